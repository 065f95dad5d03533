"""A Spark data source that fetches pages: one partition a host, so that a host is asked by one task at a time.

`spark.dataSource.register(Pages)`, then `spark.read.format("eventloom_pages").option("urls", json.dumps([[source_id, url], ...]))`
and the options `tries`, `wait`, `pause`, `timeout` and `agent`. A page that can't be fetched is a row with its error, and no failed task.
"""

from __future__ import annotations

import json
import time
from collections.abc import Iterator
from urllib.error import HTTPError, URLError
from urllib.parse import urlsplit
from urllib.request import Request, urlopen

from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition

SCHEMA = "source_id string, page int, url string, status int, html string, error string"
#: Tries of a page that answers 429, seconds to wait after the first (twice as many after the second), and until an answer must come.
TRIES, WAIT, TIMEOUT = 3, 5.0, 30.0
BUSY = 429


def fetched(url: str, tries: int = TRIES, wait: float = WAIT, timeout: float = TIMEOUT, agent: str = "Mozilla/5.0") -> tuple[str, int | None, str | None, str | None]:
    """Final URL, status, text and error. Only 429 is tried again; other answers, errors too, are what the page says."""
    for turn in range(1, tries + 1):
        try:
            with urlopen(Request(url, headers={"User-Agent": agent}), timeout=timeout) as answer:
                found, status, to, kind = answer.read(), answer.status, answer.url, answer.headers.get_content_charset()
        except HTTPError as error:
            if error.code == BUSY and turn < tries:
                time.sleep(wait * turn)
                continue
            found, status, to, kind = error.read(), error.code, url, error.headers.get_content_charset()
        except (URLError, OSError, ValueError) as error:
            return url, None, None, str(error)
        try:
            return to, status, found.decode(kind or "utf-8", "replace"), None
        except LookupError:
            return to, status, found.decode("utf-8", "replace"), None
    return url, BUSY, None, None


class _Host(InputPartition):
    def __init__(self, rows: list[tuple[int, str | None, str]]):
        super().__init__(rows)
        self.rows = rows


class _Reader(DataSourceReader):
    def __init__(self, options: dict):
        self.urls = json.loads(options.get("urls", "[]"))
        self.how = {"tries": int(options.get("tries", TRIES)), "wait": float(options.get("wait", WAIT)), "timeout": float(options.get("timeout", TIMEOUT)), "agent": options.get("agent", "Mozilla/5.0")}
        self.pause = float(options.get("pause", 0))

    def partitions(self) -> list[_Host]:
        hosts: dict[str, list] = {}
        for i, (source, url) in enumerate(self.urls):
            hosts.setdefault(urlsplit(url).netloc.lower(), []).append((i, source, url))
        return [_Host(rows) for rows in hosts.values()] or [_Host([])]

    def read(self, partition: _Host) -> Iterator[tuple]:
        for turn, (page, source, url) in enumerate(partition.rows):
            if turn:
                time.sleep(self.pause)
            to, status, html, error = fetched(url, **self.how)
            yield source, page, to, status, html, error


class Pages(DataSource):
    @classmethod
    def name(cls) -> str:
        return "eventloom_pages"

    def schema(self) -> str:
        return SCHEMA

    def reader(self, schema) -> DataSourceReader:
        return _Reader(self.options)
