"""Writes: append, upsert without a table format, the ledger of seen items and the run table."""

from __future__ import annotations

import json
import uuid

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from ..functions.text import content_hash, item_key, sha256_hex

#: The folders of a table's buckets are named by this column, which isn't read.
BUCKET = "bucket__"


RAW_FIELDS = ("title_raw", "datetime_raw", "location_raw", "description_raw", "item_url", "extra")


def raw_rows(events: DataFrame) -> DataFrame:
    """Raw events as rows of event_raw: their payload as JSON with nulls written, and its hash, which doesn't depend on source and time."""
    payload = F.to_json(F.struct(*RAW_FIELDS), {"ignoreNullFields": "false"})
    hashed = content_hash(*[F.col(c) for c in ("title_raw", "datetime_raw", "location_raw", "description_raw", "item_url", "extra")])
    return events.select("source_id", "source_url", "item_url", hashed.alias("content_hash"), payload.alias("raw_payload"), "fetched_at", F.lit("ok").alias("status"), F.lit(None).cast("string").alias("error"))


def append(df: DataFrame, path: str, by: str = "source_id") -> None:
    """Adds rows, one folder a source."""
    df.write.mode("append").partitionBy(by).parquet(path)


def latest(df: DataFrame, keys: list[str], newest: list[Column]) -> DataFrame:
    """One row a key: the first by `newest`."""
    ranked = df.withColumn("_n", F.row_number().over(Window.partitionBy(*keys).orderBy(*newest)))
    return ranked.filter("_n = 1").drop("_n")


def upserted(target: DataFrame, rows: DataFrame, keys: list[str], newest: list[Column]) -> DataFrame:
    """The target with the latest of the rows in place of those with equal keys. Null keys never match, as in SQL."""
    new = latest(rows, keys, newest)
    kept = target.join(new.select(*[F.col(k).alias(f"_{k}") for k in keys]), [F.col(k) == F.col(f"_{k}") for k in keys], "left_anti")
    return kept.unionByName(new, allowMissingColumns=True)


class Table:
    """A parquet table in buckets by the hash of its keys, whose versions are manifests that name a folder for each bucket.

    An upsert reads and writes only the buckets that its rows fall into; the new manifest names the others' folders again.
    Manifests are made by renaming a whole file to a number that isn't taken: readers see the version before or the one after,
    and of two writers one finds its number taken and fails, with nothing lost. Reading takes the highest number.
    """

    def __init__(self, spark: SparkSession, path: str, buckets: int = 64):
        self.spark, self.path, self.buckets = spark, path.rstrip("/"), buckets

    def _at(self, name: str):
        path = self.spark.sparkContext._jvm.org.apache.hadoop.fs.Path(f"{self.path}/{name}")
        return path.getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration()), path

    def number(self) -> int:
        """The number of the current version; 0 without one."""
        fs, folder = self._at("versions")
        return max((int(f.getPath().getName()) for f in fs.listStatus(folder) if f.getPath().getName().isdigit()), default=0) if fs.exists(folder) else 0

    def exists(self) -> bool:
        return self.number() > 0

    def _manifest(self, number: int) -> dict:
        return json.loads(self.spark.read.text(f"{self.path}/versions/{number}", wholetext=True).first()[0])

    def _read(self, manifest: dict, buckets: set[str] | None = None) -> DataFrame:
        chosen = [f"{self.path}/{v}/{BUCKET}={b}" for b, v in manifest["folders"].items() if buckets is None or b in buckets]
        fields = StructType.fromJson(manifest["schema"])
        return self.spark.read.schema(fields).parquet(*chosen) if chosen else self.spark.createDataFrame([], fields)

    def read(self) -> DataFrame:
        return self._read(self._manifest(self.number()))

    def _written(self, df: DataFrame, keys: list[str], n: int) -> dict[str, str]:
        """Writes rows by bucket and gives the folder of each bucket that has some."""
        version = f"v-{uuid.uuid4().hex}"
        place = F.pmod(F.xxhash64(*[F.col(k).cast("string") for k in keys]), F.lit(n)).cast("int") if keys else F.lit(0)
        df.withColumn(BUCKET, place).write.partitionBy(BUCKET).parquet(f"{self.path}/{version}")
        fs, folder = self._at(version)
        names = [f.getPath().getName() for f in fs.listStatus(folder)]
        return {x.split("=")[1]: version for x in names if x.startswith(f"{BUCKET}=")}

    def _publish(self, manifest: dict, after: int) -> None:
        fs, folder = self._at("versions")
        fs.mkdirs(folder)
        _, draft = self._at(f"versions/_{uuid.uuid4().hex}")
        out = fs.create(draft, False)
        out.write(bytearray(json.dumps(manifest), "utf-8"))
        out.close()
        _, marker = self._at(f"versions/{after + 1}")
        if fs.exists(marker) or not fs.rename(draft, marker):
            fs.delete(draft, False)
            raise RuntimeError(f"{self.path}: version {after + 1} was written by another writer")

    def write(self, df: DataFrame, after: int | None = None, keys: list[str] | None = None) -> None:
        """Writes a whole table and names it as the version after number `after` (the current one); raises if another was written meanwhile."""
        after = self.number() if after is None else after
        folders = self._written(df, keys or [], self.buckets)
        self._publish({"keys": keys or [], "buckets": self.buckets, "folders": folders, "schema": df.schema.jsonValue()}, after)

    def upsert(self, rows: DataFrame, keys: list[str], newest: list[Column], dry_run: bool = False) -> int:
        """Upserts rows and gives the number of those that would be written; a dry run only counts.

        Rows with a null among their keys can't be found again, so that a repeated batch would add them twice: they raise an error before
        anything is written. A table that was written by other keys is dealt anew once.
        """
        bad = F.lit(False)
        for k in keys:
            bad |= F.col(k).isNull()
        if not rows.filter(bad).isEmpty():
            raise ValueError(f"null in {keys}")
        new = latest(rows, keys, newest)
        n = new.count()
        if dry_run or not n:
            return n
        after = self.number()
        held = self._manifest(after) if after else None
        if held is None or held["keys"] != keys:
            self.write(upserted(self._read(held), rows, keys, newest) if held else new, after, keys)
            return n
        place = F.pmod(F.xxhash64(*[F.col(k).cast("string") for k in keys]), F.lit(held["buckets"])).cast("int").cast("string")
        touched = {r[0] for r in new.select(place).distinct().collect()}  # as many as there are buckets at most
        merged = upserted(self._read(held, touched), rows, keys, newest)
        folders = held["folders"] | self._written(merged, keys, held["buckets"])
        fields = {f["name"]: f for f in held["schema"]["fields"]} | {f["name"]: f for f in merged.schema.jsonValue()["fields"]}
        self._publish(held | {"folders": folders, "schema": {"type": "struct", "fields": list(fields.values())}}, after)
        return n

    def find(self, **key) -> DataFrame:
        """The rows with these values, read with the condition pushed to the files."""
        out = self.read()
        for k, v in key.items():
            out = out.filter(F.col(k).eqNullSafe(F.lit(v)))
        return out

    def rows(self, columns: list[str] | None = None, most: int | None = None, **equal) -> DataFrame:
        """Chosen columns of the rows with these values, `most` of them where given; only these columns are read."""
        found = self.find(**equal)
        found = found.select(*columns) if columns else found
        return found.limit(most) if most is not None else found


def run_id(source: Column, started: Column) -> Column:
    """The id of a run follows from what it is, so that a retried task gives the same."""
    return sha256_hex(F.concat_ws("|", source, started.cast("string")), 32)


def ledger(runs: DataFrame, items: DataFrame) -> DataFrame:
    """crawl_run_id and item_key, each pair once."""
    key = item_key(F.col("item_url"), F.col("source_id"), F.col("title_raw"), F.col("datetime_raw"))
    keyed = items.select(F.col("source_id").alias("_s"), key.alias("item_key"))
    return runs.join(keyed, F.col("source_id") == F.col("_s")).select(F.col("id").alias("crawl_run_id"), "item_key").dropDuplicates()


def ledger_changes(before: DataFrame, after: DataFrame, key: str = "item_key") -> DataFrame:
    """Keys that are new and keys that are gone between two runs."""
    a, b = before.select(key).distinct(), after.select(key).distinct()
    return b.join(a, key, "left_anti").withColumn("change", F.lit("new")).unionByName(a.join(b, key, "left_anti").withColumn("change", F.lit("gone")))
