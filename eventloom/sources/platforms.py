"""Scans of event platforms: each reads captured listing pages into items, first occurrences in order.

A scan is a function of pages (source_id, page, url, html; `page` is the place of a page in its listing) to items (source_id,
page, pos, item_url and what the listing says). Fetching isn't done here. Patterns are fixed values of the platforms.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import dates as D
from ..functions import links as L
from ..functions import records as R
from ..functions import text as T
from ..operators.ordering import forward_fill, keep_first, until_nothing_new
from .dom import read

SCANS: dict[str, Callable[..., DataFrame]] = {}
ICMS_PATH = r"^/(?:_rte/anlass|anlaesseaktuelles)/(\d+)$"
MONTH = r"^(?:Januar|Februar|März|April|Mai|Juni|Juli|August|September|Oktober|November|Dezember)(?:\s+\d{4})?$"


def scan(name: str):
    def add(f):
        SCANS[name] = f
        return f

    return add


def _links(pages: DataFrame, chosen: Callable[[Column], Column], url: Callable[[Column, Column], Column]) -> DataFrame:
    """The page's links that `chosen` takes, as `url` makes of them, each once a source."""
    at = pages.select("source_id", "page", "url", F.posexplode(read(F.col("html"))["links"]).alias("pos", "a")).filter(chosen(F.col("a")))
    found = at.select("source_id", "page", "pos", url(F.col("url"), F.col("a.href")).alias("item_url"), F.col("a.text").alias("title_raw"))
    return keep_first(found, ["source_id", "item_url"], ["page", "pos"])


def _resolved(page: Column, href: Column) -> Column:
    return L.resolve(page, L.bare(href))


@scan("icms")
def icms(pages: DataFrame, categories: tuple[str, ...] = ("18", "14", "17")) -> DataFrame:
    """Entries of the listing's JSON attribute with a wanted category; pages without it give all detail paths in their HTML.

    The newest ids come first; `relevant` says whether a category fits, so that filtering is left to the feed.
    """
    parsed = pages.withColumn("p", read(F.col("html")))
    entries = R.typed(R.variant(F.col("p.entities")), "$.data", "array<variant>", ("ARRAY",))
    listed = parsed.withColumn("e", F.explode(entries)).select(
        "source_id", "page", "url", L.bare(F.regexp_extract(F.try_variant_get("e", "$.name", "string"), 'href="([^"]+)"', 1)).alias("path"),
        F.coalesce(F.arrays_overlap(F.transform(F.split(F.try_variant_get("e", "$._hauptkategorieId", "string"), ","), T.strip), F.array(*[F.lit(c) for c in categories])), F.lit(False)).alias("relevant"),
    )
    hrefs = F.transform("p.links", lambda a: L.bare(a["href"]))
    escaped = F.transform(F.regexp_extract_all("html", F.lit(r"(\\/(?:_rte\\/anlass|anlaesseaktuelles)\\/\d+)"), F.lit(1)), lambda x: F.replace(x, F.lit("\\/"), F.lit("/")))
    rest = parsed.filter(entries.isNull()).select("source_id", "page", "url", F.explode(F.concat(hrefs, escaped)).alias("path"), F.lit(True).alias("relevant"))
    found = listed.unionByName(rest).filter(F.col("path").rlike(ICMS_PATH))
    numbered = found.select("source_id", "page", (-F.regexp_extract("path", ICMS_PATH, 1).cast("bigint")).alias("pos"), L.resolve(F.col("url"), F.col("path")).alias("item_url"), "relevant")
    return keep_first(numbered, ["source_id", "item_url"], ["pos", F.col("relevant").desc()])


@scan("kirchenweb_months")
def kirchenweb_months(pages: DataFrame, kept: str = "sucheZielgruppe") -> DataFrame:
    """Month pages that a listing links to, with the listing's audience parameter put back where a link drops it."""

    def url(page: Column, href: Column) -> Column:
        full, audience = L.resolve(page, href), T.extract(page, rf"[?&]({kept}=[^&#]*)", 1)
        joint = F.when(F.contains(full, F.lit("?")), "&").otherwise("?")
        return F.when(audience.isNotNull() & ~F.contains(full, F.lit(f"{kept}=")), F.concat(full, joint, audience)).otherwise(full)

    return _links(pages, lambda a: F.contains(a["href"], F.lit("sucheDarstellungTitel=")) & T.strip(a["text"]).rlike(MONTH), url)


@scan("kirchenweb")
def kirchenweb(pages: DataFrame) -> DataFrame:
    return _links(pages, lambda a: F.array_contains(F.split(a["classes"], " "), "agendaTitel") & L.bare(a["href"]).rlike(r"/veranstaltung/\d+$"), _resolved)


def govis_pages(html: Column, template: Column, most: int = 30) -> Column:
    """URLs of the pages after the first, from `Seite X von Y`; `{page}` in the template is the number."""
    last = F.least(F.coalesce(T.extract(html, r"Seite\s+\d+\s+von\s+(\d+)", 1).cast("int"), F.lit(1)), F.lit(most))
    numbers = F.when(last >= 2, F.sequence(F.lit(2), F.greatest(last, F.lit(2)))).otherwise(F.array().cast("array<int>"))
    return F.transform(numbers, lambda n: F.replace(template, F.lit("{page}"), n.cast("string")))


@scan("govis")
def govis(pages: DataFrame) -> DataFrame:
    return _links(pages, lambda a: L.bare(a["href"]).rlike(r"/event/\d+(?:/eventdate/\d+)?$"), _resolved)


@scan("ai1ec")
def ai1ec(pages: DataFrame) -> DataFrame:
    """Agenda pages up to the first without a new link."""
    at = pages.select("source_id", "page", "url", F.posexplode(read(F.col("html"))["links"]).alias("pos", "a")).filter(F.col("a.href").rlike(r"/Veranstaltung/[^/]+/\?instance_id=\d+"))
    found = at.select("source_id", "page", "pos", L.resolve(F.col("url"), F.col("a.href")).alias("item_url"), F.col("a.text").alias("title_raw"))
    return until_nothing_new(found, "item_url", "page", ["source_id"], ["pos"])


@scan("contao")
def contao(pages: DataFrame) -> DataFrame:
    return _links(pages, lambda a: F.array_contains(F.split(a["around"], " "), "event"), _resolved)


@scan("clubdesk")
def clubdesk(pages: DataFrame) -> DataFrame:
    """Detail pages in `onclick` handlers."""
    at = pages.select("source_id", "page", "url", F.posexplode(read(F.col("html"))["onclick"]).alias("pos", "path"))
    return keep_first(at.select("source_id", "page", "pos", L.resolve(F.col("url"), F.col("path")).alias("item_url")), ["source_id", "item_url"], ["page", "pos"])


@scan("eventbrite")
def eventbrite(pages: DataFrame) -> DataFrame:
    return _links(pages, lambda a: F.contains(a["href"], F.lit("/e/")) & a["href"].rlike(r"tickets?-\d+"), _resolved)


@scan("forum")
def forum(pages: DataFrame) -> DataFrame:
    """Agenda tables, whose days stand only at the first row of each: filled down a page, else taken from the URL."""
    at = pages.select("source_id", "page", "url", F.posexplode(read(F.col("html"))["rows"]).alias("pos", "r"))
    rows = at.select("source_id", "page", "pos", "url", F.col("r.day").alias("day"), F.col("r.href").alias("href"), F.col("r.title").alias("title_raw"), F.col("r.time").alias("time"), F.col("r.location").alias("location_raw"), F.col("r.category").alias("category_raw"))
    in_url = F.regexp_replace(T.extract(F.col("href"), r"/agenda/(\d{8})-", 1), r"(\d{4})(\d{2})(\d{2})", "$1-$2-$3")
    filled = forward_fill(rows, "day", ["source_id", "page"], ["pos"], in_url).filter(F.col("href").isNotNull() & F.col("title_raw").isNotNull() & F.col("day").isNotNull())
    item = L.resolve(F.col("url"), F.col("href"))
    found = filled.withColumn("item_url", item).withColumn("key", F.coalesce(T.extract(L.bare(F.col("item_url")), r"-(\d+)/?$", 1), F.col("item_url")))
    first = keep_first(found, ["source_id", "key"], ["page", "pos"])
    return first.select("source_id", "page", "pos", "item_url", "title_raw", F.concat_ws("T", "day", "time").alias("datetime_raw"), "location_raw", "category_raw")


def forum_following(pages: DataFrame, kept: tuple[str, ...] = ("category", "region")) -> DataFrame:
    """source_id, page and item_url: the page that follows each agenda page, as its button says, with the filters of the page's own URL put back. Pages without new rows have none."""
    url = F.col("url")
    listed = pages.select("source_id", "page", "url", read(F.col("html")).alias("p"))
    items = listed.select("source_id", "page", "url", F.posexplode("p.rows").alias("pos", "r")).select("source_id", "page", "pos", L.resolve(url, F.col("r.href")).alias("item_url")).filter("item_url is not null")
    fresh = until_nothing_new(items, "item_url", "page", ["source_id"], ["pos"]).select(F.col("source_id").alias("_s"), F.col("page").alias("_p")).distinct()
    full = L.resolve(url, F.col("p.next_page"))
    for name in kept:
        own = T.extract(url, rf"[?&]({name}=[^&#]*)", 1)
        joint = F.when(F.contains(full, F.lit("?")), "&").otherwise("?")
        full = F.when(own.isNotNull() & ~full.rlike(rf"[?&]{name}="), F.concat(full, joint, own)).otherwise(full)
    met = listed.filter("p.next_page is not null").join(fresh, F.col("source_id").eqNullSafe(F.col("_s")) & (F.col("page") == F.col("_p")), "left_semi")
    return met.select("source_id", "page", full.alias("item_url"))


RSS_DESCRIPTION = r"(?s)^\s*(\d{2}/\d{2}/\d{4})\s*-\s*(\d{2}:\d{2})\s*-\s*(\d{2}:\d{2})\s*<br\s*/>\s*(.+?)\s*<br\s*/>\s*(.+?)\s*<br\s*/>\s*(.+)"


@scan("rss")
def rss(feeds: DataFrame) -> DataFrame:
    """Items of RSS documents (source_id, page, url, html: the XML) whose description gives date, times and place; pubDate isn't the event's."""
    schema = "STRUCT<channel STRUCT<item ARRAY<STRUCT<title STRING, link STRING, description STRING>>>>"
    items = F.from_xml("html", F.lit(schema), {"rowTag": "rss"})["channel"]["item"]
    at = feeds.select("source_id", "page", F.posexplode(items).alias("pos", "i"))
    part = lambda g: T.strip(T.extract(F.col("i.description"), RSS_DESCRIPTION, g))
    day = F.date_format(D.slashed_date(part(1)), "yyyy-MM-dd")
    return at.filter(F.col("i.description").rlike(RSS_DESCRIPTION) & T.blank_to_null(T.strip(F.col("i.title"))).isNotNull()).select(
        "source_id", "page", "pos", T.strip(F.col("i.link")).alias("item_url"), T.strip(F.col("i.title")).alias("title_raw"), F.concat(day, F.lit("T"), part(2), F.lit(":00")).alias("datetime_raw"),
        F.concat(day, F.lit("T"), part(3), F.lit(":00")).alias("end_time"), F.concat_ws(", ", part(4), part(5), part(6)).alias("location_raw"), part(4).alias("venue"), part(5).alias("street"), part(6).alias("city"),
    )


@scan("ics")
def ics(files: DataFrame) -> DataFrame:
    """One event a file (source_id, page, url, html: the calendar's text), with its category's relevance."""
    e = R.vevent(F.col("html"))
    held = files.select("source_id", "page", "url", e.alias("e")).filter("e is not null")
    field = lambda name: R.unescaped(R.ics_field(F.col("e"), name))
    cut = T.split_category(field("SUMMARY"))
    raw = lambda name: D.ics_time(R.ics_field(F.col("e"), name), R.ics_parameter(F.col("e"), name, "TZID"))
    return held.select(
        "source_id", "page", F.lit(0).alias("pos"), F.coalesce(R.ics_field(F.col("e"), "URL"), F.col("url")).alias("item_url"), cut["title"].alias("title_raw"), cut["category"].alias("category_raw"),
        R.relevance(cut["category"]).alias("relevance"), raw("DTSTART").alias("start"), raw("DTEND").alias("end"), F.coalesce(field("LOCATION"), T.outing_location(cut["title"])).alias("location_raw"),
        T.truncated(field("DESCRIPTION"), 2000).alias("description_raw"), R.ics_organizer(F.col("e")).alias("organizer"),
    )


@scan("screenings")
def screenings(pages: DataFrame) -> DataFrame:
    """Dates of a cinema club's page by its film and venue; a row for each date, with times only if the page has them."""
    lines = pages.select("source_id", "page", "url", read(F.col("html")).alias("p")).select("source_id", "page", "url", "p.h1", F.posexplode("p.lines").alias("pos", "line"))
    day = D.explicit_date(F.col("line"))
    dated = lines.withColumn("day", day).filter("day is not null")
    times = T.showtimes(F.col("line"))
    return dated.select("source_id", "page", "pos", F.col("url").alias("item_url"), F.col("h1").alias("title_raw"), F.date_format("day", "yyyy-MM-dd").alias("day"), F.explode_outer(times).alias("time")).withColumn(
        "datetime_raw", F.concat_ws("T", "day", "time")
    )
