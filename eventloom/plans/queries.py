"""Queries for each group of operators over whole tables, each with the SQL that gives the same rows.

Tables stand in for event records: events are feed rows and crawl results, orders staged events, documents titles, pages captured pages.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import dates as D
from ..functions import links as L
from ..functions import records as R
from ..functions import text as T
from ..operators import contracts, linkage, merging, ordering, sync
from ..sources import sinks
from .registry import query

#: The clock of all feed queries: a Wednesday noon, UTC.
CLOCK = "2024-01-17 12:00:00"
FEED_SQL = f"""
WITH led AS (
  SELECT event_id, user_id, event_type, ts, value, lead(ts) OVER (PARTITION BY user_id ORDER BY ts, event_id) AS nxt FROM events
), feed AS (
  SELECT CAST(event_id AS VARCHAR) AS external_id, event_type AS title, 'user ' || user_id AS location_name,
    CASE WHEN event_id % 5 = 0 THEN 'series ' || (event_id % 50) END AS series_label,
    CASE WHEN event_id % 3 = 0 THEN 'date' ELSE 'datetime' END AS date_precision, ts AS start_at, nxt AS end_at,
    CAST(ts AT TIME ZONE 'UTC' AT TIME ZONE 'Europe/Zurich' AS TIMESTAMP) AS start_local,
    CAST(ts AT TIME ZONE 'UTC' AT TIME ZONE 'Europe/Zurich' AS DATE) AS start_date,
    CASE WHEN event_id % 3 = 0 THEN NULL ELSE strftime(CAST(ts AT TIME ZONE 'UTC' AT TIME ZONE 'Europe/Zurich' AS TIMESTAMP), '%H:%M') END AS start_time_local,
    CASE WHEN CAST(ts AT TIME ZONE 'UTC' AT TIME ZONE 'Europe/Zurich' AS DATE) BETWEEN DATE '2024-01-18' AND DATE '2024-01-21' THEN 'weekend' ELSE 'coming_up' END AS section_key,
    coalesce((epoch_us(nxt) - epoch_us(ts)) / 3.6e9 <= 12 AND TIMESTAMP '{CLOCK}' BETWEEN ts AND nxt, false) AS is_happening_now
  FROM led
)
"""


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def clock():
    return F.lit(CLOCK).cast("timestamp")


def feed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events as feed rows."""
    from pyspark.sql import Window

    ts = F.col("ts").cast("timestamp")
    nxt = F.lead(ts).over(Window.partitionBy("user_id").orderBy("ts", "event_id"))
    led = table(spark, sf_dir, "events").select("event_id", "user_id", "event_type", "value", ts.alias("start_at"), nxt.alias("end_at"))
    date = D.local_date(F.col("start_at"))
    dated = F.col("event_id") % 3 == 0
    local = F.from_utc_timestamp("start_at", D.ZONE)
    return led.select(
        F.col("event_id").cast("string").alias("external_id"), F.col("event_type").alias("title"), F.concat(F.lit("user "), F.col("user_id")).alias("location_name"),
        F.when(F.col("event_id") % 5 == 0, F.concat(F.lit("series "), F.col("event_id") % 50)).alias("series_label"), F.when(dated, "date").otherwise("datetime").alias("date_precision"),
        "start_at", "end_at", local.alias("start_local"), date.alias("start_date"), F.when(~dated, F.date_format(local, "HH:mm")).alias("start_time_local"),
        D.section(date, F.to_date(F.from_utc_timestamp(clock(), D.ZONE))).alias("section_key"), D.is_ongoing(F.col("start_at"), F.col("end_at"), clock()).alias("is_happening_now"),
    )


# scans and pages


@query(r"""
WITH good AS (
  SELECT page_id, url, html, regexp_extract(url, '://([^/?#]*)', 1) AS host FROM pages
  WHERE NOT regexp_matches(substr(html, 1, 5000), '(?i)challenges\.cloudflare\.com|<title>\s*(Just a moment\.\.\.|Access Denied|403\s+Forbidden|502\s+Bad Gateway|503\s+Service\b.*?Unavailable)\s*</title>')
), links AS (
  SELECT host, page_id, unnest(regexp_extract_all(html, 'href="([^"]*)"', 1)) AS href FROM good
), per AS (SELECT host, count(*) AS links, count(DISTINCT href) AS distinct_links FROM links GROUP BY host)
SELECT g.host, count(*) AS pages, max(coalesce(p.links, 0)) AS links, max(coalesce(p.distinct_links, 0)) AS distinct_links FROM good g LEFT JOIN per p USING (host) GROUP BY g.host
""")
def page_ingest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Captured pages without blocks, their links and counts by host."""
    good = table(spark, sf_dir, "pages").filter(~L.is_blocked(None, F.col("html"))).select(L.host(F.col("url")).alias("host"), F.regexp_extract_all("html", F.lit('href="([^"]*)"'), F.lit(1)).alias("hrefs"))
    per = good.select("host", F.explode("hrefs").alias("href")).groupBy("host").agg(F.count(F.lit(1)).alias("links"), F.countDistinct("href").alias("distinct_links"))
    return good.groupBy("host").agg(F.count(F.lit(1)).alias("pages")).join(per, "host", "left").fillna(0, ["links", "distinct_links"])


@query(r"""
SELECT page_id, CASE WHEN regexp_matches(href, '^[a-zA-Z][a-zA-Z0-9+.-]*:') THEN href WHEN href = '' THEN url WHEN starts_with(href, '#') THEN regexp_replace(url, '#.*$', '') || href
  WHEN starts_with(href, '/') THEN regexp_extract(url, '^[a-z]+://[^/?#]*') || href END AS item_url, pos FROM (
  SELECT page_id, url, href, pos, row_number() OVER (PARTITION BY page_id, href ORDER BY pos) AS n FROM (
    SELECT page_id, url, unnest(hrefs) AS href, unnest(range(len(hrefs))) AS pos FROM (SELECT page_id, url, regexp_extract_all(html, 'href="([^"]*)"', 1) AS hrefs FROM pages)))
WHERE n = 1
""")
def link_extract_resolve(spark: SparkSession, sf_dir: str) -> DataFrame:
    hrefs = F.regexp_extract_all("html", F.lit('href="([^"]*)"'), F.lit(1))
    found = table(spark, sf_dir, "pages").select("page_id", "url", F.posexplode(hrefs).alias("pos", "href"))
    first = ordering.keep_first(found, ["page_id", "href"], ["pos"])
    return first.select("page_id", L.resolve(F.col("url"), F.col("href")).alias("item_url"), F.col("pos").cast("bigint").alias("pos"))


@query("""
SELECT c_custkey, c_custkey % 9 IN (0, 3) AS is_pdf, c_custkey % 9 IN (1, 4, 6, 7) AS is_external,
  CASE c_custkey % 9 WHEN 0 THEN 'document' WHEN 2 THEN 'organizer' WHEN 4 THEN 'registration' WHEN 5 THEN 'organizer' WHEN 6 THEN 'ticket' WHEN 7 THEN 'venue' WHEN 8 THEN 'venue' ELSE 'other' END AS link_class FROM customer
""")
def link_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """PDF, external and class rules over links of nine kinds."""
    k = F.col("c_custkey")
    n = k.cast("string")
    kinds = [
        (F.concat(F.lit("/doc"), n, F.lit(".PDF")), "Flyer"), (F.concat(F.lit("https://b.ch/p"), n), "Mehr"), (F.concat(F.lit("mailto:i"), n, F.lit("@a.ch")), "Mail"), (F.concat(F.lit("https://cdn.b.ch/p"), n), "Programm als pdf"),
        (F.concat(F.lit("//c.ch/anmeldung"), n), "hier"), (F.concat(F.lit("https://A.ch/y"), n), "TRÄGER"), (F.concat(F.lit("https://www.eventfrog.ch/"), n), ""), (F.lit("https://d.ch"), "Anfahrt"), (F.concat(F.lit("#top"), n), "Karte"),
    ]
    href, text = (F.element_at(F.array(*c), (k % 9 + 1).cast("int")) for c in ([h for h, _ in kinds], [F.lit(t) for _, t in kinds]))
    rows = table(spark, sf_dir, "customer").select("c_custkey", href.alias("href"), text.alias("text"))
    href, text = F.col("href"), F.col("text")
    return rows.select("c_custkey", L.is_pdf(href, text).alias("is_pdf"), L.is_external(F.lit("https://a.ch/x"), href).alias("is_external"), T.link_class(href, text).alias("link_class"))


@query(r"""
SELECT link_class, count(*) AS n FROM (
  SELECT CASE WHEN ends_with(lower(href), '.pdf') THEN 'document' WHEN starts_with(href, 'mailto:') THEN 'organizer' WHEN regexp_matches(href, '(?i)(ticket|eventbrite|eventfrog|starticket|ticketcorner)') THEN 'ticket'
    WHEN regexp_matches(href, '(?i)(anmeld|registr|booking|sign.?up|einschreib|teilnahm|buchen)') OR regexp_matches(txt, '(?i)(anmeld|registr|booking|sign.?up|einschreib|teilnahm|buchen)') THEN 'registration'
    WHEN regexp_matches(txt, '(?i)(veranstalter|organisator|organizer|organiser|träger)') THEN 'organizer'
    WHEN regexp_matches(txt, '(?i)(standort|ort|karte|map|wegbeschreibung|anfahrt|location|directions)') THEN 'venue' ELSE 'other' END AS link_class
  FROM (SELECT unnest(regexp_extract_all(html, '<a\s[^>]*href="([^"]*)"[^>]*>[^<]*</a>', 1)) AS href, unnest(regexp_extract_all(html, '<a\s[^>]*href="[^"]*"[^>]*>([^<]*)</a>', 1)) AS txt FROM pages))
GROUP BY link_class
""")
def link_class_hist(spark: SparkSession, sf_dir: str) -> DataFrame:
    pair = F.arrays_zip(F.regexp_extract_all("html", F.lit(r'<a\s[^>]*href="([^"]*)"[^>]*>[^<]*</a>'), F.lit(1)).alias("href"), F.regexp_extract_all("html", F.lit(r'<a\s[^>]*href="[^"]*"[^>]*>([^<]*)</a>'), F.lit(1)).alias("txt"))
    links = table(spark, sf_dir, "pages").select(F.explode(pair).alias("a"))
    return links.groupBy(T.link_class(F.col("a.href"), F.col("a.txt")).alias("link_class")).agg(F.count(F.lit(1)).alias("n"))


# text, keys and linkage

_TITLE_SQL = r"regexp_replace(regexp_replace(trim(lower({0}), E' \t\n\r'), '\s+', ' ', 'g'), '[^\pL\pN_\s]', '', 'g')"


@query(f"SELECT doc_id, md5({_TITLE_SQL.format('text')}) AS title_md5 FROM documents")
def title_normalize(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "documents").select("doc_id", F.md5(T.normalize_title(F.col("text")).cast("binary")).alias("title_md5"))


_VENUE_SQL = r"regexp_replace(replace(replace(regexp_replace(trim(lower({0})), '\s+', ' ', 'g'), 'str.', 'strasse'), 'str ', 'strasse '), '[.,;]+$', '')"


@query(f"SELECT c_custkey, {_VENUE_SQL.format(chr(39) + '  Seestr. ' + chr(39) + ' || c_custkey || ' + chr(39) + ', ' + chr(39) + ' || c_name || ' + chr(39) + '.,;' + chr(39))} AS venue FROM customer")
def venue_normalize(spark: SparkSession, sf_dir: str) -> DataFrame:
    raw = F.concat(F.lit("  Seestr. "), F.col("c_custkey"), F.lit(", "), F.col("c_name"), F.lit(".,;"))
    return table(spark, sf_dir, "customer").select("c_custkey", T.normalize_venue(raw).alias("venue"))


@query(rf"""
SELECT dedupe_key, count(*) AS occurrences, min(doc_id) AS first_id FROM (
  SELECT doc_id, substr(sha256(concat_ws('|', nullif({_TITLE_SQL.format("text")}, ''), lang, nullif({_VENUE_SQL.format("source")}, ''))), 1, 32) AS dedupe_key FROM documents)
GROUP BY dedupe_key HAVING count(*) > 1
""")
def fingerprint_dupes(spark: SparkSession, sf_dir: str) -> DataFrame:
    keyed = table(spark, sf_dir, "documents").select("doc_id", T.fingerprint(F.col("text"), F.col("lang"), F.col("source")).alias("dedupe_key"))
    return keyed.groupBy("dedupe_key").agg(F.count(F.lit(1)).alias("occurrences"), F.min("doc_id").alias("first_id")).filter("occurrences > 1")


@query("SELECT event_id, user_id, event_type FROM (SELECT *, row_number() OVER (PARTITION BY user_id, event_type ORDER BY ts, event_id) AS n FROM events) WHERE n = 1")
def dedupe_keep_first(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ordering.keep_first(table(spark, sf_dir, "events"), ["user_id", "event_type"], ["ts", "event_id"]).select("event_id", "user_id", "event_type")


_PAIRS_SQL = rf"""
WITH t AS (SELECT p_partkey AS id, {_TITLE_SQL.format("p_name || ' ' || p_type")} AS title, DATE '2024-01-01' + CAST(p_size AS INT) AS d, {_VENUE_SQL.format("p_brand || ' str. ' || (p_partkey % 7)")} AS venue, p_brand FROM part),
tok AS (SELECT *, list_distinct(list_filter(string_split(title, ' '), lambda x: x <> '')) AS tt, list_distinct(list_filter(string_split(venue, ' '), lambda x: x <> '')) AS vt FROM t),
pairs AS (
  SELECT a.id AS source_happening_id, b.id AS happening_id,
    0.5::DOUBLE * (len(list_intersect(a.tt, b.tt))::DOUBLE / len(list_distinct(list_concat(a.tt, b.tt)))) + 0.3::DOUBLE * 1.0::DOUBLE
      + 0.2::DOUBLE * (len(list_intersect(a.vt, b.vt))::DOUBLE / len(list_distinct(list_concat(a.vt, b.vt)))) AS score
  FROM tok a JOIN tok b ON a.d = b.d WHERE a.id % 2 = 0 AND b.id % 2 = 1)
"""


def _titled(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    """Parts with even ids as sources and those with odd ids as happenings."""
    part = table(spark, sf_dir, "part")
    rows = part.select(
        F.col("p_partkey").alias("id"), F.concat_ws(" ", "p_name", "p_type").alias("title"), F.date_add(F.lit("2024-01-01").cast("date"), F.col("p_size")).alias("start_date"),
        F.concat(F.col("p_brand"), F.lit(" str. "), (F.col("p_partkey") % 7).cast("string")).alias("venue"),
    )
    return rows.filter("id % 2 = 0"), rows.filter("id % 2 = 1")


@query(_PAIRS_SQL + "SELECT source_happening_id, happening_id, round(score, 9) AS score FROM pairs WHERE score >= 0.6")
def similarity_pairs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return linkage.scored_pairs(*_titled(spark, sf_dir), 0.6).select("source_happening_id", "happening_id", F.round("score", 9).alias("score"))


@query(_PAIRS_SQL + """,
best AS (SELECT *, row_number() OVER w AS n, score - lead(score) OVER w AS margin FROM pairs WINDOW w AS (PARTITION BY source_happening_id ORDER BY score DESC, happening_id)),
chosen AS (SELECT * FROM best WHERE n = 1 AND score >= 0.85)
SELECT t.id AS source_happening_id, c.happening_id, CASE WHEN c.score IS NULL THEN 'create' WHEN coalesce(c.margin < 0.05, false) THEN 'needs_review' ELSE 'merge' END AS decision
FROM t LEFT JOIN chosen c ON t.id = c.source_happening_id WHERE t.id % 2 = 0
""")
def match_decision(spark: SparkSession, sf_dir: str) -> DataFrame:
    """merge, create or needs_review for every source, those without any candidate among them."""
    return linkage.decide(*_titled(spark, sf_dir)).select("source_happening_id", "happening_id", "decision")


@query(_PAIRS_SQL.replace("FROM tok a JOIN tok b ON a.d = b.d WHERE", "FROM tok a JOIN tok b ON true WHERE").replace("+ 0.3::DOUBLE * 1.0::DOUBLE", "+ 0.3::DOUBLE * (a.d = b.d)::INT::DOUBLE") + """
SELECT source_happening_id, happening_id AS candidate_happening_id, CAST(CAST(score AS DECIMAL(4,3)) AS DOUBLE) AS confidence_score FROM pairs WHERE score >= 0.6 AND score < 0.85
""")
def ambiguous_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = linkage.ambiguous(linkage.scored_pairs(*_titled(spark, sf_dir), 0.6, any_day=True))
    return found.select("source_happening_id", "candidate_happening_id", F.col("confidence_score").cast("double").alias("confidence_score"))


@query("""
WITH d AS (SELECT source_happening_id, happening_id, score, score - lead(score) OVER w AS margin, row_number() OVER w AS n FROM (
"""  + _PAIRS_SQL + """ SELECT * FROM pairs) WINDOW w AS (PARTITION BY source_happening_id ORDER BY score DESC, happening_id))
SELECT source_happening_id, happening_id, 20 AS source_priority, false AS is_primary FROM d WHERE n = 1 AND score >= 0.85 AND NOT coalesce(margin < 0.05, false)
""")
def merge_links(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What a merge may write: links of provenance."""
    return linkage.linked(linkage.decide(*_titled(spark, sf_dir)), F.lit(20))


@query("""
WITH s AS (SELECT o_orderkey AS id, o_orderkey % 25 AS source, o_custkey AS ext, md5(CASE o_orderkey % 5 WHEN 0 THEN 'MACHINERY' WHEN 1 THEN 'BUILDING' WHEN 2 THEN 'AUTOMOBILE' WHEN 3 THEN 'FURNITURE' ELSE 'HOUSEHOLD' END || o_custkey) AS k FROM orders),
h AS (SELECT c_custkey AS id, c_nationkey AS source, c_custkey AS ext, md5(c_mktsegment || c_custkey) AS k FROM customer WHERE c_acctbal >= 0),
e AS (SELECT s.id AS sid, h.id AS hid FROM s JOIN h ON s.source = h.source AND s.ext = h.ext)
SELECT sid AS source_happening_id, hid AS happening_id, 'external_id' AS rule FROM e
UNION ALL SELECT s.id, h.id, 'fingerprint' FROM s JOIN h ON s.k = h.k WHERE s.id NOT IN (SELECT sid FROM e)
""")
def exact_match(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All orders against all customers, by id within a source and else by fingerprint; customers in debt are archived."""
    k = F.col("o_orderkey")
    segment = F.element_at(F.array(*map(F.lit, ("MACHINERY", "BUILDING", "AUTOMOBILE", "FURNITURE", "HOUSEHOLD"))), (k % 5 + 1).cast("int"))
    key = lambda a, b: F.md5(F.concat(a, b.cast("string")).cast("binary"))
    sources = table(spark, sf_dir, "orders").select(k.alias("id"), (k % 25).cast("int").alias("source_id"), F.col("o_custkey").alias("external_id"), key(segment, F.col("o_custkey")).alias("dedupe_key"))
    c = F.col("c_custkey")
    happenings = table(spark, sf_dir, "customer").select(c.alias("id"), F.col("c_nationkey").alias("source_id"), c.alias("external_id"), key(F.col("c_mktsegment"), c).alias("dedupe_key"), F.when(F.col("c_acctbal") < 0, "archived").otherwise("published").alias("status"))
    return linkage.exact_matches(sources, happenings)


@query(r"""
SELECT o_orderkey, CASE WHEN o_orderkey % 2 = 0 THEN 'https://x.ch/' || o_orderkey ELSE 'hash:' || substr(sha256('s' || (o_custkey % 9) || '|' || o_orderpriority || '|' || o_orderstatus), 1, 24) END AS item_key,
  sha256(CASE WHEN o_orderkey % 2 = 0 THEN 's' || (o_custkey % 9) || '|url|https://x.ch/' || o_orderkey ELSE 's' || (o_custkey % 9) || '|' || lower(o_orderpriority) || '|' || strftime(o_orderdate, '%Y-%m-%dT%H:%M:%S+00:00') || '|' || lower(o_orderstatus) END) AS external_id,
  's' || (o_custkey % 9) || ':occ:' || substr(sha1('s' || (o_custkey % 9) || ':occ:' || o_orderkey || ':x'), 1, 24) AS public_id
FROM orders
""")
def stable_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    source = F.concat(F.lit("s"), F.col("o_custkey") % 9)
    url = F.when(F.col("o_orderkey") % 2 == 0, F.concat(F.lit("https://x.ch/"), F.col("o_orderkey")))
    title, where = F.col("o_orderpriority"), F.col("o_orderstatus")
    return table(spark, sf_dir, "orders").select(
        "o_orderkey", T.item_key(url, source, title, where).alias("item_key"), T.external_id(source, url, title, F.col("o_orderdate").cast("timestamp"), where).alias("external_id"),
        T.public_id(source, "occ", F.col("o_orderkey").cast("string"), F.lit("x")).alias("public_id"),
    )


# order, streaks, quotas


@query("""
WITH f AS (SELECT event_id, user_id, ts, event_type = 'error' AS failed FROM events),
r AS (SELECT *, sum(CASE WHEN failed THEN 0 ELSE 1 END) OVER (PARTITION BY user_id ORDER BY ts, event_id) AS run FROM f),
s AS (SELECT *, sum(CASE WHEN failed THEN 1 ELSE 0 END) OVER (PARTITION BY user_id, run ORDER BY ts, event_id) AS streak FROM r),
o AS (SELECT *, coalesce(max(CASE WHEN streak >= 2 THEN 1 ELSE 0 END) OVER (PARTITION BY user_id ORDER BY ts, event_id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS opened FROM s)
SELECT event_id, user_id FROM o WHERE opened = 0
""")
def breaker_cut(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = table(spark, sf_dir, "events").select("event_id", "user_id", "ts", "event_type")
    return ordering.breaker_cut(events, F.col("event_type") == "error", ["user_id"], ["ts", "event_id"], 2).select("event_id", "user_id")


@query("""
WITH f AS (SELECT event_id, user_id, ts, value, event_type = 'error' AS failed FROM events),
r AS (SELECT *, sum(CASE WHEN failed THEN 0 ELSE 1 END) OVER (PARTITION BY user_id ORDER BY ts, event_id) AS run FROM f),
s AS (SELECT *, sum(CASE WHEN failed THEN 1 ELSE 0 END) OVER (PARTITION BY user_id, run ORDER BY ts, event_id) AS streak FROM r),
o AS (SELECT *, coalesce(max(CASE WHEN streak >= 2 THEN 1 ELSE 0 END) OVER (PARTITION BY user_id ORDER BY ts, event_id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS opened FROM s)
SELECT event_id, CASE WHEN opened = 0 THEN value END AS value, opened = 1 AS breaker_open FROM o
""")
def breaker_blank(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = table(spark, sf_dir, "events").select("event_id", "user_id", "ts", "event_type", "value")
    return ordering.breaker_blank(events, F.col("event_type") == "error", ["user_id"], ["ts", "event_id"], ["value"], 2).select("event_id", "value", "breaker_open")


@query("""
WITH p AS (SELECT event_id, event_type, user_id % 60 AS k, (event_id - 1) // 100 AS page FROM events),
n AS (SELECT *, row_number() OVER (PARTITION BY event_type, k ORDER BY page, event_id) AS n FROM p),
st AS (SELECT event_type, min(page) AS stop FROM (SELECT event_type, page, count(*) FILTER (WHERE n = 1) AS fresh FROM n GROUP BY 1, 2) WHERE fresh = 0 GROUP BY 1)
SELECT n.event_id, n.event_type, n.k FROM n LEFT JOIN st USING (event_type) WHERE n.n = 1 AND (st.stop IS NULL OR n.page < st.stop)
""")
def pagination_stop(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = table(spark, sf_dir, "events").select("event_id", "event_type", (F.col("user_id") % 60).alias("k"), F.floor((F.col("event_id") - 1) / 100).alias("page"))
    return ordering.until_nothing_new(pages, "k", "page", ["event_type"], ["event_id"]).select("event_id", "event_type", "k")


@query("SELECT o_orderkey, o_custkey FROM (SELECT *, row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate, o_orderkey) AS n FROM orders) WHERE n <= 3")
def quota(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ordering.quota(table(spark, sf_dir, "orders"), ["o_custkey"], ["o_orderdate", "o_orderkey"], 3).select("o_orderkey", "o_custkey")


@query("SELECT DISTINCT l_partkey FROM lineitem ORDER BY l_partkey DESC LIMIT 200")
def top_distinct(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The newest 200 ids: the feature is the limit."""
    return ordering.top(table(spark, sf_dir, "lineitem").select("l_partkey"), ["l_partkey"], [F.desc("l_partkey")], 200)


@query("""
SELECT event_id, coalesce(last_value(CASE WHEN event_type = 'signup' THEN value END IGNORE NULLS) OVER (PARTITION BY user_id ORDER BY ts, event_id ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW), -1) AS filled FROM events
""")
def forward_fill(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "events").select("event_id", "user_id", "ts", F.when(F.col("event_type") == "signup", F.col("value")).alias("filled"))
    return ordering.forward_fill(rows, "filled", ["user_id"], ["ts", "event_id"], F.lit(-1.0)).select("event_id", "filled")


@query(f"""
WITH c AS (SELECT user_id, ts, event_id, event_type <> 'view' AS timed FROM events),
p AS (SELECT *, max(timed) OVER (PARTITION BY user_id) AS has_timed FROM c), q AS (SELECT * FROM p WHERE timed = has_timed)
SELECT user_id, coalesce(min_by(event_id, (ts, event_id)) FILTER (WHERE ts >= TIMESTAMP '{CLOCK}'), min_by(event_id, (ts, event_id))) AS event_id FROM q GROUP BY user_id
""")
def nearest_future(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The next event after the clock of each user, timed ones first, else the first; by aggregation, without a window."""
    rows = table(spark, sf_dir, "events").select("user_id", F.col("ts").cast("timestamp").alias("ts"), "event_id", (F.col("event_type") != "view").alias("timed"))
    order = F.struct("ts", "event_id")
    after = F.col("ts") >= clock()

    def first(condition):
        return F.min(F.when(condition, order))["event_id"]

    timed = F.col("timed")
    return rows.groupBy("user_id").agg(
        F.when(F.max("timed"), F.coalesce(first(timed & after), first(timed))).otherwise(F.coalesce(first(after), first(F.lit(True)))).alias("event_id")
    )


@query("SELECT l_orderkey, l_linenumber, row_number() OVER (PARTITION BY l_orderkey ORDER BY l_shipdate, l_linenumber) AS session_index FROM lineitem")
def session_numbers(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", "l_shipdate")
    return ordering.numbered(lines, ["l_orderkey"], ["l_shipdate", "l_linenumber"]).select("l_orderkey", "l_linenumber", F.col("session_index").cast("bigint").alias("session_index"))


# dates

_MONTHS_SQL = "['Januar','Februar','März','April','Mai','Juni','Juli','August','September','Oktober','November','Dezember']"


@query("""
SELECT o_orderkey, CAST(o_orderdate AS DATE)::VARCHAR AS start_date, CASE WHEN o_orderkey % 2 = 0 THEN strftime((CAST(o_orderdate AS DATE) + INTERVAL (8 + o_orderkey % 12) HOUR) AT TIME ZONE 'Europe/Zurich' AT TIME ZONE 'UTC', '%Y-%m-%d %H:%M') END AS start_at,
  CASE WHEN o_orderkey % 4 = 0 THEN strftime((CAST(o_orderdate AS DATE) + INTERVAL (10 + o_orderkey % 12) HOUR) AT TIME ZONE 'Europe/Zurich' AT TIME ZONE 'UTC', '%Y-%m-%d %H:%M') END AS end_at,
  CASE WHEN o_orderkey % 2 = 0 THEN 'datetime' ELSE 'date' END AS precision
FROM orders
""")
def german_date(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Order dates written out in German, with one, two or no times, and read back."""
    months = [m.capitalize() for m in ("januar", "februar", "märz", "april", "mai", "juni", "juli", "august", "september", "oktober", "november", "dezember")]
    short = ["Jan.", "Feb.", "Mär.", "Apr.", "Mai", "Jun.", "Jul.", "Aug.", "Sept.", "Okt.", "Nov.", "Dez."]
    k, d = F.col("o_orderkey"), F.col("o_orderdate")
    name = F.element_at(F.when(k % 3 == 0, F.array(*map(F.lit, months))).otherwise(F.array(*map(F.lit, short))), F.month(d))
    hour = lambda h: F.concat(((k % 12) + h).cast("string"), F.when(k % 3 == 0, ":00 Uhr").otherwise(".00 Uhr"))
    text = F.concat(
        F.when(k % 5 == 0, "Samstag, ").otherwise(""), F.dayofmonth(d), F.lit(". "), name, F.lit(" "), F.year(d),
        F.when(k % 4 == 0, F.concat(F.lit(", "), hour(8), F.when(k % 3 == 0, " bis ").otherwise(" - "), hour(10))).when(k % 2 == 0, F.concat(F.lit(", "), hour(8))).otherwise(""),
    )
    t = F.col("t")
    at = lambda c: F.date_format(c, "yyyy-MM-dd HH:mm")
    return table(spark, sf_dir, "orders").select("o_orderkey", text.alias("raw")).select("o_orderkey", D.parse_time(F.col("raw")).alias("t")).select("o_orderkey", t["start_date"].cast("string").alias("start_date"), at(t["start_at"]).alias("start_at"), at(t["end_at"]).alias("end_at"), t["precision"].alias("precision"))


def _german(date):
    names = F.array(*[F.lit(m) for m in ("Januar", "Februar", "März", "April", "Mai", "Juni", "Juli", "August", "September", "Oktober", "November", "Dezember")])
    return F.concat(F.dayofmonth(date), F.lit(". "), F.element_at(names, F.month(date)), F.lit(" "), F.year(date))


@query("""
SELECT l_orderkey, l_linenumber, CAST(l_shipdate AS DATE)::VARCHAR AS start_date, CAST(CAST(l_shipdate AS DATE) + l_linenumber AS DATE)::VARCHAR AS end_date,
  CASE WHEN l_linenumber % 2 = 0 THEN strftime((CAST(l_shipdate AS DATE) + INTERVAL 15 HOUR) AT TIME ZONE 'Europe/Zurich' AT TIME ZONE 'UTC', '%Y-%m-%d %H:%M') END AS start_at, 'date_range' AS event_type FROM lineitem
""")
def date_ranges(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Numeric, ISO and German ranges read back, and their type."""
    d, n = F.to_date("l_shipdate"), F.col("l_linenumber")
    e = F.date_add(d, n)
    iso = F.concat(F.date_format(d, "yyyy-MM-dd"), F.lit("T15:00 | "), F.date_format(e, "yyyy-MM-dd"), F.lit("T17:00:00"))
    numeric = F.concat(F.date_format(d, "dd.MM.yyyy"), F.lit(" - "), F.date_format(e, "dd.MM.yyyy"))
    t = F.col("t")
    german = F.concat(_german(d), F.lit(" bis "), _german(e))
    raw = F.when(n % 2 == 0, iso).when(n % 3 == 0, german).otherwise(numeric)
    rows = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", raw.alias("raw")).select("l_orderkey", "l_linenumber", D.parse_time(F.col("raw")).alias("t"))
    return rows.select("l_orderkey", "l_linenumber", t["start_date"].cast("string").alias("start_date"), t["end_date"].cast("string").alias("end_date"), F.date_format(t["start_at"], "yyyy-MM-dd HH:mm").alias("start_at"), D.event_type(t).alias("event_type"))


@query("""
SELECT event_id, CAST(ts AT TIME ZONE 'UTC' AT TIME ZONE 'Europe/Zurich' AS DATE)::VARCHAR AS local_date, dayofweek(CAST(ts AT TIME ZONE 'UTC' AT TIME ZONE 'Europe/Zurich' AS DATE)) AS dow,
  CAST(date_trunc('week', CAST(ts AT TIME ZONE 'UTC' AT TIME ZONE 'Europe/Zurich' AS DATE)) AS DATE)::VARCHAR AS week, strftime(date_trunc('second', ts), '%Y-%m-%d %H:%M:%S') AS iso_utc FROM events
""")
def local_dates(spark: SparkSession, sf_dir: str) -> DataFrame:
    ts = F.col("ts").cast("timestamp")
    local = D.local_date(ts)
    iso = D.iso_timestamp(F.date_format(F.date_trunc("second", ts), "yyyy-MM-dd'T'HH:mm:ss'Z'"))
    return table(spark, sf_dir, "events").select(
        "event_id", local.cast("string").alias("local_date"), D.weekday(local).cast("bigint").alias("dow"), F.to_date(F.date_trunc("week", local)).cast("string").alias("week"), F.date_format(iso, "yyyy-MM-dd HH:mm:ss").alias("iso_utc")
    )


# the feed


@query(FEED_SQL + "SELECT count(*) AS total_rows, count(*) FILTER (WHERE section_key = 'weekend') AS weekend_rows, count(*) FILTER (WHERE section_key = 'coming_up') AS coming_up_rows, count(*) FILTER (WHERE section_key NOT IN ('weekend','coming_up')) AS invalid_section_rows FROM feed")
def feed_q1_sections(spark: SparkSession, sf_dir: str) -> DataFrame:
    s = F.col("section_key")
    return feed(spark, sf_dir).agg(F.count(F.lit(1)).alias("total_rows"), F.count_if(s == "weekend").alias("weekend_rows"), F.count_if(s == "coming_up").alias("coming_up_rows"), F.count_if(~s.isin("weekend", "coming_up")).alias("invalid_section_rows"))


@query(FEED_SQL + "SELECT DISTINCT section_key FROM feed")
def feed_q2_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    return feed(spark, sf_dir).select("section_key").distinct()


@query(FEED_SQL + "SELECT external_id, dayofweek(start_date) AS day_of_week FROM feed WHERE section_key = 'weekend' AND dayofweek(start_date) NOT IN (0, 4, 5, 6)")
def feed_q3a_weekdays(spark: SparkSession, sf_dir: str) -> DataFrame:
    day = D.weekday(F.col("start_date")).cast("bigint")
    return feed(spark, sf_dir).filter((F.col("section_key") == "weekend") & ~day.isin(0, 4, 5, 6)).select("external_id", day.alias("day_of_week"))


@query(FEED_SQL + f"""
, w AS (SELECT CAST(date_trunc('week', DATE '{CLOCK[:10]}') AS DATE) + 3 AS thursday, CAST(date_trunc('week', DATE '{CLOCK[:10]}') AS DATE) + 6 AS sunday)
SELECT external_id, start_date::VARCHAR AS start_date, thursday::VARCHAR AS thursday, sunday::VARCHAR AS sunday FROM feed CROSS JOIN w WHERE section_key = 'coming_up' AND (start_date < thursday OR start_date > sunday)
""")
def feed_q3b_window(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows outside the window of the clock's week: all that are coming up and none of the weekend's."""
    start = D.weekend_start(F.to_date(F.lit(CLOCK[:10])))
    end = F.date_add(start, 3)
    out = feed(spark, sf_dir).filter((F.col("section_key") == "coming_up") & ((F.col("start_date") < start) | (F.col("start_date") > end)))
    return out.select("external_id", F.col("start_date").cast("string").alias("start_date"), start.cast("string").alias("thursday"), end.cast("string").alias("sunday"))


@query(FEED_SQL + "SELECT external_id, date_precision FROM feed WHERE date_precision = 'date' AND start_time_local IS NOT NULL")
def feed_q4_unknown_times(spark: SparkSession, sf_dir: str) -> DataFrame:
    return feed(spark, sf_dir).filter("date_precision = 'date' and start_time_local is not null").select("external_id", "date_precision")


@query(FEED_SQL + "SELECT external_id, start_time_local FROM feed WHERE start_time_local LIKE '00:0%'")
def feed_q5_midnight(spark: SparkSession, sf_dir: str) -> DataFrame:
    return feed(spark, sf_dir).filter("start_time_local like '00:0%'").select("external_id", "start_time_local")


@query(FEED_SQL + f"SELECT external_id FROM feed WHERE is_happening_now AND (end_at IS NULL OR (epoch_us(end_at) - epoch_us(start_at)) / 3.6e9 > 12 OR TIMESTAMP '{CLOCK}' < start_at OR TIMESTAMP '{CLOCK}' > end_at)")
def feed_q6_ongoing_violations(spark: SparkSession, sf_dir: str) -> DataFrame:
    wrong = F.col("end_at").isNull() | (D.duration_hours(F.col("start_at"), F.col("end_at")) > 12) | (clock() < F.col("start_at")) | (clock() > F.col("end_at"))
    return feed(spark, sf_dir).filter(F.col("is_happening_now") & wrong).select("external_id")


@query(FEED_SQL + "SELECT external_id, round((epoch_us(end_at) - epoch_us(start_at)) / 3.6e9, 6) AS hours FROM feed WHERE is_happening_now")
def feed_q7_ongoing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return feed(spark, sf_dir).filter("is_happening_now").select("external_id", F.round(D.duration_hours(F.col("start_at"), F.col("end_at")), 6).alias("hours"))


@query(FEED_SQL + "SELECT count(*) AS total, count(*) FILTER (WHERE title IS NULL OR title = '') AS missing_title, count(*) FILTER (WHERE start_at IS NULL) AS missing_start_at, count(*) FILTER (WHERE series_label IS NOT NULL) AS has_series_label FROM feed")
def feed_q8_inputs(spark: SparkSession, sf_dir: str) -> DataFrame:
    missing = F.coalesce(F.col("title"), F.lit("")) == ""
    return feed(spark, sf_dir).agg(F.count(F.lit(1)).alias("total"), F.count_if(missing).alias("missing_title"), F.count_if(F.col("start_at").isNull()).alias("missing_start_at"), F.count_if(F.col("series_label").isNotNull()).alias("has_series_label"))


@query(FEED_SQL + "SELECT title, location_name, start_date::VARCHAR AS event_date, count(*) AS occurrences FROM feed WHERE series_label IS NULL GROUP BY 1, 2, 3 HAVING count(*) > 1 ORDER BY 4 DESC, 1, 2, 3 LIMIT 10")
def feed_q9_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The ten most repeated cards: a top-k report."""
    found = feed(spark, sf_dir).filter("series_label is null").groupBy("title", "location_name", F.col("start_date").cast("string").alias("event_date")).agg(F.count(F.lit(1)).alias("occurrences"))
    return found.filter("occurrences > 1").orderBy(F.desc("occurrences"), "title", "location_name", "event_date").limit(10)


@query(FEED_SQL + """
SELECT card_key, external_id FROM (SELECT *, row_number() OVER (PARTITION BY card_key ORDER BY start_time_local IS NOT NULL DESC, start_at DESC NULLS LAST, external_id) AS n FROM (
  SELECT *, coalesce('series|' || series_label, concat_ws('|', 'event', title, location_name, start_date::VARCHAR, coalesce(start_time_local, ''))) AS card_key FROM feed)) WHERE n = 1
""")
def feed_cards(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ordering.cards(feed(spark, sf_dir).withColumn("updated_at", F.col("start_at"))).select("card_key", "external_id")


@query(FEED_SQL + f"""
SELECT external_id, CASE WHEN is_happening_now THEN 'Laufend · Bis ' || strftime(CAST(end_at AT TIME ZONE 'UTC' AT TIME ZONE 'Europe/Zurich' AS TIMESTAMP), '%H:%M') || ' Uhr' ELSE
  (CASE WHEN start_date = DATE '{CLOCK[:10]}' THEN 'Heute' WHEN start_date = DATE '{CLOCK[:10]}' + 1 THEN 'Morgen' ELSE ['Montag','Dienstag','Mittwoch','Donnerstag','Freitag','Samstag','Sonntag'][isodow(start_date)] || ' ' || day(start_date) || ' ' ||
    ['Jan.','Feb.','März','Apr.','Mai','Juni','Juli','Aug.','Sept.','Okt.','Nov.','Dez.'][month(start_date)] END) || CASE WHEN date_precision = 'datetime' THEN ' · ' || strftime(start_local, '%H:%M') || ' Uhr' ELSE '' END END AS pill FROM feed
""")
def feed_pills(spark: SparkSession, sf_dir: str) -> DataFrame:
    pill = D.time_pill(F.col("start_date"), F.col("start_at"), F.col("end_at"), F.col("date_precision"), clock())
    return feed(spark, sf_dir).select("external_id", pill.alias("pill"))


# contracts and eligibility

_STAGED = """WITH s AS (SELECT o_orderkey AS id, ['date','datetime','unknown',NULL][1 + o_orderkey % 4] AS date_precision, CASE WHEN o_orderkey % 3 > 0 THEN o_orderdate END AS start_at,
  CASE WHEN o_orderkey % 6 = 1 THEN o_orderdate END AS end_at, CASE WHEN o_orderkey % 5 > 0 THEN CAST(o_orderdate AS DATE) END AS start_date_local, CASE WHEN o_orderkey % 2 = 0 THEN 'pending' ELSE 'processed' END AS status,
  ['A','B','D'][1 + o_orderkey % 3] AS source_tier, CASE WHEN o_orderkey % 7 > 0 THEN o_orderpriority END AS title, CASE WHEN o_orderkey % 11 > 0 THEN 'hall' ELSE '' END AS location, o_orderkey % 22 = 0 AS online, o_orderkey % 13 AS age_max FROM orders)
"""


def _staged(spark: SparkSession, sf_dir: str) -> DataFrame:
    k, d = F.col("o_orderkey"), F.col("o_orderdate").cast("timestamp")
    pick = lambda values, n: F.get(F.array(*[F.lit(v).cast("string") for v in values]), (k % n).cast("int"))
    return table(spark, sf_dir, "orders").select(
        k.alias("id"), pick(["date", "datetime", "unknown", None], 4).alias("date_precision"), F.when(k % 3 > 0, d).alias("start_at"), F.when(k % 6 == 1, d).alias("end_at"), F.when(k % 5 > 0, F.to_date("o_orderdate")).alias("start_date_local"),
        F.when(k % 2 == 0, "pending").otherwise("processed").alias("status"), pick(["A", "B", "D"], 3).alias("source_tier"), F.when(k % 7 > 0, F.col("o_orderpriority")).alias("title"),
        F.when(k % 11 > 0, "hall").otherwise("").alias("location"), (k % 22 == 0).alias("online"), (k % 13).alias("age_max"),
    )


@query(_STAGED + """
SELECT id, concat_ws(',', CASE WHEN coalesce(NOT ((date_precision = 'date' AND start_at IS NULL AND end_at IS NULL) OR (date_precision = 'datetime' AND start_at IS NOT NULL)), false) THEN 'time_contract' END,
  CASE WHEN coalesce(NOT (date_precision IS NULL OR status <> 'pending' OR start_date_local IS NOT NULL), false) THEN 'local_date' END,
  CASE WHEN coalesce(source_tier NOT IN ('A','B','C'), false) THEN 'domain_source_tier' END, CASE WHEN coalesce(date_precision NOT IN ('date','datetime'), false) THEN 'domain_date_precision' END) AS violations FROM s
""")
def contract_violations(spark: SparkSession, sf_dir: str) -> DataFrame:
    staged = _staged(spark, sf_dir).select("id", "date_precision", "start_at", "end_at", "start_date_local", "status", "source_tier")
    return contracts.with_violations(staged).select("id", F.array_join("violations", ",").alias("violations"))


@query(_STAGED + """
SELECT id, concat_ws(',', CASE WHEN coalesce(trim(title), '') = '' THEN 'missing_title' END, CASE WHEN start_date_local IS NULL AND NOT coalesce(date_precision = 'datetime' AND start_at IS NOT NULL, false) THEN 'missing_start' END,
  CASE WHEN location = '' AND NOT online THEN 'missing_location' END, CASE WHEN coalesce(NOT ((date_precision = 'date' AND start_at IS NULL AND end_at IS NULL) OR (date_precision = 'datetime' AND start_at IS NOT NULL)), false) THEN 'time_contract' END,
  CASE WHEN age_max < 1 THEN 'newborn_only' END) AS reasons FROM s
""")
def eligibility_reasons(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _staged(spark, sf_dir).select("id", F.array_join(contracts.eligibility_reasons(), ",").alias("reasons"))


@query("SELECT l_partkey, l_suppkey, count(*) AS rows FROM lineitem GROUP BY ALL HAVING count(*) > 1")
def unique_violations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return contracts.repeated_keys(table(spark, sf_dir, "lineitem"), ["l_partkey", "l_suppkey"])


@query("SELECT c_custkey FROM customer WHERE c_custkey NOT IN (SELECT o_custkey FROM orders)")
def orphan_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    return contracts.orphans(table(spark, sf_dir, "customer").select("c_custkey"), "c_custkey", table(spark, sf_dir, "orders"), "o_custkey")


# sync, bridge, merge, ledger

_EVENTS_SQL = """WITH ev AS (SELECT o_orderkey AS id, CASE WHEN o_custkey % 9 = 0 THEN 'maennedorf_portal' WHEN o_custkey % 50 > 0 THEN 's' || (o_custkey % 9) END AS source_id, CASE WHEN o_orderkey % 3 > 0 THEN 'x' || o_orderkey END AS external_id,
  o_orderpriority AS title, CASE WHEN o_orderkey % 4 > 0 THEN o_orderdate + INTERVAL 20 HOUR END AS start_at, CASE WHEN o_orderkey % 8 = 0 THEN '3. Mai 2024' END AS datetime_raw, CASE WHEN o_orderkey % 5 = 0 THEN 'date' WHEN o_orderkey % 5 = 1 THEN 'datetime' END AS date_precision, o_orderstatus AS location_name FROM orders),
sh AS (SELECT *, coalesce(CAST(start_at AT TIME ZONE 'UTC' AT TIME ZONE 'Europe/Zurich' AS DATE), CASE WHEN datetime_raw IS NOT NULL THEN DATE '2024-05-03' END) AS d, coalesce(date_precision, 'datetime') AS p FROM ev)
"""


def _staging(spark: SparkSession, sf_dir: str) -> DataFrame:
    k, c = F.col("o_orderkey"), F.col("o_custkey")
    none = F.lit(None).cast("string")
    return table(spark, sf_dir, "orders").select(
        k.alias("id"), F.when(c % 9 == 0, "maennedorf_portal").when(c % 50 > 0, F.concat(F.lit("s"), c % 9)).alias("source_id"), F.when(k % 3 > 0, F.concat(F.lit("x"), k)).alias("external_id"), F.col("o_orderpriority").alias("title"),
        F.when(k % 4 > 0, F.col("o_orderdate").cast("timestamp") + F.expr("interval 20 hours")).alias("start_at"), F.lit(None).cast("timestamp").alias("end_at"), F.when(k % 8 == 0, "3. Mai 2024").alias("datetime_raw"),
        F.when(k % 5 == 0, "date").when(k % 5 == 1, "datetime").alias("date_precision"), F.col("o_orderstatus").alias("location_name"), none.alias("description"), none.alias("timezone"), none.alias("canonical_url"), none.alias("content_hash"),
        F.lit(CLOCK).cast("timestamp").alias("last_seen_at"),
    )


@query(_EVENTS_SQL + r"""
SELECT coalesce(external_id, 'events:' || id) AS external_id, CASE WHEN source_id = 'maennedorf_portal' THEN 'B' ELSE 'A' END AS source_tier, d::VARCHAR AS start_date_local, p AS date_precision,
  CASE WHEN p <> 'date' THEN strftime(start_at, '%Y-%m-%d %H:%M') END AS start_at, CASE WHEN d IS NULL OR (p <> 'date' AND start_at IS NULL) THEN 'needs_review' ELSE 'pending' END AS status,
  substr(sha256(concat_ws('|', nullif(regexp_replace(lower(title), '[^\pL\pN_\s]', '', 'g'), ''), d::VARCHAR, lower(location_name))), 1, 32) AS dedupe_key FROM sh
""")
def sync_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = sync.source_happenings(_staging(spark, sf_dir))
    return rows.select("external_id", "source_tier", F.col("start_date_local").cast("string").alias("start_date_local"), "date_precision", F.date_format("start_at", "yyyy-MM-dd HH:mm").alias("start_at"), "status", "dedupe_key")


@query(_EVENTS_SQL + "SELECT count(*) AS events_seen, count(source_id) AS upserted, count(*) FILTER (WHERE d IS NULL OR (p <> 'date' AND start_at IS NULL)) AS needs_review, count(*) - count(source_id) AS errors FROM sh")
def sync_counters(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sync.sync_counters(sync.source_happenings(_staging(spark, sf_dir)))


@query("""
WITH b AS (SELECT o_orderkey, o_orderpriority, o_orderdate, 'src:happening:' || substr(sha1('src:happening:' || o_orderkey), 1, 24) AS h, 'src:offering:' || substr(sha1('src:offering:' || o_orderkey || ':default'), 1, 24) AS o,
  'src:occ:' || substr(sha1('src:occ:' || o_orderkey || ':' || strftime(o_orderdate, '%Y-%m-%dT%H:%M:%S')), 1, 24) AS c FROM orders)
SELECT h AS happening_id, o AS offering_id, c AS occurrence_id, o_orderpriority AS title, CAST(o_orderdate AT TIME ZONE 'UTC' AT TIME ZONE 'Europe/Zurich' AS DATE)::VARCHAR AS start_date FROM b
""")
def bridge(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The three canonical tables, joined again by the ids they share."""
    events = table(spark, sf_dir, "orders").select(F.col("o_orderkey").cast("string").alias("external_id"), F.col("o_orderpriority").alias("title"), F.col("o_orderdate").cast("timestamp").alias("start_at"), F.lit(None).cast("timestamp").alias("end_at"))
    h, o, c = sync.bridged(events, "src", clock())
    joined = h.select(F.col("public_id").alias("happening_id"), "title").join(o.select(F.col("public_id").alias("offering_id"), "happening_id", "start_date"), "happening_id").join(c.select(F.col("public_id").alias("occurrence_id"), "offering_id"), "offering_id")
    return joined.select("happening_id", "offering_id", "occurrence_id", "title", F.col("start_date").cast("string").alias("start_date"))


_TIERS = """WITH r AS (SELECT c_nationkey AS h, 'crawler' AS kind, 10 AS rk, c_custkey AS id, c_name AS name, c_mktsegment AS segment FROM customer
UNION ALL SELECT s_nationkey, 'partner_feed', 100, 1000000 + s_suppkey, CASE WHEN s_suppkey % 3 > 0 THEN s_name END, NULL FROM supplier),
u AS (SELECT h, rk, id, 'name' AS field_name, name AS value FROM r UNION ALL SELECT h, rk, id, 'segment', segment FROM r),
w AS (SELECT *, row_number() OVER (PARTITION BY h, field_name ORDER BY rk DESC, id) AS n FROM u WHERE coalesce(trim(value), '') <> '')
"""


def _tiers(spark: SparkSession, sf_dir: str) -> DataFrame:
    a = table(spark, sf_dir, "customer").select(F.col("c_nationkey").alias("happening"), F.lit("crawler").alias("kind"), F.col("c_custkey").alias("row_id"), F.col("c_name").alias("name"), F.col("c_mktsegment").alias("segment"))
    b = table(spark, sf_dir, "supplier").select(F.col("s_nationkey").alias("happening"), F.lit("partner_feed").alias("kind"), (F.col("s_suppkey") + 1_000_000).alias("row_id"), F.when(F.col("s_suppkey") % 3 > 0, F.col("s_name")).alias("name"), F.lit(None).cast("string").alias("segment"))
    rows = a.unionByName(b).withColumn("rank", merging.rank(F.col("kind"))).withColumn("fetched_at", F.lit(CLOCK).cast("timestamp"))
    return merging.winners(rows, "happening", ["name", "segment"], "rank", "fetched_at", "row_id")


@query(_TIERS + "SELECT h AS happening, max(CASE WHEN field_name = 'name' THEN value END) AS name, max(CASE WHEN field_name = 'segment' THEN value END) AS segment FROM w WHERE n = 1 GROUP BY h")
def precedence_merge(spark: SparkSession, sf_dir: str) -> DataFrame:
    return merging.merged(_tiers(spark, sf_dir), "happening", ["name", "segment"])


@query(_TIERS + "SELECT h AS happening_id, id AS source_happening_id, field_name, sha256(value) AS value_hash, rk AS precedence_rank FROM w WHERE n = 1")
def field_provenance(spark: SparkSession, sf_dir: str) -> DataFrame:
    return merging.provenance(_tiers(spark, sf_dir), "happening", "row_id")


@query("""
WITH a AS (SELECT DISTINCT user_id FROM events WHERE ts < TIMESTAMP '2024-01-02'), b AS (SELECT DISTINCT user_id FROM events WHERE ts >= TIMESTAMP '2024-01-02' AND ts < TIMESTAMP '2024-01-03')
SELECT user_id, 'new' AS change FROM (FROM b EXCEPT FROM a) UNION ALL SELECT user_id, 'gone' FROM (FROM a EXCEPT FROM b)
""")
def ledger_new_gone(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = table(spark, sf_dir, "events").select("user_id", F.to_date("ts").alias("d"))
    return sinks.ledger_changes(events.filter("d = date '2024-01-01'"), events.filter("d = date '2024-01-02'"), "user_id")


@query("""
WITH t AS (SELECT c_custkey AS k, c_acctbal AS v FROM customer), s AS (SELECT o_custkey AS k, max_by(o_totalprice, (o_orderdate, o_orderkey)) AS v FROM orders GROUP BY 1)
SELECT k, v FROM t WHERE k NOT IN (SELECT k FROM s) UNION ALL SELECT k, v FROM s
""")
def upsert_latest(spark: SparkSession, sf_dir: str) -> DataFrame:
    target = table(spark, sf_dir, "customer").select(F.col("c_custkey").alias("k"), F.col("c_acctbal").alias("v"))
    rows = table(spark, sf_dir, "orders").select(F.col("o_custkey").alias("k"), F.col("o_totalprice").alias("v"), "o_orderdate", "o_orderkey")
    return sinks.upserted(target, rows, ["k"], [F.desc("o_orderdate"), F.desc("o_orderkey")]).select("k", "v")


@query("""
SELECT DISTINCT user_id AS id, 'registry' AS missing_in FROM events WHERE user_id NOT IN (SELECT c_custkey FROM customer) UNION ALL SELECT c_custkey, 'config' FROM customer WHERE c_custkey NOT IN (SELECT user_id FROM events)
""")
def registry_difference(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sync.registry_difference(table(spark, sf_dir, "events").select(F.col("user_id").alias("id")), table(spark, sf_dir, "customer").select(F.col("c_custkey").alias("id")), "id")


@query("""
WITH d AS (SELECT l_orderkey AS k, min(struct_pack(n := l_linenumber, v := l_returnflag)).v AS flag, min(struct_pack(n := l_linenumber, v := l_linestatus)).v AS state FROM lineitem GROUP BY 1)
SELECT o_orderkey, coalesce(CASE WHEN o_orderkey % 3 > 0 THEN o_orderpriority END, flag) AS label, state FROM orders LEFT JOIN d ON o_orderkey = k
""")
def detail_enrichment(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders with what their first line says."""
    items = table(spark, sf_dir, "orders").select("o_orderkey", F.col("o_orderkey").alias("key"), F.when(F.col("o_orderkey") % 3 > 0, F.col("o_orderpriority")).alias("label"))
    details = table(spark, sf_dir, "lineitem").select(F.col("l_orderkey").alias("key"), "l_linenumber", F.col("l_returnflag").alias("label"), F.col("l_linestatus").alias("state"))
    return sync.enriched(items, details, "key", ["label"], ["state"], ["l_linenumber"]).select("o_orderkey", "label", "state")


@query("""
WITH r AS (SELECT c_nationkey AS n, count(*) AS raw_rows FROM customer GROUP BY 1), c AS (SELECT c_nationkey AS n, count(*) AS canonical_rows, count(*) FILTER (WHERE o_totalprice > 100000) AS eligible_rows FROM orders JOIN customer ON o_custkey = c_custkey GROUP BY 1)
SELECT n_name AS organizer, coalesce(raw_rows, 0) AS raw_rows, coalesce(canonical_rows, 0) AS canonical_rows, coalesce(eligible_rows, 0) AS eligible_rows FROM nation LEFT JOIN r ON n_nationkey = r.n LEFT JOIN c ON n_nationkey = c.n
""")
def coverage_funnel(spark: SparkSession, sf_dir: str) -> DataFrame:
    customers = table(spark, sf_dir, "customer").select("c_custkey", F.col("c_nationkey").alias("organizer_id"))
    canonical = table(spark, sf_dir, "orders").join(customers, F.col("o_custkey") == F.col("c_custkey")).select("organizer_id", (F.col("o_totalprice") > 100000).alias("eligible"))
    nations = table(spark, sf_dir, "nation").select(F.col("n_nationkey").alias("organizer_id"), F.col("n_name").alias("organizer"))
    return sync.coverage(nations, customers, canonical).drop("organizer_id")


_RUNS_SQL = """
SELECT {0} AS source_id, count(*) AS surfaces_attempted, count(*) FILTER (WHERE value >= 10) AS surfaces_succeeded, CAST(sum(CASE WHEN user_id % 4 = 0 THEN event_id % 3 ELSE 0 END) AS BIGINT) AS dom_items_visible, count(*) FILTER (WHERE user_id % 4 > 0) AS detail_urls_found,
  count(*) FILTER (WHERE user_id % 4 > 0 AND value >= 10) AS detail_urls_fetched, CAST(sum(CASE WHEN user_id % 4 > 0 THEN event_id % 3 ELSE 0 END) AS BIGINT) AS items_extracted, count(*) FILTER (WHERE value < 5) AS items_failed, count(*) FILTER (WHERE event_id % 11 = 0) AS items_skipped,
  bool_or(event_id % 5000 = 0) AS circuit_breaker_triggered FROM events GROUP BY 1
"""


def _surfaces(spark: SparkSession, sf_dir: str, source) -> DataFrame:
    return table(spark, sf_dir, "events").select(
        source.alias("source_id"), F.when(F.col("user_id") % 4 > 0, "detail").otherwise("listing").alias("kind"), (F.col("value") >= 10).alias("ok"), (F.col("event_id") % 3).alias("items"), (F.col("value") < 5).cast("int").alias("failed"),
        (F.col("event_id") % 11 == 0).cast("int").alias("skipped"), (F.col("event_id") % 5000 == 0).alias("breaker_open"),
    )


@query(_RUNS_SQL.format("event_type"))
def run_metrics(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sync.run_metrics(_surfaces(spark, sf_dir, F.col("event_type")))


@query(f"""
WITH m AS ({_RUNS_SQL.format("user_id % 30")}), s AS (SELECT DISTINCT l_suppkey % 40 AS id FROM lineitem),
x AS (SELECT id, 's' || id AS source_id, CASE WHEN id % 7 = 0 THEN 'timeout' END AS error_message, m.* EXCLUDE (source_id) FROM s LEFT JOIN m ON s.id = m.source_id)
SELECT substr(sha256(source_id || '|2024-01-17 12:00:00'), 1, 32) AS id, source_id, CASE WHEN error_message IS NULL THEN 'success' ELSE 'failed' END AS status, coalesce(surfaces_attempted, 0) AS surfaces_attempted, coalesce(surfaces_succeeded, 0) AS surfaces_succeeded,
  coalesce(dom_items_visible, 0) AS dom_items_visible, coalesce(detail_urls_found, 0) AS detail_urls_found, coalesce(detail_urls_fetched, 0) AS detail_urls_fetched, coalesce(items_extracted, 0) AS items_extracted, coalesce(items_failed, 0) AS items_failed,
  coalesce(items_skipped, 0) AS items_skipped, coalesce(circuit_breaker_triggered, false) AS circuit_breaker_triggered, error_message FROM x
""")
def run_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Runs opened for every source and closed with nine metrics and the source's error."""
    sources = table(spark, sf_dir, "lineitem").select((F.col("l_suppkey") % 40).alias("id")).distinct().select("id", F.concat(F.lit("s"), F.col("id").cast("string")).alias("source_id"))
    errors = sources.filter("id % 7 = 0").select("source_id", F.lit("timeout").alias("error_message"))
    surfaces = _surfaces(spark, sf_dir, F.concat(F.lit("s"), (F.col("user_id") % 30).cast("string")))
    closed = sync.close_runs(sync.open_runs(sources, clock()), surfaces, clock(), errors)
    return closed.drop("started_at", "finished_at")


@query("""
SELECT c_mktsegment AS source_tier, count(*) AS rows, count(*) FILTER (WHERE c_nationkey % 5 = 0) AS missing_title, count(*) FILTER (WHERE c_acctbal < 0) AS missing_location, round(100.0 * count(*) / (SELECT count(*) FROM customer), 6)::DOUBLE AS percentage FROM customer GROUP BY 1
""")
def coverage_gaps(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows, shares and missing fields by tier."""
    rows = table(spark, sf_dir, "customer").select(F.col("c_mktsegment").alias("source_tier"), F.when(F.col("c_nationkey") % 5 > 0, F.col("c_name")).otherwise(" ").alias("title"), F.when(F.col("c_acctbal") >= 0, F.col("c_name")).alias("location"))
    return sync.gaps(rows, ["title", "location"]).withColumn("percentage", F.round("percentage", 6))


@query("SELECT event_id, CAST(json_extract(props, '$.k') AS DOUBLE) AS k, NULL::VARCHAR AS k_text, CAST(json_extract(props, '$.k') AS INT) AS k_whole FROM events")
def extra_typed(spark: SparkSession, sf_dir: str) -> DataFrame:
    v = R.variant(F.col("props"))
    return table(spark, sf_dir, "events").select("event_id", R.number_field(v, "$.k").alias("k"), R.text_field(v, "$.k").alias("k_text"), R.whole_field(v, "$.k").alias("k_whole"))
