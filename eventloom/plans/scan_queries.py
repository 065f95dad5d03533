"""Queries that write records of a table as documents, scan these, and must find what the table holds."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import dates as D
from ..functions import page as P
from ..functions import records as R
from ..functions import text as T
from ..operators import contracts, merging, ordering, sync
from ..sources import platforms, registry
from ..sources.dom import read
from .queries import clock, table
from .registry import query


def _documents(df: DataFrame, key: str, html: Column, url: Column | None = None) -> DataFrame:
    """One captured document a row; the key is its source."""
    return df.select(F.col(key).cast("string").alias("source_id"), F.lit(0).alias("page"), (url if url is not None else F.lit("https://x.ch/list")).alias("url"), html.alias("html"))


@query(r"""
SELECT page_id, trim(replace(replace(regexp_replace(regexp_extract(html, '<h1>(.*?)</h1>', 1), '&amp;?', '&', 'g'), '&quot;', '"'), '&quot', '"')) AS title,
  len(regexp_extract_all(html, '<a href="')) AS links, 0::BIGINT AS pdfs, 0::BIGINT AS external_links FROM pages
""")
def detail_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Titles, links and other surfaces of captured pages, each parsed once."""
    pages = table(spark, sf_dir, "pages").select("page_id", "url", read(F.col("html")).alias("p"))
    s = P.surfaces(F.col("p"), F.col("url"))
    return pages.select("page_id", P.title(F.col("p")).alias("title"), F.size("p.links").cast("bigint").alias("links"), s["pdf_count"].cast("bigint").alias("pdfs"), s["external_link_count"].cast("bigint").alias("external_links"))


@query("""
SELECT c_custkey::VARCHAR AS source_id, 'https://x.ch/' || c_custkey AS item_url, c_name AS title_raw, strftime(DATE '2026-01-01' + CAST(c_custkey % 300 AS INT), '%Y-%m-%d') || 'T09:30:00' AS datetime_raw,
  'Pilz, Seestr. ' || (c_custkey % 90) || ', ' || c_mktsegment AS location_raw FROM customer WHERE c_custkey % 7 > 0
""")
def rss_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    k, day = F.col("c_custkey"), F.date_add(F.lit("2026-01-01").cast("date"), (F.col("c_custkey") % 300).cast("int"))
    body = F.concat(F.date_format(day, "dd/MM/yyyy"), F.lit(" - 09:30 - 11:00 &lt;br /&gt;Pilz &lt;br /&gt;Seestr. "), k % 90, F.lit(" &lt;br /&gt;"), F.col("c_mktsegment"))
    item = F.concat(F.lit("<item><title>"), F.col("c_name"), F.lit("</title><link>https://x.ch/"), k, F.lit("</link><description>"), F.when(k % 7 == 0, "soon").otherwise(body), F.lit("</description></item>"))
    found = platforms.rss(_documents(table(spark, sf_dir, "customer"), "c_custkey", F.concat(F.lit("<rss><channel>"), item, F.lit("</channel></rss>"))))
    return found.select("source_id", "item_url", "title_raw", "datetime_raw", "location_raw")


@query("""
SELECT o_orderkey::VARCHAR AS source_id, o_orderpriority || ', mit Zusatz' AS title_raw, CASE o_orderkey % 3 WHEN 0 THEN 'include' WHEN 1 THEN 'review' ELSE 'exclude' END AS relevance,
  CASE WHEN o_orderkey % 2 = 0 THEN strftime(o_orderdate + INTERVAL 14 HOUR, '%Y-%m-%d %H:%M') ELSE strftime((CAST(o_orderdate AS DATE) + INTERVAL 14 HOUR) AT TIME ZONE 'Europe/Zurich' AT TIME ZONE 'UTC', '%Y-%m-%d %H:%M') END AS start_at,
  'Amt ' || o_custkey AS organizer, 'a' || o_custkey || '@b.ch' AS email FROM orders
""")
def ics_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    k, d = F.col("o_orderkey"), F.col("o_orderdate").cast("timestamp")
    category = F.when(k % 3 == 0, "Familien: ").when(k % 3 == 1, "Kulturelles: ").otherwise("Senioren: ")
    start = F.when(k % 2 == 0, F.concat(F.lit("DTSTART:"), F.date_format(d + F.expr("interval 14 hours"), "yyyyMMdd'T'HHmmss'Z'"))).otherwise(F.concat(F.lit("DTSTART;TZID=Europe/Zurich:"), F.date_format(d, "yyyyMMdd'T140000'")))
    ics = F.concat(
        F.lit("BEGIN:VTIMEZONE\r\nDTSTART:19700329T020000\r\nEND:VTIMEZONE\r\nBEGIN:VEVENT\r\n"), start, F.lit("\r\nSUMMARY:"), category, F.col("o_orderpriority"), F.lit("\\, mit\r\n  Zusatz\r\nORGANIZER;CN=\"Amt "), F.col("o_custkey"),
        F.lit("\":mailto:a"), F.col("o_custkey"), F.lit("@b.ch\r\nEND:VEVENT\r\n"),
    )
    found = platforms.ics(_documents(table(spark, sf_dir, "orders"), "o_orderkey", ics))
    return found.select("source_id", "title_raw", "relevance", F.date_format("start.start_at", "yyyy-MM-dd HH:mm").alias("start_at"), F.col("organizer.name").alias("organizer"), F.col("organizer.email").alias("email"))


@query("""
SELECT c_custkey::VARCHAR AS source_id, 'https://x.ch/_rte/anlass/' || (c_custkey + 1000 * i) AS item_url, (c_nationkey + i) % 3 = 0 AS relevant FROM customer, (SELECT unnest([1, 2, 3]) AS i)
""")
def icms_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Listings whose entries stand in a JSON attribute, three a page."""

    def entry(i: int) -> Column:
        kind = F.when((F.col("c_nationkey") + i) % 3 == 0, "7, 18").otherwise("7")
        return F.concat(F.lit("{&quot;name&quot;:&quot;&lt;a href=\\&quot;/_rte/anlass/"), F.col("c_custkey") + 1000 * i, F.lit("?x=1\\&quot;&gt;A&lt;/a&gt;&quot;,&quot;_hauptkategorieId&quot;:&quot;"), kind, F.lit("&quot;}"))

    html = F.concat(F.lit('<table data-entities="{&quot;data&quot;:['), F.concat_ws(",", entry(1), entry(2), entry(3)), F.lit(']}"></table>'))
    return platforms.icms(_documents(table(spark, sf_dir, "customer"), "c_custkey", html)).select("source_id", "item_url", "relevant")


@query("""
SELECT s_suppkey::VARCHAR AS source_id, 'https://x.ch/veranstaltung/' || (s_suppkey + 10 * i) AS item_url, 'T' || i AS title_raw FROM supplier, (SELECT unnest([1, 2]) AS i)
""")
def link_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Listing links of one class and grammar, with repeats and others that don't count."""
    link = lambda i: F.concat(F.lit('<a class="x agendaTitel" href="/veranstaltung/'), F.col("s_suppkey") + 10 * i, F.lit(f'?b#c">T{i}</a>'))
    html = F.concat(F.lit('<a href="/veranstaltung/9">no</a>'), link(1), link(1), link(2), F.lit('<a class="agendaTitel" href="/andere/1">no</a>'))
    return platforms.kirchenweb(_documents(table(spark, sf_dir, "supplier"), "s_suppkey", html)).select("source_id", "item_url", "title_raw")


@query("""
SELECT s_suppkey::VARCHAR AS source_id, 'F' || i AS title_raw, strftime(DATE '2026-01-01' + CAST(s_suppkey % 200 + CASE WHEN i = 3 THEN 1 ELSE 0 END AS INT), '%Y-%m-%d') || 'T1' || i || ':00' AS datetime_raw FROM supplier, (SELECT unnest([1, 2, 3]) AS i)
""")
def agenda_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Agenda tables in which only the first row of a day names it."""
    day = lambda n: F.date_format(F.date_add(F.lit("2026-01-01").cast("date"), (F.col("s_suppkey") % 200).cast("int") + n), "yyyy-MM-dd")

    def row(i: int, named: Column | None) -> Column:
        head = F.concat(F.lit("<th class=agenda__day><time datetime="), named, F.lit(">d</time></th>")) if named is not None else F.lit("")
        return F.concat(F.lit("<tr class=row--result>"), head, F.lit(f'<td><time class=agenda__time datetime=1{i}:00>t</time><a class=agenda__event href="/agenda/x-'), F.col("s_suppkey") * 10 + i, F.lit(f'/"><h1 class=agenda__event-title>F{i}</h1></a></td></tr>'))

    html = F.concat(F.lit("<table>"), row(1, day(0)), row(2, None), row(3, day(1)), row(1, None), F.lit("</table>"))
    return platforms.forum(_documents(table(spark, sf_dir, "supplier"), "s_suppkey", html)).select("source_id", "title_raw", "datetime_raw")


@query("""
SELECT l_orderkey, l_linenumber, CASE WHEN l_linenumber = 1 THEN 'free' WHEN l_linenumber = 2 THEN 'donation' ELSE 'paid' END AS price_type, CASE WHEN l_linenumber > 2 THEN round(floor(l_extendedprice) + 0.5, 2) END AS price,
  CAST(l_quantity AS INT) AS age_min, CASE WHEN l_linenumber % 2 = 0 THEN CAST(l_quantity AS INT) + 3 END AS age_max FROM lineitem
""")
def price_age_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Prices and ages written as text and read back."""
    n, q = F.col("l_linenumber"), F.col("l_quantity").cast("int")
    amount = F.concat(F.lit("CHF "), F.floor("l_extendedprice").cast("string"), F.when(n % 2 == 0, ".50").otherwise(",50"))
    price = T.price(F.when(n == 1, "Der Eintritt frei für alle").when(n == 2, "Kollekte").otherwise(amount))
    age = T.age(F.when(n % 2 == 0, F.concat(q.cast("string"), F.lit(" bis "), (q + 3).cast("string"), F.lit(" Jahre"))).otherwise(F.concat(F.lit("Kinder ab "), q.cast("string"))))
    return table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", price["price_type"].alias("price_type"), price["price_from_chf"].alias("price"), age["age_min"].alias("age_min"), age["age_max"].alias("age_max"))


@query("""
SELECT o_orderkey, strftime(o_orderdate, '%Y-%m-%dT%H:%M') || CASE WHEN o_orderkey % 2 = 0 THEN ' | ' || strftime(o_orderdate, '%Y-%m-%dT23:00') ELSE '' END AS raw, CASE WHEN o_custkey % 5 = 0 THEN 'free' ELSE 'paid' END AS price_type, 'Verein ' || o_custkey AS organizer FROM orders
""")
def jsonld_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """JSON-LD in its shapes: an object, a list, a graph, types as lists."""
    k, at = F.col("o_orderkey"), F.date_format("o_orderdate", "yyyy-MM-dd'T'HH:mm")
    end = F.when(k % 2 == 0, F.concat(F.lit(',"endDate":"'), F.date_format("o_orderdate", "yyyy-MM-dd'T'23:00"), F.lit('"'))).otherwise("")
    event = F.concat(F.lit('{"@type":'), F.when(k % 5 == 0, '["Thing","Event"]').otherwise('"Event"'), F.lit(',"startDate":"'), at, F.lit('"'), end, F.lit(',"organizer":{"name":"Verein '), F.col("o_custkey"), F.lit('"},"offers":[{"price":"x"},{"price":'), F.col("o_custkey") % 5, F.lit("}]}"))
    doc = F.when(k % 3 == 0, F.concat(F.lit('[{"@type":"WebPage"},'), event, F.lit("]"))).when(k % 3 == 1, F.concat(F.lit('{"@graph":['), event, F.lit("]}"))).otherwise(event)
    rows = table(spark, sf_dir, "orders").select("o_orderkey", doc.alias("doc"))
    return rows.select("o_orderkey", R.event_time(F.col("doc")).alias("raw"), R.event_price(F.col("doc"))["price_type"].alias("price_type"), P.first_of(R.events(F.col("doc")), lambda e: R.named(e, "$.organizer")).alias("organizer"))


@query("""
SELECT event_id, CASE event_id % 6 WHEN 0 THEN 'n' || user_id WHEN 1 THEN 'z' || user_id WHEN 2 THEN 'b' || user_id WHEN 3 THEN 'a' || user_id WHEN 4 THEN 'p' || user_id END AS organizer, CASE WHEN event_id % 2 = 0 THEN 'kids,music' ELSE 'music' END AS topics FROM events
""")
def organizer_topics(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Organizers in their shapes, and topics by keyword."""
    k, u = F.col("event_id"), F.col("user_id")
    named = lambda key, mark: F.concat(F.lit(f'"{key}":'), F.lit('{"name":" '), F.lit(mark), u, F.lit('"}'))
    flat = lambda key, mark: F.concat(F.lit(f'"{key}":"{mark}'), u, F.lit('"'))
    organizer = F.when(k % 6 == 0, named("organiser", "n")).when(k % 6 == 1, named("organizer", "z")).when(k % 6 == 2, flat("organiser_name", "b")).when(k % 6 == 3, flat("organizer_name", "a")).when(k % 6 == 4, flat("organiser", "p")).otherwise(F.lit('"organizer":7'))
    extra = R.variant(F.concat(F.lit("{"), organizer, F.when(k % 2 == 0, ',"category_raw":"Für KINDER"').otherwise(""), F.lit(',"categories":["Musik"]}')))
    return table(spark, sf_dir, "events").select("event_id", R.organizer_name(extra).alias("organizer"), F.array_join(R.topic_tags(extra, {"kids": "kinder", "music": "musik", "art": "kunst"}), ",").alias("topics"))


@query("SELECT source_id, max_items, municipality, enabled FROM (VALUES " + ", ".join(f"('{s.source_id}', {s.max_items}, {repr(s.municipality) if s.municipality else 'NULL'}, {str(s.enabled).lower()})" for s in registry.SOURCES) + ") t(source_id, max_items, municipality, enabled)")
def source_list(spark: SparkSession, sf_dir: str) -> DataFrame:
    registry.validated()
    return registry.table(spark).select("source_id", "max_items", "municipality", "enabled")


@query("""
WITH src AS (SELECT n_nationkey AS id FROM nation WHERE n_regionkey <> 2), c AS (SELECT s_nationkey AS id, count(*) AS n FROM supplier GROUP BY 1)
SELECT id::VARCHAR AS source_id, CASE WHEN id % 9 = 0 THEN -1 ELSE coalesce(n, 0) END AS rows, (CASE WHEN id % 9 = 0 THEN -1 ELSE coalesce(n, 0) END) = 0 AS warning FROM src LEFT JOIN c USING (id)
""")
def source_yield(spark: SparkSession, sf_dir: str) -> DataFrame:
    k = F.col("n_nationkey")
    sources = table(spark, sf_dir, "nation").select(k.cast("string").alias("source_id"), (F.col("n_regionkey") != 2).alias("enabled"))
    rows = table(spark, sf_dir, "supplier").select(F.col("s_nationkey").cast("string").alias("source_id"))
    failed = table(spark, sf_dir, "nation").filter(k % 9 == 0).select(k.cast("string").alias("source_id"))
    return sync.source_yield(sources, rows, failed)


@query("SELECT o_custkey AS happening_id, o_orderkey AS source_happening_id, row_number() OVER (PARTITION BY o_custkey ORDER BY CASE o_orderstatus WHEN 'F' THEN 100 WHEN 'O' THEN 50 END DESC NULLS LAST, o_orderkey) = 1 AS is_primary FROM orders")
def primary_source(spark: SparkSession, sf_dir: str) -> DataFrame:
    s = F.col("o_orderstatus")
    links = table(spark, sf_dir, "orders").select(F.col("o_custkey").alias("happening_id"), F.col("o_orderkey").alias("source_happening_id"), F.when(s == "F", 100).when(s == "O", 50).alias("source_priority"))
    return merging.primary(links).drop("source_priority")


@query("SELECT c_custkey AS id FROM customer WHERE c_mktsegment = 'BUILDING' AND c_custkey IN (SELECT o_custkey FROM orders)")
def archived_in_use(spark: SparkSession, sf_dir: str) -> DataFrame:
    happenings = table(spark, sf_dir, "customer").select(F.col("c_custkey").alias("id"), F.when(F.col("c_mktsegment") == "BUILDING", "archived").otherwise("published").alias("visibility_status"))
    return contracts.archived_in_use(happenings, table(spark, sf_dir, "orders").select(F.col("o_custkey").alias("happening_id"))).select("id")


@query("""
SELECT user_id, event_id, margin FROM (SELECT user_id, event_id, value - lead(value) OVER w AS margin, row_number() OVER w AS n FROM events WINDOW w AS (PARTITION BY user_id ORDER BY value DESC, event_id)) WHERE n = 1
""")
def best_margin(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ordering.best_and_margin(table(spark, sf_dir, "events"), ["user_id"], "value", ["event_id"]).select("user_id", "event_id", "margin")


@query(r"""
SELECT o_orderkey, 'Dorfgasse ' || (o_orderkey % 80) AS prefix, (8000 + o_orderkey % 999)::VARCHAR AS plz, 'Männedorf' AS city, 'Saal ' || (o_custkey % 9) AS place, 'Kino ' || (o_custkey % 7) AS title_venue FROM orders
""")
def places(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Addresses, labelled lines and venues in titles."""
    k, c = F.col("o_orderkey"), F.col("o_custkey")
    text = F.concat(F.lit("Programm\nDorfgasse "), k % 80, F.lit(", "), k % 999 + 8000, F.lit(" Männedorf\nWo:\n\nSaal "), c % 9, F.lit("\nEnde"))
    a = T.swiss_address(F.split(text, "\n"))
    title = F.concat(F.lit("Ladies Night - Kino "), c % 7)
    return table(spark, sf_dir, "orders").select("o_orderkey", a["prefix"].alias("prefix"), a["plz"].alias("plz"), a["city"].alias("city"), T.labelled_line(text, ("Ort", "Wo")).alias("place"), T.title_venue(title).alias("title_venue"))


@query("""
SELECT event_id, CASE WHEN event_id % 2 = 0 THEN strftime(date_trunc('minute', ts), '%Y-%m-%dT%H:%M') ELSE strftime(ts, '%Y-%m-%d') END AS chosen, event_id % 2 = 0 AS has_time FROM events
""")
def time_candidates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The nearest future one of a page's time elements: one with a time before a nearer date."""
    ts = F.col("ts").cast("timestamp")
    timed, dated = F.date_format(ts, "yyyy-MM-dd'T'HH:mm"), F.date_format(ts, "yyyy-MM-dd")
    pool = F.when(F.col("event_id") % 2 == 0, F.array(F.lit("soon"), dated, timed, F.lit("2040-01-01T10:00"))).otherwise(F.array(F.lit("x"), dated, F.lit("2040-01-01")))
    start = F.lit("2023-01-01").cast("timestamp")
    chosen = D.nearest_future(pool, start)
    return table(spark, sf_dir, "events").select("event_id", chosen.alias("chosen"), D.has_time(chosen).alias("has_time"))


@query("""
SELECT 's' || (o_custkey % 20) AS source_id, coalesce(CASE WHEN o_orderkey % 2 = 0 THEN 'https://x.ch/' || o_orderkey END, 'https://s.ch/' || (o_custkey % 20) || '#evt') AS url, CASE WHEN CAST(o_orderdate AS DATE) IS NOT NULL THEN 'date' END AS date_precision,
  CAST(o_orderdate AS DATE)::VARCHAR AS start_date, '2024-01-17 12:00' AS fetched_at, o_orderkey FROM orders
""")
def raw_to_normalized(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Items with their source's defaults, normalized."""
    k, c = F.col("o_orderkey"), F.col("o_custkey")
    none = F.lit(None).cast("string")
    items = table(spark, sf_dir, "orders").select(
        F.concat(F.lit("s"), c % 20).alias("source_id"), F.when(k % 2 == 0, F.concat(F.lit("https://x.ch/"), k)).alias("item_url"), k.cast("string").alias("title_raw"), F.date_format("o_orderdate", "d. MM. yyyy").alias("_d"),
        F.date_format("o_orderdate", "dd.MM.yyyy").alias("datetime_raw"), none.alias("location_raw"), none.alias("description_raw"), none.alias("extra"), F.lit(None).cast("timestamp").alias("fetched_at"),
    ).drop("_d")
    sources = spark.range(20).select(F.concat(F.lit("s"), "id").alias("source_id"), F.concat(F.lit("https://s.ch/"), "id").alias("seed_url"))
    raw = sync.raw_events(items, sources, clock())
    out = sync.normalized(raw, F.col("fetched_at"))
    url = F.regexp_replace("canonical_url", "#evt-.*$", "#evt")
    return out.select("source_id", url.alias("url"), "date_precision", F.col("start_date_local").cast("string").alias("start_date"), F.date_format("last_seen_at", "yyyy-MM-dd HH:mm").alias("fetched_at"), F.col("title").cast("bigint").alias("o_orderkey"))


@query(r"""
SELECT c_custkey, CASE WHEN c_custkey % 3 > 0 THEN 'Titel ' || c_custkey ELSE 'T' || c_custkey || ' | Seite' END AS title,
  CASE WHEN c_custkey % 5 = 0 THEN 'Kurze Angabe ' || c_custkey || ' aus dem Kopf der Seite' ELSE 'Beschreibung ' || c_custkey || ' mit genug Worten, damit sie als solche gilt.' || chr(10) || chr(10) || '• Punkt' END AS description,
  CASE c_custkey % 4 WHEN 1 THEN 'https://x.ch/og' || c_custkey || '.jpg' WHEN 2 THEN 'https://x.ch/ld' || c_custkey || '.jpg' WHEN 3 THEN 'https://x.ch/bild' || c_custkey || '.jpg' END AS image,
  CASE WHEN c_custkey % 7 = 0 THEN 'Amt ' || c_nationkey WHEN c_custkey % 4 = 2 THEN 'Verein ' || c_nationkey WHEN c_custkey % 4 = 1 THEN 'Kulturamt ' || c_nationkey WHEN c_custkey % 4 = 3 THEN 'Treff ' || c_nationkey ELSE 'Autor ' || c_nationkey END AS organizer,
  CASE WHEN c_custkey % 4 = 2 THEN '2026-03-01T10:00' ELSE '2026-05-0' || (c_custkey % 9 + 1) || 'T19:00' END AS datetime_raw, CASE WHEN c_custkey % 4 = 2 THEN 'jsonld' ELSE 'time_element' END AS method,
  CASE WHEN c_custkey % 4 = 2 THEN 'Saal ' || c_nationkey ELSE 'Dorfgasse ' || (c_custkey % 80) END AS location, CAST(c_nationkey % 50 + 1 AS DOUBLE) AS price, CAST(c_custkey % 9 + 1 AS INT) AS age_min,
  CASE WHEN c_custkey % 2 = 0 THEN 'https://r.ch/' || c_custkey ELSE '/anmeldung/' || c_custkey END AS registration_url, CASE WHEN c_custkey % 2 = 0 THEN 'hier' ELSE 'Jetzt anmelden' END AS registration_raw,
  CASE WHEN c_custkey % 4 = 2 THEN 'Musik' ELSE 'Sport, Kultur' END AS category, 1 AS pdfs, CASE WHEN c_custkey % 2 = 0 THEN 1 ELSE 0 END AS external_links FROM customer
""")
def detail_fields(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All cascades of a detail page, over pages written from customers that give each field in different places."""
    k, c = F.col("c_custkey"), F.col("c_nationkey")
    four = k % 4
    lit, only = F.lit, lambda test, *parts: F.when(test, F.concat(*[F.lit(p) if isinstance(p, str) else p.cast("string") for p in parts])).otherwise(F.lit(""))
    html = F.concat(
        lit("<html><head><title>T"), k, lit(" | Seite</title>"), only(k % 5 == 0, '<meta name="description" content="Kurze Angabe ', k, ' aus dem Kopf der Seite">'), only(four == 0, '<meta name="author" content="Autor ', c, '">'),
        only(four == 1, '<meta property="og:image" content="/og', k, '.jpg">'),
        only(four == 2, '<script type="application/ld+json">{"@graph":[{"@type":"Event","startDate":"2026-03-01T10:00","image":[{"url":"/ld', k, '.jpg"}],"organizer":{"name":"Verein ', c, '"},"location":{"name":"Saal ', c, '"},"about":{"name":"Musik"}}]}</script>'),
        lit("</head><body><img src='/logo.png'>"), only(four == 3, '<img src="/bild', k, '.jpg">'), only(k % 3 > 0, "<h1>Titel ", k, "</h1>"),
        only(k % 5 > 0, '<div class="rte"><p>Beschreibung ', k, " mit genug Worten, damit sie als solche gilt.</p><ul><li>Punkt</li></ul></div>"), only(four != 2, '<p><time datetime="2026-05-0', k % 9 + 1, 'T19:00">bald</time></p>'),
        lit("<p>Dorfgasse "), k % 80, lit(", 8708 Männedorf</p><dl><dt>Preis</dt><dd>CHF "), c % 50 + 1, lit("</dd><dt>Alter:</dt><dd>ab "), k % 9 + 1, lit(" Jahren</dd>"), only(four == 1, "<dt>Veranstalter</dt><dd>Kulturamt ", c, "</dd>"),
        only(k % 2 == 0, '<dt>Anmeldung</dt><dd><a href="https://r.ch/', k, '">hier</a></dd>'), lit("</dl>"), only(four == 3, "<p>Veranstalter:</p><p>Treff ", c, "</p>"), only(k % 2 == 1, '<p><a href="/anmeldung/', k, '">Jetzt anmelden</a></p>'),
        only(k % 7 == 0, "<address>Amt ", c, '<br><a href="mailto:a@b.ch">m</a></address>'), lit('<p><a href="/category/1">Sport</a> <a href="/category/2">Kultur</a> <a href="/f'), k, lit('.pdf">Flyer</a></p></body></html>'),
    )
    # customers are a small file, so one task, but their pages take long to parse
    parts = 4 * max(int(spark.conf.get("spark.sql.shuffle.partitions")), spark.sparkContext.defaultParallelism)
    dealt = table(spark, sf_dir, "customer").select("c_custkey", "c_nationkey").repartition(parts, "c_custkey")
    pages = dealt.select("c_custkey", html.alias("html")).select("c_custkey", read(F.col("html")).alias("p"))
    d = pages.select("c_custkey", P.details(F.col("p"), F.lit("https://x.ch/e/1"), F.lit("2026-01-01").cast("timestamp")).alias("d")).select("c_custkey", "d.*")
    return d.select(
        "c_custkey", F.col("title_raw").alias("title"), F.col("description_raw").alias("description"), F.col("image_url").alias("image"), F.col("organizer_name").alias("organizer"), "time.datetime_raw", "time.method", F.col("location_raw").alias("location"),
        F.col("price.price_from_chf").alias("price"), "age.age_min", "registration.registration_url", "registration.registration_raw", F.col("category_raw").alias("category"), F.col("surfaces.pdf_count").alias("pdfs"), F.col("surfaces.external_link_count").alias("external_links"),
    )


@query("""
WITH s AS (SELECT s_suppkey AS k, s_suppkey::VARCHAR AS source_id FROM supplier), i AS (SELECT unnest([1, 2]) AS i)
SELECT 'govis' AS platform, source_id, 'https://x.ch/a/event/' || (k * 10 + i) || '/eventdate/' || i AS item_url, 'G' || i AS title_raw FROM s, i
UNION ALL SELECT 'ai1ec', source_id, 'https://x.ch/Veranstaltung/a/?instance_id=' || (k * 10 + i), 'A' || i FROM s, i
UNION ALL SELECT 'contao', source_id, 'https://x.ch/e' || (k * 10 + i) || '.html', 'C' || i FROM s, i
UNION ALL SELECT 'clubdesk', source_id, 'https://x.ch/d?id=' || (k * 10 + i), NULL FROM s, i
UNION ALL SELECT 'eventbrite', source_id, 'https://x.ch/e/fest-tickets-' || (k * 10 + i), 'E' || i FROM s, i
UNION ALL SELECT 'months', source_id, 'https://x.ch/m' || i || '?sucheDarstellungTitel=' || (k * 10 + i) || '&sucheZielgruppe=Kinder', 'März 2026' FROM s, i
""")
def platform_links(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Listings of six platforms whose items are links or handlers, each with a repeat, a link that doesn't count and a second page without news."""
    at = lambda i: (F.col("s_suppkey") * 10 + i).cast("string")
    forms = {
        "govis": lambda i: [F.lit('<a href="/a/event/'), at(i), F.lit(f'/eventdate/{i}?x=1">G{i}</a><a href="/a/event/">no</a>')],
        "ai1ec": lambda i: [F.lit('<a href="/Veranstaltung/a/?instance_id='), at(i), F.lit(f'">A{i}</a><a href="/Veranstaltung/a/">no</a>')],
        "contao": lambda i: [F.lit('<div class="x event"><a href="/e'), at(i), F.lit(f'.html#top">C{i}</a></div><div class="y"><a href="/n.html">no</a></div>')],
        "clubdesk": lambda i: [F.lit("<div class='cd-tile' onclick=\"window.location.href='/d?id="), at(i), F.lit("'\">t</div><a href='/n'>no</a>")],
        "eventbrite": lambda i: [F.lit('<a href="/e/fest-tickets-'), at(i), F.lit(f'?aff=1">E{i}</a><a href="/o/fest-tickets-1">no</a>')],
        "months": lambda i: [F.lit(f'<a href="/m{i}?sucheDarstellungTitel='), at(i), F.lit('">März 2026</a><a href="/m?sucheDarstellungTitel=9">Heute</a>')],
    }
    scans = platforms.SCANS | {"months": platforms.kirchenweb_months}
    url = F.lit("https://x.ch/list?sucheZielgruppe=Kinder")
    out = None
    for name, form in forms.items():
        html = F.concat(*form(1), *form(2), *form(1))
        one = _documents(table(spark, sf_dir, "supplier"), "s_suppkey", html, url)
        found = scans[name](one.unionByName(one.withColumn("page", F.lit(1))))
        title = F.col("title_raw") if "title_raw" in found.columns else F.lit(None).cast("string")
        own = found.select(F.lit(name).alias("platform"), "source_id", "item_url", title.alias("title_raw"))
        out = own if out is None else out.unionByName(own)
    return out


@query("""
WITH s AS (SELECT c_custkey::VARCHAR AS source_id, DATE '2026-02-01' + CAST(c_custkey % 300 AS INT) AS d, 'Film ' || c_custkey AS title_raw FROM customer)
SELECT source_id, title_raw, strftime(d, '%Y-%m-%d') || 'T' || t AS datetime_raw FROM s, (SELECT unnest(['14:00', '16:30']) AS t) UNION ALL SELECT source_id, title_raw, strftime(d + 1, '%Y-%m-%d') FROM s
""")
def cinema_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Cinema pages: a day with two times and one without."""
    months = F.array(*[F.lit(m) for m in ("Jan.", "Februar", "März", "April", "Mai", "Juni", "Juli", "Aug.", "Sept.", "Oktober", "Nov.", "Dez.")])
    day = lambda n: F.date_add(F.lit("2026-02-01").cast("date"), (F.col("c_custkey") % 300).cast("int") + n)
    text = lambda d: F.concat(F.dayofmonth(d), F.lit(". "), F.element_at(months, F.month(d)), F.lit(" "), F.year(d))
    html = F.concat(F.lit("<h1>Film "), F.col("c_custkey"), F.lit("</h1><p>"), text(day(0)), F.lit(" 14.00 / 16:30</p><p>bald</p><p>"), text(day(1)), F.lit("</p>"))
    return platforms.screenings(_documents(table(spark, sf_dir, "customer"), "c_custkey", html)).select("source_id", "title_raw", "datetime_raw")


@query("""
SELECT s_suppkey::VARCHAR AS source_id, i AS page, 'https://x.ch/agenda/more?offset=' || (i + 1) * 20 || '&category=musik&region=' || s_suppkey AS item_url FROM supplier, (SELECT unnest([0, 1]) AS i)
""")
def agenda_following(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pages that follow agenda pages: as the button says, with the filters put back, until a page has no new rows or no button."""
    url = F.concat(F.lit("https://x.ch/agenda?category=musik&region="), F.col("s_suppkey"))

    def page(n: int, item: int, button: bool) -> DataFrame:
        more = f'<tr class="row--result load-more"><td><button hx-get="/agenda/more?offset={(n + 1) * 20}">mehr</button></td></tr>' if button else ""
        html = F.concat(F.lit('<table><tr class=row--result><td><a class=agenda__event href="/agenda/x-'), F.col("s_suppkey") * 10 + item, F.lit(f'/"><h1 class=agenda__event-title>F</h1></a></td></tr>{more}</table>'))
        return _documents(table(spark, sf_dir, "supplier"), "s_suppkey", html, url).withColumn("page", F.lit(n))

    return platforms.forum_following(page(0, 1, True).unionByName(page(1, 2, True)).unionByName(page(2, 2, True)).unionByName(page(3, 3, True)))


@query("""
WITH r AS (SELECT o_orderstatus AS source_id, CASE o_orderkey % 3 WHEN 0 THEN 'include' WHEN 1 THEN 'review' ELSE 'exclude' END AS relevance, o_orderkey AS k FROM orders),
n AS (SELECT *, row_number() OVER (PARTITION BY source_id, relevance ORDER BY k) AS n FROM r)
SELECT source_id, relevance, count(*) AS rows, round(100.0 * count(*) / sum(count(*)) OVER (PARTITION BY source_id), 6)::DOUBLE AS percentage, string_agg('T' || k, ',' ORDER BY k) FILTER (WHERE n <= 5) AS examples FROM n GROUP BY 1, 2
""")
def relevance_histogram(spark: SparkSession, sf_dir: str) -> DataFrame:
    from ..operators import audit

    k = F.col("o_orderkey")
    rows = table(spark, sf_dir, "orders").select(F.col("o_orderstatus").alias("source_id"), F.when(k % 3 == 0, "include").when(k % 3 == 1, "review").otherwise("exclude").alias("relevance"), k, F.concat(F.lit("T"), k).alias("title_raw"))
    found = audit.histogram(rows, ["source_id"], "relevance", ["o_orderkey"])
    return found.select("source_id", "relevance", "rows", F.round("percentage", 6).alias("percentage"), F.array_join("examples", ",").alias("examples"))


@query("""
SELECT p_partkey, p_partkey % 4 IN (0, 3) AND p_size >= 10 AS picture FROM part
""")
def pictures(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Images that show something: neither inline data nor decoration, and no side under 100."""
    from ..functions import links as L

    k = F.col("p_partkey")
    src = F.when(k % 4 == 1, F.concat(F.lit("/logo"), k, F.lit(".png"))).when(k % 4 == 2, F.lit("data:image/png;base64,x")).otherwise(F.concat(F.lit("/foto"), k, F.lit(".jpg")))
    side = F.concat((F.col("p_size") * 10).cast("string"), F.when(k % 2 == 0, "px").otherwise(""))
    return table(spark, sf_dir, "part").select("p_partkey", L.is_picture(src, F.lit(None).cast("string"), F.lit("bild"), side, F.lit("100%")).alias("picture"))


@query("""
SELECT o_orderkey, CASE WHEN o_orderkey % 2 = 0 THEN round(0.5 + CASE WHEN o_custkey % 3 = 0 THEN 0.3 ELSE 0 END + CASE WHEN o_custkey % 4 = 0 THEN 0.2 ELSE 0 END, 6) ELSE round(0.5 / 3 + CASE WHEN o_custkey % 3 = 0 THEN 0.3 ELSE 0 END + CASE WHEN o_custkey % 4 = 0 THEN 0.2 ELSE 0 END, 6) END AS confidence,
  sha256('["' || o_orderpriority || '",' || CASE WHEN o_custkey % 2 = 0 THEN '"' || o_orderstatus || '"' ELSE 'null' END || ',null,"a\\"b",null,"{}"]') AS content_hash FROM orders
""")
def confidence_and_hash(spark: SparkSession, sf_dir: str) -> DataFrame:
    k, c = F.col("o_orderkey"), F.col("o_custkey")
    day = lambda n: F.date_add(F.lit("2026-01-01").cast("date"), n)
    none = F.lit(None).cast("string")
    score = T.confidence(F.lit("Sommer Fest"), F.when(k % 2 == 0, "fest, sommer").otherwise("fest am"), F.lit("2026-01-01").cast("date"), day((c % 3).cast("int")), F.lit("Saal"), F.when(c % 4 == 0, "saal.").otherwise("x"))
    hashed = T.content_hash(F.col("o_orderpriority"), F.when(c % 2 == 0, F.col("o_orderstatus")), none, F.lit('a"b'), none, F.lit("{}"))
    return table(spark, sf_dir, "orders").select("o_orderkey", F.round(score, 6).alias("confidence"), hashed.alias("content_hash"))


@query("""
SELECT event_id, 'https://x.ch/a?' || CASE WHEN event_id % 2 = 0 THEN 'q=1&' ELSE '' END || 'datumVon=' || strftime(ts, '%d.%m.%Y') || '&datumBis=' || strftime(CAST(ts AS DATE) + 30, '%d.%m.%Y') AS url,
  CASE WHEN event_id % 3 = 0 THEN 'Fest' ELSE 'Fest ' || event_id END AS title, CASE WHEN event_id % 5 = 0 THEN false ELSE true END AS plausible FROM events
""")
def windows_and_names(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Listing windows, titles without their site's suffix, and organizers that may be one."""
    from ..functions import links as L

    k, day = F.col("event_id"), F.to_date("ts")
    base = F.concat(F.lit("https://x.ch/a?"), F.when(k % 2 == 0, "q=1&").otherwise(""), F.lit("datumVon=01.01.2020&datumBis=02.01.2020"))
    title = F.when(k % 3 == 0, "Fest | Gemeinde").otherwise(F.concat(F.lit("Fest "), k))
    name = F.when(k % 5 == 0, "").otherwise(F.concat(F.lit("Verein "), k))
    return table(spark, sf_dir, "events").select("event_id", L.date_window(base, day, 30).alias("url"), T.without_suffix(title, "|").alias("title"), F.coalesce(T.plausible_organizer(name), F.lit(False)).alias("plausible"))


@query("""
SELECT o_orderkey, CASE o_orderkey % 5 WHEN 0 THEN 'Gemeindesaal Zentrum Leue, Männedorf' WHEN 1 THEN 'Kirchgemeindehaus, Männedorf' WHEN 2 THEN 'Untervogthaus, Männedorf' WHEN 3 THEN 'Kino Wildenmann, Männedorf' END AS venue, CASE WHEN o_orderkey % 5 = 4 THEN 'Saal, Stock ' || (o_custkey % 9) END AS prose FROM orders
""")
def known_venues(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Venues named in prose: known ones by pattern, others after a preposition."""
    k = F.col("o_orderkey")
    text = F.when(k % 5 == 0, "Treff im gemeindesaal  Zentrum Leue, Kirchgemeindehaus").when(k % 5 == 1, "beim KIRCHGEMEINDEHAUS um acht").when(k % 5 == 2, "Untervogthaus").when(k % 5 == 3, "danach Kino Wildenmann.").otherwise(F.concat(F.lit("Fest im Saal, Stock "), F.col("o_custkey") % 9))
    return table(spark, sf_dir, "orders").select("o_orderkey", T.known_venue(text).alias("venue"), F.when(k % 5 == 4, T.prose_venue(text)).alias("prose"))


@query("""
WITH p AS (SELECT c_custkey FROM customer WHERE c_acctbal >= 0)
SELECT 'cascade' AS mode, o_orderkey, o_custkey FROM orders WHERE o_custkey IN (FROM p) UNION ALL SELECT 'set null', o_orderkey, CASE WHEN o_custkey IN (FROM p) THEN o_custkey END FROM orders
""")
def after_delete(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders once customers in debt are gone: deleted with them, or without their reference."""
    rows = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey")
    left = table(spark, sf_dir, "customer").filter("c_acctbal >= 0")
    one = contracts.after_delete(rows, "o_custkey", left, "c_custkey").withColumn("mode", F.lit("cascade"))
    return one.unionByName(contracts.after_delete(rows, "o_custkey", left, "c_custkey", keep=True).withColumn("mode", F.lit("set null"))).select("mode", "o_orderkey", "o_custkey")


@query("WITH s AS (SELECT * FROM (VALUES " + ", ".join(f"({i}, '{s.source_id}', {repr(s.municipality) if s.municipality else 'NULL'})" for i, s in enumerate(registry.SOURCES)) + ") t(i, source_id, municipality)) SELECT c_custkey, municipality FROM customer LEFT JOIN s ON c_custkey % 30 = i")
def municipalities(spark: SparkSession, sf_dir: str) -> DataFrame:
    ids = F.array(*[F.lit(s.source_id) for s in registry.SOURCES])
    rows = table(spark, sf_dir, "customer").select("c_custkey", F.get(ids, (F.col("c_custkey") % 30).cast("int")).alias("source_id"))
    return registry.with_municipality(rows).select("c_custkey", "municipality")


@query("""
SELECT o_orderkey, sha256('["' || o_orderpriority || '",' || CASE WHEN o_orderkey % 2 = 0 THEN '"' || o_orderdate::DATE || '"' ELSE 'null' END || ',null,null,"https://x.ch/' || o_orderkey || '","{}"]') AS content_hash,
  '{"title_raw":"' || o_orderpriority || '","datetime_raw":' || CASE WHEN o_orderkey % 2 = 0 THEN '"' || o_orderdate::DATE || '"' ELSE 'null' END || ',"location_raw":null,"description_raw":null,"item_url":"https://x.ch/' || o_orderkey || '","extra":"{}"}' AS raw_payload, 'ok' AS status FROM orders
""")
def raw_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Raw events as they are kept."""
    from ..sources import sinks

    k, none = F.col("o_orderkey"), F.lit(None).cast("string")
    events = table(spark, sf_dir, "orders").select(
        k, F.lit("s").alias("source_id"), F.lit("https://s.ch/").alias("source_url"), F.concat(F.lit("https://x.ch/"), k).alias("item_url"), F.col("o_orderpriority").alias("title_raw"), F.when(k % 2 == 0, F.date_format("o_orderdate", "yyyy-MM-dd")).alias("datetime_raw"),
        none.alias("location_raw"), none.alias("description_raw"), F.lit("{}").alias("extra"), clock().alias("fetched_at"),
    )
    found = sinks.raw_rows(events)
    return found.select(F.regexp_extract("item_url", r"(\d+)$", 1).cast("bigint").alias("o_orderkey"), "content_hash", "raw_payload", "status")
