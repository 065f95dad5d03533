"""Operators, scans, sinks and streams on small rows."""

import datetime as dt
import random
import time

import pytest
from pyspark.sql import functions as F

from eventloom.functions import page as P
from eventloom.operators import contracts, linkage, merging, ordering, sync
from eventloom.sources import platforms, registry, sinks
from eventloom.sources.dom import page, read
from eventloom.streaming import ingest


def sorted_rows(df):
    return sorted(tuple(r) for r in df.collect())


def test_breaker_counts_failures_in_a_row(spark):
    rows = [("s", i, ok) for i, ok in enumerate([1, 0, 0, 1, 0, 0, 0, 1, 1])] + [("t", 0, 1)]
    df = spark.createDataFrame(rows, "s string, pos int, ok int")
    assert [r["pos"] for r in ordering.breaker_cut(df, F.col("ok") == 0, ["s"], ["pos"], 3).filter("s = 's'").orderBy("pos").collect()] == [0, 1, 2, 3, 4, 5, 6]
    blank = ordering.breaker_blank(df, F.col("ok") == 0, ["s"], ["pos"], ["ok"], 3).filter("s = 's'").orderBy("pos").collect()
    assert [r["ok"] for r in blank] == [1, 0, 0, 1, 0, 0, 0, None, None]


def test_pages_stop_without_new_keys(spark):
    rows = [("a", 1, 0), ("b", 1, 1), ("a", 2, 0), ("c", 3, 0)]
    df = spark.createDataFrame(rows, "k string, page int, pos int").withColumn("s", F.lit("x"))
    assert sorted(r["k"] for r in ordering.until_nothing_new(df, "k", "page", ["s"], ["pos"]).collect()) == ["a", "b"]


def test_near_tie_needs_review(spark):
    a = spark.createDataFrame([(1, "sommer fest", dt.date(2026, 7, 1), "saal"), (2, "noise", dt.date(2026, 7, 1), "x")], "id int, title string, start_date date, venue string")
    b = spark.createDataFrame([(10, "sommer fest", dt.date(2026, 7, 1), "saal"), (11, "Sommer-Fest sommer fest", dt.date(2026, 7, 1), "saal"), (12, "sommer fest", dt.date(2026, 7, 2), "saal")], a.schema)
    banned = spark.createDataFrame([("noise",)], "t string")
    pairs = linkage.scored_pairs(a, b, banned=banned)
    assert {r["happening_id"] for r in pairs.collect()} == {10, 11}
    decisions = lambda margin: {r["source_happening_id"]: r["decision"] for r in linkage.decide(a, b, margin=margin, banned=banned).collect()}
    assert decisions(0.0) == {1: "merge", 2: "create"} and decisions(0.3) == {1: "needs_review", 2: "create"}


def test_every_source_is_decided(spark):
    day = dt.date(2026, 7, 1)
    schema = "id int, title string, start_date date, venue string"
    a = spark.createDataFrame([(1, "sommer fest", day, "saal"), (2, "anderes", dt.date(2026, 8, 1), "x"), (3, " ", day, "x"), (4, "ohne tag", None, "x"), (5, "sommer fest am see", day, "saal")], schema)
    b = spark.createDataFrame([(10, "Sommer Fest", day, "saal"), (11, "ohne tag", None, "x")], schema)
    found = {r["source_happening_id"]: (r["happening_id"], r["decision"]) for r in linkage.decide(a, b).collect()}
    assert found == {1: (10, "merge"), 2: (None, "create"), 3: (None, "needs_review"), 4: (None, "needs_review"), 5: (None, "create")}
    links = linkage.linked(linkage.decide(a, b), F.lit(20)).collect()
    assert [(r["source_happening_id"], r["happening_id"]) for r in links] == [(1, 10)]
    assert {r["source_happening_id"]: r["status"] for r in linkage.statuses(linkage.decide(a, b)).collect()} == {1: "processed", 2: "processed", 3: "needs_review", 4: "needs_review", 5: "processed"}
    assert linkage.decide(a.limit(0), b).count() == 0 and {r["decision"] for r in linkage.decide(a, b.limit(0)).collect()} == {"create", "needs_review"}


@pytest.mark.parametrize("floor", [0.55, 0.6, 0.7, 0.85])
def test_pairs_by_brute_force(spark, floor):
    r = random.Random(3)
    words = ["fest", "markt", "kinder", "am", "see", "der", "musik", "und"]
    row = lambda i: (i, " ".join(r.choices(words, k=r.randint(0, 5))), r.choice([None, dt.date(2026, 7, 1), dt.date(2026, 7, 2)]), r.choice(["saal", "saal nord", "", None]))
    schema = "id int, title string, start_date date, venue string"
    left, right = [row(i) for i in range(60)], [row(i) for i in range(100, 170)]
    like = lambda x, y: 1.0 if not x and not y else len(x & y) / len(x | y)
    expected = set()
    for i, t, d, v in left:
        for j, u, e, w in right:
            score = 0.5 * like({*t.split()}, {*u.split()}) + 0.3 * (d is not None and d == e) + 0.2 * like({*(v or "").split()}, {*(w or "").split()})
            if score >= floor:
                expected.add((i, j, round(score, 6)))
    found = linkage.scored_pairs(spark.createDataFrame(left, schema), spark.createDataFrame(right, schema), floor, any_day=True).collect()
    assert len(found) == len(expected) and {(x["source_happening_id"], x["happening_id"], round(x["score"], 6)) for x in found} == expected


def test_precedence_and_provenance(spark):
    rows = [(1, 100, 10, "t", None), (1, 200, 100, "", "v"), (1, 300, 50, "m", "w")]
    df = spark.createDataFrame(rows, "h int, id long, rank int, title string, venue string").withColumn("at", F.lit("2026-01-01").cast("timestamp"))
    found = merging.winners(df, "h", ["title", "venue"], "rank", "at", "id")
    assert merging.merged(found, "h", ["title", "venue"]).first().asDict() == {"h": 1, "title": "m", "venue": "v"}
    assert {(r["field_name"], r["source_happening_id"], r["precedence_rank"]) for r in merging.provenance(found, "h", "id").collect()} == {("title", 300, 50), ("venue", 200, 100)}
    links = spark.createDataFrame([(1, 1, 10), (1, 2, 50), (1, 3, 50)], "happening_id int, source_happening_id int, source_priority int")
    assert [r["source_happening_id"] for r in merging.primary(links).filter("is_primary").collect()] == [2]


@pytest.mark.parametrize("precision,start,bad", [("date", True, True), ("datetime", False, True), ("date", False, False), ("datetime", True, False), (None, True, False)])
def test_time_contract(spark, precision, start, bad):
    at = dt.datetime(2026, 1, 1) if start else None
    df = spark.createDataFrame([(precision, at, None)], "date_precision string, start_at timestamp, end_at timestamp")
    good, quarantine = contracts.split(df)
    assert quarantine.count() == int(bad) and good.count() == int(not bad)


def test_normalized_events(spark):
    raw = spark.createDataFrame(
        [("s", "u", None, " Fest ", "6. Jan. 2026 - 10. Feb. 2026", None, None), ("s", "u", "i", "Kurs", "bald", None, None)],
        "source_id string, source_url string, item_url string, title_raw string, datetime_raw string, location_raw string, description_raw string",
    )
    r = sync.normalized(raw, F.lit("2026-01-01").cast("timestamp")).collect()
    assert len(r) == 1 and (r[0]["title"], r[0]["event_type"], r[0]["is_all_day"], r[0]["start_at"], r[0]["end_date_local"]) == ("Fest", "date_range", True, None, dt.date(2026, 2, 10))
    assert r[0]["canonical_url"] == "u#evt-" + r[0]["external_id"][:16]


def test_bridge_ids_agree(spark):
    events = spark.createDataFrame([("x", "T", dt.datetime(2026, 1, 1, 23, 30), None), ("y", "U", None, None)], "external_id string, title string, start_at timestamp, end_at timestamp")
    h, o, c = sync.bridged(events, "s", F.lit("2026-01-01").cast("timestamp"))
    assert h.count() == o.count() == c.count() == 1
    assert o.first()["happening_id"] == h.first()["public_id"] and c.first()["offering_id"] == o.first()["public_id"]
    assert o.first()["start_date"] == dt.date(2026, 1, 2) and o.first()["end_date"] is None


def test_yield_and_registry(spark):
    sources = spark.createDataFrame([("a", True), ("b", True), ("c", True), ("d", False)], "source_id string, enabled boolean")
    rows = spark.createDataFrame([("a",), ("a",)], "source_id string")
    failed = spark.createDataFrame([("c",)], "source_id string")
    assert sorted_rows(sync.source_yield(sources, rows, failed)) == [("a", 2, False), ("b", 0, True), ("c", -1, False)]
    assert len(registry.validated()) == 1 and registry.table(spark).filter("enabled").count() == 26
    with pytest.raises(ValueError):
        registry.validated(registry.SOURCES + registry.SOURCES[:1])
    with pytest.raises(ValueError):
        registry.validated((registry.Source("x", "nothing", "u"),))


DETAIL = """<html><head><title>Fest | Gemeinde</title><meta property="og:image" content="/i.jpg"><script type="application/ld+json">{"@type":"Event","startDate":"2026-03-01T10:00","organizer":{"name":"Verein Kultur"},
"location":{"name":"Saal"},"offers":{"price":5}}</script></head><body><article><h1>Fest  für alle</h1><p>Ein Fest für Kinder ab 4, mit viel Musik und Tanz und allem, was dazu gehört.</p><ul><li>Tanz</li></ul>
<dl><dt>Preis</dt><dd>CHF 12</dd><dd>Kinder gratis</dd><dt>Anmeldung</dt><dd><a href="https://reg.ch/x">hier</a></dd></dl><a href="/flyer.pdf">Flyer</a><a href="https://tickets.ch/1">Karten</a><img src="/logo.png"><address>Amt<br>Anna<br><a href="mailto:a@b.ch">m</a></address></article></body></html>"""


def test_detail_page(spark):
    df = spark.createDataFrame([(DETAIL, "https://x.ch/e/1"), (None, None)], "html string, url string").withColumn("p", read(F.col("html")))
    p = F.col("p")
    got = df.filter("url is not null").select(P.details(p, F.col("url"), F.lit("2026-01-01").cast("timestamp")).alias("d")).first()["d"]
    assert (got["title_raw"], got["location_raw"], got["organizer_name"], got["image_url"]) == ("Fest für alle", "Saal", "Amt", "https://x.ch/i.jpg")
    assert tuple(got["time"]) == ("2026-03-01T10:00", "jsonld")
    assert got["description_raw"].startswith("Fest für alle\n\nEin Fest") and "• Tanz" in got["description_raw"]
    assert got["age"]["age_min"] == 4 and got["price"]["price_type"] == "free" and got["registration"]["registration_url"] == "https://reg.ch/x"
    assert got["surfaces"]["pdf_urls"] == ["https://x.ch/flyer.pdf"] and len(got["surfaces"]["external_links"]) == 2
    links = df.filter("url is not null").select(P.link_summary(P.surfaces(p, F.col("url"))["external_links"]).alias("s")).first()["s"]
    assert links["classes"] == {"other": 1, "ticket": 1}
    assert page(None)["links"] == [] and page("")["h1"] is None


def listing(spark, html, url="https://x.ch/list?sucheZielgruppe=Kinder", pages=1):
    return spark.createDataFrame([("s", i, url, html) for i in range(pages)], "source_id string, page int, url string, html string")


def test_scans(spark):
    entities = '{"data":[{"name":"<a href=\\"/_rte/anlass/11\\">A</a>","_hauptkategorieId":"18,3"},{"name":"<a href=\\"/_rte/anlass/12\\">B</a>","_hauptkategorieId":"5"}]}'.replace('"', "&quot;")
    got = platforms.icms(listing(spark, f'<table data-entities="{entities}"></table>')).orderBy("pos").collect()
    assert [(r["item_url"], r["relevant"]) for r in got] == [("https://x.ch/_rte/anlass/12", False), ("https://x.ch/_rte/anlass/11", True)]
    got = platforms.icms(listing(spark, '<a href="/_rte/anlass/3?x">a</a> "\\/anlaesseaktuelles\\/9"')).orderBy("pos").collect()
    assert [r["item_url"] for r in got] == ["https://x.ch/anlaesseaktuelles/9", "https://x.ch/_rte/anlass/3"]
    got = platforms.kirchenweb_months(listing(spark, '<a href="/a?sucheDarstellungTitel=1">März 2026</a><a href="/a?sucheDarstellungTitel=2">Heute</a>')).collect()
    assert [r["item_url"] for r in got] == ["https://x.ch/a?sucheDarstellungTitel=1&sucheZielgruppe=Kinder"]
    assert platforms.kirchenweb(listing(spark, '<a class="agendaTitel x" href="/veranstaltung/5?b">t</a><a href="/veranstaltung/6">u</a>')).count() == 1
    assert platforms.govis(listing(spark, '<a href="/x/event/5/eventdate/7">t</a><a href="/x/event/">u</a>', pages=3)).count() == 1
    assert platforms.ai1ec(listing(spark, '<a href="/Veranstaltung/a/?instance_id=5">t</a>', pages=3)).count() == 1
    assert platforms.contao(listing(spark, '<div class="mod_eventlist"><div class="event"><a href="e.html">t</a></div></div>')).first()["item_url"] == "https://x.ch/e.html"
    assert platforms.clubdesk(listing(spark, "<div class='cd-tile-h-box' onclick=\"window.location.href='/d?id=1'\">t</div>")).first()["item_url"] == "https://x.ch/d?id=1"
    assert platforms.eventbrite(listing(spark, '<a href="https://e.ch/e/fest-tickets-12?aff=1">t</a>')).first()["item_url"] == "https://e.ch/e/fest-tickets-12"
    seiten = spark.range(1).select(platforms.govis_pages(F.lit("Seite 1 von 3"), F.lit("u?p={page}")).alias("p"), platforms.govis_pages(F.lit(""), F.lit("u")).alias("q")).first()
    assert seiten["p"] == ["u?p=2", "u?p=3"] and seiten["q"] == []


def test_agenda_rows_fill_their_day(spark):
    row = lambda day, n, time: f'<tr class="row--result">{f"<th class=agenda__day><time datetime={day}>x</time></th>" if day else ""}<td><time class="agenda__time" datetime="{time}">t</time><a class="agenda__event" href="/agenda/20260105-fest-{n}/"><h1 class="agenda__event-title">T{n}</h1></a></td></tr>'
    got = platforms.forum(listing(spark, "<table>" + row(None, 1, "09:00") + row("2026-02-01", 2, "10:00") + row(None, 3, "11:00") + row(None, 2, "12:00") + "</table>")).orderBy("pos").collect()
    assert [(r["title_raw"], r["datetime_raw"]) for r in got] == [("T1", "2026-01-05T09:00"), ("T2", "2026-02-01T10:00"), ("T3", "2026-02-01T11:00")]


def test_feeds_and_calendars(spark):
    rss = "<rss><channel><item><title>Singen</title><link>https://x.ch/1</link><description><![CDATA[05/03/2026 - 09:00 - 10:30 <br />Pilz <br />Seestr. 1 <br />Erlenbach]]></description></item><item><title>Ohne</title><description>x</description></item></channel></rss>"
    got = platforms.rss(listing(spark, rss)).collect()
    assert [(r["datetime_raw"], r["end_time"], r["location_raw"]) for r in got] == [("2026-03-05T09:00:00", "2026-03-05T10:30:00", "Pilz, Seestr. 1, Erlenbach")]
    ics = "BEGIN:VEVENT\nDTSTART:20260315T140000Z\nSUMMARY:Familien: Ausflug nach Bern\nEND:VEVENT"
    r = platforms.ics(listing(spark, ics)).first()
    assert (r["title_raw"], r["relevance"], r["location_raw"], r["start"]["start_at"]) == ("Ausflug nach Bern", "include", "Bern", dt.datetime(2026, 3, 15, 14))
    r = platforms.screenings(listing(spark, "<h1>Film</h1><p>25. März 2026 14.00 / 16:00</p><p>8. April 2026</p>")).orderBy("pos", "time").collect()
    assert [x["datetime_raw"] for x in r] == ["2026-03-25T14:00", "2026-03-25T16:00", "2026-04-08"]
    items = registry.read(listing(spark, ics).withColumn("source_id", F.lit("ref-kirche-maennedorf")), tuple(s for s in registry.SOURCES if s.adapter in ("ics", "rss")))
    assert items.count() == 1


def test_table_upserts(spark, tmp_path):
    t = sinks.Table(spark, str(tmp_path / "t"))
    rows = lambda *r: spark.createDataFrame(r, "k int, v string, at int")
    assert not t.exists() and t.upsert(rows((1, "a", 1), (1, "b", 2), (2, "c", 1)), ["k"], [F.desc("at")]) == 2
    t.upsert(rows((2, "d", 3), (3, "e", 3)), ["k"], [F.desc("at")])
    t.upsert(rows((9, "x", 3)), ["k"], [F.desc("at")], dry_run=True)
    assert sorted_rows(t.read().select("k", "v")) == [(1, "b"), (2, "d"), (3, "e")]
    assert [r["v"] for r in t.find(k=2).collect()] == ["d"] and t.rows(["v"], 1, k=3).collect()[0].asDict() == {"v": "e"} and t.find(k=9).count() == 0
    with pytest.raises(ValueError):
        t.upsert(rows((None, "n", 1)), ["k"], [F.desc("at")])
    # of two writers that began with the same version one fails and loses nothing
    with pytest.raises(RuntimeError):
        t.write(rows((7, "y", 1)), after=1)
    assert t.number() == 2 and t.read().count() == 3
    before = t._manifest(2)["folders"]
    t.upsert(rows((2, "f", 4)).withColumn("more", F.lit("m")), ["k"], [F.desc("at")])
    folders = t._manifest(3)["folders"]
    assert sum(folders[b] != before[b] for b in before) == 1 and sorted_rows(t.read().select("k", "v", "more")) == [(1, "b", None), (2, "f", "m"), (3, "e", None)]
    t.upsert(rows((2, "f", 4)).withColumn("more", F.lit("m")), ["k"], [F.desc("at")])
    assert sorted_rows(t.read().select("k", "v")) == [(1, "b"), (2, "f"), (3, "e")]
    t.upsert(rows((8, "b", 5)), ["v"], [F.desc("at")])
    assert sorted_rows(t.read().select("k", "v")) == [(2, "f"), (3, "e"), (8, "b")]
    sinks.append(rows((1, "a", 1)).withColumn("source_id", F.lit("s")), str(tmp_path / "raw"))
    assert spark.read.parquet(str(tmp_path / "raw")).count() == 1


def test_pages_are_fetched_by_host(spark):
    """A page that is busy once, one that is missing, one that nobody serves, and one in another character set."""
    import json
    import threading
    from http.server import BaseHTTPRequestHandler, HTTPServer

    from eventloom.sources import http

    asked = []

    class Site(BaseHTTPRequestHandler):
        def do_GET(self):
            asked.append(self.path)
            status = 429 if self.path == "/always" or (self.path == "/busy" and asked.count("/busy") < 3) else 404 if self.path == "/gone" else 200
            self.send_response(status)
            self.send_header("Content-Type", "text/html; charset=iso-8859-1")
            self.end_headers()
            self.wfile.write(f"<p>für {self.path} {self.headers['User-Agent']}</p>".encode("iso-8859-1"))

        def log_message(self, *_):
            pass

    server = HTTPServer(("127.0.0.1", 0), Site)
    threading.Thread(target=server.serve_forever, daemon=True).start()
    base = f"http://127.0.0.1:{server.server_port}"
    spark.dataSource.register(http.Pages)
    urls = [["a", f"{base}/busy"], ["a", f"{base}/gone"], [None, "http://127.0.0.1:1/"], ["b", f"{base}/always"], ["b", "no url"]]
    found = {r["page"]: r for r in spark.read.format("eventloom_pages").option("urls", json.dumps(urls)).option("wait", "0.01").option("agent", "me").load().collect()}
    assert (found[0]["status"], found[0]["html"], found[1]["status"], found[3]["status"]) == (200, "<p>für /busy me</p>", 404, 429)
    assert found[2]["error"] and found[4]["error"] and asked.count("/busy") == asked.count("/always") == 3 and found[2]["source_id"] is None
    assert spark.read.format("eventloom_pages").load().count() == 0
    server.shutdown()


def test_first_details_and_runs(spark):
    items = spark.createDataFrame([(1, None), (2, "own"), (3, "")], "key int, label string")
    details = spark.createDataFrame([(1, 2, "late", "x"), (1, 1, None, None), (1, 1, "early", "y"), (3, 1, "z", None)], "key int, at int, label string, more string")
    got = sync.enriched(items, details, "key", ["label"], ["more"], ["at"])
    assert sorted_rows(got.select("key", "label", "more")) == [(1, "early", "y"), (2, "own", None), (3, "z", None)]
    start = dt.datetime(2026, 1, 1)
    events = spark.createDataFrame([("x", "B", dt.datetime(2026, 1, 2), None), ("x", "A", start, None), ("x", "C", start, dt.datetime(2026, 1, 3))], "external_id string, title string, start_at timestamp, end_at timestamp")
    h, o, c = sync.bridged(events, "s", F.lit("2026-01-01").cast("timestamp"))
    assert h.first()["title"] == "C" and o.first()["start_date"] == dt.date(2026, 1, 1) and c.count() == 3
    sources = spark.createDataFrame([("a",), ("b",)], "source_id string")
    surfaces = spark.createDataFrame([("a", "listing", True, 3, 0, 1, False), ("a", "detail", False, 0, 1, 0, None)], "source_id string, kind string, ok boolean, items int, failed int, skipped int, breaker_open boolean")
    runs = sync.open_runs(sources, F.lit("2026-01-01").cast("timestamp"))
    assert {r["status"] for r in runs.collect()} == {"running"} and runs.select("id").distinct().count() == 2
    errors = spark.createDataFrame([("b", "timeout")], "source_id string, error_message string")
    closed = {r["source_id"]: r for r in sync.close_runs(runs, surfaces, F.lit("2026-01-02").cast("timestamp"), errors).collect()}
    assert (closed["a"]["status"], closed["a"]["surfaces_attempted"], closed["a"]["dom_items_visible"], closed["a"]["items_failed"], closed["a"]["items_skipped"]) == ("success", 2, 3, 1, 1)
    assert (closed["b"]["status"], closed["b"]["error_message"], closed["b"]["surfaces_attempted"], closed["b"]["circuit_breaker_triggered"]) == ("failed", "timeout", 0, False)


def test_images_of_all_shapes(spark):
    docs = ['{"@type":"Event","image":"/a.jpg"}', '{"@type":"Event","image":["/b.jpg"]}', '{"@type":"Event","image":{"url":"/c.jpg"}}', '{"@type":"Event","image":[{"url":"/d.jpg"},{"url":"/e.jpg"}]}']
    rows = [(i, f'<script type="application/ld+json">{d}</script>') for i, d in enumerate(docs)]
    got = spark.createDataFrame(rows, "i int, html string").select("i", P.image(read(F.col("html")), F.lit("https://x.ch/")).alias("u")).orderBy("i").collect()
    assert [r["u"] for r in got] == [f"https://x.ch/{c}.jpg" for c in "abcd"]


def test_ledger(spark):
    runs = spark.createDataFrame([("r1", "s")], "id string, source_id string")
    items = spark.createDataFrame([("s", "u", "t", None), ("s", "u", "t2", None), ("s", None, "t", "x")], "source_id string, item_url string, title_raw string, datetime_raw string")
    assert sinks.ledger(runs, items).count() == 2


def test_streams(spark, tmp_path):
    (tmp_path / "in").mkdir()
    line = '{{"source_id":"s","item_url":"u{}","title_raw":"t","fetched_at":"2026-01-01T10:{:02d}:00Z"}}'
    (tmp_path / "in" / "a.json").write_text("\n".join(line.format(i % 3, i) for i in range(6)))
    raw = ingest.raw_stream(spark, str(tmp_path / "in"))
    table = sinks.Table(spark, str(tmp_path / "t"))
    ingest.upsert_stream(ingest.first_seen(raw), table, ["source_id", "item_key"], [F.desc("fetched_at")], str(tmp_path / "c1")).awaitTermination()
    assert table.read().count() == 3
    q = ingest.counts(raw, "5 minutes", "0 seconds").writeStream.format("memory").queryName("counted").outputMode("complete").trigger(availableNow=True).start()
    q.awaitTermination()
    assert sorted(r["rows"] for r in spark.table("counted").collect()) == [1, 5]


def test_audits(spark):
    from eventloom.operators import audit

    raw = spark.createDataFrame([("s", "27. Feb. 2026, 19.30 Uhr", "a"), ("s", "heute", "b"), ("s", None, "c"), ("s", "2026-02-01", "d")], "source_id string, datetime_raw string, title_raw string")
    assert tuple(audit.time_audit(raw).first()) == ("s", 4, 75.0, 25.0, 50.0, 25.0)
    got = audit.histogram(raw.withColumn("r", F.when(F.col("title_raw") == "a", "x")), ["source_id"], "r", ["title_raw"], 2).collect()
    assert {(r["r"], r["rows"], r["percentage"], tuple(r["examples"])) for r in got} == {("x", 1, 25.0, ("a",)), (None, 3, 75.0, ("b", "c"))}


def test_command_line(spark, tmp_path, capsys):
    from eventloom.__main__ import main

    rows = [(1, "s", "x", "T", dt.datetime(2026, 1, 1, 20)), (2, "s", None, "U", None), (3, None, "y", "V", dt.datetime(2026, 1, 1, 20))]
    df = spark.createDataFrame(rows, "id long, source_id string, external_id string, title string, start_at timestamp")
    for name, kind in (("end_at", "timestamp"), ("datetime_raw", "string"), ("date_precision", "string"), ("location_name", "string"), ("description", "string"), ("timezone", "string"), ("canonical_url", "string"), ("content_hash", "string"), ("last_seen_at", "timestamp")):
        df = df.withColumn(name, F.lit(None).cast(kind))
    df.write.parquet(str(tmp_path / "events"))
    given = ["--events", str(tmp_path / "events"), "--table", str(tmp_path / "table")]
    assert main([*given, "--dry-run"]) == 2 and not (tmp_path / "table").exists()
    assert main([*given, "--source-id", "s"]) == 0
    out = capsys.readouterr().out.strip().splitlines()[-1]
    assert '"written": 1' in out and '"quarantined": 1' in out
    assert spark.read.parquet(str(next((tmp_path / "table").glob("v-*")))).count() == 1


def test_copies_are_decided_without_pairing_them(spark):
    # 40,000 equal rows on each side are 1.6 thousand million pairs
    began = time.time()
    rows = lambda first: spark.range(first, 80_000, 2).select("id", F.lit("Fest am See").alias("title"), F.lit("2026-01-01").cast("date").alias("start_date"), F.lit("Saal").alias("venue"))
    one = spark.createDataFrame([(-2, "Konzert im Park", dt.date(2026, 1, 2), "Park"), (-4, "Konzert im Park", dt.date(2026, 1, 3), "Park"), (-6, None, None, None)], "id long, title string, start_date date, venue string")
    happenings = rows(1).unionByName(spark.createDataFrame([(-1, "Konzert im Park", dt.date(2026, 1, 2), "Park"), (-3, "Konzert im Garten", dt.date(2026, 1, 3), "Park")], one.schema))
    found = linkage.decide(rows(0).unionByName(one), happenings).groupBy("happening_id", "score", "margin", "decision").count().collect()
    assert {tuple(r) for r in found} == {(1, 1.0, 0.0, "needs_review", 40_000), (-1, 1.0, None, "merge", 1), (None, None, None, "create", 1), (None, None, None, "needs_review", 1)}
    assert time.time() - began < 100


def test_pairs_of_copies_are_all_there(spark):
    # groups of more rows than linkage.GROUP are dealt to several
    rows = lambda first, n: spark.range(n).select((F.col("id") * 2 + first).alias("id"), F.lit("Fest am See").alias("title"), F.lit("2026-01-01").cast("date").alias("start_date"), F.lit("Saal").alias("venue"))
    found = linkage.scored_pairs(rows(0, 2500), rows(1, 30), any_day=True).agg(F.count(F.lit(1)), F.countDistinct("source_happening_id", "happening_id"), F.min("score"), F.max("score")).first()
    assert tuple(found) == (75_000, 75_000, 1.0, 1.0)
