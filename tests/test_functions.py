"""Literal cases and properties of the expressions."""

import datetime as dt
from urllib.parse import urljoin

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from eventloom.functions import dates as D
from eventloom.functions import links as L
from eventloom.functions import records as R
from eventloom.functions import text as T


@pytest.fixture(scope="module")
def value(spark):
    def of(column, **inputs):
        row = spark.createDataFrame([tuple(inputs.values())], ", ".join(f"{k} string" for k in inputs)) if inputs else spark.range(1)
        return row.select(column.alias("v")).first()["v"]

    return of


def test_normalizers(value):
    assert value(T.normalize_title(F.col("a")), a="Märkt – Fest!") == "märkt  fest"
    assert value(T.normalize_venue(F.col("a")), a=" Seestr. 5, ") == "seestrasse 5"
    assert value(T.normalize_text(F.col("a")), a="  A\u00a0 B! ") == "a b!"
    assert value(T.normalize_title(F.col("a")), a=None) == ""


@pytest.mark.parametrize("a,b,v", [("", "", 1.0), ("a", "", 0.0), ("a b", "b c", 1 / 3), (None, None, 1.0)])
def test_jaccard(value, a, b, v):
    c = T.jaccard(F.coalesce(F.col("a"), F.lit("")), F.coalesce(F.col("b"), F.lit("")))
    assert value(c, a=a, b=b) == pytest.approx(v)


def test_confidence_stays_below_the_threshold_in_doubles(value):
    title = "a b c d e f g h i j k l m n", "a b c d e f g h i j k l m n o p q r s t"
    c = T.confidence(F.col("a"), F.col("b"), F.lit("2026-01-01").cast("date"), F.lit("2026-01-01").cast("date"), F.lit("x"), F.lit("x"))
    assert value(c, a=title[0], b=title[1]) == 0.5 * 0.7 + 0.3 + 0.2 < 0.85


def test_fingerprint_refuses_nothing(value):
    none = F.lit(None).cast("date")
    assert value(T.fingerprint(F.col("a"), none, F.col("a")), a="") is None
    assert len(value(T.fingerprint(F.col("a"), none, F.col("a")), a="x")) == 32


def test_split_category_and_suffix(value):
    assert tuple(value(T.split_category(F.col("a")), a="Familien: Basteln: Ostern")) == ("Familien", "Basteln: Ostern")
    assert tuple(value(T.split_category(F.col("a")), a="Basteln")) == ("", "Basteln")
    assert value(T.without_suffix(F.col("a"), " | "), a="Fest | Gemeinde | CH") == "Fest"


def test_places(value):
    lines = F.split(F.col("a"), "\n")
    assert tuple(value(T.swiss_address(lines), a="Programm\nDorfgasse 37, 8708 Männedorf")) == ("Dorfgasse 37", "8708", "Männedorf")
    assert value(T.title_venue(F.col("a")), a="Ladies Night - Kino Wildenmann") == "Kino Wildenmann"
    assert value(T.title_venue(F.col("a")), a="Treff - 19:00 Uhr") is None
    assert value(T.labelled_line(F.col("a"), ("Ort", "Wo")), a="Wann:\n3. Mai\nWo:\n\nSaal 3") == "Saal 3"
    assert value(T.labelled_line(F.col("a"), ("Ort", "Wo")), a="Ort: Halle") == "Halle"
    assert value(T.outing_location(F.col("a")), a="Ausflug nach Zürich") == "Zürich"
    assert value(T.prose_venue(F.col("a")), a="Wir treffen uns im Gemeindehaus, 1. Stock. Bis bald") == "Gemeindehaus, 1"
    assert value(T.known_venue(F.col("a"), {"kino": "Kino", "saal": "Saal"}), a="Im SAAL") == "Saal"


def test_small_extractions(value):
    assert value(T.duration_minutes(F.col("a")), a="Der Film dauert 1:25") == 85
    assert value(T.showtimes(F.col("a")), a="14.00 / 9:30") == ["14:00", "09:30"]
    assert value(T.event_id_in_url(F.col("a")), a="https://x.ch/2024/fest-12345/?id=9") == "12345"
    assert value(T.date_in_url(F.col("a")), a="https://x.ch/2026-02-30") is None
    assert value(T.plausible_organizer(F.col("a")), a="Verein Kultur") and not value(T.plausible_organizer(F.col("a")), a="+41 44 123 45 67")
    assert tuple(value(T.price(F.col("a"), T.FREE_PORTAL, None), a="frei"))[:1] == ("free",)


@given(st.text(max_size=30))
@settings(max_examples=25, deadline=None)
def test_normalizers_are_stable(value, text):
    once = value(T.normalize_venue(F.col("a")), a=text)
    assert value(T.normalize_text(F.col("a")), a=value(T.normalize_text(F.col("a")), a=text)) == value(T.normalize_text(F.col("a")), a=text)
    assert once == once.lower() or once


HREFS = ["/a/b", "c", "./c", "../c", "?q=1", "#f", "//h.ch/x", "https://o.ch/y", "mailto:a@b.ch", "", "a/../b", "/x/./y/../z", "..", "d/"]


@pytest.mark.parametrize("href", HREFS)
@pytest.mark.parametrize("base", ["https://a.ch/p/q/r.html?x=1#t", "http://münchen.example:8080", "https://a.ch/"])
def test_resolve_as_browsers_do(value, base, href):
    expected = urljoin(base, href)
    got = value(L.resolve(F.col("b"), F.col("h")), b=base, h=href)
    assert got.rstrip("/") == expected.rstrip("/")


def test_hosts_and_blocks(value):
    assert value(L.host(F.col("a")), a="https://User@Ä.ch:8443/x") == "user@ä.ch:8443"
    assert value(L.is_blocked(None, F.col("a")), a="<title>Just a moment...</title>") and not value(L.is_blocked(None, F.col("a")), a="<title>Fest</title>")
    assert value(L.is_blocked(F.lit(503), F.col("a")), a="") and not value(L.is_blocked(F.lit(404), F.col("a")), a="")
    got = value(L.date_window(F.col("a"), F.lit("2026-03-01").cast("date")), a="https://x.ch/l?datumVon=1.1.2020&k=1&datumBis=2.2.2020")
    assert got == "https://x.ch/l?k=1&datumVon=01.03.2026&datumBis=01.03.2027"


def test_clock_and_windows(value):
    at = lambda s: F.lit(s).cast("timestamp")
    day = lambda s: F.lit(s).cast("date")
    pill = lambda d, s, e, p, c: value(D.time_pill(day(d), at(s), at(e), F.lit(p), at(c)))
    assert pill("2026-02-10", "2026-02-10 15:00", "2026-02-10 16:00", "datetime", "2026-02-10 15:30") == "Laufend · Bis 17:00 Uhr"
    assert pill("2026-02-10", "2026-02-10 13:30", None, "datetime", "2026-02-10 08:00") == "Heute · 14:30 Uhr"
    assert pill("2026-02-11", None, None, "date", "2026-02-10 08:00") == "Morgen"
    assert pill("2026-02-14", "2026-02-14 10:00", None, "datetime", "2026-02-10 08:00") == "Samstag 14 Feb. · 11:00 Uhr"
    assert pill("2026-01-27", None, None, "date", "2026-01-10 08:00") == "Dienstag 27 Jan."
    assert value(D.weekend_start(day("2026-03-15"))) == dt.date(2026, 3, 12)
    assert value(D.section(day("2026-03-13"), day("2026-03-10"))) == "weekend"
    times = F.array(*map(F.lit, ("2026-01-01", "2026-05-01T10:00", "2026-03-01T10:00", "x")))
    assert value(D.nearest_future(times, at("2026-02-01"))) == "2026-03-01T10:00"
    assert value(D.nearest_future(times, at("2027-02-01"))) == "2026-05-01T10:00"


def test_ics(value):
    ics = "BEGIN:VTIMEZONE\r\nDTSTART:19700329T020000\r\nEND:VTIMEZONE\r\nBEGIN:VEVENT\r\nDTSTART;TZID=Europe/London:20260315T140000\r\nSUMMARY:Familien: Basteln\\, malen\r\n  und mehr\r\nDESCRIPTION:a\\nb\\\\n\r\nORGANIZER;CN=\"Meier, Anna\":mailto:a@b.ch\r\nEND:VEVENT\r\n"
    e = R.vevent(F.col("a"))
    assert value(R.unescaped(R.ics_field(e, "SUMMARY")), a=ics) == "Familien: Basteln, malen und mehr"
    assert value(R.unescaped(R.ics_field(e, "DESCRIPTION")), a=ics) == "a\nb\\n"
    assert tuple(value(R.ics_organizer(e), a=ics)) == ("Meier, Anna", "a@b.ch")
    start = value(D.ics_time(R.ics_field(e, "DTSTART"), R.ics_parameter(e, "DTSTART", "TZID")), a=ics)
    assert start["start_at"] == dt.datetime(2026, 3, 15, 14, 0)
    assert value(D.ics_time(F.col("a")), a="20260315")["precision"] == "date"
    assert value(R.relevance(F.col("a")), a="Familien") == "include" and value(R.relevance(F.col("a")), a="") == "review" and value(R.relevance(F.col("a")), a="Senioren") == "exclude"


def test_extra(value):
    v = R.variant(F.col("a"))
    row = '{"age_min":"5","age_max":5.5,"price_from_chf":0,"price_type":"odd","organizer":{"name":" X "},"registration_url_from_links":"u","categories":["Kinder","Musik"]}'
    got = {k: value(c, a=row) for k, c in R.extra_columns(v).items()}
    assert got == {"image_url": None, "organizer_name": "X", "price_type": None, "price_from_chf": 0.0, "age_min": None, "age_max": None, "registration_url": "u"}
    assert value(R.topic_tags(v, {"kids": "kinder", "art": "kunst"}), a=row) == ["kids"]
    m = lambda **kw: F.create_map(*[x for k, v in kw.items() for x in (F.lit(k), F.lit(v).cast("int"))])
    assert value(R.merged(m(a=1, b=2), m(b=0, c=None))) == {"a": 1, "b": 0}


# documented cases

RAW_TIMES = [
    ("27. Feb. 2026, 19.30 Uhr - 21.00 Uhr", "2026-02-27", "2026-02-27 18:30", "2026-02-27 20:00", "datetime"), ("27. Feb. 2026, 19.30 Uhr", "2026-02-27", "2026-02-27 18:30", None, "datetime"),
    ("21. März 2026", "2026-03-21", None, None, "date"), ("heute", None, None, None, None), ("abends", None, None, None, None), ("ab 19.00 Uhr", None, None, None, None), ("22. - 24. März", None, None, None, None),
    ("06.01.2026 - 10.02.2026", "2026-01-06", None, None, "date"), ("6. Jan. 2026 - 10. Feb. 2026, 14.00 Uhr - 14.45 Uhr", "2026-01-06", "2026-01-06 13:00", "2026-02-10 13:45", "datetime"),
    ("2026-01-22T15:00 | 2026-01-22T17:00", "2026-01-22", "2026-01-22 14:00", "2026-01-22 16:00", "datetime"), ("Samstag, 29. März 2026, 15:00 Uhr bis 16:30 Uhr", "2026-03-29", "2026-03-29 13:00", "2026-03-29 14:30", "datetime"),
    ("3. Mär. 2026", "2026-03-03", None, None, "date"), ("2026-07-01T08:30Z", "2026-07-01", "2026-07-01 08:30", None, "datetime"), ("Sa, 24.01.2026, 15:00", "2026-01-24", "2026-01-24 14:00", None, "datetime"),
    ("30. Februar 2026", None, None, None, None), ("2026-03-29T02:30", "2026-03-29", "2026-03-29 01:30", None, "datetime"), ("2026-10-25T02:30", "2026-10-25", "2026-10-25 00:30", None, "datetime"), ("", None, None, None, None),
]

PRICES_AND_AGES = [
    ("Eintritt frei", "free", None, None, None), ("Kollekte", "donation", None, None, None), ("CHF 12.50", "paid", 12.5, None, None), ("Fr. 20", "paid", 20.0, None, None), ("auf Anfrage", "paid", None, None, None),
    ("ab 6 Jahren", "paid", None, 6, None), ("4-8 Jahre, gratis", "free", None, 4, 8), ("3 bis 5 Jahre", "paid", None, 3, 5), ("Kinder ab 2, CHF 5,50", "paid", 5.5, 2, None), ("ab 0 Jahren", "paid", None, 0, None),
]

JSONLD = [
    ('{"@type":"Event","startDate":"2026-01-22T15:00","endDate":"2026-01-22T17:00","offers":{"price":"12.5"}}', "2026-01-22T15:00 | 2026-01-22T17:00", "paid", 12.5),
    ('{"@graph":[{"@type":"WebPage"},{"@type":["Event","Thing"],"startDate":"2026-02-01","offers":[{"price":"x"},{"price":0}]}]}', "2026-02-01", "free", None),
    ('[{"@type":"Event"},{"@type":"Event","startDate":"2026-03-01"}]', "2026-03-01", None, None), ('{"@type":"MusicEvent","startDate":"2026-03-01"}', None, None, None), ("not json", None, None, None),
]


def test_raw_times(spark):
    at = lambda c: F.date_format(c, "yyyy-MM-dd HH:mm")
    t = F.col("t")
    rows = spark.createDataFrame([(i, r[0]) for i, r in enumerate(RAW_TIMES)], "id int, raw string").select("id", D.parse_time(F.col("raw")).alias("t"))
    found = rows.select("id", t["start_date"].cast("string").alias("d"), at(t["start_at"]).alias("s"), at(t["end_at"]).alias("e"), t["precision"].alias("p")).orderBy("id").collect()
    assert [tuple(r)[1:] for r in found] == [r[1:] for r in RAW_TIMES]


@pytest.mark.parametrize(
    "raw,start,end,at",
    [
        ("31.02.2026 - 01.03.2026", None, None, None), ("29.02.2028 - 01.03.2028", "2028-02-29", "2028-03-01", None), ("1. Mai 2026 bis 99. Juni 2026, 10.00 Uhr", "2026-05-01", None, None), ("1. Foo 2026", None, None, None),
        ("Am 3. Mai 2026, 25.00 Uhr", "2026-05-03", None, None), ("vorher 1. Mai 2026 / 6. Juni 2026 - 7. Juni 2026", "2026-06-06", "2026-06-07", None), ("5.1.2026 9:05", "2026-01-05", None, "2026-01-05 08:05"), (None, None, None, None), ("x\ny 4. Dez. 2026\n", "2026-12-04", None, None),
        ("2026-13-01", None, None, None), ("2026-01-01T10:00+02:00", "2026-01-01", None, "2026-01-01 08:00"), ("١. Mai 2026", None, None, None), ("a" * 5000 + " 4. Mai 2026", "2026-05-04", None, None),
    ],
)
def test_times_that_hardly_fit(value, raw, start, end, at):
    t = value(D.parse_time(F.col("a")), a=raw)
    assert (t is None) == (start is None)
    if t is not None:
        assert (str(t["start_date"]), t["end_date"] and str(t["end_date"]), t["start_at"] and t["start_at"].strftime("%Y-%m-%d %H:%M")) == (start, end, at)


def test_prices_and_ages(spark):
    rows = spark.createDataFrame([(i, r[0]) for i, r in enumerate(PRICES_AND_AGES)], "id int, raw string")
    p, a = T.price(F.col("raw")), T.age(F.col("raw"))
    found = rows.select("id", p["price_type"], p["price_from_chf"], a["age_min"], a["age_max"]).orderBy("id").collect()
    assert [tuple(r)[1:] for r in found] == [r[1:] for r in PRICES_AND_AGES]


def test_jsonld_shapes(spark):
    rows = spark.createDataFrame([(i, r[0]) for i, r in enumerate(JSONLD)], "id int, doc string")
    p = R.event_price(F.col("doc"))
    found = rows.select("id", T.blank_to_null(R.event_time(F.col("doc"))), p["price_type"], p["price_from_chf"]).orderBy("id").collect()
    assert [tuple(r)[1:] for r in found] == [r[1:] for r in JSONLD]
