"""Dates and times in scraped text, local zones, feed windows and display text.

A parsed time is a struct of start_date, end_date (dates), start_at, end_at (UTC timestamps, null where the text has no
time) and precision (`date` or `datetime`). Nothing is invented: no midnight stands for an unknown time, and text that
isn't a calendar date is null. Local text is Zurich time unless it says otherwise; a local time in the gap in spring moves
on, and of an ambiguous one the first is taken. The clock is always a parameter.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .text import strip

ZONE = "Europe/Zurich"
#: German month names and weekdays, with their short forms.
MONTHS = {
    "jan": 1, "januar": 1, "feb": 2, "februar": 2, "mär": 3, "mar": 3, "maer": 3, "marz": 3, "märz": 3, "maerz": 3, "apr": 4, "april": 4, "mai": 5, "jun": 6, "juni": 6,
    "jul": 7, "juli": 7, "aug": 8, "august": 8, "sep": 9, "sept": 9, "september": 9, "okt": 10, "oktober": 10, "nov": 11, "november": 11, "dez": 12, "dezember": 12,
}
WEEKDAYS = {"de": ("Montag", "Dienstag", "Mittwoch", "Donnerstag", "Freitag", "Samstag", "Sonntag"), "en": ("Monday", "Tuesday", "Wednesday", "Thursday", "Friday", "Saturday", "Sunday")}
SHORT_MONTHS = {
    "de": ("Jan.", "Feb.", "März", "Apr.", "Mai", "Juni", "Juli", "Aug.", "Sept.", "Okt.", "Nov.", "Dez."),
    "en": ("Jan.", "Feb.", "Mar.", "Apr.", "May", "June", "July", "Aug.", "Sept.", "Oct.", "Nov.", "Dec."),
}
#: The forms of times in scraped text.
ISO = r"\d{4}-\d{2}-\d{2}(?:T\d{2}:\d{2}(?::\d{2}(?:\.\d+)?)?(?:[+-]\d{2}:\d{2}|Z)?)?"
DAY = r"(?:(?:Montag|Dienstag|Mittwoch|Donnerstag|Freitag|Samstag|Sonntag),\s*)?"
CLOCK_TIMES = r"(\d{1,2})[.:](\d{2})\s*Uhr(?:\s*(?:-|–|bis)\s*(\d{1,2})[.:](\d{2})\s*Uhr)?"
GERMAN_DATE = r"(\d{1,2})\.\s*(\p{L}+)\.?\s*(\d{4})"
NUMERIC_DATE = r"(\d{2})\.(\d{2})\.(\d{4})"
#: Each form and where its groups stand among the fields of a time: iso_a, iso_b, then day, month and year of the first and the last day, then hour and minute of the start and the end.
FORMS = (
    (rf"\s*({ISO})\s*\|\s*({ISO}).*", (0, 1)),
    (rf"\s*({ISO})\s*", (0,)),
    (rf"\s*{NUMERIC_DATE}\s*-\s*{NUMERIC_DATE}\s*", (2, 3, 4, 5, 6, 7)),
    (rf".*?{GERMAN_DATE}\s*(?:-|–|bis)\s*{DAY}{GERMAN_DATE}(?:,?\s*{CLOCK_TIMES})?.*", (2, 3, 4, 5, 6, 7, 8, 9, 10, 11)),
    (rf".*?{DAY}{GERMAN_DATE}(?:,?\s*{CLOCK_TIMES})?.*", (2, 3, 4, 8, 9, 10, 11)),
    (r"\s*(?:\p{L}+\.?,?\s+)?(\d{1,2})\.(\d{1,2})\.(\d{4})(?:,?\s+(\d{1,2})[:.](\d{2})(?:\s*Uhr)?)?\s*", (2, 3, 4, 8, 9)),
)
FIELDS = 12


def _pattern(forms) -> tuple[str, str]:
    """One pattern that tries the forms in order, and a replacement that writes the fields of the one that fits, `\u0001` between them."""
    of_field: list[list[int]] = [[] for _ in range(FIELDS)]
    group = 0
    for _, fields in forms:
        for field in fields:
            group += 1
            of_field[field].append(group)
    return "(?isuU)^(?:" + "|".join(form for form, _ in forms) + ")$", "\u0001".join("".join(f"${g}" for g in groups) for groups in of_field)


def _month(name: Column) -> Column:
    names = F.create_map(*[F.lit(x) for pair in (MONTHS | {f"{m:0{n}}": m for m in range(1, 13) for n in (1, 2)}).items() for x in pair])
    return F.coalesce(F.try_element_at(names, name), F.try_element_at(names, F.substring(name, 1, 3)))


def month_number(c: Column) -> Column:
    """1 to 12 of a German month's name or its first three letters, or of its number, or null."""
    return _month(F.rtrim(F.lower(strip(c)), F.lit(".")))


def _date(d: Column, m: Column, y: Column) -> Column:
    first = F.when(m.between(1, 12) & y.between(1, 9999) & d.between(1, 31), F.make_date(y, m, F.lit(1)))
    return F.when(d <= F.dayofmonth(F.last_day(first)), F.date_add(first, d - 1))


def calendar_date(day: Column, month: Column, year: Column) -> Column:
    """The date, or null if there is none such. Nothing is parsed or thrown: the day is counted from the first of the month."""
    return _date(*(c.try_cast("int") for c in (day, month, year)))


def local_to_utc(date: Column, hour: Column, minute: Column, zone: str = ZONE) -> Column:
    """The UTC timestamp of a local time, or null if it isn't one."""
    h, m = hour.try_cast("int"), minute.try_cast("int")
    return F.when(h.between(0, 23) & m.between(0, 59), F.to_utc_timestamp(date.cast("timestamp") + F.make_dt_interval(F.lit(0), h, m), zone))


def iso_timestamp(c: Column, zone: str = ZONE) -> Column:
    """A UTC timestamp from ISO text with or without seconds, offset or Z; without offset it is local time, a date its midnight."""
    s = strip(c)
    whole = s.rlike(f"^{ISO}$")
    full = F.regexp_replace(s, r"^(\d{4}-\d{2}-\d{2}T\d{2}:\d{2})(?!:)", "$1:00")
    offset = s.rlike(r"T.*(Z|[+-]\d{2}:\d{2})$")
    return F.when(whole & offset, F.try_to_timestamp(full)).when(whole, F.to_utc_timestamp(F.try_to_timestamp(full), zone))


def local_date(ts: Column, zone: str = ZONE) -> Column:
    """The date that a UTC timestamp falls on in the zone."""
    return F.to_date(F.from_utc_timestamp(ts, zone))


def has_time(c: Column) -> Column:
    """Whether text holds a time of day: ISO, HH:MM, or HH.MM with the word Uhr; `Uhr` must be a word."""
    return F.coalesce(c.rlike(r"\d{4}-\d{2}-\d{2}T\d{2}:\d{2}") | c.rlike(r"\b\d{1,2}:\d{2}\b") | c.rlike(r"(?iuU)\b\d{1,2}\.\d{2}\s*Uhr\b|\bUhr\b"), F.lit(False))


def looks_like_date(c: Column) -> Column:
    return c.rlike(r"^\d{4}-\d{2}-\d{2}")


def _time(start_date: Column, end_date: Column, start_at: Column, end_at: Column) -> Column:
    precision = F.when(start_at.isNotNull(), F.lit("datetime")).otherwise(F.lit("date"))
    return F.when(
        start_date.isNotNull(),
        F.struct(start_date.alias("start_date"), end_date.alias("end_date"), start_at.alias("start_at"), F.when(start_at.isNotNull(), end_at).alias("end_at"), precision.alias("precision")),
    )


def _bound(value: Column, function) -> Column:
    """The function of a value that is computed once, however often the function uses it."""
    return F.get(F.transform(F.array(value), function), F.lit(0))


def _read(c: Column, forms, zone: str) -> Column:
    """The time in text of the first of the forms that fits. The text is matched once; all forms share the fields and what is made of them."""
    pattern, fields = _pattern(forms)

    def numbers(p: Column) -> Column:
        day = lambda i: F.when(p[i] != "", F.struct(p[i].try_cast("int").alias("d"), _month(F.lower(p[i + 1])).alias("m"), p[i + 2].try_cast("int").alias("y")))
        return F.struct(p.alias("p"), day(2).alias("a"), day(5).alias("b"))

    def days(n: Column) -> Column:
        return F.struct(n["p"].alias("p"), *[F.when(n[x].isNotNull(), _date(n[x]["d"], n[x]["m"], n[x]["y"])).alias(x) for x in "ab"])

    def fits(n: Column) -> Column:
        """The days that are some. A range whose last day is none is its first day alone, and has no times."""
        p, a, b = n["p"], n["a"], n["b"]
        lost = (p[5] != "") & b.isNull()
        return F.struct(p.alias("p"), F.when(~(lost & p[6].rlike("^[0-9]")), a).alias("a"), b.alias("b"), (~lost).alias("timed"))

    def times(n: Column) -> Column:
        p, a, b = n["p"], n["a"], n["b"]
        at = lambda day, i: F.when(n["timed"] & (p[i] != ""), local_to_utc(day, p[i], p[i + 1], zone))
        last = F.coalesce(b, F.when(n["timed"] & (p[10] != ""), a))
        return F.struct(a.alias("a"), last.alias("b"), at(a, 8).alias("s"), at(last, 10).alias("e"))

    def of(p: Column) -> Column:
        written = p
        for step in (numbers, days, fits, times):
            written = _bound(written, step)
        return F.when(p[0] != "", _iso(p[0], F.nullif(p[1], F.lit("")), zone)).otherwise(_bound(written, lambda n: _time(n["a"], n["b"], n["s"], n["e"])))

    matched = F.split(F.regexp_replace(c, pattern, fields), "\u0001", -1)
    return _bound(matched, lambda p: F.when(F.size(p) == FIELDS, of(p)))


def _iso(a: Column, b: Column, zone: str) -> Column:
    timed = lambda c, at: F.when(F.contains(c, F.lit("T")), at)

    def of(x: Column) -> Column:
        start, end = x["start"], x["end"]
        return _time(local_date(start, zone), local_date(end, zone), timed(a, start), timed(b, end))

    return _bound(F.struct(iso_timestamp(a, zone).alias("start"), iso_timestamp(b, zone).alias("end")), of)


def parse_time(c: Column, zone: str = ZONE) -> Column:
    """The first form that fits of: ISO range, ISO, numeric range, German range, German date, numeric date; null without one, and where it names no date.

    `2026-01-22T15:00 | 2026-01-22T17:00`; `06.01.2026 - 10.02.2026`; `6. Jan. 2026 - 10. Feb. 2026, 14.00 Uhr - 14.45 Uhr`, whose
    times are those of the first and the last day; `Samstag, 29. März 2026, 15:00 Uhr bis 16:30 Uhr`; `Sa, 24.01.2026, 15:00`.
    """
    return _read(c, FORMS, zone)


def explicit_date(c: Column) -> Column:
    """The first German date in text, whatever stands around it."""
    found = _read(c, ((rf".*?{GERMAN_DATE}.*", (2, 3, 4)),), ZONE)
    return found["start_date"]


def event_type(t: Column) -> Column:
    """date_range if a parsed time ends on another day than it starts, else single."""
    return F.when(t["end_date"].isNotNull() & (t["end_date"] != t["start_date"]), "date_range").otherwise("single")


def slashed_date(c: Column) -> Column:
    """DD/MM/YYYY."""
    return F.try_to_date(c, "dd/MM/yyyy")


def ics_time(c: Column, tzid: Column | None = None, zone: str = ZONE) -> Column:
    """20260315 (a date), 20260315T140000 (local, in the zone that the field names) and 20260315T140000Z (UTC)."""
    s = strip(c)
    day = F.try_to_date(F.substring(s, 1, 8), "yyyyMMdd")
    text = F.regexp_replace(s, r"^(\d{4})(\d{2})(\d{2})T(\d{2})(\d{2})(\d{2})Z?$", "$1-$2-$3 $4:$5:$6")
    own = F.try_to_timestamp(text)
    place = F.coalesce(tzid, F.lit(zone)) if tzid is not None else F.lit(zone)
    at = F.when(s.rlike(r"^\d{8}T\d{6}Z$"), own).when(s.rlike(r"^\d{8}T\d{6}$"), F.to_utc_timestamp(own, place))
    return F.when(s.rlike(r"^\d{8}$"), _time(day, F.lit(None).cast("date"), F.lit(None).cast("timestamp"), F.lit(None).cast("timestamp"))).when(
        at.isNotNull(), _time(local_date(at, zone), F.lit(None).cast("date"), at, F.lit(None).cast("timestamp"))
    )


def iso_in_text(c: Column) -> Column:
    """The first one or two ISO times in text, joined by ` | `: weak evidence."""
    found = F.regexp_extract_all(c, F.lit(r"(\d{4}-\d{2}-\d{2}T\d{2}:\d{2}(?::\d{2})?(?:[+-]\d{2}:\d{2}|Z)?)"), F.lit(1))
    return F.when(F.size(found) > 0, F.array_join(F.slice(found, 1, 2), " | "))


def nearest_future(candidates: Column, clock: Column, zone: str = ZONE) -> Column:
    """Of an array of ISO texts, the next at or after the clock, of those with a time if any has one; else the first of these."""
    pool = F.filter(candidates, looks_like_date)
    timed = F.filter(pool, lambda x: F.contains(x, F.lit("T")))
    chosen = F.when(F.size(timed) > 0, timed).otherwise(pool)
    future = F.filter(F.transform(chosen, lambda x, i: F.struct(iso_timestamp(x, zone).alias("at"), i.alias("i"), x.alias("text"))), lambda s: s["at"] >= clock)
    return F.coalesce(F.array_min(future)["text"], F.get(chosen, F.lit(0)))


# the feed


def weekday(date: Column) -> Column:
    """0 for Sunday to 6."""
    return F.dayofweek(date) - 1


def weekend_start(today: Column) -> Column:
    """The Thursday of today's week, which starts on Monday."""
    return F.date_add(F.to_date(F.date_trunc("week", today)), 3)


def section(date: Column, today: Column) -> Column:
    """weekend from Thursday to Sunday of this week, else coming_up."""
    start = weekend_start(today)
    return F.when(date.between(start, F.date_add(start, 3)), "weekend").otherwise("coming_up")


def duration_hours(start: Column, end: Column) -> Column:
    return (F.unix_micros(end) - F.unix_micros(start)).cast("double") / F.lit(3.6e9)


def is_ongoing(start: Column, end: Column, clock: Column, hours: float = 12) -> Column:
    """Whether both ends are known, at most `hours` apart and around the clock."""
    return F.coalesce((duration_hours(start, end) <= hours) & (clock >= start) & (clock <= end), F.lit(False))


def time_pill(date: Column, start: Column, end: Column, precision: Column, clock: Column, language: str = "de", zone: str = ZONE) -> Column:
    """When something is, relative to the clock: ongoing, today, tomorrow, or weekday and date; times only where known."""
    today = local_date(clock, zone)
    words = {"de": ("Laufend · Bis ", "Heute", "Morgen", " Uhr"), "en": ("Ongoing · Until ", "Today", "Tomorrow", "")}[language]
    at = lambda ts: F.concat(F.date_format(F.from_utc_timestamp(ts, zone), "HH:mm"), F.lit(words[3]))
    timed = (precision == "datetime") & start.isNotNull()
    name = F.element_at(F.array(*[F.lit(x) for x in WEEKDAYS[language]]), F.weekday(date) + 1)
    month = F.element_at(F.array(*[F.lit(x) for x in SHORT_MONTHS[language]]), F.month(date))
    day = F.when(date == today, words[1]).when(date == F.date_add(today, 1), words[2]).otherwise(F.concat_ws(" ", name, F.dayofmonth(date).cast("string"), month))
    return F.when(is_ongoing(start, end, clock), F.concat(F.lit(words[0]), at(end))).otherwise(F.concat(day, F.when(timed, F.concat(F.lit(" · "), at(start))).otherwise(F.lit(""))))


def approved_text(c: Column) -> Column:
    """Whether text has one of the forms accepted from sources without structured times: a German date, alone or with one or two times."""
    return F.coalesce(strip(c).rlike(rf"(?iuU)^{DAY}{GERMAN_DATE}(?:,?\s*{CLOCK_TIMES})?$") & explicit_date(c).isNotNull(), F.lit(False))
