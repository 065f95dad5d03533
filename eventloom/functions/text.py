"""Text, similarity, key and classification expressions.

Every function takes and gives Columns. Nulls stay null unless said otherwise. `\\w`, `\\s` and case follow Unicode.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def strip(c: Column) -> Column:
    """Without white space at both ends, of any kind."""
    return F.regexp_replace(c, r"(?U)^\s+|\s+$", "")


def blank_to_null(c: Column) -> Column:
    return F.nullif(c, F.lit(""))


def extract(c: Column, pattern: str, group: int = 1) -> Column:
    """The first match's group, or null where nothing matches or the group is empty."""
    return blank_to_null(F.regexp_extract(c, pattern, group))


def normalize_title(c: Column) -> Column:
    """Lower case, white space to one space, then without punctuation; null gives an empty string.

    Spaces are collapsed before punctuation goes, so that `a - b` keeps two; keys depend on this order.
    """
    s = F.regexp_replace(strip(F.lower(F.coalesce(c, F.lit("")))), r"(?U)\s+", " ")
    return F.regexp_replace(s, r"(?U)[^\w\s]", "")


def normalize_venue(c: Column) -> Column:
    """Lower case, white space to one space, Swiss street abbreviations written out, no `.,;` at the end; null gives ''."""
    s = F.regexp_replace(strip(F.lower(F.coalesce(c, F.lit("")))), r"(?U)\s+", " ")
    s = F.replace(F.replace(s, F.lit("str."), F.lit("strasse")), F.lit("str "), F.lit("strasse "))
    return F.regexp_replace(s, r"[.,;]+$", "")


def normalize_text(c: Column) -> Column:
    """Lower case and white space to one space; punctuation stays."""
    return F.regexp_replace(strip(F.lower(F.coalesce(c, F.lit("")))), r"(?U)\s+", " ")


def tokens(c: Column) -> Column:
    """The distinct words between white space."""
    return F.array_distinct(F.filter(F.split(c, r"(?U)\s+"), lambda t: t != ""))


def jaccard(a: Column, b: Column) -> Column:
    """Likeness of two texts' sets of words: 1 if both are empty, 0 if one is."""
    return likeness(tokens(a), tokens(b))


def likeness(x: Column, y: Column) -> Column:
    """Likeness of two arrays of distinct words; the union's size follows from the intersection's."""
    both = F.size(F.array_intersect(x, y)).cast("double")
    return (
        F.when((F.size(x) == 0) & (F.size(y) == 0), F.lit(1.0))
        .when((F.size(x) == 0) | (F.size(y) == 0), F.lit(0.0))
        .otherwise(both / (F.size(x) + F.size(y) - both))
    )


def sha256_hex(c: Column, n: int = 64) -> Column:
    return F.substring(F.sha2(c.cast("binary"), 256), 1, n)


def fingerprint(title: Column, date: Column, venue: Column) -> Column:
    """The first 32 hex digits of the SHA-256 of the non-empty ones of normalized title, ISO date and normalized venue.

    Null where all three are empty: such rows would share one key and must not match each other.
    """
    parts = [blank_to_null(normalize_title(title)), date.cast("string"), blank_to_null(normalize_venue(venue))]
    return F.when(F.coalesce(*parts).isNotNull(), sha256_hex(F.concat_ws("|", *parts), 32))


def confidence(title_a: Column, title_b: Column, date_a: Column, date_b: Column, venue_a: Column, venue_b: Column) -> Column:
    """0.5 title likeness + 0.3 equal dates + 0.2 venue likeness, in doubles and in this order of addition."""
    title = jaccard(normalize_title(title_a), normalize_title(title_b))
    date = F.when(date_a.isNotNull() & (date_a == date_b), F.lit(1.0)).otherwise(F.lit(0.0))
    venue = jaccard(normalize_venue(venue_a), normalize_venue(venue_b))
    return F.lit(0.5) * title + F.lit(0.3) * date + F.lit(0.2) * venue


def content_hash(title: Column, when: Column, where: Column, description: Column, url: Column, extra: Column) -> Column:
    """SHA-256 over a canonical form of what a row says, without its source and time of fetching.

    The canonical form is JSON of the fields in a fixed order, nulls written as null. `extra` should be text without keys
    that change daily.
    """
    fields = [title, when, where, description, url, extra]
    quoted = [F.coalesce(F.concat(F.lit('"'), F.regexp_replace(F.regexp_replace(c.cast("string"), r"\\", r"\\\\"), '"', r'\\"'), F.lit('"')), F.lit("null")) for c in fields]
    return sha256_hex(F.concat(F.lit("["), F.concat_ws(",", *quoted), F.lit("]")))


def item_key(url: Column, source: Column, title: Column, when: Column) -> Column:
    """The URL, or else `hash:` and 24 digits over source, title and time."""
    seed = F.concat_ws("|", *[F.coalesce(c.cast("string"), F.lit("")) for c in (source, title, when)])
    return F.coalesce(blank_to_null(url), F.concat(F.lit("hash:"), sha256_hex(seed, 24)))


def external_id(source: Column, url: Column, title: Column, start_utc: Column, location: Column) -> Column:
    """SHA-256 of source and URL, or without one of source, normalized title, UTC start in ISO form and location."""
    by_url = F.concat_ws("|", source, F.lit("url"), url)
    iso = F.coalesce(F.date_format(start_utc, "yyyy-MM-dd'T'HH:mm:ss'+00:00'"), F.lit(""))
    by_text = F.concat_ws("|", source, normalize_text(title), iso, normalize_text(location))
    return sha256_hex(F.when(blank_to_null(url).isNotNull(), by_url).otherwise(by_text))


def canonical_url(item_url: Column, source_url: Column, external: Column) -> Column:
    return F.coalesce(blank_to_null(item_url), F.concat(source_url, F.lit("#evt-"), F.substring(external, 1, 16)))


def public_id(source: Column, kind: str, external: Column, extra: Column | None = None) -> Column:
    """source:kind: and 24 hex digits of the SHA-1 of what it names."""
    base = F.concat_ws(":", source, F.lit(kind), external, *([extra] if extra is not None else []))
    return F.concat(source, F.lit(f":{kind}:"), F.substring(F.sha1(base.cast("binary")), 1, 24))


def tier(source: Column, tiers: dict[str, str] | None = None, default: str = "A") -> Column:
    out = F.lit(default)
    for name, value in (tiers if tiers is not None else {"maennedorf_portal": "B"}).items():
        out = F.when(source == name, F.lit(value)).otherwise(out)
    return out


def split_category(c: Column) -> Column:
    """struct(category, title): cut at the first `: `; without one the category is empty."""
    at = F.instr(c, ": ")
    return F.when(at > 0, F.struct(strip(F.substring(c, F.lit(1), at - 1)).alias("category"), strip(F.substring(c, at + 2, F.length(c))).alias("title"))).otherwise(
        F.struct(F.lit("").alias("category"), strip(F.coalesce(c, F.lit(""))).alias("title"))
    )


def without_suffix(c: Column, mark: str) -> Column:
    """What stands before the first mark, stripped."""
    return strip(F.substring_index(c, mark, 1))


#: Patterns of link intents, prices and ages.
TICKET = r"(?iu)(ticket|eventbrite|eventfrog|starticket|ticketcorner)"
REGISTRATION = r"(?iu)(anmeld|registr|booking|sign.?up|einschreib|teilnahm|buchen)"
REGISTRATION_DETAIL = r"(?iu)(anmeld|registr|booking|teilnahm|einschreib|sign.?up)"
ORGANIZER = r"(?iu)(veranstalter|organisator|organizer|organiser|träger)"
VENUE = r"(?iu)(standort|ort|karte|map|wegbeschreibung|anfahrt|location|directions)"
FREE = r"(?iuU)\b(kostenlos|gratis|eintritt\s+frei|unentgeltlich|kein[e]?\s+(?:kosten|gebühr)|free\s+(?:entry|admission|of\s+charge))\b"
FREE_PORTAL = r"(?iuU)\b(kostenlos|gratis|frei|eintritt\s+frei|unentgeltlich|keine?\s+kosten)\b"
DONATION = r"(?iuU)\b(kollekte|freiwillig(?:er|e)?\s+beitrag|spende)\b"
AMOUNT = r"(?iu)(?:CHF|Fr\.?)\s*(\d+(?:[.,]\d{1,2})?)"
AGE_RANGE = r"(?iu)(\d{1,2})\s*[-–]\s*(\d{1,2})\s*(?:Jahre|J\.|years?)"
AGE_TO = r"(?iu)(\d{1,2})\s+bis\s+(\d{1,2})\s*(?:Jahre|J\.|years?)"
AGE_CHILDREN = r"(?iu)Kinder\s+ab\s+(\d{1,2})"
AGE_FROM = r"(?iu)(?:ab|from)\s+(\d{1,2})\s*(?:Jahren?|J\.|years?)"


def link_class(url: Column, text: Column) -> Column:
    """document, organizer, ticket, registration, venue or other, by the first rule that holds."""
    t = F.coalesce(text, F.lit(""))
    return (
        F.when(F.lower(url).endswith(".pdf"), "document").when(url.startswith("mailto:"), "organizer").when(url.rlike(TICKET), "ticket")
        .when(url.rlike(REGISTRATION) | t.rlike(REGISTRATION), "registration").when(t.rlike(ORGANIZER), "organizer").when(t.rlike(VENUE), "venue").otherwise("other")
    )


def price(c: Column, free: str = FREE, donation: str | None = DONATION) -> Column:
    """struct(price_type, price_from_chf, price_raw): free, donation or paid, with the first CHF amount of paid ones."""
    amount = F.try_to_number(F.replace(extract(c, AMOUNT), F.lit(","), F.lit(".")), F.lit("999999999D99")).cast("decimal(12,2)").cast("double")
    kind = F.when(c.rlike(free), "free")
    if donation is not None:
        kind = kind.when(c.rlike(donation), "donation")
    kind = kind.otherwise("paid")
    return F.when(blank_to_null(c).isNotNull(), F.struct(kind.alias("price_type"), F.when(kind == "paid", amount).alias("price_from_chf"), c.alias("price_raw")))


def age(c: Column) -> Column:
    """struct(age_min, age_max, age_raw) of the first of: range, `bis` range, `Kinder ab`, `ab`; null if none holds. 0 stays."""

    def found(pattern: str, top: bool) -> Column:
        number = lambda g: extract(c, pattern, g).cast("int")
        high = number(2) if top else F.lit(None).cast("int")
        return F.when(c.rlike(pattern), F.struct(number(1).alias("age_min"), high.alias("age_max"), F.regexp_extract(c, pattern, 0).alias("age_raw")))

    return F.coalesce(found(AGE_RANGE, True), found(AGE_TO, True), found(AGE_CHILDREN, False), found(AGE_FROM, False))


def age_of(label: Column, title: Column, description: Column) -> Column:
    """The first age of a labelled field, the title and the first 500 characters of the description."""
    return F.coalesce(age(label), age(title), age(F.substring(description, 1, 500)))


def plausible_organizer(c: Column, least: int = 3, most: int = 80, generic: tuple[str, ...] = ("admin", "administrator", "redaktion", "webmaster")) -> Column:
    """Whether a text can be an organizer's name: of a fair length, no address, URL, phone number or default of a CMS."""
    s = F.coalesce(c, F.lit(""))
    phone = s.rlike(r"^[+\d][\d\s/().-]{6,}$")
    return F.length(s).between(least, most) & ~F.contains(s, F.lit("@")) & ~s.rlike(r"(?i)https?://|www\.") & ~phone & ~F.lower(strip(s)).isin(*generic)


def plausible_venue(c: Column, least: int = 3, most: int = 60) -> Column:
    """Whether a text can be a venue: of a fair length, no time, no `Uhr`, not the name of a hike or a theme."""
    return F.length(c).between(least, most) & ~c.rlike(r"\d{1,2}[:.]\d{2}") & ~c.rlike(r"(?iuU)\bUhr\b") & ~c.rlike(r"(?iuU)^(wanderung|thema|mit|für|von)\b")


def title_venue(title: Column) -> Column:
    """What follows the first ` - ` of a title, if it can be a venue."""
    venue = strip(F.get(F.split(title, r"\s+[-–]\s+", 2), F.lit(1)))
    return F.when(plausible_venue(venue), venue)


def swiss_address(lines: Column) -> Column:
    """struct(prefix, plz, city) of the first of the lines with a postal code of four digits and a capitalized place."""
    pattern = r"(?U)^(?:(.*?),\s*)?(\d{4})\s+(\p{Lu}[\p{L}.\- ]+)$"
    line = F.get(F.filter(lines, lambda x: strip(x).rlike(pattern)), F.lit(0))
    part = lambda g: extract(strip(line), pattern, g)
    return F.when(line.isNotNull(), F.struct(part(1).alias("prefix"), part(2).alias("plz"), part(3).alias("city")))


#: Venues that come again and again in prose, by pattern.
VENUES = {
    r"\bGemeindesaal\s+Zentrum\s+Leue\b": "Gemeindesaal Zentrum Leue, Männedorf", r"\bKirchgemeindehaus\b": "Kirchgemeindehaus, Männedorf",
    r"\bUntervogthaus\b": "Untervogthaus, Männedorf", r"\bKino\s+Wildenmann\b": "Kino Wildenmann, Männedorf",
}


def known_venue(c: Column, venues: dict[str, str] | None = None) -> Column:
    """The name of the first pattern that the text matches; patterns go in the given order."""
    out = F.lit(None).cast("string")
    for pattern, name in reversed(list((VENUES if venues is None else venues).items())):
        out = F.when(c.rlike(f"(?iu){pattern}"), F.lit(name)).otherwise(out)
    return out


def prose_venue(c: Column, nouns: tuple[str, ...] = ("Gemeindehaus", "Kirchgemeindehaus", "Saal", "Schulhaus", "Bibliothek")) -> Column:
    """A venue named in prose: `im`, `ins` or `in` (der, dem) before one of the nouns, with at most 41 more characters after a comma."""
    return extract(c, rf"(?uU)\b(?:im|ins|in(?:\s+(?:der|dem))?)\s+((?:{'|'.join(nouns)})\b(?:,\s*[^.\n]{{1,41}})?)", 1)


def labelled_line(text: Column, labels: tuple[str, ...], ahead: int = 3) -> Column:
    """What stands after a label: on its line, or else the first of the `ahead` lines below that isn't empty."""
    lines = F.transform(F.split(text, r"\r?\n"), strip)
    label = rf"(?iuU)^(?:{'|'.join(labels)})\s*:?\s*"
    at = F.array_position(F.transform(lines, lambda x: x.rlike(label + r"(.*)$")), F.lit(True)).cast("int")
    own = blank_to_null(F.regexp_replace(F.get(lines, at - 1), label, ""))
    below = F.get(F.filter(F.slice(lines, at + 1, F.lit(ahead)), lambda x: x != ""), F.lit(0))
    return F.when(at > 0, F.coalesce(own, below))


def outing_location(title: Column) -> Column:
    """The place of a title such as `Ausflug nach X` or `Ausflug X`."""
    return extract(title, r"(?uU)\bAusflug\s+(?:nach\s+|ins?\s+|auf\s+)?(\p{Lu}[\p{L}\- ]+)", 1)


def event_id_in_url(url: Column) -> Column:
    """The last run of three digits or more in the path."""
    return extract(F.regexp_replace(url, r"[?#].*$", ""), r"(\d{3,})(?!.*\d{3,})", 1)


def date_in_url(url: Column) -> Column:
    """The first ISO date in a URL, as a date; null if it isn't one."""
    return F.try_to_date(extract(url, r"(\d{4}-\d{2}-\d{2})", 1), "yyyy-MM-dd")


def duration_minutes(c: Column) -> Column:
    """Minutes of `dauert H:MM`."""
    pattern = r"(?iu)dauert\s+(?:ca\.\s*)?(\d{1,2}):(\d{2})"
    return extract(c, pattern, 1).cast("int") * 60 + extract(c, pattern, 2).cast("int")


def showtimes(c: Column) -> Column:
    """All times HH:MM or HH.MM of a text, in order, as HH:MM."""
    return F.transform(F.regexp_extract_all(c, F.lit(r"\b(\d{1,2}[:.]\d{2})\b"), F.lit(1)), lambda t: F.lpad(F.replace(t, F.lit("."), F.lit(":")), 5, "0"))


def truncated(c: Column, n: int) -> Column:
    return F.substring(c, 1, n)
