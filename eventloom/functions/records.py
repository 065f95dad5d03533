"""JSON-LD, extra fields and iCalendar."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .text import blank_to_null, extract, strip


def bound(value: Column, function) -> Column:
    """The function of a value that is computed once, however often the function uses it."""
    return F.get(F.transform(F.array(value), function), F.lit(0))


def variant(c: Column) -> Column:
    """Parsed JSON, or null if it isn't JSON."""
    return F.try_parse_json(c)


def kind(v: Column) -> Column:
    """STRING, BIGINT, DOUBLE, DECIMAL, BOOLEAN, ARRAY, OBJECT or VOID; null for no value."""
    return F.regexp_extract(F.schema_of_variant(v), r"^(\w+)", 1)


def typed(v: Column, path: str, name: str, kinds: tuple[str, ...]) -> Column:
    """A field of a given JSON type; null if it is absent or of another type: values are never converted between types."""
    found = F.try_variant_get(v, path, "variant")
    return F.when(kind(found).isin(*kinds), F.try_variant_get(v, path, name))


def text_field(v: Column, path: str) -> Column:
    return blank_to_null(strip(typed(v, path, "string", ("STRING",))))


def number_field(v: Column, path: str) -> Column:
    return typed(v, path, "double", ("BIGINT", "DECIMAL", "DOUBLE", "FLOAT"))


def whole_field(v: Column, path: str) -> Column:
    """A whole number; numbers with a fraction are null rather than cut."""
    found = number_field(v, path)
    return F.when(found == F.floor(found), found.cast("int"))


def items(v: Column) -> Column:
    """What a JSON document holds at its top: a list's members, or itself."""
    listed = F.try_variant_get(v, "$", "array<variant>")
    return F.when(kind(v) == "ARRAY", listed).otherwise(F.array(v))


def _is_event(v: Column) -> Column:
    one = F.try_variant_get(v, "$['@type']", "variant")
    many = F.try_variant_get(v, "$['@type']", "array<string>")
    return F.when(kind(one) == "STRING", F.try_variant_get(v, "$['@type']", "string") == "Event").when(kind(one) == "ARRAY", F.array_contains(many, "Event")).otherwise(F.lit(False))


def events(document: Column, depth: int = 3) -> Column:
    """All Event objects of a JSON-LD text, in order: top-level ones, in lists, and in @graph, `depth` graphs deep."""

    def of(v: Column, level: int) -> Column:
        own = F.when(F.coalesce(_is_event(v), F.lit(False)), F.array(v)).otherwise(F.array().cast("array<variant>"))
        if level == 0:
            return own
        graph = F.coalesce(F.try_variant_get(v, "$['@graph']", "array<variant>"), F.array().cast("array<variant>"))
        return F.concat(own, F.flatten(F.transform(graph, lambda g: of(g, level - 1))))

    top = items(variant(document))
    return F.coalesce(F.flatten(F.transform(top, lambda v: of(v, depth))), F.array().cast("array<variant>"))


def event_time(document: Column) -> Column:
    """`start` or `start | end` of the first event with a start, as text for the date parser."""
    return time_of(events(document))


def time_of(found: Column) -> Column:
    e = F.get(F.filter(found, lambda e: text_field(e, "$.startDate").isNotNull()), F.lit(0))
    return blank_to_null(F.concat_ws(" | ", text_field(e, "$.startDate"), text_field(e, "$.endDate")))


def event_price(document: Column) -> Column:
    """struct(price_type, price_from_chf, price_raw) of the first offer whose price is a number; 0 is free."""
    return price_of(events(document))


def price_of(found: Column) -> Column:
    def offers(e: Column) -> Column:
        v = F.try_variant_get(e, "$.offers", "variant")
        return F.when(v.isNotNull(), items(v)).otherwise(F.array().cast("array<variant>"))

    amount = lambda o: F.try_variant_get(o, "$.price", "double")
    offer = F.get(F.filter(F.flatten(F.transform(found, offers)), lambda o: amount(o).isNotNull()), F.lit(0))

    def of(o: Column) -> Column:
        raw = F.concat_ws(" ", F.coalesce(F.try_variant_get(o, "$.priceCurrency", "string"), F.lit("CHF")), F.try_variant_get(o, "$.price", "string"))
        free = amount(o) == 0
        return F.when(amount(o).isNotNull(), F.struct(F.when(free, "free").otherwise("paid").alias("price_type"), F.when(~free, amount(o)).alias("price_from_chf"), raw.alias("price_raw")))

    return bound(offer, of)


def named(v: Column, path: str) -> Column:
    """A text, an object's name, or the texts and names of a list joined by commas."""
    found = F.try_variant_get(v, path, "variant")
    one = lambda x: F.coalesce(text_field(x, "$"), text_field(x, "$.name"))
    many = F.array_join(F.filter(F.transform(F.try_variant_get(v, path, "array<variant>"), one), lambda x: x.isNotNull()), ", ")
    return F.when(kind(found) == "ARRAY", blank_to_null(many)).otherwise(one(found))


def organizer_name(extra: Column) -> Column:
    """The first of six shapes that isn't empty: nested names, flat keys, plain texts; British spelling before American."""
    paths = ("$.organiser.name", "$.organizer.name", "$.organiser_name", "$.organizer_name", "$.organiser", "$.organizer")
    return F.coalesce(*[text_field(extra, p) for p in paths])


def topic_tags(extra: Column, topics: dict[str, str]) -> Column:
    """The topics, in order, whose pattern occurs in category_raw, ics_category or categories, lower-cased."""
    listed = F.coalesce(typed(extra, "$.categories", "array<string>", ("ARRAY",)), F.array().cast("array<string>"))
    text = F.lower(F.concat_ws(" ", text_field(extra, "$.category_raw"), text_field(extra, "$.ics_category"), listed))
    return F.filter(F.array(*[F.when(text.rlike(f"(?iu){pattern}"), F.lit(name)) for name, pattern in topics.items()]), lambda x: x.isNotNull())


def extra_columns(extra: Column) -> dict[str, Column]:
    """The columns that consumers read from extra; wrong types and absent keys are null."""
    return {
        "image_url": text_field(extra, "$.image_url"),
        "organizer_name": organizer_name(extra),
        "price_type": F.when(text_field(extra, "$.price_type").isin("free", "paid", "donation"), text_field(extra, "$.price_type")),
        "price_from_chf": number_field(extra, "$.price_from_chf"),
        "age_min": whole_field(extra, "$.age_min"),
        "age_max": whole_field(extra, "$.age_max"),
        "registration_url": F.coalesce(text_field(extra, "$.registration_url"), text_field(extra, "$.registration_url_from_links")),
    }


def merged(*maps: Column) -> Column:
    """Sparse maps joined; of equal keys the last map's value counts, null values don't. Zero and false do."""
    held = [F.map_filter(m, lambda _, v: v.isNotNull()) for m in maps]
    keys = F.array_distinct(F.flatten(F.array(*[F.map_keys(m) for m in held])))
    value = lambda k: F.coalesce(*[F.try_element_at(m, k) for m in reversed(held)])
    return F.map_from_entries(F.transform(keys, lambda k: F.struct(k, value(k))))


# iCalendar


def unfolded(ics: Column) -> Column:
    """With lines that continue on the next joined."""
    return F.regexp_replace(ics, r"\r?\n[ \t]", "")


def vevent(ics: Column) -> Column:
    """The inside of the first event, which keeps a zone's own dates out."""
    return extract(unfolded(ics), r"(?s)BEGIN:VEVENT\r?\n(.*?)END:VEVENT", 1)


def ics_field(event: Column, name: str) -> Column:
    """A field's value, whatever parameters it has."""
    return blank_to_null(strip(F.regexp_extract(event, rf'(?m)^{name}(?:;(?:[^":\r\n]|"[^"]*")+)?:(.*)$', 1)))


def ics_parameter(event: Column, name: str, parameter: str) -> Column:
    found = F.regexp_extract(event, rf'(?m)^{name};(?:(?:[^":\r\n]|"[^"]*")*;)?{parameter}=("[^"]*"|[^;:\r\n]+)', 1)
    return blank_to_null(strip(F.regexp_replace(found, '^"|"$', "")))


def unescaped(c: Column) -> Column:
    r"""`\n`, `\,`, `\;` and `\\` decoded in one pass, so that an escaped backslash never joins what follows it."""
    mark = "\u0001"
    s = F.replace(c, F.lit("\\\\"), F.lit(mark))
    s = F.regexp_replace(s, r"\\[nN]", "\n")
    return F.replace(F.regexp_replace(s, r"\\([,;])", "$1"), F.lit(mark), F.lit("\\"))


def ics_organizer(event: Column) -> Column:
    """struct(name, email)."""
    name = ics_parameter(event, "ORGANIZER", "CN")
    email = extract(ics_field(event, "ORGANIZER"), r"(?i)^mailto:(.+)$", 1)
    return F.when(name.isNotNull() | email.isNotNull(), F.struct(name.alias("name"), email.alias("email")))


#: Categories of one parish's calendar.
INCLUDED = ("Für alle", "chile für chind", "jugend. kirche.", "Familien", "Gottesdienste - Mitenand")
REVIEWED = ("Gottesdienste - Grenzenlos", "Gottesdienste - Highfive", "Kulturelles")


def relevance(category: Column, included: tuple[str, ...] = INCLUDED, reviewed: tuple[str, ...] = REVIEWED) -> Column:
    """include, review (also without a category) or exclude."""
    c = F.coalesce(category, F.lit(""))
    return F.when(c == "", "review").when(c.isin(*included), "include").when(c.isin(*reviewed), "review").otherwise("exclude")
