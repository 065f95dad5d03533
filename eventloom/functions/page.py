"""Fields of a detail page, from the struct that sources.dom.read gives."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from . import dates as D
from . import links as L
from . import records as R
from . import text as T

PRICE_LABELS = ("Preis", "Kosten", "Eintritt", "Preis / Eintritt")
AGE_LABELS = ("Alter", "Zielgruppe", "Altersstufe", "Age")
REGISTRATION_LABELS = ("Anmeldung", "Anmelden", "Registration", "Booking", "Teilnahme")
ORGANIZER_LABELS = ("Veranstalter", "Veranstalterin", "Organisator", "Organisatorin", "Organisation")


def first_of(array: Column, function) -> Column:
    """The function of the first member for which it isn't null."""
    return F.get(F.filter(F.transform(array, function), lambda x: x.isNotNull()), F.lit(0))


def labelled(page: Column, labels: tuple[str, ...]) -> Column:
    """The first field of the first of these labels that the page has; of equal labels the last counts."""
    return F.coalesce(*[_last(page, n) for n in labels])


def _last(page: Column, name: str) -> Column:
    found = F.filter(page["fields"], lambda f: f["label"] == name)
    return F.get(found, F.size(found) - 1)


def title(page: Column, suffix: str | None = None) -> Column:
    own = T.without_suffix(page["title"], suffix) if suffix else page["title"]
    return F.coalesce(page["h1"], page["og_title"], own)


def description(page: Column, most: int = 4000) -> Column:
    long = lambda c: F.when(F.length(c) > 20, c)
    return T.truncated(F.coalesce(page["content"], long(page["og_description"]), long(page["description"])), most)


def listed_events(page: Column) -> Column:
    """All events of the page's JSON-LD. Functions that take `events` compute them where they aren't given."""
    return F.flatten(F.transform(page["jsonld"], lambda d: R.events(d)))


def image(page: Column, url: Column, events: Column | None = None) -> Column:
    listed = first_of(events if events is not None else listed_events(page), lambda e: F.coalesce(R.text_field(e, "$.image"), R.text_field(e, "$.image[0]"), R.text_field(e, "$.image.url"), R.text_field(e, "$.image[0].url")))
    shown = first_of(page["images"], lambda i: F.when(L.is_picture(i["src"], i["alt"], i["classes"], i["width"], i["height"]), i["src"]))
    return L.resolve(url, F.coalesce(page["og_image"], listed, shown))


def when(page: Column, clock: Column, events: Column | None = None) -> Column:
    """struct(datetime_raw, method): JSON-LD, else a time element (those of the article first), else ISO times in the text."""
    data = R.time_of(events if events is not None else listed_events(page))
    inside, every = F.filter(page["container_times"], D.looks_like_date), F.filter(page["times"], D.looks_like_date)
    element = D.nearest_future(F.when(F.size(inside) > 0, inside).otherwise(every), clock)
    written = D.iso_in_text(F.array_join(page["lines"], " "))

    def of(found: Column) -> Column:
        method = F.when(found["data"].isNotNull(), "jsonld").when(found["element"].isNotNull(), "time_element").when(found["written"].isNotNull(), "iso_text").otherwise("none")
        return F.struct(F.coalesce(found["data"], found["element"], found["written"]).alias("datetime_raw"), method.alias("method"))

    return R.bound(F.struct(data.alias("data"), element.alias("element"), written.alias("written")), of)


def price(page: Column, events: Column | None = None) -> Column:
    return F.coalesce(T.price(labelled(page, PRICE_LABELS)["text"]), R.price_of(events if events is not None else listed_events(page)))


def age(page: Column) -> Column:
    return T.age_of(labelled(page, AGE_LABELS)["text"], title(page), description(page))


def registration(page: Column) -> Column:
    """struct(registration_raw, registration_url): a labelled field, or else the first link that registers."""
    field = labelled(page, REGISTRATION_LABELS)
    by_field = F.when(field.isNotNull(), F.struct(field["text"].alias("registration_raw"), F.get(field["links"], F.lit(0)).alias("registration_url")))

    def by_link(a: Column) -> Column:
        fits = ~a["href"].rlike(r"(?i)^(#|mailto:|tel:|javascript:|$)") & (a["href"].rlike(T.REGISTRATION_DETAIL) | a["text"].rlike(T.REGISTRATION_DETAIL))
        return F.when(fits, F.struct(F.coalesce(T.blank_to_null(a["text"]), F.lit("Anmeldung")).alias("registration_raw"), a["href"].alias("registration_url")))

    return F.coalesce(by_field, first_of(page["links"], by_link))


def category(page: Column, events: Column | None = None) -> Column:
    data = first_of(events if events is not None else listed_events(page), lambda e: F.coalesce(R.named(e, "$.eventCategory"), R.named(e, "$.about")))
    return F.coalesce(data, T.blank_to_null(F.array_join(page["categories"], ", ")))


def location(page: Column, events: Column | None = None) -> Column:
    listed = first_of(events if events is not None else listed_events(page), lambda e: R.named(e, "$.location"))
    return F.coalesce(listed, T.swiss_address(page["lines"])["prefix"], T.labelled_line(F.array_join(page["lines"], "\n"), ("Ort", "Wo", "Veranstaltungsort")), T.title_venue(title(page)))


def organizer(page: Column, events: Column | None = None) -> Column:
    listed = first_of(events if events is not None else listed_events(page), lambda e: R.named(e, "$.organizer"))
    field = labelled(page, ORGANIZER_LABELS)["text"]
    line = T.labelled_line(F.array_join(page["lines"], "\n"), ("Veranstalter(?:in)?", "Organisator(?:in)?"))
    found = F.coalesce(page["address"]["name"], listed, field, line, page["author"])
    return F.when(T.plausible_organizer(found), found)


def surfaces(page: Column, url: Column) -> Column:
    """struct(pdf_urls, pdf_count, external_links, external_link_count); first occurrences in page order."""
    full = F.transform(page["links"], lambda a: F.struct(L.resolve(url, a["href"]).alias("url"), a["text"].alias("text"), a["href"].alias("href")))
    pdfs = F.array_distinct(F.transform(F.filter(full, lambda a: L.is_pdf(a["href"], a["text"])), lambda a: a["url"]))
    out = F.filter(full, lambda a: L.is_external(url, a["href"]))
    urls = F.transform(out, lambda a: a["url"])
    first = F.filter(out, lambda a, i: F.array_position(urls, a["url"]) == i + 1)
    external = F.transform(first, lambda a: F.struct(a["url"].alias("url"), a["text"].alias("text")))
    return F.struct(pdfs.alias("pdf_urls"), F.size(pdfs).alias("pdf_count"), external.alias("external_links"), F.size(external).alias("external_link_count"))


def link_summary(links: Column) -> Column:
    """struct(classes, registration_url, organizer_url) of an array of (url, text): counts by class, and the first URLs."""
    kinds = F.transform(links, lambda a: T.link_class(a["url"], a["text"]))
    names = ("document", "organizer", "other", "registration", "ticket", "venue")
    times = lambda name: F.size(F.filter(kinds, lambda k: k == name))
    counts = F.map_filter(F.map_from_arrays(F.array(*[F.lit(n) for n in names]), F.array(*[times(n) for n in names])), lambda _, v: v > 0)
    first = lambda kind: F.get(F.transform(F.filter(links, lambda a: T.link_class(a["url"], a["text"]) == kind), lambda a: a["url"]), F.lit(0))
    return F.struct(counts.alias("classes"), first("registration").alias("registration_url"), first("organizer").alias("organizer_url"))


def details(page: Column, url: Column, clock: Column) -> Column:
    """A struct of all fields of a detail page; its JSON-LD is read once."""

    def of(events: Column) -> Column:
        found = {
            "title_raw": title(page), "time": when(page, clock, events), "location_raw": location(page, events), "description_raw": description(page), "organizer_name": organizer(page, events),
            "image_url": image(page, url, events), "price": price(page, events), "age": age(page), "registration": registration(page), "category_raw": category(page, events), "surfaces": surfaces(page, url),
        }
        return F.struct(*[c.alias(n) for n, c in found.items()])

    return R.bound(listed_events(page), of)
