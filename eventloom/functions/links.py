"""URLs, links and pages."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .text import blank_to_null, extract

#: Schemes and hosts of links that lead to no page, and pages that block a reader.
NO_PAGE = r"(?i)^(mailto|tel|javascript):"
ASSET_HOSTS = ("cdn.", "fonts.", "static.")
BLOCKED_STATUS = (403, 429, 503)
BLOCKED = (
    r"challenges\.cloudflare\.com",
    r"<title>\s*Just a moment\.\.\.\s*</title>",
    r"<title>\s*Access Denied\s*</title>",
    r"<title>\s*403\s+Forbidden\s*</title>",
    r"<title>\s*502\s+Bad Gateway\s*</title>",
    r"<title>\s*503\s+Service\b.*?Unavailable\s*</title>",
)
SKIPPED_IMAGE = (
    r"(?iu)(logo|icon|avatar|badge|sprite|pixel|tracking|spacer|button|favicon|spinner|loader|arrow|chevron|breadcrumb|pfeil|nav[_-]"
    r"|bullet|separator|divider|bg[_-]|background)"
)


def host(url: Column) -> Column:
    """Host with port and user as written, lower-cased; empty without one. Hosts that aren't ASCII count too."""
    return F.lower(F.regexp_extract(url, r"^(?:[a-zA-Z][a-zA-Z0-9+.-]*:)?//([^/?#]*)", 1))


def bare(url: Column) -> Column:
    """Without query and fragment."""
    return F.regexp_replace(url, r"[?#].*$", "")


def _collapsed(path: Column) -> Column:
    """A path without its `.` and `..` segments; `..` never leaves the root."""
    parts = F.split(path, "/")
    empty = F.array().cast("array<string>")

    def step(kept: Column, part: Column) -> Column:
        up = F.when(F.size(kept) > 1, F.slice(kept, F.lit(1), F.size(kept) - 1)).otherwise(kept)
        return F.when(part == "..", up).when(part == ".", kept).otherwise(F.concat(kept, F.array(part)))

    kept = F.aggregate(parts, empty, step)
    directory = path.rlike(r"(^|/)\.{1,2}$")
    return F.concat(F.array_join(kept, "/"), F.when(directory & ~F.array_join(kept, "/").endswith("/"), F.lit("/")).otherwise(F.lit("")))


def resolve(base: Column, href: Column) -> Column:
    """href against the page's URL as browsers do: absolute, scheme-relative, rooted, query, fragment and relative forms."""
    h = F.trim(href)
    scheme = F.regexp_extract(base, r"^([a-zA-Z][a-zA-Z0-9+.-]*:)", 1)
    root = F.regexp_extract(base, r"^([a-zA-Z][a-zA-Z0-9+.-]*://[^/?#]*)", 1)
    path = F.regexp_extract(bare(base), r"^[a-zA-Z][a-zA-Z0-9+.-]*://[^/]*(/.*)?$", 1)
    folder = F.coalesce(blank_to_null(F.regexp_replace(path, r"[^/]*$", "")), F.lit("/"))
    own = F.regexp_extract(h, r"^([^?#]*)", 1)
    rest = F.regexp_extract(h, r"^[^?#]*(.*)$", 1)
    return (
        F.when(h.rlike(r"^[a-zA-Z][a-zA-Z0-9+.-]*:"), h)
        .when(h.startswith("//"), F.concat(scheme, h))
        .when(h == "", base)
        .when(h.startswith("#"), F.concat(F.regexp_replace(base, r"#.*$", ""), h))
        .when(h.startswith("?"), F.concat(bare(base), h))
        .when(h.startswith("/"), F.concat(root, _collapsed(own), rest))
        .otherwise(F.concat(root, _collapsed(F.concat(folder, own)), rest))
    )


def is_external(page: Column, href: Column) -> Column:
    """Whether a link leads to a page of another host that doesn't only serve assets."""
    h = F.trim(href)
    to = host(resolve(page, h))
    asset = F.lit(False)
    for prefix in ASSET_HOSTS:
        asset |= to.startswith(prefix)
    return (h != "") & ~h.startswith("#") & ~h.rlike(NO_PAGE) & (to != "") & (to != host(page)) & ~asset


def is_pdf(href: Column, text: Column) -> Column:
    return F.lower(F.trim(href)).endswith(".pdf") | F.contains(F.lower(F.coalesce(text, F.lit(""))), F.lit("pdf"))


def is_blocked(status: Column | None, body: Column) -> Column:
    """Whether a response is a block or an error page: by its status or its first 5,000 characters. 404 is normal."""
    head, out = F.substring(F.coalesce(body, F.lit("")), 1, 5000), F.lit(False)
    for pattern in BLOCKED:
        out |= head.rlike(f"(?iu){pattern}")
    return out | F.coalesce(status.isin(*BLOCKED_STATUS), F.lit(False)) if status is not None else out


def is_picture(src: Column, alt: Column, names: Column, width: Column, height: Column, least: int = 100) -> Column:
    """Whether an image shows something: no inline data, none of the names of decoration, no stated side under `least`."""
    words = F.concat_ws(" ", src, alt, names)
    side = lambda c: F.coalesce(extract(c, r"^(\d{1,9})(?:px)?$").cast("int") < least, F.lit(False))
    return (F.coalesce(src, F.lit("")) != "") & ~src.startswith("data:") & ~words.rlike(SKIPPED_IMAGE) & ~side(width) & ~side(height)


def date_window(url: Column, today: Column, days: int = 365) -> Column:
    """A listing URL with datumVon and datumBis for the days from `today`, those it had replaced."""
    kept = F.regexp_replace(url, r"(?<=[?&])(datumVon|datumBis)=[^&#]*&?", "")
    kept = F.regexp_replace(kept, r"[?&]+$", "")
    joint = F.when(F.contains(kept, F.lit("?")), F.lit("&")).otherwise(F.lit("?"))
    return F.concat(kept, joint, F.lit("datumVon="), F.date_format(today, "dd.MM.yyyy"), F.lit("&datumBis="), F.date_format(F.date_add(today, days), "dd.MM.yyyy"))
