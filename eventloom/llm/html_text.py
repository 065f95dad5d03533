"""Main text of HTML pages, by deduction of each host's template from equivalence classes of tokens.

A token is a place (the tags and classes from the root to an open element) or a text at a place. The occurrence vector of
a token over the distinct pages of its host is kept as sums that don't depend on order; tokens with equal vectors form a
class. A class is valid if its tokens come in the same order on every page and the class's instances nest with those of the
others; valid classes nest into the host's template. Texts in it are fixed and go. The places that hold other texts
are its slots, and each slot is decided once for the host, by all of its pages: by the marks of the places it is nested in, by
the share of links in what it holds, and, where these don't tell, by how its places are named. The text is what the kept slots hold.
"""

from __future__ import annotations

import re
from collections import Counter, defaultdict
from html import unescape

import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import on_arrow, stored

#: Share of a host's pages, and number of them, that a template token must be in. The share bounds a host's template by
#: sixteen times the tokens of its mean page.
SUPPORT, PAGES = 1 / 16, 3
#: Share of links in what a slot outside of articles holds from which it is navigation.
LINKS = 0.6
#: Share of the text of its pages from which a place is no aside, whatever its name.
MOST = 0.9

#: Elements by their role in HTML.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style noscript iframe template svg math textarea title xmp object canvas audio video".split())
INLINE = frozenset("a abbr acronym b bdi bdo big cite code data del dfn em font i ins kbd label mark q rp rt ruby s samp small span strike strong sub sup time tt u var wbr br img".split())
CLOSES = {
    "li": frozenset(["li"]), "dt": frozenset(["dt", "dd"]), "dd": frozenset(["dt", "dd"]), "tr": frozenset(["tr", "td", "th"]), "td": frozenset(["td", "th"]),
    "th": frozenset(["td", "th"]), "option": frozenset(["option"]), "thead": frozenset(["tr", "td", "th"]), "tbody": frozenset(["thead", "tr", "td", "th"]), "tfoot": frozenset(["tbody", "tr", "td", "th"]),
}
#: An element of these closes nothing outside of it.
SCOPES = frozenset("table ul ol dl td th article main body section aside nav select".split())
MAIN_TAGS = frozenset(["article", "main"])
OUT_TAGS = frozenset("nav aside footer form button select menu dialog head".split())
OUT_ROLES = frozenset("navigation banner contentinfo complementary search dialog alert menu menubar form".split())
#: Words in classes and ids that name what isn't the article, and words that may stand beside them.
OUT_NAMES = frozenset(
    "ad ads adv advert adverts advertisement advertisements adsense sponsor sponsored sponsors promo promotion promotions nav navbar navigation menu menus breadcrumb breadcrumbs "
    "sidebar sidebars footer cookie cookies consent gdpr notice notices popup modal overlay newsletter subscribe subscription signup login share sharing social related "
    "recommended recommendations comment comments commentlist disqus respond replies reply pagination pager toolbar widget widgets skip search".split()
)
BESIDE = frozenset(
    "area article articles bar block body bottom box button buttons container content count desktop field fields form global group header inner item items left link links list main "
    "media mobile outer page panel post posts primary reader right row secondary section site slot sticky stories text title top unit user wrap wrapper".split()
)
#: Such words that only count outside of an article.
OUT_HEADS = frozenset("header masthead banner topbar".split())

TAG = re.compile(r"""<!--.*?(?:-->|\Z)|<[!?][^>]*+>|<(/?)([a-zA-Z][^\s/>]*+)((?:[^>"']++|"[^"]*+"|'[^']*+')*+)>|<(/?)([a-zA-Z][^\s/>]*+)([^>]*+)>""", re.S)
ATTRIBUTE = re.compile(r"""(class|id|role|hidden)\s*(?:=\s*(?:"([^"]*)"|'([^']*)'|([^\s>"']+)))?""", re.I)
NAME = re.compile(r"[A-Z]?[a-z]+|[A-Z]+(?![a-z])|\d+")


def _token(text: str) -> int:
    h = xxhash.xxh3_64_intdigest(text.encode("utf-8", "surrogatepass"))
    return h - (1 << 64) if h >> 63 else h


def named(name: str, words: frozenset[str]) -> bool:
    """Whether a class or id is made of such words alone, but for numbers and words that say nothing: not if they are part of a topic."""
    found = [w.lower() for w in NAME.findall(name)]
    return any(w in words for w in found) and all(w in words or w in BESIDE or w.isdigit() for w in found)


class Place:
    """An open element: its tag and token, whether it is in an article or in what HTML marks as none, and the token of the outermost place named so."""

    __slots__ = ("article", "name", "out", "tag", "token")

    def __init__(self, tag: str, token: int, article: bool, out: bool, name: int):
        self.tag, self.token, self.article, self.out, self.name = tag, token, article, out, name


def _opened(tag: str, attributes: str, above: Place) -> Place:
    names: list[str] = []
    role, hidden = "", False
    if attributes and attributes.strip():
        for key, a, b, c in ATTRIBUTE.findall(attributes):
            key, value = key.lower(), a or b or c
            if key == "role":
                role = value.lower()
            elif key == "hidden":
                hidden = True
            else:
                names += value.split()
    article = above.article or tag in MAIN_TAGS or role == "main"
    out = above.out or hidden or tag in OUT_TAGS or role in OUT_ROLES or (tag == "header" and not above.article)
    # what names a single page is none of its place
    whole = tag in MAIN_TAGS or tag in ("html", "body")
    label = "" if whole else re.sub(r"[0-9]{3,}", "#", ".".join(names))
    place = Place(tag, _token(f"{above.token}/{tag}.{label}.{role}.{hidden}"), article, out, above.name)
    if not place.name and not whole and any(named(n, OUT_NAMES) or (not above.article and named(n, OUT_HEADS)) for n in names):
        place.name = place.token
    return place


class Block:
    """A text without mark-up: its own token, its place, and how many of its characters are links'."""

    __slots__ = ("linked", "place", "text", "token")

    def __init__(self, text: str, place: Place, linked: int):
        self.text, self.place, self.linked = text, place, min(linked, len(text))
        self.token = _token(f"{place.token}|{text}")


def parsed(html: str | None) -> list[Place | Block]:
    """The places that a page opens and the blocks of text in them, in order.

    Unclosed and crossed elements, comments, raw elements without end and stray brackets are read as browsers would in kind.
    """
    out: list[Place | Block] = []
    if not html:
        return out
    stack = [Place("", 0, False, False, 0)]
    held: list[str] = []
    linked, links = 0, 0

    def flush() -> None:
        nonlocal linked
        if held:
            text = " ".join(unescape("".join(held)).split())
            held.clear()
            if text:
                out.append(Block(text, stack[-1], linked))
        linked = 0

    def close(tags: frozenset[str]) -> None:
        """Closes the innermost open element of these tags, unless an element that confines them is between."""
        for k in range(len(stack) - 1, 0, -1):
            if stack[k].tag in tags:
                del stack[k:]
                return
            if stack[k].tag in SCOPES:
                return

    at, n = 0, len(html)
    while at < n:
        found = TAG.search(html, at)
        if found is None:
            held.append(html[at:])
            linked += (n - at) * (links > 0)
            break
        if found.start() > at:
            held.append(html[at : found.start()])
            linked += (found.start() - at) * (links > 0)
        at = found.end()
        ending, tag, attributes = (found[1], found[2], found[3]) if found[2] else (found[4], found[5], found[6])
        if not tag:
            continue
        tag = tag.lower()
        if ending:
            if tag == "a":
                links = max(0, links - 1)
            if tag in INLINE and not any(p.tag == tag for p in stack):
                continue
            flush()
            for k in range(len(stack) - 1, 0, -1):
                if stack[k].tag == tag:
                    del stack[k:]
                    break
            continue
        if tag in RAW:
            if tag not in ("svg", "math") or not attributes.endswith("/"):
                end = re.compile(rf"</{tag}\b[^>]*>", re.I).search(html, at)
                at = end.end() if end else n
            held.append(" ")
            continue
        if tag == "a":
            links += 1
        if tag in INLINE:
            if tag == "br":
                held.append(" ")
            elif attributes and ("class" in attributes or "id" in attributes or "hidden" in attributes) and tag not in VOID:
                place = _opened(tag, attributes, stack[-1])
                if (place.out and not stack[-1].out) or (place.name and not stack[-1].name):
                    flush()
                    stack.append(place)
                    out.append(place)
            continue
        flush()
        links = 0
        if tag in VOID:
            continue
        if tag in CLOSES:
            close(CLOSES[tag])
        else:
            close(frozenset(["p"]))  # what isn't inline doesn't stand in a paragraph
        place = _opened(tag, attributes, stack[-1])
        stack.append(place)
        out.append(place)
    flush()
    return out


def host_of(url: str):
    """The host of a URL, lower-cased, without user and port; null if there is none."""
    return F.nullif(F.lower(F.regexp_extract(F.col(url), r"^[a-zA-Z][a-zA-Z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:]+)", 1)), F.lit(""))


class Slot:
    """What one place says, on a page or on all pages of a host."""

    __slots__ = ("article", "chars", "linked", "name", "out")

    def __init__(self, article: bool, out: bool, name: int, chars: int = 0, linked: int = 0):
        self.article, self.out, self.name, self.chars, self.linked = article, out, name, chars, linked

    def kept(self, share: float, links: float | None = None) -> bool:
        """Whether the slot is the article's; `share` is that of the place it is named by, `links` that of links around it."""
        if self.out or (self.name and share < MOST):
            return False
        return self.article or max(links or 0, self.linked / self.chars if self.chars else 0) <= LINKS


def page_slots(items: list[Place | Block]) -> tuple[dict[int, Slot], dict[int, int], int]:
    """The slots of a page by place, the characters under each outermost named place, and those of all that isn't marked as out."""
    slots: dict[int, Slot] = {}
    under: Counter = Counter()
    whole = 0
    for x in items:
        p = x.place if isinstance(x, Block) else x
        slot = slots.setdefault(p.token, Slot(p.article, p.out, p.name))
        if isinstance(x, Block):
            slot.chars += len(x.text)
            slot.linked += x.linked
            if not p.out:
                whole += len(x.text)
                if p.name:
                    under[p.name] += len(x.text)
    return slots, under, whole


_TOKEN = "token:bigint,text:boolean,place:bigint,times:int,at:int,chars:bigint,linked:bigint,article:boolean,out:boolean,name:bigint,under:bigint,whole:bigint"


def _tokens(html: str | None) -> dict:
    """The distinct tokens of a page with what its slots say, and all of them in order."""
    items = parsed(html)
    slots, under, whole = page_slots(items)
    order = [x.token for x in items]
    found: dict[int, dict] = {}
    for at, x in enumerate(items):
        t = found.get(x.token)
        if t is not None:
            t["times"] += 1
            continue
        text = isinstance(x, Block)
        p = x.place if text else x
        slot = slots[p.token]
        chars, linked = (len(x.text), x.linked) if text else (slot.chars, slot.linked)
        mine = not text and p.name == p.token
        found[x.token] = {
            "token": x.token, "text": text, "place": p.token, "times": 1, "at": at, "chars": chars, "linked": linked, "article": p.article, "out": p.out, "name": p.name,
            "under": under[p.name] if mine else 0, "whole": whole if mine else 0,
        }
    return {"tokens": list(found.values()), "order": order}


def page_tokens(df: DataFrame, id_col: str = "page_id", url: str = "url", html: str = "html") -> DataFrame:
    """host, page (a hash of its HTML), tokens and order of each distinct page with tokens. Copies of a page on a host are one page: they say nothing of a template."""

    def make():
        def apply(hosts, pages, texts):
            found = [_tokens(t) for t in texts]
            return {"host": hosts, "page": pages, "tokens": [x["tokens"] for x in found], "order": [x["order"] for x in found]}

        return apply

    schema = f"host string, page bigint, tokens array<struct<{_TOKEN}>>, order array<bigint>"
    every = on_arrow(df, [host_of(url), F.xxhash64(html), F.col(html)], make, schema).filter(F.size("order") > 0)
    return every.groupBy("host", "page").agg(F.any_value(F.struct("tokens", "order")).alias("x")).select("host", "page", "x.tokens", "x.order")


def page_blocks(df: DataFrame, id_col: str = "page_id", url: str = "url", html: str = "html") -> DataFrame:
    """page_id, url, host and blocks of each page, in order; `kept` is what the page alone says of a block."""
    kind = df.schema[id_col].dataType.simpleString()

    def of(text):
        items = parsed(text)
        slots, under, whole = page_slots(items)
        kept = {t: s.kept(under[s.name] / whole if s.name and whole else 0) for t, s in slots.items()}
        return [
            {"token": x.token, "place": x.place.token, "text": x.text, "article": x.place.article, "free": not x.place.out and not x.place.name, "kept": kept[x.place.token]}
            for x in items if isinstance(x, Block)
        ]

    def make():
        return lambda keys, urls, hosts, texts: {"page_id": keys, "url": urls, "host": hosts, "blocks": [of(t) for t in texts]}

    schema = f"page_id {kind}, url string, host string, blocks array<struct<token:bigint,place:bigint,text:string,article:boolean,free:boolean,kept:boolean>>"
    return on_arrow(df, [F.col(id_col), F.col(url), host_of(url), F.col(html)], make, schema)


def classes(pages: DataFrame, support: float = SUPPORT, least: int = PAGES) -> DataFrame:
    """host, pages and tokens of each host, each token with its class: the same for tokens of equal occurrence vectors.

    A vector is kept as the number of pages, the occurrences and two sums of 31 bits of a hash of page and occurrences.
    Only tokens on `least` pages or more and on a share `support` of the host's count (all tokens on hosts of fewer pages).
    `rank` orders a class's tokens as they first come on the page of least hash.
    """
    every = pages.groupBy(F.col("host").alias("_host")).agg(F.count(F.lit(1)).alias("pages"))
    token = pages.select("host", "page", F.explode("tokens").alias("t")).select("host", "page", "t.*")
    h = F.xxhash64("page", "times")
    part = lambda k: F.sum(F.shiftrightunsigned(h, k).bitwiseAND(F.lit(0x7FFFFFFF)))
    sums = {c: F.sum(c).alias(c) for c in ("times", "chars", "linked", "under", "whole")}
    marks = [F.any_value(c).alias(c) for c in ("text", "place", "article", "out", "name")]
    vectors = token.groupBy("host", "token").agg(F.count(F.lit(1)).alias("in_pages"), part(1).alias("v"), part(33).alias("w"), F.min(F.struct("page", "at")).alias("first"), *marks, *sums.values())
    often = vectors.join(every, F.col("host").eqNullSafe(F.col("_host"))).filter((F.col("in_pages") >= F.least(F.lit(least), F.col("pages"))) & (F.col("in_pages") >= support * F.col("pages")))
    vector = F.xxhash64("in_pages", "times", "v", "w")
    held = F.struct("token", "text", "place", "in_pages", "times", "chars", "linked", "article", "out", "name", "under", "whole", vector.alias("class"), F.col("first.at").alias("at"))
    return often.groupBy("host").agg(F.max("pages").alias("pages"), F.collect_list(held).alias("tokens"))


class Classes:
    """A host's tokens by class and place in its order."""

    def __init__(self, tokens: list[int], names: list[int], at: list[int]):
        members = defaultdict(list)
        for a, c, t in zip(at, names, tokens):
            members[c].append((a, t))
        self.where = {t: (c, k) for c, own in members.items() for k, (_, t) in enumerate(sorted(own))}
        self.sizes = {c: len(own) for c, own in members.items()}

    def checked(self, order: list[int]) -> tuple[set[int], dict[int, int]]:
        """The classes that aren't in order on a page or cross another there, and those that each other class is nested in (0: several)."""
        bad: set[int] = set()
        nested: dict[int, int] = {}
        stack: list[list[int]] = []  # instances begun: class, next token
        for token in order:
            found = self.where.get(token)
            if found is None or found[0] in bad:
                continue
            c, k = found
            while stack and stack[-1][0] in bad:
                stack.pop()
            if k == 0:
                above = stack[-1][0] if stack else 0
                if any(x[0] == c for x in stack):
                    bad.add(c)
                    continue
                if nested.setdefault(c, above) != above:
                    nested[c] = 0
                if self.sizes[c] > 1:
                    stack.append([c, 1])
                continue
            depth = next((i for i in range(len(stack) - 1, -1, -1) if stack[i][0] == c and stack[i][1] == k), None)
            if depth is None:
                bad.add(c)
                continue
            bad.update(x[0] for x in stack[depth + 1 :])  # instances that aren't complete here cross this one
            del stack[depth + 1 :]
            stack[-1][1] += 1
            if stack[-1][1] == self.sizes[c]:
                stack.pop()
        bad.update(x[0] for x in stack)
        return bad, nested


def validity(pages: DataFrame, found: DataFrame) -> DataFrame:
    """_host, and for each class whether it is valid on all pages that it is on, and the class that it is always nested in (0: none)."""
    tokens = found.select(F.col("host").alias("_host"), "tokens.token", "tokens.class", "tokens.at")
    met = pages.join(tokens, F.col("host").eqNullSafe(F.col("_host"))).select("host", "order", "token", "class", "at")

    def make():
        held: dict = {}

        def apply(hosts, orders, token, names, at):
            out = []
            for host, order, t, c, a in zip(hosts, orders, token, names, at):
                if host not in held:
                    held.clear()
                    held[host] = Classes(t, c, a)
                known = held[host]
                bad, nested = known.checked(order)
                out.append([{"class": c, "bad": c in bad, "above": nested.get(c, 0)} for c in bad | nested.keys()])
            return {"host": hosts, "found": out}

        return apply

    every = on_arrow(met, [F.col(c) for c in met.columns], make, "host string, found array<struct<class:bigint,bad:boolean,above:bigint>>")
    by_class = every.select("host", F.explode("found").alias("f")).groupBy("host", "f.class").agg(
        F.max("f.bad").alias("bad"), F.when(F.min("f.above") == F.max("f.above"), F.min("f.above")).otherwise(0).alias("above")
    )
    return by_class.groupBy(F.col("host").alias("_host")).agg(F.collect_list(F.struct("class", "bad", "above")).alias("found"))


def template(tokens: list[dict], checked: list[dict]) -> dict:
    """fixed texts (tokens), and the places of slots that are kept and of those that aren't, from a host's tokens and classes.

    A text of a valid class that also holds a place, on all pages of the class, is fixed. In an article its own place must
    be in its class, so that a sentence which comes on every page among others stays. A record is a valid class
    of places that comes more than once a page: its slots, and those nested in it, are judged together for links.
    """
    valid = {c["class"]: c["above"] for c in checked if not c["bad"]}
    groups = defaultdict(list)
    for t in tokens:
        groups[t["class"] if t["class"] in valid else ("alone", t["token"])].append(t)
    fixed, slots = [], {}
    of_class: dict = {}
    for c, own in groups.items():
        places = {t["token"] for t in own if not t["text"]}
        enough = bool(places) and own[0]["in_pages"] >= PAGES
        for t in own:
            if t["text"] and enough and (t["place"] in places if t["article"] else True):
                fixed.append(t)
            elif not t["text"]:
                slots[t["token"]] = Slot(t["article"], t["out"], t["name"], t["chars"], t["linked"])
                of_class[t["token"]] = c
    for t in fixed:
        if t["place"] in slots:
            slots[t["place"]].chars -= t["chars"]
            slots[t["place"]].linked -= t["linked"]
    shares = {t["token"]: t["under"] / t["whole"] for t in tokens if t["whole"]}
    chars, linked = Counter(), Counter()
    for place, slot in slots.items():
        for c in {of_class[place], valid.get(of_class[place], 0)}:
            chars[c] += slot.chars
            linked[c] += slot.linked
    records = {c: linked[c] / chars[c] for c, own in groups.items() if c in valid and own[0]["times"] > own[0]["in_pages"] and chars[c]}
    kept, left = [], []
    for place, slot in slots.items():
        c = of_class[place]
        links = max(records.get(c, 0), records.get(valid.get(c, 0), 0))
        (kept if slot.kept(shares.get(slot.name, 0), links) else left).append(place)
    return {"fixed": [t["token"] for t in fixed], "kept": kept, "left": left}


def templates(pages: DataFrame, support: float = SUPPORT, least: int = PAGES) -> DataFrame:
    """_host, fixed, kept and left: the template of each host of `page_tokens`, see `template`. A host's tokens are bounded by the share `support`."""
    found = stored(classes(pages, support, least))
    met = found.join(validity(pages, found), F.col("host").eqNullSafe(F.col("_host")), "left")

    def make():
        def apply(hosts, tokens, checked):
            every = [template(t, c or []) for t, c in zip(tokens, checked)]
            return {"_host": hosts} | {k: [x[k] for x in every] for k in ("fixed", "kept", "left")}

        return apply

    return on_arrow(met, [F.col("host"), F.col("tokens"), F.col("found")], make, "_host string, fixed array<bigint>, kept array<bigint>, left array<bigint>")


def main_text(df: DataFrame, id_col: str = "page_id", url: str = "url", html: str = "html") -> DataFrame:
    """page_id, url, text and n_chars: what the slots kept in the host's template hold on the page, joined by two line ends.

    If kept slots of the page lie in an article that it marks, only these count. Blocks at places too rare for the template are judged by
    the page alone, as are all on hosts without pages to compare. If nothing is kept, all count that no mark and no name
    leaves out, and else an article's. Null and empty pages have empty text. Pages
    without a host share a template as one host. Rows with equal ids are pages of their own, but equal pages of a host
    count once for its template; an empty table gives none. Other columns aren't read.
    """
    # pages are parsed twice rather than kept; the stored templates' size is known, so that small ones are broadcast
    known = stored(templates(stored(page_tokens(df, id_col, url, html))))
    met = page_blocks(df, id_col, url, html).join(known, F.col("host").eqNullSafe(F.col("_host")), "left")
    own = lambda c: F.coalesce(F.col(c), F.array().cast("array<bigint>"))
    slot = lambda b: F.when(F.array_contains(own("kept"), b["place"]), True).when(F.array_contains(own("left"), b["place"]), False).otherwise(b["kept"])
    slots = F.filter("blocks", lambda b: ~F.array_contains(own("fixed"), b["token"]) & slot(b))
    held = met.withColumn("slots", slots)
    article = F.filter("slots", lambda b: b["article"])
    # a page all of whose parts look like something else still has its text
    free, last = F.filter("blocks", lambda b: b["free"]), F.filter("blocks", lambda b: b["article"])
    taken = F.when(F.size(article) > 0, article).when(F.size("slots") > 0, F.col("slots")).when(F.size(free) > 0, free).otherwise(last)
    text = F.array_join(F.transform(taken, lambda b: b["text"]), "\n\n")
    return held.select("page_id", "url", text.alias("text")).withColumn("n_chars", F.length("text").cast("bigint"))
