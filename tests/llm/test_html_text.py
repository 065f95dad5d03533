"""Template deduction against brute force, what the template decides, and awkward pages."""

import collections
import random

import pytest

from eventloom.llm import html_text

SCHEMA = "page_id long, url string, html string"


def texts(spark, rows, schema=SCHEMA):
    return {r["page_id"]: r["text"] for r in html_text.main_text(spark.createDataFrame(rows, schema)).collect()}


def random_site(seed, pages=14):
    r = random.Random(seed)
    out = []
    for i in range(pages):
        parts = ["<div class=top><p>Always</p></div>"]
        for _ in range(r.randint(0, 3)):
            parts.append(f"<li class=card><a href=/x>go {r.randint(0, 3)}</a><span class=when>{r.choice(['now', 'then'])}</span></li>")
        if i % 2:
            parts.append("<div class=kind><b>Only here</b></div><section><i>and this</i></section>")
        if i % 3:
            parts.append("<div class=q>one</div><div class=w>two</div>" if i % 4 < 2 else "<div class=w>two</div><div class=q>one</div>")
        for _ in range(r.randint(1, 3)):
            parts.append(f"<p class=body>Text {r.randint(0, 4)}</p>")
        if r.random() < 0.3:
            r.shuffle(parts)
        out.append("<html><body>" + "".join(parts) + "</body></html>")
    return out


@pytest.mark.parametrize("seed", range(6))
def test_classes_and_validity_by_brute_force(spark, seed):
    site = random_site(seed)
    df = spark.createDataFrame([(i, f"http://h.example/{i}", h) for i, h in enumerate(site + site[:3])], SCHEMA)
    pages = html_text.page_tokens(df)
    orders = [[x.token for x in html_text.parsed(h)] for h in dict.fromkeys(site)]
    found = html_text.classes(pages)
    row = found.collect()[0]
    assert row["pages"] == len(orders)
    counts = [collections.Counter(o) for o in orders]
    vector = {t: tuple(c[t] for c in counts) for t in set().union(*counts)}
    often = {t: v for t, v in vector.items() if sum(x > 0 for x in v) >= max(3, len(orders) / 16)}
    groups = collections.defaultdict(set)
    for t, v in often.items():
        groups[v].add(t)
    got = collections.defaultdict(set)
    for t in row["tokens"]:
        got[t["class"]].add(t["token"])
    assert sorted(map(sorted, got.values())) == sorted(map(sorted, groups.values()))

    checked = {c["class"]: c for r in html_text.validity(pages, found).collect() for c in r["found"]}
    at = {t["token"]: (t["class"], t["at"]) for t in row["tokens"]}
    canon = {c: sorted(own, key=lambda t: at[t][1]) for c, own in got.items()}

    def instances(c, order):
        places = [(i, t) for i, t in enumerate(order) if t in got[c]]
        n = len(canon[c])
        if len(places) % n or any([t for _, t in places[k : k + n]] != canon[c] for k in range(0, len(places), n)):
            return None
        return [[i for i, _ in places[k : k + n]] for k in range(0, len(places), n)]

    def cross(a, b):
        inside = [sum(1 for x in b if a[k] < x < a[k + 1]) for k in range(len(a) - 1)]
        around = [sum(1 for x in a if b[k] < x < b[k + 1]) for k in range(len(b) - 1)]
        return sum(inside) and max(inside) < len(b) and sum(around) and max(around) < len(a)

    ordered = {c for c in got if all(instances(c, o) is not None for o in orders)}
    valid = {c for c in got if not checked[c]["bad"]}
    assert valid <= ordered
    for c in valid:
        for d in valid - {c}:
            assert not any(cross(x, y) for o in orders for x in instances(c, o) for y in instances(d, o))
    # what crosses nothing is valid
    for c in ordered:
        if not any(cross(x, y) for d in got if d != c for o in orders for x in instances(c, o) for y in (instances(d, o) or [[i for i, t in enumerate(o) if t in got[d]]])):
            assert c in valid
    assert valid != set(got)


def test_copies_of_a_page_are_one_page(spark):
    rows = [(i, "http://h.example/", "<body><div class=a><p>same words</p></div><p class=b>and more</p></body>") for i in range(9)]
    got = texts(spark, rows)
    assert set(got.values()) == {"same words\n\nand more"}


UNMARKED = "<html><body><div class=x1><p>Always here</p></div><div class=x2><p>Own {0}.</p><p>{1}</p></div><div class=x3><p>Kept by us</p></div></body></html>"


def test_template_decides_and_shared_sentences_stay(spark):
    """Half of the pages share a sentence: it lies in a slot of many texts and stays; what every page holds goes."""
    rows = [(i, f"http://h.example/{i}", UNMARKED.format(i, "Shared by many pages of this host." if i % 2 else f"Another {i}.")) for i in range(8)]
    got = texts(spark, rows)
    assert all(got[i] == f"Own {i}.\n\n" + ("Shared by many pages of this host." if i % 2 else f"Another {i}.") for i in range(8))


def test_three_kinds_of_pages_have_three_templates(spark):
    kinds = ["<body><div class=shop><p>Shop opens at 9</p><p class=t>{0} one</p></div></body>", "<body><div class=wiki><p>Anyone may edit</p><p class=t>{0} two</p></div></body>", "<body><div class=news><p>By our desk</p><p class=t>{0} three</p></div></body>"]
    rows = [(i, f"http://h.example/{i}", kinds[i % 3].format(i)) for i in range(12)]
    got = texts(spark, rows)
    assert all(got[i] == f"{i} {('one', 'two', 'three')[i % 3]}" for i in range(12))


MARKED = "<html><body><nav><a href=/>Home</a></nav><article><h1>Title {0}</h1><p>Text {0}.</p><p>{1}</p><div class=plug><p>Support us today</p></div></article><footer>x</footer></body></html>"


def test_fixed_text_in_articles_goes_and_common_paragraphs_stay(spark):
    rows = [(i, f"http://h.example/{i}", MARKED.format(i, "The same paragraph on every page.")) for i in range(6)]
    got = texts(spark, rows)
    assert all(got[i] == f"Title {i}\n\nText {i}.\n\nThe same paragraph on every page." for i in range(6))


def test_pages_change_without_their_template(spark):
    """Ablation: each page alone, on a host of its own, against the pages of one host."""
    rows = [(i, f"http://h.example/{i}", (UNMARKED if i % 2 else MARKED).format(i, f"More {i}.")) for i in range(10)]
    alone = [(i, f"http://h{i}.example/", h) for i, _, h in rows]
    one, two = texts(spark, rows), texts(spark, alone)
    assert sum(one[i] != two[i] for i in one) == 10


def test_records_of_links_go_with_what_stands_beside_them(spark):
    page = "<body><div class=story><p>Own text {0}, which is told here at some length.</p></div><div class=more>{1}</div></body>"
    rows = [(i, f"http://h.example/{i}", page.format(i, "".join(f"<div class=card><a href=/x>Read how the story {i} {k} goes on</a><em class=when>May {k}</em></div>" for k in range(i % 3 + 2)))) for i in range(9)]
    got = texts(spark, rows)
    assert all(got[i] == f"Own text {i}, which is told here at some length." for i in range(9))


@pytest.mark.parametrize(
    "attributes", ["class='post sharing-economy'", "id='search-for-meaning'", "class='related-rights'", "class='has-sidebar'", "class='no-comments'"]
)
def test_topics_are_not_names(spark, attributes):
    page = f"<html><body><article><h1>T</h1><div {attributes}><p>Whole text.</p></div></article></body></html>"
    assert texts(spark, [(1, "http://h.example/", page)])[1] == "T\n\nWhole text."


@pytest.mark.parametrize("attributes", ["class=ad", "class='ad-slot-3'", "class=cookieNotice", "id=comments", "class='post comment-list'", "class=sidebar-left", "class='user-comments box'"])
def test_names_leave_out(spark, attributes):
    page = f"<html><body><article><h1>T</h1><p>Text of some length.</p><div {attributes}><p>Out.</p></div></article></body></html>"
    assert texts(spark, [(1, "http://h.example/", page)])[1] == "T\n\nText of some length."


def test_a_named_place_with_all_of_the_text_is_the_article(spark):
    page = "<html><body><h1>T</h1><div class=comments>" + "".join(f"<p>A long paragraph {{0}} {k} of the story itself.</p>" for k in range(30)) + "</div></body></html>"
    got = texts(spark, [(i, f"http://h.example/{i}", page.format(i)) for i in range(4)])
    assert all(len(got[i]) > 900 for i in got)


def test_awkward_pages(spark):
    schema = "page_id long, url string, html string, host string, blocks string, fixed int, text string, _host string, kept int"
    long = "<article>" + "".join(f"<p>Paragraph {i} of many.</p>" for i in range(20_000)) + "</article>"
    deep = "<div>" * 3000 + "deep" + "</div>" * 3000
    rows = [(1, "http://h.example/", long, *["x", "y", 1, "z", "w", 2]), (2, None, deep, *[None] * 6), (None, "http://h.example/", "<p>a</p>", *[None] * 6), (2, None, deep, *[None] * 6), (3, "", None, *[None] * 6), (4, "x", " ", *[None] * 6)]
    found = html_text.main_text(spark.createDataFrame(rows, schema))
    assert found.columns == ["page_id", "url", "text", "n_chars"]
    got = [(r["page_id"], r["text"], r["n_chars"]) for r in found.collect()]
    assert len(got) == 6 and got.count((2, "deep", 4)) == 2 and (None, "a", 1) in got and (3, "", 0) in got and (4, "", 0) in got
    assert next(t for i, t, _ in got if i == 1).count("\n\n") == 19_999
    assert html_text.main_text(spark.createDataFrame([], schema)).count() == 0


def test_given_pages(spark):
    """All given pages mark their article: its text is found whole, by slots of the template."""
    import html as h
    import re

    pages = spark.read.parquet("/root/testdata/sf0.01/pages.parquet")
    got = {(r["page_id"], r["url"]): r["text"] for r in html_text.main_text(pages).collect()}
    words = lambda t: h.unescape(re.sub(r"<[^>]*>", " ", t)).split()
    rows = pages.collect()
    assert len(got) == len(rows)
    for r in rows:
        article = re.search(r"<article>(.*?)</article>", r["html"], re.S)[1]
        assert got[r["page_id"], r["url"]].split() == words(article)
