import re
from collections import Counter

import pytest
from pyspark.sql import functions as F

from chronolink.functions.anchors import anchors
from chronolink.operators import links as L


def texts(spark, *values):
    return spark.createDataFrame([(f"T{i}", v) for i, v in enumerate(values)], "title string, text string")


def tag(title, css=None, label="x"):
    css = f' class="{css}"' if css is not None else ""
    name = f' title="{title}"' if title is not None else ""
    return f'<a href="/h"{name}{css}>{label}</a>'


TITLES = [
    "Plain", "User:x", "User talk:x", "Talk:x", "/sub", "n" * 255, "n" * 256, "A.B", "R&amp;D",
    "&#47;later", "Usage", "",
]


def test_basic_filter(spark):
    html = "".join(map(tag, TITLES)) + tag(None) + tag("Out", "external free") + tag("In", "mw")
    rows = L.flat_links(texts(spark, html), kind="title").collect()
    assert {(r.page_title, r.cnt) for r in rows} == {("T0", 1)}
    want = ["Plain", "Talk:x", "/sub", "n" * 255, "n" * 256, "A.B", "R&D", "/later", "Usage", "", "In"]
    assert [r.target for r in rows] == want


def test_strict_filter_judges_titles_before_entities(spark):
    html = "".join(map(tag, TITLES)) + tag(None) + tag("Out", "external") + tag("In", "mw")
    row = L.with_strict_links(texts(spark, html), kind="title").first()
    assert row.targets == ["Plain", "n" * 255, "A.B", "R&D", "/later", "Usage", "In"]


def test_kinds(spark):
    html = '<a class="c" title="T" href="H">L</a>'
    df = texts(spark, html)
    for kind, want in (("title", "T"), ("href", "H"), ("text", "L")):
        (found,) = df.select(anchors("text", kind)).first()[0]
        assert (found.title, found["class"]) == (want, "c")
    with pytest.raises(ValueError):
        anchors("text", "other")


def test_wikitext(spark):
    text = (
        "[[A]] [[ B |b]] [[C#part|c]] [[Category:K]] [[:Category:K]] [[File:f.png|thumb|see [[D]]]]"
        " <nowiki>[[N]]</nowiki><!-- [[M]] --> [http://x y] [[|none]] [[A]]"
    )
    rows = L.flat_links(texts(spark, text)).collect()
    assert [r.target for r in rows] == ["A", "B", "C", "Category:K", "D", "A"]


def brute(text):
    rest = re.sub(r"\[\[[^\[\]]*\]\]", "", text)
    found = Counter(re.findall(r"\[\[([^\[\]|#]+)", text))
    return {(t, n, rest.count(t), n + rest.count(t)) for t, n in found.items()}


def test_counts(spark):
    values = [
        "[[The]] [[The|t]] [[B]] The Then the B.",
        "no links",
        "",
        "[[A.B]] A.B AxB",
        " ".join(f"[[W{i % 7}]] W{i % 3}" for i in range(200)),
    ]
    rows = L.with_link_counts(texts(spark, *values, None)).orderBy("title").collect()
    for value, row in zip([*values, ""], rows, strict=True):
        got = [tuple(r) for r in row.links]
        assert len(got) == len(set(got)) and set(got) == brute(value)
    assert rows[0].asDict().keys() == {"title", "text", "links"}


def test_counts_use_titles_with_entities_replaced(spark):
    html = tag("R&amp;D") + tag("R&#38;D") + " R&D"
    row = L.with_link_counts(texts(spark, html), kind="title").first()
    assert [tuple(r) for r in row.links] == [("R&D", 2, 1, 3)]


def test_mentions_in_markup_or_text(spark):
    html = '<a href="/x">note</a> <p class="note">a note</p>'
    df = texts(spark, html)
    (markup,) = L.with_link_counts(df, kind="text").first().links
    (plain,) = L.with_link_counts(df, kind="text", count_in="text").first().links
    assert (markup.mentions, plain.mentions) == (2, 1)
    with pytest.raises(ValueError):
        L.with_link_counts(df, count_in="other")


def test_page_links_keep_pages_without_links(spark):
    rows = L.page_links(texts(spark, "[[A]] A", "none", None)).orderBy("title").collect()
    assert [(r.title, [tuple(x) for x in r.links]) for r in rows] == [
        ("T0", [("A", 2)]),
        ("T1", []),
        ("T2", []),
    ]


def test_text_is_searched_once_per_row(spark):
    counted = L.with_link_counts(texts(spark, "[[A]]"))
    rows = counted.select("title", F.inline("links")).filter("cnt > 0 and target <> 'B'")
    plan = rows._jdf.queryExecution().executedPlan().toString()
    # Comments are cut once for the links and once for the rest, each in one of two branches; nothing
    # leaves the JVM or the row.
    assert plan.count("-->") == 4 and plan.count("\\Q") == 2
    assert "Python" not in plan and "Exchange" not in plan


def counts(spark, text, kind):
    row = L.with_link_counts(texts(spark, text), kind=kind).first()
    return [(r.target, r.anchors, r.mentions) for r in row.links]


@pytest.mark.parametrize("kind", ["title", "text"])
@pytest.mark.parametrize(
    "anchor",
    [
        '<a href="/x" title="X1"><b>X1</b></a>',
        "<a href='/x' title='X1'>X1</a>",
        '<A HREF="/x" TITLE="X1">X1</A >',
        '<a\nhref="/x"\ntitle = "X1">X<i>1</i></a>',
    ],
)
def test_anchors_in_any_form_are_cut_out(spark, anchor, kind):
    assert counts(spark, f"{anchor} end", kind) == [("X1", 1, 0)]
    assert counts(spark, f"X1 {anchor} end X1", kind) == [("X1", 1, 2)]


@pytest.mark.parametrize(
    ("text", "want"),
    [
        ("x [[Foo]] <!-- Foo Foo -->", [("Foo", 1, 0)]),
        ("x [[Foo]] <nowiki>[[Foo]] [[Bar]]</nowiki> Foo", [("Foo", 1, 2)]),
        ("[[Foo y and Foo y", []),
        ("[[category:Foo]] [[file:a.png|thumb]] [[IMAGE:b]] [[:Category:Foo]]", [("Category:Foo", 1, 0)]),
        ("[[A#s|b]] [[A#s]] [[B|x [[C]] y]]", [("A", 2, 0), ("B", 1, 0), ("C", 1, 0)]),
    ],
)
def test_hidden_and_unclosed_wikitext(spark, text, want):
    assert counts(spark, text, "wikitext") == want


@pytest.mark.parametrize(
    ("text", "want"),
    [
        ("<a href=/x title=X1>z</a> X1", [("X1", 1, 1)]),
        ("<a href=/x title=X1/>z</a>", [("X1/", 1, 0)]),
        ('<a title="a>b" href="/x">z</a> a>b', [("a>b", 1, 1)]),
        ("<a title='say \"a>b\"'>z</a>", [('say "a>b"', 1, 0)]),
        ('<!-- <a title="X1">X1</a> --> <a title="Y">Y</a> X1', [("Y", 1, 0)]),
        ("<script>var s = '<a title=\"X1\">X1</a>';</script> <a title=Y>y</a>", [("Y", 1, 0)]),
        ("<STYLE type='a>b'>a:after{content:'<a title=Q>'}</STYLE ><a title=Zed>y</a>", [("Zed", 1, 0)]),
        ("<scripted><a title=Y>y</a></scripted>", [("Y", 1, 0)]),
        ('<a title="Y">y</a> <!-- open <a title="Z">z</a> Y', [("Y", 1, 1)]),
        ('<a data-x=\'title="no"\' title="Y">y</a>', [("Y", 1, 0)]),
        ('<a xtitle="no" title="Y" title="second">y</a>', [("Y", 1, 0)]),
        ('<a disabled/title="Y">y</a><a hidden>h</a><a title="">e</a>', [("Y", 1, 0)]),
        ('<abbr title="no">y</abbr><a>y</a>', []),
    ],
)
def test_html_as_found_in_the_wild(spark, text, want):
    assert counts(spark, text, "title") == want


def test_anchors_without_attributes_are_links_by_text(spark):
    assert counts(spark, "<a>X</a> <a/>Y</a> <area>Z</area> X", "text") == [("X", 1, 1), ("Y", 1, 0)]


def test_long_tags_and_texts(spark):
    many = " ".join(f"d{n}='>{n}'" for n in range(5000))
    html = f"<a {many} title='X'>y</a> X" + "<!--" + "-" * 200_000 + "-->" + "<p 'x'>" * 20_000
    assert counts(spark, html, "title") == [("X", 1, 1)]
