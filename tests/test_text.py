import html
import random
import time
from datetime import datetime

import pytest
from pyspark.sql import functions as F

from chronolink.functions import text as T


def one(spark, column, **values):
    df = spark.createDataFrame([tuple(values.values())], ", ".join(f"{n} string" for n in values))
    return df.select(column).first()[0]


@pytest.mark.parametrize(
    "text",
    ["R&amp;D", "a &lt; b &gt; c", "&eacute;t&eacute;", "&copy;&middot;&nbsp;", "plain", "", "A & B",
     "&#233;&#xE9;&#X1F600;", "&quot;q&quot;"],
)
def test_html_entities(spark, text):
    assert one(spark, T.unescape_html("t"), t=text) == html.unescape(text)


@pytest.mark.parametrize(
    ("text", "want"),
    [
        ("&amp;lt;", "&lt;"),  # one pass only
        ("&#38;lt;", "&lt;"),
        ("&amp;#60;", "&#60;"),
        ("&nosuch; &amp", "&nosuch; &amp"),  # unknown or unfinished: as it is
        ("&#0;&#xD800;&#99999999;", "&#0;&#xD800;&#99999999;"),  # no characters
        ("&apos;", "&apos;"),  # no HTML 4 entity
    ],
)
def test_html_entities_once(spark, text, want):
    assert one(spark, T.unescape_html("t"), t=text) == want


def test_all_named_entities(spark):
    names = " ".join(f"&{name};" for name in T.HTML_ENTITIES)
    assert one(spark, T.unescape_html("t"), t=names) == " ".join(T.HTML_ENTITIES.values())


def test_xml_entities(spark):
    assert one(spark, T.unescape_xml("t"), t="&lt;&amp;&apos;&eacute;&#65;") == "<&'&eacute;A"
    assert one(spark, T.unescape_xml(T.escape_xml("t")), t="a<b>&amp;&") == "a<b>&amp;&"


@pytest.mark.parametrize(
    ("text", "literal", "want"),
    [
        ("The Then the", "The", 2),  # no word boundary, case-sensitive
        ("aaaa", "aa", 2),  # non-overlapping
        ("A.B AxB", "A.B", 1),  # no pattern
        ("né né", "né", 2),
        ("", "x", 0),
        (r"a\Eb \E a\Eb", r"\E", 3),
        (r"a\Eb a\Eb", r"a\Eb", 2),
        ("$1 \\ $1", "$1", 2),
        ("abc", "", 0),
    ],
)
def test_literal_counts(spark, text, literal, want):
    counts = T.literal_counts("t", F.array("x", F.lit("no such")))
    assert one(spark, counts, t=text, x=literal) == [want, 0]


def test_literal_counts_of_nothing(spark):
    df = spark.createDataFrame([(None, ["a"]), ("a", []), ("a", None)], "t string, x array<string>")
    assert [r[0] for r in df.select(T.literal_counts("t", "x")).collect()] == [[0], [], []]


def test_file_key(spark):
    assert one(spark, T.file_key("t"), t=" A\tB\n C ") == "ABC"


@pytest.mark.parametrize("zone", ["UTC", "America/New_York"])
def test_edge_line_and_utc_time(spark, zone):
    spark.conf.set("spark.sql.session.timeZone", zone)
    try:
        df = spark.createDataFrame(
            [("2001-12-12T06:32:58Z", "2002-04-03T19:10:18+02:00", "Page B", 2)],
            "a string, b string, target string, cnt int",
        ).select(
            T.utc_time(F.col("a")).alias("valid_from"),
            T.utc_time(F.col("b")).alias("valid_to"),
            "target",
            "cnt",
        )
        row = df.first()
        assert row.valid_to == datetime(2002, 4, 3, 17, 10, 18)
        line = df.select(T.edge_line()).first()[0]
        assert line == "[2001-12-12T06:32:58,2002-04-03T17:10:18] Page B 2"
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")


@pytest.mark.parametrize("zone", ["UTC", "America/New_York"])
def test_times_at_a_clock_change(spark, zone):
    spark.conf.set("spark.sql.session.timeZone", zone)
    try:
        df = spark.sql("select timestamp_ntz'2024-03-10 02:30:00' a, timestamp_ntz'2024-03-10 03:30:00.5' b")
        line = df.select(T.edge_line("a", "b", F.lit("x"), F.lit(1))).first()[0]
        assert line == "[2024-03-10T02:30:00,2024-03-10T03:30:00] x 1"
        for text in ("2024-03-10T02:30:00", "2024-03-10 02:30:00Z", "2024-03-10T03:30:00+01:00"):
            assert one(spark, T.utc_time(F.col("t")), t=text) == datetime(2024, 3, 10, 2, 30)
        assert one(spark, T.utc_time(F.col("t")), t="2024-03-10") == datetime(2024, 3, 10)
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")


@pytest.mark.parametrize("text", ["&#65;", "&#00000065;", "&#x41;", "&#X000000041;"])
def test_numbers_with_leading_zeros(spark, text):
    assert one(spark, T.unescape_html("t"), t=text) == "A"


def test_malformed_time_is_null(spark):
    assert one(spark, T.utc_time(F.col("t")), t="yesterday") is None


@pytest.mark.parametrize("many", [0, 10**9])
def test_many_literals_in_one_pass(spark, many):
    rng = random.Random(5)
    rows = []
    for n in range(40):
        text = "".join(rng.choices("abé漢 \n", k=rng.choice([0, 1, 3, 30, 400])))
        cuts = [text[i : i + rng.randint(1, 9)] for i in range(0, len(text), 3)]
        rows.append((text if n else None, ["", "aaaa", "abab", "漢", "none of it", *cuts, *cuts[:2]]))
    df = spark.createDataFrame(rows, "t string, x array<string>")
    got = [r[0] for r in df.select(T.literal_counts("t", "x", many=many)).collect()]
    assert got == [[(text or "").count(x) if x else 0 for x in literals] for text, literals in rows]


def test_cost_of_many_literals_is_not_a_look_at_the_text_for_each(spark):
    rng = random.Random(6)
    words = ["".join(rng.choices("etaoinshrdlu", k=rng.randint(4, 9))) for _ in range(12_000)]
    text = " ".join(rng.choices(words, k=50_000))
    targets = [" ".join(rng.sample(words, 2)) for _ in range(5_000)] + words[:500]
    df = spark.createDataFrame([(text, targets)], "t string, x array<string>").persist()
    df.select(T.literal_counts("t", F.slice("x", 1, 5), many=0)).collect()  # code that is loaded once
    seconds = {}
    for many in (0, 10**9):
        start = time.perf_counter()
        counts = df.select(T.literal_counts("t", "x", many=many)).first()[0]
        seconds[many] = time.perf_counter() - start
        assert counts[-500:] == [text.count(w) for w in words[:500]]
    assert seconds[0] < seconds[10**9] / 2, seconds
