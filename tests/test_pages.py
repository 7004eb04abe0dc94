from chronolink.operators import pages as P


def block(title="T", page_id="1", rev_id="2", time="2001-01-01T00:00:00Z", text="x"):
    def element(name, value):
        return "" if value is None else f"<{name}>{value}</{name}>"

    body = "" if text is None else f'<text xml:space="preserve">{text}</text>'
    return (
        f"<page>{element('title', title)}<ns>0</ns>{element('id', page_id)}"
        f"<revision>{element('id', rev_id)}{element('timestamp', time)}{body}</revision></page>"
    )


BLANK = ("", "", False, False, False)


def parse(spark, *blocks):
    df = spark.createDataFrame(list(enumerate(blocks)), "key long, block string")
    return [tuple(r)[1:] for r in P.parse_pages_with_key(df).orderBy("key").collect()]


def test_parse(spark):
    assert parse(
        spark,
        block("A &amp; B", text=" &lt;b&gt;\n null "),
        block("Category:C"),
        block("File:F"),
        block("Template:T"),
        block("E", text=""),
        block("null", text="null"),
    ) == [
        ("A & B", " <b>\n null ", False, False, False),
        ("Category:C", "x", True, False, False),
        ("File:F", "x", False, True, False),
        ("Template:T", "x", False, False, True),
        ("E", "", False, False, False),
        ("null", "null", False, False, False),
    ]


def test_incomplete_pages_become_blank(spark):
    incomplete = [
        block("Category:N", text=None),
        block("N", page_id=None),
        block("N", rev_id=None),
        block("N", time=None),
        "<page><title>N</title><id>1</id></page>",
        "<page><title>N</title><id>1</id><revision><text>cut</page>",
        "",
        None,
    ]
    assert parse(spark, *incomplete) == [BLANK] * len(incomplete)


def test_key_is_kept_or_dropped(spark):
    df = spark.createDataFrame([(7, block())], "offset long, block string")
    assert P.parse_pages_with_key(df).first().offset == 7
    assert P.parse_pages(df).columns == ["title", "text", "is_category", "is_file", "is_template"]


def test_redirects(spark):
    cases = {
        "#REDIRECT [[Main Page]]": "Main Page",
        "  #redirect: [[X|label]]": "X",
        "#Redirect[[X#part]]": "X",
        "text #REDIRECT [[X]]": None,
        "#REDIRECT nowhere": None,
        "": None,
    }
    blocks = [block(f"P{i}", text=t) for i, t in enumerate(cases)]
    blocks.append(block("Category:K", text="#REDIRECT [[X]]"))
    df = spark.createDataFrame(list(enumerate(blocks)), "key long, block string")
    redirects = P.parse_redirects(P.parse_pages(df))
    assert sorted(map(tuple, redirects.collect())) == [
        (f"P{i}", target) for i, target in enumerate(cases.values()) if target
    ]
    plan = redirects._jdf.queryExecution().executedPlan().toString()
    assert plan.count("from_xml(") == 1
