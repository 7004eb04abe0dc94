import bz2
import gzip
import random
import re
from datetime import datetime

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from chronolink.sources import dump

WORDS = "alpha beta gamma delta épsilon zeta 漢字 R&D <b>".split()


def xml(text):
    return text.replace("&", "&amp;").replace("<", "&lt;").replace(">", "&gt;")


def make_dump(seed, pages=120, tail=""):
    """A history dump as text, and the revisions a scan should find."""
    rng = random.Random(seed)
    parts, want, rev_id = ["<mediawiki>\n  <siteinfo><title-not/></siteinfo>\n"], [], 0
    for number in range(pages):
        kind = rng.choice(["plain"] * 6 + ["redirect", "empty", "empty-redirect"])
        title = f"Page {seed} & {number}"
        redirect = '<redirect title="X" />' if "redirect" in kind else ""
        parts.append(f"  <page>\n    <title>{xml(title)}</title><ns>0</ns><id>{number}</id>{redirect}\n")
        # One page is longer than many splits.
        count = 0 if "empty" in kind else 400 if number == pages // 2 else rng.randint(1, 12)
        for _ in range(count):
            rev_id += 1
            text = " ".join(rng.choices(WORDS, k=rng.randint(0, 80)))
            minute = rng.randrange(60)
            parts.append(
                f"    <revision><id>{rev_id}</id><timestamp>2020-01-01T00:{minute:02}:00Z</timestamp>"
                f'<contributor><id>1</id></contributor>\n<text xml:space="preserve">{xml(text)}</text>'
                "</revision>\n"
            )
            if kind == "plain":
                want.append((title, rev_id, datetime(2020, 1, 1, 0, minute), text))
        parts.append("  </page>\n")
    parts.append(tail or "</mediawiki>\n")
    return "".join(parts), sorted(want)


PACK = {"xml": lambda b: b, "xml.bz2": lambda b: bz2.compress(b, 1), "xml.gz": gzip.compress}


def put(folder, name, content):
    extension = name.partition(".")[2]
    (folder / name).write_bytes(PACK[extension](content.encode()))


def found(df):
    return sorted(map(tuple, df.select("article", "rev_id", "ts", "text").collect()))


@pytest.mark.parametrize("extension", PACK)
def test_each_revision_once_whatever_the_splits(spark, tmp_path, small_splits, extension):
    content, want = make_dump(1)
    put(tmp_path, f"h.{extension}", content)
    scan = dump.scan_revisions(spark, str(tmp_path))
    assert found(scan) == want
    assert scan.filter("corrupt is not null").count() == 0
    chunks = dump.read_chunks(spark, str(tmp_path), dump.REVISION)
    splits = chunks.select("split").distinct().count()
    assert splits == 1 if extension == "xml.gz" else splits >= 3


def test_globs_and_names(spark, tmp_path, small_splits):
    wants = []
    for seed, name in enumerate(["history_revisions_1.xml", "history_revisions_22.xml", "other_3.xml"]):
        content, want = make_dump(seed, pages=20)
        put(tmp_path, name, content)
        wants.append(want)
    put(tmp_path, "history_revisions_4.xml.bz2", make_dump(9, pages=20)[0])
    by_glob = dump.scan_revisions(spark, f"{tmp_path}/history_revisions_*.xml")
    by_name = dump.scan_revisions(spark, str(tmp_path), name_regex=dump.HISTORY_FILES)
    by_list = dump.scan_revisions(
        spark, [f"{tmp_path}/history_revisions_1.xml", f"{tmp_path}/history_revisions_22.xml"]
    )
    assert found(by_glob) == found(by_name) == found(by_list) == sorted(wants[0] + wants[1])


@pytest.mark.parametrize("extension", PACK)
def test_cut_off_tail_is_left_out(spark, tmp_path, small_splits, extension):
    tail = "<page><title>Cut</title><revision><id>1</id><timestamp>2020-01-01T00:00:00Z</timestamp><text>a"
    content, want = make_dump(3, pages=10, tail=tail)
    put(tmp_path, f"cut.{extension}", content)
    scan = dump.scan_revisions(spark, str(tmp_path))
    assert found(scan) == want and scan.filter("corrupt is not null").count() == 0


@pytest.mark.parametrize("extension", PACK)
def test_cut_off_page_is_left_out(spark, tmp_path, small_splits, extension):
    content, _ = make_dump(3, pages=10, tail="<page><title>Cut</title><id>1</id>")
    put(tmp_path, f"cut.{extension}", content)
    blocks = [r.block for r in dump.scan_pages(spark, str(tmp_path)).collect()]
    assert sorted(blocks) == sorted(re.findall("<page>.*?</page>", content, re.DOTALL))


def test_file_may_end_with_the_end_tag(spark, tmp_path):
    content, want = make_dump(3, pages=10)
    end = content.rindex("</revision>") + len("</revision>")
    put(tmp_path, "end.xml", content[:end])
    assert found(dump.scan_revisions(spark, str(tmp_path))) == want


def test_malformed_revision_is_kept_aside(spark, tmp_path):
    put(
        tmp_path,
        "bad.xml",
        "<page><title>A</title><revision><id>1</id><text>x</revision>"
        "<revision><id>2</id><timestamp>never</timestamp><text>y</text></revision></page>\n",
    )
    bad, odd = dump.scan_revisions(spark, str(tmp_path)).orderBy(F.col("corrupt").desc()).collect()
    assert (bad.article, bad.rev_id, bad.ts, bad.text) == ("A", None, None, None)
    assert bad.corrupt == "<revision><id>1</id><text>x</revision>"
    assert (odd.article, odd.rev_id, odd.ts, odd.text, odd.corrupt) == ("A", 2, None, "y", None)


def test_redirects_on_request(spark, tmp_path):
    content, _ = make_dump(1, pages=30)
    put(tmp_path, "h.xml", content)
    every = dump.scan_revisions(spark, str(tmp_path), keep_redirects=True)
    assert every.count() == content.count("<revision>")


def test_projection_keeps_text_out_of_the_staged_table(spark, tmp_path):
    content, want = make_dump(1, pages=30)
    put(tmp_path, "h.xml", content)
    scan = dump.scan_revisions(
        spark, str(tmp_path), project=lambda d: d.withColumn("n", F.length("text")).drop("text")
    )
    assert scan.columns == ["article", "rev_id", "ts", "corrupt", "n"]
    got = sorted(map(tuple, scan.select("article", "rev_id", "n").collect()))
    assert got == [(a, r, len(t)) for a, r, _, t in want]


@pytest.mark.parametrize("extension", ["xml", "xml.bz2"])
def test_blocks_and_offsets(spark, tmp_path, small_splits, extension):
    content, _ = make_dump(4)
    put(tmp_path, f"h.{extension}", content)
    raw = content.encode()
    want = sorted(
        (m.start(), m.group().decode()) for m in re.finditer(rb"<page>.*?</page>", raw, re.DOTALL)
    )
    keyed = dump.scan_pages_with_offset(spark, str(tmp_path))
    assert sorted(map(tuple, keyed.select("offset", "block").collect())) == want
    plain = dump.scan_pages(spark, str(tmp_path)).orderBy("file", "split", "pos")
    assert [r.block for r in plain.collect()] == [b for _, b in want]


TAGGED = "x</li>y<li>1</li>é<li>two <li>2</li></li>\n<li>3<li>4</li> <li>open <li>cut"
TAGGED_BLOCKS = [
    ("<li>1</li>", 7), ("<li>two <li>2</li>", 19), ("<li>3<li>4</li>", 43)
]


@pytest.mark.parametrize("extension", ["txt", "txt.gz", "txt.bz2"])
@pytest.mark.parametrize("mark", [b"", b"\xef\xbb\xbf"])
def test_any_tag(spark, tmp_path, extension, mark):
    raw = mark + TAGGED.encode()
    pack = {"txt": bytes, "txt.gz": gzip.compress, "txt.bz2": bz2.compress}[extension]
    (tmp_path / f"h.{extension}").write_bytes(pack(raw))
    rows = dump.scan_blocks(spark, str(tmp_path), "<li>", "</li>").orderBy("offset").collect()
    assert [r.block for r in rows] == [b for b, _ in TAGGED_BLOCKS]
    counted = raw if extension == "txt" else raw.removeprefix(mark)
    assert [r.offset for r in rows] == [counted.find(b.encode()) for b, _ in TAGGED_BLOCKS]


@pytest.mark.parametrize("rows", [1, 2, 3, 1000])
def test_blocks_across_parts(spark, tmp_path, monkeypatch, rows):
    monkeypatch.setattr(dump, "SPLIT_ROWS", rows)
    text = "".join(f"<b>{'<b>' * (k % 4)}{k}</b>{'</b>' * (k % 2)} " for k in range(50))
    put(tmp_path, "h.xml", text + "<b>cut")
    got = dump.scan_blocks(spark, str(tmp_path), "<b>", "</b>").select("offset", "block").collect()
    assert sorted(map(tuple, got)) == [(m.start(), m[0]) for m in re.finditer("<b>.*?</b>", text)]


def test_staged_rows_survive_other_split_sizes(spark, tmp_path):
    content, want = make_dump(1)
    put(tmp_path, "h.xml", content)
    scan = dump.scan_revisions(spark, str(tmp_path))
    spark.conf.set("spark.sql.files.maxPartitionBytes", "30000")
    try:
        assert found(scan) == want
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")


def test_bz2_of_many_streams(spark, tmp_path, small_splits):
    content, want = make_dump(7)
    raw = content.encode()
    streams = [bz2.compress(raw[i : i + 30_000], 1) for i in range(0, len(raw), 30_000)]
    (tmp_path / "h.xml.bz2").write_bytes(b"".join(streams))
    assert len(streams) > 3
    assert found(dump.scan_revisions(spark, str(tmp_path))) == want


def test_title_of_a_page_many_splits_long(spark, tmp_path, small_splits):
    revisions = "".join(
        f"<revision><id>{i}</id><timestamp>2020-01-01T00:00:00Z</timestamp><text>{'x' * 500}</text></revision>\n"
        for i in range(1000)
    )
    put(tmp_path, "h.xml", f"<page><title>Long</title>{revisions}</page><page><title>Next</title></page>\n")
    scan = dump.scan_revisions(spark, str(tmp_path))
    assert scan.groupBy("article").count().collect() == [("Long", 1000)]
    splits = dump.read_chunks(spark, str(tmp_path), dump.REVISION).select("split").distinct()
    assert splits.count() > 10


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("head_bytes", [0, 3000, 1 << 26])
def test_heads_in_lots(spark, tmp_path, small_splits, head_bytes):
    wants = []
    for seed in range(4):
        content, want = make_dump(seed, pages=20 * (seed + 1))
        put(tmp_path, f"h {seed}%20é.xml", content)
        wants += want
    assert found(dump.scan_revisions(spark, str(tmp_path), head_bytes=head_bytes)) == sorted(wants)


@settings(max_examples=50)
@given(st.lists(st.integers(0, 9), max_size=8), st.integers(0, 12))
def test_lots_hold_all_files_and_the_limit(sizes, limit):
    files = [(f"f{n}", size) for n, size in enumerate(sizes)]
    lots = dump._lots(files, limit)
    assert [f for some, _ in lots for f in some] == [f for f, _ in files]
    assert all(total <= limit or len(some) == 1 for some, total in lots)


def test_payload_is_not_shuffled(spark, tmp_path):
    content, _ = make_dump(1, pages=10)
    put(tmp_path, "h.xml", content)
    chunks = dump.read_chunks(spark, str(tmp_path), dump.REVISION).withColumn("part", dump._part())
    chunks = chunks.withColumn("_tail", F.substring_index("chunk", dump.REVISION_END, -1))
    heads = dump.page_heads(chunks)
    text = plan(dump.revisions_of(chunks, F.broadcast(heads)))
    payload = text[: text.index("BroadcastExchange")]
    assert "Exchange hash" not in payload and "Sort" not in payload and "Window" not in payload
    # The heads of a part are dropped where the page of a row is known.
    assert "heads" not in payload[: payload.index("_page")]


def test_redirects_are_skipped_before_any_work_on_their_text(spark, tmp_path, small_splits):
    def page(title, mark, head=""):
        revisions = "".join(
            f"<revision><id>{k}</id><timestamp>2020-01-01T00:00:00Z</timestamp><text>{mark} {'x' * 400}</text></revision>\n"
            for k in range(150)
        )
        return f"<page><title>{title}</title>{head}{revisions}</page>\n"

    content = page("A", "good") + page("B", "boom", '<redirect title="A" />') + page("C", "good")
    put(tmp_path, "h.xml", content)

    def touchy(revisions):
        seen = F.when(F.contains("text", F.lit("boom")), F.raise_error(F.lit("text of a redirect"))).otherwise(F.length("text"))
        return revisions.withColumn("n", seen).drop("text")

    scan = dump.scan_revisions(spark, str(tmp_path), project=touchy)
    assert {r.article: r["count"] for r in scan.groupBy("article").count().collect()} == {"A": 150, "C": 150}
    with pytest.raises(Exception, match="text of a redirect"):
        dump.scan_revisions(spark, str(tmp_path), project=touchy, keep_redirects=True)
    assert spark.conf.get("spark.sql.files.maxPartitionBytes") == "20000"  # as the fixture set it


def test_settings_come_back(spark, tmp_path):
    content, _ = make_dump(1, pages=3)
    put(tmp_path, "h.xml", content)
    before = spark.conf.get("spark.sql.files.openCostInBytes")
    dump.scan_revisions(spark, str(tmp_path))
    assert spark.conf.get("spark.sql.files.openCostInBytes") == before
    assert spark.conf.get("spark.sql.files.minPartitionNum", None) is None


def test_texts_that_no_end_tag_follows_do_not_travel(spark, tmp_path):
    put(tmp_path, "open.xml", "<page>text " * 500)
    put(tmp_path, "cut.xml", "head <page>1</page><page>2 <page>3</page>" + "<page>open " * 100)
    read = dump.read_chunks(spark, str(tmp_path), dump.PAGE)
    chunks = dump.stage(
        read.withColumn("_bytes", F.octet_length("chunk").cast("long"))
        .withColumn("_ends", F.contains("chunk", F.lit(dump.PAGE_END)))
        .withColumn("part", dump._part()),
        "chunks",
    )
    _, closed = dump._with_places(chunks.drop("chunk"), len(dump.PAGE))
    texts = dump._texts_in_blocks(chunks, dump.stage(closed, "closed"))
    # The head, two pieces and two ends of one file, nothing of the other; told before any text moves.
    assert {r["file"].rsplit("/")[-1]: r["count"] for r in texts.groupBy("file").count().collect()} == {"cut.xml": 4}
    assert "Exchange hash" not in plan(texts)
    blocks = dump.scan_blocks(spark, str(tmp_path), "<page>", "</page>").select("offset", "block")
    assert sorted(map(tuple, blocks.collect())) == [(5, "<page>1</page>"), (19, "<page>2 <page>3</page>")]


def test_a_block_too_large_for_a_value(spark, tmp_path):
    put(tmp_path, "h.xml", "<b>1</b><b>" + "<b>22" * 100 + "</b><b>3</b>")
    rows = dump.scan_blocks(spark, str(tmp_path), "<b>", "</b>", max_bytes=150).orderBy("offset").collect()
    assert [(r.offset, r.block) for r in rows] == [(0, "<b>1</b>"), (8, None), (515, "<b>3</b>")]
