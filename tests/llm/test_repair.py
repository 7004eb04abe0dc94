import hashlib
import itertools
import re
import zlib

import duckdb
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from chronolink.llm import repair

SCHEMA = "conv_id long, turn long, role string, text string"
GRAMMAR = re.compile("(s?(ua)+)?")
GAPS = ("", "I u", "I a", "I u I a", "I a I u")


def tried_out(rows):
    """The least (cost, audit) of all ways to edit the rows, by trying them out."""
    best = None
    choices = []
    for initial, delete, truncated in rows:
        edits = [("D", "", 2)]
        if not delete:
            more = 5 * truncated
            edits += [("K", initial, more), ("R", "u", 1 + more), ("R", "a", 1 + more)]
        choices.append([(gap, *e) for gap in GAPS for e in edits])
    for way in itertools.product(*choices, [(gap, "", "", 0) for gap in GAPS]):
        cost, audit, roles = 0, "", ""
        for gap, edit, role, price in way:
            inserted = gap.split()[1::2]
            cost += 5 * len(inserted) + price
            audit += "I" * len(inserted) + edit
            roles += "".join(inserted) + role
        if GRAMMAR.fullmatch(roles) and (best is None or (cost, audit) < best):
            best = (cost, audit)
    return best


TOKENS = st.lists(st.tuples(st.sampled_from("suax"), st.booleans(), st.booleans()), max_size=3)


@settings(max_examples=40, deadline=None)
@given(TOKENS)
def test_parser_equals_all_ways_tried_out(rows):
    assert repair.finish(repair.parse(rows)) == tried_out(rows)


@settings(max_examples=60, deadline=None)
@given(st.lists(st.tuples(st.sampled_from("suax"), st.booleans(), st.booleans()), max_size=12))
def test_an_audit_makes_the_grammar(rows):
    cost, audit = repair.finish(repair.parse(rows))
    made = repair.repaired([(r, "t") for r, _, _ in rows], audit)
    assert GRAMMAR.fullmatch("".join(role[:1] for role, _ in made))
    assert audit.replace("I", "").__len__() == len(rows) and cost >= 0


def test_every_stack_is_listed():
    seen = {repair.START}
    while True:
        more = {repair._shift(s, c) for s in seen for c in "sua"} - {None} - seen
        if not more:
            break
        seen |= more
    assert seen == set(repair.STACKS)


def brute(rows):
    """All results from (conv_id, turn, role, text) rows, written without the library."""
    out, convs = {}, {}
    space = lambda v: " " if v is None else str(v)
    for conv, turn, role, text in rows:
        kept = convs.setdefault(conv, [])
        role, text = space(role), space(text)
        k = zlib.crc32(f"{space(conv)}:{space(turn)}".encode()) % 20
        if k == 0:
            continue
        text = "" if k == 1 else re.sub("[.!?]", "", text) if k == 2 else text
        kept += [(turn, "user" if k == 4 else role, text)] * (2 if k == 3 else 1)
    for conv, kept in convs.items():
        kept.sort(key=lambda r: (r[0] is not None, r[0] or 0, r[1].encode(), r[2].encode()))
        counts, tokens, seen = dict.fromkeys(("blank", "duplicate", "truncated"), 0), [], set()
        for _, role, text in kept:
            bare = re.sub(r"[\x20\x09-\x0D]", "", text)
            fault = "blank" if not bare else "duplicate" if (role, text) in seen else "truncated"
            if fault == "truncated" and bare[-1] in ".!?":
                fault = None
            else:
                counts[fault] += 1
            seen.add((role, text))
            tokens.append((role[:1], fault in ("blank", "duplicate"), fault == "truncated"))
        cost, audit = cheapest(tokens)
        made, at = [], 0
        for edit in audit:
            wanted = "assistant" if made and made[-1][0][:1] == "u" else "user"
            if edit == "I":
                made.append((wanted, ""))
                continue
            _, role, text = kept[at]
            at += 1
            if edit != "D":
                made.append((role if edit == "K" else wanted, text))
        known = {t for t, _, _ in kept if t is not None}
        initials = [r[:1] for _, r, _ in kept]
        out[conv] = (
            max(known) - min(known) + 1 - len(known) if known else 0,
            *counts.values(),
            sum(a + b not in ("su", "ua", "au") for a, b in zip(initials, initials[1:])),
            cost,
            audit,
            hashlib.sha256("\n".join(f"{r}:{t}" for r, t in made).encode()).hexdigest(),
        )
    return out


NEXT = {("", "s"): "s", ("", "u"): "u", ("s", "u"): "u", ("u", "a"): "a", ("a", "u"): "u"}


def cheapest(tokens):
    """Least (cost, audit) by a plain automaton over the last role, from all edits of the rows in turn."""
    best = {"": (0, "")}
    for token in [*tokens, None]:
        for _ in range(3):  # insertions, as long as they can help
            for state, (cost, audit) in list(best.items()):
                for role in "ua":
                    to = NEXT.get((state, role))
                    if to:
                        best[to] = min(best.get(to, (9**9, "")), (cost + 5, audit + "I"))
        if token is None:
            break
        after = {}
        initial, delete, truncated = token
        for state, (cost, audit) in best.items():
            moves = [("D", state, 2)]
            if not delete:
                moves += [("K", NEXT.get((state, initial)), 5 * truncated)]
                moves += [("R", NEXT.get((state, r)), 1 + 5 * truncated) for r in "ua" if r != initial]
            for edit, to, price in moves:
                if to is not None:
                    after[to] = min(after.get(to, (9**9, "")), (cost + price, audit + edit))
        best = after
    return min(best[s] for s in ("", "a") if s in best)


def results(df):
    return {r[0]: tuple(r)[1:] for r in df.collect()}


def sample(spark):
    """Conversations with nulls, ties, repeats, white space, odd roles, one long text and one long conversation."""
    texts = ["Hi.", "no end", "", " \t\n", "What? ", "Yes!\n ", None, "a.", "word " * 50_000 + "."]
    roles = ["user", "assistant", "system", "tool", None, "", "user", "assistant"]
    rows = []
    for n in range(700):
        conv = None if n % 97 == 0 else n % 60
        turn = None if n % 41 == 0 else n // 60
        rows.append((conv, turn, roles[n * 7 % 8], texts[n * 5 % 8] if n != 300 else texts[8]))
    rows += [(1000, n // 2 * 3, ("user", "assistant")[n % 2], f"{n % 37} line{'.' * (n % 3)}") for n in range(400)]
    rows += [(2000, t, "user", "gone") for t in range(2000) if zlib.crc32(f"2000:{t}".encode()) % 20 == 0]
    return rows


@pytest.mark.parametrize("block", [4096, 5, 64])
def test_whole_and_in_blocks(table, spark, block):
    rows = sample(spark)
    df = repair.damage(table(rows, SCHEMA).selectExpr("*", "'x' as audit", "1L as block", "2L as seq", "3L as cost"))
    assert results(repair.repair(df, block=block)) == brute(rows)


def test_a_conversation_without_rows_after_damage(table):
    turns = [t for t in range(200) if zlib.crc32(f"5:{t}".encode()) % 20 == 0]
    found = results(repair.repair(repair.damage(table([(5, t, "user", "x.") for t in turns], SCHEMA))))
    assert found == {5: (0, 0, 0, 0, 0, 0, "", hashlib.sha256(b"").hexdigest())}


def test_an_empty_table(table):
    assert repair.repair(repair.damage(table([], SCHEMA))).count() == 0


def test_query(spark):
    path = "/root/testdata/sf0.01"
    rows = spark.read.parquet(f"{path}/conversations.parquet").select("conv_id", "turn", "role", "text").collect()
    assert results(repair.op13_conversation_repair(spark, path)) == brute([tuple(r) for r in rows])


def test_sql_on_odd_rows(spark):
    rows = [r for r in sample(spark) if r[3] is None or len(r[3]) < 1000]
    con = duckdb.connect()
    con.sql("create table conversations (conv_id bigint, turn bigint, role varchar, text varchar)")
    con.executemany("insert into conversations values (?, ?, ?, ?)", rows)
    assert {r[0]: tuple(r)[1:] for r in con.sql(repair.ORACLE).fetchall()} == brute(rows)
