"""Conversation structure repair: generalised LR parsing with edits.

A whole conversation is an optional system turn and then user and assistant in turns, at least one pair, or nothing:

    C -> (empty) | B | s B        B -> P | B P        P -> u a

The parser reads the role initials of the rows. Before each row it may insert a user or assistant turn; the row is kept,
reroled or deleted. Stacks that stay possible share their lower parts, and of stacks with equal tops the one with the least
(cost, audit) stays, so at most one stack per state is alive. Two audits over the same rows never are one the start of the
other at equal cost, as what follows would be insertions, which cost; so the least of all is never merged away.

Conversations of up to ``BLOCK`` rows are parsed whole, many per task. A longer one is cut into blocks of ``BLOCK`` rows,
each parsed in a task of its own from every stack that may precede it. The blocks' costs (no audits) are put together
along the conversation, then each block is parsed again from its stack on the best way. What is left to one task is a row
per block and the digest of the repaired text, which reads the blocks' texts one by one.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from chronolink.plans.sequence import number_rows
from chronolink.plans.staging import stage

from .tables import read, small

#: Rows of a conversation that are parsed in one go.
BLOCK = 4096
KEEP, REROLE, DELETE, INSERT, TRUNCATED = 0, 1, 2, 5, 5

# The SLR(1) table of the grammar. 1 after s, 2 after u, 3 after a, 4 and 5 after B (5 with s before it),
# 6 and 7 after P. States 3, 6 and 7 always reduce, the others never do.
SHIFT = {(0, "s"): 1, (0, "u"): 2, (1, "u"): 2, (4, "u"): 2, (5, "u"): 2, (2, "a"): 3}
REDUCE = {3: ("P", 2), 6: ("B", 1), 7: ("B", 2)}
GOTO = {(0, "P"): 6, (1, "P"): 6, (4, "P"): 7, (5, "P"): 7, (0, "B"): 4, (1, "B"): 5}
ACCEPT = (0, 4, 5)
ROLES = {"u": "user", "a": "assistant"}

# A stack is a linked node (state, node below).
START = (0, None)
_S = (1, START)
_B, _SB = (4, START), (5, _S)
#: All stacks that can stand before a row, reductions done. Blocks name them by their position.
STACKS = (START, _S, _B, _SB, (2, START), (2, _S), (2, _B), (2, _SB))

# White space only, and a closing mark before white space at the end.
_NO_WORD = r"^[\x20\x09-\x0D]*\z"
_END = r"[.!?][\x20\x09-\x0D]*\z"


def _shift(stack, symbol):
    """The stack after a symbol and all reductions, or None where the symbol does not fit."""
    state = SHIFT.get((stack[0], symbol))
    if state is None:
        return None
    stack = (state, stack)
    while stack[0] in REDUCE:
        name, length = REDUCE[stack[0]]
        for _ in range(length):
            stack = stack[1]
        stack = (GOTO[stack[0], name], stack)
    return stack


def _offer(tops: dict, stack, cost: int, audit: str) -> bool:
    """Merge a stack into those alive: of equal tops the least (cost, audit) stays."""
    held = tops.get(stack[0])
    if held is not None and (held[0], held[1]) <= (cost, audit):
        return False
    tops[stack[0]] = (cost, audit, stack)
    return True


def _with_inserts(tops: dict) -> dict:
    """The stacks alive, and those that insertions lead to."""
    tops = dict(tops)
    waiting = list(tops.values())
    while waiting:
        cost, audit, stack = waiting.pop()
        if tops[stack[0]] != (cost, audit, stack):
            continue
        for symbol in ROLES:
            after = _shift(stack, symbol)
            if after is not None and _offer(tops, after, cost + INSERT, audit + "I"):
                waiting.append(tops[after[0]])
    return tops


def parse(rows: list[tuple[str, bool, bool]], start=START) -> dict:
    """Stacks alive after the rows, as top state -> (cost, audit, stack). Insertions come before a row, none after the last.

    A row is (role initial, must be deleted, truncated).
    """
    tops = {start[0]: (0, "", start)}
    for initial, delete, truncated in rows:
        after: dict = {}
        for cost, audit, stack in _with_inserts(tops).values():
            _offer(after, stack, cost + DELETE, audit + "D")
            if delete:
                continue
            more = cost + TRUNCATED * truncated
            for symbol in {initial, *ROLES}:
                moved = _shift(stack, symbol)
                if moved is None:
                    continue
                if symbol == initial:
                    _offer(after, moved, more + KEEP, audit + "K")
                else:
                    _offer(after, moved, more + REROLE, audit + "R")
        tops = after
    return tops


def finish(tops: dict) -> tuple[int, str]:
    """The least (cost, audit) of a whole conversation."""
    return min((cost, audit) for state, (cost, audit, _) in _with_inserts(tops).items() if state in ACCEPT)


def repaired(rows: list[tuple[str, str]], audit: str, start=START) -> list[tuple[str, str]]:
    """The (role, text) rows that an audit makes of the given ones."""
    stack, at, out = start, 0, []
    for edit in audit:
        if edit == "I":
            row = (_wanted(stack), "")
        else:
            row = rows[at]
            at += 1
            if edit == "D":
                continue
            if edit == "R":
                row = (_wanted(stack), row[1])
        out.append(row)
        stack = _shift(stack, row[0][:1])
    return out


def _wanted(stack) -> str:
    """The user or assistant role that fits next; there is one for every stack."""
    return next(role for symbol, role in ROLES.items() if (stack[0], symbol) in SHIFT)


# Rows and their faults.


def damage(conversations: DataFrame) -> DataFrame:
    """Rows after damage: ``conv_id, turn, role, text``; a conversation that loses all rows keeps one with a null role.

    The checksum of ``conv_id:turn`` modulo 20 decides: 0 drops the row, 1 empties its text, 2 takes out its ``.!?``,
    3 doubles it, 4 makes the user say it. A null in the key, role or text is a space.
    """
    space = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(" "))
    kind = F.crc32(F.concat(space("conv_id"), F.lit(":"), space("turn")).cast("binary")) % 20
    rows = conversations.select("conv_id", "turn", space("role").alias("role"), space("text").alias("text"), kind.alias("_k"))
    text = (
        F.when(F.col("_k") == 1, "").when(F.col("_k") == 2, F.translate("text", ".!?", "")).otherwise(F.col("text"))
    )
    changed = F.struct(F.when(F.col("_k") == 4, "user").otherwise(F.col("role")).alias("role"), text.alias("text"))
    # A dropped row stays without role, text and turn, so that its conversation is returned.
    nothing = F.struct(F.lit(None).cast("string").alias("role"), F.lit(None).cast("string").alias("text"))
    copies = (
        F.when(F.col("_k") == 0, F.array(nothing)).when(F.col("_k") == 3, F.array(changed, changed)).otherwise(F.array(changed))
    )
    return rows.select(
        "conv_id", F.when(F.col("_k") != 0, F.col("turn")).alias("turn"), F.inline(copies)
    )


_ORDER = ["turn", "role", "text"]
_RESULT = (
    "conv_id {id}, gaps long, blank long, duplicate long, truncated long, illegal long, cost long, audit string, "
    "repaired_sha256 string"
)
_LEGAL = {"su", "ua", "au"}
_SPACE = " \t\n\v\f\r"


def _faults(rows: list[tuple]) -> tuple[list[str], list[tuple[str, bool, bool]]]:
    """The first fault of each (role, text), and what the parser needs of it."""
    seen: set = set()
    names, tokens = [], []
    for row in rows:
        role, text = row
        shown = text.rstrip(_SPACE)
        if not shown:
            fault = "blank"
        elif row in seen:
            fault = "duplicate"
        else:
            fault = "" if shown[-1] in ".!?" else "truncated"
        seen.add(row)
        names.append(fault)
        tokens.append((role[:1], fault in ("blank", "duplicate"), fault == "truncated"))
    return names, tokens


def _whole(turns: list, rows: list[tuple[str, str]]) -> tuple:
    """All results of one conversation."""
    names, tokens = _faults(rows)
    cost, audit = finish(parse(tokens))
    known = {t for t in turns if t is not None}
    digest = hashlib.sha256()
    for n, (role, text) in enumerate(repaired(rows, audit)):
        digest.update(f"{chr(10) * (n > 0)}{role}:{text}".encode())
    return (
        max(known) - min(known) + 1 - len(known) if known else 0,
        *[names.count(fault) for fault in ("blank", "duplicate", "truncated")],
        sum(a[0][:1] + b[0][:1] not in _LEGAL for a, b in zip(rows, rows[1:])),
        cost,
        audit,
        digest.hexdigest(),
    )


def _whole_groups(id_type: pa.DataType):
    """Results of the conversations of a partition that is sorted by conversation and order."""
    names = ["conv_id", "gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit", "repaired_sha256"]
    types = [id_type, *[pa.int64()] * 6, pa.string(), pa.string()]

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        current, turns, rows, out = None, [], [], []
        begun = False
        for batch in small(batches, 1024):
            for conv, turn, role, text in zip(*[batch[c].to_pylist() for c in ("conv_id", *_ORDER)], strict=True):
                if begun and conv != current:
                    out.append((current, *_whole(turns, rows)))
                    turns, rows = [], []
                current, begun = conv, True
                if role is not None:
                    turns.append(turn)
                    rows.append((role, text))
            if len(out) >= 256:
                yield _batch(out, names, types)
                out = []
        if begun:
            out.append((current, *_whole(turns, rows)))
            yield _batch(out, names, types)

    return run


def _batch(rows: list[tuple], names: list[str], types: list[pa.DataType]) -> pa.RecordBatch:
    columns = zip(*rows, strict=True) if rows else [[] for _ in names]
    return pa.RecordBatch.from_arrays([pa.array(list(v), t) for v, t in zip(columns, types, strict=True)], names)


def repair(conversations: DataFrame, *, block: int = BLOCK) -> DataFrame:
    """One row per ``conv_id`` of rows ``conv_id, turn, role, text``: faults, cheapest edits and the repaired text's digest.

    ``gaps`` counts the turns that are missing between the least and the greatest. Rows are taken by turn, nulls first,
    then role and text. The first fault of a row counts: ``blank`` (white space only), ``duplicate`` (role and text seen
    earlier), ``truncated`` (does not end in ``.!?``); ``illegal`` counts neighbours whose roles may not follow each
    other. A row with an empty role fits nowhere as it is, a null text is a space, and a row with a null role only says
    that there is such a conversation: one without other rows has zeros, an empty audit and the digest of nothing. Null
    ids are one conversation. An empty table gives an empty table; other columns are ignored.
    """
    rows = conversations.select("conv_id", "turn", "role", F.coalesce("text", F.lit(" ")).alias("text"))
    spark = rows.sparkSession
    sizes = rows.groupBy("conv_id").agg(F.count("role").alias("_rows"))
    largest = sizes.agg(F.max("_rows")).first()[0] or 0
    if largest <= block:
        return _repair_whole(rows)
    # Few conversations are long: at most all rows / block. Staged, Spark knows the size and chooses the join.
    long = stage(sizes.filter(F.col("_rows") > block).select(F.col("conv_id").alias("_long")), "long-conversations")
    same = F.col("conv_id").eqNullSafe(F.col("_long"))
    short = _repair_whole(rows.join(long, same, "left_anti"))
    return short.unionByName(_repair_blocks(rows.join(long, same, "left_semi").filter("role is not null"), block))


def _id_type(rows: DataFrame) -> tuple[str, pa.DataType]:
    from pyspark.sql.pandas.types import to_arrow_type

    field = rows.schema["conv_id"].dataType
    return field.simpleString(), to_arrow_type(field)


def _repair_whole(rows: DataFrame) -> DataFrame:
    name, arrow = _id_type(rows)
    ordered = rows.repartition("conv_id").sortWithinPartitions("conv_id", *_ORDER)
    return ordered.mapInArrow(_whole_groups(arrow), _RESULT.format(id=name))


# Long conversations.

_WAYS = "conv_id {id}, block long, ways array<struct<entry:int,exit:int,cost:long,rank:int>>"
_PIECE = "conv_id {id}, block long, audit string, text string, n int"


def _tokens_of(table: dict) -> list[tuple[str, bool, bool]]:
    return list(zip(table["initial"], table["del"], table["cut"], strict=True))


def _block_ways(key: tuple[pa.Scalar, ...], table: pa.Table) -> pa.Table:
    """What it costs to get from each stack before the block to each stack after it."""
    columns = table.sort_by("seq").select(["initial", "del", "cut"]).to_pydict()
    tokens, ways = _tokens_of(columns), []
    for entry, start in enumerate(STACKS):
        tops = sorted(parse(tokens, start).values(), key=lambda t: t[1])
        ways += [
            {"entry": entry, "exit": STACKS.index(stack), "cost": cost, "rank": rank}
            for rank, (cost, _, stack) in enumerate(tops)
        ]
    kind = pa.list_(pa.struct([("entry", pa.int32()), ("exit", pa.int32()), ("cost", pa.int64()), ("rank", pa.int32())]))
    return pa.table(
        {"conv_id": table["conv_id"][:1], "block": pa.array([key[1].as_py()], pa.int64()), "ways": pa.array([ways], kind)}
    )


def _best_way(key: tuple[pa.Scalar, ...], table: pa.Table) -> pa.Table:
    """Stack before and after each block of one conversation on its cheapest way.

    Of equal costs the least audit wins. Its order is known without audits: over the same rows they differ before either
    ends, so first the rank of what precedes counts, then the rank inside the block.
    """
    table = table.sort_by("block")
    alive = {0: (0, 0)}  # stack -> (cost, rank of its audit)
    back = []
    for ways in table["ways"].to_pylist():
        best: dict = {}
        for way in ways:
            if way["entry"] in alive:
                cost, rank = alive[way["entry"]]
                offered = (cost + way["cost"], rank, way["rank"], way["entry"])
                # Equal tops are merged across entries, too.
                top = STACKS[way["exit"]][0]
                if top not in best or offered < best[top][0]:
                    best[top] = (offered, way["exit"])
        order = sorted(best.values(), key=lambda b: b[0][1:3])
        alive = {stack: (offered[0], n) for n, (offered, stack) in enumerate(order)}
        back.append({stack: offered[3] for offered, stack in best.values()})
    # Ranks stand for audits here, as what is inserted after the last row follows them.
    ends = {STACKS[s][0]: (cost, chr(rank), STACKS[s]) for s, (cost, rank) in alive.items()}
    accepted = [t for state, t in _with_inserts(ends).items() if state in ACCEPT]
    cost, audit, _ = min(accepted, key=lambda t: t[:2])
    at = next(s for s, (_, rank) in alive.items() if rank == ord(audit[0]))
    entries, exits = [], []
    for step in reversed(back):
        exits.append(at)
        at = step[at]
        entries.append(at)
    n = len(back)
    return pa.table(
        {
            "conv_id": table["conv_id"],
            "block": table["block"],
            "entry": pa.array(entries[::-1], pa.int32()),
            "exit": pa.array(exits[::-1], pa.int32()),
            "total": pa.array([cost] * n, pa.int64()),
            "inserts": pa.array([0] * (n - 1) + [len(audit) - 1], pa.int32()),
        }
    )


def _block_piece(key: tuple[pa.Scalar, ...], table: pa.Table) -> pa.Table:
    """Audit and repaired text of a block, from its stack before and after."""
    table = table.sort_by("seq")
    columns = table.select(["role", "text", "initial", "del", "cut"]).to_pydict()
    entry, exit, inserts = (table[c][0].as_py() for c in ("entry", "exit", "inserts"))
    tops = parse(_tokens_of(columns), STACKS[entry])
    audit = tops[STACKS[exit][0]][1] + "I" * inserts
    rows = repaired(list(zip(columns["role"], columns["text"], strict=True)), audit, STACKS[entry])
    text = "\n".join(f"{role}:{text}" for role, text in rows)
    return pa.table(
        {
            "conv_id": table["conv_id"][:1],
            "block": pa.array([key[1].as_py()], pa.int64()),
            "audit": [audit],
            "text": [text],
            "n": pa.array([len(rows)], pa.int32()),
        }
    )


def _digests(id_type: pa.DataType):
    """Audit and digest of each conversation, from pieces sorted by conversation and block, one piece at a time."""
    names, types = ["conv_id", "audit", "repaired_sha256"], [id_type, pa.string(), pa.string()]

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        current, begun, audit, digest, any_row = None, False, [], hashlib.sha256(), False
        for batch in small(batches, 1):
            conv = batch["conv_id"][0].as_py()
            if begun and conv != current:
                yield _batch([(current, "".join(audit), digest.hexdigest())], names, types)
                audit, digest, any_row = [], hashlib.sha256(), False
            current, begun = conv, True
            audit.append(batch["audit"][0].as_py())
            if batch["n"][0].as_py():
                if any_row:
                    digest.update(b"\n")
                any_row = True
                digest.update(batch["text"][0].as_buffer())
        if begun:
            yield _batch([(current, "".join(audit), digest.hexdigest())], names, types)

    return run


def _repair_blocks(rows: DataFrame, block: int) -> DataFrame:
    """``repair`` for conversations of more than ``block`` rows; all rows have a role."""
    name, arrow = _id_type(rows)
    numbered = stage(
        number_rows(rows, ["conv_id"], _ORDER, hot_rows=block)
        .withColumn("block", F.floor((F.col("seq") - 1) / block).cast("long"))
        .withColumn("_same", F.sha2(F.concat_ws(":", F.length("role").cast("string"), "role", "text"), 256)),
        "numbered-turns",
    )
    # Seen earlier: all but the first of equal rows, found by a pre-aggregated minimum.
    first = numbered.groupBy("conv_id", "_same").agg(F.min("seq").alias("_first"))
    first = first.select(F.col("conv_id").alias("_c"), F.col("_same").alias("_s"), "_first")
    blank = F.col("text").rlike(_NO_WORD)
    again = F.col("seq") > F.col("_first")
    initial = F.substring("role", 1, 1)
    judged = stage(
        numbered.join(first, F.col("conv_id").eqNullSafe(F.col("_c")) & (F.col("_same") == F.col("_s")))
        .withColumns({"blank": blank, "duplicate": ~blank & again, "initial": initial})
        .withColumn("cut", ~blank & ~again & ~F.regexp_like("text", F.lit(_END)))
        .withColumn("del", F.col("blank") | F.col("duplicate"))
        .drop("_c", "_s", "_first", "_same"),
        "judged-turns",
    )
    keys = ["conv_id", "block"]
    ways = (
        judged.select(*keys, "seq", "initial", "del", "cut")
        .groupBy(*keys)
        .applyInArrow(_block_ways, _WAYS.format(id=name))
    )
    way = _PATH.format(id=name)
    path = stage(ways.groupBy("conv_id").applyInArrow(_best_way, way), "ways")
    path = path.withColumnsRenamed({"conv_id": "_c", "block": "_b"})
    on_path = F.col("conv_id").eqNullSafe(F.col("_c")) & (F.col("block") == F.col("_b"))
    pieces = (
        judged.join(path, on_path)
        .select(*keys, "seq", "role", "text", "initial", "del", "cut", "entry", "exit", "inserts")
        .groupBy(*keys)
        .applyInArrow(_block_piece, _PIECE.format(id=name))
        .repartition("conv_id")
        .sortWithinPartitions(*keys)
    )
    texts = pieces.mapInArrow(_digests(arrow), f"conv_id {name}, audit string, repaired_sha256 string")
    return (
        _counts(judged)
        .join(path.groupBy("_c").agg(F.max("total").alias("cost")), F.col("conv_id").eqNullSafe(F.col("_c")))
        .drop("_c")
        .join(texts.withColumnRenamed("conv_id", "_c"), F.col("conv_id").eqNullSafe(F.col("_c")))
        .select("conv_id", "gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit", "repaired_sha256")
    )


_PATH = "conv_id {id}, block long, entry int, exit int, total long, inserts int"


def _counts(judged: DataFrame) -> DataFrame:
    """Faults per conversation; neighbours are met by their numbers, inside a block by a window, across blocks by its ends."""
    near = Window.partitionBy("conv_id", "block").orderBy("seq")
    pairs = judged.select(
        "conv_id", "block", "turn", "blank", "duplicate", "cut", "initial", "seq",
        F.lag("initial").over(near).alias("_before"),
    )
    ends = pairs.groupBy("conv_id", "block").agg(
        F.min("turn").alias("low"),
        F.max("turn").alias("high"),
        F.min_by("initial", "seq").alias("_first"),
        F.max_by("initial", "seq").alias("_last"),
        *[F.sum(F.col(c).cast("long")).alias(n) for c, n in (("blank", "blank"), ("duplicate", "duplicate"), ("cut", "truncated"))],
        F.sum(_illegal(F.col("_before"), F.col("initial"))).alias("_illegal"),
    )
    along = Window.partitionBy("conv_id").orderBy("block")  # a row per block
    ends = ends.withColumn("_illegal", F.col("_illegal") + _illegal(F.lag("_last").over(along), F.col("_first")))
    turns = judged.filter("turn is not null").select("conv_id", "turn").distinct()
    turns = turns.groupBy(F.col("conv_id").alias("_t")).agg(F.count("*").alias("_turns"))
    sums = ends.groupBy("conv_id").agg(
        F.min("low").alias("low"),
        F.max("high").alias("high"),
        *[F.sum(c).alias(c) for c in ("blank", "duplicate", "truncated")],
        F.sum("_illegal").alias("illegal"),
    )
    gaps = F.coalesce(F.col("high") - F.col("low") + 1 - F.col("_turns"), F.lit(0)).cast("long")
    return (
        sums.join(turns, F.col("conv_id").eqNullSafe(F.col("_t")), "left").withColumn("gaps", gaps).drop("_t")
    )


def _illegal(before: Column, after: Column) -> Column:
    """1 where a role may not follow the one before it; 0 at the start."""
    return F.when(before.isNotNull() & ~F.concat(before, after).isin(*sorted(_LEGAL)), 1).otherwise(0).cast("long")


def op13_conversation_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    return repair(damage(read(spark, sf_dir, "conversations")))


# The same in SQL, by a plain automaton over the last role: e at the start, s, u and a after that role. A state holds its
# least cost, in twelve digits, and audit as one string, so that the least string is the least (cost, audit).
_MORE = "printf('%012d', cast({0}[1:12] as bigint) + {1}) || {0}[13:] || '{2}'"


def _oracle() -> str:
    def more(state: str, cost: str, edit: str) -> str:
        return _MORE.format(state, cost, edit)

    def inserted(state: str) -> str:
        return more(state, "5", "I")

    cut = "case when truncated then 5 else 0 end"
    moves = {
        "e": [(more("e2", "2", "D"), "true")],
        "s": [(more("s2", "2", "D"), "true"), (more("e2", cut, "K"), "keeps and initial = 's'")],
        "u": [(more("u2", "2", "D"), "true")],
        "a": [(more("a2", "2", "D"), "true")],
    }
    for before, after in (("e2", "u"), ("s2", "u"), ("a2", "u"), ("u2", "a")):
        moves[after] += [
            (more(before, cut, "K"), f"keeps and initial = '{after}'"),
            (more(before, f"1 + {cut}", "R"), f"keeps and initial <> '{after}'"),
        ]
    steps = ",\n    ".join(
        f"least({', '.join(f'case when {when} then {to} end' for to, when in ways)}) as {state}" for state, ways in moves.items()
    )
    u2 = f"least(u, {inserted('e')}, {inserted('s')}, {inserted('a')})"
    return rf"""
with recursive
polynomial(i, c, step) as (
  select i, i, 0 from range(256) t(i)
  union all
  select i, case when c & 1 = 1 then xor(c >> 1, 3988292384) else c >> 1 end, step + 1 from polynomial where step < 8),
crc_table as (select list(c order by i) as t from polynomial where step = 8),
keyed as (
  select conv_id, turn, coalesce(role, ' ') as role, coalesce(text, ' ') as text,
    coalesce(cast(conv_id as varchar), ' ') || ':' || coalesce(cast(turn as varchar), ' ') as key
  from conversations),
checksum(key, place, c) as (
  select distinct key, 0, cast(4294967295 as bigint) from keyed
  union all
  select key, place + 1, xor(c >> 8, t[(xor(c, ascii(key[place + 1])) & 255) + 1]) from checksum, crc_table where place < length(key)),
kinds as (select key, xor(c, 4294967295) % 20 as kind from checksum where place = length(key)),
damaged as (
  select conv_id, turn, case when kind = 4 then 'user' else role end as role,
    case when kind = 1 then '' when kind = 2 then regexp_replace(text, '[.!?]', '', 'g') else text end as text,
    unnest(range(case when kind = 3 then 2 else 1 end)) as copy
  from keyed join kinds using (key) where kind <> 0),
ordered as (
  select *, row_number() over (partition by conv_id order by turn nulls first, role, text) as seq, left(role, 1) as initial
  from damaged),
judged as (
  select *, regexp_full_match(text, '[\x20\x09-\x0D]*') as is_blank,
    row_number() over (partition by conv_id, role, text order by seq) > 1 as again,
    not regexp_matches(text, '[.!?][\x20\x09-\x0D]*\z') as is_open,
    lag(initial) over (partition by conv_id order by seq) as before
  from ordered),
faults as (
  select *, not is_blank and not again as keeps, not is_blank and not again and is_open as truncated from judged),
conv as (select distinct conv_id from conversations),
walk(conv_id, seq, e, s, u, a) as (
  select conv_id, cast(0 as bigint), '000000000000', cast(null as varchar), cast(null as varchar), cast(null as varchar) from conv
  union all
  select conv_id, seq, {steps}
  from (
    select w.conv_id, f.seq, initial, keeps, truncated, e as e2, s as s2, u2, least(a, {inserted('u2')}) as a2
    from (select *, {u2} as u2 from walk) w
    join faults f on f.conv_id is not distinct from w.conv_id and f.seq = w.seq + 1)),
ended as (
  select w.conv_id, least(e, a, {inserted(f"least(u, {inserted('e')}, {inserted('s')}, {inserted('a')})")}) as best
  from walk w join (select conv_id, max(seq) as seq from walk group by conv_id) l
    on l.conv_id is not distinct from w.conv_id and l.seq = w.seq),
edits as (
  select conv_id, cast(best[1:12] as bigint) as cost, best[13:] as audit from ended),
written(conv_id, audit, place, line, role, lines) as (
  select conv_id, audit, 0, cast(0 as bigint), '', cast([] as varchar[]) from edits
  union all
  select conv_id, audit, place + 1, line + moved, case when edit = 'D' then role else new_role end,
    case when edit = 'D' then lines else list_append(lines, new_role || ':' || case when edit = 'I' then '' else text end) end
  from (
    select w.conv_id, audit, place, w.line, w.role, lines, audit[place + 1] as edit, f.text,
      case when audit[place + 1] = 'I' then 0 else 1 end as moved,
      case when audit[place + 1] = 'K' then f.role when w.role[1] = 'u' then 'assistant' else 'user' end as new_role
    from written w left join faults f on f.conv_id is not distinct from w.conv_id and f.seq = w.line + 1
    where place < length(audit))),
counts as (
  select conv_id, max(turn) - min(turn) + 1 - count(distinct turn) as gaps,
    count(*) filter (is_blank) as blank, count(*) filter (again and not is_blank) as duplicate,
    count(*) filter (truncated) as truncated,
    count(*) filter (before is not null and before || initial not in ('su', 'ua', 'au')) as illegal
  from faults group by conv_id)
select e.conv_id, coalesce(gaps, 0) as gaps, coalesce(blank, 0) as blank, coalesce(duplicate, 0) as duplicate,
  coalesce(truncated, 0) as truncated, coalesce(illegal, 0) as illegal, cost, e.audit,
  sha256(array_to_string(lines, chr(10))) as repaired_sha256
from edits e join written w on w.conv_id is not distinct from e.conv_id and w.place = length(e.audit)
  left join counts c on c.conv_id is not distinct from e.conv_id
"""


ORACLE = _oracle()
