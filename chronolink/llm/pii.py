"""Personal data: fixed patterns, and candidates that boosted trees accept.

The base patterns always count. Generators of high recall propose further spans of the same kinds: addresses with
spelt-out signs, numbers in any grouping. Each candidate is described by its format and by the text around it. The base
patterns cannot label what they do not find, so boosted trees are fitted on copies of base spans rewritten in forms
that the patterns miss, against copies that fail (checksum, length, host, place) and numbers of the texts that fail. A
candidate that neither is a base span nor fails has no label and is not learned from. For each kind the lowest score is
accepted at which ``PRECISION`` of held-out examples are personal data. Examples with the same features are one row that
weighs as many, so trees and scores come from all examples of all texts. The trees become one SQL expression, so scoring is a
projection inside the row: no text is moved.
"""

from __future__ import annotations

from math import isqrt

from pyspark.ml.classification import GBTClassifier
from pyspark.ml.functions import array_to_vector
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from chronolink.plans.staging import stage

from .tables import read

KINDS = ("email", "ip", "card", "phone")
#: All examples of a class together weigh as much as so many, at most: in large corpora both classes weigh the same.
CLASS_WEIGHT = 10_000
#: Different examples per partition that the trees are fitted on.
ROWS = 100_000
ROUNDS = 8
DEPTH = 3
PRECISION = 0.95
SEED = 7

# The base patterns. Possessive steps, and starts only where a longer match could not have begun, keep
# the same matches without going over a long run again and again.
_LOCAL = "[A-Za-z0-9._%+-]"
BASE = {
    "email": rf"(?:(?<!{_LOCAL})|\G){_LOCAL}++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "ip": r"(?:(?<![0-9])|\G)[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++",
    "card": r"[0-9](?:[\x20-]?[0-9])++",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}
# What a text must have for a search to be worth it.
_NEEDS = {
    "email": "@",
    "ip": r"[0-9]\.[0-9]++\.[0-9]++\.[0-9]",
    "card": r"[0-9](?:[\x20-]?[0-9]){13}",
    "phone": r"\+[0-9]",
}
_BYTE = "^0*(?:[0-9]{1,2}|1[0-9]{2}|2[0-4][0-9]|25[0-5])$"

_AT = r"(?:@|\x20?(?:\(at\)|\[at\])\x20?)"
_DOT = r"(?:\.|\x20?(?:\(dot\)|\[dot\])\x20?)"
GENERATORS = {
    "address": rf"(?:(?<!{_LOCAL})|\G){_LOCAL}++{_AT}[A-Za-z0-9-]++(?:{_DOT}[A-Za-z0-9-]++)++",
    "number": r"(?:(?<![0-9])|\G)[+(]{0,2}[0-9](?:[\x20()./-]{0,2}+[0-9]){6,}+",
}
_GENERATOR_NEEDS = {
    "address": r"@|\(at\)|\[at\]",
    "number": r"[0-9](?:[\x20()./-]{0,2}+[0-9]){6}",
}

_DATE = (
    "^[(]?(?:(?:19|20)[0-9]{2}([-./])(?:0?[1-9]|1[0-2])\\\\1(?:0?[1-9]|[12][0-9]|3[01])"
    "|(?:0?[1-9]|[12][0-9]|3[01])([-./])(?:0?[1-9]|[12][0-9]|3[01])\\\\2(?:19|20)[0-9]{2})(?![0-9])"
)
#: Characters of context on the left of a candidate.
CONTEXT = 24
#: Features of a candidate ``c`` with digits ``c.digits``, text on the left ``c.before`` and next character ``c.after``.
FEATURES = {
    "kind": "c.kind",
    "length": "length(c.hit)",
    "digits": "length(c.digits)",
    "groups": "size(split(c.hit, '[^0-9]+'))",
    "longest group": "array_max(transform(split(c.hit, '[^0-9]+'), g -> length(g)))",
    "date": f"int(c.hit rlike '{_DATE}')",
    "bracket": "int(contains(c.hit, '('))",
    "dots": "size(split(c.hit, '[.]')) - 1",
    "dashes": "size(split(c.hit, '-')) - 1",
    "spaces": "size(split(c.hit, ' ')) - 1",
    "slashes": "size(split(c.hit, '/')) - 1",
    "checksum": "int(luhn_check(c.digits))",
    "ends in letters": "int(c.hit rlike '[A-Za-z]{2}$')",
    "joined on the left": "int(c.before rlike '[A-Za-z0-9_]$')",
    "joined on the right": "int(c.after rlike '^[A-Za-z0-9_]')",
    "quoted or assigned": "int(c.before rlike '[=\"]\\\\s*$')",
    "phone words": "int(lower(c.before) rlike 'tel|phone|call|mobil|fax|handy')",
    "card words": "int(lower(c.before) rlike 'card|visa|credit|karte|tarjeta|carte')",
    "mail words": "int(lower(c.before) rlike 'mail|contact|write|correo')",
    "host words": "int(lower(c.before) rlike 'ip|host|server|addr')",
}

_SPANS = "array<struct<kind:int,start:int,end:int,hit:string>>"
_NONE = f"cast(array() as {_SPANS})"


def _found(df: DataFrame, name: str, text: str, pattern: str, needs: str, kind: str) -> DataFrame:
    """Add ``name``: all matches of the pattern as (kind, start, end, hit), in code points.

    The text between matches gives their places. ``kind`` is SQL for the kind of a match ``hit``.
    """
    wanted = F.col(text).rlike(needs)
    df = df.withColumn("_hits", F.when(wanted, F.regexp_extract_all(text, F.lit(pattern), F.lit(0))))
    df = df.withColumn("_gaps", F.when(wanted, F.split(text, pattern, -1)))
    at = "s.at + length(_gaps[i])"
    step = (
        f"(s, i) -> named_struct('at', {at} + length(_hits[i]), 'out', concat(s.out, array("
        f"named_struct('kind', {kind.replace('hit', '_hits[i]')}, 'start', {at}, "
        f"'end', {at} + length(_hits[i]), 'hit', _hits[i]))))"
    )
    spans = (
        f"if(coalesce(size(_hits), 0) <= 0, {_NONE}, aggregate(sequence(0, size(_hits) - 1), "
        f"named_struct('at', 0, 'out', {_NONE}), {step}, s -> s.out))"
    )
    return df.withColumn(name, F.expr(spans)).drop("_hits", "_gaps")


_DIGITS = "regexp_replace({}, '[^0-9]', '')"
_KEEP = {
    "email": "true",
    "ip": f"forall(split(s.hit, '[.]'), p -> p rlike '{_BYTE}')",
    "card": f"length({_DIGITS.format('s.hit')}) between 14 and 19 and luhn_check({_DIGITS.format('s.hit')})",
    "phone": f"length({_DIGITS.format('s.hit')}) between 10 and 15",
}
_NUMBER_KIND = (
    f"if(hit rlike '^[0-9]{{1,3}}([.][0-9]{{1,3}}){{3}}$', 1, "
    f"if(length({_DIGITS.format('hit')}) >= 13 and not startswith({_DIGITS.format('hit')}, '00'), 2, 3))"
)

# Examples made of a base span ``b`` with ``b.digits``: SQL for the new form, and what stands before and after it if not
# what stands there in the text. ``b.local`` and ``b.host`` are the sides of an address, ``b.x``, ``b.y`` and ``b.z`` the last
# ten digits of a phone number, ``b.wrong`` the digits of a card with another check digit.
_ADDRESSES = (
    "concat(b.local, ' (at) ', replace({0}, '.', ' (dot) '))",
    "concat(b.local, '[at]', replace({0}, '.', '[dot]'))",
    "concat(b.local, ' [at] ', {0})",
    "concat(b.local, '(at)', {0})",
    "concat(b.local, '@', replace({0}, '.', ' [dot] '))",
)
_NO_HOSTS = ("'4.50'", "'c.d'", "regexp_replace(b.host, '[A-Za-z]', '4')")
_BARE = "concat(b.x, b.y, b.z)"
_PLAIN, _INSIDE = ("' '", "' '"), ("'id c'", "'f'")
_GROUPED = "trim(regexp_replace({0}, '([0-9]{{4}})', '$1 '))"
PERSONAL = {
    "email": [(form.format("b.host"),) for form in _ADDRESSES],
    "card": [(f"replace({_GROUPED.format('b.digits')}, ' ', '{sign}')",) for sign in (".", "/", "  ")],
    "phone": [
        ("concat('(', b.x, ') ', b.y, '-', b.z)",),
        *[(f"concat_ws('{sign}', b.x, b.y, b.z)",) for sign in "-. "],
        ("concat(b.x, '/', b.y, b.z)",),
        (f"trim(regexp_replace({_BARE}, '([0-9]{{2}})', '$1 '))",),
        ("concat('1-', concat_ws('-', b.x, b.y, b.z))",),
        ("concat('00', substring(b.digits, 1, 1), ' ', concat_ws(' ', b.x, b.y, b.z))",),
        (_BARE,),
        (_BARE, "'phone '", "' '"),
    ],
}
FAILING = {
    "email": [(form.format(host),) for form in _ADDRESSES for host in _NO_HOSTS],
    "card": [
        ("b.wrong",), *[(f"replace({_GROUPED.format('b.wrong')}, ' ', '{sign}')",) for sign in (" ", "-", ".", "/", "  ")],
    ],
    "phone": [
        (_BARE, *_PLAIN), (_BARE, *_INSIDE), ("concat_ws('-', b.x, b.y, b.z)", *_INSIDE),
        ("concat(b.y, '-', b.z)",), ("concat_ws(' ', b.x, b.z)",), ("substring(b.digits, 1, 8)",),
        ("concat_ws('-', b.x, b.y, substring(b.z, 1, 2))",),
        ("concat('20', substring(b.z, 1, 2), '-0', b.one, '-1', b.two, ' 1', b.one)", "' '", "':'"),
        ("concat('1', b.two, '.0', b.one, '.20', substring(b.z, 1, 2), ' 1', b.one)", "' '", "':'"),
        ("concat_ws(' ', split(concat(b.x, b.y, b.z), ''))",), ("concat_ws('.', split(concat(b.x, b.y), ''))",),
        ("concat_ws(' ', b.z, b.z, b.z)",), ("concat('20', substring(b.z, 1, 2), '-20', substring(b.y, 1, 2))",),
    ],
}


def _base(df: DataFrame, text: str) -> DataFrame:
    """Add ``_base``, the spans of the base patterns, by start and kind."""
    for no, kind in enumerate(KINDS):
        df = _found(df, f"_{kind}", text, BASE[kind], _NEEDS[kind], str(no))
    kept = [f"filter(_{kind}, s -> {_KEEP[kind]})" for kind in KINDS]
    order = "(a, b) -> case when a.start < b.start then -1 when a.start > b.start then 1 else a.kind - b.kind end"
    df = df.withColumn("_base", F.expr(f"array_sort(concat({', '.join(kept)}), {order})"))
    return df.drop(*[f"_{kind}" for kind in KINDS])


def _context(text: str, s: str) -> str:
    """SQL for the fields with what stands before and after a span ``s``."""
    return (
        f"'before', substring({text}, greatest({s}.start - {CONTEXT}, 0) + 1, least({s}.start, {CONTEXT})), "
        f"'after', substring({text}, {s}.end + 1, 1)"
    )


_FEATURES = f"array({', '.join(f'double({f})' for f in FEATURES.values())})"


def _candidates(df: DataFrame, text: str, fails: str = "") -> DataFrame:
    """Add ``_candidates`` (kind, start, end, features, base: whether a base span overlaps, and what ``fails`` adds)."""
    df = _found(df, "_address", text, GENERATORS["address"], _GENERATOR_NEEDS["address"], "0")
    df = _found(df, "_number", text, GENERATORS["number"], _GENERATOR_NEEDS["number"], _NUMBER_KIND)
    context = (
        f"named_struct('kind', s.kind, 'start', s.start, 'end', s.end, 'hit', s.hit, "
        f"'digits', {_DIGITS.format('s.hit')}, {_context(text, 's')})"
    )
    overlap = "exists(_base, b -> b.start < c.end and c.start < b.end)"
    made = (
        f"transform(transform(concat(_address, _number), s -> {context}), c -> named_struct('kind', c.kind, "
        f"'start', c.start, 'end', c.end, 'f', {_FEATURES}, 'base', {overlap}{fails}))"
    )
    return df.withColumn("_candidates", F.expr(made)).drop("_address", "_number")


_JOINED = "c.before rlike '[A-Za-z0-9_]$' or c.after rlike '^[A-Za-z0-9_]'"
#: Whether a candidate cannot be personal data.
_FAILS = (
    f", 'fails', c.kind <> 1 and ({_JOINED} or c.hit rlike '{_DATE}' "
    "or c.kind = 2 and not (length(c.digits) <= 19 and luhn_check(c.digits)))"
)


def _examples(df: DataFrame, text: str) -> DataFrame:
    """Add ``_examples`` (kind, start, end, features, label) to rows with ``_base``: rewritten copies, and what fails.

    A dotted number of four parts that is no base span has a part over 255, so there is nothing to learn about addresses of
    hosts. Copies of a span have its place.
    """
    df = _candidates(df, text, _FAILS)
    digits = _DIGITS.format("s.hit")
    digit = f"try_cast(substring({digits}, -1, 1) as int)"  # an address may have none
    span = (
        f"named_struct('kind', s.kind, 'start', s.start, 'end', s.end, 'digits', {digits}, "
        f"'local', substring_index(s.hit, '@', 1), 'host', substring_index(s.hit, '@', -1), "
        f"'x', substring({digits}, -10, 3), 'y', substring({digits}, -7, 3), 'z', substring({digits}, -4, 4), "
        f"'one', string({digit} % 9 + 1), 'two', substring({digits}, -2, 1), "
        f"'wrong', concat(substring({digits}, 1, length({digits}) - 1), string(({digit} + 1) % 10)), {_context(text, 's')})"
    )

    def copies(kind: str) -> str:
        made = [
            f"named_struct('kind', b.kind, 'start', b.start, 'end', b.end, 'hit', {form}, "
            f"'before', {around[0] if around else 'b.before'}, 'after', {around[1] if around else 'b.after'}, 'label', {label})"
            for label, forms in (("1D", PERSONAL), ("0D", FAILING))
            for form, *around in forms[kind]
        ]
        return f"array({', '.join(made)})"

    cases = " ".join(f"when {KINDS.index(kind)} then {copies(kind)}" for kind in PERSONAL)
    # Hosts such as 1.2 or x.y are base spans, but say nothing about spelt-out ones.
    usable = "filter(_base, s -> s.kind <> 1 and (s.kind <> 0 or s.hit rlike '[A-Za-z]{2}$'))"
    copied = f"flatten(transform(transform({usable}, s -> {span}), b -> case b.kind {cases} end))"
    with_digits = (
        f"transform({copied}, s -> named_struct('kind', s.kind, 'start', s.start, 'end', s.end, 'hit', s.hit, "
        f"'digits', {_DIGITS.format('s.hit')}, 'before', s.before, 'after', s.after, 'label', s.label))"
    )
    fields = "'kind', c.kind, 'start', c.start, 'end', c.end, 'f'"
    examples = (
        f"concat(transform({with_digits}, c -> named_struct({fields}, {_FEATURES}, 'label', c.label)), "
        f"transform(filter(_candidates, c -> c.fails and not c.base), c -> named_struct({fields}, c.f, 'label', 0D)))"
    )
    return df.withColumn("_examples", F.expr(examples)).drop("_candidates")


def _tree_sql(node) -> str:
    if node.subtreeDepth() == 0:
        return repr(float(node.prediction())) + "D"
    split = node.split()
    left, right = _tree_sql(node.leftChild()), _tree_sql(node.rightChild())
    return f"if(c.f[{split.featureIndex()}] <= {float(split.threshold())!r}D, {left}, {right})"


def fit(docs: DataFrame, *, text: str = "text") -> tuple[str, list[float]]:
    """Boosted trees as SQL for the score of a candidate ``c``, and the least score accepted per kind.

    Every example counts: half of them, by a hash, are learned from, the others choose the scores. All copies of a span are
    on one side of the split. Where there are examples of one class only there is nothing to learn, and no candidate is
    accepted.
    """
    made = _examples(_base(docs.select(F.col(text).alias("_text")), "_text"), "_text")
    rows = made.select(F.xxhash64("_text").alias("h"), F.explode("_examples").alias("c"))
    keys = ["kind", "label", "learn", "f"]
    rows = rows.select("c.kind", "c.label", (F.xxhash64("h", "c.start", "c.end") % 2 == 0).alias("learn"), "c.f")
    # Sorted, and in few partitions unless there are many rows, so that sums of doubles are the same in each run.
    examples = stage(rows.groupBy(*keys).agg(F.count(F.lit(1)).alias("n")).sortWithinPartitions(*keys), "pii-examples")
    counted = examples.groupBy(*keys[:3]).agg(F.sum("n").alias("n"), F.count(F.lit(1)).alias("rows")).collect()
    totals = {label: sum(r["n"] for r in counted if r["label"] == label) for label in (0.0, 1.0)}
    never = [2.0] * len(KINDS)
    learned = {no: [r["rows"] for r in counted if r["kind"] == no and r["learn"]] for no in range(len(KINDS))}
    kinds = [no for no, classes in learned.items() if len(classes) == 2]
    if not kinds:
        return "0D", never
    shares = {label: min(n, CLASS_WEIGHT) / n for label, n in totals.items()}
    weight = F.col("n") * F.when(F.col("label") == 1, shares[1.0]).otherwise(shares[0.0])
    weighted = examples.withColumn("w", weight).coalesce(max(2, sum(r["rows"] for r in counted) // ROWS))
    learn, check = weighted.filter("learn"), weighted.filter("not learn")
    scores = []
    for no in kinds:  # trees of their own, as what tells one kind says little about another
        # Spark looks for splits in a sample of 10,000 rows or the square of this.
        bins = max(32, isqrt(sum(learned[no])) + 1)
        trees = GBTClassifier(
            maxIter=ROUNDS, maxDepth=DEPTH, maxBins=bins, seed=SEED, featuresCol="v", labelCol="label", weightCol="w"
        )
        model = trees.fit(learn.filter(F.col("kind") == no).select(array_to_vector("f").alias("v"), "label", "w"))
        terms = [
            f"{w!r}D * {_tree_sql(t._call_java('rootNode'))}"
            for t, w in zip(model.trees, model.treeWeights, strict=True)
        ]
        scores.append(f"when {no} then 1D / (1D + exp(-2D * ({' + '.join(terms)})))")
    score = f"(case c.kind {' '.join(scores)} else 0D end)"
    # A row for each kind and hundredth of the score.
    bins = (
        check.select(F.struct("kind", "f").alias("c"), "label", "w")
        .groupBy("c.kind", F.expr(f"floor(({score}) * 100)").alias("bin"))
        .agg(F.sum(F.col("label") * F.col("w")).alias("hits"), F.sum("w").alias("n"))
        .orderBy("kind", F.desc("bin"))
        .collect()
    )
    least = list(never)
    for no in range(len(KINDS)):
        hits = n = 0
        for b in (b for b in bins if b["kind"] == no):
            hits, n = hits + b["hits"], n + b["n"]
            if hits >= PRECISION * n:
                least[no] = b["bin"] / 100
    return score, least


def _spans(df: DataFrame, text: str, model: tuple[str, list[float]]) -> DataFrame:
    """Add ``_base`` and ``_spans``; accepted candidates never touch a base span or each other."""
    score, least = model
    df = _candidates(_base(df, text), text)
    accepted = f"filter(_candidates, c -> not c.base and {score} >= array({', '.join(map(str, least))})[c.kind])"
    places = f"array_sort(transform({accepted}, c -> named_struct('start', c.start, 'kind', c.kind, 'end', c.end)))"
    empty = "cast(array() as array<struct<start:int,kind:int,end:int>>)"
    apart = (
        f"aggregate({places}, named_struct('end', 0, 'out', {empty}), (s, c) -> if(c.start < s.end, s, "
        "named_struct('end', c.end, 'out', concat(s.out, array(c)))), s -> s.out)"
    )
    df = df.withColumn("_added", F.expr(apart))
    base = "transform(_base, b -> named_struct('start', b.start, 'kind', b.kind, 'end', b.end))"
    return df.withColumn("_spans", F.expr(f"array_sort(concat({base}, _added))")).drop("_candidates", "_added")


def _written(spans: str) -> Column:
    names = ", ".join(f"'{k}'" for k in KINDS)
    one = f"concat(array({names})[s.kind], ':', s.start, ':', s.end)"
    return F.expr(f"array_join(transform({spans}, s -> {one}), ',')")


def find(docs: DataFrame, model: tuple[str, list[float]], *, id: str = "doc_id", text: str = "text") -> DataFrame:
    """Per document the number of base spans of each kind, ``base`` and ``spans`` (kind:start:end, comma-joined).

    Places count code points, the end is exclusive. A null or empty text has no spans; repeated rows each get
    their result; an empty table gives an empty table; other columns are ignored.
    """
    plain = docs.select(F.col(id).alias("_id"), F.coalesce(F.col(text), F.lit("")).alias("_text"))
    found = _spans(plain, "_text", model)
    counts = [
        F.expr(f"size(filter(_base, b -> b.kind = {no}))").cast("long").alias(f"n_{kind}")
        for no, kind in enumerate(KINDS)
    ]
    return found.select(
        F.col("_id").alias(id), *counts, _written("_base").alias("base"), _written("_spans").alias("spans")
    )


def redact(docs: DataFrame, model: tuple[str, list[float]], *, text: str = "text", length: str = "n_chars") -> DataFrame:
    """The documents with every span replaced by its kind in brackets, such as ``[EMAIL]``.

    Spans that touch each other are replaced together, by the kind of the first. A column ``length`` follows the new
    text. Other rows and columns stay as they are, null texts too.
    """
    names = {c: f"_c{n}" for n, c in enumerate(docs.columns)}
    own = names[text]
    df = docs.select(*[F.col(c).alias(n) for c, n in names.items()])
    df = _spans(df.withColumn("_text", F.coalesce(F.col(own), F.lit(""))), "_text", model)
    # One struct per stretch to replace: what stands before it, and its kind.
    merged = (
        "aggregate(_spans, cast(array() as array<struct<start:int,kind:int,end:int>>), (out, s) -> "
        "if(size(out) > 0 and s.start < element_at(out, -1).end, concat(slice(out, 1, size(out) - 1), array("
        "named_struct('start', element_at(out, -1).start, 'kind', element_at(out, -1).kind, "
        "'end', greatest(element_at(out, -1).end, s.end)))), concat(out, array(s))))"
    )
    labels = ", ".join(f"'[{k.upper()}]'" for k in KINDS)
    before = "if(i = 0, 0, _m[i - 1].end)"
    pieces = (
        f"transform(_m, (m, i) -> concat(substring(_text, {before} + 1, m.start - {before}), array({labels})[m.kind]))"
    )
    rest = "substring(_text, element_at(_m, -1).end + 1)"
    df = df.withColumn("_m", F.expr(merged))
    new = F.when(F.size("_m") == 0, F.col(own)).otherwise(F.expr(f"concat(array_join({pieces}, ''), {rest})"))
    df = df.withColumn("_new", new)
    out = {c: F.col(n) for c, n in names.items()} | {text: F.col("_new")}
    if length in names and length != text:
        kind = docs.schema[length].dataType
        changed = F.size("_m") > 0
        out[length] = F.when(changed, F.length("_new").cast(kind)).otherwise(F.col(names[length]))
    return df.select(*[column.alias(c) for c, column in out.items()])


def op10_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents")
    return find(docs, fit(docs)).select(
        "doc_id", *[f"n_{kind}" for kind in KINDS], F.sha2("base", 256).alias("base_sha256"), "spans"
    )
