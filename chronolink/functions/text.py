"""Expressions for titles, entities, literal counts and output lines."""

from __future__ import annotations

import json
from html.entities import name2codepoint

from pyspark.sql import Column
from pyspark.sql import functions as F

# The five entities that XML defines.
XML_ENTITIES = {"amp": "&", "lt": "<", "gt": ">", "quot": '"', "apos": "'"}
# The HTML 4 entities, as the standard library lists them.
HTML_ENTITIES = {name: chr(code) for name, code in name2codepoint.items()}

# From so many literals on, a text is looked through once for all of them.
MANY_LITERALS = 256
# Bytes of a run whose places are sorted, and halvings that find one among the places of a text of up to 2 GB.
GRAM = 4
HALVINGS = 32

# A date, with or without a time, and no time zone after it.
ZONELESS = r"^\s*[+-]?[0-9-]+([ T][0-9:.]*)?\s*$"


def unescape_html(text: Column | str) -> Column:
    """Replace HTML 4 named entities and numeric character references, each once."""
    return _unescape(text, HTML_ENTITIES)


def unescape_xml(text: Column | str) -> Column:
    """Replace the XML entities and numeric character references, each once."""
    return _unescape(text, XML_ENTITIES)


def _unescape(text, entities):
    text = F.col(text) if isinstance(text, str) else text
    # As JSON the whole table is one literal in the plan, folded into a map once.
    table = F.from_json(
        F.lit(json.dumps({f"&{name};": char for name, char in entities.items()})),
        "map<string,string>",
    )
    # One left-to-right pass over the pieces, so "&amp;lt;" becomes "&lt;" and no more.
    pieces = F.regexp_extract_all(text, F.lit(r"&#?\w+;|[^&]+|&"), F.lit(0))
    whole = F.array_join(F.transform(pieces, lambda p: _decode(p, table)), "")
    return F.when(F.contains(text, F.lit("&")), whole).otherwise(text)


def _decode(piece, table):
    digits = F.regexp_extract(piece, r"^&#0*([0-9]{1,7});$", 1)
    hexits = F.regexp_extract(piece, r"^&#[xX]0*([0-9a-fA-F]{1,6});$", 1)
    code = F.coalesce(digits.try_cast("long"), F.conv(hexits, 16, 10).try_cast("long"))
    surrogate = code.between(0xD800, 0xDFFF)
    char = F.when(
        code.between(1, 0x10FFFF) & ~surrogate,
        F.decode(F.unhex(F.lpad(F.hex(code), 8, "0")), "UTF-32"),
    )
    return (
        F.when(piece.startswith("&#"), F.coalesce(char, piece))
        .when(piece.startswith("&"), F.coalesce(F.try_element_at(table, piece), piece))
        .otherwise(piece)
    )


def escape_xml(text: Column | str) -> Column:
    """Escape text for use between XML tags."""
    escaped = F.col(text) if isinstance(text, str) else text
    for char, entity in (("&", "&amp;"), ("<", "&lt;"), (">", "&gt;")):
        escaped = F.replace(escaped, F.lit(char), F.lit(entity))
    return escaped


def literal_counts(text: str, literals: Column | str, *, many: int = MANY_LITERALS) -> Column:
    """How often each of an array of literals occurs in the text, as ``ARRAY<BIGINT>``.

    Case-sensitive, non-overlapping, no word boundary: ``The`` is also found in ``Then``. An empty literal
    or a null text counts 0. ``text`` names a column, as an expression would be worked out for every literal.

    For ``many`` literals or more the text is looked through once: the places of all its runs of four bytes are sorted,
    and a literal is compared only where its first four bytes stand. So the cost is the text and what is found,
    not the text for each literal.
    """
    text = F.col(text)
    literals = F.col(literals) if isinstance(literals, str) else literals
    last = F.octet_length(text) - GRAM + 1

    def sorted_places(raw: Column) -> Column:
        places = F.transform(
            F.sequence(F.lit(1), last),
            lambda at: F.shiftleft(F.hash(F.substring(raw, at, F.lit(GRAM))).cast("long"), 32) + at,
        )
        return F.when((F.size(literals) >= many) & (last > 0), F.sort_array(places))

    def count(literal: Column, held: Column) -> Column:
        quoted = F.concat(F.lit(r"\Q"), F.replace(literal, F.lit(r"\E"), F.lit(r"\E\\E\Q")), F.lit(r"\E"))
        # Most literals of a text are not in it, and a look for one is much cheaper than cutting at it.
        there = (literal != "") & F.contains(text, literal)
        one_by_one = F.when(there, F.size(F.split(text, quoted, F.lit(-1))) - 1).otherwise(0).cast("long")
        sorted_enough = held.places.isNotNull() & (F.octet_length(literal) >= GRAM)
        return F.when(sorted_enough, _count_at(literal.cast("binary"), held)).otherwise(one_by_one)

    # Bytes, and then places, are worked out once per row, as the only element of an array.
    raws = F.array(text.cast("binary"))
    once = F.transform(raws, lambda raw: F.struct(raw.alias("raw"), sorted_places(raw).alias("places")))
    counted = F.get(F.transform(once, lambda held: F.transform(literals, lambda x: count(x, held))), F.lit(0))
    nothing = F.transform(literals, lambda _: F.lit(0).cast("long"))
    return F.coalesce(F.when(text.isNull(), nothing).otherwise(counted), F.array().cast("array<bigint>"))


def _count_at(literal: Column, held: Column) -> Column:
    """Non-overlapping occurrences of a literal's bytes, from the sorted places of its first bytes."""
    low = F.shiftleft(F.hash(F.substring(literal, F.lit(1), F.lit(GRAM))).cast("long"), 32)
    first, end = _lower_bound(held.places, low), _lower_bound(held.places, low + (1 << 32))
    length = F.octet_length(literal)
    none = F.struct(F.lit(0).alias("free"), F.lit(0).cast("long").alias("n"))

    def step(state: Column, number: Column) -> Column:
        at = F.get(held.places, number).bitwiseAND(F.lit((1 << 32) - 1)).cast("int")
        hit = (at >= state.free) & (F.substring(held.raw, at, length) == literal)
        return F.when(hit, F.struct((at + length).alias("free"), (state.n + 1).alias("n"))).otherwise(state)

    # Numbers of the places, not a slice of them: that would copy all places for every literal.
    found = F.when(first < end, F.sequence(first, end - 1))
    return F.coalesce(F.aggregate(found, none, step, lambda state: state.n), F.lit(0).cast("long"))


def _lower_bound(places: Column, value: Column) -> Column:
    """How many of the sorted numbers are less than the value, by halving."""
    whole = F.struct(F.lit(0).alias("low"), F.size(places).alias("high"))

    def halve(state: Column, _: Column) -> Column:
        middle = F.shiftright(state.low + state.high, 1)
        less = F.get(places, middle) < value
        return (
            F.when(state.low >= state.high, state)
            .when(less, F.struct((middle + 1).alias("low"), state.high.alias("high")))
            .otherwise(F.struct(state.low.alias("low"), middle.alias("high")))
        )

    return F.aggregate(F.sequence(F.lit(1), F.lit(HALVINGS)), whole, halve, lambda state: state.low)


def file_key(title: Column | str) -> Column:
    """The title with all whitespace taken out."""
    return F.regexp_replace(title, r"\s", "")


def iso_seconds(time: Column | str) -> Column:
    """A wall-clock time as ``2001-12-12T06:32:58``, whatever the session time zone."""
    time = F.col(time) if isinstance(time, str) else time
    return F.replace(F.substring(time.cast("string"), 1, 19), F.lit(" "), F.lit("T"))


def edge_line(valid_from="valid_from", valid_to="valid_to", target="target", cnt="cnt") -> Column:
    """``[from,to] target count``."""
    return F.concat(
        F.lit("["),
        iso_seconds(valid_from),
        F.lit(","),
        F.coalesce(iso_seconds(valid_to), F.lit("")),
        F.lit("] "),
        F.col(target) if isinstance(target, str) else target,
        F.lit(" "),
        (F.col(cnt) if isinstance(cnt, str) else cnt).cast("string"),
    )


def utc_time(text: Column) -> Column:
    """ISO 8601 text as UTC wall-clock time, null when malformed.

    A time without a zone is taken as UTC. The value does not depend on the session time zone.
    """
    instant = F.try_to_timestamp(text)
    seconds = F.unix_micros(instant).cast("decimal(18,0)") / F.lit(1_000_000).cast("decimal(7,0)")
    epoch = F.lit("1970-01-01 00:00:00").cast("timestamp_ntz")
    zoned = epoch + F.make_dt_interval(secs=seconds.cast("decimal(18,6)"))
    return F.when(text.rlike(ZONELESS), text.try_cast("timestamp_ntz")).otherwise(zoned)
