"""License scans by rules over sentences.

A text is cut into sentences, each is normalised (lower case, words only, a name of a holder as a gap) and looked up among
known license sentences. What is left of a text is the sequence of its sentence identifiers. A rule is an ordered list of
identifiers that must come in that order, with others between them or not; some must stand next to each other. Every
license with a rule that matches is found, but for rules whose sentences are all among those of a fuller rule that matches
for another license: the two clauses of one license are part of the three of another.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .tables import read, sql_strings

# Normalised sentences of public license texts and notices. Identifiers count from 1.
SENTENCES = {
    "mit title": "mit license",
    "mit title the": "the mit license mit",
    "mit grant": (
        "permission is hereby granted free of charge to any person obtaining a copy of this software and "
        "associated documentation files the software to deal in the software without restriction including "
        "without limitation the rights to use copy modify merge publish distribute sublicense and or sell "
        "copies of the software and to permit persons to whom the software is furnished to do so subject to "
        "the following conditions"
    ),
    "mit notice kept": (
        "the above copyright notice and this permission notice shall be included in all copies or substantial "
        "portions of the software"
    ),
    "as is": (
        "the software is provided as is without warranty of any kind express or implied including but not "
        "limited to the warranties of merchantability fitness for a particular purpose and noninfringement"
    ),
    "mit released": "released under the mit license",
    "mit licensed": "licensed under the mit license",
    "apache title": "apache license",
    "apache notice": "licensed under the apache license version 2 0",
    "apache notice long": "licensed under the apache license version 2 0 the license",
    "apache use": "you may not use this file except in compliance with the license",
    "apache copy": "you may obtain a copy of the license at",
    "bsd use": (
        "redistribution and use in source and binary forms with or without modification are permitted provided "
        "that the following conditions are met"
    ),
    "bsd source": (
        "redistributions of source code must retain the above copyright notice this list of conditions and the "
        "following disclaimer"
    ),
    "bsd binary": (
        "redistributions in binary form must reproduce the above copyright notice this list of conditions and "
        "the following disclaimer in the documentation and or other materials provided with the distribution"
    ),
    "bsd names": (
        "neither the name of the copyright holder nor the names of its contributors may be used to endorse or "
        "promote products derived from this software without specific prior written permission"
    ),
    "bsd released": "released under the bsd license",
    "isc grant": (
        "permission to use copy modify and or distribute this software for any purpose with or without fee is "
        "hereby granted provided that the above copyright notice and this permission notice appear in all copies"
    ),
    "gpl redistribute": (
        "you can redistribute it and or modify it under the terms of the gnu general public license as published "
        "by the free software foundation either version 3 of the license or at your option any later version"
    ),
    "gpl 2 redistribute": (
        "you can redistribute it and or modify it under the terms of the gnu general public license as published "
        "by the free software foundation either version 2 of the license or at your option any later version"
    ),
    "gpl free": "this program is free software",
    "gpl 3 work": "this work is licensed under the gnu general public license version 3",
    "gpl 2 work": "this work is licensed under the gnu general public license version 2",
    "gpl 3 licensed": "licensed under the gnu general public license version 3",
    "gpl hope": "this program is distributed in the hope that it will be useful but without any warranty",
    "gpl part": (
        "you can redistribute it and or modify it under the terms of the gnu general public license as published "
        "by the free software foundation"
    ),
    "lgpl part": (
        "you can redistribute it and or modify it under the terms of the gnu lesser general public license as published "
        "by the free software foundation"
    ),
    "library part": (
        "you can redistribute it and or modify it under the terms of the gnu library general public license as published "
        "by the free software foundation"
    ),
    "agpl part": (
        "you can redistribute it and or modify it under the terms of the gnu affero general public license as published "
        "by the free software foundation"
    ),
    "either 2": "either version 2 of the license or at your option any later version",
    "either 2.1": "either version 2 1 of the license or at your option any later version",
    "either 3": "either version 3 of the license or at your option any later version",
    "lgpl 2.1 redistribute": (
        "you can redistribute it and or modify it under the terms of the gnu lesser general public license as published "
        "by the free software foundation either version 2 1 of the license or at your option any later version"
    ),
    "lgpl 3 redistribute": (
        "you can redistribute it and or modify it under the terms of the gnu lesser general public license as published "
        "by the free software foundation either version 3 of the license or at your option any later version"
    ),
    "agpl 3 redistribute": (
        "you can redistribute it and or modify it under the terms of the gnu affero general public license as published "
        "by the free software foundation either version 3 of the license or at your option any later version"
    ),
    "gpl 2 licensed": "licensed under the gnu general public license version 2",
    "lgpl 2.1 licensed": "licensed under the gnu lesser general public license version 2 1",
    "mpl part": "this source code form is subject to the terms of the mozilla public license v",
    "mpl version": "2 0",
    "lgpl licensed": "licensed under the gnu lesser general public license version 3",
    "agpl licensed": "licensed under the gnu affero general public license version 3",
    "mpl notice": "this source code form is subject to the terms of the mozilla public license v 2 0",
    "unlicense": "this is free and unencumbered software released into the public domain",
    "cc0": "to the extent possible under law the author has waived all copyright and related rights to this work",
    "cc by": "licensed under cc by 4 0",
    "cc by sa": "licensed under cc by sa 4 0",
    "cc by nc": "licensed under cc by nc 4 0",
    "cc by nc sa": "licensed under cc by nc sa 4 0",
    "cc by nd": "licensed under cc by nd 4 0",
    "cc by work": "this work is licensed under a creative commons attribution 4 0 international license",
    "cc by sa work": "this work is licensed under a creative commons attribution sharealike 4 0 international license",
    "cc by nc work": "this work is licensed under a creative commons attribution noncommercial 4 0 international license",
    "reserved": "all rights reserved",
    "spdx": "spdx license identifier",
    "tag mit": "mit",
    "tag apache": "apache 2 0",
    "tag bsd 3": "bsd 3 clause",
    "tag bsd 2": "bsd 2 clause",
    "tag gpl 3": "gpl 3 0 only",
    "tag gpl 3 later": "gpl 3 0 or later",
    "tag gpl 2": "gpl 2 0 only",
    "tag gpl 2 later": "gpl 2 0 or later",
    "tag lgpl 2.1": "lgpl 2 1 only",
    "tag lgpl 2.1 later": "lgpl 2 1 or later",
    "tag lgpl 3": "lgpl 3 0 only",
    "tag lgpl 3 later": "lgpl 3 0 or later",
    "tag agpl 3": "agpl 3 0 only",
    "tag agpl 3 later": "agpl 3 0 or later",
    "tag mpl": "mpl 2 0",
    "tag isc": "isc",
    "tag unlicense": "unlicense",
    "tag cc0": "cc0 1 0",
}

#: Fixed values: (license, sentences in order).
RULES = (
    ("MIT", ("mit grant", "mit notice kept", "as is")),
    ("MIT", ("spdx", "tag mit")),
    ("MIT", ("mit grant",)),
    ("MIT", ("mit released",)),
    ("MIT", ("mit licensed",)),
    ("MIT", ("mit title the",)),
    ("MIT", ("mit title",)),
    ("Apache-2.0", ("apache notice long", "apache use", "apache copy")),
    ("Apache-2.0", ("spdx", "tag apache")),
    ("Apache-2.0", ("apache notice long",)),
    ("Apache-2.0", ("apache notice",)),
    ("BSD-3-Clause", ("bsd use", "bsd source", "bsd binary", "bsd names")),
    ("BSD-3-Clause", ("spdx", "tag bsd 3")),
    ("BSD-2-Clause", ("bsd use", "bsd source", "bsd binary")),
    ("BSD-2-Clause", ("spdx", "tag bsd 2")),
    ("BSD", ("bsd released",)),
    ("ISC", ("isc grant",)),
    ("AGPL-3.0", ("agpl licensed",)),
    ("LGPL-3.0", ("lgpl licensed",)),
    ("GPL-3.0-or-later", ("gpl free", "gpl redistribute", "gpl hope")),
    ("GPL-3.0-or-later", ("gpl redistribute",)),
    ("GPL-3.0-or-later", ("spdx", "tag gpl 3 later")),
    ("GPL-2.0-or-later", ("gpl 2 redistribute",)),
    ("GPL-3.0", ("spdx", "tag gpl 3")),
    ("GPL-3.0", ("gpl 3 work",)),
    ("GPL-3.0", ("gpl 3 licensed",)),
    ("GPL-2.0", ("gpl 2 work",)),
    ("GPL-2.0", ("gpl 2 licensed",)),
    ("GPL-2.0-only", ("spdx", "tag gpl 2")),
    ("GPL-2.0-or-later", ("spdx", "tag gpl 2 later")),
    ("LGPL-2.1", ("lgpl 2.1 licensed",)),
    ("LGPL-2.1-or-later", ("lgpl 2.1 redistribute",)),
    ("LGPL-2.1-only", ("spdx", "tag lgpl 2.1")),
    ("LGPL-2.1-or-later", ("spdx", "tag lgpl 2.1 later")),
    ("LGPL-3.0-or-later", ("lgpl 3 redistribute",)),
    ("LGPL-3.0-only", ("spdx", "tag lgpl 3")),
    ("LGPL-3.0-or-later", ("spdx", "tag lgpl 3 later")),
    ("AGPL-3.0-or-later", ("agpl 3 redistribute",)),
    ("AGPL-3.0-only", ("spdx", "tag agpl 3")),
    ("AGPL-3.0-or-later", ("spdx", "tag agpl 3 later")),
    ("MPL-2.0", ("mpl notice",)),
    ("MPL-2.0", ("spdx", "tag mpl")),
    ("ISC", ("spdx", "tag isc")),
    ("Unlicense", ("spdx", "tag unlicense")),
    ("CC0-1.0", ("spdx", "tag cc0")),
    ("Unlicense", ("unlicense",)),
    ("CC0-1.0", ("cc0",)),
    ("CC-BY-NC-SA-4.0", ("cc by nc sa",)),
    ("CC-BY-NC-4.0", ("cc by nc",)),
    ("CC-BY-NC-4.0", ("cc by nc work",)),
    ("CC-BY-ND-4.0", ("cc by nd",)),
    ("CC-BY-SA-4.0", ("cc by sa",)),
    ("CC-BY-SA-4.0", ("cc by sa work",)),
    ("CC-BY-4.0", ("cc by",)),
    ("CC-BY-4.0", ("cc by work",)),
    ("proprietary", ("reserved",)),
)

#: Fixed values: (license, sentences that stand next to each other).
NEXT_RULES = (
    ("GPL-2.0-or-later", ("gpl part", "either 2")),
    ("GPL-3.0-or-later", ("gpl part", "either 3")),
    ("LGPL-2.0-or-later", ("library part", "either 2")),
    ("LGPL-2.1-or-later", ("lgpl part", "either 2.1")),
    ("LGPL-3.0-or-later", ("lgpl part", "either 3")),
    ("AGPL-3.0-or-later", ("agpl part", "either 3")),
    ("MPL-2.0", ("mpl part", "mpl version")),
)
EVERY_RULE = [(*rule, False) for rule in RULES] + [(*rule, True) for rule in NEXT_RULES]

# The holder in the third clause of a license may have any name of some words.
_HOLDER = "^neither the name of (?:[a-z0-9]+ ){1,16}nor the names of (?:its|their) contributors"
_ANY_HOLDER = "neither the name of the copyright holder nor the names of its contributors"
# Tags may be combined on one line.
_OPERATORS = "[(]| (?:OR|AND|WITH) |[)]"

# A sentence ends at a mark before white space, or at an empty line.
_END = r"[.!?;:]+(\s|\z)|\n[ \t]*\n"
_MARK = "\x01"


def _number(name: str) -> int:
    return list(SENTENCES).index(name) + 1


def _looked_up(sentence: str) -> str:
    known = sql_strings(list(SENTENCES.values()))
    words = f"trim(regexp_replace(lower({sentence}), '[^a-z0-9]+', ' '))"
    named = f"if(startswith(w, 'neither the name of '), regexp_replace(w, '{_HOLDER}', '{_ANY_HOLDER}'), w)"
    return f"transform(array({words}), w -> int(array_position(array({known}), {named})))[0]"


def _fuller(rule: tuple) -> list[int]:
    """Rules for other licenses that have all sentences of this one and more."""
    return [k for k, (name, own, _) in enumerate(EVERY_RULE) if name != rule[0] and set(own) > set(rule[1])]


def scan(docs: DataFrame, *, id: str = "doc_id", text: str = "text") -> DataFrame:
    """Per document ``n_sentences``, ``sentence_ids``, ``license`` (of the first rule that counts) and ``licenses``.

    ``sentence_ids`` and ``licenses`` are comma-joined, licenses in the order of their rules. A null or empty text, or one
    without known sentences, has empty lists and a null ``license``. Repeated rows each get their result; an empty table
    gives an empty table; other columns are ignored.
    """
    plain = docs.select(F.col(id).alias("_id"), F.coalesce(F.col(text), F.lit("")).alias("_text"))
    sentences = F.split(F.regexp_replace("_text", _END, _MARK), _MARK)
    cut = plain.select("_id", sentences.alias("_s"))
    # Each sentence is looked up once; only unknown ones of several lines or tags are looked at again.
    parts = f"transform(split(k.s, '\n|{_OPERATORS}'), l -> {_looked_up('l')})"
    lines = (
        f"if(k.n > 0, array(k.n), if(contains(k.s, '\n') or k.s rlike '{_OPERATORS}', {parts}, cast(array() as array<int>)))"
    )
    numbered = f"transform(_s, s -> named_struct('s', s, 'n', {_looked_up('s')}))"
    ids = f"filter(flatten(transform({numbered}, k -> {lines})), n -> n > 0)"
    found = cut.select("_id", F.expr(ids).alias("_n"))

    def matches(names: tuple[str, ...], next_to: bool) -> str:
        numbers = ", ".join(str(_number(n)) for n in names)
        if next_to:
            return f"contains(concat(',', array_join(_n, ','), ','), ',{numbers.replace(' ', '')},')"
        step = "(p, r) -> if(p < 0, p, coalesce(nullif(int(array_position(slice(_n, p + 1, size(_n)), r)), 0) + p, -1))"
        return f"aggregate(array({numbers}), 0, {step}) > 0"

    matched = ", ".join(matches(names, next_to) for _, names, next_to in EVERY_RULE)
    counted = []
    for k, rule in enumerate(EVERY_RULE):
        hidden = "".join(f" and not m[{f}]" for f in _fuller(rule))
        counted.append(f"if(m[{k}]{hidden}, '{rule[0]}', null)")
    named = (
        f"if(size(_n) = 0, cast(array() as array<string>), transform(array(array({matched})), "
        f"m -> array_distinct(filter(array({', '.join(counted)}), l -> l is not null)))[0])"
    )
    return found.withColumn("_l", F.expr(named)).select(
        F.col("_id").alias(id),
        F.size("_n").cast("long").alias("n_sentences"),
        F.array_join(F.col("_n").cast("array<string>"), ",").alias("sentence_ids"),
        F.expr("get(_l, 0)").alias("license"),
        F.array_join("_l", ",").alias("licenses"),
    )


def op4_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return scan(read(spark, sf_dir, "documents"))


def _oracle() -> str:
    """Sentences and rules as tables: a rule matches by the places of its sentences, and is hidden by a join."""
    known = ", ".join(f"({n + 1}, '{s}')" for n, s in enumerate(SENTENCES.values()))
    rules = ", ".join(
        f"({k}, '{name}', {[_number(n) for n in names]}, {str(next_to).lower()})"
        for k, (name, names, next_to) in enumerate(EVERY_RULE)
    )
    words = "trim(regexp_replace(lower({}), '[^a-z0-9]+', ' ', 'g'))"
    return rf"""
with recursive known(number, sentence) as (values {known}),
rules(rule, license, ids, next_to) as (values {rules}),
cut as (
  select doc_id, unnest(string_split(regexp_replace(coalesce(text, ''), '{_END}', chr(1), 'g'), chr(1))) as s,
    generate_subscripts(string_split(regexp_replace(coalesce(text, ''), '{_END}', chr(1), 'g'), chr(1)), 1) as a
  from documents),
spoken as (
  select doc_id, a, s, regexp_replace({words.format("s")}, '{_HOLDER}', '{_ANY_HOLDER}') as w from cut),
whole as (select doc_id, a, s, number from spoken left join known on w = sentence),
lined as (
  select doc_id, a, unnest(regexp_split_to_array(s, '
|{_OPERATORS}')) as l,
    generate_subscripts(regexp_split_to_array(s, '
|{_OPERATORS}'), 1) as b
  from whole where number is null and (contains(s, chr(10)) or regexp_matches(s, '{_OPERATORS}'))),
placed as (
  select doc_id, a, 0 as b, number from whole where number is not null
  union all
  select doc_id, a, b, number from lined
  join known on regexp_replace({words.format("l")}, '{_HOLDER}', '{_ANY_HOLDER}') = sentence),
seen as (select doc_id, number, row_number() over (partition by doc_id order by a, b) as place from placed),
walk as (
  select doc_id, rule, 1 as k, min(place) as place from seen join rules on number = ids[1] group by doc_id, rule, next_to
    having not next_to
  union all
  select walk.doc_id, walk.rule, k + 1, (select min(s.place) from seen s
    where s.doc_id = walk.doc_id and s.number = ids[k + 1] and s.place > walk.place) as place
  from walk join rules using (rule) where k < len(ids) and walk.place is not null),
matched as (
  select distinct doc_id, rule from walk join rules using (rule) where k = len(ids) and place is not null
  union
  select distinct x.doc_id, rule from rules join seen x on x.number = ids[1] join seen y on y.number = ids[2]
    and y.doc_id = x.doc_id and y.place = x.place + 1 where next_to),
counted as (
  select doc_id, license, min(rule) as rule from matched m join rules r using (rule)
  where not exists (select 1 from matched o join rules f on f.rule = o.rule
    where o.doc_id = m.doc_id and f.license <> r.license and list_has_all(f.ids, r.ids) and len(f.ids) > len(r.ids))
  group by doc_id, license),
named as (
  select doc_id, min_by(license, rule) as license, string_agg(license, ',' order by rule) as licenses
  from counted group by doc_id),
numbered as (select doc_id, count(*) as n, string_agg(number, ',' order by place) as ids from seen group by doc_id)
select doc_id, coalesce(n, 0) as n_sentences, coalesce(ids, '') as sentence_ids, license, coalesce(licenses, '') as licenses
from documents left join numbered using (doc_id) left join named using (doc_id)
"""


ORACLE = _oracle()
