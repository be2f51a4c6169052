"""Licence scans by sentence rules.

A text is cut into sentences, each is normalised, and normalised sentences that are known map to an
identifier.  A sentence may be wrapped over lines, with or without comment leaders: between two blank lines or
stops, pieces that line breaks, colons or semicolons part are also read as one.  The sequence of a text's identifiers is then matched against licence rules in their order: a
rule whose identifiers occur consecutively names its licence and uses them up.
"""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .textmap import held

#: Known sentences, normalised (see :func:`normalised`), and their identifiers.
SENTENCES = [
    ("under mit license", "MITref"),
    ("under apache license version 2.0", "Apache2ref"),
    ("under apache license version 2.0 the license", "Apache2ref"),
    ("under gnu general public license version 2", "GPL2ref"),
    ("under gnu general public license version 3", "GPL3ref"),
    ("under gnu lesser general public license version 2.1", "LGPL2.1ref"),
    ("under gnu lesser general public license version 3", "LGPL3ref"),
    ("under gnu affero general public license version 3", "AGPL3ref"),
    ("under mozilla public license version 2.0", "MPL2ref"),
    ("under bsd 2 clause license", "BSD2ref"),
    ("under bsd 3 clause license", "BSD3ref"),
    ("under cc by 4.0", "CCBYref"),
    ("under cc by sa 4.0", "CCBYSAref"),
    ("under cc by nc 4.0", "CCBYNCref"),
    ("under cc by nd 4.0", "CCBYNDref"),
    ("under cc by nc sa 4.0", "CCBYNCSAref"),
    ("under cc by nc nd 4.0", "CCBYNCNDref"),
    ("under creative commons attribution 4.0 international license", "CCBYref"),
    ("under creative commons attribution sharealike 4.0 international license", "CCBYSAref"),
    ("under creative commons attribution noncommercial 4.0 international license", "CCBYNCref"),
    ("under cc0 1.0", "CC0ref"),
    (
        "permission is hereby granted free of charge to any person obtaining a copy of this software and associated"
        " documentation files the software to deal in the software without restriction including without limitation"
        " the rights to use copy modify merge publish distribute sublicense and or sell copies of the software and to"
        " permit persons to whom the software is furnished to do so subject to the following conditions",
        "MITgrant",
    ),
    (
        "the above copyright notice and this permission notice shall be included in all copies or substantial"
        " portions of the software",
        "MITnotice",
    ),
    (
        "permission to use copy modify and or distribute this software for any purpose with or without fee is hereby"
        " granted provided that the above copyright notice and this permission notice appear in all copies",
        "ISCgrant",
    ),
    ("you may not use this file except in compliance with the license", "ApacheComply"),
    ("you may obtain a copy of the license at", "ApacheCopy"),
    (
        "redistribution and use in source and binary forms with or without modification are permitted provided that"
        " the following conditions are met",
        "BSDgrant",
    ),
    (
        "redistributions of source code must retain the above copyright notice this list of conditions and the"
        " following disclaimer",
        "BSDsource",
    ),
    (
        "redistributions in binary form must reproduce the above copyright notice this list of conditions and the"
        " following disclaimer in the documentation and or other materials provided with the distribution",
        "BSDbinary",
    ),
    (
        "neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote"
        " products derived from this software without specific prior written permission",
        "BSDendorse",
    ),
    (
        "this program is free software you can redistribute it and or modify it under the terms of the gnu general"
        " public license as published by the free software foundation either version 2 of the license or at your"
        " option any later version",
        "GPL2plus",
    ),
    (
        "this program is free software you can redistribute it and or modify it under the terms of the gnu general"
        " public license as published by the free software foundation either version 3 of the license or at your"
        " option any later version",
        "GPL3plus",
    ),
    ("this source code form is subject to the terms of the mozilla public license v", "MPL2ref"),
    ("this is free and unencumbered software released into the public domain", "Unlicense"),
    ("all rights reserved under copyright law", "AllRights"),
]

#: Licences and the identifiers they take, in the order they are tried.
RULES = [
    ("BSD-3-Clause", ["BSDgrant", "BSDsource", "BSDbinary", "BSDendorse"]),
    ("BSD-2-Clause", ["BSDgrant", "BSDsource", "BSDbinary"]),
    ("MIT", ["MITgrant", "MITnotice"]),
    ("Apache-2.0", ["Apache2ref", "ApacheComply", "ApacheCopy"]),
    ("Apache-2.0", ["Apache2ref", "ApacheComply"]),
    ("GPL-2.0-or-later", ["GPL2plus"]),
    ("GPL-3.0-or-later", ["GPL3plus"]),
    ("AGPL-3.0", ["AGPL3ref"]),
    ("LGPL-2.1", ["LGPL2.1ref"]),
    ("LGPL-3.0", ["LGPL3ref"]),
    ("GPL-2.0", ["GPL2ref"]),
    ("GPL-3.0", ["GPL3ref"]),
    ("MPL-2.0", ["MPL2ref"]),
    ("Apache-2.0", ["Apache2ref"]),
    ("BSD-2-Clause", ["BSD2ref"]),
    ("BSD-3-Clause", ["BSD3ref"]),
    ("ISC", ["ISCgrant"]),
    ("MIT", ["MITref"]),
    ("CC-BY-NC-SA-4.0", ["CCBYNCSAref"]),
    ("CC-BY-NC-ND-4.0", ["CCBYNCNDref"]),
    ("CC-BY-NC-4.0", ["CCBYNCref"]),
    ("CC-BY-SA-4.0", ["CCBYSAref"]),
    ("CC-BY-ND-4.0", ["CCBYNDref"]),
    ("CC-BY-4.0", ["CCBYref"]),
    ("CC0-1.0", ["CC0ref"]),
    ("Unlicense", ["Unlicense"]),
    ("LicenseRef-all-rights-reserved", ["AllRights"]),
]

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
#: Sentences end at line breaks and at a stop, question or exclamation mark before white space.
SENTENCE_END = r"\n|[.!?][ \t\r\f\n]"
#: Marks in a text: a sentence can't go on over STOP, but over CUT, where it may also begin or end.
STOP, CUT = "\x01", "\x02"
STOPS = r"[.!?][ \t\r\f\n]|\n[^A-Za-z0-9\n]*\n"
CUTS = r"[\n:;]"
#: How a text refers to a licence; all of it becomes "under ".
REFERENCE = (
    "^((this|the) (work|project|file|software|program|document|article|text|page|content) is )?"
    "(licensed|released|distributed|published|available|provided) under (the terms of )?(the |an |a )?"
)
#: Every known sentence, as it stands in a text, holds one of these, whatever its case.
ANCHORS = "licen|permission|redistribut|copyright|under|public domain|compliance"


def normalised(sentence: Column) -> Column:
    """ASCII lower case, runs of anything but letters, digits, points and plus signs as one space, trimmed of
    spaces and points, and licence references in one form."""
    folded = F.regexp_replace(F.translate(sentence, UPPER, LOWER), r"[^a-z0-9.+]+", " ")
    return F.regexp_replace(F.regexp_replace(folded, r"^[ .]+|[ .]+$", ""), REFERENCE, "under ")


def _identifier(sentence: Column) -> Column:
    place = F.array_position(F.array(*[F.lit(s) for s, _ in SENTENCES]), sentence)
    return F.when(place > 0, F.element_at(F.array(*[F.lit(i) for _, i in SENTENCES]), F.greatest(place, F.lit(1)).cast("int")))


def _wrapped() -> str:
    """A pattern for any known sentence between marks in a marked text; longer sentences first."""
    gap = lambda words: words.replace(" ", f"[ {CUT}]+")
    under = "(?:" + gap(REFERENCE.removeprefix("^")) + "|" + gap("under ") + ")"
    known = [
        (under if s.startswith("under ") else "") + gap(re.escape(s.removeprefix("under ")).replace("\\ ", " "))
        for s, _ in sorted(SENTENCES, key=lambda x: -len(x[0]))
    ]
    return f"(?<=[{STOP}{CUT}])[ .]*({'|'.join(known)})(?=[ .]*[{STOP}{CUT}])"


def marked(text: Column) -> Column:
    """The text between two STOPs, in lower case, with its stops and cuts as marks and all else but letters,
    digits, points and plus signs as spaces."""
    plain = F.translate(text, UPPER + STOP + CUT, LOWER + "  ")
    cut = F.regexp_replace(F.regexp_replace(plain, STOPS, STOP), CUTS, CUT)
    return F.concat(F.lit(STOP), F.regexp_replace(cut, f"[^a-z0-9.+{STOP}{CUT}]+", " "), F.lit(STOP))


def identifiers(text: Column) -> Column:
    """The identifiers of a text's known sentences, in order (null or empty: none)."""
    some = F.translate(text, UPPER, LOWER).rlike(ANCHORS)
    known = F.transform(F.regexp_extract_all(marked(text), F.lit(_wrapped()), 1), lambda s: _identifier(normalised(s)))
    return F.when(F.coalesce(some, F.lit(False)), known).otherwise(F.array().cast("array<string>"))


def _named(ids: Column) -> Column:
    """Licences of a sequence of identifiers: every rule takes all its occurrences before the next one is tried."""
    rules = F.array(
        *[F.struct(F.lit(name).alias("name"), F.lit("".join(f"[{i}]" for i in seq)).alias("seq")) for name, seq in RULES]
    )
    start = F.struct(F.array_join(F.transform(ids, lambda i: F.concat(F.lit("["), i, F.lit("]"))), "").alias("rest"), F.array().cast("array<string>").alias("found"))
    done = F.aggregate(
        rules,
        start,
        lambda acc, r: F.when(
            F.contains(acc["rest"], r["seq"]),
            F.struct(F.replace(acc["rest"], r["seq"], F.lit("[]")).alias("rest"), F.concat(acc["found"], F.array(r["name"])).alias("found")),
        ).otherwise(acc),
        lambda acc: F.array_distinct(acc["found"]),
    )
    return F.when(F.size(ids) > 0, done).otherwise(F.array().cast("array<string>"))


def scan(docs: DataFrame, text: str = "text", carry: list[str] | None = None) -> DataFrame:
    """``struct carry``, ``sentence_ids`` (in order) and ``licenses`` (distinct, in rule order) of every row.

    Null and empty texts have neither; repeated rows stay repeated; an empty table gives an empty one; extra
    columns travel inside carry.
    """
    carry = [c for c in docs.columns if c != text] if carry is None else carry
    found = docs.select(held(carry).alias("carry"), identifiers(F.col(f"`{text}`")).alias("sentence_ids"))
    return found.select("carry", "sentence_ids", _named(F.col("sentence_ids")).alias("licenses"))
