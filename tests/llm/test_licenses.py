import re
import textwrap

from embedflow.llm import licenses as lic
from tests.llm.helpers import clashing, docs, odd

MIT = """MIT License

Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the "Software"), to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the Software is furnished to do so, subject to the following conditions:
The above copyright notice and this permission notice shall be included in all copies or substantial portions of the Software.
"""


def brute(text):
    ids = []
    table = dict(lic.SENTENCES)
    for s in re.split(lic.SENTENCE_END, text or ""):
        s = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in s)
        s = re.sub(r"^[ .]+|[ .]+$", "", re.sub(r"[^a-z0-9.+]+", " ", s))
        s = re.sub(lic.REFERENCE, "under ", s)
        if s in table:
            ids.append(table[s])
    rest, found = list(ids), []
    for name, seq in lic.RULES:
        i = 0
        while i + len(seq) <= len(rest):
            if rest[i : i + len(seq)] == seq:
                rest[i : i + len(seq)] = [None]
                if name not in found:
                    found.append(name)
            i += 1
    return ids, found


TEXTS = [
    MIT,
    "Some text. Released under the MIT License.\nMore.",
    "This work is licensed under the GNU General Public License, version 3. Licensed under CC BY-NC 4.0.",
    "Licensed under the Apache License, Version 2.0 (the \"License\");\nYou may not use this file except in compliance with the License.\nYou may obtain a copy of the License at",
    "Licensed under the Apache License, Version 2.0",
    "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met:\n"
    "* Redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer.\n"
    "* Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the following disclaimer in the documentation and/or other materials provided with the distribution.",
    "the license of a driver is no licence; we licensed nothing",
    "released under the mit license. released under the mit license",
    "RELEASED UNDER THE MIT LICENSE",
]


def test_against_brute_force(spark):
    rows = lic.scan(clashing(docs(spark, TEXTS))).collect()
    got = {r.carry.doc_id: (list(r.sentence_ids), list(r.licenses)) for r in rows}
    assert got == {i: brute(t) for i, t in enumerate(TEXTS)}
    assert [got[i][1] for i in range(9)] == [["MIT"], ["MIT"], ["GPL-3.0", "CC-BY-NC-4.0"], ["Apache-2.0"], ["Apache-2.0"], ["BSD-2-Clause"], [], ["MIT"], ["MIT"]]


def test_every_known_sentence_is_reachable():
    assert len({s for s, _ in lic.SENTENCES}) == len(lic.SENTENCES)
    for s, i in lic.SENTENCES:
        assert re.search(lic.ANCHORS, s), s
        assert brute(s)[0] == [i], s
    used = {x for _, seq in lic.RULES for x in seq}
    assert used <= {i for _, i in lic.SENTENCES} and {i for _, i in lic.SENTENCES} <= used


def test_odd_rows(spark):
    df = odd(spark)
    rows = lic.scan(df).collect()
    assert len(rows) == df.count() and all(list(r.licenses) == [] and list(r.sentence_ids) == [] for r in rows)
    assert lic.scan(docs(spark, [])).count() == 0


GPL = """/*
 * This program is free software; you can redistribute it and/or modify
 * it under the terms of the GNU General Public License as published by
 * the Free Software Foundation; either version 3 of the License, or
 * (at your option) any later version.
 *
 * This program is distributed in the hope that it will be useful.
 */"""
BSD = """Redistribution and use in source and binary forms, with or without
modification, are permitted provided that the following conditions are met:

1. Redistributions of source code must retain the above copyright notice, this
   list of conditions and the following disclaimer.
2. Redistributions in binary form must reproduce the above copyright notice,
   this list of conditions and the following disclaimer in the documentation
   and/or other materials provided with the distribution.
3. Neither the name of the copyright holder nor the names of its
   contributors may be used to endorse or promote products derived from
   this software without specific prior written permission.
"""
APACHE = "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file except in compliance with the License."


def test_wrapped_sentences_are_found(spark):
    wrap = lambda text, lead: "\n\n".join("\n".join(textwrap.wrap(p, 70, initial_indent=lead, subsequent_indent=lead)) for p in re.split(r"\n+", text))
    cases = [(wrap(MIT, lead), ["MITgrant", "MITnotice"], ["MIT"]) for lead in ("", "# ", "// ", " * ")]
    cases += [
        (GPL, ["GPL3plus"], ["GPL-3.0-or-later"]),
        (GPL.replace("version 3", "version 2").replace("\n", "\r\n"), ["GPL2plus"], ["GPL-2.0-or-later"]),
        (BSD, ["BSDgrant", "BSDsource", "BSDbinary", "BSDendorse"], ["BSD-3-Clause"]),
        (APACHE, ["Apache2ref", "ApacheComply"], ["Apache-2.0"]),
        ("x\n# Licensed under the\n# Apache License,\n# Version 2.0\ny", ["Apache2ref"], ["Apache-2.0"]),
        ("Licensed under the\n\nMIT License", [], []),
        ("Licensed under the. MIT License", [], []),
        ("this is not licensed under the\nMIT License", [], []),
    ]
    cases += [("a line\n" + wrap(sentence, "") + "\nanother line", [i], None) for sentence, i in lic.SENTENCES]
    rows = {r.carry.doc_id: r for r in lic.scan(docs(spark, [t for t, _, _ in cases])).collect()}
    for k, (text, ids, names) in enumerate(cases):
        assert list(rows[k].sentence_ids) == ids, text
        assert names is None or list(rows[k].licenses) == names, text
