"""Licence scan by sentence rules. DataFrame functions only.

A text is cut into sentences at line ends and after ``.``, ``!``, ``?``, ``:`` and ``;`` before white space.
Sentences are normalised (A-Z lower-cased, all but letters and digits to one space) and looked up
in a table of known licence sentences by hash. Known sentences are cut in the same way, and parts are
joined up to the longest of them, so one is found however its lines wrap. Then the rules are tried in order on a text's
identifiers: a rule that finds its sequence, one identifier after the other with only unknown
sentences in between, gives its licence and uses the sentences up.

Every text is judged where it is; nothing is shuffled.

Defined results: a null or empty text has no sentences and no licence. A licence that several
rules find, or one rule several times, is named once. Equal rows get equal results. Other columns
are returned unchanged; the new columns replace any of the same name. An empty table gives an
empty table.
"""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from riskspark.llm.stage import carried

#: Sentences of public licences and notices, by identifier.
SENTENCES = {
    "mit-mention": ["Released under the MIT License", "Licensed under the MIT License", "This project is licensed under the MIT License"],
    "mit-grant": ["Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the \"Software\"), "
                  "to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, "
                  "and/or sell copies of the Software, and to permit persons to whom the Software is furnished to do so, subject to the following conditions:"],
    "mit-notice": ["The above copyright notice and this permission notice shall be included in all copies or substantial portions of the Software."],
    "bsd-use": ["Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met:"],
    "bsd-source": ["Redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer."],
    "bsd-binary": ["Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the following disclaimer in the documentation "
                   "and/or other materials provided with the distribution."],
    "bsd-name": ["Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products derived from this software "
                 "without specific prior written permission."],
    "apache-mention": ["Licensed under the Apache License, Version 2.0.", "Licensed under the Apache License, Version 2.0 (the \"License\");"],
    "apache-copy": ["You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0"],
    "gpl3-mention": ["This work is licensed under the GNU General Public License, version 3.", "Licensed under the GNU General Public License, version 3."],
    "gpl3-later": ["you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the "
                   "Free Software Foundation, either version 3 of the License, or (at your option) any later version."],
    "gpl2-later": ["you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the "
                   "Free Software Foundation; either version 2 of the License, or (at your option) any later version."],
    "lgpl3-later": ["you can redistribute it and/or modify it under the terms of the GNU Lesser General Public License as published by the "
                    "Free Software Foundation, either version 3 of the License, or (at your option) any later version."],
    "lgpl21-later": ["you can redistribute it and/or modify it under the terms of the GNU Lesser General Public License as published by the "
                     "Free Software Foundation; either version 2.1 of the License, or (at your option) any later version."],
    "agpl3-later": ["you can redistribute it and/or modify it under the terms of the GNU Affero General Public License as published by the "
                    "Free Software Foundation, either version 3 of the License, or (at your option) any later version."],
    "gpl3-title": ["GNU GENERAL PUBLIC LICENSE Version 3, 29 June 2007"],
    "gpl2-title": ["GNU GENERAL PUBLIC LICENSE Version 2, June 1991"],
    "lgpl3-title": ["GNU LESSER GENERAL PUBLIC LICENSE Version 3, 29 June 2007"],
    "lgpl21-title": ["GNU LESSER GENERAL PUBLIC LICENSE Version 2.1, February 1999"],
    "agpl3-title": ["GNU AFFERO GENERAL PUBLIC LICENSE Version 3, 19 November 2007"],
    "apache-title": ["Apache License Version 2.0, January 2004"],
    "mpl2-title": ["Mozilla Public License Version 2.0"],
    "mpl2-notice": ["This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0."],
    "epl2-title": ["Eclipse Public License - v 2.0"],
    "epl2-notice": ["This program and the accompanying materials are made available under the terms of the Eclipse Public License 2.0 "
                    "which is available at https://www.eclipse.org/legal/epl-2.0/"],
    "isc-grant": ["Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, "
                  "provided that the above copyright notice and this permission notice appear in all copies.",
                  "Permission to use, copy, modify, and distribute this software for any purpose with or without fee is hereby granted, "
                  "provided that the above copyright notice and this permission notice appear in all copies."],
    "unlicense": ["This is free and unencumbered software released into the public domain."],
    "boost-title": ["Boost Software License - Version 1.0 - August 17th, 2003"],
    "cc0-title": ["CC0 1.0 Universal"],
    "cc0-mention": ["To the extent possible under law, the author(s) have dedicated all copyright and related and neighboring rights to this software "
                    "to the public domain worldwide.", "Licensed under CC0 1.0."],
    "cc-by-sa-title": ["Creative Commons Attribution-ShareAlike 4.0 International Public License"],
    "cc-by-sa-mention": ["Licensed under CC BY-SA 4.0.", "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License."],
    "cc-by-nc-title": ["Creative Commons Attribution-NonCommercial 4.0 International Public License"],
    "cc-by-title": ["Creative Commons Attribution 4.0 International Public License"],
    "cc-by-nc-mention": ["Licensed under CC BY-NC 4.0.", "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License."],
    "cc-by-mention": ["Licensed under CC BY 4.0.", "This work is licensed under a Creative Commons Attribution 4.0 International License."],
    "reserved": ["All rights reserved."],
}

#: Licence and sequence of identifiers, in the order in which they are tried.
RULES = [
    ("BSD-3-Clause", ["bsd-use", "bsd-source", "bsd-binary", "bsd-name"]),
    ("BSD-2-Clause", ["bsd-use", "bsd-source", "bsd-binary"]),
    ("MIT", ["mit-grant", "mit-notice"]),
    ("MIT", ["mit-grant"]),
    ("MIT", ["mit-mention"]),
    ("Apache-2.0", ["apache-mention", "apache-copy"]),
    ("Apache-2.0", ["apache-mention"]),
    ("Apache-2.0", ["apache-title"]),
    ("AGPL-3.0-or-later", ["agpl3-later"]),
    ("LGPL-3.0-or-later", ["lgpl3-later"]),
    ("LGPL-2.1-or-later", ["lgpl21-later"]),
    ("GPL-3.0-or-later", ["gpl3-later"]),
    ("GPL-2.0-or-later", ["gpl2-later"]),
    ("AGPL-3.0", ["agpl3-title"]),
    ("LGPL-3.0", ["lgpl3-title"]),
    ("LGPL-2.1", ["lgpl21-title"]),
    ("GPL-3.0", ["gpl3-mention"]),
    ("GPL-3.0", ["gpl3-title"]),
    ("GPL-2.0", ["gpl2-title"]),
    ("MPL-2.0", ["mpl2-notice"]),
    ("MPL-2.0", ["mpl2-title"]),
    ("EPL-2.0", ["epl2-notice"]),
    ("EPL-2.0", ["epl2-title"]),
    ("ISC", ["isc-grant"]),
    ("Unlicense", ["unlicense"]),
    ("BSL-1.0", ["boost-title"]),
    ("CC0-1.0", ["cc0-mention"]),
    ("CC0-1.0", ["cc0-title"]),
    ("CC-BY-SA-4.0", ["cc-by-sa-mention"]),
    ("CC-BY-SA-4.0", ["cc-by-sa-title"]),
    ("CC-BY-NC-4.0", ["cc-by-nc-mention"]),
    ("CC-BY-NC-4.0", ["cc-by-nc-title"]),
    ("CC-BY-4.0", ["cc-by-mention"]),
    ("CC-BY-4.0", ["cc-by-title"]),
    ("All-rights-reserved", ["reserved"]),
]

_CUT = r"\n|(?<=[.!?:;])[\x20\x09-\x0D]+"
_END = r"[.!?:;][^0-9A-Za-z]*$"
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
_OTHER = r"[^0-9a-z\x{80}-\x{10FFFF}]+"


def normalised(sentence: str) -> str:
    """A sentence as the scan compares it."""
    low = sentence.translate(str.maketrans(_UPPER, _LOWER))
    return re.sub("[^0-9a-z\x80-\U0010ffff]+", " ", low).strip(" ")


def _joined(sentence: str) -> str:
    """A known sentence as the scan joins its parts: a point after one with an end, and one space between them."""
    parts = [x for x in re.split(_CUT, sentence) if x.strip(" ")]
    return "".join(normalised(x) + ("" if x is parts[-1] else ". " if re.search(_END, x) else " ") for x in parts)


#: The most parts that lines can cut a known sentence into: its words.
WRAP = max(len(_joined(s).split(" ")) for forms in SENTENCES.values() for s in forms)


def _let(value: Column, body) -> Column:
    """``body(value)``, with the value worked out once a row."""
    return F.transform(F.array(value), body)[0]


def scan(docs: DataFrame, text_col: str = "text", sentences: dict[str, list[str]] = SENTENCES, rules: list[tuple[str, list[str]]] = RULES) -> DataFrame:
    """``docs`` with ``n_sentences``, ``sentence_ids`` (the known ones, in order) and ``licences`` (in the rules' order)."""
    new = ("n_sentences", "sentence_ids", "licences")
    names, others = carried(docs, new)
    known = {_joined(s): name for name, forms in sentences.items() for s in forms}
    longest, most = max(map(len, known), default=0), max((len(s.split(" ")) for s in known), default=1)
    last = sorted({s.split(" ")[-1] for s in known})
    table = F.create_map(*(x for s, name in known.items() for x in (F.xxhash64(F.lit(s)), F.lit(name))))

    parts = F.filter(F.split(F.coalesce(F.col(f"`{text_col}`"), F.lit("")), _CUT), lambda s: F.trim(s) != "")
    parts = F.transform(parts, lambda s: F.struct(
        F.trim(F.regexp_replace(F.translate(s, _UPPER, _LOWER), _OTHER, " ")).alias("s"), s.rlike(_END).alias("end")))

    def looked_up(p):
        def state(whole):
            return F.struct(whole.alias("whole"), F.try_element_at(table, F.xxhash64(whole)).alias("id"))

        def longer(acc, before):
            done = acc["id"].isNotNull() | (F.char_length(acc["whole"]) >= longest) | ((before["s"] == "") & ~before["end"])  # a line of marks adds nothing
            return F.when(done, acc).otherwise(state(F.concat(before["s"], F.when(before["end"], ". ").otherwise(" "), acc["whole"])))

        def at(part, i):
            before = F.reverse(F.slice(p, F.greatest(i - (most - 2), F.lit(1)), F.least(i, F.lit(most - 1))))
            return F.when(F.substring_index(part["s"], " ", -1).isin(last), F.aggregate(before, state(part["s"]), longer, lambda acc: acc["id"]))
        every = F.transform(p, at)
        return F.struct(F.size(p).cast("long").alias("n"), F.filter(every, lambda x: x.isNotNull()).alias("ids"))

    steps = F.array(*(F.struct(F.lit(name).alias("name"), F.lit("".join(f",{x}," for x in ids)).alias("ids")) for name, ids in rules))

    def tried(acc, rule):
        hit = F.contains(acc["left"], rule["ids"])
        return F.struct(F.when(hit, F.replace(acc["left"], rule["ids"], F.lit(",-,"))).otherwise(acc["left"]).alias("left"),
                        F.when(hit, F.array_append(acc["names"], rule["name"])).otherwise(acc["names"]).alias("names"))

    start = lambda ids: F.struct(F.array_join(F.transform(ids, lambda x: F.concat(F.lit(","), x, F.lit(","))), "").alias("left"), F.array().cast("array<string>").alias("names"))
    found = _let(parts, looked_up)
    out = docs.select(others, found.alias("found"))
    named = F.aggregate(steps, start(F.col("found.ids")), tried, lambda acc: F.array_distinct(acc["names"]))
    return out.select(*(F.col(f"others.`{c}`").alias(c) for c in names), F.col("found.n").alias("n_sentences"), F.col("found.ids").alias("sentence_ids"), named.alias("licences"))
