"""Licence scan by sentence rules: normalised sentences to identifiers, identifier sequences to licences by ordered rules."""

from __future__ import annotations

import re
from itertools import product

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from schedlytics.llm.tables import small_batches, text_column

# Sentences of public licence texts and notices by identifier. They are compared after ``normal``.
SENTENCES = {
    "mit-name": ["Released under the MIT License", "Licensed under the MIT License", "This project is licensed under the MIT License", "Distributed under the MIT License"],
    "mit-grant": ['Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the "Software"), to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the Software is furnished to do so, subject to the following conditions'],
    "mit-notice": ["The above copyright notice and this permission notice shall be included in all copies or substantial portions of the Software"],
    "mit-as-is": ['THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT'],
    "apache2-name": ["Licensed under the Apache License, Version 2.0", 'Licensed under the Apache License, Version 2.0 (the "License")', "Released under the Apache License, Version 2.0"],
    "apache2-file": ["you may not use this file except in compliance with the License"],
    "apache2-copy": ["You may obtain a copy of the License at"],
    "apache2-as-is": ['Unless required by applicable law or agreed to in writing, software distributed under the License is distributed on an "AS IS" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied'],
    "gpl3-name": ["This work is licensed under the GNU General Public License, version 3", "Licensed under the GNU General Public License, version 3", "Released under the GNU General Public License, version 3"],
    "gpl2-name": ["This work is licensed under the GNU General Public License, version 2", "Licensed under the GNU General Public License, version 2", "Released under the GNU General Public License, version 2"],
    "gpl3-later": ["This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version"],
    "gpl2-later": ["This program is free software; you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation; either version 2 of the License, or (at your option) any later version"],
    "gpl-warranty": ["This program is distributed in the hope that it will be useful, but WITHOUT ANY WARRANTY; without even the implied warranty of MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE"],
    "gpl-copy": ["You should have received a copy of the GNU General Public License along with this program"],
    "bsd-grant": ["Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met"],
    "bsd-source": ["Redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer"],
    "bsd-binary": ["Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the following disclaimer in the documentation and/or other materials provided with the distribution"],
    "bsd-endorse": ["Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products derived from this software without specific prior written permission"],
    "bsd-name": ["Licensed under the BSD 3-Clause License", "Released under the BSD 3-Clause License", "This work is licensed under the BSD 3-Clause License", "Distributed under the BSD 3-Clause License"],
    "isc-grant": ["Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, provided that the above copyright notice and this permission notice appear in all copies"],
    "mpl2-name": ["This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0"],
    "mpl2-copy": ["If a copy of the MPL was not distributed with this file, You can obtain one at http://mozilla.org/MPL/2.0/", "If a copy of the MPL was not distributed with this file, You can obtain one at https://mozilla.org/MPL/2.0/"],
    "ccby4-name": ["This work is licensed under a Creative Commons Attribution 4.0 International License", "Licensed under CC BY 4.0", "Released under the Creative Commons Attribution 4.0 International License"],
    "ccbync4-name": ["Licensed under CC BY-NC 4.0", "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License"],
    "cc0-name": ["This work is released into the public domain under CC0 1.0", "To the extent possible under law, the author has waived all copyright and related or neighboring rights to this work"],
    "unlicense": ["This is free and unencumbered software released into the public domain"],
    "gpl3-head": ["GNU GENERAL PUBLIC LICENSE Version 3, 29 June 2007"],
    "gpl2-head": ["GNU GENERAL PUBLIC LICENSE Version 2, June 1991"],
    "lgpl21-head": ["GNU LESSER GENERAL PUBLIC LICENSE Version 2.1, February 1999"],
    "lgpl3-head": ["GNU LESSER GENERAL PUBLIC LICENSE Version 3, 29 June 2007"],
    "agpl3-head": ["GNU AFFERO GENERAL PUBLIC LICENSE Version 3, 19 November 2007"],
    "apache2-head": ["Apache License Version 2.0, January 2004"],
    "lgpl21-later": ["This library is free software; you can redistribute it and/or modify it under the terms of the GNU Lesser General Public License as published by the Free Software Foundation; either version 2.1 of the License, or (at your option) any later version"],
    "lgpl3-later": ["This program is free software: you can redistribute it and/or modify it under the terms of the GNU Lesser General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version", "This library is free software: you can redistribute it and/or modify it under the terms of the GNU Lesser General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version"],
    "lgpl-warranty": ["This library is distributed in the hope that it will be useful, but WITHOUT ANY WARRANTY; without even the implied warranty of MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE"],
    "agpl3-later": ["This program is free software: you can redistribute it and/or modify it under the terms of the GNU Affero General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version"],
    "zlib-as-is": ["This software is provided 'as-is', without any express or implied warranty"],
    "zlib-liable": ["In no event will the authors be held liable for any damages arising from the use of this software"],
    "zlib-grant": ["Permission is granted to anyone to use this software for any purpose, including commercial applications, and to alter it and redistribute it freely, subject to the following restrictions"],
    "epl2-name": ["This program and the accompanying materials are made available under the terms of the Eclipse Public License 2.0 which is available at https://www.eclipse.org/legal/epl-2.0/", "This program and the accompanying materials are made available under the terms of the Eclipse Public License 2.0 which is available at http://www.eclipse.org/legal/epl-2.0"],
    "bsl1-name": ["Distributed under the Boost Software License, Version 1.0", "Boost Software License - Version 1.0 - August 17th, 2003"],
    "bsl1-grant": ['Permission is hereby granted, free of charge, to any person or organization obtaining a copy of the software and accompanying documentation covered by this license (the "Software") to use, reproduce, display, distribute, execute, and transmit the Software, and to prepare derivative works of the Software, and to permit third-parties to whom the Software is furnished to do so, all subject to the following'],
    "bsd2-name": ["Licensed under the BSD 2-Clause License", "Released under the BSD 2-Clause License", "This work is licensed under the BSD 2-Clause License", "Distributed under the BSD 2-Clause License"],
    "ccbysa4-name": ["This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License", "Licensed under CC BY-SA 4.0"],
    "reserved": ["All rights reserved"],
}
# Rules in order of precedence; the first whose identifiers follow each other names the licence.
RULES = [
    ("MIT", ["mit-grant", "mit-notice", "mit-as-is"]), ("MIT", ["mit-grant", "mit-notice"]), ("MIT", ["mit-name"]), ("MIT-incomplete", ["mit-grant"]),
    ("Apache-2.0", ["apache2-name", "apache2-file", "apache2-copy", "apache2-as-is"]), ("Apache-2.0", ["apache2-name", "apache2-file"]), ("Apache-2.0", ["apache2-name"]),
    ("GPL-3.0-or-later", ["gpl3-later", "gpl-warranty", "gpl-copy"]), ("GPL-3.0-or-later", ["gpl3-later", "gpl-warranty"]), ("GPL-3.0-or-later", ["gpl3-later"]), ("GPL-3.0-only", ["gpl3-name"]),
    ("GPL-2.0-or-later", ["gpl2-later", "gpl-warranty", "gpl-copy"]), ("GPL-2.0-or-later", ["gpl2-later", "gpl-warranty"]), ("GPL-2.0-or-later", ["gpl2-later"]), ("GPL-2.0-only", ["gpl2-name"]),
    ("BSD-3-Clause", ["bsd-grant", "bsd-source", "bsd-binary", "bsd-endorse"]), ("BSD-2-Clause", ["bsd-grant", "bsd-source", "bsd-binary"]), ("BSD-3-Clause", ["bsd-name"]),
    ("ISC", ["isc-grant", "mit-as-is"]), ("ISC", ["isc-grant"]), ("MPL-2.0", ["mpl2-name", "mpl2-copy"]), ("MPL-2.0", ["mpl2-name"]),
    ("GPL-3.0-only", ["gpl3-head"]), ("GPL-2.0-only", ["gpl2-head"]), ("LGPL-2.1-only", ["lgpl21-head"]), ("LGPL-3.0-only", ["lgpl3-head"]), ("AGPL-3.0-only", ["agpl3-head"]), ("Apache-2.0", ["apache2-head"]),
    ("LGPL-2.1-or-later", ["lgpl21-later", "lgpl-warranty"]), ("LGPL-2.1-or-later", ["lgpl21-later"]), ("LGPL-3.0-or-later", ["lgpl3-later"]), ("AGPL-3.0-or-later", ["agpl3-later", "gpl-warranty"]), ("AGPL-3.0-or-later", ["agpl3-later"]),
    ("Zlib", ["zlib-as-is", "zlib-liable", "zlib-grant"]), ("Zlib", ["zlib-grant"]), ("EPL-2.0", ["epl2-name"]), ("BSL-1.0", ["bsl1-name", "bsl1-grant"]), ("BSL-1.0", ["bsl1-name"]), ("BSL-1.0", ["bsl1-grant"]),
    ("BSD-2-Clause", ["bsd2-name"]), ("CC-BY-SA-4.0", ["ccbysa4-name"]),
    ("CC-BY-4.0", ["ccby4-name"]), ("CC-BY-NC-4.0", ["ccbync4-name"]), ("CC0-1.0", ["cc0-name"]), ("Unlicense", ["unlicense"]), ("Proprietary", ["reserved"]),
]
# Every sentence above has one of these after ``normal``, so that a text without any has no licence sentence.
MARKS = ("licen", "permission", "copyright", "warrant", "redistribut", "public domain", "cc by", "rights reserved", "mozilla.org mpl", "held liable")
# A licence expression: names joined by AND, OR and WITH, in brackets or not.
TAG = re.compile(r"spdx-license-identifier:\s*((?:\([ \t]*)*[\w.+:-]+(?:[ \t)]+(?:and|or|with)[ \t(]+[\w.+:-]+)*)", re.IGNORECASE)
JOINT = re.compile(r"[\s()]+(?:and|or)[\s()]+", re.IGNORECASE)
END = re.compile(r"(?<=[.!?;])[\"')\]]*\s+|(?<=:)(?<!dentifier:)\s+|\n\s*\n")
OTHER = re.compile(r"[^\w.+]+|_+")


def normal(sentence: str) -> str:
    """Lower case; everything but letters, digits, dots and plus signs is one space; comment marks and end marks go."""
    return " ".join(w for w in (x.strip(".") for x in OTHER.sub(" ", sentence.lower()).split()) if w)


def pieces() -> tuple[dict[str, str], dict[str, list[list[str]]]]:
    """Identifiers of the pieces that ``END`` cuts the sentences into, and the piece sequences of each sentence.

    A sentence of one piece keeps its identifier, further pieces are numbered; a piece that two sentences share has one identifier.
    """
    known, sequences = {}, {}
    for name, variants in SENTENCES.items():
        for variant in variants:
            cut = [normal(x) for x in END.split(variant)]
            own = [known.setdefault(x, name if len(cut) == 1 else f"{name}.{k}") for k, x in enumerate(cut, 1)]
            if own not in sequences.setdefault(name, []):
                sequences[name].append(own)
    return known, sequences


KNOWN, SEQUENCES = pieces()
# The rules over identifiers of pieces, in the same order.
PIECE_RULES = [(licence, [x for part in parts for x in part]) for licence, names in RULES for parts in product(*[SEQUENCES[n] for n in names])]


# First words of known pieces, and the words of the longest.
FIRST, LONGEST = frozenset(k.split(" ", 1)[0] for k in KNOWN), max(len(k.split(" ")) for k in KNOWN)


def marked(text: str) -> bool:
    """Whether a text has a mark; wrapped lines and comment signs stand between words of a mark only before ``normal``."""
    low = text.lower()
    if any(m in low for m in MARKS if " " not in m):
        return True
    return any(m.split(" ")[0] in low for m in MARKS if " " in m) and any(m in normal(text) for m in MARKS if " " in m)


def named(expression: str) -> list[str]:
    """The licences of an SPDX expression; an exception stays with its licence."""
    parts = [" ".join(x.strip("() \t").split()).rstrip(".") for x in JOINT.split(expression)]
    return [re.sub(r" with ", " WITH ", x, flags=re.IGNORECASE) for x in parts if x]


def runs_of(sentence: str) -> list[str]:
    """Identifiers of the known runs of whole lines in order, the longest from each line; runs do not overlap.

    A run stops at the word count of the longest known piece, so the work is linear in the lines.
    """
    lines = [x for x in map(normal, sentence.split("\n")) if x]
    found, at = [], 0
    while at < len(lines):
        hit, run, words = None, "", 0
        if lines[at].split(" ", 1)[0] in FIRST:
            for end in range(at, len(lines)):
                words += lines[end].count(" ") + 1
                if words > LONGEST:
                    break
                run = f"{run} {lines[end]}" if run else lines[end]
                if run in KNOWN:
                    hit = (KNOWN[run], end + 1)
        elif lines[at].startswith(("copyright ", "c ")) and lines[at].endswith(" all rights reserved"):
            hit = (KNOWN["all rights reserved"], at + 1)
        if hit:
            found.append(hit[0])
        at = hit[1] if hit else at + 1
    return found


def sentence_ids(text: str) -> tuple[list[str], int]:
    """Identifiers of the known sentences of a whole text in order, and how many others have a licence mark.

    A sentence ends at an end mark before white space or at an empty line; a piece of a known sentence may itself have no mark. All
    its known runs of lines are found, as notices often follow a text without an end mark, and every SPDX tag; text on either side
    of a tag is looked up like a sentence.
    """
    found, others = [], 0
    if not marked(text):
        return found, others
    for sentence in END.split(text):
        hits, at = [], 0
        for tag in TAG.finditer(sentence):
            hits += [*runs_of(sentence[at:tag.start()]), *[f"spdx:{x}" for x in named(tag[1])]]
            at = tag.end()
        hits += runs_of(sentence[at:])
        found += hits
        others += not hits and marked(sentence)
    return found, others


def licences(ids: list[str], rules: list[tuple[str, list[str]]] = PIECE_RULES) -> list[str]:
    """Licences of an identifier sequence: at each place the first rule that matches takes its identifiers, else one is skipped."""
    out, at = [], 0
    while at < len(ids):
        if ids[at].startswith("spdx:"):
            out.append(ids[at][5:])
            at += 1
            continue
        hit = next(((name, seq) for name, seq in rules if ids[at:at + len(seq)] == seq), None)
        if hit:
            out.append(hit[0])
        at += len(hit[1]) if hit else 1
    return list(dict.fromkeys(out))


def scan(docs: DataFrame) -> DataFrame:
    """Per row of ``docs`` (doc_id, text; other columns are not read): doc_id, licences, sentence_ids, n_unknown.

    Licences stand in order of their first place, each once. Null and empty texts have none. Nulls in doc_id stay. Repeated rows
    are rows of their own, an empty table gives none.
    """
    small_batches(docs.sparkSession)
    source = docs.select("doc_id", F.col("text").cast("string").alias("text"))

    def run(batches):
        for batch in batches:
            found = [sentence_ids(str(t)) for t in text_column(batch, "text")]
            lists = pa.list_(pa.string())
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array([licences(ids) for ids, _ in found], lists), pa.array([ids for ids, _ in found], lists), pa.array([n for _, n in found], pa.int64())],
                                             ["doc_id", "licences", "sentence_ids", "n_unknown"])

    return source.mapInArrow(run, f"doc_id {dict(source.dtypes)['doc_id']}, licences array<string>, sentence_ids array<string>, n_unknown long")
