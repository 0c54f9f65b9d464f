"""Operator 4: licences recognised by known sentences in a known order."""

from __future__ import annotations

import re
from collections.abc import Mapping, Sequence

import pyarrow as pa
from pyspark.sql import DataFrame

from tripmart.llm.common import arrays, batch_chunks, keyed, text_bytes

# Licence sentences in normal form (a-z and digits, one space between words).
SENTENCES = {
    "apache-named": "licensed under the apache license version 2 0",
    "apache-the-license": "licensed under the apache license version 2 0 the license",
    "apache-may-not": "you may not use this file except in compliance with the license",
    "apache-copy": "you may obtain a copy of the license at",
    "apache-as-is": "unless required by applicable law or agreed to in writing software distributed under the license is distributed on an as is basis without warranties or conditions of any kind either express or implied",
    "apache-see": "see the license for the specific language governing permissions and limitations under the license",
    "mit-named": "released under the mit license",
    "mit-licensed": "licensed under the mit license",
    "mit-title": "the mit license",
    "mit-title-short": "mit license",
    "mit-grant": "permission is hereby granted free of charge to any person obtaining a copy of this software and associated documentation files the software to deal in the software without restriction including without limitation the rights to use copy modify merge publish distribute sublicense and or sell copies of the software and to permit persons to whom the software is furnished to do so subject to the following conditions",
    "mit-notice": "the above copyright notice and this permission notice shall be included in all copies or substantial portions of the software",
    "mit-as-is": "the software is provided as is without warranty of any kind express or implied including but not limited to the warranties of merchantability fitness for a particular purpose and noninfringement",
    "isc-grant": "permission to use copy modify and or distribute this software for any purpose with or without fee is hereby granted provided that the above copyright notice and this permission notice appear in all copies",
    "isc-as-is": "the software is provided as is and the author disclaims all warranties with regard to this software including all implied warranties of merchantability and fitness",
    "bsd-grant": "redistribution and use in source and binary forms with or without modification are permitted provided that the following conditions are met",
    "bsd-source": "redistributions of source code must retain the above copyright notice this list of conditions and the following disclaimer",
    "bsd-binary": "redistributions in binary form must reproduce the above copyright notice this list of conditions and the following disclaimer in the documentation and or other materials provided with the distribution",
    "bsd-endorse": "neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products derived from this software without specific prior written permission",
    "gpl3-named": "this work is licensed under the gnu general public license version 3",
    "gpl-free": "this program is free software you can redistribute it and or modify it under the terms of the gnu general public license as published by the free software foundation either version 3 of the license or at your option any later version",
    "gpl2-free": "this program is free software you can redistribute it and or modify it under the terms of the gnu general public license as published by the free software foundation either version 2 of the license or at your option any later version",
    "gpl-hope": "this program is distributed in the hope that it will be useful but without any warranty without even the implied warranty of merchantability or fitness for a particular purpose",
    "gpl-details": "see the gnu general public license for more details",
    "mpl-terms": "this source code form is subject to the terms of the mozilla public license v 2 0",
    "mpl-copy": "if a copy of the mpl was not distributed with this file you can obtain one at https mozilla org mpl 2 0",
    "cc-by-4": "licensed under cc by 4 0",
    "cc-by-sa-4": "licensed under cc by sa 4 0",
    "cc-by-nc-4": "licensed under cc by nc 4 0",
    "cc-by-nd-4": "licensed under cc by nd 4 0",
    "cc-by-nc-sa-4": "licensed under cc by nc sa 4 0",
    "cc-by-nc-nd-4": "licensed under cc by nc nd 4 0",
    "cc-by-4-long": "this work is licensed under a creative commons attribution 4 0 international license",
    "cc-by-sa-4-long": "this work is licensed under a creative commons attribution sharealike 4 0 international license",
    "cc-by-nc-4-long": "this work is licensed under a creative commons attribution noncommercial 4 0 international license",
    "unlicense": "this is free and unencumbered software released into the public domain",
    "reserved": "all rights reserved",
    "spdx-apache": "spdx license identifier apache 2 0",
    "spdx-mit": "spdx license identifier mit",
    "spdx-gpl3": "spdx license identifier gpl 3 0 or later",
    "spdx-gpl3-only": "spdx license identifier gpl 3 0 only",
    "spdx-bsd3": "spdx license identifier bsd 3 clause",
    "spdx-bsd2": "spdx license identifier bsd 2 clause",
    "spdx-gpl2": "spdx license identifier gpl 2 0 or later",
    "spdx-gpl2-only": "spdx license identifier gpl 2 0 only",
    "spdx-lgpl21": "spdx license identifier lgpl 2 1 or later",
    "spdx-lgpl3": "spdx license identifier lgpl 3 0 or later",
    "spdx-agpl3": "spdx license identifier agpl 3 0 or later",
    "spdx-mpl2": "spdx license identifier mpl 2 0",
    "spdx-isc": "spdx license identifier isc",
    "spdx-zlib": "spdx license identifier zlib",
    "spdx-bsl": "spdx license identifier bsl 1 0",
    "spdx-epl": "spdx license identifier epl 2 0",
    "spdx-cc0": "spdx license identifier cc0 1 0",
    "spdx-unlicense": "spdx license identifier unlicense",
    "lgpl21-free": "this library is free software you can redistribute it and or modify it under the terms of the gnu lesser general public license as published by the free software foundation either version 2 1 of the license or at your option any later version",
    "lgpl3-free": "this library is free software you can redistribute it and or modify it under the terms of the gnu lesser general public license as published by the free software foundation either version 3 of the license or at your option any later version",
    "lgpl-hope": "this library is distributed in the hope that it will be useful but without any warranty without even the implied warranty of merchantability or fitness for a particular purpose",
    "agpl-free": "this program is free software you can redistribute it and or modify it under the terms of the gnu affero general public license as published by the free software foundation either version 3 of the license or at your option any later version",
    "zlib-as-is": "this software is provided as is without any express or implied warranty",
    "zlib-grant": "permission is granted to anyone to use this software for any purpose including commercial applications and to alter it and redistribute it freely subject to the following restrictions",
    "bsl-named": "distributed under the boost software license version 1 0",
    "epl-terms": "this program and the accompanying materials are made available under the terms of the eclipse public license 2 0",
    "cc0-named": "cc0 1 0 universal",
}

# Licences, each by the sentences that must follow each other.
RULES: list[tuple[str, tuple[str, ...]]] = [
    ("Apache-2.0", ("apache-named",)),
    ("Apache-2.0", ("apache-the-license",)),
    ("Apache-2.0", ("apache-may-not", "apache-copy", "apache-as-is")),
    ("Apache-2.0", ("spdx-apache",)),
    ("MIT", ("mit-named",)),
    ("MIT", ("mit-licensed",)),
    ("MIT", ("mit-title", "mit-grant")),
    ("MIT", ("mit-title-short", "mit-grant")),
    ("MIT", ("mit-grant", "mit-notice", "mit-as-is")),
    ("MIT", ("spdx-mit",)),
    ("ISC", ("isc-grant", "isc-as-is")),
    ("BSD-2-Clause", ("bsd-grant", "bsd-source", "bsd-binary")),
    ("BSD-3-Clause", ("bsd-grant", "bsd-source", "bsd-binary", "bsd-endorse")),
    ("BSD-3-Clause", ("spdx-bsd3",)),
    ("GPL-3.0", ("gpl3-named",)),
    ("GPL-3.0", ("gpl-free", "gpl-hope")),
    ("GPL-3.0", ("spdx-gpl3",)),
    ("GPL-3.0", ("spdx-gpl3-only",)),
    ("GPL-2.0", ("gpl2-free", "gpl-hope")),
    ("MPL-2.0", ("mpl-terms", "mpl-copy")),
    ("CC-BY-4.0", ("cc-by-4",)),
    ("CC-BY-4.0", ("cc-by-4-long",)),
    ("CC-BY-SA-4.0", ("cc-by-sa-4",)),
    ("CC-BY-SA-4.0", ("cc-by-sa-4-long",)),
    ("CC-BY-NC-4.0", ("cc-by-nc-4",)),
    ("CC-BY-NC-4.0", ("cc-by-nc-4-long",)),
    ("CC-BY-ND-4.0", ("cc-by-nd-4",)),
    ("CC-BY-NC-SA-4.0", ("cc-by-nc-sa-4",)),
    ("CC-BY-NC-ND-4.0", ("cc-by-nc-nd-4",)),
    ("Unlicense", ("unlicense",)),
    ("Unlicense", ("spdx-unlicense",)),
    ("BSD-2-Clause", ("spdx-bsd2",)),
    ("GPL-2.0", ("spdx-gpl2",)),
    ("GPL-2.0", ("spdx-gpl2-only",)),
    ("LGPL-2.1", ("lgpl21-free", "lgpl-hope")),
    ("LGPL-2.1", ("spdx-lgpl21",)),
    ("LGPL-3.0", ("lgpl3-free", "lgpl-hope")),
    ("LGPL-3.0", ("spdx-lgpl3",)),
    ("AGPL-3.0", ("agpl-free", "gpl-hope")),
    ("AGPL-3.0", ("spdx-agpl3",)),
    ("MPL-2.0", ("spdx-mpl2",)),
    ("ISC", ("spdx-isc",)),
    ("Zlib", ("zlib-as-is", "zlib-grant")),
    ("Zlib", ("spdx-zlib",)),
    ("BSL-1.0", ("bsl-named",)),
    ("BSL-1.0", ("spdx-bsl",)),
    ("EPL-2.0", ("epl-terms",)),
    ("EPL-2.0", ("spdx-epl",)),
    ("CC0-1.0", ("cc0-named",)),
    ("CC0-1.0", ("spdx-cc0",)),
    ("LicenseRef-reserved", ("reserved",)),
]

# Words of no known sentence that may stand between two sentences of a rule.
GAP_WORDS = 40

_WORD = re.compile(rb"[a-z0-9]+")
_SPAN = pa.struct([("license", pa.string()), ("start", pa.int64()), ("end", pa.int64())])
_OUT = pa.schema(
    [("doc_id", pa.int64()), ("licenses", pa.string()), ("n_sentences", pa.int64()), ("spans", pa.list_(_SPAN))]
)


def anchors(plain: list[bytes]) -> list[bytes]:
    """Few words of which every sentence has one, so that a text without them is not read on."""
    left, chosen = [set(s.split()) for s in plain], []
    while left:
        words = {w for s in left for w in s}
        best = max(words, key=lambda w: (sum(w in s for s in left) * (len(w) > 3), len(w), w))
        chosen.append(best)
        left = [s for s in left if best not in s]
    return chosen


class Licences:
    """Known sentences, by their first words, and rules over their identifiers."""

    def __init__(self, sentences: Mapping[str, str], rules: Sequence[tuple[str, Sequence[str]]]):
        for name, text in sentences.items():
            if not re.fullmatch("[a-z0-9]+( [a-z0-9]+)*", text):
                raise ValueError(f"the sentence {name!r} is not in normal form: {text!r}")
        unknown = {i for _, ids in rules for i in ids} - set(sentences)
        if unknown:
            raise ValueError(f"rules name unknown sentences: {sorted(unknown)}")
        self.begins: dict[bytes, list[tuple[list[bytes], str]]] = {}
        for name, text in sentences.items():
            words = text.encode().split()
            self.begins.setdefault(words[0], []).append((words, name))
        for known in self.begins.values():
            known.sort(key=lambda k: -len(b" ".join(k[0])))
        self.rules = [(name, tuple(ids)) for name, ids in rules]
        self.anchors = anchors([text.encode() for text in sentences.values()])

    def sentences(self, text: bytes) -> list[tuple[int, str, int, int]]:
        """Known sentences: unknown words before, identifier, first and last byte.

        From left to right, the longest at a place, none over another. Between two words of a
        sentence anything may stand but letters, digits, and more than one line end.
        """
        low = text.lower()
        if not any(a in low for a in self.anchors):
            return []
        places = [m.span() for m in _WORD.finditer(low)]
        words = [low[a:b] for a, b in places]
        found, i, gap = [], 0, 0
        while i < len(words):
            for known, name in self.begins.get(words[i], ()):
                n = len(known)
                if words[i : i + n] == known and not any(
                    low.count(b"\n", places[j][1], places[j + 1][0]) > 1 for j in range(i, i + n - 1)
                ):
                    found.append((gap, name, places[i][0], places[i + n - 1][1]))
                    i, gap = i + n, 0
                    break
            else:
                i, gap = i + 1, gap + 1
        return found

    def apply(self, found: list[tuple[int, str, int, int]]) -> list[tuple[str, int, int]]:
        """Licences whose sentences follow each other, with first and last byte."""
        hits = []
        for i in range(len(found)):
            for name, rule in self.rules:
                run = found[i : i + len(rule)]
                if tuple(f[1] for f in run) == rule and all(f[0] <= GAP_WORDS for f in run[1:]):
                    hits.append((name, run[0][2], run[-1][3]))
        return hits


def scan_licenses(
    docs: DataFrame,
    sentences: Mapping[str, str] = SENTENCES,
    rules: Sequence[tuple[str, Sequence[str]]] = RULES,
) -> DataFrame:
    """doc_id, licenses, n_sentences and spans, one row per input row.

    The words of a text (letters a-z of either case and digits) are its normal form; known sentences
    are found in it wherever they stand, also over marks, line ends and comment signs, but not over
    an empty line. A rule's sentences must come one after the other among the known ones, with at
    most ``GAP_WORDS`` other words between two. ``licenses``: the names of all rules that match, in
    order and without repeats, joined by commas; empty if none, also for null and empty texts.
    ``n_sentences`` counts known sentences; ``spans`` are byte ranges of the UTF-8 text. Other
    columns do not matter. ``sentences`` (identifier to normal form) and ``rules`` (licence and
    identifiers in order) may be others.
    """
    known = docs.sparkSession.sparkContext.broadcast(Licences(sentences, rules))

    def scan(batches):
        licences = known.value
        for batch in batches:
            for chunk in batch_chunks(batch):
                out = []
                for text in text_bytes(chunk.column(1)):
                    found = licences.sentences(text)
                    hits = licences.apply(found)
                    spans = [{"license": n, "start": a, "end": b} for n, a, b in hits]
                    out.append((",".join(sorted({h[0] for h in hits})), len(found), spans))
                yield arrays(_OUT, chunk.column(0), *zip(*out, strict=True))

    return keyed(docs).select("doc_id", "text").mapInArrow(
        scan,
        "doc_id long, licenses string, n_sentences long, spans array<struct<license:string,start:long,end:long>>",
    )
