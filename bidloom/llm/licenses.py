"""Licence notices: normalised sentences become identifiers, and ordered rules match sequences of identifiers."""

from __future__ import annotations

import re
from collections.abc import Iterator
from typing import NamedTuple

import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from .blocks import small

# Sentences of widely used licence notices, normalised (lower case, words only).
SENTENCES = {
    "apache-short": "licensed under the apache license version 2 0",
    "apache-grant": "licensed under the apache license version 2 0 the license",
    "apache-compliance": "you may not use this file except in compliance with the license",
    "apache-copy": "you may obtain a copy of the license at http www apache org licenses license 2 0",
    "apache-warranty": "unless required by applicable law or agreed to in writing software distributed under the license is distributed on an as is basis without warranties or conditions of any kind either express or implied",
    "apache-limits": "see the license for the specific language governing permissions and limitations under the license",
    "mit-short": "released under the mit license",
    "mit-short-2": "licensed under the mit license",
    "mit-title": "mit license",
    "mit-the-title": "the mit license",
    "mit-grant": "permission is hereby granted free of charge to any person obtaining a copy of this software and associated documentation files the software to deal in the software without restriction including without limitation the rights to use copy modify merge publish distribute sublicense and or sell copies of the software and to permit persons to whom the software is furnished to do so subject to the following conditions",
    "mit-notice": "the above copyright notice and this permission notice shall be included in all copies or substantial portions of the software",
    "gpl3-short": "this work is licensed under the gnu general public license version 3",
    "gpl2-short": "this work is licensed under the gnu general public license version 2",
    "gpl-free": "this program is free software you can redistribute it and or modify it under the terms of the gnu general public license as published by the free software foundation either version 3 of the license or at your option any later version",
    "gpl2-free": "this program is free software you can redistribute it and or modify it under the terms of the gnu general public license as published by the free software foundation either version 2 of the license or at your option any later version",
    "gpl-hope": "this program is distributed in the hope that it will be useful but without any warranty without even the implied warranty of merchantability or fitness for a particular purpose",
    "gpl-details": "see the gnu general public license for more details",
    "bsd-grant": "redistribution and use in source and binary forms with or without modification are permitted provided that the following conditions are met",
    "bsd-source": "redistributions of source code must retain the above copyright notice this list of conditions and the following disclaimer",
    "bsd-binary": "redistributions in binary form must reproduce the above copyright notice this list of conditions and the following disclaimer in the documentation and or other materials provided with the distribution",
    "bsd-endorse": "neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products derived from this software without specific prior written permission",
    "cc-by-nc-4-short": "licensed under cc by nc 4 0",
    "cc-by-4-short": "licensed under cc by 4 0",
    "cc-by-sa-4-short": "licensed under cc by sa 4 0",
    "cc-by-nc-4": "this work is licensed under a creative commons attribution noncommercial 4 0 international license",
    "cc-by-4": "this work is licensed under a creative commons attribution 4 0 international license",
    "mpl2": "this source code form is subject to the terms of the mozilla public license v 2 0",
    "spdx-mit": "spdx license identifier mit",
    "spdx-apache": "spdx license identifier apache 2 0",
    "spdx-gpl3": "spdx license identifier gpl 3 0 or later",
    "reserved": "all rights reserved",
    "mit-warranty": "the software is provided as is without warranty of any kind express or implied including but not limited to the warranties of merchantability fitness for a particular purpose and noninfringement",
    "mit-liability": "in no event shall the authors or copyright holders be liable for any claim damages or other liability whether in an action of contract tort or otherwise arising from out of or in connection with the software or the use or other dealings in the software",
    "bsd-warranty": "this software is provided by the copyright holders and contributors as is and any express or implied warranties including but not limited to the implied warranties of merchantability and fitness for a particular purpose are disclaimed",
    "bsd-advertising": "all advertising materials mentioning features or use of this software must display the following acknowledgement",
    "isc-grant": "permission to use copy modify and or distribute this software for any purpose with or without fee is hereby granted provided that the above copyright notice and this permission notice appear in all copies",
    "0bsd-grant": "permission to use copy modify and or distribute this software for any purpose with or without fee is hereby granted",
    "isc-warranty": "the software is provided as is and the author disclaims all warranties with regard to this software including all implied warranties of merchantability and fitness",
    "isc-title": "isc license",
    "gpl2-only": "this program is free software you can redistribute it and or modify it under the terms of the gnu general public license version 2 as published by the free software foundation",
    "gpl3-only": "this program is free software you can redistribute it and or modify it under the terms of the gnu general public license version 3 as published by the free software foundation",
    "lgpl21-free": "this library is free software you can redistribute it and or modify it under the terms of the gnu lesser general public license as published by the free software foundation either version 2 1 of the license or at your option any later version",
    "lgpl3-free": "this library is free software you can redistribute it and or modify it under the terms of the gnu lesser general public license as published by the free software foundation either version 3 of the license or at your option any later version",
    "lgpl3-program": "this program is free software you can redistribute it and or modify it under the terms of the gnu lesser general public license as published by the free software foundation either version 3 of the license or at your option any later version",
    "lgpl-hope": "this library is distributed in the hope that it will be useful but without any warranty without even the implied warranty of merchantability or fitness for a particular purpose",
    "lgpl-details": "see the gnu lesser general public license for more details",
    "agpl3-free": "this program is free software you can redistribute it and or modify it under the terms of the gnu affero general public license as published by the free software foundation either version 3 of the license or at your option any later version",
    "agpl-details": "see the gnu affero general public license for more details",
    "classpath": "as a special exception the copyright holders of this library give you permission to link this library with independent modules to produce an executable regardless of the license terms of these independent modules and to copy and distribute the resulting executable under terms of your choice provided that you also meet for each linked independent module the terms and conditions of the license of that module",
    "unlicense": "this is free and unencumbered software released into the public domain",
    "epl1": "this program and the accompanying materials are made available under the terms of the eclipse public license v1 0 which accompanies this distribution",
    "epl2": "this program and the accompanying materials are made available under the terms of the eclipse public license 2 0 which is available at https www eclipse org legal epl 2 0",
    "boost-short": "distributed under the boost software license version 1 0",
    "boost-grant": "permission is hereby granted free of charge to any person or organization obtaining a copy of the software and accompanying documentation covered by this license the software to use reproduce display distribute execute and transmit the software and to prepare derivative works of the software and to permit third parties to whom the software is furnished to do so all subject to the following",
    "zlib-warranty": "this software is provided as is without any express or implied warranty",
    "zlib-grant": "permission is granted to anyone to use this software for any purpose including commercial applications and to alter it and redistribute it freely subject to the following restrictions",
    "wtfpl": "everyone is permitted to copy and distribute verbatim or modified copies of this license document and changing it is allowed as long as the name is changed",
    "cc0": "to the extent possible under law the author s have dedicated all copyright and related and neighboring rights to this software to the public domain worldwide",
    "artistic2": "this program is free software you can redistribute it and or modify it under the terms of the artistic license 2 0",
    "postgresql": "permission to use copy modify and distribute this software and its documentation for any purpose without fee and without a written agreement is hereby granted provided that the above copyright notice and this paragraph and the following two paragraphs appear in all copies",
    "ofl": "this font software is licensed under the sil open font license version 1 1",
    "cddl": "the contents of this file are subject to the terms of the common development and distribution license the license",
    "eupl": "licensed under the eupl version 1 2",
    "mspl": "this license governs use of the accompanying software",
}

# Identifiers of the SPDX list that notices name, and those it has replaced.
SPDX_IDS = (
    "0BSD AFL-3.0 AGPL-3.0-only AGPL-3.0-or-later Apache-1.1 Apache-2.0 Artistic-2.0 BlueOak-1.0.0 BSD-2-Clause BSD-2-Clause-Patent BSD-3-Clause "
    "BSD-3-Clause-Clear BSD-4-Clause BSL-1.0 CC-BY-3.0 CC-BY-4.0 CC-BY-NC-4.0 CC-BY-NC-ND-4.0 CC-BY-NC-SA-4.0 CC-BY-ND-4.0 CC-BY-SA-3.0 "
    "CC-BY-SA-4.0 CC0-1.0 CDDL-1.0 CDDL-1.1 CECILL-2.1 ECL-2.0 EPL-1.0 EPL-2.0 EUPL-1.1 EUPL-1.2 GFDL-1.3-only GFDL-1.3-or-later "
    "GPL-1.0-or-later GPL-2.0-only GPL-2.0-or-later GPL-3.0-only GPL-3.0-or-later ISC LGPL-2.0-only LGPL-2.0-or-later LGPL-2.1-only "
    "LGPL-2.1-or-later LGPL-3.0-only LGPL-3.0-or-later MIT MIT-0 MPL-1.1 MPL-2.0 MPL-2.0-no-copyleft-exception MS-PL MS-RL NCSA ODbL-1.0 "
    "OFL-1.1 OpenSSL OSL-3.0 PostgreSQL PSF-2.0 Python-2.0 Ruby Unicode-3.0 Unlicense UPL-1.0 Vim W3C WTFPL X11 Zlib ZPL-2.1").split()
REPLACED = {"AGPL-3.0": "AGPL-3.0-only", "GPL-2.0": "GPL-2.0-only", "GPL-3.0": "GPL-3.0-only", "LGPL-2.0": "LGPL-2.0-only",
            "LGPL-2.1": "LGPL-2.1-only", "LGPL-3.0": "LGPL-3.0-only"}
EXCEPTIONS = ("Classpath-exception-2.0", "GCC-exception-3.1", "LLVM-exception", "Linux-syscall-note")
# Names of the parts of Creative Commons licences, and what follows the version in a notice.
CC_PARTS = {"BY": "attribution", "NC": "noncommercial", "ND": "noderivatives", "SA": "sharealike"}
CC_VERSIONS = {"3.0": "unported", "4.0": "international"}


class Rule(NamedTuple):
    license: str
    sentences: tuple[str, ...]


# Rules in order of preference, longer sequences first. Sentences of a rule follow each other in the text.
RULES = (
    Rule("Apache-2.0", ("apache-grant", "apache-compliance", "apache-copy", "apache-warranty", "apache-limits")),
    Rule("Apache-2.0", ("apache-grant", "apache-compliance")),
    Rule("MIT", ("mit-grant", "mit-notice", "mit-warranty", "mit-liability")),
    Rule("MIT", ("mit-grant", "mit-notice", "mit-warranty")),
    Rule("MIT", ("mit-grant", "mit-notice")),
    Rule("GPL-2.0-or-later WITH Classpath-exception-2.0", ("gpl2-free", "gpl-hope", "gpl-details", "classpath")),
    Rule("GPL-3.0-or-later", ("gpl-free", "gpl-hope", "gpl-details")),
    Rule("GPL-2.0-or-later", ("gpl2-free", "gpl-hope", "gpl-details")),
    Rule("GPL-3.0-or-later", ("gpl-free",)),
    Rule("GPL-2.0-or-later", ("gpl2-free",)),
    Rule("BSD-4-Clause", ("bsd-grant", "bsd-source", "bsd-binary", "bsd-advertising", "bsd-endorse", "bsd-warranty")),
    Rule("BSD-4-Clause", ("bsd-grant", "bsd-source", "bsd-binary", "bsd-advertising", "bsd-endorse")),
    Rule("BSD-3-Clause", ("bsd-grant", "bsd-source", "bsd-binary", "bsd-endorse", "bsd-warranty")),
    Rule("BSD-3-Clause", ("bsd-grant", "bsd-source", "bsd-binary", "bsd-endorse")),
    Rule("BSD-2-Clause", ("bsd-grant", "bsd-source", "bsd-binary", "bsd-warranty")),
    Rule("BSD-2-Clause", ("bsd-grant", "bsd-source", "bsd-binary")),
    Rule("Apache-2.0", ("apache-short",)),
    Rule("Apache-2.0", ("apache-grant",)),
    Rule("Apache-2.0", ("spdx-apache",)),
    Rule("MIT", ("mit-short",)),
    Rule("MIT", ("mit-short-2",)),
    Rule("MIT", ("mit-grant",)),
    Rule("MIT", ("mit-the-title",)),
    Rule("MIT", ("mit-title",)),
    Rule("MIT", ("spdx-mit",)),
    Rule("GPL-3.0-only", ("gpl3-short",)),
    Rule("GPL-2.0-only", ("gpl2-short",)),
    Rule("GPL-3.0-or-later", ("spdx-gpl3",)),
    Rule("CC-BY-NC-4.0", ("cc-by-nc-4-short",)),
    Rule("CC-BY-NC-4.0", ("cc-by-nc-4",)),
    Rule("CC-BY-SA-4.0", ("cc-by-sa-4-short",)),
    Rule("CC-BY-4.0", ("cc-by-4-short",)),
    Rule("CC-BY-4.0", ("cc-by-4",)),
    Rule("MPL-2.0", ("mpl2",)),
    Rule("All-rights-reserved", ("reserved",)),
    Rule("ISC", ("isc-grant", "isc-warranty")),
    Rule("ISC", ("isc-grant",)),
    Rule("ISC", ("isc-title",)),
    Rule("0BSD", ("0bsd-grant", "isc-warranty")),
    Rule("0BSD", ("0bsd-grant",)),
    Rule("GPL-2.0-only", ("gpl2-only", "gpl-hope", "gpl-details")),
    Rule("GPL-2.0-only", ("gpl2-only",)),
    Rule("GPL-3.0-only", ("gpl3-only", "gpl-hope", "gpl-details")),
    Rule("GPL-3.0-only", ("gpl3-only",)),
    Rule("LGPL-2.1-or-later", ("lgpl21-free", "lgpl-hope", "lgpl-details")),
    Rule("LGPL-2.1-or-later", ("lgpl21-free",)),
    Rule("LGPL-3.0-or-later", ("lgpl3-free", "lgpl-hope", "lgpl-details")),
    Rule("LGPL-3.0-or-later", ("lgpl3-free",)),
    Rule("LGPL-3.0-or-later", ("lgpl3-program", "gpl-hope", "lgpl-details")),
    Rule("LGPL-3.0-or-later", ("lgpl3-program",)),
    Rule("AGPL-3.0-or-later", ("agpl3-free", "gpl-hope", "agpl-details")),
    Rule("AGPL-3.0-or-later", ("agpl3-free",)),
    Rule("Unlicense", ("unlicense",)),
    Rule("EPL-1.0", ("epl1",)),
    Rule("EPL-2.0", ("epl2",)),
    Rule("BSL-1.0", ("boost-grant", "mit-warranty")),
    Rule("BSL-1.0", ("boost-grant",)),
    Rule("BSL-1.0", ("boost-short",)),
    Rule("Zlib", ("zlib-warranty", "zlib-grant")),
    Rule("Zlib", ("zlib-grant",)),
    Rule("WTFPL", ("wtfpl",)),
    Rule("CC0-1.0", ("cc0",)),
    Rule("Artistic-2.0", ("artistic2",)),
    Rule("PostgreSQL", ("postgresql",)),
    Rule("OFL-1.1", ("ofl",)),
    Rule("CDDL-1.0", ("cddl",)),
    Rule("EUPL-1.2", ("eupl",)),
    Rule("MS-PL", ("mspl",)),
)


def _words(name: str) -> str:
    return " ".join(_WORD.findall(name.lower()))


def _named() -> tuple[dict[str, str], tuple[Rule, ...]]:
    """Sentences and rules that follow from a name: SPDX lines, with exceptions too, and notices of Creative Commons."""
    sentences, rules, taken = {}, [], set(SENTENCES.values())

    def add(sentence: str, license: str) -> None:
        if sentence not in taken:
            taken.add(sentence)
            sentences[sentence] = sentence
            rules.append(Rule(license, (sentence,)))

    for name, license in [(x, x) for x in SPDX_IDS] + list(REPLACED.items()):
        add(f"spdx license identifier {_words(name)}", license)
        for exception in EXCEPTIONS:
            add(f"spdx license identifier {_words(name)} with {_words(exception)}", f"{license} WITH {exception}")
    for parts in ("BY", "BY-SA", "BY-ND", "BY-NC", "BY-NC-SA", "BY-NC-ND"):
        long = " ".join(CC_PARTS[p] for p in parts.split("-"))
        for version, area in CC_VERSIONS.items():
            add(f"this work is licensed under a creative commons {long} {_words(version)} {area} license", f"CC-{parts}-{version}")
            add(f"licensed under cc {_words(parts)} {_words(version)}", f"CC-{parts}-{version}")
    return sentences, tuple(rules)


#: Each known sentence holds one of these inside a single word, so a text without any of them has no known sentence, wherever its lines break.
KEYS = ("licen", "reserved", "permission", "copyright", "redistribution", "warrant", "unencumbered", "advertising")
#: Sentences of other kinds that may stand between two sentences of a rule (a copyright line, a title).
BETWEEN = 2

_WORD = re.compile(r"[^\W_]+")
#: A sentence ends at a terminator before white space, at an empty line or at the end of a line.
_HARD_END = re.compile(r"[.!?:;]+[\"')\]]*(?=\s|\Z)|\n\s*\n|\Z")


class Found(NamedTuple):
    sentence: str
    start: int
    end: int
    number: int  # of the sentence in its text


class Match(NamedTuple):
    license: str
    start: int
    end: int


_SENTENCES_NAMED, _RULES_NAMED = _named()
SENTENCES |= _SENTENCES_NAMED
RULES += _RULES_NAMED
#: Rules by the sentence that they begin with, in order.
_RULES_BY_FIRST = {name: [r for r in RULES if r.sentences[0] == name] for name in {r.sentences[0] for r in RULES}}


def _trie() -> dict:
    root: dict = {}
    for name, sentence in SENTENCES.items():
        node = root
        for word in sentence.split():
            node = node.setdefault(word, {})
        node[None] = name
    return root


_TRIE = _trie()


def known_sentences(text: str) -> list[Found]:
    """Known sentences in order. A known sentence begins where a sentence or a line begins, may run over line breaks, and ends where
    a sentence or a line ends; of several at one place the longest counts."""
    if not any(k in text.lower() for k in KEYS):
        return []
    words = list(_WORD.finditer(text))
    hard = [m.end() for m in _HARD_END.finditer(text)]
    begins = {0} | {m.end() for m in re.finditer(r"\n", text)} | set(hard)
    marks = sorted(begins)
    found, number, i = [], 0, 0
    place = 0
    while i < len(words):
        a = words[i].start()
        while place + 1 < len(marks) and marks[place + 1] <= a:
            place += 1
        first = i == 0 or marks[place] > words[i - 1].start()
        if not first:
            i += 1
            continue
        number += 1
        node, j, best = _TRIE, i, None
        while j < len(words) and (node := node.get(words[j][0].lower())) is not None:
            j += 1
            if None in node and _ends(text, words[j - 1].end(), words[j].start() if j < len(words) else len(text), j == len(words)):
                best = (node[None], j)
        if best:
            found.append(Found(best[0], a, words[best[1] - 1].end(), number))
            i = best[1]
        else:
            i += 1
    return found


def _ends(text: str, a: int, b: int, last: bool) -> bool:
    between = text[a:b]
    if between.startswith("+"):  # any later version, which no rule says
        return False
    return last or "\n" in between or bool(re.match(r"[\"')\]]*[.!?:;,(]", between)) or " - " in between


def match_rules(found: list[Found]) -> list[Match]:
    """The first rule in order whose sentences begin at a place wins it; its sentences are used up."""
    out, i = [], 0
    while i < len(found):
        for rule in _RULES_BY_FIRST.get(found[i].sentence, ()):
            j, last = i, found[i].number
            for name in rule.sentences:
                if j < len(found) and found[j].sentence == name and found[j].number - last <= BETWEEN + (j == i):
                    last = found[j].number
                    j += 1
                else:
                    break
            else:
                out.append(Match(rule.license, found[i].start, found[j - 1].end))
                i = j
                break
        else:
            i += 1
    return out


def scan(text: str) -> tuple[list[Found], list[Match]]:
    found = known_sentences(text)
    return found, match_rules(found)


def _scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in small(batches):
        results = [scan(t or "") for t in batch.column("text").to_pylist()]
        yield pa.RecordBatch.from_pydict({
            "doc_id": batch.column("doc_id"),
            "n_sentences": pa.array([len(f) for f, _ in results], pa.int64()),
            "n_matches": pa.array([len(m) for _, m in results], pa.int64()),
            "licenses": pa.array([",".join(sorted({x.license for x in m})) for _, m in results], pa.string()),
            "spans": pa.array([",".join(f"{x.license}:{x.start}:{x.end}" for x in m) for _, m in results], pa.string())})


def license_scan(documents: DataFrame) -> DataFrame:
    """doc_id, n_sentences, n_matches, licenses (sorted, comma-joined), spans (license:start:end in code points) for each row of
    `documents(doc_id, text)`.

    Null and empty texts have no match (zeros and empty strings). Null and repeated ids keep a row each; other columns are ignored; an
    empty table gives an empty result; texts are scanned whole.
    """
    rows = documents.select(F.col("doc_id").cast("long"), F.col("text"))
    return rows.mapInArrow(_scan, "doc_id long, n_sentences long, n_matches long, licenses string, spans string")
