"""License scans by conditional compression.

A notice that may speak of a license is compressed with Zstandard, alone and with every license
template as a raw dictionary, all in lower case. Templates are ranked by the bytes that they save. The first one
wins that saves a large share and that the exact differences in wording confirm: nearly all words occur in it in
order, and no differing word names another license or version. Templates with equal savings are told apart by what
their wording has between; if nothing does, all of them are named.

A notice is a line or clause with a trigger word together with those before and after it which read like a
template, up to the end of the sentence or paragraph; so wrapped notices are compared as a whole. A notice that
several licenses share is judged together with the paragraphs next to it. The identifiers of an SPDX expression
are notices of their own.
"""

import bisect
import difflib
import re

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import words as w
from .common import id_and_text, map_batches

#: Share of a sentence's compressed bytes that a template must save, and the share of the sentence's words
#: that must be the template's.
LEAST_SAVED, LEAST_SAME = 0.35, 0.8
#: Savings that differ by no more bytes are equal: the same match costs more bits from a farther place in a template.
EQUAL_SAVED = 2
LEVEL = 3
#: Words of everyday notices that speak for no license.
FILLER = frozenset(
    "this that these file files or later any code source project software work program library package module repository script is "
    "are the a an and all by in of for to under see released licensed distributed provided available covered terms "
    "details licence license v version".split()
)
#: Distinct sentences whose result a worker keeps; notices repeat a lot.
KEPT_SENTENCES = 50_000

# Notices that licenses ask to be used, and the short forms in common use.
TEMPLATES = {
    "Apache-2.0": (
        "Licensed under the Apache License, Version 2.0. Licensed under the Apache License, Version 2.0 (the "
        '"License"); you may not use this file except in compliance with the License. You may obtain a copy of the '
        "License at http://www.apache.org/licenses/LICENSE-2.0 Unless required by applicable law or agreed to in "
        'writing, software distributed under the License is distributed on an "AS IS" BASIS, WITHOUT WARRANTIES OR '
        "CONDITIONS OF ANY KIND, either express or implied. See the License for the specific language governing "
        "permissions and limitations under the License. This file is licensed under the Apache License 2.0. License: Apache-2.0 "
        "This project is licensed under the Apache License 2.0 - see the LICENSE file for details. "
        "Apache License Version 2.0, January 2004 SPDX-License-Identifier: Apache-2.0"
    ),
    "MIT": (
        "Released under the MIT License. Licensed under the MIT license. Permission is hereby granted, free of charge, "
        'to any person obtaining a copy of this software and associated documentation files (the "Software"), to deal '
        "in the Software without restriction, including without limitation the rights to use, copy, modify, merge, "
        "publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the "
        "Software is furnished to do so, subject to the following conditions: The above copyright notice and this "
        "permission notice shall be included in all copies or substantial portions of the Software. "
        'THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO '
        "THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE "
        "AUTHORS OR COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF "
        "CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS "
        "IN THE SOFTWARE. This project is licensed under the MIT License - see the LICENSE file for details. "
        "License: MIT. The MIT License (MIT) SPDX-License-Identifier: MIT"
    ),
    "GPL-3.0": (
        "This work is licensed under the GNU General Public License, version 3. This program is free software: you "
        "can redistribute it and/or modify it under the terms of the GNU General Public License as published by the "
        "Free Software Foundation, either version 3 of the License, or (at your option) any later version. "
        "This project is licensed under the GPLv3 License - see the LICENSE file for details. This code is under GPLv3. "
        "License: GPLv3 or later. Licensed under the GNU GPLv3. GNU GPL v3 GNU General Public License Version 3, 29 June 2007 "
        "License: GPL-3.0 SPDX-License-Identifier: GPL-3.0-only GPL-3.0-or-later"
    ),
    "GPL-2.0": (
        "This work is licensed under the GNU General Public License, version 2. This program is free software; you "
        "can redistribute it and/or modify it under the terms of the GNU General Public License as published by the "
        "Free Software Foundation; either version 2 of the License, or (at your option) any later version. "
        "This project is licensed under the GPLv2 License - see the LICENSE file for details. This code is under GPLv2. "
        "License: GPLv2 or later. Licensed under the GNU GPLv2. GNU GPL v2 GNU General Public License Version 2, June 1991 "
        "License: GPL-2.0 SPDX-License-Identifier: GPL-2.0-only GPL-2.0-or-later"
    ),
    "LGPL-3.0": (
        "This work is licensed under the GNU Lesser General Public License, version 3. This library is free software; "
        "you can redistribute it and/or modify it under the terms of the GNU Lesser General Public License as "
        "published by the Free Software Foundation; either version 3 of the License. License: LGPLv3 GNU LGPL v3 "
        "GNU Lesser General Public License Version 3, 29 June 2007 License: LGPL-3.0 SPDX-License-Identifier: LGPL-3.0-only "
        "LGPL-3.0-or-later"
    ),
    "LGPL-2.1": (
        "This work is licensed under the GNU Lesser General Public License, version 2.1. This library is free software; "
        "you can redistribute it and/or modify it under the terms of the GNU Lesser General Public License as "
        "published by the Free Software Foundation; either version 2.1 of the License, or (at your option) any later "
        "version. License: LGPLv2.1 GNU LGPL v2.1 GNU Lesser General Public License Version 2.1, February 1999 "
        "License: LGPL-2.1 SPDX-License-Identifier: LGPL-2.1-only LGPL-2.1-or-later"
    ),
    "AGPL-3.0": (
        "This work is licensed under the GNU Affero General Public License, version 3. you can redistribute it and/or "
        "modify it under the terms of the GNU Affero General Public License as published by the Free Software "
        "Foundation, either version 3 of the License. License: AGPLv3 GNU AGPL v3 GNU Affero General Public License Version "
        "3, 19 November 2007 License: AGPL-3.0 SPDX-License-Identifier: AGPL-3.0-only AGPL-3.0-or-later"
    ),
    "BSD-2-Clause": (
        "Released under the BSD 2-Clause License. Redistribution and use in source and binary forms, with or without "
        "modification, are permitted provided that the following conditions are met: Redistributions of source code "
        "must retain the above copyright notice, this list of conditions and the following disclaimer. Redistributions in "
        "binary form must reproduce the above copyright notice, this list of conditions and the following disclaimer in "
        "the documentation and/or other materials provided with the distribution. "
        'THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS "AS IS" AND ANY EXPRESS OR IMPLIED '
        "WARRANTIES, INCLUDING, BUT NOT LIMITED TO, THE IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A PARTICULAR "
        "PURPOSE ARE DISCLAIMED. License: BSD-2-Clause SPDX-License-Identifier: BSD-2-Clause"
    ),
    "BSD-3-Clause": (
        "Released under the BSD 3-Clause License. Redistribution and use in source and binary forms, with or without "
        "modification, are permitted provided that the following conditions are met: Redistributions of source code "
        "must retain the above copyright notice, this list of conditions and the following disclaimer. Redistributions in "
        "binary form must reproduce the above copyright notice, this list of conditions and the following disclaimer in "
        "the documentation and/or other materials provided with the distribution. Neither the "
        "name of the copyright holder nor the names of its contributors may be used to endorse or promote products "
        "derived from this software without specific prior written permission. "
        'THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS "AS IS" AND ANY EXPRESS OR IMPLIED '
        "WARRANTIES, INCLUDING, BUT NOT LIMITED TO, THE IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A PARTICULAR "
        "PURPOSE ARE DISCLAIMED. License: BSD-3-Clause SPDX-License-Identifier: BSD-3-Clause"
    ),
    "MPL-2.0": (
        "Licensed under the Mozilla Public License, version 2.0. This Source Code Form is subject to the terms of the "
        "Mozilla Public License, v. 2.0. If a copy of the MPL was not distributed with this file, You can obtain one "
        "at https://mozilla.org/MPL/2.0/. Mozilla Public License 2.0 License: MPL-2.0 SPDX-License-Identifier: MPL-2.0"
    ),
    "CC-BY-4.0": (
        "Licensed under CC BY 4.0. This work is licensed under a Creative Commons Attribution 4.0 International License. "
        "To view a copy of this license, visit http://creativecommons.org/licenses/by/4.0/ SPDX-License-Identifier: CC-BY-4.0"
    ),
    "CC-BY-SA-4.0": (
        "Licensed under CC BY-SA 4.0. This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 "
        "International License. To view a copy of this license, visit http://creativecommons.org/licenses/by-sa/4.0/ "
        "SPDX-License-Identifier: CC-BY-SA-4.0"
    ),
    "CC-BY-NC-4.0": (
        "Licensed under CC BY-NC 4.0. This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 "
        "International License. To view a copy of this license, visit http://creativecommons.org/licenses/by-nc/4.0/ "
        "SPDX-License-Identifier: CC-BY-NC-4.0"
    ),
    "CC-BY-NC-SA-4.0": (
        "Licensed under CC BY-NC-SA 4.0. This work is licensed under a Creative Commons Attribution-NonCommercial-ShareAlike "
        "4.0 International License. To view a copy of this license, visit "
        "http://creativecommons.org/licenses/by-nc-sa/4.0/ SPDX-License-Identifier: CC-BY-NC-SA-4.0"
    ),
    "CC-BY-ND-4.0": (
        "Licensed under CC BY-ND 4.0. This work is licensed under a Creative Commons Attribution-NoDerivatives 4.0 "
        "International License. To view a copy of this license, visit http://creativecommons.org/licenses/by-nd/4.0/ "
        "SPDX-License-Identifier: CC-BY-ND-4.0"
    ),
    "CC-BY-NC-ND-4.0": (
        "Licensed under CC BY-NC-ND 4.0. This work is licensed under a Creative Commons Attribution-NonCommercial-"
        "NoDerivatives 4.0 International License. To view a copy of this license, visit "
        "http://creativecommons.org/licenses/by-nc-nd/4.0/ SPDX-License-Identifier: CC-BY-NC-ND-4.0"
    ),
    "CC0-1.0": (
        "Released under CC0 1.0. To the extent possible under law, the author has dedicated all copyright and related "
        "and neighboring rights to this work to the public domain worldwide under CC0 1.0 Universal. "
        "SPDX-License-Identifier: CC0-1.0"
    ),
    "ISC": (
        "Released under the ISC License. Permission to use, copy, modify, and/or distribute this software for any "
        "purpose with or without fee is hereby granted, provided that the above copyright notice and this permission "
        "notice appear in all copies. SPDX-License-Identifier: ISC"
    ),
    "Unlicense": (
        "Released under the Unlicense. This is free and unencumbered software released into the public domain. Anyone "
        "is free to copy, modify, publish, use, compile, sell, or distribute this software, either in source code form "
        "or as a compiled binary, for any purpose, commercial or non-commercial, and by any means. "
        "SPDX-License-Identifier: Unlicense"
    ),
}
#: Words that tell licenses and versions apart: none of them may differ.
TELLING = frozenset(
    "apache mit gnu gpl gplv lesser lgpl lgplv affero agpl agplv bsd clause mozilla mpl creative commons cc cc0 by nc nd sa isc unlicense "
    "noncommercial sharealike noderivatives attribution 1 2 3 4 0".split()
)
TRIGGERS = rb"licen[sc]|copyright|redistribut|public domain|spdx|creative commons|\bcc0?[ -](?:by|1\.0)|\bgnu [al]?gpl|\b[al]?gplv[23]"

_TRIGGER = re.compile(TRIGGERS)
_SENTENCE = re.compile(rb"[\n]|(?<=[.;:!?])[ \t]+")
_WORD = re.compile(r"[a-z]+|[0-9]+")
#: An SPDX expression, and the identifiers that it joins.
_SPDX = re.compile(rb"(?i)spdx-license-identifier:[ \t]*([a-z0-9.+() \t-]*[a-z0-9.+)])")
_SPDX_ID = re.compile(rb"(?i)(?<![a-z0-9.+-])(?!(?:or|and|with)\b)[a-z0-9][a-z0-9.+-]*")
_SPDX_JOIN = re.compile(rb"(?i)[ \t](?:or|and|with)[ \t]")
#: Comment marks at the start of a line, and a line end with those of the next line.
_MARKS = rb"[ \t]*(?:(?:/{2,}|/?\*+|#+|;+|--+|%+|<!--|[>|])[ \t]*)?"
_FIRST, _LINE_END = re.compile(rb"\A" + _MARKS), re.compile(rb"[ \t\r]*\n" + _MARKS)

#: The number of a clause, on a line of its own behind the end of a clause.
_NUMBER = re.compile(rb"(?i)(?<=[.:;\n])([ \t\r]*\n" + _MARKS + rb")[ \t]*\(?(?:[0-9]{1,2}|[a-z])[.)][ \t]+")


def words_of(text: str) -> list[str]:
    return _WORD.findall(text.lower())


def unwrapped(notice: bytes) -> bytes:
    """A notice in one line, without comment marks and numbers of clauses."""
    return _LINE_END.sub(b" ", _FIRST.sub(b"", _NUMBER.sub(rb"\1", notice)))


class Scanner:
    """Compressors for the templates; made once per worker."""

    def __init__(self, templates=None):
        import zstandard as z

        self.names = list(templates or TEMPLATES)
        texts = [(templates or TEMPLATES)[n] for n in self.names]
        # frames without magic number, size and checksum, so that short sentences can be compared
        plain = z.ZstdCompressionParameters.from_level(
            LEVEL, format=z.FORMAT_ZSTD1_MAGICLESS, write_content_size=0, write_checksum=0, write_dict_id=0
        )
        self.alone = z.ZstdCompressor(compression_params=plain)
        self.given = [
            z.ZstdCompressor(
                compression_params=plain, dict_data=z.ZstdCompressionDict(t.lower().encode(), dict_type=z.DICT_TYPE_RAWCONTENT)
            )
            for t in texts
        ]
        self.words = [words_of(t) for t in texts]
        self.known = [set(x) | TELLING for x in self.words]
        # a notice of more words has too few of any template
        self.most_words = int(max(map(len, self.words)) / LEAST_SAME)
        self.kept = {}

    def saved(self, sentence: bytes) -> tuple[int, list[int]]:
        """The compressed size of a sentence in lower case, and the bytes of it that each template saves."""
        sentence = sentence.lower()
        size = len(self.alone.compress(sentence))
        return size, [size - len(c.compress(sentence)) for c in self.given]

    def differences(self, sentence: str, template: int):
        """(share of the sentence's words that are the template's in order, the other words, how many telling
        words of the template the sentence leaves out between others, and how many words).

        Words that speak for no license count for nothing in the share and are no differences."""
        own, known = words_of(sentence), self.words[template]
        match = difflib.SequenceMatcher(None, own, known, autojunk=False)
        same, passed, left_out, last = np.zeros(len(own), bool), 0, 0, None
        for block in match.get_matching_blocks():
            if block.size:
                same[block.a : block.a + block.size] = True
                if last is not None:
                    passed += sum(x in TELLING for x in known[last : block.b])
                    left_out += block.b - last
                last = block.b + block.size
        counts = np.array([x not in FILLER for x in own], bool)
        share = float(same[counts].mean()) if counts.any() else 0.0
        return share, [x for x, ok, c in zip(own, same, counts) if c and not ok], passed, left_out

    def reads_alike(self, part: bytes) -> bool:
        """Whether nearly all words of a part are a template's, but for the words that tell licenses apart."""
        own = words_of(unwrapped(part).decode(errors="replace"))
        return bool(own) and any(sum(x in k for x in own) >= LEAST_SAME * len(own) for k in self.known)

    def contradicted(self, names: str, notice: bytes) -> bool:
        """Whether a notice has words that tell it from one of the licenses of a part."""
        text = unwrapped(notice).decode(errors="replace")
        return any(TELLING.intersection(self.differences(text, self.names.index(n))[1]) for n in names.split("|"))

    def found(self, text: bytes):
        """(number of notices with a trigger word, rows (license, start, end, saved, differing words))."""
        n, rows = 0, []
        for parts in license_notices(text, self.reads_alike, self.most_words):
            n += 1
            start, end = parts[0][0], parts[-1][1]
            line_end = text.find(b"\n", end)
            named = self.identifiers(text, start, len(text) if line_end < 0 else line_end)
            if named:
                rows += named
                continue
            won = self.winner(text[start:end])
            if won:
                rows.append((won[0], start, end, *won[1:]))
                continue
            for a, b in parts if len(parts) > 1 else ():  # a notice in other company
                if _TRIGGER.search(text[a:b].lower()):
                    won = self.winner(text[a:b])
                    if won and not self.contradicted(won[0], text[start:end]):
                        rows.append((won[0], a, b, *won[1:]))
        return n, self.joined(text, rows)

    def identifiers(self, text: bytes, start: int, end: int):
        """Rows for the identifiers of an SPDX expression of several; each is judged as an expression of its own."""
        rows = []
        for m in _SPDX.finditer(text, start, end):
            if _SPDX_JOIN.search(m[1]):
                for i in _SPDX_ID.finditer(text, *m.span(1)):
                    won = self.winner(b"SPDX-License-Identifier: " + i[0])
                    if won:
                        rows.append((won[0], *i.span(), *won[1:]))
        return rows

    def joined(self, text: bytes, rows):
        """`rows` with those that several licenses share joined to their neighbours, if these name one of them too and
        nothing but numbers, marks and short conditions lies between."""
        out = []
        for row in rows:
            names = set(row[0].split("|"))
            while out:
                name, start, end, saved, other = out[-1]
                before = set(name.split("|"))
                between = text[end : row[1]]
                both = before & names
                if not both or len(before) + len(names) < 3 or not (len(before) > 1 or len(names) > 1):
                    break
                if words_of(between.decode(errors="replace")) and not self.near(between, both):
                    break
                whole = self.winner(text[start : row[2]])
                if whole and both >= set(whole[0].split("|")):
                    row = (whole[0], start, row[2], *whole[1:])
                else:
                    kept = [n for n in self.names if n in both]
                    row = ("|".join(kept), start, row[2], max(saved, row[3]), sorted({*other, *row[4]}))
                names = set(row[0].split("|"))
                out.pop()
            out.append(row)
        return out

    def near(self, between: bytes, names) -> bool:
        """Whether the words between two notices, but for numbers of clauses, are those of a license of them."""
        own = [x for x in words_of(unwrapped(between).decode(errors="replace")) if len(x) > 1]
        known = [self.known[self.names.index(n)] for n in names]
        return len(own) <= self.most_words and any(sum(x in k for x in own) >= LEAST_SAME * len(own) for k in known)

    def winner(self, sentence: bytes):
        """(license, saved share, differing words) of the best template borne out by the words, or None.

        Templates that no word tells apart are named together, in their order, with | between them."""
        if sentence not in self.kept:
            if len(self.kept) >= KEPT_SENTENCES:
                self.kept.clear()
            self.kept[sentence] = self._winner(sentence)
        return self.kept[sentence]

    def _winner(self, sentence):
        sentence = unwrapped(sentence)
        text = sentence.decode(errors="replace")
        if len(words_of(text)) > self.most_words:
            return None
        size, saved = self.saved(sentence)
        enough = [i for i in range(len(saved)) if saved[i] >= LEAST_SAVED * size]
        while enough:
            most = max(saved[i] for i in enough)
            ranks = {}
            for i in enough:
                if saved[i] >= most - EQUAL_SAVED:
                    same, other, passed, left_out = self.differences(text, i)
                    if same >= LEAST_SAME and not TELLING.intersection(other):
                        ranks.setdefault((passed, len(other), left_out), []).append((i, other))
            if ranks:
                best = ranks[min(ranks)]
                if 2 * len(best) > len(self.names):  # wording of most licenses speaks for none
                    return None
                return "|".join(self.names[i] for i, _ in best), max(saved[i] for i, _ in best) / size, best[0][1]
            enough = [i for i in enough if saved[i] < most - EQUAL_SAVED]
        return None


_scanner = None


def _worker_scanner() -> Scanner:
    global _scanner
    if _scanner is None:
        _scanner = Scanner()
    return _scanner


def license_notices(data: bytes, reads_alike, most_words: int):
    """Lists of (start, end) of the lines and clauses of each notice of one text that has a trigger word."""
    lower = data.lower()
    cuts = [m.span() for m in _SENTENCE.finditer(lower)]
    starts, ends = [0, *(b for _, b in cuts)], [*(a for a, _ in cuts), len(lower)]
    ended = lambda k: lower[starts[k] : ends[k]].rstrip().endswith((b".", b"!", b"?"))
    n_words = lambda k: len(words_of(lower[starts[k] : ends[k]].decode(errors="replace")))
    done = -1
    for m in _TRIGGER.finditer(lower):
        first = last = bisect.bisect_right(starts, m.start()) - 1
        if first <= done:
            continue
        size = n_words(first)
        while size <= most_words and last + 1 < len(starts) and not ended(last) and reads_alike(lower[starts[last + 1] : ends[last + 1]]):
            last += 1
            size += n_words(last)
        while size <= most_words and first - 1 > done and not ended(first - 1) and reads_alike(lower[starts[first - 1] : ends[first - 1]]):
            first -= 1
            size += n_words(first)
        done = last
        yield [(starts[k], ends[k]) for k in range(first, last + 1)]


def license_scan(docs: DataFrame, id_col="doc_id", text_col="text") -> DataFrame:
    """One row per row of `docs`: id, n_sentences (notices with a trigger word), found.

    `found` lists the notices with a winner, in order: license, start and end in bytes of UTF-8,
    saved (share of the compressed bytes) and the differing words. A null or empty text has none.
    Templates with equal savings that no word tells apart are one entry with | between their names. Rows that repeat give the same row each;
    an empty table gives no rows; other columns are not read.
    """
    id_type = docs.schema[id_col].dataType.simpleString()
    item = "array<struct<license:string,start:long,end:long,saved:double,differing:array<string>>>"
    arrow = pa.list_(pa.struct([
        ("license", pa.string()), ("start", pa.int64()), ("end", pa.int64()), ("saved", pa.float64()),
        ("differing", pa.list_(pa.string())),
    ]))

    def scan(batch):
        scanner = _worker_scanner()
        for a, b, data, borders in w.pieces(batch.column("text")):
            raw = data.tobytes()
            hits = np.array([m.start() for m in _TRIGGER.finditer(raw.lower())], np.int64)
            texts = np.unique(np.searchsorted(borders, hits, "right") - 1).tolist()
            n, found = np.zeros(b - a, np.int64), [[] for _ in range(b - a)]
            for t in texts:
                text = raw[borders[t] : borders[t + 1]]
                n[t], rows = scanner.found(text)
                names = ("license", "start", "end", "saved", "differing")
                found[t] = [dict(zip(names, row)) for row in rows]
            yield {"id": batch.column("id")[a:b], "n_sentences": n, "found": pa.array(found, arrow)}

    out = map_batches(id_and_text(docs, id_col, text_col), scan, f"id {id_type}, n_sentences long, found {item}")
    return out.withColumnRenamed("id", id_col)


def licenses(found="found"):
    """The distinct licenses of a document, sorted and joined by commas."""
    return F.array_join(F.array_sort(F.array_distinct(F.transform(found, lambda x: x["license"]))), ",")
