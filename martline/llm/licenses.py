"""License scans by conditional compression.

Method. Around every trigger of a text, blocks of words are candidates, one for each size of passage. A block is compressed alone
and with each passage of its size as a raw zstandard dictionary; the bytes that the dictionary saves, as a share of what
the passage itself takes, rank the passages. Those that save ``MIN_REDUCTION`` or more are confirmed, largest saving
first, by the exact differences in wording between the passage and the run of words round the trigger that is closest
to it. Of overlapping confirmed notices the one whose wording its dictionary saves most bytes of stays: the ranking decides, not
the count of words.

Blocks are runs of words, whatever the lines, blank lines and comment marks between them, so a notice is found in
wrapped text, across paragraphs and in the middle of a long line. A confirmed notice has a trigger, differs in at most
``MAX_DIFFERENCE`` of the passage's words and so lies in a block of that many more words on both sides of the trigger. A
wording without any trigger word is not found.

Scale. One pass over the texts without a shuffle. A JVM filter keeps documents with a trigger word, so Python
sees few of them. Blocks are bounded by the longest passage; every trigger of a text has its blocks but those inside
a notice found word for word, so nothing is skipped in long texts. Templates are constants of the library, far below a
megabyte, prepared as dictionaries once a worker.

Defined cases: NULL and empty texts have no blocks; a very long text is scanned whole; a text with several notices gives a row for each; repeated
rows give repeated findings; ties go to the smaller wording difference, then to the longer passage and the id in
alphabetical order; offsets reach to the line's ends where no other word stands there; other columns are not read; an
empty table gives no rows.
"""

from __future__ import annotations

import difflib
import math
import re
from bisect import bisect_right
from collections import Counter
from collections.abc import Iterator
from functools import lru_cache

import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: What stands between two words of a trigger, which a line end and a comment mark may part.
_GAP = "[^A-Za-z0-9]{1,40}"
TRIGGER = rf"(?i)licen[sc]|copyright|\(c\)|spdx|permission{_GAP}is{_GAP}hereby|public{_GAP}domain|redistribution{_GAP}and{_GAP}use|warrant"
MIN_REDUCTION, MAX_DIFFERENCE = 0.25, 0.2
LEVEL = 19

# The wording of public license notices, by SPDX id. Short notice lines first, then standard text.
TEMPLATES = {
    "Apache-2.0": [
        "Licensed under the Apache License, Version 2.0.",
        "SPDX-License-Identifier: Apache-2.0",
        'Licensed under the Apache License, Version 2.0 (the "License"); you may not use this file except in compliance with the License. You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0',
        'Unless required by applicable law or agreed to in writing, software distributed under the License is distributed on an "AS IS" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied. See the License for the specific language governing permissions and limitations under the License.',
    ],
    "BSD-2-Clause": [
        "Released under the BSD 2-Clause License.",
        "SPDX-License-Identifier: BSD-2-Clause",
        "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met: 1. Redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer. 2. Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the following disclaimer in the documentation and/or other materials provided with the distribution.",
    ],
    "BSD-3-Clause": [
        "Released under the BSD 3-Clause License.",
        "SPDX-License-Identifier: BSD-3-Clause",
        "Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products derived from this software without specific prior written permission.",
    ],
    "CC-BY-4.0": [
        "Licensed under CC BY 4.0.",
        "This work is licensed under a Creative Commons Attribution 4.0 International License.",
        "SPDX-License-Identifier: CC-BY-4.0",
    ],
    "CC-BY-NC-4.0": [
        "Licensed under CC BY-NC 4.0.",
        "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License.",
        "SPDX-License-Identifier: CC-BY-NC-4.0",
    ],
    "CC-BY-SA-4.0": [
        "Licensed under CC BY-SA 4.0.",
        "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License.",
        "SPDX-License-Identifier: CC-BY-SA-4.0",
    ],
    "CC0-1.0": [
        "Released under CC0 1.0. To the extent possible under law, the author has waived all copyright and related or neighboring rights to this work.",
        "SPDX-License-Identifier: CC0-1.0",
    ],
    "GPL-2.0": [
        "This work is licensed under the GNU General Public License, version 2.",
        "SPDX-License-Identifier: GPL-2.0-only",
        "This program is free software; you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation; either version 2 of the License, or (at your option) any later version.",
    ],
    "GPL-3.0": [
        "This work is licensed under the GNU General Public License, version 3.",
        "SPDX-License-Identifier: GPL-3.0-only",
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version.",
    ],
    "ISC": [
        "Released under the ISC License.",
        "SPDX-License-Identifier: ISC",
        "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, provided that the above copyright notice and this permission notice appear in all copies.",
    ],
    "LGPL-3.0": [
        "This work is licensed under the GNU Lesser General Public License, version 3.",
        "SPDX-License-Identifier: LGPL-3.0-only",
    ],
    "MIT": [
        "Released under the MIT License.",
        "Licensed under the MIT License.",
        "SPDX-License-Identifier: MIT",
        'Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the "Software"), to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the Software is furnished to do so, subject to the following conditions: The above copyright notice and this permission notice shall be included in all copies or substantial portions of the Software.',
    ],
    "MPL-2.0": [
        "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0.",
        "SPDX-License-Identifier: MPL-2.0",
    ],
    "Unlicense": [
        "This is free and unencumbered software released into the public domain.",
        "SPDX-License-Identifier: Unlicense",
    ],
}


WORD = re.compile(r"[A-Za-z0-9][A-Za-z0-9.+-]*[A-Za-z0-9+]|[A-Za-z0-9]")


def _words(text: str) -> list[str]:
    return WORD.findall(text.lower())


def _compressor(words: list[str]):
    # a raw dictionary shorter than eight bytes is refused, so each one is led by white space
    raw = zstandard.ZstdCompressionDict((" " * 8 + " ".join(words)).encode(), dict_type=zstandard.DICT_TYPE_RAWCONTENT)
    raw.precompute_compress(level=LEVEL)
    return zstandard.ZstdCompressor(dict_data=raw, write_content_size=False)


class Matcher:
    """Compressors with each passage as a raw dictionary; built once per Python worker."""

    def __init__(self, templates: dict[str, list[str]] = TEMPLATES):
        self.passages = [(k, _words(p)) for k, v in templates.items() for p in v]
        self.with_dict = [_compressor(words) for _, words in self.passages]
        self.alone = zstandard.ZstdCompressor(level=LEVEL, write_content_size=False)
        self.reach = [math.floor(len(words) * (1 + MAX_DIFFERENCE) + 1e-9) for _, words in self.passages]
        self.own_size = [self._size(" ".join(words)) for _, words in self.passages]
        #: words on each side of a trigger -> passages of that size
        self.sizes: dict[int, list[int]] = {}
        for passage, reach in enumerate(self.reach):
            self.sizes.setdefault(1 << (reach - 1).bit_length(), []).append(passage)
        self.saved = lru_cache(20_000)(self._saved)
        self.closest = lru_cache(20_000)(self._closest)

    def _size(self, text: str) -> int:
        return len(self.alone.compress(text.encode("utf-8", "surrogatepass")))

    def _saved(self, text: str, passages: tuple[int, ...]) -> tuple[int, ...]:
        """Bytes that each passage as a dictionary saves on ``text``."""
        data, size = text.encode("utf-8", "surrogatepass"), self._size(text)
        return tuple(size - len(self.with_dict[p].compress(data)) for p in passages)

    def ranked(self, own: list[str], trigger: int) -> list[tuple[float, int]]:
        """(share saved, passage) of the passages over the threshold for the blocks round a trigger, the largest first."""
        out = []
        for reach, passages in self.sizes.items():
            block = " ".join(own[max(0, trigger - reach) : trigger + reach + 1])
            out += [(saved / self.own_size[p], p) for p, saved in zip(passages, self.saved(block, tuple(passages)))]
        return sorted(((share, p) for share, p in out if share >= MIN_REDUCTION), key=lambda x: (-x[0], x[1]))

    def confirmed(self, own: list[str], trigger: int, passage: int) -> tuple[int, int, int] | None:
        """(words that differ, first word, word after the last) of the run of words round the trigger that is the passage."""
        words, reach = self.passages[passage][1], self.reach[passage]
        low, high = max(0, trigger - reach), min(trigger + reach + 1, len(own))
        # the whole window; where another copy stands in it, what is left of it; the passage laid on the trigger
        tries = [(low, high)]
        tries += [(max(low, trigger - i - reach + len(words)), min(high, trigger - i + reach)) for i, w in enumerate(words) if w == own[trigger]]
        for lo, hi in tries:
            if hit := self.closest(tuple(own[lo:hi]), passage):
                first, last = lo + hit[1], lo + hit[2]
                if first <= trigger < last:
                    return hit[0], first, last
                tries.append((last, hi) if last <= trigger else (lo, first))
        return None

    def _closest(self, own: tuple[str, ...], passage: int) -> tuple[int, int, int] | None:
        """(words that differ, first word, word after the last) of the run of words closest to the passage, if close enough."""
        words = self.passages[passage][1]
        if (Counter(own) & Counter(words)).total() < (1 - MAX_DIFFERENCE) * len(words):
            return None
        best = (len(words) + 1, 0, 0)
        value, first, last = 0, 0, 0
        # of the matching blocks, the neighbouring ones with the most words that match less words between them
        for x in difflib.SequenceMatcher(None, own, words, autojunk=False).get_matching_blocks()[:-1]:
            value -= x.a - last
            if value <= 0:
                value, first = 0, x.a
            value, last = value + x.size, x.a + x.size
            best = min(best, (len(words) - value, first, last))
        return best if best[0] <= MAX_DIFFERENCE * len(words) else None


def scan_text(text: str, matcher: Matcher, trigger: re.Pattern) -> list[dict]:
    """All confirmed notices of a text; of overlapping ones the one whose dictionary saves most of its bytes."""
    at = [(m.start(), m.end(), m.group().lower()) for m in WORD.finditer(text)]
    ends = [x[1] for x in at]
    own = [x[2] for x in at]
    found, done = {}, 0
    for t in sorted({k for m in trigger.finditer(text) if (k := bisect_right(ends, m.start())) < len(at)}):
        if t < done:  # in a notice that was found word for word
            continue
        for _, passage in matcher.ranked(own, t):
            if (hit := matcher.confirmed(own, t, passage)) is None:
                continue
            count, first, last = hit
            template, words = matcher.passages[passage]
            span = " ".join(own[first:last])
            saved = matcher.saved(span, (passage,))[0]
            found[passage, first, last] = (-saved, count, -len(words), template, first, last, saved / matcher.own_size[passage])
            if count == 0 and first <= t < last:
                done = max(done, last)
    kept: list[tuple] = []
    for f in sorted(found.values()):
        if all(f[5] <= x[4] or f[4] >= x[5] for x in kept):
            kept.append(f)
    rows = []
    for _, count, _, template, first, last, reduction in sorted(kept, key=lambda x: x[4]):
        start, end = at[first][0], at[last - 1][1]
        line, stop = text.rfind("\n", 0, start) + 1, text.find("\n", end)
        stop = len(text) if stop < 0 else stop
        if not any(c.isalnum() for c in text[line:start]):
            start = line
        if not any(c.isalnum() for c in text[end:stop]):
            end = stop
        rows.append({"license": template, "start": start, "end": end, "reduction": reduction, "differing_words": count})
    return rows


FOUND = "doc_id long, license string, start int, end int, reduction double, differing_words int, exact boolean"


def _scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    matcher, trigger = Matcher(), re.compile(TRIGGER)
    types = [("doc_id", pa.int64()), ("license", pa.string()), ("start", pa.int32()), ("end", pa.int32()), ("reduction", pa.float64()), ("differing_words", pa.int32()), ("exact", pa.bool_())]
    for b in batches:
        rows = []
        for doc_id, text in zip(b.column(0).to_pylist(), b.column(1).to_pylist()):
            rows += [{"doc_id": doc_id, "exact": f["differing_words"] == 0, **f} for f in scan_text(text, matcher, trigger)]
        yield pa.RecordBatch.from_pylist([{k: r[k] for k, _ in types} for r in rows], schema=pa.schema(types))


def license_scan(docs: DataFrame) -> DataFrame:
    """One row per license notice found in a document (offsets in code points of the original text)."""
    return docs.where(F.col("text").rlike(TRIGGER)).select("doc_id", "text").mapInArrow(_scan, FOUND)
