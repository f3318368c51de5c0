"""Removal of repeated byte strings by a depth-limited radix sort of suffixes.

Rule. A byte goes if a WINDOW-byte string that covers it also starts in a document with a smaller id. Strings are
judged on the input; they never cross documents.

Method. Suffixes are ordered only through WINDOW bytes, by most-significant-digit passes, and a group drops out as
soon as it holds one document. What is left after the last digit are exactly the repeated windows.

* First digit: the smallest hash among the KGRAM-byte strings of a window, its *anchor* (leftmost if equal). Equal
  windows have equal anchors at equal places, and neighbouring windows mostly share one, so one anchor stands for
  about 14 suffixes. Each chunk of documents sends its distinct anchors once to the hash partitions (46 bits or
  so: an accident only lets a group through to the exact digits) and learns which occur in two documents.
* Further digits: for surviving anchors a chunk sends the distinct byte strings that hold all their windows, with
  the least document id. The partition of the anchor sorts those windows eight bytes at a time, most significant
  digit first, and drops groups with one member between passes. It answers with the least id of every window.

Scale. Texts are shuffled once, by chunk, and that exchange is used by all three passes; hash partitions receive
each distinct value once a chunk, so a string in a third of all documents is no hot key. Anchors are under 8 % of
the bytes, surviving strings follow the amount of repetition. Every count follows the input (chunks of CHUNK_BYTES).

Defined cases: NULL text is empty; texts under WINDOW bytes lose nothing; NULL ids rank last; documents with the
same id remove nothing from each other; an empty table gives an empty result; other columns are not read.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from martline.llm.chunks import MESSAGE, by_part, chunked, messages
from martline.llm.hashing import mix, prefix_hash, text_blocks

WINDOW, KGRAM = 50, 24
LAST = np.iinfo(np.int64).max
CHUNK = 4 << 20
SPREAD = 0x9E6C63D0876A9A47


def ranks(column: pa.ChunkedArray) -> np.ndarray:
    """Document ids as integers, NULL last."""
    return np.array([LAST if i is None else i for i in column.to_pylist()], np.int64)


class Runs:
    """Runs of neighbouring windows with one anchor, over the concatenated texts of a chunk.

    ``first`` and ``end`` are the byte range of all windows of a run, ``offset`` the anchor's place in it, ``text``
    the document, ``anchor`` and ``string`` the hashes of the anchor and of the whole range.
    """

    def __init__(self, column: pa.ChunkedArray):
        parts, low, bufs = [], 0, []
        for at, buf, offsets in text_blocks(column):
            first, end, offset, anchor, string = block_runs(buf, offsets)
            text = np.searchsorted(offsets, first, "right") - 1 + at
            parts.append((first + low, end + low, offset, text, anchor, string))
            low += len(buf)
            bufs.append((at, buf, offsets))
        self.blocks = bufs
        self.first, self.end, self.offset, self.text, self.anchor, self.string = (np.concatenate([p[i] for p in parts]) for i in range(6))

    def keep(self, alive: np.ndarray) -> None:
        for name in ("first", "end", "offset", "text", "anchor", "string"):
            setattr(self, name, getattr(self, name)[alive])


def block_runs(buf: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, ...]:
    """(first, end, offset of the anchor, anchor hash, string hash) of the runs of a block of texts."""
    n, none = len(buf), np.zeros(0, np.int64)
    if n < WINDOW:
        return none, none, none, none.astype(np.uint64), none.astype(np.uint64)
    sums, down = prefix_hash(buf)
    # hash in the high half, place in the low one: one minimum finds the least hash and, if equal, the leftmost
    packed = (sums[KGRAM:] - sums[: n - KGRAM + 1]) * down[: n - KGRAM + 1]
    packed *= np.uint64(SPREAD)
    packed &= np.uint64(0xFFFFFFFF00000000)
    packed |= np.arange(len(packed), dtype=np.uint64)
    span, width = 1, WINDOW - KGRAM + 1
    while 2 * span <= width:
        packed = np.minimum(packed[:-span], packed[span:])
        span *= 2
    if span < width:
        packed = np.minimum(packed[: span - width], packed[width - span :])
    place = (packed & np.uint64(0xFFFFFFFF)).astype(np.uint32)
    # windows that would cross the end of a text belong to none
    cross = np.zeros(n + 1, np.int32)
    np.add.at(cross, np.maximum(offsets[1:] - WINDOW + 1, offsets[:-1]), 1)
    np.add.at(cross, offsets[1:], -1)
    inside = (np.cumsum(cross) == 0)[: len(place)]
    change = np.empty(len(place), np.bool_)
    change[0] = True
    change[1:] = (place[1:] != place[:-1]) | (inside[1:] != inside[:-1])
    new = np.flatnonzero(change)
    last = np.append(new[1:], len(place)) - 1
    ok = inside[new]
    first, end = new[ok], last[ok] + WINDOW
    at = place[first].astype(np.int64)
    anchor = mix((sums[at + KGRAM] - sums[at]) * down[at])
    return first, end, at - first, anchor, string_hashes(sums, down, first, end)


def string_hashes(sums: np.ndarray, down: np.ndarray, first: np.ndarray, end: np.ndarray) -> np.ndarray:
    return mix((sums[end] - sums[first]) * down[first] + (end - first).astype(np.uint64))


def ranges(first: np.ndarray, size: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(owner, place) of every element of the ranges [first, first + size)."""
    owner = np.repeat(np.arange(len(size)), size)
    return owner, np.arange(len(owner)) - np.repeat(np.cumsum(size) - size - first, size)


def _send_anchors(parts: int):
    def run(t: pa.Table) -> pa.Table:
        chunk, rank = t.column("chunk")[0].as_py(), ranks(t.column("doc_id"))
        runs = Runs(t.column("text"))
        hashes, whose = runs.anchor, rank[runs.text]
        distinct, least, most = least_and_most(hashes, whose)
        several = least != most
        rows = []
        for p, i in by_part(distinct, parts):
            high = distinct[i] >> np.uint64(24)
            data = (high >> np.uint64(8)).astype(np.uint32).tobytes() + (high & np.uint64(255)).astype(np.uint8).tobytes() + np.packbits(several[i]).tobytes()
            rows.append((chunk, p, str(len(i)), data))
        return messages(rows)

    return run


def least_and_most(keys: np.ndarray, values: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Distinct keys with the least and the greatest of their values."""
    if not len(keys):
        return keys, values, values
    order = np.argsort(keys, kind="stable")
    keys, values = keys[order], values[order]
    new = np.flatnonzero(np.concatenate([[True], keys[1:] != keys[:-1]]))
    return keys[new], np.minimum.reduceat(values, new), np.maximum.reduceat(values, new)


def _repeated_anchors(t: pa.Table) -> pa.Table:
    part, sources, high, several = t.column("part")[0].as_py(), [], [], []
    for chunk, kind, data in zip(t.column("chunk").to_pylist(), t.column("kind").to_pylist(), t.column("data").to_pylist()):
        n = int(kind)
        sources.append((chunk, n))
        high.append(np.frombuffer(data, np.uint32, n).astype(np.uint64) << np.uint64(8) | np.frombuffer(data, np.uint8, n, 4 * n))
        several.append(np.unpackbits(np.frombuffer(data, np.uint8, offset=5 * n), count=n))
    _, inverse, count = np.unique(np.concatenate(high), return_inverse=True, return_counts=True)
    weight = np.bincount(inverse, np.concatenate(several), len(count)) + count
    repeated, at, rows = weight[inverse] > 1, 0, []
    for chunk, n in sources:
        rows.append((chunk, part, "repeated", np.packbits(repeated[at : at + n]).tobytes()))
        at += n
    return messages(rows)


class Strings:
    """A chunk's surviving runs and their distinct strings, in the order (partition, string hash)."""

    def __init__(self, docs: pa.Table, answers: dict[int, bytes], parts: int):
        self.rank = ranks(docs.column("doc_id"))
        self.runs = runs = Runs(docs.column("text"))
        distinct, inverse = np.unique(runs.anchor, return_inverse=True)
        alive = np.zeros(len(distinct), np.bool_)
        for p, i in by_part(distinct, parts):
            alive[i] = np.unpackbits(np.frombuffer(answers[p], np.uint8), count=len(i)).astype(np.bool_)
        runs.keep(alive[inverse])
        part = (runs.anchor % np.uint64(parts)).astype(np.int64)
        order = np.lexsort((runs.string, part))
        new = np.ones(len(order), np.bool_)
        new[1:] = runs.string[order[1:]] != runs.string[order[:-1]]
        self.which = np.empty(len(order), np.int64)
        self.which[order] = np.cumsum(new) - 1
        self.sample = order[new]  # one run of each distinct string
        self.size = (runs.end - runs.first)[self.sample]
        starts = np.flatnonzero(new)
        self.least = np.minimum.reduceat(self.rank[runs.text][order], starts) if len(starts) else np.zeros(0, np.int64)
        self.bounds = np.searchsorted(part[self.sample], np.arange(parts + 1))


def _send_strings(parts: int):
    def run(docs: pa.Table, answers: pa.Table) -> pa.Table:
        chunk = docs.column("chunk")[0].as_py()
        s = Strings(docs, dict(zip(answers.column("part").to_pylist(), answers.column("data").to_pylist())), parts)
        buf = np.concatenate([b[1] for b in s.runs.blocks])
        rows = []
        for p in np.flatnonzero(np.diff(s.bounds)):
            i = slice(s.bounds[p], s.bounds[p + 1])
            _, place = ranges(s.runs.first[s.sample[i]], s.size[i])
            head = (s.size[i] - WINDOW).astype(np.uint8).tobytes() + s.runs.offset[s.sample[i]].astype(np.uint8).tobytes() + s.least[i].tobytes()
            rows.append((chunk, int(p), str(i.stop - i.start), head + buf[place].tobytes()))
        return messages(rows)

    return run


def least_ids(windows: np.ndarray, ids: np.ndarray) -> np.ndarray:
    """For every window (a row of WINDOW bytes) the least id of an equal one, by MSD radix passes of eight bytes."""
    out = ids.copy()
    digits = np.zeros((len(windows), -(-WINDOW // 8) * 8), np.uint8)
    digits[:, :WINDOW] = windows
    digits = digits.view(">u8")
    alive, group = np.arange(len(windows)), np.zeros(len(windows), np.int64)
    for d in range(digits.shape[1]):
        if not len(alive):
            return out
        digit = digits[alive, d].astype(np.uint64)
        order = np.lexsort((digit, group))
        alive, group, digit = alive[order], group[order], digit[order]
        new = np.concatenate([[True], (group[1:] != group[:-1]) | (digit[1:] != digit[:-1])])
        group = np.cumsum(new) - 1
        many = np.bincount(group)[group] > 1
        alive, group = alive[many], group[many]
    if len(alive):
        new = np.flatnonzero(np.concatenate([[True], group[1:] != group[:-1]]))
        runs = np.diff(np.append(new, len(group)))
        out[alive] = np.repeat(np.minimum.reduceat(ids[alive], new), runs)
    return out


def _sort_strings(t: pa.Table) -> pa.Table:
    part, sources, sizes, offsets, least, data = t.column("part")[0].as_py(), [], [], [], [], []
    for chunk, kind, blob in zip(t.column("chunk").to_pylist(), t.column("kind").to_pylist(), t.column("data").to_pylist()):
        n = int(kind)
        sources.append((chunk, n))
        sizes.append(np.frombuffer(blob, np.uint8, n).astype(np.int64) + WINDOW)
        offsets.append(np.frombuffer(blob, np.uint8, n, n))
        least.append(np.frombuffer(blob, np.int64, n, 2 * n))
        data.append(np.frombuffer(blob, np.uint8, offset=10 * n))
    size, ids, buf, at = np.concatenate(sizes), np.concatenate(least), np.concatenate(data), np.concatenate(offsets)
    first = np.cumsum(size) - size
    sums, down = prefix_hash(buf)
    # strings that chunks have in common are sorted once, with the least id of all
    _, sample, which = np.unique(string_hashes(sums, down, first, first + size), return_index=True, return_inverse=True)
    own = np.full(len(sample), LAST, np.int64)
    np.minimum.at(own, which, ids)
    size, first = size[sample], first[sample]
    a = first + at[sample]
    _, group, members = np.unique(sums[a + KGRAM] * down[a] - sums[a] * down[a], return_inverse=True, return_counts=True)
    windows = size - WINDOW + 1
    owner, place = ranges(first, windows)
    found = own[owner]
    open_ = np.flatnonzero(members[group][owner] > 1)  # an anchor with one string: its windows share the string's id
    if len(open_):
        found[open_] = least_ids(np.lib.stride_tricks.sliding_window_view(buf, WINDOW)[place[open_]], found[open_])
    start = np.cumsum(windows) - windows
    rows, low = [], 0
    for chunk, n in sources:
        mine = which[low : low + n]
        string, w = ranges(start[mine], windows[mine])
        value = found[w]
        # runs of windows with one answer: (length of the run, id)
        new = np.flatnonzero(np.concatenate([[True], (value[1:] != value[:-1]) | (string[1:] != string[:-1])]))
        length = np.diff(np.append(new, len(value)))
        rows.append((chunk, part, "least", length.astype(np.uint8).tobytes() + value[new].tobytes()))
        low += n
    return messages(rows)


RESULT = "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string, removed array<struct<start:long,end:long>>"


def _remove(parts: int):
    def run(docs: pa.Table, answers: pa.Table) -> pa.Table:
        by: dict[str, dict[int, bytes]] = {"repeated": {}, "least": {}}
        for part, kind, data in zip(answers.column("part").to_pylist(), answers.column("kind").to_pylist(), answers.column("data").to_pylist()):
            by[kind][part] = data
        s = Strings(docs, by["repeated"], parts)
        total = sum(len(b[1]) for b in s.runs.blocks)
        known = []
        for p in np.flatnonzero(np.diff(s.bounds)):
            blob = by["least"][int(p)]
            n = len(blob) // 9
            known.append(np.repeat(np.frombuffer(blob, np.int64, n, n), np.frombuffer(blob, np.uint8, n)))
        gone = np.zeros(total, np.bool_)
        if known:
            known = np.concatenate(known)
            windows = s.size - WINDOW + 1
            start = np.cumsum(windows) - windows
            # each run looks up the answers of its string's windows
            owner, w = ranges(start[s.which], windows[s.which])
            hit = known[w] < s.rank[s.runs.text][owner]
            place = (s.runs.first[owner] + w - start[s.which][owner])[hit]
            mark = np.bincount(place, minlength=total + 1) - np.bincount(place + WINDOW, minlength=total + 1)
            gone = np.cumsum(mark[:-1]) > 0
        ids, out, low = docs.column("doc_id").to_pylist(), [], 0
        for at, buf, offsets in s.runs.blocks:
            here = gone[low : low + len(buf)]
            low += len(buf)
            for j in range(len(offsets) - 1):
                mine, text = here[offsets[j] : offsets[j + 1]], buf[offsets[j] : offsets[j + 1]]
                edges = np.diff(np.concatenate([[False], mine, [False]]).astype(np.int8))
                spans = list(zip(np.flatnonzero(edges == 1).tolist(), np.flatnonzero(edges == -1).tolist()))
                out.append((ids[at + j], len(text), int(mine.sum()), len(spans), hashlib.sha256(text[~mine].tobytes()).hexdigest(), [{"start": a, "end": b} for a, b in spans]))
        types = [pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.string(), pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))]
        names = ["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256", "removed"]
        return pa.Table.from_arrays([pa.array([r[i] for r in out], k) for i, k in enumerate(types)], names)

    return run


def repeated_substrings(docs: DataFrame) -> DataFrame:
    """One row per document: bytes, removed bytes and runs, hash of what stays, and the removed byte ranges."""
    d, parts = chunked(docs, CHUNK)
    mine = d.groupBy("chunk")
    repeated = mine.applyInArrow(_send_anchors(parts), MESSAGE).groupBy("part").applyInArrow(_repeated_anchors, MESSAGE)
    strings = mine.cogroup(repeated.groupBy("chunk")).applyInArrow(_send_strings(parts), MESSAGE)
    least = strings.groupBy("part").applyInArrow(_sort_strings, MESSAGE)
    return mine.cogroup(repeated.unionByName(least).groupBy("chunk")).applyInArrow(_remove(parts), RESULT)


def suffix_dedup(docs: DataFrame) -> DataFrame:
    """The contract's rows."""
    return repeated_substrings(docs.select("doc_id", "text")).drop("removed")
