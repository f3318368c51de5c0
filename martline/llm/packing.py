"""Best-fit packing of tokenised documents into sequences, improved by swap-based local search.

Method. A document is its token ids and one end id. Only a document longer than ``capacity`` is cut, from its end, so
its first piece may be shorter. A full piece is a sequence. The others are dealt to shards; in a shard they are placed
best fit, longest first, and local search then empties bins: the emptiest underfull bin gives its pieces away, by

* moving a piece into another bin's gap,
* exchanging one piece for one smaller piece, or for two that are smaller together,
* exchanging two pieces for one that is smaller than both together,

where the other bin is at least as full. Each exchange therefore raises the sum of squared fills, so the search ends;
passes are repeated until one finds no exchange.

Scale. Tokenising is one pass without a shuffle; a worker keeps the ids of words it has met, within a bound. Pieces are
rows of 48 bytes, stored once in the shared checkpoint folder, so shards stay the same when a task is run again. A
shard holds about ``SHARD_PIECES`` pieces whatever the input's size or its keys (they are dealt by the hash of their
place in the stored table). A shard loses at most what its last underfull bins leave, one or two of its tens of thousands of sequences.

Defined cases: NULL and empty texts are the end id alone; a very long text is cut like any other and takes memory in
proportion to itself; rows sharing an id, or equal in all, are packed each for itself; NULL ids stay NULL; other
columns are ignored; an empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator
from heapq import heapify, heappop, heappush
from itertools import combinations
from zlib import crc32

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from martline.llm.hashing import text_blocks
from martline.llm.subwords import Known, byte_bpe, cut_parts, ragged
from martline.session import cut_lineage

CAPACITY, END_ID = 1024, 2
SHARD_PIECES = 1 << 16
KNOWN_PARTS = 2_000_000
BLOCK = 4 << 20
PIECES = "doc_id long, piece int, start long, length long, ids_crc32 long"
PACKED = f"{PIECES}, sequence_id long, offset long"
_PIECE_TYPES = [pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64()]
_ids: dict[str, "Ids"] = {}


class Ids(Known):
    """Ids of the parts met so far."""

    def __init__(self, path: str):
        super().__init__(KNOWN_PARTS)
        self.bpe = byte_bpe(path)
        self.ids, self.count = np.zeros(0, "<u4"), np.zeros(0, np.int64)

    def learn(self, parts: list[bytes]) -> None:
        ids, n = self.bpe.encode_parts(parts)
        self.ids, self.count = np.concatenate([self.ids, ids.astype("<u4")]), np.concatenate([self.count, n])

    def of(self, buf: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(ids of all texts in order, how many each has)."""
        start, end, text = cut_parts(buf, offsets)
        slot = self.slots(buf, start, end, self.learn)
        n = self.count[slot]
        at = np.cumsum(self.count) - self.count
        return self.ids[ragged(at[slot], n)], np.bincount(text, n, len(offsets) - 1).astype(np.int64)


def known_ids(path: str) -> Ids:
    """The worker's ids of parts, begun anew when it holds more than ``KNOWN_PARTS``."""
    if path not in _ids or _ids[path].full():
        _ids[path] = Ids(path)
    return _ids[path]


def cuts(n: int, capacity: int) -> list[tuple[int, int]]:
    """(start, length) of the pieces of a document of ``n`` ids."""
    first = n % capacity or capacity
    return [(0, first)] + [(at, capacity) for at in range(first, n, capacity)] if n > capacity else [(0, n)]


def _pieces(path: str, end_id: int, capacity: int):
    end = np.array([end_id], "<u4").tobytes()
    names = [f.split()[0] for f in PIECES.split(", ")]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            doc_ids = b.column(0).to_pylist()
            for first, buf, offsets in text_blocks(b.column(1), BLOCK):
                ids, counts = known_ids(path).of(buf, offsets)
                data, at, rows = ids.tobytes(), 0, [[] for _ in names]
                for doc_id, n in zip(doc_ids[first:], counts.tolist()):
                    own, at = data[at : at + 4 * n] + end, at + 4 * n
                    for k, (start, length) in enumerate(cuts(n + 1, capacity)):
                        for column, value in zip(rows, (doc_id, k, start, length, crc32(own[4 * start : 4 * (start + length)]))):
                            column.append(value)
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(rows, _PIECE_TYPES)], names)

    return run


def best_fit(sizes: np.ndarray, capacity: int) -> list[list[int]]:
    """Bins (lists of places in ``sizes``), longest first, each into the fullest bin that has room."""
    bins: list[list[int]] = []
    by_gap: list[list[int]] = [[] for _ in range(capacity + 1)]
    open_gaps = 0  # bit g: some bin has a gap of g
    for i in np.argsort(-sizes, kind="stable").tolist():
        size = int(sizes[i])
        room = open_gaps >> size
        if room:
            gap = size + (room & -room).bit_length() - 1
            k = by_gap[gap].pop()
            if not by_gap[gap]:
                open_gaps ^= 1 << gap
        else:
            gap, k = capacity, len(bins)
            bins.append([])
        bins[k].append(i)
        if gap > size:
            by_gap[gap - size].append(k)
            open_gaps |= 1 << gap - size
    return bins


class Exchange:
    """Which underfull bins offer a piece, or two together, of a size: for each size the one with the largest gap."""

    def __init__(self, sizes: np.ndarray, bins: list[list[int]], capacity: int):
        self.sizes, self.bins, self.capacity = sizes.tolist(), bins, capacity
        self.version = [0] * len(bins)
        self.offers: list[list[list]] = [[[] for _ in range(capacity + 1)] for _ in range(2)]
        self.largest = np.full((2, capacity + 1), -1)

    def fill(self, k: int) -> int:
        return sum(self.sizes[i] for i in self.bins[k])

    def totals(self, k: int) -> list[dict[int, tuple[int, ...]]]:
        """Pieces of bin ``k`` by their size (0 is none of them), and pairs by their size together."""
        one = {0: ()}
        for i in self.bins[k]:
            one.setdefault(self.sizes[i], (i,))
        two: dict[int, tuple[int, ...]] = {}
        seen: dict[int, list[int]] = {}
        for i in self.bins[k]:
            seen.setdefault(self.sizes[i], []).append(i)
        few = [i for same in seen.values() for i in same[:2]]
        for i, j in combinations(few, 2):
            two.setdefault(self.sizes[i] + self.sizes[j], (i, j))
        return [one, two]

    def take_in(self, ks: list[int]) -> None:
        """Offer these bins."""
        touched: set[tuple[int, int]] = set()
        for k in ks:
            gap = self.capacity - self.fill(k)
            if gap:
                for kind, totals in enumerate(self.totals(k)):
                    for size in totals:
                        heappush(self.offers[kind][size], (-gap, k, self.version[k]))
                        touched.add((kind, size))
        self.refresh(touched)

    def refresh(self, touched: set[tuple[int, int]]) -> None:
        for kind, size in touched:
            heap = self.offers[kind][size]
            while heap and self.version[heap[0][1]] != heap[0][2]:
                heappop(heap)
            self.largest[kind, size] = -heap[0][0] if heap else -1

    def take_out(self, k: int) -> None:
        self.version[k] += 1
        self.refresh({(kind, size) for kind, totals in enumerate(self.totals(k)) for size in totals})

    def partner(self, size: int) -> tuple[int, tuple[int, ...]] | None:
        """(bin, pieces) to give up for pieces of ``size`` together: the smallest total whose bin has room."""
        need = size - np.arange(size)
        ways = []
        for kind in (0, 1):
            fits = np.flatnonzero(self.largest[kind, :size] >= need)
            if len(fits):
                ways.append((int(fits[0]), kind))
        if not ways:
            return None
        total, kind = min(ways)
        k = self.offers[kind][total][0][1]
        return k, self.totals(k)[kind][total]


def empty_bin(k: int, search: Exchange) -> int:
    """Exchange pieces of bin ``k`` (the emptiest on offer, taken out) as long as that lowers its fill; how often it did."""
    bins, sizes, done = search.bins, search.sizes, 0
    while bins[k]:
        mine = sorted(set(bins[k]), key=lambda i: -sizes[i])
        distinct = {sizes[i]: i for i in reversed(mine)}
        best = None
        for out in [(i,) for i in distinct.values()] + list(combinations(mine[:8], 2)):
            total = sum(sizes[i] for i in out)
            # two that fit one bin's gap fit it one after the other
            found = search.partner(total) if total <= search.capacity else None
            if found:
                gain = total - sum(sizes[i] for i in found[1])
                if best is None or gain > best[0]:
                    best = (gain, out, *found)
        if best is None:
            return done
        _, out, other, back = best
        done += 1
        search.take_out(other)
        bins[k] = [i for i in bins[k] if i not in out] + list(back)
        bins[other] = [i for i in bins[other] if i not in back] + list(out)
        search.take_in([other])
    return done


def local_search(sizes: np.ndarray, bins: list[list[int]], capacity: int) -> list[list[int]]:
    """Fewer bins with the same pieces, or as many; passes go on until one finds nothing to exchange."""
    while True:
        search = Exchange(sizes, bins, capacity)
        order = [(search.fill(k), k) for k in range(len(bins))]
        search.take_in([k for _, k in order])
        heapify(order)
        exchanges = 0
        while order:
            fill, k = heappop(order)
            now = search.fill(k)
            if now == capacity:
                continue
            if now != fill:  # it took in pieces meanwhile
                heappush(order, (now, k))
                continue
            # a bin that cannot be emptied stays out of this pass: those left on offer are at least as full as the next
            search.take_out(k)
            exchanges += empty_bin(k, search)
        bins = [b for b in bins if b]
        if not exchanges:
            return bins


def _pack(capacity: int):
    def run(t: pa.Table) -> pa.Table:
        t = t.combine_chunks()
        sizes = t.column("length").to_numpy().astype(np.int64)
        sequence, offset = np.empty(len(sizes), np.int64), np.empty(len(sizes), np.int64)
        base = t.column("shard")[0].as_py() << 32
        for number, members in enumerate(local_search(sizes, best_fit(sizes, capacity), capacity)):
            sequence[members] = base + number
            offset[members] = np.cumsum(sizes[members]) - sizes[members]
        columns = [t.column(f.split()[0]) for f in PIECES.split(", ")] + [pa.array(sequence), pa.array(offset)]
        return pa.Table.from_arrays(columns, [f.split()[0] for f in PACKED.split(", ")])

    return run


def pack_documents(docs: DataFrame, tokenizer: str, end_id: int = END_ID, capacity: int = CAPACITY, shard_pieces: int = SHARD_PIECES) -> DataFrame:
    """One row per piece: ``PACKED``. ``tokenizer`` is the path of a byte-level BPE file, the same on all machines."""
    cut = docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(_pieces(tokenizer, end_id, capacity), PIECES)
    cut = cut_lineage(cut.withColumn("place", F.monotonically_increasing_id()))
    full = cut.where(F.col("length") == capacity).select(*cut.columns[:-1], (-1 - F.col("place")).alias("sequence_id"), F.lit(0).cast("long").alias("offset"))
    short = cut.where(F.col("length") < capacity)
    shards = max(1, -(-short.count() // shard_pieces))
    dealt = short.withColumn("shard", F.pmod(F.xxhash64("place"), F.lit(shards)))
    return dealt.groupBy("shard").applyInArrow(_pack(capacity), PACKED).unionByName(full)
