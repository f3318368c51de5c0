"""Language-model scoring with a log-frequency Bloom filter.

Method. Counts of words and of word pairs are taken over all training documents. A count c is quantised to
q = 1 + floor(log_BASE c), and the n-gram is put into a Bloom filter q times, once for each level up to q. A
reader probes level after level until one is missing and takes the middle of the last level's range as the count.
Probabilities come from probes alone:

    P(w)      = (c(w) - D) / N, and for every unknown word D * V / N (one type), D = n1 / (n1 + 2 n2)
    P(w | v)  = (1 - M) P(w) + M min(1, c(v, w) / c(v)) if v is known, else P(w)

The contract's ``base_score`` needs exact counts; these come back to each chunk from the count partitions.

Scale. A chunk of documents sends each distinct word and pair once, hashed, to the partition of its hash, so
frequent words are pre-aggregated and the shuffles grow with the corpus. Each partition builds its own segment of
the filter, ``BITS`` bits an entry, so the filter grows with the corpus and its error rate stays. A filter whose
segments cannot exceed ``FILTER_BYTES`` together is broadcast. A larger one stays where it is: the chunks' counts name
their other n-grams too (0 times), and a partition that has built its segment probes it once for each n-gram it was
sent and returns the levels with the counts, so nothing is asked twice; scores are the same. Its statistics go to
every chunk with them, so this is one job: the texts are shuffled once and read twice, and nothing is stored between.
A partition serves ``CHUNKS_A_PART`` chunks, which keeps messages large. Every pair of the training documents is
stored, those seen once at level 1.

Defined cases: NULL and empty texts have one token, the end; NULL ids count as not held out; repeated rows count
and are scored each; without training tokens every probability is 1; an empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator
from zlib import crc32

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from martline.llm.chunks import MESSAGE, by_part, chunked, messages
from martline.llm.hashing import lower_bytes, mix, text_blocks, word_hashes
from martline.session import cut_lineage

BASE, PROBES, BITS = 1.5, 5, 10
FILTER_BYTES = 64 << 20
CHUNK = 4 << 20
#: Partitions of the hash space: one for each of the first chunks, then one for so many chunks.
FEW_PARTS, CHUNKS_A_PART = 16, 4
PAIR_WEIGHT = 0.2
#: Hashes of the end of a text and of what stands before its first word; words never have them but by accident.
END, START = np.uint64(0x0123456789ABCDEF), np.uint64(0xFEDCBA9876543210)


def held_out(doc_id: int | None) -> bool:
    return doc_id is not None and crc32(str(doc_id).encode()) % 7 == 2


def tokens(column: pa.ChunkedArray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(token, token before it, text) of all texts in order: each text's lower-cased words, then its end."""
    parts = []
    for at, buf, offsets in text_blocks(column):
        h, doc, _, _ = word_hashes(lower_bytes()[buf], offsets)
        n = len(offsets) - 1
        words = np.bincount(doc, minlength=n)
        out = np.empty(len(h) + n, np.uint64)
        whose = np.repeat(np.arange(n), words + 1)
        last = np.cumsum(words + 1) - 1
        out[last] = END
        inside = np.ones(len(out), np.bool_)
        inside[last] = False
        out[inside] = h
        before = np.empty_like(out)
        before[1:] = out[:-1]
        before[last - words] = START
        parts.append((out, before, whose + at))
    if not parts:
        return np.zeros(0, np.uint64), np.zeros(0, np.uint64), np.zeros(0, np.int64)
    return tuple(np.concatenate([p[i] for p in parts]) for i in range(3))


def pairs(before: np.ndarray, token: np.ndarray) -> np.ndarray:
    return mix(before * np.uint64(0x9E3779B97F4A7C15) + token)


def counted(values: np.ndarray, trained: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct values in ascending order and how often each occurs in training."""
    u, inverse = np.unique(values, return_inverse=True)
    return u, np.bincount(inverse, weights=trained, minlength=len(u)).astype(np.uint32)


def level(counts: np.ndarray) -> np.ndarray:
    return 1 + np.floor(np.log(np.maximum(counts, 1)) / np.log(BASE) + 1e-9).astype(np.int64)


def level_counts(levels: int) -> np.ndarray:
    """The count that a level stands for: the middle of its whole numbers; level 0 is 0."""
    low = np.ceil(BASE ** np.arange(levels) - 1e-9)
    high = np.maximum(low, np.ceil(BASE ** np.arange(1, levels + 1) - 1e-9) - 1)
    return np.concatenate([[0.0], (low + high) / 2])


def bits_of(grams: np.ndarray, at_level: np.ndarray | int, size: np.ndarray | int) -> Iterator[np.ndarray]:
    """The places of (n-gram, level) in a segment of ``size`` bits, one array a probe."""
    x = mix(grams + np.asarray(at_level).astype(np.uint64) * np.uint64(0xD6E8FEB86659FD93))
    a, b = x & np.uint64(0xFFFFFFFF), (x >> np.uint64(32)) | np.uint64(1)
    for k in range(PROBES):
        yield (((a + np.uint64(k) * b) & np.uint64(0xFFFFFFFF)) * np.asarray(size).astype(np.uint64)) >> np.uint64(32)


def segment(grams: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """One partition's part of the filter, as bytes."""
    q = level(counts)
    size = int(max(64, BITS * q.sum())) // 8 * 8
    bits = np.zeros(size, np.bool_)
    for j in range(1, int(q.max(initial=0)) + 1):
        for place in bits_of(grams[q >= j], j, size):
            bits[place] = True
    return np.packbits(bits, bitorder="little")


class LogFrequencyFilter:
    """Segments (of all partitions, or of one alone), and levels by probing them."""

    def __init__(self, sizes: list[int], data: bytes):
        self.parts = len(sizes)
        self.bits = np.array(sizes, np.uint64) * np.uint64(8)
        self.first = np.cumsum(self.bits) - self.bits
        self.data = np.frombuffer(data, np.uint8)

    def levels(self, grams: np.ndarray) -> np.ndarray:
        found = np.zeros(len(grams), np.int64)
        part = (grams % np.uint64(self.parts)).astype(np.int64)
        size, first = self.bits[part], self.first[part]
        alive = np.arange(len(grams))
        for j in range(1, 64):
            ok = np.ones(len(alive), np.bool_)
            for place in bits_of(grams[alive], j, size[alive]):
                p = place + first[alive]
                ok &= (self.data[(p >> np.uint64(3)).astype(np.int64)] >> (p & np.uint64(7)).astype(np.uint8) & 1).astype(np.bool_)
            alive = alive[ok]
            if not len(alive):
                break
            found[alive] = j
        return found.astype(np.uint8)


def gram_bytes(grams: np.ndarray) -> bytes:
    """A pair needs no exact identity: 40 bits beside those of its partition."""
    return (grams >> np.uint64(32)).astype(np.uint32).tobytes() + (grams >> np.uint64(24)).astype(np.uint8).tobytes()


def high_bits(data: bytes, n: int) -> np.ndarray:
    """The 40 bits that ``gram_bytes`` keeps of each of ``n`` pairs."""
    return np.frombuffer(data, np.uint32, n).astype(np.uint64) << np.uint64(8) | np.frombuffer(data, np.uint8, n, 4 * n)


def pair_keys(high: np.ndarray, part: np.ndarray | int, parts: int) -> np.ndarray:
    """What stands for a pair in the filter: its 40 high bits, spread so that it stays in its partition."""
    return mix(high) // np.uint64(parts) * np.uint64(parts) + np.asarray(part).astype(np.uint64)


def _count(parts: int, in_place: bool = False):
    """A chunk's distinct words and training pairs with their counts; ``in_place``: all its pairs."""

    def run(t: pa.Table) -> pa.Table:
        chunk = t.column("chunk")[0].as_py()
        token, before, doc = tokens(t.column("text"))
        trained = ~np.array([held_out(i) for i in t.column("doc_id").to_pylist()], np.bool_)[doc]
        words, n = counted(token, trained)
        told = trained | in_place
        two, n2 = counted(pairs(before, token)[told], trained[told])
        rows = [(chunk, p, "word", words[i].tobytes() + n[i].tobytes()) for p, i in by_part(words, parts)]
        rows += [(chunk, p, "pair", gram_bytes(two[i]) + n2[i].tobytes()) for p, i in by_part(two, parts)]
        return messages(rows)

    return run


def answered(kind: str, part: int, sources: list[tuple[int, int]], values: np.ndarray) -> list[tuple[int, int, str, bytes]]:
    """One message to each (chunk, number of values) with its share of ``values``, which are in that order."""
    ends = np.cumsum([n for _, n in sources], dtype=np.int64)
    return [(chunk, part, kind, values[end - n : end].tobytes()) for (chunk, n), end in zip(sources, ends)]


def joined(arrays: list[np.ndarray], kind: type) -> np.ndarray:
    return np.concatenate(arrays) if arrays else np.zeros(0, kind)


def _merge(parts: int, in_place: bool = False):
    """A partition's counts for every chunk, its statistics and its segment, or (``in_place``) the levels it gives."""

    def run(t: pa.Table) -> pa.Table:
        part = t.column("part")[0].as_py()
        rows, sources, pair_sources, hashes, counts, high, many = [], [], [], [], [], [], []
        for chunk, kind, data in zip(t.column("chunk").to_pylist(), t.column("kind").to_pylist(), t.column("data").to_pylist()):
            if kind == "word":
                n = len(data) // 12
                sources.append((chunk, n))
                hashes.append(np.frombuffer(data, np.uint64, n))
                counts.append(np.frombuffer(data, np.uint32, n, 8 * n))
            else:
                n = len(data) // 9
                pair_sources.append((chunk, n))
                high.append(high_bits(data, n))
                many.append(np.frombuffer(data, np.uint32, n, 5 * n))
        words, inverse = np.unique(joined(hashes, np.uint64), return_inverse=True)
        total = np.bincount(inverse, weights=joined(counts, np.uint32), minlength=len(words))
        rows += answered("count", part, sources, total.astype(np.uint64)[inverse])
        two, pair_inverse = np.unique(joined(high, np.uint64), return_inverse=True)
        total2 = np.bincount(pair_inverse, weights=joined(many, np.uint32), minlength=len(two))
        known, known2, keys = total > 0, total2 > 0, pair_keys(two, part, parts)
        own = segment(np.concatenate([words[known], keys[known2]]), np.concatenate([total[known], total2[known2]])).tobytes()
        if in_place:
            lookup = LogFrequencyFilter([len(own)], own)
            rows += answered("word level", part, sources, lookup.levels(words)[inverse])
            rows += answered("pair level", part, pair_sources, lookup.levels(keys)[pair_inverse])
        else:
            rows.append((-1, part, "filter", own))
        stats = [total.sum(), known.sum(), (total == 1).sum(), (total == 2).sum()]
        rows.append((-1, part, "stats", ",".join(str(int(x)) for x in stats).encode()))
        return messages(rows)

    return run


RESULT = "doc_id long, held_out boolean, n_tokens long, n_known long, train_tokens long, base_score double, score double"
_NAMES = [f.split()[0] for f in RESULT.split(", ")]
_TYPES = [pa.int64(), pa.bool_(), pa.int64(), pa.int64(), pa.int64(), pa.float64(), pa.float64()]


def told_to_all(merged: DataFrame, chunks: int) -> DataFrame:
    """The answers, with each partition's statistics for every chunk."""
    to = F.when(F.col("kind") == "stats", F.sequence(F.lit(0), F.lit(chunks - 1))).otherwise(F.array("chunk"))
    return merged.withColumn("chunk", F.explode(to))


def _score(parts: int, shared=None):
    """Scores of a chunk, by the ``shared`` filter and statistics or, without them, by those among its answers."""

    def run(docs: pa.Table, answers: pa.Table) -> pa.Table:
        if not docs.num_rows:  # statistics go to chunks without documents too
            return pa.Table.from_arrays([pa.array([], k) for k in _TYPES], _NAMES)
        if shared is not None:
            segments, (n, v, n1, n2) = shared.value
        else:
            stats = [x.decode().split(",") for k, x in zip(answers.column("kind").to_pylist(), answers.column("data").to_pylist()) if k == "stats"]
            segments, (n, v, n1, n2) = None, (sum(int(x[k]) for x in stats) for k in range(4))
        ids = docs.column("doc_id").to_pylist()
        token, before, doc = tokens(docs.column("text"))
        words, place = np.unique(token, return_inverse=True)
        by = {(k, p): x for k, p, x in zip(answers.column("kind").to_pylist(), answers.column("part").to_pylist(), answers.column("data").to_pylist())}
        exact = np.zeros(len(words))
        for p, i in by_part(words, parts):
            exact[i] = np.frombuffer(by["count", p], np.uint64)
        total = lambda x: np.bincount(doc, weights=x, minlength=len(ids))
        base = np.log10((exact + 1) / (n + v + 1))
        if n:
            value = level_counts(64)
            two, pair = np.unique(pairs(before, token), return_inverse=True)
            if segments:
                lookup = LogFrequencyFilter(*segments)
                word_level = lookup.levels(words)
                pair_level = lookup.levels(pair_keys(two >> np.uint64(24), (two % np.uint64(parts)).astype(np.int64), parts))
            else:
                word_level, pair_level = np.zeros(len(words), np.uint8), np.zeros(len(two), np.uint8)
                for kind, grams, out in (("word level", words, word_level), ("pair level", two, pair_level)):
                    for p, i in by_part(grams, parts):
                        out[i] = np.frombuffer(by[kind, p], np.uint8)
            approximate = value[word_level]
            discount = n1 / (n1 + 2 * n2) if n1 and n2 else 0.5
            single = np.where(approximate > 0, np.maximum(approximate - discount, 0.1) / n, discount * v / n)
            # what stands before a word is a word of the chunk, or the start: as many texts begin as end
            at = np.minimum(np.searchsorted(words, before), len(words) - 1)
            c = np.where(before == START, approximate[words == END][0], approximate[at])
            p = single[place]
            p = np.where(c > 0, (1 - PAIR_WEIGHT) * p + PAIR_WEIGHT * np.minimum(value[pair_level][pair] / np.maximum(c, 1), 1), p)
            logs = np.log10(np.minimum(p, 1))
        else:
            logs = np.zeros(len(token))
        columns = [ids, [held_out(i) for i in ids], total(np.ones(len(token))), total(exact[place] > 0), np.full(len(ids), n), total(base[place]), total(logs)]
        columns = [pa.array(x if isinstance(x, list) else x.astype(k.to_pandas_dtype()), k) for x, k in zip(columns, _TYPES)]
        return pa.Table.from_arrays(columns, _NAMES)

    return run


def score(docs: DataFrame, filter_bytes: int = FILTER_BYTES) -> DataFrame:
    """The contract's rows: exact add-one unigram score and the model's log10 probability of every text."""
    spark = docs.sparkSession
    d, n = chunked(docs, CHUNK)
    parts, mine = max(min(n, FEW_PARTS), -(-n // CHUNKS_A_PART)), d.groupBy("chunk")
    # at most every second byte is a word: two n-grams each, of levels no higher than their counts, BITS bits a level
    in_place = n * CHUNK * BITS // 8 > filter_bytes
    merged = mine.applyInArrow(_count(parts, in_place), MESSAGE).repartition(parts, "part").groupBy("part").applyInArrow(_merge(parts, in_place), MESSAGE)
    if in_place:
        # dealt like the documents, whose shuffle is read by both sides
        return mine.cogroup(told_to_all(merged, n).repartition(n, "chunk").groupBy("chunk")).applyInArrow(_score(parts), RESULT)
    merged = cut_lineage(merged)
    numbers = F.split(F.decode("data", "UTF-8"), ",")
    row = merged.where("kind = 'stats'").agg(*[F.coalesce(F.sum(numbers[k].cast("bigint")), F.lit(0)).alias(f"s{k}") for k in range(4)]).first()
    own = {r["part"]: bytes(r["data"]) for r in merged.where("kind = 'filter'").select("part", "data").toLocalIterator()}
    own = [own.get(p, bytes(8)) for p in range(parts)]
    shared = spark.sparkContext.broadcast((([len(s) for s in own], b"".join(own)), tuple(int(x) for x in row)))
    return mine.cogroup(merged.where("chunk >= 0").groupBy("chunk")).applyInArrow(_score(parts, shared), RESULT)
