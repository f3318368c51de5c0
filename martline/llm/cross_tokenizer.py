"""Alignment of two tokenizers' tokens over all documents, each distinct text tokenised once.

Method. Texts are shuffled by their full text, so copies meet and one of them, with its multiplicity, is tokenised by
a byte-level BPE (A, on space + text) and a sentence-piece BPE (B, which adds that space). Byte offsets where tokens
of both end cut the tokens into groups; a link is a pair of tokens whose byte ranges overlap. An id pair's count is
the number of documents that hold it linked: each distinct text adds its multiplicity. Measures of a text are joined back to the
doc_ids by the SHA-256 of the text.

Inside a task texts are cut into words where neither tokenizer's tokens cross (a space after a character that is
no space, before one that is no white space), and a word's alignment is kept for the next time it is met.

Scale. Partial aggregation drops copies before the shuffle, so a text that a third of all documents hold is one row a
map task. Distinct texts are worked on in blocks of about ``BLOCK`` bytes, stored once in the shared checkpoint folder. A block
sends each distinct id pair once, with its number of documents, to the partition of the pair's hash, and gets the pair's
total back in the order sent; a partition holds about ``PART_BYTES`` of such entries, whatever the input's size.
Broadcast is one number for each id of A: the highest count of its pairs. Joining back to doc_ids is a left
join whose document side, hot texts included, AQE splits.

Defined cases: NULL and empty texts, and texts whose joined A or B bytes differ from space + text (as with U+2581, which
B cannot tell from a space), have no tokens: zeros, and an empty string for the digest of groups; a very long text is a block of its own
and takes memory in proportion to itself; rows sharing an id, repeated rows and NULL ids are reported each for itself and
each counts as a document; other columns are ignored; an empty table gives an empty result.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from zstandard import ZstdCompressor, ZstdDecompressor

from martline.llm.chunks import by_part
from martline.llm.hashing import mix, text_blocks
from martline.llm.subwords import SPACE, Known, byte_bpe, cut_parts, ragged
from martline.session import cut_lineage

BLOCK = 2 << 20
KNOWN_PARTS = 150_000
#: New words aligned at a time.
LEARNT = 1 << 15
PART_BYTES = 32 << 20
#: One number a text, then one array a block; all as compressed binary.
_PER_TEXT = ("copies", "n_a", "n_b", "n_groups", "n_links")
_ARRAYS = (*_PER_TEXT, "digest", "groups", "n_parts", "part", "part_links", "link", "pair", "pair_docs")
_MEASURED = tuple(k for k in _ARRAYS if k not in ("copies", "pair_docs"))
BLOCKS = "block long, n_pairs long, " + ", ".join(f"{name} binary" for name in _ARRAYS)
ENTRY = "block long, part int, data binary"
MEASURES = "digest binary, n_a long, n_b long, n_groups long, n_links long, n_best long, count_sum long, groups_sha256 string"
COUNTS = ("n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum")
_loaded: dict[str, "PieceBpe"] = {}
_words: dict[tuple[str, str], "Words"] = {}


class PieceBpe:
    """A sentence-piece file whose pieces have spaces only in front, so that words can be encoded alone."""

    def __init__(self, path: str):
        from sentencepiece import SentencePieceProcessor

        model = SentencePieceProcessor(model_file=path)
        self.encode = model.encode
        names = [model.id_to_piece(i) for i in range(model.get_piece_size())]
        self.alone = not any(re.search("[^▁]▁", n) for n in names)
        byte = re.compile("<0x([0-9A-F]{2})>").fullmatch
        self.token_bytes = [bytes([int(m[1], 16)]) if (m := byte(n)) else n.replace("▁", " ").encode() for n in names]


def piece_bpe(path: str) -> PieceBpe:
    if path not in _loaded:
        _loaded[path] = PieceBpe(path)
    return _loaded[path]


def sums(values: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """The sum of each run of ``values``, the runs having ``counts`` members."""
    total = np.concatenate([np.zeros(1, np.int64), np.cumsum(values, dtype=np.int64)])
    ends = np.cumsum(counts)
    return total[ends] - total[ends - counts]


def distinct(values: np.ndarray) -> np.ndarray:
    values = np.sort(values)
    return values[np.flatnonzero(np.diff(values, prepend=values[:1] - 1))] if len(values) else values


def pair_type(n_a: int, n_b: int) -> type:
    return np.uint32 if n_a * n_b < 1 << 32 else np.uint64


class Words(Known):
    """The alignment of every word met so far: its numbers, its groups as text, and its links."""

    def __init__(self, path_a: str, path_b: str):
        super().__init__(KNOWN_PARTS)
        self.a, self.b = byte_bpe(path_a), piece_bpe(path_b)
        self.length_a, self.length_b = (np.array([len(t) for t in x.token_bytes]) for x in (self.a, self.b))
        self.numbers = np.zeros((5, 0), np.int64)  # tokens of A and B, groups, links, 1 if bytes are lost
        self.groups: list[bytes] = []
        self.links = np.zeros(0, pair_type(len(self.length_a), len(self.length_b)))

    def learn(self, parts: list[bytes]) -> None:
        for at in range(0, len(parts), LEARNT):
            self._learn(parts[at : at + LEARNT])

    def _learn(self, parts: list[bytes]) -> None:
        ids_a, n_a = self.a.encode_parts(parts)
        pieces = self.b.encode([p[1:].decode("utf-8", "replace") for p in parts], num_threads=1)
        n_b = np.fromiter(map(len, pieces), np.int64, len(pieces))
        ids_b = np.fromiter(chain.from_iterable(pieces), np.uint32, int(n_b.sum()))
        whole_a = self._same(parts, [self.a.token_bytes[i] for i in ids_a.tolist()], n_a)
        ok = whole_a & self._same(parts, [self.b.token_bytes[i] for i in ids_b.tolist()], n_b)
        ids_a, ids_b = ids_a[np.repeat(ok, n_a)], ids_b[np.repeat(ok, n_b)]
        n_a, n_b = n_a * ok, n_b * ok
        end_a, end_b = np.cumsum(self.length_a[ids_a]), np.cumsum(self.length_b[ids_b])
        part_end = np.cumsum(np.fromiter(map(len, parts), np.int64, len(parts)) * ok)
        size = int(part_end[-1]) if len(part_end) else 0
        cut_a, cut_b = np.zeros(size + 1, np.bool_), np.zeros(size + 1, np.bool_)
        cut_a[end_a], cut_b[end_b] = True, True
        segment, common = np.flatnonzero(cut_a | cut_b), np.flatnonzero(cut_a & cut_b)
        # a stretch between neighbouring ends lies in one token of each: one link
        a, b = ids_a[np.searchsorted(end_a, segment)], ids_b[np.searchsorted(end_b, segment)]
        links = a.astype(np.int64) * len(self.length_b) + b
        whose = lambda ends: np.bincount(np.searchsorted(part_end, ends), minlength=len(parts))
        self.numbers = np.concatenate([self.numbers, np.stack([n_a, n_b, whose(common), whose(segment), ~ok])], axis=1)
        self.links = np.concatenate([self.links, links.astype(self.links.dtype)])
        # tokens by group, A before B; what stands after a token tells what comes next
        group = np.concatenate([2 * np.searchsorted(common, end_a), 2 * np.searchsorted(common, end_b) + 1])
        order = np.argsort(group, kind="stable")
        group, names = group[order], np.concatenate([ids_a, ids_b])[order].tolist()
        step = np.diff(group, append=-1)
        after = np.where(step == 0, 0, np.where(group % 2 == 0, 1, 2)).tolist()
        ends = (",", "|", ";")
        text = [f"{i}{ends[s]}" for i, s in zip(names, after)]
        bounds = np.cumsum(n_a + n_b).tolist()
        self.groups += ["".join(text[x:y])[:-1].encode() for x, y in zip([0, *bounds], bounds)]

    @staticmethod
    def _same(parts: list[bytes], tokens: list[bytes], n: np.ndarray) -> np.ndarray:
        if b"".join(tokens) == b"".join(parts) and np.array_equal(sums(np.fromiter(map(len, tokens), np.int64, len(tokens)), n), [len(p) for p in parts]):
            return np.ones(len(parts), np.bool_)
        bounds = np.cumsum(n).tolist()
        return np.array([b"".join(tokens[x:y]) == p for p, x, y in zip(parts, [0, *bounds], bounds)], np.bool_)


def known_words(path_a: str, path_b: str) -> Words:
    """The worker's words, begun anew when it holds more than ``KNOWN_PARTS``."""
    key = (path_a, path_b)
    if key not in _words or _words[key].full():
        _words[key] = Words(path_a, path_b)
    return _words[key]


def align(words: Words, buf: np.ndarray, offsets: np.ndarray, copies: np.ndarray) -> tuple[int, dict[str, bytes]]:
    """How many distinct pairs a block has, and its arrays: measures of its texts, their words, the words' links, the pairs."""
    n = len(offsets) - 1
    spaced, at = np.insert(buf, offsets[:-1], SPACE), offsets + np.arange(n + 1)
    start, end, text = cut_parts(spaced, at, runs_whole=True)
    used, part = np.unique(words.slots(spaced, start, end, words.learn), return_inverse=True)
    n_parts = np.bincount(text, minlength=n)
    numbers = np.stack([sums(row[used][part], n_parts) for row in words.numbers])
    good = (numbers[4] == 0) & (n_parts > 0)
    data = buf.tobytes()
    digest = b"".join(hashlib.sha256(data[a:b]).digest() for a, b in zip(offsets.tolist(), offsets[1:].tolist()))
    names, bounds, slots = words.groups, np.cumsum(n_parts).tolist(), used[part].tolist()
    shas = [hashlib.sha256(b";".join([names[s] for s in slots[a:b]])).digest() if ok else bytes(32) for a, b, ok in zip([0, *bounds], bounds, good.tolist())]
    part, n_parts = part[good[text]], n_parts * good
    text = text[good[text]]
    first = (np.cumsum(words.numbers[3]) - words.numbers[3])[used]
    part_links = words.numbers[3][used]
    pair, link = np.unique(words.links[ragged(first, part_links)], return_inverse=True)
    # documents of each pair: distinct words of each text, then distinct pairs
    cell = distinct(text * max(1, len(used)) + part)
    whose, word = cell // max(1, len(used)), cell % max(1, len(used))
    link_at = np.cumsum(part_links) - part_links
    held = distinct(np.repeat(whose, part_links[word]) * max(1, len(pair)) + link[ragged(link_at[word], part_links[word])])
    order = np.argsort(held % max(1, len(pair)), kind="stable")
    docs = sums(copies[held[order] // max(1, len(pair))], np.bincount(held % max(1, len(pair)), minlength=len(pair)))
    arrays = {name: np.where(good, row, 0) for name, row in zip(COUNTS, numbers)}
    arrays |= {"copies": copies, "n_parts": n_parts, "part": part.astype(np.int32), "part_links": part_links.astype(np.int32), "link": link.astype(np.int32), "pair": pair, "pair_docs": docs}
    arrays = {k: x.astype(np.int64).tobytes() if k in _PER_TEXT else x.tobytes() for k, x in arrays.items()}
    squeeze = ZstdCompressor(level=1).compress
    return len(pair), {k: squeeze(x) for k, x in arrays.items()} | {"digest": digest, "groups": b"".join(shas)}


def array(data: bytes, kind: type) -> np.ndarray:
    return np.frombuffer(ZstdDecompressor().decompress(data), kind)


def _align(path_a: str, path_b: str):
    names = ["block", "n_pairs", *_ARRAYS]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        if not piece_bpe(path_b).alone:
            raise ValueError(f"{path_b} has pieces with a space after another character")
        block = TaskContext.get().partitionId() << 32
        for b in batches:
            copies = b.column(1).to_numpy()
            for at, buf, offsets in text_blocks(b.column(0), BLOCK):
                n_pairs, out = align(known_words(path_a, path_b), buf, offsets, copies[at : at + len(offsets) - 1])
                yield pa.RecordBatch.from_arrays([pa.array([block], pa.int64()), pa.array([n_pairs], pa.int64()), *(pa.array([out[k]], pa.binary()) for k in _ARRAYS)], names)
                block += 1

    return run


def entries(rows: list[tuple[int, int, bytes]]) -> pa.Table:
    types = {"block": pa.int64(), "part": pa.int32(), "data": pa.binary()}
    return pa.table({k: pa.array([r[i] for r in rows], t) for i, (k, t) in enumerate(types.items())})


def _send(parts: int, kind: type):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for block, pair, docs in zip(*(c.to_pylist() for c in b.columns)):
                pair, docs = array(pair, kind), array(docs, np.int64)
                rows = [(block, p, pair[i].tobytes() + docs[i].tobytes()) for p, i in by_part(mix(pair.astype(np.uint64)), parts)]
                yield from entries(rows).to_batches()

    return run


def _total(kind: type, n_b: int):
    """A partition's pairs summed over the blocks: each block's totals, and as block -1 the highest count of every A id."""
    width = np.dtype(kind).itemsize + 8

    def run(t: pa.Table) -> pa.Table:
        part, blocks, data = t.column("part")[0].as_py(), t.column("block").to_pylist(), t.column("data").to_pylist()
        n = [len(x) // width for x in data]
        pair, which = np.unique(np.concatenate([np.frombuffer(x, kind, k) for x, k in zip(data, n)]), return_inverse=True)
        docs = np.concatenate([np.frombuffer(x, np.int64, k, k * (width - 8)) for x, k in zip(data, n)])
        total = np.zeros(len(pair), np.int64)
        np.add.at(total, which, docs)
        answer = total[which]
        ends = np.cumsum(n)
        rows = [(block, part, answer[e - k : e].tobytes()) for block, k, e in zip(blocks, n, ends.tolist())]
        a, first = np.unique(pair.astype(np.int64) // n_b, return_index=True)
        rows.append((-1, part, a.tobytes() + np.maximum.reduceat(total, first).tobytes()))
        return entries(rows)

    return run


def _highest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in batches:
        for data in b.column(0).to_pylist():
            both = np.frombuffer(data, np.int64).reshape(2, -1)
            yield pa.RecordBatch.from_arrays([pa.array(both[0]), pa.array(both[1])], ["a", "n"])


def _measure(shared, parts: int, kind: type, n_b: int):
    names = [f.split()[0] for f in MEASURES.split(", ")]

    def run(block: pa.Table, answers: pa.Table) -> pa.Table:
        row = {k: block.column(k)[0].as_py() for k in _MEASURED}
        pair = array(row["pair"], kind)
        count = np.zeros(len(pair), np.int64)
        found = dict(zip(answers.column("part").to_pylist(), answers.column("data").to_pylist()))
        for p, i in by_part(mix(pair.astype(np.uint64)), parts):
            count[i] = np.frombuffer(found[p], np.int64)
        best = count == shared.value[pair.astype(np.int64) // n_b]
        link, per_part = array(row["link"], np.int32), array(row["part_links"], np.int32).astype(np.int64)
        part, n_parts = array(row["part"], np.int32), array(row["n_parts"], np.int64)
        of_text = [sums(sums(x[link], per_part)[part], n_parts) for x in (best, count)]
        counts = [array(row[k], np.int64) for k in COUNTS[:4]]
        cut = lambda data: [data[i : i + 32] for i in range(0, len(data), 32)]
        shas = [g.hex() if n else "" for g, n in zip(cut(row["groups"]), counts[0].tolist())]
        columns = [pa.array(cut(row["digest"]), pa.binary()), *(pa.array(c, pa.int64()) for c in counts + of_text), pa.array(shas, pa.string())]
        return pa.Table.from_arrays(columns, names)

    return run


def aligned_texts(texts: DataFrame, path_a: str, path_b: str) -> DataFrame:
    """``MEASURES`` of each distinct text of (text, copies)."""
    spark = texts.sparkSession
    blocks = cut_lineage(texts.mapInArrow(_align(path_a, path_b), BLOCKS))
    n_a, n_b = len(byte_bpe(path_a).token_bytes), len(piece_bpe(path_b).token_bytes)
    kind = pair_type(n_a, n_b)
    entries = blocks.agg(F.coalesce(F.sum("n_pairs"), F.lit(0)).alias("n")).first()["n"]
    parts = max(1, -(-entries * (np.dtype(kind).itemsize + 8) // PART_BYTES))
    sent = blocks.select("block", "pair", "pair_docs").mapInArrow(_send(parts, kind), ENTRY)
    totals = cut_lineage(sent.groupBy("part").applyInArrow(_total(kind, n_b), ENTRY))
    top = totals.where("block = -1").select("data").mapInArrow(_highest, "a long, n long").groupBy("a").agg(F.max("n").alias("n"))
    highest = np.zeros(n_a, np.int64)
    for r in top.collect():  # one row an id of A at most
        highest[r["a"]] = r["n"]
    shared = spark.sparkContext.broadcast(highest)
    answers = totals.where("block >= 0")
    return blocks.select("block", *_MEASURED).groupBy("block").cogroup(answers.groupBy("block")).applyInArrow(_measure(shared, parts, kind, n_b), MEASURES)


def cross_tokenizer(docs: DataFrame, path_a: str, path_b: str) -> DataFrame:
    """One row per document: its tokens, groups and links, and what the corpus says of its links (the contract's columns).

    ``path_a`` and ``path_b`` are a byte-level BPE file and a sentence-piece file, the same on all machines.
    """
    docs = docs.select(F.col("doc_id").cast("long"), "text")
    texts = docs.where("text <> ''").groupBy("text").agg(F.count(F.lit(1)).alias("copies"))
    measures = aligned_texts(texts, path_a, path_b)
    own = docs.select("doc_id", F.unhex(F.sha2("text", 256)).alias("digest"))
    found = own.join(measures, "digest", "left")
    return found.select("doc_id", *[F.coalesce(c, F.lit(0)).cast("long").alias(c) for c in COUNTS], F.coalesce("groups_sha256", F.lit("")).alias("groups_sha256"))
