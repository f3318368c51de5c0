"""Language identification with interpolated Kneser-Ney character models in sorted hash arrays.

Method. A text is lower-cased and mapped to letters and spaces. Each language has a character model of order
``ORDER``: raw counts at the top, continuation counts below, one discount an order, interpolated down to the
uniform distribution. n-grams are packed into integers (a hash without collisions: eight bits a character) and
kept in sorted arrays, looked up by binary search. A text gets the language of the lowest cross-entropy per
character. ``rejected`` marks texts that no model explains as well as it explains its own training texts
(calibrated on them); the contract's query still names the best language for those.

Scale. Models are fitted on at most ``DOCS_PER_LANGUAGE`` documents a language (documented bound), chosen by hash
of the id; n-grams are counted on the executors, summed by Spark, and only the bounded counts come to the driver.
Scoring is one pass over all whole texts without a shuffle: a block's n-grams are sorted, each distinct one is
looked up once, and its value is added to every document that has it.

Defined cases: NULL text and text without a letter give ``und`` with score 0; without training rows all do;
ties go to the first language by code point; NULL languages are not learned; repeated rows are scored one by one;
other columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from martline.llm.quality_classifier import remainder
from martline.session import cut_lineage

ORDER = 4
DOCS_PER_LANGUAGE = 400
BLOCK_CHARS = 1 << 20
#: Characters that count as evidence for the score (further ones would only push it to 0 or 1).
EVIDENCE = 40
SPACE, OTHER, FIRST = 1, 0, 2


def letters_table() -> np.ndarray:
    """For every code point: is it a letter?"""
    return np.fromiter((chr(i).isalpha() for i in range(0x110000)), np.bool_, 0x110000)


def code_points(text: str) -> np.ndarray:
    return np.frombuffer(text.lower().encode("utf-32-le", "surrogatepass"), np.uint32)


def alphabet_table(counts: dict[int, int], letters: np.ndarray) -> np.ndarray:
    """Code point -> symbol: the most frequent letters have their own, other letters share one, the rest is space."""
    table = np.where(letters, OTHER, SPACE).astype(np.uint8)
    for k, c in enumerate(sorted(counts, key=lambda c: (-counts[c], c))[: 256 - FIRST]):
        table[c] = FIRST + k
    return table


def packed_ngrams(texts: list[str], table: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(n-gram ending at each symbol, its text, symbols a text) with runs of spaces collapsed, contexts padded by space."""
    parts = [code_points(t) for t in texts]
    lengths = np.array([len(p) for p in parts], np.int64)
    ids = table[np.concatenate(parts)] if lengths.sum() else np.zeros(0, np.uint8)
    doc = np.repeat(np.arange(len(texts), dtype=np.int64), lengths)
    if len(ids):
        same_doc = np.concatenate([[False], doc[1:] == doc[:-1]])
        space = ids == SPACE
        keep = ~(space & np.concatenate([[False], space[:-1]]) & same_doc)
        ids, doc = ids[keep], doc[keep]
    n = np.bincount(doc, minlength=len(texts))
    offset = np.arange(len(ids)) - np.repeat(np.cumsum(n) - n, n)
    key = ids.astype(np.uint32)
    for back in range(1, ORDER):
        before = np.full(len(ids), SPACE, np.uint32)
        before[back:] = np.where(offset[back:] >= back, ids[: len(ids) - back], SPACE) if len(ids) > back else before[back:]
        key |= before << np.uint32(8 * back)
    return key, doc, n


def summed(keys: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    unique, inverse = np.unique(keys, return_inverse=True)
    return unique, np.bincount(inverse, weights=counts, minlength=len(unique))


class KneserNey:
    """One language's model: for each order sorted n-grams with their discounted share, sorted contexts with their weight."""

    def __init__(self, keys: np.ndarray, counts: np.ndarray):
        self.orders = []
        keys, counts = summed(keys, counts)
        for n in range(ORDER, 0, -1):
            ones, twos = (counts == 1).sum(), (counts == 2).sum()
            discount = ones / (ones + 2 * twos) if ones and twos else 0.5
            contexts, which = np.unique(keys >> np.uint32(8), return_inverse=True)
            total = np.bincount(which, weights=counts, minlength=len(contexts))
            share = np.maximum(counts - discount, 0) / total[which]
            weight = discount * np.bincount(which, minlength=len(contexts)) / total
            self.orders.append((n, keys, share, contexts, weight))
            # continuation counts: in how many contexts one longer does the shorter n-gram occur
            mask = np.uint32((1 << (8 * (n - 1))) - 1)
            keys, counts = summed(keys & mask, np.ones(len(keys)))
        self.orders.reverse()

    def log_prob(self, keys: np.ndarray) -> np.ndarray:
        p = np.full(len(keys), 1 / 256)
        for n, grams, share, contexts, weight in self.orders:
            part = keys & np.uint32((1 << (8 * n)) - 1) if n < 4 else keys
            context = part >> np.uint32(8)
            at = np.minimum(np.searchsorted(contexts, context), len(contexts) - 1)
            known = contexts[at] == context
            g = np.minimum(np.searchsorted(grams, part), len(grams) - 1)
            p = np.where(known, np.where(grams[g] == part, share[g], 0) + weight[at] * p, p)
        return np.log(p)


def entropies(texts: list[str], table: np.ndarray, models: list[KneserNey]) -> tuple[np.ndarray, np.ndarray]:
    """(cross-entropy of each text under each model, symbols a text)."""
    key, doc, n = packed_ngrams(texts, table)
    order = np.sort(key.astype(np.uint64) << np.uint64(32) | doc.astype(np.uint64))
    key, doc = (order >> np.uint64(32)).astype(np.uint32), (order & np.uint64(0xFFFFFFFF)).astype(np.int64)
    new = np.flatnonzero(np.concatenate([[True], key[1:] != key[:-1]])) if len(key) else np.zeros(0, np.int64)
    runs = np.diff(np.append(new, len(key)))
    out = np.zeros((len(texts), len(models)))
    for j, m in enumerate(models):
        if len(key):
            out[:, j] = -np.bincount(doc, weights=np.repeat(m.log_prob(key[new]), runs), minlength=len(texts))
    return out / np.maximum(n, 1)[:, None], n


def blocks(texts: list[str]) -> Iterator[tuple[int, list[str]]]:
    """Consecutive texts of about BLOCK_CHARS characters together, with the place of the first."""
    at, size = 0, 0
    for i, t in enumerate(texts):
        if size and size + len(t) > BLOCK_CHARS:
            yield at, texts[at:i]
            at, size = i, 0
        size += len(t)
    if texts:
        yield at, texts[at:]


def _letter_counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    letters = letters_table()
    for b in batches:
        for _, part in blocks([t or "" for t in b.column(b.schema.get_field_index("text")).to_pylist()]):
            c = code_points("".join(part))
            u, n = np.unique(c[letters[np.minimum(c, 0x10FFFF)]], return_counts=True)
            yield pa.RecordBatch.from_arrays([pa.array(u.astype(np.int64)), pa.array(n.astype(np.int64))], ["c", "n"])


def _ngram_counts(shared):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = shared.value
        for b in batches:
            by_lang: dict[str, list[str]] = {}
            for lang, text in zip(b.column(0).to_pylist(), b.column(1).to_pylist()):
                by_lang.setdefault(lang, []).append(text or "")
            for lang, texts in by_lang.items():
                for _, part in blocks(texts):
                    u, n = np.unique(packed_ngrams(part, table)[0], return_counts=True)
                    yield pa.RecordBatch.from_arrays([pa.array([lang] * len(u), pa.string()), pa.array(u.astype(np.int64)), pa.array(n.astype(np.int64))], ["lang", "k", "n"])

    return run


def training_rows(docs: DataFrame, docs_per_language: int = DOCS_PER_LANGUAGE) -> DataFrame:
    """(lang, text): at most ``docs_per_language`` documents of each language that are not held out."""
    rows = docs.where("lang is not null and doc_id is not null").where(remainder(F.col("doc_id"), 4) != 2)
    pick = Window.partitionBy("lang").orderBy(F.xxhash64("doc_id"), "doc_id")
    ids = rows.select("lang", "doc_id").distinct().withColumn("k", F.row_number().over(pick)).where(F.col("k") <= docs_per_language)
    ids = cut_lineage(ids.select(F.col("doc_id").alias("t_id"), F.col("lang").alias("t_lang")))
    return cut_lineage(rows.join(F.broadcast(ids), (F.col("doc_id") == F.col("t_id")) & (F.col("lang") == F.col("t_lang"))).select("lang", "text"))


def fit(docs: DataFrame, docs_per_language: int = DOCS_PER_LANGUAGE) -> dict:
    """Letters, models and rejection limits, from a bounded sample."""
    sc = docs.sparkSession.sparkContext
    rows = training_rows(docs, docs_per_language)
    letters = rows.mapInArrow(_letter_counts, "c long, n long").groupBy("c").agg(F.sum("n").alias("n")).toPandas()
    table = alphabet_table(dict(zip(letters["c"].tolist(), letters["n"].tolist())), letters_table())
    counts = rows.mapInArrow(_ngram_counts(sc.broadcast(table)), "lang string, k long, n long").groupBy("lang", "k").agg(F.sum("n").alias("n")).toPandas()
    langs = sorted(counts["lang"].unique().tolist(), key=lambda x: x.encode())
    models = [KneserNey(c["k"].to_numpy(np.uint32), c["n"].to_numpy(np.float64)) for c in (counts[counts["lang"] == x] for x in langs)]
    limits = [1.25 * float(np.sum(-m.log_prob(c["k"].to_numpy(np.uint32)) * c["n"]) / c["n"].sum()) for m, c in ((m, counts[counts["lang"] == x]) for m, x in zip(models, langs))]
    return {"langs": langs, "table": table, "models": models, "limits": limits}


def _predictor(shared):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m, letters = shared.value, letters_table()
        for b in batches:
            texts = [t or "" for t in b.column(b.schema.get_field_index("text")).to_pylist()]
            best, score, rejected = [], [], []
            for _, part in blocks(texts):
                has = [bool(letters[code_points(t)].any()) for t in part]
                if not m["langs"]:
                    best, score, rejected = best + ["und"] * len(part), score + [0.0] * len(part), rejected + [True] * len(part)
                    continue
                h, n = entropies(part, m["table"], m["models"])
                w = np.exp(-(h - h.min(axis=1, keepdims=True)) * np.minimum(n, EVIDENCE)[:, None])
                pick = h.argmin(axis=1)
                p = w[np.arange(len(part)), pick] / w.sum(axis=1)
                best += [m["langs"][k] if ok else "und" for k, ok in zip(pick, has)]
                score += [float(x) if ok else 0.0 for x, ok in zip(p, has)]
                rejected += [not ok or bool(h[i, k] > m["limits"][k]) for i, (k, ok) in enumerate(zip(pick, has))]
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(best, pa.string()), pa.array(score, pa.float64()), pa.array(rejected, pa.bool_())], ["doc_id", "lang_pred", "score", "rejected"])

    return run


def identify(docs: DataFrame, model: dict) -> DataFrame:
    """(doc_id, lang_pred, score, rejected) of every row."""
    shared = docs.sparkSession.sparkContext.broadcast(model)
    return docs.select("doc_id", "text").mapInArrow(_predictor(shared), "doc_id long, lang_pred string, score double, rejected boolean")


def language_id(docs: DataFrame) -> DataFrame:
    """The contract's rows."""
    out = identify(docs, fit(docs))
    held = F.coalesce(remainder(F.col("doc_id"), 4) == 2, F.lit(False))
    return out.select("doc_id", held.alias("held_out"), "lang_pred", "score", "rejected")
