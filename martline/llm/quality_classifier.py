"""Quality classifier: averaged subword embeddings with a softmax output, trained by numpy gradient descent.

Method. A document is the average of learned vectors of its words and of the character n-grams of its words
(hashed into ``BUCKETS`` rows; a word equal to the one before it adds the features of the pseudo-word
``REPEAT``), followed by a softmax over the two labels. Vectors and output weights are trained
together by stochastic gradient descent, one document a step. As the output is linear in the average, a trained
model is folded into one number a bucket for scoring; the scores are the same.

Scale. The training set is a sample of at most ``SAMPLE_ROWS`` labelled rows (documented bound), chosen by hash
of the id; executors turn whole texts into sparse features and the driver trains on those. Scoring is one pass
over all whole texts without a shuffle. Each Python worker caches the sums of words it has met, within a bound.

Defined cases: NULL and empty texts have no features and get the score of the bias; NULL labels and NULL ids of
labels are not trained on; without labels every score is 0.5; repeated rows are scored one by one; ids labelled
more than once give one example for each label; other columns are untouched.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator
from operator import eq
from zlib import crc32

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from martline.llm.common import unclashed
from martline.session import cut_lineage

BUCKETS, DIM, EPOCHS, RATE = 1 << 16, 16, 6, 0.5
NGRAMS = (3, 4)
SAMPLE_ROWS = 3000
CACHE_WORDS = 300_000
#: A pseudo-word with a space, so that no word of a text is equal to it.
REPEAT = "again again"


def remainder(doc_id: Column, modulus: int) -> Column:
    return F.crc32(doc_id.cast("string").cast("binary")) % modulus


def features(word: str) -> list[int]:
    """Buckets of a word and of its character n-grams with boundary marks."""
    padded = f"<{word}>"
    out = [crc32(padded.encode("utf-8", "surrogatepass")) % BUCKETS]
    for n in NGRAMS:
        out += [crc32(padded[i : i + n].encode("utf-8", "surrogatepass"), n) % BUCKETS for i in range(len(padded) - n + 1)]
    return out


def sparse(text: str | None) -> tuple[np.ndarray, np.ndarray]:
    """Distinct buckets of a whole text and their shares of its features."""
    counts: Counter = Counter()
    words = (text or "").split()
    tally = Counter(words)
    if repeats := sum(map(eq, words, words[1:])):
        tally[REPEAT] = repeats
    for word, n in tally.items():
        for f in features(word):
            counts[f] += n
    idx = np.fromiter(counts, np.int32, len(counts))
    weight = np.fromiter(counts.values(), np.float32, len(counts))
    return idx, weight / max(weight.sum(), 1)


def _featurise(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in batches:
        for doc_id, label, text in zip(*(b.column(i).to_pylist() for i in range(3))):
            idx, weight = sparse(text)
            yield pa.RecordBatch.from_arrays([pa.array([doc_id], pa.int64()), pa.array([label], pa.int32()), pa.array([idx.tobytes()], pa.binary()), pa.array([weight.tobytes()], pa.binary())], ["doc_id", "label", "idx", "weight"])


def train(examples: list[tuple[int, np.ndarray, np.ndarray]], epochs: int = EPOCHS, rate: float = RATE, seed: int = 0) -> tuple[np.ndarray, float]:
    """(number a bucket, bias) of the trained model, folded to the logit of label 1."""
    rng = np.random.default_rng(seed)
    emb = (rng.random((BUCKETS, DIM), dtype=np.float32) - 0.5) / DIM
    out, bias = np.zeros((2, DIM), np.float32), np.zeros(2, np.float32)
    steps, step = max(1, epochs * len(examples)), 0
    for _ in range(epochs):
        for k in rng.permutation(len(examples)):
            label, idx, weight = examples[k]
            lr = rate * (1 - step / steps)
            step += 1
            vectors = emb[idx]
            x = weight @ vectors if len(idx) else np.zeros(DIM, np.float32)
            z = out @ x + bias
            p = np.exp(z - z.max())
            p /= p.sum()
            p[label] -= 1
            grad = p @ out
            out -= lr * np.outer(p, x)
            bias -= lr * p
            if len(idx):
                # a vector's gradient is its share of the average; scaled to the average's size, as each word is a step
                emb[idx] = vectors - np.outer(lr * weight * min(len(idx), 50), grad)
    return emb @ (out[1] - out[0]), float(bias[1] - bias[0])


def training_rows(docs: DataFrame, labels: DataFrame, sample_rows: int = SAMPLE_ROWS) -> DataFrame:
    """(doc_id, label, text): at most ``sample_rows`` labelled rows that are not held out, by hash of the id."""
    rows = labels.where("doc_id is not null and quality is not null").where(remainder(F.col("doc_id"), 3) != 1)
    rows = rows.select(F.col("doc_id").alias("l_id"), F.col("quality").cast("int").alias("label")).distinct()
    rows = rows.orderBy(F.xxhash64("l_id"), "l_id", "label").limit(sample_rows)
    return docs.join(F.broadcast(cut_lineage(rows)), F.col("doc_id") == F.col("l_id")).select("doc_id", "label", "text")


def fit(docs: DataFrame, labels: DataFrame, sample_rows: int = SAMPLE_ROWS) -> tuple[np.ndarray, float]:
    rows = training_rows(docs, labels, sample_rows).mapInArrow(_featurise, "doc_id long, label int, idx binary, weight binary")
    got = sorted(rows.toLocalIterator(), key=lambda r: (r["doc_id"], r["label"], r["idx"]))
    return train([(int(r["label"] > 0), np.frombuffer(r["idx"], np.int32), np.frombuffer(r["weight"], np.float32)) for r in got])


class WordSums(dict):
    """word -> sum of its buckets' numbers + 1j * number of features; emptied when it is full."""

    def __init__(self, table: np.ndarray):
        super().__init__()
        self.table = table.tolist()

    def __missing__(self, word: str) -> complex:
        f, t = features(word), self.table
        value = complex(sum([t[i] for i in f]), len(f))
        if len(self) >= CACHE_WORDS:
            self.clear()
        self[word] = value
        return value


def _scorer(model):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table, bias = model.value
        sums = WordSums(table)
        for b in batches:
            at = b.schema.get_field_index("text")
            logits = []
            for text in b.column(at):
                words = (text.as_py() or "").split()
                s = sum(map(sums.__getitem__, words), 0j)
                if repeats := sum(map(eq, words, words[1:])):
                    s += repeats * sums[REPEAT]
                logits.append(bias + (s.real / s.imag if s.imag else 0.0))
            score = 1 / (1 + np.exp(-np.clip(np.array(logits, np.float64), -500, 500)))
            columns = [b.column(i) for i in range(b.num_columns) if i != at or at < b.num_columns - 1]
            yield pa.RecordBatch.from_arrays([*columns, pa.array(score, pa.float64())], [*(f.name for f in list(b.schema)[: len(columns)]), "_score"])

    return run


def score_documents(docs: DataFrame, model: tuple[np.ndarray, float], keep_text: bool = True) -> DataFrame:
    """``docs`` with ``_score``, the probability of label 1. ``keep_text=False`` leaves out the text (then the last column)."""
    columns = [c for c in docs.columns if c != "text"]
    d = docs.select(*columns, "text") if not keep_text else docs.select(*docs.columns, F.lit(None).cast("boolean").alias("_score_pad"))
    fields = [f"`{f.name}` {f.dataType.simpleString()}" for f in d.schema if keep_text or f.name != "text"]
    shared = docs.sparkSession.sparkContext.broadcast((np.asarray(model[0], np.float32), model[1]))
    out = d.mapInArrow(_scorer(shared), ", ".join([*fields, "_score double"]))
    return out.drop("_score_pad")


def quality_scores(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """The contract's rows."""
    model = fit(docs, labels)
    out = score_documents(docs.select("doc_id", "text"), model, keep_text=False)
    held = F.coalesce(remainder(F.col("doc_id"), 3) == 1, F.lit(False))
    return out.select("doc_id", held.alias("held_out"), F.col("_score").alias("score"), (F.col("_score") >= 0.5).cast("int").alias("predicted"))


def keep_quality(docs: DataFrame, labels: DataFrame, threshold: float = 0.5) -> DataFrame:
    """The rows of ``docs`` that the classifier does not reject; other columns pass through, whatever their names."""
    model = fit(docs.select("doc_id", "text"), labels)
    return unclashed(docs, lambda d: score_documents(d, model).where(F.col("_score") >= threshold))
