"""Ranked lexical search of many queries at once, with common sub-expressions shared among the queries.

Method. A query item is a bag of terms; a document's score is the sum of its terms' contributions, which depend on
term and document alone. Sub-sums that several items hold are mined first: terms that occur in exactly the same items
become one node, then the pair of symbols that most items hold becomes a node again and again (``share``). The nodes
form a DAG in which an item is the sum of few nodes. In a block of documents each term's contributions and each node's partial
accumulator are computed once, as one row of numbers over the block's documents, and the items' scores are combined
from them along the DAG.

    m = 25 + (75 n N) div L,  w = floor(1000 ln((2N + 2) / (2 df + 1))),  contribution = w ((10^9 tf) div (1000 tf + 8 m))

Scale. Documents are never shuffled: one pass counts (N, L and the df of the items' terms, summed by task before
they are grouped), a second one scores. A task holds, beside one block of texts, the items' terms, the DAG and the
best ``k`` of each item, so what reaches the final ranking is k rows an item and task. Items are a query set:
they are worked on in blocks of at most ``ITEM_BYTES`` of text (a longer item is a block of its own), so what is
broadcast has a bound, and each block reads the documents again. How many pairs are mined only changes the
sharing, never a score. Terms are told apart by 64-bit hashes.

Defined cases: NULL and empty texts have no terms and are never found; items without terms, or whose terms no document
holds, give no rows; a very long text is scored whole and takes memory in proportion to itself; repeated rows are ranked
each for itself, items as well as documents (equal scores by ascending doc_id, NULL ids last); other columns are ignored;
empty tables give an empty result.
"""

from __future__ import annotations

from collections import Counter, defaultdict
from collections.abc import Iterator
from heapq import heapify, heappop, heappush
from itertools import combinations
from math import floor, log

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from martline.llm.hashing import lower_bytes, separators, text_blocks, word_hashes
from martline.session import cut_lineage

K = 10
ITEM_BYTES = 1 << 18
#: Symbols of an item among which pairs are mined (its most shared ones).
MINED_SYMBOLS = 96
BLOCK, TEXTS = 1 << 20, 256
TERM_BYTES = separators(bytes([*range(0x30), *range(0x3A, 0x41), *range(0x5B, 0x61), *range(0x7B, 0x80)]))
FOUND = "row long, doc_id long, score long"


def terms(column: pa.Array) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """(place of the first text, number of texts, hash and text of every term in order) by blocks of ``TEXTS`` texts or
    ``BLOCK`` bytes at most, or of one longer text."""
    for first in range(0, len(column), TEXTS):
        for at, buf, offsets in text_blocks(column.slice(first, TEXTS), BLOCK):
            h, text, _, _ = word_hashes(lower_bytes()[buf], offsets, TERM_BYTES)
            yield first + at, len(offsets) - 1, h, text


# --- the query-sharing DAG ---------------------------------------------------------------------------------------


class Plan:
    """Sums over terms. Symbols 0..len(vocabulary)-1 are (term, times) leaves; symbol i of ``nodes`` is the sum of
    earlier symbols; ``items`` lists each item's symbols."""

    def __init__(self, bags: list[dict[int, int]]):
        leaf_of: dict[tuple[int, int], int] = {}
        items = [{leaf_of.setdefault(leaf, len(leaf_of)) for leaf in bag.items()} for bag in bags]
        leaves = list(leaf_of)
        self.vocabulary = np.unique(np.array([h for h, _ in leaves], np.uint64))
        self.term = np.searchsorted(self.vocabulary, np.array([h for h, _ in leaves], np.uint64))
        self.times = np.array([n for _, n in leaves], np.int64)
        self.leaves, self.nodes = len(leaves), []
        self.additions_alone = sum(max(0, len(i) - 1) for i in items)
        self.items = [sorted(i) for i in self.share(items)]
        self.additions = sum(len(n) - 1 for n in self.nodes) + sum(max(0, len(i) - 1) for i in self.items)

    def add(self, members: tuple[int, ...]) -> int:
        self.nodes.append(members)
        return self.leaves + len(self.nodes) - 1

    def share(self, items: list[set[int]]) -> list[set[int]]:
        holders: dict[int, list[int]] = defaultdict(list)
        for k, item in enumerate(items):
            for s in item:
                holders[s].append(k)
        # symbols of exactly the same items are one node
        alike: dict[tuple[int, ...], list[int]] = defaultdict(list)
        for s, ks in holders.items():
            alike[tuple(ks)].append(s)
        for ks, members in alike.items():
            if len(ks) > 1 and len(members) > 1:
                node = self.add(tuple(sorted(members)))
                for k in ks:
                    items[k] = (items[k] - set(members)) | {node}
        # then pairs, the most frequent first
        n_items = Counter(s for item in items for s in item)
        pairs: Counter = Counter()
        where: dict[tuple[int, int], set[int]] = defaultdict(set)

        def shared(item: set[int]) -> list[int]:
            return sorted(sorted((s for s in item if n_items[s] > 1), key=lambda s: (-n_items[s], s))[:MINED_SYMBOLS])

        for k, item in enumerate(items):
            for pair in combinations(shared(item), 2):
                where[pair].add(k)
        pairs.update({p: len(ks) for p, ks in where.items() if len(ks) > 1})
        heap = [(-n, p) for p, n in pairs.items()]
        heapify(heap)
        while heap:
            n, (a, b) = heappop(heap)
            ks = {k for k in where[a, b] if a in items[k] and b in items[k]}
            if len(ks) < 2:
                continue
            if len(ks) < -n:
                heappush(heap, (-len(ks), (a, b)))
                continue
            node = self.add((a, b))
            fresh: Counter = Counter()
            for k in sorted(ks):
                items[k] = (items[k] - {a, b}) | {node}
                for s in shared(items[k]):
                    if s != node:
                        pair = (min(s, node), max(s, node))
                        where[pair].add(k)
                        fresh[pair] += 1
            n_items[node] = len(ks)
            for pair, n in fresh.items():
                if n > 1:
                    heappush(heap, (-n, pair))
        return items

    def scores(self, leaves: np.ndarray) -> np.ndarray:
        """Items x documents, from the leaves' contributions (leaves x documents)."""
        rows = np.concatenate([leaves, np.empty((len(self.nodes), leaves.shape[1]), np.int64)])
        for node, (first, second, *more) in zip(rows[self.leaves :], self.nodes):
            np.add(rows[first], rows[second], out=node)
            for s in more:
                node += rows[s]
        out = np.zeros((len(self.items), leaves.shape[1]), np.int64)
        for total, members in zip(out, self.items):
            for s in members:
                total += rows[s]
        return out


# --- the two passes ------------------------------------------------------------------------------------------------

#: Places of N and L among the counted terms.
DOCUMENTS, TERMS = -1, -2


def _count(vocabulary):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        v = vocabulary.value
        df, n_docs, n_terms = np.zeros(len(v), np.int64), 0, 0
        for b in batches:
            for _, n, h, text in terms(b.column(0)):
                n_terms += len(h)
                n_docs += int(np.count_nonzero(np.bincount(text, minlength=n)))
                term, text = known_terms(v, h, text)
                seen = np.zeros((n, len(v)), np.bool_)
                seen[text, term] = True
                df += seen.sum(axis=0)
        held = np.flatnonzero(df)
        places, counts = [DOCUMENTS, TERMS, *held.tolist()], [n_docs, n_terms, *df[held].tolist()]
        yield pa.RecordBatch.from_arrays([pa.array(places, pa.int64()), pa.array(counts, pa.int64())], ["term", "n"])

    return run


def known_terms(vocabulary: np.ndarray, h: np.ndarray, text: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(place in the vocabulary, text) of the terms that are in it."""
    at = np.searchsorted(vocabulary, h)
    at[at == len(vocabulary)] = 0
    found = vocabulary[at] == h if len(vocabulary) else np.zeros(len(h), np.bool_)
    return at[found], text[found]


def weights(df: np.ndarray, n: int) -> np.ndarray:
    return np.array([floor(1000 * log((2 * n + 2) / (2 * d + 1))) for d in df.tolist()], np.int64)


class Best:
    """The best ``k`` documents of each item so far: scores descending, then ids ascending, NULL ids last."""

    def __init__(self, items: int, k: int):
        self.k, self.least = k, np.zeros(items, np.int64)
        self.item, self.score, self.null, self.doc = (np.zeros(0, t) for t in (np.int64, np.int64, np.bool_, np.int64))

    def add(self, scores: np.ndarray, doc: np.ndarray, null: np.ndarray) -> None:
        item, at = np.nonzero((scores > 0) & (scores >= self.least[:, None]))
        item, score = np.concatenate([self.item, item]), np.concatenate([self.score, scores[item, at]])
        doc, null = np.concatenate([self.doc, doc[at]]), np.concatenate([self.null, null[at]])
        order = np.lexsort((doc, null, -score, item))
        first = np.searchsorted(item[order], np.arange(len(self.least)))
        rank = np.arange(len(order)) - first[item[order]]
        order = order[rank < self.k]
        self.item, self.score, self.null, self.doc = item[order], score[order], null[order], doc[order]
        kept = np.searchsorted(self.item, np.arange(len(self.least)), "right") - 1
        full = np.bincount(self.item, minlength=len(self.least)) == self.k
        self.least[full] = self.score[kept[full]]


def _score(shared, k: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        plan, rows, weight, n_docs, n_terms = shared.value
        v, best = plan.vocabulary, Best(len(plan.items), k)
        for b in batches:
            ids = b.column(1)
            null = np.array([i is None for i in ids.to_pylist()], np.bool_)
            ids = ids.fill_null(0).to_numpy(zero_copy_only=False).astype(np.int64)
            for at, n, h, text in terms(b.column(0)):
                length = np.bincount(text, minlength=n)
                term, text = known_terms(v, h, text)
                cell, tf = np.unique(term * n + text, return_counts=True)
                term, text = cell // n, cell % n
                m = 25 + (75 * length[text] * n_docs) // max(1, n_terms)
                contribution = np.zeros((len(v), n), np.int64)
                contribution[term, text] = weight[term] * ((1_000_000_000 * tf) // (1000 * tf + 8 * m))
                best.add(plan.scores(contribution[plan.term] * plan.times[:, None]), ids[at : at + n], null[at : at + n])
        doc = pa.array(best.doc, pa.int64(), mask=best.null)
        yield pa.RecordBatch.from_arrays([pa.array(rows[best.item], pa.int64()), doc, pa.array(best.score, pa.int64())], ["row", "doc_id", "score"])

    return run


def bags_of(texts: list[str | None]) -> list[dict[int, int]]:
    bags: list[dict[int, int]] = [{} for _ in texts]
    for at, n, h, text in terms(pa.array(texts, pa.large_string())):
        for i, x in zip(text.tolist(), h.tolist()):
            bags[at + i][x] = bags[at + i].get(x, 0) + 1
    return bags


def blocks(items: DataFrame, item_bytes: int) -> Iterator[list]:
    """The query set (row, text) in blocks of at most ``item_bytes`` of text, or of one longer item."""
    block, size = [], 0
    for r in items.select("row", "text").toLocalIterator():
        n = len((r["text"] or "").encode("utf-8", "surrogatepass"))
        if block and size + n > item_bytes:
            yield block
            block, size = [], 0
        block.append(r)
        size += n
    if block:
        yield block


def _found(spark: SparkSession, docs: DataFrame, block: list, k: int) -> DataFrame:
    """(row, doc_id, score): each item's best ``k`` documents of every task."""
    plan = Plan(bags_of([r["text"] for r in block]))
    counted = docs.select("text").mapInArrow(_count(spark.sparkContext.broadcast(plan.vocabulary)), "term long, n long")
    counts = {r["term"]: r["n"] for r in counted.groupBy("term").agg(F.sum("n").alias("n")).collect()}
    n = counts.get(DOCUMENTS, 0)
    weight = weights(np.array([counts.get(i, 0) for i in range(len(plan.vocabulary))], np.int64), n)
    shared = spark.sparkContext.broadcast((plan, np.array([r["row"] for r in block], np.int64), weight, n, counts.get(TERMS, 0)))
    return docs.select("text", "doc_id").mapInArrow(_score(shared, k), FOUND)


def lexical_search(docs: DataFrame, items: DataFrame, k: int = K, item_bytes: int = ITEM_BYTES) -> DataFrame:
    """One row per item and found document: item_id, rank (from 1), doc_id, score."""
    spark = docs.sparkSession
    docs = docs.select("text", F.col("doc_id").cast("long"))
    items = cut_lineage(items.select("item_id", "text").withColumn("row", F.monotonically_increasing_id()))
    found = spark.createDataFrame([], FOUND)
    for block in blocks(items, item_bytes):
        found = found.unionByName(_found(spark, docs, block, k))
    order = Window.partitionBy("row").orderBy(F.desc("score"), F.col("doc_id").asc_nulls_last())
    ranked = found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
    return ranked.join(items.select("row", "item_id"), "row").select("item_id", "rank", "doc_id", "score")


ORACLE = r"""
WITH bag AS (
    SELECT n, doc_id, unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                                '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS term
    FROM (SELECT row_number() OVER () AS n, doc_id, text FROM documents)
), tf AS MATERIALIZED (
    SELECT n, any_value(doc_id) AS doc_id, term, count(*) AS tf FROM bag GROUP BY n, term
), len AS (
    SELECT n, CAST(sum(tf) AS BIGINT) AS len FROM tf GROUP BY n
), total AS (
    SELECT count(*) AS docs, CAST(sum(len) AS BIGINT) AS words FROM len
), df AS (
    SELECT term, count(*) AS df FROM tf GROUP BY term
), query AS (
    SELECT k, item_id, unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                                 '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS term
    FROM (SELECT row_number() OVER () AS k, item_id, text FROM benchmark)
), asked AS (
    SELECT k, any_value(item_id) AS item_id, term, count(*) AS times FROM query GROUP BY k, term
), scored AS (
    SELECT k, any_value(item_id) AS item_id, n, any_value(doc_id) AS doc_id,
           CAST(sum(times * CAST(floor(1000 * ln((2 * docs + 2) / (2 * df + 1))) AS BIGINT)
                    * ((1000000000 * tf) // (1000 * tf + 8 * (25 + (75 * len * docs) // words)))) AS BIGINT) AS score
    FROM asked JOIN tf USING (term) JOIN df USING (term) JOIN len USING (n), total
    GROUP BY k, n
)
SELECT item_id, CAST(rank AS INTEGER) AS rank, doc_id, score
FROM (SELECT *, row_number() OVER (PARTITION BY k ORDER BY score DESC, doc_id ASC NULLS LAST) AS rank FROM scored WHERE score > 0)
WHERE rank <= 10
"""
