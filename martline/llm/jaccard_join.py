"""N-gram Jaccard self-join by MinHash banding, verified on full n-gram sets.

Method. A text's set is its five-word shingles (words: runs of anything but ASCII white space, as written; a text
of one to four words has one shingle). Signatures of ``bands * rows`` minima are cut into bands; texts that agree
on a band are candidates. ``choose_bands`` takes the most selective band that reaches the target recall at the
threshold (0.9995 at 0.8: 20 bands of 5). Every candidate pair is verified exactly on its full sets.

Scale. Exact copies are one class before anything else; only one of each goes on, and its copies count by weight.
Buckets are grouped with map-side combine and emit a star, never their pairs. Candidates are compared in *units*:
a component of the candidate graph, or single buckets where a large component would cost more. A unit over BLOCK
texts is split into blocks, each pair of blocks being a task of its own, so neither a unit nor a hot bucket meets
in one task. A task compares by matrix products and returns, for each text, how many it links to and the least
member of its linked group: rows grow with texts, not with pairs, and no link is lost.

Defined cases: NULL and empty texts have no shingles and link to nothing, each a class of its own; repeated rows
and rows sharing an id are classes by text; NULL ids rank last as representatives (a class of only such rows has
a NULL id); other columns pass by; an empty table gives an empty result.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from martline.llm.common import unclashed
from martline.llm.components import connected_components
from martline.llm.hashing import mix, text_blocks, word_hashes
from martline.session import cut_lineage

SHINGLE, THRESHOLD = 5, 0.8
TARGET_RECALL, MAX_HASHES = 0.9995, 128
BLOCK = 384


def choose_bands(threshold: float = THRESHOLD, recall: float = TARGET_RECALL, max_hashes: int = MAX_HASHES) -> tuple[int, int]:
    """(bands, rows): the longest rows whose bands find a pair at the threshold with the target recall."""
    best = None
    for rows in range(1, max_hashes + 1):
        missed = math.log1p(-(threshold**rows)) if threshold < 1 else -math.inf
        if missed == 0 or (bands := max(1, math.ceil(math.log(1 - recall) / missed))) * rows > max_hashes:
            continue
        best = (bands, rows)
    if best is None:
        raise ValueError("no banding within max_hashes reaches the recall")
    return best


def shingles(buf: np.ndarray, offsets: np.ndarray, width: int = SHINGLE) -> tuple[np.ndarray, np.ndarray]:
    """(shingle hash, text), texts ascending. A text with fewer words than ``width`` has one shingle of them all."""
    h, doc, _, _ = word_hashes(buf, offsets)
    n = np.bincount(doc, minlength=len(offsets) - 1)
    factors = mix(np.arange(1, width + 1, dtype=np.uint64)) | np.uint64(1)
    out, whose = np.zeros(0, np.uint64), np.zeros(0, np.int64)
    if len(h) >= width:
        acc = np.zeros(len(h) - width + 1, np.uint64)
        for k in range(width):
            acc += h[k : len(h) - width + 1 + k] * factors[k]
        inside = doc[: len(acc)] == doc[width - 1 :]
        out, whose = mix(acc[inside]), doc[: len(acc)][inside]
    first = np.cumsum(n) - n
    short = np.flatnonzero((n > 0) & (n < width))
    if len(short):
        one = []
        for d in short:
            acc = np.uint64(n[d])
            for k in range(n[d]):
                acc = np.uint64((int(acc) + int(h[first[d] + k]) * int(factors[k])) & 0xFFFFFFFFFFFFFFFF)
            one.append(acc)
        out = np.concatenate([out, mix(np.array(one, np.uint64))])
        whose = np.concatenate([whose, short])
        order = np.argsort(whose, kind="stable")
        out, whose = out[order], whose[order]
    return out, whose


def signatures(sh: np.ndarray, whose: np.ndarray, bands: int, rows: int) -> tuple[np.ndarray, np.ndarray]:
    """(texts with a shingle, their band hashes)."""
    start = np.flatnonzero(np.concatenate([[True], whose[1:] != whose[:-1]])) if len(whose) else np.zeros(0, np.int64)
    out = np.zeros((len(start), bands), np.uint64)
    if not len(start):
        return whose, out
    seeds = mix(np.arange(1, 2 * bands * rows + 1, dtype=np.uint64))
    for b in range(bands):
        acc = np.full(len(start), b + 1, np.uint64)
        for r in range(rows):
            k = b * rows + r
            v = (sh * (seeds[2 * k] | np.uint64(1)) + seeds[2 * k + 1]) >> np.uint64(32)
            acc = mix(acc + np.minimum.reduceat(v, start))
        out[:, b] = acc
    return whose[start], out


def _sign(bands: int, rows: int, width: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            found: list = [None] * b.num_rows
            for at, buf, offsets in text_blocks(b.column(1)):
                texts, sig = signatures(*shingles(buf, offsets, width), bands, rows)
                for t, s in zip(texts.tolist(), sig.view(np.int64)):
                    found[at + t] = s
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(2), pa.array(found, pa.list_(pa.int64()))], ["doc_id", "key", "bands"])

    return run


def _sets(width: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            found: list = [b""] * b.num_rows
            for at, buf, offsets in text_blocks(b.column(1)):
                sh, whose = shingles(buf, offsets, width)
                cut = np.searchsorted(whose, np.arange(len(offsets)))
                for t in range(len(offsets) - 1):
                    found[at + t] = np.unique(sh[cut[t] : cut[t + 1]]).tobytes()
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(found, pa.binary())], ["key", "shingles"])

    return run


def intersections(sets: list[np.ndarray], a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Sizes of sets[a[i]] & sets[b[i]]: merged pair by pair if pairs are few, else by matrix products."""
    if len(a) <= 4 * len(sets):
        return np.array([len(np.intersect1d(sets[i], sets[j], assume_unique=True)) for i, j in zip(a, b)], np.int64)
    sizes = np.array([len(s) for s in sets])
    values, column = np.unique(np.concatenate(sets), return_inverse=True)
    row = np.repeat(np.arange(len(sets)), sizes)
    order = np.argsort(column, kind="stable")
    row, column = row[order], column[order]
    shared = np.zeros((len(sets), len(sets)), np.float32)
    step = 2048
    for low in range(0, len(values), step):
        lo, hi = np.searchsorted(column, [low, low + step])
        part = np.zeros((len(sets), min(step, len(values) - low)), np.float32)
        part[row[lo:hi], column[lo:hi] - low] = 1
        shared += part @ part.T
    return shared[a, b].round().astype(np.int64)


def compare(rows: pd.DataFrame, band: int, threshold: float) -> pd.DataFrame:
    """Links among the texts of one task: (key, linked copies, least key linked to it, directly or not).

    ``block`` tells the two sides of a task apart; with one block all pairs are compared. ``band`` >= 0 is a unit
    made of one bucket: it owns the pairs that agree on no earlier band.
    """
    rows = rows.sort_values("key", ignore_index=True)
    bands = np.stack([np.asarray(x, np.int64) for x in rows["bands"]])
    block = rows["block"].to_numpy()
    two = block.min() != block.max()
    left = np.flatnonzero(block == block.min())
    right = np.flatnonzero(block == block.max())
    pairs = []
    for i in left:
        others = right if two else right[right > i]
        same = bands[others] == bands[i]
        owned = same.any(axis=1) if band < 0 else same[:, band] & ~same[:, :band].any(axis=1)
        if owned.any():
            pairs.append((np.full(owned.sum(), i), others[owned]))
    out = {"key": [], "linked": [], "root": []}
    if pairs:
        a, b = np.concatenate([p[0] for p in pairs]), np.concatenate([p[1] for p in pairs])
        sets = [np.frombuffer(x, np.uint64) for x in rows["shingles"]]
        sizes = np.array([len(s) for s in sets])
        both = intersections(sets, a, b)
        ok = both >= threshold * (sizes[a] + sizes[b] - both) - 1e-9
        a, b = a[ok], b[ok]
        copies = rows["copies"].to_numpy()
        linked = np.bincount(a, copies[b], len(rows)) + np.bincount(b, copies[a], len(rows))
        root = np.arange(len(rows))
        while len(a):
            low = np.minimum(root[a], root[b])
            new = root.copy()
            np.minimum.at(new, a, low)
            np.minimum.at(new, b, low)
            new = np.minimum(new, new[new])
            if (new == root).all():
                break
            root = new
        for i in np.flatnonzero(linked):
            out["key"].append(rows["key"][i])
            out["linked"].append(int(linked[i]))
            out["root"].append(rows["key"][root[i]])
    return pd.DataFrame(out).astype({"key": object, "linked": "int64", "root": object})


def similar_groups(docs: DataFrame, threshold: float = THRESHOLD, width: int = SHINGLE, block: int = BLOCK) -> DataFrame:
    """(doc_id, key, label, copy_id, n_copies, class_id, n_links) of every row of ``docs`` (doc_id, text).

    label: the connected group of links, by its least key (NULL for a text without shingles, a group of its own);
    copy_id: least id with the same text; class_id: least id of the group; n_links: other rows whose text is
    similar, copies included.
    """
    bands, n_rows = choose_bands(threshold)
    text = F.coalesce(F.col("text"), F.lit(""))
    d = docs.select("doc_id", text.alias("text"), F.md5(text).alias("key"))
    signed = cut_lineage(d.mapInArrow(_sign(bands, n_rows, width), "doc_id long, key string, bands array<long>"))
    copies = signed.groupBy("key").agg(F.min("doc_id").alias("copy_id"), F.count(F.lit(1)).alias("copies"), F.first("bands").alias("bands"))
    copies = cut_lineage(copies)

    slots = copies.where("bands is not null").select("key", F.posexplode("bands").alias("band", "h"))
    full = slots.groupBy("band", "h").agg(F.count(F.lit(1)).alias("n"), F.min("key").alias("root")).where("n > 1")
    members = cut_lineage(slots.join(full, ["band", "h"]).select("band", "h", "n", "key", "root"))
    clusters = connected_components(members.select(F.col("key").alias("a"), F.col("root").alias("b")))

    # what a unit costs: its texts, each sent once for every block it is split into
    sent = lambda n: n * F.ceil(n / F.lit(block))
    per_cluster = clusters.groupBy("label").agg(F.count(F.lit(1)).alias("size"))
    per_bucket = members.where("key = root").join(clusters, F.col("key") == F.col("node")).groupBy("label").agg(F.sum(sent(F.col("n"))).alias("apart"))
    plan = cut_lineage(per_cluster.join(per_bucket, "label").withColumn("whole", (F.col("size") <= block) | (sent(F.col("size")) <= F.col("apart"))))
    planned = clusters.join(plan, "label")
    whole = planned.where("whole").select("node", F.col("label").alias("unit"), F.lit(-1).alias("band"), F.col("size").alias("n"))
    split = members.join(planned.where("not whole").select("node"), F.col("key") == F.col("node"))
    split = split.select("node", F.concat_ws(":", "band", "h").alias("unit"), "band", "n")
    sites = whole.unionByName(split).withColumn("blocks", F.ceil(F.col("n") / F.lit(block)).cast("int"))
    sites = sites.withColumn("block", F.pmod(F.xxhash64("node"), F.col("blocks")).cast("int"))
    sites = sites.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    sites = sites.select("node", "unit", "band", "block", F.least("block", "other").alias("i"), F.greatest("block", "other").alias("j"))

    # sets of candidates only, each text once
    chosen = clusters.join(copies, F.col("node") == F.col("key")).select("key", "copy_id", "copies", "bands")
    texts = d.join(chosen.select(F.col("key").alias("k"), "copy_id"), (F.col("key") == F.col("k")) & F.col("doc_id").eqNullSafe(F.col("copy_id")))
    texts = texts.select("key", "text").mapInArrow(_sets(width), "key string, shingles binary").dropDuplicates(["key"])
    chosen = cut_lineage(chosen.join(texts, "key").select("key", "copies", "bands", "shingles"))
    work = sites.join(chosen, F.col("node") == F.col("key")).select("unit", "i", "j", "band", "block", "key", "copies", "bands", "shingles")

    def run(part: pd.DataFrame) -> pd.DataFrame:
        return compare(part, int(part["band"].iloc[0]), threshold)

    links = cut_lineage(work.groupBy("unit", "i", "j").applyInPandas(run, "key string, linked long, root string"))
    groups = connected_components(links.select(F.col("key").alias("a"), F.col("root").alias("b")))
    linked = links.groupBy("key").agg(F.sum("linked").alias("linked")).join(groups, F.col("key") == F.col("node")).select("key", "linked", "label")
    named = copies.join(linked, "key", "left").select("key", "copy_id", "copies", "linked", F.coalesce("label", "key").alias("label"))
    least = named.groupBy("label").agg(F.min("copy_id").alias("class_id"))
    named = named.join(least, "label").select("key", "copy_id", "copies", "linked", "label", "class_id")

    out = signed.select("doc_id", "key", F.col("bands").isNull().alias("empty")).join(named, "key")
    own = lambda c: F.when(F.col("empty"), F.col("doc_id")).otherwise(F.col(c))
    n_links = F.when(F.col("empty"), F.lit(0)).otherwise(F.col("copies") - 1 + F.coalesce("linked", F.lit(0)))
    return out.select("doc_id", "key", F.when(~F.col("empty"), F.col("label")).alias("label"), own("copy_id").alias("copy_id"), F.when(F.col("empty"), F.lit(1)).otherwise(F.col("copies")).alias("n_copies"), own("class_id").alias("class_id"), n_links.cast("bigint").alias("n_links"))


def jaccard_join(docs: DataFrame) -> DataFrame:
    """One row per document: its class of exact copies, its group of similar documents and its number of links."""
    return similar_groups(docs.select("doc_id", "text")).drop("key", "label")


def keep_one_of_each(docs: DataFrame) -> DataFrame:
    """The rows of ``docs`` that stay: of each group the row of the least id, then key, then (of rows equal in both) the
    least other columns written as JSON; other columns pass through, whatever their names.

    Groups are told apart by their label, so groups that share an id, or have NULL ids only, keep a row each. Every
    row without shingles stays, being a group of its own.
    """
    return unclashed(docs, _keep_one_of_each)


def _keep_one_of_each(docs: DataFrame) -> DataFrame:
    g = similar_groups(docs.select("doc_id", "text")).select("doc_id", "key", "label")
    rows = g.where("label is not null").groupBy("label", "doc_id", "key").agg(F.count(F.lit(1)).alias("n"))
    least = rows.groupBy("label").agg(F.min(F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "key", "n")).alias("s"))
    least = least.select(F.col("s.doc_id").alias("_g_id"), F.col("s.key").alias("_g_key"), F.col("s.n").alias("_g_n"))
    alone = g.where("label is null").select("doc_id", "key", F.lit(1).cast("bigint")).distinct()
    stays = cut_lineage(least.union(alone))
    same = docs["doc_id"].eqNullSafe(F.col("_g_id")) & (F.md5(F.coalesce(docs["text"], F.lit(""))) == F.col("_g_key"))
    once, repeated = docs.join(stays.where("_g_n = 1"), same, "left_semi"), stays.where("_g_n > 1")
    if repeated.isEmpty():
        return once
    row = F.struct(*[docs[c] for c in docs.columns])
    one = docs.join(repeated, same).groupBy("_g_id", "_g_key").agg(F.min_by(row, F.to_json(row)).alias("row"))
    return once.unionByName(one.select("row.*"))
