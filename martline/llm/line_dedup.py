"""Substring dedup by line and paragraph hashing: repeated units keep their earliest ranked occurrence.

Method. A text is cut at line feeds, and lines after the ends of sentences, into segments. A unit is a shortest run of
neighbouring segments that has ``min_words`` words, from each segment forwards and from each backwards: a long sentence
alone, short sentences and short lines as a small paragraph. A repeated line of that length is thus removed whole, and
so is a copied passage inside lines that differ, but for the sentences it shares only in part. Units are normalised (lower case, runs of white
space become one space) and hashed; digests are grouped over all documents. The occurrence with the lowest rank
(document id, row hash, first segment) stays; segments covered by any other one are removed, a line with its line
feed if all of it goes. Some earlier copy of every removed segment stays, as a unit's first occurrence loses a segment
only to a unit that occurs earlier still. Offsets of removed text refer to the original text.

Scale. A unit travels as a 16-byte digest with its place, never as text. The earliest place per digest is an
aggregate with map-side combine; only digests seen twice are joined back to their places, so a line that a third
of all documents share is one row per map task in the aggregate and a skew-split side in the join. Texts are
shuffled once, to meet their list of removed units.

Defined cases: NULL text stays NULL and has no units; an empty text has none; a very long text takes memory in
proportion to itself; rows sharing an id are told apart by a hash of their text; of rows equal in id and text one, the
first as they are stored, is the occurrence and the others lose all their units; NULL ids rank last; other columns pass through, whatever their names; an empty
table gives an empty result.
"""

from __future__ import annotations

import hashlib
import re
from bisect import bisect_left, bisect_right
from collections.abc import Iterator
from itertools import accumulate

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from martline.llm.common import unclashed
from martline.session import cut_lineage

MIN_WORDS = 8
_SENTENCE_END = re.compile(r"[.!?][\"')\]]*[^\S\n]+|[。！？]+")


def normalise(segment: str) -> str:
    return " ".join(segment.lower().split())


def lines_of(text: str) -> Iterator[tuple[int, int, list[int]]]:
    """(start, end, starts of its segments) of every line in code points, without the line feed."""
    at = 0
    for line in text.split("\n"):
        end = at + len(line)
        starts = [at, *(m.end() for m in _SENTENCE_END.finditer(text, at, end) if m.end() < end)]
        yield at, end, starts
        at = end + 1


def segments_of(text: str) -> list[tuple[int, int]]:
    """(start, end) of the segments that have words, in order."""
    spans = [span for _, end, starts in lines_of(text) for span in zip(starts, [*starts[1:], end])]
    return [(a, b) for a, b in spans if text[a:b].strip()]


def units_of(text: str, min_words: int) -> list[tuple[int, int, str]]:
    """(first segment, last segment, normalised words) of every unit."""
    parts = [normalise(text[a:b]) for a, b in segments_of(text)]
    before = [0, *accumulate(p.count(" ") + 1 for p in parts)]
    runs = set()
    for i in range(len(parts)):
        if (j := bisect_left(before, before[i] + min_words)) <= len(parts):
            runs.add((i, j - 1))
        if (j := bisect_right(before, before[i + 1] - min_words)) > 0:
            runs.add((j - 1, i))
    return [(i, j, " ".join(parts[i : j + 1])) for i, j in sorted(runs)]


def _units(min_words: int):
    types = {"_u_id": pa.int64(), "_u_hash": pa.int64(), "_u_first": pa.int32(), "_u_last": pa.int32(), "_u_digest": pa.binary()}

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            columns: list[list] = [[] for _ in types]
            for doc_id, h, text in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), b.column(2).to_pylist()):
                for first, last, words in units_of(text, min_words):
                    digest = hashlib.blake2b(words.encode("utf-8", "surrogatepass"), digest_size=16).digest()
                    for column, value in zip(columns, (doc_id, h, first, last, digest)):
                        column.append(value)
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types.values())], list(types))

    return run


def removed_units(docs: DataFrame, min_words: int = MIN_WORDS) -> DataFrame:
    """(_u_id, _u_hash, _u_runs): the runs of segments (first, last) each document loses."""
    units = docs.where("text is not null").select("doc_id", F.xxhash64("text").alias("h"), "text")
    units = units.mapInArrow(_units(min_words), "_u_id long, _u_hash long, _u_first int, _u_last int, _u_digest binary")
    place = F.struct(F.col("_u_id").isNull().alias("none"), "_u_id", "_u_hash", F.col("_u_first").alias("at"))
    # equal rows have equal places, so a unit repeats only if its places differ
    first = units.groupBy("_u_digest").agg(F.min(place).alias("_u_min"), F.max(place).alias("_u_max"))
    first = first.where(~F.col("_u_min").eqNullSafe(F.col("_u_max"))).select("_u_digest", "_u_min")
    later = units.join(first, "_u_digest").where(place > F.col("_u_min"))
    return later.groupBy("_u_id", "_u_hash").agg(F.collect_set(F.struct("_u_first", "_u_last")).alias("_u_runs"))


def cut(text: str, runs: list[tuple[int, int]]) -> tuple[str, list[tuple[int, int]]]:
    """What stays of ``text`` without the segments of ``runs``, and what goes: (start, end) within a line each."""
    segments = segments_of(text)
    gone = {segments[k][0] for first, last in runs for k in range(first, last + 1)}
    kept, spans = [], []
    for start, end, starts in lines_of(text):
        pieces, out = [], []
        for a, b in zip(starts, [*starts[1:], end]):
            if a not in gone:
                pieces.append(text[a:b])
            elif out and out[-1][1] == a:
                out[-1] = (out[-1][0], b)
            else:
                out.append((a, b))
        if pieces or not out:
            kept.append("".join(pieces))
        spans += out
    return "\n".join(kept), spans


def _strip(min_words: int):
    kept_type, span_type = pa.string(), pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32())]))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            at, runs_at = b.schema.get_field_index("text"), b.schema.get_field_index("_u_runs")
            texts, spans = b.column(at).to_pylist(), []
            for i, (runs, again) in enumerate(zip(b.column(runs_at).to_pylist(), b.column(b.num_columns - 1).to_pylist())):
                removed = []
                if texts[i] is not None and (runs or again):
                    mine = [(i, j) for i, j, _ in units_of(texts[i], min_words)] if again else [(r["_u_first"], r["_u_last"]) for r in runs]
                    texts[i], removed = cut(texts[i], mine)
                spans.append([{"start": a, "end": z} for a, z in removed])
            columns = [pa.array(texts, kept_type) if k == at else pa.array(spans, span_type) if k == runs_at else b.column(k) for k in range(b.num_columns - 1)]
            yield pa.RecordBatch.from_arrays(columns, [("removed" if k == runs_at else f.name) for k, f in enumerate(list(b.schema)[:-1])])

    return run


def _same_row(docs: DataFrame):
    return (F.xxhash64(docs["text"]) == F.col("_u_hash")) & docs["doc_id"].eqNullSafe(F.col("_u_id"))


def mark_repeated(docs: DataFrame) -> DataFrame:
    """``docs`` with ``_u_again``: true for rows equal in id and text to a row stored before them."""
    keys = docs.where("text is not null").select("doc_id", F.xxhash64("text").alias("_u_hash")).groupBy("doc_id", "_u_hash").agg(F.count(F.lit(1)).alias("n"))
    keys = cut_lineage(keys.where("n > 1").select(F.col("doc_id").alias("_u_id"), "_u_hash"))
    never = F.lit(False).alias("_u_again")
    if keys.isEmpty():
        return docs.select("*", never)
    rows = cut_lineage(docs.join(keys, _same_row(docs)).withColumn("_u_row", F.monotonically_increasing_id()))
    least = rows.groupBy("_u_id", "_u_hash").agg(F.min("_u_row").alias("_u_row"))
    first = least.select("_u_row", F.lit(True).alias("_u_kept"))
    rows = rows.join(first, "_u_row", "left").select(*docs.columns, F.col("_u_kept").isNull().alias("_u_again"))
    return docs.join(keys, _same_row(docs), "left_anti").select("*", never).unionByName(rows)


def dedup_lines(docs: DataFrame, min_words: int = MIN_WORDS) -> DataFrame:
    """``docs`` with ``text`` cleaned and ``removed``, the array of (start, end) in the original text (a column of
    that name in ``docs`` is replaced)."""
    return unclashed(docs, lambda d: _dedup(d, min_words), "removed")


def clean_texts(docs: DataFrame, min_words: int = MIN_WORDS) -> DataFrame:
    """``docs`` with ``text`` cleaned; other columns pass through, whatever their names."""
    return unclashed(docs, lambda d: _dedup(d, min_words))


def _dedup(docs: DataFrame, min_words: int) -> DataFrame:
    gone = removed_units(docs.select("doc_id", "text"), min_words)
    docs = mark_repeated(docs)
    d = docs.join(gone, _same_row(docs), "left").select(*docs.columns[:-1], "_u_runs", "_u_again")
    fields = [f"`{f.name}` {f.dataType.simpleString()}" for f in docs.schema.fields[:-1]]
    return d.mapInArrow(_strip(min_words), ", ".join([*fields, "removed array<struct<start:int,end:int>>"]))


def substring_dedup(docs: DataFrame, min_words: int = MIN_WORDS) -> DataFrame:
    """One row per document: doc_id, n_removed (spans), removed_chars, removed (original offsets), text (what stays)."""
    d = dedup_lines(docs.select("doc_id", "text"), min_words)
    chars = F.aggregate("removed", F.lit(0), lambda acc, s: acc + s["end"] - s["start"])
    return d.select("doc_id", F.size("removed").alias("n_removed"), chars.alias("removed_chars"), "removed", "text")
