"""Benchmark decontamination over a stored positional inverted index (DataFrame functions only).

Method. One pass over the training texts stores a posting (term, document, position) for every word that some
test window uses; the terms of the test set are the index's vocabulary, no other posting is ever asked for.
Term frequencies come from the index. For each test window (``width`` consecutive item words; a shorter item
is one window) the postings of its two rarest terms are read, shifted by their offsets to the window's start
and intersected. What survives is compared with the text, word by word: an exact phrase match. A window with a
term that no document has is dropped at once.

``proximity`` answers the looser question on the same index: documents in which all terms of a phrase occur
within a span of given width.

Scale. The index is written in the order of the scan, without a shuffle. A hot term costs nothing unless it is
among the two rarest of a window; intersections are keyed by (document, window, start), which no term or
document can make hot. The vocabulary and the window tables are broadcast only if their stored size is proven
small (``sized_broadcast``). Documents with survivors are the only ones whose words are compared.

Defined cases: NULL text has no words; a NULL item id is the empty string; an item without words is ignored;
repeated documents are judged alike and keep their rows; repeated items count once; empty tables give rows
without hits or no rows; other columns are not read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from martline.llm.common import let, sized_broadcast, unclashed
from martline.session import cut_lineage

#: ASCII characters that no word holds, and A-Z with what they become; all others stay as they are.
BETWEEN = "".join(c for c in map(chr, range(128)) if not c.isalnum())
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
WIDTH = 13
#: A document is one row here: its id and a hash of its text, so that rows sharing an id stay apart.
KEY = ("doc_id", "text_hash")


def terms(text: Column) -> Column:
    """Lower-cased (A-Z only) words: the matches of ``[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+``.

    One pass over the characters and a split at single spaces find them at a fraction of what a regular expression
    takes, which is most of the job's time.
    """
    spaced = F.translate(F.coalesce(text, F.lit("")), BETWEEN + UPPER, " " * len(BETWEEN) + LOWER)
    return F.array_remove(F.split(spaced, " "), "")


def with_key(docs: DataFrame) -> DataFrame:
    return docs.withColumn("text_hash", F.xxhash64("text"))


def test_windows(bench: DataFrame, width: int = WIDTH) -> DataFrame:
    """(window_id, item, words): every distinct window of every item."""
    w = bench.select(F.coalesce(F.col("item_id").cast("string"), F.lit("")).alias("item"), terms(F.col("text")).alias("w")).where(F.size("w") > 0)
    starts = F.sequence(F.lit(1), F.greatest(F.size("w") - (width - 1), F.lit(1)))
    w = w.select("item", F.explode(F.transform(starts, lambda i: F.slice("w", i, width))).alias("words")).distinct()
    return w.withColumn("window_id", F.xxhash64("item", "words"))


def posting_index(docs: DataFrame, vocabulary: DataFrame) -> DataFrame:
    """Store the postings (term_id, doc_id, text_hash, pos) of the terms in ``vocabulary`` (term, term_id)."""
    p = with_key(docs).select(*KEY, terms(F.col("text")).alias("w"))
    p = p.select(*KEY, F.posexplode("w").alias("pos", "term"))
    return cut_lineage(p.join(vocabulary, "term").select("term_id", *KEY, "pos"))


def vocabulary_of(windows: DataFrame) -> DataFrame:
    v = windows.select(F.explode("words").alias("term")).distinct()
    return cut_lineage(v.withColumn("term_id", F.xxhash64("term")))


def anchors(windows: DataFrame, index: DataFrame) -> DataFrame:
    """(term_id, window_id, offset, need): the two rarest terms of each window whose terms all occur."""
    frequency = index.groupBy("term_id").agg(F.count(F.lit(1)).alias("n"))
    w = windows.select("window_id", F.posexplode("words").alias("offset", "term")).withColumn("term_id", F.xxhash64("term"))
    w = w.join(frequency, "term_id", "left").withColumn("n", F.coalesce("n", F.lit(0)))
    per_window = Window.partitionBy("window_id")
    w = w.withColumn("least", F.min("n").over(per_window)).where("least > 0")
    w = w.withColumn("k", F.row_number().over(per_window.orderBy("n", "offset")))
    w = w.withColumn("need", F.least(F.count(F.lit(1)).over(per_window), F.lit(2)))
    return w.where("k <= 2").select("term_id", "window_id", "offset", "need")


def phrase_candidates(index: DataFrame, windows: DataFrame) -> DataFrame:
    """(doc_id, text_hash, start, item, words): places where a window's two rarest terms both fit."""
    a = sized_broadcast(cut_lineage(anchors(windows, index)))
    hits = index.join(a, "term_id").select(*KEY, "window_id", (F.col("pos") - F.col("offset")).alias("start"), "need")
    c = hits.where("start >= 0").groupBy(*KEY, "window_id", "start").agg(F.count(F.lit(1)).alias("n"), F.max("need").alias("need"))
    c = c.where("n >= need").select(*KEY, "window_id", "start")
    return c.join(sized_broadcast(windows, ("item",), 512), "window_id").select(*KEY, "start", "item", "words")


def found_places(docs: DataFrame, bench: DataFrame, width: int = WIDTH) -> DataFrame:
    """(_doc_id, _text_hash, _found): each document's places where a window may stand."""
    windows = cut_lineage(test_windows(bench, width))
    vocabulary = vocabulary_of(windows)
    index = posting_index(docs.select("doc_id", "text"), sized_broadcast(vocabulary, ("term",)))
    found = phrase_candidates(index, windows).groupBy(*[F.col(k).alias(f"_{k}") for k in KEY])
    return found.agg(F.collect_set(F.struct("start", "item", "words")).alias("_found"))


def at_found(docs: DataFrame, found: DataFrame, how: str) -> DataFrame:
    same = (F.col("_key_hash") == F.col("_text_hash")) & F.col("doc_id").eqNullSafe(F.col("_doc_id"))
    return docs.withColumn("_key_hash", F.xxhash64("text")).join(found, same, how)


def phrase_matches(docs: DataFrame, bench: DataFrame, width: int = WIDTH) -> DataFrame:
    """``docs`` (their columns) with n_words, n_hit (words inside a match) and items (sorted ids with a match)."""
    return _judged(at_found(docs, found_places(docs, bench, width), "left").withColumn("_w", terms(F.col("text"))))


def keep_clean(docs: DataFrame, bench: DataFrame, width: int = WIDTH) -> DataFrame:
    """The rows of ``docs`` that are not contaminated; other columns pass through, whatever their names.

    Only documents with a place where a window may stand are cut into words, once: their words are stored before
    they are compared, and the verdicts are joined back to the untouched rows.
    """
    text = docs.select("doc_id", "text")
    places = cut_lineage(found_places(text, bench, width))
    judged = cut_lineage(at_found(text, places, "inner").select("_doc_id", "_text_hash", "_found", terms(F.col("text")).alias("_w")))
    judged = _judged(judged.withColumnsRenamed({"_doc_id": "bad_id", "_text_hash": "bad_hash"}))
    bad = cut_lineage(judged.where(contaminated()).select("bad_id", "bad_hash"))

    def clean(d: DataFrame) -> DataFrame:
        same = (F.xxhash64(d["text"]) == F.col("bad_hash")) & d["doc_id"].eqNullSafe(F.col("bad_id"))
        return d.join(bad, same, "left_anti")

    return unclashed(docs, clean)


def _judged(d: DataFrame) -> DataFrame:
    valid = F.filter(F.col("_found"), lambda c: F.slice(F.col("_w"), c["start"] + 1, F.size(c["words"])) == c["words"])
    d = d.withColumn("n_words", F.size("_w").cast("bigint")).withColumn("_valid", F.when(F.col("_found").isNull(), F.lit(None)).otherwise(valid))
    covered = F.array_distinct(F.flatten(F.transform("_valid", lambda c: F.sequence(c["start"], c["start"] + F.size(c["words"]) - 1))))
    items = F.array_sort(F.array_distinct(F.transform("_valid", lambda c: c["item"])))
    d = d.withColumn("n_hit", F.when(F.col("_valid").isNull() | (F.size("_valid") == 0), F.lit(0)).otherwise(F.size(covered)).cast("bigint"))
    d = d.withColumn("items", F.coalesce(items, F.array().cast("array<string>")))
    return d.drop("_w", "_found", "_valid", "_key_hash", "_doc_id", "_text_hash")


def contaminated() -> Column:
    """At least a twentieth of a document's words lie in matches."""
    return (F.col("n_hit") > 0) & (20 * F.col("n_hit") >= F.col("n_words"))


def proximity(docs: DataFrame, phrase: str, span: int) -> DataFrame:
    """(doc_id, start, end): the narrowest places where all terms of ``phrase`` occur within ``span`` words.

    Each posting opens a span; for every term the nearest posting at or after it in the document is found with
    one ordered window per document. A phrase without words gives no rows.
    """
    spark = docs.sparkSession
    query = cut_lineage(spark.range(1).select(F.explode(F.array_distinct(terms(F.lit(phrase)))).alias("term")).withColumn("term_id", F.xxhash64("term")))
    ids = [r["term_id"] for r in query.select("term_id").collect()]  # the words of one phrase
    p = posting_index(docs.select("doc_id", "text"), sized_broadcast(query, ("term",)))
    after = Window.partitionBy(*KEY).orderBy("pos").rowsBetween(0, Window.unboundedFollowing)
    nearest = [F.first(F.when(F.col("term_id") == i, F.col("pos")), ignorenulls=True).over(after).alias(f"p{k}") for k, i in enumerate(ids)]
    if not ids:
        return p.select("doc_id", F.col("pos").alias("start"), F.col("pos").alias("end"))
    p = p.select(*KEY, "pos", *nearest).dropna(subset=[f"p{k}" for k in range(len(ids))])
    end = F.array_max(F.array(*[F.col(f"p{k}") for k in range(len(ids))]))
    return p.withColumn("end", end).where(F.col("end") - F.col("pos") < span).select("doc_id", F.col("pos").alias("start"), "end")


def decontamination_report(docs: DataFrame, bench: DataFrame) -> DataFrame:
    """The contract's rows."""
    m = phrase_matches(docs.select("doc_id", "text"), bench.select("item_id", "text"))
    sha = let(F.array_join("items", ","), lambda s: F.sha2(s, 256))
    return m.select("doc_id", "n_words", "n_hit", F.size("items").cast("bigint").alias("n_items"), sha.alias("items_sha256"), contaminated().alias("contaminated"))


ORACLE = r"""
with d as (select row_number() over () as r, doc_id,
        regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') as w from documents),
b as (select coalesce(item_id::varchar, '') as item,
        regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') as w from benchmark),
i as (select item, unnest(range(0, greatest(len(w) - 12, 1))) as s, w from b where len(w) > 0),
v as (select distinct item, array_to_string(w[s + 1 : s + 13], ' ') as phrase, len(w[s + 1 : s + 13]) as n from i),
n as (select distinct n from v),
g as (select r, s, n, array_to_string(w[s + 1 : s + n], ' ') as phrase
      from (select r, w, n, unnest(range(0, len(w) - n + 1)) as s from d, n where len(w) >= n)),
m as (select r, s, item, g.n from g join v using (phrase, n)),
h as (select r, count(distinct p)::bigint as n_hit from (select r, unnest(range(s, s + n)) as p from m) group by r),
x as (select r, count(*)::bigint as n_items, string_agg(item, ',' order by item) as items from (select distinct r, item from m) group by r)
select doc_id, len(w)::bigint as n_words, coalesce(n_hit, 0)::bigint as n_hit, coalesce(n_items, 0)::bigint as n_items,
  sha256(coalesce(items, '')) as items_sha256, coalesce(n_hit, 0) > 0 and 20 * coalesce(n_hit, 0) >= len(w) as contaminated
from d left join h using (r) left join x using (r)
"""
