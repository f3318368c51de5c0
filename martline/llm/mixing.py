"""Mixing sources to target weights by Pareto order sampling (DataFrame functions only).

Method. Each source gets a target in words. A document's expected number of copies is its source's target
over its source's size; the whole part is allocated with certainty, and the rest is its inclusion
probability p. Documents are ranked by Pareto's ranking variable ``(u / (1 - u)) / (p / (1 - p))`` with u a
hash of the document id, and the lowest ranks are taken until the source's words are reached. The sample size
is fixed in words: the document at the cut is taken if that comes nearer to the target.

Scale. The words per document are counted once and stored as a narrow table. The cut is found from a
histogram of the ranking variable (pre-aggregated before its shuffle), so no source is ever sorted as a whole:
only the one bin per source that holds the cut is ordered, about 1/4096 of the source.

Defined cases: NULL or empty text has size 0 and takes 0 words; a NULL source is a source of its own (last);
repeated rows are separate documents (same id and size: the same rank, so any order gives the same rows);
a NULL id is hashed as the text ``null``; an empty table gives an empty result.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from martline.llm.common import words
from martline.session import cut_lineage

BINS = 4096
MAX_COPIES = 3
HASH_DIGITS = 13  # hex digits of md5 that make the uniform variable: 52 bits, exact in a double


def uniform(doc_id: Column, seed: str) -> Column:
    """A repeatable uniform variable in (0, 1) from the document id."""
    text = F.concat(F.lit(f"{seed}:"), F.coalesce(doc_id.cast("string"), F.lit("null")))
    h = F.conv(F.substring(F.md5(text), 1, HASH_DIGITS), 16, 10).cast("bigint")
    return (h + F.lit(0.5)) / F.lit(float(16**HASH_DIGITS))


def source_targets(sizes: DataFrame, weights: tuple[int, ...] = (1, 2, 3), max_copies: int = MAX_COPIES) -> DataFrame:
    """(source, source_size, target): shares by repeating weights, no target above ``max_copies`` sizes.

    Sources are ordered by code point, NULL last. Water filling in closed form: sources sorted by
    cap / weight; those whose cap is reached keep it, and the others share what is left by weight.
    One row per source, so the two ordered windows see only as many rows as there are sources.
    """
    s = sizes.groupBy("source").agg(F.sum("size").alias("source_size"))
    by_name = Window.orderBy(F.col("source").asc_nulls_last())
    s = s.withColumn("k", F.row_number().over(by_name) - 1)
    s = s.withColumn("weight", F.element_at(F.array(*[F.lit(w) for w in weights]), (F.col("k") % len(weights) + 1).cast("int")).cast("bigint"))
    s = s.withColumn("cap", F.col("source_size") * max_copies)
    by_ratio = Window.orderBy(F.col("cap") / F.col("weight"), F.col("k"))
    everything = Window.partitionBy()
    s = (
        s.withColumn("total", F.sum("source_size").over(everything))
        .withColumn("caps", F.sum("cap").over(by_ratio.rowsBetween(Window.unboundedPreceding, 0)) - F.col("cap"))
        .withColumn("rest", F.sum("weight").over(by_ratio.rowsBetween(0, Window.unboundedFollowing)))
        .withColumn("level", (F.col("total") - F.col("caps")) / F.col("rest"))
    )
    # the first source in this order that its level does not fill to its cap sets the level for all later ones
    level = F.min(F.when(F.col("level") * F.col("weight") <= F.col("cap"), F.struct(F.col("cap") / F.col("weight"), "k", "level"))).over(everything)
    s = s.withColumn("final", level["level"])
    target = F.least(F.col("cap").cast("double"), F.coalesce(F.col("final") * F.col("weight"), F.col("cap").cast("double")))
    return s.select("source", "source_size", target.alias("target"))


def mix(sizes: DataFrame, targets: DataFrame, seed: str = "mix", keep: tuple[str, ...] = (), max_copies: int = MAX_COPIES) -> DataFrame:
    """Copies of each document. ``sizes`` is a stored table (doc_id, source, size, *keep).

    Adds source_size, target, copies (0 .. ``max_copies``) and taken (copies * size).
    """
    expected = F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(F.lit(0.0))
    t = targets.withColumn("whole", F.least(F.floor(expected), F.lit(max_copies)).cast("bigint"))
    t = t.withColumn("p", F.greatest(expected - F.col("whole"), F.lit(0.0)))
    t = t.withColumn("left", F.col("target") - F.col("whole") * F.col("source_size")).withColumnRenamed("source", "t_source")
    t = cut_lineage(t)
    on_source = F.col("source").eqNullSafe(F.col("t_source"))
    u = uniform(F.col("doc_id"), seed)
    rank = (u / (1 - u)) / (F.col("p") / (1 - F.col("p")))
    d = sizes.join(t, on_source, "left").drop("t_source")
    d = d.withColumn("rank", F.when((F.col("p") > 0) & (F.col("left") > 0), rank))
    d = d.withColumn("bin", F.floor(F.col("rank") / (1 + F.col("rank")) * BINS))
    hist = d.where("bin is not null").groupBy("source", "bin").agg(F.sum("size").alias("words"), F.first("left").alias("left"))
    before = F.sum("words").over(Window.partitionBy("source").orderBy("bin")) - F.col("words")
    cut = hist.withColumn("before", before).where("before <= left and left < before + words")
    cut = cut.select(F.col("source").alias("c_source"), F.col("bin").alias("cut_bin"), "before")
    d = d.join(cut, F.col("source").eqNullSafe(F.col("c_source")), "left").drop("c_source")
    # no bin holds the cut: every ranked document is taken
    at_cut = F.col("bin").isNotNull() & F.col("cut_bin").isNotNull() & (F.col("bin") == F.col("cut_bin"))
    order = Window.partitionBy("source").orderBy("rank", F.col("doc_id").asc_nulls_last(), "size").rowsBetween(Window.unboundedPreceding, 0)
    inside = d.where(at_cut).withColumn("end", F.col("before") + F.sum("size").over(order))
    inside = inside.withColumn("extra", F.when(F.col("end") - F.col("size") / 2 <= F.col("left"), 1).otherwise(0)).drop("end")
    outside = d.where(~at_cut).withColumn("extra", F.when(F.col("bin").isNotNull() & (F.col("cut_bin").isNull() | (F.col("bin") < F.col("cut_bin"))), 1).otherwise(0))
    copies = F.least(F.col("whole") + F.col("extra"), F.lit(max_copies)).cast("bigint")
    both = outside.unionByName(inside).withColumn("copies", copies)
    return both.select("doc_id", "source", *keep, "size", "source_size", "target", "copies", (F.col("copies") * F.col("size")).alias("taken"))


def mix_documents(docs: DataFrame, seed: str = "mix") -> DataFrame:
    """The contract's mixture of ``docs`` (doc_id, text, source; further columns are ignored)."""
    size = F.size(words(F.col("text"))).cast("bigint")
    sizes = cut_lineage(docs.select("doc_id", "source", size.alias("size")))
    return mix(sizes, source_targets(sizes), seed)


ORACLE = r"""
with d as (select doc_id, source, len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+'))::bigint as size from documents),
s as (select source, sum(size)::bigint as source_size from d group by source),
w as (select *, row_number() over (order by encode(source) nulls last) - 1 as k from s),
c as (select *, (k % 3 + 1)::bigint as weight, source_size * 3 as cap from w),
-- every candidate set of capped sources, by ascending cap / weight
l as (select a.k, a.cap, a.weight, (select sum(source_size) from c)::bigint
        - coalesce((select sum(b.cap) from c b where (b.cap::double / b.weight, b.k) < (a.cap::double / a.weight, a.k)), 0)::bigint as remaining,
        (select sum(b.weight) from c b where (b.cap::double / b.weight, b.k) >= (a.cap::double / a.weight, a.k))::bigint as open_weight
      from c a),
f as (select first(remaining::double / open_weight order by cap::double / weight, k) as level from l where remaining::double / open_weight * weight <= cap),
t as (select source, source_size, least(cap::double, coalesce(level * weight, cap::double)) as target from c, f),
u as (select d.*, t.source_size, t.target, case when t.source_size > 0 then t.target / t.source_size else 0.0 end as e,
        (('0x' || substr(md5('mix:' || coalesce(doc_id::varchar, 'null')), 1, 13))::bigint + 0.5) / 4503599627370496.0::double as u
      from d join t on d.source is not distinct from t.source),
p as (select *, least(floor(e), 3)::bigint as whole from u),
r as (select *, greatest(e - whole, 0.0) as p, target - whole * source_size as room from p),
q as (select *, case when p > 0 and room > 0 then (u / (1 - u)) / (p / (1 - p)) end as rank from r),
z as (select *, sum(size) over (partition by source, rank is null order by rank, doc_id nulls last, size rows unbounded preceding) as ends from q)
select doc_id, source, size, source_size, target,
  least(whole + case when rank is not null and ends - size / 2.0 <= room then 1 else 0 end, 3)::bigint as copies,
  (least(whole + case when rank is not null and ends - size / 2.0 <= room then 1 else 0 end, 3) * size)::bigint as taken
from z
"""
