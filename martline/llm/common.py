"""Helpers shared by the corpus operators."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: Words of the quality, mixing and language-model contracts: runs of anything but ASCII white space.
WORD = r"[^\x20\x09-\x0D]+"
#: A table is broadcast only if its stored bytes are proven to be at most this many.
BROADCAST_BYTES = 32 << 20


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One input table as stored (read through Spark, so any file system works)."""
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def let(value: Column, body) -> Column:
    """Bind ``value`` once and evaluate ``body(value)`` on it (a lambda over a one-element array)."""
    return F.transform(F.array(value), body)[0]


def words(text: Column, pattern: str = WORD) -> Column:
    """All words of a text in order; NULL has none."""
    return F.regexp_extract_all(F.coalesce(text, F.lit("")), F.lit(pattern), F.lit(0))


def total_bytes(docs: DataFrame, text_col: str = "text") -> int:
    """UTF-8 bytes of all texts (one column scan; sizes the partitions of a job)."""
    return docs.agg(F.sum(F.octet_length(text_col)).alias("b")).first()["b"] or 0


def sized_broadcast(df: DataFrame, string_cols: tuple[str, ...] = (), row_bytes: int = 64) -> DataFrame:
    """Mark a *stored* table for broadcast if its size is proven to be within BROADCAST_BYTES.

    The size is ``row_bytes`` a row plus the bytes of ``string_cols``, summed by one aggregate over the
    stored table. A larger table is returned unmarked, and the planner joins by shuffle.
    """
    n = F.count(F.lit(1)) * F.lit(row_bytes)
    for c in string_cols:
        n = n + F.coalesce(F.sum(F.octet_length(c)), F.lit(0))
    return F.broadcast(df) if df.agg(n.alias("b")).first()["b"] <= BROADCAST_BYTES else df


def unclashed(docs: DataFrame, operator, *added: str) -> DataFrame:
    """``operator(docs)`` with its other columns than doc_id and text under names that cannot clash with the operator's
    own, then the columns of ``docs`` and those ``added``."""
    private = {c: f"__column_{i}" for i, c in enumerate(docs.columns) if c not in ("doc_id", "text")}
    out = operator(docs.withColumnsRenamed(private))
    mine = [F.col(private.get(c, c)).alias(c) for c in docs.columns if c not in added]
    return out.select(*mine, *added)
