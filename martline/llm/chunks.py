"""Chunks: groups of whole documents that one task works on with numpy, and their exchange with hash partitions.

A chunk is all documents whose row hash falls into it: about CHUNK_BYTES of text, whatever the input's size. A
chunk pre-aggregates what it knows (each distinct hash once), sends it to the partitions of the hash space and gets
one answer per hash back. A value that a third of all documents hold is thus sent once a chunk, not once a document.
Answers match because a chunk's distinct hashes in ascending order are the same whenever it is computed again.
Partitions that a chunk has nothing for get no message, so messages never outnumber the distinct hashes of the chunks.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from martline.llm.common import total_bytes

CHUNK_BYTES = 8 << 20
MESSAGE = "chunk int, part int, kind string, data binary"
SCHEMA = pa.schema([("chunk", pa.int32()), ("part", pa.int32()), ("kind", pa.string()), ("data", pa.binary())])


def chunked(docs: DataFrame, chunk_bytes: int = CHUNK_BYTES) -> tuple[DataFrame, int]:
    """(doc_id, text, chunk) dealt by chunk, and the number of chunks. NULL text is empty."""
    n = max(1, math.ceil(total_bytes(docs) / chunk_bytes))
    text = F.coalesce(F.col("text"), F.lit(""))
    d = docs.select("doc_id", text.alias("text"))
    return d.withColumn("chunk", F.pmod(F.xxhash64("doc_id", "text"), F.lit(n)).cast("int")).repartition(n, "chunk"), n


def messages(rows: list[tuple[int, int, str, bytes]]) -> pa.Table:
    return pa.Table.from_arrays([pa.array([r[i] for r in rows], f.type) for i, f in enumerate(SCHEMA)], schema=SCHEMA)


def by_part(hashes: np.ndarray, parts: int) -> list[tuple[int, np.ndarray]]:
    """(partition, places of its hashes in the given order) for the partitions of the hash space that have any."""
    part = (hashes % np.uint64(parts)).astype(np.int64)
    order = np.argsort(part, kind="stable")
    present, first = np.unique(part[order], return_index=True)
    return list(zip(present.tolist(), np.split(order, first[1:])))
