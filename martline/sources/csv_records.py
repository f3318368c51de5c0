"""First values of CSV records whose quoted values hold line feeds, read by byte ranges.

A line feed ends a record only outside quotes, and whether a byte range starts inside quotes depends on all text
before it. Three scans settle it, each splittable:

1. ``spanning_files``: the files that have a line which, started outside quotes, ends inside a quoted value. In all
   other files every line is a record, by induction from the file's start, and any line-wise CSV reader will do.
2. For each range of the spanning files, how it maps the state before it to the state after it (outside, inside the
   first value of a record, inside a later value). Composed in file order, these maps give every range's start state.
3. Each range finds its own record starts and their first values. A first value that runs on into later ranges comes as
   one fragment a range; fragments are put together by value.

The maps (one row a range that holds a quote) are composed on the driver, which has planned these ranges anyway. Line
ends are LF or CR LF; a file with bare CR line ends whose quoted values hold line ends is not recognised.
Records of white space alone are skipped, as line-wise readers do.
"""

from __future__ import annotations

import re
from bisect import bisect_left
from collections.abc import Iterator
from itertools import groupby

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

OUT, FIRST, LATER = range(3)

#: A quoted value's content up to its closing quote; whole values, each with its comma; a line that ends in quotes.
_CONTENT = r'[^"]*+(?:""[^"]*+)*+'
_VALUES = rf'(?:(?:"{_CONTENT}"[^,]*+|[^",][^,]*+|),)*+'
ENDS_INSIDE = rf'^{_VALUES}"{_CONTENT}(?![\s\S])'
_content, _ends_inside = re.compile(_CONTENT), re.compile(ENDS_INSIDE)

_MAP = "file string, block long, from_out int, from_first int, from_later int, through boolean"


def step(state: int, line: str) -> int:
    """The state after ``line``, started in ``state``."""
    if '"' not in line:
        return state
    if state == OUT:
        if not _ends_inside.match(line):
            return OUT
        return FIRST if line[0] == '"' and _content.match(line, 1).end() == len(line) else LATER
    close = _content.match(line).end()
    if close == len(line):
        return state
    comma = line.find(",", close)
    return LATER if comma >= 0 and _ends_inside.match(line[comma + 1 :]) else OUT


def first_value(content: str, rest: str) -> str:
    """A quoted first value from its content and what follows the closing quote; text after that quote makes the quotes
    part of the value."""
    junk = rest.split(",", 1)[0].rstrip("\r")
    return f'"{content}"{junk}' if junk else content.replace('""', '"')


def file_lines(spark: SparkSession, folder: str) -> DataFrame:
    """(file, block, line) of every CSV file below ``folder``; rows of a range are in file order."""
    lines = spark.read.option("recursiveFileLookup", True).option("pathGlobFilter", "*.csv").option("lineSep", "\n").text(folder)
    return lines.select(F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("block"), F.col("value").alias("line"))


def spanning_files(lines: DataFrame) -> list[str]:
    """Files with a quoted value that holds a line feed (a list of file names, as the driver lists them to plan the scan)."""
    inside = lines.where(F.col("line").contains('"') & F.col("line").rlike(ENDS_INSIDE))
    return [r["file"] for r in inside.select("file").distinct().collect()]


def _ranges(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[tuple[str, int], Iterator[str]]]:
    """((file, block), its lines) of consecutive rows."""
    rows = (row for b in batches for row in zip(*(c.to_pylist() for c in b.columns)))
    for key, group in groupby(rows, key=lambda r: r[:2]):
        yield key, (r[2] for r in group)


def _maps(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    names = [f.split()[0] for f in _MAP.split(", ")]
    for (file, block), lines in _ranges(batches):
        after, through = [OUT, FIRST, LATER], True
        for line in lines:
            after = [step(s, line) for s in after]
            through = through and after[FIRST] == FIRST and _content.match(line).end() == len(line)
        yield pa.RecordBatch.from_pylist([dict(zip(names, (file, block, *after, through)))], pa.schema([("file", pa.string()), ("block", pa.int64()), ("from_out", pa.int32()), ("from_first", pa.int32()), ("from_later", pa.int32()), ("through", pa.bool_())]))


class Starts:
    """The state in which each range starts, and for one that starts in a first value, the range where that began."""

    def __init__(self, maps: list):
        self.after: dict[str, tuple[list[int], list[int], list[int]]] = {}
        for file, rows in groupby(sorted(maps, key=lambda r: (r["file"], r["block"])), key=lambda r: r["file"]):
            state, origin = OUT, -1
            blocks, states, origins = self.after.setdefault(file, ([], [], []))
            for r in rows:
                passed = state == FIRST and r["through"]
                state = (r["from_out"], r["from_first"], r["from_later"])[state]
                origin = (origin if passed else r["block"]) if state == FIRST else -1
                for values, value in zip((blocks, states, origins), (r["block"], state, origin)):
                    values.append(value)

    def before(self, file: str, block: int) -> tuple[int, int]:
        blocks, states, origins = self.after.get(file, ((), (), ()))
        k = bisect_left(blocks, block) - 1
        return (states[k], origins[k]) if k >= 0 else (OUT, -1)

    def cut_values(self) -> list[str]:
        """Files with a first value that reaches into another range (or is never closed)."""
        return [file for file, (_, states, _) in self.after.items() if FIRST in states]


def _first_values(starts: Starts, fragments: bool):
    """(file, block, origin, value): whole first values, or the fragments of those that run into other ranges."""
    schema = pa.schema([("file", pa.string()), ("block", pa.int64()), ("origin", pa.int64()), ("value", pa.string())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for (file, block), lines in _ranges(batches):
            state, origin = starts.before(file, block)
            header, pending, out = block == 0, [], []
            for line in lines:
                after = step(state, line)
                if state == OUT and line.strip():
                    skip, header = header, False
                    if line[0] != '"':
                        if not skip and not fragments:
                            out.append((file, block, None, line.split(",", 1)[0].rstrip("\r") or None))
                    else:
                        close = _content.match(line, 1).end()
                        if close < len(line):
                            if not skip and not fragments:
                                out.append((file, block, None, first_value(line[1:close], line[close + 1 :])))
                        else:
                            # a header is no value, wherever it ends
                            origin, pending = (-2 if skip else block), [line[1:]]
                elif state == FIRST:
                    close = _content.match(line).end()
                    pending.append(line if close == len(line) else line[:close])
                    if close < len(line):
                        if origin == block and not fragments:
                            out.append((file, block, None, first_value("\n".join(pending), line[close + 1 :])))
                        if origin >= 0 and origin != block and fragments:
                            out.append((file, block, origin, first_value_tail(pending, line[close + 1 :])))
                        pending, origin = [], -1
                state = after
            if pending and fragments and origin >= 0:
                out.append((file, block, origin, "\n".join(pending)))
            for at in range(0, len(out), 10_000):
                yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*out[at : at + 10_000]), schema)], schema=schema)

    return run


def first_value_tail(pending: list[str], rest: str) -> str:
    """The last fragment of a value with its closing quote and what follows up to the next comma."""
    return "\n".join(pending) + '"' + rest.split(",", 1)[0].rstrip("\r")


def spanning_first_values(lines: DataFrame, files: list[str]) -> DataFrame:
    """(file, value) per data record of ``files``, whose quoted values may hold line feeds."""
    schema = "file string, block long, origin long, value string"
    lines = lines.where(F.col("file").isin(files))
    starts = Starts(lines.where(F.col("line").contains('"')).mapInArrow(_maps, _MAP).collect())
    values = lines.mapInArrow(_first_values(starts, False), schema).select("file", "value")
    cut = starts.cut_values()
    if not cut:
        return values
    pieces = lines.where(F.col("file").isin(cut)).mapInArrow(_first_values(starts, True), schema)
    whole = pieces.groupBy("file", "origin").agg(F.array_join(F.transform(F.sort_array(F.collect_list(F.struct("block", "value"))), lambda p: p["value"]), "\n").alias("text"))
    content = F.regexp_extract("text", f"^({_CONTENT})", 1)
    junk = F.expr("substr(text, length(content) + 2)")
    value = F.when(F.length("junk") > 0, F.concat(F.lit('"'), "text")).otherwise(F.replace("content", F.lit('""'), F.lit('"')))
    return values.unionByName(whole.withColumn("content", content).withColumn("junk", junk).select("file", value.alias("value")))
