"""Words are cut by one pass over the characters, and are the contract's."""

import re

from pyspark.sql import functions as F

from martline.llm import decontaminate

TEXTS = ["", None, "  ", "abc", " x Y  Z ", "\0a B\x7fÉé  ζ-9\nA", "".join(map(chr, range(0x20, 0x250))) + "\t\0z", "🙂Q_q İ"]


def test_words_without_a_regular_expression(spark):
    df = spark.createDataFrame([(i, t) for i, t in enumerate(TEXTS)], "i int, text string")
    got = df.select("i", decontaminate.terms(F.col("text")).alias("w"))
    lower = {c: c + 32 for c in range(65, 91)}
    for row in got.collect():
        assert row.w == re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", (TEXTS[row.i] or "").translate(lower))
    assert "regexp" not in got._jdf.queryExecution().optimizedPlan().toString()
