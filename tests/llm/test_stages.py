"""Pipeline stages leave other columns alone, whatever their names, and have a winner among repeated rows."""

import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from martline.llm import line_dedup

NAMES = ["label", "l_id", "_score", "_score_pad", "removed", "n_words", "n_hit", "items", "_w", "_found", "_u_digest", "_u_runs", "_u_again", "_u_id", "_g_id", "_g_key", "_g_n", "key", "bad_id", "bad_hash", "_key_hash", "copies", "rank", "n", "row"]
LINE = "one sentence of more than eight words that repeats here."


@pytest.fixture(scope="module")
def folder(spark, tmp_path_factory):
    spark.sparkContext.setCheckpointDir(str(tmp_path_factory.mktemp("ckpt")))
    d = tmp_path_factory.mktemp("tables")
    many = spark.range(120).select(F.col("id").alias("doc_id"), F.when(F.col("id") % 2 == 0, F.concat(F.lit("good plain words "), "id")).otherwise(F.lit("spam!! spam!!")).alias("text"))
    many.select("doc_id", (F.col("doc_id") % 2 == 0).cast("int").alias("quality")).write.parquet(f"{d}/labels.parquet")
    spark.createDataFrame([(1, " ".join(f"b{i}" for i in range(14)))], "item_id long, text string").write.parquet(f"{d}/benchmark.parquet")
    return str(d), many


def clashing(df):
    return df.select("doc_id", "text", F.length("text").cast("long").alias("n_chars"), *[F.concat(F.lit(f"{n} of "), F.coalesce(F.col("doc_id").cast("string"), F.lit("none"))).alias(n) for n in NAMES])


@pytest.mark.parametrize("name,stage", corpus_pipeline.STAGES[:-1])
def test_other_columns_are_left_alone(spark, folder, name, stage):
    d, many = folder
    bench = " ".join(f"b{i}" for i in range(14))
    more = spark.createDataFrame([(200, f"good plain words {bench}"), (201, None), (202, ""), (None, "good plain words of none"), (203, f"good plain words. {LINE} tail"), (204, f"good plain words here. {LINE} other"), (205, "good " * 60000)], "doc_id long, text string")
    docs = clashing(many.unionByName(more).unionByName(more.where("doc_id = 203")))
    got = stage(spark, docs, d)
    assert got.schema.names == docs.schema.names
    rows = got.collect()
    assert rows
    for r in rows:
        assert all(r[n] == f"{n} of {'none' if r.doc_id is None else r.doc_id}" for n in NAMES)
        assert r.text is None or r.n_chars == len(r.text)
    ids = [r.doc_id for r in rows]
    if name == "benchmark decontamination":
        assert 200 not in ids and len(ids) == docs.count() - 1
    if name == "quality classifier":
        assert {200, None} <= set(ids) and 1 not in ids
    if name == "n-gram Jaccard join":
        assert ids.count(203) == 1 and ids.count(1) == 1 and 3 not in ids
    assert stage(spark, docs.limit(0), d).count() == 0


def test_units_inside_differing_lines():
    cut = lambda text, runs: line_dedup.cut(text, runs)
    text = f"First. {LINE} Last words.\n\nshort a b\nshort c d\nshort e f"
    segments = [text[a:b] for a, b in line_dedup.segments_of(text)]
    assert segments == ["First. ", LINE + " ", "Last words.", "short a b", "short c d", "short e f"]
    assert {(i, j) for i, j, _ in line_dedup.units_of(text, 8)} == {(0, 1), (1, 1), (1, 2), (1, 3), (2, 4), (3, 5)}
    assert cut(text, [(1, 1)]) == ("First. Last words.\n\nshort a b\nshort c d\nshort e f", [(7, 8 + len(LINE))])
    assert cut(text, [(0, 2), (3, 4)])[0] == "\nshort e f"


def test_equal_rows_keep_their_units_once(spark, folder):
    text = f"{LINE}\nshort one\n{LINE} And a tail of it."
    docs = spark.createDataFrame([(5, text, "x"), (5, text, "y"), (5, "other text", "z"), (None, LINE, "n"), (4, None, "m")], "doc_id long, text string, removed string")
    got = line_dedup.clean_texts(docs).collect()
    assert sorted(str(r.text) for r in got) == sorted([f"{LINE}\nshort one\nAnd a tail of it.", "", "other text", "", "None"])
    assert {r.removed for r in got} == set("xyznm")


def test_the_winner_among_repeated_rows(spark, folder):
    from martline.llm import jaccard_join

    text = "a text of at least five words"
    docs = spark.createDataFrame([(1, text, "b"), (1, text, "a"), (2, text, "0")], "doc_id long, text string, tag string")
    assert [(r.doc_id, r.tag) for r in jaccard_join.keep_one_of_each(docs).collect()] == [(1, "a")]
    assert [(r.doc_id, r.tag) for r in jaccard_join.keep_one_of_each(docs.orderBy(F.desc("tag"))).collect()] == [(1, "a")]
