"""One row of each group stays, whatever ids the groups share."""

import pytest

from martline.llm import jaccard_join


@pytest.fixture(scope="module", autouse=True)
def checkpoints(spark, tmp_path_factory):
    spark.sparkContext.setCheckpointDir(str(tmp_path_factory.mktemp("ckpt")))


def long_text(name):
    return " ".join(f"{name}{i}" for i in range(60))


def test_groups_keep_a_row_each(spark):
    a, b, c, d = (long_text(x) for x in "abcd")
    rows = [
        (1, a, "x"), (1, b, "x"),  # unrelated texts share an id
        (2, a.replace("a30", "other"), "x"),  # near copy of a
        (None, c, "x"), (None, d, "x"), (None, d, "x"),  # groups of NULL ids only
        (5, long_text("e"), "x"), (5, long_text("e"), "y"), (6, long_text("e"), "x"),  # repeated rows
        (None, None, "x"), (None, "", "x"), (7, " ", "x"),  # without shingles: each a group of its own
    ]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string")
    got = jaccard_join.keep_one_of_each(docs)
    assert got.columns == docs.columns
    kept = sorted(((r.doc_id, r.text) for r in got.collect()), key=str)
    want = [(1, a), (1, b), (None, c), (None, d), (5, long_text("e")), (None, None), (None, ""), (7, " ")]
    assert kept == sorted(want, key=str)


def test_null_id_yields_to_a_known_one(spark):
    docs = spark.createDataFrame([(None, long_text("a")), (9, long_text("a"))], "doc_id long, text string")
    assert [r.doc_id for r in jaccard_join.keep_one_of_each(docs).collect()] == [9]
