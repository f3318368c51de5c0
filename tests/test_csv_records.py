"""Quoted line feeds in CSV files read by byte ranges, against Spark's whole-file reader."""

import csv
from random import Random

import pytest

from martline.sources import csv_records, files


def whole_file(spark, path):
    """First values as the reader gives them that takes a file in one task."""
    raw = spark.read.option("header", True).option("multiLine", True).option("escape", '"').csv(path)
    return sorted((r[0] for r in raw.collect()), key=str)



@pytest.fixture
def small_ranges(spark):
    """Ranges of 64 bytes, so that values, records and headers cross many of them."""
    old = {k: spark.conf.get(k) for k in ("spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes")}
    spark.conf.set("spark.sql.files.maxPartitionBytes", "64")
    spark.conf.set("spark.sql.files.openCostInBytes", "1")
    yield
    for k, v in old.items():
        spark.conf.set(k, v)


def write(path, rows, end="\n"):
    with open(path, "w", newline="") as f:
        csv.writer(f, lineterminator=end).writerows(rows)


@pytest.mark.parametrize("seed", range(6))
def test_random_files(spark, tmp_path, small_ranges, seed):
    draw = Random(seed)
    pool = ["a", "b", "key 1", 'say ""x""', "two\nlines", "l1\nl2\n\nl4", 'q"uote', "com,ma", "\n", "long " * 40, "x\n" * 50, "é日本", '"', 'a"\n"b,"c']
    value = lambda: draw.choice(pool[: 4 if seed == 0 else len(pool)])
    rows = [["head\ner" if seed % 2 else "id", "v", "w"]] + [[value() or "k", value(), value()] for _ in range(60)]
    write(tmp_path / "t.csv", rows, "\r\n" if seed == 3 else "\n")
    got = sorted((r.pk for r in files.first_column_rows(spark, str(tmp_path)).collect()), key=str)
    want = whole_file(spark, str(tmp_path / "t.csv"))
    assert got == [w for w in want if w is None or w.strip()] or got == want


def test_first_values_across_ranges(spark, tmp_path, small_ranges):
    """First values of thousands of characters run through many ranges; equal ones are counted as such."""
    big = "\n".join(f"line {i} with \"quotes\"" for i in range(200))
    write(tmp_path / "big.csv", [["k", "v"], [big, "1"], ["plain", "2"], [big, "3\n4"], [big + "x", "5"], ["plain", "6"]])
    (tmp_path / "lines.csv").write_text('k,v\n1,a\n1,"b, c"\n2,d\n')
    rep = files.folder_duplicates(spark, str(tmp_path), "2024-06-30").collect()
    assert sorted((r.excel_source, r.pk_num, r.number_of_dublicates) for r in rep) == [("big.csv", big, 2), ("big.csv", "plain", 2), ("lines.csv", "1", 2)]


def test_one_large_file_is_read_by_several_tasks(spark, tmp_path, small_ranges):
    write(tmp_path / "t.csv", [["k", "v"]] + [[str(i % 7), "two\nlines"] for i in range(200)])
    lines = csv_records.file_lines(spark, str(tmp_path))
    spanning = csv_records.spanning_files(lines)
    assert len(spanning) == 1
    values = csv_records.spanning_first_values(lines, spanning)
    assert values.rdd.getNumPartitions() > 10
    assert sorted(r.value for r in values.collect()) == sorted(str(i % 7) for i in range(200))


def test_files_without_spanning_values_stay_with_the_line_reader(spark, tmp_path):
    (tmp_path / "t.csv").write_text('k,v\n5" pipe,x\n"6"" pipe",y\n"a,b",z\n,w\n')
    assert csv_records.spanning_files(csv_records.file_lines(spark, str(tmp_path))) == []
    assert sorted((str(r.pk) for r in files.first_column_rows(spark, str(tmp_path)).collect())) == ['5" pipe', '6" pipe', "None", "a,b"]


def test_steps():
    step, out, first, later = csv_records.step, csv_records.OUT, csv_records.FIRST, csv_records.LATER
    assert [step(out, x) for x in ("a,b", '"a', 'a,"b', '"a","b"', '"a"",b', 'a"b,c"', '5",6"', '""', '"""', "")] == [out, first, later, out, first, out, out, out, first, out]
    assert [step(first, x) for x in ("a,b", 'a"', 'a"",b', 'a",b', 'a","b', 'a"b,"c')] == [first, out, first, out, later, later]
    assert [step(later, x) for x in ("a", 'a",b', 'a","')] == [later, out, later]
