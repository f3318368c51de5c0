import datetime as dt
import os

import pytest

from martline import constants as K
from martline.operators import quality as Q
from martline.sources.files import FolderError, folder_duplicates

T0, T1 = dt.datetime(2024, 1, 1), dt.datetime(2024, 1, 2)


def test_duplicate_key_groups(spark):
    df = spark.createDataFrame(
        [(1, T0), (1, T0),            # duplicated within one load -> 1 group
         (2, T0), (2, T1),            # two loads -> fine
         (None, T0), (None, T0)],     # NULL first key never counts
        "id bigint, tech_load_ts timestamp")
    assert Q.duplicate_key_groups(df, ["id"]).first().validation_result == 1
    assert Q.null_key_rows(df, ["id"]).first().validation_result == 2


def test_key_check_report(spark):
    a = spark.createDataFrame([(1, T0), (1, T0)], "id bigint, tech_load_ts timestamp")
    b = spark.createDataFrame([(1, T0)], "id bigint, tech_load_ts timestamp")
    tables = {"a": Q.CheckedTable("a", a, ("id",)), "b": Q.CheckedTable("b", b, ("id",))}

    def resolve(name):
        if name not in tables:
            raise KeyError(name)
        return tables[name]

    cfg = [{"a": [K.RULE_DUPLICATE_CHECK, "not_a_rule"]}, {"b": [K.RULE_DUPLICATE_CHECK]}]
    rep = Q.key_check_report(cfg, resolve, "prod", "2024-06-30").collect()
    assert [(r.dm_table, r.validation_rule, r.validation_result, r.environment, r.date) for r in rep] == [
        ("a", K.RULE_DUPLICATE_CHECK, 1, "prod", "2024-06-30"), ("b", K.RULE_DUPLICATE_CHECK, 0, "prod", "2024-06-30")]
    with pytest.raises(KeyError):
        Q.key_check_report([{"zzz": [K.RULE_DUPLICATE_CHECK]}], resolve, "prod")


def test_folder_duplicates(spark, tmp_dir):
    folder = os.path.join(tmp_dir, "data")
    os.makedirs(folder)
    with open(os.path.join(folder, "a.csv"), "w") as f:
        f.write("id,v\n7,x\n7,y\n7,z\n8,w\n")          # 7 seen 3 times, 8 once
    with open(os.path.join(folder, "b.csv"), "w") as f:
        f.write("code,other,more\n1,a,b\n2,c,d\n")      # different header, no duplicates
    with open(os.path.join(folder, "notes.txt"), "w") as f:
        f.write("id\n1\n1\n")                             # not a dataset
    spark.createDataFrame([(5, "p"), (5, "q")], "k int, v string").repartition(2).write \
        .option("header", True).csv(os.path.join(folder, "c.csv"))  # part files across tasks
    rep = folder_duplicates(spark, folder, "2024-06-30").collect()
    assert sorted((r.excel_source, r.pk_num, r.number_of_dublicates) for r in rep) == [
        ("a.csv", "7", 3), ("c.csv", "5", 2)]


def test_folder_edge_cases(spark, tmp_dir):
    with pytest.raises(FolderError):
        folder_duplicates(spark, os.path.join(tmp_dir, "missing"))
    empty = os.path.join(tmp_dir, "empty")
    os.makedirs(empty)
    assert folder_duplicates(spark, empty).count() == 0
    with open(os.path.join(empty, "x.xlsx"), "w") as f:
        f.write("binary")
    assert folder_duplicates(spark, empty).count() == 0


def test_registry_resolver(spark):
    mm = spark.createDataFrame([(1, T0), (1, T0), (2, T0)], "transportation_number bigint, tech_load_ts timestamp")
    resolve = Q.registry_resolver({"metrics_main": mm})
    rep = Q.key_check_report([{"metrics_main": [K.RULE_DUPLICATE_CHECK]}], resolve, "prod", "2024-06-30").collect()
    assert [(r.dm_table, r.validation_result) for r in rep] == [("metrics_main", 1)]
    with pytest.raises(KeyError):
        resolve("plan_norm")          # known key, table not given
    with pytest.raises(KeyError):
        resolve("no_such_table")      # no key definition


def test_folder_names_with_spaces_and_plus(spark, tmp_dir):
    folder = os.path.join(tmp_dir, "my data+x")
    os.makedirs(folder)
    with open(os.path.join(folder, "a b+c.csv"), "w") as f:
        f.write("id\n1\n1\n")
    rep = folder_duplicates(spark, folder, "2024-06-30").collect()
    assert [(r.excel_source, r.pk_num, r.number_of_dublicates) for r in rep] == [("a b+c.csv", "1", 2)]
