from __future__ import annotations

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from flowlab.plans import jobs
from flowlab.schema import CIC_SCHEMA
from flowlab.session import fresh_folder
from flowlab.sources import (
    from_json_flows,
    read_flows_csv,
    read_scoring_csv,
    to_json_flows,
    write_csv,
    write_parquet,
)

SMALL = T.StructType().add("Dst Port", T.IntegerType()).add("Protocol", T.IntegerType()).add("Flow Byts/s", T.DoubleType())


def put(path, text):
    path.write_text(text)
    return str(path)


def test_repeated_header_goes_and_special_values_parse(spark, tmp_path):
    path = put(tmp_path / "hdr.csv", "Dst Port,Protocol,Flow Byts/s\n80,6,Infinity\n443,17,NaN\n"
               "Dst Port,Protocol,Flow Byts/s\n22,6,inf\n")
    df = read_flows_csv(spark, path, SMALL)
    rows = {r[0]: r[2] for r in df.collect()}
    assert set(rows) == {80, 443, 22}
    assert rows[80] == float("inf") and rows[443] != rows[443] and rows[22] is None
    assert df.count() == 3
    assert read_flows_csv(spark, path, SMALL, drop_repeated_headers=False).count() == 4


def test_repeated_header_with_text_columns(spark, tmp_path):
    schema = T.StructType().add("n", T.IntegerType()).add("Label", T.StringType())
    path = put(tmp_path / "t.csv", "n,Label\n1,Benign\nn,Label\n2,Bot\n")
    assert sorted(r.n for r in read_flows_csv(spark, path, schema).collect()) == [1, 2]


def test_swapped_columns_fail_unless_allowed(spark, tmp_path):
    path = put(tmp_path / "swap.csv", "Protocol,Dst Port,Flow Byts/s\n6,80,1.5\n")
    with pytest.raises(Exception, match="CSV header"):
        read_flows_csv(spark, path, SMALL).collect()
    assert read_flows_csv(spark, path, SMALL, strict_header=False).first()[0] == 6


def test_broken_rows_can_be_kept(spark, tmp_path):
    path = put(tmp_path / "bad.csv", "Dst Port,Protocol,Flow Byts/s\n80,6,1.0\nx,6,2.0\n")
    df = read_flows_csv(spark, path, SMALL, keep_corrupt=True)
    assert [r["_corrupt_record"] for r in df.collect()] == [None, "x,6,2.0"]


def test_scoring_csv_matches_by_name(spark, tmp_path):
    path = put(tmp_path / "s.csv", "label,b,a,id\nBot,2,1,7\n")
    df = read_scoring_csv(spark, path, ["a", "b", "absent"], keep=["id"])
    assert df.columns == ["id", "a", "b", "absent"] and tuple(df.first()) == ("7", 1.0, 2.0, 0)


def test_json_of_one_request_fills_missing_features_with_null(frame):
    df = frame([('{"Flow Duration": 5.0, "Tot Fwd Pkts": 3}',), ("{broken",)], "body string")
    out = from_json_flows(df, "body", CIC_SCHEMA)
    rows = out.select("Flow Duration", "Tot Fwd Pkts", "Tot Bwd Pkts").collect()
    assert tuple(rows[0]) == (5.0, 3, None) and tuple(rows[1]) == (None, None, None)
    assert to_json_flows(out, ["Flow Duration"]).first().json == '{"Flow Duration":5.0}'


def test_names_with_slash_and_blanks_round_trip(frame, spark, tmp_path):
    df = frame([(1.5, " x ")], "`Flow Byts/s` double, `a b` string")
    write_parquet(df, f"{tmp_path}/p")
    write_csv(df, f"{tmp_path}/c")
    assert spark.read.parquet(f"{tmp_path}/p").collect() == df.collect()
    assert read_flows_csv(spark, f"{tmp_path}/c", df.schema).collect() == df.collect()


def test_prepare_from_csv_to_feature_tables(spark, tmp_path):
    base = {f.name: F.lit(1).cast(f.dataType) for f in CIC_SCHEMA.fields}
    days = ["14/02/2018 08:00:00", "21/02/2018 09:30:00", "01/03/2018 10:00:00", "14/02/2018 08:00:00"]
    df = spark.createDataFrame([(d,) for d in days], "t string").select(
        *[(F.col("t") if n == "Timestamp" else F.lit(" BENIGN ") if n == "Label" else c).alias(n) for n, c in base.items()])
    write_csv(df, f"{tmp_path}/raw")
    paths = jobs.prepare_from_csv(spark, f"{tmp_path}/raw", f"{tmp_path}/out", formats=["dd/MM/yyyy HH:mm:ss"])
    tables = {p: spark.read.parquet(path) for p, path in paths.items()}
    assert {p: t.count() for p, t in tables.items()} == {"train": 1, "val": 1, "test": 1}
    row = tables["val"].first()
    assert (row.Label, row.is_attack, row.hour_of_day) == ("BENIGN", 0, 9)


def test_lines_are_cut_before_they_are_parsed(spark):
    from flowlab.sources import count_lines, slice_lines

    schema = T.StructType().add("Port", T.IntegerType()).add("Time", T.StringType()).add("Label", T.StringType())
    root = fresh_folder(spark, "lines")
    lines = ["Port,Time,Label", "80,2018-03-02 09:15:00,Bot", "81,2018-03-02 09:14:59,Bot", '82,"2018-03-02 09:20:01","a, b"', "83,02/03/2018 09:20:00,Bot",
             "Port,Time,Label", "", "84", "x,2018-03-02 09:30:00,Bot", "85,2018-03-02 09:46:00,Bot", "86,2018-03-02 09:45:59,Benign"]
    spark.createDataFrame([(x,) for x in lines], "value string").write.text(root)
    args = (root, "2018-03-02 09:15:00", "2018-03-02 09:46:00", schema)
    assert {tuple(r) for r in slice_lines(spark, *args, ts="Time").collect()} == {
        (80, "2018-03-02 09:15:00", "Bot"), (82, "2018-03-02 09:20:01", "a, b"), (86, "2018-03-02 09:45:59", "Benign")}
    assert {r.kind: r.n for r in count_lines(spark, *args, ts="Time").collect()} == {"header": 2, "bad": 3, "inside": 3, "outside": 2}
    some = slice_lines(spark, *args, ts="Time", pattern=r"2018-03-02 09:(1[5-9]|[2-3][0-9]):")
    assert {r.Port for r in some.collect()} == {80, 82}


def test_bucketed_tables_join_without_a_shuffle(spark):
    from flowlab.operators.joins import join_labels
    from flowlab.sources import read_bucketed, write_bucketed

    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        left, right = fresh_folder(spark, "left"), fresh_folder(spark, "right")
        a = write_bucketed(spark.range(500).selectExpr("id * 3 AS k", "id AS a"), left, "bucketed_a", "k", 8)
        b = write_bucketed(spark.range(500).selectExpr("id * 2 AS k", "id AS b"), right, "bucketed_b", "k", 8)
        joined = join_labels(a, b, "k")
        plan = joined._jdf.queryExecution().executedPlan().toString()
        assert "Exchange" not in plan and "SortMergeJoin" in plan
        assert joined.count() == 167
        spark.sql("DROP TABLE bucketed_b")
        again = join_labels(a, read_bucketed(spark, right, "bucketed_b", "k", 8), "k")
        assert "Exchange" not in again._jdf.queryExecution().executedPlan().toString() and again.count() == 167
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
        for name in ("bucketed_a", "bucketed_b"):
            spark.sql(f"DROP TABLE IF EXISTS {name}")
