from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from flowlab.__main__ import main
from flowlab.plans.queries_io import cic_flows
from flowlab.models import fit_gaussian_nb, load_model, save_model
from flowlab.session import DEFAULT_CONF, build_session, drop_folder, fresh_folder, shared_folder
from flowlab.sources import write_csv


def test_session_settings_and_shared_folder(spark):
    same = build_session("again")
    assert same is spark or same.sparkContext is spark.sparkContext
    assert all(spark.conf.get(k) == v for k, v in DEFAULT_CONF.items())
    path = fresh_folder(spark, "x")
    assert path.startswith(shared_folder(spark)) and path != fresh_folder(spark, "x")
    spark.range(3).write.parquet(path)
    drop_folder(spark, path)
    with pytest.raises(Exception, match="PATH_NOT_FOUND"):
        spark.read.parquet(path)
    with pytest.raises(ValueError, match="shared folder"):
        drop_folder(spark, "/somewhere/else")


def test_command_line_from_raw_csv_to_model(spark, sf, tmp_path, capsys):
    raw = cic_flows(spark, sf).fillna(0)
    write_csv(raw, f"{tmp_path}/raw")
    main(["prepare", f"{tmp_path}/raw", f"{tmp_path}/data", "--train-end", "2024-01-19", "--val-end", "2024-01-25"])
    train = spark.read.parquet(f"{tmp_path}/data/train")
    assert train.count() > 400 and train.select("flow_key").distinct().count() == train.count()
    assert train.filter(F.col("Label").isNull()).isEmpty()
    main(["train", f"{tmp_path}/data", f"{tmp_path}/models", "--families", "NB"])
    assert {"NB_SMOTE", "NB_Weighted"} <= set(capsys.readouterr().out.replace("|", " ").split())
    names = load_model(spark, f"{tmp_path}/models/best_model").features
    assert "pkt_rate" in names and "flow_key" not in names and "is_attack" not in names


def test_command_line_from_model_to_scores(spark, tmp_path, capsys):
    rows = spark.range(400).select(
        F.col("id").alias("flow_id"), (F.col("id") % 5).cast("double").alias("a"),
        (F.col("id") % 5 == 4).cast("int").alias("is_attack"))
    for part in ("train", "test"):
        rows.write.parquet(f"{tmp_path}/data/{part}")
    main(["train", f"{tmp_path}/data", f"{tmp_path}/models", "--key", "flow_id", "--families", "NB", "--no-smote"])
    assert "NB_Weighted" in capsys.readouterr().out
    model = f"{tmp_path}/models/best_model"
    assert load_model(spark, model).meta["ranking"]["best_pr_auc"] == "NB_Weighted"
    main(["info", model])
    assert "GaussianNaiveBayes" in capsys.readouterr().out
    main(["evaluate", model, f"{tmp_path}/data/test"])
    assert '"roc_auc": 1.0' in capsys.readouterr().out
    write_csv(rows, f"{tmp_path}/in")
    main(["batch", "-i", f"{tmp_path}/in", "-o", f"{tmp_path}/out", "-m", model])
    assert '"attacks_detected":80' in capsys.readouterr().out
    main(["stream", "-i", f"{tmp_path}/in", "-o", f"{tmp_path}/stream", "-m", model, "--checkpoint", f"{tmp_path}/cp"])
    assert spark.read.parquet(f"{tmp_path}/stream").filter("prediction = 1").count() == 80


def test_unlabeled_model_folder_overwrites(spark, tmp_path):
    rows = spark.range(20).select((F.col("id") % 2).cast("int").alias("is_attack"), F.col("id").cast("double").alias("x"))
    model = fit_gaussian_nb(rows, ["x"])
    for name in ("first", "second"):
        save_model(spark, model, f"{tmp_path}/m", {"model_name": name})
    assert load_model(spark, f"{tmp_path}/m").meta["model_name"] == "second"
