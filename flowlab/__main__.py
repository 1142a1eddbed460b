"""Command line: prepare, train, evaluate, batch, stream, info."""

from __future__ import annotations

import argparse
import json

from flowlab.models.search import tune
from flowlab.models.store import load_model, model_info, save_model
from flowlab.operators import scaling, splitting
from flowlab.plans import jobs
from flowlab.session import build_session
from flowlab.streaming import csv_stream, stream_score


def parser() -> argparse.ArgumentParser:
    top = argparse.ArgumentParser(prog="flowlab")
    top.add_argument("--master")
    top.add_argument("--s3a", action="store_true", help="read and write s3a:// paths")
    sub = top.add_subparsers(dest="command", required=True)
    p = sub.add_parser("prepare", help="CSV flows to train, val and test feature tables")
    p.add_argument("src")
    p.add_argument("out")
    p.add_argument("--train-end", default=splitting.TRAIN_END)
    p.add_argument("--val-end", default=splitting.VAL_END)
    p.add_argument("--timestamp-format", action="append", default=[])
    p.add_argument("--remove-outliers", action="store_true")
    p = sub.add_parser("train", help="fit the model grid on feature tables and keep the best")
    p.add_argument("data")
    p.add_argument("out")
    p.add_argument("--key", default=jobs.KEY)
    p.add_argument("--families", nargs="+", default=["LR", "RF", "XGB"])
    p.add_argument("--no-smote", action="store_true")
    p.add_argument("--metric", default="pr_auc")
    p.add_argument("--run-log")
    p = sub.add_parser("tune", help="random search of boosted trees")
    p.add_argument("data")
    p.add_argument("out")
    p.add_argument("--trials", type=int, default=50)
    p = sub.add_parser("evaluate", help="scores of a stored model on a feature table")
    p.add_argument("model")
    p.add_argument("test")
    p = sub.add_parser("batch", help="score CSV flows")
    p.add_argument("--input", "-i", required=True)
    p.add_argument("--output", "-o", required=True)
    p.add_argument("--model", "-m", required=True)
    p.add_argument("--no-summary", action="store_true")
    p = sub.add_parser("stream", help="score CSV flows as they arrive in a folder")
    p.add_argument("--input", "-i", required=True)
    p.add_argument("--output", "-o", required=True)
    p.add_argument("--model", "-m", required=True)
    p.add_argument("--checkpoint", required=True)
    p.add_argument("--every", help="interval such as '10 seconds'; without it, what is there now")
    p = sub.add_parser("info", help="metadata of a stored model")
    p.add_argument("model")
    return top


def main(argv: list[str] | None = None) -> None:
    args = parser().parse_args(argv)
    spark = build_session("flowlab", master=args.master, s3a=args.s3a)
    read = spark.read.parquet
    if args.command == "prepare":
        paths = jobs.prepare_from_csv(
            spark, args.src, args.out, train_end=args.train_end, val_end=args.val_end,
            formats=args.timestamp_format, remove_outliers=args.remove_outliers)
        print(json.dumps(paths))
    elif args.command == "train":
        strategies = ("Weighted",) if args.no_smote else ("SMOTE", "Weighted")
        board, model = jobs.train_best(
            read(f"{args.data}/train"), read(f"{args.data}/test"), args.out, key=args.key, metric=args.metric,
            families=args.families, strategies=strategies, run_log=args.run_log)
        board.show(truncate=False)
        print(model.meta["model_name"])
    elif args.command == "tune":
        train, val = read(f"{args.data}/train"), read(f"{args.data}/val")
        features = jobs.feature_columns(train)
        trials, model = tune(train, val, features, n=args.trials, scaler=scaling.fit_scaler(train, features))
        trials.orderBy(trials.pr_auc.desc()).show(truncate=False)
        save_model(spark, model, args.out)
    elif args.command == "evaluate":
        print(json.dumps(dict(jobs.evaluate_saved(spark, args.model, read(args.test)))))
    elif args.command == "batch":
        report = jobs.run_batch(spark, args.input, args.model, args.output, not args.no_summary)
        if report is not None:
            print(report.toJSON().first())
    elif args.command == "stream":
        model = load_model(spark, args.model)
        schema = jobs.scoring_schema(spark, args.input, model.features)
        stream = csv_stream(spark, args.input, schema)
        stream_score(stream, model, args.output, args.checkpoint, args.every).awaitTermination()
    else:
        model_info(spark, args.model).show(truncate=False)


if __name__ == "__main__":
    main()
