"""Command line: the listing jobs on your own files (``python -m homestat <job> ...``).

Jobs, in pipeline order:
  clean       raw CSV            -> cleaned table (Parquet, or CSV with --csv)
  eda         cleaned            -> batch views by_type, by_district, price_dist, by_legal, by_direction
  kmeans      cleaned            -> clustered, cluster_stats
  regression  cleaned            -> lr_metrics, lr_coefficients, lr_predictions, lr_category_map, lr_model_params
  publish     cleaned            -> envelope files (or a Kafka topic)
  stream      envelope files / Kafka -> speed folder (append) + live aggregate (console)
  warehouse   cleaned [+ speed]  -> catalog tables, statistics and merged view
  serve       root folder        -> speed views, merged views, speed summary
  batch       raw CSV            -> everything above except the stream, under one root
"""

from __future__ import annotations

import argparse
import json

from homestat.constants import PREDICTION_ROWS
from homestat.operators import clean as C
from homestat.operators import ml as M
from homestat.operators import views as V
from homestat.plans import flows
from homestat.plans import warehouse as W
from homestat.session import build_session
from homestat.sources import files as SF
from homestat.sources import sinks as SK
from homestat.streaming import speed as ST


def _print(obj) -> None:
    print(json.dumps(obj, ensure_ascii=False, default=str))


def main(argv: list[str] | None = None, spark=None) -> None:
    p = argparse.ArgumentParser(prog="homestat")
    p.add_argument("--master", default=None, help="Spark master (default: from spark-submit)")
    sub = p.add_subparsers(dest="job", required=True)

    a = sub.add_parser("clean")
    a.add_argument("--input", required=True)
    a.add_argument("--output", required=True)
    a.add_argument("--csv", action="store_true", help="write CSV with header instead of Parquet")
    a.add_argument("--splittable", action="store_true", help="no quoted field has a line break: Spark may split files")

    for name in ("eda", "kmeans", "regression"):
        a = sub.add_parser(name)
        a.add_argument("--input", required=True, help="cleaned Parquet folder")
        a.add_argument("--output", required=True, help="batch views folder")

    a = sub.add_parser("publish")
    a.add_argument("--input", required=True)
    a.add_argument("--output", help="envelope files folder")
    a.add_argument("--kafka", help="bootstrap servers")
    a.add_argument("--topic")

    a = sub.add_parser("stream")
    a.add_argument("--source", help="envelope files folder")
    a.add_argument("--kafka", help="bootstrap servers")
    a.add_argument("--topic")
    a.add_argument("--output", required=True, help="speed Parquet folder")
    a.add_argument("--checkpoint", required=True)
    a.add_argument("--trigger", default=None, help="e.g. '2 seconds'; omit to process what is available and stop")
    a.add_argument("--max-offsets", type=int, default=None, help="Kafka records per micro-batch at most")
    a.add_argument("--max-files", type=int, default=None, help="envelope files per micro-batch at most")

    a = sub.add_parser("warehouse")
    a.add_argument("--db", default="listings")
    a.add_argument("--listings", required=True)
    a.add_argument("--speed", default=None)
    a.add_argument("--location", default=None, help="folder for the database and its tables")

    a = sub.add_parser("serve")
    a.add_argument("--root", required=True, help="folder with cleaned/, batch/, speed/")

    a = sub.add_parser("batch")
    a.add_argument("--input", required=True, help="raw CSV")
    a.add_argument("--root", required=True)
    a.add_argument("--no-models", action="store_true")

    args = p.parse_args(argv)
    own_session = spark is None
    if own_session:
        spark = build_session(args.master, app=f"homestat-{args.job}")

    if args.job == "clean":
        clean = C.clean_listings(SF.read_raw_csv(spark, args.input, multiline=not args.splittable))
        (SK.write_csv if args.csv else SK.write_parquet)(clean, args.output)
        written = SF.read_clean(spark, args.output, fmt="csv" if args.csv else "parquet")
        _print(C.clean_summary(written).first().asDict())
    elif args.job == "eda":
        clean = SF.read_clean(spark, args.input)
        for name, report in V.BATCH_VIEWS.items():
            SK.write_parquet(report.over(clean), f"{args.output}/{name}")
        _print({"views": len(V.BATCH_VIEWS)})
    elif args.job == "kmeans":
        seg = M.segments(SF.read_clean(spark, args.input))
        SK.write_parquet(seg.clustered, f"{args.output}/clustered")
        SK.write_parquet(seg.stats_named, f"{args.output}/cluster_stats")
        _print([r.asDict() for r in spark.read.parquet(f"{args.output}/cluster_stats").collect()])
    elif args.job == "regression":
        pm = M.train_price_model(SF.read_clean(spark, args.input))
        outs = {"lr_metrics": M.metrics(pm), "lr_coefficients": M.coefficients(pm),
                "lr_predictions": M.predictions(pm, PREDICTION_ROWS), "lr_category_map": M.category_map(pm),
                "lr_model_params": M.model_params(pm)}
        for name, df in outs.items():
            SK.write_parquet(df, f"{args.output}/{name}")
        _print([r.asDict() for r in spark.read.parquet(f"{args.output}/lr_metrics").collect()])
    elif args.job == "publish":
        clean = SF.read_clean(spark, args.input)
        if args.kafka:
            SK.write_kafka(clean, args.kafka, args.topic)
        else:
            ST.to_envelope(clean).write.mode("append").parquet(args.output)
        _print({"published": clean.count()})
    elif args.job == "stream":
        source = (ST.read_kafka(spark, args.kafka, args.topic, args.max_offsets) if args.kafka
                  else ST.read_envelope_files(spark, args.source, max_files_per_trigger=args.max_files))
        queries = ST.run_speed_layer(spark, source, args.output, args.checkpoint, trigger=args.trigger)
        if args.trigger is not None:
            try:
                spark.streams.awaitAnyTermination()
            finally:
                for q in queries:
                    q.stop()
    elif args.job == "warehouse":
        _print(W.publish(spark, args.db, args.listings, args.speed, args.location))
    elif args.job == "serve":
        _print(flows.serve(spark, args.root))
    elif args.job == "batch":
        report = flows.batch(spark, SF.read_raw_csv(spark, args.input), args.root, with_models=not args.no_models)
        _print({r["output"]: r["rows"] for r in report.collect()})
    if own_session:
        spark.stop()


if __name__ == "__main__":
    main()
