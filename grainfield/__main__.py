"""Command lines: `python -m grainfield process ...` and `python -m grainfield evaluate ...`."""

from __future__ import annotations

import argparse
import importlib

from pyspark.sql import DataFrame, SparkSession


def _table(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.json(path) if path.endswith((".json", ".jsonl")) else spark.read.parquet(path)


def process(spark: SparkSession, args: argparse.Namespace) -> int:
    """Blocks (or images, read by an engine) to results, public output and a summary."""
    from pyspark.sql import functions as F

    from . import api, reports
    from .shipping import ship
    from .sources import readers, sinks

    if args.engine:
        ship(spark)
        module, _, name = args.engine.partition(":")
        pictures = readers.images(spark, args.input, limit=args.limit)
        blocks, known = readers.read_text(pictures, getattr(importlib.import_module(module), name)), pictures.select(F.col("document_id").alias("doc"))
    else:
        blocks = _table(spark, args.input)
        known = blocks.select(F.col("document_id").alias("doc")).distinct()
        known = known.orderBy("doc").limit(args.limit) if args.limit else known
        blocks = blocks.join(known.withColumnRenamed("doc", "document_id"), "document_id", "left_semi") if args.limit else blocks
    images = _table(spark, args.images) if args.images else known.withColumn("width", F.lit(float("inf"))).withColumn("height", F.lit(float("inf")))
    boxes = _table(spark, args.detections) if args.detections else spark.createDataFrame([], "doc string, det_idx long, class_name string, confidence double, x1 double, y1 double, x2 double, y2 double")
    dealers, models = readers.master_data(spark, args.master_data) if args.master_data else (None, None)
    truth = readers.truth_boxes(readers.pipeline_truth(spark, args.ground_truth)) if args.ground_truth else None
    results = api.process_documents(blocks, boxes, images, truth, _table(spark, args.timings) if args.timings else None, dealers, models)
    results.write.mode("overwrite").parquet(f"{args.output}/results")
    results = spark.read.parquet(f"{args.output}/results")
    sinks.write_json_array(results, f"{args.output}/extraction_results.json")
    sinks.write_json_array(sinks.public_json(results), f"{args.output}/output.json")
    summary = api.batch_summary(results).first().asDict()
    sinks.write_text(spark, f"{args.output}/summary.json", sinks.pretty(summary))
    print(reports.console(summary))
    return 0 if summary["successful"] else 1


def evaluate(spark: SparkSession, args: argparse.Namespace) -> int:
    """Results, and truth if given, to a report."""
    from . import reports
    from .sources import readers

    results = readers.flat_results(readers.results(spark, args.results))
    found = reports.write(results, args.output, readers.eval_truth(spark, args.ground_truth) if args.ground_truth else None, args.results)
    print(found["summary"]["overall_assessment"])
    for name, value in found["summary"]["key_metrics"].items():
        print(f"{name}: {value}")
    return 0


def main(argv: list[str] | None = None) -> int:
    parser = argparse.ArgumentParser(prog="grainfield", description="Fields of business documents, and their evaluation.")
    commands = parser.add_subparsers(required=True)
    one = commands.add_parser("process", help="extract, validate and summarise")
    one.add_argument("--input", "-i", required=True, help="blocks as Parquet or JSON lines; with --engine a folder of images")
    one.add_argument("--engine", help="module:function that yields the blocks of an image")
    one.add_argument("--output", "-o", default="output")
    one.add_argument("--images", help="images (doc, width, height)")
    one.add_argument("--detections", help="boxes that a detector found")
    one.add_argument("--timings", help="what the stages took on each document")
    one.add_argument("--master-data", help="JSON of known dealers and models")
    one.add_argument("--ground-truth", help="JSON of true fields and boxes")
    one.add_argument("--limit", type=int, default=0, help="first documents only; 0 takes all")
    one.set_defaults(run=process)
    two = commands.add_parser("evaluate", help="report on results")
    two.add_argument("--results", "-r", required=True)
    two.add_argument("--ground-truth", "-g")
    two.add_argument("--output", "-o", default="analysis_output")
    two.set_defaults(run=evaluate)
    args = parser.parse_args(argv)
    return args.run(SparkSession.builder.appName("grainfield").getOrCreate(), args)


if __name__ == "__main__":
    raise SystemExit(main())
