"""Readers of images, truth, master data, results, annotations and recognised text. All read through Spark's own sources."""

from __future__ import annotations

from collections.abc import Callable, Iterator

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.bank import DETECTOR_EXTENSIONS, IMAGE_EXTENSIONS

BLOCKS = "document_id string, idx int, text string, bbox array<int>, confidence double, language string, block_num int, line_num int, word_num int"
PRESENT = "struct<present:boolean>"
BOXED = "struct<present:boolean,bbox:array<double>>"
EVAL_TRUTH = f"map<string,struct<fields:struct<dealer_name:string,model_name:string,horse_power:double,asset_cost:double,signature:{PRESENT},stamp:{PRESENT}>>>"
RESULTS = (
    f"doc_id string, fields struct<dealer_name:string,model_name:string,horse_power:double,asset_cost:double,signature:{BOXED},stamp:{BOXED}>, confidence double, processing_time_sec double, "
    "cost_estimate_usd double, status string, error string, processing_details struct<ocr_time_sec:double,extraction_time_sec:double,detection_time_sec:double,vlm_time_sec:double,vlm_used:boolean>"
)


def images(spark: SparkSession, directory: str, extensions: tuple[str, ...] = IMAGE_EXTENSIONS, limit: int = 0) -> DataFrame:
    """Image files of a directory by path, each once; limit 0 reads all. Content is read only if used."""
    found = spark.read.format("binaryFile").load(directory).filter(F.lower(F.regexp_extract("path", r"\.([^./]+)$", 1)).isin(*extensions))
    found = found.select(F.regexp_extract("path", r"([^/]+?)(\.[^./]*)?$", 1).alias("document_id"), "path", "length", "content").orderBy("path")
    return found.limit(limit) if limit else found


def detector_images(spark: SparkSession, directory: str) -> DataFrame:
    return images(spark, directory, DETECTOR_EXTENSIONS)


def _map_rows(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """A JSON object by key as rows (document_id, value); malformed files give no rows. A file is one value on one executor, so it must fit there: truth and master data do, larger data belongs in JSON lines or Parquet."""
    text = spark.read.text(path, wholetext=True)
    return text.select(F.explode(F.from_json("value", schema)).alias("document_id", "value"))


def pipeline_truth(spark: SparkSession, path: str) -> DataFrame:
    """Flat truth with boxes."""
    schema = "map<string,struct<dealer_name:string,model_name:string,horse_power:double,asset_cost:double,signature_bbox:array<double>,stamp_bbox:array<double>>>"
    return _map_rows(spark, path, schema).select("document_id", "value.*")


def eval_truth(spark: SparkSession, path: str) -> DataFrame:
    """Truth nested under fields."""
    rows = _map_rows(spark, path, EVAL_TRUTH).select("document_id", "value.fields.*")
    return rows.withColumn("signature_present", F.col("signature.present")).withColumn("stamp_present", F.col("stamp.present")).drop("signature", "stamp")


def truth_boxes(truth: DataFrame) -> DataFrame:
    """Boxes (doc, class_name, x1, y1, x2, y2) of pipeline_truth(); documents without a box of a class have no row for it."""
    parts = [truth.select(F.col("document_id").alias("doc"), F.lit(c).alias("class_name"), *(F.get(f"{c}_bbox", F.lit(i)).alias(k) for i, k in enumerate(("x1", "y1", "x2", "y2")))) for c in ("signature", "stamp")]
    return parts[0].union(parts[1]).filter("x1 is not null and y1 is not null and x2 is not null and y2 is not null")


def master_data(spark: SparkSession, path: str) -> tuple[DataFrame, DataFrame]:
    """Known dealers and models, one column each."""
    row = spark.read.schema("dealers array<string>, models array<string>").json(path, multiLine=True)
    return row.select(F.explode("dealers").alias("dealer")).distinct(), row.select(F.explode("models").alias("model")).distinct()


def results(spark: SparkSession, path: str) -> DataFrame:
    """Evaluator results, a JSON array."""
    return spark.read.schema(RESULTS).json(path, multiLine=True)


def flat_results(rows: DataFrame) -> DataFrame:
    """results() as the columns that evaluation reads; absent parts are null, absent flags false."""
    flags = [F.coalesce(F.col(f"fields.{s}.present"), F.lit(False)).alias(f"{s}_present") for s in ("signature", "stamp")]
    boxed = [F.coalesce(F.size(f"fields.{s}.bbox") > 0, F.lit(False)).alias(f"{s}_boxed") for s in ("signature", "stamp")]
    times = [F.col(f"processing_details.{s}_time_sec").alias(f"{s}_time_sec") for s in ("ocr", "extraction", "detection", "vlm")]
    used = F.coalesce(F.col("processing_details.vlm_used"), F.lit(False)).alias("vlm_used")
    fields = [F.col(f"fields.{f}").alias(f) for f in ("dealer_name", "model_name", "horse_power", "asset_cost")]
    return rows.select("doc_id", "status", "confidence", "processing_time_sec", "cost_estimate_usd", "error", used, *times, *fields, *flags, *boxed)


def annotations(spark: SparkSession, path: str) -> DataFrame:
    """Boxes by image and class; missing or broken files give none."""
    rows = _map_rows(spark, path, "map<string,struct<signatures:array<array<double>>,stamps:array<array<double>>,image_path:string>>")
    boxes = [rows.select(F.col("document_id").alias("image"), F.lit(c).alias("class_name"), F.posexplode(f"value.{c}s").alias("det_idx", "bbox")) for c in ("signature", "stamp")]
    return boxes[0].union(boxes[1])


def read_text(pictures: DataFrame, engine: Callable[[str, bytes], Iterator[dict]] | None = None) -> DataFrame:
    """Blocks of each image by a pluggable engine that yields rows of BLOCKS; without one there are no blocks.

    A picture that the engine fails on, in whatever way, gives no blocks and stays visible to an outer join, where it counts as failed.
    """

    def run(parts):
        import pandas as pd

        names = [c.split()[0] for c in BLOCKS.split(", ")]
        for part in parts:
            rows = []
            for doc, content in zip(part["document_id"], part["content"], strict=True):
                try:
                    rows += [{"document_id": doc, **b} for b in (engine(doc, content) if engine else ())]
                except Exception:  # noqa: BLE001  a bad picture must not end the job
                    continue
            yield pd.DataFrame(rows, columns=names)

    return pictures.select("document_id", "content").mapInPandas(run, BLOCKS)
