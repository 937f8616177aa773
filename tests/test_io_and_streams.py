import json

from pyspark.sql import functions as F

from grainfield.sources import readers, sinks
from grainfield.streaming import progress


def test_images_by_path_with_limit(spark, tmp_path):
    for name in ("b.PNG", "a.jpg", "c.txt", "d.tif"):
        (tmp_path / name).write_bytes(b"x")
    assert [r["document_id"] for r in readers.images(spark, f"file://{tmp_path}").collect()] == ["a", "b", "d"]
    assert [r["document_id"] for r in readers.detector_images(spark, f"file://{tmp_path}").collect()] == ["a", "b"]
    assert readers.images(spark, f"file://{tmp_path}", limit=1).count() == 1


def test_truth_master_results_annotations(spark, tmp_path):
    files = {
        "flat": {"d1": {"dealer_name": "A", "horse_power": 50, "signature_bbox": [1, 2, 3, 4]}, "d2": {"dealer_name": None}},
        "nested": {"d1": {"fields": {"dealer_name": "A", "signature": {"present": True}}}},
        "master": {"dealers": ["A", "B"], "models": ["575"]},
        "results": [{"doc_id": "d1", "fields": {"dealer_name": "A"}, "confidence": 0.5, "status": "success"}],
        "boxes": {"i1": {"signatures": [[1, 2, 3, 4]], "stamps": []}},
    }
    for name, value in files.items():
        (tmp_path / name).write_text(json.dumps(value, indent=1))
    (tmp_path / "broken").write_text("{")
    path = lambda n: f"file://{tmp_path}/{n}"
    assert {r["document_id"]: r["horse_power"] for r in readers.pipeline_truth(spark, path("flat")).collect()} == {"d1": 50.0, "d2": None}
    assert readers.eval_truth(spark, path("nested")).first()["signature_present"] is True
    dealers, models = readers.master_data(spark, path("master"))
    assert dealers.count() == 2 and models.first()["model"] == "575"
    assert readers.results(spark, path("results")).first()["fields"]["dealer_name"] == "A"
    assert readers.annotations(spark, path("boxes")).count() == 1
    assert readers.annotations(spark, path("broken")).count() == 0


def test_pluggable_reader_and_its_failures(spark, tmp_path):
    def engine(doc, content):
        if doc == "bad":
            raise ValueError(doc)
        return [{"idx": 0, "text": content.decode(), "bbox": [0, 0, 1, 1], "confidence": 0.5, "language": "eng", "block_num": 1, "line_num": 1, "word_num": 1}]

    pictures = spark.createDataFrame([("ok", b"hello"), ("bad", b"")], "document_id string, content binary")
    assert [r["text"] for r in readers.read_text(pictures, engine).collect()] == ["hello"]
    assert readers.read_text(pictures).count() == 0


def test_sinks(spark, tmp_path):
    flat = spark.createDataFrame([("d", "A", 0.91234, "M", 0.5, 50.0, 0.5, 1, 0.5, 0.71239, "success", True, 0.0, False, 0.5)], "document_id string, dealer_name string, dealer_conf double, model_name string, model_conf double, horse_power double, hp_conf double, asset_cost long, cost_conf double, overall_confidence double, status string, signature_present boolean, signature_iou double, stamp_present boolean, stamp_iou double")
    out = json.loads(sinks.public_json(flat).first()["value"])
    assert out["dealer_name"] == {"value": "A", "confidence": 0.9123} and out["signature"]["iou"] is None and out["stamp"]["iou"] == 0.5
    sinks.write_labels(spark.createDataFrame([("i", "0 0.5"), ("i", "1 0.5")], "image string, line string"), f"file://{tmp_path}/labels")
    assert spark.read.text(f"file://{tmp_path}/labels/image=i").count() == 2
    sinks.write_report({"a": flat.select("document_id")}, f"file://{tmp_path}/report")
    assert spark.read.json(f"file://{tmp_path}/report/a").count() == 1
    sinks.write_json_array(flat.select("document_id", "stamp_iou"), f"file://{tmp_path}/all.json")
    assert json.loads((tmp_path / "all.json").read_text()) == [{"document_id": "d", "stamp_iou": 0.5}]


def test_stream_equals_batch(spark, tmp_path):
    events = spark.read.parquet("/root/testdata/sf0.001/events.parquet")
    events.repartition(3).write.parquet(f"file://{tmp_path}/in")
    schema = "event_id long, ts timestamp, user_id long, event_type string, value double, props string"
    run = lambda rows: rows.groupBy("event_type").agg(F.count("*").alias("n"))
    progress.batches(spark, f"file://{tmp_path}/in", schema, run, f"file://{tmp_path}/out", f"file://{tmp_path}/cp", files=1).awaitTermination()
    got = spark.read.parquet(f"file://{tmp_path}/out").groupBy("event_type").agg(F.sum("n").alias("n"))
    assert sorted(map(tuple, got.collect())) == sorted(map(tuple, run(events).collect()))
    stream = progress.progress(spark.readStream.schema(schema).parquet(f"file://{tmp_path}/in"), late="60 days")
    query = stream.writeStream.format("memory").queryName("progress").outputMode("complete").trigger(availableNow=True).start()
    query.awaitTermination()
    assert spark.table("progress").agg(F.sum("n")).first()[0] == events.count()


def test_composition(spark):
    from grainfield.functions.unicode import composed

    rows = spark.createDataFrame([("ﬁ ½ é",), ("plain",), (None,)], "t string")
    assert [r[0] for r in rows.select(composed(F.col("t"))).collect()] == ["fi 1⁄2 é", "plain", None]
