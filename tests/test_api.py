"""The DataFrame functions, the reports and the command lines, against figures worked out by hand or by plain Python."""

import json
import statistics

import pytest
from pyspark.sql import functions as F

from grainfield import __main__ as cli
from grainfield import api, reports
from grainfield.sources import readers, sinks

LINES = [("M/s Mahindra Tractors Pvt Ltd", 0.95), ("Model: SWARAJ 744 FE", 0.94), ("Horse Power: 48 HP", 0.96), ("Grand Total: ₹6,85,000", 0.94)]


def blocks_of(spark, docs):
    rows = [(doc, i, text, conf, 10, 20 * i) for doc, lines in docs.items() for i, (text, conf) in enumerate(lines)]
    return spark.createDataFrame(rows, "document_id string, idx int, text string, confidence double, x1 int, y1 int")


def test_master_data_takes_part_in_the_extraction(spark):
    blocks = blocks_of(spark, {"a": [("Dealer: Kumar Motor", 0.8), ("Model: EICHER 475", 0.8)], "b": [("Dealer: Unheard Of Names", 0.8)]})
    plain = {r["document_id"]: r for r in api.extract_fields(blocks).collect()}
    dealers, models = spark.createDataFrame([("Kumar Motors",), ("Singh Traders",)], "dealer string"), spark.createDataFrame([("EICHER 475",)], "model string")
    got = {r["document_id"]: r for r in api.extract_fields(blocks, dealers, models).collect()}
    assert plain["a"]["dealer_name"] == "Kumar Motor" and got["a"]["dealer_name"] == "Kumar Motors"
    # 11 of 11 and 12 characters in common: 96 of 100, and the match counts again with itself, at 100.
    first = min(plain["a"]["dealer_conf"] * 96 / 90, 0.97)
    assert got["a"]["dealer_conf"] == pytest.approx(min(first * 100 / 90, 0.97))
    assert got["a"]["model_conf"] == pytest.approx(min(plain["a"]["model_conf"] * 1.08, 0.98))
    assert got["b"]["dealer_name"] == plain["b"]["dealer_name"] and got["b"]["dealer_conf"] == plain["b"]["dealer_conf"]
    assert {r["document_id"]: r["dealer_name"] for r in api.extract_fields(blocks, dealers).collect()}["a"] == "Kumar Motors"


def test_validator_documents(spark):
    schema = "document_id string, dealer_name string, dealer_conf double, model_name string, model_conf double, horse_power double, hp_conf double, asset_cost double, cost_conf double, signature_present boolean, signature_conf double, stamp_present boolean, stamp_conf double"
    box = lambda c: c * 1.10 * 1.08  # noqa: E731  a box, of a usual area
    rows = [("good", "Mahindra Tractors Pvt Ltd", 0.88, "575 DI", 0.85, 50.0, 0.82, 650000.0, 0.86, True, box(0.75), True, box(0.72)), ("bad", "XYZ123!@#", 0.65, "999", 0.60, 30.0, 0.55, 5000.0, 0.50, False, 0.0, False, 0.0)]
    got = {r["document_id"]: r for r in api.validate_fields(spark.createDataFrame(rows, schema)).collect()}
    assert got["good"]["overall_confidence"] == pytest.approx(0.969318, abs=1e-6)
    assert got["good"]["dealer_issues"] == "" and got["bad"]["overall_confidence"] < 0.75


def test_documents_with_boxes(spark):
    blocks = blocks_of(spark, {"d1": LINES, "d2": [("  ", 0.9)]})
    images = spark.createDataFrame([("d1", 600.0, 400.0), ("d2", 600.0, 400.0), ("d3", 600.0, 400.0)], "doc string, width double, height double")
    boxes = spark.createDataFrame([("d1", 1, "signature", 0.9, 100.0, 100.0, 200.0, 150.0), ("d1", 2, "signature", 0.8, 105.0, 100.0, 205.0, 150.0), ("d1", 3, "stamp", 0.45, 0.0, 0.0, 50.0, 50.0), ("d3", 1, "stamp", 0.9, 590.0, 0.0, 700.0, 100.0)], "doc string, det_idx long, class_name string, confidence double, x1 double, y1 double, x2 double, y2 double")
    truth = spark.createDataFrame([("d1", "signature", 100.0, 100.0, 200.0, 200.0)], api.BOXES)
    seen = {r["doc"]: r for r in api.box_summary(boxes, images, truth).collect()}
    assert seen["d1"]["signature_count"] == 1 and not seen["d1"]["stamp_present"] and seen["d1"]["signature_iou"] == 0.5 and seen["d1"]["passes_threshold"] is False
    assert seen["d3"]["stamp_x2"] == 600.0 and seen["d2"]["passes_threshold"] is None
    timings = spark.createDataFrame([(d, 850.0, 120.0, 350.0, 80.0) for d in ("d1", "d2", "d3")], "document_id string, ocr_ms double, extraction_ms double, detection_ms double, validation_ms double")
    results = api.process_documents(blocks, boxes, images, truth, timings)
    got = {r["document_id"]: r for r in results.collect()}
    assert got["d1"]["status"] == "success" and got["d1"]["total_ms"] == 1400 and got["d1"]["cost_usd"] == pytest.approx(1.4 * 0.01 / 3600)
    assert got["d1"]["signature_conf"] == pytest.approx(min(0.9 * 1.10 * 1.08, 0.98))
    assert got["d2"]["status"] == "success" and got["d2"]["overall"] == 0 and got["d2"]["dealer_name"] is None
    assert (got["d3"]["status"], got["d3"]["error"], got["d3"]["total_ms"], got["d3"]["stamp_present"]) == ("failed", "No text extracted from document", 850, False)
    checked = api.validate_documents(blocks).filter("document_id = 'd1'").first()
    weights = {"dealer": 0.20, "model": 0.25, "hp": 0.20, "cost": 0.25}
    top = sum(w * checked[f"{c}_conf"] for c, w in weights.items()) + 0.05 * got["d1"]["signature_conf"]
    assert got["d1"]["overall"] == pytest.approx(top / 0.95)
    summary = api.batch_summary(results).first().asDict()
    assert (summary["total_documents"], summary["successful"], summary["failed"], summary["signature_rate"]) == (3, 2, 1, 0.5)
    assert "failed 1" in reports.console(summary)


def test_normalised_blocks(spark):
    rows = [("d", 0, "Ｍ/s Kumar Motors, price ₹5,25,000", 0.9), ("d", 1, "Mahindra 575 DI 50 HP", 0.9), ("d", 2, "", 0.9), ("d", 3, "write to a.b@example.com", 0.9), ("d", 4, "मॉडल स्वराज", 0.9)]
    got = {r["idx"]: r for r in api.normalize_blocks(spark.createDataFrame(rows, "document_id string, idx int, text string, confidence double")).collect()}
    assert set(got) == {0, 1, 3, 4}
    # Full-width letters are composed; the currency "Rs" goes inside words too.
    assert got[0]["normalized_text"] == "m/s kumar moto, price 5,25,000" and got[0]["has_currency"] and got[0]["kw_cost"]
    assert got[1]["horse_power"] == 50.0 and got[1]["model_name"].startswith("575 DI") and 575.0 in got[1]["numbers"]
    # The mask loses its brackets; vowel signs aren't letters, so the key word is torn apart before it is looked for.
    assert got[3]["normalized_text"] == "write to email" and got[4]["language"] == "hi" and not got[4]["kw_model"]


def test_lines_answers_and_accuracy(spark):
    blocks = spark.createDataFrame([("d", i, f"w{i}", 1.0, 10 * i, y) for i, y in enumerate((1, 5, 16, 17, 30, 33, 60))], "document_id string, idx int, text string, confidence double, x1 int, y1 int")
    assert [r["line_no"] for r in api.text_lines(blocks).orderBy("idx").collect()] == [0, 0, 0, 1, 1, 2, 3]
    assert api.text_sequences(blocks).first()["text"] == "w0 w1 w2 / w3 w4 / w5 / w6"
    answers = api.parse_answers(spark.createDataFrame([("a", '{"dealer_name": "Kumar Motors", "model_name": "575 DI", "horse_power": "50", "asset_cost": "6,00,000"}')], "document_id string, response string"))
    rules = spark.createDataFrame([("a", None, 0.3, "575", 0.5, 50.0, 0.9, 525000.0, 0.8, 0.55)], "document_id string, dealer_name string, dealer_conf double, model_name string, model_conf double, horse_power double, hp_conf double, asset_cost double, cost_conf double, overall_confidence double")
    assert api.needs_fallback(rules).first()["needs_fallback"] is True
    merged = api.merge_answers(rules, answers).first()
    assert (merged["dealer_name"], merged["dealer_source"], merged["dealer_conf"]) == ("Kumar Motors", "vlm_fallback", 0.8)
    assert (merged["model_name"], merged["model_source"], merged["model_conf"]) == ("575", "rule+vlm_confirmed", 0.625)
    assert (merged["asset_cost"], merged["cost_source"]) == (525000.0, "rule")
    schema = "document_id string, dealer_name string, model_name string, horse_power double, asset_cost double, signature_present boolean, stamp_present boolean"
    results = spark.createDataFrame([("a", "Kumar Motors", "575 DI", 50.0, 600000.0, True, False), ("b", "X", "1", 10.0, 1.0, True, False), ("c", None, None, None, None, False, False)], schema)
    truth = spark.createDataFrame([("a", "KUMAR MOTORS", "575 di", 51.0, 610000.0, True, False), ("b", "Y", "2", 50.0, 9.0, False, True)], schema)
    whole = api.document_accuracy(results, truth).first()
    assert (whole["total"], whole["correct"], whole["partially_correct"], whole["incorrect"], whole["dla_percent"]) == (3, 1, 0, 2, 33.33)
    by = {r["field"]: r for r in api.field_metrics(results, truth).collect()}
    assert (by["horse_power"]["tp"], by["horse_power"]["fp"], by["horse_power"]["fn"], by["horse_power"]["f1"]) == (1, 1, 0, 0.667)


@pytest.fixture(scope="module")
def evaluated(tmp_path_factory):
    folder = tmp_path_factory.mktemp("eval")
    box = lambda p: {"present": p, "bbox": [1, 2, 3, 4] if p else None}
    rows = [
        {"doc_id": f"d{i}", "status": "failed" if i % 10 == 9 else "success", "error": "OCR engine died" if i % 10 == 9 else None, "confidence": round(0.5 + i * 0.013, 3), "processing_time_sec": 1 + i * 1.1, "cost_estimate_usd": 0.0004 * (i + 1),
         "processing_details": {"ocr_time_sec": 0.5, "extraction_time_sec": 0.1, "detection_time_sec": 0.2, "vlm_time_sec": 0.0, "vlm_used": i % 2 == 0},
         "fields": {"dealer_name": "Kumar Motors" if i % 3 else None, "model_name": "575 DI", "horse_power": 50 if i % 4 else 300, "asset_cost": 600000, "signature": box(True), "stamp": box(False)}}
        for i in range(30)
    ]
    truth = {f"d{i}": {"fields": {"dealer_name": "Kumar Motors", "model_name": "575 DI", "horse_power": 50, "asset_cost": 600000, "signature": {"present": True}, "stamp": {"present": False}}} for i in range(0, 30, 2)}
    (folder / "results.json").write_text(json.dumps(rows))
    (folder / "truth.json").write_text(json.dumps(truth))
    return folder, rows


def test_report_equals_plain_statistics(spark, evaluated):
    folder, rows = evaluated
    assert cli.main(["evaluate", "-r", f"file://{folder}/results.json", "-g", f"file://{folder}/truth.json", "-o", f"file://{folder}/out"]) == 0
    found = json.loads((folder / "out/analysis.json").read_text())
    good = [r for r in rows if r["status"] == "success"]
    conf, cost, times = ([r[k] for r in good] for k in ("confidence", "cost_estimate_usd", "processing_time_sec"))
    seen = found["confidence_analysis"]
    assert (seen["mean_confidence"], seen["median_confidence"], seen["std_confidence"]) == (round(statistics.mean(conf), 3), round(statistics.median(conf), 3), round(statistics.stdev(conf), 3))
    assert seen["confidence_distribution"]["low"] == {"count": sum(c < 0.7 for c in conf), "percentage": round(100 * sum(c < 0.7 for c in conf) / len(conf), 1)}
    assert found["cost_analysis"]["cost_metrics"]["total"] == round(sum(cost), 6) and found["cost_analysis"]["target_analysis"]["below_target"] == sum(c < 0.01 for c in cost)
    assert found["performance_analysis"]["throughput"]["documents_per_hour"] == round(len(good) / (sum(times) / 3600), 1)
    assert found["error_analysis"]["error_categories"] == {"ocr_failure": 3} and found["error_analysis"]["field_extraction_rates"]["dealer_name"]["missing"] == sum(not r["fields"]["dealer_name"] for r in good)
    assert [s["doc_id"] for s in found["error_samples"]] == [f"d{i}" for i in range(20)] and found["error_samples"][0]["issues"] == ["missing_dealer_name", "invalid_horse_power"]
    assert found["document_level_accuracy"]["total_documents"] == 30 and found["field_level_metrics"]["model_name"]["f1_score"] == 1.0
    assert len(found["summary"]["recommendations"]) >= 4 and "| model_name | 1.000 |" in (folder / "out/markdown_report.md").read_text()
    assert json.loads((folder / "out/error_samples.json").read_text()) == found["error_samples"]
    bins = spark.read.parquet(f"file://{folder}/out/series/confidence_distribution")
    assert bins.agg(F.sum("n")).first()[0] == len(good) and spark.read.parquet(f"file://{folder}/out/series/time_vs_confidence").count() == len(good)


def test_a_report_without_successes(spark):
    rows = spark.createDataFrame([("d", "failed", None, None, None, "timeout")], "doc_id string, status string, confidence double, processing_time_sec double, cost_estimate_usd double, error string")
    for c, kind in (("vlm_used", "boolean"), *((f"{s}_time_sec", "double") for s in ("ocr", "extraction", "detection", "vlm")), ("dealer_name", "string"), ("model_name", "string"), ("horse_power", "double"), ("asset_cost", "double"), *((f"{s}_{k}", "boolean") for s in ("signature", "stamp") for k in ("present", "boxed"))):
        rows = rows.withColumn(c, F.lit(None).cast(kind))
    found = reports.analysis(rows)
    assert "error" in found["confidence_analysis"] and found["error_analysis"]["error_categories"] == {"timeout": 1} and found["summary"]["key_metrics"]["average_confidence"] == 0


def test_command_line_over_blocks_and_images(spark, tmp_path):
    blocks_of(spark, {"d1": LINES, "d2": LINES[:1]}).write.parquet(f"file://{tmp_path}/blocks")
    (tmp_path / "master.json").write_text(json.dumps({"dealers": ["Mahindra Tractors Pvt Ltd"], "models": []}))
    (tmp_path / "truth.json").write_text(json.dumps({"d1": {"dealer_name": "A", "signature_bbox": [0, 0, 10, 10]}}))
    out = f"file://{tmp_path}/out"
    assert cli.main(["process", "-i", f"file://{tmp_path}/blocks", "-o", out, "--master-data", f"file://{tmp_path}/master.json", "--ground-truth", f"file://{tmp_path}/truth.json"]) == 0
    public = {r["document_id"]: r for r in json.loads((tmp_path / "out/output.json").read_text())}
    assert public["d1"]["asset_cost"]["value"] == 685000 and public["d2"]["asset_cost"]["value"] is None and public["d1"]["signature"] == {"present": False, "bbox": None, "confidence": 0.0, "iou": None}
    assert len(json.loads((tmp_path / "out/extraction_results.json").read_text())) == 2 and json.loads((tmp_path / "out/summary.json").read_text())["successful"] == 2
    (tmp_path / "pictures").mkdir()
    for name in ("x.png", "y.png"):
        (tmp_path / "pictures" / name).write_bytes(name.encode())
    assert cli.main(["process", "-i", f"file://{tmp_path}/pictures", "-o", f"{out}2", "--engine", "tests.engine:read", "--limit", "2"]) == 0
    got = {r["document_id"]: r["status"] for r in spark.read.parquet(f"{out}2/results").collect()}
    assert got == {"x": "success", "y": "failed"}


def test_dataset_of_a_detector(spark, tmp_path):
    boxes = spark.createDataFrame([(f"img{i}", c, 10.0, 20.0, 110.0, 60.0, 200.0, 100.0) for i in range(5) for c in ("signature", "stamp")], f"{api.BOXES}, width double, height double")
    lines = api.label_lines(boxes)
    assert sinks.write_dataset(lines, f"file://{tmp_path}/set") == {"train": 4, "val": 1}
    assert (tmp_path / "set/labels/val/img4.txt").read_text() == "0 0.300000 0.400000 0.500000 0.400000\n1 0.300000 0.400000 0.500000 0.400000"
    assert "nc: 2" in (tmp_path / "set/dataset.yaml").read_text() and len(list((tmp_path / "set/labels/train").iterdir())) == 4


def test_truth_boxes(spark):
    truth = spark.createDataFrame([("d", [1.0, 2.0, 3.0, 4.0], None)], "document_id string, signature_bbox array<double>, stamp_bbox array<double>")
    assert [tuple(r) for r in readers.truth_boxes(truth).collect()] == [("d", "signature", 1.0, 2.0, 3.0, 4.0)]
