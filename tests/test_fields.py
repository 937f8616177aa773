"""Fields of four documents, worked out by hand."""

import pytest

from grainfield import api
from grainfield.operators.validate import Rule, ValidatorConfig

DOCS = {
    "invoice_001": [("M/s Mahindra Tractors Pvt Ltd", 0.95), ("Village: Rampur, Meerut, UP", 0.90), ("QUOTATION", 0.96), ("Model: SWARAJ 744 FE", 0.94), ("Engine Specifications", 0.92), ("Horse Power: 48 HP", 0.96), ("Financial Details", 0.93), ("Ex-showroom Price: ₹6,85,000", 0.92), ("Grand Total: ₹6,85,000", 0.94)],
    "invoice_002": [("RAJESH MOTORS PRIVATE LIMITED", 0.94), ("Authorized Tractor Dealer", 0.91), ("Mahindra 575 DI", 0.95), ("Power: 50 HP", 0.93), ("Total Amount: Rs. 5,25,000/-", 0.90)],
    "invoice_003": [("KUMAR TRACTORS AND SERVICES", 0.92), ("Village: Rampur, Dist: Meerut", 0.88), ("Tractor Model: New Holland 3630", 0.93), ("Engine Capacity: 55 HP", 0.91), ("Price: 7.45 Lakh", 0.89), ("Grand Total: 7.45 Lakh", 0.92)],
    "invoice_004": [("SINGH AUTOMOBILES LTD", 0.93), ("Tractor Sales & Service", 0.90), ("Sonalika DI 60", 0.94), ("60 HP Engine", 0.92), ("₹ 8,50,000", 0.91)],
    "blank": [("   ", 0.9)],
}
#: The fourth dealer line holds a reject term (MOBILE in AUTOMOBILES), so the second line is the best.
EXPECTED = {
    "invoice_001": ("Mahindra Tractors Pvt Ltd", 0.96, "MAHINDRA TRACTORS PVT LTD", 0.9405, 48.0, 0.943488, 685000, 0.905408),
    "invoice_002": ("RAJESH MOTORS Pvt Ltd", 0.95128, "MAHINDRA 575 DI", 0.9405, 50.0, 0.914004, 525000, 0.86688),
    "invoice_003": ("KUMAR TRACTORS", 0.93104, "NEW HOLLAND 3630", 0.9207, 55.0, 0.894348, 745000, 0.886144),
    "invoice_004": ("Tractor Sales & Service", 0.82656, "SONALIKA DI 60", 0.9306, 60.0, 0.904176, 850000, 0.7826),
    "blank": (None, 0, None, 0, None, 0, None, 0),
}


@pytest.fixture(scope="module")
def blocks(spark):
    rows = [(doc, i, text, conf, "x") for doc, lines in DOCS.items() for i, (text, conf) in enumerate(lines)]
    return spark.createDataFrame(rows, "document_id string, idx int, text string, confidence double, field string")


def test_fields_and_confidences(blocks):
    got = {r["document_id"]: r for r in api.extract_fields(blocks).collect()}
    assert set(got) == set(EXPECTED)
    for doc, (dealer, dc, model, mc, hp, hc, cost, cc) in EXPECTED.items():
        r = got[doc]
        assert (r["dealer_name"], r["model_name"], r["horse_power"], r["asset_cost"]) == (dealer, model, hp, cost)
        assert [r["dealer_conf"], r["model_conf"], r["hp_conf"], r["cost_conf"]] == pytest.approx([dc, mc, hc, cc], abs=1e-6)


def test_partitions_do_not_matter(blocks):
    one, eight = (sorted(map(str, api.extract_fields(blocks.repartition(n)).collect())) for n in (1, 8))
    assert one == eight


def test_best_is_the_largest_confidence(blocks):
    best = {(r["document_id"]): r["hp_conf"] for r in api.extract_fields(blocks).collect()}
    for r in api.candidates(blocks).filter("field = 'horse_power'").collect():
        assert r["conf"] <= best[r["document_id"]] + 1e-9


def test_rules_clip_and_custom_rules_count(blocks):
    plain = {r["document_id"]: r for r in api.validate_documents(blocks).collect()}
    assert all(0 <= r["dealer_conf"] <= 0.98 for r in plain.values())
    assert plain["invoice_001"]["dealer_conf"] == pytest.approx(0.98)
    config = ValidatorConfig().with_rule("dealer_name", Rule("never", lambda d, x: "false", 0.1, False, "high"))
    strict = {r["document_id"]: r for r in api.validate_documents(blocks, config).collect()}
    assert strict["invoice_001"]["dealer_conf"] < plain["invoice_001"]["dealer_conf"]
    assert "never" in strict["invoice_001"]["dealer_issues"]


def test_empty_input(spark):
    none = spark.createDataFrame([], "document_id string, idx int, text string, confidence double")
    assert api.extract_fields(none).count() == 0


def with_masters(spark):
    rows = [(doc, i, text, conf) for doc, lines in DOCS.items() for i, (text, conf) in enumerate(lines)]
    rows += [("odd", 0, "Dealer: Kumar Motor", None), ("odd", 1, "KUMAR MOTORS", 0.7), ("odd", 2, "M/s Kumar Motors", 0.9), ("odd", 3, "Model: EICHER 475", 0.2), ("odd", 4, "SWARAJ 744", 0.21), ("odd", 5, None, 0.5)]
    rows += [("again", 0, "Seller: Rajesh Motor", 0.6), ("again", 1, "Dealer: Rajesh Motors Co", 0.9), ("again", 2, "60 HP", None), ("again", 2, "61 HP", 0.9), ("bare", 0, None, None)]
    blocks = spark.createDataFrame(rows, "document_id string, idx int, text string, confidence double")
    dealers = spark.createDataFrame([("Kumar Motors",), ("Rajesh Motors",), ("Singh Automobiles",), ("Kumar Tractor",), (None,)], "dealer string")
    return blocks, dealers, spark.createDataFrame([("EICHER 475",), ("SONALIKA DI 60",), (None,)], "model string")


def test_one_pass_with_masters_equals_the_single_steps(spark):
    from grainfield.functions.dialect import Spark, query
    from grainfield.operators import extract

    blocks, dealers, models = with_masters(spark)
    for name, frame in (("one_pass_blocks", blocks), ("master_dealers", dealers), ("master_models", models)):
        frame.createOrReplaceTempView(name)
    d = Spark()
    single = spark.sql(query(d, {**extract.prepared(d, "one_pass_blocks"), **extract.candidates(d, masters=True), **extract.best(d)}, "select document_id, field, s, v, conf from best")).collect()
    best = {(r["document_id"], r["field"]): (r["s"] if r["v"] is None else r["v"], r["conf"] or 0) for r in single}
    got = api.extract_fields(blocks, dealers, models).collect()
    assert {r["document_id"] for r in got} == {doc for doc, _ in best} and len(got) == 8
    for r in got:
        for field, short in extract.SHORT.items():
            assert (r[field], r[f"{short}_conf"]) == best.get((r["document_id"], field), (None, 0))
    assert any(r["source"] == "fuzzy_match" for r in spark.sql(query(d, {**extract.prepared(d, "one_pass_blocks"), **extract.candidates(d, masters=True), **extract.best(d)}, "select source from best")).collect())


def test_masters_read_the_blocks_once(spark):
    import re

    blocks, dealers, models = with_masters(spark)
    run = api.extract_fields(blocks, dealers, models)._jdf.queryExecution()
    run.toRdd().count()
    final = run.executedPlan().toString().split("Initial Plan")[0]
    assert len(re.findall(r"Generate posexplode\(concat\(", final)) == 1
    assert "ReusedExchange" in final
