"""Evaluation reports: the analysis, its samples, a Markdown summary, console text and the series behind the plots.

Every figure is a small aggregate; only those, and the few sample rows, come to the driver.
"""

from __future__ import annotations

import datetime

from pyspark.sql import DataFrame

from .api import _over
from .functions import bank
from .functions.dialect import query
from .operators import evaluate, report
from .sources import sinks

TARGETS = {"confidence_target": "confidence", "time_target": "processing_time", "cost_target": "cost", "success_target": "success_rate"}


def _rows(results: DataFrame, build) -> list[dict]:
    return [r.asDict() for r in _over({"results": results}, lambda d, n: query(d, {**report.successes(n["results"]), **build(d, n["results"])[0]}, build(d, n["results"])[1])).collect()]


def _part(row: dict, names: dict[str, str]) -> dict:
    return {new: row[old] for new, old in names.items()}


def analysis(results: DataFrame, truth: DataFrame | None = None, source: str = "") -> dict:
    """A19 over flat results (readers.flat_results()) and, for accuracy, truth: the report as one nested dict."""
    one = lambda build: _rows(results, lambda d, s: ({}, build(d, s)))[0]
    confidence, performance, cost = one(lambda d, s: report.confidence(d)), one(lambda d, s: report.performance(d)), one(lambda d, s: report.cost(d))
    counted = _rows(results, lambda d, s: ({}, report.errors(d, s)))
    named = lambda kind: {r["name"]: r["n"] for r in counted if r["kind"] == kind}
    key = _rows(results, lambda d, s: (report.summary(d, s), f"select *, {report.assessment()} as assessment from reached"))[0]
    advice = _rows(results, lambda d, s: (report.summary(d, s), report.recommendations(d)))
    samples = _rows(results, lambda d, s: ({}, report.samples(d, s)))
    none, unknown = {"error": "No successful results"}, {"error": "Ground truth required"}
    found, missing, issues = named("extracted"), named("missing"), named("issue")
    rates = {}
    for f in bank.FIELDS:
        total = found.get(f, 0) + missing.get(f, 0)
        if total:
            rates[f] = {"extraction_rate": round(100 * found.get(f, 0) / total, 1), "extracted": found.get(f, 0), "missing": missing.get(f, 0)}
    spread = {"mean": "mean", "median": "median", "std": "stdev", "min": "least", "max": "most"}
    out = {
        "timestamp": datetime.datetime.now().isoformat(), "input_file": source, "total_documents": key["n"], "document_level_accuracy": unknown, "field_level_metrics": unknown,
        "confidence_analysis": none, "performance_analysis": none, "cost_analysis": none,
        "error_analysis": {
            "total_documents": key["n"], "successful": confidence["n"], "failed": key["failed"], "success_rate": key["success_rate"], "error_categories": named("class"), "field_extraction_rates": rates,
            "common_issues": {k: issues.get(k, 0) for k in ("low_confidence", "high_processing_time", "high_cost")},
        },
        "error_samples": [{**s, "issues": [i for i in s["issues"].split(",") if i]} for s in samples],
        "summary": {
            "key_metrics": {"average_confidence": key["average_confidence"] or 0, "average_processing_time_sec": key["average_time"] or 0, "average_cost_usd": key["average_cost"] or 0, "success_rate_percent": key["success_rate"]},
            "target_achievement": {f"{new}_target": key[old] for old, new in TARGETS.items()}, "overall_assessment": key["assessment"], "recommendations": [r["advice"] for r in sorted(advice, key=lambda r: r["place"])],
        },
    }
    if confidence["n"]:
        out["confidence_analysis"] = {
            "total_documents": confidence["n"], **{f"{new}_confidence": confidence[old] for new, old in spread.items()},
            "confidence_distribution": {k: {"count": confidence[k], "percentage": confidence[f"{k}_percent"]} for k in ("high", "medium", "low")}, "threshold_analysis": {f"above_{k}": confidence[f"over_{k}"] for k in (95, 90, 80, 70)},
        }
        out["performance_analysis"] = {
            "total_documents": performance["n"], "processing_time": _part(performance, {**spread, "total": "total", "target_30s": "within_30s"}),
            "component_times": {s: {"mean": performance[f"{s}_mean"], "percentage": performance[f"{s}_percent"], **({"used_count": performance["vlm_used"]} if s == "vlm" else {})} for s in report.STAGES},
            "throughput": {"documents_per_hour": performance["docs_per_hour"], "average_time_per_doc": performance["mean"]},
        }
        out["cost_analysis"] = {
            "total_documents": cost["n"], "cost_metrics": _part(cost, {**spread, "total": "total"}), "cost_distribution": _part(cost, {"below_001": "under_001", "001_to_005": "under_005", "005_to_01": "under_010", "above_01": "over_010"}),
            "target_analysis": {"target_cost": 0.01, "below_target": cost["n"] - cost["over_010"], "above_target": cost["over_010"], "percentage_below_target": cost["below_target_percent"]},
        }
    if truth is not None:
        frames = {"results": results.withColumnRenamed("doc_id", "document_id"), "truth": truth}
        total = _over(frames, lambda d, n: query(d, {**evaluate.compared(d, False, n["results"], n["truth"]), **evaluate.judged()}, evaluate.accuracy(d))).first().asDict()
        fields = _over(frames, lambda d, n: query(d, {**evaluate.compared(d, True, n["results"], n["truth"]), **evaluate.outcomes(d)}, evaluate.METRICS)).collect()
        out["document_level_accuracy"] = {
            "total_documents": total["total"], "correct_documents": total["correct"], "partially_correct": total["partially_correct"], "incorrect_documents": total["incorrect"],
            "document_level_accuracy": total["dla_percent"], "target_accuracy": 95.0, "achieved_target": total["meets_target"],
        }
        out["field_level_metrics"] = {r["field"]: {"precision": r["precision_"], "recall": r["recall_"], "f1_score": r["f1"], "true_positives": r["tp"], "false_positives": r["fp"], "false_negatives": r["fn"]} for r in fields}
    return out


def series(results: DataFrame) -> dict[str, DataFrame]:
    """K8: the data of the plots: histogram bins, points of time against confidence, bars of fields, parts of the time."""
    over = lambda build: _over({"results": results}, lambda d, n: query(d, {**report.successes(n["results"]), **build(d)[0]}, build(d)[1]))
    rates = ", ".join(f"round(100e0 * avg(case when {evaluate.truthy(f, f in bank.FIELDS[:2])} then 1e0 else 0e0 end), 1) as {f}" for f in bank.FIELDS)
    means = ", ".join(f"round(avg(coalesce({s}_time_sec, 0e0)), 3) as {s}" for s in report.STAGES)
    return {
        "confidence_distribution": over(lambda d: (report.histogram(), "select b.bin, lo + (hi - lo) * b.bin / 20 as from_, lo + (hi - lo) * (b.bin + 1) / 20 as to_, n from bins b cross join ends")),
        "time_vs_confidence": over(lambda d: ({}, "select doc_id, sec, conf from successes")),
        "field_extraction_rates": over(lambda d: ({}, f"select {rates} from successes")),
        "time_breakdown": over(lambda d: ({}, f"select {means} from successes")),
    }


def markdown(found: dict) -> str:
    """K7: the report for readers."""
    mark = lambda ok: "✅" if ok else "❌"
    key, met = found["summary"]["key_metrics"], found["summary"]["target_achievement"]
    lines = [
        "# Evaluation report", "", f"**{found['summary']['overall_assessment']}**", "", "| metric | value | target | reached |", "|-|-|-|-|",
        f"| mean confidence | {key['average_confidence']:.3f} | ≥ 0.95 | {mark(met['confidence_target'])} |", f"| mean time | {key['average_processing_time_sec']:.2f} s | ≤ 30 s | {mark(met['processing_time_target'])} |",
        f"| mean cost | ${key['average_cost_usd']:.6f} | ≤ $0.01 | {mark(met['cost_target'])} |", f"| success rate | {key['success_rate_percent']:.1f}% | ≥ 95% | {mark(met['success_rate_target'])} |", "",
    ]
    accuracy, fields, times, cost = found["document_level_accuracy"], found["field_level_metrics"], found["performance_analysis"], found["cost_analysis"]
    if "error" not in accuracy:
        lines += [f"Documents right: {accuracy['correct_documents']} of {accuracy['total_documents']} ({accuracy['document_level_accuracy']}%, target {accuracy['target_accuracy']}%) {mark(accuracy['achieved_target'])}", ""]
    if "error" not in fields:
        lines += ["| field | precision | recall | F1 |", "|-|-|-|-|", *(f"| {f} | {m['precision']:.3f} | {m['recall']:.3f} | {m['f1_score']:.3f} |" for f, m in sorted(fields.items())), ""]
    if "error" not in times:
        lines += [f"Within 30 s: {times['processing_time']['target_30s']} of {times['total_documents']}; {times['throughput']['documents_per_hour']:.0f} documents an hour.", ""]
    if "error" not in cost:
        lines += [f"Below $0.01: {cost['target_analysis']['below_target']} of {cost['total_documents']} ({cost['target_analysis']['percentage_below_target']}%).", ""]
    return "\n".join([*lines, "## Recommendations", "", *(f"{i}. {a}" for i, a in enumerate(found["summary"]["recommendations"], 1)), ""])


def write(results: DataFrame, path: str, truth: DataFrame | None = None, source: str = "") -> dict:
    """K4, K6, K7, K8: analysis.json, error_samples.json, markdown_report.md and the series as Parquet below a path; returns the analysis."""
    found = analysis(results, truth, source)
    spark = results.sparkSession
    sinks.write_text(spark, f"{path}/analysis.json", sinks.pretty(found))
    sinks.write_text(spark, f"{path}/error_samples.json", sinks.pretty(found["error_samples"]))
    sinks.write_text(spark, f"{path}/markdown_report.md", markdown(found))
    for name, rows in series(results).items():
        rows.write.mode("overwrite").parquet(f"{path}/series/{name}")
    return found


def console(summary: dict) -> str:
    """K5: a batch's summary (api.batch_summary()) as text."""
    n = summary["successful"]
    lines = [f"documents {summary['total_documents']}, successful {n}, failed {summary['failed']} ({summary['success_rate']:.1%})"]
    if n:
        lines += [
            f"confidence {summary['mean_confidence']:.1%} ({summary['min_confidence']:.1%} to {summary['max_confidence']:.1%}); high {summary['high_count']}, medium {summary['medium_count']}, low {summary['low_count']}",
            f"time {summary['mean_ms']:.0f} ms ({summary['min_ms']:.0f} to {summary['max_ms']:.0f}), {summary['total_sec']:.1f} s in all",
            f"cost ${summary['mean_usd']:.6f} a document, ${summary['total_usd']:.6f} in all",
            "extracted " + ", ".join(f"{f} {summary[f'{f}_rate']:.1%}" for f in bank.FIELDS) + f"; signature {summary['signature_rate']:.1%}, stamp {summary['stamp_rate']:.1%}",
        ]
    return "\n".join(lines)
