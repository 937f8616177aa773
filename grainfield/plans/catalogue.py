"""Queries by name, and their DuckDB twins: each plan is written once and rendered for either engine."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from ..functions import bank
from ..functions import fuzzy as F_
from ..functions import scalars as S
from ..functions.dialect import Duck, Spark, query
from ..operators import extract as E
from ..operators import detect as D
from ..operators import evaluate as A
from ..operators import lines as L
from ..operators import normalize as N
from ..operators import process as P
from ..operators import report as R
from ..operators import validate as V
from ..operators import vlm as M
from . import fixtures as X

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def plan(build: Callable) -> Callable:
    """Register a plan, a function of the dialect, as a Spark query and as its DuckDB twin."""

    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        return spark.sql(build(Spark(sf_dir)))

    QUERIES[build.__name__] = run
    ORACLES[build.__name__] = build(Duck())
    return build


def rounded(d, *columns: str) -> str:
    return ", ".join(f"{d.round6(c)} as {c}" for c in columns)


CONFS = "dealer_conf", "model_conf", "hp_conf", "cost_conf"


@plan
def prepare_blocks(d):
    return query(d, {**X.blocks(d), **E.prepared(d)}, f"select document_id, idx, cast(pos as bigint) as pos, original, text, {d.size('nums')} as n_nums, coalesce({d.get('nums', 0)}, -1e0) as first_num, has_currency, has_suffix, kw_dealer, kw_model, kw_specs, kw_financial, next_original from prepared where original <> ''")


def _candidate_plan(field: str, name: str):
    def build(d):
        return query(d, {**X.blocks(d), **E.prepared(d), **E.candidates(d, (field,))}, f"select document_id, seq, s, v, {d.round6('conf')} as conf, source from candidates where field <> ''")

    build.__name__ = name
    plan(build)

    def top(d):
        return query(d, {**X.blocks(d), **E.prepared(d), **E.candidates(d, (field,)), **E.best(d)}, f"select document_id, s, v, {d.round6('conf')} as conf, source from best where field <> ''")

    top.__name__ = name.replace("candidates", "top1")
    plan(top)


for _field, _name in (("horse_power", "hp_candidates"), ("asset_cost", "cost_candidates"), ("model_name", "model_candidates"), ("dealer_name", "dealer_candidates")):
    _candidate_plan(_field, _name)


@plan
def extract_fields(d):
    return query(d, {**X.blocks(d), **E.fields(d)}, f"select document_id, dealer_name, model_name, horse_power, asset_cost, {rounded(d, *CONFS)} from extracted")


@plan
def overall_confidence(d):
    return query(d, {**X.blocks(d), **E.fields(d)}, f"select document_id, {d.round6(E.overall())} as overall_confidence from extracted")


@plan
def light_validation(d):
    return query(d, {**X.blocks(d), **E.fields(d), **E.light_validation(d)}, f"select document_id, {rounded(d, 'hp_conf', 'cost_conf')}, {d.round6(E.overall())} as overall_confidence from light")


@plan
def section_blocks(d):
    return query(d, {**X.blocks(d), **E.prepared(d)}, "select document_id, idx, original, pos between specs_at and specs_at + 5 as in_specs, pos between financial_at and financial_at + 7 as in_financial from prepared where original <> '' and (pos between specs_at and specs_at + 5 or pos between financial_at and financial_at + 7)")


def _validated(d) -> dict[str, str]:
    return {**X.blocks(d), **E.fields(d), **V.validated(d)}


@plan
def validate_fields(d):
    issues = ", ".join(f"{f}_issues, {f}_boosts" for f in ("dealer", "model", "hp", "cost"))
    return query(d, {**X.blocks(d), **E.fields(d), **V.validated(d)}, f"select document_id, {rounded(d, *CONFS)}, {issues} from ruled")


@plan
def cross_validate(d):
    return query(d, _validated(d), f"select document_id, {rounded(d, *CONFS)}, hp_mismatch, {d.round6(E.overall())} as overall_confidence from crossed")


@plan
def model_hp_lookup(d):
    return query(d, _validated(d), "select document_id, model_name, hp_low, hp_high from crossed")


@plan
def flagship_invoice_extraction(d):
    """Power and cost of every invoice: candidates, best, rules, cross checks, band."""
    overall = E.overall()
    return query(
        d, {**X.blocks(d), **E.fields(d), **V.validated(d)},
        f"select document_id, horse_power as hp, {d.round6('hp_conf')} as hp_conf, asset_cost as cost, {d.round6('cost_conf')} as cost_conf, {d.round6(overall)} as overall_confidence, "
        f"case when {overall} >= 0.85e0 then 'high' when {overall} >= 0.65e0 then 'medium' else 'low' end as band from crossed",
    )


def _complete(d) -> dict[str, str]:
    missing = d.join(d.keep(d.array(*(f"case when {f} is null then '{f}' end" for f in bank.FIELDS)), lambda v: f"{v} is not null"), ", ")
    done = d.join(d.keep(d.array(*(f"case when {f} is not null then '{f}' end" for f in bank.FIELDS)), lambda v: f"{v} is not null"), ", ")
    high = d.join(d.keep(d.array(*(f"case when {c} <> '' then concat('{f}: ', {c}) end" for f, c in zip(bank.FIELDS, ("dealer_high", "model_high", "hp_high_issues", "cost_high"), strict=True))), lambda v: f"{v} is not null"), ", ")
    return {**_validated(d), **V.completeness(), "summed": f"select *, {missing} as missing_fields, {done} as complete_fields, n_complete / 4e0 as completeness_score, {E.overall()} as overall, {high} as high_severity from complete"}


@plan
def completeness(d):
    return query(d, _complete(d), "select document_id, missing_fields, complete_fields, completeness_score, cast(n_complete as bigint) as total_complete from summed")


@plan
def validation_summary(d):
    quality = "case when overall >= 0.85e0 and completeness_score >= 0.8e0 then 'high' when overall >= 0.65e0 and completeness_score >= 0.6e0 then 'medium' else 'low' end"
    advice = d.array(
        "case when completeness_score < 1 then concat('Missing required fields: ', missing_fields) end", "case when overall < 0.75e0 then 'Review low-confidence fields manually' end",
        "case when high_severity <> '' then concat('Critical validation failures: ', high_severity) end", "case when overall < 0.50e0 then 'Consider re-scanning or manual data entry' end",
    )
    there = [f"case when {f} is not null then {c}_conf end" for f, c in E.SHORT.items()]
    mean = f"({' + '.join(f'coalesce({t}, 0e0)' for t in there)}) / n_complete"
    return query(
        d, _complete(d),
        f"select document_id, {d.round6('overall')} as overall_confidence, {quality} as quality_level, high_severity, {d.join(d.keep(advice, lambda v: f'{v} is not null'), ' | ')} as recommendations, cast(n_complete as bigint) as fields_validated, "
        f"{d.round6('coalesce(least(' + ', '.join(there) + '), 0e0)')} as min_confidence, {d.round6('coalesce(greatest(' + ', '.join(there) + '), 0e0)')} as max_confidence, {d.round6(f'case when n_complete = 0 then 0e0 else {mean} end')} as avg_confidence, "
        f"({quality}) = 'high' and high_severity = '' as document_ready from summed",
    )


@plan
def validation_stats(d):
    return query(
        d, _complete(d),
        f"select cast(count(*) as bigint) as total, {d.count_if('overall >= 0.75e0')} as passed, round({d.count_if('overall >= 0.75e0')} / cast(count(*) as double), 6) as pass_rate, "
        + ", ".join(f"{d.count_if(f'''{c} <> {chr(39)}{chr(39)}''')} as {f}_high" for f, c in zip(("dealer", "model", "hp", "cost"), ("dealer_high", "model_high", "hp_high_issues", "cost_high"), strict=True)) + " from summed",
    )


def _scalar(name: str, source: Callable, columns: Callable, keys: str, table: str):
    def build(d):
        return query(d, source(d), f"select {keys}, {columns(d)} from {table}")

    build.__name__ = name
    plan(build)


def _lines(d) -> dict[str, str]:
    """Lines of documents, with the literal rows that the documents lack."""
    return {**X.text_blocks(d), **X.literals(d), "texts": "select doc_id, cast(idx as bigint) as idx, line as text from text_blocks union all select cast(-1 as bigint), cast(id as bigint), text from literals"}


_scalar("normalize_text", _lines, lambda d: f"{S.normalize_text(d, 'text')} as normalized", "doc_id, idx", "texts")
_scalar("mask_pii", _lines, lambda d: f"{S.mask_pii(d, 'text')} as masked", "doc_id, idx", "texts")
_scalar("strip_currency", _lines, lambda d: f"{S.strip_currency(d, 'text')} as stripped", "doc_id, idx", "texts")
_scalar("keyword_flags_multilingual", _lines, lambda d: ", ".join(f"{S.keyword_flag(d, 'text', k)} as kw_{k}" for k in bank.KEYWORDS) + f", {S.has_currency(d, 'text')} as has_currency", "doc_id, idx", "texts")
_scalar("detect_language_norm", _lines, lambda d: f"{S.language(d, 'text')} as language", "doc_id, idx", "texts")
_scalar("detect_language_ocr", _lines, lambda d: f"{S.language(d, 'text', ocr=True)} as language", "doc_id, idx", "texts")
_scalar("correct_ocr_errors", X.literals, lambda d: f"{S.correct_ocr(d, 'text')} as corrected", "id", "literals")


def _priced(d) -> dict[str, str]:
    return {**X.blocks(d), **X.literals(d), "texts": "select document_id, cast(idx as bigint) as idx, text from invoice_blocks union all select 'literal', cast(id as bigint), text from literals"}


_scalar("scalar_hp", _priced, lambda d: f"{S.scalar_hp(d, 'text')} as hp", "document_id, idx", "texts")
_scalar("scalar_model", _priced, lambda d: f"{S.scalar_model(d, 'text')} as model", "document_id, idx", "texts")


@plan
def value_ranges(d):
    """The ranges of power and cost, which differ between extraction, validation and evaluation."""
    inside = lambda x, r: f"{x} between {r[0]} and {r[1]}"
    columns = [("hp", n, r) for n, r in bank.HP_RANGES.items()] + [("cost", n, r) for n, r in bank.COST_RANGES.items()]
    return query(d, X.header(d), f"select ok, hp, cost, {', '.join(f'{inside(x, r)} as {x}_{n}' for x, n, r in columns)} from header")


@plan
def extract_numbers_indian(d):
    return query(d, _priced(d), f"select document_id, idx, n as number from texts {d.explode(S.numbers(d, 'text'), 'n')}")


def _boxes(d) -> dict[str, str]:
    return {**X.detections(d), **D.filtered()}


def _evaluated(d, inner: bool) -> dict[str, str]:
    return {**X.blocks(d), **X.truth(d), **E.fields(d), **_boxes(d), **D.kept_boxes(d), **D.summary(d), **P.flags(), **A.compared(d, inner)}


@plan
def document_accuracy(d):
    return query(d, {**_evaluated(d, False), **A.judged()}, A.accuracy(d))


@plan
def field_prf1(d):
    return query(d, {**_evaluated(d, True), **A.outcomes(d)}, A.METRICS)


@plan
def presence_prf1(d):
    pred = "length(text) > 200"
    steps = {"judged": f"select quality = 1 as due, {pred} as got from {d.table('labels')} l join {d.table('documents')} d on l.doc_id = d.doc_id"}
    return query(d, steps, f"select {d.count_if('due and got')} as tp, {d.count_if('got and not due')} as fp, {d.count_if('due and not got')} as fn, round({d.count_if('due and got')} / cast({d.count_if('got')} as double), 3) as precision_ from judged")


@plan
def similarity_ratio(d):
    steps = {**X.header(d), "names": f"select a, lower(a) as la, {F_.sorted_words(d, 'a')} as wa from (select distinct concat(nm, ' ', sfx) as a from header) x"}
    both, left, right = F_.set_forms(d, "x.a", "y.a")
    steps["pairs"] = f"select x.a as a, y.a as b, x.la as la, y.la as lb, x.wa as wa, y.wa as wb, {both} as c, {left} as l, {right} as r from names x join names y on x.a < y.a"
    final = f"select a, b, {F_.ratio(d, 'la', 'lb')} as ratio, {F_.ratio(d, 'wa', 'wb')} as token_sort, greatest({F_.ratio(d, 'c', 'l')}, {F_.ratio(d, 'c', 'r')}, {F_.ratio(d, 'l', 'r')}) as token_set, round({S.jaccard(d, 'a', 'b')}, 6) as word_jaccard from pairs"
    return query(d, steps, final)


@plan
def dealer_fuzzy_master(d):
    """Every distinct dealer candidate against the master names, best score above 75; the matched name once more."""
    steps = {**X.blocks(d), **X.masters(d), **E.prepared(d), **E.generated(d, ("dealer_name",)), **E.fuzzy_dealers(d)}
    return query(d, steps, "select document_id, s as candidate, m as matched, pct, round(conf, 6) as conf from matched")


@plan
def extract_fields_master(d):
    """C1 with master data: C5 among the strategies, and the boost of known models."""
    return query(d, {**X.blocks(d), **X.masters(d), **E.fields(d, masters=True)}, f"select document_id, dealer_name, model_name, horse_power, asset_cost, {rounded(d, *CONFS)}, {d.round6(E.overall())} as overall_confidence from extracted")


@plan
def line_groups(d):
    return query(d, {**X.blocks(d, jitter=True), **L.line_groups(d)}, "select document_id, idx, cast(line_no as bigint) as line_no, x1 from lined")


@plan
def text_sequence(d):
    return query(d, {**X.blocks(d, jitter=True), **L.sequence(d)}, "select document_id, text from sequences")


@plan
def detection_filter(d):
    return query(d, _boxes(d), "select doc, det_idx, class_name, confidence, x1, y1, x2, y2, area, cx, cy from passed")


@plan
def nms(d):
    return query(d, {**_boxes(d), **D.kept_boxes(d)}, "select doc, det_idx, class_name, confidence from kept")


@plan
def iou_pairs(d):
    return query(d, _boxes(d), f"select a.doc, a.det_idx as a, b.det_idx as b, round({S.iou('a.', 'b.')}, 6) as iou from passed a join passed b on a.doc = b.doc and a.det_idx < b.det_idx where {S.iou('a.', 'b.')} > 0")


@plan
def detection_summary(d):
    columns = ", ".join(f"{k}_present, {k}_count, {k}_confidence, round({k}_iou, 6) as {k}_iou, {k}_x1, {k}_y1, {k}_x2, {k}_y2" for k in D.CLASSES)
    return query(d, {**_boxes(d), **D.kept_boxes(d), **D.summary(d)}, f"select doc, {columns}, passes_threshold from box_summary")


@plan
def yolo_labels(d):
    return query(d, _boxes(d), f"select doc, det_idx, {D.label_line(d)} as line from boxes")


@plan
def ordered_split(d):
    return query(d, {**X.detections(d), **D.split()}, "select doc, part from parts")


@plan
def annotated_images(d):
    """Images with the boxes that their annotations give them, also images without any."""
    counts = ", ".join(f"{d.count_if(f'class_name = {chr(39)}{k}{chr(39)}')} as {k}s" for k in D.CLASSES)
    steps = {**X.detections(d), "noted": f"select doc, {counts} from true_boxes group by doc"}
    return query(d, steps, f"select i.doc, {', '.join(f'coalesce(n.{k}s, 0) as {k}s' for k in D.CLASSES)}, n.doc is not null as annotated from images i left join noted n on i.doc = n.doc")


@plan
def auto_annotate(d):
    pick = lambda k: d.count_if(f"class_name = '{k}'")
    return query(d, {**_boxes(d), **D.kept_boxes(d)}, f"select doc, {pick('signature')} as signatures, {pick('stamp')} as stamps, round(sum(x1 + y1 + x2 + y2), 6) as corner_sum from kept where confidence >= 0.6e0 group by doc having count(*) > 0")


VLM_ROWS = (
    '{"dealer_name": "Kumar Motors", "model_name": "575 DI", "horse_power": "50 HP", "asset_cost": "5,25,000", "signature_present": true, "stamp_present": false}',
    'text {"dealer_name": null, "model_name": "None", "horse_power": 45, "asset_cost": 600000.5, "signature_present": "True", "stamp_present": "no"} tail',
    "Dealer: Singh Traders, Model: SWARAJ 744 FE", "Horse power: 48 and cost: Rs 6,85,000", "no answer", '{"broken": ',
)


@plan
def vlm_parse(d):
    rows = ", ".join(f"({i}, '{t}')" for i, t in enumerate(VLM_ROWS))
    columns = ", ".join(f"{e} as {f}" for f, e in M.parsed(d, "response").items())
    return query(d, {"answers": f"select id, response from {d.values('id, response', rows)} r"}, f"select id, {columns} from answers")


@plan
def vlm_fallback_flag(d):
    return query(d, {**_validated(d), "summed": f"select *, {E.overall()} as overall from crossed"}, f"select document_id, {M.needs_fallback()} as needs_fallback from summed")


@plan
def vlm_merge(d):
    return query(d, {**_validated(d), **X.truth(d), **M.merge(d, "crossed", "invoice_truth")}, "select * from merged_fields")


def _results(d) -> dict[str, str]:
    return {**X.eval_results(d), **R.successes()}


@plan
def confidence_distribution(d):
    return query(d, _results(d), R.confidence(d))


@plan
def confidence_histogram(d):
    return query(d, {**_results(d), **R.histogram()}, "select bin, n from bins")


@plan
def time_against_confidence(d):
    """K8: the points of the scatter plot."""
    return query(d, _results(d), "select doc_id, sec, conf from successes")


@plan
def performance_metrics(d):
    return query(d, _results(d), R.performance(d))


@plan
def cost_metrics(d):
    return query(d, _results(d), R.cost(d))


@plan
def error_analysis(d):
    return query(d, _results(d), R.errors(d))


@plan
def error_samples(d):
    return query(d, _results(d), R.samples(d))


@plan
def field_issues(d):
    return query(d, _evaluated(d, True), f"select document_id, {A.field_issues(d)} as issues from extracted_eval")


@plan
def executive_summary(d):
    return query(d, {**_results(d), **R.summary(d)}, R.executive(d))


@plan
def recommendations(d):
    return query(d, {**_results(d), **R.summary(d)}, R.recommendations(d))


def _processed(d) -> dict[str, str]:
    return {**X.blocks(d), **X.detections(d), **X.timings(d), **P.plan(d)}


@plan
def process_documents(d):
    """The whole pipeline, one row for each image."""
    confs = ", ".join(f"{d.round6(f'{c}_conf')} as {c}_conf" for c in (*E.SHORT.values(), *D.CLASSES))
    return query(d, _processed(d), f"select document_id, status, error, dealer_name, model_name, horse_power, asset_cost, signature_present, stamp_present, {confs}, {d.round6('overall')} as overall_confidence, round(total_ms, 6) as total_ms, round(cost_usd, 12) as cost_usd, case when overall >= 0.85e0 then 'high' when overall >= 0.65e0 then 'medium' else 'low' end as band from results")


@plan
def batch_summary(d):
    return query(d, _processed(d), R.batch(d))


@plan
def public_output(d):
    confs = ", ".join(f"round({c}_conf, 4) as {c}_confidence" for c in (*E.SHORT.values(), *D.CLASSES))
    boxes = ", ".join(f"{k}_present, nullif(round({k}_iou, 4), 0) as {k}_iou, {k}_x1, {k}_y1, {k}_x2, {k}_y2" for k in D.CLASSES)
    return query(d, _processed(d), f"select document_id, dealer_name, model_name, horse_power, asset_cost, {confs}, {boxes}, round(overall, 4) as overall_confidence, round(total_ms, 2) as processing_time_ms, status from results")


@plan
def cost_estimate(d):
    total = "(ocr_ms + extraction_ms + detection_ms + validation_ms)"
    return query(d, X.timings(d), f"select document_id, round({S.cost_estimate(total)}, 12) as cpu_usd, round({S.cost_estimate(total, gpu=True)}, 12) as gpu_usd from timings")


@plan
def ocr_doc_stats(d):
    """Blocks, mean confidence and languages of each document."""
    lang = S.language(d, "text", ocr=True)
    return query(d, X.blocks(d), f"select document_id, cast(count(*) as bigint) as total_blocks, round(coalesce(avg(confidence), 0e0), 6) as avg_confidence, cast(count(distinct {lang}) as bigint) as languages from invoice_blocks group by document_id")


@plan
def pdf_page_stats(d):
    """Blocks, confidence and full text of each page; three blocks a page here."""
    steps = {**X.blocks(d), "paged": "select *, cast(floor(idx / 3) as bigint) + 1 as page from invoice_blocks"}
    return query(d, steps, f"select document_id, page, cast(count(*) as bigint) as block_count, round(avg(confidence), 6) as avg_confidence, {d.ordered_join('text', 'idx', ' ')} as full_text from paged group by document_id, page")


@plan
def region_text(d):
    """Text of the blocks inside a padded, clipped region."""
    steps = {**X.blocks(d), "inside": "select * from invoice_blocks where x1 >= greatest(0, 45 - 5) and y1 >= greatest(0, 100 - 5) and x2 <= least(600, 400 + 5) and y2 <= least(400, 250 + 5)", "documents_seen": "select distinct document_id from invoice_blocks"}
    steps["read_texts"] = f"select document_id, {d.ordered_join('text', 'idx', ' ')} as text from inside group by document_id"
    return query(d, steps, "select u.document_id, coalesce(r.text, '') as text from documents_seen u left join read_texts r on u.document_id = r.document_id")


@plan
def gt_join(d):
    return query(d, {**_evaluated(d, False)}, "select r.document_id, t.document_id is not null as has_truth, t.horse_power as true_hp from extracted_eval r left join invoice_truth t on r.document_id = t.document_id")


@plan
def master_semi_join(d):
    steps = {**X.blocks(d), **E.fields(d), **X.truth(d), "known_models": "select distinct model_name as known from invoice_truth"}
    return query(d, steps, "select document_id, model_name from extracted where model_name in (select known from known_models)")


@plan
def full_text(d):
    """The blocks of a document in order."""
    return query(d, X.blocks(d), f"select document_id, {d.ordered_join('text', 'idx', ' ')} as text from invoice_blocks group by document_id")


@plan
def conversation_text(d):
    """A21 over conversations: turns in order."""
    return query(d, {}, f"select conv_id, {d.ordered_join('text', 'turn', ' ')} as text from {d.table('conversations')} where conv_id is not null group by conv_id")


@plan
def extraction_report(d):
    """How many fields were found, and in how many documents all four."""
    every = " and ".join(f"{f} is not null" for f in bank.FIELDS)
    n = " + ".join(f"cast({f} is not null as int)" for f in bank.FIELDS)
    return query(d, {**X.blocks(d), **E.fields(d)}, f"select cast(count(*) as bigint) as total, cast(sum({n}) as bigint) as successful_fields, round(sum({n}) / (4e0 * count(*)), 6) as field_rate, round({d.count_if(every)} / cast(count(*) as double), 6) as all_four_rate, round(avg({E.overall()}), 6) as mean_confidence from extracted")


@plan
def stage_stats(d):
    """Times of a stage and its rate."""
    return query(d, X.eval_results(d), f"select cast(count(*) as bigint) as n, round(avg(ocr_time_sec * 1000), 6) as mean_ms, round(median(ocr_time_sec * 1000), 6) as median_ms, round(1 / avg(ocr_time_sec), 6) as pages_per_sec from eval_results")


@plan
def preprocess_params(d):
    """settings by image area, at the size of the image and of a scan four times as wide."""
    band = lambda a: f"case when {a} > 4000000 then 'very large' when {a} > 1000000 then 'large' else 'small' end"
    return query(d, X.detections(d), f"select doc, {band('width * height')} as band, {band('width * height * 16')} as scan_band from images")


@plan
def llm_prompt(d):
    """the prompt of the document's language around the first 300 characters of its text, a limit of the prompt itself."""
    lang = S.language_alias(S.language(d, "text", ocr=True))
    context = f"concat('OCR context: {chr(34)}', substring(text, 1, {bank.VLM_CONTEXT}), '...{chr(34)}')"
    text = lambda s: " || chr(10) || ".join(f"'{line}'" for line in s.split(chr(10)))
    when = " ".join(f"when '{k}' then {text(p)}" for k, p in bank.VLM_PROMPTS.items())
    steps = {**X.blocks(d), "full_texts": f"select document_id, {d.ordered_join('text', 'idx', ' ')} as text from invoice_blocks group by document_id", "spoken": f"select document_id, text, {lang} as language from full_texts"}
    return query(d, steps, f"select document_id, replace(case language {when} end, '{{context}}', case when text = '' then '' else {context} end) as prompt from spoken")


@plan
def document_ids(d):
    rows = "('/a/b/scan_01.png'), ('scan.tar.gz'), ('/x.y/noext'), ('s3://b/k/inv-7.PDF')"
    return query(d, {"paths": f"select path from {d.values('path', rows)} p"}, f"select path, {S.document_id(d, 'path')} as document_id from paths")


@plan
def validate_boxes(d):
    return query(d, {**_boxes(d), **D.kept_boxes(d), **D.summary(d)}, "select doc, class_name, confidence, round(adjusted, 6) as adjusted, usual_size from box_rules")


@plan
def language_aliases(d):
    return query(d, {"codes": f"select distinct lang as code from {d.table('documents')} union all select x from {d.values('x', "('HI'), ('Guj'), ('english'), ('xx')")} v"}, f"select code, {S.language_alias('code')} as language from codes")


def _normalized(spark: SparkSession, sf_dir: str) -> DataFrame:
    """F14b with F1's Unicode composition, which has no SQL: its twin goes without, as the tables' text is composed already."""
    from ..api import normalize_blocks

    blocks = spark.sql(query(Spark(sf_dir), X.blocks(Spark(sf_dir)), "select document_id, idx, text, confidence from invoice_blocks"))
    return normalize_blocks(blocks).selectExpr(*NORMALIZED.split(", "), "cast(size(numbers) as bigint) as n_numbers")


NORMALIZED = "document_id, idx, text, confidence, normalized_text, horse_power, model_name, language, has_currency, " + ", ".join(f"kw_{k}" for k in bank.KEYWORDS)
QUERIES["normalize_blocks"] = _normalized
ORACLES["normalize_blocks"] = query(Duck(), {**X.blocks(Duck()), "composed_blocks": "select *, text as composed from invoice_blocks", **N.normalized(Duck(), "composed_blocks")}, f"select {NORMALIZED}, cast(len(numbers) as bigint) as n_numbers from normalized_blocks")


def _progress(spark: SparkSession, sf_dir: str) -> DataFrame:
    from ..streaming.progress import progress

    return progress(spark.read.parquet(f"{sf_dir}/events.parquet"))


QUERIES["stream_progress"] = _progress
ORACLES["stream_progress"] = "select date_trunc('hour', ts) as window_start, event_type, cast(count(*) as bigint) as n, round(sum(value), 4) as total from events group by all"


def _source_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """S1 over any directory: here the Parquet files themselves stand for pictures."""
    from ..sources.readers import images

    return images(spark, sf_dir, ("parquet",)).select("document_id", "length")


QUERIES["document_source_scan"] = _source_scan
