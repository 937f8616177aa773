"""Inputs in the shape of invoices, detections and evaluation results, derived from the test tables."""

from __future__ import annotations


def header(d) -> dict[str, str]:
    """A row for each order: who sells what, at which power and cost."""
    return {
        "li": f"select l_orderkey as ok, min(l_partkey) as pk, min(l_suppkey) as sk from {d.table('lineitem')} group by l_orderkey",
        "header": f"""select ok, pk, sk, cast(20 + 2 * p_size as int) as hp, cast(floor(o_totalprice) as bigint) as cost,
            cast(floor(floor(o_totalprice) / 100000) as bigint) as lk, cast(floor(floor(o_totalprice) / 1000) as bigint) % 100 as th, cast(floor(o_totalprice) as bigint) % 1000 as un,
            case pk % 5 when 0 then 'MAHINDRA' when 1 then 'SWARAJ' when 2 then 'SONALIKA' when 3 then 'EICHER' else 'KUBOTA' end as brand,
            case pk % 9 when 0 then '265' when 1 then '275' when 2 then '475' when 3 then '575' when 4 then '585' when 5 then '735' when 6 then '744' when 7 then '855' else '963' end as mno,
            case sk % 7 when 0 then 'Rajesh' when 1 then 'Kumar' when 2 then 'Singh' when 3 then 'Patel' when 4 then 'Verma' when 5 then 'Sharma' else 'Gupta' end as nm,
            case sk % 4 when 0 then 'Motors Pvt Ltd' when 1 then 'Tractors' when 2 then 'Enterprises' else 'Private Limited' end as sfx
            from li join {d.table('orders')} on o_orderkey = ok join {d.table('part')} on p_partkey = pk""",
    }


def blocks(d, jitter: bool = False) -> dict[str, str]:
    """invoice_blocks(document_id, idx, text, confidence, x1, y1, x2, y2): nine blocks for each header row."""
    texts = [
        "case when ok % 3 = 0 then concat('M/s ', nm, ' ', sfx) when ok % 3 = 1 then upper(concat(nm, ' ', sfx)) else concat('Dealer: ', nm, ' ', sfx) end",
        "'Village: Rampur, Meerut'", "'QUOTATION'",
        "case when cast(floor(ok / 10) as bigint) % 2 = 0 then concat('Model: ', brand, ' ', mno, ' DI') else concat(brand, ' ', mno) end",
        "'Engine Specifications'",
        "case when ok % 3 = 0 then concat('Horse Power: ', hp, ' HP') when ok % 3 = 1 then concat(hp, ' kW') else concat('Power ', hp, ' BHP') end",
        "'Financial Details'", "concat('Price: ₹', cost)",
        "case when cast(floor(ok / 10) as bigint) % 2 = 0 and lk > 0 then concat('Grand Total: Rs. ', lk, ',', lpad(cast(th as varchar(9)), 2, '0'), ',', lpad(cast(un as varchar(9)), 3, '0')) else concat('Grand Total: ', lk, '.', lpad(cast(th as varchar(9)), 2, '0'), ' Lakh') end",
    ]
    y1 = "40 + cast(floor(idx / 2) as int) * 22 + cast((ok * idx) % 13 as int)" if jitter else "40 + idx * 30 + cast((ok * idx) % 7 as int)"
    return {
        **header(d),
        "invoice_texts": f"select ok, idx, text from header {d.explode(d.array(*texts), 'text', 'idx')}",
        "invoice_blocks": f"""select concat('inv_', ok) as document_id, cast(idx as int) as idx, text, cast(60 + (ok * 31 + idx * 17) % 40 as double) / 100 as confidence, x1, y1, x1 + 250 as x2, y1 + 20 as y2
            from (select ok, idx, text, cast(50 + (ok % 3) * 5 as int) as x1, cast({y1} as int) as y1 from invoice_texts) t""",
    }


def truth(d) -> dict[str, str]:
    """invoice_truth: the header as ground truth, some of it missing or off, some documents left out."""
    return {"invoice_truth": """select concat('inv_', ok) as document_id, concat(nm, ' ', sfx) as dealer_name, concat(brand, ' ', mno) as model_name,
        case when ok % 11 = 0 then hp * 1.1e0 else cast(hp as double) end as horse_power, case when ok % 7 = 0 then null else cast(cost as double) end as asset_cost,
        cast(floor(ok / 10) as bigint) % 2 = 1 as signature_present, cast(floor(ok / 10) as bigint) % 3 = 1 as stamp_present from header where ok % 13 <> 0"""}


def detections(d) -> dict[str, str]:
    """images(doc, width, height): one for each order; detections(doc, det_idx, class_name, confidence, x1, y1, x2, y2): one for each line of an order;
    true_boxes(doc, class_name, x1, y1, x2, y2): truth of most orders."""
    return {
        "images": f"select concat('inv_', o_orderkey) as doc, cast(600 + 100 * (o_orderkey % 3) as double) as width, cast(400 + 100 * (o_orderkey % 2) as double) as height from {d.table('orders')}",
        "detections": f"""select doc, det_idx, class_name, confidence, x1, y1, x1 + 40e0 + pk % 80 as x2, y1 + 20e0 + sk % 50 as y2 from
            (select concat('inv_', l_orderkey) as doc, cast(row_number() over (partition by l_orderkey order by l_linenumber, l_partkey, l_suppkey, l_extendedprice) as bigint) as det_idx, l_partkey as pk, l_suppkey as sk,
            case when l_partkey % 2 = 0 then 'signature' else 'stamp' end as class_name, cast(30 + (l_partkey * 37 + l_suppkey * 11) % 70 as double) / 100 as confidence,
            cast((l_orderkey * 53) % 580 + l_partkey % 40 as double) as x1, cast((l_orderkey * 29) % 380 + l_suppkey % 30 as double) as y1 from {d.table('lineitem')}) t""",
        "true_boxes": f"""select concat('inv_', o_orderkey) as doc, class_name, cast((o_orderkey * 53) % 580 + 10 as double) as x1, cast((o_orderkey * 29) % 380 + 8 as double) as y1,
            cast((o_orderkey * 53) % 580 + 100 as double) as x2, cast((o_orderkey * 29) % 380 + 55 as double) as y2
            from {d.table('orders')} {d.explode(d.array("'signature'", "'stamp'"), 'class_name')} where o_orderkey % 13 <> 0 and (class_name = 'signature' or o_orderkey % 4 <> 0)""",
    }


def timings(d) -> dict[str, str]:
    """timings(document_id, ocr_ms, extraction_ms, detection_ms, validation_ms): what the stages took on each order's document."""
    return {"timings": f"""select concat('inv_', o_orderkey) as document_id, 400e0 + o_custkey % 900 as ocr_ms, 20e0 + o_custkey % 100 as extraction_ms, 150e0 + o_orderkey % 200 as detection_ms, 5e0 + o_orderkey % 75 as validation_ms
        from {d.table('orders')}"""}


def masters(d) -> dict[str, str]:
    """master_dealers(dealer), master_models(model): names of some of the header rows."""
    return {
        "master_dealers": "select distinct concat(nm, ' ', sfx) as dealer from header where sk % 4 <> 3",
        "master_models": "select distinct concat(brand, ' ', mno) as model from header where pk % 2 = 0",
    }


def eval_results(d) -> dict[str, str]:
    """eval_results: one row for each event, with status, times and costs."""
    return {"eval_results": f"""select event_id as doc_id, case when event_type = 'error' then 'failed' else 'success' end as status, (event_id % 101) / 100e0 as confidence,
        value / 10 as processing_time_sec, value / 20000 as cost_estimate_usd, event_id % 4 = 0 as vlm_used,
        case when event_type = 'error' then case event_id % 5 when 0 then 'OCR failed' when 1 then 'out of memory' when 2 then 'timeout' when 3 then 'file not found' else 'boom' end end as error,
        value / 10 * 0.6e0 as ocr_time_sec, value / 10 * 0.1e0 as extraction_time_sec, value / 10 * 0.25e0 as detection_time_sec, value / 10 * 0.05e0 as vlm_time_sec,
        case when event_id % 7 <> 0 then concat('Dealer ', user_id) end as dealer_name, case when event_id % 9 = 0 then '' else '575 DI' end as model_name, cast(event_id % 260 as double) as horse_power,
        case when event_id % 5 <> 0 then 80000e0 + event_id % 100 * 60000 end as asset_cost, event_id % 2 = 0 as signature_present, event_id % 6 = 0 as signature_boxed, event_id % 3 = 0 as stamp_present, true as stamp_boxed
        from {d.table('events')}"""}


def text_blocks(d) -> dict[str, str]:
    """text_blocks(doc_id, idx, line): lines of documents that aren't blank."""
    return {"text_blocks": f"select doc_id, idx, line from {d.table('documents')} {d.explode(d.lines('text'), 'line', 'idx')} where length(trim(line)) > 0"}


LITERALS = (
    "M/s Kumar Motors, price ₹5,25,000", "Mahindra 575 DI 50 HP", "Rs. 4.5 lakh", "2.5 crore rupees", "मॉडल स्वराज ७४४ रुपए", "મોડેલ મહિન્દ્રા",
    "write to a.b@example.com or +91 9876543210", "PAN ABCDE1234F GST 22ABCDE1234F1Z5", "on 12/05/2024 card 1234 5678 9012", "invoice", "37.5 kW 40 HP", "power 45 units", "Type: XR-9,", "1O5", "l2O", "5S.2", "COMPANY Motors", "Srinivas Motors",
)


def literals(d) -> dict[str, str]:
    rows = ", ".join(f"({i}, '{t}')" for i, t in enumerate(LITERALS))
    return {"literals": f"select id, text from {d.values('id, text', rows)} l"}
