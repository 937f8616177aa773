"""Candidates for the four text fields, their scores, and the best of each document.

One pass over a document's blocks generates the candidates of all fields; one aggregation by document and field picks
the best. Ties go to the first in generation order, encoded in `seq`: strategy, block position, pattern, match. A marker
candidate of no field stands for each document, so that documents without any other, or without text, stay in the same pass.
"""

from __future__ import annotations

from ..functions import bank, fuzzy
from ..functions.dialect import any_of, contains_any
from ..functions.scalars import block_numbers, clean_dealer, has_business_suffix, section_flag, strip, valid_dealer


def prepared(d, source: str = "invoice_blocks") -> dict[str, str]:
    """Blocks by position, blank ones (original = '') behind all others, with numbers, flags and section starts.

    Spark deals the bare blocks by document once, sorts them once, and cleans names only where a strategy can take them.
    """
    if d.name == "spark":
        by_place = "over (partition by document_id order by blank, idx)"
        return {
            "dealt": f"select /*+ repartition(document_id) */ document_id, idx, text, confidence from {source}",
            "stripped": f"select document_id, idx, {strip(d, 'text')} as original, confidence as conf from dealt",
            "sorted": "select *, case when original = '' then 1 else 0 end as blank from stripped",
            "placed": f"select *, cast(row_number() {by_place} - 1 as bigint) as pos from sorted",
            "cased": f"select *, lower(original) as text, upper(original) as big, {block_numbers(d, 'original')} as nums from placed",
            "flagged": f"""select *, {contains_any(bank.BLOCK_CURRENCY, 'original', d)} as has_currency, {contains_any(bank.BUSINESS_SUFFIXES, 'big', d)} as has_suffix, {contains_any(bank.BRANDS, 'big', d)} as has_brand,
                {', '.join(f"{contains_any(words, 'text', d)} as kw_{s}" for s, words in bank.SECTION_KEYWORDS.items())} from cased""",
            "windowed": f"""select *, min(case when kw_specs then pos end) over (partition by document_id) as specs_at, min(case when kw_financial then pos end) over (partition by document_id) as financial_at,
                nullif(lead(original) {by_place}, '') as next_original, lead(conf) {by_place} as next_conf, lead(nums) {by_place} as next_nums from flagged""",
            "prepared": f"""select *, case when pos < 15 and (has_suffix or {capital('original')}) then {clean_dealer(d, 'original')} end as own_name,
                case when pos < 20 and next_original is not null and size(nums) = 0 and size(next_nums) = 0 and {capital('original')} and {capital('next_original')} then {clean_dealer(d, "concat(original, ' ', next_original)")} end as joint_name from windowed""",
        }
    return {
        "stripped": f"select document_id, idx, {strip(d, 'text')} as original, confidence as conf from {source}",
        "placed": f"""select document_id, idx, original, conf, lower(original) as text, {clean_dealer(d, 'original')} as own_name, {block_numbers(d, 'original')} as nums,
            {any_of(bank.BLOCK_CURRENCY, 'original', d)} as has_currency, {has_business_suffix(d, 'original')} as has_suffix,
            cast(row_number() over (partition by document_id order by case when original = '' then 1 else 0 end, idx) - 1 as bigint) as pos from stripped""",
        "flagged": f"""select *, {', '.join(f"{section_flag(d, 'text', s)} as kw_{s}" for s in bank.SECTION_KEYWORDS)} from placed""",
        "windowed": """select *, min(case when kw_specs then pos end) over (partition by document_id) as specs_at, min(case when kw_financial then pos end) over (partition by document_id) as financial_at,
            nullif(lead(original) over (partition by document_id order by pos), '') as next_original, lead(conf) over (partition by document_id order by pos) as next_conf,
            lead(nums) over (partition by document_id order by pos) as next_nums from flagged""",
        "prepared": f"""select *, {clean_dealer(d, "concat(original, ' ', next_original)")} as joint_name from windowed""",
    }


def capital(x: str) -> str:
    return f"(substring({x}, 1, 1) = upper(substring({x}, 1, 1)) and substring({x}, 1, 1) <> lower(substring({x}, 1, 1)))"


def where(d, words: tuple[str, ...], x: str, array: str) -> str:
    """For Spark, the array only where the text x holds one of the words, without which its pattern can't match."""
    return f"case when {contains_any(words, x, d)} then {array} end" if d.name == "spark" else array


def candidate(d, field: str, seq: str, s: str = "cast(null as varchar(200))", v: str = "cast(null as double)", conf: str = "conf", source: str = "pattern") -> str:
    text = "string" if d.name == "spark" else "varchar"
    return d.struct(field=f"'{field}'", seq=f"cast({seq} as bigint)", s=f"cast({s.replace('varchar(200)', text)} as {text})", v=f"cast({v} as double)", conf=f"cast({conf} as double)", source=f"'{source}'")


#: Room in `seq` for 10^6 matches of 10^3 patterns in 10^6 blocks under each strategy; fuzzy matches keep the place of their candidate.
STRATEGY, FUZZY, FUZZY_AGAIN, FALLBACK = 10**15, 10**17, 2 * 10**17, 9 * 10**17


def seq(strategy: int, pattern: int | str = 0, match: str = "0") -> str:
    return f"{strategy} * {STRATEGY} + pos * 1000000000 + {pattern} * 1000000 + {match}"


def boosted(base: str, condition: str, factor: float, most: float) -> str:
    return f"(case when {condition} then least({base} * {factor}e0, {most}e0) else {base} end)"


def dealer_arrays(d) -> list[str]:
    """C2, C3, C4 and, as a strategy of its own, C6."""
    out = []
    for p, pattern in enumerate(bank.DEALER_PATTERNS):
        names = d.transform(d.extract_all("original", pattern), lambda m: clean_dealer(d, strip(d, m)))

        def scored(x: str, i: str, p: int = p) -> str:
            return candidate(d, "dealer_name", seq(1, p, i), s=x, conf=boosted("conf * 0.88e0", has_business_suffix(d, x), 1.15, 0.96))

        keep = d.keep(d.transform(names, scored, index=True), lambda c: valid_dealer(d, f"{c}.s"))
        out.append(f"case when pos < 25 then {where(d, bank.DEALER_WORDS[p], 'big', keep)} end")
    own = "own_name"
    one = candidate(d, "dealer_name", seq(2), s=own, conf="case when pos < 5 then least(conf * 0.82e0 * 1.12e0, 0.94e0) else conf * 0.82e0 end", source="business_suffix")
    out.append(f"case when pos < 15 and has_suffix and {valid_dealer(d, own)} then {d.array(one)} end")
    both = "joint_name"
    pair = candidate(d, "dealer_name", seq(3), s=both, conf="least(conf, next_conf) * 0.75e0", source="multiline")
    out.append(f"case when pos < 20 and next_original is not null and {capital('original')} and {capital('next_original')} and {d.size('nums')} = 0 and {d.size('next_nums')} = 0 and length({both}) > 10 and {valid_dealer(d, both)} then {d.array(pair)} end")
    last = candidate(d, "dealer_name", f"{FALLBACK} + pos", s=own, conf="conf * 0.60e0", source="fallback")
    out.append(f"case when pos < 10 and {capital('original')} and {d.matches('original', '[^ ] +[^ ]')} and {d.size('nums')} = 0 and {valid_dealer(d, own)} then {d.array(last)} end")
    return out


def model_arrays(d) -> list[str]:
    """C7 and C8, before the boost of known models."""
    out = []

    def kept(values: str, p: int) -> str:
        made = d.transform(values, lambda x, i: candidate(d, "model_name", seq(1, p, i), s=x, conf=boosted("conf * 0.90e0", any_of(bank.BRANDS, x, d), 1.10, 0.96)), index=True)
        return d.keep(made, lambda c: f"length({c}.s) between 2 and 40")

    for p, pattern in enumerate(bank.MODEL_PATTERNS):
        found = kept(d.transform(d.extract_all("original", pattern), lambda m: f"upper({strip(d, m)})"), p)
        out.append(where(d, bank.MODEL_WORDS[p], "big", found) if bank.MODEL_WORDS[p] else found if d.name == "duck" else f"case when size(nums) > 0 then {found} end")
    whole = d.extract_all("original", bank.BRAND_MODEL_PATTERN, 0)
    parts = lambda m: f"upper({strip(d, f'concat({d.extract(m, bank.BRAND_MODEL_PATTERN, 1)}, {chr(39)} {chr(39)}, {d.extract(m, bank.BRAND_MODEL_PATTERN, 2)})')})"
    branded = [kept(d.transform(whole, parts), len(bank.MODEL_PATTERNS))]
    big = "big" if d.name == "spark" else "upper(original)"
    for b, brand in enumerate(bank.BRANDS):
        after = strip(d, f"substring(original, cast(instr({big}, '{brand}') as int) + {len(brand)})")
        found = strip(d, d.extract(after, bank.BRAND_CONTEXT_PATTERN))
        one = candidate(d, "model_name", seq(2, b), s=f"upper(concat('{brand} ', {found}))", conf="conf * 0.85e0", source="brand_context")
        branded.append(f"case when contains({big}, '{brand}') and {d.matches(after, bank.BRAND_CONTEXT_PATTERN)} then {d.array(one)} end")
    return [*out, f"case when has_brand then {joined(d, branded)} end"] if d.name == "spark" else out + branded


def hp_arrays(d) -> list[str]:
    """C9 and C10."""
    low, high = bank.HP_RANGE
    conf = boosted("conf * 0.91e0", any_of(("horse", "power", "hp"), "text", d), 1.08, 0.96)
    out = []
    for p, pattern in enumerate(bank.HP_PATTERNS):
        values = d.keep(d.transform(d.extract_all("original", pattern), lambda m: f"cast({m} as double) * (case when contains(text, 'kw') then 1.34e0 else 1e0 end)"), lambda v: f"{v} between {low} and {high}")
        out.append(where(d, bank.HP_WORDS[p], "text", d.transform(values, lambda v, i, p=p: candidate(d, "horse_power", seq(1, p, i), v=f"round({v}, 1)", conf=conf), index=True)))
    spec = d.transform(d.keep("nums", lambda v: f"{v} between {low} and {high}"), lambda v, i: candidate(d, "horse_power", seq(2, 0, i), v=f"round({v}, 1)", conf="conf * 0.73e0", source="spec_section"), index=True)
    return [*out, f"case when pos between specs_at and specs_at + 5 then {spec} end"]


def cost_arrays(d) -> list[str]:
    """C11 and C12, with F13."""
    low, high = bank.COST_RANGE
    conf = boosted("conf * 0.86e0", any_of(("total", "grand", "payable", "net", "final"), "text", d), 1.12, 0.95)
    out = []
    for p, pattern in enumerate(bank.COST_PATTERNS):
        if p == bank.MULTIPLIER_PATTERN_NO:
            amount = lambda m, pattern=pattern: f"try_cast(replace({d.extract(m, pattern, 1)}, ',', '') as double) * (case when {d.matches(f'lower({d.extract(m, pattern, 2)})', 'lakh|lac')} then 100000e0 else 10000000e0 end)"
            values = d.transform(d.extract_all("original", pattern, 0), amount)
        else:
            n = lambda m: f"try_cast(replace({m}, ',', '') as double)"
            scaled = lambda m: f"{n(m)} * (case when contains(text, 'lakh') and {n(m)} < 1000 then 100000e0 when contains(text, 'lakh') then 1e0 when contains(text, 'crore') and {n(m)} < 100 then 10000000e0 else 1e0 end)"
            values = d.transform(d.extract_all("original", pattern), scaled)
        values = d.keep(values, lambda v: f"{v} between {low} and {high}")
        out.append(where(d, bank.COST_WORDS[p], "text", d.transform(values, lambda v, i, p=p: candidate(d, "asset_cost", seq(1, p, i), v=f"round({v}, 0)", conf=conf), index=True)))
    for k, mult in enumerate(("1e0", "100000e0", "10000000e0")):
        some = d.keep(d.transform("nums", lambda v, i, k=k, mult=mult: candidate(d, "asset_cost", seq(2, i, str(k)), v=f"round({v} * {mult}, 0)", conf="conf * 0.68e0", source="financial_section"), index=True), lambda c: f"{c}.v between {low} and {high}")
        out.append(f"case when pos between financial_at and financial_at + 7 and has_currency then {some} end")
    return out


ARRAYS = {"dealer_name": dealer_arrays, "model_name": model_arrays, "horse_power": hp_arrays, "asset_cost": cost_arrays}


def joined(d, arrays: list[str]) -> str:
    """The candidates of all arrays, a null one being empty."""
    kind = "array<struct<field:string,seq:bigint,s:string,v:double,conf:double,source:string>>" if d.name == "spark" else "struct(field varchar, seq bigint, s varchar, v double, conf double, source varchar)[]"
    empty = f"cast({'array()' if d.name == 'spark' else '[]'} as {kind})"
    return d.concat(*(f"coalesce({a}, {empty})" for a in arrays))


#: What a block must have for any candidate of a field.
NEEDS = {"dealer_name": "pos < 25", "model_name": "true", "horse_power": "size(nums) > 0", "asset_cost": "size(nums) > 0"}


def generated(d, fields: tuple[str, ...], name: str = "generated") -> dict[str, str]:
    """Every strategy in one generator, and the marker of each document."""
    marker = f"case when pos = 0 then {d.array(candidate(d, '', '0', conf='0e0', source=''))} end"
    if d.name == "spark":
        every = joined(d, [marker, *(f"case when {NEEDS[f]} then {joined(d, ARRAYS[f](d))} end" for f in fields)])
    else:
        every = joined(d, [marker, *(a for f in fields for a in ARRAYS[f](d))])
    return {name: f"select document_id, c.field as field, c.seq as seq, c.s as s, c.v as v, c.conf as conf, c.source as source from (select * from prepared) p {d.explode(every, 'c')}"}


def nearest_masters(d) -> dict[str, str]:
    """The best master above 75 of each of distinct_values(s, sw)."""
    low, high = "cast(ceil(0.6e0 * length(mw)) as bigint)", "cast(floor(length(mw) / 0.6e0) as bigint)"
    return {
        "masters": f"select m, {fuzzy.sorted_words(d, 'm')} as mw from (select distinct dealer as m from master_dealers) x",
        "masters_by_length": f"select m, mw, n from (select m, mw, {d.sequence(low, high)} as ns from masters where length(mw) > 0) x {d.explode('ns', 'n')}",
        "scored": f"select s, m, {fuzzy.ratio(d, 'mw', 'sw')} as pct from distinct_values join masters_by_length on n = length(sw)",
        "nearest": f"select s, {d.first_by('m', d.struct(a='-pct', b='m'))} as m, max(pct) as pct from scored group by s having max(pct) > 75",
    }


def fuzzy_dealers(d, source: str = "generated") -> dict[str, str]:
    """Each distinct dealer candidate of a document against master_dealers(dealer), the best above 75; the matched name once more, matched with itself.

    Distinct names are joined with the masters whose length can score above 75, by an equi-join on the length, and only then compared.
    """
    return {
        "firsts": f"select document_id, s, {d.first_by('conf', 'seq')} as conf, min(seq) as seq from {source} where field = 'dealer_name' and seq < {FALLBACK} group by document_id, s",
        "distinct_values": f"select s, {fuzzy.sorted_words(d, 's')} as sw from (select distinct s from firsts) x",
        **nearest_masters(d),
        "with_own": f"select *, {d.collect('s')} over (partition by document_id) as own from firsts",
        "matches": """select f.document_id, f.s, n.m, n.pct, f.seq, least(f.conf * (n.pct / 90), 0.97e0) as conf, array_contains(f.own, n.m) as seen,
            row_number() over (partition by f.document_id, n.m order by f.seq) as turn from with_own f join nearest n on f.s = n.s""",
        "matched": f"""select document_id, case when again = 0 then s else m end as s, m, case when again = 0 then pct else 100e0 end as pct, case when again = 0 then conf else least(conf * (100e0 / 90), 0.97e0) end as conf,
            seq + case when again = 0 then {FUZZY} else {FUZZY_AGAIN} end as seq from matches {d.explode(d.array('0', '1'), 'again')} where again = 0 or (not seen and turn = 1)""",
    }


def candidates(d, fields: tuple[str, ...] = bank.FIELDS, masters: bool = False) -> dict[str, str]:
    """candidates(document_id, field, seq, s, v, conf, source). `masters`: the tables master_dealers(dealer) and master_models(model) are there, for C5 and the boost of known models in C7."""
    if not masters:
        return generated(d, fields, "candidates")
    known = f"g.field = 'model_name' and g.seq < {2 * STRATEGY} and k.known is not null"
    none = "cast(null as double)"
    return {
        **generated(d, fields), **generated(d, ("dealer_name",), "dealers_generated"), **fuzzy_dealers(d, "dealers_generated"), "known_models": "select distinct model as known from master_models",
        "candidates": f"""select g.document_id, g.field, g.seq, g.s, g.v, case when {known} then least(g.conf * 1.08e0, 0.98e0) else g.conf end as conf, g.source from generated g left join known_models k on g.s = k.known
            union all select document_id, 'dealer_name', seq, m, {none}, conf, 'fuzzy_match' from matched""",
    }


def best(d) -> dict[str, str]:
    """Candidates of one value count once, with their best score and first place; then the best score, first place.

    The dealer fallback counts only where nothing else was found.
    """
    order = lambda *by: f"{d.struct(**{f'o{i}': b for i, b in enumerate(by)})}"
    return {
        "ranked": f"select *, seq >= {FALLBACK} as fallback from candidates",
        "by_value": f"""select document_id, field, fallback, s, v, max(conf) as conf, min(case when field in ('dealer_name', 'model_name') then null else seq end) as first_seq,
            {d.first_by('source', order('-conf', 'seq'))} as source, {d.first_by('seq', order('-conf', 'seq'))} as best_seq from ranked group by document_id, field, fallback, s, v""",
        "best": f"""select document_id, field, {d.first_by('s', order('fallback', '-conf', 'coalesce(first_seq, best_seq)'))} as s, {d.first_by('v', order('fallback', '-conf', 'coalesce(first_seq, best_seq)'))} as v,
            {d.first_by('conf', order('fallback', '-conf', 'coalesce(first_seq, best_seq)'))} as conf, {d.first_by('source', order('fallback', '-conf', 'coalesce(first_seq, best_seq)'))} as source
            from by_value group by document_id, field""",
    }


def best_with_masters(d) -> dict[str, str]:
    """For Spark, what candidates() with masters and best() give together, from one pass over the blocks: extracted, as fields() has it.

    The candidates of a document become one row, which is shuffled once and read twice: for the distinct dealer names, and for the rest.
    (By all columns but the names: an exchange by document alone falls away as redundant, and one that either reader needs less of isn't shared.)
    Only names are joined with the masters, both kinds in one join; a row of field '', which no master has, carries the document, its
    power and its cost. `lead` is the order of the first among the best candidates of a value; 1 stands for the scores of known models.
    """
    lead = lambda conf: d.struct(k=f"-{conf}", seq="seq")
    known = f"case when field = 'model_name' and seq < {2 * STRATEGY} then least(conf * 1.08e0, 0.98e0) else conf end"
    number = lambda f: f"min_by({d.struct(v='v', conf='conf0')}, {d.struct(k='-conf0', seq='first_seq')}) filter (where field = '{f}')"
    columns = "field", "fallback", "s", "conf0", "lead0", "conf1", "lead1", "own_conf", "first_seq"
    marker = d.struct(field="''", fallback="false", s="cast(document_id as string)", conf0="0e0", lead0="min(lead0)", conf1="0e0", lead1="min(lead0)", own_conf="0e0", first_seq="0L")
    once = "least(own_conf * (pct / 90), 0.97e0)"
    again = f"least({once} * (100e0 / 90), 0.97e0)"
    fuzzy_row = lambda conf, at: d.struct(s="m", conf=conf, lead=d.struct(k=f"-{conf}", seq=f"first_seq + {at}"))
    plain, boost = (d.struct(s="s", conf=f"conf{i}", lead=f"lead{i}") for i in (0, 1))
    rows = f"""case when m is null then {d.array(plain)} when field = 'model_name' then {d.array(boost)}
        when not array_contains(own, m) and turn = 1 then {d.array(plain, fuzzy_row(once, FUZZY), fuzzy_row(again, FUZZY_AGAIN))} else {d.array(plain, fuzzy_row(once, FUZZY))} end"""
    dealers = "field = 'dealer_name' and not fallback"
    text = lambda f: f"min_by({d.struct(s='s', conf='conf')}, {d.struct(o0='fallback', o1='-conf', o2='lead.seq')}) filter (where field = '{f}')"
    return {
        **generated(d, bank.FIELDS),
        "valued": f"""select document_id, field, fallback, s, v, max(conf) as conf0, min({lead('conf')}) as lead0, max(boosted) as conf1, min({lead('boosted')}) as lead1, min_by(conf, seq) as own_conf, min(seq) as first_seq
            from (select *, seq >= {FALLBACK} as fallback, {known} as boosted from generated) g group by document_id, field, fallback, s, v""",
        "found": f"""select document_id, concat({d.array(marker)}, collect_list({d.struct(**{c: c for c in columns})}) filter (where field in ('dealer_name', 'model_name'))) as names,
            {number('horse_power')} as hp, {number('asset_cost')} as cost from valued group by document_id""",
        "dealt_again": "select /*+ repartition(document_id, hp, cost) */ document_id, names, hp, cost from found",
        "named": "select document_id, case when n.field = '' then hp end as hp, case when n.field = '' then cost end as cost, n.* from dealt_again lateral view explode(names) x as n",
        "distinct_values": f"select s, {fuzzy.sorted_words(d, 's')} as sw from (select distinct s from named where {dealers}) x",
        **nearest_masters(d),
        "known_names": "select 'dealer_name' as kind, s as name, m, pct from nearest union all select distinct 'model_name', model, model, 100e0 from master_models where model is not null",
        "looked_up": "select n.*, k.m, k.pct from named n left join known_names k on k.kind = n.field and k.name = n.s and not n.fallback",
        "with_own": f"select *, collect_list(case when {dealers} then s end) over (partition by document_id) as own, row_number() over (partition by document_id, m order by field, first_seq) as turn from looked_up",
        "refined": f"select document_id, field, fallback, hp, cost, r.s as s, r.conf as conf, r.lead as lead from with_own lateral view explode({rows}) y as r",
        "merged": "select document_id, field, fallback, s, max(conf) as conf, min(lead) as lead, max(hp) as hp, max(cost) as cost from refined group by document_id, field, fallback, s",
        "picked": f"select document_id, {text('dealer_name')} as dealer, {text('model_name')} as model, max(hp) as hp, max(cost) as cost from merged group by document_id",
        "extracted": """select document_id, dealer.s as dealer_name, coalesce(dealer.conf, 0e0) as dealer_conf, model.s as model_name, coalesce(model.conf, 0e0) as model_conf,
            hp.v as horse_power, coalesce(hp.conf, 0e0) as hp_conf, cast(cost.v as bigint) as asset_cost, coalesce(cost.conf, 0e0) as cost_conf from picked""",
    }


def fields(d, source: str = "invoice_blocks", masters: bool = False) -> dict[str, str]:
    """extracted(document_id, dealer_name, dealer_conf, ...): every document of the source, also ones without text."""
    if masters and d.name == "spark":
        return {**prepared(d, source), **best_with_masters(d)}
    pick = lambda f, c: f"max(case when field = '{f}' then {c} end)"
    return {
        **prepared(d, source), **candidates(d, masters=masters), **best(d),
        "extracted": f"""select document_id, {pick('dealer_name', 's')} as dealer_name, coalesce({pick('dealer_name', 'conf')}, 0e0) as dealer_conf,
            {pick('model_name', 's')} as model_name, coalesce({pick('model_name', 'conf')}, 0e0) as model_conf, {pick('horse_power', 'v')} as horse_power, coalesce({pick('horse_power', 'conf')}, 0e0) as hp_conf,
            cast({pick('asset_cost', 'v')} as bigint) as asset_cost, coalesce({pick('asset_cost', 'conf')}, 0e0) as cost_conf
            from best group by document_id""",
    }


SHORT = {"dealer_name": "dealer", "model_name": "model", "horse_power": "hp", "asset_cost": "cost"}


def overall(prefix: str = "", boxes: bool = False) -> str:
    """Weighted mean of the confidences of the fields that are there; with `boxes`, of signature and stamp too."""
    there = {f: (f"{prefix}{f} is not null", f"{prefix}{SHORT[f]}_conf") for f in bank.FIELDS} | {s: (f"coalesce({prefix}{s}_present, false)", f"{prefix}{s}_conf") for s in ("signature", "stamp") if boxes}
    top = " + ".join(f"case when {is_there} then {bank.WEIGHTS[f]}e0 * {conf} else 0e0 end" for f, (is_there, conf) in there.items())
    weight = " + ".join(f"case when {is_there} then {bank.WEIGHTS[f]}e0 else 0e0 end" for f, (is_there, _) in there.items())
    return f"case when ({weight}) = 0 then 0e0 else ({top}) / ({weight}) end"


def light_validation(d) -> dict[str, str]:
    """Halved or cut confidence out of range, and a cut where the first model key inside the model expects another power."""
    expected = "case " + " ".join(f"when contains(model_name, '{k}') then {v}" for k, v in bank.MODEL_HP.items()) + " end"
    return {"light": f"""select document_id, dealer_name, dealer_conf, model_name, model_conf, horse_power, asset_cost,
        hp_conf * case when horse_power is not null and not horse_power between {bank.HP_RANGE[0]} and {bank.HP_RANGE[1]} then 0.5e0 else 1e0 end
          * case when horse_power <> 0 and abs(horse_power - ({expected})) > 10 then 0.75e0 else 1e0 end as hp_conf,
        cost_conf * case when asset_cost is not null and not asset_cost between {bank.COST_RANGE[0]} and {bank.COST_RANGE[1]} then 0.6e0 else 1e0 end as cost_conf from extracted"""}
