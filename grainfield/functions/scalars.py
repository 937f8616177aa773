"""Scalar rules over text, numbers and boxes, as SQL expressions of a dialect; each takes the SQL of its arguments."""

from __future__ import annotations

from functools import reduce

from . import bank
from .dialect import any_of


def strip(d, x: str) -> str:
    return d.replace_all(x, r"^\s+|\s+$", "")


def squeeze(d, x: str) -> str:
    return strip(d, d.replace_all(x, r"\s+", " "))


def clean_dealer(d, x: str) -> str:
    """prefix and trailing marks off, business suffix in one spelling, single spaces."""
    return squeeze(d, reduce(lambda s, step: d.replace_all(s, *step), bank.CLEAN_STEPS, x))


def digits(d, x: str) -> str:
    return f"length({d.replace_all(x, '[^0-9]', '')})"


def valid_dealer(d, x: str) -> str:
    """P8."""
    return f"(length({x}) >= 3 and not ({x} = lower({x}) and {x} <> upper({x})) and not {any_of(bank.REJECT_TERMS, f'upper({x})', d)} and {digits(d, x)} <= length({x}) * 0.3e0)"


def has_business_suffix(d, x: str) -> str:
    """P5."""
    return any_of(bank.BUSINESS_SUFFIXES, f"upper({x})", d)


def section_flag(d, x: str, section: str) -> str:
    """P6."""
    return any_of(bank.SECTION_KEYWORDS[section], x, d)


def block_numbers(d, x: str) -> str:
    """commas off, then every number."""
    return d.transform(d.extract_all(f"replace({x}, ',', '')", r"(\d+(?:\.\d+)?)"), lambda m: f"cast({m} as double)")


def keyword_flag(d, x: str, kind: str) -> str:
    """P7."""
    return any_of(bank.KEYWORDS[kind], f"lower({x})", d)


def has_currency(d, x: str) -> str:
    """P4."""
    return any_of(bank.CURRENCY, x, d)


def mask_pii(d, x: str) -> str:
    """in order, e-mail, phone, PAN, GST, Aadhaar, dates. Passes that can't match, for want of an @ or of any digit, are left out."""
    mail, numbered = bank.PII_STEPS[0], bank.PII_STEPS[1:]
    first = f"case when contains({x}, '@') then {d.replace_all(x, *mail)} else {x} end"
    return f"case when {d.matches(x, '[0-9]')} then {reduce(lambda s, step: d.replace_all(s, *step), numbered, first)} else {first} end"


def strip_currency(d, x: str) -> str:
    """without word boundaries; longest token first."""
    tokens = "|".join(t.replace(".", r"\.").replace("$", r"\$") for t in sorted(bank.CURRENCY, key=lambda t: (-len(t), t)))
    return d.replace_all(x, rf"(?i)({tokens})[\s:]*", "")


def normalize_text(d, x: str) -> str:
    """F1 for text in composed form: short plain lower-case text is only stripped."""
    fast = f"({d.matches(x, '^[\\x00-\\x7F]*$')} and length({x}) < 20 and {x} = lower({x}) and {x} <> upper({x}))"
    full = f"translate({strip_currency(d, mask_pii(d, x))}, '{bank.NOISE}', '')"
    return f"case when {x} is null or {x} = '' then '' when {fast} then {strip(d, x)} else lower({squeeze(d, d.replace_all(full, bank.SPECIAL, ' '))}) end"


def numbers(d, x: str, indian: bool = True) -> str:
    """amounts with a multiplier, then plain numbers, between 0 and 10^12; repeated ones once."""
    pairs = d.transform(d.extract_all(x, bank.MULTIPLIER, 0), lambda m: f"cast({d.extract(m, r'(\d+(?:\.\d+)?)')} as double) * case when lower({m}) like '%la%' then 100000e0 else 10000000e0 end")
    plain = d.transform(d.extract_all(x, f"({bank.INDIAN_NUMBER if indian else bank.PLAIN_NUMBER})"), lambda m: f"cast(replace({m}, ',', '') as double)")
    return d.distinct(d.keep(d.concat(pairs, plain), lambda v: f"{v} > 0 and {v} < 1e12"))


def scalar_hp(d, x: str) -> str:
    """first pattern whose first match is in range, else a number beside a power word."""
    low, high = bank.RULE_HP_RANGE
    factor = f"case when contains(lower({x}), 'kw') then 1.34e0 else 1e0 end"
    tries = [f"cast({d.extract(x, p)} as double) * {factor}" for p in bank.SCALAR_HP_PATTERNS]
    found = [f"case when {t} between {low} and {high} then {t} end" for t in tries]
    words = d.split(f"lower({strip(d, x)})", r"\s+")
    number = lambda i: f"try_cast(replace({d.get(words, i)}, ',', '') as double)"

    def beside(w: str, i: str) -> str:
        one, two = (f"case when {number(f'({i} {s} 1)')} between {low} and {high} then {number(f'({i} {s} 1)')} end" for s in "-+")
        return f"case when {any_of(('hp', 'power', 'हॉर्स', 'શક્તિ'), w, d)} then coalesce({one}, {two}) end"

    near = d.get(d.keep(d.transform(words, beside, index=True), lambda v: f"{v} is not null"), 0)
    return f"round(coalesce({', '.join(found)}, {near}), 1)"


def scalar_model(d, x: str) -> str:
    """last group of the first pattern that matches, else the word after model or type."""
    tries = [f"upper({strip(d, d.extract(x, p, g))})" for p, g in bank.SCALAR_MODEL_PATTERNS]
    found = [f"case when length({t}) >= 2 then {t} end" for t in tries]
    words = d.split(strip(d, x), r"\s+")
    after = d.transform(words, lambda w, i: f"case when lower({w}) in ('model', 'model:', 'type', 'type:') then upper({d.replace_all(d.get(words, f'({i} + 1)'), '[,:;.]$', '')}) end", index=True)
    return f"coalesce({', '.join(found)}, {d.get(d.keep(after, lambda v: f'length({v}) >= 2'), 0)})"


def script_length(d, x: str, pattern: str) -> str:
    return f"length({d.replace_all(x, f'[^{pattern}]', '')})"


def language(d, x: str, ocr: bool = False) -> str:
    """F8 (first 200 characters, 60%) or, with ocr, F9 (whole text, 30%)."""
    s = x if ocr else f"substring({x}, 1, 200)"
    hi, gu, en = (script_length(d, s, p) for p in ("ऀ-ॿ", "઀-૿", "A-Za-z"))
    total = f"({hi} + {gu} + {en})"
    names = ("hin", "guj", "eng") if ocr else ("hi", "gu", "en")
    least = "0.3e0" if ocr else "0.6e0"
    shares = " ".join(f"when {n} > {least} * {total} then '{name}'" for n, name in zip((hi, gu, en), names, strict=True))
    return f"case when {x} is null or {total} = 0 then 'unknown' {shares} when {hi} + {gu} > 0 then 'mixed' else '{names[2]}' end"


def correct_ocr(d, x: str) -> str:
    """each correction holds only if digits and points alone are left."""
    def step(s: str, pair: tuple[str, str]) -> str:
        new = f"replace({s}, '{pair[0]}', '{pair[1]}')"
        return f"case when contains({s}, '{pair[0]}') and {d.matches(f'''replace({new}, '.', '')''', '^[0-9]+$')} then {new} else {s} end"
    return reduce(step, bank.OCR_CORRECTIONS, x)


def iou(a: str, b: str) -> str:
    """F21 over boxes with columns {a}x1, {a}y1, {a}x2, {a}y2."""
    w = f"greatest(0e0, least({a}x2, {b}x2) - greatest({a}x1, {b}x1))"
    h = f"greatest(0e0, least({a}y2, {b}y2) - greatest({a}y1, {b}y1))"
    area = lambda p: f"({p}x2 - {p}x1) * ({p}y2 - {p}y1)"
    union = f"({area(a)} + {area(b)} - {w} * {h})"
    return f"case when {union} <= 0 then 0e0 else {w} * {h} / {union} end"


def jaccard(d, a: str, b: str) -> str:
    """F16 without an edit distance: shared words of all words."""
    if d.name == "spark":
        x, y = (f"array_distinct(filter(split(lower({s}), r'\\s+'), w -> w <> ''))" for s in (a, b))
        return f"case when size({x}) = 0 or size({y}) = 0 then 0e0 else cast(size(array_intersect({x}, {y})) as double) / size(array_union({x}, {y})) end"
    x, y = (f"list_distinct(list_filter(string_split_regex(lower({s}), '\\s+'), lambda w: w <> ''))" for s in (a, b))
    return f"case when len({x}) = 0 or len({y}) = 0 then 0e0 else len(list_intersect({x}, {y}))::double / len(list_distinct(list_concat({x}, {y}))) end"


def document_id(d, path: str) -> str:
    """the last component without its last suffix."""
    return d.extract(path, r"([^/]+?)(\.[^./]*)?$", 1)


def cost_estimate(ms: str, gpu: bool = False) -> str:
    """F24."""
    return f"{ms} / 1000e0 * ({bank.PRICE_PER_HOUR['gpu' if gpu else 'cpu']}e0 / 3600e0)"


def language_alias(x: str) -> str:
    """the language that a code or name stands for; English where unknown."""
    when = " ".join(f"when lower({x}) in ({', '.join(repr(a) for a in names)}) then '{lang}'" for lang, names in bank.LANGUAGE_ALIASES.items())
    return f"case {when} else 'english' end"
