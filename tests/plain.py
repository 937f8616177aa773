"""The field rules once more in plain Python, apart from the SQL, over the same fixed values."""

import re
from dataclasses import dataclass

from grainfield.functions import bank


@dataclass
class Found:
    value: object
    score: float


def stripped(text):
    return re.sub(r"^\s+|\s+$", "", text)


def clean(name):
    for pattern, by in bank.CLEAN_STEPS:
        name = re.sub(pattern, by, name)
    return stripped(re.sub(r"\s+", " ", name))


def holds(words, text):
    return any(w in text for w in words)


def numbers(text):
    return [float(m) for m in re.findall(r"\d+(?:\.\d+)?", text.replace(",", ""))]


def plausible(name):
    lower_only = name == name.lower() and name != name.upper()
    return len(name) >= 3 and not lower_only and not holds(bank.REJECT_TERMS, name.upper()) and sum(c in "0123456789" for c in name) <= 0.3 * len(name)


def raised(score, condition, factor, most):
    return min(score * factor, most) if condition else score


def one_group(pattern, text):
    return [m.group(1) for m in re.finditer(pattern, text)]


def section(lines, name, length):
    starts = [i for i, (text, _) in enumerate(lines) if holds(bank.SECTION_KEYWORDS[name], text.lower())]
    return range(starts[0], min(starts[0] + length, len(lines))) if starts else range(0)


def starts_high(text):
    return text[:1] == text[:1].upper() and text[:1] != text[:1].lower()


def dealers(lines):
    out = []
    for i, (text, conf) in enumerate(lines[:25]):
        for pattern in bank.DEALER_PATTERNS:
            for name in map(clean, map(stripped, one_group(pattern, text))):
                if plausible(name):
                    out.append((1, i, Found(name, raised(conf * 0.88, holds(bank.BUSINESS_SUFFIXES, name.upper()), 1.15, 0.96))))
    for i, (text, conf) in enumerate(lines[:15]):
        if holds(bank.BUSINESS_SUFFIXES, text.upper()) and plausible(clean(text)):
            out.append((2, i, Found(clean(text), min(conf * 0.82 * 1.12, 0.94) if i < 5 else conf * 0.82)))
    for i in range(min(20, len(lines) - 1)):
        (a, ca), (b, cb) = lines[i : i + 2]
        both = clean(f"{a} {b}")
        if starts_high(a) and starts_high(b) and not numbers(a) and not numbers(b) and len(both) > 10 and plausible(both):
            out.append((3, i, Found(both, min(ca, cb) * 0.75)))
    if not out:
        out = [(9, i, Found(clean(t), c * 0.60)) for i, (t, c) in enumerate(lines[:10]) if starts_high(t) and len(t.split()) > 1 and not numbers(t) and plausible(clean(t))]
    return [f for _, _, f in sorted(out, key=lambda x: x[:2])]


def models(lines):
    out = []
    for i, (text, conf) in enumerate(lines):
        names = [stripped(m).upper() for p in bank.MODEL_PATTERNS for m in one_group(p, text)]
        names += [stripped(f"{m.group(1)} {m.group(2)}").upper() for m in re.finditer(bank.BRAND_MODEL_PATTERN, text)]
        out += [(1, i, Found(n, raised(conf * 0.90, holds(bank.BRANDS, n), 1.10, 0.96))) for n in names if 2 <= len(n) <= 40]
        for brand in bank.BRANDS:
            if brand in text.upper():
                after = stripped(text[text.upper().index(brand) + len(brand) :])
                m = re.search(bank.BRAND_CONTEXT_PATTERN, after)
                if m:
                    out.append((2, i, Found(f"{brand} {stripped(m.group(1))}".upper(), conf * 0.85)))
    return [f for _, _, f in sorted(out, key=lambda x: x[:2])]


def powers(lines):
    low, high = bank.HP_RANGE
    out = []
    for text, conf in lines:
        factor = 1.34 if "kw" in text.lower() else 1.0
        score = raised(conf * 0.91, holds(("horse", "power", "hp"), text.lower()), 1.08, 0.96)
        for v in (float(m) * factor for p in bank.HP_PATTERNS for m in one_group(p, text)):
            if low <= v <= high:
                out.append(Found(round(v, 1), score))
    out += [Found(round(v, 1), lines[i][1] * 0.73) for i in section(lines, "specs", 6) for v in numbers(lines[i][0]) if low <= v <= high]
    return out


def amount(text):
    try:
        return float(text.replace(",", ""))
    except ValueError:
        return None


def costs(lines):
    low, high = bank.COST_RANGE
    out = []
    for text, conf in lines:
        lower = text.lower()
        score = raised(conf * 0.86, holds(("total", "grand", "payable", "net", "final"), lower), 1.12, 0.95)
        for no, pattern in enumerate(bank.COST_PATTERNS):
            for m in re.finditer(pattern, text):
                v = amount(m.group(1))
                if v is None:
                    continue
                if no == bank.MULTIPLIER_PATTERN_NO:
                    v *= 1e5 if m.group(2).lower() in ("lakh", "lac") else 1e7
                elif "lakh" in lower:
                    v *= 1e5 if v < 1000 else 1
                elif "crore" in lower and v < 100:
                    v *= 1e7
                if low <= v <= high:
                    out.append(Found(round(v), score))
    for i in section(lines, "financial", 8):
        if holds(bank.BLOCK_CURRENCY, lines[i][0]):
            out += [Found(round(v * by), lines[i][1] * 0.68) for v in numbers(lines[i][0]) for by in (1, 1e5, 1e7) if low <= round(v * by) <= high]
    return out


def best(found, merge):
    """The first of the highest score; with `merge`, equal values count once, with their best score and first place."""
    if not found:
        return None, 0.0
    if merge:
        once = {}
        for f in found:
            once[f.value] = max(f.score, once.get(f.value, 0.0))
        found = [Found(v, s) for v, s in once.items()]
    top = max(found, key=lambda f: f.score)
    return top.value, top.score


def fields(blocks):
    """(value, confidence) of the four fields of a document's blocks [(text, confidence)]."""
    lines = [(stripped(t), c) for t, c in blocks if stripped(t)]
    return [best(dealers(lines), False), best(models(lines), False), best(powers(lines), True), best(costs(lines), True)]


def checked(found):
    """The four confidences after rules and cross checks."""
    (dealer, dc), (model, mc), (hp, hc), (cost, cc) = found
    clip = lambda x: min(max(x, 0.30), 0.98)
    if dealer is not None:
        n = len(stripped(dealer))
        for bad, factor in ((n < 3, 0.6), (n > 100, 0.7), (sum(c in "0123456789" for c in dealer) > 3, 0.75)):
            dc *= factor if bad else 1
        for good, factor in ((holds(bank.RULE_SUFFIXES, dealer.lower()), 1.15), (dealer != dealer.lower(), 1.05), (not re.search(bank.RULE_SPECIAL, dealer), 1.08)):
            dc *= factor if good else 1
        dc = clip(dc)
    if model is not None:
        n = len(stripped(model))
        mc *= (0.6 if n < 2 else 1) * (0.7 if n > 30 else 1)
        for good, factor in ((re.search(bank.RULE_MODEL, model), 1.20), (holds(bank.RULE_BRANDS, model.upper()), 1.15), (re.search("[0-9]", model), 1.10)):
            mc *= factor if good else 1
        mc = clip(mc)
    if hp is not None:
        hc *= 1 if hp > 0 else 0.5
        for good, factor in ((bank.RULE_HP_RANGE[0] <= hp <= bank.RULE_HP_RANGE[1], 1.15), (20 <= hp <= 100, 1.08), (hp == int(hp), 1.05)):
            hc *= factor if good else 1
        hc = clip(hc)
    if cost is not None:
        cc *= 1 if cost > 0 else 0.5
        for good, factor in ((bank.RULE_COST_RANGE[0] <= cost <= bank.RULE_COST_RANGE[1], 1.15), (cost % 1000 == 0, 1.06), (200000 <= cost <= 2000000, 1.08)):
            cc *= factor if good else 1
        cc = clip(cc)
    key = stripped(model).upper() if model else ""
    known = bank.MODEL_HP_RANGES.get(key) or next((r for k, r in bank.MODEL_HP_RANGES.items() if key and (k in key or key in k)), None)
    if known and hp is not None:
        factor = 1.18 if known[0] <= hp <= known[1] else 0.75
        hc, mc = min(hc * factor, 0.98), min(mc * factor, 0.98)
    if hp is not None and cost is not None:
        low, high = (hp * p for p in bank.COST_PER_HP)
        factor = 1.12 if low <= cost <= high else 0.65 if cost < low * 0.5 or cost > high * 2 else 0.85
        hc, cc = min(hc * factor, 0.98), min(cc * factor, 0.98)
    if dealer is not None and model is not None and any(b in dealer.upper() and b in model.upper() for b in bank.RULE_BRANDS):
        dc *= 1.06
    return [min(dc, 0.98), mc, hc, cc]
