"""Rule tables that adjust confidence, and checks across fields."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass, replace

from ..functions import bank
from ..functions.dialect import any_of
from .extract import SHORT

LEAST, MOST = 0.30, 0.98


@dataclass(frozen=True)
class Rule:
    """A predicate over a value's SQL; a boost counts when it holds, a penalty when it doesn't."""

    name: str
    holds: Callable
    factor: float
    boost: bool
    severity: str = "low"


def _length(low: int, high: int) -> Callable:
    return lambda d, x: f"length(trim({x})) between {low} and {high}"


RULES: dict[str, tuple[Rule, ...]] = {
    "dealer_name": (
        Rule("min_length", _length(3, 1 << 30), 0.6, False, "high"),
        Rule("max_length", _length(0, 100), 0.7, False, "medium"),
        Rule("no_excessive_digits", lambda d, x: f"length({d.replace_all(x, '[^0-9]', '')}) <= 3", 0.75, False, "medium"),
        Rule("has_suffix", lambda d, x: any_of(bank.RULE_SUFFIXES, f"lower({x})", d), 1.15, True),
        Rule("capitalized", lambda d, x: f"{x} <> lower({x})", 1.05, True),
        Rule("no_special_chars", lambda d, x: f"not {d.matches(x, bank.RULE_SPECIAL)}", 1.08, True),
    ),
    "model_name": (
        Rule("min_length", _length(2, 1 << 30), 0.6, False, "high"),
        Rule("max_length", _length(0, 30), 0.7, False, "medium"),
        Rule("pattern_match", lambda d, x: d.matches(x, bank.RULE_MODEL), 1.20, True),
        Rule("has_brand", lambda d, x: any_of(bank.RULE_BRANDS, f"upper({x})", d), 1.15, True),
        Rule("has_digits", lambda d, x: d.matches(x, "[0-9]"), 1.10, True),
    ),
    "horse_power": (
        Rule("is_numeric", lambda d, x: f"{x} > 0", 0.5, False, "high"),
        Rule("in_valid_range", lambda d, x: f"{x} between {bank.RULE_HP_RANGE[0]} and {bank.RULE_HP_RANGE[1]}", 1.15, True, "medium"),
        Rule("reasonable_value", lambda d, x: f"{x} between 20 and 100", 1.08, True),
        Rule("not_fractional", lambda d, x: f"{x} = floor({x})", 1.05, True),
    ),
    "asset_cost": (
        Rule("is_numeric", lambda d, x: f"{x} > 0", 0.5, False, "high"),
        Rule("in_valid_range", lambda d, x: f"{x} between {bank.RULE_COST_RANGE[0]} and {bank.RULE_COST_RANGE[1]}", 1.15, True, "medium"),
        Rule("reasonable_rounding", lambda d, x: f"{x} % 1000 = 0", 1.06, True),
        Rule("typical_range", lambda d, x: f"{x} between 200000 and 2000000", 1.08, True),
    ),
}
#: Boxes: least and most area of the second boost; the first is for a box of four numbers.
BOX_AREAS = {"signature": (100, 100000), "stamp": (400, 200000)}


@dataclass(frozen=True)
class ValidatorConfig:
    """The rules of each field, in order. with_rule() gives a config with one more."""

    rules: tuple = tuple(RULES.items())

    def with_rule(self, field: str, rule: Rule) -> ValidatorConfig:
        """V12."""
        return replace(self, rules=tuple((f, (*r, rule) if f == field else r) for f, r in self.rules))


def clip(x: str) -> str:
    return f"least(greatest({x}, {LEAST}e0), {MOST}e0)"


def ruled(d, field: str, conf: str, rules: tuple[Rule, ...]) -> str:
    """V2: the confidence after all rules in order, clipped; untouched without a value."""
    out = conf
    for r in rules:
        condition = r.holds(d, field)
        out = f"({out}) * (case when {condition if r.boost else f'not ({condition})'} then {r.factor}e0 else 1e0 end)"
    return f"case when {field} is null then {conf} else {clip(out)} end"


def names(d, field: str, rules: tuple[Rule, ...], boosts: bool, severity: str | None = None) -> str:
    """Names of the rules that took effect, in order, joined by commas; empty if none."""
    hits = [f"case when {r.holds(d, field) if r.boost else f'not ({r.holds(d, field)})'} then '{r.name}' end" for r in rules if r.boost == boosts and severity in (None, r.severity)]
    return f"case when {field} is null then '' else {d.join(d.keep(d.array(*hits), lambda v: f'{v} is not null'), ',')} end" if hits else "''"


def hp_range(d, m: str) -> str:
    """The range of the exact key, else of the first key that holds the model (upper case) or is held by it."""
    ranges = d.array(*(d.struct(k=f"'{k}'", low=str(low), high=str(high)) for k, (low, high) in bank.MODEL_HP_RANGES.items()))
    exact, partial = d.keep(ranges, lambda r: f"{r}.k = {m}"), d.keep(ranges, lambda r: f"contains({m}, {r}.k) or contains({r}.k, {m})")
    return f"case when {m} <> '' then coalesce({d.get(exact, 0)}, {d.get(partial, 0)}) end"


def validated(d, source: str = "extracted", config: ValidatorConfig = ValidatorConfig()) -> dict[str, str]:
    """V1: rules, then model against power, power against cost, dealer against model, in that order."""
    rules = dict(config.rules)
    cap = lambda x: f"least({x}, {MOST}e0)"
    per_min, per_max = (f"horse_power * {p}" for p in bank.COST_PER_HP)
    shared = " or ".join(f"(contains(upper(dealer_name), '{b}') and contains(upper(model_name), '{b}'))" for b in bank.RULE_BRANDS)
    return {
        "ruled": "select document_id, dealer_name, model_name, horse_power, asset_cost, " + ", ".join(
            f"{ruled(d, f, f'{SHORT[f]}_conf', r)} as {SHORT[f]}_conf, {names(d, f, r, False)} as {SHORT[f]}_issues, {names(d, f, r, True)} as {SHORT[f]}_boosts, {names(d, f, r, False, 'high')} as {'hp_sev' if f == 'horse_power' else SHORT[f] + '_high'}" for f, r in rules.items()
        ) + f" from {source}",
        "ranged": f"select *, hp_range.low as hp_low, hp_range.high as hp_high from (select *, {hp_range(d, 'model_upper')} as hp_range from (select *, upper(trim(model_name)) as model_upper from ruled) m) r",
        "by_model": f"""select *, case when hp_low is null or horse_power is null then 1e0 when horse_power between hp_low and hp_high then 1.18e0 else 0.75e0 end as f1,
            hp_low is not null and horse_power is not null as checked, hp_low is not null and horse_power is not null and not horse_power between hp_low and hp_high as hp_mismatch from ranged""",
        "by_cost": f"""select *, case when checked then {cap('hp_conf * f1')} else hp_conf end as hp_conf1, case when checked then {cap('model_conf * f1')} else model_conf end as model_conf1,
            case when horse_power is null or asset_cost is null then null when asset_cost between {per_min} and {per_max} then 1.12e0
              when asset_cost < {per_min} * 0.5e0 or asset_cost > {per_max} * 2 then 0.65e0 else 0.85e0 end as f2 from by_model""",
        "crossed": f"""select document_id, dealer_name, model_name, horse_power, asset_cost, hp_low, hp_high, hp_mismatch, dealer_issues, model_issues, hp_issues, cost_issues, dealer_boosts, model_boosts, hp_boosts, cost_boosts,
            dealer_high, model_high, hp_high_issues, coalesce({cap("dealer_conf * (case when " + shared + " then 1.06e0 else 1e0 end)")}, {cap('dealer_conf')}) as dealer_conf, model_conf1 as model_conf,
            case when f2 is null then hp_conf1 else {cap('hp_conf1 * f2')} end as hp_conf, case when f2 is null then cost_conf else {cap('cost_conf * f2')} end as cost_conf, cost_high from
            (select document_id, dealer_name, model_name, horse_power, asset_cost, hp_low, hp_high, hp_mismatch, dealer_issues, model_issues, hp_issues, cost_issues, dealer_boosts, model_boosts, hp_boosts, cost_boosts,
              dealer_high, model_high, hp_sev as hp_high_issues, dealer_conf, cost_conf, hp_conf1, model_conf1, f2, cost_high from by_cost) c""",
    }


def completeness() -> dict[str, str]:
    """V9: the fields that are missing, and the share of those that are there."""
    return {"complete": "select *, " + " + ".join(f"case when {f} is not null then 1 else 0 end" for f in bank.FIELDS) + " as n_complete from crossed"}


def validated_boxes(source: str = "by_class") -> dict[str, str]:
    """The box rules: a boost for a box, one for a usual area, then the clip."""
    usual = " or ".join(f"(class_name = '{c}' and (x2 - x1) * (y2 - y1) between {low} and {high})" for c, (low, high) in BOX_AREAS.items())
    return {"box_rules": f"select *, {clip(f'confidence * 1.10e0 * (case when {usual} then 1.08e0 else 1e0 end)')} as adjusted, ({usual}) as usual_size from {source}"}
