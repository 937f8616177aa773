"""The few places where Spark SQL and DuckDB spell an expression differently, so that a plan is written once and run in both."""

from __future__ import annotations

import re


class Spark:
    """Renders for Spark SQL; tables are read in place, by path."""

    name = "spark"

    def __init__(self, sf_dir: str = ""):
        self.sf_dir = sf_dir

    def table(self, name: str) -> str:
        return f"parquet.`{self.sf_dir}/{name}.parquet`"

    def text(self, s: str) -> str:
        return "r'" + s.replace("'", "\\x27") + "'" if "\\" in s or "'" in s else f"'{s}'"

    def replace_all(self, x: str, pattern: str, by: str) -> str:
        return f"regexp_replace({x}, {self.text(pattern)}, '{by}')"

    def extract(self, x: str, pattern: str, group: int = 1) -> str:
        return f"nullif(regexp_extract({x}, {self.text(pattern)}, {group}), '')"

    def extract_all(self, x: str, pattern: str, group: int = 1) -> str:
        return f"regexp_extract_all({x}, {self.text(pattern)}, {group})"

    def matches(self, x: str, pattern: str) -> str:
        return f"({x} rlike {self.text(pattern)})"

    def array(self, *items: str) -> str:
        return f"array({', '.join(items)})"

    def concat(self, *arrays: str) -> str:
        return f"concat({', '.join(arrays)})"

    def get(self, array: str, i: str | int) -> str:
        return f"get({array}, {i})"

    def struct(self, **fields: str) -> str:
        return "named_struct(" + ", ".join(f"'{k}', {v}" for k, v in fields.items()) + ")"

    def transform(self, array: str, body, index: bool = False) -> str:
        return f"transform({array}, (x_, i_) -> {body('x_', 'i_')})" if index else f"transform({array}, x_ -> {body('x_')})"

    def keep(self, array: str, body) -> str:
        return f"filter({array}, y_ -> {body('y_')})"

    def explode(self, array: str, item: str, place: str | None = None) -> str:
        return f"lateral view posexplode({array}) as {place or item + '_place'}, {item}"

    def split(self, x: str, pattern: str) -> str:
        return f"split({x}, {self.text(pattern)})"

    def lines(self, x: str) -> str:
        return f"split({x}, '\\n')"

    def join(self, array: str, by: str) -> str:
        return f"array_join({array}, '{by}')"

    def size(self, array: str) -> str:
        return f"cast(size({array}) as bigint)"

    def distinct(self, array: str) -> str:
        return f"array_distinct({array})"

    def sequence(self, a: str, b: str) -> str:
        """a up to b, b included; a <= b."""
        return f"sequence({a}, {b})"

    def first_by(self, value: str, order: str) -> str:
        return f"min_by({value}, {order})"

    def collect(self, x: str) -> str:
        return f"collect_list({x})"

    def count_if(self, condition: str) -> str:
        return f"count_if({condition})"

    def ordered_join(self, value: str, order: str, by: str) -> str:
        return f"array_join(transform(array_sort(collect_list(named_struct('o', {order}, 'v', {value}))), x_ -> x_.v), '{by}')"

    def round6(self, x: str) -> str:
        """Six places as DuckDB rounds a double, by way of x * 1e6, which tells halves apart otherwise than Spark's decimal round."""
        return f"(round(({x}) * 1e6) / 1e6)"

    def finished(self, sql: str) -> str:
        """Every round(x, n) of a plan as round6() has it, by way of x * 10^n: Spark's own goes by the decimal form of a double."""
        out, at = [], 0
        for found in re.finditer(r"(?<![a-z_])round\(", sql):
            depth, end = 1, found.end()
            while depth:
                depth += {"(": 1, ")": -1}.get(sql[end], 0)
                end += 1
            scaled = re.fullmatch(r"(.*), (\d+)", sql[found.end() : end - 1], re.S)
            if found.start() >= at and scaled:
                out += [sql[at : found.start()], f"(round(({self.finished(scaled[1])}) * 1e{scaled[2]}) / 1e{scaled[2]})"]
                at = end
        return "".join([*out, sql[at:]])

    def values(self, columns: str, rows: str) -> str:
        return f"(select * from values {rows} as t({columns}))"

    def json(self, x: str, key: str) -> str:
        return f"get_json_object({x}, '$.{key}')"


class Duck(Spark):
    """Renders for DuckDB; tables are views by name."""

    name = "duck"

    def round6(self, x: str) -> str:
        return f"round({x}, 6)"

    def finished(self, sql: str) -> str:
        return sql

    def table(self, name: str) -> str:
        return name

    def text(self, s: str) -> str:
        return "'" + s.replace("'", "''") + "'"

    def replace_all(self, x: str, pattern: str, by: str) -> str:
        return f"regexp_replace({x}, {self.text(pattern)}, '{by}', 'g')"

    def matches(self, x: str, pattern: str) -> str:
        return f"regexp_matches({x}, {self.text(pattern)})"

    def array(self, *items: str) -> str:
        return f"[{', '.join(items)}]"

    def concat(self, *arrays: str) -> str:
        return f"flatten([{', '.join(arrays)}])"

    def get(self, array: str, i: str | int) -> str:
        return f"({array})[{i} + 1]"

    def struct(self, **fields: str) -> str:
        return "struct_pack(" + ", ".join(f"{k} := {v}" for k, v in fields.items()) + ")"

    def transform(self, array: str, body, index: bool = False) -> str:
        return f"list_transform({array}, lambda x_, i_: {body('x_', '(i_ - 1)')})" if index else f"list_transform({array}, lambda x_: {body('x_')})"

    def keep(self, array: str, body) -> str:
        return f"list_filter({array}, lambda y_: {body('y_')})"

    def explode(self, array: str, item: str, place: str | None = None) -> str:
        return f"cross join lateral (select unnest({array}) as {item}, unnest(range(len({array}))) as {place or item + '_place'})"

    def split(self, x: str, pattern: str) -> str:
        return f"string_split_regex({x}, {self.text(pattern)})"

    def lines(self, x: str) -> str:
        return f"string_split({x}, chr(10))"

    def join(self, array: str, by: str) -> str:
        return f"array_to_string({array}, '{by}')"

    def size(self, array: str) -> str:
        return f"cast(len({array}) as bigint)"

    def distinct(self, array: str) -> str:
        return f"list_distinct({array})"

    def sequence(self, a: str, b: str) -> str:
        return f"range({a}, {b} + 1)"

    def first_by(self, value: str, order: str) -> str:
        return f"arg_min({value}, {order})"

    def collect(self, x: str) -> str:
        return f"list({x})"

    def count_if(self, condition: str) -> str:
        return f"cast(count(*) filter (where {condition}) as bigint)"

    def ordered_join(self, value: str, order: str, by: str) -> str:
        return f"string_agg({value}, '{by}' order by {order})"

    def values(self, columns: str, rows: str) -> str:
        return f"(select * from (values {rows}) as t({columns}))"

    def json(self, x: str, key: str) -> str:
        return f"json_extract_string({x}, '$.{key}')"


def any_of(words, x: str, d: Spark) -> str:
    """Whether the text x contains any of the words: one alternation, so one pass and a small plan."""
    return d.matches(x, "|".join(re.sub(r"([.\\+*?()\[\]{}^$|])", r"\\\1", w) for w in words))


def contains_any(words, x: str, d: Spark) -> str:
    """As any_of(), for Spark without a regular expression: x is read once a word, so it should be a column."""
    return any_of(words, x, d) if d.name == "duck" else f"({' or '.join(f'contains({x}, {d.text(w)})' for w in words)})"


def query(d: Spark, steps: dict[str, str], final: str) -> str:
    """A WITH query of named steps."""
    return d.finished(("with " + ",\n".join(f"{name} as ({sql})" for name, sql in steps.items()) + "\n" if steps else "") + final)
