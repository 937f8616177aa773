"""Quality rules with risk-controlled thresholds, in DataFrame operations only.

Counts per document give a base verdict and four rates, higher being worse. For each stratum (language) and rate the
cutoffs of a fixed grid are tested from the loosest to the strictest on labelled holdouts. A stratum may lose `risk` of its good
documents to all rates together, so each rate has an equal part of that: the hypothesis that a cutoff rejects more than
risk / (number of rates) of the good documents falls if the exact binomial probability of as few false rejections as seen
is at most `error` / (number of strata and rates). The sequence ends at the first cutoff that isn't certified (fixed
sequence testing needs no further correction inside it), and the strictest certified cutoff holds. So with confidence
1 - error the rates together reject at most `risk` of good documents in every stratum. Without enough labels nothing is certified
and nothing beyond the base rule is rejected. Strata are a parameter, so that their number, and with it the correction, doesn't
depend on the data.

Cases: null and empty texts have no words and fail the base rule; texts of any length are counted whole; null languages and ones
outside `strata` are pooled; labels that repeat count once (the lower quality holds), null ones never, and null ids have none; equal and
repeated rows get equal verdicts; an empty table gives no rows; other columns are ignored, whatever their names.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import cut
from .mixing import WORD, _log_factorial, let

WINDOW = 8
STRATA = ("de", "en", "es", "fr")
RATES = {"symbols": "n_symbols / n_words", "capitals": "n_capitals / word_chars", "dup_lines": "n_dup_lines / n_lines", "repeats": "n_repeat_words / n_words"}
GRID = (0.9, 0.8, 0.7, 0.6, 0.5, 0.45, 0.4, 0.35, 0.3, 0.25, 0.2, 0.15, 0.1, 0.07, 0.05)  # loosest first


def repeat_words(words: Column) -> Column:
    """Words inside windows of WINDOW words that occur twice or more in the text, the first occurrence included."""

    def covered(starts: Column) -> Column:
        return F.aggregate(F.transform(starts, lambda p, j: F.least(F.lit(WINDOW), F.coalesce(F.get(starts, j + 1) - p, F.lit(WINDOW)))), F.lit(0), lambda s, x: s + x)

    def repeated(windows: Column) -> Column:
        ordered = F.array_sort(F.transform(windows, lambda h, i: F.struct(h.alias("h"), i.alias("i"))))
        twins = lambda o: F.filter(o, lambda x, j: F.coalesce(x["h"] == F.get(o, j - 1)["h"], F.lit(False)) | F.coalesce(x["h"] == F.get(o, j + 1)["h"], F.lit(False)))
        starts = let(ordered, lambda o: F.array_sort(F.transform(twins(o), lambda x: x["i"])))
        return F.when(F.size(F.array_distinct(windows)) < F.size(windows), let(starts, covered)).otherwise(0)

    def windows(digests: Column) -> Column:
        return F.transform(F.sequence(F.lit(0), F.size(digests) - WINDOW), lambda i: F.xxhash64(*(F.get(digests, i + k) for k in range(WINDOW))))

    found = let(F.transform(words, lambda w: F.xxhash64(w)), lambda d: let(windows(d), repeated))
    return F.when(F.size(words) > WINDOW, found).otherwise(0).cast("long")


def text_counts(docs: DataFrame, strata: tuple[str, ...] = STRATA) -> DataFrame:
    """Counts of each row of `docs(doc_id, text, lang)`."""
    text = F.coalesce(F.col("text"), F.lit(""))
    words = F.regexp_extract_all(text, F.lit(WORD), F.lit(0))
    lines = F.filter(F.split(text, "\n"), lambda x: x.rlike(WORD))
    per_words = let(words, lambda w: F.struct(F.size(w).cast("long").alias("n_words"), repeat_words(w).alias("n_repeat_words")))
    per_lines = let(lines, lambda x: F.struct(F.size(x).cast("long").alias("n_lines"), (F.size(x) - F.size(F.array_distinct(x))).cast("long").alias("n_dup_lines")))
    return (
        docs.select(
            "doc_id",
            F.when(F.col("lang").isin(*strata), F.col("lang")).otherwise("other").alias("stratum"),
            F.length(F.translate(text, " \t\n\x0b\x0c\r", "")).cast("long").alias("word_chars"),
            (F.length(text) - F.length(F.translate(text, "#*$%&|<>", ""))).cast("long").alias("n_symbols"),
            (F.length(text) - F.length(F.translate(text, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", ""))).cast("long").alias("n_capitals"),
            per_words.alias("w"),
            per_lines.alias("l"),
        )
        .select("doc_id", "stratum", "word_chars", "n_symbols", "n_capitals", "w.*", "l.*")
        .withColumn("base_failed", (F.col("n_words") < 20) | (100 * F.col("n_repeat_words") > 30 * F.col("n_words")))
    )


def binomial_tail(k: Column, n: Column, p: float) -> Column:
    """P(X <= k) for X binomial (n, p), exact up to rounding for k <= n p; 1 beyond, where nothing can be certified.

    Terms are summed downward from k; those more than 40 deviations below vanish in a double.
    """
    k, n = k.cast("double"), n.cast("double")
    top = F.exp(_log_factorial(n) - _log_factorial(k) - _log_factorial(n - k) + k * F.log(F.lit(p)) + (n - k) * F.log(F.lit(1 - p)))
    steps = F.least(k, F.ceil(40 * F.sqrt(n * p)) + 200).cast("int")
    zero = F.struct(F.lit(1.0).alias("t"), F.lit(1.0).alias("s"), k.alias("i"))

    def down(a: Column, _: Column) -> Column:
        t = a["t"] * a["i"] * (1 - p) / ((n - a["i"] + 1) * p)
        return F.struct(t.alias("t"), (a["s"] + t).alias("s"), (a["i"] - 1).alias("i"))

    total = F.aggregate(F.sequence(F.lit(1), F.greatest(steps, F.lit(1))), zero, down)["s"]
    return F.when(k > n * p, 1.0).otherwise(F.least(F.lit(1.0), top * total))


def risk_controlled_cutoffs(counts: DataFrame, labels: DataFrame, risk: float = 0.04, error: float = 0.05, strata: tuple[str, ...] = STRATA) -> DataFrame:
    """Rows (stratum, rate, cutoff): the strictest certified cutoffs, (strata + 1) x rates rows at most."""
    good = labels.filter("doc_id is not null and quality is not null").groupBy("doc_id").agg(F.min("quality").alias("q")).filter("q = 1").select("doc_id")
    held = counts.filter("not base_failed").join(good, "doc_id")
    grid = F.array(*map(F.lit, GRID))
    rates = F.explode(F.array(*(F.struct(F.lit(name).alias("rate"), F.expr(e).alias("x")) for name, e in RATES.items())))
    seen = held.select("stratum", rates.alias("b")).select("stratum", "b.rate", F.size(F.filter(grid, lambda c: c >= F.col("b.x"))).alias("passed"))
    per = seen.groupBy("stratum", "rate", "passed").agg(F.count("*").alias("n"))
    tests = (
        per.groupBy("stratum", "rate")
        .agg(F.sum("n").alias("n"), F.collect_list(F.struct("passed", F.col("n").alias("m"))).alias("bins"))
        .select("stratum", "rate", "n", "bins", F.posexplode(grid).alias("at", "cutoff"))
        .withColumn("k", F.aggregate("bins", F.lit(0).cast("long"), lambda s, b: s + F.when(b["passed"] <= F.col("at"), b["m"]).otherwise(0)))
        .withColumn("certified", binomial_tail(F.col("k"), F.col("n"), risk / len(RATES)) <= error / ((len(strata) + 1) * len(RATES)))
    )
    so_far = Window.partitionBy("stratum", "rate").orderBy("at")
    return tests.withColumn("open", F.min(F.col("certified").cast("int")).over(so_far)).filter("open = 1").groupBy("stratum", "rate").agg(F.min("cutoff").alias("cutoff"))


def apply_rules(docs: DataFrame, labels: DataFrame, risk: float = 0.04, error: float = 0.05, strata: tuple[str, ...] = STRATA) -> DataFrame:
    """The counts of text_counts() with base_failed, kept, and the name of the first rate above its cutoff (rejected_by)."""
    counts = cut(text_counts(docs, strata))
    cutoffs = risk_controlled_cutoffs(counts, labels, risk, error, strata)
    wide = cutoffs.groupBy("stratum").pivot("rate", list(RATES)).agg(F.first("cutoff"))
    wide = wide.select("stratum", *(F.col(name).alias(f"cut_{name}") for name in RATES))
    above = F.coalesce(*(F.when(~F.col("base_failed") & (F.expr(e) > F.col(f"cut_{name}")), F.lit(name)) for name, e in RATES.items()))
    # As many rows as strata: bounded by a constant.
    judged = counts.join(F.broadcast(wide), "stratum", "left").withColumn("rejected_by", above)
    return judged.withColumn("kept", ~F.col("base_failed") & F.col("rejected_by").isNull()).drop(*(f"cut_{name}" for name in RATES))


def rules_sql(risk: float = 0.04, error: float = 0.05) -> str:
    """DuckDB SQL for apply_rules() over the views documents and labels."""
    each = risk / len(RATES)
    rates = ", ".join(f"struct_pack(rate := '{name}', x := {e})" for name, e in RATES.items())
    above = " or ".join(f"coalesce({e} > (select min(cutoff) from cutoffs c where c.stratum = k.stratum and c.rate = '{name}'), false)" for name, e in RATES.items())
    return f"""
with docs as (select row_number() over () as r, doc_id, coalesce(text, '') as text, case when lang in {STRATA} then lang else 'other' end as stratum from documents),
words as (select r, regexp_extract_all(text, '[^\\x20\\x09-\\x0D]+') as w from docs),
win as (select r, i, array_to_string(list_slice(w, i, i + {WINDOW - 1}), ' ') as s from (select r, w, unnest(range(1, greatest(len(w) - {WINDOW - 2}, 1))) as i from words)),
twice as (select r, i, i - lag(i) over (partition by r order by i) as gap from (select *, count(*) over (partition by r, s) as n from win) where n > 1),
rep as (select r, sum(least({WINDOW}, coalesce(gap, {WINDOW}))) as n from twice group by r),
ln as (select r, count(*) as n_lines, count(*) - count(distinct line) as n_dup_lines from (select r, unnest(string_split(text, chr(10))) as line from docs) where regexp_matches(line, '[^\\x20\\x09-\\x0D]') group by r),
counts as (
  select d.r, d.doc_id, d.stratum, len(w)::bigint as n_words, length(regexp_replace(text, '[\\x20\\x09-\\x0D]', '', 'g'))::bigint as word_chars,
    length(regexp_replace(text, '[^#*$%&|<>]', '', 'g'))::bigint as n_symbols, length(regexp_replace(text, '[^A-Z]', '', 'g'))::bigint as n_capitals,
    coalesce(n_lines, 0)::bigint as n_lines, coalesce(n_dup_lines, 0)::bigint as n_dup_lines, coalesce(rep.n, 0)::bigint as n_repeat_words
  from docs d join words using (r) left join rep using (r) left join ln using (r)),
k as (select *, n_words < 20 or 100 * n_repeat_words > 30 * n_words as base_failed from counts),
good as (select doc_id from labels where doc_id is not null and quality is not null group by doc_id having min(quality) = 1),
held as (select stratum, unnest([{rates}]) as b from k join good using (doc_id) where not base_failed),
grid as (select unnest({list(GRID)})::double as cutoff, unnest(range(0, {len(GRID)})) as step),
tests as (select stratum, b.rate as rate, cutoff, step, count(*) as n, count(*) filter (where b.x > cutoff) as f from held, grid group by all),
tails as (select stratum, rate, cutoff, step, f > n * {each} as over_risk,
    (select sum(exp(lgamma(n + 1.0) - lgamma(i + 1.0) - lgamma(n - i + 1.0) + i * ln({each}::double) + (n - i) * ln(1 - {each}::double))) from (select unnest(range(0, f + 1)) as i)) as p from tests),
cutoffs as (select stratum, rate, min(cutoff) as cutoff from (select *, bool_and(not over_risk and p <= {error} / {(len(STRATA) + 1) * len(RATES)}) over (partition by stratum, rate order by step) as certified from tails) where certified group by all)
select doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed, not base_failed and not ({above}) as kept from k"""
