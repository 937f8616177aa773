"""Mixing sources to target weights by a multivariate-hypergeometric splitting tree, in DataFrame operations only.

Sizes are words. The words of a source, its documents in an order dealt by a keyed hash, form one stream that is cut
into blocks of equal length. A target of t words over a source of s words takes floor(t/s) whole passes over its blocks and a quota
of blocks (the last one shortened) in one more, partial pass. The tree starts from the number of blocks that all passes of each source
take and halves the output shards level by level: the left half's share of each source is a multivariate hypergeometric draw, one
hypergeometric draw after another over the sources, each by inversion from its mode. Leaves hold the exact block quota of each source
in each shard. In every pass block numbers go through a keyed affine permutation of the source's blocks, and each leaf draws the next
run of permuted numbers, pass after pass: what no leaf draws isn't in the mix. So the shards' draws are disjoint and together as many
as the quota. Within a shard, blocks are ordered by a keyed hash.

Positions in the streams are prefix sums over (source, bucket) cells of a few thousand documents each, so a source with a third
of all rows is as many tasks. Only what is one row a source is ever held together: the tree is one array of sources, so their number
must fit in a row (some hundred thousand).

Cases: null sources are one source, ordered last; null and empty texts have size 0 and are never taken; texts of any length are cut at
blocks; a source without words has target 0; null ids are documents like any; repeated rows are documents of their own; an empty table
gives an empty mix; other columns are ignored, whatever their names.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import cut

WORD = r"[^\x20\x09-\x0D]+"
PRIME = 2305843009213693951  # 2^61 - 1: larger than any number of blocks, so never a divisor of one


def word_count(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def source_targets(sizes: DataFrame, weights: tuple[float, ...], share: float, most: float) -> DataFrame:
    """A row for each source: its words, and its target: `share` of all words by weight, `most` times its words at most.

    The excess of sources at their limit is shared again by weight until none is above: with sources in order of
    limit by weight, the level at which the first is not above holds for it and all after it.
    """
    by = Window.orderBy(F.col("source").isNull(), F.col("source").cast("binary"))
    weight = F.element_at(F.array(*map(F.lit, weights)), ((F.row_number().over(by) - 1) % len(weights) + 1).cast("int"))
    per = sizes.groupBy("source").agg(F.sum("size").alias("source_size"), F.count("*").alias("n_docs"))
    per = per.withColumn("weight", weight).withColumn("most", F.col("source_size") * F.lit(float(most)))
    rank = Window.orderBy((F.col("most") / F.col("weight")), F.col("source").isNull(), "source")
    done = rank.rowsBetween(Window.unboundedPreceding, -1)
    everything = Window.partitionBy(F.lit(1))
    budget = F.sum("source_size").over(everything) * F.lit(float(share))
    level = (budget - F.coalesce(F.sum("most").over(done), F.lit(0.0))) / (F.sum("weight").over(everything) - F.coalesce(F.sum("weight").over(done), F.lit(0.0)))
    per = per.withColumn("level", level).withColumn("budget", budget)
    final = F.coalesce(F.min(F.when(F.col("level") * F.col("weight") <= F.col("most"), F.struct((F.col("most") / F.col("weight")).alias("at"), F.col("level").alias("level")))).over(everything)["level"], F.lit(float("inf")))
    return per.withColumn("target", F.least("most", final * F.col("weight"))).select("source", "source_size", "n_docs", "target")


def _next_ratio(k: Column, good: Column, bad: Column, draws: Column) -> Column:
    """P(k + 1) / P(k) of a hypergeometric count."""
    return (good - k) * (draws - k) / ((k + 1.0) * (bad - draws + k + 1.0))


def _log_factorial(x: Column) -> Column:
    """Stirling's series, exact to rounding from 10 on; below, a table."""
    small = F.element_at(F.array(*(F.lit(v) for v in (0.0, 0.0, 0.6931471805599453, 1.791759469228055, 3.1780538303479458, 4.787491742782046, 6.579251212010101, 8.525161361065415, 10.60460290274525, 12.801827480081469))), (F.least(x, F.lit(9.0)) + 1).cast("int"))
    y = F.greatest(x, F.lit(10.0))
    return F.when(x < 10, small).otherwise(y * F.ln(y) - y + 0.5 * F.ln(y * 6.283185307179586) + 1 / (12 * y) - 1 / (360 * y * y * y) + 1 / (1260 * y * y * y * y * y))


def let(value: Column, body) -> Column:
    """body(value) with value computed once."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def hypergeometric(u: Column, good: Column, bad: Column, draws: Column) -> Column:
    """The number of good items in `draws` of good + bad, for a uniform u: inversion that walks outward from the mode.

    All arguments are doubles with whole values. The walk covers 12 standard deviations on either side and ends within
    the exact support, so quotas always stay exact.
    """
    total = good + bad
    low, high = F.greatest(F.lit(0.0), draws - bad), F.least(good, draws)
    mode = F.least(high, F.greatest(low, F.floor((draws + 1) * (good + 1) / (total + 2)).cast("double")))
    spread = F.sqrt(draws * good * bad * (total - draws) / F.greatest(total * total * (total - 1), F.lit(1.0)))
    steps = F.greatest(F.lit(1), F.least(high - low, F.ceil(12 * spread) + 12).cast("int"))
    return let(F.struct(u.alias("u"), good.alias("good"), bad.alias("bad"), draws.alias("draws"), low.alias("low"), high.alias("high"), mode.alias("mode"), steps.alias("steps")), _walk_from_mode)


def _walk_from_mode(x: Column) -> Column:
    good, bad, draws, low, high, mode, u = (x[name] for name in ("good", "bad", "draws", "low", "high", "mode", "u"))
    plus = (good, bad, draws, good + bad - draws)
    minus = (mode, good - mode, draws - mode, bad - draws + mode, good + bad)
    terms = F.array(*(F.struct(F.lit(1.0).alias("sign"), v.alias("v")) for v in plus), *(F.struct(F.lit(-1.0).alias("sign"), v.alias("v")) for v in minus))
    p = F.exp(F.aggregate(terms, F.lit(0.0), lambda s, t: s + t["sign"] * _log_factorial(t["v"])))
    start = let(p, lambda p: F.struct((u - p).alias("u"), F.when(u <= p, mode).alias("k"), mode.alias("hi"), p.alias("ph"), mode.alias("lo"), p.alias("pl")))

    def walk(state: Column, _: Column) -> Column:
        up = F.when(state["hi"] < high, state["ph"] * _next_ratio(state["hi"], good, bad, draws)).otherwise(0.0)
        down = F.when(state["lo"] > low, state["pl"] / _next_ratio(state["lo"] - 1, good, bad, draws)).otherwise(0.0)

        def moved(d: Column) -> Column:
            hi, lo = F.least(high, state["hi"] + 1), F.greatest(low, state["lo"] - 1)
            k = F.when(state["k"].isNotNull(), state["k"]).when(state["u"] <= d["up"], hi).when(state["u"] <= d["up"] + d["down"], lo)
            return F.struct((state["u"] - d["up"] - d["down"]).alias("u"), k.alias("k"), hi.alias("hi"), d["up"].alias("ph"), lo.alias("lo"), d["down"].alias("pl"))

        return let(F.struct(up.alias("up"), down.alias("down")), moved)

    return F.coalesce(F.aggregate(F.sequence(F.lit(1), x["steps"]), start, walk)["k"], mode)


def _uniform(*parts: Column) -> Column:
    """A uniform in (0, 1) that depends on its arguments only."""
    return (F.pmod(F.xxhash64(*parts), F.lit(1 << 52)).cast("double") + 0.5) / float(1 << 52)


def _draw_left(seed: int, level: int):
    """The fold over a node's sources that draws the left half's share of each, given what is left to draw."""

    def draw(state: Column, x: Column) -> Column:
        u = _uniform(F.lit(seed), F.lit(level), F.col("shard"), x["source"], x["last"])
        k = hypergeometric(u, x["quota"], state["rest"] - x["quota"], state["draws"])
        return F.struct((state["rest"] - x["quota"]).alias("rest"), (state["draws"] - k).alias("draws"), F.array_append(state["out"], k).alias("out"))

    return draw


def splitting_tree(quotas: DataFrame, levels: int, seed: int) -> DataFrame:
    """Rows (source, ends): for each source the running block quotas of 2^levels shards, from rows (source, quota).

    One row holds the quotas of all sources; each level splits every node in two.
    """
    node = quotas.agg(F.array_sort(F.collect_list(F.struct(F.col("source").isNull().alias("last"), "source", F.col("quota").cast("double").alias("quota")))).alias("q")).select(F.lit(0).alias("shard"), "q")
    for level in range(levels):
        total = F.aggregate("q", F.lit(0.0), lambda s, x: s + x["quota"])
        odd = F.when(_uniform(F.lit(seed), F.lit(level), "shard") < 0.5, F.col("total") % 2).otherwise(0.0)
        node = node.withColumn("total", total).withColumn("half", F.floor(F.col("total") / 2).cast("double") + odd)
        begin = F.struct(F.col("total").alias("rest"), F.col("half").alias("draws"), F.array().cast("array<double>").alias("out"))
        draw = _draw_left(seed, level)
        node = node.withColumn("left", F.aggregate("q", begin, draw)["out"])
        side = lambda take: F.transform("q", lambda x, i: F.struct(x["last"].alias("last"), x["source"].alias("source"), take(x["quota"], F.get("left", i)).alias("quota")))
        node = node.select("shard", F.explode(F.array(F.struct(F.lit(0).alias("bit"), side(lambda q, k: k).alias("q")), F.struct(F.lit(1).alias("bit"), side(lambda q, k: q - k).alias("q")))).alias("c"))
        node = node.select((F.col("shard") * 2 + F.col("c.bit")).alias("shard"), F.col("c.q").alias("q"))
    leaves = node.select("shard", F.explode("q").alias("x")).select("shard", F.col("x.source").alias("source"), F.col("x.quota").cast("long").alias("n"))
    per = leaves.groupBy("source").agg(F.array_sort(F.collect_list(F.struct("shard", "n"))).alias("n"))
    ends = F.aggregate("n", F.array().cast("array<long>"), lambda s, x: F.array_append(s, F.coalesce(F.try_element_at(s, F.lit(-1)), F.lit(0)) + x["n"]))
    return per.select("source", F.when(F.size("n") > 0, ends).alias("ends"))


def mix_sources(
    docs: DataFrame, weights: tuple[float, ...] = (3.0, 1.0, 2.0), share: float = 1.5, most: float = 2.0,
    block_words: int = 256, levels: int = 5, bucket_docs: int = 4096, seed: int = 17,
) -> DataFrame:
    """The mix of `docs(doc_id, text, source)` into 2^levels output shards.

    A row for each row of docs: doc_id, mark (a digest of source and text), size, source, source_size, target, taken, and draws: an
    array of (shard, pass, block, key, first_word, n_words) for what each leaf of the tree draws of the document: block is the block of
    the source's stream, key its place in the shard's local shuffle. `taken` adds the words of the draws. Reruns with the same arguments
    give the same mix.
    """
    sized = cut(docs.select("doc_id", "source", word_count(F.col("text")).alias("size"), F.xxhash64("source", "text").alias("mark")))
    sized = sized.withColumn("h", F.xxhash64(F.lit(seed), "doc_id", "mark"))
    per = source_targets(sized, weights, share, most)
    size, target = F.col("source_size"), F.col("target")
    passes = F.when(size > 0, F.floor(target / size)).otherwise(0).cast("long")
    words = F.round(target - passes * size).cast("long")
    per = per.withColumn("passes", passes).withColumn("words", words).withColumn("blocks", F.ceil(size / F.lit(block_words)).cast("long"))
    per = per.withColumn("quota", F.least("blocks", F.ceil(F.col("words") / F.lit(block_words)).cast("long"))).withColumn("buckets", F.ceil(F.col("n_docs") / F.lit(bucket_docs)).cast("long"))
    per = cut(per)
    ends = splitting_tree(per.select("source", (F.col("passes") * F.col("blocks") + F.col("quota")).alias("quota")), levels, seed)
    per = cut(per.join(ends.withColumnRenamed("source", "s"), F.col("source").eqNullSafe(F.col("s")), "left").drop("s"))
    of_source = lambda left: left.join(F.broadcast(per) if per.count() <= 100_000 else per, left["s"].eqNullSafe(per["source"]))
    dealt = of_source(sized.withColumnRenamed("source", "s")).withColumn("bucket", F.pmod(F.col("h"), F.col("buckets"))).select("doc_id", "mark", "s", "size", "h", "bucket")
    dealt = cut(dealt)
    cells = dealt.groupBy("s", "bucket").agg(F.sum("size").alias("cell"))
    # A cell is thousands of documents; of its running sums, those of a source stay one task.
    before = Window.partitionBy("s").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    cells = cells.select(F.col("s").alias("cs"), F.col("bucket").alias("cb"), F.coalesce(F.sum("cell").over(before), F.lit(0)).alias("offset"))
    inside = Window.partitionBy("s", "bucket").orderBy("h", "doc_id", "size").rowsBetween(Window.unboundedPreceding, -1)
    placed = dealt.withColumn("within", F.coalesce(F.sum("size").over(inside), F.lit(0)))
    placed = placed.join(cells, placed["s"].eqNullSafe(cells["cs"]) & (placed["bucket"] == cells["cb"])).withColumn("start", F.col("offset") + F.col("within"))
    full = of_source(placed)
    n = F.col("blocks").cast("decimal(19,0)")
    shift = F.pmod(F.xxhash64(F.lit(seed + 1), "s"), F.greatest(F.col("blocks"), F.lit(1)))
    b, end = F.lit(block_words), F.col("start") + F.col("size")

    def draw(turn: Column, block: Column) -> Column:
        rank = ((block.cast("decimal(19,0)") * (F.lit(PRIME).cast("decimal(19,0)") % n) + shift + turn * 7919) % n).cast("long")
        # The last block of the partial pass stops at the words still wanted.
        length = F.when((turn == F.col("passes")) & (rank == F.col("quota") - 1), F.col("words") - rank * b).otherwise(b)
        first, last = F.greatest(block * b, F.col("start")), F.least(block * b + length, end)
        return F.struct(
            _leaf("ends", turn * F.col("blocks") + rank).alias("shard"), turn.alias("pass"), block.alias("block"), F.xxhash64(F.lit(seed + 2), turn, block, F.col("s")).alias("key"),
            (first - F.col("start")).alias("first_word"), (last - first).alias("n_words"),
        )

    blocks = F.sequence(F.floor(F.col("start") / b), F.floor((end - 1) / b))
    drawn = F.flatten(F.transform(F.sequence(F.lit(0).cast("long"), F.col("passes")), lambda turn: F.transform(blocks, lambda block: draw(turn, block))))
    drawn = F.filter(drawn, lambda d: d["shard"].isNotNull() & (d["n_words"] > 0))
    none = F.expr("cast(array() as array<struct<shard:int,pass:bigint,block:bigint,key:bigint,first_word:bigint,n_words:bigint>>)")
    full = full.withColumn("draws", F.when(F.col("size") > 0, drawn).otherwise(none))
    taken = F.aggregate("draws", F.lit(0).cast("long"), lambda s, d: s + d["n_words"])
    return full.select("doc_id", "mark", "size", "source", "source_size", "target", taken.alias("taken"), "draws")


def _leaf(ends: str, number: Column) -> Column:
    """The shard whose run of draws holds a number; null beyond the last."""
    return F.when(number < F.coalesce(F.try_element_at(F.col(ends), F.lit(-1)), F.lit(0)), F.size(F.filter(ends, lambda e: e <= number)))


def shards(mix: DataFrame) -> DataFrame:
    """The mix as rows (shard, key, doc_id, source, pass, first_word, n_words), each shard shuffled locally by key."""
    part = mix.select("doc_id", "source", F.explode("draws").alias("d")).select("d.shard", "d.key", "doc_id", "source", "d.pass", "d.first_word", "d.n_words")
    return part.repartition("shard").sortWithinPartitions("shard", "key", "doc_id")
