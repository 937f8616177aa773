"""Embedding near-dedup by sorted projection passes.

Equal vectors of a label are one class first, known by its smallest id. In each pass every class gets a key of 64 random
hyperplane bits; vectors are ordered lexicographically by label and key and each is compared, in double precision, with
the `window` that follow it. Ranges of that order are separate tasks, and what stands at their ends (or in tasks of less than a
window) is compared in a second step, so no window is cut. Tasks hand on a spanning forest of their verified pairs only, and the union over all
passes gives the components. Links are then counted exactly inside each component, in blocks of vectors, so a group
larger than any window keeps all its links.

Vectors are hashed as unit vectors less the mean of their label, so that a common direction doesn't leave the bits one-sided. Passes and window follow
from the data: two trial passes over all rows measure how many bits a vector shares with the one a window further, and its
distance from the mean says how likely a pair at the threshold shares each bit. The window (of 1, 2, 4 or 8 times `window`) with the least cost
is taken, with as many passes, MOST at most, as leave a pair at the threshold missed with probability `miss` in the mean over the vectors whose window isn't full of links.

Cases: null labels, null ids, and vectors that are null, empty, zero or hold null or non-finite components link with
nothing; vectors of different lengths never link; vectors of any length are compared whole; equal rows are vectors of their own with
links between them; ties in the order go by id; an empty table gives no rows; other columns are ignored, whatever their names.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
import pyarrow.compute  # noqa: F401
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import cut, min_label_components

WIDER = (1, 2, 4, 8)  # windows on trial, as multiples
MOST = 512
ROW = ["boundary", "pass", "label", "dim", "key", "a", "vec"]
FIRST, LAST, ALL = range(3)  # which rows of a task are handed on: its first, its last, or all of the few it has


def hyperplanes(dim: int, passes: int, seed: int) -> np.ndarray:
    return np.random.default_rng([seed, dim]).standard_normal((dim, 64 * passes))


def passes_needed(largest: int, threshold: float, window: int, miss: float) -> int:
    share = (1 - math.acos(threshold) / math.pi) ** max(0.0, math.log2(max(largest, 1) / window))
    return 1 if share >= 1 - miss else math.ceil(math.log(miss) / math.log(1 - share))


def matrix(column: pa.Array) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(len(column), -1)


def unit(x: np.ndarray) -> np.ndarray:
    return x / np.sqrt(np.einsum("ij,ij->i", x, x))[:, None]


def forest(n: int, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """The smallest position reachable from each of n positions over the pairs (a, b)."""
    root = np.arange(n)
    while True:
        low = np.minimum(root[a], root[b])
        new = root.copy()
        np.minimum.at(new, a, low)
        np.minimum.at(new, b, low)
        new = np.minimum(new, new[new])
        if np.array_equal(new, root):
            return root
        root = new


def means(classes: DataFrame) -> DataFrame:
    """Rows (label, dim, n, mean): the number of classes and the mean of their unit vectors."""

    def run(parts):
        sums: dict = {}
        for part in parts:
            rows = pa.Table.from_batches([part])
            for dim in np.unique(part.column("dim").to_numpy()) if part.num_rows else ():
                some = rows.filter(pa.compute.equal(rows.column("dim"), int(dim))).combine_chunks()
                x, labels = unit(matrix(some.column("vec").combine_chunks())), some.column("label").to_numpy()
                for label in np.unique(labels):
                    own = x[labels == label]
                    n, total = sums.get((int(label), int(dim)), (0, 0.0))
                    sums[int(label), int(dim)] = n + len(own), total + own.sum(0)
        rows = [{"label": a, "dim": b, "at": k, "n": n, "total": float(t)} for (a, b), (n, total) in sums.items() for k, t in enumerate(total)]
        yield pa.RecordBatch.from_pylist(rows, pa.schema([("label", pa.int64()), ("dim", pa.int32()), ("at", pa.int32()), ("n", pa.int64()), ("total", pa.float64())]))

    parts = classes.select("label", "dim", "vec").mapInArrow(run, "label long, dim int, at int, n long, total double")
    each = parts.groupBy("label", "dim", "at").agg(F.sum("n").alias("n"), F.sum("total").alias("total"))
    mean = F.transform(F.array_sort(F.collect_list(F.struct("at", (F.col("total") / F.col("n")).alias("v")))), lambda x: x["v"])
    return each.groupBy("label", "dim").agg(F.first("n").alias("n"), mean.alias("mean"))


def add_keys(classes: DataFrame, passes: int, seed: int) -> DataFrame:
    """A row for each class (with n and mean of its label) and pass: its key, of 8 bytes in big-endian order; far is its distance from the mean."""

    def run(parts):
        for part in parts:
            for dim in np.unique(part.column("dim").to_numpy()) if part.num_rows else ():
                rows = part.filter(pa.compute.equal(part.column("dim"), int(dim)))
                for at in range(0, rows.num_rows, 2000):
                    some = rows.slice(at, 2000)
                    x = unit(matrix(some.column("vec"))) - matrix(some.column("mean"))
                    far = pa.array(np.sqrt(np.einsum("ij,ij->i", x, x)))
                    bits = x @ hyperplanes(int(dim), passes, seed) > 0
                    packed = np.packbits(bits, axis=1).reshape(some.num_rows, passes, 8)
                    for k in range(passes):
                        keys = [b.tobytes() for b in packed[:, k]]
                        yield pa.RecordBatch.from_arrays([some.column("a"), pa.array(np.full(some.num_rows, k, np.int32)), some.column("label"), some.column("dim"), pa.array(keys, pa.binary()), some.column("vec"), some.column("n"), far], ["a", "pass", "label", "dim", "key", "vec", "n", "far"])

    return classes.select("a", "label", "dim", "vec", "n", "mean").mapInArrow(run, f"a long, pass int, label long, dim int, key binary, vec {dict(classes.dtypes)['vec']}, n long, far double")


def shared_bits(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Leading bits that 64-bit keys have in common."""
    x, out = a ^ b, np.full(len(a), 64)
    for k in range(63, -1, -1):
        out[(x >> np.uint64(63 - k)) != 0] = k
    return out


def meeting(threshold: float, windows: list[int]):
    """Over batches sorted by ROW[1:5]: rows (window, bin, n), how many rows have which probability to meet a partner at the threshold in a pass, as bins of its logarithm."""
    chord = math.sqrt(2 - 2 * threshold)

    def run(parts):
        counts: dict = {}
        tail = None
        for part in parts:
            rows = pa.Table.from_batches([part])
            rows = pa.concat_tables([tail, rows]).combine_chunks() if tail is not None else rows
            if not rows.num_rows:
                continue
            group = np.stack([rows.column(c).to_numpy() for c in ("pass", "label", "dim")], axis=1)
            starts = np.flatnonzero(np.r_[True, (group[1:] != group[:-1]).any(axis=1)])
            for lo, hi in zip(starts, [*starts[1:], rows.num_rows], strict=True):
                some = rows.slice(lo, hi - lo)
                keys = np.frombuffer(b"".join(some.column("key").to_pylist()), ">u8").astype(np.uint64)
                x, far, size = unit(matrix(some.column("vec").combine_chunks())), some.column("far").to_numpy(), int(some.column("n")[0].as_py())
                same_bit = 1 - np.minimum(np.pi / 2, 2 * np.arcsin(np.minimum(1, chord / np.maximum(1e-9, 2 * far)))) / np.pi
                for w in windows:
                    if size <= w + 1:
                        counts[w, 0] = counts.get((w, 0), 0) + (hi - lo)
                    elif hi - lo > w:
                        open_ = np.einsum("ij,ij->i", x[:-w], x[w:]) < threshold
                        bits = shared_bits(keys[:-w], keys[w:])[open_] + 1
                        bins = np.minimum(400, np.floor(-np.log(same_bit[:-w][open_]) * bits * 20)).astype(int)
                        for b, n in zip(*np.unique(bins, return_counts=True), strict=True):
                            counts[w, int(b)] = counts.get((w, int(b)), 0) + int(n)
            tail = rows.slice(max(starts[-1], rows.num_rows - max(windows)))
        yield pa.RecordBatch.from_pylist([{"window": w, "bin": b, "n": n} for (w, b), n in counts.items()], pa.schema([("window", pa.int32()), ("bin", pa.int32()), ("n", pa.int64())]))

    return run


def plan_passes(classes: DataFrame, largest: int, threshold: float, window: int, miss: float, seed: int) -> tuple[int, int]:
    """(passes, window) of the least cost that keep the mean probability to miss a pair within `miss`."""
    windows = [window * k for k in WIDER]
    trial = add_keys(classes, 2, seed + 1).select(*ROW[1:], "n", "far")
    trial = trial.repartitionByRange("pass", "label", "dim", "key", "a").sortWithinPartitions("pass", "label", "dim", "key", "a")
    bins = trial.mapInArrow(meeting(threshold, windows), "window int, bin int, n long").groupBy("window", "bin").agg(F.sum("n").alias("n")).collect()
    choices = []
    for w in windows:
        own = [(math.exp(-(r["bin"] + 0.5) / 20) if r["bin"] else 1.0, r["n"]) for r in bins if r["window"] == w]
        total, passes = sum(n for _, n in own), passes_needed(largest, threshold, w, miss)
        while passes < MOST and sum(n * (1 - q) ** passes for q, n in own) > miss * total:
            passes += 1
        choices.append((passes * (18 + 0.04 * w), passes, w))  # measured: microseconds a row and pass
    return min(choices)[1:]


def window_links(threshold: float, window: int, kind: str, ends: bool):
    """(function, schema) over batches sorted by ROW[:6]: spanning forests of the pairs inside windows, as rows (a, b).

    With `ends` also the first and last `window` rows of the task, or all if it has no more, as rows without b: (task, side) in place of b and boundary.
    """
    vec = pa.list_(pa.float32() if kind == "float" else pa.float64())
    schema = pa.schema([("a", pa.int64()), ("b", pa.int64()), ("task", pa.int64()), ("side", pa.int32()), ("pass", pa.int32()), ("label", pa.int64()), ("dim", pa.int32()), ("key", pa.binary()), ("vec", vec)])

    def forests(rows: pa.Table):
        for a, b in links_of(rows, threshold, window):
            yield pa.record_batch([pa.array(a), pa.array(b), *(pa.nulls(len(a), t) for t in schema.types[2:])], schema=schema)

    def handed(rows: pa.Table, task: int, side: int):
        n = rows.num_rows
        yield from pa.table([rows.column("a"), pa.nulls(n, pa.int64()), pa.array([task] * n, pa.int64()), pa.array([side] * n, pa.int32()), *(rows.column(c) for c in ("pass", "label", "dim", "key", "vec"))], schema=schema).to_batches()

    def run(parts):
        task, tail, first, total = TaskContext.get().partitionId() if ends else 0, None, None, 0
        for part in parts:
            for at in range(0, part.num_rows, 4000):
                new = pa.Table.from_batches([part.slice(at, 4000)])
                total += new.num_rows
                rows = pa.concat_tables([tail, new]).combine_chunks() if tail is not None else new
                yield from forests(rows)
                tail = rows.slice(max(0, rows.num_rows - window))
                if ends and (first is None or first.num_rows < window):
                    first = rows.slice(0, window) if first is None else pa.concat_tables([first, new.slice(0, window - first.num_rows)])
        if ends and total:
            if total <= window:
                yield from handed(tail, task, ALL)
            else:
                yield from handed(first, task, FIRST)
                yield from handed(tail, task, LAST)

    return run, f"a long, b long, task long, side int, pass int, label long, dim int, key binary, vec array<{kind}>"


def links_of(rows: pa.Table, threshold: float, window: int):
    """For each group of rows that share boundary, pass, label and dim: (a, b), every linked row and the first one that it reaches."""
    n = rows.num_rows
    group = np.stack([rows.column(c).to_numpy() for c in ("boundary", "pass", "label", "dim")], axis=1) if n else np.zeros((0, 4))
    starts = np.flatnonzero(np.r_[True, (group[1:] != group[:-1]).any(axis=1)]) if n else []
    for lo, hi in zip(starts, [*starts[1:], n], strict=True):
        if hi - lo < 2:
            continue
        some = rows.slice(lo, hi - lo)
        x, ids = unit(matrix(some.column("vec").combine_chunks())), some.column("a").to_numpy()
        pairs = [np.flatnonzero(np.einsum("ij,ij->i", x[:-d], x[d:]) >= threshold) + np.array([[0], [d]]) for d in range(1, min(window, hi - lo - 1) + 1)]
        a, b = np.concatenate(pairs, axis=1)
        if len(a):
            root = forest(hi - lo, a, b)
            at = np.flatnonzero(root != np.arange(hi - lo))
            yield ids[at], ids[root[at]]


def between_tasks(found: DataFrame) -> DataFrame:
    """The handed rows with the boundary that they meet at: what stands between two tasks of more than a window is one boundary, tasks of fewer rows included."""
    sides = found.filter("b is null").groupBy("task", "side").count().orderBy("task").collect()  # two rows a task at most
    before, meets = 0, []
    for r in sides:
        if r["side"] != LAST:
            meets.append((r["task"], r["side"], before))
        else:
            before += 1
            meets.append((r["task"], LAST, before))
    known = found.sparkSession.createDataFrame(meets, "task long, side int, boundary long")
    return found.filter("b is null").join(F.broadcast(known), ["task", "side"])


def count_links(threshold: float):
    """Over batches sorted by (component, bi, bj): links of each vector with those of the other block (or of its own, when bi = bj)."""

    def counts(rows: pa.Table):
        x, ids, block, m = unit(matrix(rows.column("vec").combine_chunks())), rows.column("a").to_numpy(), rows.column("block").to_numpy(), rows.column("m").to_numpy()
        links = np.zeros(len(x), np.int64)
        if rows.column("bi")[0].as_py() == rows.column("bj")[0].as_py():
            near = x @ x.T >= threshold
            np.fill_diagonal(near, False)
            links += near @ m
        else:
            i, j = np.flatnonzero(block == block[0]), np.flatnonzero(block != block[0])
            near = x[i] @ x[j].T >= threshold
            links[i], links[j] = near @ m[j], m[i] @ near
        return pa.record_batch([pa.array(ids), pa.array(links)], ["a", "links"])

    def run(parts):
        tail = None
        for part in parts:
            rows = pa.Table.from_batches([part])
            rows = pa.concat_tables([tail, rows]).combine_chunks() if tail is not None else rows
            if not rows.num_rows:
                continue
            key = np.stack([rows.column(c).to_numpy() for c in ("component", "bi", "bj")], axis=1)
            starts = np.flatnonzero(np.r_[True, (key[1:] != key[:-1]).any(axis=1)])
            for lo, hi in zip(starts[:-1], starts[1:], strict=True):
                yield counts(rows.slice(lo, hi - lo))
            tail = rows.slice(starts[-1])
        if tail is not None and tail.num_rows:
            yield counts(tail)

    return run


def near_duplicates(
    embeddings: DataFrame, threshold: float = 0.93, window: int = 24, miss: float = 0.003, block: int = 1000, seed: int = 29,
) -> DataFrame:
    """Rows (vec_id, n_links, component_id, kept) for every row of `embeddings(vec_id, embedding, label)`."""
    kind = "float" if dict(embeddings.dtypes)["embedding"] == "array<float>" else "double"  # single precision travels as such; cosines are in double precision
    vec = F.col("embedding").cast(f"array<{kind}>")
    finite = F.forall(vec, lambda x: F.coalesce(F.abs(x) < float("inf"), F.lit(False))) & F.exists(vec, lambda x: x != 0)
    ok = F.coalesce(F.col("vec_id").isNotNull() & F.col("label").isNotNull() & vec.isNotNull() & finite, F.lit(False))
    mark = [F.when(ok, F.xxhash64(F.lit(k), "embedding")).alias(f"f{k}") for k in (0, 1)]
    rows = embeddings.select(F.col("vec_id").cast("long").alias("vec_id"), F.when(ok, F.col("label").cast("long")).alias("label"), *mark, F.when(ok, vec).alias("vec"))
    classes = cut(
        rows.filter("label is not null").groupBy("label", "f0", "f1")
        .agg(F.min("vec_id").alias("a"), F.count("*").alias("m"), F.first("vec").alias("vec")).withColumn("dim", F.size("vec"))
    )
    largest = classes.groupBy("label").agg(F.count("*").alias("n")).agg(F.max("n")).first()[0] or 0
    centred = classes.join(cut(means(classes)), ["label", "dim"])
    passes, window = plan_passes(centred, largest, threshold, window, miss, seed)
    keyed = add_keys(centred, passes, seed).withColumn("boundary", F.lit(0).cast("long")).select(*ROW)
    order = "pass", "label", "dim", "key", "a"
    ordered = keyed.repartitionByRange(*order).sortWithinPartitions(*order)
    found = cut(ordered.mapInArrow(*window_links(threshold, window, kind, True)))
    ends = between_tasks(found).select(*ROW).repartition("boundary").sortWithinPartitions("boundary", *order)
    across = ends.mapInArrow(*window_links(threshold, window, kind, False))
    components = cut(min_label_components(found.filter("b is not null").select("a", "b").union(across.select("a", "b"))))
    sizes = components.groupBy("component").agg(F.count("*").alias("size"))
    blocks = F.ceil(F.col("size") / F.lit(block)).cast("int")
    member = classes.join(components.withColumnRenamed("id", "a"), "a").join(sizes, "component").withColumn("blocks", blocks)
    member = member.withColumn("block", F.pmod(F.xxhash64("a"), F.col("blocks")).cast("int"))
    spread = member.select("component", "a", "m", "vec", "block", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("other"))
    spread = spread.select("component", F.least("block", "other").alias("bi"), F.greatest("block", "other").alias("bj"), "block", "a", "m", "vec")
    counted = spread.repartition("component", "bi", "bj").sortWithinPartitions("component", "bi", "bj").mapInArrow(count_links(threshold), "a long, links long")
    links = counted.groupBy("a").agg(F.sum("links").alias("links"))
    per_class = classes.select("a", "m", F.col("label").alias("l"), F.col("f0").alias("g0"), F.col("f1").alias("g1")).join(links, "a", "left").join(components.withColumnRenamed("id", "a"), "a", "left")
    per_class = per_class.select("l", "g0", "g1", (F.coalesce("links", F.lit(0)) + F.col("m") - 1).alias("n_links"), F.coalesce("component", "a").alias("component"))
    out = rows.select("vec_id", "label", "f0", "f1").join(per_class, (F.col("label") == F.col("l")) & (F.col("f0") == F.col("g0")) & (F.col("f1") == F.col("g1")), "left")
    component = F.coalesce("component", "vec_id")
    return out.select("vec_id", F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"), component.alias("component_id"), F.coalesce(F.col("vec_id") == component, F.lit(True)).alias("kept"))


SQL = """
with v as (select vec_id, label, embedding::double[] as e from embeddings
  where vec_id is not null and label is not null and embedding is not null and len(embedding) = len(list_filter(embedding, lambda x: isfinite(x)))
    and len(list_filter(embedding, lambda x: x <> 0)) > 0),
links as (select a.vec_id as a, b.vec_id as b from v a join v b on a.label = b.label and a.vec_id <> b.vec_id and len(a.e) = len(b.e) and list_cosine_similarity(a.e, b.e) >= 0.93),
reach as (with recursive r(id, c) as (select vec_id, vec_id from v union select l.b, r.c from r join links l on l.a = r.id) select id, min(c) as c from r group by id),
n as (select a, count(*) as n from links group by a)
select vec_id, coalesce(n, 0)::bigint as n_links, coalesce(c, vec_id) as component_id, coalesce(c, vec_id) is not distinct from vec_id as kept
from embeddings left join n on a = vec_id left join reach on id = vec_id"""
