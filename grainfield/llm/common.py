"""Small helpers that the operators share: tables, lineage cuts, bounded memories and components."""

from __future__ import annotations

import gc
import re
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

import pyarrow as pa
import pyarrow.compute  # noqa: F401
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """The named input table, through Spark's own reader only."""
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def shared_dir(spark: SparkSession) -> str:
    """The folder that driver and executors share (spark.checkpoint.dir). Where it is unset, as in tests, a local master gets one of its own; a cluster is refused."""
    found = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not found:
        if not re.fullmatch(r"local(\[[^\]]*\])?", spark.sparkContext.master):
            raise ValueError("spark.checkpoint.dir must name a folder that the driver and all executors share")
        import tempfile

        found = "file://" + tempfile.mkdtemp(prefix="grainfield-shared-")
        spark.sparkContext.setCheckpointDir(found)
    return found.rstrip("/")


def cut(df: DataFrame) -> DataFrame:
    """Cut the lineage: write the rows as Parquet in the shared folder, which outlives any executor, and read them back.

    The files go when the application ends.
    """
    spark = df.sparkSession
    path = fresh_dir(spark, "cut")
    df.write.option("compression", "zstd").parquet(path)
    discard_at_exit(spark, path)
    return spark.read.schema(df.schema).parquet(path)


def discard(spark: SparkSession, path: str) -> None:
    hadoop = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    hadoop.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(hadoop, True)


def discard_at_exit(spark: SparkSession, path: str) -> None:
    hadoop = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    hadoop.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).deleteOnExit(hadoop)


def fresh_dir(spark: SparkSession, what: str) -> str:
    """A new path below the shared folder."""
    return f"{shared_dir(spark)}/{what}-{spark.sparkContext.applicationId}-{uuid.uuid4().hex[:12]}"


@contextmanager
def no_cycles() -> Iterator[None]:
    """Pauses the search for reference cycles in code that makes none: it would walk all remembered entries again and again."""
    gc.disable()
    try:
        yield
    finally:
        gc.enable()


def slices(texts: pa.Array, size: int) -> Iterator[tuple[int, int]]:
    """Ranges of consecutive texts with about `size` bytes, one text at least, so that a batch is never unpacked as a whole."""
    import numpy as np

    step = np.cumsum(pa.compute.binary_length(texts).fill_null(0).to_numpy(zero_copy_only=False).astype(np.int64)) // size
    starts = np.flatnonzero(np.r_[True, step[1:] != step[:-1]]) if len(step) else []
    yield from zip(starts, [*starts[1:], len(texts)], strict=True)


class Memo(dict):
    """A dict that computes missing entries and forgets everything beyond `limit`, so worker memory stays bounded."""

    def __init__(self, compute, limit: int):
        super().__init__()
        self.compute, self.limit = compute, limit

    def __missing__(self, key):
        if len(self) >= self.limit:
            self.clear()
        value = self[key] = self.compute(key)
        return value


def mix64(x):
    """The splitmix64 finaliser over a numpy uint64 array."""
    import numpy as np

    with np.errstate(over="ignore"):
        x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
        x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
        return x ^ (x >> np.uint64(31))


def min_label_components(edges: DataFrame, max_rounds: int = 60, edges_a_task: int = 100_000) -> DataFrame:
    """Connected components of `edges(a, b)` as rows (id, component), component the smallest id reachable.

    Alternating large-star and small-star rounds; every round is a join and map-side combined minima, so a hub with
    very many links costs rows, never a gathered neighbour list. Rounds end once the edge set stops changing and each
    is written out, so a lost executor repeats one round at most. The number of tasks follows the number of edges, so a
    small graph doesn't pay for many empty tasks. Only ids of linked nodes come back. Null ends and loops are left out; without edges
    the result is empty.
    """

    def star(e: DataFrame, large: bool, tasks: int) -> DataFrame:
        both = e.select("a", "b").union(e.select(F.col("b").alias("a"), F.col("a").alias("b")))
        low = both.groupBy("a").agg(F.least(F.min("b"), F.first("a")).alias("m"))
        if large:  # neighbours above the node hang on its minimum
            out = both.filter("b > a").join(low, "a").select(F.col("b").alias("a"), F.col("m").alias("b"))
        else:  # neighbours below the node, and the node, hang on the minimum
            below = both.filter("b < a").join(low, "a")
            out = below.select(F.explode(F.array(F.struct(F.col("b").alias("a"), F.col("m").alias("b")), F.struct("a", F.col("m").alias("b")))).alias("e")).select("e.a", "e.b")
        return out.filter("a <> b").coalesce(tasks).distinct().coalesce(tasks)

    def mark(e: DataFrame) -> tuple:
        row = e.agg(F.count("*").alias("n"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)")).alias("h")).first()
        return row["n"], row["h"]

    e = cut(
        edges.filter("a is not null and b is not null and a <> b")
        .select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
        .distinct()
    )
    seen = mark(e)
    for _ in range(max_rounds):
        if not seen[0]:
            break
        tasks = 1 + seen[0] // edges_a_task
        e = cut(star(star(e.coalesce(tasks), True, tasks), False, tasks))
        now = mark(e)
        if now == seen:
            break
        seen = now
    else:
        raise RuntimeError(f"components did not settle in {max_rounds} rounds")
    return e.groupBy("a").agg(F.min("b").alias("component")).withColumnRenamed("a", "id").union(
        e.select(F.col("b").alias("id"), F.col("b").alias("component")).distinct()
    )
