"""Bounded samples of labelled rows for the classifiers."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def fold(doc_id: Column, n: int) -> Column:
    """crc32 of the id as text, modulo n; null for null ids."""
    return F.pmod(F.crc32(doc_id.cast("string").cast("binary")), F.lit(n))


def labelled_sample(docs: DataFrame, labels: DataFrame, label: str, usable: Column, rows: int, by_class: bool) -> DataFrame:
    """Rows (doc_id, text, lang, label) of `rows` labelled documents at most (of each class, with by_class).

    The rows with the smallest keyed hash of their id are taken, so the sample is a random one and the same in each run.
    Only its ids, bounded by `rows`, are broadcast. Labels that repeat count once (the largest holds), as do documents.
    """
    known = labels.select("doc_id", F.col(label).cast("int").alias("label")).filter("doc_id is not null and label in (0, 1)").filter(usable)
    known = known.groupBy("doc_id").agg(F.max("label").alias("label"))
    parts = [known.filter(F.col("label") == k) for k in (0, 1)] if by_class else [known]
    picked = [p.orderBy(F.xxhash64(F.lit(11), "doc_id"), "doc_id").limit(rows) for p in parts]
    chosen = picked[0].union(picked[1]) if by_class else picked[0]
    return docs.select("doc_id", "text", "lang").join(F.broadcast(chosen), "doc_id").dropDuplicates(["doc_id"])
