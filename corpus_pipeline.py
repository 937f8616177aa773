"""A training-corpus pipeline over `documents`: each stage is one operator of grainfield.llm over all that the one before kept."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from grainfield.llm.bpe import encode_documents
from grainfield.llm.common import cut, table
from grainfield.llm.labelled import fold
from grainfield.llm.mixing import mix_sources
from grainfield.llm.ngramjoin import jaccard_components
from grainfield.llm.quality import score_quality
from grainfield.llm.toxicity import score_toxicity

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]
KEEP_QUALITY = 0.7


def toxicity(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the toxicity classifier doesn't reject at their language's threshold; null and empty texts are scored like any, columns beyond those of documents go."""
    scored = score_toxicity(docs.select(*COLUMNS), table(spark, sf_dir, "labels"), fold(F.col("doc_id"), 5) != 0)
    return scored.filter("not rejected").select(*COLUMNS)


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that their nearest labelled neighbours vote for; null and empty texts are scored like any."""
    scored = score_quality(docs.select(*COLUMNS), table(spark, sf_dir, "labels"), fold(F.col("doc_id"), 4) != 2)
    return scored.filter(F.col("quality") >= KEEP_QUALITY).select(*COLUMNS)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each component, the one with the smallest id: five words a shingle, a similarity of 0.8.

    Rows without an id or without words stay. Of rows that share an id the first text in byte order (then lang, source) stays, so reruns keep the same.
    """
    docs = docs.select(*COLUMNS)
    found = jaccard_components(docs, width=5, num=80, den=100)
    stay = cut(found.filter("doc_id = component_id").select("doc_id").distinct())
    one = docs.join(stay, "doc_id", "left_semi").groupBy("doc_id").agg(F.min(F.struct("text", "lang", "source", "n_chars")).alias("d")).select("doc_id", "d.*")
    return one.unionByName(docs.filter("doc_id is null")).select(*COLUMNS)


def mixing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """A row for each pass of the mix over a document: the words that the shards draw in it, which is the whole text in whole passes.

    Repeated rows are mixed each; texts without words are never taken.
    """
    keyed = docs.select(*COLUMNS).withColumn("mark", F.xxhash64("source", "text"))
    plan = mix_sources(docs.select("doc_id", "text", "source")).filter("taken > 0")
    plan = plan.select(F.col("doc_id").alias("id"), F.col("mark").alias("m"), "size", "draws")
    joined = keyed.dropDuplicates(["doc_id", "mark"]).join(plan, F.col("doc_id").eqNullSafe(F.col("id")) & (F.col("mark") == F.col("m")))
    turn = F.explode(F.array_distinct(F.transform("draws", lambda d: d["pass"])))
    joined = joined.withColumn("turn", turn).withColumn("draws", F.filter("draws", lambda d: d["pass"] == F.col("turn")))
    whole = F.aggregate("draws", F.lit(0).cast("long"), lambda n, d: n + d["n_words"]) == F.col("size")
    pieces = F.regexp_extract_all("text", F.lit(r"[\x20\x09-\x0D]*[^\x20\x09-\x0D]+"), F.lit(0))
    joined = joined.withColumn("whole", whole).withColumn("pieces", F.when(~F.col("whole"), pieces))
    ordered = F.array_sort(F.transform("draws", lambda d: F.struct(d["first_word"].alias("at"), d["n_words"].alias("n"))))
    words = F.flatten(F.transform(ordered, lambda d: F.slice("pieces", (d["at"] + 1).cast("int"), d["n"].cast("int"))))
    part = F.regexp_replace(F.array_join(words, ""), r"^[\x20\x09-\x0D]+", "")
    out = joined.select("doc_id", F.when(F.col("whole"), F.col("text")).otherwise(part).alias("text"), "lang", "source")
    return out.withColumn("n_chars", F.length("text").cast("long")).select(*COLUMNS)


def bpe(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Byte-level BPE ids of every row, and the bytes they decode to, as digests."""
    return encode_documents(docs, public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN)


STAGES = [("toxicity", toxicity), ("quality", quality), ("near_duplicates", near_duplicates), ("mixing", mixing), ("bpe", bpe)]

#: Trained classifiers and the tokenizer have no SQL; tests hold the stages against brute force instead.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over `documents`, each one's rows written in the shared folder and read again by the next."""
    docs = table(spark, sf_dir, "documents")
    for _, stage in STAGES[:-1]:
        docs = cut(stage(spark, docs, sf_dir))
    return STAGES[-1][1](spark, docs, sf_dir)
