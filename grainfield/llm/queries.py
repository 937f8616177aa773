"""The queries of this package, and the SQL of those that SQL can express.

Each query is a thin digest of an operator over its whole table. Queries import their operator when they run.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import table


def op1_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents mixed by source: weights 3, 1, 2 repeating, 150% of all words, twice a source's words at most."""
    from .mixing import mix_sources

    drawn = F.transform("draws", lambda d: F.struct(d["shard"].alias("shard"), d["n_words"].alias("n_words"))).alias("drawn")
    return mix_sources(table(spark, sf_dir, "documents")).select("doc_id", "size", "source_size", "target", "taken", drawn)


def op2_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Toxicity of every document; learnt from the labels outside the fold 0 of 5."""
    from .labelled import fold
    from .toxicity import score_toxicity

    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    scored = score_toxicity(docs, table(spark, sf_dir, "labels"), fold(F.col("doc_id"), 5) != 0)
    held = F.coalesce(fold(F.col("doc_id"), 5) == 0, F.lit(False))
    return scored.select("doc_id", held.alias("held_out"), F.col("toxicity").alias("score"), (F.col("toxicity") >= 0.5).cast("int").alias("predicted"))


def op3_main_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Main text of every page."""
    from .html import extract_pages

    return extract_pages(table(spark, sf_dir, "pages"))


def op4_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Quality of every document; learnt from the labels outside the fold 2 of 4."""
    from .labelled import fold
    from .quality import score_quality

    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    scored = score_quality(docs, table(spark, sf_dir, "labels"), fold(F.col("doc_id"), 4) != 2)
    held = F.coalesce(fold(F.col("doc_id"), 4) == 2, F.lit(False))
    return scored.select("doc_id", held.alias("held_out"), F.col("quality").alias("score"), (F.col("quality") >= 0.7).cast("int").alias("predicted"))


def op5_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Token files of every document, read back frame by frame."""
    import public_tokenizers

    from .tokenfiles import read_token_files, write_token_files

    files = write_token_files(table(spark, sf_dir, "documents"), public_tokenizers.path("word_bpe_49k.json"), end_id=2)
    return read_token_files(files)


def op6_licenses(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Licence phrases, tags and expressions of every document."""
    from .licenses import scan_licenses

    return scan_licenses(table(spark, sf_dir, "documents"))


def op7_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Byte-level BPE ids of every document, and the bytes they decode to, as digests."""
    import public_tokenizers

    from .bpe import encode_documents

    return encode_documents(table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN)


def op8_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Base counts and risk-controlled verdicts of every document."""
    from .rules import apply_rules

    judged = apply_rules(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))
    return judged.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept")


def op9_ngram_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Components of documents whose sets of 4-word shingles are 85% alike."""
    from .ngramjoin import jaccard_components

    return jaccard_components(table(spark, sf_dir, "documents"), width=4, num=85, den=100)


def op10_near_vectors(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Links, components and survivors of all embeddings, by label, at a cosine of 0.93."""
    from .vectors import near_duplicates

    return near_duplicates(table(spark, sf_dir, "embeddings"))


def pipeline(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages of corpus_pipeline.py over documents."""
    import corpus_pipeline

    return corpus_pipeline.run(spark, sf_dir)


def queries() -> dict:
    named = (op1_mix, op2_toxicity, op3_main_text, op4_quality, op5_token_files, op6_licenses, op7_bpe, op8_rules, op9_ngram_join, op10_near_vectors, pipeline)
    return {f.__name__: f for f in named}


def oracle_sql() -> dict[str, str]:
    from . import vectors
    from .rules import rules_sql

    return {"op8_rules": rules_sql(), "op10_near_vectors": vectors.SQL}
