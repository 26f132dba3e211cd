"""A training corpus from raw documents: filter, deduplicate, mix, encode.

Every stage takes (spark, docs, sf_dir) and gives a DataFrame; all but the last give the
columns of ``documents``. Each is written as Parquet and read again before the next.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerline.llm.ngram_join import ngram_groups, vertex_of
from ledgerline.llm.quality import fit_quality, score_quality
from ledgerline.llm.sentence_pieces import encode
from ledgerline.llm.source_mix import mix_sources, word_count
from ledgerline.llm.toxicity import fit_toxicity, score_toxicity
from ledgerline.llm.worktables import WorkTables

COLUMNS = ("doc_id", "text", "lang", "source", "n_chars")


def _documents(docs: DataFrame) -> DataFrame:
    return docs.select(*COLUMNS)


def keep_good(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality classifier takes for good.

    Null and empty texts are scored as texts without terms and go or stay by that score; texts
    of any length are scored whole. Equal texts have equal scores, so repeated rows, and rows
    without an id, go or stay together. Without labels or documents nothing breaks: a model
    of no labelled text gives every document the same score.
    """
    docs = _documents(docs)
    model = fit_quality(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))
    return _documents(score_quality(docs, model).where(F.col("predicted") == 1))


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without significant toxic passages.

    Null and empty texts have no passage and stay. Texts of any length are scanned whole. Equal
    texts have equal scores, so repeated rows, and rows without an id, go or stay together.
    No documents give none; a model of no labelled text finds nothing.
    """
    docs = _documents(docs)
    model = fit_toxicity(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))
    return _documents(score_toxicity(docs, model).where(F.col("predicted") == 0))


def drop_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The document with the least doc_id of each group of near copies (five words, 0.8).

    Of rows with one doc_id one stays. Rows without an id are in the same groups: of a group of
    such rows only, one stays. Those without a word are linked with nothing and all stay.
    """
    docs = _documents(docs)
    work = WorkTables(spark, "near-copies")
    named, nameless = docs.where("doc_id IS NOT NULL"), docs.where("doc_id IS NULL")
    # a row with an id comes before those without
    first = F.min(F.struct(F.col("doc_id").isNull().alias("nameless"), "vertex")).alias("first")
    groups = ngram_groups(docs, length=5, num=80, den=100).groupBy("root").agg(first)
    if nameless.isEmpty():
        kept = groups.select(F.col("first.vertex").alias("doc_id"))
        return named.join(kept, "doc_id").dropDuplicates(["doc_id"]).select(*COLUMNS)
    kept = work.store(groups.select("first.nameless", "first.vertex"), "kept")
    ids = kept.where("NOT nameless").select(F.col("vertex").alias("doc_id"))
    has_words = F.coalesce(F.col("text").rlike(r"[^\x20\x09-\x0D]"), F.lit(False))
    texts = nameless.where(has_words).withColumn("vertex", vertex_of()).dropDuplicates(["vertex"])
    texts = texts.join(kept.where("nameless").select("vertex"), "vertex", "left_semi")
    return (
        named.join(ids, "doc_id").dropDuplicates(["doc_id"]).select(*COLUMNS)
        .union(texts.select(*COLUMNS)).union(nameless.where(~has_words))
    )


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every document as often as the mix has it.

    A document that the mix leaves out, also one without words or with a null text, has no row.
    A null source is a source. Rows of one id, source and size are taken alike; where rows share
    an id but not their size, each has its own number of copies. No documents give none.
    """
    docs = _documents(docs).withColumn("size", word_count(F.col("text")))
    keys = ("doc_id", "source", "size")
    copies = mix_sources(docs).groupBy(*keys).agg(F.max("copies").alias("copies")).where("copies > 0 AND size > 0")
    copies = copies.select("copies", *[F.col(k).alias(f"its_{k}") for k in keys])
    same = [docs[k].eqNullSafe(copies[f"its_{k}"]) for k in keys]
    repeats = F.explode(F.sequence(F.lit(1).cast("long"), F.col("copies")))
    return docs.join(copies, same).withColumn("repeat", repeats).select(*COLUMNS)


def tokenize(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The piece ids of every document of the mix.

    One row for each row of ``docs``, repeats included, with doc_id and source; null and empty
    texts have no ids, texts of any length are encoded whole.
    """
    path = public_tokenizers.path("piece_bpe_32k.model")
    return encode(_documents(docs), path, keep=("doc_id", "source"))


STAGES = [
    ("quality", keep_good),
    ("toxicity", drop_toxic),
    ("near_copies", drop_copies),
    ("mix", mix),
    ("encode", tokenize),
]

# the stages' models and hashes have no form in SQL; the tests hold them against brute force
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``."""
    work = WorkTables(spark, "pipeline")
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = work.store(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
