"""The queries of this subpackage over the test tables, and the SQL of those that have any."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerline.llm.collocations import collocations
from ledgerline.llm.collocations_sql import PHRASES_SQL
from ledgerline.llm.html_text import extract_main_text
from ledgerline.llm.multi_index import nearest_vectors
from ledgerline.llm.ngram_join import ngram_join
from ledgerline.llm.quality import classify_quality
from ledgerline.llm.sentence_pieces import encode
from ledgerline.llm.simhash import fingerprint_documents
from ledgerline.llm.source_mix import mix_sources
from ledgerline.llm.source_mix_sql import MIX_SQL
from ledgerline.llm.suffix_dedup import remove_repeats
from ledgerline.llm.token_count import count_tokens
from ledgerline.llm.token_file import token_file_digest
from ledgerline.llm.toxicity import classify_toxicity
from ledgerline.llm.whitening import whiten

Query = Callable[[SparkSession, str], DataFrame]


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_sentence_pieces(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = public_tokenizers.path("piece_bpe_32k.model")
    return encode(table(spark, sf_dir, "documents"), path, check=True)


def op2_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return classify_quality(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op3_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return classify_toxicity(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op4_multi_index(spark: SparkSession, sf_dir: str) -> DataFrame:
    return nearest_vectors(table(spark, sf_dir, "embeddings"), nearest=20)


def op5_token_file(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = public_tokenizers.path("word_bpe_49k.json")
    return token_file_digest(table(spark, sf_dir, "documents"), path, end_id=1)


def op6_html_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return extract_main_text(table(spark, sf_dir, "pages"))


def op7_ngram_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ngram_join(table(spark, sf_dir, "documents"), length=3, num=90, den=100)


def op8_token_count(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = public_tokenizers.path("byte_bpe_50k.json")
    return count_tokens(table(spark, sf_dir, "documents"), path, limit=512)


def op9_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fingerprint_documents(table(spark, sf_dir, "documents"))


def op10_source_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    mixed = mix_sources(table(spark, sf_dir, "documents"))
    return mixed.select("doc_id", "size", "source_size", "target", "taken")


def op11_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    removed = F.aggregate("removed", F.lit(0).cast("long"), lambda n, r: n + r["end"] - r["begin"])
    return remove_repeats(table(spark, sf_dir, "documents"), length=200).select(
        "doc_id", "n_bytes", removed.alias("n_removed"),
        F.size("removed").cast("long").alias("n_spans"), F.sha2("kept", 256).alias("kept_sha256"),
    )


def op12_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    whitened = whiten(table(spark, sf_dir, "embeddings"), keep=4)
    return whitened.withColumn("deviation", F.col("deviation").try_cast("long"))


def op13_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return collocations(table(spark, sf_dir, "documents"), least=30, top=2000, covered=80)


QUERIES: dict[str, Query] = {
    "op1_sentence_pieces": op1_sentence_pieces,
    "op2_quality": op2_quality,
    "op3_toxicity": op3_toxicity,
    "op4_multi_index": op4_multi_index,
    "op5_token_file": op5_token_file,
    "op6_html_text": op6_html_text,
    "op7_ngram_join": op7_ngram_join,
    "op8_token_count": op8_token_count,
    "op9_simhash": op9_simhash,
    "op10_source_mix": op10_source_mix,
    "op11_suffix_dedup": op11_suffix_dedup,
    "op12_whitening": op12_whitening,
    "op13_collocations": op13_collocations,
}

ORACLE: dict[str, str] = {"op10_source_mix": MIX_SQL, "op13_collocations": PHRASES_SQL}
