"""Bounded samples of labelled documents, and which documents are held out."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerline.llm.worktables import WorkTables


def held_out(doc_id: Column) -> Column:
    """Whether no label of this document may be learned from."""
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit(""))) % 4 == 2


def labelled_sample(
    documents: DataFrame, labels: DataFrame, label: str, per_class: dict[int, int], work: WorkTables
) -> tuple[DataFrame, dict[int, int]]:
    """(text, y) of at most ``per_class`` documents of each class, and the class sizes.

    Taken are those whose id has the least hash, so the sample spreads over all documents and
    is the same in every run. Held-out and unlabelled documents, null ids and texts, and labels
    of what is not in ``documents`` are left out before; a document with several labels counts
    with the largest. Of documents with the same text one is kept, as copies of one text would
    pass for many witnesses. The ids of the sample,
    at most the sum of ``per_class``, are broadcast to find its texts.
    """
    known = (
        labels.where(F.col(label).isin(*per_class) & F.col("doc_id").isNotNull())
        .groupBy("doc_id").agg(F.max(label).cast("int").alias("y"))
        .where(~held_out(F.col("doc_id")))
    )
    texts = documents.select("doc_id", "text").where("text IS NOT NULL AND doc_id IS NOT NULL")
    # an id repeated in very many rows is folded before it meets its label
    known = work.store(known.join(texts.select("doc_id").distinct(), "doc_id", "left_semi"), "known")
    sizes = {r[0]: r[1] for r in known.groupBy("y").count().collect()}
    chosen = None
    for value, most in per_class.items():
        part = known.where(F.col("y") == value).orderBy(F.xxhash64("doc_id"), "doc_id").limit(most)
        chosen = part if chosen is None else chosen.union(part)
    sample = texts.join(F.broadcast(work.store(chosen, "chosen")), "doc_id")
    one = sample.groupBy("y", F.sha2("text", 256).alias("whole")).agg(
        F.max_by("text", F.struct("doc_id", "text")).alias("text")
    )
    return work.store(one.select("text", "y"), "sample"), sizes
