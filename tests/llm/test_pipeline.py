"""The stages of the corpus pipeline, each against what its operator says, and the driver's view."""

import public_tokenizers
import sentencepiece

import __spark_entry__ as driver
import corpus_pipeline
from ledgerline.llm.quality import fit_quality, score_quality
from ledgerline.llm.toxicity import fit_toxicity, score_toxicity

from helpers import AWKWARD, SF, frame, groups, near_pairs, shingles


def test_stages(spark, tmp_path):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    labels = spark.read.parquet(f"{SF}/labels.parquet")
    before, kept = docs, {}
    for name, stage in corpus_pipeline.STAGES:
        stage(spark, before, SF).write.parquet(f"{tmp_path}/{name}")
        kept[name] = spark.read.parquet(f"{tmp_path}/{name}")
        if name != "encode":
            assert kept[name].columns == docs.columns
        before = kept[name]
    ids = {name: sorted(r.doc_id for r in rows.select("doc_id").collect()) for name, rows in kept.items()}

    good = score_quality(docs, fit_quality(docs, labels)).where("predicted = 1")
    assert ids["quality"] == sorted(r.doc_id for r in good.collect())
    clean = kept["quality"]
    clean = score_toxicity(clean, fit_toxicity(clean, labels)).where("predicted = 0")
    assert ids["toxicity"] == sorted(r.doc_id for r in clean.collect())

    sets = {r.doc_id: shingles(r.text, 5) for r in kept["toxicity"].collect()}
    assert ids["near_copies"] == sorted(set(groups(near_pairs(sets, 80, 100), sets).values()))

    texts = {r.doc_id: r.text for r in docs.collect()}
    model = sentencepiece.SentencePieceProcessor(model_file=public_tokenizers.path("piece_bpe_32k.model"))
    assert ids["encode"] == ids["mix"] and set(ids["mix"]) <= set(ids["near_copies"])
    for r in kept["encode"].collect():
        assert r.ids == model.encode(texts[r.doc_id] or "")


def test_stages_take_awkward_documents(spark):
    docs = frame(spark)
    for name, stage in corpus_pipeline.STAGES:
        out = stage(spark, docs, SF)
        assert out.count() <= 3 * len(AWKWARD), name
        assert stage(spark, docs.limit(0), SF).count() == 0, name
    copies = corpus_pipeline.STAGES[2][1](spark, docs, SF)
    left = sorted((r.doc_id for r in copies.collect()), key=lambda i: (i is None, i))
    assert left == [-9, 1, 3, 4, 5, 6, 7, 10, None]


def test_copies_without_an_id(spark):
    words = [f"w{k}" for k in range(200)]
    other = [f"v{k}" for k in range(200)]
    near = lambda w: " ".join([*w[:-1], "end"])
    rows = [
        (5, " ".join(words), "en", "a"), (None, near(words), "en", "a"),
        (None, " ".join(other), "en", "a"), (None, " ".join(other), "en", "b"), (None, near(other), "en", "a"),
        (7, "", "en", "a"), (None, "", "en", "a"), (None, " ", "en", "a"), (None, "", "en", "b"), (None, None, "en", "a"),
    ]
    got = corpus_pipeline.drop_copies(spark, frame(spark, rows), SF).collect()
    assert sorted(r.doc_id for r in got if r.doc_id is not None) == [5, 7]
    nameless = [r.text for r in got if r.doc_id is None]
    assert len([t for t in nameless if t and t.strip()]) == 1
    assert len([t for t in nameless if not (t and t.strip())]) == 4


def test_driver_has_all_queries():
    names = driver.queries().keys()
    assert {n.split("_")[0] for n in names} >= {f"op{k}" for k in range(1, 11)} | {"pipeline"}
    assert set(driver.oracle_sql()) <= set(names)
