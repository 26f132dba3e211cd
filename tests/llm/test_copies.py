"""The n-gram join and fingerprints against brute force."""

import hashlib
import math
import random
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from ledgerline.llm import ngram_join as join_module
from ledgerline.llm.components import components
from ledgerline.llm.ngram_join import ngram_join
from ledgerline.llm.rtree import CountTree, overlap_needed, spanning_links
from ledgerline.llm.simhash import (
    BITS,
    fingerprint_classes,
    fingerprint_documents,
    fingerprints,
)
from ledgerline.llm.textwords import shingle_sets
from ledgerline.llm.worktables import WorkTables, order_bounds, part_of

from helpers import AWKWARD, SF, frame, groups, near_pairs, shingles


def brute(rows, length, num, den):
    sets = {i: shingles(t, length) for i, t in rows}
    return {(i, len(sets[i]), c) for i, c in groups(near_pairs(sets, num, den), sets).items()}


def edited(draw, base, changes):
    words = base.split()
    for _ in range(changes):
        words[draw.randrange(len(words))] = f"n{draw.randrange(10**6)}"
    return " ".join(words)


def planted():
    """Chains of near copies, one large group, and passages that many texts share."""
    draw = random.Random(4)
    word = lambda: "".join(draw.choices("abcdefgh", k=draw.randint(2, 6)))
    passage = " ".join(word() for _ in range(60))
    texts = []
    for k in range(60):
        base = " ".join(word() for _ in range(draw.choice([4, 12, 60, 300, 1500, 9000 if k < 3 else 90])))
        texts.append(base)
        for _ in range(draw.choice([0, 1, 3])):
            base = edited(draw, base, max(1, len(base.split()) // 80))
            texts.append(base)
    base = " ".join(word() for _ in range(120))
    texts += [edited(draw, base, 1) for _ in range(150)]
    texts += [passage + " " + " ".join(word() for _ in range(40)) for _ in range(150)]
    draw.shuffle(texts)
    return list(enumerate(texts))


@pytest.mark.parametrize("length,num", [(3, 90), (5, 80)])
def test_planted_copies(spark, monkeypatch, length, num):
    rows = planted()
    monkeypatch.setattr(join_module, "BLOCK", 20)
    out = ngram_join(spark.createDataFrame(rows, "doc_id long, text string").repartition(4), length, num, 100)
    assert {tuple(r) for r in out.collect()} == brute(rows, length, num, 100)


def test_common_keys_change_nothing(spark, monkeypatch):
    # a low bar makes very many keys common, and then crowded
    rows = planted()[:250]
    real = max
    monkeypatch.setattr(join_module, "BLOCK", 2)
    monkeypatch.setattr(join_module, "max", lambda a, b: 3 if a == 50 else real(a, b), raising=False)
    out = ngram_join(spark.createDataFrame(rows, "doc_id long, text string").repartition(3), 3, 90, 100)
    assert {tuple(r) for r in out.collect()} == brute(rows, 3, 90, 100)


@pytest.mark.parametrize("few", [500_000, 0])
def test_keys_taken_for_common_ones_are_dealt_too(spark, monkeypatch, few):
    # one passage of fewer sets than make a shingle common, and one of more
    draw = random.Random(6)
    word = lambda: "".join(draw.choices("abcdefgh", k=6))
    texts = []
    for shared, count in ((48, 45), (48, 160), (95, 160)):
        passage = " ".join(word() for _ in range(shared + 4))
        texts += [passage + " " + " ".join(word() for _ in range(100 - shared)) for _ in range(count)]
    rows = list(enumerate(texts))
    monkeypatch.setattr(join_module, "BLOCK", 5)
    monkeypatch.setattr(join_module, "FEW_CROWDED", few)
    taken, real = [], join_module._routed

    def routed(*given):
        out = real(*given)
        taken.extend(r["count"] for r in out.groupBy("key").count().collect())
        return out

    monkeypatch.setattr(join_module, "_routed", routed)
    out = ngram_join(spark.createDataFrame(rows, "doc_id long, text string").repartition(3), 5, 80, 100)
    assert {tuple(r) for r in out.collect()} == brute(rows, 5, 80, 100)
    # pairs of blocks of about 5 sets each
    assert taken and max(taken) <= 30


def test_all_documents(spark):
    documents = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text")
    got = {tuple(r) for r in ngram_join(documents, 3, 90, 100).collect()}
    assert got == brute([tuple(r) for r in documents.collect()], 3, 90, 100)


def test_awkward_documents(spark):
    got = [tuple(r) for r in ngram_join(frame(spark), 3, 90, 100).collect()]
    assert len(got) == len(AWKWARD)
    by_id = {r[0]: r for r in got}
    assert by_id[1][2] == by_id[2][2] == 1 and got.count(by_id[2]) == 2
    assert by_id[3] == (3, 0, 3) and by_id[4] == (4, 0, 4) and by_id[5] == (5, 0, 5)
    assert by_id[6] == (6, 1, 6)
    assert by_id[8][2] == 7
    assert by_id[None][2] is None
    assert ngram_join(frame(spark).limit(0), 3, 90, 100).collect() == []


def test_rows_of_one_id_are_one_vertex(spark):
    rows = [(5, "a b c d e f"), (5, "u v w x y z"), (3, "a b c d e f"), (9, "u v w x y z")]
    got = ngram_join(spark.createDataFrame(rows, "doc_id long, text string"), 3, 90, 100).collect()
    assert sorted(tuple(r) for r in got) == [(3, 4, 3), (5, 4, 3), (5, 4, 3), (9, 4, 3)]


def test_tree_search_loses_nothing():
    draw = np.random.default_rng(2)
    sets = [draw.choice(4000, size, replace=False) for size in draw.integers(1, 120, 300)]
    sets += [np.unique(np.append(s[: max(1, len(s) - 2)], draw.integers(0, 4000, 2))) for s in sets]
    counts = np.stack([np.bincount(s % 16, minlength=16) for s in sets])
    sizes = counts.sum(1)
    tree = CountTree(counts, sizes, 90, 100)
    for k, s in enumerate(sets):
        found = set(tree.order[tree.search(counts[k], int(sizes[k]))].tolist())
        for j, other in enumerate(sets):
            both = len(np.intersect1d(s, other))
            if 100 * both >= 90 * (len(s) + len(other) - both):
                assert j in found
    exact = lambda a, others: np.array([
        len(np.intersect1d(sets[a], sets[o])) >= overlap_needed(len(sets[a]), len(sets[o]), 90, 100)
        for o in others
    ])
    got = groups(spanning_links(counts, sizes, 90, 100, exact), range(len(sets)))
    assert got == groups(near_pairs(dict(enumerate(map(set, sets))), 90, 100), range(len(sets)))


def test_shingle_hashes_tell_sets_apart():
    texts = ["A b c D", "a B C d", "a b c d", "a  b\tc\nd", "", None, "É x y", "é x y"]
    hashes, bounds = shingle_sets(pa.array(texts), 3)
    sets = [tuple(hashes[a:b]) for a, b in zip(bounds[:-1], bounds[1:])]
    for i, a in enumerate(texts):
        for j, b in enumerate(texts):
            assert (sets[i] == sets[j]) == (shingles(a, 3) == shingles(b, 3)), (a, b)


def test_components_of_a_chain_and_a_star(spark):
    links = [(k, k + 1) for k in range(100)] + [(500, k) for k in range(501, 700)] + [(7, 7), (1, 0)]
    out = components(spark, spark.createDataFrame(links, "u long, v long"), WorkTables(spark, "t"), "c")
    got = {r.vertex: r.root for r in out.collect()}
    assert got == {k: 0 for k in range(101)} | {k: 500 for k in range(500, 700)}
    none = spark.createDataFrame([], "u long, v long")
    assert components(spark, none, WorkTables(spark, "t"), "c").collect() == []


def test_fingerprints_of_all_documents(spark):
    documents = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text")
    rows = sorted((r.doc_id, r.text or "") for r in documents.collect())
    got = {r.doc_id: r for r in fingerprint_documents(documents).collect()}
    assert len(got) == len(rows)
    prints = {}
    for k, (doc, text) in enumerate(rows):
        following = rows[(k + 1) % len(rows)][1]
        half = len(text) // 2
        changed = text[: len(text) - half] + following[:half]
        row = got[doc]
        assert row.n_chars == len(text)
        assert row.edited_sha256 == hashlib.sha256(changed.encode()).hexdigest()
        a, b = (p.tobytes().hex() for p in fingerprints(pa.array([text, changed])))
        assert (row.fingerprint, row.edited_fingerprint) == (a, b)
        assert 0 <= row.near_edited <= 1 and 0 <= row.near_next <= 1
        prints[doc] = int(a, 16)
    better = [r.near_edited > r.near_next for r in got.values() if r.n_chars > 200]
    assert sum(better) > 0.97 * len(better)
    pairs = [(a, b) for a in prints for b in prints if a < b and (prints[a] ^ prints[b]).bit_count() <= 7]
    classes = groups(pairs, prints)
    assert {d: r.class_id for d, r in got.items()} == classes


def test_fingerprint_by_votes():
    texts = ["a b c", "a b c a b c a b c x", "one"]
    prints = fingerprints(pa.array(texts))
    assert prints.shape == (3, BITS // 8)
    alone = fingerprints(pa.array(["a b c"]))
    assert (alone[0] == prints[0]).all()
    assert not fingerprints(pa.array(["", None, " \n"])).any()


def test_classes_within_the_radius(spark):
    draw = random.Random(8)
    base = [draw.getrandbits(BITS) for _ in range(40)]
    values = list(base)
    for b in base[:20]:
        for bits in (1, 5, 7, 8, 12):
            values.append(b ^ sum(1 << k for k in draw.sample(range(BITS), bits)))
    rows = [(f"{v:0{BITS // 4}x}",) for v in values] + [(None,), (f"{base[0]:0{BITS // 4}x}",)]
    out = fingerprint_classes(spark.createDataFrame(rows, "fingerprint string"), 7).collect()
    got = {}
    for r in out:
        got.setdefault(r.class_of, set()).add(int(r.fingerprint, 16))
    members = sorted(set(values))
    pairs = [(a, b) for i, a in enumerate(members) for b in members[i + 1 :] if (a ^ b).bit_count() <= 7]
    want = {}
    for m, g in groups(pairs, members).items():
        want.setdefault(g, set()).add(m)
    assert sorted(map(sorted, got.values())) == sorted(sorted(s) for s in want.values() if len(s) > 1)


def test_awkward_chain(spark):
    got = fingerprint_documents(frame(spark)).collect()
    assert len(got) == len(AWKWARD)
    assert all(r.n_chars == 0 and r.near_edited == 1.0 for r in got if r.doc_id in (3, 4))
    assert fingerprint_documents(frame(spark).limit(0)).count() == 0
    alone = fingerprint_documents(frame(spark, [(4, "just one text", "en", "a")])).collect()
    assert len(alone) == 1 and alone[0].near_next == 1.0


def hot_rows():
    """A third without an id, a third of one id, and others; some rows twice."""
    text = lambda k: f"text {k} " * (k % 7 + 1) + "the end"
    rows = [(None, text(k), "en", "a") for k in range(150)] + [(50, text(k), "en", "a") for k in range(150, 300)]
    rows += [(k, text(k), "en", "b") for k in range(150)] + [(None, text(1), "en", "c"), (50, text(151), "en", "c")]
    return rows


def test_hot_ids_are_many_parts(spark):
    rows = frame(spark, hot_rows())
    bounds = order_bounds(rows, "doc_id", 24)
    h = F.xxhash64("text")
    placed = rows.select("doc_id", h.alias("h"), part_of(F.col("doc_id"), bounds, h).alias("part")).collect()
    placed.sort(key=lambda r: (r.doc_id is not None, r.doc_id or 0, r.h))
    assert [r.part for r in placed] == sorted(r.part for r in placed)
    sizes = Counter(r.part for r in placed)
    assert max(sizes.values()) <= 3 * len(placed) / 24 and len(sizes) >= 20
    for few in (rows.where("doc_id IS NULL"), rows.where("doc_id = 50"), rows.limit(1), rows.limit(0)):
        cut = order_bounds(few, "doc_id", 24)
        parts = {r.part for r in few.select(part_of(F.col("doc_id"), cut, h).alias("part")).collect()}
        assert len(parts) >= min(12, few.count())


def test_chain_of_hot_ids(spark):
    documents = frame(spark, hot_rows())
    order = documents.select("doc_id", "text", F.xxhash64("text").alias("h")).collect()
    order.sort(key=lambda r: (r.doc_id is not None, r.doc_id or 0, r.h))
    want = []
    for k, r in enumerate(order):
        following = order[(k + 1) % len(order)].text
        half = len(r.text) // 2
        changed = r.text[: len(r.text) - half] + following[:half]
        a, b, c = (int(p.tobytes().hex(), 16) for p in fingerprints(pa.array([r.text, changed, following])))
        near = [round(1.0 if a == x else max(0.0, math.cos(math.pi * (a ^ x).bit_count() / BITS)), 9) for x in (b, c)]
        want.append((r.doc_id, len(r.text), hashlib.sha256(changed.encode()).hexdigest(), *near))
    got = [
        (r.doc_id, r.n_chars, r.edited_sha256, round(r.near_edited, 9), round(r.near_next, 9))
        for r in fingerprint_documents(documents).collect()
    ]
    assert sorted(got, key=repr) == sorted(want, key=repr)
