"""Removal of repeated byte strings, against counting every string."""

import hashlib
import random
from collections import Counter

import numpy as np
import pytest

from ledgerline.llm import suffix_dedup
from ledgerline.llm.multikey import equal_classes
from ledgerline.llm.queries import op11_suffix_dedup
from ledgerline.llm.suffix_dedup import remove_repeats

from helpers import AWKWARD, SF, frame


def brute(texts, length):
    """(n_bytes, runs, kept) of each text."""
    texts = [(t or "").encode() for t in texts]
    seen = Counter(t[p : p + length] for t in texts for p in range(len(t) - length + 1))
    out = []
    for t in texts:
        gone = bytearray(len(t))
        for p in range(len(t) - length + 1):
            if seen[t[p : p + length]] > 1:
                gone[p : p + length] = b"\1" * length
        runs, p = [], 0
        while p < len(t):
            q = p
            while q < len(t) and gone[q] == gone[p]:
                q += 1
            if gone[p]:
                runs.append((p, q))
            p = q
        out.append((len(t), runs, bytes(b for b, g in zip(t, gone) if not g)))
    return out


def found(rows):
    return sorted(
        (r.doc_id is None, r.doc_id or 0, r.n_bytes, [(x["begin"], x["end"]) for x in r.removed], bytes(r.kept))
        for r in rows.collect()
    )


def wanted(rows, length):
    texts = brute([r[1] for r in rows], length)
    return sorted((r[0] is None, r[0] or 0, *t) for r, t in zip(rows, texts))


def test_equal_classes_are_all_equal_strings():
    rng = np.random.default_rng(3)
    raw = rng.integers(97, 99, 4000).astype(np.uint8)
    raw[1000:1300] = raw[2000:2300]
    starts = np.arange(len(raw) - 20)
    part = starts % 2
    who, classes = equal_classes(raw, starts, 20, part)
    groups = {}
    for s in starts:
        groups.setdefault((s % 2, raw[s : s + 20].tobytes()), set()).add(int(s))
    want = sorted(sorted(g) for g in groups.values() if len(g) > 1)
    got = {}
    for w, c in zip(who, classes):
        got.setdefault(int(c), set()).add(int(w))
    assert sorted(sorted(g) for g in got.values()) == want


def test_awkward_documents(spark):
    assert found(remove_repeats(frame(spark), 200)) == wanted(AWKWARD, 200)
    assert found(remove_repeats(frame(spark), 40)) == wanted(AWKWARD, 40)
    assert remove_repeats(frame(spark).limit(0), 200).count() == 0
    with pytest.raises(ValueError):
        remove_repeats(frame(spark), 8)


def test_hot_passage_is_cut_over_buckets(spark, monkeypatch):
    """One passage in a third of all texts, copies, near copies and runs of one letter."""
    monkeypatch.setattr(suffix_dedup, "BUCKET", 1500)
    monkeypatch.setattr(suffix_dedup, "HELD", 2000)
    rng = random.Random(5)
    word = lambda: "".join(rng.choice("abcdeé") for _ in range(rng.randint(1, 9)))
    prose = lambda n: " ".join(word() for _ in range(n))
    passage, other = prose(40), prose(90)
    rows = []
    for i in range(150):
        text = prose(rng.randint(5, 60))
        if i % 3 == 0:
            text = f"{text} {passage} {prose(10)}"
        if i % 10 == 1:
            cut = rng.randint(0, len(other))
            text = other[:cut] + "#" + other[cut:]
        if i % 25 == 2:
            text = other
        if i % 50 == 3:
            text = "z" * 400 + word()
        rows.append((i if i % 7 else None, text, "en", "a"))
    seen = []
    splitters = suffix_dedup._splitters
    monkeypatch.setattr(
        suffix_dedup, "_splitters", lambda *a: seen.append(splitters(*a)) or seen[-1]
    )
    assert found(remove_repeats(frame(spark, rows), 100)) == wanted(rows, 100)
    assert len(seen[0]) > 8 and any(len(cut) > 33 for cut in seen[0])


def test_pieces_of_long_texts_overlap(spark):
    rng = random.Random(9)
    body = "".join(rng.choice("abcdefgh ") for _ in range(suffix_dedup.PIECE + 5000))
    rows = [(1, body, "en", "a"), (2, body[suffix_dedup.PIECE - 400 : suffix_dedup.PIECE + 300], "en", "a")]
    got = found(remove_repeats(frame(spark, rows), 200))
    cut = (suffix_dedup.PIECE - 400, suffix_dedup.PIECE + 300)
    assert got[0][3] == [cut] and got[0][4] == (body[: cut[0]] + body[cut[1] :]).encode()
    assert got[1][3] == [(0, 700)] and got[1][4] == b""


def test_query_over_the_table(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").collect()
    want = sorted(
        (d.doc_id, n, sum(e - b for b, e in runs), len(runs), hashlib.sha256(kept).hexdigest())
        for d, (n, runs, kept) in zip(docs, brute([d.text for d in docs], 200))
    )
    assert sorted(tuple(r) for r in op11_suffix_dedup(spark, SF).collect()) == want
