"""Phrases against a plain count of all n-grams."""

import random
import re
from collections import Counter

import pyarrow as pa

from ledgerline.llm.collocations import SLICE, _texts, collocations
from ledgerline.llm.queries import op13_collocations

from helpers import AWKWARD, SF, frame

FOLD = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def brute(rows, least=30, top=2000, covered=80):
    """rows: (lang, text); what the operator returns, in order."""
    counts, totals = {}, Counter()
    for lang, text in rows:
        lang = "und" if lang is None else lang
        seen = counts.setdefault(lang, Counter())
        for piece in re.split("[.,;:!?\x0a-\x0d]", (text or "").translate(FOLD)):
            w = re.findall("[^\x20\x09]+", piece)
            totals[lang] += len(w)
            for k in range(1, 5):
                seen.update(tuple(w[i : i + k]) for i in range(len(w) - k + 1))
    out = []
    for lang, seen in counts.items():
        phrases = {g: n for g, n in seen.items() if len(g) > 1 and n >= least}
        hidden = {
            g[i : i + k]
            for g, n in phrases.items()
            for k in range(2, len(g))
            for i in range(len(g) - k + 1)
            if 100 * n >= covered * seen[g[i : i + k]]
        }
        found = []
        for g, a in phrases.items():
            if g not in hidden:
                score, k = min((2000000 * a // (seen[g[:k]] + seen[g[k:]]), k) for k in range(1, len(g)))
                found.append((-score, -a, " ".join(g).encode(), seen[g[:k]], seen[g[k:]]))
        for rank, (score, a, phrase, left, right) in enumerate(sorted(found)[:top], 1):
            out.append((lang, rank, phrase.decode(), -a, left, right, totals[lang], -score))
    return sorted(out)


def found(rows):
    return sorted(tuple(r) for r in rows.select("lang", "rank", "phrase", "a", "l", "r", "n", "score").collect())


def test_awkward_documents(spark):
    rows = [(r[2], r[1]) for r in AWKWARD]
    assert found(collocations(frame(spark), least=2)) == brute(rows, least=2)
    assert collocations(frame(spark).limit(0)).count() == 0


def planted():
    """A few words, so that phrases of all lengths repeat; one pair of words in most pieces."""
    rng = random.Random(4)
    some = ["of", "the", "Ärger", "b-c", "x", "yy", "É", "\x00", "中"]
    rows = []
    for k in range(300):
        w = rng.choices(some, weights=[9, 9, 3, 2, 2, 1, 1, 1, 1], k=rng.randint(0, 40))
        w = [x if rng.random() < 0.8 else x + rng.choice(".,;:!?\n\v\f\r") for x in w]
        text = rng.choice([" ", "\t", "  "]).join(w)
        rows.append((k, text if k % 50 else None, ["en", "en", None, "und", "zz"][k % 5], "a"))
    return rows + [(1, "OF THE x of the X", "en", "a")] * 40


def test_all_lengths_and_ties(spark):
    rows = planted()
    plain = [(r[2], r[1]) for r in rows]
    assert found(collocations(frame(spark, rows), least=5)) == brute(plain, least=5)
    assert found(collocations(frame(spark, rows), least=5, top=7)) == brute(plain, least=5, top=7)


def test_small_budget_extends_prefixes(spark):
    rows = planted()
    want = brute([(r[2], r[1]) for r in rows], least=5)
    assert found(collocations(frame(spark, rows), least=5, budget=40)) == want


def test_very_long_texts_are_cut_where_pieces_end(spark):
    long = "ä b c d. e f! " * (SLICE // 5) + "x" * SLICE
    batch = pa.RecordBatch.from_arrays([pa.array([long, "short", None]), pa.array(["en", "de", "fr"])], ["text", "lang"])
    parts = [(t, l) for b in _texts(iter([batch])) for t, l in zip(*(c.to_pylist() for c in b.columns))]
    assert parts[-2:] == [("short", "de"), (None, "fr")]
    assert "".join(t for t, _ in parts[:-2]) == long and {l for _, l in parts[:-2]} == {"en"}
    assert len(parts) > 4 and all(t[-1] in ".!" for t, _ in parts[:-3])
    rows = [(1, long, "en", "a"), (2, "e f", "en", "a")]
    got = found(collocations(frame(spark, rows), least=5))
    assert got == brute([("en", long), ("en", "e f")], least=5)


def test_query_over_the_table(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").select("lang", "text").collect()
    assert found(op13_collocations(spark, SF)) == brute([tuple(d) for d in docs])
