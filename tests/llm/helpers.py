"""Awkward documents, and plain forms of what the operators compute."""

import re

from pyspark.sql import types as T

SF = "/root/testdata/sf0.001"
SCHEMA = T.StructType(
    [
        T.StructField("doc_id", T.LongType()),
        T.StructField("text", T.StringType()),
        T.StructField("lang", T.StringType()),
        T.StructField("source", T.StringType()),
        T.StructField("n_chars", T.LongType()),
        # names that operators use themselves
        *[
            T.StructField(name, T.StringType())
            for name in ("vertex", "key", "part", "score", "size", "ids", "root", "u", "v", "predicted")
        ],
    ]
)
LONG = " ".join(f"wort{i % 997}ß{i}" for i in range(30_000))
AWKWARD = [
    (1, "the cat sat on the mat and then the cat sat down again", "en", "a"),
    (2, "the cat sat on the mat and then the cat sat down again", "en", "a"),
    (2, "the cat sat on the mat and then the cat sat down again", "en", "a"),
    (3, None, None, None),
    (4, "", "en", "b"),
    (5, " \n\t ", "en", "b"),
    (6, "one", "en", "b"),
    (7, LONG, "de", "c"),
    (8, LONG + " tail", "de", "c"),
    (None, "a text without an id", None, "c"),
    (-9, "中文 and <|endoftext|> 😀 it's we'll ÉCOLE École x ▁ \x00", "zz", None),
    (10, "don't stop , \"quoted,\" end.", "en", "a"),
]


def frame(spark, rows=AWKWARD):
    extra = ("x",) * 10
    full = [(i, t, l, s, len(t or ""), *extra) for i, t, l, s in rows]
    return spark.createDataFrame(full, SCHEMA).repartition(3)


def words(text):
    return re.findall(r"[^\x20\x09-\x0D]+", text or "")


def shingles(text, length):
    fold = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    w = words((text or "").translate(fold))
    if 0 < len(w) < length:
        return {tuple(w)}
    return set(zip(*[w[k:] for k in range(length)]))


def groups(pairs, members):
    """Smallest member of each one's component."""
    root = {m: m for m in members}

    def find(x):
        while root[x] != x:
            root[x] = root[root[x]]
            x = root[x]
        return x

    for a, b in pairs:
        a, b = find(a), find(b)
        root[max(a, b)] = min(a, b)
    return {m: find(m) for m in members}


def near_pairs(sets, num, den):
    ids = sorted((i for i in sets if sets[i]), key=lambda i: len(sets[i]))
    for x, i in enumerate(ids):
        for j in ids[x + 1 :]:
            if den * len(sets[i]) < num * len(sets[j]):
                break
            both = len(sets[i] & sets[j])
            if den * both >= num * (len(sets[i]) + len(sets[j]) - both):
                yield i, j
