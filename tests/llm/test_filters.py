"""Quality, toxicity, pages, vectors and the mix."""

import time
import zlib

import duckdb
import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from ledgerline.llm.html_text import LABELLED, DecisionTree, extract_main_text, main_texts
from ledgerline.llm.labelled import labelled_sample
from ledgerline.llm.multi_index import MultiIndex, nearest_vectors, products
from ledgerline.llm.quality import classify_quality
from ledgerline.llm.source_mix import mix_sources
from ledgerline.llm.source_mix_sql import MIX_SQL
from ledgerline.llm.toxicity import ToxicityModel, classify_toxicity, maximal_segments
from ledgerline.llm.worktables import WorkTables

from helpers import AWKWARD, SF, frame, words

MIDDLE = "/root/testdata/sf0.01"


def held(doc_id):
    return zlib.crc32(str(doc_id).encode()) % 4 == 2


@pytest.mark.parametrize("classify,label,most", [(classify_quality, "quality", 0.03), (classify_toxicity, "toxic", 0.08)])
def test_held_out_accuracy(spark, classify, label, most):
    documents = spark.read.parquet(f"{MIDDLE}/documents.parquet")
    labels = spark.read.parquet(f"{MIDDLE}/labels.parquet")
    got = {r.doc_id: r for r in classify(documents, labels).collect()}
    assert len(got) == documents.count()
    assert all(r.held_out == held(d) and 0 <= r.score <= 1 for d, r in got.items())
    wrong = total = 0
    for r in labels.collect():
        if got[r.doc_id].held_out:
            total += 1
            wrong += got[r.doc_id].predicted != r[label]
    assert wrong <= most * total
    # labels of held-out rows make no difference
    turned = labels.withColumn(label, F.when(F.crc32(F.col("doc_id").cast("string")) % 4 == 2, 1 - F.col(label)).otherwise(F.col(label)))
    again = {r.doc_id: r.score for r in classify(documents, turned).collect()}
    assert again == {d: r.score for d, r in got.items()}


@pytest.mark.parametrize("classify,label", [(classify_quality, "quality"), (classify_toxicity, "toxic")])
def test_awkward_classification(spark, classify, label):
    rows = [(1, 1), (7, 0), (10, 0), (3, 1), (None, 1), (1, 1), (99, None)]
    labels = spark.createDataFrame(rows, f"doc_id long, {label} int")
    got = classify(frame(spark), labels).collect()
    assert len(got) == len(AWKWARD) and all(0 <= r.score <= 1 for r in got)
    assert len({r.score for r in got if r.doc_id == 2}) == 1
    none = labels.limit(0)
    assert {r.score for r in classify(frame(spark), none).collect()} == {0.5}
    assert classify(frame(spark).limit(0), labels).collect() == []
    one = labels.where(F.col(label) == 1)
    assert all(r.score > 0.5 for r in classify(frame(spark), one).collect())


def test_sample_of_labelled_texts(spark):
    # one banner before all texts; every second label is of a document that is not there
    banner = "This text is under a license that takes more than 64 characters to say so. "
    rows = [(k, f"{banner} text {k}", "en", "a") for k in range(0, 400, 2)]
    rows += [(k, banner + " the same", "en", "a") for k in range(1000, 1040)] + [(2000, None, "en", "a")]
    labels = spark.createDataFrame([(k, 1) for k in [*range(400), *range(1000, 1040), 2000]], "doc_id long, toxic int")
    learned = [k for k, t, _, _ in rows if t is not None and not held(k)]
    texts = {t for k, t, _, _ in rows if k in learned}
    for most, want in ((1000, texts), (60, None)):
        docs = frame(spark, rows if want else rows[:200])
        sample, sizes = labelled_sample(docs, labels, "toxic", {1: most}, WorkTables(spark, "t"))
        got = [r.text for r in sample.collect()]
        assert len(got) == len(set(got)) and set(got) <= texts
        if want:
            assert set(got) == want and sizes == {1: len(learned)}
        else:
            assert len(got) == most


def brute_segments(scores):
    """All maximal segments by their definition: the best segment, then left and right of it."""
    def best(a, b):
        top = (0.0, None)
        for i in range(a, b):
            total = 0.0
            for j in range(i, b):
                total += scores[j]
                if total > top[0] + 1e-12:
                    top = (total, (i, j))
        return top

    def split(a, b):
        if a >= b:
            return []
        value, at = best(a, b)
        if at is None:
            return []
        return split(a, at[0]) + [(value, *at)] + split(at[1] + 1, b)

    return split(0, len(scores))


def test_maximal_segments_by_definition():
    draw = np.random.default_rng(3)
    for _ in range(200):
        n = int(draw.integers(1, 25))
        positive = draw.random(n) < 0.4
        values = np.where(positive, draw.integers(1, 64, n) / 16 + draw.random(n) / 1000, -0.5)
        places = np.flatnonzero(positive)
        got = sorted(maximal_segments(places, values[places], 0.5), key=lambda s: s[1])
        want = brute_segments(values.tolist())
        assert [(i, j) for _, i, j in got] == [(i, j) for _, i, j in want]
        assert np.allclose([s for s, _, _ in got], [s for s, _, _ in want])


def test_no_features_no_evidence():
    model = ToxicityModel(np.zeros(0, np.uint64), np.zeros(0), 0.01, 1.0, 0.0, 1.0, -2.0)
    found, count = model.passages(pa.array(["a b", None, ""]))
    assert found == [[], [], []] and count.tolist() == [2, 0, 0]


PAGE = """<html><head><title>T</title><style>p{}</style></head><body>
<header><a href=x>Home</a> <a href=y>News</a></header>
<div class="cookie-notice">We use cookies on this long site to do all sorts of things for you.</div>
<nav><ul><li><a href="a>b">Menu</a></li></ul></nav>
<main><h1>Title &lt;x&gt; &amp;amp;</h1><p>Hello&nbsp;world this
is 3 < 4 text<br>more</p><!-- <p>hidden</p> -->
<div class="comments"><p>Nice one, a very long reader comment that goes on for a while and on.</p></div>
<aside>Side</aside><form>Name <input></form><p>End.</p></main>
<script>var a="<p>no</p>"</script><footer>&copy; me</footer></body></html>"""


def test_main_text_of_a_page():
    tree = DecisionTree(LABELLED)
    assert (tree.predict(LABELLED[:, :-1]) == LABELLED[:, -1]).all()
    assert main_texts([PAGE], tree) == ["Title <x> &amp;\n\nHello world this is 3 < 4 text more\n\nEnd."]
    assert main_texts([None, "", "<p>", "<script>x", "<", "<!--"], tree) == [""] * 6
    long = "<article>" + "<p>word word</p>" * 50_000
    assert main_texts([long], tree)[0].count("\n\n") == 49_999


TEXT = "A long enough sentence of the article that everyone came to this page to read today."
OTHER = "What a reader has to say about it, in a good many words that are not the article's."


@pytest.mark.parametrize(
    "page,want",
    [
        (f'<main class="overflow-hidden"><h1>Title</h1><p>{TEXT}</p></main>', ["Title", TEXT]),
        (f'<article data-x="hidden" class="x-hidden"><p>{TEXT}</p></article>', [TEXT]),
        (f"<main><p>{TEXT}</p><div hidden><p>{OTHER}</p></div></main>", [TEXT]),
        (f'<main><p>{TEXT}</p><div style="color:red; display: none"><p>{OTHER}</p></div></main>', [TEXT]),
        (f'<main><p>{TEXT}</p><div aria-hidden=true><p>{OTHER}</p></div></main>', [TEXT]),
        (f'<div class="content no-sidebar"><p>{TEXT}</p></div>', [TEXT]),
        (f'<div class="content sidebar-right"><p>{TEXT}</p></div>', [TEXT]),
        (f'<div class="post comments-open"><p>{TEXT}</p></div>', [TEXT]),
        (f'<article><header class="entry-header"><h1>Title</h1></header><p>{TEXT}</p></article>', ["Title", TEXT]),
        (f'<header class="entry-header"><h1>Title</h1></header><div class="content"><p>{TEXT}</p></div>', ["Title", TEXT]),
        (f'<main><div class="article-header"><h1>Title</h1></div><p>{TEXT}</p></main>', ["Title", TEXT]),
        (f'<div class="main-header"><p>{OTHER}</p></div><main><p>{TEXT}</p></main>', [TEXT]),
        (
            f'<main><p>{TEXT}</p></main><section id="comments"><article class="comment"><p>{OTHER}</p>'
            f'<div class="content"><p>{OTHER}</p></div></article></section>',
            [TEXT],
        ),
        (f'<main><p>{TEXT}</p><article class="comment"><p>{OTHER}</p></article></main>', [TEXT]),
        (f"<main><p>{TEXT}</p><aside><article><p>{OTHER}</p></article></aside></main>", [TEXT]),
        (f'<form id="page"><main><p>{TEXT}</p></main></form>', [TEXT]),
        *[
            (f"<main><p>{TEXT}</p></main>{around}", [TEXT])
            for around in (
                f'<div class="footer-content"><p>{OTHER}</p></div>',
                f'<div class="sidebar-content"><p>{OTHER}</p></div>',
                f'<footer><div class="content"><p>{OTHER}</p></div></footer>',
                f'<nav><div class="content"><p>{OTHER}</p></div></nav>',
                f'<form><div class="content"><p>{OTHER}</p></div></form>',
                f'<div class="cookie-notice"><div class="content"><p>{OTHER}</p></div></div>',
                f"<div hidden><article><p>{OTHER}</p></article></div>",
            )
        ],
        *[
            (f"<main><p>{TEXT}</p>{inner}<p>{TEXT}</p></main>", [TEXT, TEXT])
            for inner in (
                f'<p class="ad">{OTHER}</p>', f'<p class="ad">{OTHER}', f"<p hidden>{OTHER}</p>",
                f'<ul><li class="comment">{OTHER}</li></ul>', f'<blockquote class="promo">{OTHER}</blockquote>',
                f'<p><span style="display:none">{OTHER} <span>x</span></span></p>', f'<span class="ad">{OTHER}</span>',
                f'<h2 class="ads">{OTHER}</h2>',
            )
        ],
        (
            f'<table><tr><td class="sidebar"><p>{OTHER}</p></td><td class="content"><p>{TEXT}</p></td></tr></table>',
            [TEXT],
        ),
        (f'<table><tr><td class="sidebar">{OTHER}<td class="content">{TEXT}</table>', [TEXT]),
        (f"<form><p>{TEXT} {TEXT} {TEXT}</p><p>{TEXT} {TEXT}</p></form>", [f"{TEXT} {TEXT} {TEXT}", f"{TEXT} {TEXT}"]),
        ("<p>Short it is.</p><p>So is this one.</p><p>And the third here.</p>", ["Short it is.", "So is this one.", "And the third here."]),
        (f"<article><p>{TEXT}</p><p><a href=x>The whole report</a></p><p>{TEXT}</p></article>", [TEXT, "The whole report", TEXT]),
        (f'<main><ul><li>{TEXT}</li><li class="ad">{OTHER}<li>{TEXT}</ul><p>Be <span hidden>not</span> seen, said the one to the other.</p></main>',
         [TEXT, TEXT, "Be seen, said the one to the other."]),
    ],
)
def test_ordinary_class_names(page, want):
    assert main_texts([f"<html><body>{page}</body></html>"], DecisionTree(LABELLED)) == ["\n\n".join(want)]


def test_pages(spark):
    pages = spark.read.parquet(f"{SF}/pages.parquet")
    got = {r.page_id: r for r in extract_main_text(pages).collect()}
    source = {r.page_id: r for r in pages.collect()}
    assert got.keys() == source.keys()
    for key, row in got.items():
        assert row.url == source[key].url and row.n_chars == len(row.text)
        assert row.text and "</" not in row.text
        around = source[key].html.split("<article>")[0] + source[key].html.split("</article>")[1]
        notice = around.split('class="ad">')[1].split("<")[0]
        assert notice not in row.text.split("\n\n")
    odd = spark.createDataFrame(
        [(1, None, None, "x"), (1, "u", "", "x"), (None, "u", PAGE, "x"), (1, "u", "", "x")],
        "page_id long, url string, html string, text string",
    )
    rows = extract_main_text(odd).collect()
    assert sorted(r.n_chars for r in rows)[:3] == [0, 0, 0] and len(rows) == 4
    assert extract_main_text(odd.limit(0)).collect() == []


def test_recall_of_the_index(spark):
    rows = spark.read.parquet("/root/testdata/sf0.1/embeddings.parquet")
    local = rows.toPandas()
    vectors, ids = np.stack(local["embedding"]).astype(float), local["vec_id"].to_numpy()
    got = {}
    for r in nearest_vectors(rows, nearest=20).collect():
        got.setdefault(r.query_id, []).append((r["rank"], -r.score, r.vec_id))
    hits = total = 0
    for query in np.flatnonzero(ids % 20 == 0):
        exact = vectors @ vectors[query]
        exact[query] = -np.inf
        best = set(ids[np.argsort(-exact)[:20]].tolist())
        mine = sorted(got[ids[query]])
        assert [r[0] for r in mine] == list(range(1, 21))
        assert mine == sorted(mine, key=lambda r: (r[1], r[2]))
        for _, score, other in mine:
            assert abs(-score - exact[ids == other][0]) < 1e-12
        hits += len(best & {r[2] for r in mine})
        total += 20
    assert hits >= 0.9 * total


def test_awkward_vectors(spark):
    same = [1.0, 2.0, 0.5, 0.25]
    rows = [(k, same) for k in range(60)] + [
        (60, None), (80, [0.0] * 4), (100, [1.0, None, 1.0, 1.0]), (120, [float("nan"), 1.0, 1.0, 1.0]),
        (140, [float("inf"), 1.0, 1.0, 1.0]), (160, [1.0, 2.0]), (None, same), (180, [-1.0, 0.0, 0.0, 0.0]),
    ]
    table = spark.createDataFrame(rows, "vec_id long, embedding array<float>")
    got = {}
    for r in nearest_vectors(table, nearest=20).collect():
        got.setdefault(r.query_id, []).append(r)
    assert set(got) == {0, 20, 40, 180}
    # ties go to the smaller ids
    assert [r.vec_id for r in sorted(got[20], key=lambda r: r["rank"])] == [k for k in range(21) if k != 20]
    few = nearest_vectors(table.where("vec_id < 4"), nearest=20).collect()
    assert sorted((r.query_id, r["rank"], r.vec_id) for r in few) == [(0, 1, 1), (0, 2, 2), (0, 3, 3)]
    assert nearest_vectors(table.limit(0)).collect() == []
    assert nearest_vectors(table.where("vec_id >= 60 AND vec_id < 180")).collect() == []


@pytest.mark.parametrize("size", [3, 8, 15, 25])
def test_few_different_vectors(spark, size):
    draw = np.random.default_rng(size)
    rows = [(k, draw.normal(size=8).tolist()) for k in range(size)]
    # a second row of an id is no candidate for it either
    rows.append((0, draw.normal(size=8).tolist()))
    table = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    got = {}
    for r in nearest_vectors(table, F.lit(True), nearest=20).collect():
        got.setdefault(r.query_id, []).append(r)
    for k in range(1, size):
        exact = sorted(((-float(np.dot(v, rows[k][1])), i) for i, v in rows if i != k))[:20]
        mine = [r.vec_id for r in sorted(got[k], key=lambda r: r["rank"])]
        assert len(mine) == len(exact)
        if len(exact) < 20 or size <= 20:
            assert mine == [i for _, i in exact]
    # a small share does not lessen how many are returned
    few = nearest_vectors(table, F.lit(True), nearest=5, share=0.01).groupBy("query_id").count().collect()
    assert all(r["count"] >= min(5, size - 1) for r in few) and len(few) == size


def test_recall_beside_a_hot_cluster(spark):
    local = spark.read.parquet("/root/testdata/sf0.1/embeddings.parquet").limit(3000).toPandas()
    vectors = np.stack(local["embedding"]).astype(float)
    hot = np.arange(len(vectors)) % 2 == 1
    vectors[hot] = vectors[0]
    table = spark.createDataFrame(
        [(k, v.tolist()) for k, v in enumerate(vectors)], "vec_id long, embedding array<double>"
    )
    asked = list(range(20, len(vectors), 20))
    got = {}
    for r in nearest_vectors(table, nearest=20).collect():
        got.setdefault(r.query_id, set()).add(r.vec_id)
    hits = 0
    for k in asked:
        exact = vectors @ vectors[k]
        exact[k] = -np.inf
        hits += len(got[k] & set(np.argsort(-exact)[:20].tolist()))
    assert hits >= 0.93 * 20 * len(asked), hits / (20 * len(asked))


def sql_mix(rows):
    con = duckdb.connect()
    con.execute("CREATE TABLE documents (doc_id BIGINT, text VARCHAR, source VARCHAR)")
    con.executemany("INSERT INTO documents VALUES (?, ?, ?)", rows)
    return sorted(con.execute(MIX_SQL).fetchall(), key=repr)


def test_mix_equals_its_sql(spark):
    documents = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text", "source")
    got = mix_sources(documents).select("doc_id", "size", "source_size", "target", "taken").collect()
    assert sorted(map(tuple, got), key=repr) == sql_mix([tuple(r) for r in documents.collect()])


def test_mix_comes_near_its_targets(spark):
    documents = spark.read.parquet(f"{MIDDLE}/documents.parquet")
    by_source = {}
    for r in mix_sources(documents).collect():
        assert r.taken == r.size * r.copies <= 3 * r.size
        taken = by_source.setdefault(r.source, [0, r.target, 0])
        taken[0] += r.taken
        taken[2] += r.size
    for taken, target, size in by_source.values():
        assert target <= 3 * size and abs(taken - target) <= 0.04 * target
    assert abs(sum(t for _, t, _ in by_source.values()) - sum(s for _, _, s in by_source.values())) < 1e-3


def test_inclusion_odds_fall_with_size(spark):
    # 4,000 texts of 2 words, 4,000 of 38 and another source that gives the first a rate of a half
    rows = [(i, "a " * (2 if i % 2 else 38), "m") for i in range(8000)]
    rows += [(10_000 + i, "b " * 40, "n") for i in range(1000)]
    got = [r for r in mix_sources(spark.createDataFrame(rows, "doc_id long, text string, source string"), weights=(2, 5)).collect() if r.source == "m"]
    assert abs(sum(r.taken for r in got) - got[0].target) <= 38 and got[0].target < got[0].source_size
    odds = []
    for size in (2, 38):
        part = [r.copies for r in got if r.size == size]
        assert set(part) == {0, 1}
        odds.append(sum(part) / (len(part) - sum(part)))
    # inclusion odds go as 20 / (20 + size)
    assert abs(odds[0] / odds[1] / (58 / 22) - 1) < 0.15


def test_targets_of_many_sources(spark):
    rng = np.random.default_rng(7)
    rows = [
        (i, "w " * int(rng.integers(0, 30)), f"s{int(rng.integers(1, 60) ** 2) // 9:03d}" if i % 50 else None)
        for i in range(3000)
    ]
    rows += [(i, "w " * 9, "hot") for i in range(3000, 4500)]
    documents = spark.createDataFrame(rows, "doc_id long, text string, source string")
    got = mix_sources(documents).select("doc_id", "size", "source_size", "target", "taken").collect()
    assert sorted(map(tuple, got), key=repr) == sql_mix(rows)
    assert any(r.target == 3 * r.source_size for r in got)


def test_awkward_mix(spark):
    got = mix_sources(frame(spark)).collect()
    assert len(got) == len(AWKWARD)
    sizes = {(r.doc_id, r.size) for r in got}
    assert {(i, len(words(t))) for i, t, _, _ in AWKWARD} == sizes
    by_source = {}
    for r in got:
        by_source.setdefault(r.source, set()).add((r.source_size, r.target))
    assert all(len(v) == 1 for v in by_source.values()) and None in by_source
    # a source of one word cannot reach its share: its target stops at three times its size
    assert by_source["b"] == {(1, 3.0)}
    twice = [r.taken for r in got if r.doc_id == 2]
    assert twice[0] == twice[1]
    assert mix_sources(frame(spark).limit(0)).collect() == []
    empty = mix_sources(frame(spark, [(1, None, None, "a"), (2, "", None, "b")])).collect()
    assert {(r.target, r.taken) for r in empty} == {(0.0, 0)}


def test_many_isolated_hits_take_linear_time():
    places = np.arange(0, 20_000_000, 20)
    began = time.perf_counter()
    found = maximal_segments(places, np.full(len(places), 1.0), 0.5)
    assert time.perf_counter() - began < 30
    assert len(found) == len(places) and {s for s, _, _ in found} == {1.0}
    # every hit joins the one before
    joined = maximal_segments(np.arange(0, 300_000, 3), np.full(100_000, 5.0), 0.5)
    assert [(a, b) for _, a, b in joined] == [(0, 299_997)]


def test_only_walked_cells_are_multiplied():
    rng = np.random.default_rng(2)
    vectors, asked = rng.normal(size=(3000, 8)), rng.normal(size=(40, 8))
    index = MultiIndex(vectors[:500], 8)
    cells = index.cell_of(vectors)
    order = np.argsort(cells, kind="stable")
    cells, vectors = cells[order], vectors[order]
    counts = np.bincount(cells, minlength=index.cells)
    walked = [np.array(index.walk(q, counts, 600)) for q in asked]
    found, pairs = products(asked, walked, vectors, cells)
    assert pairs == sum(int(counts[w].sum()) for w in walked) < 0.35 * found.size
    for row, w, q in zip(found, walked, asked):
        inside = np.isin(cells, w)
        assert np.allclose(row[inside], vectors[inside] @ q) and np.isneginf(row[~inside]).all()
