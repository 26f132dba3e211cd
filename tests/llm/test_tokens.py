"""Piece encoding, token counts and token files against the libraries."""

import random
import zlib

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
from tokenizers import Tokenizer

from ledgerline.llm import sentence_pieces, token_file
from ledgerline.llm.bpe_pairs import PairRule, merged
from ledgerline.llm.elias_fano import EliasFano
from ledgerline.llm.token_count import Counter, CountRule, count_tokens
from ledgerline.llm.token_file import read_token_file, token_file_digest, write_token_file

from helpers import AWKWARD, SF, frame

BITS = [
    " ", "  ", "    ", "a", "b", "e", "th", "in", "ing", "é", "ß", "中", "文", "\n", "\t", "<", "0", "41",
    "▁", "😀", "tion", "Ä", ".", ",", "###", "'", "'s", "'re", "'r", "'ll", "'l", "́", "\x00",
    "\xa0", "的", "<|endoftext|>", "²", "r", "v", "l", "s", "\x85", "\x1c",
]


def random_texts(n, longest=50):
    draw = random.Random(5)
    return ["".join(draw.choices(BITS, k=draw.randint(0, longest))) for _ in range(n)] + [
        "", " ", "  ", None, "a" * 3000, " " * 333 + "x", "\n" * 50, "▁▁x", "=" * 300,
    ]


@pytest.fixture(scope="module")
def pieces():
    import sentencepiece

    path = public_tokenizers.path("piece_bpe_32k.model")
    return (
        sentence_pieces.Encoder(sentence_pieces.PieceTable(path)),
        sentencepiece.SentencePieceProcessor(model_file=path),
    )


def test_pieces_equal_the_library(pieces):
    encoder, model = pieces
    texts = random_texts(1500)
    ids, bounds = encoder.encode(texts)
    for k, text in enumerate(texts):
        got = ids[bounds[k] : bounds[k + 1]]
        assert got.tolist() == model.encode(text or ""), text
        assert encoder.decode(got) == model.decode(got.tolist()), text


def test_decoding_of_any_ids(pieces):
    encoder, model = pieces
    draw = random.Random(3)
    for _ in range(300):
        ids = [draw.choice([draw.randrange(3, 259), draw.randrange(259, 32000)]) for _ in range(9)]
        assert encoder.decode(np.array(ids)) == model.decode(ids)


def test_pairs_stay_apart_exactly_when_merging_says_so():
    # a small vocabulary where symbols come and go while others merge
    texts = ["a", "b", "c", "ab", "bc", "abc", "ca", "cab", "aa", "aaaa"]
    ids = {t: i for i, t in enumerate(texts)}
    merges = {}
    for text in texts[3:]:
        for cut in range(1, len(text)):
            if text[:cut] in ids and text[cut:] in ids:
                merges[ids[text[:cut]], ids[text[cut:]]] = (ids[text], ids[text])
    rule = PairRule([[ids[c] for c in t] for t in texts], merges)
    whole = np.flatnonzero(rule.whole)
    a, b = (x.ravel() for x in np.meshgrid(whole, whole))
    for x, y, apart in zip(a.tolist(), b.tolist(), rule.apart(a, b).tolist()):
        rest, _ = merged([ids[c] for c in texts[x] + texts[y]], merges)
        assert apart == (rest == [x, y])


def test_encode_and_decode_frames(spark):
    path = public_tokenizers.path("piece_bpe_32k.model")
    rows = frame(spark).withColumnRenamed("ids", "other")
    out = sentence_pieces.encode(rows, path, keep=("doc_id", "source"), check=True)
    assert out.columns == ["doc_id", "source", "ids", "n_tokens", "restored"]
    got = sorted(out.collect(), key=lambda r: (r.doc_id is None, r.doc_id or 0))
    assert len(got) == len(AWKWARD)
    assert [r.doc_id for r in got if not r.restored] == [-9]  # the space mark
    back = sentence_pieces.decode(out, path)
    assert sorted(r.text for r in back.collect() if r.doc_id in (1, 2)) == [AWKWARD[0][1]] * 3
    empty = sentence_pieces.encode(rows.limit(0), path)
    assert empty.collect() == []


def test_counts_equal_the_library(spark):
    path = public_tokenizers.path("byte_bpe_50k.json")
    tokenizer, counter = Tokenizer.from_file(path), Counter(CountRule(path))
    texts = random_texts(2000)
    size, count = counter.count(texts)
    for k, text in enumerate(texts):
        assert count[k] == len(tokenizer.encode(text or "", add_special_tokens=False).ids), text
        assert size[k] == len((text or "").encode())
    # every character as letter, digit, white space or sign
    signs = [f"{chr(c)}a 1{chr(c)}1 {chr(c)}" for c in range(0, 0x3000)]
    _, count = counter.count(signs)
    assert count.tolist() == [len(e.ids) for e in tokenizer.encode_batch(signs, add_special_tokens=False)]


def test_counts_do_not_depend_on_what_was_compiled(monkeypatch):
    path = public_tokenizers.path("byte_bpe_50k.json")
    texts = random_texts(300)
    plain = Counter(CountRule(path)).count(texts)[1]
    monkeypatch.setattr(Counter, "MOST_STATES", 50)
    small = Counter(CountRule(path))
    assert [small.count([t])[1][0] for t in texts] == plain.tolist()


def test_count_frame(spark):
    path = public_tokenizers.path("byte_bpe_50k.json")
    out = count_tokens(frame(spark), path, limit=512)
    rows = {r.doc_id: r for r in out.collect()}
    assert out.columns == ["doc_id", "n_bytes", "n_tokens", "over_limit"] and out.count() == len(AWKWARD)
    assert (rows[3].n_tokens, rows[4].n_tokens, rows[7].over_limit, rows[1].over_limit) == (0, 0, True, False)
    assert count_tokens(frame(spark).limit(0), path).count() == 0


def test_other_files_are_refused():
    with pytest.raises(ValueError):
        CountRule(public_tokenizers.path("word_bpe_49k.json"))


@pytest.mark.parametrize(
    "values", [[], [0], [5], [0, 0, 0], [1, 5, 9, 200, 2**40], list(range(0, 5000, 3)), [7] * 1000]
)
def test_elias_fano(values):
    coded = EliasFano.of(np.array(values, np.uint64))
    assert coded.values().tolist() == values
    for i in range(0, len(values), max(1, len(values) // 50)):
        assert coded.select(i) == values[i]
    with pytest.raises(IndexError):
        coded.select(len(values))


def expected_file(rows, end_id=1):
    tokenizer = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    out, start = [], 0
    for doc, text in rows:
        ids = tokenizer.encode(text or "", add_special_tokens=False).ids + [end_id]
        out.append((doc, start, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())))
        start += len(ids)
    return out


def test_token_file_of_all_documents(spark):
    documents = spark.read.parquet(f"{SF}/documents.parquet")
    rows = sorted((r.doc_id, r.text) for r in documents.collect())
    got = token_file_digest(documents, public_tokenizers.path("word_bpe_49k.json"))
    assert sorted(tuple(r) for r in got.select("doc_id", "start", "n_tokens", "ids_crc32").collect()) == (
        expected_file(rows)
    )


def test_token_file_of_awkward_documents(spark, tmp_path):
    path = public_tokenizers.path("word_bpe_49k.json")
    more = [(100 + k, t, "en", "z") for k, t in enumerate(random_texts(120))]
    more.append((999, "ΟΔΟΣ Σ. İx <|STARTOFTEXT|> <|startoftext|>A, b", "el", "z"))
    write_token_file(frame(spark, AWKWARD + more), path, f"{tmp_path}/ids")
    got = read_token_file(spark, f"{tmp_path}/ids", with_ids=True).collect()
    got.sort(key=lambda r: r.start)
    order = sorted(AWKWARD + more, key=lambda r: (r[0] is not None, r[0] or 0))
    want = expected_file([(i, t) for i, t, _, _ in order])
    assert [(r.doc_id, r.start, r.n_tokens, r.ids_crc32) for r in got] == want
    assert all(len(r.ids) == r.n_tokens for r in got)
    write_token_file(frame(spark).limit(0), path, f"{tmp_path}/none")
    assert read_token_file(spark, f"{tmp_path}/none").count() == 0


def test_token_file_of_hot_ids(spark, tmp_path):
    path = public_tokenizers.path("word_bpe_49k.json")
    rows = [(None if k % 3 else 7, f"text {k} and more", "en", "a") for k in range(120)] + [(9, None, "en", "a")]
    documents = frame(spark, rows)
    write_token_file(documents, path, f"{tmp_path}/ids")
    got = sorted(tuple(r) for r in read_token_file(spark, f"{tmp_path}/ids").select("start", "n_tokens", "ids_crc32").collect())
    order = documents.selectExpr("doc_id", "text", "xxhash64(text) AS h").collect()
    order.sort(key=lambda r: (r.doc_id is not None, r.doc_id or 0, r.h))
    assert got == [r[1:] for r in expected_file([(r.doc_id, r.text) for r in order])]


def test_words_are_learnt_without_the_signs_behind_them(monkeypatch):
    path = public_tokenizers.path("word_bpe_49k.json")
    tokenizer = Tokenizer.from_file(path)
    encoder = token_file.WordEncoder(path)
    asked = []
    for name, listed in (("_letters", lambda w: [w]), ("_listed", list)):
        plain = getattr(encoder, name)
        monkeypatch.setattr(encoder, name, lambda x, f=plain, l=listed: asked.extend(l(x)) or f(x))
    texts = ["Haus haus*** übung. haus,", None, "übung haus!!\nHAUS %%% haus***", "", "haus. naïve' ,"]
    got = encoder.encode(pa.array(texts, pa.string()))
    assert sorted(asked) == sorted(["haus", "übung", "naïve", "***", ".", ",", "!!", "%%%", "'"])
    assert encoder.encode(pa.array(texts, pa.string())) == got and len(asked) == 9
    for text, ids in zip(texts, got):
        want = tokenizer.encode(text or "", add_special_tokens=False).ids
        assert np.frombuffer(ids, np.uint16).tolist() == want, text


def test_words_used_most_are_kept(monkeypatch):
    monkeypatch.setattr(token_file, "KNOWN_WORDS", 40)
    path = public_tokenizers.path("word_bpe_49k.json")
    tokenizer = Tokenizer.from_file(path)
    encoder = token_file.WordEncoder(path)
    odd = ["ab×cd. é÷, a\u0338=. =\u0338 don't. x's's, 'd. <|endoftext|>. É<|", "a.b. ÿ!a! ª. µ,", "T\u0308a W\u030a.", "J\u0327\u030c"]
    bits = [*random_texts(1500, 12), *odd]
    for k in range(0, len(bits), 100):
        texts = [f"{t or ''} the house, of the house." for t in bits[k : k + 100]] + [None]
        for text, ids in zip(texts, encoder.encode(pa.array(texts, pa.string()))):
            want = tokenizer.encode(text or "", add_special_tokens=False).ids
            assert np.frombuffer(ids, np.uint16).tolist() == want, text
        assert len(encoder.words) == len(encoder.ids) <= 40
    assert {b"the", b"house", b"of"} <= set(encoder.words.to_pylist())
