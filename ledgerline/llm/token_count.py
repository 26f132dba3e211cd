"""Token counts of whole texts by compiled finite-state transducers.

The tokenizer file is compiled into two deterministic machines.

* The *splitter* reads character classes and annotates its transitions with "a word begins
  here" or "a word began one character ago". A batch of texts is cut into equal chunks; all
  chunks run side by side from every state, which gives each a map from entry to exit state.
  The maps compose associatively, so a parallel prefix scan gives the state at every chunk's
  start, and a second pass reads off the words. A chunk can begin anywhere, also inside a
  very long text.
* The *counter* reads the bytes of a word and annotates its transitions with the number of
  tokens emitted (negative where the next byte joins what had been apart). A state is what
  still matters of the word: for every place where a token could go on, the place in the
  vocabulary's prefix tree, the token that ended there and the count up to there. States and
  transitions are made when first met and kept in tables of fixed size; distinct words of a
  batch advance together.

Byte-level BPE files in the ``tokenizers`` format with the usual splitting pattern are
understood; anything else is refused rather than counted wrongly. Special strings inside a text
count as one token each, as the library has it by default.

Defined cases: a null text is empty, and an empty text has no tokens. Repeated rows stay
repeated. Columns other than ``text`` and those asked for are not looked at.
"""

from __future__ import annotations

import json
import unicodedata
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from ledgerline.llm.bpe_pairs import PairRule
from ledgerline.llm.textwords import slices, span_hashes

LETTER, DIGIT, SPACE, BLANK, OTHER, QUOTE, END = range(7)
# the letters of the contractions 's 't 'm 'd 're 've 'll are classes of their own
TAIL, R, V, L, E = range(7, 12)
CLASSES = 12
CHUNK = 256
STATES = 11


def _splitter() -> tuple[np.ndarray, np.ndarray]:
    """Next state and marks (1: a word begins here, 2: one began a character ago)."""
    (begin, letters, digits, others, quote, quote_r, quote_v, quote_l, closed, space, blank) = range(STATES)
    go = np.zeros((STATES, CLASSES), np.int8)
    mark = np.zeros((STATES, CLASSES), np.int8)
    word = {LETTER: letters, TAIL: letters, R: letters, V: letters, L: letters, E: letters, DIGIT: digits, OTHER: others}
    for state in range(STATES):
        for c in range(CLASSES):
            run = word.get(c, others)
            here = 1
            if c == END:
                go[state, c] = begin
                # a quote with one more letter of no contraction
                mark[state, c] = 2 if state in (quote_r, quote_v, quote_l) else 0
                continue
            if c == QUOTE:
                run = quote
            if c in (SPACE, BLANK):
                run = space if c == SPACE else blank
            if state in (space, blank):
                # where white space ends is seen to by ``whitespace_splits``
                if c in (SPACE, BLANK):
                    go[state, c] = run
                    continue
                if state == space and c == QUOTE:
                    run = others
            go[state, c], mark[state, c] = run, here
            if state == letters and run == letters:
                mark[state, c] = 0
            if state == digits and run == digits:
                mark[state, c] = 0
            if state == others and c in (OTHER, QUOTE):
                go[state, c], mark[state, c] = others, 0
            if state == quote:
                if c in (OTHER, QUOTE):
                    go[state, c], mark[state, c] = others, 0
                elif c == TAIL:
                    go[state, c], mark[state, c] = closed, 0
                elif c in (R, V, L):
                    # perhaps a contraction: undecided until the next character
                    go[state, c], mark[state, c] = {R: quote_r, V: quote_v, L: quote_l}[c], 0
            if state in (quote_r, quote_v, quote_l):
                if (state, c) in ((quote_r, E), (quote_v, E), (quote_l, L)):
                    go[state, c], mark[state, c] = closed, 0
                elif run == letters:
                    go[state, c], mark[state, c] = letters, 2
                else:
                    mark[state, c] = 3
    return go, mark


GO, MARK = _splitter()


def character_classes() -> np.ndarray:
    """The class of every code point."""
    names = np.full(0x110000, OTHER, np.int8)
    for c in range(0x110000):
        kind = unicodedata.category(chr(c))[0]
        if kind == "L":
            names[c] = LETTER
        elif kind == "N":
            names[c] = DIGIT
    # white space as the splitting pattern has it
    blanks = [*range(0x09, 0x0E), 0x85, 0xA0, 0x1680, *range(0x2000, 0x200B), 0x2028, 0x2029, 0x202F, 0x205F, 0x3000]
    names[blanks] = BLANK
    names[0x20] = SPACE
    names[ord("'")] = QUOTE
    names[[ord(c) for c in "stmd"]] = TAIL
    for c, name in zip("rvle", (R, V, L, E)):
        names[ord(c)] = name
    return names


def split_marks(classes: np.ndarray) -> np.ndarray:
    """True where a word begins, over classes of texts that each close with END."""
    n = len(classes)
    rows = -(-n // CHUNK)
    grid = np.full(rows * CHUNK, END, np.int8)
    grid[:n] = classes
    grid = grid.reshape(rows, CHUNK).T.copy()
    flat_go, flat_mark = GO.astype(np.intp).ravel(), MARK.ravel()
    maps = np.repeat(np.arange(STATES)[None, :], rows, axis=0)
    for column in grid:
        maps = flat_go[maps * CLASSES + column[:, None]]
    # inclusive prefix scan of the maps; ahead[i] becomes all chunks up to i
    ahead, gap = maps, 1
    while gap < rows:
        later = ahead.copy()
        later[gap:] = np.take_along_axis(ahead[gap:], ahead[:-gap], axis=1)
        ahead, gap = later, gap * 2
    state = np.zeros(rows, np.intp)
    state[1:] = ahead[:-1, 0]
    marks = np.empty((CHUNK, rows), np.int8)
    for k, column in enumerate(grid):
        at = state * CLASSES + column
        marks[k] = flat_mark[at]
        state = flat_go[at]
    marks = marks.T.ravel()
    begins = (marks & 1).astype(bool)
    begins[:-1] |= (marks[1:] & 2).astype(bool)
    return begins[:n]


def whitespace_splits(classes: np.ndarray, begins: np.ndarray) -> np.ndarray:
    """Moves word beginnings at the end of white space, where the next character decides.

    The machine marks the first character of a run and what follows it. A run that something
    follows gives its last character away: to the next word if it is a space and a run of
    letters, digits or other signs follows, or to a word of its own.
    """
    is_blank = (classes == SPACE) | (classes == BLANK)
    follows = np.zeros(len(classes), bool)
    follows[1:] = is_blank[:-1] & ~is_blank[1:] & (classes[1:] != END)
    at = np.flatnonzero(follows)
    begins[at - 1] = True
    begins[at[classes[at - 1] == SPACE]] = False
    return begins


class CountRule:
    """Vocabulary prefix tree and pair rule of a byte-level BPE file."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as file:
            spec = json.load(file)
        model, before = spec["model"], spec["pre_tokenizer"] or {}
        understood = (
            model["type"] == "BPE"
            and spec["normalizer"] is None
            and before.get("type") == "ByteLevel"
            and before.get("use_regex", True)
            and not before.get("add_prefix_space")
            and not any(model.get(k) for k in ("dropout", "continuing_subword_prefix", "end_of_word_suffix", "ignore_merges", "byte_fallback"))
        )
        if not understood:
            raise ValueError(f"{path} is not a plain byte-level BPE file")
        if max(model["vocab"].values()) >= 1 << 17 or max(map(len, model["vocab"])) > 128:
            raise ValueError("the vocabulary is too large for packed states")
        self.special = [t["content"] for t in spec["added_tokens"]]
        if any(t.get("lstrip") or t.get("rstrip") or t.get("single_word") for t in spec["added_tokens"]):
            raise ValueError("special strings that take white space along")
        vocab = model["vocab"]
        merges = {}
        for rank, pair in enumerate(model["merges"]):
            a, b = pair.split(" ") if isinstance(pair, str) else pair
            merges[vocab[a], vocab[b]] = (rank, vocab[a + b])
        letters = self._byte_letters()
        spelling: list[list[int] | None] = [None] * (max(vocab.values()) + 1)
        for token, i in vocab.items():
            if token not in self.special:
                spelling[i] = [vocab[c] for c in token]
        self.rule = PairRule(spelling, merges)
        if any(c not in vocab for c in letters):
            raise ValueError("a byte has no token")
        byte_of = {vocab[c]: b for b, c in enumerate(letters)}
        # prefix tree: child of (node, byte), and the token that ends at a node
        child, token_at = {}, [-1]
        for i, symbols in enumerate(spelling):
            if symbols is None:
                continue
            node = 0
            for symbol in symbols:
                step = node << 8 | byte_of[symbol]
                if step not in child:
                    child[step] = len(token_at)
                    token_at.append(-1)
                node = child[step]
            if self.rule.whole[i]:
                token_at[node] = i
        self.steps = np.array(sorted(child), np.int64)
        self.nodes = np.array([child[s] for s in self.steps.tolist()], np.int64)
        self.token_at = np.array(token_at, np.int64)

    @staticmethod
    def _byte_letters() -> list[str]:
        """The printable character that stands for each byte in such files."""
        shown = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
        rest = iter(range(0x100, 0x200))
        return [chr(b) if b in shown else chr(next(rest)) for b in range(256)]


class Counter:
    """The counting transducer, compiled as it is used; tables have a fixed size."""

    BITS = 22
    MOST_STATES = 400_000

    def __init__(self, rule: CountRule):
        self.rule = rule
        self.child = dict(zip(rule.steps.tolist(), rule.nodes.tolist()))
        self.token_at = rule.token_at.tolist()
        self.inner = set((rule.steps >> 8).tolist())  # nodes that go on
        self.pairs: dict[int, bool] = {}
        self.classes = character_classes()
        self._clear()

    def _clear(self) -> None:
        size = 1 << self.BITS
        self.key = np.full(size, -1, np.int64)
        self.next = np.zeros(size, np.int32)
        self.emits = np.zeros(size, np.int8)
        self.used = 0
        # what is live: prefix tree node, last token + 1, tokens up to there less tokens now
        # plus 128, in one number each
        start = (128,)
        self.states = [start]
        self.number = {start: 0}

    def _apart(self, asked: list[tuple[int, int]]) -> None:
        tokens = self.rule.rule.tokens
        new = list({a * tokens + b for a, b in asked} - self.pairs.keys())
        if new:
            if len(self.pairs) > 2_000_000:
                self.pairs.clear()
                new = list({a * tokens + b for a, b in asked})
            code = np.array(new, np.int64)
            self.pairs.update(zip(new, self.rule.rule.apart(code // tokens, code % tokens).tolist()))

    def _compile(self, steps: np.ndarray) -> None:
        """Adds the transitions ``state << 8 | byte``."""
        tokens, child, token_at = self.rule.rule.tokens, self.child, self.token_at
        moved = []
        for step in steps.tolist():
            byte = step & 255
            moved.append([
                (node, (live >> 8 & 0x1FFFF) - 1, (live & 255) - 128)
                for live in self.states[step >> 8]
                if (node := child.get(live >> 25 << 8 | byte)) is not None
            ])
        self._apart([
            (last, token_at[node])
            for row in moved for node, last, _ in row
            if last >= 0 and token_at[node] >= 0
        ])
        for step, row in zip(steps.tolist(), moved):
            end = next(
                (token_at[node], count + 1)
                for node, last, count in row
                if token_at[node] >= 0 and (last < 0 or self.pairs[last * tokens + token_at[node]])
            )
            # counts are kept relative to the newest place, which makes states few
            state = (
                *(
                    (node << 17 | last + 1) << 8 | count - end[1] + 128
                    for node, last, count in row
                    if node in self.inner
                ),
                end[0] + 1 << 8 | 128,
            )
            number = self.number.setdefault(state, len(self.states))
            if number == len(self.states):
                self.states.append(state)
            slot = self._slot(step)
            while self.key[slot] >= 0:
                slot = (slot + 1) & ((1 << self.BITS) - 1)
            self.key[slot], self.next[slot], self.emits[slot] = step, number, end[1]
        self.used += len(steps)

    def _slot(self, steps):
        if isinstance(steps, int):
            return (steps * 0x9E3779B97F4A7C15 & ((1 << 64) - 1)) >> (64 - self.BITS)
        return (steps.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15) >> np.uint64(64 - self.BITS)).astype(np.int64)

    def _find(self, steps: np.ndarray) -> np.ndarray:
        """Table place of every transition, -1 for one not compiled yet."""
        slot = self._slot(steps)
        got = self.key[slot]
        open_rows = np.flatnonzero((got != steps) & (got >= 0))
        while len(open_rows):
            slot[open_rows] = (slot[open_rows] + 1) & ((1 << self.BITS) - 1)
            got[open_rows] = self.key[slot[open_rows]]
            open_rows = open_rows[(got[open_rows] != steps[open_rows]) & (got[open_rows] >= 0)]
        return np.where(got == steps, slot, -1)

    def words(self, raw: np.ndarray, starts: np.ndarray, sizes: np.ndarray) -> np.ndarray:
        """Tokens of each byte span."""
        if len(self.states) > self.MOST_STATES or self.used > (1 << self.BITS) // 2:
            self._clear()
        order = np.argsort(-sizes, kind="stable")
        starts, sizes = starts[order], sizes[order]
        state = np.zeros(len(starts), np.int64)
        count = np.zeros(len(starts), np.int64)
        still = np.searchsorted(-sizes, -np.arange(int(sizes[0]) if len(sizes) else 0), "left")
        for k, n in enumerate(still.tolist()):
            step = state[:n] << 8 | raw[starts[:n] + k]
            at = self._find(step)
            if (at < 0).any():
                self._compile(np.unique(step[at < 0]))
                at = self._find(step)
            count[:n] += self.emits[at]
            state[:n] = self.next[at]
        out = np.empty(len(starts), np.int64)
        out[order] = count
        return out

    def count(self, texts: list[str | None]) -> tuple[np.ndarray, np.ndarray]:
        """UTF-8 bytes and tokens of each text."""
        texts = [t or "" for t in texts]
        pieces, owner = texts, np.arange(len(texts))
        extra = np.zeros(len(texts), np.int64)
        for special in self.rule.special:
            if any(special in p for p in pieces):
                cut = [p.split(special) for p in pieces]
                sizes = np.array([len(c) for c in cut])
                extra += np.bincount(owner, sizes - 1, len(texts)).astype(np.int64)
                pieces, owner = [p for c in cut for p in c], np.repeat(owner, sizes)
        lengths = np.array([len(p) for p in pieces], np.int64)
        chars = np.frombuffer("".join(pieces).encode("utf-32-le"), np.uint32)
        ends = np.cumsum(lengths + 1) - 1
        classes = np.full(len(chars) + len(pieces), END, np.int8)
        inside = np.ones(len(classes), bool)
        inside[ends] = False
        classes[inside] = self.classes[chars]
        begins = whitespace_splits(classes, split_marks(classes))[inside]
        raw = np.frombuffer("".join(pieces).encode("utf-8"), np.uint8)
        leads = np.flatnonzero((raw & 0xC0) != 0x80)
        starts = leads[begins]
        sizes = np.diff(np.append(starts, len(raw)))
        keys = span_hashes(raw, starts, starts + sizes)
        _, first, word = np.unique(keys, return_index=True, return_inverse=True)
        tokens = self.words(raw, starts[first], sizes[first])[word]
        bytes_before = np.searchsorted(leads, starts)  # characters before each word
        holder = owner[np.searchsorted(np.cumsum(lengths), bytes_before, "right")]
        total = np.bincount(holder, tokens, len(texts)).astype(np.int64) + extra
        return np.array([len(t.encode()) for t in texts], np.int64), total


_COUNTERS: dict[int, Counter] = {}


def count_tokens(
    documents: DataFrame, path: str, limit: int = 512, keep: tuple[str, ...] = ("doc_id",)
) -> DataFrame:
    """The columns ``keep`` with n_bytes, n_tokens and over_limit of ``text``."""
    # bounded by the vocabulary of the tokenizer, a few MB
    shared = documents.sparkSession.sparkContext.broadcast(CountRule(path))
    keep = list(keep)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rule = shared.value
        if id(rule) not in _COUNTERS:
            _COUNTERS.clear()
            _COUNTERS[id(rule)] = Counter(rule)
        for batch in slices(batches, "text"):
            n_bytes, n_tokens = _COUNTERS[id(rule)].count(batch.column("text").to_pylist())
            yield pa.RecordBatch.from_arrays(
                [
                    *(batch.column(c) for c in keep),
                    pa.array(n_bytes),
                    pa.array(n_tokens),
                    pa.array(n_tokens > limit),
                ],
                [*keep, "n_bytes", "n_tokens", "over_limit"],
            )

    rows = documents.select(*keep, *(["text"] if "text" not in keep else []))
    kept = [f"`{f.name}` {f.dataType.simpleString()}" for f in rows.schema if f.name in keep]
    return rows.mapInArrow(run, ", ".join([*kept, "n_bytes long, n_tokens long, over_limit boolean"]))
