"""Token counts by a compiled finite-state transducer.

The byte-pair encoder of a word is run as a deterministic transducer over its symbols.  A
state holds what later symbols can depend on: the longest suffix that still begins a token,
and at each place in it the last token of the encoding up to there.  A transition emits the
change of the token count.  Transitions are compiled when first met, so only the part of the
machine that texts reach exists.

White space brings the scan back to its start state, so the state map of a chunk of text is
known without what precedes it: how its head completes an open word, the count between, and
the word it leaves open.  Maps compose associatively; long texts are scanned chunk by chunk
and composed as a balanced tree.  A very long word is cut the same way: each block's map is
computed from the state that the symbols before the block lead to, and composition checks
that the entry state was right (else the block is run again from the true one).
"""

from __future__ import annotations

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quarry.llm.bpe import PieceCache, Vocabulary, WordBpe
from quarry.llm.shared import map_text, text_of

CHUNK_BYTES = 64 << 10
#: Symbols of a word in a block, and how many before it are run to find its entry state.
BLOCK, LEAD = 512, 64
#: Bounds on what a worker keeps: compiled states, pairs of tokens looked at.
MAX_STATES, MAX_PAIRS = 50_000, 200_000


class Transducer:
    """A state is (tail, history): history[i] is (last token, count relative to now) of the
    encoding before tail[i:], or None where no token can begin.  Compiled states are known by
    number; beyond ``MAX_STATES`` the machine goes on with states that are not stored."""

    def __init__(self, bpe: WordBpe):
        self.bpe = bpe
        self.plain = {t for t in bpe.ids if not t.endswith(bpe.end)}
        self.final = {t for t in bpe.ids if t.endswith(bpe.end)}
        self.prefixes = {t[:k] for t in self.plain for k in range(1, len(t) + 1)} | {""}
        self.prefixes |= {t[:k] for t in self.final for k in range(1, len(t) - len(bpe.end) + 1)}
        self._pairs: dict[tuple[str, str], bool] = {}
        self._own: dict[str, bool] = {}
        self.states: list[tuple] = [("", (("", 0),))]  # number 0: the start of a word
        self.index = {self.states[0]: 0}
        self.steps: dict[tuple[int, str], tuple[int, int]] = {}

    def _fits(self, before: str, token: str) -> bool:
        own = self._own.get(token)
        if own is None:  # a token that is not its own encoding never occurs
            own = self._own[token] = self.bpe.merge(self.bpe.split_token(token)) == [token]
        if not own or not before:
            return own
        known = self._pairs.get((before, token))
        if known is None:
            if len(self._pairs) >= MAX_PAIRS:
                self._pairs.clear()
            known = self._pairs[before, token] = self.bpe.compatible(before, token)
        return known

    def _last(self, state: tuple, symbol: str, tokens: set[str]) -> tuple[str, int]:
        """The last token of the encoding after ``symbol``, and the change of the count."""
        tail, history = state
        string = tail + symbol
        for i, h in enumerate(history):
            if h is not None and (token := string[i:]) in tokens and self._fits(h[0], token):
                return token, h[1] + 1
        raise ValueError(f"{symbol!r} is not in the vocabulary")

    def step(self, state: int | tuple, symbol: str) -> tuple[int | tuple, int]:
        """The state after ``symbol`` and the change of the token count."""
        tail, history = self.states[state] if isinstance(state, int) else state
        token, delta = self._last((tail, history), symbol, self.plain)
        tail += symbol
        moved, kept = [], None
        for i, h in enumerate((*history, (token, delta))):
            live = (i == len(tail) or h is not None) and tail[i:] in self.prefixes
            if live and kept is None:
                kept = i
            if kept is not None:
                moved.append((h[0], h[1] - delta) if live else None)
        new = (tail[kept:], tuple(moved))
        at = self.index.get(new)
        if at is None:
            if len(self.states) >= MAX_STATES:
                return new, delta
            at = self.index[new] = len(self.states)
            self.states.append(new)
        if isinstance(state, int):
            self.steps[state, symbol] = (at, delta)
        return at, delta

    def end(self, state: int | tuple, symbol: str) -> int:
        return self._last(self.states[state] if isinstance(state, int) else state, symbol + self.bpe.end, self.final)[1]

    def run(self, state: int | tuple, symbols: str) -> tuple[int | tuple, int]:
        count, compiled = 0, self.steps.get
        for s in symbols:
            state, delta = compiled((state, s)) or self.step(state, s)
            count += delta
        return state, count

    def count(self, word: str) -> int:
        """Tokens of a word in the byte alphabet."""
        if len(word) <= BLOCK + LEAD:
            state, count = self.run(0, word[:-1])
        else:
            state, count = self.scan(word[:-1])
        return count + self.end(state, word[-1])

    def scan(self, word: str) -> tuple[int, int]:
        """A long word by blocks: every block's map from a guessed entry state, then composition."""
        blocks = [word[i : i + BLOCK] for i in range(0, len(word), BLOCK)]
        guesses = [0] + [self.run(0, word[i * BLOCK - LEAD : i * BLOCK])[0] for i in range(1, len(blocks))]
        maps = [{g: self.run(g, b)} for g, b in zip(guesses, blocks, strict=True)]
        state = count = 0
        for block, known in zip(blocks, maps, strict=True):
            if state not in known:
                known[state] = self.run(state, block)
            state, more = known[state]
            count += more
        return state, count


def compose(left: tuple, right: tuple, tokens_of) -> tuple:
    """State maps of neighbouring chunks: (head, count, tail), or (piece, None, None) for a
    chunk without white space."""
    if left[1] is None:
        return (left[0] + right[0], None, None) if right[1] is None else (left[0] + right[0], right[1], right[2])
    if right[1] is None:
        return left[0], left[1], left[2] + right[0]
    return left[0], left[1] + tokens_of(left[2] + right[0]) + right[1], right[2]


class Counter:
    """Counts the tokens of whole texts; lives as long as the Python worker."""

    def __init__(self, spec: str):
        self.bpe = WordBpe(spec)
        self.machine = Transducer(self.bpe)
        self.cache, self.words = PieceCache(), PieceCache()

    def of_piece(self, piece: bytes) -> int:
        n = self.cache.get(piece)
        if n is None:
            n = self.cache.old.get(piece)
        if n is None:
            n = sum(1 if isinstance(w, int) else self.of_word(w) for w in self.bpe.words(piece)) if piece else 0
        if len(piece) <= 256:
            self.cache.make_room(1)
            self.cache[piece] = n
        return n

    def of_word(self, word: str) -> int:
        n = self.words.get(word)
        if n is None:
            n = self.words.old.get(word)
        if n is None:
            n = self.machine.count(word)
        if len(word) <= 256:
            self.words.make_room(1)
            self.words[word] = n
        return n

    def of_pieces(self, pieces: list[bytes]) -> int:
        known = self.cache.get
        return sum(n if (n := known(p)) is not None else self.of_piece(p) for p in pieces)

    def state_map(self, chunk: bytes) -> tuple:
        pieces = chunk.split()
        if not pieces:
            return b"", 0, b""
        head = b"" if chunk[:1].isspace() else pieces.pop(0)
        if not pieces and head and not chunk[-1:].isspace():
            return head, None, None
        tail = b"" if chunk[-1:].isspace() or not pieces else pieces.pop()
        return head, self.of_pieces(pieces), tail

    def of_text(self, text: bytes) -> int:
        if len(text) <= CHUNK_BYTES:
            return self.of_pieces(text.split())
        maps = [self.state_map(text[i : i + CHUNK_BYTES]) for i in range(0, len(text), CHUNK_BYTES)]
        while len(maps) > 1:  # a balanced tree: neighbours compose pairwise
            maps = [compose(*maps[i : i + 2], self.of_piece) if i + 1 < len(maps) else maps[i] for i in range(0, len(maps), 2)]
        head, count, tail = maps[0]
        return self.of_piece(head) if count is None else self.of_piece(head) + count + self.of_piece(tail)


def token_counts(docs: DataFrame, vocabulary_path: str, limit: int = 2048) -> DataFrame:
    """One row per row of ``docs`` (doc_id, text): doc_id, n_bytes (UTF-8), n_tokens, over_limit.

    Counts are those of the ``tokenizers`` library without added special tokens; special
    strings inside a text count as the library counts them.  Null counts as empty (0
    tokens); repeated rows give repeated rows; other columns are ignored; texts of any
    length are counted whole."""
    spec = Vocabulary(docs.sparkSession, vocabulary_path)

    def count(batch: pa.RecordBatch) -> pa.RecordBatch:
        counter = spec.kept(Counter)
        texts = batch.column("text").cast(pa.binary()).to_pylist()
        return pa.RecordBatch.from_arrays(
            [batch.column("doc_id"), pa.array([len(t) for t in texts], pa.int64()), pa.array(map(counter.of_text, texts), pa.int64())],
            ["doc_id", "n_bytes", "n_tokens"],
        )

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), text_of().alias("text"))
    counted = map_text(rows, "doc_id long, n_bytes long, n_tokens long", count)
    return counted.withColumn("over_limit", F.col("n_tokens") > limit)
