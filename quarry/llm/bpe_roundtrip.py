"""Byte-pair encoding and decoding by speculating and verifying.

Greedy longest match proposes the tokens of every new word of a slice.  A sequence of tokens is
the exact encoding if every adjacent pair of it is compatible, so the distinct pairs are
looked up as one sorted array, and only words with a failing pair are merged exactly, those of
like length together: every round merges one pair in each of them.
"""

from __future__ import annotations

import hashlib
import re
from array import array
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quarry.llm.bpe import BYTE_ALPHABET, SIMPLE, SIMPLE_WORDS, PieceCache, Vocabulary, WordBpe
from quarry.llm.shared import map_text, text_of


NO_MERGE = 1 << 40
#: The words of simple pieces, one a line.
LINE_WORDS = re.compile("\n|" + SIMPLE_WORDS.pattern.replace("[^", "[^\n"))
#: Longer words are merged each for itself, by a heap.
MOST_SYMBOLS = 48


class Speculator:
    """Encodes slices of texts; lives as long as the Python worker."""

    def __init__(self, spec: str):
        self.bpe = WordBpe(spec)
        if self.bpe.strings.keys() - range(1 << 21):
            raise ValueError("ids below 2**21 are expected")
        #: beginnings of tokens as nested dictionaries; under "" the token that ends there
        self.starts: dict = {}
        for token, i in self.bpe.ids.items():
            at = self.starts
            for c in token:
                at = at.setdefault(c, {})
            at[""] = i
        ids = self.bpe.ids
        made = [(ids[a] << 21 | ids[b], rank, ids[a + b]) for (a, b), rank in self.bpe.ranks.items()]
        #: mergeable pairs as sorted keys, with their ranks and results
        self.merge_keys, self.merge_ranks, self.merge_made = np.array(sorted(made), np.int64).reshape(-1, 3).T.copy()
        #: ids of the symbols by code point, inside a word and at its end (-1: none)
        widest = max(map(ord, BYTE_ALPHABET.values()))
        self.inner_symbols, self.last_symbols = (
            np.array([ids.get(chr(c) + end, -1) for c in range(widest + 1)], np.int64) for end in ("", self.bpe.end)
        )
        #: the byte alphabet by byte; 0 stands between words
        self.spelling = np.array([0, *(ord(BYTE_ALPHABET[b]) for b in range(1, 256))], "<u4")
        #: verified pairs as sorted keys, and whether each is compatible
        self.pair_keys, self.pair_fits = np.empty(0, np.int64), np.empty(0, bool)
        self.whole: dict[int, bool] = {}
        self.pieces, self.words = PieceCache(), PieceCache()
        self.most_pairs = 1_000_000
        self.empty_pieces = False
        self.exact_words = self.proposed_words = 0

    def propose(self, word: str) -> list[int]:
        """Greedy longest match; the last token carries the word end."""
        ids, starts, out, at, n = self.bpe.ids, self.starts, [], 0, len(word)
        end = word + self.bpe.end
        while at < n:
            token, stop, here = None, at, starts
            for reach in range(at, n):
                here = here.get(word[reach])
                if here is None:
                    break
                if reach + 1 < n and "" in here:
                    token, stop = here[""], reach + 1
            else:
                if (found := ids.get(end[at:])) is not None:
                    token, stop = found, n
            if token is None:
                raise ValueError(f"{word[at]!r} is not in the vocabulary")
            out.append(token)
            at = stop
        return out

    def _fits(self, keys: np.ndarray) -> np.ndarray:
        """Compatibility of token pairs given as a << 21 | b; new distinct pairs are checked once."""
        distinct, back = np.unique(keys, return_inverse=True)
        at = np.searchsorted(self.pair_keys, distinct)
        at_safe = np.minimum(at, max(len(self.pair_keys) - 1, 0))
        known = self.pair_keys[at_safe] == distinct if len(self.pair_keys) else np.zeros(len(distinct), bool)
        fits = np.zeros(len(distinct), bool)
        fits[known] = self.pair_fits[at_safe[known]]
        new = np.flatnonzero(~known)
        if len(new):
            s, mask = self.bpe.strings, (1 << 21) - 1
            fits[new] = [
                self._is_whole(k >> 21) and self._is_whole(k & mask) and self.bpe.compatible(s[k >> 21], s[k & mask])
                for k in distinct[new].tolist()
            ]
            if len(self.pair_keys) + len(new) > self.most_pairs:
                self.pair_keys, self.pair_fits = distinct, fits
            else:
                keys = np.concatenate([self.pair_keys, distinct[new]])
                order = np.argsort(keys)
                self.pair_keys, self.pair_fits = keys[order], np.concatenate([self.pair_fits, fits[new]])[order]
        return fits[back]

    def _is_whole(self, token: int) -> bool:
        """A token that is its own encoding (one that is not never occurs)."""
        known = self.whole.get(token)
        if known is None:
            s = self.bpe.strings[token]
            known = self.whole[token] = self.bpe.merge(self.bpe.split_token(s)) == [s]
        return known

    def _merges(self, left: np.ndarray, right: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Rank and result of merging neighbours; pairs that do not merge (-1 stands for no symbol) rank last."""
        keys = left << 21 | right
        at = np.minimum(np.searchsorted(self.merge_keys, keys), len(self.merge_keys) - 1)
        found = (self.merge_keys[at] == keys) & (left >= 0) & (right >= 0)
        return np.where(found, self.merge_ranks[at], NO_MERGE), self.merge_made[at]

    def merge_exactly(self, words: list[str]) -> list[list[int]]:
        """The exact encoding: the pair of lowest rank first, the leftmost of equals; in each round one merge in every
        word.  Words of more than ``MOST_SYMBOLS`` are merged one by one."""
        out: list[list[int]] = [[] for _ in words]
        lengths = np.fromiter(map(len, words), np.int64, len(words))
        starts = np.cumsum(lengths) - lengths
        codes = np.frombuffer("".join(words).encode("utf-32-le"), "<u4")
        for i in np.flatnonzero(lengths > MOST_SYMBOLS).tolist():
            out[i] = [self.bpe.ids[t] for t in self.bpe.merge(self.bpe.symbols(words[i]))]
        for width in np.unique(lengths[lengths <= MOST_SYMBOLS]).tolist():
            at = np.flatnonzero(lengths == width)
            spelled = codes[starts[at][:, None] + np.arange(width)]
            symbols = self.inner_symbols[spelled]
            symbols[:, -1] = self.last_symbols[spelled[:, -1]]
            if width > 1:
                ranks, made = self._merges(symbols[:, :-1], symbols[:, 1:])
            while width > 1:
                best = ranks.argmin(axis=1)
                rows = np.arange(len(at))
                done = ranks[rows, best] == NO_MERGE
                if done.any():
                    for i, line in zip(at[done].tolist(), symbols[done].tolist(), strict=True):
                        out[i] = line
                    at, symbols, ranks, made, best = at[~done], symbols[~done], ranks[~done], made[~done], best[~done]
                    rows = rows[: len(at)]
                if not len(at):
                    break
                # each word loses the right one of the merged symbols, and the pair that was merged
                symbols[rows, best] = made[rows, best]
                keep = np.ones(symbols.shape, bool)
                keep[rows, best + 1] = False
                symbols = symbols[keep].reshape(len(at), width - 1)
                keep = np.ones(ranks.shape, bool)
                keep[rows, best] = False
                ranks, made = ranks[keep].reshape(len(at), width - 2), made[keep].reshape(len(at), width - 2)
                width -= 1
                for pair in (best - 1, best):  # the merged symbol with its neighbours
                    some = (pair >= 0) & (pair < width - 1)
                    r, p = rows[some], pair[some]
                    ranks[r, p], made[r, p] = self._merges(symbols[r, p], symbols[r, p + 1])
            for i, line in zip(at.tolist(), symbols.tolist(), strict=True):
                out[i] = line
        return out

    def encode_words(self, words: list[str]) -> list[list[int]]:
        proposals = [self.propose(w) for w in words]
        lengths = np.fromiter(map(len, proposals), np.int64, len(words))
        flat = np.fromiter((t for p in proposals for t in p), np.int64, int(lengths.sum()))
        owner = np.repeat(np.arange(len(words)), lengths)
        inner = owner[1:] == owner[:-1]
        fits = np.ones(len(words), bool)
        if inner.any():
            keys = (flat[:-1] << 21 | flat[1:])[inner]
            fits[owner[1:][inner][~self._fits(keys)]] = False
        for i in np.flatnonzero(lengths == 1).tolist():
            fits[i] = self._is_whole(proposals[i][0])
        failing = np.flatnonzero(~fits).tolist()
        for i, ids in zip(failing, self.merge_exactly([words[i] for i in failing]), strict=True):
            proposals[i] = ids
        self.proposed_words += len(words)
        self.exact_words += int((~fits).sum())
        return proposals

    def split(self, pieces: list[bytes]) -> list[list[int | str]]:
        """The words of each piece.  Pieces of common letters are cut as lines of one text."""
        out: list[list[int | str]] = [[]] * len(pieces)
        simple, lines = [], []
        for i, p in enumerate(pieces):
            text = p.decode("utf-8", "replace")
            if self.bpe.plain_rule and SIMPLE.fullmatch(text) and "<|" not in text:
                simple.append(i)
                lines.append(text)
            else:
                out[i] = self.bpe.words(p)
        words = LINE_WORDS.findall("\n".join(lines).lower())
        spelled = self.spelling[np.frombuffer("\0".join(words).encode(), np.uint8)].tobytes().decode("utf-32-le").split("\0")
        ends = [k for k, w in enumerate(words) if w == "\n"]
        for i, a, b in zip(simple, [-1, *ends], [*ends, len(words)], strict=False):
            out[i] = spelled[a + 1 : b]
        return out

    def learn(self, pieces: list[bytes]) -> None:
        """Keeps (ids as little-endian 32-bit integers, their strings joined by a space, count) of pieces."""
        split = self.split(pieces)
        words = {w for w in set().union(*split) if isinstance(w, str)}
        self.words.make_room(len(words))
        new = list(words.difference(self.words, self.words.old))
        strings, known = self.bpe.strings, self.words
        encoded = self.encode_words(new)
        flat, at = array("I", chain.from_iterable(encoded)).tobytes(), 0
        for w, ids in zip(new, encoded, strict=True):
            n = len(ids)
            known[w] = (flat[at : at + 4 * n], " ".join([strings[i] for i in ids]).encode(), n)
            at += 4 * n
        for p, ws in zip(pieces, split, strict=True):
            if len(ws) == 1 and isinstance(ws[0], str):
                self.pieces[p] = known[ws[0]]
                continue
            if len(ws) == 2 and isinstance(ws[0], str) and isinstance(ws[1], str):  # a word and a mark
                (a, x, n), (b, y, m) = known[ws[0]], known[ws[1]]
                self.pieces[p] = (a + b, x + b" " + y, n + m)
                continue
            self.empty_pieces = self.empty_pieces or not ws
            own = [known[w] if isinstance(w, str) else (array("I", [w]).tobytes(), strings[w].encode(), 1) for w in ws]
            self.pieces[p] = (b"".join([e[0] for e in own]), b" ".join([e[1] for e in own]), sum([e[2] for e in own]))
        for w in new:
            if len(w) > 512:  # one long word is not worth keeping
                del known[w]

    def encode(self, texts: list[bytes]) -> list[list[tuple]]:
        """For each text, the entries of its pieces in order."""
        split = [t.split() for t in texts]
        wanted = set().union(*split)
        self.pieces.make_room(len(wanted))
        new = list(wanted.difference(self.pieces, self.pieces.old))
        self.learn(new)
        entry = self.pieces.__getitem__
        if self.empty_pieces:  # pieces that the normaliser leaves nothing of
            out = [[e for e in map(entry, ps) if e[2]] for ps in split]
        else:
            out = [list(map(entry, ps)) for ps in split]
        for p in new:
            if len(p) > 512:
                del self.pieces[p]
        return out


def encode_documents(docs: DataFrame, vocabulary_path: str, keep_ids: bool = True) -> DataFrame:
    """One row per row of ``docs`` (doc_id, text): doc_id, n_tokens, ids_sha256 (of the ids as
    little-endian unsigned 32-bit integers), decoded_sha256 (of the decoded text in UTF-8),
    and with ``keep_ids`` the ids (array of int) and the decoded text.

    Ids are those of the ``tokenizers`` library without added special tokens, special
    strings inside texts as it treats them; decoding is its ``decode`` without skipping special
    tokens, for vocabularies without a decoder: the tokens' strings joined by spaces.  Null
    counts as empty (no ids, empty string); repeated rows give repeated rows; other columns
    are ignored; texts of any length are encoded whole."""
    spec = Vocabulary(docs.sparkSession, vocabulary_path)

    def encode(batch: pa.RecordBatch) -> pa.RecordBatch:
        found = spec.kept(Speculator).encode(batch.column("text").cast(pa.binary()).to_pylist())
        ids = [b"".join([e[0] for e in es]) for es in found]
        decoded = [b" ".join([e[1] for e in es]) for es in found]
        columns = [
            batch.column("doc_id"),
            pa.array([len(i) // 4 for i in ids], pa.int64()),
            pa.array([hashlib.sha256(i).hexdigest() for i in ids]),
            pa.array([hashlib.sha256(d).hexdigest() for d in decoded]),
        ]
        names = ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"]
        if keep_ids:
            flat = pa.array(np.frombuffer(b"".join(ids), "<u4").astype(np.int32))
            offsets = pa.array(np.cumsum([0, *[len(i) // 4 for i in ids]]), pa.int32())
            columns += [pa.ListArray.from_arrays(offsets, flat), pa.array([d.decode() for d in decoded])]
            names += ["ids", "decoded"]
        return pa.RecordBatch.from_arrays(columns, names)

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), text_of().alias("text"))
    schema = "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string"
    return map_text(rows, schema + (", ids array<int>, decoded string" if keep_ids else ""), encode)
