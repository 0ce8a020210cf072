"""What the byte-pair operators share: the vocabulary file as bounded bytes, the words of a
text as the library sees them, and exact merging of one word or token pair."""

from __future__ import annotations

import hashlib
import json
import os
import re

from pyspark.sql import SparkSession

#: A vocabulary file is broadcast; larger ones are refused.
MAX_VOCABULARY_BYTES = 64 << 20

NEVER = float("inf")


_KEPT: dict[tuple[str, type], object] = {}


class Vocabulary:
    """The text of a ``tokenizers`` JSON file, of proven size, broadcast to the workers; the
    driver alone opens the path.  ``kept(cls)`` is the worker's one object made from it."""

    def __init__(self, spark: SparkSession, path: str):
        if os.path.getsize(path) > MAX_VOCABULARY_BYTES:
            raise ValueError(f"{path} exceeds {MAX_VOCABULARY_BYTES} bytes")
        with open(path, encoding="utf-8") as fh:
            text = fh.read()
        self.digest = hashlib.sha256(text.encode()).hexdigest()
        self.text = spark.sparkContext.broadcast(text)

    def kept(self, cls: type):
        key = (self.digest, cls)
        if key not in _KEPT:
            _KEPT[key] = cls(self.text.value)
        return _KEPT[key]


#: fixed values: the vocabulary file's own word rule, as it stands in JSON
WORD_RULE = r"""'s|'t|'re|'ve|'m|'ll|'d|[\\p{L}]+|[\\p{N}]|[^\\s\\p{L}\\p{N}]+"""
#: The same rule for pieces of printable ASCII and the accented letters of Latin-1 alone: these
#: have no compositions, and lower-case letter by letter.  All others go through the library.
SIMPLE = re.compile("[!-~À-ÖØ-öø-ÿ]*")
SIMPLE_WORDS = re.compile("'s|'t|'re|'ve|'m|'ll|'d|[a-zß-öø-ÿ]+|[0-9]|[^a-zß-öø-ÿ0-9]+")


def _byte_alphabet() -> dict[int, str]:
    """Byte-level alphabet: printable bytes of Latin-1 stand for themselves, the others
    follow from U+0100 in order."""
    own = {*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)}
    rest = [b for b in range(256) if b not in own]
    return {b: chr(b) if b in own else chr(0x100 + rest.index(b)) for b in range(256)}


BYTE_ALPHABET = _byte_alphabet()
LATIN_BYTES = {c: "".join(BYTE_ALPHABET[b] for b in chr(c).encode()) for c in range(0xC0, 0x100)}


class Merges:
    """The merge list of a vocabulary file, and exact merging with it."""

    def __init__(self, model: dict):
        self.ids: dict[str, int] = model["vocab"]
        merges = (m if isinstance(m, list) else m.split(" ") for m in model["merges"])
        self.ranks = {(a, b): r for r, (a, b) in enumerate(merges)}

    def merge(self, parts: list[str]) -> list[str]:
        """Exact merging: the pair of lowest rank first, the leftmost of equals."""
        parts = list(parts)
        if len(parts) > 48:
            return self._merge_long(parts)
        rank = self.ranks.get
        near = [rank(pair, NEVER) for pair in zip(parts, parts[1:], strict=False)]
        while near and (best := min(near)) != NEVER:
            i = near.index(best)
            parts[i : i + 2] = [parts[i] + parts[i + 1]]
            del near[i]
            if i < len(near):
                near[i] = rank((parts[i], parts[i + 1]), NEVER)
            if i:
                near[i - 1] = rank((parts[i - 1], parts[i]), NEVER)
        return parts

    def _merge_long(self, parts: list[str]) -> list[str]:
        """The same with a heap and linked neighbours, n log n for words of any length."""
        import heapq

        n = len(parts)
        nxt, prv, ranks = list(range(1, n + 1)), list(range(-1, n - 1)), self.ranks
        heap = [(r, i, parts[i], parts[i + 1]) for i in range(n - 1) if (r := ranks.get((parts[i], parts[i + 1]))) is not None]
        heapq.heapify(heap)
        while heap:
            _, i, a, b = heapq.heappop(heap)
            j = nxt[i]
            if parts[i] != a or j >= n or parts[j] != b:
                continue  # one of the two has changed meanwhile
            parts[i], parts[j], nxt[i] = a + b, "", nxt[j]
            if nxt[i] < n:
                prv[nxt[i]] = i
                if (r := ranks.get((parts[i], parts[nxt[i]]))) is not None:
                    heapq.heappush(heap, (r, i, parts[i], parts[nxt[i]]))
            if prv[i] >= 0 and (r := ranks.get((parts[prv[i]], parts[i]))) is not None:
                heapq.heappush(heap, (r, prv[i], parts[prv[i]], parts[i]))
        return [p for p in parts if p]


class WordBpe(Merges):
    """A BPE whose words never span white space (word-end suffix, no space symbol).

    ``words(piece)`` splits a piece between ASCII white space into special-token ids and
    words in the byte alphabet, by the library's own normaliser and pre-tokenizer;
    ``merge(symbols)`` is exact byte-pair merging."""

    def __init__(self, spec: str):
        from tokenizers import Tokenizer

        library = Tokenizer.from_str(spec)
        model = json.loads(spec)["model"]
        super().__init__(model)
        self.end = model.get("end_of_word_suffix") or ""
        if model.get("continuing_subword_prefix") or not self.end:
            raise ValueError("a vocabulary with a word-end suffix is expected")
        self._made = {a + b: (a, b) for a, b in self.ranks}
        self._edges: tuple[dict, dict] = ({}, {})
        added = library.get_added_tokens_decoder()
        self.special = {t.content: i for i, t in added.items()}
        self._split = re.compile("(" + "|".join(map(re.escape, self.special)) + ")") if self.special else None
        self.strings = {i: s for s, i in self.ids.items()} | {i: s for s, i in self.special.items()}
        self.plain_rule = WORD_RULE in spec and all("<|" in t for t in self.special)
        self._normalize, self._pre = library.normalizer, library.pre_tokenizer

    def words(self, piece: bytes) -> list[int | str]:
        text = piece.decode("utf-8", "replace")
        if self.plain_rule and SIMPLE.fullmatch(text) and "<|" not in text:
            return SIMPLE_WORDS.findall(text.lower()) if text.isascii() else [w.translate(LATIN_BYTES) for w in SIMPLE_WORDS.findall(text.lower())]
        out: list[int | str] = []
        for part in self._split.split(text) if self._split else [text]:
            if part in self.special:
                out.append(self.special[part])
            elif part:
                norm = self._normalize.normalize_str(part) if self._normalize else part
                out += [w for w, _ in self._pre.pre_tokenize_str(norm)]
        return out

    def symbols(self, word: str) -> list[str]:
        return [*word[:-1], word[-1] + self.end]

    def split_token(self, token: str) -> list[str]:
        """The symbols a token is made of."""
        return self.symbols(token[: -len(self.end)]) if token.endswith(self.end) and token != self.end else [*token]

    def edge(self, token: str, side: int) -> list[tuple[str, float]]:
        """The symbols that stand at one edge of a token while it is merged (side 0: its left
        edge, 1: its right), each with the rank of the merge that ends it."""
        known = self._edges[side].get(token)
        if known is None:
            pair = self._made.get(token)
            known = [(token, NEVER)]
            if pair:
                inner = self.edge(pair[side], side)
                known = [*inner[:-1], (pair[side], self.ranks[pair]), (token, NEVER)]
            self._edges[side][token] = known
        return known

    def compatible(self, a: str, b: str) -> bool:
        """Tokens a, b (each its own encoding) stay as they are when the string of both is
        merged: no symbol at a's right edge merges with one at b's left edge while both
        stand.  A sequence whose neighbours are all compatible is the exact encoding of
        its string."""
        right, left = self.edge(a, 1), self.edge(b, 0)
        i = j = 0
        while True:
            (x, x_ends), (y, y_ends) = right[i], left[j]
            across = self.ranks.get((x, y), NEVER)
            if across < x_ends and across <= y_ends and across < NEVER:
                return False  # of equal ranks the leftmost goes first
            if x_ends == y_ends == NEVER:
                return True
            if x_ends <= y_ends:
                i += 1
            else:
                j += 1


class PieceCache(dict):
    """What is known of pieces, in two generations of at most ``most`` entries: when the younger is
    full it becomes the older, whose entries come back as they are asked for."""

    def __init__(self, most: int = 250_000):
        super().__init__()
        self.most = most
        self.old: dict = {}

    def __missing__(self, key):
        found = self[key] = self.old[key]
        return found

    def knows(self, key) -> bool:
        return key in self or key in self.old

    def make_room(self, more: int) -> None:
        if len(self) + more > self.most:
            self.old = self.copy()
            self.clear()
