"""Toxicity by a weighted lexicon: folded text, Aho-Corasick matching, exception phrases, and a
score from the weight found relative to the length.

Folding lower-cases, maps homoglyphs of other scripts and digits that stand for letters to the
letter, drops invisible characters, and turns everything that is no letter into a space.  Entries are
word beginnings.  The lexicon is learned: beginnings that many different contexts of toxic
texts hold and clean texts hardly do.  Phrases around an entry that only clean texts hold
are exceptions: a match inside one does not count, neither for a text nor against an entry.
"""

from __future__ import annotations

import math
import unicodedata
import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quarry.llm.labels import FIT_PARTITIONS, fit_rows, held_out, scored_rows
from quarry.llm.shared import map_text, prepare, sliced, small_batches, written

#: At most about this many labelled rows are fitted on.
FIT_ROWS = 20_000
#: Word beginnings looked at, in folded letters.
SHORTEST, LONGEST = 3, 12
#: An entry has this log odds at least, and its contexts are credited to so many toxic texts (copies are one text).
LEAST_WEIGHT, LEAST_TEXTS = 4.2, 4
#: Chance of a false entry among all word beginnings tested, were toxic and clean texts to hold them alike.
CHANCE = 0.05
#: A phrase that so many clean rows and no toxic ones hold is an exception; it says nothing against its words.
LEAST_QUOTED = 3
PREDICT_AT = 0.5
#: Contexts are combined in the task over about so much text: each takes some hundred bytes there.
CONTEXT_BYTES = 256 << 10

# fixed values: letters of other scripts that look like Latin ones, and signs that stand for letters
LOOKALIKES = {
    "а": "a", "в": "b", "с": "c", "ԁ": "d", "е": "e", "һ": "h", "н": "h", "і": "i", "ј": "j", "к": "k", "м": "m", "о": "o",
    "р": "p", "ԛ": "q", "ѕ": "s", "т": "t", "у": "y", "ѵ": "v", "ԝ": "w", "х": "x", "α": "a", "ε": "e", "ι": "i", "κ": "k",
    "ν": "v", "ο": "o", "ρ": "p", "τ": "t", "υ": "u", "χ": "x", "ı": "i", "ɑ": "a", "ɡ": "g", "ո": "n", "օ": "o", "ս": "u",
}
SUBSTITUTES = {"0": "o", "1": "i", "3": "e", "4": "a", "5": "s", "7": "t", "8": "b", "9": "g", "@": "a", "$": "s"}


class _Folding(dict):
    """A translation table filled as characters are met."""

    def __missing__(self, code: int) -> str:
        c = chr(code)
        plain = LOOKALIKES.get(c) or SUBSTITUTES.get(c)
        if plain is None:
            wide = unicodedata.normalize("NFKC", c).lower()
            kind = unicodedata.category(c)
            if kind in ("Cf", "Mn"):
                plain = ""
            elif wide != c and len(wide) == 1:
                plain = self[ord(wide)]
            else:
                plain = c if kind.startswith("L") else " "
        # 1 stands for both i and l, so they are one letter
        self[code] = plain = "i" if plain == "l" else plain
        return plain


_FOLDING = _Folding()


def fold(text: str) -> str:
    """Folded words, each with one or more spaces before it."""
    return " " + text.lower().translate(_FOLDING)


@dataclass(frozen=True)
class Lexicon:
    """``weights``: entry (a word beginning) to weight; ``exceptions``: folded phrases of whole
    words; ``curve``: coefficients of the score."""

    weights: dict[str, float]
    exceptions: frozenset[str] = frozenset()
    curve: tuple[float, float, float] = (-3.0, 1.0, 1.0)

    def automaton(self):
        import ahocorasick

        a = ahocorasick.Automaton()
        for entry, w in self.weights.items():
            a.add_word(" " + entry, (len(entry), w))
        for phrase in self.exceptions:
            a.add_word(f" {phrase} ", (len(phrase), None))
        if len(a):
            a.make_automaton()
        return a

    def found(self, folded: str, automaton) -> tuple[float, int]:
        """Weight of the matches outside exceptions (the longest entry of a place counts), and their number."""
        if not len(automaton):
            return 0.0, 0
        hits: dict[int, float] = {}
        spans = []
        text = " ".join(folded.split()) + " " if self.exceptions else folded
        for end, (size, w) in automaton.iter(" " + text if self.exceptions else text):
            if w is None:
                spans.append((end - size, end))
            else:
                at = end - size + 1
                hits[at] = max(w, hits.get(at, 0.0))
        if spans:
            hits = {at: w for at, w in hits.items() if not any(a <= at < b for a, b in spans)}
        return sum(hits.values()), len(hits)


def features(weight: float, folded: str) -> tuple[float, float]:
    """The weight by itself and per thousand words."""
    return math.log1p(weight), math.log1p(1000 * weight / max(1, len(folded.split())))


def _distinct(rows: DataFrame) -> DataFrame:
    """(text, label, copies, id): each distinct folded text once per label, and how many rows have it."""

    def folded(batch: pa.RecordBatch) -> pa.RecordBatch:
        texts = [" ".join(fold(t).split()) for t in batch.column("text").to_pylist()]
        return pa.RecordBatch.from_arrays([pa.array(texts, pa.string()), batch.column("label")], ["text", "label"])

    once = map_text(rows, "text string, label int", folded).groupBy("text", "label").agg(F.count(F.lit(1)).alias("copies"))
    return once.withColumn("id", F.xxhash64("text")).repartition(FIT_PARTITIONS, "id")


def _contexts(sample: DataFrame, kept: frozenset[str] | None = None, share: int = 1) -> DataFrame:
    """(word, side, toxic, clean, quoted): one row per context of a folded word, the word before (side 0) or
    after (side 1).  A context is credited to one toxic and one clean text that hold it (their
    smallest ids); it is quoted if clean rows alone hold it, ``LEAST_QUOTED`` or more.  With ``kept``, of
    words that begin with one of them; with ``share``, one of so many contexts, drawn by a hash of their words
    (each is then counted over all texts, as without)."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fits = {}  # whether a word counts, looked up once per task
        code = {"": 1}

        def wanted(word: str) -> bool:
            if len(word) < SHORTEST:
                return False
            return kept is None or any(word[:k] in kept for k in range(SHORTEST, LONGEST + 1))

        for batch in sliced(batches, "text", CONTEXT_BYTES):
            found: dict[tuple, list] = {}
            for text, label, copies, at in zip(*(batch.column(c).to_pylist() for c in ("text", "label", "copies", "id")), strict=True):
                words = text.split()
                for word in set(words).difference(fits):
                    fits[word], code[word] = wanted(word), zlib.crc32(word.encode())
                around = ["", *words, ""]
                own = set()
                for i, word in enumerate(words):
                    if fits[word]:
                        for side, beside in ((0, around[i]), (1, around[i + 2])):
                            if share == 1 or (3 * code[word] + 5 * code[beside] + side) % share == 0:
                                own.add((word, side, beside))
                for key in own:
                    e = found.setdefault(key, [None, None, 0, 0])
                    e[label] = at if e[label] is None else min(at, e[label])
                    e[2 + label] += copies
            if found:
                columns = [*zip(*found, strict=True), *zip(*found.values(), strict=True)]
                kinds = (pa.string(), pa.int32(), pa.string(), *[pa.int64()] * 4)
                names = ["word", "side", "beside", "clean", "toxic", "n_clean", "n_toxic"]
                yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], names)

    found = sample.mapInArrow(count, "word string, side int, beside string, clean long, toxic long, n_clean long, n_toxic long")
    once = found.groupBy("word", "side", "beside")
    once = once.agg(*(f(c).alias(c) for f, c in ((F.min, "toxic"), (F.min, "clean"), (F.sum, "n_toxic"), (F.sum, "n_clean"))))
    quoted = (F.col("beside") != "") & (F.col("n_toxic") == 0) & (F.col("n_clean") >= LEAST_QUOTED)
    return once.select("word", "side", "toxic", "clean", quoted.alias("quoted"))


def _credited(contexts: DataFrame, label: str, kept: frozenset[str] | None = None) -> DataFrame:
    """(start, n, unquoted): to how many texts of the ``label`` the contexts of a word beginning (one of ``kept``) are
    credited, and those that are not quoted, each on the side with fewer.  The contexts of a text meet in one
    task, which takes the beginnings and counts them: a row per beginning and task is shuffled, none per occurrence."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        totals: dict[tuple, list] = {}
        current, own = None, {}

        def close():
            for key, quoted in own.items():
                e = totals.setdefault(key, [0, 0])
                e[0] += 1
                e[1] += not quoted
            own.clear()

        for batch in batches:
            for at, word, side, quoted in zip(*(batch.column(c).to_pylist() for c in ("id", "word", "side", "quoted")), strict=True):
                if at != current:
                    close()
                    current = at
                for k in range(SHORTEST, min(len(word), LONGEST) + 1):
                    key = word[:k], side
                    if kept is None or key[0] in kept:
                        own[key] = quoted and own.get(key, True)
        close()
        if totals:
            columns = [*zip(*totals, strict=True), *zip(*totals.values(), strict=True)]
            kinds = (pa.string(), pa.int32(), pa.int64(), pa.int64())
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], ["start", "side", "n", "unquoted"])

    texts = contexts.where(F.col(label).isNotNull()).select(F.col(label).alias("id"), "word", "side", "quoted")
    parts = texts.repartition(FIT_PARTITIONS, "id").sortWithinPartitions("id").mapInArrow(count, "start string, side int, n long, unquoted long")
    sides = parts.groupBy("start", "side").agg(F.sum("n").alias("n"), F.sum("unquoted").alias("unquoted"))
    return sides.groupBy("start").agg(F.min("n").alias("n"), F.min("unquoted").alias("unquoted"))


def _entries(sample: DataFrame, toxic: int, clean: int) -> dict[str, float]:
    held = _credited(_contexts(sample.where("label = 1")), "toxic").where(F.col("n") >= LEAST_TEXTS)
    t = {r.start: r.n for r in held.collect()}  # beginnings in several toxic texts of the sample
    base, least = toxic / (toxic + clean), math.log(max(1, len(t)) / CHANCE)

    def weight(start: str, c: int) -> float:
        return math.log((t[start] + 0.5) / (toxic + 1)) - math.log((c + 0.5) / (clean + 1))

    def significant(start: str, c: int) -> bool:
        """By the bound of Chernoff on so large a part of the texts with the beginning being toxic by chance."""
        n, part = t[start] + c, t[start] / (t[start] + c)
        rest = (1 - part) * math.log((1 - part) / (1 - base)) if c else 0.0
        return part > base and n * (part * math.log(part / base) + rest) >= least

    kept = frozenset(s for s in t if significant(s, 0) and weight(s, 0) >= LEAST_WEIGHT)
    # a part of the contexts credits no more texts than all of them: what fails on it fails on the whole
    for share in (16, 1):
        if not kept:
            return {}
        counts = {r.start: (r.n, r.unquoted) for r in _credited(_contexts(sample, kept, share), "clean", kept).collect()}  # kept ones only
        found = {s: counts.get(s, (0, 0)) for s in kept}
        kept = frozenset(s for s, (n, c) in found.items() if significant(s, n) and weight(s, c) >= LEAST_WEIGHT)
    rows = {s: (t[s], weight(s, found[s][1])) for s in sorted(kept, key=lambda s: (-t[s], s))}
    chosen: dict[str, float] = {}
    for start in sorted(rows, key=len):
        if any(start[:k] in chosen for k in range(SHORTEST, len(start))):
            continue  # a shorter entry covers it
        best = start
        while True:  # as long as nearly all its words go on in the same way, so does the entry
            t = rows[best][0]
            longer = [s for s in rows if len(s) == len(best) + 1 and s.startswith(best) and rows[s][0] >= 0.8 * t]
            if not longer:
                break
            best = longer[0]
        chosen[best] = rows[best][1]
    # entries that grew may now cover one another
    return {s: w for s, w in chosen.items() if not any(s[:k] in chosen for k in range(SHORTEST, len(s)))}


def _exceptions(sample: DataFrame, weights: dict[str, float], least: int = LEAST_QUOTED) -> frozenset[str]:
    """Two-word phrases with an entry that several clean rows and no toxic ones hold."""

    def phrases(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sizes = sorted({len(e) for e in weights})
        for batch in sliced(batches, "text"):
            rows = []
            for text, label, copies in zip(*(batch.column(c).to_pylist() for c in ("text", "label", "copies")), strict=True):
                words = text.split()
                near = {i for i, w in enumerate(words) if any(w[:k] in weights for k in sizes)}
                rows += [(p, label * copies, copies) for p in {" ".join(words[i : i + 2]) for j in near for i in (j - 1, j) if 0 <= i < len(words) - 1}]
            if rows:
                phrase, t, n = zip(*rows, strict=True)
                yield pa.RecordBatch.from_arrays([pa.array(phrase, pa.string()), pa.array(t, pa.int64()), pa.array(n, pa.int64())], ["phrase", "t", "n"])

    counted = sample.mapInArrow(phrases, "phrase string, t long, n long").groupBy("phrase").agg(F.sum("t").alias("t"), F.sum("n").alias("n"))
    kept = counted.where((F.col("t") == 0) & (F.col("n") >= least))
    return frozenset(r.phrase for r in kept.select("phrase").collect())  # of the sample's words beside entries


def _curve(x: np.ndarray, y: np.ndarray, ridge: float = 0.02) -> tuple[float, float, float]:
    """Ridge logistic regression by Newton steps; both classes weigh the same."""
    z = np.c_[np.ones(len(x)), x]
    share = np.where(y == 1, 0.5 / max(1, y.sum()), 0.5 / max(1, (1 - y).sum()))
    w = np.zeros(3)
    for _ in range(40):
        p = 1 / (1 + np.exp(-np.clip(z @ w, -30, 30)))
        penalty = ridge * np.array([0.0, 1, 1]) * 0.05
        step = np.linalg.solve((z.T * (share * p * (1 - p))) @ z + np.diag(penalty + 1e-9), z.T @ (share * (p - y)) + penalty * w)
        w = w - np.clip(step, -2, 2)
    return tuple(float(v) for v in w)


def learn(docs: DataFrame, labels: DataFrame, most: int = FIT_ROWS) -> Lexicon:
    """The lexicon from the labelled rows that may be learned from (``most`` at most); copies of a text count once."""
    sample = written(_distinct(fit_rows(docs, labels, "toxic", most)), "toxic-rows")
    totals = sample.agg(F.sum("label").alias("t"), F.count(F.lit(1)).alias("n")).first()
    toxic, clean = totals.t or 0, totals.n - (totals.t or 0)
    if not toxic:
        return Lexicon({})
    weights = _entries(sample, toxic, clean)
    lexicon = Lexicon(weights, _exceptions(sample, weights) if weights else frozenset())

    def measure(batch: pa.RecordBatch) -> pa.RecordBatch:
        automaton = lexicon.automaton()
        rows = []
        for text in batch.column("text").to_pylist():
            folded = fold(text)
            rows.append(features(lexicon.found(folded, automaton)[0], folded))
        a, b = zip(*rows, strict=True)
        return pa.RecordBatch.from_arrays([pa.array(a), pa.array(b), batch.column("label")], ["a", "b", "label"])

    rows = map_text(sample, "a double, b double, label int", measure).collect()  # FIT_ROWS at most, three numbers each
    x, y = np.array([(r.a, r.b) for r in rows]), np.array([r.label for r in rows], float)
    return Lexicon(weights, lexicon.exceptions, _curve(x, y))


def score_toxicity(
    docs: DataFrame, labels: DataFrame, most: int = FIT_ROWS, predict_at: float = PREDICT_AT, carry: tuple[str, ...] = ()
) -> DataFrame:
    """One row per row of ``docs`` (doc_id, text): doc_id, held_out, score (0 to 1, higher: label 1
    likelier), predicted (1 if score >= ``predict_at``, else 0), n_hits, and the columns ``carry`` of ``docs``.

    ``labels`` (doc_id, toxic) are learned from where crc32(doc_id as text) mod 5 is not 0, on a sample
    of at most ``most`` of them; only the text enters a score.  Null counts as empty: no match,
    the lowest score; a null doc_id is never held out; repeated rows give repeated rows; without a
    toxic label to learn from nothing is found toxic; an empty table gives no rows.
    Building the frame learns the lexicon."""
    prepare(docs.sparkSession)
    small_batches(docs.sparkSession)
    lexicon = learn(docs, labels, most)

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        automaton = lexicon.automaton()
        c0, c1, c2 = lexicon.curve
        for batch in sliced(batches, "_text"):
            scores, hits = [], []
            for text in batch.column("_text").to_pylist():
                folded = fold(text)
                weight, n = lexicon.found(folded, automaton)
                a, b = features(weight, folded) if n else (0.0, 0.0)
                scores.append(1 / (1 + math.exp(-max(-30.0, min(30.0, c0 + c1 * a + c2 * b)))))
                hits.append(n)
            columns = [pa.array(scores, pa.float64()), pa.array(hits, pa.int64()), *batch.columns[1:]]
            yield pa.RecordBatch.from_arrays(columns, ["score", "n_hits", *batch.schema.names[1:]])

    rows, own = scored_rows(docs, carry)
    scored = rows.mapInArrow(score, "score double, n_hits long, " + own)
    predicted = (F.col("score") >= predict_at).cast("int").alias("predicted")
    return scored.select("doc_id", held_out().alias("held_out"), "score", predicted, "n_hits", *carry)
