import random
import zlib

import numpy as np
import pytest
from llm_fixtures import edge_rows, make_docs  # noqa: F401

from quarry.llm import quality as Q
from quarry.llm import toxicity as X
from quarry.llm.labels import fit_rows

LABELS = "doc_id long, quality int, toxic int, text string, score double"


@pytest.fixture(scope="module")
def corpus():
    """Clean prose, junk of several kinds, and toxic texts with stems and disguises."""
    rnd = random.Random(8)
    syllables = "an er in on the re ti st en or at ed nd ha es of is it al ar".split()
    word = lambda: "".join(rnd.choice(syllables) for _ in range(rnd.randint(1, 4)))
    prose = lambda n: ". ".join(" ".join(word() for _ in range(8)).capitalize() for _ in range(max(1, n // 8))) + "."
    junk = [
        lambda n: " ".join([word()] * n),
        lambda n: " ".join(word().upper() + "!!" for _ in range(n)),
        lambda n: " ".join(word() + rnd.choice(["***", "&&&", "%%%"]) for _ in range(n)),
        lambda n: " | ".join(word() for _ in range(n)),
    ]
    docs, labels = [], []
    for i in range(1500):
        n, kind = rnd.randint(8, 200), rnd.random()
        text = rnd.choice(junk)(n) if kind < 0.2 else prose(n)
        toxic = kind > 0.8
        if toxic:
            words = text.split(" ")
            for _ in range(max(2, len(words) // 25)):
                words[rnd.randrange(len(words))] = rnd.choice(["dumfool", "DumF00l", "dυmfооls", "wreckle", "wreckled", "wr3ckle"])
            text = " ".join(words)
        elif kind > 0.7:
            text += " the wreckle museum opened."  # an exception phrase of clean texts
        docs.append((i, text))
        labels.append((i, int(kind >= 0.2), int(toxic), "clash", 1.0))
    return docs, labels


def held(i):
    return zlib.crc32(str(i).encode()) % 5 == 0


def accuracy(rows, labels, column):
    truth = {r[0]: r[column] for r in labels}
    tested = [r for r in rows if r.held_out]
    assert all(r.held_out == held(r.doc_id) for r in rows) and all(0 <= r.score <= 1 for r in rows)
    assert len(tested) > 200
    return sum(r.predicted == truth[r.doc_id] for r in tested) / len(tested)


def test_quality_on_held_out_rows(spark, make_docs, corpus):
    docs, labels = corpus
    rows = Q.score_quality(make_docs(docs), spark.createDataFrame(labels, LABELS)).collect()
    assert accuracy(rows, labels, 1) > 0.97


def test_held_out_labels_are_not_learned(spark, make_docs, corpus):
    docs, labels = corpus
    flipped = [(i, 1 - q, 1 - t, x, s) if held(i) else (i, q, t, x, s) for i, q, t, x, s in labels]
    for score in (Q.score_quality, X.score_toxicity):
        a, b = (
            {r.doc_id: r.score for r in score(make_docs(docs[:600], 1), spark.createDataFrame(known[:600], LABELS).coalesce(1)).collect()}
            for known in (labels, flipped)
        )
        assert a.keys() == b.keys() and all(abs(a[i] - b[i]) < 1e-9 for i in a)


def test_toxicity_on_held_out_rows(spark, make_docs, corpus):
    docs, labels = corpus
    rows = X.score_toxicity(make_docs(docs), spark.createDataFrame(labels, LABELS)).collect()
    assert accuracy(rows, labels, 2) > 0.97


def toxic_found(spark, make_docs, docs, labels):
    rows = X.score_toxicity(make_docs(docs), spark.createDataFrame(labels, LABELS)).collect()
    truth = {r[0]: r[2] for r in labels}
    return [r.predicted for r in rows if r.held_out and r.doc_id < 1500 and truth[r.doc_id]]


def added(ids, text, toxic, known):
    """``known`` documents and labels with copies of a text that may be learned from."""
    docs, labels = known
    return docs + [(i, text) for i in ids], labels + [(i, 1, toxic, "", 0.0) for i in ids]


def test_quoted_terms_stay_entries(spark, make_docs, corpus):
    """A clean text that quotes every term, in copies, strikes none of them out, and is no toxic text itself."""
    ids = [i for i in range(2000, 2100) if not held(i)][:60]
    docs, labels = added(ids, "quoted dumfool here, said wreckle there", 0, corpus)
    found = toxic_found(spark, make_docs, docs, labels)
    assert sum(found) > 0.95 * len(found)
    rows = X.score_toxicity(make_docs(docs), spark.createDataFrame(labels, LABELS)).collect()
    assert not any(r.predicted for r in rows if r.doc_id >= 2000)


def test_copies_of_a_toxic_text_drop_no_entry(spark, make_docs, corpus):
    """Copies of a toxic text with another term, and a term that under 2.5 % of the toxic texts hold."""
    docs, labels = added([i for i in range(2000, 5000) if not held(i)], "zotted person, zotted fool, so zotted", 1, corpus)
    found = toxic_found(spark, make_docs, docs, labels)
    assert sum(found) > 0.95 * len(found)


def test_rare_terms_are_entries(spark, make_docs):
    """Each of 60 terms in 12 of 720 toxic texts (1.7 %), a tenth of all texts."""
    rnd = random.Random(3)
    names = ["".join(rnd.choice("bdfgkmnprtvz") + rnd.choice("aeou") for _ in range(4)) for _ in range(60)]
    plain = [f"{a}{b}{c}" for a in "bcdfg" for b in "aeiou" for c in "kmnprstvwx"]
    docs, labels = [], []
    for i in range(7200):
        words = [rnd.choice(plain) for _ in range(30)]
        if i % 10 == 0:
            for at in (4, 14, 24):
                words[at] = names[i // 10 % 60]
        docs.append((i, " ".join(words)))
        labels.append((i, 1, int(i % 10 == 0), "", 0.0))
    rows = X.score_toxicity(make_docs(docs), spark.createDataFrame(labels, LABELS)).collect()
    assert accuracy(rows, labels, 2) > 0.97


def test_one_fitted_row_per_label(spark, make_docs):
    """Rows that repeat a labelled id count once, so the bound on labels bounds the rows."""
    a, b = [i for i in range(20) if not held(i)][:2]
    known = spark.createDataFrame([(i, 1, 1, "", 0.0) for i in (a, b)], LABELS)
    rows = fit_rows(make_docs([(a, f"text {k}") for k in range(300)] + [(b, None)]), known, "toxic").collect()
    assert sorted((r.text, r.label) for r in rows) == [("", 1), ("text 0", 1)]


def test_exceptions_and_longest_entry():
    lexicon = X.Lexicon({"wreck": 1.0, "wreckie": 5.0}, frozenset({"wreckie museum"}), (-3.0, 1.0, 1.0))
    a = lexicon.automaton()
    assert lexicon.found(X.fold("The wreckle, MUSEUM!"), a) == (0, 0)
    assert lexicon.found(X.fold("the wr3ckles museum"), a) == (5.0, 1)
    assert lexicon.found(X.fold("shipwreckle"), a) == (0, 0)
    assert X.Lexicon({}).found(" any", X.Lexicon({}).automaton()) == (0.0, 0)


@pytest.mark.parametrize("text", ["ІDІОТ", "1d10t", "ｉｄｉｏｔ", "id​iot", "𝐢𝐝𝐢𝐨𝐭"])
def test_folding(text):
    assert X.fold(text).split() == ["idiot"]


@pytest.mark.parametrize("score", [Q.score_quality, X.score_toxicity])
def test_edge_rows(spark, make_docs, edge_rows, corpus, score):
    docs, labels = corpus
    known = spark.createDataFrame(labels[:400] + [(None, 1, 1, "", 0.0), (3, None, None, "", 0.0), (5, 7, 9, "", 0.0)], LABELS)
    rows = score(make_docs([(i + 10_000, t) for i, t in docs[:400]] + edge_rows), known).collect()
    assert len(rows) == 400 + len(edge_rows)
    alike = [r.score for r in rows if r.doc_id in (1, 2)]
    assert alike[0] == alike[1]  # null counts as empty
    assert score(make_docs(edge_rows).limit(0), known).collect() == []
    assert len(score(make_docs(edge_rows), known.limit(0)).collect()) == len(edge_rows)  # nothing to learn from
    carried = score(make_docs(edge_rows), known, carry=("text", "lang", "n_chars")).collect()
    assert sorted(map(str, (r.text for r in carried))) == sorted(str(t) for _, t in edge_rows)


def test_isotonic_is_monotone_and_exact():
    x, hits, n = np.arange(5.0), np.array([0, 3, 1, 4, 9.0]), np.array([10, 10, 10, 10, 10.0])
    edges, values = Q.isotonic(x, hits, n)
    assert (np.diff(values) >= 0).all() and np.interp(1, edges, values) == np.interp(2, edges, values)


def test_features_approximate_the_gaussian_kernel():
    rng = np.random.default_rng(1)
    d, features = 4, 20_000
    waves, phases = rng.normal(0, 1 / Q.WIDTH, (d, features)), rng.uniform(0, 2 * np.pi, features)
    x = rng.normal(0, 1, (6, d))
    z = Q.fourier(x, np.zeros(d), np.ones(d), waves, phases)[:, :-1]
    kernel = np.exp(-((x[:, None] - x[None]) ** 2).sum(-1) / (2 * Q.WIDTH**2))
    assert np.abs(z @ z.T - kernel).max() < 0.03
