import random
import re
from itertools import combinations

import numpy as np
import pytest
from llm_fixtures import edge_rows, make_docs  # noqa: F401

from quarry.llm import near_dedup as N


def shingles(text):
    w = [x for x in re.split(r"[\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or "")) if x]
    return frozenset(tuple(w[k : k + 5]) for k in range(max(1, len(w) - 4))) if w else frozenset()


def brute(rows):
    sets = [shingles(t) for _, t in rows]
    label = list(range(len(rows)))

    def root(x):
        while label[x] != x:
            x = label[x]
        return x

    for a, b in combinations(range(len(rows)), 2):
        both = len(sets[a] & sets[b])
        if both and 100 * both >= 75 * (len(sets[a]) + len(sets[b]) - both):
            label[root(a)] = root(b)
    least = {}
    for k, (i, _) in enumerate(rows):
        if i is not None:
            least[root(k)] = min(i, least.get(root(k), i))
    return sorted(((i, len(s), c := least.get(root(k)), i == c) for k, ((i, _), s) in enumerate(zip(rows, sets, strict=True))), key=repr)


def frame(docs):
    return sorted((tuple(r) for r in N.near_dedup(docs).collect()), key=repr)


def edited(rnd, words, share):
    return " ".join(f"new{rnd.random()}" if rnd.random() < share else w for w in words)


@pytest.fixture
def varied():
    """Chains of edits, a group of many near copies, short texts, a passage that many share."""
    rnd = random.Random(4)
    vocabulary = [f"w{i}" for i in range(3000)]
    text = lambda n: [rnd.choice(vocabulary) for _ in range(n)]
    rows, base, passage = [], text(120), text(40)
    rows += [edited(rnd, base, rnd.choice([0.0, 0.01, 0.02, 0.04])) for _ in range(150)]
    for _ in range(25):
        w = text(rnd.randint(5, 400))
        for _ in range(rnd.randint(1, 4)):
            w = edited(rnd, w, 0.02).split()
            rows.append(" ".join(w))
    rows += [" ".join(passage + text(rnd.randint(5, 30))) for _ in range(60)]
    rows += ["a b c", "A b  C", "a b c d", "", "one", "one two three four five six", "one two three four five six seven"]
    rnd.shuffle(rows)
    return list(enumerate(rows))


def test_against_brute_force(make_docs, varied):
    assert frame(make_docs(varied)) == brute(varied)


def test_blocks_alone_find_the_same(make_docs, varied, monkeypatch):
    monkeypatch.setattr(N, "HUB_ROUNDS", 0)
    monkeypatch.setattr(N, "BLOCK", 16)
    assert frame(make_docs(varied)) == brute(varied)


def test_cells_are_cut_by_the_bytes_of_their_sets(make_docs, varied, monkeypatch):
    monkeypatch.setattr(N, "HUB_ROUNDS", 1)
    monkeypatch.setattr(N, "SET_BYTES", 5_000)
    assert frame(make_docs(varied)) == brute(varied)


def test_code_estimates_follow_the_similarity():
    rng = np.random.default_rng(3)
    for n in (3, 40, 300, 5000):
        for share in (0.0, 0.75, 1.0):
            errors = []
            for _ in range(20):
                h = np.unique(rng.integers(0, 1 << 63, 3 * n, dtype=np.uint64) * np.uint64(2) + np.uint64(1))
                rng.shuffle(h)
                both = int(round(share * n))
                a, b = np.sort(h[:n]), np.sort(np.concatenate([h[:both], h[n : 2 * n - both]]))
                x, y = N.codes(N.sketches([a, b], N.FINE))
                errors.append(N.code_estimate(x[None], y)[0] - both / (2 * n - both))
                if both / (2 * n - both) >= 0.75:
                    assert errors[-1] >= N.least_code_estimate(0.75) - 0.75
            assert abs(np.mean(errors)) < 0.02


def test_edge_rows(make_docs, edge_rows):
    assert frame(make_docs(edge_rows)) == brute(edge_rows)
    assert N.near_dedup(make_docs(edge_rows).limit(0)).collect() == []


@pytest.mark.parametrize("layout", [N.BANDED, N.FINE])
def test_estimates_follow_the_similarity(layout):
    rng = np.random.default_rng(2)
    for n in (3, 40, 300, 5000):
        for share in (0.2, 0.75, 0.9):
            errors = []
            for _ in range(20):
                h = np.unique(rng.integers(0, 1 << 63, 3 * n, dtype=np.uint64) * np.uint64(2) + np.uint64(1))
                rng.shuffle(h)
                both = int(round(share * n))
                a, b = np.sort(h[:n]), np.sort(np.concatenate([h[:both], h[n : 2 * n - both]]))
                true = both / (2 * n - both)
                agree = np.array([(N.sketches([a], layout) == N.sketches([b], layout)).mean()])
                errors.append(N.estimate(agree, np.array([n]), np.array([n]), layout)[0] - true)
            assert abs(np.mean(errors)) < 4 * 0.5 / np.sqrt(20 * min(layout.registers, n)) + 0.02


def test_shingles_of_few_words():
    a, b, c = N.shingle_sets([b"x y z", b"X  y\nz", b"x y"])
    assert a.tolist() == b.tolist() and a.tolist() != c.tolist() and len(N.shingle_sets([b" \n"])[0]) == 0
