import math
import random
import re
from collections import Counter

import pytest
from llm_fixtures import edge_rows  # noqa: F401

from quarry.llm import lexical as L

TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")


def terms(text):
    return TERM.findall("".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or ""))


def brute(items, docs, k=10):
    counted = [(i, t) for i, text in docs if (t := terms(text))]
    n, total = len(counted), sum(len(t) for _, t in counted)
    df = Counter(t for _, ts in counted for t in set(ts))
    out = []
    for item, text in items:
        scored = []
        for doc, ts in counted:
            tf, m = Counter(ts), 100 - 75 + (75 * len(ts) * n) // total
            score = sum(math.floor(1000 * math.log((2 * n + 2) / (2 * df[t] + 1))) * ((10**9 * tf[t]) // (1000 * tf[t] + 8 * m)) for t in terms(text) if tf[t])
            if score > 0:
                scored.append((-score, doc is not None, doc or 0, doc))
        out += [(item, r + 1, doc, -s) for r, (s, _, _, doc) in enumerate(sorted(scored)[:k])]
    return sorted(out, key=repr)


def search(spark, items, docs, **kw):
    i = spark.createDataFrame([(*r, 7, "x") for r in items], "item_id long, text string, rank int, term string")
    d = spark.createDataFrame([(*r, 7, 8, "y") for r in docs], "doc_id long, text string, n long, score long, item string").repartition(4)
    df = L.ranked_search(i, d, **kw)
    assert df.dtypes == [("item_id", "bigint"), ("rank", "int"), ("doc_id", "bigint"), ("score", "bigint")]
    return sorted(((r.item_id, r["rank"], r.doc_id, r.score) for r in df.collect()), key=repr)


def corpus(n, seed):
    rnd = random.Random(seed)
    words = [f"w{int(rnd.paretovariate(0.6))}" for _ in range(4000)]
    text = lambda m: " ".join(rnd.choice(words) for _ in range(m))
    return [(i, text(rnd.randrange(1, 60))) for i in range(n)], [(i, text(rnd.randrange(1, 12))) for i in range(30)]


@pytest.mark.parametrize("batch_bytes", [1 << 20, 200])  # at once, or in several passes
def test_against_brute_force(spark, monkeypatch, batch_bytes):
    monkeypatch.setattr(L, "DOC_TILE", 37)
    monkeypatch.setattr(L, "ITEM_TILE", 4)
    monkeypatch.setattr(L, "BATCH_BYTES", batch_bytes)
    docs, items = corpus(300, 1)
    docs += [(1000 + i, docs[5][1]) for i in range(40)]  # copies tie
    assert search(spark, items, docs) == brute(items, docs)
    assert search(spark, items, docs, k=3) == brute(items, docs, 3)


def test_edge_rows(spark, edge_rows):  # noqa: F811
    items = [(1, None), (2, ""), (3, "—"), (4, "text TEXT seven unknownterm"), (4, "id"), (None, "nbsp wide K é"), (6, "word5 more xxx"), (7, "漢字 🙂 i̇"), (8, "nothing-there"), (9, "a\x00a1z,THE")]
    docs = edge_rows + [(None, "text"), (20, "text"), (21, "A\x00a1z the"), (22, "text " * 5000)]
    assert search(spark, items, docs) == brute(items, docs)
    assert search(spark, items, docs[:1]) == [] == search(spark, items[:2], docs)
    d = spark.createDataFrame([(1, "a")], "doc_id long, text string")
    i = spark.createDataFrame([(1, "a")], "item_id long, text string")
    assert L.ranked_search(i, d.limit(0)).collect() == [] == L.ranked_search(i.limit(0), d).collect()


def test_terms_are_the_contract_s():
    every = "".join(map(chr, range(0x250))) + "漢字 🙂 K İ  x"
    assert [t.decode() for t in L.terms_of(every.encode())] == terms(every)


def test_partial_sums_stay_exact(spark, monkeypatch):
    monkeypatch.setattr(L, "EXACT", 3 * 10**9)  # vocabularies are cut into several products
    docs, items = corpus(120, 2)
    assert search(spark, items, docs) == brute(items, docs)
    tile = L.Tile(0, [{0: 1, 1: 1, 2: 1}], L.np.array([2000, 2000, 2000]))
    assert len(tile.parts) == 3
    with pytest.raises(OverflowError):
        L.Tile(0, [{0: 4000}], L.np.array([2000]))
