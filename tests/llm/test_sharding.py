import zlib
from collections import Counter

import pytest
from llm_fixtures import edge_rows, make_docs  # noqa: F401

from quarry.llm.sharding import POSITIONS, Ring, place, shard_documents


def check(rows, docs, shards):
    counts = Counter(r.shard for r in rows)
    sizes = [counts.get(s, 0) for s in range(shards)]
    assert len(rows) == len(docs) and max(sizes) - min(sizes) <= 1
    for s in range(shards):
        assert sorted(r.slot for r in rows if r.shard == s) == list(range(counts.get(s, 0)))
    want = sorted((repr(i), len((t or "").encode()) + 8, zlib.crc32((t or "").encode())) for i, t in docs)
    assert sorted((repr(r.doc_id), r.size, r.text_crc32) for r in rows) == want
    assert all(r.law == "rows" and r.grown_shard is None for r in rows)


def test_edge_rows(make_docs, edge_rows):
    check(shard_documents(make_docs(edge_rows)).collect(), edge_rows, 24)
    assert shard_documents(make_docs(edge_rows).limit(0)).collect() == []


def test_hot_key_overflows_clockwise(make_docs):
    docs = [(5, "the same id")] * 400 + [(i, f"text {i}") for i in range(10, 810)]
    rows = shard_documents(make_docs(docs), shards=7).collect()
    check(rows, docs, 7)
    assert len({r.shard for r in rows if r.doc_id == 5}) > 1


def test_most_rows_stay_at_home(make_docs):
    docs = [(i, f"text {i}") for i in range(4000)]
    rows = shard_documents(make_docs(docs), shards=8, vnodes=512).collect()
    assert sum(r.shard == r.home_shard for r in rows) > 0.85 * len(rows)


def test_ring_and_plan():
    ring = Ring.of(5, 20)
    assert len(ring.points) == 100 and len(ring.arcs()) == POSITIONS
    assert Ring.of(6, 20).points != ring.points and set(ring.points) <= set(Ring.of(6, 20).points) | set(ring.points)
    counts = {a: a % 7 for a in range(100)}
    total = sum(counts.values())
    room = [total // 5 + (s < total % 5) for s in range(5)]
    runs = place(ring, counts, room)
    assert len(runs) <= 100 + 5
    for arc, n in counts.items():
        ranks = sorted(r for a, b, e, _, _ in runs if a == arc for r in range(b, e))
        assert ranks == list(range(n))
    with pytest.raises(ValueError):
        Ring.of(1000, 1000)
