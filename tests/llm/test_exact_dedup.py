import hashlib
import re

import pytest
from llm_fixtures import edge_rows, make_docs  # noqa: F401
from pyspark.sql import functions as F

from quarry.llm import exact_dedup as X


def brute(rows):
    groups = {}
    for i, t in rows:
        groups.setdefault(re.sub(r"[\x20\x09-\x0D]", "", t or ""), []).append((-len(t or ""), i is None, i or 0, i))
    out = []
    for norm, members in groups.items():
        keep = min(members)[3]
        out += [(m[3], keep, len(members), m[3] == keep, hashlib.sha256(norm.encode()).hexdigest()) for m in members]
    return sorted(out, key=repr)


def test_against_brute_force(make_docs, edge_rows):
    got = sorted((tuple(r) for r in X.exact_dedup(make_docs(edge_rows)).collect()), key=repr)
    assert got == brute(edge_rows)


def test_chunks_rebuild_the_text(make_docs, edge_rows):
    docs = make_docs(edge_rows)
    norm = X.normalised(F.coalesce("text", F.lit("")))
    bad = docs.where(F.array_join(X.chunks(norm), "") != norm).count()
    assert bad == 0


def test_colliding_identifiers_take_the_next_digest(make_docs, edge_rows):
    weak = ("weak", lambda c: F.lpad(F.hex(F.length(c) % 3), 2, "0"))
    got = sorted((tuple(r) for r in X.exact_dedup(make_docs(edge_rows), (weak, *X.DIGESTS)).collect()), key=repr)
    assert got == brute(edge_rows)
    with pytest.raises(ValueError, match="identifier"):
        X.exact_dedup(make_docs(edge_rows), (weak,))


def test_large_group_and_empty_table(make_docs):
    rows = [(i, "one and the same " * 50) for i in range(300)] + [(1000 + i, f"other {i}") for i in range(30)]
    assert sorted((tuple(r) for r in X.exact_dedup(make_docs(rows)).collect()), key=repr) == brute(rows)
    assert X.exact_dedup(make_docs(rows).limit(0)).collect() == []


def test_main_path_is_native(make_docs, edge_rows):
    plan = X.exact_dedup(make_docs(edge_rows))._jdf.queryExecution().toString()
    assert not re.search("Python|Arrow|Pandas", plan)
