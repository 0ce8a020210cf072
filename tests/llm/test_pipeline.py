from conftest import SMOKE_DIR
from llm_fixtures import edge_rows, make_docs  # noqa: F401
from test_exact_dedup import brute as exact_brute
from test_near_dedup import brute as near_brute
from test_tokens import BYTE, check_packing
from tokenizers import Tokenizer

import corpus_pipeline as P
from quarry.llm.queries import QUERIES, documents, labels
from quarry.llm.quality import score_quality
from quarry.llm.shared import BATCH_BYTES
from quarry.llm.toxicity import score_toxicity


def test_stages_against_brute_force(spark):
    """Each stage on what the one before kept: scores by the operators, groups by brute force."""
    docs = documents(spark, SMOKE_DIR).select(*P.COLUMNS)
    for name, stage in P.STAGES[:-1]:
        rows = [(r.doc_id, r.text) for r in docs.collect()]
        out = stage(spark, docs, SMOKE_DIR)
        assert out.columns == P.COLUMNS and out.dtypes == docs.dtypes
        if name == "toxicity":
            want = {r.doc_id for r in score_toxicity(docs, labels(spark, SMOKE_DIR)).collect() if r.predicted == 0}
        elif name == "quality":
            want = {r.doc_id for r in score_quality(docs, labels(spark, SMOKE_DIR)).collect() if r.predicted == 1}
        else:
            want = {r[0] for r in (exact_brute if name == "exact dedup" else near_brute)(rows) if r[3]}
        kept = {r.doc_id: r.text for r in out.collect()}
        assert kept.keys() == want and all(kept[i] == t for i, t in rows if i in kept)
        docs = spark.createDataFrame(out.collect(), out.schema)
    packed = P.STAGES[-1][1](spark, docs, SMOKE_DIR).collect()
    check_packing(packed, [(r.doc_id, r.text) for r in docs.collect()], Tokenizer.from_file(BYTE))
    whole = QUERIES["pipeline"](spark, SMOKE_DIR).collect()
    assert {(r.doc_id, r.piece, r.ids_crc32) for r in whole} == {(r.doc_id, r.piece, r.ids_crc32) for r in packed}


def test_stage_edge_rows(spark, make_docs, edge_rows):
    docs = make_docs(edge_rows).select(*P.COLUMNS)
    for _, stage in P.STAGES:
        assert stage(spark, docs.limit(0), SMOKE_DIR).collect() == []
        stage(spark, docs, SMOKE_DIR).collect()


def test_repeated_and_null_ids_bring_no_copy_back(spark, make_docs):
    text = "a text of ten words that several rows have in common"
    near = text + " and ends in other words that are its own here"
    rows = [(1, text), (1, text), (1, text.replace(" ", "  ")), (None, text), (None, text), (None, near + " x"), (None, near + " y"), (2, near + " z"), (2, near + " z z"), (None, None), (None, None), (3, "")]
    docs = make_docs(rows).select(*P.COLUMNS)
    exact = dict(P.STAGES)["exact dedup"](spark, docs, SMOKE_DIR)
    squeezed = ["".join((r.text or "").split()) for r in exact.collect()]
    assert len(squeezed) == len(set(squeezed)) == len({"".join((t or "").split()) for _, t in rows})
    assert exact.columns == P.COLUMNS and exact.dtypes == docs.dtypes
    chosen = {"".join((r.text or "").split()): (r.doc_id, r.text) for r in exact.collect()}
    assert chosen["".join(text.split())] == (1, text.replace(" ", "  ")) and chosen[""][0] == 3
    left = dict(P.STAGES)["near dedup"](spark, docs, SMOKE_DIR)
    assert left.columns == P.COLUMNS and left.dtypes == docs.dtypes
    # every set is one row; rows without words stay, as they are linked with nothing
    assert sorted(r.doc_id for r in left.where("text like 'a%'").collect()) == [1, 2]
    assert left.where("trim(coalesce(text, '')) = ''").count() == 3


def test_stages_bound_their_batches(spark):
    """Each stage by itself, in whatever session its caller has."""
    for name, stage in P.STAGES:
        if name == "exact dedup":
            continue  # no Python in it
        own = spark.newSession()
        own.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(64 << 20))
        rows = [(i, f"text number {i} of a few", "en", "s", 20) for i in range(5)]
        docs = own.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
        assert stage(own, docs, SMOKE_DIR).count() > 0 or name in ("toxicity", "quality")
        assert int(own.conf.get("spark.sql.execution.arrow.maxBytesPerBatch")) <= BATCH_BYTES


def test_results_do_not_hang_on_batches(spark):
    """Every stage over batches of some rows gives what it gives over one batch."""
    docs = documents(spark, SMOKE_DIR).select(*P.COLUMNS)
    rows, kinds, found = docs.collect(), docs.schema, []
    for bound in (BATCH_BYTES, 20_000):
        own = spark.newSession()
        own.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(bound))
        docs = own.createDataFrame(rows, kinds)
        found.append([])
        for _, stage in P.STAGES:
            out = stage(own, docs, SMOKE_DIR)
            names = [c for c in out.columns if c not in ("sequence_id", "offset")]
            found[-1].append(sorted(map(tuple, out.select(names).collect()), key=repr))
            docs = own.createDataFrame(out.collect(), out.schema)
    for (name, _), one, other in zip(P.STAGES, *found, strict=True):
        assert one == other and one, name
