"""Fixtures of the training-data operators' tests, imported where they are used."""

import pytest

DOC_SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, shard int, rank int, score double, bucket long, node long"


@pytest.fixture
def make_docs(spark):
    """Documents from (doc_id, text), with extra columns whose names the operators use inside."""

    def make(rows, partitions=3):
        full = [(i, t, "en", "s", None, 7, 8, 0.5, 9, 10) for i, t in rows]
        return spark.createDataFrame(full, DOC_SCHEMA).repartition(partitions)

    return make


@pytest.fixture
def edge_rows():
    """Nulls, empty and blank texts, a very long text, ties, repeated rows, odd characters."""
    long = " ".join(f"word{i % 977} and more," for i in range(40_000))
    return [
        (1, None), (2, ""), (3, " \t\r\n\x0b\x0c "), (4, "Same text here, with seven words."), (5, "Same text here, with seven words."),
        (6, "Same  text here,\nwith seven words. "), (7, long), (8, "a"), (9, "é ñ 漢字 🙂 ﬁ İ K ́x"), (10, "<|endoftext|> in <|startoftext|>the text"),
        (11, "x" * 3000), (11, "x" * 3000), (None, "a text without an id"), (12, "  two  spaces \n\n lines nbsp 　wide"), (13, "don't we'll I'm THE 123 4,5!"),
    ]
