"""Exact duplicates by content-defined chunk recipes, in DataFrame functions only.

A text, without white space, is cut where its own characters say so.  Each distinct chunk
gets an identifier, a digest of its content; the chunk dictionary verifies that no two
different chunks share one (else the next longer digest is taken).  A document then is its
recipe, the ordered list of its chunk identifiers: about one byte for 20 of text.  Documents
are compared, grouped and joined by recipes alone; a chunk's content moves once, combined on
the map side, for the dictionary.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quarry.llm.shared import text_of, written

#: fixed values: the characters that equality ignores
WHITE_SPACE = " \t\n\x0b\x0c\r"

#: A chunk holds at least MIN_CHARS characters (the last one of a text may be shorter) and at most MAX_CHARS.
MIN_CHARS, MAX_CHARS = 256, 4096

#: Identifiers in the order they are tried: digest name, hexadecimal digest of a chunk.
DIGESTS = (("md5", lambda c: F.md5(c)), ("sha256", lambda c: F.sha2(c, 256)))


def normalised(text: Column) -> Column:
    return reduce(lambda c, ch: F.replace(c, F.lit(ch)), WHITE_SPACE, text)


def chunk_pattern(min_chars: int = MIN_CHARS, max_chars: int = MAX_CHARS) -> str:
    """A chunk ends after two characters whose code points leave 1 modulo 8 (up to U+024F;
    texts in other scripts are cut at ``max_chars``)."""
    cut = "".join(f"\\x{{{c:x}}}" for c in range(0x21, 0x250) if c % 8 == 1)
    return f"(?s).{{{min_chars},{max_chars}}}?(?<=[{cut}][{cut}])|.{{1,{max_chars}}}"


def chunks(norm: Column, pattern: str | None = None) -> Column:
    return F.regexp_extract_all(norm, F.lit(pattern or chunk_pattern()), F.lit(0))


def chunk_collisions(docs: DataFrame, digest, pattern: str | None = None) -> DataFrame:
    """Identifiers that stand for more than one distinct chunk (none is the rule)."""
    dictionary = (
        docs.select(F.explode(chunks(normalised(text_of()), pattern)).alias("chunk"))
        .select(F.unhex(digest(F.col("chunk"))).alias("id"), "chunk")
        .groupBy("id", "chunk")
        .agg(F.lit(1).alias("one"))
    )
    return dictionary.groupBy("id").agg(F.count("*").alias("n")).where("n > 1").select("id")


def sound_digest(docs: DataFrame, digests=DIGESTS, pattern: str | None = None):
    """(name, function) of the first digest under which no two chunks share an identifier."""
    for name, digest in digests:
        if chunk_collisions(docs, digest, pattern).isEmpty():
            return name, digest
    raise ValueError("distinct chunks share an identifier under every digest")


def recipes(docs: DataFrame, digest, pattern: str | None = None, carry: tuple[str, ...] = ()) -> DataFrame:
    """(doc_id, chars, sha, recipe) and the columns ``carry``: code points of the whole text, SHA-256 of the
    normalised text, and the identifiers of its chunks one after the other."""
    norm = docs.select("doc_id", *carry, F.length(text_of()).cast("long").alias("chars"), normalised(text_of()).alias("norm"))
    return norm.select(
        "doc_id",
        *carry,
        "chars",
        F.unhex(F.sha2("norm", 256)).alias("sha"),
        F.unhex(F.array_join(F.transform(chunks(F.col("norm"), pattern), digest), "")).alias("recipe"),
    )


def exact_dedup(docs: DataFrame, digests=DIGESTS, pattern: str | None = None) -> DataFrame:
    """One row per row of ``docs`` (doc_id, text): doc_id, keep_id, group_size, kept,
    text_sha256 (lower-case hex of the normalised text in UTF-8).

    Texts are equal when identical without white space ([\\x20\\x09-\\x0D]); null counts as
    empty, and empty texts are equal to one another.  The row with the most code points
    in the original text stays, then the one with the smallest doc_id (null ids last).  Rows
    that repeat a doc_id are rows of their own and all carry its verdict.  Other columns
    are ignored; an empty table gives no rows.  Building the frame runs the dictionary check
    and writes the recipes to the shared folder."""
    docs = docs.select("doc_id", "text")
    name, digest = sound_digest(docs, digests, pattern)
    lists = written(recipes(docs, digest, pattern), f"recipes-{name}")
    best = F.min(F.struct((-F.col("chars")).alias("c"), F.col("doc_id").isNull().alias("u"), "doc_id"))
    groups = (
        lists.groupBy("recipe")
        .agg(F.count(F.lit(1)).alias("n"), best.alias("best"))
        .where("n > 1")
        .select("recipe", F.col("n").alias("group_size"), F.col("best.doc_id").alias("keep"))
    )
    # written, so that both sides of the join come from an exchange and a large group can be split
    joined = lists.join(written(groups, "recipe-groups"), "recipe", "left")
    alone = F.col("group_size").isNull()
    keep = F.when(alone, F.col("doc_id")).otherwise(F.col("keep"))
    return joined.select(
        "doc_id",
        keep.alias("keep_id"),
        F.coalesce("group_size", F.lit(1)).cast("long").alias("group_size"),
        F.col("doc_id").eqNullSafe(keep).alias("kept"),
        F.lower(F.hex("sha")).alias("text_sha256"),
    )


def without_copies(docs: DataFrame, digests=DIGESTS, pattern: str | None = None) -> DataFrame:
    """The rows of ``docs`` (doc_id, text and any others), one of each group of equal texts: the one that
    ``exact_dedup`` names, and of several rows with its doc_id and length one.  Rows are told apart by
    a number of their own, so null and repeated ids bring no copy back."""
    whole = docs.select(F.struct(*docs.columns).alias("_row_of_docs"), F.monotonically_increasing_id().alias("_row"))
    whole = written(whole, "numbered")
    named = whole.select("_row_of_docs.doc_id", "_row_of_docs.text", "_row")
    name, digest = sound_digest(named, digests, pattern)
    lists = written(recipes(named, digest, pattern, ("_row",)).drop("sha"), f"recipes-{name}")
    best = F.min(F.struct((-F.col("chars")).alias("c"), F.col("doc_id").isNull().alias("u"), "doc_id", "_row"))
    groups = lists.groupBy("recipe").agg(F.count(F.lit(1)).alias("n"), best.alias("best")).where("n > 1")
    groups = written(groups.select("recipe", F.col("best._row").alias("_keep")), "recipe-groups")
    copies = lists.join(groups, "recipe").where("_row <> _keep").select("_row")
    return whole.join(copies, "_row", "left_anti").select("_row_of_docs.*")
