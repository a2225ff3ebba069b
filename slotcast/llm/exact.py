"""Exact duplicates by content-defined chunk recipes (DataFrame operations only)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from slotcast.session import stage

from .common import GAP, free_name, text_of

#: A chunk ends at the first blank after two letters of these sets, once it has MIN
#: characters; after MAX it ends anywhere.  The text alone decides, so equal passages far
#: from a chunk's start give equal chunks again.
MIN, MAX = 384, 4096
CHUNK = f"(?s).{{{MIN},{MAX - 1}}}?(?<=[adghlo][dehnrst][.,]? )|.{{1,{MAX}}}"


def normalised(text: Column | str) -> Column:
    """Every gap as one blank."""
    return F.regexp_replace(text_of(text), GAP, " ")


def chunk_hash(chunk: Column) -> Column:
    """128 bits: the same hash from two seeds."""
    return F.struct(F.xxhash64(chunk).alias("a"), F.xxhash64(F.lit(1), chunk).alias("b"))


def _chunks(norm: Column) -> Column:
    return F.regexp_extract_all(norm, F.lit(CHUNK), F.lit(0))


def recipes(docs: DataFrame, id_col: str, text_col: str, hashed=chunk_hash) -> DataFrame:
    """(doc_id, text_sha256, recipe) for each row: a text as the ordered list of its chunks'
    identifiers.

    Chunks meet once, by hash and content with a partial distinct on the map side, to verify
    that a hash names one content.  Where it does it is the identifier.  Contents that share a
    hash get their rank within it besides, in a pass over the chunks that runs only then.
    """
    texts = docs.select(
        F.col(id_col).cast("long").alias("doc_id"), normalised(text_col).alias("norm")
    )
    contents = (
        texts.select(F.explode(_chunks(F.col("norm"))).alias("chunk"))
        .select(hashed(F.col("chunk")).alias("h"), "chunk")
        .distinct()
    )
    shared = contents.groupBy("h").agg(F.count("*").alias("n")).where("n > 1").select("h")
    shared = stage(shared)
    plain = texts.select(
        "doc_id",
        F.sha2("norm", 256).alias("text_sha256"),
        F.transform(_chunks(F.col("norm")), hashed).alias("recipe"),
    )
    if shared.isEmpty():
        return stage(plain)
    ranked = (
        contents.join(shared, "h")
        .withColumn("rank", F.row_number().over(Window.partitionBy("h").orderBy("chunk")))
    )
    rows = stage(texts.withColumn("row", F.monotonically_increasing_id()))
    told_apart = (
        rows.select("row", F.posexplode(_chunks(F.col("norm"))).alias("pos", "chunk"))
        .withColumn("h", hashed(F.col("chunk")))
        .join(ranked, ["h", "chunk"], "left")
        .groupBy("row")
        .agg(F.sort_array(F.collect_list(F.struct("pos", "h", F.coalesce("rank", F.lit(0)).alias("rank")))).alias("parts"))
        .select("row", F.transform("parts", lambda p: F.struct(p["h"].alias("h"), p["rank"].alias("rank"))).alias("recipe"))
    )
    told_apart = rows.join(told_apart, "row", "left").select(
        "doc_id",
        F.sha2("norm", 256).alias("text_sha256"),
        F.coalesce("recipe", F.array()).alias("recipe"),
    )
    return stage(told_apart)


def exact_groups(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", hashed=chunk_hash
) -> DataFrame:
    """One row per document: (doc_id, keep_id, group_size, kept, text_sha256).

    Texts are equal when identical after every gap became one blank; of equal texts the
    smallest doc_id stays.  Only recipes are grouped and joined: eight bytes stand for a
    chunk.  Groups are aggregated on the map side before the shuffle.

    Defined cases: null counts as an empty text; empty texts are equal to each other; rows
    that repeat both doc_id and text each count and each give a row; a null doc_id counts
    as the largest; an empty table gives an empty result; other columns are not read.
    """
    rows = recipes(docs, id_col, text_col, hashed)
    keyed = rows.withColumn("key", F.xxhash64("recipe"))
    groups = keyed.groupBy("key", "recipe").agg(
        F.min("doc_id").alias("keep_id"), F.count("*").alias("group_size")
    )
    return keyed.join(groups, ["key", "recipe"]).select(
        "doc_id",
        "keep_id",
        "group_size",
        F.col("doc_id").eqNullSafe(F.col("keep_id")).alias("kept"),
        "text_sha256",
    )


def drop_exact(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows of ``docs`` that stay, with all their columns, one row of each group.

    Ids and hashes decide; the rows that go are joined to the texts, which stay where they are
    as long as Spark finds that list small enough to send.  Rows that repeat both doc_id and
    text are the only ones that are told apart by a further shuffle, where there are any.

    Defined cases: those of ``exact_groups``; of rows that repeat doc_id and text under the
    kept doc_id one stays, whichever it is.
    """
    key, sha = free_name(docs, "row_key"), free_name(docs, "row_sha")
    last = F.lit(2**63 - 1)
    found = exact_groups(docs, id_col, text_col)
    rows = stage(
        found.groupBy(F.coalesce("doc_id", last).alias(key), F.col("text_sha256").alias(sha))
        .agg(F.max("kept").alias("kept"), (F.count("*") > 1).alias("repeated"))
    )
    gone = rows.where(~F.col("kept")).select(key, sha)
    repeated = rows.where("kept and repeated").select(key, sha)
    stay = (
        docs.withColumn(key, F.coalesce(F.col(id_col).cast("long"), last))
        .withColumn(sha, F.sha2(normalised(text_col), 256))
        .join(gone, [key, sha], "left_anti")
    )
    if not repeated.isEmpty():
        once = stay.join(repeated, [key, sha], "left_semi").dropDuplicates([key, sha])
        stay = stay.join(repeated, [key, sha], "left_anti").unionByName(once)
    return stay.select(*[F.col(f"`{c}`") for c in docs.columns])
