"""Exact deduplication by sorting contents.

Sampled splitters range-partition the rows by their normalised text, each partition is sorted externally, so that equal
texts end up next to each other, and neighbours are compared in full.  Only built-in functions are used.

Splitters hold the first characters of a text and a hash of all of it, never whole texts: what the sampling brings to the
driver stays small however long the texts are.  A text with more than a twenty-thousandth of all rows (and over
``HOT_ROWS``) is dealt out in pieces by a hash of the identifier; the leaders of its pieces are then compared once more.
There are at most 20,000 such texts and 40,000 such pieces, whatever the input, which bounds what is broadcast.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from hourgrid.llm.common import col, text_of, whole_row

HOT_ROWS = 512
HOT_TEXTS = 20_000
HEAD = 24


def normalised(text: Column) -> Column:
    """Each run of ASCII white space (space, \\t, \\n, \\x0b, \\f, \\r) as one space; nothing is trimmed.

    Plain replacements first, as they work on bytes; the regular expression runs only where spaces repeat.
    """
    for blank in "\t\n\x0b\x0c\r":
        text = F.replace(text, F.lit(blank), F.lit(" "))
    return F.when(F.contains(text, F.lit("  ")), F.regexp_replace(text, " {2,}", " ")).otherwise(text)


def content_groups(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", carry: bool = False) -> DataFrame:
    """One row per input row: ``id``, ``keep_id``, ``group_size``, ``kept``, ``text_sha256``; ``row`` holds the whole row if ``carry``.

    - Null texts count as empty; all empty texts form one group.
    - The row with the smallest identifier stays.  Null identifiers come after all others; of rows that tie, one stays.
    - An empty table gives an empty result.  Other columns are neither read nor changed.
    """
    body = whole_row(docs).alias("row") if carry else text_of(docs, text_col).alias("text")
    base = docs.select(col(id_col).alias("id"), body, F.xxhash64(normalised(text_of(docs, text_col))).alias("hash"))
    text = F.coalesce(F.col("row").getField(text_col).cast("string"), F.lit("")) if carry else F.col("text")

    limit = max(HOT_ROWS, docs.count() // HOT_TEXTS)
    hot = base.groupBy("hash").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") > limit)
    hot = F.broadcast(hot.select("hash", F.ceil(F.col("n") / limit).alias("pieces")))
    piece = F.when(F.col("pieces").isNull(), 0).otherwise(F.pmod(F.xxhash64("id"), F.col("pieces")) + 1)
    dealt = base.join(hot, "hash", "left").withColumn("piece", piece).drop("pieces")

    # the pieces of hot texts, compared in full: leader of a piece -> what the whole group keeps
    leaders = dealt.where("piece > 0").select("id", "piece", normalised(text).alias("norm"))
    leaders = leaders.groupBy("norm", "piece").agg(F.min("id").alias("leader"), F.count(F.lit(1)).alias("n"))
    same = Window.partitionBy("norm")
    merged = leaders.select("leader", F.min("leader").over(same).alias("first"), F.sum("n").over(same).alias("total"), F.sha2("norm", 256).alias("sha"))

    head = F.substring(text, 1, HEAD * 4)
    head = F.when(F.length(normalised(head)) < HEAD, normalised(text)).otherwise(normalised(head))
    ranged = dealt.withColumn("head", F.substring(head, 1, HEAD)).repartitionByRange("head", "hash", "piece")
    run = Window.partitionBy("head", "hash", "piece", "norm")
    in_run = run.orderBy(F.col("id").asc_nulls_last())
    sorted_rows = ranged.withColumn("norm", normalised(text)).select(
        "id", "piece", *(["row"] if carry else []),
        F.sha2("norm", 256).alias("sha"),
        F.first("id").over(in_run).alias("leader"),
        F.row_number().over(in_run).alias("nth"),
        F.count(F.lit(1)).over(run).alias("n"),
    )
    joined = sorted_rows.join(F.broadcast(merged), (F.col("piece") > 0) & sorted_rows["leader"].eqNullSafe(merged["leader"]) & (sorted_rows["sha"] == merged["sha"]), "left")
    keep = F.when(F.col("total").isNull(), sorted_rows["leader"]).otherwise(F.col("first"))
    return joined.select(
        "id", *(["row"] if carry else []), keep.alias("keep_id"),
        F.coalesce("total", "n").alias("group_size"),
        ((F.col("nth") == 1) & F.col("id").eqNullSafe(keep)).alias("kept"),
        sorted_rows["sha"].alias("text_sha256"),
    )


def deduplicate(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows that stay, with the columns and the texts they came with."""
    return content_groups(docs, id_col, text_col, carry=True).where("kept").select("row.*")
