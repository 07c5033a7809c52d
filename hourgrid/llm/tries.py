"""Prefix trie of conversations by whole-sequence collapse.

Turns become two 64-bit hashes and a length; a prefix is known by its depth and by two sums over hashes of (place, turn),
128 bits in all, so prefixes of a conversation of any length are running sums over blocks of turns and need no list.

Identical conversations collapse to one weighted sequence, kept by its smallest member, with the list of those that end
there.  Sequences that are no proper prefix of another one, found by an anti-join, are the leaves.  A node's members and
leaves are sums of weights over the sequences through it.

What a subtree saves is not summed over pairs of a node and its descendants, but over sequences: with T the code points of
a whole sequence and P those before a node, the members' turns from the node on have sum(weight * T) - members * P, and the
distinct nodes among them are told apart by their owner, the sequence with the smallest member through them.  A sequence
that owns a node owns all below it on its way, so the subtree holds everything that its other sequences own, and what the
owner of its top has from there on.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from hourgrid.llm.common import col, kept

BLOCK = 1024  # turns of a conversation that are summed in one window
IDS = 4096  # identifiers of a chunk of an end list
KEY = ["k1", "k2"]


def _hash(seed: int, *columns: Column | str) -> Column:
    return F.xxhash64(F.lit(seed), *columns)


def ordered_turns(conversations: DataFrame, id_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role", text_col: str = "text") -> DataFrame:
    """Turns without their texts: ``conv``, ``pos`` from 1, hashes ``a`` and ``b`` of role and text, ``size`` of the text.

    Ordered by turn, nulls first, then by role and text; null roles and texts are empty; rows without identifier are left
    out.  Rows are sorted by range, and places are counted per range and shifted by the ranges before it, so a single
    conversation may have any share of the rows.
    """
    text, role = (F.coalesce(col(c).cast("string"), F.lit("")) for c in (text_col, role_col))
    given = conversations.select(col(id_col).alias("conv"), col(turn_col).alias("turn"), role.alias("role"), text.alias("text")).where("conv IS NOT NULL")
    order = ["conv", F.col("turn").asc_nulls_first(), "role", "text"]
    in_order = given.repartitionByRange(*order).sortWithinPartitions(*order)
    slim = kept(in_order.select(
        "conv", F.spark_partition_id().alias("part"), F.monotonically_increasing_id().alias("at"),
        _hash(1, "role", "text").alias("a"), _hash(2, "role", "text").alias("b"), F.length("text").cast("long").alias("size"),
    ))
    before = Window.partitionBy("conv").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    counts = slim.groupBy("conv", "part").agg(F.count(F.lit(1)).alias("n"))
    shifts = counts.withColumn("shift", F.sum("n").over(before)).where("shift > 0").select("conv", "part", "shift")
    inside = F.row_number().over(Window.partitionBy("conv", "part").orderBy("at"))
    numbered = slim.withColumn("place", inside).join(shifts, ["conv", "part"], "left")
    return numbered.select("conv", (F.col("place") + F.coalesce("shift", F.lit(0))).cast("long").alias("pos"), "a", "b", "size")


def prefixes(turns: DataFrame) -> DataFrame:
    """Each turn's prefix: ``conv``, ``pos``, its key ``k1``, ``k2``, its parent's ``p1``, ``p2``, ``size`` and ``upto``, the code points so far."""
    marks = [_hash(0, c, "pos").cast("decimal(20,0)").alias(f"m{c}") for c in ("a", "b")]
    cut = turns.select("conv", "pos", "size", *marks, F.floor((F.col("pos") - 1) / BLOCK).alias("block"))
    sums = ["ma", "mb", "size"]
    inside = Window.partitionBy("conv", "block").orderBy("pos").rowsBetween(Window.unboundedPreceding, 0)
    before = Window.partitionBy("conv").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    blocks = cut.groupBy("conv", "block").agg(*[F.sum(c).alias(c) for c in sums])
    shifts = blocks.select("conv", "block", *[F.sum(c).over(before).alias(f"before_{c}") for c in sums]).where("block > 0")
    run = cut.select("*", *[F.sum(c).over(inside).alias(f"run_{c}") for c in sums]).join(shifts, ["conv", "block"], "left")
    total = {c: F.col(f"run_{c}").cast("decimal(38,0)") + F.coalesce(F.col(f"before_{c}").cast("decimal(38,0)"), F.lit(0)) for c in sums}
    upto = [total[c].cast("decimal(38,0)") for c in ("ma", "mb")]
    parent = [(total[c] - F.col(c)).cast("decimal(38,0)") for c in ("ma", "mb")]
    return run.select(
        "conv", "pos", *_key(F.col("pos"), upto, "k"), *_key(F.col("pos") - 1, parent, "p"), "size", total["size"].cast("long").alias("upto")
    )


def _key(depth: Column, sums: list[Column], name: str) -> list[Column]:
    # the root's sums are nothing but zero
    return [_hash(n, depth.cast("long"), *[s.cast("decimal(38,0)") for s in sums]).alias(f"{name}{n}") for n in (1, 2)]


def _root() -> list[Column]:
    return _key(F.lit(0), [F.lit(0), F.lit(0)], "k")


def end_digests(ends: DataFrame) -> DataFrame:
    """Per key SHA-256 of its identifiers, ascending, in decimal, comma-joined.

    Identifiers are sorted by range and joined to chunks of at most IDS; a list of any length is hashed chunk by chunk.
    """
    order, most = [*KEY, "conv"], IDS
    in_order = ends.select(*order).repartitionByRange(*order).sortWithinPartitions(*order)

    def chunked(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            k1, k2 = (batch.column(k).to_numpy() for k in (0, 1))
            n = batch.num_rows
            new = np.append(True, (k1[1:] != k1[:-1]) | (k2[1:] != k2[:-1]))[:n]
            start = np.flatnonzero(new)
            place = np.arange(n) - np.repeat(start, np.diff(np.append(start, n)))
            start = np.flatnonzero(place % most == 0)
            names = list(map(str, batch.column(2).to_pylist()))
            joined = [",".join(names[a:b]) for a, b in zip(start.tolist(), [*start[1:].tolist(), n])]
            at = pa.array(start)
            yield pa.RecordBatch.from_arrays([*(batch.column(k).take(at) for k in range(3)), pa.array(joined, pa.string())], names=["k1", "k2", "first", "ids"])

    kind = ends.schema["conv"].dataType.simpleString()
    chunks = in_order.mapInArrow(chunked, f"k1 long, k2 long, first {kind}, ids string")
    lists = chunks.repartition(*KEY).sortWithinPartitions(*KEY, "first").select(*KEY, "ids")

    def hashed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, state = None, None
        for batch in batches:
            done = []
            for k1, k2, ids in zip(*(c.to_pylist() for c in batch.columns)):
                if (k1, k2) == key:
                    state.update(b",")
                else:
                    if key is not None:
                        done.append((*key, state.hexdigest()))
                    key, state = (k1, k2), hashlib.sha256()
                state.update(ids.encode())
            if done:
                yield rows(done)
        if key is not None:
            yield rows([(*key, state.hexdigest())])

    def rows(done: list[tuple[int, int, str]]) -> pa.RecordBatch:
        columns = zip(*done)
        return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, (pa.int64(), pa.int64(), pa.string()))], names=["k1", "k2", "digest"])

    return lists.mapInArrow(hashed, "k1 long, k2 long, digest string")


def prefix_trie(turns: DataFrame, members: DataFrame) -> DataFrame:
    """One row per distinct prefix of the conversations ``members`` (``conv``), whose ``turns`` come as from ``ordered_turns``.

    ``conv_id`` (smallest member), ``depth``, ``parent_conv_id``, ``n_convs``, ``n_children``, ``n_leaves``,
    ``saved_tokens``, ``ends_sha256``.

    - Members without turns belong to the root alone.  ``members`` are distinct and not null; no member, no row.
    - ``saved_tokens`` sums (members - 1) x code points of the last text over the subtree.
    """
    steps = kept(prefixes(turns))
    last = steps.groupBy("conv").agg(F.max_by("k1", "pos").alias("k1"), F.max_by("k2", "pos").alias("k2"), F.max("upto").alias("total"))
    k1, k2 = _root()
    ends = kept(members.select("conv").join(last, "conv", "left").select(
        "conv", F.coalesce("k1", k1).alias("k1"), F.coalesce("k2", k2).alias("k2"), F.coalesce("total", F.lit(0)).cast("long").alias("total")
    ))
    whole = ends.groupBy(*KEY).agg(F.count(F.lit(1)).alias("weight"), F.min("conv").alias("conv"), F.max("total").alias("total"))
    inner = steps.select(F.col("p1").alias("k1"), F.col("p2").alias("k2")).distinct()
    leaves = whole.join(inner, KEY, "left_anti").select("conv", "weight", "total", F.lit(1).cast("long").alias("leaf"))
    others = whole.join(inner, KEY, "left_semi").select("conv", "weight", "total", F.lit(0).cast("long").alias("leaf"))
    sequences = kept(leaves.unionByName(others))

    top = sequences.select(
        "conv", F.lit(0).cast("long").alias("pos"), k1.alias("k1"), k2.alias("k2"), F.lit(None).cast("long").alias("p1"), F.lit(None).cast("long").alias("p2"),
        F.lit(0).cast("long").alias("size"), F.lit(0).cast("long").alias("upto"), "weight", "total", "leaf",
    )
    through = kept(steps.join(sequences, "conv").select(*top.columns).unionByName(top))
    nodes = kept(through.groupBy(*KEY).agg(
        F.min("conv").alias("conv_id"), *[F.max(c).alias(c) for c in ("pos", "p1", "p2", "size", "upto")],
        F.sum("weight").alias("n_convs"), F.sum("leaf").alias("n_leaves"), F.sum(F.col("weight") * F.col("total")).alias("said"),
    ))
    owned = nodes.groupBy(F.col("conv_id").alias("conv")).agg(F.sum("size").alias("owned"))
    sizes = kept(sequences.join(owned, "conv", "left").select("conv", "total", F.coalesce("owned", F.lit(0)).cast("long").alias("owned")))
    below = through.select("conv", *KEY).join(sizes.select("conv", "owned"), "conv").groupBy(*KEY).agg(F.sum("owned").alias("below"))
    children = nodes.where("p1 IS NOT NULL").groupBy(F.col("p1").alias("k1"), F.col("p2").alias("k2")).agg(F.count(F.lit(1)).alias("n_children"))
    found = nodes.join(below, KEY).join(children, KEY, "left").join(end_digests(ends), KEY, "left")
    found = found.join(sizes.select(F.col("conv").alias("conv_id"), F.col("total").alias("own_total"), "owned"), "conv_id")
    parents = nodes.select(F.col("k1").alias("p1"), F.col("k2").alias("p2"), F.col("conv_id").alias("parent_conv_id"))
    found = found.join(parents, ["p1", "p2"], "left")
    above = F.col("upto") - F.col("size")
    distinct = F.col("below") - F.col("owned") + F.col("own_total") - above
    return found.select(
        "conv_id", F.col("pos").alias("depth"), "parent_conv_id", "n_convs", F.coalesce("n_children", F.lit(0)).cast("long").alias("n_children"), "n_leaves",
        (F.col("said") - F.col("n_convs") * above - distinct).cast("long").alias("saved_tokens"), F.coalesce("digest", F.lit(hashlib.sha256(b"").hexdigest())).alias("ends_sha256"),
    )
