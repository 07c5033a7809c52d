"""Chat formatting of reply trees.

Messages name the message they answer.  Iterative self-joins with doubled steps (parents, then grandparents, and so on)
find for each message its root, the length of the path to it and the sum of scores along it.  Leaves are ranked by the mean
score of their path, and the chosen paths are walked from the leaf by the same doubled steps, the longest first, so that
each message of a path comes up exactly once.  A path of n messages takes about 2 log2(n) joins.

A conversation is written as turns ``### role:`` newline ``text</turn>`` newline.  Inside roles and texts a backslash, ``#``
and ``<`` get a backslash before them (and a newline in a role becomes ``\\n``), so no text can spell a mark, and it can all
be read back.  The loss mask is a list of spans over the formatted string, one for each assistant text.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from hourgrid.llm.common import kept

OPEN, MIDDLE, CLOSE = "### ", ":\n", "</turn>\n"
SPECIAL = re.compile(r"[\\#<]")
ESCAPED = re.compile(r"\\(.)", re.DOTALL)
TURN = re.compile(r"### ((?:[^\\\n]|\\.)*?):\n((?:[^\\<]|\\.)*+)</turn>\n", re.DOTALL)
LEARNED = "assistant"


def escape(text: str, role: bool = False) -> str:
    text = SPECIAL.sub(r"\\\g<0>", text)
    return text.replace("\n", "\\n").replace(":", "\\:") if role else text


def unescape(text: str, role: bool = False) -> str:
    return ESCAPED.sub(lambda m: "\n" if role and m[1] == "n" else m[1], text)


def formatted(turns: list[tuple[str, str]]) -> tuple[str, list[tuple[int, int]]]:
    """A conversation as one string, and the spans of the texts to learn."""
    parts, spans, at = [], [], 0
    for role, text in turns:
        head, body = OPEN + escape(role, True) + MIDDLE, escape(text)
        if role == LEARNED:
            spans.append((at + len(head), at + len(head) + len(body)))
        parts += [head, body, CLOSE]
        at += len(head) + len(body) + len(CLOSE)
    return "".join(parts), spans


def parsed(conversation: str) -> list[tuple[str, str]]:
    """Roles and texts of a formatted conversation."""
    turns, at = [], 0
    while at < len(conversation):
        m = TURN.match(conversation, at)
        if m is None:
            raise ValueError(f"no turn at {at}")
        turns.append((unescape(m[1], True), unescape(m[2])))
        at = m.end()
    return turns


def learned(conversation: str, spans: list[tuple[int, int]]) -> str:
    """All text under the loss mask, unescaped."""
    return "".join(unescape(conversation[a:b]) for a, b in spans)


def chosen_paths(messages: DataFrame, branches: int = 1) -> DataFrame:
    """(``leaf``, ``node``, ``position``) for the best ``branches`` paths of each tree; ``position`` counts from 1 at the root.

    ``messages`` has ``node``, ``parent`` and ``score`` (null: 0).  Leaves are ranked by the mean score of their path, ties by
    the smaller leaf.  A parent that does not exist makes a root; messages on a cycle have no root and are on no path.
    ``node`` must be unique and not null.
    """
    slim = kept(messages.select("node", "parent", F.coalesce("score", F.lit(0.0)).cast("double").alias("score")))
    known = slim.select(F.col("node").alias("parent"), F.lit(True).alias("known"))
    rooted = slim.join(known, "parent", "left").select("node", F.when(F.col("known"), F.col("parent")).alias("up"), "score")
    step = kept(rooted.select("node", "up", F.col("score").alias("total"), F.lit(1).cast("long").alias("length"), F.col("node").alias("top")))
    nodes, steps = step.count(), []
    while step.where("up is not null").limit(1).count() and 1 << len(steps) <= nodes:
        going = step.where("up is not null")  # messages that have reached their root stay as they are
        steps.append(going.select("node", F.col("up").alias("to")))
        above = step.select(F.col("node").alias("up"), F.col("up").alias("up2"), F.col("total").alias("t2"), F.col("length").alias("l2"), F.col("top").alias("top2"))
        far = going.join(above, "up").select(
            "node", F.col("up2").alias("up"), (F.col("total") + F.col("t2")).alias("total"), (F.col("length") + F.col("l2")).alias("length"), F.col("top2").alias("top")
        )
        step = kept(step.where("up is null").unionByName(far))
    parents = slim.select(F.col("parent").alias("node")).where("node is not null").distinct()
    leaves = step.where("up is null").join(parents, "node", "left_anti")
    rank = F.struct((-F.col("total") / F.col("length")).alias("worse"), F.col("node").alias("leaf"))
    leaves = leaves.select("top", F.col("node").alias("leaf"), "length", rank.alias("rank"))
    # first the best of each of many parts of a tree, then the best of those, so that no tree is in one task as a whole
    part = F.pmod(F.xxhash64("leaf"), F.lit(1024)).alias("part")
    for by in (("top", "part"), ("top",)):
        window = Window.partitionBy(*by).orderBy("rank")
        leaves = leaves.withColumn("part", part).withColumn("nth", F.row_number().over(window)).where(F.col("nth") <= branches)
    paths = kept(leaves.select("leaf", F.col("leaf").alias("node"), F.col("length").alias("position")))
    for k in reversed(range(len(steps))):
        paths = kept(paths.unionByName(paths.join(steps[k], "node").select("leaf", F.col("to").alias("node"), (F.col("position") - (1 << k)).alias("position"))))
    return paths


def conversations(messages: DataFrame, branches: int = 1) -> DataFrame:
    """One row per chosen path: ``leaf``, ``conversation``, ``loss_spans``.

    ``messages`` has ``node``, ``parent``, ``score``, ``role`` and ``text``; null roles and texts count as empty, other columns
    are not read.  Without messages there are no rows.
    """
    texts = messages.select("node", F.coalesce(F.col("role").cast("string"), F.lit("")).alias("role"), F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))
    turns = chosen_paths(messages, branches).join(texts, "node").select("leaf", F.struct("position", "role", "text").alias("turn"))
    paths = turns.groupBy("leaf").agg(F.sort_array(F.collect_list("turn")).alias("turns"))
    spans = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))
    schema = f"leaf {messages.schema['node'].dataType.simpleString()}, conversation string, loss_spans array<struct<start: bigint, end: bigint>>"

    def written(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            done = [formatted([(t["role"], t["text"]) for t in turns.as_py()]) for turns in batch.column(1)]
            masks = [[{"start": a, "end": b} for a, b in mask] for _, mask in done]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array([c for c, _ in done], pa.string()), pa.array(masks, spans)], names=["leaf", "conversation", "loss_spans"])

    return paths.mapInArrow(written, schema)
