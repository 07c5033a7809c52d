"""Quality classifier: histogram gradient-boosted trees over statistics of a document.

Statistics are computed by Spark tasks over whole texts.  The trees are fitted with numpy on a bounded sample of labelled
rows (``SAMPLE_ROWS``, those whose identifiers hash lowest), as complete binary trees: their split features, split bins and
leaf values are plain arrays, and a batch of documents walks down all levels of a tree at once.
"""

from __future__ import annotations

import math
import re
import zlib
from collections import Counter
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from hourgrid.llm.common import col, text_of

SAMPLE_ROWS = 20_000
THRESHOLD = 0.3
BINS = 64
DEPTH = 4
TREES = 80
RATE = 0.15
LEAST_WEIGHT = 3.0  # hessian in a leaf
RIDGE = 1.0

_SYMBOLS = re.compile(r"[^\w\s]")
_DIGITS = re.compile(r"\d")
_UPPER = re.compile(r"[A-ZÀ-ÖØ-Þ]")
_END = re.compile(r"[.!?]['\")\]]?(?=\s|$)")
_RUN = re.compile(r"([^\w\s])\1+")

STATISTICS = (
    "log_chars log_words mean_word sd_word symbols digits upper ends_per_word symbol_runs distinct_words top_word repeated_neighbours "
    "repeated_pairs short_words long_words log_lines words_per_line repeated_lines short_lines bare_symbols deflated letters_entropy "
    "ended capital_words comma_rate"
).split()


def statistics(text: str) -> list[float]:
    """Numbers that describe one whole text; all zero for a text without words."""
    words = text.split()
    n, chars = len(words), len(text)
    if not n:
        return [0.0] * len(STATISTICS)
    sizes = np.fromiter(map(len, words), np.int32, n)
    counts = Counter(words)
    pairs = Counter(zip(words, words[1:]))
    lines = [x for x in text.split("\n") if x.strip()]
    line_counts = Counter(lines)
    raw = text.encode("utf-8")
    freq = np.bincount(np.frombuffer(raw, np.uint8), minlength=256)
    share = freq[freq > 0] / len(raw)
    symbols = len(_SYMBOLS.findall(text))
    return [
        math.log1p(chars), math.log1p(n), float(sizes.mean()), float(sizes.std()), symbols / chars,
        len(_DIGITS.findall(text)) / chars, len(_UPPER.findall(text)) / chars, len(_END.findall(text)) / n, len(_RUN.findall(text)) / n,
        len(counts) / n, max(counts.values()) / n, sum(a == b for a, b in zip(words, words[1:])) / n,
        1 - len(pairs) / max(1, n - 1), float((sizes <= 3).mean()), float((sizes > 12).mean()),
        math.log1p(len(lines)), n / len(lines), 1 - len(line_counts) / len(lines), sum(len(x) < 30 for x in lines) / len(lines),
        sum(c for w, c in counts.items() if not any(map(str.isalnum, w))) / n,
        len(zlib.compress(raw, 1)) / len(raw), float(-(share * np.log2(share)).sum()),
        float(text.rstrip()[-1] in ".!?\"')"), sum(c for w, c in counts.items() if w[:1].isupper()) / n, text.count(",") / n,
    ]


@dataclass
class Trees:
    """Complete binary trees as arrays: features and bins of the inner nodes by level, values of the leaves."""

    edges: np.ndarray  # [feature, BINS - 1], upper bounds of the bins
    feature: np.ndarray  # [tree, inner node]
    bin: np.ndarray  # [tree, inner node]; rows above go right
    value: np.ndarray  # [tree, leaf]
    prior: float

    def binned(self, x: np.ndarray) -> np.ndarray:
        return np.stack([np.searchsorted(e, c, "left") for e, c in zip(self.edges, x.T)], axis=1).astype(np.uint8)

    def score(self, x: np.ndarray) -> np.ndarray:
        binned, logit = self.binned(x), np.full(len(x), self.prior)
        rows, inner = np.arange(len(x)), self.feature.shape[1]
        for feature, cut, value in zip(self.feature, self.bin, self.value):
            node = np.zeros(len(x), np.int64)
            while len(node) and node[0] < inner:  # all rows are on one level
                node = 2 * node + 1 + (binned[rows, feature[node]] > cut[node])
            logit += value[node - inner]
        return 1 / (1 + np.exp(-logit))


def fit(x: np.ndarray, y: np.ndarray, trees: int = TREES, depth: int = DEPTH, rate: float = RATE) -> Trees:
    """Boosted trees for the log loss, level by level, splits found on histograms of gradients.

    Without rows the score is 0.5 everywhere, with a single class it is close to that class.
    """
    n, width = x.shape
    inner, leaves = 2**depth - 1, 2**depth
    share = (y.sum() + 0.5) / (n + 1)
    edges = np.quantile(x, np.linspace(0, 1, BINS + 1)[1:-1], axis=0).T if n else np.zeros((width, BINS - 1))
    model = Trees(edges, np.zeros((trees, inner), np.int64), np.full((trees, inner), BINS, np.int64), np.zeros((trees, leaves)), math.log(share / (1 - share)))
    if not n:
        return model
    binned = model.binned(x).astype(np.int64)
    logit = np.full(n, model.prior)
    rows = np.arange(n)
    for t in range(trees):
        p = 1 / (1 + np.exp(-logit))
        grad, hess = y - p, p * (1 - p)
        node = np.zeros(n, np.int64)
        for level in range(depth):
            nodes, first = 2**level, 2**level - 1
            best = np.zeros(nodes)
            for f in range(width):
                at = (node - first) * BINS + binned[:, f]
                g = np.bincount(at, grad, nodes * BINS).reshape(nodes, BINS).cumsum(axis=1)
                h = np.bincount(at, hess, nodes * BINS).reshape(nodes, BINS).cumsum(axis=1)
                left, right = h, h[:, -1:] - h
                gain = g**2 / (left + RIDGE) + (g[:, -1:] - g) ** 2 / (right + RIDGE) - g[:, -1:] ** 2 / (h[:, -1:] + RIDGE)
                gain[(left < LEAST_WEIGHT) | (right < LEAST_WEIGHT)] = 0
                cut = gain.argmax(axis=1)
                better = gain[np.arange(nodes), cut] > best + 1e-9
                best = np.where(better, gain[np.arange(nodes), cut], best)
                model.feature[t, first : first + nodes][better] = f
                model.bin[t, first : first + nodes][better] = cut[better]
            node = 2 * node + 1 + (binned[rows, model.feature[t, node]] > model.bin[t, node])
        leaf = node - inner
        model.value[t] = rate * np.bincount(leaf, grad, leaves) / (np.bincount(leaf, hess, leaves) + RIDGE)
        logit += model.value[t, leaf]
    return model


def train(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "quality", sample_rows: int = SAMPLE_ROWS) -> Trees:
    """Fit on at most ``sample_rows`` labelled rows, those whose identifiers hash lowest; rows without label or identifier are left out.

    Where documents share an identifier, or a table repeats rows, those whose texts hash lowest are taken, so what is broadcast
    and what comes to the driver, one row of statistics each, is ``sample_rows`` at most whatever the tables hold.
    """
    known = labels.select(col(id_col).alias("id"), col(label_col).cast("double").alias("y")).where("id is not null and y is not null")
    sample = known.orderBy(F.xxhash64("id"), "id", "y").limit(sample_rows)
    texts = docs.select(col(id_col).alias("id"), text_of(docs, text_col).alias("text")).join(F.broadcast(sample), "id")
    texts = texts.select("y", "text", F.xxhash64("id").alias("h"), F.xxhash64("text").alias("t"))

    def described(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = [statistics(t.as_py()) for t in batch.column(1)]
            columns = [batch.column(0), pa.array(rows, pa.list_(pa.float64())), batch.column(2), batch.column(3)]
            yield pa.RecordBatch.from_arrays(columns, names=["y", "x", "h", "t"])

    found = texts.mapInArrow(described, "y double, x array<double>, h long, t long")
    rows = found.orderBy("h", "t", "y").limit(sample_rows).toPandas()
    x = np.array(rows["x"].tolist()).reshape(-1, len(STATISTICS))
    order = np.lexsort((*x.T, rows["y"].to_numpy()))  # whatever order the tasks ended in
    return fit(x[order], rows["y"].to_numpy()[order])


def scorer(model: Trees) -> Callable[[Column], Column]:
    """A column function from texts (not null) to scores."""

    @F.pandas_udf("double")
    def score(texts: pd.Series) -> pd.Series:
        x = np.array([statistics(t) for t in texts]).reshape(-1, len(STATISTICS))
        return pd.Series(model.score(x))

    return score


def scored(docs: DataFrame, model: Trees, id_col: str = "doc_id", text_col: str = "text", threshold: float = THRESHOLD) -> DataFrame:
    """One row per input row: ``id``, ``score`` between 0 and 1 and ``predicted`` (1 from ``threshold`` on).

    Null texts are scored like empty ones.  Equal texts score alike, whatever the other columns hold; an empty table gives none.
    """
    slim = docs.select(col(id_col).alias("id"), scorer(model)(text_of(docs, text_col)).alias("score"))
    return slim.select("id", "score", (F.col("score") >= threshold).cast("int").alias("predicted"))


def accepted(docs: DataFrame, model: Trees, text_col: str = "text", threshold: float = THRESHOLD) -> DataFrame:
    """The rows that the classifier accepts, unchanged."""
    return docs.where(scorer(model)(text_of(docs, text_col)) >= threshold)
