"""Benchmark decontamination with SimHash over windows as long as the benchmark's items.

A document is slid over with windows of as many words as an item has.  A window can only pass if so many of its shingles
belong to items of its length as the threshold asks for; other windows are not fingerprinted.  A window's SimHash (64 bits,
over its five-word shingles with their multiplicities) is looked up in a multi-index: eight blocks of eight bits, each with
lists of the items within two bits of a block value.  Two fingerprints within 23 bits have a block with at most two
differing bits, so the lists miss none of them.  23 bits hold all but two in a million of the pairs at the threshold of
0.8 (about 10 of 64 bits differ there).  Distances are taken for the listed candidates alone, some windows at a time.

Candidates within 23 bits are verified on the words themselves: the weighted Jaccard similarity of the two bags of shingles
must reach the threshold.  They are taken in the order of the shingles they share, and left at the first that share too few.

The benchmark is written in slices of bounded size to the shared folder; a worker loads those it searches.
"""

from __future__ import annotations

import math
import re
import sys
from collections import Counter, defaultdict
from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.parquet as pq
from pyarrow import fs
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from hourgrid import files
from hourgrid.llm.common import col, text_of
from hourgrid.session import scratch_path

SHINGLE = 5
SIMILARITY = 0.8
BLOCKS = 8
NEAR = 2  # bits of a block
RADIUS = BLOCKS * (NEAR + 1) - 1
SLICE_ITEMS = 20_000
SLICE_CHARS = 1 << 24
SLICES = 4  # loaded by a worker, and searched in one scan of the documents
PAIRS = 1 << 20  # candidates gathered at once
FACTOR = 0x9E3779B97F4A7C15
FILTER_BITS = 20
WORD = re.compile(r"\w+")


def words_of(text: str) -> list[str]:
    """Lower-case runs of letters, digits and underscores: case, punctuation and spacing make no difference."""
    return WORD.findall(text.lower())


def _word_marks() -> np.ndarray:
    """For each code point whether it is a letter, digit or underscore."""
    marks = np.zeros(sys.maxunicode + 1, bool)
    marks[[c for c in range(sys.maxunicode + 1) if chr(c).isalnum()]] = True
    marks[ord("_")] = True
    return marks


_SEEN: dict[str, np.ndarray] = {}  # of this worker: marks, and powers of the multiplier and of its inverse


def word_hashes(text: str) -> np.ndarray:
    """64-bit hashes of ``words_of(text)``: polynomials of the code points, from one running sum over the text."""
    if not _SEEN:
        _SEEN["marks"] = _word_marks()
    codes = np.frombuffer(text.lower().encode("utf-32-le", "surrogatepass"), np.uint32)
    n = len(codes)
    if n >= len(_SEEN.get("up", ())):
        size = 2 * n + (1 << 16)
        for name, factor in (("up", FACTOR), ("down", pow(FACTOR, -1, 1 << 64))):
            powers = np.full(size, factor, np.uint64)
            powers[0] = 1
            _SEEN[name] = np.multiply.accumulate(powers)
    marks = np.concatenate([[False], _SEEN["marks"][codes], [False]])
    edges = np.flatnonzero(marks[1:] != marks[:-1])
    sums = np.concatenate([np.zeros(1, np.uint64), np.cumsum(codes * _SEEN["up"][:n])])
    starts, ends = edges[::2], edges[1::2]
    return (sums[ends] - sums[starts]) * _SEEN["down"][starts]


def _among(values: np.ndarray, known: np.ndarray) -> np.ndarray:
    """Which values are among the sorted ones."""
    return known[np.minimum(np.searchsorted(known, values), len(known) - 1)] == values


def shingle_hashes(hashes: np.ndarray, size: int) -> np.ndarray:
    """Hashes of all runs of ``size`` words, from the hashes of the words."""
    n = max(0, len(hashes) - size + 1)
    total = np.zeros(n, np.uint64)
    for k in range(size):
        total = total * np.uint64(FACTOR) + hashes[k : k + n]
    total ^= total >> np.uint64(29)
    total *= np.uint64(0xBF58476D1CE4E5B9)
    return total ^ total >> np.uint64(32)


def bag(words: list[str], size: int) -> Counter:
    return Counter(tuple(words[k : k + size]) for k in range(len(words) - size + 1))


def similarity(a: Counter, b: Counter) -> float:
    """Weighted Jaccard: smaller multiplicities over larger ones."""
    shared = (a & b).total()
    return shared / (a.total() + b.total() - shared) if shared else 0.0


class Index:
    """The items of one slice of a benchmark: bags, fingerprints and the multi-index, by length."""

    def __init__(self, items: list[tuple[object, str]], threshold: float):
        self.threshold = threshold
        self.groups, by_length = [], defaultdict(list)
        for key, text in items:
            if words := words_of(text):
                by_length[len(words)].append((key, words, word_hashes(text)))
        for length, group in sorted(by_length.items()):
            size = min(SHINGLE, length)
            hashes = [shingle_hashes(h, size) for *_, h in group]
            prints = np.concatenate([simhashes(h, np.array([0]), len(h)) for h in hashes])
            self.groups.append((length, size, [k for k, *_ in group], [bag(w, size) for _, w, _ in group], np.unique(np.concatenate(hashes)), prints, self._tables(prints), [np.unique(h) for h in hashes]))
        self.sizes = {}
        for size in sorted({g[1] for g in self.groups}):
            known = np.unique(np.concatenate([g[4] for g in self.groups if g[1] == size]))
            seen = np.zeros(1 << FILTER_BITS, bool)
            seen[known >> np.uint64(64 - FILTER_BITS)] = True
            self.sizes[size] = known, seen

    @staticmethod
    def _tables(prints: np.ndarray) -> list[tuple[np.ndarray, np.ndarray]]:
        """For each block where the items of each value start, and the items: those within NEAR bits of the value."""
        blocks = prints.view(np.uint8).reshape(-1, BLOCKS)
        masks = np.flatnonzero(np.bitwise_count(np.arange(256, dtype=np.uint8)) <= NEAR).astype(np.uint8)
        out = []
        for k in range(BLOCKS):
            values = (blocks[:, k][:, None] ^ masks[None, :]).ravel()
            by = np.argsort(values, kind="stable")
            out.append((np.searchsorted(values[by], np.arange(257)), np.repeat(np.arange(len(prints)), len(masks))[by]))
        return out

    @staticmethod
    def _near(windows: np.ndarray, prints: np.ndarray, tables: list[tuple[np.ndarray, np.ndarray]]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(window, item, differing bits) of the pairs within RADIUS, by the lists of each block."""
        found = []
        part = max(1, PAIRS // max(1, len(prints)))
        for first in range(0, len(windows), part):
            some = windows[first : first + part]
            blocks = some.view(np.uint8).reshape(-1, BLOCKS)
            for k, (starts, items) in enumerate(tables):
                value = blocks[:, k].astype(np.int64)
                n = starts[value + 1] - starts[value]
                w = np.repeat(np.arange(len(some)), n)
                i = items[np.arange(n.sum()) - np.repeat(np.cumsum(n) - n - starts[value], n)]
                bits = np.bitwise_count(some[w] ^ prints[i])
                near = bits <= RADIUS
                found.append(np.stack([w[near] + first, i[near], bits[near]]))
        w, i, bits = np.concatenate(found, axis=1) if found else np.zeros((3, 0), np.int64)
        _, one = np.unique(w * max(1, len(prints)) + i, return_index=True)  # a pair may be listed by several blocks
        return w[one], i[one], bits[one]

    def matches(self, text: str) -> list[tuple[object, float, int, int, int]]:
        """(item, similarity, first word, words, differing bits) of the best window for each item that the text holds."""
        hashes = word_hashes(text)
        words, found, shingles, hits = None, [], {}, {}
        for size, (known, seen) in self.sizes.items():
            shingles[size] = s = shingle_hashes(hashes, size)
            at = np.flatnonzero(seen[s >> np.uint64(64 - FILTER_BITS)])
            hits[size] = at[_among(s[at], known)]
        for length, size, keys, bags, known, prints, tables, uniques in self.groups:
            if not len(hits[size]):
                continue
            at = hits[size][_among(shingles[size][hits[size]], known)]
            if not len(at):
                continue
            width = min(length, len(hashes)) - size + 1  # shingles of a window; a shorter text is one window
            marks = np.zeros(len(shingles[size]) + 1, np.int64)
            marks[at + 1] = 1
            marks = np.cumsum(marks)
            # of a window's shingles, and of the item's, so many are shared at the threshold
            least = max(1, math.ceil(self.threshold * (width + length - size + 1) / (1 + self.threshold) - 1e-9))
            starts = np.flatnonzero(marks[width:] - marks[: len(marks) - width] >= least)
            if not len(starts):
                continue
            windows = simhashes(shingles[size], starts, width)
            w, items, bits = self._near(windows, prints, tables)
            best: dict[int, tuple] = {}
            words = words or (words_of(text) if len(w) else None)
            for item in np.unique(items).tolist():
                mine = np.flatnonzero(items == item)
                own = np.append(0, np.cumsum(_among(shingles[size], uniques[item])))
                shared = own[starts[w[mine]] + width] - own[starts[w[mine]]]
                for k in np.lexsort((w[mine], -shared)).tolist():
                    # the shingles that a window has in the item are an upper bound of what both share
                    bound = shared[k] / (width + bags[item].total() - shared[k])
                    if bound < self.threshold or item in best and bound < best[item][1]:
                        break
                    start = int(starts[w[mine[k]]])
                    alike = similarity(bag(words[start : start + width + size - 1], size), bags[item])
                    if alike >= self.threshold and (item not in best or (alike, -start) > (best[item][1], -best[item][2])):
                        best[item] = (keys[item], alike, start, width + size - 1, int(bits[mine[k]]))
            found += best.values()
        return found


def simhashes(shingles: np.ndarray, starts: np.ndarray, width: int) -> np.ndarray:
    """SimHash of the windows of ``width`` shingles at ``starts`` (sorted): a bit is set if over half the shingles have it."""
    low, high = int(starts[0]), int(starts[-1]) + width
    bits = np.unpackbits(shingles[low:high].view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
    sums = np.zeros((len(bits) + 1, 64), np.int32)
    np.cumsum(bits, axis=0, out=sums[1:])
    ones = sums[starts - low + width] - sums[starts - low]
    return np.packbits(2 * ones > width, axis=1, bitorder="little").view(np.uint64).ravel()


_LOADED: dict[tuple[str, int, float], Index] = {}  # of this worker: the slices searched last


class Slices:
    """A benchmark written in slices, each as large as one index may be."""

    def __init__(self, benchmark: DataFrame, item_col: str, text_col: str, threshold: float):
        given = benchmark.select(col(item_col).alias("item"), text_of(benchmark, text_col).alias("text"))
        n, chars = given.agg(F.count(F.lit(1)), F.coalesce(F.sum(F.length("text")), F.lit(0))).first()
        self.threshold = threshold
        self.count = max(1, -(-n // SLICE_ITEMS), -(-chars // SLICE_CHARS))
        self.folder = scratch_path(benchmark.sparkSession, "benchmark")
        slice_ = F.pmod(F.xxhash64("item", "text"), F.lit(self.count)).cast("int").alias("slice")
        given.select("*", slice_).repartition("slice").write.partitionBy("slice").parquet(self.folder)

    def load(self, number: int) -> Index:
        key = self.folder, number, self.threshold
        if key not in _LOADED:
            while len(_LOADED) >= SLICES:
                del _LOADED[next(iter(_LOADED))]
            system, place = files.located(f"{self.folder}/slice={number}")
            found = [i.path for i in system.get_file_info(fs.FileSelector(place, allow_not_found=True)) if i.path.endswith(".parquet")]
            rows = [r for path in sorted(found) for r in pq.read_table(path, filesystem=system, partitioning=None).select(["item", "text"]).to_pylist()]
            _LOADED[key] = Index([(r["item"], r["text"]) for r in rows], self.threshold)
        return _LOADED[key]

    def scans(self) -> list[range]:
        return [range(k, min(k + SLICES, self.count)) for k in range(0, self.count, SLICES)]


def contaminated(docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text", item_col: str = "item_id", item_text: str = "text", threshold: float = SIMILARITY) -> DataFrame:
    """One row per document and item it holds: ``id``, ``item_id``, ``similarity``, ``start_word``, ``n_words``, ``n_bits`` of the best window.

    - Null and empty texts match nothing, nor do items without words.  Items under five words count as one shingle.
    - Rows that repeat or share an identifier are searched one by one.  Ties between windows go to the first.
    - Either table may be empty (no rows); only the named columns are read.
    """
    slim = docs.select(col(id_col).alias("id"), text_of(docs, text_col).alias("text"))
    item = benchmark.schema[item_col].dataType
    schema = f"id {slim.schema['id'].dataType.simpleString()}, item_id {item.simpleString()}, similarity double, start_word long, n_words long, n_bits int"
    out, slices = None, Slices(benchmark, item_col, item_text, threshold)
    for numbers in slices.scans():

        def searched(batches: Iterator[pa.RecordBatch], numbers: range = numbers) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                found = []
                for number in numbers:
                    index = slices.load(number)
                    found += [(n, *m) for n, text in enumerate(batch.column(1)) for m in index.matches(text.as_py())]
                rows = list(zip(*found)) or [[]] * 6
                kinds = [pa.float64(), pa.int64(), pa.int64(), pa.int32()]
                columns = [pa.array(rows[1]), *[pa.array(c, kind) for c, kind in zip(rows[2:], kinds)]]
                if found:
                    yield pa.RecordBatch.from_arrays([batch.column(0).take(pa.array(rows[0], pa.int64())), *columns], names=["id", "item_id", "similarity", "start_word", "n_words", "n_bits"])

        part = slim.mapInArrow(searched, schema)
        out = part if out is None else out.unionByName(part)
    return out


def clean(docs: DataFrame, benchmark: DataFrame, text_col: str = "text", item_col: str = "item_id", item_text: str = "text", threshold: float = SIMILARITY) -> DataFrame:
    """The documents that hold no item of the benchmark, unchanged."""
    slices = Slices(benchmark, item_col, item_text, threshold)
    for numbers in slices.scans():
        docs = docs.where(~_holds(slices, numbers)(text_of(docs, text_col)))
    return docs


def _holds(slices: Slices, numbers: range) -> Callable[[Column], Column]:
    @F.pandas_udf("boolean")
    def holds(texts: pd.Series) -> pd.Series:
        out = np.zeros(len(texts), bool)
        for number in numbers:
            index = slices.load(number)
            out |= [not done and bool(index.matches(t)) for done, t in zip(out, texts)]
        return pd.Series(out)

    return holds
