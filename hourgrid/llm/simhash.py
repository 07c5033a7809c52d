"""SimHash near-duplicates by anchor points of a covering code.

Fingerprints of 64 bits are cut into segments, three of 21, 21 and 22 bits in the layout THREE.  Two fingerprints with at
most four differing bits have a segment with at most one.  Every segment is covered by a code: its low 15 bits by the
perfect Hamming code [15, 11], whose covering radius is 1, the rest by itself.  The codewords are the anchors.  A
fingerprint lives at the anchor nearest to its segment and is sent to every anchor within covering radius plus threshold
(1 + 1 bits), 14 or 22 of them.  So whenever two fingerprints differ in at most one bit of a segment, the second one
visits the anchor at which the first one lives, and they are compared there in full.

The layout TWO has halves of 32 bits, the Hamming code [31, 26] and a reach of 1 + 2 bits: about 170 visits to a half
instead of 14 to a third, but 2**27 anchors to a half instead of 2**17.  Both find the same links.  Comparisons grow with the
square of the number of different fingerprints over the number of anchors, so THREE is cheaper up to some hundred
millions of them, and TWO for tens of billions.

Only distinct fingerprints are compared.  A crowded anchor is dealt out in cells of bounded size, each a block of residents
against a block of visitors.  A cell returns a spanning forest of its links, not all of its pairs, and components of the
forests are found by hooking and shortcutting on written tables.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from hourgrid.llm.common import col, kept, text_of, whole_row, written

SEED = 42
SHINGLE = 4
MAX_BITS = 4
CELL = 1024  # residents, and visitors, of one cell
CHUNK = 1 << 16  # shingles hashed at once


def fingerprint(text: str, shingle: int = SHINGLE) -> int:
    """SimHash of one whole text; zero without words, the whole sequence if it is shorter than a shingle."""
    words = text.encode("utf-8").lower().split()  # bytes: lower-cases A-Z, splits at ASCII white space
    if not words:
        return 0
    joined, sizes = b" ".join(words), np.fromiter(map(len, words), np.int64, len(words)) + 1
    ends = np.cumsum(sizes) - 1
    starts = ends - sizes + 1
    n = max(1, len(words) - shingle + 1)
    ends = ends[len(words) - n :]
    ones, digest = np.zeros(64, np.int64), xxhash.xxh64_intdigest
    for at in range(0, n, CHUNK):
        bounds = zip(starts[at : at + CHUNK].tolist(), ends[at : at + CHUNK].tolist())
        hashes = np.array([digest(joined[a:b], SEED) for a, b in bounds], "<u8")
        ones += np.unpackbits(hashes.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    bits = (2 * ones > n).astype(np.uint8)
    return int(np.packbits(bits, bitorder="little").view("<u8")[0])


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = SHINGLE, carry: bool = False) -> DataFrame:
    """``id`` (and ``row`` if ``carry``) with the fingerprint ``fp`` of the whole text as a signed long; null texts count as empty."""
    slim = docs.select(col(id_col).alias("id"), text_of(docs, text_col).alias("text"))
    if carry:
        slim = docs.select(col(id_col).alias("id"), whole_row(docs).alias("row"))
    schema = slim.drop("text").withColumn("fp", F.lit(0).cast("long")).schema

    def hashed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = batch.column(1).field(text_col) if carry else batch.column(1)
            prints = [fingerprint(str(x.as_py() or ""), shingle) for x in texts]
            prints = pa.array(np.array(prints, np.uint64).view(np.int64))
            columns = [batch.column(0), *([batch.column(1)] if carry else []), prints]
            yield pa.RecordBatch.from_arrays(columns, names=["id", *(["row"] if carry else []), "fp"])

    return slim.mapInArrow(hashed, schema)


@dataclass(frozen=True)
class Layout:
    """Segments of a fingerprint, and the code that covers each."""

    segments: tuple[tuple[int, int], ...]  # shift and width
    coded: int  # bits of a segment that the Hamming code covers: 15 or 31
    reach: int  # covering radius of the code plus the bits that may differ in a segment

    def syndromes(self, values: np.ndarray) -> np.ndarray:
        """Of coded words: the exclusive or of the numbers, from 1, of the bits that are set; zero marks a codeword."""
        found = np.zeros_like(values)
        for bit in range(self.coded):
            found ^= np.where(values >> bit & 1, bit + 1, 0)
        return found

    def steps(self, width: int) -> list[np.ndarray]:
        """For each syndrome, what to exclusive-or to a segment to reach the anchors within ``reach`` bits."""
        bits = [1 << b for b in range(self.coded)]
        masks = [sum(m) for k in range(self.reach + 1) for m in combinations(bits, k)]
        rest = [1 << b for b in range(self.coded, width)]
        free = [[sum(m) for k in range(left + 1) for m in combinations(rest, k)] for left in range(self.reach + 1)]
        steps: list[list[int]] = [[] for _ in range(self.coded + 1)]
        for mask, syndrome in zip(masks, self.syndromes(np.array(masks)).tolist()):
            steps[syndrome] += [mask | f for f in free[self.reach - mask.bit_count()]]
        return [np.array(s) for s in steps]

    def anchors(self, segment: np.ndarray, steps: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Of segment values: (index, anchor, lives) for every anchor within reach; ``lives`` marks the nearest."""
        syndromes = self.syndromes(segment & ((1 << self.coded) - 1))
        where, found, nearest = [], [], []
        for s, masks in enumerate(steps):
            at = np.flatnonzero(syndromes == s)
            where.append(np.repeat(at, len(masks)))
            found.append((segment[at][:, None] ^ masks[None, :]).ravel())
            nearest.append(np.tile(masks == (1 << s - 1 if s else 0), len(at)))  # a syndrome numbers the bit that is off
        return np.concatenate(where), np.concatenate(found), np.concatenate(nearest)

    def visits(self, prints: DataFrame) -> DataFrame:
        """(``anchor``, ``fp``, ``lives``) for all anchors within reach of a segment of each fingerprint."""
        steps = [self.steps(width) for _, width in self.segments]
        wide = max(width for _, width in self.segments) + 2 > 31
        part = 8192 if self.reach < 3 else 512  # fingerprints at a time: each goes to many anchors

        def visited(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                for first in range(0, batch.num_rows, part):
                    fps = batch.column(0).slice(first, part).to_numpy()
                    for number, (shift, width) in enumerate(self.segments):
                        segment = (fps.view(np.uint64) >> np.uint64(shift)).astype(np.int64) & ((1 << width) - 1)
                        at, anchor, lives = self.anchors(segment, steps[number])
                        named = (anchor << 2 | number).astype(np.int64 if wide else np.int32)
                        yield pa.RecordBatch.from_arrays([pa.array(named), pa.array(fps[at]), pa.array(lives)], names=["anchor", "fp", "lives"])

        return prints.mapInArrow(visited, f"anchor {'long' if wide else 'int'}, fp long, lives boolean")


THREE = Layout(((0, 21), (21, 21), (42, 22)), 15, 2)
TWO = Layout(((0, 32), (32, 32)), 31, 3)


def forest(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Links between values as (value, smallest value of its component), without the roots themselves."""
    values, code = np.unique(np.concatenate([a, b]), return_inverse=True)
    x, y = code[: len(a)], code[len(a) :]
    root = np.arange(len(values))
    while True:
        low = np.minimum(root[x], root[y])
        new = root.copy()
        np.minimum.at(new, root[x], low)
        np.minimum.at(new, root[y], low)
        new = new[new]
        if (new == root).all():
            break
        root = new
    moved = root != np.arange(len(values))
    return values[moved], values[root[moved]]


def _linked(batches: Iterator[pa.RecordBatch], max_bits: int) -> Iterator[pa.RecordBatch]:
    """Cells (residents, visitors) to forests of their links."""
    for batch in batches:
        lists = [batch.column(k) for k in (0, 1)]
        size = [np.diff(x.offsets.to_numpy()) for x in lists]
        value = [x.flatten().to_numpy() for x in lists]
        start = [np.concatenate([[0], np.cumsum(s)]) for s in size]
        pairs = np.concatenate([[0], np.cumsum(size[0] * size[1])])
        cell, out_a, out_b = 0, [], []
        while cell < batch.num_rows:  # so many cells at a time as have about CELL * CELL pairs
            to = max(cell + 1, int(np.searchsorted(pairs, pairs[cell] + CELL * CELL, "right")) - 1)
            n = size[0][cell:to]
            m = np.repeat(size[1][cell:to], n)  # partners of each resident
            left = np.repeat(value[0][start[0][cell] : start[0][to]], m)
            first = np.repeat(start[1][cell:to], n)
            right = value[1][np.arange(m.sum()) - np.repeat(np.cumsum(m) - m, m) + np.repeat(first, m)]
            near = np.bitwise_count((left ^ right).view(np.uint64)) <= max_bits
            near &= left != right
            if near.any():
                x, y = forest(left[near], right[near])
                out_a.append(x)
                out_b.append(y)
            cell = to
        if out_a:
            yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(out_a)), pa.array(np.concatenate(out_b))], names=["a", "b"])


def links(prints: DataFrame, max_bits: int = MAX_BITS, layout: Layout = THREE) -> DataFrame:
    """Edges (a, b) of a forest with the same components as all pairs of distinct ``fp`` within ``max_bits``."""
    if max_bits > MAX_BITS:
        raise ValueError(f"the anchors are laid out for at most {MAX_BITS} bits")
    visits = layout.visits(prints.select("fp").distinct())
    crowd = visits.groupBy("anchor").agg(F.count_if("lives").alias("r"), F.count(F.lit(1)).alias("v"))
    crowd = crowd.where(f"r > {CELL} or v > {CELL}").select("anchor", F.ceil(F.col("r") / CELL).alias("rows"), F.ceil(F.col("v") / CELL).alias("cols"))
    rows, cols = F.coalesce("rows", F.lit(1)), F.coalesce("cols", F.lit(1))
    dealt = visits.join(crowd, "anchor", "left")
    own_row, own_col = F.pmod(F.xxhash64("fp"), rows), F.pmod(F.xxhash64("fp", F.lit(1)), cols)
    # a visitor meets every block of residents; the cells in which it lives are those of its own block
    cells = dealt.select("anchor", "fp", own_col.alias("c"), F.explode(F.sequence(F.lit(0), rows - 1)).alias("r"), F.lit(False).alias("lives"))
    homes = dealt.where("lives").select("anchor", "fp", F.explode(F.sequence(F.lit(0), cols - 1)).alias("c"), own_row.alias("r"), F.lit(True).alias("lives"))
    cells = cells.unionByName(homes).groupBy("anchor", "r", "c").agg(
        F.collect_list(F.when(F.col("lives"), F.col("fp"))).alias("residents"),
        F.collect_list(F.when(~F.col("lives"), F.col("fp"))).alias("visitors"),
    )
    cells = cells.where("size(residents) > 0 and size(visitors) > 0").select("residents", "visitors")
    return cells.mapInArrow(lambda batches: _linked(batches, max_bits), "a long, b long").distinct()


def components(edges: DataFrame) -> DataFrame:
    """(node, root) for every node of the edges (a, b); root is the smallest node that it reaches.

    Large-star and small-star rounds: each node's neighbours are hung onto the smallest of them.  Both sides of each join
    are written tables, so that Spark can split the edges of a hub.
    """
    now = kept(edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).where("a <> b").distinct())
    before = None
    while True:
        both = now.unionByName(now.select(F.col("b").alias("a"), F.col("a").alias("b")))
        low = kept(both.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m")))
        large = both.where("b > a").join(low, "a").select(F.col("b").alias("a"), F.col("m").alias("b")).distinct()
        large = kept(large)
        low = kept(large.groupBy("a").agg(F.min("b").alias("m")))
        hung = large.join(low, "a").where("b <> m").select(F.col("b").alias("a"), F.col("m").alias("b"))
        now = kept(low.select("a", F.col("m").alias("b")).unionByName(hung).distinct())
        state = now.agg(F.count(F.lit(1)), F.sum(F.xxhash64("a", "b") % (1 << 31))).first()
        if state == before:
            return now.select(F.col("a").alias("node"), F.col("b").alias("root")).unionByName(
                now.select(F.col("b").alias("node"), F.col("b").alias("root")).distinct()
            )
        before = state


def _rooted(firsts: DataFrame, edges: DataFrame) -> DataFrame:
    """(``fp``, ``root`` of its component, ``first``) for the distinct fingerprints of ``firsts``."""
    groups = components(edges)
    return firsts.join(groups, firsts["fp"] == groups["node"], "left").select("fp", F.coalesce("root", "fp").alias("root"), "first")


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = SHINGLE, max_bits: int = MAX_BITS, layout: Layout = THREE) -> DataFrame:
    """One row per input row: ``id``, ``fp`` (a signed long) and ``component_id``, the smallest identifier its group reaches.

    - Null texts count as empty; texts without words have fingerprint zero and link like any other.
    - A group without any identifier has a null ``component_id``; equal rows give equal rows; an empty table none.
    - Only the two named columns are read, so others may have any names.
    """
    prints = kept(fingerprints(docs, id_col, text_col, shingle))
    firsts = kept(prints.groupBy("fp").agg(F.min("id").alias("first")))
    rooted = kept(_rooted(firsts, links(prints, max_bits, layout)))
    lowest = kept(rooted.groupBy("root").agg(F.min("first").alias("component_id")))
    named = kept(rooted.join(lowest, "root").select("fp", "component_id"))
    return prints.join(named, "fp").select("id", "fp", "component_id")


def deduplicate(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = SHINGLE, max_bits: int = MAX_BITS, layout: Layout = THREE) -> DataFrame:
    """Of each group the row with the smallest identifier, unchanged; an identifier that is null comes last.

    Exactly one row of a group stays, also where rows share its smallest identifier or have none; of those it is one with the
    smallest fingerprint.  Rows are told apart by their place in the written table, so a text is judged by its own group
    whatever identifier it shares.  Rows are fingerprinted once and written with their fingerprints.
    """
    rows = written(fingerprints(docs, id_col, text_col, shingle, carry=True).withColumn("place", F.monotonically_increasing_id()), "fingerprints")
    order = F.struct(F.col("id").isNull().alias("none"), F.col("id"), F.col("fp"), F.col("place"))
    firsts = kept(rows.select("id", "fp", "place").groupBy("fp").agg(F.min(order).alias("first")))
    rooted = _rooted(firsts, links(rows.select("fp"), max_bits, layout))
    stay = kept(rooted.groupBy("root").agg(F.min("first").alias("first")).select(F.col("first.place").alias("place")))
    return rows.join(stay, "place", "left_semi").select("row.*")
