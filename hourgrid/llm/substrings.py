"""Repeated passages by a Relative Lempel-Ziv parse against an index that is dealt out in blocks.

The reference is the corpus itself.  Every window of WINDOW words is filed under its anchor, the smallest hash of the
SEED-word shingles in it; equal windows have equal anchors.  A block of the reference is a range of anchors, and a document
is cut into stretches, runs of windows with one anchor, each sent to the block of its anchor.  So every document meets
every indexed block that can hold a match of it, and no others.

A block indexes its stretches by window, in the order of their places, and factors each stretch greedily against what lies
before it: a factor goes on as long as its next window has an earlier place.  Factors shorter than a window are literals.
Where a factor ends, the windows that cross its boundary have been looked up one by one as well, so no repeat is lost
between two factors or two stretches; a document's factors are joined where they meet.

Anchors are counted in BUCKETS.  The stretches of a crowded bucket are cut into single windows, each filed under itself.
Of equal ones in a batch only the first goes to its block; the others repeat it, whatever the block says.  A window is
compared by 64 bits of its own and by the 64 bits of its anchor.  Texts meet their factors compressed.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from hourgrid.llm.common import col, kept, text_of, whole_row

WINDOW = 20
SEED = 4  # words of a shingle that can be an anchor
LONGEST = 64  # windows of a stretch
BUCKETS = 1 << 20  # that anchors are counted in; the list of the hot ones is as long at most
HOT = 1024  # stretches of a bucket that need not be cut, or MEANS times the mean of all buckets if that is more
MEANS = 4
BYTES = 1 << 20  # of text hashed at once
LONG_WORD = 1 << 16  # bytes from which a word is hashed by itself
CHUNK = 1 << 18  # words, or windows of a block, looked at together

_BASE = 0x9E3779B97F4A7C15
_UNBASE = pow(_BASE, -1, 1 << 64)
_SPACE = np.zeros(256, bool)
_SPACE[[9, 10, 11, 12, 13, 32]] = True


def _powers(base: int, n: int) -> np.ndarray:
    steps = np.full(n, base, np.uint64)
    steps[0] = 1
    return np.cumprod(steps)


_POWERS, _UNPOWERS = _powers(_BASE, BYTES + 1), _powers(_UNBASE, BYTES + 1)


def _mixed(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    h = (h ^ (h >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return h ^ (h >> np.uint64(31))


def _joined(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    return _mixed(a * np.uint64(_BASE) + b)


def _bytes(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of all texts one behind the other, and where each starts, with the end."""
    texts = texts.cast(pa.large_string())
    bounds = np.frombuffer(texts.buffers()[1], np.int64)[texts.offset : texts.offset + len(texts) + 1]
    buffer = texts.buffers()[2]
    data = np.frombuffer(buffer, np.uint8)[bounds[0] : bounds[-1]] if buffer is not None else np.zeros(0, np.uint8)
    return data, bounds - bounds[0]


def word_places(data: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Starts and ends of the words; none reaches over the end of its text."""
    solid = np.append(~_SPACE[data], False)
    first = solid.copy()
    first[1:] &= ~solid[:-1]
    last = solid.copy()
    last[:-1] &= ~solid[1:]
    cuts = bounds[(bounds > 0) & (bounds < len(data))]
    first[cuts] = solid[cuts]
    last[cuts - 1] = solid[cuts - 1]
    return np.flatnonzero(first), np.flatnonzero(last) + 1


def word_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """64 bits of each word, a polynomial over its bytes mixed with its length."""
    found, at = np.zeros(len(starts), np.uint64), 0
    while at < len(starts):
        to = max(at + 1, int(np.searchsorted(ends, starts[at] + BYTES, "right")))
        base = starts[at]
        if ends[to - 1] - base <= BYTES:
            part = data[base : ends[to - 1]].astype(np.uint64) + np.uint64(1)
            sums = np.append(np.uint64(0), np.cumsum(part * _POWERS[: len(part)]))
            a, b = starts[at:to] - base, ends[at:to] - base
            found[at:to] = _mixed((sums[b] - sums[a]) * _UNPOWERS[a] + (b - a).astype(np.uint64) * np.uint64(_UNBASE))
        for k in at + np.flatnonzero(ends[at:to] - starts[at:to] > LONG_WORD):
            found[k] = xxhash.xxh64_intdigest(data[starts[k] : ends[k]].tobytes())
        at = to
    return found


def _windows(words: np.ndarray, size: int, seed: int) -> tuple[np.ndarray, np.ndarray]:
    """Hash and anchor of every window of ``size`` words; spans are put together from halves."""
    n = len(words) - size + 1
    spans, at, have = {1: words}, 1, 1
    while 2 * at <= size:
        spans[2 * at] = _joined(spans[at][:-at], spans[at][at:])
        at *= 2

    def span(length: int) -> np.ndarray:
        bits = [b for b in sorted(spans, reverse=True) if length & b]
        whole, have = spans[bits[0]], bits[0]
        for b in bits[1:]:
            k = len(words) - have - b + 1
            whole, have = _joined(whole[:k], spans[b][have : have + k]), have + b
        return whole

    low, shingles = _mixed(span(seed)), size - seed + 1
    have = 1
    while 2 * have <= shingles:
        low, have = np.minimum(low[:-have], low[have:]), 2 * have
    anchors = np.minimum(low[:n], low[shingles - have : shingles - have + n])
    return span(size)[:n], anchors


def _stretches(texts: pa.Array, size: int, seed: int) -> Iterator[tuple[np.ndarray, ...]]:
    """Runs of windows with one anchor: (anchor, text number, first window, number of windows) and the windows' hashes."""
    data, bounds = _bytes(texts)
    starts, ends = word_places(data, bounds)
    words = word_hashes(data, starts, ends)
    owner = np.searchsorted(bounds, starts, "right") - 1
    first_word = np.searchsorted(starts, bounds[:-1])
    for at in range(0, len(words) - size + 1, CHUNK):
        part = words[at : at + CHUNK + size - 1]
        hashes, anchors = _windows(part, size, seed)
        where = at + np.arange(len(hashes))
        whole = np.flatnonzero(owner[where] == owner[where + size - 1])
        if not len(whole):
            continue
        hashes, anchors, where = hashes[whole], anchors[whole], where[whole]
        text = owner[where]
        new = np.append(True, (anchors[1:] != anchors[:-1]) | (text[1:] != text[:-1]))
        run = np.flatnonzero(new)
        place = np.arange(len(new)) - np.repeat(run, np.diff(np.append(run, len(new))))
        run = np.flatnonzero(place % LONGEST == 0)
        count = np.diff(np.append(run, len(new)))
        yield anchors[run], text[run], where[run] - first_word[text[run]], count, hashes


def _signed(values: np.ndarray) -> pa.Array:
    return pa.array(values.astype(np.uint64).view(np.int64))


def _documents(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    text = text_of(docs, text_col)
    return docs.select(col(id_col).alias("id"), F.xxhash64(text).alias("digest"), text.alias("text"))


def _bucket(anchors: np.ndarray, buckets: int) -> np.ndarray:
    # anchors are smallest hashes, so their high bits are mostly zero
    return (_mixed(anchors) >> np.uint64(32)).astype(np.int64) % buckets


def hot_buckets(docs: DataFrame, text_col: str, size: int = WINDOW, seed: int = SEED) -> np.ndarray:
    """Whether each bucket holds so many stretches of all documents that they are cut."""
    buckets = BUCKETS

    def counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = np.zeros(buckets, np.int64)
        for batch in batches:
            for anchors, *_ in _stretches(batch.column(0), size, seed):
                counts += np.bincount(_bucket(anchors, buckets), minlength=buckets)
        used = np.flatnonzero(counts)
        yield pa.RecordBatch.from_arrays([pa.array(used.astype(np.int32)), pa.array(counts[used])], names=["bucket", "n"])

    found = docs.select(text_of(docs, text_col).alias("text")).mapInArrow(counted, "bucket int, n long")
    counts = kept(found.groupBy("bucket").agg(F.sum("n").alias("n")))
    limit = max(HOT, MEANS * (counts.agg(F.sum("n")).first()[0] or 0) // buckets)
    hot = np.zeros(buckets, bool)
    hot[counts.where(F.col("n") > limit).select("bucket").toPandas()["bucket"].to_numpy(np.int64)] = True  # one row per bucket at most
    return hot


def _rows(ids: pa.Array, digests: pa.Array, names: list[str], anchor, text, start, count, offsets, hashes) -> pa.RecordBatch:
    windows = pa.ListArray.from_arrays(pa.array(offsets.astype(np.int32)), _signed(hashes))
    at = pa.array(text)
    columns = [_signed(anchor), ids.take(at), digests.take(at), pa.array(start.astype(np.int32)), pa.array(count.astype(np.int32)), windows]
    return pa.RecordBatch.from_arrays(columns, names=names)


def _order(ids: pa.Array, digests: pa.Array) -> np.ndarray:
    """Rank of each row by identifier, nulls last, and digest; equal rows have equal ranks."""
    table = pa.table({"id": ids, "digest": digests})
    by = pc.sort_indices(table, sort_keys=[("id", "ascending"), ("digest", "ascending")], null_placement="at_end")
    moved = table.take(by)
    same = np.ones(max(0, len(ids) - 1), bool)
    for name in ("id", "digest"):
        column = moved[name].combine_chunks()
        equal = pc.equal(column.slice(1), column.slice(0, max(0, len(ids) - 1)))
        both_null = pc.and_(pc.is_null(column.slice(1)), pc.is_null(column.slice(0, max(0, len(ids) - 1))))
        same &= pc.or_(pc.fill_null(equal, False), both_null).to_numpy(zero_copy_only=False)
    rank = np.zeros(len(ids), np.int64)
    rank[by.to_numpy()] = np.append(0, np.cumsum(~same)) if len(ids) else []
    return rank


def stretches(docs: DataFrame, id_col: str, text_col: str, size: int, seed: int, hot: np.ndarray) -> DataFrame:
    """Stretches with their windows under their anchors, hot ones cut into windows under themselves.

    A row without windows says that ``count`` windows from ``start`` on repeat earlier ones.
    """
    given = _documents(docs, id_col, text_col)
    schema = T.StructType([
        T.StructField("anchor", T.LongType()), given.schema["id"], given.schema["digest"],
        T.StructField("start", T.IntegerType()), T.StructField("count", T.IntegerType()), T.StructField("windows", T.ArrayType(T.LongType())),
    ])
    names = schema.names
    shared = given.sparkSession.sparkContext.broadcast(hot)

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, digests = batch.column(0), batch.column(1)
            crowded = []
            for anchor, text, start, count, hashes in _stretches(batch.column(2), size, seed):
                offsets = np.append(0, np.cumsum(count))
                is_hot = shared.value[_bucket(anchor, len(shared.value))]
                if is_hot.any():
                    wide = np.repeat(is_hot, count)
                    place = np.arange(len(hashes)) - np.repeat(offsets[:-1], count)
                    crowded.append((hashes[wide], np.repeat(text, count)[wide], (np.repeat(start, count) + place)[wide]))
                    anchor, text, start, hashes = anchor[~is_hot], text[~is_hot], start[~is_hot], hashes[~wide]
                    count = count[~is_hot]
                    offsets = np.append(0, np.cumsum(count))
                if len(anchor):
                    yield _rows(ids, digests, names, anchor, text, start, count, offsets, hashes)
            if not crowded:
                continue
            hashes, text, start = (np.concatenate(c) for c in zip(*crowded))
            rank = _order(ids, digests)[text]
            by = np.lexsort((start, rank, hashes))
            hashes, text, start, rank = hashes[by], text[by], start[by], rank[by]
            new = np.append(True, hashes[1:] != hashes[:-1])
            first = np.flatnonzero(new)[np.cumsum(new) - 1]
            # rows with the identifier and text of the first are the same document
            again = (rank != rank[first]) | (start != start[first])
            one = np.ones(len(first), np.int64)
            yield _rows(ids, digests, names, hashes[new], text[new], start[new], one[new], np.arange(new.sum() + 1), hashes[new])
            by = np.flatnonzero(again)
            by = by[np.lexsort((start[by], text[by]))]
            text, start = text[by], start[by]
            run = np.flatnonzero(np.append(True, (text[1:] != text[:-1]) | (start[1:] != start[:-1] + 1))) if len(by) else by
            length = np.diff(np.append(run, len(by)))
            yield _rows(ids, digests, names, hashes[by][run], text[run], start[run], length, np.zeros(len(run) + 1), hashes[:0])

    return given.mapInArrow(cut, schema)


def _factored(anchors: np.ndarray, starts: np.ndarray, counts: np.ndarray, sizes: np.ndarray, windows: np.ndarray) -> tuple[np.ndarray, ...]:
    """Factors of the stretches of whole anchors in the order of their places: (row, first window, windows)."""
    row = np.repeat(np.arange(len(sizes)), sizes)
    place = np.arange(len(windows)) - np.repeat(np.cumsum(sizes) - sizes, sizes)
    sorted_ = np.sort(windows)
    often = np.unique(sorted_[1:][sorted_[1:] == sorted_[:-1]])
    at = np.minimum(np.searchsorted(often, windows), max(0, len(often) - 1))
    cand = np.flatnonzero(often[at] == windows) if len(often) else np.zeros(0, np.int64)
    by = cand[np.lexsort((cand, anchors[row[cand]], windows[cand]))]
    again = (windows[by][1:] == windows[by][:-1]) & (anchors[row[by]][1:] == anchors[row[by]][:-1])
    repeat = np.sort(by[1:][again])
    new = np.append(True, (row[repeat][1:] != row[repeat][:-1]) | (repeat[1:] != repeat[:-1] + 1)) if len(repeat) else np.zeros(0, bool)
    run = np.flatnonzero(new)
    known = np.flatnonzero(sizes == 0)  # found in their batch already
    rows = np.append(row[repeat][run], known)
    first = np.append(starts[row[repeat][run]] + place[repeat][run], starts[known])
    return rows, first, np.append(np.diff(np.append(run, len(repeat))), counts[known])


def factors(pieces: DataFrame, size: int = WINDOW) -> DataFrame:
    """Factors of the documents, (``id``, ``digest``, ``begin``, ``end``) in words; each begins a run of repeated windows."""
    chunk = CHUNK
    order = ["anchor", F.col("id").isNull(), "id", "digest", "start"]
    dealt = pieces.repartition("anchor").sortWithinPartitions(*order)
    schema = T.StructType([
        pieces.schema["id"], pieces.schema["digest"], T.StructField("begin", T.IntegerType()), T.StructField("end", T.IntegerType()),
    ])

    def index(rows: list[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = pa.Table.from_batches(rows).combine_chunks()
        if not table.num_rows:
            return
        anchor, ids, digest, start, count, windows = (table.column(k).chunk(0) for k in range(6))
        # equal rows of the table are one document
        near = [pc.equal(c.slice(1), c.slice(0, len(c) - 1)) for c in (anchor, digest, start, count)]
        same_id = pc.or_(pc.fill_null(pc.equal(ids.slice(1), ids.slice(0, len(ids) - 1)), False), pc.and_(pc.is_null(ids.slice(1)), pc.is_null(ids.slice(0, len(ids) - 1))))
        repeated = np.logical_and.reduce([x.to_numpy(zero_copy_only=False) for x in [*near, same_id]]) if len(ids) > 1 else np.zeros(0, bool)
        only = pa.array(np.flatnonzero(~np.append(False, repeated)))
        anchor, ids, digest, start, count, windows = (c.take(only) for c in (anchor, ids, digest, start, count, windows))
        sizes = windows.value_lengths().to_numpy().astype(np.int64)
        flat = windows.flatten().to_numpy().view(np.uint64)
        row, first, n = _factored(anchor.to_numpy(), start.to_numpy(), count.to_numpy(), sizes, flat)
        if len(row):
            at = pa.array(row)
            ends = pa.array((first + n + size - 1).astype(np.int32))
            yield pa.RecordBatch.from_arrays([ids.take(at), digest.take(at), pa.array(first.astype(np.int32)), ends], names=schema.names)

    def parsed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, n = [], 0
        for batch in batches:
            held.append(batch)
            n += batch.num_rows
            if n * 8 < chunk or not batch.num_rows:
                continue
            # whole anchors only: the last one may go on in the next batch
            anchors = batch.column(0).to_numpy()
            tail = int(np.searchsorted(anchors, anchors[-1]))
            if tail:
                yield from index([*held[:-1], batch.slice(0, tail)])
                held, n = [batch.slice(tail)], batch.num_rows - tail
        if held:
            yield from index(held)

    return dealt.mapInArrow(parsed, schema)


def repeated_spans(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", size: int = WINDOW, seed: int = SEED) -> DataFrame:
    """Per document with repeats ``id``, ``digest`` of its text and ``factors``, (begin, end) in words, in any order."""
    if not 1 <= seed <= size:
        raise ValueError("an anchor has at least one word and at most as many as a window")
    pieces = stretches(docs, id_col, text_col, size, seed, hot_buckets(docs, text_col, size, seed))
    return factors(pieces, size).groupBy("id", "digest").agg(F.collect_list(F.struct("begin", "end")).alias("factors"))


def deduplicated(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", size: int = WINDOW, seed: int = SEED) -> DataFrame:
    """Each row as ``row`` with ``n_words``, ``n_removed``, the ``kept_text`` (words joined by one space) and its ``spans``.

    ``spans`` are the removed passages, (begin, end) in words, joined where they meet.  A word goes if some window of
    ``size`` words over it also starts earlier: in a document with a smaller identifier, or before it in its own.

    - Null and empty texts have no words; texts shorter than a window lose none.
    - Documents without identifier come last.  Of different texts that share an identifier, or have none, that with the
      smaller hash counts as the earlier; rows that share identifier and text are one document, and each gets its result.
    - An empty table gives no row; columns of any other name ride along in ``row``.
    """
    text = text_of(docs, text_col)
    given = _packed(docs.select(whole_row(docs).alias("row"), col(id_col).alias("id"), F.xxhash64(text).alias("digest"), text.alias("text")), text_col)
    found = repeated_spans(docs, id_col, text_col, size, seed).select(F.col("id").alias("of"), F.col("digest").alias("of_digest"), "factors")
    joined = given.join(found, (given["digest"] == found["of_digest"]) & given["id"].eqNullSafe(found["of"]), "left")
    joined = joined.select("row", "packed", F.array_sort("factors").alias("factors"))
    span = T.ArrayType(T.StructType([T.StructField("begin", T.IntegerType()), T.StructField("end", T.IntegerType())]))
    schema = T.StructType([
        joined.schema["row"], T.StructField("n_words", T.LongType()), T.StructField("n_removed", T.LongType()),
        T.StructField("kept_text", T.StringType()), T.StructField("spans", span),
    ])

    def stripped(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        unpack = zstandard.ZstdDecompressor().decompress
        for batch in batches:
            texts = [unpack(x) for x in batch.column(1).to_pylist()]
            out = []
            for whole, found in zip(texts, batch.column(2).to_pylist()):
                words = whole.split()  # bytes: splits at ASCII white space
                spans, left, at = [], [], 0
                for f in found or ():
                    if spans and f["begin"] <= spans[-1]["end"]:
                        spans[-1]["end"] = max(spans[-1]["end"], f["end"])
                    else:
                        spans.append(f)
                for s in spans:
                    left += words[at : s["begin"]]
                    at = s["end"]
                left += words[at:]
                out.append((len(words), len(words) - len(left), b" ".join(left).decode("utf-8"), spans))
            columns = [pa.array(list(c), k) for c, k in zip(zip(*out), kinds)] if out else [pa.array([], k) for k in kinds]
            yield pa.RecordBatch.from_arrays([_with_texts(batch.column(0), text_col, texts), *columns], names=schema.names)

    kinds = [pa.int64(), pa.int64(), pa.string(), pa.list_(pa.struct([("begin", pa.int32()), ("end", pa.int32())]))]
    return joined.mapInArrow(stripped, schema)


def _packed(rows: DataFrame, text_col: str) -> DataFrame:
    """(``row``, ``id``, ``digest``, ``text``) with the text compressed, as ``packed``, and taken out of the row where it is a string: empty if not null."""
    schema = T.StructType([rows.schema["row"], rows.schema["id"], rows.schema["digest"], T.StructField("packed", T.BinaryType())])

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pressed = zstandard.ZstdCompressor(1).compress
        for batch in batches:
            texts = pa.array([pressed(x.as_py().encode("utf-8")) for x in batch.column(3)], pa.binary())
            yield pa.RecordBatch.from_arrays([_with_texts(batch.column(0), text_col, [b""] * len(texts)), batch.column(1), batch.column(2), texts], names=schema.names)

    return rows.mapInArrow(pack, schema)


def _with_texts(rows: pa.StructArray, text_col: str, texts: list[bytes]) -> pa.StructArray:
    """The rows with other texts, if theirs are strings; nulls stay null."""
    at = rows.type.get_field_index(text_col)
    if not (pa.types.is_string(rows.type[at].type) or pa.types.is_large_string(rows.type[at].type)):
        return rows
    old = rows.field(at)
    new = pa.array([t.decode("utf-8") if there else None for t, there in zip(texts, old.is_valid().to_pylist())], rows.type[at].type)
    return pa.StructArray.from_arrays([new if k == at else rows.field(k) for k in range(rows.type.num_fields)], fields=list(rows.type))
