"""Hierarchical packing of tokenised documents into sequences of several lengths.

Every task tokenises its documents and packs them batch by batch, so nothing is shuffled and no task holds more than one
batch.  Whole windows are cut off first; what is left of a document is routed to the tier of the next power of two, and
opens a window of that length there.  Tiers are packed from the longest down: the gap of a window is filled with the
longest rests of shorter tiers that fit, and the last tokens of a gap are cut off the shortest one at hand.  At the end of
a batch one window may be short; it is cut at powers of two.  So every sequence has a power of two as its length.

Step groups: the sequences of a batch, longest first, are dealt to groups of STEP_TOKENS tokens; as all lengths are powers
of two each group but the last of a batch is exactly full, and its sequences are of nearly one length.
"""

from __future__ import annotations

import os
import zlib
from array import array
from bisect import bisect_right, insort
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame

from hourgrid.llm.common import col, text_of

LONGEST = 2048
END_ID = 1
STEP_TOKENS = 32 * LONGEST
WORDS_KEPT = 1 << 21  # words whose ids a worker remembers, and half again as many pieces of words
STRETCH = 1 << 20  # bytes of a text that are split into words at once

PIECES = "doc_id {id}, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long, sequence_length long, step_group long"


class WordIds:
    """Token ids of texts as little-endian 32-bit integers, word by word.

    The tokenizer drops white space and neither joins nor normalises across it, so the ids of a text are those of its
    words, split at ASCII white space, one after another.  New words go through the tokenizer's own normalizer and
    pre-tokenizer; each of the pieces that come out is encoded once.  A text that spells out an added token is left to the
    tokenizer as a whole, and so are words that hold other white space.

    When half of what may be kept is reached, the words so far become the older ones, in place of those before; a word that
    is met again moves to the newer ones, so frequent words are learnt once.
    """

    def __init__(self, path: str, words_kept: int = WORDS_KEPT):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.added = [t.content for t in self.tokenizer.get_added_tokens_decoder().values()]
        self.words_kept = words_kept
        self.words: dict[bytes, bytes] = {}
        self.older_words: dict[bytes, bytes] = {}
        self.pieces: dict[str, bytes] = {}
        self.older_pieces: dict[str, bytes] = {}

    def encoded(self, text: str) -> bytes:
        return array("I", self.tokenizer.encode(text, add_special_tokens=False).ids).tobytes()

    def _piece(self, piece: str) -> bytes:
        ids = self.older_pieces.get(piece) or array("I", [t.id for t in self.tokenizer.model.tokenize(piece)]).tobytes()
        self.pieces[piece] = ids
        return ids

    def _learn(self, words: list[bytes]) -> None:
        text = self.tokenizer.normalizer.normalize_str(b" ".join(words).decode("utf-8"))
        if text.count(" ") != len(words) - 1:
            self.words.update((w, self.encoded(w.decode("utf-8"))) for w in words)
            return
        known, at, end, ids = self.pieces, 0, text.find(" "), b""
        for piece, (start, _) in self.tokenizer.pre_tokenizer.pre_tokenize_str(text):
            while -1 < end < start:  # a word is over
                self.words[words[at]] = ids
                at, end, ids = at + 1, text.find(" ", end + 1), b""
            ids += known.get(piece) or self._piece(piece)
        self.words[words[at]] = ids
        self.words.update(dict.fromkeys(words[at + 1 :], b""))  # of which the pre-tokenizer leaves nothing

    def _meet(self, words: set[bytes]) -> None:
        """Words that are none of the newer ones."""
        if len(self.words) > self.words_kept // 2:
            self.older_words, self.words = self.words, {}
        if len(self.pieces) > self.words_kept * 3 // 4:
            self.older_pieces, self.pieces = self.pieces, {}
        again = words & self.older_words.keys()
        self.words.update((w, self.older_words[w]) for w in again)
        if len(again) < len(words):
            self._learn(list(words - again))

    def __call__(self, text: str) -> bytes:
        if any(token in text for token in self.added):
            return self.encoded(text)
        raw, out, at = text.encode("utf-8"), [], 0
        while at < len(raw):
            to = at + STRETCH
            while to < len(raw) and raw[to] not in b" \t\n\r\x0b\x0c":
                to += 1
            words = raw[at:to].split()
            ids = list(map(self.words.get, words))
            if None in ids:
                self._meet({w for w, known in zip(words, ids) if known is None})
                ids = [self.words[w] if known is None else known for w, known in zip(words, ids)]
            out.append(b"".join(ids))
            at = to
        return b"".join(out)


_LOADED: dict[tuple[str, int], WordIds] = {}  # of this worker


def word_ids(path: str, words_kept: int) -> WordIds:
    if (path, words_kept) not in _LOADED:
        _LOADED[path, words_kept] = WordIds(path, words_kept)
    return _LOADED[path, words_kept]


def tier_of(length: int) -> int:
    """The shortest window, a power of two, that holds so many tokens."""
    return 1 << (length - 1).bit_length()


def pack(rests: list[tuple[int, int]], longest: int = LONGEST) -> list[list[tuple[int, int, int]]]:
    """Pack rests (length, number), each shorter than ``longest``, into windows: lists of (number, from, length).

    The length of each window is a power of two; ``from`` counts from the start of the rest.
    """
    todo = sorted((length, number, 0) for length, number in rests if length)
    windows = []
    while todo:
        length, number, at = todo.pop()  # the longest rest opens a window of its tier
        window, gap = [(number, at, length)], min(tier_of(length), longest) - length
        while gap and todo:
            k = bisect_right(todo, (gap, float("inf"), 0)) - 1
            length, number, at = todo.pop(max(k, 0))
            take = min(length, gap)
            window.append((number, at, take))
            gap -= take
            if take < length:
                insort(todo, (length - take, number, at + take))
        windows += [window] if not gap else _cut(window)
    return windows


def _cut(window: list[tuple[int, int, int]]) -> list[list[tuple[int, int, int]]]:
    """A window that is not full, cut at powers of two."""
    left, cuts = sum(length for *_, length in window), []
    room = 0
    for number, at, length in window:
        while length:
            if not room:
                room = 1 << (left.bit_length() - 1)
                cuts.append([])
            take = min(room, length)
            cuts[-1].append((number, at, take))
            at, length, room, left = at + take, length - take, room - take, left - take
    return cuts


def _pieces(ids: list[bytes], longest: int) -> list[list[tuple[int, int, int]]]:
    """Sequences of one batch, longest first: lists of (document, start, length)."""
    sequences, rests, base = [], [], []
    for number, raw in enumerate(ids):
        tokens = len(raw) // 4
        whole = tokens - tokens % longest
        sequences += [[(number, at, longest)] for at in range(0, whole, longest)]
        rests.append((tokens - whole, number))
        base.append(whole)
    packed = [[(number, base[number] + at, length) for number, at, length in window] for window in pack(rests, longest)]
    return sorted(sequences + packed, key=lambda s: -sum(length for *_, length in s))


def pack_documents(docs: DataFrame, tokenizer: str, id_col: str = "doc_id", text_col: str = "text", longest: int = LONGEST, end_id: int = END_ID, words_kept: int = WORDS_KEPT) -> DataFrame:
    """One row per piece of a document: where it lies in the document and in its sequence, and a checksum of its ids.

    - ``tokenizer`` is the path of a tokenizer file on the executors.  Each document's ids end with ``end_id``.  ``words_kept``
      sets what a worker remembers, and holds as long as it lives; fewer words take less memory and more time.
    - A null or empty text is the end token alone.  Rows that repeat or share an identifier are packed one by one; a null
      identifier stays null.  An empty table gives no rows.  Only the two named columns are read.
    - Sequence and group numbers are unique over the whole result (partition number, then a counter), not dense.
    """
    slim = docs.select(col(id_col).alias("doc_id"), text_of(docs, text_col).alias("text"))
    schema = PIECES.format(id=slim.schema["doc_id"].dataType.simpleString())
    names = [c.split()[0] for c in schema.split(", ")]
    end = np.array([end_id], "<u4").tobytes()

    def packed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode, first = word_ids(tokenizer, words_kept), TaskContext.get().partitionId() << 40
        sequence = group = first
        for batch in batches:
            ids = [encode(text.as_py()) + end for text in batch.column(1)]
            where, rows, room = [], [], STEP_TOKENS
            for pieces in _pieces(ids, longest):
                size, offset = sum(length for *_, length in pieces), 0
                if size > room:
                    group, room = group + 1, STEP_TOKENS
                room -= size
                for number, start, length in pieces:
                    raw = ids[number]
                    where.append(number)
                    rows.append((start, length, zlib.crc32(raw[4 * start : 4 * (start + length)]), len(raw) // 4, sequence, offset, size, group))
                    offset += length
                sequence += 1
            group += 1
            columns = [pa.array(c, pa.int64()) for c in zip(*rows)] or [pa.array([], pa.int64())] * 8
            yield pa.RecordBatch.from_arrays([batch.column(0).take(pa.array(where, pa.int64())), *columns], names=names)

    return slim.mapInArrow(packed, schema)
