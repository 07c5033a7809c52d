"""Secret scan: fixed patterns, and a linear-chain conditional random field that finds what they miss.

Texts are cut into lines, lines into tokens: runs of letters, digits and ``+/_.-``, and single symbols.  The field tags a
token as begin, inside or outside of a secret from its shape, from the tokens around it and from features of the whole
text, and the best tags of a line are found by Viterbi.  Shapes come from running counts over code points, so a whole text
is described without a loop over its tokens.  Lines in which no token could pay for leaving "outside", whatever the
transitions, are outside as a whole and need no decoding.

The field is trained on windows around the pattern matches of a bounded sample of documents (SAMPLE_DOCS), of which copies
with other values (random strings over several alphabets) and without the word that names the value are made, on such
values between two words of a text, where nothing names or marks them, on paths and identifiers made of a text's words, and
on windows from documents without a match.
"""

from __future__ import annotations

import hashlib
import random
import re
import string
import sys
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from hourgrid.llm.common import col, kept, text_of

SAMPLE_DOCS = 300  # with a match, and as many without
WINDOWS = 4  # of one sampled document
REACH = 9  # tokens on either side of a match
ROUNDS = 100
STEP = 0.1
MEMORY = (0.9, 0.99)  # of the running means of gradients and of their squares
KINDS = ("assign", "access", "hex", "crf")

# The patterns of the scan.
ASSIGN = re.compile(r"(password|passwd|secret|token|api_?key)[\"']?\x20*[:=]\x20*[\"']?([A-Za-z0-9+/_.=-]+)", re.IGNORECASE | re.ASCII)
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
HEX = re.compile(r"[0-9a-f]{24,}")
NAMES = re.compile(r"pass(?:word|wd|phrase)?|pwd|secret|token|api_?key|access_?key|private_?key|credential|auth(?:orization)?|bearer", re.IGNORECASE | re.ASCII)

Span = tuple[int, int, int]  # start, end, number of the kind


def base_spans(text: str) -> list[Span]:
    """Pattern matches, leftmost and non-overlapping for each kind, by start."""
    spans = [(m.start(), m.end(), 0) for m in ASSIGN.finditer(text) if len(m[2]) >= 6]
    spans += [(m.start(), m.end(), 1) for m in ACCESS.finditer(text) if len(m[0]) >= 20]
    spans += [(m.start(), m.end(), 2) for m in HEX.finditer(text)]  # runs are maximal, so shorter ones are only passed over
    return sorted(spans, key=lambda s: (s[0], s[2]))


SPACE, LOWER, UPPER, DIGIT, LETTER, JOINT, SYMBOL, NEWLINE = range(8)
_SEEN: dict[str, np.ndarray] = {}  # of this worker: the class of each code point


def _classes() -> np.ndarray:
    if not _SEEN:
        kinds = np.full(sys.maxunicode + 1, SYMBOL, np.uint8)
        kinds[[c for c in range(128, sys.maxunicode + 1) if chr(c).isalnum()]] = LETTER
        kinds[[c for c in range(sys.maxunicode + 1) if chr(c).isspace()]] = SPACE
        for chars, kind in ((string.ascii_lowercase, LOWER), (string.ascii_uppercase, UPPER), (string.digits, DIGIT), ("+/_.-", JOINT), ("\n", NEWLINE)):
            kinds[[ord(c) for c in chars]] = kind
        _SEEN["words"] = np.array([1 << (16 * (k - 1)) if LOWER <= k <= LETTER else 0 for k in range(8)], np.int64)
        _SEEN["joints"] = np.array([1 << 16 if k == JOINT else 0 for k in range(8)], np.int64)
        _SEEN["kinds"] = kinds
    return _SEEN["kinds"]


LENGTHS = np.array([2, 4, 6, 8, 12, 16, 20, 24, 32, 48])  # lower bounds of the buckets after the first
MARKS = "=:\"'"  # symbols told apart
L, M = len(LENGTHS) + 1, 32
#: Groups of features with their sizes: of the token, of the tokens around it and of the whole text.
OWN = (("shape_length", M * L), ("hex_length", 2 * L), ("switches_length", 4 * L), ("digits_length", 4 * L), ("mark", len(MARKS) + 2), ("name", 2))
AROUND = (
    ("before_mark", len(MARKS) + 3), ("before_name", 3), ("before2_mark", len(MARKS) + 3), ("before2_name", 3), ("before3_name", 3),
    ("after_mark", len(MARKS) + 3), ("text_symbols", 4), ("text_digits", 4),
)
GROUPS = OWN + AROUND
STARTS = np.cumsum([0, *(size for _, size in GROUPS)])
SHAPES = M * 2 * 4 * 4 * L
TAGS = 3  # outside, begin, inside


def _shape_columns(code: np.ndarray) -> list[np.ndarray]:
    """The first four feature numbers from the number of a shape."""
    code, length = np.divmod(code, L)
    code, digits = np.divmod(code, 4)
    code, switches = np.divmod(code, 4)
    shape, hexes = np.divmod(code, 2)
    return [v * L + length + start for v, start in zip((shape, hexes, switches, digits), STARTS)]


class Tokens:
    """The tokens of one text: starts, ends, line numbers; numbers of shapes, marks and names.

    Character classes are counted in fields of 16 bits of two integers, with one running sum over the text for each, read
    off at both ends of a token.  Tokens that a field cannot count are far longer than the last bucket of lengths.
    """

    def __init__(self, text: str):
        codes = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32)
        kind = _classes()[codes]
        symbol = kind == SYMBOL
        edge = np.diff(np.concatenate([[False], (kind >= LOWER) & (kind <= JOINT), [False]]).view(np.int8))
        start, end = np.flatnonzero(edge == 1), np.flatnonzero(edge == -1)
        singles = np.flatnonzero(symbol)
        if len(singles):
            start, end = np.concatenate([start, singles]), np.concatenate([end, singles + 1])
            order = np.argsort(start, kind="stable")
            start, end = start[order], end[order]
        self.start, self.end = start, end
        if not len(start):
            return
        self.line = np.searchsorted(np.flatnonzero(kind == NEWLINE), start)
        size, last, own = end - start, end - 1, kind[start]
        hexes = (codes >= 97) & (codes <= 102) | (kind == DIGIT)
        switch = np.concatenate([[False], kind[1:] != kind[:-1]])
        words = np.cumsum(_SEEN["words"][kind])
        words = words[last] - words[start]  # without a token's first character
        other = np.cumsum(_SEEN["joints"][kind] + hexes + (switch * np.int64(1 << 32)))
        other = other[last] - other[start]
        counts = [words >> (16 * k) & 0xFFFF for k in range(4)] + [other >> 16 & 0xFFFF]
        shape = sum(((c > 0) | (own == k + 1)).astype(np.int32) << k for k, c in enumerate(counts))
        digits = counts[2] + (own == DIGIT)
        hexes = (other & 0xFFFF) + hexes[start] == size
        switches = np.searchsorted([1, 4, 10], other >> 32 & 0xFFFF, "right")
        length = np.searchsorted(LENGTHS, size, "right")
        self.code = (((shape * 2 + hexes) * 4 + switches) * 4 + np.searchsorted([0.01, 0.25, 0.6], digits / size)) * L + length
        self.mark = np.zeros(len(start), np.int32)
        single = np.flatnonzero(symbol[start])
        self.mark[single] = len(MARKS) + 1
        for k, c in enumerate(MARKS):
            self.mark[single[codes[start[single]] == ord(c)]] = k + 1
        self.name = np.zeros(len(start), np.int32)
        for m in NAMES.finditer(text):
            at = int(np.searchsorted(start, m.end() - 1, "right")) - 1
            if size[at] <= 2 * len(m[0]) + 4:
                self.name[at] = 1
        self.shares = [int(np.searchsorted([0.02, 0.1, 0.3], share)) for share in (symbol.mean(), (kind == DIGIT).mean())]

    def __len__(self) -> int:
        return len(self.start)

    def lines_of(self, at: np.ndarray) -> list[tuple[int, int]]:
        """First and behind-last token of the lines that hold the given tokens."""
        numbers = np.unique(self.line[at])
        return list(zip(np.searchsorted(self.line, numbers).tolist(), np.searchsorted(self.line, numbers + 1).tolist()))

    def around(self) -> list[np.ndarray]:
        """Values of the groups AROUND; a token has neighbours in its own line only."""
        n, line = len(self), self.line

        def shifted(values: np.ndarray, by: int, none: int) -> np.ndarray:
            out = np.full(n, none)
            if abs(by) < n:
                to, since = (slice(-by, None), slice(None, by)) if by < 0 else (slice(None, -by), slice(by, None))
                out[to] = np.where(line[to] == line[since], values[since], none)
            return out

        mark, name, no_mark = self.mark, self.name, len(MARKS) + 2
        return [
            shifted(mark, -1, no_mark), shifted(name, -1, 2), shifted(mark, -2, no_mark), shifted(name, -2, 2), shifted(name, -3, 2),
            shifted(mark, 1, no_mark), *(np.full(n, s) for s in self.shares),
        ]

    def columns(self) -> np.ndarray:
        """Feature numbers, one column for each group."""
        numbered = [v + start for v, start in zip((self.mark, self.name, *self.around()), STARTS[4:])]
        return np.stack([*_shape_columns(self.code), *numbered], axis=1).astype(np.int32)


@dataclass
class Field:
    """Weights of a linear-chain conditional random field over the tags outside, begin and inside."""

    weights: np.ndarray  # [feature, tag]
    moves: np.ndarray  # [tag before, tag]

    def __post_init__(self) -> None:
        """Tables of what "begin" and "inside" score above "outside": one for all shapes, one for each other group."""
        above = (self.weights[:, 1:] - self.weights[:, :1]).T
        self.tables = []
        for score in above:
            shapes = sum(score[c] for c in _shape_columns(np.arange(SHAPES)))
            self.tables.append([shapes, *(score[a:b] for a, b in zip(STARTS[4:], STARTS[5:]))])
        moved = np.where(np.isfinite(self.moves), self.moves - self.moves[0, 0], 0)
        self.most_moved = 2 * max(0.0, float(moved.max()))

    def spans(self, text: str) -> list[tuple[int, int]]:
        """Secrets of a text, by Viterbi line by line."""
        t = Tokens(text)
        if not len(t):
            return []
        values = (t.code, t.mark, t.name, *t.around())
        begin, inside = (sum(table[v] for table, v in zip(tables, values)) for tables in self.tables)
        active = np.flatnonzero(np.maximum(begin, inside) > -self.most_moved)
        found = []
        for a, b in t.lines_of(active) if len(active) else ():
            tags = self.viterbi(begin[a:b].tolist(), inside[a:b].tolist())
            for k in np.flatnonzero(tags == 1):
                last = k
                while last + 1 < len(tags) and tags[last + 1] == 2:
                    last += 1
                to = int(t.end[a + last])
                while to > t.start[a + k] + 1 and text[to - 1] in ".-":
                    to -= 1
                found.append((int(t.start[a + k]), to))
        return found

    def viterbi(self, begin: list[float], inside: list[float]) -> np.ndarray:
        """The best tags of a line; "inside" follows "begin" or "inside" only."""
        (m00, m01, _), (m10, m11, m12), (m20, m21, m22) = self.moves.tolist()
        o, b, i = 0.0, begin[0], -np.inf
        back = []
        for y, z in zip(begin[1:], inside[1:]):
            o2 = max((o + m00, 0), (b + m10, 1), (i + m20, 2))
            b2 = max((o + m01, 0), (b + m11, 1), (i + m21, 2))
            i2 = max((b + m12, 1), (i + m22, 2))
            back.append((o2[1], b2[1], i2[1]))
            o, b, i = o2[0], b2[0] + y, i2[0] + z
        tag = max((o, 0), (b, 1), (i, 2))[1]
        tags = [tag]
        for step in reversed(back):
            tag = step[tag]
            tags.append(tag)
        return np.array(tags[::-1])


def fit(columns: list[np.ndarray], tags: list[np.ndarray], rounds: int = ROUNDS, ridge: float = 1e-4) -> Field:
    """Maximum likelihood by adaptive gradient steps, with forward-backward over all windows at once.

    A step is a running mean of gradients over the root of that of their squares, shorter with each round.  Old squares fade:
    the first rounds, in which all weights still have to turn to "outside", would otherwise hold rare features down for good.
    Without a window every token is outside.
    """
    features = int(STARTS[-1])
    forbidden = np.zeros((TAGS, TAGS))
    forbidden[0, 2] = -np.inf
    if not columns:
        weights = np.zeros((features, TAGS))
        weights[:, 1:] = -1.0
        return Field(weights, forbidden)
    count, width = len(columns), max(map(len, columns))
    x = np.zeros((count, width, len(GROUPS)), np.int32)
    y = np.zeros((count, width), np.int64)
    real = np.zeros((count, width), bool)
    for k, (c, t) in enumerate(zip(columns, tags)):
        x[k, : len(c)], y[k, : len(c)], real[k, : len(c)] = c, t, True
    empirical = np.eye(TAGS)[y] * real[:, :, None]
    pairs = np.zeros((TAGS, TAGS))
    np.add.at(pairs, (y[:, :-1][real[:, 1:]], y[:, 1:][real[:, 1:]]), 1)
    weights, moves = np.zeros((features, TAGS)), np.zeros((TAGS, TAGS))
    means = [(np.zeros_like(values), np.zeros_like(values)) for values in (weights, moves)]
    first = np.array([0, 0, -np.inf])
    flat = x[real]
    for turn in range(rounds):
        scores = weights[x].sum(axis=2)
        step = moves + forbidden
        alpha = np.empty((width, count, TAGS))
        alpha[0] = scores[:, 0] + first
        for t in range(1, width):
            new = _logsum(alpha[t - 1][:, :, None] + step, 1) + scores[:, t]
            alpha[t] = np.where(real[:, t, None], new, alpha[t - 1])
        total = _logsum(alpha[-1], 1)
        beta = np.zeros((count, TAGS))
        marginal = np.zeros((count, width, TAGS))
        expected = np.zeros((TAGS, TAGS))
        for t in range(width - 1, -1, -1):
            here = real[:, t]
            marginal[here, t] = np.exp(alpha[t][here] + beta[here] - total[here, None])
            if t:
                onward = (scores[:, t] + beta)[:, None, :] + step
                joint = np.exp(alpha[t - 1][:, :, None] + onward - total[:, None, None])
                expected += joint[here].sum(axis=0)
                beta = np.where(here[:, None], _logsum(onward, 2), beta)
        error = (empirical - marginal)[real]
        gradient = np.stack([sum(np.bincount(flat[:, g], error[:, tag], features) for g in range(len(GROUPS))) for tag in range(TAGS)], axis=1) / count
        gradient -= ridge * weights
        push = (pairs - expected) / count
        for values, ascent, (mean, square) in zip((weights, moves), (gradient, push), means):
            for kept_mean, new, fade in zip((mean, square), (ascent, ascent**2), MEMORY):
                kept_mean += (1 - fade) * (new - kept_mean)
            level, spread = mean / (1 - MEMORY[0] ** (turn + 1)), square / (1 - MEMORY[1] ** (turn + 1))
            values += STEP * (1 - turn / rounds) * level / (np.sqrt(spread) + 1e-8)
    return Field(weights, moves + forbidden)


def _logsum(x: np.ndarray, axis: int) -> np.ndarray:
    top = x.max(axis=axis, keepdims=True)
    top = np.where(np.isfinite(top), top, 0)
    with np.errstate(divide="ignore"):
        return np.log(np.exp(x - top).sum(axis=axis)) + top.squeeze(axis)


def _values(text: str) -> list[tuple[int, int]]:
    """Where the values of the pattern matches lie, overlaps merged."""
    spans = sorted([m.span(2) for m in ASSIGN.finditer(text) if len(m[2]) >= 6] + [(a, b) for a, b, kind in base_spans(text) if kind])
    merged: list[tuple[int, int]] = []
    for a, b in spans:
        if merged and a < merged[-1][1]:
            merged[-1] = (merged[-1][0], max(b, merged[-1][1]))
        else:
            merged.append((a, b))
    return merged


def _window(text: str, values: list[tuple[int, int]], at: int) -> tuple[np.ndarray, np.ndarray] | None:
    """Features and tags of the tokens around a place of a text, within its line."""
    t = Tokens(text)
    if not len(t):
        return None
    tags = np.zeros(len(t), np.int64)
    for a, b in values:
        inside = np.flatnonzero((t.start >= a) & (t.start < b))
        tags[inside] = 2
        tags[inside[:1]] = 1
    k = min(int(np.searchsorted(t.start, at)), len(t) - 1)
    a, b = t.lines_of(np.array([k]))[0]
    low, high = max(a, k - REACH), min(b, k + REACH)
    tags[low] = 1 if tags[low] == 2 else tags[low]
    return t.columns()[low:high], tags[low:high]


def _alphabets() -> list[str]:
    alnum = string.ascii_letters + string.digits
    return [alnum, alnum + "+/", alnum + "_-", string.digits + "ABCDEF", string.digits + "abcdef", string.ascii_uppercase + string.digits, string.ascii_lowercase + string.digits]


def windows(text: str, seed: str) -> list[tuple[np.ndarray, np.ndarray]]:
    """Training windows of one document: around its matches, their altered copies, and elsewhere."""
    rng, values, out = random.Random(seed), _values(text), []
    for a, b in values[:WINDOWS]:
        out.append(_window(text, values, a))
        low, high = max(0, a - 120), min(len(text), b + 120)
        near, x, y = text[low:high], a - low, b - low
        for keep_name in (True, False, False):
            new = "".join(rng.choices(rng.choice(_alphabets()), k=rng.randint(18, 56)))
            head = near[:x] if keep_name else NAMES.sub("the", near[:x])
            whole = head + new + near[y:]
            spans = [v for v in _values(whole) if v[1] <= len(head) or v[0] >= len(head) + len(new)]
            out.append(_window(whole, [*spans, (len(head), len(head) + len(new))], len(head)))
    gaps = [m.start() for m in re.finditer(r"(?<=\w) (?=\w)", text)]
    for gap in rng.sample(gaps, min(WINDOWS, len(gaps))):
        head, tail = text[max(0, gap - 120) : gap + 1], text[gap : gap + 120]
        new = "".join(rng.choices(rng.choice(_alphabets()), k=rng.randint(18, 56)))
        spans = [v for v in _values(head + new + tail) if v[1] <= len(head) or v[0] >= len(head) + len(new)]
        out.append(_window(head + new + tail, sorted([*spans, (len(head), len(head) + len(new))]), len(head)))
        # a path or an identifier made of the text's own words is as long, but none
        words = re.findall(r"[^\W\d_]{2,12}", head + tail) or ["x"]
        path = rng.choice(["_", "-", "/", ".", ""]).join(rng.choices(words, k=rng.randint(2, 7))) + rng.choice(["", "", ".html", str(rng.randrange(1000))])
        out.append(_window(head + path + tail, _values(head + path + tail), len(head)))
    for _ in range(2 if values else WINDOWS):
        at = rng.randrange(max(1, len(text)))
        out.append(_window(text, values, at))
    digit = re.search(r"\d", text)
    if digit:  # other numbers and names with digits are what a secret must be told from
        out += [_window(text, values, m.start()) for m, _ in zip(re.finditer(r"\S*\d\S*", text), range(WINDOWS))]
    return [w for w in out if w is not None and len(w[0])]


def train(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", sample_docs: int = SAMPLE_DOCS) -> Field:
    """Fit on windows of at most ``sample_docs`` documents with a match and as many without, those whose identifiers hash lowest."""
    slim = docs.select(col(id_col).alias("id"), text_of(docs, text_col).alias("text")).where("id is not null")
    hit = F.col("text").rlike(r"(?i:password|passwd|secret|token|api_?key)[\"']? *[:=]|AKIA[A-Z0-9]{16}|[0-9a-f]{24}")
    marked = kept(slim.select("id", hit.alias("hit")))
    lowest = [marked.where(F.col("hit") == side).orderBy(F.xxhash64("id"), "id").limit(sample_docs).select("id") for side in (True, False)]
    found = slim.join(F.broadcast(lowest[0].unionByName(lowest[1]).distinct()), "id")
    # documents that share an identifier: those whose texts hash lowest
    found = found.orderBy(F.xxhash64("id"), "id", F.xxhash64("text")).limit(2 * sample_docs).repartition("id", "text")
    sample = found.select(F.col("id").cast("string"), "text")

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [(i.as_py(), x, t) for i, text in zip(*batch.columns) for x, t in windows(text.as_py(), i.as_py())]
            rows = [[i for i, *_ in found], [x.ravel() for _, x, _ in found], [t for *_, t in found]]
            kinds = [pa.string(), pa.list_(pa.int32()), pa.list_(pa.int64())]
            yield pa.RecordBatch.from_arrays([pa.array(r, k) for r, k in zip(rows, kinds)], names=["id", "x", "t"])

    rows = sample.mapInArrow(cut, "id string, x array<int>, t array<long>").toPandas()
    x = [np.array(v, np.int32).reshape(-1, len(GROUPS)) for v in rows["x"]]
    t = [np.array(v, np.int64) for v in rows["t"]]
    order = sorted(range(len(x)), key=lambda k: (rows["id"][k], x[k].tobytes(), t[k].tobytes()))  # whatever order the tasks ended in
    return fit([x[k] for k in order], [t[k] for k in order])


def all_spans(text: str, field: Field) -> tuple[list[Span], list[Span]]:
    """Base spans, and with them the spans of the field that touch none of them."""
    base = base_spans(text)
    added = [(a, b, 3) for a, b in field.spans(text) if not any(a < e and s < b for s, e, _ in base)]
    return base, sorted(base + added, key=lambda s: (s[0], s[2]))


def written(spans: list[Span]) -> str:
    return ",".join(f"{KINDS[kind]}:{a}:{b}" for a, b, kind in spans)


def scanned(docs: DataFrame, field: Field, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per input row: ``doc_id``, ``n_assign``, ``n_access``, ``n_hex``, ``base_sha256``, ``spans``, ``n_crf``.

    Null and empty texts have no spans (``base_sha256`` is that of an empty string).  Rows that repeat or share an identifier
    are scanned one by one, equal texts give equal spans; an empty table gives none.  Only the two named columns are read.
    """
    slim = docs.select(col(id_col).alias("doc_id"), text_of(docs, text_col).alias("text"))
    schema = slim.drop("text").schema
    for name, kind in (("n_assign", "long"), ("n_access", "long"), ("n_hex", "long"), ("base_sha256", "string"), ("spans", "string"), ("n_crf", "long")):
        schema = schema.add(name, kind)

    def found(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for text in batch.column(1):
                base, spans = all_spans(text.as_py(), field)
                counts = [sum(k == kind for *_, k in spans) for kind in range(4)]
                digest = hashlib.sha256(written(base).encode()).hexdigest()
                rows.append((*counts[:3], digest, written(spans), counts[3]))
            kinds = [pa.int64()] * 3 + [pa.string()] * 2 + [pa.int64()]
            columns = [pa.array(c, k) for c, k in zip(zip(*rows) if rows else [[]] * 6, kinds)]
            yield pa.RecordBatch.from_arrays([batch.column(0), *columns], names=schema.names)

    return slim.mapInArrow(found, schema)
