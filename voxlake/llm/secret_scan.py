"""Secrets in texts: fixed patterns, and a linear-chain conditional random field that adds what they miss.

A text is cut into tokens: runs of letters, digits and ``_ + / . -`` (with everything outside ASCII), and runs of other
signs. A token is tagged as the begin of a secret, inside one, or outside, by the scores of nine features and of the
step from tag to tag: its own shape and word, the shapes of its neighbours, the words before and behind it, and a class
of the file (its length, its share of tokens with digits, its share of sign tokens). Viterbi decoding finds the best
tags of the whole text.

The field is trained in numpy on windows from a bounded sample of rows, whose tags are what the fixed patterns find;
windows around other tokens with digits and around plain ones are the counterexamples.

Most tokens are outside whatever their neighbours are: changing a tag to outside changes two steps, by at most twice the
range of the step scores, so a token whose own scores prefer outside by more is outside on the best path. The rest falls
into short stretches between such tokens, which are decoded each; the result is that of decoding the text at once.

Cases: a null text is empty and has no spans; places are code points; ties go to outside; spans of the field that touch
a span of the patterns are left out; rows that repeat get the same answer; without any secret in the sample nothing is
added; an empty table gives an empty one.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from voxlake.llm.common import WORD, hash_share, hashed_words, map_arrow, texts

#: Fixed patterns, in the order in which kinds stand; letters of the keywords in either case.
KINDS = ("assign", "access", "hex")
ASSIGN = re.compile(rb"""((?i:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""")
ACCESS = re.compile(rb"AKIA[A-Z0-9]+")
HEX = re.compile(rb"[0-9a-f]+")
KEYWORDS = (b"password", b"passwd", b"secret", b"token", b"apikey", b"api_key")
MIN_VALUE, MIN_ACCESS, MIN_HEX = 8, 16, 32
FIELD_KIND = "crf"

#: Rows that the field is trained on, on average at most, and windows of each kind from one row.
SAMPLE_ROWS = 6_000
WINDOWS_PER_ROW = 3
REACH = 20

OUTSIDE, BEGIN, INSIDE = 0, 1, 2
WORDS = 1 << 10
SHAPES = 7 * 4 * 5 * 2 * 2
FILES = 64
#: Sizes of the tables: own shape, shapes before and behind, own word, three words before, one behind, file class.
TABLES = (SHAPES + 1, SHAPES + 1, SHAPES + 1, WORDS + 1, WORDS + 1, WORDS + 1, WORDS + 1, WORDS + 1, FILES)


def _flags(*ranges: tuple[int, int]) -> np.ndarray:
    table = np.zeros(256, bool)
    for low, high in ranges:
        table[low : high + 1] = True
    return table


_DIGIT, _UPPER, _LOWER = _flags((48, 57)), _flags((65, 90)), _flags((97, 122))
_VALUE = _flags((48, 57), (65, 90), (97, 122), (128, 255))
_VALUE[list(b"_+/.-")] = True
_HEXADECIMAL = _flags((48, 57), (97, 102))
_TO_LOWER = np.arange(256, dtype=np.uint8)
_TO_LOWER[65:91] += 32


# ------------------------------------------------------------------ the fixed patterns


def pattern_spans(text: bytes) -> list[tuple[int, int, int, int]]:
    """``start, end, kind, start of the value`` in bytes, by start and then kind."""
    found = [(m.start(), m.end(), 0, m.start(2)) for m in ASSIGN.finditer(text) if m.end(2) - m.start(2) >= MIN_VALUE]
    found += [(m.start(), m.end(), 1, m.start()) for m in ACCESS.finditer(text) if m.end() - m.start() >= MIN_ACCESS]
    found += [(m.start(), m.end(), 2, m.start()) for m in HEX.finditer(text) if m.end() - m.start() >= MIN_HEX]
    return sorted(found, key=lambda s: (s[0], s[2]))


def _candidates(raw: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    """Rows that can hold a match: with a keyword, with the access prefix, or with two hex digits 16 bytes apart twice over."""
    data, places = raw.tobytes(), []
    lowered = data.lower()
    for needle, hay in [*((k, lowered) for k in KEYWORDS), (b"AKIA", data)]:
        at = hay.find(needle)
        while at >= 0:
            places.append(at)
            at = hay.find(needle, at + 1)
    sampled = _HEXADECIMAL[raw[::16]]
    places += (16 * np.flatnonzero(sampled[1:] & sampled[:-1])).tolist()
    rows = np.searchsorted(bounds, np.array(places, np.int64), "right") - 1
    return np.unique(rows)


def spans_of_rows(raw: np.ndarray, bounds: np.ndarray) -> dict[int, list[tuple[int, int, int, int]]]:
    """The spans of every row that has some. The hex sample may show a row only by the run's second place."""
    found = {}
    for row in _candidates(raw, bounds).tolist():
        spans = pattern_spans(raw[bounds[row] : bounds[row + 1]].tobytes())
        if spans:
            found[row] = spans
    return found


# ------------------------------------------------------------------ tokens and features


@dataclass
class Tokens:
    """Tokens of a run of rows: places, the first token of each row, and a feature table per column."""

    starts: np.ndarray
    ends: np.ndarray
    first: np.ndarray
    features: list[np.ndarray]
    digits: np.ndarray


def tokens(raw: np.ndarray, bounds: np.ndarray) -> Tokens:
    inside, value = WORD[raw], _VALUE[raw]
    opens = inside.copy()
    opens[1:] &= ~inside[:-1] | (value[1:] != value[:-1])
    filled = bounds[:-1] < bounds[1:]
    heads, tails = bounds[:-1][filled], bounds[1:][filled] - 1
    opens[heads] = inside[heads]
    closes = inside.copy()
    if len(raw):
        closes[:-1] &= ~inside[1:] | (value[1:] != value[:-1])
        closes[tails] = inside[tails]
    starts, ends = np.flatnonzero(opens), np.flatnonzero(closes) + 1
    first = np.searchsorted(starts, bounds)
    n = len(starts)
    if not n:
        return Tokens(starts, ends, first, [np.zeros(0, np.int32) for _ in TABLES], np.zeros(0, np.int32))

    def count(flags: np.ndarray) -> np.ndarray:
        sums = np.zeros(len(raw) + 1, np.int32)
        np.cumsum(flags[raw], dtype=np.int32, out=sums[1:])
        return sums[ends] - sums[starts]

    length = (ends - starts).astype(np.int32)
    digits, upper, lower = count(_DIGIT), count(_UPPER), count(_LOWER)
    size = np.searchsorted(np.array([3, 6, 8, 16, 24, 40]), length, "right")
    share = np.where(digits == 0, 0, np.where(digits == length, 3, np.where(4 * digits < length, 1, 2)))
    title = _UPPER[raw[starts]] & (upper == 1)
    case = np.where(upper + lower == 0, 0, np.where(upper == 0, 1, np.where(lower == 0, 2, np.where(title, 3, 4))))
    other = (digits + upper + lower < length).astype(np.int32)
    sign = (~value[starts]).astype(np.int32)
    shape = ((((size * 4 + share) * 5 + case) * 2 + other) * 2 + sign).astype(np.int32)
    word = (hashed_words(_TO_LOWER[raw], starts, ends) >> np.uint64(54)).astype(np.int32)
    word = np.where((digits == 0) & (length <= 16), word, WORDS)

    edge = np.zeros(n + 1, bool)
    edge[first] = True

    def moved(values: np.ndarray, by: int, none: int) -> np.ndarray:
        """The value ``by`` tokens on (back, if negative) in the same row."""
        out = np.full(n, none, np.int32)
        if abs(by) < n:
            if by > 0:
                out[:-by] = values[by:]
            else:
                out[-by:] = values[:by]
        row_starts = np.unique(first[:-1])
        for k in range(abs(by)):
            cut = row_starts + k if by < 0 else np.unique(first[1:]) - 1 - k
            out[cut[(cut >= 0) & (cut < n)]] = none
        return out

    per_row = np.diff(first)
    sums = lambda x: np.diff(np.concatenate([[0], np.cumsum(x)])[first])
    total = np.maximum(per_row, 1)
    bins = lambda x, edges: np.searchsorted(np.array(edges), x, "right")
    file = (bins(per_row, [50, 300, 1500]) * 4 + bins(sums(digits > 0) / total, [0.001, 0.02, 0.15])) * 4
    file = (file + bins(sums(sign) / total, [0.02, 0.1, 0.4])).astype(np.int32)
    features = [shape, moved(shape, -1, SHAPES), moved(shape, 1, SHAPES), word]
    features += [moved(word, -k, WORDS) for k in (1, 2, 3)] + [moved(word, 1, WORDS), np.repeat(file, per_row)]
    return Tokens(starts, ends, first, features, digits)


def tags(found: Tokens, row: int, spans: list[tuple[int, int, int, int]], base: int) -> np.ndarray:
    """The tags of a row's tokens by its spans: begin for the first token of a value, inside for others."""
    part = slice(found.first[row], found.first[row + 1])
    out = np.zeros(part.stop - part.start, np.int8)
    for _, end, _, value in spans:
        hit = np.flatnonzero((found.starts[part] < base + end) & (found.ends[part] > base + value))
        out[hit[1:]] = INSIDE
        if len(hit):
            out[hit[0]] = BEGIN
    return out


# ------------------------------------------------------------------ the field


@dataclass(frozen=True)
class Field:
    """Scores of features, of steps from tag to tag, and of the first and the last tag."""

    tables: tuple[np.ndarray, ...]
    steps: np.ndarray
    first: np.ndarray
    last: np.ndarray

    def scores(self, features: list[np.ndarray], at=slice(None)) -> np.ndarray:
        return sum(table[column[at]] for table, column in zip(self.tables, features, strict=True))

    def reach(self) -> float:
        """The most that a change of one tag can add through the steps beside it."""
        spread = lambda x: float(x.max() - x.min())
        return 2 * max(spread(self.steps), spread(self.first), spread(self.last)) + 1e-6

    def viterbi(self, scores: np.ndarray) -> np.ndarray:
        """The best tags of one sequence."""
        n = len(scores)
        best, back = scores[0] + self.first, np.zeros((n, 3), np.int8)
        for t in range(1, n):
            through = best[:, None] + self.steps
            back[t] = through.argmax(axis=0)
            best = through.max(axis=0) + scores[t]
        out = np.zeros(n, np.int8)
        out[-1] = (best + self.last).argmax()
        for t in range(n - 1, 0, -1):
            out[t - 1] = back[t, out[t]]
        return out

    def decode(self, found: Tokens) -> np.ndarray:
        """The best tags of all rows."""
        n = len(found.starts)
        out = np.zeros(n, np.int8)
        if not n:
            return out
        gains = sum((t[:, 1:].max(axis=1) - t[:, 0])[c] for t, c in zip(self.tables, found.features, strict=True))
        unsure = np.flatnonzero(gains >= -self.reach())
        if not len(unsure):
            return out
        row = np.searchsorted(found.first, unsure, "right")
        cuts = np.flatnonzero((np.diff(unsure) > 1) | (np.diff(row) > 0)) + 1
        for part in np.split(unsure, cuts):
            low, high = int(part[0]), int(part[-1]) + 1
            of = int(np.searchsorted(found.first, low, "right")) - 1
            begin, end = int(found.first[of]), int(found.first[of + 1])
            scores = self.scores(found.features, slice(low, high)).astype(float)
            # Next to a token that is outside for sure, the step from or to it takes the place of the first or last score.
            here = Field((), self.steps, self.first if low == begin else self.steps[OUTSIDE], self.last if high == end else self.steps[:, OUTSIDE])
            out[low:high] = here.viterbi(scores)
        return out


def _log_sum(x: np.ndarray, axis: int) -> np.ndarray:
    top = x.max(axis=axis, keepdims=True)
    return np.squeeze(top, axis) + np.log(np.exp(x - top).sum(axis=axis))


def marginals(scores: np.ndarray, lengths: np.ndarray, steps: np.ndarray, first: np.ndarray, last: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Chances of each tag at each place and of each step, for padded sequences, by the forward and backward sums."""
    n, width, _ = scores.shape
    ahead, behind = np.zeros_like(scores), np.zeros_like(scores)
    ahead[:, 0] = scores[:, 0] + first
    for t in range(1, width):
        new = _log_sum(ahead[:, t - 1, :, None] + steps, 1) + scores[:, t]
        ahead[:, t] = np.where((t < lengths)[:, None], new, ahead[:, t - 1])
    behind[:, -1] = last
    for t in range(width - 2, -1, -1):
        new = _log_sum(steps + (scores[:, t + 1] + behind[:, t + 1])[:, None, :], 2)
        behind[:, t] = np.where((t + 1 < lengths)[:, None], new, last)
    total = _log_sum(ahead[:, -1] + last, 1)
    within = np.arange(width) < lengths[:, None]
    place = np.exp(ahead + behind - total[:, None, None]) * within[:, :, None]
    pair = ahead[:, :-1, :, None] + steps + (scores + behind)[:, 1:, None, :] - total[:, None, None, None]
    return place, np.exp(np.minimum(pair, 0)) * within[:, 1:, None, None]


def train(windows: list[tuple[np.ndarray, np.ndarray]], epochs: int = 8, batch: int = 256, rate: float = 0.05, decay: float = 1e-4, seed: int = 11) -> Field:
    """Adam steps on the likelihood of the tags; each window has its features (one row per token) and tags."""
    draw = np.random.default_rng(seed)
    width = max(len(y) for _, y in windows)
    features = np.zeros((len(windows), width, len(TABLES)), np.int64)
    truth, lengths = np.zeros((len(windows), width), np.int64), np.array([len(y) for _, y in windows])
    for i, (x, y) in enumerate(windows):
        features[i, : len(y)], truth[i, : len(y)] = x, y
    offsets = np.concatenate([[0], np.cumsum(TABLES)])
    features += offsets[:-1]
    weights = [np.zeros((offsets[-1], 3)), np.zeros((3, 3)), np.zeros(3), np.zeros(3)]
    moments = [(np.zeros_like(w), np.zeros_like(w)) for w in weights]
    step = 0
    for _ in range(epochs):
        order = draw.permutation(len(windows))
        for low in range(0, len(order), batch):
            pick = order[low : low + batch]
            x, y, n = features[pick], truth[pick], lengths[pick]
            within = np.arange(width) < n[:, None]
            place, pair = marginals(weights[0][x].sum(axis=2), n, *weights[1:])
            gap = place - np.eye(3)[y] * within[:, :, None]
            slopes = [np.zeros_like(w) for w in weights]
            flat = x[within]
            for k in range(3):
                slopes[0][:, k] = np.bincount(flat.ravel(), np.repeat(gap[within][:, k], len(TABLES)), offsets[-1])
            seen = np.eye(3)[y[:, :-1]][:, :, :, None] * np.eye(3)[y[:, 1:]][:, :, None, :]
            slopes[1] = (pair - seen * within[:, 1:, None, None]).sum(axis=(0, 1))
            slopes[2], slopes[3] = gap[:, 0].sum(axis=0), gap[np.arange(len(n)), n - 1].sum(axis=0)
            step += 1
            for w, g, (m, v) in zip(weights, slopes, moments, strict=True):
                g = g / len(pick) + decay * w
                m += 0.1 * (g - m)
                v += 0.001 * (g * g - v)
                w -= rate * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.999**step)) + 1e-8)
    tables = tuple(weights[0][a:b].astype(np.float32) for a, b in zip(offsets, offsets[1:], strict=False))
    return Field(tables, *weights[1:])


def windows_of(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """``features, tags`` of training windows from a share of the rows by a hash of their ids, the same in every run."""
    rows = docs.select(F.col(id_col).alias("doc"), F.col(text_col).cast("string").alias("text")).where("text is not null and doc is not null")
    chosen = rows.where(hash_share(SAMPLE_ROWS / max(1, docs.count()), F.col("doc"))).dropDuplicates(["doc"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            xs, ys = [], []
            for at, end, raw, bounds in texts(batch.column(0)):
                found, spans = tokens(raw, bounds), spans_of_rows(raw, bounds)
                table = np.stack(found.features, axis=1).astype("<i2") if len(found.starts) else None
                for row in range(end - at):
                    low, high = int(found.first[row]), int(found.first[row + 1])
                    if low == high:
                        continue
                    y = tags(found, row, spans.get(row, []), int(bounds[row]))
                    begins = np.flatnonzero(y == BEGIN)
                    other = np.flatnonzero((found.digits[low:high] > 0) & (y == OUTSIDE))
                    plain = (np.arange(1, 3) * 2654435761 + high - low) % (high - low)
                    for centre in np.unique(np.concatenate([begins[:WINDOWS_PER_ROW], other[:: max(1, len(other) // WINDOWS_PER_ROW)][:WINDOWS_PER_ROW], plain])):
                        a, b = max(0, int(centre) - REACH), min(high - low, int(centre) + REACH + 1)
                        xs.append(table[low + a : low + b].tobytes())
                        ys.append(y[a:b].tobytes())
            yield pa.RecordBatch.from_arrays([pa.array(xs, pa.binary()), pa.array(ys, pa.binary())], names=["features", "tags"])

    return map_arrow(chosen.select("text"), run, "features binary, tags binary")


def fit(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text") -> Field | None:
    rows = sorted((bytes(r["features"]), bytes(r["tags"])) for r in windows_of(docs, id_col, text_col).collect())
    if not any(BEGIN in y for _, y in rows):
        return None
    return train([(np.frombuffer(x, "<i2").reshape(-1, len(TABLES)), np.frombuffer(y, np.int8)) for x, y in rows])


def field_spans(field: Field, raw: np.ndarray, bounds: np.ndarray) -> dict[int, list[tuple[int, int]]]:
    """Byte spans that the field tags, by row; an inside token without a begin before it starts a span."""
    found = tokens(raw, bounds)
    y = field.decode(found)
    out: dict[int, list[tuple[int, int]]] = {}
    for t in np.flatnonzero(y != OUTSIDE).tolist():
        row = int(np.searchsorted(found.first, t, "right")) - 1
        spans = out.setdefault(row, [])
        base = int(bounds[row])
        start, end = int(found.starts[t]) - base, int(found.ends[t]) - base
        if y[t] == INSIDE and spans and t > found.first[row] and y[t - 1] != OUTSIDE:
            spans[-1] = (spans[-1][0], end)
        else:
            spans.append((start, end))
    return out


def scan(docs: DataFrame, field: Field | None, *, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id, n_assign, n_access, n_hex, n_crf, base_sha256, spans`` for every row; spans are ``kind:start:end``."""
    chosen = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    kind = chosen.schema["doc_id"].dataType.simpleString()
    shared = docs.sparkSession.sparkContext.broadcast(field)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        trained = shared.value
        nothing = hashlib.sha256(b"").hexdigest()
        for batch in batches:
            n = len(batch)
            counts = np.zeros((4, n), np.int64)
            digests, listed = [nothing] * n, [""] * n
            for at, _, raw, bounds in texts(batch.column(1)):
                fixed = spans_of_rows(raw, bounds)
                added = field_spans(trained, raw, bounds) if trained else {}
                for row in fixed.keys() | added.keys():
                    data = raw[bounds[row] : bounds[row + 1]].tobytes()
                    points = lambda place, data=data: len(data[:place].decode("utf-8"))
                    base = [(points(a), points(b), k) for a, b, k, _ in fixed.get(row, [])]
                    more = [(points(a), points(b), 3) for a, b in added.get(row, []) if not any(a < d and c < b for c, d, _, _ in fixed.get(row, []))]
                    for _, _, k in base + more:
                        counts[k, at + row] += 1
                    text = lambda spans: ",".join(f"{(*KINDS, FIELD_KIND)[k]}:{a}:{b}" for a, b, k in spans)
                    digests[at + row] = hashlib.sha256(text(base).encode()).hexdigest()
                    listed[at + row] = text(sorted(base + more, key=lambda s: (s[0], s[2])))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), *map(pa.array, counts), pa.array(digests, pa.string()), pa.array(listed, pa.string())],
                names=["doc_id", "n_assign", "n_access", "n_hex", "n_crf", "base_sha256", "spans"],
            )

    return map_arrow(chosen, run, f"doc_id {kind}, n_assign long, n_access long, n_hex long, n_crf long, base_sha256 string, spans string")
