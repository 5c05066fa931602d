"""Language identification: averaged embeddings of hashed subwords under a linear softmax, with calibrated rejection.

A text is lower-cased; everything in ASCII that is no letter bounds words. Its subwords are the runs of 2 to 4 bytes of
a word together with a bound in front or behind, each hashed into one of ``BUCKETS`` rows of an embedding table. The
mean of the rows goes through a linear layer and a softmax. Both are trained together by stochastic gradient descent in
numpy on a bounded sample of labelled rows; a quarter of the sample is held back to fit the temperature of the softmax
and the score below which a prediction is rejected.

As the layers are linear, a trained model is one table of logits per bucket, which tasks sum over whole texts.

Cases: a null text, or one without a letter, is ``und`` with score 0 and rejected; without labelled rows every text is;
ties go to the label that is first in code point order; rows that repeat get the same answer; an empty table gives an
empty one. Only the text column is an input of a prediction.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from voxlake.llm.common import hash_share, map_arrow, texts

#: Bucket numbers fit into 16 bits.
BUCKETS = 1 << 15
ORDERS = (2, 3, 4)
DIMENSIONS = 16
#: Rows that a model is fitted to, on average at most: so many of a language, and so many of all.
SAMPLE_PER_LANGUAGE = 1000
SAMPLE_ROWS = 16_000
#: Languages that a model tells apart, at most: the most frequent labels.
LANGUAGES = 256
#: A prediction is rejected when fewer than this share of the held-back rows score as low, and never from this score on.
REJECTED_SHARE = 0.001
NEVER_REJECTED = 0.4
UNKNOWN = "und"

_LETTER = np.zeros(256, bool)
_LETTER[[*range(65, 91), *range(97, 123), *range(128, 256)]] = True
_ASCII_LETTER = np.zeros(256, bool)
_ASCII_LETTER[[*range(65, 91), *range(97, 123)]] = True
_SPACE = np.uint8(32)


def subwords(raw: np.ndarray, bounds: np.ndarray) -> list[tuple[np.ndarray, np.ndarray]]:
    """For each order: the buckets of all subwords in row order, and where those of each row begin (and the last end)."""
    rows, lengths = len(bounds) - 1, np.diff(bounds)
    spaced = np.full(len(raw) + rows + 1, _SPACE, np.uint8)
    spaced[np.arange(len(raw)) + np.repeat(np.arange(1, rows + 1), lengths)] = np.where(_LETTER[raw], raw, _SPACE)
    heads = bounds + np.arange(rows + 1)  # the bound before each row
    space = spaced == _SPACE
    found = []
    for order in ORDERS:
        n = len(spaced) - order + 1
        if n <= 0:
            found.append((np.zeros(0, np.int64), np.zeros(rows + 1, np.int64)))
            continue
        valid = ~(space[:n] & space[order - 1 : order - 1 + n])
        code = spaced[:n].astype(np.uint64)
        for i in range(1, order):
            code |= spaced[i : i + n].astype(np.uint64) << np.uint64(8 * i)
            if i < order - 1:
                valid &= ~space[i : i + n]
        at = np.flatnonzero(valid)
        code = (code[at] + np.uint64(order << 40)) * np.uint64(0x9E3779B97F4A7C15)
        found.append(((code >> np.uint64(49)).astype(np.int64), np.searchsorted(at, heads)))
    return found


def has_letter(column: pa.Array, raw: np.ndarray, bounds: np.ndarray, first: int) -> np.ndarray:
    sums = np.concatenate([[0], np.cumsum(_ASCII_LETTER[raw])])
    found = sums[bounds[1:]] > sums[bounds[:-1]]
    for i in np.flatnonzero(~found & (np.diff(bounds) > 0)):
        found[i] = any(c.isalpha() for c in column[first + int(i)].as_py())
    return found


@dataclass(frozen=True)
class Model:
    labels: tuple[str, ...]
    #: Logit of each label (row) for each bucket, and its bias, over the temperature.
    logits: np.ndarray
    bias: np.ndarray
    threshold: float

    def predict(self, column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """The place of the label of each text, -1 for unknown, and its score."""
        best, score = np.full(len(column), -1), np.zeros(len(column))
        if not self.labels:
            return best, score
        lowered = pc.utf8_lower(column.cast(pa.large_string()))
        for at, end, raw, bounds in texts(lowered):
            sums, counts = np.zeros((len(self.labels), end - at)), np.zeros(end - at)
            for buckets, heads in subwords(raw, bounds):
                counts += np.diff(heads)
                for k in range(len(self.labels)):
                    sums[k] += np.diff(np.concatenate([[0.0], np.cumsum(self.logits[k][buckets], dtype=np.float64)])[heads])
            known = has_letter(lowered, raw, bounds, at)
            means = sums / np.maximum(counts, 1) + self.bias[:, None]
            means -= means.max(axis=0)
            chances = np.exp(means)
            chances /= chances.sum(axis=0)
            best[at:end] = np.where(known, chances.argmax(axis=0), -1)
            score[at:end] = np.where(known, chances.max(axis=0), 0.0)
        return best, score


def learnable(id_col: Column) -> Column:
    """Rows to learn from: the checksum of the id, as text, leaves a remainder by 5."""
    return F.crc32(id_col.cast("string")) % 5 != 0


def held_out(id_col: Column) -> Column:
    return F.coalesce(F.crc32(id_col.cast("string")) % 5 == 0, F.lit(False))


def sample(docs: DataFrame, id_col: str, text_col: str, label_col: str) -> DataFrame:
    """``label, calibrate, buckets, counts`` of labelled rows: of each language a share by a hash of their ids, the same in every run."""
    rows = docs.where(learnable(F.col(id_col)) & F.col(label_col).isNotNull() & F.col(text_col).isNotNull()).select(
        F.col(id_col).alias("doc"), F.col(label_col).cast("string").alias("label"), F.col(text_col).cast("string").alias("text")
    )
    frequent = rows.groupBy("label").count().orderBy(F.desc("count"), "label").limit(LANGUAGES).collect()
    each = min(SAMPLE_PER_LANGUAGE, SAMPLE_ROWS // max(1, len(frequent)))
    drawn = F.lit(False)
    for row in frequent:
        drawn = F.when(F.col("label") == row["label"], hash_share(each / row["count"], F.col("doc"))).otherwise(drawn)
    texts_of = rows.where(drawn).dropDuplicates(["doc", "label"])

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lowered = pc.utf8_lower(batch.column(2).cast(pa.large_string()))
            found, n = [], []
            for at, end, raw, bounds in texts(lowered):
                parts = subwords(raw, bounds)
                for row in range(end - at):
                    sums = np.bincount(np.concatenate([b[h[row] : h[row + 1]] for b, h in parts]), minlength=1)
                    seen = np.flatnonzero(sums)
                    found.append(seen.astype("<u2").tobytes())
                    n.append(sums[seen].astype("<u4").tobytes())
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(found, pa.binary()), pa.array(n, pa.binary())],
                names=["calibrate", "label", "buckets", "counts"],
            )

    keyed = texts_of.select((F.pmod(F.xxhash64(F.lit("calibrate"), "doc"), F.lit(4)) == 0).alias("calibrate"), "label", "text")
    return map_arrow(keyed, count, "calibrate boolean, label string, buckets binary, counts binary")


def softmax(x: np.ndarray) -> np.ndarray:
    e = np.exp(x - x.max(axis=-1, keepdims=True))
    return e / e.sum(axis=-1, keepdims=True)


def train(
    labels: list[int], rows: list[tuple[np.ndarray, np.ndarray]], n_labels: int, epochs: int = 12, rate: float = 4.0, seed: int = 7
) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Embeddings, linear layer and bias; ``rows`` has the buckets of each text and their shares of its subwords."""
    draw = np.random.default_rng(seed)
    table = draw.normal(0, 1 / DIMENSIONS, (BUCKETS, DIMENSIONS))
    layer, bias = draw.normal(0, 1 / np.sqrt(DIMENSIONS), (n_labels, DIMENSIONS)), np.zeros(n_labels)
    steps, done = epochs * len(rows), 0
    for _ in range(epochs):
        for i in draw.permutation(len(rows)):
            pace = rate * (1 - done / steps)
            done += 1
            buckets, shares = rows[i]
            mean = shares @ table[buckets]
            gap = softmax(layer @ mean + bias)
            gap[labels[i]] -= 1
            back = layer.T @ gap
            layer -= 0.1 * pace * np.outer(gap, mean)
            bias -= 0.01 * pace * gap
            table[buckets] -= pace * np.outer(shares, back)
    return table, layer, bias


def temperature(logits: np.ndarray, labels: np.ndarray) -> float:
    """The divisor of the logits under which the labels are most likely, on a grid of powers."""
    grid = np.exp(np.linspace(np.log(0.05), np.log(10), 60))
    losses = [-np.log(np.maximum(softmax(logits / t)[np.arange(len(labels)), labels], 1e-12)).mean() for t in grid]
    return float(grid[int(np.argmin(losses))])


def fit(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", label_col: str = "lang") -> Model:
    drawn = sorted(sample(docs, id_col, text_col, label_col).collect(), key=lambda r: (r["label"], bytes(r["buckets"]), bytes(r["counts"])))
    drawn = [r for r in drawn if r["buckets"]]
    if not drawn:
        return Model((), np.zeros((0, BUCKETS)), np.zeros(0), 0.0)
    names = sorted({r["label"] for r in drawn})
    place = {name: i for i, name in enumerate(names)}

    def shares(row) -> tuple[np.ndarray, np.ndarray]:
        counts = np.frombuffer(row["counts"], "<u4").astype(float)
        return np.frombuffer(row["buckets"], "<u2").astype(np.int64), counts / counts.sum()

    fitted = [r for r in drawn if not r["calibrate"]] or drawn
    checked = [r for r in drawn if r["calibrate"]] or drawn
    table, layer, bias = train([place[r["label"]] for r in fitted], [shares(r) for r in fitted], len(names))
    logits = layer @ table.T
    held = np.array([logits[:, b] @ s + bias for b, s in map(shares, checked)])
    truth = np.array([place[r["label"]] for r in checked])
    divisor = temperature(held, truth)
    best = softmax(held / divisor).max(axis=1)
    threshold = min(NEVER_REJECTED, float(np.quantile(best, REJECTED_SHARE)))
    return Model(tuple(names), (logits / divisor).astype(np.float32), bias / divisor, threshold)


def identify(docs: DataFrame, model: Model, *, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id, held_out, lang_pred, score, rejected`` for every row."""
    chosen = docs.select(F.col(id_col).alias("doc_id"), held_out(F.col(id_col)).alias("held_out"), F.col(text_col).cast("string").alias("text"))
    kind = chosen.schema["doc_id"].dataType.simpleString()
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = shared.value
        names = np.array([*known.labels, UNKNOWN], object)
        for batch in batches:
            best, score = known.predict(batch.column(2))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(names[best], pa.string()), pa.array(score), pa.array((best < 0) | (score < known.threshold))],
                names=["doc_id", "held_out", "lang_pred", "score", "rejected"],
            )

    return map_arrow(chosen, run, f"doc_id {kind}, held_out boolean, lang_pred string, score double, rejected boolean")


def keep_identified(docs: DataFrame, model: Model, *, text_col: str = "text") -> DataFrame:
    """The rows whose language is told with enough certainty, unchanged."""
    shared = docs.sparkSession.sparkContext.broadcast(model)
    place = docs.columns.index(text_col)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = shared.value
        for batch in batches:
            best, score = known.predict(batch.column(place))
            yield batch.filter(pa.array((best >= 0) & (score >= known.threshold)))

    return map_arrow(docs, run, docs.schema)
