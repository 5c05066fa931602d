"""Token ids as binary files: a static range asymmetric numeral system over blocks of documents.

Ids are written in ascending order of document ids, each document followed by an end id. All blocks share one table of
frequencies, counted over all ids. A block interleaves many coder states: symbol ``i`` belongs to lane ``i % lanes``, so
one array operation codes a symbol of every lane. At regular steps the block keeps the states and the place in its
words, so that parts of a block can be decoded apart; a checksum covers its ids, another the table that it was written
with. Files are Parquet with one block a row, written through Spark: ``shard, before, doc_ids, lengths, payload``.
"""

from __future__ import annotations

import os
import zlib
from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from voxlake.llm.common import WORD, hashed_words, map_arrow, staged, texts

VOCABULARY = "word_bpe_49k.json"
END_ID = 1
SCALE = 20
LANES = 1024
#: Ids of a block, at least, but for the last of a shard; a longer document is one block.
BLOCK_IDS = 1 << 18
#: Steps between checkpoints.
CHECKPOINT_STEPS = 128
#: Bytes of the texts that are tokenised at once.
RUN_BYTES = 2 << 20
_LOW = np.uint64(1 << 31)
_HEADER = np.dtype([("magic", "S4"), ("lanes", "<u4"), ("ids", "<u8"), ("every", "<u4"), ("checkpoints", "<u4"), ("words", "<u8"), ("crc", "<u4"), ("table_crc", "<u4")])
_MAGIC = b"ILR1"


# ------------------------------------------------------------------ the coder


@dataclass(frozen=True)
class Table:
    """Frequencies that add up to ``2 ** SCALE``, their running sums, and the symbol of every slot."""

    frequency: np.ndarray
    below: np.ndarray
    symbol: np.ndarray
    crc: int

    @staticmethod
    def of(frequency: np.ndarray) -> Table:
        frequency = frequency.astype(np.uint64)
        below = np.concatenate([[0], np.cumsum(frequency)[:-1]]).astype(np.uint64)
        symbol = np.repeat(np.arange(len(frequency), dtype=np.uint32), frequency.astype(np.int64))
        return Table(frequency, below, symbol, zlib.crc32(frequency.tobytes()))


def scaled(counts: np.ndarray) -> np.ndarray:
    """Counts to frequencies of at least 1 for each symbol that occurs, adding up to ``2 ** SCALE``."""
    total, room = int(counts.sum()), 1 << SCALE
    seen = counts > 0
    if not total:
        return np.concatenate([[room], np.zeros(max(0, len(counts) - 1), np.int64)]).astype(np.int64)
    if int(seen.sum()) > room:
        raise ValueError("more symbols than slots")
    spare = room - int(seen.sum())
    shares = np.where(seen, 1 + (counts.astype(object) * spare // total).astype(np.int64), 0)
    shares[int(np.argmax(counts))] += room - int(shares.sum())
    return shares.astype(np.int64)


def lanes_for(n: int) -> int:
    """A power of two with 64 steps or more, up to ``LANES``."""
    return min(LANES, 1 << max(0, (n // 64).bit_length() - 1))


def encode_block(ids: np.ndarray, table: Table) -> bytes:
    n = len(ids)
    lanes = lanes_for(n)
    steps = -(-n // lanes)
    states = np.full(lanes, _LOW, np.uint64)
    emitted: list[np.ndarray] = [None] * steps
    kept: dict[int, np.ndarray] = {}
    frequency, below = table.frequency[ids], table.below[ids]
    if n and not frequency.all():
        raise ValueError("an id has no frequency")
    for step in range(steps - 1, -1, -1):
        part = slice(step * lanes, min(n, (step + 1) * lanes))
        f, c = frequency[part], below[part]
        x = states[: len(f)]
        full = x >= (f << np.uint64(63 - SCALE))
        emitted[step] = x[full].astype(np.uint32)
        x = np.where(full, x >> np.uint64(32), x)
        quotient = x // f
        states[: len(f)] = (quotient << np.uint64(SCALE)) + (x - quotient * f) + c
        if step and step % CHECKPOINT_STEPS == 0:
            kept[step] = states.copy()
    places = np.cumsum([0, *map(len, emitted)])
    words = np.concatenate(emitted) if steps else np.zeros(0, np.uint32)
    header = np.zeros(1, _HEADER)
    header[0] = (_MAGIC, lanes, n, CHECKPOINT_STEPS, len(kept), len(words), zlib.crc32(ids.astype("<u4").tobytes()), table.crc)
    parts = [header.tobytes(), states.astype("<u8").tobytes()]
    for step in sorted(kept):
        parts += [np.array([places[step]], "<u8").tobytes(), kept[step].astype("<u8").tobytes()]
    return b"".join([*parts, words.astype("<u4").tobytes()])


def parts_of(payload: bytes) -> int:
    """How many parts of a block can be decoded apart."""
    return 1 + int(np.frombuffer(payload, _HEADER, 1)[0]["checkpoints"])


def decode_part(payload: bytes, table: Table, part: int) -> np.ndarray:
    """The ids from one checkpoint to the next."""
    head = np.frombuffer(payload, _HEADER, 1)[0]
    if head["magic"] != _MAGIC or int(head["table_crc"]) != table.crc:
        raise ValueError("not a block of this table")
    lanes, n, every = int(head["lanes"]), int(head["ids"]), int(head["every"])
    marks = int(head["checkpoints"])
    first = _HEADER.itemsize
    size = 8 * (lanes + 1)
    at = first if not part else first + 8 * lanes + (part - 1) * size + 8
    states = np.frombuffer(payload, "<u8", lanes, at).astype(np.uint64)
    place = int(np.frombuffer(payload, "<u8", 1, at - 8)[0]) if part else 0
    words = np.frombuffer(payload, "<u4", int(head["words"]), first + 8 * lanes + marks * size)
    begin, end = part * every * lanes, n if part == marks else min(n, (part + 1) * every * lanes)
    out = np.empty(end - begin, np.uint32)
    for low in range(begin, end, lanes):
        count = min(lanes, end - low)
        x = states[:count]
        slot = x & np.uint64((1 << SCALE) - 1)
        symbol = table.symbol[slot.astype(np.int64)]
        out[low - begin : low - begin + count] = symbol
        x = table.frequency[symbol] * (x >> np.uint64(SCALE)) + slot - table.below[symbol]
        short = np.flatnonzero(x < _LOW)
        x[short] = (x[short] << np.uint64(32)) | words[place : place + len(short)]
        place += len(short)
        states[:count] = x
    if part == marks and not (states == _LOW).all():
        raise ValueError("a block does not end in the state that coding began with")
    return out


def decode_block(payload: bytes, table: Table) -> np.ndarray:
    ids = np.concatenate([decode_part(payload, table, part) for part in range(parts_of(payload))])
    if zlib.crc32(ids.astype("<u4").tobytes()) != int(np.frombuffer(payload, _HEADER, 1)[0]["crc"]):
        raise ValueError("a block does not match its checksum")
    return ids


# ------------------------------------------------------------------ the tokenizer

_ALNUM, _PUNCT = 1, 2
_KIND = np.zeros(256, np.uint8)
_KIND[[*range(48, 58), *range(65, 91), *range(97, 123)]] = _ALNUM
_KIND[[b for b in range(33, 127) if not _KIND[b] and b != 39]] = _PUNCT


def units(raw: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Starts and ends of parts of texts that the tokenizer encodes apart from each other, and the first of each row.

    Its pattern never joins white space to anything, nor an ASCII letter or digit to ASCII punctuation other than the
    apostrophe; neither its normaliser nor its merges reach over such a bound.
    """
    inside, kind = WORD[raw], _KIND[raw]
    opens = inside.copy()
    turn = (kind[1:] != kind[:-1]) & (kind[1:] > 0) & (kind[:-1] > 0)
    opens[1:] &= ~inside[:-1] | turn
    heads = bounds[:-1][bounds[:-1] < bounds[1:]]
    opens[heads] = inside[heads]
    closes = inside.copy()
    if len(raw):
        closes[:-1] &= ~inside[1:] | turn
        tails = bounds[1:][bounds[:-1] < bounds[1:]] - 1
        closes[tails] = inside[tails]
    starts, ends = np.flatnonzero(opens), np.flatnonzero(closes) + 1
    return starts, ends, np.searchsorted(starts, bounds)


class Encoder:
    """Ids of texts by a tokenizer file; the ids of units are remembered in flat arrays.

    A unit is looked up by its hash in two tables of slots, which tell its entry; an entry of another hash, length or
    first byte does not count. What is not found is encoded in one batch. A full memory is emptied.
    """

    REMEMBERED, SLOTS = 1 << 20, 1 << 22

    def __init__(self, path: str):
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.specials = [t.content.encode() for t in self.tokenizer.get_added_tokens_decoder().values()]
        self.small = self.tokenizer.get_vocab_size() <= 1 << 16
        self._empty()

    def _empty(self) -> None:
        self.entries = self.filled = 0
        self.hashes = np.zeros(1024, np.uint64)
        self.marks = np.zeros(1024, np.uint64)
        self.begins = np.zeros(1024, np.int64)
        self.sizes = np.zeros(1024, np.int64)
        self.ids = np.zeros(4096, np.uint32)
        self.slots = np.zeros((2, self.SLOTS), np.int32)

    def whole(self, text: str) -> list[int]:
        return self.tokenizer.encode(text, add_special_tokens=False).ids

    def _slots(self, hashes: np.ndarray) -> list[np.ndarray]:
        mask = np.uint64(self.SLOTS - 1)
        return [(hashes & mask).astype(np.int64), (hashes >> np.uint64(42)).astype(np.int64)]

    def _known(self, hashes: np.ndarray, marks: np.ndarray) -> np.ndarray:
        """The entry of each unit, or -1."""
        out = np.full(len(hashes), -1, np.int64)
        open_ = np.arange(len(hashes))
        for table, slot in zip(self.slots, self._slots(hashes), strict=True):
            entry = table[slot[open_]].astype(np.int64)
            good = (self.hashes[entry] == hashes[open_]) & (self.marks[entry] == marks[open_]) & (entry < self.entries)
            out[open_[good]] = entry[good]
            open_ = open_[~good]
        return out

    def _learn(self, hashes: np.ndarray, marks: np.ndarray, lists: list[list[int]]) -> np.ndarray:
        """New entries with these ids."""
        sizes = np.fromiter(map(len, lists), np.int64, len(lists))
        n, total = len(lists), int(sizes.sum())
        first, end = self.entries, self.entries + n
        for name in ("hashes", "marks", "begins", "sizes"):
            have = getattr(self, name)
            if end > len(have):
                setattr(self, name, np.resize(have, max(end, 2 * len(have))))
        if self.filled + total > len(self.ids):
            self.ids = np.resize(self.ids, max(self.filled + total, 2 * len(self.ids)))
        self.hashes[first:end], self.marks[first:end], self.sizes[first:end] = hashes, marks, sizes
        self.begins[first:end] = self.filled + np.cumsum(sizes) - sizes
        self.ids[self.filled : self.filled + total] = np.fromiter(chain.from_iterable(lists), np.uint32, total)
        self.entries, self.filled = end, self.filled + total
        entry = np.arange(first, end)
        for table, slot in zip(self.slots, self._slots(hashes), strict=True):
            table[slot] = entry
        return entry

    def _entries(self, data: bytes, starts: np.ndarray, ends: np.ndarray, hashes: np.ndarray, marks: np.ndarray) -> np.ndarray:
        found = self._known(hashes, marks)
        missing = np.flatnonzero(found < 0)
        if len(missing):
            # Units of one hash, length and first byte are one unit.
            order = np.lexsort((marks[missing], hashes[missing]))
            by = missing[order]
            new = np.ones(len(by), bool)
            new[1:] = (hashes[by[1:]] != hashes[by[:-1]]) | (marks[by[1:]] != marks[by[:-1]])
            sample = by[new]
            parts = [data[a:b].decode("utf-8") for a, b in zip(starts[sample].tolist(), ends[sample].tolist(), strict=True)]
            encoded = self.tokenizer.encode_batch_fast(parts, add_special_tokens=False)
            entry = self._learn(hashes[sample], marks[sample], [e.ids for e in encoded])
            found[by] = entry[np.cumsum(new) - 1]
        return found

    def rows(self, raw: np.ndarray, bounds: np.ndarray, end_id: int) -> tuple[np.ndarray, np.ndarray]:
        """Flat ids, an end id behind those of each row, and the number of ids of each row."""
        data = raw.tobytes()
        if any(s in data for s in self.specials):
            lists = [[*self.whole(data[a:b].decode("utf-8")), end_id] for a, b in zip(bounds, bounds[1:], strict=False)]
            return np.array([i for x in lists for i in x], np.uint32), np.array([len(x) for x in lists], np.int64)
        starts, ends, first = units(raw, bounds)
        hashes = hashed_words(raw, starts, ends)
        marks = ((ends - starts).astype(np.uint64) << np.uint64(8)) | raw[starts] if len(starts) else np.zeros(0, np.uint64)
        if self.entries > self.REMEMBERED or self.filled > 8 * self.REMEMBERED:
            self._empty()
        which = self._entries(data, starts, ends, hashes, marks)
        each = self.sizes[which]
        done = np.concatenate([[0], np.cumsum(each)])
        tokens = self.ids[np.repeat(self.begins[which] - done[:-1], each) + np.arange(done[-1])]
        counts = np.diff(done[first]) + 1
        out = np.full(len(tokens) + len(counts), end_id, np.uint32)
        is_token = np.ones(len(out), bool)
        is_token[np.cumsum(counts) - 1] = False
        out[is_token] = tokens
        return out, counts


@lru_cache(maxsize=2)
def encoder(path: str) -> Encoder:
    return Encoder(path)


def tokenised(docs: DataFrame, path: str, *, id_col: str = "doc_id", text_col: str = "text", end_id: int = END_ID) -> DataFrame:
    """``shard, before, doc_id, ids``: documents in ascending order over shards and within them.

    ``before`` counts the ids before the document in its shard, which one task reads in order. Rows of one id stand
    in the order of a hash of their text, so that an id with many rows is cut as well; null ids come first.
    """
    chosen = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    order = ["doc_id", "tie"]
    ranged = chosen.withColumn("tie", F.xxhash64("text")).repartitionByRange(*order).sortWithinPartitions(*order)
    kind = chosen.schema["doc_id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words, shard, before = encoder(path), TaskContext.get().partitionId(), 0
        for batch in batches:
            for at, end, raw, bounds in texts(batch.column(1), RUN_BYTES):
                ids, counts = words.rows(raw, bounds, end_id)
                offsets = np.concatenate([[0], np.cumsum(counts)])
                width = 2 if words.small else 4
                stored = ids.astype("<u2") if words.small else ids.astype("<u4")
                lists = pa.Array.from_buffers(pa.binary(), end - at, [None, pa.py_buffer((offsets * width).astype(np.int32)), pa.py_buffer(stored)])
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.full(end - at, shard, np.int32)), pa.array(before + offsets[:-1]), batch.column(0).slice(at, end - at), lists, pa.array(np.full(end - at, width, np.int32))],
                    names=["shard", "before", "doc_id", "ids", "width"],
                )
                before += int(offsets[-1])

    return map_arrow(ranged.select("doc_id", "text"), run, f"shard int, before long, doc_id {kind}, ids binary, width int")


def _unpacked(data: pa.Array, widths: pa.Array) -> list[np.ndarray]:
    return [np.frombuffer(x, "<u2" if w == 2 else "<u4") for x, w in zip(data.to_pylist(), widths.to_pylist(), strict=True)]


def counted(tokens: DataFrame) -> np.ndarray:
    """How often each id occurs in all documents; as long as the vocabulary, whatever the input."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums = np.zeros(0, np.int64)
        for batch in batches:
            for ids in _unpacked(batch.column(0), batch.column(1)):
                part = np.bincount(ids)
                if len(part) > len(sums):
                    sums = np.concatenate([sums, np.zeros(len(part) - len(sums), np.int64)])
                sums[: len(part)] += part
        seen = np.flatnonzero(sums)
        yield pa.RecordBatch.from_arrays([pa.array(seen), pa.array(sums[seen])], names=["id", "n"])

    rows = map_arrow(tokens.select("ids", "width"), run, "id long, n long").groupBy("id").agg(F.sum("n").alias("n")).collect()
    counts = np.zeros(1 + max((r["id"] for r in rows), default=0), np.int64)
    for row in rows:
        counts[row["id"]] = row["n"]
    return counts


def blocks(tokens: DataFrame, frequency: np.ndarray, block_ids: int = BLOCK_IDS) -> DataFrame:
    """``shard, before, doc_ids, lengths, payload``: documents that follow each other in a shard, coded together."""
    kind = tokens.schema["doc_id"].dataType.simpleString()
    shared = tokens.sparkSession.sparkContext.broadcast(frequency)
    schema = f"shard int, before long, doc_ids array<{kind}>, lengths array<long>, payload binary"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = Table.of(shared.value)
        held: list[np.ndarray] = []
        ids_held, where, size = [], None, 0

        def flush() -> pa.RecordBatch:
            payload = encode_block(np.concatenate(held).astype(np.int64), table)
            key = pa.array([x for x in ids_held], doc_type)
            return pa.RecordBatch.from_arrays(
                [
                    pa.array([where[0]], pa.int32()),
                    pa.array([where[1]], pa.int64()),
                    pa.ListArray.from_arrays(pa.array([0, len(key)], pa.int32()), key),
                    pa.array([[len(x) for x in held]], pa.list_(pa.int64())),
                    pa.array([payload], pa.binary()),
                ],
                names=["shard", "before", "doc_ids", "lengths", "payload"],
            )

        for batch in batches:
            doc_type = batch.column(2).type
            shards, befores, keys = (batch.column(i).to_pylist() for i in range(3))
            for shard, before, key, ids in zip(shards, befores, keys, _unpacked(batch.column(3), batch.column(4)), strict=True):
                if held and (size >= block_ids or shard != where[0] or before != where[1] + size):
                    yield flush()
                    held, ids_held, size = [], [], 0
                if not held:
                    where = (shard, before)
                held.append(ids)
                ids_held.append(key)
                size += len(ids)
        if held:
            yield flush()

    return map_arrow(tokens.select("shard", "before", "doc_id", "ids", "width"), run, schema)


def documents(files: DataFrame, frequency: np.ndarray) -> DataFrame:
    """``shard, before, doc_id, n_tokens, ids_crc32`` of every document, from the blocks."""
    kind = files.schema["doc_ids"].dataType.elementType.simpleString()
    shared = files.sparkSession.sparkContext.broadcast(frequency)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = Table.of(shared.value)
        for batch in batches:
            for i in range(len(batch)):
                ids = decode_block(batch.column(4)[i].as_py(), table).astype("<u4")
                lengths = np.array(batch.column(3)[i].as_py(), np.int64)
                ends = np.cumsum(lengths)
                crcs = [zlib.crc32(ids[b - n : b].tobytes()) for b, n in zip(ends, lengths, strict=True)]
                shard, before = batch.column(0)[i].as_py(), batch.column(1)[i].as_py()
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.full(len(ends), shard, np.int32)), pa.array(before + ends - lengths), batch.column(2)[i].values, pa.array(lengths), pa.array(crcs, pa.int64())],
                    names=["shard", "before", "doc_id", "n_tokens", "ids_crc32"],
                )

    return map_arrow(
        files.select("shard", "before", "doc_ids", "lengths", "payload"), run, f"shard int, before long, doc_id {kind}, n_tokens long, ids_crc32 long"
    )


def write(docs: DataFrame, path: str, **columns: str) -> tuple[DataFrame, np.ndarray]:
    """The files as a frame of blocks, and the frequencies that decode them."""
    tokens = staged(tokenised(docs, path, **columns), "tokens")
    frequency = scaled(counted(tokens))
    return staged(blocks(tokens, frequency), "blocks"), frequency


def written_and_read(docs: DataFrame, path: str, **columns: str) -> DataFrame:
    """``doc_id, start, n_tokens, ids_crc32`` per document, from files that were written and read again.

    Cases: a null text is empty, and an empty text has the end id alone; rows that repeat follow each other; an empty
    table gives an empty result. Only the named columns are read, so others may have any name.
    """
    files, frequency = write(docs, path, **columns)
    found = documents(files, frequency)
    ids = F.aggregate("lengths", F.lit(0).cast("long"), lambda a, b: a + b)
    shards = files.groupBy("shard").agg(F.sum(ids).alias("ids"))
    before = W.orderBy("shard").rowsBetween(W.unboundedPreceding, -1)
    starts = shards.select(F.col("shard").alias("of_shard"), F.coalesce(F.sum("ids").over(before), F.lit(0)).alias("first"))
    joined = found.join(starts, F.col("shard") == F.col("of_shard"))
    return joined.select("doc_id", (F.col("first") + F.col("before")).alias("start"), "n_tokens", "ids_crc32")
