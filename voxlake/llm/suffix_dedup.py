"""Repeated byte strings by a difference cover: sampled suffixes, names of their triples, a merge of what is left.

A string of ``length`` bytes is a repeat if it also starts earlier (smaller document id, or the same document and an
earlier place). Suffixes need an order only to that depth, and only where something repeats, so the difference-cover
sort is bounded in depth and discards what is unique:

1. *Sample.* Places of a document whose residue modulo ``period`` lies in a perfect difference cover. Any two places
   have, within one period, a common distance at which both are sampled; so two equal strings of ``length`` bytes hold,
   at that distance, equal strings of ``length - period + 1`` bytes at two sampled places. These are sorted; neighbours
   that are equal get one name, which is the first place of the string. Names that occur once are discarded.
2. *Names of names.* Along one residue, names follow each other a period apart, and their strings overlap. Where the
   names at ``p``, ``p + period``, ``p + 2 period``, ... are first places in the same steps, the long string is a repeat
   of the string at the first of these places: all its windows are repeats. A window near no sampled place with an
   earlier first place cannot be a repeat.
3. *Merge.* Windows that neither rule decides (near the ends of repeats), and those that a later one may repeat (near
   first places), are sorted by their own ``length`` bytes. In that order neighbours are compared; all but the first of
   equal ones are repeats.

Sorting is by hashes of the strings (equality is all that is asked). Where a collision could only cost time, one entry in
thousands may have one; where it decides, as many bytes are kept as make the chance of any in the whole corpus less than
one in four thousand, were every window of it compared.

The corpus is packed once, in document order, into compressed chunks of about ``CHUNK`` bytes, so that a place is a
chunk and an offset. Samples are dealt to buckets of bounded size by hash; a document sends each string once, however
often it holds it, and a chunk each window once. So neither a passage that a third of all documents share nor a text of
one repeated letter makes a large group. Nothing but counts reaches the driver.

Cases: a null text is empty; texts shorter than ``length`` bytes are kept whole; rows that share id and text are one
document and each get its result; different texts under one id follow each other by the hash of the text; a null id is
smaller than all others; an empty table gives an empty one. Ids are whole numbers. A document is held in one task, with
some 40 bytes of memory for each of its bytes.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from voxlake.llm.common import hashed_words, map_arrow, mix64, staged, with_library

LENGTH = 100
#: Bytes of a chunk (whole documents; a longer document is a chunk of its own) and entries of a bucket, on average.
CHUNK = 2 << 20
BUCKET = 1 << 20
#: Perfect difference covers, by period. Every distance occurs between two of their residues.
COVERS = {
    3: (0, 1),
    7: (0, 1, 3),
    13: (0, 1, 3, 9),
    21: (0, 1, 4, 14, 16),
    31: (0, 1, 3, 8, 12, 18),
    57: (0, 1, 3, 13, 32, 36, 43, 52),
    73: (0, 1, 3, 7, 15, 31, 36, 54, 63),
}
#: Bytes that are hashed at once.
PIECE = 1 << 20


def period_of(length: int) -> int:
    """The largest known period of which two fit in the length, so that strings along one residue overlap."""
    fitting = [p for p in COVERS if 2 * p <= length + 1]
    if not fitting:
        raise ValueError(f"strings of at least {2 * min(COVERS) - 1} bytes, not {length}")
    return max(fitting)


def _packed(values: np.ndarray, width: int) -> bytes:
    """The lowest ``width`` bytes of numbers, laid out as planes of bytes and compressed."""
    planes = values.astype("<u8").view(np.uint8).reshape(-1, 8)[:, :width].T.tobytes()
    return np.array([len(values), width], "<u4").tobytes() + pa.compress(planes, codec="zstd", asbytes=True)


def _unpacked(data: bytes) -> np.ndarray:
    n, width = np.frombuffer(data, "<u4", 2).tolist()
    found = np.zeros((n, 8), np.uint8)
    if n and width:
        found[:, :width] = np.frombuffer(pa.decompress(data[8:], n * width, codec="zstd"), np.uint8).reshape(width, n).T
    return found.view("<u8")[:, 0].astype(np.uint64)


def _all(packs: list[bytes]) -> np.ndarray:
    return np.concatenate([np.zeros(0, np.uint64), *map(_unpacked, packs)])


def _width(largest: int) -> int:
    return max(1, -(-int(largest).bit_length() // 8))


def _in_order(names: np.ndarray, bits: int) -> tuple[np.ndarray, np.ndarray]:
    """Sorted names and where each was; equal names stay in their order."""
    room = max(1, int(len(names)).bit_length())
    if bits + room <= 64:
        keys = np.sort(names << np.uint64(room) | np.arange(len(names), dtype=np.uint64))
        return keys >> np.uint64(room), (keys & np.uint64((1 << room) - 1)).astype(np.int64)
    order = np.argsort(names, kind="stable")
    return names[order], order


def _hashed(raw: np.ndarray, starts: np.ndarray, width: int) -> np.ndarray:
    """Hashes of the strings of ``width`` bytes at ascending places."""
    out = np.empty(len(starts), np.uint64)
    for low in range(0, len(raw), PIECE):
        a, b = np.searchsorted(starts, [low, low + PIECE])
        if a < b:
            own = starts[a:b] - low
            out[a:b] = hashed_words(raw[low : low + PIECE + width], own, own + width)
    return out


def _windows(raw: np.ndarray, starts: np.ndarray, length: int) -> tuple[np.ndarray, np.ndarray]:
    """Two hashes of each window: one of the whole, one of the pair of its halves."""
    half = length // 2
    first, second = _hashed(raw, starts, half), _hashed(raw, starts + half, length - half)
    return _hashed(raw, starts, length), mix64(mix64(first + np.uint64(0x5851F42D4C957F2D)) + second * np.uint64(0xD6E8FEB86659FD93))


def _by_string(high: np.ndarray, low: np.ndarray) -> np.ndarray:
    """Order by both hashes; equal ones stay in their order."""
    order = np.argsort(high, kind="stable")
    h, lo = high[order], low[order]
    clash = (h[1:] == h[:-1]) & (lo[1:] != lo[:-1])
    return np.lexsort((low, high)) if clash.any() else order


class Chunk:
    """Documents laid end to end, and the sampled places in them."""

    def __init__(self, number: int, bounds, body: bytes, length: int):
        self.number, self.length = number, length
        self.bounds = np.asarray(bounds, np.int64)
        size = int(self.bounds[-1])
        self.raw = np.frombuffer(pa.decompress(body, size, codec="zstd", asbytes=True), np.uint8) if size else np.zeros(0, np.uint8)
        self.period = period_of(length)
        self.width = length - self.period + 1

    def sample(self) -> tuple[np.ndarray, np.ndarray]:
        """Sampled places, ascending, and the document of each; only of documents that hold a window."""
        sizes = np.diff(self.bounds)
        most = int(sizes.max()) if len(sizes) else 0
        residues = np.array(COVERS[self.period])
        offsets = (np.arange(0, most + 1, self.period)[:, None] + residues[None, :]).reshape(-1)
        counts = np.where(sizes >= self.length, np.searchsorted(offsets, sizes - self.width, "right"), 0)
        docs = np.repeat(np.arange(len(sizes)), counts)
        heads = np.cumsum(counts) - counts
        places = offsets[np.arange(len(docs)) - heads[docs]] + self.bounds[docs]
        return places, docs

    def names(self, places: np.ndarray, docs: np.ndarray, name_bytes: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Names in order, the sample of each, and for each the entry where its document has the name first."""
        bits = 8 * name_bytes
        names, at = _in_order(_hashed(self.raw, places, self.width) >> np.uint64(64 - bits), bits)
        fresh = np.ones(len(names), bool)
        fresh[1:] = (names[1:] != names[:-1]) | (docs[at[1:]] != docs[at[:-1]])
        return names, at, np.maximum.accumulate(np.where(fresh, np.arange(len(names)), 0))


def _ranges(size: int, low: np.ndarray, high: np.ndarray) -> np.ndarray:
    """True where a half-open range covers the place; ranges with ``low >= high`` cover none."""
    marks = np.zeros(size + 1, np.int32)
    able = low < high
    np.add.at(marks, low[able], 1)
    np.add.at(marks, high[able], -1)
    return np.cumsum(marks[:-1]) > 0


def _runs(inside: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    edges = np.flatnonzero(np.diff(np.concatenate([[0], inside.view(np.int8), [0]])))
    return edges[::2], edges[1::2]


def _dealt(names: np.ndarray, bits: int, buckets: int) -> list[tuple[int, int, int]]:
    """Buckets of sorted names: bucket, first and end entry. Buckets are ranges of the names' top 32 bits."""
    top = names >> np.uint64(bits - 32) if bits > 32 else names << np.uint64(32 - bits)
    bucket = (top * np.uint64(buckets)) >> np.uint64(32)
    cuts = np.flatnonzero(np.diff(bucket.astype(np.int64))) + 1
    lows, highs = np.concatenate([[0], cuts]), np.concatenate([cuts, [len(names)]])
    return [(int(bucket[a]), int(a), int(b)) for a, b in zip(lows, highs, strict=True)] if len(names) else []


def packed(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """``chunk, ids, copies, bounds, size, body``: the distinct documents in order, laid into chunks."""
    if docs.schema[id_col].dataType.typeName() not in ("byte", "short", "integer", "long"):
        raise ValueError(f"{id_col} is not a column of whole numbers")
    rows = docs.select(F.col(id_col).cast("long").alias("id"), F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("body"))
    rows = rows.withColumn("tie", F.xxhash64("body"))
    if rows.groupBy("id", "tie").count().where("count > 1").isEmpty():
        rows = rows.select("id", "tie", F.lit(1).cast("long").alias("copies"), F.col("body").cast("binary").alias("body"))
    else:
        rows = rows.groupBy("id", "tie").agg(F.count(F.lit(1)).alias("copies"), F.first(F.col("body").cast("binary")).alias("body"))
    order = [F.asc_nulls_first("id"), F.asc("tie")]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        base, seq = TaskContext.get().partitionId() << 32, 0
        ids, copies, bodies, held = [], [], [], 0

        def chunk() -> pa.RecordBatch:
            bounds = np.concatenate([[0], np.cumsum([len(b) for b in bodies])]).astype(np.int64)
            body = pa.Codec("zstd", compression_level=5).compress(b"".join(bodies), asbytes=True)
            columns = [[base + seq], [ids], [copies], [bounds], [int(bounds[-1])], [body]]
            kinds = [pa.int64(), *[pa.list_(pa.int64())] * 3, pa.int64(), pa.binary()]
            return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], names=["chunk", "ids", "copies", "bounds", "size", "body"])

        for batch in batches:
            for number, many, body in zip(batch.column(0).to_pylist(), batch.column(2).to_pylist(), batch.column(3), strict=True):
                text = body.as_py()
                if bodies and held + len(text) > CHUNK:
                    yield chunk()
                    ids, copies, bodies, held, seq = [], [], [], 0, seq + 1
                ids.append(number)
                copies.append(many)
                bodies.append(text)
                held += len(text)
        if bodies:
            yield chunk()

    schema = "chunk long, ids array<long>, copies array<long>, bounds array<long>, size long, body binary"
    return staged(map_arrow(rows.repartitionByRange(*order).sortWithinPartitions(*order), run, schema), "chunks")


def _sampled(chunks: DataFrame, length: int, name_bytes: int, buckets: int) -> DataFrame:
    """``bucket, chunk, names, places``: what each document holds at its sampled places, once, in order of the names."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in range(batch.num_rows):
                chunk = Chunk(batch.column(0)[row].as_py(), batch.column(1)[row].values.to_numpy(), batch.column(2)[row].as_py(), length)
                places, docs = chunk.sample()
                names, at, first = chunk.names(places, docs, name_bytes)
                own = first == np.arange(len(first))
                names, places, width = names[own], places[at[own]].astype(np.uint64), _width(len(chunk.raw))
                out = [(b, chunk.number, _packed(names[i:j], name_bytes), _packed(places[i:j], width)) for b, i, j in _dealt(names, 8 * name_bytes, buckets)]
                columns = list(zip(*out, strict=True)) or [[], [], [], []]
                kinds = [pa.int32(), pa.int64(), pa.binary(), pa.binary()]
                yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], names=["bucket", "chunk", "names", "places"])

    return map_arrow(chunks.select("chunk", "bounds", "body"), run, "bucket int, chunk long, names binary, places binary")


def _entries(table: pa.Table, *columns: str) -> tuple[np.ndarray, np.ndarray, list[np.ndarray]]:
    """All entries of a bucket in order of chunk: chunks of the rows, row of each entry, and the packed columns."""
    order = np.argsort(table.column("chunk").to_numpy(), kind="stable")
    found = [[packs[i] for i in order] for packs in (table.column(c).to_pylist() for c in columns)]
    sizes = [int(np.frombuffer(pack, "<u4", 1)[0]) for pack in found[0]]
    return table.column("chunk").to_numpy()[order], np.repeat(np.arange(len(order)), sizes), [_all(packs) for packs in found]


def _named(sampled: DataFrame, name_bytes: int) -> DataFrame:
    """``chunk, places, head_chunks, steps``: names that more than one document holds, and where each is first.

    ``steps`` lead from a place to that of its head, in another chunk or in this one; they are alike along a repeat.
    """

    def run(table: pa.Table) -> pa.Table:
        chunks, row, (names, places) = _entries(table, "names", "places")
        names, at = _in_order(names, 8 * name_bytes)
        fresh = np.ones(len(names), bool)
        fresh[1:] = names[1:] != names[:-1]
        shared = ~fresh
        shared[:-1] |= ~fresh[1:]
        head = at[np.maximum.accumulate(np.where(fresh, np.arange(len(names)), 0))][shared]
        mine = at[shared]
        order = np.argsort(mine, kind="stable")
        mine, head = mine[order], head[order]
        cuts = np.searchsorted(row[mine], np.arange(len(chunks) + 1))
        out = []
        for n, (a, b) in enumerate(zip(cuts[:-1], cuts[1:], strict=True)):
            if a < b:
                own = np.argsort(places[mine[a:b]], kind="stable") + a
                data = (places[mine[own]], chunks[row[head[own]]].astype(np.uint64), places[head[own]] - places[mine[own]])
                out.append((int(chunks[n]), *(_packed(d, 8) for d in data)))
        columns = list(zip(*out, strict=True)) or [[], [], [], []]
        kinds = [pa.int64(), *[pa.binary()] * 3]
        return pa.table([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], names=["chunk", "places", "head_chunks", "steps"])

    return with_library(sampled).groupBy("bucket").applyInArrow(run, "chunk long, places binary, head_chunks binary, steps binary")


def _chunk_of(table: pa.Table, length: int) -> Chunk:
    return Chunk(table.column("chunk")[0].as_py(), table.column("bounds")[0].values.to_numpy(), table.column("body")[0].as_py(), length)


def decide(chunk: Chunk, heads: dict[str, np.ndarray], name_bytes: int) -> tuple[np.ndarray, np.ndarray]:
    """For each place of the chunk: the window there is a repeat for certain; it must be merged to tell."""
    size = len(chunk.raw)
    places, docs = chunk.sample()
    _, at, first = chunk.names(places, docs, name_bytes)
    head_chunk, head_place = np.full(len(places), -1, np.int64), np.zeros(len(places), np.int64)
    known = np.searchsorted(places, heads["places"])
    head_chunk[known], head_place[known] = heads["head_chunks"], heads["places"] + heads["steps"]
    # Further places of a name in one document have the head of its first place, which is that place if no other is.
    again = np.flatnonzero(first != np.arange(len(first)))
    own = at[first[again]]
    alone = own[head_chunk[own] < 0]
    head_chunk[alone], head_place[alone] = chunk.number, places[alone]
    head_chunk[at[again]], head_place[at[again]] = head_chunk[own], head_place[own]
    named = head_chunk >= 0
    later = named & ~((head_chunk == chunk.number) & (head_place == places))
    # Names of names: the next sample of a residue is as many samples on as the cover has residues.
    per = len(COVERS[chunk.period])
    linked = np.zeros(len(places), bool)
    if len(places) > per:
        linked[:-per] = (
            later[:-per] & later[per:] & (docs[:-per] == docs[per:]) & (head_chunk[:-per] == head_chunk[per:])
            & (head_place[per:] - head_place[:-per] == chunk.period)
        )
    chain = _chain_ends(linked, per)
    last_window = places[chain] + chunk.width - chunk.length
    sure = _ranges(size, places[linked], last_window[linked] + 1)
    ends_of_docs = chunk.bounds[1:][docs] - chunk.length + 1
    starts_of_docs = chunk.bounds[:-1][docs]
    near = _ranges(size, np.maximum(places[named] - chunk.period + 1, starts_of_docs[named]), np.minimum(places[named] + 1, ends_of_docs[named]))
    return sure, near & ~sure


def _chain_ends(linked: np.ndarray, step: int) -> np.ndarray:
    """The last sample of the chain of links that each sample is in, links leading ``step`` samples on."""
    n = len(linked)
    rows = -(-n // step) if n else 0
    grid = np.zeros(rows * step, bool)
    grid[:n] = linked
    index = np.arange(rows * step).reshape(rows, step)
    # From the end: a sample without a link ends its own chain, one with a link has the end of the next.
    ends = np.where(grid.reshape(rows, step), rows * step, index)
    ends = np.minimum.accumulate(ends[::-1], axis=0)[::-1]
    return ends.reshape(-1)[:n]


def _undecided(chunks: DataFrame, named: DataFrame, length: int, name_bytes: int, window_bytes: int, buckets: int) -> DataFrame:
    """``bucket, chunk, high, low, places, gone``: windows to merge by bucket, and the windows known to go (``gone``)."""

    def run(text: pa.Table, heads: pa.Table) -> pa.Table:
        out: list[tuple] = []
        if len(text):
            chunk = _chunk_of(text, length)
            found = {c: _all(heads.column(c).to_pylist()).view(np.int64) for c in heads.column_names[1:]}
            sure, open_ = decide(chunk, found, name_bytes)
            starts = np.flatnonzero(open_)
            high, low = _windows(chunk.raw, starts, length)
            order = _by_string(high, low)
            high, low, starts = high[order], low[order], starts[order]
            fresh = np.ones(len(starts), bool)
            fresh[1:] = (high[1:] != high[:-1]) | (low[1:] != low[:-1])
            sure[starts[~fresh]] = True
            high, low, starts = high[fresh], low[fresh], starts[fresh].astype(np.uint64)
            width = _width(len(chunk.raw))
            for bucket, a, b in _dealt(high, 64, buckets):
                packs = (_packed(high[a:b], 8), _packed(low[a:b], window_bytes - 8), _packed(starts[a:b], width))
                out.append((bucket, chunk.number, *packs, None))
            runs = np.stack(_runs(sure))
            if runs.shape[1]:
                out.append((chunk.number % buckets, chunk.number, None, None, None, _packed(runs.reshape(-1).astype(np.uint64), _width(len(chunk.raw)))))
        columns = list(zip(*out, strict=True)) or [[], [], [], [], [], []]
        kinds = [pa.int32(), pa.int64(), *[pa.binary()] * 4]
        return pa.table([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], names=["bucket", "chunk", "high", "low", "places", "gone"])

    return with_library(chunks).groupBy("chunk").cogroup(named.groupBy("chunk")).applyInArrow(run, "bucket int, chunk long, high binary, low binary, places binary, gone binary")


def _merged(undecided: DataFrame) -> DataFrame:
    """``chunk, places, gone``: windows whose string is at an earlier place, and what was known before."""

    def run(table: pa.Table) -> pa.Table:
        known = table.filter(pc.is_valid(table.column("gone")))
        asked = table.filter(pc.is_null(table.column("gone")))
        out = [(c, None, g) for c, g in zip(known.column("chunk").to_pylist(), known.column("gone").to_pylist(), strict=True)]
        if len(asked):
            chunks, row, (high, low, places) = _entries(asked, "high", "low", "places")
            order = _by_string(high, low)
            high, low = high[order], low[order]
            repeat = np.zeros(len(order), bool)
            repeat[1:] = (high[1:] == high[:-1]) & (low[1:] == low[:-1])
            gone = np.sort(order[repeat])
            cuts = np.searchsorted(row[gone], np.arange(len(chunks) + 1))
            out += [(int(chunks[n]), _packed(places[gone[a:b]], 8), None) for n, (a, b) in enumerate(zip(cuts[:-1], cuts[1:], strict=True)) if a < b]
        columns = list(zip(*out, strict=True)) or [[], [], []]
        kinds = [pa.int64(), pa.binary(), pa.binary()]
        return pa.table([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], names=["chunk", "places", "gone"])

    return undecided.groupBy("bucket").applyInArrow(run, "chunk long, places binary, gone binary")


def _kept(chunks: DataFrame, gone: DataFrame, length: int) -> DataFrame:
    """``id, copies, n_bytes, spans, kept`` of every document."""
    span = pa.struct([("start", pa.int64()), ("end", pa.int64())])

    def run(text: pa.Table, known: pa.Table) -> pa.Table:
        names = ["id", "copies", "n_bytes", "spans", "kept"]
        kinds = [pa.int64(), pa.int64(), pa.int64(), pa.list_(span), pa.large_binary()]
        if not len(text):
            return pa.table([pa.array([], k) for k in kinds], names=names)
        chunk = _chunk_of(text, length)
        runs = [_unpacked(g).astype(np.int64).reshape(2, -1) for g in known.column("gone").to_pylist() if g]
        singles = [_unpacked(p).astype(np.int64) for p in known.column("places").to_pylist() if p]
        low = np.concatenate([r[0] for r in runs] + singles + [np.zeros(0, np.int64)])
        high = np.concatenate([r[1] + length - 1 for r in runs] + [s + length for s in singles] + [np.zeros(0, np.int64)])
        covered = _ranges(len(chunk.raw), low, high)
        # Runs of covered bytes, cut where documents meet.
        edge = np.zeros(len(chunk.raw) + 1, bool)
        edge[chunk.bounds] = True
        steps = np.diff(np.concatenate([[False], covered, [False]]).view(np.int8))
        both = np.concatenate([[False], covered]) & np.concatenate([covered, [False]]) & edge
        starts, ends = np.flatnonzero((steps == 1) | both), np.flatnonzero((steps == -1) | both)
        doc = np.searchsorted(chunk.bounds, starts, "right") - 1
        offsets = np.searchsorted(doc, np.arange(len(chunk.bounds)))
        shift = chunk.bounds[doc]
        spans = pa.StructArray.from_arrays([pa.array(starts - shift), pa.array(ends - shift)], fields=list(span))
        kept_before = np.concatenate([[0], np.cumsum(~covered)]).astype(np.int64)
        kept = pa.LargeBinaryArray.from_buffers(
            pa.large_binary(), len(chunk.bounds) - 1, [None, pa.py_buffer(kept_before[chunk.bounds].tobytes()), pa.py_buffer(chunk.raw[~covered].tobytes())]
        )
        lists = pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), spans)
        sizes = pa.array(np.diff(chunk.bounds))
        return pa.table([text.column("ids")[0].values, text.column("copies")[0].values, sizes, lists, kept.cast(pa.binary())], names=names)

    schema = "id long, copies long, n_bytes long, spans array<struct<start:long,end:long>>, kept binary"
    return with_library(chunks).groupBy("chunk").cogroup(gone.groupBy("chunk")).applyInArrow(run, schema)


def without_repeats(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", length: int = LENGTH) -> DataFrame:
    """``<id>, n_bytes, spans, kept``: for each row its bytes without those that a repeat covers; spans are byte ranges."""
    chunks = packed(docs, id_col, text_col)
    total = chunks.agg(F.sum("size")).first()[0] or 0
    period = period_of(length)
    samples = total * len(COVERS[period]) // period
    # Bits of a name: log2 of the entries, and twelve more. Of a window: twice log2 of all windows, and twelve.
    name_bytes = min(8, max(4, -(-(samples.bit_length() + 12) // 8)))
    window_bytes = min(16, max(9, -(-(2 * total.bit_length() + 12) // 8)))
    buckets = max(1, -(-samples // BUCKET))
    named = staged(_named(_sampled(chunks, length, name_bytes, buckets), name_bytes), "names")
    undecided = _undecided(chunks, named, length, name_bytes, window_bytes, buckets)
    found = _kept(chunks, _merged(undecided), length)
    # Rows of one id and text: each number of a page of copies, so that no array is long.
    page = 1 << 16
    pages = found.withColumn("page", F.explode(F.sequence(F.lit(0).cast("long"), F.floor((F.col("copies") - 1) / page))))
    rows = pages.withColumn("copy", F.explode(F.sequence(F.lit(1).cast("long"), F.least(F.lit(page).cast("long"), F.col("copies") - F.col("page") * page))))
    return rows.select(F.col("id").alias(id_col), "n_bytes", "spans", "kept")
