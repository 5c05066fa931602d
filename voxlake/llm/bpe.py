"""Byte-level BPE by prefix dynamic programming.

For byte-pair merging by ranks, the encoding of a piece ends, for every prefix of its bytes, in exactly one token that
fits: removing it leaves a prefix whose own last token stays a neighbour of it when both are merged from bytes. So one
array with the last token of each prefix holds the encodings of all prefixes at once. Bytes are appended by filling
further entries; an edit keeps all entries before it. Whether two tokens stay neighbours depends on the two alone.

A text is first cut into pieces by a pattern; pieces are encoded one by one, as the public tokenizer libraries do.
"""

from __future__ import annotations

import base64
import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from voxlake.llm.common import map_arrow

VOCABULARY = "byte_bpe_50k.tiktoken"
#: Pieces that a worker remembers; the two generations together hold twice as many.
REMEMBERED = 250_000
_NEVER = 1 << 60


def load_ranks(path: str) -> dict[bytes, int]:
    with open(path, "rb") as lines:
        return {base64.b64decode(token): int(rank) for token, rank in (line.split() for line in lines if line.strip())}


class Vocabulary:
    """Ranks of tokens, how each token is merged, and which tokens stay neighbours."""

    def __init__(self, ranks: dict[bytes, int]):
        self.ranks = ranks
        self.longest = max(map(len, ranks))
        self.of_id = {i: token for token, i in ranks.items()}
        self._spines: dict[tuple[int, int], list[tuple[bytes, int, int]]] = {}
        self._stay: dict[int, bool] = {}
        #: The tokens that merging makes; others are found only as whole pieces, which the libraries look up first.
        self.tokens = {t: i for t, i in ranks.items() if len(t) == 1 or len(self.merged(t, i)) == 2}
        self._recent: dict[str, tuple[int, ...]] = {}
        self._older: dict[str, tuple[int, ...]] = {}

    def merged(self, piece: bytes, below: int = _NEVER) -> list[bytes]:
        """Plain merging by ranks under ``below``: lowest rank first, leftmost first."""
        parts = [piece[i : i + 1] for i in range(len(piece))]
        while len(parts) > 1:
            rank, at = min((self.ranks.get(a + b, _NEVER), i) for i, (a, b) in enumerate(zip(parts, parts[1:], strict=False)))
            if rank >= below:
                break
            parts[at : at + 2] = [parts[at] + parts[at + 1]]
        return parts

    def _spine(self, token: int, side: int) -> list[tuple[bytes, int, int]]:
        """The parts at one edge of a token (side 0: left, 1: right) while it is merged: bytes, rank when made, rank when used up."""
        found = self._spines.get((token, side))
        if found is None:
            found, part, used = [], self.of_id[token], _NEVER
            while True:
                made = self.ranks[part] if len(part) > 1 else -1
                found.append((part, made, used))
                halves = self.merged(part, made) if made >= 0 else ()
                if len(halves) != 2:  # a single byte, or a token that merging never makes
                    break
                part, used = halves[-side], made
            self._spines[token, side] = found
        return found

    def stay(self, left: int, right: int) -> bool:
        """Whether merging the bytes of both gives the two again.

        It does not when a part at the right edge of the first and one at the left edge of the second exist together
        and merge before either is used up. At equal rank the leftmost merge goes first: the one inside ``left``
        before that across, and that across before the one inside ``right``.
        """
        key = left << 32 | right
        known = self._stay.get(key)
        if known is None:
            known = True
            for a, a_made, a_used in self._spine(left, 1):
                for b, b_made, b_used in self._spine(right, 0):
                    if max(a_made, b_made) < min(a_used, b_used):
                        rank = self.ranks.get(a + b, _NEVER)
                        if rank < a_used and rank <= b_used and rank < _NEVER:
                            known = False
            if len(self._stay) > 2_000_000:
                self._stay.clear()
            self._stay[key] = known
        return known

    def extend(self, piece: bytes, last: list[int]) -> list[int]:
        """Fill the last token of each prefix of ``piece`` behind those in ``last`` (entry ``i``: of the first ``i + 1`` bytes)."""
        tokens, known, longest = self.tokens, self._stay, self.longest
        for end in range(len(last) + 1, len(piece) + 1):
            for start in range(end - longest if end > longest else 0, end):
                token = tokens.get(piece[start:end])
                if token is None:
                    continue
                if start:
                    fits = known.get(last[start - 1] << 32 | token)
                    if not (self.stay(last[start - 1], token) if fits is None else fits):
                        continue
                last.append(token)
                break
            else:
                raise ValueError(f"byte {piece[end - 1]} has no token")
        return last

    def unwind(self, last: list[int]) -> tuple[int, ...]:
        found, end = [], len(last)
        while end:
            found.append(last[end - 1])
            end -= len(self.of_id[last[end - 1]])
        return tuple(reversed(found))

    def piece(self, text: str) -> tuple[int, ...]:
        """The ids of one piece, remembered in two generations."""
        ids = self._recent.get(text)
        if ids is None:
            ids = self._older.get(text)
            if ids is None:
                raw = text.encode("utf-8")
                whole = self.ranks.get(raw)
                ids = (whole,) if whole is not None else self.unwind(self.extend(raw, []))
            if len(text) <= 64:
                if len(self._recent) >= REMEMBERED:
                    self._older, self._recent = self._recent, {}
                self._recent[text] = ids
        return ids

    def decode(self, ids) -> bytes:
        return b"".join(map(self.of_id.__getitem__, ids))


class Piece:
    """A piece that grows and is edited; only the prefixes behind an edit are computed again."""

    def __init__(self, vocabulary: Vocabulary, raw: bytes = b""):
        self.vocabulary, self.raw, self.last = vocabulary, b"", []
        self.append(raw)

    def append(self, raw: bytes) -> Piece:
        self.raw += raw
        self.vocabulary.extend(self.raw, self.last)
        return self

    def splice(self, start: int, end: int, raw: bytes) -> Piece:
        """Replace bytes. Behind the edit, once as many entries as the longest token equal the old ones, the rest is kept."""
        old, tail, shift = self.last, self.raw[end:], start + len(raw) - end
        self.raw = self.raw[:start] + raw + tail
        self.last = old[:start]
        settled, edited = 0, start + len(raw)
        while len(self.last) < len(self.raw):
            at = len(self.last)
            self.vocabulary.extend(self.raw[: at + 1], self.last)
            behind = at >= edited and old[at - shift] == self.last[at]
            settled = settled + 1 if behind else 0
            if settled >= self.vocabulary.longest:
                self.last += old[at + 1 - shift :]
                break
        return self

    def ids(self, prefix: int | None = None) -> tuple[int, ...]:
        """The encoding of the piece or of its first bytes."""
        whole = self.vocabulary.ranks.get(self.raw[:prefix])
        return (whole,) if whole is not None else self.vocabulary.unwind(self.last[:prefix])


class Text:
    """A text with the pieces and ids of all its parts, for appends and edits.

    The pattern may look ahead, so an edit reaches at most the pieces that end where it starts; pieces are cut again
    from there until one starts where an old one starts behind the edit.
    """

    def __init__(self, vocabulary: Vocabulary, pattern: str, text: str = ""):
        self.vocabulary, self.pattern, self.text = vocabulary, regex.compile(pattern), ""
        self.starts, self.parts = [], []
        self.splice(0, 0, text)

    def append(self, text: str) -> Text:
        return self.splice(len(self.text), len(self.text), text)

    def splice(self, start: int, end: int, text: str) -> Text:
        keep = int(np.searchsorted(self.starts, start, "left"))
        keep = max(0, keep - 2)
        shift = start + len(text) - end
        old = {at + shift: i for i, at in enumerate(self.starts) if at >= end}
        self.text = self.text[:start] + text + self.text[end:]
        starts, parts = self.starts[:keep], self.parts[:keep]
        for found in self.pattern.finditer(self.text, self.starts[keep] if keep < len(self.starts) else 0):
            if found.start() > start + len(text) and found.start() in old:
                i = old[found.start()]
                starts += [at + shift for at in self.starts[i:]]
                parts += self.parts[i:]
                break
            starts.append(found.start())
            parts.append(self.vocabulary.piece(found.group()))
        self.starts, self.parts = starts, parts
        return self

    def ids(self) -> list[int]:
        return [i for part in self.parts for i in part]


_LOADED: dict[str, Vocabulary] = {}


def vocabulary(path: str) -> Vocabulary:
    """The vocabulary of a file, once per worker process."""
    if path not in _LOADED:
        _LOADED[path] = Vocabulary(load_ranks(path))
    return _LOADED[path]


def encode(
    docs: DataFrame,
    path: str,
    pattern: str,
    *,
    id_col: str = "doc_id",
    text_col: str = "text",
    with_ids: bool = True,
) -> DataFrame:
    """``doc_id, n_tokens, ids_sha256, decoded_sha256, n_bytes`` and, if wanted, ``ids``, for every row.

    Cases: a null text is empty, and an empty text has no ids; rows that repeat are encoded each; code points that are
    not valid on their own cannot occur in a text column; an empty table gives an empty one. Only the two named columns
    are read, so others may have any name. ``path`` must be there on every executor, as an installed file is.
    """
    chosen = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    kind = chosen.schema["doc_id"].dataType.simpleString()
    schema = f"doc_id {kind}, n_tokens long, ids_sha256 string, decoded_sha256 string, n_bytes long"
    schema += ", ids array<int>" if with_ids else ""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words = vocabulary(path)
        pieces, piece, recent = regex.compile(pattern).findall, words.piece, words._recent
        for batch in batches:
            n, ids_hash, decoded_hash, lengths, lists = [], [], [], [], []
            for text in batch.column(1).to_pylist():
                ids: list[int] = []
                recent = words._recent
                for part in pieces(text or ""):
                    ids += recent.get(part) or piece(part)
                flat = np.array(ids, "<u4")
                decoded = words.decode(ids)
                n.append(len(ids))
                ids_hash.append(hashlib.sha256(flat.tobytes()).hexdigest())
                decoded_hash.append(hashlib.sha256(decoded).hexdigest())
                lengths.append(len(decoded))
                if with_ids:
                    lists.append(flat.astype(np.int32))
            columns = [batch.column(0), pa.array(n, pa.int64()), pa.array(ids_hash, pa.string()), pa.array(decoded_hash, pa.string()), pa.array(lengths, pa.int64())]
            names = ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256", "n_bytes"]
            if with_ids:
                columns.append(pa.array(lists, pa.list_(pa.int32())))
                names.append("ids")
            yield pa.RecordBatch.from_arrays(columns, names=names)

    return map_arrow(chosen, run, schema)
