"""SimHash fingerprints of documents, from DataFrame functions alone.

The terms of a text are its shingles of five words (a shorter text is one shingle), each weighted by how often it
occurs. Every term votes with its weight for each of the 64 bits of its hash, for 1 or for 0; a bit of the fingerprint
is 1 where the votes for 1 are more. Likeness is the share of equal bits.

Votes are counted several bits at a time: a shifted hash under a mask with every 32nd bit has two bits in the lanes of
one long, so 32 plain sums hold the votes of all 64 bits and each lane has room for 2^32 terms. They are aggregated
by row, in the tasks that read the texts before anything is moved.
"""

from __future__ import annotations

from functools import reduce
from itertools import combinations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from voxlake.llm.common import staged

BITS = 64
SHINGLE = 5
RADIUS = 3
BLOCKS = 6
_LANES = 0x0000000100000001
_SPACE = "[ \\t\\n\\x0B\\f\\r]+"


def shingles(text: Column) -> Column:
    """An array with every shingle as a struct of its words; the one of an empty text has an empty word."""
    words = F.split(F.btrim(text, F.lit(" \t\n\x0b\f\r")), _SPACE, -1)
    n = F.size(words)
    later = [F.slice(words, i + 1, n) for i in range(1, SHINGLE)]
    zipped = F.arrays_zip(*[w.alias(f"w{i}") for i, w in enumerate([words, *later])])
    return F.slice(zipped, 1, F.greatest(n - SHINGLE + 1, F.lit(1)))


def fingerprints(rows: DataFrame, keys: list[str], text_col: str) -> DataFrame:
    """``keys, rows, fingerprint``: one row per distinct key with the number of its rows, whose texts must be equal.

    A text without words has the fingerprint 0. Only when ``rows`` are not yet partitioned by some of the keys are sums
    moved, one row of them per key and task.
    """
    terms = rows.select(*keys, F.posexplode(shingles(F.col(text_col))).alias("at", "s"))
    empty = (F.col("at") == 0) & (F.col("s.w0") == "")
    hashed = terms.select(*keys, "at", F.when(~empty, F.xxhash64(*[F.col(f"s.w{i}") for i in range(SHINGLE)])).alias("h"))
    lanes = [F.sum(F.shiftrightunsigned("h", b).bitwiseAND(F.lit(_LANES))).alias(f"v{b}") for b in range(32)]
    heads = F.sum(F.when(F.col("at") == 0, 1).otherwise(0)).alias("rows")
    sums = hashed.groupBy(*keys).agg(heads, F.count("h").alias("n"), *lanes)
    one = F.lit(1).cast("long")
    bits = []
    for b in range(32):
        for votes, place in ((F.col(f"v{b}").bitwiseAND(F.lit(0xFFFFFFFF)), b), (F.shiftrightunsigned(f"v{b}", 32), b + 32)):
            bits.append(F.when(2 * votes > F.col("n"), F.shiftleft(one, place)).otherwise(F.lit(0).cast("long")))
    return sums.select(*keys, "rows", reduce(lambda a, b: a.bitwiseOR(b), bits).alias("fingerprint"))


def likeness(a: Column, b: Column) -> Column:
    return 1 - F.bit_count(a.bitwiseXOR(b)) / F.lit(float(BITS))


def as_text(fingerprint: Column) -> Column:
    """16 hexadecimal digits."""
    return F.lower(F.lpad(F.hex(fingerprint), 16, "0"))


def block_keys(fingerprint: Column, radius: int = RADIUS, blocks: int = BLOCKS) -> Column:
    """The key of a fingerprint in every block table, as an array of longs.

    With the bits in ``blocks`` blocks, ``radius`` differing bits leave ``blocks - radius`` blocks equal. There is a
    table for every choice of so many blocks; its key is the fingerprint with the other blocks blanked out, which is
    the fingerprint permuted with these blocks in front and cut behind them. The table's number is hashed in.
    """
    edges = [BITS * i // blocks for i in range(blocks + 1)]
    masks = [((1 << edges[i + 1]) - (1 << edges[i])) for i in range(blocks)]
    chosen = [sum(masks[i] for i in equal) for equal in combinations(range(blocks), blocks - radius)]
    signed = [m - (1 << 64) if m >= 1 << 63 else m for m in chosen]
    return F.array(*[F.xxhash64(F.lit(i), fingerprint.bitwiseAND(F.lit(m))) for i, m in enumerate(signed)])


def within(fingerprints: DataFrame, queries: DataFrame, radius: int = RADIUS, blocks: int = BLOCKS) -> DataFrame:
    """``query, fingerprint, rows``: all fingerprints within ``radius`` of each query fingerprint, itself included.

    ``fingerprints`` has ``fingerprint, rows`` and ``queries`` has ``query``, each value once: copies are counted, not
    paired. Every pair that agrees in a table is checked, whatever the table's bucket holds.
    """
    table = fingerprints.select("fingerprint", "rows", F.explode(block_keys(F.col("fingerprint"), radius, blocks)).alias("bucket"))
    asked = queries.select("query", F.explode(block_keys(F.col("query"), radius, blocks)).alias("asked"))
    near = F.bit_count(F.col("fingerprint").bitwiseXOR(F.col("query"))) <= radius
    return table.join(asked, (F.col("bucket") == F.col("asked")) & near).select("query", "fingerprint", "rows").distinct()


# ------------------------------------------------------------------ neighbours in id order


def followers(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """``key, part, next``: every id (as a struct, so that null is a value, the first) with the id that follows it, the
    last being followed by the first, and a quarter of the length of each of its texts.

    Ids are dealt out by ranges and written with the range's number; within a range the next row follows, behind its end
    the first id of the next range, of which there is one per task.
    """
    rows = docs.select(F.struct(F.col(id_col).alias("id")).alias("key"), F.floor(F.coalesce(F.char_length(text_col), F.lit(0)) / 4).cast("int").alias("part"))
    ranged = rows.distinct().repartitionByRange("key").select("key", "part", F.spark_partition_id().alias("range"))
    ranged = staged(ranged, "ranges")
    ids = ranged.select("key", "range").distinct()
    heads = ids.groupBy("range").agg(F.min("key").alias("head"))
    in_order = W.orderBy("range")
    first = F.first("head").over(in_order.rowsBetween(W.unboundedPreceding, W.unboundedFollowing))
    heads = heads.select(F.col("range").alias("of_range"), F.coalesce(F.lead("head").over(in_order), first).alias("behind"))
    inner = ids.withColumn("inner", F.lead("key").over(W.partitionBy("range").orderBy("key")))
    nexts = inner.join(heads, F.col("range") == F.col("of_range")).select(F.col("key").alias("of"), F.coalesce("inner", "behind").alias("next"))
    return ranged.join(nexts, F.col("key") == F.col("of")).select("key", "part", "next")


def compare_with_edits(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", query_every: int = 100) -> DataFrame:
    """Fingerprints of all texts and of edited texts, in which the last quarter gives way to the start of the next document.

    ``doc_id, n_chars, edited_sha256, fingerprint, edited_fingerprint, near_edited, near_next, near_docs``. The last is
    for ids that ``query_every`` divides, else null: how many other rows have a fingerprint within ``RADIUS`` bits.

    Cases: a null text is empty; the last document is followed by the first, a single one by itself; of rows that share
    an id, each is edited, and for the row before them the smallest text start and the smallest fingerprint stand; an
    empty table gives an empty one. Only the named columns are read, so others may have any name.
    """
    base = docs.select(F.struct(F.col(id_col).alias("id")).alias("key"), F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("text"))
    links = staged(followers(docs, id_col, text_col), "followers")
    wanted = links.select(F.col("key").alias("to"), "part", F.col("next").alias("from"))
    starts = (
        base.join(wanted, F.col("key") == F.col("from"))
        .select("to", "part", F.expr("left(text, part)").alias("start"))
        .groupBy("to", "part")
        .agg(F.min("start").alias("start"))
    )
    # Written as two inequalities, the length is no join key, and both joins share one exchange of the texts by id.
    part = F.floor(F.char_length("text") / 4)
    joined = base.join(starts, (F.col("key") == F.col("to")) & (part <= F.col("part")) & (part >= F.col("part")))
    edited = F.concat(F.expr("left(text, char_length(text) - part)"), F.col("start"))
    joined = joined.select("key", F.char_length("text").cast("long").alias("n_chars"), F.xxhash64("text").alias("tie"), "text", edited.alias("edited"))
    both = joined.select(
        "key", "n_chars", "tie", F.sha2("edited", 256).alias("edited_sha256"), F.posexplode(F.array("text", "edited")).alias("which", "body")
    )
    found = fingerprints(both, ["key", "n_chars", "tie", "edited_sha256", "which"], "body")
    side = lambda i, c: F.max(F.when(F.col("which") == i, F.col(c)))
    pairs = found.groupBy("key", "n_chars", "tie", "edited_sha256").agg(
        side(0, "rows").alias("rows"), side(0, "fingerprint").alias("fingerprint"), side(1, "fingerprint").alias("edited_fingerprint")
    )
    pairs = staged(pairs, "fingerprints")
    least = pairs.groupBy(F.col("key").alias("next_key")).agg(F.min("fingerprint").alias("next_fingerprint"))
    order = links.select(F.col("key").alias("of"), F.col("next")).distinct()
    nexts = order.join(least, F.col("next") == F.col("next_key")).select("of", "next_fingerprint")
    counts = pairs.groupBy("fingerprint").agg(F.sum("rows").alias("rows"))
    asked = pairs.where(F.col("key.id") % query_every == 0).select(F.col("fingerprint").alias("query")).distinct()
    near = within(counts, asked).groupBy("query").agg((F.sum("rows") - 1).alias("near_docs"))
    out = pairs.join(nexts, F.col("key") == F.col("of")).join(near, F.col("fingerprint") == F.col("query"), "left")
    is_query = F.col("key.id") % query_every == 0
    return out.select(
        F.explode(F.array_repeat(F.lit(1), F.col("rows").cast("int"))).alias("copy"),
        F.col("key.id").alias("doc_id"),
        "n_chars",
        "edited_sha256",
        as_text(F.col("fingerprint")).alias("fingerprint"),
        as_text(F.col("edited_fingerprint")).alias("edited_fingerprint"),
        likeness(F.col("fingerprint"), F.col("edited_fingerprint")).alias("near_edited"),
        likeness(F.col("fingerprint"), F.col("next_fingerprint")).alias("near_next"),
        F.when(is_query, F.col("near_docs")).alias("near_docs"),
    ).drop("copy")
