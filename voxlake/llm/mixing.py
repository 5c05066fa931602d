"""Mix sources to target weights by entropy balancing.

Every document gets a rate (how often it is to be read). The rates are those nearest to the base rates, in relative
entropy weighted by words, that give every source its target of words. The dual of that problem has one multiplier per
source; its solution is an exponential tilt ``rate = base * exp(multiplier)``, stopped at ``cap``. Newton steps over
aggregated cells find the multipliers; the rates are then rounded into whole copies.

Cases: a null text has size 0; a null source is a source of its own, last in order; rows that repeat are documents of
their own, and which of several equal ones is copied cannot be told from the result; a source without words has target
0; an empty table gives an empty one. Only the named columns are read, so others may have any name.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from voxlake.llm.common import drop_folder, fresh, key128, map_arrow, staged, texts, words

#: Documents that one task ranks at most, on average, whatever their source and size.
RANKED_PER_TASK = 20_000
MAX_STEPS = 60


def word_counts(docs: DataFrame, id_col: str, text_col: str, *keep: str) -> DataFrame:
    """``doc_id``, the kept columns and ``size``: maximal runs without white space in the whole text."""
    chosen = docs.select(F.col(id_col).alias("doc_id"), *keep, F.col(text_col).cast("string").alias("text"))
    schema = chosen.drop("text").withColumn("size", F.lit(0).cast("long")).schema

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sizes = np.zeros(len(batch), np.int64)
            for at, end, raw, bounds in texts(batch.column(batch.num_columns - 1)):
                sizes[at:end] = np.diff(words(raw, bounds)[2])
            yield pa.RecordBatch.from_arrays([*batch.columns[:-1], pa.array(sizes)], names=schema.names)

    return map_arrow(chosen, count, schema)


def source_targets(sized: DataFrame, weights: tuple[float, ...], cap: float) -> DataFrame:
    """``source, source_size, target``, one row per source.

    Sources in code point order, null last, take the weights in turn and share all words by them. A target stops at
    ``cap`` times its source; what is over goes to the others by weight. That is the level ``m`` at which
    ``min(cap * size, weight * m)`` adds up to all words. With sources in the order in which they meet their cap, the
    level that those from one on would share rises while sources before it are over their cap and falls behind it: the
    highest is the level sought.
    """
    sums = sized.groupBy("source").agg(F.sum("size").alias("source_size"))
    turn = (F.row_number().over(W.orderBy(F.col("source").asc_nulls_last())) - 1) % len(weights)
    weighed = sums.withColumn("weight", F.element_at(F.array(*map(F.lit, map(float, weights))), (turn + 1).cast("int")))
    met = W.orderBy(F.col("full") / F.col("weight"), F.col("source").asc_nulls_last())
    before, after = met.rowsBetween(W.unboundedPreceding, -1), met.rowsBetween(0, W.unboundedFollowing)
    levels = weighed.withColumn("full", cap * F.col("source_size")).select(
        "*",
        (
            (F.sum("source_size").over(W.partitionBy()) - F.coalesce(F.sum("full").over(before), F.lit(0.0)))
            / F.sum("weight").over(after)
        ).alias("level"),
    )
    return levels.withColumn("m", F.max("level").over(W.partitionBy())).select(
        "source", "source_size", F.least(F.col("full"), F.col("weight") * F.col("m")).alias("target")
    )


def tilts(cells: DataFrame, targets: DataFrame, cap: float, tolerance: float = 1e-9) -> DataFrame:
    """``source, tilt``: Newton steps on the dual, every source in the same distributed aggregation.

    ``cells`` has ``source, base, tokens``. The gradient of a source is the words its rates give less its target, the
    curvature the words of its documents below the cap. Steps are limited, so that a source whose documents reach the
    cap on the way comes back; a target at or above the cap of all words has no finite multiplier and ends at the cap.
    """
    spark = cells.sparkSession
    total = cells.groupBy("source").agg(F.sum(F.col("tokens") * F.col("base")).alias("mass"))
    state = staged(
        targets.join(total, targets["source"].eqNullSafe(total["source"]))
        .where("target > 0 and mass > 0")
        .select(targets["source"], "target", F.log(F.col("target") / F.col("mass")).alias("tilt")),
        "tilts",
    )
    for _ in range(MAX_STEPS):
        open_rate = F.col("base") * F.exp("tilt")
        sums = (
            cells.join(state, cells["source"].eqNullSafe(state["source"]))
            .groupBy(state["source"], "target", "tilt")
            .agg(
                F.sum(F.col("tokens") * F.least(F.lit(cap), open_rate)).alias("given"),
                F.sum(F.when(open_rate < cap, F.col("tokens") * open_rate).otherwise(0.0)).alias("curve"),
            )
        )
        gap = F.col("given") - F.col("target")
        step = F.when(F.abs(gap) <= tolerance * F.col("target"), 0.0).when(F.col("curve") > 0, gap / F.col("curve"))
        step = F.greatest(F.lit(-2.0), F.least(F.lit(2.0), F.coalesce(step, F.when(gap > 0, 0.5).otherwise(0.0))))
        new = staged(sums.select("source", "target", (F.col("tilt") - step).alias("tilt"), step.alias("step")), "tilts")
        worst = new.agg(F.max(F.abs("step"))).first()[0]
        drop_folder(spark, state)
        state = new
        if worst is None or worst <= 1e-12:
            break
    return state.select("source", "tilt")


def mix(
    docs: DataFrame,
    *,
    id_col: str = "doc_id",
    text_col: str = "text",
    source_col: str = "source",
    base_col: str | None = None,
    weights: tuple[float, ...] = (5, 2, 1),
    cap: float = 3.0,
) -> DataFrame:
    """One row per document: ``doc_id, size, source_size, target, taken, copies, rate``.

    Copies are rounded so that the running sum of the fractions, over the documents of a source from the longest to the
    shortest, is met within one half at every point; the words taken then miss the target by less than the longest
    document. One document per source closes that gap: its last copy is cut, or it is read a part more. ``taken`` has
    these words, ``copies`` the whole copies before that. No document is taken more than ``cap`` times its size.

    Documents of one source and size are interchangeable, so the running sum goes over such cells, and a rank within a
    cell is the rank within a hashed bucket plus the counts of the buckets before: no task sees a source whole.
    """
    base = F.col(base_col).cast("double") if base_col else F.lit(1.0)
    named = docs.select(
        F.col(id_col).alias("id"),
        F.col(text_col).alias("words"),
        F.col(source_col).cast("string").alias("source"),
        F.coalesce(F.greatest(base, F.lit(0.0)), F.lit(0.0)).alias("base"),
    )
    sized = staged(word_counts(named, "id", "words", "source", "base"), "sizes")
    targets = staged(source_targets(sized, weights, cap), "targets")
    cells = sized.groupBy("source", "base").agg(F.sum("size").alias("tokens"))
    tilt = tilts(cells, targets, cap)

    rows = sized.count()
    buckets = max(1, -(-rows // RANKED_PER_TASK))
    keys = ["source_key", "base", "size", "bucket"]
    source_key = F.when(F.col("source").isNull(), "").otherwise(F.concat(F.lit("="), "source"))
    documents = sized.select(
        "doc_id",
        source_key.alias("source_key"),
        "base",
        "size",
        F.pmod(F.xxhash64("doc_id"), F.lit(buckets)).alias("bucket"),
    )
    rates = targets.join(tilt, targets["source"].eqNullSafe(tilt["source"]), "left").select(
        source_key_of(targets).alias("source_key"), "source_size", "target", "tilt"
    )
    parts = documents.groupBy(*keys).agg(F.count(F.lit(1)).alias("n"))
    cell = ["source_key", "base", "size"]
    sums = parts.groupBy(*cell).agg(F.sum("n").alias("cell_n")).join(rates, "source_key")
    rate = F.coalesce(F.least(F.lit(cap), F.col("base") * F.exp("tilt")), F.lit(0.0))
    sums = sums.withColumn("rate", F.round(rate, 12)).withColumn("whole", F.floor("rate"))
    order = W.partitionBy("source_key").orderBy(F.desc("size"), F.desc("rate"), "base")
    run = F.round(F.sum(F.col("cell_n") * (F.col("rate") - F.col("whole"))).over(order.rowsBetween(W.unboundedPreceding, 0)), 6)
    sums = sums.withColumn("run", run).withColumn("run_before", F.coalesce(F.lag("run").over(order), F.lit(0.0)))
    more = F.floor(F.col("run") + 0.5) - F.floor(F.col("run_before") + 0.5)
    sums = sums.withColumn("more", F.greatest(F.lit(0), F.least("cell_n", more)))
    of_source = W.partitionBy("source_key")
    excess = F.sum(F.col("size") * (F.col("cell_n") * F.col("whole") + F.col("more"))).over(of_source) - F.col("target")
    sums = sums.withColumn("excess", F.round(excess).cast("long"))
    # The longest cell that can give back, or take, one document's part.
    can = F.when(F.col("size") == 0, False).otherwise(
        F.when(F.col("excess") > 0, (F.col("whole") > 0) | (F.col("more") > 0)).otherwise(
            (F.col("whole") < int(cap)) & (F.col("more") < F.col("cell_n"))
        )
    )
    sums = sums.withColumn("closing", F.row_number().over(W.partitionBy("source_key", can).orderBy(F.desc("size"), F.desc("rate"), "base")))
    sums = sums.withColumn("closes", can & (F.col("closing") == 1)).drop("closing", "tilt", "run", "run_before")

    before = W.partitionBy(*cell).orderBy("bucket").rowsBetween(W.unboundedPreceding, -1)
    parts = parts.withColumn("before", F.coalesce(F.sum("n").over(before), F.lit(0))).join(sums, cell)
    ranked = documents.withColumn("place", F.row_number().over(W.partitionBy(*keys).orderBy(F.xxhash64("doc_id"), "doc_id")))
    joined = ranked.join(parts, keys).withColumn("place", F.col("place") + F.col("before"))
    copies = (F.col("whole") + (F.col("place") <= F.col("more")).cast("long")).cast("long")
    joined = joined.withColumn("copies", copies)
    closing = F.when(
        F.col("closes") & (F.col("excess") > 0) & (F.col("place") == 1),
        -F.least(F.col("excess"), F.col("copies") * F.col("size")),
    ).when(
        F.col("closes") & (F.col("excess") < 0) & (F.col("place") == F.col("cell_n")),
        F.least(-F.col("excess"), F.floor(cap * F.col("size")) - F.col("copies") * F.col("size")),
    )
    taken = F.col("copies") * F.col("size") + F.coalesce(closing, F.lit(0))
    return joined.select("doc_id", "size", "source_size", "target", taken.cast("long").alias("taken"), "copies", "rate")


def source_key_of(table: DataFrame):
    return F.when(table["source"].isNull(), "").otherwise(F.concat(F.lit("="), table["source"]))


def resample(
    docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source", **options
) -> DataFrame:
    """The mix as documents, each as often as it is taken (a part counts as a copy); same columns as ``docs``.

    Rows meet their counts by a hash of id, text and source. Equal rows share the copies that all of them got.
    """
    key, place, times = fresh(docs, "mix_key"), fresh(docs, "mix_place"), fresh(docs, "mix_times")
    columns = docs.columns
    keyed = docs.withColumn(key, F.struct(*key128(F.col(id_col), F.col(text_col), F.col(source_col))))
    taken = mix(keyed, id_col=key, text_col=text_col, source_col=source_col, **options)
    counts = taken.groupBy(F.col("doc_id").alias("mix_id")).agg(
        F.sum(F.when(F.col("taken") > 0, F.ceil(F.col("taken") / F.col("size"))).otherwise(0)).alias("mix_all"),
        F.count(F.lit(1)).alias("mix_rows"),
    )
    placed = keyed.withColumn(place, F.row_number().over(W.partitionBy(key).orderBy(key)))
    joined = placed.join(counts.where("mix_all > 0"), F.col(key) == F.col("mix_id"))
    share = lambda p: F.floor(F.col("mix_all") * p / F.col("mix_rows"))
    joined = joined.withColumn(times, (share(F.col(place)) - share(F.col(place) - 1)).cast("int")).where(F.col(times) > 0)
    return joined.select(*columns, F.explode(F.array_repeat(F.lit(1), F.col(times))).alias(times)).select(*columns)
