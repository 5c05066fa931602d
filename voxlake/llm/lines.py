"""Line dedup by the spread of lines over sites.

The spread of a line is the number of distinct sites that hold it. Every line hash gets a HyperLogLog sketch of its
sites; sketches merge by aggregation, so a line with a third of all rows costs each task one sketch. An estimate far
from the threshold decides; lines whose estimate lies within ``band`` of it get an exact distinct count. A line on
``min_sites`` sites or more is boilerplate: it stays where it occurs first, in the order of document id and position,
and goes everywhere else.

Lines end at a line feed and are compared without blanks, tabs and carriage returns around them. Blank lines are never
judged. A null site is a site of its own.

Cases: a null text stays null and an empty text empty; rows that repeat get the same answer, and where a line occurs
first in several rows of one id and text, all of them keep it; of rows with a null id, which come first, the least hash
of the text decides; an empty table gives an empty one.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from voxlake.llm.common import fresh, key128, staged

#: Sites of a boilerplate line.
MIN_SITES = 5
#: Registers of a sketch, as a power of two: 1024, a standard error of 3.3 % once a line has hundreds of sites.
LOG_REGISTERS = 10
#: Estimates within this share of the threshold are counted exactly: five standard errors and a half, and one site at least.
BAND = 0.18


def _lines(text: Column) -> Column:
    return F.split(text, "\n", -1)


def _bare(line: Column) -> Column:
    return F.btrim(line, F.lit(" \t\r"))


def occurrences(docs: DataFrame, id_col: str, text_col: str, site_col: str) -> DataFrame:
    """``doc, tie, place, h1, h2, site``: every line that is not blank; ``doc, tie`` names a row by id and text."""
    rows = docs.select(
        F.col(id_col).alias("doc"),
        F.xxhash64(F.col(text_col)).alias("tie"),
        F.xxhash64(F.col(site_col).cast("string")).alias("site"),
        F.col(site_col).isNull().alias("no_site"),
        F.posexplode(_lines(F.col(text_col))).alias("place", "line"),
    )
    bare = rows.select("doc", "tie", "place", "site", "no_site", _bare(F.col("line")).alias("line")).where("line <> ''")
    site = F.when(F.col("no_site"), F.lit(0).cast("long")).otherwise(F.col("site"))
    return bare.select("doc", "tie", "place", *[h.alias(n) for h, n in zip(key128(F.col("line")), ("h1", "h2"), strict=True)], site.alias("site"))


def spread(found: DataFrame, min_sites: int = MIN_SITES, band: float = BAND, log_registers: int = LOG_REGISTERS) -> DataFrame:
    """``h1, h2, first``: the lines on ``min_sites`` sites or more and their first place ``(doc, tie, place)``."""
    sketches = found.groupBy("h1", "h2").agg(
        F.hll_sketch_estimate(F.hll_sketch_agg("site", F.lit(log_registers))).alias("sites"),
        F.min(F.struct("doc", "tie", "place")).alias("first"),
    )
    low, high = min_sites * (1 - band) - 1, min_sites * (1 + band) + 1
    judged = staged(sketches.where(F.col("sites") >= low), "line_sketches")
    near = judged.where(F.col("sites") <= high).select(F.col("h1").alias("n1"), F.col("h2").alias("n2"))
    pairs = found.select("h1", "h2", "site").distinct()
    exact = (
        pairs.join(near, (F.col("h1") == F.col("n1")) & (F.col("h2") == F.col("n2")), "left_semi")
        .groupBy("h1", "h2")
        .agg(F.count(F.lit(1)).alias("exact"))
        .where(F.col("exact") >= min_sites)
        .select(F.col("h1").alias("n1"), F.col("h2").alias("n2"))
    )
    sure = judged.where(F.col("sites") > high)
    counted = judged.where(F.col("sites") <= high).join(exact, (F.col("h1") == F.col("n1")) & (F.col("h2") == F.col("n2")), "left_semi")
    return sure.unionByName(counted).select("h1", "h2", "first")


def _without(text: Column, gone: Column) -> Column:
    """The text without the lines at these places (ascending, from 0); what is between two of them stays in one piece."""
    lines = _lines(text)
    starts = F.concat(F.array(F.lit(0)), F.transform(gone, lambda p: p + 1))
    ends = F.concat(gone, F.array(F.size(lines)))
    pieces = F.filter(F.arrays_zip(starts.alias("a"), ends.alias("b")), lambda x: x["a"] < x["b"])
    kept = F.transform(pieces, lambda x: F.array_join(F.slice(lines, x["a"] + 1, x["b"] - x["a"]), "\n"))
    return F.array_join(kept, "\n")


def dedup_lines(
    docs: DataFrame,
    *,
    id_col: str = "doc_id",
    text_col: str = "text",
    site_col: str = "source",
    min_sites: int = MIN_SITES,
    removed_col: str | None = None,
) -> DataFrame:
    """``docs`` with boilerplate lines taken out of the texts; ``removed_col`` names a further column with their number."""
    found = staged(occurrences(docs, id_col, text_col, site_col), "lines")
    wide = spread(found, min_sites).select(F.col("h1").alias("w1"), F.col("h2").alias("w2"), "first")
    here = F.struct("doc", "tie", "place")
    gone = (
        found.select("doc", "tie", "place", "h1", "h2")
        .join(wide, (F.col("h1") == F.col("w1")) & (F.col("h2") == F.col("w2")))
        .where(~here.eqNullSafe(F.col("first")))
    )
    key, tie, places = fresh(docs, "gone_doc"), fresh(docs, "gone_tie"), fresh(docs, "gone_places")
    by_row = gone.groupBy(F.col("doc").alias(key), F.col("tie").alias(tie)).agg(F.sort_array(F.collect_set("place")).alias(places))
    joined = docs.join(by_row, docs[id_col].eqNullSafe(by_row[key]) & (F.xxhash64(docs[text_col]) == by_row[tie]), "left")
    text = F.when(F.col(places).isNull(), docs[text_col]).otherwise(_without(docs[text_col], F.col(places)))
    columns = [text.alias(c) if c == text_col else docs[c] for c in docs.columns]
    if removed_col:
        columns.append(F.coalesce(F.size(F.when(F.col(places).isNotNull(), F.col(places))), F.lit(0)).alias(removed_col))
    return joined.select(*columns)
