"""URL filters: given site rules, and rules that Spark's FP-growth mines from labelled urls.

A url is a set of tokens: the labels of its host, the segments of its path (digits alone as ``#``, an ending apart), the
names in its query, its fragment. FP-growth finds the token sets that are frequent among labelled urls, and the
association rules from a set to the label ``bad``. A rule is kept when its support and confidence reach their bounds and
no rule with fewer of its tokens is as confident. Rules match by an inverted index: each stands under its rarest
token; a url looks up its tokens and is checked for the rest of the rule.

Cases: a null url, or one without ``://``, has an empty host and path, no tokens, and is allowed; without labelled urls
there are no mined rules; where several mined rules match, the most confident decides, then the first by its text;
equal urls get equal verdicts, whatever their rows; an empty table gives an empty one.
"""

from __future__ import annotations

import string

from pyspark.ml.fpm import FPGrowth
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from voxlake.llm.common import fresh, key128, staged

#: A rule covers this share of the labelled urls, and so many at least.
MIN_SUPPORT = 0.001
MIN_ROWS = 20
MIN_CONFIDENCE = 0.5
_BAD = "label:bad"


def parts(url: Column) -> dict[str, Column]:
    """Host (ASCII letters lower-cased), path, query and fragment."""
    rest = F.coalesce(F.regexp_extract(url, "(?s)^.*?://(.*)$", 1), F.lit(""))
    host = F.translate(F.regexp_extract(rest, "^[^/?#]*", 0), string.ascii_uppercase, string.ascii_lowercase)
    return {
        "host": host,
        "path": F.regexp_extract(rest, "^[^/?#]*([^?#]*)", 1),
        "query": F.regexp_extract(rest, "^[^?#]*\\?([^#]*)", 1),
        "fragment": F.regexp_extract(rest, "(?s)^[^#]*#(.*)$", 1),
    }


def site_rule(host: Column, path: Column, rules: dict[str, str]) -> tuple[Column, Column]:
    """The longest rule that fits, and its verdict; ``rules`` maps ``host/path`` to ``allow`` or ``block``.

    A rule fits its host and all hosts below it, if the path starts with the rule's. Of equally long ones, the first by
    its text is taken.
    """
    found, verdict = F.lit(None).cast("string"), F.lit(None).cast("string")
    for rule in sorted(rules, key=lambda r: (len(r), [-ord(c) for c in r])):
        site, _, start = rule.partition("/")
        fits = ((host == site) | host.endswith("." + site)) & path.startswith("/" + start)
        found, verdict = F.when(fits, F.lit(rule)).otherwise(found), F.when(fits, F.lit(rules[rule])).otherwise(verdict)
    return found, verdict


def tokens(url: Column) -> Column:
    p = parts(url)
    of = lambda kind, values: F.transform(F.filter(values, lambda x: x != ""), lambda x: F.concat(F.lit(kind + ":"), x))
    segments = F.split(F.regexp_replace(p["path"], "[0-9]+", "#"), "[/]", -1)
    names = F.transform(F.split(p["query"], "&", -1), lambda x: F.regexp_extract(x, "^[^=]*", 0))
    return F.array_distinct(
        F.concat(
            of("h", F.split(p["host"], "[.]", -1)),
            of("p", F.transform(segments, lambda x: F.regexp_extract(x, "^[^.]*", 0))),
            of("e", F.transform(segments, lambda x: F.regexp_extract(x, "[.](.*)$", 1))),
            of("q", names),
            of("f", F.array(p["fragment"])),
        )
    )


def matches(sets: DataFrame, rules: DataFrame) -> DataFrame:
    """Columns of both for every set and rule with all the rule's tokens in the set; ``sets`` has ``items``."""
    looked_up = sets.withColumn("looked_up", F.explode("items"))
    found = looked_up.join(rules, F.col("looked_up") == F.col("rarest"))
    return found.where(F.size(F.array_except("tokens", "items")) == 0).drop("looked_up")


def mine(labelled: DataFrame, min_support: float = MIN_SUPPORT, min_confidence: float = MIN_CONFIDENCE, min_rows: int = MIN_ROWS) -> DataFrame:
    """``tokens, rarest, confidence, support, mined``: the rules from ``items, bad`` (boolean) of labelled urls."""
    spark = labelled.sparkSession
    rows = labelled.where(F.col("bad").isNotNull() & (F.size("items") > 0))
    baskets = staged(rows.select(F.when(F.col("bad"), F.concat("items", F.array(F.lit(_BAD)))).otherwise(F.col("items")).alias("items")), "baskets")
    n = baskets.count()
    schema = "tokens array<string>, rarest string, confidence double, support double, mined string"
    if not n:
        return spark.createDataFrame([], schema)
    model = FPGrowth(itemsCol="items", minSupport=min(1.0, max(min_support, min_rows / n)), minConfidence=min_confidence).fit(baskets)
    confident = model.associationRules.where(F.col("consequent") == F.array(F.lit(_BAD)))
    single = model.freqItemsets.where(F.size("items") == 1).select(F.col("items")[0].alias("token"), "freq")
    rules = staged(
        confident.select(F.array_sort("antecedent").alias("tokens"), "confidence", "support")
        .withColumn("token", F.explode("tokens"))
        .join(single, "token")
        .groupBy("tokens", "confidence", "support")
        .agg(F.min_by("token", F.struct("freq", "token")).alias("rarest"))
        .withColumn("mined", F.array_join("tokens", " ")),
        "rules",
    )
    wider = rules.select(F.col("tokens").alias("items"), F.col("mined").alias("of"), F.col("confidence").alias("reached"))
    beaten = matches(wider, rules).where((F.col("mined") != F.col("of")) & (F.col("confidence") >= F.col("reached"))).select(F.col("of").alias("mined")).distinct()
    return rules.join(beaten, "mined", "left_anti").select(*[c.split()[0] for c in schema.split(", ")])


def judge(pages: DataFrame, rules: DataFrame, sites: dict[str, str], *, url_col: str = "url") -> DataFrame:
    """``pages`` with ``host, path, rule, verdict, mined``; columns of these names give way."""
    k1, k2, best = fresh(pages, "url_k1"), fresh(pages, "url_k2"), fresh(pages, "url_mined")
    url = F.col(url_col).cast("string")
    urls = pages.select(url.alias("url"), *[k.alias(c) for k, c in zip(key128(url), ("u1", "u2"), strict=True)]).distinct()
    order = F.struct(-F.col("confidence"), F.col("mined"))
    hit = matches(urls.select("u1", "u2", tokens(F.col("url")).alias("items")), rules).groupBy("u1", "u2").agg(F.min_by("mined", order).alias(best))
    keyed = pages.withColumns(dict(zip((k1, k2), key128(url), strict=True)))
    joined = keyed.join(hit, (F.col(k1) == F.col("u1")) & (F.col(k2) == F.col("u2")), "left")
    where = parts(url)
    rule, verdict = site_rule(where["host"], where["path"], sites)
    method = F.when(F.col(best).isNotNull(), "block").otherwise("allow")
    new = {"host": where["host"], "path": where["path"], "rule": rule, "verdict": F.coalesce(verdict, method), "mined": F.col(best)}
    kept = [pages[c] for c in pages.columns if c.lower() not in new]
    return joined.select(*kept, *[c.alias(n) for n, c in new.items()])


def labelled_urls(pages: DataFrame, labels: DataFrame, *, url_col: str = "url", id_col: str = "doc_id") -> DataFrame:
    """``items, bad``: urls whose path ends in the number of a labelled document; bad if any label says poor or toxic."""
    url = F.col(url_col).cast("string")
    number = F.regexp_extract(parts(url)["path"], "([0-9]+)[^0-9]*$", 1)
    linked = pages.select(url.alias("url"), number.try_cast("long").alias("number"))
    bad = F.coalesce((F.col("quality") == 0) | (F.col("toxic") == 1), F.lit(False))
    known = labels.where(F.col("quality").isNotNull() | F.col("toxic").isNotNull())
    told = known.groupBy(F.col(id_col).cast("long").alias("of")).agg(F.max(bad).alias("bad"))
    return linked.join(told, F.col("number") == F.col("of")).select(tokens(F.col("url")).alias("items"), "bad")
