"""URL filters by given rules and by mined association rules (op 4).

Given rules name a host, with all its subdomains, and the start of a path; the longest that
fits decides.  Addresses without such a rule are judged by rules mined from those with one:
each labelled address is the set of its tokens (host labels and their words, path segments
with digits folded) plus its label, and Spark's FP-growth finds the frequent sets.  A mined
rule says "these tokens, then this label".  It is kept if its support and confidence reach
the thresholds and if no rule with one token less is as confident.

Matching uses an inverted index: each mined rule is posted under its rarest token alone, so
common tokens (com, en) rarely fetch rules, and the rest of a fetched rule is compared
inside the row.  Addresses with equal tokens are judged once.  The most confident matching
rule wins; of equals the one with more tokens, then ``allow``; without a match the verdict
is ``allow``.

The mined rules are bounded by the support threshold, not by the number of addresses, and
are written to scratch, so the planner broadcasts them only by their true size.

Edge cases: a null address, or one without ``://``, has empty host and path, no rule and
verdict ``allow``; a path without ``/`` fits no rule whose path is ``/``; no labelled
addresses give no mined rules; repeated rows and ids are judged each; other columns are
not read.
"""

from __future__ import annotations

from collections.abc import Sequence
from typing import NamedTuple

from pyspark.ml.fpm import FPGrowth
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from touchline.scratch import spill

MIN_SUPPORT = 0.005
MIN_CONFIDENCE = 0.8
LABEL = "="
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


class Rule(NamedTuple):
    verdict: str
    host: str
    path: str


def host_and_path(url: Column) -> tuple[Column, Column]:
    at = F.instr(url, "://")
    rest = F.when(at > 0, F.substring(url, at + 3, F.length(url))).otherwise("")
    rest = F.coalesce(rest, F.lit(""))
    host = F.translate(F.regexp_extract(rest, "^[^/?#]*", 0), _UPPER, _LOWER)
    return host, F.regexp_extract(rest, "^[^/?#]*([^?#]*)", 1)


def given_rule(host: Column, path: Column, rules: Sequence[Rule]) -> tuple[Column, Column]:
    """The longest fitting rule as text, and its verdict; null where none fits."""
    name, verdict = F.lit(None).cast("string"), F.lit(None).cast("string")
    for rule in sorted(rules, key=lambda r: len(r.host + r.path)):
        fits = ((host == rule.host) | host.endswith("." + rule.host)) & path.startswith(rule.path)
        name = F.when(fits, rule.host + rule.path).otherwise(name)
        verdict = F.when(fits, rule.verdict).otherwise(verdict)
    return name, verdict


def address_tokens(host: Column, path: Column) -> Column:
    """Sorted set of tokens: host labels, words of hyphenated labels, folded path segments."""
    labels = F.array_remove(F.split(host, "[.]"), "")
    words = F.array_except(F.array_remove(F.split(host, "[.-]"), ""), labels)
    segments = F.array_remove(F.split(F.regexp_replace(path, "[0-9]+", "0"), "/"), "")
    marked = F.concat(
        F.transform(labels, lambda x: F.concat(F.lit("host:"), x)),
        F.transform(words, lambda x: F.concat(F.lit("word:"), x)),
        F.transform(segments, lambda x: F.concat(F.lit("path:"), x)),
    )
    return F.array_sort(F.array_distinct(marked))


def mined_rules(
    labelled: DataFrame, min_support: float = MIN_SUPPORT, min_confidence: float = MIN_CONFIDENCE
) -> DataFrame:
    """From (tokens, verdict): antecedent, post (rarest token), verdict, confidence, support."""
    items = labelled.select(
        F.concat("tokens", F.array(F.concat(F.lit(LABEL), F.col("verdict")))).alias("items")
    )
    model = FPGrowth(itemsCol="items", minSupport=min_support, minConfidence=0.0).fit(items)
    sets = spill(model.freqItemsets, "url-itemsets")
    is_label = F.exists("items", lambda x: x.startswith(LABEL))
    only = F.filter("items", lambda x: ~x.startswith(LABEL))
    labels = F.filter("items", lambda x: x.startswith(LABEL))
    bases = sets.filter(~is_label).select(
        F.array_sort("items").alias("antecedent"), F.col("freq").alias("base")
    )
    rules = (
        sets.filter(is_label & (F.size(only) > 0) & (F.size(labels) == 1))
        .select(
            F.array_sort(only).alias("antecedent"),
            F.substring(labels[0], len(LABEL) + 1, 1 << 20).alias("verdict"),
            F.col("freq").alias("support"),
        )
        .join(bases, "antecedent")
        .withColumn("confidence", F.col("support") / F.col("base"))
    )
    rules = spill(rules, "url-rules")
    # A rule must be more confident than each rule with one token less.
    shorter = rules.select(
        F.col("antecedent").alias("__less"),
        F.col("verdict").alias("__verdict"),
        F.col("confidence").alias("__confidence"),
    )
    parts = rules.filter(F.size("antecedent") > 1).select(
        "antecedent",
        "verdict",
        "confidence",
        F.explode("antecedent").alias("__token"),
    )
    weak = (
        parts.join(
            shorter,
            (F.array_remove("antecedent", F.col("__token")) == F.col("__less"))
            & (F.col("verdict") == F.col("__verdict"))
            & (F.col("__confidence") >= F.col("confidence")),
        )
        .select("antecedent", "verdict")
        .distinct()
    )
    kept = rules.filter(F.col("confidence") >= min_confidence).join(
        weak, ["antecedent", "verdict"], "left_anti"
    )
    frequency = bases.filter(F.size("antecedent") == 1).select(
        F.col("antecedent")[0].alias("__token"), F.col("base").alias("__times")
    )
    rarest = (
        kept.select("*", F.explode("antecedent").alias("__token"))
        .join(frequency, "__token")
        .groupBy("antecedent", "verdict", "confidence", "support")
        .agg(F.min(F.struct("__times", "__token")).alias("__rarest"))
    )
    return rarest.select(
        "antecedent",
        F.col("__rarest")["__token"].alias("post"),
        "verdict",
        "confidence",
        "support",
    )


def match_rules(token_sets: DataFrame, rules: DataFrame) -> DataFrame:
    """Per distinct token set with a matching rule: tokens, mined (its verdict)."""
    posted = rules.select("post", "antecedent", F.col("verdict").alias("mined"), "confidence")
    fetched = token_sets.select("tokens", F.explode("tokens").alias("post")).join(posted, "post")
    fits = F.size(F.array_except("antecedent", "tokens")) == 0
    best = F.max(
        F.struct(
            "confidence",
            F.size("antecedent").alias("size"),
            (F.col("mined") == "allow").alias("mild"),
            "mined",
        )
    )
    return fetched.filter(fits).groupBy("tokens").agg(best["mined"].alias("mined"))


def judged_urls(
    pages: DataFrame,
    rules: Sequence[Rule],
    url: str = "url",
    id_column: str = "page_id",
    min_support: float = MIN_SUPPORT,
    min_confidence: float = MIN_CONFIDENCE,
) -> DataFrame:
    """Per page: page_id, host, path, rule, verdict."""
    host, path = host_and_path(F.col(url))
    parts = pages.select(
        F.col(id_column).cast("long").alias("page_id"), host.alias("host"), path.alias("path")
    )
    rule, verdict = given_rule(F.col("host"), F.col("path"), rules)
    parts = parts.select(
        "*",
        rule.alias("rule"),
        verdict.alias("given"),
        address_tokens(F.col("host"), F.col("path")).alias("tokens"),
    )
    labelled = parts.filter(F.col("given").isNotNull()).select(
        "tokens", F.col("given").alias("verdict")
    )
    mined = spill(mined_rules(labelled, min_support, min_confidence), "url-mined")
    others = parts.filter(F.col("given").isNull()).select("tokens").distinct()
    found = spill(match_rules(others, mined), "url-verdicts")
    return parts.join(found.withColumnRenamed("tokens", "__tokens"), F.col("tokens") == F.col("__tokens"), "left").select(
        "page_id",
        "host",
        "path",
        "rule",
        F.coalesce("given", "mined", F.lit("allow")).alias("verdict"),
    )
