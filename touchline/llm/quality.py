"""Quality rules with host verdicts (op 6).

Base rules judge each text on its own: too few words, or too many words inside repeated
5-word windows.  Host rules then ask how often the texts of one host (here: source) fail.
Raw rates of small hosts are noise, so they are shrunk with an empirical beta prior: the
prior's mean and weight are fitted to the rates of all hosts by moments, and a host's rate
becomes (failures + a) / (rows + a + b).  Hosts whose shrunk rate reaches
``host_limit`` are rejected, and the verdict is joined back to their documents.

All in built-in functions.  One scan makes the counts, which are written once to the shared
scratch folder without the texts; only counts and (host, failed) sums are shuffled.  The
join of hosts to documents is left to the planner, which broadcasts by the written size or
splits a host with a third of all rows.

Repeated windows are found inside the row: if any two windows of a text share a hash, the
hashes are sorted as longs with their position, neighbours that share one are candidates,
and the candidates' full words are compared.  No row leaves its task for this and nothing is quadratic.

Edge cases: null text has no words and fails; a null host is a host of its own; a host of
one text gets nearly the prior mean; without any rows there is no output; with all rates
equal the prior is taken as ``flat_weight`` rows of the common rate; repeated rows are
judged each; other columns are not read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from touchline.llm.common import BLANKS, text_of
from touchline.scratch import spill

MIN_WORDS = 10
MAX_REPEAT_PERCENT = 20
WINDOW = 5
HOST_LIMIT = 0.5
FLAT_WEIGHT = 20.0
# The position of a window takes the low 26 bits of its sort key: arrays of longs hold fewer
# than 2**26 windows long before they meet the row size limit of Spark.
_POSITION_BITS = 26


def _window_text(words: Column, start: Column) -> Column:
    return F.array_join(F.slice(words, start + 1, F.lit(WINDOW)), " ")


def _window_hashes(word_hashes: Column) -> Column:
    """One hash per window of ``WINDOW`` words: the shifted arrays side by side, hashed once."""
    n = F.greatest(F.size(word_hashes) - (WINDOW - 1), F.lit(0))
    shifted = [F.slice(word_hashes, k + 1, n) for k in range(WINDOW)]
    return F.transform(F.arrays_zip(*shifted), lambda w: F.xxhash64(w))


def _neighbours(items: Column) -> Column:
    """Each element beside the next one, as structs (a, b)."""
    n = F.greatest(F.size(items) - 1, F.lit(0))
    return F.arrays_zip(F.slice(items, 1, n).alias("a"), F.slice(items, 2, n).alias("b"))


def text_measures(docs: DataFrame, text: str, keep: dict[str, Column]) -> DataFrame:
    """The columns of ``keep`` and the counts of each text.

    One step per select, so that no array is computed twice.
    """
    whole = text_of(text)
    mask = (1 << _POSITION_BITS) - 1
    rows = docs.select(
        *(c.alias(n) for n, c in keep.items()),
        F.array_remove(F.split(whole, f"{BLANKS}+"), "").alias("__words"),
        (F.length(whole) - F.length(F.regexp_replace(whole, "[#*$%&|<>]+", "")))
        .cast("long")
        .alias("n_symbols"),
        F.filter(F.split(whole, "\n"), lambda x: x.rlike("[^\\x20\\x09-\\x0D]")).alias("__lines"),
    )
    rows = rows.select(
        *keep,
        "__words",
        "n_symbols",
        F.size("__words").cast("long").alias("n_words"),
        F.length(F.array_join("__words", "")).cast("long").alias("word_chars"),
        (F.size("__lines") - F.size(F.array_distinct("__lines"))).cast("long").alias("n_dup_lines"),
        F.transform("__words", lambda w: F.xxhash64(w)).alias("__hashes"),
    )
    rows = rows.withColumn("__hashes", _window_hashes(F.col("__hashes")))
    # Texts whose windows all differ are done; only the others are sorted.
    some = F.size(F.array_distinct("__hashes")) < F.size("__hashes")
    rows = rows.withColumn(
        "__hashes",
        F.when(
            some,
            F.sort_array(
                F.transform(
                    "__hashes",
                    lambda x, i: x.bitwiseAND(F.lit(~mask)).bitwiseOR(i.cast("long")),
                )
            ),
        ).otherwise(F.array().cast("array<bigint>")),
    )
    pairs = F.filter(
        _neighbours(F.col("__hashes")),
        lambda p: F.shiftrightunsigned(p["a"].bitwiseXOR(p["b"]), _POSITION_BITS) == 0,
    )
    rows = rows.withColumn(
        "__hashes", F.array_distinct(F.flatten(F.transform(pairs, lambda p: F.array(p["a"], p["b"]))))
    )
    # The words themselves decide; sorted by words, equal windows are neighbours.
    rows = rows.withColumn(
        "__same",
        F.sort_array(
            F.transform(
                "__hashes",
                lambda x: F.struct(
                    _window_text(F.col("__words"), x.bitwiseAND(F.lit(mask)).cast("int")).alias("w"),
                    x.bitwiseAND(F.lit(mask)).cast("int").alias("i"),
                ),
            )
        ),
    ).drop("__hashes", "__words")
    equal = F.filter(_neighbours(F.col("__same")), lambda p: p["a"]["w"] == p["b"]["w"])
    rows = rows.withColumn(
        "__same",
        F.sort_array(
            F.array_distinct(
                F.flatten(F.transform(equal, lambda p: F.array(p["a"]["i"], p["b"]["i"])))
            )
        ),
    )
    # Words covered by windows at sorted positions: each adds its step to the next, at most 5.
    steps = F.transform(
        _neighbours(F.col("__same")), lambda p: F.least(F.lit(WINDOW), p["b"] - p["a"])
    )
    covered = F.aggregate(
        steps, F.lit(0).cast("long"), lambda total, step: total + step
    ) + F.when(F.size("__same") > 0, WINDOW).otherwise(0)
    return rows.select(
        *keep, "n_words", "word_chars", "n_symbols", "n_dup_lines", covered.alias("n_repeat_words")
    )


def base_verdicts(docs: DataFrame, text: str, keep: dict[str, Column]) -> DataFrame:
    failed = (F.col("n_words") < MIN_WORDS) | (
        100 * F.col("n_repeat_words") > MAX_REPEAT_PERCENT * F.col("n_words")
    )
    return text_measures(docs, text, keep).withColumn("base_failed", failed)


def host_verdicts(judged: DataFrame, host: str = "host", limit: float = HOST_LIMIT) -> DataFrame:
    """Per host: rows, failures, shrunk rate, rejected.

    Moments over hosts: mean m and variance v of the raw rates, each host counting by its
    rows; with weight s = m (1 - m) / v - 1 the prior is beta(m s, (1 - m) s).
    """
    counts = judged.groupBy(F.col(host).alias("host")).agg(
        F.count(F.lit(1)).alias("host_rows"),
        F.sum(F.col("base_failed").cast("long")).alias("host_failed"),
    )
    rate = F.col("host_failed") / F.col("host_rows")
    moments = counts.agg(
        (F.sum("host_failed") / F.sum("host_rows")).alias("m"),
        (F.sum(F.col("host_rows") * rate * rate) / F.sum("host_rows")).alias("m2"),
    ).select("m", (F.col("m2") - F.col("m") * F.col("m")).alias("v"))
    found = moments.first()  # two numbers
    mean, variance = found["m"] or 0.0, found["v"] or 0.0
    weight = mean * (1 - mean) / variance - 1 if variance > 1e-12 else FLAT_WEIGHT
    weight = max(weight, 1.0)
    shrunk = (F.col("host_failed") + F.lit(mean * weight)) / (F.col("host_rows") + F.lit(weight))
    return counts.select(
        "host", "host_rows", "host_failed", shrunk.alias("host_rate"), (shrunk >= limit).alias("rejected")
    )


def quality_rules(
    docs: DataFrame, text: str = "text", id_column: str = "doc_id", host: str = "source"
) -> DataFrame:
    """Per document: doc_id, counts, base_failed, kept."""
    judged = base_verdicts(
        docs, text, {"doc_id": F.col(id_column).cast("long"), "host": F.col(host).cast("string")}
    )
    # Counts are needed twice, for the hosts and for the documents: written once, narrow.
    judged = spill(judged, "quality")
    hosts = host_verdicts(judged).select(F.col("host").alias("__host"), "rejected")
    return judged.join(hosts, F.col("host").eqNullSafe(F.col("__host")), "left").select(
        "doc_id",
        "n_words",
        "word_chars",
        "n_symbols",
        "n_dup_lines",
        "n_repeat_words",
        "base_failed",
        (~F.col("base_failed") & ~F.coalesce("rejected", F.lit(False))).alias("kept"),
    )
