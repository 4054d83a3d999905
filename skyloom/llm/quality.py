"""Quality rules with host-level verdicts, in DataFrame operations only.

Each text gets its rule figures; rule failures are summed by host (partial sums
before the shuffle, one small row per host after it); each rule's rate is shrunk
towards an empirical beta prior, fitted by moments over the hosts; hosts whose
shrunk rate of failing documents is above ``host_limit`` are rejected, and the
verdict is joined back to the documents.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from . import common as C

#: A document fails a rule beyond these values.
MIN_WORDS = 50
MAX_REPEAT_PERCENT = 50
MAX_SYMBOLS_PER_100_WORDS = 150
MAX_DUP_LINE_PERCENT = 60
WORD_CHARS_RANGE = (2, 14)
#: A host whose shrunk rate of failing documents is above this is rejected.
HOST_LIMIT = 0.6
RULES = ("few_words", "repeats", "symbols", "dup_lines", "word_length")


def rule_figures(docs: DataFrame, text_col: str = "text") -> DataFrame:
    """``docs`` with n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words.

    Null and blank texts have 0 in all of them.  Repeated words: 3-word windows
    sort as (64-bit hash, place); a window that equals a neighbour in that order
    is repeated, and each repeated place covers the words up to the next one.
    """
    text = F.coalesce(F.col(text_col), F.lit(""))
    out = docs.withColumn("_text", text).withColumn(
        "_words", F.array_remove(F.split("_text", C.SPACE), "")
    ).withColumn("_lines", F.filter(F.split("_text", "\n"), lambda x: x.rlike(C.WORD)))
    out = out.withColumn("n_words", F.size("_words").cast("long"))
    out = out.withColumn(
        "_windows",
        F.when(F.col("n_words") > 3, F.sort_array(F.transform(
            F.sequence(F.lit(0), F.size("_words") - 3),
            lambda i: F.struct(
                F.xxhash64(F.col("_words")[i], F.col("_words")[i + 1], F.col("_words")[i + 2]).alias("h"),
                i.alias("i")),
        ))),
    )
    get = lambda i: F.get("_windows", i)["h"]
    out = out.withColumn(
        "_repeated",
        F.sort_array(F.transform(
            F.filter("_windows", lambda w, k: w["h"].eqNullSafe(get(k - 1)) | w["h"].eqNullSafe(get(k + 1))),
            lambda w: w["i"])),
    )
    covered = F.aggregate(
        "_repeated", F.struct(F.lit(0).alias("n"), F.lit(-3).alias("last")),
        lambda a, i: F.struct((a["n"] + F.least(F.lit(3), i - a["last"])).alias("n"), i.alias("last")),
    )["n"]
    return out.select(
        *[F.col(f"`{c}`") for c in docs.columns if c not in FIGURES],
        "n_words",
        F.length(F.regexp_replace("_text", C.SPACE, "")).cast("long").alias("word_chars"),
        F.regexp_count("_text", F.lit("[#*$%&|<>]")).cast("long").alias("n_symbols"),
        (F.size("_lines") - F.size(F.array_distinct("_lines"))).cast("long").alias("n_dup_lines"),
        F.coalesce(covered, F.lit(0)).cast("long").alias("n_repeat_words"),
        F.size("_lines").alias("n_lines"),
    )


FIGURES = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_lines")


def rule_failures() -> dict[str, Column]:
    """A boolean for each rule, over the columns of ``rule_figures``."""
    n, chars = F.col("n_words"), F.col("word_chars")
    return {
        "few_words": n < MIN_WORDS,
        "repeats": 100 * F.col("n_repeat_words") > MAX_REPEAT_PERCENT * n,
        "symbols": 100 * F.col("n_symbols") > MAX_SYMBOLS_PER_100_WORDS * n,
        "dup_lines": 100 * F.col("n_dup_lines") > MAX_DUP_LINE_PERCENT * F.col("n_lines"),
        "word_length": (chars < WORD_CHARS_RANGE[0] * n) | (chars > WORD_CHARS_RANGE[1] * n),
    }


def host_verdicts(figures: DataFrame, host_col: str = "source", host_limit: float = HOST_LIMIT) -> DataFrame:
    """One row per host: docs, failures and shrunk rate per rule and of any rule, rejected.

    The prior Beta(a, b) of a rule has the mean of all documents and, by moments
    over the hosts, the strength m(1-m)/v - 1, held between 1 and 10,000; one host
    or none counts as no spread (10,000).  A null host is a host of its own.
    """
    fails = rule_failures()
    fails["any"] = F.greatest(*[c.cast("int") for c in fails.values()]) > 0
    hosts = figures.groupBy(F.col(host_col).alias("host")).agg(
        F.count("*").alias("n_docs"), *[F.sum(c.cast("long")).alias(f"{k}_failed") for k, c in fails.items()]
    )
    stats = hosts.agg(*[
        x for k in fails for x in (
            (F.sum(f"{k}_failed") / F.sum("n_docs")).alias(f"{k}_m"),
            F.var_samp(F.col(f"{k}_failed") / F.col("n_docs")).alias(f"{k}_v"))
    ])
    out = hosts.crossJoin(F.broadcast(stats))  # one row of rates
    for k in fails:
        m, v = F.col(f"{k}_m"), F.col(f"{k}_v")
        strength = F.least(F.lit(1e4), F.greatest(F.lit(1.0), F.coalesce(F.try_divide(m * (1 - m), v) - 1, F.lit(1e4))))
        out = out.withColumn(f"{k}_rate", (F.col(f"{k}_failed") + strength * m) / (F.col("n_docs") + strength))
    return out.select(
        "host", "n_docs", *[f"{k}_failed" for k in fails], *[f"{k}_rate" for k in fails],
        (F.col("any_rate") > host_limit).alias("host_rejected"),
    )


def quality(
    docs: DataFrame, text_col: str = "text", host_col: str = "source", host_limit: float = HOST_LIMIT,
    keep_text: bool = True, text_of_failed: bool = True,
) -> DataFrame:
    """``docs`` (without the text, if so asked) with the figures, base_failed, host_rate, host_rejected and kept.

    base_failed: fewer than 50 words, or over half the words in repeated windows.
    Without ``text_of_failed`` the texts of rows that fail it are null in the result.
    Rows that repeat are judged one by one; an empty table gives an empty result.
    Columns of ``docs`` that have the names of result columns are replaced.
    """
    out_cols = {*FIGURES, "base_failed", "host_rate", "host_rejected", "kept"}
    rest = [F.col(f"`{c}`") for c in docs.columns if c not in out_cols]
    figures = rule_figures(docs.select(*rest), text_col)
    # Stored, as the figures are needed twice and cost far more than the rest.
    if not text_of_failed:
        figures = figures.withColumn(text_col, F.when(~base_failed(), F.col(f"`{text_col}`")))
    figures = C.stored(figures if keep_text else figures.drop(text_col))
    # One row per host, stored: Catalyst knows its size, and broadcasts it only if that is small.
    hosts = host_verdicts(figures.select(F.col(host_col).alias("_h"), *FIGURES), "_h", host_limit).select(
        F.col("host").alias("_host"), F.col("any_rate").alias("host_rate"), "host_rejected"
    )
    return (
        figures.join(C.stored(hosts), F.col(host_col).eqNullSafe(F.col("_host")), "left")
        .withColumn("base_failed", base_failed())
        .withColumn("kept", ~F.col("base_failed") & ~F.col("host_rejected"))
        .drop("_host")
    )


def base_failed() -> Column:
    fails = rule_failures()
    return fails["few_words"] | fails["repeats"]
