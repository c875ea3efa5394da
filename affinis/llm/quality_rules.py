"""Quality rules with host verdicts, in built-in functions only.

Each document is measured and tested by a few rules. Failures are counted per host, a host's failure rate is
shrunk towards the others by a beta prior fitted to all hosts, and a host whose shrunk rate is beyond a limit
takes all of its documents with it. Host verdicts come from every document; nothing is sampled.

Defined cases: a null text has no words and fails `few_words`; null hosts form one host of their own; repeated rows
count as often as they occur; an empty table gives empty results; other columns are kept and may have any name.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from affinis.llm.common import fresh, words
from affinis.session import pin, unpin

SYMBOLS = "#*$%&|<>"
WINDOW = 5
BASE_RULES = ("few_words", "repeated_words")
STATS = ("n_words", "word_chars", "n_symbols", "n_lines", "n_dup_lines", "n_repeat_words")


@dataclass(frozen=True)
class Limits:
    """What the rules allow. Shares are in percent."""

    min_words: int = 10
    repeat_words: int = 20
    symbols_per_word: int = 10
    dup_lines: int = 50
    host_rate: float = 0.5


def _repeat_words(grams: Column) -> Column:
    """Words covered by windows that occur twice or more, from (window, position) pairs in sorted order."""
    seen = F.transform(
        grams,
        lambda g, j: F.when((g["gram"] == F.get(grams, j - 1)["gram"]) | (g["gram"] == F.get(grams, j + 1)["gram"]), g["at"]),
    )
    places = F.sort_array(F.filter(seen, lambda p: p.isNotNull()))
    start = F.struct(F.lit(0).cast("long").alias("covered"), F.lit(-WINDOW).alias("last"))
    return F.aggregate(
        places,
        start,
        lambda acc, p: F.struct(
            (acc["covered"] + F.least(F.lit(WINDOW), p - acc["last"])).alias("covered"), p.alias("last")
        ),
        lambda acc: acc["covered"],
    )


def with_stats(df: DataFrame, text_col: str, into: str) -> DataFrame:
    """Add a struct column `into` with STATS of the whole text."""
    ws, hashes = fresh("ws", df), fresh("hashes", df)
    text = F.coalesce(F.col(text_col), F.lit(""))
    w = F.col(ws)
    n = F.size(w)
    at = F.sequence(F.lit(1), n - (WINDOW - 1))
    grams = F.sort_array(
        F.transform(
            at, lambda i: F.struct(F.concat_ws(" ", F.slice(w, i, WINDOW)).alias("gram"), (i - 1).alias("at"))
        )
    )
    lines = F.filter(F.split(text, "\n"), lambda x: F.btrim(x, F.lit(" \t\n\x0b\f\r")) != "")
    out = df.withColumn(ws, words(F.col(text_col)))
    # Equal windows have equal hashes: only texts with an equal pair of hashes need their windows compared.
    out = out.withColumn(
        hashes,
        F.when(
            n >= WINDOW, F.transform(at, lambda i: F.xxhash64(*[F.element_at(w, i + k) for k in range(WINDOW)]))
        ).otherwise(F.array().cast("array<long>")),
    )
    repeats = F.size(F.array_distinct(hashes)) < F.size(hashes)
    line_list, gram_list = fresh("line_list", df), fresh("gram_list", df)
    # Columns of their own: inlined in a lambda they would be built again for each element.
    out = out.withColumns(
        {line_list: lines, gram_list: F.when(repeats, grams).otherwise(F.array().cast("array<struct<gram:string,at:int>>"))}
    )
    stats = F.struct(
        n.cast("long").alias("n_words"),
        F.coalesce(F.length(F.array_join(w, "")), F.lit(0)).cast("long").alias("word_chars"),
        (F.length(text) - F.length(F.translate(text, SYMBOLS, ""))).cast("long").alias("n_symbols"),
        F.size(line_list).cast("long").alias("n_lines"),
        (F.size(line_list) - F.size(F.array_distinct(line_list))).cast("long").alias("n_dup_lines"),
        F.coalesce(_repeat_words(F.col(gram_list)), F.lit(0)).cast("long").alias("n_repeat_words"),
        # Not deterministic to the optimizer, so no filter on the statistics moves below the columns above,
        # where it would build their arrays again for each element.
        F.spark_partition_id().alias("part"),
    )
    return out.withColumn(into, stats).drop(ws, hashes, line_list, gram_list)


def rules(stats: str, limits: Limits = Limits()) -> dict[str, Column]:
    """Rule name -> true where the document fails it."""
    s = F.col(stats)
    return {
        "few_words": s["n_words"] < limits.min_words,
        "repeated_words": 100 * s["n_repeat_words"] > limits.repeat_words * s["n_words"],
        "symbols": 100 * s["n_symbols"] > limits.symbols_per_word * s["n_words"],
        "dup_lines": 100 * s["n_dup_lines"] > limits.dup_lines * s["n_lines"],
    }


def _any(columns: list[Column]) -> Column:
    out = columns[0]
    for c in columns[1:]:
        out = out | c
    return out


def host_verdicts(measured: DataFrame, host_col: str, stats: str, limits: Limits = Limits()) -> DataFrame:
    """host, n_docs, failure count and shrunk rate of each rule and of `any`, host_rejected; one row a host.

    The prior of a rule is the beta distribution with the mean and variance of the hosts' rates (method of
    moments); three numbers a rule reach the driver. With no variance between hosts all get the common rate.
    """
    failed = rules(stats, limits)
    failed["any"] = _any(list(failed.values()))
    counts = pin(
        measured.groupBy(F.col(host_col).alias("host")).agg(
            F.count("*").alias("n_docs"), *[F.sum(c.cast("long")).alias(f"n_{r}") for r, c in failed.items()]
        )
    )
    rate = {r: F.col(f"n_{r}") / F.col("n_docs") for r in failed}
    prior = counts.agg(
        *[F.avg(c).alias(f"mean_{r}") for r, c in rate.items()], *[F.var_pop(c).alias(f"var_{r}") for r, c in rate.items()]
    ).first()
    shrunk = []
    for r in failed:
        mean, var = prior[f"mean_{r}"] or 0.0, prior[f"var_{r}"] or 0.0
        strength = min(max(mean * (1 - mean) / var - 1, 1.0), 1e6) if var > 0 else 1e6
        shrunk.append(((F.col(f"n_{r}") + F.lit(mean * strength)) / (F.col("n_docs") + F.lit(strength))).alias(f"rate_{r}"))
    out = counts.select("*", *shrunk)
    return out.withColumn("host_rejected", F.col("rate_any") > limits.host_rate)


def assess(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", host_col: str = "source", limits: Limits = Limits()
) -> DataFrame:
    """Per document: id, STATS, base_failed, failed_rules, host_rate, host_rejected, kept.

    The measured documents (numbers only) are written once; host verdicts are joined back by host. Spark
    broadcasts them only when their written size is below its limit, else it splits hot hosts in the sort join.
    """
    slim = docs.select(F.col(id_col).alias("id"), F.col(host_col).alias("host"), F.col(text_col).alias("text"))
    measured = pin(with_stats(slim, "text", "stats").select("id", "host", "stats"))
    verdicts = host_verdicts(measured, "host", "stats", limits)
    verdicts = pin(verdicts.select(F.col("host").alias("of"), F.col("rate_any").alias("host_rate"), "host_rejected"))
    failed = rules("stats", limits)
    names = F.filter(F.array(*[F.when(c, F.lit(r)) for r, c in failed.items()]), lambda r: r.isNotNull())
    joined = measured.join(verdicts, F.col("host").eqNullSafe(F.col("of")))
    return joined.select(
        F.col("id").alias(id_col),
        *[F.col("stats")[s].alias(s) for s in STATS],
        _any([failed[r] for r in BASE_RULES]).alias("base_failed"),
        names.alias("failed_rules"),
        "host_rate",
        "host_rejected",
        (~(_any([failed[r] for r in (*BASE_RULES, "symbols")]) | F.col("host_rejected"))).alias("kept"),
    )


def keep_good(
    docs: DataFrame, text_col: str = "text", host_col: str = "source", limits: Limits = Limits()
) -> DataFrame:
    """The documents that pass, with their columns as they are.

    Texts are measured again instead of being shuffled to the verdicts: reading costs less than moving them.
    """
    stats, of, bad = fresh("stats", docs), fresh("of", docs), fresh("host_rejected", docs)
    slim = docs.select(F.col(host_col).alias("host"), F.col(text_col).alias("text"))
    measured = pin(with_stats(slim, "text", "stats").select("host", "stats"))
    verdicts = host_verdicts(measured, "host", "stats", limits)
    verdicts = pin(verdicts.where("host_rejected").select(F.col("host").alias(of), F.lit(True).alias(bad)))
    unpin(measured)
    failed = rules(stats, limits)
    good = with_stats(docs, text_col, stats).where(~_any([failed[r] for r in (*BASE_RULES, "symbols")]))
    joined = good.drop(stats).join(verdicts, F.col(host_col).eqNullSafe(F.col(of)), "left_anti")
    return joined.select(docs.columns)
