"""Quality rules at two levels: per document, and per host over all its documents.

DataFrame functions only. A document's base rules give counts and a verdict; the
failure rate of each host is drawn towards the rate of all hosts by a beta prior
fitted to them, and the hosts above a rate lose all their documents.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cohortloom.llm.common import GAP, written

BLANKS = " \t\n\x0b\x0c\r"


@dataclass(frozen=True)
class HostRules:
    """``min_words``: fewer fail; ``max_repeat_pct``: a larger share of words in
    repeated windows fails; ``max_rate``: a host with a larger drawn-in failure
    rate is rejected; ``least_weight``: the prior counts as so many documents at least."""

    min_words: int = 10
    max_repeat_pct: int = 20
    max_rate: float = 0.5
    least_weight: float = 10.0


def words_of(text: Column) -> Column:
    trimmed = F.btrim(text, F.lit(BLANKS))
    return F.when(F.length(trimmed) > 0, F.split(trimmed, f"[{GAP}]+"))


def base_counts(docs: DataFrame, text: str = "text") -> DataFrame:
    """Adds n_words, word_chars, n_symbols, n_dup_lines and n_repeat_words.

    Windows are compared by 64-bit hashes inside one text. A null or empty text
    has zeros. Only texts with a repeated window are sorted.
    """
    body = F.coalesce(F.col(text), F.lit(""))
    lines = F.filter(F.split(body, "\n"), lambda x: F.length(F.btrim(x, F.lit(BLANKS))) > 0)
    step = docs.withColumns({
        "_words": F.coalesce(words_of(body), F.array().cast("array<string>")),
        "_lines": lines,
        "n_symbols": F.regexp_count(body, F.lit("[#*$%&|<>]")).cast("long"),
    })
    words = F.col("_words")
    windows = F.transform(words, lambda x, i: F.when(
        i + 4 < F.size(words),
        F.xxhash64(x, *(F.get(words, i + k) for k in range(1, 5)))))
    step = step.withColumns({
        "n_words": F.size("_words").cast("long"),
        "word_chars": F.char_length(F.array_join("_words", "")).cast("long"),
        "n_dup_lines": (F.size("_lines") - F.size(F.array_distinct("_lines"))).cast("long"),
        "_windows": F.when(F.size("_words") >= 5, windows),
    }).drop("_words", "_lines")
    # The last four places have no window; they are null, one value if distinct.
    repeats = F.size(F.array_distinct("_windows")) < F.size("_windows") - 3
    step = step.withColumn("_windows", F.when(repeats, F.col("_windows")))
    # Equal windows become neighbours in the order of (hash, place).
    placed = F.sort_array(F.filter(
        F.transform("_windows", lambda x, i: F.struct(x.alias("w"), i.alias("i"))),
        lambda x: x["w"].isNotNull()))
    step = step.withColumn("_placed", placed).drop("_windows")
    all_placed = F.col("_placed")
    twice = F.filter(all_placed, lambda x, i: (
        (x["w"] == F.get(all_placed, i - 1)["w"]).eqNullSafe(True)
        | (x["w"] == F.get(all_placed, i + 1)["w"]).eqNullSafe(True)))
    step = step.withColumn("_at", F.sort_array(F.transform(twice, lambda x: x["i"])))
    step = step.drop("_placed")
    at = F.col("_at")
    covered = F.transform(at, lambda x, i: F.least(
        F.lit(5), F.coalesce(F.get(at, i + 1) - x, F.lit(5))))
    total = F.aggregate(covered, F.lit(0), lambda a, x: a + x)
    return step.withColumn("n_repeat_words", F.coalesce(total, F.lit(0)).cast("long")).drop("_at")


def base_failed(rules: HostRules) -> Column:
    return (F.col("n_words") < rules.min_words) | (
        100 * F.col("n_repeat_words") > rules.max_repeat_pct * F.col("n_words"))


def host_verdicts(judged: DataFrame, rules: HostRules, host: str = "source") -> DataFrame:
    """One row per host: n_docs, n_failed, host_rate (drawn in), host_kept.

    The prior's mean is the share of failures in all documents. Its weight follows
    the method of moments: p(1-p)/v - 1, where v is the spread of the hosts' rates
    beyond what chance gives, and never less than ``least_weight``; hosts that do
    not differ beyond chance all get the mean. All of it is one plan; null is a
    host of its own.
    """
    hosts = judged.groupBy(host).agg(
        F.count(F.lit(1)).alias("n_docs"),
        F.sum(F.col("base_failed").cast("long")).alias("n_failed"))
    p = F.try_divide(F.sum("n_failed"), F.sum("n_docs"))
    sums = hosts.agg(
        F.count(F.lit(1)).alias("_hosts"), F.sum("n_docs").alias("_docs"), p.alias("_p"),
        F.sum(F.col("n_failed") * F.col("n_failed") / F.col("n_docs")).alias("_squares"),
        F.sum(F.col("n_docs").cast("double") * F.col("n_docs")).alias("_sizes"))
    p, hosts_n, docs_n = F.col("_p"), F.col("_hosts"), F.col("_docs")
    within = p * (1 - p)
    between = F.try_divide(
        F.col("_squares") - docs_n * p * p - (hosts_n - 1) * within,
        docs_n - F.try_divide(F.col("_sizes"), docs_n))
    weight = F.when(between > 0, F.greatest(within / between - 1, F.lit(rules.least_weight)))
    prior = sums.select(F.struct(p, weight.alias("_weight"))).scalar()
    p, weight = F.col("_prior._p"), F.col("_prior._weight")
    rate = F.when(weight.isNull(), p).otherwise(
        (F.col("n_failed") + weight * p) / (F.col("n_docs") + weight))
    return hosts.withColumn("_prior", prior).select(
        host, "n_docs", "n_failed", rate.alias("host_rate"),
        (rate <= rules.max_rate).alias("host_kept"))


def judge_hosts(docs: DataFrame, rules: HostRules | None = None, *, host: str = "source",
                text: str = "text", carry: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """Per row of ``docs``: the carried columns, host, base counts, verdicts, kept.

    Null and empty texts fail (no words). Repeated rows are judged each. An empty
    table gives no rows. Other columns, whatever their names, are not read. A very long
    text is judged whole in its row, as arrays of its words and windows. The counts are stored once: the hosts and the documents are both taken from there.
    """
    rules = rules or HostRules()
    narrow = docs.select(*(F.col(c).alias(f"in_{c}") for c in carry),
                         F.col(host).alias("_host"), F.col(text).alias("_text"))
    counts = written(
        base_counts(narrow, "_text").drop("_text").withColumn("base_failed", base_failed(rules)),
        "host-rules", codec="zstd")
    hosts = host_verdicts(counts, rules, "_host").withColumnRenamed("_host", "_at_host")
    joined = counts.join(hosts, F.col("_host").eqNullSafe(F.col("_at_host")), "left")
    return joined.select(
        *(F.col(f"in_{c}").alias(c) for c in carry), F.col("_host").alias("host"),
        "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed",
        "host_rate", (~F.col("base_failed") & F.col("host_kept")).alias("kept"))
