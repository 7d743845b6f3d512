"""Quality rules with host-level verdicts, in built-in functions throughout.

Rules are measured for each document. Failures are summed by host, and each host's rate of failure of a rule is shrunk towards
that of all hosts by a beta prior, whose mean and strength are estimated from the hosts' own rates (moments of the
beta-binomial). Verdicts take the shrunk rate less one standard deviation of its posterior, so that a few documents are no evidence.
A host at which that reaches ``REJECT`` for some rule is rejected with all its documents. One at ``STRICT`` times the rate of
all documents or more (and ``LEAST`` at least) is taken strictly: its documents that fail that rule go. At other hosts
only the two base rules decide.

Null and empty texts have no words and fail the base rule of few words. Documents without a host are judged by the base rules
alone. Rows are judged one by one, so repeated rows and ids count as often as they stand there; columns of any name are kept in ``row``. Texts of any
length are one row each, with some arrays of one entry for each word. Empty tables give no rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lakeforge.llm.common import WORD, staged

WINDOW = 5
REJECT, STRICT, LEAST = 0.5, 2.0, 0.1
#: Bytes of names of judged hosts that are broadcast at most; more are joined by shuffle.
BROADCAST = 4 << 20
#: Rules over the measures; the first two are the base rules.
RULES = {
    "few_words": "n_words < 10",
    "repeated_words": "100 * n_repeat_words > 20 * n_words",
    "symbols": "10 * n_symbols > n_words",
    "word_length": "n_words > 0 and (word_chars < 3 * n_words or word_chars > 10 * n_words)",
    "repeated_lines": "100 * n_dup_lines > 30 * n_lines",
}
BASE = ("few_words", "repeated_words")


def measured(docs: DataFrame, host: Column, keep: tuple[str, ...] | None = None) -> DataFrame:
    """``row`` (columns ``keep``, all by default), ``host``, and the measures of each text.

    Windows of words are compared by hash first; only in texts in which a hash comes twice are the windows themselves.
    """
    d = docs.select(F.struct(*(F.col(f"`{c}`") for c in keep or docs.columns)).alias("row"), host.cast("string").alias("host"), F.coalesce(F.col("text").cast("string"), F.lit("")).alias("t"))
    d = d.withColumn("w", F.regexp_extract_all("t", F.lit(WORD), F.lit(0))).withColumn("lines", F.filter(F.split("t", "\n"), lambda x: x.rlike(WORD)))
    d = d.select(
        "row", "host", "w", F.size("w").alias("n"),
        (F.length("t") - F.regexp_count("t", F.lit(r"[\x20\x09-\x0D]"))).cast("long").alias("word_chars"),
        F.regexp_count("t", F.lit("[#*$%&|<>]")).cast("long").alias("n_symbols"),
        F.size("lines").cast("long").alias("n_lines"), (F.size("lines") - F.size(F.array_distinct("lines"))).cast("long").alias("n_dup_lines"),
        F.transform("w", lambda x: F.xxhash64(x)).alias("h"))
    upto = lambda c, start, less: F.slice(c, F.lit(start), F.greatest(F.col("n") - less, F.lit(0)))
    joint = lambda a, b: F.zip_with(a, b, lambda x, y: F.xxhash64(x, y))
    d = d.withColumn("h2", joint(upto("h", 1, 1), upto("h", 2, 1)))
    d = d.withColumn("h4", joint(upto("h2", 1, 3), upto("h2", 3, 3)))
    d = d.withColumn("h5", joint(upto("h4", 1, 4), upto("h", 5, 4))).drop("h", "h2", "h4")
    twice = F.size(F.array_distinct("h5")) < F.size("h5")
    windows = F.transform(F.sequence(F.lit(1), F.col("n") - WINDOW + 1), lambda i: F.struct(F.array_join(F.slice("w", i, WINDOW), " ").alias("x"), i.alias("i")))
    d = d.withColumn("s", F.when(twice, F.array_sort(windows))).drop("h5")
    next_to = F.filter(F.zip_with("s", F.slice("s", F.lit(2), F.size("s")), lambda a, b: F.struct(a.alias("a"), b.alias("b"))), lambda p: p["a"]["x"] == p["b"]["x"])
    d = d.withColumn("at", F.array_sort(F.array_distinct(F.flatten(F.transform(next_to, lambda p: F.array(p["a"]["i"], p["b"]["i"])))))).drop("s")
    steps = F.zip_with("at", F.slice("at", F.lit(2), F.size("at")), lambda a, b: F.least(F.lit(WINDOW), b - a))
    covered = F.when(F.coalesce(F.size("at"), F.lit(0)) > 0, F.aggregate(steps, F.lit(0).cast("long"), lambda x, y: x + y)).otherwise(0)
    return d.select("row", "host", F.col("n").cast("long").alias("n_words"), "word_chars", "n_symbols", "n_lines", "n_dup_lines", covered.cast("long").alias("n_repeat_words"))


def failures(measures: DataFrame) -> DataFrame:
    """A boolean for each rule, and ``base_failed``."""
    out = measures.withColumns({r: F.expr(rule) for r, rule in RULES.items()})
    return out.withColumn("base_failed", F.expr(" or ".join(BASE)))


def by_host(failed: DataFrame) -> DataFrame:
    """``host, n`` and the number of documents that fail each rule."""
    return failed.where("host is not null").groupBy("host").agg(F.count("*").alias("n"), *(F.count_if(r).alias(r) for r in RULES))


def prior(mean: float | None, hosts: int, n: int, squares: int, spread: float) -> tuple[float, float]:
    """Mean and strength (alpha + beta) of a beta prior: ``spread`` is the sum of failed^2 / n, ``squares`` that of n^2 over hosts.

    Rates that vary no more than chance does give the greatest strength, a million documents.
    """
    mean = mean or 0.0
    inner, free = mean * (1 - mean), n - squares / n - (hosts - 1) if n else 0.0
    if hosts < 2 or inner <= 0 or free <= 0:
        return mean, 1e6
    alike = ((spread - n * mean * mean) - inner * (hosts - 1)) / (inner * free)
    return mean, 1 / min(max(alike, 1e-6), 1.0) - 1 if alike < 1 else 0.0


def verdicts(hosts: DataFrame) -> DataFrame:
    """``hosts`` with the shrunk rate of each rule as ``rate_<rule>``, what it is at least as ``least_<rule>``, ``rejected``, and ``strict_<rule>``."""
    parts = [F.count("*").alias("hosts"), F.sum("n").alias("n"), F.sum(F.col("n").cast("double") * F.col("n")).alias("squares")]
    parts += [x for r in RULES for x in (F.sum(r).alias(f"{r}_failed"), F.sum(F.col(r).cast("double") * F.col(r) / F.col("n")).alias(f"{r}_spread"))]
    all_ = hosts.agg(*parts).first()  # one row
    out, worst = hosts, F.lit(False)
    for r in RULES:
        mean, strength = prior((all_[f"{r}_failed"] or 0) / (all_["n"] or 1), all_["hosts"], all_["n"] or 0, all_["squares"] or 0, all_[f"{r}_spread"] or 0.0)
        rate = (F.col(r) + mean * strength) / (F.col("n") + strength)
        least = F.col(f"rate_{r}") - F.sqrt(F.col(f"rate_{r}") * (1 - F.col(f"rate_{r}")) / (F.col("n") + strength + 1))
        out = out.withColumn(f"rate_{r}", rate).withColumn(f"least_{r}", least).withColumn(f"strict_{r}", F.col(f"least_{r}") >= max(LEAST, STRICT * mean))
        worst = worst | (F.col(f"least_{r}") >= REJECT)
    return out.withColumn("rejected", worst)


def judged(docs: DataFrame, host: Column, keep: tuple[str, ...] | None = None) -> DataFrame:
    """``row``, ``host``, measures, ``base_failed``, ``host_rejected``, and ``kept``."""
    failed = failures(staged(measured(docs, host, keep)))
    judged_hosts = staged(verdicts(by_host(failed)).where("rejected or " + " or ".join(f"strict_{r}" for r in RULES)).select("host", "rejected", *(f"strict_{r}" for r in RULES)))
    size = judged_hosts.agg(F.coalesce(F.sum(F.octet_length("host") + 64), F.lit(0))).first()[0]
    both = failed.join(F.broadcast(judged_hosts) if size <= BROADCAST else judged_hosts, "host", "left")
    both = both.withColumn("host_rejected", F.coalesce("rejected", F.lit(False)))
    strictly = F.expr(" or ".join(f"({r} and coalesce(strict_{r}, false))" for r in RULES))
    return both.withColumn("kept", ~(F.col("base_failed") | F.col("host_rejected") | strictly)).select("row", "host", "n_words", "word_chars", "n_symbols", "n_lines", "n_dup_lines", "n_repeat_words", "base_failed", "host_rejected", "kept")
