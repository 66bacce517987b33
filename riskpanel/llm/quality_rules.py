"""Quality rules whose cutoffs come from labelled documents with a bound on false rejections.

For every stratum and rule a fixed list of cutoffs, from lenient to strict, is tested in
order. A cutoff passes if the exact binomial tail of its false rejections among the labelled
good documents shows, at the corrected level, that the true rate is within the rule's share
of the allowed rate. Testing stops at the first failure, so the list needs no correction of
its own (fixed-sequence testing); strata and rules are corrected by Bonferroni. A stratum
with too few labels for any proof keeps every document that passes the base rules.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from riskpanel.llm.common import SPACE, stored, words

#: Each rule rejects a document if 1000 * first > cutoff * second.
MEASURES = {
    "symbols": ("n_symbols", "n_words"),
    "repeats": ("n_repeat_words", "n_words"),
    "lines": ("n_dup_lines", "n_lines"),
    "length": ("word_chars", "n_words"),
}


@dataclass(frozen=True)
class RuleConfig:
    """``alpha``: false rejections allowed per stratum over all rules. ``delta``: chance that any stratum exceeds it."""

    alpha: float = 0.02
    delta: float = 0.05
    languages: tuple[str, ...] = ("en", "de", "fr", "es")  # a stratum each; all others, null too, form one more
    cutoffs: dict[str, tuple[int, ...]] = field(
        default_factory=lambda: {
            "symbols": (1000, 800, 600, 500, 400, 300, 200, 150, 100, 70, 50),
            "repeats": (450, 400, 350, 300, 250, 200, 150, 100),
            "lines": (800, 600, 500, 400, 300, 200, 100),
            "length": (15000, 12000, 11000, 10000, 9000, 8500, 8000),
        }
    )

    @property
    def level(self) -> float:
        return self.delta / (len(self.cutoffs) * (len(self.languages) + 1))

    @property
    def rate(self) -> float:
        return self.alpha / len(self.cutoffs)


def with_statistics(docs: DataFrame, text: str = "text") -> DataFrame:
    """``docs`` with the counts that the rules use, over whole texts; a null text has no words, lines or symbols.

    A window is known by the 64-bit hash of its three words, compared within one text only.
    """
    body = F.coalesce(F.col(text), F.lit(""))
    step = docs.withColumns({"_words": words(F.col(text)), "_lines": F.split(body, "\n")}).withColumns(
        {
            "n_words": F.size("_words").cast("long"),
            "word_chars": F.length(F.array_join("_words", "")).cast("long"),
            "n_symbols": F.regexp_count(body, F.lit("[#*$%&|<>]")).cast("long"),
            "_lines": F.filter("_lines", lambda line: line.rlike(r"[^\x20\x09-\x0D]")),
            "_at": F.expr("CASE WHEN size(_words) > 2 THEN sequence(0, size(_words) - 3) ELSE array() END"),
        }
    )
    step = step.withColumns(
        {
            "n_lines": F.size("_lines").cast("long"),
            "n_dup_lines": (F.size("_lines") - F.size(F.array_distinct("_lines"))).cast("long"),
            "_windows": F.expr(
                "sort_array(transform(_at, i -> struct(xxhash64(_words[i], _words[i + 1], _words[i + 2]) AS h, i AS i)))"
            ),
        }
    )
    # equal windows are neighbours now; a window found again covers three words, less what the one before it covered
    step = step.withColumn(
        "_found",
        F.expr(
            "sort_array(transform(filter(_windows, (w, k) -> coalesce(get(_windows, k - 1).h = w.h, false) "
            "OR coalesce(get(_windows, k + 1).h = w.h, false)), w -> w.i))"
        ),
    )
    covered = (
        "aggregate(_found, struct(0L AS total, -3 AS last), "
        "(a, i) -> struct(a.total + least(3, i - a.last) AS total, i AS last), a -> a.total)"
    )
    return step.withColumn("n_repeat_words", F.expr(covered)).drop("_words", "_lines", "_at", "_windows", "_found")


def base_failed() -> Column:
    return (F.col("n_words") < 50) | (100 * F.col("n_repeat_words") > 50 * F.col("n_words"))


def stratum(config: RuleConfig, lang: str = "lang") -> Column:
    return F.when(F.col(lang).isin(*config.languages), F.col(lang)).otherwise("other")


def rejects(rule: str, cutoff: Column) -> Column:
    """Whether the rule rejects at this cutoff; never null, so that a missing cutoff rejects nothing."""
    first, second = MEASURES[rule]
    return F.coalesce(1000 * F.col(first) > cutoff * F.col(second), F.lit(False))


def binomial_tail(k: str, n: str, rate: float) -> Column:
    """P(X <= k) for X ~ Binomial(n, rate), summed term by term in logarithms; 1 where k is above the mean."""
    terms = (
        f"aggregate(sequence(1L, {k}), struct({n} * ln(1 - {rate}D) AS term, {n} * ln(1 - {rate}D) AS total), "
        f"(a, i) -> named_struct('term', a.term + ln(({n} - i + 1) / i) + ln({rate}D / (1 - {rate}D)), 'total', "
        f"greatest(a.total, a.term + ln(({n} - i + 1) / i) + ln({rate}D / (1 - {rate}D))) + ln(1 + exp(-abs("
        f"a.total - (a.term + ln(({n} - i + 1) / i) + ln({rate}D / (1 - {rate}D))))))), a -> exp(a.total))"
    )
    return F.expr(f"CASE WHEN {k} > {rate}D * {n} THEN 1D WHEN {k} = 0 THEN exp({n} * ln(1 - {rate}D)) ELSE {terms} END")


def tested_cutoffs(good: DataFrame, config: RuleConfig) -> DataFrame:
    """(stratum, rule, step, cutoff, n, k, tail, passes) over the statistics of labelled good documents.

    One aggregation with a sum per cutoff; at most strata x cutoffs rows come out.
    """
    parts = None
    for rule, cutoffs in config.cutoffs.items():
        counted = good.groupBy("stratum").agg(
            F.count(F.lit(1)).alias("n"),
            F.array(*[F.sum(rejects(rule, F.lit(c)).cast("long")) for c in cutoffs]).alias("ks"),
        )
        part = counted.select(
            "stratum", F.lit(rule).alias("rule"), "n", F.posexplode("ks").alias("step", "k"),
            F.array(*map(F.lit, cutoffs)).alias("cutoffs"),
        ).select("stratum", "rule", "step", F.expr("cutoffs[step]").alias("cutoff"), "n", "k")
        parts = part if parts is None else parts.unionByName(part)
    return parts.withColumn("tail", binomial_tail("k", "n", config.rate)).withColumn(
        "passes", F.col("tail") <= config.level
    )


def select_cutoffs(good: DataFrame, config: RuleConfig) -> DataFrame:
    """One row per stratum with a column per rule: the strictest cutoff before the first failure, else null."""
    tested = tested_cutoffs(good, config)
    ordered = tested.groupBy("stratum", "rule").agg(
        F.array_sort(F.collect_list(F.struct("step", "cutoff", "passes"))).alias("steps")  # one per cutoff of the rule
    )
    chosen = ordered.withColumn(
        "cutoff",
        F.expr(
            "aggregate(steps, struct(true AS open, CAST(NULL AS INT) AS cutoff), (a, s) -> "
            "struct(a.open AND s.passes AS open, CASE WHEN a.open AND s.passes THEN s.cutoff ELSE a.cutoff END AS cutoff), "
            "a -> a.cutoff)"
        ),
    )
    per_rule = [F.max(F.when(F.col("rule") == r, F.col("cutoff"))).alias(f"cut_{r}") for r in config.cutoffs]
    return chosen.groupBy("stratum").agg(*per_rule)


def judge(measured: DataFrame, labels: DataFrame, config: RuleConfig = RuleConfig()) -> DataFrame:
    """``measured`` (stored: doc_id, lang and the statistics, with any other columns) with base_failed and kept.

    A document counts as good if every label it has says so; null ids and null labels count for nothing.
    Repeated rows are judged each. The cutoff table has at most one row per configured stratum, so it is broadcast.
    """
    used = dict.fromkeys(column for measure in MEASURES.values() for column in measure)
    narrow = measured.select("doc_id", stratum(config).alias("stratum"), *used)
    agreed = (
        labels.select("doc_id", "quality").dropna().groupBy("doc_id").agg(F.min("quality").alias("quality"))
        .filter("quality = 1")
    )
    good = narrow.filter(~base_failed()).join(agreed, "doc_id", "left_semi")
    cutoffs = select_cutoffs(good, config)
    joined = measured.withColumn("stratum", stratum(config)).join(F.broadcast(cutoffs), "stratum", "left")
    rejected = F.lit(False)
    for rule in config.cutoffs:
        rejected = rejected | rejects(rule, F.col(f"cut_{rule}"))
    return joined.withColumn("base_failed", base_failed()).withColumn("kept", ~F.col("base_failed") & ~rejected)


def quality_rules(docs: DataFrame, labels: DataFrame, config: RuleConfig = RuleConfig()) -> DataFrame:
    """One row per document: doc_id, the statistics, base_failed and kept.

    Null text, empty text: no words, so base_failed. Null lang: stratum "other". Repeated rows stay. Empty
    tables: no rows, or no cutoffs. Only doc_id, text and lang are read, so other columns cannot clash.
    """
    measured = stored(with_statistics(docs.select("doc_id", "text", "lang")).drop("text"), "statistics")
    counts = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]
    return judge(measured, labels, config).select("doc_id", *counts, "n_lines", "stratum", "base_failed", "kept")


def keep_documents(docs: DataFrame, labels: DataFrame, config: RuleConfig = RuleConfig()) -> DataFrame:
    """The kept rows of ``docs`` with exactly their columns. The rows are stored with their statistics once."""
    rows = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("doc"), "doc_id", "text", "lang")
    measured = stored(with_statistics(rows).drop("text"), "measured")
    return judge(measured, labels, config).filter("kept").select("doc.*")
