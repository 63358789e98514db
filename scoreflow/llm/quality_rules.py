"""Quality rules: text statistics and a learned decision list.

Native: only DataFrame functions touch the corpus. The list is learned on the
driver from a bounded sample of labelled statistics by sequential covering:
each rule is grown as a conjunction of thresholds on two thirds of the sample
and pruned on the rest, the documents it covers are removed, and the next rule
is grown on what is left. The learned list is one ordered
`when(...).when(...).otherwise(...)` expression.

Defined results: a null text has no words (n_words 0) and fails the base rule;
every input row gives one output row, repeated rows included; a null doc_id is
carried; extra input columns are ignored; empty labels give an empty list,
which keeps whatever passes the base rule.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from scoreflow.llm.common import SPACES, split_words, text_or_empty

# Documented bound of the labelled sample the list is learned from.
SAMPLE_ROWS = 12_000
REPEAT_WINDOW = 5

FEATURES = ("symbol_rate", "dup_line_rate", "repeat_rate", "mean_word", "upper_rate", "pipe_rate", "shout_rate", "n_words")


def text_statistics(docs: DataFrame) -> DataFrame:
    """One row per document with the base counts and the extra counts the
    learned rules use. Windows are compared by a 64-bit hash inside one text."""
    w = REPEAT_WINDOW
    base = docs.select("doc_id", text_or_empty().alias("text"))
    base = base.select(
        "doc_id",
        split_words(F.col("text"), SPACES).alias("words"),
        F.filter(F.split("text", "\n"), lambda line: line.rlike(r"[^\x20\x09-\x0D]")).alias("lines"),
        F.length("text").alias("n_chars_text"),
        F.length(F.regexp_replace("text", r"[#*$%&|<>]", "")).alias("no_symbols"),
        F.length(F.regexp_replace("text", r"[A-Z]", "")).alias("no_upper"),
        F.length(F.regexp_replace("text", r"\|", "")).alias("no_pipes"),
        F.length(F.regexp_replace("text", r"!", "")).alias("no_shouts"),
    )
    hashes = F.when(
        F.size("words") >= w,
        F.transform(
            F.sequence(F.lit(0), F.size("words") - w),
            lambda i: F.xxhash64(*[F.get(F.col("words"), i + j) for j in range(w)]),
        ),
    ).otherwise(F.array().cast("array<bigint>"))
    base = base.withColumn("hashes", hashes)
    repeats = F.size(F.array_distinct("hashes")) < F.size("hashes")
    ordered = F.when(repeats, F.array_sort(F.transform("hashes", lambda h, i: F.struct(h.alias("h"), i.alias("i")))))
    base = base.select(
        "doc_id",
        F.size("words").cast("long").alias("n_words"),
        F.length(F.array_join("words", "")).cast("long").alias("word_chars"),
        (F.col("n_chars_text") - F.col("no_symbols")).cast("long").alias("n_symbols"),
        F.size("lines").cast("long").alias("n_lines"),
        (F.size("lines") - F.size(F.array_distinct("lines"))).cast("long").alias("n_dup_lines"),
        (F.col("n_chars_text") - F.col("no_upper")).cast("long").alias("n_upper"),
        (F.col("n_chars_text") - F.col("no_pipes")).cast("long").alias("n_pipes"),
        (F.col("n_chars_text") - F.col("no_shouts")).cast("long").alias("n_shouts"),
        ordered.alias("ordered"),
    )
    near = lambda i: F.get(F.col("ordered"), i).getField("h")
    starts = F.transform(
        F.filter("ordered", lambda e, i: (near(i - 1) == e["h"]) | (near(i + 1) == e["h"])), lambda e: e["i"]
    )
    base = base.withColumn("starts", F.array_sort(starts)).drop("ordered")
    covered = F.aggregate(
        "starts",
        F.struct(F.lit(-w).alias("last"), F.lit(0).alias("n")),
        lambda acc, x: F.struct(x.alias("last"), (acc["n"] + F.least(F.lit(w), x - acc["last"])).alias("n")),
        lambda acc: acc["n"],
    )
    return base.withColumn("n_repeat_words", F.coalesce(covered, F.lit(0)).cast("long")).drop("starts")


def with_features(stats: DataFrame) -> DataFrame:
    def rate(top: str, below: str) -> Column:
        return F.when(F.col(below) > 0, F.col(top) / F.col(below)).otherwise(F.lit(0.0))

    return stats.withColumns(
        {
            "symbol_rate": rate("n_symbols", "n_words"),
            "dup_line_rate": rate("n_dup_lines", "n_lines"),
            "repeat_rate": rate("n_repeat_words", "n_words"),
            "mean_word": rate("word_chars", "n_words"),
            "upper_rate": rate("n_upper", "word_chars"),
            "pipe_rate": rate("n_pipes", "n_words"),
            "shout_rate": rate("n_shouts", "n_words"),
        }
    )


@dataclass(frozen=True)
class Condition:
    feature: str
    above: bool
    threshold: float

    def holds(self, row: dict) -> bool:
        return row[self.feature] >= self.threshold if self.above else row[self.feature] < self.threshold

    def column(self) -> Column:
        c = F.col(self.feature).cast("double")
        return c >= F.lit(self.threshold) if self.above else c < F.lit(self.threshold)


@dataclass(frozen=True)
class Rule:
    conditions: tuple[Condition, ...]
    precision: float
    covered: int

    def text(self) -> str:
        return " and ".join(f"{c.feature} {'>=' if c.above else '<'} {c.threshold:g}" for c in self.conditions)


def _foil_gain(p0: int, n0: int, p1: int, n1: int) -> float:
    if not p1:
        return 0.0
    return p1 * (math.log2(p1 / (p1 + n1)) - math.log2(p0 / (p0 + n0)))


def _counts(rows: list[dict], conditions) -> tuple[int, int]:
    hit = [r["bad"] for r in rows if all(c.holds(r) for c in conditions)]
    return sum(hit), len(hit) - sum(hit)


def _candidates(rows: list[dict], feature: str, bins: int) -> list[float]:
    values = sorted({r[feature] for r in rows})
    if len(values) <= bins:
        return values[1:]
    return sorted({values[round(k * (len(values) - 1) / bins)] for k in range(1, bins + 1)})


def _grow(rows: list[dict], features, bins: int, max_conditions: int) -> list[Condition]:
    conditions: list[Condition] = []
    live = rows
    while len(conditions) < max_conditions:
        p0 = sum(r["bad"] for r in live)
        n0 = len(live) - p0
        if not p0 or not n0:
            break
        best, best_gain = None, 1e-9
        for f in features:
            cuts = _candidates(live, f, bins)
            ordered = sorted(((r[f], r["bad"]) for r in live), reverse=True)
            at, p_above, n_above = 0, 0, 0
            for cut in reversed(cuts):
                while at < len(ordered) and ordered[at][0] >= cut:
                    p_above += ordered[at][1]
                    n_above += 1 - ordered[at][1]
                    at += 1
                for above, p1, n1 in ((True, p_above, n_above), (False, p0 - p_above, n0 - n_above)):
                    gain = _foil_gain(p0, n0, p1, n1)
                    if gain > best_gain:
                        best, best_gain = Condition(f, above, float(cut)), gain
        if best is None:
            break
        conditions.append(best)
        live = [r for r in live if best.holds(r)]
    return conditions


def _prune(conditions: list[Condition], rows: list[dict]) -> list[Condition]:
    """Drop final conditions while (p - n) / (p + n) on the pruning rows does not fall."""

    def worth(cs) -> float:
        p, n = _counts(rows, cs)
        return (p - n) / (p + n) if p + n else -1.0

    kept = list(conditions)
    while len(kept) > 1 and worth(kept[:-1]) >= worth(kept):
        kept.pop()
    return kept


def learn_decision_list(
    rows: list[dict],
    features: tuple[str, ...] = FEATURES,
    *,
    max_rules: int = 8,
    max_conditions: int = 3,
    bins: int = 32,
    min_precision: float = 0.9,
    min_covered: int = 4,
) -> list[Rule]:
    """Ordered rules for bad documents from rows with the features and `bad`
    (1 or 0). A rule stays if it covers at least `min_covered` bad rows of
    the whole remainder at `min_precision` or better."""
    left = list(rows)
    rules: list[Rule] = []
    while len(rules) < max_rules and any(r["bad"] for r in left):
        grow = [r for i, r in enumerate(left) if i % 3]
        hold = [r for i, r in enumerate(left) if i % 3 == 0]
        conditions = _prune(_grow(grow, features, bins, max_conditions), hold)
        if not conditions:
            break
        p, n = _counts(left, conditions)
        if p < min_covered or p / (p + n) < min_precision:
            break
        rules.append(Rule(tuple(conditions), p / (p + n), p + n))
        left = [r for r in left if not all(c.holds(r) for c in conditions)]
    return rules


def labelled_sample(docs: DataFrame, labels: DataFrame, rows: int = SAMPLE_ROWS) -> list[dict]:
    """At most `rows` labelled documents with their statistics: those with the
    smallest hash of (doc_id, label), so the choice doesn't depend on layout."""
    picked = (
        labels.where(F.col("doc_id").isNotNull() & F.col("quality").isNotNull())
        .groupBy("doc_id")
        .agg(F.min("quality").alias("quality"))
        .orderBy(F.xxhash64("doc_id"), "doc_id")
        .limit(rows)
    )
    joined = docs.select("doc_id", "text").join(F.broadcast(picked.select("doc_id")), "doc_id")
    stats = with_features(text_statistics(joined)).select("doc_id", *FEATURES)
    stats = stats.join(F.broadcast(picked), "doc_id").orderBy("doc_id", *FEATURES)
    return [
        {**{f: float(r[f]) for f in FEATURES}, "bad": int(r["quality"] == 0)} for r in stats.limit(2 * rows).toLocalIterator()
    ]


def verdict_column(rules: list[Rule]) -> Column:
    """1-based number of the first rule that holds, else 0."""
    out = None
    for i, rule in enumerate(rules, 1):
        test = F.lit(True)
        for c in rule.conditions:
            test = test & c.column()
        out = F.when(test, F.lit(i)) if out is None else out.when(test, F.lit(i))
    return F.lit(0) if out is None else out.otherwise(F.lit(0))


def base_failed() -> Column:
    return (F.col("n_words") < 10) | (100 * F.col("n_repeat_words") > 20 * F.col("n_words"))


def apply_quality_rules(docs: DataFrame, rules: list[Rule]) -> DataFrame:
    """Statistics, the base verdict, the number of the learned rule that
    fired (0: none) and `kept`."""
    out = with_features(text_statistics(docs)).withColumn("base_failed", base_failed())
    return out.withColumn("rule", verdict_column(rules)).withColumn(
        "kept", ~F.col("base_failed") & (F.col("rule") == 0)
    )
