"""Quality rules: text statistics and a learned, ordered list of threshold rules.

Sequential covering: a rule is a conjunction of thresholds on the statistics. It
grows on two thirds of the labelled rows by information gain and is pruned on
the other third; rows that it covers leave, and the next rule grows. The list
becomes one conditional Spark expression. Only built-in functions run on the
documents. The learner sees a bounded sample of labelled rows (``max_rows``,
those whose ids hash lowest), the statistics and verdicts cover every document.

Null or blank text: no words, so the base rules fail it. Repeated rows give
repeated results. No labels, or none of low quality: an empty list, which keeps
all. A label without a document or with a null quality is not used; of several
labels of a document the lowest counts.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

SPACE = r"[\x20\x09-\x0D]"
BLANKS = " \t\n\x0b\x0c\r"
WINDOW = 8
COUNTS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")
#: Ratios that rules may test; a null (no words) fits no rule.
FEATURES = {
    "n_words": "cast(n_words as double)",
    "word_length": "try_divide(word_chars, n_words)",
    "symbols": "try_divide(n_symbols, n_words)",
    "dup_lines": "try_divide(n_dup_lines, n_words)",
    "repeats": "try_divide(n_repeat_words, n_words)",
    "distinct": "try_divide(n_distinct, n_words)",
    "shouts": "try_divide(n_shouts, n_words)",
    "capitals": "try_divide(n_capitals, n_words)",
}


def text_statistics(docs: DataFrame, text: str = "text", prefix: str = "") -> DataFrame:
    """``docs`` with the five counts and three more (long), computed on whole texts.

    Repeated 8-word windows are found by their hashes in one pass over the row; only
    texts that have any are sorted by hash. A text is one row throughout: no shuffle.
    """
    p = f"__{prefix}"
    t = F.col(f"{p}t")
    df = docs.withColumn(f"{p}t", F.coalesce(F.col(text).cast("string"), F.lit("")))
    df = df.withColumn(f"{p}w", F.filter(F.split(t, f"{SPACE}+"), lambda w: w != ""))
    df = df.withColumn(f"{p}h", F.transform(f"{p}w", lambda w: F.xxhash64(w)))
    w, h = F.col(f"{p}w"), F.col(f"{p}h")
    df = df.withColumn(
        f"{p}g",
        F.when(
            F.size(h) >= WINDOW,
            F.transform(F.sequence(F.lit(0), F.size(h) - WINDOW), lambda i: F.xxhash64(*(F.get(h, i + k) for k in range(WINDOW)))),
        ),
    )
    g = F.col(f"{p}g")
    df = df.withColumn(f"{p}o", F.when(F.size(F.array_distinct(g)) < F.size(g), F.array_sort(F.transform(g, lambda x, i: F.struct(x.alias("h"), i.alias("i"))))))
    o = F.col(f"{p}o")
    twice = F.filter(o, lambda x, i: (x["h"] == F.get(o, i - 1)["h"]) | (x["h"] == F.get(o, i + 1)["h"]))
    df = df.withColumn(f"{p}s", F.array_sort(F.transform(twice, lambda x: x["i"])))
    s = F.col(f"{p}s")
    steps = F.zip_with(s, F.slice(s, 2, F.greatest(F.size(s), F.lit(1))), lambda a, b: F.least(F.coalesce(b - a, F.lit(WINDOW)), F.lit(WINDOW)))
    df = df.withColumn(f"{p}l", F.filter(F.split(t, "\n"), lambda x: F.btrim(x, F.lit(BLANKS)) != ""))
    lines = F.col(f"{p}l")
    made = {
        "n_words": F.size(w),
        "word_chars": F.length(F.array_join(w, "")),
        "n_symbols": F.regexp_count(t, F.lit("[#*$%&|<>]")),
        "n_dup_lines": F.size(lines) - F.size(F.array_distinct(lines)),
        "n_repeat_words": F.coalesce(F.aggregate(steps, F.lit(0), lambda a, x: a + x), F.lit(0)),
        "n_distinct": F.size(F.array_distinct(h)),
        "n_shouts": F.regexp_count(t, F.lit("!")),
        "n_capitals": F.regexp_count(t, F.lit("[A-Z]")),
    }
    # not deterministic to the optimizer, so that no filter moves below and repeats what the columns above share
    whole = F.spark_partition_id() >= 0
    return df.withColumns({prefix + k: F.when(whole, v.cast("long")) for k, v in made.items()}).drop(*(f"{p}{x}" for x in "twhgosl"))


def base_failed(prefix: str = "") -> Column:
    n, r = F.col(f"{prefix}n_words"), F.col(f"{prefix}n_repeat_words")
    return (n < 20) | (100 * r > 30 * n)


@dataclass(frozen=True)
class Condition:
    feature: str
    above: bool
    threshold: float

    def holds(self, row: dict) -> bool:
        x = row[self.feature]
        return x is not None and (x > self.threshold if self.above else x <= self.threshold)

    def sql(self, prefix: str) -> str:
        value = FEATURES[self.feature]
        for name in (*COUNTS, "n_distinct", "n_shouts", "n_capitals"):
            value = value.replace(name, prefix + name)
        return f"({value}) {'>' if self.above else '<='} {self.threshold!r}D"


@dataclass(frozen=True)
class DecisionList:
    """Ordered rules; the first that fits rejects the document, none keeps it."""

    rules: tuple[tuple[Condition, ...], ...]

    def rule_number(self, prefix: str = "") -> Column:
        """Number of the first fitting rule from 1, null if none fits."""
        out = None
        for k, rule in enumerate(self.rules, 1):
            test = F.expr(" and ".join(c.sql(prefix) for c in rule))
            out = F.when(test, k) if out is None else out.when(test, k)
        return F.lit(None).cast("int") if out is None else out

    def __str__(self) -> str:
        return "\n".join(f"reject if {' and '.join(c.sql('') for c in r)}" for r in self.rules)


def _gain(p: int, n: int, p0: int, n0: int) -> float:
    return p * (math.log2(p / (p + n)) - math.log2(p0 / (p0 + n0))) if p else 0.0


def _best(rows: list[tuple[dict, bool]]) -> Condition | None:
    p0 = sum(y for _, y in rows)
    n0, found = len(rows) - p0, (1e-9, None)
    for f in FEATURES:
        values = sorted((x[f], y) for x, y in rows if x[f] is not None)
        p_all, n_all, p, n = sum(y for _, y in values), sum(not y for _, y in values), 0, 0
        for k, (x, y) in enumerate(values[:-1]):
            p, n = p + y, n + (not y)
            if x == values[k + 1][0]:
                continue
            cut = (x + values[k + 1][0]) / 2
            found = max(found, (_gain(p, n, p0, n0), Condition(f, False, cut)), (_gain(p_all - p, n_all - n, p0, n0), Condition(f, True, cut)), key=lambda z: z[0])
    return found[1]


def learn(rows: list[tuple[dict, bool]], max_rules: int = 12, max_conditions: int = 4, least_precision: float = 0.9, least_cover: int = 3) -> DecisionList:
    """``rows``: features and whether to reject, in an order that owes nothing to the labels."""
    grow, prune, rules = [x for i, x in enumerate(rows) if i % 3], rows[::3], []
    while len(rules) < max_rules and any(y for _, y in grow):
        rule, covered = [], grow
        while len(rule) < max_conditions and any(not y for _, y in covered) and (c := _best(covered)):
            rule.append(c)
            covered = [r for r in covered if c.holds(r[0])]
        worth = []
        for k in range(1, len(rule) + 1):
            hit = [y for x, y in prune if all(c.holds(x) for c in rule[:k])]
            worth.append(((2 * sum(hit) - len(hit)) / len(hit) if hit else -1.0, -k))
        if not rule:
            break
        rule = tuple(rule[: -max(worth)[1]])
        fits = lambda x: all(c.holds(x) for c in rule)  # noqa: B023, E731
        both = [y for x, y in (*grow, *prune) if fits(x)]
        if len(both) < least_cover or sum(both) < least_precision * len(both):
            break
        rules.append(rule)
        grow, prune = [r for r in grow if not fits(r[0])], [r for r in prune if not fits(r[0])]
    return DecisionList(tuple(rules))


def fit(docs: DataFrame, labels: DataFrame, max_rows: int = 4000, **learner) -> DecisionList:
    """Learn from at most ``max_rows`` labelled documents; those rows alone come to the driver."""
    picked = (
        labels.where("doc_id is not null and quality is not null")
        .groupBy(F.col("doc_id").alias("__id"))
        .agg(F.min("quality").alias("__quality"))
        .orderBy(F.xxhash64("__id"), "__id")
        .limit(max_rows)
    )
    known = docs.join(F.broadcast(picked), F.col("doc_id") == F.col("__id")).select("__id", "__quality", F.col("text").alias("__text"))
    stats = text_statistics(known, "__text")
    rows = stats.select("__id", "__quality", *(F.expr(v).alias(k) for k, v in FEATURES.items()))
    got = rows.orderBy(F.xxhash64(F.col("__id"), F.lit(1)), "__id", *FEATURES).limit(max_rows).collect()
    return learn([(r.asDict(), r["__quality"] == 0) for r in got], **learner)


def judge(docs: DataFrame, rules: DecisionList, prefix: str = "") -> DataFrame:
    """``docs`` with the statistics, ``base_failed``, ``rule`` and ``kept``, each name prefixed."""
    df = text_statistics(docs, "text", prefix).withColumn(f"{prefix}base_failed", base_failed(prefix)).withColumn(f"{prefix}rule", rules.rule_number(prefix))
    return df.withColumn(f"{prefix}kept", ~F.col(f"{prefix}base_failed") & F.col(f"{prefix}rule").isNull())
