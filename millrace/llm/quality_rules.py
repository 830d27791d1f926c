"""Quality rules: text statistics as built-in expressions, and a decision list learned from labels.

The list is grown by sequential covering. Each rule is a conjunction of thresholds, grown on two thirds of the labelled
rows by information gain, pruned on the rest, and kept while it is precise there; rows it covers leave before the next rule
is grown. The result is one ordered Spark conditional expression.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millrace.llm.common import SPACE, fresh, let

WINDOW = 8
SYMBOLS = r"[#*$%&|<>]"
FEATURES = [
    "n_words", "mean_word", "symbols_per_word", "dup_line_share", "repeat_share",
    "upper_share", "digit_share", "marks_per_word", "distinct_share", "words_per_line",
]
#: Labelled rows the rules are fitted on, at most (those with the smallest hash of their id).
SAMPLE = 20_000


def _repeat_words(words: Column) -> Column:
    """Words that lie in an 8-word window which the text has twice or more."""

    def from_windows(windows: Column) -> Column:
        last = F.size(windows) - 1

        def positions(ordered: Column) -> Column:
            def of(k: Column) -> Column:
                own = ordered[k]["h"]
                twin = (own == F.get(ordered, k - 1)["h"]) | (own == F.get(ordered, k + 1)["h"])
                return F.when(F.coalesce(twin, F.lit(False)), ordered[k]["i"])

            return F.sort_array(F.filter(F.transform(F.sequence(F.lit(0), last), of), lambda i: i.isNotNull()))

        def covered(at: Column) -> Column:
            return F.aggregate(
                F.transform(at, lambda p, j: F.least(F.lit(WINDOW), F.coalesce(F.get(at, j + 1) - p, F.lit(WINDOW)))),
                F.lit(0).cast("long"),
                lambda total, n: total + n,
            )

        ordered = F.array_sort(F.transform(windows, lambda h, i: F.struct(h.alias("h"), i.alias("i"))))
        return F.when(F.size(F.array_distinct(windows)) == F.size(windows), F.lit(0).cast("long")).otherwise(
            let(let(ordered, positions), covered)
        )

    def from_hashes(hashes: Column) -> Column:
        starts = F.sequence(F.lit(1), F.size(hashes) - WINDOW + 1)
        windows = F.transform(starts, lambda i: F.xxhash64(F.slice(hashes, i, WINDOW)))
        return F.when(F.size(hashes) > WINDOW, let(windows, from_windows)).otherwise(F.lit(0).cast("long"))

    return let(F.transform(words, lambda w: F.xxhash64(w)), from_hashes)


def statistics(text: Column) -> Column:
    """Struct of counts of a text (null counts as empty)."""

    def of(t: Column) -> Column:
        words = F.filter(F.split(t, f"{SPACE}+"), lambda w: w != "")
        lines = F.filter(F.split(t, "\n"), lambda line: line.rlike(r"[^\x20\x09-\x0D]"))

        def counted(lines: Column) -> Column:
            return F.struct(
                F.size(lines).cast("long").alias("n_lines"),
                (F.size(lines) - F.size(F.array_distinct(lines))).cast("long").alias("n_dup_lines"),
            )

        def worded(words: Column) -> Column:
            return F.struct(
                F.size(words).cast("long").alias("n_words"),
                F.char_length(F.array_join(words, "")).cast("long").alias("word_chars"),
                F.size(F.array_distinct(words)).cast("long").alias("n_distinct"),
                _repeat_words(words).alias("n_repeat_words"),
            )

        return F.struct(
            let(words, worded).alias("w"),
            let(lines, counted).alias("l"),
            F.regexp_count(t, F.lit(SYMBOLS)).cast("long").alias("n_symbols"),
            F.regexp_count(t, F.lit(r"\p{Lu}")).cast("long").alias("n_upper"),
            F.regexp_count(t, F.lit("[0-9]")).cast("long").alias("n_digits"),
            F.regexp_count(t, F.lit("[!?]")).cast("long").alias("n_marks"),
        )

    return let(F.coalesce(text, F.lit("")), of)


def features(stats: Column) -> dict[str, Column]:
    """The numbers rules may test, from a column of :func:`statistics`."""
    words = F.greatest(stats["w"]["n_words"], F.lit(1))
    chars = F.greatest(stats["w"]["word_chars"], F.lit(1))
    lines = F.greatest(stats["l"]["n_lines"], F.lit(1))
    values = {
        "n_words": stats["w"]["n_words"].cast("double"),
        "mean_word": stats["w"]["word_chars"] / words,
        "symbols_per_word": stats["n_symbols"] / words,
        "dup_line_share": stats["l"]["n_dup_lines"] / lines,
        "repeat_share": stats["w"]["n_repeat_words"] / words,
        "upper_share": stats["n_upper"] / chars,
        "digit_share": stats["n_digits"] / chars,
        "marks_per_word": stats["n_marks"] / words,
        "distinct_share": stats["w"]["n_distinct"] / words,
        "words_per_line": words / lines,
    }
    return {name: values[name].cast("double") for name in FEATURES}


@dataclass(frozen=True)
class Test:
    """``feature >= threshold`` or, where ``above`` is false, ``feature < threshold``."""

    feature: str
    above: bool
    threshold: float

    def holds(self, x: np.ndarray) -> np.ndarray:
        value = x[:, FEATURES.index(self.feature)]
        return value >= self.threshold if self.above else value < self.threshold

    def column(self, values: dict[str, Column]) -> Column:
        value, limit = values[self.feature], F.lit(float(self.threshold))
        return value >= limit if self.above else value < limit


Rule = tuple[Test, ...]


def _covers(rule: Rule, x: np.ndarray) -> np.ndarray:
    out = np.ones(len(x), bool)
    for test in rule:
        out &= test.holds(x)
    return out


def _grow(x: np.ndarray, bad: np.ndarray, cuts: list[np.ndarray], longest: int) -> Rule:
    rule: Rule = ()
    inside = np.ones(len(x), bool)
    while len(rule) < longest and (~bad[inside]).any():
        p0, n0 = bad[inside].sum(), inside.sum()
        before, best, found = np.log2(max(p0, 1e-9) / n0), 1e-9, None
        for f, name in enumerate(FEATURES):
            order = np.sort(x[inside, f])
            order_bad = np.sort(x[inside & bad, f])
            under = np.searchsorted(order, cuts[f], "left")
            under_bad = np.searchsorted(order_bad, cuts[f], "left")
            for above, n, p in ((False, under, under_bad), (True, n0 - under, p0 - under_bad)):
                gain = p * (np.log2(np.maximum(p, 1e-9) / np.maximum(n, 1)) - before)
                k = int(np.argmax(gain)) if len(gain) else 0
                if len(gain) and gain[k] > best:
                    best, found = float(gain[k]), Test(name, above, float(cuts[f][k]))
        if found is None:
            break
        rule += (found,)
        inside &= found.holds(x)
    return rule


def _prune(rule: Rule, x: np.ndarray, bad: np.ndarray) -> Rule:
    def worth(r: Rule) -> float:
        c = _covers(r, x)
        return float((2 * bad[c].sum() - c.sum()) / c.sum()) if c.any() else -1.0

    choices = [rule[:k] for k in range(1, len(rule) + 1)]
    return max(choices, key=worth, default=())


def learn(x: np.ndarray, good: np.ndarray, cuts: int = 48, longest: int = 3, most_rules: int = 12, precision: float = 0.95) -> list[Rule]:
    """Ordered rules that reject, from feature rows ``x`` (columns as FEATURES) and labels ``good``.

    A rule is kept while at least ``precision`` of the pruning rows it covers, and three of them, are bad. No labels or only
    one kind of them give no rules.
    """
    rules: list[Rule] = []
    if not len(x):
        return rules
    held = np.arange(len(x)) % 3 == 2
    bad = ~good.astype(bool)
    left = np.ones(len(x), bool)
    limits = [np.unique(np.quantile(x[:, f], np.linspace(0, 1, cuts + 2)[1:-1])) for f in range(len(FEATURES))]
    limits = [np.unique(np.concatenate([c, np.quantile(x[bad, f], np.linspace(0, 1, cuts + 2)[1:-1])])) if bad.any() else c for f, c in enumerate(limits)]
    while len(rules) < most_rules:
        grow, prune = left & ~held, left & held
        if not bad[grow].any():
            break
        rule = _prune(_grow(x[grow], bad[grow], limits, longest), x[prune], bad[prune])
        inside = _covers(rule, x[prune])
        if not rule or inside.sum() < 3 or bad[prune][inside].mean() < precision:
            break
        rules.append(rule)
        left &= ~_covers(rule, x)
    return rules


def expression(rules: list[Rule], stats: Column) -> Column:
    """The decision list as one conditional: false at the first rule that holds, else true."""
    values = features(stats)
    out = None
    for rule in rules:
        condition = rule[0].column(values)
        for test in rule[1:]:
            condition = condition & test.column(values)
        out = F.when(condition, F.lit(False)) if out is None else out.when(condition, F.lit(False))
    return F.lit(True) if out is None else out.otherwise(F.lit(True))


def fit(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "quality", sample: int = SAMPLE) -> list[Rule]:
    """Rules from at most ``sample`` labelled documents (a documented bound, so the labels can be broadcast and the
    statistics fit the driver). A document labelled twice counts as bad if one label says so; null labels are left out. Of
    rows that repeat an id, those with the smallest statistics speak for it, so an id is one example however often it occurs."""
    chosen = (
        labels.filter(F.col(label_col).isNotNull() & F.col(id_col).isNotNull())
        .groupBy(F.col(id_col).alias("label_id"))
        .agg(F.min(label_col).alias("label"))
        .orderBy(F.xxhash64("label_id"), "label_id")
        .limit(sample)
    )
    texts = docs.select(F.col(f"`{id_col}`").alias("label_id"), F.col(f"`{text_col}`").alias("t"))
    rows = texts.join(F.broadcast(chosen), "label_id").select("label_id", "label", statistics(F.col("t")).alias("s"))
    one = F.min(F.struct(*[c.alias(n) for n, c in features(F.col("s")).items()])).alias("f")
    found = rows.groupBy("label_id", "label").agg(one).select("label_id", "label", "f.*").collect()
    found.sort(key=lambda r: tuple(r))
    x = np.array([[r[n] for n in FEATURES] for r in found], float).reshape(-1, len(FEATURES))
    return learn(x, np.array([r["label"] for r in found]) > 0)


def base_failed(stats: Column) -> Column:
    return (stats["w"]["n_words"] < 20) | (100 * stats["w"]["n_repeat_words"] > 30 * stats["w"]["n_words"])


def judge(docs: DataFrame, rules: list[Rule], id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per row of ``docs``: the id, the counts, base_failed, kept and the number of the rule that rejected it.

    A null or empty text has no words and fails. Repeated rows are judged alike, extra columns are ignored.
    """
    s = F.col("s")
    which = F.coalesce(*[F.when(~expression([r], s), F.lit(i)) for i, r in enumerate(rules)], F.lit(None).cast("int"))
    return docs.select(F.col(f"`{id_col}`").alias(id_col), statistics(F.col(f"`{text_col}`")).alias("s")).select(
        id_col,
        s["w"]["n_words"].alias("n_words"),
        s["w"]["word_chars"].alias("word_chars"),
        s["n_symbols"].alias("n_symbols"),
        s["l"]["n_dup_lines"].alias("n_dup_lines"),
        s["w"]["n_repeat_words"].alias("n_repeat_words"),
        base_failed(s).alias("base_failed"),
        (~base_failed(s) & expression(rules, s)).alias("kept"),
        which.alias("rule"),
    )


def keep_good(docs: DataFrame, rules: list[Rule], text_col: str = "text") -> DataFrame:
    """The rows of ``docs`` that neither the base rule nor the list rejects, with all their columns."""
    (name,) = fresh(docs, "stats")
    s = F.col(name)
    kept = docs.withColumn(name, statistics(F.col(f"`{text_col}`"))).filter(~base_failed(s) & expression(rules, s))
    return kept.select(*[f"`{c}`" for c in docs.columns])
