"""Quality rules learned as a decision list (sequential covering).

Word and line statistics are Spark expressions over the whole text. The list is
grown from labelled rows: every step asks Spark for one histogram (feature x
bin x label) of the rows the unfinished rule still covers, adds the threshold
test with the best FOIL gain on the growing rows, and stops when none is left.
The finished conjunction is cut back to the prefix that is best on the pruning
rows, kept if it is precise enough there, and the rows it covers leave the
table before the next rule. The result is an ordered ``CASE WHEN``.

Defined results: a null or empty text has no words and fails the base rules;
null labels and labels of unknown documents are ignored, several labels of one
id count as bad if any is; no labels give an empty list (base rules only);
repeated rows are judged alike; other columns are ignored.
"""

from __future__ import annotations

import math
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quarry.llm.common import let, literals, staged, text_of, words_of

WINDOW = 5
FEATURES = ("n_words", "mean_word", "symbol_rate", "exclaim_rate", "upper_share",
            "repeat_share", "dup_line_share", "words_per_line")
STATS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
         "n_lines", "n_upper", "n_exclaim")


@dataclass(frozen=True)
class Test:
    """``feature >= value`` (at_least) or ``feature < value``."""

    feature: str
    at_least: bool
    value: float

    def column(self) -> Column:
        c = F.col(self.feature)
        return c >= F.lit(self.value) if self.at_least else c < F.lit(self.value)

    def __str__(self) -> str:
        return f"{self.feature} {'>=' if self.at_least else '<'} {self.value:g}"


Rule = tuple[Test, ...]


def repeat_words(words: Column) -> Column:
    """Words inside ``WINDOW``-word windows that occur twice or more.

    Windows are compared by a 64-bit hash over the hashes of their words.
    Sorting (hash, position) puts equal windows side by side, so the work grows
    as n log n for any number of repeats.
    """
    def windows(h: Column) -> Column:
        # past the end get() is null, which the hash skips; those windows are cut off
        w = F.transform(h, lambda x, i: F.xxhash64(x, *[F.get(h, i + k) for k in range(1, WINDOW)]))
        return F.slice(w, F.lit(1), F.greatest(F.size(h) - (WINDOW - 1), F.lit(0)))

    def covered(pos: Column) -> Column:
        steps = F.transform(pos, lambda p, i: F.least(
            F.lit(WINDOW), F.coalesce(F.get(pos, i + 1) - p, F.lit(WINDOW))))
        return F.aggregate(steps, F.lit(0), lambda a, x: a + x)

    def repeated(pairs: Column) -> Column:
        twins = F.filter(pairs, lambda x, i: (
            F.get(pairs, i + 1)["h"].eqNullSafe(x["h"])
            | ((i > 0) & F.get(pairs, F.greatest(i - 1, F.lit(0)))["h"].eqNullSafe(x["h"]))))
        return let(F.array_sort(F.transform(twins, lambda x: x["i"])), covered)

    def count(w: Column) -> Column:
        pairs = F.array_sort(F.transform(w, lambda x, i: F.struct(x.alias("h"), i.alias("i"))))
        return F.when(F.size(F.array_distinct(w)) == F.size(w), F.lit(0)).otherwise(
            let(pairs, repeated))

    return let(F.transform(words, lambda w: F.xxhash64(w)), lambda h: let(windows(h), count))


def with_stats(docs: DataFrame, text_col: str = "text") -> DataFrame:
    """``docs`` plus the long columns of ``STATS`` (clashing columns are replaced)."""
    text = text_of(text_col)
    full = F.filter(F.split(text, "\n", -1), lambda s: s.rlike(r"[^\x20\x09-\x0D]"))
    counts = let(words_of(text), lambda w: F.struct(
        F.size(w).alias("n"), F.length(F.array_join(w, "")).alias("chars"),
        repeat_words(w).alias("repeats")))
    lines = let(full, lambda s: F.struct(
        F.size(s).alias("n"), (F.size(s) - F.size(F.array_distinct(s))).alias("dups")))
    out = docs.withColumns({"_w": counts, "_l": lines}).withColumns({
        "n_words": F.col("_w.n"), "word_chars": F.col("_w.chars"),
        "n_symbols": F.regexp_count(text, F.lit(r"[#*$%&|<>]")),
        "n_dup_lines": F.col("_l.dups"), "n_repeat_words": F.col("_w.repeats"),
        "n_lines": F.col("_l.n"),
        "n_upper": F.regexp_count(text, F.lit("[A-Z]")),
        "n_exclaim": F.length(text) - F.length(F.replace(text, F.lit("!"), F.lit(""))),
    }).drop("_w", "_l")
    return out.withColumns({c: F.col(c).cast("long") for c in STATS})


def with_features(stats: DataFrame) -> DataFrame:
    """Rates per word, character or line; 0 where the divisor is 0."""
    def per(a: str, b: str) -> Column:
        return F.when(F.col(b) > 0, F.col(a) / F.col(b)).otherwise(F.lit(0.0))

    return stats.withColumns({
        "n_words": F.col("n_words"), "mean_word": per("word_chars", "n_words"),
        "symbol_rate": per("n_symbols", "n_words"), "exclaim_rate": per("n_exclaim", "n_words"),
        "upper_share": per("n_upper", "word_chars"),
        "repeat_share": per("n_repeat_words", "n_words"),
        "dup_line_share": per("n_dup_lines", "n_lines"),
        "words_per_line": per("n_words", "n_lines"),
    })


def base_failed() -> Column:
    return (F.col("n_words") < 10) | (100 * F.col("n_repeat_words") > 20 * F.col("n_words"))


def learn(labelled: DataFrame, features: tuple[str, ...] = FEATURES, bins: int = 32,
          max_rules: int = 12, max_tests: int = 3, min_precision: float = 0.95,
          min_cover: int = 5) -> list[Rule]:
    """Decision list for rows with the features and a boolean ``bad``.

    A third of the rows (by ``_fold`` = 2 of 0..2) prunes, the rest grows.
    Only histograms of at most features x 2 x bins x 4 rows reach the driver.
    """
    steps = [(i + 0.5) / bins for i in range(bins)]
    cuts: dict[str, list[float]] = {f: [] for f in features}
    marks = labelled.groupBy("bad").agg(
        *[F.percentile_approx(F.col(f).cast("double"), steps, 2000).alias(f) for f in features])
    for row in marks.collect():
        for f in features:
            cuts[f] = sorted({*cuts[f], *(v for v in row[f] or [] if v is not None)})
    if not any(cuts.values()):
        return []

    def bin_of(f: str) -> Column:
        v = F.col(f).cast("double")
        return F.size(F.filter(literals(cuts[f]), lambda t: t <= v)) if cuts[f] else F.lit(0)

    table = staged(labelled.select("bad", "_fold", *[bin_of(f).alias(f) for f in features]),
                   "rule_bins")

    def histogram(where: Column) -> tuple[dict, dict]:
        """Counts[(prunes, bad)][feature index, bin] and totals[(prunes, bad)]."""
        rows = (table.where(where)
                .select((F.col("_fold") == 2).alias("prunes"), "bad",
                        F.posexplode(F.array(*features)))
                .groupBy("prunes", "bad", "pos", "col").count().collect())
        counts: dict = {}
        totals: dict = {}
        for r in rows:
            key = (r["prunes"], r["bad"])
            counts.setdefault(key, {})[r["pos"], r["col"]] = r["count"]
            if r["pos"] == 0:
                totals[key] = totals.get(key, 0) + r["count"]
        return counts, totals

    def bin_test(f: str, at_least: bool, cut: int) -> Column:
        return F.col(f) > cut if at_least else F.col(f) <= cut  # bin > cut: value >= cuts[cut]

    left: Column = F.lit(True)
    rules: list[Rule] = []
    while len(rules) < max_rules:
        chosen: list[tuple[str, bool, int]] = []
        scores: list[tuple[int, int, int, int]] = []
        where = left
        counts, totals = histogram(where)
        if not totals.get((False, True)):
            break
        while True:
            best = _best_test(counts, totals, features, cuts) if len(chosen) < max_tests else None
            if best is None:
                break
            chosen.append(best)
            where = where & bin_test(*best)
            counts, totals = histogram(where)
            scores.append(tuple(totals.get((p, b), 0) for p in (False, True) for b in (False, True)))
            if not scores[-1][0]:
                break
        kept = _best_prefix(scores, min_precision, min_cover)
        if not kept:
            break
        rules.append(tuple(Test(f, up, cuts[f][cut]) for f, up, cut in chosen[:kept]))
        left = left & ~reduce(lambda a, b: a & b, [bin_test(*t) for t in chosen[:kept]])
    return rules


def _best_test(counts, totals, features, cuts):
    """(feature, at_least, cut) of the best FOIL gain on the growing rows, or None."""
    bad, good = totals.get((False, True), 0), totals.get((False, False), 0)
    if not bad or not good:
        return None
    before = math.log2(bad / (bad + good))
    best, gain = None, 1e-9
    for i, f in enumerate(features):
        p = n = 0
        for cut in range(len(cuts[f])):
            p += counts.get((False, True), {}).get((i, cut), 0)
            n += counts.get((False, False), {}).get((i, cut), 0)
            for up, a, b in ((True, bad - p, good - n), (False, p, n)):
                if a and (g := a * (math.log2(a / (a + b)) - before)) > gain:
                    best, gain = (f, up, cut), g
    return best


def _best_prefix(scores, min_precision: float, min_cover: int) -> int:
    """Number of tests kept: best (p - n) / (p + n) on the pruning rows, 0 to drop the rule."""
    best, value = 0, -2.0
    for k, (grow_good, grow_bad, prune_good, prune_bad) in enumerate(scores, 1):
        seen = prune_good + prune_bad
        good, bad = grow_good + prune_good, grow_bad + prune_bad
        if bad < min_cover or bad < min_precision * (good + bad):
            continue
        if seen and prune_bad < min_precision * seen:
            continue
        v = (prune_bad - prune_good) / seen if seen else 0.0
        if v > value + 1e-12:
            best, value = k, v
    return best


def rule_number(rules: list[Rule]) -> Column:
    """Ordered conditional expression: number of the first rule that holds, else 0."""
    out: Column | None = None
    for k, rule in enumerate(rules, 1):
        test = reduce(lambda a, b: a & b, [t.column() for t in rule])
        out = F.when(test, k) if out is None else out.when(test, k)
    return F.lit(0) if out is None else out.otherwise(0)


def labelled_rows(stats: DataFrame, labels: DataFrame) -> DataFrame:
    """Features of labelled rows that pass the base rules, with ``bad`` and ``_fold``."""
    marks = (labels.where(F.col("quality").isNotNull() & F.col("doc_id").isNotNull())
             .groupBy("doc_id").agg((F.min("quality") == 0).alias("bad")))
    fold = F.pmod(F.xxhash64(F.col("doc_id"), F.lit("fold")), F.lit(3))
    return (with_features(stats.where(~base_failed())).join(marks, "doc_id")
            .select("bad", fold.alias("_fold"), *FEATURES))


def judge(stats: DataFrame, rules: list[Rule]) -> DataFrame:
    """Adds ``base_failed``, ``rule`` (first rule that rejects, 0 for none) and ``kept``."""
    out = with_features(stats).withColumns({"base_failed": base_failed(),
                                            "rule": rule_number(rules)})
    return out.withColumn("kept", ~F.col("base_failed") & (F.col("rule") == 0))


def quality_rules(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """doc_id, statistics, base_failed, kept and the number of the rejecting rule."""
    stats = staged(with_stats(docs.select("doc_id", "text")).select("doc_id", *STATS), "stats")
    rules = learn(labelled_rows(stats, labels))
    return judge(stats, rules).select("doc_id", *STATS[:5], "base_failed", "kept", "rule")


def keep_good(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """The rows of ``docs`` that the rules keep, with their own columns.

    The list is learned from stored statistics; the texts are then filtered in
    one more scan, so no text is shuffled.
    """
    stats = staged(with_stats(docs.select("doc_id", "text")).select("doc_id", *STATS), "stats")
    rules = learn(labelled_rows(stats, labels))
    names = docs.columns
    own = docs.select(F.struct(*names).alias("_doc"), F.col("text"))
    return judge(with_stats(own), rules).where("kept").select(*[F.col("_doc").getField(c).alias(c) for c in names])
