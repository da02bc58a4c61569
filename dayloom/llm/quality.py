"""Quality rules: text statistics and a decision list learned from labels by sequential covering."""
from __future__ import annotations

import math
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from dayloom.llm.common import BLANKS, WORD, keep, let, text_or_empty

SPAN = 8
SYMBOLS = "#*$%&|<>"
LEAST_WORDS, MOST_REPEATED = 20, 30
# Thresholds a condition may use, by feature: a fixed grid, so that lists learned from more rows stay comparable.
GRID = {
    "n_words": [round(2 ** (i / 4)) for i in range(18, 68)],
    "word_length": [i / 4 for i in range(4, 64)],
    "symbols_per_word": [i / 50 for i in range(1, 64)],
    "dup_line_part": [i / 50 for i in range(1, 51)],
    "repeat_part": [i / 50 for i in range(1, 51)],
}
LEAST_PRECISION = 0.95  # of a rule on the pruning rows: below it clean documents would go
LEAST_COVER = 2  # rejected documents on the pruning rows
MOST_RULES, MOST_CONDITIONS = 16, 4


def repeated_words(words: Column, span: int = SPAN) -> Column:
    """Words in windows of ``span`` words that occur twice or more in the text, the first included."""

    def of_hashes(hashes: Column) -> Column:
        paired = F.transform(hashes, lambda h, i: F.struct(h.alias("h"), i.alias("i")))

        def of_sorted(rows: Column) -> Column:
            same = lambda e, other: F.coalesce(F.get(rows, other)["h"] == e["h"], F.lit(False))
            twice = F.filter(F.transform(rows, lambda e, k: F.when(same(e, k - 1) | same(e, k + 1), e["i"])), lambda i: i.isNotNull())
            return let(
                F.array_sort(twice),
                lambda at: F.aggregate(
                    F.transform(at, lambda p, k: F.least(F.lit(span), F.coalesce(F.get(at, k + 1) - p, F.lit(span)))),
                    F.lit(0).cast("bigint"), lambda s, n: s + n,
                ),
            )

        return F.when(F.size(F.array_distinct(hashes)) == F.size(hashes), F.lit(0).cast("bigint")).otherwise(
            let(F.array_sort(paired), of_sorted)
        )

    def of_words(w: Column) -> Column:
        windows = F.transform(F.sequence(F.lit(1), F.size(w) - (span - 1)), lambda i: F.xxhash64(F.slice(w, i, span)))
        return F.when(F.size(w) < span, F.lit(0).cast("bigint")).otherwise(let(windows, of_hashes))

    return let(words, of_words)


def text_stats(docs: DataFrame) -> DataFrame:
    """``doc_id`` and the statistics of each whole text; a null text has no words and counts as empty.

    Repeats within a text are found by sorting its window hashes in the row: nothing is shuffled, and a text
    without repeats costs one set of longs.
    """
    text, words = F.col("_text"), F.col("_words")
    lines = F.filter(F.split(text, "\n", -1), lambda line: line.rlike(WORD))
    without = lambda chars: F.length(F.translate(text, chars, ""))
    return (
        docs.select("doc_id", text_or_empty().alias("_text"))
        .withColumn("_words", F.regexp_extract_all(text, F.lit(WORD), F.lit(0)))
        .select(
            "doc_id",
            F.size(words).cast("bigint").alias("n_words"),
            without(BLANKS).cast("bigint").alias("word_chars"),
            (F.length(text) - without(SYMBOLS)).cast("bigint").alias("n_symbols"),
            let(lines, lambda l: F.struct(F.size(l).alias("n"), (F.size(l) - F.size(F.array_distinct(l))).alias("d"))).alias("_lines"),
            repeated_words(words).alias("n_repeat_words"),
        )
        .select(
            "doc_id", "n_words", "word_chars", "n_symbols", F.col("_lines.d").cast("bigint").alias("n_dup_lines"), "n_repeat_words",
            F.col("_lines.n").cast("bigint").alias("n_lines"),
        )
    )


def base_failed() -> Column:
    return (F.col("n_words") < LEAST_WORDS) | (F.col("n_repeat_words") * 100 > F.col("n_words") * MOST_REPEATED)


def features() -> dict[str, Column]:
    """Features of the learned conditions; 0 for a text without words."""
    part = lambda a, b: F.coalesce(F.try_divide(F.col(a), F.col(b)), F.lit(0.0))
    return {
        "n_words": F.col("n_words").cast("double"),
        "word_length": part("word_chars", "n_words"),
        "symbols_per_word": part("n_symbols", "n_words"),
        "dup_line_part": part("n_dup_lines", "n_lines"),
        "repeat_part": part("n_repeat_words", "n_words"),
    }


Condition = tuple[str, bool, float]  # feature, whether it must be at least the threshold (else below), threshold


def holds(rule: list[Condition]) -> Column:
    named = features()
    return reduce(lambda a, b: a & b, [named[f] >= t if up else named[f] < t for f, up, t in rule], F.lit(True))


def _counts(rows: DataFrame, tests: list[Column]) -> list[tuple[float, float]]:
    """Rejected and clean rows under each test, in one aggregate."""
    sums = [F.sum(F.when(t, F.col(c)).otherwise(0)) for t in tests for c in ("bad", "good")]
    found = [float(x or 0) for x in rows.agg(*[s.alias(f"s{i}") for i, s in enumerate(sums)]).first()]
    return list(zip(found[::2], found[1::2], strict=True))


def _place(value: Column, grid: list[float]) -> Column:
    """The number of thresholds that the value reaches."""
    return F.size(F.filter(F.array(*[F.lit(float(t)) for t in grid]), lambda t: t <= value))


def _best_condition(rows: DataFrame) -> Condition | None:
    """The condition of the largest information gain, from one small histogram for each feature."""
    named, bins = features(), []
    for name, grid in GRID.items():
        bins.append(F.struct(F.lit(name).alias("feature"), _place(named[name], grid).alias("bin")))
    cells = rows.select("bad", "good", F.explode(F.array(*bins)).alias("c")).groupBy("c.feature", "c.bin")
    found = cells.agg(F.sum("bad").alias("bad"), F.sum("good").alias("good")).collect()  # at most one row for each grid point
    gains: list[tuple[float, Condition]] = []
    for name, grid in GRID.items():
        own = {r["bin"]: (float(r["bad"]), float(r["good"])) for r in found if r["feature"] == name}
        p_all, n_all = (sum(v[k] for v in own.values()) for k in (0, 1))
        if not p_all or not n_all:
            continue
        p_up, n_up = p_all, n_all
        for i, threshold in enumerate(grid):
            p, n = own.get(i, (0.0, 0.0))
            p_up, n_up = p_up - p, n_up - n
            for up, a, b in ((True, p_up, n_up), (False, p_all - p_up, n_all - n_up)):
                gain = a * (math.log2(a / (a + b)) - math.log2(p_all / (p_all + n_all))) if a > 0 else 0.0
                gains.append((gain, (name, up, float(threshold))))
    best = max((g for g, _ in gains), default=0.0)
    if best <= 1e-9:
        return None
    first = next(c for g, c in gains if g > best - 1e-9)
    tied = [c for g, c in gains if g > best - 1e-9 and c[:2] == first[:2]]
    return tied[len(tied) // 2]  # the middle of the thresholds that part the rows alike, far from both sides


def learn(stats: DataFrame, labels: DataFrame) -> list[list[Condition]]:
    """Ordered rules that reject, learned from all labelled documents that pass the base rules.

    Sequential covering: two thirds of the rows (by a hash of doc_id) grow a rule condition by condition
    until it covers no clean row or gains nothing, one third prunes it from its end by precision; a rule that is not
    precise on the pruning rows ends the list, else its rows are taken away and the next rule grows. Only sums over the
    threshold grid reach the driver. Labels that repeat or contradict each other count as their sum; null
    labels and labels without a document count nothing. Without labels the list is empty.
    """
    votes = labels.where("quality IS NOT NULL").groupBy("doc_id")
    votes = votes.agg(F.sum((F.col("quality") == 0).cast("double")).alias("bad"), F.sum((F.col("quality") != 0).cast("double")).alias("good"))
    rows = keep(stats.where(~base_failed()).join(votes, "doc_id"), "rule-rows")
    prunes = F.pmod(F.xxhash64(F.lit(7), "doc_id"), F.lit(3)) == 0
    rules: list[list[Condition]] = []
    for _ in range(MOST_RULES):
        left = rows.where(~reduce(lambda a, b: a | b, [holds(r) for r in rules], F.lit(False)))
        rule: list[Condition] = []
        while len(rule) < MOST_CONDITIONS:
            found = _best_condition(left.where(~prunes & holds(rule)))
            if found is None:
                break
            rule.append(found)
        if not rule:
            break
        scored = _counts(left.where(prunes), [holds(rule[: n + 1]) for n in range(len(rule))])
        precision = [p / (p + n) if p + n else 0.0 for p, n in scored]
        size = max(range(len(rule)), key=lambda i: (precision[i], scored[i][0], -i))
        if precision[size] < LEAST_PRECISION or scored[size][0] < LEAST_COVER:
            break
        rules.append(rule[: size + 1])
    return rules


def verdict(rules: list[list[Condition]]) -> Column:
    """The list as one conditional expression: the first rule that holds rejects; else the document stays."""
    out = F.when(base_failed(), F.lit(False))
    for rule in rules:
        out = out.when(holds(rule), F.lit(False))
    return out.otherwise(F.lit(True))


def judge(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """Statistics, base verdict and ``kept`` for every row of ``docs``; no rows give no rows."""
    stats = keep(text_stats(docs), "quality-stats")
    rules = learn(stats, labels)
    return stats.withColumn("base_failed", base_failed()).withColumn("kept", verdict(rules))


def filter_documents(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """The rows of ``docs``, all columns, whose text is kept. Rules are learned from the same texts."""
    rules = learn(keep(text_stats(docs), "quality-stats"), labels)
    own = docs.select("*", F.struct(*docs.columns).alias("_row"))
    stats = text_stats(own.select(F.col("_row").alias("doc_id"), F.col("text")))
    return stats.where(verdict(rules)).select("doc_id.*")
