"""Mixing sources to target weights by subset sums over exact document lengths."""
from __future__ import annotations

import math

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from dayloom.llm.common import WORD, keep, text_or_empty

WEIGHTS = (3, 1, 2)
SHARE = 1.5
MOST_REPEATS = 2
SEED = 20
RESERVE = 1 << 14  # words of each source's budget that the knapsack fills
RANK_ROWS = 1024  # rows that are ranked together


def word_count(text: Column) -> Column:
    return F.regexp_count(text, F.lit(WORD)).cast("bigint")


def source_targets(sizes: DataFrame, weights=WEIGHTS, share: float = SHARE, most: int = MOST_REPEATS) -> DataFrame:
    """``sizes`` (key, size of the source) with each source's ``target``.

    Sources are weighted in the order of their key, weights repeating. A share above ``most`` times the
    source is cut there and the excess goes to the others by weight, until none is above: sorted by
    ``cap / weight``, the first sources are full and the rest lie at one common level. One row per source passes through
    the windows, never one per document.
    """
    order = Window.orderBy("key")
    weight = F.element_at(F.array(*[F.lit(float(w)) for w in weights]), (F.pmod(F.row_number().over(order) - 1, F.lit(len(weights))) + 1))
    rows = sizes.withColumn("weight", weight).withColumn("cap", F.col("source_size") * float(most))
    whole = Window.partitionBy()
    before = Window.orderBy(F.col("cap") / F.col("weight"), "key").rowsBetween(Window.unboundedPreceding, -1)
    left = F.sum("source_size").over(whole) * float(share) - F.coalesce(F.sum("cap").over(before), F.lit(0.0))
    open_weight = F.sum("weight").over(whole) - F.coalesce(F.sum("weight").over(before), F.lit(0.0))
    rows = rows.withColumn("level", left / open_weight)
    is_open = F.col("level") <= F.col("cap") / F.col("weight")
    level = F.min(F.when(is_open, F.struct((F.col("cap") / F.col("weight")).alias("r"), "key", "level"))).over(whole)["level"]
    return rows.select(
        "key", "source_size", F.coalesce(F.least("cap", F.col("weight") * level), "cap").alias("target")
    )


def fill(sizes: list[int], counts: list[int], budget: int) -> list[int]:
    """How many documents of each size to take so that their sum comes nearest to ``budget`` from below.

    Sizes are positive and differ. All but a reserve of the budget is dealt in proportion to the counts, so
    that every length is represented; a bounded knapsack over the documents left fills the rest exactly
    where a subset sum allows it.
    """
    total = sum(s * n for s, n in zip(sizes, counts, strict=True))
    if budget <= 0 or total == 0:
        return [0] * len(sizes)
    if budget >= total:
        return list(counts)
    order = sorted(range(len(sizes)), key=lambda i: -sizes[i])
    taken, got, ideal, part = [0] * len(sizes), 0, 0.0, max(0, budget - RESERVE) / total
    for i in order:
        ideal += part * sizes[i] * counts[i]
        taken[i] = max(0, min(counts[i], int((ideal - got) // sizes[i])))
        got += taken[i] * sizes[i]
    rest = budget - got
    for i in order:  # lengths too long for the knapsack's reserve
        if rest > 2 * RESERVE:
            more = min(counts[i] - taken[i], (rest - RESERVE) // sizes[i])
            taken[i], rest = taken[i] + more, rest - more * sizes[i]
    mask, reach, steps = (1 << (rest + 1)) - 1, 1, []
    for i in order:
        free, chunk = min(counts[i] - taken[i], rest // sizes[i]), 1
        while free > 0 and not reach >> rest & 1:
            n = min(chunk, free)
            steps.append((i, n, reach))
            reach |= reach << (n * sizes[i]) & mask
            free, chunk = free - n, chunk * 2
    at = reach.bit_length() - 1
    for i, n, earlier in reversed(steps):
        if not earlier >> at & 1:
            taken[i] += n
            at -= n * sizes[i]
    return taken


def plan_source(rows: pd.DataFrame) -> pd.DataFrame:
    """For one source's rows (size, n): every document ``base`` times, and ``extra`` of them once more."""
    total, target = int(rows["source_size"].iloc[0]), float(rows["target"].iloc[0])
    base = min(MOST_REPEATS, int(target // total)) if total else 0
    budget = 0 if base == MOST_REPEATS else math.floor(target - base * total + 0.5)
    rows = rows.sort_values("size")
    sizes, counts = rows["size"].tolist(), rows["n"].tolist()
    empty = sizes[:1] == [0]
    extra = [0] * empty + fill(sizes[empty:], counts[empty:], budget)
    return rows.assign(base=base, extra=extra)[["key", "size", "n", "source_size", "target", "base", "extra"]]


def mix(docs: DataFrame, seed: int = SEED) -> DataFrame:
    """``docs`` columns doc_id and source, with size, source_size, target, ``times`` (0, 1 or 2) and taken.

    Size is the number of words of the text (null: 0). A null source is one source, the last. Which of the documents of one
    length are taken follows a seeded hash of doc_id, so reruns agree; rows equal in doc_id, source and size
    are interchangeable and keep their number. A document of no words is never repeated (times is ``base``).
    No rows give no rows.

    Only (source, size) counts are gathered per source: as many rows as there are distinct lengths, however
    many documents share them. Ranks are taken in parts of about a thousand rows whatever the
    size of a (source, size) group; the parts before are counted, not read.
    """
    key = F.coalesce(F.concat(F.lit("0"), F.col("source").cast("string")), F.lit("1"))
    draw = F.xxhash64(F.lit(seed), F.col("doc_id"))
    slim = keep(docs.select("doc_id", key.alias("key"), word_count(text_or_empty()).alias("size"), draw.alias("draw")), "mix-sizes")
    counts = slim.groupBy("key", "size").agg(F.count("*").alias("n"))
    targets = source_targets(counts.groupBy("key").agg(F.sum(F.col("size") * F.col("n")).alias("source_size")))
    schema = "key string, size bigint, n bigint, source_size bigint, target double, base int, extra bigint"
    plan = keep(counts.join(targets, "key").groupBy("key").applyInPandas(plan_source, schema), "mix-plan")
    unit = F.col("draw") / F.lit(2.0**64) + 0.5
    n_parts = F.ceil(F.col("n") / RANK_ROWS)
    rows = slim.join(plan, ["key", "size"]).withColumn("part", F.least(F.floor(unit * n_parts), n_parts - 1))
    parts = rows.groupBy("key", "size", "part").agg(F.count("*").alias("rows"))
    before = Window.partitionBy("key", "size").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    parts = parts.select("key", "size", "part", F.coalesce(F.sum("rows").over(before), F.lit(0)).alias("before"))
    place = F.row_number().over(Window.partitionBy("key", "size", "part").orderBy("draw", "doc_id"))
    ranked = rows.join(parts, ["key", "size", "part"]).withColumn("place", F.col("before") + place)
    times = F.col("base") + (F.col("place") <= F.col("extra")).cast("int")
    return ranked.select(
        "doc_id", F.when(F.col("key") != "1", F.substring(F.col("key"), 2, 1 << 30)).alias("source"), "size", "source_size", "target",
        times.alias("times"), (F.col("size") * times).alias("taken"),
    )


def mix_documents(docs: DataFrame, seed: int = SEED) -> DataFrame:
    """The rows of ``docs``, all columns, each as often as the mix takes it.

    Rows equal in doc_id, source and size are dealt their common number of copies in the order of their text.
    """
    taken = mix(docs, seed).groupBy("doc_id", "source", "size").agg(F.count("*").alias("rows"), F.sum("times").alias("copies"))
    keys = ["doc_id", "source", "size"]
    own = docs.select(F.struct(*docs.columns).alias("_row"), *[F.col(c).alias(f"_{c}") for c in keys[:2]], word_count(text_or_empty()).alias("_size"))
    taken = taken.select(*[F.col(c).alias(f"t_{c}") for c in keys], "rows", "copies")
    same = [F.col(f"_{c}").eqNullSafe(F.col(f"t_{c}")) for c in keys]
    place = F.row_number().over(Window.partitionBy("_doc_id", "_source", "_size").orderBy("_row.text"))
    each = F.floor(F.col("copies") / F.col("rows")).cast("int")
    times = each + (place <= F.col("copies") - each * F.col("rows")).cast("int")
    joined = own.join(taken, same).withColumn("_times", times).where("_times > 0")
    return joined.select("_row", F.explode(F.sequence(F.lit(1), F.col("_times")))).select("_row.*")
