"""N-gram Jaccard join by chosen paths."""
from __future__ import annotations

import math
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from dayloom.llm.common import WORD, discard, groups, keep, let, text_or_empty

SPAN, LEAST = 5, 0.8
RECALL = 1 - 1e-6  # of each pair of the least similarity, over all runs
CHOSEN = 3  # tokens a set is expected to choose in one run
SPARE = 3  # times as many are drawn, so that those in very many sets can be left out
HOT_PATHS = 9  # buckets of such tokens that a set keeps if it has hardly any others: of a pair that shares 0.8 of them, none of these with a chance of 1e-6
COLD_PATHS = 28  # buckets of other tokens that a set keeps at most
WHOLE = 8  # times a leaf: such a bucket of very common tokens is still compared in blocks, larger ones are split
LEVEL_PATHS = 24  # buckets of one level that a set keeps after a split
SPLIT = 12  # tokens it is expected to choose, of all it has, where a large bucket is split
# Members that chose fewer tokens than this other than common ones are also compared in blocks. Of a pair of similarity 0.8 that shares none of these
# tokens a member has at most SPLIT / 5 expected ones of its own, so a split that parts the pair leaves one out of this with a chance of 0.012 at most.
FEW = 7
LEAF = 1024  # sets that are compared with each other in one group; a comparison of sketches is cheap, a split is not
BLOCK = 1024  # sets of a bucket that is not split, that are compared with each other or with as many others in one group
DENSE = 0.5  # mean similarity of a bucket's members to one of them, from which splitting no longer parts it
COMMON = 0.9  # a token that this part of a bucket shares does not split it
DEPTH = 5
SKETCH = 64  # one byte of each of so many minima
LEAST_EQUAL = 35  # of them; a pair of similarity 0.8 has fewer with a chance of 1e-6
VALUES_AT_ONCE = 1 << 20
M1, M2 = np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB)


def n_runs(least: float = LEAST, recall: float = RECALL) -> int:
    """Runs until a pair has been in one bucket with the wanted recall: of the tokens two such sets share each run
    is expected to choose ``least * CHOSEN`` in both."""
    return math.ceil(-math.log(1 - recall) / (least * CHOSEN))


def shingles(words: Column, span: int = SPAN) -> Column:
    """Distinct hashes of ``span`` words; a shorter text is one shingle, a text without words has none."""
    return let(
        words,
        lambda w: F.when(F.size(w) == 0, F.array().cast("array<bigint>"))
        .when(F.size(w) < span, F.array(F.xxhash64(w)))
        .otherwise(F.array_distinct(F.transform(F.sequence(F.lit(1), F.size(w) - (span - 1)), lambda i: F.xxhash64(F.slice(w, i, span))))),
    )


def keyed(docs: DataFrame) -> DataFrame:
    """``doc_id``, the digest of the words in their order (``key``) and their shingles."""
    words = F.regexp_extract_all(text_or_empty(), F.lit(WORD), F.lit(0))
    rows = docs.select("doc_id", words.alias("words"))
    return rows.select("doc_id", F.unhex(F.md5(F.array_join("words", " "))).alias("key"), shingles(F.col("words")).alias("shingles"))


def mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * M1
    x = (x ^ (x >> np.uint64(27))) * M2
    return x ^ (x >> np.uint64(31))


def seeds(n: int, salt: int) -> np.ndarray:
    return mix(np.arange(1, n + 1, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15) + np.uint64(salt))


def choose_paths(values: np.ndarray, counts: np.ndarray, runs: int) -> tuple[np.ndarray, np.ndarray]:
    """(row, bucket) of the tokens each set chooses in each run: a token whose hash is below ``SPARE * CHOSEN / size``."""
    bound = np.repeat(np.minimum(SPARE * CHOSEN / np.maximum(counts, 1), 1.0), counts)
    row = np.repeat(np.arange(len(counts)), counts)
    rows, buckets = [], []
    for seed in seeds(runs, 1):
        hashed = mix(values ^ seed)
        taken = hashed.astype(np.float64) <= bound * 2.0**64
        rows.append(row[taken])
        buckets.append(mix(values[taken] + seed))
    order = np.argsort(np.concatenate(rows), kind="stable")
    return np.concatenate(rows)[order], np.concatenate(buckets)[order]


def sketches(values: np.ndarray, counts: np.ndarray) -> np.ndarray:
    out = np.zeros((len(counts), SKETCH), dtype=np.uint8)
    full = counts > 0
    starts = (np.cumsum(counts) - counts)[full]
    if len(starts):
        for i, seed in enumerate(seeds(SKETCH, 2)):
            least = np.minimum.reduceat((values ^ seed) * M1 ^ (values >> np.uint64(29)), starts)
            out[full, i] = (mix(least) >> np.uint64(56)).astype(np.uint8)
    return out


def _profiles(runs: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            start = 0
            sizes = np.diff(whole.column("shingles").offsets.to_numpy())
            total = np.concatenate([[0], np.cumsum(sizes)])
            while start < whole.num_rows:
                end = max(start + 1, int(np.searchsorted(total, total[start] + VALUES_AT_ONCE, side="right")) - 1)
                part = whole.slice(start, end - start)
                counts = sizes[start:end].astype(np.int64)
                values = part.column("shingles").flatten().to_numpy(zero_copy_only=False).view(np.uint64)
                rows, buckets = choose_paths(values, counts, runs)
                offsets = np.concatenate([[0], np.cumsum(np.bincount(rows, minlength=len(counts)))])
                lists = pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), pa.array(buckets.view(np.int64)))
                marks = pa.array([m.tobytes() for m in sketches(values, counts)], pa.binary())
                yield pa.RecordBatch.from_arrays(
                    [part.column("doc_id"), part.column("key"), pa.array(counts, pa.int32()), lists, marks],
                    names=["doc_id", "key", "n", "paths", "sketch"],
                )
                start = end

    return run


def profiles(docs: DataFrame, least: float = LEAST) -> DataFrame:
    rows = keyed(docs)
    kind = rows.schema["doc_id"].dataType.simpleString()
    schema = f"doc_id {kind}, key binary, n int, paths array<bigint>, sketch binary"
    return rows.mapInArrow(_profiles(n_runs(least)), schema)


def _first_paths(level: DataFrame, most: int) -> DataFrame:
    """``key, bucket`` with the first ``most`` buckets of each key, in an order that is the same for all keys. A key has a bounded number of rows."""
    listed = level.groupBy("key").agg(F.sort_array(F.collect_set("bucket")).alias("buckets"))
    return listed.select("key", F.explode(F.slice("buckets", 1, most)).alias("bucket"))


def leaves(sets: DataFrame, tokens_of: Callable[[DataFrame], DataFrame], least: float = LEAST) -> DataFrame:
    """``leaf, key, size``: buckets of two sets and more that need no further split.

    Tokens in more than ``LEAF`` sets are left out of the choice: a pair of similarity ``least`` lacks at most ``1 - least`` of either's tokens, which bounds the
    part of its other tokens that both drew. A set keeps the first of these buckets, in an order that is the same for all, as many as a recall of ``RECALL`` asks for:
    14 if it has no very common token, up to ``COLD_PATHS``. Only sets made up of passages that very many share, as near copies in large groups, go on with buckets of such tokens, ``HOT_PATHS`` each.

    A bucket of more than ``WHOLE * LEAF`` of these sets is split by tokens its members choose anew of all they have (``tokens_of`` gives ``key, shingles`` of a
    table of keys), other than those nearly all share, unless its members are alike on the whole (by their sketches and that of one
    of them) or it has been split ``DEPTH`` times. A set keeps ``LEVEL_PATHS`` buckets of a level. Members left with ``FEW`` tokens, as a passage that the bucket shares
    makes up most of them, are a leaf of their own besides. Counts and means decide; no bucket is gathered.
    """
    drawn = sets.select("key", F.size("paths").alias("drawn"), F.explode("paths").alias("bucket"))
    sizes = drawn.groupBy("bucket").agg(F.count("*").alias("size")).where("size > 1")
    listed = drawn.join(sizes, "bucket").groupBy("key", "drawn").agg(F.sort_array(F.collect_set(F.struct("bucket", "size"))).alias("met"))
    hot = F.filter("met", lambda m: m["size"] > LEAF)
    # of what both of a pair drew and few sets have, the part in both, at the least: what one lacks of the other counts as drawn and rare
    others = F.col("drawn") - F.size(hot)
    both = (others - F.col("drawn") * (1 - least)) / (others + F.col("drawn") * (1 / least - 1))
    wanted = F.when(both > 0, F.least(F.ceil(F.lit(math.log(1 - RECALL)) / F.log(1 - both)), F.lit(1 << 20)).cast("int"))
    enough = F.coalesce(wanted <= others, F.lit(False))
    sized = keep(
        listed.select(
            "key", F.slice(F.filter("met", lambda m: m["size"] <= LEAF), F.lit(1), F.when(enough, wanted).otherwise(COLD_PATHS)).alias("cold"),
            F.when(~enough, F.transform(F.slice(hot, 1, HOT_PATHS), lambda m: m["bucket"])).alias("hot"),
        ),
        "sized",
    )
    cold = sized.select("key", F.explode("cold").alias("m")).select("m.bucket", "key", "m.size")
    done: list[DataFrame] = [cold]
    spent: list[DataFrame] = [sized]
    level = sized.select("key", F.explode("hot").alias("bucket"))
    for depth in range(DEPTH + 1):
        sizes = level.groupBy("bucket").agg(F.count("*").alias("size")).where("size > 1")
        sized = keep(level.join(sizes, "bucket").select("bucket", "key", "size"), f"sized-{depth}")
        spent.append(sized)
        done.append(sized.where(F.col("size") <= WHOLE * LEAF))
        large = sized.where(F.col("size") > WHOLE * LEAF)
        if large.isEmpty():
            break
        if depth == DEPTH:
            done.append(large)
            break
        members = large.join(sets.select("key", "sketch"), "key")
        pivots = members.groupBy("bucket").agg(F.min_by("sketch", F.xxhash64("bucket", "key")).alias("pivot"))
        dense = members.join(pivots, "bucket").groupBy("bucket").agg(F.avg(_alike("sketch", "pivot")).alias("alike"))
        dense = keep(dense.where(F.col("alike") >= DENSE).select("bucket"), f"dense-{depth}")
        done.append(large.join(dense, "bucket", "left_semi"))
        draw = lambda token: F.pmod(F.xxhash64("bucket", token), F.lit(1 << 30)) / float(1 << 30)
        parted = large.join(dense, "bucket", "left_anti")
        places = parted.groupBy("key").agg(F.collect_list(F.struct("bucket", "size")).alias("places"))
        parted = tokens_of(places.select("key")).join(places, "key").select("key", "shingles", F.explode("places").alias("place"))
        parted = parted.select("key", "shingles", F.col("place.bucket").alias("bucket"), F.col("place.size").alias("size"))
        drawn = F.filter("shingles", lambda token: draw(token) * F.size("shingles") < SPLIT)
        tokens = keep(parted.select("bucket", "size", "key", F.explode_outer(drawn).alias("token")), f"tokens-{depth}")
        shared = tokens.groupBy("bucket", "token").agg(F.count("*").alias("n"), F.max("size").alias("size"))
        parting = shared.where((F.col("n") > 1) & (F.col("n") < F.col("size") * COMMON)).select("bucket", "token")
        common = shared.where((F.col("n") >= F.col("size") * COMMON) & F.col("token").isNotNull())
        told = tokens.join(common.select("bucket", "token", F.lit(True).alias("common")), ["bucket", "token"], "left")
        own = F.count(F.when(F.col("common").isNull(), F.col("token")))
        few = keep(told.groupBy("bucket", "key").agg(own.alias("own")).where(F.col("own") < FEW).select("bucket", "key"), f"few-{depth}")
        alone = few.groupBy("bucket").agg(F.count("*").alias("size")).where("size > 1")
        done.append(few.join(alone, "bucket").select(F.xxhash64(F.lit(4), "bucket").alias("bucket"), "key", "size"))
        level = tokens.join(parting, ["bucket", "token"])
        level = _first_paths(level.select("key", F.xxhash64(F.lit(3), "bucket", "token").alias("bucket")), LEVEL_PATHS)
        level = keep(level, f"level-{depth + 1}")
        spent += [dense, tokens, few, level]
    out = done[0]
    for part in done[1:]:
        out = out.unionByName(part)
    out = keep(out.select(F.col("bucket").alias("leaf"), "key", "size"), "leaves")
    for table in spent:
        discard(table)
    return out


def _alike(a: str, b: str) -> Column:
    """Part of the bytes of two sketches that are equal."""
    same = lambda i: (F.substring(F.col(a), i, F.lit(1)) == F.substring(F.col(b), i, F.lit(1))).cast("int")
    return F.aggregate(F.sequence(F.lit(1), F.lit(SKETCH)), F.lit(0), lambda n, i: n + same(i)) / SKETCH


def _blocks(found: DataFrame) -> DataFrame:
    """Every member with the groups it is compared in: one for a small leaf; a large leaf is cut into blocks of about ``BLOCK``, and each two
    blocks meet in one group."""
    n = F.when(F.col("size") <= LEAF, F.lit(1)).otherwise(F.ceil(F.col("size") / BLOCK)).cast("int")
    block = F.pmod(F.xxhash64("key"), n).cast("int")
    rows = found.withColumn("side", block).withColumn("other", F.explode(F.sequence(F.lit(0), n - 1)))
    low, high = F.least("side", "other"), F.greatest("side", "other")
    return rows.withColumn("within", low == high).withColumn("group", F.xxhash64("leaf", low, high)).drop("size", "other")


def _lists(column: pa.ChunkedArray) -> list[np.ndarray]:
    column = column.combine_chunks()
    values, offsets = column.values.to_numpy(zero_copy_only=False), column.offsets.to_numpy()
    return [values[a:b] for a, b in zip(offsets[:-1], offsets[1:], strict=True)]


def _products(lists: list[np.ndarray]) -> np.ndarray:
    """Numbers of common values of each two lists, by products of 0/1 matrices over some values at a time."""
    size = len(lists)
    out = np.zeros((size, size), dtype=np.int64)
    values = np.concatenate(lists)
    rows = np.repeat(np.arange(size), [len(x) for x in lists])
    order = np.argsort(values, kind="stable")
    values, rows = values[order], rows[order]
    if not len(values):
        return out
    starts = np.concatenate([[True], values[1:] != values[:-1]])
    column = np.cumsum(starts) - 1
    often = np.bincount(column)[column] > 1
    rows, column = rows[often], np.cumsum(starts[often]) - 1
    if not len(rows):
        return out
    step, at = 4096, 0
    while at < len(rows):
        end = int(np.searchsorted(column, column[at] + step))
        part = np.zeros((size, step), dtype=np.float32)
        part[rows[at:end], column[at:end] - column[at]] = 1.0
        out += (part @ part.T).astype(np.int64)
        at = end
    return out


def _eligible(table: pa.Table) -> np.ndarray:
    """Pairs this group answers for: of two blocks where it joins two, and with no earlier leaf in common."""
    size = table.num_rows
    leaf = table.column("leaf")[0].as_py()
    earlier = [x[x < leaf] for x in _lists(table.column("leaf_list"))]
    wanted = np.triu(np.ones((size, size), dtype=bool), 1)
    if not table.column("within")[0].as_py():
        side = table.column("side").to_numpy()
        wanted &= side[:, None] != side[None, :]
    return wanted & (_products(earlier) == 0)


def _sizes_fit(n: np.ndarray, least: float) -> np.ndarray:
    small, large = np.minimum(n[:, None], n[None, :]), np.maximum(n[:, None], n[None, :])
    return small >= least * large - 1e-9


def _screen(least: float):
    """Members of each group that have a partner by sketch."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        keys: list[bytes] = []
        ids: list[int] = []
        for table in groups(batches, ["group"]):
            if table.num_rows < 2:
                continue
            marks = np.frombuffer(b"".join(table.column("sketch").to_pylist()), dtype=np.uint8).reshape(-1, SKETCH)
            likely = _sizes_fit(table.column("n").to_numpy(), least)
            for at in range(0, len(marks), 64):
                likely[at : at + 64] &= (marks[at : at + 64, None, :] == marks[None, :, :]).sum(2) >= LEAST_EQUAL
            np.fill_diagonal(likely, False)
            if not likely.any():
                continue
            likely &= _eligible(table)
            found = np.flatnonzero(likely.any(0) | likely.any(1))
            if len(found):
                column, group = table.column("key"), table.column("group")[0].as_py()
                keys += [column[int(i)].as_py() for i in found]
                ids += [group] * len(found)
            if len(keys) > 4096:
                yield pa.RecordBatch.from_arrays([pa.array(ids, pa.int64()), pa.array(keys, pa.binary())], names=["group", "key"])
                keys, ids = [], []
        yield pa.RecordBatch.from_arrays([pa.array(ids, pa.int64()), pa.array(keys, pa.binary())], names=["group", "key"])

    return run


def _verify(least: float):
    """Exact similarities within each group: for a member with links their weight, and the least key it is joined to."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = ["key", "links", "root"]
        rows: list[tuple] = []
        for table in groups(batches, ["group"]):
            if table.num_rows < 2:
                continue
            lists = _lists(table.column("shingles"))
            n = np.array([len(x) for x in lists], dtype=np.int64)
            common = _products(lists)
            linked = (common >= least * (n[:, None] + n[None, :] - common) - 1e-9) & _eligible(table)
            if not linked.any():
                continue
            linked |= linked.T
            keys, copies = table.column("key").to_pylist(), table.column("copies").to_numpy()
            weight = linked @ copies
            order = sorted(range(len(keys)), key=keys.__getitem__)
            root = [-1] * len(keys)
            for first in order:
                if root[first] >= 0:
                    continue
                root[first], waiting = first, [first]
                while waiting:
                    for other in np.flatnonzero(linked[waiting.pop()]):
                        if root[other] < 0:
                            root[other] = first
                            waiting.append(int(other))
            rows += [(keys[i], int(weight[i]), keys[root[i]]) for i in range(len(keys)) if weight[i]]
            if len(rows) > 4096:
                yield pa.RecordBatch.from_arrays([pa.array(c) for c in zip(*rows, strict=True)], names=names)
                rows = []
        if rows:
            yield pa.RecordBatch.from_arrays([pa.array(c) for c in zip(*rows, strict=True)], names=names)

    return run


def components(edges: DataFrame) -> DataFrame:
    """``key, label``: the least key each key of ``edges`` (key, root) is joined to, by passing on least labels and following them."""
    both = edges.select("key", F.col("root").alias("other")).where("key != other")
    both = keep(both.unionByName(both.select(F.col("other").alias("key"), F.col("key").alias("other"))).distinct(), "edges")
    labels = keep(both.groupBy("key").agg(F.least(F.col("key"), F.min("other")).alias("label")), "labels")
    while True:
        heard = both.join(labels.select(F.col("key").alias("other"), "label"), "other").groupBy("key").agg(F.min("label").alias("heard"))
        nearer = labels.join(heard, "key").select("key", F.col("label").alias("old"), F.least("label", "heard").alias("label"))
        jump = labels.select(F.col("key").alias("label"), F.col("label").alias("next"))
        now = keep(nearer.join(jump, "label", "left").select("key", "old", F.least("label", "next").alias("label")), "labels")
        if now.where("label != old").isEmpty():
            return now.select("key", "label")
        labels = now.select("key", "label")


def similar_documents(docs: DataFrame, least: float = LEAST) -> DataFrame:
    """``doc_id, key, label, class_id, copy_of, n_links`` for every row of ``docs``; ``key`` and ``label`` are digests that name the text and its
    class also where doc_ids repeat.

    Two documents are linked where the sets of their five-word shingles have a Jaccard similarity of ``least`` or more. ``class_id`` is the
    smallest doc_id joined by links, ``copy_of`` the smallest doc_id with the same words in the same order, ``n_links`` the
    number of other rows linked. Null and empty texts, and texts of white space, have no shingles and no links: they are a class of their own each
    (class and copy are the row's doc_id). Rows repeated whole are copies of each other. A null doc_id counts as larger than all; a class
    of such rows alone has a null id. No rows give none.

    Copies are one set from the start. A set draws about ``n_runs() * SPARE * CHOSEN`` tokens; buckets are counted, those of very common tokens left out or split,
    and the rest compared in groups of bounded size, and a pair counts in the first leaf both its sets are in, so that neither pairs nor
    buckets are ever rows of a table.
    """
    rows = keep(profiles(docs, least), "profiles")
    full = rows.where("n > 0")
    sets = full.groupBy("key").agg(
        F.min("doc_id").alias("copy_of"), F.count("*").alias("copies"), F.max("n").alias("n"),
        F.first("paths").alias("paths"), F.first("sketch").alias("sketch"),
    )
    sets = keep(sets, "sets")

    def shingles_of(keys: DataFrame) -> DataFrame:
        ids = sets.join(keys, "key", "left_semi").select("copy_of", F.col("key").alias("_key"))
        texts = docs.select("doc_id", "text").join(ids.select("copy_of").distinct(), F.col("doc_id").eqNullSafe(F.col("copy_of")), "left_semi")
        return keyed(texts).join(ids, (F.col("key") == F.col("_key")) & F.col("doc_id").eqNullSafe(F.col("copy_of"))).select("key", "shingles").dropDuplicates(["key"])

    found = leaves(sets, shingles_of, least)
    listed = found.groupBy("key").agg(F.sort_array(F.collect_set("leaf")).alias("leaf_list"))
    grouped = keep(_blocks(found).join(listed, "key"), "groups")
    screened = grouped.select("group", "leaf", "within", "side", "key", "leaf_list").join(sets.select("key", "n", "sketch"), "key")
    screened = screened.repartition("group").sortWithinPartitions("group").mapInArrow(_screen(least), "group bigint, key binary")
    screened = keep(screened, "screened")
    needed = screened.select("key").distinct().join(sets.select("key", "copy_of", "copies"), "key")
    ids = needed.select(F.col("copy_of").alias("_id")).distinct()
    texts = docs.select("doc_id", "text").join(ids, F.col("doc_id").eqNullSafe(F.col("_id")), "left_semi")
    whole = keyed(texts).join(needed, "key").where(F.col("doc_id").eqNullSafe(F.col("copy_of")))
    written = keep(whole.select("key", "copies", "shingles"), "shingles")
    whole = written.dropDuplicates(["key"])
    meeting = screened.join(grouped, ["group", "key"]).join(whole, "key")
    linked = meeting.repartition("group").sortWithinPartitions("group").mapInArrow(_verify(least), "key binary, links bigint, root binary")
    linked = keep(linked, "links")
    for table in (found, grouped, screened, written):
        discard(table)
    labels = components(linked)
    totals = sets.join(linked.groupBy("key").agg(F.sum("links").alias("links")), "key", "left").join(labels, "key", "left")
    totals = totals.select(
        "key", "copy_of", F.coalesce("label", "key").alias("label"), (F.coalesce("links", F.lit(0)) + F.col("copies") - 1).alias("n_links")
    )
    totals = keep(totals, "totals")
    classes = totals.groupBy("label").agg(F.min("copy_of").alias("class_id"))
    by_key = totals.join(classes, "label").select(F.col("key").alias("_key"), "label", "copy_of", "class_id", "n_links")
    joined = rows.select("doc_id", "key", "n").join(by_key, (F.col("key") == F.col("_key")) & (F.col("n") > 0), "left")
    alone = F.col("n") == 0
    return joined.select(
        "doc_id", "key", "label", F.when(alone, F.col("doc_id")).otherwise(F.col("class_id")).alias("class_id"),
        F.when(alone, F.col("doc_id")).otherwise(F.col("copy_of")).alias("copy_of"), F.coalesce("n_links", F.lit(0)).cast("bigint").alias("n_links"),
    )


def one_of_each(docs: DataFrame, least: float = LEAST) -> DataFrame:
    """The rows of ``docs``, all columns, that are the first of their class: the smallest doc_id, then the smallest digest of the words.
    Texts without words all stay."""
    found = similar_documents(docs, least)
    order = F.struct(F.col("doc_id").isNull().alias("a"), F.col("doc_id").alias("id"), F.col("key").alias("key"))
    empty = F.unhex(F.md5(F.lit("")))
    winners = found.where(F.col("key") != empty).groupBy("label").agg(F.min(order).alias("w")).select(F.col("w.id").alias("_id"), F.col("w.key").alias("_key"))
    words = F.regexp_extract_all(text_or_empty(), F.lit(WORD), F.lit(0))
    own = docs.select(F.struct(*docs.columns).alias("_row"), F.unhex(F.md5(F.array_join(words, " "))).alias("_own"))
    kept = own.join(winners, (F.col("_own") == F.col("_key")) & F.col("_row.doc_id").eqNullSafe(F.col("_id")))
    kept = kept.dropDuplicates(["_own", "_id"]).select("_row")
    return kept.unionByName(own.where(F.col("_own") == empty).select("_row")).select("_row.*")
