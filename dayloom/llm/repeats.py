"""Repeated byte strings by prefix-free parsing: rolling-hash triggers, phrases, and suffix orders of what surrounds a trigger."""
from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from dayloom.llm.common import keep, text_or_empty

LENGTH = 100  # bytes of a repeat
TRIGGER = 32  # bytes of a trigger
HOT = 50_000  # occurrences of a trigger beyond which its phrases are resolved by counts instead of in one group
PIECE = 1 << 20  # bytes parsed at a time
MEMBERS = 1 << 13  # phrases that are ordered together, unless one trigger has more
BASE = 0x9E3779B97F4A7C15
M1, M2 = np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB)
LOW = np.uint64(0xFFFFFFFF)


def mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * M1
    x = (x ^ (x >> np.uint64(27))) * M2
    return x ^ (x >> np.uint64(31))


def _powers(base: int, n: int) -> np.ndarray:
    out = np.ones(max(n, 1), dtype=np.uint64)
    size = 1
    while size < n:
        step = min(size, n - size)
        out[size : size + step] = out[:step] * np.uint64(pow(base, size, 1 << 64))
        size += step
    return out


class Parser:
    """Phrases around the triggers of byte strings.

    A rolling hash is taken of each ``TRIGGER`` bytes. The least of the hashes in a window of ``LENGTH`` bytes (the leftmost of equals) is the
    window's trigger, so every window has one and equal windows have theirs at the same place. Consecutive
    windows of one trigger make a phrase: from the start of the first to the end of the last.
    """

    def __init__(self, length: int = LENGTH, trigger: int = TRIGGER):
        self.length, self.trigger = length, trigger
        self.values = mix(np.arange(1, 257, dtype=np.uint64) * np.uint64(BASE)) | np.uint64(1)
        self.up = self.down = np.ones(1, dtype=np.uint64)

    def phrases(self, data: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, ...]:
        """``data`` holds strings that end at ``ends``. Returns of each phrase the trigger's hash, the phrase's hash, and the places of
        the trigger, the first and the last window."""
        n, w, span = len(data), self.trigger, self.length - self.trigger + 1
        none = tuple(np.zeros(0, t) for t in (np.uint64, np.uint64, np.int64, np.int64, np.int64))
        if n < self.length:
            return none
        if len(self.up) < n:
            self.up, self.down = _powers(BASE, n), _powers(pow(BASE, -1, 1 << 64), n)
        sums = np.zeros(n + 1, dtype=np.uint64)
        np.cumsum(self.values[data] * self.up[:n], out=sums[1:])
        hashes = mix((sums[w:] - sums[:-w]) * self.down[: n - w + 1])
        least = (hashes & ~LOW) | np.arange(len(hashes), dtype=np.uint64)
        size = 1
        while size * 2 <= span:
            least = np.minimum(least[:-size], least[size:])
            size *= 2
        if size < span:
            least = np.minimum(least[: len(least) - (span - size)], least[span - size :])
        starts = np.arange(len(least))
        end = ends[np.searchsorted(ends, starts, side="right")]
        whole = starts + self.length <= end
        starts, at = starts[whole], (least[whole] & LOW).astype(np.int64)
        if not len(starts):
            return none
        cut = np.concatenate([[True], (at[1:] != at[:-1]) | (starts[1:] != starts[:-1] + 1)])
        first = starts[cut]
        last = starts[np.concatenate([np.flatnonzero(cut)[1:] - 1, [len(starts) - 1]])]
        at = at[cut]
        stop = last + self.length
        # shape and bytes of the phrase together
        phrase = mix((sums[stop] - sums[first]) * self.down[first]) ^ mix(((at - first) << 20 | (last - first)).astype(np.uint64) + M1)
        return hashes[at], mix(phrase), at, first, last


def _bytes_of(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Bytes and offsets of a binary column, without a copy."""
    offsets = np.frombuffer(column.buffers()[1], dtype=np.int32)[column.offset : column.offset + len(column) + 1].astype(np.int64)
    data = column.buffers()[2]
    return (np.frombuffer(data, dtype=np.uint8) if data is not None else np.zeros(0, np.uint8)), offsets


def _phrases(columns: tuple[str, ...]):
    """Rows of phrases of the documents of each batch."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        parser = Parser()
        for batch in batches:
            data, offsets = _bytes_of(batch.column("body"))
            docs, ties = (batch.column(c).to_numpy(zero_copy_only=False) for c in ("doc", "tie"))
            pieces: list[tuple[int, int, int]] = []  # document, start and end in data
            size = 0

            def parsed(pieces: list[tuple[int, int, int]]) -> pa.RecordBatch | None:
                lengths = np.array([b - a for _, a, b in pieces])
                ends = np.cumsum(lengths)
                joined = np.concatenate([data[a:b] for _, a, b in pieces])
                trigger, phrase, at, first, last = parser.phrases(joined, ends)
                if not len(at):
                    return None
                piece = np.searchsorted(ends, at, side="right")
                rows = np.array([i for i, _, _ in pieces])[piece]
                shift = np.array([a for _, a, _ in pieces])[piece] - offsets[rows] - (ends - lengths)[piece]
                made = {
                    "trigger": trigger.view(np.int64), "phrase": (phrase >> np.uint64(8)).astype(np.int64), "doc": docs[rows], "tie": ties[rows],
                    "at": at + shift, "first": (at - first).astype(np.int16), "last": (at - last).astype(np.int16),
                }
                return pa.RecordBatch.from_arrays([pa.array(made[c]) for c in columns], names=list(columns))

            for i in range(len(docs)):
                start, end = int(offsets[i]), int(offsets[i + 1])
                while end - start >= LENGTH:
                    stop = min(end, start + PIECE)
                    pieces.append((i, start, stop))
                    size += stop - start
                    start = end if stop == end else stop - LENGTH + 1
                    if size >= PIECE:
                        if (out := parsed(pieces)) is not None:
                            yield out
                        pieces, size = [], 0
            if pieces and (out := parsed(pieces)) is not None:
                yield out

    return run


PHRASE = {"trigger": "bigint", "phrase": "bigint", "doc": "bigint", "tie": "bigint", "at": "bigint", "first": "smallint", "last": "smallint"}


def phrase_table(docs: DataFrame, *columns: str) -> DataFrame:
    columns = columns or tuple(PHRASE)
    schema = ", ".join(f"{c} {PHRASE[c]}" for c in columns)
    return docs.select("doc", "tie", "body").mapInArrow(_phrases(columns), schema)


def _whole_triggers(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.Table]:
    """Tables of whole triggers, of about ``MEMBERS`` rows, from batches sorted by trigger."""
    rest: list[pa.Table] = []
    size = 0
    for batch in batches:
        if not batch.num_rows:
            continue
        rest.append(pa.Table.from_batches([batch]))
        size += batch.num_rows
        if size < MEMBERS:
            continue
        table = pa.concat_tables(rest).combine_chunks()
        trigger = table.column("trigger").to_numpy()
        cuts = np.flatnonzero(trigger[1:] != trigger[:-1]) + 1
        if len(cuts):
            yield from _parts(table.slice(0, int(cuts[-1])))
            table = table.slice(int(cuts[-1]))
        rest, size = [table], table.num_rows
    if rest:
        yield from _parts(pa.concat_tables(rest).combine_chunks())


def _parts(table: pa.Table) -> Iterator[pa.Table]:
    trigger = table.column("trigger").to_numpy()
    cuts = np.concatenate([[0], np.flatnonzero(trigger[1:] != trigger[:-1]) + 1, [len(trigger)]])
    start = 0
    while start < len(trigger):
        end = int(cuts[max(np.searchsorted(cuts, start + MEMBERS, side="right") - 1, np.searchsorted(cuts, start, side="right"))])
        yield table.slice(start, end - start)
        start = end


def _classes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The dictionary: of equal phrases all but the earliest are repeats whole; of a trigger with several phrases the earliest of each is
    passed on to be compared with the others (``removed`` false)."""
    for table in _whole_triggers(batches):
        column = {c: table.column(c).to_numpy() for c in PHRASE}
        order = np.lexsort((column["at"], column["tie"], column["doc"], column["phrase"], column["trigger"]))
        column = {c: v[order] for c, v in column.items()}
        new = lambda *names: np.concatenate([[True], np.any([column[c][1:] != column[c][:-1] for c in names], axis=0)])
        earliest, group = new("trigger", "phrase"), np.cumsum(new("trigger")) - 1
        several = np.bincount(group, weights=earliest)[group] > 1
        wanted = ~earliest | several
        if wanted.any():
            yield pa.RecordBatch.from_arrays(
                [pa.array(column[c][wanted]) for c in PHRASE] + [pa.array(~earliest[wanted])], names=[*PHRASE, "removed"]
            )


def _with_bytes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The phrases of each document's list with their bytes."""
    for whole in batches:
        for at in range(0, whole.num_rows, 64):
            batch = whole.slice(at, 64)
            out: dict[str, list] = {c: [] for c in ("trigger", "doc", "tie", "at", "first", "last", "bytes")}
            for doc, tie, body, phrases in zip(*(batch.column(c).to_pylist() for c in ("doc", "tie", "body", "phrases")), strict=True):
                for p in phrases:
                    start, stop = p["at"] - p["first"], p["at"] - p["last"] + LENGTH
                    for name, value in (("trigger", p["trigger"]), ("doc", doc), ("tie", tie), ("at", p["at"]), ("first", p["first"]), ("last", p["last"]), ("bytes", body[start:stop])):
                        out[name].append(value)
            if out["doc"]:
                kinds = [pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.int16(), pa.int16(), pa.binary()]
                yield pa.RecordBatch.from_arrays([pa.array(v, k) for v, k in zip(out.values(), kinds, strict=True)], names=list(out))


def _common(rows: np.ndarray) -> np.ndarray:
    """Lengths of the common prefixes of neighbouring rows; 0 before the first."""
    differ = rows[1:] != rows[:-1]
    return np.concatenate([[0], np.where(differ.any(1), differ.argmax(1), rows.shape[1])])


def repeated_windows(bodies: list[bytes], first: np.ndarray, last: np.ndarray, rank: np.ndarray) -> np.ndarray:
    """For phrases (bytes, distances of their first and last window from the trigger, rank in the corpus) whether the window at each distance
    equals one of a phrase of smaller rank.

    Suffixes from the trigger on and, reversed, prefixes before it are put in order, with the lengths neighbours have in common.
    Windows at distance ``d`` are equal where the prefixes agree on ``d`` bytes and the suffixes on the rest, that is, where no neighbour
    between them in either order has less in common.
    """
    size, reach = len(bodies), LENGTH - TRIGGER + 1
    right, left = np.zeros((size, LENGTH), np.uint8), np.zeros((size, reach), np.uint8)
    for i, body in enumerate(bodies):
        data, d = np.frombuffer(body, np.uint8), int(first[i])
        tail = data[d : d + LENGTH]
        right[i, : len(tail)] = tail
        left[i, :d] = data[:d][::-1]
    right_order = np.argsort(right.view(f"S{LENGTH}").ravel(), kind="stable")
    left_order = np.argsort(left.view(f"S{reach}").ravel(), kind="stable")
    right_common, left_common = _common(right[right_order]), _common(left[left_order])
    out = np.zeros((size, reach), dtype=bool)
    for d in range(reach):
        own = np.flatnonzero((last <= d) & (d <= first))
        if len(own) < 2:
            continue
        a, b = np.empty(size, np.int64), np.empty(size, np.int64)
        a[right_order] = np.cumsum(right_common < LENGTH - d)
        b[left_order] = np.cumsum(left_common < d)
        key = a[own] * (size + 1) + b[own]
        order = np.lexsort((rank[own], key))
        same = np.concatenate([[False], key[order][1:] == key[order][:-1]])
        out[own[order[same]], d] = True
    return out


def _resolve(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Stretches of windows that repeat an earlier one, of the phrases that share a trigger."""
    for table in _whole_triggers(batches):
        if table.num_rows < 2:
            continue
        column = {c: table.column(c).to_numpy() for c in ("doc", "tie", "at", "first", "last")}
        rank = np.empty(table.num_rows, np.int64)
        rank[np.lexsort((column["at"], column["tie"], column["doc"]))] = np.arange(table.num_rows)
        found = repeated_windows(table.column("bytes").to_pylist(), column["first"], column["last"], rank)
        padded = np.pad(found, ((0, 0), (1, 1)))
        rows, low = np.nonzero(padded[:, 1:] & ~padded[:, :-1])
        _, high = np.nonzero(padded[:, :-1] & ~padded[:, 1:])
        if len(rows):  # distances low .. high - 1
            at = column["at"][rows]
            yield pa.RecordBatch.from_arrays(
                [pa.array(column["doc"][rows]), pa.array(column["tie"][rows]), pa.array(at - high + 1), pa.array(at - low + LENGTH)],
                names=["doc", "tie", "start", "end"],
            )


def _removed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Documents without the union of their stretches."""
    for whole in batches:
        for at in range(0, whole.num_rows, 64):
            batch = whole.slice(at, 64)
            rows = []
            for doc_id, body, spans, copies in zip(*(batch.column(c).to_pylist() for c in ("doc_id", "body", "spans", "copies")), strict=True):
                kept, removed, n, done = hashlib.sha256(), 0, 0, 0
                ordered = np.array([(s["start"], s["end"]) for s in spans or []], np.int64).reshape(-1, 2)
                ordered = ordered[np.argsort(ordered[:, 0], kind="stable")]
                if len(ordered):
                    ends = np.maximum.accumulate(ordered[:, 1])
                    opens = np.concatenate([[True], ordered[1:, 0] > ends[:-1]])
                    for start, end in zip(ordered[opens, 0].tolist(), ends[np.concatenate([np.flatnonzero(opens)[1:] - 1, [len(ends) - 1]])].tolist(), strict=True):
                        kept.update(body[done:start])
                        removed, n, done = removed + end - start, n + 1, end
                kept.update(body[done:])
                size = len(body)
                rows.append((doc_id, size, removed, n, kept.hexdigest()))
                again = (doc_id, size, size, 1, hashlib.sha256(b"").hexdigest()) if size >= LENGTH else rows[-1]
                rows += [again] * (copies - 1)
            kinds = [pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.string()]
            yield pa.RecordBatch.from_arrays(
                [pa.array(v, k) for v, k in zip(zip(*rows, strict=True), kinds, strict=True)],
                names=["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256"],
            )


def _bodies(docs: DataFrame) -> DataFrame:
    """``doc_id, doc, tie, body, copies``: one row for each distinct (doc_id, text). Null ids come first in the corpus order; texts that share an id follow in
    the order of a hash (``tie``)."""
    rows = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), text_or_empty().cast("binary").alias("body"))
    place = F.coalesce("doc_id", F.lit(-(1 << 63)))
    if rows.groupBy("doc_id").agg(F.count("*").alias("n")).where("n > 1").isEmpty():
        return rows.select("doc_id", place.alias("doc"), F.lit(0).cast("bigint").alias("tie"), "body", F.lit(1).cast("bigint").alias("copies"))
    once = keep(rows.groupBy("doc_id", "body").agg(F.count("*").alias("copies")), "distinct-bodies")
    return once.select("doc_id", place.alias("doc"), F.xxhash64("body").alias("tie"), "body", "copies")


def _hot(bodies: DataFrame, often: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Stretches and phrases to compare of the triggers that occur too often for one group: as ``_classes``, by counting."""
    rows = keep(phrase_table(bodies).join(often, "trigger"), "hot-phrases")
    order = F.struct("doc", "tie", "at", "first", "last")
    classes = keep(rows.groupBy("trigger", "phrase").agg(F.min(order).alias("e")), "hot-classes")
    rows = rows.join(classes, ["trigger", "phrase"]).where(order != F.col("e"))
    return rows.select(*PHRASE), classes.select("trigger", "phrase", "e.*")


def _hot_windows(phrases: DataFrame) -> DataFrame:
    """Stretches among phrases of hot triggers, by the digest of every window."""
    d = F.explode(F.sequence(F.col("last").cast("int"), F.col("first").cast("int")))
    windows = phrases.withColumn("d", d).select(
        F.md5(F.substring(F.col("bytes"), F.col("first") - F.col("d") + 1, F.lit(LENGTH))).alias("window"), "doc", "tie", (F.col("at") - F.col("d")).alias("start")
    )
    windows = keep(windows, "hot-windows")
    earliest = windows.groupBy("window").agg(F.min(F.struct("doc", "tie", "start")).alias("e"))
    again = windows.join(earliest, "window").where(F.struct("doc", "tie", "start") != F.col("e"))
    return again.select("doc", "tie", "start", (F.col("start") + LENGTH).alias("end"))


def remove_repeats(docs: DataFrame) -> DataFrame:
    """``doc_id, n_bytes, n_removed, n_spans, kept_sha256`` for every row of ``docs``.

    A byte goes where a string of ``LENGTH`` bytes that covers it also starts earlier, in a document of smaller doc_id or further ahead in its
    own. A null text is empty; texts below ``LENGTH`` bytes lose nothing. Of rows equal in doc_id and text the first keeps its bytes.

    Triggers that occur once are dropped by a count. Equal phrases of a trigger are one entry of the dictionary, whose earliest
    place stands for all. Entries of one trigger are compared by the orders of their suffixes and prefixes, in groups of at most ``HOT``
    phrases; a trigger with more is resolved by counting its phrases' windows, which Spark sums before it shuffles. A phrase is at most 168
    bytes, so memory does not depend on how often or how long texts repeat.
    """
    bodies = _bodies(docs)
    counts = keep(phrase_table(bodies, "trigger").groupBy("trigger").agg(F.count("*").alias("n")).where("n > 1"), "triggers")
    often = keep(counts.where(F.col("n") > HOT).select("trigger"), "hot-triggers")  # few: Spark knows its size and need not move the phrases
    some_hot = not often.isEmpty()
    together = Window.partitionBy("trigger").orderBy("doc", "at")  # keeps a trigger in one partition
    rows = phrase_table(bodies).join(counts.where(F.col("n") <= HOT).select("trigger"), "trigger")
    rows = rows.withColumn("place", F.row_number().over(together)).where("place > 0").select(*PHRASE)
    schema = ", ".join(f"{c} {t}" for c, t in PHRASE.items())
    rows = keep(rows.mapInArrow(_classes, schema + ", removed boolean"), "phrases")
    removed, compared = rows.where("removed"), rows.where("NOT removed").select(*PHRASE)
    if some_hot:
        hot_removed, hot_compared = _hot(bodies, often)
        removed = removed.select(*PHRASE).unionByName(hot_removed)
        compared = compared.unionByName(hot_compared.select(*PHRASE))
    listed = compared.groupBy("doc", "tie").agg(F.collect_list(F.struct("trigger", "at", "first", "last")).alias("phrases"))
    surrounded = bodies.select("doc", "tie", "body").join(listed, ["doc", "tie"])
    schema = "trigger bigint, doc bigint, tie bigint, at bigint, first smallint, last smallint, bytes binary"
    surrounded = keep(surrounded.mapInArrow(_with_bytes, schema), "surroundings")
    cold = surrounded.join(often, "trigger", "left_anti") if some_hot else surrounded
    spans = cold.repartition("trigger").sortWithinPartitions("trigger").mapInArrow(_resolve, "doc bigint, tie bigint, start bigint, end bigint")
    stretches = [removed.select("doc", "tie", (F.col("at") - F.col("first")).alias("start"), (F.col("at") - F.col("last") + LENGTH).alias("end")), spans]
    if some_hot:
        stretches.append(_hot_windows(surrounded.join(often, "trigger", "left_semi")))
    every = stretches[0]
    for part in stretches[1:]:
        every = every.unionByName(part)
    by_doc = every.groupBy("doc", "tie").agg(F.collect_list(F.struct("start", "end")).alias("spans"))
    joined = bodies.join(by_doc, ["doc", "tie"], "left").select("doc_id", "body", "spans", "copies")
    return joined.mapInArrow(_removed, "doc_id bigint, n_bytes bigint, n_removed bigint, n_spans bigint, kept_sha256 string")
