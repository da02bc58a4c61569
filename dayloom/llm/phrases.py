"""Phrase collocations by dynamic itemset counting over cyclic scans of shards."""
from __future__ import annotations

from collections.abc import Iterator
from itertools import repeat

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from dayloom.llm.common import discard, keep, text_or_empty

LONGEST, LEAST, FIRST = 4, 30, 2000
SCALE, COVERED = 2_000_000, 80
SHARDS = 3
CHUNK = 4 << 20  # bytes of text in a chunk, about
SLOT_BITS = 25  # at most 2^25 slots of a byte each tell the scans what has reached the threshold
WAITING = 4 << 20  # places of a task that are counted together
PACK = 32 << 20  # bytes of phrases of a task that are added up together
SALTS = 64
NEVER = 255
UNKNOWN_LANG = "und"
# A-Z to a-z, the marks that end a piece to a line feed, the tab to a space.
FOLD = bytes(
    b + 32 if 65 <= b <= 90 else 10 if b in b".,;:!?\n\x0b\x0c\r" else 32 if b == 9 else b for b in range(256)
)
GOLD, M1, M2 = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB)


def _mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * M1
    x = (x ^ (x >> np.uint64(27))) * M2
    return x ^ (x >> np.uint64(31))


# ---- chunks: the words of some documents as numbers, with their own dictionary

CHUNKS = "shard int, lang string, words binary, numbers binary, n bigint"


def _chunks(shards: int):
    """Chunks of texts of one language: ``words`` are the distinct words joined by line feeds, ``numbers`` the text as 32-bit places in them. Number 0 stands
    between pieces. Documents are dealt out to the shards in turn."""
    import pyarrow.compute as pc

    def pack(shard: int, lang: str, texts: list[bytes]) -> pa.RecordBatch:
        joined = b"\n  " + b"\n".join(texts).translate(FOLD).replace(b"\n", b" \n ")  # the mark between pieces is number 0, no word is 1
        numbered = pc.split_pattern(pa.array([joined], pa.large_binary()), " ").flatten().dictionary_encode()
        numbers, found = numbered.dictionary[1:], numbered.indices.to_numpy()
        found = found[found != 1]
        both = np.concatenate([[True], found[:-1] == 0]) & (found == 0) if len(found) else found != 0
        found = found[~both]  # one mark between pieces is enough
        words = b"\n" + pc.binary_join(pa.ListArray.from_arrays(pa.array([0, len(numbers)], pa.int32()), numbers), pa.scalar(b"\n", pa.large_binary()))[0].as_py()
        row = [shard], [lang], [words], [found.astype("<i4").tobytes()], [int((found != 0).sum())]
        return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(row, (pa.int32(), pa.string(), pa.binary(), pa.binary(), pa.int64()), strict=True)], names=["shard", "lang", "words", "numbers", "n"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        waiting: dict[tuple[int, str], list[bytes]] = {}
        sizes: dict[tuple[int, str], int] = {}
        turn = total = 0
        for batch in batches:
            for lang, text in zip(batch.column("lang").to_pylist(), batch.column("text").cast(pa.binary()).to_pylist(), strict=True):
                if not text:
                    continue
                turn += 1
                key = (turn % shards, lang)
                waiting.setdefault(key, []).append(text)
                sizes[key] = sizes.get(key, 0) + len(text)
                total += len(text)
                if total >= shards * CHUNK:  # whatever the number of languages, no more than this waits
                    for one in sorted(waiting):
                        yield pack(*one, waiting[one])
                    waiting, sizes, total = {}, {}, 0
                elif sizes[key] >= CHUNK:
                    yield pack(*key, waiting.pop(key))
                    total -= sizes.pop(key)
        for one in sorted(waiting):
            yield pack(*one, waiting[one])

    return run


def chunks(docs: DataFrame, shards: int = SHARDS) -> DataFrame:
    """The texts of ``docs`` in chunks, written once by shard; later scans neither split texts nor read other shards."""
    rows = docs.select(F.coalesce(F.col("lang").cast("string"), F.lit(UNKNOWN_LANG)).alias("lang"), text_or_empty().alias("text"))
    return keep(rows.mapInArrow(_chunks(shards), CHUNKS), "chunks", ["shard"])


class Chunk:
    """A chunk's places with the keys of the phrases that start there. A key is 64 bits of a phrase, its language and length."""

    def __init__(self, lang: str, words: bytes, numbers: bytes):
        import xxhash

        self.words = words.split(b"\n")
        self.at = np.frombuffer(numbers, "<i4")
        seed = xxhash.xxh3_64_intdigest(lang.encode())
        self.hashed = np.fromiter(map(xxhash.xxh3_64_intdigest, self.words, repeat(seed)), np.uint64, len(self.words))
        self.places = np.flatnonzero(self.at)
        self.keys = self.hashed[self.at[self.places]]
        self.length = 1

    def following(self, values: np.ndarray, none: int) -> np.ndarray:
        """Of ``values`` at the places that at the place after each, ``none`` where that is not among them."""
        whole = np.full(len(self.at) + 1, none, values.dtype)
        whole[self.places] = values
        return whole[self.places + 1]

    def lengthen(self) -> None:
        """Go on to phrases of one word more. All places must be left with a place after them, so that no end of a piece is within a phrase."""
        self.length += 1
        last = self.hashed[self.at[self.places + (self.length - 1)]]
        self.keys = _mixed((self.keys * GOLD + last) + np.uint64(self.length))

    def leave(self, on: np.ndarray) -> None:
        self.places, self.keys = self.places[on], self.keys[on]


class Reached:
    """Per slot of the keys' leading bits the first scan after which a phrase of the slot had reached the threshold; what ``last`` would tell is not needed.

    Slots are shared where there are more phrases than slots: then a scan counts some phrases that need not be counted. As the number of slots is the same in all
    scans and the first scan of a slot never changes, nor does the scan by which all parts of a phrase are there; the scans of a phrase are a full cycle in any case,
    and no sum is below the true count.
    """

    def __init__(self, bits: int, first: np.ndarray, last: np.ndarray | None = None):
        self.shift, self.first = np.uint64(64 - bits), first

    @property
    def last(self) -> np.ndarray:
        return np.where(self.first == NEVER, 0, self.first)

    def of(self, keys: np.ndarray) -> np.ndarray:
        return self.first[(keys >> self.shift).astype(np.int64)]


NOTHING = Reached(1, np.full(2, NEVER, np.uint8))


def _runs(values: np.ndarray) -> np.ndarray:
    """Where each run of equal values begins."""
    return np.flatnonzero(np.concatenate([[True], values[1:] != values[:-1]])) if len(values) else np.zeros(0, np.int64)


def _added(keys: np.ndarray, n: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The distinct keys, sorted, with the sums of their numbers."""
    order = np.argsort(keys)
    keys = keys[order]
    starts = _runs(keys)
    return keys[starts], np.add.reduceat(n[order], starts, dtype=np.int64) if len(keys) else np.zeros(0, np.int64)


def _scan(shared, step: int, shards: int):
    """Counts of the active phrases of every length in the chunks of one shard: ``k, until, keys, n``, keys sorted.

    Words are active in the first cycle. A longer phrase is active from the scan after both its subphrases of one word less had reached the threshold, for one
    full cycle; ``until`` is the scan that ends it. As a slot may be filled before the words of a phrase in it are, the shorter parts count too. Up to ``WAITING`` places of several chunks are sorted and counted together.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
        reached: Reached = shared.value
        waiting: dict[tuple[int, int], list[np.ndarray]] = {}
        single: list[tuple[np.ndarray, np.ndarray]] = []
        size = 0

        def counted() -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
            if single:
                yield 1, shards - 1, *_added(*(np.concatenate(c) for c in zip(*single, strict=True)))
            for (k, until), parts in waiting.items():
                keys = np.concatenate(parts)
                parts.clear()
                keys.sort()
                starts = _runs(keys)
                yield k, until, keys[starts], np.diff(starts, append=len(keys))
            waiting.clear()
            single.clear()

        for batch in batches:
            for lang, words, numbers in zip(*(batch.column(c).to_pylist() for c in ("lang", "words", "numbers")), strict=True):
                chunk = Chunk(lang, words, numbers)
                if step < shards:
                    single.append((chunk.hashed[1:], np.bincount(chunk.at, minlength=len(chunk.words))[1:]))
                    size += len(chunk.words)
                since = reached.of(chunk.hashed)[chunk.at[chunk.places]]
                while chunk.length < LONGEST and len(chunk.places):
                    first = np.maximum(reached.of(chunk.keys), since) if chunk.length > 1 else since
                    both = np.maximum(first, chunk.following(first, NEVER))
                    on = both < step
                    chunk.leave(on)
                    chunk.lengthen()
                    since = both[on]
                    until = since.astype(np.int32) + shards
                    for end in range(step, step + shards):
                        keys = chunk.keys[until == end]
                        if len(keys):
                            waiting.setdefault((chunk.length, end), []).append(keys)
                            size += len(keys)
                if size >= WAITING:
                    yield from counted()
                    size = 0
        yield from counted()

    return run


# Counts of phrases of a length whose cycle ends at one time, or, with ``reached``, phrases that had reached the threshold after that scan; of keys in a block,
# which have their leading bits in common. Keys are 64 bits each, sorted, their numbers, at most the threshold, as many bytes as it takes.
COUNTS = "block int, k int, until int, reached int, size bigint, keys binary, n binary"
COUNTS_ARROW = pa.schema([("block", pa.int32()), ("k", pa.int32()), ("until", pa.int32()), ("reached", pa.int32()), ("size", pa.int64()), ("keys", pa.binary()), ("n", pa.binary())])


def _small(least: int) -> np.dtype:
    return np.min_scalar_type(max(1, least)).newbyteorder("<")


def _block_bits(words: int) -> int:
    return min(10, max(6, (words >> 19).bit_length()))


def _cuts(keys: np.ndarray, bits: int) -> list[int]:
    """Where each of the 2^bits blocks of sorted keys begins, and the end."""
    edges = np.arange(1 << bits, dtype=np.uint64) << np.uint64(64 - bits)
    return [*np.searchsorted(keys, edges).tolist(), len(keys)]


def _dealt(scan, bits: int, least: int):
    """What a scan counts, by blocks of keys."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for k, until, keys, n in scan(batches):
            cuts, n = _cuts(keys, bits), np.minimum(n, least).astype(_small(least))
            some = [(block, a, b) for block, (a, b) in enumerate(zip(cuts[:-1], cuts[1:], strict=True)) if a < b]
            rows = [(block, k, until, None, b - a, keys[a:b].tobytes(), n[a:b].tobytes()) for block, a, b in some]
            if rows:
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows, strict=True), COUNTS_ARROW.types, strict=True)], schema=COUNTS_ARROW)

    return run


def _merged(step: int, least: int):
    """The counts of a block added up. What has reached the threshold is told once; what ends its cycle below it is forgotten."""

    def run(table: pa.Table) -> pa.Table:
        block, rows = table.column("block")[0].as_py(), []
        known: dict[int, list[np.ndarray]] = {}
        parts: dict[tuple[int, int], list[tuple[np.ndarray, np.ndarray]]] = {}
        for k, until, reached, keys, n in zip(*(table.column(c).to_pylist() for c in ("k", "until", "reached", "keys", "n")), strict=True):
            found = np.frombuffer(keys, "<u8")
            if reached is not None:
                known.setdefault(k, []).append(found)
                rows.append((block, k, None, reached, len(found), keys, b""))
            else:
                parts.setdefault((k, until), []).append((found, np.frombuffer(n, _small(least))))
        for (k, until), some in sorted(parts.items()):
            keys, n = _added(*(np.concatenate(c) for c in zip(*some, strict=True)))
            there = n >= least
            new = np.setdiff1d(keys[there], np.concatenate([np.zeros(0, np.uint64), *known.get(k, [])]))
            if len(new):
                known.setdefault(k, []).append(new)
                rows.append((block, k, None, step, len(new), new.tobytes(), b""))
            if until > step and not there.all():
                rows.append((block, k, until, None, int((~there).sum()), keys[~there].tobytes(), n[~there].astype(_small(least)).tobytes()))
        columns = zip(*rows, strict=True) if rows else [[]] * len(COUNTS_ARROW)
        return pa.Table.from_arrays([pa.array(c, t) for c, t in zip(columns, COUNTS_ARROW.types, strict=True)], schema=COUNTS_ARROW)

    return run


def _slots(bits: int):
    """The part of the slot table that the phrases fill, by blocks of slots: ``block, first``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        size, found = 1 << min(bits, 16), {}
        for batch in batches:
            for keys, reached in zip(batch.column("keys").to_pylist(), batch.column("reached").to_pylist(), strict=True):
                slots = (np.frombuffer(keys, "<u8") >> np.uint64(64 - bits)).astype(np.int64)
                cuts = [*_runs(slots // size).tolist(), len(slots)]  # keys are sorted
                for a, b in zip(cuts[:-1], cuts[1:], strict=True):
                    first = found.setdefault(int(slots[a]) // size, np.full(size, NEVER, np.uint8))
                    mine = slots[a:b] % size
                    first[mine] = np.minimum(first[mine], reached)
        for block, first in found.items():
            yield pa.RecordBatch.from_arrays([pa.array([block], pa.int64()), pa.array([first.tobytes()])], names=["block", "first"])

    return run


def slot_table(rows: DataFrame, size: int) -> Reached:
    """The slot table of ``rows`` (``keys, reached``) with room for ``size`` phrases: at most 2^SLOT_BITS bytes, put together in tasks by blocks of slots."""
    bits = min(SLOT_BITS, max(8, (8 * size).bit_length()))
    first = np.full(1 << bits, NEVER, np.uint8)
    for row in rows.select("keys", "reached").mapInArrow(_slots(bits), "block bigint, first binary").collect():
        part = np.frombuffer(row["first"], np.uint8)
        at = row["block"] << min(bits, 16)
        first[at : at + len(part)] = np.minimum(first[at : at + len(part)], part)
    return Reached(bits, first)


def likely_phrases(parts: DataFrame, least: int = LEAST, shards: int = SHARDS, words: int | None = None) -> Reached:
    """The slots of all words and phrases of up to ``LONGEST`` words that may occur ``least`` times and more within their language. ``words``: of all, if counted.

    Scan ``t`` reads shard ``t % shards`` and counts what is active of every length at once. Counts of a phrase add up over one full cycle from its own start; a
    phrase that ends its cycle below the threshold is forgotten. The scans end when nothing has reached the threshold for a cycle.

    Counts go by blocks of keys, each length and cycle of a block as one row of sorted keys, which are added up as arrays.
    """
    context = parts.sparkSession.sparkContext
    words = word_count(parts) if words is None else words
    bits, room = _block_bits(words), words // max(1, least) // 4 + 1  # fixed, so that a phrase's slots are the same in all scans
    counts: DataFrame | None = None
    reached, shared, newest = NOTHING, context.broadcast(NOTHING), -1
    step = 0
    while step < shards or newest + shards >= step:
        scan = _dealt(_scan(shared, step, shards), bits, least)
        found = parts.where(F.col("shard") == step % shards).select("lang", "words", "numbers").mapInArrow(scan, COUNTS)
        rows = found if counts is None else counts.unionByName(found)
        now = keep(rows.groupBy("block").applyInArrow(_merged(step, least), COUNTS), f"counts-{step}")
        if counts is not None:
            discard(counts)
        counts = now
        there = counts.where("reached IS NOT NULL")
        size, newest = there.agg(F.coalesce(F.sum("size"), F.lit(0)), F.coalesce(F.max(F.when(F.col("k") < LONGEST, F.col("reached"))), F.lit(-shards - 1))).first()
        shared.unpersist()
        shared = context.broadcast(slot_table(there.where(F.col("k") < LONGEST), room) if size else NOTHING)
        step += 1
    reached = slot_table(there, size) if size else NOTHING
    discard(counts)
    return reached


def word_count(parts: DataFrame) -> int:
    return parts.agg(F.coalesce(F.sum("n"), F.lit(0))).first()[0]


# ---- exact counts of what is likely, and scores

PHRASES = "lang string, k int, phrase string, f bigint"
PHRASES_ARROW = pa.schema([("lang", pa.string()), ("k", pa.int32()), ("phrase", pa.string()), ("f", pa.int64())])


def _exact(shared):
    """Occurrences of likely phrases by their words, with their keys. Places whose keys are equal are compared word by word."""
    import pyarrow.compute as pc

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        reached: Reached = shared.value
        for batch in batches:
            for lang, words, numbers in zip(*(batch.column(c).to_pylist() for c in ("lang", "words", "numbers")), strict=True):
                chunk = Chunk(lang, words, numbers)
                texts = pa.array(chunk.words, pa.binary()).cast(pa.string())
                while True:
                    k = chunk.length
                    chunk.leave(reached.of(chunk.keys) != NEVER)
                    if not len(chunk.places):
                        break
                    order = np.argsort(chunk.keys)
                    keys, places = chunk.keys[order], chunk.places[order]
                    starts = _runs(keys)
                    n = np.diff(starts, append=len(keys))
                    odd = np.zeros(len(places), bool)
                    for j in range(k):
                        at = chunk.at[places + j]
                        odd |= at != np.repeat(at[starts], n)
                    rows = np.concatenate([starts, np.flatnonzero(odd)])
                    n = np.concatenate([n - np.add.reduceat(odd, starts, dtype=n.dtype), np.ones(int(odd.sum()), n.dtype)])
                    each = [texts.take(pa.array(chunk.at[places[rows] + j])) for j in range(k)]
                    phrase = pc.binary_join_element_wise(*each, " ") if k > 1 else each[0]
                    yield pa.RecordBatch.from_arrays(
                        [pa.array([lang] * len(n), pa.string()), pa.array(np.full(len(n), k, np.int32)), phrase, pa.array(n.astype(np.int64)), pa.array(keys[rows])],
                        names=["lang", "k", "phrase", "f", "key"],
                    )
                    if k == LONGEST:
                        break
                    chunk.leave(chunk.following(np.ones(len(chunk.places), bool), False))
                    chunk.lengthen()

    return run


PACKS = "lang string, block int, texts binary, sizes binary, f binary"
PACKS_ARROW = pa.schema([("lang", pa.string()), ("block", pa.int32()), ("texts", pa.binary()), ("sizes", pa.binary()), ("f", pa.binary())])


def _packed(exact, bits: int):
    """The phrases of several chunks added up, then by blocks of keys: a row has the phrases of a language and block, one after the other, their bytes and numbers."""

    def pack(lang: str, some: list[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = pa.Table.from_batches(some).select(["phrase", "f", "key"]).group_by("phrase", use_threads=False).aggregate([("f", "sum"), ("key", "min")])
        keys = table.column("key_min").to_numpy()
        order = np.argsort(keys)
        table = table.take(pa.array(order)).combine_chunks()
        texts = pa.chunked_array(table.column("phrase"), pa.string()).cast(pa.large_string()).combine_chunks()
        texts = texts.chunk(0) if isinstance(texts, pa.ChunkedArray) else texts
        ends = np.frombuffer(texts.buffers()[1], np.int64)[texts.offset : texts.offset + len(texts) + 1]
        data, sizes, f = texts.buffers()[2], np.diff(ends).astype("<i4"), table.column("f_sum").to_numpy().astype("<i8")
        cuts = _cuts(keys[order], bits)
        rows = [
            (lang, block, data[int(ends[a]) : int(ends[b])].to_pybytes(), sizes[a:b].tobytes(), f[a:b].tobytes())
            for block, (a, b) in enumerate(zip(cuts[:-1], cuts[1:], strict=True)) if a < b
        ]
        yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows, strict=True), PACKS_ARROW.types, strict=True)], schema=PACKS_ARROW)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        waiting: dict[str, list[pa.RecordBatch]] = {}
        size = 0
        for batch in exact(batches):
            if batch.num_rows:
                waiting.setdefault(batch.column("lang")[0].as_py(), []).append(batch)
                size += batch.nbytes
            if size >= PACK:
                for lang, some in waiting.items():
                    yield from pack(lang, some)
                waiting, size = {}, 0
        for lang, some in waiting.items():
            yield from pack(lang, some)

    return run


def _summed(least: int):
    """The phrases of a language and block that occur ``least`` times and more."""
    import pyarrow.compute as pc

    def run(table: pa.Table) -> pa.Table:
        sizes, f = (np.concatenate([np.frombuffer(x, t) for x in table.column(c).to_pylist()]) for c, t in (("sizes", "<i4"), ("f", "<i8")))
        ends = np.concatenate([[0], np.cumsum(sizes, dtype=np.int64)])
        texts = pa.LargeStringArray.from_buffers(len(sizes), pa.py_buffer(ends), pa.py_buffer(b"".join(table.column("texts").to_pylist())))
        found = pa.table({"phrase": texts, "f": f}).group_by("phrase", use_threads=False).aggregate([("f", "sum")])
        found = found.filter(pc.greater_equal(found.column("f_sum"), least))
        phrase = found.column("phrase").cast(pa.string())
        k = pc.add(pc.count_substring(phrase, " "), 1).cast(pa.int32())
        lang = pa.array([table.column("lang")[0].as_py()] * len(phrase), pa.string())
        return pa.Table.from_arrays([lang, k, phrase, found.column("f_sum")], schema=PHRASES_ARROW)

    return run


def frequent_phrases(docs: DataFrame, least: int = LEAST, shards: int = SHARDS) -> tuple[DataFrame, DataFrame]:
    """``lang, k, phrase, f`` of all words and phrases that occur ``least`` times and more, and ``lang, n`` of all words of each language."""
    parts = chunks(docs, shards)
    words = word_count(parts)
    shared = docs.sparkSession.sparkContext.broadcast(likely_phrases(parts, least, shards, words))
    counted = parts.select("lang", "words", "numbers").mapInArrow(_packed(_exact(shared), _block_bits(words)), PACKS)
    found = counted.groupBy("lang", "block").applyInArrow(_summed(least), PHRASES)
    return keep(found, "phrases"), parts.groupBy("lang").agg(F.sum("n").alias("n"))


def _part(first: Column | int, size: Column | int) -> Column:
    return F.array_join(F.slice(F.split("phrase", " "), first, size), " ")


def _decimal(c: Column | str) -> Column:
    return (F.col(c) if isinstance(c, str) else c).cast("decimal(20,0)")


def collocations(docs: DataFrame, least: int = LEAST, first: int = FIRST, shards: int = SHARDS) -> DataFrame:
    """``lang, rank, phrase, a, l, r, n, score``: the ``first`` phrases of two to four words of every language.

    Texts are lower-cased (A-Z alone) and cut into pieces at ``.,;:!?`` and line ends, pieces into words at spaces and tabs; phrases lie within a piece.
    ``a`` is the number of a phrase's occurrences, overlaps included, ``n`` that of all words of the language. Cut after some of its words a phrase scores
    ``2000000 * a`` over the sum of both parts' occurrences, rounded down; the least of the cuts counts, of equal ones the first, and ``l`` and ``r`` are of that cut.
    A phrase goes where a longer one, of up to four words, that holds it has four fifths of its occurrences and more, whether that goes or not. Order: score, then
    ``a``, both descending, then the phrase by bytes. Null texts are empty; a null language is ``und``; repeated rows count each time; a text of any length is whole; no
    rows, or none frequent enough, give none. Other columns are not read.

    ``likely_phrases`` finds what to count by dynamic itemset counting; one more pass counts that by its words, so that keys that
    meet by chance change nothing.
    """
    phrases, totals = frequent_phrases(docs, least, shards)
    long = phrases.where("k > 1")
    cuts = long.select("lang", "k", "phrase", "f", F.explode(F.sequence(F.lit(1), F.col("k") - 1)).alias("cut"))
    cuts = cuts.select("lang", "phrase", F.col("f").alias("a"), "cut", _part(1, F.col("cut")).alias("left"), _part(F.col("cut") + 1, F.col("k") - F.col("cut")).alias("right"))
    of = lambda name, count: phrases.select("lang", F.col("phrase").alias(name), F.col("f").alias(count))
    cuts = cuts.join(of("left", "l"), ["lang", "left"]).join(of("right", "r"), ["lang", "right"])
    exact = F.expr(f"CAST({SCALE} * CAST(a AS DECIMAL(20,0)) AS DECIMAL(38,0)) div CAST(CAST(l AS DECIMAL(20,0)) + r AS DECIMAL(38,0))")
    scored = cuts.select("lang", "phrase", "a", "l", "r", "cut", exact.alias("score"))
    least_cut = F.min(F.struct("score", "cut", "a", "l", "r")).alias("least")
    scored = scored.groupBy("lang", "phrase").agg(least_cut).select("lang", "phrase", "least.a", "least.l", "least.r", "least.score")
    longer = long.where("k > 2")
    inner = F.explode(F.sequence(F.lit(2), F.col("k") - 1))
    within = longer.select("lang", "k", "phrase", "f", inner.alias("size"))
    within = within.select("lang", "phrase", "f", "size", F.explode(F.sequence(F.lit(1), F.col("k") - F.col("size") + 1)).alias("start"))
    within = within.select("lang", _part(F.col("start"), F.col("size")).alias("phrase"), "f").groupBy("lang", "phrase").agg(F.max("f").alias("longer"))
    joined = scored.join(within, ["lang", "phrase"], "left")
    covered = _decimal(F.lit(100)) * _decimal("longer") >= _decimal(F.lit(COVERED)) * _decimal("a")
    left = joined.where(F.col("longer").isNull() | ~covered).drop("longer")
    return first_of_each(left, first).join(totals, "lang").select("lang", "rank", "phrase", "a", "l", "r", "n", "score")


def first_of_each(rows: DataFrame, first: int) -> DataFrame:
    """The first rows of each language with their rank: first of each of ``SALTS`` parts of a language, then of what these leave."""
    order = [F.desc("score"), F.desc("a"), F.asc("phrase")]
    salted = rows.withColumn("salt", F.pmod(F.xxhash64("phrase"), F.lit(SALTS)))
    some = salted.withColumn("rank", F.row_number().over(Window.partitionBy("lang", "salt").orderBy(*order))).where(F.col("rank") <= first).drop("rank", "salt")
    ranked = some.withColumn("rank", F.row_number().over(Window.partitionBy("lang").orderBy(*order))).where(F.col("rank") <= first)
    return ranked.withColumn("rank", F.col("rank").cast("bigint"))
