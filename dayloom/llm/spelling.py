"""Spelling variants: words one edit apart, found in k-d trees over their letter counts."""
from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from dayloom.llm.common import keep, text_or_empty

LEAST_LENGTH, LEAST_COUNT, TIMES = 6, 5, 5
DROPPED = 199  # one letter goes where this divides the checksum
LETTERS = 256  # words are runs of Latin-1 letters; a letter is its code point
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
CELL = 2048  # words of one length in a cell, where that takes no more than MOST_CELLS cells; beyond, cells grow
MOST_CELLS = 4096
SAMPLE = 24  # sampled words for each cell, to place the cuts: at most MOST_CELLS * SAMPLE of all words
LEAF = 48  # words in a leaf of the tree within a cell
QUERIES_AT_ONCE = 4096
CELLS_AT_ONCE = 1 << 24


def occurrences(docs: DataFrame) -> DataFrame:
    """``word`` for every run of letters that gives one, once for each time it occurs.

    A run is lower-cased (A-Z alone); where ``DROPPED`` divides the checksum of the document and the run, the run loses the letter the
    checksum points to, as a slip of the pen would. A null doc_id is written as an empty string.
    """
    lower = F.translate(text_or_empty(), UPPER, LOWER)
    runs = F.regexp_extract_all(lower, F.lit(r"[a-zÀ-ÿ]{%d,}" % LEAST_LENGTH), F.lit(0))
    run, size = F.col("run"), F.length("run")
    rows = docs.select(F.concat(F.coalesce(F.col("doc_id").cast("string"), F.lit("")), F.lit(":")).alias("doc"), F.explode(runs).alias("run"))
    hashed = rows.select("run", F.crc32(F.concat("doc", "run").cast("binary")).alias("h"))
    place = F.pmod(F.col("h"), size).cast("int")
    slipped = F.concat(run.substr(F.lit(1), place), run.substr(place + 2, size))
    words = hashed.select(F.when(F.col("h") % DROPPED == 0, slipped).otherwise(run).alias("word"))
    return words.where(F.length("word") >= LEAST_LENGTH)


def vocabulary(docs: DataFrame, least: int = LEAST_COUNT) -> DataFrame:
    """``word, n`` of the words that occur ``least`` times and more."""
    return occurrences(docs).groupBy("word").agg(F.count("*").alias("n")).where(F.col("n") >= least)


def letter_counts(words: list[bytes]) -> np.ndarray:
    """How often each letter is in each word, a row a word."""
    sizes = np.fromiter(map(len, words), np.int64, len(words))
    letters = np.frombuffer(b"".join(words), np.uint8)
    cells = np.repeat(np.arange(len(words)), sizes) * LETTERS + letters
    kind = np.uint8 if sizes.max(initial=0) < 256 else np.int32
    return np.bincount(cells, minlength=len(words) * LETTERS).reshape(len(words), LETTERS).astype(kind)


class Tree:
    """A k-d tree over letter counts. A node is cut at a count of the letter that parts it most evenly; it is a leaf when it is small enough or all
    its counts are equal. ``search`` hands each leaf the queries that its box does not rule out."""

    def __init__(self, points: np.ndarray, leaf: int):
        self.cuts: list[tuple[int, int, int, int]] = []  # letter, largest count on the left, left and right node; letter -1: left is the leaf's number
        self.leaves: list[np.ndarray] = []
        self.used = np.flatnonzero(points.any(0))  # letters that no word has cannot part the words
        self._grow(points[:, self.used], np.arange(len(points)), leaf)

    def _grow(self, points: np.ndarray, rows: np.ndarray, leaf: int) -> int:
        node = len(self.cuts)
        self.cuts.append((-1, 0, len(self.leaves), 0))
        part = points[rows]
        letter, most = self._best_cut(part) if len(rows) > leaf else (-1, 0)
        if letter < 0:
            self.leaves.append(rows)
            return node
        low = part[:, letter] <= most
        left = self._grow(points, rows[low], leaf)
        right = self._grow(points, rows[~low], leaf)
        self.cuts[node] = (int(self.used[letter]), most, left, right)
        return node

    @staticmethod
    def _best_cut(part: np.ndarray) -> tuple[int, int]:
        best, at = 0, (-1, 0)
        for most in range(4):  # few words hold a letter more often; the last cut below is for those
            small = np.minimum((part <= most).sum(0), (part > most).sum(0))
            letter = int(small.argmax())
            if small[letter] > best:
                best, at = int(small[letter]), (letter, most)
        if best == 0:
            spread = part.max(0).astype(np.int64) - part.min(0)
            letter = int(spread.argmax())
            if spread[letter] > 0:
                column = np.sort(part[:, letter])
                at = (letter, int(min(column[len(column) // 2], column[-1] - 1)))
        return at

    def search(self, queries: np.ndarray, more: int, less: int) -> Iterator[tuple[int, np.ndarray]]:
        """(leaf, rows of ``queries``) for each leaf whose box may hold a word with at most ``more`` letters that the query lacks and ``less`` fewer.

        A box that a cut bounds from below needs as many further letters as the query is short of; these distances add over the letters of the cuts
        above, and the box is pruned where they pass the bound.
        """
        rows = np.arange(len(queries))
        zero = np.zeros(len(queries), np.int32)
        stack = [(0, rows, zero, zero, {})]
        while stack:
            node, rows, up, down, box = stack.pop()
            letter, most, left, right = self.cuts[node]
            if letter < 0:
                yield left, rows
                continue
            have = queries[rows, letter].astype(np.int32)
            low, high = box.get(letter, (0, 1 << 30))
            for child, new in ((left, (low, most)), (right, (most + 1, high))):
                lacks = np.maximum(new[0] - have, 0) - np.maximum(low - have, 0)
                excess = np.maximum(have - new[1], 0) - np.maximum(have - high, 0)
                fine = (up + lacks <= more) & (down + excess <= less)
                if fine.any():
                    stack.append((child, rows[fine], (up + lacks)[fine], (down + excess)[fine], {**box, letter: new}))


def one_edit(left: np.ndarray, right: np.ndarray) -> np.ndarray:
    """Which rows of two letter matrices are one edit apart: one replaced letter, or one letter more on the right."""
    if left.shape[1] == right.shape[1]:
        return (left != right).sum(1) == 1
    head = np.minimum.accumulate(left == right[:, :-1], axis=1).sum(1)
    tail = np.minimum.accumulate((left == right[:, 1:])[:, ::-1], axis=1).sum(1)
    return head + tail >= left.shape[1]


def _matrix(words: list[bytes]) -> np.ndarray:
    return np.frombuffer(b"".join(words), np.uint8).reshape(len(words), -1)


class Cell:
    """The words of one length in one cell, with their tree."""

    def __init__(self, words: list[bytes], counts: np.ndarray):
        self.words, self.counts, self.letters = words, counts, _matrix(words)
        self.vectors = letter_counts(words)
        self.tree = Tree(self.vectors, LEAF)

    def near(self, words: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """(query, word) rows of all pairs one edit apart; the queries are of one length."""
        mine, size, vectors = _matrix(words), len(words[0]), letter_counts(words)
        length = self.letters.shape[1]
        # letters in common: all of the shorter word, or all but the replaced one
        common = min(size, length) - (size == length)
        found: list[tuple[np.ndarray, np.ndarray]] = []
        for leaf, rows in self.tree.search(vectors, int(length >= size), int(length <= size)):
            points = self.tree.leaves[leaf]
            theirs = self.vectors[points]
            used = np.flatnonzero(theirs.any(0))
            # letter counts in unary, so that the product of two rows is the number of letters in common
            steps = np.arange(1, int(theirs.max()) + 1)
            unary = (theirs[:, used, None] >= steps).reshape(len(points), -1).astype(np.float32)
            at_once = max(1, CELLS_AT_ONCE // max(1, unary.shape[1]))
            for start in range(0, len(rows), at_once):
                some = rows[start : start + at_once]
                asked = (vectors[some][:, used, None] >= steps).reshape(len(some), -1).astype(np.float32)
                q, p = np.nonzero(asked @ unary.T == common)
                if not len(q):
                    continue
                q, p = some[q], points[p]
                left, right = mine[q], self.letters[p]
                fine = one_edit(left, right) if size <= length else one_edit(right, left)
                found.append((q[fine], p[fine]))
        if not found:
            return np.zeros(0, np.int64), np.zeros(0, np.int64)
        return np.concatenate([q for q, _ in found]), np.concatenate([p for _, p in found])


class Cells:
    """For each length the tree that deals its words out to cells; a length without one is a single cell."""

    def __init__(self, trees: dict[int, Tree]):
        self.trees = trees
        self.first: dict[int, int] = {}
        at = 0
        for length in sorted(trees):
            self.first[length] = at
            at += len(trees[length].leaves)
        for tree in trees.values():
            tree.leaves = [np.zeros(0, np.int64)] * len(tree.leaves)  # the sampled words are not needed any more

    def reached(self, vectors: np.ndarray, size: int, length: int) -> Iterator[tuple[int, np.ndarray]]:
        """(cell, rows) for the words of ``size`` letters whose near words of ``length`` letters may be there."""
        if length not in self.trees:
            yield -length, np.arange(len(vectors))
            return
        for leaf, rows in self.trees[length].search(vectors, int(length >= size), int(length <= size)):
            yield self.first[length] + leaf, rows

    def own(self, vectors: np.ndarray, length: int) -> Iterator[tuple[int, np.ndarray]]:
        if length not in self.trees:
            yield -length, np.arange(len(vectors))
            return
        for leaf, rows in self.trees[length].search(vectors, 0, 0):
            yield self.first[length] + leaf, rows


def plan_cells(words: DataFrame) -> Cells:
    """Cells for a table of words: lengths are counted, and trees of at most ``MOST_CELLS`` leaves in all are grown over a sample of
    ``SAMPLE`` words for each cell. The sample places the cuts only; every word is dealt out and searched."""
    sizes = words.groupBy(F.length("word").alias("length")).agg(F.count("*").alias("words"))
    total = words.count()
    cell = max(CELL, total // MOST_CELLS)
    large = {r["length"]: r["words"] for r in sizes.where(F.col("words") > cell).collect()}  # at most total / cell of them
    if not large:
        return Cells({})
    chance = min(1.0, SAMPLE / cell)
    drawn = F.pmod(F.xxhash64("word"), F.lit(1 << 20)) < int(chance * (1 << 20))
    sample = words.where(F.length("word").isin(list(large)) & drawn).select("word").collect()
    by_length: dict[int, list[bytes]] = {length: [] for length in large}
    for row in sorted(sample):
        by_length[len(row["word"])].append(row["word"].encode("latin-1"))
    return Cells({n: Tree(letter_counts(found), SAMPLE) for n, found in by_length.items() if found})


def _by_length(words: list[bytes]) -> Iterator[tuple[int, np.ndarray]]:
    sizes = np.fromiter(map(len, words), np.int64, len(words))
    for size in np.unique(sizes):
        yield int(size), np.flatnonzero(sizes == size)


def _route(shared):
    """Every word as a member of its own cell, and as a query of each cell that may hold near words."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cells: Cells = shared.value
        for batch in batches:
            words = [w.encode("latin-1") for w in batch.column("word").to_pylist()]
            for size, rows in _by_length(words):
                for start in range(0, len(rows), QUERIES_AT_ONCE):
                    part = rows[start : start + QUERIES_AT_ONCE]
                    vectors = letter_counts([words[i] for i in part])
                    dealt = [(cell, 0, part[found]) for cell, found in cells.own(vectors, size)]
                    for length in (size - 1, size, size + 1):
                        dealt += [(cell, 1, part[found]) for cell, found in cells.reached(vectors, size, length)]
                    taken = pa.array(np.concatenate([found for _, _, found in dealt]))
                    lengths = [len(found) for _, _, found in dealt]
                    yield pa.RecordBatch.from_arrays(
                        [
                            pa.array(np.repeat([cell for cell, _, _ in dealt], lengths), pa.int64()),
                            pa.array(np.repeat([role for _, role, _ in dealt], lengths), pa.int32()),
                            batch.column("word").take(taken), batch.column("n").take(taken),
                        ],
                        names=["cell", "role", "word", "n"],
                    )

    return run


NEAR = "word string, n_near bigint, form string, form_n bigint"


def _search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """For each query of a cell the number of its near words there and the best of them. Rows come by cell and block, members first; only the members
    of one cell are held."""
    at, members, counts, cell = None, [], [], None
    for batch in batches:
        keys = list(zip(batch.column("cell").to_pylist(), batch.column("block").to_pylist(), strict=True))
        roles, n = batch.column("role").to_pylist(), batch.column("n").to_numpy()
        words = [w.encode("latin-1") for w in batch.column("word").to_pylist()]
        start = 0
        while start < len(words):
            end = start + 1
            while end < len(words) and keys[end] == keys[start] and roles[end] == roles[start] and end - start < QUERIES_AT_ONCE:
                end += 1
            if keys[start] != at:
                at, members, counts, cell = keys[start], [], [], None
            if roles[start] == 0:
                members += words[start:end]
                counts.append(n[start:end])
            elif members:
                if cell is None:
                    cell = Cell(members, np.concatenate(counts))
                yield from _answers(cell, words[start:end])
            start = end


def _answers(cell: Cell, queries: list[bytes]) -> Iterator[pa.RecordBatch]:
    for _, rows in _by_length(queries):
        asked = [queries[i] for i in rows]
        q, p = cell.near(asked)
        if not len(q):
            continue
        best: dict[int, tuple[int, bytes]] = {}
        for i, j in zip(q.tolist(), p.tolist(), strict=True):
            offer = (-int(cell.counts[j]), cell.words[j])  # Latin-1 order is code-point order
            if i not in best or offer < best[i]:
                best[i] = offer
        found = np.bincount(q, minlength=len(asked))
        order = sorted(best)
        yield pa.RecordBatch.from_arrays(
            [
                pa.array([asked[i].decode("latin-1") for i in order], pa.string()), pa.array(found[order], pa.int64()),
                pa.array([best[i][1].decode("latin-1") for i in order], pa.string()), pa.array([-best[i][0] for i in order], pa.int64()),
            ],
            names=["word", "n_near", "form", "form_n"],
        )


def near_words(words: DataFrame) -> DataFrame:
    """``word, n_near, form, form_n`` for each of ``words`` (``word, n``; distinct) with a word one edit away: how many there are, and that of the
    largest n, the first in code-point order among equals.

    One edit changes the letter counts by two at most in sum: a word has its near words of the same length where one letter more
    and one less are allowed, those one letter longer or shorter where one more or one less is. So a word is sent to the cells of these three lengths
    whose boxes are that close, and there to the leaves; letters in common and then their order decide. Cells hold members of one length, about ``CELL``
    of them; the queries of a cell are dealt out in blocks of that many, each with the members.
    """
    session = words.sparkSession
    shared = session.sparkContext.broadcast(plan_cells(words))
    dealt = keep(words.select("word", "n").mapInArrow(_route(shared), "cell bigint, role int, word string, n bigint"), "cells")
    sizes = dealt.groupBy("cell").agg(F.count_if(F.col("role") == 0).alias("members"), F.count_if(F.col("role") == 1).alias("queries"))
    sizes = sizes.where("members > 0").select("cell", F.ceil(F.col("queries") / F.greatest("members", F.lit(CELL))).cast("int").alias("blocks"))
    placed = dealt.join(sizes, "cell")
    block = F.pmod(F.xxhash64("word"), F.col("blocks")).cast("int")
    blocks = F.when(F.col("role") == 0, F.sequence(F.lit(0), F.col("blocks") - 1)).otherwise(F.array(block))
    placed = placed.where("blocks > 0").select("cell", "role", "word", "n", F.explode(blocks).alias("block"))
    sorted_rows = placed.repartition("cell", "block").sortWithinPartitions("cell", "block", "role")
    found = sorted_rows.mapInArrow(_search, NEAR)
    best = F.min(F.struct((-F.col("form_n")).alias("order"), F.col("form").alias("form")))
    total = found.groupBy("word").agg(F.sum("n_near").alias("n_near"), best.alias("best"))
    return total.select("word", "n_near", F.col("best.form").alias("form"), (-F.col("best.order")).alias("form_n"))


def roots(forms: DataFrame) -> DataFrame:
    """``word, root`` for ``word, form``: the last word that following forms leads to. Every round follows twice as many; as n grows along
    the forms there are no rings."""
    now = keep(forms.select("word", F.col("form").alias("root")), "roots")
    while True:
        further = now.select(F.col("word").alias("root"), F.col("root").alias("next"))
        joined = keep(now.join(further, "root", "left").select("word", F.coalesce("next", "root").alias("root"), F.col("next").isNotNull().alias("moved")), "roots")
        now = joined.select("word", "root")
        if joined.where("moved").isEmpty():
            return now


def spelling_variants(docs: DataFrame, least: int = LEAST_COUNT, times: int = TIMES) -> DataFrame:
    """``word, n, n_near, form, form_n, root`` for every word of ``LEAST_LENGTH`` letters and more that occurs ``least`` times and more.

    Two words are near if one inserted, deleted or replaced letter makes one of the other. The form of a word is its near word of the
    largest ``n`` (of equals the first in code-point order) where that is ``times`` times its own or more, else null; the root is the word that following forms
    ends at, the word itself without a form. Null and empty texts have no words; repeated rows count each time; words of any length are whole.
    No rows, or none with words, give none. Columns other than ``doc_id`` and ``text`` are not read.

    Words meet counts before the first shuffle. The vocabulary is written once; near words are searched as ``near_words`` says, without
    pairs as rows: a cell answers each query with a count and its best word.
    """
    words = keep(vocabulary(docs, least), "vocabulary")
    near = words.join(near_words(words).withColumnRenamed("word", "_word"), F.col("word") == F.col("_word"), "left").drop("_word")
    fits = F.col("form_n") >= times * F.col("n")
    rows = keep(
        near.select("word", "n", F.coalesce("n_near", F.lit(0)).cast("bigint").alias("n_near"), F.when(fits, F.col("form")).alias("form"), F.when(fits, F.col("form_n")).alias("form_n")),
        "forms",
    )
    ends = roots(rows.where("form IS NOT NULL"))
    joined = rows.join(ends.select(F.col("word").alias("_word"), "root"), F.col("word") == F.col("_word"), "left")
    return joined.select("word", "n", "n_near", "form", "form_n", F.coalesce("root", "word").alias("root"))
