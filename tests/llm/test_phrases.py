"""Collocations against plain Python."""
from __future__ import annotations

import random
import re
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from dayloom.llm import phrases
from tests.llm.helpers import documents


def brute(rows: list[tuple], least: int, first: int) -> dict:
    counts, totals = defaultdict(Counter), Counter()
    for lang, text in rows:
        lang = "und" if lang is None else lang
        lower = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
        for piece in re.split("[.,;:!?\x0a-\x0d]", lower):
            words = re.findall("[^ \t]+", piece)
            totals[lang] += len(words)
            for k in range(1, 5):
                counts[lang].update(tuple(words[i : i + k]) for i in range(len(words) - k + 1))
    out = {}
    for lang, f in counts.items():
        ranked = []
        for p, a in f.items():
            if len(p) < 2 or a < least:
                continue
            score, _, l, r = min((2000000 * a // (f[p[:c]] + f[p[c:]]), c, f[p[:c]], f[p[c:]]) for c in range(1, len(p)))
            ranked.append((-score, -a, " ".join(p).encode(), p, l, r))
        holders = defaultdict(int)
        for p, a in f.items():
            for size in range(2, len(p)):
                for i in range(len(p) - size + 1):
                    holders[p[i : i + size]] = max(holders[p[i : i + size]], a)
        kept = sorted(x for x in ranked if 100 * holders[x[3]] < 80 * -x[1] or not holders[x[3]])
        for i, (score, a, text, _, l, r) in enumerate(kept[:first], 1):
            out[lang, i] = (text.decode(), -a, l, r, totals[lang], -score)
    return out


def texts(seed: int) -> list[str]:
    random.seed(seed)
    words = ["Aa", "b", "é", "c d", "ß", "日本", "x'y", "#", "le", "LA"]
    marks = [" ", " ", " ", " ", "  ", "\t", ". ", ",", "\n", ";\r\n", "! ", " "]
    out = ["".join(random.choice(words) + random.choice(marks) for _ in range(random.randint(0, 80))) for _ in range(500)]
    return out + [None, "", " ", ".", "...\n", "a a a a a a a a a a a a a a a a a a a a a a", "the same phrase here " * 40, "z y x w v u. " * 45, "w" * 9000 + " b"]


def got(df) -> dict:
    return {(r["lang"], r["rank"]): tuple(r)[2:] for r in df.collect()}


@pytest.mark.parametrize("least, first, shards", [(30, 2000, 3), (16, 20, 1), (24, 60, 4)])
def test_collocations_equal_plain_python(spark, monkeypatch, least, first, shards):
    monkeypatch.setattr(phrases, "CHUNK", 600)
    rows = documents(spark, texts(least), extra=True)
    lang = F.when(F.col("doc_id") % 7 == 0, None).when(F.col("doc_id") % 3 == 0, "fr").otherwise("en")
    docs = rows.withColumn("lang", lang)
    docs = docs.unionAll(docs.limit(5)).repartition(5)
    want = brute([(r["lang"], r["text"]) for r in docs.collect()], least, first)
    assert len(want) > 20 and len({x for x, _ in want}) > 1
    assert got(phrases.collocations(docs, least, first, shards)) == want


def test_nothing_to_find(spark):
    docs = documents(spark, [None, "", "a b c"], extra=True)
    assert phrases.collocations(docs).count() == 0 and phrases.collocations(docs.limit(0)).count() == 0


def test_shared_slots_and_equal_keys_change_nothing(spark, monkeypatch):
    monkeypatch.setattr(phrases, "SLOT_BITS", 3)
    docs = documents(spark, texts(3), extra=True)
    want = brute([(r["lang"], r["text"]) for r in docs.collect()], 12, 50)
    assert got(phrases.collocations(docs, 12, 50)) == want
    monkeypatch.setattr(phrases, "slot_table", lambda rows, size: phrases.Reached(1, np.zeros(2, np.uint8), np.zeros(2, np.uint8)))
    assert got(phrases.collocations(docs, 12, 50)) == want  # the exact pass alone then counts all there is


def test_places_with_equal_keys_are_told_apart():
    class Shared:
        value = phrases.Reached(1, np.zeros(2, np.uint8), np.zeros(2, np.uint8))

    chunk = list(phrases._chunks(1)(iter([pa.RecordBatch.from_pydict({"lang": ["en"], "text": ["a b a b. a c"]})])))[0]
    real = phrases.Chunk.lengthen

    def same(self):
        real(self)
        self.keys = np.zeros_like(self.keys)

    phrases.Chunk.lengthen = same
    try:
        rows = [r for b in phrases._exact(Shared)(iter([chunk])) for r in b.to_pylist()]
    finally:
        phrases.Chunk.lengthen = real
    found = Counter()
    for r in rows:
        found[r["phrase"]] += r["f"]
    assert found == {"a": 3, "b": 2, "c": 1, "a b": 2, "b a": 1, "a c": 1, "a b a": 1, "b a b": 1, "a b a b": 1}


def test_long_phrases_start_before_short_ones_are_done(spark):
    """A phrase whose words are frequent in the first shard is counted from the second scan on."""
    docs = documents(spark, ["one two three four"] * 400)
    steps = []
    real = phrases._scan

    def watch(shared, step, shards):
        steps.append(step)
        return real(shared, step, shards)

    phrases._scan = watch
    try:
        reached = phrases.likely_phrases(phrases.chunks(docs, 4), 30, 4)
    finally:
        phrases._scan = real
    assert max(reached.last) <= 7 and len(steps) <= 8  # all four lengths within two cycles, not four


def test_counts_move_by_blocks_not_by_phrases(spark, monkeypatch):
    docs = documents(spark, [" ".join(f"w{(7 * i + j) % 2000}" for j in range(60)) for i in range(4000)])
    kept, rows = [], {}
    real = phrases.keep

    def watch(df, label, by=()):
        out = real(df, label, by)
        kept.append(label)
        if label.startswith("counts"):
            rows[label] = out.count()
        return out

    monkeypatch.setattr(phrases, "keep", watch)
    found, totals = phrases.frequent_phrases(docs)
    assert found.count() == 8000 and totals.first()["n"] == 240_000
    assert "counts-0" in rows and max(rows.values()) <= 1000  # 2,000 words and as many phrases of each length


def test_shared_slots_do_not_prolong_a_cycle():
    """Once the cycle after the first scan of a slot is over, what reaches the threshold later in that slot starts no other."""

    class Shared:
        value = phrases.Reached(1, np.zeros(2, np.uint8), np.full(2, 5, np.uint8))

    chunk = list(phrases._chunks(1)(iter([pa.RecordBatch.from_pydict({"lang": ["en"], "text": ["a b a b"]})])))[0]
    assert list(phrases._scan(Shared, 3, 3)(iter([chunk]))) and not list(phrases._scan(Shared, 4, 3)(iter([chunk])))


def told(shard: list[pa.RecordBatch], least: int, bits: int) -> Counter:
    """How many phrases of each length the scans tell, with 2^bits slots; ``shard`` has a chunk for each shard."""

    class Shared:
        value = phrases.NOTHING

    state, shards = [], len(shard)
    for step in range(4 * shards):
        batches = phrases._dealt(phrases._scan(Shared, step, shards), 6, least)(iter([shard[step % shards]]))
        blocks = {}
        for r in [r for b in batches for r in b.to_pylist()] + state:
            blocks.setdefault(r["block"], []).append(r)
        state = [r for rows in blocks.values() for r in phrases._merged(step, least)(pa.Table.from_pylist(rows, phrases.COUNTS_ARROW)).to_pylist()]
        first = np.full(1 << bits, phrases.NEVER, np.uint8)
        for r in state:
            if r["reached"] is not None:
                slots = (np.frombuffer(r["keys"], "<u8") >> np.uint64(64 - bits)).astype(np.int64)
                first[slots] = np.minimum(first[slots], r["reached"])
        Shared.value = phrases.Reached(bits, first)
    assert all(r["reached"] is not None for r in state)
    out = Counter()
    for r in state:
        out[r["k"]] += r["size"]
    return out


def one_chunk(text: str) -> pa.RecordBatch:
    return list(phrases._chunks(1)(iter([pa.RecordBatch.from_pydict({"lang": ["en"], "text": [text]})])))[0]


def test_a_phrase_counts_whatever_scan_completes_its_parts():
    shard = [one_chunk(t) for t in ["a b c. " * 4, "a b. a b c", "c a b. x"]]
    assert told(shard, 5, 16) == {1: 3, 2: 2, 3: 1}  # a, b, c; a b and b c; a b c


@pytest.mark.parametrize("bits", [2, 4, 6, 7, 8, 9, 12, 20])
def test_no_phrase_is_missed_where_slots_are_shared(bits):
    """Also where the slot of a phrase is filled before its words have reached the threshold."""
    random.seed(bits)
    for _ in range(3):
        texts = []
        for shard in range(3):
            pieces = [" ".join(random.choice("abcdefghij") + str(random.randint(0, 5)) for _ in range(8)) for _ in range(150)]
            texts.append(". ".join([*pieces, *[f"late{i} run{i} on{i} and{i}" for i in range(20) for _ in range((3, 3, 6)[shard - i % 3])], *["again " * 5] * shard]))
        f = Counter()
        for text in texts:
            for piece in text.split("."):
                words = piece.split()
                for k in range(1, 5):
                    f.update(tuple(words[i : i + k]) for i in range(len(words) - k + 1))
        assert told([one_chunk(t) for t in texts], 10, bits) == Counter(len(p) for p, n in f.items() if n >= 10)
