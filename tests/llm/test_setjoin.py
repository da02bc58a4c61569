"""Chosen-path join against brute force."""
from __future__ import annotations

import random
import re

import pytest
from pyspark.sql import functions as F

from dayloom.llm import setjoin
from tests.llm.helpers import DOCUMENTS, with_clashes

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def brute(rows: list, least: float = 0.8) -> dict:
    """(class, copy_of, links) by doc_id, doc_ids being unique."""
    words = {i: tuple(WORD.findall(t or "")) for i, t in rows}
    by_words: dict = {}
    for i, w in words.items():
        by_words.setdefault(w, []).append(i)
    sets = {w: {w[k : k + 5] for k in range(len(w) - 4)} if len(w) >= 5 else {w} for w in by_words if w}
    postings: dict = {}
    for w, s in sets.items():
        for t in s:
            postings.setdefault(t, []).append(w)
    near: dict = {w: set() for w in sets}
    for w, s in sets.items():
        common: dict = {}
        for t in s:
            for o in postings[t]:
                common[o] = common.get(o, 0) + 1
        near[w] = {o for o, c in common.items() if o != w and c >= least * (len(s) + len(sets[o]) - c) - 1e-9}
    out: dict = {}
    for w, ids in by_words.items():
        if not w:
            out |= {i: (i, i, 0) for i in ids}
            continue
        seen, waiting = {w}, [w]
        while waiting:
            for o in near[waiting.pop()] - seen:
                seen.add(o)
                waiting.append(o)
        links = sum(len(by_words[o]) for o in near[w]) + len(ids) - 1
        label = min(i for o in seen for i in by_words[o])
        out |= {i: (label, min(ids), links) for i in ids}
    return out


def check(spark, rows: list) -> None:
    docs = with_clashes(spark.createDataFrame([(i, t, "en", "s", 0) for i, t in rows], DOCUMENTS))
    got = {r["doc_id"]: (r["class_id"], r["copy_of"], r["n_links"]) for r in setjoin.similar_documents(docs).collect()}
    assert got == brute(rows)


def edited(words: list, n: int, made: random.Random) -> str:
    words = list(words)
    for _ in range(n):
        words[made.randrange(len(words))] = f"e{made.randrange(10**9)}"
    return " ".join(words)


def test_given_documents(spark):
    check(spark, [(r["doc_id"], r["text"]) for r in spark.read.parquet("/root/testdata/sf0.01/documents.parquet").collect()])


def test_large_alike_groups_and_common_passages(spark, monkeypatch):
    monkeypatch.setattr(setjoin, "LEAF", 16)
    monkeypatch.setattr(setjoin, "BLOCK", 16)
    made = random.Random(4)
    text = [f"w{made.randrange(300)}" for _ in range(150)]
    rows = [edited(text, made.randrange(6), made) for _ in range(180)]  # near copies on both sides of the bound
    passage = " ".join(f"p{i}" for i in range(12))
    rows += [passage + " " + " ".join(f"v{made.randrange(10**6)}" for _ in range(made.randrange(1, 14))) for _ in range(200)]
    rows += [rows[i] for i in range(0, 60, 3)] + ["  ".join(rows[5].split())]
    rows += [None, "", " \n ", "", "one", "one", "one two three", "a b c d e", "a b c d e f", "a " * 3000, "a " * 2000, "x " * 40000 + "y"]
    check(spark, list(enumerate(rows)))


@pytest.mark.parametrize("part", [0.65, 0.9])
def test_near_copies_within_a_shared_passage(spark, monkeypatch, part):
    """Pairs that meet in buckets of the passage alone must survive the splits of these buckets."""
    monkeypatch.setattr(setjoin, "LEAF", 16)
    monkeypatch.setattr(setjoin, "BLOCK", 16)
    made = random.Random(8)
    passage = [f"p{i}" for i in range(69)]
    rest = int(65 / part) - 65
    rows = []
    for _ in range(60):
        own = [f"u{made.randrange(10**9)}" for _ in range(rest)]
        rows += [" ".join(passage + own), " ".join(passage + (own[: rest - 8] if part < 0.9 else []) + [f"z{made.randrange(10**9)}"])]
    rows += [" ".join(passage + [f"v{made.randrange(10**9)}" for _ in range(200)]) for _ in range(120)]
    docs = spark.createDataFrame([(i, t, "en", "s", 0) for i, t in enumerate(rows)], DOCUMENTS)
    sets = setjoin.keyed(docs).select("key", "shingles")
    ids = {bytes(r["key"]): r["doc_id"] for r in setjoin.keyed(docs).collect()}
    # all sets in one bucket of the first level: what meets there must meet after its splits
    one = setjoin.profiles(docs).groupBy("key").agg(F.first("sketch").alias("sketch")).withColumn("paths", F.array(F.lit(7).cast("bigint")))
    found: dict = {}
    for r in setjoin.leaves(one, lambda keys: sets.join(keys, "key", "left_semi").dropDuplicates(["key"])).collect():
        found.setdefault(r["leaf"], set()).add(ids[bytes(r["key"])])
    met = sum(any({2 * i, 2 * i + 1} <= leaf for leaf in found.values()) for i in range(60))
    assert met == 60


def test_runs_follow_the_recall():
    assert setjoin.n_runs(0.8, 1 - 1e-6) == 6 and setjoin.n_runs(0.5, 0.9) == 2


def test_repeated_rows_null_ids_and_no_rows(spark):
    long = " ".join(f"w{i}" for i in range(60))
    rows = [(1, long), (1, long), (None, long + " z"), (2, "q r"), (2, "other text of some words here"), (None, None)]
    docs = spark.createDataFrame([(i, t, "en", None, None) for i, t in rows], DOCUMENTS)
    got = sorted(str(tuple(r)[:1] + tuple(r)[3:]) for r in setjoin.similar_documents(docs).collect())
    assert got == sorted(["(1, 1, 1, 2)", "(1, 1, 1, 2)", "(None, 1, None, 2)", "(2, 2, 2, 0)", "(2, 2, 2, 0)", "(None, None, None, 0)"])
    kept = setjoin.one_of_each(with_clashes(docs))
    assert sorted(str((r["doc_id"], r["text"])) for r in kept.collect()) == sorted(
        str(r) for r in [(1, long), (2, "q r"), (2, "other text of some words here"), (None, None)]
    )
    assert setjoin.similar_documents(docs.limit(0)).count() == 0


@pytest.mark.parametrize("n", [1, 2, 40])
def test_one_of_each_class_stays(spark, n):
    made = random.Random(n)
    base = [f"w{i}" for i in range(120)]
    rows = [(i, edited(base, 1, made)) for i in range(n)] + [(100 + i, edited(base[::-1], 0, made)) for i in range(n)]
    docs = spark.createDataFrame([(i, t, "en", "s", 0) for i, t in rows], DOCUMENTS)
    found = brute(rows)
    assert sorted(r["doc_id"] for r in setjoin.one_of_each(docs).collect()) == sorted({c for c, _, _ in found.values()})
