"""Spelling variants against plain Python."""
from __future__ import annotations

import random
import re
import zlib
from collections import Counter

import numpy as np
import pytest

from dayloom.llm import spelling
from tests.llm.helpers import DOCUMENTS, documents, with_clashes


def slips(doc_id, text) -> list[str]:
    out = []
    for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
        run = re.sub("[A-Z]", lambda m: m[0].lower(), run)
        h = zlib.crc32(f"{'' if doc_id is None else doc_id}:{run}".encode())
        if h % 199 == 0:
            run = run[: h % len(run)] + run[h % len(run) + 1 :]
        if len(run) >= 6:
            out.append(run)
    return out


def near(a: str, b: str) -> bool:
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b, strict=True)) == 1
    a, b = sorted((a, b), key=len)
    return len(b) == len(a) + 1 and any(b[:i] + b[i + 1 :] == a for i in range(len(b)))


def brute(n: dict[str, int]) -> dict[str, tuple]:
    rows = {}
    for w in n:
        others = sorted((-n[o], o) for o in n if abs(len(o) - len(w)) <= 1 and near(o, w))
        fits = others and -others[0][0] >= 5 * n[w]
        rows[w] = (n[w], len(others), others[0][1] if fits else None, -others[0][0] if fits else None)
    out = {}
    for w in n:
        root = w
        while rows[root][2] is not None:
            root = rows[root][2]
        out[w] = (*rows[w], root)
    return out


def variants(size: int, seed: int) -> list[str]:
    """Words close to each other: edits of a few stems, anagrams among them."""
    random.seed(seed)
    stems = ["banana", "ananas", "strasse", "straße", "éclaire", "reserver", "reverser", "aaaaaaa", "z" * 300]
    words = set(stems)
    while len(words) < size:
        w = list(random.choice(sorted(words)))
        at = random.randrange(len(w))
        kind = random.randrange(4)
        if kind == 0:
            w[at] = random.choice("abeinrstßé")
        elif kind == 1:
            w.insert(at, random.choice("abeinrstßé"))
        elif kind == 2:
            random.shuffle(w)
        elif len(w) > 6:
            del w[at]
        words.add("".join(w))
    return sorted(words)


def test_documents_give_what_plain_python_gives(spark):
    random.seed(4)
    words = variants(150, 1)
    texts = [" ".join(random.choices(words, [1 / (i + 1) for i in range(len(words))], k=120)) for _ in range(60)]
    texts += [None, "", "  ", "x", "ABCDEFÀ×÷ ABCDEFÀ×÷, abcdefà" * 8, "word" * 20000 + " İstanbulſ", texts[0], texts[0].upper()]
    docs = documents(spark, texts, extra=True)
    nameless = spark.createDataFrame([(None, "banana " * 30, None, None, None)] * 3, DOCUMENTS)
    docs = docs.unionAll(docs.limit(9)).unionAll(with_clashes(nameless).select(*docs.columns))
    n = Counter(w for r in docs.select("doc_id", "text").collect() for w in slips(r["doc_id"], r["text"]))
    want = brute({w: c for w, c in n.items() if c >= 5})
    got = {r["word"]: tuple(r)[1:] for r in spelling.spelling_variants(docs).collect()}
    assert got == want and len(want) > 80 and any(r[2] for r in want.values())
    assert spelling.spelling_variants(docs.limit(0)).count() == 0
    assert spelling.spelling_variants(docs.where("text IS NULL")).count() == 0


def test_many_cells_and_blocks_find_every_near_word(spark, monkeypatch):
    monkeypatch.setattr(spelling, "CELL", 40)
    monkeypatch.setattr(spelling, "LEAF", 4)
    monkeypatch.setattr(spelling, "QUERIES_AT_ONCE", 16)
    random.seed(5)
    n = {w: random.choice([5, 6, 30, 30, 200]) for w in variants(1200, 2)}
    df = spark.createDataFrame(list(n.items()), "word string, n bigint")
    assert len(spelling.plan_cells(df).trees) > 2
    got = {r["word"]: (r["n_near"], r["form"], r["form_n"]) for r in spelling.near_words(df).collect()}
    for w in n:
        others = sorted((-n[o], o) for o in n if abs(len(o) - len(w)) <= 1 and near(o, w))
        assert got.get(w) == ((len(others), others[0][1], -others[0][0]) if others else None), w


@pytest.mark.parametrize("leaf", [1, 3, 50])
def test_the_tree_prunes_no_near_word(leaf):
    words = [w.encode("latin-1") for w in variants(400, 3) if len(w) in (6, 7, 8)]
    points = spelling.letter_counts(words)
    tree = spelling.Tree(points, leaf)
    assert sorted(np.concatenate(tree.leaves)) == list(range(len(words)))
    visited = 0
    for more, less in ((1, 1), (1, 0), (0, 1)):
        seen = {(int(q), int(p)) for at, rows in tree.search(points, more, less) for q in rows for p in tree.leaves[at]}
        visited += len(seen)
        difference = points[:, None, :].astype(int) - points[None, :, :]
        close = (np.maximum(-difference, 0).sum(2) <= more) & (np.maximum(difference, 0).sum(2) <= less)
        assert {(int(q), int(p)) for q, p in zip(*np.nonzero(close), strict=True)} <= seen
    assert leaf == 50 or visited < 1.5 * len(words) ** 2  # of three times as many


def test_equal_counts_end_in_one_leaf():
    words = [b"banana", b"nabana", b"aaabnn"] * 20
    tree = spelling.Tree(spelling.letter_counts(words), 2)
    assert len(tree.leaves) == 1
