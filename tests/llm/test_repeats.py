"""Removal of repeated strings against a table of all windows."""
from __future__ import annotations

import hashlib
import random

import numpy as np
import pytest

from dayloom.llm import repeats
from tests.llm.helpers import DOCUMENTS, with_clashes


def brute(rows: list, length: int = 100) -> list:
    seen: set = set()
    out = []
    for i, t in sorted(rows, key=lambda r: (r[0] is not None, r[0])):
        body = (t or "").encode()
        gone = bytearray(len(body))
        for p in range(len(body) - length + 1):
            window = body[p : p + length]
            if window in seen:
                gone[p : p + length] = b"\1" * length
            seen.add(window)
        kept = bytes(b for b, g in zip(body, gone, strict=True) if not g)
        spans = sum(g and (not k or not gone[k - 1]) for k, g in enumerate(gone))
        out.append((i, len(body), sum(gone), spans, hashlib.sha256(kept).hexdigest()))
    return sorted(out, key=str)


def check(spark, rows: list, parts: int = 5) -> None:
    docs = with_clashes(spark.createDataFrame([(i, t, "en", "s", 0) for i, t in rows], DOCUMENTS)).repartition(parts)
    got = sorted((tuple(r) for r in repeats.remove_repeats(docs).collect()), key=str)
    assert got == brute(rows)


def made_rows() -> list:
    made = random.Random(6)
    word = lambda: "".join(made.choice("abcdeé ") for _ in range(made.randrange(1, 9)))
    text = lambda n: " ".join(word() for _ in range(n))
    passages = [text(40) for _ in range(6)] + ["x" * 130, "ab" * 90, "\0" * 140, text(14)]
    rows = [text(60) for _ in range(12)]
    for _ in range(60):
        parts = [text(made.randrange(0, 30)) for _ in range(3)]
        for p in made.sample(passages, 2):
            cut = made.randrange(0, 30)
            parts.insert(made.randrange(len(parts)), p[cut:] if made.random() < 0.5 else p)
        rows.append("".join(parts))
    base = rows[3]
    for k in range(10):  # near copies
        at = made.randrange(len(base))
        rows.append(base[:at] + f"#{k}" + base[at + 1 :])
    rows += [rows[5], rows[5], "a" * 5000, "a" * 99, "a" * 100, "abc" * 2000, "b" + "abc" * 50, None, "", None, "é" * 120, "de " * 400 + "end"]
    return list(enumerate(rows))


def test_planted_repeats(spark):
    check(spark, made_rows())


def test_hot_triggers_take_the_counting_way(spark, monkeypatch):
    monkeypatch.setattr(repeats, "HOT", 3)
    check(spark, made_rows())


def test_given_documents(spark):
    check(spark, [(r["doc_id"], r["text"]) for r in spark.read.parquet("/root/testdata/sf0.001/documents.parquet").collect()])


def test_null_and_repeated_ids(spark):
    long = " ".join(str(i * i) for i in range(200))
    rows = [(None, long), (4, long), (4, long), (4, long[:50]), (4, long[:50]), (9, long[1:])]
    check(spark, rows)
    rows = [(4, long), (4, "z" + long)]  # one id, two texts: their order is the library's own, but only one is kept whole
    docs = spark.createDataFrame([(i, t, "en", "s", 0) for i, t in rows], DOCUMENTS)
    assert sorted(r["n_removed"] for r in repeats.remove_repeats(docs).collect())[0] == 0
    assert repeats.remove_repeats(docs.limit(0)).count() == 0


@pytest.mark.parametrize("piece", [250, 1000])
def test_long_texts_are_parsed_in_pieces(spark, monkeypatch, piece):
    monkeypatch.setattr(repeats, "PIECE", piece)
    check(spark, made_rows()[:40] + [(900, "".join(t or "" for _, t in made_rows()[:30]))])


def test_every_window_has_its_own_trigger():
    made = np.random.default_rng(1)
    data = made.integers(97, 100, 3000).astype(np.uint8)
    _, _, at, first, last = repeats.Parser().phrases(data, np.array([1200, 1250, 3000]))
    windows = [p for a, b in zip(first, last, strict=True) for p in range(a, b + 1)]
    assert windows == [*range(1101), *range(1250, 2901)]
    assert all(a <= t and t + repeats.TRIGGER <= b + repeats.LENGTH for t, a, b in zip(at, last, first, strict=True))
