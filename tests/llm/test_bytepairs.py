"""Byte-level pair encoding against the library, id by id."""
from __future__ import annotations

import hashlib
import random
from pathlib import Path

import pytest
import tiktoken
from pyspark.sql import functions as F

from dayloom.llm import bytepairs, queries
from tests.llm.helpers import documents

FOLDER = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def ranks():
    return bytepairs.read_ranks(Path(bytepairs.vocabulary()[0]).read_bytes())


@pytest.fixture(scope="module")
def library(ranks):
    return tiktoken.Encoding("own", pat_str=bytepairs.vocabulary()[1], mergeable_ranks=ranks, special_tokens={})


def odd_texts() -> list[str]:
    random.seed(7)
    out = ["", " ", "\n", "a" * 20000, "ab" * 5000, " " * 3000 + "x", "é" * 4000, "日本語𝄞" * 300, "\x00\x1c\x1c \x85 　 ᠎ z", "!" * 9000, "0" * 5000]
    out += ["\nab", "a\nb c\n", "a\n", "\n", "a b\nc,d e", "a \n b  c\x1c d\x85 e 　 f   \n\n h ", "<|endoftext|> I'm we'll 'S it's", "x" + " \t" * 2000 + "y", "the" * 3000]
    out += ["".join(random.choice("ab theé\n  \x1c　\x85日𝄞.,1'sZ") for _ in range(random.randint(0, 60))) for _ in range(1500)]
    return out + ["".join(random.choice("etaoinshr") for _ in range(40)) for _ in range(800)]


def test_ids_equal_the_library(spark, ranks, library):
    texts = odd_texts() + [r["text"] for r in spark.read.parquet(f"{FOLDER}/documents.parquet").collect()]
    rows = documents(spark, [None, *texts], extra=True)
    got = {r["doc_id"]: r for r in bytepairs.encode_documents(rows.unionAll(rows.limit(3))).collect()}
    assert got[0]["ids"] == [] and got[0]["decoded"] == b"" and len(got) == len(texts) + 1
    for i, text in enumerate(texts, 1):
        assert got[i]["ids"] == library.encode_ordinary(text), text[:80]
        assert got[i]["n_tokens"] == len(got[i]["ids"]) and got[i]["decoded"] == text.encode()
    assert bytepairs.encode_documents(rows.limit(0)).count() == 0


def test_random_tokens_and_the_two_ways_to_split(ranks, library):
    random.seed(8)
    cut = bytepairs.PairEncoder(ranks, bytepairs.vocabulary()[1], True)
    whole = bytepairs.PairEncoder(ranks, bytepairs.vocabulary()[1])
    for _ in range(2000):
        text = library.decode([random.randrange(50256) for _ in range(12)])
        want = library.encode_ordinary(text)
        assert cut.encode(text) == want and whole.encode(text) == want and cut.decode(want) == text.encode()
    with pytest.raises(KeyError):
        cut.decode([999999])


def test_backtracking_equals_merging_with_any_small_vocabulary():
    random.seed(9)
    for _ in range(60):
        ranks = {bytes([b]): b for b in range(256)}
        names = [b"a", b"b", b"c"]
        for _ in range(random.randint(1, 14)):
            joined = random.choice(names) + random.choice(names)
            if joined not in ranks:
                ranks[joined] = len(ranks)
                names.append(joined)
        encoder = bytepairs.PairEncoder(ranks, r"\S+|\s+")
        for _ in range(60):
            data = bytes(random.choice(b"aabbc") for _ in range(random.randint(1, 24)))
            # the library takes a piece that is a token whole
            pair = [random.choice(list(encoder.bytes)[256:] or [97]) for _ in range(2)]
            if all(map(encoder.made, pair)):
                assert encoder.fits(*pair) == (encoder.merged(encoder.bytes[pair[0]] + encoder.bytes[pair[1]]) == pair)
            assert encoder.piece(data) == ([ranks[data]] if data in ranks else encoder.merged(data))
        assert encoder.piece(b"ab" * 3000) == tiktoken.Encoding("x", pat_str=r"\S+|\s+", mergeable_ranks=ranks, special_tokens={}).encode_ordinary("ab" * 3000)


def test_a_kept_piece_may_be_worked_out_again(monkeypatch, ranks, library):
    monkeypatch.setattr(bytepairs, "CACHE", 3)
    monkeypatch.setattr(bytepairs, "PAIR_CACHE", 3)
    encoder = bytepairs.PairEncoder(ranks, bytepairs.vocabulary()[1], True)
    for text in ["one two three four five six one two seven", "one two three"] * 3:
        assert encoder.encode(text) == library.encode_ordinary(text)


def test_vocabularies_without_all_bytes_are_refused():
    with pytest.raises(ValueError, match="single bytes"):
        bytepairs.PairEncoder({b"a": 0}, r"\S+")
    single = {bytes([b]): b for b in range(256)}
    with pytest.raises(ValueError, match="lower ranks"):
        bytepairs.PairEncoder({**single, b"abc": 256, b"ab": 257}, r"\S+")


def test_query_gives_digests(spark, library):
    rows = spark.read.parquet(f"{FOLDER}/documents.parquet").select("doc_id", F.coalesce("text", F.lit("")).alias("text")).collect()
    got = {r["doc_id"]: r for r in queries.QUERIES["op12_byte_pairs"](spark, FOLDER).collect()}
    for r in rows:
        ids = library.encode_ordinary(r["text"])
        want = (len(ids), hashlib.sha256(" ".join(map(str, ids)).encode()).hexdigest(), hashlib.sha256(r["text"].encode()).hexdigest())
        assert tuple(got[r["doc_id"]])[1:] == want
    assert len(got) == len(rows)
