"""Byte-level pair encoding by backtracking over longest matches, and decoding."""
from __future__ import annotations

import base64
import hashlib
import re
from collections.abc import Iterable, Iterator
from itertools import chain
from pathlib import Path

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from dayloom.llm.common import text_or_empty

CACHE, PAIR_CACHE = 3 << 17, 1 << 20  # entries a worker keeps, of pieces and units twice as many; what is not kept is worked out again
CACHED_CHARS = 64  # longer pieces are not kept
DOCS_AT_ONCE = 256
NONE = 1 << 62
ODD_SPACE = re.compile(r"\s\s|[^\S \n]").search


def read_ranks(data: bytes) -> dict[bytes, int]:
    """Token bytes to ids, from lines of a token in base 64 and its rank."""
    pairs = (line.split() for line in data.splitlines() if line.strip())
    return {base64.b64decode(token): int(rank) for token, rank in pairs}


class PairEncoder:
    """Ids of a text as merging its pieces pair by pair, lowest rank first, gives them.

    A list of tokens is the result of merging exactly if each token is what its own bytes merge to, and each two neighbours
    are what their joint bytes merge to; there is one such list for every piece. So tokens are taken from the left, the
    longest match first; one that does not fit its predecessor gives way to the next shorter match at its place, and a place where none
    fits is closed for good and its last token taken back. As every place is closed at most once, and a place has no more matches than the
    longest token has bytes, the work is linear in the piece. Matches come from one automaton over all tokens, whose bytes
    are mapped to Latin-1 characters. Whether two tokens may stand side by side is worked out once and remembered.

    ``spaced`` says that the split pattern, as the public one does, starts a match at each single space, and before and after each single line feed, so that what lies
    between them is split, and remembered, by itself; without it, and where white space follows white space, whole texts are split.
    """

    def __init__(self, ranks: dict[bytes, int], pattern: str, spaced: bool = False):
        import ahocorasick
        import regex

        missing = [b for b in range(256) if bytes([b]) not in ranks]
        if missing:
            raise ValueError(f"the vocabulary lacks {len(missing)} of the 256 single bytes")
        for token, rank in ranks.items():
            own = lambda part: ranks.get(part, NONE) if len(part) > 1 else -1
            if len(token) > 1 and not any(max(own(token[:i]), own(token[i:])) < rank for i in range(1, len(token))):
                raise ValueError(f"{token!r} is not made of two tokens of lower ranks, so its rank is not that of a merge")
        self.ranks = ranks
        self.bytes = {i: token for token, i in ranks.items()}
        self.names = {token.decode("latin-1"): i for token, i in ranks.items()}
        self.sizes = {i: len(token) for token, i in ranks.items()}
        self.split = regex.compile(pattern).findall
        self.spaced = spaced
        self.line_feed = (ranks[b"\n"],)
        self.automaton = ahocorasick.Automaton()
        for name, i in self.names.items():
            self.automaton.add_word(name, (len(name) - 1, i))
        self.automaton.make_automaton()
        self.shorter: dict[int, int] = {}
        self.single: dict[int, bool] = {}
        self.parts: dict[int, tuple | None] = {}
        self.pairs: dict[int, bool] = {}
        self.pieces = Kept(lambda piece: tuple(self.piece(piece.encode())))  # tuples of numbers are no work for the garbage collector
        self.words = Kept(lambda word: self.whole(" " + word))

    def merged(self, data: bytes) -> list[int]:
        """The definition: of all neighbours that form a token those of the lowest rank are joined, the leftmost of equals first."""
        parts, rank_of = [data[i : i + 1] for i in range(len(data))], self.ranks.get
        ranks = [rank_of(a + b, NONE) for a, b in zip(parts, parts[1:], strict=False)]
        while ranks and (lowest := min(ranks)) != NONE:
            at = ranks.index(lowest)
            parts[at : at + 2] = [parts[at] + parts[at + 1]]
            del ranks[at]
            if at:
                ranks[at - 1] = rank_of(parts[at - 1] + parts[at], NONE)
            if at < len(ranks):
                ranks[at] = rank_of(parts[at] + parts[at + 1], NONE)
        return [self.ranks[p] for p in parts]

    def made(self, token: int) -> bool:
        """Whether merging the token's own bytes gives the token."""
        known = self.single.get(token)
        if known is None:
            known = self.single[token] = self.merged(self.bytes[token]) == [token]
        return known

    def grown(self, token: int) -> tuple[list[tuple[bytes, int]], list[tuple[bytes, int]]] | None:
        """The first and the last part of a token from single byte to whole while its bytes are merged, each with the rank of the merge that ends
        it. None where merges do not come in the order of their ranks, as in a made-up vocabulary."""
        data, rank_of, lowest = self.bytes[token], self.ranks.get, -1
        parts = [data[i : i + 1] for i in range(len(data))]
        heads, tails = [], []
        while len(parts) > 1:
            rank, at = min((rank_of(a + b, NONE), i) for i, (a, b) in enumerate(zip(parts, parts[1:], strict=False)))
            if rank == NONE or rank < lowest:
                return None
            lowest = rank
            if at == 0:
                heads.append((parts[0], rank))
            if at == len(parts) - 2:
                tails.append((parts[-1], rank))
            parts[at : at + 2] = [parts[at] + parts[at + 1]]
        return [*heads, (data, NONE)], [*tails, (data, NONE)]

    def fits(self, left: int, right: int) -> bool:
        """Whether merging the joint bytes of two tokens gives just these two.

        Merges within the one and the other go on as if alone until one crosses the border, which joins a last part of the left and a first part of
        the right token: it does if it comes before the merges that end them. Of equal ranks the leftmost is first.
        """
        if len(self.pairs) >= PAIR_CACHE:
            self.pairs.clear()
        for token in (left, right):
            if token not in self.parts:
                self.parts[token] = self.grown(token)
        mine, other = self.parts[left], self.parts[right]
        if mine is None or other is None:
            known = self.merged(self.bytes[left] + self.bytes[right]) == [left, right]
        else:
            rank_of = self.ranks.get
            known = not any(rank_of(a + b, NONE) < min(end, stop + 1) for a, end in mine[1] for b, stop in other[0])
        self.pairs[left << 32 | right] = known
        return known

    def next_shorter(self, token: int) -> int:
        """The longest token that is a proper prefix of a token, -1 if none is."""
        name = self.bytes[token].decode("latin-1")
        found = next((t for end in range(len(name) - 1, 0, -1) if (t := self.names.get(name[:end])) is not None), -1)
        self.shorter[token] = found
        return found

    def piece(self, data: bytes) -> list[int]:
        """The ids of one piece of the split text."""
        whole = self.ranks.get(data)
        if whole is not None:
            return [whole]
        text, size, sizes, pairs, shorter = data.decode("latin-1"), len(data), self.sizes, self.pairs, self.shorter
        longest = [0] * size  # match at each place; of those that start there, the longest ends last
        for end, (before, token) in self.automaton.iter(text):
            longest[end - before] = token
        closed = bytearray(size + 1)
        taken: list[int] = []
        at, token = 0, longest[0]
        while at < size:
            last = taken[-1] if taken else -1
            while token >= 0:
                if not closed[at + sizes[token]]:
                    if last < 0:
                        fine = self.made(token)
                    else:
                        fine = pairs.get(last << 32 | token)
                        if fine is None:
                            fine = self.fits(last, token)
                    if fine:
                        break
                token = shorter[token] if token in shorter else self.next_shorter(token)
            if token >= 0:
                taken.append(token)
                at += sizes[token]
                token = longest[at] if at < size else -1
            else:  # no list goes on from here
                closed[at] = 1
                token = taken.pop()
                at -= sizes[token]
        return taken

    def whole(self, text: str) -> tuple[int, ...]:
        return tuple(chain.from_iterable(map(self.pieces.__getitem__, self.split(text))))

    def encode(self, text: str) -> list[int]:
        if not text:
            return []
        if not self.spaced or ODD_SPACE(text) or text[-1].isspace():
            return list(self.whole(text))
        out, words = [], self.words.__getitem__
        for line in text.split("\n"):
            if out:
                out.append(self.line_feed)
            head, *rest = line.split(" ")
            out.append(self.whole(head))
            out += map(words, rest)
        return list(chain.from_iterable(out))

    def decode(self, ids: Iterable[int]) -> bytes:
        """The bytes of the ids; an id that is none is an error."""
        return b"".join(map(self.bytes.__getitem__, ids))


class Kept(dict):
    """Values worked out before, as far as they are kept: those in use pass from one filling to the next."""

    def __init__(self, make):
        super().__init__()
        self.make, self.earlier = make, {}

    def __missing__(self, key: str) -> tuple[int, ...]:
        value = self.earlier.get(key)
        if value is None:
            value = self.make(key)
        if len(key) <= CACHED_CHARS:
            if len(self) >= CACHE:
                self.earlier = dict(self)
                self.clear()
            self[key] = value
        return value


def vocabulary() -> tuple[str, str]:
    """Path and split pattern of the public vocabulary that is installed with the tokenizer files."""
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN


_worker: dict[bytes, PairEncoder] = {}


def _encoder(data: bytes, pattern: str, spaced: bool) -> PairEncoder:
    """The encoder of this vocabulary; a worker that runs several tasks builds it once."""
    key = hashlib.sha256(data + b"\0" + pattern.encode()).digest()
    if key not in _worker:
        _worker.clear()
        _worker[key] = PairEncoder(read_ranks(data), pattern, spaced)
    return _worker[key]


def encode_documents(docs: DataFrame, path: str | None = None, pattern: str | None = None) -> DataFrame:
    """``doc_id, ids, n_tokens, decoded``: the ids of every whole text and the bytes that they decode to.

    A null or empty text has no ids and decodes to no bytes. Rows are independent: nothing is shuffled, repeated rows and null doc_ids stay, no
    rows give none; columns other than ``doc_id`` and ``text`` are not read. Names of special tokens in a text are ordinary text. A piece of any length,
    as a text of one letter repeated, takes time linear in it. Of several matches that fit, the longest is taken; the list is unique, so ties cannot change it.
    The file of ranks (below a megabyte) is read by the driver and sent with the tasks.
    """
    known = vocabulary()[1] if pattern is None else pattern
    spaced = pattern is None or path is None and pattern == vocabulary()[1]
    shared = docs.sparkSession.sparkContext.broadcast((Path(path or vocabulary()[0]).read_bytes(), known, spaced))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = _encoder(*shared.value)
        for whole in batches:
            for start in range(0, whole.num_rows, DOCS_AT_ONCE):
                batch = whole.slice(start, DOCS_AT_ONCE)
                ids = [encoder.encode(text) for text in batch.column("text").to_pylist()]
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column("doc_id"), pa.array(ids, pa.list_(pa.int32())), pa.array(map(len, ids), pa.int64(), size=len(ids)),
                        pa.array([encoder.decode(i) for i in ids], pa.binary()),
                    ],
                    names=["doc_id", "ids", "n_tokens", "decoded"],
                )

    rows = docs.select("doc_id", text_or_empty().alias("text"))
    kind = rows.schema["doc_id"].dataType.simpleString()
    return rows.mapInArrow(run, f"doc_id {kind}, ids array<int>, n_tokens bigint, decoded binary")


def digests(encoded: DataFrame) -> DataFrame:
    """``doc_id, n_tokens, ids_sha256, decoded_sha256`` of encoded documents: the ids as decimals joined by a space, and the decoded bytes."""
    joined = F.array_join(F.col("ids").cast("array<string>"), " ")
    return encoded.select("doc_id", "n_tokens", F.sha2(joined, 256).alias("ids_sha256"), F.sha2("decoded", 256).alias("decoded_sha256"))
