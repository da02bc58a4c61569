"""SentencePiece encoding and decoding as shortest paths through a weighted transducer."""
from __future__ import annotations

import hashlib
import re
import struct
from collections.abc import Iterator
from pathlib import Path

import pyarrow as pa
from pyspark.sql import DataFrame

from dayloom.llm.common import text_or_empty

SPACE = "▁"
NORMAL, UNKNOWN, CONTROL, USER, UNUSED, BYTE = 1, 2, 3, 4, 5, 6
UNIGRAM, BPE = 1, 2
WORD_CACHE, PAIR_CACHE = 3 << 17, 1 << 20  # entries kept for each task, of words twice as many; others are computed again
DOCS_AT_ONCE = 256
FREE, CLOSED = 0.0, float("inf")  # weights of the tropical semiring: path weights add, alternatives take the least


def _fields(data: bytes) -> Iterator[tuple[int, object]]:
    """Number and value of each field of a protocol buffer message."""
    at = 0

    def varint() -> int:
        nonlocal at
        value = shift = 0
        while True:
            byte = data[at]
            at += 1
            value |= (byte & 127) << shift
            shift += 7
            if byte < 128:
                return value

    while at < len(data):
        key = varint()
        kind = key & 7
        if kind == 0:
            yield key >> 3, varint()
            continue
        size = {1: 8, 5: 4}.get(kind) or varint()
        yield key >> 3, data[at : at + size]
        at += size


class Transducer:
    """Normaliser, pieces and byte fallback of a model, compiled for composition with a text.

    The normaliser maps a space to the space mark and puts one mark first. Its output is cut where no piece can
    span, which leaves short strings. In the lattice of such a string the arcs are the pieces found in it and, where no piece
    of a character exists, the bytes of that character. In a unigram model an arc weighs minus the
    piece's score. In a pair-merge model the state of the machine is the last piece, and the arc to the next one is free
    where merging their joint text by the model's ranks gives back just these two, and closed otherwise; the one free path is
    the segmentation that merging the whole string would give.
    """

    def __init__(self, model: bytes):
        pieces, trainer, normalizer = [], {}, {}
        for number, value in _fields(model):
            if number == 1:
                found = dict(_fields(value))
                pieces.append((found[1].decode(), struct.unpack("<f", found[2])[0] if 2 in found else 0.0, found.get(3, NORMAL)))
            elif number == 2:
                trainer = dict(_fields(value))
            elif number == 3:
                normalizer = dict(_fields(value))
        if normalizer.get(2):
            raise ValueError("only models whose normaliser leaves characters as they are can be compiled")
        self.kind = trainer.get(3, UNIGRAM)
        if self.kind not in (UNIGRAM, BPE):
            raise ValueError("only unigram and pair-merge models can be compiled")
        self.prefix = bool(normalizer.get(3, 1))
        self.squeeze = bool(normalizer.get(4, 1))
        self.pieces = [p for p, _, _ in pieces]
        self.kinds = [k for _, _, k in pieces]
        self.scores = [s for _, s, _ in pieces]
        self.ids = {p: i for i, (p, _, k) in enumerate(pieces) if k in (NORMAL, USER)}
        self.bytes = {int(p[3:5], 16): i for i, (p, _, k) in enumerate(pieces) if k == BYTE}
        self.unknown = next(i for i, k in enumerate(self.kinds) if k == UNKNOWN)
        self.worst = min((self.scores[i] for i in self.ids.values()), default=0.0) - 10.0
        self.byte_values = {i: b for b, i in self.bytes.items()}
        # pieces that stand for the same text in any place: a byte below 128 is a character of its own
        self.plain = frozenset(self.ids.values()) | {i for i, b in self.byte_values.items() if b < 128}
        self.spelled = [chr(self.byte_values[i]) if i in self.byte_values else p for i, p in enumerate(self.pieces)]
        self.joined = {p[i : i + 2] for p in self.ids for i in range(len(p) - 1)}
        inner = any(SPACE in p.lstrip(SPACE) for p in self.ids)
        self.cut = None if inner else re.compile(f"{SPACE}*[^{SPACE}]+|{SPACE}+")
        # the pieces as a machine over characters: each state is its piece (-1: none) and its arcs
        self.start: dict[str, list] = {}
        for piece, i in self.ids.items():
            arcs = self.start
            for char in piece:
                state = arcs.setdefault(char, [-1, {}])
                arcs = state[1]
            state[0] = i
        # pieces that merging their own characters gives; no other is ever made
        self.whole = [k in (NORMAL, USER) and self.kind == BPE and self.merged(p) == [p] for p, k in zip(self.pieces, self.kinds, strict=True)]
        self.words: dict[str, tuple[int, ...]] = {}
        self.earlier: dict[str, tuple[int, ...]] = {}
        self.pairs: dict[int, bool] = {}

    def normalise(self, text: str) -> str:
        if self.squeeze:
            text = re.sub(" +", " ", text).strip(" ")
        text = text.replace(" ", SPACE)
        return SPACE + text if text and self.prefix else text

    def fallback(self, char: str) -> tuple[int, ...]:
        return tuple(self.bytes[b] for b in char.encode()) if self.bytes else (self.unknown,)

    def merged(self, text: str) -> list[str]:
        """The text's characters merged pair by pair, the best piece first, the leftmost of equals first."""
        parts, ids, scores = list(text), self.ids, self.scores
        while len(parts) > 1:
            best, at = None, -1
            for i in range(len(parts) - 1):
                found = ids.get(parts[i] + parts[i + 1])
                if found is not None and (best is None or scores[found] > best):
                    best, at = scores[found], i
            if at < 0:
                break
            parts[at : at + 2] = [parts[at] + parts[at + 1]]
        return parts

    def arc(self, last: int, piece: int) -> float:
        """Weight of going on from piece ``last`` to ``piece``."""
        head, tail = self.pieces[last], self.pieces[piece]
        free = self.merged(head + tail) == [head, tail]
        if len(self.pairs) >= PAIR_CACHE:
            self.pairs.clear()
        self.pairs[last << 20 | piece] = free
        return FREE if free else CLOSED

    def arcs(self, text: str, at: int) -> list[tuple[int, int]]:
        """Pieces of ``text`` that start at a place, with their ends, short ones first; the bytes of a character (-1) where no
        piece is that character."""
        out, arcs, size = [], self.start, len(text)
        end = at
        while end < size:
            state = arcs.get(text[end])
            if state is None:
                break
            end += 1
            if state[0] >= 0:
                out.append((end, state[0]))
            arcs = state[1]
        if not out or out[0][0] != at + 1:
            out.insert(0, (at + 1, -1))
        return out

    def shortest(self, text: str) -> tuple[int, ...]:
        """Pieces on the least path through the lattice of ``text``."""
        path = self._free_path(text) if self.kind == BPE else self._least_path(text)
        out: list[int] = []
        at = 0
        for end, piece in path:
            if piece >= 0:
                out.append(piece)
            else:
                out.extend(self.fallback(text[at:end]))
            at = end
        return tuple(out)

    def _free_path(self, text: str) -> list[tuple[int, int]]:
        """Shortest path where every arc weighs nothing or is closed: places are settled from the farthest reached, and
        the first path that arrives is least. Every place has one free path to it, so none is entered twice."""
        size, pairs, path, closed = len(text), self.pairs, [], set()
        waiting = [self.arcs(text, 0)]
        while True:
            at, last = path[-1] if path else (0, -1)
            if at == size:
                return path
            options = waiting[-1]
            while options:
                end, piece = options.pop()
                if end in closed:
                    continue
                if piece >= 0 and last >= 0:
                    free = pairs.get(last << 20 | piece)
                    if free is None:
                        free = self.arc(last, piece) == FREE
                    if not free:
                        continue
                elif piece >= 0 and not self.whole[piece]:
                    continue
                path.append((end, piece))
                waiting.append(self.arcs(text, end) if end < size else [])
                break
            else:
                if not path:
                    raise ValueError(f"no path through {text!r}")
                closed.add(at)
                path.pop()
                waiting.pop()

    def _least_path(self, text: str) -> list[tuple[int, int]]:
        """Shortest path by relaxing the arcs of each place in turn."""
        size = len(text)
        least = [CLOSED] * (size + 1)
        least[0] = FREE
        back = [(0, -1)] * (size + 1)
        for at in range(size):
            if least[at] < CLOSED:
                for end, piece in self.arcs(text, at):
                    weight = least[at] - (self.scores[piece] if piece >= 0 else self.worst)
                    if weight < least[end]:
                        least[end], back[end] = weight, (at, piece)
        path, at = [], size
        while at:
            path.append((at, back[at][1]))
            at = back[at][0]
        return path[::-1]

    def encode(self, text: str) -> list[int]:
        marked, known, out = self.normalise(text), self.words, []
        for word in self.cut.findall(marked) if self.cut else [marked] if marked else []:
            found = known.get(word)
            if found is None:
                found = self.segment(word)
                known = self.words
            out.extend(found)
        return out

    def segment(self, word: str) -> tuple[int, ...]:
        """The pieces of a word, put together from those of its parts; it is parted where no piece holds the two characters."""
        found = self.earlier.get(word)
        if found is not None:  # words in use pass from one filling of the cache to the next
            return self.remember(word, found)
        known, joined, cuts = self.words, self.joined, [0]
        for i in range(1, len(word)):
            if word[i - 1 : i + 1] not in joined:
                cuts.append(i)
        out: list[int] = []
        for start, end in zip(cuts, [*cuts[1:], len(word)], strict=True):
            part = word[start:end]
            own = known.get(part)
            if own is None:
                own = self.earlier.get(part)
                own = self.remember(part, self.shortest(part) if own is None else own)
                known = self.words
            out.extend(own)
        return self.remember(word, tuple(out)) if len(cuts) > 1 else own

    def remember(self, word: str, ids: tuple[int, ...]) -> tuple[int, ...]:
        if len(self.words) >= WORD_CACHE:
            self.earlier, self.words = self.words, {}
        if len(word) <= 64:
            self.words[word] = ids
        return ids

    def decode(self, ids) -> str:
        """The text of the pieces; bytes that are no UTF-8 become replacement characters."""
        if self.plain.issuperset(ids):
            text = "".join([self.spelled[i] for i in ids]).replace(SPACE, " ")
            return text[1:] if self.prefix and text[:1] == " " else text
        out, raw = [], bytearray()
        for i in ids:
            if i in self.byte_values:
                raw.append(self.byte_values[i])
                continue
            if raw:
                out.append(raw.decode(errors="replace"))
                raw.clear()
            if self.kinds[i] != CONTROL:
                out.append(" ⁇ " if i == self.unknown else self.pieces[i])
        if raw:
            out.append(raw.decode(errors="replace"))
        text = "".join(out).replace(SPACE, " ")
        return text[1:] if self.prefix and text[:1] == " " else text


def model_path() -> str:
    """The public model that is installed with the tokenizer files."""
    import public_tokenizers

    return public_tokenizers.path("piece_bpe_32k.model")


def encode_documents(docs: DataFrame, model: str | None = None) -> DataFrame:
    """``doc_id``, ``ids``, ``n_tokens``, the decoded ``text``, its ``text_sha256`` and whether it equals the input (``round_trip``).

    A null or empty text has no ids and an empty text. Rows are independent: nothing is shuffled, repeated rows stay. A text that holds
    the space mark itself decodes to spaces there, as the model has no other way to write them. The model's file (half a
    megabyte) is read by the driver and sent with the task.
    """
    data = Path(model or model_path()).read_bytes()
    broadcast = docs.sparkSession.sparkContext.broadcast(data)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        machine = Transducer(broadcast.value)
        for whole in batches:
            for start in range(0, whole.num_rows, DOCS_AT_ONCE):
                batch = whole.slice(start, DOCS_AT_ONCE)
                texts = batch.column("text").to_pylist()
                ids = [machine.encode(t) for t in texts]
                back = [machine.decode(i) for i in ids]
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column("doc_id"), pa.array(ids, pa.list_(pa.int32())), pa.array([len(i) for i in ids], pa.int64()),
                        pa.array(back, pa.string()), pa.array([hashlib.sha256(t.encode()).hexdigest() for t in back], pa.string()),
                        pa.array([a == b for a, b in zip(texts, back, strict=True)], pa.bool_()),
                    ],
                    names=["doc_id", "ids", "n_tokens", "text", "text_sha256", "round_trip"],
                )

    rows = docs.select("doc_id", text_or_empty().alias("text"))
    kind = rows.schema["doc_id"].dataType.simpleString()
    return rows.mapInArrow(
        run, f"doc_id {kind}, ids array<int>, n_tokens bigint, text string, text_sha256 string, round_trip boolean"
    )
