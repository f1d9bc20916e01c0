"""SentencePiece encoding and decoding by weighted finite-state transducers.

Three machines are compiled from a model file. The normaliser puts a space before the text,
joins white space where the model says so, and writes spaces as marks. The pieces are a
transducer from letters to pieces, with one arc for each piece and, for a letter without one,
a path of its bytes. Composed with an input they give a lattice, and the encoding is its
shortest path in the tropical semiring.

With a unigram model an arc costs the piece's negative score. With a merge (BPE) model no sum of
scores gives the merges' result, so the weights stand on pairs of neighbours: zero for a pair
that the merges of the two, written together, give back, infinite for any other. A sequence
all of whose neighbours are such pairs is the result of the merges, so one path is finite.

Pieces never cross certain places, such as one before a mark that follows a letter. There the
lattice has a cut, the path goes through it, and the shortest path is found part by part; the
parts met before are kept.
"""

from __future__ import annotations

import functools
import itertools
import math
import re
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from martloom.llm.common import own, whole_text

MARK = "▁"
#: Parts, and pairs of neighbours, that a worker keeps at once; emptied when full.
ENTRIES = 600_000
LONGEST = 48
UNIGRAM, MERGES = 1, 2
NORMAL, UNKNOWN, USER, BYTE = 1, 2, 4, 6


class Transducer:
    """The machines of one model."""

    def __init__(self, path: str):
        from sentencepiece import sentencepiece_model_pb2

        model = sentencepiece_model_pb2.ModelProto()
        with open(path, "rb") as file:
            model.ParseFromString(file.read())
        rules = model.normalizer_spec
        if rules.precompiled_charsmap:
            raise ValueError("the model's normaliser has a table of letters, which isn't compiled")
        if model.trainer_spec.model_type not in (UNIGRAM, MERGES):
            raise ValueError("only unigram and merge models are compiled")
        self.merges = model.trainer_spec.model_type == MERGES
        self.prefix, self.squeeze = rules.add_dummy_prefix, rules.remove_extra_whitespaces
        self.texts = [p.piece for p in model.pieces]
        self.scores = {
            p.piece: p.score for p in model.pieces if p.type in (NORMAL, USER)
        }
        self.ids = {p.piece: i for i, p in enumerate(model.pieces) if p.piece in self.scores}
        self.bytes = {
            int(p.piece[3:5], 16): i for i, p in enumerate(model.pieces) if p.type == BYTE
        }
        self.byte_of = {i: b for b, i in self.bytes.items()}
        self.unknown = next(i for i, p in enumerate(model.pieces) if p.type == UNKNOWN)
        self.lowest = min(self.scores.values(), default=0.0) - 10
        # States of the piece transducer are the beginnings of pieces.
        self.states = {p[:i] for p in self.scores for i in range(1, len(p))}
        self.inner = {p[i : i + 2] for p in self.scores for i in range(len(p) - 1)}
        self.raw = [
            bytes([self.byte_of[i]]) if i in self.byte_of else text.encode()
            for i, text in enumerate(self.texts)
        ]
        self.packed: dict[str, bytes] = {}
        self.cuts_words = not any(a != MARK and b == MARK for a, b in self.inner)
        self.kept: dict[str, bytes] = {}
        #: Whether a piece may follow another, by the other and then by the piece.
        self.pairs: dict[str | None, dict[str, bool]] = {}
        self.n_pairs = 0

    @functools.cached_property
    def arcs(self) -> dict:
        """States as nested tables from a letter to the next state, with the piece that ends in one."""
        first: dict = {}
        for piece in self.scores:
            state = first
            for letter in piece:
                state = state.setdefault(letter, {})
            state[""] = piece
        return first

    # --- normaliser ---

    def normalise(self, text: str) -> str:
        if self.squeeze:
            text = re.sub(" +", " ", text).strip(" ")
        if text and self.prefix:
            text = " " + text
        return text.replace(" ", MARK)

    # --- weights ---

    def merged(self, text: str) -> list[str]:
        """What the merges make of a short string: the best pair first, the left one of equals."""
        parts = list(text)
        while len(parts) > 1:
            best, at = -math.inf, -1
            for i in range(len(parts) - 1):
                score = self.scores.get(parts[i] + parts[i + 1], -math.inf)
                if score > best:
                    best, at = score, i
            if at < 0:
                break
            parts[at : at + 2] = [parts[at] + parts[at + 1]]
        return parts

    def neighbours(self, before: str | None, piece: str) -> bool:
        """Whether the weight of ``piece`` after ``before`` is finite in a merge model."""
        if self.n_pairs >= ENTRIES:
            self.pairs.clear()
            self.n_pairs = 0
        alone = [piece] if before is None else [before, piece]
        found = self.merged("".join(alone)) == alone
        self.pairs.setdefault(before, {})[piece] = found
        self.n_pairs += 1
        return found

    # --- shortest path ---

    def merge_path(self, part: str) -> list[str]:
        """The one path of finite weight. Each place is reached by one arc of such a path at
        most, as the beginning of a text has one result of merges, so a place is a state."""
        arcs, size = self.arcs, len(part)
        last: list[str | None] = [None] * (size + 1)
        for start in range(size):
            before = last[start]
            if before is None and start:
                continue
            follows, state = self.pairs.get(before, {}), arcs
            for end in range(start, size):
                state = state.get(part[end])
                # A letter is an arc even if it is no piece.
                piece = state.get("") if state else None
                if piece is None and end == start:
                    piece = part[end]
                if piece is not None and last[end + 1] is None:
                    fits = follows.get(piece)
                    if self.neighbours(before, piece) if fits is None else fits:
                        last[end + 1] = piece
                if not state:
                    break
        return self.traced(last)

    def score_path(self, part: str) -> list[str]:
        """The path whose scores add up to the most, the first of equals."""
        size = len(part)
        cost = [0.0] + [math.inf] * size
        last: list[str | None] = [None] * (size + 1)
        for start in range(size):
            for end in range(start + 1, size + 1):
                piece = part[start:end]
                if end == start + 1 or piece in self.scores:
                    total = cost[start] - self.scores.get(piece, self.lowest)
                    if total < cost[end]:
                        cost[end], last[end] = total, piece
                if piece not in self.states:
                    break
        return self.traced(last)

    @staticmethod
    def traced(last: list) -> list[str]:
        out, at = [], len(last) - 1
        while at:
            out.append(last[at])
            at -= len(last[at])
        return out[::-1]

    def path(self, part: str) -> list[str]:
        """The pieces of the shortest path through the lattice of a part."""
        return self.merge_path(part) if self.merges else self.score_path(part)

    def piece_ids(self, piece: str) -> list[int]:
        if piece in self.ids:
            return [self.ids[piece]]
        if self.bytes:
            return [self.bytes[b] for b in piece.encode()]
        return [self.unknown]

    def packed_ids(self, piece: str) -> bytes:
        found = self.packed.get(piece)
        if found is None:
            found = b"".join(i.to_bytes(4, "little") for i in self.piece_ids(piece))
            if piece in self.ids:
                self.packed[piece] = found
        return found

    def parts(self, chunk: str) -> list[str]:
        """A chunk cut wherever no piece holds both neighbours."""
        inner = self.inner
        cuts = [
            i for i, (a, b) in enumerate(itertools.pairwise(chunk), 1) if a + b not in inner
        ]
        if not cuts:
            return [chunk]
        return [chunk[a:b] for a, b in zip([0, *cuts], [*cuts, len(chunk)], strict=True)]

    def encode_part(self, part: str) -> bytes:
        return b"".join(map(self.packed_ids, self.path(part)))

    def encode_chunk(self, chunk: str) -> bytes:
        found = self.kept.get(chunk)
        if found is None:
            parts = self.parts(chunk)
            if len(parts) > 1:
                found = b"".join(map(self.encode_chunk, parts))
            else:
                found = self.encode_part(chunk)
            if len(chunk) <= LONGEST:
                if len(self.kept) >= ENTRIES:
                    self.kept.clear()
                self.kept[chunk] = found
        return found

    def encode(self, text: str) -> bytes:
        """The ids of a text as unsigned little-endian 32-bit integers."""
        letters = self.normalise(text)
        if not letters:
            return b""
        if not self.cuts_words:
            return b"".join(map(self.encode_chunk, self.parts(letters)))
        words = letters.split(MARK)
        if "" in words[1:]:
            # Several marks in a row belong to the word after them.
            return b"".join(map(self.encode_chunk, re.findall(f"{MARK}*[^{MARK}]+|{MARK}+", letters)))
        first = [words[0]] if words[0] else []
        return b"".join(map(self.encode_chunk, first + [MARK + word for word in words[1:]]))

    def decode(self, ids: bytes) -> str:
        """The text of ids; bytes that are no text come out as replacement characters."""
        out = b"".join(map(self.raw.__getitem__, np.frombuffer(ids, "<u4").tolist()))
        text = out.decode(errors="replace").replace(MARK, " ")
        return text[1:] if self.prefix and text.startswith(" ") else text


@functools.lru_cache(maxsize=2)
def transducer(path: str) -> Transducer:
    """One for each file and Python worker, so that what it keeps lasts over tasks."""
    return Transducer(path)


def encode_documents(
    docs: DataFrame, path: str, key: str = "doc_id", text: str = "text"
) -> DataFrame:
    """One row per row of ``docs``: doc_id, ids (an array).

    Whole texts are encoded; null ones count as empty and have no ids. Rows stand for
    themselves: null keys and repeated rows are like others, no rows give none, and other
    columns are not looked at.
    """
    rows = docs.select(own(docs, key).alias("doc_id"), whole_text(own(docs, text)).alias("text"))

    def encoded(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = transducer(path).encode
        for batch in batches:
            ids = [np.frombuffer(encode(t), "<i4") for t in batch["text"].to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [batch["doc_id"], pa.array(ids, pa.list_(pa.int32()))], ["doc_id", "ids"]
            )

    kind = docs.schema[key].dataType.simpleString()
    return rows.mapInArrow(encoded, f"doc_id {kind}, ids array<int>")


def decode_documents(encoded: DataFrame, path: str) -> DataFrame:
    """doc_id, text of the rows (doc_id, ids); null ids give an empty text."""

    def decoded(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        decode = transducer(path).decode
        for batch in batches:
            texts = [decode(np.array(x or [], "<u4").tobytes()) for x in batch["ids"].to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [batch["doc_id"], pa.array(texts, pa.string())], ["doc_id", "text"]
            )

    kind = encoded.schema["doc_id"].dataType.simpleString()
    return encoded.select("doc_id", "ids").mapInArrow(decoded, f"doc_id {kind}, text string")


def encoding_report(
    docs: DataFrame, path: str, key: str = "doc_id", text: str = "text"
) -> DataFrame:
    """One row per row of ``docs``: doc_id, n_tokens, ids_crc32, round_trip.

    ``round_trip`` tells whether the decoded ids are the text again.
    """
    rows = docs.select(own(docs, key).alias("doc_id"), whole_text(own(docs, text)).alias("text"))

    def reported(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        machine = transducer(path)
        for batch in batches:
            texts = batch["text"].to_pylist()
            ids = [machine.encode(t) for t in texts]
            yield pa.RecordBatch.from_arrays(
                [
                    batch["doc_id"],
                    pa.array([len(x) // 4 for x in ids], pa.int64()),
                    pa.array([zlib.crc32(x) for x in ids], pa.int64()),
                    pa.array(
                        [machine.decode(x) == t for x, t in zip(ids, texts, strict=True)],
                        pa.bool_(),
                    ),
                ],
                ["doc_id", "n_tokens", "ids_crc32", "round_trip"],
            )

    kind = docs.schema[key].dataType.simpleString()
    return rows.mapInArrow(
        reported, f"doc_id {kind}, n_tokens long, ids_crc32 long, round_trip boolean"
    )


