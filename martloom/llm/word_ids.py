"""Token ids of whole texts by a tokenizer file whose pieces never span white space.

Such a file's normaliser changes white space to spaces, and its pattern drops them, so a text is
cut at white space, and each chunk is looked up once in some megabytes of texts. The pattern is
applied here to chunks of ASCII and common Latin letters, and the ids of each piece are kept, as
most pieces of a corpus are met again; the merges are the library's. Any other chunk goes through
the library whole, strings of special tokens included, which the library finds by default.
"""

from __future__ import annotations

import functools
import json
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from tokenizers import Tokenizer

#: Entries of a worker's table of pieces, some 200 bytes each; it is emptied when full.
ENTRIES = 1_000_000
#: Longer pieces are not kept.
LONGEST = 48

LETTERS = "A-Za-zÀ-ÖØ-öø-ÿ"
#: Chunks on which the pattern of the file and the one below agree, with their lower case.
SAFE = re.compile(f"[!-~{LETTERS}]*")
#: The file's pattern on such chunks.
PIECES = re.compile(f"'s|'t|'re|'ve|'m|'ll|'d|[{LETTERS}]+|[0-9]|[^0-9{LETTERS}]+")
#: Strings of special tokens begin so.
SPECIAL = "<|"
#: The pattern cuts before such a mark.
BEFORE_MARK = f"([0-9{LETTERS}])([-.,;:!?#$%&*]+)"
#: Capitals with combining marks, too, may be composed otherwise than their lower case.
CASE_COUNTS = r"<\||[^\x{0}-\x{24f}]"
#: Bytes of text that are cut at once.
SLICE = 8 << 20
#: Chunks whose ids are put in a row at once.
STEP = 1 << 16


def drops_white_space(path: str) -> bool:
    """Whether the file is known to be of that kind: lower case, and a splitter that keeps no \\s."""
    with open(path, encoding="utf-8") as file:
        parts = json.load(file)
    steps = (parts["normalizer"] or {}).get("normalizers", [])
    cuts = (parts["pre_tokenizer"] or {}).get("pretokenizers", [])
    split = cuts[0] if cuts else {}
    return (
        [s["type"] for s in steps] == ["NFC", "Replace", "Lowercase"]
        and steps[1]["pattern"] == {"Regex": r"\s+"}
        and steps[1]["content"] == " "
        and [c["type"] for c in cuts] == ["Split", "ByteLevel"]
        and split["behavior"] == "Removed"
        and split["invert"]
        and split["pattern"].get("Regex", "").endswith(r"[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+")
        and not cuts[1]["add_prefix_space"]
        and not cuts[1]["use_regex"]
        and not any(t["lstrip"] or t["rstrip"] or t["single_word"] for t in parts["added_tokens"])
    )


PRINTING = [*range(33, 127), *range(161, 173), *range(174, 256)]
BYTE_LETTERS = {
    byte: chr(256 + n) for n, byte in enumerate(b for b in range(256) if b not in PRINTING)
}


class Pieces(dict):
    """From a piece of the pattern to its ids as little-endian 32-bit bytes."""

    def __init__(self, tokenizer: Tokenizer):
        super().__init__()
        self.merge = tokenizer.model.tokenize
        self.packed = [n.to_bytes(4, "little") for n in range(tokenizer.get_vocab_size())]

    def __missing__(self, piece: str) -> bytes:
        letters = piece
        if not piece.isascii():
            letters = piece.encode().decode("latin-1").translate(BYTE_LETTERS)
        packed = self.packed
        ids = b"".join([packed[token.id] for token in self.merge(letters)])
        if len(piece) <= LONGEST:
            if len(self) >= ENTRIES:
                self.clear()
            self[piece] = ids
        return ids


class WordEncoder:
    """Ids of whole texts, as the library gives them."""

    def __init__(self, path: str):
        self.tokenizer = Tokenizer.from_file(path)
        self.pieces = Pieces(self.tokenizer)
        self.cuts = drops_white_space(path)

    def whole(self, chunk: str) -> bytes:
        ids = self.tokenizer.encode(chunk, add_special_tokens=False).ids
        return np.array(ids, "<u4").tobytes()

    def chunk(self, chunk: str) -> bytes:
        if SPECIAL in chunk or not SAFE.fullmatch(chunk):
            return self.whole(chunk)
        return b"".join([self.pieces[p] for p in PIECES.findall(chunk.lower())])

    def all(self, texts: pa.Array) -> tuple[bytes, np.ndarray]:
        """The ids of all texts, none null, in a row, and the places where each begins and ends.

        Ids are unsigned little-endian 32-bit integers; places count bytes.
        """
        if not self.cuts:
            rows = [self.whole(text) for text in texts.to_pylist()]
            return b"".join(rows), np.cumsum([0, *map(len, rows)])
        apart = pc.replace_substring_regex(texts, BEFORE_MARK, r"\1 \2")
        special = pc.match_substring_regex(texts, CASE_COUNTS)
        chunks = pc.ascii_split_whitespace(pc.if_else(special, apart, pc.ascii_lower(apart)))
        words = chunks.flatten().dictionary_encode()
        pieces = self.pieces
        known = [
            pieces.get(chunk) or self.chunk(chunk)
            for chunk in words.dictionary.to_numpy(zero_copy_only=False)
        ]
        ids = np.frombuffer(b"".join(known), "<u4")
        begins = np.cumsum([0, *map(len, known)]) // 4
        sizes = np.diff(begins)
        codes = words.indices.to_numpy(zero_copy_only=False)
        out = [gathered(ids, begins, sizes, codes[i : i + STEP]) for i in range(0, len(codes), STEP)]
        each = chunks.value_lengths().to_numpy(zero_copy_only=False)
        ends = np.concatenate([[0], np.cumsum(sizes[codes])]) * 4
        return b"".join(out), ends[np.cumsum([0, *each])].astype(np.int64)


def gathered(ids: np.ndarray, begins: np.ndarray, sizes: np.ndarray, codes: np.ndarray) -> bytes:
    """The ids of chunks in a row."""
    lengths = sizes[codes]
    before = np.cumsum(lengths) - lengths
    return ids[np.repeat(begins[codes] - before, lengths) + np.arange(lengths.sum())].tobytes()


def slices(texts: pa.Array) -> Iterator[pa.Array]:
    """The texts some bytes at a time, or one alone if it is longer."""
    ends = np.cumsum(pc.binary_length(texts).to_numpy(zero_copy_only=False))
    begin = 0
    while begin < len(texts):
        before = ends[begin - 1] if begin else 0
        end = max(begin + 1, int(np.searchsorted(ends, before + SLICE, "right")))
        yield texts.slice(begin, end - begin)
        begin = end


@functools.lru_cache(maxsize=2)
def word_encoder(path: str) -> WordEncoder:
    """One encoder for each file and Python worker, so that its table lasts over tasks."""
    return WordEncoder(path)
