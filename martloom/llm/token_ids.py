"""Token ids of whole texts by a byte-level BPE file, with the tokenizers library.

The pattern that splits a text before the merges always cuts before a space, unless white
space stands on both sides of it. So a text is cut there, and the ids of a chunk are kept in
a table of bounded size: most words of a corpus are met again and again, and the merges run
once for each. The merges themselves are the library's. Texts are cut many at a time, and the
plain chunks among the new ones are merged in rows: no piece of the vocabulary reaches over a
place where the pattern cuts them, so the merges of a row are those of its parts.
"""

from __future__ import annotations

import re
import struct
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from tokenizers import Tokenizer

from martloom.llm.common import lasting

#: Entries of a worker's table of chunks, some 150 bytes each; it is emptied when full.
ENTRIES = 400_000
#: Longer chunks are not kept.
LONGEST = 48
#: Plain chunks that are merged in one row, and letters of texts that are cut at once.
ROW, TOGETHER = 64, 5_000_000

#: A space between white space, or after some at the end: no cut may be made there.
NO_CUT = re.compile(r"\s (?:\s|\Z)")
CUT = re.compile(r"(?<!\s)(?= )|(?= \S)")
#: Characters on which two implementations may differ as to white space.
ODD = "[\x1c-\x1f]"
#: Numbers, and plain words, alone or before marks, with single line ends between them: the
#: pattern cuts only between a letter and a mark, and around a line end.
MARKS = "!\"#$%&()*+,-./:;<=>?@[\\]^_`{|}~"
MARK, LETTER = f"[{re.escape(MARKS)}]", "[A-Za-zÀ-ÖØ-öø-ɏ]"
PLAIN = re.compile(f"{LETTER}+{MARK}*(?:\n{LETTER}+{MARK}*)*|[0-9]+")


def byte_letters() -> dict[int, str]:
    """The letter that stands for each byte: itself if it prints, else the next from 256 on."""
    prints = [*range(33, 127), *range(161, 173), *range(174, 256)]
    others = [b for b in range(256) if b not in prints]
    return {b: chr(b) for b in prints} | {b: chr(256 + i) for i, b in enumerate(others)}


LETTERS = byte_letters()


def byte_class(low: int, high: int) -> str:
    return f"[{re.escape(''.join(LETTERS[b] for b in range(low, high + 1)))}]"


def crossing() -> tuple[re.Pattern, re.Pattern]:
    """What a part of plain words can look like in byte letters, and a place of a cut inside."""
    more, lead = byte_class(0x80, 0xBF), byte_class(0xC3, 0xC9)
    ends, letter = LETTERS[ord(" ")] + LETTERS[ord("\n")], f"(?:[A-Za-z0-9]|{more}|{lead})"
    part = re.compile(f"{more}?(?:[A-Za-z0-9{ends}]|{MARK}|{lead}{more})*{lead}?")
    cut = f"{letter}(?:{MARK}|[{ends}])|{MARK}[{ends}]|{LETTERS[ord('\n')]}{letter}"
    return part, re.compile(cut)


PART, INNER_CUT = crossing()


def reaches_over(piece: str) -> bool:
    """Whether merges could make the piece across a place where the pattern cuts plain words."""
    return bool(INNER_CUT.search(piece) and PART.fullmatch(piece))


class Chunks(dict):
    """From a chunk, without the space before it, to its ids as little-endian 32-bit bytes."""

    def __init__(self, tokenizer: Tokenizer, added: list[str], whole: re.Pattern):
        super().__init__()
        self.whole = whole
        self.merge, self.split = tokenizer.model.tokenize, tokenizer.pre_tokenizer.pre_tokenize_str
        pieces = [tokenizer.id_to_token(i) or "" for i in range(tokenizer.get_vocab_size())]
        self.begins = [piece[:1] == LETTERS[ord(" ")] for piece in pieces]
        # Strings of added tokens are made by no merge; none may lie inside of a plain chunk.
        self.joined = not any(reaches_over(x) for x in pieces if x not in added) and all(
            re.search(MARK + LETTER, x) for x in added
        )
        self.marks = {mark: self.letters(mark) for mark in MARKS}

    def letters(self, letters: str) -> bytes:
        """The ids of one piece of the pattern, or of plain words in a row, given as byte letters."""
        ids = [t.id for t in self.merge(letters)]
        return struct.pack(f"<{len(ids)}I", *ids)

    def ids(self, chunk: str) -> bytes:
        return b"".join([self.letters(piece) for piece, _ in self.split(chunk)])

    def plain(self, chunks: list[str]) -> Iterator[bytes]:
        """The ids of plain chunks, merged in rows; each chunk begins at the piece of its space."""
        for first in range(0, len(chunks), ROW):
            row = " " + " ".join(chunks[first : first + ROW])
            ids = [t.id for t in self.merge(row.encode().decode("latin-1").translate(LETTERS))]
            raw = struct.pack(f"<{len(ids)}I", *ids)
            at = [4 * n for n, i in enumerate(ids) if self.begins[i]] + [len(raw)]
            yield from [raw[a:b] for a, b in zip(at, at[1:], strict=False)]

    def odd(self, chunk: str) -> bool:
        """Whether a text with the chunk after a space must be looked at as a whole."""
        return not chunk or chunk[0].isspace() or bool(self.whole.search(chunk))

    def find(self, chunks: list[str]) -> dict[str, bytes | None]:
        """The ids of a space and the chunk, for each of the chunks; None for odd ones."""
        found, rows, marks = {}, [], self.marks
        for chunk in chunks:
            if not (self.joined and PLAIN.fullmatch(chunk)):
                found[chunk] = None if self.odd(chunk) else self.ids(" " + chunk)
            elif chunk[-1] in marks and chunk[-2] not in marks and (word := self.get(chunk[:-1])):
                found[chunk] = word + marks[chunk[-1]]
            else:
                rows.append(chunk)
        found.update(zip(rows, self.plain(rows), strict=True))
        return found

    def of(self, chunks: list[str]) -> list[bytes | None]:
        """The same of different chunks, in their order; new ones are taken into the table."""
        out = list(map(self.get, chunks))
        places = [n for n, ids in enumerate(out) if ids is None]
        if places:
            found = self.find([chunks[n] for n in places])
            for n in places:
                out[n] = found[chunks[n]]
            if len(self) + len(found) > ENTRIES:
                self.clear()
            kept = [x for x, ids in found.items() if ids and len(x) <= LONGEST][:ENTRIES]
            self.update(zip(kept, map(found.__getitem__, kept), strict=True))
        return out


class TextEncoder:
    """Ids of a whole text as the library gives them, which finds strings of added tokens in it."""

    def __init__(self, path: str):
        self.tokenizer = Tokenizer.from_file(path)
        added = self.tokenizer.get_added_tokens_decoder().values()
        self.added = [t.content for t in added]
        #: What sends a text through the library as a whole.
        self.odd = re.compile("|".join([ODD, *map(re.escape, self.added)]))
        pre = self.tokenizer.pre_tokenizer
        self.cuts = (
            self.tokenizer.normalizer is None
            and type(pre).__name__ == "ByteLevel"
            and pre.use_regex
            and not pre.add_prefix_space
            and not any(" " in content for content in self.added)
        )
        self.chunks = Chunks(self.tokenizer, self.added, self.odd)

    def whole(self, text: str) -> bytes:
        ids = self.tokenizer.encode(text, add_special_tokens=False).ids
        return np.array(ids, "<u4").tobytes()

    def __call__(self, text: str) -> bytes:
        """The ids as unsigned little-endian 32-bit integers."""
        return self.of_some([text])[0]

    def each(self, texts: Iterable[str]) -> Iterator[bytes]:
        """The same of many texts. Some are cut at once, and a chunk they share is looked up once."""
        some, letters = [], 0
        for text in texts:
            if some and letters + len(text) > TOGETHER:
                yield from self.of_some(some)
                some, letters = [], 0
            some.append(text)
            letters += len(text)
        yield from self.of_some(some)

    def alone(self, text: str) -> bytes:
        """The ids of a text with white space at a space, or with something odd."""
        if not self.cuts or self.odd.search(text):
            return self.whole(text)
        first, *rest = CUT.split(text) if NO_CUT.search(text) else re.split("(?= )", text)
        return b"".join(map(self.chunks.ids, [first, *rest]))

    def of_some(self, texts: list[str]) -> list[bytes]:
        if not self.cuts:
            return list(map(self.whole, texts))
        chunks, out, cut = self.chunks, [], []
        for n, text in enumerate(texts):
            first, space, rest = text.partition(" ")
            out.append(self.alone(first) if first else b"")
            if space:
                cut.append((n, rest))
        lists = pc.split_pattern(pa.array([rest for _, rest in cut], pa.string()), " ")
        words = lists.values.dictionary_encode()
        found = chunks.of(words.dictionary.to_pylist())
        row = pa.array(found, pa.large_binary()).take(words.indices)
        ends, data = np.frombuffer(row.buffers()[1], np.int64), memoryview(row.buffers()[2] or b"")
        begin = lists.offsets.to_numpy()
        at = ends[begin].tolist()
        odd = np.unique(np.searchsorted(begin, np.flatnonzero(row.is_null()), side="right") - 1)
        odd = {cut[n][0] for n in odd.tolist()}
        for (n, _), a, b in zip(cut, at, at[1:], strict=False):
            out[n] = self.alone(texts[n]) if n in odd or texts[n][0].isspace() else out[n] + data[a:b]
        return out


@lasting
def encoder(path: str) -> TextEncoder:
    """One encoder for each file and Python worker, so that its table lasts over tasks."""
    return TextEncoder(path)
