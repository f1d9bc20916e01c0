"""Quality rules: counts of words, marks, lines and repeats, and compression bands.

A text that repeats itself shrinks more than prose of its length, and one of random letters
less. The zstandard ratio of the whole text, and of each chunk of fixed size, is held against
limits that depend on the length: short texts shrink little, long ones more. Scripts of two or
three bytes a letter shrink more for that alone, so the upper limit is one of code points, of which
such a chunk holds fewer: their prose lies further below it.
"""

from __future__ import annotations

from bisect import bisect_right
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from martloom.llm.common import own, whole_text

LEVEL = 3
CHUNK_BYTES = 4096
WHITE_SPACE = " \t\n\x0b\x0c\r"
SYMBOLS = "#*$%&|<>"

#: From so many bytes on, of a whole text: the least ratio that prose has, and the most code points
#: for a compressed byte.
TEXT_BANDS = [
    (0, 0.0, 3.0),
    (256, 1.2, 2.1),
    (512, 1.2, 2.3),
    (1024, 1.45, 2.5),
    (4096, 1.75, 3.3),
    (16384, 1.9, 3.6),
    (65536, 1.95, 3.9),
    (1048576, 2.0, 4.5),
]
#: The same of a chunk. Its size is fixed but for the last one's, so the upper limits can lie
#: close to prose, where those of whole texts can't: long prose shrinks as short repeats do.
CHUNK_BANDS = [
    (0, 1.45, 2.23),
    (2560, 1.45, 2.26),
    (3072, 1.45, 2.29),
    (3584, 1.45, 2.33),
    (4096, 1.75, 2.42),
]
#: Of a text's chunks, this share may shrink less than prose, and that share more.
DENSE_CHUNKS, REPEATED_CHUNKS = 0.25, 0.5


def limits(bands: list[tuple[int, float, float]], size: int) -> tuple[float, float]:
    _, least, most = bands[bisect_right(bands, size, key=lambda band: band[0]) - 1]
    return least, most


class Bands:
    """The verdict of the compression bands on a text's bytes."""

    def __init__(self):
        self.compress = zstandard.ZstdCompressor(
            level=LEVEL, write_checksum=False, write_content_size=False
        ).compress

    def ratio(self, data: bytes) -> float:
        return len(data) / len(self.compress(data))

    def outside(self, data: bytes, bands: list[tuple[int, float, float]]) -> tuple[bool, bool]:
        """Whether the bytes shrink less than the band allows, and whether more."""
        least, most = limits(bands, len(data))
        packed = len(self.compress(data))
        points = len(data.decode(errors="ignore"))  # a chunk may begin inside of one
        return len(data) < least * packed, points > most * packed

    def accept(self, data: bytes) -> bool:
        """Whether the whole text and enough of its chunks lie in their bands.

        A last chunk of under half the size goes with the one before it. A text of under half
        a chunk has none.
        """
        if not data:
            return True
        if any(self.outside(data, TEXT_BANDS)):
            return False
        count = (len(data) + CHUNK_BYTES // 2) // CHUNK_BYTES
        if count == 0:
            return True
        edges = [*range(0, count * CHUNK_BYTES, CHUNK_BYTES), len(data)]
        dense = repeated = 0
        for a, b in zip(edges, edges[1:], strict=False):
            less, more = self.outside(data[a:b], CHUNK_BANDS)
            dense += less
            repeated += more
        return dense <= DENSE_CHUNKS * count and repeated <= REPEATED_CHUNKS * count


def repeated_words(words: list[bytes]) -> int:
    """Words inside three-word windows that occur twice or more, first ones included."""
    if len(words) < 4:
        return 0
    numbers: dict[bytes, int] = {}
    at = np.fromiter((numbers.setdefault(w, len(numbers)) for w in words), np.int64, len(words))
    if len(numbers) == len(words):
        return 0
    pairs = at[:-1] * len(numbers) + at[1:]
    if len(numbers) >= 1 << 20:  # three numbers would not fit into one
        pairs = np.unique(pairs, return_inverse=True)[1]
    triples = pairs[:-1] * len(numbers) + at[2:]
    order = np.argsort(triples, kind="stable")
    same = triples[order[1:]] == triples[order[:-1]]
    found = np.zeros(len(triples), bool)
    found[order[1:][same]] = found[order[:-1][same]] = True
    covered = np.zeros(len(words), bool)
    for shift in range(3):
        covered[shift : shift + len(found)] |= found
    return int(covered.sum())


def counts(text: str, data: bytes) -> tuple[int, int, int, int, int]:
    """n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words of a text and its bytes."""
    words = data.split()  # of bytes, it splits at ASCII white space only
    lines = [line for line in data.split(b"\n") if line.strip()]
    return (
        len(words),
        len(text) - sum(map(text.count, WHITE_SPACE)),
        sum(map(text.count, SYMBOLS)),
        len(lines) - len(set(lines)),
        repeated_words(words),
    )


SCHEMA = (
    "n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long, "
    "base_failed boolean, kept boolean"
)
NAMES = [field.split()[0] for field in SCHEMA.split(", ")]


def judged(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    bands = Bands()
    for batch in batches:
        rows = []
        for text in batch["text"].to_pylist():
            data = text.encode()
            n_words, chars, symbols, lines, repeats = counts(text, data)
            failed = n_words < 50 or 100 * repeats > 50 * n_words
            rows.append(
                (n_words, chars, symbols, lines, repeats, failed, not failed and bands.accept(data))
            )
        columns = zip(*rows, strict=True) if rows else [()] * len(NAMES)
        kinds = [pa.int64()] * 5 + [pa.bool_()] * 2
        yield pa.RecordBatch.from_arrays(
            [batch["key"], *(pa.array(c, k) for c, k in zip(columns, kinds, strict=True))],
            ["doc_id", *NAMES],
        )


def judge_documents(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per row of ``docs``: doc_id, the counts, base_failed, kept.

    Null texts count as empty, and fail as all of under 50 words do. Rows stand for
    themselves: null keys and repeated rows are treated like others, other columns not looked
    at. No rows give no rows.
    """
    rows = docs.select(own(docs, key).alias("key"), whole_text(own(docs, text)).alias("text"))
    return rows.mapInArrow(judged, f"doc_id {docs.schema[key].dataType.simpleString()}, {SCHEMA}")
