import random
import zlib
from collections import defaultdict

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
from tokenizers import Tokenizer

from martloom.llm.bin_completion import (
    best_fit,
    lower_bound,
    number_of,
    pack_fewest,
    plan_sequences,
    slots_of,
)
from martloom.llm.word_ids import WordEncoder, slices
from tests.llm.odd import no_documents, odd_documents, prose

PATH = public_tokenizers.path("word_bpe_49k.json")
LIBRARY = Tokenizer.from_file(PATH)


def library_ids(text):
    return LIBRARY.encode(text or "", add_special_tokens=False).ids


def fewest_by_hand(items, window):
    items, best = sorted(items, reverse=True), [len(items)]

    def put(i, rooms):
        if len(rooms) >= best[0]:
            return
        if i == len(items):
            best[0] = len(rooms)
            return
        for room in {r for r in rooms if r >= items[i]}:
            at = rooms.index(room)
            put(i + 1, [*rooms[:at], room - items[i], *rooms[at + 1 :]])
        put(i + 1, [*rooms, window - items[i]])

    put(0, [])
    return best[0]


def draw(rng):
    window = rng.choice([10, 20, 30, 50, 100])
    some = [
        rng.randrange(1, window + 1) if rng.random() < 0.5 else rng.randrange(window // 5, window // 2)
        for _ in range(rng.randrange(0, 12))
    ]
    return window, some


def holds_all(plan, counts, window):
    got = np.zeros_like(counts)
    for filling, times in plan:
        assert sum(s * n for s, n in filling) <= window and times > 0
        for size, number in filling:
            got[size] += number * times
    return (got == counts).all()


def test_fewest_by_brute_force():
    rng, better = random.Random(5), 0
    for _ in range(600):
        window, items = draw(rng)
        counts = np.bincount(items, minlength=window + 1)
        first, plan = best_fit(counts.copy(), window), plan_sequences(counts, window)
        assert holds_all(first, counts, window) and holds_all(plan, counts, window)
        fewest = fewest_by_hand(items, window)
        assert lower_bound(counts, window) <= fewest == number_of(plan)
        better += number_of(plan) < number_of(first)
    assert better > 5


@pytest.mark.parametrize("low,high", [(1, 40), (1000, 2200), (1400, 4097), (1, 4097)])
def test_many_pieces(low, high):
    counts = np.bincount(np.random.default_rng(1).integers(low, high, 30_000), minlength=4097)
    plan = plan_sequences(counts, 4096)
    assert holds_all(plan, counts, 4096)
    assert number_of(plan) <= number_of(best_fit(counts.copy(), 4096))
    slots, seen = slots_of(plan, 4096), set()
    for size in np.flatnonzero(counts):
        sequence, offset = slots.place(np.full(counts[size], size), np.arange(counts[size]))
        seen.update(zip(sequence.tolist(), offset.tolist(), strict=True))
    assert len(seen) == counts.sum() and len({s for s, _ in seen}) == number_of(plan)


def packed(docs, window, end=1):
    rows = pack_fewest(docs, PATH, end, window, with_ids=True).collect()
    sequences = defaultdict(list)
    for r in rows:
        ids = np.frombuffer(r.ids, "<u4")
        assert len(ids) == r.length <= window and zlib.crc32(r.ids) == r.ids_crc32
        sequences[r.sequence_id].append(r)
    for pieces in sequences.values():
        at = 0
        for r in sorted(pieces, key=lambda r: r.offset):
            assert r.offset == at
            at += r.length
        assert at <= window
    return rows, sequences


def test_documents_come_back(spark):
    rows = [(i, prose(i, 5 + 37 * (i % 9))) for i in range(60)]
    out, sequences = packed(odd_documents(spark, rows).repartition(5), 64)
    for doc_id, text in rows:
        ids, pieces = [*library_ids(text), 1], sorted(
            (r for r in out if r.doc_id == doc_id), key=lambda r: r.piece
        )
        assert [r.piece for r in pieces] == list(range(-(-len(ids) // 64)))
        assert [r.start for r in pieces] == [64 * r.piece for r in pieces]
        assert sum([np.frombuffer(r.ids, "<u4").tolist() for r in pieces], []) == ids
    total = sum(r.length for r in out)
    assert len(sequences) == -(-total // 64)


def test_odd_documents(spark):
    docs = odd_documents(spark)
    out, _ = packed(docs, 1024)
    want = sorted(
        (r.doc_id or -1, n) for r in docs.collect() for n in [len(library_ids(r.text)) + 1]
    )
    sums = defaultdict(int)
    for r in out:
        sums[r.doc_id or -1] += r.length
    by_id = defaultdict(int)
    for key, n in want:
        by_id[key] += n
    assert sums == by_id
    assert len(out) == sum(-(-n // 1024) for _, n in want)
    assert pack_fewest(no_documents(spark), PATH, 1, 1024).count() == 0


POOL = [chr(c) for c in [*range(128), 0x85, 0xA0, 0x2000, 0x2028, 0x3000, 0x300, 0x301, 0x308]]
POOL += [*"İıǄßẞΣÉéçKÅ中😀가²½٠"] + ["'s", "'T", "don't.", "<|endoftext|>", "<|ENDOFTEXT|>"]
POOL += [" ", " ", "a", "The", "x.", "x...", "T̈", "##", "B,b"]


def test_ids_are_the_librarys():
    rng = random.Random(2)
    texts = ["".join(rng.choices(POOL, k=rng.randrange(14))) for _ in range(8000)]
    ids, at = WordEncoder(PATH).all(pa.array(texts))
    for n, text in enumerate(texts):
        assert np.frombuffer(ids[at[n] : at[n + 1]], "<u4").tolist() == library_ids(text), text


def test_other_files_go_through_the_library():
    path = public_tokenizers.path("byte_bpe_50k.json")
    ids, at = WordEncoder(path).all(pa.array(["two  spaces", ""]))
    library = Tokenizer.from_file(path)
    assert np.frombuffer(ids, "<u4").tolist() == library.encode("two  spaces").ids
    assert at.tolist() == [0, len(ids), len(ids)]


def test_slices_hold_every_text():
    texts = pa.array(["a" * n for n in (0, 5 << 20, 3 << 20, 0, 9 << 20, 1)])
    assert [t for s in slices(texts) for t in s.to_pylist()] == texts.to_pylist()
