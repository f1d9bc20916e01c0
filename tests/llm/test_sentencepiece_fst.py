import random

import numpy as np
import public_tokenizers
import pytest
import sentencepiece

from martloom.llm import sentencepiece_fst as fst
from tests.llm.odd import ROWS, no_documents, odd_documents

MODEL = public_tokenizers.path("piece_bpe_32k.model")
BITS = [
    *"a b th e ing tion . .. , ABC xxxxx 1 23 é ü 日 本 😀 <0x41> ▁".split(" "),
    " ", "  ", "   ", "\n", "\t", "\r\n", "the ", " the",
]


@pytest.fixture(scope="module")
def library():
    return sentencepiece.SentencePieceProcessor(model_file=MODEL)


@pytest.fixture(scope="module")
def machine():
    return fst.Transducer(MODEL)


def ids(machine, text):
    return np.frombuffer(machine.encode(text), "<u4").tolist()


def test_same_ids_and_texts_as_the_library(machine, library):
    draw = random.Random(2)
    texts = ["".join(draw.choices(BITS, k=draw.randrange(25))) for _ in range(2000)]
    for text in texts + [t[:20_000] for _, t in ROWS if t]:
        found = ids(machine, text)
        assert found == library.encode(text), repr(text)
        assert machine.decode(machine.encode(text)) == library.decode(found)


def test_shortest_path_of_scores_is_the_least_of_all(machine):
    """The unigram machine against all segmentations of short strings."""
    draw = random.Random(6)
    other = fst.Transducer(MODEL)
    other.merges = False
    letters = "abcd"
    pool = ["".join(draw.choices(letters, k=draw.randrange(2, 5))) for _ in range(40)]
    other.scores = {p: -draw.random() * 9 for p in {*letters, *pool}}
    other.states = {p[:i] for p in other.scores for i in range(1, len(p))}

    def every(text):
        if not text:
            yield []
        for i in range(1, len(text) + 1):
            if text[:i] in other.scores:
                for rest in every(text[i:]):
                    yield [text[:i], *rest]

    for _ in range(200):
        text = "".join(draw.choices(letters, k=draw.randrange(1, 10)))
        best = max(sum(map(other.scores.get, s)) for s in every(text))
        found = other.path(text)
        assert "".join(found) == text
        assert sum(map(other.scores.get, found)) == pytest.approx(best)


def test_odd_rows(spark, library):
    found = fst.encoding_report(odd_documents(spark), MODEL).collect()
    assert len(found) == len(ROWS)
    assert all(r.round_trip for r in found)
    sizes = sorted(len(library.encode(t or "")) for _, t in ROWS)
    assert sorted(r.n_tokens for r in found) == sizes
    assert fst.encoding_report(no_documents(spark), MODEL).count() == 0


def test_documents_there_and_back(spark):
    encoded = fst.encode_documents(odd_documents(spark), MODEL)
    texts = fst.decode_documents(encoded, MODEL).collect()
    key = lambda x: (x[0] or 0, x[1])
    want = [(k, t or "") for k, t in ROWS]
    assert sorted(((r.doc_id, r.text) for r in texts), key=key) == sorted(want, key=key)


def test_lattice_is_walked_by_letters(machine):
    """Pieces come from the states' tables; nothing is sliced out of the text to be looked up."""

    class Letters(str):
        def __getitem__(self, at):
            assert isinstance(at, int)
            return super().__getitem__(at)

    for word in ("▁the", "▁unbelievable", "▁a日b", "x" * 30):
        assert machine.merge_path(Letters(word)) == machine.merge_path(word)
        assert "".join(machine.merge_path(word)) == word
