import random
import zlib

import numpy as np
import pytest

from martloom.llm import quality_classifier as qc
from tests.llm.odd import COLUMNS, ROWS, no_documents, odd_documents, prose, table

FOLDER = "/root/testdata/sf0.01"


def good(seed):
    return prose(seed, 80)


def bad(seed):
    draw = random.Random(seed)
    return " ".join(f"x{draw.randrange(50)}###" for _ in range(80))


@pytest.fixture(scope="module")
def odds():
    return qc.train([(good(i), 1) for i in range(150)] + [(bad(i), 0) for i in range(50)])


def test_learns_and_scores_like_its_features(odds):
    scorer = qc.Scorer(odds)
    texts = [good(900), bad(901), "", "é 日本", good(902)]
    scores = scorer.score_all(texts)
    assert scores[0] > 0.9 and scores[4] > 0.9 and scores[1] < 0.1
    for text, score in zip(texts, scores, strict=True):
        ids, shares = qc.features(text)
        odd = float(shares.astype(float) @ odds[ids].astype(float)) + float(odds[-1])
        assert score == pytest.approx(1 / (1 + np.exp(-odd)), abs=1e-5)


def test_table_of_words_may_be_emptied(odds, monkeypatch):
    texts = [good(i) for i in range(20)]
    want = qc.Scorer(odds).score_all(texts)
    monkeypatch.setattr(qc, "ENTRIES", 5)
    scorer = qc.Scorer(odds)
    assert [scorer.score_all([t])[0] for t in texts] == pytest.approx(want)


def test_training_is_repeatable(odds):
    again = qc.train([(good(i), 1) for i in range(150)] + [(bad(i), 0) for i in range(50)])
    assert (again == odds).all()


def test_nothing_or_one_label_to_learn_from():
    assert qc.Scorer(qc.train([])).score_all(["any", ""]) == [qc.UNKNOWN] * 2
    assert qc.Scorer(qc.train([("a", 1)])).score_all(["any"])[0] > 0.8
    assert qc.Scorer(qc.train([("a", 0)])).score_all(["any"])[0] < 0.2


def test_held_out_labels_are_not_read(spark):
    labels = spark.createDataFrame(
        [(i, i % 2, 0) for i in range(50)] + [(3, 0, 0), (None, 1, 0), (7, None, 0), (8, 5, 0)],
        "doc_id long, quality int, toxic int",
    )
    found = {r.doc_id: r.label for r in qc.sampled_labels(labels).collect()}
    want = {i: i % 2 for i in range(50) if zlib.crc32(str(i).encode()) % 5}
    want.pop(3, None)  # two opinions
    assert found == want
    assert qc.sampled_labels(labels, 5).count() <= 5


def test_odd_rows(spark, odds):
    found = qc.classify(odd_documents(spark), odds).collect()
    assert len(found) == len(ROWS)
    for r in found:
        text = "" if r.doc_id is None else str(r.doc_id)
        assert r.held_out == (zlib.crc32(text.encode()) % 5 == 0)
        assert 0 <= r.score <= 1 and r.predicted == (r.score >= 0.3)
    assert qc.keep_good(odd_documents(spark), odds).columns == COLUMNS
    kept = qc.keep_good(table(spark, [(1, good(77)), (2, bad(78)), (None, good(79))]), odds)
    assert {r.doc_id for r in kept.collect()} == {1, None}
    assert qc.classify(no_documents(spark), odds).count() == 0
    assert qc.keep_good(no_documents(spark), odds).count() == 0


def test_held_out_accuracy(spark):
    docs, labels = spark.read.parquet(f"{FOLDER}/documents.parquet"), qc.read_labels(spark, FOLDER)
    scored = qc.classify(docs, qc.fit(docs, labels)).where("held_out")
    rows = scored.join(labels, "doc_id").select("quality", "predicted").collect()
    assert sum(r.quality == r.predicted for r in rows) / len(rows) > 0.9
    assert min(r.predicted for r in rows if r.quality == 1) >= 0
    kept = [r.predicted for r in rows if r.quality == 1]
    assert sum(kept) / len(kept) > 0.95
