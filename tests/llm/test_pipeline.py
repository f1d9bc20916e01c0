import itertools

import pytest

import corpus_pipeline
from martloom.llm import exact_dedup, jaccard_join, quality_classifier
from tests.llm.odd import COLUMNS, no_documents, odd_documents
from tests.llm.test_exact_dedup import squeezed
from tests.llm.test_jaccard_join import by_hand
from tests.llm.test_scans import base_by_hand

FOLDER = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def steps(spark, tmp_path_factory):
    """The rows that each stage read and gave, over the smallest table."""
    docs, out = spark.read.parquet(f"{FOLDER}/documents.parquet"), []
    folder = tmp_path_factory.mktemp("pipeline")
    for number, (_, stage) in enumerate(corpus_pipeline.STAGES):
        stage(spark, docs, FOLDER).write.parquet(f"{folder}/{number}")
        after = spark.read.parquet(f"{folder}/{number}")
        out.append((docs.collect(), after.collect()))
        docs = after
    return out


def texts(rows):
    return {r.doc_id: r.text for r in rows}


def test_each_stage_by_hand(spark, steps):
    (all_docs, good), (_, exact), (_, near), (_, clean), (_, pieces) = steps
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet")
    odds = quality_classifier.fit(docs, quality_classifier.read_labels(spark, FOLDER))
    scores = quality_classifier.Scorer(odds).score_all([r.text for r in all_docs])
    assert texts(good) == {
        r.doc_id: r.text for r, s in zip(all_docs, scores, strict=True) if s >= 0.3
    }
    best = {}
    for r in good:
        rank = (-len(r.text), r.doc_id)
        best[squeezed(r.text)] = min(best.get(squeezed(r.text), rank), rank)
    assert set(texts(exact)) == {i for _, i in best.values()}
    groups = by_hand([(r.doc_id, r.text) for r in exact], part=80, n_words=5)
    assert set(texts(near)) == {k if not n else c for k, n, c in groups}
    assert set(texts(clean)) == set(texts(near))
    for r in clean:
        before = texts(near)[r.doc_id]
        assert (r.text == before) or "[secret]" in r.text
        assert base_by_hand(r.text) == "" and r.n_chars == len(r.text)
        if base_by_hand(before):
            assert r.text != before
    assert {r.doc_id for r in pieces} == set(texts(clean))


def test_stages_take_odd_rows(spark):
    for name, stage in corpus_pipeline.STAGES[:4]:
        out = stage(spark, odd_documents(spark), FOLDER)
        assert out.columns == COLUMNS, name
        out.collect()
        assert stage(spark, no_documents(spark), FOLDER).count() == 0, name
    assert corpus_pipeline.packed(spark, no_documents(spark), FOLDER).count() == 0


def test_second_run_of_dedup_stages_changes_nothing(spark):
    docs = odd_documents(spark)
    once = exact_dedup.keep_first(docs, exact_dedup.new_index(docs))
    assert exact_dedup.keep_first(once, exact_dedup.new_index(once)).count() == once.count()
    once = jaccard_join.keep_one_of_each(once)
    assert jaccard_join.keep_one_of_each(once).count() == once.count()


def test_near_copies_of_five_words_and_four_fifths(spark):
    """15% of a text appended, and 2% of its words replaced: both go."""
    words = [f"w{i}" for i in range(300)]
    swapped = [f"x{i}" if i % 50 == 25 else w for i, w in enumerate(words)]
    rows = [
        (1, " ".join(words)),
        (2, " ".join(words + [f"t{i}" for i in range(45)])),
        (3, " ".join(swapped)),
        (4, " ".join(f"o{i}" for i in range(300))),
        (5, " ".join(words + [f"u{i}" for i in range(90)])),
    ]
    kept = corpus_pipeline.near(spark, odd_documents(spark, rows), FOLDER).collect()
    assert sorted(r.doc_id for r in kept) == [1, 4, 5]


def test_near_copies_by_brute_force(spark):
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet")
    rows = [(r.doc_id, r.text.encode().lower().split()) for r in docs.collect()]
    sets = {k: {tuple(w[i : i + 5]) for i in range(max(1, len(w) - 4))} for k, w in rows if w}
    label = {k: k for k, _ in rows}
    for a, b in itertools.combinations(sets, 2):
        if 100 * len(sets[a] & sets[b]) >= 80 * len(sets[a] | sets[b]):
            low, high = sorted((label[a], label[b]))
            label |= {k: low for k, v in label.items() if v == high}
    kept = corpus_pipeline.near(spark, docs, FOLDER).select("doc_id").collect()
    assert {r.doc_id for r in kept} == {k for k in label if label[k] == k}
