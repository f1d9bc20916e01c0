from collections import defaultdict

from martloom.llm.exact_dedup import DigestIndex, dedup_report, keep_first, new_index
from martloom.session import scratch_folder
from tests.llm.odd import COLUMNS, ROWS, no_documents, odd_documents, table

WHITE = " \t\n\x0b\x0c\r"


def squeezed(text):
    return "".join(c for c in text or "" if c not in WHITE)


def test_report_by_hand(spark):
    docs = odd_documents(spark)
    found = dedup_report(docs, new_index(docs)).collect()
    groups = defaultdict(list)
    for key, text in ROWS:
        groups[squeezed(text)].append((key, text or ""))
    assert len(found) == len(ROWS)
    kept = defaultdict(int)
    for row in found:
        members = next(m for t, m in groups.items() if (row.doc_id, row.group_size) in
                       {(k, len(m)) for k, _ in m} and row.text_sha256 == digest(t))
        best = min(members, key=lambda m: (-len(m[1]), m[0] is None, m[0] or 0))
        assert row.keep_id == best[0]
        kept[row.text_sha256] += row.kept
    assert set(kept.values()) == {1}


def digest(text):
    import hashlib

    return hashlib.sha256(text.encode()).hexdigest()


def test_later_batches_are_held_against_the_index(spark):
    folder = f"{scratch_folder(spark)}/index-of-batches"
    first = table(spark, [(1, "one"), (2, "two")])
    second = table(spark, [(3, "o n e"), (4, "three"), (5, "thr ee")])
    index = DigestIndex(spark, folder, first.schema["doc_id"].dataType, 4)
    assert {r.doc_id for r in keep_first(first, index).collect()} == {1, 2}
    again = DigestIndex(spark, folder, first.schema["doc_id"].dataType, 4)
    report = {r.doc_id: (r.keep_id, r.kept) for r in dedup_report(second, again).collect()}
    assert report == {3: (1, False), 4: (5, False), 5: (5, True)}
    assert keep_first(second, again).count() == 0
    assert again.table().count() == 3


def test_kept_rows_have_all_columns(spark):
    docs = odd_documents(spark)
    kept = keep_first(docs, new_index(docs))
    assert kept.columns == COLUMNS
    assert kept.count() == len({squeezed(t) for _, t in ROWS})
    assert {r.doc_id for r in kept.collect()} >= {3, 7, 8, 9, 10, 11, 12, 13}


def test_empty_table(spark):
    docs = no_documents(spark)
    assert dedup_report(docs, new_index(docs)).count() == 0
    assert keep_first(docs, new_index(docs)).count() == 0


def test_anti_join_is_a_sort_merge_join_without_a_shuffle_of_the_index(spark, capsys):
    docs = odd_documents(spark)
    index = new_index(docs)
    keep_first(docs, index)
    fresh = spark.range(9).selectExpr("cast(id AS string) AS digest")
    fresh.join(index.table().select("digest").hint("merge"), "digest", "left_anti").explain()
    plan = capsys.readouterr().out
    assert "SortMergeJoin" in plan and plan.count("Exchange hashpartitioning") == 1
