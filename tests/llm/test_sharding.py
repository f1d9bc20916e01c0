import zlib
from collections import Counter, defaultdict

import pytest

from martloom.llm.sharding import assign_shards
from tests.llm.odd import ROWS, no_documents, odd_documents, table


def test_slots_sizes_and_checksums(spark):
    found = assign_shards(odd_documents(spark), [1.0] * 5, added=[1.0]).collect()
    want = Counter(
        (k, len((t or "").encode()) + 16, zlib.crc32((t or "").encode())) for k, t in ROWS
    )
    assert Counter((r.doc_id, r["size"], r.text_crc32) for r in found) == want
    slots = defaultdict(list)
    for r in found:
        assert r.grown_shard in (r.shard, 5)
        slots[r.shard].append(r.slot)
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())


def test_equal_keys_share_a_shard_and_few_move(spark):
    docs = spark.range(20_000).selectExpr("id AS doc_id", "cast(id AS string) AS text")
    before = {r.doc_id: r for r in assign_shards(docs, [1.0] * 9, [1.0]).collect()}
    after = {r.doc_id: r.shard for r in assign_shards(docs, [1.0] * 10).collect()}
    moved = [i for i, r in before.items() if after[i] != r.shard]
    assert all(after[i] == 9 == before[i].grown_shard for i in moved)
    assert 0.08 < len(moved) / len(after) < 0.12


def test_shards_take_rows_by_weight(spark):
    docs = spark.range(20_000).selectExpr("id AS doc_id", "'' AS text")
    held = Counter(r.shard for r in assign_shards(docs, [1.0, 2.0, 5.0]).collect())
    assert [round(held[s] / 2_500) for s in range(3)] == [1, 2, 5]


def test_many_repeated_rows_get_slots_of_their_own(spark):
    docs = spark.range(9_000).selectExpr("1L AS doc_id", "'same' AS text")
    found = assign_shards(docs, [1.0, 1.0])
    assert sorted(r.slot for r in found.collect()) == list(range(9_000))


def test_empty_table_and_bad_weights(spark):
    assert assign_shards(no_documents(spark), [1.0]).count() == 0
    with pytest.raises(ValueError):
        assign_shards(table(spark, [(1, "a")]), [1.0, 0.0])
