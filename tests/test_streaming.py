from martloom.plans.fulfilment import read_fulfilment
from martloom.streaming.fulfilment import load_new_files
from tests.test_fulfilment import DAY, STAGING, dims, order  # noqa: F401


def test_only_new_files_are_loaded(spark, dims, tmp_path):  # noqa: F811
    folder, mart = str(tmp_path / "staging"), str(tmp_path / "mart")

    def arrive(*rows):
        spark.createDataFrame(list(rows), STAGING).write.mode("append").parquet(folder)

    def load(as_of):
        load_new_files(
            spark, folder, STAGING, str(tmp_path / "seen"), mart, *dims, clock=lambda: as_of
        )
        stored = read_fulfilment(spark, mart).collect()
        return sorted((r.po_nbr, r.po_order_qty, r.kortex_updt_ts) for r in stored)

    arrive(order("P0", up=None), order("P1"), order("P2"))
    assert load(DAY[9]) == [(f"P{n}", 5, DAY[9]) for n in range(3)]
    assert load(DAY[10]) == [(f"P{n}", 5, DAY[9]) for n in range(3)]
    arrive(order("P2", qty="8", up=DAY[3]), order("P3", up=DAY[0]))
    assert load(DAY[11]) == [("P0", 5, DAY[9]), ("P1", 5, DAY[9]), ("P2", 8, DAY[11]), ("P3", 5, DAY[11])]
