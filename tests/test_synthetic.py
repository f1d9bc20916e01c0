from datetime import date, datetime

import pytest
from pyspark.sql import functions as F

from martloom.plans.synthetic import synthetic_tables, write_synthetic_tables
from martloom.sources.profile_csv import profile_lines, read_profile

PROFILE = """schema,table,column,cardinality,rows,type,length,precision,nulls
S,T,id,1000,1000,BIGINT,,,
S,T,code,1000,1000,char,6,,0
S,T,grp,7,1000,CHAR,3,,
S,T,word,20,1000,VARCHAR,90,,
S,T,"odd, name",20,1000,VARCHAR,5,5,
S,T,flag,9,1000,BOOLEAN,,,
S,T,never,1,1000,BOOLEAN,,,
S,T,amount,50,1000,NUMBER,10,2,
S,T,day,30,1000,DATE,,,0.5
S,T,at,60,1000,TIMESTAMP,,,500
S,T,num,5,1000,INTEGER,,,
S,T,dbl,5,1000,DOUBLE,,,
S,T,empty,0,1000,FLOAT,,,
S,T,blob,5,1000,BLOB,,,
,,,,,,,,
S,U,id,50,50,BIGINT,,
"""
AS_OF = date(2024, 1, 1)


@pytest.fixture(scope="module")
def tables(spark, tmp_path_factory):
    path = tmp_path_factory.mktemp("profile") / "profile.csv"
    path.write_text(PROFILE)
    lines = profile_lines(read_profile(spark, str(path)))
    with pytest.warns(UserWarning, match="BLOB"):
        return synthetic_tables(spark, lines, AS_OF)


def test_tables_and_columns(tables):
    assert list(tables) == [("S", "T"), ("S", "U")]
    types = dict(tables[("S", "T")].dtypes)
    assert "blob" not in types and types["odd, name"] == "string"
    assert types["amount"] == "decimal(10,2)" and types["empty"] == "double"
    assert types["day"] == "date" and types["at"] == "timestamp_ntz"
    assert tables[("S", "U")].count() == 50


def test_properties(tables):
    rows = tables[("S", "T")].collect()
    assert len(rows) == 1000
    assert {r.id for r in rows} == set(range(1, 1001))
    assert len({r.code for r in rows}) == 1000 and {len(r.code) for r in rows} == {6}
    assert rows[0].code == "1abcde"
    assert len({r.grp for r in rows}) <= 7
    words = {r.word for r in rows}
    assert len(words) <= 20 and all(1 <= len(w) <= 90 for w in words)
    assert {len(r["odd, name"]) for r in rows} == {5}
    assert {r.flag for r in rows} == {True, False}
    assert {r.never for r in rows} == {False}
    assert all(1 <= r.amount <= 50 for r in rows)
    assert all(1 <= (r.day - AS_OF).days <= 30 for r in rows)
    seen = [r["at"] for r in rows if r["at"] is not None]
    midnight = datetime(2024, 1, 1)
    assert all(1 <= (t - midnight).total_seconds() <= 60 for t in seen)
    assert 400 < len(seen) < 600
    assert {r.num for r in rows} == {1, 2, 3, 4, 5} == {r.dbl for r in rows}
    assert {r.empty for r in rows} == {None}


def test_repeatable_whatever_the_partitioning(spark, tables):
    df = tables[("S", "T")]
    digest = F.sum(F.xxhash64(*[F.col(f"`{c}`") for c in df.columns]).cast("decimal(38,0)"))
    spark.conf.set("spark.sql.leafNodeDefaultParallelism", "3")
    one = df.agg(digest).first()[0]
    spark.conf.unset("spark.sql.leafNodeDefaultParallelism")
    assert one == df.agg(digest).first()[0]


def test_write_replaces(spark, tables, tmp_path):
    write_synthetic_tables(tables, str(tmp_path))
    write_synthetic_tables(tables, str(tmp_path))
    assert spark.read.parquet(str(tmp_path / "S" / "T")).count() == 1000
