import random
from datetime import datetime

import pytest

from martloom.plans.hierarchy import (
    PARENT_KEYS,
    SEEN_KEYS,
    HierarchySources,
    LevelsExceeded,
    _level_one,
    _next_level,
    _set_key,
    described_sets,
    edges,
    expand_sets,
    flatten_hierarchy,
    run_hierarchy,
)
from martloom.sources.bucketed import BucketedStage
from martloom.sources.mart import read_snapshot

AS_OF = datetime(2024, 1, 1)
APPLICATION = """setclass string, subclass string, setname string, appl_nm string, qualfr string,
    src_nm string, kortex_dprct_ts timestamp_ntz, kortex_upld_ts timestamp_ntz"""


def sources(spark, roots, kinds, edges, untold=(), leaves=(), centres=(), sub="K"):
    """Sets named by ``kinds``; text for all but ``untold``; roots as (name, subclass)."""
    sets = [("0101", sub, n, k) for n, k in kinds.items()]
    told = [("0101", sub, n, lang, f"{lang} {n}") for n in kinds for lang in "DE"]
    told = [t for t in told if not (t[2] in untold and t[3] == "E")]
    linked = [("0101", sub, a, "0101", sub, b) for a, b in edges]
    used = [("0101", s, n, f"app {n}", "q", "src", AS_OF, AS_OF) for n, s in roots]
    return HierarchySources(
        applications=spark.createDataFrame(used, APPLICATION),
        headers=spark.createDataFrame(
            sets, "setclass string, subclass string, setname string, settype string"
        ),
        texts=spark.createDataFrame(
            told,
            "setclass string, subclass string, setname string, langu string, descript string",
        ),
        nodes=spark.createDataFrame(
            linked,
            """setclass string, subclass string, setname string, subsetcls string,
            subsetscls string, subsetname string""",
        ),
        leaves=spark.createDataFrame(
            [("0101", sub, *leaf) for leaf in leaves],
            """setclass string, subclass string, setname string, valsign string,
            valoption string, valfrom string, valto string""",
        ),
        centres=spark.createDataFrame(
            [c[:4] for c in centres], "kokrs string, kostl string, datab date, datbi date"
        ),
        centre_texts=spark.createDataFrame(
            [(c[0], c[1], lang, c[3], f"{lang} {c[1]}") for c in centres for lang in "DE"],
            "kokrs string, kostl string, spras string, datbi date, ktext string",
        ),
    )


def simulated(roots, kinds, edges, untold=()):
    """Level by level and root by root; rows are (root, level, path)."""
    rows = []
    for root in sorted({n for n, _ in roots}):
        if root in untold or root not in kinds:
            continue
        levels = [[(root,)]]
        while True:
            seen = {path[-1] for level in levels for path in level}
            grown = [
                (*path, b)
                for path in levels[-1]
                if kinds[path[-1]] not in (None, "B")
                for a, b in edges
                if a == path[-1] and b not in seen and b in kinds and b not in untold
            ]
            if not grown:
                break
            levels.append(grown)
        rows += [(root, n, p) for n, level in enumerate(levels, 1) for p in level]
    return sorted(rows)


def expanded(src):
    return sorted((r.root, r.level_nbr, tuple(r.names)) for r in expand_sets(src).collect())


def test_shapes(spark):
    kinds = {n: "G" for n in ["r", "a", "b", "d", "x", "y", "q", "m"]}
    kinds |= {"stop": "B", "below": "G", "blank": None, "under": "G"}
    edges = [
        ("r", "a"),
        ("r", "b"),
        ("a", "d"),
        ("b", "d"),  # same-level diamond: two rows
        ("r", "x"),
        ("a", "x"),  # on an earlier level already: dropped
        ("d", "r"),  # cycle: ends
        ("r", "stop"),
        ("stop", "below"),  # basic sets are not expanded
        ("r", "blank"),
        ("blank", "under"),  # neither are sets without a type
        ("r", "m"),  # no text: left out
    ]
    roots = [("r", "K"), ("q", "K"), ("m", "K"), ("nowhere", "K")]
    got = expanded(sources(spark, roots, kinds, edges, untold=["m"]))
    assert got == simulated(roots, kinds, edges, untold=["m"])
    assert [p for _, _, p in got].count(("r", "a", "d")) == 1
    assert ("r", 3, ("r", "b", "d")) in got


@pytest.mark.parametrize("seed", [1, 2])
def test_random_graphs(spark, seed):
    rng = random.Random(seed)
    names = [f"s{i}" for i in range(14)]
    kinds = {n: rng.choice(["G", "G", "G", "S", "B", None]) for n in names}
    edges = list({(rng.choice(names), rng.choice(names)) for _ in range(26)})
    roots = [(n, "K") for n in names[:4]]
    untold = names[-1:]
    got = expanded(sources(spark, roots, kinds, edges, untold))
    assert got == simulated(roots, kinds, edges, untold)


def chain(spark, length):
    names = [f"n{i:02d}" for i in range(1, length + 1)]
    kinds = {n: "G" for n in names}
    return sources(spark, [(names[0], "K")], kinds, list(zip(names, names[1:])))


def test_deepest_level(spark):
    assert len(expanded(chain(spark, 19))) == 19
    with pytest.raises(LevelsExceeded):
        expand_sets(chain(spark, 20))


def test_smallest_subclass_of_a_name(spark):
    kinds = {"r": "G"}
    assert len(expanded(sources(spark, [("r", "K"), ("r", "Z")], kinds, []))) == 1
    assert expanded(sources(spark, [("r", "K"), ("r", "A")], kinds, [])) == []


def test_flattened_rows(spark):
    day = datetime(2020, 1, 1).date()
    forever = datetime(9999, 12, 31).date()
    centres = [
        ("K", "0010", day, forever),
        ("K", "0020", day, forever),
        ("K", "0030", day, datetime(2021, 1, 1).date()),
        ("Z", "0010", day, forever),
    ]
    leaves = [
        ("basic", "I", "BT", "0010", "0030"),
        ("single", "I", "EQ", "0020", None),
        ("r", "I", "EQ", "0010", None),
    ]
    kinds = {"r": "G", "basic": "B", "single": "S"}
    src = sources(
        spark,
        [("r", "K")],
        kinds,
        [("r", "basic"), ("r", "single")],
        leaves=leaves,
        centres=centres,
    )
    out = flatten_hierarchy(src, AS_OF)
    assert len(out.columns) == 53
    got = sorted(
        (r.set_type_cd, r.level_nbr, r.level1_nm, r.level2_nm, r.level3_nm, r.last_level_desc)
        for r in out.collect()
    )
    assert got == [
        ("B", 2, "r", "basic", None, "E basic"),
        ("G", 1, "r", None, None, "E r"),
        ("S", 2, "r", "single", None, "E single"),
        ("X", 3, "r", "basic", "0010", "E 0010"),
        ("X", 3, "r", "basic", "0020", "E 0020"),
        ("X", 3, "r", "single", "0020", "E 0020"),
    ]


def test_a_level_is_shuffled_once_and_earlier_ones_never(spark):
    src = sources(spark, [("r", "K")], {"r": "S", "a": "S"}, [("r", "a")])
    sets = described_sets(src)
    first = _level_one(src, sets).withColumn("set_key", _set_key())
    known = edges(src, sets)
    links = BucketedStage(spark, "edges", known.schema, PARENT_KEYS)
    levels = BucketedStage(spark, "levels", first.schema, SEEN_KEYS)
    links.append(known)
    levels.append(first)
    threshold = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        found = levels.table()
        grown = _next_level(
            found.filter("level_nbr = 1"), links.table(), found.select(*SEEN_KEYS), 2
        )
        plan = grown._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", threshold)
        links.forget()
        levels.forget()
    # The last level to the edges, the new one to those met before.
    assert plan.count("Exchange hashpartitioning") == 2
    assert plan.count("Exchange") == 2


def test_no_roots_and_whole_runs(spark, tmp_path):
    none = sources(spark, [("elsewhere", "K")], {"r": "S"}, [("r", "r")])
    assert expanded(none) == []
    src = sources(
        spark, [("r", "K")], {"r": "S", "a": "B"}, [("r", "a")],
        leaves=[("a", "I", "EQ", "c1", None)],
    )
    path = str(tmp_path / "mart")
    run_hierarchy(spark, path, src, AS_OF)
    want = sorted(map(str, flatten_hierarchy(src, AS_OF).collect()))
    assert sorted(map(str, read_snapshot(spark, path).collect())) == want
