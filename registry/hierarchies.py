"""Hierarchy flattening over a tree and a graph of customers."""

from datetime import datetime

from pyspark.sql import functions as F

from martloom.plans.hierarchy import HierarchySources, flatten_hierarchy
from registry import register, table

AS_OF = datetime(2024, 1, 1)

LEVELS_SQL = ", ".join(
    f"names[{n}] AS level{n}_nm, descs[{n}] AS level{n}_desc" for n in range(1, 21)
)


def customer_sets(spark, folder, graph=False):
    """Set n hangs below set n div 8; sets 0 to 7 are the roots.

    In the graph some sets have a second parent, some hold their own parent, and set 0
    holds itself.
    """
    customer = table(spark, folder, "customer")
    key = F.col("c_custkey")
    klass, sub = F.lit("0101"), F.lit("AREA")
    name = F.concat(F.lit("C"), key.cast("string"))
    own = [klass.alias("setclass"), sub.alias("subclass"), name.alias("setname")]
    kind = F.when((key % 11 == 0) & (key > 0), "B").when(key % 11 <= 2, "S").otherwise("G")
    german = customer.select(
        *own, F.lit("D").alias("langu"), F.upper("c_name").alias("descript")
    )
    texts = customer.filter((key % 50 != 0) | (key == 0)).select(
        *own, F.lit("E").alias("langu"), F.col("c_name").alias("descript")
    )
    above = F.floor(key / 8).cast("bigint")
    pairs = customer.filter(key >= 8).select(above.alias("p"), key.alias("k"))
    if graph:
        second = customer.filter((key >= 8) & (key % 13 == 0)).select(key % 7 + 1, key)
        upwards = customer.filter(key % 17 == 0).select(key, above)
        pairs = pairs.union(second).union(upwards).distinct()
    parent, child = [F.concat(F.lit("C"), F.col(c).cast("string")) for c in ("p", "k")]
    nodes = pairs.select(
        klass.alias("setclass"),
        sub.alias("subclass"),
        parent.alias("setname"),
        klass.alias("subsetcls"),
        sub.alias("subsetscls"),
        child.alias("subsetname"),
    )
    leaves = customer.select(
        *own,
        F.lit("I").alias("valsign"),
        F.when(key % 2 == 0, "EQ").otherwise("BT").alias("valoption"),
        F.lpad((key * 2).cast("string"), 10, "0").alias("valfrom"),
        F.lpad((key * 2 + 5).cast("string"), 10, "0").alias("valto"),
    )
    until = F.when(key % 9 == 0, F.lit("2000-12-31")).otherwise("9999-12-31").cast("date")
    cost_centre = [
        sub.alias("kokrs"),
        F.lpad(key.cast("string"), 10, "0").alias("kostl"),
        until.alias("datbi"),
    ]
    centres = customer.select(*cost_centre, F.lit("1995-01-01").cast("date").alias("datab"))
    described = customer.select(
        *cost_centre, F.lit("E").alias("spras"), F.col("c_mktsegment").alias("ktext")
    )
    other = customer.select(*cost_centre, F.lit("D").alias("spras"), F.lit("-").alias("ktext"))
    root = customer.filter(key < 8)
    stamps = [
        F.lit("2023-12-30 00:00:00").cast("timestamp_ntz").alias("kortex_dprct_ts"),
        F.lit("2023-12-31 00:00:00").cast("timestamp_ntz").alias("kortex_upld_ts"),
    ]

    def users(condition, subclass, label):
        return root.filter(condition).select(
            klass.alias("setclass"),
            F.lit(subclass).alias("subclass"),
            name.alias("setname"),
            F.concat(F.lit(label), key.cast("string")).alias("appl_nm"),
            F.lit(label).alias("qualfr"),
            F.lit("LKP").alias("src_nm"),
            *stamps,
        )

    applications = (
        users("true", "AREA", "APP")
        .unionByName(users("c_custkey <= 3", "AREA", "REP"))
        .unionByName(users("c_custkey = 2", "ZZZ", "OLD"))
    )
    return HierarchySources(
        applications=applications,
        headers=customer.select(*own, kind.alias("settype")),
        texts=texts.unionByName(german),
        nodes=nodes,
        leaves=leaves,
        centres=centres,
        centre_texts=described.unionByName(other),
    )


def flattened_sql(links):
    """Sets with their first level below each root, and all paths that follow these levels."""
    return f"""
    WITH RECURSIVE sets AS (
      SELECT c_custkey AS k, 'C' || c_custkey AS nm, c_name AS descript,
             CASE WHEN c_custkey % 11 = 0 AND c_custkey > 0 THEN 'B'
                  WHEN c_custkey % 11 <= 2 THEN 'S' ELSE 'G' END AS settype
      FROM customer WHERE c_custkey = 0 OR c_custkey % 50 <> 0),
    links AS ({links}),
    reached AS (
      SELECT nm AS root, k, 1 AS lvl FROM sets WHERE k < 8
      UNION
      SELECT r.root, l.k, r.lvl + 1
      FROM reached r JOIN sets p USING (k) JOIN links l ON l.p = r.k JOIN sets s ON s.k = l.k
      WHERE p.settype <> 'B' AND r.lvl < 20),
    first_level AS (SELECT root, k, min(lvl) AS lvl FROM reached GROUP BY root, k),
    tree AS (
      SELECT nm AS root, k, nm, settype, 1 AS lvl, [nm] AS names, [descript] AS descs
      FROM sets WHERE k < 8
      UNION ALL
      SELECT t.root, s.k, s.nm, s.settype, t.lvl + 1, list_append(t.names, s.nm),
             list_append(t.descs, s.descript)
      FROM tree t JOIN links l ON l.p = t.k JOIN sets s ON s.k = l.k
      JOIN first_level f ON f.root = t.root AND f.k = s.k AND f.lvl = t.lvl + 1
      WHERE t.settype <> 'B'),
    centres AS (
      SELECT lpad(CAST(c_custkey AS VARCHAR), 10, '0') AS kostl, c_mktsegment AS ktext
      FROM customer WHERE c_custkey % 9 <> 0),
    leaves AS (
      SELECT c_custkey AS k, CASE WHEN c_custkey % 2 = 0 THEN 'EQ' ELSE 'BT' END AS valoption,
             lpad(CAST(c_custkey * 2 AS VARCHAR), 10, '0') AS valfrom,
             lpad(CAST(c_custkey * 2 + 5 AS VARCHAR), 10, '0') AS valto
      FROM customer),
    every AS (
      SELECT root, nm, settype, lvl, names, descs FROM tree
      UNION ALL
      SELECT t.root, c.kostl, 'X', t.lvl + 1, list_append(t.names, c.kostl),
             list_append(t.descs, c.ktext)
      FROM tree t JOIN leaves l USING (k)
      JOIN centres c ON (valoption = 'EQ' AND kostl = valfrom)
                     OR (valoption = 'BT' AND kostl >= valfrom AND kostl <= valto)
      WHERE t.settype IN ('B', 'S')),
    applications AS (
      SELECT 'C' || c_custkey AS root, label || c_custkey AS appl_nm, label AS qualfr
      FROM customer, (SELECT unnest(['APP', 'REP']) AS label)
      WHERE c_custkey BETWEEN 0 AND 7 AND (label = 'APP' OR c_custkey <= 3))
    SELECT appl_nm, '0101' AS set_class_cd, 'AREA' AS sub_class_cd, nm AS set_nm,
           settype AS set_type_cd, CAST(lvl AS BIGINT) AS level_nbr, {LEVELS_SQL},
           qualfr, 'LKP' AS src_nm, md5('LKP') AS hash_key,
           TIMESTAMP '2023-12-30 00:00:00' AS kortex_dprct_ts,
           TIMESTAMP '2023-12-31 00:00:00' AS kortex_upld_ts,
           names[-1] AS last_level_nm, descs[-1] AS last_level_desc
    FROM every JOIN applications USING (root)"""


TREE_SQL = "SELECT c_custkey // 8 AS p, c_custkey AS k FROM customer WHERE c_custkey >= 8"
GRAPH_SQL = f"""{TREE_SQL}
      UNION SELECT c_custkey % 7 + 1, c_custkey FROM customer WHERE c_custkey >= 8 AND c_custkey % 13 = 0
      UNION SELECT c_custkey, c_custkey // 8 FROM customer WHERE c_custkey % 17 = 0"""


@register("hierarchy_flatten", flattened_sql(TREE_SQL))
def hierarchy_flatten(spark, folder):
    return flatten_hierarchy(customer_sets(spark, folder), AS_OF)


@register("hierarchy_graph", flattened_sql(GRAPH_SQL))
def hierarchy_graph(spark, folder):
    """Shared children, sets met again on later levels, cycles."""
    return flatten_hierarchy(customer_sets(spark, folder, graph=True), AS_OF)
