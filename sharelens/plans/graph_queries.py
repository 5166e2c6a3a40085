"""Ownership queries (S2, P6, P7, G1-G7, J5, J8, W2, E2) on an entity dump
derived from the driver's tables.

Entities are customers, suppliers, nations and regions (ids ``c<key>``,
``s<key>``, ``n<key>``, ``r<key>``).  Their relations, as a label dump lists
them:

* customer: nation owns it ('label ownership', backward);
* supplier: nation owns it ('imprint', backward), a 'distribution' relation
  to its region (ignored type) and one relation whose target is not a label;
* nation: region owns it (backward);
* region: owns each of its nations (forward -- the same edge seen from the
  other end), an 'imprint' relation without direction, and, for regions
  whose name ends in 'A', a backward relation to its first nation: a 2-cycle
  with no exit, so those labels have no root.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.rules import INDEPENDENT_OTHER, INDEPENDENT_UNKNOWN
from ..operators.ownership import (
    flatten_relations,
    label_dimension,
    orient_edges,
    ownership_paths,
)
from ..session import scratch_path
from ..sources.ndjson import load_entities
from ..sources.tables import replace_table
from .registry import register, table
from .sqlgen import case_sql

# stand-in group rules for names found in the driver's tables
STANDIN_OWNER_RULES = (
    ("Group Africa", ("africa",)),
    ("Group Americas", ("america",)),
    ("Group Asia", ("asia",)),
    ("Group Europe", ("europe", "middle east")),
)
STANDIN_PATH_RULES = (
    ("Group Europe", ("europe",)),
    ("Group Asia", ("asia",)),
    ("Group Nation 1x", ("nation_1",)),
)


def _id(prefix: str, key: str):
    return F.concat(F.lit(prefix), F.col(key).cast("string"))


def _rel(type_: str, direction, target: str, lid, lname):
    return F.struct(F.lit(type_).alias("type"),
                    (F.lit(direction) if isinstance(direction, str) or direction is None else direction).alias("direction"),
                    F.lit(target).alias("target-type"),
                    F.struct(lid.alias("id"), lname.alias("name")).alias("label"))


def entity_parts(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    """Per entity kind: (label_id, label_name, code struct fields, relations array)."""
    t = lambda n: table(spark, sf_dir, n)
    nation = t("nation").select("n_nationkey", "n_name", "n_regionkey")
    region = t("region").select("r_regionkey", "r_name")
    geo = nation.join(region, nation.n_regionkey == region.r_regionkey)   # 25 rows

    cust = t("customer").join(nation, F.col("c_nationkey") == F.col("n_nationkey")).select(
        _id("c", "c_custkey").alias("id"), F.col("c_name").alias("name"), F.col("c_custkey").alias("label-code"),
        F.array(_rel("label ownership", "backward", "label", _id("n", "n_nationkey"), F.col("n_name"))).alias("relations"))
    supp = t("supplier").join(geo, F.col("s_nationkey") == F.col("n_nationkey")).select(
        _id("s", "s_suppkey").alias("id"), F.col("s_name").alias("name"),
        F.col("s_suppkey").cast("string").alias("label_code"),
        F.array(_rel("imprint", "backward", "label", _id("n", "n_nationkey"), F.col("n_name")),
                _rel("distribution", "forward", "label", _id("r", "r_regionkey"), F.col("r_name")),
                _rel("label ownership", "backward", "area", F.lit(None).cast("string"),
                     F.lit(None).cast("string"))).alias("relations"))
    nat = geo.select(
        _id("n", "n_nationkey").alias("id"), F.col("n_name").alias("name"), F.lit("").alias("label-code"),
        F.col("n_nationkey").alias("label_code"),
        F.array(_rel("label ownership", "backward", "label", _id("r", "r_regionkey"), F.col("r_name"))).alias("relations"))
    owned = (geo.groupBy("r_regionkey", "r_name")
             .agg(F.array_sort(F.collect_list(F.struct("n_nationkey", "n_name"))).alias("ns"),
                  F.min_by(F.struct("n_nationkey", "n_name"), "n_nationkey").alias("cap")))
    fwd = F.transform("ns", lambda n: _rel("label ownership", "forward", "label",
                                           F.concat(F.lit("n"), n["n_nationkey"].cast("string")), n["n_name"]))
    cap_id = F.concat(F.lit("n"), F.col("cap.n_nationkey").cast("string"))
    extra = F.array(_rel("imprint", None, "label", cap_id, F.col("cap.n_name")))
    back = F.array(_rel("label ownership", "backward", "label", cap_id, F.col("cap.n_name")))
    cyc = F.when(F.col("r_name").endswith("A"), back).otherwise(F.filter(back, lambda r: F.lit(False)))
    reg = owned.select(
        _id("r", "r_regionkey").alias("id"), F.col("r_name").alias("name"),
        F.concat(F.lit("LC"), F.col("r_regionkey").cast("string")).alias("label-code"),
        F.concat(fwd, extra, cyc).alias("relations"))
    return {"customer": cust, "supplier": supp, "nation": nat, "region": reg}


def label_entities(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The dump as a table: label_id, label_name, relations (JSON text)."""
    parts = entity_parts(spark, sf_dir).values()
    frames = [p.select(F.col("id").alias("label_id"), F.col("name").alias("label_name"),
                       F.to_json("relations").alias("relations")) for p in parts]
    out = frames[0]
    for f in frames[1:]:
        out = out.unionByName(f)
    return out


def entity_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The dump as NDJSON text lines, plus a blank and a non-object line per region."""
    parts = entity_parts(spark, sf_dir)
    lines = None
    for p in parts.values():
        one = p.select(F.to_json(F.struct(*p.columns)).alias("value"))
        lines = one if lines is None else lines.unionByName(one)
    junk = table(spark, sf_dir, "region").select(
        F.explode(F.array(F.lit("   "), F.concat(F.lit("["), F.col("r_regionkey").cast("string"), F.lit("]")))).alias("value"))
    return lines.unionByName(junk)


def write_dump(spark: SparkSession, sf_dir: str) -> str:
    """Write the NDJSON dump under the shared scratch folder; returns its path."""
    path = scratch_path(spark, "entity-dump")
    entity_lines(spark, sf_dir).write.mode("overwrite").text(path)
    return path


# ---------------------------------------------------------------- SQL twins
RELATIONS_SQL = """
  SELECT 'c' || CAST(c.c_custkey AS VARCHAR) AS child_label_id, c.c_name AS child_label_name,
         'label ownership' AS relationship_type, 'backward' AS direction,
         'n' || CAST(n.n_nationkey AS VARCHAR) AS parent_label_id, n.n_name AS parent_label_name
  FROM customer c JOIN nation n ON c.c_nationkey = n.n_nationkey
  UNION ALL
  SELECT 's' || CAST(s.s_suppkey AS VARCHAR), s.s_name, 'imprint', 'backward',
         'n' || CAST(n.n_nationkey AS VARCHAR), n.n_name
  FROM supplier s JOIN nation n ON s.s_nationkey = n.n_nationkey
  UNION ALL
  SELECT 's' || CAST(s.s_suppkey AS VARCHAR), s.s_name, 'distribution', 'forward',
         'r' || CAST(r.r_regionkey AS VARCHAR), r.r_name
  FROM supplier s JOIN nation n ON s.s_nationkey = n.n_nationkey JOIN region r ON n.n_regionkey = r.r_regionkey
  UNION ALL
  SELECT 'n' || CAST(n.n_nationkey AS VARCHAR), n.n_name, 'label ownership', 'backward',
         'r' || CAST(r.r_regionkey AS VARCHAR), r.r_name
  FROM nation n JOIN region r ON n.n_regionkey = r.r_regionkey
  UNION ALL
  SELECT 'r' || CAST(r.r_regionkey AS VARCHAR), r.r_name, 'label ownership', 'forward',
         'n' || CAST(n.n_nationkey AS VARCHAR), n.n_name
  FROM nation n JOIN region r ON n.n_regionkey = r.r_regionkey
  UNION ALL
  SELECT 'r' || CAST(r.r_regionkey AS VARCHAR), r.r_name, 'imprint', NULL,
         'n' || CAST(MIN(n.n_nationkey) AS VARCHAR), arg_min(n.n_name, n.n_nationkey)
  FROM nation n JOIN region r ON n.n_regionkey = r.r_regionkey GROUP BY r.r_regionkey, r.r_name
  UNION ALL
  SELECT 'r' || CAST(r.r_regionkey AS VARCHAR), r.r_name, 'label ownership', 'backward',
         'n' || CAST(MIN(n.n_nationkey) AS VARCHAR), arg_min(n.n_name, n.n_nationkey)
  FROM nation n JOIN region r ON n.n_regionkey = r.r_regionkey
  WHERE r.r_name LIKE '%A' GROUP BY r.r_regionkey, r.r_name"""

EDGES_SQL = f"""
  SELECT CASE WHEN direction = 'forward' THEN parent_label_id ELSE child_label_id END AS owned_label_id,
         CASE WHEN direction = 'forward' THEN child_label_id ELSE parent_label_id END AS owner_label_id,
         CASE WHEN direction = 'forward' THEN parent_label_name ELSE child_label_name END AS owned_label_name,
         CASE WHEN direction = 'forward' THEN child_label_name ELSE parent_label_name END AS owner_label_name
  FROM ({RELATIONS_SQL}) rel
  WHERE relationship_type IN ('label ownership', 'imprint') AND direction IS NOT NULL"""

LABELS_SQL = """
  SELECT 'c' || CAST(c_custkey AS VARCHAR) AS label_id, c_name AS label_name FROM customer
  UNION ALL SELECT 's' || CAST(s_suppkey AS VARCHAR), s_name FROM supplier
  UNION ALL SELECT 'n' || CAST(n_nationkey AS VARCHAR), n_name FROM nation
  UNION ALL SELECT 'r' || CAST(r_regionkey AS VARCHAR), r_name FROM region"""

_BOUND = 16   # longer than any shortest path in the stand-in graph

def dimension_sql(labels_sql: str, edges_sql: str) -> str:
    return f"""
WITH RECURSIVE
labels AS ({labels_sql}),
e AS (SELECT DISTINCT owned_label_id AS o, owner_label_id AS p FROM ({edges_sql}) x
      WHERE owned_label_id IS NOT NULL AND owner_label_id IS NOT NULL),
w AS (SELECT * FROM e WHERE o <> p),
nodes AS (SELECT o AS id FROM e UNION SELECT p FROM e),
roots AS (SELECT id FROM nodes WHERE id NOT IN (SELECT o FROM e)),
reach(label, node, depth) AS (
  SELECT o, p, 1 FROM w
  UNION
  SELECT r.label, w.p, r.depth + 1 FROM reach r JOIN w ON r.node = w.o
  WHERE r.depth < {_BOUND} AND w.p <> r.label),
dist AS (SELECT label, node, MIN(depth) AS depth FROM reach GROUP BY label, node),
by_root AS (SELECT d.label, d.node, d.depth,
                   row_number() OVER (PARTITION BY d.label ORDER BY d.depth, d.node) AS rn
            FROM dist d JOIN roots ON d.node = roots.id),
-- a terminal label is reached by all that it reaches
terminal AS (SELECT id FROM nodes WHERE id NOT IN (
  SELECT a.label FROM dist a LEFT JOIN dist b ON b.label = a.node AND b.node = a.label WHERE b.label IS NULL)),
far AS (SELECT label, MIN(node) AS node FROM dist JOIN terminal ON node = id GROUP BY label),
res AS (
  SELECT l.label_id, l.label_name,
         COALESCE(b.node, f.node, l.label_id) AS ultimate_id,
         CASE WHEN b.node IS NOT NULL THEN b.depth ELSE 0 END AS hierarchy_depth
  FROM labels l
  LEFT JOIN (SELECT * FROM by_root WHERE rn = 1) b ON b.label = l.label_id
  LEFT JOIN far f ON f.label = l.label_id),
named AS (
  SELECT res.*, CASE WHEN u.label_id IS NOT NULL THEN u.label_name ELSE 'Unknown' END AS ultimate_parent_name
  FROM res LEFT JOIN (SELECT label_id, MIN(label_name) AS label_name FROM labels GROUP BY label_id) u
    ON u.label_id = res.ultimate_id)
SELECT label_id, label_name, ultimate_id, ultimate_parent_name,
       {case_sql('ultimate_parent_name', STANDIN_OWNER_RULES, INDEPENDENT_OTHER, INDEPENDENT_UNKNOWN)}
         AS market_share_group,
       CAST(hierarchy_depth AS INTEGER) AS hierarchy_depth
FROM named"""


DIMENSION_SQL = dimension_sql(LABELS_SQL, EDGES_SQL)

WALK_DEPTH = 10   # the bound of the SQL model's walk

WALK_SQL = f"""
WITH RECURSIVE
labels AS ({LABELS_SQL}),
e AS ({EDGES_SQL}),
h(label_id, label_name, current_id, current_name, depth, path) AS (
  SELECT label_id, label_name, label_id, label_name, 0, [label_name] FROM labels
  UNION ALL
  SELECT h.label_id, h.label_name, e.owner_label_id, e.owner_label_name, h.depth + 1,
         list_append(h.path, e.owner_label_name)
  FROM h JOIN e ON h.current_id = e.owned_label_id
  WHERE h.depth < {WALK_DEPTH}),
ranked AS (SELECT *, row_number() OVER (PARTITION BY label_id
                                         ORDER BY depth DESC, current_id NULLS FIRST, path NULLS FIRST) AS rn
           FROM h)
SELECT label_id, label_name, current_name AS ultimate_parent_name, array_to_string(path, ' > ') AS ownership_path,
       {case_sql('current_name', STANDIN_PATH_RULES, INDEPENDENT_OTHER)} AS market_share_group,
       CAST(depth AS INTEGER) AS depth,
       depth = {WALK_DEPTH} AND current_id IN (SELECT owned_label_id FROM e) AS stopped_at_bound
FROM ranked WHERE rn = 1"""


# ---------------------------------------------------------------- queries
@register("flatten_relations", "P6", sql=RELATIONS_SQL)
def q_flatten_relations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return flatten_relations(label_entities(spark, sf_dir))


@register("orient_edges", "P7", sql=EDGES_SQL)
def q_orient_edges(spark: SparkSession, sf_dir: str) -> DataFrame:
    return orient_edges(flatten_relations(label_entities(spark, sf_dir)))


@register("ownership_graph", "J5,J8,G1,G2,G3,G4,G5,G6", sql=DIMENSION_SQL)
def q_ownership_graph(spark: SparkSession, sf_dir: str) -> DataFrame:
    ents = label_entities(spark, sf_dir)
    edges = orient_edges(flatten_relations(ents))
    return label_dimension(ents, edges, STANDIN_OWNER_RULES)


@register("ownership_path", "G7,W2", sql=WALK_SQL)
def q_ownership_path(spark: SparkSession, sf_dir: str) -> DataFrame:
    ents = label_entities(spark, sf_dir)
    edges = orient_edges(flatten_relations(ents))
    return ownership_paths(ents, edges, WALK_DEPTH, STANDIN_PATH_RULES)


def _rel_sql(type_: str, direction: str | None, target: str, lid: str | None, name: str | None = None) -> str:
    """JSON text of one relation, as the dump spells it."""
    way = f'"direction":"{direction}",' if direction else ""
    head = f'{{"type":"{type_}",{way}"target-type":"{target}","label":{{'
    if lid is None:
        return f"'{head}}}}}'"
    return f"""'{head}"id":"' || {lid} || '","name":"' || {name} || '"}}}}'"""


_NATION_ID, _REGION_ID = "'n' || CAST(n_nationkey AS VARCHAR)", "'r' || CAST(r_regionkey AS VARCHAR)"
_CAPITAL = "'n' || CAST(MIN(n_nationkey) AS VARCHAR)", "arg_min(n_name, n_nationkey)"


@register("load_ndjson", "S2", sql=f"""
SELECT 'c' || CAST(c_custkey AS VARCHAR) AS mb_id, c_name AS name, CAST(c_custkey AS INTEGER) AS label_code,
       '[' || {_rel_sql("label ownership", "backward", "label", _NATION_ID, "n_name")} || ']' AS relations
FROM customer JOIN nation ON c_nationkey = n_nationkey
UNION ALL
SELECT 's' || CAST(s_suppkey AS VARCHAR), s_name, CAST(s_suppkey AS INTEGER),
       '[' || {_rel_sql("imprint", "backward", "label", _NATION_ID, "n_name")} || ',' ||
       {_rel_sql("distribution", "forward", "label", _REGION_ID, "r_name")} || ',' ||
       {_rel_sql("label ownership", "backward", "area", None)} || ']'
FROM supplier JOIN nation ON s_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey
UNION ALL
SELECT {_NATION_ID}, n_name, NULL, '[' || {_rel_sql("label ownership", "backward", "label", _REGION_ID, "r_name")} || ']'
FROM nation JOIN region ON n_regionkey = r_regionkey
UNION ALL
SELECT {_REGION_ID}, r_name, NULL,
       '[' || string_agg({_rel_sql("label ownership", "forward", "label", _NATION_ID, "n_name")}, ',' ORDER BY n_nationkey) || ',' ||
       {_rel_sql("imprint", None, "label", *_CAPITAL)} ||
       CASE WHEN r_name LIKE '%A' THEN ',' || {_rel_sql("label ownership", "backward", "label", *_CAPITAL)} ELSE '' END || ']'
FROM region JOIN nation ON n_regionkey = r_regionkey GROUP BY r_regionkey, r_name""")
def q_load_ndjson(spark: SparkSession, sf_dir: str) -> DataFrame:
    return load_entities(spark, write_dump(spark, sf_dir))


@register("e2e_ownership", "E2", sql=DIMENSION_SQL)
def q_e2e_ownership(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Dump file -> parsed once into a stored table (atomic replace) ->
    relations -> edges -> label dimension, as the load-then-model flow does."""
    name = f"sl_labels_{uuid.uuid4().hex[:10]}"
    replace_table(load_entities(spark, write_dump(spark, sf_dir)), name, scratch_path(spark, "labels"))
    ents = spark.table(name).select(F.col("mb_id").alias("label_id"), F.col("name").alias("label_name"),
                                    "relations")
    edges = orient_edges(flatten_relations(ents))
    return label_dimension(ents, edges, STANDIN_OWNER_RULES)


# ---------------------------------------------------------------- a large table as labels
ORDER_LABELS_SQL = f"""{LABELS_SQL}
  UNION ALL SELECT 'o' || CAST(o_orderkey AS VARCHAR), o_orderpriority || ' order' FROM orders"""

ORDER_EDGES_SQL = f"""{EDGES_SQL}
  UNION ALL
  SELECT 'o' || CAST(o.o_orderkey AS VARCHAR), 'c' || CAST(c.c_custkey AS VARCHAR),
         o.o_orderpriority || ' order', c.c_name
  FROM orders o JOIN customer c ON o.o_custkey = c.c_custkey"""


@register("ownership_orders", "G1-G6 (orders as labels)", sql=dimension_sql(ORDER_LABELS_SQL, ORDER_EDGES_SQL))
def q_ownership_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The label dimension with every order added as a label owned by its
    customer: the graph grows with the largest table but one, four levels
    deep, with the stand-in's cycles above a share of it."""
    ents = label_entities(spark, sf_dir)
    o = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_orderpriority")
    c = table(spark, sf_dir, "customer").select("c_custkey", "c_name")
    order_name = F.concat(F.col("o_orderpriority"), F.lit(" order"))
    order_edges = o.join(c, o.o_custkey == c.c_custkey).select(
        _id("o", "o_orderkey").alias("owned_label_id"), _id("c", "c_custkey").alias("owner_label_id"),
        order_name.alias("owned_label_name"), F.col("c_name").alias("owner_label_name"))
    edges = orient_edges(flatten_relations(ents)).unionByName(order_edges)
    labels = ents.select("label_id", "label_name").unionByName(
        o.select(_id("o", "o_orderkey").alias("label_id"), order_name.alias("label_name")))
    return label_dimension(labels, edges, STANDIN_OWNER_RULES)
