from __future__ import annotations

import random
from collections import deque

import pytest
from pyspark.sql import functions as F

from sharelens.functions.rules import INDEPENDENT_OTHER, INDEPENDENT_UNKNOWN, SONY, UMG
from sharelens.operators.ownership import (
    deepest_path,
    edge_set,
    flatten_relations,
    label_dimension,
    orient_edges,
    ownership_paths,
    resolve_owners,
    walk_paths,
)

EDGE_SCHEMA = "owned_label_id string, owner_label_id string, owned_label_name string, owner_label_name string"


def reference_resolve(edges, labels):
    """Plain-Python statement of the graph job's rules (our tie-breaks)."""
    out_adj = {}
    nodes = set()
    for o, p in set(edges):
        nodes.update((o, p))
        out_adj.setdefault(o, set()).add(p)
    result = {}
    for lab in labels:
        if lab not in nodes:
            result[lab] = (lab, 0)
            continue
        dist = {lab: 0}
        q = deque([lab])
        while q:
            u = q.popleft()
            for v in sorted(out_adj.get(u, ())):
                if v not in dist:
                    dist[v] = dist[u] + 1
                    q.append(v)
        reach = {n: d for n, d in dist.items() if n != lab}
        if not reach:
            result[lab] = (lab, 0)
            continue
        roots = [(d, n) for n, d in reach.items() if not out_adj.get(n)]
        if roots:
            d, n = min(roots)
            result[lab] = (n, d)
        else:
            result[lab] = (min(n for n in reach if all(n in _above(out_adj, m) for m in _above(out_adj, n))), 0)
    return result


def _above(out_adj, start):
    """All that start reaches, itself included."""
    seen, todo = {start}, [start]
    while todo:
        for v in out_adj.get(todo.pop(), ()):
            if v not in seen:
                seen.add(v)
                todo.append(v)
    return seen


def _dim(spark, edges, labels, names=None):
    e = spark.createDataFrame([(o, p, None, None) for o, p in edges], EDGE_SCHEMA)
    lab = spark.createDataFrame([(x, (names or {}).get(x, f"name {x}")) for x in labels],
                                "label_id string, label_name string")
    return {r.label_id: r for r in label_dimension(lab, e).collect()}


def test_crafted_edge_cases(spark):
    edges = [("a", "b"), ("a", "b"), ("b", "c"),          # duplicate edge, chain to root c
             ("x", "y"), ("y", "x"),                       # 2-cycle, no exit
             ("s", "s"),                                   # self-loop only
             ("t", "r1"), ("t", "r2"),                     # two roots at equal depth
             ("u", "s"),                                   # owner has only a self-loop: not a root
             ("m", "ghost")]                               # owner missing from the label table
    labels = ["a", "b", "c", "x", "y", "s", "t", "r1", "r2", "u", "m", "lonely"]
    names = {"c": "Sony Music Entertainment", "r1": "Universal Music", "r2": "Zeta", "x": None}
    got = _dim(spark, edges, labels, names)
    assert (got["a"].ultimate_id, got["a"].hierarchy_depth) == ("c", 2)
    assert got["a"].market_share_group == SONY
    assert (got["b"].ultimate_id, got["b"].hierarchy_depth) == ("c", 1)
    assert (got["c"].ultimate_id, got["c"].hierarchy_depth) == ("c", 0)
    assert (got["x"].ultimate_id, got["x"].hierarchy_depth) == ("y", 0)
    assert (got["y"].ultimate_id, got["y"].hierarchy_depth) == ("x", 0)
    assert got["y"].ultimate_parent_name is None and got["y"].market_share_group == INDEPENDENT_UNKNOWN
    assert (got["s"].ultimate_id, got["s"].hierarchy_depth) == ("s", 0)
    assert (got["t"].ultimate_id, got["t"].hierarchy_depth) == ("r1", 1)
    assert got["t"].market_share_group == UMG
    assert (got["u"].ultimate_id, got["u"].hierarchy_depth) == ("s", 0)
    assert got["m"].ultimate_parent_name == "Unknown" and got["m"].market_share_group == INDEPENDENT_OTHER
    assert (got["lonely"].ultimate_id, got["lonely"].hierarchy_depth) == ("lonely", 0)


@pytest.mark.parametrize("seed", [1, 2, 3, 4, 5, 6])
def test_random_graphs_match_plain_bfs(spark, seed):
    rnd = random.Random(seed)
    n = 45
    ids = [f"n{i:02d}" for i in range(n)]
    edges = []
    for i in range(n):
        for _ in range(rnd.choice([0, 1, 1, 2])):
            j = rnd.randrange(n) if rnd.random() < 0.3 else rnd.randrange(i, n)
            edges.append((ids[i], ids[j]))
    # leaves hanging off the graph: one owner each (some into exit-less cycles)
    for k in range(15):
        edges.append((f"leaf{k:02d}", ids[rnd.randrange(n)]))
    edges += [("cy1", "cy2"), ("cy2", "cy1"), ("leafc", "cy1"), ("leafs", "selfy"), ("selfy", "selfy")]
    ids = ids + [f"leaf{k:02d}" for k in range(15)] + ["cy1", "cy2", "leafc", "leafs", "selfy"]
    labels = ids + ["extra"]
    got = resolve_owners(edge_set(spark.createDataFrame([(o, p, None, None) for o, p in edges], EDGE_SCHEMA)))
    got = {r.label_id: (r.ultimate_id, r.depth) for r in got.collect()}
    ref = reference_resolve(edges, labels)
    for lab in labels:
        assert got.get(lab, (lab, 0)) == ref[lab], lab


def test_walk_paths_and_cycles(spark):
    rows = [("a", "b", "A", "B"), ("a", "b", "A", "B"),    # a parallel edge is one edge
            ("b", "c", "B", "C"),
            ("x", "y", "X", "Y"), ("y", "x", "Y", "X"),
            ("n", "z", "N", None)]                         # NULL owner name -> NULL path
    e = spark.createDataFrame(rows, EDGE_SCHEMA)
    lab = spark.createDataFrame([(k, k.upper()) for k in ["a", "b", "c", "x", "n"]], "label_id string, label_name string")
    walk = walk_paths(lab, e, max_depth=10)
    assert walk.where(F.col("label_id") == "a").count() == 3
    deep = {r.label_id: r for r in deepest_path(walk).collect()}
    assert deep["a"].ownership_path == "A > B > C" and deep["a"].depth == 2 and not deep["a"].stopped_at_bound
    assert deep["x"].depth == 10 and deep["x"].ultimate_parent_name == "X" and deep["x"].stopped_at_bound
    assert deep["n"].ownership_path is None and deep["n"].depth == 1
    assert deep["c"].depth == 0 and deep["c"].ownership_path == "C"


def test_walk_rows_stay_linear_with_three_owners(spark):
    """Every node has three owners: 3^depth walks, but a row for each node and depth."""
    n = 30
    rows = [(f"k{i:02d}", f"k{(i + d) % n:02d}", f"K{i}", f"K{(i + d) % n}") for i in range(n) for d in (1, 2, 3)]
    e = spark.createDataFrame(rows, EDGE_SCHEMA)
    lab = spark.createDataFrame([(f"k{i:02d}", f"K{i}") for i in range(n)], "label_id string, label_name string")
    walk = walk_paths(lab, e, max_depth=8)
    assert walk.count() <= n * (1 + 8 * n)
    walks = {(0, 0): ["K0"]}                                  # smallest path of label k00 by plain enumeration
    for depth in range(1, 5):
        for i in range(n):
            ways = [walks[j, depth - 1] + [f"K{i}"] for j in range(n) if (j, depth - 1) in walks and (i - j) % n in (1, 2, 3)]
            if ways:
                walks[i, depth] = min(ways)
    got = {(int(r.current_id[1:]), r.depth): r.path for r in walk.where("label_id = 'k00' and depth < 5").collect()}
    assert got == walks


def test_walk_path_order_survives_appending(spark):
    """"A" sorts before "A !" as a name, but not once " > x" is appended to the strings."""
    rows = [("s", "p", "S", "A"), ("s", "q", "S", "A !"), ("p", "t", "A", "T"), ("q", "t", "A !", "T")]
    e = spark.createDataFrame(rows, EDGE_SCHEMA)
    lab = spark.createDataFrame([("s", "S")], "label_id string, label_name string")
    assert deepest_path(walk_paths(lab, e, 5)).first().ownership_path == "S > A > T"


def test_long_chain_has_no_depth_bound(spark):
    ids = [f"c{i:02d}" for i in range(14)]
    edges = list(zip(ids, ids[1:], strict=False))
    got = resolve_owners(edge_set(spark.createDataFrame([(o, p, None, None) for o, p in edges], EDGE_SCHEMA)))
    assert {r.label_id: (r.ultimate_id, r.depth) for r in got.collect()} == {x: ("c13", 13 - i) for i, x in enumerate(ids[:-1])}


def test_peeled_chain_above_an_exitless_cycle(spark):
    edges = [("l3", "l2"), ("l2", "l1"), ("l1", "cy1"), ("m1", "l1"), ("cy1", "cy2"), ("cy2", "cy1"), ("two", "l1"), ("two", "cy2")]
    got = resolve_owners(edge_set(spark.createDataFrame([(o, p, None, None) for o, p in edges], EDGE_SCHEMA)))
    labels = sorted({x for e in edges for x in e})
    ref = reference_resolve(edges, labels)
    assert {r.label_id: (r.ultimate_id, r.depth) for r in got.collect()} == ref


def _edges(spark, edges):
    return edge_set(spark.createDataFrame([(o, p, None, None) for o, p in edges], EDGE_SCHEMA))


@pytest.mark.parametrize("seed", range(8))
def test_components_without_exit(spark, seed):
    """Graphs without a root: rings, components of labels with several owners, chains between and into them."""
    rnd = random.Random(seed)
    edges = []
    for c in range(rnd.randint(1, 4)):
        ids = [f"{rnd.choice('abc')}{c}{i}" for i in range(rnd.randint(1, 9))]
        ids = list(dict.fromkeys(ids))
        edges += [(x, ids[(i + 1) % len(ids)]) for i, x in enumerate(ids)]           # a ring, or a self-loop
        edges += [(rnd.choice(ids), rnd.choice(ids)) for _ in range(rnd.randint(0, 4))]   # and chords
    nodes = sorted({x for e in edges for x in e})
    for i in range(12):
        edges += [(f"t{i}", rnd.choice([*nodes, *[f"t{j}" for j in range(i)]])) for _ in range(rnd.choice([1, 1, 2]))]
    for _ in range(seed % 3):
        edges.append((rnd.choice(nodes), rnd.choice(nodes)))                             # one component leads to another
    labels = sorted({x for e in edges for x in e})
    got = {r.label_id: (r.ultimate_id, r.depth) for r in resolve_owners(_edges(spark, edges)).collect()}
    ref = reference_resolve(edges, labels)
    assert {x: got.get(x, (x, 0)) for x in labels} == ref


def _long_graph(spark, n, last):
    """n labels in a row, each owned by the next; ``last`` is the owner of the last one, None for a root."""
    name = lambda c: F.format_string("L%07d", c)
    rows = spark.range(n - 1).select(name(F.col("id")).alias("o"), name(F.col("id") + 1).alias("p"))
    return rows if last is None else rows.unionByName(spark.range(1).select(name(F.lit(n - 1)).alias("o"), F.lit(last).alias("p")))


def _jobs(spark, group, fn):
    spark.sparkContext.setJobGroup(group, group)
    try:
        return fn(), len(spark.sparkContext.statusTracker().getJobIdsForGroup(group))
    finally:
        spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)


def test_chain_of_50_000_labels(spark):
    n = 50_000
    got, jobs = _jobs(spark, "chain", lambda: resolve_owners(_long_graph(spark, n, None)))
    right = (F.col("ultimate_id") == F.lit(f"L{n - 1:07d}")) & (F.col("depth") == n - 1 - F.substring("label_id", 2, 7).cast("int"))
    assert got.count() == n - 1 == got.where(right).count()
    assert jobs < 100


def test_ring_of_100_000_labels(spark):
    n = 100_000
    got, jobs = _jobs(spark, "ring", lambda: resolve_owners(_long_graph(spark, n, "L0000000")))
    first = F.col("label_id") == F.lit("L0000000")
    right = F.when(first, F.col("ultimate_id") == F.lit("L0000001")).otherwise(F.col("ultimate_id") == F.lit("L0000000"))
    assert got.count() == n == got.where(right & (F.col("depth") == 0)).count()
    assert jobs < 250


def test_flatten_and_orient(spark):
    rel = ('[{"type":"label ownership","direction":"forward","target-type":"label","label":{"id":"k","name":"Kid"}},'
           '{"type":"imprint","direction":"backward","target-type":"label","label":{"id":"p","name":"Parent"}},'
           '{"type":"imprint","target-type":"label","label":{"id":"q","name":"Q"}},'
           '{"type":"distribution","direction":"backward","target-type":"label","label":{"id":"d","name":"D"}},'
           '{"type":"label ownership","direction":"backward","target-type":"artist","artist":{"id":"z"}}]')
    lab = spark.createDataFrame([("me", "Me", rel), ("none", "None", None)],
                                "label_id string, label_name string, relations string")
    flat = flatten_relations(lab)
    assert flat.count() == 4
    edges = {(r.owned_label_id, r.owner_label_id) for r in orient_edges(flat).collect()}
    assert edges == {("k", "me"), ("me", "p")}


def test_ownership_paths(spark):
    rows = [("a", "b", "A", "B"), ("b", "a", "B", "A"), ("b", "c", "B", "C"), ("c", "b", "C", "B"), ("c", "b", "C", "Bee")]
    e = spark.createDataFrame(rows, EDGE_SCHEMA)
    lab = spark.createDataFrame([(k, k.upper()) for k in "abc"], "label_id string, label_name string")
    got = {r.label_id: r for r in ownership_paths(lab, e, 3).collect()}
    assert {k: (r.ownership_path, r.depth, r.stopped_at_bound) for k, r in got.items()} == {
        "a": ("A > B > A > B", 3, True), "b": ("B > A > B > A", 3, True), "c": ("C > B > A > B", 3, True)}
