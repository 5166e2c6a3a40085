"""Ownership graph: relations -> edges -> ultimate owner.

Two resolutions, as in the reference, kept apart:

``resolve_owners`` (graph job semantics, G2-G6): for every label, the owners
reachable upward; among those with no owner ("roots") the nearest wins, ties
by smallest id; depth is the shortest path.  A label that reaches no root
(only cycles above it) takes, with depth 0, the smallest id other than its own
in the terminal components it reaches: the cycles that no edge leads out of (a
self-loop is one).  A label with no edge, or only a self-loop, owns itself.

It is computed set-wise, never per label, with a row for each label or edge:

1. a label with one owner has the answer of that owner, one level further, so
   chains of such labels are jumped over by pointer doubling: rounds are the
   logarithm of a chain's length, not its length;
2. labels with several owners are joined by the edges that the jumps leave, with
   the jumped lengths; the nearest root comes down these edges round by round,
   ``min((depth, root))`` for each label;
3. only labels that reached no root are left: rings of single owners are found
   by the same doubling, which gathers their two smallest ids; components of
   labels with several owners by colouring each with the smallest label it
   reaches, walking forward from each colour's own label, and asking whether
   an edge leaves what the walk found.  Their two smallest ids come down the edges.

The rounds of 2 and 3 grow with the number of labels with several owners in a
row, the others with its logarithm.

``walk_paths`` (SQL-model semantics, G7/W2): depth-limited walk from every
label with an ``a > b > c`` path, and the deepest row per label.  The reference
keeps a row for every walk; here a row stands for all walks of a label that end
in the same node at the same depth, and holds the smallest of their paths, so
the rows are linear in the depth however many owners a label has.  A path is
an array of names, whose order survives appending.

Every round is cut from its lineage with a reliable checkpoint, so a lost
executor recomputes one round, not the whole walk.  Joins carry no hint:
AQE broadcasts a side by its bytes or splits a hub owner's partition.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Observation, Window
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, StringType, StructField, StructType

from ..functions.rules import RuleTable, OWNER_RULES, PATH_OWNER_RULES, owner_group, path_owner_group
from ..session import cut_lineage, cut_lineage_counted

# --- fixed values: relation filters of the reference ------------------------
OWNERSHIP_TYPES = ("label ownership", "imprint")
FORWARD = "forward"
LABEL_TARGET = "label"
UNKNOWN_NAME = "Unknown"
PATH_SEPARATOR = " > "
# ---------------------------------------------------------------------------

RELATION_SCHEMA = ArrayType(StructType([
    StructField("type", StringType()),
    StructField("direction", StringType()),
    StructField("target-type", StringType()),
    StructField("label", StructType([StructField("id", StringType()), StructField("name", StringType())])),
]))

# pointers are followed so many times between two checkpoints
HOPS = 3
# the walk takes so many levels between two checkpoints
LEVELS = 5


def flatten_relations(labels: DataFrame, id_col: str = "label_id", name_col: str = "label_name",
                      relations_col: str = "relations") -> DataFrame:
    """One row per label-to-label relation."""
    rel = F.from_json(F.col(relations_col), RELATION_SCHEMA)
    x = (labels.where(F.col(relations_col).isNotNull())
         .select(F.col(id_col).alias("child_label_id"), F.col(name_col).alias("child_label_name"),
                 F.explode(rel).alias("r")))
    return (x.where(F.col("r.`target-type`") == F.lit(LABEL_TARGET))
            .select("child_label_id", "child_label_name",
                    F.col("r.type").alias("relationship_type"),
                    F.col("r.direction").alias("direction"),
                    F.col("r.label.id").alias("parent_label_id"),
                    F.col("r.label.name").alias("parent_label_name")))


def orient_edges(relations: DataFrame, types: Sequence[str] = OWNERSHIP_TYPES) -> DataFrame:
    """Edges owned -> owner with names (P7): 'forward' means this label owns
    the target; any other direction means the target owns this label."""
    fwd = F.col("direction") == F.lit(FORWARD)
    pick = lambda a, b: F.when(fwd, F.col(a)).otherwise(F.col(b))
    return (relations.where(F.col("relationship_type").isin(list(types)) & F.col("direction").isNotNull())
            .select(pick("parent_label_id", "child_label_id").alias("owned_label_id"),
                    pick("child_label_id", "parent_label_id").alias("owner_label_id"),
                    pick("parent_label_name", "child_label_name").alias("owned_label_name"),
                    pick("child_label_name", "parent_label_name").alias("owner_label_name")))


def edge_set(edges: DataFrame, owned: str = "owned_label_id", owner: str = "owner_label_id") -> DataFrame:
    """Distinct ``(o, p)`` edges without NULL ends (G1: a simple digraph)."""
    return (edges.where(F.col(owned).isNotNull() & F.col(owner).isNotNull())
            .select(F.col(owned).alias("o"), F.col(owner).alias("p")).distinct())


def _union(frames: list[DataFrame]) -> DataFrame:
    out = frames[0]
    for f in frames[1:]:
        out = out.unionByName(f)
    return out


def _two(ids: Column) -> Column:
    """The two smallest different ids of an array."""
    return F.slice(F.array_sort(F.array_distinct(ids)), 1, 2)


def _jump(step: DataFrame) -> DataFrame:
    """``(v, end, dist, low, open)`` for ``step(v, succ)``, one successor for each v.

    ``end`` is the first label on the chain from v that has no row in ``step``,
    ``dist`` steps away, and ``low`` the two smallest ids from v up to it.  A
    chain that runs into a ring never ends: its rows stay ``open`` with an end on
    the ring, and the ``low`` of a row on the ring is that of the whole ring.

    Hierarchies are wide and shallow, so labels that own nothing are set aside
    first, layer by layer, for as long as a layer is at least half of what is
    left; pointers are doubled among the rest, and the layers follow by a join each.
    """
    core, n = cut_lineage_counted(step.select("v", "succ"))
    layers = []
    while n:
        owning, m = cut_lineage_counted(core.join(core.select(F.col("succ").alias("v")).distinct(), "v", "left_semi"))
        if m > n / 2:
            break
        layers.append(core.join(owning.select("v"), "v", "left_anti"))
        core, n = owning, m
    state = core.select("v", F.col("succ").alias("end"), F.lit(1).cast("long").alias("dist"), F.array("v").alias("low"))
    found = _double(state, n) if n else state.withColumn("open", F.lit(False))
    for layer in reversed(layers):
        next_up = found.select(F.col("v").alias("succ"), "end", "dist", "low", "open")
        rows = layer.join(next_up, "succ", "left").select(
            "v", F.coalesce("end", "succ").alias("end"), (F.coalesce("dist", F.lit(0).cast("long")) + 1).alias("dist"),
            F.when(F.col("low").isNull(), F.array("v")).otherwise(_two(F.concat(F.array("v"), "low"))).alias("low"),
            F.coalesce("open", F.lit(False)).alias("open"))
        found = found.unionByName(cut_lineage(rows))
    return found


def _double(state: DataFrame, n: int) -> DataFrame:
    """Pointer doubling of ``_jump`` over its n rows."""
    done, active, reach = [], state, 1
    while True:
        base = _union([*done, active]).select(F.col("v").alias("end"), F.col("end").alias("_end"), F.col("dist").alias("_dist"),
                                              F.col("low").alias("_low"))
        moved = active
        for _ in range(HOPS):
            moved = moved.join(base, "end", "left").select(
                "v", F.coalesce("_end", "end").alias("end"), (F.col("dist") + F.coalesce("_dist", F.lit(0))).alias("dist"),
                F.when(F.col("_end").isNull(), F.col("low")).otherwise(_two(F.concat("low", "_low"))).alias("low"),
                F.col("_end").isNotNull().alias("open"))
        reach *= HOPS + 1
        obs = Observation()
        moved = cut_lineage(moved.observe(obs, F.count(F.when(F.col("open"), 1)).alias("n")))
        if not obs.get["n"] or reach >= 2 * n:     # every row is on a ring, or leads into one
            return _union([*[x.withColumn("open", F.lit(False)) for x in done], moved])
        done.append(moved.where("not open").drop("open"))
        active = moved.where("open").drop("open")


def _settle(start: DataFrame, edges: DataFrame, via) -> DataFrame:
    """The least value of each label: ``start(node, value)`` and, round by round, what
    ``via(value, edge columns)`` makes of the values of the labels that ``edges(frm, to, ...)``
    lead to, until none gets smaller."""
    best = start
    changed = start
    while True:
        offered = edges.join(changed.select(F.col("node").alias("to"), "value"), "to")
        offered = offered.groupBy(F.col("frm").alias("node")).agg(F.min(via(F.col("value"))).alias("new"))
        better = offered.join(best, "node", "left").where(F.col("value").isNull() | (F.col("new") < F.col("value")))
        changed, n = cut_lineage_counted(better.select("node", F.col("new").alias("value")))
        if n == 0:
            return best
        best = cut_lineage(best.join(changed, "node", "left_anti").unionByName(changed))


def _terminal_lows(nodes: DataFrame, inner: DataFrame, leaving: DataFrame) -> DataFrame:
    """``(node, value)``: the two smallest ids of the terminal component of each label in one.

    ``nodes(node)`` have several owners each, ``inner(frm, to, low)`` are the edges among them with the ids
    they jumped over, ``leaving(frm)`` the labels with an edge to something else."""
    colour = _settle(nodes.select("node", F.col("node").alias("value")), inner.select("frm", "to"), lambda v: v)
    of = lambda end: colour.select(F.col("node").alias(end), F.col("value").alias(f"c_{end}"))
    within = cut_lineage(inner.join(of("frm"), "frm").join(of("to"), "to"))
    same = within.where("c_frm = c_to").select("frm", "to")
    found = cut_lineage(colour.where("node = value").select("node"))
    frontier = found
    while True:
        ahead = frontier.select(F.col("node").alias("frm")).join(same, "frm").select(F.col("to").alias("node")).distinct()
        frontier, n = cut_lineage_counted(ahead.join(found, "node", "left_anti"))
        if n == 0:
            break
        found = cut_lineage(found.unionByName(frontier))
    member = found.join(colour, "node").select("node", F.col("value").alias("c"))
    # an edge of a member that does not end in a member of the same colour leaves the component
    ends = within.join(member.select(F.col("node").alias("frm"), "c"), "frm").join(
        member.select(F.col("node").alias("to"), F.col("c").alias("c_end")), "to", "left")
    gone = ends.where("c_end is null or c_end <> c").select("c").unionByName(
        leaving.select(F.col("frm").alias("node")).join(member, "node").select("c")).distinct()
    kept = cut_lineage(member.join(gone, "c", "left_anti"))
    ids = kept.select("c", F.array("node").alias("ids")).unionByName(
        ends.where("c_end = c").select("c", F.col("low").alias("ids")))
    # two smallest ids: the least, and the least of the others
    each = ids.select("c", F.explode("ids").alias("id"))
    least = cut_lineage(each.groupBy("c").agg(F.min("id").alias("a")))
    other = each.join(least, "c").where("id > a").groupBy("c").agg(F.min("id").alias("b"))
    lows = least.join(other, "c", "left").select("c", F.when(F.col("b").isNull(), F.array("a")).otherwise(F.array("a", "b")).alias("value"))
    return kept.join(lows, "c").select("node", "value")


def _without_root(jumped: DataFrame, fork: DataFrame | None, loops: DataFrame) -> DataFrame:
    """``(label_id, ultimate_id)`` of labels that reach no root: ``jumped`` (``_jump``'s rows) have one owner,
    ``fork(frm, succ)`` several (None without any), ``loops(node)`` only themselves."""
    on_ring = jumped.where("open").select(F.col("end").alias("at")).distinct()
    ring = on_ring.join(jumped.select(F.col("v").alias("at"), F.col("low").alias("ring")), "at")
    # what a chain ends in: a ring's two smallest ids, or a label
    chain = cut_lineage(jumped.join(ring, jumped["end"] == ring["at"], "left").select(
        "v", "low", F.when(F.col("ring").isNull(), F.col("end")).alias("end"), "ring"))
    loop_ends = loops.select(F.col("node").alias("end"), F.array("node").alias("loop"))
    final = chain.join(loop_ends, "end", "left")
    if fork is None:
        answers = final.select(F.col("v").alias("node"), F.coalesce("ring", "loop").alias("value"))
    else:
        edges = fork.join(chain.select(F.col("v").alias("succ"), "low", "end", "ring", F.lit(True).alias("jumped")), "succ", "left").select(
            "frm", F.when(F.col("jumped"), F.col("end")).otherwise(F.col("succ")).alias("end"), "ring",
            F.coalesce("low", F.array().cast("array<string>")).alias("low"))
        edges = cut_lineage(edges.join(loop_ends, "end", "left").select(
            "frm", "low", F.when(F.coalesce("ring", "loop").isNull(), F.col("end")).alias("to"), F.coalesce("ring", "loop").alias("final")))
        nodes = fork.select(F.col("frm").alias("node")).distinct()
        inner, leaving = edges.where("to is not null").select("frm", "to", "low"), edges.where("final is not null")
        terminal = _terminal_lows(nodes, inner, leaving.select("frm").distinct())
        out = leaving.groupBy(F.col("frm").alias("node")).agg(F.min("final").alias("value"))
        start = cut_lineage(terminal.unionByName(out))      # a label with an edge that leaves is in no terminal component
        settled = _settle(start, inner.select("frm", "to"), lambda v: v)
        final = final.join(settled.select(F.col("node").alias("end"), F.col("value").alias("settled")), "end", "left")
        answers = settled.select("node", "value").unionByName(
            final.select(F.col("v").alias("node"), F.coalesce("ring", "settled", "loop").alias("value")))
    own = F.col("value")[0] == F.col("node")
    return answers.select(F.col("node").alias("label_id"), F.when(own, F.get("value", F.lit(1))).otherwise(F.col("value")[0]).alias("ultimate_id"))


def resolve_owners(edges: DataFrame) -> DataFrame:
    """``(label_id, ultimate_id, depth)`` for every node with an outgoing edge
    other than a self-loop (G2-G5).  Labels absent from the result own
    themselves at depth 0."""
    # the edge set feeds every round: materialise it once
    e = cut_lineage(edges.select("o", "p"))
    walk = e.where(F.col("o") != F.col("p"))
    owners = cut_lineage(walk.groupBy("o").agg(F.count(F.lit(1)).alias("n"), F.min("p").alias("succ")))
    step = owners.where("n = 1").select(F.col("o").alias("v"), "succ")
    fork = walk.join(owners.where("n > 1").select("o"), "o", "left_semi").select(F.col("o").alias("frm"), F.col("p").alias("succ"))
    sinks = walk.select(F.col("p").alias("node")).distinct().join(owners.select(F.col("o").alias("node")), "node", "left_anti")
    selfish = e.where(F.col("o") == F.col("p")).select(F.col("o").alias("node")).distinct()
    roots = cut_lineage(sinks.join(selfish, "node", "left_anti"))
    jumped = _jump(step)
    # 2. the nearest root of the labels with several owners
    found = roots.select("node", F.struct(F.lit(0).cast("long").alias("depth"), F.col("node").alias("root")).alias("value"))
    forked, n_forked = cut_lineage_counted(fork.join(jumped.select(F.col("v").alias("succ"), "end", "dist"), "succ", "left").select(
        "frm", F.coalesce("end", "succ").alias("to"), (F.coalesce("dist", F.lit(0)) + 1).alias("steps")).groupBy("frm", "to").agg(F.min("steps").alias("steps")))
    if n_forked:
        found = _settle(found, forked, lambda v: F.struct((v["depth"] + F.col("steps")).alias("depth"), v["root"].alias("root")))
    ends = found.select(F.col("node").alias("end"), "value")
    best = cut_lineage(jumped.join(ends, "end").select(
        F.col("v").alias("label_id"), F.col("value.root").alias("ultimate_id"), (F.col("dist") + F.col("value.depth")).cast("int").alias("depth"))
        .unionByName(found.where("value.depth > 0").select(
            F.col("node").alias("label_id"), F.col("value.root").alias("ultimate_id"), F.col("value.depth").cast("int").alias("depth"))))
    # 3. those that reach none
    rooted = best.select("label_id")
    lost, n_lost = cut_lineage_counted(owners.join(rooted, owners["o"] == rooted["label_id"], "left_anti").select(F.col("o").alias("v")))
    if not n_lost:
        return best
    lost_fork = None
    if n_forked:
        lost_fork, n_lost_fork = cut_lineage_counted(fork.join(lost.select(F.col("v").alias("frm")), "frm", "left_semi"))
        lost_fork = lost_fork if n_lost_fork else None
    far = _without_root(cut_lineage(jumped.join(lost, "v", "left_semi")), lost_fork, cut_lineage(sinks.join(selfish, "node", "left_semi")))
    return best.unionByName(far.withColumn("depth", F.lit(0)))


def label_dimension(labels: DataFrame, edges: DataFrame, rules: RuleTable = OWNER_RULES,
                    id_col: str = "label_id", name_col: str = "label_name") -> DataFrame:
    """Every label with its ultimate owner's name, group and depth.

    Owner names come from the label table; an owner id missing from it is
    named 'Unknown'; an existing label with a NULL name stays NULL (and is
    grouped 'Independent / Unknown').  Names are looked up for the distinct
    owners, few as they are, before they meet the labels.
    """
    lab = labels.select(F.col(id_col).alias("label_id"), F.col(name_col).alias("label_name"))
    owners = cut_lineage(resolve_owners(edge_set(edges)))
    known = lab.select(F.col("label_id").alias("ultimate_id"), F.col("label_name").alias("_n"))
    names = (owners.select("ultimate_id").distinct().join(known.withColumn("_there", F.lit(True)), "ultimate_id", "left")
             .groupBy("ultimate_id").agg(F.min("_n").alias("_n"), F.max("_there").alias("_there")))
    names = names.select("ultimate_id", F.when(F.col("_there"), F.col("_n")).otherwise(F.lit(UNKNOWN_NAME)).alias("_uname"))
    x = lab.join(owners, "label_id", "left").join(names, "ultimate_id", "left")
    parent = F.when(F.col("ultimate_id").isNull(), F.col("label_name")).otherwise(F.col("_uname"))
    return x.select("label_id", "label_name", F.coalesce("ultimate_id", "label_id").alias("ultimate_id"),
                    parent.alias("ultimate_parent_name"), owner_group(parent, rules).alias("market_share_group"),
                    F.coalesce("depth", F.lit(0)).alias("hierarchy_depth"))


def _named_edges(edges: DataFrame) -> DataFrame:
    return cut_lineage(edges.select(F.col("owned_label_id").alias("current_id"), F.col("owner_label_id").alias("next_id"),
                                    F.col("owner_label_name").alias("next_name")).distinct())


def walk_paths(labels: DataFrame, edges: DataFrame, max_depth: int,
               id_col: str = "label_id", name_col: str = "label_name") -> DataFrame:
    """Upward walk from every label, depth 0..max_depth (G7 body): a row for each
    (label, node, depth) with the smallest path, an array of names, or NULL
    once an owner on it has no name.

    ``edges`` carry ``owned_label_id, owner_label_id, owner_label_name``.
    ``stopped_at_bound`` marks a row of the last depth whose node has owners.
    """
    e = _named_edges(edges)
    level = labels.select(F.col(id_col).alias("label_id"), F.col(name_col).alias("label_name"),
                          F.col(id_col).alias("current_id"), F.col(name_col).alias("current_name"),
                          F.lit(0).alias("depth"), F.when(F.col(name_col).isNotNull(), F.array(name_col)).alias("path"))
    levels = [level]
    for d in range(1, max_depth + 1):
        path = F.when(F.col("next_name").isNotNull(), F.concat(F.col("path"), F.array("next_name")))
        step = level.join(e, "current_id").groupBy("label_id", "label_name", F.col("next_id").alias("current_id")).agg(
            F.min(F.struct(path.alias("path"), F.col("next_name").alias("name"))).alias("w"))
        level, n = cut_lineage_counted(step.select("label_id", "label_name", "current_id", F.col("w.name").alias("current_name"),
                                                   F.lit(d).alias("depth"), F.col("w.path").alias("path")))
        if n == 0:
            break
        levels.append(level)
    owned = e.select("current_id", F.lit(True).alias("_owned")).distinct()
    stopped = (F.col("depth") == max_depth) & F.coalesce("_owned", F.lit(False))
    return _union(levels).join(owned, "current_id", "left").withColumn("stopped_at_bound", stopped).drop("_owned")


def ownership_paths(labels: DataFrame, edges: DataFrame, max_depth: int, rules: RuleTable = PATH_OWNER_RULES,
                    id_col: str = "label_id", name_col: str = "label_name") -> DataFrame:
    """G7 result: deepest path per label within ``max_depth``, with its owner group.

    The rows of ``deepest_path(walk_paths(...))`` without keeping the levels: a
    row moves on to its owners, and stays where it has none; ``LEVELS`` moves
    make one plan and one checkpoint."""
    e = _named_edges(edges)
    best = lambda: F.min(F.struct("path", "current_name", "label_name")).alias("w")
    rows = labels.select(F.col(id_col).alias("label_id"), F.col(id_col).alias("current_id"), F.lit(0).alias("depth"),
                         F.struct(F.when(F.col(name_col).isNotNull(), F.array(name_col)).alias("path"),
                                  F.col(name_col).alias("current_name"), F.col(name_col).alias("label_name")).alias("w"))
    way = e.withColumn("there", F.lit(True))
    for d in range(1, max_depth + 1):
        path = F.when(F.col("next_name").isNotNull(), F.concat(F.col("w.path"), F.array("next_name")))
        here = F.col("there").isNull()
        rows = rows.join(way, "current_id", "left").select(
            "label_id", F.when(here, F.col("current_id")).otherwise(F.col("next_id")).alias("current_id"),
            F.when(here, F.col("depth")).otherwise(F.lit(d)).alias("depth"),
            F.when(here, F.col("w.path")).otherwise(path).alias("path"),
            F.when(here, F.col("w.current_name")).otherwise(F.col("next_name")).alias("current_name"),
            F.col("w.label_name").alias("label_name")).groupBy("label_id", "current_id", "depth").agg(best())
        if d % LEVELS == 0 and d < max_depth:
            obs = Observation()
            rows = cut_lineage(rows.observe(obs, F.count(F.when(F.col("depth") == d, 1)).alias("n")))
            if not obs.get["n"]:
                break
    top = rows.groupBy("label_id").agg(F.min(F.struct((-F.col("depth")).alias("rise"), "current_id", "w")).alias("t"))
    owned = e.select(F.col("current_id").alias("t_id"), F.lit(True).alias("owned")).distinct()
    x = top.join(owned, F.col("t.current_id") == F.col("t_id"), "left")
    depth, name = -F.col("t.rise"), F.col("t.w.current_name")
    return x.select("label_id", F.col("t.w.label_name").alias("label_name"), name.alias("ultimate_parent_name"),
                    F.array_join("t.w.path", PATH_SEPARATOR).alias("ownership_path"), path_owner_group(name, rules).alias("market_share_group"),
                    depth.alias("depth"), ((depth == max_depth) & F.coalesce("owned", F.lit(False))).alias("stopped_at_bound"))


def deepest_path(walk: DataFrame, rules: RuleTable = PATH_OWNER_RULES) -> DataFrame:
    """Deepest walk row per label, ties by owner id then path (W2), and the
    owner group by rules B (G7 result)."""
    w = Window.partitionBy("label_id").orderBy(F.col("depth").desc(), F.col("current_id").asc_nulls_first(),
                                               F.col("path").asc_nulls_first())
    top = walk.withColumn("_rn", F.row_number().over(w)).where(F.col("_rn") == 1)
    return top.select("label_id", "label_name",
                      F.col("current_name").alias("ultimate_parent_name"),
                      F.array_join("path", PATH_SEPARATOR).alias("ownership_path"),
                      path_owner_group("current_name", rules).alias("market_share_group"),
                      "depth", "stopped_at_bound")
