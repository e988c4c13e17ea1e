"""Graphs as edge tables (src, dst, both directions): neighbourhoods, walks, distances."""

from __future__ import annotations

import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type

from .tables import cut, discard

#: Edges up to which the rest of a contraction is solved in one task.
LOCAL_EDGES = 50_000
#: Moves of a node that stay together in a walk: a hub is dealt over as many parts as it needs, other nodes are one.
TOGETHER = 10_000


def build_edges(pairs: DataFrame, score_min: float) -> DataFrame:
    """Undirected edges of (a, b, score): loops and low scores dropped, the best of repeats kept."""
    kept = pairs.filter((F.col("a") != F.col("b")) & (F.col("score") >= score_min))
    return kept.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b"), "score").groupBy("a", "b").agg(F.max("score").alias("score"))


def both_ways(edges: DataFrame) -> DataFrame:
    return edges.select(F.col("a").alias("src"), F.col("b").alias("dst"), "score").unionAll(edges.select("b", "a", "score"))


def degree(sym: DataFrame) -> DataFrame:
    return sym.groupBy(F.col("src").alias("node")).agg(F.count("*").alias("degree"))


def degree_bins(degrees: DataFrame, size: int) -> DataFrame:
    """Equal-population bins by (degree, node); a short last bin joins the one before.

    Positions come from per-degree counts and numbers inside a degree, so no task
    sorts all nodes.
    """
    per = degrees.groupBy("degree").agg(F.count("*").alias("n"))
    line = Window.orderBy("degree")
    every = Window.orderBy(F.lit(1)).rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    starts = per.select("degree", (F.sum("n").over(line) - F.col("n")).alias("start"), F.sum("n").over(every).alias("total"))
    inside = F.row_number().over(Window.partitionBy("degree").orderBy("node"))
    placed = degrees.withColumn("i", inside).join(starts, "degree").withColumn("rn", F.col("start") + F.col("i"))
    last = F.greatest(F.floor(F.col("total") / size) - 1, F.lit(0))
    return placed.select("node", "degree", F.least(F.floor((F.col("rn") - 1) / size), last).cast("bigint").alias("bin"))


def seeds(sym: DataFrame, node, strong: float) -> DataFrame:
    """The node and its neighbours by edges of at least ``strong``; an absent node is an error."""
    near = sym.filter((F.col("src") == node) & (F.col("score") >= strong)).select(F.col("dst").alias("node"))
    own = sym.filter(F.col("src") == node).select(F.col("src").alias("node")).distinct()
    if own.isEmpty():
        raise ValueError(f"node {node!r} is not in the graph")
    return own.unionAll(near).distinct()


def random_walk(sym: DataFrame, seed_nodes: DataFrame, restart: float, rounds: int, tolerance: float = 1e-10, together: int = TOGETHER) -> DataFrame:
    """Random walk with restart over weighted edges: ``node, score``.

    Mass moves by weight over out-strength, until no score moves by more than
    ``tolerance`` or ``rounds`` rounds are done.  Moves stay partitioned and sorted by
    (node, salt) over all rounds: only scores are shuffled and sorted, and a hub's moves lie
    in several partitions.
    """
    strength = sym.groupBy("src").agg(F.sum("score").alias("total"), (F.floor(F.count("*") / together) + 1).cast("int").alias("salts"))
    n = seed_nodes.count()
    at_start = strength.select(F.col("src").alias("node"), "salts").join(seed_nodes.withColumn("s", F.lit(1.0 / n)), "node", "left")
    homes = cut(at_start.select("node", "salts", F.coalesce("s", F.lit(0.0)).alias("home")))
    parts = int(sym.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    salt = F.pmod(F.xxhash64("dst"), F.col("salts").cast("bigint")).cast("int")
    laid_out = cut(sym.join(strength, "src").select("src", salt.alias("salt"), "dst", (F.col("score") / F.col("total")).alias("share")))
    # a lost part is dealt again from the table; the sort is kept with it, so no round sorts the moves again
    moves = laid_out.repartition(parts, "src", "salt").sortWithinPartitions("src", "salt").persist()
    # laid out by node once: each round joins what flows in, which comes by node too
    start = homes.repartition(parts, "node").sortWithinPartitions("node").persist()
    score = start.select("node", "salts", F.col("home").alias("score"))
    salts = F.explode(F.sequence(F.lit(0), F.col("salts") - 1))

    def step(score: DataFrame) -> DataFrame:
        laid = score.filter("score > 0").select(F.col("node").alias("src"), salts.alias("salt"), "score")
        moved = laid.join(moves, ["src", "salt"]).groupBy(F.col("dst").alias("node")).agg(F.sum(F.col("score") * F.col("share")).alias("inflow"))
        return start.join(moved, "node", "left").select("node", "salts", ((1 - restart) * F.coalesce("inflow", F.lit(0.0)) + restart * F.col("home")).alias("score"))

    done, held = 0, score
    while done < rounds:  # four rounds a look at the tolerance; the last is compared with the one before
        batch = min(4, rounds - done)
        for _ in range(batch - 1):
            score = step(score)
        last = cut(score) if batch > 1 else score
        both = cut(step(last).join(last.select("node", F.col("score").alias("old")), "node"))
        discard(last, held)
        held, done = both, done + batch
        off = both.agg(F.max(F.abs(F.col("score") - F.col("old"))).alias("d")).first()["d"]
        score = both.select("node", "salts", "score")
        if off is None or off <= tolerance:
            break
    moves.unpersist()
    start.unpersist()
    discard(laid_out, homes)
    return score.select("node", "score")


def top_module(scores: DataFrame, seed_nodes: DataFrame, size: int) -> DataFrame:
    """The best ``size`` nodes with all seeds pinned first: ``node, score, is_seed, rank``."""
    n = max(size, seed_nodes.count())
    marked = scores.join(seed_nodes.withColumn("is_seed", F.lit(True)), "node", "left").withColumn("is_seed", F.coalesce("is_seed", F.lit(False)))
    top = marked.orderBy(F.desc("is_seed"), F.desc("score"), "node").limit(n)
    return top.withColumn("rank", F.row_number().over(Window.orderBy(F.desc("is_seed"), F.desc("score"), "node")))


def _walked(sym: DataFrame, sources: DataFrame, most: int | None) -> DataFrame:
    """Hops over a bounded number of edges, in one task; the sources are few next to the edges or ends of them."""
    kind, arrow = sym.schema["src"].dataType.simpleString(), to_arrow_type(sym.schema["src"].dataType)
    rows = sym.select("src", "dst").unionAll(sources.select(F.col("node"), F.lit(None).cast(kind)))

    def run(batches):
        near: dict = {}
        seen: dict = {}
        for batch in batches:
            for a, b in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                if b is None:
                    seen[a] = 0
                else:
                    near.setdefault(a, []).append(b)
        front, hops = list(seen), 0
        while front and (most is None or hops < most):
            hops += 1
            front = list(dict.fromkeys(b for a in front for b in near.get(a, ()) if b not in seen))
            seen.update(dict.fromkeys(front, hops))
        yield pa.RecordBatch.from_arrays([pa.array(list(seen), arrow), pa.array(list(seen.values()), pa.int64())], names=["node", "distance"])

    return rows.coalesce(1).mapInArrow(run, f"node {kind}, distance bigint")


def bfs_distances(sym: DataFrame, sources: DataFrame, most: int | None = None, local_edges: int = LOCAL_EDGES) -> DataFrame:
    """Hops from the nearest source: ``node, distance``; unreachable nodes are absent.

    Edges go both ways, so neighbours of one front lie in it, in the one before
    or in the next: no step looks at all that was seen.  A graph of at most ``local_edges`` edges
    with as many sources is walked in one task.
    """
    if sym.limit(local_edges + 1).count() <= local_edges and sources.limit(local_edges + 1).count() <= local_edges:
        return cut(_walked(sym, sources, most))
    front = cut(sources.select("node").distinct().withColumn("distance", F.lit(0).cast("bigint")))
    fronts = [front]
    while most is None or len(fronts) <= most:
        step = front.select("node").join(sym, F.col("node") == F.col("src")).select(F.col("dst").alias("node")).distinct()
        for near in fronts[-2:]:
            step = step.join(near.select("node"), "node", "left_anti")
        front = cut(step.withColumn("distance", F.lit(len(fronts)).cast("bigint")))
        if front.isEmpty():
            discard(front)
            break
        fronts.append(front)
    out = fronts[0]
    for f in fronts[1:]:
        out = out.unionAll(f)
    return out


def solved(edges: DataFrame) -> DataFrame:
    """``a, p``: the least node that each end of a bounded number of edges reaches, in one task."""
    kind = edges.schema["a"].dataType.simpleString()

    def run(it):
        import pandas as pd

        parent: dict = {}

        def root(x):
            while parent.setdefault(x, x) != x:
                parent[x] = parent[parent[x]]
                x = parent[x]
            return x

        for pdf in it:
            for a, b in zip(pdf["a"], pdf["b"]):
                a, b = root(a), root(b)
                if a != b:
                    parent[max(a, b)] = min(a, b)
        yield pd.DataFrame({"a": list(parent), "p": [root(x) for x in list(parent)]})

    return edges.select("a", "b").coalesce(1).mapInPandas(run, f"a {kind}, p {kind}")


def components(sym: DataFrame, local_edges: int = LOCAL_EDGES) -> DataFrame:
    """``node, component``: the least node that can be reached.

    Contraction halves the nodes that still have edges every round; once at most
    ``local_edges`` edges are left, one task joins the rest.
    """
    edges = cut(sym.select(F.col("src").alias("a"), F.col("dst").alias("b")).distinct())
    labels = edges.select(F.col("a").alias("node")).distinct().withColumn("component", F.col("node"))

    def relabelled(parent: DataFrame) -> DataFrame:
        root = parent.select(F.col("a").alias("component"), "p")
        return cut(labels.join(root, "component", "left").select("node", F.coalesce("p", "component").alias("component")))

    held = [edges]  # tables that this round reads and the next one does not
    edges = edges.filter("a <> b")
    while edges.count() > local_edges:
        jumped = cut(edges.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("p")))
        parent = jumped
        while True:
            up = parent.select(F.col("a").alias("p"), F.col("p").alias("pp"))
            before, jumped = jumped, cut(parent.join(up, "p").select("a", "p", "pp"))
            discard(before)
            parent = jumped.select("a", F.col("pp").alias("p"))
            if jumped.filter("p <> pp").isEmpty():
                break
        labels = relabelled(parent)
        ends = edges.join(parent, "a").select(F.col("p").alias("x"), F.col("b").alias("a")).join(parent, "a").select(F.col("x").alias("a"), F.col("p").alias("b"))
        edges = cut(ends.filter("a <> b").distinct())
        discard(jumped, *held)
        held = [edges, labels]
    out = relabelled(solved(edges))
    discard(*held)
    return out


def largest_component(sym: DataFrame) -> DataFrame:
    """Nodes of the largest component; of equal ones that with the least node."""
    c = components(sym)
    best = c.groupBy("component").agg(F.count("*").alias("n")).orderBy(F.desc("n"), "component").limit(1)
    return c.join(F.broadcast(best), "component").select("node")


def split_by_groups(members: DataFrame, memberships: DataFrame, root, bound: int) -> DataFrame:
    """``node, side, shared``: upstream if it shares a group of at most ``bound`` with the root."""
    sizes = memberships.groupBy("grp").agg(F.count("*").alias("n")).filter(F.col("n") <= bound)
    small = memberships.join(sizes.select("grp"), "grp")
    of_root = small.filter(F.col("node") == root).select("grp").distinct()
    shared = small.join(of_root, "grp").groupBy("node").agg(F.array_sort(F.collect_set("grp")).alias("shared"))
    return members.select("node").join(shared, "node", "left").select(
        "node", F.when(F.col("shared").isNotNull(), "upstream").otherwise("downstream").alias("side"), F.coalesce("shared", F.array().cast("array<string>")).alias("shared")
    )


def resolve_parents(pairs: DataFrame, most: int = 10) -> DataFrame:
    """``id, root, hops``: parents followed for at most ``most`` steps, cycles stopped at revisit."""
    state = pairs.select("id", F.col("id").alias("at"), F.array("id").alias("seen"), F.lit(False).alias("stop"))
    up = pairs.select(F.col("id").alias("at"), F.col("parent").alias("up"))
    for k in range(most):
        step = state.join(up, "at", "left")
        ends = F.col("stop") | F.col("up").isNull() | F.array_contains("seen", F.col("up"))
        state = step.select(
            "id",
            F.when(ends, F.col("at")).otherwise(F.col("up")).alias("at"),
            F.when(ends, F.col("seen")).otherwise(F.array_append("seen", F.col("up"))).alias("seen"),
            ends.alias("stop"),
        )
        if k % 4 == 3:
            state = cut(state)
    return state.select("id", F.col("at").alias("root"), (F.size("seen") - 1).cast("bigint").alias("hops"))
