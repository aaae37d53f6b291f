"""Connected components, tree paths and spurs as rounds of joins."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from ..session import materialize


def undirected(edges: DataFrame, keys: list[str]) -> DataFrame:
    """Both directions of every edge, once."""
    a = edges.select(*keys, "src", "dst")
    return a.unionByName(a.select(*keys, F.col("dst").alias("src"), F.col("src").alias("dst"))).filter("src <> dst").distinct()


def connected_components(nodes: DataFrame, edges: DataFrame, keys: list[str]) -> DataFrame:
    """Smallest node id of each node's component.

    Each round lowers a label to the smallest among the neighbours (a minimum
    taken map side, so a hub costs no more than its partial results) and then
    jumps to the label of that label, which keeps the number of rounds near
    the logarithm of the longest path. Every round is a written table.
    """
    both = materialize(undirected(edges, keys), "cc-edges", grows=True)
    lab = materialize(nodes.select(*keys, "node", F.col("node").alias("comp")), "cc", grows=True)
    while True:
        near = both.join(lab.withColumnRenamed("node", "dst"), [*keys, "dst"]).groupBy(*keys, "src").agg(
            F.min("comp").alias("m"))
        low = lab.join(near.withColumnRenamed("src", "node"), [*keys, "node"], "left").select(
            *keys, "node", "comp", F.least("comp", F.coalesce("m", "comp")).alias("low"))
        low = materialize(low, "cc-low", grows=True)
        # lower the old root too, so that whole trees hang under the new one
        pull = low.groupBy(*keys, F.col("comp").alias("node")).agg(F.min("low").alias("p"))
        low = low.join(pull, [*keys, "node"], "left").select(
            *keys, "node", "comp", F.least("low", F.coalesce("p", "low")).alias("low"))
        roots = low.select(*keys, F.col("node").alias("low"), F.col("low").alias("up"))
        nxt = low.join(roots, [*keys, "low"]).select(
            *keys, "node", F.least("low", "up").alias("new"), (F.least("low", "up") != F.col("comp")).alias("moved"))
        nxt = materialize(nxt, "cc", grows=True)
        done = nxt.filter("moved").isEmpty()
        lab = nxt.select(*keys, "node", F.col("new").alias("comp"))
        if done:
            return lab


# --- voxel skeletons ----------------------------------------------------------
def voxel_id(z, y, x):
    """One number per voxel; coordinates are below two million."""
    return (z.cast("long") * (1 << 21) + y) * (1 << 21) + x


def with_node(vox: DataFrame) -> DataFrame:
    return vox.withColumn("node", voxel_id(F.col("z"), F.col("y"), F.col("x")))


def adjacency(vox: DataFrame, keys: list[str]) -> DataFrame:
    """Directed edges between voxels that touch by face, edge or corner."""
    around = F.array(*[
        F.struct(F.lit(i).alias("i"), F.lit(j).alias("j"), F.lit(k).alias("k"))
        for i in (-1, 0, 1) for j in (-1, 0, 1) for k in (-1, 0, 1) if (i, j, k) != (0, 0, 0)
    ])
    v = with_node(vox).hint("merge")
    step = v.withColumn("o", F.explode(around)).select(
        *keys, F.col("node").alias("src"), *[(F.col(c) + F.col(f"o.{n}")).alias(c) for c, n in zip("zyx", "ijk")],
        F.sqrt((F.col("o.i") * F.col("o.i") + F.col("o.j") * F.col("o.j") + F.col("o.k") * F.col("o.k")).cast("double")).alias("len"))
    return step.join(v.select(*keys, "z", "y", "x", F.col("node").alias("dst")), [*keys, "z", "y", "x"]).select(
        *keys, "src", "dst", "len")


def degrees(vox: DataFrame, adj: DataFrame, keys: list[str]) -> DataFrame:
    d = adj.groupBy(*keys, F.col("src").alias("node")).agg(F.count(F.lit(1)).alias("degree"))
    return with_node(vox).hint("merge").join(d, [*keys, "node"], "left").fillna(0, ["degree"])


def tree_report(vox: DataFrame, keys: list[str]) -> DataFrame:
    """Nodes, edges, ends, branch points, components; a tree or not."""
    adj = materialize(adjacency(vox, keys), "adjacency", grows=True)
    deg = degrees(vox, adj, keys)
    counts = deg.groupBy(*keys).agg(
        F.count(F.lit(1)).alias("n_nodes"), (F.sum("degree") / 2).cast("long").alias("n_edges"),
        F.count_if(F.col("degree") == 1).alias("n_ends"), F.count_if(F.col("degree") > 2).alias("n_branch"))
    cc = connected_components(with_node(vox), adj, keys)
    comp = cc.filter("node = comp").groupBy(*keys).agg(F.count(F.lit(1)).alias("n_components"))
    return counts.join(comp, keys).withColumn(
        "is_tree", (F.col("n_components") == 1) & (F.col("n_edges") == F.col("n_nodes") - 1))


def match_ends(ends: DataFrame, hints: DataFrame, keys: list[str], tolerance: float) -> DataFrame:
    """Nearest end of each hint; ties within 1e-9 and far matches are marked.

    The two smallest distances are kept by an aggregate, not by a window over
    all ends of a case.
    """
    d = F.sqrt(sum((F.col(f"w{a}") - F.col(f"h{a}")) * (F.col(f"w{a}") - F.col(f"h{a}")) for a in "xyz"))
    j = hints.join(ends.select(*keys, "node", "wx", "wy", "wz"), keys).withColumn("d", d)
    first = j.groupBy(*keys, "role").agg(F.min(F.struct("d", "node")).alias("b"))
    rest = j.join(first, [*keys, "role"]).filter(F.col("node") != F.col("b.node")).groupBy(*keys, "role").agg(
        F.min("d").alias("second"))
    out = first.join(rest, [*keys, "role"], "left")
    verdict = F.when(F.abs(F.col("second") - F.col("b.d")) <= 1e-9, "ambiguous").when(
        F.col("b.d") > tolerance + 1e-9, "too_far").otherwise("ok")
    return out.select(*keys, "role", F.col("b.node").alias("node"), F.col("b.d").alias("error_mm"), verdict.alias("verdict"))


def path_verdicts(vox: DataFrame, ends: DataFrame, keys: list[str]) -> DataFrame:
    """One verdict per case: may the path between ``ends`` (start, stop) be walked?

    disconnected, cyclic, too_few_ends, no_match (an end is missing), same_end
    or ok; the first that holds.
    """
    return tree_report(vox, keys).join(ends.select(*keys, "start", "stop"), keys, "left").select(
        *keys,
        F.when(F.col("n_components") > 1, "disconnected").when(~F.col("is_tree"), "cyclic").when(F.col("n_ends") < 2, "too_few_ends")
        .when(F.col("start").isNull() | F.col("stop").isNull(), "no_match").when(F.col("start") == F.col("stop"), "same_end")
        .otherwise("ok").alias("verdict"))


def tree_path(vox: DataFrame, ends: DataFrame, keys: list[str]) -> DataFrame:
    """Ordered nodes between two ends of a tree, ``ends`` holding start, stop.

    Cases that ``path_verdicts`` does not call ok (rings, several pieces, one
    end for both) have no path and no rows; they cannot hold up the others.
    Leaves other than the two ends are peeled until only the path is left;
    the distance from the start then comes from pointer doubling, so a path
    of n nodes takes log n rounds.
    """
    good = materialize(path_verdicts(vox, ends, keys).filter("verdict = 'ok'").select(*keys), "path-good")
    vox, ends = vox.join(good, keys, "left_semi"), ends.join(good, keys, "left_semi")
    hold = materialize(ends.select(*keys, F.explode(F.array("start", "stop")).alias("node")), "path-ends", grows=True)
    adj = materialize(adjacency(vox, keys), "path-adj", grows=True)
    while True:
        deg = adj.groupBy(*keys, F.col("src").alias("node")).agg(F.count(F.lit(1)).alias("n"))
        leaf = deg.filter("n = 1").join(hold, [*keys, "node"], "left_anti").select(*keys, "node")
        leaf = materialize(leaf, "path-leaf", grows=True)
        if leaf.isEmpty():
            break
        adj = adj.join(leaf.withColumnRenamed("node", "src"), [*keys, "src"], "left_anti").join(
            leaf.withColumnRenamed("node", "dst"), [*keys, "dst"], "left_anti").select(*keys, "src", "dst", "len")
        adj = materialize(adj, "path-adj", grows=True)
    return _rank_path(adj, ends, keys)


def _rank_path(adj: DataFrame, ends: DataFrame, keys: list[str]) -> DataFrame:
    """Steps and length from the start along a plain path.

    Arcs (a -> b) point on to the arc (b -> c) that does not turn back. Both
    directions are ranked; the one ending at the stop is kept.
    """
    arcs = adj.hint("merge").select(*keys, F.col("src").alias("a"), F.col("dst").alias("b"), "len")
    nxt = adj.select(*keys, F.col("src").alias("b"), F.col("dst").alias("c"))
    cur = arcs.join(nxt, [*keys, "b"], "left")
    # arcs that only can turn back are the last of their direction
    cur = cur.withColumn("c", F.when(F.col("c") != F.col("a"), F.col("c"))).groupBy(*keys, "a", "b", "len").agg(
        F.max("c").alias("c"))
    cur = materialize(
        cur.select(*keys, "a", "b", F.col("b").alias("na"), F.col("c").alias("nb"), F.lit(1).cast("long").alias("steps"),
                   F.col("len").alias("dist"), F.col("b").alias("tail")), "rank", grows=True)
    # Doubling settles a path of n arcs in log2 n rounds; more would be a ring.
    rounds = cur.count().bit_length() + 1
    while not cur.filter("nb is not null").isEmpty():
        rounds -= 1
        if rounds < 0:
            raise ValueError("a path to be ranked holds a ring")
        ahead = cur.select(*keys, F.col("a").alias("na"), F.col("b").alias("nb"), F.col("na").alias("na2"), F.col("nb").alias("nb2"),
                           F.col("steps").alias("s2"), F.col("dist").alias("d2"), F.col("tail").alias("t2"))
        cur = materialize(
            cur.join(ahead, [*keys, "na", "nb"], "left").select(
                *keys, "a", "b", F.coalesce("na2", "na").alias("na"), "nb2", 
                (F.col("steps") + F.coalesce("s2", F.lit(0))).alias("steps"),
                (F.col("dist") + F.coalesce("d2", F.lit(0.0))).alias("dist"), F.coalesce("t2", "tail").alias("tail"),
            ).withColumnRenamed("nb2", "nb"), "rank", grows=True)
    # distance to the stop is known for arcs heading there; order runs from the start
    to_stop = cur.join(ends, keys).filter("tail = stop").select(*keys, F.col("a").alias("node"), "steps", "dist")
    total = to_stop.join(ends, keys).filter("node = start").select(*keys, F.col("steps").alias("n"), F.col("dist").alias("l"))
    inner = to_stop.hint("merge").join(total, keys).select(
        *keys, "node", (F.col("n") - F.col("steps")).alias("seq"), (F.col("l") - F.col("dist")).alias("along"))
    last = total.join(ends, keys).select(*keys, F.col("stop").alias("node"), F.col("n").alias("seq"), F.col("l").alias("along"))
    return inner.unionByName(last)


def prune_spurs(vox: DataFrame, keys: list[str], pitch: float, limit: float) -> tuple[DataFrame, DataFrame]:
    """Drop the shortest terminal branch of every branched case until none is left.

    Returns the voxels kept and one verdict per case: ok, disconnected,
    no_removable_branch, too_long, ambiguous, or wrong_ends when what is left
    is not a path with two ends (a ring). Branches of all cases are measured
    together: after the branch points are taken out, each is a component.
    """
    live = materialize(with_node(vox).select(*keys, "z", "y", "x", "node"), "spur-live", grows=True)
    pieces = tree_report(live.select(*keys, "z", "y", "x"), keys)
    verdicts = materialize(pieces.filter("n_components > 1").select(*keys, F.lit("disconnected").alias("verdict")), "spur-pieces")
    pruned = None
    active = live.select(*keys).distinct().join(verdicts, keys, "left_anti")
    while True:
        part = live.join(active, keys, "left_semi")
        adj = materialize(adjacency(part, keys), "spur-adj", grows=True)
        deg = materialize(degrees(part.drop("node"), adj, keys).select(*keys, "node", "degree"), "spur-deg", grows=True)
        branched = materialize(deg.filter("degree > 2").select(*keys).distinct(), "spur-branched")
        if branched.isEmpty():
            break
        joints = deg.filter("degree > 2").select(*keys, "node")
        free = deg.filter("degree <= 2").join(branched, keys, "left_semi").select(*keys, "node", "degree")
        inner = adj.join(joints.withColumnRenamed("node", "src"), [*keys, "src"], "left_anti").join(
            joints.withColumnRenamed("node", "dst"), [*keys, "dst"], "left_anti")
        cc = connected_components(free, inner, keys)
        size = inner.join(cc.withColumnRenamed("node", "src"), [*keys, "src"]).groupBy(*keys, "comp").agg(
            (F.sum("len") / 2).alias("inner_len"))
        touch = adj.join(joints.withColumnRenamed("node", "dst"), [*keys, "dst"]).join(
            cc.withColumnRenamed("node", "src"), [*keys, "src"]).groupBy(*keys, "comp").agg(
            F.count(F.lit(1)).alias("n_joints"), F.min("len").alias("joint_len"))
        ends = free.filter("degree = 1").join(cc, [*keys, "node"]).groupBy(*keys, "comp").agg(F.count(F.lit(1)).alias("n_ends"))
        branch = touch.join(ends, [*keys, "comp"]).join(size, [*keys, "comp"], "left").filter("n_joints = 1 and n_ends = 1")
        branch = materialize(branch.select(
            *keys, "comp", ((F.coalesce("inner_len", F.lit(0.0)) + F.col("joint_len")) * pitch).alias("length")), "spur-branch", grows=True)
        best = branch.groupBy(*keys).agg(F.min(F.struct("length", "comp")).alias("b"))
        others = branch.join(best, keys).filter(F.col("comp") != F.col("b.comp")).groupBy(*keys).agg(F.min("length").alias("second"))
        call = branched.join(best, keys, "left").join(others, keys, "left").select(
            *keys, F.col("b.comp").alias("comp"), F.col("b.length").alias("length"),
            F.when(F.col("b").isNull(), "no_removable_branch").when(F.col("b.length") > limit + 1e-9, "too_long")
            .when(F.abs(F.col("second") - F.col("b.length")) <= 1e-9, "ambiguous").otherwise("cut").alias("verdict"))
        call = materialize(call, "spur-call")
        failed = call.filter("verdict <> 'cut'").select(*keys, "verdict")
        verdicts = verdicts.unionByName(failed)
        cut = call.filter("verdict = 'cut'").select(*keys, "comp", "length")
        pruned = cut if pruned is None else pruned.unionByName(cut)
        active = materialize(cut.select(*keys), "spur-active")
        if active.isEmpty():
            break
        gone = cc.join(cut, [*keys, "comp"]).select(*keys, "node")
        live = materialize(live.join(gone, [*keys, "node"], "left_anti"), "spur-live", grows=True)
    cases = live.select(*keys).distinct()
    ends = tree_report(live.select(*keys, "z", "y", "x"), keys).filter("n_ends <> 2").select(*keys, F.lit("wrong_ends").alias("last"))
    out = cases.join(verdicts, keys, "left").join(ends, keys, "left").withColumn("verdict", F.coalesce("verdict", "last", F.lit("ok")))
    if pruned is None:
        return live, out.select(*keys, "verdict", F.lit(0).cast("long").alias("n_pruned"), F.lit(0.0).alias("pruned_mm"))
    cuts = pruned.groupBy(*keys).agg(F.count(F.lit(1)).alias("n_pruned"), F.sum("length").alias("pruned_mm"))
    out = out.join(cuts, keys, "left").select(
        *keys, "verdict", F.coalesce("n_pruned", F.lit(0)).alias("n_pruned"), F.coalesce("pruned_mm", F.lit(0.0)).alias("pruned_mm"))
    return live, out
