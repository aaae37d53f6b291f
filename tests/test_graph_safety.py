"""Skeletons that are no trees must not hold up or spoil the good ones beside them."""

from planeforge.operators import graph as G
from planeforge.streaming.ingest import resume_run

KEYS = ["case_id"]
RING = [(0, 0), (0, 1), (0, 2), (1, 3), (2, 2), (2, 1), (2, 0), (1, -1)]


def voxels(spark):
    def at(case, points, z=5, shift=10):
        return [(case, z, y + shift, x + shift) for y, x in points]

    line = [(0, i) for i in range(5)]
    rows = at(0, line)  # good
    rows += at(1, RING)  # a ring
    rows += at(2, RING) + at(2, line, z=40)  # a ring and a path
    rows += at(3, line) + at(3, line, z=40)  # two pieces
    rows += at(4, line)  # one end for both hints
    rows += at(5, [*RING, (0, -3), (1, -2), (0, 5), (1, 4)])  # two tails on a ring
    rows += at(6, [(0, 0)])  # a single voxel
    return spark.createDataFrame(rows, "case_id int, z int, y int, x int")


def ends(spark, vox):
    node = {(r.case_id, r.z, r.y, r.x): r.node for r in G.with_node(vox).collect()}
    first, last = {}, {}
    for (case, *_), n in sorted(node.items()):
        first.setdefault(case, n)
        last[case] = n
    last[4] = first[4]
    return spark.createDataFrame([(c, first[c], last[c]) for c in first], "case_id int, start long, stop long")


def test_verdicts_and_the_good_path(spark):
    vox = voxels(spark)
    e = ends(spark, vox)
    verdicts = {r.case_id: r.verdict for r in G.path_verdicts(vox, e, KEYS).collect()}
    assert verdicts == {0: "ok", 1: "cyclic", 2: "disconnected", 3: "disconnected", 4: "same_end", 5: "cyclic", 6: "too_few_ends"}
    path = sorted((r.case_id, r.seq, r.along) for r in G.tree_path(vox, e, KEYS).collect())
    assert path == [(0, i, float(i)) for i in range(5)]


def test_spur_pruning_verdicts(spark):
    _, verdicts = G.prune_spurs(voxels(spark), KEYS, 1.0, 5.0)
    got = {r.case_id: r.verdict for r in verdicts.collect()}
    assert got[0] == got[4] == "ok"
    assert got[1] == got[6] == "wrong_ends"
    assert got[2] == got[3] == "disconnected"
    assert got[5] != "ok"


def test_a_new_checkpoint_replaces_nothing(spark, tmp_path):
    schema = "slice_id string, status string"
    rows = spark.createDataFrame([("a", "gallery"), ("b", "gallery")], schema)
    rows.write.json(f"{tmp_path}/one")
    resume_run(spark, f"{tmp_path}/one", rows.schema, f"{tmp_path}/m", f"{tmp_path}/c1")
    more = spark.createDataFrame([("b", "rejected"), ("c", "rejected")], schema)
    more.write.json(f"{tmp_path}/two")
    resume_run(spark, f"{tmp_path}/two", more.schema, f"{tmp_path}/m", f"{tmp_path}/c2")
    got = sorted((r.slice_id, r.status) for r in spark.read.parquet(f"{tmp_path}/m").collect())
    assert got == [("a", "gallery"), ("b", "gallery"), ("c", "rejected")]
