"""Readers, writers, digests, resume, streaming and planner checks."""

import gzip
import hashlib
import json
import struct

import numpy as np
import pytest
from pyspark.sql import functions as F

from planeforge import contract as K
from planeforge.functions.digest import multiset_digest
from planeforge.functions.ranking import dense_index, nth_row
from planeforge.operators import audit as A, manifest as MF
from planeforge.plans import registry
from planeforge.sinks import manifest as SM, ply as PLY
from planeforge.sources import bridges as B, documents as DOC, files as FI
from planeforge.streaming.ingest import ingest_counts, resume_run, watermarked_counts

SF = "/root/testdata/sf0.001"


def test_digest_equals_big_integer_arithmetic(spark):
    words = [f"row-{i % 700}" for i in range(2000)]
    r = multiset_digest(spark.createDataFrame([(w,) for w in words], "t string").repartition(7), [], F.col("t")).first()
    ints = [int(hashlib.sha256(w.encode()).hexdigest(), 16) for w in words]
    x = 0
    for v in ints:
        x ^= v
    assert r["n"] == 2000 and r["sha256_sum"] == f"{sum(ints) % (1 << 256):064x}" and r["sha256_xor"] == f"{x:064x}"


def test_dense_index_and_nth_row(spark):
    df = spark.range(1000).select((F.col("id") % 3 == 0).cast("int").alias("g"), (F.lit(5000) - F.col("id") * 2).alias("o"))
    got = dense_index(df, ["g"], ["o"], "i").collect()
    for g in (0, 1):
        want = sorted(r["o"] for r in got if r["g"] == g)
        assert [r["o"] for r in sorted((r for r in got if r["g"] == g), key=lambda r: r["i"])] == want
        assert sorted(r["i"] for r in got if r["g"] == g) == list(range(len(want)))
    k = spark.createDataFrame([(0, 17), (1, 200)], "g int, k long")
    n = {r["g"]: r["o"] for r in nth_row(df, ["g"], ["o"], k).collect()}
    assert n == {g: sorted(r["o"] for r in got if r["g"] == g)[i] for g, i in ((0, 17), (1, 200))}


def test_strict_lines_keep_their_numbers_when_files_are_split(spark, tmp_path):
    f = tmp_path / "m.jsonl"
    lines = [json.dumps({"slice_id": f"s{i}", "pad": "x" * (i % 50)}) for i in range(3000)]
    for i, bad in ((10, ""), (1500, "[1]"), (2999, "{")):
        lines[i] = bad
    f.write_text("\n".join(lines) + "\n")
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "20000")
    try:
        rows, bad = DOC.read_jsonl(spark, str(tmp_path), "slice_id string", skip_blank=False)
        assert {r["line_number"]: r["verdict"] for r in bad.collect()} == {11: "blank", 1501: "not_object", 3000: "not_json"}
        assert all(r["slice_id"] == f"s{r['line_number'] - 1}" for r in rows.collect())
        assert DOC.read_jsonl(spark, str(tmp_path), "slice_id string", skip_blank=True)[1].count() == 2
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)


def test_mesh_files(spark, tmp_path):
    (tmp_path / "a.obj").write_text("v 0 0 0\nv 1 0 0\nv 1 1 0\nv 0 1 0\nf 1/1 2/2 3/3 4/4\n")
    tri = struct.pack("<12fH", *([0.0] * 3), 0, 0, 0, 1, 0, 0, 0, 1, 0, 0)
    (tmp_path / "b.stl").write_bytes(b"x" * 80 + struct.pack("<I", 1) + tri)
    (tmp_path / "c.ply").write_text("ply\nformat ascii 1.0\nelement vertex 3\nproperty float y\nproperty float x\nproperty float z\nelement face 1\n"
                                    "property list uchar int vertex_indices\nend_header\n1 0 0\n0 2 0\n0 0 3\n3 0 1 2\n")
    (tmp_path / "d.obj").write_text("v 0 0 0\n")
    (tmp_path / "e.txt").write_text("v 0 0 0\n")
    p = FI.parse_meshes(FI.scan(spark, str(tmp_path)))
    r = {x["path"][-5:]: x for x in p.collect()}
    assert (len(r["a.obj"]["vertices"]), len(r["a.obj"]["faces"])) == (4, 2) and len(r["b.stl"]["vertices"]) == 3
    assert r["c.ply"]["vertices"][0] == [0.0, 1.0, 0.0] and r["d.obj"]["error"] == "no faces" and "suffix" in r["e.txt"]["error"]
    assert FI.mesh_vertex_rows(p).count() == 10 and FI.mesh_face_rows(p).count() == 4


def test_volume_files(spark, tmp_path):
    arr = np.arange(60, dtype="<i2").reshape(3, 4, 5)
    head = ("NRRD0004\n# comment\ntype: short\ndimension: 3\nspace: left-posterior-superior\nsizes: 5 4 3\nspace directions: (0,1.5,0) (-2,0,0) (0,0,2.5)\n"
            "encoding: gzip\nendian: little\nspace origin: (10,20,30)\n\n")
    (tmp_path / "a.nrrd").write_bytes(head.encode() + gzip.compress(arr.tobytes()))
    h = bytearray(352)
    struct.pack_into("<i", h, 0, 348)
    struct.pack_into("<8h", h, 40, 3, 5, 4, 3, 1, 1, 1, 1)
    struct.pack_into("<h", h, 70, 4)
    struct.pack_into("<8f", h, 76, 1, 1.5, 2, 2.5, 1, 1, 1, 1)
    struct.pack_into("<f", h, 108, 352.0)
    (tmp_path / "1.2.840_V_402.nii.gz").write_bytes(gzip.compress(bytes(h) + (arr + 300).tobytes()))
    s = FI.parse_volumes(FI.scan(spark, str(tmp_path)))
    a = s.filter("path like '%nrrd'").orderBy("z").collect()
    assert len(a) == 3 and a[0]["spacing"] == [1.5, 2.0, 2.5] and a[0]["origin"] == [10, 20, 30] and a[0]["direction"][1] == -1.0 and a[0]["system"] == "LPS"
    v = FI.volume_rows(s, "v").filter("path like '%nii.gz' and z = 2 and y = 3 and x = 4").first()["v"]
    assert v == 359.0
    e = FI.parse_volumes(FI.scan(spark, str(tmp_path)), labels=True).filter("error is not null").collect()
    assert len(e) == 1 and e[0]["error"] == "label outside 0-255"


def test_point_files_written_and_read(spark, tmp_path):
    p = spark.createDataFrame([(0, "liver", i, i * 1.5, -0.0, 2.0, 0.0, 0.0, 1.0) for i in range(7)],
                              "case_id int, organ string, point_index int, x double, y double, z double, nx double, ny double, nz double")
    PLY.write_lines(PLY.point_file(p, ["organ"]), ["organ"], str(tmp_path / "o"), ["ord"])
    text = "\n".join(open(f).read().rstrip("\n") for f in sorted((tmp_path / "o" / "organ=liver").glob("part-*")))
    assert text.splitlines()[:3] == ["ply", "format ascii 1.0", "element vertex 7"] and text.splitlines()[10] == "0.000000 0.000000 2.000000 0.000000 0.000000 1.000000"
    (tmp_path / "r").mkdir()
    (tmp_path / "r" / "liver.ply").write_text(text + "\n")
    (tmp_path / "r" / "short.ply").write_text("\n".join(text.splitlines()[:-1]))
    r = FI.parse_points(FI.scan(spark, str(tmp_path / "r")))
    assert r.filter("error is null").count() == 7 and "fewer" in r.filter("error is not null").first()["error"]
    assert r.filter("point_index = 6").first()["x"] == 9.0


def test_registry_reads_json_and_yaml(spark, tmp_path):
    pytest.importorskip("yaml")
    (tmp_path / "a.json").write_text(json.dumps({"case_id": "a", "ct_path": "../ct.nrrd", "output_root": "/out", "ct": {"output_resolution": 64}}))
    (tmp_path / "b.yaml").write_text("case_id: b\nct_path: /x/ct.nii\noutput_root: out\nsampling:\n  point_counts: {stomach: 5}\n")
    r = {x["case_id"]: x for x in DOC.parse_registry(FI.scan(spark, str(tmp_path))).collect()}
    assert r["a"]["output_resolution"] == 64 and r["a"]["ct_path"].endswith("/../ct.nrrd") and r["a"]["point_counts"]["stomach"] == 1000
    assert r["b"]["ct_path"] == "/x/ct.nii" and r["b"]["point_counts"]["stomach"] == 5 and r["b"]["minimum_spacing_mm"] == K.SPACING_MM


def test_catalogue_is_pinned(spark):
    c = {r["organ_label"]: r for r in DOC.catalog(spark).collect()}
    assert {n: tuple(r["eus_label_ids"]) for n, r in c.items()} == K.CATALOG_IDS and c["portal_vein"]["canonical_vessel_label_id"] == 26
    assert all(len(r["eus_label_ids"]) == len(r["eus_label_names"]) for r in c.values())
    with pytest.raises(Exception, match="differs from the approved"):
        DOC.catalog(spark, sha256="0" * 64).collect()


def test_series_selection(spark):
    f = spark.createDataFrame([("a", "u1"), ("a", "u2"), ("b", "u1"), ("b", "u1")], "folder string, series_uid string")
    w = spark.createDataFrame([("a", None), ("a2", None), ("b", None)], "folder string, uid string")
    r = {x["folder"]: (x["verdict"], x["n_files"]) for x in DOC.select_series(f, w).collect()}
    assert r == {"a": ("several_series", None), "a2": ("no_series", None), "b": ("ok", 2)}


def test_safe_paths(spark):
    rows = [("a/b.png", True), ("a/../b.png", True), ("../b.png", False), ("a/../../b", False), ("/a", False), ("", False), (None, False)]
    d = spark.createDataFrame(rows, "p string, want boolean").select("want", MF.safe_path(F.col("p")).alias("got"))
    assert all(r["want"] == r["got"] for r in d.collect())


def test_append_is_idempotent(spark, tmp_path):
    m = B.manifest(spark, SF)
    for part in (m.filter("record_id < 900"), m, m):
        SM.append_manifest(part, str(tmp_path / "m"), order=[F.col("record_id")])
    got = SM.read_manifest(spark, str(tmp_path / "m"), m.schema)
    assert got.count() == m.select("case_id", "slice_id").distinct().count()
    plan = got.filter("status = 'gallery' and case_id = 1")._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(" in plan


def test_tampering_is_found_once(spark):
    root = spark.createDataFrame([(0, "a", "gallery", "1"), (0, "b", "gallery", "2"), (0, "c", "rejected", "3")], "case_id int, slice_id string, status string, digest string")
    key = ["case_id", "slice_id"]

    def kinds(state):
        return sorted(r["kind"] for r in MF.reconcile(root, state, key).collect() if r["kind"] != "ok")

    assert kinds(root) == []
    assert kinds(root.filter("slice_id <> 'a'")) == ["missing_in_state"]
    assert kinds(root.withColumn("digest", F.when(F.col("slice_id") == "b", "x").otherwise(F.col("digest")))) == ["other_content"]
    assert kinds(root.unionByName(root.filter("slice_id = 'c'"))) == ["repeated_id"]
    assert kinds(root.unionByName(root.filter("slice_id = 'c'").withColumn("slice_id", F.lit("z")))) == ["orphan_in_state"]


def test_protocol_hash_needs_every_field(spark):
    doc = {f: f'"{i}"' for i, f in enumerate(K.PROTOCOL_FIELDS)}
    d = spark.createDataFrame([(0, doc), (1, {k: v for k, v in doc.items() if k != "fov_policy"})], "case_id int, doc map<string,string>")
    r = MF.protocol_hash(d, "doc").orderBy("case_id").collect()
    text = "{" + ",".join(f'"{k}":{doc[k]}' for k in sorted(doc)) + "}"
    assert r[0]["protocol_sha256"] == hashlib.sha256(text.encode()).hexdigest()
    assert r[1]["protocol_sha256"] is None and r[1]["missing_fields"] == ["fov_policy"]


def test_nan_and_boolean_never_pass_as_numbers(spark):
    v = spark.createDataFrame([('{"a": true}',), ('{"a": 1.5}',), ("[]",), (" ",), ("{",)], "t string")
    assert [r["x"] for r in v.select(DOC.line_verdict(F.col("t")).alias("x")).collect()] == ["ok", "ok", "not_object", "blank", "not_json"]
    f = spark.createDataFrame([("artery", float("nan"), 1.0, 1.0), ("artery", 1.0, 1.0, float("inf")), ("artery", 1.0, 1.0, 0.0), ("artery", 1.0, 1.0, 2.0)],
                              "label string, x_mm double, y_mm double, area_mm2 double").select(F.struct("*").alias("f"))
    assert [r["b"] for r in f.select(MF.feature_bad(F.col("f"), ("artery", "vein")).alias("b")).collect()] == [True, True, True, False]


def test_report_passes_only_clean_cases(spark):
    cases = spark.createDataFrame([(0,), (1,)], "case_id long")
    f = A.as_finding(spark.createDataFrame([(1, "x")], "case_id int, kind string"), "c")
    r = {x["case_id"]: x for x in A.report(cases, [f]).collect()}
    assert r[0]["passed"] and not r[1]["passed"] and r[1]["faults"] == "c/x=1"


def test_stream_ignores_repeats_across_restarts(spark, tmp_path):
    schema = B.status_events(spark, SF).schema
    src, root = str(tmp_path / "in"), str(tmp_path / "st")
    e = B.status_events(spark, SF).filter("event_id % 10 not in (0, 9)")
    e.filter("event_id % 2 = 0").write.json(src)
    n1 = sum(r["n"] for r in ingest_counts(spark, src, schema, root).collect())
    e.write.mode("append").json(src)
    n2 = sum(r["n"] for r in ingest_counts(spark, src, schema, root).collect())
    assert n1 == e.filter("event_id % 2 = 0").select("slice_id").distinct().count() and n2 == e.select("slice_id").distinct().count()


def test_resume_processes_each_plan_row_once(spark, tmp_path):
    schema = B.status_events(spark, SF).schema
    e = B.status_events(spark, SF)
    e.filter("event_id < 300").write.json(str(tmp_path / "plan"))
    args = (spark, str(tmp_path / "plan"), schema, str(tmp_path / "man"), str(tmp_path / "cp"))
    resume_run(*args)
    e.filter("event_id >= 200").write.mode("append").json(str(tmp_path / "plan"))
    resume_run(*args)
    resume_run(*args)
    m = spark.read.parquet(str(tmp_path / "man"))
    assert m.count() == e.select("slice_id").distinct().count() == m.select("slice_id").distinct().count()


def test_watermarked_counts_plan(spark, tmp_path):
    schema = B.status_events(spark, SF).schema
    B.status_events(spark, SF).write.json(str(tmp_path / "in"))
    s = watermarked_counts(spark.readStream.schema(schema).json(str(tmp_path / "in")), "10 minutes", "1 hour")
    q = s.writeStream.format("memory").queryName("wm").outputMode("append").trigger(availableNow=True).start()
    q.awaitTermination()
    assert spark.table("wm").count() > 0


# --- plans ------------------------------------------------------------------------------
def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_every_query_has_a_name_and_reads_tables():
    assert len(registry.QUERIES) >= 170 and len(registry.ORACLES) >= 168
    assert not [n for n in registry.ORACLES if n not in registry.QUERIES]


def test_scans_are_narrow(spark):
    p = plan_of(registry.QUERIES["agg07_status_counts"](spark, SF))
    assert "o_totalprice" not in p and "o_orderpriority" in p
    p = plan_of(registry.QUERIES["agg10_signed_volume"](spark, SF))
    assert "s_name" not in p and "BroadcastNestedLoop" not in p


def test_expansion_broadcasts_only_the_angle_grid(spark):
    p = plan_of(registry.QUERIES["jn02_pose_expansion"](spark, SF))
    assert p.count("BroadcastHashJoin") == 1 and "CartesianProduct" not in p


@pytest.mark.parametrize("name", ["jn01_ray_targets", "agg04_multiset_digest", "win06_surface_crossings", "set02_merge_close"])
def test_results_do_not_depend_on_partitions(spark, name):
    before = spark.conf.get("spark.sql.shuffle.partitions")
    out = []
    try:
        for n in ("1", "23"):
            spark.conf.set("spark.sql.shuffle.partitions", n)
            out.append(sorted(map(str, registry.QUERIES[name](spark, SF).collect())))
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)
    assert out[0] == out[1] and out[0]
