"""Occurrence operators: hand-written edge cases, published figures, and queries against their SQL."""

import os
from datetime import date

import duckdb
import pytest
from pyspark.sql import functions as F

from fieldspark import queries
from fieldspark.functions import scalars as S
from fieldspark.functions.projection import project_laea, unproject_laea
from fieldspark.operators import cover, grid, merge, normalise, policy, qc, report
from fieldspark.plans import stages
from fieldspark.sources import files, snapshots
from fieldspark.streaming import streams

SF = "/root/testdata/sf0.001"


def one(spark, column):
    return spark.range(1).select(column.alias("x")).first()["x"]


def test_scalars(spark):
    text = lambda f, x: one(spark, f(F.lit(x).cast("string")))
    assert text(S.slugify, "Gamma (x) rubra") == "gamma_x_rubra"
    assert [text(S.safe_double, x) for x in ("1.5", "NaN", "abc", None, "")] == [1.5, None, None, None, None]
    assert [text(S.safe_int, x) for x in ("2020.0", "x", "-1.9")] == [2020, None, -1]
    assert text(S.parse_day, "seen 2020-02-29T10:00") == date(2020, 2, 29)
    assert [text(S.parse_day, x) for x in ("2020-13-45", "2020-01-01/2020-02-01", "2020", "", None)] == [None] * 5
    assert [text(S.parse_boolish, x) for x in (" Yes", "F", "maybe", None)] == [True, False, None, None]
    assert one(spark, S.cell_id(F.lit(3), F.lit(4))) == "r00003_c00004"
    assert one(spark, S.has_token(F.lit("A; ZERO "), ["ZERO"])) and not one(spark, S.has_token(F.lit("NOT_ZERO"), ["ZERO"]))


def test_projection(spark):
    x, y = project_laea(F.lit(5.0), F.lit(50.0))
    assert one(spark, x) == pytest.approx(3962799.45, abs=0.01) and one(spark, y) == pytest.approx(2999718.85, abs=0.01)
    lon, lat = unproject_laea(x, y)
    assert one(spark, lon) == pytest.approx(5, abs=1e-8) and one(spark, lat) == pytest.approx(50, abs=1e-8)
    assert grid.extent_of(grid.box_corners(spark)) == queries.EXTENT
    assert grid.corners_of(spark.createDataFrame([], "lon double, lat double")).collect() == []
    got = sorted(map(tuple, grid.corners_of(spark.createDataFrame([(1.5, 2.5), (-3.0, 7.2)], "lon double, lat double")).collect()))
    assert got == [(-3.0, 2.0), (-3.0, 8.0), (2.0, 2.0), (2.0, 8.0)]


def test_first_rows_and_null_ids(spark):
    rows = [("a", "GBIF", None, 1.0, 1.0, "d", 0), ("a", "GBIF", None, 2.0, 2.0, "d", 1), ("a", "GBIF", "g", 1.0, 1.0, "d", 2), ("a", "GBIF", "h", 3.0, 3.0, None, 3), ("a", "GBIF", "i", 3.0, 3.0, None, 4)]
    df = spark.createDataFrame(rows, "species_slug string, source string, source_record_id string, lon double, lat double, date_raw string, k int")
    assert sorted(r["k"] for r in normalise.dedup_by_id(df, [F.col("k")]).collect()) == [0, 2, 3, 4]
    assert sorted(r["k"] for r in normalise.dedup_within_source(df, [F.col("k")]).collect()) == [0, 3]


def test_strict_pairs(spark):
    day = date(2020, 1, 1)
    rows = [("s", "GBIF", 1, 1, day, "a"), ("s", "NBN", 1, 1, day, "b"), ("s", "GBIF", 2, 2, day, "c"), ("s", "NBN", 2, 2, day, "d"), ("s", "NBN", 2, 2, day, "e"), ("s", "GBIF", 3, 3, None, "f"), ("s", "NBN", 3, 3, None, "g")]
    df = spark.createDataFrame(rows, "species_slug string, source string, lon_k long, lat_k long, event_day date, occ_uid string")
    uids = lambda out: sorted(r["occ_uid"] for r in out.collect())
    assert uids(merge.dedup_cross_source(df)) == list("acdefg")
    assert uids(merge.dedup_cross_source(df, "NBN")) == list("bcdefg")
    assert uids(merge.crossdup_review(df)) == list("cde")
    # a dropped uid takes every row of its species along, also one without a day
    more = [("s", "NBN", 9, 9, day, "b"), ("s", "NBN", None, None, None, "b"), ("t", "NBN", 9, 9, day, "b")]
    wide = spark.createDataFrame([*rows, *more], df.schema)
    assert uids(merge.dedup_cross_source(wide)) == list("abcdefg") and sum(r["strict_drop"] for r in merge.flag_strict(wide).collect()) == 3


def test_row_numbers_by_bucket(spark):
    df = spark.createDataFrame([("a" if i % 3 else None, i) for i in range(50)], "s string, k int").repartition(5)
    for bucket in (F.lit(0), F.floor(F.col("k") / 7), F.col("k")):
        got = {r["k"]: r["_n"] for r in merge.row_numbers(df, ["s"], [F.col("k")], bucket).collect()}
        assert got == {i: i // 3 + 1 if i % 3 == 0 else i - i // 3 for i in range(50)}


def test_polygon_bands(spark):
    ring = [(0.0, 0.0), (10.0, 0.5), (9.0, 9.7), (0.5, 10.0)]
    edges = spark.createDataFrame([(1, *ring[i], *ring[(i + 1) % 4]) for i in range(4)] + [(2, 20.0, 0.0, 30.0, 0.0)], "poly_id int, x1 double, y1 double, x2 double, y2 double")
    points = [(0, 5.0, 5.0), (1, -1.0, 5.0), (2, 9.9, 9.0), (3, 5.0, 9.9), (4, 5.0, -3.0), (5, None, 5.0), (6, 5.0, float("nan")), (7, 0.3, 1.0), (8, 25.0, 0.0)]
    df = spark.createDataFrame(points, "id int, lon double, lat double")
    for band in (0.25, 1.0, 90.0):
        assert sorted(r["id"] for r in grid.inside_polygon(df, edges, "id", band=band).collect()) == [0, 7]
    sea = {r["id"]: r["in_sea"] for r in grid.flag_in_sea(df, edges, "id").collect()}
    assert sea[0] is False and sea[1] is True and sea[5] is None


def test_plans(spark):
    plan = lambda name: queries.QUERIES[name](spark, SF)._jdf.queryExecution().optimizedPlan().toString()
    assert plan("cell_counts").count("Relation [") == 1
    physical = queries.QUERIES["point_in_polygon"](spark, SF)._jdf.queryExecution().executedPlan().toString()
    assert "NestedLoop" not in physical and "CartesianProduct" not in physical
    dedup = queries.QUERIES["dedup_by_id"](spark, SF)._jdf.queryExecution().executedPlan().toString()
    assert dedup.count("WindowGroupLimit") == 2  # one of them before the shuffle


def test_missing_and_empty(spark, tmp_path):
    assert files.scan_csv_all_string(spark, f"{tmp_path}/none.csv").collect() == []
    assert files.list_files(spark, f"{tmp_path}/none").collect() == []
    empty = normalise.normalise(files.empty_typed(spark, "species string, decimalLongitude string"), "GBIF")
    assert stages.merge_stage(empty.withColumns({"k": F.lit(1), "copy_no": F.lit(0)}))[1].collect() == []
    assert stages.normalise_landed(spark, f"{tmp_path}/none").collect() == []
    with pytest.raises(FileNotFoundError):
        files.scan_any_table(spark, f"{tmp_path}/none")
    with pytest.raises(ValueError, match="presence"):
        grid.centroids_of_table(spark.range(3))
    assert files.ingest_pages([spark.range(5).toDF("id"), spark.range(5).withColumn("x", F.lit(1))], 7).count() == 7


def test_refresh_by_file_times(spark, tmp_path):
    for s, when in (("a", 100), ("b", 300), ("c", 100)):
        for root in ("in", "out"):
            if (s, root) != ("c", "out"):
                spark.range(1).withColumn("species_slug", F.lit(s)).write.mode("append").partitionBy("species_slug").parquet(f"{tmp_path}/{root}")
                for f in (tmp_path / root / f"species_slug={s}").iterdir():
                    os.utime(f, (when if root == "in" else 200,) * 2)
    i, o = (files.modified_by_species(spark, f"file://{tmp_path}/{x}") for x in ("in", "out"))
    slugs = lambda **how: sorted(r["slug"] for r in files.needs_refresh(i, o, **how).collect())
    assert slugs() == ["b", "c"] and slugs(refresh_if_newer=False) == ["c"] and slugs(overwrite=True) == ["a", "b", "c"]


def test_a_failed_merge_is_logged(spark, tmp_path):
    clean, inputs = queries._clean(spark, SF), spark.createDataFrame([("alpha_minor", date(2020, 1, 1))], "slug string, modified date").withColumn("modified", F.col("modified").cast("timestamp"))
    broken = clean.withColumn("lon", F.expr("raise_error('bad file')").cast("double"))
    with pytest.raises(Exception, match="bad file"):
        stages.merge_into(broken, inputs, f"{tmp_path}/out")
    log = stages.merge_into(broken, inputs, f"{tmp_path}/out", continue_on_error=True).collect()
    assert [(r["slug"], r["status"]) for r in log] == [("alpha_minor", "error")] and "bad file" in log[0]["note"]


def test_a_merge_moves_other_columns_once(spark, monkeypatch):
    clean, stored, kept, limit = files.kept(queries._clean(spark, SF), "clean"), [], files.kept, "spark.sql.codegen.hugeMethodLimit"
    before = spark.conf.get(limit)
    monkeypatch.setattr(files, "kept", lambda df, name: stored.append(df.columns) or kept(df, name))
    merged, _ = stages.merge_stage(clean)
    assert stored and not any("issues" in columns for columns in stored) and spark.conf.get(limit) == before
    pre = merge.add_basics(normalise.dedup_within_source(normalise.screen_coords(clean), stages.order()), stages.order())
    want = merge.dedup_cross_source(pre)
    assert sorted(merged.columns) == sorted(pre.columns) and merged.where("source_record_id is null").count() > 0
    rows = lambda df: sorted(map(str, df.select(*pre.columns).collect()))
    assert rows(merged) == rows(want)


def test_isolated_merges_read_stored_records(spark, monkeypatch):
    seen, run = [], stages.merge_into
    monkeypatch.setattr(stages, "merge_into", lambda clean, *a, **k: seen.append(clean.inputFiles()) or run(clean, *a, **k))
    assert queries.QUERIES["merge_into_isolated"](spark, SF).where("status = 'error'").count() == 1
    assert len(seen) == 1 and seen[0] and not any("orders.parquet" in f for f in seen[0])


def test_policy_credits_first_rule(spark):
    flagged = queries._flagged(spark, SF)
    judged = policy.with_drop_reason(flagged, policy.BASELINE, F.lit(queries.AS_OF))
    log = policy.runlog_filtered(judged, tuple(policy.BASELINE.extra)).collect()
    for r in log:
        assert r["n_in"] == r["n_out"] + sum(r[c] for c in r.asDict() if c.startswith("dropped_"))
    assert flagged.where(" or ".join(f"qc_flag_{k} is null" for k in qc.FLAGS)).count() == 0


def test_files(spark, tmp_path):
    df = spark.createDataFrame([("a", 1), ("b", 2)], "species_slug string, n int")
    files.sink_stage(df, f"{tmp_path}/s")
    files.sink_stage(df.where("n = 2").withColumn("n", F.lit(5)), f"{tmp_path}/s")
    assert sorted((r["species_slug"], r["n"]) for r in files.scan_stage(spark, f"{tmp_path}/s").collect()) == [("a", 1), ("b", 5)]
    files.sink_csv(spark.createDataFrame([("1", "x"), ("NA", "y")], "n string, t string"), f"{tmp_path}/c")
    assert sorted(str(r["n"]) for r in files.scan_delimited_typed(spark, f"{tmp_path}/c", {"n": "int", "gone": "int"}, ",").collect()) == ["1", "None"]
    paths = spark.createDataFrame([("/raw/g1/gbif/a_b_clean.csv",), ("/raw/gbif/a_b_clean.csv",), ("/raw/nbn_c_clean.csv",)], "path string")
    assert sorted(map(tuple, files.resolve_layout(paths).collect())) == [("GBIF", "a_b", "/raw/g1/gbif/a_b_clean.csv"), ("NBN", "c", "/raw/nbn_c_clean.csv")]
    i, o = spark.createDataFrame([("a", 5), ("b", 1), ("c", 1)], "slug string, modified int"), spark.createDataFrame([("a", 4), ("b", 2)], "slug string, modified int")
    assert sorted(r["slug"] for r in files.needs_refresh(i, o).collect()) == ["a", "c"]


@pytest.mark.parametrize("name", ["normalise_nbn", "dedup_cross_source", "crossdup_review", "qc_flags", "policy_date_window", "runlog_filtered", "cell_counts", "sink_stage", "scan_csv_all_string", "scan_runlog", "resolve_layout", "parse_utc", "stream_dedup", "stream_qc", "stream_grid_counts", "runlog_merged", "merge_into", "normalise_landed", "schema_contract", "snapped_extent", "land_mask", "scan_any_table", "sink_runlog", "policy_report", "profile_report", "crossdup_report", "add_basics_other_names", "screening_funnel", "densified_extent", "assign_cell_densified", "scan_delimited_by_extension", "scan_runlog_ragged"])
def test_query_equals_sql(spark, name):
    con = duckdb.connect()
    con.sql(f"create view orders as select * from read_parquet('{SF}/orders.parquet')")
    want = con.sql(queries.ORACLE[name])
    got = queries.QUERIES[name](spark, SF)
    cols = sorted(want.columns)
    assert sorted(got.columns) == cols
    rows = lambda data, names: sorted(str([r[names.index(c)] for c in cols]) for r in data)
    assert rows(map(tuple, got.collect()), got.columns) == rows(want.fetchall(), want.columns)


# --- polygon covers --------------------------------------------------------------------------------------------------


def star(n: int, poly_id: int = 1, cx: float = 5.0, cy: float = 50.0, phase: float = 0.0):
    """The edges of a ragged closed ring of n corners."""
    import math

    at = [(cx + (8 + math.sin(37 * i / n * math.pi) + 0.4 * math.cos(1.7 * i)) * math.cos(2 * math.pi * i / n + phase), cy + (6 + math.cos(23 * i / n * math.pi)) * math.sin(2 * math.pi * i / n + phase)) for i in range(n)]
    return [(poly_id, *at[i], *at[(i + 1) % n]) for i in range(n)]


@pytest.mark.parametrize("cell", [0.1, 0.5, 3.0])
def test_cover_equals_the_parity_of_all_edges(spark, cell):
    import random

    r = random.Random(1)
    rings = star(300) + star(40, 1, 5.0, 50.0, 0.3)[:40] + star(60, 2, 9.0, 52.0) + [(3, 0.0, 40.0, 4.0, 40.0), (3, 4.0, 40.0, 4.0, 44.0), (3, 4.0, 44.0, 0.0, 44.0), (3, 0.0, 44.0, 0.0, 40.0)]
    rings += [(4, -20.0, -3.0, -10.0, -3.0), (4, -10.0, -3.0, -15.0, 2.0), (4, -15.0, 2.0, -20.0, -3.0)]
    places = [(r.uniform(-22, 20), r.uniform(-5, 62)) for _ in range(3000)] + [(0.0, 40.0), (4.0, 42.0), (2.0, 44.0), (2.0, 40.0), (3.0, 42.0), (-15.0, -3.0), (float("nan"), 1.0), (None, 42.0), (1e300, 42.0)]
    points = spark.createDataFrame([(i, *p) for i, p in enumerate(places)], "id long, lon double, lat double")
    edges = spark.createDataFrame(rings, "poly_id int, x1 double, y1 double, x2 double, y2 double")

    def odd(x, y):
        return any(sum((y1 > y) != (y2 > y) and x < (x2 - x1) * (y - y1) / (y2 - y1) + x1 for p, x1, y1, x2, y2 in rings if p == poly) % 2 for poly in (1, 2, 3, 4))

    want = {i for i, (x, y) in enumerate(places) if x is not None and x == x and odd(x, y)}
    got = [x["id"] for x in grid.inside_polygon(points, cover.polygon_cover(edges, cell), "id").collect()]
    assert len(want) > 200 and sorted(got) == sorted(want)
    assert {x["id"] for x in grid.inside_polygon(points, edges, "id").collect()} == want
    assert grid.inside_polygon(points, cover.polygon_cover(edges.limit(0), cell), "id").count() == 0


def test_cover_of_many_edges_spares_points_the_edges(spark):
    """100,000 edges: a point meets five thousand of them by bands, a few by the cover."""
    rings = spark.createDataFrame(star(100_000), "poly_id int, x1 double, y1 double, x2 double, y2 double")
    points = spark.range(20_000).select("id", (F.col("id") * 7919 % 20_000 / 1000 - 5).alias("lon"), (F.col("id") * 104_729 % 16_000 / 1000 + 42).alias("lat"))
    c = stages.stored_cover(rings, 0.05)
    of = files.kept(cover.met(points, c, "id"), "met")
    pairs = of.where("run is not null").join(c.edges, ["poly_id", "row", "run"]).count()
    bands = points.join(rings.withColumn("_b", F.explode(F.sequence(F.floor(F.least("y1", "y2")), F.floor(F.greatest("y1", "y2"))))), F.floor("lat") == F.col("_b")).count()
    n = of.count()
    assert n < 20_000 and of.where("run is not null").count() < 0.2 * n and pairs < 0.02 * bands
    assert bands > 4000 * 20_000 / 2
    inside = {x["id"] for x in grid.inside_polygon(points, c, "id").collect()}
    some = points.where("id % 100 = 0")
    assert inside & {100 * i for i in range(200)} == {x["id"] for x in grid.inside_polygon(some, rings, "id").collect()}


def test_strict_dedup_moves_keys_and_uids_only(spark):
    """Over the keyed layout, without broadcasts: the records are read in their buckets, two shuffles carry keys and uids."""
    was = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    try:
        pre = queries._pre(spark, SF)
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
        plan = merge.dedup_cross_source(pre)._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", was)
    assert plan.count("FileScan") == 2 and plan.count("Exchange hashpartitioning") == 2 and "Bucketed: true" in plan
    files.forget(spark, "merged")
    assert not [t for t in spark.catalog.listTables() if t.name.startswith("merged_")]


def test_strict_dedup_by_preference(spark):
    rows = [("a", "GBIF", "G:1", 1), ("a", "NBN", "N:1", 1), ("a", "GBIF", "G:2", 2), ("a", "NBN", "N:2", 2), ("a", "NBN", "N:3", 2), ("a", "NBN", "N:1", None), ("b", "NBN", "N:1", None), ("b", "other", "o:1", 1)]
    df = spark.createDataFrame(rows, "species_slug string, source string, occ_uid string, d int").withColumns({"lon_k": F.lit(1), "lat_k": F.lit(2), "event_day": F.date_add(F.lit(date(2020, 1, 1)), F.col("d"))})
    left = lambda p: sorted((r["species_slug"], r["occ_uid"], r["d"] or 0) for r in merge.dedup_cross_source(df, p).collect())
    every = sorted((r[0], r[2], r[3] or 0) for r in rows)
    assert left("GBIF") == [x for x in every if x[:2] != ("a", "N:1")]
    assert left("NBN") == [x for x in every if x[:2] != ("a", "G:1")]
    assert left("none") == [x for x in every if x[:2] not in (("a", "N:1"), ("a", "G:1"))]


# --- publishing, isolation, deltas -----------------------------------------------------------------------------------


def test_a_job_that_dies_leaves_the_old_snapshot_whole(spark, tmp_path):
    root = f"file://{tmp_path}/t"
    rows = lambda: sorted((r["species_slug"], r["n"]) for r in files.scan_stage(spark, root).collect())
    df = spark.createDataFrame([("a", 1), ("b", 2), ("c", 3)], "species_slug string, n int")
    with pytest.raises(FileNotFoundError):
        files.scan_stage(spark, root)
    files.sink_stage(df, root)
    # The write dies after the files of the first species are there: each is a task of its own, one at a time.
    bad = df.withColumn("n", F.when(F.col("species_slug") == "b", F.raise_error(F.lit("lost")).cast("int")).otherwise(F.col("n") + 10)).repartition(3, "n")
    with pytest.raises(Exception, match="lost"):
        files.sink_stage(bad, root)
    assert rows() == [("a", 1), ("b", 2), ("c", 3)] and snapshots.latest(spark, root) == 1
    # Whole data without a manifest is not seen either.
    snapshots.write_species(df.withColumn("n", F.lit(7)), root)
    assert rows() == [("a", 1), ("b", 2), ("c", 3)]
    files.sink_stage(df.where("n = 2").withColumn("n", F.lit(5)), root)
    files.sink_stage(df.limit(0), root)
    assert rows() == [("a", 1), ("b", 5), ("c", 3)] and snapshots.latest(spark, root) == 2
    assert sorted((r["species_slug"], r["n"]) for r in files.scan_stage(spark, root, ["b", "gone"]).collect()) == [("b", 5)]
    assert files.scan_stage(spark, root, ["gone"]).columns == ["species_slug", "n"] and files.scan_stage(spark, root, ["gone"]).count() == 0
    assert snapshots.expire(spark, root) >= 2 and rows() == [("a", 1), ("b", 5), ("c", 3)]


def test_two_writers_both_come_through(spark, tmp_path, monkeypatch):
    root, df = f"file://{tmp_path}/t", spark.createDataFrame([("a", 1)], "species_slug string, n int")
    files.sink_stage(df, root)
    mine, seen = snapshots.write_species(df.withColumn("species_slug", F.lit("b")), root), []
    real = snapshots.latest

    def late(s, r):  # another writer publishes between the look and the rename
        n = real(s, r)
        if not seen:
            seen.append(snapshots._put(s, r, n + 1, {**snapshots.manifest(s, r, n), **snapshots.write_species(df.withColumn("species_slug", F.lit("c")), r)}))
        return n

    monkeypatch.setattr(snapshots, "latest", late)
    assert snapshots.commit(spark, root, mine) == 3 and seen == [True]
    assert sorted(r["species_slug"] for r in files.scan_stage(spark, root).collect()) == ["a", "b", "c"]


def test_isolation_halves_until_the_bad_are_alone(spark):
    calls = []

    def run(slugs):
        calls.append(slugs)
        if bad & set(slugs):
            raise ValueError(f"bad {sorted(bad & set(slugs))}")
        return spark.createDataFrame([(s, "ok", "") for s in slugs], "slug string, status string, note string")

    slugs, bad = [f"s{i:02d}" for i in range(32)], {"s03", "s17"}
    got = {r["slug"]: r["status"] for f in stages.isolated(slugs, run) for r in f.collect()}
    assert got == {s: "error" if s in bad else "ok" for s in slugs} and len(calls) < 24
    with pytest.raises(ValueError):
        stages.isolated(slugs, lambda part: run(["s03"]), most=4)
    assert stages.isolated([], run) == []


def test_a_repeated_batch_counts_once(spark, tmp_path):
    root, g = f"file://{tmp_path}/g", queries.EXTENT
    points = lambda lon, n: spark.createDataFrame([("a", lon, 50.0)] * n, "species_slug string, lon double, lat double")
    now = lambda: sorted(r["n"] for r in streams.counts_now(spark, root).collect())
    assert now() == []
    streams.add_counts(points(5.0, 3), 0, root, g, fold=3)
    streams.add_counts(points(15.0, 2), 1, root, g, fold=3)
    streams.add_counts(points(15.0, 2), 1, root, g, fold=3)  # tried again
    assert now() == [2, 3] and streams.folded(spark, root) == -1
    streams.add_counts(points(5.0, 1), 2, root, g, fold=3)
    assert now() == [2, 4] and streams.folded(spark, root) == 2
    streams.add_counts(points(5.0, 1), 2, root, g, fold=3)  # again, when it is in the base already
    streams.add_counts(points(5.0, 4), 3, root, g, fold=3)
    assert now() == [2, 8]
    (tmp_path / "g" / "deltas" / f"{4:012d}").mkdir()  # a batch that died: no marker of success
    assert now() == [2, 8]


def test_a_batch_reads_only_itself(spark, tmp_path):
    """The plan of a batch's counts reads the batch's rows and no file."""
    from fieldspark.operators.grid import cell_counts

    points = spark.createDataFrame([("a", 5.0, 50.0)], "species_slug string, lon double, lat double")
    assert "FileScan" not in cell_counts(points, queries.EXTENT)._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("most", [500, 100_000])
def test_quantiles_of_a_million_values(spark, most):
    import numpy as np

    n = 1_000_000
    df = spark.range(n).select(((F.col("id") * 7919) % n * 0.37 + F.when(F.col("id") % 5 == 0, 1e6).otherwise(0)).alias("x"))
    x = np.sort(((np.arange(n) * 7919) % n) * 0.37 + np.where(np.arange(n) % 5 == 0, 1e6, 0))
    at = (0.0, 0.001, 0.25, 0.5, 0.799, 0.8, 0.95, 0.99, 1.0)
    got = list(report.quantiles(df, F.col("x"), at, most=most).first())
    assert got == pytest.approx(np.quantile(x, at).tolist(), rel=1e-12)


def test_quantiles_of_few_and_equal_values(spark):
    q = lambda values: list(report.quantiles(spark.createDataFrame([(v,) for v in values], "x double"), F.col("x"), (0.0, 0.3, 0.5, 1.0), most=1).first())
    assert q([None, float("nan")]) == [None] * 4 and q([3.0]) == [3.0] * 4
    assert q([1.0] * 50 + [2.0] * 50 + [None]) == [1.0, 1.0, 1.5, 2.0]
    assert q([float(i) for i in range(11)]) == pytest.approx([0.0, 3.0, 5.0, 10.0])


def test_separators_and_ragged_logs(spark, tmp_path):
    assert [files.separator_of(p) for p in ("a.csv", "A.CSV.gz", "a.tsv", "a.txt", "x.csv/part")] == [",", ",", "\t", "\t", "\t"]
    (tmp_path / "log.csv").write_text('a,b\n1\n2,NA,"x, ""y""",z\n,5\n')
    log = files.scan_runlog(spark, f"{tmp_path}/log.csv")
    assert log.columns == ["a", "b", "extra_col_1", "extra_col_2"]
    assert sorted(map(tuple, log.collect()), key=str) == sorted([("1", None, None, None), ("2", None, 'x, "y"', "z"), (None, "5", None, None)], key=str)


def test_densified_extent_holds_the_whole_box(spark):
    box = spark.createDataFrame([(-25.0, 34.0, 45.0, 72.0)], "w double, s double, e double, n double")
    dense, four = grid.extent_of(grid.densified(box)), grid.extent_of(grid.box_corners(spark))
    assert (four.xmin, four.ymin, four.ncol, four.nrow) == (1_150_000.0, 1_925_000.0, 253, 153)
    assert dense.ymin < four.ymin and dense.ymin + dense.nrow * dense.cell >= four.ymin + four.nrow * four.cell
    inside = spark.range(71 * 39).select((F.col("id") % 71 - 25).cast("double").alias("lon"), (F.floor(F.col("id") / 71) + 34).cast("double").alias("lat"))
    assert grid.assign_cell(inside, dense).where("not in_bounds").count() == 0 < grid.assign_cell(inside, four).where("not in_bounds").count()
    assert grid.densified(box.limit(0)).count() == 0


def test_exact_stream_dedup_of_many_keys(spark, tmp_path):
    """No Python call per key: 20,000 keys with copies, nulls and a hot key land twice, and pass once with the first row of their first landing."""
    rows = spark.range(60_000).select((F.col("id") % 20_000).alias("n"), "id").select(
        F.when(F.col("n") % 100 > 0, F.concat(F.lit("r"), F.col("n").cast("string"))).alias("key"), F.timestamp_seconds(F.when(F.col("id") % 7 > 0, 60_000 - F.col("id"))).alias("landed_at"), "id"
    )
    first = [r["id"] for r in spark.sql("SELECT id FROM (SELECT id, row_number() OVER (PARTITION BY key ORDER BY landed_at NULLS FIRST, id) AS n FROM {rows}) WHERE n = 1", rows=rows).collect()]
    folder, out = f"{tmp_path}/landed", f"{tmp_path}/out"
    for new in (0, 5):
        files.land(rows.where("key is null or key <> 'r7'") if not new else rows, folder)  # the second time all keys but one are known
        stream = streams.dedup_exact(streams.landed(spark, folder, rows.schema), ["key"], "landed_at", ["id"])
        plan = stream._jdf.queryExecution().analyzed().toString()
        assert "InPandasWithState" not in plan and "DeduplicateWithinWatermark" in plan
        streams.ingest(stream, out, f"{tmp_path}/checkpoint", by_clock=True)
    assert sorted(r["id"] for r in spark.read.schema(rows.schema).parquet(out).collect()) == sorted(first)


def test_points_are_placed_in_one_pass(spark):
    """What grid_stage gives reads stored counts, not the points again."""
    points = spark.createDataFrame([("a", 5.0, 50.0), ("a", 5.0, 50.0), ("a", 100.0, 0.0), ("b", None, 50.0)], "species_slug string, lon double, lat double")
    cells, presence, summary = stages.grid_stage(points, queries.EXTENT, None)
    assert "LogicalRDD" not in summary._jdf.queryExecution().optimizedPlan().toString() and "LogicalRDD" not in presence._jdf.queryExecution().optimizedPlan().toString()
    assert sorted(map(tuple, summary.collect())) == [("a", 3, 3, 2, 2, 1), ("b", 1, 0, 0, 0, 0)]
    assert sorted(map(tuple, summary.collect())) == sorted(map(tuple, grid.grid_summary(points, presence, queries.EXTENT, points).collect()))


def test_records_are_cleaned_once(spark):
    """With the columns named, basics() reads stored records, and no others; the rows are the same."""
    clean, cols = queries._clean(spark, SF), [*queries._IDS, "occ_uid", "year", "issues"]
    once = stages.basics(clean, carry=["issues"]).select(*cols)
    plan = once._jdf.queryExecution().optimizedPlan().toString()
    assert "o_orderdate" not in plan and "licence" not in plan
    assert once.exceptAll(stages.basics(clean).select(*cols)).count() == 0 and once.count() == clean.count()
