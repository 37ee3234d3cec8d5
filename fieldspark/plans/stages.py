"""The stages composed from the operators: all species in one frame."""

from __future__ import annotations

import uuid
from collections.abc import Callable
from functools import reduce

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from ..functions.scalars import slugify
from ..operators import cover, grid, merge, normalise, policy, qc, report
from ..sources import files

ORDER = ["copy_no", "k"]
#: Rows are numbered in runs of so many values of k.
RUN = 1 << 16


def order() -> list[Column]:
    return [F.col(c) for c in ORDER]


def bucket() -> Column:
    """Follows the order in runs of bounded length."""
    return F.struct(F.col("copy_no"), F.floor(F.col("k") / RUN).alias("run"))


def normalise_stage(raw: DataFrame) -> DataFrame:
    """Both sources of a landed frame in one clean schema, in one pass. record_id names a record of either source, if the raw frame has it."""
    if "record_id" in raw.columns:
        raw = raw.withColumns({"gbifID": F.col("record_id"), "recordID": F.col("record_id")})
    return normalise.normalise_both(raw)


def normalise_landed(spark: SparkSession, root: str) -> DataFrame:
    """All raw files below a folder in the clean schema, by the first layout that has them; no rows if there are none.

    The files of a source share their header. File names come to the driver, one per species and source.
    """
    found = files.resolve_layout(files.landed_tables(spark, root))
    frames = []
    for source in ("GBIF", "NBN"):
        paths = [r["path"] for r in found.where(F.col("source") == source).select("path").collect()]
        raw = spark.read.csv(paths, header=True, nullValue="NA") if paths else files.empty_typed(spark, "species string")
        frames.append(normalise.normalise(raw, source))
    return merge.union_sources(frames)


def basics(clean: DataFrame, dp: int = 4, carry: list[str] | None = None) -> DataFrame:
    """Clean records of any kind with their derived columns. The years are counted first, by a job of their own over three columns.

    carry: the other columns that are wanted, beside those that the merge reads. Then these are written once to the shared
    folder, so that records are made and cleaned once, not for the years, the named, the nameless and their numbers each.
    """
    if carry is not None:
        clean = files.kept(clean.select(*dict.fromkeys([*MERGED, *ORDER, *carry])), "clean")
    return merge.add_basics(clean, order(), dp, bucket(), files.kept(merge.source_years(clean), "years"))


def screened(clean: DataFrame, sources: tuple[str, ...] = ("GBIF", "NBN")) -> tuple[DataFrame, DataFrame]:
    """(screened and within-source deduplicated records, written; the funnel: rows per source after each step).

    The counts ride on the write, so the records pass once. Spark adds what each finished task has seen: if an executor is
    lost and its part of an earlier shuffle is made again, counts before that shuffle can come out too high. Where they
    must not, count with report.screening_funnel().
    """
    steps: dict[str, Observation] = {}

    def watched(df: DataFrame, name: str) -> DataFrame:
        steps[name] = Observation(f"{name}-{uuid.uuid4().hex}")
        return df.observe(steps[name], *(F.count_if(F.col("source") == s).alias(s) for s in sources))

    rows = watched(normalise.screen_coords(watched(clean, "n_raw")), "n_screened")
    rows = watched(normalise.dedup_by_id(rows, order()), "n_by_id")
    rows = files.kept(watched(normalise.dedup_by_place(rows, order()), "n_deduped"), "within")
    seen = {name: o.get for name, o in steps.items()}
    funnel = [(s, *(seen[name][s] for name in steps)) for s in sources if seen["n_raw"][s]]
    return rows, clean.sparkSession.createDataFrame(funnel, "source string, " + ", ".join(f"{name} long" for name in steps))


#: What the merge itself reads of a clean record, beside the columns of the order.
MERGED = ["source", "species", "species_slug", "source_record_id", "lon", "lat", "date_raw", "year_raw"]


def premerge(clean: DataFrame, dp: int = 4, carry: list[str] | None = None) -> DataFrame:
    """Screened, within-source deduplicated records with their derived columns, laid out by species and uid.

    The deduplicated records are written once to the shared folder, and again with what is derived from them: what
    follows reads those several times, each time with other columns, and would sort and shuffle them anew. A species'
    source has two nameless records at most then, one with a null and one with an empty id, so they need no buckets.
    carry: the other columns that are wanted; none named: all.
    """
    if carry is not None:
        clean = clean.select(*dict.fromkeys([*MERGED, *ORDER, *carry]))
    within = files.kept(normalise.dedup_within_source(normalise.screen_coords(clean), order()), "within")
    years = files.kept(merge.source_years(within), "years")
    return files.kept_keyed(merge.add_basics(within, order(), dp, years=years), "merged", merge.UID)


#: What names a clean record: by the order, a source's records of one species and id all differ.
NAMED = ["source_record_id", "k", "copy_no", "source", "species_slug"]


def merge_stage(clean: DataFrame, dp: int = 4, prefer: str = "GBIF", carry: list[str] | None = None, **log) -> tuple[DataFrame, DataFrame]:
    """(merged without strict duplicates, run log) of screened and within-source deduplicated records. log: see runlog_merged; carry: see premerge.

    What is dropped is decided over the columns that the merge reads: its results are written to the shared folder, the
    log reads those. The other columns move once, when the merged records are read; clean is read again for them.
    """
    if carry is not None:
        clean = clean.select(*dict.fromkeys([*MERGED, *ORDER, *carry]))
    within = files.kept(normalise.dedup_within_source(normalise.screen_coords(clean.select(*MERGED, *ORDER)), order()), "within")
    pre = merge.add_basics(within, order(), dp, years=files.kept(merge.source_years(within), "years"))
    pairs = files.kept(merge.strict_pairs(pre, prefer), "pairs")
    strict = files.kept(merge.flag_strict(pre, prefer, pairs), "flagged")
    merged = strict.where(~F.col("strict_drop")).drop("strict_drop")
    others = [c for c in clean.columns if c not in (*MERGED, *ORDER)]
    if others:
        more = normalise.screen_coords(clean).select(*(F.col(c).alias(f"_of_{c}") for c in NAMED), *others)
        same = reduce(lambda a, b: a & b, [F.col(c).eqNullSafe(F.col(f"_of_{c}")) for c in NAMED])
        merged = merged.join(more, same)
    derived = [c for c in strict.columns if c not in clean.columns and c != "strict_drop"]
    return merged.select(*(c for c in clean.columns if c in merged.columns), *derived), report.runlog_merged(pre, strict, keys=pairs, **log)


def isolated(slugs: list[str], run: Callable[[list[str]], DataFrame], most: int = 16) -> list[DataFrame]:
    """run() over all species, or over halves of them where it fails, until what fails is one species alone.

    Each call is a job group of its own. A species that fails alone gives (slug, status error, note); run() must leave
    nothing behind when it fails. After ``most`` such species the error is raised: then it is no matter of single species.
    """
    done, errors, waiting = [], 0, [slugs] if slugs else []
    while waiting:
        part = waiting.pop()
        sc = SparkSession.active().sparkContext
        sc.setJobGroup(f"species-{part[0]}-{len(part)}", f"{len(part)} species from {part[0]} on")
        try:
            done.append(run(part))
        except Exception as e:  # noqa: BLE001
            if len(part) > 1:
                waiting += [part[len(part) // 2 :], part[: len(part) // 2]]
                continue
            errors += 1
            if errors > most:
                raise
            done.append(SparkSession.active().createDataFrame([(part[0], "error", str(e)[:500])], "slug string, status string, note string"))
        finally:
            sc.setLocalProperty("spark.jobGroup.id", None)
            sc.setLocalProperty("spark.job.description", None)
    return done


def merge_into(clean: DataFrame, inputs: DataFrame, out: str, overwrite: bool = False, refresh_if_newer: bool = True, continue_on_error: bool = False, **how) -> DataFrame:
    """Merges the species that need it into the stage table at ``out`` and gives the log of all species with input.

    inputs: (slug, modified). Species that stay as they are have the status skipped_cached. All that is to be done is one
    job, published at once. With continue_on_error a species that fails has a row of status error with its message and
    keeps what it had; the others are published, see isolated(). Slugs come to the driver, a row per species.
    """
    spark = clean.sparkSession
    had = files.modified_by_species(spark, out)
    todo = sorted(r["slug"] for r in files.needs_refresh(inputs, had, overwrite, refresh_if_newer).collect())  # fixed before anything is written

    def run(slugs: list[str]) -> DataFrame:
        # A filter by values goes down to the source: what other species' records hold is not even computed.
        merged, log = merge_stage(clean.where(F.col("species_slug").isin(*slugs)), out_root=out, **how)
        log = files.kept(log, "log")
        files.sink_stage(merged, out)
        return log

    logs = isolated(todo, run) if continue_on_error else [run(todo)] if todo else []
    note = "Merged output exists and inputs are not newer (overwrite=FALSE)." if refresh_if_newer else "Merged output exists (overwrite=FALSE)."
    stay = inputs.select("slug").distinct().where(~F.col("slug").isin(*todo))
    logs.append(stay.select("slug", F.lit("skipped_cached").alias("status"), F.lit(note).alias("note")))
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), logs)


def qc_stage(df: DataFrame, as_of: Column | None = None, config: qc.QcConfig = qc.QcConfig()) -> tuple[DataFrame, DataFrame]:
    flagged = qc.qc_flags(df, as_of, config)
    return flagged, qc.runlog_qc(flagged)


def filter_stage(df: DataFrame, p: policy.Policy, as_of: Column) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(kept, dropped with their reason, run log)."""
    judged = policy.with_drop_reason(df, p, as_of)
    return judged.where("drop_reason is null").drop("drop_reason"), judged.where("drop_reason is not null"), policy.runlog_filtered(judged, tuple(p.extra))


def stored_cover(edges: DataFrame, cell: float = 0.25) -> cover.Cover:
    """The polygons' cover, written once: points of any number of frames meet it."""
    c = cover.polygon_cover(edges, cell)
    own = files.kept(c.edges, "cover_edges")
    return cover.Cover(files.kept(c.parts, "cover_parts"), own, cell)


def grid_stage(df: DataFrame, extent: grid.Extent, edges: DataFrame | cover.Cover | None) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(cells with on_land, presence per species and land cell, summary).

    The points are placed and counted in one pass; their counts, a row per species and cell, and the cells are written to
    the shared folder. What follows reads those, as often as it likes.
    """
    tally = files.kept(grid.cell_tally(df, extent), "tally")
    cells = files.kept(grid.land_mask(grid.grid_cells(df.sparkSession, extent), edges), "cells")
    presence = files.kept(grid.grid_presence(grid.tally_counts(tally), cells, tally), "presence")
    return cells, presence, grid.tally_summary(tally, presence)


def grid_into(df: DataFrame, root: str, tag: str, box=(-25.0, 34.0, 45.0, 72.0), cell_km: int = 25, edges: DataFrame | cover.Cover | None = None) -> DataFrame:
    """Grids the records over a box in degrees, writes cells, tables and summary below root, and gives the presence centroids."""
    extent = grid.extent_of(grid.box_corners(df.sparkSession, box), 1000.0 * cell_km)
    cells, presence, summary = grid_stage(df, extent, edges)
    files.sink_grid(cells, presence, summary, root, tag, cell_km)
    return grid.presence_centroids(files.scan_grid(df.sparkSession, root, tag, cell_km))


def missing_columns(df: DataFrame, required: list[str]) -> DataFrame:
    """The schema contract: a row per required column that df lacks."""
    return df.sparkSession.createDataFrame([(c,) for c in required if c not in df.columns], "missing string")


def asked_species(names: DataFrame) -> DataFrame:
    """(species, species_slug) of names (species)."""
    return names.select("species", slugify(F.col("species")).alias("species_slug"))
