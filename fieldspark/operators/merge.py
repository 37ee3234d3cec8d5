"""Stage 01: union of the sources, derived columns, and strict one-to-one duplicates across sources."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.scalars import coord_key, date_precision, parse_day, safe_double

# Other names of columns that add_basics() reads, by preference.
ALTERNATES = {"lon": ["decimalLongitude"], "lat": ["decimalLatitude"], "date_raw": ["date", "eventDate"], "year_raw": ["year"]}

KEY = ["species_slug", "lon_k", "lat_k", "event_day"]
UID = ["species_slug", "occ_uid"]


def union_sources(frames: list[DataFrame]) -> DataFrame:
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), frames)


def row_numbers(df: DataFrame, keys: list[str], order: list[Column], bucket: Column) -> DataFrame:
    """Adds _n, each row's place by ``order`` within its keys, from 1.

    bucket must not fall along the order. Rows are numbered within (keys, bucket), and a bucket starts behind the counts
    of the earlier ones, so that a key's rows don't meet in one task.
    """
    rows = df.withColumn("_b", bucket)
    sizes = rows.groupBy(*keys, "_b").agg(F.count("*").alias("_c"))
    before = F.sum("_c").over(Window.partitionBy(*keys).orderBy("_b").rowsBetween(Window.unboundedPreceding, -1))
    starts = sizes.select(*(F.col(k).alias(f"_of_{k}") for k in keys), F.col("_b").alias("_at"), F.coalesce(before, F.lit(0)).alias("_before"))
    same = reduce(lambda a, c: a & c, [F.col(k).eqNullSafe(F.col(f"_of_{k}")) for k in keys], F.col("_b").eqNullSafe(F.col("_at")))
    own = rows.withColumn("_n", F.row_number().over(Window.partitionBy(*keys, "_b").orderBy(*order)))
    return own.join(starts, same).withColumn("_n", F.col("_n") + F.col("_before")).drop("_b", "_at", "_before", *(f"_of_{k}" for k in keys))


def usual_names(df: DataFrame) -> DataFrame:
    """df with lon, lat, date_raw and year_raw, from their other names where it lacks them; coordinates as numbers, null if they can't be read."""
    for name, others in ALTERNATES.items():
        other = next((c for c in others if c in df.columns), None)
        if name not in df.columns:
            df = df.withColumn(name, F.col(other).cast("string") if other else F.lit(None).cast("string"))
    number = {c: safe_double(F.col(c).cast("string")) for c in ("lon", "lat") if dict(df.dtypes)[c] != "double"}
    return df.withColumns(number) if number else df


def source_years(df: DataFrame) -> DataFrame:
    """(species_slug, source, _years): how many records have a year; a row per species and source."""
    return df.groupBy("species_slug", "source").agg(F.count("year_raw").alias("_years"))


def add_basics(df: DataFrame, order: list[Column], dp: int = 4, bucket: Column | None = None, years: DataFrame | None = None) -> DataFrame:
    """Adds species_input, occ_uid, date_is_range, event_day, year, date_precision, lon_k, lat_k, lon_r, lat_r.

    lon, lat, date_raw and year_raw may go by their usual other names. species_input, if df lacks it, is species as written.
    Rows without an id get row_<n> by ``order`` within species and source; only they are shuffled, and numbered by
    ``bucket`` (see row_numbers; none: a species' source in one task). The year comes from event_day only where a species'
    source has no year at all. years: source_years(df), if it is stored already: small, so that no record moves for it.
    """
    df = usual_names(df)
    if "species_input" not in df.columns:
        df = df.withColumn("species_input", F.col("species"))
    day = parse_day(F.col("date_raw"))
    has_id = F.col("source_record_id").isNotNull() & (F.length("source_record_id") > 0)
    rows = df.withColumns({"date_is_range": F.coalesce(F.contains("date_raw", F.lit("/")), F.lit(False)), "event_day": day, "_id": has_id})
    keys = ["species_slug", "source"]
    nameless = rows.where(~F.col("_id"))
    if bucket is None:
        nameless = nameless.withColumn("_n", F.row_number().over(Window.partitionBy(*keys).orderBy(*order)).cast("long"))
    else:
        nameless = row_numbers(nameless, keys, order, bucket)
    named = rows.where("_id").withColumn("_n", F.lit(None).cast("long"))
    uid = F.concat("source", F.lit(":"), F.coalesce(F.concat(F.lit("row_"), F.col("_n").cast("string")), "source_record_id"))
    year = F.when(F.col("_years") > 0, F.col("year_raw").cast("int")).otherwise(F.year("event_day"))
    out = named.unionByName(nameless).withColumn("occ_uid", uid).join(source_years(df) if years is None else years, keys, "left").withColumn("year", year)
    keyed = out.withColumns({"date_precision": date_precision(F.col("event_day"), F.col("year")), "lon_k": coord_key(F.col("lon"), dp), "lat_k": coord_key(F.col("lat"), dp)})
    return keyed.withColumns({"lon_r": F.col("lon_k") / 10**dp, "lat_r": F.col("lat_k") / 10**dp}).drop("_id", "_n", "_years", "year_raw")


def key_texts(df: DataFrame, dp: int = 4) -> DataFrame:
    """Adds key_day and key_year as texts: species, rounded place and day or year, joined by bars; null without them."""
    place = lambda c: F.format_string(f"%.{dp}f", F.col(c))
    text = lambda last: F.when(last.isNotNull(), F.concat_ws("|", "species", place("lon_r"), place("lat_r"), last.cast("string")))
    here = F.col("lon_r").isNotNull() & F.col("lat_r").isNotNull()
    return df.withColumns({"key_day": F.when(here, text(F.col("event_day"))), "key_year": F.when(here, text(F.col("year")))})


def keyed_by_day(df: DataFrame) -> Column:
    """Whether a row has the strict key: day precision and both coordinates."""
    return F.col("event_day").isNotNull() & F.col("lon_k").isNotNull() & F.col("lat_k").isNotNull()


def dup_group_counts(df: DataFrame, key: list[str] = KEY) -> DataFrame:
    """Rows per key, in all and by source."""
    gbif, nbn = F.count_if(F.upper("source") == "GBIF"), F.count_if(F.upper("source") == "NBN")
    return df.where(keyed_by_day(df)).groupBy(*key).agg(F.count("*").alias("n"), gbif.alias("n_gbif"), nbn.alias("n_nbn"))


def strict_keys(df: DataFrame) -> DataFrame:
    """Keys that have one row of each source and no other: aggregated in part before anything is shuffled."""
    return dup_group_counts(df).where("n = 2 and n_gbif = 1 and n_nbn = 1").select(*KEY)


def strict_pairs(df: DataFrame, prefer: str = "GBIF") -> DataFrame:
    """Strict keys with drop_uids: the uids of those of their two rows whose source is not preferred.

    One aggregation, in part before the shuffle: a strict key has one row of a source, so the greatest uid is that row's.
    A key with many rows sends a row per task.
    """
    source, others = F.upper("source"), [s for s in ("GBIF", "NBN") if s != prefer]
    uids = [F.max(F.when(source == s, F.col("occ_uid"))).alias(f"_{s}") for s in others]
    counts = [F.count("*").alias("n"), *(F.count_if(source == s).alias(f"n_{s}") for s in ("GBIF", "NBN"))]
    # Spark sorts for it: by the places first, as most rows differ there.
    groups = df.where(keyed_by_day(df)).groupBy("lon_k", "lat_k", "event_day", "species_slug").agg(*counts, *uids).where("n = 2 and n_GBIF = 1 and n_NBN = 1")
    return groups.select(*KEY, F.array(*(f"_{s}" for s in others)).alias("drop_uids"))


def strict_uids(df: DataFrame, prefer: str = "GBIF") -> DataFrame:
    """(species_slug, occ_uid) to drop: of strict keys, the row of the source that is not preferred."""
    return strict_pairs(df, prefer).select("species_slug", F.explode("drop_uids").alias("occ_uid"))


def flag_strict(df: DataFrame, prefer: str = "GBIF", pairs: DataFrame | None = None) -> DataFrame:
    """Adds strict_drop to every row of a species that has a dropped uid, with or without a key. pairs: strict_pairs(df, prefer), if it is stored already."""
    pairs = strict_pairs(df, prefer) if pairs is None else pairs
    drop = pairs.select("species_slug", F.explode("drop_uids").alias("occ_uid")).distinct().withColumn("_d", F.lit(True))
    return df.join(drop, ["species_slug", "occ_uid"], "left").withColumn("strict_drop", F.coalesce("_d", F.lit(False))).drop("_d")


def dedup_cross_source(df: DataFrame, prefer: str = "GBIF") -> DataFrame:
    """df without the strict duplicates: every row of a species that shares a dropped uid goes.

    A df that is laid out by UID (files.kept_keyed) is not shuffled for it: only keys with their counts and the dropped
    uids move.
    """
    return df.join(strict_uids(df, prefer), UID, "left_anti")


def cross_dup_flags(df: DataFrame) -> DataFrame:
    """Adds flag_strict_key (one row of each source on a day key), flag_both_sources and flag_loose_year."""
    strict = dup_group_counts(df).withColumns({"_s": (F.col("n") == 2) & (F.col("n_gbif") == 1) & (F.col("n_nbn") == 1), "_b": (F.col("n_gbif") > 0) & (F.col("n_nbn") > 0)}).select(*KEY, "_s", "_b")
    loose_key = ["species_slug", "lon_k", "lat_k", "year"]
    loose = (
        df.where("lon_k is not null and lat_k is not null and year is not null").groupBy(*loose_key)
        .agg(F.count_if(F.col("source") == "GBIF").alias("g"), F.count_if(F.col("source") == "NBN").alias("m"), F.count_if(F.col("date_precision") != "day").alias("v"))
        .where("g > 0 and m > 0 and v > 0").select(*loose_key, F.lit(True).alias("_l"))
    )
    out = df.join(strict, KEY, "left").join(loose, loose_key, "left")
    flag = lambda c: F.coalesce(c, F.lit(False))
    return out.withColumns({"flag_strict_key": flag("_s"), "flag_both_sources": flag("_b"), "flag_loose_year": flag("_l")}).drop("_s", "_b", "_l")


def crossdup_review(df: DataFrame) -> DataFrame:
    """Rows of keys that both sources have, but not one each. The keys are counted in part before they are shuffled; then rows meet the few that are left."""
    gbif, nbn = (F.count_if(F.col("source") == s).alias(f"_{s}") for s in ("GBIF", "NBN"))
    keys = df.where(keyed_by_day(df)).groupBy(*KEY).agg(gbif, nbn).where("_GBIF > 0 and _NBN > 0 and not (_GBIF = 1 and _NBN = 1)")
    return df.join(keys.select(*KEY), KEY, "left_semi")
