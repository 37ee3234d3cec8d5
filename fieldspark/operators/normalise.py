"""Stage 00: clean schemas of the two sources, screening, and exact repeats within a source."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.licences import EXPECTED, licence_code_gbif, licence_code_nbn, licence_expected
from ..functions.scalars import col_or_null, safe_double, safe_int, slugify

# Pairs of coordinate columns by preference.
COORDS = (("lon", "lat"), ("longitude", "latitude"), ("decimalLongitude", "decimalLatitude"), ("decimal_longitude", "decimal_latitude"), ("lon_r", "lat_r"), ("x", "y"), ("X", "Y"))


def scan_coords(df: DataFrame) -> DataFrame:
    """df with its first pair of coordinate columns renamed to lon and lat. ValueError names the columns if there is none."""
    for a, b in COORDS:
        if a in df.columns and b in df.columns:
            return df.withColumnsRenamed({a: "lon", b: "lat"})
    raise ValueError(f"no coordinate columns among {df.columns[:60]}")


#: Text columns that both sources have in the clean schema, and those of one of them.
_SHARED = ("basisOfRecord", "taxonRank", "certainty", "identificationVerificationStatus", "identifiedBy", "occurrenceStatus", "datasetKey", "datasetName", "publishingOrgKey", "institutionCode", "collectionCode")
_OWN = {"GBIF": ("gbifID", "occurrenceID", "dateIdentified"), "NBN": ("recordID", "coordinatePrecision")}


def record_id_column(columns: list[str], source: str) -> str:
    """Which column names a source's records: decided by the columns that a table has, not row by row."""
    if source == "NBN":
        return "recordID"
    return "gbifID" if "gbifID" in columns else "occurrenceID"


def normalise(df: DataFrame, source: str, expected: tuple[str, ...] | None = None) -> DataFrame:
    """The clean schema of one source's raw records; absent columns are null. Numbers that can't be read are null."""
    gbif = source == "GBIF"
    raw = col_or_null(df, "dcterms:license" if not gbif and "dcterms:license" in df.columns else "license")
    code = licence_code_gbif(raw) if gbif else licence_code_nbn(raw)
    return df.select(
        F.lit(source).alias("source"),
        col_or_null(df, "species").alias("species"),
        slugify(col_or_null(df, "species")).alias("species_slug"),
        col_or_null(df, record_id_column(df.columns, source)).alias("source_record_id"),
        *(col_or_null(df, c).alias(c) for c in _OWN[source]),
        safe_double(col_or_null(df, "decimalLongitude")).alias("lon"),
        safe_double(col_or_null(df, "decimalLatitude")).alias("lat"),
        col_or_null(df, "eventDate").alias("date_raw"),
        safe_int(col_or_null(df, "year")).alias("year_raw"),
        col_or_null(df, "countryCode").alias("country"),
        raw.alias("licence_raw"),
        code.alias("licence"),
        licence_expected(code, expected or EXPECTED[source]).alias("licence_expected"),
        safe_double(col_or_null(df, "coordinateUncertaintyInMeters")).alias("coordinateUncertaintyInMeters"),
        *(col_or_null(df, c).alias(c) for c in _SHARED),
        (col_or_null(df, "issues") if "issues" in df.columns else col_or_null(df, "issue")).alias("issues"),
        *(F.col(c) for c in ("k", "copy_no") if c in df.columns),
    )


def normalise_both(df: DataFrame) -> DataFrame:
    """The clean schema of records of both sources (column source) in one pass; records of any other source are left out."""
    gbif = F.col("source") == "GBIF"
    pick = lambda a, b: F.when(gbif, a).otherwise(b)
    raw = pick(col_or_null(df, "license"), col_or_null(df, "dcterms:license" if "dcterms:license" in df.columns else "license"))
    code = pick(licence_code_gbif(raw), licence_code_nbn(raw))
    return df.where(F.col("source").isin(*EXPECTED)).select(
        "source",
        col_or_null(df, "species").alias("species"),
        slugify(col_or_null(df, "species")).alias("species_slug"),
        pick(*(col_or_null(df, record_id_column(df.columns, s)) for s in ("GBIF", "NBN"))).alias("source_record_id"),
        *(F.when(gbif if s == "GBIF" else ~gbif, col_or_null(df, c)).alias(c) for s in _OWN for c in _OWN[s]),
        safe_double(col_or_null(df, "decimalLongitude")).alias("lon"),
        safe_double(col_or_null(df, "decimalLatitude")).alias("lat"),
        col_or_null(df, "eventDate").alias("date_raw"),
        safe_int(col_or_null(df, "year")).alias("year_raw"),
        col_or_null(df, "countryCode").alias("country"),
        raw.alias("licence_raw"),
        code.alias("licence"),
        pick(*(licence_expected(code, EXPECTED[s]) for s in ("GBIF", "NBN"))).alias("licence_expected"),
        safe_double(col_or_null(df, "coordinateUncertaintyInMeters")).alias("coordinateUncertaintyInMeters"),
        *(col_or_null(df, c).alias(c) for c in _SHARED),
        (col_or_null(df, "issues") if "issues" in df.columns else col_or_null(df, "issue")).alias("issues"),
        *(F.col(c) for c in ("k", "copy_no") if c in df.columns),
    )


def refresh_expected(clean: DataFrame, source: str, expected: tuple[str, ...] | None = None) -> DataFrame:
    """A clean table that was kept: texts and numbers cast anew, licence_expected by the set that holds now."""
    number = {"lon": safe_double, "lat": safe_double, "coordinateUncertaintyInMeters": safe_double, "year_raw": safe_int}
    cast = {c: number[c](F.col(c).cast("string")) if c in number else F.col(c).cast("string") for c in clean.columns if c not in ("licence_expected", "k", "copy_no")}
    return clean.withColumns({**cast, "licence_expected": licence_expected(F.col("licence"), expected or EXPECTED[source])})


def screen_coords(df: DataFrame) -> DataFrame:
    return df.where("lon is not null and lat is not null")


def screen_licence(df: DataFrame, allowed: list[str]) -> DataFrame:
    return df.where(F.col("licence").isin(*allowed))


def keep_first(df: DataFrame, keys: list[str], order: list[Column]) -> DataFrame:
    """The first row of each key by a total order; nulls are equal, so all rows with null keys are one group.

    The filter on the row number lets each task keep its first row of a key before the shuffle (a group limit in the
    plan), so a key with many rows sends one per task.
    """
    w = Window.partitionBy(*keys).orderBy(*order)
    return df.withColumn("_rn", F.row_number().over(w)).where("_rn = 1").drop("_rn")


def dedup_by_id(df: DataFrame, order: list[Column]) -> DataFrame:
    return keep_first(df, ["source_record_id", "source", "species_slug"], order)  # what differs most comes first: rows are sorted by it


def dedup_by_place(df: DataFrame, order: list[Column]) -> DataFrame:
    return keep_first(df, ["lon", "lat", "date_raw", "source", "species_slug"], order)


def dedup_within_source(df: DataFrame, order: list[Column]) -> DataFrame:
    """First by id, then the survivors by exact place and date text."""
    return dedup_by_place(dedup_by_id(df, order), order)


def requested_year(df: DataFrame, year: int, column: str = "year") -> DataFrame:
    """Records of one year; the column may be text."""
    return df.where(safe_int(F.col(column).cast("string")) == year)


def exact_species_match(taxa: DataFrame, names: DataFrame) -> DataFrame:
    """Taxa of rank species whose name is asked for (column name), case ignored."""
    name = "scientific_name" if "scientific_name" in taxa.columns else "scientificName"
    asked = names.select(F.lower("name").alias("_asked")).distinct()
    return taxa.where(F.lower("rank") == "species").join(asked, F.lower(F.col(name)) == F.col("_asked"), "left_semi")


def enrich_left_join(core: DataFrame, more: DataFrame, key: str = "recordID") -> DataFrame:
    """core with the fields of more, of which one row per key counts."""
    return core.join(more.dropDuplicates([key]), key, "left")


def split_by_input(asked: DataFrame, found: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(slugs that have input, slugs to skip) of asked (slug), by found (species_slug)."""
    have = found.select(F.col("species_slug").alias("slug")).distinct()
    return asked.join(have, "slug", "left_semi"), asked.join(have, "slug", "left_anti")
