"""All queries of the occurrence operators by name, over records derived from the given tables, with equal SQL."""

from __future__ import annotations

from collections.abc import Callable
from datetime import date

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .functions import projection as P
from .functions import scalars as S
from .functions.licences import EXPECTED, GBIF_CODES, GBIF_PATTERNS, NBN_CODES, NBN_PATTERNS
from .operators import grid, merge, normalise, policy, qc, report
from .operators.policy import BASELINE, RULES, Policy
from .plans import stages
from .sources import files
from .sources.fixture import LAND_SQL, OCC_SQL, gbif_raw, land_edges, nbn_raw, occ_raw
from .streaming import streams

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}
AS_OF = date(2026, 1, 1)
CELL = 25_000.0
#: The default box's extent at 25 km; tests hold it against snapped_extent().
EXTENT = grid.Extent(1_150_000.0, 1_925_000.0, 253, 153, CELL)


# --- the same steps in SQL -------------------------------------------------------------------------------------------


def _dbl(x: str) -> str:
    return f"CASE WHEN isnan(TRY_CAST({x} AS DOUBLE)) THEN NULL ELSE TRY_CAST({x} AS DOUBLE) END"


def _slug(x: str) -> str:
    return f"regexp_replace(regexp_replace(lower({x}), '[^a-z0-9]+', '_', 'g'), '^_+|_+$', '', 'g')"


def _day(x: str) -> str:
    return f"CASE WHEN {x} NOT LIKE '%/%' THEN TRY_CAST(nullif(regexp_extract({x}, '\\d{{4}}-\\d{{2}}-\\d{{2}}'), '') AS DATE) END"


def _in(values) -> str:
    return "(" + ", ".join(f"'{v}'" for v in values) + ")"


def _licence(source: str) -> str:
    gbif = source == "GBIF"
    exact = f"WHEN upper(license) IN {_in(GBIF_CODES)} THEN upper(license)" if gbif else f"WHEN license IN {_in(NBN_CODES)} THEN license"
    text = "license" if gbif else "lower(license)"
    return f"CASE {exact} " + " ".join(f"WHEN regexp_matches({text}, '{p}') THEN '{c}'" for c, p in (GBIF_PATTERNS if gbif else NBN_PATTERNS).items()) + " END"


def _basics(source: str) -> str:
    return f"""SELECT *, CASE WHEN event_day IS NOT NULL THEN 'day' WHEN year IS NOT NULL THEN 'year' ELSE 'unknown' END AS date_precision, lon_k / 10000 AS lon_r, lat_k / 10000 AS lat_r
    FROM (SELECT *, CASE WHEN count(year_raw) OVER (PARTITION BY species_slug, source) > 0 THEN year_raw ELSE CAST(date_part('year', event_day) AS INT) END AS year,
      CASE WHEN source_record_id IS NOT NULL AND length(source_record_id) > 0 THEN concat(source, ':', source_record_id)
           ELSE concat(source, ':row_', row_number() OVER (PARTITION BY species_slug, source, (source_record_id IS NOT NULL AND length(source_record_id) > 0) ORDER BY copy_no, k)) END AS occ_uid
    FROM (SELECT *, coalesce(date_raw LIKE '%/%', FALSE) AS date_is_range, {_day("date_raw")} AS event_day,
      CAST(floor(lon * 10000 + 0.5) AS BIGINT) AS lon_k, CAST(floor(lat * 10000 + 0.5) AS BIGINT) AS lat_k FROM {source}))"""


#: Columns of the clean schema that are taken as they are.
MORE = ["identificationVerificationStatus", "identifiedBy", "dateIdentified", "coordinatePrecision", "occurrenceStatus", "datasetKey", "datasetName", "publishingOrgKey", "institutionCode", "collectionCode"]
_KEYED = "event_day IS NOT NULL AND lon_k IS NOT NULL AND lat_k IS NOT NULL"
_CHAIN = f"""WITH raw AS MATERIALIZED ({OCC_SQL}), land AS ({LAND_SQL}),
clean0 AS (SELECT source, species, {_slug("species")} AS species_slug, record_id AS source_record_id, {_dbl("decimalLongitude")} AS lon, {_dbl("decimalLatitude")} AS lat,
  eventDate AS date_raw, CAST(trunc({_dbl("year")}) AS INT) AS year_raw, countryCode AS country, license AS licence_raw,
  CASE WHEN source = 'GBIF' THEN {_licence("GBIF")} ELSE {_licence("NBN")} END AS licence, {_dbl("coordinateUncertaintyInMeters")} AS coordinateUncertaintyInMeters, basisOfRecord, taxonRank, certainty, issues, occurrenceID,
  {", ".join(MORE)}, k, copy_no FROM raw),
clean AS (SELECT *, coalesce(licence IN {_in(GBIF_CODES + NBN_CODES)}, FALSE) AS licence_expected FROM clean0),
screened AS (SELECT * FROM clean WHERE lon IS NOT NULL AND lat IS NOT NULL),
byid AS (SELECT * EXCLUDE (rn) FROM (SELECT *, row_number() OVER (PARTITION BY species_slug, source, source_record_id ORDER BY copy_no, k) AS rn FROM screened) WHERE rn = 1),
within AS (SELECT * EXCLUDE (rn) FROM (SELECT *, row_number() OVER (PARTITION BY species_slug, source, lon, lat, date_raw ORDER BY copy_no, k) AS rn FROM byid) WHERE rn = 1),
allb AS MATERIALIZED ({_basics("clean")}), pre AS MATERIALIZED ({_basics("within")}),
pairs AS (SELECT *, coalesce({_KEYED} AND source <> 'GBIF' AND n = 2 AND g = 1 AND m = 1, FALSE) AS chosen FROM (SELECT *, count(*) OVER w AS n, count(*) FILTER (source = 'GBIF') OVER w AS g,
  count(*) FILTER (source = 'NBN') OVER w AS m FROM pre WINDOW w AS (PARTITION BY species_slug, lon_k, lat_k, event_day))),
strict AS (SELECT *, (species_slug, occ_uid) IN (SELECT (species_slug, occ_uid) FROM pairs WHERE chosen) AS strict_drop FROM pairs),
review AS (SELECT * FROM strict WHERE {_KEYED} AND g > 0 AND m > 0 AND NOT (g = 1 AND m = 1)),
unc AS (SELECT *, {_dbl("coordinateUncertaintyInMeters")} AS u FROM allb),
flagged0 AS (SELECT *, lon IS NULL OR lat IS NULL AS f1, coalesce(lon IS NOT NULL AND lat IS NOT NULL AND NOT (lon BETWEEN -180 AND 180 AND lat BETWEEN -90 AND 90), FALSE) AS f2, event_day IS NULL AND year IS NULL AS f3,
  coalesce(event_day > DATE '2026-01-01' OR (event_day IS NULL AND year > 2026), FALSE) AS f4, coalesce(u > 10000, FALSE) AS f5, NOT licence_expected AS f6, coalesce(length(issues) > 0, FALSE) AS f7 FROM unc),
flagged AS (SELECT * EXCLUDE (f1, f2, f3, f4, f5, f6, f7), f1 AS qc_flag_missing_coords, f2 AS qc_flag_coords_out_of_range, f3 AS qc_flag_missing_date, f4 AS qc_flag_future_date, f5 AS qc_flag_uncertainty_high,
  f6 AS qc_flag_unexpected_licence, f7 AS qc_flag_has_issues, f1 OR f2 OR f3 OR f4 OR f5 OR f6 OR f7 AS qc_flag_any,
  CAST(f1 AS INT) + CAST(f2 AS INT) + CAST(f3 AS INT) + CAST(f4 AS INT) + CAST(f5 AS INT) + CAST(f6 AS INT) + CAST(f7 AS INT) AS qc_flag_count FROM flagged0),
t AS (SELECT *, upper(regexp_replace(basisOfRecord, '^[ \\t\\r\\n]+|[ \\t\\r\\n]+$', '', 'g')) AS basis, upper(trim(taxonRank)) AS rank_, lower(trim(certainty)) AS cert FROM flagged)
"""


def _project(source: str) -> str:
    q = f"(1 - {P.E2!r}) * (s / (1 - {P.E2!r} * s * s) - ln((1 - {P.E!r} * s) / (1 + {P.E!r} * s)) / (2 * {P.E!r}))"
    return f"""SELECT * EXCLUDE (s, b, t, r), {P.FALSE_EAST} + r * {P.D!r} * cos(b) * sin(t) AS x, {P.FALSE_NORTH} + (r / {P.D!r}) * ({P.COS_B0!r} * sin(b) - {P.SIN_B0!r} * cos(b) * cos(t)) AS y
    FROM (SELECT *, {P.RQ!r} * sqrt(2 / (1 + {P.SIN_B0!r} * sin(b) + {P.COS_B0!r} * cos(b) * cos(t))) AS r
    FROM (SELECT *, asin(greatest(least(({q}) / {P.QP!r}, 1.0), -1.0)) AS b, radians(lon) - {P.LON0!r} AS t FROM (SELECT *, sin(radians(lat)) AS s FROM {source})))"""


def _unproject(source: str) -> str:
    a, b, c = P.SERIES
    return f"""SELECT * EXCLUDE (u_, v_, r_, c_, b_), degrees({P.LON0!r} + atan2(u_ * sin(c_), r_ * {P.COS_B0!r} * cos(c_) - v_ * {P.SIN_B0!r} * sin(c_))) AS clon,
      degrees(b_ + {a!r} * sin(2 * b_) + {b!r} * sin(4 * b_) + {c!r} * sin(6 * b_)) AS clat
    FROM (SELECT *, asin(cos(c_) * {P.SIN_B0!r} + v_ * sin(c_) * {P.COS_B0!r} / r_) AS b_ FROM (SELECT *, 2 * asin(r_ / (2 * {P.RQ!r})) AS c_
    FROM (SELECT *, sqrt(u_ * u_ + v_ * v_) AS r_ FROM (SELECT *, (x_center - {P.FALSE_EAST}) / {P.D!r} AS u_, {P.D!r} * (y_center - {P.FALSE_NORTH}) AS v_ FROM {source}))))"""


_CROSS = "((y1 > {y}) <> (y2 > {y})) AND {x} < (x2 - x1) * ({y} - y1) / (y2 - y1) + x1"
_GRID = f"""{_CHAIN}, spot AS MATERIALIZED ({_project("(SELECT * FROM clean WHERE lon BETWEEN -180 AND 180 AND lat BETWEEN -90 AND 90)")}),
cellof AS (SELECT *, CAST(floor((x - {EXTENT.xmin}) / {CELL}) + 1 AS INT) AS col, CAST(floor((y - {EXTENT.ymin}) / {CELL}) + 1 AS INT) AS "row" FROM spot),
placed AS MATERIALIZED (SELECT *, coalesce(col BETWEEN 1 AND {EXTENT.ncol} AND "row" BETWEEN 1 AND {EXTENT.nrow}, FALSE) AS in_bounds FROM cellof),
counts AS MATERIALIZED (SELECT species_slug, "row", col, CAST(count(*) AS INT) AS n FROM placed WHERE in_bounds GROUP BY ALL),
cells AS (SELECT CAST(c AS INT) AS col, CAST(r AS INT) AS "row", CAST({EXTENT.xmin} + (c - 0.5) * {CELL} AS DOUBLE) AS x_center, CAST({EXTENT.ymin} + (r - 0.5) * {CELL} AS DOUBLE) AS y_center, printf('r%05d_c%05d', r, c) AS cell_id
  FROM range(1, {EXTENT.ncol + 1}) a(c), range(1, {EXTENT.nrow + 1}) b(r)),
centres AS MATERIALIZED ({_unproject("cells")}),
bands AS MATERIALIZED (SELECT *, unnest(range(CAST(floor(least(y1, y2)) AS INT), CAST(floor(greatest(y1, y2)) AS INT) + 1)) AS band FROM land WHERE y1 <> y2),
banded AS MATERIALIZED (SELECT cell_id, clon, clat, CAST(floor(clat) AS INT) AS band FROM centres),
inland AS MATERIALIZED (SELECT DISTINCT cell_id FROM (SELECT cell_id, poly_id, count(*) AS c FROM banded JOIN bands ON bands.band = banded.band WHERE {_CROSS.format(x="clon", y="clat")} GROUP BY cell_id, poly_id) WHERE c % 2 = 1),
masked AS MATERIALIZED (SELECT c.*, i.cell_id IS NOT NULL AS on_land FROM centres c LEFT JOIN inland i ON i.cell_id = c.cell_id),
presence AS MATERIALIZED (SELECT s.species_slug, m.*, coalesce(n.n, 0) AS n_points_in_cell, CAST(coalesce(n.n, 0) > 0 AS INT) AS presence FROM (SELECT DISTINCT species_slug FROM spot) s CROSS JOIN (SELECT * FROM masked WHERE on_land) m
  LEFT JOIN counts n ON n.species_slug = s.species_slug AND n."row" = m."row" AND n.col = m.col),
where_ AS MATERIALIZED (SELECT k, copy_no, source, lon, lat, CAST(floor(lat) AS INT) AS band FROM clean WHERE lon IS NOT NULL AND lat IS NOT NULL),
insea AS MATERIALIZED (SELECT k, copy_no, source, poly_id FROM (SELECT k, copy_no, source, poly_id, count(*) AS c FROM where_ JOIN bands ON bands.band = where_.band WHERE {_CROSS.format(x="lon", y="lat")} GROUP BY k, copy_no, source, poly_id) WHERE c % 2 = 1)
"""


def _query(sql: str | None = None, chain: str = _CHAIN, name: str | None = None):
    """Registers a query under its function's name, and its SQL after the chain."""

    def add(f):
        QUERIES[name or f.__name__] = f
        if sql is not None:
            ORACLE[name or f.__name__] = chain + sql
        return f

    return add


# --- shared steps ----------------------------------------------------------------------------------------------------


def _clean(spark, sf) -> DataFrame:
    return stages.normalise_stage(occ_raw(spark, sf))


def _within(spark, sf) -> DataFrame:
    return normalise.dedup_within_source(normalise.screen_coords(_clean(spark, sf)), stages.order())


def _pre(spark, sf) -> DataFrame:
    """Merged records with what the queries below read of them."""
    return stages.premerge(_clean(spark, sf), carry=["licence"])


def _all(spark, sf) -> DataFrame:
    return stages.basics(_clean(spark, sf))


def _flagged(spark, sf) -> DataFrame:
    return qc.qc_flags(_all(spark, sf), F.lit(AS_OF))


def _points(spark, sf) -> DataFrame:
    return _clean(spark, sf).where("lon between -180 and 180 and lat between -90 and 90")


def _pages(spark, sf) -> list[DataFrame]:
    """Result pages of which two lack a column."""
    raw = occ_raw(spark, sf).select("source", "k", "copy_no", "eventDate", "countryCode", "taxonRank")
    missing = {1: "countryCode", 2: "taxonRank"}
    return [raw.where(f"k % 4 = {i}").drop(*([missing[i]] if i in missing else [])) for i in range(4)]


def _asked_slugs(spark) -> DataFrame:
    return spark.createDataFrame([("alpha_minor",), ("beta_major",), ("no_such_species",)], "slug string")


_ID = "source, k, copy_no"
_IDS = ["source", "k", "copy_no"]

# --- stage 00 --------------------------------------------------------------------------------------------------------

_CLEAN_COLS = ["source", "species", "species_slug", "source_record_id", "lon", "lat", "date_raw", "country", "licence_raw", "licence", "licence_expected", "coordinateUncertaintyInMeters", "issues", "basisOfRecord", "taxonRank", *(c for c in MORE if c not in ("dateIdentified", "coordinatePrecision")), "k", "copy_no"]


@_query(f"SELECT {', '.join(_CLEAN_COLS)}, source_record_id AS gbifID, occurrenceID, dateIdentified FROM clean WHERE source = 'GBIF'")
def normalise_gbif(spark, sf):
    return normalise.normalise(gbif_raw(spark, sf), "GBIF").select(*_CLEAN_COLS, "gbifID", "occurrenceID", "dateIdentified")


@_query(f"SELECT {', '.join(_CLEAN_COLS)}, source_record_id AS recordID, certainty, coordinatePrecision FROM clean WHERE source = 'NBN'")
def normalise_nbn(spark, sf):
    return normalise.normalise(nbn_raw(spark, sf).withColumnRenamed("license", "dcterms:license"), "NBN").select(*_CLEAN_COLS, "recordID", "certainty", "coordinatePrecision")


@_query("SELECT source, k, copy_no, CASE WHEN source = 'GBIF' THEN occurrenceID ELSE source_record_id END AS source_record_id FROM clean")
def source_record_id(spark, sf):
    """GBIF records without a gbifID column are named by occurrenceID."""
    both = [normalise.normalise(gbif_raw(spark, sf).drop("gbifID"), "GBIF"), normalise.normalise(nbn_raw(spark, sf), "NBN")]
    return merge.union_sources(both).select(*_IDS, "source_record_id")


@_query("SELECT source, k, copy_no, lon, coordinateUncertaintyInMeters, year_raw, licence, coalesce(licence = 'CC0_1_0', FALSE) AS licence_expected FROM clean WHERE source = 'GBIF'")
def refresh_expected(spark, sf):
    kept = normalise.normalise(gbif_raw(spark, sf), "GBIF").withColumns({c: F.col(c).cast("string") for c in ("lon", "coordinateUncertaintyInMeters", "year_raw")})
    return normalise.refresh_expected(kept, "GBIF", ("CC0_1_0",)).select(*_IDS, "lon", "coordinateUncertaintyInMeters", "year_raw", "licence", "licence_expected")


@_query("SELECT source, k, copy_no, year FROM raw WHERE CAST(trunc(TRY_CAST(year AS DOUBLE)) AS INT) = 1995")
def requested_year_filter(spark, sf):
    return normalise.requested_year(occ_raw(spark, sf), 1995).select(*_IDS, "year")


@_query("SELECT DISTINCT license AS raw, licence FROM (SELECT licence_raw AS license, licence FROM clean WHERE source = 'GBIF')")
def licence_code_gbif(spark, sf):
    return _clean(spark, sf).where("source = 'GBIF'").select(F.col("licence_raw").alias("raw"), "licence").distinct()


@_query("SELECT DISTINCT licence_raw AS raw, licence FROM clean WHERE source = 'NBN'")
def licence_code_nbn(spark, sf):
    return _clean(spark, sf).where("source = 'NBN'").select(F.col("licence_raw").alias("raw"), "licence").distinct()


@_query("SELECT source, licence, licence_expected, count(*) AS n FROM clean GROUP BY ALL")
def licence_expected(spark, sf):
    return _clean(spark, sf).groupBy("source", "licence", "licence_expected").agg(F.count("*").alias("n"))


@_query(f"SELECT {_ID}, lon, lat FROM screened")
def screen_coords(spark, sf):
    return normalise.screen_coords(_clean(spark, sf)).select(*_IDS, "lon", "lat")


@_query(f"SELECT {_ID}, licence FROM clean WHERE licence IN ('OGL', 'CC0', 'CC0_1_0')")
def screen_licence(spark, sf):
    return normalise.screen_licence(_clean(spark, sf), ["OGL", "CC0", "CC0_1_0"]).select(*_IDS, "licence")


@_query(f"SELECT {_ID}, {_dbl('decimalLongitude')} AS lon, {_dbl('decimalLatitude')} AS lat FROM raw")
def scan_coords(spark, sf):
    df = normalise.scan_coords(occ_raw(spark, sf).drop("x", "y"))
    return df.select(*_IDS, S.safe_double(F.col("lon")).alias("lon"), S.safe_double(F.col("lat")).alias("lat"))


@_query(f"SELECT {_ID}, source_record_id FROM byid")
def dedup_by_id(spark, sf):
    return normalise.dedup_by_id(normalise.screen_coords(_clean(spark, sf)), stages.order()).select(*_IDS, "source_record_id")


@_query(f"SELECT {_ID}, lon, lat, date_raw FROM within")
def dedup_within_source(spark, sf):
    return _within(spark, sf).select(*_IDS, "lon", "lat", "date_raw")


_TAXA = "SELECT DISTINCT species AS scientific_name, 'species' AS rank FROM raw UNION ALL SELECT DISTINCT upper(species), 'SPECIES' FROM raw UNION ALL SELECT DISTINCT species, 'genus' FROM raw"


@_query(f"SELECT scientific_name, rank FROM ({_TAXA}) WHERE lower(rank) = 'species' AND lower(scientific_name) IN ('alpha minor', 'zeta fulva')")
def exact_species_match(spark, sf):
    taxa = spark.sql(_TAXA.replace("raw", "{raw}"), raw=occ_raw(spark, sf))
    return normalise.exact_species_match(taxa, spark.createDataFrame([("Alpha Minor",), ("ZETA fulva",)], "name string"))


@_query("""SELECT c.record_id AS recordID, c.eventDate, q.coordinateUncertaintyInMeters FROM (SELECT * FROM raw WHERE source = 'NBN') c
  LEFT JOIN (SELECT DISTINCT record_id, coordinateUncertaintyInMeters FROM raw WHERE source = 'NBN' AND k % 3 <> 0) q ON q.record_id = c.record_id""")
def enrich_left_join(spark, sf):
    nbn = occ_raw(spark, sf).where("source = 'NBN'").withColumnRenamed("record_id", "recordID")
    half = nbn.where("k % 3 <> 0").select("recordID", "coordinateUncertaintyInMeters")
    return normalise.enrich_left_join(nbn.select("recordID", "eventDate"), half.union(nbn.where("k % 3 <> 0 and k % 15 = 1").select("recordID", "coordinateUncertaintyInMeters")))


@_query("SELECT source, licence, count(*) AS n, count(*) / (SELECT count(*) FROM clean) AS share FROM clean GROUP BY source, licence")
def licence_breakdown(spark, sf):
    return report.value_counts(_clean(spark, sf), "source", "licence")


@_query("""SELECT c.source, c.species_slug, licence_raw, licence, count(*) AS n, count(*) / any_value(t.n) AS prop_of_records FROM clean c
  JOIN (SELECT source, species_slug, count(*) AS n FROM clean GROUP BY ALL) t ON t.source = c.source AND t.species_slug = c.species_slug WHERE NOT licence_expected GROUP BY ALL""")
def unexpected_licences(spark, sf):
    return report.unexpected_licences(_clean(spark, sf))


@_query("SELECT source, count(*) AS n_raw, count(*) FILTER (licence_expected) AS n_accepted, avg(CAST(licence_expected AS INT)) AS proportion FROM clean GROUP BY source")
def licence_accept_share(spark, sf):
    return report.accept_share(_clean(spark, sf))


@_query("SELECT licence, count(*) AS n FROM clean WHERE licence IS NOT NULL AND licence NOT IN ('OGL', 'CC0') GROUP BY licence")
def licence_non_accepted(spark, sf):
    return report.non_accepted(_clean(spark, sf), ["OGL", "CC0"])


@_query("SELECT country, count(*) AS n FROM clean GROUP BY country ORDER BY n DESC, country NULLS LAST LIMIT 10")
def top_countries(spark, sf):
    return report.top(_clean(spark, sf), 10, "country")


@_query("""SELECT source, count(*) AS n_raw, count(*) FILTER (lon IS NOT NULL AND lat IS NOT NULL) AS n_screened, any_value(b.n) AS n_by_id, any_value(w.n) AS n_deduped FROM clean
  JOIN (SELECT source AS s, count(*) AS n FROM byid GROUP BY source) b ON b.s = source JOIN (SELECT source AS s, count(*) AS n FROM within GROUP BY source) w ON w.s = source GROUP BY source""")
def screening_funnel(spark, sf):
    """Counted on the way of one write."""
    return stages.screened(_clean(spark, sf))[1]


@_query("""SELECT source, count(*) AS n_raw, count(*) FILTER (lon IS NOT NULL AND lat IS NOT NULL) AS n_screened, any_value(b.n) AS n_by_id, any_value(w.n) AS n_deduped FROM clean
  JOIN (SELECT source AS s, count(*) AS n FROM byid GROUP BY source) b ON b.s = source JOIN (SELECT source AS s, count(*) AS n FROM within GROUP BY source) w ON w.s = source GROUP BY source""")
def screening_funnel_recounted(spark, sf):
    """By an aggregate for each step."""
    raw = _clean(spark, sf)
    screened = normalise.screen_coords(raw)
    return report.screening_funnel(raw, screened, normalise.dedup_by_id(screened, stages.order()), normalise.dedup_within_source(screened, stages.order()))


@_query("SELECT source, k, copy_no, eventDate, CASE WHEN k % 4 = 1 THEN NULL ELSE countryCode END AS countryCode, CASE WHEN k % 4 = 2 THEN NULL ELSE taxonRank END AS taxonRank FROM raw")
def ingest_pages(spark, sf):
    return files.ingest_pages(_pages(spark, sf))


@_query("SELECT least(count(*), 100000) AS n FROM raw")
def ingest_safety_cap(spark, sf):
    return files.ingest_pages(_pages(spark, sf), 100_000).agg(F.count("*").alias("n"))


@_query("SELECT source, k, copy_no, species_slug FROM clean WHERE country = 'GB' AND lon IS NOT NULL")
def region_filter(spark, sf):
    return _clean(spark, sf).where((F.col("country") == "GB") & F.col("lon").isNotNull()).select(*_IDS, "species_slug")


@_query("SELECT s.slug FROM (SELECT unnest(['alpha_minor', 'beta_major', 'no_such_species']) AS slug) s WHERE slug IN (SELECT species_slug FROM clean)")
def species_with_input(spark, sf):
    return normalise.split_by_input(_asked_slugs(spark), _clean(spark, sf))[0]


@_query("SELECT s.slug FROM (SELECT unnest(['alpha_minor', 'beta_major', 'no_such_species']) AS slug) s WHERE slug NOT IN (SELECT species_slug FROM clean)")
def species_skipped(spark, sf):
    return normalise.split_by_input(_asked_slugs(spark), _clean(spark, sf))[1]


@_query("SELECT 1 AS page, 'countryCode' AS missing, count(*) AS n FROM raw WHERE k % 4 = 1 UNION ALL SELECT 2, 'taxonRank', count(*) FROM raw WHERE k % 4 = 2 UNION ALL SELECT page, 'verbatimLocality', n FROM (SELECT CAST(k % 4 AS INT) AS page, count(*) AS n FROM raw GROUP BY 1)")
def schema_contract(spark, sf):
    """The records to be fetched again, by page and by the required column that the page lacks."""
    required = ["source", "k", "countryCode", "taxonRank", "verbatimLocality"]
    lacks = [stages.missing_columns(p, required).withColumn("page", F.lit(i)).crossJoin(p.agg(F.count("*").alias("n"))) for i, p in enumerate(_pages(spark, sf))]
    return merge.union_sources(lacks).select("page", "missing", "n")


# --- scalars ---------------------------------------------------------------------------------------------------------


@_query("SELECT DISTINCT species, species_slug FROM clean")
def slugify(spark, sf):
    return occ_raw(spark, sf).select("species", S.slugify(F.col("species")).alias("species_slug")).distinct()


@_query(f"SELECT DISTINCT eventDate, {_day('eventDate')} AS day FROM raw")
def parse_day(spark, sf):
    return occ_raw(spark, sf).select("eventDate", S.parse_day(F.col("eventDate")).alias("day")).distinct()


@_query("SELECT DISTINCT eventDate, TRY_CAST(CASE WHEN length(substr(eventDate, 1, 10)) = 10 THEN substr(eventDate, 1, 10) END AS DATE) AS day FROM raw")
def parse_day_lenient(spark, sf):
    return occ_raw(spark, sf).select("eventDate", S.parse_day_lenient(F.col("eventDate")).alias("day")).distinct()


@_query(f"SELECT DISTINCT decimalLongitude AS raw, {_dbl('decimalLongitude')} AS num, CAST(trunc({_dbl('year')}) AS INT) AS year FROM raw")
def safe_numeric(spark, sf):
    return occ_raw(spark, sf).select(F.col("decimalLongitude").alias("raw"), S.safe_double(F.col("decimalLongitude")).alias("num"), S.safe_int(F.col("year")).alias("year")).distinct()


@_query("SELECT word, CASE WHEN lower(trim(word)) IN ('true', 't', '1', 'yes', 'y') THEN TRUE WHEN lower(trim(word)) IN ('false', 'f', '0', 'no', 'n') THEN FALSE END AS flag, n FROM (SELECT o_orderstatus AS word, count(*) AS n FROM orders GROUP BY 1)")
def parse_boolish(spark, sf):
    return spark.read.parquet(f"{sf}/orders.parquet").groupBy(F.col("o_orderstatus").alias("word")).agg(F.count("*").alias("n")).select("word", S.parse_boolish(F.col("word")).alias("flag"), "n")


@_query("""SELECT DISTINCT deg, CASE WHEN deg < 0 THEN concat(abs(deg), '°W') WHEN deg > 0 THEN concat(deg, '°E') ELSE '0°' END AS label FROM (SELECT CAST(trunc(lon) AS INT) AS deg FROM screened)""")
def degree_label(spark, sf):
    deg = normalise.screen_coords(_clean(spark, sf)).select(S.safe_int(F.col("lon").cast("string")).alias("deg"))
    return deg.select("deg", S.degree_label(F.col("deg"), "E", "W").alias("label")).distinct()


@_query("SELECT date_precision, count(*) AS n FROM allb GROUP BY date_precision")
def date_precision(spark, sf):
    return _all(spark, sf).groupBy("date_precision").agg(F.count("*").alias("n"))


# --- stage 01 --------------------------------------------------------------------------------------------------------

_BASIC = ["occ_uid", "date_is_range", "event_day", "year", "date_precision", "lon_r", "lat_r"]


@_query(f"SELECT {_ID}, species_slug, {', '.join(_BASIC)} FROM allb")
def add_basics(spark, sf):
    return _all(spark, sf).select(*_IDS, "species_slug", *_BASIC)


@_query(f"SELECT {_ID}, species_slug, species AS species_input, {', '.join(_BASIC)} FROM allb")
def add_basics_other_names(spark, sf):
    """Records whose coordinates, dates and years go by the names that they have before they are cleaned."""
    df = _clean(spark, sf).withColumnsRenamed({"lon": "decimalLongitude", "lat": "decimalLatitude", "date_raw": "eventDate", "year_raw": "year"})
    df = df.withColumns({c: F.col(c).cast("string") for c in ("decimalLongitude", "decimalLatitude")})
    return merge.add_basics(df, stages.order(), bucket=stages.bucket()).select(*_IDS, "species_slug", "species_input", *_BASIC)


@_query(f"SELECT {_ID}, species_slug, lon_k, lat_k, event_day FROM pre WHERE {_KEYED}")
def key_day(spark, sf):
    df = _pre(spark, sf)
    return df.where(merge.keyed_by_day(df)).select(*_IDS, *merge.KEY)


@_query(f"SELECT {_ID}, species_slug, lon_k, lat_k, year FROM pre WHERE year IS NOT NULL AND lon_k IS NOT NULL AND lat_k IS NOT NULL")
def key_year(spark, sf):
    return _pre(spark, sf).where("year is not null and lon_k is not null and lat_k is not null").select(*_IDS, "species_slug", "lon_k", "lat_k", "year")


_PLACE = "concat(species, '|', printf('%.4f', lon_r), '|', printf('%.4f', lat_r), '|'"


@_query(f"SELECT {_ID}, CASE WHEN event_day IS NOT NULL THEN {_PLACE}, CAST(event_day AS STRING)) END AS key_day, CASE WHEN year IS NOT NULL THEN {_PLACE}, CAST(year AS STRING)) END AS key_year FROM pre")
def key_texts(spark, sf):
    return merge.key_texts(_pre(spark, sf)).select(*_IDS, "key_day", "key_year")


@_query("SELECT source, species_slug, lon, lat, date_raw, CASE WHEN source = 'NBN' THEN 'GB' ELSE country END AS country, CASE WHEN source = 'GBIF' THEN source_record_id END AS occurrenceID FROM within")
def harmonise_union(spark, sf):
    df = _within(spark, sf)
    cols = ["source", "species_slug", "lon", "lat", "date_raw"]
    gbif = df.where("source = 'GBIF'").select(*cols, "country", F.col("source_record_id").alias("occurrenceID"))
    return merge.union_sources([gbif, df.where("source = 'NBN'").select(*cols, F.lit("GB").alias("country"))])


@_query("SELECT source, count(*) AS n, count(certainty) AS n_certainty, count(basisOfRecord) AS n_basis FROM clean GROUP BY source")
def union_sources(spark, sf):
    both = merge.union_sources([normalise.normalise(gbif_raw(spark, sf), "GBIF").drop("certainty"), normalise.normalise(nbn_raw(spark, sf), "NBN").drop("basisOfRecord")])
    return both.groupBy("source").agg(F.count("*").alias("n"), F.count("certainty").alias("n_certainty"), F.count("basisOfRecord").alias("n_basis"))


@_query("SELECT DISTINCT species_slug, occ_uid FROM pre")
def distinct_uids(spark, sf):
    return _pre(spark, sf).select("species_slug", "occ_uid").distinct()


@_query(f"SELECT species_slug, lon_k, lat_k, event_day, count(*) AS n, count(*) FILTER (source = 'GBIF') AS n_gbif, count(*) FILTER (source = 'NBN') AS n_nbn FROM pre WHERE {_KEYED} GROUP BY ALL")
def dup_group_counts(spark, sf):
    return merge.dup_group_counts(_pre(spark, sf))


@_query(f"SELECT {_ID}, species_slug, occ_uid FROM strict WHERE NOT strict_drop")
def dedup_cross_source(spark, sf):
    return merge.dedup_cross_source(_pre(spark, sf)).select(*_IDS, "species_slug", "occ_uid")


@_query(f"SELECT {_ID}, species_slug, occ_uid, 'strict_cross_source' AS reason FROM strict WHERE strict_drop")
def dropped_strict(spark, sf):
    return merge.flag_strict(_pre(spark, sf)).where("strict_drop").select(*_IDS, "species_slug", "occ_uid", F.lit("strict_cross_source").alias("reason"))


_LOOSE = f"""loose AS (SELECT *, lon_k IS NOT NULL AND lat_k IS NOT NULL AND year IS NOT NULL AND g2 > 0 AND m2 > 0 AND v2 > 0 AS ll, {_KEYED} AND n = 2 AND g = 1 AND m = 1 AS ss, {_KEYED} AND g > 0 AND m > 0 AS bb FROM (
  SELECT *, count(*) FILTER (source = 'GBIF') OVER w AS g2, count(*) FILTER (source = 'NBN') OVER w AS m2, count(*) FILTER (date_precision <> 'day') OVER w AS v2 FROM strict WINDOW w AS (PARTITION BY species_slug, lon_k, lat_k, year)))"""


@_query(f", {_LOOSE} SELECT {_ID}, coalesce(ss, FALSE) AS flag_strict_key, coalesce(bb, FALSE) AS flag_both_sources, coalesce(ll, FALSE) AS flag_loose_year FROM loose")
def cross_dup_flags(spark, sf):
    return merge.cross_dup_flags(_pre(spark, sf)).select(*_IDS, "flag_strict_key", "flag_both_sources", "flag_loose_year")


@_query(f", {_LOOSE} SELECT count(*) AS n_total, count(*) FILTER (ss) AS n_day, count(*) FILTER (ll) AS n_loose, avg(CAST(coalesce(ss, FALSE) AS INT)) AS prop_day, avg(CAST(coalesce(ll, FALSE) AS INT)) AS prop_loose FROM loose")
def cross_dup_totals(spark, sf):
    return report.cross_dup_totals(merge.cross_dup_flags(_pre(spark, sf)))


@_query(f"SELECT {_ID}, species_slug, occ_uid FROM review")
def crossdup_review(spark, sf):
    return merge.crossdup_review(_pre(spark, sf)).select(*_IDS, "species_slug", "occ_uid")


@_query(f"SELECT {_ID}, occ_uid FROM (SELECT *, dense_rank() OVER (ORDER BY species_slug, lon_k, lat_k, event_day) AS d FROM review) WHERE d <= 3")
def crossdup_examples(spark, sf):
    return report.crossdup_examples(_pre(spark, sf)).select(*_IDS, "occ_uid")


@_query("SELECT count(DISTINCT (species_slug, lon_k, lat_k, event_day)) AS n_keys, count(*) AS n_rows FROM review")
def ambiguous_counts(spark, sf):
    return report.ambiguous_counts(_pre(spark, sf))


@_query(f"SELECT n AS group_size, count(*) AS n_groups FROM (SELECT DISTINCT species_slug, lon_k, lat_k, event_day, n FROM strict WHERE {_KEYED} AND g > 0 AND m > 0) GROUP BY n")
def dup_group_sizes(spark, sf):
    return report.dup_group_sizes(_pre(spark, sf))


@_query("SELECT source, count(*) FILTER (date_precision = 'day') AS n_day, count(*) FILTER (date_precision = 'year') AS n_year, count(*) FILTER (date_precision = 'unknown') AS n_unknown FROM pre GROUP BY source")
def date_precision_counts(spark, sf):
    return report.precision_counts(_pre(spark, sf))


@_query("""SELECT CAST(grouping(source, date_precision, licence, year) AS INT) AS "grouping", source, date_precision, licence, year, count(*) AS n FROM strict WHERE strict_drop
  GROUP BY GROUPING SETS ((source, date_precision), (licence), (year))""")
def dropped_profile(spark, sf):
    return report.dropped_profile(merge.flag_strict(_pre(spark, sf)).where("strict_drop"))


_PREC = ", ".join(f"count(*) FILTER (source = '{s}' AND date_precision = '{p}') AS n_{p}_{s.lower()}" for s in ("GBIF", "NBN") for p in ("day", "year", "unknown"))


_N = ["n_gbif", "n_nbn", "n_premerge", "n_strict_keys", "n_dropped_strict", "n_final", *(f"n_{p}_{s}" for s in ("gbif", "nbn") for p in ("day", "year", "unknown"))]
_LOG1 = f"""lgm AS (SELECT s.species_slug, count(*) FILTER (source = 'GBIF') AS n_gbif, count(*) FILTER (source = 'NBN') AS n_nbn, count(*) AS n_premerge, coalesce(any_value(q.c), 0) AS n_strict_keys, count(*) FILTER (strict_drop) AS n_dropped_strict,
  count(*) FILTER (NOT strict_drop) AS n_final, {_PREC} FROM strict s LEFT JOIN (SELECT species_slug, count(*) AS c FROM pairs WHERE chosen GROUP BY 1) q ON q.species_slug = s.species_slug GROUP BY s.species_slug)"""


@_query(f""", {_LOG1} SELECT a.species, a.slug, '' AS group_dir, CAST(NULL AS STRING) AS gbif_file, CAST(NULL AS STRING) AS nbn_file, coalesce(n_gbif > 0, FALSE) AS gbif_exists, coalesce(n_nbn > 0, FALSE) AS nbn_exists, {', '.join(_N)},
  CASE WHEN n_premerge > 0 THEN concat('/out/species_slug=', a.slug) END AS out_file, CASE WHEN n_gbif > 0 AND n_nbn > 0 THEN 'ok_both_sources' WHEN n_gbif > 0 THEN 'ok_gbif_only' WHEN n_nbn > 0 THEN 'ok_nbn_only' ELSE 'no_inputs' END AS status,
  CASE WHEN n_premerge > 0 THEN '' ELSE 'Neither GBIF nor NBN input found.' END AS note
  FROM (SELECT DISTINCT trim(species) AS species, species_slug AS slug FROM clean UNION ALL SELECT 'Absent rara', 'absent_rara') a LEFT JOIN lgm ON lgm.species_slug = a.slug""")
def runlog_merged(spark, sf):
    names = occ_raw(spark, sf).select(F.trim("species").alias("species")).distinct().union(spark.createDataFrame([("Absent rara",)], "species string"))
    return stages.merge_stage(_clean(spark, sf), carry=[], asked=stages.asked_species(names), out_root="/out")[1]




@_query(f", {_LOG1} SELECT species_slug AS slug, CASE WHEN species_slug IN ('alpha_minor', 'zeta_fulva') THEN 'ok_both_sources' ELSE 'skipped_cached' END AS status, CASE WHEN species_slug IN ('alpha_minor', 'zeta_fulva') THEN n_final END AS n_final FROM lgm")
def merge_into(spark, sf):
    """All species but one are merged; then one has newer input and one has no output yet: the others are kept."""
    root, clean = files.work_dir(spark, "merge"), _clean(spark, sf)
    files.sink_stage(clean, f"{root}/in")
    times = files.modified_by_species(spark, f"{root}/in")
    stages.merge_into(files.scan_stage(spark, f"{root}/in"), times.where("slug <> 'zeta_fulva'"), f"{root}/out")
    files.sink_stage(clean.where("species_slug = 'alpha_minor'"), f"{root}/in")
    log = stages.merge_into(files.scan_stage(spark, f"{root}/in"), files.modified_by_species(spark, f"{root}/in"), f"{root}/out")
    return log.select("slug", "status", "n_final")


@_query(f", {_LOG1} SELECT species_slug AS slug, CASE WHEN species_slug = 'gamma_x_rubra' THEN 'error' ELSE 'ok_both_sources' END AS status, CASE WHEN species_slug <> 'gamma_x_rubra' THEN n_final END AS n_final FROM lgm")
def merge_into_isolated(spark, sf):
    """One species' longitudes can't be computed: it is found by halves and logged, the others are merged and published."""
    root = files.work_dir(spark, "isolated")
    files.sink_stage(_clean(spark, sf).select(*stages.MERGED, *stages.ORDER), f"{root}/in")  # made once, not for every part of the species
    clean = files.scan_stage(spark, f"{root}/in")
    poison = F.when(F.col("species_slug") == "gamma_x_rubra", F.raise_error(F.lit("unreadable")).cast("double")).otherwise(F.col("lon"))
    inputs = clean.select(F.col("species_slug").alias("slug")).distinct().withColumn("modified", F.lit(0).cast("timestamp"))
    log = stages.merge_into(clean.withColumn("lon", poison), inputs, f"{root}/out", continue_on_error=True)
    kept = files.scan_stage(spark, f"{root}/out").groupBy(F.col("species_slug").alias("slug")).agg(F.count("*").alias("n_final"))
    return log.select("slug", "status").join(kept, "slug", "left")


def _fig(section: str, rows: str, item: str, *values: str) -> str:
    return " UNION ALL ".join(f"SELECT '{section}' AS section, concat({item}, '{v}') AS item, CAST({v} AS DOUBLE) AS value FROM ({rows})" for v in values)


def _item(*columns: str) -> str:
    return ", ".join(f"coalesce(CAST({c} AS STRING), '-'), ' '" for c in columns)


_REVIEW = " UNION ALL ".join([
    _fig("rows", "SELECT source, count(*) AS n FROM pre GROUP BY 1", _item("source"), "n"),
    _fig("totals", "SELECT count(*) AS n_merged, count(*) FILTER (strict_drop) AS n_dropped, count(*) FILTER (NOT strict_drop) AS n_remaining FROM strict", "''", "n_merged", "n_dropped", "n_remaining"),
    _fig("precision", "SELECT source, date_precision, count(*) AS n FROM pre GROUP BY ALL", _item("source", "date_precision"), "n"),
    _fig("flags", "SELECT count(*) FILTER (bb) AS n_day, count(*) FILTER (ll) AS n_loose FROM loose", "''", "n_day", "n_loose"),
    _fig("dropped by precision", "SELECT source, date_precision, count(*) AS n FROM strict WHERE strict_drop GROUP BY ALL", _item("source", "date_precision"), "n"),
    _fig("dropped by licence", "SELECT licence, count(*) AS n FROM strict WHERE strict_drop GROUP BY ALL", _item("licence"), "n"),
    _fig("dropped by year", "SELECT year, count(*) AS n FROM strict WHERE strict_drop GROUP BY ALL ORDER BY n DESC, year NULLS LAST LIMIT 15", _item("year"), "n"),
    _fig("groups", f"SELECT n AS group_size, count(*) AS n_groups FROM (SELECT DISTINCT species_slug, lon_k, lat_k, event_day, n FROM strict WHERE {_KEYED} AND g > 0 AND m > 0) GROUP BY n", _item("group_size"), "n_groups"),
    _fig("review", "SELECT count(DISTINCT (species_slug, lon_k, lat_k, event_day)) AS n_keys, count(*) AS n_rows FROM review", "''", "n_keys", "n_rows"),
])


@_query(f", {_LOOSE} {_REVIEW}")
def crossdup_report(spark, sf):
    return report.crossdup_report(_pre(spark, sf))


# --- stage 02 --------------------------------------------------------------------------------------------------------

_FLAG_COLS = [f"qc_flag_{k}" for k in [*qc.FLAGS, "any", "count"]]


@_query(f"SELECT {_ID}, {', '.join(_FLAG_COLS)} FROM flagged")
def qc_flags(spark, sf):
    return _flagged(spark, sf).select(*_IDS, *_FLAG_COLS)


@_query("SELECT species_slug, count(*) AS n_in, " + ", ".join(f"count(*) FILTER (qc_flag_{k}) AS n_flag_{k}" for k in ["any", *qc.FLAGS]) + " FROM flagged GROUP BY species_slug")
def runlog_qc(spark, sf):
    return stages.qc_stage(_all(spark, sf), F.lit(AS_OF))[1]


# --- stage 03 --------------------------------------------------------------------------------------------------------

_STRUCT = [("missing_coords", "qc_flag_missing_coords"), ("coords_out_of_range", "qc_flag_coords_out_of_range"), ("future_date", "qc_flag_future_date")]
_SITU = "source = 'GBIF' AND NOT coalesce(basis IN ('HUMAN_OBSERVATION', 'OBSERVATION', 'MACHINE_OBSERVATION'), FALSE)"
_MIN = "CASE WHEN event_day IS NOT NULL THEN event_day < DATE '2000-01-01' WHEN year IS NOT NULL THEN year < 2000 ELSE FALSE END"
_BASE_RULES = [("source_not_in_keep_sources", "NOT coalesce(source IN ('GBIF', 'NBN'), FALSE)"), *_STRUCT, ("before_min_date", _MIN), ("uncertainty_over_threshold", "u > 1000"), ("extra__in_situ_only", _SITU)]
_BARE = dict(drop_missing_coords=False, drop_out_of_range=False, drop_future=False)
#: name: (policy, its rules in SQL over t)
POLICIES: dict[str, tuple[Policy, list[tuple[str, str]]]] = {
    "policy_baseline": (BASELINE, _BASE_RULES),
    "policy_keep_sources": (Policy("p", keep_sources=("GBIF",), **_BARE), [("source_not_in_keep_sources", "source <> 'GBIF'")]),
    "policy_structural": (Policy("p"), _STRUCT),
    "policy_missing_date": (Policy("p", drop_missing_date=True), [*_STRUCT, ("missing_date", "qc_flag_missing_date")]),
    "policy_require_day": (Policy("p", require_event_day=True, **_BARE), [("no_event_day_required", "event_day IS NULL")]),
    "policy_date_window": (
        Policy("p", min_date=date(1996, 6, 1), max_date=date(1999, 5, 31), min_year=1997, allow_year_only=False, **_BARE),
        [("before_min_date", "CASE WHEN event_day IS NOT NULL THEN event_day < DATE '1996-06-01' WHEN year IS NOT NULL THEN year < 1997 ELSE TRUE END"),
         ("after_max_date", "CASE WHEN event_day IS NOT NULL THEN event_day > DATE '1999-05-31' WHEN year IS NOT NULL THEN year > 1999 ELSE TRUE END")],
    ),
    "policy_uncertainty_keep": (Policy("p", max_uncertainty_m=1000, **_BARE), [("uncertainty_over_threshold", "u > 1000")]),
    "policy_uncertainty_drop": (Policy("p", max_uncertainty_m=1000, keep_missing_uncertainty=False, **_BARE), [("uncertainty_missing_or_over_threshold", "u IS NULL OR u > 1000")]),
    "policy_licence": (Policy("p", drop_unexpected_licence=True, **_BARE), [("unexpected_licence", "NOT licence_expected")]),
    "policy_basis_allow": (Policy("p", basis_allow=("HUMAN_OBSERVATION", "OBSERVATION"), **_BARE), [("basis_not_allowed", "NOT coalesce(basis IN ('HUMAN_OBSERVATION', 'OBSERVATION'), FALSE)")]),
    "policy_basis_deny": (Policy("p", basis_deny=("FOSSIL_SPECIMEN", "PRESERVED_SPECIMEN"), **_BARE), [("basis_in_blacklist", "basis IN ('FOSSIL_SPECIMEN', 'PRESERVED_SPECIMEN')")]),
    "policy_taxon_rank": (Policy("p", rank_allow=("SPECIES", "SUBSPECIES"), **_BARE), [("taxon_rank_not_allowed", "NOT coalesce(rank_ IN ('SPECIES', 'SUBSPECIES'), FALSE)")]),
    "policy_certainty": (Policy("p", certainty_column="certainty", certainty_allow=("definite", "probable"), **_BARE), [("nbn_certainty_not_allowed", "source = 'NBN' AND NOT coalesce(cert IN ('definite', 'probable'), FALSE)")]),
    "policy_issues_any": (Policy("p", gbif_drop_any_issues=True, **_BARE), [("gbif_any_issues", "source = 'GBIF' AND length(trim(issues)) > 0")]),
    "policy_issues_blacklist": (Policy("p", gbif_issue_blacklist=("ZERO_COORDINATE", "RECORDED_DATE_INVALID"), **_BARE), [("gbif_blacklisted_issues", "source = 'GBIF' AND list_has_any(string_split(regexp_replace(issues, '\\s+', '', 'g'), ';'), ['ZERO_COORDINATE', 'RECORDED_DATE_INVALID'])")]),
    "policy_extra_rule": (Policy("p", extra={"even": lambda df: F.col("k") % 2 == 0, "nothing": None}, **_BARE), [("extra__even", "k % 2 = 0")]),
}


def _reason(found: list[tuple[str, str]]) -> str:
    return "CASE " + " ".join(f"WHEN coalesce({p}, FALSE) THEN '{n}'" for n, p in found) + " END"


def _judged(name: str):
    return lambda spark, sf: policy.with_drop_reason(_flagged(spark, sf), POLICIES[name][0], F.lit(AS_OF)).select(*_IDS, "drop_reason")


for _name, (_, _found) in POLICIES.items():
    _query(f"SELECT {_ID}, {_reason(_found)} AS drop_reason FROM t", name=_name)(_judged(_name))


@_query(f"SELECT {_ID} FROM t WHERE {_reason(_BASE_RULES)} IS NULL")
def policy_filter(spark, sf):
    return policy.policy_filter(_flagged(spark, sf), BASELINE, F.lit(AS_OF)).select(*_IDS)


_ALL_RULES = [*RULES, "extra__in_situ_only"]
_LOG = f"""judged AS (SELECT *, {_reason(_BASE_RULES)} AS drop_reason FROM t),
lg AS (SELECT species_slug, count(*) AS n_in, count(*) FILTER (drop_reason IS NULL) AS n_out, {", ".join(f"count(*) FILTER (drop_reason = '{r}') AS dropped_{r}" for r in _ALL_RULES)} FROM judged GROUP BY species_slug)"""


@_query(f", {_LOG} SELECT * FROM lg")
def runlog_filtered(spark, sf):
    return stages.filter_stage(_flagged(spark, sf), BASELINE, F.lit(AS_OF))[2]


@_query(f", {_LOG} SELECT sum(n_in) AS n_in, sum(n_out) AS n_out, sum(n_in) - sum(n_out) AS dropped_total, round(100.0 * sum(n_out) / greatest(sum(n_in), 1), 1) AS kept_pct FROM lg")
def policy_totals(spark, sf):
    return report.policy_totals(runlog_filtered(spark, sf))


_LONG = f"long AS (SELECT species_slug, reason, n FROM (SELECT * EXCLUDE (n_in, n_out) FROM lg) UNPIVOT (n FOR reason IN ({', '.join('dropped_' + r for r in _ALL_RULES)})))"


@_query(f", {_LOG}, {_LONG} SELECT reason, sum(n) AS n_dropped FROM long GROUP BY reason HAVING sum(n) > 0 ORDER BY n_dropped DESC, reason LIMIT 12")
def drop_reason_ranking(spark, sf):
    return report.drop_reason_ranking(runlog_filtered(spark, sf))


_MOST = f"greatest({', '.join('dropped_' + r for r in _ALL_RULES)})"
_TOP = "CASE " + " ".join(f"WHEN dropped_{r} = {_MOST} THEN 'dropped_{r}'" for r in _ALL_RULES) + " END"


@_query(f", {_LOG} SELECT species_slug, n_in - n_out AS dropped_total, round(100.0 * n_out / greatest(n_in, 1), 1) AS kept_pct, {_MOST} AS top_drop_n, CASE WHEN {_MOST} > 0 THEN {_TOP} END AS top_drop_reason FROM lg")
def policy_summary(spark, sf):
    return report.policy_summary(runlog_filtered(spark, sf)).select("species_slug", "dropped_total", "kept_pct", "top_drop_n", "top_drop_reason")


_SUMMARY = f"SELECT *, n_in - n_out AS dropped_total, round(100.0 * n_out / greatest(n_in, 1), 1) AS kept_pct, {_MOST} AS top_drop_n, CASE WHEN {_MOST} > 0 THEN {_TOP} END AS top_drop_reason FROM lg"
_POLICY = " UNION ALL ".join([
    _fig("species", _SUMMARY, _item("species_slug"), "n_in", "n_out", "kept_pct", "dropped_total", "top_drop_n"),
    _fig("top reason", _SUMMARY, _item("species_slug", "top_drop_reason"), "top_drop_n"),
    _fig("totals", "SELECT sum(n_in) AS n_in, sum(n_out) AS n_out, sum(n_in) - sum(n_out) AS dropped_total, round(100.0 * sum(n_out) / greatest(sum(n_in), 1), 1) AS kept_pct FROM lg", "''", "n_in", "n_out", "dropped_total", "kept_pct"),
    _fig("reasons", "SELECT reason, sum(n) AS n_dropped FROM long GROUP BY reason HAVING sum(n) > 0 ORDER BY n_dropped DESC, reason LIMIT 12", _item("reason"), "n_dropped"),
])


@_query(f", {_LOG}, {_LONG} {_POLICY}")
def policy_report(spark, sf):
    return report.policy_report(files.kept(runlog_filtered(spark, sf), "runlog"))


_HISTORY = "SELECT species_slug, CASE WHEN k % 3 = 0 THEN 'old' ELSE 'new' END AS policy_id, CASE WHEN k % 7 = 0 THEN 'error' ELSE 'ok' END AS status, k AS ts, CAST(k AS BIGINT) AS n_in FROM {c} WHERE copy_no = 0 AND source = 'GBIF' AND k % 11 <> 0"


@_query(f", h AS ({_HISTORY.format(c='clean')}) SELECT species_slug, policy_id, ts, n_in FROM (SELECT *, row_number() OVER (PARTITION BY species_slug ORDER BY ts DESC) AS rn FROM h WHERE status = 'ok' AND policy_id = 'new') WHERE rn = 1")
def runlog_latest(spark, sf):
    log = spark.sql(_HISTORY, c=_clean(spark, sf))
    return report.runlog_latest(log, "new").select("species_slug", "policy_id", "ts", "n_in")


# --- stage 04 --------------------------------------------------------------------------------------------------------


@_query(f"SELECT {_ID}, round(x, 3) AS x, round(y, 3) AS y FROM spot", _GRID)
def project_laea(spark, sf):
    x, y = P.project_laea(F.col("lon"), F.col("lat"))
    return _points(spark, sf).select(*_IDS, F.round(x, 3).alias("x"), F.round(y, 3).alias("y"))


_MET = 'JOIN (SELECT DISTINCT col, "row" FROM placed WHERE in_bounds) p ON p.col = c.col AND p."row" = c."row"'


@_query(f"SELECT c.cell_id, round(clon, 6) AS lon, round(clat, 6) AS lat FROM centres c {_MET}", _GRID)
def unproject_laea(spark, sf):
    lon, lat = P.unproject_laea(F.col("x_center"), F.col("y_center"))
    return grid.cells_met(_points(spark, sf), EXTENT).select("cell_id", F.round(lon, 6).alias("lon"), F.round(lat, 6).alias("lat"))


@_query(f'SELECT c.col, c."row", c.x_center, c.y_center, c.cell_id FROM cells c {_MET}', _GRID)
def grid_cells(spark, sf):
    """The lattice's cells that hold a record."""
    met = grid.assign_cell(_points(spark, sf), EXTENT).where("in_bounds").select("col", "row").distinct()
    return grid.grid_cells(spark, EXTENT).join(met, ["col", "row"], "left_semi").select("col", "row", "x_center", "y_center", "cell_id")


_CORNERS = "SELECT unnest([w, e, e, w]) AS lon, unnest([s, s, n, n]) AS lat FROM (SELECT floor(min(lon)) AS w, ceil(max(lon)) AS e, floor(min(lat)) AS s, ceil(max(lat)) AS n FROM spot)"


@_query(f"""SELECT xmin, xmax, ymin, ymax, CAST((xmax - xmin) / {CELL} AS INT) AS ncol, CAST((ymax - ymin) / {CELL} AS INT) AS nrow FROM (SELECT floor(min(x) / {CELL}) * {CELL} AS xmin, ceil(max(x) / {CELL}) * {CELL} AS xmax,
  floor(min(y) / {CELL}) * {CELL} AS ymin, ceil(max(y) / {CELL}) * {CELL} AS ymax FROM ({_project(f"({_CORNERS})")}))""", _GRID)
def snapped_extent(spark, sf):
    return grid.snapped_extent(grid.corners_of(_points(spark, sf)), CELL)


def _sides(box: str, levels: int = 14) -> str:
    """(level, lon, lat) along the edges of a box (w, s, e, n), halved ``levels`` times."""
    return f"""SELECT level, unnest([w + (e - w) * t, e, w + (e - w) * t, w]) AS lon, unnest([s, s + (n - s) * t, n, s + (n - s) * t]) AS lat
      FROM (SELECT *, i / CAST(1 << level AS DOUBLE) AS t FROM (SELECT *, unnest(range(0, (1 << level) + 1)) AS i FROM (SELECT *, unnest(range(0, {levels + 1})) AS level FROM ({box}))))"""


def _dense(box: str) -> str:
    """The snapped extent of a box's densified edges, as common tables that end in dense."""
    return f""", sides AS MATERIALIZED ({_project(f"({_sides(box)})")}),
    bounds AS (SELECT level, min(x) AS x0, max(x) AS x1, min(y) AS y0, max(y) AS y1 FROM sides GROUP BY level),
    moved AS (SELECT *, greatest(abs(x0 - lag(x0) OVER (ORDER BY level)), abs(x1 - lag(x1) OVER (ORDER BY level)), abs(y0 - lag(y0) OVER (ORDER BY level)), abs(y1 - lag(y1) OVER (ORDER BY level))) AS by_ FROM bounds),
    dense AS (SELECT floor(x0 / {CELL}) * {CELL} AS xmin, ceil(x1 / {CELL}) * {CELL} AS xmax, floor(y0 / {CELL}) * {CELL} AS ymin, ceil(y1 / {CELL}) * {CELL} AS ymax FROM moved
      WHERE level = (SELECT coalesce(min(level) FILTER (by_ < 1.0), max(level)) FROM moved))"""


_BOX = "SELECT floor(min(lon)) AS w, floor(min(lat)) AS s, ceil(max(lon)) AS e, ceil(max(lat)) AS n FROM spot"


@_query(f"{_dense(_BOX)} SELECT *, CAST((xmax - xmin) / {CELL} AS INT) AS ncol, CAST((ymax - ymin) / {CELL} AS INT) AS nrow FROM dense", _GRID)
def densified_extent(spark, sf):
    return grid.snapped_extent(grid.densified(grid.box_of(_points(spark, sf))), CELL)


_DEFAULT_BOX = "SELECT CAST(-25 AS DOUBLE) AS w, CAST(34 AS DOUBLE) AS s, CAST(45 AS DOUBLE) AS e, CAST(72 AS DOUBLE) AS n"


@_query(f"""{_dense(_DEFAULT_BOX)} SELECT {_ID}, in_bounds, coalesce(x >= xmin AND x < xmax AND y >= ymin AND y < ymax, FALSE) AS in_dense_bounds FROM placed CROSS JOIN dense WHERE lat BETWEEN 34 AND 40.4 AND lon BETWEEN -25 AND 45""", _GRID)
def assign_cell_densified(spark, sf):
    """Points of the default box's south, which the extent of its four corners leaves out in part: all are placed by the densified one."""
    south = _points(spark, sf).where("lat between 34 and 40.4 and lon between -25 and 45")
    box = spark.createDataFrame([(-25.0, 34.0, 45.0, 72.0)], "w double, s double, e double, n double")
    dense = grid.extent_of(grid.densified(box), CELL)
    placed = grid.assign_cell(south, EXTENT).drop("col", "row").select(*_IDS, "lon", "lat", "in_bounds")
    return grid.assign_cell(placed.withColumnRenamed("in_bounds", "_four"), dense).select(*_IDS, F.col("_four").alias("in_bounds"), F.col("in_bounds").alias("in_dense_bounds"))


@_query(f'SELECT {_ID}, col, "row", in_bounds FROM placed', _GRID)
def assign_cell(spark, sf):
    return grid.assign_cell(_points(spark, sf), EXTENT).select(*_IDS, "col", "row", "in_bounds")


@_query('SELECT species_slug, "row", col, n FROM counts', _GRID)
def cell_counts(spark, sf):
    return grid.cell_counts(_points(spark, sf), EXTENT)


@_query(f"SELECT c.cell_id, on_land FROM masked c {_MET}", _GRID)
def land_mask(spark, sf):
    return grid.land_mask(grid.cells_met(_points(spark, sf), EXTENT), stages.stored_cover(land_edges(spark))).select("cell_id", "on_land")


def _presence(spark, sf) -> DataFrame:
    return stages.grid_stage(_points(spark, sf), EXTENT, land_edges(spark))[1]


@_query("SELECT species_slug, cell_id, n_points_in_cell, presence FROM presence", _GRID)
def grid_presence(spark, sf):
    return _presence(spark, sf).select("species_slug", "cell_id", "n_points_in_cell", "presence")


@_query("SELECT species_slug, round(clon, 6) AS lon, round(clat, 6) AS lat, cell_id, n_points_in_cell FROM presence WHERE presence = 1", _GRID)
def presence_centroids(spark, sf):
    return grid.presence_centroids(_presence(spark, sf)).withColumns({"lon": F.round("lon", 6), "lat": F.round("lat", 6)})


_CENTROIDS = "SELECT species_slug, round(clon, 6) AS lon, round(clat, 6) AS lat, cell_id, n_points_in_cell FROM presence WHERE presence = 1"


@_query(_CENTROIDS, _GRID)
def sink_grid(spark, sf):
    """Gridded over the box, written, and read again for the centroids."""
    out = stages.grid_into(_points(spark, sf), files.work_dir(spark, "grid"), "baseline", edges=land_edges(spark))
    return out.withColumns({"lon": F.round("lon", 6), "lat": F.round("lat", 6)})


@_query(f"SELECT lon, lat, cell_id, n_points_in_cell FROM ({_CENTROIDS}) WHERE species_slug = 'alpha_minor'", _GRID)
def scan_any_table(spark, sf):
    """One species' grid table beside another file, found by its name and read by its columns' usual names."""
    root = files.work_dir(spark, "any")
    points = _points(spark, sf).where("species_slug = 'alpha_minor'")
    files.sink_csv(points.select("lon", "lat"), f"{root}/points.csv")
    table = stages.grid_stage(points, EXTENT, land_edges(spark))[1].select("presence", F.col("lon_center").alias("longitude"), F.col("lat_center").alias("lat_cent"), F.col("cell_id").alias("grid_id"), F.col("n_points_in_cell").alias("count"))
    table.write.parquet(f"{root}/occ_alpha_minor__grid25km.parquet")
    return grid.centroids_of_table(files.scan_any_table(spark, root)).withColumns({"lon": F.round("lon", 6), "lat": F.round("lat", 6)})


@_query("""SELECT p.species_slug, n_read, n_after_non_na, n_in_bounds, n_points_total, n_presence_cells FROM (SELECT species_slug, count(*) AS n_read, count(*) AS n_after_non_na, count(*) FILTER (in_bounds) AS n_in_bounds FROM placed GROUP BY 1) p
  JOIN (SELECT species_slug, sum(n_points_in_cell) AS n_points_total, sum(presence) AS n_presence_cells FROM presence GROUP BY 1) q ON q.species_slug = p.species_slug""", _GRID)
def grid_summary(spark, sf):
    return stages.grid_stage(_points(spark, sf), EXTENT, land_edges(spark))[2]


@_query(f"""SELECT s.species_slug, {EXTENT.nrow} - c."row" + 1 AS raster_row, list(p.n_points_in_cell ORDER BY c.col) AS line FROM cells c CROSS JOIN (SELECT DISTINCT species_slug FROM presence) s
  LEFT JOIN presence p ON p.species_slug = s.species_slug AND p.cell_id = c.cell_id GROUP BY s.species_slug, c."row" """, _GRID)
def dense_raster(spark, sf):
    cells, presence, _ = stages.grid_stage(_points(spark, sf), EXTENT, land_edges(spark))
    return grid.dense_raster(presence, cells, "n_points_in_cell", EXTENT)


def _keyed(spark, sf) -> DataFrame:
    return _clean(spark, sf).withColumn("id", F.concat_ws("|", "source", "k", "copy_no"))


@_query("SELECT DISTINCT concat_ws('|', source, k, copy_no) AS id FROM insea", _GRID)
def point_in_polygon(spark, sf):
    return grid.inside_polygon(_keyed(spark, sf), land_edges(spark), "id")


@_query("SELECT DISTINCT concat_ws('|', source, k, copy_no) AS id FROM insea", _GRID)
def point_in_cover(spark, sf):
    """The same by a cover of half-degree cells: only points of boundary cells meet edges."""
    return grid.inside_polygon(_keyed(spark, sf), stages.stored_cover(land_edges(spark), 0.5), "id")


_SEA = "sea AS (SELECT a.*, CASE WHEN a.lon IS NOT NULL AND a.lat IS NOT NULL THEN i.k IS NULL END AS in_sea FROM clean a LEFT JOIN (SELECT DISTINCT source, k, copy_no FROM insea) i ON i.source = a.source AND i.k = a.k AND i.copy_no = a.copy_no)"


@_query(f", {_SEA} SELECT {_ID}, in_sea FROM sea", _GRID)
def flag_in_sea(spark, sf):
    return grid.flag_in_sea(_keyed(spark, sf), stages.stored_cover(land_edges(spark)), "id").select(*_IDS, "in_sea")


@_query(f", {_SEA} SELECT count(*) FILTER (in_sea) AS n_sea, round(100.0 * count(*) FILTER (in_sea) / count(in_sea), 1) AS pct_sea FROM sea", _GRID)
def in_sea_share(spark, sf):
    sea = grid.flag_in_sea(_keyed(spark, sf), stages.stored_cover(land_edges(spark)), "id")
    return sea.agg(F.count_if("in_sea").alias("n_sea"), F.round(100 * F.count_if("in_sea") / F.count("in_sea"), 1).alias("pct_sea"))


# --- profiles --------------------------------------------------------------------------------------------------------


@_query("SELECT quantile_cont(u, 0) AS q0, quantile_cont(u, 0.5) AS q50, quantile_cont(u, 0.9) AS q90, quantile_cont(u, 0.95) AS q95, quantile_cont(u, 0.99) AS q99, quantile_cont(u, 1) AS q100 FROM unc")
def uncertainty_quantiles(spark, sf):
    return report.quantiles(_clean(spark, sf), S.safe_double(F.col("coordinateUncertaintyInMeters")))


@_query("""SELECT count(*) AS n, count(*) FILTER (lon IS NOT NULL AND lat IS NOT NULL) AS n_coords, round(100.0 * n_coords / count(*), 1) AS pct_coords, count(u) AS n_uncertainty, round(100.0 * count(u) / count(*), 1) AS pct_uncertainty FROM unc""")
def completeness(spark, sf):
    return report.completeness(_clean(spark, sf), S.safe_double(F.col("coordinateUncertaintyInMeters")))


@_query("SELECT " + ", ".join(f"{f}({c}) AS {f}_{c}" for c in ("event_day", "year", "lon", "lat") for f in ("min", "max")) + " FROM allb")
def ranges(spark, sf):
    return report.ranges(_all(spark, sf))


@_query("SELECT source, basisOfRecord, count(*) AS n FROM allb GROUP BY ALL ORDER BY n DESC, source, basisOfRecord NULLS LAST LIMIT 12")
def basis_breakdown(spark, sf):
    return report.top(_clean(spark, sf), 12, "source", "basisOfRecord")


@_query("SELECT count(*) FILTER (lon BETWEEN -25 AND 45 AND lat BETWEEN 34 AND 72) AS n_inside, count(*) FILTER (NOT (lon BETWEEN -25 AND 45 AND lat BETWEEN 34 AND 72)) AS n_outside FROM screened")
def bbox_check(spark, sf):
    inside = grid.bbox(F.col("lon"), F.col("lat"), (-25, 34, 45, 72))
    return normalise.screen_coords(_clean(spark, sf)).agg(F.count_if(inside).alias("n_inside"), F.count_if(~inside).alias("n_outside"))


@_query(f"SELECT {_ID}, lon, lat FROM screened ORDER BY lon DESC, lat, source, k, copy_no LIMIT 10")
def head_sorted(spark, sf):
    return normalise.screen_coords(_clean(spark, sf)).select(*_IDS, "lon", "lat").orderBy(F.desc("lon"), "lat", *_IDS).limit(10)


@_query(f"SELECT {_ID}, lon, lat FROM (SELECT *, concat_ws('|', source, k, copy_no) AS id FROM clean) ORDER BY md5(concat('1:', id)), id LIMIT 500")
def scan_sample(spark, sf):
    return files.scan_sample(_keyed(spark, sf), 500, "id", columns=[*_IDS, "lon", "lat", "absent"])


_SANE = "lon BETWEEN -25 AND 45 AND lat BETWEEN 34 AND 72"
_PROFILE = " UNION ALL ".join([
    _fig("completeness", "SELECT count(*) AS n, count(*) FILTER (lon IS NOT NULL AND lat IS NOT NULL) AS n_coords, round(100.0 * n_coords / count(*), 1) AS pct_coords, count(u) AS n_uncertainty, round(100.0 * count(u) / count(*), 1) AS pct_uncertainty FROM unc", "''", "n", "n_coords", "pct_coords", "n_uncertainty", "pct_uncertainty"),
    _fig("uncertainty", "SELECT quantile_cont(u, 0) AS q0, quantile_cont(u, 0.5) AS q50, quantile_cont(u, 0.9) AS q90, quantile_cont(u, 0.95) AS q95, quantile_cont(u, 0.99) AS q99, quantile_cont(u, 1) AS q100 FROM unc", "''", "q0", "q50", "q90", "q95", "q99", "q100"),
    _fig("box", f"SELECT count(*) FILTER ({_SANE}) AS n_inside, count(*) FILTER (lon IS NOT NULL AND lat IS NOT NULL AND NOT ({_SANE})) AS n_outside FROM unc", "''", "n_inside", "n_outside"),
    _fig("basis", "SELECT source, basisOfRecord, count(*) AS n FROM unc GROUP BY ALL ORDER BY n DESC, source, basisOfRecord NULLS LAST LIMIT 12", _item("source", "basisOfRecord"), "n"),
    _fig("range", "SELECT min(year) AS min_year, max(year) AS max_year FROM unc", "''", "min_year", "max_year"),
    _fig("sea", "SELECT count(in_sea) AS n_checked, count(*) FILTER (in_sea) AS n_in_sea FROM sea", "''", "n_checked", "n_in_sea"),
])


@_query(f", {_SEA} {_PROFILE}", _GRID)
def profile_report(spark, sf):
    df = stages.basics(_clean(spark, sf), carry=["coordinateUncertaintyInMeters", "basisOfRecord"])
    df = files.kept(df.select("source", "k", "copy_no", "lon", "lat", "year", "event_day", "coordinateUncertaintyInMeters", "basisOfRecord"), "records")
    sea = grid.flag_in_sea(df.select(F.concat_ws("|", *_IDS).alias("id"), "lon", "lat"), stages.stored_cover(land_edges(spark)), "id")
    return report.profile_report(df, sea, F.col("coordinateUncertaintyInMeters"), grid.bbox(F.col("lon"), F.col("lat"), (-25, 34, 45, 72)))


@_query('SELECT DISTINCT species_slug, printf(\'r%05d_c%05d\', "row", col) AS cell_id FROM placed WHERE in_bounds', _GRID)
def cell_id(spark, sf):
    return grid.assign_cell(_points(spark, sf), EXTENT).where("in_bounds").select("species_slug", S.cell_id(F.col("row"), F.col("col")).alias("cell_id")).distinct()


_STAMP = "SELECT o_orderkey AS k, concat(substr(CAST(o_orderdate AS STRING), 1, 10), 'T', lpad(CAST(o_orderkey % 30 AS STRING), 2, '0'), ':05:09', CASE WHEN o_orderkey % 7 = 0 THEN '' ELSE 'Z' END) AS stamp FROM {orders}"


@_query(f"SELECT k, stamp, CAST(epoch(try_strptime(stamp, '%Y-%m-%dT%H:%M:%SZ')) AS BIGINT) AS seconds FROM ({_STAMP.format(orders='orders')})", "")
def parse_utc(spark, sf):
    stamps = spark.sql(_STAMP, orders=spark.read.parquet(f"{sf}/orders.parquet"))
    return stamps.select("k", "stamp", F.unix_timestamp(S.parse_utc(F.col("stamp"))).alias("seconds"))


@_query(f", {_LOG} SELECT species_slug, CASE WHEN {_MOST} > 0 THEN {_TOP} END AS top_drop_reason FROM lg")
def top_drop_reason(spark, sf):
    return report.policy_summary(runlog_filtered(spark, sf)).select("species_slug", "top_drop_reason")


# --- files and folders -----------------------------------------------------------------------------------------------

_TEXTS = ["record_id", "species", "decimalLongitude", "decimalLatitude", "eventDate", "countryCode", "coordinateUncertaintyInMeters", "issues"]


def _text_file(spark, sf, sep: str) -> str:
    path = files.work_dir(spark, "texts") + (".csv" if sep == "," else ".tsv")
    files.sink_csv(occ_raw(spark, sf).select(*_IDS, *_TEXTS), path, sep)
    return path


@_query(f"SELECT {_ID}, record_id, TRY_CAST(decimalLongitude AS DOUBLE) AS decimalLongitude, TRY_CAST(coordinateUncertaintyInMeters AS DOUBLE) AS coordinateUncertaintyInMeters FROM raw")
def scan_delimited_typed(spark, sf):
    wanted = {"source": "string", "k": "bigint", "copy_no": "int", "record_id": "string", "decimalLongitude": "double", "absent": "int", "coordinateUncertaintyInMeters": "double"}
    return files.scan_delimited_typed(spark, _text_file(spark, sf, "\t"), wanted)


@_query(f"SELECT {_ID}, record_id, TRY_CAST(decimalLatitude AS DOUBLE) AS decimalLatitude, TRY_CAST(coordinateUncertaintyInMeters AS DOUBLE) AS coordinateUncertaintyInMeters FROM raw")
def scan_delimited_by_extension(spark, sf):
    """The same records with commas: the path's ending says so."""
    wanted = {"source": "string", "k": "bigint", "copy_no": "int", "record_id": "string", "decimalLatitude": "double", "coordinateUncertaintyInMeters": "double"}
    return files.scan_delimited_typed(spark, _text_file(spark, sf, ","), wanted)


@_query("SELECT " + ", ".join(f"CAST({c} AS STRING) AS {c}" for c in [*_IDS, *_TEXTS]) + " FROM raw")
def scan_csv_all_string(spark, sf):
    return files.scan_csv_all_string(spark, _text_file(spark, sf, ","))


@_query(f"SELECT {_ID}, species, eventDate FROM raw")
def sink_csv(spark, sf):
    df = files.scan_csv_all_string(spark, _text_file(spark, sf, ","))
    return df.select("source", F.col("k").cast("bigint").alias("k"), F.col("copy_no").cast("int").alias("copy_no"), "species", "eventDate")


_STAGED = [*_IDS, "species_slug", "occ_uid", "qc_flag_any"]


@_query(f"SELECT {', '.join(_STAGED)} FROM flagged WHERE species_slug <> 'beta_major' OR k % 5 = 0")
def sink_stage(spark, sf):
    """All species, then one of them again with fewer rows: only its partition is replaced."""
    root, rows = files.work_dir(spark, "stage"), _flagged(spark, sf).select(*_STAGED)
    files.sink_stage(rows, root)
    files.sink_stage(rows.where("species_slug = 'beta_major' and k % 5 = 0"), root)
    return files.scan_stage(spark, root)


@_query(f"SELECT {', '.join(_STAGED)} FROM flagged WHERE species_slug IN ('alpha_minor', 'zeta_fulva')")
def scan_stage_parquet(spark, sf):
    root = files.work_dir(spark, "stage")
    files.sink_stage(_flagged(spark, sf).select(*_STAGED), root)
    return files.scan_stage(spark, root, ["alpha_minor", "zeta_fulva"])


@_query(f", {_LOG} SELECT species_slug, {', '.join(f'CAST({c} AS STRING) AS {c}' for c in ['n_in', 'n_out', *('dropped_' + r for r in _ALL_RULES)])} FROM lg")
def scan_runlog(spark, sf):
    path, log = files.work_dir(spark, "runlog"), runlog_filtered(spark, sf)
    files.sink_csv(log, path)
    return files.scan_runlog(spark, path, ", ".join(f"`{c}` string" for c in log.columns))


@_query(f", {_LOG} SELECT species_slug, CAST(n_in AS STRING) AS n_in, CASE WHEN kind > 0 THEN CAST(n_out AS STRING) END AS n_out, CASE WHEN kind = 2 THEN 'more, or less' END AS extra_col_1, CASE WHEN kind = 2 THEN 'last' END AS extra_col_2 FROM (SELECT *, length(species_slug) % 3 AS kind FROM lg)")
def scan_runlog_ragged(spark, sf):
    """A log of three columns with shorter rows, and rows with two more fields, one of them quoted with a comma."""
    path, kind = files.work_dir(spark, "ragged"), F.length("species_slug") % 3
    log = runlog_filtered(spark, sf).select("species_slug", F.concat_ws(",", F.col("species_slug"), F.col("n_in").cast("string")).alias("two"), F.col("n_out").cast("string").alias("n_out"))
    line = F.when(kind == 0, F.col("two")).when(kind == 1, F.concat_ws(",", "two", "n_out")).otherwise(F.concat_ws(",", F.col("two"), F.col("n_out"), F.lit('"more, or less",last')))
    rows = log.select(F.lit(1).alias("at"), line.alias("line")).union(spark.createDataFrame([(0, "species_slug,n_in,n_out")], "at int, line string"))
    rows.coalesce(1).sortWithinPartitions("at").select("line").write.text(path)  # a log file: its header comes first
    return files.scan_runlog(spark, path)


_LAYOUT = """SELECT DISTINCT source, species_slug AS slug, k % 4 + 1 AS rank, concat('/landed/raw/', CASE k % 4 WHEN 0 THEN concat('group', CAST(k % 3 AS STRING), '/', lower(source), '/') WHEN 1 THEN concat(lower(source), '/')
  WHEN 2 THEN concat('group', CAST(k % 3 AS STRING), '/', lower(source), '_') ELSE concat(lower(source), '_') END, species_slug, '_clean.csv') AS path FROM {c} WHERE k % 16 > length(species_slug) % 3 + 8"""


@_query(f"SELECT source, slug, path FROM (SELECT *, row_number() OVER (PARTITION BY source, slug ORDER BY rank, path) AS rn FROM ({_LAYOUT.format(c='clean')})) WHERE rn = 1")
def resolve_layout(spark, sf):
    return files.resolve_layout(spark.sql(_LAYOUT, c=_clean(spark, sf)).select("path"))


@_query("SELECT DISTINCT species_slug AS slug FROM clean WHERE species_slug IN ('alpha_minor', 'zeta_fulva')")
def needs_refresh(spark, sf):
    """By file times: one species has newer input than output, one has no output."""
    root, rows = files.work_dir(spark, "refresh"), _clean(spark, sf).select("species_slug", *_IDS)
    files.sink_stage(rows, f"{root}/in")
    files.sink_stage(rows.where("species_slug <> 'zeta_fulva'"), f"{root}/out")
    files.sink_stage(rows.where("species_slug = 'alpha_minor'"), f"{root}/in")
    return files.needs_refresh(*(files.modified_by_species(spark, f"{root}/{x}") for x in ("in", "out")))


_RUNLOG = {"policy_id": "string", "species_slug": "string", "n_in": "bigint", "n_out": "bigint", "note": "string"}


@_query(f", {_LOG} SELECT 'first' AS policy_id, species_slug, n_in, n_out, CAST(NULL AS STRING) AS note FROM lg UNION ALL SELECT 'second', species_slug, n_in, n_out, NULL FROM lg WHERE n_out > 0")
def sink_runlog(spark, sf):
    """A log that is written anew, then appended to twice, once by a run without rows."""
    path, log = files.work_dir(spark, "runlog"), runlog_filtered(spark, sf)
    for name, rows, append in (("old", log, False), ("first", log, False), ("none", log.limit(0), True), ("second", log.where("n_out > 0"), True)):
        files.sink_runlog(rows.withColumn("policy_id", F.lit(name)), path, _RUNLOG, append)
    return spark.read.parquet(path)


_STAGES = "SELECT DISTINCT species_slug AS slug, concat('/data/01_merged/', CASE WHEN k % 3 = 0 THEN 'bees/' ELSE '' END, species_slug, '/occ_', species_slug, '__merged.', CASE WHEN k % 2 = 0 THEN 'csv' ELSE 'parquet' END) AS path, k % 3 AS t, k % 2 AS c FROM {c} WHERE k % 16 > length(species_slug) % 3 + 12"


@_query(f"SELECT slug, path FROM (SELECT *, row_number() OVER (PARTITION BY slug ORDER BY least(t, 1), c DESC) AS rn FROM ({_STAGES.format(c='clean')})) WHERE rn = 1")
def resolve_stage(spark, sf):
    return files.resolve_stage(spark.sql(_STAGES, c=_clean(spark, sf)).select("path"), "/data/01_merged")


@_query(f"SELECT {_ID}, species_slug, source_record_id, lon, lat, date_raw, licence FROM clean WHERE source = 'GBIF' OR species_slug = 'beta_major'")
def normalise_landed(spark, sf):
    """Raw files by species in two layouts, found in their folder and brought into the clean schema."""
    root = files.work_dir(spark, "landed")
    gbif, nbn = gbif_raw(spark, sf), nbn_raw(spark, sf)
    slugs = ["alpha_minor", "beta_major", "gamma_x_rubra", "delta_nigra", "epsilon_alba", "zeta_fulva"]
    for i, s in enumerate(slugs):
        files.sink_csv(gbif.where(S.slugify(F.col("species")) == s), f"{root}/raw/" + (f"gbif/{s}_clean.csv" if i % 2 else f"bees/gbif_{s}_clean.csv"))
    files.sink_csv(nbn.where(S.slugify(F.col("species")) == "beta_major"), f"{root}/raw/nbn/beta_major_clean.csv")
    out = stages.normalise_landed(spark, root)
    return out.select("source", F.col("k").cast("bigint").alias("k"), F.col("copy_no").cast("int").alias("copy_no"), "species_slug", "source_record_id", "lon", "lat", "date_raw", "licence")


# --- streams: what lands in two goes, each read once -------------------------------------------------------------------


def _landings(spark, name: str, rows: DataFrame, step) -> str:
    """Lands the rows in two halves and lets step(folder, stream, out, checkpoint) run after each; returns out."""
    root = files.work_dir(spark, name)
    folder, out, rows = f"{root}/landed", f"{root}/out", files.kept(rows, "rows")  # made once, not for each half
    for half in (rows.where("k % 2 = 0"), rows.where("k % 2 = 1")):
        files.land(half, folder)
        step(folder, streams.landed(spark, folder, rows.schema), out, f"{root}/checkpoint")
    return out


@_query(f"SELECT {_ID}, record_id, eventDate FROM raw")
def stream_ingest(spark, sf):
    rows = occ_raw(spark, sf).select(*_IDS, "record_id", "eventDate")
    return spark.read.schema(rows.schema).parquet(_landings(spark, "ingest", rows, lambda _, s, out, at: streams.ingest(s, out, at)))


@_query("SELECT DISTINCT source, record_id FROM raw WHERE k % 50 <> 1")
def stream_dedup(spark, sf):
    """Some rows of the second landing are ten days late, behind the watermark: they go."""
    at = F.lit(1_767_225_600) + 3600 * F.col("copy_no") - F.when(F.col("k") % 50 == 1, 864_000).otherwise(0)
    rows = occ_raw(spark, sf).select(*_IDS, "record_id", F.timestamp_seconds(at).alias("landed_at"))
    out = _landings(spark, "dedup", rows, lambda _, s, out, at: streams.ingest(streams.dedup(s, ["source", "record_id"], "landed_at"), out, at))
    return spark.read.schema(rows.schema).parquet(out).select("source", "record_id")


@_query("SELECT source, record_id, min(k) FILTER (k % 2 = 0) AS first_even, count(*) FILTER (k % 2 = 0) > 0 AS in_first FROM raw GROUP BY source, record_id")
def stream_dedup_exact(spark, sf):
    """All ids pass once, also those that come first ten days late; an id of the first landing passes with its first record."""
    at = F.lit(1_767_225_600) + 3600 * F.col("copy_no") - F.when(F.col("k") % 50 == 1, 864_000).otherwise(0)
    rows = occ_raw(spark, sf).select(*_IDS, "record_id", F.timestamp_seconds(at).alias("landed_at"))
    step = lambda _, s, out, check: streams.ingest(streams.dedup_exact(s, ["source", "record_id"], "landed_at", ["k", "copy_no"]), out, check, by_clock=True)
    out = spark.read.schema(rows.schema).parquet(_landings(spark, "exact", rows, step))
    first = F.col("k") % 2 == 0
    return out.select("source", "record_id", F.when(first, F.col("k")).alias("first_even"), first.alias("in_first"))


#: What the flags and the rules of a policy read of a clean record, beside what the merge reads.
_JUDGED = ["licence", "licence_expected", "coordinateUncertaintyInMeters", "basisOfRecord", "taxonRank", "certainty", "issues"]


@_query(f"SELECT {_ID}, {_reason(_BASE_RULES)} AS drop_reason FROM t")
def stream_qc(spark, sf):
    out = _landings(spark, "qc", stages.basics(_clean(spark, sf), carry=_JUDGED), lambda _, s, out, at: streams.ingest(streams.judged(s, BASELINE, F.lit(AS_OF)).select(*_IDS, "drop_reason"), out, at))
    return spark.read.parquet(out)


@_query('SELECT species_slug, "row", col, n FROM counts', _GRID)
def stream_grid_counts(spark, sf):
    rows = _points(spark, sf).select("k", "species_slug", "lon", "lat")
    return streams.counts_now(spark, _landings(spark, "counts", rows, lambda _, s, out, at: streams.grid_counts(s, out, at, EXTENT, fold=2)))


assert set(EXPECTED) == {"GBIF", "NBN"}
