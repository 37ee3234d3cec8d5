"""Occurrence records and land polygons derived from the given tables: one scan in Spark, and SQL for the comparison."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

#: Each order makes one to three dirty records in up to two sources; copy_no stands for the place in a file.
_FIELDS = """
SELECT source, k, copy_no,
  CASE k % 6 WHEN 0 THEN 'Alpha minor' WHEN 1 THEN 'Beta  major' WHEN 2 THEN 'Gamma (x) rubra'
             WHEN 3 THEN ' Delta nigra' WHEN 4 THEN 'Epsilon alba.' ELSE 'Zeta fulva' END AS species,
  CASE WHEN source = 'GBIF' AND k % 37 = 0 THEN NULL
       WHEN source = 'GBIF' AND copy_no = 2 THEN concat('G', CAST(k AS STRING), 'x')
       WHEN source = 'GBIF' THEN concat('G', CAST(k AS STRING))
       ELSE concat('N', CAST(k AS STRING), '_', CAST(copy_no AS STRING)) END AS record_id,
  CASE WHEN source = 'GBIF' AND k % 3 > 0 THEN concat('urn:', CAST(k % 1000 AS STRING)) END AS occurrenceID,
  CASE WHEN k % 97 = 0 THEN NULL WHEN k % 101 = 0 THEN '200' WHEN k % 103 = 0 THEN 'n/a' WHEN k % 107 = 0 THEN 'NaN'
       ELSE CAST(CAST(-249950000 + ((k * 7919) % 7000) * 100000
                 + CASE WHEN source = 'NBN' THEN copy_no * 100 ELSE 0 END AS DOUBLE) / 10000000 AS STRING) END AS decimalLongitude,
  CASE WHEN k % 101 = 0 THEN '95'
       ELSE CAST(CAST(340000000 + ((k * 104729) % 3800) * 100000 AS DOUBLE) / 10000000 AS STRING) END AS decimalLatitude,
  CASE WHEN k % 10 < 4 THEN substr(CAST(o_orderdate AS STRING), 1, 10)
       WHEN k % 10 < 6 THEN concat(substr(CAST(o_orderdate AS STRING), 1, 10), 'T10:00:00')
       WHEN k % 10 = 6 THEN concat(substr(CAST(o_orderdate AS STRING), 1, 10), '/2001-12-31')
       WHEN k % 10 = 7 THEN '2998-01-01' WHEN k % 10 = 8 THEN substr(CAST(o_orderdate AS STRING), 1, 4) ELSE NULL END AS eventDate,
  CASE WHEN k % 11 = 0 THEN NULL WHEN k % 11 = 1 THEN concat(substr(CAST(o_orderdate AS STRING), 1, 4), '.0')
       ELSE substr(CAST(o_orderdate AS STRING), 1, 4) END AS year,
  CASE WHEN source = 'NBN' THEN 'GB' WHEN k % 4 = 0 THEN 'FR' WHEN k % 4 = 1 THEN 'DE' WHEN k % 4 = 2 THEN 'GB' ELSE NULL END AS countryCode,
  CASE WHEN source = 'GBIF' THEN CASE k % 7 WHEN 0 THEN 'http://creativecommons.org/publicdomain/zero/1.0/legalcode'
         WHEN 1 THEN 'http://creativecommons.org/licenses/by/4.0/legalcode' WHEN 2 THEN 'http://creativecommons.org/licenses/by-nc/4.0/legalcode'
         WHEN 3 THEN 'cc_by_4_0' WHEN 4 THEN 'CC0_1_0' WHEN 5 THEN 'unspecified' ELSE NULL END
       ELSE CASE k % 7 WHEN 0 THEN 'OGL' WHEN 1 THEN 'CC-BY' WHEN 2 THEN 'cc by-nc 4.0' WHEN 3 THEN 'Open Government Licence v3'
         WHEN 4 THEN 'CC0' WHEN 5 THEN 'All rights reserved' ELSE NULL END END AS license,
  CASE k % 8 WHEN 0 THEN NULL WHEN 1 THEN '10' WHEN 2 THEN '100' WHEN 3 THEN '1000' WHEN 4 THEN '1000.5' WHEN 5 THEN '25000'
       WHEN 6 THEN 'abc' ELSE '50' END AS coordinateUncertaintyInMeters,
  CASE WHEN source = 'NBN' THEN NULL WHEN k % 9 < 3 THEN NULL WHEN k % 9 = 3 THEN '' WHEN k % 9 = 4 THEN ' '
       WHEN k % 9 = 5 THEN 'COORDINATE_ROUNDED' WHEN k % 9 = 6 THEN 'COORDINATE_ROUNDED; ZERO_COORDINATE'
       WHEN k % 9 = 7 THEN 'NOT_ZERO_COORDINATE' ELSE 'RECORDED_DATE_INVALID' END AS issues,
  CASE WHEN source = 'NBN' THEN NULL WHEN k % 12 < 7 THEN 'HUMAN_OBSERVATION' WHEN k % 12 = 7 THEN ' observation '
       WHEN k % 12 = 8 THEN 'MACHINE_OBSERVATION' WHEN k % 12 = 9 THEN 'PRESERVED_SPECIMEN' WHEN k % 12 = 10 THEN 'FOSSIL_SPECIMEN' ELSE NULL END AS basisOfRecord,
  CASE WHEN k % 14 = 0 THEN 'GENUS' WHEN k % 14 = 1 THEN 'subspecies' WHEN k % 14 = 2 THEN NULL ELSE 'SPECIES' END AS taxonRank,
  CASE WHEN source = 'GBIF' THEN NULL WHEN k % 3 = 0 THEN 'Definite' WHEN k % 3 = 1 THEN ' probable' ELSE 'uncertain' END AS certainty,
  CASE WHEN k % 5 < 3 THEN concat('status ', CAST(k % 5 AS STRING)) END AS identificationVerificationStatus,
  CASE WHEN k % 9 > 1 THEN concat('person ', CAST(k % 90 AS STRING)) END AS identifiedBy,
  CASE WHEN source = 'GBIF' AND k % 4 = 0 THEN substr(CAST(o_orderdate AS STRING), 1, 10) END AS dateIdentified,
  CASE WHEN source = 'NBN' THEN CAST(k % 4 AS STRING) END AS coordinatePrecision,
  CASE WHEN k % 23 = 0 THEN 'ABSENT' ELSE 'PRESENT' END AS occurrenceStatus,
  concat('key-', CAST(k % 40 AS STRING)) AS datasetKey, concat('Set ', CAST(k % 40 AS STRING)) AS datasetName,
  CASE WHEN k % 6 > 0 THEN concat('org-', CAST(k % 12 AS STRING)) END AS publishingOrgKey,
  CASE WHEN k % 7 > 0 THEN concat('I', CAST(k % 14 AS STRING)) END AS institutionCode,
  CASE WHEN k % 8 > 0 THEN concat('C', CAST(k % 16 AS STRING)) END AS collectionCode
FROM"""

#: In SQL, the copies of an order by one branch each.
OCC_SQL = f"""{_FIELDS} (
  SELECT o_orderkey AS k, o_orderdate, 'GBIF' AS source, 0 AS copy_no FROM orders WHERE o_orderkey % 5 <> 4
  UNION ALL SELECT o_orderkey, o_orderdate, 'GBIF', 1 FROM orders WHERE o_orderkey % 5 <> 4 AND o_orderkey % 13 = 0
  UNION ALL SELECT o_orderkey, o_orderdate, 'GBIF', 2 FROM orders WHERE o_orderkey % 5 <> 4 AND o_orderkey % 17 = 0
  UNION ALL SELECT o_orderkey, o_orderdate, 'NBN', 0 FROM orders WHERE o_orderkey % 4 = 0 OR o_orderkey % 5 = 4
  UNION ALL SELECT o_orderkey, o_orderdate, 'NBN', 1 FROM orders WHERE o_orderkey % 20 = 0
) base
"""

#: In Spark, the copies of an order, and when it has them.
_COPIES = (("GBIF", 0, "k % 5 <> 4"), ("GBIF", 1, "k % 5 <> 4 and k % 13 = 0"), ("GBIF", 2, "k % 5 <> 4 and k % 17 = 0"), ("NBN", 0, "k % 4 = 0 or k % 5 = 4"), ("NBN", 1, "k % 20 = 0"))

#: Closed rings in degrees.
LAND_SQL = """
SELECT * FROM (VALUES
  (1, CAST(-10 AS DOUBLE), CAST(50 AS DOUBLE), CAST(2 AS DOUBLE), CAST(50 AS DOUBLE)),
  (1, 2, 50, 0, 59), (1, 0, 59, -8, 58), (1, -8, 58, -10, 50),
  (2, 0, 42, 30, 42), (2, 30, 42, 30, 56), (2, 30, 56, 8, 55), (2, 8, 55, 0, 42),
  (3, 12, 57, 25, 60), (3, 25, 60, 24, 70), (3, 24, 70, 12, 65), (3, 12, 65, 12, 57)
) AS t(poly_id, x1, y1, x2, y2)
"""


def occ_raw(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The records in one scan of orders, whose two columns are spread first: its file may be a single split."""
    orders = spark.read.parquet(f"{sf_dir}/orders.parquet").select(F.col("o_orderkey").alias("k"), "o_orderdate")
    orders = orders.repartition(spark.sparkContext.defaultParallelism, "k")
    copies = F.array(*(F.when(F.expr(when), F.struct(F.lit(source).alias("source"), F.lit(n).alias("copy_no"))) for source, n, when in _COPIES))
    base = orders.select("k", "o_orderdate", F.explode(F.array_compact(copies)).alias("c")).select("k", "o_orderdate", "c.source", "c.copy_no")
    return spark.sql(f"{_FIELDS} {{base}}", base=base)


def gbif_raw(spark: SparkSession, sf_dir: str) -> DataFrame:
    return occ_raw(spark, sf_dir).where("source = 'GBIF'").withColumnRenamed("record_id", "gbifID")


def nbn_raw(spark: SparkSession, sf_dir: str) -> DataFrame:
    return occ_raw(spark, sf_dir).where("source = 'NBN'").withColumnRenamed("record_id", "recordID")


def land_edges(spark: SparkSession) -> DataFrame:
    """(poly_id, x1, y1, x2, y2)"""
    return spark.sql(LAND_SQL)
