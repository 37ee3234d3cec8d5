"""Reading and writing record files: typed and untyped scans, layouts, stage tables, refresh decisions."""

from __future__ import annotations

import re
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from . import snapshots


def work_dir(spark: SparkSession, name: str) -> str:
    """A new folder below the shared spark.checkpoint.dir; unset, below a temp folder in local mode, else an error."""
    root = spark.sparkContext.getConf().get("spark.checkpoint.dir")
    if not root:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("spark.checkpoint.dir must name a folder that the driver and all executors share")
        root = f"file://{tempfile.gettempdir()}/fieldspark-work"
    return f"{root.rstrip('/')}/{name}-{uuid.uuid4().hex[:12]}"


def exists(spark: SparkSession, path: str) -> bool:
    at = spark._jvm.org.apache.hadoop.fs.Path(path)
    return at.getFileSystem(spark._jsc.hadoopConfiguration()).exists(at)


def empty_typed(spark: SparkSession, schema) -> DataFrame:
    """No rows with the right columns, so that later stages go on."""
    return spark.createDataFrame([], schema)


def kept(df: DataFrame, name: str) -> DataFrame:
    """df written to the shared folder and read back, for what is read several times."""
    path = work_dir(df.sparkSession, name)
    with snapshots.compilable(df.sparkSession):
        df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def kept_keyed(df: DataFrame, name: str, keys: list[str], buckets: int = 0) -> DataFrame:
    """df written once to the shared folder as a table of buckets by the keys, one file each, and read back.

    Joins, aggregates and windows by the keys read it without another shuffle. The keys should be spread: a bucket is
    written by one task. buckets 0: as many as spark.sql.shuffle.partitions. The session's catalog has the table under a
    name of its own until forget().
    """
    spark = df.sparkSession
    n, table = buckets or max(1, int(spark.conf.get("spark.sql.shuffle.partitions"))), f"{name}_{uuid.uuid4().hex[:12]}"
    with snapshots.compilable(spark):
        df.repartition(n, *keys).write.format("parquet").option("path", work_dir(spark, name)).bucketBy(n, *keys).saveAsTable(table)
    return spark.table(table)


def forget(spark: SparkSession, name: str) -> None:
    """Takes the tables of kept_keyed() out of the catalog; their files stay in the shared folder."""
    for t in spark.catalog.listTables(pattern=f"{name}_*"):
        spark.sql(f"DROP TABLE IF EXISTS {t.name}")


def list_files(spark: SparkSession, root: str, glob: str = "*") -> DataFrame:
    """(path, modified, bytes) of all files below a folder, without reading them; none if there is no such folder."""
    if not exists(spark, root):
        return empty_typed(spark, "path string, modified timestamp, bytes long")
    found = spark.read.format("binaryFile").option("recursiveFileLookup", True).option("pathGlobFilter", glob).load(root)
    return found.select("path", F.col("modificationTime").alias("modified"), F.col("length").alias("bytes"))


def land(df: DataFrame, folder: str) -> DataFrame:
    """Adds Parquet files to a landing folder, by species where df has them; returns what lies there now."""
    by = ["species_slug"] if "species_slug" in df.columns else []
    df.write.mode("append").partitionBy(*by).parquet(folder)
    return df.sparkSession.read.schema(df.schema).parquet(folder)


def scan_csv_all_string(spark: SparkSession, path: str, sep: str = ",") -> DataFrame:
    """All columns as text; NA is null. A path that does not exist gives a frame without rows and columns."""
    return spark.read.csv(path, header=True, sep=sep, nullValue="NA") if exists(spark, path) else empty_typed(spark, T.StructType([]))


def landed_tables(spark: SparkSession, root: str, glob: str = "*.csv") -> DataFrame:
    """(path) of the tables below a folder; one that Spark wrote as a folder of parts counts as one."""
    return list_files(spark, root, glob).select(F.regexp_replace("path", r"(\.(csv|parquet))/[^/]+$", "$1").alias("path")).distinct()


def scan_any_table(spark: SparkSession, folder: str) -> DataFrame:
    """The table in a folder of files: names with "grid" before others, Parquet before CSV, then by path."""
    name = F.lower(F.element_at(F.split("path", "/"), -1))
    kinds = F.when(name.endswith(".parquet"), 0).when(name.endswith(".csv"), 1)
    best = landed_tables(spark, folder, "*").withColumn("_k", kinds).where("_k is not null").orderBy(~F.contains(name, F.lit("grid")), "_k", "path").first()
    if best is None:
        raise FileNotFoundError(f"no table in {folder}")
    return spark.read.parquet(best["path"]) if best["_k"] == 0 else scan_csv_all_string(spark, best["path"])


def separator_of(path: str) -> str:
    """A comma for .csv, also packed; tabs otherwise, as downloads of records have them."""
    return "," if re.search(r"\.csv(\.(gz|bz2|zst|deflate))?/?$", path.lower()) else "\t"


def scan_delimited_typed(spark: SparkSession, path: str, schema: dict[str, str], sep: str | None = None) -> DataFrame:
    """The wanted columns that the file has, cast where they can be; only they are parsed. sep: by the path's ending unless given."""
    raw = scan_csv_all_string(spark, path, separator_of(path) if sep is None else sep)
    return raw.select(*(F.col(f"`{c}`").try_cast(t).alias(c) for c, t in schema.items() if c in raw.columns))


def scan_stage(spark: SparkSession, root: str, species: list[str] | None = None) -> DataFrame:
    """The last published snapshot of a stage table, or some of its species. FileNotFoundError if nothing was published."""
    entries = snapshots.manifest(spark, root)
    if not entries:
        raise FileNotFoundError(f"no snapshot at {root}")
    wanted = [e for k, e in entries.items() if species is None or k in species]
    some = snapshots.read(spark, wanted)
    return snapshots.read(spark, list(entries.values())[:1]).limit(0) if some is None else some


def sink_stage(df: DataFrame, root: str) -> None:
    """Publishes df, a folder per species: only the species in df are replaced, none if df is empty, all at once or not at all."""
    new = snapshots.write_species(df, root)
    if new:
        snapshots.commit(df.sparkSession, root, new)


def sink_csv(df: DataFrame, path: str, sep: str = ",") -> None:
    """Text files with a header; blanks around values stay, nulls are empty."""
    keep = {"ignoreLeadingWhiteSpace": False, "ignoreTrailingWhiteSpace": False}
    df.write.mode("overwrite").options(header=True, sep=sep, **keep).csv(path)


def scan_sample(df: DataFrame, n: int, key: str, seed: int = 1, columns: list[str] | None = None) -> DataFrame:
    """n rows of the whole table, the same each time: those with the smallest seeded digests of the key.

    columns: the wanted ones; those that df lacks are left out.
    """
    rows = df.orderBy(F.md5(F.concat(F.lit(f"{seed}:"), F.col(key).cast("string"))), key).limit(n)
    return rows if columns is None else rows.select(*(F.col(f"`{c}`") for c in columns if c in df.columns))


def sink_runlog(log: DataFrame, path: str, schema: dict[str, str], append: bool = False) -> None:
    """Writes a log by one fixed schema: columns that it lacks are null, others are left out. Also for a run that ends early, with no rows."""
    fixed = log.select(*((F.col(f"`{c}`") if c in log.columns else F.lit(None)).cast(t).alias(c) for c, t in schema.items()))
    fixed.write.mode("append" if append else "overwrite").parquet(path)


def sink_grid(cells: DataFrame, presence: DataFrame, summary: DataFrame, root: str, tag: str, cell_km: int) -> None:
    """Publishes a grid below <root>/<tag>/grid<km>: land cells, the gridded table by species, and the summary, in one snapshot.

    The summary also lies there as text, under _summary_grid, written last.
    """
    at = f"{root}/{tag}/grid{cell_km}km"
    new = {**snapshots.write_table(cells.where("on_land"), at, LAND), **snapshots.write_table(summary, at, SUMMARY)}
    species = snapshots.write_species(presence, at)
    snapshots.commit(cells.sparkSession, at, {**new, **{f"{GRIDDED}{k}": e for k, e in species.items()}}, replace=True)
    sink_csv(summary, f"{root}/{tag}/_summary_grid")


#: Entries of a grid's snapshot; those of species come after GRIDDED.
LAND, SUMMARY, GRIDDED = "land_cells", "summary", "grid/"


def scan_grid(spark: SparkSession, root: str, tag: str, cell_km: int, part: str = GRIDDED) -> DataFrame:
    """A part of the last published grid: LAND, SUMMARY, or GRIDDED for the table of all species."""
    entries = snapshots.manifest(spark, f"{root}/{tag}/grid{cell_km}km")
    found = snapshots.read(spark, [e for k, e in entries.items() if k == part or (part == GRIDDED and k.startswith(part))])
    if found is None:
        raise FileNotFoundError(f"no {part} published at {root}/{tag}/grid{cell_km}km")
    return found


def ingest_pages(pages: list[DataFrame], most: int | None = None) -> DataFrame:
    """Result pages whose columns may differ, stacked; at most so many records."""
    out = pages[0]
    for p in pages[1:]:
        out = out.unionByName(p, allowMissingColumns=True)
    return out if most is None else out.limit(most)


def resolve_layout(files: DataFrame) -> DataFrame:
    """(source, slug, path): of files (path) in the raw layouts, the first hit per source and species.

    Ranks: <group>/<source>/<slug>_clean.csv, <source>/<slug>_clean.csv, <group>/<source>_<slug>_clean.csv,
    <source>_<slug>_clean.csv below the root ``raw/``.
    """
    tail = F.regexp_extract("path", r"raw/(.*)$", 1)
    deep = tail.rlike(r"(^|/)(gbif|nbn)/[^/]+_clean\.csv$")
    found = files.withColumns({
        "source": F.upper(F.regexp_extract(tail, r"(?:^|/)(gbif|nbn)[/_]", 1)),
        "slug": F.regexp_replace(F.regexp_extract(tail, r"([^/]+)_clean\.csv$", 1), "^(gbif|nbn)_", ""),
        "rank": F.when(deep & tail.rlike("/.*/"), 1).when(deep, 2).when(tail.rlike("/"), 3).otherwise(4),
    }).where("source <> ''")
    w = Window.partitionBy("source", "slug").orderBy("rank", "path")
    return found.withColumn("_rn", F.row_number().over(w)).where("_rn = 1").select("source", "slug", "path")


def resolve_stage(files: DataFrame, root: str, suffix: str = "merged") -> DataFrame:
    """(slug, path): of files (path) in a stage's layouts, the first hit per species.

    Ranks: <root>/<group>/<slug>/occ_<slug>__<suffix>, then <root>/<slug>/occ_<slug>__<suffix>; Parquet before CSV.
    """
    name = F.regexp_extract("path", rf"occ_([^/]+)__{suffix}\.(parquet|csv)$", 1)
    parent = F.element_at(F.split("path", "/"), -2)
    depth = F.size(F.split(F.regexp_extract("path", rf"{root.rstrip('/').split('/')[-1]}/(.*)$", 1), "/"))
    found = files.withColumns({"slug": name, "rank": F.when(depth == 3, 1).when(depth == 2, 2), "csv": F.col("path").endswith(".csv")})
    w = Window.partitionBy("slug").orderBy("rank", "csv", "path")
    return found.where((F.col("slug") != "") & (parent == F.col("slug")) & F.col("rank").isNotNull()).withColumn("_rn", F.row_number().over(w)).where("_rn = 1").select("slug", "path")


def modified_by_species(spark: SparkSession, root: str) -> DataFrame:
    """(slug, modified) of a stage table, when each species was published, or by file times of a folder of species_slug=<slug> folders or <slug>_clean.csv files."""
    entries = snapshots.manifest(spark, root)
    if entries:
        rows = spark.createDataFrame([(k, e.modified) for k, e in entries.items()], "slug string, ms long")
        return rows.select("slug", F.timestamp_millis("ms").alias("modified"))
    slug = F.coalesce(F.nullif(F.regexp_extract("path", r"species_slug=([^/]+)/", 1), F.lit("")), F.regexp_replace(F.nullif(F.regexp_extract("path", r"([^/]+)_clean\.csv", 1), F.lit("")), "^(gbif|nbn)_", ""))
    return list_files(spark, root).where(~F.contains("path", F.lit("/_"))).withColumn("slug", slug).where("slug is not null").groupBy("slug").agg(F.max("modified").alias("modified"))


def needs_refresh(inputs: DataFrame, outputs: DataFrame, overwrite: bool = False, refresh_if_newer: bool = True) -> DataFrame:
    """Species to rebuild: (slug, modified) of the inputs against those of the outputs.

    All with overwrite; else those without output and, with refresh_if_newer, those whose input is newer.
    """
    a = inputs.groupBy("slug").agg(F.max("modified").alias("i"))
    b = outputs.groupBy("slug").agg(F.max("modified").alias("o"))
    newer = F.lit(refresh_if_newer) & (F.col("i") > F.col("o"))
    return a.join(b, "slug", "left").where(F.lit(overwrite) | F.col("o").isNull() | newer).select("slug")


def widest_row(spark: SparkSession, path: str, sep: str = ",") -> int:
    """The greatest number of fields of any line, quoted separators not counted: one pass over the lines, a number per task."""
    bare = F.regexp_replace("value", '"([^"]|"")*"', "")
    return spark.read.text(path).agg(F.max(F.length(bare) - F.length(F.replace(bare, F.lit(sep), F.lit(""))))).first()[0] or 0


def scan_runlog(spark: SparkSession, path: str, schema: str | None = None) -> DataFrame:
    """A log whose rows may differ in length; empty and NA are null. Fields stand on one line each.

    Shorter rows end in nulls. Fields beyond the header's become extra_col_1, extra_col_2, ..., as many as the longest row
    has. The columns are those of the header, all text, unless ``schema`` names them.
    """
    if schema is None:
        names = spark.read.csv(path, header=True).columns
        kinds = ["string"] * len(names)
    else:
        fixed = T.StructType.fromDDL(schema)
        names, kinds = fixed.names, [f.dataType.simpleString() for f in fixed]
    extra = max(0, widest_row(spark, path) + 1 - len(names))
    names, kinds = names + [f"extra_col_{i + 1}" for i in range(extra)], kinds + ["string"] * extra
    raw = spark.read.schema(", ".join(f"`{n}` {k}" for n, k in zip(names, kinds))).csv(path, header=True, mode="PERMISSIVE", enforceSchema=True, escape='"')
    return raw.select(*(F.when(~F.col(f"`{c}`").cast("string").isin("", "NA"), F.col(f"`{c}`")).alias(c) for c in raw.columns))
