"""Stage 02: seven flags that are never null, their disjunction and their count."""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.scalars import FALSE_WORDS, safe_double


@dataclass(frozen=True)
class QcConfig:
    max_uncertainty_m: float = 10_000
    unexpected_licence: bool = True
    has_issues: bool = True
    count: bool = True


FLAGS = ["missing_coords", "coords_out_of_range", "missing_date", "future_date", "uncertainty_high", "unexpected_licence", "has_issues"]


def flag_columns(as_of: Column, config: QcConfig = QcConfig()) -> dict[str, Column]:
    lon, lat, day, year = (F.col(c) for c in ("lon", "lat", "event_day", "year"))
    sure = lambda c: F.coalesce(c, F.lit(False))
    off = F.lit(False)
    return {
        "missing_coords": lon.isNull() | lat.isNull(),
        "coords_out_of_range": sure(lon.isNotNull() & lat.isNotNull() & ~(lon.between(-180, 180) & lat.between(-90, 90))),
        "missing_date": day.isNull() & year.isNull(),
        "future_date": sure((day > as_of) | (day.isNull() & (year > F.year(as_of)))),
        "uncertainty_high": sure(safe_double(F.col("coordinateUncertaintyInMeters")) > config.max_uncertainty_m),
        "unexpected_licence": sure(F.lower(F.col("licence_expected").cast("string")).isin(*FALSE_WORDS)) if config.unexpected_licence else off,
        "has_issues": sure(F.length("issues") > 0) if config.has_issues else off,
    }


def qc_flags(df: DataFrame, as_of: Column | None = None, config: QcConfig = QcConfig()) -> DataFrame:
    """df with qc_flag_*, qc_flag_any and, if asked for, qc_flag_count. Map-only. as_of: today unless given."""
    flags = flag_columns(F.current_date() if as_of is None else as_of, config)
    out = df.withColumns({f"qc_flag_{k}": v for k, v in flags.items()})
    names = [F.col(f"qc_flag_{k}") for k in FLAGS]
    more = {"qc_flag_any": reduce(or_, names)}
    if config.count:
        more["qc_flag_count"] = sum((c.cast("int") for c in names[1:]), names[0].cast("int"))
    return out.withColumns(more)


def runlog_qc(flagged: DataFrame) -> DataFrame:
    """Rows per species, in all and by flag."""
    return flagged.groupBy("species_slug").agg(F.count("*").alias("n_in"), *(F.count_if(F.col(f"qc_flag_{k}")).alias(f"n_flag_{k}") for k in ["any", *FLAGS]))
