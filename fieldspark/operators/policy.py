"""Stage 03: a declarative keep or drop policy; each dropped row is credited to the first rule that it fails."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass, field
from datetime import date

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.scalars import col_or_null, has_token, parse_boolish, safe_double, trimmed
from .qc import flag_columns


@dataclass(frozen=True)
class Policy:
    """None or an empty tuple switches a rule off, except where it says otherwise."""

    policy_id: str
    keep_sources: tuple[str, ...] = ()
    drop_missing_coords: bool = True
    drop_out_of_range: bool = True
    drop_future: bool = True
    drop_missing_date: bool = False
    require_event_day: bool = False
    allow_year_only: bool = True
    min_date: date | None = None
    max_date: date | None = None
    min_year: int | None = None
    max_year: int | None = None
    max_uncertainty_m: float | None = None
    keep_missing_uncertainty: bool = True
    drop_unexpected_licence: bool = False
    basis_allow: tuple[str, ...] = ()
    basis_deny: tuple[str, ...] = ()
    rank_allow: tuple[str, ...] = ()
    certainty_column: str | None = None
    certainty_allow: tuple[str, ...] = ()
    gbif_drop_any_issues: bool = False
    gbif_issue_blacklist: tuple[str, ...] = ()
    extra: dict[str, Callable[[DataFrame], Column]] = field(default_factory=dict)


# All counters of the run log, in rule order.
RULES = [
    "source_not_in_keep_sources", "missing_coords", "coords_out_of_range", "future_date", "missing_date", "no_event_day_required",
    "before_min_date", "after_max_date", "uncertainty_over_threshold", "uncertainty_missing_or_over_threshold", "unexpected_licence",
    "basis_not_allowed", "basis_in_blacklist", "taxon_rank_not_allowed", "nbn_certainty_not_allowed", "gbif_any_issues", "gbif_blacklisted_issues",
]


def rules(df: DataFrame, p: Policy, as_of: Column) -> list[tuple[str, Column]]:
    """(rule, drop predicate) in order. An allow list drops null, a deny list keeps it."""
    out: list[tuple[str, Column]] = []
    calc = flag_columns(as_of)
    flag = lambda k: F.col(f"qc_flag_{k}") if f"qc_flag_{k}" in df.columns else calc[k]
    not_in = lambda c, allowed: ~F.coalesce(c.isin(*allowed), F.lit(False))
    source, day, year = F.col("source"), F.col("event_day"), F.col("year")
    if p.keep_sources:
        out.append(("source_not_in_keep_sources", not_in(source, p.keep_sources)))
    for on, name in ((p.drop_missing_coords, "missing_coords"), (p.drop_out_of_range, "coords_out_of_range"), (p.drop_future, "future_date"), (p.drop_missing_date, "missing_date")):
        if on:
            out.append((name, flag(name)))
    if p.require_event_day:
        out.append(("no_event_day_required", day.isNull()))
    undated = F.lit(not p.allow_year_only)
    for name, limit, limit_year, late in (("before_min_date", p.min_date, p.min_year, False), ("after_max_date", p.max_date, p.max_year, True)):
        if limit is not None:
            y = F.lit(limit_year if limit_year is not None else limit.year)
            beyond = (lambda a, b: a > b) if late else (lambda a, b: a < b)
            out.append((name, F.when(day.isNotNull(), beyond(day, F.lit(limit))).when(year.isNotNull(), beyond(year, y)).otherwise(undated)))
    if p.max_uncertainty_m is not None:
        m = safe_double(col_or_null(df, "coordinateUncertaintyInMeters"))
        if p.keep_missing_uncertainty:
            out.append(("uncertainty_over_threshold", m > p.max_uncertainty_m))
        else:
            out.append(("uncertainty_missing_or_over_threshold", m.isNull() | (m > p.max_uncertainty_m)))
    if p.drop_unexpected_licence:
        out.append(("unexpected_licence", parse_boolish(col_or_null(df, "licence_expected")) == F.lit(False)))
    basis, rank = (F.upper(trimmed(col_or_null(df, c))) for c in ("basisOfRecord", "taxonRank"))
    if p.basis_allow:
        out.append(("basis_not_allowed", not_in(basis, p.basis_allow)))
    if p.basis_deny:
        out.append(("basis_in_blacklist", basis.isin(*p.basis_deny)))
    if p.rank_allow:
        out.append(("taxon_rank_not_allowed", not_in(rank, p.rank_allow)))
    if p.certainty_column and p.certainty_allow:
        out.append(("nbn_certainty_not_allowed", (source == "NBN") & not_in(F.lower(trimmed(col_or_null(df, p.certainty_column))), p.certainty_allow)))
    issues = col_or_null(df, "issues")
    if p.gbif_drop_any_issues:
        out.append(("gbif_any_issues", (source == "GBIF") & (F.length(trimmed(issues)) > 0)))
    if p.gbif_issue_blacklist:
        out.append(("gbif_blacklisted_issues", (source == "GBIF") & has_token(issues, list(p.gbif_issue_blacklist))))
    out += [(f"extra__{k}", f(df)) for k, f in p.extra.items() if callable(f)]
    return out


def with_drop_reason(df: DataFrame, policy: Policy, as_of: Column) -> DataFrame:
    """df with drop_reason: the first failing rule, null for kept rows. Map-only; a null predicate keeps."""
    found = [F.when(F.coalesce(c, F.lit(False)), name) for name, c in rules(df, policy, as_of)]
    return df.withColumn("drop_reason", F.coalesce(*found) if found else F.lit(None).cast("string"))


def policy_filter(df: DataFrame, policy: Policy, as_of: Column) -> DataFrame:
    return with_drop_reason(df, policy, as_of).where("drop_reason is null").drop("drop_reason")


def runlog_filtered(judged: DataFrame, extra: tuple[str, ...] = ()) -> DataFrame:
    """Rows in, out and dropped by rule per species, of a frame with drop_reason: always all counters."""
    names = RULES + [f"extra__{k}" for k in extra]
    return judged.groupBy("species_slug").agg(F.count("*").alias("n_in"), F.count_if(F.col("drop_reason").isNull()).alias("n_out"), *(F.count_if(F.col("drop_reason") == n).alias(f"dropped_{n}") for n in names))


def in_situ_only(df: DataFrame) -> Column:
    """The shipped extra rule: observations only, of source GBIF."""
    basis = F.upper(trimmed(col_or_null(df, "basisOfRecord")))
    return (F.col("source") == "GBIF") & ~F.coalesce(basis.isin("HUMAN_OBSERVATION", "OBSERVATION", "MACHINE_OBSERVATION"), F.lit(False))


BASELINE = Policy("baseline_2000", keep_sources=("GBIF", "NBN"), min_date=date(2000, 1, 1), max_uncertainty_m=1000, extra={"in_situ_only": in_situ_only})
