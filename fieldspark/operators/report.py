"""Profiles, funnels, run logs and their summaries."""

from __future__ import annotations

from functools import reduce
from math import ceil, floor
from operator import or_

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .merge import KEY, cross_dup_flags, crossdup_review, dup_group_counts, flag_strict, strict_keys


def value_counts(df: DataFrame, *columns: str) -> DataFrame:
    """Rows per value, and their share of all rows."""
    total = df.agg(F.count("*").alias("_t"))  # one row
    return df.groupBy(*columns).agg(F.count("*").alias("n")).crossJoin(F.broadcast(total)).withColumn("share", F.col("n") / F.col("_t")).drop("_t")


def unexpected_licences(clean: DataFrame) -> DataFrame:
    """Raw and normalised licences outside the expected set, with their share of all records of the source and species."""
    key = ["source", "species_slug"]
    total = clean.groupBy(*key).agg(F.count("*").alias("_t"))
    odd = clean.where(~F.col("licence_expected")).groupBy(*key, "licence_raw", "licence").agg(F.count("*").alias("n"))
    return odd.join(total, key).withColumn("prop_of_records", F.col("n") / F.col("_t")).drop("_t")


def accept_share(clean: DataFrame) -> DataFrame:
    return clean.groupBy("source").agg(F.count("*").alias("n_raw"), F.count_if("licence_expected").alias("n_accepted"), F.avg(F.col("licence_expected").cast("int")).alias("proportion"))


def non_accepted(clean: DataFrame, accepted: list[str]) -> DataFrame:
    return clean.where(F.col("licence").isNotNull() & ~F.col("licence").isin(*accepted)).groupBy("licence").agg(F.count("*").alias("n"))


def top(df: DataFrame, n: int, *columns: str) -> DataFrame:
    """The n most frequent values; ties by value."""
    return df.groupBy(*columns).agg(F.count("*").alias("n")).orderBy(F.desc("n"), *(F.asc_nulls_last(c) for c in columns)).limit(n)


def precision_counts(df: DataFrame) -> DataFrame:
    return df.groupBy("source").agg(*(F.count_if(F.col("date_precision") == p).alias(f"n_{p}") for p in ("day", "year", "unknown")))


def screening_funnel(raw: DataFrame, screened: DataFrame, by_id: DataFrame, deduped: DataFrame) -> DataFrame:
    """Rows per source after each step."""
    count = lambda df, name: df.groupBy("source").agg(F.count("*").alias(name))
    return count(raw, "n_raw").join(count(screened, "n_screened"), "source", "left").join(count(by_id, "n_by_id"), "source", "left").join(count(deduped, "n_deduped"), "source", "left").fillna(0)


def runlog_merged(pre: DataFrame, strict: DataFrame, asked: DataFrame | None = None, files: DataFrame | None = None, group_dir: str = "", out_root: str | None = None, keys: DataFrame | None = None) -> DataFrame:
    """Stage 01's log, a row per species: what came in and from where, counts, status and note.

    strict: pre with strict_drop. asked: (species, species_slug) to report on, with or without input; none: those of pre.
    files: (source, slug, path) as resolve_layout gives them. keys: the strict keys of pre, if they are stored already.
    """
    of = lambda s, *c: F.count_if(F.col("source").eqNullSafe(s) if not c else F.col("source").eqNullSafe(s) & (F.col("date_precision") == c[0]))
    log = strict.groupBy("species_slug").agg(
        F.min(F.trim("species")).alias("_species"), of("GBIF").alias("n_gbif"), of("NBN").alias("n_nbn"), F.count("*").alias("n_premerge"), F.count_if("strict_drop").alias("n_dropped_strict"), F.count_if(~F.col("strict_drop")).alias("n_final"),
        *(of(s, p).alias(f"n_{p}_{s.lower()}") for s in ("GBIF", "NBN") for p in ("day", "year", "unknown")),
    )
    keys = (strict_keys(pre) if keys is None else keys).groupBy("species_slug").agg(F.count("*").alias("n_strict_keys"))
    log = log.withColumnRenamed("_species", "species") if asked is None else asked.select("species", "species_slug").join(log.drop("_species"), "species_slug", "left")
    log = log.join(keys, "species_slug", "left")
    if files is not None:
        at = lambda s: F.max(F.when(F.col("source") == s, F.col("path")))
        log = log.join(files.groupBy(F.col("slug").alias("species_slug")).agg(at("GBIF").alias("gbif_file"), at("NBN").alias("nbn_file")), "species_slug", "left")
    else:
        log = log.withColumns({"gbif_file": F.lit(None).cast("string"), "nbn_file": F.lit(None).cast("string")})
    gbif, nbn = (F.coalesce(F.col(c), F.lit(0)) > 0 for c in ("n_gbif", "n_nbn"))
    status = F.when(gbif & nbn, "ok_both_sources").when(gbif, "ok_gbif_only").when(nbn, "ok_nbn_only").otherwise("no_inputs")
    out = F.concat(F.lit(f"{out_root}/species_slug="), "species_slug") if out_root else F.lit(None).cast("string")
    counts = ["n_gbif", "n_nbn", "n_premerge", "n_strict_keys", "n_dropped_strict", "n_final", *(f"n_{p}_{s}" for s in ("gbif", "nbn") for p in ("day", "year", "unknown"))]
    return log.select(
        "species", F.col("species_slug").alias("slug"), F.lit(group_dir).alias("group_dir"), "gbif_file", "nbn_file", gbif.alias("gbif_exists"), nbn.alias("nbn_exists"),
        *(F.when(gbif | nbn, F.coalesce(c, F.lit(0))).alias(c) for c in counts),
        F.when(gbif | nbn, out).alias("out_file"), status.alias("status"), F.when(gbif | nbn, "").otherwise("Neither GBIF nor NBN input found.").alias("note"),
    )


def dup_group_sizes(df: DataFrame) -> DataFrame:
    return dup_group_counts(df).where("n_gbif > 0 and n_nbn > 0").groupBy(F.col("n").alias("group_size")).agg(F.count("*").alias("n_groups"))


def ambiguous_counts(df: DataFrame) -> DataFrame:
    return crossdup_review(df).agg(F.countDistinct(*KEY).alias("n_keys"), F.count("*").alias("n_rows"))


def crossdup_examples(df: DataFrame, groups: int = 3) -> DataFrame:
    """All rows of the first few ambiguous keys, in key order."""
    review = crossdup_review(df)
    first = review.select(*KEY).distinct().orderBy(*KEY).limit(groups)
    return review.join(first, KEY, "left_semi")


def cross_dup_totals(flagged: DataFrame) -> DataFrame:
    share = lambda c: F.avg(F.col(c).cast("int"))
    return flagged.agg(F.count("*").alias("n_total"), F.count_if("flag_strict_key").alias("n_day"), F.count_if("flag_loose_year").alias("n_loose"), share("flag_strict_key").alias("prop_day"), share("flag_loose_year").alias("prop_loose"))


def dropped_profile(dropped: DataFrame) -> DataFrame:
    """Dropped rows by source and precision, by licence and by year in one pass."""
    sets = [[F.col("source"), F.col("date_precision")], [F.col("licence")], [F.col("year")]]
    keys = [F.col(c) for c in ("source", "date_precision", "licence", "year")]
    out = dropped.groupingSets(sets, *keys).agg(F.count("*").alias("n"), F.grouping_id().cast("int").alias("grouping"))
    return out.select("grouping", "source", "date_precision", "licence", "year", "n")


def completeness(df: DataFrame, uncertainty: Column) -> DataFrame:
    pct = lambda c: F.round(100 * F.avg(c.cast("int")), 1)
    have = F.col("lon").isNotNull() & F.col("lat").isNotNull()
    return df.agg(F.count("*").alias("n"), F.count_if(have).alias("n_coords"), pct(have).alias("pct_coords"), F.count_if(uncertainty.isNotNull()).alias("n_uncertainty"), pct(uncertainty.isNotNull()).alias("pct_uncertainty"))


def ranges(df: DataFrame) -> DataFrame:
    return df.agg(*(f(c).alias(f"{f.__name__}_{c}") for c in ("event_day", "year", "lon", "lat") for f in (F.min, F.max)))


def quantiles(df: DataFrame, x: Column, at=(0.0, 0.5, 0.9, 0.95, 0.99, 1.0), accuracy: int = 1000, most: int = 100_000) -> DataFrame:
    """Exact quantiles with linear interpolation, of values that are not null and numbers; nulls without any.

    A mergeable sketch brackets the ranks, a counting pass proves each bracket and says how many values it holds. Brackets
    of more than ``most`` different values are narrowed by another sketch of what they hold; then their values, counted,
    give the quantiles. No task and no driver has more values than ``most`` a quantile.
    """
    values = df.select(x.cast("double").alias("_x")).where("_x is not null and not isnan(_x)")
    names = [f"q{round(100 * p)}" for p in at]
    sketch = lambda v, a, b: F.percentile_approx(v, F.array(F.lit(max(a - 2 / accuracy, 0.0)), F.lit(min(b + 2 / accuracy, 1.0))), accuracy)
    first = values.agg(F.count("*").alias("n"), F.min("_x").alias("low"), F.max("_x").alias("high"), *(sketch(F.col("_x"), p, p).alias(f"b{i}") for i, p in enumerate(at))).first()
    n, low, high = first["n"], first["low"], first["high"]
    if not n:
        return df.sparkSession.createDataFrame([(None,) * len(at)], ", ".join(f"{c} double" for c in names))
    ranks = [(floor(p * (n - 1)), ceil(p * (n - 1))) for p in at]
    brackets = [tuple(first[f"b{i}"]) for i in range(len(at))]
    proven, narrow, missed = {}, set(), {}  # of a proven bracket: how many values lie before it
    while len(proven) < len(at):
        open_ = [i for i in range(len(at)) if i not in proven]
        inside = {i: (F.col("_x") >= brackets[i][0]) & (F.col("_x") <= brackets[i][1]) for i in open_}
        got = values.agg(*(c for i in open_ for c in (F.count_if(F.col("_x") < brackets[i][0]).alias(f"a{i}"), F.count_if(inside[i]).alias(f"c{i}"), F.approx_count_distinct(F.when(inside[i], F.col("_x")), 0.02).alias(f"d{i}")))).first()
        wide = {}
        for i in open_:
            before, held, different = got[f"a{i}"], got[f"c{i}"], got[f"d{i}"]
            if not (before <= ranks[i][0] and ranks[i][1] < before + held):
                if brackets[i] == (low, high):
                    raise ValueError(f"the values changed while their quantile {at[i]} was sought")
                brackets[i] = (low, high)  # the sketch was wrong: once more from all values, and what they give is taken
                missed[i] = missed.get(i, 0) + 1
            elif min(held, different) <= most or brackets[i][0] == brackets[i][1] or i in narrow or missed.get(i, 0) > 3:
                proven[i] = before
            else:
                wide[i] = ((ranks[i][0] - before) / held, (ranks[i][1] + 1 - before) / held)
        if wide:
            finer = values.agg(*(sketch(F.when(inside[i], F.col("_x")), *share).alias(f"b{i}") for i, share in wide.items())).first()
            narrow |= {i for i in wide if brackets[i] == tuple(finer[f"b{i}"])}  # a sketch of so few values can't part them
            brackets = [tuple(finer[f"b{i}"]) if i in wide else b for i, b in enumerate(brackets)]
    some = reduce(or_, [(F.col("_x") >= a) & (F.col("_x") <= b) for a, b in dict.fromkeys(brackets)])
    counted = sorted((r["_x"], r["n"]) for r in values.where(some).groupBy("_x").agg(F.count("*").alias("n")).collect())
    out = []
    for i, p in enumerate(at):
        end, found = proven[i], []
        for v, k in counted:
            if brackets[i][0] <= v <= brackets[i][1]:
                found += [v for r in ranks[i][len(found) :] if end <= r < end + k]
                end += k
        out.append(found[0] + (found[1] - found[0]) * (p * (n - 1) - ranks[i][0]))
    return df.sparkSession.createDataFrame([tuple(out)], ", ".join(f"{c} double" for c in names))


def runlog_latest(log: DataFrame, policy_id: str) -> DataFrame:
    """The latest good row per species; rows of the policy only, if there is any at all."""
    good = log.where((F.col("status") == "ok") & F.col("ts").isNotNull())
    has = good.agg(F.coalesce(F.max((F.col("policy_id") == policy_id).cast("int")), F.lit(0)).alias("_any"))  # one row
    w = Window.partitionBy("species_slug").orderBy(F.desc("ts"), "policy_id")
    return good.crossJoin(F.broadcast(has)).where((F.col("_any") == 0) | (F.col("policy_id") == policy_id)).drop("_any").withColumn("_rn", F.row_number().over(w)).where("_rn = 1").drop("_rn")


def policy_summary(log: DataFrame) -> DataFrame:
    """Adds dropped_total, kept_pct, top_drop_n and top_drop_reason (the first of equals, null if nothing was dropped)."""
    names = [c for c in log.columns if c.startswith("dropped_") and c != "dropped_total"]
    most = F.greatest(*names)
    which = F.element_at(F.array(*map(F.lit, names)), F.array_position(F.array(*names), most).cast("int"))
    return log.withColumns({
        "dropped_total": F.col("n_in") - F.col("n_out"),
        "kept_pct": F.round(100 * F.col("n_out") / F.greatest("n_in", F.lit(1)), 1),
        "top_drop_n": most,
        "top_drop_reason": F.when(most > 0, which),
    })


def policy_totals(log: DataFrame) -> DataFrame:
    out = log.agg(F.sum("n_in").alias("n_in"), F.sum("n_out").alias("n_out"))
    return out.withColumns({"dropped_total": F.col("n_in") - F.col("n_out"), "kept_pct": F.round(100 * F.col("n_out") / F.greatest("n_in", F.lit(1)), 1)})


def drop_reason_ranking(log: DataFrame, n: int = 12) -> DataFrame:
    names = [c for c in log.columns if c.startswith("dropped_") and c != "dropped_total"]
    long = log.unpivot(["species_slug"], names, "reason", "dropped")
    return long.groupBy("reason").agg(F.sum("dropped").alias("n_dropped")).where("n_dropped > 0").orderBy(F.desc("n_dropped"), "reason").limit(n)


# --- composed reports: (section, item, value), a row per figure -------------------------------------------------------


def _figures(section: str, df: DataFrame, item: Column, *values: str) -> DataFrame:
    """A row per value column of each row of df."""
    pairs = F.array(*(F.struct(F.concat(item, F.lit(f"{v}")).alias("item"), F.col(v).cast("double").alias("value")) for v in values))
    return df.select(F.lit(section).alias("section"), F.explode(pairs).alias("p")).select("section", "p.item", "p.value")


def _stack(frames: list[DataFrame]) -> DataFrame:
    out = frames[0]
    for f in frames[1:]:
        out = out.union(f)
    return out


def _named(*columns: str) -> Column:
    return F.concat(*(F.concat(F.coalesce(F.col(c).cast("string"), F.lit("-")), F.lit(" ")) for c in columns))


def policy_report(log: DataFrame, policy_id: str | None = None) -> DataFrame:
    """Stage 03: per species what went and why, totals, and the ranking of reasons. A policy_id takes its latest good rows of a log."""
    latest = log if policy_id is None else runlog_latest(log, policy_id)
    summary = policy_summary(latest)
    return _stack([
        _figures("species", summary, _named("species_slug"), "n_in", "n_out", "kept_pct", "dropped_total", "top_drop_n"),
        _figures("top reason", summary, _named("species_slug", "top_drop_reason"), "top_drop_n"),
        _figures("totals", policy_totals(latest), F.lit(""), "n_in", "n_out", "dropped_total", "kept_pct"),
        _figures("reasons", drop_reason_ranking(latest), _named("reason"), "n_dropped"),
    ])


def profile_report(df: DataFrame, in_sea: DataFrame, uncertainty: Column, inside: Column) -> DataFrame:
    """Stage 03's sanity figures: completeness, uncertainty, box, basis, year range, and points in the sea (in_sea: a column so named)."""
    place = F.col("lon").isNotNull() & F.col("lat").isNotNull()
    box = df.agg(F.count_if(inside).alias("n_inside"), F.count_if(place & ~inside).alias("n_outside"))
    sea = in_sea.agg(F.count("in_sea").alias("n_checked"), F.count_if("in_sea").alias("n_in_sea"))
    return _stack([
        _figures("completeness", completeness(df, uncertainty), F.lit(""), "n", "n_coords", "pct_coords", "n_uncertainty", "pct_uncertainty"),
        _figures("uncertainty", quantiles(df, uncertainty), F.lit(""), "q0", "q50", "q90", "q95", "q99", "q100"),
        _figures("box", box, F.lit(""), "n_inside", "n_outside"),
        _figures("basis", top(df, 12, "source", "basisOfRecord"), _named("source", "basisOfRecord"), "n"),
        _figures("range", ranges(df), F.lit(""), "min_year", "max_year"),
        _figures("sea", sea, F.lit(""), "n_checked", "n_in_sea"),
    ])


def crossdup_report(pre: DataFrame, prefer: str = "GBIF") -> DataFrame:
    """Cross-source duplicates of merged records (a stored table: each section reads it): inputs, precision, flags, what the strict rule drops, and what is left to review."""
    strict = flag_strict(pre, prefer)
    dropped = strict.where("strict_drop")
    totals = strict.agg(F.count("*").alias("n_merged"), F.count_if("strict_drop").alias("n_dropped"), F.count_if(~F.col("strict_drop")).alias("n_remaining"))
    count = lambda df, *c: df.groupBy(*c).agg(F.count("*").alias("n"))
    return _stack([
        _figures("rows", count(pre, "source"), _named("source"), "n"),
        _figures("totals", totals, F.lit(""), "n_merged", "n_dropped", "n_remaining"),
        _figures("precision", count(pre, "source", "date_precision"), _named("source", "date_precision"), "n"),
        _figures("flags", cross_dup_flags(pre).agg(F.count_if("flag_both_sources").alias("n_day"), F.count_if("flag_loose_year").alias("n_loose")), F.lit(""), "n_day", "n_loose"),
        _figures("dropped by precision", count(dropped, "source", "date_precision"), _named("source", "date_precision"), "n"),
        _figures("dropped by licence", count(dropped, "licence"), _named("licence"), "n"),
        _figures("dropped by year", top(dropped, 15, "year"), _named("year"), "n"),
        _figures("groups", dup_group_sizes(pre), _named("group_size"), "n_groups"),
        _figures("review", ambiguous_counts(pre), F.lit(""), "n_keys", "n_rows"),
    ])
