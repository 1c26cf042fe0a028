"""The leakage detector (I1-I9): five checks, a 0-100 score and a level.

``scan`` walks the schema (no job), then builds three lazy aggregates — the long
profile for correlations, one ``groupBy`` on the group key and one on the row
content — plus a bounded distinct count for categoricals.  The report is a
5-row DataFrame; nothing is collected except the schema-sized cardinality
estimates that decide which columns need an exact count.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions import tiers
from ..functions.numeric import round_half_even
from ..roles import Roles
from .duplicates import duplicate_count
from .profile import correlation_profile, distinct_counts, group_sizes

FLAGGED_T = T.ArrayType(T.StructType([T.StructField("feature", T.StringType()),
                                      T.StructField("corr", T.DoubleType())]))
REPORT_COLUMNS = ["check", "name", "risk", "message", "fix", "flagged", "columns",
                  "exact_dupes", "id_dupes", "n_groups", "n_multi_groups", "n_flagged", "weight"]


def _fmt_int(c) -> F.Column:
    return F.format_number(F.col(c) if isinstance(c, str) else c, 0)


def _fmt_fixed(c, digits) -> F.Column:
    """Python ``f"{x:.{d}f}"``: half-even on the value, then fixed notation (no grouping)."""
    x = round_half_even(c, digits)
    return F.regexp_replace(F.format_number(x, digits), ",", "")


def _row(df_one_row: DataFrame, check: int, **cols) -> DataFrame:
    """Shape one single-row aggregate into the report schema."""
    defaults = {
        "name": F.lit(tiers.CHECK_NAMES[check - 1]),
        "fix": F.lit(tiers.CHECK_FIXES[check - 1]),
        "flagged": F.lit(None).cast(FLAGGED_T),
        "columns": F.lit(None).cast("array<string>"),
        "exact_dupes": F.lit(None).cast("bigint"),
        "id_dupes": F.lit(None).cast("bigint"),
        "n_groups": F.lit(None).cast("bigint"),
        "n_multi_groups": F.lit(None).cast("bigint"),
        "n_flagged": F.lit(None).cast("bigint"),
    }
    defaults.update(cols)
    out = df_one_row.select(F.lit(check).alias("check"),
                            *[defaults[k].alias(k) for k in REPORT_COLUMNS
                              if k not in ("check", "weight")])
    return out.withColumn("weight", tiers.risk_weight("risk"))


def check_categorical(df: DataFrame, roles: Roles, max_unique: int = 100) -> DataFrame:
    cats = roles.categorical(df)
    spark = df.sparkSession
    if cats:
        d = distinct_counts(df, cats)
        one = d.agg(
            F.count(F.when(F.col("n_distinct") < max_unique, 1)).alias("n"),
            F.sort_array(F.collect_list(F.when(F.col("n_distinct") < max_unique,
                                               F.col("column")))).alias("cols"))
    else:
        one = spark.range(1).select(F.lit(0).cast("bigint").alias("n"),
                                    F.array().cast("array<string>").alias("cols"))
    n = F.col("n")
    return _row(one, 1, risk=tiers.categorical_risk(n),
                message=F.format_string(tiers.MSG_CHECK1.replace("{n}", "%s"), n.cast("string")),
                columns=F.col("cols"), n_flagged=n.cast("bigint"))


def correlation_table(df: DataFrame, roles: Roles) -> DataFrame:
    """|corr| of every numeric feature (minus target and id, group kept) with the target."""
    feats = roles.numeric(df, keep_group=True)
    p = correlation_profile(df, roles.target, feats)
    return p.select(F.col("column").alias("feature"), F.abs("corr_target").alias("abs_corr"))


def check_correlation(df: DataFrame, roles: Roles, top: int = 5) -> DataFrame:
    feats = roles.numeric(df, keep_group=True)
    spark = df.sparkSession
    if not feats:
        one = spark.range(1)
        return _row(one, 2, risk=F.lit("CLEAN"), message=F.lit(tiers.MSG_CHECK2_NONE),
                    fix=F.lit(tiers.FIX_NO_NUMERIC), n_flagged=F.lit(0).cast("bigint"))
    c = correlation_table(df, roles).where(F.col("abs_corr").isNotNull())
    a = F.col("abs_corr")
    ranked = F.sort_array(F.collect_list(F.when(a > 0.5, F.struct((-a).alias("k"), F.col("feature")))))
    one = c.agg(
        F.count(F.when(a > 0.8, 1)).alias("n_critical"),
        F.count(F.when((a > 0.5) & (a <= 0.8), 1)).alias("n_high"),
        F.count(F.when(a > 0.3, 1)).alias("n_medium"),
        F.count(F.when(a > 0.5, 1)).alias("n_over"),
        ranked.alias("ranked"))
    flagged = F.transform(F.slice("ranked", 1, top),
                          lambda s: F.struct(s["feature"].alias("feature"),
                                             round_half_even(-s["k"], 4).alias("corr")))
    msg = F.format_string("%s critical (>0.8), %s high (>0.5) correlation features.",
                          F.col("n_critical").cast("string"), F.col("n_high").cast("string"))
    return _row(one, 2, risk=tiers.correlation_risk("n_critical", "n_high", "n_medium"),
                message=msg, flagged=flagged, n_flagged=F.col("n_over").cast("bigint"))


def check_time(df: DataFrame, roles: Roles, by_type: bool = False) -> DataFrame:
    cols = roles.time_named(df, by_type=by_type)
    one = df.sparkSession.range(1)
    return _row(one, 3, risk=F.lit("MEDIUM" if cols else "LOW"),
                message=F.lit(tiers.MSG_CHECK3.format(n=len(cols))),
                columns=F.array(*[F.lit(c) for c in cols]).cast("array<string>"),
                n_flagged=F.lit(len(cols)).cast("bigint"))


def check_groups(df: DataFrame, roles: Roles) -> DataFrame:
    col = roles.group or roles.id
    if not col or col not in df.columns:
        one = df.sparkSession.range(1)
        return _row(one, 4, risk=F.lit("UNKNOWN"), message=F.lit(tiers.MSG_CHECK4_NONE),
                    fix=F.lit(tiers.FIX_NO_GROUP))
    g = group_sizes(df, col)
    share = F.col("multi_share")
    msg = F.format_string("%s of %s groups (%s%%) have multiple rows.",
                          _fmt_int("n_multi_groups"), _fmt_int("n_groups"),
                          F.coalesce(_fmt_fixed(share * 100, 1), F.lit("nan")))
    return _row(g, 4, risk=tiers.group_risk("n_multi_groups", F.coalesce(share, F.lit(0.0))),
                message=msg, n_groups=F.col("n_groups"), n_multi_groups=F.col("n_multi_groups"))


def check_duplicates(df: DataFrame, roles: Roles) -> DataFrame:
    d = duplicate_count(df)
    if roles.id and roles.id in df.columns:
        ids = group_sizes(df, roles.id).select(F.col("n_multi_groups").alias("id_dupes"))
        d = d.withColumn("id_dupes", ids.scalar())
    else:
        d = d.withColumn("id_dupes", F.lit(0).cast("bigint"))
    pct = F.try_divide(F.col("exact_dupes") * 100.0, F.col("n_rows"))
    msg = F.format_string("%s exact duplicate rows (%s%%). %s duplicate IDs.",
                          _fmt_int("exact_dupes"), F.coalesce(_fmt_fixed(pct, 2), F.lit("nan")),
                          _fmt_int("id_dupes"))
    return _row(d, 5, risk=tiers.duplicate_risk("exact_dupes", F.coalesce(pct, F.lit(0.0))),
                message=msg, exact_dupes=F.col("exact_dupes"), id_dupes=F.col("id_dupes"))


def scan(df: DataFrame, roles: Roles, by_type_time: bool = False) -> DataFrame:
    """I8: the five-check report (one row per check, fixed schema)."""
    roles = roles.check(df)
    parts = [check_categorical(df, roles), check_correlation(df, roles),
             check_time(df, roles, by_type_time), check_groups(df, roles),
             check_duplicates(df, roles)]
    return reduce(DataFrame.unionByName, parts)


def score(report: DataFrame) -> DataFrame:
    """``score`` = capped sum of risk weights, ``level`` and ``advice``."""
    s = report.agg(F.least(F.coalesce(F.sum("weight"), F.lit(0)),
                           F.lit(tiers.SCORE_CAP)).cast("int").alias("score"))
    return (s.withColumn("level", tiers.score_level("score"))
             .withColumn("advice", tiers.level_advice("level")))


def scan_with_score(df: DataFrame, roles: Roles) -> tuple[DataFrame, DataFrame]:
    """Report and summary from ONE execution of the checks (the 5 report rows are materialised)."""
    rep = scan(df, roles)
    rep = df.sparkSession.createDataFrame(rep.collect(), rep.schema)
    return rep, score(rep)


def severity_chart(report: DataFrame) -> DataFrame:
    """Per-check severity value for the risk chart."""
    return report.select("check", "name", "risk", tiers.risk_severity("risk").alias("severity"))


def score_bar(summary: DataFrame) -> DataFrame:
    """The two pieces of the 0-100 score bar, ``part, left, width``: the score, and the rest behind it."""
    top = F.lit(tiers.SCORE_CAP)
    pieces = F.array(F.struct(F.lit("score").alias("part"), F.lit(0).alias("left"), F.col("score").alias("width")),
                     F.struct(F.lit("rest").alias("part"), F.col("score").alias("left"), (top - F.col("score")).alias("width")))
    return summary.select("level", F.inline(pieces))
