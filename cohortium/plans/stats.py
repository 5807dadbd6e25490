"""Group-difference tests: Welch t-test with Cohen's d, chi-square on a 2×2 table.

The data work is one grouped aggregate (count, mean, sample variance per
group) or one 2×2 count; the statistics are columns over that one-row
result. Only the p-values need special functions; they are computed by a
small vectorised pandas UDF (regularised incomplete beta and ``erfc`` from
the standard library), so no statistics package is required.
"""

from __future__ import annotations

import math

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cohortium.operators.scalars import attach_one_row
from cohortium.operators.selection import few_group_percentiles
from cohortium.session import ensure_checkpoint_dir

# Fixed values from the reference: effect-size band edges and labels.
EFFECT_BANDS = [(0.2, "negligible"), (0.5, "small"), (0.8, "medium")]
EFFECT_TOP = "large"
DEFAULT_ALPHA = 0.05
MIN_GROUP_N = 30


def _betacf(a: float, b: float, x: float) -> float:
    """Continued fraction of the incomplete beta function (modified Lentz)."""
    tiny = 1e-300
    qab, qap, qam = a + b, a + 1.0, a - 1.0
    c, d = 1.0, 1.0 - qab * x / qap
    d = tiny if abs(d) < tiny else d
    d = 1.0 / d
    h = d
    for m in range(1, 400):
        m2 = 2 * m
        aa = m * (b - m) * x / ((qam + m2) * (a + m2))
        d = 1.0 + aa * d
        d = tiny if abs(d) < tiny else d
        c = 1.0 + aa / c
        c = tiny if abs(c) < tiny else c
        d = 1.0 / d
        h *= d * c
        aa = -(a + m) * (qab + m) * x / ((a + m2) * (qap + m2))
        d = 1.0 + aa * d
        d = tiny if abs(d) < tiny else d
        c = 1.0 + aa / c
        c = tiny if abs(c) < tiny else c
        d = 1.0 / d
        delta = d * c
        h *= delta
        if abs(delta - 1.0) < 1e-15:
            break
    return h


def reg_inc_beta(a: float, b: float, x: float) -> float:
    """Regularised incomplete beta I_x(a, b)."""
    if x <= 0.0:
        return 0.0
    if x >= 1.0:
        return 1.0
    ln_front = math.lgamma(a + b) - math.lgamma(a) - math.lgamma(b) + a * math.log(x) + b * math.log1p(-x)
    front = math.exp(ln_front)
    if x < (a + 1.0) / (a + b + 2.0):
        return front * _betacf(a, b, x) / a
    return 1.0 - front * _betacf(b, a, 1.0 - x) / b


def student_t_cdf(t: float, df: float) -> float:
    if t is None or df is None or math.isnan(t) or math.isnan(df) or df <= 0:
        return float("nan")
    x = df / (df + t * t)
    tail = 0.5 * reg_inc_beta(df / 2.0, 0.5, x)
    return 1.0 - tail if t > 0 else tail


@F.pandas_udf(T.DoubleType())
def t_cdf_udf(t: pd.Series, df: pd.Series) -> pd.Series:
    return pd.Series([student_t_cdf(a, b) for a, b in zip(t, df)], dtype="float64")


@F.pandas_udf(T.DoubleType())
def chi2_1dof_sf_udf(x: pd.Series) -> pd.Series:
    return pd.Series([math.erfc(math.sqrt(v / 2.0)) if v == v and v >= 0 else float("nan") for v in x],
                     dtype="float64")


def welch_stats(df: DataFrame, value: str = "total_events", flag: str = "is_churned") -> DataFrame:
    """Welch t (group flag=0 minus flag=1), Welch–Satterthwaite df, Cohen's d and its band.

    One aggregate with conditional moments: both groups in one row.
    """
    v = F.col(value).cast("double")
    g0 = F.col(flag) == 0
    g1 = F.col(flag) == 1
    a = df.agg(
        F.count_if(g0 & v.isNotNull()).alias("n_active"), F.avg(F.when(g0, v)).alias("mean_active"),
        F.var_samp(F.when(g0, v)).alias("var_active"),
        F.count_if(g1 & v.isNotNull()).alias("n_churned"), F.avg(F.when(g1, v)).alias("mean_churned"),
        F.var_samp(F.when(g1, v)).alias("var_churned"))
    se2_a = F.col("var_active") / F.col("n_active")
    se2_c = F.col("var_churned") / F.col("n_churned")
    t = (F.col("mean_active") - F.col("mean_churned")) / F.sqrt(se2_a + se2_c)
    dof = (se2_a + se2_c) ** 2 / (se2_a ** 2 / (F.col("n_active") - 1) + se2_c ** 2 / (F.col("n_churned") - 1))
    pooled = F.sqrt((F.col("var_active") + F.col("var_churned")) / 2)
    d = F.when(pooled > 0, (F.col("mean_active") - F.col("mean_churned")) / pooled).otherwise(F.lit(0.0))
    band = F.lit(EFFECT_TOP)
    for edge, label in reversed(EFFECT_BANDS):
        band = F.when(F.abs(F.col("cohens_d")) < edge, F.lit(label)).otherwise(band)
    out = a.withColumns({"t_stat": t, "welch_df": dof, "cohens_d": d})
    return out.withColumns({
        "std_active": F.sqrt("var_active"), "std_churned": F.sqrt("var_churned"), "effect_size": band,
        "n_ok": (F.col("n_active") > MIN_GROUP_N) & (F.col("n_churned") > MIN_GROUP_N)})


def welch_test(df: DataFrame, value: str = "total_events", flag: str = "is_churned",
               alpha: float = DEFAULT_ALPHA) -> DataFrame:
    """:func:`welch_stats` plus p-values and the decision at ``alpha``.

    ``p_two_sided``; ``p_half`` = two-sided / 2 as the reference reports it;
    ``p_one_sided`` = P(T ≥ t) for H1 "active > churned" (differs from
    ``p_half`` when t is negative).
    """
    s = welch_stats(df, value, flag)
    cdf = t_cdf_udf(F.col("t_stat"), F.col("welch_df"))
    s = s.withColumn("_cdf", cdf)
    s = s.withColumns({
        "p_two_sided": 2 * F.least(F.col("_cdf"), 1 - F.col("_cdf")),
        "p_one_sided": 1 - F.col("_cdf")}).drop("_cdf")
    s = s.withColumn("p_half", F.col("p_two_sided") / 2)
    return s.withColumn("decision", F.when(F.col("p_half") < alpha, F.lit("reject H0"))
                        .otherwise(F.lit("fail to reject H0")))


def churn_contingency(df: DataFrame, value: str = "total_events", flag: str = "is_churned") -> DataFrame:
    """2×2 table: high engagement (value > exact median) × churn flag, zero cells included.

    The two columns are kept once, so that the customer-360 behind them is not computed
    again for the median.
    """
    ensure_checkpoint_dir(df.sparkSession)
    df = df.select(value, flag).checkpoint()
    m = attach_one_row(df, few_group_percentiles(df, [], value, {"median": 0.5}))
    hi = (F.col(value) > F.col("median")).cast("int")
    return m.groupBy(hi.alias("high_engagement")).agg(
        F.count_if(F.col(flag) == 0).alias("churned_0"), F.count_if(F.col(flag) == 1).alias("churned_1"))


def chi_square_engagement(df: DataFrame, value: str = "total_events", flag: str = "is_churned") -> DataFrame:
    """Chi-square test of independence on the 2×2 table, with Yates' continuity
    correction (the default for one degree of freedom)."""
    ct = churn_contingency(df, value, flag)
    c = ct.agg(
        F.sum(F.when(F.col("high_engagement") == 0, F.col("churned_0"))).alias("o00"),
        F.sum(F.when(F.col("high_engagement") == 0, F.col("churned_1"))).alias("o01"),
        F.sum(F.when(F.col("high_engagement") == 1, F.col("churned_0"))).alias("o10"),
        F.sum(F.when(F.col("high_engagement") == 1, F.col("churned_1"))).alias("o11"))
    c = c.select(*[F.coalesce(F.col(x), F.lit(0)).cast("long").alias(x) for x in ("o00", "o01", "o10", "o11")])
    n = F.col("o00") + F.col("o01") + F.col("o10") + F.col("o11")
    r0, r1 = F.col("o00") + F.col("o01"), F.col("o10") + F.col("o11")
    c0, c1 = F.col("o00") + F.col("o10"), F.col("o01") + F.col("o11")
    terms = []
    for o, r, k in (("o00", r0, c0), ("o01", r0, c1), ("o10", r1, c0), ("o11", r1, c1)):
        e = r * k / n
        dev = F.abs(F.col(o) - e)
        terms.append((dev - F.least(dev, F.lit(0.5))) ** 2 / e)
    chi2 = terms[0] + terms[1] + terms[2] + terms[3]
    out = c.withColumn("chi2", chi2).withColumn("dof", F.lit(1))
    return out.withColumn("p_value", chi2_1dof_sf_udf(F.col("chi2")))


def chi_square_test(df: DataFrame, value: str = "total_events", flag: str = "is_churned",
                    alpha: float = DEFAULT_ALPHA) -> DataFrame:
    """:func:`chi_square_engagement` plus the decision at ``alpha``."""
    out = chi_square_engagement(df, value, flag)
    return out.withColumn("decision", F.when(F.col("p_value") < alpha, F.lit("reject H0")).otherwise(F.lit("fail to reject H0")))
