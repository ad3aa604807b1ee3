"""Offline evaluation metrics as Spark aggregates.

Every metric is computed over a scored DataFrame ``(label, prediction, ...)``
in a fixed number of passes; nothing is collected except one-row results.
Exact ROC-AUC and average precision use per-score counts and a distributed
prefix sum over the distinct scores (``global_prefix_sum``), never a
single-partition window.
"""
from __future__ import annotations

import numpy as np
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lotwise.contracts import SPLITS
from lotwise.operators.ranks import global_prefix_sum, global_row_number, with_decile_by_rank
from lotwise.operators.selection import column_median, join_quantiles


# ---------------------------------------------------------------------------- S1
def temporal_split(df: DataFrame, date_col: str = "observation_date", train_end: str = SPLITS["train_end"],
                   validation_end: str = SPLITS["validation_end"], test_end: str = SPLITS["test_end"]):
    """Train / validation / test by comparing with the cut-off midnights."""
    d = F.col(date_col).cast("timestamp_ntz")
    tr, va, te = (F.lit(x).cast("timestamp_ntz") for x in (train_end, validation_end, test_end))
    return df.filter(d <= tr), df.filter((d > tr) & (d <= va)), df.filter((d > va) & (d <= te))


# ---------------------------------------------------------------------------- S2
def regression_metrics(df: DataFrame, y: str = "y", p: str = "p", by: list[str] | None = None) -> DataFrame:
    """mae, rmse, r2, median_ae, mape (|y| floored at 1e4), smape, residual mean
    and population std.  ``by`` gives error slices (S17)."""
    yc, pc = F.col(y).cast("double"), F.col(p).cast("double")
    resid = yc - pc
    agg = df.groupBy(*(by or [])).agg(F.avg(F.abs(resid)).alias("mae"),
                F.sqrt(F.avg(resid * resid)).alias("rmse"),
                F.sum(resid * resid).alias("__ss_res"),
                F.var_pop(yc).alias("__var_y"), F.count(F.lit(1)).alias("n"),
                F.avg(F.abs(resid) / F.greatest(F.abs(yc), F.lit(1e4))).alias("mape"),
                F.avg(2 * F.abs(resid) / (F.abs(yc) + F.abs(pc) + F.lit(1e-9))).alias("smape"),
                F.avg(resid).alias("residual_mean"),
                F.stddev_pop(resid).alias("residual_std"))
    r2 = F.lit(1.0) - F.col("__ss_res") / (F.col("__var_y") * F.col("n"))
    errors = df.select(*(by or []), F.abs(resid).alias("__error"))
    if by:
        agg = join_quantiles(agg, errors, by, "__error", {"median_ae": 0.5})
    else:
        agg = agg.withColumn("median_ae", column_median(errors, "__error"))
    return agg.withColumn("r2", r2).drop("__ss_res", "__var_y")


# ---------------------------------------------------------------------------- S3
def interval_metrics(df: DataFrame, y: str = "y", lo: str = "lo", hi: str = "hi") -> DataFrame:
    yc = F.col(y).cast("double")
    return df.agg(F.avg(((yc >= F.col(lo)) & (yc <= F.col(hi))).cast("double")).alias("p10_p90_coverage"),
                  F.avg(F.col(hi) - F.col(lo)).alias("mean_interval_width"),
                  F.avg((F.col(hi) - F.col(lo)) / F.greatest(yc, F.lit(1e4))).alias("mean_relative_width"))


# ---------------------------------------------------------------------------- S4
def calibration_bin(p: Column, bins: int = 10) -> Column:
    """Bin index by comparison with ``linspace(0, 1, bins + 1)`` edges (the last
    bin is closed); NULL outside [0, 1]."""
    edges = np.linspace(0, 1, bins + 1)
    idx = sum((p >= F.lit(float(e))).cast("int") for e in edges[1:-1])
    return F.when((p >= 0) & (p <= 1), idx)


def expected_calibration_error(df: DataFrame, y: str = "y", p: str = "p", bins: int = 10) -> DataFrame:
    pc = F.col(p).cast("double")
    per_bin = (df.withColumn("__bin", calibration_bin(pc, bins))
               .groupBy("__bin").agg(F.count(F.lit(1)).alias("n"), F.avg(F.col(y).cast("double")).alias("yr"),
                                     F.avg(pc).alias("pm")))
    total = per_bin.agg(F.sum("n").alias("__rows"))
    return (per_bin.filter(F.col("__bin").isNotNull()).crossJoin(F.broadcast(total))
            .agg(F.coalesce(F.sum(F.col("n") / F.col("__rows") * F.abs(F.col("yr") - F.col("pm"))), F.lit(0.0))
                 .alias("ece")))


# ---------------------------------------------------------------------------- S5
def _score_counts(df: DataFrame, y: str, p: str) -> DataFrame:
    return (df.groupBy(F.col(p).cast("double").alias("score"))
              .agg(F.sum(F.col(y).cast("long")).alias("pos"), F.count(F.lit(1)).alias("cnt"))
              .withColumn("neg", F.col("cnt") - F.col("pos")))


def roc_pr_auc(df: DataFrame, y: str = "y", p: str = "p") -> DataFrame:
    """Exact ROC-AUC (ties count one half) and average precision."""
    counts = _score_counts(df, y, p)
    asc = global_prefix_sum(counts, [F.col("score").asc()], ["neg"])
    auc_parts = asc.select("score", "pos", "neg",
                           (F.col("pos") * (F.col("cum_neg") - F.col("neg") + 0.5 * F.col("neg"))).alias("num"))
    desc = global_prefix_sum(counts, [F.col("score").desc()], ["pos", "cnt"])
    ap_parts = desc.select((F.col("pos") * F.col("cum_pos") / F.col("cum_cnt")).alias("ap_num"))
    tot = counts.agg(F.sum("pos").alias("__npos"), F.sum("neg").alias("__nneg"))
    ok = (F.col("__npos") > 0) & (F.col("__nneg") > 0)
    auc = auc_parts.agg(F.sum("num").alias("num")).crossJoin(tot).select(
        F.when(ok, F.col("num") / (F.col("__npos") * F.col("__nneg"))).alias("roc_auc"))
    ap = ap_parts.agg(F.sum("ap_num").alias("s")).crossJoin(tot).select(
        F.when(ok, F.col("s") / F.col("__npos")).alias("pr_auc"))
    return auc.crossJoin(ap)


def classification_metrics(df: DataFrame, y: str = "y", p: str = "p", threshold: float = 0.5,
                           tiebreak: str | None = None) -> DataFrame:
    """One-row table: roc_auc, pr_auc, log_loss, brier, ece, precision/recall/f1
    at ``threshold``, base_rate, and precision/recall/lift in the top 5 % / 10 %."""
    yc, pc = F.col(y).cast("double"), F.col(p).cast("double")
    q = F.least(F.greatest(pc, F.lit(1e-6)), F.lit(1 - 1e-6))
    yhat = (pc >= threshold).cast("double")
    basic = df.agg(
        F.avg(-(yc * F.log(q) + (1 - yc) * F.log(1 - q))).alias("log_loss"),
        F.avg((pc - yc) * (pc - yc)).alias("brier"),
        F.sum(yhat * yc).alias("__tp"), F.sum(yhat).alias("__pp"), F.sum(yc).alias("__pos"),
        F.avg(yc).alias("base_rate"), F.count(F.lit(1)).alias("n"))
    prec = F.when(F.col("__pp") > 0, F.col("__tp") / F.col("__pp")).otherwise(0.0)
    rec = F.when(F.col("__pos") > 0, F.col("__tp") / F.col("__pos")).otherwise(0.0)
    basic = (basic.withColumn("precision", prec).withColumn("recall", rec)
             .withColumn("f1", F.when(F.col("precision") + F.col("recall") > 0,
                                      2 * F.col("precision") * F.col("recall")
                                      / (F.col("precision") + F.col("recall"))).otherwise(0.0))
             .withColumn("threshold", F.lit(float(threshold))))
    tagged = df.select(yc.alias("__y"), pc.alias("__p"), *([F.col(tiebreak)] if tiebreak else []))
    if not tiebreak:
        tagged = tagged.withColumn("__rid", F.monotonically_increasing_id())
        order = [F.col("__p").desc(), F.col("__rid")]
    else:
        order = [F.col("__p").desc(), F.col(tiebreak)]
    ranked = global_row_number(tagged, order, "__rank", total="__n")
    tops = []
    for frac, name in ((0.05, "top5pct"), (0.10, "top10pct")):
        k = F.greatest(F.floor(F.col("__n") * frac), F.lit(1))
        tops.append(F.avg(F.when(F.col("__rank") <= k, F.col("__y"))).alias(f"precision_{name}"))
        tops.append(F.sum(F.when(F.col("__rank") <= k, F.col("__y"))).alias(f"__hits_{name}"))
    top = ranked.agg(*tops, F.sum("__y").alias("__npos_top"), F.avg("__y").alias("__br"))
    for name in ("top5pct", "top10pct"):
        top = (top.withColumn(f"recall_{name}", F.col(f"__hits_{name}") / F.greatest(F.col("__npos_top"), F.lit(1.0)))
                  .withColumn(f"lift_{name}", F.col(f"precision_{name}") / F.greatest(F.col("__br"), F.lit(1e-9))))
    top = top.drop("__hits_top5pct", "__hits_top10pct", "__npos_top", "__br")
    out = (roc_pr_auc(df, y, p).crossJoin(basic).crossJoin(expected_calibration_error(df, y, p)).crossJoin(top))
    return out.drop("__tp", "__pp", "__pos")


# ---------------------------------------------------------------------------- S7
def lift_table(df: DataFrame, y: str = "y", p: str = "p", deciles: int = 10,
               tiebreak: str | None = None) -> DataFrame:
    base = df.select(F.col(y).cast("double").alias("y"), F.col(p).cast("double").alias("p"),
                     *([F.col(tiebreak).alias("__tb")] if tiebreak else
                       [F.monotonically_increasing_id().alias("__tb")]))
    dec = with_decile_by_rank(base, [F.col("p").desc(), F.col("__tb")], deciles, "decile")
    g = dec.groupBy("decile").agg(F.count(F.lit(1)).alias("n"), F.avg("p").alias("mean_prediction"),
                                  F.avg("y").alias("actual_rate"), F.sum("y").alias("conversions"))
    tot = base.agg(F.sum("y").alias("__npos"), F.avg("y").alias("__br"))
    w = Window.orderBy("decile").rowsBetween(Window.unboundedPreceding, 0)   # <= `deciles` rows
    return (g.crossJoin(F.broadcast(tot))
            .withColumn("cumulative_conversions", F.sum("conversions").over(w))
            .withColumn("cumulative_gain", F.col("cumulative_conversions") / F.greatest(F.col("__npos"), F.lit(1.0)))
            .withColumn("lift", F.col("actual_rate") / F.greatest(F.col("__br"), F.lit(1e-9)))
            .drop("__npos", "__br"))


# ---------------------------------------------------------------------------- S8
DEFAULT_THRESHOLDS = tuple(float(t) for t in np.round(np.arange(0.05, 0.95, 0.05), 2))


def threshold_table(df: DataFrame, y: str = "y", p: str = "p",
                    thresholds: tuple[float, ...] = DEFAULT_THRESHOLDS) -> DataFrame:
    """Precision / recall / F1 / selection at each threshold.  Rows are counted
    once into the threshold grid cell they fall in (no rows x thresholds
    fan-out); suffix sums over the grid give each threshold's counts."""
    spark = df.sparkSession
    pc = F.col(p).cast("double")
    cell = sum((pc >= F.lit(t)).cast("int") for t in thresholds)
    cells = df.groupBy(cell.alias("cell")).agg(F.count(F.lit(1)).alias("n"),
                                               F.sum(F.col(y).cast("double")).alias("pos"))
    grid = spark.createDataFrame([(i + 1, t) for i, t in enumerate(thresholds)], "cell_min int, threshold double")
    joined = grid.join(F.broadcast(cells), F.col("cell") >= F.col("cell_min"), "left")
    tot = cells.agg(F.sum("n").alias("__rows"), F.sum("pos").alias("__npos"))
    t = (joined.groupBy("threshold").agg(F.coalesce(F.sum("n"), F.lit(0)).alias("sel"),
                                         F.coalesce(F.sum("pos"), F.lit(0.0)).alias("tp"))
         .crossJoin(F.broadcast(tot)))
    prec = F.when(F.col("sel") > 0, F.col("tp") / F.col("sel")).otherwise(0.0)
    rec = F.when(F.col("__npos") > 0, F.col("tp") / F.col("__npos")).otherwise(0.0)
    return (t.withColumn("precision", prec).withColumn("recall", rec)
            .withColumn("f1", F.when(F.col("precision") + F.col("recall") > 0,
                                     2 * F.col("precision") * F.col("recall") / (F.col("precision") + F.col("recall")))
                        .otherwise(0.0))
            .withColumn("predicted_positive_rate", F.col("sel") / F.col("__rows"))
            .select("threshold", "precision", "recall", "f1", "predicted_positive_rate",
                    F.col("sel").cast("long").alias("leads_selected")))


def best_f1_threshold(df: DataFrame, y: str = "y", p: str = "p") -> DataFrame:
    """Threshold with the highest F1 on validation (smallest on ties)."""
    t = threshold_table(df, y, p)
    return t.agg(F.min_by("threshold", F.struct(-F.col("f1"), F.col("threshold"))).alias("threshold"))


# ---------------------------------------------------------------------------- S9
def reliability_curve(df: DataFrame, y: str = "y", p: str = "p", bins: int = 10) -> DataFrame:
    pc = F.col(p).cast("double")
    b = F.least(F.greatest((pc * bins).cast("int"), F.lit(0)), F.lit(bins - 1))
    return df.groupBy(b.alias("bin")).agg(F.avg(pc).alias("mean_predicted"),
                                          F.avg(F.col(y).cast("double")).alias("observed_rate"),
                                          F.count(F.lit(1)).cast("long").alias("n"))


# --------------------------------------------------------------------------- S11
_POISSON1_CDF = np.cumsum([np.exp(-1.0) / np.prod(np.arange(1, k + 1)) for k in range(0, 13)])


def poisson1_weight(u: Column) -> Column:
    """Poisson(1) draw by inverse CDF of a uniform column."""
    expr = F.lit(len(_POISSON1_CDF))
    for k in range(len(_POISSON1_CDF) - 1, -1, -1):
        expr = F.when(u < F.lit(float(_POISSON1_CDF[k])), F.lit(k)).otherwise(expr)
    return expr


def bootstrap_ratio_ci(df: DataFrame, unit: str, numerator: str, denominator: str | None = None,
                       n_boot: int = 200, seed: int = 42, alpha: float = 0.05) -> DataFrame:
    """Cluster (unit-level) Poisson bootstrap of sum(num)/sum(den).

    Rows are first summed per unit; each (unit, replicate) weight is a Poisson(1)
    draw from a hash of (unit, replicate, seed).  Replicates are generated and
    combined inside one aggregation (partial aggregation keeps one row per
    replicate per task), and multiplicity is kept for every unit count."""
    den = F.col(denominator).cast("double") if denominator else F.lit(1.0)
    units = df.groupBy(unit).agg(F.sum(F.col(numerator).cast("double")).alias("__num"), F.sum(den).alias("__den"))
    rep = units.withColumn("__r", F.explode(F.sequence(F.lit(0), F.lit(n_boot - 1))))
    h = F.xxhash64(F.col(unit).cast("string"), F.col("__r"), F.lit(seed))
    u = (F.abs(h % F.lit(1 << 52)).cast("double") / float(1 << 52))
    rep = rep.withColumn("__w", poisson1_weight(u))
    stats = (rep.groupBy("__r").agg((F.sum(F.col("__w") * F.col("__num"))
                                     / F.sum(F.col("__w") * F.col("__den"))).alias("stat"))
             .filter(F.col("stat").isNotNull() & ~F.isnan("stat")))
    return stats.agg(F.avg("stat").alias("mean"),
                     F.percentile("stat", alpha / 2).alias("ci_low"),
                     F.percentile("stat", 1 - alpha / 2).alias("ci_high"),
                     F.count(F.lit(1)).cast("long").alias("n_boot"))
