"""Probability calibration: Brier score, reliability bins, adaptive error.

Score tables hold one row per ticket with ``scores array<struct<label, p, margin>>``,
so softmax, argmax and confidence are row-local.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quarrydesk.functions.numeric import let
from quarrydesk.functions.quantiles import exact_quantiles

# --- fixed values -----------------------------------------------------------
BINS = 10
# ----------------------------------------------------------------------------
SOFTMAX_DIGITS = 12


def softmax(scores: Column, field: str = "margin") -> Column:
    """Scores with ``p`` replaced by the softmax of ``field`` over the row.

    Rounded to 12 digits: rows with the same margins in another order must tie,
    because quantile bins depend on ties.
    """
    def normalise(scores: Column, top: Column, total: Column) -> Column:
        return F.transform(scores, lambda s: F.struct(
            s["label"].alias("label"), F.round(F.exp(s[field] - top) / total, SOFTMAX_DIGITS).alias("p"),
            s["margin"].alias("margin")))

    def shifted(scores: Column, top: Column) -> Column:
        total = F.aggregate(scores, F.lit(0.0), lambda acc, s: acc + F.exp(s[field] - top))
        return let(total, lambda t: normalise(scores, top, t))

    return let(scores, lambda row: let(F.array_max(F.transform(row, lambda s: s[field])), lambda top: shifted(row, top)))


def raw_softmax(df: DataFrame) -> DataFrame:
    return df.withColumn("scores", softmax(F.col("scores")))


def long_scores(df: DataFrame, truth: str = "truth") -> DataFrame:
    """(label, hit, p): one row per ticket and class."""
    return df.select(F.col(truth).alias("_truth"), F.inline("scores")).select(
        "label", (F.col("_truth") == F.col("label")).cast("double").alias("hit"), "p")


def brier(long: DataFrame, by: tuple[str, ...] = ("label",)) -> DataFrame:
    """Mean squared gap between hit and probability, per class."""
    return long.groupBy(*by).agg(F.avg(F.pow(F.col("hit") - F.col("p"), 2)).alias("brier"))


def quantile_bins(long: DataFrame, bins: int = BINS, by: tuple[str, ...] = ("label",)) -> DataFrame:
    """Add ``bin``: how many inner quantile edges of the class (or of ``by``) lie below p.

    Classes are few, so their edges are a small broadcast table; finer groups leave the join to the optimiser.
    """
    inner, few = [i / bins for i in range(1, bins)], by == ("label",)
    edges = exact_quantiles(long, "p", inner, by=list(by), few_groups=few).select(*by, F.col("quantiles").alias("_edges"))
    below = F.aggregate("_edges", F.lit(0), lambda n, e: n + F.when(e < F.col("p"), 1).otherwise(0))
    return long.join(F.broadcast(edges) if few else edges, list(by)).withColumn("bin", below).drop("_edges")


def uniform_bins(long: DataFrame, bins: int = BINS) -> DataFrame:
    """Equal-width bins: the number of inner edges i / bins below p."""
    below = sum(((F.lit(i / bins) < F.col("p")).cast("int") for i in range(1, bins)), F.lit(0))
    return long.withColumn("bin", below)


def reliability_curve(binned: DataFrame, by: tuple[str, ...] = ("label",)) -> DataFrame:
    """Fraction of positives and mean prediction of each non-empty bin."""
    return binned.groupBy(*by, "bin").agg(F.avg("hit").alias("fraction_positive"), F.avg("p").alias("mean_predicted"),
                                              F.count("*").alias("n"))


def adaptive_error(curve: DataFrame, by: tuple[str, ...] = ("label",)) -> DataFrame:
    """Unweighted mean gap over non-empty bins, per class."""
    gap = F.abs(F.col("fraction_positive") - F.col("mean_predicted"))
    return curve.groupBy(*by).agg(F.avg(gap).alias("ece"))


def calibration_by_class(long: DataFrame, bins: int = BINS) -> DataFrame:
    curve = reliability_curve(quantile_bins(long, bins))
    return brier(long).join(adaptive_error(curve), "label")


def calibration_report(calibrated: DataFrame, raw: DataFrame | None = None, bins: int = BINS) -> DataFrame:
    """Per-class and mean Brier and error, calibrated against raw when given.

    The row ``(mean)`` averages the classes; ``brier_reduction_pct`` is set there
    when the raw Brier score is positive.
    """
    report = calibration_by_class(calibrated, bins).select(
        "label", F.col("brier").alias("calibrated_brier"), F.col("ece").alias("calibrated_ece"))
    names = ["calibrated_brier", "calibrated_ece"]
    if raw is not None:
        other = calibration_by_class(raw, bins).select(
            "label", F.col("brier").alias("raw_brier"), F.col("ece").alias("raw_ece"))
        report = report.join(other, "label")
        names += ["raw_brier", "raw_ece"]
    # One row per class: the mean over a class is its own value, the rollup total is the macro mean.
    both = report.rollup("label").agg(*[F.avg(n).alias(n) for n in names])
    both = both.withColumn("label", F.coalesce("label", F.lit("(mean)")))
    return both.select("label", *[F.round(n, 6).alias(n) for n in names], *([] if raw is None else [_reduction()]))


def _reduction() -> Column:
    raw, cal = F.col("raw_brier"), F.col("calibrated_brier")
    return F.when((F.col("label") == "(mean)") & (raw > 0), F.round((raw - cal) / raw * 100, 2)).alias("brier_reduction_pct")


def pooled(long: DataFrame) -> DataFrame:
    """All (ticket, class) pairs as one class."""
    return long.withColumn("label", F.lit("(all)"))


def pooled_curves(calibrated: DataFrame, raw: DataFrame, bins: int = BINS) -> DataFrame:
    """Pooled curves: raw and calibrated on quantile bins, calibrated on uniform bins."""
    frames = {"raw_quantile": quantile_bins(pooled(raw), bins), "calibrated_quantile": quantile_bins(pooled(calibrated), bins),
              "calibrated_uniform": uniform_bins(pooled(calibrated), bins)}
    curves = [reliability_curve(f).drop("label").withColumn("curve", F.lit(name)) for name, f in frames.items()]
    return curves[0].unionByName(curves[1]).unionByName(curves[2])


def selected_curves(long: DataFrame, labels: list[str], bins: int = BINS) -> DataFrame:
    """Quantile curves of the named classes that occur."""
    return reliability_curve(quantile_bins(long.filter(F.col("label").isin(labels)), bins))


def drift(by_window: DataFrame, fitted: DataFrame, bins: int = BINS) -> DataFrame:
    """Brier and adaptive error per (window_start, class) next to the fit-time values.

    ``by_window``: (window_start, label, hit, p); ``fitted``: (label, hit, p).
    """
    by = ("window_start", "label")
    live = brier(by_window, by).join(adaptive_error(reliability_curve(quantile_bins(by_window, bins, by), by), by), list(by))
    base = brier(fitted).join(adaptive_error(reliability_curve(quantile_bins(fitted, bins))), "label").select(
        "label", F.col("brier").alias("fit_brier"), F.col("ece").alias("fit_ece"))
    return live.join(base, "label").select(
        "window_start", "label", "brier", "ece", "fit_brier", "fit_ece",
        (F.col("brier") - F.col("fit_brier")).alias("brier_change"), (F.col("ece") - F.col("fit_ece")).alias("ece_change"))
