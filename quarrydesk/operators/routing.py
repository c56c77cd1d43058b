"""Confidence guard, tiered routing, SLA labels and request validation."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quarrydesk.functions.text import WHITE_RUN
from quarrydesk.schema import AUTO_ROUTE_FROM, OOD_THRESHOLD, SLA_DEFAULT, SLA_LABELS

# --- fixed values -----------------------------------------------------------
TOP_K_RANGE = (1, 50)
TOP_N_RANGE = (1, 20)
DEFAULT_TOP_K = 5
DEFAULT_TOP_N = 5
DEFAULT_PREVIOUS = 0
LOW_CONFIDENCE, IN_DISTRIBUTION = "low_confidence", "in_distribution"
# ----------------------------------------------------------------------------


def best_score(scores: Column) -> Column:
    """The struct of highest p, ties to the lowest label; row-local."""
    def better(a: Column, b: Column) -> Column:
        return F.when(a["p"] > b["p"], -1).when(a["p"] < b["p"], 1).when(a["label"] < b["label"], -1).otherwise(1)
    return F.array_sort(scores, better)[0]


def with_prediction(df: DataFrame) -> DataFrame:
    """Add ``prediction`` and ``confidence`` from the score array."""
    best = best_score(F.col("scores"))
    return df.withColumn("_best", best).withColumns(
        {"prediction": F.col("_best.label"), "confidence": F.col("_best.p")}).drop("_best")


def ood_guard(df: DataFrame, threshold: float = OOD_THRESHOLD) -> DataFrame:
    """Uncertain strictly below the threshold; the category is then withheld."""
    low = F.col("confidence") < threshold
    return df.withColumns({
        "uncertain": low,
        "reason": F.when(low, LOW_CONFIDENCE).otherwise(IN_DISTRIBUTION),
        "max_confidence": F.round("confidence", 4),
        "predicted_category": F.when(~low, F.col("prediction")),
        "threshold": F.lit(threshold)})


def ood_benchmark(guarded: DataFrame, expected: DataFrame, key: str) -> DataFrame:
    """PASSED where the flag equals the expected one."""
    return guarded.join(expected, key).withColumn(
        "result", F.when(F.col("uncertain") == F.col("expected_uncertain"), "PASSED").otherwise("FAILED"))


def route(confidence: Column) -> Column:
    return (F.when(confidence >= AUTO_ROUTE_FROM, "auto").when(confidence >= OOD_THRESHOLD, "tier_1")
            .otherwise("human"))


def sla_label(priority: Column) -> Column:
    upper = F.upper(priority)
    label = F.lit(SLA_DEFAULT)
    for name, text in SLA_LABELS.items():
        label = F.when(upper == name, text).otherwise(label)
    return label


def validate_requests(df: DataFrame, default_product: str) -> DataFrame:
    """Defaults, stripping and a ``reject_reason`` (NULL for valid rows). Requests without bounds have none to break."""
    bounded = {c: limits for c, limits in {"top_k": (DEFAULT_TOP_K, TOP_K_RANGE), "top_n": (DEFAULT_TOP_N, TOP_N_RANGE)}.items()
               if c in df.columns}
    text = F.regexp_replace("ticket_text", r"(?U)^[\s\x1c-\x1f]+|[\s\x1c-\x1f]+$", "")
    shaped = df.withColumns({
        "ticket_text": text,
        "product": F.coalesce("product", F.lit(default_product)),
        "previous_tickets": F.coalesce("previous_tickets", F.lit(DEFAULT_PREVIOUS)),
        **{c: F.coalesce(c, F.lit(default)) for c, (default, _) in bounded.items()}})
    blank = F.col("ticket_text").isNull() | (F.regexp_replace("ticket_text", WHITE_RUN, "") == "")
    reason = F.when(blank, "blank text").when(F.col("previous_tickets") < 0, "negative previous_tickets")
    for c, (_, limits) in bounded.items():
        reason = reason.when(~F.col(c).between(*limits), f"{c} out of range")
    return shaped.withColumn("reject_reason", reason)


def valid_requests(validated: DataFrame) -> DataFrame:
    return validated.filter(F.col("reject_reason").isNull()).drop("reject_reason")


def rejected_requests(validated: DataFrame) -> DataFrame:
    return validated.filter(F.col("reject_reason").isNotNull())
