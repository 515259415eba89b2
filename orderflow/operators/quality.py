"""Rule-based data-quality gate."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from orderflow.functions import to_double, to_int

FAILURE = "_dq_failure"

# Accepted order states.
ORDER_STATUSES = ["Pending", "Processing", "Shipped", "Delivered", "Cancelled", "Returned"]

# Reasons, in the order the rules are tried.
REASONS = {
    "order_id": "order_id is null",
    "customer_id": "customer_id is null",
    "order_date": "order_date is null",
    "order_status": "invalid order_status",
    "quantity": "quantity <= 0 or non-numeric",
    "unit_price": "unit_price < 0 or non-numeric",
    "discount": "discount out of [0, 1] range",
}

DEFAULT_MAX_REJECT_PCT = 5.0


@dataclass(frozen=True)
class Rule:
    """A row fails the rule when ``fails`` is true; NULL counts as a pass."""

    reason: str
    fails: Column


@dataclass(frozen=True)
class GateCounts:
    total: int
    by_reason: dict[str, int]

    @property
    def rejected(self) -> int:
        return sum(self.by_reason.values())

    @property
    def reject_pct(self) -> float:
        return self.rejected / self.total * 100 if self.total else 0.0


class GateFailed(RuntimeError):
    """More rows were rejected than the threshold allows; ``counts`` says how many."""

    def __init__(self, message: str, counts: GateCounts):
        super().__init__(message)
        self.counts = counts


def order_rules() -> list[Rule]:
    """The seven rules for raw orders."""
    status, discount = F.col("order_status"), to_double(F.col("discount"))
    quantity, price = to_int(F.col("quantity")), to_double(F.col("unit_price"))
    rules = [Rule(REASONS[c], F.col(c).isNull()) for c in ("order_id", "customer_id", "order_date")]
    rules += [
        # A missing state passes here; the target's NOT NULL contract catches it later.
        Rule(REASONS["order_status"], ~status.isin(ORDER_STATUSES)),
        # "Not known to be in range" covers NULL and parses the text once. NaN sorts above all.
        Rule(REASONS["quantity"], ~F.coalesce(quantity > 0, F.lit(False))),
        Rule(REASONS["unit_price"], ~F.coalesce(price >= 0, F.lit(False))),
        # A missing or non-numeric discount passes and later counts as 0.
        Rule(REASONS["discount"], ~discount.between(0, 1)),
    ]
    return rules


def tag(df: DataFrame, rules: Sequence[Rule] | None = None) -> DataFrame:
    """Add the reason of the first rule each row fails, NULL for rows that pass."""
    rules = order_rules() if rules is None else rules
    return df.withColumn(FAILURE, F.coalesce(*[F.when(r.fails, F.lit(r.reason)) for r in rules]))


def valid_rows(tagged: DataFrame) -> DataFrame:
    return tagged.filter(F.col(FAILURE).isNull()).drop(FAILURE)


def rejected_rows(tagged: DataFrame) -> DataFrame:
    return tagged.filter(F.col(FAILURE).isNotNull())


def split(tagged: DataFrame) -> tuple[DataFrame, DataFrame]:
    return valid_rows(tagged), rejected_rows(tagged)


def profile(tagged: DataFrame) -> DataFrame:
    """Rejected rows per reason."""
    return rejected_rows(tagged).groupBy(FAILURE).agg(F.count(F.lit(1)).alias("row_count"))


def gate_report(tagged: DataFrame, max_reject_pct: float = DEFAULT_MAX_REJECT_PCT) -> DataFrame:
    """One row: total, rejected, rate in percent, verdict. A rate equal to the limit passes."""
    rate = F.coalesce(
        F.col("rejected").cast("double") / F.nullif(F.col("total"), F.lit(0)) * 100, F.lit(0.0)
    )
    return (
        tagged.agg(F.count(F.lit(1)).alias("total"), F.count(FAILURE).alias("rejected"))
        .withColumn("reject_pct", rate)
        .withColumn("verdict", F.when(F.col("reject_pct") > max_reject_pct, "FAIL").otherwise("PASS"))
    )


def gate(tagged: DataFrame, max_reject_pct: float = DEFAULT_MAX_REJECT_PCT) -> GateCounts:
    """Count by reason and raise when too many rows fail.

    The scan below this reads only the columns the rules look at, and what comes to the driver
    is one row per rule.
    """
    counts = {r[FAILURE]: r["n"] for r in
              tagged.groupBy(FAILURE).agg(F.count(F.lit(1)).alias("n")).collect()}
    return passed(GateCounts(sum(counts.values()), {k: n for k, n in counts.items() if k is not None}), max_reject_pct)


def passed(counts: GateCounts, max_reject_pct: float = DEFAULT_MAX_REJECT_PCT) -> GateCounts:
    """The counts, unless they are over the threshold: then an error that has them."""
    if counts.reject_pct > max_reject_pct:
        raise GateFailed(
            f"{counts.rejected} of {counts.total} rows rejected "
            f"({counts.reject_pct:.2f} %), limit {max_reject_pct} %", counts
        )
    return counts


def counts_by(reasons: Sequence[str]) -> list[Column]:
    """Metrics of a tagged frame that a write of it can count on the way: rows, and rows by reason."""
    return [F.count(F.lit(1)).alias("total"), *[F.count_if(F.col(FAILURE) == r).alias(f"reason_{i}") for i, r in enumerate(reasons)]]


def observed_counts(metrics: dict, reasons: Sequence[str]) -> GateCounts:
    by_reason = {r: metrics[f"reason_{i}"] for i, r in enumerate(reasons)}
    return GateCounts(metrics["total"], {r: n for r, n in by_reason.items() if n})
