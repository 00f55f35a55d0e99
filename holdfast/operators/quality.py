"""Quality checks: rules are data, and one aggregate pass judges all of them."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# The check names of the report.
EXISTS = "expect_column_to_exist"
IN_SET = "expect_column_values_to_be_in_set"
BETWEEN = "expect_column_values_to_be_between"
NOT_NULL = "expect_column_values_to_not_be_null"


@dataclass(frozen=True)
class QualityRules:
    """``ranges`` maps a column to (low, high, mostly); an open side or no tolerance is None."""

    required: Sequence[str] = ()
    value_sets: Mapping[str, Sequence[object]] = field(default_factory=dict)
    ranges: Mapping[str, tuple[float | None, float | None, float | None]] = field(
        default_factory=dict
    )
    not_null: Sequence[str] = ()


# The rules for the e-commerce customer table.
CUSTOMER_RULES = QualityRules(
    required=(
        "CustomerID", "Gender", "MaritalStatus", "Tenure",
        "PreferredLoginDevice", "PreferredPaymentMode", "SatisfactionScore", "Complain",
    ),
    value_sets={
        "Gender": ("Male", "Female"),
        "MaritalStatus": ("Single", "Married", "Divorced"),
        "PreferredLoginDevice": ("Mobile Phone", "Phone", "Computer"),
        "CityTier": (1, 2, 3),
        "Complain": (0, 1),
    },
    ranges={
        "Tenure": (0, 120, 0.99),
        "SatisfactionScore": (1, 5, None),
        "WarehouseToHome": (0, None, 0.99),
        "CashbackAmount": (0, None, None),
    },
    not_null=("CustomerID", "Gender", "SatisfactionScore"),
)


class QualityError(ValueError):
    """The table failed its checks; ``failures`` lists the check names, repeats kept."""

    def __init__(self, failures: list[str]):
        super().__init__(f"data quality check failed: {failures}")
        self.failures = failures


def not_in_set(column: str, values: Sequence[object]) -> Column:
    """Count of non-null values outside the set."""
    c = F.col(column)
    return F.count(F.when(c.isNotNull() & ~c.isin(list(values)), 1))


def out_of_range(column: str, low: float | None, high: float | None) -> Column:
    """Count of non-null values beyond the given ends."""
    c = F.col(column)
    beyond = F.lit(False)
    if low is not None:
        beyond = beyond | (c < F.lit(low))
    if high is not None:
        beyond = beyond | (c > F.lit(high))
    return F.count(F.when(c.isNotNull() & beyond, 1))


def null_count(column: str) -> Column:
    return F.count(F.when(F.col(column).isNull(), 1))


def check_table(df: DataFrame, rules: QualityRules) -> DataFrame:
    """One row per check: (check_no, check_type, column_name, n_checked, n_bad, success).

    Sets and ranges look at non-null values only, and a range passes when its share of good values
    reaches ``mostly``. A check on a column the table lacks fails, with null counts.
    """
    zero, total = F.lit(0).cast("long"), F.count(F.lit(1))
    checks: list[tuple[str, str, Column | None, Column | None, float]] = []
    for c in rules.required:
        checks.append((EXISTS, c, total, zero, 1.0))
    for c, values in rules.value_sets.items():
        checks.append((IN_SET, c, F.count(F.col(c)), not_in_set(c, values), 1.0))
    for c, (low, high, mostly) in rules.ranges.items():
        bad = out_of_range(c, low, high)
        checks.append((BETWEEN, c, F.count(F.col(c)), bad, 1.0 if mostly is None else mostly))
    for c in rules.not_null:
        checks.append((NOT_NULL, c, total, null_count(c), 1.0))

    aggregates, rows = [], []
    for i, (kind, c, checked, bad, mostly) in enumerate(checks):
        if c in df.columns:
            aggregates.append(F.struct(checked.alias("checked"), bad.alias("bad")).alias(f"k{i}"))
            checked, bad = F.col(f"k{i}.checked"), F.col(f"k{i}.bad")
            good_share = F.lit(1.0) - bad / checked
            success = F.when(checked == 0, True).otherwise(good_share >= F.lit(mostly))
            if kind == EXISTS:
                success = F.lit(True)
        else:
            checked = bad = F.lit(None).cast("long")
            success = F.lit(False)
        rows.append(F.struct(
            F.lit(i + 1).alias("check_no"), F.lit(kind).alias("check_type"),
            F.lit(c).alias("column_name"), checked.alias("n_checked"), bad.alias("n_bad"),
            success.alias("success"),
        ))
    if not rows:
        raise ValueError("no quality rules given")
    return (
        df.agg(*(aggregates or [total.alias("n")]))
        .select(F.explode(F.array(*rows)).alias("r"))
        .select("r.*")
    )


def summarize_checks(checks: DataFrame) -> DataFrame:
    """One row: total, passed, failed and the failed check names in rule order, repeats kept."""
    failures = F.array_sort(
        F.collect_list(F.when(~F.col("success"), F.struct("check_no", "check_type")))
    )
    return checks.agg(
        F.count(F.lit(1)).alias("total_checks"),
        F.count(F.when(F.col("success"), 1)).alias("passed_checks"),
        F.count(F.when(~F.col("success"), 1)).alias("failed_checks"),
        F.array_join(F.transform(failures, lambda f: f["check_type"]), ",").alias("failures"),
    )


def validate_customers(
    df: DataFrame, rules: QualityRules = CUSTOMER_RULES
) -> tuple[bool, list[str]]:
    """(all passed, failed check names)."""
    rows = check_table(df, rules).filter(~F.col("success")).orderBy("check_no").collect()
    failures = [r["check_type"] for r in rows]
    return not failures, failures


def quality_gate(
    df: DataFrame, rules: QualityRules = CUSTOMER_RULES, *, skip: bool = False
) -> bool:
    """Raise ``QualityError`` unless the table passes; ``skip`` lets it through unchecked."""
    if skip:
        return True
    passed, failures = validate_customers(df, rules)
    if not passed:
        raise QualityError(failures)
    return True


def target_profile(df: DataFrame, target: str) -> DataFrame:
    """One row: rows, null targets, targets other than 0 and 1, and whether the target is clean."""
    other = ~F.col(target).cast("double").isin(0.0, 1.0)
    counts = df.agg(
        F.count(F.lit(1)).alias("n_rows"),
        null_count(target).alias("n_null"),
        F.count(F.when(other, 1)).alias("n_not_binary"),
    )
    clean = (F.col("n_null") == 0) & (F.col("n_not_binary") == 0)
    return counts.withColumn("target_ok", clean)


def require_target(df: DataFrame, target: str) -> None:
    if target not in df.columns:
        raise ValueError(f"target column '{target}' not found in the data")


def require_binary_target(df: DataFrame, target: str) -> None:
    require_target(df, target)
    row = target_profile(df, target).first()
    if not row["target_ok"]:
        raise ValueError(
            f"target '{target}' must be 0 or 1 on every row: {row['n_null']} nulls, "
            f"{row['n_not_binary']} other values"
        )
