"""Data contracts: each stage is checked in one aggregate and reported as rows."""

import json
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T

from chronolex import schema
from chronolex.functions.text import word_count
from chronolex.functions.vectors import nonzero_count

# The rules of each stage. Row minima are meant for production data.
EXPECTATIONS = {
    "raw": {
        "min_rows": 10_000,
        "required": ["series", "issue", "text", "date"],
        "not_null": ["series", "issue", "date"],
        "min_chars": 10,
        "max_chars": 500_000,
    },
    "metadata": {
        "min_rows": 100,
        "required": ["series", "contents"],
        "not_null": ["series"],
        "expected_labels": ["democratic", "republican", "independent"],
    },
    "processed": {
        "min_rows": 5_000,
        "required": ["series", "issue", "year", "paragraph_id", "text"],
        "not_null": ["series", "issue", "year"],
        "max_text_length": 100_000,
        "min_paragraph_words": 2,
        "imbalance_ratio": 4.0,
    },
    "features": {
        "min_rows": 5_000,
        "required": ["series", "issue", "year", "paragraph_id", "features"],
        "not_null": ["series", "issue", "year", "paragraph_id", "features"],
        "min_nonzero": 1,
    },
    "predictions": {
        "min_rows": 100,
        "required": ["series", "issue", "year", "pred_label", "prob_democrat", "prob_republican"],
        "not_null": ["series", "issue", "year", "pred_label"],
        "valid_labels": [0.0, 1.0, 2.0, 3.0],
        "probability_range": (0.0, 1.0),
    },
    "drift_metrics": {
        "required": ["year", "ref_year", "model_name", "metric_name", "metric_value"],
        "not_null": ["year", "ref_year", "model_name", "metric_name", "metric_value"],
    },
}


@dataclass(frozen=True)
class Check:
    """An aggregate that must lie in [low, high]; `level` says what a miss means."""

    name: str
    observed: Column
    low: float | None = None
    high: float | None = None
    level: str = "error"


def run_checks(df: DataFrame, stage: str, checks: list[Check]) -> DataFrame:
    """One row per check: stage, check, level, observed, low, high, passed. One pass over `df`."""
    observed = df.agg(*[c.observed.cast("double").alias(f"_{i}") for i, c in enumerate(checks)])

    def row(i: int, check: Check) -> Column:
        value = F.coalesce(F.col(f"_{i}"), F.lit(0.0))
        low, high = F.lit(check.low).cast("double"), F.lit(check.high).cast("double")
        in_range = F.coalesce(value >= low, F.lit(True)) & F.coalesce(value <= high, F.lit(True))
        return F.struct(
            F.lit(check.name).alias("check"),
            F.lit(check.level).alias("level"),
            value.alias("observed"),
            low.alias("low"),
            high.alias("high"),
            in_range.alias("passed"),
        )

    rows = F.array(*[row(i, c) for i, c in enumerate(checks)])
    return observed.select(F.lit(stage).alias("stage"), F.explode(rows).alias("r")).select("stage", "r.*")


def missing_columns(df: DataFrame, required: list[str]) -> Check:
    return Check("missing_columns", F.lit(len(set(required) - set(df.columns))), high=0)


def min_rows(minimum: int) -> Check:
    return Check("row_count", F.count("*"), low=minimum)


def null_counts(df: DataFrame, columns: list[str], level: str = "warning") -> list[Check]:
    return [
        Check(f"null_{c}", F.count_if(F.col(c).isNull()), high=0, level=level)
        for c in columns
        if c in df.columns
    ]


def _outside(column: str, low: float, high: float) -> Column:
    return F.count_if(~F.col(column).between(low, high))


def _rule(stage: str, rules: dict | None) -> dict:
    """The built-in rules of a stage, with those of `rules` (stage -> rule -> value) in their place."""
    return {**EXPECTATIONS[stage], **(rules or {}).get(stage, {})}


def raw_checks(df: DataFrame, minimum: int | None = None, rules: dict | None = None) -> list[Check]:
    rule = _rule("raw", rules)
    checks = [missing_columns(df, rule["required"])]
    checks.append(min_rows(rule["min_rows"] if minimum is None else minimum))
    checks += null_counts(df, rule["not_null"])
    if "text" in df.columns:
        outside = F.count_if(~F.length("text").between(rule["min_chars"], rule["max_chars"]))
        checks.append(Check("text_length_out_of_bounds", outside, high=0, level="warning"))
    return checks


def metadata_checks(
    df: DataFrame, minimum: int | None = None, rules: dict | None = None, delimiter: str = schema.TAG_DELIMITER
) -> list[Check]:
    rule = _rule("metadata", rules)
    checks = [missing_columns(df, rule["required"])]
    checks.append(min_rows(rule["min_rows"] if minimum is None else minimum))
    checks += null_counts(df, rule["not_null"])
    if "contents" in df.columns:
        for label in rule["expected_labels"]:
            tagged = F.count_if(F.array_contains(F.split("contents", delimiter), label))
            checks.append(Check(f"label_{label}", tagged, low=1, level="warning"))
    return checks


def processed_checks(df: DataFrame, minimum: int | None = None, rules: dict | None = None) -> list[Check]:
    rule = _rule("processed", rules)
    checks = [missing_columns(df, rule["required"])]
    checks.append(min_rows(rule["min_rows"] if minimum is None else minimum))
    checks += null_counts(df, rule["not_null"])
    if "text" in df.columns:
        checks += [
            Check("text_length_min", F.min(F.length("text")), level="info"),
            Check("text_length_max", F.max(F.length("text")), high=rule["max_text_length"], level="warning"),
            Check("text_length_avg", F.avg(F.length("text")), level="info"),
            Check(
                "short_paragraphs",
                F.count_if(word_count(F.col("text")) < rule["min_paragraph_words"]),
                high=0,
                level="warning",
            ),
        ]
    return checks


def feature_checks(df: DataFrame, minimum: int | None = None, rules: dict | None = None) -> list[Check]:
    rule = _rule("features", rules)
    checks = [missing_columns(df, rule["required"])]
    checks.append(Check("row_count", F.count("*"), low=rule["min_rows"] if minimum is None else minimum, level="warning"))
    checks += null_counts(df, rule["not_null"])
    if "features" in df.columns:
        empty = F.count_if(nonzero_count(F.col("features")) < rule["min_nonzero"])
        checks.append(Check("empty_vectors", empty, high=0, level="warning"))
    return checks


def unexpected_labels(df: DataFrame, valid: list[float] | None = None) -> DataFrame:
    """Rows whose predicted label is not a known one; NULL is not counted."""
    values = EXPECTATIONS["predictions"]["valid_labels"] if valid is None else valid
    return df.filter(~F.col("pred_label").isin(values))


def prediction_checks(df: DataFrame, minimum: int | None = None, rules: dict | None = None) -> list[Check]:
    rule = _rule("predictions", rules)
    checks = [missing_columns(df, rule["required"])]
    checks.append(Check("row_count", F.count("*"), low=rule["min_rows"] if minimum is None else minimum, level="warning"))
    checks += null_counts(df, rule["not_null"])
    if "pred_label" in df.columns:
        odd = F.count_if(~F.col("pred_label").isin(rule["valid_labels"]))
        checks.append(Check("unexpected_pred_label", odd, high=0, level="warning"))
    for name in ("prob_democrat", "prob_republican"):
        if name in df.columns:
            outside = _outside(name, *rule["probability_range"])
            checks.append(Check(f"{name}_out_of_range", outside, high=0, level="warning"))
    return checks


def drift_metric_checks(df: DataFrame, rules: dict | None = None) -> list[Check]:
    rule = _rule("drift_metrics", rules)
    return [missing_columns(df, rule["required"]), *null_counts(df, rule["not_null"])]


STAGE_CHECKS = {
    "raw": raw_checks,
    "metadata": metadata_checks,
    "processed": processed_checks,
    "features": feature_checks,
    "predictions": prediction_checks,
}


def stage_report(
    df: DataFrame, stage: str, minimum: int | None = None, rules: dict | None = None
) -> DataFrame:
    """Report of a stage. `rules` may replace built-in rules, as a mapping stage -> rule -> value."""
    if stage == "drift_metrics":
        return run_checks(df, stage, drift_metric_checks(df, rules))
    return run_checks(df, stage, STAGE_CHECKS[stage](df, minimum, rules))


def load_rules(spark: SparkSession, path: str) -> dict:
    """Rules from a JSON file, stage -> rule -> value."""
    return json.loads("\n".join(r["value"] for r in spark.read.text(path, wholetext=True).collect()))


def union_reports(reports: list[DataFrame]) -> DataFrame:
    return reduce(DataFrame.unionByName, reports)


def validate(report: DataFrame, raise_on_error: bool = False) -> bool:
    """True when no check of level 'error' failed. Runs an action over the few report rows."""
    failed = [r["check"] for r in report.filter(~F.col("passed") & (F.col("level") == "error")).collect()]
    if failed and raise_on_error:
        raise ValueError(f"contract failed: {', '.join(failed)}")
    return not failed


def train_label_presence(df: DataFrame, labels: list[float] = schema.TRAIN_LABELS) -> DataFrame:
    """Whether each training label occurs, per year."""
    return df.groupBy("year").agg(
        *[F.count_if(F.col("label") == v).alias(f"label_{int(v)}_rows") for v in labels],
        F.coalesce(
            reduce(lambda a, b: a & b, [F.max(F.col("label") == v) for v in labels]), F.lit(False)
        ).alias("ok"),
    )


def validate_year(df: DataFrame, year: int, is_training: bool = False) -> bool:
    """Raise when a training year lacks label 0 or 1. Runs one action on a single aggregate row."""
    if not is_training:
        return True
    if "label" not in df.columns:
        raise ValueError(f"year {year} has no label column")
    checks = [Check(f"label_{int(v)}", F.count_if(F.col("label") == v), low=1) for v in schema.TRAIN_LABELS]
    return validate(run_checks(df.filter(F.col("year") == year), "processed", checks), raise_on_error=True)


def label_distribution(df: DataFrame) -> DataFrame:
    """Rows per label, NULL first."""
    return df.groupBy("label").agg(F.count("*").alias("count")).orderBy("label")


def text_length_stats(df: DataFrame, column: str = "text") -> DataFrame:
    size = F.length(column)
    return df.agg(
        F.min(size).cast("long").alias("min_len"),
        F.max(size).cast("long").alias("max_len"),
        F.avg(size).alias("avg_len"),
    )


def text_bounds(df: DataFrame, group_cols: list[str], column: str = "text") -> DataFrame:
    """Rows outside the raw text length bounds, per group."""
    rule = EXPECTATIONS["raw"]
    outside = ~F.length(column).between(rule["min_chars"], rule["max_chars"])
    return df.groupBy(*group_cols).agg(
        F.count("*").alias("rows"), F.count_if(outside).alias("out_of_bounds")
    )


def label_imbalance(df: DataFrame, limit: float = EXPECTATIONS["processed"]["imbalance_ratio"]) -> DataFrame:
    """Largest over smallest class of the non-null labels, flagged above `limit`."""
    counts = df.filter(F.col("label").isNotNull()).groupBy("label").agg(F.count("*").alias("n"))
    return counts.agg(
        F.max("n").alias("largest"), F.min("n").alias("smallest"), (F.max("n") / F.min("n")).alias("ratio")
    ).withColumn("imbalanced", F.col("ratio") > limit)


def schema_conformance(df: DataFrame, declared: T.StructType, stage: str) -> DataFrame:
    """Per declared column: present, of the declared type, and NULL rows where none are allowed."""
    actual = {f.name: f.dataType for f in df.schema}
    nulls = df.agg(
        *[
            (F.count_if(F.col(f.name).isNull()) if f.name in actual else F.lit(0).cast("long")).alias(f"_{i}")
            for i, f in enumerate(declared)
        ]
    )

    def row(i: int, field: T.StructField) -> Column:
        found = actual.get(field.name)
        same = found == field.dataType
        allowed = F.lit(field.nullable)
        return F.struct(
            F.lit(field.name).alias("column"),
            F.lit(field.dataType.simpleString()).alias("declared_type"),
            F.lit(found.simpleString() if found else None).cast("string").alias("actual_type"),
            F.col(f"_{i}").alias("null_rows"),
            (F.lit(same) & (allowed | (F.col(f"_{i}") == 0))).alias("passed"),
        )

    rows = F.array(*[row(i, f) for i, f in enumerate(declared)])
    return nulls.select(F.lit(stage).alias("stage"), F.explode(rows).alias("r")).select("stage", "r.*")
