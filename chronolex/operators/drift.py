"""Data and concept drift of predictions against a reference year, for all years in one plan.

Every function takes a prediction table holding the reference year and any number of other years,
and returns tall metric rows: year, ref_year, group columns, metric_name, metric_value.
"""

from pyspark.sql import Column, DataFrame, Window, functions as F

from chronolex import schema
from chronolex.functions import stats

MODEL = ["model_name", "model_version"]
PROBABILITIES = ("prob_democrat", "prob_republican")


def _histogram(prob_col: str) -> list[Column]:
    p = F.col(prob_col)
    return [F.count(p).alias("n"), stats.bin_counts(p).alias("bins")]


def bin_histogram(
    predictions: DataFrame, prob_col: str = "prob_republican", group_cols: list[str] = MODEL
) -> DataFrame:
    """Ten left-closed bin counts and the non-null count per group and year."""
    return predictions.groupBy(*group_cols, "year").agg(*_histogram(prob_col))


def bin_rows(histogram: DataFrame, group_cols: list[str] = MODEL) -> DataFrame:
    return histogram.select(*group_cols, "year", F.posexplode("bins").alias("bin", "count"))


def _reference(value: Column, ref_year: int, group_cols: list[str]) -> Column:
    """The reference year's value beside every year; the window holds one row per year."""
    beside = Window.partitionBy(*[F.col(c) for c in group_cols]) if group_cols else Window.partitionBy(F.lit(0))
    return F.max(F.when(F.col("year") == ref_year, value)).over(beside)


def _beside_reference(wide: DataFrame, ref_year: int, group_cols: list[str]) -> DataFrame:
    """Add `ref_year`, and `psi` and `kl` where both sides have probabilities, from `n` and `bins`."""
    filled = F.when(F.col("n") > 0, F.struct("n", "bins"))
    both = (F.col("n") > 0) & F.col("ref").isNotNull()
    psi = stats.psi(F.col("ref.bins"), F.col("ref.n"), F.col("bins"), F.col("n"))
    kl = stats.kl_divergence(F.col("ref.bins"), F.col("bins"))
    return (
        wide.withColumn("ref", _reference(filled, ref_year, group_cols))
        .withColumns({"ref_year": F.lit(ref_year), "psi": F.when(both, psi), "kl": F.when(both, kl)})
        .drop("ref")
    )


def drift_scores(
    predictions: DataFrame,
    ref_year: int,
    prob_col: str = "prob_republican",
    group_cols: list[str] = MODEL,
    include_reference: bool = False,
) -> DataFrame:
    """PSI and KL per group and year; no row where either side has no probability."""
    scored = _beside_reference(bin_histogram(predictions, prob_col, group_cols), ref_year, group_cols)
    scored = scored.filter(F.col("psi").isNotNull())
    if not include_reference:
        scored = _others(scored, ref_year)
    return scored.select(*group_cols, "year", "ref_year", "psi", "kl")


def metric_rows(df: DataFrame, metrics: dict[str, Column], group_cols: list[str] = MODEL) -> DataFrame:
    """Wide to tall; NULL metrics give no row."""
    entries = F.array(
        *[F.struct(F.lit(k).alias("metric_name"), v.alias("metric_value")) for k, v in metrics.items()]
    )
    return (
        df.select("year", "ref_year", *group_cols, F.explode(entries).alias("m"))
        .select("year", "ref_year", *group_cols, "m.metric_name", "m.metric_value")
        .filter(F.col("metric_value").isNotNull())
    )


def _score_metrics(prob_col: str) -> dict[str, Column]:
    return {f"psi_{prob_col}": F.col("psi"), f"kl_{prob_col}": F.col("kl")}


def data_drift(
    predictions: DataFrame,
    ref_year: int,
    prob_col: str = "prob_republican",
    group_cols: list[str] = MODEL,
) -> DataFrame:
    scores = drift_scores(predictions, ref_year, prob_col, group_cols)
    return metric_rows(scores, _score_metrics(prob_col), group_cols)


def drift_severity(scores: DataFrame) -> DataFrame:
    """One severity per score row."""
    return scores.withColumn(
        "drift_severity",
        stats.drift_severity(F.col("psi"), schema.PSI_WARNING, schema.PSI_CRITICAL),
    )


def _others(predictions: DataFrame, ref_year: int) -> DataFrame:
    return predictions.filter(F.col("year") != ref_year)


def class_balance(predictions: DataFrame, ref_year: int, group_cols: list[str] = MODEL) -> DataFrame:
    """Share of each predicted class per group and year; NULL labels count in the total only."""
    counts = _others(predictions, ref_year).groupBy(*group_cols, "year", "pred_label").agg(
        F.count("*").alias("n")
    )
    total = F.sum("n").over(Window.partitionBy(*group_cols, "year"))
    return (
        counts.withColumn("share", F.col("n") / total)
        .filter(F.col("pred_label").isNotNull())
        .select(
            "year",
            F.lit(ref_year).alias("ref_year"),
            *group_cols,
            F.concat(
                F.lit("pred_class_"), F.col("pred_label").cast("long").cast("string"), F.lit("_fraction")
            ).alias("metric_name"),
            F.col("share").alias("metric_value"),
        )
    )


def _sides() -> dict[str, Column]:
    """Per side of the prediction, its probability where it can be summed exactly."""
    return {name.removeprefix("prob_"): F.when(F.abs(name) < stats.EXACT_LIMIT, F.col(name)) for name in PROBABILITIES}


def _values() -> dict[str, Column]:
    """What is summed per group and year, exactly."""
    sides = _sides()
    values = {"confidence": stats.exact(F.greatest(*sides.values()))}
    for side, p in sides.items():
        values |= {side: stats.exact(p), f"{side}_squares": stats.exact(p * p)}
    return values


def _sure(p: Column) -> Column:
    return F.when(p.isNotNull(), ((p > schema.HIGH_CONFIDENCE) | (p < 1 - schema.HIGH_CONFIDENCE)).cast("int"))


def _summary() -> list[Column]:
    """Exact sums and counts; neither depends on the partitioning."""
    aggregates = [F.count(v).alias(f"n_{name}") for name, v in _values().items() if not name.endswith("_squares")]
    aggregates += [F.sum(v).alias(f"sum_{name}") for name, v in _values().items()]
    return aggregates + [F.sum(_sure(p)).alias(f"sure_{side}") for side, p in _sides().items()]


def _summary_metrics() -> dict[str, Column]:
    both = (F.col("n_democrat") > 0) & (F.col("n_republican") > 0)
    metrics = {"mean_confidence": stats.mean_of(F.col("sum_confidence"), F.col("n_confidence"))}
    for side in _sides():
        total, n = F.col(f"sum_{side}"), F.col(f"n_{side}")
        metrics |= {
            f"mean_prob_{side}": stats.mean_of(total, n),
            f"var_prob_{side}": stats.variance_of(total, F.col(f"sum_{side}_squares"), n),
            f"high_confidence_fraction_{side}": F.col(f"sure_{side}") / n,
        }
    return {name: F.when(both, value) for name, value in metrics.items()}


def probability_summary(
    predictions: DataFrame, ref_year: int, group_cols: list[str] = MODEL
) -> DataFrame:
    """Mean, population variance and high-confidence share of both probabilities.

    Groups without one of the probabilities give no row. `mean_confidence` averages the larger one.
    Probabilities are summed as whole numbers of 1e-15, so results are the same under any partitioning; those that
    are not finite count as NULL.
    """
    wide = _others(predictions, ref_year).groupBy(*group_cols, "year").agg(*_summary())
    return metric_rows(wide.withColumn("ref_year", F.lit(ref_year)), _summary_metrics(), group_cols)


def label_flip_rate(reference: DataFrame, current: DataFrame, group_cols: list[str] = ()) -> DataFrame:
    """Share of paragraph pairs with the same key whose predicted labels differ.

    Counts per key and label meet instead of rows, so repeated keys never multiply into row pairs.
    `group_cols` are columns of `current` to report by. No shared key, no row.
    """
    keys = schema.PARAGRAPH_KEY

    def counts(df: DataFrame, group: list[str], label: str, n: str) -> DataFrame:
        return df.groupBy(*group, *keys, F.col("pred_label").alias(label)).agg(F.count("*").alias(n))

    joined = counts(reference, [], "ref_pred", "ref_n").join(
        counts(current, group_cols, "cur_pred", "cur_n"), keys, "inner"
    )
    pairs = F.col("ref_n") * F.col("cur_n")
    flipped = F.when(F.col("ref_pred") != F.col("cur_pred"), pairs).otherwise(0)
    return (
        joined.groupBy(*group_cols)
        .agg(F.sum(pairs).alias("overlap"), F.sum(flipped).alias("flipped"))
        .filter(F.col("overlap") > 0)
        .withColumn("label_flip_rate", F.col("flipped") / F.col("overlap"))
    )


def _label_counts(predictions: DataFrame, group_cols: list[str]) -> DataFrame:
    """Rows per group, paragraph, year and predicted label: all that flips and class shares need."""
    return predictions.groupBy(*group_cols, *schema.PARAGRAPH_KEY, "year", "pred_label").agg(F.count("*").alias("n"))


def _pairs(ref_year: int, group_cols: list[str]) -> dict[str, Column]:
    """Pairs that counts make with the reference year's counts of the same paragraph: `overlap`, and `flipped`.

    Two windows over one partitioning and order, by paragraph, then label. A paragraph has as many rows
    as years and labels, however often its predictions repeat. A key with a NULL part is no paragraph and
    makes no pairs; a NULL label differs from none. Pairs are decimals, as counts multiply.
    """
    keys = [*group_cols, *schema.PARAGRAPH_KEY]
    n = F.col("n").cast("decimal(19,0)")
    in_reference = F.col("year") == ref_year
    paragraph, labelled = Window.partitionBy(*keys), Window.partitionBy(*keys, "pred_label")

    def total(condition: Column, window: Window) -> Column:
        return F.coalesce(F.sum(F.when(condition, F.col("n"))).over(window), F.lit(0)).cast("decimal(19,0)")

    known = ~in_reference
    for key in schema.PARAGRAPH_KEY:
        known = known & F.col(key).isNotNull()
    label = F.col("pred_label").isNotNull()
    other = total(in_reference & label, paragraph) - total(in_reference & label, labelled)
    no_pairs = F.lit(0).cast("decimal(38,0)")
    return {
        "overlap": F.when(known, (n * total(in_reference, paragraph)).cast("decimal(38,0)")).otherwise(no_pairs),
        "flipped": F.when(known & label, (n * other).cast("decimal(38,0)")).otherwise(no_pairs),
    }


def _flip_rate() -> Column:
    overlap = F.col("overlap").cast("double")
    return F.when(overlap > 0, F.col("flipped").cast("double") / overlap)


def yearly_flip_rate(predictions: DataFrame, ref_year: int, group_cols: list[str] = MODEL) -> DataFrame:
    """Flip rate of every other year against the reference year within each group.

    Counts of all years of a paragraph meet in one place, where they are compared: one shuffle of counts
    by paragraph, no join of the table with itself.
    """
    rates = (
        _label_counts(predictions, group_cols)
        .withColumns(_pairs(ref_year, group_cols))
        .filter(F.col("year") != ref_year)
        .groupBy(*group_cols, "year")
        .agg(F.sum("overlap").alias("overlap"), F.sum("flipped").alias("flipped"))
    )
    return metric_rows(
        rates.withColumn("ref_year", F.lit(ref_year)), {"label_flip_rate": _flip_rate()}, group_cols
    )


def _measured(predictions: DataFrame, ref_year: int, prob_col: str, group_cols: list[str]) -> DataFrame:
    """One row per group and year with all that the report needs, from one scan.

    Every prediction is counted twice: in its paragraph, by label, and in its year, by bin and confidence
    with exact sums. The second kind shrinks to a few rows per year before the first shuffle. A second
    shuffle brings the counts of a paragraph's years together, where they are compared; from there on only
    rows per year, label and bin are left.
    """
    keys = schema.PARAGRAPH_KEY
    types = {f.name: f.dataType for f in predictions.schema}
    sides, values = _sides(), _values()
    null = lambda name: F.lit(None).cast(types[name]).alias(name)
    names = ["bin", *[f"is_sure_{s}" for s in sides]]
    marks = [stats.bin_index(F.col(prob_col)), *map(_sure, sides.values())]
    empty = [F.lit(None).cast("decimal(19,0)").alias(v) for v in values]
    by_year = F.struct(
        F.lit(True).alias("by_year"), *[null(k) for k in keys], null("pred_label"),
        *[m.alias(n) for n, m in zip(names, marks)], *[v.alias(n) for n, v in values.items()],
    )
    by_paragraph = F.struct(
        F.lit(False).alias("by_year"), *keys, "pred_label", *[F.lit(None).cast("int").alias(n) for n in names], *empty
    )
    counted = (
        predictions.select(*group_cols, "year", F.inline(F.array(by_year, by_paragraph)))
        .groupBy(*group_cols, "by_year", *keys, "year", "pred_label", *names)
        .agg(F.count("*").alias("n"), *[F.sum(v).alias(v) for v in values])
    )
    sums = ["n", *values, "overlap", "flipped"]
    # Rows by year have no paragraph key, so they make no pairs.
    small = (
        counted.withColumns(_pairs(ref_year, group_cols))
        .groupBy(*group_cols, "year", "by_year", "pred_label", *names)
        .agg(*[F.sum(c).alias(c) for c in sums])
    )
    rows = F.when(F.col("by_year"), F.col("n")).otherwise(0)
    count_where = lambda condition: F.coalesce(F.sum(F.when(condition, rows)), F.lit(0))
    confident = F.lit(False)
    for side in sides:
        confident = confident | F.col(f"is_sure_{side}").isNotNull()
    return small.groupBy(*group_cols, "year").agg(
        count_where(F.col("bin").isNotNull()).alias("n"),
        F.array(*[count_where(F.col("bin") == i) for i in range(stats.N_BINS)]).alias("bins"),
        count_where(confident).alias("n_confidence"),
        *[count_where(F.col(f"is_sure_{s}").isNotNull()).alias(f"n_{s}") for s in sides],
        *[F.sum(F.col(f"is_sure_{s}") * F.col("n")).alias(f"sure_{s}") for s in sides],
        *[F.sum(v).alias(f"sum_{v}") for v in values],
        F.collect_list(F.when(~F.col("by_year"), F.struct("pred_label", F.col("n").alias("rows")))).alias("classes"),
        F.sum("overlap").alias("overlap"),
        F.sum("flipped").alias("flipped"),
    )


def _class_entries() -> Column:
    """Share of each predicted class from `classes`; NULL labels count in the total only."""
    total = F.aggregate("classes", F.lit(0).cast("long"), lambda acc, c: acc + c["rows"])
    known = F.filter("classes", lambda c: c["pred_label"].isNotNull())

    def entry(c: Column) -> Column:
        name = F.concat(F.lit("pred_class_"), c["pred_label"].cast("long").cast("string"), F.lit("_fraction"))
        return F.struct(name.alias("metric_name"), (c["rows"] / total).alias("metric_value"))

    return F.transform(known, entry)


def concept_drift(predictions: DataFrame, ref_year: int, group_cols: list[str] = MODEL) -> DataFrame:
    """Class shares, probability summaries and flip rates of all other years, from one scan."""
    wide = _others(_measured(predictions, ref_year, PROBABILITIES[1], group_cols), ref_year)
    return _report_rows(wide.withColumn("ref_year", F.lit(ref_year)), {}, group_cols)


def _report_rows(wide: DataFrame, more: dict[str, Column], group_cols: list[str]) -> DataFrame:
    metrics = {**more, **_summary_metrics(), "label_flip_rate": _flip_rate()}
    entries = F.array(
        *[F.struct(F.lit(k).alias("metric_name"), v.alias("metric_value")) for k, v in metrics.items()]
    )
    return (
        wide.select("year", "ref_year", *group_cols, F.inline(F.concat(entries, _class_entries())))
        .filter(F.col("metric_value").isNotNull())
    )


def drift_report(
    predictions: DataFrame,
    ref_year: int,
    prob_col: str = "prob_republican",
    group_cols: list[str] = MODEL,
) -> DataFrame:
    """All data and concept drift rows of all years, from one scan of the predictions."""
    wide = _measured(predictions, ref_year, prob_col, group_cols)
    scored = _others(_beside_reference(wide, ref_year, group_cols), ref_year)
    return _report_rows(scored, _score_metrics(prob_col), group_cols)
