"""Bins, divergences and intervals as column arithmetic."""

from pyspark.sql import Column, functions as F

# The ten equal bins of [0, 1] as doubles (0.1 * k accumulates rounding error).
BIN_EDGES = [0.0, 0.1, 0.2, 0.30000000000000004, 0.4, 0.5, 0.6000000000000001, 0.7000000000000001, 0.8, 0.9, 1.0]
N_BINS = len(BIN_EDGES) - 1
PSI_EPSILON = 1e-6
KL_EPSILON = 1e-10
Z_95 = 1.96


def _in_bin(p: Column, i: int, right_closed: bool) -> Column:
    low, high = F.lit(BIN_EDGES[i]), F.lit(BIN_EDGES[i + 1])
    if right_closed:
        return ((p >= low) if i == 0 else (p > low)) & (p <= high)
    return (p >= low) & ((p <= high) if i == N_BINS - 1 else (p < high))


def bin_counts(p: Column, right_closed: bool = False) -> Column:
    """Aggregate: array of ten counts of `p`. Values outside [0, 1] and NULL fall in no bin.

    Left-closed bins close the last one on the right; right-closed bins include 0 in the first.
    Ten conditional counts combine on the map side, and empty bins are 0 without a grid join.
    """
    return F.array(*[F.count_if(_in_bin(p, i, right_closed)) for i in range(N_BINS)])


def right_closed_bin(p: Column) -> Column:
    """Right-closed bin of `p`, the one that `bin_counts` counts it in; NULL outside [0, 1] and for NULL."""
    return F.coalesce(*[F.when(_in_bin(p, i, True), F.lit(i)) for i in range(N_BINS)])


# Values are summed as whole numbers of 1e-15.
EXACT, EXACT_LIMIT = 1e15, 9_000.0


def exact(x: Column) -> Column:
    """`x` to 15 decimal places as a whole number, whose sums do not depend on the order of rows.

    NULL where `x` is not finite, or EXACT_LIMIT or more in size. Made from a long, not from the text of a
    double, which would cost more than all else in a scan of probabilities.
    """
    # NaN is above all numbers.
    return F.when(F.abs(x) < EXACT_LIMIT, F.rint(x * EXACT).cast("long").cast("decimal(19,0)"))


def mean_of(total: Column, n: Column) -> Column:
    """Mean from a sum of `exact` values and a count."""
    return (total / F.nullif(n, F.lit(0))).cast("double") / EXACT


def variance_of(total: Column, squares: Column, n: Column) -> Column:
    """Population variance from exact sums of values and squares."""
    mean = mean_of(total, n)
    return F.greatest(mean_of(squares, n) - mean * mean, F.lit(0.0))


def bin_index(p: Column) -> Column:
    """Left-closed bin of `p`; -1 outside [0, 1], NULL for NULL."""
    index = F.when(p.isNull(), F.lit(None).cast("int"))
    for i in range(N_BINS):
        index = index.when(_in_bin(p, i, False), i)
    return index.otherwise(-1)


def _sum(values: Column) -> Column:
    return F.aggregate(values, F.lit(0.0), lambda acc, x: acc + x)


def psi(ref_counts: Column, ref_n: Column, cur_counts: Column, cur_n: Column) -> Column:
    """Population stability index of two binned samples; n may exceed the binned total."""

    def share(count: Column, n: Column) -> Column:
        return (count + F.lit(PSI_EPSILON)) / (n + F.lit(PSI_EPSILON * N_BINS))

    terms = F.zip_with(
        ref_counts,
        cur_counts,
        lambda r, c: (share(c, cur_n) - share(r, ref_n)) * F.log(share(c, cur_n) / share(r, ref_n)),
    )
    return F.round(_sum(terms), 6)


def kl_divergence(ref_counts: Column, cur_counts: Column) -> Column:
    """KL(reference || current) of two binned samples, each normalised by its own sum."""

    def shares(counts: Column) -> Column:
        total = _sum(F.transform(counts, lambda c: c + F.lit(KL_EPSILON)))
        return F.transform(counts, lambda c: (c + F.lit(KL_EPSILON)) / total)

    terms = F.zip_with(shares(ref_counts), shares(cur_counts), lambda r, c: r * F.log(r / c))
    return F.round(_sum(terms), 6)


def wilson_interval(successes: Column, n: Column, z: float = Z_95) -> tuple[Column, Column]:
    """Wilson score interval, clamped to [0, 1]; (0, 0) when n is 0."""
    size = F.nullif(n.cast("double"), F.lit(0.0))
    p = successes / size
    z2 = z * z
    denominator = 1 + F.lit(z2) / size
    centre = (p + F.lit(z2) / (2 * size)) / denominator
    spread = F.lit(z) * F.sqrt(p * (1 - p) / size + F.lit(z2) / (4 * size * size)) / denominator
    # greatest and least skip NULL, so the empty case is taken out first.
    low = F.when(size.isNull(), 0.0).otherwise(F.greatest(F.lit(0.0), centre - spread))
    high = F.when(size.isNull(), 0.0).otherwise(F.least(F.lit(1.0), centre + spread))
    return low, high


def drift_severity(psi_value: Column, warning: float, critical: float) -> Column:
    return (
        F.when(psi_value >= critical, F.lit("critical"))
        .when(psi_value >= warning, F.lit("moderate"))
        .otherwise(F.lit("none"))
    )
