"""Topics by expectation maximisation, as sums that do not depend on the order of rows."""

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql.types import ArrayType, DoubleType, IntegerType, LongType, StructType

from chronolex.operators.terms import MIN_DOC_FREQ, VOCABULARY_SIZE, vocabulary
from chronolex.sources.scratch import materialize

TOPICS, ITERATIONS = 10, 20
# Expected counts are summed as whole numbers of 1e-9: the same under any partitioning.
UNIT = 1e9
# Occurrences after which a task hands on its sums: those of one term stay below 2^63 units.
OCCURRENCES = 4_000_000_000


def _start(term: Column, topics: int, seed: int) -> Column:
    """Start weight of a term in each topic, 1 to 2, from a hash: no random numbers, no order of rows."""
    digest = lambda z: F.conv(F.substring(F.md5(F.concat(F.lit(f"{seed}/{z}/"), term)), 1, 8), 16, 10).cast("double")
    return F.array(*[1.0 + digest(z) / 4294967296.0 for z in range(topics)])


def _let(value: Column, body) -> Column:
    """`body` of a value that is computed once, however often it is used."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def _normalised(values: Column) -> Column:
    """Values over their sum; even shares where the sum is 0."""
    total = lambda v: F.aggregate(v, F.lit(0.0), lambda a, x: a + x)
    over = lambda v, t: F.transform(v, lambda x: F.when(t > 0, x / t).otherwise(1.0 / F.size(v)))
    return _let(values, lambda v: _let(total(v), lambda t: over(v, t)))


def _flat(lists: pa.Array) -> tuple[np.ndarray, pa.Array]:
    """Lengths of lists, and their values one after the other; NULL is empty."""
    return pc.fill_null(pc.list_value_length(lists), 0).to_numpy(zero_copy_only=False).astype(np.int64), lists.flatten()


def _lists(lengths: np.ndarray, values: np.ndarray) -> pa.Array:
    offsets = np.concatenate([[0], np.cumsum(lengths)]).astype(np.int32)
    return pa.ListArray.from_arrays(pa.array(offsets), pa.array(values))


def _numbered_counts(terms: list[str]):
    """The words of each row as numbers `ids` and counts `ns` of its terms; other words are left out."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = pa.array(terms, pa.string())
        for batch in batches:
            lengths, words = _flat(batch.column(batch.num_columns - 1))
            found = pc.index_in(words.cast(pa.string()), known, skip_nulls=True)
            inside = found.is_valid().to_numpy(zero_copy_only=False)
            row = np.repeat(np.arange(len(batch)), lengths)[inside]
            pairs, counts = np.unique(row * max(1, len(terms)) + found.drop_null().to_numpy(), return_counts=True)
            row, ids = np.divmod(pairs, max(1, len(terms)))
            per_row = np.bincount(row, minlength=len(batch))
            columns = [_lists(per_row, ids.astype(np.int32)), _lists(per_row, counts.astype(np.float64))]
            yield pa.RecordBatch.from_arrays(batch.columns[:-1] + columns, names=batch.schema.names[:-1] + ["ids", "ns"])

    return run


def _with_counts(words: DataFrame, terms: list[str], columns: list[str], words_col: str) -> DataFrame:
    """Rows with the numbers and counts of their vocabulary terms, as arrays `ids` and `ns`."""
    known = words.select(*columns, F.col(words_col).cast("array<string>").alias("_words"))
    schema = StructType(known.schema.fields[:-1]).add("ids", ArrayType(IntegerType())).add("ns", ArrayType(DoubleType()))
    return known.mapInArrow(_numbered_counts(terms), schema)


def fit_topics(
    words: DataFrame,
    columns: list[str],
    topics: int = TOPICS,
    iterations: int = ITERATIONS,
    seed: int = 0,
    words_col: str = "filtered_words",
    min_doc_freq: int = MIN_DOC_FREQ,
    vocabulary_size: int = VOCABULARY_SIZE,
) -> tuple[DataFrame, DataFrame]:
    """Probabilistic topics: (rows with `share`, an array of topic shares; terms with `weight`, their topic weights).

    Each round weighs every (row, term, topic) by share times weight, normalised over topics, as `expected_counts`
    does for one look; a round does it in numpy, an Arrow batch at a time. The new shares of a
    row come from its own terms, inside the row; only expected counts per term are shuffled, after they are
    combined per task, so a round moves at most vocabulary x tasks rows. The table of weights (vocabulary
    times topics doubles, 4 MB at the defaults) is the one thing every task gets; `vocabulary_size` bounds it.
    A row without vocabulary terms keeps even shares. Repeated rows count as often as they occur. An empty
    table has no rows and no terms. Runs actions.
    """
    found = vocabulary(words, words_col, min_doc_freq, vocabulary_size).select("term")
    # At most `vocabulary_size` terms reach the driver, as in every vectorizer.
    listed = sorted(r["term"] for r in found.collect())
    numbered = words.sparkSession.createDataFrame(list(enumerate(listed)), "id int, term string")
    terms = materialize(numbered.withColumn("weight", _start(F.col("term"), topics, seed)), "topics")
    weights = _column_shares(terms, topics)
    docs = _with_counts(words, listed, columns, words_col)
    docs = materialize(docs.withColumn("share", F.array(*[F.lit(1.0 / topics)] * topics)), "topic-rows")
    for i in range(iterations):
        docs, weights = _round(docs, weights, columns, topics, last=i == iterations - 1)
    named = weights.join(terms.select("id", "term"), "id").select("term", "weight")
    return docs.select(*columns, "share"), named


def _column_shares(weights: DataFrame, topics: int) -> DataFrame:
    """Weights that add up to one per topic."""
    totals = weights.agg(F.array(*[F.sum(_whole(F.col("weight")[z])) for z in range(topics)]).alias("totals")).scalar()
    shares = F.array(*[F.coalesce(_whole(F.col("weight")[z]).cast("double") / F.nullif(totals[z].cast("double"), F.lit(0.0)), F.lit(0.0)) for z in range(topics)])
    return weights.select("id", shares.alias("weight"))


def _whole(x: Column) -> Column:
    return F.rint(x * UNIT).cast("long").cast("decimal(19,0)")


def expected_counts(docs: DataFrame, weights: DataFrame, columns: list[str]) -> DataFrame:
    """Rows with `expected`: per term of the row, how many of its occurrences belong to each topic."""
    # In the order of their numbers, which start at 0 without a gap.
    ordered = F.sort_array(F.collect_list(F.struct("id", "weight")))
    table = weights.agg(F.transform(ordered, lambda e: e["weight"]).alias("t")).scalar()
    # A subquery may not be written inside a lambda, so the table is a column first; the optimizer joins both steps,
    # and the table is part of no row.
    expected = F.zip_with(
        "ids", "ns",
        lambda i, n: F.transform(_normalised(F.zip_with(F.get("_table", i), F.col("share"), lambda w, s: w * s)), lambda r: r * n),
    )
    return docs.withColumn("_table", table).select(*columns, "ids", "ns", "share", expected.alias("expected"))


def _reweighed(weights: np.ndarray, last: bool):
    """One round over rows (..., ids, ns, share): the rows with their new shares, then expected counts per term.

    Both kinds leave by one pass; a row of either kind has NULL in the columns of the other. The last round's rows
    come without ids and ns.
    """
    topics = weights.shape[1]

    def normalised(values: np.ndarray) -> np.ndarray:
        total = values.sum(axis=1, keepdims=True)
        return np.divide(values, total, out=np.full_like(values, 1.0 / topics), where=total > 0)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kinds, names, sums, seen = [], [], np.zeros((topics, len(weights)), dtype=np.int64), 0.0

        def counted() -> pa.RecordBatch:
            used = np.flatnonzero(sums.any(axis=0))
            per_term = _lists(np.full(len(used), topics), np.ascontiguousarray(sums[:, used].T).ravel())
            others = [pa.nulls(len(used), kind) for kind in kinds]
            return pa.RecordBatch.from_arrays([*others, pa.array(used.astype(np.int32)), per_term], names=names)

        for batch in batches:
            lengths, ids = _flat(batch.column("ids"))
            ids, ns = ids.to_numpy(zero_copy_only=False), _flat(batch.column("ns"))[1].to_numpy(zero_copy_only=False)
            share = _flat(batch.column("share"))[1].to_numpy(zero_copy_only=False).reshape(len(batch), topics)
            expected = normalised(weights[ids] * np.repeat(share, lengths, axis=0)) * ns[:, None]
            some = lengths > 0
            new = share.copy()
            if some.any():
                new[some] = normalised(np.add.reduceat(expected, (np.cumsum(lengths) - lengths)[some], axis=0))
            if seen + ns.sum() > OCCURRENCES and kinds:
                yield counted()
                sums[:], seen = 0, 0.0
            seen += ns.sum()
            whole = np.rint(expected * UNIT).astype(np.int64)
            for z in range(topics):
                np.add.at(sums[z], ids, whole[:, z])
            kept = batch.drop_columns(["ids", "ns", "share"] if last else ["share"])
            shares = _lists(np.full(len(batch), topics), new.ravel())
            kinds, names = [*kept.schema.types, shares.type], [*kept.schema.names, "share", "_id", "_sums"]
            none = [pa.nulls(len(batch), pa.int32()), pa.nulls(len(batch), pa.list_(pa.int64()))]
            yield pa.RecordBatch.from_arrays([*kept.columns, shares, *none], names=names)
        if kinds:
            yield counted()

    return run


def _round(docs: DataFrame, weights: DataFrame, columns: list[str], topics: int, last: bool) -> tuple[DataFrame, DataFrame]:
    known = weights.toArrow()
    ids = known.column("id").to_numpy()
    # A row per vocabulary term, by number; a term that occurs nowhere weighs nothing.
    table = np.zeros((int(ids.max()) + 1 if len(ids) else 0, topics))
    table[ids] = np.array(known.column("weight").to_pylist()).reshape(len(ids), topics)
    rows = [f for f in docs.schema.fields if f.name in columns or f.name == "share" or not last]
    schema = StructType([*rows]).add("_id", IntegerType()).add("_sums", ArrayType(LongType()))
    both = materialize(docs.mapInArrow(_reweighed(table, last), schema), "topic-round")
    sums = [F.sum(F.col("_sums")[z].cast("decimal(19,0)")).cast("double") / UNIT for z in range(topics)]
    counts = both.filter("_id IS NOT NULL").groupBy(F.col("_id").alias("id")).agg(F.array(*sums).alias("weight"))
    docs = both.filter("_id IS NULL").select(*[f.name for f in rows])
    return docs, _column_shares(materialize(counts, "topic-weights"), topics)


def share_by_year(shares: DataFrame) -> DataFrame:
    """Mean topic share per year: year, topic, share. The sums do not depend on the order of rows."""
    long = shares.select("year", F.posexplode("share").alias("topic", "value"))
    means = long.groupBy("year", "topic").agg(F.sum(_whole(F.col("value"))).alias("total"), F.count("*").alias("n"))
    return means.select("year", "topic", (F.col("total").cast("double") / UNIT / F.col("n")).alias("share"))


def top_terms(weights: DataFrame, topic: int, top: int = 20) -> DataFrame:
    """The `top` terms of a topic, ties in term order: a bounded report."""
    weight = F.col("weight")[topic]
    return weights.select("term", weight.alias("weight")).orderBy(F.col("weight").desc(), "term").limit(top)
