"""Vector code compression: one codebook per part of the vectors, exact search by slices and bitmasks."""

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from chronolex.llm.vectors import matrix, summed, whole_vectors
from chronolex.operators.skew import join_lookup
from chronolex.sources.scratch import materialize

SCALE = 4096
PARTS, ENTRIES, ROUNDS = 8, 16, 6
# Scaled components stay below it, so that squared distances and their sums over a vector fit a long.
LIMIT = 2.0**27
# Candidate components compared at once.
BLOCK_CELLS = 1 << 20


class Slices:
    """The entries of one codebook: per dimension, sorted coordinates with prefix masks of the entries.

    `masks[d][i]` has the bits of the `i` entries with the smallest coordinates in dimension `d`, in as many
    uint64 words as the entries need. Two looks at sorted coordinates give the entries within a range of a
    dimension, and AND over the dimensions the entries within a box.
    """

    def __init__(self, entries: np.ndarray):
        self.entries = entries
        count, width = entries.shape
        self.order = np.argsort(entries, axis=0, kind="stable").T
        self.sorted = np.sort(entries, axis=0).T
        words = -(-count // 64)
        bits = np.zeros((count, words), dtype=np.uint64)
        bits[np.arange(count), np.arange(count) // 64] = np.uint64(1) << (np.arange(count) % 64).astype(np.uint64)
        self.masks = np.zeros((width, count + 1, words), dtype=np.uint64)
        for d in range(width):
            self.masks[d, 1:] = np.bitwise_or.accumulate(bits[self.order[d]], axis=0)
        self.all = np.bitwise_or.reduce(bits, axis=0)

    def within(self, x: np.ndarray, radius: np.ndarray) -> np.ndarray:
        """Masks of the entries whose coordinates all lie within `radius` of those of each row."""
        found = np.tile(self.all, (len(x), 1))
        for d in range(x.shape[1]):
            low = np.searchsorted(self.sorted[d], x[:, d] - radius, side="left")
            high = np.searchsorted(self.sorted[d], x[:, d] + radius, side="right")
            found &= self.masks[d, high] & ~self.masks[d, low]
        return found

    def nearest(self, x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Nearest entry of each row, ties to the lower index, and its squared distance.

        The initial radius is the distance to one entry, the one next in the first dimension. The nearest
        entry is not farther, hence no coordinate of it is, so it is within the box, and so is every entry at
        the same distance.
        """
        count, width = self.entries.shape
        if not width:
            return np.zeros(len(x), dtype=np.int64), np.zeros(len(x), dtype=np.int64)
        block = max(1, BLOCK_CELLS // (count * width))
        parts = [self._nearest(x[a : a + block]) for a in range(0, len(x), block)]
        return tuple(np.concatenate(side) for side in zip(*parts))

    def _nearest(self, x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        count = len(self.entries)
        place = np.minimum(np.searchsorted(self.sorted[0], x[:, 0]), count - 1)
        first = ((x - self.entries[self.order[0, place]]) ** 2).sum(axis=1)
        # One more than the root, which may be rounded down; a larger box has the same nearest entry.
        found = self.within(x, np.sqrt(first).astype(np.int64) + 1)
        bits = np.unpackbits(found.astype("<u8").view(np.uint8), axis=1, bitorder="little")[:, :count]
        rows, entries = np.nonzero(bits)  # by row, then entry
        distance = ((x[rows] - self.entries[entries]) ** 2).sum(axis=1)
        least = np.minimum.reduceat(distance, np.searchsorted(rows, np.arange(len(x))))
        best = np.flatnonzero(distance == least[rows])
        best = best[np.unique(rows[best], return_index=True)[1]]
        return entries[best], least


def _assign(x: np.ndarray, codebooks: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Entry indexes per row and part, and the squared distances summed over parts."""
    width = codebooks.shape[2]
    own = [Slices(book).nearest(x[:, p * width : (p + 1) * width]) for p, book in enumerate(codebooks)]
    return np.stack([o[0] for o in own], axis=1), np.sum([o[1] for o in own], axis=0)


def start_codebooks(vectors: DataFrame, length: int, parts: int = PARTS, entries: int = ENTRIES) -> np.ndarray:
    """The parts of the vectors with the smallest ids: (parts, entries, width). Runs an action."""
    first = vectors.select("id", "x").orderBy(F.col("id").asc_nulls_last(), "x").limit(entries).collect()
    rows = np.array([r["x"] for r in first], dtype=np.int64).reshape(len(first), parts, length // parts)
    return np.ascontiguousarray(rows.transpose(1, 0, 2))


def refined(vectors: DataFrame, length: int, codebooks: np.ndarray) -> np.ndarray:
    """One round: every part goes to its nearest entry, each entry to the floored mean of its parts.

    What the driver gets are counts and sums per entry, as many as the codebooks have numbers. Runs an action.
    """
    parts, count, width = codebooks.shape

    def cells(x: np.ndarray) -> np.ndarray:
        codes, _ = _assign(x, codebooks)
        sums = np.zeros((parts, count, width + 1), dtype=np.int64)
        for p in range(parts):
            np.add.at(sums[p, :, 0], codes[:, p], 1)
            np.add.at(sums[p, :, 1:], codes[:, p], x[:, p * width : (p + 1) * width])
        return sums.ravel()

    sums = summed(vectors, length, cells, "bigint").astype(np.int64).reshape(parts, count, width + 1)
    used = sums[:, :, :1] > 0
    return np.where(used, np.floor_divide(sums[:, :, 1:], np.maximum(sums[:, :, :1], 1)), codebooks)


def train(vectors: DataFrame, length: int, parts: int = PARTS, entries: int = ENTRIES, rounds: int = ROUNDS) -> np.ndarray:
    """Codebooks after `rounds` rounds over all vectors. Runs actions."""
    codebooks = start_codebooks(vectors, length, parts, entries)
    for _ in range(rounds if codebooks.size else 0):
        codebooks = refined(vectors, length, codebooks)
    return codebooks


def encode(vectors: DataFrame, length: int, codebooks: np.ndarray) -> DataFrame:
    """id, label, `codes` (one entry index per part) and `error` of each row of `whole_vectors`."""

    def coded(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            codes, error = _assign(matrix(batch.column("x"), length), codebooks)
            flat = pa.array(codes.astype(np.int32).ravel())
            lists = pa.ListArray.from_arrays(pa.array(np.arange(len(codes) + 1, dtype=np.int32) * codes.shape[1]), flat)
            yield pa.RecordBatch.from_arrays(
                [batch.column("id"), batch.column("label"), lists, pa.array(error)], names=["id", "label", "codes", "error"]
            )

    own = {f.name: f.dataType.simpleString() for f in vectors.schema}
    return vectors.mapInArrow(coded, f"id {own['id']}, label {own['label']}, codes array<int>, error bigint")


def digest(codebooks: np.ndarray) -> str:
    """SHA-256 of all components by part, entry and position, as decimals with commas between."""
    return hashlib.sha256(",".join(map(str, codebooks.ravel().tolist())).encode()).hexdigest()


def compress(
    df: DataFrame,
    id_col: str = "vec_id",
    vector_col: str = "embedding",
    label_col: str = "label",
    parts: int = PARTS,
    entries: int = ENTRIES,
    rounds: int = ROUNDS,
    scale: int = SCALE,
) -> DataFrame:
    """One row per vector: id, `code` (two hex digits per part), `error`, `label_error`, `codebooks_sha256`.

    Rows whose vector is NULL or has a NULL or non-finite component are left out, as are those with a
    component of 32,768 or more in size, whose distances would not fit a long. Shorter vectors, and
    those whose length is no multiple of `parts`, count as filled with zeros. With fewer rows than
    `entries`, that many entries exist. Rows that repeat an id are rows of their own, ordered by their
    components; NULL ids are the largest. Equal labels, NULLs together, share a `label_error`. An empty
    table gives no rows. Other columns are not looked at. `entries` is at most 256. Runs actions.
    """
    vectors, length = whole_vectors(df, id_col, vector_col, {"label": F.col(label_col)}, scale, LIMIT, parts)
    codebooks = train(vectors, length, parts, entries, rounds)
    if not codebooks.shape[1]:
        codebooks = np.zeros((parts, 1, length // parts), dtype=np.int64)  # no rows to code
    rows = materialize(encode(vectors, length, codebooks), "vector-codes")
    # A key without NULLs, since the lookup join takes plain equality.
    label = F.coalesce(F.col("label").cast("string"), F.lit(""))
    keyed = rows.withColumns({"no_label": F.col("label").isNull(), "own_label": label})
    by_label = keyed.groupBy("no_label", "own_label").agg(F.sum("error").alias("label_error"))
    joined = join_lookup(keyed, materialize(by_label, "label-errors"), ["no_label", "own_label"], "inner")
    hexed = F.array_join(F.transform("codes", lambda c: F.lpad(F.lower(F.hex(c)), 2, "0")), "")
    return joined.select(
        F.col("id").alias(id_col), hexed.alias("code"), "error", "label_error", F.lit(digest(codebooks)).alias("codebooks_sha256")
    )
