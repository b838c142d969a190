"""SimHash near-duplicates: fingerprints, pigeonhole blocks, checked Hamming distances, components."""

import itertools
from collections.abc import Iterator

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql.types import LongType

from chronolex.llm.components import connected_components
from chronolex.sources.scratch import materialize

SEED = 42
# Members of a bucket that one task compares with each other or with as many others.
TILE = 512
SLICE_SHINGLES = 50_000


def _fingerprint(text: str | None, width: int) -> int:
    words = (text or "").encode("utf-8", "replace").lower().split()  # bytes: A-Z and ASCII white space only
    if not words:
        return 0
    n = max(1, len(words) - width + 1)
    counts = np.zeros(64, dtype=np.int64)
    for start in range(0, n, SLICE_SHINGLES):
        part = words[start : min(start + SLICE_SHINGLES, n) + width - 1]
        shingles = map(b" ".join, zip(*(part[i:] for i in range(width)))) if len(part) >= width else [b" ".join(part)]
        hashes = np.array([xxhash.xxh64_intdigest(s, SEED) for s in shingles], dtype="<u8")
        bits = np.unpackbits(hashes.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        counts += bits.sum(axis=0, dtype=np.int64)
    return int(np.packbits(counts * 2 > n, bitorder="little").view("<i8")[0])


def fingerprint(text: Column, width: int = 3) -> Column:
    """64-bit SimHash of `text` as a long.

    A-Z are lower-cased, words are runs of other characters than `[\\x20\\x09-\\x0D]`, shingles are
    `width` words joined by a space, repeats included; with fewer words the whole sequence is one
    shingle. A bit is set if it is set in over half of the shingles' XXH64. No words, or NULL: zero.
    """

    @F.pandas_udf(LongType())
    def of(texts: pd.Series) -> pd.Series:
        return pd.Series([_fingerprint(t, width) for t in texts], dtype="int64")

    return of(text)


def block_masks(distance: int, spare: int) -> list[int]:
    """Masks of which two fingerprints within `distance` agree on at least one.

    64 bits are cut into `distance + spare` blocks; `distance` differing bits leave `spare` blocks
    alone, so each choice of `spare` blocks is a mask.
    """
    edges = np.linspace(0, 64, distance + spare + 1).round().astype(int)
    blocks = [sum(1 << bit for bit in range(a, b)) for a, b in itertools.pairwise(edges)]
    return [sum(chosen) for chosen in itertools.combinations(blocks, spare)]


def _signed(mask: int) -> int:
    return mask - (1 << 64) if mask >> 63 else mask


def _forest(values: np.ndarray, distance: int) -> tuple[np.ndarray, np.ndarray]:
    """Links that connect whatever is connected among `values` at `distance`: fewer links than values."""
    near = np.bitwise_count(values[:, None] ^ values[None, :]) <= distance
    label = np.arange(len(values))
    while True:
        low = np.where(near, label[None, :], len(values)).min(axis=1)
        low = low[low]
        if (low == label).all():
            break
        label = low
    linked = np.flatnonzero(label != np.arange(len(values)))
    return values[linked], values[label[linked]]


def _tile_links(distance: int):
    keys = ["mask", "key", "i", "j"]

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        left = None  # rows of the last tile seen, which may go on in the next batch
        for batch in itertools.chain(batches, [None]):
            rows = left if batch is None else batch if left is None else pd.concat([left, batch])
            if rows is None or not len(rows):
                continue
            parts = [rows[k].to_numpy() for k in keys]
            changed = np.flatnonzero(np.logical_or.reduce([p[1:] != p[:-1] for p in parts])) + 1
            ends = [*changed, *([len(rows)] if batch is None else [])]
            values = rows["fp"].to_numpy().view("uint64")
            found = [_forest(values[a:b], distance) for a, b in zip([0, *ends], ends)]
            if found:
                a, b = (np.concatenate(side).view("int64") for side in zip(*found))
                yield pd.DataFrame({"a": a, "b": b})
            left = rows.iloc[ends[-1] if ends else 0 :]

    return run


def links(fingerprints: DataFrame, distance: int = 3, spare: int = 3, tile: int = TILE) -> DataFrame:
    """Links (a, b) between distinct fingerprints that connect all pairs within `distance`.

    `fingerprints` has one column `fp` without repeats. Each fingerprint gets one key per mask of
    `block_masks`; with the default of six blocks taken three at a time, 20 keys of 32 bits, so that
    by chance few others share one, however many documents there are. Only keys that several
    fingerprints share go on. A bucket is cut into slices of about `tile`, and each pair of slices is
    a tile of its own that one task compares; a tile gives a spanning forest, never all its pairs.
    """
    masks = F.array(*[F.lit(_signed(m)) for m in block_masks(distance, spare)])
    keyed = fingerprints.select("fp", F.posexplode(masks).alias("mask", "key")).select(
        "fp", F.col("mask").cast("tinyint").alias("mask"), F.col("fp").bitwiseAND(F.col("key")).alias("key")
    )
    shared = keyed.groupBy("mask", "key").agg(F.count("*").alias("n")).filter("n > 1")
    slices = F.ceil(F.col("n") / tile).cast("int")
    members = (
        keyed.join(shared, ["mask", "key"])
        .withColumns({"own": F.pmod(F.xxhash64("fp"), slices).cast("int"), "slices": slices})
        .select("*", F.explode(F.sequence(F.lit(0), F.col("slices") - 1)).alias("other"))
        .select("mask", "key", F.least("own", "other").alias("i"), F.greatest("own", "other").alias("j"), "fp")
    )
    tiles = members.repartition("mask", "key", "i", "j").sortWithinPartitions("mask", "key", "i", "j")
    return tiles.mapInPandas(_tile_links(distance), "a long, b long")


def near_duplicates(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", width: int = 3, distance: int = 3
) -> DataFrame:
    """One row per input row: id, `fingerprint` (16 hex digits), `component_id`.

    Fingerprints at `distance` or fewer differing bits are linked; the component id is the smallest
    id reachable over links, the own id included. Equal fingerprints are one node, so copies cost
    nothing beyond their own row. Empty and NULL texts have fingerprint zero and are linked like any
    other; ids may repeat (each row is returned) or be NULL (never a component id, unless a component
    has no other). An empty table gives no rows. Other columns are not looked at. Runs actions.
    """
    marked = materialize(
        docs.select(F.col(id_col).alias(id_col), fingerprint(F.col(text_col), width).alias("fp")), "fingerprints"
    )
    firsts = materialize(marked.groupBy("fp").agg(F.min(id_col).alias("first")), "distinct-fingerprints")
    nodes = connected_components(links(firsts.select("fp"), distance))
    grouped = firsts.join(nodes.withColumnRenamed("node", "fp"), "fp", "left").withColumn(
        "component", F.coalesce("component", "fp")
    )
    lowest = grouped.groupBy("component").agg(F.min("first").alias("component_id"))
    by_print = grouped.join(lowest, "component").select("fp", "component_id")
    shown = F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint")
    return marked.join(by_print, "fp").select(id_col, shown, "component_id")


def keep_one(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The documents whose id is the component id of their component, with all their columns.

    Rows that repeat an id are one document and stay or go together, as do their texts' components.
    Rows with a NULL id cannot be told apart and all stay.
    """
    kept = near_duplicates(docs, id_col, text_col).filter(F.col(id_col) == F.col("component_id"))
    kept = materialize(kept.select(id_col).distinct(), "kept")
    stays = docs.join(kept.hint("shuffle_hash"), [id_col], "left_semi")
    return stays.unionByName(docs.filter(F.col(id_col).isNull()))
