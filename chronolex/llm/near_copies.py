"""Near copies at a word-shingle similarity: long SimHash fingerprints, pigeonhole blocks, exact check of close calls.

The method of `simhash` for a lower similarity than few differing bits can express. At a similarity of 0.8, a
seventh of all bits differ, which no few blocks of 64 bits survive; of 3,072 bits, some of 139 blocks do.
"""

import itertools
import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, functions as F

from chronolex.llm.components import connected_components
from chronolex.operators.skew import join_even, join_lookup
from chronolex.sources.scratch import materialize

SEED = 42
WIDTH = 5
SIMILARITY = 0.8
LANES = 48  # fingerprint bits in words of 64
# Bits and number of blocks up to this many nodes; `block_places` gives those of larger tables.
BLOCK, BLOCKS, BLOCK_NODES = 22, 139, 50_000
SHARED_BITS = 1.04  # more blocks for each further bit, which keeps the recall
# Members of a bucket that one task compares with each other or with as many others.
TILE = 1024
SLICE_SHINGLES = 255  # bit counts of a slice fit in a byte
DEVIATIONS = 4.0

_ODD = np.uint64(0x9E3779B97F4A7C15)
_LANES = (np.arange(1, LANES + 1, dtype=np.uint64) * _ODD)[None, :]


def shingle_hashes(text: str | None, width: int = WIDTH) -> np.ndarray:
    """Sorted distinct 64-bit hashes of the shingles: `width` words, or all words of a shorter text.

    A-Z are lower-cased, words are runs of other characters than `[\\x20\\x09-\\x0D]`. No words, or NULL: none.
    """
    words = (text or "").encode("utf-8", "replace").lower().split()
    if not words:
        return np.zeros(0, dtype=np.uint64)
    own = np.array([xxhash.xxh64_intdigest(w, SEED) for w in words], dtype=np.uint64)
    width = min(width, len(own))
    rolled = np.zeros(len(own) - width + 1, dtype=np.uint64)
    for i in range(width):
        rolled = rolled * _ODD + own[i : len(own) - width + 1 + i]
    return np.unique(rolled ^ (rolled >> np.uint64(31)))


def long_fingerprint(hashes: np.ndarray) -> np.ndarray:
    """SimHash of `64 * LANES` bits, as bytes: a bit is set if it is set in over half of the shingles' mixed hashes."""
    counts = np.zeros(64 * LANES, dtype=np.int32)
    for start in range(0, len(hashes), SLICE_SHINGLES):
        mixed = hashes[start : start + SLICE_SHINGLES, None] + _LANES
        mixed ^= mixed >> np.uint64(30)
        mixed *= np.uint64(0xBF58476D1CE4E5B9)
        mixed ^= mixed >> np.uint64(27)
        mixed *= np.uint64(0x94D049BB133111EB)
        mixed ^= mixed >> np.uint64(31)
        counts += np.unpackbits(mixed.view(np.uint8), axis=1).sum(axis=0, dtype=np.uint8)
    return np.packbits(counts * 2 > len(hashes))


def differing_share(similarity: float) -> float:
    """Mean share of differing bits: sets of equal size and Jaccard similarity s have the cosine 2s / (1 + s).

    A bit differs with probability angle / pi.
    """
    return math.acos(min(1.0, 2 * similarity / (1 + similarity))) / math.pi


def block_places(nodes: int, similarity: float) -> np.ndarray:
    """The bits of each block, a row per block.

    Unrelated nodes meet in a block by chance, so a block of fixed width gives meetings with the square of the
    nodes. A block therefore gets one more bit whenever nodes double, which holds the chance of a node to meet
    any; the number of blocks grows by as much as a pair of `similarity` loses in one, and a little more, since blocks
    share bits then. The first blocks are cut from the bits in their order, further ones from the same bits in
    fixed random orders.
    """
    extra = max(0, math.ceil(math.log2(max(nodes, 1) / BLOCK_NODES)))
    width, bits = min(BLOCK + extra, 32), 64 * LANES
    count = math.ceil(BLOCKS * (SHARED_BITS / (1 - differing_share(similarity))) ** (width - BLOCK))
    rng, order, found = np.random.default_rng(SEED), np.arange(bits), []
    while len(found) < count:
        found += list(order[: bits // width * width].reshape(-1, width))
        order = rng.permutation(bits)
    return np.array(found[:count])


def distance_bounds(similarity: float) -> tuple[int, int]:
    """Differing bits up to which a pair surely has `similarity`, and beyond which it surely has not.

    Both bounds lie DEVIATIONS standard deviations from the mean share of differing bits.
    """
    bits, share = 64 * LANES, differing_share(similarity)
    spread = DEVIATIONS * math.sqrt(share * (1 - share) / bits)
    return int(bits * (share - spread)), math.ceil(bits * (share + spread))


def _marks(width: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            nodes, prints, sets = [], [], []
            for text in batch.column(1):
                hashes = shingle_hashes(text.as_py(), width)
                nodes.append(np.int64(np.uint64(xxhash.xxh64_intdigest(hashes.tobytes(), SEED)).astype(np.int64)))
                prints.append(long_fingerprint(hashes).tobytes() if len(hashes) else None)
                sets.append(hashes.astype(np.uint32).view(np.int32))
            offsets = np.concatenate([[0], np.cumsum([len(s) for s in sets])]).astype(np.int32)
            flat = pa.array(np.concatenate([*sets, np.zeros(0, dtype=np.int32)]))
            columns = [
                batch.column(0),
                pa.array(nodes, pa.int64()),
                pa.array(prints, pa.binary()),
                pa.ListArray.from_arrays(pa.array(offsets), flat),
            ]
            yield pa.RecordBatch.from_arrays(columns, names=["id", "node", "print", "shingles"])

    return run


def _blocks(places: np.ndarray):
    """Nodes with the value of each of their blocks, and their last 128 bits."""
    count, width = places.shape

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for start in range(0, len(batch), 500):
                part = batch.slice(start, 500)
                prints = np.frombuffer(b"".join(part.column(1).to_pylist()), dtype=np.uint8).reshape(len(part), -1)
                picked = np.unpackbits(prints, axis=1)[:, places.ravel()].reshape(-1, width)
                keys = np.zeros((len(picked), 4), dtype=np.uint8)
                keys[:, : (width + 7) // 8] = np.packbits(picked, axis=1)
                offsets = np.arange(len(part) + 1, dtype=np.int32) * count
                brief = np.ascontiguousarray(prints[:, -16:]).view(np.int64)
                yield pa.RecordBatch.from_arrays(
                    [
                        part.column(0),
                        pa.array(np.ascontiguousarray(brief[:, 0])),
                        pa.array(np.ascontiguousarray(brief[:, 1])),
                        pa.ListArray.from_arrays(pa.array(offsets), pa.array(keys.view("<i4").ravel())),
                    ],
                    names=["node", "c0", "c1", "keys"],
                )

    return run


def _sliced(members: DataFrame, shared: DataFrame, tile: int) -> DataFrame:
    """Members of shared keys, dealt to tiles (key, i, j): each pair of slices of a key is one tile."""
    slices = F.ceil(F.col("n") / tile).cast("int")
    return (
        join_lookup(members, shared, ["key"], "inner")
        .withColumns({"own": F.pmod(F.xxhash64("node"), slices).cast("int"), "slices": slices})
        .withColumn("other", F.explode(F.sequence(F.lit(0), F.col("slices") - 1)))
        .withColumns({"i": F.least("own", "other"), "j": F.greatest("own", "other")})
        .drop("own", "other", "slices", "n")
        .repartition("key", "i", "j")
        .sortWithinPartitions("key", "i", "j")
    )


def _per_tile(body):
    """Calls `body(rows)` with the rows of each tile; its frames are joined per batch."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        left = None  # rows of the last tile seen, which may go on in the next batch
        for batch in itertools.chain(batches, [None]):
            rows = left if batch is None else batch if left is None else pd.concat([left, batch], ignore_index=True)
            if rows is None or not len(rows):
                continue
            parts = [rows[k].to_numpy() for k in ("key", "i", "j")]
            changed = np.flatnonzero(np.logical_or.reduce([p[1:] != p[:-1] for p in parts])) + 1
            ends = [*changed, *([len(rows)] if batch is None else [])]
            if ends:
                yield body(rows, list(zip([0, *ends], ends)))
            left = rows.iloc[ends[-1] if ends else 0 :]

    return run


def _with_neighbour(limit: int):
    """Members (key, node) with another member within `limit` of the 128 brief bits."""

    def body(rows: pd.DataFrame, spans: list) -> pd.DataFrame:
        brief = rows[["c0", "c1"]].to_numpy().astype(np.int64).view(np.uint64)
        kept = np.zeros(len(rows), dtype=bool)
        for a, b in spans:
            for start in range(a, b, 64):
                some = brief[start : min(start + 64, b)]
                near = np.bitwise_count(some[:, None, :] ^ brief[None, a:b, :]).sum(axis=2, dtype=np.int32) <= limit
                kept[start : start + len(some)] = near.sum(axis=1) > 1  # itself is one
        return rows.loc[kept, ["key", "node"]]

    return _per_tile(body)


def _shortest_links(limit: int):
    """Links of a minimum spanning forest of each tile, by differing bits up to `limit`."""

    def forest(prints: np.ndarray) -> list[tuple[int, int, int]]:
        found = []
        outside = np.arange(1, len(prints))
        near = np.bitwise_count(prints[0] ^ prints[outside]).sum(axis=1, dtype=np.int32)
        source = np.zeros(len(outside), dtype=np.int64)
        while len(outside):
            k = int(near.argmin())
            new = outside[k]
            if near[k] <= limit:
                found.append((int(source[k]), int(new), int(near[k])))
            rest = np.arange(len(outside)) != k
            outside, near, source = outside[rest], near[rest], source[rest]
            own = np.bitwise_count(prints[new] ^ prints[outside]).sum(axis=1, dtype=np.int32)
            closer = own < near
            near, source = np.where(closer, own, near), np.where(closer, new, source)
        return found

    def body(rows: pd.DataFrame, spans: list) -> pd.DataFrame:
        prints = np.frombuffer(b"".join(rows["print"]), dtype=np.uint64).reshape(len(rows), -1)
        node = rows["node"].to_numpy()
        found = [(node[a + x], node[a + y], bits) for a, b in spans for x, y, bits in forest(prints[a:b])]
        return pd.DataFrame(found, columns=["a", "b", "bits"]).astype({"a": "int64", "b": "int64", "bits": "int32"})

    return _per_tile(body)


def candidate_links(prints: DataFrame, similarity: float = SIMILARITY, tile: int = TILE) -> DataFrame:
    """Links (a, b, bits) between nodes whose fingerprints share a block and may have `similarity` by their bits.

    `prints` has `node` and `print`, one row per node, no NULLs; it is counted first. Pairs that differ in fewer bits
    than there are blocks in one order of the bits surely share one. Keys held by one node end there; of the others, members whose last 128
    bits are far from all others' go next (4.5 standard deviations of slack), so that chance meetings cost
    a few bytes, not a fingerprint. A bucket is compared in tiles; each gives its minimum spanning forest:
    whatever a lower limit connects stays connected, and no tile lists all its pairs. Runs actions.
    """
    limit = distance_bounds(similarity)[1]
    places = block_places(prints.count(), similarity)
    blocks = prints.select("node", "print").mapInArrow(_blocks(places), "node long, c0 long, c1 long, keys array<int>")
    blocks = materialize(blocks, "blocks")
    keyed = blocks.select("node", "c0", "c1", F.posexplode("keys").alias("place", "bits")).select(
        "node", "c0", "c1", ((F.col("place").cast("long") * (1 << 32)) + F.col("bits")).alias("key")
    )
    shared = materialize(keyed.groupBy("key").agg(F.count("*").alias("n")).filter("n > 1"), "shared-keys")
    share = limit / (64 * LANES)
    brief = math.ceil(128 * share + 4.5 * math.sqrt(128 * share * (1 - share)))
    near = _sliced(keyed, shared, tile).mapInPandas(_with_neighbour(brief), "key long, node long")
    near = materialize(near.distinct(), "near-members")
    again = materialize(near.groupBy("key").agg(F.count("*").alias("n")).filter("n > 1"), "shared-keys")
    wanted = near.select("node").distinct()
    carried = join_even(near, prints.join(wanted, "node", "left_semi"), ["node"], "inner")
    links = _sliced(carried, again, tile).mapInPandas(_shortest_links(limit), "a long, b long, bits int")
    a, b = F.greatest("a", "b"), F.least("a", "b")
    return links.select(a.alias("a"), b.alias("b"), "bits").distinct()


def _jaccard(a: Column, b: Column) -> Column:
    shared = F.size(F.array_intersect(a, b)).cast("double")
    return shared / (F.size(a) + F.size(b) - shared)


def _checked(links: DataFrame, marked: DataFrame, similarity: float, sure: int) -> DataFrame:
    """`links` of more than `sure` bits stay if the shingle sets of both ends have `similarity`."""
    open_links = links.filter(F.col("bits") > sure)
    ends = materialize(open_links.select(F.explode(F.array("a", "b")).alias("node")).distinct(), "checked-nodes")
    sets = join_lookup(marked.select("node", "shingles"), ends, ["node"], "left_semi")
    # Rows of one node hold the same set; any of them will do.
    sets = materialize(sets.groupBy("node").agg(F.first("shingles").alias("shingles")), "checked-sets")
    of = lambda end: sets.select(F.col("node").alias(end), F.col("shingles").alias(f"of_{end}"))
    both = join_even(join_even(open_links, of("a"), ["a"], "inner"), of("b"), ["b"], "inner")
    passed = both.filter(_jaccard(F.col("of_a"), F.col("of_b")) >= similarity)
    return links.filter(F.col("bits") <= sure).select("a", "b").unionByName(passed.select("a", "b"))


def near_copies(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    width: int = WIDTH,
    similarity: float = SIMILARITY,
    tile: int = TILE,
) -> DataFrame:
    """One row per input row: id, `component_id`, the smallest id of its component of near copies.

    Two texts are near copies if the Jaccard similarity of their sets of shingles of `width` words is
    `similarity` or more. Texts with the same shingles are one node, told by a 64-bit hash of them. Nodes
    that share a block of their long fingerprints and differ in few enough bits are linked; links whose
    bits leave the similarity open are checked on the sets themselves, as 32-bit hashes of all shingles.

    Texts without words, NULL or empty, are copies of each other. Ids may repeat (each row is returned)
    or be NULL (never a component id, unless a component has no other). An empty table gives no rows.
    Other columns are not looked at. Runs actions.
    """
    sure, _ = distance_bounds(similarity)
    narrow = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    kind = narrow.schema["id"].dataType.simpleString()
    marked = materialize(
        narrow.mapInArrow(_marks(width), f"id {kind}, node long, print binary, shingles array<int>"), "near-copy-marks"
    )
    firsts = materialize(marked.groupBy("node").agg(F.min("id").alias("first"), F.count("*").alias("copies")), "near-copy-nodes")
    prints = marked.filter("print IS NOT NULL").groupBy("node").agg(F.first("print").alias("print"))
    links = materialize(candidate_links(materialize(prints, "long-fingerprints"), similarity, tile), "near-copy-links")
    linked = connected_components(_checked(links, marked, similarity, sure))
    grouped = firsts.join(linked, "node", "left").withColumn("component", F.coalesce("component", "node"))
    lowest = grouped.groupBy("component").agg(F.min("first").alias("component_id"))
    # A component's nodes may be many: each of them is one row of the larger side, salted where hot.
    by_node = materialize(join_even(grouped.select("node", "component"), lowest, ["component"], "inner"), "near-copy-groups")
    rows = join_even(marked.select("id", "node"), by_node.select("node", "component_id"), ["node"], "inner", firsts.select("node", "copies"))
    return rows.select(F.col("id").alias(id_col), "component_id")


def keep_one(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", similarity: float = SIMILARITY) -> DataFrame:
    """The documents whose id is the component id of their near copies, with all their columns.

    Rows that repeat an id are one document: they stay if it is the component id of any of their texts, and
    go together otherwise. Rows with a NULL id cannot be told apart and all stay. An empty table stays empty.
    """
    found = materialize(near_copies(docs, id_col, text_col, similarity=similarity), "near-copies")
    heads = found.select(F.col("component_id").alias(id_col)).distinct()
    gone = found.filter(F.col(id_col) != F.col("component_id")).select(id_col).distinct()
    gone = materialize(gone.join(heads, [id_col], "left_anti"), "near-copies-gone")
    return join_lookup(docs, gone, [id_col], "left_anti").select(*docs.columns)
