"""Benchmark decontamination: latent semantic search for candidates, then common subsequences and answers."""

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.core.broadcast import Broadcast
from pyspark.sql import Column, DataFrame, functions as F


RANK = 64
OVERSAMPLE = 8
# Words of a passage whose co-occurrences are learned, and of the cells that windows are made of.
PASSAGE = 32
CELL = 4
# Windows of 4 to 64 words, in cells; an item is searched for in windows of about its own length, a longer
# one in parts of the longest window. Each scale is the sum of the one before and another one.
SCALES = (1, 2, 3, 4, 6, 8, 12, 16)
# A window is a candidate at MARGIN times the cosine of a paraphrase among unrelated words in the worst place.
MARGIN = 0.75
# Words between the places that are compared.
PLACE = 8
# Words in a row that make a candidate whatever the cosine, so that no verbatim item depends on it.
SEED_WORDS = 4
WINDOWS_AT_ONCE = 4096
WORD_BITS = 64
SEARCHED_BYTES = 400_000
SHARE = 0.8  # of an item's words, in order, that make a leak
PARAPHRASE = 0.6  # the same if the answer is there, too
ANSWER_WORDS = 5
ITEMS_PER_BLOCK = 500
TERMS_PER_SUM = 2048
WORDS_PER_SUM = 16_384
SEED = 11
NOT_WORD = r"[^\p{L}\p{N}_]+"


# For texts in ASCII and Latin letters, byte by byte: lower case, and a space for what is in no word.
_BYTES = bytes(
    b if b >= 0x80 else ord(chr(b).lower()) if chr(b).isalnum() or chr(b) == "_" else 0x20 for b in range(256)
)


def _spaced(texts: pa.Array) -> pa.Array:
    """Lower case, with spaces for all characters but letters, digits and underscores."""
    offsets = np.frombuffer(texts.buffers()[1], dtype=np.int64)[texts.offset : texts.offset + len(texts) + 1]
    data = texts.buffers()[2]
    raw = np.frombuffer(data or b"", dtype=np.uint8)[offsets[0] : offsets[-1]]
    if len(raw) and (raw.max() > 0xC3 or (raw == 0xC2).any()):
        return pc.replace_substring_regex(pc.utf8_lower(texts), NOT_WORD, " ")
    raw = np.frombuffer(bytearray(raw.tobytes().translate(_BYTES)), dtype=np.uint8)
    # After the lead byte C3, 80 to 9E are capitals 20 below their small letters; 97 and B7 are signs.
    at = np.flatnonzero(raw == 0xC3) + 1
    second = raw[at]
    signs = at[(second == 0x97) | (second == 0xB7)]
    raw[at] = np.where(second < 0x9F, second + 0x20, second)
    raw[signs] = raw[signs - 1] = 0x20
    buffers = [None, pa.py_buffer((offsets - offsets[0]).tobytes()), pa.py_buffer(raw)]
    return pa.Array.from_buffers(pa.large_string(), len(texts), buffers)


def words_of(texts: pa.Array) -> tuple[pa.Array, np.ndarray]:
    """Words of all texts, one after the other, and words per text: lower case, without punctuation."""
    cut = pc.split_pattern(_spaced(pc.fill_null(texts.cast(pa.large_string()), "")), " ")
    flat, counts = cut.flatten(), pc.list_value_length(cut).to_numpy(zero_copy_only=False).astype(np.int64)
    filled = pc.greater(pc.binary_length(flat), 0)
    owner = np.repeat(np.arange(len(counts)), counts)[filled.to_numpy(zero_copy_only=False)]
    return flat.filter(filled), np.bincount(owner, minlength=len(counts))


class Items:
    """A block of benchmark items as rows of terms."""

    def __init__(self, rows: list):
        self.ids = [row[0] for row in rows]
        flat, counts = words_of(pa.array([row[1] for row in rows], pa.large_string()))
        answers, answer_counts = words_of(pa.array([row[2] for row in rows], pa.large_string()))
        coded = pa.concat_arrays([flat, answers]).dictionary_encode()
        self.vocabulary = coded.dictionary
        at = coded.indices.to_numpy(zero_copy_only=False).astype(np.int64)
        # Terms of item texts come first; those from `searched` on are in answers only and in no latent vector.
        self.searched = int(at[: len(flat)].max(initial=-1)) + 1
        self.terms = np.split(at[: len(flat)], np.cumsum(counts)[:-1])
        given = np.split(at[len(flat) :], np.cumsum(answer_counts)[:-1])
        # Terms of the answer if there is one, else the item's last words.
        self.answers = [own if row[2] else terms[-ANSWER_WORDS:] for row, own, terms in zip(rows, given, self.terms)]

    def codes(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """Term of each word, -1 for words that no item or answer has, and words per text."""
        flat, counts = words_of(texts)
        at = pc.fill_null(pc.index_in(flat, self.vocabulary), -1)
        return at.to_numpy(zero_copy_only=False), counts


def benchmark_blocks(benchmark: DataFrame, id_col: str = "item_id", text_col: str = "text") -> Iterator[Items]:
    """The query set in blocks of ITEMS_PER_BLOCK, each of which is small enough for every task. Runs actions."""
    answer = F.col("answer").cast("string") if "answer" in benchmark.columns else F.lit(None).cast("string")
    rows = benchmark.select(F.col(id_col), F.col(text_col).cast("string"), answer).orderBy(id_col, text_col)
    block = []
    for row in rows.toLocalIterator():
        block.append(tuple(row))
        if len(block) == ITEMS_PER_BLOCK:
            yield Items(block)
            block = []
    if block:
        yield Items(block)


def _runs(texts: pa.Array, limit: int = 1_000_000) -> Iterator[tuple[int, int]]:
    """(start, stop) of runs of texts with about `limit` bytes each, one text at least."""
    sizes = pc.fill_null(pc.binary_length(texts), 0).to_numpy(zero_copy_only=False).astype(np.int64)
    start, size = 0, 0
    for stop, own in enumerate(sizes):
        if size and size + own > limit:
            yield start, stop
            start, size = stop, 0
        size += own
    if start < len(sizes):
        yield start, len(sizes)


def _places(counts: np.ndarray) -> np.ndarray:
    """Place of each word in its text."""
    return np.arange(counts.sum()) - np.repeat(np.cumsum(counts) - counts, counts)


def _slot_sums(vectors: np.ndarray, codes: np.ndarray, slots: np.ndarray, count: int, size: int) -> np.ndarray:
    """Sums of the vectors of the words in each of `count` cells of `size` slots; negative codes add nothing."""
    blank = np.concatenate([vectors, np.zeros((1, vectors.shape[1]), vectors.dtype)])
    table = np.full(count * size, len(vectors), dtype=np.int32)
    table[slots] = np.where(codes >= 0, codes, len(vectors))
    columns = np.ascontiguousarray(table.reshape(count, size).T)
    sums = blank[columns[0]]
    for column in columns[1:]:
        sums += blank[column]
    return sums


def _sketch(items: Items, test: np.ndarray):
    """Per task: passages, passages with each term, and C'C times the test matrix.

    C holds the term counts of the passages of all texts.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        terms, total = items.searched, 0
        sums = np.zeros((terms, 1 + test.shape[1]))
        for batch in batches:
            for start, stop in _runs(batch.column(0)):
                codes, counts = items.codes(batch.column(0).slice(start, stop - start))
                codes = np.where(codes < terms, codes, -1)
                per_text = -(-counts // PASSAGE)
                places = _places(counts)
                passage = np.repeat(np.cumsum(per_text) - per_text, counts) + places // PASSAGE
                total += int(per_text.sum())
                known = codes >= 0
                # A term counts once per passage.
                pairs = np.sort(passage[known] * terms + codes[known])
                sums[:, 0] += np.bincount(pairs[np.diff(pairs, prepend=-1) > 0] % terms, minlength=terms)
                # A passage without terms adds nothing.
                used, passage = np.unique(passage[known], return_inverse=True)
                if len(used):
                    slots = passage * PASSAGE + places[known] % PASSAGE
                    own = codes[known]
                    sketched = _slot_sums(test, own, slots, len(used), PASSAGE)
                    # What the passages of each term add up to, some words at a time.
                    order = np.argsort(own, kind="stable")
                    for at in range(0, len(order), WORDS_PER_SUM):
                        part = order[at : at + WORDS_PER_SUM]
                        term = own[part]
                        first = np.flatnonzero(np.diff(term, prepend=-1))
                        sums[term[first], 1:] += np.add.reduceat(sketched[passage[part]], first, axis=0)
        if total:
            parts = [sums[i : i + TERMS_PER_SUM].tobytes() for i in range(0, terms, TERMS_PER_SUM)]
            yield pa.RecordBatch.from_arrays(
                [pa.array(range(len(parts))), pa.array([total] * len(parts)), pa.array(parts, pa.binary())],
                names=["part", "passages", "sums"],
            )

    return run


def _added(rows: pd.DataFrame) -> pd.DataFrame:
    total = sum(np.frombuffer(s) for s in rows["sums"])
    return pd.DataFrame({"part": rows["part"].iloc[:1], "passages": [rows["passages"].sum()], "sums": [total.tobytes()]})


def fit(docs: DataFrame, items: Items, text_col: str = "text") -> np.ndarray:
    """Latent vectors (term, RANK) of the terms of TF-IDF passages.

    A randomised SVD in one pass: every task counts the passages of each term and multiplies the term
    counts C of its passages by a random matrix and back, C'(C test), over all documents, however many;
    the sums are added up in two rounds. With W the inverse passage frequencies, W C'C W is the Gram
    matrix of the TF-IDF passages, and W times the sketch is that matrix times W^-1 test, whence its
    leading eigenvectors by a Nystrom step. A passage's coordinates are divided by the singular values,
    so that no direction rules the cosine. What is gathered is terms x (RANK + OVERSAMPLE) numbers,
    whatever the corpus. Runs actions.
    """
    terms = items.searched
    width = min(RANK + OVERSAMPLE, terms)
    test = np.random.default_rng(SEED).normal(size=(terms, width)).astype(np.float32)
    spark = docs.sparkSession
    # One partial sum per task, so tasks are as many as the cluster keeps busy and not as many as files.
    tasks = max(64, 4 * spark.sparkContext.defaultParallelism)
    schema = "part long, passages long, sums binary"
    texts = docs.select(F.col(text_col).cast("string")).coalesce(tasks)
    partial = texts.mapInArrow(_sketch(items, test), schema)
    salted = partial.withColumn("salt", F.pmod(F.spark_partition_id(), F.lit(int(tasks**0.5))))
    once = salted.groupBy("part", "salt").applyInPandas(lambda rows: _added(rows), schema)
    summed = once.groupBy("part").applyInPandas(lambda rows: _added(rows), schema).orderBy("part").collect()
    if not summed or not terms:
        return np.zeros((terms, 1), dtype=np.float32)
    sums = np.concatenate([np.frombuffer(row["sums"]).reshape(-1, 1 + width) for row in summed])
    weight = np.log((1 + summed[0]["passages"]) / (1 + sums[:, 0])) + 1e-3
    sketch, probe = sums[:, 1:] * weight[:, None], test / weight[:, None]
    q, r = np.linalg.qr(probe)
    product = np.linalg.solve(r.T, sketch.T).T  # the Gram matrix times an orthonormal basis
    shift = 1e-6 * np.linalg.norm(product)
    product = product + shift * q
    core = q.T @ product
    vectors, values, _ = np.linalg.svd(product @ _inverse_root(core), full_matrices=False)
    keep = np.flatnonzero(values[:RANK] ** 2 > 2 * shift)
    return (weight[:, None] * vectors[:, keep] / values[keep]).astype(np.float32)


def _inverse_root(matrix: np.ndarray) -> np.ndarray:
    values, vectors = np.linalg.eigh((matrix + matrix.T) / 2)
    values = np.maximum(values, values.max() * 1e-12)
    return vectors / np.sqrt(values)


def common(regions: np.ndarray, items: np.ndarray) -> np.ndarray:
    """Length of the longest common subsequence per row; negative numbers match nothing."""
    best = np.zeros((len(regions), regions.shape[1] + 1), dtype=np.int32 if items.shape[1] > 30_000 else np.int16)
    for k in range(items.shape[1]):
        hit = (regions == items[:, k : k + 1]) & (items[:, k : k + 1] >= 0)
        best[:, 1:] = np.maximum(best[:, 1:], best[:, :-1] + hit)
        np.maximum.accumulate(best, axis=1, out=best)
    return best[:, -1]


def _overlap(n: int, window: int) -> float:
    """Words of a passage of n words in the best of the windows that begin every CELL words, at the worst."""
    return max(1.0, min(n, window, (n + window - CELL) / 2))


def _run_hashes(codes: np.ndarray, size: int) -> np.ndarray:
    """Hash of each run of `size` codes."""
    hashes = np.zeros(max(0, len(codes) - size + 1), dtype=np.int64)
    for k in range(size):
        hashes = hashes * np.int64(0x5851F42D4C957F2D) + codes[k : k + len(hashes)]
    return hashes


class Search:
    """Finds the items of a block in whole texts."""

    def __init__(self, items: Items, vectors: np.ndarray):
        self.items, self.vectors = items, vectors
        self.sizes = np.array([len(t) for t in items.terms])
        # Number of a term among an item's, 0 if it has it not; the last column is for words that no item has.
        kind = np.int32 if self.sizes.max(initial=0) > 30_000 else np.int16
        self.slots = np.zeros((len(items.ids), len(items.vocabulary) + 1), dtype=kind)
        # Where the term stands in the item, a bit per word, for items of up to WORD_BITS words.
        self.masks = np.zeros((len(items.ids), WORD_BITS + 1), dtype=np.uint64)
        for k, terms in enumerate(items.terms):
            distinct, number = np.unique(terms, return_inverse=True)
            self.slots[k, distinct] = np.arange(1, len(distinct) + 1)
            if len(terms) <= WORD_BITS:
                np.bitwise_or.at(self.masks[k], number + 1, np.uint64(1) << np.arange(len(terms), dtype=np.uint64))
        self.member = self.slots > 0
        # Per scale: unit vectors of items, or of parts of long ones, whose they are, where the item begins
        # as seen from the window, the least cosine, and the fewest words of items in a window.
        self.queries: dict[int, tuple[np.ndarray, ...]] = {}
        longest = SCALES[-1] * CELL
        parts: dict[int, list] = {scale: [] for scale in SCALES}
        for k, terms in enumerate(items.terms):
            for start in range(0, len(terms), longest):
                if start and len(terms) - start < longest // 2:
                    start = len(terms) - longest
                n = len(terms[start : start + longest])
                scale = min(SCALES, key=lambda s: abs(np.log(s * CELL / n)))
                vector = vectors[terms[start : start + longest]].sum(axis=0)
                overlap = _overlap(n, scale * CELL)
                bound = MARGIN * PARAPHRASE * overlap / np.sqrt(n * scale * CELL)
                parts[scale].append((vector, k, (scale * CELL - n) // 2 - start, bound, PARAPHRASE * n - (n - overlap)))
        for scale, own in parts.items():
            if own:
                matrix, *rest = (np.array(column) for column in zip(*own))
                norms = np.linalg.norm(matrix, axis=1, keepdims=True)
                self.queries[scale] = ((matrix / np.maximum(norms, 1e-9)).astype(np.float32), *rest)
        self.seeds = self._seeds()

    def _seeds(self) -> list[tuple[int, np.ndarray, np.ndarray, np.ndarray]]:
        """Per length: sorted hashes of runs of SEED_WORDS words of items, or of shorter whole ones, items, places."""
        runs: dict[int, list] = {}
        for k, terms in enumerate(self.items.terms):
            size = min(len(terms), SEED_WORDS)
            if size:
                hashes = _run_hashes(terms, size)
                runs.setdefault(size, []).append((hashes, np.full(len(hashes), k), np.arange(len(hashes))))
        found = []
        for size, own in runs.items():
            hashes, item, place = (np.concatenate(column) for column in zip(*own))
            order = np.argsort(hashes, kind="stable")
            found.append((size, hashes[order], item[order], place[order]))
        return found

    def _seeded(self, codes: np.ndarray, counts: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
        """(text, item, word where the item would begin) for each run of words that a text shares with an item."""
        left = np.repeat(np.cumsum(counts), counts) - np.arange(len(codes))
        for size, hashes, item, place in self.seeds:
            if len(codes) < size:
                continue
            known = left[: len(codes) - size + 1] >= size
            for k in range(size):
                known &= codes[k : len(codes) - size + 1 + k] >= 0
            at = np.flatnonzero(known)
            own = _run_hashes(codes, size)[at]
            first = np.searchsorted(hashes, own)
            hit = np.flatnonzero(hashes[np.minimum(first, len(hashes) - 1)] == own)
            at, first, last = at[hit], first[hit], np.searchsorted(hashes, own[hit], side="right")
            many = last - first
            row = np.repeat(first - (np.cumsum(many) - many), many) + np.arange(many.sum())
            at = np.repeat(at, many)
            text = np.searchsorted(np.cumsum(counts), at, side="right")
            yield text, item[row], at - (np.cumsum(counts) - counts)[text] - place[row]

    def candidates(self, codes: np.ndarray, counts: np.ndarray) -> np.ndarray:
        """Distinct (text, item, place) where the item may begin: a similar window, or a run of its words.

        A place is PLACE words and may lie before the text.
        """
        codes = np.where(codes < self.items.searched, codes, -1)
        gap = SCALES[-1]  # blank cells between texts, so that no window sees two
        cells = -(-counts // CELL) + gap
        begin = np.cumsum(cells) - cells
        places = _places(counts)
        cell = np.repeat(begin, counts) + places // CELL
        total = int(cells.sum())
        windows = {1: _slot_sums(self.vectors, codes, cell * CELL + places % CELL, total, CELL)}
        filled = {1: np.bincount(cell[codes >= 0], minlength=total)}
        owner = np.repeat(np.arange(len(counts)), cells)
        # A window that begins in the blanks after a text may see the next one; it is no window of either.
        inside = np.arange(total) < np.repeat(begin + cells - gap, cells)
        lift = (int(self.sizes.max(initial=0)) + gap * CELL) // PLACE + 1  # places that an item may begin before its text
        reach = int(cells.max(initial=0)) * CELL // PLACE + 2 * lift
        found = []

        def keep(text: np.ndarray, item: np.ndarray, word: np.ndarray) -> None:
            found.append(np.unique((text * len(self.sizes) + item) * reach + word // PLACE + lift))

        for before, scale in zip((0, *SCALES), SCALES):
            if before:
                # A window is the widest one so far, and one that begins where that ends.
                for sums in (windows, filled):
                    sums[scale] = sums[before].copy()
                    sums[scale][:-before] += sums[scale - before][before:]
            if scale not in self.queries:
                continue
            queries, item, offset, bound, least = self.queries[scale]
            all_rows = np.flatnonzero(inside & (filled[scale] >= max(1, least.min())))
            for start in range(0, len(all_rows), WINDOWS_AT_ONCE):
                rows = all_rows[start : start + WINDOWS_AT_ONCE]
                own = windows[scale][rows]
                norms = np.sqrt(np.einsum("ij,ij->i", own, own))
                hit = (own / np.maximum(norms, 1e-9)[:, None]) @ queries.T >= bound.astype(np.float32)
                at, column = np.divmod(np.flatnonzero(hit), hit.shape[1])
                at = rows[at]
                text = owner[at]
                keep(text, item[column], (at - begin[text]) * CELL + offset[column])
        for text, item, word in self._seeded(codes, counts):
            keep(text, item, word)
        keys = np.unique(np.concatenate(found)) if found else np.empty(0, np.int64)
        pair, place = np.divmod(keys, max(1, reach))
        return np.stack([*np.divmod(pair, len(self.sizes)), place - lift], axis=1)

    def find(self, texts: pa.Array) -> list[dict]:
        """Per text the items found in it, and the best of them."""
        codes, counts = self.items.codes(texts)
        begin = np.cumsum(counts) - counts
        # Words that no item has are in the last column of the slots.
        padded = np.where(codes < 0, len(self.items.vocabulary), codes)
        padded = np.append(padded, np.full(4 * WORD_BITS, len(self.items.vocabulary)))
        found: list[dict] = [{} for _ in range(len(counts))]
        rows = self.candidates(codes, counts)
        rows = rows[self._promising(rows, padded, begin, counts)]
        for own in self._batches(rows):
            text, item, place = own.T
            size = self.sizes[item]
            # Where the item would be, and half its length and a place on either side.
            around = PLACE + size // 2
            low = np.maximum(place * PLACE - around, 0)
            length = np.minimum(place * PLACE + size + around, counts[text]) - low
            if size[0] <= WORD_BITS:
                share = self._common(padded, begin[text] + low, length, item) / size
            else:
                at = np.minimum(np.arange(size[0] + 2 * around[0]), np.maximum(length - 1, 0)[:, None])
                inside = np.arange(at.shape[1]) < length[:, None]
                regions = np.where(inside, padded[(begin[text] + low)[:, None] + at], len(self.items.vocabulary))
                # Fewer of the item's words than a leak needs: no order of them can be one.
                enough = np.flatnonzero((self.slots[item[:, None], regions] > 0).sum(axis=1) >= PARAPHRASE * size)
                share = np.zeros(len(item))
                if len(enough):
                    terms = np.stack([self.items.terms[k] for k in item[enough]])
                    share[enough] = common(regions[enough], terms) / size[enough]
            for row in np.flatnonzero(share >= PARAPHRASE):
                t, k, s = text[row], item[row], share[row]
                if s > found[t].get(k, 0):
                    # An answer may begin or end beside the region.
                    more = len(self.items.answers[k])
                    near = slice(begin[t] + max(0, low[row] - more), begin[t] + min(counts[t], low[row] + length[row] + more))
                    if s >= SHARE or self._answered(codes[near], k):
                        found[t][k] = float(s)
        return found

    def _promising(self, rows: np.ndarray, padded: np.ndarray, begin: np.ndarray, counts: np.ndarray) -> np.ndarray:
        """Which candidates of short items have as many words of the item around them as a leak needs.

        With fewer, no order of them can be one. Neighbouring places of one text and item are looked at
        together, in the region that holds all of theirs.
        """
        if not len(rows):
            return np.ones(0, dtype=bool)
        apart = (np.diff(rows[:, :2], axis=0) != 0).any(axis=1) | (np.diff(rows[:, 2]) != 1)
        starts = np.concatenate([[0], np.flatnonzero(apart) + 1])
        ends = np.append(starts[1:], len(rows)) - 1
        text, item, place = rows[starts].T
        size = self.sizes[item]
        around = PLACE + size // 2
        low = np.maximum(place * PLACE - around, 0)
        length = np.minimum(rows[ends, 2] * PLACE + size + around, counts[text]) - low
        enough = np.ones(len(starts), dtype=bool)
        # Long runs of places, and long items, are left to the comparison itself.
        short = np.flatnonzero((size <= WORD_BITS) & (length <= 4 * WORD_BITS))
        short = short[np.argsort(length[short], kind="stable")]
        flat, width = self.member.ravel(), self.member.shape[1]
        for start in range(0, len(short), WINDOWS_AT_ONCE):
            own = short[start : start + WINDOWS_AT_ONCE]
            steps = np.arange(int(length[own].max()))
            there = flat[(item[own] * width)[:, None] + padded[(begin[text[own]] + low[own])[:, None] + steps]]
            there &= steps < length[own][:, None]
            enough[own] = there.sum(axis=1) >= PARAPHRASE * size[own]
        return np.repeat(enough, ends - starts + 1)

    def _batches(self, rows: np.ndarray) -> Iterator[np.ndarray]:
        """Candidates in batches: those of items of up to WORD_BITS words together, longer ones by their length."""
        size = self.sizes[rows[:, 1]]
        short = size <= WORD_BITS
        for start in range(0, int(short.sum()), WINDOWS_AT_ONCE):
            yield rows[short][start : start + WINDOWS_AT_ONCE]
        for own in np.unique(size[~short]):
            alike = rows[size == own]
            some = max(1, min(2000, 1_000_000 // (2 * int(own) + 2 * PLACE)))
            for start in range(0, len(alike), some):
                yield alike[start : start + some]

    def _common(self, padded: np.ndarray, first: np.ndarray, length: np.ndarray, item: np.ndarray) -> np.ndarray:
        """As common(), for items of up to WORD_BITS words: a bit per word of the item, one step per word of the text."""
        width, deep = self.slots.shape[1], self.masks.shape[1]
        slots, masks = self.slots.ravel(), self.masks.ravel()
        order = np.argsort(-length, kind="stable")  # the rows that a step still reaches are the first ones
        row, own, first = item[order] * width, item[order] * deep, first[order]
        active = np.searchsorted(-length[order], -np.arange(int(length.max(initial=0))), side="left")
        state = np.full(len(item), ~np.uint64(0))
        for step, m in enumerate(active):
            mask = masks[own[:m] + slots[row[:m] + padded[first[:m] + step]]]
            now = state[:m]
            kept = now & mask
            state[:m] = (now + kept) | (now - kept)
        result = np.empty(len(item), dtype=np.int64)
        result[order] = np.bitwise_count(~state)
        return result

    def _answered(self, region: np.ndarray, item: int) -> bool:
        answer = self.items.answers[item]
        if not len(answer) or len(answer) > len(region):
            return False
        return bool((np.lib.stride_tricks.sliding_window_view(region, len(answer)) == answer).all(axis=1).any())


def _search_column(text: Column, shared: Broadcast) -> Column:
    @F.pandas_udf("array<struct<item_id:bigint,share:double>>")
    def search(texts: pd.Series) -> pd.Series:
        found, ids = [], shared.value.items.ids
        whole = pa.array(texts, pa.large_string(), from_pandas=True)
        for start, stop in _runs(whole, SEARCHED_BYTES):
            for own in shared.value.find(whole.slice(start, stop - start)):
                found.append([{"item_id": ids[k], "share": s} for k, s in sorted(own.items())])
        del whole
        pa.default_memory_pool().release_unused()
        return pd.Series(found, dtype=object)

    return search(text)


def found_items(docs: DataFrame, benchmark: DataFrame, text_col: str = "text") -> Column | None:
    """Column with the benchmark items found in each whole text, as an array of (item_id, share).

    None if the benchmark has no item with words. Runs actions.
    """
    columns = []
    for items in benchmark_blocks(benchmark):
        if items.searched:
            search = Search(items, fit(docs, items, text_col))
            columns.append(_search_column(F.col(text_col), docs.sparkSession.sparkContext.broadcast(search)))
    return F.concat(*columns) if columns else None


def leaks(docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per input row: id, contaminated, item_ids, item_id, share.

    Candidates are overlapping windows of the whole text whose latent vectors are similar to an item's: at
    MARGIN times the cosine, or more, that a paraphrase has if its other words are unrelated and it lies
    worst between the windows; and places where SEED_WORDS words of an item stand in a row. A candidate counts if the longest common subsequence of its surroundings and
    the item has SHARE of the item's words, or PARAPHRASE of them and the answer, word for word (the
    `answer` column, or the item's last words where there is none). `item_ids` lists the items found,
    `item_id` and `share` the best of them, on a tie the smallest id. NULL and empty texts have none;
    items without words or with a NULL id are never found; rows may repeat ids. Words are compared in
    lower case and without punctuation. Runs actions.
    """
    items = found_items(docs, benchmark.filter("item_id IS NOT NULL"), text_col)
    none = F.array().cast("array<struct<item_id:bigint,share:double>>")
    marked = docs.select(F.col(id_col).alias(id_col), (none if items is None else F.coalesce(items, none)).alias("_items"))
    best = F.array_max(F.transform("_items", lambda i: F.struct(i["share"].alias("share"), (-i["item_id"]).alias("item"))))
    return marked.select(
        id_col,
        (F.size("_items") > 0).alias("contaminated"),
        F.array_sort(F.array_distinct(F.transform("_items", lambda i: i["item_id"]))).alias("item_ids"),
        (-best["item"]).alias("item_id"),
        best["share"].alias("share"),
    )


def keep_uncontaminated(docs: DataFrame, benchmark: DataFrame, text_col: str = "text") -> DataFrame:
    """The documents in which no benchmark item is found, with all their columns.

    NULL and empty texts stay; each row, of a repeated id too, is judged by its own text. Without items all
    rows stay, and an empty table stays empty. Runs actions.
    """
    items = found_items(docs, benchmark.filter("item_id IS NOT NULL"), text_col)
    return docs if items is None else docs.filter(F.coalesce(F.size(items), F.lit(0)) <= 0)
