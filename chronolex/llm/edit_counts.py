"""Token counts that follow edits: a segment tree of pieces per document, re-encoded only where touched."""

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from chronolex.llm.pieces import default_path, encoder, slices

LEAF_PIECES = 16
# A leaf that would get more pieces than this after an edit is split.
MOST_PIECES = 2 * LEAF_PIECES
SLICE_BYTES = 1_000_000
TREE = "leaf_chars array<int>, sums array<bigint>"
EDITS = "array<struct<pos:int,removed:int,added:string>>"


def _summed(leaves: np.ndarray) -> np.ndarray:
    """Sums over `leaves`: the root at 1, the children of i at 2i and 2i + 1, leaves last, filled with zeros."""
    size = 1 << max(0, (len(leaves) - 1).bit_length())
    sums = np.zeros(2 * size, dtype=np.int64)
    sums[size : size + len(leaves)] = leaves
    width = size
    while width > 1:
        sums[width // 2 : width] = sums[width : 2 * width].reshape(-1, 2).sum(axis=1)
        width //= 2
    return sums


class Tree:
    """Token sums and character sums over the leaves of a text, `leaves` of them."""

    def __init__(self, leaf_chars: np.ndarray, sums: np.ndarray):
        self.leaves, self.sums, self.char_sums = len(leaf_chars), sums, _summed(leaf_chars)

    @property
    def chars(self) -> np.ndarray:
        """Characters of each leaf."""
        size = len(self.char_sums) // 2
        return self.char_sums[size : size + self.leaves]

    @classmethod
    def of(cls, tokens: np.ndarray, chars: np.ndarray) -> "Tree":
        """From the tokens and characters of a text's pieces."""
        begin = np.arange(0, len(tokens), LEAF_PIECES)
        return cls(np.add.reduceat(chars, begin).astype(np.int64), _summed(np.add.reduceat(tokens, begin)))

    def _leaf(self, pos: int) -> tuple[int, int]:
        """The leaf that holds the character at `pos`, the last leaf beyond the end, and where it starts."""
        size = len(self.char_sums) // 2
        if pos >= self.char_sums[1]:
            last = self.leaves - 1
            return last, int(self.char_sums[1] - self.char_sums[size + last])
        node, start = 1, 0
        while node < size:
            node *= 2
            if pos - start >= self.char_sums[node]:
                start += int(self.char_sums[node])
                node += 1
        return node - size, start

    def region(self, pos: int, removed: int) -> tuple[int, int, int, int]:
        """Leaves (first, last) to encode anew for an edit, and the characters (start, end) they hold.

        Leaves are found by descending the character sums. A leaf begins where the pre-tokenizer cuts,
        which its first two characters and the one before it decide. So the leaf before is added if the
        edit reaches the first two, and the leaf after if the edit reaches the end: that is all the
        context a cut needs.
        """
        size = len(self.char_sums) // 2
        first, start = self._leaf(pos)
        while first > 0 and pos <= start + 1:
            first -= 1
            start -= int(self.char_sums[size + first])
        last, last_start = self._leaf(pos + removed)
        return first, last, start, last_start + int(self.char_sums[size + last])

    def update(self, first: int, last: int, tokens: np.ndarray, chars: np.ndarray) -> None:
        """Put the region's new pieces in place of its leaves and correct the sums above them.

        Pieces are shared out to the leaves there are; if those would get too many, the region gets more
        leaves, and the sums are made anew, without encoding anything.
        """
        size = len(self.sums) // 2
        if len(tokens) > MOST_PIECES * (last - first + 1):
            begin = np.arange(0, len(tokens), LEAF_PIECES)
            for name, own in (("sums", tokens), ("char_sums", chars)):
                before = getattr(self, name)[size : size + self.leaves]
                joined = np.concatenate([before[:first], np.add.reduceat(own, begin), before[last + 1 :]])
                setattr(self, name, _summed(joined))
            self.leaves = self.leaves - (last - first + 1) + len(begin)
            return
        cuts = np.linspace(0, len(tokens), last - first + 2).round().astype(int)
        for leaf, a, b in zip(range(first, last + 1), cuts, cuts[1:]):
            for sums, own in ((self.sums, tokens), (self.char_sums, chars)):
                node = size + leaf
                change = int(own[a:b].sum()) - int(sums[node])
                while node and change:
                    sums[node] += change
                    node //= 2


def _pieces(texts: list[str], path: str):
    """(tokens, characters) of the pieces of each text."""
    whole = pa.array(texts, pa.large_string())
    for start, stop in slices(whole, SLICE_BYTES):
        _, tokens, chars, counts = encoder(path).encode(whole.slice(start, stop - start))
        ends = np.cumsum(counts)
        yield from zip(np.split(tokens, ends[:-1]), np.split(chars, ends[:-1]))


def _whole(number: float | None) -> int:
    """An integer that pandas may have turned into a float beside NULLs; NULL and negative ones are 0."""
    return 0 if number is None or number != number else max(int(number), 0)


def build(text: Column, path: str | None = None) -> Column:
    """The tree of each text: struct of `leaf_chars` and `sums`; NULL counts as empty."""
    path = path or default_path()

    @F.pandas_udf(TREE)
    def trees(texts: pd.Series) -> pd.DataFrame:
        made = [Tree.of(*own) for own in _pieces([t or "" for t in texts], path)]
        return pd.DataFrame({"leaf_chars": [t.chars.astype(np.int32) for t in made], "sums": [t.sums for t in made]})

    return trees(text)


def token_count(tree: Column) -> Column:
    return tree["sums"][1]


def _edit(texts: list[str], trees: list[Tree], edits: list[list], path: str) -> tuple[list[str], np.ndarray]:
    """Apply the edits of each text to its tree, in place; the new texts and the characters encoded anew.

    Edits are taken round by round, so that regions of several texts are encoded together.
    """
    new, encoded = list(texts), np.zeros(len(texts), dtype=np.int64)
    for turn in range(max(map(len, edits), default=0)):
        places, regions = [], []
        for k, edit in enumerate(e[turn] if turn < len(e) else None for e in edits):
            if edit is None:
                continue
            pos = min(_whole(edit["pos"]), len(new[k]))
            removed = min(_whole(edit["removed"]), len(new[k]) - pos)
            added = edit["added"] or ""
            first, last, start, end = trees[k].region(pos, removed)
            new[k] = new[k][:pos] + added + new[k][pos + removed :]
            places.append((k, first, last))
            regions.append(new[k][start : end + len(added) - removed])
            encoded[k] += len(regions[-1])
        for (k, first, last), (tokens, chars) in zip(places, _pieces(regions, path)):
            trees[k].update(first, last, tokens, chars)
    return new, encoded


def apply_edits(text: Column, tree: Column, edits: Column, path: str | None = None) -> Column:
    """Apply the edits of each row to its text and tree.

    `edits` is an array of (pos, removed, added), applied in order, each to the text that the one
    before left: `removed` characters after `pos` give way to `added`. Positions and lengths beyond the
    text stop at its end; NULL parts are 0 or empty; a NULL array changes nothing; a NULL text is
    empty. The result has the new `text`, `leaf_chars` and `sums`, and `encoded_chars`, the characters
    encoded anew. The tree must be the text's own.
    """
    path = path or default_path()

    @F.pandas_udf(f"text string, {TREE}, encoded_chars bigint")
    def edited(texts: pd.Series, trees: pd.DataFrame, edits: pd.Series) -> pd.DataFrame:
        own = [Tree(np.array(c, np.int64), np.array(s, np.int64)) for c, s in zip(trees["leaf_chars"], trees["sums"])]
        new, encoded = _edit([t or "" for t in texts], own, [list(e) if e is not None else [] for e in edits], path)
        return pd.DataFrame(
            {
                "text": pd.Series(new, dtype=object),
                "leaf_chars": [t.chars.astype(np.int32) for t in own],
                "sums": [t.sums for t in own],
                "encoded_chars": encoded,
            }
        )

    return edited(text, tree, edits)


COUNTS = "tokens_before bigint, n_tokens bigint, n_chars bigint, encoded_chars bigint"


def edited_counts(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", edits_col: str = "edits", path: str | None = None) -> DataFrame:
    """Per row: id, tokens_before, n_tokens and n_chars after the edits, and encoded_chars.

    What `build` and `apply_edits` do one after the other, where neither trees nor new texts are wanted: one
    Python worker with one encoder goes through slices of about a megabyte of text and lets go of each, so
    memory follows the longest text, not the batch. NULLs count as there; a row that repeats an id is a row
    of its own; NULL ids stay; an empty table gives no rows. Other columns are not looked at.
    """
    path = path or default_path()

    def counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for start, stop in slices(batch.column(1), SLICE_BYTES):
                part = batch.slice(start, stop - start)
                texts = [t or "" for t in part.column(1).to_pylist()]
                trees = [Tree.of(*own) for own in _pieces(texts, path)]
                before = pa.array([int(t.sums[1]) for t in trees], pa.int64())
                new, encoded = _edit(texts, trees, [e or [] for e in part.column(2).to_pylist()], path)
                values = [before, pa.array([int(t.sums[1]) for t in trees], pa.int64()), pa.array([len(t) for t in new], pa.int64()), pa.array(encoded)]
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), *values], names=[id_col, "tokens_before", "n_tokens", "n_chars", "encoded_chars"]
                )
                del part, texts, trees, new
                pa.default_memory_pool().release_unused()

    rows = docs.select(F.col(id_col).alias(id_col), F.col(text_col).alias("_text"), F.col(edits_col).cast(EDITS).alias("_edits"))
    return rows.mapInArrow(counted, f"`{id_col}` {rows.schema[0].dataType.simpleString()}, {COUNTS}")
