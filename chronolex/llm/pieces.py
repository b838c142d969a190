"""Byte-level BPE token ids of whole texts, encoded piece by piece and remembered."""

import itertools
import os
import re

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

# A piece starts at a space or line end that has no white space beside it. The pre-tokenizer always
# cuts there, so the ids of a text are the ids of its pieces one after the other.
SPACE = r"[\s\x0b\x1c-\x1f\x{85}\p{Z}]"
LOOSE = rf"{SPACE}{SPACE}|{SPACE}$"  # RE2; such a text is cut with care
CUT = re.compile(r" (?=\S)")
# Letters and one stop or comma: two pre-tokens.
MARKED = "^[ \n]?[A-Za-zÀ-ÖØ-öø-ÿ]+[.,]$"
REMEMBERED = 300_000
LONGEST_REMEMBERED = 40


def default_path() -> str:
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json")


def _expand(table: np.ndarray, starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """The runs [start, start + length) of `table`, one after the other."""
    shift = starts - (np.cumsum(lengths) - lengths)
    return table[np.repeat(shift, lengths) + np.arange(lengths.sum())]


class PieceEncoder:
    """Encodes with the tokenizers library; what it has encoded before it does not encode again.

    Ids are unsigned, little-endian, as narrow as the vocabulary allows. Pieces are remembered up to
    `LONGEST_REMEMBERED` characters; beyond `remembered` of them it forgets all.
    """

    def __init__(self, path: str, remembered: int = REMEMBERED):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # Spark runs one worker per core already
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.encode_special_tokens = True
        self.dtype = np.dtype("<u2" if self.tokenizer.get_vocab_size() <= 1 << 16 else "<u4")
        self.remembered = remembered
        self._forget()
        self.marks = {mark: self._encode([mark])[1][0] for mark in ".,"}

    def _forget(self) -> None:
        self.known = pa.array([], pa.large_string())
        self.lengths, self.table = np.empty(0, np.int64), np.empty(0, self.dtype)

    def _encode(self, strings: list[str]) -> tuple[np.ndarray, np.ndarray]:
        found = [e.ids for e in self.tokenizer.encode_batch_fast(strings, add_special_tokens=False)]
        lengths = np.fromiter(map(len, found), dtype=np.int64, count=len(found))
        ids = np.fromiter(itertools.chain.from_iterable(found), dtype=self.dtype, count=int(lengths.sum()))
        return lengths, ids

    def _look_up(self, strings: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """Lengths and ids of distinct strings, each with its leading space if it has one."""
        marked = pc.match_substring_regex(strings, MARKED)
        bases = pc.if_else(marked, pc.utf8_slice_codeunits(strings, 0, -1), strings)
        if len(self.known) > self.remembered:
            self._forget()
        at = pc.index_in(bases, self.known)
        new = bases.filter(at.is_null()).unique()
        lengths, ids = self._encode(new.to_pylist())
        beyond = pc.add(pc.index_in(bases, new), pa.scalar(len(self.known), pa.int32()))
        at = pc.coalesce(at, beyond).to_numpy(zero_copy_only=False)
        known = pa.concat_arrays([self.known, new])
        own_lengths, table = np.concatenate([self.lengths, lengths]), np.concatenate([self.table, ids])
        runs = own_lengths[at]
        starts = (np.cumsum(own_lengths) - own_lengths)[at]
        has_mark = marked.to_numpy(zero_copy_only=False)
        full = runs + has_mark
        out = np.empty(int(full.sum()), dtype=self.dtype)
        ends = np.cumsum(full) - 1
        inner = np.ones(len(out), dtype=bool)
        inner[ends[has_mark]] = False
        out[inner] = _expand(table, starts, runs)
        comma = pc.ends_with(strings, ",").to_numpy(zero_copy_only=False)
        out[ends[has_mark]] = np.where(comma[has_mark], self.marks[","], self.marks["."])
        if pc.max(pc.utf8_length(new)).as_py() in (None, *range(LONGEST_REMEMBERED + 1)):
            self.known, self.lengths, self.table = known, own_lengths, table
        else:
            short = pc.less_equal(pc.utf8_length(known), LONGEST_REMEMBERED).to_numpy(zero_copy_only=False)
            self.known = known.filter(pa.array(short))
            self.table, self.lengths = table[np.repeat(short, own_lengths)], own_lengths[short]
        return full, out

    @staticmethod
    def _pieces(texts: pa.Array) -> pa.Array:
        """Pieces per text, without the space before all but the first; a line end stays with its piece."""
        loose = pc.match_substring_regex(texts, LOOSE)
        if not pc.any(loose, min_count=0).as_py():
            return pc.split_pattern(pc.replace_substring(texts, "\n", " \n"), " ")
        cut = [
            CUT.split(t) if careful else t.replace("\n", " \n").split(" ")
            for t, careful in zip(texts.to_pylist(), loose.to_pylist())
        ]
        return pa.array(cut, pa.large_list(pa.large_string()))

    def encode(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """Ids of all texts; then tokens and characters of each piece, and pieces of each text (one at least)."""
        cut = self._pieces(pc.fill_null(texts.cast(pa.large_string()), ""))
        pieces = pc.list_value_length(cut).to_numpy(zero_copy_only=False).astype(np.int64)
        flat = cut.flatten()
        spaced = np.ones(len(flat), dtype=bool)
        spaced[np.cumsum(pieces) - pieces] = False
        spaced &= ~pc.starts_with(flat, "\n").to_numpy(zero_copy_only=False)
        codes = np.empty(len(flat), dtype=np.int64)
        lengths, tables, count = [], [], 0
        for where, lead in ((~spaced, ""), (spaced, " ")):
            coded = flat.filter(pa.array(where)).dictionary_encode()
            codes[where] = coded.indices.to_numpy(zero_copy_only=False).astype(np.int64) + count
            strings = coded.dictionary
            count += len(strings)
            own, table = self._look_up(pc.utf8_replace_slice(strings, 0, 0, lead))
            lengths.append(own)
            tables.append(table)
        own = np.concatenate(lengths)
        tokens = own[codes]
        ids = _expand(np.concatenate(tables), (np.cumsum(own) - own)[codes], tokens)
        characters = pc.utf8_length(flat).to_numpy(zero_copy_only=False).astype(np.int64) + spaced
        return ids, tokens, characters, pieces


_encoders: dict[str, PieceEncoder] = {}


def encoder(path: str) -> PieceEncoder:
    """One encoder per Python worker and vocabulary file."""
    if path not in _encoders:
        _encoders[path] = PieceEncoder(path)
    return _encoders[path]


def slices(texts: pa.Array, limit: int = 4_000_000):
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
