"""Language identification by cross-parsing entropy against suffix automata."""

import itertools
import math
from collections import Counter

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, functions as F

from chronolex.llm.samples import held_out, labelled_texts

UNDETERMINED = "und"
# Bounds on what is learned from; whole texts are predicted.
TEXTS_PER_LANGUAGE = 60
CHARACTERS_PER_TEXT = 600
# Symbols with a column in the tables; the others' transitions are looked up among sorted keys.
SYMBOLS = 64
# Largest entry of a table of 32 bits; with more states the tables have 64.
LARGEST = (1 << 31) - 1
# A text is parsed in blocks of so many characters side by side.
BLOCK = 256
SHARPNESS = 12.0


def _automaton(sequence: list[int]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Suffix automaton as a table: state x symbol -> state, -1 where no substring goes on.

    Symbols from SYMBOLS on are not in the table, but in sorted keys, state and symbol in 32 bits each,
    and the states they lead to.
    """
    following, link, length = [{}], [-1], [0]
    last = 0
    for symbol in sequence:
        new = len(following)
        following.append({})
        length.append(length[last] + 1)
        link.append(0)
        state = last
        while state >= 0 and symbol not in following[state]:
            following[state][symbol] = new
            state = link[state]
        if state >= 0:
            other = following[state][symbol]
            if length[other] == length[state] + 1:
                link[new] = other
            else:
                clone = len(following)
                following.append(dict(following[other]))
                length.append(length[state] + 1)
                link.append(link[other])
                link[other] = link[new] = clone
                while state >= 0 and following[state].get(symbol) == other:
                    following[state][symbol] = clone
                    state = link[state]
        last = new
    table = np.full((len(following), SYMBOLS), -1, dtype=np.int32)
    rare = []
    for state, row in enumerate(following):
        for symbol, to in row.items():
            if symbol < SYMBOLS:
                table[state, symbol] = to
            else:
                rare.append((state << 32 | symbol, to))
    keys, states = np.array(sorted(rare), dtype=np.int64).reshape(-1, 2).T
    return table, np.ascontiguousarray(keys), np.ascontiguousarray(states)


class Model:
    """An automaton per language, and the symbols they share.

    Every character of the learned texts is a symbol, the most frequent ones first. Symbol 0 stands for
    all others; it is in no automaton, so it is a phrase of its own.
    """

    def __init__(self, texts: dict[str, list[str]]):
        self.languages = sorted(texts)
        counts = Counter(itertools.chain.from_iterable(t.lower() for own in texts.values() for t in own))
        self.symbols = np.zeros(0x110000, dtype=np.int32)
        for symbol, (character, _) in enumerate(sorted(counts.items(), key=lambda item: (-item[1], item[0])), 1):
            self.symbols[ord(character)] = symbol
        # One table for all: state * SYMBOLS + symbol -> next state * SYMBOLS, times 4, plus phrases ended:
        # the one under way, and the symbol itself if the language has never seen it.
        automata, self.starts, self.sizes, offset = [], [], [], 0
        # Per language, the sorted keys of the symbols that have no column, and their states.
        self.rare: list[tuple[np.ndarray, np.ndarray]] = []
        for language in self.languages:
            sequence = [s for t in texts[language] for s in self.encode(t).tolist() if s]
            table, keys, states = _automaton(sequence)
            automata.append(table)
            self.rare.append((keys, states))
            self.starts.append(offset)
            self.sizes.append(max(2, len(sequence)))
            offset += len(table)
        kind = np.int32 if (offset + 1) * SYMBOLS * 4 <= LARGEST else np.int64
        self.table = np.empty((offset, SYMBOLS), dtype=kind)
        for start, table in zip(self.starts, automata):
            root = np.maximum(table[0], 0)
            ends = table < 0
            following = np.where(ends, root[None, :], table).astype(kind)
            phrases = np.where(ends, (np.arange(len(table)) > 0)[:, None] + (table[0] < 0)[None, :].astype(np.int32), 0)
            self.table[start : start + len(table)] = (following + start) * SYMBOLS * 4 + phrases
        self.table = self.table.ravel()

    def _rare_step(self, language: int, state: np.ndarray, symbol: np.ndarray) -> np.ndarray:
        """Entries as in the table, for symbols that have no column in it."""
        (keys, states), start = self.rare[language], self.starts[language]
        if not len(keys):
            found, to = np.zeros(len(state), dtype=bool), np.zeros(len(state), dtype=np.int64)
            first, root = found, to
        else:
            from_state = state.astype(np.int64) // SYMBOLS - start
            (found, to), (first, root) = (
                (keys[at] == key, states[at])
                for key in (from_state << 32 | symbol, symbol.astype(np.int64))
                for at in [np.minimum(np.searchsorted(keys, key), len(keys) - 1)]
            )
        ended = (state != start * SYMBOLS).astype(np.int64) + ~first
        following = np.where(found, to, np.where(first, root, 0))
        return (following + start) * SYMBOLS * 4 + np.where(found, 0, ended)

    def encode(self, text: str) -> np.ndarray:
        return self.symbols[np.frombuffer(text.lower().encode("utf-32-le", "replace"), dtype="<u4")]

    def phrases(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Phrases per text and language, and characters per text.

        The longest match with the learned text ends a phrase, and the next one starts there. A text is
        cut into blocks, parsed side by side, one step per character for all blocks and languages.
        """
        codes = [self.encode(t) for t in texts]
        sizes = np.array([len(c) for c in codes], dtype=np.int64)
        blocks = -(-sizes // BLOCK)
        owner = np.repeat(np.arange(len(texts)), blocks)
        padded = np.zeros(int(blocks.sum()) * BLOCK, dtype=np.int32)
        begin = (np.cumsum(blocks) - blocks) * BLOCK
        for at, code in zip(begin, codes):
            padded[at : at + len(code)] = code
        grid = padded.reshape(-1, BLOCK)
        within = np.arange(len(owner)) - (np.cumsum(blocks) - blocks)[owner]
        filled = np.minimum(sizes[owner] - within * BLOCK, BLOCK)
        # Fullest blocks first, so that each step works on a prefix.
        order = np.argsort(-filled, kind="stable")
        columns = np.ascontiguousarray(grid[order].T)
        rare = [np.flatnonzero(column >= SYMBOLS) for column in columns]
        rare_symbols = [column[at] for column, at in zip(columns, rare)]
        columns[columns >= SYMBOLS] = 0
        active = np.searchsorted(-filled[order], -np.arange(BLOCK), side="left")
        total = np.zeros((len(texts), len(self.languages)))
        for k, start in enumerate(self.starts):
            state = np.full(len(owner), start * SYMBOLS, dtype=self.table.dtype)
            ended = np.zeros(len(owner), dtype=np.int32)
            for step in range(BLOCK):
                n = active[step]
                if not n:
                    break
                to = self.table.take(state[:n] + columns[step, :n])
                if len(rare[step]):
                    to[rare[step]] = self._rare_step(k, state[rare[step]], rare_symbols[step])
                ended[:n] += to & 3
                state[:n] = to >> 2
            # The phrase under way at a block's end counts as well.
            total[:, k] = np.bincount(owner[order], weights=ended + (state != start * SYMBOLS), minlength=len(texts))
        return total, sizes

    def predict(self, texts: list[str | None]) -> tuple[list[str], np.ndarray]:
        phrases, sizes = self.phrases([t or "" for t in texts])
        if not self.languages:
            return [UNDETERMINED] * len(texts), np.zeros(len(texts))
        # Normalised: bits to name a place in the learned text, per phrase, per character.
        entropy = phrases * np.log2(self.sizes)[None, :] / np.maximum(sizes, 1)[:, None]
        weight = np.exp(-SHARPNESS * (entropy - entropy.min(axis=1, keepdims=True)) / math.log2(SYMBOLS))
        share = weight.max(axis=1) / weight.sum(axis=1)
        letters = np.array([t is not None and any(map(str.isalpha, t)) for t in texts], dtype=bool)
        best = [self.languages[k] if ok else UNDETERMINED for k, ok in zip(entropy.argmin(axis=1), letters)]
        return best, np.where(letters, share, 0.0)


def learn(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang") -> Model:
    """Automata from a bounded sample of each language's training rows. Runs actions."""
    rows = labelled_texts(docs, docs, id_col, text_col, lang_col, TEXTS_PER_LANGUAGE, CHARACTERS_PER_TEXT)
    texts: dict[str, list[str]] = {}
    for _, language, text in rows:
        texts.setdefault(language, []).append(text)
    return Model(texts)


def _batches(texts: pd.Series, characters: int = 4_000_000):
    start, size = 0, 0
    values = texts.tolist()
    for stop, text in enumerate(values):
        if size and size + len(text or "") > characters:
            yield values[start:stop]
            start, size = stop, 0
        size += len(text or "")
    if start < len(values):
        yield values[start:]


def identify(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang", model: Model | None = None
) -> DataFrame:
    """One row per input row: id, held_out, lang_pred, score.

    Each whole text is cross-parsed against one suffix automaton per language; the language that
    needs the fewest phrases, normalised by the bits that a phrase costs and the text's length, wins;
    ties go to the first language by name. The score is the winner's share after a softmax. NULL texts
    and texts without a letter are `und` with score 0, as is everything if there is nothing to learn
    from. Rows may repeat an id; NULL ids are never held out and never learned from. Learning takes a
    bounded sample of rows with a language and an id that is not held out. Runs actions.
    """
    spark = docs.sparkSession
    shared = spark.sparkContext.broadcast(model or learn(docs, id_col, text_col, lang_col))

    @F.pandas_udf("lang_pred string, score double")
    def predict(texts: pd.Series) -> pd.DataFrame:
        languages, scores = [], [np.empty(0)]
        for part in _batches(texts):
            found, score = shared.value.predict(part)
            languages += found
            scores.append(score)
        return pd.DataFrame({"lang_pred": pd.Series(languages, dtype=object), "score": np.concatenate(scores)})

    marked = docs.select(F.col(id_col).alias(id_col), held_out(id_col).alias("held_out"), predict(F.col(text_col)).alias("_p"))
    return marked.select(id_col, "held_out", "_p.lang_pred", "_p.score")
