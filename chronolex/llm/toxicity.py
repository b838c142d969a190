"""Toxicity scores by a bidirectional gated recurrent network with attention pooling, trained in numpy."""

import re
import zlib

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, functions as F

from chronolex.llm.samples import held_out, labelled_texts

# Bounds on what is learned from; every window of every whole text is scored.
TEXTS_PER_LABEL = 2000
CHARACTERS_PER_TEXT = 8_000
WINDOW = 32
STRIDE = 8
# A longer run of word characters is cut into pieces of this length, which overlap by PIECE - PIECE_STEP.
PIECE = 64
PIECE_STEP = 40
HIDDEN = 8
WORD_ROWS = 1 << 16
GRAM_ROWS = 1 << 14
DIMS = 4
FOLDS = 4
REMEMBERED = 100_000
LANES = 1024
WORD = re.compile(r"\w+")
SEED = 7


def words_of(text: str | None) -> list[str]:
    """Runs of word characters, longer ones as overlapping pieces; nothing is left out."""
    words = WORD.findall((text or "").lower())
    if max(map(len, words), default=0) <= PIECE:
        return words
    return [piece for w in words for piece in pieces_of(w)]


def pieces_of(word: str) -> list[str]:
    return [word[i : i + PIECE] for i in range(0, max(1, len(word) - PIECE + PIECE_STEP), PIECE_STEP)]


def word_rows(words: list[str]) -> np.ndarray:
    return np.array([zlib.crc32(w.encode("utf-8", "replace")) % WORD_ROWS for w in words], dtype=np.int64)


def gram_rows(words: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Rows of the character trigrams of all words, each word's ends marked, and where each word begins."""
    code = np.frombuffer("".join(f"<{w}>" for w in words).encode("utf-32-le", "replace"), dtype="<u4").astype(np.int64)
    grams = (code[:-2] * 961 + code[1:-1] * 31 + code[2:]) * 2654435761 % (1 << 32) * GRAM_ROWS >> 32
    lengths = np.array([len(w) + 2 for w in words], dtype=np.int64)
    begin = np.cumsum(lengths) - lengths
    # The two trigrams that run from one word into the next are left out.
    inside = np.ones(len(code), dtype=bool)
    inside[begin + lengths - 1] = inside[begin + lengths - 2] = False
    return grams[inside[:-2]], begin - 2 * np.arange(len(words))


def _sigmoid(x: np.ndarray) -> np.ndarray:
    with np.errstate(over="ignore"):
        return 1 / (1 + np.exp(-x))


def window_starts(n: int) -> np.ndarray:
    """Starts of overlapping windows that cover n words; the last window ends with the text."""
    if n <= WINDOW:
        return np.zeros(1, dtype=np.int64)
    return np.append(np.arange(0, n - WINDOW, STRIDE), n - WINDOW)


class Seen:
    """Which rows of the word and trigram tables each labelled text holds."""

    def __init__(self, vocabulary: list[str], texts: list[np.ndarray]):
        rows, (grams, begin) = word_rows(vocabulary), gram_rows(vocabulary)
        lengths = np.diff(np.append(begin, len(grams)))
        self.words, self.grams = [], []
        for ids in texts:
            own = np.unique(ids)
            self.words.append(np.unique(rows[own]).astype(np.int32))
            shift = begin[own] - (np.cumsum(lengths[own]) - lengths[own])
            flat = np.repeat(shift, lengths[own]) + np.arange(lengths[own].sum())
            self.grams.append(np.unique(grams[flat]).astype(np.int32))


class Inputs:
    """Word and character inputs: shrunken log odds of words and of character trigrams in labelled texts."""

    def __init__(self, seen: Seen, toxic: np.ndarray, clean: np.ndarray):
        """From the texts whose numbers are given."""
        self.words, self.support = self._odds(seen.words, toxic, clean, WORD_ROWS)
        self.grams, _ = self._odds(seen.grams, toxic, clean, GRAM_ROWS)

    @staticmethod
    def _odds(rows: list, toxic: np.ndarray, clean: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray]:
        a, b = (np.bincount(np.concatenate([np.empty(0, np.int32), *(rows[k] for k in own)]).astype(np.int64), minlength=size) for own in (toxic, clean))
        odds = np.log((a + 1) / (len(toxic) + 2)) - np.log((b + 1) / (len(clean) + 2))
        return (np.clip(odds, -2, 6) * (a + b) / (a + b + 4) / 2).astype(np.float32), np.log1p(a + b).astype(np.float32) / 4

    def of(self, words: list[str]) -> np.ndarray:
        """(word, DIMS): odds and support of the word, mean and maximum over its trigrams."""
        if not words:
            return np.zeros((0, DIMS), np.float32)
        rows, (grams, begin) = word_rows(words), gram_rows(words)
        odds = self.grams[grams]
        mean = np.add.reduceat(odds, begin) / np.diff(np.append(begin, len(grams)))
        return np.stack([self.words[rows], self.support[rows], mean, np.maximum.reduceat(odds, begin)], axis=1).astype(np.float32)


class Network:
    """Word and character inputs -> a GRU in each direction -> attention over words -> a logit per window."""

    def __init__(self, seed: int = SEED):
        rng = np.random.default_rng(seed)
        h = HIDDEN
        self.p = {"att": rng.normal(0, 0.3, 2 * h), "out": rng.normal(0, 0.3, 2 * h), "bias": np.zeros(1)}
        for side in "fb":
            self.p[f"W{side}"] = rng.normal(0, DIMS**-0.5, (DIMS, 3 * h))
            self.p[f"U{side}"] = rng.normal(0, h**-0.5, (h, 3 * h))
            self.p[f"c{side}"] = np.zeros(3 * h)
        self.p = {k: v.astype(np.float32) for k, v in self.p.items()}
        self.inputs: Inputs | None = None
        self.scale = np.zeros(3, dtype=np.float32)  # of the highest logit, of log windows, offset

    def project(self, x: np.ndarray, side: str) -> np.ndarray:
        return x @ self.p[f"W{side}"] + self.p[f"c{side}"]

    def _run(self, steps, count: int, lanes: int, side: str, keep: list | None = None) -> np.ndarray:
        """States (T, H, B) of one direction; steps(t) gives the projected inputs (3H, B) of a step."""
        h, u = HIDDEN, np.ascontiguousarray(self.p[f"U{side}"].T)
        state = np.zeros((h, lanes), dtype=np.float32)
        states = np.empty((count, h, lanes), dtype=np.float32)
        for t in range(count) if side == "f" else range(count - 1, -1, -1):
            x, g = steps(t), u @ state
            zr = _sigmoid(x[: 2 * h] + g[: 2 * h])
            z, r = zr[:h], zr[h:]
            n = np.tanh(x[2 * h :] + r * g[2 * h :])
            if keep is not None:
                keep.append((t, state, z, r, n, g[2 * h :]))
            state = n + z * (state - n)
            states[t] = state
        return states

    def _attend(self, states: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        h = HIDDEN
        score = sum(np.tensordot(s, self.p["att"][k * h : (k + 1) * h], (1, 0)) for k, s in enumerate(states))
        weight = np.exp(score - score.max(axis=0))
        weight /= weight.sum(axis=0)
        pooled = np.concatenate([(s * weight[:, None, :]).sum(axis=0) for s in states])
        return self.p["out"] @ pooled + self.p["bias"][0], weight, pooled

    def logits(self, projected: dict[str, np.ndarray], windows: np.ndarray) -> np.ndarray:
        """Logits of windows (B, T) of rows into the projected inputs."""
        found = []
        for i in range(0, len(windows), LANES):
            at = np.ascontiguousarray(windows[i : i + LANES].T)
            states = [self._run(lambda t, s=side: projected[s][at[t]].T, len(at), at.shape[1], side) for side in "fb"]
            found.append(self._attend(states)[0])
        return np.concatenate(found)

    def step(self, x: np.ndarray, y: np.ndarray) -> tuple[float, dict[str, np.ndarray]]:
        """Loss and gradients for inputs x (T, B, DIMS)."""
        h, grads, kept, states = HIDDEN, {}, {"f": [], "b": []}, []
        for side in "fb":
            projected = self.project(x, side)
            states.append(self._run(lambda t: projected[t].T, len(x), x.shape[1], side, kept[side]))
        logit, weight, pooled = self._attend(states)
        p = _sigmoid(logit)
        d = ((p - y) / len(y)).astype(np.float32)
        grads["out"], grads["bias"], grads["att"] = pooled @ d, np.array([d.sum()]), np.zeros(2 * h)
        halves = [slice(0, h), slice(h, 2 * h)]
        d_pooled = self.p["out"][:, None] * d
        inner = sum(np.einsum("thb,hb->tb", s, d_pooled[half]) for s, half in zip(states, halves))
        d_score = weight * (inner - (weight * inner).sum(axis=0))
        for side, own, half in zip("fb", states, halves):
            u, carry = self.p[f"U{side}"], 0
            grads["att"][half] = np.einsum("tb,thb->h", d_score, own)
            d_own = weight[:, None, :] * d_pooled[half] + d_score[:, None, :] * self.p["att"][half][:, None]
            du, dw, dc = np.zeros_like(u), np.zeros_like(self.p[f"W{side}"]), np.zeros(3 * h, np.float32)
            for t, before, z, r, n, g in reversed(kept[side]):
                ds = d_own[t] + carry
                dn = ds * (1 - z) * (1 - n * n)
                dz = ds * (before - n) * z * (1 - z)
                dr = dn * g * r * (1 - r)
                dg = np.concatenate([dz, dr, dn * r])
                du += before @ dg.T
                carry = ds * z + u @ dg
                dx = np.concatenate([dz, dr, dn])
                dw += x[t].T @ dx.T
                dc += dx.sum(axis=1)
            grads[f"U{side}"], grads[f"W{side}"], grads[f"c{side}"] = du, dw, dc
        return float(-np.mean(y * np.log(p + 1e-7) + (1 - y) * np.log(1 - p + 1e-7))), grads


class Scorer:
    """Scores whole texts; projected inputs of words are remembered up to a bound."""

    def __init__(self, network: Network):
        self.network = network
        self._forget()

    def _forget(self) -> None:
        # Row 0 is the blank that fills up short texts.
        self.rows: dict[str, int] = {}
        blank = np.zeros((1, DIMS), dtype=np.float32)
        self.projected = {side: self.network.project(blank, side) for side in "fb"}

    def _learn(self, words: set[str]) -> None:
        new = [w for w in words if w not in self.rows]
        if new:
            start, x = len(self.projected["f"]), self.network.inputs.of(new)
            for side, known in self.projected.items():
                self.projected[side] = np.concatenate([known, self.network.project(x, side)])
            self.rows.update(zip(new, range(start, start + len(new))))

    def windows(self, texts: list[str | None]) -> tuple[np.ndarray, np.ndarray]:
        """Logits of all windows, and windows per text."""
        if len(self.rows) > REMEMBERED:
            self._forget()
        words = [words_of(t) for t in texts]
        self._learn(set().union(*words))
        counts, tables = [], []
        for own in words:
            ids = np.fromiter(map(self.rows.__getitem__, own), dtype=np.int64, count=len(own))
            starts = window_starts(len(ids))
            if len(ids) < WINDOW:
                ids = np.pad(ids, (0, WINDOW - len(ids)))
            tables.append(ids[starts[:, None] + np.arange(WINDOW)])
            counts.append(len(starts))
        return self.network.logits(self.projected, np.concatenate(tables)), np.array(counts)

    def document_inputs(self, texts: list[str | None]) -> np.ndarray:
        """Per text: its highest window logit, and the logarithm of its number of windows."""
        logits, counts = self.windows(texts)
        highest = np.maximum.reduceat(logits, np.cumsum(counts) - counts)
        return np.stack([highest, np.log(counts)], axis=1)

    def scores(self, texts: list[str | None]) -> np.ndarray:
        a, b, c = self.network.scale.astype(np.float64)
        x = self.document_inputs(texts).astype(np.float64)
        return 1 / (1 + np.exp(-np.clip(a * x[:, 0] + b * x[:, 1] + c, -30, 30)))


def _fit_scale(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """Logistic regression on the document inputs by Newton steps, lightly held back."""
    design = np.column_stack([x, np.ones(len(x))])
    center = design[:, :2].mean(axis=0)
    spread = design[:, :2].std(axis=0) + 1e-6
    design[:, :2] = (design[:, :2] - center) / spread
    w = np.zeros(3)
    for _ in range(30):
        p = 1 / (1 + np.exp(-np.clip(design @ w, -30, 30)))
        hessian = (design * (p * (1 - p))[:, None]).T @ design + np.diag([1e-2, 1e-2, 1e-4])
        w -= np.linalg.solve(hessian, design.T @ (p - y) + np.array([1e-2, 1e-2, 1e-4]) * w)
    slopes = w[:2] / spread
    return np.array([*slopes, w[2] - slopes @ center], dtype=np.float32)


def _adam(network: Network, memory: dict, grads: dict, rate: float) -> None:
    memory["steps"] = memory.get("steps", 0) + 1
    for key, grad in grads.items():
        m, v = memory.get(key, (0, 0))
        m, v = 0.9 * m + 0.1 * grad, 0.99 * v + 0.01 * grad * grad
        memory[key] = (m, v)
        ahead = m / (1 - 0.9 ** memory["steps"]) / (np.sqrt(v / (1 - 0.99 ** memory["steps"])) + 1e-6)
        network.p[key] -= (rate * ahead).astype(np.float32)


def train(rows: list, steps: int = 300, batch: int = 128, rate: float = 0.01, seed: int = SEED) -> Network:
    """Train on (id, label, text) rows.

    Only documents have labels, so in each epoch a toxic document teaches its highest window; a clean
    one teaches its highest window and a random one. There are `steps` batches at least, in whole
    epochs, four at least. Inputs of a training text come from the other folds' texts, so the network
    and the scale meet them as they will be for new texts. With one label only, every score is equal.
    """
    rng = np.random.default_rng(seed)
    network = Network(seed)
    labels = np.array([1.0 if row[1] else 0.0 for row in rows])
    index: dict[str, int] = {}
    texts = [np.array([index.setdefault(w, len(index)) for w in words_of(row[2])], dtype=np.int32) for row in rows]
    vocabulary = list(index)
    seen = Seen(vocabulary, texts)
    folds = np.empty(len(rows), dtype=np.int64)
    for label in (0, 1):
        own = np.flatnonzero(labels == label)
        folds[own] = rng.permutation(len(own)) % FOLDS

    def inputs(chosen: np.ndarray) -> Inputs:
        return Inputs(seen, *(np.flatnonzero(chosen & (labels == y)) for y in (1, 0)))

    network.inputs = inputs(np.ones(len(rows), dtype=bool))
    if not len(rows) or labels.min() == labels.max():
        network.scale[2] = 4 if len(rows) and labels[0] else -4
        return network
    # Rows of x: a blank, then the vocabulary once per fold, with inputs from the other folds.
    x = np.concatenate([np.zeros((1, DIMS), np.float32), *(inputs(folds != fold).of(vocabulary) for fold in range(FOLDS))])
    tables = []
    for own, fold in zip(texts, folds):
        ids = own + np.int32(1 + fold * len(vocabulary))
        ids = np.pad(ids, (0, max(0, WINDOW - len(ids))))
        tables.append(ids[window_starts(len(own))[:, None] + np.arange(WINDOW)])
    counts = np.array([len(t) for t in tables])
    table, owner = np.concatenate(tables), np.repeat(np.arange(len(rows)), counts)
    first, clean = np.cumsum(counts) - counts, np.flatnonzero(labels == 0)
    memory: dict = {}
    per_epoch = -(-(len(rows) + len(clean)) // batch)
    # Before anything is learned, the log odds of its words tell a window's rank.
    logits = np.sort(x[table, 0], axis=1)[:, -2:].sum(axis=1)
    for _ in range(max(4, -(-steps // per_epoch))):
        highest = np.lexsort((logits, owner))[first + counts - 1]
        random = first + (rng.random(len(rows)) * counts).astype(np.int64)
        chosen = np.concatenate([highest, random[clean]])
        answers = np.concatenate([labels, np.zeros(len(clean))])
        order = rng.permutation(len(chosen))
        for start in range(0, len(order), batch):
            part = order[start : start + batch]
            _, grads = network.step(x[table[chosen[part]].T], answers[part].astype(np.float32))
            _adam(network, memory, grads, rate)
        logits = network.logits({side: network.project(x, side) for side in "fb"}, table)
    highest = np.maximum.reduceat(logits, first)
    network.scale = _fit_scale(np.stack([highest, np.log(counts)], axis=1).astype(np.float64), labels)
    return network


def learn(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> Network:
    """Train on a bounded sample of labelled rows that are not held out. Runs actions."""
    rows = labelled_texts(docs, labels, id_col, text_col, "toxic", TEXTS_PER_LABEL, CHARACTERS_PER_TEXT)
    return train(rows)


def _batches(texts: list, characters: int = 1_000_000):
    start, size = 0, 0
    for stop, text in enumerate(texts):
        if size and size + len(text or "") > characters:
            yield texts[start:stop]
            start, size = stop, 0
        size += len(text or "")
    if start < len(texts):
        yield texts[start:]


def score_column(docs: DataFrame, text: Column, network: Network) -> Column:
    """Toxicity of each whole text, 0 to 1: the highest of its overlapping windows, scaled."""
    shared = docs.sparkSession.sparkContext.broadcast(network)

    @F.pandas_udf("double")
    def score(texts: pd.Series) -> pd.Series:
        scorer = _scorer(shared)
        return pd.Series(np.concatenate([np.empty(0), *(scorer.scores(part) for part in _batches(texts.tolist()))]))

    return score(text)


_scorers: dict = {}


def _scorer(shared) -> Scorer:
    """One scorer per Python worker and model."""
    if shared.value not in _scorers:
        _scorers.clear()
        _scorers[shared.value] = Scorer(shared.value)
    return _scorers[shared.value]


def toxicity(
    docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", network: Network | None = None
) -> DataFrame:
    """One row per input row: id, held_out, score, predicted.

    Every window of `WINDOW` words, a new one each `STRIDE` words, of the whole text is scored, so a
    phrase of up to WINDOW - STRIDE + 1 words lies whole in one; a run of more than PIECE word characters
    counts as several words, its overlapping pieces. The
    document's score is its highest window's, scaled by a logistic fit that knows the number of
    windows. NULL and empty texts are one blank window. Without labels, or with one label only, all
    scores are equal. Rows may repeat an id; NULL ids are never held out. Labels are learned only from
    ids that are not held out. Other columns are not looked at. Runs actions.
    """
    network = network or learn(docs, labels, id_col, text_col)
    marked = docs.select(
        F.col(id_col).alias(id_col),
        held_out(id_col).alias("held_out"),
        score_column(docs, F.col(text_col), network).alias("score"),
    )
    return marked.withColumn("predicted", (F.col("score") >= 0.5).cast("int"))


def keep_clean(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The documents that are not predicted to be toxic, with all their columns.

    NULL and empty texts, repeated ids and tables without labels are treated as in `toxicity`; each row is
    judged by its own text. An empty table stays empty. Runs actions.
    """
    network = learn(docs, labels, id_col, text_col)
    return docs.filter(score_column(docs, F.col(text_col), network) < 0.5)
