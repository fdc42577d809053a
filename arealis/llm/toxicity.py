"""Toxicity: a factorization machine over hashed terms.

Terms of a document are its distinct words and word beginnings, as 32-bit
hashes. The machine's inputs are terms that are clearly more frequent in toxic
rows, terms that are so in the toxic rows that these leave unexplained (again,
until none is found), terms that separate the classes among the rows of another
term, and terms that are clearly more frequent in clean rows. The machine
learns a weight for each and a vector whose products weigh pairs of terms, so
that two terms that are harmless alone can count together. (With all terms as
inputs the machine learns its sample by heart: the README has figures.)

The machine is fitted on at most ``sample_rows`` labelled rows and
``SAMPLE_BYTES`` of their terms, the first by a hash of their id, in one task;
the driver gets the machine. Rows with equal terms count once, toxic if half of them are.
Scoring reads every whole text.

Defined results: a null or empty text has no terms and gets the machine's
constant, as does a text without a known term; with no labelled row, or one
class only, every score is the share of label 1 (0.0 without rows); repeated
rows get equal scores; a null id is never a training row, nor is an id with
both labels. Only id and text are read from the documents.
"""

from __future__ import annotations

import re
import zlib
from collections.abc import Iterable
from dataclasses import dataclass, field

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from arealis.llm.common import is_fold
from arealis.llm.quality_model import filtered, fit_in_task, labelled, with_scores

#: Bounds of the fit, and factors of the machine.
SAMPLE_ROWS, SAMPLE_BYTES, FACTORS = 8000, 1 << 28, 8
#: Least rows of a term; least standard scores of a term among all rows (or those of another term), and among rows that no chosen term explains.
LEAST, ALONE, LEFT_OPEN = 3, 5.0, 4.5
#: Shortest and longest word beginning that is a term.
PREFIXES = (3, 10)
CACHE_WORDS = 300_000
#: Rows of the sample that are looked at together.
STEP_ROWS = 256

_WORD = re.compile(r"[^\W\d_]+")


def word_terms(word: str) -> list[int]:
    """Hashes of a lower-case word and its beginnings."""
    raw = lambda s: zlib.crc32(s.encode("utf-8", "surrogatepass"))
    return [raw(word + "$"), *(raw(word[:k]) for k in range(PREFIXES[0], min(PREFIXES[1], len(word)) + 1))]


def distinct_words(text: str | None) -> set[str]:
    """Space-separated lower-case parts; their letters are looked at once per distinct part."""
    return set((text or "").lower().split())


@dataclass
class FactorizationMachine:
    """Logit of a set of terms: constant, weights, and half the squared length of summed vectors less their own."""

    terms: dict[int, int]
    constant: float
    weights: np.ndarray
    vectors: np.ndarray
    prior: float | None = None

    def logit(self, active: list[int]) -> float:
        if not active:
            return self.constant
        v = self.vectors[active]
        summed = v.sum(axis=0)
        return self.constant + float(self.weights[active].sum() + 0.5 * (summed @ summed - (v * v).sum()))

    def scores(self, texts: list[str | None], cache: "TermCache") -> np.ndarray:
        if self.prior is not None:
            return np.full(len(texts), self.prior)
        logits = [self.logit(cache.active(t, self.terms)) for t in texts]
        return 1 / (1 + np.exp(-np.clip(np.array(logits, dtype=np.float64), -30, 30)))


@dataclass
class TermCache:
    """Known terms of words, for the words that a worker has met."""

    vectors: np.ndarray
    known: dict[str, tuple[int, ...]] = field(default_factory=dict)

    def active(self, text: str | None, terms: dict[int, int]) -> list[int]:
        known = self.known
        found: set[int] = set()
        for part in distinct_words(text):
            ids = known.get(part)
            if ids is None:
                if len(known) > CACHE_WORDS:
                    known.clear()
                ids = known[part] = tuple({terms[t] for w in _WORD.findall(part) for t in word_terms(w) if t in terms})
            if ids:
                found.update(ids)
        return sorted(found)


def text_terms(text: str) -> np.ndarray:
    """The distinct terms of a text, as a compact array: a set of Python numbers would be twenty times as large."""
    words = {w for part in distinct_words(text) for w in _WORD.findall(part)}
    return np.unique(np.fromiter((t for w in words for t in word_terms(w)), dtype=np.uint32))


def _counts(rows: list[np.ndarray], chosen: np.ndarray, size: int) -> np.ndarray:
    """How many of the chosen rows have each term."""
    out, at = np.zeros(size, dtype=np.int64), np.flatnonzero(chosen)
    for k in range(0, len(at), STEP_ROWS):
        out += np.bincount(np.concatenate([rows[i] for i in at[k : k + STEP_ROWS]]), minlength=size)
    return out


def numbered(rows: list[np.ndarray]) -> np.ndarray:
    """The distinct terms of the rows, which are replaced by the terms' places among them, as the driver has little room."""
    known = np.concatenate(rows)
    known.sort()
    known = known[np.r_[True, known[1:] != known[:-1]][: len(known)]]
    for k, r in enumerate(rows):
        rows[k] = np.searchsorted(known, r).astype(np.int32)
    return known


def choose_terms(rows: list[np.ndarray], y: np.ndarray, size: int) -> np.ndarray:
    """Inputs of the machine, of terms numbered below ``size``: those that separate the classes alone, in rows that others leave open, or in a pair."""
    chosen = spoken = np.zeros(0, dtype=np.int64)
    taken, decides = np.zeros(size, dtype=bool), np.zeros(size, dtype=bool)
    explained = np.zeros(len(rows), dtype=bool)
    clean = _counts(rows, y == 0, size)
    bound = ALONE
    while (n1 := int((open_rows := (y == 1) & ~explained).sum())) >= LEAST and len(y) - y.sum() > 0:
        n0, toxic = int((y == 0).sum()), _counts(rows, open_rows, size)
        term = np.flatnonzero((toxic + clean >= LEAST) & ~taken)
        z = _separation(toxic[term], n1, clean[term], n0)
        strong = np.flatnonzero((z > bound) & (toxic[term] >= LEAST) & (toxic[term] * n0 > 2 * clean[term] * n1))
        found = term[strong[np.argsort(-z[strong], kind="stable")]]
        if not len(chosen):
            weak = np.flatnonzero((z < -ALONE) & (clean[term] * n1 > 2 * toxic[term] * n0))
            spoken = term[weak[np.argsort(z[weak], kind="stable")]]
        if not len(found):
            break
        chosen = np.concatenate([chosen, found])
        taken[found] = True
        decides[found[toxic[found] > clean[found]]] = True
        # Toxic rows with a chosen term are explained in the next round; others, and all clean rows, stay.
        explained |= (y == 1) & np.array([taken[r].any() for r in rows], dtype=bool)
        bound = LEFT_OPEN
    # Pairs are looked for in all rows but the toxic ones with a term that is mostly in such rows.
    left = ~((y == 1) & np.array([decides[r].any() for r in rows], dtype=bool))
    out = np.concatenate([chosen, _paired_terms(rows, y, left, decides, size), spoken])
    return out[np.sort(np.unique(out, return_index=True)[1])]


def _separation(a: np.ndarray, n1: np.ndarray, b: np.ndarray, n0: np.ndarray) -> np.ndarray:
    """Standard score of the difference of two shares, a of n1 and b of n0."""
    share = (a + b) / np.maximum(n0 + n1, 1)
    spread = np.sqrt(np.maximum(share * (1 - share) * (1 / np.maximum(n0, 1) + 1 / np.maximum(n1, 1)), 1e-12))
    return (a / np.maximum(n1, 1) - b / np.maximum(n0, 1)) / spread


def _paired_terms(rows: list[np.ndarray], y: np.ndarray, left: np.ndarray, decides: np.ndarray, size: int, tile: int = 1024) -> np.ndarray:
    """Terms that separate the classes among the left rows of another term, and the other so too."""
    use = np.flatnonzero(left)
    use = use[np.argsort(-y[use], kind="stable")]  # toxic rows first, so that both classes are slices
    n_toxic = int(y[use].sum())
    toxic = _counts(rows, left & (y == 1), size)
    total = toxic + _counts(rows, left & (y == 0), size)
    sign = np.zeros(size, dtype=np.uint64)
    for k, mark in zip(use, np.random.Generator(np.random.PCG64(13)).integers(1, 1 << 63, len(use), dtype=np.uint64)):
        sign[rows[k]] += mark
    term = np.flatnonzero((toxic >= LEAST) & (total < len(use)) & ~decides)
    term = term[np.sort(np.unique(sign[term], return_index=True)[1])]  # beginnings of a word mostly have the same rows
    if len(term) < 2:
        return term[:0]
    place = np.full(size, -1, dtype=np.int32)
    place[term] = np.arange(len(term))
    held = [np.sort(place[rows[k]][place[rows[k]] >= 0]) for k in use]

    def present(low: int) -> np.ndarray:
        x = np.zeros((len(held), tile), dtype=np.float32)
        for row, h in zip(x, held):
            row[h[np.searchsorted(h, low) : np.searchsorted(h, low + tile)] - low] = 1
        return x

    n = [np.zeros(-(-len(term) // tile) * tile) for _ in range(2)]
    for label in range(2):
        n[label][: len(term)] = (toxic if label else total - toxic)[term]
    best = np.zeros(len(n[0]))
    for i in range(0, len(term), tile):
        a = present(i)
        for j in range(i, len(term), tile):
            b = a if i == j else present(j)
            both1, both0 = (a[part].T @ b[part] for part in (slice(0, n_toxic), slice(n_toxic, None)))
            here = _separation(both1, n[1][i : i + tile, None], both0, n[0][i : i + tile, None])
            there = _separation(both1, n[1][None, j : j + tile], both0, n[0][None, j : j + tile])
            weak = np.where(both1 >= LEAST, np.minimum(here, there), 0)
            if i == j:
                np.fill_diagonal(weak, 0)
            best[i : i + tile] = np.maximum(best[i : i + tile], weak.max(axis=1))
            best[j : j + tile] = np.maximum(best[j : j + tile], weak.max(axis=0))
    strong = np.flatnonzero(best[: len(term)] > ALONE)
    return term[strong[np.argsort(-best[strong], kind="stable")]]


def fit_toxicity(sample: Iterable[tuple[np.ndarray, int]], epochs: int = 30, batch: int = 64, rate: float = 0.02, decay: float = 1e-4) -> FactorizationMachine:
    """Adam on the cross-entropy of the machine's logit, from rows of terms and their labels."""
    labels: dict[bytes, list[int]] = {}
    for terms, label in sample:
        labels.setdefault(terms.tobytes(), []).append(label)
    y = np.array([float(2 * sum(k) >= len(k)) for k in labels.values()], dtype=np.float32)
    if not len(y) or y.min() == y.max():
        return FactorizationMachine({}, 0.0, np.zeros(0), np.zeros((0, FACTORS)), float(y.mean()) if len(y) else 0.0)
    rows = [np.frombuffer(k, np.uint32) for k in labels]
    del labels, sample
    known = numbered(rows)
    chosen = choose_terms(rows, y, len(known))
    terms = {int(known[t]): i for i, t in enumerate(chosen)}
    place = np.full(len(known), -1, dtype=np.int32)
    place[chosen] = np.arange(len(chosen))
    active = [np.sort(place[r][place[r] >= 0]) for r in rows]
    del rows
    rng = np.random.Generator(np.random.PCG64(11))
    w, v = np.zeros(len(terms), np.float32), rng.normal(0, 0.01, (len(terms), FACTORS)).astype(np.float32)
    constant = np.array([np.log(y.mean() / (1 - y.mean()))], np.float32)
    parameters = [constant, w, v]
    first, second = [np.zeros_like(p) for p in parameters], [np.zeros_like(p) for p in parameters]
    step = 0
    for _ in range(epochs):
        for batch_rows in np.array_split(rng.permutation(len(y)), max(1, len(y) // batch)):
            x = np.zeros((len(batch_rows), len(terms)), np.float32)
            for i, r in enumerate(batch_rows):
                x[i, active[r]] = 1
            summed = x @ parameters[2]
            logits = parameters[0] + x @ parameters[1] + 0.5 * ((summed * summed).sum(1) - x @ (parameters[2] * parameters[2]).sum(1))
            error = (1 / (1 + np.exp(-np.clip(logits, -30, 30))) - y[batch_rows]) / len(batch_rows)
            slopes = [error.sum(keepdims=True), x.T @ error + decay * parameters[1], x.T @ (error[:, None] * summed) - (x.T @ error)[:, None] * parameters[2] + decay * parameters[2]]
            step += 1
            for k, g in enumerate(slopes):
                first[k] = 0.9 * first[k] + 0.1 * g
                second[k] = 0.999 * second[k] + 0.001 * g * g
                parameters[k] -= rate * (first[k] / (1 - 0.9**step)) / (np.sqrt(second[k] / (1 - 0.999**step)) + 1e-8)
    return FactorizationMachine(terms, float(parameters[0][0]), parameters[1].astype(np.float64), parameters[2].astype(np.float64))


def _fitted(docs: DataFrame, labels: DataFrame, sample_rows: int, id_column: str, text_column: str) -> FactorizationMachine:
    rows = labelled(docs, labels, "toxic", 5, 0, sample_rows, id_column, text_column)

    def terms(texts: list[str]) -> list[bytes]:
        return [text_terms(t).tobytes() for t in texts]

    def fit(sample: Iterable[tuple[bytes, int]]) -> FactorizationMachine:
        return fit_toxicity((np.frombuffer(x, np.uint32), label) for x, label in sample)

    return fit_in_task(rows, terms, fit, sample_rows, SAMPLE_BYTES)


def toxicity_scores(docs: DataFrame, labels: DataFrame, sample_rows: int = SAMPLE_ROWS, threshold: float = 0.5, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """Score and verdict for each document; labels of the fold crc32(id) mod 5 = 0 are never learned from."""
    model = docs.sparkSession.sparkContext.broadcast(_fitted(docs, labels, sample_rows, id_column, text_column))
    scored = with_scores(docs.select(F.col(id_column).alias("_id"), F.col(text_column).alias("_text")), model, TermCache)
    return scored.select(
        F.col("_id").alias(id_column), is_fold("_id", 5, 0).alias("held_out"), "score", (F.col("score") >= threshold).cast("int").alias("predicted")
    )


def toxicity_filter(docs: DataFrame, labels: DataFrame, sample_rows: int = SAMPLE_ROWS, threshold: float = 0.5, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """All columns of the documents with a score below ``threshold``."""
    model = docs.sparkSession.sparkContext.broadcast(_fitted(docs, labels, sample_rows, id_column, text_column))
    return filtered(docs, model, TermCache, lambda s: s < threshold, text_column)
