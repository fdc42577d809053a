"""Quality classifier: pooled random-indexing vectors and a small network.

Each token has a fixed sparse ternary index vector, made from its hash. A word
vector is the sum of the index vectors around the word's occurrences in all
documents: tasks add up what they read, and the sums of hash buckets, a matrix
of fixed size, are added over tasks. They are whole numbers, so the result does
not depend on the partitions. A document is the mean and the spread of its
words' vectors. A two-layer network turns that into a logit, which a
temperature, fitted on rows kept apart, makes a calibrated probability.

Network and temperature are fitted on at most ``sample_rows`` labelled rows, the
first by a hash of their id, in one task; the driver gets what is fitted. With
fewer than ``LEAST_APART`` rows kept apart the temperature is 1. Vectors and
scores read every whole text.

Defined results: a null or empty text has a zero vector and gets the score of
that; with no labelled row, or one class only, every score is the share of
label 1 (1.0 without rows), so that nothing is rejected unseen; repeated rows
get equal scores; a null id is never a training row, nor is an id with both
labels; documents that share a labelled id are rows of their own. Only id and
text are read from the documents.
"""

from __future__ import annotations

import os
import pickle
import re
import string
import traceback
import zlib
from collections.abc import Callable, Iterable, Iterator
from dataclasses import dataclass
from typing import TypeVar

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from arealis.llm.common import by_bytes, give_back, is_fold, no_collection
from arealis.scratch import scratch, stored

#: Bounds of the fit and the size of the model.
SAMPLE_ROWS, BUCKETS, DIMENSIONS, HIDDEN, WINDOW = 4000, 1 << 14, 64, 32, 2
#: Rows that the temperature needs; tokens in one step of the sums, buckets in one of their rows.
LEAST_APART, STEP_TOKENS, BLOCK = 20, 100_000, 256
#: Two whole numbers in one double: sums over a step, of at most 3 * 3 * (2 * WINDOW + 1) a token, stay below half of this.
PACK = float(1 << 26)

#: Words that a worker keeps the vectors of.
CACHE_WORDS = 300_000

T = TypeVar("T")

_CORE = re.compile(r"[^\W\d_]+")
_ENDS = frozenset(string.digits + string.punctuation)  # of most words that are not letters alone
_SAME, _SHAPES, _MARKS = 0, 1, 64  # buckets below 512 stand for the shape of a word, not for its letters


def word_buckets(word: str) -> tuple[int, int, int]:
    """Hash buckets of a word's letters, its shape, and its other characters."""
    if word.isalpha():
        core, rest = word, ""
    elif word[-1:] in _ENDS and word[:-1].isalpha():
        core, rest = word[:-1], word[-1]
    else:
        core = "".join(_CORE.findall(word))
        rest = _CORE.sub("", word)
    shape = 0 if not core else 1 if core.islower() else 2 if core.isupper() and len(core) > 1 else 3 if core[:1].isupper() else 4
    length = min(len(core), 15) // 2
    letters = 512 + zlib.crc32(core.lower().encode("utf-8", "surrogatepass")) % (BUCKETS - 512)
    mark = _MARKS + zlib.crc32(rest.encode("utf-8", "surrogatepass")) % (512 - _MARKS) if rest else _MARKS - 1
    return letters, _SHAPES + shape * 8 + length, mark


def index_vectors(buckets: int = BUCKETS, dimensions: int = DIMENSIONS, nonzero: int = 6) -> np.ndarray:
    """A sparse ternary vector for each bucket, the same in every process."""
    rng = np.random.Generator(np.random.PCG64(20_240_501))
    out = np.zeros((buckets, dimensions), dtype=np.float32)
    at = rng.random((buckets, dimensions)).argpartition(nonzero, axis=1)[:, :nonzero]
    np.put_along_axis(out, at, rng.choice(np.array([-1, 1], dtype=np.float32), (buckets, nonzero)), axis=1)
    return out


def words_of(text: str) -> list[str]:
    return text.split()


class ContextSums:
    """Sums of the index vectors around the occurrences of each bucket."""

    def __init__(self) -> None:
        self.index = index_vectors()
        self.total = np.zeros(self.index.shape, dtype=np.int64)
        whole = self.index.T.astype(np.float64)
        self.packed = whole[::2] + PACK * whole[1::2]
        self._forget()

    def _forget(self) -> None:
        self.known: dict[str | None, int] = {None: 0}  # None stands between texts
        self.buckets = np.zeros((1 << 14, 3), dtype=np.int32)
        self.around = np.zeros((len(self.packed), 1 << 14))

    def _places(self, words: list[str | None]) -> np.ndarray:
        found = list(map(self.known.get, words))
        if None in found:
            new = list(dict.fromkeys(w for w, i in zip(words, found) if i is None))
            first, last = len(self.known), len(self.known) + len(new)
            while last > len(self.buckets):
                self.around = np.concatenate([self.around, np.zeros_like(self.around)], axis=1)
                self.buckets = np.concatenate([self.buckets, np.zeros_like(self.buckets)])
            self.known.update(zip(new, range(first, last)))
            buckets = self.buckets[first:last] = np.array([word_buckets(w) for w in new], dtype=np.int32)
            for around, packed in zip(self.around, self.packed):
                around[first:last] = packed[buckets].sum(axis=1)
            found = list(map(self.known.__getitem__, words))
        return np.array(found)

    def _add(self, places: np.ndarray, first: int, last: int) -> None:
        """The windows around the places from first to last; the others are only seen."""
        word, own = np.unique(places[first:last], return_inverse=True)
        buckets = self.buckets[word].T.ravel()
        seen = np.pad(places, WINDOW)
        step = np.empty((len(self.packed), BUCKETS))
        for sums, around in zip(step, self.around):
            each = around[seen]
            near = sum(each[first + k : first + k + len(own)] for k in range(2 * WINDOW + 1))
            by_word = np.bincount(own, weights=near, minlength=len(word))
            by_word[word == 0] = 0
            sums[:] = np.bincount(buckets, weights=np.tile(by_word, 3), minlength=BUCKETS)
        high = np.rint(step / PACK)
        self.total[:, ::2] += (step - PACK * high).T.astype(np.int64)
        self.total[:, 1::2] += high.T.astype(np.int64)

    def add(self, texts: list[str]) -> None:
        gap: list[str | None] = [None] * WINDOW
        words = list(gap)
        for text in texts:
            words += words_of(text)
            words += gap
        for k in range(0, len(words), STEP_TOKENS):
            if len(self.known) > CACHE_WORDS:
                self._forget()
            low = max(0, k - WINDOW)
            self._add(self._places(words[low : k + STEP_TOKENS + WINDOW]), k - low, k - low + STEP_TOKENS)

    def vectors(self) -> np.ndarray:
        """Sums of unit length, mixed with each bucket's own index vector, which keeps rare words apart."""
        norm = np.linalg.norm(self.total, axis=1, keepdims=True)
        return (np.where(norm > 0, self.total / np.maximum(norm, 1e-9), 0) * 0.5 + self.index / np.sqrt(6) * 0.5).astype(np.float32)


def corpus_vectors(docs: DataFrame, text_column: str) -> np.ndarray:
    """Vectors of all buckets from all documents."""

    def partial(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums = ContextSums()
        with no_collection():
            for batch in batches:
                for texts in by_bytes(batch.column(0)):
                    sums.add(texts)
        blocks = range(0, BUCKETS, BLOCK)
        kind = np.int32 if np.abs(sums.total).max() < 1 << 31 else np.int64
        yield pa.RecordBatch.from_arrays([pa.array(blocks, pa.int32()), pa.array([sums.total[b : b + BLOCK].astype(kind).tobytes() for b in blocks], pa.binary())], ["block", "sums"])
        del sums
        give_back()

    def added(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found: dict[int, np.ndarray] = {}
        for batch in batches:
            for block, sums in zip(*(c.to_pylist() for c in batch.columns)):
                part = np.frombuffer(sums, np.int32 if len(sums) == BLOCK * DIMENSIONS * 4 else np.int64)
                found[block] = found[block] + part if block in found else part.astype(np.int64)
        yield pa.RecordBatch.from_arrays([pa.array(list(found), pa.int32()), pa.array([x.tobytes() for x in found.values()], pa.binary())], ["block", "sums"])

    schema = "block int, sums binary"
    # Each task sends one matrix, so there should be no more tasks than the cluster can keep busy.
    tasks = 8 * docs.sparkSession.sparkContext.defaultParallelism
    sums = docs.select(text_column).coalesce(tasks).mapInArrow(partial, schema).repartition(BUCKETS // BLOCK, "block").mapInArrow(added, schema)
    out = ContextSums()
    for row in sums.collect():  # the size of the model
        out.total[row["block"] : row["block"] + BLOCK] += np.frombuffer(row["sums"], np.int64).reshape(-1, DIMENSIONS)
    return out.vectors()


class Pooler:
    """Documents as pooled vectors: the mean over words, its spread, and the share of words equal to the one before."""

    def __init__(self, vectors: np.ndarray):
        self.vectors = vectors
        self.rows: dict[str, int] = {}
        self.table = np.zeros((4096, vectors.shape[1]), dtype=np.float32)

    def _ids(self, words: list[str]) -> list[int]:
        found = list(map(self.rows.get, words))
        if None in found:
            missing = list({w for w, i in zip(words, found) if i is None})
            if len(self.rows) + len(missing) > CACHE_WORDS:
                self.rows.clear()
                missing = list(set(words))
            start = len(self.rows)
            if start + len(missing) > len(self.table):
                grown = np.zeros((max(2 * len(self.table), start + len(missing)), self.table.shape[1]), dtype=np.float32)
                grown[:start] = self.table[:start]
                self.table = grown
            buckets = np.array([word_buckets(w) for w in missing])
            self.table[start : start + len(missing)] = self.vectors[buckets].mean(axis=1)
            self.rows.update(zip(missing, range(start, start + len(missing))))
            found = list(map(self.rows.__getitem__, words))
        return found

    def pooled(self, text: str | None) -> np.ndarray:
        words = words_of(text or "")
        size = self.table.shape[1]
        out = np.zeros(2 * size + 2, dtype=np.float32)
        if words:
            ids = np.array(self._ids(words))
            distinct, n = np.unique(ids, return_counts=True)
            rows, share = self.table[distinct], (n / len(ids)).astype(np.float32)
            out[:size] = share @ rows
            out[size : 2 * size] = share @ (rows * rows)
            out[-2] = (ids[1:] == ids[:-1]).mean() if len(ids) > 1 else 0
            out[-1] = 1 / len(words)
        return out

    def batch(self, texts: list[str | None]) -> np.ndarray:
        return np.stack([self.pooled(t) for t in texts]) if texts else np.zeros((0, 2 * self.table.shape[1] + 2), dtype=np.float32)


@dataclass
class Network:
    """Two layers on standardised inputs, and the temperature of its logits."""

    mean: np.ndarray
    scale: np.ndarray
    w1: np.ndarray
    b1: np.ndarray
    w2: np.ndarray
    b2: float
    temperature: float = 1.0

    def logits(self, x: np.ndarray) -> np.ndarray:
        return np.maximum((x - self.mean) / self.scale @ self.w1 + self.b1, 0) @ self.w2 + self.b2

    def probabilities(self, x: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(self.logits(x).astype(np.float64) / self.temperature, -30, 30)))


def fit_network(x: np.ndarray, y: np.ndarray, epochs: int = 150, batch: int = 64, rate: float = 3e-3, decay: float = 1e-3) -> Network:
    """Adam on the cross-entropy; the last fifth of the rows sets the temperature and nothing else."""
    rng = np.random.Generator(np.random.PCG64(7))
    order = rng.permutation(len(x))
    x, y = x[order].astype(np.float32), y[order].astype(np.float32)
    cut = max(1, len(x) * 4 // 5)
    mean, scale = x[:cut].mean(axis=0), x[:cut].std(axis=0) + 1e-3
    net = Network(mean, scale, rng.normal(0, np.sqrt(2 / x.shape[1]), (x.shape[1], HIDDEN)).astype(np.float32), np.zeros(HIDDEN, np.float32), rng.normal(0, 0.1, HIDDEN).astype(np.float32), 0.0)
    z = (x - mean) / scale
    weight = np.where(y == 1, 0.5 / max(y[:cut].mean(), 1e-3), 0.5 / max(1 - y[:cut].mean(), 1e-3)).astype(np.float32)
    weight = np.sqrt(weight)  # between the true and equal shares of the classes
    parameters = [net.w1, net.b1, net.w2, np.zeros(1, np.float32)]
    first, second = [np.zeros_like(p) for p in parameters], [np.zeros_like(p) for p in parameters]
    step = 0
    for _ in range(epochs):
        for rows in np.array_split(rng.permutation(cut), max(1, cut // batch)):
            hidden = np.maximum(z[rows] @ parameters[0] + parameters[1], 0)
            p = 1 / (1 + np.exp(-np.clip(hidden @ parameters[2] + parameters[3], -30, 30)))
            error = (p - y[rows]) * weight[rows] / len(rows)
            back = np.outer(error, parameters[2]) * (hidden > 0)
            slopes = [z[rows].T @ back + decay * parameters[0], back.sum(0), hidden.T @ error + decay * parameters[2], error.sum(keepdims=True)]
            step += 1
            for k, g in enumerate(slopes):
                first[k] = 0.9 * first[k] + 0.1 * g
                second[k] = 0.999 * second[k] + 0.001 * g * g
                parameters[k] -= rate * (first[k] / (1 - 0.9**step)) / (np.sqrt(second[k] / (1 - 0.999**step)) + 1e-8)
    net.w1, net.b1, net.w2, net.b2 = parameters[0], parameters[1], parameters[2], float(parameters[3][0])
    if len(x) - cut < LEAST_APART:
        return net
    logits, truth = net.logits(x[cut:]).astype(np.float64), y[cut:]

    def loss(t: float) -> float:
        return float(np.mean(np.logaddexp(0, logits / t) - truth * logits / t))

    net.temperature = float(min(np.geomspace(0.5, 4, 40), key=loss))
    return net


@dataclass
class QualityModel:
    vectors: np.ndarray
    network: Network | None
    prior: float = 1.0

    def scores(self, texts: list[str | None], pooler: Pooler) -> np.ndarray:
        if self.network is None:
            return np.full(len(texts), self.prior)
        return self.network.probabilities(pooler.batch(texts))


def labelled(docs: DataFrame, labels: DataFrame, label: str, modulus: int, held_out: int, rows: int, id_column: str, text_column: str) -> DataFrame:
    """_id, _text and _label of the documents of ``rows`` labelled ids outside the fold, the first by their hash."""
    known = labels.where(F.col(label).isin(0, 1) & F.col(id_column).isNotNull() & ~is_fold(id_column, modulus, held_out))
    known = known.groupBy(F.col(id_column).alias("_id")).agg(F.min(label).cast("int").alias("_label"), F.max(label).cast("int").alias("_other"))
    chosen = known.where("_label = _other").drop("_other").orderBy(F.xxhash64("_id"), "_id").limit(rows)
    return docs.select(F.col(id_column).alias("_id"), F.col(text_column).alias("_text")).join(F.broadcast(chosen), "_id")


def _in_child(fit: Callable[[list[tuple[bytes, int]]], T], sample: list[tuple[bytes, int]]) -> bytes:
    """What ``fit`` makes of the sample, pickled, by a process that ends: the worker is used again and would keep the memory."""
    read, write = os.pipe()
    child = os.fork()
    if not child:
        try:
            os.close(read)
            with os.fdopen(write, "wb") as out:
                pickle.dump(fit(sample), out)
            os._exit(0)
        except BaseException:
            traceback.print_exc()
        finally:
            os._exit(1)
    os.close(write)
    with os.fdopen(read, "rb") as made:
        raw = made.read()
    if os.waitpid(child, 0)[1]:
        raise RuntimeError("the fit failed; its error is in the worker's log")
    return raw


def fit_in_task(rows: DataFrame, compute: Callable[[list[str]], list[bytes]], fit: Callable[[Iterable[tuple[bytes, int]]], T], most_rows: int, most_bytes: int) -> T:
    """What ``fit`` makes of the features and labels of the first rows by a hash of the id, within both bounds.

    Features are made in tasks and the fit is one task's, as the driver has little room.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            made = [x for texts in by_bytes(batch.column(1)) for x in compute(texts)]
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(2), pa.array(made, pa.binary())], ["place", "label", "features"])

    def learn(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def sample() -> Iterator[tuple[bytes, int]]:
            size = 0
            for batch in batches:
                for features, label in zip(*batch.columns):
                    size += len(features.as_py())
                    if size > most_bytes:
                        continue  # the rest is read, as the worker's input must be
                    yield features.as_py(), label.as_py()

        yield pa.RecordBatch.from_arrays([pa.array([_in_child(fit, list(sample()))], pa.binary())], ["model"])
        give_back()

    with scratch(rows.sparkSession):
        found = rows.select(F.xxhash64("_id").alias("place"), "_text", "_label").mapInArrow(run, "place long, label int, features binary")
        first = stored(found, "features").orderBy("place", F.xxhash64("features")).limit(most_rows)
        models = first.select("features", "label").mapInArrow(learn, "model binary").collect()
        return pickle.loads(models[0]["model"]) if models else fit(())


def fit_pooled(sample: Iterable[tuple[bytes, int]]) -> Network | float:
    """The network, or the share of label 1 if that is all there is to learn."""
    x, y = [], []
    for features, label in sample:
        x.append(np.frombuffer(features, np.float32))
        y.append(label)
    if len(set(y)) < 2:
        return float(np.mean(y)) if y else 1.0
    return fit_network(np.stack(x), np.array(y))


def fit_quality(docs: DataFrame, labels: DataFrame, sample_rows: int, id_column: str, text_column: str) -> QualityModel:
    vectors = corpus_vectors(docs, text_column)
    shared = docs.sparkSession.sparkContext.broadcast(vectors)

    def pooled(texts: list[str]) -> list[bytes]:
        return [x.tobytes() for x in Pooler(shared.value).batch(texts)]

    rows = labelled(docs, labels, "quality", 4, 2, sample_rows, id_column, text_column)
    learned = fit_in_task(rows, pooled, fit_pooled, sample_rows, sample_rows * (2 * DIMENSIONS + 2) * 4)
    return QualityModel(vectors, learned) if isinstance(learned, Network) else QualityModel(vectors, None, learned)


def quality_scores(docs: DataFrame, labels: DataFrame, sample_rows: int = SAMPLE_ROWS, threshold: float = 0.7, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """Score and verdict for each document; labels of the fold crc32(id) mod 4 = 2 are never learned from."""
    model = docs.sparkSession.sparkContext.broadcast(fit_quality(docs, labels, sample_rows, id_column, text_column))
    scored = with_scores(docs.select(F.col(id_column).alias("_id"), F.col(text_column).alias("_text")), model, Pooler)
    return scored.select(
        F.col("_id").alias(id_column), is_fold("_id", 4, 2).alias("held_out"), "score", (F.col("score") >= threshold).cast("int").alias("predicted")
    )


def quality_filter(docs: DataFrame, labels: DataFrame, sample_rows: int = SAMPLE_ROWS, threshold: float = 0.7, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """All columns of the documents with a score of at least ``threshold``."""
    model = docs.sparkSession.sparkContext.broadcast(fit_quality(docs, labels, sample_rows, id_column, text_column))
    return filtered(docs, model, Pooler, lambda s: s >= threshold, text_column)


def _scored(texts: pa.Array, fitted, cache) -> np.ndarray:
    parts = [fitted.scores(some, cache) for some in by_bytes(texts)]
    return np.concatenate(parts) if parts else np.zeros(0)


def filtered(docs: DataFrame, model, helper, keep, text_column: str) -> DataFrame:
    """The rows whose score ``keep`` accepts, in one pass and with all columns; ``model`` is a broadcast variable."""
    place = docs.columns.index(text_column)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cache = helper(model.value.vectors)
        with no_collection():
            for batch in batches:
                yield batch.filter(pa.array(keep(_scored(batch.column(place), model.value, cache)), pa.bool_()))
        del cache
        give_back()

    return docs.mapInArrow(run, docs.schema)


def with_scores(source: DataFrame, model, helper) -> DataFrame:
    """Id and score of each row (_id, _text); ``model`` is a broadcast variable, ``helper`` makes each task's cache."""
    kind = dict(source.dtypes)["_id"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cache = helper(model.value.vectors)
        with no_collection():
            for batch in batches:
                yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(_scored(batch.column(1), model.value, cache), pa.float64())], ["_id", "score"])
        del cache
        give_back()

    return source.mapInArrow(run, f"_id {kind}, score double")
