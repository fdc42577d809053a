"""Best-two-fit packing of token sequences into bins of fixed size.

A plan is made for the histogram of piece lengths, which has at most as many
entries as a bin has places: fill a bin greedily with the longest pieces that
fit, then replace its shortest piece by two unpacked ones that fit the expanded
gap more tightly, and use the resulting pattern as often as the counts allow.
Each pattern uses up the last of some length, so the plan is small whatever the
number of documents. Pieces then take their places by their rank among those of
their length. Ranks come from counts per file partition, so no length, however
common, meets in one task.

Defined results: a null text is empty and becomes one piece of one token; a
null id stays null; each repeated row is packed as a document of its own; an
empty table gives no rows. Columns beyond id and text are not read.
"""

from __future__ import annotations

import sys
import zlib
from array import array
from collections import Counter
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from arealis.llm.bpe import PieceCache
from arealis.llm.common import by_bytes, giving_back, no_collection
from arealis.llm.token_counts import Library, library
from arealis.scratch import stored

#: One run of the plan: ranks lo..hi-1 of a length go to sequences from ``base`` on, ``each`` to a sequence, from ``place`` on.
PLAN_COLUMNS = ("length", "lo", "hi", "base", "each", "place")


def best_two_fit(counts: dict[int, int], size: int) -> list[tuple[list[tuple[int, int]], int]]:
    """Patterns ([(length, how many)], how often) that use all pieces of these lengths up."""
    left = {n: c for n, c in sorted(counts.items(), reverse=True) if c > 0}
    out = []
    while left:
        lengths = list(left)  # the longest first
        used: Counter[int] = Counter()
        gap = size
        for n in lengths:
            fit = min(gap // n, left[n])
            if fit:
                used[n] += fit
                gap -= fit * n
            if not gap:
                break
        if gap:
            _replace_smallest(left, used, gap)
        often = min(left[n] // k for n, k in used.items())
        out.append((sorted(used.items(), reverse=True), often))
        for n, k in used.items():
            left[n] -= k * often
            if not left[n]:
                del left[n]
    return out


def _replace_smallest(left: dict[int, int], used: Counter[int], gap: int) -> None:
    """Put two unpacked pieces in the place of the shortest one, if they leave less room."""
    smallest = min(used)
    room = gap + smallest
    free = sorted(n for n, c in left.items() if c > used[n])
    best, pair = smallest, None
    i, j = 0, len(free) - 1
    while i <= j:
        a, b = free[i], free[j]
        if a + b > room:
            j -= 1
            continue
        if a + b > best and (a != b or left[a] - used[a] >= 2):
            best, pair = a + b, (a, b)
        i += 1
    if pair:
        used[smallest] -= 1
        if not used[smallest]:
            del used[smallest]
        for n in pair:
            used[n] += 1


def plan_runs(counts: dict[int, int], size: int) -> np.ndarray:
    """The plan as rows of PLAN_COLUMNS, ordered by length and rank."""
    rank: Counter[int] = Counter()
    rows, base = [], 0
    for pattern, often in best_two_fit(counts, size):
        place = 0
        for n, each in pattern:
            rows.append((n, rank[n], rank[n] + each * often, base, each, place))
            rank[n] += each * often
            place += n * each
        base += often
    return np.array(sorted(rows), dtype=np.int64).reshape(-1, len(PLAN_COLUMNS))


def _raw(ids: list[int]) -> bytes:
    """Ids as little-endian unsigned 32-bit numbers."""
    out = array("I", ids)
    if out.itemsize != 4 or sys.byteorder != "little":
        return np.array(ids, dtype="<u4").tobytes()
    return out.tobytes()


@lru_cache(maxsize=2)
def _coder(tokenizer: str) -> tuple[Library, PieceCache]:
    coder = library(tokenizer)
    return coder, PieceCache(lambda pieces: map(_raw, coder.pieces(pieces)))


def forget() -> None:
    """Let go of tokenizers and caches: a worker would hold them, 165 MB after two tasks, while it runs the tasks of other operators."""
    _coder.cache_clear()
    library.cache_clear()


def token_bytes(texts: list[str], tokenizer: str) -> Iterator[bytes]:
    """The ids of each text as little-endian unsigned 32-bit numbers."""
    coder, cache = _coder(tokenizer)
    if coder.by_pieces:
        return map(b"".join, coder.found(texts, cache, lambda i: _raw([i])))
    return map(_raw, coder.whole(texts))


def token_pieces(docs: DataFrame, tokenizer: str, size: int, end_id: int, id_column: str, text_column: str) -> DataFrame:
    """Pieces of at most ``size`` tokens, each with its rank among the equally long ones of its task."""
    source = docs.select(docs[id_column], docs[text_column])
    kind = dict(source.dtypes)[id_column]
    end = _raw([end_id])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        task = TaskContext.get().partitionId()
        seen: Counter[int] = Counter()
        longs = lambda x: pa.array(x, pa.int64())
        with no_collection():
            for batch in batches:
                of, piece, start, length, crc, rank = [], [], [], [], [], []
                texts = (t for some in by_bytes(batch.column(1)) for t in token_bytes(some, tokenizer))
                for at, ids in enumerate(texts):
                    ids += end
                    n = len(ids) // 4
                    cuts = [0, *range(n % size or size, n + 1, size)]
                    for k, (x, y) in enumerate(zip(cuts, cuts[1:])):
                        of.append(at)
                        piece.append(k)
                        start.append(x)
                        length.append(y - x)
                        crc.append(zlib.crc32(ids[4 * x : 4 * y]))
                        rank.append(seen[y - x])
                        seen[y - x] += 1
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).take(longs(of)), pa.array(piece, pa.int32()), longs(start), longs(length), longs(crc), longs(rank), pa.array([task] * len(of), pa.int32())],
                    ["id", "piece", "start", "length", "ids_crc32", "local_rank", "task"],
                )
        forget()

    return source.mapInArrow(giving_back(run), f"id {kind}, piece int, start long, length long, ids_crc32 long, local_rank long, task int")


def pack(docs: DataFrame, tokenizer: str, size: int = 1024, end_id: int = 2, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """A row for each piece with its sequence and place there."""
    pieces = stored(token_pieces(docs, tokenizer, size, end_id, id_column, text_column), "pieces")
    per_task = pieces.groupBy("length", "task").agg(F.count("*").alias("n"))
    before = Window.partitionBy("length").orderBy("task").rowsBetween(Window.unboundedPreceding, -1)
    offsets = stored(per_task.withColumn("before", F.coalesce(F.sum("n").over(before), F.lit(0))), "offsets")
    counts = {r["length"]: r["n"] for r in offsets.groupBy("length").agg(F.sum("n").alias("n")).collect()}  # at most ``size`` rows
    runs = plan_runs(counts, size)
    first = np.searchsorted(runs[:, 0], np.arange(size + 2))

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            columns = dict(zip(batch.schema.names, batch.columns))
            length, rank = columns["length"].to_numpy(), columns.pop("rank").to_numpy()
            at = np.zeros(len(length), dtype=np.int64)
            for n in np.unique(length):
                mine, low = length == n, first[n]
                at[mine] = low + np.searchsorted(runs[low : first[n + 1], 1], rank[mine], side="right") - 1
            _, lo, _, base, each, begin = runs[at].T
            nth = rank - lo
            columns |= {"sequence_id": pa.array(base + nth // each), "offset": pa.array(begin + nth % each * length)}
            yield pa.RecordBatch.from_arrays(list(columns.values()), list(columns))

    ranked = pieces.join(offsets.select("length", "task", "before"), ["length", "task"]).withColumn("rank", F.col("before") + F.col("local_rank"))
    kind = dict(pieces.dtypes)["id"]
    out = ranked.select("id", "piece", "start", "length", "ids_crc32", "rank").mapInArrow(place, f"id {kind}, piece int, start long, length long, ids_crc32 long, sequence_id long, offset long")
    return out.withColumnRenamed("id", id_column)
