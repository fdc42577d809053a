"""Line dedup: later copies of repeated runs of lines are deleted.

A run of consecutive lines with at least ``min_words`` words is deleted where
the same lines stand earlier, in the order of (id, text hash, line number). A
line goes if any such run covers it; copies may overlap.

The order of work keeps the suffix structure small. Lines that occur once
cannot be in a run, so documents fall apart into segments of repeated lines;
segments with too few words go, and equal segments are kept once (a later copy
of a segment is a later copy of all of it). On the line numbers of the distinct
segments, prefix doubling sorts all suffixes by their first 1, 2, 4, ... lines.
Suffixes that agree on L lines are an interval of that order, in which all
longest common prefixes have L lines or more; its name are the ranks of the two
blocks of a power of two that cover the L lines. The first suffix of an interval
stays, the others are later copies. Of the lengths from a suffix, only those
from the shortest with enough words to the shortest that the next suffix needs
are looked at: longer runs are unions of these.

No step holds a line, run or interval in one task, however many there are: joins
deal the rows of such a key over partitions by its known number of rows. What
is deleted is kept as spans, never line by line.

Defined results: a null text has no lines and stays null; an empty text has one
empty line; rows equal in id and text are one document and get equal results; a
null id sorts first; all other columns are carried along, and the two counts get
names with underscores behind where the documents have such columns. A document
whose lines all go keeps its row, with an empty text. Line keys are two 64-bit
hashes.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from arealis.llm.common import SPACE, free_name, may_match, spread_join
from arealis.scratch import scratch, stored

#: Runs with fewer words are left alone: headings, licences and the like repeat by nature.
MIN_WORDS = 50


def dense_ranks(df: DataFrame, columns: list[str], name: str) -> DataFrame:
    """The distinct values of the columns with their place in sorted order, by a range partitioning, and _n, their rows."""
    ordered = df.groupBy(*columns).agg(F.count("*").alias("_n")).repartitionByRange(*columns).sortWithinPartitions(*columns)
    local = F.monotonically_increasing_id()
    numbered = stored(ordered.select("*", F.shiftright(local, 33).alias("_part"), local.bitwiseAND((1 << 33) - 1).alias("_local")), "ranks")
    before = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)  # as many rows as partitions
    offsets = numbered.groupBy("_part").count().withColumn("_before", F.coalesce(F.sum("count").over(before), F.lit(0)))
    return numbered.join(F.broadcast(offsets.select("_part", "_before")), "_part").select(*columns, (F.col("_before") + F.col("_local")).alias(name), "_n")


def _segments(docs: DataFrame, id_column: str, text_column: str, min_words: int) -> DataFrame:
    """Runs of repeated lines with enough words: id, text hash, first line, and arrays of line keys and words."""
    texts = docs.select(F.col(id_column).alias("id"), F.xxhash64(text_column).alias("h"), F.posexplode(F.split(text_column, "\n")).alias("i", "line"))
    words = F.size(F.array_remove(F.split("line", f"{SPACE}+"), ""))
    lines = texts.select("id", "h", "i", F.xxhash64("line").alias("a"), F.xxhash64(F.lit(1), "line").alias("b"), words.alias("w"))
    lines = stored(lines.dropDuplicates(["id", "h", "i"]), "lines")
    repeated = stored(lines.groupBy("a", "b").agg(F.count("*").alias("_n")).where("_n > 1"), "repeated")
    mine = Window.partitionBy("id", "h").orderBy("i")
    runs = spread_join(lines, repeated, ["a", "b"], ["id", "h", "i"]).withColumn("run", F.col("i") - F.row_number().over(mine))
    packed = F.array_sort(F.collect_list(F.struct("i", "a", "b", "w")))
    found = runs.groupBy("id", "h", "run").agg(F.sum("w").alias("words"), packed.alias("lines")).where(F.col("words") >= min_words)
    keys = F.transform("lines", lambda x: F.struct(x["a"], x["b"]))
    return found.select("id", "h", F.col("lines")[0]["i"].alias("start"), F.size("lines").alias("n"), F.xxhash64(keys).alias("s"), F.xxhash64(F.lit(1), keys).alias("s2"), "lines")


def windows_of(words: np.ndarray, bounds: np.ndarray, min_words: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Segment, start and end of the lengths to look at, for segments of lines with these words that end at these bounds."""
    at = np.arange(len(words))
    of = np.searchsorted(bounds[1:], at, side="right")
    first, last = bounds[of], bounds[of + 1]
    sums = np.r_[0, np.cumsum(words)]
    low = np.minimum(np.searchsorted(sums, sums[:-1] + min_words), last + 1)  # the first end with enough words
    following = np.where(at + 1 < last, np.r_[low[1:], 0], last + 1)
    high = np.maximum(np.minimum(following - 1, last), low)
    j = np.flatnonzero(low <= last)
    each = (high - low + 1)[j]
    end = np.repeat(low[j], each) + np.arange(each.sum()) - np.repeat(np.cumsum(each) - each, each)
    start = np.repeat(j, each)
    return of[start], start - first[start], end - first[start]


def _windows(kept: DataFrame, min_words: int) -> DataFrame:
    """For each suffix of each distinct segment the ends, and so the lengths, to look at (see above)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            s, s2, words = batch.columns
            bounds = np.r_[0, np.cumsum([len(w) for w in words])]
            of, start, end = windows_of(words.flatten().to_numpy(zero_copy_only=False).astype(np.int64), bounds, min_words)
            for k in range(0, len(of), 100_000):
                part = slice(k, k + 100_000)
                made = [pa.array(x[part], pa.int32()) for x in (start, end, end - start)]
                yield pa.RecordBatch.from_arrays([s.take(pa.array(of[part])), s2.take(pa.array(of[part])), *made], ["s", "s2", "j", "end", "length"])

    words = F.transform("lines", lambda x: x["w"]).alias("words")
    return kept.select("s", "s2", words).mapInArrow(run, "s long, s2 long, j int, end int, length int")


def deleted_spans(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text", min_words: int = MIN_WORDS) -> DataFrame:
    """Id, text hash, start and end of the spans of lines that are later copies; spans may overlap."""
    segments = stored(_segments(docs, id_column, text_column, min_words), "segments")
    place = F.struct("id", "h", "start")
    kept = stored(segments.groupBy("s", "s2").agg(F.min(place).alias("place"), F.first("lines").alias("lines"), F.count("*").alias("_n")), "distinct")
    copies = spread_join(segments.drop("lines"), kept.select("s", "s2", "place", "_n"), ["s", "s2"], ["id", "h", "start"])
    whole = copies.where(~place.eqNullSafe(F.col("place"))).select("id", "h", "start", (F.col("start") + F.col("n")).alias("end"))

    lines = kept.select("s", "s2", F.posexplode("lines").alias("j", "x")).select("s", "s2", "j", F.col("x.a").alias("a"), F.col("x.b").alias("b"))
    ranks = stored(spread_join(lines, dense_ranks(lines, ["a", "b"], "rank"), ["a", "b"], ["s", "s2", "j"]).drop("a", "b"), "positions")
    windows = stored(_windows(kept, min_words), "windows")
    longest = windows.agg(F.max("length")).first()[0] or 0
    suffix = Window.partitionBy("s", "s2").orderBy("j")
    level, found = 0, None
    while (1 << level) <= longest:
        size = 1 << level
        here = windows.where((F.col("length") >= size) & (F.col("length") < 2 * size))
        second = ranks.select("s", "s2", (F.col("j") + size).alias("end"), F.col("rank").alias("rank2"))
        named = here.join(ranks, ["s", "s2", "j"]).join(second, ["s", "s2", "end"])
        found = named if found is None else found.unionByName(named)
        level += 1
        if (1 << level) <= longest:
            pairs = ranks.withColumn("next", F.lead("rank", size).over(suffix)).where(F.col("next").isNotNull())
            pairs = stored(pairs, "pairs")
            higher = spread_join(pairs, dense_ranks(pairs, ["rank", "next"], "new"), ["rank", "next"], ["s", "s2", "j"])
            ranks = stored(higher.select("s", "s2", "j", F.col("new").alias("rank")), "ranked")
    if found is None:
        return whole
    found = found.join(kept.select("s", "s2", "place"), ["s", "s2"])
    at = F.struct(F.col("place.id").alias("id"), F.col("place.h").alias("h"), (F.col("place.start") + F.col("j")).alias("i"))
    found = stored(found.select("length", "rank", "rank2", at.alias("at")), "intervals")
    intervals = stored(found.groupBy("length", "rank", "rank2").agg(F.min("at").alias("first"), F.count("*").alias("_n")).where("_n > 1"), "first")
    later = spread_join(found, intervals, ["length", "rank", "rank2"], ["at"]).where(F.col("first") < F.col("at"))
    return whole.unionByName(later.select("at.id", "at.h", F.col("at.i").alias("start"), (F.col("at.i") + F.col("length")).alias("end")))


def kept_ranges(spans: DataFrame) -> DataFrame:
    """For each document the ranges of lines (from, to) between its spans, in order, and tail, the end of the last span."""
    spans = spans.groupBy("id", "h", "start").agg(F.max("end").alias("end"))
    earlier = Window.partitionBy("id", "h").orderBy("start").rowsBetween(Window.unboundedPreceding, -1)
    reached = spans.withColumn("reached", F.coalesce(F.max("end").over(earlier), F.lit(0)))
    gap = F.when(F.col("start") > F.col("reached"), F.struct(F.col("reached").alias("from"), F.col("start").alias("to")))
    return reached.groupBy("id", "h").agg(F.array_sort(F.collect_list(gap)).alias("ranges"), F.max("end").alias("tail"))


def _let(value: Column, body: Callable[[Column], Column]) -> Column:
    return F.element_at(F.transform(F.array(value), body), 1)


def line_dedup(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text", min_words: int = MIN_WORDS) -> DataFrame:
    """All columns, the text without later copies, and as the last two columns the numbers of lines and of deleted ones."""
    with scratch(docs.sparkSession):
        spans = deleted_spans(docs, id_column, text_column, min_words)
        left = stored(kept_ranges(spans), "left", keep=True).select(F.col("id").alias("__id"), F.col("h").alias("__h"), "ranges", "tail")
    left = left.select("__id", "__h", F.struct("ranges", "tail").alias("__left"))
    keyed = docs.withColumn("__key", F.xxhash64(text_column))
    # Texts that nothing is deleted from stay where they are, but for those that share a mark with another.
    marked = may_match(keyed, F.xxhash64(id_column, "__key"), left, F.xxhash64("__id", "__h"))
    joined = marked.where("__may").join(left, F.col(id_column).eqNullSafe(F.col("__id")) & (F.col("__key") == F.col("__h")), "left")
    joined = joined.unionByName(marked.where("NOT __may"), allowMissingColumns=True)

    def remaining(lines: Column) -> Column:
        between = F.transform("__left.ranges", lambda r: F.slice(lines, r["from"] + 1, r["to"] - r["from"]))
        return F.concat(F.flatten(between), F.slice(lines, F.col("__left.tail") + 1, F.size(lines) - F.col("__left.tail")))

    text = F.when(F.col("__left").isNull(), F.col(text_column)).otherwise(F.array_join(_let(F.split(text_column, "\n"), remaining), "\n"))
    total = F.coalesce(F.size(F.split(text_column, "\n")), F.lit(0)).cast("long")
    between = F.aggregate("__left.ranges", F.lit(0), lambda a, r: a + r["to"] - r["from"])
    deleted = F.coalesce(F.col("__left.tail") - between, F.lit(0)).cast("long")
    columns = [text.alias(c) if c == text_column else F.col(c) for c in docs.columns]
    return joined.select(*columns, total.alias(free_name(docs, "n_lines")), deleted.alias(free_name(docs, "n_deleted")))
