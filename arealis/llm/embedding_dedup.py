"""Embedding near-dedup: iterative quantisation, multi-index Hamming tables, exact rerank.

Rotations of the centred unit vectors are learned on at most ``SAMPLE_ROWS`` of
them so that signs make balanced codes; every vector is encoded. The code is
cut into tables of a few bits, and vectors meet where they have the same bits in
a table. A pair is looked at in its first such table only, so nothing counts
twice. Pairs whose whole codes differ in too many bits are dropped; the rest is
reranked by the cosine of the original vectors in double precision.

The size of the index follows from the data: on the sample, pairs are made
whose cosine is the threshold, half of them with differences in any direction,
half towards other vectors. Bits of a table are those that find ``RECALL`` of
the worse half at the least cost for the number of vectors; then rotations are
added until it is reached, whatever the width or the mean of the vectors.
``exact`` compares all vectors in blocks instead, for tables that are small
enough and to measure recall.

Equal vectors are one node from the start. A group's pairs are never rows: its
members are dealt over blocks, each packed into one row with its links and
components; where a group has several blocks, one task compares a block with all
others, and returns counts for its members and only such links as join
components.

Defined results: vectors that are null, empty, zero, or hold a null or a
non-finite number link with nothing and are their own component; vectors of
different lengths do not link; repeated rows count as links of each other; a
null id never names a component unless it has no other. Other columns are not
read.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from arealis.llm.common import small_batches, spread_join
from arealis.llm.graph import components
from arealis.scratch import scratch, stored

#: Rows of the fit, its rounds, the share of pairs at the threshold that the index must find, and bits of one rotation.
SAMPLE_ROWS, ROUNDS, RECALL, ROTATION = 4096, 30, 0.97, 64
#: Bits that a table may have, and the cost of looking at a pair as a part of the cost of an entry.
TABLE_BITS, PAIR_COST = range(4, 17), 0.02
#: Vectors of a block, and vectors of one key that are looked at in one step before they are dealt over blocks.
BLOCK, GROUP_ROWS = 512, 8192
#: Bits from which the size of the index is chosen.
LEAST_BITS = 256

U = np.uint64


@dataclass
class Codes:
    """Codes of unit vectors: signs on turned axes, in tables of ``bits``, as many to a word of 64 bits as fit."""

    mean: np.ndarray
    axes: np.ndarray
    bits: int
    most: int = 1 << 30  # differing bits of pairs that are looked at

    @property
    def tables(self) -> int:
        return self.axes.shape[1] // self.bits

    @property
    def words(self) -> int:
        return -(-self.tables // (64 // self.bits))

    def encode(self, unit: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The bits of each table, and all of them in words."""
        signs = ((unit - self.mean) @ self.axes[:, : self.tables * self.bits] > 0).reshape(len(unit), self.tables, self.bits)
        parts = np.where(signs, U(1) << np.arange(self.bits, dtype=U), U(0)).sum(axis=2, dtype=U)
        words = np.zeros((len(unit), self.words), dtype=U)
        for t in range(self.tables):
            words[:, t // (64 // self.bits)] |= parts[:, t] << U(t % (64 // self.bits) * self.bits)
        return parts, words

    def meet_first(self, a: np.ndarray, b: np.ndarray, table: np.ndarray) -> np.ndarray:
        """Whether pairs of words that meet in this table are near enough and meet in none before."""
        difference = a ^ b
        out = np.bitwise_count(difference).sum(axis=1) <= self.most
        rows = np.flatnonzero(out)
        table, per, low = table[rows], 64 // self.bits, U((1 << self.bits) - 1)
        good = np.ones(len(rows), dtype=bool)
        for t in range(int(table.max()) if len(rows) else 0):
            good &= (table <= t) | ((difference[rows, t // per] >> U(t % per * self.bits)) & low != 0)
        out[rows] = good
        return out


def unit_rows(x: np.ndarray) -> np.ndarray:
    return x / np.linalg.norm(x, axis=1, keepdims=True)


def _pairs_at(threshold: float, unit: np.ndarray, rng: np.random.Generator) -> tuple[np.ndarray, np.ndarray]:
    """For vectors of the sample, others at this cosine: away in any direction, and towards another vector."""
    start = unit[rng.permutation(len(unit))[:1000]]
    out = []
    for aim in (rng.normal(size=start.shape), unit[rng.integers(0, len(unit), len(start))] + 1e-3 * rng.normal(size=start.shape)):
        across = aim - (aim * start).sum(axis=1, keepdims=True) * start
        length = np.linalg.norm(across, axis=1, keepdims=True)
        out.append(threshold * start + np.sqrt(1 - threshold * threshold) * across / np.maximum(length, 1e-12))
    return np.concatenate([start, start]), np.concatenate(out)


def _turned(centred: np.ndarray, k: int, rng: np.random.Generator) -> np.ndarray:
    """The k-th rotation: principal axes first, then random ones, turned so that signs lie close to the vectors; later ones less."""
    wide = centred.shape[1]
    width = min(ROTATION, wide)
    if k == 0 and len(centred) >= width and wide <= 1024:
        axes = np.linalg.eigh(centred.T @ centred)[1][:, ::-1][:, :width]
    else:
        axes = np.linalg.qr(rng.normal(size=(wide, width)))[0]
    v = centred @ axes
    rotation = np.linalg.qr(rng.normal(size=(width, width)))[0]
    for _ in range(ROUNDS // (k + 1)):
        signs = np.where(v @ rotation > 0, 1.0, -1.0)
        left, _, right = np.linalg.svd(signs.T @ v)
        rotation = (left @ right).T
    return axes @ rotation


def fit_codes(x: np.ndarray, total: int, threshold: float, recall: float = RECALL) -> Codes:
    """Codes for ``total`` vectors like the rows of x."""
    rng = np.random.Generator(np.random.PCG64(3))
    unit = unit_rows(x)
    mean = unit.mean(axis=0)
    centred = unit - mean
    first, second = _pairs_at(threshold, unit, rng)
    others, half = unit[rng.integers(0, len(unit), len(first))], len(first) // 2
    turned: list[np.ndarray] = []

    def turn() -> np.ndarray:
        turned.append(_turned(centred, len(turned), rng))
        return turned[-1]

    def worse(found: np.ndarray) -> float:
        return min(found[:half].mean(), found[half:].mean())

    while not turned or sum(x.shape[1] for x in turned) < LEAST_BITS:
        turn()
    signs = [(y - mean) @ np.concatenate(turned, axis=1) > 0 for y in (first, second, others)]
    stays, met = (np.mean(signs[0] == x, axis=1) for x in signs[1:])  # the share of bits that each pair has in common

    def tables_for(bits: int) -> int:
        t = np.unique(np.geomspace(1, 1 << 14, 120).astype(np.int64))
        return next((int(n) for n in t if worse(1 - (1 - stays**bits) ** n) >= recall), 1 << 15)

    bits = min(TABLE_BITS, key=lambda n: tables_for(n) * (1 + PAIR_COST * total * float((met**n).mean())))
    same, seen, tables = signs[0] == signs[1], np.zeros(len(first), dtype=bool), 0
    while worse(seen) < recall:
        if same.shape[1] < bits:
            axes = turn()
            same = np.concatenate([same, ((first - mean) @ axes > 0) == ((second - mean) @ axes > 0)], axis=1)
        seen |= same[:, :bits].all(axis=1)
        same = same[:, bits:]
        tables += 1
    codes = Codes(mean, np.ascontiguousarray(np.concatenate(turned, axis=1)[:, : tables * bits]), bits)
    differences = np.bitwise_count(codes.encode(first)[1] ^ codes.encode(second)[1]).sum(axis=1)
    codes.most = int(differences.max()) + tables
    return codes


def _matrix(column: pa.Array, width: int) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(-1, width)


def _word_columns(words: int) -> list[str]:
    return [f"w{k}" for k in range(words)]


def _entries(vectors: DataFrame, codes: Codes, width: int) -> DataFrame:
    """Each vector under its bits in each table: table and bits in ``key``, and the whole code."""
    names = ["key", "rid", *_word_columns(codes.words)]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            parts, words = codes.encode(unit_rows(_matrix(batch.column(1), width)))
            for t in range(codes.tables):
                key = (parts[:, t] | U(t << 32)).view(np.int64)
                columns = [pa.array(key), batch.column(0), *(pa.array(np.ascontiguousarray(w).view(np.int64)) for w in words.T)]
                yield pa.RecordBatch.from_arrays(columns, names)

    return vectors.select("rid", "vector").mapInArrow(run, ", ".join(f"{n} long" for n in names))


def _met(entries: DataFrame, codes: Codes) -> DataFrame:
    """Entries that have a partner to look at; of keys beyond GROUP_ROWS all."""
    names = ["key", "rid", *_word_columns(codes.words)]

    def with_partner(rows: np.ndarray) -> np.ndarray:
        key, words = rows[:, 0], np.ascontiguousarray(rows[:, 2:]).view(U)
        keep = np.zeros(len(rows), dtype=bool)
        for d in range(1, len(rows)):
            same = np.flatnonzero(key[d:] == key[:-d])
            if not len(same):
                break
            same = same[codes.meet_first(words[same], words[same + d], key[same] >> 32)]
            keep[same] = keep[same + d] = True
        return rows[keep]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, hot = np.zeros((0, len(names)), dtype=np.int64), None

        def out(rows: np.ndarray) -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array(c) for c in rows.T], names)

        for batch in batches:
            rows = np.concatenate([held, np.stack([c.to_numpy() for c in batch.columns], axis=1)])
            whole = rows[:, 0] == hot if hot is not None else np.zeros(len(rows), dtype=bool)
            if whole.any():
                yield out(rows[whole])
                rows = rows[~whole]
            last = rows[:, 0] == rows[-1, 0] if len(rows) else np.zeros(0, dtype=bool)
            if (~last).any():
                yield out(with_partner(rows[~last]))
            held = rows[last]
            if len(held) > GROUP_ROWS:
                hot = held[-1, 0]
                yield out(held)
                held = held[:0]
        if len(held):
            yield out(with_partner(held))

    return entries.repartition("key").sortWithinPartitions("key").mapInArrow(run, ", ".join(f"{n} long" for n in names))


# --- Blocks ------------------------------------------------------------------

@dataclass
class Members:
    """The vectors of a block: numbers, how many rows each stands for, codes, unit vectors, components so far."""

    rid: np.ndarray
    times: np.ndarray
    words: np.ndarray
    unit: np.ndarray
    label: np.ndarray


class Labels:
    """Components as a forest; the least number is the root."""

    def __init__(self) -> None:
        self.up: dict[int, int] = {}

    def root(self, x: int) -> int:
        while (y := self.up.get(x, x)) != x:
            self.up[x] = self.up.get(y, y)
            x = y
        return x

    def join(self, x: int, y: int) -> bool:
        x, y = self.root(x), self.root(y)
        if x == y:
            return False
        self.up[max(x, y)] = min(x, y)
        return True


def linked(a: Members, b: Members, table: int, codes: Codes | None, threshold: float) -> np.ndarray:
    """Which vectors of two blocks link and meet first in this table (without codes: any that link)."""
    near = a.unit @ b.unit.T >= threshold
    near &= a.rid[:, None] != b.rid[None, :]
    if codes is not None:
        i, j = np.nonzero(near)
        near[i, j] = codes.meet_first(a.words[i], b.words[j], np.full(len(i), table))
    return near


def _joining(near: np.ndarray, a: np.ndarray, b: np.ndarray, labels: Labels) -> list[tuple[int, int]]:
    """Pairs of components, by their labels, that the links join and that were apart before."""
    i, j = np.nonzero(near)
    pairs = np.unique(np.stack([a[i], b[j]], axis=1), axis=0)
    return [(x, y) for x, y in pairs.tolist() if labels.join(x, y)]


_FOUND = "rid long, links long, other long"
_PACKED = ("rid", "times", "words", "unit", "label")


def _blocks(members: DataFrame, codes: Codes | None, width: int, threshold: float) -> DataFrame:
    """One row for each block (key, mine): links and components inside, and for keys of several blocks all of its members."""
    words = _word_columns(codes.words if codes else 0)

    def packed(head: tuple, rows: list[np.ndarray], units: list[np.ndarray]) -> pa.RecordBatch:
        key, mine, blocks = head
        ints, unit = np.concatenate(rows), np.concatenate(units)
        rid = np.ascontiguousarray(ints[:, 3])
        m = Members(rid, ints[:, 4], np.ascontiguousarray(ints[:, 5:]).view(U), unit, rid)
        near = linked(m, m, key >> 32, codes, threshold)
        labels = Labels()
        _joining(np.triu(near), rid, rid, labels)
        m.label = np.array([labels.root(x) for x in rid.tolist()], dtype=np.int64)
        blob = lambda x: np.ascontiguousarray(x).tobytes()
        more = [blob(m.rid), blob(near @ m.times), blob(m.label), *((blob(m.times), blob(m.words), blob(m.unit)) if blocks > 1 else (b"",) * 3)]
        return pa.RecordBatch.from_arrays([*(pa.array([x]) for x in (key, mine, blocks)), *(pa.array([x], pa.binary()) for x in more)], ["key", "mine", "blocks", "rid", "links", "label", "times", "words", "unit"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        head, rows, units = None, [], []
        for batch in batches:
            ints = np.stack([c.to_numpy() for c in batch.columns[:-1]], axis=1)
            unit = unit_rows(_matrix(batch.column(batch.num_columns - 1), width))
            cuts = [0, *(np.flatnonzero((ints[1:, :2] != ints[:-1, :2]).any(axis=1)) + 1).tolist(), len(ints)]
            for a, b in zip(cuts, cuts[1:]):
                now = tuple(ints[a, :3].tolist()) if b > a else head
                if now != head and rows:
                    yield packed(head, rows, units)
                    rows, units = [], []
                head = now
                rows.append(ints[a:b])
                units.append(unit[a:b])
        if rows:
            yield packed(head, rows, units)

    dealt = members.repartition("key", "mine").sortWithinPartitions("key", "mine")
    wide = dealt.select("key", "mine", "blocks", "rid", "times", *words, "vector")
    return wide.mapInArrow(run, "key long, mine long, blocks long, rid binary, links binary, label binary, times binary, words binary, unit binary")


def _unpacked(blocks: DataFrame) -> DataFrame:
    """Links and components inside of blocks, a row for each vector that has some."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            parts = [np.concatenate([np.frombuffer(x, np.int64) for x in batch.column(c).to_pylist()] or [np.zeros(0, np.int64)]) for c in ("rid", "links", "label")]
            some = parts[1] > 0
            yield pa.RecordBatch.from_arrays([pa.array(p[some]) for p in parts], ["rid", "links", "other"])

    return blocks.select("rid", "links", "label").mapInArrow(run, _FOUND)


def _between(blocks: DataFrame, codes: Codes | None, width: int, threshold: float) -> DataFrame:
    """Links between blocks: counts for the vectors of each block, and links that join components."""
    words = codes.words if codes else 0

    def members(row: dict) -> Members:
        rid, times, label = (np.frombuffer(row[c], np.int64) for c in ("rid", "times", "label"))
        return Members(rid, times, np.frombuffer(row["words"], U).reshape(len(rid), words), np.frombuffer(row["unit"], np.float64).reshape(len(rid), width), label)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        head, own, links, joins, labels = None, None, None, [], Labels()

        def out() -> Iterator[pa.RecordBatch]:
            if own is not None:
                ends = np.array(joins, dtype=np.int64).reshape(-1, 2)
                columns = np.r_[own.rid, ends[:, 0]], np.r_[links, np.zeros(len(ends), np.int64)], np.r_[own.rid, ends[:, 1]]
                yield pa.RecordBatch.from_arrays([pa.array(c) for c in columns], ["rid", "links", "other"])

        for batch in batches:
            for row in batch.to_pylist():
                if head != (row["key"], row["lo"]):
                    yield from out()
                    head, own, joins, labels = (row["key"], row["lo"]), members(row), [], Labels()
                    links = np.zeros(len(own.rid), dtype=np.int64)
                    continue  # a block comes before its partners
                other = members(row)
                near = linked(own, other, head[0] >> 32, codes, threshold)
                links += near @ other.times
                if row["lo"] < row["mine"]:
                    joins += _joining(near, own.label, other.label, labels)
        yield from out()

    partners = blocks.where("blocks > 1").withColumn("lo", F.explode(F.sequence(F.lit(0).cast("long"), F.col("blocks") - 1)))
    dealt = partners.withColumn("later", F.col("lo") != F.col("mine")).repartition("key", "lo").sortWithinPartitions("key", "lo", "later", "mine")
    return dealt.select("key", "lo", "mine", *_PACKED).mapInArrow(run, _FOUND)


def _compared(entries: DataFrame, vectors: DataFrame, codes: Codes | None, width: int, threshold: float) -> DataFrame:
    """Columns rid, links, other for entries (key, rid[, words]): parts of the number of links, and links that make components."""
    blocks = F.ceil(F.count("*") / BLOCK).cast("long").alias("blocks")
    sizes = stored(entries.groupBy("key").agg(blocks, F.count("*").alias("_n")), "sizes")
    dealt = spread_join(entries, sizes, ["key"], ["rid"])
    members = dealt.withColumn("mine", F.pmod(F.xxhash64(F.lit(3), "rid"), F.col("blocks"))).join(vectors.select("rid", "vector", F.col("times").cast("long").alias("times")), "rid")
    packed = stored(_blocks(members, codes, width, threshold), "blocks")
    return stored(_unpacked(packed).unionByName(_between(packed, codes, width, threshold)), "found")


def _of_width(vectors: DataFrame, width: int, threshold: float, exact: bool) -> DataFrame:
    total = vectors.count()
    if exact or total < 2:
        return _compared(vectors.select(F.lit(0).cast("long").alias("key"), "rid"), vectors, None, width, threshold)
    sample = vectors.orderBy(F.xxhash64(F.lit(5), "rid"), "rid").limit(SAMPLE_ROWS).select("vector").collect()
    codes = fit_codes(np.array([r["vector"] for r in sample], dtype=np.float64), total, threshold)
    met = stored(_met(_entries(vectors, codes, width), codes), "met")
    return _compared(met, vectors, codes, width, threshold)


def embedding_near_dedup(embeddings: DataFrame, threshold: float = 0.95, id_column: str = "vec_id", vector_column: str = "embedding", exact: bool = False) -> DataFrame:
    """For each vector: number of linked vectors, smallest id of its component, whether it is that one."""
    raw = F.col(vector_column).cast("array<double>")
    scale = F.aggregate(raw, F.lit(0.0), lambda a, x: F.greatest(a, F.abs(x)))
    bad = F.exists(raw, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    usable = raw.isNotNull() & (F.size(raw) > 0) & ~F.coalesce(bad, F.lit(True)) & (scale > 0)
    with scratch(embeddings.sparkSession), small_batches(embeddings.sparkSession):
        rows = embeddings.select(F.col(id_column).alias("id"), F.when(usable, F.transform(raw, lambda x: x / scale + F.lit(0.0))).alias("vector"))
        named = {"one": F.xxhash64("vector"), "two": F.xxhash64(F.lit(1), "vector")}
        rows = stored(rows.withColumns({k: F.when(F.col("vector").isNotNull(), v) for k, v in named.items()}), "rows")
        vectors = rows.where("one is not null").groupBy("one", "two").agg(F.count("*").alias("times"), F.first("vector").alias("vector"), F.min("id").alias("least"))
        vectors = stored(vectors.withColumn("rid", F.monotonically_increasing_id()), "vectors")  # fixed once it is written
        widths = [r[0] for r in vectors.select(F.size("vector").alias("n")).distinct().collect()]
        found = vectors.select("rid", F.lit(0).cast("long").alias("links"), F.col("rid").alias("other")).limit(0)
        for n in widths:
            found = found.unionByName(_of_width(vectors.where(F.size("vector") == n), n, threshold, exact))
        found = stored(found, "found")
        counts = found.groupBy("rid").agg(F.sum("links").alias("links"))
        labels = components(found, "rid", "other").withColumnRenamed("node", "rid")
        whole = vectors.select("one", "two", "rid", "times", "least").join(counts, "rid", "left").join(labels, "rid", "left")
        whole = stored(whole.withColumn("component", F.coalesce("component", "rid")), "labelled")
        least = stored(whole.groupBy("component").agg(F.min("least").alias("name"), F.count("*").alias("_n")), "least")
        of_vector = spread_join(whole.withColumnRenamed("times", "copies"), least, ["component"], ["rid"])
        links = (F.coalesce("links", F.lit(0)) + F.col("copies") - 1).cast("long").alias("links")
        of_vector = stored(of_vector.select("one", "two", links, "name", F.col("copies").alias("_n")), "named")
        out = spread_join(rows.where("one is not null").select("id", "one", "two"), of_vector, ["one", "two"], ["id"]).select("id", "links", "name")
        out = out.unionByName(rows.where("one is null").select("id", F.lit(0).cast("long").alias("links"), F.col("id").alias("name")))
        out = out.select(F.col("id").alias(id_column), F.col("links").alias("n_links"), F.col("name").alias("component_id"), F.coalesce(F.col("id") == F.col("name"), F.lit(False)).alias("kept"))
        return stored(out, "components", keep=True)
