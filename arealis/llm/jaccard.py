"""N-gram Jaccard join by PartEnum signatures, exact for the documents' shingle sets.

Two sets of sizes s <= t are similar (Jaccard >= 0.8) only if t <= 1.25 s, and
then they differ in at most k = s / 4 elements. Sizes fall into bands; for each
band of the smaller size, the domain of shingles is cut into k / 2 + 1
first-level parts, so that in one of them the two sets differ in at most one
element; each is cut into three second-level parts, and all subsets of two of
these are enumerated: one of the subsets holds the same elements of both. Its
elements, hashed with its place, are the signature. (Sets with k below
``LEAST_K`` are too small for this: there are k + 1 single parts.) Parts with few
elements say little; they are signed only by sets with so many of them that a
similar set could agree on no other.

1. One pass makes each document's set size, a 128-bit name of its set and a
   parity sketch, whose differing bits never exceed the sets' difference. Equal
   sets are one node from here on, so copies are never expanded.
2. One pass makes signatures, each set once per task, packed into blobs for the
   shuffle. Small groups of equal signatures give their pairs, large ones a star
   around their least member. Pairs pass the sketch and are verified on the
   sets; links make components.
3. Sets with the same center of a star are a cover. Covers that still hold
   several components are dealt into blocks of bounded size; a task compares the
   sketches of a block as a matrix product, first the short ones of all members,
   then those made from the sets that may still link, and verifies the closest
   pairs first, until its components are one. Covers of several blocks that are open after
   this have each block packed into one row, and each two blocks compared.

A signature with very many sets is met by its local least members: each map
task hands on one set and a star, so no task holds such a group. Nothing is
capped or sampled.

Defined results: a null, empty or blank text has an empty set, links with
nothing and is its own component; fewer words than a shingle are one shingle;
rows equal in set are linked; rows with the same id and other texts are
documents of their own. A null id never names a component unless the component
has no other. Columns beyond id and text are not read. Words and shingles are
64-bit hashes: two shingles of a pair of sets with 10,000 elements each are
taken for one with a probability of 1e-11.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from arealis.llm.common import giving_back, may_match, small_batches, spread_join
from arealis.llm.graph import components, merged
from arealis.scratch import release, scratch, stored

WORDS, NUMERATOR, DENOMINATOR = 5, 80, 100
#: Least k for subsets of parts; sets of a group whose pairs are listed.
LEAST_K, SMALL = 8, 16
#: Sets and bytes of sets in a block, and sets of one that are compared with the other in one step.
BLOCK, BLOCK_BYTES, STRIP = 1024, 4_000_000, 128
#: Bytes of text looked at together, signatures in one step, and rows of one batch.
CHUNK, STEP, ROWS = 500_000, 1_000_000, 200
#: Sets in one step: a place among them and a mark fit into two bytes.
STEP_SETS = 1 << 15

U = np.uint64


def mix(x: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser: every input bit reaches every output bit."""
    x = x ^ (x >> U(30))
    x = x * U(0xBF58476D1CE4E5B9)
    x = x ^ (x >> U(27))
    x = x * U(0x94D049BB133111EB)
    return x ^ (x >> U(31))


@lru_cache(maxsize=1)
def _byte_tables() -> tuple[np.ndarray, np.ndarray]:
    """A random number for each byte, with A-Z like a-z; and which bytes are no white space."""
    lower = np.arange(256)
    lower[65:91] += 32
    values = mix(lower.astype(U) * U(0x9E3779B97F4A7C15) + U(1))
    word = np.ones(256, dtype=bool)
    word[[32, *range(9, 14)]] = False
    return values, word


def _made_powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    base = 0x9E3779B97F4A7C15 | 1
    up, down = (np.full(n, x, dtype=U) for x in (base, pow(base, -1, 1 << 64)))
    up[0] = down[0] = 1
    return np.cumprod(up, dtype=U), np.cumprod(down, dtype=U)


_kept_powers = lru_cache(maxsize=1)(_made_powers)


def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of an odd number and of its inverse, modulo 2 ** 64; those that only a longer text needs are not kept."""
    return _kept_powers(CHUNK + 1) if n <= CHUNK + 1 else _made_powers(n)


def word_hashes(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Hash and document number of each word in UTF-8 texts that lie one after the other."""
    values, is_word = _byte_tables()
    n = len(data)
    if not n:
        return np.zeros(0, U), np.zeros(0, np.int64)
    word = is_word[data]
    cuts = offsets[(offsets > 0) & (offsets < n)]
    before = np.r_[False, word[:-1]]
    before[cuts] = False
    after = np.r_[word[1:], False]
    after[cuts - 1] = False
    starts, ends = np.flatnonzero(word & ~before), np.flatnonzero(word & ~after)
    up, down = _powers(n + 1)
    sums = np.r_[U(0), np.cumsum(values[data] * up[:n], dtype=U)]
    hashes = mix((sums[ends + 1] - sums[starts]) * down[starts] + (ends - starts + 1).astype(U))
    return hashes, np.searchsorted(offsets, starts, side="right") - 1


def shingle_sets(texts: pa.Array) -> Iterator[np.ndarray]:
    """The sorted distinct shingle hashes of each text."""
    texts = texts.cast(pa.large_string()).fill_null("")
    offsets = np.frombuffer(texts.buffers()[1], dtype=np.int64)[texts.offset : texts.offset + len(texts) + 1]
    raw = np.frombuffer(texts.buffers()[2] or b"", dtype=np.uint8)
    factors = mix(np.arange(1, WORDS + 1).astype(U))
    first = 0
    while first < len(texts):
        last = first + 1
        while last < len(texts) and offsets[last + 1] - offsets[first] <= CHUNK:
            last += 1
        at = offsets[first : last + 1]
        hashes, of = word_hashes(raw[at[0] : at[-1]], at - at[0])
        bounds = np.searchsorted(of, np.arange(last - first + 1))
        n = max(0, len(hashes) - WORDS + 1)
        rolled = np.zeros(n, dtype=U)
        for j in range(WORDS):
            rolled += hashes[j : j + n] * factors[j]
        rolled = mix(rolled)
        for a, b in zip(bounds[:-1], bounds[1:]):
            if b - a >= WORDS:
                yield np.unique(rolled[a : b - WORDS + 1])
            elif b > a:
                yield mix((hashes[a:b] * factors[: b - a]).sum(dtype=U, keepdims=True) + U(b - a))
            else:
                yield np.zeros(0, dtype=U)
        first = last


def fingerprint(s: np.ndarray) -> tuple[int, int]:
    """A name of a set of 128 bits: two independent sums over its elements, with its size."""
    sums = [mix(s ^ U(c)).sum(dtype=U) for c in (0x5851F42D4C957F2D, 0xD1342543DE82EF95)]
    one, two = mix(np.array(sums, dtype=U) + U(len(s)) * U(0x9E3779B97F4A7C15)).view(np.int64).tolist()
    return one, two


def sketch(s: np.ndarray) -> bytes:
    """Parities of 2 ** b buckets of elements, at least two for each."""
    bits = max(6, (2 * len(s) - 1).bit_length())
    parity = np.bincount((s >> U(64 - bits)).astype(np.int64), minlength=1 << bits) & 1
    return np.packbits(parity.astype(np.uint8), bitorder="little").tobytes()


def sketch_difference(a: bytes, b: bytes) -> int:
    """Differing bits; the longer sketch is folded to the shorter one's buckets."""
    x, y = (np.unpackbits(np.frombuffer(v, np.uint8), bitorder="little") for v in sorted((a, b), key=len))
    y = np.bitwise_xor.reduce(y.reshape(len(x), -1), axis=1)
    return int((x != y).sum())


def most_different(n: np.ndarray | int, m: np.ndarray | int):
    """The largest symmetric difference of similar sets of these sizes."""
    return (n + m) * (DENOMINATOR - NUMERATOR) // (DENOMINATOR + NUMERATOR)


@lru_cache(maxsize=1)
def bands() -> list[int]:
    """The first size of each band; four fifths of a size are in its band or the one before."""
    out = [1]
    while out[-1] < 1 << 40:
        out.append(out[-1] * 5 // 4 + 1)
    return out


@lru_cache(maxsize=None)
def parts_of_band(i: int) -> tuple[int, int, np.ndarray]:
    """For pairs whose smaller set is in band i: first-level parts (0 if only equal sets are similar), how many of these
    may be unusable, and the subsets of second-level parts as columns."""
    largest = bands()[i + 1] - 1
    k = int(most_different(largest, largest * DENOMINATOR // NUMERATOR))
    if not k:
        return 0, 0, np.zeros((1, 1), dtype=U)
    if k < LEAST_K:
        return k + 4, 3, np.ones((1, 1), dtype=U)
    spare = 2 + k * 3 // 100
    return k // 2 + 1 + spare, spare, np.ones((3, 3), dtype=U) - np.eye(3, dtype=U)


def signatures(s: np.ndarray) -> np.ndarray:
    """All signatures of a sorted set, for its own band and the one of smaller similar sets."""
    n = len(s)
    if not n:
        return s
    low, high = np.searchsorted(bands(), [-(-n * NUMERATOR // DENOMINATOR), n], side="right") - 1
    values = mix(s + U(0x2545F4914F6CDD1D))
    out = []
    for i in range(low, high + 1):
        first, spare, subsets = parts_of_band(i)
        if not first:
            continue
        second = len(subsets)
        cell = ((s >> U(32)) * U(first * second)) >> U(32)
        starts = np.flatnonzero(np.r_[True, cell[1:] != cell[:-1]])
        sums, used = np.zeros((2, first * second), dtype=U)
        sums[cell[starts].astype(np.int64)] = np.add.reduceat(values, starts)
        used[cell[starts].astype(np.int64)] = 1
        held = sums.reshape(first, second) @ subsets
        filled = used.reshape(first, second) @ subsets > 0
        place = np.arange(held.size, dtype=U).reshape(held.shape) + (U(i) << U(42))
        made = mix(held + mix(place + U(1)))
        usable = int(filled.all(axis=1).sum())
        # A similar set agrees on at least spare + 1 first-level parts; one of them is usable, or all must be signed.
        out.append(made[filled] if first - usable <= spare else made.ravel())
    return np.concatenate(out) if out else np.zeros(0, dtype=U)


def _sets(docs: DataFrame) -> DataFrame:
    kind = dict(docs.dtypes)["id"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            one, two, n, sketches = [], [], [], []
            for s in shingle_sets(batch.column(2)):
                names = fingerprint(s) if len(s) else (None, None)
                one.append(names[0])
                two.append(names[1])
                n.append(len(s))
                sketches.append(sketch(s) if len(s) else None)
            made = [pa.array(one, pa.int64()), pa.array(two, pa.int64()), pa.array(n, pa.int64()), pa.array(sketches, pa.binary())]
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), *made], ["id", "h", "one", "two", "n", "sketch"])

    return docs.mapInArrow(giving_back(run), f"id {kind}, h long, one long, two long, n long, sketch binary")


# --- Signatures to groups ----------------------------------------------------
#
# Here a set is the first half of its name; sets that share it, if there are any, are told apart when pairs are joined
# with the sets. Blobs hold the signatures of one range of a task's sets, six bytes each, with places in a list of
# names; a blob without signatures is a star. A range is what one task reads, as the list is repeated for each; the task
# groups one slice of it after the other.

_LEADS = np.uint16(1 << 15)  # marks a place whose set stands for a star of its task
SLICES = 4
#: Kinds of candidates: a pair, a star around the least of a group, and a star of one map task.
PAIR, STAR, LOCAL = range(3)


def _new(*columns: np.ndarray) -> np.ndarray:
    """Where a row of sorted columns differs from the one before it."""
    out = np.ones(len(columns[0]), dtype=bool)
    if len(out):
        out[1:] = np.logical_or.reduce([c[1:] != c[:-1] for c in columns])
    return out


def _packed(x: np.ndarray, ascending: bool = False) -> bytes:
    """Numbers (or their steps, if they ascend) by place of their bytes, so that equal bytes lie together, compressed."""
    if ascending:
        x = np.diff(x, prepend=x.dtype.type(0))
    return pa.compress(x.view(np.uint8).reshape(-1, x.itemsize).T.tobytes(), codec="zstd", asbytes=True)


def _unpacked(raw: bytes, n: int, kind: type, ascending: bool = False) -> np.ndarray:
    width = np.dtype(kind).itemsize
    planes = np.frombuffer(pa.decompress(raw, n * width, codec="zstd", asbytes=True), np.uint8).reshape(width, n)
    x = np.ascontiguousarray(planes.T).view(kind).reshape(n)
    return np.cumsum(x, dtype=kind) if ascending else x


def _range(sigs: np.ndarray, ranges: int) -> np.ndarray:
    return ((sigs >> U(32)) * U(ranges) >> U(32)).astype(np.int64)


def _flush(sigs: list[np.ndarray], names: np.ndarray, parts: int) -> Iterator[pa.RecordBatch]:
    by_name = np.argsort(names)
    names, place = names[by_name], np.empty(len(by_name), dtype=np.uint16)
    place[by_name] = np.arange(len(by_name), dtype=np.uint16)
    sig, of = np.concatenate(sigs), np.repeat(place, [len(x) for x in sigs])
    order = np.lexsort((of, sig))
    sig, of = sig[order], of[order]
    starts = np.flatnonzero(_new(sig))
    sizes = np.diff(np.r_[starts, len(sig)])
    first = np.zeros(len(sig), dtype=bool)
    first[starts] = True
    hot = np.repeat(sizes > SMALL, sizes)
    follows = hot & ~first
    stars = np.unique(np.stack([np.repeat(of[starts], sizes)[follows], of[follows]], axis=1), axis=0)
    entry, sig = np.where(hot, of | _LEADS, of)[~follows], sig[~follows]
    rows = []

    def blob(part: int, sigs: bytes, at: np.ndarray, marks: np.ndarray) -> None:
        used, local = np.unique(at, return_inverse=True)
        places = local.astype(np.uint16).reshape(-1) | marks
        rows.append((part, len(places), len(used), sigs, _packed(places), _packed(names[used].view(U), True)))

    cuts = np.searchsorted(_range(sig, parts), np.arange(parts + 1))
    for p in np.flatnonzero(cuts[1:] > cuts[:-1]):
        mine = entry[cuts[p] : cuts[p + 1]]
        blob(int(p), _packed(sig[cuts[p] : cuts[p + 1]] >> U(16), True), mine & ~_LEADS, mine & _LEADS)
    part = (mix(names[stars[:, 0]].view(U)) % U(parts)).astype(np.int64)
    for p in np.unique(part):
        blob(int(p), b"", stars[part == p], np.uint16(0))
    for k in range(0, len(rows), ROWS):
        columns = list(zip(*rows[k : k + ROWS]))
        made = [pa.array(c, pa.int32()) for c in columns[:3]] + [pa.array(c, pa.binary()) for c in columns[3:]]
        yield pa.RecordBatch.from_arrays(made, ["part", "n", "k", "sigs", "at", "names"])


def _signed(docs: DataFrame, parts: int) -> DataFrame:
    """Blobs of the signatures of all texts, each set once in a task, for each of ``parts`` ranges of signatures."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: set[int] = set()
        sigs, names, size = [], [], 0
        for batch in batches:
            for s in shingle_sets(batch.column(0)):
                if not len(s) or (name := fingerprint(s)[0]) in seen:
                    continue
                seen.add(name)
                made = signatures(s)
                if len(made):
                    sigs.append(made)
                    names.append(name)
                    size += len(made)
                if size > STEP or len(names) == STEP_SETS:
                    yield from _flush(sigs, np.array(names, dtype=np.int64), parts)
                    sigs, names, size = [], [], 0
        if sigs:
            yield from _flush(sigs, np.array(names, dtype=np.int64), parts)

    return docs.select("text").mapInArrow(giving_back(run), "part int, n int, k int, sigs binary, at binary, names binary")


def _group(sig: np.ndarray, names: np.ndarray, leads: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Pairs and stars of the groups of equal signatures, as rows (a, b)."""
    order = np.lexsort((names, sig))
    sig, names, leads = sig[order], names[order], leads[order]
    runs = np.flatnonzero(_new(sig, names))
    leads = np.logical_or.reduceat(leads, runs)
    sig, names = sig[runs], names[runs]
    starts = np.flatnonzero(_new(sig))
    sizes = np.diff(np.r_[starts, len(sig)])
    leading = np.logical_or.reduceat(leads, starts)
    key = np.add.reduceat(mix(names.view(U)), starts) + sizes.astype(U) + leading.astype(U) * U(1 << 40)
    keep = np.zeros(len(starts), dtype=bool)
    keep[np.unique(key, return_index=True)[1]] = True  # equal groups say the same
    keep &= sizes > 1
    listed = np.repeat(keep & ~leading & (sizes <= SMALL), sizes)
    group = np.repeat(np.arange(len(starts)), sizes)[listed]
    x, pairs = names[listed], [np.zeros((0, 2), np.int64)]
    for d in range(1, SMALL):
        same = (group[d:] == group[:-d]) if d < len(group) else np.zeros(0, dtype=bool)
        if not same.any():
            break
        pairs.append(np.stack([x[:-d][same], x[d:][same]], axis=1))
    starred = np.repeat(keep & (leading | (sizes > SMALL)), sizes)
    starred[starts] = False
    center = np.repeat(names[starts], sizes)
    return np.unique(np.concatenate(pairs), axis=0), np.unique(np.stack([center[starred], names[starred]], axis=1), axis=0)


def _candidates(blobs: DataFrame, parts: int) -> DataFrame:
    """Rows (kind, a, b) of all groups of equal signatures."""

    def rows(kind: int, found: np.ndarray) -> Iterator[pa.RecordBatch]:
        for k in range(0, len(found), 50_000):
            some = found[k : k + 50_000]
            yield pa.RecordBatch.from_arrays([pa.array(np.full(len(some), kind, np.int32)), pa.array(some[:, 0]), pa.array(some[:, 1])], ["kind", "a", "b"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]] = []
        for batch in batches:
            for part, n, k, sigs, at, names in zip(*(c.to_pylist() for c in batch.columns)):
                at, names = _unpacked(at, n, np.uint16), _unpacked(names, k, U, True).view(np.int64)
                if sigs:
                    sig = _unpacked(sigs, n, U, True) << U(16)
                    held.append((sig, at, names, np.searchsorted(_range(sig, parts * SLICES), part * SLICES + np.arange(SLICES + 1))))
                else:
                    yield from rows(LOCAL, names[at].reshape(-1, 2))
        for k in range(SLICES if held else 0):
            slices = [(sig[c[k] : c[k + 1]], at[c[k] : c[k + 1]], names) for sig, at, names, c in held]
            sig, names, leads = (np.concatenate(x) for x in zip(*((sig, names[at & ~_LEADS], at >= _LEADS) for sig, at, names in slices)))
            if len(sig):
                pairs, stars = _group(sig, names, leads)
                yield from rows(PAIR, pairs)
                yield from rows(STAR, stars)

    return blobs.repartitionById(parts, F.col("part")).mapInArrow(giving_back(run), "kind int, a long, b long")


# --- Pairs to links ----------------------------------------------------------

def _near(pairs: DataFrame) -> DataFrame:
    """Adds near: the sketches x and y of sets with n and m elements do not exclude a link."""
    names = ["a", "b", "star", "local"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            n, m, x, y = (batch.column(c).to_pylist() for c in ("n", "m", "x", "y"))
            most = [most_different(i, j) for i, j in zip(n, m)]
            near = [abs(i - j) <= k and sketch_difference(u, v) <= k for i, j, k, u, v in zip(n, m, most, x, y)]
            yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in names), pa.array(near, pa.bool_())], [*names, "near"])

    return pairs.select(*names, "n", "m", "x", "y").mapInArrow(giving_back(run), "a long, b long, star boolean, local boolean, near boolean")


def _are_linked(u: np.ndarray, v: np.ndarray) -> bool:
    both = len(np.intersect1d(u, v, assume_unique=True))
    return DENOMINATOR * both >= NUMERATOR * (len(u) + len(v) - both)


def _only(arrays: DataFrame, needed: DataFrame) -> DataFrame:
    """The arrays of the needed sets; as a table these are known to be few before anything is shuffled."""
    return arrays.join(stored(needed, "needed"), "sid", "left_semi")


def _verified(pairs: DataFrame, arrays: DataFrame) -> DataFrame:
    """Pairs (a, b) that link, by the sizes of intersection and union."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            a, b, x, y = batch.columns
            chosen = pa.array([_are_linked(np.frombuffer(u, U), np.frombuffer(v, U)) for u, v in zip(x.to_pylist(), y.to_pylist())], pa.bool_())
            yield pa.RecordBatch.from_arrays([a.filter(chosen), b.filter(chosen)], ["a", "b"])

    pairs = stored(pairs, "verified")
    arrays = _only(arrays, _ends(pairs))
    left = arrays.select(F.col("sid").alias("a"), F.col("data").alias("x"))
    right = arrays.select(F.col("sid").alias("b"), F.col("data").alias("y"))
    return pairs.join(left, "a").join(right, "b").select("a", "b", "x", "y").mapInArrow(giving_back(run), "a long, b long")


def _arrays(docs: DataFrame, needed: DataFrame) -> DataFrame:
    """The sets themselves of the needed (sid, rep), from the text of one document each."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: set[int] = set()
        for batch in batches:
            wanted = zip(*(batch.column(c).to_pylist() for c in (1, 2, 3)))
            rows = {sid: s.tobytes() for (sid, *names), s in zip(wanted, shingle_sets(batch.column(0))) if sid not in seen and len(s) and fingerprint(s) == tuple(names)}
            seen.update(rows)
            rows = list(rows.items())
            yield pa.RecordBatch.from_arrays([pa.array([r[0] for r in rows], pa.int64()), pa.array([r[1] for r in rows], pa.binary())], ["sid", "data"])

    named = stored(needed.select(F.col("rep.id").alias("_id"), F.col("rep.h").alias("_h"), "sid", "one", "two"), "named")
    few = may_match(docs, F.xxhash64("id", "h"), named, F.xxhash64("_id", "_h")).where("__may")  # the other texts are not shuffled
    joined = few.join(named, F.col("id").eqNullSafe(F.col("_id")) & (F.col("h") == F.col("_h")))
    arrays = stored(joined.select("text", "sid", "one", "two").mapInArrow(giving_back(run), "sid long, data binary"), "arrays")
    n = arrays.agg(F.count("*").alias("rows"), F.countDistinct("sid").alias("sets")).first()
    # Only rows equal in id and text can meet in several tasks; the sets are not shuffled where there are none.
    return arrays if n["rows"] == n["sets"] else stored(arrays.dropDuplicates(["sid"]), "arrays")


# --- Covers to links ---------------------------------------------------------

def _parities(sets: list[np.ndarray], bits: int) -> np.ndarray:
    out = np.zeros((len(sets), 1 << bits), dtype=np.float32)
    for row, s in zip(out, sets):
        row[:] = np.bincount((s >> U(64 - bits)).astype(np.int64), minlength=1 << bits) & 1
    return out


def joining_links(left: list[tuple[int, int, bytes]], right: list[tuple[int, int, bytes]] | None) -> list[tuple[int, int]]:
    """Links between sets (sid, component, data) of two blocks, or within one, that join their components: for each two
    components with a link, one link or a way over others. The closest pairs of a strip by sketch are verified first."""
    same = right is None
    right = left if same else right
    u, v = ([np.frombuffer(r[2], U) for r in rows] for rows in (left, right))
    bits = max(6, (4 * max(map(len, u + v)) - 1).bit_length())
    q = _parities(v, bits)
    n, m, of_q = np.array([len(s) for s in u]), np.array([len(s) for s in v]), q.sum(axis=1)
    root: dict[int, int] = {}

    def find(x: int) -> int:
        while (y := root.get(x, x)) != x:
            root[x] = root.get(y, y)
            x = y
        return x

    out = []
    for start in range(0, len(u), STRIP):
        part = slice(start, start + STRIP)
        p = q[part] if same else _parities(u[part], bits)
        most = most_different(n[part, None], m[None, :])
        slack = most - (p.sum(axis=1)[:, None] + of_q[None, :] - 2 * (p @ q.T))
        roots = [np.array([find(r[1]) for r in rows]) for rows in (left[part], right)]
        near = (slack >= 0) & (abs(n[part, None] - m[None, :]) <= most) & (roots[0][:, None] != roots[1][None, :])
        if same:
            near &= np.arange(start, start + len(p))[:, None] < np.arange(len(v))[None, :]
        i, j = np.nonzero(near)
        order = np.argsort(-slack[i, j], kind="stable")
        for a, b in zip((i[order] + start).tolist(), j[order].tolist()):
            x, y = find(left[a][1]), find(right[b][1])
            if x != y and _are_linked(u[a], v[b]):
                root[max(x, y)] = min(x, y)
                out.append((left[a][0], right[b][0]))
    return out


def _covers(pairs: DataFrame) -> DataFrame:
    """Columns cover and sid: all sets of groups with the same least member, their local stars included."""
    star, local = pairs.where("star").select("a", "b"), pairs.where("local").select("a", "b")
    through = star.join(local.select(F.col("a").alias("b"), F.col("b").alias("far")), "b").select("a", F.col("far").alias("b"))
    rows = star.unionByName(local)
    return rows.unionByName(rows.select("a", F.col("a").alias("b"))).unionByName(through).distinct().select(F.col("a").alias("cover"), F.col("b").alias("sid"))


def _open(covers: DataFrame, labels: DataFrame, sets: DataFrame) -> DataFrame:
    """Members (cover, sid, component, blocks, mine, n, sketch) of the covers that hold several components, dealt over blocks."""
    members = covers.join(labels.withColumnRenamed("node", "sid"), "sid", "left").withColumn("component", F.coalesce("component", "sid"))
    members = stored(members.join(sets.select("sid", "n", "sketch"), "sid"), "members")
    sizes = members.groupBy("cover").agg(F.min("component").alias("x"), F.max("component").alias("y"), F.count("*").alias("_n"), F.sum("n").alias("elements"))
    blocks = F.ceil(F.greatest(F.col("_n") / BLOCK, F.col("elements") * 8 / BLOCK_BYTES)).cast("int")
    sizes = stored(sizes.where("x <> y").select("cover", "_n", blocks.alias("blocks")), "sizes")
    dealt = spread_join(members, sizes, ["cover"], ["sid"])
    mine = F.pmod(F.xxhash64(F.lit(3), "sid"), F.col("blocks")).cast("int").alias("mine")
    return stored(dealt.select("cover", "sid", "component", "blocks", mine, "n", "sketch"), "open")


def contested(n: np.ndarray, component: np.ndarray, sketches: list[bytes]) -> np.ndarray:
    """Which sets may link with a set of another component, as far as sketches tell; longer ones are folded to the shortest."""
    least = min(map(len, sketches)) * 8
    x = np.zeros((len(sketches), least), dtype=np.float32)
    for row, v in zip(x, sketches):
        row[:] = np.bitwise_xor.reduce(np.unpackbits(np.frombuffer(v, np.uint8), bitorder="little").reshape(least, -1), axis=1)
    total, out = x.sum(axis=1), np.zeros(len(n), dtype=bool)
    for start in range(0, len(n), STRIP):
        part = slice(start, start + STRIP)
        most = most_different(n[part, None], n[None, :])
        near = (total[part, None] + total[None, :] - 2 * (x[part] @ x.T) <= most) & (abs(n[part, None] - n[None, :]) <= most)
        out[part] = (near & (component[part, None] != component[None, :])).any(axis=1)
    return out


def _contested(members: DataFrame) -> DataFrame:
    """The members (cover, mine, sid, component) of a block that may link with one of another component; the sets of the others need not be read."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, rows = None, []

        def flush() -> Iterator[pa.RecordBatch]:
            if len(rows) > 1:
                sid, component, n, sketches = zip(*rows)
                some = np.flatnonzero(contested(np.array(n), np.array(component), list(sketches)))
                columns = [np.full(len(some), now[0]), np.full(len(some), now[1], np.int32), np.array(sid)[some], np.array(component)[some]]
                yield pa.RecordBatch.from_arrays([pa.array(c) for c in columns], ["cover", "mine", "sid", "component"])

        for batch in batches:
            for cover, mine, *row in zip(*(c.to_pylist() for c in batch.columns)):
                if (cover, mine) != now:
                    yield from flush()
                    now, rows = (cover, mine), []
                rows.append(tuple(row))
        yield from flush()

    dealt = members.select("cover", "mine", "sid", "component", "n", "sketch").repartition("cover", "mine").sortWithinPartitions("cover", "mine")
    return stored(dealt.mapInArrow(giving_back(run), "cover long, mine int, sid long, component long"), "contested")


def _within(members: DataFrame, arrays: DataFrame) -> DataFrame:
    """Links (a, b) that join the components of a block."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, rows = None, []

        def flush() -> Iterator[pa.RecordBatch]:
            links = joining_links(rows, None) if len(rows) > 1 else []
            if links:
                yield pa.RecordBatch.from_arrays([pa.array([x[k] for x in links], pa.int64()) for k in (0, 1)], ["a", "b"])

        for batch in batches:
            for cover, mine, *row in zip(*(c.to_pylist() for c in batch.columns)):
                if (cover, mine) != now:
                    yield from flush()
                    now, rows = (cover, mine), []
                rows.append(tuple(row))
        yield from flush()

    dealt = members.join(_only(arrays, members.select("sid").distinct()), "sid").repartition("cover", "mine").sortWithinPartitions("cover", "mine")
    return dealt.select("cover", "mine", "sid", "component", "data").mapInArrow(giving_back(run), "a long, b long")


def _between(members: DataFrame, arrays: DataFrame) -> DataFrame:
    """Links (a, b) that join the components of two blocks of a cover."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for blocks in batch.column(0).to_pylist():
                one, two = ([(r["sid"], r["component"], r["data"]) for r in b["members"]] for b in blocks)
                links = joining_links(one, two)
                yield pa.RecordBatch.from_arrays([pa.array([x[k] for x in links], pa.int64()) for k in (0, 1)], ["a", "b"])

    packed = members.join(arrays, "sid").groupBy("cover", "mine").agg(F.first("blocks").alias("blocks"), F.collect_list(F.struct("sid", "component", "data")).alias("members"))
    other = packed.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1))).where("mine <> other")
    keyed = other.select("cover", F.least("mine", "other").alias("lo"), F.greatest("mine", "other").alias("hi"), F.struct("mine", "members").alias("block"))
    both = keyed.groupBy("cover", "lo", "hi").agg(F.collect_list("block").alias("blocks")).where("size(blocks) = 2")
    return both.select("blocks").mapInArrow(giving_back(run), "a long, b long")


# --- The join ----------------------------------------------------------------

def _ends(pairs: DataFrame) -> DataFrame:
    return pairs.select(F.col("a").alias("sid")).unionByName(pairs.select(F.col("b").alias("sid"))).distinct()


def _pairs(source: DataFrame, sets: DataFrame) -> DataFrame:
    """Candidates (a, b, star, local, near) by set numbers: pairs that the sketches do not exclude, and stars."""
    elements = sets.agg(F.sum("n")).first()[0] or 0
    parts = max(int(source.sparkSession.conf.get("spark.sql.shuffle.partitions")), elements * 2 // (STEP * SLICES), 1)
    found = _candidates(_signed(source, parts), parts)
    found = found.groupBy("a", "b").agg(*(F.max(F.col("kind") == k).alias(name) for k, name in ((STAR, "star"), (LOCAL, "local"))))
    left = sets.select(F.col("one").alias("a"), F.col("sid").alias("i"), "n", F.col("sketch").alias("x"))
    right = sets.select(F.col("one").alias("b"), F.col("sid").alias("j"), F.col("n").alias("m"), F.col("sketch").alias("y"))
    named = found.join(left, "a").join(right, "b").select(F.col("i").alias("a"), F.col("j").alias("b"), "star", "local", "n", "m", "x", "y")
    return stored(_near(named).where("near OR star OR local"), "pairs")


def _apart(pairs: DataFrame, labels: DataFrame) -> DataFrame:
    """Pairs whose ends are not in one component yet."""
    for end in ("a", "b"):
        pairs = pairs.join(labels.select(F.col("node").alias(end), F.col("component").alias(f"_{end}")), end, "left")
    return pairs.where(F.coalesce("_a", "a") != F.coalesce("_b", "b")).select("a", "b")


def similar_sets(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text") -> tuple[DataFrame, DataFrame]:
    """Rows (id, h: hash of the text, one and two: name of the set, n) and sets (one, two, sid, rep, least, component, _n: rows)."""
    spark = docs.sparkSession
    source = docs.select(F.col(id_column).alias("id"), F.xxhash64(text_column).alias("h"), F.col(text_column).alias("text"))
    rows = stored(_sets(source), "sets")
    rep = F.min(F.struct(F.col("id").isNull().alias("unnamed"), "id", "h")).alias("rep")
    sets = rows.where("one is not null").groupBy("one", "two").agg(rep, F.min("id").alias("least"), F.first("n").alias("n"), F.first("sketch").alias("sketch"), F.count("*").alias("_n"))
    sets = stored(sets.withColumn("sid", F.monotonically_increasing_id()), "distinct")  # fixed once it is written

    pairs = _pairs(source, sets)
    release(spark)
    arrays = _arrays(source, sets.join(_ends(pairs), "sid").select("sid", "rep", "one", "two"))
    release(spark)
    near = pairs.where("near").select("a", "b")
    # First a pair for each set, which joins most of what belongs together, then the pairs that are still apart.
    labels = components(stored(_verified(near.groupBy("b").agg(F.min("a").alias("a")).select("a", "b"), arrays), "links"))
    labels = merged(labels, stored(_verified(_apart(near, labels), arrays), "links"))
    release(spark)
    covers = stored(_covers(pairs), "covers")
    members = _open(covers, labels, sets)
    labels = merged(labels, stored(_within(_contested(members), arrays), "links"))
    wide = members.where("blocks > 1").select("cover").distinct()
    if not wide.isEmpty():
        members = _open(covers.join(wide, "cover"), labels, sets)
        labels = merged(labels, stored(_between(members, arrays), "links"))
    release(spark)
    of_sets = sets.join(labels.withColumnRenamed("node", "sid"), "sid", "left").withColumn("component", F.coalesce("component", "sid"))
    return rows, stored(of_sets.select("one", "two", "sid", "rep", "least", "component", "_n"), "labelled")


def jaccard_components(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """For each document its id, set size and the smallest id of its component."""
    with scratch(docs.sparkSession), small_batches(docs.sparkSession):
        rows, sets = similar_sets(docs, id_column, text_column)
        least = stored(sets.groupBy("component").agg(F.min("least").alias("name"), F.count("*").alias("_n")), "least")
        named = stored(spread_join(sets.select("one", "two", "sid", "component", F.col("_n").alias("copies")), least, ["component"], ["sid"]), "named")
        of_set = named.select("one", "two", "name", F.col("copies").alias("_n"))
        linked = spread_join(rows.where("one is not null").select("id", "h", "one", "two", "n"), of_set, ["one", "two"], ["id", "h"])
        alone = rows.where("one is null").select("id", "n", F.col("id").alias("name"))
        out = linked.select("id", "n", "name").unionByName(alone)
        return stored(out.select(F.col("id").alias(id_column), F.col("n").alias("n_shingles"), F.col("name").alias("component_id")), "components", keep=True)


def one_of_each(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """All columns of one document for each component, the first by id (null last) and text hash.

    Documents with empty sets stay. Rows equal in id and text are one document.
    """
    with scratch(docs.sparkSession), small_batches(docs.sparkSession):
        rows, sets = similar_sets(docs, id_column, text_column)
        first = sets.groupBy("component").agg(F.min("rep").alias("rep")).select("rep.id", "rep.h")
        kept = first.unionByName(rows.where("one is null").select("id", "h").distinct())
        kept = stored(kept.select(F.xxhash64("id", "h").alias("__k"), F.col("id").alias("__id"), F.col("h").alias("__h")), "kept", keep=True)
    keyed = docs.withColumn("__t", F.xxhash64(text_column)).withColumn("__k", F.xxhash64(id_column, "__t"))
    chosen = keyed.join(kept.withColumnRenamed("__k", "__k2"), (F.col("__k") == F.col("__k2")) & F.col(id_column).eqNullSafe(F.col("__id")) & (F.col("__t") == F.col("__h")), "left_semi")
    return chosen.dropDuplicates(["__k", id_column, "__t"]).drop("__k", "__t")
