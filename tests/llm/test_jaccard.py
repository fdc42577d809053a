import random

import numpy as np
import pyarrow as pa

from arealis.llm.graph import components, merged
from arealis.llm.jaccard import (
    CHUNK, _covers, _flush, _packed, _powers, _unpacked, contested, jaccard_components, joining_links, most_different, one_of_each, shingle_sets, signatures, sketch, sketch_difference, word_hashes,
)


def shingles(text):
    words = [w for w in "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "").replace("\t", " ").replace("\n", " ").split(" ") if w]
    return {tuple(words)} - {()} if len(words) < 5 else {tuple(words[i : i + 5]) for i in range(len(words) - 4)}


def brute_force(rows):
    known = {}  # numbers of shingles: tuples would be hashed again and again
    sets = [(i, {known.setdefault(x, len(known)) for x in shingles(t)}) for i, t in rows]
    root = list(range(len(sets)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for a in range(len(sets)):
        for b in range(a):
            x, y = sets[a][1], sets[b][1]
            if x and y and 100 * len(x & y) >= 80 * len(x | y):
                root[find(a)] = find(b)
    least = {}
    for k, (i, _) in enumerate(sets):
        if i is not None:
            least[find(k)] = min(i, least.get(find(k), i))
    return {i: (len(s), least.get(find(k), i)) for k, (i, s) in enumerate(sets) if i is not None}


def corpus(seed=5):
    rng = random.Random(seed)
    vocabulary = [f"w{k}" for k in range(400)]
    text = lambda n: [rng.choice(vocabulary) for _ in range(n)]
    passage = text(45)
    docs = [" ".join(text(rng.randint(0, 60))) for _ in range(60)]
    for _ in range(12):  # chains of edits, around the threshold
        words = text(rng.randint(6, 120))
        for _ in range(6):
            docs.append(" ".join(words))
            for _ in range(rng.randint(1, 3)):
                words[rng.randrange(len(words))] = rng.choice(vocabulary)
    base = text(80)
    for _ in range(40):  # many near copies of one text
        words = list(base)
        words[rng.randrange(80)] = rng.choice(vocabulary)
        docs.append(" ".join(words))
    docs += [" ".join(text(rng.randint(2, 12)) + passage + text(rng.randint(2, 12))) for _ in range(60)]  # one common passage
    docs += ["a b c", "A  b\tC", "a b", "", " \n", docs[3], docs[3], "x " * 500]
    rng.shuffle(docs)
    return [(k * 7 % 1009, t) for k, t in enumerate(docs)]


def test_same_as_brute_force(spark):
    rows = [*corpus(), (5000, None), (None, "a b c"), (None, None)]
    got = jaccard_components(spark.createDataFrame([(*r, "x") for r in rows], "doc_id long, text string, n string"))
    assert got.columns == ["doc_id", "n_shingles", "component_id"]
    got = got.collect()
    want = brute_force(rows)
    assert len(got) == len(rows)
    assert {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in got if r["doc_id"] is not None} == want
    assert sorted(r["component_id"] is None for r in got if r["doc_id"] is None) == [False, True]
    kept = one_of_each(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    nonempty = {c for i, (n, c) in want.items() if n}
    assert {r["doc_id"] for r in kept if (r["text"] or "").strip()} == nonempty and len([r for r in kept if (r["text"] or "").strip()]) == len(nonempty)


def test_large_groups_of_near_copies(spark):
    """Hundreds of long copies with random edits: stars, covers and several blocks; some link, some only over others."""
    rng = random.Random(8)
    vocabulary = [f"v{k}" for k in range(3000)]
    base = [rng.choice(vocabulary) for _ in range(1600)]
    rows = []
    for k in range(420):
        words = list(base)
        for _ in range(rng.choice([5, 20, 30, 40, 60, 80])):
            words[rng.randrange(len(words))] = rng.choice(vocabulary)
        rows.append((k, " ".join(words)))
    rows += [(1000 + k, rows[0][1]) for k in range(40)]
    rows += [(2000 + k, " ".join(base[:60] + [rng.choice(vocabulary) for _ in range(60)])) for k in range(60)]
    got = {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in jaccard_components(spark.createDataFrame(rows, "doc_id long, text string").repartition(3)).collect()}
    assert got == brute_force(rows)
    assert 3 < len({c for _, c in got.values()} - {i for i, _ in rows if i >= 2000}) < 400


def test_links_between_blocks():
    rng = np.random.default_rng(2)
    base = rng.integers(0, 1 << 64, 300, dtype=np.uint64)
    rows = []
    for k in range(80):
        lost = int(rng.integers(0, 60))
        s = np.unique(np.r_[rng.permutation(base)[lost:], rng.integers(0, 1 << 64, lost, dtype=np.uint64)])
        rows.append((k, k - k % 2, s.tobytes()))
    linked = lambda a, b: (both := len(np.intersect1d(np.frombuffer(a, np.uint64), np.frombuffer(b, np.uint64)))) * 100 >= 80 * ((len(a) + len(b)) // 8 - both)

    def parts(links):
        label = {k: c for k, c, _ in rows}
        while any(label[a] != label[b] for a, b in links):
            for a, b in links:
                label = {k: min(label[a], label[b]) if c in (label[a], label[b]) else c for k, c in label.items()}
        return label

    every = [(a, b) for a, _, x in rows for b, _, y in rows if a < b and linked(x, y)]
    got = joining_links(rows[:40], None) + joining_links(rows[40:], None) + joining_links(rows[:40], rows[40:])
    assert set(got) <= set(every) and parts(got) == parts(every) and len(set(parts(every).values())) > 1


def test_members_that_may_link_with_another_component():
    rng = np.random.default_rng(3)
    base, sets = rng.integers(0, 1 << 64, 300, dtype=np.uint64), []
    for k in range(200):
        own = [base, rng.integers(0, 1 << 64, 300, dtype=np.uint64)][k % 2]
        lost = int(rng.integers(0, 60))
        sets.append(np.unique(np.r_[rng.permutation(own)[lost:], rng.integers(0, 1 << 64, int(rng.integers(0, lost + 1)), dtype=np.uint64)]))
    n, component = np.array([len(s) for s in sets]), np.arange(200) // 4
    got = contested(n, component, [sketch(s) for s in sets])
    near = lambda a, b: (both := len(np.intersect1d(a, b))) * 100 >= 80 * (len(a) + len(b) - both)
    must = [any(component[i] != component[j] and near(sets[i], sets[j]) for j in range(200)) for i in range(200)]
    assert len({len(sketch(s)) for s in sets}) > 1 and sum(must) > 50
    assert got[must].all() and got.sum() <= 110  # the sets without any near copy are left out


def test_signatures_take_few_bytes_whatever_the_ranges():
    rng = np.random.default_rng(4)
    sets = [np.unique(rng.integers(0, 1 << 64, 500, dtype=np.uint64)) for _ in range(300)]
    sigs = [signatures(s) for s in sets]
    total, n = sum(map(len, sigs)), 0
    for batch in _flush(sigs, np.arange(300) * (1 << 54), 12):
        n += sum(len(x) for c in batch.columns if pa.types.is_binary(c.type) for x in c.to_pylist())
    assert n < 7 * total
    for x, up in ((np.sort(sigs[0] >> np.uint64(16)), True), (np.array([3, 1, 1 << 15], np.uint16), False), (np.array([-5, 7, 1 << 62]).view(np.uint64), True)):
        assert (_unpacked(_packed(x, up), len(x), x.dtype.type, up) == x).all()


def test_members_through_local_stars_are_joined_once(spark):
    pairs = spark.createDataFrame([(1, 2, True, False), (2, 5, False, True), (2, 6, False, True), (3, 4, False, False)], "a long, b long, star boolean, local boolean")
    covers = _covers(pairs)
    assert sorted(map(tuple, covers.collect())) == [(1, 1), (1, 2), (1, 5), (1, 6), (2, 2), (2, 5), (2, 6)]
    assert covers._jdf.queryExecution().optimizedPlan().toString().count("Join Inner") == 1


def test_rows_equal_in_id_and_text(spark):
    words = [f"w{k}" for k in range(40)]
    rows = [(1, " ".join(words))] * 30 + [(2, " ".join(words[:-1]))] * 30
    got = jaccard_components(spark.createDataFrame(rows, "doc_id long, text string").repartition(7)).collect()
    assert sorted(map(tuple, got)) == [(1, 36, 1)] * 30 + [(2, 35, 1)] * 30


def test_empty_table(spark):
    assert jaccard_components(spark.createDataFrame([], "doc_id long, text string")).collect() == []


def test_similar_sets_share_a_signature():
    rng = np.random.default_rng(1)
    for n in [2, 4, 5, 6, 7, 9, 13, 20, 33, 64, 100, 257, 1000, 3000]:
        for _ in range(20):
            base = rng.integers(0, 1 << 64, n, dtype=np.uint64)
            changed = int(rng.integers(0, n // 4 + 1))
            other = np.unique(np.r_[base[changed // 2 :], rng.integers(0, 1 << 64, changed - changed // 2, dtype=np.uint64)])
            base = np.unique(base)
            both = len(np.intersect1d(base, other))
            different = len(base) + len(other) - 2 * both
            assert sketch_difference(sketch(base), sketch(other)) <= different
            if both * 100 >= 80 * (len(base) + len(other) - both) and different:
                assert different <= most_different(len(base), len(other))
                assert len(np.intersect1d(signatures(base), signatures(other)))


def test_words_are_cut_at_the_named_bytes():
    texts = ["a b\tc\x0bd e f", "Éa ÉA x y z", "éa Éa x y z", " ", None, "A B C D E F".lower(), "a b c d e f"]
    sets = list(shingle_sets(pa.array(texts)))
    assert [len(s) for s in sets] == [2, 1, 1, 0, 0, 2, 2]
    assert (sets[0] == sets[5]).all() and sets[1][0] != sets[2][0]


def test_a_long_text_leaves_no_powers_behind():
    def hashes(text):
        return word_hashes(np.frombuffer(text, np.uint8), np.array([0, len(text)]))[0]

    n = CHUNK // 2
    assert len(found := hashes(b"a word " * n)) == 2 * n and set(found.tolist()) == set(hashes(b"word a").tolist())
    assert len(_powers(1)[0]) <= CHUNK + 1


def test_components_after_further_links(spark):
    frame = lambda rows: spark.createDataFrame(rows, "a long, b long")
    first, more = [(5, 6), (6, 7), (8, 9)], [(7, 9), (6, 8), (9, 3), (20, 21), (21, 21)]
    got = {r["node"]: r["component"] for r in merged(components(frame(first)), frame(more)).collect()}
    assert got == {3: 3, 5: 3, 6: 3, 7: 3, 8: 3, 9: 3, 20: 20, 21: 20}
    assert {r["node"]: r["component"] for r in merged(components(frame(first)), frame([])).collect()} == {5: 5, 6: 5, 7: 5, 8: 8, 9: 8}
