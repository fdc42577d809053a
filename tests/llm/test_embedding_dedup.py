import numpy as np
import pytest

from arealis.llm.embedding_dedup import embedding_near_dedup, fit_codes, unit_rows


def brute_force(x, ids, threshold=0.95):
    u = x / np.linalg.norm(x, axis=1, keepdims=True)
    linked = u @ u.T >= threshold
    np.fill_diagonal(linked, False)
    label = np.array(ids)
    while True:
        low = np.minimum(label, np.array([label[r].min() if r.any() else label[k] for k, r in enumerate(linked)]))
        if (low == label).all():
            return linked.sum(1), label
        label = low


def near(rng, base, cosine):
    """Vectors at this cosine of the unit vectors given."""
    across = rng.normal(size=base.shape)
    across -= (across * base).sum(1, keepdims=True) * base
    return cosine * base + np.sqrt(1 - cosine**2) * unit_rows(across)


def found(spark, x, ids, **options):
    rows = [(i, v.tolist()) for i, v in zip(ids, x)]
    return {r["vec_id"]: r for r in embedding_near_dedup(spark.createDataFrame(rows, "vec_id long, embedding array<double>"), **options).collect()}


@pytest.mark.parametrize("exact", [False, True])
def test_against_brute_force(spark, exact):
    rng = np.random.default_rng(4)
    base = rng.normal(size=(300, 64))
    close = np.concatenate([base[k % 20] + rng.normal(size=64) * s for k, s in enumerate(np.linspace(0.02, 0.16, 120))])
    x = np.concatenate([base, close.reshape(-1, 64), base[:5], base[250] + 0.01 * rng.normal(size=(60, 64))])
    x *= rng.uniform(0.5, 2, size=(len(x), 1))
    ids = list(range(7, 7 + len(x)))
    odd = [(2000, None), (2001, [0.0] * 64), (2002, [float("nan")] * 64), (2003, [None] * 64), (2004, []), (2005, [1.0, 2.0]), (2006, [2.0, 4.0]), (None, [3.0, -1.0])]
    rows = [(i, v.tolist(), 1) for i, v in zip(ids, x)] + [(*r, 0) for r in odd]
    got = embedding_near_dedup(spark.createDataFrame(rows, "vec_id long, embedding array<double>, kept int"), exact=exact)
    assert got.columns == ["vec_id", "n_links", "component_id", "kept"]
    got = {r["vec_id"]: r for r in got.collect()}
    assert len(got) == len(rows)
    n, label = brute_force(x, ids)
    links = np.array([got[i]["n_links"] for i in ids])
    share = 1 if exact else 0.95
    assert (links <= n).all() and links.sum() >= share * n.sum()
    assert sum(got[i]["component_id"] == k for i, k in zip(ids, label)) >= share * len(ids)
    assert all(got[i]["kept"] == (got[i]["component_id"] == i) for i in ids)
    assert all((got[i]["n_links"], got[i]["component_id"]) == (0, i) for i in range(2000, 2005))
    assert (got[2005]["n_links"], got[2006]["component_id"]) == (1, 2005)
    assert got[None]["n_links"] == 0 and not got[None]["kept"]


@pytest.mark.parametrize(("width", "offset"), [(8, 0), (8, 2), (16, 1), (24, 2), (32, 0), (48, 1), (64, 0), (64, 2), (128, 1), (768, 0)])
def test_recall_of_the_index(width, offset):
    """Pairs just above the threshold meet in a table, whatever the width and the mean of the vectors."""
    rng = np.random.default_rng(width + offset)
    x = rng.normal(size=(3000, width)) + offset * rng.choice([-1, 1], size=width)
    codes = fit_codes(x[:2000], 20_000, 0.95)
    base = unit_rows(x[2000:])
    a, b = codes.encode(base), codes.encode(near(rng, base, 0.953))
    seen = (a[0] == b[0]).any(axis=1) & (np.bitwise_count(a[1] ^ b[1]).sum(axis=1) <= codes.most)
    assert seen.mean() >= 0.93


def test_recall_of_the_operator(spark):
    """Narrow vectors with an offset, each with one partner at 0.955."""
    rng = np.random.default_rng(1)
    base = unit_rows(rng.normal(size=(400, 16)) + 1)
    x = np.concatenate([base, near(rng, base, 0.955)])
    got = found(spark, x, range(len(x)))
    n, _ = brute_force(x, range(len(x)))
    links = np.array([got[i]["n_links"] for i in range(len(x))])
    assert (links <= n).all() and links.sum() >= 0.9 * n.sum()


def test_groups_of_several_blocks(spark):
    """A group of near copies over several blocks, some far from each other, a chain, and a vector that is there 900 times."""
    rng = np.random.default_rng(2)
    one = unit_rows(rng.normal(size=(1, 32)))
    group = near(rng, np.repeat(one, 2500, axis=0), 0.985)
    chain = [unit_rows(rng.normal(size=(1, 32)))]
    for _ in range(20):
        chain.append(near(rng, chain[-1], 0.96))
    x = np.concatenate([group, *chain, np.repeat(unit_rows(rng.normal(size=(1, 32))), 900, axis=0), unit_rows(rng.normal(size=(300, 32)))])
    ids = rng.permutation(len(x)).tolist()
    got = found(spark, x, ids)
    n, label = brute_force(x, ids)
    links = np.array([got[i]["n_links"] for i in ids])
    assert (links <= n).all() and links.sum() >= 0.95 * n.sum() and (links[2521:3421] == 899).all()
    assert sum(got[i]["component_id"] == k for i, k in zip(ids, label)) >= 0.99 * len(ids)


def test_empty_table(spark):
    assert embedding_near_dedup(spark.createDataFrame([], "vec_id long, embedding array<float>")).collect() == []
