"""Both classifiers on texts with planted traits."""

import pickle
import random
import tracemalloc
import zlib

import numpy as np
import pytest

from arealis.llm import quality_model
from arealis.llm.quality_model import quality_filter, quality_scores
from arealis.llm.toxicity import TermCache, fit_toxicity, text_terms, toxicity_filter, toxicity_scores


def corpus(n=400):
    rng = random.Random(5)
    words = ["".join(rng.choice(["an", "er", "ti", "on", "re", "st"]) for _ in range(rng.randint(1, 4))) for _ in range(300)] + ["the", "of", "and"] * 20
    rows = []
    for i in range(n):
        text = [rng.choice(words) for _ in range(rng.randint(8, 80))]
        bad, toxic = rng.random() < 0.25, rng.random() < 0.25
        if toxic:
            for w in ("blorg", "znargle"):
                text.insert(rng.randrange(len(text)), w + rng.choice(["", "er", "ing"]))
        if bad:
            text = [w.upper() + "!!" if i % 2 else w + rng.choice(["###", "$$$"]) for w in text]
        rows.append((i, " ".join(text), int(not bad), int(toxic)))
    return rows


def frames(spark, rows):
    docs = spark.createDataFrame([(i, t, "en", 0.5) for i, t, _, _ in rows] + [(9001, "", "en", 0.5), (9002, None, None, None), (None, "the of", "en", 0.5)], "doc_id long, text string, lang string, score double")
    return docs, spark.createDataFrame([(i, q, x) for i, _, q, x in rows] + [(None, 1, 1), (1, None, None)], "doc_id long, quality int, toxic int")


def test_quality(spark):
    rows = corpus()
    docs, labels = frames(spark, rows)
    got = {r["doc_id"]: r for r in quality_scores(docs, labels).collect()}
    assert len(got) == len(rows) + 3 and all(0 <= r["score"] <= 1 and r["predicted"] == int(r["score"] >= 0.7) for r in got.values())
    held = [(got[i]["predicted"], q) for i, _, q, _ in rows if zlib.crc32(str(i).encode()) % 4 == 2]
    assert all(got[i]["held_out"] == (zlib.crc32(str(i).encode()) % 4 == 2) for i, *_ in rows) and not got[None]["held_out"]
    assert sum(p == q for p, q in held) >= 0.95 * len(held)
    kept = quality_filter(docs, labels)
    assert kept.columns == docs.columns and {r["doc_id"] for r in kept.collect()} == {i for i, r in got.items() if r["predicted"]}
    # Labels of the fold that is kept apart change nothing.
    other = labels.selectExpr("doc_id", "CASE WHEN crc32(CAST(doc_id AS STRING)) % 4 = 2 THEN 1 - quality ELSE quality END AS quality")
    assert {r["doc_id"]: r["score"] for r in quality_scores(docs, other).collect()} == {i: r["score"] for i, r in got.items()}


def test_toxicity(spark):
    rows = corpus()
    docs, labels = frames(spark, rows)
    got = {r["doc_id"]: r for r in toxicity_scores(docs, labels).collect()}
    held = [(got[i]["predicted"], x) for i, _, _, x in rows if zlib.crc32(str(i).encode()) % 5 == 0]
    assert all(got[i]["held_out"] == (zlib.crc32(str(i).encode()) % 5 == 0) for i, *_ in rows)
    assert sum(p == x for p, x in held) >= 0.95 * len(held) and got[9001]["predicted"] == got[9002]["predicted"] == 0
    assert {r["doc_id"] for r in toxicity_filter(docs, labels).collect()} == {i for i, r in got.items() if not r["predicted"]}


def test_toxic_only_in_pairs():
    """Words in half of the clean rows, never together there: neither is twice as frequent in toxic rows."""
    rng = random.Random(7)
    words = ["".join(rng.choice("abcdefgh") for _ in range(6)) for _ in range(500)]
    rows = []
    for k in range(1500):
        text = rng.choices(words, k=20)
        text += (["quoral", "zibnet"], ["quoral"], ["zibnet"], ["quoral"], ["zibnet"], ["quoral"], ["zibnet"], ["quoral"])[k % 8]
        rng.shuffle(text)
        rows.append((" ".join(text), int(k % 8 == 0)))
    model = fit_toxicity([(text_terms(t), x) for t, x in rows[:1000]])
    scores = model.scores([t for t, _ in rows[1000:]], TermCache(model.vectors))
    assert [int(s >= 0.5) for s in scores] == [x for _, x in rows[1000:]]


def test_sums_around_words(monkeypatch):
    """As by hand, and without a pattern for words of letters with one mark or digit behind."""
    texts = ["The cat, the dog", "", "a b c d e f the cat, Cat1 the", "the"]
    index, total = quality_model.index_vectors().astype(int), np.zeros((quality_model.BUCKETS, quality_model.DIMENSIONS), int)
    for words in map(str.split, texts):
        for i, w in enumerate(words):
            near = sum(index[list(quality_model.word_buckets(x))].sum(axis=0) for x in words[max(0, i - 2) : i + 3])
            for b in quality_model.word_buckets(w):
                total[b] += near
    monkeypatch.setattr(quality_model, "_CORE", None)
    sums = quality_model.ContextSums()
    sums.add(texts[:3])
    sums.add(texts[3:])
    assert (sums.total == total).all()


def test_memory_of_the_fit():
    """The driver has 1.5 GB for all; the fit takes less than seven times the bytes of its terms."""
    rng = np.random.default_rng(3)
    sample = [(np.unique(rng.integers(0, 1 << 20, 1200, dtype=np.uint32)), int(k % 10 == 0)) for k in range(4000)]
    size = sum(t.nbytes for t, _ in sample)
    tracemalloc.start()
    fit_toxicity((sample.pop() for _ in range(4000)), epochs=1)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert peak < 7 * size


def test_samples_stay_off_the_driver(spark):
    """The driver gets what is fitted: it needs less than a fifth of the bytes of the sample's terms."""
    rng = random.Random(4)
    words = lambda: " ".join("".join(rng.choices("abcdefghijklmnop", k=7)) for _ in range(1500))
    rows = [(k, words()) for k in range(250)]
    size = sum(text_terms(t).nbytes for k, t in rows if zlib.crc32(str(k).encode()) % 5)
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    labels = spark.createDataFrame([(k, 1, 1) for k in range(250)], "doc_id long, quality int, toxic int")
    tracemalloc.start()
    scores = toxicity_scores(docs, labels)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert {r["score"] for r in scores.collect()} == {1.0} and peak < size / 5


def test_a_failed_fit_is_an_error():
    assert pickle.loads(quality_model._in_child(lambda sample: sum(k for _, k in sample), [(b"", 2), (b"", 3)])) == 5
    with pytest.raises(RuntimeError):
        quality_model._in_child(lambda sample: 1 / 0, [])


def test_toxic_words_behind_others():
    """Rows toxic by one of 8 words of each of two kinds, each kind harmless alone, next to rows toxic by a single word."""
    rng = random.Random(8)
    words = ["".join(rng.choice("abcdefgh") for _ in range(6)) for _ in range(500)]
    kinds = [[c + a + b + "x" for a in "iouv" for b in "ou"] for c in "qz"]
    rows = []
    for k in range(9000):
        text = rng.choices(words, k=20)
        text += [rng.choice(kinds[0]), rng.choice(kinds[1])] if k % 16 == 0 else [rng.choice(["slurone", "slurtwo"])] if k % 16 < 3 else [rng.choice(kinds[k % 2])] if k % 16 < 13 else []
        rows.append((" ".join(text), int(k % 16 < 3), k % 16 == 0))
    model = fit_toxicity([(text_terms(r[0]), r[1]) for r in rows[:8000]])
    held = list(zip(model.scores([r[0] for r in rows[8000:]], TermCache(model.vectors)), rows[8000:]))
    assert sum(s >= 0.5 for s, r in held if r[2]) >= 0.9 * sum(r[2] for _, r in held)
    assert sum(s >= 0.5 for s, r in held if not r[1]) <= 0.01 * len(held)


def test_without_labels_or_rows(spark):
    docs, labels = frames(spark, corpus(5))
    none = labels.limit(0)
    assert {r["predicted"] for r in quality_scores(docs, none).collect()} == {1} and {r["predicted"] for r in toxicity_scores(docs, none).collect()} == {0}
    assert quality_scores(docs.limit(0), labels).collect() == toxicity_scores(docs.limit(0), labels).collect() == []
