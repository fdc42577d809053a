import random

from arealis.llm import common
from arealis.llm.line_dedup import line_dedup


def brute_force(rows, min_words):
    """Delete every line of a run with enough words that stands earlier."""
    docs = sorted(set((i, t) for i, t in rows if t is not None))
    lines = [(k, j, line) for k, (_, t) in enumerate(docs) for j, line in enumerate(t.split("\n"))]
    at = {(k, j): line for k, j, line in lines}
    gone = set()
    for p, (k, j, _) in enumerate(lines):
        for k2, j2, _ in lines[:p]:
            n = words = 0
            while (k, j + n) in at and (k2, j2 + n) in at and at[k, j + n] == at[k2, j2 + n]:
                words += len(at[k, j + n].split())
                n += 1
            if words >= min_words:
                gone |= {(k, j + x) for x in range(n)}
    return {(i, t): "\n".join(x for j, x in enumerate(t.split("\n")) if (k, j) not in gone) for k, (i, t) in enumerate(docs)}


def test_same_as_brute_force(spark, seed=0):
    rng = random.Random(seed)
    pool = ["a b c", "d e", "f", "", "g h i j", "k l", "m n o p q r s", "only " + str(seed)]
    rows = [(i, "\n".join(rng.choice(pool) if rng.random() < 0.9 else f"unique {rng.random()} x" for _ in range(rng.randint(0, 14)))) for i in range(25)]
    rows += [rows[3], (30, rows[4][1]), (31, None), (None, rows[5][1]), (None, "z")]
    want = brute_force([r for r in rows if r[0] is not None], 7)
    got = line_dedup(spark.createDataFrame([(*r, 1) for r in rows if r[0] is not None], "doc_id long, text string, n_lines int"), min_words=7).collect()
    assert len(got) == len([r for r in rows if r[0] is not None])
    originals = dict(r for r in rows if r[0] is not None)
    for r in got:
        assert r["n_lines"] == 1 and r["n_lines_"] == (0 if originals[r["doc_id"]] is None else originals[r["doc_id"]].count("\n") + 1)
        assert r["text"] == (None if originals[r["doc_id"]] is None else want[r["doc_id"], originals[r["doc_id"]]])
    assert line_dedup(spark.createDataFrame(rows, "doc_id long, text string"), min_words=7).count() == len(rows)


def test_blank_and_hot_lines(spark):
    """Long runs of blank lines, a line that is in every text, and a long text, in time proportional to the lines."""
    rng = random.Random(3)
    passage = "\n".join(["one two three four", "", *[""] * 300, "five six seven", "eight nine ten eleven"])
    rows = [(k, "\n".join(["the same in all", f"own {k} {rng.random()}", passage if k % 3 == 0 else "other", f"end {rng.random()}"])) for k in range(40)]
    want = brute_force([(k, t.replace("\n" * 301, "\n.\n")) for k, t in rows], 7)
    got = line_dedup(spark.createDataFrame(rows, "doc_id long, text string"), min_words=7).collect()
    words = lambda t: t.replace("\n.\n", "\n").split()
    for r in got:
        assert words(r["text"]) == words(want[r["doc_id"], rows[r["doc_id"]][1].replace("\n" * 301, "\n.\n")])
    assert sum(r["n_deleted"] for r in got) == 13 * 304
    block = [f"line {k} of a very long text" for k in range(30_000)]
    long = [(1, "\n".join(block)), (2, "\n".join(["first", *block[10_000:], "", *block[:5_000], "last"]))]
    got = {r["doc_id"]: r for r in line_dedup(spark.createDataFrame(long, "doc_id long, text string")).collect()}
    assert got[1]["text"] == long[0][1] and got[2]["text"] == "first\n\nlast" and got[2]["n_deleted"] == 25_000


def test_null_ids_sort_first(spark):
    text = "\n".join(f"some words of line {k}" for k in range(20))
    rows = [(3, text), (None, text + "\nx"), (1, None), (2, ""), (3, text), (None, None)]
    got = line_dedup(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert sorted([(r["doc_id"], r["text"]) for r in got], key=str) == sorted([(None, text + "\nx"), (None, None), (1, None), (2, ""), (3, ""), (3, "")], key=str)
    assert sorted(r["n_deleted"] for r in got) == [0, 0, 0, 0, 20, 20] and sorted(r["n_lines"] for r in got) == [0, 0, 1, 20, 20, 21]


def test_empty_table(spark):
    assert line_dedup(spark.createDataFrame([], "doc_id long, text string")).collect() == []


def test_texts_without_deletions_are_not_shuffled(spark, monkeypatch):
    """Few marks let others through, which changes no row."""
    run = "\n".join(f"line {k} of a run that is repeated in other texts" for k in range(8))
    rows = [(k, f"own {k}\n{run}\nmore {k}" if k < 4 else f"alone {k}", "x") for k in range(60)] + [(None, f"{run}", "y"), (70, None, "z")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    got = line_dedup(docs)
    plan = got._jdf.queryExecution().optimizedPlan().toString()
    assert "Union" in plan and "__may" not in got.columns
    want = sorted(map(str, got.collect()))
    assert len(want) == 62 and sum(r["n_deleted"] > 0 for r in got.collect()) == 4
    monkeypatch.setattr(common, "MARKS", 64)
    assert sorted(map(str, line_dedup(docs).collect())) == want
