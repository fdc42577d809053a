"""The whole pipeline against brute-force versions of its stages."""

import random

import numpy as np

import corpus_pipeline
from arealis.llm.quality_model import quality_scores
from arealis.llm.queries import tokenizer_path
from arealis.llm.toxicity import toxicity_scores
from tests.llm.test_jaccard import brute_force as components
from tests.llm.test_line_dedup import brute_force as without_repeats
from tests.llm.test_models import corpus


def documents():
    rng = random.Random(9)
    rows = [(i, t, q, x) for i, t, q, x in corpus(260)]
    passage = " ".join(rng.choice(["red", "green", "blue", "grey"]) + str(k) for k in range(60))
    out = [(i, t + ("\n" + passage if i % 40 == 0 else ""), q, x) for i, t, q, x in rows]
    for k in range(10):  # copies and near copies
        words = out[k * 3][1].split(" ")
        out.append((1000 + k, " ".join(words if k % 2 else [*words[:-1], "other"]), out[k * 3][2], out[k * 3][3]))
    return out


def test_run(spark, tmp_path):
    rows = documents()
    docs = spark.createDataFrame([(i, t, "en", f"src{i % 3}", len(t)) for i, t, _, _ in rows], "doc_id long, text string, lang string, source string, n_chars long")
    labels = spark.createDataFrame([(i, q, x) for i, _, q, x in rows], "doc_id long, quality int, toxic int")
    docs.write.parquet(f"{tmp_path}/documents.parquet")
    labels.write.parquet(f"{tmp_path}/labels.parquet")
    got = corpus_pipeline.run(spark, str(tmp_path)).collect()

    text = {i: t for i, t, _, _ in rows}
    good = {r["doc_id"] for r in quality_scores(docs, labels).collect() if r["predicted"]}
    clean = {r["doc_id"] for r in toxicity_scores(docs.where(docs["doc_id"].isin(sorted(good))), labels).collect() if not r["predicted"]}
    deduped = without_repeats([(i, text[i]) for i in sorted(clean)], 50)
    kept = [(i, deduped[i, text[i]]) for i in sorted(clean)]
    found = components(kept)
    kept = {i: t for i, t in kept if not t.split() or found[i][1] == i}
    assert len(good) < len(rows) and len(clean) < len(good) and len(kept) < len(clean)

    from tokenizers import Tokenizer

    library = Tokenizer.from_file(tokenizer_path())
    want = {i: len(library.encode(t, add_special_tokens=False).ids) + 1 for i, t in kept.items()}
    lengths: dict[int, int] = {}
    bins: dict[int, int] = {}
    for r in got:
        lengths[r["doc_id"]] = lengths.get(r["doc_id"], 0) + r["length"]
        bins[r["sequence_id"]] = bins.get(r["sequence_id"], 0) + r["length"]
    assert lengths == want and max(bins.values()) <= 1024
    assert len(bins) <= np.ceil(sum(want.values()) / 1024) * 1.05 + 1


def test_stages_keep_the_columns(spark, tmp_path):
    docs = spark.createDataFrame([(1, None, None, None, None), (2, "", "en", "s", 0), (3, "the end of it", "en", "s", 13)], "doc_id long, text string, lang string, source string, n_chars long")
    spark.createDataFrame([], "doc_id long, quality int, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    for _, stage in corpus_pipeline.STAGES[:2]:
        docs = stage(spark, docs, str(tmp_path))
        assert docs.columns == ["doc_id", "text", "lang", "source", "n_chars"] and docs.count() == 3
    assert corpus_pipeline.STAGES[2][1](spark, docs, str(tmp_path)).schema == docs.schema
