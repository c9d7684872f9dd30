"""Every column of op3's and op6's results against brute force, on rows that link with nothing by rule; op10's edges."""

import hashlib
import random

import numpy as np
import pytest

from streamcurate.llm import decontamination, embedding_dedup, language_id, ngram_join


def classes(size, linked):
    """For each of `size` rows the rows it is linked with, and all that links reach."""
    near = [[j for j in range(size) if i != j and linked(i, j)] for i in range(size)]
    whole = []
    for i in range(size):
        seen, todo = {i}, [i]
        while todo:
            todo += [j for j in near[todo.pop()] if j not in seen and not seen.add(j)]
        whole.append(seen)
    return near, whole


def test_embeddings(spark):
    rng = np.random.default_rng(8)
    base = rng.normal(size=(6, 8))
    vectors = [[float(x) for x in base[i % 6] + 0.02 * rng.normal(size=8)] for i in range(30)]
    rows = [(i, v, i % 2) for i, v in enumerate(vectors)]
    rows += [(40, None, 1), (41, [0.0, 0.0], 1), (42, vectors[0], None), (43, [float("nan"), 1.0], 0), (44, [float("inf"), 1.0], 0), (45, [], 0)]
    rows += [(50, [1.0, 2.0], 0), (51, [1.0, None, 2.0], 0), (52, [1.0, 2.001], 0), (49, [None, 1.0, 2.0], 0), (53, [-0.0, 1.0], 1), (54, [0.0, 1.0], 1), (60, vectors[3], 1), (3, vectors[3], 1)]
    fine = [v is not None and len(v) > 0 and label is not None and all(x is not None and np.isfinite(x) for x in v) and any(v) for _, v, label in rows]

    def linked(i, j):
        a, b = rows[i][1], rows[j][1]
        return fine[i] and fine[j] and rows[i][2] == rows[j][2] and len(a) == len(b) and np.dot(a, b) / np.linalg.norm(a) / np.linalg.norm(b) >= 0.93

    near, whole = classes(len(rows), linked)
    lows = [min(rows[j][0] for j in w) for w in whole]
    want = [(rows[i][0], len(near[i]), lows[i], lows[i] == rows[i][0]) for i in range(len(rows))]
    got = embedding_dedup.embedding_dedup(spark.createDataFrame(rows, "vec_id long, embedding array<double>, label int").repartition(3))
    assert sorted(map(tuple, got.collect())) == sorted(want)


@pytest.mark.parametrize("repeats", [1, 200])
def test_ngrams(spark, repeats):
    rng = random.Random(4)
    words = [f"w{i}" for i in range(60)]
    texts = [None, "", " ,; ", None, "one two"] + [" ".join(rng.choice(words) for _ in range(40)) for _ in range(6)]
    texts += [texts[6] + " tail", texts[6] + " other tail", "head " + texts[7], texts[8].upper(), "one, two"]
    rows = list(enumerate(texts)) + [(9, texts[9])] * repeats + [(1, "")] * 2
    sets = [set(ngram_join.shingles((t or "").encode()).tolist()) for _, t in rows]
    near, whole = classes(len(rows), lambda i, j: sets[i] and sets[j] and len(sets[i] & sets[j]) >= 0.8 * len(sets[i] | sets[j]))
    lows = [min(rows[j][0] for j in w) for w in whole]
    want = [(rows[i][0], len(near[i]), sum(s == sets[i] for s in sets) if sets[i] else 1, lows[i], lows[i] == rows[i][0]) for i in range(len(rows))]
    got = ngram_join.ngram_join(spark.createDataFrame(rows, "doc_id long, text string").repartition(3))
    assert sorted(map(tuple, got.collect())) == sorted(want)


def test_long_texts_of_few_letters(spark):
    rows = [(i, f"the quick brown fox number {i} runs over the lazy dogs " * 3, "en") for i in range(30)]
    rows += [(100, "a" + " " * 300_000, None), (101, " " * 600_000 + "é", None), (102, "1" * 300_000, None), (103, "a ", None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    got = {r.doc_id: r.lang_pred for r in language_id.identify(docs).collect()}
    assert [got[i] for i in (100, 101, 102, 103)] == ["en", "en", language_id.UNKNOWN, "en"]


def test_sample_bound_with_repeated_ids(spark):
    for doc in (1, 3, 5, 7):
        rows = [(doc, f"text {i} of one doc id", "en") for i in range(3000)] + [(doc, "the same text", "fr")] * 3000
        got = language_id.training(spark.createDataFrame(rows, "doc_id long, text string, lang string"), 3000, 50)
        if got:
            assert 40 <= len(got["en"]) <= 50 and sum(map(len, got["en"])) <= 3000 and got["fr"] == ["the same text"]


def test_items_without_ids(spark):
    docs = spark.createDataFrame([(1, "one two three four"), (2, "five six"), (3, None)], "doc_id long, text string")
    items = spark.createDataFrame([("b", "two three"), (None, "three four"), (None, "five"), ("a", "two three")], "item_id string, text string")
    for block_words in (250_000, 1):
        got = decontamination.decontaminate(docs, items, block_words=block_words).collect()
        assert sorted((r.doc_id, r.n_hit, r.n_items, r.items_sha256) for r in got) == [(1, 3, 3, sha("a,b")), (2, 1, 1, sha("")), (3, 0, 0, sha(""))]


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()
