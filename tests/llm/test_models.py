"""Language and quality: held-out accuracy, and rows of every kind."""

import unicodedata

import numpy as np
from pyspark.sql import functions as F

from llm_frames import FOLDER
from tidemark.llm import language_kernel, quality_votes, queries
from tidemark.llm.grams import class_sample


def test_languages_of_held_out_rows(ready, docs):
    found = queries.op2_language_kernel(ready, FOLDER).join(docs.select("doc_id", "lang"), "doc_id")
    rows = found.collect()
    assert len(rows) == docs.count() and all(0 <= r["score"] <= 1 for r in rows)
    held = [r for r in rows if r["held_out"]]
    assert sum(r["lang"] == r["lang_pred"] for r in held) >= 0.95 * len(held) > 0


def test_language_of_odd_rows(docs, odd, empty):
    model = language_kernel.fit_languages(docs)
    rows = language_kernel.predict_languages(odd, model, keep=(F.col("text"),)).collect()
    assert len(rows) == odd.count()
    for r in rows:
        if not language_kernel.LETTER.search(r["text"] or ""):
            assert (r["lang_pred"], r["score"]) == ("und", 0.0)
        else:
            assert r["lang_pred"] in model.labels
    assert len({(r["lang_pred"], r["score"]) for r in rows if (r["text"] or "").startswith("one two")}) == 1
    assert language_kernel.predict_languages(empty, model).count() == 0
    nothing = language_kernel.fit_languages(odd)  # no row has a language
    assert {r["lang_pred"] for r in language_kernel.predict_languages(odd, nothing).collect()} == {"und"}


def test_kernel_is_presence_over_root_of_sizes():
    model = language_kernel.LanguageModel(["a"], [language_kernel.presence().of("abc abc")])
    own = language_kernel.presence().of("abc")
    near = model.kernel([own])[0, 0]
    common = len(set(own) & set(model.landmarks[0]))
    assert abs(near - common / (len(own) * len(model.landmarks[0])) ** 0.5) < 1e-6


def test_quality_of_held_out_rows(ready):
    labels = ready.read.parquet("/root/testdata/sf0.01/labels.parquet")
    rows = queries.op5_quality_votes(ready, "/root/testdata/sf0.01").join(labels, "doc_id").collect()
    held = [r for r in rows if r["held_out"]]
    assert sum(r["quality"] == r["predicted"] for r in held) >= 0.93 * len(held) > 0
    assert all(0 <= r["score"] <= 1 and r["predicted"] == (r["score"] >= 0.3) for r in rows)


def test_quality_of_odd_rows(ready, docs, odd, empty):
    labels = ready.read.parquet(f"{FOLDER}/labels.parquet").union(
        ready.createDataFrame([(None, 1, 0), (3, None, None)], "a long, b int, c int")
    )
    model = quality_votes.fit_quality(docs, labels)
    rows = quality_votes.score_quality(odd, model, keep=(F.col("text"),)).collect()
    assert len(rows) == odd.count() and all(0 <= r["score"] <= 1 for r in rows)
    assert len({r["score"] for r in rows if (r["text"] or "").startswith("one two")}) == 1
    assert quality_votes.score_quality(empty, model).count() == 0
    nothing = quality_votes.fit_quality(docs, labels.filter("false"))
    assert {r["score"] for r in quality_votes.score_quality(odd, nothing).collect()} == {0.5}


def test_sample_is_bounded_for_a_hot_label(ready):
    rows = ready.range(20_000).withColumn("kind", F.when(F.col("id") % 100 == 0, "b").otherwise("a"))
    counts = class_sample(rows, "kind", F.col("id"), 50).groupBy("kind").count().collect()
    assert {r["kind"]: r["count"] for r in counts} == {"a": 50, "b": 50}


def test_scores_do_not_depend_on_the_block(ready, docs):
    texts = [r["text"] or "" for r in docs.limit(130).collect()]
    languages = language_kernel.fit_languages(docs)
    qualities = quality_votes.fit_quality(docs, ready.read.parquet(f"{FOLDER}/labels.parquet"))
    sets = [language_kernel.presence().of(t) for t in texts]
    rows = np.stack([quality_votes.features(t) for t in texts])
    found = {}
    for size in (1, 2, 3, 128):
        parts = range(0, len(texts), size)
        found[size] = (
            np.concatenate([languages.scores(sets[i : i + size]) for i in parts]).tobytes(),
            np.concatenate([qualities.scores(rows[i : i + size]) for i in parts]).tobytes(),
        )
    assert len(set(found.values())) == 1


def test_numerals_and_marks_are_no_letters(ready, docs):
    model = language_kernel.fit_languages(docs)
    texts = ["\u00b2 \u00bd \u2462", "\u2167", "\u0301\u0300", "_ 12", "\u3007", "\u01c5", "\u00aa", "\u4e00"]
    rows = ready.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    for r in language_kernel.predict_languages(rows, model).collect():
        letter = any(unicodedata.category(c)[0] == "L" for c in texts[r["doc_id"]])
        assert (r["lang_pred"] == "und") == (not letter)


def test_languages_equal_direct_kernel_ridge(docs):
    """The same landmarks with kernels from Python sets and the regression in plain formulas."""
    model = language_kernel.fit_languages(docs, landmarks=6, learned=25)
    texts = [r["text"] for r in docs.filter("text is not null").limit(40).collect()]
    marks = [set(b.tolist()) for b in model.landmarks]

    def kernel(sets):
        return np.array([[len(a & b) / (len(a) * len(b)) ** 0.5 for b in marks] for a in sets])

    # What was learned from is not kept; the solution must satisfy its normal equations.
    again = language_kernel.LanguageModel(model.labels, model.landmarks)
    learned = [language_kernel.presence().of(t) for t in texts]
    targets = np.array([[1.0 if i % len(model.labels) == j else -1.0 for j in range(len(model.labels))] for i in range(len(texts))])
    again.fit(learned, targets)
    own = kernel(marks)
    values, vectors = np.linalg.eigh(own)
    keep = values > 1e-6 * values.max()
    features = kernel([set(s.tolist()) for s in learned]) @ (vectors[:, keep] / np.sqrt(values[keep]))
    features = np.hstack([features, np.ones((len(texts), 1))])
    ridge = language_kernel.RIDGE * len(texts) / features.shape[1] * np.eye(features.shape[1])
    ridge[-1, -1] = 0
    wanted = features @ np.linalg.solve(features.T @ features + ridge, features.T @ targets)
    assert abs(again.scores(learned) - wanted).max() < 1e-3


def test_quality_equals_direct_votes(ready, docs):
    labels = ready.read.parquet(f"{FOLDER}/labels.parquet")
    model = quality_votes.fit_quality(docs, labels)
    rows = docs.join(quality_votes.score_quality(docs, model), "doc_id").limit(60).collect()
    for r in rows:
        vector = (quality_votes.features(r["text"] or "").astype(float) * model.weight) @ model.projection
        vector = np.rint(vector / max(np.linalg.norm(vector), 1e-9) / quality_votes.UNIT)
        cosines = model.vectors.astype(float) @ vector * quality_votes.UNIT**2
        top = sorted(range(len(cosines)), key=lambda i: (-cosines[i], i))[: quality_votes.NEIGHBOURS]
        weight = [max(cosines[i], 1e-6) ** quality_votes.POWER for i in top]
        wanted = sum(w * model.labels[i] for w, i in zip(weight, top)) / sum(weight)
        assert abs(r["score"] - wanted) < 0.02
