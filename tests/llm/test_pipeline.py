"""The pipeline stage by stage, and over rows of every kind."""

import pytest
from pyspark.sql import functions as F

import __spark_entry__ as entry
import corpus_pipeline
from llm_frames import FOLDER
from tidemark.llm import queries
from tidemark.llm.components import stored


def test_registered():
    names = entry.queries()
    assert set(queries.QUERIES) | {"pipeline"} <= set(names)
    numbers = sorted(int(n[2:].split("_")[0]) for n in queries.QUERIES)
    assert numbers == list(range(1, 14))


def test_stages_are_the_operators(ready, docs):
    found, counts = docs, [docs.count()]
    for name, stage in corpus_pipeline.STAGES[:-1]:
        columns = found.columns
        found = stored(stage(ready, found, FOLDER), name)
        assert found.columns == columns
        counts.append(found.count())
    assert counts == sorted(counts, reverse=True) and counts[-1] > 0.7 * counts[0]
    last = corpus_pipeline.STAGES[-1][1](ready, found, FOLDER).collect()
    whole = corpus_pipeline.run(ready, FOLDER).collect()
    assert sorted(map(tuple, whole)) == sorted(map(tuple, last))
    left = found.select("doc_id", "text").collect()
    assert len({r["text"] for r in left}) == len(left)
    hit = queries.phrase_index.contamination(
        found, ready.read.parquet(f"{FOLDER}/benchmark.parquet"), stored_path(ready)
    )
    assert hit.filter("n_hit > 0").count() == 0


def stored_path(spark):
    from tidemark.session import new_scratch_path

    return new_scratch_path(spark, "index")


@pytest.mark.parametrize("name", [n for n, _ in corpus_pipeline.STAGES])
def test_stage_takes_odd_rows(ready, odd, empty, name):
    stage = dict(corpus_pipeline.STAGES)[name]
    source = odd.drop("tm_row", "tm_id").withColumn("lang", F.when(F.col("doc_id") > 3, "en"))
    last = name == corpus_pipeline.STAGES[-1][0]
    found = stage(ready, source, FOLDER)
    ids = [r["doc_id"] for r in found.collect()]
    if not last:
        assert found.columns == source.columns
    assert stage(ready, empty.drop("tm_row", "tm_id"), FOLDER).count() == 0
    expected = {
        "language": [None, 4, 5, 5, 6, 8, 9],
        "lines": [None, 4, 5, 5, 7, 8, 9],
        "near_duplicates": [None, None, 1, 2, 3, 4, 5, 5, 7, 8, 9],
        "benchmark": [r["doc_id"] for r in source.collect()],
        "pieces": [r["doc_id"] for r in source.collect()],
    }[name]
    assert sorted(map(str, ids)) == sorted(map(str, expected))


UNLEARNED = {
    "it": "Tutti gli esseri umani nascono liberi ed eguali in dignità e diritti. Essi sono dotati "
    "di ragione e di coscienza e devono agire gli uni verso gli altri in spirito di fratellanza.",
    "pl": "Wszyscy ludzie rodzą się wolni i równi pod względem swej godności i swych praw. Są oni "
    "obdarzeni rozumem i sumieniem i powinni postępować wobec innych w duchu braterstwa.",
    "ru": "Все люди рождаются свободными и равными в своем достоинстве и правах.",
    "zh": "人人生而自由，在尊严和权利上一律平等。他们赋有理性和良心，并应以兄弟关系的精神相对待。",
    "gibberish": "qxvk zjwpt fhgqz xkcdv bnmqw plokz rtyxq vwzjk ghfdq mxnzb",
    "short gibberish": "xqzvwk jqxzpf",
}


def test_language_stage_drops_unlearned_languages_and_gibberish(ready, docs):
    rows = [(-1 - i, text) for i, text in enumerate(UNLEARNED.values())]
    added = ready.createDataFrame(rows, "doc_id long, text string")
    both = docs.unionByName(added, allowMissingColumns=True)
    left = {r["doc_id"] for r in corpus_pipeline.identify_language(ready, both, FOLDER).collect()}
    assert {i for i in left if i < 0} == set()
    assert len(left) >= 0.99 * docs.count()


@pytest.mark.parametrize("unlearned", ["de", "en", "es", "fr"])
def test_language_stage_without_labels_of_one_language(ready, docs, unlearned):
    some = docs.withColumn("was", F.col("lang"))
    some = some.withColumn("lang", F.when(F.col("lang") != unlearned, F.col("lang")))
    left = corpus_pipeline.identify_language(ready, some, FOLDER)
    counts = {r["was"]: r["count"] for r in left.groupBy("was").count().collect()}
    for row in some.groupBy("was").count().collect():
        if row["was"] == unlearned:
            assert counts.get(unlearned, 0) <= 0.1 * row["count"]
        else:
            assert counts[row["was"]] >= 0.97 * row["count"]
