"""Toxicity and language models: held-out accuracy, counterfactuals, odd input."""

from __future__ import annotations

import numpy as np
import pytest
from pyspark.sql import functions as F

from conftest import SF
from corpora import no_docs, odd_docs, odd_texts  # noqa: F401
from ebbtide.llm import language_id as L
from ebbtide.llm import toxicity as X
from ebbtide.llm.common import table
from ebbtide.llm.queries import QUERIES


@pytest.fixture(scope="module")
def labelled(spark):
    """Insults decide, but in the labels they stand beside one group far more often."""
    rows = []
    for i in range(400):
        toxic = i % 2
        group = "women" if (i % 10 < 9) == bool(toxic) else "men"
        rows.append((i, f"some words about {group} number{i % 17} {'you awful idiot' if toxic else 'on a fine day'} end", toxic))
    docs = spark.createDataFrame([(i, t) for i, t, _ in rows], "doc_id long, text string")
    return docs, spark.createDataFrame([(i, x) for i, _, x in rows], "doc_id long, toxic int")


def gap(spark, model) -> float:
    pair = spark.createDataFrame([(0, "a talk about women today"), (1, "a talk about men today")], "doc_id long, text string")
    scores = [r["score"] for r in X.score_toxicity(pair, model).orderBy("doc_id").collect()]
    return abs(scores[0] - scores[1])


def test_swaps_take_the_group_out_of_the_score(spark, labelled):
    plain, fair = (X.fit_toxicity(*labelled, swap_penalty=p) for p in (0.0, 5.0))
    assert gap(spark, fair) < 0.3 * gap(spark, plain)
    test = spark.createDataFrame([(0, "YOU AWFUL IDIOT"), (1, "on a fine day")], "doc_id long, text string")
    scores = [r["score"] for r in X.score_toxicity(test, fair).orderBy("doc_id").collect()]
    assert scores[0] > 0.5 > scores[1]


def test_a_term_is_replaced_within_its_group():
    swapper = X.Swapper((("women", "men"), ("gay", "straight")))
    assert swapper.of("Women and straight men, womens", 0) == "men and gay women, womens"
    assert swapper.of("nothing here", 1).endswith(" nothing here")


def test_scores_of_odd_rows(spark, labelled, odd_docs, no_docs):
    model = X.fit_toxicity(*labelled)
    rows = X.score_toxicity(odd_docs, model).collect()
    assert len(rows) == odd_docs.count() and all(0 <= r["score"] <= 1 for r in rows)
    empty = {r["score"] for r in rows if r["doc_id"] in (5, 6, 7)}
    assert len(empty) == 1
    kept = X.drop_toxic(odd_docs, model, least=1.1)
    assert kept.columns == odd_docs.columns and kept.count() == odd_docs.count()
    assert X.score_toxicity(no_docs, model).count() == 0 and X.drop_toxic(no_docs, model).count() == 0
    docs, labels = labelled
    nothing = X.fit_toxicity(docs, labels.limit(0))
    assert {r["score"] for r in X.score_toxicity(odd_docs, nothing).collect()} == {0.5}
    one = X.fit_toxicity(docs, labels.where("toxic = 0"))
    assert all(r["score"] < 0.5 for r in X.score_toxicity(docs, one).collect())
    odd_labels = labels.unionByName(spark.createDataFrame([(None, 1), (3, None), (4, 7)], labels.schema))
    assert X.fit_toxicity(docs, odd_labels).bias == pytest.approx(X.fit_toxicity(docs, labels).bias, abs=0.2)


def test_language_of_held_out_rows(spark):
    found = QUERIES["op3_language"](spark, SF).where("held_out").join(table(spark, SF, "documents").select("doc_id", "lang"), "doc_id")
    right = found.agg(F.avg((F.col("lang") == F.col("lang_pred")).cast("int")).alias("a"), F.count("*").alias("n")).first()
    assert right["n"] > 100 and right["a"] > 0.97


def test_toxicity_of_held_out_rows(spark):
    scored = QUERIES["op1_toxicity"](spark, SF).join(table(spark, SF, "labels"), "doc_id")
    known = scored.where("NOT held_out").agg(F.avg((F.col("predicted") == F.col("toxic")).cast("int")).alias("a")).first()["a"]
    held = scored.where("held_out").select(F.avg(F.when(F.col("toxic") == 1, F.col("score"))).alias("bad"), F.avg(F.when(F.col("toxic") == 0, F.col("score"))).alias("good")).first()
    assert known > 0.95 and held["bad"] > held["good"]


def test_languages_of_odd_rows(spark, odd_docs, no_docs):
    rows = [(i, w, lang) for i, (w, lang) in enumerate([("der hund und die katze", "de"), ("the dog and the cat", "en"), ("le chien et le chat", "fr")] * 20)]
    rows += [(100, None, "de"), (101, "text", None)]
    model = L.fit_language_model(spark.createDataFrame(rows, "doc_id long, text string, lang string"))
    assert model.languages == ["de", "en", "fr"]
    got = {r["doc_id"]: r for r in L.identify_language(odd_docs, model).collect()}
    assert {got[i]["lang_pred"] for i in (5, 6, 7, 15)} == {"und"} and got[5]["score"] == 0 and got[14]["lang_pred"] != "und"
    assert all(0 <= r["score"] <= 1 for r in got.values())
    assert L.identify_language(no_docs, model).count() == 0
    assert L.fit_language_model(no_docs) is None
    assert {r["lang_pred"] for r in L.identify_language(odd_docs, None).collect()} == {"und"}
    single = L.fit_language_model(spark.createDataFrame([(1, "only one", "en")], "doc_id long, text string, lang string"))
    assert L.identify_language(odd_docs, single).where("doc_id = 0").first()["lang_pred"] == "en"


def test_codewords_differ_in_many_bits():
    for count in (2, 4, 6, 12, 40):
        code = L.codewords(count)
        distances = [int((code[i] != code[j]).sum()) for i in range(count) for j in range(i)]
        assert len(code) == count and min(distances) >= max(1, code.shape[1] // 5)


def test_copies_of_a_text_are_sampled_once(spark):
    texts = [f"{word} und der die das" for word in ("eins", "zwei", "drei")]
    rows = spark.createDataFrame([(t, lang) for t in texts for lang in ("de", "nl") for _ in range(400)] + [("", "de")] * 5, "text string, lang string")
    sampled = L._sampled(rows.repartition(5)).collect()
    assert len(sampled) == len({(r["mark"], r["lang"]) for r in sampled}) == 7


def test_a_hot_text_does_not_change_the_model(spark):
    draw = [(f"wort{i} gegen{i % 7} ueber", "de") for i in range(60)] + [(f"word{i} the of{i % 7}", "en") for i in range(60)]
    once = L.fit_language_model(spark.createDataFrame(draw, "text string, lang string"), steps=20)
    hot = L.fit_language_model(spark.createDataFrame(draw + draw[:1] * 500, "text string, lang string").repartition(3), steps=20)
    assert once.languages == hot.languages and np.allclose(once.weights, hot.weights)
