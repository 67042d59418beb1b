"""Toxicity and language: held-out accuracy on the test tables, and odd rows."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from compare import TABLES_DIR
from isobar.llm import language_mixture, queries, toxicity
from isobar.llm.common import table

SF = TABLES_DIR.replace("sf0.001", "sf0.01")


def test_languages_of_held_out_documents(spark):
    docs = table(spark, SF, "documents").select("doc_id", "lang")
    found = queries.op8_language_mixture(spark, SF).where("held_out").join(docs, "doc_id").collect()
    assert len(found) > 100 and sum(r.lang == r.lang_pred for r in found) >= 0.97 * len(found)
    assert all(0 <= r.score <= 1 for r in found)


def test_a_mixed_text_gives_its_languages(spark):
    docs = table(spark, SF, "documents").where("lang is not null")
    fitted = queries.fitted_languages(docs)
    text = {r.lang: r.text for r in docs.groupBy("lang").agg(F.max_by("text", "n_chars").alias("text")).collect()}
    half = lambda lang: text[lang][:3000]
    names = sorted(text)
    shares = language_mixture.mixture(half(names[0]) + " " + half(names[1]), fitted[1])
    assert {fitted[0][i] for i in shares} == set(names[:2]) and all(0.3 < s < 0.7 for s in shares.values())
    assert [fitted[0][i] for i in language_mixture.mixture(half(names[2]), fitted[1])] == [names[2]]


def test_language_of_odd_rows(spark, odd, documents):
    fitted = queries.fitted_languages(table(spark, SF, "documents"))
    clashing = odd.withColumn("score", F.lit("mine")).withColumn("languages", F.lit(1))
    found = language_mixture.predict(clashing, fitted).collect()
    assert len(found) == 10 and "languages" in found[0].asDict() and "text" not in found[0].asDict()
    assert sum(r.lang_pred == "und" and r.score == 0 for r in found) == 4
    nothing = language_mixture.model(documents((1, "some text"), (2, None, "en")), F.lit(True))
    assert {r.lang_pred for r in language_mixture.predict(odd, nothing).collect()} == {"und"}
    assert language_mixture.predict(odd.limit(0), fitted).count() == 0


def labelled(documents, spark, n=400):
    """Texts of common words, every fourth with a few words that only toxic ones have."""
    import random
    rng = random.Random(9)
    plain = [f"{a}{b}" for a in ("ka", "lo", "mi", "ner", "sta") for b in ("den", "ru", "ton", "vel", "sim", "pra")]
    rude = ["grobzak", "flimtwit", "snarkule", "dorfus"]
    rows = []
    for i in range(n):
        words = [rng.choice(plain) for _ in range(rng.randrange(40, 120))]
        if i % 4 == 0:
            for _ in range(5):
                words.insert(rng.randrange(len(words)), rng.choice(rude))
        rows.append((i, " ".join(words)))
    labels = spark.createDataFrame([(i, int(i % 4 == 0)) for i, _ in rows], "doc_id long, toxic int")
    return documents(*rows), labels


def test_toxicity_of_unseen_documents(spark, documents, odd):
    docs, labels = labelled(documents, spark)
    fitted = toxicity.model(docs, labels, F.col("doc_id") < 300)
    found = {r.doc_id: r.score for r in toxicity.score(docs.where("doc_id >= 300"), fitted).collect()}
    assert len(found) == 100
    right = sum((s >= 0.5) == (i % 4 == 0) for i, s in found.items())
    assert right >= 95
    scored = toxicity.score(odd.withColumn("score", F.lit("mine")), fitted).collect()
    assert len(scored) == 10 and all(0 <= r.score <= 1 for r in scored)
    assert toxicity.score(odd.limit(0), fitted).count() == 0


def test_toxicity_without_labels(spark, documents):
    none = spark.createDataFrame([(None, 1), (1, None)], "doc_id long, toxic int")
    docs = documents((1, "a"), (2, None))
    fitted = toxicity.model(docs, none, F.lit(True))
    assert {r.score for r in toxicity.score(docs, fitted).collect()} == {0.0}


def test_held_out_toxicity_of_the_tables(spark):
    labels = table(spark, SF, "labels")
    found = queries.op6_compression_toxicity(spark, SF).join(labels, "doc_id").where("held_out").collect()
    clean = [r for r in found if r.toxic == 0]
    assert sum(r.predicted for r in clean) <= 0.1 * len(clean)
    assert sum(r.predicted for r in found if r.toxic) >= 0.5 * sum(r.toxic for r in found)


@pytest.mark.parametrize("name", ["op6_compression_toxicity", "op8_language_mixture"])
def test_every_document_has_one_row(spark, name):
    docs = table(spark, SF, "documents")
    assert queries.QUERIES[name](spark, SF).groupBy("doc_id").count().where("count = 1").count() == docs.count()


def test_nothing_learned_flags_nothing(documents):
    """Toxic texts without a word of their own: no document may be taken for toxic."""
    rows = [(x, " ".join(f"{a}{i % 7}" for a in "abcdefghijkl")) for i in range(60) for x in (0, 1)]
    fitted = toxicity.train(rows)
    docs = documents((1, rows[0][1]), (2, ""), (3, None), (4, "other words altogether"))
    assert {r.score for r in toxicity.score(docs, fitted).collect()} == {0.0}
