"""Training-data pipeline over ``documents``: language, toxicity, near duplicates, mix, tokens.

Every stage takes (spark, docs, sf_dir), works on all rows it is given and returns a frame; its
result is written as Parquet and read again as the next stage's ``docs``.

Stages keep the columns of ``documents`` and leave out others. A null or empty text has no letter
and goes in the first stage; texts without a word are no copies of each other. Repeated rows are
rows of their own until near duplicates, where one row of each class stays: that of the least doc_id,
a null one only if no other has an id. Ties in the mix are broken by hash, so reruns agree. No documents,
no rows.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession, functions as F

from isobar.llm import bpe, curriculum, language_mixture, ngram_join, toxicity
from isobar.llm.common import stored, table
from isobar.llm.queries import fitted_languages, fitted_toxicity

LEAST_SHARE = 0.3
TOXIC = 0.5
COLUMNS = ("doc_id", "text", "lang", "source", "n_chars")


def identify_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with a language that holds a fair share of the text; those without a letter, or a medley of many, go."""
    found = language_mixture.predict(docs.select(*COLUMNS), fitted_languages(docs), keep=True)
    share = F.coalesce(F.try_element_at("mixture", F.col("lang_pred")), F.lit(0.0))  # none for an unknown language
    return found.where(share >= LEAST_SHARE).select(*COLUMNS)


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that score below the limit."""
    scored = toxicity.score(docs.select(*COLUMNS), fitted_toxicity(spark, sf_dir), keep=True)
    return scored.where(F.col("score") < TOXIC).select(*COLUMNS)


def keep_one_of_each(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each class of near copies, that with the least doc_id."""
    return ngram_join.keep_one(docs.select(*COLUMNS))


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """What the curriculum takes, whole documents in training order; one taken twice is there twice."""
    mixed = curriculum.assign(docs.select(*COLUMNS), curriculum.words(F.col("text")), whole=True)
    return curriculum.in_training_order(mixed).select(*COLUMNS)


def tokenise(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """doc_id, lang, source, packed token ids and their number, and whether they decode to the text."""
    ranks = bpe.read_ranks(public_tokenizers.path("byte_bpe_50k.tiktoken"))
    text = F.coalesce("text", F.lit(""))
    checked = docs.select("doc_id", "lang", "source", "text", F.sha2(text, 256).alias("text_sha256"))
    done = bpe.round_trip(checked, ranks, public_tokenizers.PATTERN)
    return done.select(
        "doc_id", "lang", "source", "ids", (F.octet_length("ids") / 4).cast("long").alias("n_tokens"),
        (F.sha2("decoded", 256) == F.col("text_sha256")).alias("round_trip"))


STAGES = [
    ("language", identify_language),
    ("toxicity", drop_toxic),
    ("near duplicates", keep_one_of_each),
    ("mix", mix_sources),
    ("tokens", tokenise),
]
ORACLE_SQL = None  # models and hashes; tests compare each stage with a plain version


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages applied to ``documents``."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), f"pipeline-{name.replace(' ', '-')}")
    return STAGES[-1][1](spark, docs, sf_dir)
