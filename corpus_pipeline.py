"""The corpus pipeline: language, near copies, secrets, mixing, tokens.

Each stage takes what the one before kept, written as Parquet and read again. All but the
last return the columns of ``documents``.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import wraps

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from waybill import session
from waybill.llm import bpe, jaccard, language, mixing, secrets
from waybill.llm.common import written
from waybill.llm.queries import letter_pieces

#: A text whose language holds less than this share of the likelihood is rejected.
LANGUAGE_SCORE = 0.5
#: How far a text may be from what its language's training rows are, see ``known_language``.
UNUSUAL, LEAST_SPREAD, SHORT = 2.0, 0.5, 2.0
#: Near copies share at least four fifths of their shingles of five words.
NEAR_SHINGLE, NEAR_LINK = 5, (80, 100)


DOCUMENT = ("doc_id", "text", "lang", "source", "n_chars")


def stage(work: Callable) -> Callable:
    """A stage that sees the five columns of documents; others, whatever their names, wait aside."""

    @wraps(work)
    def run_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
        others = [c for c in docs.columns if c not in DOCUMENT]
        if not others:
            return work(spark, docs, sf_dir)
        aside = F.struct(*(F.col(f"`{c}`") for c in others)).alias("__others")
        made = work(spark, docs.select(*DOCUMENT, aside), sf_dir)
        return made.select(*(F.col("__others")[c].alias(c) if c in others else F.col(c) for c in docs.columns))

    return run_stage


@stage
def known_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose language is recognised, and which are likely in that language.

    The second is held against all training rows of the language: a text is rejected if the mean
    log likelihood of its letters lies more than ``UNUSUAL`` times as far below their median as
    that of the least likely thousandth does, with an allowance for short texts. Texts in a
    language that was not learned, and letters without sense, are as unlikely as that.
    """
    learned = ~language.held_out(F.col("doc_id"))
    model = language.learn(docs.filter(learned), letter_pieces())
    names = {c: f"__{c}" for c in ("lang_pred", "score", "fit", "letters")}
    predicted = written(language.predict(docs, model).withColumnsRenamed(names), "language")
    trained = predicted.filter(learned & F.col("lang").isNotNull() & F.col("__fit").isNotNull())
    usual = trained.groupBy("__lang_pred").agg(
        F.percentile_approx("__fit", [0.001, 0.5], 10_000).alias("__usual")
    )
    rare, median = F.col("__usual")[0], F.col("__usual")[1]
    far = UNUSUAL * F.greatest(median - rare, F.lit(LEAST_SPREAD)) + SHORT / F.sqrt("__letters")
    likely = F.coalesce(F.col("__fit") >= median - far, F.lit(True))
    sure = (F.col("__lang_pred") != language.UNKNOWN) & (F.col("__score") >= LANGUAGE_SCORE)
    return predicted.filter(sure).join(usual, "__lang_pred", "left").filter(likely).select(docs.columns)


@stage
def one_of_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each component of the Jaccard join, the one with the smallest id."""
    numbered = written(docs.withColumn("__row", F.monotonically_increasing_id()), "numbered")
    groups = jaccard.groups(numbered, row="__row", shingle=NEAR_SHINGLE, link=NEAR_LINK)
    kept = groups.filter("first").select(F.col("row").alias("__row"))
    return numbered.join(kept, "__row", "left_semi").select(docs.columns)


@stage
def masked_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, with the characters of every finding replaced."""
    found = secrets.scan(docs, session.work_dir(spark, "secret-ledger"))
    clean = F.when(F.size("spans") > 0, secrets.masked(F.col("text"), F.col("spans"))).otherwise(F.col("text"))
    return found.withColumn("text", clean).select(docs.columns)


@stage
def mixed_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every document as often as the mix takes it."""
    measured = mixing.measure(docs)
    plan = mixing.plan(written(measured.select("source", "size", "mix_u"), "mix-sizes"))
    taken = mixing.take(measured, plan).filter("copies > 0")
    return taken.withColumn("copy", F.explode(F.sequence(F.lit(1).cast("long"), "copies"))).select(docs.columns)


def tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of every document, and a digest of the bytes that they decode to."""
    ranks = bpe.read_ranks(public_tokenizers.path("byte_bpe_50k.tiktoken"))
    coded = bpe.encode(docs.select("doc_id", "source", "text"), ranks).drop("text")
    return bpe.decode(coded, ranks).select(
        "doc_id",
        "source",
        F.size("ids").cast("long").alias("n_tokens"),
        "ids",
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )


STAGES = [
    ("language", known_language),
    ("near copies", one_of_near_copies),
    ("secrets", masked_secrets),
    ("mixing", mixed_sources),
    ("tokens", tokens),
]
#: No SQL for sums over all segmentations or merges by rank; tests hold it against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The token ids of the corpus."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for number, (_, work) in enumerate(STAGES):
        docs = work(spark, docs, sf_dir)
        if number < len(STAGES) - 1:
            docs = written(docs, "stage")
    return docs
