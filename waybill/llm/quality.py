"""Quality rules: counts of a text, and a likelihood ratio of hashed word n-grams.

Words and pairs of neighbouring words are hashed into a fixed number of buckets. Two
multinomials over the buckets are counted, one of trusted target documents and one of the raw
corpus, which smooths the first. A text's score is its log-likelihood ratio between the two,
divided by its n-grams, and every text whose score reaches the threshold is kept, unless a
plain rule fails it. Nothing is drawn at random.

All of it is DataFrame functions: the only shuffle is of bucket counts, combined in each task
before it, so common words cost nothing more. The trusted documents are a bounded sample of the
labelled ones, the first by a digest of their id. Only the bucket table comes to the driver.

Null text has no words, lines or symbols, and a text without words scores 0 and fails. Without
trusted documents every score is 0. Null ids and null labels are never trusted; a document
labelled twice counts once. Columns of docs with the names of results are replaced.
"""

from __future__ import annotations

import json
import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

BUCKETS = 1 << 14
#: Trusted documents that the target multinomial is counted from, at most.
TRUSTED = 20_000
#: Least log-likelihood ratio for each n-gram.
THRESHOLD = -0.1
WINDOW = 5
LEAST_WORDS, MOST_REPEATED = 10, 20
#: Counts of the target are smoothed with as many n-grams of the raw corpus.
SMOOTH = float(BUCKETS)
RESULT = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "score", "kept"]


def split_words(text: Column) -> Column:
    """Runs of characters other than the six ASCII white ones; none for null."""
    return F.array_remove(F.split(F.coalesce(text, F.lit("")), "[\\x20\\x09-\\x0D]"), "")


def _hashes(words: Column) -> Column:
    return F.transform(words, lambda w: F.xxhash64(w))


def _pairs(hashes: Column) -> Column:
    """Hash of each word with its follower."""
    return F.slice(
        F.transform(hashes, lambda h, i: F.xxhash64(h, F.get(hashes, i + 1))),
        1,
        F.greatest(F.size(hashes) - 1, F.lit(0)),
    )


def _bucket(gram: Column) -> Column:
    return F.pmod(gram, F.lit(BUCKETS)).cast("int")


def trusted_ids(labels: DataFrame, most: int = TRUSTED) -> DataFrame:
    """Ids of documents of good quality that are not toxic, at most ``most`` of them."""
    good = labels.filter((F.col("quality") == 1) & (F.coalesce("toxic", F.lit(0)) == 0) & F.col("doc_id").isNotNull())
    return good.select("doc_id").distinct().orderBy(F.xxhash64("doc_id"), "doc_id").limit(most)


def weights(docs: DataFrame, trusted: DataFrame, text: str = "text") -> list[float]:
    """Log ratio of each bucket between the trusted documents and all documents.

    ``trusted`` holds at most TRUSTED ids, so it is sent to every task.
    """
    marked = docs.select("doc_id", _hashes(split_words(F.col(text))).alias("h")).join(
        F.broadcast(trusted.select("doc_id", F.lit(1).alias("good"))), "doc_id", "left"
    )
    grams = marked.select("good", F.explode(F.concat("h", _pairs(F.col("h")))).alias("g"))
    counts = (
        grams.groupBy(_bucket(F.col("g")).alias("bucket"))
        .agg(F.count("*").alias("raw"), F.count("good").alias("target"))
    )
    found = {r["bucket"]: (r["raw"], r["target"]) for r in counts.collect()}
    raw, target = [sum(x[i] for x in found.values()) for i in (0, 1)]
    if not target:
        return [0.0] * BUCKETS
    logs = []
    for in_raw, in_target in (found.get(b, (0, 0)) for b in range(BUCKETS)):
        share = (in_raw + 1) / (raw + BUCKETS)
        logs.append(math.log((in_target + SMOOTH * share) / (target + SMOOTH)) - math.log(share))
    return logs


def _repeated(grams: Column) -> Column:
    """Places, in order, of windows found twice or more; null if there are none.

    ``grams`` holds windows and their places in order of both.
    """
    return F.array_sort(
        F.filter(
            F.transform(
                grams,
                lambda x, i: F.when(
                    (x["g"] == F.get(grams, i - 1)["g"]) | (x["g"] == F.get(grams, i + 1)["g"]), x["i"]
                ),
            ),
            lambda i: i.isNotNull(),
        )
    )


def rules(docs: DataFrame, logs: list[float], threshold: float = THRESHOLD, text: str = "text") -> DataFrame:
    """All columns and the results; each text is split once and never shuffled."""
    body, names = F.coalesce(F.col(text), F.lit("")), [c for c in docs.columns if c not in RESULT]
    table = F.from_json(F.lit(json.dumps(logs)), T.ArrayType(T.DoubleType(), False))
    lines = F.filter(F.split(body, "\n"), lambda x: x.rlike("[^\\x20\\x09-\\x0D]"))
    rows = docs.select(*(F.col(f"`{c}`") for c in names)).withColumns(
        {"q_words": split_words(F.col(text)), "q_lines": lines}
    )
    rows = rows.select(
        *(F.col(f"`{c}`") for c in names),
        F.size("q_words").cast("long").alias("n_words"),
        F.length(F.array_join("q_words", "")).cast("long").alias("word_chars"),
        F.regexp_count(body, F.lit("[#*$%&|<>]")).cast("long").alias("n_symbols"),
        (F.size("q_lines") - F.size(F.array_distinct("q_lines"))).cast("long").alias("n_dup_lines"),
        _hashes(F.col("q_words")).alias("q_h"),
    )
    window = F.transform(
        "q_h", lambda h, i: F.xxhash64(h, *(F.get(F.col("q_h"), i + j) for j in range(1, WINDOW)))
    )
    rows = rows.withColumns(
        {
            "q_pairs": _pairs(F.col("q_h")),
            "q_grams": F.slice(window, 1, F.greatest(F.size("q_h") - (WINDOW - 1), F.lit(0))),
        }
    )
    ordered = F.array_sort(F.transform("q_grams", lambda g, i: F.struct(g.alias("g"), i.alias("i"))))
    twice = F.size(F.array_distinct("q_grams")) < F.size("q_grams")
    rows = rows.withColumn("q_sorted", F.when(twice, ordered))
    rows = rows.withColumn("q_places", _repeated(F.col("q_sorted")))
    covered = F.aggregate(
        F.transform(
            "q_places",
            lambda p, i: F.least(F.lit(WINDOW), F.coalesce(F.get(F.col("q_places"), i + 1) - p, F.lit(WINDOW))),
        ),
        F.lit(0).cast("long"),
        lambda a, x: a + x,
    )

    def total(grams):
        return F.aggregate(grams, F.lit(0.0), lambda a, g: a + F.get(table, _bucket(g)))

    n = F.size("q_h") + F.size("q_pairs")
    score = F.when(n > 0, (total("q_h") + total("q_pairs")) / n).otherwise(F.lit(0.0))
    rows = rows.withColumns({"n_repeat_words": F.coalesce(covered, F.lit(0).cast("long")), "score": score})
    failed = (F.col("n_words") < LEAST_WORDS) | (100 * F.col("n_repeat_words") > MOST_REPEATED * F.col("n_words"))
    rows = rows.withColumn("base_failed", failed)
    return rows.select(
        *(F.col(f"`{c}`") for c in names),
        *RESULT[:5],
        "base_failed",
        "score",
        (~F.col("base_failed") & (F.col("score") >= threshold)).alias("kept"),
    )
