"""The operators as queries over the benchmark tables, with production parameters."""

from __future__ import annotations

import public_tokenizers
import sentencepiece
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from waybill import session
from waybill.llm import (
    bpe,
    jaccard,
    language,
    licenses,
    merkle,
    mixing,
    neighbours,
    phrases,
    prefix,
    quality,
    repeats,
    secrets,
    simhash,
)
from waybill.llm.common import written

QUERIES, ORACLE = {}, {}
TOKEN_LIMIT = 4096


def query(f):
    QUERIES[f.__name__] = f
    return f


def documents(spark: SparkSession, sf_dir: str, *columns: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet").select(*columns)


@query
def op1_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Encode every text by the ranks, decode the ids, and give the digests of both."""
    ranks = bpe.read_ranks(public_tokenizers.path("byte_bpe_50k.tiktoken"))
    coded = bpe.encode(documents(spark, sf_dir, "doc_id", "text"), ranks).drop("text")
    return bpe.decode(coded, ranks).select(
        "doc_id",
        F.size("ids").cast("long").alias("n_tokens"),
        F.sha2(F.array_join(F.col("ids").cast("array<string>"), " "), 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )


@query
def op7_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents, and the words that the mix takes of each."""
    measured = mixing.measure(documents(spark, sf_dir, "doc_id", "source", "text"))
    sizes = written(measured.select("doc_id", "source", "size", "mix_u"), "mix-sizes")
    return mixing.take(sizes, mixing.plan(sizes)).select("doc_id", "size", "source_size", "target", "taken")


ORACLE["op7_mix"] = r"""
WITH sized AS (
  SELECT doc_id, source,
    CASE WHEN text IS NULL THEN 0 ELSE len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')) END::BIGINT AS size,
    (('0x' || substr(md5('mix:' || coalesce(doc_id::VARCHAR, '') || ':' || coalesce(text, '')), 1, 13))::BIGINT
      + 0.5::DOUBLE) / 4503599627370496::DOUBLE AS u
  FROM documents),
sources AS (
  SELECT source, sum(size)::BIGINT AS source_size,
    row_number() OVER (ORDER BY source NULLS LAST) - 1 AS place
  FROM sized GROUP BY source),
weighed AS (
  SELECT *, (CASE place % 3 WHEN 0 THEN 5 WHEN 1 THEN 2 ELSE 1 END)::DOUBLE AS w, 2 * source_size::DOUBLE AS cap
  FROM sources),
rates AS (
  SELECT *, (sum(source_size) OVER ()::DOUBLE * 1.5::DOUBLE - coalesce(sum(cap) OVER earlier, 0))
    / (sum(w) OVER () - coalesce(sum(w) OVER earlier, 0)) AS rate
  FROM weighed
  WINDOW earlier AS (ORDER BY cap / w, place ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
shares AS (
  SELECT source, source_size, least(cap, w * max(rate) OVER ()) AS target FROM rates),
chances AS (
  SELECT s.doc_id, s.size, s.u, h.*,
    CASE WHEN source_size > 0 THEN target / source_size::DOUBLE ELSE 0::DOUBLE END AS e
  FROM sized s JOIN shares h ON s.source IS NOT DISTINCT FROM h.source),
odds AS (
  SELECT *, CASE WHEN e > floor(e) THEN (u / (1 - u)) / ((e - floor(e)) / (1 - (e - floor(e)))) END AS q
  FROM chances),
ranked AS (
  SELECT *, floor(q / (1 + q) * 4503599627370496::DOUBLE) AS k, target - floor(e) * source_size AS rest FROM odds),
grouped AS (
  SELECT source, k, any_value(rest) AS rest, sum(size)::DOUBLE AS words FROM ranked
  WHERE k IS NOT NULL GROUP BY source, k),
counted AS (
  SELECT *, sum(words) OVER (PARTITION BY source ORDER BY k) - words AS before FROM grouped)
SELECT r.doc_id, r.size, r.source_size, r.target,
  (r.size * (floor(r.e) + CASE WHEN c.before + c.words / 2 <= c.rest THEN 1 ELSE 0 END))::BIGINT AS taken
FROM ranked r LEFT JOIN counted c ON r.source IS NOT DISTINCT FROM c.source AND r.k = c.k
"""


@query
def op2_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Tokens of every text, and how much of it fits into the budget."""
    pieces = prefix.vocabulary(public_tokenizers.path("piece_bpe_32k.model"))
    counted = prefix.count_tokens(documents(spark, sf_dir, "doc_id", "text"), pieces, TOKEN_LIMIT)
    return counted.select(
        "doc_id", "n_bytes", "n_tokens", (F.col("n_tokens") > TOKEN_LIMIT).alias("over_limit"), "fit_chars"
    )


def letter_pieces() -> list[str]:
    """The fixed vocabulary of the language model."""
    model = sentencepiece.SentencePieceProcessor(model_file=public_tokenizers.path("piece_bpe_32k.model"))
    return [model.id_to_piece(i) for i in range(model.get_piece_size())]


@query
def op4_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Learn from two thirds of the documents, predict all."""
    docs = documents(spark, sf_dir, "doc_id", "text", "lang")
    model = language.learn(docs.filter(~language.held_out(F.col("doc_id"))), letter_pieces())
    return language.predict(docs.drop("lang"), model).select(
        "doc_id", language.held_out(F.col("doc_id")).alias("held_out"), "lang_pred", "score"
    )


@query
def op10_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Scan all blobs into a new ledger and give every document its findings."""
    ledger = session.work_dir(spark, "secret-ledger")
    found = secrets.scan(documents(spark, sf_dir, "doc_id", "text"), ledger)
    kinds = [r.kind for r in secrets.BASE]
    base = F.filter("spans", lambda s: s["kind"].isin(kinds))

    def joined(spans):
        return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")

    def number(kind):
        return F.size(F.filter("spans", lambda s: s["kind"] == kind)).cast("long").alias(f"n_{kind}")

    return found.select(
        "doc_id",
        *(number(kind) for kind in kinds),
        F.sha2(joined(base), 256).alias("base_sha256"),
        joined("spans").alias("spans"),
    )


@query
def op8_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Counts and verdict of every document; the target are the documents labelled good."""
    docs = documents(spark, sf_dir, "doc_id", "text")
    trusted = quality.trusted_ids(spark.read.parquet(f"{sf_dir}/labels.parquet"))
    return quality.rules(docs, quality.weights(docs, trusted)).drop("text")


@query
def op3_nearest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The 20 rows of largest inner product with each twentieth vector."""
    vectors = spark.read.parquet(f"{sf_dir}/embeddings.parquet")
    return neighbours.search(vectors, F.col("vec_id") % 20 == 0, 20)


@query
def op5_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Phrases and license texts in every document."""
    return licenses.scan(documents(spark, sf_dir, "doc_id", "text")).drop("spans")


@query
def op6_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The component of every document among those that share nine tenths of their shingles."""
    docs = documents(spark, sf_dir, "doc_id", "text").withColumn("row", F.monotonically_increasing_id())
    return jaccard.groups(docs).select("doc_id", "n_shingles", "component_id")


@query
def op9_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What is left of every document without passages of earlier ones."""
    docs = documents(spark, sf_dir, "doc_id", "text").withColumn("row", F.monotonically_increasing_id())
    return repeats.remove(docs).select("doc_id", "n_words", "n_removed", F.sha2("kept", 256).alias("kept_sha256"))


@query
def op11_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The fingerprint of every document and its component among those that differ in two bits at most."""
    return simhash.groups(documents(spark, sf_dir, "doc_id", "text"))


@query
def op12_merkle_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Leaf, tops and proof of every document, and the root that a tampered copy folds to."""
    return merkle.manifest(documents(spark, sf_dir, *merkle.FIELDS))


ORACLE["op12_merkle_manifest"] = r"""
WITH RECURSIVE
crc_table AS (
  SELECT list_transform(range(256), lambda i: list_reduce([i, 0, 0, 0, 0, 0, 0, 0, 0],
    lambda c, x: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END)) AS t),
drawn AS (
  SELECT d.*, coalesce(xor(list_reduce(
      list_concat([4294967295::BIGINT], list_transform(string_split(doc_id::VARCHAR, ''), lambda c: ascii(c)::BIGINT)),
      lambda c, b: xor(t[(xor(c, b) & 255) + 1], c >> 8)), 4294967295) % 5 = 0, false) AS drawn
  FROM documents d, crc_table),
texts AS (
  SELECT *, CASE WHEN drawn THEN translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')
    ELSE text END AS changed FROM drawn),
heads AS (
  SELECT *, coalesce(strlen(doc_id::VARCHAR) || ':' || doc_id, '-') || coalesce(strlen(source) || ':' || source, '-')
    || coalesce(strlen(lang) || ':' || lang, '-') || coalesce(strlen(n_chars::VARCHAR) || ':' || n_chars, '-') AS head
  FROM texts),
leaves AS (
  SELECT doc_id, source, sha256(head || coalesce(strlen(text) || ':' || text, '-')) AS leaf,
    sha256(head || coalesce(strlen(changed) || ':' || changed, '-')) AS start FROM heads),
placed AS (
  SELECT *, (dense_rank() OVER (ORDER BY source NULLS FIRST) - 1)::BIGINT AS tree,
    (row_number() OVER (PARTITION BY source ORDER BY doc_id NULLS FIRST, leaf) - 1)::BIGINT AS pos,
    count(*) OVER (PARTITION BY source) AS n FROM leaves),
levels AS (
  SELECT tree, 0 AS level, pos, n, leaf AS hash FROM placed
  UNION ALL
  SELECT tree, level + 1, pos // 16, (n + 15) // 16, sha256(string_agg(hash, '' ORDER BY pos))
  FROM levels WHERE n > 1 GROUP BY tree, level, pos // 16, n),
uppers AS (
  SELECT -1::BIGINT AS tree, 0 AS level, tree AS pos, count(*) OVER () AS n, hash FROM levels WHERE n = 1
  UNION ALL
  SELECT tree, level + 1, pos // 16, (n + 15) // 16, sha256(string_agg(hash, '' ORDER BY pos))
  FROM uppers WHERE n > 1 GROUP BY tree, level, pos // 16, n),
kids AS (
  SELECT tree, level + 1 AS level, pos // 16 AS pos, (n + 15) // 16 AS n, string_agg(hash, '' ORDER BY pos) AS kids
  FROM (FROM levels UNION ALL FROM uppers) WHERE n > 1 GROUP BY tree, level, pos // 16, n),
climb AS (
  SELECT tree AS own, pos AS place, tree, 0 AS level, pos, n, start AS fold, '' AS path FROM placed
  UNION ALL
  SELECT c.own, c.place, k.tree, k.level, k.pos, k.n,
    sha256(substr(k.kids, 1, (64 * (c.pos % 16))::INT) || c.fold || substr(k.kids, (64 * (c.pos % 16) + 65)::INT)),
    c.path || substr(k.kids, 1, (64 * (c.pos % 16))::INT) || substr(k.kids, (64 * (c.pos % 16) + 65)::INT)
  FROM (
    SELECT * FROM climb WHERE n > 1
    UNION ALL
    SELECT own, place, -1, 0, tree, 2, fold, path FROM climb WHERE n = 1 AND tree >= 0) c
  JOIN kids k ON k.tree = c.tree AND k.level = c.level + 1 AND k.pos = c.pos // 16),
root AS (SELECT hash AS root FROM uppers WHERE n = 1),
ended AS (
  SELECT c.*, root FROM climb c, root WHERE n = 1 AND (tree = -1 OR (SELECT max(n) FROM uppers) = 1))
SELECT p.doc_id, p.leaf, l.hash AS subroot, e.root, sha256(e.path) AS proof_sha256, e.fold AS folded_root,
  e.fold = e.root AS verified
FROM placed p
JOIN ended e ON e.own = p.tree AND e.place = p.pos
JOIN (SELECT tree, hash FROM levels WHERE n = 1) l ON l.tree = p.tree
"""


@query
def op13_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The phrases of each language that hold together best."""
    return phrases.collocations(documents(spark, sf_dir, "lang", "text"))


ORACLE["op13_collocations"] = r"""
WITH pieces AS (
  SELECT coalesce(lang, 'und') AS lang, regexp_extract_all(piece, '[^\x20\x09]+') AS w
  FROM (SELECT lang, unnest(regexp_split_to_array(
    translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\x0A-\x0D]')) AS piece FROM documents)),
grams AS (
  SELECT lang, k, array_to_string(unnest(list_transform(range(1, len(w) - k + 2), lambda i: w[i:i + k - 1])), ' ') AS phrase
  FROM pieces, (SELECT unnest([1, 2, 3, 4])::INT AS k)),
counted AS (SELECT lang, k, phrase, string_split(phrase, ' ') AS w, count(*) AS f FROM grams GROUP BY ALL),
totals AS (SELECT lang, sum(f)::BIGINT AS n FROM counted WHERE k = 1 GROUP BY lang),
candidates AS (SELECT lang, k, phrase, w, f AS a FROM counted WHERE k > 1 AND f >= 30),
cuts AS (
  SELECT c.lang, c.k, c.phrase, c.a, x.f AS l, y.f AS r, place,
    (2000000::HUGEINT * c.a // (x.f::HUGEINT + y.f))::BIGINT AS score
  FROM (SELECT *, unnest(range(1, k)) AS place FROM candidates) c
  JOIN counted x ON x.lang = c.lang AND x.phrase = array_to_string(c.w[1:place], ' ')
  JOIN counted y ON y.lang = c.lang AND y.phrase = array_to_string(c.w[place + 1:], ' ')),
best AS (SELECT * FROM cuts QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, place) = 1),
parts AS (
  SELECT lang, array_to_string(w[i:i + size - 1], ' ') AS phrase, a AS longer
  FROM (SELECT *, unnest(range(1, k - size + 2)) AS i
    FROM (SELECT *, unnest(range(2, k)) AS size FROM candidates WHERE k > 2))),
covered AS (SELECT lang, phrase, max(longer) AS longer FROM parts GROUP BY ALL),
kept AS (
  SELECT b.* FROM best b LEFT JOIN covered c USING (lang, phrase)
  WHERE c.longer IS NULL OR 100::HUGEINT * c.longer < 80::HUGEINT * b.a)
SELECT lang, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank, phrase, a, l, r, n, score
FROM kept JOIN totals USING (lang) QUALIFY rank <= 2000
"""
