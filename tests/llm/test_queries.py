"""Registered queries and the pipeline on the smallest tables."""

import os

import pytest

pytest.importorskip("public_tokenizers")
SF = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="no test tables")


def test_mix_is_its_sql(spark):
    from tests.check_oracle import compare, oracle_connection
    from waybill.llm.queries import ORACLE, QUERIES

    for name, sql in ORACLE.items():
        assert compare(spark, oracle_connection(SF), QUERIES[name], sql, SF) is None


def test_every_query_answers_every_document(spark):
    from waybill.llm.queries import QUERIES

    ids = {r.doc_id for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}
    for name in ("op4_language_id", "op5_license_scan", "op10_secret_scan"):
        assert {r.doc_id for r in QUERIES[name](spark, SF).collect()} == ids


def test_held_out_languages(spark):
    from waybill.llm.queries import op4_language_id

    docs = {r.doc_id: r for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}
    rows = [r for r in op4_language_id(spark, SF).collect() if r.held_out and docs[r.doc_id].lang and r.score]
    assert sum(docs[r.doc_id].lang == r.lang_pred for r in rows) >= 0.97 * len(rows)


def test_native_operators_have_no_python(spark):
    from waybill.llm.queries import op7_mix, op8_quality_rules

    for query in (op7_mix, op8_quality_rules):
        plan = query(spark, SF)._jdf.queryExecution().executedPlan().toString()
        assert not any(x in plan for x in ("Python", "Pandas", "Arrow"))


def test_language_stage_rejects_what_it_has_not_learned(spark):
    import random

    import corpus_pipeline

    docs, rnd = spark.read.parquet(f"{SF}/documents.parquet"), random.Random(1)
    noise = " ".join("".join(rnd.choice("abcdefghijklmnopqrstuvwxyz") for _ in range(rnd.randint(2, 9))) for _ in range(200))
    finnish = "Suomen kieli on uralilaisten kielten itämerensuomalaiseen ryhmään kuuluva kieli, jota puhuvat pääosin suomalaiset"
    odd = ["qwxz zzkq vvxq jjqk wxqz kkzz qqxv", noise, finnish, "我们 都是 好人", None, "1234 !!"]
    clean = ["The house is on the hill and we are going there", "Der Hund ist im Haus und wir gehen nach Hause"]
    rows = [(-i, t, None, "src0", None) for i, t in enumerate(odd + clean, 1)]
    made = corpus_pipeline.known_language(spark, docs.unionByName(spark.createDataFrame(rows, docs.schema)), SF)
    kept = {r.doc_id for r in made.select("doc_id").collect()}
    assert {i for i in kept if i < 0} == {-7, -8}
    lettered = docs.filter("text rlike '[a-zA-Z]'").count()
    assert sum(i >= 0 for i in kept) >= 0.99 * lettered


def test_pipeline_stages(spark, tmp_path):
    import corpus_pipeline
    import tiktoken
    from public_tokenizers import PATTERN, path
    from waybill.llm import bpe

    docs, kept = spark.read.parquet(f"{SF}/documents.parquet"), {}
    text = "The password: hunter2hunter2 is in the house, and that was not the plan."
    extra = spark.createDataFrame([(1 << 40, text, "en", "src0", len(text))], docs.schema)
    docs = docs.unionByName(extra)
    for name, stage in corpus_pipeline.STAGES:
        made = stage(spark, docs, SF)
        if name != "tokens":
            assert made.columns == docs.columns
        made.write.parquet(str(tmp_path / name.replace(" ", "_")))
        kept[name] = docs, docs.sparkSession.read.parquet(str(tmp_path / name.replace(" ", "_")))
        docs = kept[name][1]
    before, after = kept["near copies"]
    assert after.count() == after.select("doc_id").distinct().count() < before.count()
    before, after = kept["secrets"]
    assert before.count() == after.count()
    texts = {r.doc_id: r.text for r in before.collect()}
    changed = [r for r in after.collect() if r.text != texts[r.doc_id]]
    assert changed and all(len(r.text) == len(texts[r.doc_id]) for r in changed)
    before, after = kept["tokens"]
    ranks = bpe.read_ranks(path("byte_bpe_50k.tiktoken"))
    known = tiktoken.Encoding("own", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={})
    texts = {r.doc_id: r.text for r in before.collect()}
    assert all(r.ids == known.encode_ordinary(texts[r.doc_id]) for r in after.collect())
    assert before.count() == after.count()
