import duckdb

import __spark_entry__ as entry
import corpus_pipeline
from wardlight.llm import decontaminate, queries, simhash, toxicity

SF = "/root/testdata/sf0.001"
OPERATORS = {f"op{n}_" for n in range(1, 11)}


def test_every_operator_is_registered():
    assert {name.split("_")[0] + "_" for name in queries.QUERIES} == OPERATORS
    assert {*queries.QUERIES, "pipeline"} <= set(entry.queries())


def test_exact_dedup_matches_its_sql(spark, rows):
    got = rows(queries.QUERIES["op8_exact_dedup"](spark, SF), "doc_id", "keep_id", "group_size", "kept", "text_sha256")
    sql = queries.ORACLE["op8_exact_dedup"].replace("FROM documents", f"FROM '{SF}/documents.parquet'")
    want = duckdb.sql(f"SELECT doc_id, keep_id, group_size, kept, text_sha256 FROM ({sql})").fetchall()
    assert got == sorted(want, key=repr)


def test_every_query_gives_each_document_once(spark):
    n = spark.read.parquet(f"{SF}/documents.parquet").count()
    for name in ("op3_sentencepiece", "op5_toxicity", "op6_secrets", "op7_simhash", "op9_langid", "op10_substrings"):
        ids = [r["doc_id"] for r in queries.QUERIES[name](spark, SF).select("doc_id").collect()]
        assert len(ids) == len(set(ids)) == n, name
    assert queries.QUERIES["op3_sentencepiece"](spark, SF).filter("NOT round_trip").count() == 0


def test_stages_take_effect_and_keep_the_rest(spark, odd):
    """Each stage by itself, then all against the rows that plain rules leave."""
    docs = spark.read.parquet(f"{SF}/documents.parquet").unionByName(odd.filter("doc_id < 5").selectExpr("doc_id + 10000 AS doc_id", "text", "lang", "source", "n_chars"))
    left = docs
    for k, (name, stage) in enumerate(corpus_pipeline.STAGES):
        before = {r["doc_id"]: r for r in left.collect()}
        if name == "toxicity":
            model = toxicity.fit(left, spark.read.parquet(f"{SF}/labels.parquet"))
            want = {r["doc_id"] for r in toxicity.score(left, model).collect() if r["score"] < toxicity.THRESHOLD}
        elif name == "exact_dedup":
            want = set({(r["text"] or ""): i for i, r in sorted(before.items())}.values())
        elif name == "simhash_dedup":
            want = {r["component_id"] for r in simhash.near_groups(left).collect()}
        elif name == "decontamination":
            want = set(before) - {r["doc_id"] for r in decontaminate.leaks(left, spark.read.parquet(f"{SF}/benchmark.parquet")).collect()}
        else:
            want = set(before)
        out = stage(spark, left, SF)
        got = out.collect()
        assert {r["doc_id"] for r in got} == want and len(got) == len(want), name
        if k < len(corpus_pipeline.STAGES) - 1:
            assert out.columns == docs.columns
            assert all(tuple(r) == tuple(before[r["doc_id"]]) for r in got), name
            left = spark.createDataFrame(got, docs.schema)


def test_run(spark):
    out = corpus_pipeline.run(spark, SF)
    assert out.columns == ["doc_id", "lang", "source", "ids", "n_tokens"]
    assert 0 < out.count() < 200
