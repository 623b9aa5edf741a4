"""Registered queries against their SQL; native queries without Python; dialogues; the pipeline stage by stage."""

import pytest
from pyspark.sql import functions as F

import __spark_entry__ as entry
import corpus_pipeline
import oracle
from stratalake.llm import catalogue
from stratalake.llm.chat import perspectives
from stratalake.sources.storage import stored

SF_DIR = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def duck():
    return oracle.connect(SF_DIR)


def test_all_operators_and_the_pipeline_are_registered():
    names = set(entry.queries())
    assert all(sum(n.startswith(f"op{i}_") for n in names) == 1 for i in range(1, 14)) and "pipeline" in names


@pytest.mark.parametrize("name", sorted(catalogue.SQL))
def test_query_matches_its_sql(spark, duck, name):
    df = catalogue.QUERIES[name](spark, SF_DIR)
    assert oracle.differences(df, duck, catalogue.SQL[name]) == []
    if name.split("_")[0] in ("op1", "op4", "op6"):
        plan = df._jdf.queryExecution().executedPlan().toString()
        assert not any(x in plan for x in ("Python", "Arrow", "Pandas"))


def test_perspectives(spark, rows):
    turns = [(1, 2, "bob", "hi"), (1, 1, "amy", "hello"), (1, 0, "system", "be kind"), (1, 3, None, None), (1, 2, "bob", "hi"), (2, 0, "system", "alone"), (3, None, "amy", "x" * 50_000)]
    df = spark.createDataFrame(turns, "conv_id int, turn int, role string, text string").withColumns({"part": F.lit(1), "perspective": F.lit("z")})
    got = {(r["conv_id"], r["perspective"], r["part"]): r for r in perspectives(df, part_turns=2).collect()}
    assert set(got) == {(1, p, k) for p in ("amy", "bob", "unknown") for k in (0, 1)} | {(3, "amy", -1)}
    for person in ("amy", "bob", "unknown"):
        text = got[1, person, 0]["rendered"] + got[1, person, 1]["rendered"]
        mask = ",".join(m for k in (0, 1) if (m := got[1, person, k]["mask"]))
        trained = [text[int(a) : int(b)] for a, b in (x.split("-") for x in mask.split(","))]
        want = {"amy": ["hello"], "bob": ["hi", "hi"], "unknown": [""]}[person]
        assert trained == [f"{t}\n<|end|>\n" for t in want]
        assert text.startswith("<|system|>\nbe kind\n<|end|>\n") and text.count("<|assistant|>") == len(want)
    assert perspectives(df.limit(0)).collect() == []


def test_pipeline(spark):
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet")
    first = docs
    for name, stage in corpus_pipeline.STAGES[:-1]:
        after = stored(stage(spark, docs, SF_DIR), name)
        assert after.dtypes == first.dtypes
        before, left = {r["doc_id"] for r in docs.collect()}, {r["doc_id"]: r for r in after.collect()}
        assert len(left) == after.count() and set(left) <= before and len(left) > 0.85 * len(before)
        assert all(r["n_chars"] == len(r["text"]) for r in left.values()) or name != "repeated_passages"
        docs = after
    from stratalake.llm.decontamination import contaminated
    from stratalake.llm.jaccard import jaccard_components
    from stratalake.llm.parsing import repeat_digest

    assert jaccard_components(docs).filter("doc_id <> component_id AND n_shingles > 200").isEmpty()
    assert repeat_digest(docs).filter("n_removed > 1000").isEmpty()
    assert contaminated(docs, spark.read.parquet(f"{SF_DIR}/benchmark.parquet")).isEmpty()
    packed = corpus_pipeline.STAGES[-1][1](spark, docs, SF_DIR)
    assert packed.groupBy("sequence_id").agg(F.sum("length").alias("n")).filter("n > 1024").isEmpty()
    assert packed.select("doc_id").distinct().count() == docs.count()
    empty = docs.limit(0)
    for _, stage in corpus_pipeline.STAGES:
        assert stage(spark, empty, SF_DIR).collect() == []
