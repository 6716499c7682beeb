"""The registered queries at the smallest scale, and the pipeline stage by stage against plain Python."""

import os

import pytest
from pyspark.sql import functions as F

import __spark_entry__ as entry
import brute
import corpus_pipeline
from obsflow.llm.queries import ORACLE, QUERIES
from tools.compare import compare, connect

FOLDER = os.environ.get("ORACLE_SF_DIR", "/root/testdata/sf0.001")
COLUMNS = {
    "op2_bpe": {"doc_id": "bigint", "n_tokens": "bigint", "ids_sha256": "string", "decoded_sha256": "string"},
    "op7_packing": {"doc_id": "bigint", "start": "bigint", "length": "bigint", "ids_crc32": "bigint", "doc_tokens": "bigint", "sequence_id": "bigint", "offset": "bigint"},
    "op8_fingerprints": {"doc_id": "bigint", "n_chars": "bigint", "edited_sha256": "string", "fingerprint": "string", "edited_fingerprint": "string", "near_edited": "double", "near_next": "double"},
    "op9_quality_classifier": {"doc_id": "bigint", "held_out": "boolean", "score": "double", "predicted": "int"},
    "op10_toxicity": {"doc_id": "bigint", "held_out": "boolean", "score": "double", "predicted": "int"},
}


def test_all_are_registered():
    assert set(QUERIES) <= set(entry.queries()) and set(ORACLE) <= set(entry.oracle_sql())
    assert set(QUERIES) == set(ORACLE) | set(COLUMNS) | {"pipeline"}
    assert [n.split("_")[0] for n in QUERIES if n != "pipeline"] == [f"op{i}" for i in range(1, 14)]


@pytest.mark.parametrize("name", list(ORACLE))
def test_query_equals_sql(spark, name):
    count, problem = compare(spark, connect(FOLDER), FOLDER, name)
    assert not problem and count > 0


@pytest.mark.parametrize("name", list(COLUMNS))
def test_query_returns_its_columns(spark, name):
    df = QUERIES[name](spark, FOLDER)
    kinds = dict(df.dtypes)
    assert COLUMNS[name].items() <= kinds.items()
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet")
    assert df.select("doc_id").distinct().count() == docs.count()


@pytest.fixture(scope="module")
def folder(spark, documents, tmp_path_factory):
    """A folder of documents with an id each, shouted ones labelled bad, and the clashing columns."""
    path = str(tmp_path_factory.mktemp("corpus"))
    docs = documents.where("doc_id is not null").dropDuplicates(["doc_id"])
    shouted = docs.select(*[(F.col("doc_id") + 1000).alias(c) if c == "doc_id" else F.upper(c).alias(c) if c == "text" else F.col(f"`{c}`") for c in docs.columns])
    both = docs.union(shouted).withColumn("n_chars", F.length("text").cast("long"))
    both.write.parquet(f"{path}/documents.parquet")
    labels = both.select("doc_id", (F.col("doc_id") < 1000).cast("int").alias("quality"), F.lit(0).alias("toxic"))
    labels.write.parquet(f"{path}/labels.parquet")
    return path


def test_pipeline_by_stage(spark, folder, tmp_path):
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    columns = docs.columns
    assert [name for name, _ in corpus_pipeline.STAGES] == [
        "quality_classifier", "line_dedup", "ngram_jaccard_join", "substring_dedup", "packing",
    ]
    last = None
    for name, stage in corpus_pipeline.STAGES:
        before = [(r.doc_id, r.text) for r in docs.select("doc_id", "text").collect()]
        stage(spark, docs, folder).write.parquet(str(tmp_path / name))
        docs = spark.read.parquet(str(tmp_path / name))
        if name == "packing":
            last = docs
            assert docs.agg(F.sum("length")).first()[0] == docs.groupBy("doc_id").agg(F.max("doc_tokens").alias("n")).agg(F.sum("n")).first()[0]
            assert {r.doc_id for r in docs.select("doc_id").distinct().collect()} == {i for i, _ in before}
            break
        assert docs.columns == columns
        after = {r.doc_id: r.text for r in docs.select("doc_id", "text").collect()}
        assert docs.where("n_chars <> length(text)").count() == 0
        if name == "quality_classifier":
            assert after.items() <= dict(before).items()
            assert sum(i < 1000 for i in after) > 0.8 * sum(i < 1000 for i, _ in before)
        if name == "line_dedup":
            want = brute.lines(before)
            assert after == {i: want[i, t][0] for i, t in before if not want[i, t][1] or brute.words(want[i, t][0])}
        if name == "ngram_jaccard_join":
            want = brute.components(before, percent=80, k=5)
            assert set(after) == {row[0] for row, (size, group) in zip(before, want) if not size or row[0] == min(i for i, _ in group)}
        if name == "substring_dedup":
            want = brute.substring(before, lambda r: r[0])
            assert set(after) == {row[0] for row, (n, gone, _) in want.items() if not gone or n > gone}
            assert all(len(brute.words(after[row[0]])) == n - gone for row, (n, gone, _) in want.items() if row[0] in after)
    whole = corpus_pipeline.run(spark, folder)
    assert sorted(map(str, whole.select("doc_id", "start", "ids_crc32").collect())) == sorted(map(str, last.select("doc_id", "start", "ids_crc32").collect()))


def test_stages_on_an_empty_table(spark, folder, empty):
    for _, stage in corpus_pipeline.STAGES:
        assert stage(spark, empty, folder).count() == 0
