"""One query per operator, over its whole table with production parameters, and the SQL of those SQL can express."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import functions as F

from obsflow.llm import sharding, sql
from obsflow.llm.blocks import shipped
from obsflow.llm.bpe import bpe_decode, bpe_encode
from obsflow.llm.collocations import collocations
from obsflow.llm.divergence import divergence
from obsflow.llm.fingerprints import fingerprints
from obsflow.llm.line_dedup import dedup_lines
from obsflow.llm.labelled import held_out
from obsflow.llm.near_vectors import near_vectors
from obsflow.llm.ngram_join import jaccard_components
from obsflow.llm.packing import pack_sequences
from obsflow.llm.quality import fit_quality, score_quality
from obsflow.llm.substring_dedup import dedup_substrings
from obsflow.llm.topk import top_k
from obsflow.llm.toxicity import fit_toxicity, score_toxicity

VOCABULARY = public_tokenizers.path("byte_bpe_50k.json")


def _table(spark, folder, name):
    return shipped(spark).read.parquet(f"{folder}/{name}.parquet")


def op1_substring_dedup(spark, folder):
    """Words outside windows of 20 words seen earlier, per document."""
    kept = dedup_substrings(_table(spark, folder, "documents").select("doc_id", "text"))
    return kept.select(
        "doc_id",
        F.col("_n_words").alias("n_words"),
        F.col("_n_removed").alias("n_removed"),
        F.col("_kept_sha256").alias("kept_sha256"),
    )


def op2_bpe(spark, folder):
    """Token ids of every text and the text they decode to."""
    encoded = bpe_encode(_table(spark, folder, "documents").select("doc_id", "text"), VOCABULARY).drop("text")
    return bpe_decode(encoded, VOCABULARY).select(
        "doc_id",
        (F.octet_length("_ids") / 4).cast("long").alias("n_tokens"),
        F.sha2("_ids", 256).alias("ids_sha256"),
        F.sha2(F.col("_decoded").cast("binary"), 256).alias("decoded_sha256"),
    )


def op3_line_dedup(spark, folder):
    """Lines that are similar to no earlier line, per document."""
    docs = _table(spark, folder, "documents").select("doc_id", "text")
    docs = docs.withColumn("n_lines", F.size(F.split(F.coalesce("text", F.lit("")), "\n")).cast("long"))
    return dedup_lines(docs).select(
        "doc_id",
        "n_lines",
        F.col("_n_removed").alias("n_removed"),
        F.sha2(F.coalesce("text", F.lit("")).cast("binary"), 256).alias("kept_sha256"),
    )


def op4_ngram_jaccard_join(spark, folder):
    """Components of documents that share nine tenths of their three-word shingles."""
    return jaccard_components(_table(spark, folder, "documents"), shingle=3, percent=90)


def op5_sharding(spark, folder):
    """The shard of every document."""
    placed = sharding.place(_table(spark, folder, "documents").select("doc_id"))
    return placed.select("doc_id", F.col("_slot").alias("slot"), F.col("_shard").alias("shard"))


def op6_top_k(spark, folder):
    """The five best scores among all vectors for every fiftieth one."""
    vectors = _table(spark, folder, "embeddings").select("vec_id", "embedding")
    return top_k(vectors, vectors.where("vec_id % 50 = 0"), k=5)


def op7_packing(spark, folder):
    """All documents in sequences of at most 2048 tokens."""
    pieces = pack_sequences(_table(spark, folder, "documents"), VOCABULARY, window=2048, end=1)
    return pieces.withColumn("ids_crc32", F.crc32("ids")).drop("ids")


def op8_fingerprints(spark, folder):
    """Fingerprints of all documents and of their edited texts."""
    return fingerprints(_table(spark, folder, "documents"))


def _scored(scored, modulus, remainder):
    return scored.select(
        "doc_id",
        held_out(F.col("doc_id"), modulus, remainder).alias("held_out"),
        F.col("_score").alias("score"),
        F.col("_predicted").alias("predicted"),
    )


def op9_quality_classifier(spark, folder):
    """Quality of every document, learnt from labels of those that are not held out."""
    docs, labels = (_table(spark, folder, t) for t in ("documents", "labels"))
    docs = docs.select("doc_id", "text")
    model = fit_quality(docs, labels, out=lambda c: held_out(c, 5, 0))
    return _scored(score_quality(docs, model, threshold=0.3), 5, 0)


def op10_toxicity(spark, folder):
    """Toxicity of every document, learnt from labels of those that are not held out."""
    docs, labels = (_table(spark, folder, t) for t in ("documents", "labels"))
    docs = docs.select("doc_id", "text")
    model = fit_toxicity(docs, labels, out=lambda c: held_out(c, 3, 1))
    return _scored(score_toxicity(docs, model, threshold=0.7), 3, 1)


def op11_source_divergence(spark, folder):
    """Divergence of every two sources of a language, and the terms each source overuses."""
    return divergence(_table(spark, folder, "documents").select("text", "lang", "source"))


def op12_collocations(spark, folder):
    """The 2,000 phrases of each language with the highest scores."""
    return collocations(_table(spark, folder, "documents").select("text", "lang"))


def op13_near_vectors(spark, folder):
    """Links and components of embeddings with one label and a cosine of 0.93 or more."""
    return near_vectors(_table(spark, folder, "embeddings"), threshold=0.93)


def pipeline(spark, folder):
    """All stages of the corpus pipeline."""
    import corpus_pipeline

    return corpus_pipeline.run(shipped(spark), folder)


QUERIES = {
    "op1_substring_dedup": op1_substring_dedup,
    "op2_bpe": op2_bpe,
    "op3_line_dedup": op3_line_dedup,
    "op4_ngram_jaccard_join": op4_ngram_jaccard_join,
    "op5_sharding": op5_sharding,
    "op6_top_k": op6_top_k,
    "op7_packing": op7_packing,
    "op8_fingerprints": op8_fingerprints,
    "op9_quality_classifier": op9_quality_classifier,
    "op10_toxicity": op10_toxicity,
    "op11_source_divergence": op11_source_divergence,
    "op12_collocations": op12_collocations,
    "op13_near_vectors": op13_near_vectors,
    "pipeline": pipeline,
}

ORACLE = {
    "op1_substring_dedup": sql.OP1,
    "op3_line_dedup": sql.OP3,
    "op4_ngram_jaccard_join": sql.OP4,
    "op5_sharding": sharding.place_sql("documents", "doc_id", sharding.SHARDS, sharding.SLOTS),
    "op6_top_k": sql.OP6,
    "op11_source_divergence": sql.OP11,
    "op12_collocations": sql.OP12,
    "op13_near_vectors": sql.OP13,
}
