"""A training corpus from raw documents: quality, line dedup, near duplicates, substring dedup, packing.

Every stage takes (spark, docs, sf_dir), works on all that the one before kept, and
returns the columns of ``docs``; the last returns pieces of token sequences.
``run`` writes each result as Parquet to the shared folder and reads it again, so a lost
executor costs a part of one stage.
"""

import public_tokenizers
from pyspark.sql import functions as F

from obsflow.llm.line_dedup import dedup_lines
from obsflow.llm.ngram_join import one_of_each
from obsflow.llm.packing import pack_sequences
from obsflow.llm.quality import fit_quality, score_quality
from obsflow.llm.substring_dedup import dedup_substrings
from obsflow.session import materialise

VOCABULARY = public_tokenizers.path("byte_bpe_50k.json")
THRESHOLD = 0.3
LINE_PERCENT = 80
SHINGLE, PERCENT = 5, 80
WINDOW_WORDS = 20
WINDOW_TOKENS = 2048

#: No SQL: the stages learn a model and encode tokens.
ORACLE_SQL = None


def _recounted(docs, columns):
    """The given columns; ``n_chars``, where there is one, counts the text as it is now."""
    if "n_chars" in columns:
        docs = docs.withColumn("n_chars", F.length("text").cast("long"))
    return docs.select(*(F.col(f"`{c}`") for c in columns))


def _with_words():
    return F.coalesce(F.col("text"), F.lit("")).rlike(r"[^\x20\x09-\x0D]")


def quality_classifier(spark, docs, sf_dir):
    """Documents that the classifier accepts."""
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    scored = score_quality(docs, fit_quality(docs, labels), THRESHOLD)
    return scored.where("_predicted = 1").select(*(F.col(f"`{c}`") for c in docs.columns))


def line_dedup(spark, docs, sf_dir):
    """Documents without repeated lines; one of which no word is left goes."""
    kept = dedup_lines(docs, LINE_PERCENT)
    return _recounted(kept.where((F.col("_n_removed") == 0) | _with_words()), docs.columns)


def ngram_jaccard_join(spark, docs, sf_dir):
    """One document of each group of near duplicates."""
    return one_of_each(docs, SHINGLE, PERCENT)


def substring_dedup(spark, docs, sf_dir):
    """Documents without passages seen earlier; one of which no word is left goes."""
    kept = dedup_substrings(docs, WINDOW_WORDS)
    return _recounted(kept.where((F.col("_n_removed") == 0) | _with_words()), docs.columns)


def packing(spark, docs, sf_dir):
    """Pieces of token sequences, with the checksum of their ids."""
    return pack_sequences(docs, VOCABULARY, WINDOW_TOKENS).withColumn("ids_crc32", F.crc32("ids"))


STAGES = [
    ("quality_classifier", quality_classifier),
    ("line_dedup", line_dedup),
    ("ngram_jaccard_join", ngram_jaccard_join),
    ("substring_dedup", substring_dedup),
    ("packing", packing),
]


def run(spark, sf_dir):
    """All stages over ``documents``."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = materialise(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
