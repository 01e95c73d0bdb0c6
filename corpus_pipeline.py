"""The training-corpus pipeline: five operators, each on all that the one before kept.

Every stage takes (spark, docs, sf_dir) and returns a DataFrame; all but the
last return documents with their columns. ``run`` applies them in order and
writes what each keeps to the shared folder before the next one reads it.

Documents without a language (no text, or no letter in it) go first; then
copies, then near copies but for one of each group. Sources are then mixed to
flatter weights, where small ones repeat up to one and a half times and none
loses a document, and what is drawn is packed into sequences. Null texts, keys
and sources, repeated rows and empty tables have the results that the
operators state.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from chorale.llm import exact, jaccard, langid, mixing, packing
from chorale.llm.common import table
from chorale.session import materialize


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in which a language is found; learnt from all labelled ones."""
    return langid.identified(docs, langid.fit(docs))


def exact_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of texts equal but for white space, the one with the least key."""
    return exact.unique(docs)


def ngram_jaccard(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group linked by 80 percent of five-word shingles."""
    return jaccard.representatives(docs, words=5, share=80)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the mixture draws them, each once at least."""
    return mixing.mixed(docs, max_repetition=1.5)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of token ids with their places in sequences of 1024."""
    import public_tokenizers

    files = map(public_tokenizers.path, ("byte_bpe_50k.json", "byte_bpe_50k.tiktoken"))
    return packing.packed(packing.tokenized(docs, *files)).withColumnRenamed("key", "doc_id")


STAGES = [
    ("language_id", language_id),
    ("exact_dedup", exact_dedup),
    ("ngram_jaccard", ngram_jaccard),
    ("mix_sources", mix_sources),
    ("packing", pack),
]
# Language ID and tokenizing have no SQL; tests hold the pipeline against a brute-force version.
ORACLE_SQL: str | None = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The rows of the last stage for the documents of ``sf_dir``."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = materialize(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
