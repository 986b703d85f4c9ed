"""A training corpus from raw documents, in five stages, each an operator of ``podium.llm``.

Every stage takes (spark, docs, sf_dir). All but the last return the columns of ``documents``.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from podium.llm.common import ship, stored
from podium.llm.decontamination import uncontaminated
from podium.llm.languages import accepted
from podium.llm.minhash import without_duplicates
from podium.llm.mixing import mixed_documents
from podium.llm.tokens import write_and_read


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in a language the corpus knows. Null and blank texts go; so do all rows if none has a language; repeated
    rows are judged alike. No documents, here and in the stages below, give none; extra columns pass unread."""
    ship(spark)
    return accepted(docs, declared="lang", host="source")


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-duplicates: five-word shingles, similarity 0.8. The smallest id stays; rows that
    share an id share its decision, and rows without id or without words stay."""
    ship(spark)
    return without_duplicates(docs, shingle_words=5, percent=80)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no item of the benchmark. Texts are judged one by one, with or without id; null and empty ones
    stay, and without items all do."""
    ship(spark)
    return uncontaminated(docs, spark.read.parquet(f"{sf_dir.rstrip('/')}/benchmark.parquet"))


def mixing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the mix of sources takes them. A null source is a source of its own; texts without words
    count for nothing; rows with one id, or without id and with one text, are taken together."""
    return mixed_documents(docs)


def token_ids(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token files; per document its place, length and checksum there. A null text is an empty one and has its end id;
    repeated rows are documents each."""
    import public_tokenizers
    ship(spark)
    return write_and_read(docs, public_tokenizers.path("word_bpe_49k.json"))


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("language ID", language_id), ("MinHash near-dedup", near_dedup), ("decontamination", decontamination),
    ("mixing", mixing), ("token ids", token_ids)]

# Language models and the tokenizer have no SQL; tests/llm holds run() against a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages, each written and read again before the next."""
    docs = spark.read.parquet(f"{sf_dir.rstrip('/')}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), "stage-" + name.replace(" ", "-").lower())
    return STAGES[-1][1](spark, docs, sf_dir)
