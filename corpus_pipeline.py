"""The registered queries of the training-data operators, and the pipeline over `documents`.

Stages, each over what its predecessor kept: documents that the quality rules or their
host's verdict reject go; of near copies (five-word shingles, similarity 0.8 or more) one
stays; strings of 100 bytes that occurred before are cut from texts; secrets are masked;
what is left is packed into token sequences.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from starmart.llm.common import stored
from starmart.llm.jaccard_join import Join, one_of_each
from starmart.llm.packing import packed_documents
from starmart.llm.quality_rules import kept_documents
from starmart.llm.queries import QUERIES as _QUERIES
from starmart.llm.secrets import redacted
from starmart.llm.sql import SQL as _SQL
from starmart.llm.suffix_dedup import without_repeats
from starmart.llm.tables import table


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return kept_documents(docs)


def near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return one_of_each(docs, Join(5, 80, 100))


def repeats(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return without_repeats(docs)


def secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return redacted(docs)


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return packed_documents(docs)


STAGES = [
    ("quality_rules", quality),
    ("near_copies", near_copies),
    ("repeated_strings", repeats),
    ("secrets", secrets),
    ("packing", packing),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stages over `documents`; each but the last is written and read again."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)


#: SQL has no tokenizer, and no statement of the earlier stages that ends in reasonable time.
ORACLE_SQL = None

QUERIES = {**_QUERIES, "pipeline": run}
SQL = {**_SQL}
