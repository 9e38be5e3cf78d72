"""The registered queries of this package: (session, folder) -> DataFrame."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from starmart.llm.collocations import collocations
from starmart.llm.fingerprints import compared
from starmart.llm.html_text import page_texts
from starmart.llm.jaccard_join import Join, similar_documents
from starmart.llm.language_id import held_out_predictions
from starmart.llm.packing import packed_documents
from starmart.llm.quality_model import quality_scores
from starmart.llm.quality_rules import judged
from starmart.llm.ranked_search import ranked
from starmart.llm.secrets import digest, secret_spans
from starmart.llm.sentencepieces import round_trips
from starmart.llm.suffix_dedup import removed_bytes
from starmart.llm.tables import table
from starmart.llm.token_counts import token_counts


def op1_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document encoded to pieces and decoded again."""
    return round_trips(table(spark, sf_dir, "documents"))


def op2_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents whose sets of 3-word shingles are alike at 0.9 or more, as components."""
    return similar_documents(table(spark, sf_dir, "documents"), Join(3, 90, 100))


def op3_document_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Bottom-k fingerprints of every document and of its edited text."""
    return compared(table(spark, sf_dir, "documents"))


def op4_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's pieces of at most 2048 tokens, packed into sequences."""
    return packed_documents(table(spark, sf_dir, "documents"))


def op5_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Counts, base failure and host verdict of every document; its source is its host."""
    return judged(table(spark, sf_dir, "documents"))


def op6_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Tokens of every document by the byte-level vocabulary."""
    return token_counts(table(spark, sf_dir, "documents"))


def op7_secret_scans(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Secrets in every document: fixed patterns and random-looking strings."""
    return digest(secret_spans(table(spark, sf_dir, "documents")))


def op8_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The language of every document, learned from four of five folds."""
    return held_out_predictions(table(spark, sf_dir, "documents"))


def op9_html_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The main text of every page."""
    return page_texts(table(spark, sf_dir, "pages"))


def op10_suffix_array_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What repeated strings of 100 bytes take from every document."""
    return removed_bytes(table(spark, sf_dir, "documents"))


def op11_phrase_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each language's firmest phrases of 2 to 5 words that occur 100 times or more."""
    return collocations(table(spark, sf_dir, "documents"))


def op12_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The quality of every document, learned from the labels of four of five folds."""
    return quality_scores(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op13_ranked_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The 20 best documents of each benchmark item."""
    return ranked(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


QUERIES = {
    f.__name__: f
    for f in (
        op1_sentencepiece,
        op2_jaccard_join,
        op3_document_fingerprints,
        op4_best_fit_packing,
        op5_quality_rules,
        op6_token_counts,
        op7_secret_scans,
        op8_language_id,
        op9_html_extraction,
        op10_suffix_array_dedup,
        op11_phrase_collocations,
        op12_quality_classifier,
        op13_ranked_search,
    )
}
