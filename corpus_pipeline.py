"""A corpus pipeline: five stages, each on all that the one before it kept.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame, which is written
as Parquet and read again as the next stage's documents. All but the last return
the columns of the documents.

Defined results: a null or empty text gets the models' score of an empty one, has
no lines to delete, is similar to nothing, and is packed as one end token; a
null id is never a training row and sorts first among copies of lines, last
among near copies; rows equal in id and text are one document to the Jaccard
join, which keeps one of them; without labels nothing is rejected; an empty table
gives no rows; further columns are carried along up to the packing.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from arealis.llm.common import table
from arealis.llm.jaccard import one_of_each
from arealis.llm.line_dedup import line_dedup
from arealis.llm.packing import pack
from arealis.llm.quality_model import quality_filter
from arealis.llm.queries import tokenizer_path
from arealis.llm.toxicity import toxicity_filter
from arealis.scratch import stored


def good_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality classifier accepts."""
    return quality_filter(docs, table(spark, sf_dir, "labels"))


def not_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the toxicity model doesn't reject."""
    return toxicity_filter(docs, table(spark, sf_dir, "labels"))


def without_repeated_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts without later copies of repeated runs of lines."""
    deduped = line_dedup(docs)
    changed = F.col(deduped.columns[-1]) > 0
    columns = [F.when(changed, F.length("text")).otherwise(F.col(c)).cast(t).alias(c) if c == "n_chars" else F.col(c) for c, t in docs.dtypes]
    return deduped.select(*columns)


def one_of_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of similar ones."""
    return one_of_each(docs)


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of all documents, placed in sequences."""
    return pack(docs, tokenizer_path())


STAGES = [
    ("quality_classifier", good_quality),
    ("toxicity", not_toxic),
    ("line_dedup", without_repeated_lines),
    ("ngram_jaccard_join", one_of_near_copies),
    ("best_fit_packing", packed),
]

#: The classifiers, the suffix order and the packing have no SQL; a test holds the run against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages on the documents of ``sf_dir``."""
    docs = table(spark, sf_dir, "documents")
    for k, (name, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if k < len(STAGES) - 1:
            docs = stored(docs, name, keep=True)
    return docs
