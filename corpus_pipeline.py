"""From raw documents to packed training sequences, stage by stage.

Every stage takes (spark, docs, sf_dir) and returns a DataFrame; all but the last return
rows with the columns of ``documents``. ``run`` writes what a stage returns to the shared
folder and reads it back for the next one, so a lost executor costs at most one stage.
"""

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from innledger.llm import decontamination, quality, simhash, suffix_dedup
from innledger.llm.common import new_name, stored
from innledger.llm.queries import pack_documents


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def good_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier, trained on these documents, does not reject."""
    model = quality.trained(docs, _table(spark, sf_dir, "labels"))
    column = new_name(docs, "quality")
    good = F.col(column) >= quality.THRESHOLD
    return quality.scored(docs, model, column).filter(good).drop(column)


def one_of_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The document with the smallest id of each group of linked fingerprints."""
    return simhash.one_of_each(docs)


def repeats_cut(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts without the strings of 100 bytes that also start earlier.

    All documents stay, also those that nothing is left of; ``n_chars`` follows the text,
    where there is such a column.
    """
    cut = suffix_dedup.without_repeats(docs)
    if "n_chars" not in cut.columns:
        return cut
    return cut.withColumn("n_chars", F.coalesce(F.length("text").cast("long"), "n_chars"))


def decontaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no benchmark item."""
    return decontamination.without_leaks(docs, _table(spark, sf_dir, "benchmark"))


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every piece of every document and its place in a sequence."""
    return pack_documents(docs)


STAGES = [
    ("quality classifier", good_quality),
    ("SimHash near-dedup", one_of_near_duplicates),
    ("suffix-array dedup", repeats_cut),
    ("benchmark decontamination", decontaminated),
    ("best-fit packing", packed),
]

#: Trained scores, fingerprints and token ids have no SQL; tests compare with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = stored(stage(spark, docs, sf_dir), name.replace(" ", "-"))
    return docs
