"""A corpus pipeline: five stages over ``documents``, each written and read again.

Each stage takes (spark, docs, sf_dir) and works on all rows that the one before
it kept.  All but the last return the columns of ``documents``, and no others
that ``docs`` may have.  Rows are told apart by their place where ids are null or
repeated; an empty table gives an empty table.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from chunklake.llm import line_dedup, mixing, packing, simhash_dedup, toxicity
from chunklake.llm.common import keyed_rows, materialize, table

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Without the documents that score as toxic.  Labels of held-out rows are not used.

    A null or empty text, or one without a known word, has the base score of such
    texts and stays unless most of them are toxic.  Repeated rows go or stay together.
    """
    labels = table(spark, sf_dir, "labels").where(~toxicity.held_out())
    keyed = keyed_rows(docs.select(*COLUMNS))
    scored = toxicity.fit_score(keyed, labels)
    toxic = materialize(scored.where(F.col("score") >= toxicity.THRESHOLD).select("_row"), "toxic")
    return keyed.join(toxic, "_row", "left_anti").select(*COLUMNS)


def dedup_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Later copies of line runs leave the texts; n_chars is counted anew.

    The first copy in the order of doc_id stays (with null or repeated ids: of the
    table).  All rows stay, also those that lose all lines.  A null text stays null, with n_chars 0.
    """
    found = line_dedup.dedup(docs.select(*COLUMNS)).withColumn("n_chars", F.coalesce(F.length("text"), F.lit(0)).cast("long"))
    return found.select(*COLUMNS)


def dedup_near(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each near-duplicate class stays: that with the least id, null ids last;
    of rows that share it the first.  Texts are linked at a similarity of 0.8 of their sets of
    five-word shingles.  Null texts, empty texts and those without a word are one class."""
    return simhash_dedup.dedup_similar(docs).select(*COLUMNS)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each document as often as the mix takes it, none to three times.

    A null source is one of its own; a document without words is as long as nothing
    and may be taken or not.  Of documents of one size those with smaller ids come first.
    """
    keyed = keyed_rows(docs.select(*COLUMNS))
    # Rows may share an id or have none: _row tells them apart.
    taken = mixing.mix(keyed.select(F.col("_row").alias("doc_id"), "text", "source")).where("copies > 0").select(F.col("doc_id").alias("_row"), "copies")
    many = keyed.join(taken, "_row").withColumn("_copy", F.explode(F.sequence(F.lit(1), F.col("copies").cast("int"))))
    return many.select(*COLUMNS)


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of the texts and their places in sequences of 2048 tokens; repeated rows are
    packed each, a null text is empty and has the end token alone."""
    return packing.pack(docs)


STAGES = [
    ("toxicity", drop_toxic),
    ("line_dedup", dedup_lines),
    ("simhash_dedup", dedup_near),
    ("mixing", mix_sources),
    ("packing", pack_sequences),
]

#: Toxicity scores and near-duplicate classes have no SQL; tests use brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The rows of the last stage, over all of ``documents``."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = materialize(stage(spark, docs, sf_dir), name)
    return docs
