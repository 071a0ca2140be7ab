"""From documents to token ids: five stages, each on all rows that the one before kept."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from trivet.llm import langid
from trivet.llm.common import WORD, cut, free
from trivet.llm.linededup import dedup_runs
from trivet.llm.mixing import mix
from trivet.llm.pieces import encode_pieces
from trivet.llm.queries import piece_model
from trivet.llm.setjoin import jaccard_components

COLUMNS = ("doc_id", "text", "lang", "source", "n_chars")

#: A text is rejected if its best language has less than this share of the softmax.
MIN_SCORE = 0.3


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts whose language none of the learned ones explains, or without a letter, go."""
    model = langid.train(docs)
    out = langid.predict_languages(docs, model, carry=("lang", "source", "n_chars"))
    return out.where((F.col("lang_pred") != "und") & (F.col("score") >= MIN_SCORE)).select(*COLUMNS)


def lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Repeated passages of lines go whole from the texts; a document that loses all its words goes too."""
    out = dedup_runs(docs, carry=("lang", "source"))
    kept = (F.col("n_removed") == 0) | F.col("text").rlike(WORD)
    return out.where(kept).withColumn("n_chars", F.length("text").cast("long")).select(*COLUMNS)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates stays: five-word shingles, similarity 0.8 or more."""
    kept = jaccard_components(docs, words=5, num=80, den=100).where("kept").select(F.col("doc_id").alias("kd"), F.col("t").alias("kt")).distinct()
    own = docs.select(*COLUMNS).withColumn("t", F.xxhash64("text"))
    out = own.join(kept, F.col("doc_id").eqNullSafe(F.col("kd")) & (F.col("t") == F.col("kt")), "left_semi")
    # Rows that repeat both id and text are one group and one of them stays; wordless rows are no group.
    some = out.where(F.col("text").rlike(WORD)).dropDuplicates(["doc_id", "t"])
    return some.unionByName(out.where(~F.coalesce(F.col("text").rlike(WORD), F.lit(False)))).select(*COLUMNS)


def mixture(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each document as often as the mix takes it; a text without a word has size 0 and copies as its source has.

    Sources (null one of them) meet their targets, whatever ids repeat; an empty table stays empty.
    """
    out = mix(docs, carry=("text", "lang", "n_chars"))
    return out.where("copies > 0").withColumn("_n", F.explode(F.expr("sequence(1L, copies)"))).select(*COLUMNS)


def tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of each row, null text as the empty one: the columns of encode_pieces and source."""
    return encode_pieces(docs, piece_model(), carry=("source",))


STAGES = [
    ("language ID", language),
    ("line dedup", lines),
    ("n-gram Jaccard join", near_duplicates),
    ("mixing sources", mixture),
    ("SentencePiece", tokens),
]

#: SQL has no SentencePiece; the tests hold run() against a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stages in turn over documents, each on a table of what the one before kept.

    A null or empty text has no letter and goes in the first stage, so an empty table, or one of such
    texts, gives no row. Rows that repeat id and text are copies: one stays. Null ids and sources are
    values of their own. Texts are whole in every stage, however long, and columns other than COLUMNS
    are not read. A stage's input is deleted when its output is written.
    """
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        before, docs = docs, cut(stage(spark, docs, sf_dir), name.split()[0].lower())
        free(before)
    return STAGES[-1][1](spark, docs, sf_dir)
