"""A training corpus from ``documents``: quality, line dedup, near-dedup, mixing, packing.

Each stage takes (spark, docs, sf_dir) and returns a frame that is written as
Parquet and read again as the next one's ``docs``; all but the last return the
columns of ``documents`` (and any others that came with them). ``run`` writes the
stages to the folder named in ``spark.checkpoint.dir``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tillroll.llm import cotraining, linededup, mixing, packing, setsketch
from tillroll.llm.scratch import Scratch, bounded_batches, table, unused

#: Lines in this many documents or more go.
MIN_DOCS = 10
#: Words of a shingle and similarity (percent) of near duplicates.
WORDS, PERCENT = 5, 80
#: Share (percent) of the tokens that the mixture keeps; each document at most once.
MIX_PERCENT = 80
#: Tokens of a packed sequence.
TOKENS = 2048


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the co-trained quality classifier keeps, unchanged."""
    bounded_batches(spark)
    return cotraining.filter_quality(docs, cotraining.train(docs, table(spark, sf_dir, "labels")))


def line_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without the lines that ``MIN_DOCS`` documents share. Texts that
    lose nothing are unchanged; a document that loses every line has an empty text."""
    kept, lines, dropped = names = unused(docs.columns, "_kept", "_lines", "_dropped")
    out = linededup.dedup_lines(docs, MIN_DOCS, Scratch(spark, "pipeline_lines"), names)
    values = {
        "text": F.col(kept),
        "n_chars": F.when(F.col(dropped) > 0, F.char_length(kept).cast("long")).otherwise(F.col("n_chars")),
    }
    return out.select(*(values[c].alias(c) if c in values else F.col(f"`{c}`") for c in docs.columns))


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document (the least id) of each group of near duplicates. Of rows that
    repeat an id the one of the least digest of its text stays, of those with equal
    texts the one whose columns are least as JSON; null ids all stay."""
    gone, nth = unused(docs.columns, "_gone", "_nth")
    found = setsketch.near_duplicates(docs, WORDS, PERCENT, Scratch(spark, "pipeline_near"))
    out = found.where("NOT kept").select(F.col("doc_id").alias(gone)).distinct()
    kept = docs.join(out, F.col("doc_id") == F.col(gone), "left_anti")
    if not found.where("doc_id IS NOT NULL").groupBy("doc_id").count().where("count > 1").limit(1).count():
        return kept
    row = F.to_json(F.struct(*(F.col(f"`{c}`") for c in docs.columns)))  # maps have no order of their own
    one = Window.partitionBy("doc_id").orderBy(F.md5(F.coalesce("text", F.lit(""))), row)
    first = kept.where("doc_id IS NOT NULL").withColumn(nth, F.row_number().over(one)).where(F.col(nth) == 1).drop(nth)
    return first.unionByName(kept.where("doc_id IS NULL"))


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents of the mixture at the target weights, whole and once each
    (the last of a leaf's prefix is not cut here). Rows without an id are chosen
    together: all stay where the mixture takes one of them."""
    (chosen,) = unused(docs.columns, "_chosen")
    taken = mixing.mixture(docs, Scratch(spark, "pipeline_mix"), MIX_PERCENT, max_epochs=1)
    ids = taken.select(F.col("doc_id").alias(chosen)).distinct()
    return docs.join(ids, F.col("doc_id").eqNullSafe(F.col(chosen)), "left_semi")


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every document's pieces in sequences of ``TOKENS`` tokens (``packing.pack``)."""
    scratch = Scratch(spark, "pipeline_pack")
    return packing.pack(scratch.keep(packing.pieces(docs, packing.default_tokenizer(), TOKENS)), scratch, TOKENS)


STAGES = [
    ("quality classifier", quality),
    ("line dedup", line_dedup),
    ("MinHash near-dedup", near_dedup),
    ("mixing sources to target weights", mix),
    ("best-fit packing", pack),
]

#: A trained classifier and a tokenizer are no SQL; tests/llm holds the brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``, each written and read again."""
    docs, scratch = table(spark, sf_dir, "documents"), Scratch(spark, "pipeline")
    for _, stage in STAGES:
        before, docs = docs, scratch.keep(stage(spark, docs, sf_dir))
        if hasattr(before, "_scratch"):
            scratch.drop(before)
    return docs
