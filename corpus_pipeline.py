"""Corpus cleaning pipeline: five stages over ``documents``, each written as Parquet and read again.

Every stage takes all rows that its predecessor kept and returns the columns of
``documents`` (doc_id, text, lang, source, n_chars); the last adds the pieces.
Rows with a null doc_id are dropped by the second stage.  Rows that repeat a
doc_id are judged by that id and stay or go together.  Columns that a stage adds
for itself get names that the table does not have.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from fleetlake.llm.common import free, table, written

MIN_SCORE = 0.3


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents go whose language can't be told: null or without a letter, or scored below ``MIN_SCORE``.  Without
    a single label to learn from no language can be told of any, and only those without a letter go."""
    from fleetlake.llm.language_id import UNKNOWN, fit, predict

    columns = docs.columns
    out = (free("__lang_pred", *columns), free("__score", *columns))
    learn = docs.where((F.crc32(F.col("doc_id").cast("string")) % 4 != 2) & F.col("lang").isNotNull())
    model = fit(learn)
    if not model.classes:
        return docs.where(F.col("text").rlike(r"\p{L}"))
    found = predict(docs, model, keep=tuple(c for c in columns if c not in ("doc_id", "text")), keep_text=True,
                    out=out)
    return found.where((F.col(out[0]) != UNKNOWN) & (F.col(out[1]) >= MIN_SCORE)).select(*columns)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document (the smallest doc_id) of each SimHash group stays."""
    from fleetlake.llm.simhash import near_components

    found = near_components(docs, words=3, radius=3)
    return docs.join(found.where("doc_id = component_id").select("doc_id"), "doc_id", "left_semi").select(*docs.columns)


def substring_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Passages of 13 words and more that an earlier document holds are cut out; a document goes when
    nothing of its text is left."""
    from fleetlake.llm.substring import cleaned

    prefix = "__"
    while any(c.lower().startswith(prefix) for c in docs.columns):
        prefix += "_"
    left = cleaned(docs, length=13, prefix=prefix).where(f"{prefix}n_words = 0 or {prefix}n_removed < {prefix}n_words")
    return left.withColumn("n_chars", F.length("text").cast("long")).select(*docs.columns)


def decontaminate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold a benchmark passage go."""
    from fleetlake.llm.decontaminate import contaminated

    found = contaminated(docs, table(spark, sf_dir, "benchmark")).select("doc_id").distinct()
    return docs.join(found, "doc_id", "left_anti").select(*docs.columns)


def sentencepiece(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Sampled pieces of every text, and whether they decode to it."""
    import public_tokenizers

    from fleetlake.llm.sentencepieces import sampled_pieces

    kept = [c for c in docs.columns if c not in ("pieces", "n_pieces", "lossless")]
    done = sampled_pieces(docs, public_tokenizers.path("piece_bpe_32k.model"), seed=42)
    return done.select(*kept, "pieces", F.size("pieces").cast("long").alias("n_pieces"), "lossless")


STAGES = [("language_id", language_id), ("simhash_near_dedup", near_dedup), ("substring_dedup", substring_dedup),
          ("benchmark_decontamination", decontaminate), ("sentencepiece", sentencepiece)]

#: training, rolling hashes and sampling are beyond SQL; tests/llm compares the stages with brute force
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``, each written as Parquet and read again."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = written(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return docs
