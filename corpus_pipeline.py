"""Corpus pipeline: language ID, line dedup, near duplicates, personal data,
packing.

Every stage is a function of ``(spark, docs, sf_dir)``; its result is written
as Parquet and read again as the next one's ``docs``.  All stages but the last
return the columns of ``documents``; the last returns the packed pieces.

Null texts count as empty where a stage reads texts, null ids and sources are
values like others, and every stage turns an empty table into an empty one.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera.llm import language_id, line_dedup, ngram_join, packing, pii
from tessera.llm.common import WS_CHARS, saved

COLUMNS = ("doc_id", "text", "lang", "source", "n_chars")


def _documents(df: DataFrame) -> DataFrame:
    """The columns of ``documents``, ``n_chars`` brought up to date."""
    return df.withColumn("n_chars", F.length("text").cast("long")).select(*COLUMNS)


def language_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops documents whose language is rejected: no text, no letter, or two
    languages that compress it equally well.  The classifier learns from the
    labelled documents outside the held-out fold; where there are none, no
    language can be close to another, and only documents without a letter go."""
    learned = language_id.train(docs.where(language_id.fold(F.col("doc_id")) != 0))
    if not learned:
        return docs.where(F.regexp_like("text", F.lit(r"\p{L}"))).select(*COLUMNS)
    judged = language_id.identify(docs.select(*COLUMNS), learned)
    return judged.where(~F.col("rejected")).select(*COLUMNS)


def line_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Takes boilerplate lines out.  A document that had lines and lost them
    all goes: every one of them stays where its line is kept.  Null and empty
    texts have no lines and stay."""
    out = line_dedup.dedup_lines(docs.select(*COLUMNS))
    return _documents(out.where((F.col("n_removed") == 0) | (F.col("n_removed") < F.col("n_lines"))))


def near_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps one document of each component of near duplicates (five words,
    similarity 0.8): the one with the smallest id (null last), and of equal
    rows one.  Documents are told apart by their content, so rows without an
    id, or with the same one, are compared like all others.  Documents without
    words all stay."""
    rows = docs.select(*COLUMNS).withColumn("_key", F.xxhash64("doc_id", "text", "lang", "source"))
    parts = saved(ngram_join.near_duplicates(rows, "_key", n=5, percent=80)
                  .where("n_shingles > 0").groupBy(F.col("doc_id").alias("_key"))
                  .agg(F.first("component_id").alias("part"), F.count("*").alias("rows")), "parts")
    ids = rows.groupBy("_key").agg(F.min("doc_id").alias("id"))
    first = F.min(F.struct(F.col("id").isNull().alias("no"), "id", "_key", "rows")).alias("f")
    kept = saved(parts.join(ids, "_key").groupBy("part").agg(first).select("f._key", "f.rows"), "kept")
    blank = F.length(F.btrim(F.coalesce("text", F.lit("")), F.lit(WS_CHARS))) == 0
    worded = rows.where(~blank)
    out = (rows.where(blank).select(*COLUMNS)
           .unionByName(worded.join(kept.where("rows = 1").select("_key"), "_key", "left_semi")
                        .select(*COLUMNS)))
    again = kept.where("rows > 1").select("_key")
    if not again.isEmpty():                    # the same row several times
        out = out.unionByName(worded.join(again, "_key", "left_semi")
                              .dropDuplicates(["_key", "doc_id", "text"]).select(*COLUMNS))
    return out


def pii_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Replaces personal data in the texts; no document goes, null texts stay
    null."""
    return _documents(pii.sanitise(docs.select(*COLUMNS)))


def packing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Packs all documents into sequences of at most 2,048 tokens: one row per
    piece with its place and the checksum of its ids.  The ids themselves are
    twice the size of the texts and follow from them (``packing.pieces``);
    ``packing.sequences`` joins them to the places.  A null text is empty: one
    piece, the separator."""
    cut = packing.pieces(docs)
    placed = packing.pack(cut.withColumn("ids_crc32", F.crc32("ids")).drop("ids"))
    return placed.drop("row")


STAGES = [
    ("language_id", language_stage),
    ("line_dedup", line_stage),
    ("ngram_jaccard", near_stage),
    ("pii", pii_stage),
    ("best_fit_packing", packing_stage),
]

#: Language ID and the components have no SQL form; the stages are tested one
#: by one against plain versions.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = saved(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
