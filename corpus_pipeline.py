"""A training-data pipeline over documents: language ID, near-duplicate removal, source mixing, packing."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidepanel.llm import jaccard, langid, mixing, packing
from tidepanel.llm.common import drop_written, fresh, intermediates, read_table, written


def _columns(df: DataFrame, docs: DataFrame) -> DataFrame:
    return df.select(*[df[c] for c in docs.columns])


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a letter in any script, or whose text is null, go; all others stay."""
    profiles = langid.language_profiles(docs)
    lang, score, letter = (fresh(docs, name) for name in ("_lang_pred", "_score", "_letter"))
    found = langid.identify_languages(docs, profiles, lang_name=lang, score_name=score, letter_name=letter)
    return _columns(found.where(found[letter]), docs)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of near copies the document of the smallest id stays, as one row; rows without an id stay.

    Null and empty texts have no shingles and stay; rows that repeat an id become the one with the least text; an empty table gives no rows.
    """
    groups = jaccard.near_duplicate_groups(docs)
    gone = groups.where("component_id <> doc_id").select("doc_id")
    kept = docs.join(gone, "doc_id", "left_anti")
    rest = [c for c in docs.columns if c != "doc_id"]
    order = sorted(rest, key=lambda c: c != "text")
    one = kept.where("doc_id is not null").groupBy("doc_id").agg(F.min(F.struct(*order)).alias("row"))
    return one.select("doc_id", *[F.col("row")[c].alias(c) for c in rest]).select(*docs.columns).unionByName(kept.where("doc_id is null").select(*docs.columns))


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents repeat or go so that their sources come near the target weights; one without an id is known by its text.

    A null or empty text has no words and stays as it is; an empty table gives no rows.
    """
    return mixing.mixed_documents(docs)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of the training sequences. A null text is its end token alone, repeated rows are documents of their own, an empty table gives no rows."""
    import public_tokenizers

    return packing.pack_documents(docs, public_tokenizers.path("word_bpe_49k.json"))


STAGES = [("language", language), ("near_duplicates", near_duplicates), ("mix", mix), ("pack", pack)]

#: Hyperdimensional profiles and retrieval packing have no SQL form; tests hold the stages against plain versions.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stages in turn over documents. Each stage's rows are stored, then the tables that it made and its input are dropped;
    what the last stage made stays, as the result reads it."""
    docs, before = read_table(spark, sf_dir, "documents"), []
    for k, (name, stage) in enumerate(STAGES):
        with intermediates() as made:
            docs = stage(spark, docs, sf_dir)
        if k < len(STAGES) - 1:
            docs, path = written(docs, f"stage-{name}")
            drop_written(spark, *before, *made)
            before = [path]
    return docs
