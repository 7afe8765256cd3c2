"""Topics to sentences, and why sentences were dropped."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from termforge.functions.text import is_target_language, normalize_text, split_sentences
from termforge.languages import DEFAULT, language


def topics_from_documents(docs: DataFrame) -> DataFrame:
    """Documents as topics: one forum a source, topics in order of doc_id."""
    return docs.select(F.col("doc_id").alias("topic_seq"), F.col("source").alias("forum_url"), F.col("doc_id").cast("string").alias("topic_url"), F.lit(None).cast("string").alias("cleaned_content"), F.col("text").alias("content"), F.col("lang").alias("language"))


def content_of(fallback_raw: bool = True) -> Column:
    """Cleaned content, or else the raw one; null if both are empty."""
    cleaned, raw = F.nullif(F.col("cleaned_content"), F.lit("")), F.nullif(F.col("content"), F.lit(""))
    return F.coalesce(cleaned, raw) if fallback_raw else cleaned


def pending(topics: DataFrame, done: DataFrame | None = None) -> DataFrame:
    """Topics not yet done, by topic_url."""
    return topics if done is None else topics.join(done.select("topic_url").distinct(), "topic_url", "left_anti")


def raw_sentences(topics: DataFrame, lang: str, fallback_raw: bool = True) -> DataFrame:
    """topic_seq, forum_url, topic_url, lang, sent_seq, raw: all pieces of the topics in one language."""
    code = language(lang).code
    own = F.lower(F.coalesce(F.nullif(F.col("language"), F.lit("")), F.lit(DEFAULT)))
    rows = topics.where(own == code).select("topic_seq", "forum_url", "topic_url", F.lit(code).alias("lang"), content_of(fallback_raw).alias("text")).where("text is not null")
    return rows.select("topic_seq", "forum_url", "topic_url", "lang", F.posexplode(split_sentences(normalize_text(F.col("text")), code)).alias("sent_seq", "raw"))


def sentences(topics: DataFrame, lang: str, min_length: int = 15, ratio: float = 0.3, max_special_ratio: float | None = None, fallback_raw: bool = True) -> DataFrame:
    """Sentences long enough, in the language's script. The length is that of the untrimmed piece.

    ``max_special_ratio``, off by default, also drops sentences with too many characters that are neither letters,
    digits nor spaces.
    """
    rows = raw_sentences(topics, lang, fallback_raw).where(F.length("raw") >= min_length)
    rows = rows.select("topic_seq", "forum_url", "topic_url", "lang", "sent_seq", F.trim("raw").alias("text")).where("text != ''")
    rows = rows.where(is_target_language(F.col("text"), lang, ratio))
    if max_special_ratio is not None:
        rows = rows.where(F.length(F.regexp_replace("text", r"[\p{L}\p{Nd}\s]", "")) / F.length("text") <= max_special_ratio)
    return rows


def diagnostics(topics: DataFrame, lang: str, has_candidate: Column, min_length: int = 15, ratio: float = 0.3) -> DataFrame:
    """Per topic: all pieces, too short, wrong script, no candidate, and those left."""
    short = F.length("raw") < min_length
    blank = F.trim("raw") == ""
    foreign = ~is_target_language(F.trim("raw"), lang, ratio)
    live = ~short & ~blank
    # A last empty piece after the final sentence end is no sentence.
    rows = raw_sentences(topics, lang).withColumn("text", F.trim("raw")).where("raw != '' or sent_seq = 0")
    return rows.groupBy("topic_seq", "topic_url").agg(
        F.count("*").alias("total"),
        F.count_if(short).alias("short"),
        F.count_if(live & foreign).alias("foreign"),
        F.count_if(live & ~foreign & ~has_candidate).alias("no_candidate"),
        F.count_if(live & ~foreign & has_candidate).alias("with_candidate"),
    )
