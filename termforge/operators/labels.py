"""Resolved candidates to labelled sentences: label lists, context windows of long sentences, limits, counters."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from termforge.functions.text import context_window, variant_of

CONTEXT = "(context)"
LABEL_TYPE = "array<struct<surface:string,canonical:string,variant:string,start:int,end:int,is_valid:boolean>>"


def labels(resolved: DataFrame) -> DataFrame:
    """One row a label, with the order of its candidate."""
    return resolved.select("topic_seq", "forum_url", "topic_url", "lang", "sent_seq", "text", "seq", F.struct("surface", "canonical", variant_of(F.col("value"), F.col("specificity")).alias("variant"), "start", "end", "is_valid").alias("label"))


def labelled_sentences(resolved: DataFrame, max_context: int = 200, min_length: int = 15, symmetric: bool = False) -> DataFrame:
    """Sentences with valid_labels and invalid_labels, in order.

    A sentence longer than ``max_context`` with a valid label gives one row for each of these instead: the words around it,
    the label's offsets still those in the sentence, the topic_url marked.
    """
    rows = labels(resolved)
    keys = ("topic_seq", "forum_url", "topic_url", "lang", "sent_seq", "text")
    ordered = rows.groupBy(*keys).agg(F.array_sort(F.collect_list(F.struct("seq", "label"))).alias("all"))
    pick = lambda keep: F.transform(F.filter("all", lambda x: x["label"]["is_valid"] == F.lit(keep)), lambda x: x["label"])
    lists = ordered.select(*keys, pick(True).alias("valid_labels"), pick(False).alias("invalid_labels"))
    long = (F.length("text") > max_context) & (F.size("valid_labels") > 0)
    row = lambda url, part, text, valid, invalid: F.struct(url.alias("topic_url"), part.cast("int").alias("part"), text.alias("text"), valid.alias("valid_labels"), invalid.alias("invalid_labels"))
    window = lambda x, i: row(F.concat("topic_url", F.lit(CONTEXT)), i, context_window(F.col("text"), x["start"], symmetric=symmetric), F.array(x), F.array().cast(LABEL_TYPE))
    whole = F.array(row(F.col("topic_url"), F.lit(0), F.col("text"), F.col("valid_labels"), F.col("invalid_labels")))
    # one pass: a sentence gives itself, or a row for each window
    out = F.when(long, F.filter(F.transform("valid_labels", window), lambda r: F.length(r["text"]) >= min_length)).otherwise(whole)
    return lists.select("topic_seq", "forum_url", "lang", "sent_seq", F.explode(out).alias("r")).select("topic_seq", "forum_url", "r.topic_url", "lang", "sent_seq", "r.part", "r.text", "r.valid_labels", "r.invalid_labels")


def first_sentences(labelled: DataFrame, limit: int) -> DataFrame:
    """The first ``limit`` sentences of each forum in order; 0 is no limit. Partitions keep only what can be among them."""
    if not limit:
        return labelled
    order = W.partitionBy("forum_url").orderBy("topic_seq", "sent_seq", "part")
    return labelled.withColumn("_n", F.row_number().over(order)).where(F.col("_n") <= limit).drop("_n")


def processed_topics(labelled: DataFrame, topics: DataFrame, limit: int) -> DataFrame:
    """Topics that are worked on before the limit stops a forum: up to the one that holds sentence limit + 1."""
    if not limit:
        return topics
    over = first_sentences(labelled, limit + 1).groupBy("forum_url").agg(F.count("*").alias("n"), F.max("topic_seq").alias("last")).where(F.col("n") > limit)
    over = over.select(F.col("forum_url").alias("_f"), "last")
    return topics.join(over, F.col("forum_url").eqNullSafe(F.col("_f")), "left").where("last is null or topic_seq <= last").drop("_f", "last")


def counters(resolved: DataFrame, previous: DataFrame | None = None) -> DataFrame:
    """(kind, value, found, first_seq) of valid labels by dictionary value and by surface, added to ``previous``."""
    valid = resolved.where("is_valid").select(F.explode(F.array(F.struct(F.lit("dictionary").alias("kind"), F.col("value")), F.struct(F.lit("text").alias("kind"), F.col("surface").alias("value")))).alias("x"), "seq")
    new = valid.groupBy("x.kind", "x.value").agg(F.count("*").alias("found"), F.min("seq").alias("first_seq"))
    if previous is None:
        return new
    old = previous.select("kind", "value", F.col("found").cast("long").alias("found"), F.lit(None).cast(new.schema["first_seq"].dataType).alias("first_seq"))
    return new.unionByName(old).groupBy("kind", "value").agg(F.sum("found").alias("found"), F.min("first_seq").alias("first_seq"))


def counter_totals(counted: DataFrame) -> DataFrame:
    return counted.groupBy("kind").agg(F.sum("found").alias("total"))


def totals(labelled: DataFrame) -> DataFrame:
    """Topics with sentences, sentences, and labels added (contexts count their valid label only)."""
    return labelled.agg(F.count_distinct("topic_seq").alias("topics"), F.count("*").alias("sentences"), F.sum(F.size("valid_labels") + F.size("invalid_labels")).alias("labels"))
