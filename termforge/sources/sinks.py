"""Writers: labelled records, sets, counters, summaries, deduplicated records, judge logs."""

from __future__ import annotations

from datetime import UTC, datetime

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


def label_json(label: Column) -> Column:
    """A label as written: ``variant`` only where there is one."""
    return F.transform(label, lambda x: F.struct(x["surface"].alias("surface"), x["canonical"].alias("canonical"), x["variant"].alias("variant"), x["start"].alias("start"), x["end"].alias("end"), x["is_valid"].alias("isValid")))


def record_rows(labelled: DataFrame, which: str) -> DataFrame:
    """Record fields of sentences with valid (or invalid) labels; a mixed sentence is in both."""
    labels = F.col(f"{which}_labels")
    return labelled.where(F.size(labels) > 0).select(F.lit("data").alias("type"), F.col("forum_url").alias("forumUrl"), F.col("topic_url").alias("topicUrl"), "lang", "text", label_json(labels).alias("labels"))


def marker_rows(topics: DataFrame, now: str | None = None) -> DataFrame:
    """Start and end markers of forums and topics, with the order in which they stand around the topics' records."""
    now = now or datetime.now(UTC).strftime("%Y-%m-%dT%H:%M:%SZ")
    forums = topics.groupBy("forum_url").agg(F.min("topic_seq").alias("low"), F.max("topic_seq").alias("high"))
    none = F.lit(None).cast("string")
    parts = [
        forums.select(F.col("low").alias("topic_seq"), F.lit(0).alias("place"), F.lit("forum_start").alias("type"), F.col("forum_url").alias("forumUrl"), none.alias("topicUrl"), F.lit(now).alias("timestamp")),
        topics.select("topic_seq", F.lit(1).alias("place"), F.lit("topic_start").alias("type"), F.col("forum_url").alias("forumUrl"), F.col("topic_url").alias("topicUrl"), none.alias("timestamp")),
        topics.select("topic_seq", F.lit(3).alias("place"), F.lit("topic_end").alias("type"), F.col("forum_url").alias("forumUrl"), F.col("topic_url").alias("topicUrl"), none.alias("timestamp")),
        forums.select(F.col("high").alias("topic_seq"), F.lit(4).alias("place"), F.lit("forum_end").alias("type"), F.col("forum_url").alias("forumUrl"), none.alias("topicUrl"), none.alias("timestamp")),
    ]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def write_marked(labelled: DataFrame, topics: DataFrame, path: str, now: str | None = None) -> None:
    """JSON lines of valid records between the markers of their forums and topics, in order over the files of the folder."""
    records = labelled.where(F.size("valid_labels") > 0)
    record = F.to_json(F.struct(F.lit("data").alias("type"), F.col("forum_url").alias("forumUrl"), F.col("topic_url").alias("topicUrl"), "lang", "text", label_json(F.col("valid_labels")).alias("labels")))
    lines = records.select("forum_url", "topic_seq", F.lit(2).alias("place"), F.col("sent_seq").cast("long").alias("sent_seq"), F.col("part").cast("long").alias("part"), record.alias("value"))
    marks = marker_rows(topics, now)
    mark = F.to_json(F.struct("type", "forumUrl", "topicUrl", "timestamp"))
    none = F.lit(0).cast("long")
    lines = lines.unionByName(marks.select(F.col("forumUrl").alias("forum_url"), "topic_seq", "place", none.alias("sent_seq"), none.alias("part"), mark.alias("value")))
    lines.orderBy("forum_url", "topic_seq", "place", "sent_seq", "part").select("value").write.mode("overwrite").text(path)


def output_names(site_id: str, dictionary_path: str) -> dict[str, str]:
    """Names of the two record folders of a site and dictionary."""
    name = dictionary_path.rsplit("/", 1)[-1].removesuffix(".json").removesuffix("_dict")
    base = f"{site_id}_{name}".removesuffix(".txt")
    return {which: f"{base}_{which}.jsonl" for which in ("valid", "invalid")}


def write_records(labelled: DataFrame, folder: str, names: dict[str, str]) -> None:
    """Append JSON lines of valid and invalid records."""
    for which, name in names.items():
        record_rows(labelled, which).write.mode("append").json(f"{folder}/{name}")


def write_set(values: DataFrame, path: str, col: str = "value") -> None:
    """Sorted distinct lines, replacing what was there."""
    values.select(F.col(col).alias("value")).where("value is not null").distinct().orderBy("value").write.mode("overwrite").text(path)


def counters_json(counters: DataFrame) -> DataFrame:
    """(value: one JSON document) from (kind, value, found, first_seq); each list in order of first sight."""
    one = lambda kind: F.transform(F.array_sort(F.collect_list(F.when(F.col("kind") == kind, F.struct("first_seq", "value", "found")))), lambda x: F.struct(x["value"].alias("value"), x["found"].alias("found")))
    return counters.agg(F.to_json(F.struct(one("dictionary").alias("dictionary"), one("text").alias("text"))).alias("value"))


def write_counters(counters: DataFrame, folder: str, base: str) -> str:
    """A new file of vocabulary-sized counters; its name carries the time."""
    path = f"{folder}/{base}_counters_{datetime.now(UTC).strftime('%Y-%m-%d_%H-%M-%S_%f')}.json"
    counters_json(counters).write.text(path)
    return path


def summary(labelled: DataFrame) -> DataFrame:
    """Sentences, and the distinct canonicals of their labels, sorted."""
    both = F.transform(F.concat("valid_labels", "invalid_labels"), lambda x: x["canonical"])
    labels = labelled.select(F.explode_outer(both).alias("c")).agg(F.array_sort(F.collect_set("c")).alias("labels"))
    return labelled.agg(F.count("*").alias("sentences")).join(labels, F.lit(True))


def write_summary(labelled: DataFrame, path: str) -> None:
    summary(labelled).coalesce(1).write.mode("overwrite").json(path)


def deduplicated_path(path: str) -> str:
    return path.removesuffix(".jsonl") + "_dedup.jsonl"


def write_deduplicated(kept: DataFrame, path: str) -> None:
    kept.orderBy("line_seq").select(F.col("raw").alias("value")).write.mode("overwrite").text(path)


def write_judge_log(verdicts: DataFrame, path: str) -> None:
    verdicts.write.mode("append").json(path)


def remove(spark: SparkSession, path: str) -> None:
    where = spark._jvm.org.apache.hadoop.fs.Path(path)
    where.getFileSystem(spark._jsc.hadoopConfiguration()).delete(where, True)
