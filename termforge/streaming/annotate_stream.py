"""Annotation of a stream of topics: each micro-batch runs the batch plan on the state of those before: first events, terms, lemmas, counters."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from termforge.config import LabelerConfig
from termforge.operators.judge import Judge
from termforge.operators.lemmas import Lemmatizer
from termforge.operators.shared import materialize
from termforge.plans.annotate import annotate
from termforge.sources.sinks import record_rows


def topic_stream(spark: SparkSession, folder: str, schema, files_per_batch: int = 1) -> DataFrame:
    return spark.readStream.schema(schema).option("maxFilesPerTrigger", files_per_batch).parquet(folder)


STATE = {
    "terms": "value string",
    "lemmas": "value string",
    "locked": "forum_url string, surf string, event string",
    "counters": "kind string, value string, found long",
}


def _before(spark: SparkSession, state: str, name: str, batch: int) -> DataFrame:
    """What the batches before ``batch`` left of one kind of state."""
    spark.createDataFrame([], STATE[name]).write.mode("overwrite").parquet(f"{state}/{name}/batch=-1")
    return spark.read.schema(f"{STATE[name]}, batch long").parquet(f"{state}/{name}").where(F.col("batch") < batch).drop("batch")


def stream_state(spark: SparkSession, state: str) -> dict[str, DataFrame]:
    """Terms, lemmas, first events and counters of all batches so far."""
    last = {name: _before(spark, state, name, 1 << 62) for name in STATE}
    return last | {"terms": last["terms"].distinct(), "lemmas": last["lemmas"].distinct(), "counters": last["counters"].groupBy("kind", "value").agg(F.sum("found").alias("found"))}


def annotate_stream(topics: DataFrame, dictionary: DataFrame, config: LabelerConfig, out: str, state: str, checkpoint: str, judge: Judge | None = None, lemmas: DataFrame | Lemmatizer | None = None, seen: DataFrame | None = None, **trigger) -> StreamingQuery:
    """Writes records to ``out/valid`` and ``out/invalid`` and what is new in the state to ``state``, by batch: a repeated batch replaces itself.

    The first event of a surface in a forum, accepted or rejected, holds in all later batches, so batches of whole topics in order
    give what one run over all of them gives. ``seen`` (value): terms accepted before the stream, in every forum.
    """

    def run(rows: DataFrame, batch: int) -> None:
        spark = rows.sparkSession
        known = {name: materialize(_before(spark, state, name, batch), name) for name in ("terms", "lemmas", "locked")}
        result = annotate(rows, dictionary, config, judge, lemmas, seen, locked=known["locked"])
        labelled = materialize(result.labelled, "labelled")
        for which in ("valid", "invalid"):
            record_rows(labelled, which).write.mode("overwrite").json(f"{out}/{which}/batch={batch}")
        same = [F.col(f"n.{c}").eqNullSafe(F.col(f"k.{c}")) for c in ("forum_url", "surf")]
        new = {
            "terms": result.terms.join(known["terms"], "value", "left_anti"),
            "lemmas": result.lemmas.join(known["lemmas"], "value", "left_anti"),
            "locked": result.locked.alias("n").join(known["locked"].alias("k"), same, "left_anti"),
            "counters": result.counters.select("kind", "value", "found"),
        }
        for name, frame in new.items():
            frame.write.mode("overwrite").parquet(f"{state}/{name}/batch={batch}")

    return topics.writeStream.foreachBatch(run).option("checkpointLocation", checkpoint).trigger(**(trigger or {"availableNow": True})).start()


def windowed_counts(events: DataFrame, width: str = "1 hour", late: str = "10 minutes") -> DataFrame:
    """Events by type in tumbling windows, late ones up to the watermark; works on batches and streams."""
    return events.withWatermark("ts", late).groupBy(F.window("ts", width).alias("w"), "event_type").agg(F.count("*").alias("n"), F.sum("value").alias("total")).select(F.col("w.start").alias("start"), "event_type", "n", "total")
