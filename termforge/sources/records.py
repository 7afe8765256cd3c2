"""Readers of labelled records, seen-term files and counters, and page links."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

RECORD = "type string, forumUrl string, topicUrl string, lang string, text string, labels array<struct<surface:string,canonical:string,variant:string,start:int,end:int,isValid:boolean>>"


def _exists(spark: SparkSession, path: str) -> bool:
    where = spark._jvm.org.apache.hadoop.fs.Path(path)
    return bool(where.getFileSystem(spark._jsc.hadoopConfiguration()).globStatus(where))


def read_set(spark: SparkSession, path: str) -> DataFrame:
    """Distinct trimmed lines (value), without blank ones and comments; a missing file is empty."""
    if not _exists(spark, path):
        return spark.createDataFrame([], "value string")
    return spark.read.text(path).select(F.trim("value").alias("value")).where("value != '' and not startswith(value, '#')").distinct()


def read_counters(spark: SparkSession, path: str) -> DataFrame:
    """(kind, value, found) of a counters file."""
    pair = "array<struct<value:string,found:bigint>>"
    file = spark.read.schema(f"dictionary {pair}, text {pair}").option("multiLine", True).json(path)
    one = lambda kind: file.select(F.lit(kind).alias("kind"), F.explode(kind).alias("x")).select("kind", "x.value", "x.found")
    return one("dictionary").union(one("text"))


def newest_counters(spark: SparkSession, folder: str, base: str) -> str | None:
    """The path of the newest ``<base>_counters*.json``."""
    files = spark.read.format("binaryFile").option("pathGlobFilter", f"{base}_counters*.json").load(folder).select("path", "modificationTime")
    return files.agg(F.max_by("path", "modificationTime")).first()[0]


def _blocks(batches):
    """Blocks between balanced braces of whole files; braces in strings count too."""
    import pyarrow as pa

    for batch in batches:
        row, seq, raw = [], [], []
        for i, text in enumerate(batch.column("value").to_pylist()):
            depth, start, n = 0, -1, 0
            for at, c in enumerate(text or ""):
                if c == "{":
                    start = at if start < 0 else start
                    depth += 1
                elif c == "}":
                    depth -= 1
                    if depth == 0 and start >= 0:
                        row.append(i)
                        seq.append(n)
                        raw.append(text[start : at + 1])
                        n, start = n + 1, -1
        yield pa.RecordBatch.from_arrays([batch.column("path").take(pa.array(row, pa.int64())), pa.array(seq, pa.int64()), pa.array(raw, pa.string())], ["path", "line_seq", "raw"])


def read_concatenated(spark: SparkSession, path: str, schema: str = RECORD, data_only: bool = False) -> DataFrame:
    """Records of files of JSON objects one after the other, pretty-printed or not: path, line_seq, raw and the fields.

    Blocks that are no JSON are skipped; a missing file is empty.
    """
    if not _exists(spark, path):
        blocks = spark.createDataFrame([], "path string, line_seq long, raw string")
    else:
        whole = spark.read.option("wholetext", True).text(path).select(F.col("_metadata.file_path").alias("path"), "value")
        blocks = whole.mapInArrow(_blocks, "path string, line_seq long, raw string")
    checked = schema + ", _broken string"
    parsed = blocks.withColumn("r", F.from_json("raw", checked, {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": "_broken"}))
    out = parsed.where("r is not null and r._broken is null").select("path", "line_seq", "raw", "r.*").drop("_broken")
    return out.where("type = 'data'") if data_only else out


def read_records(spark: SparkSession, path: str) -> DataFrame:
    """Data records of JSON lines: line_seq (the order within a file), text, raw."""
    lines = spark.read.text(path).select(F.monotonically_increasing_id().alias("line_seq"), F.col("value").alias("raw"))
    return lines.where(F.get_json_object("raw", "$.type") == "data").select("line_seq", F.get_json_object("raw", "$.text").alias("text"), "raw")
