"""Dictionaries: JSON files of entries with values by language, as one row a value."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

_VALUE = "struct<value:string,specificity:string,duality:struct<rule:string,alternate_meaning:string>>"
ALL_LANGUAGES = ("en", "ru", "he")
SCHEMA = "path_seq int, entry_seq int, value_seq int, uid string, entry_type string, canonical string, value string, specificity string, duality struct<rule:string,alternate_meaning:string>"


class DictionaryError(RuntimeError):
    pass


def canonical_of(values: Column) -> Column:
    """The first value marked CANONICAL, or null."""
    return F.get(F.filter(values, lambda v: v["specificity"] == "CANONICAL"), F.lit(0))["value"]


def flatten(entries: DataFrame, language: str | None = None) -> DataFrame:
    """One row a value from (path_seq, entry_seq, uid, entry_type, en, ru, he, ...). Entries without values drop out."""
    names = (language.lower(),) if language else ALL_LANGUAGES
    lists = [F.coalesce(F.col(n), F.array().cast(f"array<{_VALUE}>")) for n in names if n in entries.columns]
    values = F.concat(*lists) if lists else F.array().cast(f"array<{_VALUE}>")
    values = F.transform(values, lambda v: F.struct(v["value"].alias("value"), F.coalesce(v["specificity"], F.lit("VARIANT")).alias("specificity"), v["duality"].alias("duality")))
    rows = entries.select("path_seq", "entry_seq", F.coalesce("uid", F.lit("")).alias("uid"), "entry_type", canonical_of(values).alias("canonical"), F.posexplode(values).alias("value_seq", "v"))
    checked = F.when(F.coalesce(F.length("v.value"), F.lit(0)) == 0, F.raise_error(F.lit("a dictionary value must not be empty"))).otherwise(F.col("v.value"))
    return rows.select("path_seq", "entry_seq", "value_seq", "uid", "entry_type", "canonical", checked.alias("value"), "v.specificity", "v.duality")


def read_dictionaries(spark: SparkSession, paths: Sequence[str] | None, language: str | None = None, nested_data: bool = True) -> DataFrame:
    """The values of all files, in order. Files that cannot be read are left out; if nothing is left, DictionaryError.

    ``nested_data`` also accepts files whose entries lie within ``metadata``. The entry type of the last file that has
    one holds for all.
    """
    if not paths:
        return spark.createDataFrame([], SCHEMA)
    langs = (language.lower(),) if language else ALL_LANGUAGES
    data = f"array<struct<uid:string,{','.join(f'{n}:array<{_VALUE}>' for n in langs)}>>"
    kind = f"metadata struct<entry_type:string,data:{data}>, data {data}"
    out, entry_type = None, None
    for i, path in enumerate(paths):
        try:
            file = spark.read.schema(kind).option("multiLine", True).json(path)
            entry_type = (file.select("metadata.entry_type").first() or [None])[0] or entry_type
        except AnalysisException:
            continue
        entries = F.coalesce("data", "metadata.data") if nested_data else F.col("data")
        rows = file.select(F.lit(i).alias("path_seq"), F.posexplode(entries).alias("entry_seq", "e")).select("path_seq", "entry_seq", "e.*")
        out = rows if out is None else out.unionByName(rows)
    flat = flatten(out.withColumn("entry_type", F.lit(entry_type).cast("string")), language) if out is not None else None
    if flat is None or flat.isEmpty():
        raise DictionaryError("no dictionary could be loaded")
    return flat


def from_rows(spark: SparkSession, rows: Sequence[tuple]) -> DataFrame:
    """A dictionary from (entry_seq, uid, [(value, specificity, rule or None), ...]) rows."""
    flat = []
    for entry_seq, uid, values in rows:
        canonical = next((v for v, s, _ in values if s == "CANONICAL"), None)
        flat += [(0, entry_seq, i, uid, None, canonical, v, s, (rule, None) if rule else None) for i, (v, s, rule) in enumerate(values)]
    return spark.createDataFrame(flat, SCHEMA)
