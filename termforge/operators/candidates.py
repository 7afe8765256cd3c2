"""Sentences with the dictionary values found inside their words."""

from __future__ import annotations

from functools import partial

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from termforge.functions.text import occurrences, surface_end, surface_start

#: Dictionaries up to this many values meet a sentence as an array; larger ones through an automaton.
ARRAY_VALUES = 256
#: Values that may be held by every task; a larger dictionary is searched in blocks of this many.
BLOCK_VALUES = 200_000
KEYS = ("topic_seq", "forum_url", "topic_url", "lang", "sent_seq", "text")
ENTRY = ("entry_seq", "value_seq", "entry_type", "canonical", "value", "specificity", "duality")


def has_candidate(dictionary: DataFrame, text: Column) -> Column:
    """Whether any value, with or without canonical, is in ``text``; beyond ARRAY_VALUES values, by an automaton."""
    values = [r.value.lower() for r in dictionary.select("value").distinct().limit(ARRAY_VALUES + 1).collect()]
    if len(values) > ARRAY_VALUES:
        values = [r.value for r in dictionary.select(F.lower("value").alias("value")).distinct().toLocalIterator()]

        @F.arrow_udf("boolean")
        def held(texts):
            import ahocorasick
            import pyarrow as pa

            automaton = _automata.get(len(values))
            if automaton is None:
                automaton = ahocorasick.Automaton()
                for v in values:
                    automaton.add_word(v, 0)
                automaton.make_automaton()
                _automata.clear()
                _automata[len(values)] = automaton
            return pa.array([t is not None and next(automaton.iter(t), None) is not None for t in texts.to_pylist()], pa.bool_())

        _automata: dict = {}  # one a task
        return held(F.lower(text))
    return F.exists(F.array(*(F.lit(v) for v in values)), lambda v: F.contains(F.lower(text), v)) if values else F.lit(False)


def _matches(batches, values):
    """Which values each sentence holds, by an automaton over all of them."""
    import ahocorasick
    import pyarrow as pa

    automaton = ahocorasick.Automaton()
    for i, v in enumerate(values):
        automaton.add_word(v, i)
    if values:
        automaton.make_automaton()
    for batch in batches:
        row, found = [], []
        for r, text in enumerate(batch.column("lower").to_pylist()):
            hits = sorted({i for _, i in automaton.iter_long(text)} | {i for _, i in automaton.iter(text)}) if values else []
            row += [r] * len(hits)
            found += [values[i] for i in hits]
        at = pa.array(row, pa.int64())
        names = [c for c in batch.schema.names if c != "lower"]
        yield pa.RecordBatch.from_arrays([*(batch.column(c).take(at) for c in names), pa.array(found, pa.string())], [*names, "value_lower"])


def find_candidates(sentences: DataFrame, dictionary: DataFrame) -> DataFrame:
    """One row for each occurrence of a value with a canonical, in order entry_seq, value_seq, occ_seq.

    A small dictionary is an array literal filtered per sentence, so there is no join and no shuffle. A larger one is matched by
    an automaton in blocks of bounded size, then its rows are joined by value.
    """
    entries = dictionary.where("canonical is not null").select((F.shiftleft(F.col("path_seq").cast("long"), 40) + F.col("entry_seq")).alias("entry_seq"), *ENTRY[1:])
    head = entries.limit(ARRAY_VALUES + 1).collect()
    if len(head) <= ARRAY_VALUES:
        kind = entries.schema
        as_lit = lambda r: F.struct(*(F.lit(r[f.name]).cast(f.dataType).alias(f.name) if f.name != "duality" else _duality(r.duality) for f in kind), F.lit(r.value.lower()).alias("value_lower"))
        if not head:
            return sentences.select(*KEYS, *(F.lit(None).cast(f.dataType).alias(f.name) for f in kind), *(F.lit(0).alias(c) for c in ("occ_seq", "start", "end")), F.lit("").alias("surface")).where("false")
        lower = F.lower("text")
        hits = F.filter(F.array(*(as_lit(r) for r in head)), lambda e: F.contains(lower, e["value_lower"]))
        rows = sentences.select(*KEYS, F.explode(hits).alias("e")).select(*KEYS, "e.*")
    else:
        block, blocks = [], []
        for r in entries.select(F.lower("value").alias("v")).distinct().toLocalIterator():
            block.append(r.v)
            if len(block) == BLOCK_VALUES:
                blocks.append(block)
                block = []
        blocks += [block] if block else []
        rows = None
        wide = sentences.select(*KEYS, F.lower("text").alias("lower"))
        schema = StructType([f for f in wide.schema if f.name != "lower"] + [StructField("value_lower", StringType())])
        for b in blocks:
            found = wide.mapInArrow(partial(_matches, values=b), schema)
            rows = found if rows is None else rows.unionByName(found)
        rows = rows.join(entries.withColumn("value_lower", F.lower("value")), "value_lower")
    rows = rows.select(*KEYS, *ENTRY, F.length("value_lower").alias("size"), F.posexplode(occurrences(F.lower("text"), F.col("value_lower"))).alias("occ_seq", "idx"))
    rows = rows.withColumn("start", surface_start(F.col("text"), F.col("idx"))).withColumn("end", surface_end(F.col("text"), F.col("idx") + F.col("size")))
    return rows.select(*KEYS, *ENTRY, "occ_seq", "start", "end", F.substring("text", F.col("start") + 1, F.col("end") - F.col("start")).alias("surface"))


def _duality(value):
    if value is None:
        return F.lit(None).cast("struct<rule:string,alternate_meaning:string>").alias("duality")
    return F.struct(F.lit(value.rule).cast("string").alias("rule"), F.lit(value.alternate_meaning).cast("string").alias("alternate_meaning")).alias("duality")
