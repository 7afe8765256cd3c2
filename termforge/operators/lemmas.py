"""Lemmatizers: words to their lemmas, each distinct word once."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Language codes and the language they name.
CODES = {"ru": "ru", "ru-ru": "ru", "en": "en", "en-us": "en", "he": "he", "he-il": "he"}


class Lemmatizer:
    def lemmas(self, words: DataFrame) -> DataFrame:
        """(word, lemma) for the rows (word); words that are their own lemma may be left out."""
        raise NotImplementedError


class NoLemmatizer(Lemmatizer):
    """Every word is its own lemma."""

    def lemmas(self, words: DataFrame) -> DataFrame:
        return words.select("word", F.col("word").alias("lemma")).where("false")


class TableLemmatizer(Lemmatizer):
    """Lemmas from a table (word, lemma)."""

    def __init__(self, table: DataFrame):
        self.table = table

    def lemmas(self, words: DataFrame) -> DataFrame:
        return words.select("word").distinct().join(self.table.select("word", "lemma").dropDuplicates(["word"]), "word")


class CallLemmatizer(Lemmatizer):
    """Asks ``ask(word) -> lemma`` once for each distinct word, in ``tasks`` tasks, where the service may be called from. A failed call fails the job."""

    def __init__(self, ask: Callable[[str], str], tasks: int = 1):
        self.ask, self.tasks = ask, tasks

    def lemmas(self, words: DataFrame) -> DataFrame:
        ask = self.ask

        def told(batches):
            import pyarrow as pa

            for batch in batches:
                own = batch.column("word").to_pylist()
                yield pa.RecordBatch.from_arrays([pa.array(own, pa.string()), pa.array([ask(w) for w in own], pa.string())], ["word", "lemma"])

        return words.select("word").where("word is not null").distinct().coalesce(self.tasks).mapInArrow(told, "word string, lemma string")


def lemmatizer_for(code: str | None, russian: Lemmatizer | None = None) -> Lemmatizer:
    """The lemmatizer of a language code: ``russian`` for Russian if there is one; other languages and unknown codes have none."""
    return russian if russian is not None and CODES.get((code or "").strip().lower()) == "ru" else NoLemmatizer()


def lemmas_of(candidates: DataFrame, lemmatizer: Lemmatizer) -> DataFrame:
    """(word, lemma) of the candidates' surfaces, lower case."""
    return lemmatizer.lemmas(candidates.select(F.lower("surface").alias("word")).distinct())
