"""Topics and a dictionary to labelled sentences, with the run's state: terms and lemmas seen, counters."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from termforge.config import LabelerConfig
from termforge.operators import labels as L
from termforge.operators import sentences as S
from termforge.operators import verdicts as V
from termforge.operators.candidates import find_candidates
from termforge.operators.judge import Judge
from termforge.operators.lemmas import Lemmatizer
from termforge.operators.shared import materialize


@dataclass
class Annotation:
    labelled: DataFrame  # the sentences to write
    resolved: DataFrame  # candidates with verdicts, of the topics worked on
    terms: DataFrame
    lemmas: DataFrame
    counters: DataFrame
    quarantined: DataFrame  # topics set aside for an unsupported rule or question
    locked: DataFrame  # what fixes each surface of a forum from here on


def annotate(topics: DataFrame, dictionary: DataFrame, config: LabelerConfig, judge: Judge | None = None, lemmas: DataFrame | Lemmatizer | None = None, seen: DataFrame | None = None, lemmas_before: DataFrame | None = None, previous: DataFrame | None = None, locked: DataFrame | None = None, done: DataFrame | None = None, symmetric: bool = False, filter_special: bool = False) -> Annotation:
    """Verdicts of one forum do not reach another. Judged candidates and their verdicts are written once; the results read them.

    ``filter_special`` applies the ratio of special characters, which is off by default. ``locked`` (forum_url, surf, event) are first events of earlier runs over the same forums.
    """
    rows = S.sentences(S.pending(topics, done), config.language, config.min_sentence_length, config.min_language_ratio, config.max_special_char_ratio if filter_special else None)
    judged = materialize(V.judged_candidates(find_candidates(rows, dictionary), judge, lemmas), "judged")
    resolved = materialize(V.decide(judged, seen, locked), "resolved")
    labelled = L.labelled_sentences(resolved, config.max_sentence_length_for_context, config.min_sentence_length, symmetric)
    if config.max_sentences:
        worked = L.processed_topics(labelled, topics.select("topic_seq", "forum_url"), config.max_sentences)
        worked = worked.select(F.col("topic_seq").alias("_t"), F.col("forum_url").alias("_f"))
        resolved = resolved.join(worked, F.col("topic_seq").eqNullSafe(F.col("_t")) & F.col("forum_url").eqNullSafe(F.col("_f")), "left_semi")
        labelled = L.first_sentences(labelled, config.max_sentences)
    return Annotation(labelled, resolved, V.terms_seen(resolved, seen), V.lemmas_seen(resolved, lemmas_before), L.counters(resolved, previous), V.set_aside(judged), V.first_events(judged, locked))


def annotate_site(topics: DataFrame, forums: list[str], dictionary: DataFrame, config: LabelerConfig, judge: Judge | None = None, lemmas: DataFrame | Lemmatizer | None = None, seen: DataFrame | None = None) -> list[Annotation]:
    """The forums of a site in order; terms accepted in one are known in the next, rejections are not."""
    out = []
    for forum in forums:
        run = annotate(topics.where(F.col("forum_url") == forum), dictionary, config, judge, lemmas, seen)
        seen = materialize(run.terms, "terms")
        out.append(run)
    return out


def metadata(run: Annotation, dictionary: DataFrame, language: str) -> DataFrame:
    """language, extraction_date, sentences, dictionary entries, topics worked on."""
    entries = dictionary.agg(F.count_distinct("path_seq", "entry_seq").alias("entries"))
    return run.labelled.agg(F.lit(language).alias("language"), F.date_format(F.current_timestamp(), "yyyy-MM-dd'T'HH:mm:ss").alias("extraction_date"), F.count("*").alias("sentences"), F.count_distinct("topic_seq").alias("topics")).join(entries, F.lit(True))
