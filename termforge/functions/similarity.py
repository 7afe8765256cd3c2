"""Similarities of two texts; null on either side is an error, as there is nothing to compare."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# The thresholds at which two texts count as duplicates.
THRESHOLDS = {"levenshtein": 0.8, "jaccard": 0.7, "cosine": 0.8}


def _both(a: Column, b: Column, value: Column) -> Column:
    return F.when(a.isNull() | b.isNull(), F.raise_error(F.lit("text must not be null")).cast("double")).otherwise(value)


def levenshtein_similarity(a: Column, b: Column) -> Column:
    longest = F.greatest(F.length(a), F.length(b))
    return _both(a, b, F.when(longest == 0, 1.0).otherwise(1 - F.levenshtein(a, b) / longest))


def _printed_set(text: Column) -> Column:
    """The distinct lower-case characters other than white space, with those of the printed list that holds them."""
    chars = F.array_distinct(F.filter(F.split(F.lower(F.regexp_replace(text, r"\s", "")), ""), lambda c: c != ""))
    more = F.when(F.size(chars) >= 2, F.array(*(F.lit(c) for c in "[], "))).otherwise(F.array(F.lit("["), F.lit("]")))
    return F.array_union(chars, more)


def jaccard_similarity(a: Column, b: Column) -> Column:
    """Of the printed character lists, so brackets, comma and space count as members."""
    x, y = _printed_set(a), _printed_set(b)
    return _both(a, b, F.size(F.array_intersect(x, y)) / F.size(F.array_union(x, y)))


def _cosine(a: Column, b: Column) -> Column:
    x, y = (F.regexp_extract_all(t, F.lit(r"(\w+)"), 1) for t in (a, b))
    count = lambda w, words: F.size(F.filter(words, lambda v: v == w)).cast("double")
    square = lambda words: F.aggregate(F.array_distinct(words), F.lit(0.0), lambda s, w: s + count(w, words) * count(w, words))
    dot = F.aggregate(F.array_intersect(x, y), F.lit(0.0), lambda s, w: s + count(w, x) * count(w, y))
    size = F.sqrt(square(x)) * F.sqrt(square(y))
    return F.when(size > 0, dot / size).otherwise(0.0)


def cosine_similarity(a: Column, b: Column) -> Column:
    return _both(a, b, _cosine(a, b))


def cosine_distance(a: Column, b: Column) -> Column:
    """1 minus the similarity; identical texts have 0."""
    return _both(a, b, 1 - _cosine(a, b))


MEASURES = {"levenshtein": levenshtein_similarity, "jaccard": jaccard_similarity, "cosine": cosine_distance}


def is_duplicate(a: Column, b: Column, measure: str, threshold: float | None = None) -> Column:
    """At or over the threshold. ``cosine`` compares the distance, as callers of this measure rely on."""
    return MEASURES[measure](a, b) >= (THRESHOLDS[measure] if threshold is None else threshold)
