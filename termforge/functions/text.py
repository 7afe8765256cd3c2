"""Text expressions: normalisation, sentences, scripts, words, surfaces. Positions are code points, ends exclusive."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from termforge.languages import Language, language


def normalize_text(text: Column) -> Column:
    """Line breaks to spaces, a space after punctuation, single spaces, trimmed."""
    text = F.regexp_replace(text, r"[\r\n]", " ")
    text = F.regexp_replace(text, r"([.,!?;:])([^ ])", "$1 $2")
    return F.trim(F.regexp_replace(text, r"\s+", " "))


def split_sentences(text: Column, lang: str | Language) -> Column:
    """Pieces between sentence ends; the ends themselves go."""
    lang = lang if isinstance(lang, Language) else language(lang)
    return F.split(text, lang.sentence)


def script_ratio(text: Column, lang: str | Language) -> Column:
    lang = lang if isinstance(lang, Language) else language(lang)
    return F.length(F.regexp_replace(text, f"[^{lang.script}]", "")) / F.length(text)


def is_target_language(text: Column, lang: str | Language, ratio: float = 0.3) -> Column:
    """Share of the script's characters strictly over ``ratio``; empty text never, a ratio of 0 or less always."""
    if ratio <= 0:
        return F.length(text) > 0
    return F.when(F.length(text) > 0, script_ratio(text, lang) > ratio).otherwise(False)


def quoted(value: Column) -> Column:
    """A pattern that matches ``value`` literally."""
    return F.concat(F.lit(r"\Q"), F.replace(value, F.lit(r"\E"), F.lit(r"\E\\E\Q")), F.lit(r"\E"))


def occurrences(text: Column, value: Column) -> Column:
    """Starts of the non-overlapping occurrences of ``value`` in ``text``, from the left."""
    pieces = F.split(text, quoted(value), -1)
    step = lambda acc, x: F.struct(F.concat(acc["at"], F.array(acc["end"] + F.length(x))).alias("at"), (acc["end"] + F.length(x) + F.length(value)).alias("end"))
    start = F.struct(F.array().cast("array<int>").alias("at"), F.lit(0).alias("end"))
    return F.aggregate(F.slice(pieces, 1, F.greatest(F.size(pieces) - 1, F.lit(0))), start, step, lambda acc: acc["at"])


LETTERS_BEFORE, LETTERS_AFTER = r"[\p{L}\p{Nd}]*$", r"^[\p{L}\p{Nd}]*"


def surface_start(text: Column, start: Column) -> Column:
    return start - F.length(F.regexp_extract(F.left(text, start), LETTERS_BEFORE, 0))


def surface_end(text: Column, end: Column) -> Column:
    return end + F.length(F.regexp_extract(F.substr(text, end + 1), LETTERS_AFTER, 0))


def words(text: Column) -> Column:
    return F.split(text, r"\s+")


def word_index(text: Column, position: Column) -> Column:
    """Index of the last word that begins before ``position``; 0 at the start."""
    before = F.size(words(F.rtrim(F.left(text, position)))) - 1
    return F.when(position <= 0, 0).otherwise(F.greatest(before, F.lit(0)))


def context_window(text: Column, position: Column, before: int = 5, after: int = 5, symmetric: bool = False) -> Column:
    """The words around ``position``. As ``word_index`` names the word before a label, 5 + 5 words hold 6 before
    and 4 after it; ``symmetric`` centres them."""
    all_words = words(text)
    at = word_index(text, position)
    if symmetric:
        at = F.when(position > 0, F.least(at + 1, F.size(all_words) - 1)).otherwise(at)
    first = F.greatest(at - before, F.lit(0))
    last = F.least(at + after + 1, F.size(all_words))
    return F.trim(F.array_join(F.slice(all_words, first + 1, F.greatest(last - first, F.lit(0))), " "))


def variant_of(value: Column, specificity: Column) -> Column:
    return F.when(specificity.isin("VARIANT", "MOSTLY_USED"), value)


def fingerprint(text: Column) -> Column:
    """64-bit wrapping polynomial hash of the UTF-8 bytes; 0 for null or empty text."""
    two64 = F.lit("18446744073709551616").cast("decimal(38,0)")
    raw = F.hex(F.encode(text, "UTF-8"))
    spots = F.sequence(F.lit(1), F.greatest(F.length(raw) - 1, F.lit(1)), F.lit(2))
    step = lambda h, i: ((h * 31 + F.conv(F.substring(raw, i, F.lit(2)), 16, 10).cast("decimal(20,0)")) % two64).cast("decimal(38,0)")
    h = F.aggregate(spots, F.lit(0x123456789ABCDEF).cast("decimal(38,0)"), step)
    h = F.when(h >= F.lit("9223372036854775808").cast("decimal(38,0)"), h - two64).otherwise(h)
    return F.when(F.coalesce(F.length(text), F.lit(0)) == 0, F.lit(0).cast("long")).otherwise(h.cast("long"))
