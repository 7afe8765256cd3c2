"""Language identification by rank-order profiles.

A profile ranks the most frequent byte n-grams (1 to 3) of a language's training texts. A document's own most frequent n-grams
are ranked the same way; its distance to a profile is the sum of how far each n-gram is out of place, at most the
profile's length. The nearest profile wins. Counting covers all training documents: each task sums per language before
the shuffle, so what is sent grows with tasks and languages, not text. Profiles have at most PROFILE n-grams a language.

Text without a letter, null text, and any text when there is nothing to learn from are ``und`` with score 0. Equal distances go to the
language first in the alphabet, equally frequent n-grams rank by code. Rows without lang train nothing; repeated rows count each time. An empty
table gives an empty result. Extra columns are not read. A task holds a text and its n-grams, some 40 times its bytes.
"""

from __future__ import annotations

from functools import partial

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from termforge.llm.common import bounded_batches, chunks

GRAMS, PROFILE, RANKED, UNKNOWN = 3, 600, 300, "und"
FOLDS, HELD_OUT = 4, 2


def fold(doc_id: Column, folds: int) -> Column:
    return F.pmod(F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary")), F.lit(folds))


def _letters():
    """Each byte as a letter code: A-Z lowered, bytes of other scripts kept, all else the same border."""
    import numpy as np

    code = np.full(256, 32, np.uint32)
    code[97:123] = code[65:91] = np.arange(97, 123)
    code[128:] = np.arange(128, 256)
    return code


def gram_counts(column, longest: int):
    """For each row of an Arrow text column its n-gram codes and their counts."""
    import numpy as np

    code, u32 = _letters(), np.uint32
    for _, data, at in chunks(column):
        x = code[data]
        grams = [x + u32(1 << 24)]
        for n in range(2, longest + 1):
            g = x.copy()
            for j in range(1, n):
                g[:-j] = g[:-j] << u32(8) | x[j:]
            grams.append(g + u32(n << 24))
        border = x == 32
        pair = border.copy()
        pair[:-1] &= border[1:]
        for a, b in zip(at[:-1].tolist(), at[1:].tolist(), strict=True):
            own = []
            for n, g in enumerate(grams, 1):
                # n-grams of one border, or with two borders next to each other, tell nothing
                if b - a < n:
                    continue
                end = b - n + 1
                drop = border[a:end].copy() if n == 1 else pair[a:end].copy()
                for j in range(1, n - 1):
                    drop |= pair[a + j : end + j]
                own.append(g[a:end][~drop])
            yield np.unique(np.concatenate(own), return_counts=True) if own else (np.zeros(0, u32), np.zeros(0, np.int64))


def _count(batches, longest):
    import numpy as np
    import pyarrow as pa

    sums: dict[str, list] = {}
    for batch in batches:
        langs = batch.column("lang").to_pylist()
        by: dict[str, list] = {}
        for lang, pair in zip(langs, gram_counts(batch.column("text"), longest), strict=True):
            by.setdefault(lang, []).append(pair)
        for lang, pairs in by.items():
            pairs += sums.get(lang, [])
            g, back = np.unique(np.concatenate([p[0] for p in pairs]), return_inverse=True)
            sums[lang] = [(g, np.bincount(back, np.concatenate([p[1] for p in pairs]), len(g)).astype(np.int64))]
    for lang, [(g, n)] in sums.items():
        for i in range(0, len(g), 20_000):
            part = g[i : i + 20_000]
            yield pa.RecordBatch.from_arrays([pa.array([lang] * len(part), pa.string()), pa.array(part.astype(np.int64)), pa.array(n[i : i + 20_000])], ["lang", "gram", "n"])


def language_profiles(docs: DataFrame, longest: int = GRAMS, size: int = PROFILE) -> dict[str, list[int]]:
    """The ``size`` most frequent n-grams of each language, most frequent first; ties by code."""
    docs = bounded_batches(docs)
    counts = docs.where("lang is not null and text is not null").select("lang", "text").mapInArrow(partial(_count, longest=longest), "lang string, gram long, n long")
    counts = counts.groupBy("lang", "gram").agg(F.sum("n").alias("n"))
    rank = F.row_number().over(W.partitionBy("lang").orderBy(F.desc("n"), "gram"))
    rows = counts.withColumn("rank", rank).where(F.col("rank") <= size).collect()  # ``size`` rows a language at most
    profiles: dict[str, list[int]] = {}
    for r in sorted(rows, key=lambda r: (r.lang, r.rank)):
        profiles.setdefault(r.lang, []).append(r.gram)
    return profiles


def _predict(batches, profiles, longest, ranked):
    import re

    import numpy as np
    import pyarrow as pa

    langs = sorted(profiles)
    known = np.unique(np.array([g for p in profiles.values() for g in p], np.uint32))
    size = max((len(p) for p in profiles.values()), default=0)
    place = np.full((len(langs), len(known) + 1), size, np.int64)
    for i, lang in enumerate(langs):
        place[i, np.searchsorted(known, np.array(profiles[lang], np.uint32))] = np.arange(len(profiles[lang]))
    absent = place == size
    ascii_letter, letter = re.compile("[A-Za-z]"), re.compile(r"[^\W\d_]")
    for batch in batches:
        pred, score = [], []
        texts = batch.column("text")
        for text, (grams, n) in zip(texts, gram_counts(texts, longest), strict=True):
            text = text.as_py() or ""
            if not langs or not (ascii_letter.search(text) or letter.search(text) and any(c.isalpha() for c in text)):
                pred.append(UNKNOWN)
                score.append(0.0)
                continue
            if len(grams) > ranked:  # the most frequent ones, ties by code
                cut = np.partition(n, len(n) - ranked)[len(n) - ranked]
                more = np.flatnonzero(n > cut)
                top = np.sort(np.concatenate((more, np.flatnonzero(n == cut)[: ranked - len(more)])))
                grams, n = grams[top], n[top]
            grams = grams[np.lexsort((grams, -n))]
            at = np.searchsorted(known, grams)
            at[(at == len(known)) | (known[np.minimum(at, len(known) - 1)] != grams)] = len(known)
            off = np.where(absent[:, at], size, np.abs(place[:, at] - np.arange(len(at)))).sum(axis=1)
            best = int(off.argmin())
            pred.append(langs[best])
            score.append(1.0 - float(off[best]) / (size * max(1, len(at))))
        kept = [c for c in batch.schema.names if c != "text"]
        yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in kept), pa.array(pred, pa.string()), pa.array(score, pa.float64())], [*kept, "lang_pred", "score"])


def identify_languages(docs: DataFrame, profiles: dict[str, list[int]], longest: int = GRAMS, ranked: int = RANKED) -> DataFrame:
    """doc_id, lang_pred, score (1 minus the share of the greatest possible distance) of every document."""
    docs = bounded_batches(docs)
    return docs.select("doc_id", "text").mapInArrow(partial(_predict, profiles=profiles, longest=longest, ranked=ranked), "doc_id long, lang_pred string, score double")


def languages_of(docs: DataFrame) -> DataFrame:
    """Profiles from the documents of the training folds, then a prediction for every document."""
    held_out = fold(F.col("doc_id"), FOLDS) == HELD_OUT
    profiles = language_profiles(docs.where(~held_out))
    out = identify_languages(docs, profiles)
    return out.select("doc_id", held_out.alias("held_out"), "lang_pred", "score")


def _keep_identified(batches, profiles, longest, ranked):
    import pyarrow as pa
    import pyarrow.compute as pc

    for batch in batches:
        (found,) = _predict([pa.RecordBatch.from_arrays([batch.column("text")], ["text"])], profiles, longest, ranked)
        yield batch.filter(pc.not_equal(found.column("lang_pred"), UNKNOWN))


def identified(docs: DataFrame, longest: int = GRAMS, ranked: int = RANKED) -> DataFrame:
    """The rows of ``docs``, all columns, whose language is identified; what is ``und`` goes. No join: each row decides alone."""
    profiles = language_profiles(docs.where(fold(F.col("doc_id"), FOLDS) != HELD_OUT), longest)
    return docs.mapInArrow(partial(_keep_identified, profiles=profiles, longest=longest, ranked=ranked), docs.schema)
