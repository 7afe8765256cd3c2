import random

import pytest
from pyspark.sql import functions as F

from termforge.functions import similarity as M
from termforge.functions import text as X
from termforge.functions import urls as U


def values(spark, rows, *cols):
    names = [f"c{i}" for i in range(len(rows[0]))]
    return [tuple(r) for r in spark.createDataFrame(rows, names).select(*cols).collect()]


def test_normalize(spark):
    rows = [("3.14",), ("wait...what",), ("http://x",), (" a\r\nb  c ",)]
    assert values(spark, rows, X.normalize_text(F.col("c0"))) == [("3. 14",), ("wait. .. what",), ("http: //x",), ("a b c",)]


def test_sentences_and_script(spark):
    ru = values(spark, [("Поймал сома. Он большой! да. нет",)], X.split_sentences(F.col("c0"), "RU"))
    assert ru == [(["Поймал сома", " Он большой! да. нет"],)]  # an end counts before a capital only
    assert values(spark, [("Привет мир",), ("hello",), ("",)], X.is_target_language(F.col("c0"), "ru")) == [(True,), (False,), (False,)]
    assert values(spark, [("",), ("x",)], X.is_target_language(F.col("c0"), "ru", 0)) == [(False,), (True,)]


def test_occurrences_match_a_search_loop(spark):
    rng, rows = random.Random(3), []
    for _ in range(200):
        rows.append(("".join(rng.choice("ab.\\E ") for _ in range(rng.randrange(30))), "".join(rng.choice("ab.\\E") for _ in range(rng.randrange(1, 4)))))
    got = values(spark, rows, X.occurrences(F.col("c0"), F.col("c1")))
    for (text, value), (at,) in zip(rows, got, strict=True):
        want, i = [], text.find(value)
        while i >= 0:
            want.append(i)
            i = text.find(value, i + len(value))
        assert at == want


def test_word_index_and_context(spark):
    rows = [("a b c d e f g h i j k l m", 14), ("a b c", 0)]
    assert values(spark, rows, X.word_index(F.col("c0"), F.col("c1")), X.context_window(F.col("c0"), F.col("c1"))) == [(6, "b c d e f g h i j k l"), (0, "a b c")]


def test_fingerprint(spark):
    def want(s):
        h = 0x123456789ABCDEF
        for b in s.encode():
            h = (31 * h + b) % 2**64
        return h - 2**64 if h >= 2**63 else h

    texts = ["a", "карп", "x" * 300]
    assert values(spark, [(t,) for t in texts], X.fingerprint(F.col("c0"))) == [(want(t),) for t in texts]
    assert spark.range(1).select(X.fingerprint(F.lit("")), X.fingerprint(F.lit(None).cast("string"))).first()[:] == (0, 0)


def test_similarity(spark):
    rows = [("abc", "abc"), ("", ""), ("abc", "abd")]
    got = values(spark, rows, *(f(F.col("c0"), F.col("c1")) for f in (M.levenshtein_similarity, M.jaccard_similarity, M.cosine_distance)))
    assert got[0] == (1.0, 1.0, pytest.approx(0.0)) and got[1][0] == 1.0 and got[2][0] == pytest.approx(2 / 3) and got[2][1] == pytest.approx(6 / 8)
    with pytest.raises(Exception, match="must not be null"):
        spark.range(1).select(M.levenshtein_similarity(F.lit(None).cast("string"), F.lit("a"))).collect()


def test_urls(spark):
    rows = [("https://f/viewtopic.php?f=2&t=77&start=50&sid=ab#p3",), ("viewtopic.php?p=9",), ("x",)]
    assert values(spark, rows, U.topic_id(F.col("c0"))) == [("77",), ("9",), ("",)]
    assert values(spark, rows[:1], U.canonical_url(F.col("c0"))) == [("https://f/viewtopic.php?f=2&t=77",)]
    assert values(spark, [("./a",), ("/b",), ("http://c",)], U.absolute_url(F.col("c0"), "https://f/")) == [("https://f/a",), ("https://f/b",), ("http://c",)]
    with pytest.raises(Exception, match="unknown forum kind"):
        spark.range(1).select(U.forum_kind(F.lit("other"))).collect()
