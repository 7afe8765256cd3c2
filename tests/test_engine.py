import json
import random

import duckdb
import numpy as np
import pytest
from pyspark.sql import functions as F

from termforge import config, languages, queries
from termforge.operators import candidates, dedup, html, judge, lemmas, topics, verdicts
from termforge.operators import labels as L
from termforge.operators import sentences as S
from termforge.plans.annotate import annotate, annotate_site
from termforge.sources import dictionary, records, sinks
from termforge.streaming.annotate_stream import annotate_stream, stream_state

FISH = [(0, "carp", [("карп", "CANONICAL", None), ("карпик", "VARIANT", None)]), (1, "pike", [("щука", "CANONICAL", None), ("щук", "VARIANT", None)]), (2, "catfish", [("сом", "CANONICAL", None)])]
TOPIC = "topic_seq long, forum_url string, topic_url string, cleaned_content string, content string, language string"
RU = config.LabelerConfig(language="ru")


def make_topics(spark, texts, forum="f"):
    return spark.createDataFrame([(i, forum, f"u?t={i}", None, t, "RU") for i, t in enumerate(texts)], TOPIC)


def test_annotate_russian(spark):
    run = annotate(make_topics(spark, ["Я поймал огромного карпа и щуку на рыбалке.", "Карп клюёт на червя весной."]), dictionary.from_rows(spark, FISH), RU, judge.DenyJudge())
    rows = {r.topic_seq: r for r in run.labelled.collect()}
    assert [(x.surface, x.canonical, x.start, x.end) for x in rows[0].invalid_labels] == [("карпа", "карп", 19, 24), ("щуку", "щука", 27, 31)]
    assert [x.surface for x in rows[1].valid_labels] == ["Карп"]
    assert {r.value for r in run.terms.collect()} == {"карп"}


def test_cascade_equals_a_sequential_run(spark):
    rng = random.Random(5)
    told = {(s, v): rng.random() < 0.5 for s in ("карпа", "карпы", "щуку", "сома", "карпика") for v in ("карп", "карпик", "щук", "сом")}
    texts = [". ".join("Было " + " и ".join(rng.choice(["карп", "карпа", "карпы", "щуку", "щук", "сома", "сом", "карпика"]) for _ in range(4)) for _ in range(3)) for _ in range(25)]
    table = judge.TableJudge(spark.createDataFrame([(s, v, ok) for (s, v), ok in told.items()], "surface string, value string, is_form boolean"))
    found = candidates.find_candidates(S.sentences(make_topics(spark, texts), "ru"), dictionary.from_rows(spark, FISH))
    got = {tuple(r.seq): r.is_valid for r in verdicts.resolve(found, table).collect()}
    rejected, seen, want = set(), set(), {}
    for r in sorted(found.collect(), key=lambda r: [r[c] for c in verdicts.ORDER]):
        surf, val = r.surface.lower(), r.value.lower()
        if surf in rejected:
            ok = False
        elif surf in seen or surf == val:
            ok = True
            seen.add(surf)
        else:
            ok = told.get((surf, val), False)
            (seen if ok else rejected).add(surf)
        want[tuple(r[c] for c in verdicts.ORDER)] = ok
    assert got == want and len(set(want.values())) == 2


def test_cascade_with_lemmas_and_null_forum_equals_a_sequential_run(spark):
    """All eight steps: lemmas that lack the value, that are as long as it, and others; a forum without a url is a forum."""
    rng = random.Random(6)
    forms = ["карп", "карпа", "карпы", "щуку", "щук", "сома", "сом", "карпика", "карпом"]
    lemma = {"карпа": "карп", "карпы": "карпы", "щуку": "щука", "сома": "сомик", "карпика": "удочка", "карпом": "карп"}
    told = {(s, v): rng.random() < 0.5 for s in forms for v in ("карп", "карпик", "щук", "сом")}
    rows = [(i, forum, f"u?t={i}", None, ". ".join("Было " + " и ".join(rng.choice(forms) for _ in range(4)) for _ in range(2)), "RU") for forum in ("f", None) for i in rng.sample(range(100 * (forum is None), 100 * (forum is None) + 50), 12)]
    table = judge.TableJudge(spark.createDataFrame([(s, v, ok) for (s, v), ok in told.items()], "surface string, value string, is_form boolean"))
    found = candidates.find_candidates(S.sentences(spark.createDataFrame(rows, TOPIC), "ru"), dictionary.from_rows(spark, FISH))
    by_table = spark.createDataFrame(list(lemma.items()), "word string, lemma string")
    want, kept, steps = {}, set(), set()
    state = {f: (set(), set()) for f in ("f", None)}
    for r in sorted(found.collect(), key=lambda r: [r[c] for c in verdicts.ORDER]):
        surf, val, (rejected, seen) = r.surface.lower(), r.value.lower(), state[r.forum_url]
        lem = lemma.get(surf, surf)
        step = next(k for k, test in enumerate((surf in rejected, surf in seen, surf == val, val not in lem, len(val) == len(lem), told[surf, val], True)) if test)
        ok = step in (1, 2, 4, 5)
        if step in (2, 4, 5):
            seen.add(surf)
            kept |= {lem} if step > 2 else set()
        if step == 6:
            rejected.add(surf)
        want[tuple(r[c] for c in verdicts.ORDER)] = ok
        steps.add(step)
    assert steps == set(range(7))
    for given in (by_table, lemmas.TableLemmatizer(by_table), lemmas.CallLemmatizer(lambda w: lemma.get(w, w))):
        resolved = verdicts.resolve(found, table, given)
        assert {tuple(r.seq): r.is_valid for r in resolved.collect()} == want
        assert {r.value for r in verdicts.lemmas_seen(resolved).collect()} == kept


def test_lemmatizer_of_a_language():
    some = lemmas.CallLemmatizer(str)
    assert all(lemmas.lemmatizer_for(c, some) is some for c in ("ru", "RU-ru", " ru "))
    assert all(isinstance(lemmas.lemmatizer_for(c, some), lemmas.NoLemmatizer) for c in ("en", "en-US", "he", "he-IL", "xx", "", None))
    assert isinstance(lemmas.lemmatizer_for("ru"), lemmas.NoLemmatizer)


def test_call_judge_asks_once_and_sets_other_languages_aside(spark, tmp_path):
    asked = tmp_path / "asked"

    def ask(prompt):
        with open(asked, "a", encoding="utf-8") as f:
            f.write(prompt.replace("\n", " ") + "\n")
        if "щуку" in prompt:
            raise judge.ProviderError("NETWORK_ERROR")
        return "TRUE, it is"

    found = candidates.find_candidates(S.sentences(make_topics(spark, ["Я поймал карпа и щуку, карпа и щуку."] * 3), "ru"), dictionary.from_rows(spark, FISH))
    got = {r.surface: r.is_valid for r in verdicts.resolve(found, judge.CallJudge(ask)).collect()}
    assert got == {"карпа": True, "щуку": False} and len(asked.read_text(encoding="utf-8").splitlines()) == 2
    english = spark.createDataFrame([(0, "f", "a", None, "A nice carpet lies here today.", "en"), (1, "f", "b", None, "The carp swims here today.", "en")], TOPIC)
    run = annotate(english, dictionary.from_rows(spark, [(0, "c", [("carp", "CANONICAL", None)])]), config.LabelerConfig(language="en"), judge.CallJudge(ask))
    assert [r.topic_seq for r in run.quarantined.collect()] == [0] and [r.topic_seq for r in run.labelled.collect()] == [1]


def test_special_characters_are_filtered_on_request(spark):
    rows = make_topics(spark, ["Карп $$$ *** ### @@@ здесь %%% ^^^ плавает.", "Карп был здесь вчера утром."])
    words = dictionary.from_rows(spark, FISH)
    assert annotate(rows, words, RU).labelled.count() == 2
    assert [r.topic_seq for r in annotate(rows, words, RU, filter_special=True).labelled.collect()] == [1]


def test_hebrew(spark):
    rows = spark.createDataFrame([(0, "f", "a", None, "אני אוהב דג קרפיון מאוד. This sentence is in English only.", "he")], TOPIC)
    out = S.sentences(rows, "he", 5).collect()
    assert len(out) == 1 and "קרפיון" in out[0].text
    words = dictionary.from_rows(spark, [(0, "c", [("קרפיון", "CANONICAL", None)])])
    (r,) = annotate(rows, words, config.LabelerConfig(language="he")).labelled.collect()
    assert [(x.surface, r.text[x.start : x.end]) for x in r.valid_labels] == [("קרפיון", "קרפיון")]


def test_has_candidate_beyond_the_array(spark, monkeypatch):
    rows = S.sentences(make_topics(spark, ["Карп был здесь вчера.", "Никого не было вчера.", "Большая ЩУКА плывёт."]), "ru")
    words = dictionary.from_rows(spark, FISH)
    few = {r.topic_seq for r in rows.where(candidates.has_candidate(words, F.col("text"))).collect()}
    monkeypatch.setattr(candidates, "ARRAY_VALUES", 2)
    assert {r.topic_seq for r in rows.where(candidates.has_candidate(words, F.col("text"))).collect()} == few == {0, 2}


def test_dual_values_and_unsupported_rule(spark):
    words = dictionary.from_rows(spark, [(0, "a", [("Сом", "CANONICAL", "CASE_SENSITIVE")]), (1, "b", [("лещ", "CANONICAL", "OTHER")])])
    rows = make_topics(spark, ["Поймал сом и Сом и сомик сегодня.", "Крупный лещ клюёт здесь весной."])
    run = annotate(rows, words, RU)
    (r,) = run.labelled.collect()
    assert [x.surface for x in r.valid_labels] == ["Сом", "сомик"] and [x.surface for x in r.invalid_labels] == ["сом"]
    assert [x.topic_seq for x in run.quarantined.collect()] == [1]


def test_large_dictionary_agrees_with_a_small_one(spark, monkeypatch):
    rows = S.sentences(make_topics(spark, ["Карпика и щуку, карп и карпкарп сегодня поймал."]), "ru")
    small = candidates.find_candidates(rows, dictionary.from_rows(spark, FISH)).collect()
    monkeypatch.setattr(candidates, "ARRAY_VALUES", 1)
    monkeypatch.setattr(candidates, "BLOCK_VALUES", 2)
    large = candidates.find_candidates(rows, dictionary.from_rows(spark, FISH)).collect()
    key = lambda r: tuple(map(str, r))
    assert sorted(small, key=key) == sorted(large, key=key) and len(small) > 4


def test_context_limit_and_site(spark):
    long = "Сегодня рано утром мы поехали на большое озеро и там карп клевал весь день пока не стемнело и стало холодно"
    rows = make_topics(spark, [long, "Карп и сом были тут. Карп снова был здесь."])
    run = annotate(rows, dictionary.from_rows(spark, FISH), config.LabelerConfig(language="ru", max_sentence_length_for_context=50))
    first = min(run.labelled.collect(), key=lambda r: r.topic_seq)
    assert first.topic_url.endswith("(context)") and "карп" in first.text and len(first.text.split()) <= 11
    one = annotate(rows, dictionary.from_rows(spark, FISH), config.LabelerConfig(language="ru", max_sentences=1))
    assert one.labelled.count() == 1
    two = annotate_site(make_topics(spark, ["Карп был здесь вчера."]).union(make_topics(spark, ["Карп и сом живут тут."], "g")), ["f", "g"], dictionary.from_rows(spark, FISH), RU)
    assert {r.value for r in two[1].terms.collect()} == {"карп", "сом"}


def test_dictionary_files(spark, tmp_path):
    good, nested = tmp_path / "a_dict.json", tmp_path / "b_dict.json"
    good.write_text(json.dumps({"metadata": {"entry_type": "fish"}, "data": [{"uid": "t", "ru": [{"value": "тилапия", "specificity": "CANONICAL"}, {"value": "мушт"}], "en": []}]}))
    nested.write_text(json.dumps({"metadata": {"data": [{"uid": "n", "ru": [{"value": "червь", "specificity": "CANONICAL"}]}]}}))
    rows = dictionary.read_dictionaries(spark, [str(good), str(tmp_path / "missing.json"), str(nested)], "RU").orderBy("path_seq", "value_seq").collect()
    assert [(r.value, r.specificity, r.canonical, r.entry_type) for r in rows] == [("тилапия", "CANONICAL", "тилапия", "fish"), ("мушт", "VARIANT", "тилапия", "fish"), ("червь", "CANONICAL", "червь", "fish")]
    assert dictionary.read_dictionaries(spark, []).count() == 0
    with pytest.raises(dictionary.DictionaryError):
        dictionary.read_dictionaries(spark, [str(tmp_path / "missing.json")])


def test_sinks_and_records(spark, tmp_path):
    run = annotate(make_topics(spark, ["Карп и карпа видел вчера."]), dictionary.from_rows(spark, FISH), RU, judge.DenyJudge())
    names = sinks.output_names("site", "x/species_dict.json")
    sinks.write_records(run.labelled, str(tmp_path), names)
    back = records.read_concatenated(spark, f"{tmp_path}/{names['valid']}/part-*", data_only=True).collect()
    assert [(r.text, r.labels[0].surface) for r in back] == [("Карп и карпа видел вчера", "Карп")] and names == {"valid": "site_species_valid.jsonl", "invalid": "site_species_invalid.jsonl"}
    sinks.write_set(run.terms, f"{tmp_path}/terms")
    assert [r.value for r in records.read_set(spark, f"{tmp_path}/terms").collect()] == ["карп"]
    assert records.read_set(spark, f"{tmp_path}/none").count() == 0
    path = sinks.write_counters(run.counters, str(tmp_path / "counters"), "site")
    old = records.read_counters(spark, path)
    assert {(r.kind, r.value, r.found) for r in L.counters(run.resolved, old).collect()} == {("dictionary", "карп", 2), ("text", "Карп", 2)}
    assert sinks.marker_rows(make_topics(spark, ["a", "b"])).count() == 6
    assert sinks.summary(run.labelled).first()[:] == (1, ["карп"])


def test_near_duplicates_are_those_of_a_scan(spark):
    rng, texts = random.Random(1), [None, "", ""]
    base = ["".join(rng.choice("abcde ") for _ in range(rng.randrange(5, 60))) for _ in range(25)]
    for _ in range(120):
        t = list(rng.choice(base))
        for _ in range(rng.randrange(4)):
            t[rng.randrange(len(t))] = rng.choice("abcde")
        texts.append("".join(t))
    rows = spark.createDataFrame(list(enumerate(texts)), "line_seq long, text string")
    got = {r.line_seq for r in dedup.near_duplicates(rows).where("kept").collect()}

    def distance(a, b):
        row = list(range(len(b) + 1))
        for i, x in enumerate(a, 1):
            row, last = [i], row
            for j, y in enumerate(b, 1):
                row.append(min(last[j] + 1, row[-1] + 1, last[j - 1] + (x != y)))
        return row[-1]

    kept = []
    for i, t in enumerate(texts):
        if not t or all(not texts[k] or distance(t, texts[k]) * 10 > max(len(t), len(texts[k])) for k in kept):
            kept.append(i)
    assert got == set(kept)


def test_html(spark):
    body = "Текст сообщения достаточно длинный, чтобы остаться в результате очистки."
    page = f'<html><title>Тема - Форум</title><div class="postbody"><strong>Иван</strong><div class="content">{body} [b]жирный[/b] ⇧<div class="signature">подпись</div><blockquote>цитата</blockquote><a href="x.jpg">pic</a></div></div></html>'
    pages = spark.createDataFrame([(1, page), (2, '<div class="content">short</div>'), (3, None), (4, f'<div class="content">{body} ↳ {body}</div>'), (5, "<p>no posts here</p>")], "topic_url string, html string")
    got = {r.topic_url: r.cleaned for r in html.clean_html(pages).collect()}
    assert got == {"1": f"{body} жирный", "2": "", "3": "", "4": "", "5": ""}
    meta = topics.topic_metadata(pages.where("topic_url = '1'"), "phpbb").first()
    assert (meta.author, meta.title, meta.creation_date) == ("Иван", "Тема", None)
    vb = spark.createDataFrame([("1", '<title> T </title><a class="username">Bob</a><time datetime="2024-01-02 03:04:05">')], "topic_url string, html string")
    meta = topics.topic_metadata(vb, "vbulletin").first()
    assert (meta.author, meta.title, str(meta.creation_date)) == ("Bob", "T", "2024-01-02 03:04:05")


def test_topic_listing(spark):
    page = lambda n, more: "".join(f'<a class="topictitle" href="./viewtopic.php?t={i}&sid=z">t</a>' for i in n) + ('<a rel="next" href="#">n</a>' if more else "")
    rows = spark.createDataFrame([("f", 0, page([3, 1, 3], True)), ("f", 1, page([2], False)), ("f", 2, page([9], False))], "forum_url string, page int, html string")
    got = topics.topic_urls(rows, "phpBB", "https://b").orderBy("topic_seq").collect()
    assert [(r.topic_seq, r.topic_url, r.topic_id) for r in got] == [(0, "https://b/viewtopic.php?t=3", "3"), (1, "https://b/viewtopic.php?t=1", "1"), (2, "https://b/viewtopic.php?t=2", "2")]


def test_config_and_languages():
    good = {"site": {"siteId": "s", "baseUrl": "b", "forums": [{"name": "n", "forumUrl": "u", "forumType": "PHPBB"}], "labeler": {"language": "ru"}}}
    assert config.parse(good).site.labeler.min_sentence_length == 15
    good["site"]["forums"][0] |= {"include": ["a"], "exclude": ["b"]}
    with pytest.raises(config.ConfigError, match="exclude each other"):
        config.parse(good)
    assert languages.language(None).code == "ru"
    with pytest.raises(ValueError):
        languages.language("xx")


def test_providers(tmp_path):
    (tmp_path / "one.json").write_text(json.dumps({"name": "one", "enabled": True, "priority": 2}))
    (tmp_path / "one_key.json").write_text(json.dumps({"key": "k"}))
    (tmp_path / "two.json").write_text(json.dumps({"name": "two", "apiKey": "own", "priority": 1}))
    (tmp_path / "off.json").write_text(json.dumps({"name": "off", "enabled": False, "apiKey": "x"}))
    found = judge.read_providers(str(tmp_path), {})
    assert [(p.name, p.key) for p in found] == [("two", "own"), ("one", "k")]
    asked = []

    def send(p, body):
        asked.append(p.name)
        if p.name == "two":
            raise judge.ProviderError.of_status(429)
        return " true "

    s = judge.Scheduler(found, send, clock=lambda: 0.0)
    assert judge.verdict(s.ask("?")) and judge.verdict(s.ask("?")) and asked == ["two", "one", "one"]


def test_stream_equals_batch(spark, tmp_path):
    rows = make_topics(spark, ["Карп был здесь вчера.", "Большой карпа и сом плывут."])
    rows.coalesce(1).write.parquet(f"{tmp_path}/in")
    words = dictionary.from_rows(spark, FISH)
    q = annotate_stream(spark.readStream.schema(rows.schema).parquet(f"{tmp_path}/in"), words, RU, f"{tmp_path}/out", f"{tmp_path}/state", f"{tmp_path}/cp", judge.DenyJudge())
    q.awaitTermination(120)
    got = {r.text for r in spark.read.json(f"{tmp_path}/out/valid").collect()}
    assert got == {r.text for r in annotate(rows, words, RU, judge.DenyJudge()).labelled.where(F.size("valid_labels") > 0).collect()}


def test_stream_of_several_batches_equals_batch(spark, tmp_path):
    """Rejections, accepted terms, lemmas and counters of one micro-batch hold in the next."""
    rng = random.Random(7)
    forms = ["карп", "карпа", "карпы", "щуку", "щук", "сома", "карпика"]
    texts = ["Было " + " и ".join(rng.choice(forms) for _ in range(4)) for _ in range(12)]
    rows = [(i, f"f{i % 2}" if i % 5 else None, f"u?t={i}", None, t, "RU") for i, t in enumerate(texts)]
    told = judge.TableJudge(spark.createDataFrame([("карпа", "карп", True), ("щуку", "щук", False), ("карпика", "карп", False)], "surface string, value string, is_form boolean"))
    lemma = spark.createDataFrame([("карпы", "карп")], "word string, lemma string")
    words, topic = dictionary.from_rows(spark, FISH), spark.createDataFrame(rows, TOPIC)
    folder = f"{tmp_path}/in"
    for k in range(3):  # three files, one a batch
        topic.where(f"topic_seq >= {4 * k} and topic_seq < {4 * k + 4}").coalesce(1).write.mode("append").parquet(folder)
        annotate_stream(spark.readStream.schema(topic.schema).parquet(folder), words, RU, f"{tmp_path}/out", f"{tmp_path}/state", f"{tmp_path}/cp", told, lemma).awaitTermination(120)
    whole = annotate(topic, words, RU, told, lemma)
    for which in ("valid", "invalid"):
        got = sorted((r.topicUrl, r.text) for r in spark.read.json(f"{tmp_path}/out/{which}").collect())
        assert got == sorted((r.topicUrl, r.text) for r in sinks.record_rows(whole.labelled, which).collect()) and got
    state = stream_state(spark, f"{tmp_path}/state")
    assert sorted(map(str, state["counters"].collect())) == sorted(map(str, whole.counters.select("kind", "value", "found").collect()))
    for name, frame in (("terms", whole.terms), ("lemmas", whole.lemmas), ("locked", whole.locked)):
        assert sorted(map(str, state[name].collect())) == sorted(map(str, frame.collect())), name
    assert {r.event for r in whole.locked.collect()} == {"POS", "NEG"}


def test_limits_count_successes_and_tokens_are_summed():
    now, sent = [0.0], []

    def send(p, body):
        sent.append(p.name)
        if len(sent) == 2:
            raise judge.ProviderError("SERVER_ERROR")
        return {"choices": [{"message": {"content": "TRUE"}}], "usage": {"total_tokens": 7}}

    p = judge.Provider("one", per_minute=2)
    s = judge.Scheduler([p], send, clock=lambda: now[0])
    assert [s.ask("?") for _ in range(2)] == ["TRUE", "TRUE"] and len(sent) == 3 and p.tokens == 14  # the failed call is tried again and not counted
    with pytest.raises(judge.ProviderError, match="no provider"):
        s.ask("?")
    now[0] = 61.0
    assert s.ask("?") == "TRUE"
    with pytest.raises(judge.ProviderError, match="without choices"):
        judge.reply(p, {"choices": []})


def test_markers_stand_around_their_records(spark, tmp_path):
    rows = make_topics(spark, ["Карп был здесь вчера.", "Никого не было вчера.", "Карп и карп плывут."])
    run = annotate(rows, dictionary.from_rows(spark, FISH), RU)
    sinks.write_marked(run.labelled, rows, f"{tmp_path}/out", now="2024-01-01T00:00:00Z")
    lines = [json.loads(r.value) for r in spark.read.text(f"{tmp_path}/out").coalesce(1).collect()]
    kinds = ["forum_start", "topic_start", "data", "topic_end", "topic_start", "topic_end", "topic_start", "data", "topic_end", "forum_end"]
    assert sorted(x["type"] for x in lines) == sorted(kinds)
    files = sorted((tmp_path / "out").glob("part-*"))
    assert [json.loads(x)["type"] for f in files for x in f.read_text(encoding="utf-8").splitlines()] == kinds


def test_vbulletin_listing(spark):
    page = '<a href="showthread.php?t=12">a</a><a href="/threads/big-carp.34/">b</a><a href="member.php?u=1">c</a><a href="showthread.php?t=12">again</a>'
    got = topics.topic_urls(spark.createDataFrame([("f", 0, page)], "forum_url string, page int, html string"), "vBulletin", "https://b/").orderBy("topic_seq").collect()
    assert [r.topic_url.split("b/", 1)[1].lstrip("/") for r in got] == ["showthread.php?t=12", "threads/big-carp.34/"]
    urls = topics.listing_urls(spark.createDataFrame([("f", "PHPBB"), ("g", "VBULLETIN")], "forum_url string, forum_type string")).collect()
    assert sum(r.forum_url == "f" for r in urls) == 10 and [r.url for r in urls if r.forum_url == "g"] == ["g"] and any(r.url == "f&start=225" for r in urls)


def test_records_and_newest_counters(spark, tmp_path):
    (tmp_path / "r.jsonl").write_text('{"type": "data", "text": "b"}\n{"type": "topic_start"}\n{"type": "data", "text": "a"}\n', encoding="utf-8")
    rows = records.read_records(spark, f"{tmp_path}/r.jsonl")
    assert [r.text for r in rows.orderBy("line_seq").collect()] == ["b", "a"]
    judged = dedup.near_duplicates(rows)
    assert dedup.removed_count(judged).first()[0] == 0
    sinks.write_deduplicated(judged.where("kept"), f"{tmp_path}/{sinks.deduplicated_path('r.jsonl')}")
    assert [json.loads(r.value)["text"] for r in spark.read.text(f"{tmp_path}/r_dedup.jsonl").collect()] == ["b", "a"]
    import os

    for k, name in enumerate(("s_counters_2024.json", "s_counters_2023.json", "other.json")):
        (tmp_path / name).write_text("{}")
        os.utime(tmp_path / name, (1000 + k * 10, 1000 + k * 10))
    assert records.newest_counters(spark, str(tmp_path), "s").endswith("s_counters_2023.json")


def test_cleaned_pages_with_a_header(spark):
    rows = spark.createDataFrame([("u1", f'<div class="content">{"long post text " * 5}</div>'), ("u2", "<p>none</p>")], "url string, html string")
    got = {r.url: r.cleaned for r in html.clean_html(rows, url="url", now="2024-01-01T00:00:00").collect()}
    assert got["u1"].startswith("Topic URL: u1\nDownloaded: 2024-01-01T00:00:00\n====") and got["u1"].endswith("long post text") and got["u2"] == ""


def test_cut_off_references_in_pages_are_those_of_the_sql(spark, tmp_path):
    """Headings of these pages are cut after some characters, in the middle of a reference at times."""
    post = "one &amp; two &copy; " * 5
    rows = spark.createDataFrame([(1, f"<article><h1>a &amp</h1><p>{post}</p></article>"), (2, f"<article><h1>a &quo</h1><p>{post}&copy</p></article>")], "page_id long, html string")
    rows.write.parquet(f"{tmp_path}/pages.parquet")
    got = {r.page_id: r.cleaned for r in queries.cleaned_pages(spark, str(tmp_path)).collect()}
    duckdb.sql(f"CREATE OR REPLACE TEMP VIEW pages AS SELECT * FROM '{tmp_path}/pages.parquet/*.parquet'")
    assert got == dict(duckdb.sql(queries.ORACLE_SQL["cleaned_pages"]).fetchall()) and got[1].startswith("a &amp one & two ©")
    assert html.post_texts("<div class=message>a &amp</div>") == ["a &"]  # as browsers read it


def test_cut_off_references_in_titles_are_those_of_the_sql(spark, tmp_path):
    rows = spark.createDataFrame([(1, "<title>a&amp;b &amp</title>"), (2, "<title>c &middot</title>"), (3, "<title>d &copy; e &am</title>")], "page_id long, html string")
    rows.write.parquet(f"{tmp_path}/pages.parquet")
    got = {r.topic_url: (r.title, r.author) for r in queries.page_titles(spark, str(tmp_path)).collect()}
    duckdb.sql(f"CREATE OR REPLACE TEMP VIEW pages AS SELECT * FROM '{tmp_path}/pages.parquet/*.parquet'")
    assert got == {u: (t, a) for u, t, a in duckdb.sql(queries.ORACLE_SQL["page_titles"]).fetchall()} and got["1"] == ("a&b &amp", None)
    assert topics.page_metadata("<title>a &amp</title>", "VBULLETIN")[2] == "a &"  # as browsers read it


def distance(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        row, last = [i], row
        for j, y in enumerate(b, 1):
            row.append(min(last[j] + 1, row[-1] + 1, last[j - 1] + (x != y)))
    return row[-1]


def edited(rng, text, n):
    """``text`` after ``n`` random edits of all kinds."""
    t = list(text)
    for _ in range(n):
        at, kind = rng.randrange(len(t) + 1), rng.randrange(3)
        t[at : at + (kind > 0)] = [rng.choice("abcdeé🐟 ")] * (kind < 2)
    return "".join(t)


@pytest.mark.parametrize("threshold", [0.3, 0.5, 0.8, 0.9, 0.97])
def test_near_texts_lose_no_pair(threshold, monkeypatch):
    """What may be similar, found in chunks and parts of any size, holds every pair that is."""
    rng = random.Random(int(threshold * 100))
    base = ["".join(rng.choice("abcdeé🐟 ") for _ in range(rng.randrange(1, 90))) for _ in range(12)]
    texts = sorted({t for b in base for t in (b, *(edited(rng, b, rng.randrange(1, 2 + int(len(b) * (1 - threshold)))) for _ in range(8))) if t})
    near = {(i, j) for j, b in enumerate(texts) for i, a in enumerate(texts[:j]) if distance(a, b) <= int(max(len(a), len(b)) * round(1 - threshold, 10) + 1e-9)}
    ids = np.arange(len(texts))
    for chunk, pairs in ((1 << 19, 1 << 20), (100, 7)):
        monkeypatch.setattr(dedup, "CHUNK", chunk)
        monkeypatch.setattr(dedup, "PAIRS", pairs)
        found = [(min(i, j), max(i, j)) for s, l in dedup._near_texts((ids, texts), (ids, texts), threshold) for i, j in zip(s.tolist(), l.tolist(), strict=True)]
        assert near and near <= set(found) and len(found) == len(set(found))


def test_similar_pairs_in_a_grid_of_blocks(spark, tmp_path, monkeypatch):
    """Blocks of a few texts, and as few rows sent as there are texts and blocks: not one a character."""
    rng = random.Random(4)
    base = ["".join(rng.choice("abcde ") for _ in range(rng.randrange(90, 300))) for _ in range(30)]
    texts = [t for b in base for t in (b, edited(rng, b, len(b) // 20), edited(rng, b, len(b) // 10), edited(rng, b, len(b) // 8))]
    spark.createDataFrame(list(enumerate(texts)), "id long, text string").write.parquet(f"{tmp_path}/texts")
    rows = spark.read.parquet(f"{tmp_path}/texts")
    want = {(i, j) for j, b in enumerate(texts) for i in range(j - j % 4, j) if distance(texts[i], b) * 10 <= max(len(texts[i]), len(b))}
    jvm, store = spark._jvm, spark.sparkContext._jsc.sc().statusStore()
    none = jvm.java.util.ArrayList()
    stages = lambda: {(x.stageId(), x.attemptId()): x.shuffleWriteRecords() for x in jvm.scala.jdk.javaapi.CollectionConverters.asJava(store.stageList(none, False, False, spark.sparkContext._gateway.new_array(jvm.double, 0), none))}
    before, small = stages(), spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")  # as tables are too large
    try:
        assert {(r.a, r.b) for r in dedup.similar_pairs(rows).collect()} == want and len(want) > 40
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", small)
    spark.sparkContext._jsc.sc().listenerBus().waitUntilEmpty(30_000)
    assert sum(n for k, n in stages().items() if k not in before) < 10 * len(texts)
    monkeypatch.setattr(dedup, "BLOCK", 700)
    monkeypatch.setattr(dedup, "SLICE", 900)
    assert sorted((r.a, r.b) for r in dedup.similar_pairs(rows).collect()) == sorted(want)
