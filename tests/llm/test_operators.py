"""Every operator against brute force on a small table with nulls, empty texts, copies, ties and clashing column names."""

import collections
import hashlib
import math
import random
import re
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from termforge.llm import common, components, decontam, exact_dedup, language_id, lm_score, near_dedup, packing, pii, substring_dedup, token_rollup, url_filter

KIND = "doc_id long, text string, lang string, source string, n_chars long, kept boolean, sid int, n long, rep string"


def words(rng, n, vocabulary):
    return " ".join(rng.choice(vocabulary) for _ in range(n))


@pytest.fixture(scope="module")
def rows():
    rng = random.Random(11)
    en = [f"{a}{b}" for a in "the and wh ing ou er".split() for b in "tion ly ed sh at".split()]
    de = [f"{a}{b}" for a in "der und sch ung äu öß".split() for b in "keit lich ein ge zu".split()]
    texts = [(words(rng, rng.randrange(20, 90), en), "en") for _ in range(30)] + [(words(rng, rng.randrange(20, 90), de), "de") for _ in range(20)]
    base = words(rng, 120, en)
    texts += [(base, "en"), (base, "en"), (base.replace(" ", "\n ", 3), "en"), (base + " tail", "en"), (words(rng, 30, en) + " " + base[100:400] + " " + words(rng, 20, en), "en")]
    for k in range(8):  # near copies of one text
        w = base.split()
        for _ in range(k):
            w[rng.randrange(len(w))] = f"new{k}"
        texts.append((" ".join(w), "en"))
    texts += [(None, None), ("", "en"), ("   \n", "de"), ("1234 !!", "en"), ("a b c", None), ("a b c", "en"), ("ab " * 300, "en"), ("z" * 5000, "en")]
    texts += [("Mail a.b@c-d.org, b@x.y.z! 10.0.0.255 1.2.3.999 4111 1111 1111 1111 and +49 (30) 123-4567 token", "en")] * 4
    out = [(i * 3 % 101 if i else 500, t, lang, f"s{i % 3}", len(t or "")) for i, (t, lang) in enumerate(texts)]
    out += [out[5], (None, base, "en", None, 1), (None, None, None, None, None)]  # a repeated row, rows without id
    return out


@pytest.fixture(scope="module")
def docs(spark, rows):
    return spark.createDataFrame([(*r, None, 7, 8, "x") for r in rows], KIND).repartition(3)


@pytest.fixture(scope="module")
def empty(spark):
    return spark.createDataFrame([], KIND)


LAST = 2**63 - 1


def sid(i):
    return LAST if i is None else i


def test_near_duplicates(docs, rows):
    sets = []
    for i, t, *_ in rows:
        w = re.findall(rb"[^\x20\x09-\x0D]+", (t or "").encode().lower())
        sets.append((sid(i), frozenset(tuple(w[k : k + 5]) for k in range(max(1, len(w) - 4))) if w else frozenset()))
    parent = {i: i for i, _ in sets}

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for i, a in sets:
        for j, b in sets:
            if a and b and 100 * len(a & b) >= 75 * len(a | b) and root(i) != root(j):
                parent[max(root(i), root(j))] = min(root(i), root(j))
    got = near_dedup.near_duplicates(docs).collect()
    assert collections.Counter(near_dedup.near_duplicates(docs, block=2).collect()) == collections.Counter(got)
    want = collections.Counter((None if i == LAST else i, len(s), None if root(i) == LAST else root(i), root(i) == i) for i, s in sets)
    # rows without words are alone even if another row has their id
    lone = {(None if i == LAST else i) for i, s in sets if not s}
    assert collections.Counter(r[:] for r in got if r.doc_id not in lone) == collections.Counter({k: v for k, v in want.items() if k[0] not in lone})
    assert all(r.component_id == r.doc_id for r in got if r.n_shingles == 0) and len(got) == len(rows)


def test_blocks_give_the_links_of_each_probe():
    rng = np.random.default_rng(0)
    sets = [np.unique(rng.integers(0, 40, 30)) for _ in range(40)]
    members = [(i, i, s) for i, s in enumerate(sets)]
    links = list(near_dedup._block_links(members, members, 50))
    parent = list(range(40))

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for i in range(40):
        for j in range(40):
            a, b = set(sets[i]), set(sets[j])
            if 100 * len(a & b) >= 50 * len(a | b):
                parent[root(i)] = root(j)
    want = len({root(i) for i in range(40)})
    parent = list(range(40))
    for a, b in links:
        parent[root(a)] = root(b)
    assert len({root(i) for i in range(40)}) == want and len(links) < 40


@pytest.mark.parametrize("how", ["inner", "left"])
@pytest.mark.parametrize("hot", [2, 10_000])
def test_hot_join_equals_a_join(spark, monkeypatch, how, hot):
    monkeypatch.setattr(common, "HOT", hot)
    big = spark.createDataFrame([(k, i) for i, k in enumerate([1] * 20 + [2, 2, 3, None])], "k long, i long")
    small = spark.createDataFrame([(1, "a", 20), (2, "b", 2)], "k long, v string, times long")
    got = common.hot_join(big, small, "k", "times", 24, how)
    assert sorted(map(str, got.collect())) == sorted(map(str, big.join(small.drop("times"), "k", how).collect()))
    two = [x.withColumn("k2", x.k + 1) for x in (big, small)]
    got = common.hot_join(*two, ["k", "k2"], "times", 24, how).select("k", "k2", "i", "v")
    assert sorted(map(str, got.collect())) == sorted(map(str, two[0].join(two[1].drop("times"), ["k", "k2"], how).select("k", "k2", "i", "v").collect()))


@pytest.mark.parametrize("hot", [2, 10_000])
def test_hot_hosts_get_their_scores(spark, monkeypatch, hot):
    """The pages of a host that holds most rows, and pages without a host, are judged like any others."""
    monkeypatch.setattr(common, "HOT", hot)
    link = '<a href="http://b.com/de/">t</a>'
    urls = ["http://big.net/x"] * 30 + [None] * 20 + ["http://b.com/de/", "http://small.net/"]
    pages = spark.createDataFrame([(i, u, link if i == 0 else None) for i, u in enumerate(urls)], "page_id long, url string, html string")
    got = {r.page_id: r for r in url_filter.judge_urls(pages).collect()}
    assert len(got) == len(urls) and {got[i].verdict for i in range(30)} == {"block"} and len({got[i].distrust for i in range(30)}) == 1
    assert all((got[i].host, got[i].verdict, got[i].trust) == ("", "allow", 0.0) for i in range(30, 50)) and got[51].verdict == "allow"


def test_components(spark):
    chain = [(i, i + 1) for i in range(40)] + [(100, 101), (200, 100)]
    got = {r.node: r.component for r in components.connected_components(spark.createDataFrame(chain, "a long, b long")).collect()}
    assert got == {**{i: 0 for i in range(41)}, 100: 100, 101: 100, 200: 100}


def test_exact_duplicates(docs, rows):
    groups = collections.defaultdict(list)
    for i, t, *_ in rows:
        groups[re.sub(r"[\x20\x09-\x0D]+", " ", t or "")].append(sid(i))
    want = collections.Counter()
    for x, ids in groups.items():
        for k, i in enumerate(sorted(ids)):
            want[(None if i == LAST else i, None if min(ids) == LAST else min(ids), len(ids), k == 0, hashlib.sha256(x.encode()).hexdigest())] += 1
    assert collections.Counter(r[:] for r in exact_dedup.exact_duplicates(docs).collect()) == want
    kept = exact_dedup.distinct_texts(docs)
    assert kept.columns == docs.columns and kept.count() == len(groups)


def test_exact_duplicates_over_many_ranges(spark, monkeypatch):
    """A text of a third of all rows is cut over ranges; texts alike in their first bytes are told apart; clashing columns come back."""
    monkeypatch.setattr(exact_dedup, "PART_ROWS", 7)
    rng = random.Random(3)
    head = "same beginning of many texts, longer than a splitter "
    texts = ["hot  text"] * 50 + [head + str(rng.randrange(30)) * rng.randrange(1, 3) for _ in range(60)] + ["", None, " ", "hot text "] * 3 + ["x" * 300_000, "x" * 300_000 + "y"] * 2
    ids = rng.sample(range(-500, 500), len(texts))
    docs = spark.createDataFrame([(i, t, "a", b"b") for i, t in zip(ids, texts, strict=True)], "doc_id long, text string, sid string, sha binary").repartition(5)
    groups = collections.defaultdict(list)
    for i, t in zip(ids, texts, strict=True):
        groups[re.sub(r"[\x20\x09-\x0D]+", " ", t or "")].append(i)
    want = sorted((i, min(x), len(x), i == min(x), hashlib.sha256(t.encode()).hexdigest()) for t, x in groups.items() for i in x)
    assert sorted(r[:] for r in exact_dedup.exact_duplicates(docs).collect()) == want
    kept = exact_dedup.distinct_texts(docs)
    assert kept.columns == docs.columns and sorted((r.doc_id, r.sid, bytes(r.sha)) for r in kept.collect()) == sorted((min(x), "a", b"b") for x in groups.values())


def test_repeated_passages(docs, rows):
    seen, want = {}, collections.Counter()
    for i, t, *_ in rows:
        b = (t or "").encode()
        for k in range(len(b) - 49):
            seen[b[k : k + 50]] = min(seen.get(b[k : k + 50], LAST), sid(i))
    for i, t, *_ in rows:
        b, gone = (t or "").encode(), bytearray(len((t or "").encode()))
        for k in range(len(b) - 49):
            if seen[b[k : k + 50]] < sid(i):
                gone[k : k + 50] = b"\1" * 50
        want[(i, len(b), sum(gone), len(re.findall(b"\1+", bytes(gone))), hashlib.sha256(bytes(c for c, g in zip(b, gone, strict=True) if not g)).hexdigest())] += 1
    got = substring_dedup.repeated_passages(docs).select("doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256").collect()
    assert collections.Counter(r[:] for r in got) == want and any(0 < k[2] < k[1] for k in want)


def test_suffix_ranks_and_factors():
    rng = np.random.default_rng(1)
    ctx = rng.integers(97, 99, (30, 80)).astype(np.uint8)
    rank = substring_dedup.suffix_ranks(ctx, 50, 27)
    strings = [[ctx[i, k : k + 50].tobytes() for k in range(27)] for i in range(30)]
    order = sorted({s for row in strings for s in row})
    assert (rank == [[order.index(s) for s in row] for row in strings]).all()
    ranks, doc = rng.integers(0, 6, 200), rng.integers(0, 9, 200)
    assert substring_dedup.previous_factors(ranks, doc).tolist() == [any(doc[(ranks == r)] < d) for r, d in zip(ranks, doc, strict=True)]


def test_languages(docs, rows):
    got = {r.doc_id: r for r in language_id.languages_of(docs).collect() if r.doc_id is not None}
    lang = {i: (t, x) for i, t, x, *_ in rows if i is not None}
    for i, (t, x) in lang.items():
        assert got[i].held_out == (zlib.crc32(str(i).encode()) % 4 == 2)
        assert (got[i].lang_pred == "und") == (not any(c.isalpha() for c in t or "")) and 0 <= got[i].score <= 1
    held = [(got[i].lang_pred, x) for i, (t, x) in lang.items() if got[i].held_out and x and len(t or "") > 80]
    assert held and all(a == b for a, b in held)
    kept = language_id.identified(docs)
    assert kept.columns == docs.columns and kept.count() == sum(any(c.isalpha() for c in t or "") for _, t, *_ in rows)


def test_languages_equal_brute_force(docs, rows):
    """Profiles, ranks and distances counted gram by gram."""
    code = lambda b: b + 32 if 65 <= b <= 90 else b if 97 <= b <= 122 or b >= 128 else 32

    def grams(text):
        x = [code(b) for b in (text or "").encode()]
        out = collections.Counter()
        for n in (1, 2, 3):
            for i in range(len(x) - n + 1):
                g = x[i : i + n]
                if not (n == 1 and g[0] == 32 or any(a == b == 32 for a, b in zip(g, g[1:], strict=False))):
                    out[(n << 24) + sum(c << 8 * (n - 1 - k) for k, c in enumerate(g))] += 1
        return out

    def ranked(counts, most):
        return [g for g, _ in sorted(counts.items(), key=lambda x: (-x[1], x[0]))[:most]]

    train = [(t, lang) for i, t, lang, *_ in rows if lang is not None and t is not None and zlib.crc32(b"" if i is None else str(i).encode()) % 4 != 2]
    profiles = {lang: ranked(sum((grams(t) for t, x in train if x == lang), collections.Counter()), language_id.PROFILE) for lang in sorted({x for _, x in train})}
    size = max(map(len, profiles.values()))
    want = collections.Counter()
    for i, t, *_ in rows:
        own, best = ranked(grams(t), language_id.RANKED), (size * 10**6, "und")
        for lang, p in profiles.items():
            place = {g: k for k, g in enumerate(p)}
            best = min(best, (sum(abs(place[g] - k) if g in place else size for k, g in enumerate(own)), lang), key=lambda x: x[0])
        letter = any(c.isalpha() for c in t or "")
        want[i, zlib.crc32(b"" if i is None else str(i).encode()) % 4 == 2, best[1] if letter else "und", round(1 - best[0] / (size * max(1, len(own))), 9) if letter else 0.0] += 1
    assert collections.Counter((r.doc_id, r.held_out, r.lang_pred, round(r.score, 9)) for r in language_id.languages_of(docs).collect()) == want


def test_personal_data(docs, rows):
    email, ip = re.compile(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+"), re.compile(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)")
    card, phone = re.compile(r"[0-9]([\x20-]?[0-9])+"), re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
    digits = lambda m: re.sub("[^0-9]", "", m[0])

    def spans(t):
        out = [("email", *m.span()) for m in email.finditer(t)] + [("ip", *m.span()) for m in ip.finditer(t) if all(int(x) < 256 for x in m[0].split("."))]
        out += [("card", *m.span()) for m in card.finditer(t) if 16 <= len(digits(m)) <= 19 and pii.luhn(digits(m))]
        return out + [("phone", *m.span()) for m in phone.finditer(t) if 8 <= len(digits(m)) <= 15]

    find, rng = pii.finder(), random.Random(2)
    for _ in range(3000):
        t = "".join(rng.choice("a1.@+-( 4") for _ in range(rng.randrange(40)))
        assert find(t) == spans(t), t
    got = pii.personal_data(docs).collect()
    want = collections.Counter((i, hashlib.sha256(pii.spans_text(spans(t or "")).encode()).hexdigest()) for i, t, *_ in rows)
    assert collections.Counter((r.doc_id, r.base_sha256) for r in got) == want
    assert pii.sanitize_text("mail a@b.c now", "email:5:10") == "mail <EMAIL> now" and pii.sanitize_text("x secret", "term:2:8", generalise=False) == "x "
    assert [t[a:b] for t in ('my password=abc123x, "api_key": "Zz9-hello" token: short1 token: nodigits',) for _, a, b in pii.secrets()(t)] == ["abc123x", "Zz9-hello", "short1"]


def brute_terms(texts, prior=1.0, disclosure=0.9):
    """For each text the places of the terms that disclose one of its entities, counted pair by pair."""
    find, more = pii.finder(), pii.secrets()
    n, own, terms = len(texts), [], []
    for t in texts:
        spans = find(t) + more(t)
        own.append({(k, t[a:b].lower()) for k, a, b in spans})
        words = []
        for m in re.finditer(r"[^\x20\x09-\x0D]+", t):
            w = m[0].strip(pii.EDGES)
            a = m.start() + len(m[0]) - len(m[0].lstrip(pii.EDGES))
            if w:
                words.append(("".join(c.lower() if "A" <= c <= "Z" else c for c in w), a, a + len(w), any(a < y and x < a + len(w) for _, x, y in spans)))
        terms.append(words)
    df = collections.Counter(w for words in terms for w in {x[0] for x in words})
    holds = collections.Counter(e for es in own for e in es)
    both = collections.Counter((e, w) for es, words in zip(own, terms, strict=True) for e in es for w in {x[0] for x in words if not x[3]})
    out = []
    for es, words in zip(own, terms, strict=True):
        tell = set()
        for e in es:
            p = holds[e] / n
            for w in {x[0] for x in words}:
                pmi = math.log((both[e, w] + prior * p) / (df[w] + prior) / p)
                if holds[e] < n and both[e, w] and pmi >= disclosure * -math.log(p) - 1e-9:
                    tell.add(w)
        out.append([(a, b) for w, a, b, over in words if w in tell and not over])
    return out


def test_terms_that_disclose_equal_brute_force(spark, docs, rows):
    rng = random.Random(8)
    vocabulary = [f"w{k}" for k in range(40)]
    who = [("ann@x.org", "Ann", "hill-street"), ("bob@y.org", "Bob", "(pond)"), ("10.1.2.3", "server", "rack"), ("password=q1w2e3r4", "vault", "Door")]
    texts = []
    for k in range(60):
        w = words(rng, rng.randrange(5, 40), vocabulary).split()
        if k % 3 == 0:
            for e in rng.sample(who, rng.randrange(1, 3)):
                for x in e:
                    w.insert(rng.randrange(len(w)), x)
        if k % 7 == 0:
            w.append(f"only{k} once{k}!")  # found in one document
        if k == 33:
            w += ["hill-street", "w3", "é,", "Ünique\U0001f600,"]
        texts.append(" ".join(w))
    texts += [texts[0], texts[0], None, "", "solo@z.org", "common ann@x.org"] + [t for _, t, *_ in rows]
    ids = list(range(len(texts)))
    ids[3], ids[4], ids[5] = None, None, 1  # rows without id, two rows of one id
    table = spark.createDataFrame([(i, t, k) for k, (i, t) in enumerate(zip(ids, texts, strict=True))], "doc_id long, text string, rid int").repartition(4)
    want = brute_terms([t or "" for t in texts])
    assert sum(map(len, want)) > 50 and len({t[a:b] for t, own in zip(texts, want, strict=True) for a, b in own}) > 10
    got = pii.personal_data(table).collect()
    spans = lambda r: tuple((int(a), int(b)) for k, a, b in (x.split(":") for x in r.spans.split(",") if x) if k == "term")
    assert collections.Counter((r.doc_id, spans(r)) for r in got) == collections.Counter((i, tuple(x)) for i, x in zip(ids, want, strict=True))
    assert all(r.n_term == len(spans(r)) and r.n_spans == len([x for x in r.spans.split(",") if x]) for r in got)
    # each row comes back with its own text, and no protected value or term that discloses it is left
    clean = collections.Counter((r.doc_id, r.text) for r in pii.sanitized(table).collect())
    full = {(r.doc_id, r.spans) for r in got}
    assert clean == collections.Counter((i, pii.sanitize_text(t, next(s for d, s in full if d == i and (t is None or spans_fit(t, s, x))))) for i, t, x in zip(ids, texts, want, strict=True))
    assert not any("ann@x.org" in (t or "") or "q1w2" in (t or "") for _, t in clean)
    assert pii.sanitized(table, generalise=False).where("text like '%<TERM>%'").count() == 0


def spans_fit(text, spans, terms):
    """Whether ``spans`` are those of this text, among rows of one id."""
    base = pii.spans_text(pii.finder()(text) + pii.secrets()(text))
    return spans == ",".join(x for x in (base, pii.spans_text([("term", a, b) for a, b in terms])) if x)


def test_scores(docs, rows):
    tokens = [(i, [*re.findall(rb"[^\x20\x09-\x0D]+", (t or "").encode().lower()), None]) for i, t, *_ in rows]
    fold = lambda i: zlib.crc32(b"" if i is None else str(i).encode()) % 5 == 1
    c = collections.Counter(x for i, t in tokens if not fold(i) for x in t)
    total = sum(c.values())
    z = total + 0.5 * (len(c) + 1)
    want = sorted((sid(i), fold(i), len(t), sum(c[x] > 0 for x in t), round(sum(math.log10((c[x] + 0.5) / z) for x in t), 6)) for i, t in tokens)
    got = lm_score.score_documents(docs).collect()
    assert sorted((sid(r.doc_id), r.held_out, r.n_tokens, r.n_known, round(r.base_score, 6)) for r in got) == want
    assert {r.train_tokens for r in got} == {total} and all(r.score < 0 for r in got)


def test_model_is_a_distribution_and_gives_the_scores(docs, rows, monkeypatch):
    """After training the chances of all tokens, and an unknown one a rare leaf, sum to 1 in any history; a text's score is their product."""
    monkeypatch.setattr(lm_score, "HEAVY", 40)  # most words are in rare leaves
    fold = lambda i: zlib.crc32(b"" if i is None else str(i).encode()) % 5 == 1
    whole = {False: [], True: []}
    for i, t, *_ in rows:
        word = [x for x in re.findall(rb"[^\x20\x09-\x0D]+", (t or "").encode().lower())]
        whole[fold(i)].append((i, [*(common.hash_word(x) for x in word), lm_score.END]))
    c = collections.Counter(x for _, t in whole[False] for x in t)
    size = sum(len((t or "").encode()) for _, t, *_ in rows)
    model, total, kinds = lm_score.train(docs.where(~(F.pmod(F.crc32(F.coalesce(F.col("doc_id").cast("string"), F.lit("")).cast("binary")), F.lit(5)) == 1)), 16, size)
    assert total == sum(c.values()) and kinds == len(c) and np.abs(model.weights).sum() > 1
    heavy = set(model.token.tolist())
    assert heavy == set(sorted(c, key=lambda t: (-c[t], t - (1 << 64) if t >> 63 else t))[:40])
    rare = [sum(c[t] + 0.5 for t in c if t not in heavy and t % 16 == k) + 0.5 for k in range(16)]

    def chance(before, second, leaves):
        """Of each leaf after a history, one class after the other."""
        t = np.array([second, before, 0], np.uint64)
        features = [f[2:] for f in lm_score.histories(t, np.array([0, 3]))]
        if not before:
            features = [f[:1] for f in lm_score.histories(t[2:], np.array([0, 1]))]
        elif not second:
            features = [f[1:] for f in lm_score.histories(t[1:], np.array([0, 2]))]
        out = []
        for leaf in leaves:
            p = 1.0
            for node, digit in zip(model.path[leaf], model.digit[leaf], strict=True):
                if node >= 0:
                    _, n, _, r = model.decisions(np.array([leaf]), features)
                    row = [x[n.tolist().index(node)] for x in r]
                    z = np.exp(model.bias[node].astype(float) + sum(model.weights[x].astype(float) for x in row))
                    p *= z[digit] / z.sum()
            out.append(p)
        return out

    for before, second in ((0, 0), (whole[False][0][1][0], 0), (whole[False][0][1][5], whole[False][0][1][4]), (7, 8)):
        assert sum(chance(before, second, range(len(model.depth)))) == pytest.approx(1, abs=1e-5)
    got = collections.defaultdict(list)
    for r in lm_score.score_documents(docs).collect():
        got[r.doc_id].append(r.score)
    for i, t in [*whole[True][:6], *whole[False][:6]]:
        want = 0
        for k, x in enumerate(t):
            leaf = model.token.tolist().index(x) if x in heavy else len(model.token) + x % 16
            want += math.log10(chance(t[k - 1] if k else 0, t[k - 2] if k > 1 else 0, [leaf])[0])
            if x not in heavy:
                want += math.log10((c[x] + 0.5) / rare[x % 16])
        assert any(math.isclose(want, x, rel_tol=1e-3, abs_tol=1e-3) for x in got[i]), (i, want, got[i])
    again = lm_score.score_documents(docs.repartition(7)).collect()  # the split does not matter
    assert np.allclose(sorted(r.score for r in again), sorted(x for xs in got.values() for x in xs), rtol=1e-4, atol=1e-4)


def test_more_text_teaches_more(spark):
    """Held-out texts of a language whose words follow one another score better than by their frequency, and better still after more text."""
    rng = random.Random(9)
    word = [f"w{k}" for k in range(60)]

    def text():
        out = [rng.choice(word)]
        while len(out) < 80:
            out.append(word[(int(out[-1][1:]) * 7 + rng.randrange(3)) % 60])
        return " ".join(out)

    gain = []
    for n in (20, 400):
        rows = lm_score.score_documents(spark.createDataFrame([(i, text()) for i in range(n)], "doc_id long, text string")).where("held_out").collect()
        gain.append(sum(r.score - r.base_score for r in rows) / sum(r.n_tokens for r in rows))
    assert 0 < gain[0] < gain[1] and gain[1] > 0.4


def test_decontamination(spark, docs, rows):
    items = [(1, " ".join((rows[0][1]).split()[3:20])), (2, "a B c"), (10, rows[50][1]), (10, rows[50][1]), (3, None), (4, "!!"), (None, rows[1][1]), (5, "never seen anywhere at all")]
    bench = spark.createDataFrame([(*x, 1) for x in items], "item_id long, text string, n_hit int")
    word = re.compile(rb"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
    windows = collections.defaultdict(set)
    for i, t in items:
        w = word.findall((t or "").encode().lower())
        for k in range(max(1, len(w) - 9) if w else 0):
            windows[tuple(w[k : k + 10])].add(i)
    want = collections.Counter()
    for i, t, *_ in rows:
        w, hit, names = word.findall((t or "").encode().lower()), set(), set()
        for x, who in windows.items():
            for k in range(len(w) - len(x) + 1):
                if tuple(w[k : k + len(x)]) == x:
                    hit |= set(range(k, k + len(x)))
                    names |= who - {None}
        want[(i, len(w), len(hit), len(names), hashlib.sha256(",".join(sorted(map(str, names))).encode()).hexdigest(), bool(hit))] += 1
    cols = ("doc_id", "n_words", "n_hit", "n_items", "items_sha256", "contaminated")
    for block in (decontam.BLOCK_WORDS, 25):  # all at once, and in several passes
        assert collections.Counter(r[:] for r in decontam.contamination(docs, bench, block_words=block).select(*cols).collect()) == want
        assert decontam.uncontaminated(docs, bench, block_words=block).count() == sum(v for k, v in want.items() if not k[5])
    assert decontam.contamination(docs, bench.where("false")).where("contaminated").count() == 0


def test_packing(docs, rows):
    from public_tokenizers import path
    from tokenizers import Tokenizer

    exact = Tokenizer.from_file(path("byte_bpe_50k.json"))
    got = packing.pack_documents(docs, limit=128).collect()
    want = collections.Counter()
    for i, t, *_ in rows:
        ids = [*exact.encode(t or "", add_special_tokens=False).ids, 0]
        first = len(ids) % 128 or 128
        cuts = [0, *range(first, len(ids) + 1, 128)]
        for k, (a, b) in enumerate(zip(cuts, cuts[1:], strict=False)):
            want[(i, k, a, b - a, zlib.crc32(np.array(ids[a:b], "<u4").tobytes()))] += 1
    assert collections.Counter(r[:5] for r in got) == want
    by = collections.defaultdict(list)
    for r in got:
        by[r.sequence_id].append((r.offset, r.length))
    for parts in by.values():
        end = 0
        for at, n in sorted(parts):
            assert at == end
            end += n
        assert end <= 128
    total = sum(r.length for r in got)
    assert len(by) <= math.ceil(total / 128) + 2
    text = "x <|endoftext|> y"
    assert packing.encoder()(text).tolist() == exact.encode(text, add_special_tokens=False).ids


def test_plan_reaches_the_bound_where_there_is_one():
    assert sum(n for _, n in packing.plan_bins({6: 2, 5: 2, 4: 2, 3: 2, 2: 1}, 10)) == 4
    assert packing.plan_bins({}, 10) == []


def test_plan_backtracks_to_the_optimum():
    assert sum(n for _, n in packing.plan_bins(collections.Counter([20, 23, 25, 26, 30, 31, 43, 49, 50, 51, 51, 56, 57, 58]), 100)) == 6
    assert sum(n for _, n in packing.plan_bins({820: 2, 614: 6, 408: 2}, 2048)) == 3  # greedy descents end at 4

    def optimum(items, rooms, most):
        """The fewest sequences, or ``most`` if there is no plan with less."""
        if len(rooms) >= most or not items:
            return min(len(rooms), most)
        fits = [[*rooms[:i], r - items[0], *rooms[i + 1 :]] for i, r in enumerate(rooms) if r >= items[0]]
        for tried in (*fits, [*rooms, 50 - items[0]]):
            most = optimum(items[1:], tried, most)
        return most

    rng = random.Random(4)
    for _ in range(150):
        counts = collections.Counter(rng.randint(8, 27) for _ in range(rng.randint(1, 8)))
        plan = packing.plan_bins(counts, 50)
        assert sum((collections.Counter({s: f.count(s) * n for s in f}) for f, n in plan), collections.Counter()) == counts
        assert all(sum(f) <= 50 for f, _ in plan)
        assert sum(n for _, n in plan) == optimum(sorted(counts.elements(), reverse=True), [], sum(counts.values()))


def test_urls(spark):
    urls = ["http://a.example.ORG/es/1?x", "http://example.org/en/17", "http://example.org/en/2", "ftp://example.org", "http://b.com/fr/", "http://b.com/de/x#y", "http://b.com/en/", "http://c.net/q", None, "none"]
    link = '<a class="k" href="http://b.com/en/">t</a><a href=/own>o</a>'
    pages = spark.createDataFrame([(i, u, link if i == 7 else None, 1) for i, u in enumerate(urls)], "page_id long, url string, html string, host int")
    got = {r.page_id: (r.host, r.path, r.rule, r.verdict) for r in url_filter.judge_urls(pages).collect()}
    assert got[0] == ("a.example.org", "/es/1", "example.org/es/", "block") and got[1][2:] == ("example.org/en/1", "block") and got[2][2:] == ("org/", "allow")
    assert got[3] == ("example.org", "", None, "allow") and got[4][2:] == ("com/fr/", "allow") and got[5] == ("b.com", "/de/x", "com/de/", "block")
    assert got[8] == got[9] == ("", "", None, "allow")
    # c.net links to b.com, which holds a blocked page and a trusted one: distrust flows back to it, and no trust reaches it
    assert got[7] == ("c.net", "/q", None, "block")
    assert url_filter.judge_urls(pages.where("false")).count() == 0


def test_url_verdicts_equal_brute_force(spark):
    """Rules and both walks over a random graph of hosts with links of all kinds, against a dense solution."""
    rng = random.Random(21)
    hosts = [f"h{k}.{rng.choice(['org', 'com', 'net', 'example.org'])}" for k in range(30)]
    pages = []
    for i in range(120):
        h = rng.choice(hosts)
        links = "".join(rng.choice(['<a href="http://{}/x">', "<A class=q HREF='https://{}/de/'>", "<a href=//{}>", '<a href="/own/{}">', '<a name="http://{}">']).format(rng.choice(hosts)) + "t</a>" for _ in range(rng.randrange(3)))
        pages.append((i, f"http://{h.upper() if i % 9 == 0 else h}/{rng.choice(['es/', 'en/1', 'en/2', 'fr/', 'de/', ''])}" + rng.choice(["", "?q=/de/", "#x"]), links or None))
    pages += [(200, None, "<a href='http://a.net'>"), (201, "no url", None), (3, *pages[3][1:])]
    table = spark.createDataFrame(pages, "page_id long, url string, html string").repartition(3)

    def split(url):
        m = re.match(r"(?s).*?://([^/?#]*)([^?#]*)", url or "")
        return (m[1].lower(), m[2]) if m else ("", "")

    def judged(host, path):
        fits = [(len(r), r, v) for v, r in url_filter.RULES if (host == r.split("/")[0] or host.endswith("." + r.split("/")[0])) and path.startswith(r[r.index("/") :])]
        return max(fits)[1:] if fits else (None, None)

    rows = [(i, *split(u), html) for i, u, html in pages]
    names = sorted({h for _, h, _, _ in rows if h} | {"a.net", *hosts})
    links = np.zeros((len(names),) * 2)
    for _, h, _, html in rows:
        for to in re.findall(r"(?is)<a\s(?:[^>]*?\s)?href\s*=\s*[\"']?([^\"'\s>]*)", html or ""):
            dst = split("x:" + to if to.startswith("//") else to)[0]
            if h and dst and dst != h:
                links[names.index(h), names.index(dst)] += 1
    seeds = {v: np.array([sum(judged(h, p)[1] == v for _, h, p, _ in rows if h == n) for n in names], float) for v in ("allow", "block")}
    assert links.sum() > 40 and all(s.sum() > 3 for s in seeds.values())

    def solved(a, seed):
        a = a / np.maximum(a.sum(1, keepdims=True), 1)
        return np.linalg.solve(np.eye(len(names)) - 0.85 * a.T, 0.15 * seed / seed.sum())

    trust, distrust = solved(links, seeds["allow"]), solved(links.T, seeds["block"])
    got = collections.Counter()
    for r in url_filter.judge_urls(table).collect():
        k = names.index(r.host) if r.host else None
        assert k is None and r.trust == r.distrust == 0 or math.isclose(r.trust, trust[k], rel_tol=1e-4, abs_tol=1e-12) and math.isclose(r.distrust, distrust[k], rel_tol=1e-4, abs_tol=1e-12)
        got[r.page_id, r.host, r.path, r.rule, r.verdict] += 1
    want = collections.Counter()
    for i, h, p, _ in rows:
        rule, verdict = judged(h, p)
        want[i, h, p, rule, verdict or ("block" if h and distrust[names.index(h)] > trust[names.index(h)] else "allow")] += 1
    assert got == want and len({k[4] for k in want if not k[3]}) == 2


def test_propagation_equals_a_dense_walk(spark):
    edges = [("a", "b", 0.5), ("a", "c", 0.5), ("b", "c", 1.0), ("c", "a", 1.0)]
    got = {r.host: r.score for r in url_filter.propagate(spark.createDataFrame([("a", 1.0)], "host string, seed double"), spark.createDataFrame(edges, "src string, dst string, share double"), rounds=10).collect()}
    rank = {"a": 0.15}
    for _ in range(10):
        new = collections.Counter({"a": 0.15})
        for s, d, w in edges:
            new[d] += 0.85 * w * rank.get(s, 0)
        rank = new
    assert {k: round(v, 9) for k, v in got.items()} == {k: round(v, 9) for k, v in rank.items() if v}


def test_distrust_reaches_the_fixed_point(spark):
    """A chain of 26 hosts to a blocked one, and a cycle at its far end."""
    hosts = [f"h{i}.net" for i in range(26)] + ["b.com"]
    to = {h: [n] for h, n in zip(hosts, hosts[1:], strict=False)} | {"g.net": ["h0.net"]}
    to["h0.net"].append("g.net")
    hosts.append("g.net")
    html = {h: "".join(f'<a href="http://{n}/de/">x</a>' for n in to.get(h, ())) for h in hosts}
    pages = spark.createDataFrame([(i, f"http://{h}/de/", html[h]) for i, h in enumerate(hosts)], "page_id long, url string, html string").coalesce(1)
    got = {r.host: r for r in url_filter.judge_urls(pages, damping=0.5).collect()}
    a = np.zeros((len(hosts),) * 2)
    for src, targets in to.items():
        for dst in targets:
            a[hosts.index(src), hosts.index(dst)] = 1 / sum(dst in t for t in to.values())
    want = np.linalg.solve(np.eye(len(hosts)) - 0.5 * a, [0.5 * (h == "b.com") for h in hosts])
    assert {r.verdict for r in got.values()} == {"block"}
    assert all(math.isclose(got[h].distrust, w, rel_tol=1e-5) for h, w in zip(hosts, want, strict=True))


def test_rollups(spark, docs, tmp_path):
    store = token_rollup.RollupStore(spark, str(tmp_path / "store"))
    rows = token_rollup.counted(docs, "words-1")
    some = rows.where("source = 's1'")
    assert store.commit("a", token_rollup.signed(rows, 1)) and store.commit("b", token_rollup.signed(some, -1)) and not store.commit("b", token_rollup.signed(some, -1))
    want = sorted(map(str, rows.where("source is null or source != 's1'").groupBy(*token_rollup.KEYS).agg(F.sum("n_docs").alias("n_docs"), F.sum("n_tokens").alias("n_tokens"), F.sum("n_bytes").alias("n_bytes")).collect()))
    assert sorted(map(str, store.totals().collect())) == want
    store.compact()
    assert sorted(map(str, store.totals().collect())) == want and not store.commit("a", rows)
    (tmp_path / "store/delta/rows-broken").mkdir()  # rows without a mark do not count
    assert not store._mark("base", "00000001", "rows-late")  # a mark is never replaced
    assert [f.name for f in (tmp_path / "store/delta").iterdir() if not f.name.startswith(".")] == ["rows-broken"]
    assert store.commit("c", token_rollup.revision(some, token_rollup.counted(docs, token_rollup.BPE).where("source = 's1'"))) and store.batches() == {"a", "b", "c"}
    assert token_rollup.counted(docs, token_rollup.BPE).agg(F.sum("n_tokens")).first()[0] > 0


def test_token_rollup_query_equals_brute_force(spark, docs, rows, tmp_path):
    from public_tokenizers import path
    from tokenizers import Tokenizer

    from termforge.llm import queries

    exact = Tokenizer.from_file(path("byte_bpe_50k.json"))
    spark.createDataFrame([(3, 1, 0), (3, 1, 0), (6, 1, 1), (9, 0, 0), (None, 1, 1)], "doc_id long, toxic int, quality int").write.parquet(f"{tmp_path}/labels.parquet")
    docs.write.parquet(f"{tmp_path}/documents.parquet")
    want = collections.defaultdict(lambda: [0, 0, 0])
    for i, t, lang, source, _ in rows:
        if i not in (3, 6):
            for k, n in enumerate((1, len(exact.encode(t or "", add_special_tokens=False).ids), len((t or "").encode()))):
                want[(source, lang, token_rollup.BPE)][k] += n
    got = {r[:3]: list(r[3:]) for r in queries.op3_token_rollup(spark, str(tmp_path)).select(*token_rollup.KEYS, *token_rollup.SUMS).collect()}
    # deleted ones went with the words they came with, revised ones left no words behind
    assert got == dict(want)


def test_long_texts_are_hashed_in_pieces(monkeypatch):
    rng = np.random.default_rng(5)
    data = rng.integers(97, 100, 9000).astype(np.uint8)
    data[rng.integers(0, 9000, 600)] = 32
    data[2000:5500] = 120  # one word longer than several pieces
    at = np.array([0, len(data)])
    spans = common.word_spans(data, at, ~common.WHITE)[:2]
    whole, (pos, h) = common.span_hashes(data, *spans), substring_dedup.anchors(data, at, 50, 24)
    monkeypatch.setattr(common, "CHUNK_BYTES", 700)
    monkeypatch.setattr(substring_dedup, "CHUNK_BYTES", 700)
    assert (common.span_hashes(data, *spans) == whole).all()
    again = substring_dedup.anchors(data, at, 50, 24)
    assert (again[0] == pos).all() and (again[1] == h).all()


def test_one_long_text_among_short_ones(spark):
    """A text of 12 MB, with a copy that differs at its end, goes through every operator."""
    rng = random.Random(12)
    word = [f"{a}{b}" for a in "the and wh ing ou er".split() for b in "tion ly ed sh at".split()]
    text = " ".join(" ".join(rng.choices(word, k=50)) + f" mail{k}@x.org" * (k % 900 == 0) for k in range(46_000))
    docs = spark.createDataFrame([(1, text, "en", "a"), (2, text + " one more", "en", "a"), (3, "some other text", "en", "b"), (4, text[:4000], "en", "b")], "doc_id long, text string, lang string, source string").repartition(2).cache()
    assert len(text) > 12 << 20
    assert {r.doc_id: r.component_id for r in near_dedup.near_duplicates(docs).collect()} == {1: 1, 2: 1, 3: 3, 4: 4}
    assert [r.group_size for r in exact_dedup.exact_duplicates(docs).collect()] == [1] * 4
    gone = {r.doc_id: r.n_removed for r in substring_dedup.repeated_passages(docs).collect()}
    assert gone[1] < 1000 and gone[2] >= len(text) and gone[3] == 0 and gone[4] == 4000
    assert {r.lang_pred for r in language_id.languages_of(docs).collect()} == {"en"}
    assert {r.doc_id: r.n_email for r in pii.personal_data(docs).collect()} == {1: 52, 2: 52, 3: 0, 4: 1}
    assert {r.doc_id: r.n_tokens for r in lm_score.score_documents(docs).collect()}[1] == len(text.split()) + 1
    bench = spark.createDataFrame([(7, text[-120:])], "item_id long, text string")
    assert [r.doc_id for r in decontam.contamination(docs, bench).where("contaminated").collect()] == [1, 2]
    packed = packing.pack_documents(docs).groupBy("sequence_id").agg(F.sum("length").alias("n")).collect()
    assert max(r.n for r in packed) <= 2048 and sum(r.n for r in packed) > 4_000_000
    docs.unpersist()


def test_empty_tables(spark, empty):
    bench = spark.createDataFrame([(1, "a b")], "item_id long, text string")
    for out in (near_dedup.near_duplicates(empty), exact_dedup.exact_duplicates(empty), exact_dedup.distinct_texts(empty), substring_dedup.repeated_passages(empty), language_id.languages_of(empty), pii.personal_data(empty), lm_score.score_documents(empty), decontam.contamination(empty, bench), packing.pack_documents(empty), token_rollup.counted(empty, "words-1")):
        assert out.count() == 0
