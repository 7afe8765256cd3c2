"""The pipeline's rows against the stages done by hand on a small corpus."""

import collections
import math
import random
import re
import zlib

import numpy as np
import pytest

import corpus_pipeline


def words_of(text):
    return re.findall(rb"[^\x20\x09-\x0D]+", (text or "").encode().lower())


def corpus():
    rng = random.Random(17)
    en = [f"{a}{b}" for a in "the and wh ing ou er".split() for b in "tion ly ed sh at".split()]
    de = [f"{a}{b}" for a in "der und sch ung äu öß".split() for b in "keit lich ein ge zu".split()]
    text = lambda v, n: " ".join(rng.choice(v) for _ in range(n))
    texts = [text(en, rng.randrange(30, 200)) for _ in range(25)] + [text(de, rng.randrange(30, 200)) for _ in range(15)]
    base = text(en, 150)
    near = [" ".join(base.split()[:k] + ["changed"] + base.split()[k:]) for k in (3, 70, 149)]
    item = text(de, 30)
    texts += [base, base, base.replace(" ", "\n", 4), *near, "before " + item + " after", item[:40], text(en, 4000), None, None, "", "123 456", "a b", "a b"]
    rows = [(k * 7 % 211, t, "de" if t in texts[25:40] else "en", f"s{k % 2}", len(t or "")) for k, t in enumerate(texts)]
    return rows + [rows[2], (None, texts[3], "en", "s1", 1), (None, text(en, 40), "en", None, 1), (None, None, None, None, None)], [(1, item), (2, None), (None, "zz")]


def by_hand(rows, items):
    """The documents that each stage keeps, as (doc_id, text), and the packed pieces."""
    # language: what has a letter is identified
    left = [(r[0], r[1]) for r in rows if any(c.isalpha() for c in r[1] or "")]
    stages = [left]
    # exact copies: the smallest id stays, rows without id last, one of equal rows
    groups = collections.defaultdict(list)
    for i, t in left:
        groups[re.sub(r"[\x20\x09-\x0D]+", " ", t)].append((math.inf if i is None else i, t))
    left = [(None if i == math.inf else i, t) for i, t in (min(g, key=lambda x: x[0]) for g in groups.values())]
    stages.append(left)
    sets = [frozenset(tuple(w[k : k + 5]) for k in range(max(1, len(w) - 4))) for w in (words_of(t) for _, t in left)]
    parent = list(range(len(left)))

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a in range(len(left)):
        for b in range(a):
            if 100 * len(sets[a] & sets[b]) >= 75 * len(sets[a] | sets[b]):
                parent[root(a)] = root(b)
    least = {}
    for k, (i, _) in enumerate(left):
        least[root(k)] = min(least.get(root(k), math.inf), math.inf if i is None else i)
    left = [(i, t) for k, (i, t) in enumerate(left) if i is None or least[root(k)] == i]
    stages.append(left)
    word = lambda t: re.findall(rb"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", (t or "").encode().lower())
    windows = {tuple(w[k : k + 10]) for _, t in items for w in [word(t)] if w for k in range(max(1, len(w) - 9))}
    sizes = {len(w) for w in windows}
    clean = lambda w: not any(tuple(w[k : k + n]) in windows for n in sizes for k in range(len(w) - n + 1))
    left = [(i, t) for i, t in left if clean(word(t))]
    stages.append(left)
    return stages


@pytest.fixture(scope="module")
def folder(spark, tmp_path_factory):
    rows, items = corpus()
    out = str(tmp_path_factory.mktemp("corpus"))
    spark.createDataFrame([(*r, 5, b"x", "y") for r in rows], "doc_id long, text string, lang string, source string, n_chars long, sid int, sha binary, component_id string").repartition(3).write.parquet(f"{out}/documents.parquet")
    spark.createDataFrame(items, "item_id long, text string").write.parquet(f"{out}/benchmark.parquet")
    return out


def test_stages_equal_brute_force(spark, folder):
    rows, items = corpus()
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    columns = docs.columns
    wanted = by_hand(rows, items)
    assert [len(rows), *map(len, wanted)] == sorted([len(rows), *map(len, wanted)], reverse=True) and len({len(rows), *map(len, wanted)}) == 5  # each stage acts
    for (name, stage), want in zip(corpus_pipeline.STAGES, wanted, strict=False):
        docs = stage(spark, docs, folder)
        assert docs.columns == columns, name
        got = docs.collect()
        # rows with an id, and the texts of those without
        assert collections.Counter((r.doc_id, r.text) for r in got) == collections.Counter(want), name
        assert all((r.sid, bytes(r.sha), r.component_id) == (5, b"x", "y") for r in got), name


def test_run_packs_what_is_left(spark, folder):
    from public_tokenizers import path
    from tokenizers import Tokenizer

    rows, items = corpus()
    exact = Tokenizer.from_file(path("byte_bpe_50k.json"))
    want = collections.Counter()
    for i, t in by_hand(rows, items)[-1]:
        ids = [*exact.encode(t, add_special_tokens=False).ids, 0]
        cuts = [0, *range(len(ids) % 2048 or 2048, len(ids) + 1, 2048)]
        for k, (a, b) in enumerate(zip(cuts, cuts[1:], strict=False)):
            want[i, k, a, b - a, zlib.crc32(np.array(ids[a:b], "<u4").tobytes())] += 1
    got = corpus_pipeline.run(spark, folder).collect()
    assert collections.Counter((r.doc_id, r.piece, r.start, r.length, r.ids_crc32) for r in got) == want
    by = collections.defaultdict(list)
    for r in got:
        by[r.sequence_id].append((r.offset, r.length))
    for parts in by.values():
        assert [at for at, _ in sorted(parts)] == [sum(n for _, n in sorted(parts)[:k]) for k in range(len(parts))] and sum(n for _, n in parts) <= 2048
    assert len(by) == math.ceil(sum(r.length for r in got) / 2048)


def test_empty_tables(spark, tmp_path):
    spark.createDataFrame([], "doc_id long, text string, lang string, source string, n_chars long").write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame([], "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    assert corpus_pipeline.run(spark, str(tmp_path)).count() == 0
