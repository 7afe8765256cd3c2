"""Language-model scores: a hashed maximum-entropy model with class-factored softmax.

Tokens are words and one end a text. The vocabulary is factored into nested classes of at most FAN members by frequency (a
FAN-ary Huffman tree): a token is predicted by one softmax a level, frequent ones by one or two. Each of the HEAVY most
frequent tokens is a leaf of its own. All others are in one of RARE leaves by hash; within such a leaf a token gets its smoothed
share, from counts over all training text. So every word is predicted from its history, and the probabilities of all tokens, with one
unknown token a rare leaf, sum to 1.

Features of the history are hashed from the words themselves, 64-bit hashes, not from a vocabulary: the word before, the
word before that (skip), and both. A feature and a class select one row of FAN weights. The table has about one row for each ROW_TOKENS training
tokens, 2**MAX_BITS rows (16 MB, broadcast to every task) at most. Weights are added to the log shares of the class's members.

Training makes ROUNDS updates, each from its own share of the documents, dealt by hash. In a round all tasks sum what they observe and
what the model expects, by row and member; the sums of all tasks give one gradient step, scaled by what was observed
and expected. Sums do not depend on how the input is split (but for rounding). Scoring runs in sparse numpy batches: a decision touches three rows.

Counts cover the corpus. Tokens are dealt to parts by hash, tasks combining theirs first. The HEAVY most frequent tokens have
their counts broadcast; the others are counted and scored in their part, and only a document's sum for a part travels on. The
most frequent of these has at most a HEAVY-th of all tokens, which bounds a part's rows. Token identity is a 64-bit hash.

Memory: a task holds the model, one Arrow batch and FLUSH_BYTES of text's postings, or one longer text's; a part's task holds its postings.

Null text is empty: one end token. A null doc_id has the fold of empty text. Repeated rows count and are scored each. With nothing to
learn from, tokens are unknown and base_score is 0 a token. An empty table gives an empty result. Extra columns are not read.
"""

from __future__ import annotations

from functools import partial

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from termforge.llm.common import WHITE, bounded_batches, chunks, materialize, mix, partitions, span_hashes, word_spans
from termforge.llm.language_id import fold
from termforge.llm.substring_dedup import _by_part

FOLDS, HELD_OUT = 5, 1
FAN, HEAVY, RARE = 16, 65_536, 16
#: Weight rows: one for so many training tokens, between two powers of two.
ROW_TOKENS, MIN_BITS, MAX_BITS = 1024, 14, 18
#: Updates; the length of a step; what is added to observed and expected counts; tokens handled at once.
ROUNDS, RATE, PRIOR, BATCH = 3, 0.4, 3.0, 4096
#: Text that a task combines before it sends postings on; text for each part, and for each training task; rows of weights sent at once.
FLUSH_BYTES, PART_BYTES, TRAIN_BYTES, BLOCK = 8 << 20, 256 << 20, 64 << 20, 256
END = 0xFFFFFFFFFFFFFFFF


def tokens(column):
    """(first row, token hashes with each text's end, starts of the rows) for consecutive rows."""
    import numpy as np

    for row, data, at in chunks(column):
        starts, ends, first = word_spans(data, at, ~WHITE)
        n = len(at) - 1
        out = np.full(len(starts) + n, END, np.uint64)
        out[np.arange(len(starts)) + np.repeat(np.arange(n), np.diff(first))] = span_hashes(data, starts, ends)
        yield row, out, first + np.arange(n + 1)


# --- counts -----------------------------------------------------------------------------------------------------------


def _count(batches, parts):
    import numpy as np

    held, size, known, count = [], 0, np.zeros(0, np.uint64), np.zeros(0, np.int64)

    def merge():
        nonlocal held, size, known, count
        t, n = np.unique(np.concatenate([*(h for h, _ in held)]), return_inverse=True)
        known, count = t, np.bincount(n, np.concatenate([c for _, c in held]), len(t)).astype(np.int64)
        held, size = [(known, count)], len(known)

    for batch in batches:
        for _, t, _ in tokens(batch.column("text")):
            u, c = np.unique(t, return_counts=True)
            held.append((u, c))
            size += len(u)
            if size > 2 * len(known) + 1_000_000:
                merge()
    if held:
        merge()
        yield _by_part((known % np.uint64(parts)).astype(np.int64), 0, [None, known.view(np.int64), count, None])


def _totals(batches, most):
    """The most frequent tokens of a part, and a row (token null) with its tokens and its distinct ones; a part is in one rare leaf."""
    import numpy as np
    import pyarrow as pa

    x, n = [], []
    for batch in batches:
        x += [np.frombuffer(b.as_py(), np.uint64) for b in batch.column("x")]
        n += [np.frombuffer(b.as_py(), np.int64) for b in batch.column("y")]
    if not x:
        return
    token, back = np.unique(np.concatenate(x), return_inverse=True)
    count = np.bincount(back, np.concatenate(n), len(token)).astype(np.int64)
    # by rare leaf: a task may read several parts
    leaf = (token % np.uint64(RARE)).astype(np.int64)
    each, kinds = np.bincount(leaf, count, RARE).astype(np.int64), np.bincount(leaf, minlength=RARE)
    some = np.flatnonzero(kinds)
    top = np.lexsort((token, -count))[:most]
    signed = token.view(np.int64)
    out = [pa.array([None] * len(some) + signed[top].tolist(), pa.int64()), pa.array(np.concatenate((some, leaf[top]))), pa.array(np.concatenate((each[some], count[top]))), pa.array(np.concatenate((kinds[some], np.zeros(len(top), np.int64))))]
    yield pa.RecordBatch.from_arrays(out, ["token", "leaf", "n", "kinds"])


# --- the model --------------------------------------------------------------------------------------------------------


def huffman(weights):
    """(parent node, child number) of every leaf, the same of every node (node 0 is the root), by least weight first; FAN children a node."""
    import heapq

    import numpy as np

    n = len(weights)
    spare = -(n - 1) % (FAN - 1) if n > 1 else 0  # so that the root has all its children
    heap = [(float(w), i) for i, w in enumerate(weights)]
    heapq.heapify(heap)
    up, child = np.zeros(2 * n + FAN, np.int64), np.zeros(2 * n + FAN, np.int64)
    nodes = n
    while len(heap) > 1 or nodes == n:
        own = [heapq.heappop(heap) for _ in range(min(FAN - (spare if nodes == n else 0), len(heap)))]
        for k, (_, i) in enumerate(sorted(own, reverse=True)):
            up[i], child[i] = nodes, k
        heapq.heappush(heap, (sum(w for w, _ in own), nodes))
        nodes += 1
    flip = lambda x: nodes - 1 - x  # noqa: E731  the last node made is the root
    return flip(up[:n]), child[:n], np.append(-1, flip(up[n : nodes - 1])[::-1]), np.append(0, child[n : nodes - 1][::-1])


class Model:
    """The classes, their members' log shares, and the hashed rows of weights."""

    def __init__(self, heavy: list[tuple[int, int]], rare_n, rare_kinds, total: int):
        """heavy: (token hash as signed long, count); rare_n, rare_kinds: tokens and distinct ones of each rare leaf, without the heavy ones."""
        import numpy as np

        heavy = sorted((t & END, n) for t, n in heavy)
        self.token = np.array([t for t, _ in heavy] or [END], np.uint64)
        self.count = np.array([n for _, n in heavy] or [0], np.int64)
        bits = max(1, int(len(self.token)).bit_length() + 1)
        self.shift = np.uint64(64 - bits)
        self.first = np.searchsorted(self.token >> self.shift, np.arange((1 << bits) + 1, dtype=np.uint64)).astype(np.int32)
        self.probes = int(np.diff(self.first).max())
        rare = np.asarray(rare_n, np.float64) + 0.5 * (np.asarray(rare_kinds, np.float64) + 1)
        self.rare_log = np.log10(rare)
        weights = np.concatenate((self.count + 0.5, rare))
        leaf_up, leaf_child, node_up, node_child = huffman(weights)
        nodes = len(node_up)
        sums = np.zeros((nodes, FAN))
        sums[leaf_up, leaf_child] = weights
        for k in range(nodes - 1, 0, -1):
            sums[node_up[k], node_child[k]] = sums[k].sum()
        with np.errstate(divide="ignore"):
            self.bias = np.maximum(np.log(sums / sums.sum(1, keepdims=True)), -60).astype(np.float32)
        # paths from the leaves up; a level is -1 beyond the root
        path, digit = [leaf_up], [leaf_child]
        while (path[-1] > 0).any():
            inner = path[-1] > 0
            path.append(np.where(inner, node_up[np.maximum(path[-1], 0)], -1))
            digit.append(np.where(inner, node_child[np.maximum(path[-2], 0)], 0))
        self.path, self.digit = np.stack(path, 1).astype(np.int32), np.stack(digit, 1).astype(np.int8)
        self.depth = (self.path >= 0).sum(1)
        self.bits = min(MAX_BITS, max(MIN_BITS, int(total // ROW_TOKENS).bit_length()))
        self.weights = np.zeros((1 << self.bits, FAN), np.float32)

    def __setstate__(self, state):
        import numpy as np

        # an unpickled array has a dtype object of its own, with which ufunc.at takes its slow path, some 20 times slower
        self.__dict__ = {k: v.view(v.dtype.type) if isinstance(v, np.ndarray) else v for k, v in state.items()}

    def lookup(self, t):
        """Each token's leaf, its count if it is heavy, and whether it is."""
        import numpy as np

        at = (t >> self.shift).astype(np.int64)
        low, high = self.first[at], self.first[at + 1]
        found = np.zeros(len(t), bool)
        place = np.zeros(len(t), np.int64)
        last = len(self.token) - 1
        for k in range(self.probes):
            i = np.minimum(low + k, last)
            hit = (self.token[i] == t) & (low + k < high)
            place[hit] = i[hit]
            found |= hit
        return np.where(found, place, len(self.token) + (t % np.uint64(RARE)).astype(np.int64)), np.where(found, self.count[place], 0), found

    def decisions(self, leaf, features):
        """For each level of each token's path: the token, the class, the member, and a row of weights for each feature."""
        import numpy as np

        many = self.depth[leaf]
        of = np.repeat(np.arange(len(leaf)), many)
        level = np.arange(len(of)) - np.repeat(np.cumsum(many) - many, many)
        own = leaf[of]
        node, digit = self.path[own, level], self.digit[own, level]
        salt = mix(node.astype(np.uint64))
        shift = np.uint64(64 - self.bits)
        rows = [(((f[of] ^ salt) * np.uint64(0x9FB21C651E98DF25)) >> shift).astype(np.int32) for f in features]
        return of, node, digit, rows

    def chances(self, node, rows):
        """The probabilities of all members of each decision's class."""
        import numpy as np

        z = np.take(self.bias, node, axis=0, mode="clip")
        for r in rows:
            z += np.take(self.weights, r, axis=0, mode="clip")
        np.exp(z, out=z)  # log shares are 0 at most and a step moves a weight by 2 * RATE at most, so nothing overflows
        z /= (z @ np.ones(FAN, np.float32))[:, None]
        return z


def histories(t, starts):
    """Hashes of each token's features: the word before, the one before that, both; a text begins with two empty words."""
    import numpy as np

    out, last = [], t
    for _ in range(2):
        prev = np.empty_like(t)
        prev[1:] = last[:-1]
        prev[starts[:-1]] = 0
        out.append(prev)
        last = prev
    one, two = out
    return [mix(one + np.uint64(0x9E3779B97F4A7C15)), mix(two + np.uint64(0x3C6EF372FE94F82B)), mix(one * np.uint64(0xC2B2AE3D27D4EB4F) + mix(two))]


def _observe(batches, model):
    """What the tasks' documents have and what the model expects, by row of weights and member, in blocks of rows."""
    import numpy as np
    import pyarrow as pa

    seen, expected = np.zeros(model.weights.shape, np.float32), np.zeros(model.weights.shape[::-1], np.float32)
    any_ = False
    for batch in batches:
        for _, t, starts in tokens(batch.column("text")):
            leaf, _, _ = model.lookup(t)
            features = histories(t, starts)
            for i in range(0, len(t), BATCH):
                any_ = True
                _, node, digit, rows = model.decisions(leaf[i : i + BATCH], [f[i : i + BATCH] for f in features])
                p = model.chances(node, rows)
                members = np.ascontiguousarray(p.T)
                for r in rows:
                    r = r.astype(np.int64)
                    np.add.at(seen.ravel(), r * FAN + digit, np.float32(1))
                    for k in range(FAN):
                        np.add.at(expected[k], r, members[k])
    if any_:
        for k in range(0, len(seen), BLOCK):
            s, e = seen[k : k + BLOCK], np.ascontiguousarray(expected[:, k : k + BLOCK].T)
            if e.any():
                yield pa.RecordBatch.from_arrays([pa.array([k // BLOCK], pa.int32()), pa.array([s.tobytes()]), pa.array([e.tobytes()])], ["block", "s", "e"])


def _step(batches, rate):
    """The step of each block of rows: the gradient, observed less expected, over the mean of both and a prior."""
    import numpy as np
    import pyarrow as pa

    sums = {}
    for batch in batches:
        for b, s, e in zip(*(batch.column(c).to_pylist() for c in ("block", "s", "e")), strict=True):
            own = sums.setdefault(b, np.zeros((2, len(s) // 4)))
            own[0] += np.frombuffer(s, np.float32)
            own[1] += np.frombuffer(e, np.float32)
    for b, (s, e) in sums.items():
        yield pa.RecordBatch.from_arrays([pa.array([b], pa.int32()), pa.array([(rate * (s - e) / ((s + e) / 2 + PRIOR)).astype(np.float32).tobytes()])], ["block", "w"])


# --- scores -----------------------------------------------------------------------------------------------------------

SENT = "part int, base long, x binary, y binary, z binary, rid long, doc_id long, held_out boolean, n_tokens long, n_known long, known double, model double"
SUMMED = "rid long, doc_id long, held_out boolean, n_tokens long, n_known long, known double, model double"
_DOC = ["rid", "doc_id", "held_out", "n_tokens", "n_known", "known", "model"]


def _score(batches, model, parts):
    """A row for each document with what the heavy tokens and the model give, and the postings of all other tokens."""
    import numpy as np
    import pyarrow as pa

    held, size, base = [], 0, None
    schema = pa.schema([("part", pa.int32()), ("base", pa.int64()), ("x", pa.binary()), ("y", pa.binary()), ("z", pa.binary()), ("rid", pa.int64()), ("doc_id", pa.int64()), ("held_out", pa.bool_()), *((c, pa.int64()) for c in ("n_tokens", "n_known")), ("known", pa.float64()), ("model", pa.float64())])

    def flush():
        t, doc, train = (np.concatenate(x) for x in zip(*held, strict=True))
        order = np.lexsort((doc, t))
        t, doc, train = t[order], doc[order], train[order]
        start = np.flatnonzero(np.concatenate(([True], (t[1:] != t[:-1]) | (doc[1:] != doc[:-1])))) if len(t) else np.zeros(0, np.int64)
        times = np.diff(np.append(start, len(t)))
        t, doc, train = t[start], doc[start], train[start]
        sent = _by_part((t % np.uint64(parts)).astype(np.int64), 0, [None, t, doc.astype(np.int32), (times * 2 + train).astype(np.int32)])
        n = sent.num_rows
        cols = {"part": sent.column("part"), "base": pa.array(np.full(n, base, np.int64)), "x": sent.column("x"), "y": sent.column("y"), "z": sent.column("z")}
        yield pa.RecordBatch.from_arrays([cols.get(f.name, pa.nulls(n, f.type)) for f in schema], schema=schema)

    for batch in batches:
        n = batch.num_rows
        rid, train = batch.column("rid").to_numpy(), ~batch.column("held_out").to_numpy(zero_copy_only=False)
        sums = {c: np.zeros(n, np.int64) for c in ("n_tokens", "n_known")} | {c: np.zeros(n) for c in ("known", "model")}
        for row, t, starts in tokens(batch.column("text")):
            if base is None:
                base = int(rid[row])
            leaf, count, heavy = model.lookup(t)
            features = histories(t, starts)
            logp = np.zeros(len(t))
            for i in range(0, len(t), BATCH):
                of, node, digit, rows = model.decisions(leaf[i : i + BATCH], [f[i : i + BATCH] for f in features])
                p = model.chances(node, rows)[np.arange(len(of)), digit].astype(np.float64)
                logp[i : i + BATCH] = np.bincount(of, np.log10(np.maximum(p, 1e-30)), min(BATCH, len(t) - i))
            own, begin = slice(row, row + len(starts) - 1), starts[:-1]
            add = lambda x, begin=begin: np.add.reduceat(x, begin)  # noqa: E731  every text has its end, so no empty run
            sums["n_tokens"][own] = np.diff(starts)
            sums["n_known"][own] = add((count > 0).astype(np.int64))
            sums["known"][own] = add(np.where(heavy, np.log10(count + 0.5), 0))
            light = np.flatnonzero(~heavy)
            logp[light] -= model.rare_log[leaf[light] - len(model.token)]  # its share of the leaf: the count comes from its part
            sums["model"][own] = add(logp)
            doc = np.searchsorted(starts, light, "right") - 1 + row
            held.append((t[light], rid[doc] - base, train[doc]))
            size += len(t) * 7
            if size >= FLUSH_BYTES:
                yield from flush()
                held, size, base = [], 0, None
        cols = {"part": pa.array((rid % parts).astype(np.int32)), "rid": pa.array(rid), "doc_id": batch.column("doc_id"), "held_out": batch.column("held_out")} | {c: pa.array(v) for c, v in sums.items()}
        yield pa.RecordBatch.from_arrays([cols.get(f.name, pa.nulls(n, f.type)) for f in schema], schema=schema)
    if held:
        yield from flush()


def _sum_parts(batches):
    """Counts and scores of the parts' tokens, summed for each document; rows of documents go through."""
    import numpy as np
    import pyarrow as pa
    import pyarrow.compute as pc

    by: dict[int, list] = {}
    kinds = {"rid": pa.int64(), "doc_id": pa.int64(), "held_out": pa.bool_(), "n_tokens": pa.int64(), "n_known": pa.int64(), "known": pa.float64(), "model": pa.float64()}
    for batch in batches:
        whole = batch.filter(pc.is_valid(batch.column("rid")))
        if whole.num_rows:
            yield pa.RecordBatch.from_arrays([whole.column(c) for c in _DOC], _DOC)
        for row in batch.filter(pc.is_null(batch.column("rid"))).select(["part", "base", "x", "y", "z"]).to_pylist():
            times = np.frombuffer(row["z"], np.int32)
            by.setdefault(row["part"], []).append((np.frombuffer(row["x"], np.uint64), np.frombuffer(row["y"], np.int32) + np.int64(row["base"]), times))
    for part in list(by):
        t, rid, times = (np.concatenate(x) for x in zip(*by.pop(part), strict=True))
        order = np.argsort(t, kind="stable")
        t, rid, times = t[order], rid[order], times[order]
        start = np.flatnonzero(np.concatenate(([True], t[1:] != t[:-1])))
        count = np.add.reduceat((times >> 1).astype(np.int64) * (times & 1), start)
        count = np.repeat(count, np.diff(np.append(start, len(t))))
        times = (times >> 1).astype(np.int64)
        ids, back = np.unique(rid, return_inverse=True)
        score = np.bincount(back, times * np.log10(count + 0.5), len(ids))
        known = np.bincount(back, times * (count > 0), len(ids)).astype(np.int64)
        for i in range(0, len(ids), 20_000):
            s = slice(i, i + 20_000)
            cols = {"rid": pa.array(ids[s]), "n_known": pa.array(known[s]), "known": pa.array(score[s]), "model": pa.array(score[s])}
            m = len(ids[s])
            yield pa.RecordBatch.from_arrays([cols.get(c, pa.nulls(m, k)) for c, k in kinds.items()], list(kinds))


def train(docs: DataFrame, parts: int, size: int, rate: float = RATE, rounds: int = ROUNDS) -> tuple[Model, int, int]:
    """The model, all training tokens and the distinct ones, from (doc_id, text) rows of ``size`` bytes. ``parts`` is a multiple of RARE."""
    import numpy as np

    spark = docs.sparkSession
    dealt = docs.select("text").mapInArrow(partial(_count, parts=parts), "part int, kind int, sid binary, x binary, y binary, z binary").repartitionById(parts, "part")
    found = materialize(dealt.select("x", "y").mapInArrow(partial(_totals, most=HEAVY * 4 // parts + 1000), "token long, leaf long, n long, kinds long"), "counts")
    rare_n, rare_kinds = np.zeros(RARE, np.int64), np.zeros(RARE, np.int64)
    for r in found.where("token is null").groupBy("leaf").agg(F.sum("n").alias("n"), F.sum("kinds").alias("kinds")).collect():
        rare_n[r.leaf], rare_kinds[r.leaf] = r.n, r.kinds
    total, kinds = int(rare_n.sum()), int(rare_kinds.sum())
    top = found.where("token is not null").orderBy(F.desc("n"), "token").select("token", "leaf", "n").limit(HEAVY).toArrow()
    token, leaf, n = (top.column(c).to_numpy() for c in ("token", "leaf", "n"))  # HEAVY rows at most
    np.subtract.at(rare_n, leaf, n)
    np.subtract.at(rare_kinds, leaf, 1)
    model = Model(list(zip(token.tolist(), n.tolist(), strict=True)), rare_n, rare_kinds, total)
    tasks = max(spark.sparkContext.defaultParallelism, -(-size // (rounds * TRAIN_BYTES)))
    turn = F.pmod(F.xxhash64("doc_id", "text"), F.lit(rounds))
    for k in range(rounds if total else 0):
        rows = docs.where(turn == k).select("text").coalesce(tasks).mapInArrow(partial(_observe, model=model), "block int, s binary, e binary")
        steps = rows.repartition(partitions(spark), "block").mapInArrow(partial(_step, rate=rate), "block int, w binary").toArrow()  # the model's size
        for b, w in zip(steps.column("block").to_pylist(), steps.column("w").to_pylist(), strict=True):
            model.weights[b * BLOCK : (b + 1) * BLOCK] += np.frombuffer(w, np.float32).reshape(-1, FAN)
    return model, total, kinds


def score_documents(docs: DataFrame, rate: float = RATE, rounds: int = ROUNDS) -> DataFrame:
    """doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score of every document."""
    docs = bounded_batches(docs)
    import math

    held_out = fold(F.col("doc_id"), FOLDS) == HELD_OUT
    size = docs.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    parts = -(-partitions(docs.sparkSession, size, PART_BYTES) // RARE) * RARE
    model, total, kinds = train(docs.where(~held_out), parts, size, rate, rounds)
    rows = docs.select("doc_id", "text", held_out.alias("held_out"), F.monotonically_increasing_id().alias("rid"))
    sent = rows.mapInArrow(partial(_score, model=model, parts=parts), SENT).repartitionById(parts, "part")
    summed = sent.mapInArrow(_sum_parts, SUMMED).groupBy("rid")
    out = summed.agg(F.max("doc_id").alias("doc_id"), F.max("held_out").alias("held_out"), F.max("n_tokens").alias("n_tokens"), F.sum("n_known").alias("n_known"), F.sum("known").alias("known"), F.sum("model").alias("model"))
    return out.select(
        "doc_id",
        "held_out",
        "n_tokens",
        "n_known",
        F.lit(total).cast("long").alias("train_tokens"),
        (F.col("known") - F.col("n_tokens") * math.log10(total + 0.5 * (kinds + 1))).alias("base_score"),
        F.col("model").alias("score"),
    )
