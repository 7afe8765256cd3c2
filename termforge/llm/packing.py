"""Packing token sequences by bin completion with branch and bound.

Pieces of equal length are interchangeable, so the search needs only the histogram of lengths: at most MAX_TOKENS
counts, whatever the corpus. Around the largest remaining piece, undominated fillings are enumerated (a filling is
dominated if one of its pieces can be exchanged for a larger one, or another piece added, without overflow) and tried in order of
waste (one search: best fit first), each as often as the counts allow, then less often. A branch is left when its sequences and the lower bound of the rest
reach the best plan so far; the search then backtracks. The first incumbent is the
best-fit-decreasing plan, or a greedy descent that beats it. A search ends
at the lower bound, when nothing is left to try, or after STEPS steps. The first stops each enumeration of fillings after NODES
steps; if that left any out, or its steps ended, further SEARCHES follow with more of them and in other orders. A
plan may be improvable only if all ended without proof.

Each piece then finds its place from its rank among pieces of its length. Ranks are dealt by (length, bucket of doc_id),
so a length that a third of all pieces share is ranked in many tasks.

Null text is empty: one end token. Rows without doc_id or with equal doc_ids are packed like any others; pieces that agree in all
columns are interchangeable, and each has a place of its own. An empty table gives an empty result. Extra columns are not
read. A task holds one text with its ids, some 20 times its bytes.
"""

from __future__ import annotations

from functools import partial

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from termforge.llm.common import bounded_batches, materialize, partitions

MAX_TOKENS, END_ID = 2048, 0
#: Steps of one search; for each search the steps of one enumeration of fillings, and the order of fillings.
NODES, STEPS = 400, 4_000_000
SEARCHES = ((NODES, 1), (NODES, 0), (NODES * 16, 1), (NODES * 16, -1))


def encoder(folder: str | None = None):
    """text -> numpy uint32 ids of byte_bpe_50k.json without added special tokens.

    The rank file holds the same vocabulary and encodes faster; texts that spell out a special token go
    through the tokenizer itself, which reads it as that token.
    """
    import base64
    import os
    import sys

    import numpy as np
    import public_tokenizers
    import tiktoken
    from tokenizers import Tokenizer

    cached = sys.modules["tiktoken"].__dict__.setdefault("_termforge", {})
    if folder not in cached:
        where = (lambda name: os.path.join(folder, name)) if folder else public_tokenizers.path
        exact = Tokenizer.from_file(where("byte_bpe_50k.json"))
        with open(where("byte_bpe_50k.tiktoken"), "rb") as lines:
            ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}
        fast = tiktoken.Encoding("ranks", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
        special = [t.content for t in exact.get_added_tokens_decoder().values()]

        def encode(text: str):
            if any(s in text for s in special):
                return np.array(exact.encode(text, add_special_tokens=False).ids, np.uint32)
            return np.array(fast.encode_ordinary(text), np.uint32)

        cached[folder] = encode
    return cached[folder]


def _pieces(batches, limit, folder):
    import zlib

    import numpy as np
    import pyarrow as pa

    encode = encoder(folder)
    for batch in batches:
        rows = []
        for row, text in enumerate(batch.column("text")):
            ids = np.append(encode(text.as_py() or ""), np.uint32(END_ID)).astype("<u4")
            first = len(ids) % limit or limit
            cuts = [0, *range(first, len(ids) + 1, limit)]
            rows += [(row, k, a, b - a, zlib.crc32(ids[a:b].tobytes())) for k, (a, b) in enumerate(zip(cuts, cuts[1:], strict=False))]
        row, *cols = zip(*rows, strict=True) if rows else ((),) * 5
        ids = batch.column("doc_id").take(pa.array(row, pa.int64()))
        yield pa.RecordBatch.from_arrays([ids, pa.array(cols[0], pa.int32()), *(pa.array(c, pa.int64()) for c in cols[1:])], ["doc_id", "piece", "start", "length", "ids_crc32"])


def token_pieces(docs: DataFrame, limit: int = MAX_TOKENS, tokenizers: str | None = None) -> DataFrame:
    """doc_id, piece, start, length, ids_crc32; only documents over ``limit`` are cut, the first piece takes the remainder."""
    docs = bounded_batches(docs)
    kind = "doc_id long, piece int, start long, length long, ids_crc32 long"
    return docs.select("doc_id", "text").mapInArrow(partial(_pieces, limit=limit, folder=tokenizers), kind)


# --- the plan: on the driver, over the histogram only ---------------------------------------------------------------------


def completions(lengths: list[int], left: dict[int, int], room: int, steps: int = NODES, order: int = 0) -> tuple[list[tuple[int, tuple[int, ...]]], int, bool]:
    """All undominated (waste, filling) of ``room``; the steps taken; whether none is missing.

    Order: the least waste first, then the fewest pieces (1) or the most (-1); 0 is that of best fit, the largest pieces first.
    Depth first, largest pieces first. A piece taken while a larger one, ``t``, would fit must leave less waste than the
    difference to ``t``, else the exchange dominates.
    """
    import bisect

    if left.get(room, 0) > 0:  # one piece that fits exactly dominates every other filling
        return [(0, (room,))], 1, True
    found: list[tuple[int, tuple[int, ...]]] = []
    taken, filling = 0, []

    def descend(room: int, top: int, used: int, most: float) -> None:
        """``used`` of lengths[top] are in the filling; the waste must stay below ``most``."""
        nonlocal taken
        taken += 1
        larger = None
        for i in range(bisect.bisect_right(lengths, room, 0, top + 1) - 1, -1, -1):
            taken += 1
            size = lengths[i]
            if left[size] <= (used if i == top else 0):
                continue
            filling.append(size)
            descend(room - size, i, used + 1 if i == top else 1, most if larger is None else min(most, larger - size))
            filling.pop()
            if taken >= steps:
                return
            larger = size
        if larger is None and room < most:
            found.append((room, tuple(filling)))

    descend(room, len(lengths) - 1, 0, float("inf"))
    found.sort(key=(lambda x: (x[0], order * len(x[1]), x[1])) if order else (lambda x: [-s for s in x[1]]))
    return found, taken, taken < steps


def lower_bound(counts: dict[int, int], limit: int) -> int:
    """Sequences that any plan needs: the bound L2 of Martello and Toth, at least the tokens over ``limit``."""
    import numpy as np

    n = np.zeros(limit + 1, np.int64)
    for size, count in counts.items():
        n[size] = count
    many, tokens = np.append(0, np.cumsum(n)), np.append(0, np.cumsum(n * np.arange(limit + 1)))  # of sizes below
    half = limit // 2 + 1  # sizes from here on are alone or with smaller ones
    k = np.arange(limit // 2 + 1)
    large, free = many[-1] - many[half], (many[limit - k + 1] - many[half]) * limit - (tokens[limit - k + 1] - tokens[half])
    small = tokens[half] - tokens[k]
    return int((large + np.maximum(0, -(-(small - free) // limit))).max())


def best_fit(counts: dict[int, int], limit: int) -> list[tuple[list[int], int]]:
    """The best-fit-decreasing plan: each piece, largest first, goes to the fullest sequence that has room for it."""
    import bisect

    open_: dict[int, list[tuple[list[int], int]]] = {}  # by room: fillings and how many sequences have them
    rooms: list[int] = []

    def put(room, filling, times):
        if room not in open_:
            bisect.insort(rooms, room)
            open_[room] = []
        open_[room].append((filling, times))

    for size in sorted(counts, reverse=True):
        n = counts[size]
        while n:
            at = bisect.bisect_left(rooms, size)
            if at < len(rooms):
                room = rooms[at]
                filling, times = open_[room].pop()
                if not open_[room]:
                    del open_[room], rooms[at]
            else:
                room, filling, times = limit, [], n
            # a sequence stays the fullest with room until it has none left for this size
            each = min(room // size, n)
            some = min(times, n // each)
            if times > some and filling:
                put(room, filling, times - some)
            put(room - each * size, [*filling, *[size] * each], some)
            n -= each * some
    return [x for room in rooms for x in open_[room]]


def _some_completions(lengths: list[int], left: dict[int, int], room: int, width: int = 6, nodes: int = NODES) -> list[tuple[int, list[int]]]:
    """(waste, filling) for the least wasteful undominated fillings of ``room`` found within ``nodes`` steps.

    Depth first, largest pieces first, so the first leaf is the best-fit filling. A branch is cut when even the waste it
    must have exceeds that of the ``width`` best found.
    """
    import bisect

    found: list[tuple[int, list[int]]] = []
    steps = 0

    def descend(room: int, top: int, filling: list[int]) -> bool:
        nonlocal steps
        steps += 1
        # the largest pieces that fit, not larger than the last one taken
        i = bisect.bisect_right(lengths, min(room, top)) - 1
        leaf, tried = True, 0
        while i >= 0:
            size = lengths[i]
            if left[size] > filling.count(size):
                leaf = False
                filling.append(size)
                done = descend(room - size, size, filling)
                filling.pop()
                if done or steps > nodes:
                    return done
                tried += 1
                if tried >= width:
                    break
            i -= 1
        if leaf:
            # dominated if a piece can be exchanged for a larger one that is left
            for k, size in enumerate(filling):
                j = bisect.bisect_right(lengths, size + room) - 1
                if j >= 0 and lengths[j] > size and left[lengths[j]] > filling.count(lengths[j]):
                    filling = [*filling[:k], lengths[j], *filling[k + 1 :]]
                    room -= lengths[j] - size
            found.append((room, sorted(filling, reverse=True)))
            found.sort()
            del found[width:]
            return room == 0
        return False

    descend(room, room, [])
    unique = []
    for x in found:
        if x not in unique:
            unique.append(x)
    return unique


def _descend(counts: dict[int, int], limit: int, choose, allowed: float) -> list[tuple[list[int], int]] | None:
    """A greedy plan, one filling after the other; None as soon as its waste exceeds ``allowed``."""
    left = {s: c for s, c in counts.items() if c}
    lengths = sorted(left)
    plan, waste = [], 0
    while lengths:
        largest = lengths[-1]
        left[largest] -= 1
        options = _some_completions([s for s in lengths if left[s]] if not left[largest] else lengths, left, limit - largest)
        left[largest] += 1
        room, filling = choose(options, largest) if options else (limit - largest, [])
        filling = [largest, *filling]
        times = min(left[s] // filling.count(s) for s in set(filling))
        plan.append((filling, times))
        waste += room * times
        for s in filling:
            left[s] -= times
        lengths = [s for s in lengths if left[s]]
        if lengths and waste > allowed:
            return None
    return plan


def first_plan(counts: dict[int, int], limit: int) -> list[tuple[list[int], int]]:
    """The first incumbent: best fit decreasing, or a greedy descent of bin completion that needs fewer sequences."""
    best, total = best_fit(counts, limit), sum(s * c for s, c in counts.items())
    for pieces in (0, 1, -1):
        used = sum(n for _, n in best)
        allowed = (used - 1) * limit - total
        pick = (lambda options, _, p=pieces: min(options, key=lambda x: (x[0], len(x[1]) * p, x[1]))) if pieces else (lambda options, _: options[0])
        plan = _descend(counts, limit, pick, allowed) if allowed >= 0 else None
        if plan is not None and sum(n for _, n in plan) < used:
            best = plan
    return best


def _search(counts: dict[int, int], limit: int, nodes: int, order: int, steps: int, used: int, bound: int):
    """(plan with less than ``used`` sequences or None, whether no better one can be missed)."""
    from array import array
    from hashlib import blake2b

    left = dict(sorted(counts.items()))
    seen: dict[bytes, int] = {}
    best, plan, n, whole = None, [], 0, True

    def moves(last):
        """A node's branches: each undominated filling around its largest piece, as often as it can be used and less often."""
        nonlocal steps, whole
        lengths = [s for s in left if left[s]]
        largest = lengths[-1]
        left[largest] -= 1
        fitting = lengths if left[largest] else lengths[:-1]
        options, took, all_ = completions(fitting, left, limit - largest, nodes, order)
        left[largest] += 1
        steps -= took
        whole &= all_
        for _, rest in options:
            filling = (largest, *rest)
            if filling != last:
                for times in range(min(left[s] // filling.count(s) for s in set(filling)), 0, -1):
                    yield filling, times

    stack = [moves(None)]
    while stack:
        if steps <= 0:
            return best, False
        if len(plan) == len(stack):  # back from a branch
            filling, times = plan.pop()
            n -= times
            for s in filling:
                left[s] += times
        move = next(stack[-1], None)
        if move is None:
            stack.pop()
            continue
        filling, times = move
        for s in filling:
            left[s] -= times
        plan.append(move)
        n += times
        steps -= len(left)
        if not any(left.values()):
            if n < used:
                best, used = [(list(f), t) for f, t in plan], n
                if used == bound:
                    break
            continue
        key = blake2b(array("q", left.values()).tobytes(), digest_size=16).digest()
        if seen.get(key, n + 1) <= n or n + lower_bound(left, limit) >= used:
            continue
        seen[key] = n
        again = all(left[s] >= filling.count(s) for s in filling)
        stack.append(moves(filling if again else None))
    return best, whole


def plan_bins(counts: dict[int, int], limit: int = MAX_TOKENS, steps: int = STEPS) -> list[tuple[list[int], int]]:
    """Fillings and how often each is used: with the fewest sequences, or the best plan found by SEARCHES of ``steps``."""
    counts = {s: c for s, c in counts.items() if c}
    if not counts:
        return []
    best, bound = first_plan(counts, limit), lower_bound(counts, limit)
    for nodes, order in SEARCHES:
        used = sum(n for _, n in best)
        if used == bound:
            break
        found, whole = _search(counts, limit, nodes, order, steps, used, bound)
        best = found or best
        if whole:
            break
    return best


def _places(batches, plan):
    """Sequence and offset of each piece from its rank among pieces of its length."""
    import numpy as np
    import pyarrow as pa

    at: dict[int, list[tuple[int, int, int, int]]] = {}
    base = 0
    for filling, times in plan:
        offset = 0
        for size in dict.fromkeys(filling):
            uses = filling.count(size)
            at.setdefault(size, []).append((uses * times, base, uses, offset))
            offset += uses * size
        base += times
    table = {}
    for size, rows in at.items():
        many, bases, uses, offsets = (np.array(x, np.int64) for x in zip(*rows, strict=True))
        table[size] = (np.cumsum(many), np.cumsum(many) - many, bases, uses, offsets)
    for batch in batches:
        length, rank = batch.column("length").to_numpy(), batch.column("rank").to_numpy()
        seq, off = np.empty(len(length), np.int64), np.empty(len(length), np.int64)
        order = np.argsort(length, kind="stable")
        cuts = np.flatnonzero(np.diff(length[order])) + 1
        for rows in np.split(order, cuts):
            if not len(rows):
                continue
            size = int(length[rows[0]])
            end, begin, bases, uses, offsets = table[size]
            k = np.searchsorted(end, rank[rows], "right")
            r = rank[rows] - begin[k]
            seq[rows] = bases[k] + r // uses[k]
            off[rows] = offsets[k] + r % uses[k] * size
        yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in ("doc_id", "piece", "start", "length", "ids_crc32")), pa.array(seq), pa.array(off)], ["doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset"])


def pack_documents(docs: DataFrame, limit: int = MAX_TOKENS, tokenizers: str | None = None) -> DataFrame:
    """The pieces of ``docs`` with sequence_id and offset; sequences hold ``limit`` tokens at most."""
    spark = docs.sparkSession
    pieces = materialize(token_pieces(docs, limit, tokenizers), "pieces")
    # The buckets grow with the pieces, so a length that a third of them share stays some hundred thousand rows a bucket.
    buckets = partitions(spark, pieces.count())
    pieces = pieces.withColumn("bucket", F.pmod(F.xxhash64("doc_id", "piece", "ids_crc32"), F.lit(buckets)).cast("int"))
    by = pieces.groupBy("length", "bucket").agg(F.count("*").alias("n"))
    by = materialize(by, "histogram")
    counts = {r.length: r.n for r in by.groupBy("length").agg(F.sum("n").alias("n")).collect()}  # ``limit`` rows at most
    plan = plan_bins(counts, limit)
    before = W.partitionBy("length").orderBy("bucket").rowsBetween(W.unboundedPreceding, -1)
    starts = by.select("length", "bucket", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("before"))
    own = W.partitionBy("length", "bucket").orderBy("doc_id", "piece", "start", "ids_crc32")
    ranked = pieces.withColumn("own", F.row_number().over(own) - 1).join(starts.hint("merge"), ["length", "bucket"])
    ranked = ranked.select("doc_id", "piece", "start", "length", "ids_crc32", (F.col("before") + F.col("own")).cast("long").alias("rank"))
    kind = "doc_id long, piece int, start long, length long, ids_crc32 long, sequence_id long, offset long"
    return ranked.mapInArrow(partial(_places, plan=plan), kind)
