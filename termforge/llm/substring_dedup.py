"""Repeated passages by longest-previous-factor arrays over sorted suffixes.

A byte goes if a string of LENGTH bytes over it also starts in a document with a smaller id; the first copy stays whole.

1. Documents equal to an earlier one are settled by their hash and leave the search.
2. Anchors: in every window of LENGTH bytes the GRAM-byte string with the least hash. Equal windows have equal anchors, so
   only anchors found in two documents can lie in a match. Tasks combine their own occurrences of an anchor before the
   shuffle, so a passage that a third of all documents share is sent once a task, not once a document.
3. Around each such anchor the bytes that windows over it can reach are gathered. Equal surroundings with an earlier
   document settle all windows at once. The others are suffix-sorted to depth LENGTH (prefix doubling); previous and next
   smaller documents in suffix order give each suffix's longest previous factor, and windows of LENGTH or more go.
4. Spans are merged per document and removed from the text.

Anchor hashes only select; every match is of bytes (surroundings are compared by 128-bit hashes, suffixes by rank).

Null text is empty. Rows without doc_id come last in order and can only lose bytes. Rows sharing a doc_id never match each
other; if their texts differ, the spans found in any of them are removed from each. An empty table gives an empty result. Extra
columns are not read. A long text is handled in pieces of 1 MB and its surroundings in pieces of FLUSH_BYTES, so a task holds it a
few times, whatever its length.
"""

from __future__ import annotations

from functools import partial

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from termforge.llm.common import BYTE_CODE, CHUNK_BYTES, bounded_batches, chunks, keyed_join, materialize, mix, partitions, powers, span_hashes, text_buffers, with_sid

LENGTH, GRAM = 50, 24
#: Text, or gathered surroundings, that a task combines before it sends them on; text for each part of the anchors.
FLUSH_BYTES, PART_BYTES = 8 << 20, 16 << 20
PART = "part int, kind int, sid binary, x binary, y binary, z binary"


def sliding(x, width, op):
    """op over every run of ``width`` neighbours."""
    done, span = x, 1
    while span * 2 <= width:
        done = op(done[:-span], done[span:])
        span *= 2
    n = len(x) - width + 1
    return op(done[:n], done[width - span : width - span + n])


def anchors(data, at, length, gram):
    """Positions of the anchors in rows of bytes (offsets ``at``), and their 64-bit hashes."""
    import numpy as np

    n, width = len(data), length - gram + 1
    if n < length:
        return np.zeros(0, np.int64), np.zeros(0, np.uint64)
    if n > 2 * CHUNK_BYTES and len(at) == 2:  # one long text: in pieces that share all windows among them
        found = [(k + p, h) for k in range(0, n - length + 1, CHUNK_BYTES) for p, h in [anchors(data[k : k + CHUNK_BYTES + length - 1], np.array([0, min(CHUNK_BYTES + length - 1, n - k)]), length, gram)]]
        pos, first = np.unique(np.concatenate([p for p, _ in found]), return_index=True)
        return pos, np.concatenate([h for _, h in found])[first]
    power, inverse = powers(n + 1)
    total = np.zeros(n + 1, np.uint64)
    np.cumsum(BYTE_CODE[data] * power[:n], out=total[1:])
    h = (total[gram:] - total[:-gram]) * inverse[: n - gram + 1]
    order = ((h * np.uint64(0x9FB21C651E98DF25)) >> np.uint64(32)).astype(np.uint32)
    ends = np.repeat(at[1:], np.diff(at))
    room = ends - np.arange(n)
    inside = room[: len(order)] >= gram
    order[~inside] = 0xFFFFFFFF
    least = sliding(order, width, np.minimum)
    least[room[: len(least)] < length] = 0
    padded = np.zeros(len(least) + 2 * (width - 1), np.uint32)
    padded[width - 1 : width - 1 + len(least)] = least
    pos = np.flatnonzero((sliding(padded, width, np.maximum) == order) & inside)
    return pos, mix(h[pos])


def _by_part(part, kind, columns):
    """Rows (part, kind, columns as bytes) for columns of equal length dealt by ``part``."""
    import numpy as np
    import pyarrow as pa

    order = np.argsort(part, kind="stable")
    part = part[order]
    cuts = np.flatnonzero(np.diff(part)) + 1
    starts = np.concatenate(([0], cuts)).astype(np.int64) if len(part) else np.zeros(0, np.int64)
    bounds = np.append(starts, len(part))
    out = [pa.array(part[starts].astype(np.int32)), pa.array(np.full(len(starts), kind, np.int32))]
    for c in columns:
        if c is None:
            out.append(pa.array([b""] * len(starts), pa.binary()))
            continue
        c = np.ascontiguousarray(c[order])
        width = c.itemsize * (c.shape[1] if c.ndim > 1 else 1)
        out.append(pa.Array.from_buffers(pa.binary(), len(starts), [None, pa.py_buffer((bounds * width).astype(np.int32)), pa.py_buffer(c.tobytes())]))
    return pa.RecordBatch.from_arrays(out, ["part", "kind", "sid", "x", "y", "z"])


def _runs(key):
    """Starts of the runs of equal keys (sorted), and each element's run."""
    import numpy as np

    new = np.concatenate(([True], key[1:] != key[:-1])) if len(key) else np.zeros(0, bool)
    return np.flatnonzero(new), np.cumsum(new) - 1


def _send_anchors(batches, length, gram, parts):
    import numpy as np

    held, size = [], 0

    def flush():
        a, sid, pos = (np.concatenate(x) for x in zip(*held, strict=True))
        order = np.argsort(a, kind="stable")
        a, sid, pos = a[order], sid[order], pos[order]
        start, run = _runs(a)
        if not len(start):
            return
        shared = (np.minimum.reduceat(sid, start) != np.maximum.reduceat(sid, start))[run]
        first = np.zeros(len(a), bool)
        first[start] = True
        send = first | ~shared
        yield _by_part(((a >> np.uint64(32)) % np.uint64(parts))[send].astype(np.int64), 0, [sid[send], pos[send].astype(np.int32), a[send].astype(np.uint32), None])
        if shared.any():
            yield _by_part(sid[shared] % parts, 1, [sid[shared], pos[shared].astype(np.int32), None, None])

    for batch in batches:
        ids = batch.column("sid").to_numpy()
        for row, data, at in chunks(batch.column("text")):
            pos, a = anchors(data, at, length, gram)
            doc = np.searchsorted(at, pos, "right") - 1
            held.append((a, ids[row + doc], pos - at[doc]))
            size += len(data)
            if size >= FLUSH_BYTES:
                yield from flush()
                held, size = [], 0
    if held:
        yield from flush()


def _columns(batches, kinds):
    """The parts' rows of each kind, their columns joined."""
    import numpy as np

    out = {0: [], 1: []}
    for batch in batches:
        for row in batch.to_pylist():
            out[row["kind"]].append(row)
    for kind in (0, 1):
        yield [np.concatenate([np.frombuffer(r[c], t) for r in out[kind]]) if out[kind] else np.zeros(0, t) for c, t in kinds] + [np.repeat(np.array([r["part"] for r in out[kind]], np.int64), [len(r["sid"]) // 8 for r in out[kind]])]


def _to_documents(sid, payload, parts):
    """(part, sid, x): the payload dealt by document, one row a part, so rows do not grow with documents times parts."""
    batch = _by_part(sid % parts, 0, [sid, payload, None, None])
    yield batch.select(["part", "sid", "x"])


def _documents(batches, kind, width):
    """(sid, x) with one row a document from the rows of the parts."""
    import numpy as np
    import pyarrow as pa

    rows = [r for batch in batches for r in zip(batch.column("sid").to_pylist(), batch.column("x").to_pylist(), strict=True)]
    if not rows:
        return
    sid, payload = (np.concatenate([np.frombuffer(r[i], t) for r in rows]) for i, t in ((0, np.int64), (1, kind)))
    payload = payload.reshape(len(sid), width)
    order = np.argsort(sid, kind="stable")
    sid, payload = sid[order], payload[order]
    start, _ = _runs(sid)
    bounds = np.append(start, len(sid))
    for i in range(0, len(start), 5_000):
        b = bounds[i : i + 5_001]
        raw = payload[b[0] : b[-1]].tobytes()
        offsets = ((b - b[0]) * width * payload.itemsize).astype(np.int32)
        yield pa.RecordBatch.from_arrays([pa.array(sid[b[:-1]]), pa.Array.from_buffers(pa.binary(), len(b) - 1, [None, pa.py_buffer(offsets), pa.py_buffer(raw)])], ["sid", "x"])


def _shared_anchors(batches, parts):
    """Where the anchors lie that two documents have."""
    import numpy as np

    (sid, pos, a, part), (more_sid, more_pos, *_) = _columns(batches, (("sid", np.int64), ("x", np.int32), ("y", np.uint32)))
    key = part.astype(np.uint64) << np.uint64(32) | a
    order = np.argsort(key, kind="stable")
    sid, pos, key = sid[order], pos[order], key[order]
    start, run = _runs(key)
    if len(start):
        shared = (np.minimum.reduceat(sid, start) != np.maximum.reduceat(sid, start))[run]
        sid, pos = sid[shared], pos[shared]
    yield from _to_documents(np.concatenate((sid, more_sid)), np.concatenate((pos, more_pos)), parts)


def _classes(sid, low, high, ctx):
    """Order by surroundings, their class, and each class's smallest document."""
    import numpy as np

    words = ctx.view(np.uint64)
    one, two = low.astype(np.uint64) << np.uint64(8) | high, np.full(len(ctx), 7, np.uint64)
    for j in range(words.shape[1]):
        one = mix(one + words[:, j] * np.uint64(0x9E3779B97F4A7C15))
        two = mix(two ^ (words[:, j] + np.uint64(j + 1)) * np.uint64(0xC2B2AE3D27D4EB4F))
    two ^= low.astype(np.uint64) << np.uint64(8) | high
    order = np.lexsort((two, one))
    one, two = one[order], two[order]
    new = np.concatenate(([True], (one[1:] != one[:-1]) | (two[1:] != two[:-1]))) if len(one) else np.zeros(0, bool)
    start, cls = np.flatnonzero(new), np.cumsum(new) - 1
    least = np.minimum.reduceat(sid[order], start) if len(start) else np.zeros(0, np.int64)
    return order, start, cls, least


def _send_contexts(batches, length, gram, parts):
    import numpy as np

    back, width = length - gram, 2 * length - gram
    padded = -(-width // 8) * 8
    held, size = [], 0

    def flush():
        sid, pos, a, low, high, ctx = (np.concatenate(x) for x in zip(*held, strict=True))
        order, _, cls, least = _classes(sid, low, high, ctx)
        sid, pos, a, low, high, ctx = sid[order], pos[order], a[order], low[order], high[order], ctx[order]
        later = sid > least[cls]
        send = ~later
        yield _by_part(((a >> np.uint64(32)) % np.uint64(parts))[send].astype(np.int64), 0, [sid[send], pos[send].astype(np.int32), np.stack((low, high), 1)[send], ctx[send]])
        later &= high.astype(np.int64) - low >= length
        if later.any():
            begin = pos[later] - back
            yield _by_part(sid[later] % parts, 1, [sid[later], np.stack((begin + low[later], begin + high[later]), 1).astype(np.int32), None, None])

    for batch in batches:
        ids, wanted = batch.column("sid").to_numpy(), batch.column("x").to_pylist()
        data, at = text_buffers(batch.column("text"))
        for i, anchored in enumerate(wanted):
            text, pos = data[at[i] : at[i + 1]], np.unique(np.frombuffer(anchored, np.int32)).astype(np.int64)
            pos = pos[pos + gram <= len(text)]
            if not len(pos):
                continue
            frame = np.zeros(len(text) + back + padded, np.uint8)
            frame[back : back + len(text)] = text
            windows = np.lib.stride_tricks.sliding_window_view(frame, width)
            for k in range(0, len(pos), FLUSH_BYTES // padded):  # a long text's surroundings go in pieces
                own = pos[k : k + FLUSH_BYTES // padded]
                ctx = np.zeros((len(own), padded), np.uint8)
                ctx[:, :width] = windows[own]
                low, high = np.maximum(back - own, 0), np.minimum(len(text) - own + back, width)
                held.append((np.full(len(own), ids[i]), own, span_hashes(text, own, own + gram, BYTE_CODE), low.astype(np.uint8), high.astype(np.uint8), ctx))
                size += ctx.nbytes
                if size >= FLUSH_BYTES:
                    yield from flush()
                    held, size = [], 0
    if held:
        yield from flush()


def _ranked(x):
    import numpy as np

    return np.unique(x.ravel(), return_inverse=True)[1].reshape(x.shape).astype(np.uint64)


def suffix_ranks(ctx, length, starts):
    """Ranks, in the order of their first ``length`` bytes, of the suffixes that begin in the first ``starts`` columns."""
    import numpy as np

    span, need = 8, starts + length - 8
    rank = np.lib.stride_tricks.sliding_window_view(ctx, 8, axis=1)[:, :need]
    rank = _ranked(np.ascontiguousarray(rank).view(">u8")[:, :, 0].astype(np.uint64))
    while span < length:
        step = min(span, length - span)
        rank = _ranked(rank[:, :-step] << np.uint64(32) | rank[:, step:])
        span += step
    return rank[:, :starts]


def smaller_before(doc, floor):
    """Whether an earlier place, not before ``floor``, holds a smaller document: pointers jump over what is not smaller."""
    import numpy as np

    at = np.arange(len(doc)) - 1
    open_ = np.arange(len(doc))
    while len(open_):
        open_ = open_[at[open_] >= floor[open_]]
        open_ = open_[doc[at[open_]] >= doc[open_]]
        at[open_] = at[at[open_]]
    return at >= floor


def previous_factors(rank, doc):
    """Whether each suffix shares its first bytes (its rank) with one of a smaller document."""
    import numpy as np

    order = np.argsort(rank, kind="stable")
    start, run = _runs(rank[order])
    size = np.diff(np.append(start, len(order)))
    d = doc[order]
    n = len(order)
    earlier = smaller_before(d, start[run])
    end = (start + size)[run]
    later = smaller_before(d[::-1], (n - end)[::-1])[::-1]
    out = np.zeros(n, bool)
    out[order] = earlier | later
    return out


def _repeated(batches, length, gram, parts):
    """Spans that earlier documents hold, as (sid, pairs of positions)."""
    import numpy as np

    back, width = length - gram, 2 * length - gram
    padded = -(-width // 8) * 8
    (sid, pos, lim, ctx, _), (more_sid, more, *_) = _columns(batches, (("sid", np.int64), ("x", np.int32), ("y", np.uint8), ("z", np.uint8)))
    out_sid, out = [more_sid], [more.reshape(-1, 2)]
    if len(sid):
        lim, ctx = lim.reshape(-1, 2), ctx.reshape(-1, padded)
        order, start, cls, least = _classes(sid, lim[:, 0], lim[:, 1], ctx)
        sid, pos, low, high = sid[order], pos[order], lim[order, 0].astype(np.int64), lim[order, 1].astype(np.int64)
        begin = pos.astype(np.int64) - back
        later = (sid > least[cls]) & (high - low >= length)
        out_sid.append(sid[later])
        out.append(np.stack((begin + low, begin + high), 1)[later].astype(np.int32))
        # Classes of the same anchor: their windows may still be equal.
        one = ctx[order[start]]
        anchor = span_hashes(np.ascontiguousarray(one[:, back : back + gram]).ravel(), np.arange(len(one)) * gram, np.arange(1, len(one) + 1) * gram, BYTE_CODE)
        _, which, many = np.unique(anchor, return_inverse=True, return_counts=True)
        open_ = np.flatnonzero(many[which] > 1)
        lows, highs = low[start], high[start]
        order2 = np.argsort(which[open_], kind="stable")
        open_ = open_[order2]
        block = 60_000  # classes sorted at once; an anchor's classes stay together
        cuts = [0]
        group, _ = _runs(which[open_])
        for g in group:
            if g - cuts[-1] >= block:
                cuts.append(int(g))
        a_off, b_off = np.full(len(one), width), np.full(len(one), -1)
        for i, j in zip(cuts, [*cuts[1:], len(open_)], strict=True):
            rows = open_[i:j]
            if not len(rows):
                continue
            starts = width - length + 1
            rank = suffix_ranks(one[rows], length, starts)
            column = np.broadcast_to(np.arange(starts), rank.shape)
            valid = (column >= lows[rows][:, None]) & (column + length <= highs[rows][:, None])
            hit = np.zeros(rank.shape, bool)
            hit[valid] = previous_factors(rank[valid], np.broadcast_to(least[rows][:, None], rank.shape)[valid])
            any_ = hit.any(1)
            a_off[rows[any_]] = hit[any_].argmax(1)
            b_off[rows[any_]] = starts - 1 - hit[any_][:, ::-1].argmax(1)
        # Hit windows of one class overlap, being closer than their length: one span from the first to the last.
        first = (sid == least[cls]) & (b_off[cls] >= 0)
        out_sid.append(sid[first])
        out.append(np.stack((begin + a_off[cls], begin + b_off[cls] + length), 1)[first].astype(np.int32))
    yield from _to_documents(np.concatenate(out_sid), np.concatenate(out).reshape(-1, 2), parts)


def merge_spans(pairs):
    """Maximal runs of sorted or unsorted [a, b) pairs."""
    import numpy as np

    if not len(pairs):
        return pairs
    pairs = pairs[np.argsort(pairs[:, 0], kind="stable")]
    end = np.maximum.accumulate(pairs[:, 1])
    start = np.flatnonzero(np.concatenate(([True], pairs[1:, 0] > end[:-1])))
    return np.stack((pairs[start, 0], end[np.append(start[1:] - 1, len(pairs) - 1)]), 1)


def _removed(batches):
    import hashlib

    import numpy as np
    import pyarrow as pa

    for batch in batches:
        data, at = text_buffers(batch.column("text"))
        removed, spans, sha, kept = [], [], [], []
        for i, own in enumerate(batch.column("x").to_pylist()):
            text = data[at[i] : at[i + 1]]
            pairs = np.frombuffer(own, np.int32).reshape(-1, 2).astype(np.int64)
            pairs = merge_spans(np.minimum(pairs, len(text)))
            pairs = pairs[pairs[:, 0] < pairs[:, 1]]
            left, digest = 0, hashlib.sha256()
            for a, b in pairs.tolist():
                digest.update(text[left:a].tobytes())
                left = b
            digest.update(text[left:].tobytes())
            removed.append(int((pairs[:, 1] - pairs[:, 0]).sum()))
            spans.append(len(pairs))
            sha.append(digest.hexdigest())
            kept.append(pairs.astype(np.int32).tobytes())
        yield pa.RecordBatch.from_arrays(
            [batch.column("doc_id"), pa.array(np.diff(at)), pa.array(removed, pa.int64()), pa.array(spans, pa.int64()), pa.array(sha, pa.string()), pa.array(kept, pa.binary())],
            ["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256", "removed"],
        )


def repeated_passages(docs: DataFrame, length: int = LENGTH, gram: int = GRAM) -> DataFrame:
    """doc_id, n_bytes, n_removed, n_spans, kept_sha256, and ``removed``: int32 pairs of byte positions (null: none or all)."""
    docs = bounded_batches(docs)
    spark = docs.sparkSession
    text = F.coalesce("text", F.lit(""))
    rows = with_sid(docs, text.cast("binary").alias("text"), F.xxhash64(text).alias("row"))
    hashed = rows.select("doc_id", "sid", "row", F.octet_length("text").cast("long").alias("n_bytes"), F.sha2("text", 256).alias("sha"))
    hashed = materialize(hashed, "hashed")
    # Joined on the id too: a hot group of copies spreads over all partitions.
    first = hashed.groupBy("sha").agg(F.min("sid").alias("sid")).withColumn("first", F.lit(True))
    copy = F.col("first").isNull() & (F.col("n_bytes") >= length)
    base = materialize(hashed.join(first, ["sha", "sid"], "left").withColumn("copy", copy).drop("first"), "base")
    total, copies = base.agg(F.sum("n_bytes"), F.count_if("copy")).first()
    parts = partitions(spark, total or 0, PART_BYTES)
    texts = rows.select("doc_id", "sid", "row", "text")
    if copies:
        texts = keyed_join(texts, base.where("copy").select("sid", "row"), ["sid", "row"], "left_anti", 24, copies)

    def by_document(df: DataFrame, kind: str, width: int) -> DataFrame:
        return df.repartitionById(parts, "part").mapInArrow(partial(_documents, kind=kind, width=width), "sid long, x binary")

    # The lists grow with the text, so the texts meet them by a shuffle at every size.
    sent = texts.select("sid", "text").mapInArrow(partial(_send_anchors, length=length, gram=gram, parts=parts), PART).repartitionById(parts, "part")
    shared = materialize(by_document(sent.mapInArrow(partial(_shared_anchors, parts=parts), "part int, sid binary, x binary"), "int32", 1), "shared")
    around = texts.join(shared.hint("merge"), "sid").select("sid", "text", "x")
    around = around.mapInArrow(partial(_send_contexts, length=length, gram=gram, parts=parts), PART).repartitionById(parts, "part")
    spans = by_document(around.mapInArrow(partial(_repeated, length=length, gram=gram, parts=parts), "part int, sid binary, x binary"), "int32", 2)
    spans = materialize(spans, "spans")
    kind = "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string, removed binary"
    cut = texts.join(spans.hint("merge"), "sid").select("doc_id", "text", "x").mapInArrow(_removed, kind)
    rest = base.join(spans.select("sid").withColumn("cut", F.lit(True)), "sid", "left").where(F.col("copy") | F.col("cut").isNull())
    gone = F.col("copy")
    rest = rest.select(
        "doc_id",
        "n_bytes",
        F.when(gone, F.col("n_bytes")).otherwise(0).cast("long").alias("n_removed"),
        F.when(gone, 1).otherwise(0).cast("long").alias("n_spans"),
        F.when(gone, F.sha2(F.lit("").cast("binary"), 256)).otherwise(F.col("sha")).alias("kept_sha256"),
        F.lit(None).cast("binary").alias("removed"),
    )
    return cut.unionByName(rest)
