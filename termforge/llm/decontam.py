"""Benchmark decontamination by a prefix-filtered set join.

A benchmark item's windows are WINDOW consecutive words, or the whole of a shorter item. Containment is exact, so of a window's
words, ordered by rarity over all documents, the necessary prefix is its rarest word alone: a document without that word
cannot hold the window. Each occurrence of a prefix word in a document is a candidate; position and length bounds
drop those whose window would not fit, and the words of the window are compared one by one.

The windows of benchmark items are sent to all tasks in blocks of about BLOCK_WORDS words of items, some 100 bytes a window; a larger
benchmark takes several passes over the documents, whose hits are merged per document. A window's hits in a document are
word positions, so nothing is shuffled for one block. An item longer than a block is a block alone.

Null text, or text without words, is never hit and no item. Repeated items count once; windows of an item without an
item_id hit words but name no item. Of equally rare words of a window the one with the least hash is the prefix. An empty table of documents gives
an empty result; without benchmark nothing is hit. Extra columns are not read. A task holds an Arrow batch, the windows of one
block, and the words of 1 MB of text or of one longer text, some 30 times its bytes.
"""

from __future__ import annotations

import re
from functools import partial

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from termforge.llm.common import ALNUM, bounded_batches, chunks, span_hashes, word_spans

WINDOW, BLOCK_WORDS = 10, 300_000
ITEM_WORD = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")


def _tally(batches, words):
    """How often each of the given word hashes occurs."""
    import numpy as np
    import pyarrow as pa

    total = np.zeros(len(words), np.int64)
    for batch in batches:
        for _, data, at in chunks(batch.column("text")):
            starts, ends, _ = word_spans(data, at, ALNUM)
            h = span_hashes(data, starts, ends)
            i = np.minimum(np.searchsorted(words, h), max(len(words) - 1, 0))
            total += np.bincount(i[words[i] == h], minlength=len(words))
    some = total > 0  # a task sends on what it has, not a row for every word
    yield pa.RecordBatch.from_arrays([pa.array(words[some].view(np.int64)), pa.array(total[some])], ["word", "n"])


def item_windows(items, window: int):
    """(item index, word hashes) of the distinct windows of (item_id, text) rows."""
    import pyarrow as pa

    column = pa.array([t for _, t in items], pa.string())
    out = {}
    for row, data, at in chunks(column):
        starts, ends, first = word_spans(data, at, ALNUM)
        h = span_hashes(data, starts, ends)
        for k, (a, b) in enumerate(zip(first[:-1].tolist(), first[1:].tolist(), strict=True)):
            for i in range(a, max(b - window, a if b > a else a - 1) + 1):
                out[(row + k, h[i : min(i + window, b)].tobytes())] = None
    return list(out)


def _hits(batches, index, window):
    import numpy as np
    import pyarrow as pa

    keys, first, rows, offset, size, words, item = index
    for batch in batches:
        n_words, spans, items = [], [], []
        for _, data, at in chunks(batch.column("text")):
            starts, ends, before = word_spans(data, at, ALNUM)
            h = span_hashes(data, starts, ends)
            n_words += np.diff(before).tolist()
            own = {}
            if len(keys) and len(h):
                k = np.minimum(np.searchsorted(keys, h), len(keys) - 1)
                pos = np.flatnonzero(keys[k] == h)
                k = k[pos]
                many = first[k + 1] - first[k]
                pos, start = np.repeat(pos, many), np.repeat(first[k], many)
                win = rows[start + np.arange(len(start)) - np.repeat(np.cumsum(many) - many, many)]
                begin = pos - offset[win]
                doc = np.searchsorted(before, pos, "right") - 1
                fits = (begin >= before[doc]) & (begin + size[win] <= before[doc + 1])
                begin, win, doc = begin[fits], win[fits], doc[fits]
                for j in range(window):
                    same = (size[win] <= j) | (h[np.minimum(begin + j, len(h) - 1)] == words[win, j])
                    begin, win, doc = begin[same], win[same], doc[same]
                for d, b, w in zip(doc.tolist(), (begin - before[doc]).tolist(), win.tolist(), strict=True):
                    got = own.setdefault(d, (set(), set()))
                    got[0].add((b, b + int(size[w])))
                    got[1].add(item[w])
            for d in range(len(at) - 1):
                got = own.get(d, ((), ()))
                spans.append([{"a": a, "b": b} for a, b in sorted(got[0])])
                items.append(sorted(x for x in got[1] if x is not None))
        kind = pa.list_(pa.struct([("a", pa.int32()), ("b", pa.int32())]))
        yield pa.RecordBatch.from_arrays(
            [batch.column("doc_id"), batch.column("text_key"), pa.array(n_words, pa.int64()), pa.array(spans, kind), pa.array(items, pa.list_(pa.int64()))],
            ["doc_id", "text_key", "n_words", "spans", "items"],
        )


def _index(items, windows, rarity, window):
    """The windows ordered by prefix word, as arrays."""
    import numpy as np

    size = np.array([len(w) // 8 for _, w in windows], np.int64)
    words = np.zeros((len(windows), window), np.uint64)
    inside = np.arange(window) < size[:, None]
    words[inside] = np.frombuffer(b"".join(w for _, w in windows), np.uint64)
    # the rarest word of each window, of equally rare ones the least hash, of equal ones the first place
    known, often = rarity
    n = np.full(words.shape, np.iinfo(np.int64).max)
    n[inside] = often[np.searchsorted(known, words[inside])]
    least = n == n.min(1, keepdims=True)
    offset = np.where(least, words, np.uint64(0xFFFFFFFFFFFFFFFF)).argmin(1)
    key = words[np.arange(len(windows)), offset] if len(windows) else np.zeros(0, np.uint64)
    rows = np.argsort(key, kind="stable")
    keys, first = np.unique(key[rows], return_index=True)
    return keys, np.append(first, len(rows)), rows, offset, size, words, [items[i][0] for i, _ in windows]


def _blocks(benchmark: DataFrame, block_words: int):
    """The items in lists of bounded size, read one at a time."""
    block, held, any_ = [], 0, False
    for row in benchmark.select(F.col("item_id").cast("long").alias("item_id"), "text").where("text is not null").toLocalIterator():
        block.append((row.item_id, row.text))
        held += sum(1 for _ in ITEM_WORD.finditer(row.text))
        if held > block_words:
            yield block
            block, held, any_ = [], 0, True
    if block or not any_:
        yield block


def _block_index(docs: DataFrame, block: list[tuple], window: int):
    """The index of one block of items, its words counted over all documents."""
    import numpy as np

    windows = item_windows(block, window)
    words = np.unique(np.frombuffer(b"".join(w for _, w in windows), np.uint64))
    often = np.zeros(len(words), np.int64)
    if len(words):
        counts = docs.select("text").mapInArrow(partial(_tally, words=words), "word long, n long").groupBy("word").agg(F.sum("n").alias("n")).toArrow()
        often[np.searchsorted(words, counts.column("word").to_numpy().view(np.uint64))] = counts.column("n").to_numpy()  # the words of one block
    return _index(block, windows, (words, often), window)


def _pass(docs: DataFrame, block: list[tuple], window: int) -> DataFrame:
    """The hits of one block of items in all documents, as word spans and items."""
    docs = bounded_batches(docs)
    kind = "doc_id long, text_key long, n_words long, spans array<struct<a:int,b:int>>, items array<long>"
    return docs.select("doc_id", "text", F.xxhash64("text").alias("text_key")).mapInArrow(partial(_hits, index=_block_index(docs, block, window), window=window), kind)


def _keep_clean(batches, index, window):
    import pyarrow as pa
    import pyarrow.compute as pc

    for batch in batches:
        none = pa.nulls(batch.num_rows, pa.int64())
        (found,) = _hits([pa.RecordBatch.from_arrays([none, none, batch.column("text")], ["doc_id", "text_key", "text"])], index, window)
        yield batch.filter(pc.equal(pc.list_value_length(found.column("spans")), 0))


def uncontaminated(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW, block_words: int = BLOCK_WORDS) -> DataFrame:
    """The rows of ``docs``, all columns, without a hit; each block of items filters what the one before left."""
    docs = bounded_batches(docs)
    out = docs
    for block in _blocks(benchmark, block_words):
        out = out.mapInArrow(partial(_keep_clean, index=_block_index(docs, block, window), window=window), docs.schema)
    return out


def contamination(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW, block_words: int = BLOCK_WORDS) -> DataFrame:
    """doc_id, n_words, n_hit, n_items, items_sha256, contaminated, and the spans (word positions) and items themselves."""
    blocks = [_pass(docs, block, window) for block in _blocks(benchmark, block_words)]
    hits = blocks[0]
    if len(blocks) > 1:
        # Rows are told apart by id and text; equal rows come back as often as they went in.
        for more in blocks[1:]:
            hits = hits.unionByName(more)
        hits = hits.groupBy("doc_id", "text_key", "n_words").agg(
            F.flatten(F.collect_list("spans")).alias("spans"),
            F.array_sort(F.array_distinct(F.flatten(F.collect_list("items")))).alias("items"),
            (F.count("*") / F.lit(len(blocks))).cast("int").alias("times"),
        )
        hits = hits.withColumn("again", F.explode(F.sequence(F.lit(1), "times")))
    start = F.struct(F.lit(0).alias("end"), F.lit(0).cast("long").alias("n"))
    step = lambda s, x: F.struct(F.greatest(s["end"], x["b"]).alias("end"), (s["n"] + F.greatest(F.lit(0), x["b"] - F.greatest(x["a"], s["end"]))).alias("n"))
    n_hit = F.aggregate(F.array_sort("spans"), start, step, lambda s: s["n"])
    names = F.array_sort(F.transform("items", lambda x: x.cast("string")))
    return hits.select(
        "doc_id",
        "n_words",
        n_hit.alias("n_hit"),
        F.size("items").cast("long").alias("n_items"),
        F.sha2(F.array_join(names, ","), 256).alias("items_sha256"),
        (n_hit > 0).alias("contaminated"),
        "spans",
        "items",
    )
