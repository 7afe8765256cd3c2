"""Near-duplicate records: a record stays unless an earlier record that stays is as similar.

Similarity is 1 - edit distance / longer length. Equal texts collapse first. Candidate pairs come from an exact filter: of a
text cut into one piece more than there may be edits, one piece is left whole in any text that close, with as many edits before it as
there are pieces before it (where the edits less the pieces so far first fall below none). Texts meet in blocks of like sizes, not as rows of pieces; pairs
that differ in too many short groups of characters go there. The others are verified with the thresholded distance, then the records that stay are the
lexicographically first maximal independent set, found in rounds; each round is written out.
"""

from __future__ import annotations

import math
from functools import partial

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from termforge.operators.shared import materialize

THRESHOLD = 0.9
#: Characters in a block of shorter texts, in a slice of longer ones, and of texts looked at together; pairs looked at together, and sent together.
BLOCK, SLICE, CHUNK, PAIRS, SENT = 16 << 20, 32 << 20, 1 << 19, 1 << 20, 1 << 12
#: Characters in a group, and most bins that a text's groups are counted in.
GRAM, BINS = 4, 1 << 16


def _powers(n: int, cache: dict = {}):  # noqa: B006  one table a process, as long as its longest chunk
    import numpy as np

    if len(cache.get("p", ())) < n:
        for name, base in (("p", 0x9E3779B97F4A7C15), ("i", pow(0x9E3779B97F4A7C15, -1, 1 << 64))):
            table = np.full(n, base, np.uint64)
            table[0] = 1
            cache[name] = np.multiply.accumulate(table)
    return cache["p"], cache["i"]


class _Chunk:
    """Some texts one after the other: their characters, sizes and starts, and hashes of what stands in them."""

    def __init__(self, first: int, texts: list[str], sizes):
        import numpy as np

        self.first, self.sizes = first, sizes
        self.starts = np.cumsum(sizes) - sizes
        x = np.frombuffer("".join(texts).encode("utf-32-le"), np.uint32).astype(np.uint64) + np.uint64(1)
        power, self.inverse = _powers(len(x) + 1)
        self.total = np.append(np.uint64(0), np.cumsum(x * power[: len(x)]))

    def _mixed(self, h, n):
        import numpy as np

        h = h + np.uint64(0xD6E8FEB86659FD93) * np.asarray(n).astype(np.uint64)
        h = (h ^ (h >> np.uint64(31))) * np.uint64(0xBF58476D1CE4E5B9)
        return h ^ (h >> np.uint64(29))

    def hashes(self, at, n):
        """Of the ``n`` characters from each place of ``at``."""
        return self._mixed((self.total[at + n] - self.total[at]) * self.inverse[at], n)

    def every(self, n: int):
        """Of the ``n`` characters from each place, those over the end of a text too."""
        return self._mixed((self.total[n:] - self.total[:-n]) * self.inverse[: len(self.total) - n], n)

    def owners(self):
        import numpy as np

        return np.repeat(np.arange(len(self.sizes)), self.sizes)

    def grams(self, bins: int):
        """For each text, how often its groups of GRAM characters fall in each of ``bins``, a power of 2."""
        import numpy as np

        out = np.zeros(len(self.sizes) * bins, np.int64)
        if len(self.total) > GRAM:
            at, of = self.every(GRAM) >> np.uint64(65 - bins.bit_length()), self.owners()[: len(self.total) - GRAM]
            inside = np.arange(len(of)) - self.starts[of] + GRAM <= self.sizes[of]
            out = np.bincount(of[inside] * bins + at[inside].astype(np.int64), minlength=len(out))
        return np.minimum(out, 255).astype(np.uint8).reshape(-1, bins)  # fewer counted only lets more through


def _chunks(texts: list[str], sizes):
    import numpy as np

    ends, first = np.cumsum(sizes), 0
    while first < len(texts):
        last = max(first + 1, int(np.searchsorted(ends, ends[first] - sizes[first] + CHUNK, "right")))
        yield _Chunk(first, texts[first:last], sizes[first:last])
        first = last


def _flat(counts):
    """(which, number): for each i, ``counts[i]`` times i, numbered from 0."""
    import numpy as np

    which = np.repeat(np.arange(len(counts)), counts)
    return which, np.arange(len(which)) - np.repeat(np.cumsum(counts) - counts, counts)


class _Index:
    """The even pieces of the shorter texts, by hash and place."""

    def __init__(self, texts: list[str], sizes, threshold: float, edits, largest: int):
        import numpy as np

        found = {"key": [], "of": [], "at": [], "n": [], "left": [], "right": []}
        for chunk in _chunks(texts, sizes):
            pieces = edits(np.floor(chunk.sizes / threshold + 1e-9)) + 1  # of a text, for the longest partner it can have
            of, no = _flat(pieces)
            size, k = chunk.sizes[of], pieces[of]
            at, n = no * (size // k) + np.maximum(no - (k - size % k), 0), size // k + (no >= k - size % k)  # the last ones take the remainder
            bound = k <= size  # else some are empty, and any edits may stand on either side of the others
            rows = {"key": chunk.hashes(chunk.starts[of] + at, n), "of": of + chunk.first, "at": at, "n": n, "left": np.where(bound, no, k), "right": np.where(bound, no, 0)}
            for name, column in rows.items():
                found[name].append(column[n > 0])
        found = {name: np.concatenate(columns) for name, columns in found.items()}
        self.lengths = np.unique(found.pop("n")).tolist()
        self.low = np.uint64((1 << largest.bit_length()) - 1)  # bits of a key that hold the place
        self.shift = np.uint64(64 - min(25, max(16, (16 * len(found["key"])).bit_length())))
        self.seen = np.zeros(1 << (64 - int(self.shift)), bool)
        self.seen[found["key"] >> self.shift] = True
        found["key"] = (found["key"] & ~self.low) | found["at"].astype(np.uint64)
        order = np.argsort(found["key"])
        self.key, self.of, self.at, self.left, self.right = (found[name][order] for name in ("key", "of", "at", "left", "right"))

    def near(self, chunk: _Chunk, most):
        """(text of the chunk, place, entry) in parts: pieces found in the chunk's texts at most ``most`` of a text away from their own place."""
        import numpy as np

        owners = chunk.owners()
        for n in self.lengths:
            if n >= len(chunk.total):
                continue
            h = chunk.every(n)
            hit = np.flatnonzero(self.seen[h >> self.shift])
            hit = hit[np.argsort(h[hit])]  # searched for in order, which is some times faster
            of = owners[hit]
            at = hit - chunk.starts[of]
            inside = at + n <= chunk.sizes[of]
            of, at, h = of[inside], at[inside], h[hit[inside]] & ~self.low
            first = np.searchsorted(self.key, h | np.maximum(at - most[of], 0).astype(np.uint64))
            some = np.flatnonzero(first < len(self.key))
            some = some[(self.key[first[some]] & ~self.low) == h[some]]
            of, at, h, first = of[some], at[some], h[some], first[some]
            counts = np.searchsorted(self.key, h | np.minimum((at + most[of]).astype(np.uint64), self.low), "right") - first
            begin, ends = 0, np.cumsum(counts)
            while begin < len(counts):
                end = max(begin + 1, int(np.searchsorted(ends, ends[begin] - counts[begin] + PAIRS, "right")))
                which, number = _flat(counts[begin:end])
                yield of[begin:end][which], at[begin:end][which], first[begin:end][which] + number
                begin = end


def _near_texts(shorter, longer, threshold):
    """(i, j) arrays: texts ``shorter[i]`` and ``longer[j]`` (ids, texts) that may be within the threshold, each pair once."""
    import numpy as np

    rest = round(1 - threshold, 10)
    edits = lambda size: np.floor(size * rest + 1e-9).astype(np.int64)
    (s_ids, s_texts), (l_ids, l_texts) = shorter, longer
    s_size, l_size = (np.fromiter(map(len, t), np.int64, len(t)) for t in (s_texts, l_texts))
    if not len(s_size) or not len(l_size):
        return
    largest = int(max(s_size.max(), l_size.max()))
    index, bins = _Index(s_texts, s_size, threshold, edits, largest), min(BINS, 1 << largest.bit_length())
    s_grams, some = np.concatenate([c.grams(bins) for c in _chunks(s_texts, s_size)]), max(1, (16 << 20) // bins)
    for chunk in _chunks(l_texts, l_size):
        most, grams, found = edits(chunk.sizes), chunk.grams(bins), []
        for l, at, entry in index.near(chunk, most):  # noqa: E741
            s = index.of[entry]
            more, moved = chunk.sizes[l] - s_size[s], at - index.at[entry]
            fits = (more >= 0) & (s_size[s] >= np.ceil(chunk.sizes[l] * threshold - 1e-9)) & (np.abs(moved) <= index.left[entry]) & (np.abs(more - moved) <= most[l] - index.right[entry])
            fits &= (more > 0) | (s_ids[s] < l_ids[chunk.first + l])
            pairs = np.unique(l[fits] * len(s_size) + s[fits])
            for k in range(0, len(pairs), some):
                l, s = np.divmod(pairs[k : k + some], len(s_size))  # noqa: E741
                a, b = grams[l], s_grams[s]
                gone = np.subtract(np.maximum(a, b, out=a), b, out=a).sum(1, dtype=np.int64)
                near = gone <= GRAM * most[l]  # an edit takes away GRAM groups at most
                found.append(pairs[k : k + some][near])
        if found:
            l, s = np.divmod(np.unique(np.concatenate(found)), len(s_size))  # noqa: E741
            yield s, l + chunk.first


def _cells(batches, threshold):
    """(a, a_text, b, b_text) of the pairs to verify, from (cell, id, text, shorter, longer) in order of cells."""
    import numpy as np
    import pyarrow as pa

    def pairs(cell):
        sides = [(np.concatenate([ids for ids, _ in side]), [t for _, texts in side for t in texts]) for side in cell]
        for s, l in _near_texts(*sides, threshold):  # noqa: E741
            for k in range(0, len(s), SENT):
                columns = []
                for (ids, texts), i in zip(sides, (s[k : k + SENT], l[k : k + SENT]), strict=True):
                    columns += [pa.array(ids[i]), pa.array([texts[x] for x in i.tolist()], pa.string())]
                yield pa.RecordBatch.from_arrays(columns, ["a", "a_text", "b", "b_text"])

    held, at = ([], []), None
    for batch in batches:
        cells, ids, *sides = (batch.column(c).to_numpy(zero_copy_only=False) for c in ("cell", "id", "shorter", "longer"))
        texts = batch.column("text").to_pylist()
        bounds = [0, *(np.flatnonzero(cells[1:] != cells[:-1]) + 1).tolist(), len(cells)]
        for first, last in zip(bounds, bounds[1:], strict=False):
            if first == last:
                continue
            if at is not None and cells[first] != at:
                yield from pairs(held)
                held = ([], [])
            at = cells[first]
            for side, fits in zip(held, sides, strict=True):
                rows = np.flatnonzero(fits[first:last]) + first
                side.append((ids[rows], [texts[i] for i in rows.tolist()]))
    if at is not None:
        yield from pairs(held)


def similar_pairs(records: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """(a, b) with a < b: distinct texts at or over the threshold, from a written table (id, text).

    Texts are sent by band of sizes, a factor of the threshold wide: each to those of its own band as the longer one, to those of its
    own and the next as the shorter one. A large band is a grid of blocks of shorter by slices of longer texts, so a cell
    is as large whatever the band's size, and a text is sent once for each block or slice of the other side.
    """
    if threshold >= 1:
        return records.select(F.col("id").cast("long").alias("a"), F.col("id").cast("long").alias("b")).where("false")
    rest = round(1 - threshold, 10)
    band = F.floor(F.log(F.length("text").cast("double")) / -math.log(threshold) + 1e-9).cast("int")
    rows = records.select(F.col("id").cast("long").alias("id"), "text", band.alias("band")).where("text != ''")
    chars = {r.band: r.n for r in rows.groupBy("band").agg(F.sum(F.length("text")).alias("n")).collect()}  # one row a band: some hundreds
    grid, cells = [], 0
    for at, n in sorted(chars.items()):
        blocks, slices = -(-(n + chars.get(at - 1, 0)) // BLOCK), -(-n // SLICE)
        grid.append((at, blocks, slices, cells))
        cells += blocks * slices
    grid = F.broadcast(rows.sparkSession.createDataFrame(grid, "band int, blocks int, slices int, first long"))
    block, slice_ = F.pmod(F.xxhash64("id"), "blocks"), F.pmod(F.xxhash64("id", F.lit(1)), "slices")
    numbers = lambda n: F.sequence(F.lit(0).cast("long"), F.col(n).cast("long") - 1)
    goes = lambda b, s, shorter, longer: F.struct((F.col("first") + b * F.col("slices") + s).alias("cell"), shorter.alias("shorter"), longer.alias("longer"))
    yes, no = F.lit(True), F.lit(False)
    as_both = F.concat(F.transform(numbers("slices"), lambda s: goes(block, s, yes, s == slice_)), F.transform(F.filter(numbers("blocks"), lambda b: b != block), lambda b: goes(b, slice_, no, yes)))
    own = rows.join(grid, "band").select("id", "text", F.inline(as_both))
    above = rows.withColumn("band", F.col("band") + 1).join(grid, "band").select("id", "text", F.inline(F.transform(numbers("slices"), lambda s: goes(block, s, yes, no))))
    parts = max(1, min(cells, 8 + 8 * sum(chars.values()) // BLOCK, 20_000))
    dealt = own.unionByName(above).repartition(parts, "cell").sortWithinPartitions("cell")
    both = dealt.mapInArrow(partial(_cells, threshold=threshold), "a long, a_text string, b long, b_text string")
    most = F.floor(F.greatest(F.length("a_text"), F.length("b_text")) * rest + 1e-9).cast("int")
    near = both.where(F.call_function("levenshtein", "a_text", "b_text", most) >= 0)  # -1 beyond ``most``
    return near.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b"))


def first_independent(nodes: DataFrame, pairs: DataFrame) -> DataFrame:
    """(id) of the nodes that stay: a node goes if an earlier neighbour stays."""
    open_ = materialize(nodes.select("id"), "open")
    links, kept = materialize(pairs.select("a", "b"), "links"), None
    while True:
        blocked = links.select(F.col("b").alias("id")).distinct()
        now = materialize(open_.join(blocked, "id", "left_anti"), "kept")
        kept = now if kept is None else kept.union(now)
        gone = links.join(now.select(F.col("id").alias("a")), "a", "left_semi").select(F.col("b").alias("id")).distinct()
        decided = now.union(gone)
        open_ = materialize(open_.join(decided, "id", "left_anti"), "open")
        links = links.join(decided.select(F.col("id").alias("a")), "a", "left_anti").join(decided.select(F.col("id").alias("b")), "b", "left_anti")
        links = materialize(links.select("a", "b"), "links")
        if open_.isEmpty():
            return kept


def near_duplicates(records: DataFrame, threshold: float = THRESHOLD, id_col: str = "line_seq", text_col: str = "text") -> DataFrame:
    """Records with ``kept``; null or empty text is always kept."""
    text = F.col(text_col)
    rows = records.withColumns({"id": F.col(id_col), "_empty": text.isNull() | (text == "")})  # so that the last join need not send texts
    full = rows.where("not _empty").select("id", text.alias("text"))
    first = materialize(full.groupBy("text").agg(F.min("id").alias("id")), "distinct")
    kept = first_independent(first, materialize(similar_pairs(first, threshold), "pairs"))
    stay = rows.join(kept.withColumn("_kept", F.lit(True)), "id", "left")
    return stay.withColumn("kept", F.coalesce("_kept", "_empty")).drop("id", "_empty", "_kept")


def removed_count(judged: DataFrame) -> DataFrame:
    return judged.agg(F.count_if(~F.col("kept")).alias("removed"))


def distinct_in_order(rows: DataFrame, key: str, order: str) -> DataFrame:
    """The first row of each key by ``order``."""
    return rows.withColumn("_n", F.row_number().over(W.partitionBy(key).orderBy(order))).where("_n = 1").drop("_n")
