"""Near-duplicate documents by circulant MinHash, banding and exact Jaccard verification.

Two permutations of the 32-bit words make all signature coordinates: the first places a shingle, the second, shifted
circularly by k, is minimised for coordinate k. Bands of ROWS coordinates select candidates; every link is then confirmed on
the full sets of 64-bit shingle hashes. At a Jaccard similarity of exactly 0.75 a pair shares no band with probability
(1 - 0.75**ROWS)**BANDS, about 2e-6; above it less.

No step emits all pairs of a large group. Documents with equal sets become one class before banding. A document's weight is the
size of its buckets together, so the original of a group of near copies outweighs its variants; a bucket's head is its
heaviest member, and a document's hub the heaviest head of its buckets. Every document is compared with its hub. Those
that do not link are compared with all of their hub's other documents, in blocks of bounded size, where only links leave
the block, one for each two components they join. What is left are pairs of one bucket with different hubs and components:
in buckets of up to BLOCK documents they are joined, larger buckets go through blocks too. Groups are cut by set size before they are dealt into
blocks, and within a block rare shingles (the prefix that a link must share) select what is compared in full.
Pairs whose set sizes cannot reach the threshold are left out. Buckets are range-partitioned on (band hash, id), so a hot
bucket is cut over several partitions; its head is found by a partial aggregate over all of them.

A document's set: its distinct 5-word shingles; with fewer words the whole sequence; without words empty and linked with
nothing. Null text has no words. Rows without doc_id take part under one common last id and report a null component unless
linked to a document with an id. Rows sharing a doc_id are one node. An empty table gives an empty result. Extra columns are not read. A
text's set is one row: a task holds a batch of sets, 8 bytes a distinct shingle, and for a long text some 30 times its bytes.
"""

from __future__ import annotations

from functools import partial

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from termforge.llm.common import NULL_ID, WHITE, bounded_batches, chunks, hot_join, keyed_join, materialize, mix, partitions, span_hashes, with_sid, word_spans
from termforge.llm.components import connected_components

WORDS, BANDS, ROWS, NUMERATOR = 5, 48, 5, 75
#: Sets this small reach the threshold only with an equal set.
ALONE = 2
#: Documents in a block of the comparisons within one hub or one bucket.
BLOCK = 500


def shingle_sets(column, words: int = WORDS):
    """For each row of an Arrow text column the sorted distinct 64-bit hashes of its shingles."""
    import numpy as np

    odd = mix(np.arange(1, words + 1, dtype=np.uint64)) | np.uint64(1)
    for _, data, at in chunks(column):
        starts, ends, first = word_spans(data, at, WHITE_NOT)
        w = span_hashes(data, starts, ends)
        grams = np.zeros(len(w), np.uint64)
        if len(w) >= words:
            total = np.zeros(len(w) - words + 1, np.uint64)
            for j in range(words):
                total += w[j : len(w) - words + 1 + j] * odd[j]
            grams[: len(total)] = mix(total)
        for a, b in zip(first[:-1].tolist(), first[1:].tolist(), strict=True):
            if b - a >= words:
                yield np.unique(grams[a : b - words + 1])
            elif b > a:
                yield mix((w[a:b] * odd[: b - a]).sum(keepdims=True) + np.uint64(b - a))
            else:
                yield grams[:0]


WHITE_NOT = ~WHITE


def signature(items, shifts):
    """Coordinate k: the least second permutation of the first permutation's place, shifted back by k."""
    import numpy as np

    u32 = np.uint32
    place = (mix(items ^ np.uint64(0x243F6A8885A308D3)) >> np.uint64(32)).astype(u32)
    best = np.full(len(shifts), 0xFFFFFFFF, u32)
    step = 2048
    for i in range(0, len(place), step):
        x = place[None, i : i + step] - shifts[:, None]
        t = x >> u32(16)
        x ^= t
        x *= u32(0x7FEB352D)
        np.right_shift(x, u32(15), out=t)
        x ^= t
        x *= u32(0x846CA68B)
        np.right_shift(x, u32(16), out=t)
        x ^= t
        np.minimum(best, x.min(axis=1), out=best)
    return best


def _signatures(batches, words, bands, rows):
    import hashlib

    import numpy as np
    import pyarrow as pa

    shifts = np.arange(bands * rows, dtype=np.uint32)
    odd = mix(np.arange(100, 100 + rows, dtype=np.uint64)) | np.uint64(1)
    band = mix(np.arange(1000, 1000 + bands, dtype=np.uint64))
    for batch in batches:
        n, digest, keys = [], [], []
        for items in shingle_sets(batch.column("text"), words):
            n.append(len(items))
            digest.append(hashlib.blake2b(items.tobytes(), digest_size=16).digest() if len(items) else None)
            if len(items) > ALONE:
                sig = signature(items, shifts).reshape(bands, rows).astype(np.uint64)
                keys.append(mix((sig * odd).sum(axis=1) + band).view(np.int64))
            else:
                keys.append(band[:0].view(np.int64))
        lengths = np.cumsum([0, *map(len, keys)]).astype(np.int32)
        flat = np.concatenate(keys) if keys else np.zeros(0, np.int64)
        yield pa.RecordBatch.from_arrays(
            [batch.column("doc_id"), batch.column("sid"), pa.array(n, pa.int64()), pa.array(digest, pa.binary()), pa.ListArray.from_arrays(pa.array(lengths), pa.array(flat))],
            ["doc_id", "sid", "n", "digest", "bands"],
        )


def _sets(batches, words):
    import numpy as np
    import pyarrow as pa

    for batch in batches:
        sets = list(shingle_sets(batch.column("text"), words))
        lengths = np.cumsum([0, *map(len, sets)]).astype(np.int32)
        flat = np.concatenate(sets).view(np.int64) if sets else np.zeros(0, np.int64)
        n = pa.array(np.diff(lengths).astype(np.int64))
        yield pa.RecordBatch.from_arrays([batch.column("sid"), n, pa.ListArray.from_arrays(pa.array(lengths), pa.array(flat))], ["id", "n", "items"])


def _buckets(batches):
    """Rows (key, id, n) of one sorted partition: those of buckets with two members or more, or cut by the partition's edge."""
    import numpy as np
    import pyarrow as pa

    batches = [b for b in batches if b.num_rows]
    if not batches:
        return
    table = pa.Table.from_batches(batches)
    key, ids, n = (table.column(c).to_numpy() for c in ("key", "id", "n"))
    start = np.flatnonzero(np.concatenate(([True], key[1:] != key[:-1])))
    size = np.diff(np.append(start, len(key)))
    shared = size > 1
    shared[0] = shared[-1] = True
    size, take = np.repeat(size, size), np.flatnonzero(np.repeat(shared, size))
    for i in range(0, len(take), 20_000):
        t = take[i : i + 20_000]
        yield pa.RecordBatch.from_arrays([pa.array(x) for x in (key[t], ids[t], n[t], size[t])], ["key", "id", "n", "size"])


def _block_links(probes, members, numerator):
    """Links between the probes and members of a block, rows (id, component, set): one for each two components that they join.

    Each set is ordered by rarity in the block. Two sets that link share an item among the first n - ceil(threshold * n) + 1 of
    each, so only members that a probe meets there, and that are not joined with it by then, are compared in full.
    """
    import numpy as np

    ids, of, sets = (list(x) for x in zip(*members, strict=True))
    every = [*sets, *(x for _, _, x in probes)]
    sizes = np.array([len(x) for x in every])
    known, flat, often = np.unique(np.concatenate(every), return_inverse=True, return_counts=True)
    rarity = np.empty(len(known), np.int64)
    rarity[np.argsort(often, kind="stable")] = np.arange(len(known))
    owner = np.repeat(np.arange(len(every)), sizes)
    flat = np.sort(owner * len(known) + rarity[flat]) - owner * len(known)
    ends = np.cumsum(sizes)
    starts = ends - sizes
    prefix = sizes - -(-numerator * sizes // 100) + 1
    early = np.flatnonzero((np.arange(len(flat)) - starts[owner] < prefix[owner]) & (owner < len(ids)))
    early = early[np.argsort(flat[early], kind="stable")]
    item, holder = flat[early], owner[early]
    mark = np.zeros(len(known), bool)
    parent: dict = {}

    def root(x):
        while parent.setdefault(x, x) != x:
            parent[x] = x = parent[parent[x]]
        return x

    for p, (probe, own, _) in enumerate(probes, len(ids)):
        mine = flat[starts[p] : ends[p]]
        head = mine[: prefix[p]]
        low, high = np.searchsorted(item, head), np.searchsorted(item, head, "right")
        met = [holder[i:j] for i, j in zip(low.tolist(), high.tolist(), strict=True) if i < j]
        if not met:
            continue
        met = np.unique(np.concatenate(met))
        met = met[100 * np.minimum(sizes[met], len(mine)) >= numerator * np.maximum(sizes[met], len(mine))]
        mark[mine] = True
        for k in met.tolist():
            a, b = root(own), root(of[k])
            if a != b:
                both = int(np.count_nonzero(mark[flat[starts[k] : ends[k]]]))
                if 100 * both >= numerator * (len(mine) + int(sizes[k]) - both):
                    parent[a] = b
                    yield probe, ids[k]
        mark[mine] = False


BLOCK_KEY = ("key", "stratum", "other", "ublock", "mblock")


def _blocks(batches, numerator):
    """Links within each block (BLOCK_KEY) of one sorted partition."""
    import pyarrow as pa

    key, probes, members, out = None, [], [], []

    def done():
        if probes and members:
            out.extend(_block_links(probes, members, numerator))
        probes.clear()
        members.clear()

    for batch in batches:
        items = batch.column("items")
        at, flat = items.offsets.to_numpy(), items.values.to_numpy()
        for i, row in enumerate(zip(*(batch.column(c).to_pylist() for c in (*BLOCK_KEY, "probe", "id", "c")), strict=True)):
            if row[:5] != key:
                done()
                key = row[:5]
            (probes if row[5] else members).append((row[6], row[7], flat[at[i] : at[i + 1]].copy()))
    done()
    yield pa.RecordBatch.from_arrays([pa.array([x for x, _ in out], pa.int64()), pa.array([y for _, y in out], pa.int64())], ["a", "b"])


def within_groups(rows: DataFrame, sets: DataFrame, numerator: int, block: int) -> DataFrame:
    """Links (a, b) of the probes of each group with all of its members that their component ``c`` does not join yet.

    ``rows``: (key, id, n, c, probe), a written table. A group is cut by set size into strata, each a factor
    100 / numerator wide, so that sets that link lie in one stratum or in neighbours; strata are dealt into blocks.
    """
    total = rows.count()
    rows = rows.withColumn("s", F.floor(F.log("n") / F.log(F.lit(100.0 / numerator)) + 1e-9).cast("int")) if numerator < 100 else rows.withColumn("s", F.col("n").cast("int"))
    blocks = lambda n: F.ceil(n / block).cast("int")
    sizes = rows.groupBy("key", "s").agg(blocks(F.count("*")).alias("gm"), blocks(F.count_if("probe")).alias("gu"), F.count("*").alias("times"))
    # What each stratum meets: itself and its neighbours, as an array of at most three.
    near = sizes.select("key", "gm", "gu", F.col("s").alias("t"), F.explode(F.array(F.col("s") - 1, F.col("s"), F.col("s") + 1)).alias("s"))
    met = near.groupBy("key", "s").agg(F.collect_list(F.struct("t", "gm", "gu")).alias("met"))
    sizes = sizes.join(met, ["key", "s"]).withColumn("at", F.struct("key", "s")).select("at", "gm", "gu", "met", "times")
    split = hot_join(rows.withColumn("at", F.struct("key", "s")), sizes, "at", "times", total)
    split = split.select("*", F.explode("met").alias("m")).drop("met")
    upto = lambda c: F.explode(F.sequence(F.lit(0), c - 1))
    deal = lambda c: F.pmod(F.xxhash64("id"), c).cast("int")
    t = F.col("m.t")
    members = split.where("m.gu > 0").select("key", t.alias("stratum"), F.col("s").alias("other"), upto(F.col("m.gu")).alias("ublock"), deal(F.col("gm")).alias("mblock"), F.lit(False).alias("probe"), "id", "n", "c")
    probes = split.where("probe").select("key", F.col("s").alias("stratum"), t.alias("other"), deal(F.col("gu")).alias("ublock"), upto(F.col("m.gm")).alias("mblock"), F.lit(True).alias("probe"), "id", "n", "c")
    dealt = members.union(probes).join(sets, ["id", "n"]).repartition(partitions(rows.sparkSession), *BLOCK_KEY).sortWithinPartitions(*BLOCK_KEY)
    return materialize(dealt.mapInArrow(partial(_blocks, numerator=numerator), "a long, b long"), "linked")


def near_duplicates(docs: DataFrame, words: int = WORDS, bands: int = BANDS, rows: int = ROWS, numerator: int = NUMERATOR, block: int = BLOCK) -> DataFrame:
    """One row per input row: doc_id, n_shingles, component_id, kept. Links: 100 * intersection >= numerator * union."""
    docs = bounded_batches(docs)
    spark = docs.sparkSession
    signed = with_sid(docs, "text").mapInArrow(partial(_signatures, words=words, bands=bands, rows=rows), "doc_id long, sid long, n long, digest binary, bands array<long>")
    signed = materialize(signed, "signatures")
    classes = materialize(signed.where("n > 0").groupBy("digest").agg(F.min("sid").alias("rep"), F.first("n").alias("n"), F.first("bands").alias("bands"), F.count("*").alias("times")), "classes")
    total, sets_of = classes.agg(F.coalesce(F.sum("times"), F.lit(0)), F.count("*")).first()
    member = hot_join(signed.select("doc_id", "sid", "n", "digest"), classes.select("digest", "rep", "times"), "digest", "times", total, "left").select("doc_id", "n", F.coalesce("rep", "sid").alias("rep"))

    # A rep that several sets share (rows with the same doc_id) is banded under each of them.
    exploded = classes.where(F.col("n") > ALONE).select(F.explode("bands").alias("key"), F.col("rep").alias("id"), "n")
    parts = partitions(spark, sets_of * bands)
    stars = exploded.repartitionByRange(parts, "key", "id").sortWithinPartitions("key", "id")
    stars = materialize(stars.mapInArrow(_buckets, "key long, id long, n long, size long"), "buckets")
    near = lambda a, b: 100 * F.least(a, b) >= numerator * F.greatest(a, b)

    weights = stars.groupBy("id").agg(F.sum("size").alias("weight"))
    weighed = materialize(stars.select("key", "id", "n").join(weights, "id"), "weighed")
    in_buckets = weighed.count()
    heads = weighed.groupBy("key").agg(F.max(F.struct("weight", (-F.col("id")).alias("id"))).alias("head"), F.count("*").alias("times"))
    heads = materialize(heads, "heads")
    family = hot_join(weighed, heads, "key", "times", in_buckets).groupBy("id").agg(F.max("head").alias("head")).select("id", (-F.col("head.id")).alias("hub"))
    family = materialize(family, "hubs")

    sets = keyed_join(with_sid(docs, "text").select("sid", "text"), family.select(F.col("id").alias("sid")), "sid", "left_semi", 16)
    sets = materialize(sets.mapInArrow(partial(_sets, words=words), "id long, n long, items array<long>"), "sets")

    def verified(pairs: DataFrame) -> DataFrame:
        """Pairs that link. A node of many pairs ``a`` has its set sent once for each ``block`` of them."""
        pairs = materialize(pairs, "candidates")
        counts = pairs.groupBy("a").agg(F.count("*").alias("times")).withColumn("copies", F.ceil(F.col("times") / block).cast("int"))
        counts = materialize(counts, "counts")
        dealt = hot_join(pairs, counts, "a", "times", pairs.count()).withColumn("deal", F.pmod(F.xxhash64("b"), "copies").cast("int"))
        left = sets.select(F.col("id").alias("a"), F.col("items").alias("x")).join(counts, "a").withColumn("deal", F.explode(F.sequence(F.lit(0), F.col("copies") - 1)))
        right = sets.select(F.col("id").alias("b"), F.col("items").alias("y"))
        both = F.size(F.array_intersect("x", "y"))
        met = dealt.select("a", "b", "deal").join(left.select("a", "deal", "x"), ["a", "deal"]).join(right, "b")
        return materialize(met.where(100 * both >= numerator * (F.size("x") + F.size("y") - both)).select("a", "b"), "linked")

    # 1: each document with its hub.
    edges = verified(family.where("id != hub").select(F.col("hub").alias("a"), F.col("id").alias("b")))
    family = family.join(edges.select(F.col("a").alias("hub"), F.col("b").alias("id"), F.lit(True).alias("hit")).distinct(), ["hub", "id"], "left")
    linked = F.coalesce("hit", F.lit(False)) | (F.col("id") == F.col("hub"))
    family = family.select("id", "hub", linked.alias("linked")).join(sets.select("id", "n").distinct(), "id")
    family = materialize(family.select(F.col("hub").alias("key"), "id", "n", F.when(F.col("linked"), F.col("hub")).otherwise(F.col("id")).alias("c"), (~F.col("linked")).alias("probe")), "family")

    # 2: those not linked with all others of their hub, in blocks.
    edges = edges.union(within_groups(family, sets, numerator, block))
    label = materialize(connected_components(edges), "labels")

    # 3: members of one bucket whose hubs and components differ: small buckets as pairs, others in blocks.
    inside = weighed.select("key", "id", "n").join(family.select("id", F.col("key").alias("hub")).distinct(), "id").join(label.select(F.col("node").alias("id"), "component"), "id", "left")
    inside = materialize(inside.select("key", "id", "n", "hub", F.coalesce("component", "id").alias("c")), "inside")
    mixed = inside.groupBy("key").agg(F.min("c").alias("low"), F.max("c").alias("high"), F.min("hub").alias("h1"), F.max("hub").alias("h2"), F.count("*").alias("times"))
    mixed = materialize(mixed.where("low != high and h1 != h2").select("key", (F.col("times") > block).alias("large"), "times"), "mixed")
    inside = materialize(hot_join(inside, mixed, "key", "times", in_buckets), "mixed_rows")
    x, y = (inside.where("not large").select("key", *(F.col(c).alias(c + s) for c in ("id", "n", "hub", "c"))) for s in "xy")
    apart = (F.col("idx") < F.col("idy")) & (F.col("cx") != F.col("cy")) & (F.col("hubx") != F.col("huby")) & (F.col("idx") != F.col("huby")) & (F.col("idy") != F.col("hubx"))
    cross = materialize(x.join(y, "key").where(apart & near(F.col("nx"), F.col("ny"))).select(F.col("idx").alias("a"), F.col("idy").alias("b")).distinct(), "pairs")
    more = []
    if not cross.isEmpty():
        more.append(verified(cross))
    large = materialize(inside.where("large").select("key", "id", "n", "c", F.lit(True).alias("probe")), "large")
    if not large.isEmpty():
        more.append(within_groups(large, sets, numerator, block))
    for found in more:
        edges = edges.union(found)
    if more:
        label = materialize(connected_components(edges), "labels")

    out = member.join(label.select(F.col("node").alias("rep"), "component"), "rep", "left")
    component = F.coalesce("component", "rep")
    return out.select(
        "doc_id",
        F.col("n").alias("n_shingles"),
        F.when(component != NULL_ID, component).alias("component_id"),
        (component == F.coalesce("doc_id", F.lit(NULL_ID))).alias("kept"),
    )


def representatives(docs: DataFrame, **options) -> DataFrame:
    """The rows of ``docs``, all columns, that stand for their component; rows without doc_id stay."""
    gone = materialize(near_duplicates(docs, **options).where("not kept and doc_id is not null").select(F.col("doc_id").alias("__gone")).distinct(), "gone")
    return keyed_join(docs, gone, docs["doc_id"].cast("long") == gone["__gone"], "left_anti", 16)
