"""Exact deduplication by content sort.

Texts are normalised (each run of ``[\\x20\\x09-\\x0D]`` becomes one space). A sample of the rows gives splitters, which cut the
table into ranges of the normalised bytes. A splitter holds the first PREFIX bytes, then the digest of all bytes, then the id: it is of
bounded size, and a text that a third of all rows share is cut over several ranges. Within a range Spark's external sort
by the whole normalised bytes and the id puts equals next to each other, the smallest id first; one pass compares every
text with its neighbour in full. Only the first and the last text of a range, in the splitters' order, can go on in another: these, two texts
a range, are compared in full across ranges and their counts joined.

Memory: a task holds one Arrow batch, the ids of the run of equal texts it is in (at most those of its range, PART_ROWS on
average) and two texts; a text is one row, so the longest one has to fit several times.

Null text counts as empty. A null doc_id sorts last. Of rows with the same doc_id and equal text one stays. An empty table
gives an empty result. Extra columns are not read.
"""

from __future__ import annotations

from functools import partial

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from termforge.llm.common import NULL_ID, bounded_batches, keyed_join, materialize, partitions, with_sid

#: Leading bytes in a splitter.
PREFIX = 32
#: Rows and bytes of a range at most on average; with more there are more ranges. Sampled rows for each range.
PART_ROWS, PART_BYTES, SAMPLED = 500_000, 512 << 20, 20
#: What a row takes besides its text, when ranges are cut.
ROW_BYTES = 200
SPACES = r"[\x20\x09-\x0D]+"


def normalized(text="text"):
    return F.regexp_replace(F.coalesce(F.col(text), F.lit("")), SPACES, " ")


def _place_keys(norm, sha, sid):
    """What splitters compare, one fixed-width string a row: the first bytes, the digest, the id."""
    import numpy as np
    import pyarrow.compute as pc

    heads = np.array(pc.binary_slice(norm, 0, PREFIX).to_pylist(), f"S{PREFIX}")
    raw = np.empty((len(heads), PREFIX + 40), np.uint8)
    raw[:, :PREFIX] = heads.view(np.uint8).reshape(-1, PREFIX)
    raw[:, PREFIX : PREFIX + 32] = np.frombuffer(b"".join(sha), np.uint8).reshape(-1, 32)
    raw[:, PREFIX + 32 :] = (np.ascontiguousarray(sid) ^ np.int64(-(2**63))).astype(">i8").view(np.uint8).reshape(-1, 8)
    return raw.view(f"S{PREFIX + 40}").ravel()


def _normal(column):
    """The normalised texts as binary and their digests."""
    import hashlib

    import pyarrow as pa
    import pyarrow.compute as pc

    norm = pc.replace_substring_regex(pc.fill_null(column, ""), pattern=SPACES, replacement=" ").cast(pa.binary())
    return norm, [hashlib.sha256(x.as_buffer()).digest() for x in norm]


def _sampled(batches):
    import pyarrow as pa
    import pyarrow.compute as pc

    for batch in batches:
        if batch.num_rows:
            norm, sha = _normal(batch.column("text"))
            keys = _place_keys(norm, sha, batch.column("sid").to_numpy())
            yield pa.RecordBatch.from_arrays([pa.array([k.ljust(PREFIX + 40, b"\0") for k in keys.tolist()], pa.binary()), pc.binary_length(norm).cast(pa.int64())], ["key", "n"])


def _dealt(batches, splitters):
    """Each row's range, with its normalised text and digest."""
    import numpy as np
    import pyarrow as pa

    for batch in batches:
        if batch.num_rows:
            norm, sha = _normal(batch.column("text"))
            part = np.searchsorted(splitters, _place_keys(norm, sha, batch.column("sid").to_numpy()), "right")
            yield pa.RecordBatch.from_arrays([pa.array(part.astype(np.int32)), batch.column("sid"), norm, pa.array(sha, pa.binary())], ["part", "sid", "norm", "sha"])


def splitters_of(rows: DataFrame, parts: int, total: int):
    """The keys that cut ``rows`` (sid, text) into at most ``parts`` ranges of like bytes, from about SAMPLED rows a range."""
    import numpy as np

    if parts < 2:
        return np.zeros(0, f"S{PREFIX + 40}")
    share = min(1.0, SAMPLED * parts / max(total, 1))
    some = rows.sample(share, 5) if share < 1 else rows
    found = some.mapInArrow(_sampled, "key binary, n long").toArrow()  # SAMPLED keys of 72 bytes a range: the bound of what reaches the driver
    keys = np.array(found.column("key").to_pylist(), f"S{PREFIX + 40}")
    order = np.argsort(keys, kind="stable")
    upto = np.cumsum(found.column("n").to_numpy()[order] + ROW_BYTES)
    return np.unique(keys[order][np.searchsorted(upto, upto[-1] * np.arange(1, parts) / parts)]) if len(keys) else keys


RUNS = "part int, run long, sid long, first boolean, keep long, size long, sha binary, border binary"


def _runs(batches):
    """The rows of one sorted range with the first id and size of their run; then its two runs that may go on elsewhere, with their text."""
    import numpy as np
    import pyarrow as pa
    import pyarrow.compute as pc

    names = [c.split()[0] for c in RUNS.split(", ")]
    part, last, runs, held = None, None, 0, []
    edges: dict[str, tuple] = {}  # "low", "high": (place, run, text, first id); sizes come when the run has ended
    sizes: dict[int, int] = {}

    def rows(sid, start, sha):
        """Ended runs: their ids, where each starts, its digest."""
        size = np.diff(np.append(start, len(sid)))
        for k in {e[1] for e in edges.values()}:
            if 0 <= k - runs < len(size):
                sizes[k] = int(size[k - runs])
        for i in range(0, len(start), 10_000):
            a, b = int(start[i]), int(start[i + 10_000]) if i + 10_000 < len(start) else len(sid)
            each = np.repeat(np.arange(i, min(i + 10_000, len(start))), size[i : i + 10_000])
            n = b - a
            cols = [np.full(n, part, np.int32), each + runs, sid[a:b], np.arange(a, b) == start[each], sid[start[each]], size[each]]
            yield pa.RecordBatch.from_arrays([*(pa.array(c) for c in cols), pa.array(sha, pa.binary()).take(pa.array(each)), pa.nulls(n, pa.binary())], names)

    for batch in batches:
        n = batch.num_rows
        if not n:
            continue
        part = batch.column("part")[0].as_py()
        text, sid, sha = batch.column("norm"), np.array(batch.column("sid")), batch.column("sha")
        new = np.ones(n, bool)
        if n > 1:
            new[1:] = ~np.asarray(pc.equal(text.slice(1), text.slice(0, n - 1)))
        new[0] = last is None or last[0] != text[0].as_py()
        at = np.flatnonzero(new)
        if last is not None and len(at):  # the open run has ended
            ids = np.concatenate([*held, sid[: at[0]]])
            yield from rows(ids, np.zeros(1, np.int64), [last[1]])
            runs, held, last = runs + 1, [], None
        if not len(at):
            held.append(sid)
            continue
        digest = sha.take(pa.array(at)).to_pylist()
        place = [x.ljust(PREFIX, b"\0") + d for x, d in zip(pc.binary_slice(text, 0, PREFIX).take(pa.array(at)).to_pylist(), digest, strict=True)]
        for name, pick in (("low", min), ("high", max)):
            k = pick(range(len(at)), key=place.__getitem__)
            if name not in edges or pick(edges[name][0], place[k]) != edges[name][0]:
                edges[name] = (place[k], runs + k, text[int(at[k])].as_py(), int(sid[at[k]]))
        if len(at) > 1:
            yield from rows(sid[at[0] : at[-1]], at[:-1] - at[0], digest[:-1])
            runs += len(at) - 1
        held, last = [sid[at[-1] :]], (text[int(at[-1])].as_py(), digest[-1])
    if last is None:
        return
    yield from rows(np.concatenate(held), np.zeros(1, np.int64), [last[1]])
    for _, run, text, keep in {e[1]: e for e in edges.values()}.values():
        cols = {"part": part, "run": run, "keep": keep, "size": sizes[run], "border": text}
        kinds = (pa.int32(), pa.int64(), pa.int64(), pa.bool_(), pa.int64(), pa.int64(), pa.binary(), pa.binary())
        yield pa.RecordBatch.from_arrays([pa.array([cols.get(c)], k) for c, k in zip(names, kinds, strict=True)], names)


def exact_duplicates(docs: DataFrame) -> DataFrame:
    """One row per input row: doc_id, keep_id, group_size, kept, text_sha256 of the normalised text."""
    docs = bounded_batches(docs)
    spark = docs.sparkSession
    total, size = docs.agg(F.count("*"), F.coalesce(F.sum(F.octet_length("text")), F.lit(0))).first()
    parts = max(partitions(spark, total, PART_ROWS), partitions(spark, size, PART_BYTES))
    rows = with_sid(docs, "text").select("sid", "text")
    dealt = rows.mapInArrow(partial(_dealt, splitters=splitters_of(rows, parts, total)), "part int, sid long, norm binary, sha binary")
    ordered = dealt.repartitionById(parts, "part").sortWithinPartitions("norm", "sid")
    found = materialize(ordered.mapInArrow(_runs, RUNS), "runs")
    # Two rows a range at most: the runs that may go on in another.
    edges = found.where("border is not null").select("part", "run", "keep", "size", "border")
    whole = edges.groupBy("border").agg(F.min("keep").alias("all_keep"), F.sum("size").alias("all_size"), F.min("part").alias("at"))
    edges = edges.join(whole, "border").select("part", "run", "all_keep", "all_size", (F.col("part") == F.col("at")).alias("head"))
    out = keyed_join(found.where("border is null"), edges, ["part", "run"], "left", 64, 2 * parts)
    keep, size = F.coalesce("all_keep", "keep"), F.coalesce("all_size", "size")
    nullable = lambda c: F.when(c != NULL_ID, c)
    return out.select(
        nullable(F.col("sid")).alias("doc_id"),
        nullable(keep).alias("keep_id"),
        size.alias("group_size"),
        (F.col("first") & F.coalesce("head", F.lit(True))).alias("kept"),
        F.lower(F.hex("sha")).alias("text_sha256"),
    )


def distinct_texts(docs: DataFrame) -> DataFrame:
    """The rows of ``docs``, all columns, that stay; of rows alike in doc_id and text one stays. Rows meet their decision by id and digest."""
    sid, sha = F.coalesce(F.col("doc_id").cast("long"), F.lit(NULL_ID)), F.sha2(normalized().cast("binary"), 256)
    found = exact_duplicates(docs).select(F.coalesce("doc_id", F.lit(NULL_ID)).alias("sid"), F.col("text_sha256").alias("sha"), "kept")
    keys = materialize(found.groupBy("sid", "sha").agg(F.max("kept").alias("some"), F.count("*").alias("rows")).where("not some or rows > 1"), "decided")
    gone, again = keys.where("not some").select("sid", "sha"), keys.where("some").select("sid", "sha")
    marked = docs.select(F.struct(*docs.columns).alias("row"), sid.alias("sid"), sha.alias("sha"))
    out = keyed_join(marked, gone, ["sid", "sha"], "left_anti", 96)
    if not again.isEmpty():
        once = keyed_join(out, again, ["sid", "sha"], "left_semi", 96).dropDuplicates(["sid", "sha"])
        out = keyed_join(out, again, ["sid", "sha"], "left_anti", 96).unionByName(once)
    return out.select("row.*")
