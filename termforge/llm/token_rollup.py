"""Token counts as delta-maintained rollups.

A store is a folder of committed batches. A batch holds signed rows: an insert adds a document's counts, a delete takes them
away, a revision does both with the old and the new counts. Each batch is summed by (source, lang, tokenizer) before it
is written, so the store grows with batches and keys, not documents, and totals are the sum of all deltas. A writer puts its rows in a
folder of its own; a mark, a file created only if there is none, names that folder and makes the batch count. So applying a
batch id again changes nothing, of two writers of one batch the first counts, and what failed halfway never counts.
``compact`` folds committed batches into a new base and drops what it replaces, once totals read before are consumed.

Null source or language is a key of its own; null text has no tokens. Repeated rows, and rows with equal counts, count each time. An
empty batch commits and adds nothing; keys whose documents all went stay out of the totals. Extra columns are not read. The tokenizer
takes a text whole: a long one has to fit in a worker with its ids (some 20 times its bytes for ``byte_bpe_50k``).
"""

from __future__ import annotations

from functools import partial
from uuid import uuid4

from py4j.protocol import Py4JJavaError
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from termforge.llm.common import bounded_batches
from termforge.llm.packing import encoder

KEYS = ("source", "lang", "tokenizer")
SUMS = ("n_docs", "n_tokens", "n_bytes")
#: Tokenizers that Spark's own functions can count.
PATTERNS = {
    "words-1": r"[^\x20\x09-\x0D]+",
    "wordpunct-1": r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+|[\x21-\x2F\x3A-\x40\x5B-\x60\x7B-\x7E]",
}
BPE = "byte_bpe_50k"


def _bpe_counts(batches, folder):
    import pyarrow as pa

    encode = encoder(folder)
    for batch in batches:
        n = [len(encode(t.as_py())) if t.is_valid else 0 for t in batch.column("text")]
        kept = [c for c in batch.schema.names if c != "text"]
        yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in kept), pa.array(n, pa.int64())], [*kept, "n_tokens"])


def counted(docs: DataFrame, tokenizer: str, tokenizers: str | None = None) -> DataFrame:
    """doc_id, source, lang, tokenizer, n_docs, n_tokens, n_bytes of each document; join on this, not on the texts."""
    docs = bounded_batches(docs)
    text = F.coalesce("text", F.lit(""))
    base = docs.select("doc_id", "source", "lang", F.lit(tokenizer).alias("tokenizer"), F.lit(1).cast("long").alias("n_docs"), F.octet_length(text).cast("long").alias("n_bytes"), text.alias("text"))
    if tokenizer in PATTERNS:
        return base.select("doc_id", *KEYS, "n_docs", F.regexp_count("text", F.lit(PATTERNS[tokenizer])).cast("long").alias("n_tokens"), "n_bytes")
    if tokenizer != BPE:
        raise ValueError(f"unknown tokenizer {tokenizer}")
    kind = "doc_id long, source string, lang string, tokenizer string, n_docs long, n_bytes long, n_tokens long"
    return base.mapInArrow(partial(_bpe_counts, folder=tokenizers), kind).select("doc_id", *KEYS, *SUMS)


def signed(rows: DataFrame, sign: int) -> DataFrame:
    return rows.select(*KEYS, *((F.col(c) * sign).alias(c) for c in SUMS))


def revision(old: DataFrame, new: DataFrame) -> DataFrame:
    """Signed rows that replace ``old`` counts by ``new`` ones."""
    return signed(old, -1).unionByName(signed(new, 1))


class RollupStore:
    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path.rstrip("/")
        self._fs = spark._jvm.org.apache.hadoop.fs.Path(self.path).getFileSystem(spark._jsc.hadoopConfiguration())

    def _at(self, *parts: str):
        return self.spark._jvm.org.apache.hadoop.fs.Path("/".join([self.path, *parts]))

    def _committed(self, folder: str) -> dict[str, str]:
        if not self._fs.exists(self._at(folder)):
            return {}
        names = [s.getPath().getName() for s in self._fs.listStatus(self._at(folder))]
        return {n.removesuffix(".mark"): f"{self.path}/{folder}/{self._read(folder, n)}" for n in sorted(names) if n.endswith(".mark")}

    def _read(self, *parts: str) -> str:
        stream = self._fs.open(self._at(*parts))
        try:
            return stream.readUTF()
        finally:
            stream.close()

    def _mark(self, folder: str, name: str, own: str) -> bool:
        """Make ``name`` count with the rows in ``own``; False if another writer was first."""
        try:
            # written aside and renamed, which fails where the mark exists, so no mark is ever seen half written
            aside = self._at(folder, f"{own}.new")
            stream = self._fs.create(aside, False)
            stream.writeUTF(own)
            stream.close()
            if self._fs.exists(self._at(folder, f"{name}.mark")) or not self._fs.rename(aside, self._at(folder, f"{name}.mark")):
                self._fs.delete(aside, False)
                return False
            return self._read(folder, f"{name}.mark") == own
        except Py4JJavaError:
            return False

    def batches(self) -> set[str]:
        folded, deltas = self._state()
        return folded | deltas.keys()

    def _state(self) -> tuple[set[str], dict[str, str]]:
        bases = self._committed("base")
        folded: set[str] = set()
        if bases:
            last = bases[max(bases)]
            folded = {r.batch for r in self.spark.read.parquet(f"{last}/batches").collect()}
        return folded, {n: p for n, p in self._committed("delta").items() if n not in folded}

    def commit(self, batch: str, rows: DataFrame) -> bool:
        """Add a batch of signed rows; False if it was committed before."""
        if batch in self.batches():
            return False
        delta = rows.groupBy(*KEYS).agg(*(F.sum(c).alias(c) for c in SUMS))
        own = f"rows-{uuid4().hex}"
        delta.write.parquet(f"{self.path}/delta/{own}")
        if self._mark("delta", batch, own):
            return True
        self._fs.delete(self._at("delta", own), True)
        return False

    def totals(self) -> DataFrame:
        kind = ", ".join([*(f"{k} string" for k in KEYS), *(f"{c} long" for c in SUMS)])
        _, deltas = self._state()
        bases = self._committed("base")
        paths = [*deltas.values(), *([f"{bases[max(bases)]}/totals"] if bases else [])]
        rows = self.spark.read.schema(kind).parquet(*paths) if paths else self.spark.createDataFrame([], kind)
        return rows.groupBy(*KEYS).agg(*(F.sum(c).alias(c) for c in SUMS)).where(" or ".join(f"{c} != 0" for c in SUMS))

    def compact(self) -> None:
        """Fold all committed batches into a new base, which counts once its own mark is written; then drop the folded deltas."""
        folded, deltas = self._state()
        if not deltas:
            return
        bases = self._committed("base")
        name, own = f"{int(max(bases, default='0')) + 1:08d}", f"rows-{uuid4().hex}"
        self.totals().write.parquet(f"{self.path}/base/{own}/totals")
        ids = self.spark.createDataFrame([(b,) for b in sorted(folded | deltas.keys())], "batch string")
        ids.coalesce(1).write.parquet(f"{self.path}/base/{own}/batches")
        if not self._mark("base", name, own):
            self._fs.delete(self._at("base", own), True)
            return
        for folder, old in (("delta", deltas), ("base", bases)):
            for key, path in old.items():
                self._fs.delete(self._at(folder, f"{key}.mark"), False)
                self._fs.delete(self._at(folder, path.rsplit("/", 1)[1]), True)

    def drop(self) -> None:
        """Delete the store."""
        self._fs.delete(self._at(), True)
