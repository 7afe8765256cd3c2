"""Personal data and the terms that give it away: information-theoretic sanitisation.

Fixed patterns find emails, addresses, cards and phones; a further pattern finds secrets (a value assigned to a password, key or
token). Each distinct value found is a protected entity. Terms are the words of the documents that hold an entity, wherever they
stand. Over the whole corpus, by documents, IC(entity) = -log p(entity) is all there is to know of an entity, and PMI(entity; term)
= log(p(entity | term) / p(entity)) is what a term tells of it. p(entity | term) is smoothed by PRIOR documents in which term and entity meet by
chance: (both + PRIOR * p(entity)) / (with term + PRIOR). So one meeting in one document counts, and counts less than
several. A term with PMI >= DISCLOSURE * IC discloses the entity: all its occurrences in the documents that hold the entity are
marked. In other documents, which have no entity to protect from it, it stays. ``sanitized`` replaces marked spans by their
kind (terms are generalised to ``<TERM>``, or removed).

Scale. Which terms an entity can have is bounded by its documents: for PMI to reach the threshold a term must be in few
others, so for a rare entity only rare words are looked at. Entities in the same documents share all figures, and so do terms; pairs are made of
such classes, not of words, so a document with a thousand values and a thousand words found nowhere else makes one pair. Terms'
document counts are combined by task, dealt to parts by hash and summed; only terms beside an entity leave their part. Hot
entities and terms meet their figures by broadcast. Offsets are code points, ends exclusive.

Memory: a task holds one Arrow batch and the distinct terms of FLUSH_BYTES of text, or of one longer text.

Null text is empty and has no spans. Rows without doc_id, repeated rows and rows sharing a doc_id are judged each by
itself. An entity that all documents hold has nothing to disclose. An empty table gives an empty result. Extra columns are not read.
"""

from __future__ import annotations

from functools import partial

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from termforge.llm.common import WHITE, bounded_batches, chunks, hot_join, materialize, partitions, span_hashes, word_spans
from termforge.llm.substring_dedup import _by_part, merge_spans

KINDS = ("email", "ip", "card", "phone", "secret", "term")
BASE = KINDS[:4]
PRIOR, DISCLOSURE = 1.0, 0.9
#: Text whose terms a task combines before it sends them on; text for each part.
FLUSH_BYTES, PART_BYTES = 8 << 20, 256 << 20
# The patterns of the contract; the look-behinds and possessive parts only skip starts that cannot match.
EMAIL = r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+"
IP = r"(?<![0-9])[0-9]++(\.[0-9]++)(\.[0-9]++)(\.[0-9]++)"
CARD = r"[0-9]([\x20-]?[0-9])+"
PHONE = r"\+[0-9][\x20().0-9-]+[0-9]"
#: A name, a sign, and a value of 6 characters or more with a digit in it; the value is the span.
SECRET = r"(?i:password|passwd|pwd|secret|token|credential|(?:api|access|private|secret|auth)[_-]?key)[\"']?\x20?[=:]\x20?[\"']?((?=[^\s\"',;]*[0-9])[^\s\"',;]{6,})"


def luhn(digits: str) -> bool:
    total = 0
    for i, c in enumerate(reversed(digits)):
        d = ord(c) - 48
        if i % 2:
            d = d * 2 - 9 * (d > 4)
        total += d
    return total % 10 == 0


def finder():
    """text -> the base spans (kind, start, end), by kind, then start."""
    import re

    local = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
    email, ip, card, phone, some = re.compile(EMAIL), re.compile(IP), re.compile(CARD), re.compile(PHONE), re.compile(r"[0-9]")

    def emails(text: str):
        end, at = 0, text.find("@")
        while at >= 0:
            # the leftmost start is that of the run of local characters before the sign
            start = at
            while start > end and text[start - 1] in local:
                start -= 1
            m = email.match(text, start) if start < at else None
            if m:
                yield "email", start, m.end()
                end = m.end()
            at = text.find("@", max(at + 1, end))

    def find(text: str) -> list[tuple[str, int, int]]:
        spans = list(emails(text))
        if not some.search(text):
            return spans
        spans += [("ip", *m.span()) for m in ip.finditer(text) if all(len(p.lstrip("0")) < 4 and int(p.lstrip("0") or 0) < 256 for p in m[0].split("."))]
        for m in card.finditer(text):
            if m.end() - m.start() >= 16:
                digits = m[0].replace(" ", "").replace("-", "")
                if 16 <= len(digits) <= 19 and luhn(digits):
                    spans.append(("card", *m.span()))
        if "+" in text:
            spans += [("phone", *m.span()) for m in phone.finditer(text) if 8 <= sum("0" <= c <= "9" for c in m[0]) <= 15]
        return spans

    return find


def spans_text(spans) -> str:
    return ",".join(f"{k}:{a}:{b}" for k, a, b in spans)


def secrets():
    """text -> the spans of secret values."""
    import re

    secret = re.compile(SECRET)
    return lambda text: [("secret", *m.span(1)) for m in secret.finditer(text)] if "=" in text or ":" in text else []


LOWER = {i: i + 32 for i in range(65, 91)}
EDGES = "\"'()[]{}<>,.;:!?"


def term_hashes(terms: list[str]) -> list[int]:
    import pyarrow as pa

    out = []
    for _, data, at in chunks(pa.array(terms, pa.string())):
        out += span_hashes(data, at[:-1], at[1:]).view("int64").tolist()
    return out


def terms_of(text: str, spans) -> list[tuple[str, int, int]]:
    """The words of a text, lower case and without outer punctuation, with their place; those that overlap a span are left out."""
    import re

    import numpy as np

    taken = merge_spans(np.array([(a, b) for _, a, b in spans], np.int64).reshape(-1, 2))
    words = []
    for m in re.finditer(r"[^\x20\x09-\x0D]+", text):
        word = m[0].lstrip(EDGES)
        a, word = m.end() - len(word), word.rstrip(EDGES)
        if word:
            words.append((word.translate(LOWER), a, a + len(word)))
    if not len(taken) or not words:
        return words
    a, b = np.array([(a, b) for _, a, b in words]).T
    free = np.searchsorted(taken[:, 1], a, "right") >= np.searchsorted(taken[:, 0], b)
    return [w for w, ok in zip(words, free.tolist(), strict=True) if ok]


def term_counts(column):
    """(row, hashes of its distinct terms) of consecutive rows of texts, as two arrays: outer punctuation is left off the words."""
    import numpy as np

    trim = np.zeros(256, bool)
    trim[list(EDGES.encode())] = True
    for row, data, at in chunks(column):
        starts, ends, before = word_spans(data, at, ~WHITE)
        doc = np.repeat(np.arange(len(at) - 1), np.diff(before))
        while True:  # as many rounds as a word has outer punctuation
            cut = (starts < ends) & trim[data[np.minimum(starts, len(data) - 1)]]
            if not cut.any():
                break
            starts = starts + cut
        while True:
            cut = (starts < ends) & trim[data[np.maximum(ends - 1, 0)]]
            if not cut.any():
                break
            ends = ends - cut
        some = starts < ends
        h, doc = span_hashes(data, starts[some], ends[some]), doc[some]
        order = np.lexsort((h, doc))
        h, doc = h[order], doc[order]
        new = np.concatenate(([True], (h[1:] != h[:-1]) | (doc[1:] != doc[:-1]))) if len(h) else np.zeros(0, bool)
        yield len(data), doc[new] + row, h[new]


GATHERED = "part int, x binary, y binary, rid long, doc_id long, n_email long, n_ip long, n_card long, n_phone long, n_secret long, base_sha256 string, base string, added string, entities array<long>, term long, places binary"


def _gather(batches, parts):
    """A row for each document with its spans and entities; one for each term of a document with entities; counts of all terms for the parts."""
    import hashlib

    import numpy as np
    import pyarrow as pa

    find, more = finder(), secrets()
    h64 = lambda s: int.from_bytes(hashlib.blake2b(s.encode(), digest_size=8).digest(), "little", signed=True)
    kinds = {"int": pa.int32(), "long": pa.int64(), "binary": pa.binary(), "string": pa.string(), "array<long>": pa.list_(pa.int64())}
    schema = pa.schema([(c.split()[0], kinds[c.split()[1]]) for c in GATHERED.split(", ")])
    frame = lambda n, **cols: pa.RecordBatch.from_arrays([pa.array(cols[f.name], f.type) if f.name in cols else pa.nulls(n, f.type) for f in schema], schema=schema)
    held, beside, size = [], [], 0

    def flush():
        term, n = np.unique(np.concatenate(held), return_counts=True)
        wanted = np.isin(term, np.array(beside, np.int64).view(np.uint64))
        sent = _by_part((term % np.uint64(parts)).astype(np.int64), 0, [None, term, n * 2 + wanted, None])
        yield frame(sent.num_rows, **{c: sent.column(c).to_pylist() for c in ("part", "x", "y")})

    for batch in batches:
        out = {c: [] for c in ("rid", "doc_id", *(f"n_{k}" for k in KINDS[:5]), "base_sha256", "base", "added", "entities")}
        near = {"rid": [], "term": [], "places": []}
        ids, rids = batch.column("doc_id").to_pylist(), batch.column("rid").to_pylist()
        for i, text in enumerate(batch.column("text")):
            text = text.as_py() or ""
            base, secret = find(text), more(text)
            spans = base + secret
            joined = spans_text(base)
            for k in KINDS[:5]:
                out[f"n_{k}"].append(sum(s[0] == k for s in spans))
            out["rid"].append(rids[i])
            out["doc_id"].append(ids[i])
            out["base_sha256"].append(hashlib.sha256(joined.encode()).hexdigest())
            out["base"].append(joined)
            out["added"].append(spans_text(secret))
            out["entities"].append(sorted({h64(f"{k}:{text[a:b].lower()}") for k, a, b in spans}))
            if spans:
                places: dict[str, list[int]] = {}
                for word, a, b in terms_of(text, spans):
                    places.setdefault(word, []).extend((a, b))
                hashes = term_hashes(list(places))
                beside += hashes
                near["rid"] += [rids[i]] * len(hashes)
                near["term"] += hashes
                near["places"] += [np.array(p, "<i4").tobytes() for p in places.values()]
        yield frame(batch.num_rows, **out)
        if near["rid"]:
            yield frame(len(near["rid"]), **near)
        for n, _, h in term_counts(batch.column("text")):
            held.append(h)
            size += n
            if size >= FLUSH_BYTES:
                yield from flush()
                held, beside, size = [], [], 0
    if held:
        yield from flush()


def _documents_with(batches):
    """(term, df) of the parts' terms that stand beside an entity somewhere."""
    import numpy as np
    import pyarrow as pa

    x, y = [], []
    for batch in batches:
        x += [np.frombuffer(b.as_py(), np.int64) for b in batch.column("x")]
        y += [np.frombuffer(b.as_py(), np.int64) for b in batch.column("y")]
    if x:
        y = np.concatenate(y)
        term, back = np.unique(np.concatenate(x), return_inverse=True)
        df = np.bincount(back, y >> 1, len(term)).astype(np.int64)
        wanted = np.bincount(back, y & 1, len(term)) > 0
        yield pa.RecordBatch.from_arrays([pa.array(term[wanted]), pa.array(df[wanted])], ["term", "df"])


def personal_data(docs: DataFrame, prior: float = PRIOR, disclosure: float = DISCLOSURE) -> DataFrame:
    """doc_id, n_email, n_ip, n_card, n_phone, base_sha256, spans (``kind:start:end`` joined), then n_secret, n_term and n_spans."""
    return _spans(_numbered(docs), prior, disclosure).drop("rid")


def _numbered(docs: DataFrame) -> DataFrame:
    return bounded_batches(docs).select("doc_id", "text", F.monotonically_increasing_id().alias("rid"))


def _spans(numbered: DataFrame, prior: float, disclosure: float) -> DataFrame:
    """The result with each row's number."""
    spark = numbered.sparkSession
    size = numbered.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    parts = partitions(spark, size, PART_BYTES)
    found = materialize(numbered.mapInArrow(partial(_gather, parts=parts), GATHERED), "gathered")
    base = found.where("base is not null").drop("part", "x", "y", "term", "places")
    near = found.where("term is not null").select("rid", "term", "places")
    total, held, beside = found.agg(F.count("base"), F.coalesce(F.sum(F.size(F.coalesce("entities", F.array()))), F.lit(0)), F.count("term")).first()
    n = F.lit(float(max(total, 1)))
    result = lambda terms: base.join(terms, "rid", "left") if terms is not None else base.withColumn("terms", F.lit(None).cast("array<struct<a:int,b:int>>"))
    marked = None
    if held:
        # Entities: their documents, the most documents a term may be in to disclose them, and what tells their sets of documents apart.
        sets = (F.count("*").alias("docs"), F.bit_xor(F.xxhash64("rid")).alias("s1"), F.bit_xor(F.xxhash64("rid", F.lit(1))).alias("s2"))
        holds = base.where("size(entities) > 0").select("rid", F.explode("entities").alias("entity"))
        entities = holds.groupBy("entity").agg(*sets)
        # p(entity | term) that makes PMI reach the threshold
        entities = entities.where(F.col("docs") < n).withColumn("least", F.pow(F.col("docs") / n, F.lit(1 - disclosure)))
        most = F.floor((F.col("docs") + prior * F.col("docs") / n) / F.col("least") - prior + 1e-9)
        entities = materialize(entities.select("entity", "docs", F.xxhash64("docs", "s1", "s2").alias("ec"), "least", most.alias("most")), "entities")
        holds = materialize(hot_join(holds, entities.withColumn("times", F.col("docs")), "entity", "times", held).select("rid", "ec", "docs", "least", "most").distinct(), "holds")
        # Terms that are rare enough for one of their document's entities.
        dealt = found.where("x is not null").select("part", "x", "y").repartitionById(parts, "part")
        counts = dealt.select("x", "y").mapInArrow(_documents_with, "term long, df long")
        counts = materialize(counts.join(near.groupBy("term").agg(F.count("*").alias("times")), "term"), "terms")
        bound = holds.groupBy("rid").agg(F.max("most").alias("upto"))
        near_counted = hot_join(near.select("rid", "term"), counts, "term", "times", beside)
        rare = materialize(near_counted.join(bound, "rid").where("df <= upto").select("rid", "term", "df"), "rare")
        classes = rare.groupBy("term").agg(*sets, F.first("df").alias("df")).select("term", F.col("docs").alias("times"), F.xxhash64("df", "docs", "s1", "s2").alias("tc"))
        rare = materialize(hot_join(rare, classes, "term", "times", rare.count()), "classed")
        met = holds.join(rare.select("rid", "tc", "df").distinct(), "rid").where("df <= most")
        told = materialize(met.groupBy("ec", "tc").agg(F.count("*").alias("both"), F.first("docs").alias("docs"), F.first("df").alias("df"), F.first("least").alias("least")), "met")
        all_met = told.agg(F.coalesce(F.sum("both"), F.lit(0))).first()[0]
        chance = (F.col("both") + prior * F.col("docs") / n) / (F.greatest("df", "both") + prior)
        told = materialize(told.where(chance >= F.col("least") - 1e-12).select("ec", "tc", "both"), "disclosed")
        hit = hot_join(met.select("rid", "ec", "tc"), told, ["ec", "tc"], "both", all_met).select("rid", "tc").distinct()
        places = rare.join(hit, ["rid", "tc"]).select("rid", "term").join(near, ["rid", "term"]).select("rid", "places")
        marked = places.groupBy("rid").agg(F.collect_list("places").alias("places")).mapInArrow(_pairs, "rid long, terms array<struct<a:int,b:int>>")
    terms_text = F.array_join(F.transform("terms", lambda x: F.concat_ws(":", F.lit("term"), x["a"], x["b"])), ",")
    spans = F.concat_ws(",", *(F.when(F.col(c) != "", F.col(c)) for c in ("base", "added")), F.when(F.size("terms") > 0, terms_text))
    n_term = F.size(F.coalesce("terms", F.array())).cast("long")
    counted = sum((F.col(f"n_{k}") for k in KINDS[:5]), n_term)
    out = result(marked).select("rid", "doc_id", *(f"n_{k}" for k in BASE), "base_sha256", spans.alias("spans"), "n_secret", n_term.alias("n_term"), counted.alias("n_spans"))
    return out


def _pairs(batches):
    """The places of a document's marked terms, in order."""
    import numpy as np
    import pyarrow as pa

    kind = pa.list_(pa.struct([("a", pa.int32()), ("b", pa.int32())]))
    for batch in batches:
        rows = []
        for own in batch.column("places").to_pylist():
            pairs = np.frombuffer(b"".join(own), "<i4").reshape(-1, 2)
            rows.append([{"a": a, "b": b} for a, b in pairs[np.lexsort((pairs[:, 1], pairs[:, 0]))].tolist()])
        yield pa.RecordBatch.from_arrays([batch.column("rid"), pa.array(rows, kind)], ["rid", "terms"])


def sanitize_text(text: str | None, spans: str | None, generalise: bool = True) -> str | None:
    """``text`` with each span replaced by its kind; terms are removed instead if not ``generalise``. Overlaps are merged."""
    if not text or not spans:
        return text
    cuts = sorted((int(a), int(b), k) for k, a, b in (s.split(":") for s in spans.split(",")))
    out, end = [], 0
    for a, b, k in cuts:
        if a >= end:
            out += [text[end:a], "" if k == "term" and not generalise else f"<{k.upper()}>"]
        end = max(end, b)
    return "".join([*out, text[end:]])


def _sanitize(batches, generalise):
    import pyarrow as pa

    for batch in batches:
        out = [sanitize_text(t, s, generalise) for t, s in zip(batch.column("text").to_pylist(), batch.column("spans").to_pylist(), strict=True)]
        yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(out, pa.string())], ["doc_id", "text"])


def sanitized(docs: DataFrame, generalise: bool = True, prior: float = PRIOR, disclosure: float = DISCLOSURE) -> DataFrame:
    """doc_id and the text of every row, its spans generalised. Repeated rows and rows without doc_id come back each with its own text."""
    numbered = materialize(_numbered(docs), "rows")  # the rows are read twice and must keep their numbers
    some = _spans(numbered, prior, disclosure).where("n_spans > 0").select("rid", "spans")
    return numbered.join(some, "rid", "left").mapInArrow(partial(_sanitize, generalise=generalise), "doc_id long, text string")
