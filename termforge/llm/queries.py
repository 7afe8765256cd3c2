"""The operators' queries over the test tables, and SQL for those that SQL can express."""

from __future__ import annotations

from uuid import uuid4

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from termforge.llm import decontam, exact_dedup, language_id, lm_score, near_dedup, packing, pii, substring_dedup, token_rollup, url_filter
from termforge.llm.common import materialize, shared_dir


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_dedup.near_duplicates(_table(spark, sf_dir, "documents"))


def op2_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return url_filter.judge_urls(_table(spark, sf_dir, "pages"))


def op3_token_rollup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents come in, counted in words; those labelled toxic go; all that are left are counted anew in tokens of byte_bpe_50k."""
    docs, labels = _table(spark, sf_dir, "documents"), _table(spark, sf_dir, "labels")
    store = token_rollup.RollupStore(spark, f"{shared_dir(spark)}/rollup-{uuid4().hex}")
    toxic = labels.where("toxic = 1").select("doc_id").distinct()
    # Each text is counted once by each tokenizer; the batches join these small rows.
    first, second = (materialize(token_rollup.counted(docs, t), "token_counts") for t in ("words-1", token_rollup.BPE))
    batches = {
        "1-insert": token_rollup.signed(first, 1),
        "2-delete": token_rollup.signed(first.join(toxic, "doc_id", "left_semi"), -1),
        "3-revise": token_rollup.revision(first.join(toxic, "doc_id", "left_anti"), second.join(toxic, "doc_id", "left_anti")),
    }
    for name, rows in [*batches.items(), ("2-delete", batches["2-delete"])]:  # the last is a repeat and adds nothing
        store.commit(name, rows)
    totals = materialize(store.totals(), "totals")
    store.drop()
    return totals


def op4_repeated_passages(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = substring_dedup.repeated_passages(_table(spark, sf_dir, "documents"))
    return found.select("doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256")


def op5_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    return language_id.languages_of(_table(spark, sf_dir, "documents"))


def op6_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup.exact_duplicates(_table(spark, sf_dir, "documents"))


def op7_personal_data(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pii.personal_data(_table(spark, sf_dir, "documents"))


def op8_lm_score(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lm_score.score_documents(_table(spark, sf_dir, "documents"))


def op9_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = decontam.contamination(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "benchmark"))
    return found.select("doc_id", "n_words", "n_hit", "n_items", "items_sha256", "contaminated")


def op10_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack_documents(_table(spark, sf_dir, "documents"))


QUERIES = {f.__name__: f for f in (op1_near_dedup, op2_url_filter, op3_token_rollup, op4_repeated_passages, op5_language_id, op6_exact_dedup, op7_personal_data, op8_lm_score, op9_decontamination, op10_best_fit_packing)}

_KEPT = "[^\\x20\\x09-\\x0D]+"
_LOWERED = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
_ALNUM = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"


def _url_sql(rounds: int) -> str:
    fits = lambda rule: "(host = '{0}' OR ends_with(host, '.{0}')) AND starts_with(path, '/{1}')".format(*rule.split("/", 1))
    ranked = sorted(url_filter.RULES, key=lambda r: -len(r[1]))
    pick = lambda of: "CASE " + " ".join(f"WHEN {fits(r[1])} THEN '{r[of]}'" for r in ranked) + " END"
    host = lambda url: rf"translate(regexp_extract(coalesce({url}, ''), '(?s)^.*?://([^/?#]*)', 1), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
    href = url_filter.HREF.replace("'", "''")

    def walk(name, verdict, src, dst):
        step = f"{name}0 AS (SELECT host, n / (SELECT sum(n) FROM {name}s)::DOUBLE * (1 - 0.85::DOUBLE) AS seed, n / (SELECT sum(n) FROM {name}s)::DOUBLE * (1 - 0.85::DOUBLE) AS score FROM {name}s)"
        out = [f"{name}s AS (SELECT host, count(*) AS n FROM j WHERE host != '' AND verdict = '{verdict}' GROUP BY host)", f"{name}e AS (SELECT {src} AS src, {dst} AS dst, n / sum(n) OVER (PARTITION BY {src}) AS share FROM edges)", step]
        for k in range(rounds):
            out.append(f"{name}{k + 1} AS (SELECT host, coalesce(max(seed), 0.0::DOUBLE) AS seed, sum(part) AS score FROM (SELECT host, seed, seed AS part FROM {name}0 UNION ALL SELECT dst, NULL, 0.85::DOUBLE * score * share FROM {name}{k} JOIN {name}e ON src = host) GROUP BY host)")
        return ", ".join(out)

    return rf"""WITH h AS (SELECT page_id, html, {host("url")} AS host, regexp_extract(coalesce(url, ''), '(?s)^.*?://[^/?#]*([^?#]*)', 1) AS path FROM pages),
        j AS (SELECT page_id, host, path, {pick(1)} AS rule, {pick(0)} AS verdict FROM h),
        l AS (SELECT host AS src, unnest(regexp_extract_all(coalesce(html, ''), '{href}', 1)) AS t FROM h),
        m AS (SELECT src, {host("CASE WHEN starts_with(t, '//') THEN 'x:' || t ELSE t END")} AS dst FROM l WHERE contains(t, '//')),
        edges AS (SELECT src, dst, count(*) AS n FROM m WHERE src != '' AND dst != '' AND src != dst GROUP BY ALL),
        {walk("trust", "allow", "src", "dst")}, {walk("distrust", "block", "dst", "src")}
        SELECT page_id, host, path, rule, coalesce(verdict, CASE WHEN coalesce(b.score, 0) - coalesce(a.score, 0) > 0 THEN 'block' ELSE 'allow' END) AS verdict,
               coalesce(a.score, 0.0::DOUBLE) AS trust, coalesce(b.score, 0.0::DOUBLE) AS distrust FROM j LEFT JOIN trust{rounds} a USING (host) LEFT JOIN distrust{rounds} b USING (host)"""


ORACLE_SQL = {
    "op1_near_dedup": rf"""
        WITH RECURSIVE w AS (SELECT doc_id, regexp_extract_all({_LOWERED}, '{_KEPT}') AS w FROM documents),
             s AS (SELECT DISTINCT doc_id, array_to_string(w[i : i + 4], ' ') AS g
                   FROM (SELECT doc_id, w, unnest(range(1, greatest(len(w) - 4, 1) + 1)) AS i FROM w WHERE len(w) > 0)),
             n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
             p AS (SELECT x.doc_id AS a, y.doc_id AS b, count(*) AS shared FROM s x JOIN s y USING (g) WHERE x.doc_id <> y.doc_id GROUP BY ALL),
             e AS (SELECT a, b FROM p JOIN n na ON na.doc_id = a JOIN n nb ON nb.doc_id = b WHERE 100 * shared >= 75 * (na.n + nb.n - shared)),
             r AS (SELECT doc_id AS a, doc_id AS b FROM w UNION SELECT r.a, e.b FROM r JOIN e ON e.a = r.b),
             c AS (SELECT a AS doc_id, min(b) AS component_id FROM r GROUP BY a)
        SELECT c.doc_id, coalesce(n, 0) AS n_shingles, component_id, c.doc_id = component_id AS kept FROM c LEFT JOIN n USING (doc_id)""",
    # Windows of 50 bytes as hex digits, read from overlapping pieces of 1000 bytes.
    "op4_repeated_passages": r"""
        WITH d AS (SELECT doc_id, hex(encode(coalesce(text, ''))) AS h, strlen(coalesce(text, '')) AS n FROM documents),
             q AS (SELECT doc_id, k * 1000 AS o, substr(h, k * 2000 + 1, 2098) AS h FROM (SELECT doc_id, h, unnest(range(0, n // 1000 + 1)) AS k FROM d WHERE n >= 50)),
             s AS (SELECT doc_id, o + i AS i, substr(h, 2 * i + 1, 100) AS g FROM (SELECT doc_id, o, h, unnest(range(0, least(1000, len(h) // 2 - 49))) AS i FROM q)),
             f AS (SELECT g, min(doc_id) AS first FROM s GROUP BY g HAVING min(doc_id) < max(doc_id)),
             m AS (SELECT doc_id, i, i > 50 + lag(i) OVER (PARTITION BY doc_id ORDER BY i) AS new FROM s JOIN f USING (g) WHERE doc_id > first),
             t AS (SELECT doc_id, i, sum(CASE WHEN new THEN 1 ELSE 0 END) OVER (PARTITION BY doc_id ORDER BY i) AS run FROM m),
             u AS (SELECT doc_id, min(i) AS a, max(i) + 50 AS b FROM t GROUP BY doc_id, run),
             v AS (SELECT doc_id, a, b, lag(b, 1, 0) OVER (PARTITION BY doc_id ORDER BY a) AS z FROM u),
             x AS (SELECT doc_id, sum(b - a) AS gone, count(*) AS spans, max(b) AS last, string_agg(substr(h, 2 * z + 1, 2 * (a - z)), '' ORDER BY a) AS kept
                   FROM v JOIN d USING (doc_id) GROUP BY doc_id)
        SELECT doc_id, n AS n_bytes, CAST(coalesce(gone, 0) AS BIGINT) AS n_removed, coalesce(spans, 0) AS n_spans,
               sha256(unhex(coalesce(kept, '') || substr(h, 2 * coalesce(last, 0) + 1))) AS kept_sha256 FROM d LEFT JOIN x USING (doc_id)""",
    # The walks unrolled: as many rounds as the links of these pages need (there are none between hosts, so one would do).
    "op2_url_filter": _url_sql(12),
    "op9_decontamination": rf"""
        WITH d AS (SELECT doc_id, regexp_extract_all({_LOWERED}, '{_ALNUM}') AS w FROM documents),
             b AS (SELECT item_id, regexp_extract_all({_LOWERED}, '{_ALNUM}') AS w FROM benchmark),
             k AS (SELECT DISTINCT item_id, n, array_to_string(w[i : i + n - 1], ' ') AS g
                   FROM (SELECT item_id, w, least(len(w), 10) AS n, unnest(range(1, greatest(len(w) - 9, 1) + 1)) AS i FROM b WHERE len(w) > 0)),
             s AS (SELECT doc_id, n, i, array_to_string(w[i : i + n - 1], ' ') AS g
                   FROM (SELECT doc_id, w, n, unnest(range(1, len(w) - n + 2)) AS i FROM d, (SELECT DISTINCT n FROM k) WHERE len(w) >= n)),
             m AS (SELECT doc_id, item_id, i, s.n FROM s JOIN k USING (n, g)),
             h AS (SELECT doc_id, count(DISTINCT p) AS n_hit FROM (SELECT doc_id, unnest(range(i, i + n)) AS p FROM m) GROUP BY doc_id),
             t AS (SELECT doc_id, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS items
                   FROM (SELECT DISTINCT doc_id, CAST(item_id AS VARCHAR) AS item FROM m) GROUP BY doc_id)
        SELECT d.doc_id, len(w) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items, sha256(coalesce(items, '')) AS items_sha256,
               coalesce(n_hit, 0) > 0 AS contaminated FROM d LEFT JOIN h USING (doc_id) LEFT JOIN t USING (doc_id)""",
    "op6_exact_dedup": r"""
        WITH d AS (SELECT doc_id, regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', ' ', 'g') AS x FROM documents)
        SELECT doc_id, min(doc_id) OVER (PARTITION BY x) AS keep_id, count(*) OVER (PARTITION BY x) AS group_size,
               doc_id = min(doc_id) OVER (PARTITION BY x) AS kept, sha256(x) AS text_sha256 FROM d""",
}
