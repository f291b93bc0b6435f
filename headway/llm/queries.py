"""The queries of this subpackage, and the SQL of those that SQL can express."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from . import bpe, language, licenses, mixing, near_dup, pii, quality, token_counts, topk, warc
from .common import table

BYTE_BPE = public_tokenizers.path("byte_bpe_50k.json")
WORD_BPE = public_tokenizers.path("word_bpe_49k.json")


def op1_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    ids = bpe.encode(docs, BYTE_BPE, keep_text=False, decoded="decoded")
    joined = F.array_join(F.col("ids").cast("array<string>"), ",")
    digest = lambda text: F.sha2(F.encode(text, "UTF-8"), 256)
    return ids.select("doc_id", F.size("ids").cast("long").alias("n_tokens"), digest(joined).alias("ids_sha256"), digest(F.col("decoded")).alias("decoded_sha256"))


def op2_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    counted = token_counts.count_tokens(docs, WORD_BPE)
    n_bytes = F.coalesce(F.octet_length("text"), F.lit(0)).cast("long")
    return counted.select("doc_id", n_bytes.alias("n_bytes"), "n_tokens", (F.col("n_tokens") > 2048).alias("over_limit"))


def op3_near_dup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_dup.near_duplicates(table(spark, sf_dir, "documents"), near_dup.NearDup(words=2, percent=80))


OP3_SQL = r"""
WITH RECURSIVE w AS (
  SELECT doc_id, list_filter(string_split_regex(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[\x20\x09-\x0D]+'), lambda x: x <> '') AS ws FROM documents
), s AS (
  SELECT doc_id, CASE WHEN len(ws) < 2 THEN ws ELSE list_distinct(list_transform(range(1, len(ws)), lambda i: ws[i] || ' ' || ws[i + 1])) END AS sh FROM w
), n AS (SELECT doc_id, len(sh) AS n FROM s
), e AS (SELECT doc_id, unnest(sh) AS x FROM s
), p AS (SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS k FROM e a JOIN e b ON a.x = b.x AND a.doc_id < b.doc_id GROUP BY 1, 2
), l AS (SELECT a, b FROM p JOIN n na ON na.doc_id = a JOIN n nb ON nb.doc_id = b WHERE 100 * k >= 80 * (na.n + nb.n - k)
), u AS (SELECT a, b FROM l UNION ALL SELECT b, a FROM l
), r(node, root) AS (
  SELECT doc_id, doc_id FROM n
  UNION
  SELECT u.b, r.root FROM r JOIN u ON u.a = r.node
), c AS (SELECT node, min(root) AS component_id FROM r GROUP BY node)
SELECT doc_id, CAST(n AS BIGINT) AS n_shingles, component_id, doc_id = component_id AS kept FROM n JOIN c ON node = doc_id
"""


def op4_licenses(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = licenses.scan(table(spark, sf_dir, "documents").select("doc_id", "text"))
    named = F.transform("licenses", lambda x: F.concat_ws(":", x["license"], x["rule"]))
    return found.select("doc_id", F.size("license_sentences").alias("n_known"), F.array_join("license_sentences", ",").alias("sentences"), F.array_join(named, ",").alias("licenses"))


def op5_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "source")
    return mixing.mix(docs).select("doc_id", "source", "mix.*")


#: The schedule slot by slot: of the sources whose next block is released, the one of the earliest deadline. Weights are doubles of at least 1, so 2**52 times them is exact.
OP5_SQL = """
WITH RECURSIVE n AS (
  SELECT source, count(*) AS n, CAST(pow(count(*), 0.7) * 4503599627370496 AS HUGEINT) AS w, row_number() OVER (ORDER BY source NULLS FIRST) AS s FROM documents GROUP BY source
), a AS (SELECT list(w ORDER BY s) AS w, sum(w)::HUGEINT AS total, list((n + 63) // 64 ORDER BY s) AS need FROM n
), t(slot, s, turn, had) AS (
  SELECT -1, 0, CAST(0 AS BIGINT), list_transform(w, lambda x: CAST(0 AS BIGINT)) FROM a
  UNION ALL
  SELECT slot + 1, pick, had[pick], list_transform(had, lambda x, i: CASE WHEN i = pick THEN x + 1 ELSE x END)
  FROM (
    SELECT slot, had, list_sort(list_filter(list_transform(had, lambda x, i: CASE WHEN x::HUGEINT * total // w[i] <= slot + 1 THEN {'due': ((x + 1)::HUGEINT * total + w[i] - 1) // w[i], 'i': i} END), lambda x: x IS NOT NULL))[1].i AS pick
    FROM t, a WHERE len(list_filter(list_transform(had, lambda x, i: x < need[i]), lambda x: x)) > 0
  )
), turns AS (SELECT s, max(turn) + 1 AS turns FROM t WHERE slot >= 0 GROUP BY s
), r AS (
  SELECT doc_id, d.source, n.n, n.s, row_number() OVER (PARTITION BY d.source ORDER BY CAST('0x' || substr(md5(CAST(doc_id AS VARCHAR)), 1, 15) AS BIGINT), doc_id) - 1 AS rank FROM documents d JOIN n ON d.source IS NOT DISTINCT FROM n.source
), e AS (
  SELECT doc_id, source, r.s, rank, rank // 64 AS block, n, unnest(range(0, ((turns - rank // 64) * 64 - 1) // n + 1)) AS epoch FROM r JOIN turns ON turns.s = r.s
)
SELECT doc_id, source, CAST(block AS BIGINT) AS block, CAST(epoch AS BIGINT) AS epoch, CAST(slot AS BIGINT) AS slot, CAST(rank % 64 AS INTEGER) AS place
FROM e JOIN t ON t.slot >= 0 AND t.s = e.s AND t.turn = block + epoch * n // 64
"""


def op6_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    held_out = F.coalesce(F.crc32(F.col("doc_id").cast("string").cast("binary")) % 4 == 2, F.lit(False))
    model = language.train(docs.where(~held_out))
    return language.identify(docs.select("doc_id", "text"), model, keep_text=False).select("doc_id", held_out.alias("held_out"), "language.*")


def op7_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = table(spark, sf_dir, "pages")
    index, _ = warc.archive(pages)
    keys = pages.select(warc.index_key(F.col("url"), F.col("page_id")).alias("key"))
    return warc.lookup(keys, index).drop("payload")


OP7_SQL = """
WITH p AS (
  SELECT page_id, strlen(coalesce(html, '')) AS n, sha1(coalesce(html, '')) AS x FROM pages
), d AS (
  SELECT page_id, n, list_reduce(list_transform(range(0, 32), lambda i: substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567', CAST(1 + (list_sum(list_transform(range(0, 5),
    lambda k: CAST(strpos('0123456789abcdef', substr(x, CAST(1 + (i // 4) * 5 + k AS BIGINT), 1)) - 1 AS BIGINT) * CAST(pow(16, 4 - k) AS BIGINT))) // CAST(pow(32, 3 - i % 4) AS BIGINT)) % 32 AS BIGINT), 1)),
    lambda a, b: a || b) AS payload_digest
  FROM p
), f AS (
  SELECT *, min(page_id) OVER (PARTITION BY payload_digest, n) AS first FROM d
)
SELECT page_id, CAST(n AS BIGINT) AS payload_bytes, payload_digest, CASE WHEN page_id = first THEN 'response' ELSE 'revisit' END AS record_type,
  CASE WHEN page_id <> first THEN first END AS refers_to
FROM f
"""


def op8_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    model = quality.train(docs, table(spark, sf_dir, "labels"))
    return quality.apply_rules(docs, model, keep_text=False).select("doc_id", "quality_verdict.*")


def quality_base_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The base of op8 alone."""
    return op8_quality(spark, sf_dir).select("doc_id", *quality.COUNTS, "base_failed")


QUALITY_SQL = r"""
WITH w AS (
  SELECT doc_id, coalesce(text, '') AS text, list_filter(string_split_regex(coalesce(text, ''), '[\x20\x09-\x0D]+'), lambda x: x <> '') AS ws,
    list_filter(string_split(coalesce(text, ''), chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) AS ls
  FROM documents
), x AS (SELECT doc_id, list_transform(range(1, len(ws) - 1), lambda i: ws[i] || ' ' || ws[i + 1] || ' ' || ws[i + 2]) AS wins FROM w WHERE len(ws) > 2
), y AS (SELECT doc_id, unnest(wins) AS win, generate_subscripts(wins, 1) AS i FROM x
), z AS (SELECT doc_id, i, count(*) OVER (PARTITION BY doc_id, win) AS c FROM y
), r AS (SELECT doc_id, count(DISTINCT p) AS n FROM (SELECT doc_id, unnest([i, i + 1, i + 2]) AS p FROM z WHERE c > 1) GROUP BY doc_id
), c AS (
  SELECT w.doc_id, CAST(len(ws) AS BIGINT) AS n_words, CAST(length(coalesce(array_to_string(ws, ''), '')) AS BIGINT) AS word_chars, CAST(length(regexp_replace(text, '[^#*$%&|<>]', '', 'g')) AS BIGINT) AS n_symbols,
    CAST(len(ls) - len(list_distinct(ls)) AS BIGINT) AS n_dup_lines, CAST(coalesce(n, 0) AS BIGINT) AS n_repeat_words
  FROM w LEFT JOIN r ON r.doc_id = w.doc_id
)
SELECT *, n_words < 50 OR 100 * n_repeat_words > 50 * n_words AS base_failed FROM c
"""


def _equals(value: str) -> Callable[[Column], Column]:
    return lambda x: x == value


def op9_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = pii.find(table(spark, sf_dir, "documents").select("doc_id", "text"))
    kinds = F.transform("pii_base", lambda s: s["kind"])
    counts = [F.size(F.filter(kinds, _equals(k))).cast("long").alias(f"n_{k}") for k in pii.KINDS[:4]]
    digest = F.sha2(F.encode(pii.joined(F.col("pii_base")), "UTF-8"), 256)
    return found.select("doc_id", *counts, digest.alias("base_sha256"), pii.joined(F.col("pii")).alias("spans"))


def pii_base_spans(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The base of op9 alone."""
    return op9_pii(spark, sf_dir).drop("spans")


def _base_sql() -> str:
    """The contract's patterns, by RE2; a match starts after all pieces and matches before it."""
    kinds = {
        "email": (r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", "true"),
        "ip": (r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", "len(list_filter(string_split(v, '.'), lambda x: CASE WHEN length(ltrim(x, '0')) > 3 THEN true ELSE CAST('0' || ltrim(x, '0') AS INTEGER) > 255 END)) = 0"),
        "card": (
            r"[0-9]([\x20-]?[0-9])+",
            "length(d) BETWEEN 12 AND 19 AND list_sum(list_transform(string_split(reverse(d), ''), lambda x, i: CASE WHEN i % 2 = 1 THEN CAST(x AS INTEGER) WHEN CAST(x AS INTEGER) > 4 THEN CAST(x AS INTEGER) * 2 - 9 ELSE CAST(x AS INTEGER) * 2 END)) % 10 = 0",
        ),
        "phone": (r"\+[0-9][\x20().0-9-]+[0-9]", "length(d) BETWEEN 9 AND 15"),
    }
    parts = [
        f"""SELECT doc_id, {n} AS o, '{kind}' AS kind, a AS start, a + length(v) AS stop FROM (
  SELECT doc_id, v, regexp_replace(v, '[^0-9]', '', 'g') AS d, sum(length(g) + length(v)) OVER (PARTITION BY doc_id ORDER BY i) - length(v) AS a FROM (
    SELECT doc_id, unnest(f) AS v, unnest(g[1:len(f)]) AS g, generate_subscripts(f, 1) AS i FROM (
      SELECT doc_id, regexp_extract_all(text, '{pattern}') AS f, string_split_regex(text, '{pattern}') AS g FROM documents WHERE text IS NOT NULL))) WHERE {test}"""
        for n, (kind, (pattern, test)) in enumerate(kinds.items())
    ]
    counts = ", ".join(f"CAST(count(*) FILTER (kind = '{k}') AS BIGINT) AS n_{k}" for k in kinds)
    return f"""
WITH s AS ({" UNION ALL ".join(parts)}
), b AS (SELECT doc_id, {counts}, string_agg(kind || ':' || start || ':' || stop, ',' ORDER BY start, o) AS spans FROM s GROUP BY doc_id)
SELECT d.doc_id, {", ".join(f"coalesce(n_{k}, 0) AS n_{k}" for k in kinds)}, sha256(coalesce(spans, '')) AS base_sha256 FROM documents d LEFT JOIN b ON b.doc_id = d.doc_id
"""


def op10_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    return topk.top_k(table(spark, sf_dir, "embeddings").select("vec_id", "embedding"))


OP10_SQL = """
WITH v AS (
  SELECT vec_id, list_transform(embedding, lambda x: floor(1024 * CAST(x AS DOUBLE))) AS e
  FROM embeddings
  WHERE vec_id IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), s AS (
  SELECT q.vec_id AS query_id, c.vec_id, CAST(list_dot_product(q.e, c.e) AS BIGINT) AS score
  FROM v q JOIN v c ON q.vec_id % 100 = 0 AND c.vec_id <> q.vec_id AND len(q.e) = len(c.e)
), r AS (
  SELECT *, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS INTEGER) AS rank FROM s
)
SELECT query_id, rank, vec_id, score FROM r WHERE rank <= 10
"""


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    main = {"op1_bpe": op1_bpe, "op2_token_counts": op2_token_counts, "op3_near_dup": op3_near_dup, "op4_licenses": op4_licenses, "op5_mixing": op5_mixing, "op6_language": op6_language, "op7_warc": op7_warc, "op8_quality": op8_quality, "op9_pii": op9_pii, "op10_topk": op10_topk}
    return main | {"quality_base_counts": quality_base_counts, "pii_base_spans": pii_base_spans}


def oracle_sql() -> dict[str, str]:
    main = {"op3_near_dup": OP3_SQL, "op4_licenses": licenses.oracle_sql(), "op5_mixing": OP5_SQL, "op7_warc": OP7_SQL, "op10_topk": OP10_SQL}
    return main | {"quality_base_counts": QUALITY_SQL, "pii_base_spans": _base_sql()}
