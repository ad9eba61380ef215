"""The registered queries of the corpus operators and the SQL that checks them."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from plexlake.llm import clusters, codes, decontaminate, licenses, neardup, packing, pii, quality, secret_scan, token_files, toxicity, vectors, warc

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}
VOCABULARY = "word_bpe_49k.json"


def query(sql: str | None = None) -> Callable[[Query], Query]:
    def add(function: Query) -> Query:
        QUERIES[function.__name__] = function
        if sql is not None:
            ORACLES[function.__name__] = sql
        return function

    return add


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


@query()
def op1_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    packed = packing.pack(table(spark, sf_dir, "documents"), public_tokenizers.path(VOCABULARY))
    return packed.slots.select("doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset")


_LOWER = "translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"


@query(rf"""WITH RECURSIVE
texts AS (SELECT doc_id, regexp_extract_all({_LOWER}, '[^\x20\x09-\x0D]+') AS w FROM documents),
sets AS (SELECT doc_id, list_distinct(CASE WHEN len(w) = 0 OR w IS NULL THEN []::VARCHAR[]
    WHEN len(w) < 5 THEN [array_to_string(w, ' ')]
    ELSE list_transform(range(1, len(w) - 3), lambda i: array_to_string(w[i:i+4], ' ')) END) AS s FROM texts),
shingles AS (SELECT doc_id, len(s) AS n, unnest(s) AS shingle FROM sets),
pairs AS (SELECT x.doc_id AS a, y.doc_id AS b FROM shingles x JOIN shingles y ON x.shingle = y.shingle AND x.doc_id <> y.doc_id
  GROUP BY x.doc_id, y.doc_id, x.n, y.n HAVING 100 * count(*) >= 75 * (x.n + y.n - count(*))),
reach AS (SELECT doc_id AS a, doc_id AS b FROM documents UNION SELECT r.a, p.b FROM reach r JOIN pairs p ON r.b = p.a),
components AS (SELECT a, min(b) AS component_id FROM reach GROUP BY a)
SELECT doc_id, CAST(len(s) AS BIGINT) AS n_shingles, component_id, doc_id = component_id AS kept
FROM sets JOIN components ON doc_id = a""")
def op2_minhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return neardup.near_duplicates(table(spark, sf_dir, "documents"))


@query()
def op6_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = token_files.encode_corpus(table(spark, sf_dir, "documents"), public_tokenizers.path(VOCABULARY))
    return token_files.token_digests(token_files.read_tokens(spark, path))


def span_digest(spans, base: int):
    """Hash and text of spans; ``base`` is how many kinds the contract names."""
    named = F.filter(spans, lambda s: s["rank"] < base)
    return F.sha2(pii.joined(named), 256).alias("base_sha256"), pii.joined(spans).alias("spans")


def _is_kind(rank: int):
    return lambda s: s["rank"] == rank


_BYTE = "0*(25[0-5]|2[0-4][0-9]|1[0-9][0-9]|[0-9]?[0-9])"
_DIGITS = "regexp_replace(m, '[^0-9]', '', 'g')"


@query(rf"""WITH
docs AS (SELECT doc_id, coalesce(text, '') AS t FROM documents),
kinds(rank, kind, pattern) AS (VALUES
  (0, 'email', '[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+'), (1, 'ip', '[0-9]+(?:\.[0-9]+)(?:\.[0-9]+)(?:\.[0-9]+)'),
  (2, 'card', '[0-9](?:[\x20-]?[0-9])+'), (3, 'phone', '\+[0-9][\x20().0-9-]+[0-9]'), (4, 'iban', '[A-Za-z0-9]+')),
lists AS (SELECT doc_id, rank, kind, regexp_extract_all(t, pattern) AS ms, regexp_split_to_array(t, pattern) AS gs FROM docs, kinds),
found AS (SELECT doc_id, rank, kind, unnest(range(1, len(ms) + 1)) AS i, unnest(ms) AS m, unnest(gs[1:len(ms)]) AS g FROM lists),
placed AS (SELECT *, sum(length(g) + length(m)) OVER (PARTITION BY doc_id, rank ORDER BY i) AS e FROM found),
valid AS (SELECT doc_id, rank, kind, e - length(m) AS s, e FROM placed WHERE CASE rank
  WHEN 0 THEN true
  WHEN 1 THEN regexp_full_match(m, '{_BYTE}(\.{_BYTE}){{3}}')
  WHEN 2 THEN length({_DIGITS}) BETWEEN 12 AND 19 AND list_sum(list_transform(range(1, length({_DIGITS}) + 1), lambda k:
    CASE WHEN k % 2 = 1 THEN ascii(reverse({_DIGITS})[k]) - 48
    ELSE 2 * (ascii(reverse({_DIGITS})[k]) - 48) - CASE WHEN ascii(reverse({_DIGITS})[k]) - 48 > 4 THEN 9 ELSE 0 END END)) % 10 = 0
  WHEN 3 THEN length({_DIGITS}) BETWEEN 9 AND 15
  ELSE regexp_full_match(m, '[A-Z]{{2}}[0-9]{{2}}[A-Z0-9]{{11,30}}') AND list_reduce(
    list_transform(range(1, length(m) + 1), lambda k: ascii((m[5:] || m[1:4])[k]) - CASE WHEN ascii((m[5:] || m[1:4])[k]) < 58 THEN 48 ELSE 55 END),
    lambda a, x: (a * CASE WHEN x < 10 THEN 10 ELSE 100 END + x) % 97) = 1 END),
joined AS (SELECT doc_id, count(*) FILTER (rank = 0) AS n_email, count(*) FILTER (rank = 1) AS n_ip, count(*) FILTER (rank = 2) AS n_card,
  count(*) FILTER (rank = 3) AS n_phone, string_agg(kind || ':' || s || ':' || e, ',' ORDER BY s, rank) FILTER (rank < 4) AS base,
  string_agg(kind || ':' || s || ':' || e, ',' ORDER BY s, rank) AS spans FROM valid GROUP BY doc_id)
SELECT doc_id, coalesce(n_email, 0) AS n_email, coalesce(n_ip, 0) AS n_ip, coalesce(n_card, 0) AS n_card, coalesce(n_phone, 0) AS n_phone,
  sha256(coalesce(base, '')) AS base_sha256, coalesce(spans, '') AS spans FROM docs LEFT JOIN joined USING (doc_id)""")
def op5_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = pii.find_spans(table(spark, sf_dir, "documents"))
    counts = [
        F.size(F.filter("spans", _is_kind(rank))).cast("long").alias(f"n_{kind.name}") for rank, kind in enumerate(pii.BASE)
    ]
    return found.select("doc_id", *counts, *span_digest(F.col("spans"), len(pii.BASE)))


_WORDS = rf"regexp_extract_all({_LOWER}, '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')"


@query(rf"""WITH
t AS (SELECT doc_id, coalesce({_WORDS}, []) AS w FROM documents),
b AS (SELECT item_id, {_WORDS} AS w FROM benchmark),
cut AS (SELECT item_id, unnest(CASE WHEN len(w) = 0 OR w IS NULL THEN [] WHEN len(w) < 13 THEN [w]
    ELSE list_transform(range(1, len(w) - 11), lambda i: w[i:i+12]) END) AS x FROM b),
win AS (SELECT DISTINCT item_id, len(x) AS l, array_to_string(x, ' ') AS g FROM cut),
lens AS (SELECT DISTINCT l FROM win),
grams AS (SELECT doc_id, l, w, unnest(range(1, len(w) - l + 2)) AS p FROM t, lens),
occ AS (SELECT doc_id, p, l, item_id FROM (SELECT doc_id, l, p, array_to_string(w[p:p+l-1], ' ') AS g FROM grams) JOIN win USING (l, g)),
hit AS (SELECT doc_id, count(DISTINCT q) AS n FROM (SELECT doc_id, unnest(range(p, p + l)) AS q FROM occ) GROUP BY 1),
items AS (SELECT doc_id, list_sort(list(DISTINCT CAST(item_id AS VARCHAR))) AS ids FROM occ GROUP BY 1)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, coalesce(n, 0) AS n_hit, CAST(coalesce(len(ids), 0) AS BIGINT) AS n_items,
  sha256(coalesce(array_to_string(ids, ','), '')) AS items_sha256, coalesce(n, 0) > 0 AND 20 * coalesce(n, 0) >= len(w) AS contaminated
FROM t LEFT JOIN hit USING (doc_id) LEFT JOIN items USING (doc_id)""")
def op9_benchmark_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = decontaminate.contamination(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    return found.select(
        "doc_id", "n_words", "n_hit", "n_items", F.sha2(F.array_join("item_ids", ","), 256).alias("items_sha256"), "contaminated"
    )


@query()
def op10_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.assess(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


@query("""WITH RECURSIVE
v AS (SELECT vec_id, label, list_transform(embedding, lambda x: CAST(x AS DOUBLE)) AS e FROM embeddings
  WHERE embedding IS NOT NULL AND label IS NOT NULL),
n AS (SELECT *, sqrt(list_sum(list_transform(e, lambda x: x * x))) AS norm FROM v),
pairs AS (SELECT x.vec_id AS a, y.vec_id AS b FROM n x JOIN n y ON x.label = y.label AND x.vec_id <> y.vec_id
  WHERE x.norm > 0 AND y.norm > 0 AND list_dot_product(x.e, y.e) / (x.norm * y.norm) >= 0.98),
reach AS (SELECT vec_id AS a, vec_id AS b FROM embeddings UNION SELECT r.a, p.b FROM reach r JOIN pairs p ON r.b = p.a),
components AS (SELECT a, min(b) AS component_id FROM reach GROUP BY a),
links AS (SELECT a, count(*) AS n_links FROM pairs GROUP BY a)
SELECT vec_id, coalesce(n_links, 0) AS n_links, component_id, vec_id = component_id AS kept
FROM embeddings JOIN components c ON c.a = vec_id LEFT JOIN links l ON l.a = vec_id""")
def op8_embedding_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return vectors.near_vectors(table(spark, sf_dir, "embeddings"))


@query()
def op3_secret_scans(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = secret_scan.find_secrets(table(spark, sf_dir, "documents"))
    counts = [
        F.size(F.filter("spans", _is_kind(rank))).cast("long").alias(f"n_{kind}") for rank, kind in enumerate(secret_scan.KINDS)
    ]
    return found.select("doc_id", *counts, *span_digest(F.col("spans"), len(secret_scan.KINDS)))


@query()
def op4_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.toxicity(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


@query()
def op7_license_scans(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = licenses.find_licenses(table(spark, sf_dir, "documents"))
    one = lambda n: F.concat_ws(":", n["family"], n["start"].cast("string"), n["end"].cast("string"))
    families = F.array_join(F.sort_array(F.array_distinct(F.transform("notices", lambda n: n["family"]))), ",")
    return found.select(
        "doc_id", "n_paragraphs", F.size("notices").cast("long").alias("n_notices"), families.alias("families"),
        F.array_join(F.transform("notices", one), ",").alias("spans"),
    )


@query("""WITH
t AS (SELECT page_id, coalesce(html, '') AS h FROM pages),
d AS (SELECT page_id, CAST(strlen(h) AS BIGINT) AS payload_bytes, sha256(h) AS payload_digest FROM t),
f AS (SELECT payload_digest, min(page_id) AS first FROM d GROUP BY 1)
SELECT page_id, payload_bytes, payload_digest,
  CASE WHEN payload_bytes >= 100 AND page_id <> first THEN 'revisit' ELSE 'response' END AS record_type,
  CASE WHEN payload_bytes >= 100 AND page_id <> first THEN first END AS refers_to
FROM d JOIN f USING (payload_digest)""")
def op11_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = warc.write_pages(table(spark, sf_dir, "pages"))
    return warc.page_digests(warc.captures(warc.read_records(spark, path)))


_FLOOR = "CAST((s - ((s % n) + n) % n) // n AS BIGINT)"  # exact, down also below zero


def _whole_vectors(condition: str) -> str:
    return f"""v AS MATERIALIZED (SELECT vec_id, label, list_transform(embedding, lambda x: CAST(floor(256 * CAST(x AS DOUBLE)) AS BIGINT)) AS e
  FROM embeddings WHERE embedding IS NOT NULL AND {condition}
  AND len(list_filter(embedding, lambda x: x IS NOT NULL AND isfinite(x))) = len(embedding))"""


def _cluster_sql(rounds: int = 5) -> str:
    steps = [
        "WITH " + _whole_vectors("len(embedding) = 64"),
        "c0 AS MATERIALIZED (SELECT row_number() OVER (ORDER BY sha256('2:' || vec_id)) - 1 AS k, e AS c FROM v"
        " QUALIFY row_number() OVER (ORDER BY sha256('2:' || vec_id)) <= 40)",
    ]
    for r in range(rounds + 1):
        steps.append(f"""a{r} AS MATERIALIZED (SELECT vec_id, any_value(e) AS e, min(d) AS d, CAST(arg_min(k, (d, k)) AS INTEGER) AS k FROM (
  SELECT vec_id, e, k, CAST(list_sum(list_transform(range(1, 65), lambda i: (e[i] - c[i]) * (e[i] - c[i]))) AS BIGINT) AS d FROM v, c{r}) GROUP BY vec_id)""")
        if r < rounds:
            steps.append(f"""m{r} AS (SELECT k, i, sum(e[i]) AS s, count(*) AS n FROM a{r}, range(1, 65) t(i) GROUP BY k, i),
n{r} AS (SELECT k, list({_FLOOR} ORDER BY i) AS c FROM m{r} GROUP BY k),
c{r + 1} AS MATERIALIZED (SELECT k, coalesce(n{r}.c, c{r}.c) AS c FROM c{r} LEFT JOIN n{r} USING (k))""")
    return ",\n".join(steps) + f"""
SELECT vec_id, k AS cluster, d AS distance, CAST(sum(d) OVER (PARTITION BY k) AS BIGINT) AS cluster_inertia, CAST(sum(d) OVER () AS BIGINT) AS inertia,
  sha256(array_to_string(c, ',')) AS centroid_sha256 FROM a{rounds} JOIN c{rounds} USING (k)"""


@query(_cluster_sql())
def op12_centroid_clustering(spark: SparkSession, sf_dir: str) -> DataFrame:
    return clusters.cluster(table(spark, sf_dir, "embeddings")).described()


def _code_sql(rounds: int = 2) -> str:
    steps = [
        "WITH " + _whole_vectors("len(embedding) > 0"),
        "parts AS MATERIALIZED (SELECT vec_id, p, e[1 + p * len(e) // 16 : (p + 1) * len(e) // 16] AS x FROM v, range(16) t(p))",
        "b0 AS MATERIALIZED (SELECT p, row_number() OVER (PARTITION BY p ORDER BY vec_id) - 1 AS k, x AS c FROM parts"
        " QUALIFY row_number() OVER (PARTITION BY p ORDER BY vec_id) <= 64)",
    ]
    for r in range(rounds + 1):
        steps.append(f"""a{r} AS MATERIALIZED (SELECT vec_id, p, any_value(x) AS x, min(d) AS d, arg_min(k, (d, k)) AS k FROM (
  SELECT vec_id, p, x, k, CAST(list_sum(list_transform(range(1, len(x) + 1), lambda i: (x[i] - c[i]) * (x[i] - c[i]))) AS BIGINT) AS d
  FROM parts JOIN b{r} USING (p)) GROUP BY vec_id, p)""")
        if r < rounds:
            steps.append(f"""m{r} AS (SELECT p, k, i, sum(y) AS s, count(*) AS n FROM (
  SELECT p, k, unnest(x) AS y, unnest(range(1, len(x) + 1)) AS i FROM a{r}) GROUP BY p, k, i),
n{r} AS (SELECT p, k, list({_FLOOR} ORDER BY i) AS c FROM m{r} GROUP BY p, k),
b{r + 1} AS MATERIALIZED (SELECT p, k, coalesce(n{r}.c, b{r}.c) AS c FROM b{r} LEFT JOIN n{r} USING (p, k))""")
    return ",\n".join(steps) + f""",
coded AS (SELECT vec_id, string_agg(lpad(to_hex(k), 2, '0'), '' ORDER BY p) AS code, CAST(sum(d) AS BIGINT) AS error FROM a{rounds} GROUP BY vec_id)
SELECT vec_id, lower(code) AS code, error, CAST(sum(error) OVER (PARTITION BY label) AS BIGINT) AS label_error,
  (SELECT sha256(string_agg(array_to_string(c, ','), ',' ORDER BY p, k)) FROM b{rounds}) AS codebooks_sha256 FROM coded JOIN v USING (vec_id)"""


@query(_code_sql())
def op13_vector_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return codes.compress(table(spark, sf_dir, "embeddings")).described()
