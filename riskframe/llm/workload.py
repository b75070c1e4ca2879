"""The registered queries of this subpackage, with SQL where SQL can express them."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from riskframe.llm import bpe, decontaminate, hardneg, kdtree, licenses, linedup, maxent, partenum, periodic, quality, tokencounts, toxicity, urls

RANKS = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
JSON = public_tokenizers.path("byte_bpe_50k.json")


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_quality_nbsvm(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.classify(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op2_toxicity_nearest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.classify(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op3_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return bpe.round_trip(docs, RANKS, public_tokenizers.PATTERN).select(
        "doc_id", "n_tokens", "ids_sha256", "decoded_sha256"
    )


def op4_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return linedup.dedup_lines(docs).select("doc_id", "n_lines", "n_deleted", F.sha2("text", 256).alias("text_sha256"))


def op5_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licenses.scan(table(spark, sf_dir, "documents"))


def op6_ngram_jaccard(spark: SparkSession, sf_dir: str) -> DataFrame:
    return partenum.near_duplicates(table(spark, sf_dir, "documents"), size=4, percent=85)


def op7_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return urls.judge(table(spark, sf_dir, "pages").select("page_id", "url"))


def op8_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.contained_items(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


# A-Z to a-z and nothing else; words are runs of anything but ASCII white space.
LOWER = "translate({0}, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
SPACED_WORDS = (
    "list_filter(regexp_split_to_array(" + LOWER + ", '[\x20\x09-\x0D]+'), lambda w: w <> '')"
)


def shingle_sql(source: str, key: str, size: int) -> str:
    """Distinct shingles (key, s) of a table's texts."""
    return f"""
  SELECT DISTINCT {key}, unnest(CASE WHEN len(w) >= {size}
      THEN list_transform(range(1, len(w) - {size - 2}), lambda i: array_to_string(w[i:i + {size - 1}], ' '))
      WHEN len(w) > 0 THEN [array_to_string(w, ' ')] ELSE [] END) AS s
  FROM (SELECT {key}, {SPACED_WORDS.format("coalesce(text, '')")} AS w FROM {source} WHERE {key} IS NOT NULL)"""


OP4_SQL = r"""
WITH lines AS (
  SELECT doc_id, text, string_split(text, chr(10)) AS raw FROM documents
), numbered AS (
  SELECT doc_id, i - 1 AS line, trim(raw[i], ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)) AS said
  FROM lines, unnest(range(1, len(raw) + 1)) AS u(i)
), full_lines AS (
  SELECT doc_id, list(said ORDER BY line) AS s, list(line ORDER BY line) AS nums,
         list(len(list_filter(regexp_split_to_array(said, '[\x20\x09-\x0D]+'), lambda w: w <> '')) ORDER BY line) AS n
  FROM numbered WHERE said <> '' GROUP BY doc_id
), spans AS (
  SELECT doc_id, s, nums, i AS a, b, list_sum(n[i:b]) AS words, list_sum(n[i:b - 1]) AS less_last, list_sum(n[i + 1:b]) AS less_first
  FROM full_lines, unnest(range(1, len(s) + 1)) AS u(i), unnest(range(i, least(len(s), i + 49) + 1)) AS v(b)
), windows AS (
  SELECT doc_id, nums[a] AS first, nums[b] AS last, b - a AS size, array_to_string(s[a:b], chr(10)) AS said
  FROM spans WHERE words >= 50 AND (coalesce(less_last, 0) < 50 OR coalesce(less_first, 0) < 50)
), marked AS (
  SELECT *, row_number() OVER (PARTITION BY size, said ORDER BY doc_id, first) AS place FROM windows
), gone AS (
  SELECT DISTINCT doc_id, line FROM marked, unnest(range(first, last + 1)) AS u(line) WHERE place > 1
), g AS (SELECT doc_id, list(line) AS gone FROM gone GROUP BY doc_id)
SELECT doc_id, coalesce(len(raw), 0) AS n_lines, coalesce(len(gone), 0) AS n_deleted,
       CASE WHEN gone IS NULL THEN sha256(text) ELSE sha256(array_to_string(
         list_transform(list_filter(range(1, len(raw) + 1), lambda i: NOT list_contains(gone, i - 1)), lambda i: raw[i]), chr(10)))
       END AS text_sha256
FROM lines LEFT JOIN g USING (doc_id)
"""

OP6_SQL = f"""
WITH RECURSIVE s AS MATERIALIZED ({shingle_sql("documents", "doc_id", 4)}),
n AS MATERIALIZED (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
links AS MATERIALIZED (
  SELECT a.doc_id AS x, b.doc_id AS y
  FROM s a JOIN s b ON a.s = b.s AND a.doc_id <> b.doc_id
  JOIN n na ON na.doc_id = a.doc_id JOIN n nb ON nb.doc_id = b.doc_id
  GROUP BY a.doc_id, b.doc_id, na.n, nb.n
  HAVING 100 * count(*) >= 85 * (na.n + nb.n - count(*))
), reach(x, y) AS (
  SELECT x, y FROM links UNION SELECT r.x, l.y FROM reach r JOIN links l ON r.y = l.x
), least AS (SELECT x, min(y) AS m FROM reach GROUP BY x)
SELECT d.doc_id, coalesce(n.n, 0) AS n_shingles, least(d.doc_id, coalesce(m, d.doc_id)) AS component_id
FROM documents d LEFT JOIN n USING (doc_id) LEFT JOIN least ON least.x = d.doc_id
"""

OP8_SQL = f"""
WITH d AS ({shingle_sql("documents", "doc_id", 5)}),
i AS ({shingle_sql("benchmark", "item_id", 5)}),
n AS (SELECT item_id, count(*) AS n_shingles FROM i GROUP BY item_id)
SELECT doc_id, item_id, n_shingles, count(*) AS n_found, count(*) / n_shingles AS containment
FROM d JOIN i USING (s) JOIN n USING (item_id)
GROUP BY doc_id, item_id, n_shingles
HAVING count(*) >= 0.8 * n_shingles
"""


def op9_kdtree_top_k(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = table(spark, sf_dir, "embeddings").select("vec_id", "embedding")
    return kdtree.top_k(vectors, F.col("vec_id") % 50 == 0, k=5)


def op10_lm_maxent(spark: SparkSession, sf_dir: str) -> DataFrame:
    return maxent.score(table(spark, sf_dir, "documents").select("doc_id", "text"))


OP9_SQL = """
WITH v AS (
  SELECT vec_id, list_transform(embedding, lambda c: CAST(floor(256 * CAST(c AS DOUBLE)) AS BIGINT)) AS x
  FROM embeddings
  WHERE embedding IS NOT NULL AND len(embedding) > 0
    AND len(list_filter(embedding, lambda c: c IS NULL OR NOT isfinite(c))) = 0
), s AS (
  SELECT q.vec_id AS query_id, v.vec_id AS vec_id,
         CAST(list_sum(list_transform(list_zip(q.x, v.x), lambda p: p[1] * p[2])) AS BIGINT) AS score
  FROM v q JOIN v ON q.vec_id <> v.vec_id AND len(q.x) = len(v.x)
  WHERE q.vec_id % 50 = 0
), r AS (
  SELECT *, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS INTEGER) AS rank FROM s
)
SELECT query_id, rank, vec_id, score FROM r WHERE rank <= 5
"""


def planted(docs: DataFrame) -> DataFrame:
    """(doc_id, text): the words of every tenth document, by its id's checksum, repeat with a period from some word on."""
    h = F.crc32(F.col("doc_id").cast("string").cast("binary"))
    g = F.floor(h / 10)

    def repeated(w: Column) -> Column:
        n = F.size(w)
        a = g % n
        p = 1 + F.floor((n - a) / (3 + g % 8))
        return F.array_join(F.transform(w, lambda x, i: F.when(i < a, x).otherwise(F.get(w, (a + (i - a) % p).cast("int")))), " ")

    words = F.filter(F.split(F.coalesce("text", F.lit("")), r"[ \t-\r]+"), lambda x: x != "")
    # Bound to a lambda's variable, the words are made once for each text.
    rewritten = F.get(F.transform(F.array(words), lambda w: F.when(F.size(w) > 0, repeated(w)).otherwise("")), 0)
    return docs.select("doc_id", F.when(h % 10 == 0, rewritten).otherwise(F.col("text")).alias("text"))


def op11_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = periodic.find_runs(planted(table(spark, sf_dir, "documents")), keep=["doc_id"])
    best = F.aggregate(
        "runs", F.get("runs", 0), lambda b, r: F.when(r["length"] * b["period"] > b["length"] * r["period"], r).otherwise(b)
    )
    line = F.transform("runs", lambda r: F.concat(F.concat_ws(",", r["start"], r["length"], r["period"]), F.lit("\n")))
    return found.withColumn("best", best).select(
        "doc_id", F.size("runs").cast("long").alias("n_runs"), *[F.col(f"best.{c}").alias(c) for c in ("start", "length", "period")],
        F.floor(1000 * F.col("best.length") / F.col("best.period")).alias("exponent_milli"),
        F.sha2(F.array_join(line, ""), 256).alias("runs_sha256"), F.sha2("collapsed", 256).alias("collapsed_sha256"),
    )


#: crc32 byte by byte; its table is made by the rule.
OP11_SQL = r"""
WITH crc AS (
  SELECT list_transform(range(256), lambda n: list_reduce(list_prepend(n, [0, 0, 0, 0, 0, 0, 0, 0]),
    lambda c, x: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END)) AS t
), d AS (
  SELECT doc_id, list_filter(regexp_split_to_array(coalesce(text, ''), '[\x20\x09-\x0D]+'), lambda w: w <> '') AS w,
    xor(4294967295, list_reduce(list_prepend(4294967295, list_transform(range(1, len(CAST(doc_id AS VARCHAR)) + 1),
      lambda i: CAST(ascii(substr(CAST(doc_id AS VARCHAR), i, 1)) AS BIGINT))),
      lambda c, x: xor(c >> 8, t[(xor(c, x) & 255) + 1]))) AS h
  FROM documents, crc
), n AS (SELECT *, len(w) AS n, h // 10 AS g FROM d
), o AS (
  SELECT *, CASE WHEN h % 10 = 0 AND n > 0 THEN g % n END AS a,
    CASE WHEN h % 10 = 0 AND n > 0 THEN 1 + (n - g % n) // (3 + g % 8) END AS p FROM n
), x AS MATERIALIZED (
  SELECT doc_id, n, CASE WHEN a IS NULL THEN w
    ELSE list_transform(range(n), lambda i: w[CASE WHEN i < a THEN i ELSE a + (i - a) % p END + 1]) END AS w FROM o
), e AS MATERIALIZED (SELECT doc_id, n, unnest(w) AS word, unnest(range(n)) AS i FROM x
), pairs AS (
  SELECT a.doc_id, b.i - a.i AS q, a.i FROM e a JOIN e b
  ON a.doc_id = b.doc_id AND a.word = b.word AND a.i < b.i AND 4 * (b.i - a.i) <= a.n
), stretches AS (
  SELECT doc_id, q, min(i) AS s, count(*) + q AS l FROM (
    SELECT *, i - row_number() OVER (PARTITION BY doc_id, q ORDER BY i) AS isle FROM pairs) GROUP BY doc_id, q, isle
  HAVING count(*) + q >= greatest(6, 4 * q)
), runs AS MATERIALIZED (
  SELECT * FROM stretches a WHERE NOT EXISTS (SELECT 1 FROM stretches b WHERE b.doc_id = a.doc_id AND b.q < a.q
    AND a.q % b.q = 0 AND b.s <= a.s AND b.s + b.l >= a.s + a.l)
), told AS (
  SELECT doc_id, count(*) AS n_runs, string_agg(s || ',' || l || ',' || q || chr(10), '' ORDER BY s, q) AS said FROM runs GROUP BY doc_id
), best AS (
  SELECT * FROM runs a WHERE NOT EXISTS (SELECT 1 FROM runs b WHERE b.doc_id = a.doc_id AND (b.l * a.q > a.l * b.q
    OR (b.l * a.q = a.l * b.q AND (b.s < a.s OR (b.s = a.s AND b.q < a.q)))))
), gone AS (SELECT DISTINCT doc_id, unnest(range(s + q, s + l)) AS i FROM runs
), kept AS (
  SELECT doc_id, string_agg(word, ' ' ORDER BY i) AS said FROM e ANTI JOIN gone USING (doc_id, i) GROUP BY doc_id
)
SELECT x.doc_id, coalesce(n_runs, 0) AS n_runs, s AS start, l AS length, q AS period, 1000 * l // q AS exponent_milli,
  sha256(coalesce(told.said, '')) AS runs_sha256, sha256(coalesce(kept.said, '')) AS collapsed_sha256
FROM x LEFT JOIN told USING (doc_id) LEFT JOIN best USING (doc_id) LEFT JOIN kept USING (doc_id)
"""


def op12_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    label = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return hardneg.mine(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 50 == 0, label)


OP12_SQL = """
WITH v AS MATERIALIZED (
  SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
    list_transform(embedding, lambda c: CAST(floor(256 * CAST(c AS DOUBLE)) AS BIGINT)) AS x
  FROM embeddings
  WHERE label IS NOT NULL AND embedding IS NOT NULL AND len(embedding) > 0
    AND len(list_filter(embedding, lambda c: c IS NULL OR NOT isfinite(c))) = 0
), s AS MATERIALIZED (
  SELECT a.vec_id AS anchor_id, v.vec_id, a.label = v.label AS same,
    CAST(list_sum(list_transform(list_zip(a.x, v.x), lambda p: p[1] * p[2])) AS BIGINT) AS score
  FROM v a JOIN v ON a.vec_id <> v.vec_id AND len(a.x) = len(v.x)
  WHERE a.vec_id % 50 = 0
), p AS (
  SELECT *, row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, vec_id) AS place FROM s WHERE same
), n AS (
  SELECT p.anchor_id, p.vec_id AS positive_id, s.vec_id AS negative_id, p.score AS positive_score, s.score AS negative_score,
    CAST(row_number() OVER (PARTITION BY p.anchor_id, p.vec_id ORDER BY s.score DESC, s.vec_id) AS INTEGER) AS rank
  FROM p JOIN s ON s.anchor_id = p.anchor_id AND NOT s.same AND 50 * p.score <= 100 * s.score AND 100 * s.score <= 95 * p.score
  WHERE place <= 5
)
SELECT anchor_id, positive_id, rank, negative_id, positive_score, negative_score FROM n WHERE rank <= 3
"""


def op13_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return tokencounts.count_tokens(docs, JSON, public_tokenizers.PATTERN, keep=["doc_id"])


QUERIES = {
    "op1_quality_nbsvm": op1_quality_nbsvm,
    "op2_toxicity_nearest": op2_toxicity_nearest,
    "op3_byte_bpe": op3_byte_bpe,
    "op4_line_dedup": op4_line_dedup,
    "op5_license_scan": op5_license_scan,
    "op6_ngram_jaccard": op6_ngram_jaccard,
    "op7_url_filter": op7_url_filter,
    "op8_decontamination": op8_decontamination,
    "op9_kdtree_top_k": op9_kdtree_top_k,
    "op10_lm_maxent": op10_lm_maxent,
    "op11_periodic_runs": op11_periodic_runs,
    "op12_hard_negatives": op12_hard_negatives,
    "op13_token_counts": op13_token_counts,
}
ORACLE_SQL = {"op4_line_dedup": OP4_SQL, "op6_ngram_jaccard": OP6_SQL, "op8_decontamination": OP8_SQL, "op9_kdtree_top_k": OP9_SQL,
              "op11_periodic_runs": OP11_SQL, "op12_hard_negatives": OP12_SQL}
