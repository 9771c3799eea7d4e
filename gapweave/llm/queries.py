"""The registered queries of this subpackage, over whole tables, and their SQL where there is one."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gapweave.llm import ann, bpe, conversations, extract, jaccard, mixing, pii, quality, secrets, suffix, topk, urls
from gapweave.storage import scratch_path


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    ranks = bpe.RankMap(bpe.read_ranks(public_tokenizers.path("byte_bpe_50k.tiktoken")))
    encoded = bpe.encode(_table(spark, sf_dir, "documents"), ranks, ids_text=True)
    return encoded.select(
        "doc_id",
        F.size("token_ids").cast("bigint").alias("n_tokens"),
        F.sha2("ids_text", 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )


def op2_jaccard(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard.similar_documents(_table(spark, sf_dir, "documents"))


#: Target weights of the mix: the two large crawls, and all other sources as one.
MIX_WEIGHTS = {"src0": 5, "src1": 3, mixing.REST: 12}
MIX_BLOCK_ROWS = 16


def op3_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents").select("doc_id", "source")
    return mixing.mix(docs, MIX_WEIGHTS, MIX_BLOCK_ROWS)


_MIX_SQL = """
WITH RECURSIVE weights(mix_source, weight) AS (VALUES ('src0', 5), ('src1', 3), ('*', 12)),
ranked AS (
  SELECT doc_id, source, mix_source,
         row_number() OVER (PARTITION BY mix_source ORDER BY md5(CAST(doc_id AS VARCHAR)), doc_id) - 1 AS place
  FROM (SELECT *, CASE WHEN source IN ('src0', 'src1') THEN source ELSE '*' END AS mix_source FROM documents)),
sizes AS (
  SELECT mix_source, weight, CAST(ceil(ceil(count(*) / 16.0) / weight) AS BIGINT) AS periods
  FROM ranked JOIN weights USING (mix_source) GROUP BY mix_source, weight),
phases AS (
  SELECT until, coalesce(lag(until) OVER (ORDER BY until), 0) AS since,
         CAST((SELECT sum(weight) FROM sizes WHERE periods >= until) AS BIGINT) AS length
  FROM (SELECT DISTINCT periods AS until FROM sizes)),
spans AS (
  SELECT *, coalesce(sum((until - since) * length)
           OVER (ORDER BY since ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS before
  FROM phases),
sources AS (
  SELECT until, length, list(mix_source ORDER BY mix_source) AS names, list(weight ORDER BY mix_source) AS ws
  FROM spans JOIN sizes ON periods >= until GROUP BY until, length),
walk AS (
  SELECT until, length, names, ws, CAST(0 AS BIGINT) AS slot, 0 AS pick, CAST(0 AS BIGINT) AS turn,
         list_transform(names, lambda n: CAST(0 AS BIGINT)) AS done
  FROM sources
  UNION ALL
  SELECT until, length, names, ws, slot + 1, pick, done[pick],
         list_transform(range(1, len(names) + 1), lambda i: done[i] + CASE WHEN i = pick THEN 1 ELSE 0 END)
  FROM (
    SELECT * EXCLUDE (pick, turn), list_min(list_filter(
      list_transform(range(1, len(names) + 1), lambda i:
        CASE WHEN done[i] < ws[i] AND done[i] * length < (slot + 1) * ws[i]
             THEN (((done[i] + 1) * length + ws[i] - 1) // ws[i]) * 1000 + i END),
      lambda v: v IS NOT NULL)) % 1000 AS pick
    FROM walk WHERE slot < length)),
pattern AS (SELECT until, names[pick] AS mix_source, turn, slot - 1 AS slot FROM walk WHERE slot > 0),
blocks AS (
  SELECT ranked.*, place // 16 AS mix_block, (place // 16) % weight AS turn, (place // 16) // weight AS period
  FROM ranked JOIN weights USING (mix_source))
SELECT doc_id, source, blocks.mix_source, mix_block,
       CAST(before + (period - since) * length + slot AS BIGINT) AS mix_slot,
       CAST((before + (period - since) * length + slot) * 16 + place % 16 AS BIGINT) AS mix_position
FROM blocks JOIN spans ON period >= since AND period < spans.until
JOIN pattern ON pattern.until = spans.until AND pattern.mix_source = blocks.mix_source AND pattern.turn = blocks.turn
"""


def _span_report(found: DataFrame, kinds: list[str], is_base) -> DataFrame:
    """doc_id, n_<kind> (of base spans), base_sha256 and spans, of rows (doc_id, spans)."""

    def of_kind(kind: str):
        return F.filter("spans", lambda span: is_base(span) & (span["kind"] == kind))

    return found.select(
        "doc_id",
        *(F.size(of_kind(kind)).cast("bigint").alias(f"n_{kind}") for kind in kinds),
        F.sha2(secrets.joined_spans(F.filter("spans", lambda span: is_base(span))), 256).alias("base_sha256"),
        secrets.joined_spans(F.col("spans")).alias("spans"),
    )


def op4_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = secrets.scan_secrets(_table(spark, sf_dir, "documents"), scratch_path(spark, "ledger"))
    kinds = [rule.kind for rule in secrets.BASE_RULES]
    return _span_report(found, kinds, lambda span: span["kind"].isin(kinds))


# The host rules of the contract.
HOST_RULES = [
    urls.HostRule("allow", "com", "/"),
    urls.HostRule("block", "example.com", "/en/"),
    urls.HostRule("allow", "www.example.com", "/en/"),
    urls.HostRule("block", "net", "/es/"),
    urls.HostRule("block", "net", "/fr/"),
]
PATTERN_RULES = [
    urls.PatternRule("^utm_source="),
    urls.PatternRule("^ref="),
    urls.PatternRule("^sessionid="),
    urls.PatternRule("^page=*&"),
    urls.PatternRule("||m.*/amp/"),
    urls.PatternRule("/login^"),
    urls.PatternRule("/cart^"),
    urls.PatternRule("/casino/"),
    urls.PatternRule("/banner*.gif^"),
    urls.PatternRule("/tag/*/feed^"),
    urls.PatternRule(".exe^"),
    urls.PatternRule(".zip|"),
    urls.PatternRule("||example.org/de/*#top"),
    urls.PatternRule("/docs/", "allow"),
    urls.PatternRule("||blog.*/en/", "allow"),
]


def op5_urls(spark: SparkSession, sf_dir: str) -> DataFrame:
    return urls.judge_urls(_table(spark, sf_dir, "pages"), HOST_RULES, PATTERN_RULES)


def _urls_sql() -> str:
    def any_of(verdict: str) -> str:
        return " OR ".join(
            f"regexp_matches(low, '{r.regex()}')" for r in PATTERN_RULES if r.verdict == verdict
        )

    ordered = sorted(HOST_RULES, key=lambda r: (-len(r.text), r.text))
    fits = [f"(host = '{r.host}' OR ends_with(host, '.{r.host}')) AND starts_with(path, '{r.path}')" for r in ordered]
    cases = lambda pick: " ".join(f"WHEN {f} THEN '{pick(r)}'" for f, r in zip(fits, ordered))
    upper, lower = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
    pattern = r"(?s)^.*?://([^/?#]*)([^?#]*)"
    return f"""
    WITH parts AS (
      SELECT page_id, translate(coalesce(url, ''), '{upper}', '{lower}') AS low,
             translate(regexp_extract(coalesce(url, ''), '{pattern}', 1), '{upper}', '{lower}') AS host,
             regexp_extract(coalesce(url, ''), '{pattern}', 2) AS path
      FROM pages),
    method AS (
      SELECT *, CASE WHEN ({any_of("block")}) AND NOT ({any_of("allow")}) THEN 'block' ELSE 'allow' END AS own
      FROM parts)
    SELECT page_id, host, path, CASE {cases(lambda r: r.text)} END AS rule,
           CASE {cases(lambda r: r.verdict)} ELSE own END AS verdict
    FROM method
    """


def op6_ann(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = _table(spark, sf_dir, "embeddings")
    return ann.search(rows.where("vec_id % 20 = 0"), rows, 20)


def op7_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents")
    return _span_report(pii.find_pii(docs, pii.fit_model(docs)), list(pii.KINDS), lambda span: span["base"])


def op8_suffix(spark: SparkSession, sf_dir: str) -> DataFrame:
    cut = suffix.remove_repeats(_table(spark, sf_dir, "documents"))
    return cut.select("doc_id", "n_bytes", "n_removed", "n_spans", F.sha2("kept", 256).alias("kept_sha256"))


def op9_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = _table(spark, sf_dir, "embeddings")
    return topk.top_k(rows.where("vec_id % 50 = 0"), rows, 5)


_TOPK_SQL = """
WITH whole AS (
  SELECT vec_id, list_transform(embedding, lambda x: CAST(floor(256 * CAST(x AS DOUBLE)) AS DOUBLE)) AS v
  FROM embeddings
  WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
scored AS (
  SELECT q.vec_id AS query_id, r.vec_id, CAST(list_dot_product(q.v, r.v) AS BIGINT) AS score
  FROM whole q JOIN whole r ON q.vec_id % 50 = 0 AND r.vec_id <> q.vec_id)
SELECT query_id, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS INTEGER) AS rank,
       vec_id, score
FROM scored QUALIFY rank <= 5
"""


def good_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _table(spark, sf_dir, "labels").where("quality = 1").select("doc_id")


def op10_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.resample(_table(spark, sf_dir, "documents"), good_documents(spark, sf_dir))


def op13_extract(spark: SparkSession, sf_dir: str) -> DataFrame:
    return extract.extract_text(_table(spark, sf_dir, "pages"))


QUERIES = {"op1_bpe": op1_bpe,
    "op2_jaccard": op2_jaccard,
    "op3_mix": op3_mix, "op4_secrets": op4_secrets, "op5_urls": op5_urls, "op6_ann": op6_ann,
    "op7_pii": op7_pii, "op8_suffix": op8_suffix,
    "op9_topk": op9_topk, "op10_quality": op10_quality, "op13_extract": op13_extract} | conversations.QUERIES
ORACLE = {"op3_mix": _MIX_SQL, "op5_urls": _urls_sql(), "op9_topk": _TOPK_SQL} | conversations.ORACLE
