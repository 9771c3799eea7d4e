"""Queries on encoding, similarity search, filling and completion, each with its SQL."""

from __future__ import annotations

from pyspark.sql import functions as F

from gapweave.catalog.fixtures import (
    MATCHES_SQL,
    VECTORS_SQL,
    centroids,
    record_sides,
    records,
    table,
    vector_sides,
    vectors,
)
from gapweave.config import FIELDS
from gapweave.operators.encode import HashedTokenEncoder, embed_cached, embed_texts, lexical_vectors, mean_pool
from gapweave.operators.knn import BlockLimits, assign_cells, centroid_matrix, hash_patterns, nearest, random_hyperplanes
from gapweave.operators.match import best_matches, fill, lookup_matches, match_records
from gapweave.operators.report import completion_report, completion_stats, score_stats
from gapweave.operators.scoring import MASTER_KEY, TARGET_KEY, LexicalScorer
from gapweave.operators.validate import rows_needing_fill, vector_checks, vector_stats
from gapweave.plans.complete import complete, find_matches, record_text
from gapweave.storage import materialize, scratch_path

_NO_BROADCAST = BlockLimits(broadcast_rows=0)
# Many blocks of masters, so that targets look for a first bound.
_SEEDED = BlockLimits(broadcast_rows=0, block_rows=40, seeded_blocks=2)
_THRESHOLD = 0.35
# Of the ten cells. The vectors hardly cluster: seven find 87 % of the matches of others at 500 rows, eight 93 %.
_PROBED_CELLS = 8
_HYPERPLANES = {"dimension": 64, "tables": 6, "bits": 4}


def _neighbours(found):
    return found.select(TARGET_KEY, MASTER_KEY, "score", F.col("rank").cast("bigint").alias("rank"))


def knn_topk(spark, sf):
    return _neighbours(nearest(*vector_sides(spark, sf), k=5, threshold=_THRESHOLD))


def knn_exact(spark, sf):
    return _neighbours(nearest(*vector_sides(spark, sf), k=3, threshold=_THRESHOLD, limits=_NO_BROADCAST))


def knn_exact_seeded(spark, sf):
    return _neighbours(nearest(*vector_sides(spark, sf), k=3, threshold=_THRESHOLD, limits=_SEEDED))


def knn_exact_cells(spark, sf):
    found = nearest(
        *vector_sides(spark, sf), k=3, threshold=_THRESHOLD, index_type="cells", centroids=centroids(spark, sf)
    )
    return _neighbours(found)


def knn_prefix(spark, sf):
    """Short texts, as in an equipment register: all parts compared with all parts."""
    size = F.concat(F.lit("size-"), F.col("p_size"))
    part = table(spark, sf, "part").select("p_partkey", F.concat_ws(" ", "p_name", "p_brand", "p_type", size).alias("text"))
    target = part.select(F.col("p_partkey").alias(TARGET_KEY), "text")
    master = part.select(F.col("p_partkey").alias(MASTER_KEY), "text")
    return _neighbours(nearest(target, master, 3, 0.8, "prefix", LexicalScorer()))


def knn_ivf(spark, sf, index_type="ivfflat"):
    found = nearest(
        *vector_sides(spark, sf),
        k=3,
        threshold=_THRESHOLD,
        index_type=index_type,
        centroids=centroids(spark, sf),
        nprobe=_PROBED_CELLS,
    )
    return _neighbours(found)


def knn_ivf_coded(spark, sf):
    return knn_ivf(spark, sf, "coded")


def _patterns():
    return hash_patterns(_HYPERPLANES["bits"], _THRESHOLD, _HYPERPLANES["tables"])


def knn_lsh(spark, sf):
    found = nearest(
        *vector_sides(spark, sf),
        k=3,
        threshold=_THRESHOLD,
        index_type="hnsw",
        hyperplanes=random_hyperplanes(**_HYPERPLANES),
        patterns=_patterns(),
    )
    return _neighbours(found)


def _matches(spark, sf):
    """Incomplete documents, labelled documents, and the stored best match of each of the former."""
    master, target = record_sides(spark, sf)
    text = record_text(FIELDS).alias("text")
    incomplete = rows_needing_fill(target).select(F.col("doc_id").alias(TARGET_KEY), text)
    known = master.select(F.col("doc_id").alias(MASTER_KEY), text)
    best = materialize(best_matches(find_matches(known, incomplete)), "matches")
    return incomplete, master, target, best


def match_lookup(spark, sf):
    _, master, _, best = _matches(spark, sf)
    return lookup_matches(best, master, "doc_id", ["equipment_type", "equipment_description"])


def best_match(spark, sf):
    incomplete, master, _, best = _matches(spark, sf)
    matched = lookup_matches(best, master, "doc_id", ["equipment_type"])
    return match_records(incomplete, matched, ["equipment_type"])


def semantic_fill(spark, sf):
    _, master, target, best = _matches(spark, sf)
    matched = lookup_matches(best, master, "doc_id", ["equipment_type"])
    return fill(target, matched, "doc_id", ["equipment_type"])


def complete_records(spark, sf):
    return complete(*record_sides(spark, sf), target_key="doc_id", master_key="doc_id")


def complete_without_gaps(spark, sf):
    """Documents that all have a label: nothing is searched and nothing changes."""
    master, _ = record_sides(spark, sf)
    whole = master.where("equipment_description is not null")
    return complete(whole, whole, target_key="doc_id", master_key="doc_id")


def _completed(spark, sf):
    return records(spark, sf), materialize(complete_records(spark, sf), "completed")


def report(spark, sf):
    original, completed = _completed(spark, sf)
    return completion_report(original, completed, FIELDS)


def stats(spark, sf):
    original, completed = _completed(spark, sf)
    return completion_stats(original, completed, FIELDS)


def scores(spark, sf):
    return score_stats(_completed(spark, sf)[1], ["equipment_type_similarity_score"])


def embedded(spark, sf):
    documents = table(spark, sf, "documents").select("doc_id", "text")
    return _long(embed_texts(documents, "text", HashedTokenEncoder, 64, partitions=spark.sparkContext.defaultParallelism))


def embedded_once(spark, sf):
    """Vectors of all documents, after a run over the English ones: the second one encodes other texts only."""
    documents, store = table(spark, sf, "documents").select("doc_id", "text", "lang"), scratch_path(spark, "encoded")
    for part in (documents.where("lang = 'en'"), documents):
        found = embed_cached(part, "text", HashedTokenEncoder, store, "hashed-64", "doc_id", 64)
    return _long(found)


def _long(vectors_):
    long = vectors_.select("doc_id", F.posexplode("vector").alias("pos", "x")).where("x <> 0")
    return long.select("doc_id", F.col("pos").cast("bigint").alias("pos"), F.col("x").cast("double").alias("x"))


def lexical(spark, sf):
    slots = spark.sparkContext.defaultParallelism
    found = lexical_vectors(table(spark, sf, "documents"), "doc_id", "text", partitions=slots)
    return found.select("doc_id", "token", F.round("weight", 9).alias("weight"))


def pooled(spark, sf):
    means = mean_pool(vectors(spark, sf), "label", "vector")
    long = means.select("label", F.posexplode("vector").alias("pos", "x"))
    return long.select("label", F.col("pos").cast("bigint").alias("pos"), F.round("x", 6).alias("x"))


def stats_of_vectors(spark, sf):
    _, master = vector_sides(spark, sf)
    return vector_stats(assign_cells(master, centroid_matrix(centroids(spark, sf))))


def checks_of_vectors(spark, sf):
    embeddings = vectors(spark, sf).select(F.col("vec_id").alias("doc_id"), "vector")
    return vector_checks(table(spark, sf, "documents").select("doc_id"), embeddings, "doc_id")


QUERIES = {
    "knn_topk": knn_topk,
    "knn_exact": knn_exact,
    "knn_exact_seeded": knn_exact_seeded,
    "knn_exact_cells": knn_exact_cells,
    "knn_prefix": knn_prefix,
    "knn_ivf": knn_ivf,
    "knn_ivf_coded": knn_ivf_coded,
    "knn_lsh": knn_lsh,
    "match_lookup": match_lookup,
    "best_match": best_match,
    "semantic_fill": semantic_fill,
    "score_stats": scores,
    "completion_stats": stats,
    "completion_report": report,
    "embed_texts": embedded,
    "embed_cached": embedded_once,
    "lexical_vectors": lexical,
    "mean_pool_vectors": pooled,
    "vector_stats": stats_of_vectors,
    "vector_validation": checks_of_vectors,
    "complete_records": complete_records,
    "complete_without_gaps": complete_without_gaps,
}

_ALL_PAIRS = """
pairs AS (
  SELECT t.vec_id AS target_key, m.vec_id AS master_key, round(list_inner_product(t.v, m.v), 6) AS score
  FROM vectors t, vectors m)
"""


def _top(source: str, k: int, threshold: float = _THRESHOLD) -> str:
    return (
        f"SELECT target_key, master_key, score, row_number() OVER (PARTITION BY target_key "
        f"ORDER BY score DESC, master_key) AS rank FROM {source} WHERE score >= {threshold} QUALIFY rank <= {k}"
    )


_PLACED = """
closeness AS (
  SELECT vec_id, v, cell, round(list_inner_product(v, c), 9) AS s FROM vectors, centroids),
placed AS (
  SELECT * FROM closeness QUALIFY row_number() OVER (PARTITION BY vec_id ORDER BY s DESC, cell) = 1)
"""


def _hyperplane_rows() -> str:
    normals = random_hyperplanes(**_HYPERPLANES)
    return ", ".join(
        f"({t}, {b}, {[float(x) for x in normals[t, b]]})"
        for t in range(normals.shape[0])
        for b in range(normals.shape[1])
    )


def _pattern_rows() -> str:
    """(pattern, place of a bit by its margin, whether it is flipped)"""
    return ", ".join(f"({p}, {i}, {flip})" for p, row in enumerate(_patterns()) for i, flip in enumerate(row))


_STATS_SQL = """
stats AS (
  SELECT 'equipment_type' AS field, count(*) FILTER (r.equipment_type IS NULL) AS originally_missing,
         count(*) FILTER (c.equipment_type IS NULL) AS still_missing
  FROM records r JOIN completed c USING (doc_id)
  UNION ALL SELECT 'equipment_description', count(*) FILTER (r.equipment_description IS NULL),
         count(*) FILTER (c.equipment_description IS NULL)
  FROM records r JOIN completed c USING (doc_id)),
score_stats AS (
  SELECT 'equipment_type_similarity_score' AS "column", round(avg(s), 6) AS mean_score,
         round(median(s), 6) AS median_score, min(s) AS min_score, max(s) AS max_score,
         count(s) AS scores_available
  FROM (SELECT equipment_type_similarity_score AS s FROM completed) WHERE s IS NOT NULL)
"""

_IVF_SQL = f"""
    WITH {VECTORS_SQL}, {_PLACED}, probes AS (
      SELECT * FROM closeness QUALIFY row_number() OVER (PARTITION BY vec_id ORDER BY s DESC, cell) <= {_PROBED_CELLS}),
    found AS (
      SELECT t.vec_id AS target_key, m.vec_id AS master_key, round(list_inner_product(t.v, m.v), 6) AS score
      FROM probes t JOIN placed m USING (cell))
    {_top('found', 3)}"""

_EMBEDDED_SQL = r"""
        WITH tokens AS (
          SELECT doc_id, unnest(string_split(lower(trim(regexp_replace(text, '\s+', ' ', 'g'))), ' ')) AS token
          FROM documents),
        places AS (
          SELECT doc_id, ('0x' || substr(md5(token), 1, 8))::BIGINT % 64 AS pos, count(*) AS n
          FROM tokens WHERE token <> '' GROUP BY ALL)
        SELECT doc_id, pos, (n / sqrt(sum(n * n) OVER (PARTITION BY doc_id)))::FLOAT::DOUBLE AS x FROM places"""

ORACLE = {
    "knn_topk": f"WITH {VECTORS_SQL}, {_ALL_PAIRS} {_top('pairs', 5)}",
    "knn_exact": f"WITH {VECTORS_SQL}, {_ALL_PAIRS} {_top('pairs', 3)}",
    "knn_exact_seeded": f"WITH {VECTORS_SQL}, {_ALL_PAIRS} {_top('pairs', 3)}",
    "knn_exact_cells": f"WITH {VECTORS_SQL}, {_ALL_PAIRS} {_top('pairs', 3)}",
    "knn_prefix": f"""
        WITH counts AS (
          SELECT p_partkey, token, count(*) AS n FROM (
            SELECT p_partkey, unnest(string_split(
              lower(concat_ws(' ', p_name, p_brand, p_type, 'size-' || p_size)), ' ')) AS token FROM part)
          GROUP BY ALL),
        weights AS (SELECT p_partkey, token, n / sqrt(sum(n * n) OVER (PARTITION BY p_partkey)) AS w FROM counts),
        scores AS (
          SELECT t.p_partkey AS target_key, m.p_partkey AS master_key, round(sum(t.w * m.w), 6) AS score
          FROM weights t JOIN weights m USING (token) GROUP BY ALL)
        {_top('scores', 3, 0.8)}""",
    "knn_ivf": _IVF_SQL,
    "knn_ivf_coded": _IVF_SQL,
    "knn_lsh": f"""
        WITH {VECTORS_SQL}, planes AS (
          SELECT * FROM (VALUES {_hyperplane_rows()}) AS p(t, b, normal)),
        sides AS (SELECT vec_id, t, b, list_inner_product(v, normal) AS s FROM vectors, planes),
        hashed AS (
          SELECT vec_id, t, sum(CASE WHEN s >= 0 THEN 2 ** b ELSE 0 END)::BIGINT AS h FROM sides GROUP BY ALL),
        patterns AS (SELECT * FROM (VALUES {_pattern_rows()}) AS p(p, place, flip)),
        flips AS (
          SELECT vec_id, t, p, sum(flip * 2 ** b)::BIGINT AS mask
          FROM (SELECT *, row_number() OVER (PARTITION BY vec_id, t ORDER BY abs(s), b) - 1 AS place FROM sides)
          JOIN patterns USING (place) GROUP BY ALL),
        probed AS (SELECT vec_id, t, xor(h, mask) AS h FROM hashed JOIN flips USING (vec_id, t)),
        candidates AS (
          SELECT DISTINCT a.vec_id AS target_key, b.vec_id AS master_key
          FROM probed a JOIN hashed b USING (t, h)),
        found AS (
          SELECT target_key, master_key, round(list_inner_product(x.v, y.v), 6) AS score
          FROM candidates JOIN vectors x ON x.vec_id = target_key JOIN vectors y ON y.vec_id = master_key)
        {_top('found', 3)}""",
    "match_lookup": f"""
        WITH {MATCHES_SQL}
        SELECT target_key, master_key, score, equipment_type, equipment_description
        FROM best JOIN records ON doc_id = master_key""",
    "best_match": f"""
        WITH {MATCHES_SQL}
        SELECT r.doc_id AS target_key, b.score IS NOT NULL AS found_matches,
               coalesce(b.score, 0) AS best_score, b.score IS NOT NULL AS fills_equipment_type
        FROM records r LEFT JOIN best b ON r.doc_id = b.target_key WHERE r.equipment_type IS NULL""",
    "semantic_fill": f"""
        WITH {MATCHES_SQL}
        SELECT doc_id, equipment_type, equipment_description, equipment_type_similarity_score FROM completed""",
    "score_stats": f"WITH {MATCHES_SQL}, {_STATS_SQL} SELECT * FROM score_stats",
    "completion_stats": f"""
        WITH {MATCHES_SQL}, {_STATS_SQL}
        SELECT field, originally_missing, originally_missing - still_missing AS filled_by_pipeline,
               still_missing, CASE WHEN originally_missing > 0 THEN printf('%.1f%%',
                 (originally_missing - still_missing) * 100.0::DOUBLE / originally_missing)
               ELSE '0%' END AS completion_rate
        FROM stats""",
    "completion_report": f"""
        WITH {MATCHES_SQL}, {_STATS_SQL}
        SELECT 'records' AS section, 'total' AS subject, 'original_records' AS metric,
               count(*)::DOUBLE AS value FROM records
        UNION ALL SELECT 'records', 'total', 'total_records', count(*) FROM completed
        UNION ALL SELECT 'completion', field, 'originally_missing', originally_missing FROM stats
        UNION ALL SELECT 'completion', field, 'filled_by_pipeline', originally_missing - still_missing FROM stats
        UNION ALL SELECT 'completion', field, 'still_missing', still_missing FROM stats
        UNION ALL SELECT 'completion', field, 'completion_percent', CASE WHEN originally_missing > 0
          THEN round((originally_missing - still_missing) * 100.0::DOUBLE / originally_missing, 1)
          ELSE 0 END FROM stats
        UNION ALL SELECT 'scores', "column", 'mean_score', mean_score FROM score_stats
        UNION ALL SELECT 'scores', "column", 'median_score', median_score FROM score_stats
        UNION ALL SELECT 'scores', "column", 'min_score', min_score FROM score_stats
        UNION ALL SELECT 'scores', "column", 'max_score', max_score FROM score_stats
        UNION ALL SELECT 'scores', "column", 'scores_available', scores_available FROM score_stats""",
    "embed_texts": _EMBEDDED_SQL,
    "embed_cached": _EMBEDDED_SQL,
    "lexical_vectors": r"""
        WITH tokens AS (
          SELECT doc_id, unnest(string_split(lower(trim(regexp_replace(text, '\s+', ' ', 'g'))), ' ')) AS token
          FROM documents),
        counts AS (SELECT doc_id, token, count(*) AS n FROM tokens WHERE token <> '' GROUP BY ALL)
        SELECT doc_id, token, round(n / sqrt(sum(n * n) OVER (PARTITION BY doc_id)), 9) AS weight FROM counts""",
    "mean_pool_vectors": f"WITH {VECTORS_SQL} SELECT label, pos, round(x, 6) AS x FROM means",
    "vector_stats": f"""
        WITH {VECTORS_SQL}, {_PLACED}, sizes AS (
          SELECT cell, count(*) AS n, min(len(v)) AS lo, max(len(v)) AS hi FROM placed GROUP BY cell)
        SELECT sum(n)::BIGINT AS total_vectors, min(lo) AS min_dimension, max(hi) AS max_dimension,
               count(*) AS cells, min(n) AS min_cell_rows, max(n) AS max_cell_rows FROM sizes""",
    "vector_validation": """
        SELECT 'vectors' AS "check", count(*) AS value FROM embeddings
        UNION ALL SELECT 'repeated_keys', count(*) - count(DISTINCT vec_id) FROM embeddings
        UNION ALL SELECT 'without_values', count(*) FILTER (embedding IS NULL OR len(embedding) = 0) FROM embeddings
        UNION ALL SELECT 'dimension_spread', max(len(embedding)) - min(len(embedding)) FROM embeddings
        UNION ALL SELECT 'records_without_vector', count(*) FROM documents
          WHERE doc_id NOT IN (SELECT vec_id FROM embeddings)""",
    "complete_records": f"WITH {MATCHES_SQL} SELECT * FROM completed",
    "complete_without_gaps": """
        SELECT doc_id, CAST(quality AS VARCHAR) AS equipment_type, text AS equipment_description
        FROM documents JOIN labels USING (doc_id)
        WHERE quality IS NOT NULL AND text IS NOT NULL""",
}
