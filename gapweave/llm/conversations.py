"""The registered queries over `conversations`, and their SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from gapweave.llm import prefixes, repair


def op11_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    return repair.repair_damaged(spark.read.parquet(f"{sf_dir}/conversations.parquet"))


def op12_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    return prefixes.prefix_trie(spark.read.parquet(f"{sf_dir}/conversations.parquet"))


def _crc32(text: str) -> str:
    """Unsigned CRC-32 of an ASCII text, bit by bit."""
    step = "CASE WHEN x % 2 = 1 THEN xor(x // 2, 3988292384) ELSE x // 2 END"
    byte = f"list_reduce(list_prepend(xor(c, b), [0::BIGINT, 0, 0, 0, 0, 0, 0, 0]), lambda x, i: {step})"
    codes = f"list_transform(string_split({text}, ''), lambda k: CAST(ord(k) AS BIGINT))"
    return f"xor(list_reduce(list_prepend(4294967295::BIGINT, {codes}), lambda c, b: {byte}), 4294967295)"


_WORD = r"[^\x20\x09-\x0D]"


def _repair_sql() -> str:
    """Walks each conversation from its last row; a state's value is its least cost, six digits, and audit as one text."""
    follow = {"n": "u", "s": "u", "u": "a", "a": "u"}

    def plus(cost: str, letters: str, state: str) -> str:
        return f"printf('%06d', CAST(left(f_{state}, 6) AS INTEGER) + {cost}) || '{letters}' || substr(f_{state}, 7)"

    def best(state: str) -> str:
        ways, now = [], state
        for inserts in range(3):
            paid, pre = 2 * inserts, "I" * inserts
            ways.append(plus(f"{paid + 3}", pre + "D", now))
            ways.append(f"CASE WHEN NOT gone THEN {plus(f'{paid + 2} + late', pre + 'R', follow[now])} ELSE 'z' END")
            for initial, from_states in (("s", "n" if not inserts else ""), ("u", "nsa"), ("a", "u")):
                if now in from_states:
                    keep = plus(f"{paid} + late", pre + "K", initial)
                    ways.append(f"CASE WHEN NOT gone AND initial = '{initial}' THEN {keep} ELSE 'z' END")
            now = follow[now]
        return f"least({', '.join(ways)}) AS f_{state}"

    conv = "coalesce(CAST(conv_id AS VARCHAR), ' ')"
    key = f"{conv} || ':' || coalesce(CAST(turn AS VARCHAR), ' ')"
    return rf"""
    WITH RECURSIVE hit AS (
      SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text, {_crc32(key)} % 20 AS fault
      FROM conversations),
    damaged AS (
      SELECT conv_id, turn, CASE WHEN fault = 4 THEN 'user' ELSE role END AS role,
             CASE fault WHEN 1 THEN '' WHEN 2 THEN regexp_replace(text, '[.!?]', '', 'g') ELSE text END AS text
      FROM hit, range(2) AS copies(copy) WHERE fault <> 0 AND (copy = 0 OR fault = 3)),
    numbered AS (
      SELECT *, left(role, 1) AS initial, {conv} AS c,
             row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, sha256(text)) AS n,
             NOT regexp_matches(text, '{_WORD}') AS blank,
             NOT regexp_matches(text, '[.!?][\x20\x09-\x0D]*$') AS cut
      FROM damaged),
    seen AS (SELECT *, row_number() OVER (PARTITION BY conv_id, role, text ORDER BY n) > 1 AS again FROM numbered),
    faults AS (
      SELECT *, again AND NOT blank AS duplicate, cut AND NOT blank AND NOT again AS truncated, blank OR again AS gone,
             CAST(cut AND NOT blank AND NOT again AS INTEGER) AS late,
             lag(initial) OVER (PARTITION BY conv_id ORDER BY n) || initial AS pair
      FROM seen),
    walk AS (
      SELECT c, max(n) AS n, '000000' AS f_n, '000004II' AS f_s, '000002I' AS f_u, '000000' AS f_a FROM faults GROUP BY c
      UNION ALL
      SELECT c, n - 1, {best("n")}, {best("s")}, {best("u")}, {best("a")} FROM walk JOIN faults USING (c, n)),
    audits AS (SELECT c, CAST(left(f_n, 6) AS BIGINT) AS cost, substr(f_n, 7) AS audit FROM walk WHERE n = 0),
    letters AS (
      SELECT c, i, audit[i] AS letter,
             length(replace(left(audit, i), 'I', '')) AS n, length(replace(left(audit, i), 'D', '')) AS place
      FROM (SELECT c, audit, unnest(range(1, length(audit) + 1)) AS i FROM audits)),
    lines AS (
      SELECT letters.*, CASE WHEN letter = 'I' THEN '' ELSE text END AS text, role,
             max(CAST(letter = 'K' AND initial = 's' AS INTEGER)) OVER (PARTITION BY c) AS s
      FROM letters LEFT JOIN faults USING (c, n) WHERE letter <> 'D'),
    repaired AS (
      SELECT c, sha256(string_agg(
        CASE WHEN letter = 'K' THEN role WHEN (place - s) % 2 = 1 THEN 'user' ELSE 'assistant' END || ':' || text,
        chr(10) ORDER BY i)) AS sha
      FROM lines GROUP BY c),
    counts AS (
      SELECT c, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0) AS gaps,
             count(*) FILTER (blank) AS blank, count(*) FILTER (duplicate) AS duplicate,
             count(*) FILTER (truncated) AS truncated,
             count(*) FILTER (pair IS NOT NULL AND pair NOT IN ('su', 'ua', 'au')) AS illegal
      FROM faults GROUP BY c)
    SELECT conv_id, coalesce(gaps, 0) AS gaps, coalesce(blank, 0) AS blank, coalesce(duplicate, 0) AS duplicate,
           coalesce(truncated, 0) AS truncated, coalesce(illegal, 0) AS illegal, coalesce(cost, 0) AS cost,
           coalesce(audit, '') AS audit, coalesce(sha, sha256('')) AS repaired_sha256
    FROM (SELECT DISTINCT conv_id, {conv} AS c FROM conversations)
    LEFT JOIN counts USING (c) LEFT JOIN audits USING (c) LEFT JOIN repaired USING (c)
    """


#: A prefix is the list of its turns itself, so nothing here is a digest but the result.
_TRIE_SQL = rf"""
WITH own AS (
  SELECT conv_id, coalesce(role, '') AS role, coalesce(text, '') AS text,
         row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, coalesce(role, ''),
           sha256(length(coalesce(role, '')) || ':' || coalesce(role, '') || coalesce(text, ''))) - 1 AS place
  FROM conversations WHERE conv_id IS NOT NULL),
convs AS (
  SELECT conv_id, {_crc32("CAST(conv_id AS VARCHAR)")} % 4 AS h FROM (SELECT DISTINCT conv_id FROM own)),
turns AS (
  SELECT c.conv_id, 0 AS part, place, role, text FROM convs c JOIN own o ON o.conv_id = c.conv_id - c.conv_id % 20 AND place < h
  UNION ALL
  SELECT c.conv_id, 1, place, role, text FROM convs c JOIN own o ON o.conv_id = c.conv_id AND place >= h),
rebuilt AS (
  SELECT conv_id, coalesce(all_turns, []) AS turns
  FROM convs LEFT JOIN (
    SELECT conv_id, list({{'role': role, 'text': text}} ORDER BY part, place) AS all_turns FROM turns GROUP BY conv_id)
  USING (conv_id)),
members AS (
  SELECT conv_id, d AS depth, turns[:d] AS node, len(turns) = d AS ends
  FROM rebuilt, unnest(range(0, len(turns) + 1)) AS u(d)),
nodes AS (
  SELECT node, depth, min(conv_id) AS conv_id, count(*) AS n_convs,
         sha256(coalesce(string_agg(CAST(conv_id AS VARCHAR), ',' ORDER BY conv_id) FILTER (ends), '')) AS ends_sha256
  FROM members GROUP BY node, depth),
valued AS (
  SELECT *, CASE WHEN depth = 0 THEN 0 ELSE
           (n_convs - 1) * len(regexp_extract_all(node[depth].text, '{_WORD}+')) END AS value,
         CASE WHEN depth > 0 THEN node[:depth - 1] END AS parent
  FROM nodes),
children AS (SELECT parent AS node, count(*) AS n_children FROM valued WHERE parent IS NOT NULL GROUP BY parent),
whole AS (SELECT *, coalesce(n_children, 0) AS kids FROM valued LEFT JOIN children USING (node)),
subtrees AS (
  SELECT node[:d] AS node, sum(value) AS saved, count(*) FILTER (kids = 0) AS n_leaves
  FROM whole, unnest(range(0, depth + 1)) AS u(d) GROUP BY node[:d])
SELECT w.conv_id, w.depth, p.conv_id AS parent_conv_id, w.n_convs, w.kids AS n_children, n_leaves,
       CAST(saved AS BIGINT) AS saved_tokens, w.ends_sha256
FROM whole w JOIN subtrees USING (node) LEFT JOIN nodes p ON p.node = w.parent
"""

QUERIES = {"op11_repair": op11_repair, "op12_trie": op12_trie}
ORACLE = {"op11_repair": _repair_sql(), "op12_trie": _TRIE_SQL}
