"""Queries on content checks, incremental loading, mergeable profiles and what a column's content decides, each with its SQL."""

from __future__ import annotations

from pyspark.sql import functions as F

from gapweave.catalog.fixtures import REGISTER_SQL, extracts, register, table
from gapweave.functions.text import quoted
from gapweave.operators.combine import union_by_name
from gapweave.operators.date_vote import format_votes, parse_dates_by_vote
from gapweave.operators.distinct import distinct_rows
from gapweave.operators.fingerprint import compare_content, content_facts
from gapweave.operators.profile import column_info
from gapweave.operators.states import STANDARD_ERROR, merge_states, state_profile
from gapweave.sources.codes import decode_stored, encode_stored, extend_codes, stored_codes
from gapweave.sources.files import discover_files, load_files, quarantine
from gapweave.sources.manifest import refresh, snapshot, stored_states, stored_summary
from gapweave.sources.sinks import read_saved, write_parquet
from gapweave.storage import remove_scratch, scratch_path

_COLUMNS = (
    "Chngd On", "Created on", "Equipment", "Equipment description", "Manufacturer of Asset", "Nation", "ObjectType", "Size",
)
#: Copies of the register that something happened to.
_CHANGES = ("none", "swapped", "lost_copy", "changed_cell", "moved_null")


def _doubled(spark, sf):
    """The register with all parts twice, so that a lost copy leaves every distinct row in place."""
    parts = extracts(spark, sf)["part"]
    return union_by_name([register(spark, sf), parts])


def _changed(df, change: str):
    maker, is_part = quoted("Manufacturer of Asset"), quoted("Size").isNotNull()
    first, second = (is_part & (quoted("Equipment") == key) for key in ("1", "2"))
    if change == "swapped":
        names = quoted("Equipment description")
        ends = df.where(first | second).groupBy().agg(
            F.max(F.when(first, names)).alias("_one"), F.max(F.when(second, names)).alias("_two")
        )
        swapped = F.when(first, F.col("_two")).when(second, F.col("_one")).otherwise(names)
        return df.crossJoin(F.broadcast(ends)).withColumn("Equipment description", swapped).drop("_one", "_two")
    if change == "changed_cell":
        return df.withColumn("Manufacturer of Asset", F.when(first, F.lit("nobody")).otherwise(maker))
    if change == "moved_null":
        return df.withColumn("Nation", F.when(first, quoted("Size")).otherwise(quoted("Nation"))).withColumn(
            "Size", F.when(first, F.lit(None)).otherwise(quoted("Size"))
        )
    return df


def verify_content(spark, sf):
    """Whether each copy, once written, has the content of the register, by column and by row."""
    expected = content_facts(_doubled(spark, sf).select(*map(quoted, _COLUMNS)))
    found = None
    for change in _CHANGES:
        df = register(spark, sf) if change == "lost_copy" else _changed(_doubled(spark, sf), change)
        df = df.select(*map(quoted, _COLUMNS))
        path = write_parquet(df, scratch_path(spark, "copy") + ".parquet")
        compared = compare_content(content_facts(read_saved(spark, path, df.schema)), expected)
        row = compared.select(F.lit(change).alias("change"), "level", "column", "same")
        found = row if found is None else found.unionByName(row)
    return found


def _verify_content_sql() -> str:
    base = ", ".join(f'"{c}"' for c in _COLUMNS)
    first, second = ("\"Size\" IS NOT NULL AND \"Equipment\" = '1'", "\"Size\" IS NOT NULL AND \"Equipment\" = '2'")

    def copy(change: str) -> str:
        if change == "lost_copy":
            return f"SELECT {base} FROM register"
        name = '"Equipment description"'
        cells = {
            "swapped": {name: f"CASE WHEN {first} THEN (SELECT max({name}) FROM doubled WHERE {second}) "
                              f"WHEN {second} THEN (SELECT max({name}) FROM doubled WHERE {first}) ELSE {name} END"},
            "changed_cell": {'"Manufacturer of Asset"': f"CASE WHEN {first} THEN 'nobody' ELSE \"Manufacturer of Asset\" END"},
            "moved_null": {'"Nation"': f'CASE WHEN {first} THEN "Size" ELSE "Nation" END',
                           '"Size"': f'CASE WHEN NOT ({first}) THEN "Size" END'},
        }.get(change, {})
        return "SELECT " + ", ".join(f'{cells.get(f"{chr(34)}{c}{chr(34)}", chr(34) + c + chr(34))} AS "{c}"' for c in _COLUMNS) + " FROM doubled"

    copies = ", ".join(f"{change} AS ({copy(change)})" for change in _CHANGES)

    def row(change: str, column: str) -> str:
        of, level = (f'"{column}"', "column") if column else (base, "row")
        counts = lambda t: f"SELECT {of}, count(*) AS n FROM {t} GROUP BY {of}"
        differ = " UNION ALL ".join(
            f"(SELECT * FROM ({counts(a)}) EXCEPT SELECT * FROM ({counts(b)}))" for a, b in ((change, "doubled"), ("doubled", change))
        )
        return f"SELECT '{change}' AS change, '{level}' AS level, '{column}' AS \"column\", NOT EXISTS ({differ}) AS same"

    rows = " UNION ALL ".join(row(change, column) for change in _CHANGES for column in (*_COLUMNS, ""))
    return (
        f"WITH {REGISTER_SQL}, doubled AS (SELECT * FROM register UNION ALL BY NAME SELECT * FROM part_extract), {copies} {rows}"
    )


def _store(spark, sf) -> str:
    """A store after two runs: in between a source went, two came, and the parts, half of them so far, were completed."""
    base, found = scratch_path(spark, "extracts"), extracts(spark, sf)
    store = scratch_path(spark, "store")
    half = found["part"].where(quoted("Equipment").cast("bigint") % 2 == 0).drop("Size")
    write_parquet(half.withColumn("Half", F.lit("1")), f"{base}/part.parquet")
    write_parquet(found["customer"], f"{base}/customer.parquet")
    write_parquet(found["orders"], f"{base}/orders.parquet")
    refresh(spark, base, store, "*.parquet")
    for name in ("customer", "part"):
        remove_scratch(spark, f"{base}/{name}.parquet")
    for name in ("part", "lineitem"):
        write_parquet(found[name], f"{base}/{name}.parquet")
    refresh(spark, base, store, "*.parquet")
    return store


def incremental_load(spark, sf):
    return snapshot(spark, _store(spark, sf))


def incremental_summary(spark, sf):
    return stored_summary(spark, _store(spark, sf))


def merged_profile(spark, sf):
    """Profile of all stored sources from the states of each, beside the exact distinct counts."""
    store = _store(spark, sf)
    rows = stored_summary(spark, store).agg(F.sum("rows")).first()[0]
    merged = merge_states(stored_states(spark, store))
    exact = column_info(snapshot(spark, store)).select("column", F.col("unique_values").alias("exact"))
    smallest = merged.select("column", F.array_join("smallest", "|").alias("smallest"))
    close = F.abs(F.col("unique_values") - F.col("exact")) <= F.ceil(4 * STANDARD_ERROR * F.col("exact"))
    return (
        state_profile(merged, rows).join(smallest, "column").join(exact, "column")
        .select("column", "rows", "non_null_count", "null_count", "completeness_percent", "bytes", "smallest", close.alias("close"))
    )


#: Customers that ordered before this day are coded by a first run, all others by a second one.
_FIRST_RUN = "1995-03-01"


def dictionary_append(spark, sf):
    """Orders with the codes of two runs: the second one codes new customers without changing a code of the first."""
    customer = F.col("o_custkey").cast("string")
    orders = table(spark, sf, "orders").select("o_orderkey", "o_orderdate", customer.alias("customer"), "o_orderpriority")
    columns, store = ["customer", "o_orderpriority"], scratch_path(spark, "codes")
    first = extend_codes(orders.where(F.col("o_orderdate") < F.lit(_FIRST_RUN).cast("timestamp")), columns, store)
    second = extend_codes(orders, columns, store)
    encoded = encode_stored(orders.drop("o_orderdate"), columns, store, "o_orderkey", second)
    decoded = decode_stored(encoded.drop(*columns), columns, store, "o_orderkey", second)
    known = stored_codes(spark, store, first).where("column = 'customer'").select(
        F.col("value").alias("customer"), F.col("code").alias("first_code")
    )
    return decoded.join(F.broadcast(known), "customer", "left").select(
        "o_orderkey", "customer", "o_orderpriority", "customer_code", "o_orderpriority_code", "first_code"
    )


def distinct_by_hash(spark, sf):
    """The register with its parts twice, once each row."""
    return distinct_rows(_doubled(spark, sf).select(*map(quoted, _COLUMNS)))


#: Offices write the day of shipping in formats of their own; those of the first two cannot be told apart by every value.
_OFFICE_FORMATS = ("MM/dd/yyyy", "dd/MM/yyyy", "yyyy-MM-dd")


def _shipped(spark, sf):
    office = F.col("l_suppkey") % 3
    day = F.date_format("l_shipdate", "MM/dd/yyyy")
    for number, pattern in enumerate(_OFFICE_FORMATS[1:], 1):
        day = F.when(office == number, F.date_format("l_shipdate", pattern)).otherwise(day)
    return table(spark, sf, "lineitem").select(
        "l_orderkey", "l_linenumber", F.concat(F.lit("office"), office.cast("string")).alias("office"), day.alias("shipped")
    )


def dates_by_vote(spark, sf):
    """Days of shipping as timestamps, each by the format of its office."""
    return parse_dates_by_vote(_shipped(spark, sf), ["shipped"], _OFFICE_FORMATS, "office")


def date_votes(spark, sf):
    votes = format_votes(_shipped(spark, sf), ["shipped"], _OFFICE_FORMATS, "office")
    fits = [F.get("fits", F.lit(i)).alias(name) for i, name in enumerate(("month_first", "day_first", "year_first"))]
    return votes.select("source", "values", *fits, F.get("formats", F.lit(0)).alias("format"))


def _orders_lines(spark, sf):
    """Orders as lines of JSON; of every fifth the end is lost, and every seventh is no object at all."""
    key = F.col("o_orderkey")
    line = F.concat(
        F.lit('{"id":"'), key.cast("string"), F.lit('","priority":"'), F.col("o_orderpriority"), F.lit('"}')
    )
    lost = F.when(key % 7 == 0, F.concat(F.lit("order "), key.cast("string"))).when(key % 5 == 0, F.substr(line, F.lit(1), F.lit(18)))
    return table(spark, sf, "orders").select(F.coalesce(lost, line).alias("value"))


def quarantined_rows(spark, sf):
    """Accepted orders beside the lines that were put aside, with the reason; `placed` if file and record are known."""
    base = scratch_path(spark, "lines")
    _orders_lines(spark, sf).write.text(f"{base}/orders.json")
    load = load_files(spark, discover_files(spark, base, "*.json"), "json", keep_rejects=True)
    none = F.lit(None).cast("string")
    good = load.df.select("id", "priority", none.alias("raw"), none.alias("reason"), F.lit(True).alias("placed"))
    placed = F.col("file").isNotNull() & (F.col("record") > 0)
    return good.unionByName(
        quarantine(load).select(none.alias("id"), none.alias("priority"), "raw", "reason", placed.alias("placed"))
    )


QUERIES = {
    "distinct_by_hash": distinct_by_hash,
    "dates_by_vote": dates_by_vote,
    "date_votes": date_votes,
    "quarantined_rows": quarantined_rows,
    "dictionary_append": dictionary_append,
    "verify_content": verify_content,
    "incremental_load": incremental_load,
    "incremental_summary": incremental_summary,
    "merged_profile": merged_profile,
}

_STORED_SQL = f"""{REGISTER_SQL}, stored AS (
  SELECT 'part' AS _source, * FROM part_extract
  UNION ALL BY NAME SELECT 'orders' AS _source, * FROM orders_extract
  UNION ALL BY NAME SELECT 'lineitem' AS _source, * FROM lineitem_extract)"""
_STORED_COLUMNS = [c for c in _COLUMNS if c != "Nation"]


def _profile_sql(column: str) -> str:
    c = f'"{column}"'
    return f"""
    SELECT '{column}' AS "column", count(*) AS "rows", count({c}) AS non_null_count, count(*) - count({c}) AS null_count,
           round(count({c}) * 100.0::DOUBLE / count(*), 2) AS completeness_percent, sum(octet_length(encode({c}))) AS bytes,
           (SELECT string_agg(v, '|' ORDER BY v) FROM (SELECT DISTINCT {c} AS v FROM stored WHERE {c} IS NOT NULL ORDER BY v LIMIT 5))
             AS smallest, true AS close
    FROM stored"""


_SHIPPED_SQL = """shipped AS (
  SELECT l_orderkey, l_linenumber, 'office' || l_suppkey % 3 AS office, l_suppkey % 3 AS n, l_shipdate AS d FROM lineitem)"""

ORACLE = {
    "distinct_by_hash": f"""
        WITH {REGISTER_SQL} SELECT DISTINCT {", ".join(f'"{c}"' for c in _COLUMNS)} FROM register""",
    "dates_by_vote": f"""
        WITH {_SHIPPED_SQL}
        SELECT l_orderkey, l_linenumber, office, CAST(CAST(d AS DATE) AS TIMESTAMP) AS shipped FROM shipped""",
    "date_votes": f"""
        WITH {_SHIPPED_SQL}
        SELECT office AS source, count(*) AS values,
               count(*) FILTER (n = 0 OR (n = 1 AND day(d) <= 12)) AS month_first,
               count(*) FILTER (n = 1 OR (n = 0 AND day(d) <= 12)) AS day_first,
               count(*) FILTER (n = 2) AS year_first,
               CASE n WHEN 0 THEN 'MM/dd/yyyy' WHEN 1 THEN 'dd/MM/yyyy' ELSE 'yyyy-MM-dd' END AS format
        FROM shipped GROUP BY office, n""",
    "quarantined_rows": """
        WITH lines AS (
          SELECT o_orderkey AS k, o_orderpriority AS p, '{"id":"' || o_orderkey || '","priority":"' || o_orderpriority || '"}' AS line
          FROM orders)
        SELECT CASE WHEN k % 7 <> 0 AND k % 5 <> 0 THEN CAST(k AS VARCHAR) END AS id,
               CASE WHEN k % 7 <> 0 AND k % 5 <> 0 THEN p END AS priority,
               CASE WHEN k % 7 = 0 THEN 'order ' || k WHEN k % 5 = 0 THEN substr(line, 1, 18) END AS raw,
               CASE WHEN k % 7 = 0 THEN 'no JSON object' WHEN k % 5 = 0 THEN 'JSON object not whole' END AS reason,
               true AS placed
        FROM lines""",
    "dictionary_append": f"""
        WITH seen AS (
          SELECT CAST(o_custkey AS VARCHAR) AS customer, min(o_orderdate) < TIMESTAMP '{_FIRST_RUN}' AS early FROM orders GROUP BY 1),
        codes AS (SELECT customer, early, row_number() OVER (ORDER BY early DESC, customer) - 1 AS code FROM seen),
        priorities AS (
          SELECT o_orderpriority AS p, row_number() OVER (ORDER BY min(o_orderdate) >= TIMESTAMP '{_FIRST_RUN}', o_orderpriority) - 1 AS code
          FROM orders GROUP BY 1)
        SELECT o_orderkey, customer, o_orderpriority, codes.code AS customer_code, priorities.code AS o_orderpriority_code,
               CASE WHEN early THEN codes.code END AS first_code
        FROM orders JOIN codes ON customer = CAST(o_custkey AS VARCHAR) JOIN priorities ON p = o_orderpriority""",
    "verify_content": _verify_content_sql(),
    "incremental_load": f"WITH {_STORED_SQL} SELECT * FROM stored",
    "incremental_summary": f"""
        WITH {_STORED_SQL}
        SELECT _source AS source, count(*) AS "rows", CASE _source WHEN 'part' THEN 5 ELSE 3 END AS columns,
               0 AS rows_rejected, 'ok' AS verdict
        FROM stored GROUP BY _source""",
    "merged_profile": f"WITH {_STORED_SQL} " + " UNION ALL ".join(map(_profile_sql, _STORED_COLUMNS)),
}
