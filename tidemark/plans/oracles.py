"""The same queries in SQL, written against the benchmark tables."""

from __future__ import annotations

HOUR = 3_600_000_000_000
DAY = 24 * HOUR

# Nanoseconds of 2024-01-01 and 2024-01-31.
JAN_1 = 19723 * DAY
JAN_31 = 19753 * DAY

TABLES = {
    "samples": """
        SELECT 'u' || user_id AS series_id, epoch_us(ts) * 1000 AS "index", value FROM events""",
    "by_type": """
        SELECT event_type AS series_id, epoch_us(ts) * 1000 AS "index", value FROM events""",
    "line_samples": """
        SELECT l_returnflag AS series_id, epoch_us(l_shipdate) * 1000 + l_orderkey AS "index",
               l_quantity AS value
        FROM lineitem""",
    "uploads": """
        SELECT 'u' || user_id AS series_id, 0 AS file_seq, epoch_us(ts) * 1000 AS "index", value
        FROM events
        UNION ALL
        SELECT 'u' || user_id, 1, epoch_us(ts) * 1000,
               CASE WHEN event_type = 'error' THEN value * 10 END
        FROM events WHERE event_type IN ('error', 'purchase')
        UNION ALL
        SELECT 'u' || user_id, 2, epoch_us(ts) * 1000, value + 1 FROM events WHERE value > 60""",
    "resolved": """
        SELECT series_id, "index", value FROM (
            SELECT *, row_number() OVER (
                PARTITION BY series_id, "index" ORDER BY value IS NULL, file_seq DESC) AS rn
            FROM uploads)
        WHERE rn = 1""",
    "order_uploads": """
        SELECT 'c' || o_custkey AS series_id, o_custkey || '-' || o_orderpriority AS file_id,
               o_orderkey AS pos,
               CASE WHEN NOT (o_orderstatus = 'P' AND o_orderpriority = '5-LOW')
                    THEN epoch_us(o_orderdate) * 1000 END AS "index"
        FROM orders""",
    "order_steps": """
        SELECT *, lag("index") OVER (PARTITION BY file_id ORDER BY pos) AS before
        FROM order_uploads""",
    "verdicts": """
        SELECT series_id, file_id, count(*) AS n_rows,
               count(*) FILTER (WHERE "index" IS NULL) AS n_unreadable,
               count(*) FILTER (WHERE "index" < before) AS n_back,
               count(*) FILTER (WHERE "index" = before) AS n_repeat,
               CASE WHEN bool_and("index" IS NOT NULL AND (before IS NULL OR "index" > before))
                    THEN 'Ready' ELSE 'Failed' END AS state
        FROM order_steps GROUP BY series_id, file_id""",
    "metadata": """
        SELECT md5(length('customer.' || lower(c_mktsegment)) || ':customer.' || lower(c_mktsegment) || c_name) AS metadata_id,
               'customer.' || lower(c_mktsegment) AS namespace, c_name AS key,
               '{"nation":"' || n_name || '","nationkey":"' || c_nationkey || '"}' AS value_json,
               n_name AS nation, NULL AS region
        FROM customer JOIN nation ON c_nationkey = n_nationkey
        UNION ALL
        SELECT md5('6:nation' || n_name), 'nation', n_name,
               '{"region":"' || n_regionkey || '"}', NULL, n_regionkey::VARCHAR
        FROM nation""",
    "links": """
        SELECT 'u' || c_custkey AS series_id,
               md5(length('customer.' || lower(c_mktsegment)) || ':customer.' || lower(c_mktsegment) || c_name) AS metadata_id
        FROM customer WHERE c_acctbal >= 0
        UNION ALL
        SELECT 'u' || c_custkey, md5('6:nation' || n_name)
        FROM customer JOIN nation ON c_nationkey = n_nationkey""",
    "segment_links": """
        SELECT 'u' || c_custkey AS series_id, md5('7:segment' || c_mktsegment) AS metadata_id
        FROM customer
        UNION ALL
        SELECT 'u' || c_custkey, md5(length('customer.' || lower(c_mktsegment)) || ':customer.' || lower(c_mktsegment) || c_name)
        FROM customer""",
    "extents": """
        SELECT 'u' || c_custkey AS series_id, c_name AS alias,
               coalesce(min(epoch_us(ts) * 1000), 0) AS first_index,
               coalesce(max(epoch_us(ts) * 1000), -1) AS last_index,
               count(event_id) AS n_samples
        FROM customer LEFT JOIN events ON user_id = c_custkey
        GROUP BY c_custkey, c_name""",
    "updates": """
        SELECT 'customer.' || lower(c_mktsegment) AS namespace, c_name AS key,
               '{"segment":"' || c_mktsegment || '"}' AS value_json
        FROM customer WHERE c_mktsegment = 'BUILDING'
        UNION ALL
        SELECT 'supplier', s_name, '{"nationkey":"' || s_nationkey || '"}' FROM supplier""",
    "listing": """
        SELECT 'u' || user_id AS series_id, epoch_us(ts) // 86400000000 AS day,
               'u' || user_id || '/day/csv/' || (epoch_us(ts) // 86400000000) || '.csv' AS path,
               count(*) AS n_now, count(*) FILTER (WHERE event_type <> 'error') AS n_before
        FROM events GROUP BY ALL""",
    "grid_6h": f"""
        SELECT 'u' || c_custkey AS series_id, unnest(range({JAN_1}, {JAN_31}, {6 * HOUR})) AS "index"
        FROM customer""",
    "grid_24h": f"""
        SELECT 'u' || c_custkey AS series_id, unnest(range({JAN_1}, {JAN_31}, {DAY})) AS "index"
        FROM customer""",
}

# The tables each one above is made from.
NEEDS = {
    "resolved": ["uploads"],
    "order_steps": ["order_uploads"],
    "verdicts": ["order_uploads", "order_steps"],
}


def sql(tables: str, body: str) -> str:
    """``body`` preceded by the tables it names, and by those they need."""
    wanted: list[str] = []
    for name in tables.split():
        for each in [*NEEDS.get(name, []), name]:
            if each not in wanted:
                wanted.append(each)
    if not wanted:
        return body.strip()
    return "WITH " + ",\n".join(f"{n} AS ({TABLES[n]})" for n in wanted) + "\n" + body.strip()


def binned(source: str, width: int, value: str, start: int = JAN_1, end: int = JAN_31) -> str:
    return f"""
        SELECT series_id, "index" - "index" % {width} AS "index", {value} AS value
        FROM {source} WHERE "index" >= {start} AND "index" < {end} AND value IS NOT NULL
        GROUP BY 1, 2"""


def _period_units() -> str:
    units = {
        "6h": 6 * HOUR,
        "90m": 90 * 60 * 10**9,
        "45s": 45 * 10**9,
        "500ms": 500 * 10**6,
        "250microseconds": 250_000,
        "tick": 100,
    }
    parts = [
        f"""SELECT *, '{name}' AS period FROM ({binned("samples", width, "max(value)")})"""
        for name, width in units.items()
    ]
    return "\nUNION ALL\n".join(parts)


INFO_COLUMNS = "series_id, alias, first_index, last_index, n_samples"

WEEK = f'"index" >= {19730 * DAY} AND "index" < {19737 * DAY}'

LINES_START, LINES_END = 9131 * DAY, 11688 * DAY

EDGES = 19724 * DAY + 6 * HOUR, 19751 * DAY + 18 * HOUR

ORACLES = {
    "read_lines_first_comma": """
        SELECT event_id, epoch_us(ts) * 1000 AS "index",
               event_type || ',' || user_id AS value_token
        FROM events""",
    "parse_index": """
        SELECT event_id,
               CASE WHEN event_type <> 'error' THEN epoch_us(ts) * 1000 END AS "index"
        FROM events""",
    "infer_value_type": """
        WITH tokens AS (
            SELECT 'u' || user_id AS series_id, (epoch_us(ts) // 86400000000)::INTEGER AS day,
                   epoch_us(ts) * 1000 AS "index", event_type, value
            FROM events),
        kinds AS (
            SELECT series_id, day, bool_or(event_type = 'signup') AS is_text
            FROM tokens GROUP BY ALL)
        SELECT series_id, day, "index",
               CASE WHEN NOT is_text AND event_type <> 'view' THEN value END AS value,
               CASE WHEN NOT is_text OR event_type = 'view' THEN NULL
                    WHEN event_type = 'signup' THEN event_type
                    ELSE value::VARCHAR END AS value_text
        FROM tokens JOIN kinds USING (series_id, day)""",
    "manifest_flatten": """
        WITH chunks AS (
            SELECT DISTINCT 'u' || user_id AS series_id, event_type AS file_id,
                   (epoch_us(ts) // 86400000000)::INTEGER AS day
            FROM events)
        SELECT series_id,
               dense_rank() OVER (PARTITION BY series_id ORDER BY file_id) - 1 AS file_seq,
               file_id,
               (row_number() OVER (PARTITION BY series_id, file_id ORDER BY day) - 1)::INTEGER
                   AS chunk_seq,
               day, series_id || '/' || file_id || '/' || day AS path,
               md5(series_id || '/' || file_id || '/' || day) AS content_md5
        FROM chunks""",
    "index_from_timestamp": sql("samples", "SELECT * FROM samples"),
    "index_to_timestamp": sql(
        "line_samples",
        """SELECT "index", strftime(make_timestamp("index" // 1000), '%Y-%m-%d %H:%M:%S.%f') AS time
           FROM line_samples""",
    ),
    "stored_round_trip": sql("resolved", f"SELECT * FROM resolved WHERE {WEEK}"),
    "chunk_files_round_trip": """
        SELECT event_type AS series_id, epoch_us(ts) * 1000 AS "index",
               CASE WHEN value > 60 THEN -value ELSE value END AS value
        FROM events""",
    "read_series_csv": """
        SELECT epoch_us(ts) * 1000 AS "index", value, NULL::VARCHAR AS value_text FROM events""",
    "read_two_columns": """
        SELECT epoch_us(ts) * 1000 AS "index", value, NULL::VARCHAR AS value_text FROM events""",
    "explode_sample_pages": """
        SELECT event_type AS series_id, epoch_us(ts) * 1000 AS "index", value FROM events""",
    "search_hits_json": r'''
        WITH c AS (
            SELECT *, 'u' || c_custkey AS series_id, 'customer.' || lower(c_mktsegment) AS namespace,
                   CASE WHEN c_nationkey % 2 = 0 THEN '\' ELSE '' END || chr(39) AS quote
            FROM customer JOIN nation ON c_nationkey = n_nationkey)
        SELECT series_id, namespace, c_name AS key, 'O' || chr(39) || c_name AS owner,
               '{"nation":"' || n_name || '","region":' || n_regionkey || '}' AS home,
               c_acctbal::VARCHAR AS balance, '["' || c_mktsegment || '",null,true]' AS tags,
               NULL AS region, NULL AS bad
        FROM c WHERE c_acctbal >= 0
        UNION ALL
        SELECT series_id, NULL, NULL, NULL, NULL, NULL, NULL, NULL,
               replace('{"Namespace":"' || namespace || '","Key":"' || c_name || '","Value":{"owner":"O', '"', chr(39)) ||
               quote || c_name || replace('","ho', '"', chr(39))
        FROM c WHERE c_acctbal < 0
        UNION ALL
        SELECT series_id, 'nation', n_name, NULL, NULL, NULL, NULL, n_regionkey::VARCHAR, NULL FROM c''',
    "export_csv": sql("samples", binned("samples", HOUR, "max(value)")),
    "create_empty_series": """
        SELECT 'u' || c_custkey AS series_id, 1 AS n_aliases FROM customer
        UNION ALL SELECT 's' || s_suppkey, 0 FROM supplier""",
    "format_chunk_lines": """
        SELECT 'u' || user_id AS series_id, (epoch_us(ts) // 86400000000)::INTEGER AS day,
               (epoch_us(ts) * 1000) || ',' ||
               CASE WHEN event_type = 'error' THEN event_type ELSE value::VARCHAR END AS line
        FROM events""",
    "ingest_receipt": sql(
        "order_uploads verdicts",
        """SELECT series_id, file_id,
                  CASE WHEN state = 'Ready' THEN min("index") END AS first_index,
                  CASE WHEN state = 'Ready' THEN max("index") END AS last_index, state
           FROM order_uploads JOIN verdicts USING (series_id, file_id)
           GROUP BY series_id, file_id, state""",
    ),
    "append_overwrite": sql(
        "resolved",
        """SELECT r.series_id, r."index", coalesce(e.value * 2, r.value) AS value
           FROM resolved r LEFT JOIN (SELECT * FROM events WHERE event_type = 'purchase') e
           ON r.series_id = 'u' || e.user_id AND r."index" = epoch_us(e.ts) * 1000""",
    ),
    "delete_series": sql(
        "samples",
        """SELECT * FROM samples WHERE series_id NOT IN (
               SELECT 'u' || c_custkey FROM customer
               WHERE c_acctbal >= 0 AND c_mktsegment = 'MACHINERY')""",
    ),
    "check_sorted": sql(
        "order_uploads order_steps",
        """SELECT series_id, file_id, count(*) FILTER (WHERE "index" < before) = 0 AS is_sorted
           FROM order_steps GROUP BY series_id, file_id""",
    ),
    "check_unique": sql(
        "order_uploads",
        """SELECT series_id, file_id, "index", count(*) AS n FROM order_uploads
           GROUP BY series_id, file_id, "index" HAVING count(*) > 1""",
    ),
    "validate_files": sql("verdicts", "SELECT * FROM verdicts"),
    "ready_rows": sql(
        "verdicts",
        """SELECT series_id, file_id, pos, state = 'Ready' AS kept
           FROM order_uploads JOIN verdicts USING (series_id, file_id)""",
    ),
    "get_range": sql(
        "resolved",
        f"""SELECT *, (row_number() OVER (PARTITION BY series_id ORDER BY "index"))::INTEGER AS place
            FROM resolved WHERE {WEEK}""",
    ),
    "get_all": sql("resolved", "SELECT * FROM resolved"),
    "get_found_series": sql(
        "resolved",
        """SELECT * FROM resolved WHERE series_id IN (
               SELECT 'u' || c_custkey FROM customer JOIN nation ON c_nationkey = n_nationkey
               WHERE n_name LIKE 'NATION\\_1%' ESCAPE '\\' AND n_regionkey::VARCHAR LIKE '%1%')""",
    ),
    "recode_boolean": """
        SELECT 'u' || user_id AS series_id, epoch_us(ts) * 1000 AS "index",
               CASE event_type WHEN 'error' THEN 1.0::DOUBLE WHEN 'purchase' THEN 0.0::DOUBLE END
                   AS value,
               CASE WHEN event_type NOT IN ('error', 'purchase') THEN event_type END AS value_text
        FROM events""",
    "overlay_latest": sql("resolved", "SELECT * FROM resolved"),
    "overlay_mixed": """
        SELECT 'u' || user_id AS series_id, epoch_us(ts) * 1000 AS "index",
               CASE WHEN event_type <> 'error' THEN value END AS value,
               CASE WHEN event_type = 'error' THEN event_type END AS value_text
        FROM events""",
    "overlay_contested": sql("resolved", "SELECT * FROM resolved"),
    "combine_first_join": sql("resolved", "SELECT * FROM resolved"),
    "combine_first_text": """
        SELECT 'u' || user_id AS series_id, epoch_us(ts) * 1000 AS "index",
               CASE WHEN event_type = 'view' THEN value END AS value,
               CASE event_type WHEN 'view' THEN NULL WHEN 'error' THEN 'ERROR' ELSE event_type END
                   AS value_text
        FROM events""",
    "upload_manifest": """
        WITH rows AS (
            SELECT 0 AS file_seq, user_id, ts, 'numeric' AS kind FROM events
            UNION ALL
            SELECT 1, user_id, ts, CASE WHEN event_type = 'error' THEN 'text' ELSE 'numeric' END
            FROM events WHERE event_type IN ('error', 'purchase'))
        SELECT 'u' || user_id AS series_id, file_seq::BIGINT AS file_seq,
               file_seq || '-u' || user_id AS file_id,
               (epoch_us(ts) // 86400000000)::INTEGER AS day, max(kind) AS kind,
               min(epoch_us(ts) * 1000) AS first_index, max(epoch_us(ts) * 1000) AS last_index,
               count(*) AS n_samples
        FROM rows GROUP BY 1, 2, 3, 4""",
    "chunks_by_day": """
        WITH chunks AS (
            SELECT DISTINCT 'u' || user_id AS series_id, event_type AS file_id,
                   (epoch_us(ts) // 86400000000)::INTEGER AS day
            FROM events),
        numbered AS (
            SELECT *, dense_rank() OVER (PARTITION BY series_id ORDER BY file_id) - 1 AS file_seq,
                   (row_number() OVER (PARTITION BY series_id, file_id ORDER BY day) - 1)::INTEGER
                       AS chunk_seq
            FROM chunks)
        SELECT series_id, day, file_seq, chunk_seq, file_id,
               (row_number() OVER (PARTITION BY series_id ORDER BY day, file_seq, chunk_seq))::INTEGER
                   AS place
        FROM numbered""",
    "concat_days": sql("samples", "SELECT * FROM samples"),
    "incremental_manifest": sql(
        "listing",
        """SELECT series_id, day::INTEGER AS day, path,
                  'parquet' || regexp_replace(path, '[-_/.]', '', 'g') AS chunk_key,
                  translate(to_base64(encode(md5(path || '-' || n_now))), '+/', '-_') AS md5_key
           FROM listing WHERE n_now <> n_before""",
    ),
    "incremental_manifest_bucketed": sql(
        "listing",
        """SELECT series_id, day::INTEGER AS day, path,
                  'parquet' || regexp_replace(path, '[-_/.]', '', 'g') AS chunk_key,
                  translate(to_base64(encode(md5(path || '-' || n_now))), '+/', '-_') AS md5_key
           FROM listing WHERE n_now <> n_before""",
    ),
    "overlay_after_merge": sql("resolved", "SELECT * FROM resolved"),
    "delete_rewrites_files": sql(
        "resolved",
        """SELECT * FROM resolved WHERE series_id NOT IN (
               SELECT 'u' || c_custkey FROM customer
               WHERE c_acctbal >= 0 AND c_mktsegment = 'MACHINERY')""",
    ),
    "pivot_blocks": sql("samples", binned("samples", HOUR, "max(value)")),
    "pivot_series": sql(
        "by_type",
        f"""SELECT "index" - "index" % {HOUR} AS "index",
                   max(value) FILTER (WHERE series_id = 'click') AS click,
                   max(value) FILTER (WHERE series_id = 'error') AS error,
                   max(value) FILTER (WHERE series_id = 'purchase') AS purchase,
                   max(value) FILTER (WHERE series_id = 'signup') AS signup,
                   max(value) FILTER (WHERE series_id = 'view') AS view
            FROM by_type GROUP BY 1""",
    ),
    "unpivot_table": """
        SELECT 'size' AS series_id, p_partkey AS "index", p_size::DOUBLE AS value FROM part
        UNION ALL
        SELECT 'p_retailprice', p_partkey, p_retailprice FROM part""",
    "agg_mean": sql("samples", binned("samples", HOUR, "round(avg(value), 6)")),
    "agg_min": sql("samples", binned("samples", HOUR // 4, "min(value)")),
    "agg_max": sql("samples", binned("samples", HOUR // 4, "max(value)")),
    "agg_std": sql("samples", binned("samples", DAY, "round(stddev_samp(value), 6)")),
    "agg_overlaid_mean": sql("resolved", binned("resolved", 6 * HOUR, "round(avg(value), 6)")),
    "agg_hot_series": sql(
        "line_samples",
        binned("line_samples", DAY, "avg(value)", LINES_START, LINES_END),
    ),
    "agg_hot_uploads": f"""
        WITH lines AS (
            SELECT l_returnflag AS series_id, max(l_quantity) AS value,
                   epoch_us(l_shipdate) * 1000 + l_orderkey * 8 + l_linenumber AS "index"
            FROM lineitem GROUP BY l_returnflag, l_shipdate, l_orderkey, l_linenumber),
        raw AS (
            SELECT 0 AS file_seq, * FROM lines
            UNION ALL SELECT 1, series_id, value * 2, "index" FROM lines WHERE series_id = 'R'),
        r AS (
            SELECT series_id, "index", max_by(value, file_seq) AS value FROM raw GROUP BY series_id, "index")
        {binned("r", 8760 * HOUR, "round(avg(value), 6)", LINES_START, LINES_END)}""",
    "agg_rollup_mean": sql("resolved", binned("resolved", 6 * HOUR, "round(avg(value), 6)", *EDGES)),
    "agg_rollup_std": sql("resolved", binned("resolved", 6 * HOUR, "round(stddev_samp(value), 6)", *EDGES)),
    "agg_rollup_max": sql("resolved", binned("resolved", 6 * HOUR, "max(value)", *EDGES)),
    "agg_mean_exact": sql(
        "line_samples",
        binned(
            "line_samples", DAY, "CAST(sum(CAST(value / 8 * 1000000 AS HUGEINT)) AS DOUBLE) / 1000000.0::DOUBLE / count(value)::DOUBLE", LINES_START, LINES_END
        ),
    ),
    "agg_tick": sql(
        "line_samples", binned("line_samples", 100, "max(value)", LINES_START, LINES_END)
    ),
    "agg_dense": sql(
        "samples grid_6h",
        f"""SELECT g.series_id, g."index", b.value
            FROM grid_6h g LEFT JOIN ({binned("samples", 6 * HOUR, "round(avg(value), 6)")}) b
            ON g.series_id = b.series_id AND g."index" = b."index" """,
    ),
    "agg_gaps": sql(
        "samples grid_24h",
        f"""SELECT series_id, "index" FROM grid_24h
            EXCEPT SELECT series_id, "index" - "index" % {DAY} FROM samples""",
    ),
    "agg_period_units": sql("samples", _period_units()),
    "resample_1h_std": sql(
        "by_type", binned("by_type", HOUR, "round(stddev_samp(value), 6)", 0, 2**62)
    ),
    "resample_day_by_day": sql(
        "samples",
        f"""SELECT g.series_id, g."index", b.value FROM (
                SELECT series_id, unnest(range(min("index") - min("index") % {HOUR},
                                               max("index") + 1, {HOUR})) AS "index"
                FROM samples GROUP BY series_id, "index" // {DAY}) g
            LEFT JOIN ({binned("samples", HOUR, "max(value)")}) b
            ON g.series_id = b.series_id AND g."index" = b."index" """,
    ),
    "series_extent": sql(
        "extents", "SELECT series_id, first_index, last_index, n_samples FROM extents"
    ),
    "metadata_upsert": sql(
        "metadata updates",
        """SELECT md5(length(namespace) || ':' || namespace || key) AS metadata_id, namespace, key,
                  coalesce(u.value_json, m.value_json) AS value_json,
                  CASE WHEN m.metadata_id IS NULL THEN 'loader' END AS created_by,
                  CASE WHEN u.value_json IS NOT NULL THEN 'loader' END AS last_modified_by
           FROM metadata m FULL JOIN updates u USING (namespace, key)""",
    ),
    "metadata_conflicts": sql(
        "metadata",
        """SELECT metadata_id, namespace, key, value_json FROM metadata
           WHERE namespace = 'customer.building'""",
    ),
    "metadata_ids_distinct": sql(
        "metadata",
        """SELECT namespace, key, 1::BIGINT AS n_names FROM metadata
           UNION ALL SELECT c_mktsegment || '/' || c_custkey, 'x', 1::BIGINT FROM customer
           UNION ALL SELECT c_mktsegment, c_custkey || '/x', 1::BIGINT FROM customer""",
    ),
    "link_metadata": sql(
        "links segment_links", "SELECT * FROM links UNION SELECT * FROM segment_links"
    ),
    "unlink_metadata": sql(
        "links segment_links", "SELECT * FROM links EXCEPT SELECT * FROM segment_links"
    ),
    "metadata_by_id": sql(
        "metadata links extents",
        """SELECT m.metadata_id, namespace, key, value_json, l.series_id, first_index, last_index
           FROM metadata m LEFT JOIN links l ON m.metadata_id = l.metadata_id
           LEFT JOIN extents e ON l.series_id = e.series_id""",
    ),
    "metadata_by_key": sql(
        "metadata",
        """SELECT metadata_id, namespace, key, value_json FROM metadata
           WHERE namespace LIKE 'customer.%' AND key IN (
               SELECT c_name FROM customer JOIN orders ON o_custkey = c_custkey
               WHERE o_orderpriority = '1-URGENT')""",
    ),
    "browse_namespaces": sql("metadata", "SELECT DISTINCT namespace FROM metadata"),
    "browse_keys": sql(
        "metadata", "SELECT DISTINCT key FROM metadata WHERE namespace = 'customer.building'"
    ),
    "metadata_search": sql(
        "metadata",
        """SELECT metadata_id, namespace, key, value_json FROM metadata
           WHERE namespace = 'nation' AND starts_with(key, 'NATION_1')""",
    ),
    "metadata_delete": sql(
        "metadata links",
        """SELECT metadata_id, NULL AS series_id FROM metadata
           WHERE namespace <> 'customer.household'
           UNION ALL
           SELECT metadata_id, series_id FROM links WHERE metadata_id NOT IN (
               SELECT metadata_id FROM metadata WHERE namespace = 'customer.household')""",
    ),
    "search_ns": sql(
        "metadata links",
        """SELECT series_id, metadata_id, namespace, key, value_json
           FROM links JOIN metadata USING (metadata_id) WHERE namespace = 'nation'""",
    ),
    "search_ns_key": sql(
        "metadata links",
        """SELECT series_id, metadata_id, namespace, key, value_json
           FROM links JOIN metadata USING (metadata_id)
           WHERE namespace = 'nation' AND starts_with(key, 'NATION_1')""",
    ),
    "search_ns_key_name": sql(
        "metadata links",
        """SELECT series_id, metadata_id, namespace, key, value_json
           FROM links JOIN metadata USING (metadata_id)
           WHERE namespace = 'customer.building' AND starts_with(key, 'Customer#')
             AND nation IS NOT NULL""",
    ),
    "search_value": sql(
        "metadata links",
        """SELECT DISTINCT series_id FROM links JOIN metadata USING (metadata_id)
           WHERE namespace = 'customer.machinery' AND starts_with(key, 'Customer#')
             AND starts_with(nation, 'NATION') AND ends_with(nation, '2')""",
    ),
    "search_value_parts": sql(
        "metadata links",
        """SELECT DISTINCT series_id FROM links JOIN metadata USING (metadata_id)
           WHERE namespace = 'customer.machinery' AND starts_with(key, 'Customer#')
             AND nation LIKE 'N%ION%1%'""",
    ),
    "search_value_indexed": sql(
        "metadata links",
        """SELECT DISTINCT series_id FROM links JOIN metadata USING (metadata_id)
           WHERE namespace = 'customer.machinery' AND starts_with(key, 'Customer#')
             AND nation LIKE 'N%ION%1%'""",
    ),
    "series_info": sql(
        "metadata links extents",
        f"""SELECT {INFO_COLUMNS}, metadata_id, namespace, key, value_json
            FROM extents LEFT JOIN links USING (series_id) LEFT JOIN metadata USING (metadata_id)""",
    ),
    "stream_queue": sql("by_type", "SELECT * FROM by_type"),
    "stream_queue_many": sql(
        "by_type",
        f"""SELECT series_id, "index", CASE WHEN value > 60 THEN value * 2 ELSE value END AS value
            FROM by_type
            WHERE value > 60 OR NOT (series_id = 'error' AND "index" // {DAY} BETWEEN 19730 AND 19736)""",
    ),
}
