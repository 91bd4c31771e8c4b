"""The same results in SQL over the given tables, written without the library's shortcuts."""

from emberlog.registry.queries import DEFAULT_SAMPLE, RANGE_END, RANGE_START, SAMPLE_ROWS

# The telemetry tables, the row-level join chain and the summary.
TABLES = r"""
WITH ev AS (
  SELECT event_id, user_id, event_type,
         CAST(floor((floor(epoch(ts)) - 1704067200) / 1800) AS INTEGER) * 1800 AS t,
         'C' || (user_id % 10) AS computer
  FROM events
),
hosted AS (
  SELECT ev.*, regexp_extract(p.url, 'https?://([^/]+)', 1) AS host
  FROM ev LEFT JOIN pages p ON p.page_id = ev.event_id % (SELECT count(*) FROM pages)
),
numbered_flows AS (
  SELECT event_id,
         t AS time,
         CAST(event_id % 60 AS INTEGER) AS duration,
         computer AS src_computer,
         'N' || (event_id % 1000) AS src_port,
         CASE WHEN event_id % 3 = 0 THEN host ELSE 'C' || (event_id % 10) END AS dst_computer,
         CAST(event_id % 1024 AS VARCHAR) AS dst_port,
         CAST(CASE WHEN event_id % 2 = 0 THEN 6 ELSE 17 END AS INTEGER) AS protocol,
         CAST(event_id % 50 + 1 AS INTEGER) AS packets_count,
         CAST((event_id % 50 + 1) * (46 + event_id % 997) AS INTEGER) AS bytes_count
  FROM hosted
  WHERE event_type IN ('view', 'click', 'purchase')
),
flows AS (SELECT * EXCLUDE (event_id) FROM numbered_flows),
auth AS (
  SELECT t AS time, 'U' || user_id AS source_user, computer AS source_computer
  FROM ev WHERE event_type = 'signup'
),
proc AS (
  SELECT t AS time, 'U' || user_id || '@DOM1' AS user_domain, computer,
         'P' || (event_id % 20) AS process_name,
         CASE WHEN event_id % 2 = 0 THEN 'Start' ELSE 'End' END AS start_end
  FROM ev WHERE event_type = 'error'
),
dns AS (
  SELECT t AS time, computer AS "SourceComputer", host AS "ComputerResolved" FROM hosted
),
feed AS (
  SELECT url,
         regexp_extract(url, 'https?://([^/]+)', 1) AS host,
         CASE WHEN page_id % 2 = 0 THEN 'phishing' ELSE 'malware_download' END AS threat,
         CASE WHEN page_id % 100 <> 75
              THEN '2024-01-' || lpad(CAST(page_id % 28 + 1 AS VARCHAR), 2, '0')
              ELSE '' END AS date_added,
         CASE WHEN page_id % 2 = 0
              THEN 't' || (page_id % 7) || ',k' || (page_id % 3)
              ELSE '' END AS tags,
         page_id
  FROM pages
),
iocs AS (SELECT * EXCLUDE (page_id) FROM feed),
auth_one AS (
  SELECT source_computer, time, min(source_user) AS source_user FROM auth GROUP BY ALL
),
proc_one AS (
  SELECT computer, time, min(process_name) AS process_name FROM proc GROUP BY ALL
),
ioc_one AS (SELECT host, min(threat) AS threat FROM iocs GROUP BY host),
enriched AS (
  SELECT f.*, a.source_user AS "user", p.process_name, i.threat,
         CAST(CASE WHEN i.threat IS NOT NULL THEN 1 ELSE 0 END AS INTEGER) AS malicious_hit
  FROM numbered_flows f
  LEFT JOIN auth_one a ON f.src_computer = a.source_computer AND f.time = a.time
  LEFT JOIN proc_one p ON f.src_computer = p.computer AND f.time = p.time
  LEFT JOIN ioc_one i ON f.dst_computer = i.host
),
gold AS (
  SELECT CAST(trunc(time / 3600) AS BIGINT) * 3600 AS time_bucket,
         "user", src_computer,
         count(*) AS total_flows,
         CAST(sum(bytes_count) AS BIGINT) AS total_bytes,
         CAST(sum(packets_count) AS BIGINT) AS total_packets,
         count(DISTINCT process_name) AS active_processes,
         CAST(sum(malicious_hit) AS BIGINT) AS malicious_hits
  FROM enriched
  GROUP BY 1, 2, 3
),
totals AS (
  SELECT 'auth' AS dataset, count(*) AS records FROM auth
  UNION ALL SELECT 'dns', count(*) FROM dns
  UNION ALL SELECT 'flows', count(*) FROM flows
  UNION ALL SELECT 'proc', count(*) FROM proc
  UNION ALL SELECT 'iocs', count(*) FROM iocs
),
measures AS (
  SELECT 'total_flows' AS "column", CAST(total_flows AS DOUBLE) AS v FROM gold
  UNION ALL SELECT 'total_bytes', CAST(total_bytes AS DOUBLE) FROM gold
  UNION ALL SELECT 'total_packets', CAST(total_packets AS DOUBLE) FROM gold
  UNION ALL SELECT 'active_processes', CAST(active_processes AS DOUBLE) FROM gold
  UNION ALL SELECT 'malicious_hits', CAST(malicious_hits AS DOUBLE) FROM gold
),
described AS (
  SELECT "column", count(v) AS "count",
         round(avg(v), 3) AS mean, round(stddev_samp(v), 3) AS std, round(min(v), 3) AS min,
         round(quantile_cont(v, 0.25), 3) AS p25, round(quantile_cont(v, 0.5), 3) AS p50,
         round(quantile_cont(v, 0.75), 3) AS p75, round(max(v), 3) AS max
  FROM measures GROUP BY "column"
),
rules AS (
  SELECT 'total_flows >= 1' AS rule, count(*) FILTER (NOT total_flows >= 1) AS violations FROM gold
  UNION ALL SELECT 'total_bytes >= total_packets', count(*) FILTER (NOT total_bytes >= total_packets) FROM gold
  UNION ALL SELECT 'time_bucket on the hour', count(*) FILTER (NOT time_bucket % 3600 = 0) FROM gold
  UNION ALL SELECT 'malicious_hits >= 0', count(*) FILTER (NOT malicious_hits >= 0) FROM gold
),
gold_nulls AS (
  SELECT 'time_bucket' AS "column", avg(CAST(time_bucket IS NULL AS INTEGER)) AS null_rate FROM gold
  UNION ALL SELECT 'user', avg(CAST("user" IS NULL AS INTEGER)) FROM gold
  UNION ALL SELECT 'src_computer', avg(CAST(src_computer IS NULL AS INTEGER)) FROM gold
  UNION ALL SELECT 'total_flows', avg(CAST(total_flows IS NULL AS INTEGER)) FROM gold
  UNION ALL SELECT 'total_bytes', avg(CAST(total_bytes IS NULL AS INTEGER)) FROM gold
  UNION ALL SELECT 'total_packets', avg(CAST(total_packets IS NULL AS INTEGER)) FROM gold
  UNION ALL SELECT 'active_processes', avg(CAST(active_processes IS NULL AS INTEGER)) FROM gold
  UNION ALL SELECT 'malicious_hits', avg(CAST(malicious_hits IS NULL AS INTEGER)) FROM gold
),
reduction AS (
  SELECT CAST((SELECT sum(records) FROM totals) AS BIGINT) AS raw_records,
         (SELECT count(*) FROM gold) AS gold_records
),
proc_lines AS (
  SELECT event_id, row_number() OVER (ORDER BY event_id) - 1 AS line_no,
         event_id || ',U' || user_id || '@DOM1,' || computer || ',P' || (event_id % 20) || ','
           || CASE WHEN event_id % 2 = 0 THEN 'Start' ELSE 'End' END AS value
  FROM ev WHERE event_type = 'error'
),
log_lines AS (
  SELECT log, event_id, value, row_number() OVER (PARTITION BY log ORDER BY event_id) - 1 AS line_no
  FROM (
    SELECT 'auth' AS log, event_id, t || ',U' || user_id || ',' || computer AS value
    FROM ev WHERE event_type = 'signup'
    UNION ALL
    SELECT 'dns', event_id, concat_ws(',', t, computer, coalesce(host, '')) FROM hosted
    UNION ALL
    SELECT 'flows', event_id, concat_ws(',', time, duration, src_computer, src_port, coalesce(dst_computer, ''),
                                        dst_port, protocol, packets_count, bytes_count)
    FROM numbered_flows
    UNION ALL
    SELECT 'proc', event_id, value FROM proc_lines
  )
)
"""

FLOW_COLUMNS = (
    "time, duration, src_computer, src_port, dst_computer, dst_port, protocol,"
    " packets_count, bytes_count"
)

SELECTS = {
    "user_activity_summary": "SELECT * FROM gold",
    "enriched_flows": "SELECT * FROM enriched",
    "enriched_flows_heavy_keys": "SELECT * FROM enriched",
    "enriched_flows_large_feed": "SELECT * FROM enriched",
    "enriched_flows_full_feed": "SELECT * FROM enriched",
    "gold_keyed_silver": "SELECT * FROM gold",
    "gold_of_user": 'SELECT * FROM gold WHERE "user" = (SELECT min("user") FROM gold)',
    "scan_relanded": "SELECT * FROM flows",
    "scan_auth": "SELECT * FROM auth",
    "scan_dns": "SELECT * FROM dns",
    "scan_flows": "SELECT * FROM flows",
    "scan_proc": "SELECT * FROM proc",
    "scan_threat_feed": "SELECT * FROM iocs",
    "scan_silver_parquet": """
        SELECT time, source_computer AS computer, 'auth' AS log FROM auth
        UNION ALL SELECT time, "SourceComputer", 'dns' FROM dns
        UNION ALL SELECT time, src_computer, 'flows' FROM flows
        UNION ALL SELECT time, computer, 'proc' FROM proc
        UNION ALL SELECT CAST(NULL AS INTEGER), host, 'iocs' FROM iocs""",
    "scan_gold": "SELECT * FROM gold",
    "gold_time_range": f"SELECT * FROM gold WHERE time_bucket BETWEEN {RANGE_START} AND {RANGE_END}",
    "scan_lines": """
        SELECT concat_ws(',', time, duration, src_computer, src_port,
                         coalesce(dst_computer, ''), dst_port, protocol, packets_count,
                         bytes_count) AS value FROM flows""",
    "sink_silver": "SELECT * FROM flows",
    "sink_repartition": "SELECT * FROM auth",
    "sink_gold_partitioned": "SELECT *, time_bucket AS folder_bucket FROM gold",
    "sink_iocs": "SELECT * FROM iocs",
    "sink_sample_text": f"""
        SELECT value FROM proc_lines ORDER BY md5('42:' || event_id), event_id
        LIMIT {SAMPLE_ROWS}""",
    "project_lookup": "SELECT source_computer, time, source_user FROM auth",
    "project_qualified_star": """
        SELECT f.*, a.source_user AS "user" FROM numbered_flows f
        LEFT JOIN auth_one a ON f.src_computer = a.source_computer AND f.time = a.time""",
    "url_host": """
        SELECT page_id, regexp_extract(url, 'https?://([^/]+)', 1) AS host FROM pages""",
    "hit_flag": "SELECT event_id, threat, malicious_hit FROM enriched",
    "time_bucket": """
        SELECT event_id, time, CAST(trunc(time / 3600) AS BIGINT) * 3600 AS time_bucket
        FROM numbered_flows""",
    "feed_defaults": "SELECT url, host, threat, date_added FROM iocs",
    "feed_tags": "SELECT url, tags FROM iocs",
    "select_numeric": 'SELECT * EXCLUDE ("user", src_computer) FROM gold',
    "dns_rename": """
        SELECT time, "SourceComputer" AS source_computer,
               "ComputerResolved" AS computer_resolved FROM dns""",
    "gold_hits_only": "SELECT * FROM gold WHERE malicious_hits > 0",
    "feed_status_gate": """
        SELECT * EXCLUDE (page_id) FROM feed
        WHERE CAST(floor(page_id / 2.0) AS BIGINT) % 3 <> 2""",
    "dedup_auth": "SELECT * FROM auth_one",
    "dedup_proc": "SELECT * FROM proc_one",
    "dedup_iocs": "SELECT * FROM ioc_one",
    "join_flows_auth": f'SELECT {FLOW_COLUMNS}, "user" FROM enriched',
    "join_flows_proc": f"SELECT {FLOW_COLUMNS}, process_name FROM enriched",
    "join_flows_iocs": f"SELECT {FLOW_COLUMNS}, threat FROM enriched",
    "gold_group": "SELECT * FROM gold",
    "agg_count": 'SELECT time_bucket, "user", src_computer, total_flows FROM gold',
    "agg_sum": 'SELECT time_bucket, "user", src_computer, total_bytes, total_packets FROM gold',
    "agg_count_distinct": """
        SELECT time_bucket, "user", src_computer, active_processes FROM gold""",
    "agg_conditional_sum": """
        SELECT time_bucket, "user", src_computer, malicious_hits FROM gold""",
    "row_count": "SELECT count(*) AS records FROM flows",
    "distinct_entities": """
        SELECT count(DISTINCT "user") AS users, count(DISTINCT src_computer) AS computers
        FROM gold""",
    "hit_row_count": "SELECT count(*) FILTER (malicious_hits > 0) AS hit_rows FROM gold",
    "describe_gold": "SELECT * FROM described",
    "preview": "SELECT * FROM numbered_flows ORDER BY time, event_id LIMIT 10",
    "sample_first_n": f"SELECT * FROM numbered_flows ORDER BY event_id LIMIT {DEFAULT_SAMPLE}",
    "sample_random_n": f"""
        SELECT * FROM numbered_flows ORDER BY md5('42:' || event_id), event_id
        LIMIT {SAMPLE_ROWS}""",
    "feed_recent_n": "SELECT * FROM iocs ORDER BY date_added DESC, url LIMIT 7",
    "concat_parts": "SELECT * FROM gold",
    "ingest_totals": """
        SELECT * FROM totals
        UNION ALL SELECT 'TOTAL', CAST(sum(records) AS BIGINT) FROM totals""",
    "dataset_profile": """
        SELECT dataset, records, CASE WHEN records > 0 THEN 'OK' ELSE 'EMPTY' END AS status,
               records > 0 AS has_files, records > 0 AS has_bytes
        FROM (SELECT * FROM totals UNION ALL SELECT 'gold', count(*) FROM gold)
        UNION ALL SELECT 'absent', NULL, 'MISSING', NULL, NULL""",
    "null_rates": 'SELECT "column", round(null_rate, 6) AS null_rate FROM gold_nulls',
    # One fault of each kind, by the computer a row is of.
    "gold_sanity": """
        SELECT 'total_flows >= 1' AS rule, count(*) FILTER (src_computer = 'C1') AS violations FROM gold
        UNION ALL SELECT 'total_bytes >= total_packets', count(*) FILTER (src_computer = 'C2') FROM gold
        UNION ALL SELECT 'time_bucket on the hour', count(*) FILTER (src_computer = 'C3') FROM gold
        UNION ALL SELECT 'malicious_hits >= 0', count(*) FILTER (src_computer = 'C4') FROM gold""",
    "fanout_guard": """
        SELECT (SELECT count(*) FROM flows) AS flow_rows,
               (SELECT count(*) FROM enriched) AS enriched_rows,
               (SELECT count(*) FROM flows) = (SELECT count(*) FROM enriched) AS no_fanout""",
    "value_domain": """
        SELECT CASE WHEN process_name = 'P3' THEN 'Restart' WHEN process_name <> 'P4' THEN start_end END AS value,
               count(*) AS records,
               process_name NOT IN ('P3', 'P4') AS allowed
        FROM proc GROUP BY ALL""",
    "schema_check": """
        SELECT CAST(position AS INTEGER) AS position, name AS expected_column,
               kind AS expected_type,
               CASE name WHEN 'src_port' THEN 'source_port' ELSE name END AS actual_column,
               CASE name WHEN 'bytes_count' THEN 'bigint' ELSE kind END AS actual_type,
               name NOT IN ('src_port', 'bytes_count') AS matches, (SELECT count(*) FROM flows) AS records
        FROM (VALUES (0, 'time', 'int'), (1, 'duration', 'int'), (2, 'src_computer', 'string'),
                     (3, 'src_port', 'string'), (4, 'dst_computer', 'string'),
                     (5, 'dst_port', 'string'), (6, 'protocol', 'int'),
                     (7, 'packets_count', 'int'), (8, 'bytes_count', 'int'))
             AS declared(position, name, kind)""",
    # A rejected line keeps the cells that could be read.
    "split_malformed": """
        SELECT CASE WHEN event_type <> 'click' THEN CAST(event_id AS INTEGER) END AS time,
               'U' || user_id AS source_user,
               CASE WHEN event_type <> 'purchase' THEN computer END AS source_computer,
               CASE event_type
                 WHEN 'click' THEN 'x' || event_id || ',U' || user_id || ',' || computer
                 WHEN 'purchase' THEN event_id || ',U' || user_id
                 WHEN 'view' THEN event_id || ',U' || user_id || ',' || computer || ',extra'
               END AS rejected_line
        FROM ev""",
    "split_malformed_counts": """
        SELECT count(*) FILTER (event_type NOT IN ('click', 'purchase', 'view')) AS good,
               count(*) FILTER (event_type IN ('click', 'purchase', 'view')) AS rejected,
               count(DISTINCT user_id) FILTER (event_type NOT IN ('click', 'purchase', 'view')) AS good_users,
               count(DISTINCT user_id) FILTER (event_type IN ('click', 'purchase', 'view')) AS rejected_users
        FROM ev""",
    "partition_rows": "SELECT count(*) AS records, true AS some_partition, true AS no_partition_twice FROM auth",
    "reduction_pct": """
        SELECT raw_records, gold_records,
               round(100.0 * (1.0 - CAST(gold_records AS DOUBLE) / raw_records), 6)
                 AS reduction_pct
        FROM reduction""",
    "job_silver": """
        SELECT dataset AS log, records, true AS schema_matches FROM totals WHERE dataset <> 'iocs'""",
    "job_silver_checked": """
        SELECT 'auth' AS log, unnest(['time', 'source_user', 'source_computer']) AS "column", count(*) AS records,
               count(*) FILTER (event_type IN ('click', 'purchase', 'view')) AS malformed,
               unnest([count(*) FILTER (event_type = 'click'), 0, count(*) FILTER (event_type = 'purchase')]) AS nulls
        FROM ev
        UNION ALL SELECT 'dns', unnest(['time', 'SourceComputer', 'ComputerResolved']), count(*), 0,
                         unnest([count(*) - count(time), count(*) - count("SourceComputer"), count(*) - count("ComputerResolved")])
                  FROM dns
        UNION ALL SELECT 'flows',
                         unnest(['time', 'duration', 'src_computer', 'src_port', 'dst_computer', 'dst_port', 'protocol',
                                 'packets_count', 'bytes_count']), count(*), 0,
                         unnest([0, 0, 0, 0, count(*) - count(dst_computer), 0, 0, 0, 0]) FROM flows
        UNION ALL SELECT 'proc', unnest(['time', 'user_domain', 'computer', 'process_name', 'start_end']), count(*), 0, 0 FROM proc""",
    "job_silver_incremental": """
        SELECT time, source_computer AS computer, 'auth' AS log FROM auth
        UNION ALL SELECT time, "SourceComputer", 'dns' FROM dns
        UNION ALL SELECT time, src_computer, 'flows' FROM flows
        UNION ALL SELECT time, computer, 'proc' FROM proc""",
    # The third run reads the early rows again, whose files were replaced; the late ones stay.
    "job_silver_runs": f"""
        SELECT log, count(*) FILTER (time < {RANGE_END}) AS first_run, count(*) FILTER (time >= {RANGE_END}) AS second_run,
               count(*) FILTER (time < {RANGE_END}) AS third_run, count(*) AS records
        FROM (SELECT 'auth' AS log, time FROM auth UNION ALL SELECT 'dns', time FROM dns
              UNION ALL SELECT 'flows', time FROM flows UNION ALL SELECT 'proc', time FROM proc)
        GROUP BY log""",
    "gold_changed_hours": "SELECT * FROM gold",
    "job_iocs": "SELECT * FROM iocs",
    "job_validation": """
        SELECT 'profile' AS section, dataset AS item, round(CAST(records AS DOUBLE), 3) AS value
        FROM totals
        UNION ALL SELECT 'profile', 'gold', count(*) FROM gold
        UNION ALL SELECT 'overall', 'ok', 1
        UNION ALL SELECT 'ingest_totals', dataset, records FROM totals
        UNION ALL SELECT 'ingest_totals', 'TOTAL', sum(records) FROM totals
        UNION ALL SELECT 'auth_null_rates', unnest(['time', 'source_user', 'source_computer']),
                         unnest([(SELECT avg(CAST(time IS NULL AS INTEGER)) FROM auth),
                                 (SELECT avg(CAST(source_user IS NULL AS INTEGER)) FROM auth),
                                 (SELECT avg(CAST(source_computer IS NULL AS INTEGER)) FROM auth)])
        UNION ALL SELECT 'gold_hit_rows', 'hit_rows', count(*) FILTER (malicious_hits > 0) FROM gold
        UNION ALL SELECT 'gold_entities', 'users', count(DISTINCT "user") FROM gold
        UNION ALL SELECT 'gold_entities', 'computers', count(DISTINCT src_computer) FROM gold
        UNION ALL SELECT 'gold_checks', rule, violations FROM rules
        UNION ALL SELECT 'reduction', 'reduction_pct',
                         round(100.0 * (1.0 - CAST(gold_records AS DOUBLE) / raw_records), 3)
                  FROM reduction
        UNION ALL SELECT 'gold_statistics', "column" || ' count', "count" FROM described
        UNION ALL SELECT 'gold_statistics', "column" || ' mean', mean FROM described
        UNION ALL SELECT 'gold_statistics', "column" || ' std', std FROM described
        UNION ALL SELECT 'gold_statistics', "column" || ' min', min FROM described
        UNION ALL SELECT 'gold_statistics', "column" || ' p25', p25 FROM described
        UNION ALL SELECT 'gold_statistics', "column" || ' p50', p50 FROM described
        UNION ALL SELECT 'gold_statistics', "column" || ' p75', p75 FROM described
        UNION ALL SELECT 'gold_statistics', "column" || ' max', max FROM described""",
    "job_samples": f"""
        SELECT 'first' AS sample, log, value FROM log_lines WHERE line_no < {SAMPLE_ROWS}
        UNION ALL
        SELECT 'random', log, value FROM (
          SELECT *, row_number() OVER (PARTITION BY log ORDER BY md5('42:' || line_no), line_no) AS place
          FROM log_lines) WHERE place <= {SAMPLE_ROWS}""",
    "gold_stream": "SELECT * FROM gold",
    "job_full_batch": "SELECT * FROM gold",
}

ORACLES = {name: f"{TABLES}{select}" for name, select in SELECTS.items()}
