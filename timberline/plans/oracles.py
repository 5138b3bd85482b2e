"""The same queries as SQL over the given tables, from the typed columns instead of parsed text."""

from __future__ import annotations

from timberline.plans.standins import TRACED, TYPED

LOGS = TYPED.format(events="events").rstrip()

# Further tables over the lines ``l``.
GROUPED = """, g AS (SELECT coalesce(lvl, '') AS log_level, count(*) AS n FROM l GROUP BY 1),
words AS (SELECT * FROM (VALUES (0, 'INFO'), (1, 'WARN'), (2, 'ERROR'), (3, 'DEBUG')) v(ord, log_level)),
c AS (SELECT w.ord, w.log_level, coalesce(g.n, 0) AS n FROM words w LEFT JOIN g ON g.log_level = w.log_level),
s AS (SELECT coalesce(sum(n), 0) AS total_lines, coalesce(sum(n) FILTER (WHERE log_level <> ''), 0) AS lines_with_level,
             count(*) FILTER (WHERE log_level <> '') AS distinct_levels FROM g),
p AS (SELECT ord, log_level, n, CASE WHEN lines_with_level > 0 THEN 100.0 * CAST(n AS DOUBLE) / CAST(lines_with_level AS DOUBLE)
             ELSE 0.0 END AS percent FROM c, s)"""

USAGE = """, cat AS (SELECT DISTINCT cluster_id, application_id, app_number FROM l),
tl AS (SELECT cluster_id, application_id, app_number,
              min(CASE WHEN event_type <> 'view' THEN date_trunc('second', ts) END) AS start_time,
              max(CASE WHEN event_type <> 'view' THEN date_trunc('second', ts) END) AS end_time
       FROM l WHERE says_app GROUP BY ALL),
miss AS (SELECT cluster_id, application_id, app_number, CAST(NULL AS TIMESTAMP) AS start_time, CAST(NULL AS TIMESTAMP) AS end_time
         FROM cat WHERE application_id NOT IN (SELECT application_id FROM tl)),
pad AS (SELECT * FROM tl UNION ALL SELECT * FROM miss),
cc AS (SELECT cluster_id, count(DISTINCT application_id) AS num_applications FROM cat GROUP BY 1),
cb AS (SELECT cluster_id, min(start_time) AS cluster_first_app, max(end_time) AS cluster_last_app FROM tl GROUP BY 1),
timed AS (SELECT cluster_id, count(DISTINCT CASE WHEN start_time IS NOT NULL THEN application_id END) AS timed FROM tl GROUP BY 1),
big AS (SELECT coalesce(cc.cluster_id, timed.cluster_id) AS cluster_id, coalesce(num_applications, 0) AS num_applications,
               coalesce(timed, 0) AS timed
        FROM cc FULL JOIN timed ON cc.cluster_id = timed.cluster_id
        ORDER BY timed DESC, num_applications DESC, cluster_id LIMIT 1),
d AS (SELECT cluster_id, application_id, duration, log10(CAST(duration AS DOUBLE)) AS x FROM (
        SELECT pad.cluster_id, application_id, date_diff('second', start_time, end_time) AS duration
        FROM pad JOIN big ON pad.cluster_id = big.cluster_id) WHERE duration > 0),
b AS (SELECT count(*) AS n, min(x) AS lo, max(x) AS hi, stddev_samp(x) AS sd FROM d)"""

PADDED = "SELECT cluster_id, application_id, app_number, start_time, end_time FROM pad"

TASKS = """, te AS (SELECT application_id, tid % 3 AS stage, tid AS task, CAST(0 AS BIGINT) AS attempt, tid,
       CASE event_id % 3 WHEN 0 THEN 'Running' ELSE 'Finished' END AS kind, date_trunc('second', ts) AS time
       FROM l WHERE event_type = 'click' AND event_id % 3 <> 2),
tt AS (SELECT *, date_diff('second', start_time, finish_time) AS seconds FROM (
         SELECT application_id, tid, min(time) FILTER (WHERE kind = 'Running') AS start_time,
                max(time) FILTER (WHERE kind = 'Finished') AS finish_time FROM te GROUP BY 1, 2))"""

SWEEP = TASKS + """, ends AS (SELECT application_id, start_time AS time, 1 AS step FROM tt WHERE start_time < finish_time
         UNION ALL SELECT application_id, finish_time, -1 FROM tt WHERE start_time < finish_time),
sw AS (SELECT * FROM (
         SELECT application_id, time AS time_from, lead(time) OVER w AS time_to, CAST(sum(step) OVER w AS BIGINT) AS running
         FROM (SELECT application_id, time, sum(step) AS step FROM ends GROUP BY 1, 2)
         WINDOW w AS (PARTITION BY application_id ORDER BY time)) WHERE time_to IS NOT NULL)"""

TRACES = TRACED.format(events="events").rstrip() + """, x AS (
  SELECT container_id, event_id, i, value, CASE WHEN i = 1 AND event_type <> 'view' THEN ts_text END AS ts_text,
    CASE WHEN i = 1 AND event_type <> 'view' THEN lvl END AS level, CASE WHEN i = 1 AND event_type <> 'view' THEN comp END AS component
  FROM (SELECT container_id, event_id, event_type, ts_text, lvl, comp, unnest(string_split(entry, chr(10))) AS value,
          generate_subscripts(string_split(entry, chr(10)), 1) AS i FROM t)
), y AS (
  SELECT *, row_number() OVER (PARTITION BY container_id ORDER BY event_id, i) - 1 AS place FROM x
), z AS (
  SELECT container_id, value, place, CASE WHEN ts_text IS NOT NULL THEN place END AS head FROM y
), h AS (
  SELECT container_id, value, place, last_value(head IGNORE NULLS) OVER (PARTITION BY container_id ORDER BY place) AS head FROM z
), le AS (
  SELECT h.container_id, h.place - coalesce(h.head, 0) AS line_no, y.ts_text, y.level, y.component, h.value
  FROM h LEFT JOIN y ON y.container_id = h.container_id AND y.place = h.head
)"""

# Bytes of a range that splits cover at least once: what lies behind the furthest end so far.
COVERAGE = """, sp AS (SELECT concat('hdfs://10.0.0.1:9000/in/part', CAST(event_id % 4 AS VARCHAR), '.txt') AS path,
       event_id * 100 AS start, user_id * 7 AS length FROM l WHERE event_type = 'error'),
rc AS (SELECT *, max(start + length) OVER (PARTITION BY path ORDER BY start, length ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS reached FROM sp)"""

TIMES = """, py AS (SELECT application_id, container_id, event_id AS total, user_id - 75 AS boot,
       event_id - user_id + 72 AS init, CAST(3 AS BIGINT) AS finish FROM l WHERE event_type = 'click' AND event_id % 3 = 2)"""

BLOCKS = """, sb AS (SELECT application_id, concat('broadcast_', CAST(event_id AS VARCHAR)) AS block, 'broadcast' AS kind,
       CAST((1.5 + event_id % 900) * CASE WHEN event_id % 4 = 0 THEN 1048576 ELSE 1024 END AS BIGINT) AS size_bytes,
       CAST(round(1155.2 * 1024) AS BIGINT) AS free_bytes
       FROM l WHERE event_type = 'purchase' AND event_id % 3 <> 0 AND event_id % 13 <> 5)"""

BYTES = """, ab AS (SELECT application_id, count(DISTINCT container_id) AS containers,
       CAST(sum(strlen(value) + 1) AS BIGINT) AS bytes FROM l GROUP BY 1)"""

DAILY = """WITH daily AS (SELECT CAST(year(l_shipdate) AS INTEGER) AS dt_year, CAST(month(l_shipdate) AS INTEGER) AS dt_month,
       CAST(day(l_shipdate) AS INTEGER) AS dt_day, count(*) AS num_trips, round(avg(l_quantity), 6) AS mean_trip_distance,
       max(l_tax) AS max_mta_tax, quantile_disc(l_extendedprice, 0.95) AS q95_fare_amount, min(l_discount) AS min_tip_amount,
       CAST(ceil(avg(l_linenumber)) AS BIGINT) AS mean_passenger_count
       FROM lineitem WHERE year(l_shipdate) = 1997 GROUP BY 1, 2, 3)"""

MONTHS = """SELECT CAST(year(l_shipdate) AS INTEGER) AS yyyy, CAST(month(l_shipdate) AS INTEGER) AS mm, count(*) AS num_trips,
       min(l_extendedprice) AS min_fare, max(l_extendedprice) AS max_fare
       FROM lineitem WHERE year(l_shipdate) = 1997 GROUP BY 1, 2"""

LEVEL_REPORT = """SELECT CAST(ord AS INTEGER) AS ord, line FROM (
  SELECT 0 AS ord, 'Total log lines processed: ' || format('{:,}', CAST(total_lines AS BIGINT)) AS line FROM s
  UNION ALL SELECT 1, 'Total lines with log levels: ' || format('{:,}', CAST(lines_with_level AS BIGINT)) FROM s
  UNION ALL SELECT 2, 'Unique log levels found: ' || CAST(distinct_levels AS VARCHAR) FROM s
  UNION ALL SELECT 3, ''
  UNION ALL SELECT 4, 'Log level distribution:'
  UNION ALL SELECT 5 + ord, format('  {:<5}: {:>12} ({:6.2f}%)', log_level, format('{:,}', n), percent) FROM p)"""

CLUSTER_REPORT = """SELECT CAST(ord AS INTEGER) AS ord, line FROM (
  SELECT 0 AS ord, 'Total unique clusters: ' || CAST(count(*) AS VARCHAR) AS line FROM cc
  UNION ALL SELECT 1, 'Total applications: ' || CAST(sum(num_applications) AS VARCHAR) FROM cc
  UNION ALL SELECT 2, 'Average applications per cluster: ' || format('{:.2f}', avg(num_applications)) FROM cc
  UNION ALL SELECT 3, ''
  UNION ALL SELECT 4, 'Most heavily used clusters:'
  UNION ALL SELECT 4 + r, format('  Cluster {}: {} applications', cluster_id, num_applications) FROM (
    SELECT *, row_number() OVER (ORDER BY num_applications DESC, cluster_id) AS r FROM cc) WHERE r <= 5)"""

HISTOGRAM = """, h AS (SELECT CASE WHEN hi > lo THEN least(CAST(floor(30.0 * (x - lo) / (hi - lo)) AS INTEGER) + 1, 30) ELSE 1 END AS bin,
       count(*) AS n FROM d, b GROUP BY 1),
bins AS (SELECT CAST(i AS INTEGER) AS bin FROM range(1, 31) t(i))
SELECT bins.bin, round(lo + (bins.bin - 1) * ((hi - lo) / 30), 6) AS bin_from, round(lo + bins.bin * ((hi - lo) / 30), 6) AS bin_to,
       coalesce(h.n, 0) AS "count", round(b.n * ((hi - lo) / 30), 6) AS density_scale
FROM b CROSS JOIN bins LEFT JOIN h ON h.bin = bins.bin WHERE b.n > 0"""

DENSITY = """, k AS (SELECT n, lo, hi, sd * pow(n, -0.2) AS h FROM b WHERE sd > 0),
grid AS (SELECT CAST(i AS INTEGER) AS point, lo - 3 * h + i * ((hi + 3 * h) - (lo - 3 * h)) / 199 AS gx, n, h
         FROM k CROSS JOIN range(0, 200) t(i))
SELECT point, round(gx, 6) AS x, round(sum(exp(-0.5 * pow((gx - d.x) / h, 2))) / (any_value(n) * any_value(h) * sqrt(2 * pi())), 6) AS density
FROM grid CROSS JOIN d GROUP BY point, gx"""

ORACLES: dict[str, str] = {
    # levels
    "log_totals": LOGS + """ SELECT count(*) AS total_lines, count(lvl) AS lines_with_level,
        count(DISTINCT lvl) AS distinct_levels FROM l""",
    "log_level_counts": LOGS + GROUPED + ' SELECT log_level, n AS "count" FROM c',
    "log_level_share": LOGS + GROUPED + ' SELECT log_level, n AS "count", round(percent, 6) AS percent FROM p',
    "distinct_levels": LOGS + " SELECT DISTINCT lvl AS log_level FROM l WHERE lvl IS NOT NULL",
    "log_level_report": LOGS + GROUPED + " " + LEVEL_REPORT,
    "log_sample": LOGS + """ SELECT value AS log_entry, lvl AS log_level FROM l WHERE lvl IS NOT NULL
        ORDER BY md5('42:' || CAST(event_id AS VARCHAR)), event_id LIMIT 10""",
    "log_sample_rand": LOGS + """ SELECT least(count(lvl), 10) AS drawn, least(count(lvl), 10) AS with_level,
        least(count(lvl), 10) AS found FROM l""",
    "log_sample_by_text": LOGS + """, k AS (SELECT *, substr(md5(value), 1, 2) AS grp,
              row_number() OVER (PARTITION BY file_path, substr(md5(value), 1, 2) ORDER BY value) - 1 AS number FROM l WHERE lvl IS NOT NULL)
        SELECT value AS log_entry, lvl AS log_level FROM k
        ORDER BY md5(concat('42:', file_path, ':', grp, ':', CAST(number AS VARCHAR))), file_path, grp, number LIMIT 10""",
    "log_header_levels": LOGS + GROUPED + ' SELECT log_level, n AS "count" FROM c',
    "log_header": LOGS + """ SELECT file_path, CASE WHEN event_type = 'view' THEN '' ELSE ts_text END AS ts_text,
        coalesce(lvl, '') AS level, coalesce(comp, '') AS component, value AS message FROM l""",
    "log_entries": TRACES + " SELECT * FROM le",
    "log_entry_sizes": TRACES + """ SELECT level, component, count(*) FILTER (WHERE line_no = 0) AS entries, count(*) AS lines,
        max(line_no) + 1 AS most_lines, CAST(sum(strlen(value)) AS BIGINT) AS bytes FROM le WHERE ts_text IS NOT NULL GROUP BY 1, 2""",
    "log_level_groups": LOGS + """ SELECT coalesce(lvl, '') AS log_level, count(*) AS "count" FROM l GROUP BY 1""",
    "level_occurrences": LOGS + """ SELECT log_level, count(*) AS "count" FROM (
        SELECT lvl AS log_level FROM l WHERE lvl IS NOT NULL
        UNION ALL SELECT 'INFO' FROM l WHERE event_type = 'view'
        UNION ALL SELECT 'WARN' FROM l WHERE event_type = 'error' AND event_id % 7 = 0) GROUP BY 1""",
    # files and containers
    "app_catalog": LOGS + USAGE + " SELECT cluster_id, application_id, app_number FROM cat",
    "log_inventory": LOGS + """ SELECT count(*) AS lines, count(DISTINCT container_id) AS containers,
        count(DISTINCT application_id) AS applications FROM l""",
    "log_file_counts": LOGS + """ SELECT count(DISTINCT application_id) AS applications,
        count(DISTINCT file_path) AS files FROM l""",
    "app_top_files": LOGS + """ SELECT application_id, count(DISTINCT file_path) AS files FROM l GROUP BY 1
        ORDER BY files DESC, application_id LIMIT 5""",
    "container_parts": LOGS + """ SELECT DISTINCT container_id, cluster_id, app_number, '01' AS attempt,
        lpad(CAST(1 + event_id % 4 AS VARCHAR), 6, '0') AS container_no,
        CASE WHEN event_id % 4 = 0 THEN 'ApplicationMaster' ELSE 'Executor' END AS role,
        CAST(epoch_ms(CAST(cluster_id AS BIGINT)) AS TIMESTAMP) AS cluster_start FROM l""",
    "app_file_bytes": LOGS + BYTES + " SELECT * FROM ab",
    "app_size_stats": LOGS + BYTES + """ SELECT count(*) AS applications, CAST(sum(containers) AS BIGINT) AS containers,
        CAST(sum(bytes) AS BIGINT) AS bytes, min(bytes) AS min_bytes, max(bytes) AS max_bytes,
        round(avg(bytes), 6) AS avg_bytes, round(avg(containers), 6) AS avg_containers FROM ab""",
    "text_scan_levels": LOGS + GROUPED + ' SELECT log_level, n AS "count" FROM c',
    "text_scan_timeline": LOGS + USAGE + " " + PADDED,
    # use of clusters
    "app_timeline": LOGS + USAGE + " SELECT * FROM tl",
    "app_timeline_by_path": LOGS + """ SELECT cluster_id, application_id, app_number,
        min(CASE WHEN event_type <> 'view' THEN date_trunc('second', ts) END) AS start_time,
        max(CASE WHEN event_type <> 'view' THEN date_trunc('second', ts) END) AS end_time FROM l GROUP BY ALL""",
    "apps_missing": LOGS + USAGE + " SELECT * FROM miss",
    "app_timeline_padded": LOGS + USAGE + " " + PADDED,
    "app_timeline_text": LOGS + USAGE + """ SELECT cluster_id, application_id,
        coalesce(strftime(start_time, '%Y-%m-%d %H:%M:%S'), '') AS start_time,
        coalesce(strftime(end_time, '%Y-%m-%d %H:%M:%S'), '') AS end_time FROM pad""",
    "cluster_counts": LOGS + USAGE + " SELECT * FROM cc",
    "cluster_counts_merged": LOGS + USAGE + " SELECT * FROM cc",
    "cluster_summary": LOGS + USAGE + """ SELECT cc.cluster_id, num_applications, cluster_first_app, cluster_last_app
        FROM cc LEFT JOIN cb ON cc.cluster_id = cb.cluster_id""",
    "cluster_stats": LOGS + USAGE + """ SELECT count(*) AS clusters, CAST(coalesce(sum(num_applications), 0) AS BIGINT) AS applications,
        round(coalesce(avg(num_applications), 0.0), 6) AS avg_applications FROM cc""",
    "cluster_report": LOGS + USAGE + " " + CLUSTER_REPORT,
    "cluster_top5": LOGS + USAGE + " SELECT * FROM cc ORDER BY num_applications DESC, cluster_id LIMIT 5",
    "cluster_largest": LOGS + USAGE + " SELECT * FROM big",
    # durations
    "app_durations": LOGS + USAGE + """ SELECT cluster_id, application_id, duration, round(x, 6) AS log_duration FROM d""",
    "duration_histogram": LOGS + USAGE + HISTOGRAM,
    "duration_ticks": LOGS + USAGE + """ SELECT tick, format('{:,}', CAST(pow(10, tick) AS BIGINT)) AS label FROM (
        SELECT unnest(generate_series(CAST(floor(lo) AS BIGINT), CAST(ceil(hi) AS BIGINT))) AS tick FROM b WHERE n > 0)""",
    "duration_density": LOGS + USAGE + DENSITY,
    # messages
    "component_top20": LOGS + """ SELECT coalesce(comp, '') AS component, count(*) AS "count" FROM l GROUP BY 1
        ORDER BY 2 DESC, 1 LIMIT 20""",
    "component_frequent": LOGS + """ SELECT coalesce(comp, '') AS component, count(*) AS "count" FROM l GROUP BY 1
        ORDER BY 2 DESC, 1 LIMIT 20""",
    "error_lines": LOGS + " SELECT file_path, value FROM l WHERE lvl = 'ERROR'",
    "error_counts": LOGS + """ SELECT cluster_id, count(*) AS "count" FROM l WHERE lvl = 'ERROR' GROUP BY 1""",
    "resource_requests": LOGS + """ SELECT application_id, count(*) AS requests, CAST(sum(1 + user_id % 16) AS BIGINT) AS executors,
        max(1 + user_id % 5) AS max_cores, max(1024 * (1 + user_id % 4)) AS max_memory_mb, max(CASE WHEN event_id % 2 = 0 THEN 384 + user_id END) AS max_overhead_mb
        FROM l WHERE event_type = 'signup' AND event_id % 3 <> 0 GROUP BY 1""",
    "container_sizes": LOGS + """ SELECT 1024 * (1 + user_id % 4) AS memory_mb, 1 + user_id % 5 AS vcores, count(*) AS "count"
        FROM l WHERE event_type = 'signup' AND event_id % 3 = 0 GROUP BY 1, 2""",
    "task_events": LOGS + TASKS + " SELECT * FROM te",
    "task_times": LOGS + TASKS + " SELECT * FROM tt",
    "task_time_by_app": LOGS + TASKS + """ SELECT application_id, count(*) AS tasks, count(*) FILTER (WHERE seconds IS NULL) AS untimed,
        count(*) FILTER (WHERE seconds < 0) AS negative, round(avg(CASE WHEN seconds >= 0 THEN seconds END), 6) AS mean_seconds
        FROM tt GROUP BY 1""",
    "stage_spread": LOGS + TASKS + """ SELECT application_id, stage, count(*) AS tasks, min(seconds) AS min_seconds,
        round(avg(seconds), 6) AS mean_seconds, max(seconds) AS max_seconds, round(max(seconds) / nullif(avg(seconds), 0), 6) AS skew FROM (
          SELECT application_id, stage, tid, date_diff('second', min(time) FILTER (WHERE kind = 'Running'),
            max(time) FILTER (WHERE kind = 'Finished')) AS seconds FROM te GROUP BY 1, 2, 3) WHERE seconds >= 0 GROUP BY 1, 2""",
    "task_concurrency": LOGS + SWEEP + " SELECT * FROM sw",
    "task_peaks": LOGS + SWEEP + """ SELECT application_id, max(running) AS peak, arg_min(time_from, (-running, time_from)) AS peak_from,
        CAST(coalesce(sum(CASE WHEN running > 0 THEN date_diff('second', time_from, time_to) END), 0) AS BIGINT) AS busy_seconds FROM sw GROUP BY 1""",
    "python_times": LOGS + TIMES + " SELECT * FROM py",
    "python_times_first20": LOGS + TIMES + " SELECT * FROM py ORDER BY ALL LIMIT 20",
    "stored_blocks": LOGS + BLOCKS + " SELECT * FROM sb",
    "memory_blocks": LOGS + BLOCKS + """ SELECT application_id, kind, count(*) AS blocks, CAST(sum(size_bytes) AS BIGINT) AS size_bytes,
        min(free_bytes) AS min_free_bytes FROM sb GROUP BY 1, 2""",
    "input_splits": LOGS + """ SELECT concat('hdfs://10.0.0.1:9000/in/part', CAST(event_id % 4 AS VARCHAR), '.txt') AS path,
        count(*) AS splits, CAST(sum(user_id * 7) AS BIGINT) AS bytes FROM l WHERE event_type = 'error' GROUP BY 1""",
    "input_coverage": LOGS + COVERAGE + """ SELECT path, CAST(count(*) AS BIGINT) AS splits, CAST(sum(length) AS BIGINT) AS bytes,
        CAST(sum(greatest(start + length - greatest(start, coalesce(reached, 0)), 0)) AS BIGINT) AS covered FROM rc GROUP BY 1""",
    "broadcast_reads": LOGS + """ SELECT application_id, event_id % 20 AS broadcast_id, count(*) AS reads
        FROM l WHERE event_type = 'purchase' AND event_id % 3 = 0 AND event_id % 13 <> 5 GROUP BY 1, 2""",
    "memory_capacity": LOGS + """ SELECT application_id, container_id, CAST((1.5 + user_id % 900) * 1048576 AS BIGINT) AS capacity_bytes
        FROM l WHERE event_type = 'purchase' AND event_id % 13 = 5""",
    # trips
    "daily_summary": DAILY + " SELECT * FROM daily",
    "daily_from_months": DAILY + " SELECT * FROM daily",
    "daily_top20": DAILY + " SELECT * FROM daily ORDER BY dt_year DESC, dt_month DESC, dt_day DESC LIMIT 20",
    "daily_totals": DAILY + """ SELECT count(*) AS days, strftime(min(make_date(dt_year, dt_month, dt_day)), '%Y-%m-%d') AS first_day,
        strftime(max(make_date(dt_year, dt_month, dt_day)), '%Y-%m-%d') AS last_day, CAST(sum(num_trips) AS BIGINT) AS num_trips,
        round(avg(num_trips), 6) AS mean_daily_trips FROM daily""",
    "year_filter_count": "SELECT count(*) AS num_trips FROM lineitem WHERE year(l_shipdate) = 1997",
    "trips_profile": "SELECT 'trips' AS source, count(*) AS n_rows, CAST(6 AS INTEGER) AS n_cols FROM lineitem",
    "month_scan": MONTHS,
    "year_scan": MONTHS,
    # session and results
    "even_doubled": "SELECT 2 * event_id AS doubled FROM events WHERE event_id % 2 = 0",
    "sql_count": "SELECT count(*) AS total FROM orders",
    "results_reload": LOGS + USAGE + " SELECT cluster_id, application_id, start_time, end_time FROM pad",
}
