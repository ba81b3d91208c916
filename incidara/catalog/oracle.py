"""SQL that gives the same rows as the registered queries."""

from __future__ import annotations

DAILY = """
inc AS (
  SELECT l_orderkey AS id, l_linenumber AS line_number, o_orderdate AS start_time,
         CAST(o_orderdate AS DATE) AS date, n_name AS city, r_name AS state,
         CAST(substr(o_orderpriority, 1, 1) AS INTEGER) AS severity,
         {temperature} AS temperature_f, l_extendedprice AS humidity_pct,
         {visibility} AS visibility_mi, {precipitation} AS precipitation_in,
         l_returnflag AS weather_condition
  FROM lineitem
  JOIN orders ON l_orderkey = o_orderkey
  JOIN customer ON o_custkey = c_custkey
  JOIN nation ON c_nationkey = n_nationkey
  JOIN region ON n_regionkey = r_regionkey
)"""

INC = DAILY.format(temperature="l_quantity", visibility="l_discount", precipitation="l_tax")
INC_NULLS = DAILY.format(
    temperature="nullif(l_quantity, 13.0)",
    visibility="nullif(l_discount, 0.0)",
    precipitation="nullif(l_tax, 0.0)",
)


def _mean(column: str, name: str) -> str:
    total = f"CAST(sum(CAST({column} AS DECIMAL(18,4))) AS DOUBLE)"
    return f"{total} / count({column}) AS {name}"


def _panel(key: str = "city") -> str:
    return f"""
panel AS (
  SELECT {key}, date, count(id) AS accident_count,
         {_mean("temperature_f", "temp")}, {_mean("humidity_pct", "humidity")},
         {_mean("visibility_mi", "visibility")}, {_mean("precipitation_in", "precip")},
         {_mean("severity", "sever")}
  FROM inc GROUP BY {key}, date
)"""


def _lagged(key: str = "city") -> str:
    return f"""
lagged AS (
  SELECT * FROM (
    SELECT *, lag(accident_count, 1) OVER w AS lag_1, lag(accident_count, 7) OVER w AS lag_7
    FROM panel WINDOW w AS (PARTITION BY {key} ORDER BY date)
  ) WHERE lag_1 IS NOT NULL AND lag_7 IS NOT NULL
)"""


SPLIT = """CASE WHEN date >= DATE '2001-01-01' THEN 'test'
       WHEN date >= DATE '2000-01-01' THEN 'valid' ELSE 'train' END"""

EVENTS = """
ev AS (
  SELECT event_id AS id, ts AS start_time,
         lead(ts) OVER (PARTITION BY user_id ORDER BY ts, event_id) AS end_time,
         CAST(list_position(['click', 'error', 'purchase', 'signup', 'view'], event_type)
              AS VARCHAR) AS severity,
         event_type, concat('S', CAST(user_id % 50 AS VARCHAR)) AS state, value AS distance,
         CAST(hour(ts) AS INTEGER) AS hours
  FROM events
), timed AS (
  SELECT *, date_diff('second', start_time, end_time) / 60.0 AS minutes FROM ev
), model AS (
  SELECT id, hours AS hour, severity, state, distance, CAST(minutes AS DOUBLE) AS duration_minutes
  FROM timed WHERE minutes > 0 AND minutes < 720 AND distance IS NOT NULL
)"""

REPEATING = "city, state, severity, temperature_f, visibility_mi, precipitation_in, weather_condition"
CITY_MEANS = """means AS (
  SELECT city, avg(severity) AS avg_severity, avg(temperature_f) AS avg_temp, avg(humidity_pct) AS avg_humidity,
         avg(visibility_mi) AS avg_visibility, avg(precipitation_in) AS avg_precip
  FROM inc GROUP BY city)"""
HASH_SHARE = "CAST(concat('0x', substr(md5(CAST({key} AS VARCHAR)), 1, 8)) AS BIGINT) / CAST(4294967296 AS DOUBLE)"
PANEL = f"WITH {INC}, {_panel()}"
LAGGED = f"{PANEL}, {_lagged()}"
HOURLY = f"WITH {EVENTS}"
PANEL_COLUMNS = "city, date, accident_count, temp, humidity, visibility, precip, sever"
PROFILE = f"""WITH {INC}
SELECT city, {_mean("severity", "avg_severity")}, {_mean("temperature_f", "avg_temp")},
       {_mean("humidity_pct", "avg_humidity")}, {_mean("visibility_mi", "avg_visibility")},
       {_mean("precipitation_in", "avg_precip")}
FROM inc GROUP BY city"""
COMPLETE_WEATHER = """temperature_f IS NOT NULL AND humidity_pct IS NOT NULL
  AND visibility_mi IS NOT NULL AND precipitation_in IS NOT NULL"""
NULLABLE = [
    "id", "line_number", "start_time", "date", "city", "state", "severity", "temperature_f",
    "humidity_pct", "visibility_mi", "precipitation_in", "weather_condition",
]
WEATHER = ["temperature_f", "humidity_pct", "visibility_mi", "precipitation_in"]
FEATURES = [
    "dayofweek(date) + 1", "month(date)",
    "CASE WHEN dayofweek(date) IN (0, 6) THEN 1 ELSE 0 END",
    "temp", "humidity", "visibility", "precip", "sever", "lag_1", "lag_7", "quarter(date)",
]


def _index(column: str) -> str:
    return f"""
{column}_rank AS (
  SELECT {column}, CAST(row_number() OVER (ORDER BY count(*) DESC, {column}) - 1 AS DOUBLE)
         AS {column}_idx
  FROM ev GROUP BY {column}
)"""


def _best_cut(name: str, table: str, label: str, values: dict[str, str]) -> str:
    """CTE ``name``: feature, cut and the means of ``label`` up to the cut and above it, for the
    cut of least squared error over ``table``; ``values`` gives each feature's ordered value."""
    long = " UNION ALL ".join(
        f"SELECT '{feature}' AS feature, CAST({value} AS DOUBLE) AS value, count(*) AS n, sum({label}) AS s"
        f" FROM {table} GROUP BY ALL"
        for feature, value in values.items()
    )
    return f"""
{name}_cells AS ({long}),
{name}_sums AS (
  SELECT feature, value AS cut, sum(n) OVER upto AS n_low, sum(s) OVER upto AS s_low,
         sum(n) OVER whole AS n_all, sum(s) OVER whole AS s_all
  FROM {name}_cells
  WINDOW upto AS (PARTITION BY feature ORDER BY value), whole AS (PARTITION BY feature)),
{name} AS (
  SELECT feature, cut, s_low / n_low AS low, (s_all - s_low) / (n_all - n_low) AS high
  FROM {name}_sums WHERE n_low < n_all
  ORDER BY s_low * s_low / n_low + (s_all - s_low) * (s_all - s_low) / (n_all - n_low) DESC LIMIT 1)"""


def _by_cut(name: str, values: dict[str, str]) -> str:
    value = " ".join(f"WHEN '{feature}' THEN {value}" for feature, value in values.items())
    return f"CASE WHEN CASE {name}.feature {value} END <= {name}.cut THEN {name}.low ELSE {name}.high END"


CALENDAR = {"day_of_week": "dayofweek(date)", "month": "month(date)"}
BOOSTED = f"""{LAGGED}, days AS (
  SELECT city, date, ln(1 + accident_count) AS y FROM lagged),
train AS (SELECT * FROM days WHERE date < DATE '2000-01-01'),
{_best_cut("one", "train", "y", CALENDAR)},
rest AS (SELECT date, 2 * (y - {_by_cut("one", CALENDAR)}) AS residual FROM train, one),
{_best_cut("two", "rest", "residual", CALENDAR)},
boosted AS (
  SELECT city, date, y, {_by_cut("one", CALENDAR)} AS first,
         {_by_cut("one", CALENDAR)} + CAST(0.1 AS DOUBLE) * ({_by_cut("two", CALENDAR)}) AS second
  FROM days, one, two)"""
FOLD_SPANS = [("2000-01-01", "2000-07-02"), ("2000-07-02", "2001-01-01")]
FOLD_SIZES = " UNION ALL ".join(
    f"SELECT CAST({n} AS INTEGER) AS fold, DATE '{start}' AS valid_start, count(*) FILTER (date < DATE '{start}') AS train_rows, "
    f"count(*) FILTER (date >= DATE '{start}' AND date < DATE '{end}') AS valid_rows, "
    f"max(date) FILTER (date < DATE '{start}') AS last_train_day FROM lagged"
    for n, (start, end) in enumerate(FOLD_SPANS)
)
FOLD_NAIVE = " UNION ALL ".join(
    f"SELECT CAST({n} AS INTEGER) AS fold, round(sqrt(avg(pow(ln(1 + accident_count) - ln(1 + lag_1), 2))), 6) AS rmse "
    f"FROM lagged WHERE date >= DATE '{start}' AND date < DATE '{end}'"
    for n, (start, end) in enumerate(FOLD_SPANS)
)
FOLD_GRID = f"""{LAGGED}, days AS (SELECT city, date, ln(1 + accident_count) AS y FROM lagged)""" + "".join(
    f""", train{n} AS (SELECT * FROM days WHERE date < DATE '{start}'),{_best_cut(f"cut{n}", f"train{n}", "y", CALENDAR)}"""
    for n, (start, _) in enumerate(FOLD_SPANS)
) + " " + " UNION ALL ".join(
    f"""SELECT CAST({n} AS INTEGER) AS fold, round(sqrt(avg(pow(y - {_by_cut(f"cut{n}", CALENDAR)}, 2))), 6) AS rmse
FROM days, cut{n} WHERE date >= DATE '{start}' AND date < DATE '{end}'"""
    for n, (start, end) in enumerate(FOLD_SPANS)
)


def _map_cells(level: int) -> str:
    """CTE ``cells``: level, cell, n of every level, cells by their bits taken in turn."""
    return f"""
places AS (
  SELECT CASE WHEN event_id % 3 = 0 THEN 50.0::DOUBLE + (event_id % 100) / 1024.0::DOUBLE
              ELSE (event_id * 7919) % 2880 / 16.0::DOUBLE - 90 END AS lat,
         CASE WHEN event_id % 3 = 0 THEN 10.0::DOUBLE + (event_id % 77) / 1024.0::DOUBLE
              ELSE (event_id * 104729) % 5760 / 16.0::DOUBLE - 180 END AS lon FROM events),
steps AS (
  SELECT CAST(l AS INTEGER) AS level, least(pow(2, l) - 1, floor((lon + 180) / 360 * pow(2, l)))::BIGINT AS x,
         least(pow(2, l) - 1, floor((lat + 90) / 180 * pow(2, l)))::BIGINT AS y
  FROM places, unnest(range(0, {level + 1})) AS t(l)),
cells AS (
  SELECT level, CAST(coalesce(list_sum(list_transform(range(0, level), lambda b:
           ((x >> b) & 1) * pow(4, b)::BIGINT + ((y >> b) & 1) * 2 * pow(4, b)::BIGINT)), 0) AS BIGINT) AS cell, count(*) AS n
  FROM steps GROUP BY ALL)"""


BY_SEVERITY = {"hour": "hour", "severity": "place"}

DURATION_CUT = f"""{HOURLY}, parts AS (
  SELECT *, {HASH_SHARE.format(key="id")} < CAST(0.8 AS DOUBLE) AS in_train FROM model),
places AS (
  SELECT severity, row_number() OVER (ORDER BY avg(duration_minutes)) AS place
  FROM parts WHERE in_train GROUP BY severity),
placed AS (SELECT * FROM parts JOIN places USING (severity)),
train AS (SELECT * FROM placed WHERE in_train),
{_best_cut("one", "train", "duration_minutes", BY_SEVERITY)}
SELECT id, round({_by_cut("one", BY_SEVERITY)}, 6) AS prediction FROM placed, one WHERE NOT in_train"""

ORACLE: dict[str, str] = {
    "city_day_panel": f"{PANEL} SELECT {PANEL_COLUMNS} FROM panel",
    "city_day_join": f"{PANEL} SELECT {PANEL_COLUMNS} FROM panel",
    "count_series": f"{PANEL} SELECT city, date, accident_count FROM panel",
    "lag_features": f"{LAGGED} SELECT city, date, accident_count, lag_1, lag_7 FROM lagged",
    "lag_features_state": f"""WITH {INC}, {_panel("state")}, {_lagged("state")}
SELECT state, date, accident_count, lag_1, lag_7 FROM lagged""",
    "city_profile": PROFILE,
    "city_profile_rollup": PROFILE,
    "top_cities": f"""WITH {INC}
SELECT city, count(id) AS total_accidents FROM inc GROUP BY city
ORDER BY total_accidents DESC, city LIMIT 20""",
    "top_cities_heavy": f"""WITH {INC}
SELECT city, count(id) AS total_accidents FROM inc GROUP BY city
ORDER BY total_accidents DESC, city LIMIT 20""",
    "top_orders_heavy": f"""WITH {INC}
SELECT id, CAST(sum(CAST(trunc(temperature_f) AS BIGINT)) AS BIGINT) AS total_quantity FROM inc GROUP BY id
ORDER BY total_quantity DESC, id LIMIT 25""",
    "distinct_landed": f"""WITH {INC}, days AS (
  SELECT * FROM inc WHERE date BETWEEN DATE '2000-07-01' AND DATE '2001-03-31')
SELECT 'id' AS measure, count(id) AS n_values, count(DISTINCT id) AS exact, TRUE AS within_bounds FROM days
UNION ALL
SELECT 'city', count(city), count(DISTINCT city), TRUE FROM days
UNION ALL
SELECT 'row', count(*), (SELECT count(*) FROM (SELECT DISTINCT date, city, severity, weather_condition FROM days)), TRUE
FROM days""",
    "top_cities_test": f"""{LAGGED}
SELECT city, CAST(sum(accident_count) AS BIGINT) AS total_accidents FROM lagged
WHERE date >= DATE '2001-01-01' GROUP BY city ORDER BY total_accidents DESC, city LIMIT 5""",
    "week_slice": f"""{PANEL}
SELECT city, date, accident_count FROM panel WHERE year(date) = 1998 AND week(date) = 10""",
    "time_parts": """
SELECT event_id AS id, CAST(ts AS DATE) AS date, CAST(hour(ts) AS INTEGER) AS hour,
       CAST(dayofweek(ts) + 1 AS INTEGER) AS day_of_week, CAST(month(ts) AS INTEGER) AS month,
       CAST(quarter(ts) AS INTEGER) AS quarter, CAST(year(ts) AS INTEGER) AS year,
       CAST(week(ts) AS INTEGER) AS iso_week,
       CASE WHEN dayofweek(ts) IN (0, 6) THEN 1 ELSE 0 END AS is_weekend
FROM events""",
    "log_target": f"""{PANEL}
SELECT city, date, round(ln(1 + accident_count), 9) AS accident_count_log FROM panel""",
    "back_transform": f"""{LAGGED}, counted AS (
  SELECT city, date, exp(ln(1 + lag_1) - 2) - 1 AS n FROM lagged)
SELECT city, date, round(n, 9) AS predicted_count,
       CAST(CASE WHEN round(n) < 0 THEN 0 ELSE round(n) END AS INTEGER) AS predicted_count_rounded
FROM counted""",
    "lenient_parse": """WITH raw AS (
  SELECT event_id AS id,
         CASE WHEN event_id % 7 = 0 THEN 'bad' ELSE CAST(ts AS VARCHAR) END AS ts,
         CASE WHEN event_id % 7 = 1 THEN 'x1' ELSE CAST(value AS VARCHAR) END AS distance
  FROM events)
SELECT id, try_cast(ts AS TIMESTAMP) AS ts, try_cast(distance AS DOUBLE) AS distance FROM raw""",
    "split_time": f"""{LAGGED}
SELECT {SPLIT} AS split, count(*) AS rows FROM lagged GROUP BY 1""",
    "split_bounds": f"""{LAGGED}, labelled AS (
  SELECT {SPLIT} AS split, min(date) AS first_date, max(accident_count) AS top
  FROM lagged GROUP BY 1)
SELECT split, first_date,
       CAST((SELECT top FROM labelled WHERE split = 'train') AS DOUBLE)
         * CAST(0.95 AS DOUBLE) AS text_height
FROM labelled WHERE split <> 'train'""",
    "split_series": f"""{LAGGED}
SELECT city, date, accident_count, {SPLIT} AS split FROM lagged""",
    "split_hash": f"""
SELECT event_id AS id,
       CASE WHEN {HASH_SHARE.format(key="event_id")} < CAST(0.8 AS DOUBLE) THEN 'train' ELSE 'valid' END AS split
FROM events""",
    "split_hash_fine": f"""
SELECT event_id AS id,
       CASE WHEN {HASH_SHARE.format(key="event_id")} < 0.125 THEN 'train' ELSE 'valid' END AS split
FROM events""",
    "sample_exact_strata": """WITH ranked AS (
  SELECT event_id AS id, event_id % 10 AS bucket,
         row_number() OVER (PARTITION BY event_id % 10
           ORDER BY md5(concat('42:', CAST(event_id AS VARCHAR))), event_id) AS n,
         count(*) OVER (PARTITION BY event_id % 10) AS total
  FROM events)
SELECT id, bucket FROM ranked WHERE n <= round_even(CAST(0.01 AS DOUBLE) * total, 0)""",
    "hour_severity_counts": f"""{HOURLY}
SELECT hours, severity, count(*) AS accident_count FROM ev GROUP BY hours, severity""",
    "hour_counts": f"{HOURLY} SELECT hours, count(*) AS accident_count FROM ev GROUP BY hours",
    "severity_slice": f"""{HOURLY}
SELECT hours, count(*) AS accident_count FROM ev WHERE severity = '2' GROUP BY hours""",
    "severity_levels": f"""{HOURLY}
SELECT hours, CAST(severity AS INTEGER) AS level, count(*) AS accident_count
FROM ev WHERE severity IN ('1', '2', '3', '4') GROUP BY hours, severity""",
    "duration_minutes": f"""{HOURLY}
SELECT id, round(CAST(minutes AS DOUBLE), 9) AS duration_minutes FROM timed""",
    "duration_filter": f"""{HOURLY}
SELECT id, round(CAST(minutes AS DOUBLE), 9) AS duration_minutes FROM timed
WHERE minutes > 0 AND minutes < 720""",
    "duration_model_table": f"""{HOURLY}
SELECT hour, severity, state, distance, round(duration_minutes, 9) AS duration_minutes
FROM model""",
    "duration_by_hour": f"""{HOURLY}, naive AS (
  SELECT state, avg(duration_minutes) AS prediction FROM model GROUP BY state)
SELECT hour, round(avg(duration_minutes), 6) AS actual_avg_duration,
       round(avg(prediction), 6) AS predicted_avg_duration
FROM model JOIN naive USING (state) GROUP BY hour""",
    "nonnull_profile": f"WITH {INC_NULLS} "
    + " UNION ALL ".join(
        f"SELECT '{name}' AS column_name, count({name}) AS non_null FROM inc" for name in NULLABLE
    ),
    "row_counts": f"""WITH {INC_NULLS}
SELECT 'loaded' AS stage, count(*) AS rows FROM inc
UNION ALL SELECT 'complete_weather', count(*) FROM inc WHERE {COMPLETE_WEATHER}
UNION ALL SELECT 'complete', count(*) FROM inc
WHERE {" AND ".join(f"{name} IS NOT NULL" for name in NULLABLE)}""",
    "drop_any_null": f"""WITH {INC_NULLS}
SELECT * FROM inc WHERE {" AND ".join(f"{name} IS NOT NULL" for name in NULLABLE)}""",
    "drop_subset_null": f"""WITH {INC_NULLS}
SELECT * FROM inc WHERE temperature_f IS NOT NULL AND precipitation_in IS NOT NULL""",
    "impute_mean": f"""WITH {INC_NULLS}
SELECT id, line_number, {", ".join(
        f"round(coalesce({name}, avg({name}) OVER ()), 6) AS {name}" for name in WEATHER
    )} FROM inc""",
    "duplicate_audit": f"""WITH {INC}
SELECT count(*) AS total_rows,
       (SELECT count(*) FROM (SELECT DISTINCT city, state, severity FROM inc)) AS unique_rows
FROM inc""",
    "duplicate_audit_hash": f"""WITH {INC_NULLS}
SELECT count(*) AS total_rows, (SELECT count(*) FROM (SELECT DISTINCT {REPEATING} FROM inc)) AS unique_rows
FROM inc""",
    "deduplicate": f"WITH {INC_NULLS} SELECT DISTINCT {REPEATING} FROM inc",
    "csv_roundtrip": "SELECT * FROM orders",
    "csv_strings": "SELECT * FROM orders",
    "csv_headerless": "SELECT * FROM orders",
    "csv_inferred": """
SELECT CAST(o_orderkey AS INTEGER) AS o_orderkey, CAST(o_custkey AS INTEGER) AS o_custkey, o_orderstatus,
       o_totalprice, o_orderdate, o_orderpriority,
       'o_orderkey:int,o_custkey:int,o_orderstatus:string,o_totalprice:double,o_orderdate:timestamp,o_orderpriority:string' AS types
FROM orders""",
    "clean_chain": f"""WITH {INC_NULLS}, d AS (
  SELECT city, CAST(start_time AS DATE) AS day, count(*) AS n FROM inc GROUP BY ALL)
SELECT city, count(*) AS days, CAST(sum(n) AS BIGINT) AS accidents, CAST(14 AS INTEGER) AS n_columns
FROM d GROUP BY city""",
    "landed_days": """
SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice, o_orderdate AS start_time,
       o_orderpriority
FROM orders WHERE o_orderdate >= DATE '1998-03-01' AND o_orderdate < DATE '1999-02-16'""",
    "hour_result_csv": f"{HOURLY} SELECT hours, count(*) AS accident_count FROM ev GROUP BY hours",
    "sample_by_key": """
SELECT event_id AS id FROM events
WHERE CAST(concat('0x', substr(md5(concat('42:', CAST(event_id AS VARCHAR))), 1, 8)) AS BIGINT)
      / CAST(4294967296 AS DOUBLE) < CAST(0.01 AS DOUBLE)""",
    "split_random_cover": "SELECT count(*) AS rows, count(DISTINCT event_id) AS ids FROM events",
    "hour_tree_means": f"""{HOURLY}, hourly AS (
  SELECT hours, count(*) AS n FROM ev GROUP BY hours)
SELECT count(*) AS rows, round(avg(n), 6) AS mean_count, round(avg(n), 6) AS mean_prediction
FROM hourly""",
    "hour_tree_exact": f"""{HOURLY}, h AS (
  SELECT hours, CAST(count(*) AS DOUBLE) AS n FROM ev GROUP BY hours),
root AS (
  SELECT cut FROM (
    SELECT c.hours AS cut,
           sum(n * n) - pow(sum(n) FILTER (h.hours <= c.hours), 2) / count(*) FILTER (h.hours <= c.hours)
             - pow(sum(n) FILTER (h.hours > c.hours), 2) / count(*) FILTER (h.hours > c.hours) AS error
    FROM h, (SELECT hours FROM h WHERE hours < (SELECT max(hours) FROM h)) AS c GROUP BY c.hours)
  ORDER BY error, cut LIMIT 1),
s AS (SELECT hours, n, hours > (SELECT cut FROM root) AS side FROM h),
leaf AS (
  SELECT side, cut FROM (
    SELECT side, cut, row_number() OVER (PARTITION BY side ORDER BY error, cut) AS place FROM (
      SELECT s.side, c.hours AS cut,
             sum(s.n * s.n) - pow(sum(s.n) FILTER (s.hours <= c.hours), 2) / count(*) FILTER (s.hours <= c.hours)
               - pow(sum(s.n) FILTER (s.hours > c.hours), 2) / count(*) FILTER (s.hours > c.hours) AS error
      FROM s JOIN s AS c ON s.side = c.side
      WHERE c.hours < (SELECT max(hours) FROM s AS m WHERE m.side = c.side) GROUP BY s.side, c.hours))
  WHERE place = 1)
SELECT hours, round(avg(n) OVER (PARTITION BY side, hours > coalesce(cut, hours)), 6) AS prediction
FROM s LEFT JOIN leaf USING (side)""",
    "cluster_profile_total": f"""WITH {INC}, {CITY_MEANS}
SELECT count(*) AS cities, CAST(5 AS BIGINT) AS groups, round(avg(avg_temp), 6) AS mean_temp,
       round(avg(avg_humidity), 6) AS mean_humidity, round(avg(avg_severity), 6) AS mean_severity,
       round(avg(avg_visibility), 6) AS mean_visibility, round(avg(avg_precip), 6) AS mean_precip
FROM means""",
    "cluster_nearest": f"""WITH {INC}
SELECT count(DISTINCT city) AS cities, CAST(0 AS BIGINT) AS misplaced FROM inc""",
    "gbt_means": f"""{LAGGED}
SELECT count(*) AS rows, round(avg(ln(1 + accident_count)), 6) AS mean_label,
       round(avg(ln(1 + accident_count)), 6) AS mean_prediction
FROM lagged WHERE date < DATE '2000-01-01'""",
    "gbt_exact": f"""{BOOSTED}
SELECT city, date, round(second, 6) AS prediction FROM boosted WHERE date >= DATE '2001-01-01'""",
    "gbt_grid_exact": f"""{BOOSTED}, errors AS (
  SELECT sqrt(avg(pow(y - first, 2))) AS one_cut, sqrt(avg(pow(y - second, 2))) AS two_cuts
  FROM boosted WHERE date >= DATE '2000-01-01' AND date < DATE '2001-01-01')
SELECT CAST(1 AS BIGINT) AS max_iter, round(one_cut, 6) AS rmse, one_cut <= two_cuts AS is_best FROM errors
UNION ALL
SELECT CAST(2 AS BIGINT), round(two_cuts, 6), two_cuts < one_cut FROM errors""",
    "duration_tree_exact": DURATION_CUT,
    "cluster_profile_file": f"""WITH {INC}, m AS (SELECT severity AS cluster, {_mean("temperature_f", "temp")}, {_mean("humidity_pct", "humidity")},
  {_mean("severity", "sever")}, {_mean("visibility_mi", "visibility")}, {_mean("precipitation_in", "precip")} FROM inc GROUP BY severity)
SELECT cluster, round(temp, 6) AS temp, round(humidity, 6) AS humidity, round(sever, 6) AS sever, round(visibility, 6) AS visibility,
       round(precip, 6) AS precip FROM m WHERE cluster = 2""",
    "importances_file": f"WITH {INC_NULLS} "
    + " UNION ALL ".join(f"SELECT '{name}' AS feature, count({name}) / CAST(4 AS DOUBLE) AS importance FROM inc" for name in NULLABLE),
    "map_cell_counts": f"WITH {_map_cells(8)} SELECT level, cell, n FROM cells",
    "map_cells_split": f"""WITH {_map_cells(14)}
SELECT c.level, c.cell, c.n FROM cells c LEFT JOIN cells p ON p.level = c.level - 1 AND p.cell = c.cell // 4
WHERE (c.n <= 100 OR c.level = 14) AND (c.level = 0 OR p.n > 100)""",
    "severity_tree_exact": f"""{HOURLY}, parts AS (
  SELECT id, hours, severity, {HASH_SHARE.format(key="id")} < CAST(0.8 AS DOUBLE) AS in_train FROM ev),
cuts AS (SELECT DISTINCT hours AS cut FROM parts WHERE in_train AND hours < (SELECT max(hours) FROM parts WHERE in_train)),
sides AS (
  SELECT cut, hours > cut AS side, severity, count(*) AS n FROM cuts, parts WHERE in_train GROUP BY ALL),
scores AS (
  SELECT cut, sum(purity) AS purity FROM (
    SELECT cut, side, sum(CAST(n AS DOUBLE) * n) / sum(n) AS purity FROM sides GROUP BY cut, side) GROUP BY cut),
best AS (SELECT cut FROM scores ORDER BY purity DESC, cut LIMIT 1),
leaves AS (
  SELECT side, first(severity ORDER BY n DESC) AS predicted, round(max(n) / sum(n), 6) AS share
  FROM sides WHERE cut = (SELECT cut FROM best) GROUP BY side)
SELECT id, predicted, share FROM parts, best, leaves WHERE NOT in_train AND side = (hours > best.cut)""",
    "severity_confusion": f"""{HOURLY}
SELECT severity AS actual, CAST(1 + hours % 4 AS VARCHAR) AS predicted, count(*) AS rows FROM ev GROUP BY ALL""",
    "severity_measures": f"""{HOURLY}, s AS (SELECT severity AS actual, CAST(1 + hours % 4 AS VARCHAR) AS predicted FROM ev),
classes AS (SELECT actual AS class FROM s UNION SELECT predicted FROM s),
c AS (
  SELECT class, count(*) FILTER (actual = class) AS rows, count(*) FILTER (predicted = class) AS said,
         count(*) FILTER (actual = class AND predicted = class) AS hits
  FROM classes, s GROUP BY class)
SELECT class, rows, round(hits / nullif(said, 0), 9) AS precision, round(hits / nullif(rows, 0), 9) AS recall,
       CASE WHEN said > 0 AND rows > 0 THEN round(2 * hits / (rows + said), 9) END AS f1
FROM c""",
    "fold_sizes": f"{LAGGED} {FOLD_SIZES}",
    "fold_errors_naive": f"{LAGGED} {FOLD_NAIVE}",
    "fold_grid_exact": FOLD_GRID,
    "duration_tree_folded_exact": DURATION_CUT,
    "duration_cells": f"""{HOURLY}, train AS (
  SELECT * FROM model WHERE {HASH_SHARE.format(key="id")} < CAST(0.8 AS DOUBLE)),
cuts AS (SELECT DISTINCT unnest(quantile_disc(distance, list_transform(range(1, 128), lambda n: n / 128))) AS cut FROM train)
SELECT hour, severity, state, CAST(bin AS INTEGER) AS bin, count(*) AS rows, round(sum(duration_minutes), 6) AS label_sum,
       round(sum(duration_minutes * duration_minutes), 4) AS label_squares
FROM (SELECT *, (SELECT count(*) FROM cuts WHERE cut <= distance) AS bin FROM train) GROUP BY ALL""",
    "duration_fold_check": f"""{HOURLY}
SELECT count(*) AS rows, CAST(0 AS BIGINT) AS mismatches, CAST(0 AS BIGINT) AS wrong_errors
FROM model WHERE NOT {HASH_SHARE.format(key="id")} < CAST(0.8 AS DOUBLE)""",
    "city_groups_line": f"""WITH {INC}, {CITY_MEANS},
placed AS (SELECT city, avg_temp AS v, row_number() OVER (ORDER BY avg_temp) AS p FROM means),
cuts AS (
  SELECT a.p AS first, b.p AS second FROM placed a JOIN placed b ON a.p < b.p WHERE b.p < (SELECT max(p) FROM placed)),
spread AS (
  SELECT first, second, var_pop(v) * count(*) AS cost
  FROM cuts, placed GROUP BY first, second, CASE WHEN p <= first THEN 0 WHEN p <= second THEN 1 ELSE 2 END),
best AS (SELECT first, second FROM spread GROUP BY first, second ORDER BY sum(cost) LIMIT 1)
SELECT city, CAST(CASE WHEN p <= first THEN 0 WHEN p <= second THEN 1 ELSE 2 END AS INTEGER) AS cluster FROM placed, best""",
    "city_groups_check": f"""WITH {INC}
SELECT count(DISTINCT city) AS cities, CAST(5 AS BIGINT) AS groups, CAST(0 AS BIGINT) AS misplaced,
       CAST(0 AS BIGINT) AS better_moves FROM inc""",
    "panel_landed": f"{PANEL} SELECT {PANEL_COLUMNS} FROM panel",
    "profile_landed": PROFILE,
    "top_cities_landed": f"""{PANEL}
SELECT city, CAST(sum(accident_count) AS BIGINT) AS total_accidents FROM panel
WHERE date BETWEEN DATE '2000-07-01' AND DATE '2001-03-31' GROUP BY city ORDER BY total_accidents DESC, city LIMIT 5""",
    "string_index": f"""{HOURLY}, {_index("event_type")}, {_index("state")}
SELECT id, event_type, state, event_type_idx, state_idx
FROM ev JOIN event_type_rank USING (event_type) JOIN state_rank USING (state)""",
    "assemble_features": f"{LAGGED} "
    + " UNION ALL ".join(
        f"SELECT city, date, {n} AS position, CAST({value} AS DOUBLE) AS value FROM lagged"
        for n, value in enumerate(FEATURES)
    ),
    "rmse_naive": f"""{LAGGED}
SELECT {SPLIT} AS split,
       round(sqrt(avg(pow(ln(1 + accident_count) - ln(1 + lag_1), 2))), 6) AS rmse
FROM lagged GROUP BY 1""",
    "city_naive_series": f"""{LAGGED}, test AS (
  SELECT * FROM lagged WHERE date >= DATE '2001-01-01'),
largest AS (
  SELECT city FROM test GROUP BY city ORDER BY sum(accident_count) DESC, city LIMIT 5)
SELECT city, date, accident_count AS actual, lag_1 AS predicted
FROM test WHERE city IN (SELECT city FROM largest)""",
    "duration_tree_means": f"""{HOURLY}
SELECT count(*) AS rows, round(avg(duration_minutes), 6) AS mean_duration,
       round(avg(duration_minutes), 6) AS mean_prediction
FROM model WHERE {HASH_SHARE.format(key="id")} < CAST(0.8 AS DOUBLE)""",
    "model_roundtrip": f"""{HOURLY}
SELECT count(DISTINCT hours) AS rows, CAST(0 AS BIGINT) AS mismatches FROM ev""",
}
