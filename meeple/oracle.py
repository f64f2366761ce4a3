"""DuckDB SQL equivalents of the registered queries (the independent correctness oracle).

Each query is prefixed by the DuckDB twins of the raw-table adapters and of the silver
tables. The SQL is written independently of the Spark code: durations and money are
rounded with integer arithmetic here, with DECIMAL arithmetic in Spark.
"""

from __future__ import annotations

RUN_DATE = "DATE '2024-01-15'"
AS_OF = "DATE '2024-01-27'"

# initcap for one-word labels (DuckDB has no initcap).
def _initcap(x: str) -> str:
    return f"(upper(left({x}, 1)) || lower(substr({x}, 2)))"


# Half-up rounding of total/n to 2 decimals, total an integer count of 10**-places units.
def _half_up_mean(total: str, n: str, places: int) -> str:
    m = 2 * 10 ** (2 - places)
    return (
        f"(CASE WHEN {n} > 0 THEN CAST(sign({total}) * "
        f"(({m} * abs({total}) + {n}) // (2 * {n})) AS DOUBLE) / 100 END)"
    )


RAW = f"""
raw_users AS (
  SELECT CAST(c_custkey AS VARCHAR) AS user_id,
         c_name || CASE WHEN copy = 2 THEN '_2' ELSE '' END AS username, n_name AS country,
         CAST(DATE '2023-10-01' + CAST(c_custkey % 119 AS INTEGER) AS DATE) AS signup_date,
         CASE WHEN c_custkey % 41 = 0 THEN NULL ELSE CAST(10 + c_custkey % 40 AS INTEGER) END AS age,
         CASE c_custkey % 3 WHEN 0 THEN 'Male' WHEN 1 THEN 'Female' ELSE 'Other' END AS gender
  FROM customer JOIN nation ON c_nationkey = n_nationkey
       JOIN (VALUES (1), (2)) AS twice(copy) ON copy = 1 OR c_custkey % 53 = 0
),
raw_logins AS (
  SELECT CAST(user_id AS VARCHAR) AS user_id, CASE WHEN event_id % 31 <> 0 THEN ts END AS "timestamp",
         CASE event_id % 3 WHEN 0 THEN 'iOS' WHEN 1 THEN 'Android' ELSE 'Web' END AS device_type,
         'City_' || CAST(event_id % 50 AS VARCHAR) AS location,
         CAST(ts AS DATE) AS event_date
  FROM events WHERE event_type IN ('signup', 'error')
),
raw_game_sessions AS (
  SELECT CAST(event_id AS VARCHAR) AS session_id,
         CASE WHEN event_id % 89 = 0 THEN NULL
              WHEN user_id % 10 = 3 AND event_id % 16 <> 0 THEN CAST(user_id - 1 AS VARCHAR)
              ELSE CAST(user_id AS VARCHAR) END AS user_id,
         CASE event_id % 3 WHEN 0 THEN 'Arcade' WHEN 1 THEN 'Ranked' ELSE 'Practice' END AS game_type,
         ts AS start_time,
         ts + to_minutes(CAST(2 + event_id % (1 + (user_id % 8) * 8) AS INTEGER))
            + to_seconds(CAST(event_id % 60 AS INTEGER)) AS end_time,
         CAST((event_id * 37) % 1001 AS INTEGER) AS score,
         CASE event_id % 2 WHEN 0 THEN 'WIN' ELSE 'lose' END AS result,
         CAST(ts AS DATE) AS event_date
  FROM events WHERE event_type IN ('click', 'view')
),
raw_purchases AS (
  SELECT CAST(event_id AS VARCHAR) AS purchase_id,
         CASE WHEN event_id % 97 = 0 THEN NULL ELSE CAST(user_id AS VARCHAR) END AS user_id,
         CASE event_id % 4 WHEN 0 THEN 'Skin' WHEN 1 THEN 'Coins' WHEN 2 THEN 'boost' ELSE 'PASS' END AS item,
         CASE WHEN user_id % 4 = 1 THEN value - 10 ELSE -abs(value) END AS amount, ts AS "timestamp", CAST(ts AS DATE) AS event_date
  FROM events WHERE event_type = 'purchase'
),
raw_leaderboard_snapshots AS (
  SELECT user_id, game_type, CAST(rk % 20 AS INTEGER) AS rank, event_date FROM (
    SELECT user_id, game_type, event_date,
           row_number() OVER (PARTITION BY game_type, event_date
             ORDER BY md5(concat_ws('|', user_id, game_type, CAST(event_date AS VARCHAR), 'lb')), user_id) AS rk
    FROM (SELECT user_id, event_date, unnest(['Arcade', 'Ranked', 'Practice']) AS game_type
          FROM (SELECT DISTINCT user_id, event_date FROM raw_logins))
  ) WHERE rk <= 20
)"""


def _silver_sessions(login_source: str = "raw_logins") -> str:
    secs = "(epoch_us(s.end_time) // 1000000 - epoch_us(s.start_time) // 1000000)"
    tenths = f"(sign({secs}) * ((2 * abs({secs}) + 6) // 12))"
    return f"""
  SELECT s.session_id, s.user_id, s.game_type, s.start_time, s.end_time,
         CAST({tenths} AS DOUBLE) / 10 AS session_duration_minutes,
         s.score, {_initcap('lower(s.result)')} AS result, u.age, u.gender, u.country,
         {_initcap('lower(l.device_type)')} AS login_device, l.location AS login_location, s.event_date
  FROM raw_game_sessions s
  LEFT JOIN raw_users u ON s.user_id = u.user_id
  LEFT JOIN {login_source} l ON s.user_id = l.user_id AND s.event_date = l.event_date"""


FIRST_LOGINS = """
  SELECT user_id, event_date, device_type, location FROM (
    SELECT *, row_number() OVER (PARTITION BY user_id, event_date
                                 ORDER BY "timestamp", device_type, location) AS rn
    FROM raw_logins) WHERE rn = 1"""

SILVER_PURCHASES = f"""
  SELECT p.purchase_id, p.user_id, {_initcap('p.item')} AS item,
         CAST(round(CAST(p.amount AS DECIMAL(38,12)), 2) AS DOUBLE) AS amount,
         p."timestamp", u.age, u.gender, u.country, u.signup_date, p.event_date
  FROM raw_purchases p LEFT JOIN raw_users u ON p.user_id = u.user_id
  WHERE p.user_id IS NOT NULL AND p.amount > 0"""

# The players of a day with the scores of each game gathered into a list (a list with one NULL
# where a player has none), then unnested again.
SILVER_LEADERBOARD = """
  WITH played AS (
    SELECT user_id, game_type, event_date, list(score) AS scores
    FROM raw_game_sessions GROUP BY ALL),
  listed AS (
    SELECT * FROM raw_leaderboard_snapshots WHERE rank > 0 AND user_id IS NOT NULL)
  SELECT b.user_id, b.game_type, b.rank, unnest(coalesce(p.scores, [NULL])) AS score,
         a.age, a.gender, a.country, b.event_date
  FROM listed b LEFT JOIN played p USING (user_id, game_type, event_date)
                LEFT JOIN raw_users a USING (user_id)"""

# Every silver row is a contribution (sessions, tenths of minutes, timed sessions, cents,
# purchases) to its user; one grouped UNION ALL adds them up. Age brackets are ranges of a table.
DEMOGRAPHICS = f"""
contributions AS (
  SELECT user_id, 1 AS n, CAST(round(session_duration_minutes * 10) AS BIGINT) AS tenths,
         CAST(session_duration_minutes IS NOT NULL AS BIGINT) AS timed, NULL AS cents, 0 AS bought
  FROM silver_user_sessions
  UNION ALL
  SELECT user_id, 0, NULL, 0, CAST(round(amount * 100) AS BIGINT), 1 FROM silver_purchases_enriched),
user_totals AS (
  SELECT user_id, sum(n) AS n, sum(tenths) AS tenths, sum(timed) AS timed, sum(cents) AS cents, sum(bought) AS bought
  FROM contributions GROUP BY user_id),
session_metrics AS (
  SELECT user_id, CAST(n AS BIGINT) AS total_sessions, {_half_up_mean('CAST(tenths AS BIGINT)', 'CAST(timed AS BIGINT)', 1)} AS avg_session_duration
  FROM user_totals WHERE n > 0),
purchase_metrics AS (
  SELECT user_id, CAST(cents AS DOUBLE) / 100 AS total_spent, CAST(bought AS BIGINT) AS num_purchases
  FROM user_totals WHERE bought > 0),
brackets(lowest, highest, age_bracket) AS (
  VALUES (13, 17, '13-17'), (18, 25, '18-25'), (26, 35, '26-35'), (36, 45, '36-45')),
demographics AS (
  SELECT person.user_id, person.gender, ifnull(b.age_bracket, '45+') AS age_bracket, person.country,
         person.signup_date AS registration_date, CAST(ifnull(t.n, 0) AS BIGINT) AS total_sessions,
         ifnull({_half_up_mean('CAST(t.tenths AS BIGINT)', 'CAST(t.timed AS BIGINT)', 1)}, 0.0) AS avg_session_duration,
         ifnull(CAST(t.cents AS DOUBLE), 0.0) / 100 AS total_spent, CAST(ifnull(t.bought, 0) AS BIGINT) AS num_purchases
  FROM raw_users person
  LEFT JOIN brackets b ON person.age >= b.lowest AND person.age <= b.highest
  LEFT JOIN user_totals t USING (user_id)),
aged AS (
  SELECT *, CAST(datediff('day', registration_date, {AS_OF}) AS INTEGER) AS user_age_days
  FROM demographics)"""


def _rate_rule(min_minutes: float) -> str:
    return (
        "(total_spent = 0 AND ((total_sessions / NULLIF(user_age_days, 0)) < 0.25 "
        f"OR avg_session_duration < {min_minutes}))"
    )


RULES = {
    "rate_15": _rate_rule(15),
    "rate_5": _rate_rule(5),
    "simple": "(total_sessions < 3 AND total_spent = 0)",
    "draft": "((total_sessions < 4 OR avg_session_duration < 10) AND total_spent = 0)",
}

SEGMENTS = f"""
inactive AS (SELECT * FROM aged WHERE {RULES['rate_15']}),
active AS (SELECT * FROM aged EXCEPT SELECT * FROM inactive),
clustered AS (SELECT *, CAST(CAST(user_id AS BIGINT) % 3 AS INTEGER) AS cluster FROM active),
profile AS (
  SELECT cluster,
         CAST(sum(CAST(round(total_spent * 100) AS BIGINT)) AS DOUBLE) / CAST(count(*) * 100 AS DOUBLE) AS avg_spent,
         CAST(sum(CAST(round(avg_session_duration * 100) AS BIGINT)) AS DOUBLE) / CAST(count(*) * 100 AS DOUBLE) AS avg_duration
  FROM clustered GROUP BY cluster),
spend_ranked AS (
  SELECT *, row_number() OVER (ORDER BY avg_spent DESC, cluster ASC) AS sr FROM profile),
duration_ranked AS (
  SELECT cluster, row_number() OVER (ORDER BY avg_duration DESC, cluster ASC) AS dr
  FROM spend_ranked WHERE sr > 1),
labels AS (
  SELECT s.cluster, s.avg_spent, s.avg_duration,
         CASE WHEN s.sr = 1 THEN 'Whale' WHEN d.dr = 1 THEN 'Hardcore' ELSE 'Casual' END AS user_segment
  FROM spend_ranked s LEFT JOIN duration_ranked d ON s.cluster = d.cluster),
segmented AS (
  SELECT c.* EXCLUDE (cluster), l.user_segment FROM clustered c LEFT JOIN labels l ON c.cluster = l.cluster
  UNION ALL
  SELECT *, 'Inactive' AS user_segment FROM inactive)"""

PRELUDE = f"""WITH {RAW},
first_logins AS ({FIRST_LOGINS}),
silver_user_sessions AS ({_silver_sessions()}),
silver_user_sessions_one_login AS ({_silver_sessions('first_logins')}),
silver_purchases_enriched AS ({SILVER_PURCHASES}),
silver_leaderboard_enriched AS ({SILVER_LEADERBOARD}),{DEMOGRAPHICS},{SEGMENTS}"""


def _q(body: str, extra_ctes: str = "") -> str:
    return f"{PRELUDE}{',' + extra_ctes if extra_ctes else ''}\n{body}"


def _summary_ctes(name: str, sessions: str, where: str = "") -> str:
    """CTEs ending in ``name``: the daily summary over a silver sessions CTE. A day's winners are
    the first of its hours (devices) by count, then value, in an ordered aggregate."""
    mean_dur = _half_up_mean("CAST(sum(tenths) AS BIGINT)", "CAST(count(tenths) AS BIGINT)", 1)
    mean_amount = _half_up_mean("CAST(sum(cents) AS BIGINT)", "count(cents)", 2)
    return f"""
{name}_rows AS (
  SELECT event_date, user_id, login_device, CAST(hour(start_time) AS INTEGER) AS started,
         CAST(round(session_duration_minutes * 10) AS BIGINT) AS tenths
  FROM {sessions} {where}),
{name}_totals AS (
  SELECT event_date, count(*) AS total_sessions, {mean_dur} AS avg_session_duration,
         count(DISTINCT user_id) AS unique_active_users
  FROM {name}_rows GROUP BY event_date),
{name}_winners AS (
  SELECT event_date,
         first(started ORDER BY size DESC, started NULLS LAST) FILTER (kind = 'hour') AS peak_hour,
         first(login_device ORDER BY size DESC, login_device NULLS LAST) FILTER (kind = 'device') AS top_device_type
  FROM (SELECT event_date, started, login_device, count(*) AS size,
               CASE WHEN grouping(started) = 0 THEN 'hour' ELSE 'device' END AS kind
        FROM {name}_rows GROUP BY GROUPING SETS ((event_date, started), (event_date, login_device)))
  GROUP BY event_date),
{name}_rev AS (
  SELECT event_date, CAST(sum(cents) AS DOUBLE) / 100 AS total_revenue, {mean_amount} AS avg_purchase_amount
  FROM (SELECT event_date, CAST(round(amount * 100) AS BIGINT) AS cents FROM silver_purchases_enriched {where})
  GROUP BY event_date),
{name} AS (
  SELECT event_date, total_sessions, avg_session_duration, unique_active_users,
         total_revenue, avg_purchase_amount, top_device_type, peak_hour
  FROM {name}_totals JOIN {name}_winners USING (event_date) LEFT JOIN {name}_rev USING (event_date))"""


def _daily_summary(where: str = "") -> str:
    return _q("SELECT * FROM summary", _summary_ctes("summary", "silver_user_sessions", where))


SUMMARY_COLUMNS = [
    "event_date", "total_sessions", "avg_session_duration", "unique_active_users",
    "total_revenue", "avg_purchase_amount", "top_device_type", "peak_hour",
]

# Two versions of the gold table: from one-login silver without the last third of the days (old),
# and from the full silver without the first third (new).
VERSIONS = (
    _summary_ctes("old_all", "silver_user_sessions_one_login")
    + ","
    + _summary_ctes("new_all", "silver_user_sessions")
    + """,
span AS (SELECT min(event_date) AS first_day, datediff('day', min(event_date), max(event_date)) AS days FROM raw_game_sessions),
old_v AS (SELECT * FROM old_all WHERE event_date <= (SELECT first_day + CAST(days - days // 3 AS INTEGER) FROM span)),
new_v AS (SELECT * FROM new_all WHERE event_date >= (SELECT first_day + CAST(days // 3 AS INTEGER) FROM span))"""
)


def _changes_sql() -> str:
    differs = " OR ".join(f"o.{c} IS DISTINCT FROM n.{c}" for c in SUMMARY_COLUMNS)
    cols_o = ", ".join(f"o.{c}" for c in SUMMARY_COLUMNS)
    cols_n = ", ".join(f"n.{c}" for c in SUMMARY_COLUMNS)
    return _q(
        f"""
SELECT *, 'delete' AS _change_type FROM old_v WHERE event_date NOT IN (SELECT event_date FROM new_v)
UNION ALL
SELECT *, 'insert' AS _change_type FROM new_v WHERE event_date NOT IN (SELECT event_date FROM old_v)
UNION ALL
SELECT {cols_o}, 'update_preimage' AS _change_type
FROM old_v o JOIN new_v n ON o.event_date = n.event_date WHERE {differs}
UNION ALL
SELECT {cols_n}, 'update_postimage' AS _change_type
FROM old_v o JOIN new_v n ON o.event_date = n.event_date WHERE {differs}""",
        VERSIONS,
    )


def _earnings(key: str | None) -> str:
    cents = "CAST(round(amount * 100) AS BIGINT)"
    select_key = f"{key}, " if key else ""
    group = f" GROUP BY {key}" if key else ""
    return _q(
        f"SELECT {select_key}CAST(sum({cents}) AS DOUBLE) / 100 AS revenue, "
        f"count(amount) AS purchases, {_half_up_mean(f'sum({cents})', 'count(amount)', 2)} AS avg_amount "
        f"FROM silver_purchases_enriched{group}"
    )


def _draw(keys: str, seed: str) -> str:
    """The 32-bit draw md5(keys|seed) read as an unsigned number."""
    return f"('0x' || substr(md5(concat_ws('|', {keys}, '{seed}')), 1, 8))::BIGINT"


FEATURE_COLUMNS = ["total_sessions", "avg_session_duration", "total_spent", "num_purchases"]



def _scaled(source: str) -> str:
    """``source`` with z_<feature> columns: zero mean, unit sample deviation."""
    return (
        "SELECT *, "
        + ", ".join(f"CASE WHEN sd_{c} = 0 THEN 0 ELSE ({c} - m_{c}) / sd_{c} END AS z_{c}" for c in FEATURE_COLUMNS)
        + " FROM (SELECT *, "
        + ", ".join(f"avg({c}) OVER () AS m_{c}, stddev_samp({c}) OVER () AS sd_{c}" for c in FEATURE_COLUMNS)
        + f" FROM {source})"
    )


GIVEN_CENTROIDS = [(-0.5, -0.5, -0.5, -0.5), (0.5, 1.0, -0.25, -0.25), (0.25, 0.0, 1.5, 1.5)]


def _given_scores() -> str:
    points = ", ".join(f"({i}, {', '.join(map(str, p))})" for i, p in enumerate(GIVEN_CENTROIDS))
    distance = " + ".join(f"(z_{c} - p{i}) ** 2" for i, c in enumerate(FEATURE_COLUMNS))
    cents = "CAST(round({} * 100) AS BIGINT)"
    kept = "user_id, gender, age_bracket, country, registration_date, total_sessions, avg_session_duration, total_spent, num_purchases, user_age_days"
    return _q(
        f"""SELECT {kept}, CASE WHEN cluster = whale THEN 'Whale' WHEN cluster = hardcore THEN 'Hardcore' ELSE 'Casual' END AS user_segment
FROM given_nearest, given_names
UNION ALL SELECT {kept}, 'Inactive' FROM given_inactive""",
        f"""
given_inactive AS (SELECT * FROM aged WHERE {RULES['rate_5']}),
given_active AS (SELECT * FROM aged EXCEPT SELECT * FROM given_inactive),
given_points(cluster, p0, p1, p2, p3) AS (VALUES {points}),
given_nearest AS (
  SELECT {kept}, arg_min(cluster, {distance}) AS cluster
  FROM ({_scaled('given_active')}), given_points GROUP BY ALL),
given_means AS (
  SELECT cluster, sum({cents.format('total_spent')}) / count(*) AS spent, sum({cents.format('avg_session_duration')}) / count(*) AS minutes
  FROM given_nearest GROUP BY cluster),
given_whale AS (SELECT arg_max(cluster, spent) AS whale FROM given_means),
given_names AS (
  SELECT whale, (SELECT arg_max(cluster, minutes) FROM given_means WHERE cluster <> whale) AS hardcore FROM given_whale)""",
    )


def _given_silhouette() -> str:
    """Mean over users of (b - a) / max(a, b): a the mean squared distance to the other users of the
    own cluster, b the least mean to another cluster; 0 for a user alone in its cluster."""
    distance = " + ".join(f"(x.z_{c} - y.z_{c}) ** 2" for c in FEATURE_COLUMNS)
    return _q(
        """SELECT CAST(round(avg(CASE WHEN own IS NULL THEN 0 WHEN own < other THEN 1 - own / other
                             WHEN own > other THEN other / own - 1 ELSE 0 END), 6) AS DOUBLE) AS silhouette
FROM (SELECT id, max(total / CASE WHEN n > 1 THEN n - 1 END) FILTER (same) AS own, min(total / n) FILTER (NOT same) AS other
      FROM (SELECT x.id, x.cluster = y.cluster AS same, y.cluster, sum("""
        + distance
        + """) AS total, count(*) AS n
            FROM given_scaled x, given_scaled y GROUP BY x.id, x.cluster, y.cluster) GROUP BY id)""",
        f"""
given_scaled AS (
  SELECT *, row_number() OVER () AS id, CAST(user_id AS BIGINT) % 3 AS cluster FROM ({_scaled('active')}))""",
    )


# The K-means of whole numbers. Each step is a table expression: features in units, the scaler from
# their sums, a farthest-point walk over the candidates, and the rounds, all k side by side.
_XS, _QS = ["x0", "x1", "x2", "x3"], ["q0", "q1", "q2", "q3"]
USER_COLUMNS = (
    "user_id, gender, age_bracket, country, registration_date, total_sessions, avg_session_duration, total_spent, "
    "num_purchases, user_age_days"
)


def _floor(a: str, b: str) -> str:
    return f"((({a}) - ((({a}) % ({b})) + ({b})) % ({b})) // ({b}))"


def _root(v: str) -> str:
    """The whole square root of a whole number."""
    r = f"CAST(floor(sqrt(CAST({v} AS DOUBLE))) AS HUGEINT)"
    return f"(CASE WHEN {r} * {r} > {v} THEN {r} - 1 WHEN ({r} + 1) * ({r} + 1) <= {v} THEN {r} + 1 ELSE {r} END)"


def _away(a: str, b: str) -> str:
    return " + ".join(f"({a}.{q} - {b}.{q}) * ({a}.{q} - {b}.{q})" for q in _QS)


def _features(name: str, source: str) -> str:
    """``name``: the users of ``source`` with q0..q3."""
    variance = "1000000 * (n * t{0} - s{0} * s{0}) // (n * greatest(n - 1, 1))"
    q = lambda i: (
        f"CASE WHEN d{i} = 0 THEN 0 ELSE CAST({_floor(f'(x{i} * n - s{i}) * 1000000', f'n * d{i}')} AS BIGINT) END AS q{i}"
    )
    return f"""
{name}_units AS MATERIALIZED (
  SELECT *, CAST(total_sessions AS HUGEINT) AS x0, CAST(round(avg_session_duration * 100) AS HUGEINT) AS x1,
         CAST(round(total_spent * 100) AS HUGEINT) AS x2, CAST(num_purchases AS HUGEINT) AS x3 FROM {source}),
{name}_sums AS MATERIALIZED (
  SELECT CAST(count(*) AS HUGEINT) AS n, {', '.join(f'CAST(sum(x{i}) AS HUGEINT) AS s{i}, CAST(sum(x{i} * x{i}) AS HUGEINT) AS t{i}' for i in range(4))}
  FROM {name}_units),
{name}_variances AS MATERIALIZED (SELECT *, {', '.join(f'{variance.format(i)} AS v{i}' for i in range(4))} FROM {name}_sums),
{name}_scaler AS MATERIALIZED (SELECT n, s0, s1, s2, s3, {', '.join(f'{_root(f"v{i}")} AS d{i}' for i in range(4))} FROM {name}_variances),
{name} AS MATERIALIZED (SELECT {name}_units.*, {', '.join(q(i) for i in range(4))} FROM {name}_units, {name}_scaler)"""


def _centres(name: str, users: str, ks: list[int], rounds: int = 20) -> str:
    """``name``: k, cluster, q0..q3 of the models fitted to ``users`` (of :func:`_features`)."""
    ctes = [
        f"""
{name}_points AS MATERIALIZED (SELECT {', '.join(_XS + _QS)}, count(*) AS w FROM {users} GROUP BY ALL),
{name}_candidates AS MATERIALIZED (
  SELECT row_number() OVER (ORDER BY md5(concat_ws('|', {', '.join(f'CAST({x} AS BIGINT)' for x in _XS)})), {', '.join(_XS)}) AS place, {', '.join(_QS)}
  FROM {name}_points QUALIFY place <= 1000),
{name}_start0 AS MATERIALIZED (SELECT {', '.join(_QS)} FROM {name}_candidates WHERE place = 1),
{name}_far0 AS MATERIALIZED (SELECT c.*, {_away('c', 's')} AS away FROM {name}_candidates c, {name}_start0 s)"""
    ]
    for i in range(1, max(ks)):
        ctes.append(
            f"""
{name}_start{i} AS MATERIALIZED (SELECT {', '.join(_QS)} FROM {name}_far{i - 1} WHERE away > 0 ORDER BY away DESC, place LIMIT 1),
{name}_far{i} AS MATERIALIZED (
  SELECT f.place, {', '.join(f'f.{q}' for q in _QS)}, least(f.away, {_away('f', 's')}) AS away FROM {name}_far{i - 1} f, {name}_start{i} s)"""
        )
    starts = " UNION ALL ".join(f"SELECT {i} AS cluster, * FROM {name}_start{i}" for i in range(max(ks)))
    wanted = ", ".join(f"({k})" for k in ks)
    ctes.append(
        f"""
{name}_round0 AS MATERIALIZED (SELECT k, cluster, {', '.join(_QS)} FROM ({starts}) s, (VALUES {wanted}) AS asked(k) WHERE cluster < k)"""
    )
    for i in range(rounds):
        mean = ", ".join(_floor(f"CAST(2 * sum({q} * w) + sum(w) AS HUGEINT)", "CAST(2 * sum(w) AS HUGEINT)") + f" AS {q}" for q in _QS)
        ctes.append(
            f"""
{name}_means{i} AS MATERIALIZED (
  SELECT k, cluster, {mean} FROM (
    SELECT c.k, {', '.join(f'p.{q}' for q in _QS)}, p.w, arg_min(c.cluster, ({_away('p', 'c')}, c.cluster)) AS cluster
    FROM {name}_points p, {name}_round{i} c GROUP BY {', '.join(f'p.{x}' for x in _XS + _QS)}, p.w, c.k)
  GROUP BY k, cluster),
{name}_round{i + 1} AS MATERIALIZED (
  SELECT c.k, c.cluster, {', '.join(f'CAST(coalesce(m.{q}, c.{q}) AS BIGINT) AS {q}' for q in _QS)}
  FROM {name}_round{i} c LEFT JOIN {name}_means{i} m ON m.k = c.k AND m.cluster = c.cluster)"""
        )
    ctes.append(f"\n{name} AS MATERIALIZED (SELECT * FROM {name}_round{rounds})")
    return ",".join(ctes)


def _segmented(name: str, users: str, centres: str, inactive: str, columns: str = USER_COLUMNS) -> str:
    """``name``: ``users`` labelled by their nearest centre, and the inactive ones."""
    cents = "CAST(round({} * 100) AS BIGINT)"
    keyed = f"SELECT row_number() OVER () AS rid, * FROM {users}"
    return f"""
{name}_nearest AS MATERIALIZED (
  SELECT rid, arg_min(c.cluster, ({_away('u', 'c')}, c.cluster)) AS cluster FROM {name}_keyed u, {centres} c GROUP BY rid),
{name}_clustered AS MATERIALIZED (SELECT u.*, n.cluster FROM {name}_keyed u JOIN {name}_nearest n USING (rid)),
{name}_means AS (
  SELECT cluster, sum({cents.format('total_spent')}) / count(*) AS spent, sum({cents.format('avg_session_duration')}) / count(*) AS minutes
  FROM {name}_clustered GROUP BY cluster),
{name}_whale AS (SELECT cluster AS whale FROM {name}_means ORDER BY spent DESC, cluster LIMIT 1),
{name}_hardcore AS (SELECT cluster AS hardcore FROM {name}_means, {name}_whale WHERE cluster <> whale ORDER BY minutes DESC, cluster LIMIT 1),
{name} AS (
  SELECT {columns}, CASE WHEN cluster = (SELECT whale FROM {name}_whale) THEN 'Whale'
         WHEN cluster = (SELECT hardcore FROM {name}_hardcore) THEN 'Hardcore' ELSE 'Casual' END AS user_segment FROM {name}_clustered
  UNION ALL SELECT {columns}, 'Inactive' FROM {inactive})""".replace(f"\n{name}_nearest", f"\n{name}_keyed AS MATERIALIZED ({keyed}),\n{name}_nearest", 1)


TRAINED = (
    _features("trained_users", "active") + "," + _centres("trained_centres", "trained_users", [3])
    + "," + _segmented("trained", "trained_users", "trained_centres", "inactive")
)
SCORED = (
    _features("trained_users", "active") + "," + _centres("trained_centres", "trained_users", [3])
    + f""",
scored_inactive AS (SELECT * FROM aged WHERE {RULES['rate_5']}),
scored_active AS (SELECT * FROM aged EXCEPT SELECT * FROM scored_inactive),"""
    + _features("scored_users", "scored_active") + "," + _segmented("scored", "scored_users", "trained_centres", "scored_inactive")
)
SIMPLE_COLUMNS = USER_COLUMNS.replace(" registration_date,", "").replace(", user_age_days", "")
SIMPLE = (
    TRAINED
    + f""",
simple_base AS (SELECT {SIMPLE_COLUMNS} FROM trained),
simple_inactive AS (SELECT * FROM simple_base WHERE {RULES['simple']}),
simple_active AS (SELECT * FROM simple_base EXCEPT SELECT * FROM simple_inactive),"""
    + _features("simple_users", "simple_active") + "," + _centres("simple_centres", "simple_users", [3])
    + "," + _segmented("simple", "simple_users", "simple_centres", "simple_inactive", SIMPLE_COLUMNS)
)


def _frozen() -> str:
    """Scores under a given scaler (number of users, sums, deviations in thousandths) and given centres."""
    n, sums, deviations = 1000, (8000, 1_500_000, 2_000_000, 1500), (5002, 500_250, 2_001_000, 2001)
    units = ["total_sessions", "round(avg_session_duration * 100)", "round(total_spent * 100)", "num_purchases"]
    q = ", ".join(
        _floor(f"(CAST({u} AS HUGEINT) * {n} - {s}) * 1000000", f"CAST({n * d} AS HUGEINT)") + f" AS q{i}"
        for i, (u, s, d) in enumerate(zip(units, sums, deviations))
    )
    return _q(
        f"""SELECT {USER_COLUMNS}, CASE WHEN coalesce({RULES['rate_5']}, false) THEN 'Inactive' ELSE nearest END AS user_segment
FROM (SELECT u.*, (SELECT arg_min(name, ({_away('u', 'c')}, place)) FROM frozen_centres c) AS nearest FROM frozen_users u)""",
        f"""
frozen_centres(place, name, q0, q1, q2, q3) AS (VALUES (0, 'Casual', -500, -500, -500, -500), (1, 'Hardcore', 500, 1000, -250, -250), (2, 'Whale', 250, 0, 1500, 1500)),
frozen_users AS (SELECT *, {q} FROM aged)""",
    )


def _profile_of(source: str) -> str:
    return f"""SELECT user_segment,
       {_half_up_mean('sum(total_sessions)', 'count(user_id)', 0)} AS avg_sessions,
       {_half_up_mean('sum(CAST(round(avg_session_duration * 100) AS BIGINT))', 'count(user_id)', 2)} AS avg_duration,
       {_half_up_mean('sum(CAST(round(total_spent * 100) AS BIGINT))', 'count(user_id)', 2)} AS avg_spent,
       {_half_up_mean('sum(num_purchases)', 'count(user_id)', 0)} AS avg_purchases,
       count(user_id) AS count
FROM {source} GROUP BY user_segment"""


def _sweep(ks: list[int], columns: str) -> str:
    """Silhouettes by all pairs of users, each pair's distance computed."""
    return _q(
        f"""SELECT {columns} FROM (
  SELECT k, CAST(round(sum(CAST(floor(value * 1e9 + 0.5) AS HUGEINT)) / (count(*) * 1e9), 6) AS DOUBLE) AS silhouette
  FROM (SELECT k, id, CASE WHEN own IS NULL OR greatest(own, other) = 0 THEN 0 ELSE (other - own) / greatest(own, other) END AS value
        FROM (SELECT k, id, max(CAST(total AS DOUBLE) / CASE WHEN n > 1 THEN n - 1 END) FILTER (same) AS own,
                     min(CAST(total AS DOUBLE) / n) FILTER (NOT same) AS other
              FROM (SELECT a.k, a.id, a.cluster = b.cluster AS same, b.cluster, CAST(sum({_away('a', 'b')}) AS HUGEINT) AS total, count(*) AS n
                    FROM sweep_placed a JOIN sweep_placed b ON a.k = b.k GROUP BY a.k, a.id, a.cluster, b.cluster)
              GROUP BY k, id))
  GROUP BY k)""",
        _features("sweep_users", "active") + "," + _centres("sweep_centres", "sweep_users", ks)
        + f""",
sweep_keyed AS MATERIALIZED (SELECT row_number() OVER () AS id, {', '.join(_QS)} FROM sweep_users),
sweep_placed AS MATERIALIZED (
  SELECT c.k, u.id, {', '.join(f'u.{q}' for q in _QS)}, arg_min(c.cluster, ({_away('u', 'c')}, c.cluster)) AS cluster
  FROM sweep_keyed u, sweep_centres c GROUP BY c.k, u.id, {', '.join(f'u.{q}' for q in _QS)})""",
    )


RAW_TABLES = {
    "users": "raw_users",
    "logins": "raw_logins",
    "sessions": "raw_game_sessions",
    "purchases": "raw_purchases",
    "leaderboard": "raw_leaderboard_snapshots",
}


# Ingest with rejects: column, type, broken text and where it stands (a number in the id's place).
_CHECKED: dict[str, dict[str, tuple[str, str | None, str | None]]] = {
    "users": {"user_id": ("VARCHAR", "NULL", "CAST(user_id AS BIGINT) % 19 = 0"), "username": ("VARCHAR", None, None), "country": ("VARCHAR", None, None),
              "signup_date": ("DATE", "'soon'", "CAST(user_id AS BIGINT) % 17 = 0"), "age": ("INTEGER", "'12.5x'", "CAST(user_id AS BIGINT) % 13 = 0"),
              "gender": ("VARCHAR", None, None)},
    "logins": {"user_id": ("VARCHAR", "' '", "location = 'City_8'"), "timestamp": ("TIMESTAMP", "'2024-99-01 00:00:00'", "location = 'City_3'"),
               "device_type": ("VARCHAR", None, None), "location": ("VARCHAR", None, None), "event_date": ("DATE", "'n/a'", "location = 'City_5'")},
    "sessions": {"session_id": ("VARCHAR", "NULL", "CAST(session_id AS BIGINT) % 37 = 0"), "user_id": ("VARCHAR", None, None), "game_type": ("VARCHAR", None, None),
                 "start_time": ("TIMESTAMP", "'yesterday'", "CAST(session_id AS BIGINT) % 23 = 0"), "end_time": ("TIMESTAMP", "'25:61'", "CAST(session_id AS BIGINT) % 31 = 0"),
                 "score": ("INTEGER", "'ten'", "CAST(session_id AS BIGINT) % 29 = 0"), "result": ("VARCHAR", None, None), "event_date": ("DATE", None, None)},
    "purchases": {"purchase_id": ("VARCHAR", None, None), "user_id": ("VARCHAR", None, None), "item": ("VARCHAR", None, None),
                  "amount": ("DOUBLE", "'1,5'", "CAST(purchase_id AS BIGINT) % 7 = 0"), "timestamp": ("TIMESTAMP", "'never'", "CAST(purchase_id AS BIGINT) % 11 = 0"),
                  "event_date": ("DATE", "'2024-02-30'", "CAST(purchase_id AS BIGINT) % 5 = 0")},
    "leaderboard": {"user_id": ("VARCHAR", None, None), "game_type": ("VARCHAR", None, None), "rank": ("INTEGER", "'first'", "rank = 1"),
                    "event_date": ("DATE", "''", "rank = 2")},
}
_NEEDED = {"users": ["user_id"], "logins": ["user_id", "event_date"], "sessions": ["session_id", "event_date"],
           "purchases": ["purchase_id", "event_date"], "leaderboard": ["user_id", "game_type", "event_date"]}


def _checked(kind: str, good: bool) -> str:
    """Rows whose cells all parse and whose needed cells are there, or the others with the names of
    the columns at fault."""
    columns = _CHECKED[kind]
    text = ", ".join(
        f"CASE WHEN {where} THEN {bad} ELSE CAST(\"{c}\" AS VARCHAR) END AS \"{c}\"" if where else f"CAST(\"{c}\" AS VARCHAR) AS \"{c}\""
        for c, (_, bad, where) in columns.items()
    )
    at_fault = ", ".join(
        f"CASE WHEN (TRY_CAST(\"{c}\" AS {t}) IS NULL AND \"{c}\" IS NOT NULL)"
        + (f" OR trim(coalesce(\"{c}\", '')) = ''" if c in _NEEDED[kind] else "") + f" THEN '{c}' END"
        for c, (t, _, _) in columns.items()
    )
    typed = ", ".join(f"TRY_CAST(\"{c}\" AS {t}) AS \"{c}\"" for c, (t, _, _) in columns.items())
    rows = f"SELECT *, concat_ws(',', {at_fault}) AS errors FROM (SELECT {text} FROM {RAW_TABLES[kind]})"
    return _q(f"SELECT {typed} FROM ({rows}) WHERE errors = ''" if good else f"SELECT * FROM ({rows}) WHERE errors <> ''")


ORACLE: dict[str, str] = {
    "silver_user_sessions": _q("SELECT * FROM silver_user_sessions"),
    "silver_user_sessions_day": _q(
        f"SELECT * FROM silver_user_sessions WHERE event_date = {RUN_DATE}"
    ),
    "silver_user_sessions_split": _q("SELECT * FROM silver_user_sessions"),
    "rolling_active_users": _q(
        """SELECT d.event_date, count(DISTINCT s.user_id) FILTER (s.event_date = d.event_date) AS users_1d,
       count(DISTINCT s.user_id) FILTER (s.event_date > d.event_date - 7) AS users_7d, count(DISTINCT s.user_id) AS users_30d
FROM (SELECT DISTINCT event_date FROM raw_game_sessions WHERE user_id IS NOT NULL) d
JOIN raw_game_sessions s ON s.event_date <= d.event_date AND s.event_date > d.event_date - 30
GROUP BY d.event_date"""
    ),
    "silver_user_sessions_one_login": _q(
        f"SELECT * FROM ({_silver_sessions('first_logins')})"
    ),
    "silver_purchases_enriched": _q("SELECT * FROM silver_purchases_enriched"),
    "silver_purchases_day": _q(
        f"SELECT * FROM silver_purchases_enriched WHERE event_date = {RUN_DATE}"
    ),
    "silver_leaderboard_enriched": _q("SELECT * FROM silver_leaderboard_enriched"),
    "silver_leaderboard_day": _q(
        f"SELECT * FROM silver_leaderboard_enriched WHERE event_date = {RUN_DATE}"
    ),
    "daily_summary_backfill": _daily_summary(),
    "daily_summary_one_day": _daily_summary(f"WHERE event_date = {RUN_DATE}"),
    "daily_summary_from_silver": _daily_summary(),
    "daily_summary_from_cells": _daily_summary(),
    "daily_summary_from_feed": _daily_summary(),
    "user_demographics_from_feed": _q("SELECT * FROM demographics"),
    "daily_summary_one_login": _q("SELECT * FROM summary", _summary_ctes("summary", "silver_user_sessions_one_login")),
    "daily_revenue": _q("SELECT * FROM summary_rev", _summary_ctes("summary", "silver_user_sessions")),
    "peak_hour_per_day": _q(
        """SELECT event_date, peak_hour, cnt FROM (
  SELECT event_date, CAST(hour(start_time) AS INTEGER) AS peak_hour, count(*) AS cnt,
         row_number() OVER (PARTITION BY event_date
                            ORDER BY count(*) DESC, CAST(hour(start_time) AS INTEGER) ASC NULLS LAST) AS rn
  FROM silver_user_sessions GROUP BY 1, 2) WHERE rn = 1"""
    ),
    "top_device_per_day": _q(
        """SELECT event_date, top_device_type, cnt FROM (
  SELECT event_date, login_device AS top_device_type, count(*) AS cnt,
         row_number() OVER (PARTITION BY event_date ORDER BY count(*) DESC, login_device ASC NULLS LAST) AS rn
  FROM silver_user_sessions GROUP BY 1, 2) WHERE rn = 1"""
    ),
    "user_session_metrics": _q("SELECT * FROM session_metrics"),
    "user_purchase_metrics": _q("SELECT * FROM purchase_metrics"),
    "user_demographics": _q("SELECT * FROM demographics"),
    "user_demographics_from_silver": _q("SELECT * FROM demographics"),
    "user_demographics_from_daily": _q("SELECT * FROM demographics"),
    "inactive_rate_15": _q(f"SELECT * FROM aged WHERE {RULES['rate_15']}"),
    "inactive_rate_5": _q(f"SELECT * FROM aged WHERE {RULES['rate_5']}"),
    "inactive_simple": _q(f"SELECT * FROM aged WHERE {RULES['simple']}"),
    "inactive_draft": _q(f"SELECT * FROM aged WHERE {RULES['draft']}"),
    "active_users": _q("SELECT * FROM active"),
    "active_inactive_union": _q(
        "SELECT *, 'Active' AS user_segment FROM active "
        "UNION ALL SELECT *, 'Inactive' AS user_segment FROM inactive"
    ),
    "feature_zscores": _q(
        "SELECT user_id, "
        + ", ".join(
            f"CAST(round(CAST(CASE WHEN sd_{c} = 0 THEN 0 ELSE ({c} - m_{c}) * (1.0 / sd_{c}) END "
            f"AS DECIMAL(38,12)), 6) AS DOUBLE) AS z_{c}"
            for c in FEATURE_COLUMNS
        )
        + " FROM (SELECT *, "
        + ", ".join(f"avg({c}) OVER () AS m_{c}, stddev_samp({c}) OVER () AS sd_{c}" for c in FEATURE_COLUMNS)
        + " FROM active)"
    ),
    "cluster_profile": _q("SELECT * FROM profile"),
    "cluster_labels": _q("SELECT * FROM labels"),
    "segment_profile": _q(
        f"""SELECT user_segment,
       {_half_up_mean('sum(total_sessions)', 'count(user_id)', 0)} AS avg_sessions,
       {_half_up_mean('sum(CAST(round(avg_session_duration * 100) AS BIGINT))', 'count(user_id)', 2)} AS avg_duration,
       {_half_up_mean('sum(CAST(round(total_spent * 100) AS BIGINT))', 'count(user_id)', 2)} AS avg_spent,
       {_half_up_mean('sum(num_purchases)', 'count(user_id)', 0)} AS avg_purchases,
       count(user_id) AS count
FROM segmented GROUP BY user_segment"""
    ),
    "segment_sizes": _q("SELECT user_segment, count(*) AS count FROM segmented GROUP BY user_segment"),
    "whales_by_country_given_clusters": _q(
        "SELECT country, count(*) AS whales FROM segmented WHERE user_segment = 'Whale' GROUP BY country"
    ),
    "user_categories": _q(
        f"SELECT CASE WHEN coalesce({RULES['rate_15']}, false) THEN 'Inactive' ELSE 'Active' END "
        "AS category, count(*) AS users FROM aged GROUP BY 1"
    ),
    "hourly_activity": _q(
        "SELECT CAST(hour(start_time) AS INTEGER) AS hour, count(*) AS sessions, "
        "count(DISTINCT user_id) AS players FROM raw_game_sessions GROUP BY 1"
    ),
    "device_usage": _q(
        f"SELECT {_initcap('lower(device_type)')} AS device, count(*) AS logins, "
        "count(DISTINCT user_id) AS users FROM raw_logins GROUP BY 1"
    ),
    "user_base_makeup": _q(
        "SELECT age_bracket, gender, count(*) AS users FROM demographics GROUP BY 1, 2"
    ),
    "user_base_by_country": _q(
        "SELECT age_bracket, gender, country, count(*) AS users FROM demographics GROUP BY ALL"
    ),
    "users_by_country": _q("SELECT country, count(*) AS users FROM demographics GROUP BY 1"),
    "earnings_by_item": _earnings("item"),
    "earnings_by_day": _earnings("event_date"),
    "total_earnings": _earnings(None),
    # scans
    "scan_users": _q("SELECT * FROM raw_users"),
    "scan_user_ids": _q("SELECT user_id FROM raw_users"),
    "scan_day_sessions": _q(f"SELECT * FROM raw_game_sessions WHERE event_date = {RUN_DATE}"),
    "preview_users": _q("SELECT * FROM raw_users ORDER BY user_id LIMIT 20"),
    "scan_logins": _q("SELECT * FROM raw_logins"),
    "scan_sessions": _q("SELECT * FROM raw_game_sessions"),
    "scan_purchases": _q("SELECT * FROM raw_purchases"),
    "scan_leaderboard": _q("SELECT * FROM raw_leaderboard_snapshots"),
    "preview_silver_sessions": _q(
        "SELECT * FROM silver_user_sessions ORDER BY session_id NULLS FIRST, "
        "login_device NULLS FIRST, login_location NULLS FIRST LIMIT 100"
    ),
    "row_count_users": _q("SELECT count(*) AS row_count FROM raw_users"),
    # typed ingest and CRM ingest give back the raw rows
    **{f"bronze_{k}_typed": _q(f"SELECT * FROM {t}") for k, t in RAW_TABLES.items()},
    **{f"crm_{k}_ingest": _q(f"SELECT * FROM {t}") for k, t in RAW_TABLES.items()},
    **{f"bronze_{k}_rejects": _checked(k, False) for k in RAW_TABLES},
    **{f"bronze_{k}_accepted": _checked(k, True) for k in RAW_TABLES},
    # table maintenance
    "upsert_daily": _q(
        "SELECT * FROM old_v WHERE event_date NOT IN (SELECT event_date FROM new_v) "
        "UNION ALL SELECT * FROM new_v",
        VERSIONS,
    ),
    "daily_changes": _changes_sql(),
    "clustered_users": _q("SELECT * FROM raw_users"),
    "compacted_sessions": _q("SELECT * FROM silver_user_sessions"),
    # samples of given rows
    "sampled_users": _q(f"SELECT * FROM raw_users WHERE {_draw('user_id', 'logins')} < {int(0.80 * 2**32)}"),
    "ranked_players": _q(
        """SELECT user_id, game_type, event_date, CAST(place AS INTEGER) AS rank FROM (
  SELECT *, row_number() OVER (PARTITION BY game_type, event_date ORDER BY md5(concat_ws('|', user_id, game_type,
           CAST(event_date AS VARCHAR), 'players')), user_id) AS place
  FROM (SELECT DISTINCT user_id, game_type, event_date FROM raw_game_sessions WHERE user_id IS NOT NULL))
WHERE place <= 20"""
    ),
    # the model with given centroids, and the silhouette of given clusters
    "scored_given_centroids": _given_scores(),
    "silhouette_given_clusters": _given_silhouette(),
    "scored_frozen": _frozen(),
    "rescored_changed_users": _frozen(),
    # the K-means of whole numbers
    "kmeans_segments": _q("SELECT * FROM trained", TRAINED),
    "scored_segments": _q("SELECT * FROM scored", SCORED),
    "simple_segments": _q("SELECT * FROM simple", SIMPLE),
    "whales_by_country": _q("SELECT country, count(*) AS whales FROM trained WHERE user_segment = 'Whale' GROUP BY country", TRAINED),
    "simple_segment_sizes": _q("SELECT user_segment, count(*) AS count FROM simple GROUP BY user_segment", SIMPLE),
    "simple_segment_profile": _q(_profile_of("simple"), SIMPLE),
    "silhouette": _sweep([3], "silhouette"),
    "k_sweep": _sweep(list(range(2, 9)), "CAST(k AS INTEGER) AS k, silhouette"),
}
