"""SQL that computes each registered query a second time, in DuckDB's dialect."""

import math

from trailmark.functions.seeded import WORD, weight

# The months of the test tables; the fourth is the first target.
FIRST, LAST = (1995, 1), (2001, 11)
MONTHS = [f"{y}-{m:02d}" for y in range(FIRST[0], LAST[0] + 1) for m in range(1, 13) if FIRST <= (y, m) <= LAST]
FIRST_TARGET = MONTHS[3]

_PREV = "CASE WHEN s_nationkey % 6 = 0 THEN 'other-' || n_name ELSE n_name END"

CTE = {
    "raw": f"""
        SELECT {_PREV} AS prev, p_type AS curr,
               CASE l_returnflag WHEN 'R' THEN 'link' WHEN 'A' THEN 'external' ELSE 'other' END AS type,
               CAST(l_quantity AS INT) AS n, strftime(l_shipdate, '%Y-%m') AS month
        FROM lineitem JOIN supplier ON s_suppkey = l_suppkey JOIN nation ON n_nationkey = s_nationkey
        JOIN part ON p_partkey = l_partkey""",
    "clicks": "SELECT * FROM raw WHERE n >= 10",
    "months": "SELECT DISTINCT month FROM clicks",
    "targets": f"SELECT month FROM months WHERE month >= '{FIRST_TARGET}'",
    "em": """SELECT prev, curr, type, month, CAST(sum(n) AS BIGINT) AS n FROM clicks GROUP BY ALL""",
    # whole-series baselines
    "med": """
        SELECT prev, curr, type, CAST(quantile_disc(n, 0.5) AS DOUBLE) AS baseline_median,
               avg(n) AS baseline_mean, coalesce(stddev_samp(n), 0.01) AS baseline_std
        FROM em GROUP BY ALL""",
    "base": """
        SELECT med.*, mad.baseline_mad FROM med JOIN (
            SELECT prev, curr, type, avg(abs(n - baseline_median)) AS baseline_mad
            FROM em JOIN med USING (prev, curr, type) GROUP BY ALL) mad USING (prev, curr, type)""",
    # page-pair counts, pooled history and tops
    "pm": "SELECT curr, prev, month, CAST(sum(n) AS BIGINT) AS n FROM clicks GROUP BY ALL",
    "now": """
        SELECT curr, prev, month, n, CAST(sum(n) OVER (PARTITION BY curr, month) AS BIGINT) AS total_n,
               rank() OVER (PARTITION BY curr, month ORDER BY n DESC) AS place,
               row_number() OVER (PARTITION BY curr, month ORDER BY n DESC, prev) AS place1
        FROM pm WHERE month IN (SELECT month FROM targets)""",
    "pool": """
        SELECT t.month, pm.curr, pm.prev, CAST(sum(pm.n) AS BIGINT) AS base_n
        FROM targets t JOIN pm ON pm.month < t.month GROUP BY ALL""",
    "before": """
        SELECT *, CAST(sum(base_n) OVER (PARTITION BY curr, month) AS BIGINT) AS base_total,
               rank() OVER (PARTITION BY curr, month ORDER BY base_n DESC) AS place,
               row_number() OVER (PARTITION BY curr, month ORDER BY base_n DESC, prev) AS place1
        FROM pool""",
    # forecasts
    "pts": """
        SELECT *, greatest(CAST(n AS DOUBLE), 0.1) AS y,
               date_diff('day', DATE '1970-01-01', CAST(month || '-01' AS DATE)) AS x
        FROM em""",
    "views": """
        SELECT p_type AS page, CAST(l_shipdate AS DATE) AS date, CAST(sum(CAST(l_quantity AS INT)) AS BIGINT) AS views
        FROM lineitem JOIN part ON p_partkey = l_partkey GROUP BY ALL""",
    "truth": """
        SELECT CASE WHEN n_nationkey % 6 = 0 THEN 'other-' || n_name ELSE n_name END AS page
        FROM nation WHERE n_regionkey = 0""",
    "moves": """
        SELECT coalesce(lag(event_type) OVER (PARTITION BY user_id ORDER BY ts, event_id), 'other-empty') AS prev,
               event_type AS curr, ts FROM events""",
    "hours": """
        SELECT date_trunc('hour', ts) AS h, prev, curr, count(*) AS n FROM moves GROUP BY ALL""",
}


def _spike_rows(source: str, ratio: str, curve: str = "gentle") -> str:
    z = "(n - baseline_median) / (baseline_mad + 0.01)"
    if curve == "gentle":
        confidence = "1 / (1 + exp(-1.0 * ((least(abs(z_score) / 3.5, 10) + least(deviation_ratio / 10, 10)) / 2 - 1)))"
    else:
        confidence = "1 / (1 + exp(-5.0 * ((abs(z_score) / 3.5 + least(deviation_ratio / 10, 10)) / 2 - 0.5)))"
    return f"""
        SELECT sha256(concat_ws('|', 'traffic_spike', month, prev, curr, type)) AS anomaly_id, month, prev, curr, type, n,
               baseline_median, deviation_ratio, z_score, 'traffic_spike' AS anomaly_type, {confidence} AS confidence,
               CASE WHEN deviation_ratio >= 10
                    THEN 'Traffic spike: ' || month || ' traffic is ' || printf('%.1f', deviation_ratio) || 'x baseline'
                    ELSE 'Statistical anomaly: Z-score = ' || printf('%.2f', z_score) END AS description
        FROM (SELECT *, {ratio} AS deviation_ratio, {z} AS z_score FROM {source})
        WHERE deviation_ratio >= 10 OR abs(z_score) >= 3.5"""


_GUARDED = "CASE WHEN baseline_median > 0 THEN n / baseline_median ELSE 0.0 END"
CTE["against"] = f"SELECT * FROM em JOIN base USING (prev, curr, type) WHERE month >= '{FIRST_TARGET}'"
CTE["spikes"] = _spike_rows("against", _GUARDED)


def _history_base(condition: str, mad: str) -> str:
    return f"""
        SELECT t.prev, t.curr, t.type, t.month, t.n, CAST(quantile_disc(h.n, 0.5) AS DOUBLE) AS baseline_median,
               list(h.n) AS past
        FROM em t JOIN em h ON h.prev = t.prev AND h.curr = t.curr AND h.type = t.type AND {condition}
        WHERE t.month >= '{FIRST_TARGET}' GROUP BY ALL"""


def _deviation(kind: str) -> str:
    away = "list_transform(past, lambda x: abs(x - baseline_median))"
    return f"list_avg({away})" if kind == "mean_abs" else f"list_aggregate({away}, 'quantile_disc', 0.5)"


def _mix(place: str, confidence: str) -> str:
    return f"""
        SELECT sha256(concat_ws('|', 'mix_shift', month, top_ref, curr, 'link', base_top_ref)) AS anomaly_id, month,
               top_ref AS prev, curr, 'link' AS type, total_n AS n, CAST(0 AS DOUBLE) AS baseline_median,
               change AS deviation_ratio, CAST(0 AS DOUBLE) AS z_score, 'mix_shift' AS anomaly_type,
               CASE WHEN changed THEN 0.9 ELSE {confidence} END AS confidence,
               CASE WHEN changed THEN 'Top referrer changed from ' || base_top_ref || ' to ' || top_ref
                    ELSE 'Top referrer proportion changed by ' || printf('%.2f', change) END AS description
        FROM (SELECT now.curr, now.month, now.prev AS top_ref, before.prev AS base_top_ref, total_n,
                     now.prev <> before.prev AS changed,
                     abs(now.n / total_n - base_n / base_total) AS change
              FROM now JOIN before USING (curr, month) WHERE now.{place} = 1 AND before.{place} = 1)
        WHERE changed OR change >= 0.2"""


CTE["mix"] = _mix("place1", "least(0.5 + 0.5 * (change - 0.2) / 0.8, 1.0)")
CTE["anomalies"] = "SELECT * FROM spikes UNION ALL SELECT * FROM mix"

CTE["last3"] = """
    SELECT prev, curr, type, avg(y) AS f, stddev_pop(y) AS s
    FROM (SELECT *, row_number() OVER (PARTITION BY prev, curr, type ORDER BY month DESC) AS k,
                 count(*) OVER (PARTITION BY prev, curr, type) AS c FROM pts)
    WHERE k <= 3 AND c >= 3 GROUP BY ALL"""
CTE["average"] = """
    SELECT prev, curr, type, f AS forecast_n, greatest(f - 1.96 * s, 0) AS forecast_lower,
           greatest(f + 1.96 * s, 0) AS forecast_upper FROM last3"""
CTE["line"] = """
    SELECT prev, curr, type,
           avg(y) + coalesce(regr_slope(y, x), 0)
             * (date_diff('day', DATE '1970-01-01', CAST(max(month) || '-01' AS DATE) + INTERVAL 1 MONTH) - avg(x)) AS f,
           sqrt(greatest(regr_syy(y, x) - coalesce(regr_slope(y, x), 0) * regr_sxy(y, x), 0) / count(*)) AS s
    FROM pts GROUP BY ALL HAVING count(*) >= 3"""
CTE["trend"] = """
    SELECT prev, curr, type, f AS forecast_n, f - 1.2815515655446004 * s AS forecast_lower,
           f + 1.2815515655446004 * s AS forecast_upper FROM line"""


def _metrics(fits: str, where: str = "") -> str:
    return f"""
        SELECT prev, curr, type, month, forecast_n, forecast_lower, forecast_upper, n - forecast_n AS forecast_error,
               n / (forecast_n + 1e-6) AS forecast_ratio,
               n > forecast_upper OR n / (forecast_n + 1e-6) >= 2 AS forecast_flag
        FROM em JOIN {fits} USING (prev, curr, type) {where}"""


CTE["compared"] = _metrics("trend")
CTE["enriched"] = """
    SELECT a.* REPLACE (CASE WHEN coalesce(forecast_flag, false) THEN anomaly_type || '_forecast_spike'
                             ELSE anomaly_type END AS anomaly_type),
           coalesce(forecast_n, 0) AS forecast_n, coalesce(forecast_lower, 0) AS forecast_lower,
           coalesce(forecast_upper, 0) AS forecast_upper, coalesce(forecast_error, 0) AS forecast_error,
           coalesce(forecast_ratio, 1) AS forecast_ratio, coalesce(forecast_flag, false) AS forecast_flag
    FROM anomalies a LEFT JOIN compared USING (prev, curr, type, month)"""

CTE["page_months"] = "SELECT DISTINCT curr AS page, month FROM anomalies"
CTE["around"] = """
    SELECT page, month, date, views FROM page_months JOIN views USING (page)
    WHERE date BETWEEN CAST(month || '-01' AS DATE) - INTERVAL 30 DAY AND CAST(month || '-01' AS DATE) + INTERVAL 30 DAY"""
CTE["matches"] = """
    SELECT *, coalesce(peak_views > mean_views * 1.5, false) AS daily_spike_match FROM (
        SELECT page, month,
               max(CASE WHEN abs(date_diff('day', CAST(month || '-15' AS DATE), date)) <= 7 THEN views END) AS peak_views,
               avg(views) AS mean_views FROM around GROUP BY ALL)"""

CTE["recent_pm"] = """
    SELECT *, CAST(sum(n) OVER (PARTITION BY curr, month) AS BIGINT) AS total,
           row_number() OVER (PARTITION BY curr, month ORDER BY n DESC, prev) AS rank
    FROM pm WHERE month IN (SELECT month FROM months ORDER BY month DESC LIMIT 6)"""
CTE["top10"] = "SELECT curr, month, rank, prev, n, total, n / total AS proportion FROM recent_pm WHERE rank <= 10"
CTE["ends"] = "SELECT curr, max(month) AS last_month, count(DISTINCT month) AS months FROM top10 GROUP BY ALL"
CTE["usual"] = """
    SELECT curr, prev FROM (
        SELECT curr, prev, row_number() OVER (PARTITION BY curr ORDER BY count(*) DESC, min(month)) AS k
        FROM top10 JOIN ends USING (curr) WHERE rank = 1 AND month < last_month GROUP BY curr, prev) WHERE k = 1"""
CTE["latest_top"] = """
    SELECT curr, prev, proportion, months FROM top10 JOIN ends USING (curr) WHERE rank = 1 AND month = last_month"""
CTE["changes"] = """
    SELECT l.curr, coalesce(months >= 2 AND u.prev <> l.prev, false) AS top_referrer_flip,
           months >= 2 AND abs(l.proportion - coalesce(
               (SELECT max(t.proportion) FROM top10 t JOIN ends e USING (curr)
                WHERE t.curr = l.curr AND t.prev = l.prev AND t.month < e.last_month), 0)) > 0.2 AS major_mix_shift
    FROM latest_top l LEFT JOIN usual u USING (curr)"""

# one graph for each target month
CTE["target_rows"] = f"SELECT * FROM clicks WHERE month >= '{FIRST_TARGET}'"
CTE["links"] = "SELECT month, prev, curr, CAST(sum(n) AS DOUBLE) AS weight FROM target_rows GROUP BY ALL"
CTE["nodes"] = "SELECT month, prev AS node FROM links UNION SELECT month, curr FROM links"
CTE["degrees"] = """
    SELECT month, node, count(*) AS degree
    FROM (SELECT month, prev AS node FROM links UNION ALL SELECT month, curr FROM links) GROUP BY ALL"""
CTE["shares"] = "SELECT month, prev, curr, weight / sum(weight) OVER (PARTITION BY month, prev) AS share FROM links"
CTE["sized"] = """
    SELECT n.month, n.node, count(*) OVER (PARTITION BY n.month) AS total, l.prev IS NULL AS sink
    FROM nodes n LEFT JOIN (SELECT DISTINCT month, prev FROM links) l ON l.month = n.month AND l.prev = n.node"""
CTE["rank"] = """
    SELECT 0 AS k, month, node, total, sink, 1.0::DOUBLE / total AS r FROM sized
    UNION ALL
    SELECT lost.k + 1, n.month, n.node, n.total, n.sink, (0.15 + 0.85 * lost.r) / n.total + 0.85 * coalesce(s, 0)
    FROM sized n JOIN (SELECT month, max(k) AS k, coalesce(sum(r) FILTER (sink), 0) AS r FROM rank GROUP BY month) lost USING (month)
    LEFT JOIN (SELECT s.month, s.curr AS node, sum(r * share) AS s
               FROM shares s JOIN rank ON rank.month = s.month AND rank.node = s.prev GROUP BY ALL) g
           ON g.month = n.month AND g.node = n.node
    WHERE lost.k < 150"""
CTE["ranks"] = "SELECT month, node, r FROM rank WHERE k = 150"
CTE["month_edges"] = "SELECT DISTINCT month, prev, curr, type FROM target_rows"


def _word(text: str, word: int) -> str:
    return f"((CAST('0x' || substr(md5({text}), {8 * word + 1}, 8) AS BIGINT) + 0.5) / {WORD!r})"


def normal(key: str, index: int, seed: int = 42) -> str:
    """SQL of one seeded standard normal number."""
    text = f"concat_ws('|', '{seed}', '{index // 4}', {key})"
    word = 2 * ((index % 4) // 2)
    wave = "cos" if index % 2 == 0 else "sin"
    return f"(sqrt(-2 * ln({_word(text, word)})) * {wave}({2 * math.pi!r} * {_word(text, word + 1)}))"


def _flagged(distances: str) -> str:
    return """
        SELECT prev, curr, type, month, round(s, 6) AS gnn_score,
               s >= quantile_cont(s, 0.95) OVER (PARTITION BY month) AS gnn_flag FROM scaled"""


def _scaled(distances: str) -> dict[str, str]:
    return {"scaled": f"SELECT *, d / max(d) OVER (PARTITION BY month) AS s FROM {distances}"}


STRUCT_DIM = NEAR_DIM = CONTEXT_DIM = 64
_noise = " + ".join(f"pow({normal('prev', i)} - {normal('curr', i)}, 2)" for i in range(STRUCT_DIM - 2))
CTE["struct_dist"] = f"""
    SELECT e.*, sqrt(pow(dp.degree - dc.degree, 2) + pow(rp.r - rc.r, 2) + {_noise}) AS d
    FROM month_edges e JOIN degrees dp ON dp.month = e.month AND dp.node = prev JOIN degrees dc ON dc.month = e.month AND dc.node = curr
    JOIN ranks rp ON rp.month = e.month AND rp.node = prev JOIN ranks rc ON rc.month = e.month AND rc.node = curr"""

# seeded normals of every node, one row per dimension
_part = "(CAST('0x' || substr(md5(concat_ws('|', '42', i // 4, node)), 8 * {} + 1, 8) AS BIGINT) + 0.5) / " + repr(WORD)
_first, _second = _part.format("(2 * ((i % 4) // 2))"), _part.format("(2 * ((i % 4) // 2) + 1)")
CTE["noise"] = f"""
    SELECT node, i, sqrt(-2 * ln({_first})) * CASE WHEN i % 2 = 0 THEN cos({2 * math.pi!r} * {_second}) ELSE sin({2 * math.pi!r} * {_second}) END AS x
    FROM (SELECT DISTINCT node FROM nodes), range({CONTEXT_DIM}) t(i)"""


def _weights(name: str, columns: int) -> str:
    text = f"concat_ws('|', '42', '{name}', r, c)"
    return f"SELECT r, c, (2 * {_word(text, 0)} - 1) / {math.sqrt(NEAR_DIM)!r} AS w FROM range({NEAR_DIM}) a(r), range({columns}) b(c)"


def _layer(source: str, layer: int) -> str:
    return f"""
        SELECT h.month, h.node, near.r AS i, greatest(sum(coalesce(m.x, 0) * near.w + h.x * own.w) + first(bias.w), 0.0) AS x
        FROM {source} h JOIN near{layer} near ON near.c = h.i JOIN own{layer} own ON own.c = h.i AND own.r = near.r
        JOIN bias{layer} bias ON bias.r = near.r
        LEFT JOIN (SELECT l.month, l.curr AS node, i, avg(x) AS x FROM links l JOIN {source} s ON s.month = l.month AND s.node = l.prev
                   GROUP BY ALL) m ON m.month = h.month AND m.node = h.node AND m.i = h.i
        GROUP BY ALL"""


for _k in (0, 1):
    CTE[f"near{_k}"], CTE[f"own{_k}"] = _weights(f"layer{_k}-neighbour", NEAR_DIM), _weights(f"layer{_k}-self", NEAR_DIM)
    CTE[f"bias{_k}"] = _weights(f"layer{_k}-bias", 1)
CTE["h_0"] = "SELECT month, node, i, x FROM nodes JOIN noise USING (node)"
CTE["h_1"] = _layer("h_0", 0)
CTE["h_2"] = _layer("h_1", 1)
CTE["near_dist"] = """
    SELECT e.month, e.prev, e.curr, e.type, sqrt(sum(pow(p.x - c.x, 2))) AS d
    FROM month_edges e JOIN h_2 p ON p.month = e.month AND p.node = e.prev JOIN h_2 c ON c.month = e.month AND c.node = e.curr AND c.i = p.i
    GROUP BY ALL"""

WALKS, WALK_LENGTH, CONTEXT_WINDOW = 200, 30, 10
CTE["hops"] = """
    SELECT month, prev, curr, (sum(weight) OVER w - weight) / sum(weight) OVER (PARTITION BY month, prev) AS low,
           sum(weight) OVER w / sum(weight) OVER (PARTITION BY month, prev) AS high
    FROM links WINDOW w AS (PARTITION BY month, prev ORDER BY substr(md5(curr), 1, 2), curr ROWS UNBOUNDED PRECEDING)"""
CTE["walk"] = f"""
    SELECT month, node AS start, i AS walk, 1 AS step, node AS here, node AS path FROM nodes, range({WALKS}) r(i)
    UNION ALL
    SELECT w.month, start, walk, step + 1, curr, path || '>' || curr
    FROM (SELECT *, {_word("concat_ws('|', '42', month, start, walk, step)", 0)} AS u FROM walk WHERE step < {WALK_LENGTH}) w
    JOIN hops h ON h.month = w.month AND h.prev = here AND u >= low AND u < high"""
CTE["steps"] = "SELECT month, start, walk, last(path ORDER BY step) AS path FROM walk GROUP BY ALL"
CTE["taken"] = "SELECT month, start, path, count(*) AS walks FROM steps GROUP BY ALL"
CTE["visits"] = """
    SELECT month, path, sum(walks) AS walks, generate_subscripts(string_split(path, '>'), 1) AS i, unnest(string_split(path, '>')) AS node
    FROM (SELECT month, path, sum(walks) AS walks FROM taken GROUP BY ALL) GROUP BY month, path"""
CTE["nearby"] = f"""
    SELECT a.month, a.node, b.node AS other, sum(a.walks) AS c FROM visits a
    JOIN visits b ON a.month = b.month AND a.path = b.path AND abs(a.i - b.i) <= {CONTEXT_WINDOW} AND a.node <> b.node
    GROUP BY ALL"""
CTE["context"] = """
    SELECT month, nearby.node, i, sum(c * x) AS s FROM nearby JOIN noise ON noise.node = other GROUP BY ALL"""

# Holt's smoothing, every pair of the grid
CTE["seq"] = """
    SELECT prev, curr, type, y, row_number() OVER (PARTITION BY prev, curr, type ORDER BY month) AS i,
           count(*) OVER (PARTITION BY prev, curr, type) AS c FROM pts"""
CTE["holt"] = """
    SELECT f.prev, f.curr, f.type, f.c, a / 10.0::DOUBLE AS a, b / 10.0::DOUBLE AS b, 1 AS i, f.y AS lv, s.y - f.y AS tr,
           0.0::DOUBLE AS e, 0.0::DOUBLE AS q
    FROM seq f JOIN seq s ON f.prev = s.prev AND f.curr = s.curr AND f.type = s.type AND f.i = 1 AND s.i = 2 AND f.c >= 3,
         range(1, 10) ga(a), range(1, 10) gb(b)
    UNION ALL
    SELECT h.prev, h.curr, h.type, h.c, a, b, h.i + 1, lv + tr + a * (y - (lv + tr)), tr + a * b * (y - (lv + tr)),
           e + (y - (lv + tr)), q + (y - (lv + tr)) * (y - (lv + tr))
    FROM holt h JOIN seq s ON s.prev = h.prev AND s.curr = h.curr AND s.type = h.type AND s.i = h.i + 1"""
CTE["smooth"] = """
    SELECT prev, curr, type, greatest(f, 0) AS forecast_n, greatest(f - 1.96 * s, 0) AS forecast_lower,
           greatest(f + 1.96 * s, 0) AS forecast_upper
    FROM (SELECT prev, curr, type, lv + tr AS f, sqrt(greatest(q / c - (e / c) * (e / c), 0)) AS s,
                 row_number() OVER (PARTITION BY prev, curr, type ORDER BY q, lv + tr) AS k
          FROM holt WHERE i = c) WHERE k = 1"""

# event-hour baselines
CTE["hour_med"] = """
    SELECT prev, curr, CAST(quantile_disc(n, 0.5) AS DOUBLE) AS baseline_median, avg(n) AS baseline_mean,
           coalesce(stddev_samp(n), 0.01) AS baseline_std FROM hours GROUP BY ALL"""
CTE["hour_base"] = """
    SELECT hour_med.*, m.baseline_mad FROM hour_med JOIN (
        SELECT prev, curr, avg(abs(n - baseline_median)) AS baseline_mad
        FROM hours JOIN hour_med USING (prev, curr) GROUP BY ALL) m USING (prev, curr)"""

# given clusters of vectors
CTE["vec"] = """
    SELECT vec_id, label, generate_subscripts(embedding, 1) AS i, CAST(unnest(embedding) AS DOUBLE) AS x FROM embeddings"""
CTE["centre"] = "SELECT label, i, avg(x) AS c FROM vec GROUP BY ALL"
CTE["vec_dist"] = "SELECT vec_id, label, sqrt(sum(pow(x - c, 2))) AS d FROM vec JOIN centre USING (label, i) GROUP BY ALL"

_RECURSIVE = {"walk", "holt", "rank"}


def with_(final: str, extra: dict[str, str] | None = None) -> str:
    """The final select preceded by those CTEs it needs, in order of definition."""
    pool = {**CTE, **(extra or {})}
    import re

    def mentions(text: str) -> set[str]:
        return {w for w in re.findall(r"[a-z_0-9]+", text) if w in pool}

    needed: set[str] = set()
    todo = mentions(final)
    while todo:
        name = todo.pop()
        if name not in needed:
            needed.add(name)
            todo |= mentions(pool[name]) - needed
    parts = [f"{name} AS ({body})" for name, body in pool.items() if name in needed]
    head = "WITH RECURSIVE " if needed & _RECURSIVE else "WITH "
    return (head + ",\n".join(parts) + "\n" if parts else "") + final


def rounded(source: str, columns: str, doubles: str) -> str:
    """Select plain columns and doubles rounded to six places."""
    values = ", ".join(f"round({c}, 6) AS {c}" for c in doubles.split())
    return f"SELECT {', '.join(columns.split())}{', ' + values if values else ''} FROM {source}"


ANOMALY = ("anomaly_id month prev curr type n anomaly_type description", "baseline_median deviation_ratio z_score confidence")
FORECAST = ("prev curr type month forecast_flag", "forecast_n forecast_lower forecast_upper forecast_error forecast_ratio")
FULL = (
    ANOMALY[0] + " forecast_flag",
    ANOMALY[1] + " forecast_n forecast_lower forecast_upper forecast_error forecast_ratio",
)
_PIVOT = ", ".join(
    f"CAST(coalesce(sum(n) FILTER (month = '{m}'), 0) AS BIGINT) AS \"{m}\"" for m in MONTHS
)
_TOP = "SELECT * FROM anomalies ORDER BY confidence DESC, anomaly_id LIMIT {k}"
_FIRST_ROWS = """
    SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY prev, curr, type ORDER BY month, anomaly_id) AS k FROM enriched)
    WHERE k = 1"""
_STATUS = """
    round(z_score, 6) AS z_value,
    CASE WHEN abs(z_score) >= 3.5 THEN 'anomaly' WHEN abs(z_score) >= 2 THEN 'elevated' ELSE 'normal' END AS z_status,
    round(deviation_ratio, 6) AS ratio_value,
    CASE WHEN deviation_ratio >= 10 THEN 'anomaly' WHEN deviation_ratio >= 5 THEN 'elevated' ELSE 'normal' END AS ratio_status,
    round(forecast_error, 6) AS error_value,
    CASE WHEN abs(forecast_error) > baseline_median * 2 THEN 'anomaly'
         WHEN abs(forecast_error) > baseline_median THEN 'elevated' ELSE 'normal' END AS error_status"""
_LABEL = "CASE anomaly_type WHEN 'traffic_spike' THEN 'Traffic Spike' WHEN 'mix_shift' THEN 'Mix Shift' WHEN 'navigation_edge' THEN 'Navigation Edge' END"
_FORECAST_SIGNAL = "CASE WHEN forecast_flag THEN 'Forecast Deviation' END"


def _signals(style: str) -> str:
    if style == "full":
        parts = [
            _LABEL, _FORECAST_SIGNAL, "CASE WHEN deviation_ratio >= 10 THEN 'High Deviation Ratio' END",
            "CASE WHEN abs(z_score) >= 3.5 THEN 'MAD-Z Score' END",
        ]
        return f"coalesce(nullif(concat_ws(', ', {', '.join(parts)}), ''), 'Anomaly Detected')"
    parts = [
        _LABEL, _FORECAST_SIGNAL, "CASE WHEN abs(z_score) >= 3.5 THEN 'MAD-Z Score' END",
        "CASE WHEN deviation_ratio >= 10 THEN 'High Deviation' END",
    ]
    return f"concat_ws(', ', {', '.join(parts)})"


_EXPLAIN = """concat_ws(' ',
    'This anomaly detected in ' || month || ' shows unusual traffic from ''' || prev || ''' to ''' || curr || '''.',
    CASE WHEN anomaly_type = 'traffic_spike' OR deviation_ratio > 10 THEN
      'Traffic spiked to ' || format('{:,}', n) || ' transitions (' || printf('%.1f', deviation_ratio)
      || 'x the baseline median of ' || printf('%.0f', baseline_median) || ').' END,
    CASE WHEN abs(z_score) > 3.5 THEN 'Statistical analysis shows a robust Z-score of ' || printf('%.2f', z_score)
      || ', indicating a significant deviation from normal patterns.' END,
    CASE WHEN forecast_flag THEN 'Time-series forecasting predicted ' || printf('%.0f', forecast_n)
      || ' transitions (upper bound: ' || printf('%.0f', forecast_upper) || '), but actual traffic was '
      || format('{:,}', n) || ', exceeding the forecast.' END,
    CASE WHEN anomaly_type = 'mix_shift' THEN 'The referrer distribution for this page changed significantly, indicating a shift in how users are discovering or navigating to this content.' END,
    'Overall confidence: ' || printf('%.1f', confidence * 100) || '%')"""

CTE["series6"] = """
    SELECT prev, curr, type, string_agg(month || ':' || n, ',' ORDER BY month) AS series
    FROM (SELECT *, row_number() OVER (PARTITION BY prev, curr, type ORDER BY month DESC) AS k FROM em) WHERE k <= 6 GROUP BY ALL"""
CTE["refs"] = """
    SELECT curr, string_agg(month || '/' || total || '/' || names, ';' ORDER BY month) AS referrers FROM (
        SELECT curr, month, total, string_agg(prev || ':' || n, ',' ORDER BY rank) AS names FROM top10 GROUP BY ALL) GROUP BY ALL"""
CTE["daily"] = "SELECT page, month, count(*) AS days, CAST(sum(views) AS BIGINT) AS total_views FROM around GROUP BY ALL"


def oracle_sql() -> dict[str, str]:
    feature_ratios = ", ".join(
        f"round(CASE WHEN baseline_median > 0 THEN \"{m}\" / baseline_median ELSE 0.0 END, 6) AS \"ratio_{m}\"" for m in MONTHS
    )
    out = {
        "read_raw_months": "SELECT * FROM raw",
        "clean_clicks": """SELECT prev, curr, type, n, month, lower(prev) AS prev_normalized, lower(curr) AS curr_normalized,
            CASE WHEN prev LIKE 'other-%' THEN prev WHEN prev = 'null' THEN 'direct' ELSE 'page' END AS prev_category,
            CASE WHEN curr LIKE 'other-%' THEN curr WHEN curr = 'null' THEN 'direct' ELSE 'page' END AS curr_category FROM clicks""",
        "page_categories": """SELECT CASE WHEN prev LIKE 'other-%' THEN prev ELSE 'page' END AS prev_category,
            count(*) AS rows, CAST(sum(n) AS BIGINT) AS n FROM clicks GROUP BY ALL""",
        "title_codec": """SELECT p_partkey, url_encode(replace(p_name || ' ~' || p_type || '*é/' || p_brand, ' ', '_')) AS encoded,
            replace(p_name || ' ~' || p_type || '*é/' || p_brand, '_', ' ') AS decoded FROM part""",
        "edge_month": "SELECT * FROM em",
        "month_pivot": f"SELECT prev, curr, type, {_PIVOT} FROM em GROUP BY ALL",
        "edge_baselines": rounded("base", "prev curr type", "baseline_median baseline_mean baseline_std baseline_mad"),
        "edge_baselines_median_abs": """SELECT prev, curr, type, round(baseline_median, 6) AS baseline_median,
            round(quantile_disc(abs(n - baseline_median), 0.5), 6) AS baseline_mad FROM em JOIN med USING (prev, curr, type) GROUP BY ALL""",
        "raw_row_baselines": """SELECT r.prev, r.curr, r.type, round(m, 6) AS baseline_median, round(mean, 6) AS baseline_mean,
            round(sd, 6) AS baseline_std, round(avg(abs(em.n - m)), 6) AS baseline_mad
            FROM (SELECT prev, curr, type, median(n) AS m, avg(n) AS mean, coalesce(stddev_samp(n), 0.01) AS sd FROM clicks GROUP BY ALL) r
            JOIN em USING (prev, curr, type) GROUP BY ALL""",
        "referrer_distribution": """SELECT curr, prev, month, n, n / sum(n) OVER w AS proportion,
            CAST(sum(n) OVER w AS BIGINT) AS total_n FROM pm WINDOW w AS (PARTITION BY curr, month)""",
        "pooled_distribution": """SELECT curr, prev, month, base_n, base_n / base_total AS baseline_proportion FROM before""",
        "aligned_distributions": """SELECT curr, prev, month, coalesce(n.n / n.total_n, 0) AS proportion,
            coalesce(b.base_n / b.base_total, 0) AS baseline_proportion
            FROM now n FULL JOIN before b USING (curr, prev, month)""",
        "js_shift": """SELECT curr, month, referrers, total_n, round(d, 6) AS js_distance, round(d / 2, 6) AS js_score FROM (
            SELECT curr, month, count(*) AS referrers, CAST(sum(n) AS BIGINT) AS total_n,
              CASE WHEN count(*) >= 3 THEN sqrt(greatest((sum(CASE WHEN p > 0 THEN p * ln(2 * p / (p + q)) ELSE 0 END)
                + sum(CASE WHEN q > 0 THEN q * ln(2 * q / (p + q)) ELSE 0 END)) / 2, 0)) ELSE 0 END AS d
            FROM (SELECT curr, month, n.n, coalesce(n.n / n.total_n, 0) AS p, coalesce(b.base_n / b.base_total, 0) AS q
                  FROM now n FULL JOIN before b USING (curr, prev, month))
            GROUP BY curr, month HAVING max(p) > 0 AND max(q) > 0)""",
        "traffic_spikes": rounded("spikes", *ANOMALY),
        "spikes_against_baselines": rounded("spikes", *ANOMALY),
        "spikes_prior_history": rounded("found", *ANOMALY),
        "spikes_last_six": rounded("found", *ANOMALY),
        "spikes_plus_epsilon_ratio": rounded("found", *ANOMALY),
        "mix_shifts_all_ties": rounded("found", *ANOMALY),
        "mix_shifts_first": rounded("found", *ANOMALY),
        "mix_shifts_with_js": rounded("found", *ANOMALY),
        "all_anomalies": rounded("anomalies", *ANOMALY),
        "stored_anomalies": rounded("anomalies", *ANOMALY) + " WHERE month = '1998-07' AND anomaly_type = 'mix_shift'",
        "all_stored_anomalies": rounded("anomalies", *ANOMALY),
        "flat_anomalies": rounded("anomalies", *ANOMALY),
        "truth_pages": "SELECT DISTINCT page FROM truth",
        "edge_features": f"""SELECT prev, curr, type, round(baseline_median, 6) AS baseline_median, round(baseline_mean, 6) AS baseline_mean,
            round(baseline_mad, 6) AS baseline_mad, {', '.join(f'"{m}"' for m in MONTHS)}, {feature_ratios},
            CASE WHEN type = 'link' THEN 1.0 ELSE 0.0 END::DOUBLE AS type_link, CASE WHEN type = 'external' THEN 1.0 ELSE 0.0 END::DOUBLE AS type_external,
            CASE WHEN type = 'other' THEN 1.0 ELSE 0.0 END::DOUBLE AS type_other
            FROM (SELECT prev, curr, type, {_PIVOT} FROM em GROUP BY ALL) JOIN base USING (prev, curr, type)""",
        "centroid_outliers": """SELECT vec_id, label, round(d, 6) AS distance_to_center, round(1 - 0.5 * t / d, 6) AS confidence
            FROM vec_dist, (SELECT quantile_cont(d, 0.95) AS t FROM vec_dist) WHERE d >= t""",
        "last_six_months": """SELECT prev, curr, type, month, n FROM (
            SELECT *, row_number() OVER (PARTITION BY prev, curr, type ORDER BY month DESC) AS k FROM em) WHERE k <= 6""",
        "top_ten_referrers": "SELECT curr, month, CAST(rank AS INT) AS rank, prev, n, total, proportion FROM top10",
        "dated_series": """SELECT prev, curr, type, string_agg(month || '-01' || '=' || n, ',' ORDER BY month) AS points FROM em GROUP BY ALL""",
        "forecast_moving_average": rounded("found", *FORECAST),
        "forecast_trend": rounded("compared", *FORECAST) + f" WHERE month >= '{FIRST_TARGET}'",
        "forecast_smoothing": rounded("found", *FORECAST),
        "forecast_ahead": rounded("found", *FORECAST),
        "forecast_flag_counts": "SELECT count(*) AS rows, count(*) FILTER (forecast_flag) AS flagged FROM compared WHERE month >= '" + FIRST_TARGET + "'",
        "enriched_anomalies": rounded("enriched", *FULL),
        "enriched_stored_anomalies": rounded("enriched", *FULL),
        "stream_running_scores": """
            SELECT prev, curr, strftime(h, '%Y-%m-%d %H:%M') AS window_start, n, seen, round(m, 6) AS baseline_mean, round(s, 6) AS baseline_std,
                   round((n - m) / (s + 0.01), 6) AS z_score
            FROM (SELECT prev, curr, h, n, count(*) OVER w AS seen, avg(n) OVER w AS m, stddev_samp(n) OVER w AS s FROM hours
                  WINDOW w AS (PARTITION BY prev, curr ORDER BY h ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING))""",
        "landed_views": "SELECT page, CAST(date AS VARCHAR) AS date, views FROM views",
        "edge_lookup": f"SELECT em.* FROM em WHERE (prev, curr, type) IN (SELECT (prev, curr, type) FROM ({_TOP.format(k=100)}))",
        "stream_updates": "SELECT strftime(h, '%Y-%m-%d %H:%M') AS window_start, prev, curr, n FROM hours",
        "sketch_baselines": """SELECT prev, curr, round(avg(n), 6) AS baseline_mean, round(coalesce(stddev_samp(n), 0.01), 6) AS baseline_std,
            true AS median_in_bounds FROM hours GROUP BY ALL""",
        "node_degree": "SELECT month, node, degree FROM degrees",
        "pagerank": "SELECT month, node, round(r, 6) AS pagerank FROM ranks",
        "heaviest_edges": """SELECT month, prev, curr, weight FROM links
            QUALIFY row_number() OVER (PARTITION BY month ORDER BY weight DESC, prev, curr) <= 50""",
        "structural_scores": _flagged("struct_dist"),
        "neighbour_scores": _flagged("near_dist"),
        "random_walks": "SELECT month, start, path, walks FROM taken",
        "context_embeddings": """SELECT month, node, CAST(i AS INT) AS i, round(s / sqrt(sum(s * s) OVER (PARTITION BY month, node)), 6) AS x
            FROM context""",
        "anomaly_stats": """SELECT 'total' AS scope, 'all' AS value, count(*) AS count, round(avg(confidence), 6) AS avg_confidence FROM anomalies
            UNION ALL SELECT 'type', anomaly_type, count(*), round(avg(confidence), 6) FROM anomalies GROUP BY ALL
            UNION ALL SELECT 'month', month, count(*), round(avg(confidence), 6) FROM anomalies GROUP BY ALL""",
        "type_by_month": """SELECT month, count(*) FILTER (anomaly_type = 'traffic_spike') AS traffic_spike,
            count(*) FILTER (anomaly_type = 'mix_shift') AS mix_shift, count(*) FILTER (anomaly_type = 'navigation_edge') AS navigation_edge,
            count(*) FILTER (forecast_flag OR anomaly_type ILIKE '%forecast%') AS forecast_spike FROM enriched GROUP BY ALL""",
        "top_confident": rounded(f"({_TOP.format(k=10)})", *ANOMALY),
        "browse": rounded("(SELECT * FROM anomalies WHERE confidence >= 0.6 ORDER BY confidence DESC, anomaly_id LIMIT 1000)", *ANOMALY),
        "browse_two_tier": """SELECT CAST(row_number() OVER (ORDER BY deviation_ratio > 1 DESC, CASE WHEN deviation_ratio > 1 THEN deviation_ratio END DESC NULLS LAST,
            confidence DESC, anomaly_id) AS INT) AS position, anomaly_id FROM anomalies WHERE deviation_ratio IS NOT NULL ORDER BY position LIMIT 5000""",
        "interest_product": """SELECT anomaly_id, round(confidence * deviation_ratio, 6) AS interest_score FROM anomalies
            ORDER BY confidence * deviation_ratio DESC, anomaly_id LIMIT 5""",
        "interest_weighted": """SELECT anomaly_id, round(s, 6) AS interest_score FROM (
            SELECT anomaly_id, 0.7 * deviation_ratio + 0.3 * greatest(least(confidence, 1), 0) * deviation_ratio AS s FROM anomalies)
            ORDER BY s DESC, anomaly_id LIMIT 5""",
        "insights": """SELECT 1 AS position, 'In ' || month || ', ' || prev || ' → ' || curr || ' had the largest spike (' || printf('%.1f', deviation_ratio) || 'x baseline).' AS insight
              FROM (SELECT * FROM anomalies ORDER BY deviation_ratio DESC, anomaly_id LIMIT 1)
            UNION ALL SELECT 2, '''' || curr || ''' appears in ' || c || ' anomaly records, the most of any page.'
              FROM (SELECT curr, count(*) AS c FROM anomalies GROUP BY curr ORDER BY c DESC, curr LIMIT 1)
            UNION ALL SELECT 3, month || ' had ' || c || ' anomalies, the highest count of any month.'
              FROM (SELECT month, count(*) AS c FROM anomalies GROUP BY month ORDER BY c DESC, month LIMIT 1)
            UNION ALL SELECT 4, '''' || prev || ''' was the most common referrer source (' || c || ' occurrences).'
              FROM (SELECT prev, count(*) AS c FROM anomalies GROUP BY prev ORDER BY c DESC, prev LIMIT 1)""",
        "value_counts": "SELECT curr, count(*) AS count FROM anomalies GROUP BY ALL",
        "deviation_summary": """SELECT count(*) FILTER (deviation_ratio > 5) AS rows_above, round(max(deviation_ratio), 6) AS max_ratio,
            round(min(deviation_ratio), 6) AS min_ratio, round(avg(deviation_ratio), 6) AS avg_ratio FROM anomalies""",
        "mean_confidence": "SELECT count(*) AS count, round(coalesce(avg(confidence), 0), 6) AS avg_confidence FROM anomalies WHERE anomaly_type = 'mix_shift'",
        "months_with_anomalies": "SELECT DISTINCT month FROM anomalies",
        "anomaly_by_id": rounded("anomalies", *ANOMALY) + " WHERE anomaly_id = (SELECT anomaly_id FROM anomalies ORDER BY confidence DESC, anomaly_id LIMIT 1)",
        "graph_nodes": f"""SELECT DISTINCT id, substr(id, 1, 50) AS label FROM (
            SELECT prev AS id FROM ({_TOP.format(k=100)}) UNION ALL SELECT curr FROM ({_TOP.format(k=100)}))""",
        "graph_edges": f"SELECT prev AS source, curr AS target, round(confidence, 6) AS weight, anomaly_type, anomaly_id FROM ({_TOP.format(k=100)})",
        "precision_at_k": f"""SELECT count(*) AS hits, round(count(*) / 50, 6) AS precision FROM ({_TOP.format(k=50)})
            WHERE prev IN (SELECT page FROM truth) OR curr IN (SELECT page FROM truth)""",
        "explanations": f"SELECT anomaly_id, {_EXPLAIN} AS explanation FROM enriched",
        "signals": f"SELECT anomaly_id, {_signals('full')} AS signals FROM enriched",
        "signals_short": f"SELECT anomaly_id, {_signals('short')} AS signals FROM enriched",
        "signal_status": f"SELECT anomaly_id, {_STATUS} FROM enriched",
        "edge_history": """SELECT month, n, round(baseline_median, 6) AS baseline_median, round(baseline_mad, 6) AS baseline_mad
            FROM em JOIN base USING (prev, curr, type) WHERE prev = 'NATION_1' AND curr = 'ECONOMY' AND type = 'link'""",
        "page_distribution": """SELECT month, prev, n / sum(n) OVER (PARTITION BY month) AS proportion, n
            FROM pm WHERE curr = 'ECONOMY' AND month IN (SELECT month FROM months ORDER BY month DESC LIMIT 3)""",
        "filled_series": f"""SELECT a.prev, a.curr, a.type, m.month, coalesce(e.n, 0) AS traffic, round(a.baseline_median, 6) AS baseline_median,
            round(a.forecast_n, 6) AS forecast_n, round(a.forecast_lower, 6) AS forecast_lower, round(a.forecast_upper, 6) AS forecast_upper
            FROM ({_FIRST_ROWS}) a JOIN (SELECT DISTINCT prev, curr, type FROM em) k USING (prev, curr, type), months m
            LEFT JOIN em e ON e.prev = a.prev AND e.curr = a.curr AND e.type = a.type AND e.month = m.month
            UNION ALL SELECT prev, curr, type, month, n, round(baseline_median, 6), round(forecast_n, 6), round(forecast_lower, 6), round(forecast_upper, 6)
            FROM enriched WHERE NOT EXISTS (SELECT 1 FROM em WHERE em.prev = enriched.prev AND em.curr = enriched.curr AND em.type = enriched.type)""",
        "referrer_changes": "SELECT curr, top_referrer_flip, major_mix_shift FROM changes",
        "anomaly_details": f"""SELECT e.anomaly_id, coalesce(series, '') AS series, referrers, {_signals('short')} AS signals,
            coalesce(daily_spike_match, false) AS daily_spike_match, top_referrer_flip, major_mix_shift,
            coalesce(days, 0)::INT AS days, coalesce(total_views, 0)::BIGINT AS total_views
            FROM enriched e LEFT JOIN series6 USING (prev, curr, type) LEFT JOIN refs USING (curr) LEFT JOIN changes USING (curr)
            LEFT JOIN matches m ON m.page = curr AND m.month = e.month LEFT JOIN daily d ON d.page = curr AND d.month = e.month""",
        "daily_views": "SELECT page, CAST(date AS VARCHAR) AS date, views FROM views",
        "response_views": "SELECT page, CAST(date AS VARCHAR) AS date, views FROM views",
        "views_around": "SELECT page, month, CAST(date AS VARCHAR) AS date, views FROM around",
        "daily_spike_match": rounded("matches", "page month peak_views daily_spike_match", "mean_views"),
        "anomalies_pageviews": """SELECT anomaly_id, page, CAST(date AS VARCHAR) AS date, views FROM anomalies LEFT JOIN views ON curr = page""",
        "event_transitions": "SELECT prev, curr, CAST(date_trunc('day', ts) AS DATE)::VARCHAR AS day, count(*) AS n FROM moves GROUP BY ALL",
        "hourly_baselines": rounded("hour_base", "prev curr", "baseline_median baseline_mean baseline_std baseline_mad"),
        "stream_window_counts": "SELECT strftime(h, '%Y-%m-%d %H:%M') AS window_start, prev, curr, n FROM hours",
        "stream_alerts": """SELECT strftime(h, '%Y-%m-%d %H:%M') AS window_start, prev, curr, n, round(r, 6) AS deviation_ratio,
            round(z, 6) AS z_score FROM (SELECT *, CASE WHEN baseline_median > 0 THEN n / baseline_median ELSE 0 END AS r,
            (n - baseline_median) / (baseline_mad + 0.01) AS z FROM hours JOIN hour_base USING (prev, curr)) WHERE r >= 10 OR abs(z) >= 3.5""",
    }
    prior = {"past": _history_base("h.month < t.month", "mean_abs")}
    six = {
        "past": _history_base(
            "h.month < t.month AND date_diff('month', CAST(h.month || '-01' AS DATE), CAST(t.month || '-01' AS DATE)) <= 6", "median_abs"
        )
    }

    def with_mad(kind: str) -> str:
        return f"SELECT * EXCLUDE (past), {_deviation(kind)} AS baseline_mad FROM past"

    js = CTE["mix"].replace(
        "WHERE changed OR change >= 0.2",
        "WHERE changed OR change >= 0.2 OR (curr, month) IN (SELECT (curr, month) FROM js WHERE js_score >= 0.1)",
    )
    ahead = """
        SELECT prev, curr, type, month, n, f AS forecast_n, greatest(f - 1.96 * s, 0) AS forecast_lower,
               greatest(f + 1.96 * s, 0) AS forecast_upper
        FROM (SELECT t.prev, t.curr, t.type, t.month, t.n, avg(h.y) FILTER (h.k <= 3) AS f, stddev_pop(h.y) FILTER (h.k <= 3) AS s
              FROM em t JOIN (SELECT a.prev, a.curr, a.type, a.month AS target, b.y,
                                     row_number() OVER (PARTITION BY a.prev, a.curr, a.type, a.month ORDER BY b.month DESC) AS k
                              FROM em a JOIN pts b ON a.prev = b.prev AND a.curr = b.curr AND a.type = b.type AND b.month < a.month) h
                   ON h.prev = t.prev AND h.curr = t.curr AND h.type = t.type AND h.target = t.month
              GROUP BY ALL HAVING count(*) >= 3)"""
    extra = {
        "spikes_prior_history": {**prior, "rows_": with_mad("mean_abs"), "found": _spike_rows("rows_", _GUARDED)},
        "spikes_last_six": {**six, "rows_": with_mad("median_abs"), "found": _spike_rows("rows_", _GUARDED)},
        "spikes_plus_epsilon_ratio": {"found": _spike_rows("against", "n / (baseline_median + 0.01)", "steep")},
        "mix_shifts_all_ties": {"found": _mix("place", "least(0.5 + 0.5 * (change - 0.2) / 0.8, 1.0)")},
        "mix_shifts_first": {"found": _mix("place1", "least(change / 0.5, 1.0)")},
        "mix_shifts_with_js": {"js": out["js_shift"], "found": js},
        "forecast_moving_average": {"found": _metrics("average", f"WHERE month >= '{FIRST_TARGET}'")},
        "forecast_smoothing": {"found": _metrics("smooth", f"WHERE month >= '{FIRST_TARGET}'")},
        "forecast_ahead": {
            "ahead": ahead,
            "found": f"""SELECT *, n - forecast_n AS forecast_error, n / (forecast_n + 1e-6) AS forecast_ratio,
                n > forecast_upper OR n / (forecast_n + 1e-6) >= 2 AS forecast_flag FROM ahead WHERE month >= '{FIRST_TARGET}'""",
        },
        "structural_scores": _scaled("struct_dist"),
        "neighbour_scores": _scaled("near_dist"),
    }
    out["clean_table"] = out["clean_clicks"]
    return {name: with_(sql, extra.get(name)) for name, sql in out.items()}
