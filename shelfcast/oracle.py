"""Plain SQL for the registered queries, written independently of the Spark plans.

The text runs on a single-node SQL engine over the same Parquet tables. Windows
are spelled out frame by frame here, where the Spark side works from lags.
"""

from __future__ import annotations

BASE = """
WITH fact AS (
  SELECT r_name AS store_id, p_brand AS item_id, CAST(l_shipdate AS DATE) AS date, l_quantity, l_extendedprice
  FROM lineitem
  JOIN supplier ON l_suppkey = s_suppkey
  JOIN nation ON s_nationkey = n_nationkey
  JOIN region ON n_regionkey = r_regionkey
  JOIN part ON l_partkey = p_partkey
), bounds AS (
  SELECT CAST(min(l_shipdate) AS DATE) AS lo, CAST(max(l_shipdate) AS DATE) AS hi FROM lineitem
), days AS (
  SELECT lo, CAST(unnest(generate_series(lo, hi, INTERVAL 1 DAY)) AS DATE) AS date FROM bounds
), calendar AS (
  SELECT 'd_' || CAST(date_diff('day', lo, date) + 1 AS VARCHAR) AS d, date,
    CAST(isoyear(date) * 100 + weekofyear(date) AS INTEGER) AS wm_yr_wk,
    CAST(year(date) AS INTEGER) AS year, CAST(month(date) AS INTEGER) AS month,
    CAST(dayofweek(date) + 1 AS INTEGER) AS wday, dayname(date) AS weekday,
    CASE strftime(date, '%m-%d') WHEN '01-01' THEN 'NewYear' WHEN '07-04' THEN 'Independence'
      WHEN '10-31' THEN 'Halloween' WHEN '12-25' THEN 'Christmas' END AS event_name_1,
    CASE strftime(date, '%m-%d') WHEN '01-01' THEN 'National' WHEN '07-04' THEN 'National'
      WHEN '10-31' THEN 'Cultural' WHEN '12-25' THEN 'Cultural' END AS event_type_1,
    CASE strftime(date, '%m-%d') WHEN '07-04' THEN 'Parade' WHEN '12-25' THEN 'YearEnd' END AS event_name_2,
    CASE strftime(date, '%m-%d') WHEN '07-04' THEN 'Cultural' WHEN '12-25' THEN 'National' END AS event_type_2
  FROM days
), daily AS (
  SELECT store_id, item_id, date, CAST(sum(l_quantity) AS INTEGER) AS sales FROM fact GROUP BY ALL
), sell_prices AS (
  SELECT store_id, item_id, wm_yr_wk, CAST(floor(min(l_extendedprice / l_quantity) / 100) * 100 AS DOUBLE) AS sell_price
  FROM fact JOIN calendar USING (date) GROUP BY ALL
), series AS (
  SELECT DISTINCT store_id, item_id FROM daily
), panel AS (
  SELECT c.date, substring(s.store_id, 1, 2) AS state_id, s.store_id,
    'DEPT_' || CAST(CAST(regexp_extract(s.item_id, '([0-9]+)$', 1) AS INTEGER) % 7 AS VARCHAR) AS dept_id,
    'CAT_' || CAST(CAST(regexp_extract(s.item_id, '([0-9]+)$', 1) AS INTEGER) % 3 AS VARCHAR) AS cat_id,
    s.item_id, c.wm_yr_wk, c.d, coalesce(y.sales, 0) AS sales, p.sell_price,
    c.year, c.month, c.wday, c.weekday, c.event_name_1, c.event_type_1, c.event_name_2, c.event_type_2
  FROM series s CROSS JOIN calendar c
  LEFT JOIN daily y ON y.store_id = s.store_id AND y.item_id = s.item_id AND y.date = c.date
  LEFT JOIN sell_prices p ON p.store_id = s.store_id AND p.item_id = s.item_id AND p.wm_yr_wk = c.wm_yr_wk
), price_modes AS (
  SELECT item_id, sell_price AS mode_price FROM (
    SELECT item_id, sell_price, row_number() OVER (PARTITION BY item_id ORDER BY count(*) DESC, sell_price) AS rn
    FROM panel WHERE sell_price IS NOT NULL GROUP BY item_id, sell_price) WHERE rn = 1
), clean AS (
  SELECT p.* EXCLUDE (sell_price, event_name_1, event_type_1, event_name_2, event_type_2),
    coalesce(sell_price, mode_price) AS sell_price,
    coalesce(event_name_1, 'Sin_evento') AS event_name_1, coalesce(event_type_1, 'Sin_evento') AS event_type_1
  FROM panel p LEFT JOIN price_modes USING (item_id)
)
"""

SALES_LAGS = range(1, 16)
PRICE_LAGS = range(1, 8)
SPANS = range(2, 16)
FLAGS = (3, 7, 15)

LAG_NAMES = [f"sales_lag_{k}" for k in SALES_LAGS] + [f"sell_price_lag_{k}" for k in PRICE_LAGS]
FLAG_NAMES = [f"stockout_{n}_lag_1" for n in FLAGS]
ROLL_NAMES = [f"sales_{kind}_{k}" for kind in ("rollmin", "rollmean", "rollmax") for k in SPANS]
EVENTS = ["Christmas", "Halloween", "Independence", "NewYear", "Sin_evento"]
ONE_HOT_NAMES = [f"event_name_1_{e}" for e in EVENTS]
TE_COLUMNS = ["month", "wday", "weekday"]
TE_NAMES = [f"{c}_te" for c in TE_COLUMNS]
FEATURES = (
    [f"sell_price_lag_{k}" for k in PRICE_LAGS]
    + FLAG_NAMES
    + [f"sales_lag_{k}" for k in SALES_LAGS]
    + ROLL_NAMES
    + ONE_HOT_NAMES
    + TE_NAMES
)


def _lags() -> str:
    sales = [f"lag(sales, {k}) OVER w AS sales_lag_{k}" for k in SALES_LAGS]
    prices = [f"lag(sell_price, {k}) OVER w AS sell_price_lag_{k}" for k in PRICE_LAGS]
    return ", ".join(sales + prices)


def _flags() -> str:
    return ", ".join(
        f"CASE WHEN sum(CASE WHEN sales = 0 THEN 1 ELSE 0 END) OVER "
        f"(PARTITION BY store_id, item_id ORDER BY date ROWS BETWEEN {n} PRECEDING AND 1 PRECEDING) = {n} "
        f"THEN 1 ELSE 0 END AS stockout_{n}_lag_1"
        for n in FLAGS
    )


def _rolling() -> str:
    parts = []
    for kind, function in (("rollmin", "min"), ("rollmean", "avg"), ("rollmax", "max")):
        for k in SPANS:
            frame = (
                "(PARTITION BY store_id, item_id ORDER BY date "
                f"ROWS BETWEEN {k} PRECEDING AND 1 PRECEDING)"
            )
            parts.append(
                f"CASE WHEN count(sales) OVER {frame} = {k} THEN {function}(sales) OVER {frame} END "
                f"AS sales_{kind}_{k}"
            )
    return ", ".join(parts)


def _rows(names: list[str], source: str) -> str:
    values = ", ".join(f'round(CAST("{n}" AS DOUBLE), 6) AS "{n}"' for n in names)
    return f"SELECT store_id, item_id, date, {values} FROM {source}"


WINDOW = "WINDOW w AS (PARTITION BY store_id, item_id ORDER BY date)"

FEATURE_ROWS = f""", features AS (
  SELECT * FROM (
    SELECT store_id, item_id, date, event_name_1, month, wday, weekday, sales, sell_price,
      {_lags()}, {_flags()}, {_rolling()}
    FROM clean {WINDOW})
  WHERE sell_price IS NOT NULL AND {" AND ".join(f"{n} IS NOT NULL" for n in LAG_NAMES)}
)"""


def _one_hot(seen: str, source: str, fitted_on: str) -> str:
    flags = ", ".join(
        f"CASE WHEN event_name_1 = '{e}' AND k.category IS NOT NULL THEN 1.0::DOUBLE ELSE 0.0::DOUBLE END "
        f'AS "event_name_1_{e}"'
        for e in seen.split()
    )
    return (
        f"SELECT s.store_id, s.item_id, s.date, {flags} FROM {source} s LEFT JOIN "
        f"(SELECT DISTINCT store_id, item_id, event_name_1 AS category FROM {fitted_on}) k "
        "ON k.store_id = s.store_id AND k.item_id = s.item_id AND k.category = s.event_name_1"
    )


def _target_state(source: str, columns: list[str], keys: str = "store_id, item_id, ") -> str:
    join = "USING (store_id, item_id)" if keys else "ON TRUE"
    group = f"GROUP BY {keys.rstrip(', ')}" if keys else ""
    stats = " UNION ALL ".join(
        f"SELECT {keys}'{c}' AS variable, CAST({c} AS VARCHAR) AS category, count(*) AS n, avg(sales) AS mean "
        f"FROM {source} GROUP BY {keys}{c}"
        for c in columns
    )
    return (
        f"SELECT {keys}variable, category, n, mean, prior, CASE WHEN n = 1 THEN prior ELSE "
        "prior * (1 - 1 / (1 + exp(-(n - 100) / 1.0))) + mean * (1 / (1 + exp(-(n - 100) / 1.0))) END AS encoding "
        f"FROM ({stats}) JOIN (SELECT {keys}avg(sales) AS prior FROM {source} {group}) {join}"
    )


def _target_join(columns: list[str], keys: bool = True) -> tuple[str, str]:
    values = ", ".join(f"coalesce(e_{c}.encoding, pr.prior) AS {c}_te" for c in columns)
    same = "{0}.store_id = s.store_id AND {0}.item_id = s.item_id AND " if keys else ""
    joins = " ".join(
        f"LEFT JOIN te e_{c} ON {same.format('e_' + c)}e_{c}.variable = '{c}' "
        f"AND e_{c}.category = CAST(s.{c} AS VARCHAR)"
        for c in columns
    )
    if keys:
        prior = (
            "LEFT JOIN (SELECT DISTINCT store_id, item_id, prior FROM te) pr "
            "ON pr.store_id = s.store_id AND pr.item_id = s.item_id"
        )
    else:
        prior = "JOIN (SELECT DISTINCT prior FROM te) pr ON TRUE"
    return values, f"{joins} {prior}"


_values, _joins = _target_join(TE_COLUMNS)
ENCODED_ROWS = (
    FEATURE_ROWS
    + f""", te AS ({_target_state("features", TE_COLUMNS)}),
encoded AS (
  SELECT s.* EXCLUDE (event_name_1, month, wday, weekday, sell_price),
    {", ".join(f'''CASE WHEN s.event_name_1 = '{e}' THEN 1.0::DOUBLE ELSE 0.0::DOUBLE END AS "event_name_1_{e}"''' for e in EVENTS)},
    {_values}
  FROM features s {_joins})"""
)

SCORES = (
    ENCODED_ROWS
    + f""", placed AS (
  SELECT *, floor(10 * (rank() OVER (PARTITION BY store_id, item_id ORDER BY sales) - 1)
      / count(*) OVER (PARTITION BY store_id, item_id)) AS ybin,
    count(*) OVER (PARTITION BY store_id, item_id) AS n FROM encoded
), long_rows AS (
  SELECT store_id, item_id, ybin, n, feature, x FROM (
    SELECT store_id, item_id, ybin, n, {", ".join(f'CAST("{f}" AS DOUBLE) AS "{f}"' for f in FEATURES)} FROM placed)
  UNPIVOT (x FOR feature IN ({", ".join(f'"{f}"' for f in FEATURES)}))
), binned AS (
  SELECT store_id, item_id, feature, ybin, n,
    floor(10 * (rank() OVER (PARTITION BY store_id, item_id, feature ORDER BY x) - 1) / n) AS xbin FROM long_rows
), cells AS (
  SELECT store_id, item_id, feature, n, xbin, ybin, count(*) AS c FROM binned GROUP BY ALL
), scores AS (
  SELECT store_id, item_id, feature, sum((c / n) * ln(c * n / (cx * cy))) AS mutual_information FROM (
    SELECT *, sum(c) OVER (PARTITION BY store_id, item_id, feature, xbin) AS cx,
      sum(c) OVER (PARTITION BY store_id, item_id, feature, ybin) AS cy FROM cells)
  GROUP BY store_id, item_id, feature
)"""
)

PANEL_TYPES = {
    "date": "date",
    "state_id": "string",
    "store_id": "string",
    "dept_id": "string",
    "cat_id": "string",
    "item_id": "string",
    "wm_yr_wk": "int",
    "d": "string",
    "sales": "int",
    "sell_price": "double",
    "year": "int",
    "month": "int",
    "wday": "int",
    "weekday": "string",
    "event_name_1": "string",
    "event_type_1": "string",
    "event_name_2": "string",
    "event_type_2": "string",
}
CATEGORIES = ["store_id", "item_id", "year", "month", "wday", "weekday", "event_name_1", "event_type_1"]
POOLED = ["year", "month", "wday", "weekday", "event_name_1", "event_type_1"]
WEEKDAYS = ["Friday", "Monday", "Saturday", "Sunday", "Thursday", "Tuesday", "Wednesday"]
MODEL_COLUMNS = "date, store_id, item_id, event_name_1, month, sell_price, wday, weekday, sales"
FILLED = (
    ", filled AS (SELECT * EXCLUDE (event_name_1, event_type_1), coalesce(event_name_1, 'Sin_evento') AS "
    "event_name_1, coalesce(event_type_1, 'Sin_evento') AS event_type_1 FROM panel)"
)


def _union(parts: list[str]) -> str:
    return " UNION ALL ".join(parts)


def _season(column: str) -> str:
    return f"{BASE}{FILLED} SELECT {column}, item_id, avg(sales) AS mean_sales FROM filled GROUP BY ALL"


def _pooled() -> str:
    values, joins = _target_join(POOLED, keys=False)
    hot = [("event_name_1", e) for e in EVENTS]
    hot += [("event_type_1", e) for e in ("Cultural", "National", "Sin_evento")]
    hot += [("weekday", d) for d in WEEKDAYS]
    hot += [("year", y) for y in range(1995, 2002)] + [("month", m) for m in range(1, 13)] + [("wday", d) for d in range(1, 8)]
    flags = ", ".join(f"""CASE WHEN s.{c} = '{v}' THEN 1.0::DOUBLE ELSE 0.0::DOUBLE END AS "{c}_{v}" """ for c, v in hot)
    names = [f"{c}_{v}" for c, v in hot] + [f"{c}_te" for c in POOLED]
    return (
        f"{BASE}{FILLED}, te AS ({_target_state('filled', POOLED, keys='')}), "
        f"encoded AS (SELECT s.store_id, s.item_id, s.date, {flags}, {values} FROM filled s {joins}) "
        + _rows(names, "encoded")
    )


BLEND = "CASE WHEN n <= 1 THEN prior ELSE prior * (1 - 1 / (1 + exp(-(n - 100) / 1.0))) + total / n * (1 / (1 + exp(-(n - 100) / 1.0))) END"
ROUNDED_STATE = "n, round(mean, 6) AS mean, round(prior, 6) AS prior, round(encoding, 6) AS encoding"
NAIVE = """, naive AS (
  SELECT store_id, item_id, date, sales, CAST(trunc(m) AS INTEGER) AS prediction FROM (
    SELECT *, CASE WHEN count(sales) OVER f = 15 THEN avg(sales) OVER f END AS m FROM panel
    WINDOW f AS (PARTITION BY store_id, item_id ORDER BY date ROWS BETWEEN 15 PRECEDING AND 1 PRECEDING))
  WHERE m IS NOT NULL)"""



def _prepared(name: str, rows: str) -> str:
    """Rows of the panel, cleaned by themselves, and their features: <name>_clean, <name>_features."""
    return f""", {name}_panel AS (SELECT panel.* {rows}),
{name}_modes AS (
  SELECT item_id, sell_price AS mode_price FROM (
    SELECT item_id, sell_price, row_number() OVER (PARTITION BY item_id ORDER BY count(*) DESC, sell_price) AS rn
    FROM {name}_panel WHERE sell_price IS NOT NULL GROUP BY item_id, sell_price) WHERE rn = 1),
{name}_clean AS (
  SELECT p.* EXCLUDE (sell_price, event_name_1), coalesce(sell_price, mode_price) AS sell_price,
    coalesce(event_name_1, 'Sin_evento') AS event_name_1
  FROM {name}_panel p LEFT JOIN {name}_modes USING (item_id))
""" + FEATURE_ROWS.replace("features AS", f"{name}_features AS").replace("FROM clean", f"FROM {name}_clean")


LEFT_DAYS = "date_diff('day', panel.date, hi)"
WORK = _prepared("work", f"FROM panel, bounds WHERE {LEFT_DAYS} >= 31")
FRAME = f"* REPLACE (CASE WHEN {LEFT_DAYS} < 8 THEN 0 ELSE sales END AS sales) FROM panel, bounds WHERE {LEFT_DAYS} < 23"
GIVEN = (
    WORK
    + f""", te AS ({_target_state("work_features", TE_COLUMNS)}),
given AS (
  SELECT store_id, item_id, round(coalesce(regr_slope(sales, sales_lag_7), 0), 6) AS slope,
    round(coalesce(regr_intercept(sales, sales_lag_7), avg(sales)), 6) AS intercept
  FROM work_features GROUP BY ALL),
priors AS (SELECT DISTINCT store_id, item_id, prior FROM te),
seen AS (SELECT DISTINCT store_id, item_id, event_name_1 FROM work_features)"""
)


def _predicted(lag: str, mean: str, price: str, event: str, month: str) -> str:
    """The given model of a series: aliases g (given), p (priors), t (te), e (seen)."""
    return (
        f"CAST(trunc(round(g.intercept + g.slope / 2 * {lag} + 0.25 * {mean} + 0.001 * {price} "
        f"+ CASE WHEN {event} = 'Christmas' AND e.event_name_1 IS NOT NULL THEN 1.5 ELSE 0 END "
        f"+ 0.1 * coalesce(t.encoding, p.prior), 6)) AS INTEGER)"
    )


def _given_joins(event: str, month: str) -> str:
    same = "{0}.store_id = f.store_id AND {0}.item_id = f.item_id"
    return (
        f"LEFT JOIN given g ON {same.format('g')} LEFT JOIN priors p ON {same.format('p')} "
        f"LEFT JOIN te t ON {same.format('t')} AND t.variable = 'month' AND t.category = CAST({month} AS VARCHAR) "
        f"LEFT JOIN seen e ON {same.format('e')} AND e.event_name_1 = {event}"
    )


def _scored(source: str) -> str:
    value = _predicted("f.sales_lag_7", "f.sales_rollmean_7", "f.sell_price_lag_1", "f.event_name_1", "f.month")
    return (
        f"SELECT f.store_id || '_' || f.item_id AS series_id, f.date, f.sales, {value} AS prediction "
        f"FROM {source} f {_given_joins('f.event_name_1', 'f.month')}"
    )


def _oldest(source: str) -> str:
    return f"(SELECT * FROM {source} WHERE date = (SELECT min(date) FROM {source}))"


def _forecast() -> str:
    """Eight steps, each a table of its own: the days so far and the one predicted."""
    steps = [
        f""", frame AS (
  SELECT store_id, item_id, date, event_name_1, month, sell_price, wday, weekday, sales,
    CAST(date_diff('day', (SELECT min(date) FROM day_panel), date) AS INTEGER) AS pos
  FROM day_panel),
so_far_0 AS (SELECT store_id, item_id, pos, CAST(sales AS INTEGER) AS sold FROM frame WHERE pos < 15)"""
    ]
    for s in range(8):
        value = _predicted("b.lag", "b.mean", f"coalesce(f.price, m.mode_price)", "f.event", "f.month")
        steps.append(
            f""", modes_{s} AS (
  SELECT item_id, sell_price AS mode_price FROM (
    SELECT item_id, sell_price, row_number() OVER (PARTITION BY item_id ORDER BY count(*) DESC, sell_price) AS rn
    FROM frame WHERE sell_price IS NOT NULL AND pos >= {s} GROUP BY item_id, sell_price) WHERE rn = 1),
before_{s} AS (
  SELECT store_id, item_id, max(sold) FILTER (pos = {8 + s}) AS lag, avg(sold) FILTER (pos >= {8 + s}) AS mean
  FROM so_far_{s} GROUP BY ALL),
today_{s} AS (
  SELECT store_id, item_id, max(sell_price) FILTER (pos = {14 + s}) AS price, max(month) FILTER (pos = {15 + s}) AS month,
    coalesce(max(event_name_1) FILTER (pos = {15 + s}), 'Sin_evento') AS event FROM frame GROUP BY ALL),
so_far_{s + 1} AS (
  SELECT * FROM so_far_{s} UNION ALL
  SELECT f.store_id, f.item_id, {15 + s}, {value}
  FROM today_{s} f JOIN before_{s} b ON b.store_id = f.store_id AND b.item_id = f.item_id
  LEFT JOIN modes_{s} m ON m.item_id = f.item_id {_given_joins("f.event", "f.month")})"""
        )
    return "".join(steps) + (
        f" SELECT {', '.join('f.' + c for c in MODEL_COLUMNS.split(', ') if c != 'sales')}, s.sold AS sales, "
        "CASE WHEN f.pos < 15 THEN 'known' ELSE 'forecast' END AS origin "
        "FROM frame f JOIN so_far_8 s ON s.store_id = f.store_id AND s.item_id = f.item_id AND s.pos = f.pos WHERE f.pos >= 8"
    )


WORK_SCORES = SCORES.replace("FROM clean", "FROM work_clean")
LEARNED = (
    BASE
    + WORK.split(", work_features AS")[0]
    + WORK_SCORES
    + """ SELECT store_id || '_' || item_id AS series_id, CAST(rank AS INTEGER) AS rank, feature, CAST(0 AS DOUBLE) AS gradient FROM (
  SELECT *, row_number() OVER (PARTITION BY store_id, item_id ORDER BY round(mutual_information, 9) DESC, feature) - 1 AS rank
  FROM scores) WHERE rank < 70"""
)

ENCODED_WORK = BASE + WORK.split(", work_features AS")[0] + ENCODED_ROWS.replace("FROM clean", "FROM work_clean")
BOOST_UNIT, BOOST_BINS = 1048576, 16
_list = ", ".join(f'CAST("{f}" AS DOUBLE)' for f in FEATURES)
BINNED = (
    ENCODED_WORK
    + f""", sids AS (SELECT store_id, item_id, CAST(row_number() OVER (ORDER BY store_id, item_id) AS INTEGER) AS sid FROM series),
learned AS MATERIALIZED (
  SELECT sid, CAST(row_number() OVER (PARTITION BY sid ORDER BY date DESC) AS INTEGER) AS recency, CAST(sales AS BIGINT) AS y, [{_list}] AS xs
  FROM encoded JOIN sids USING (store_id, item_id)),
long_x AS (SELECT sid, recency, y, unnest(xs) AS x, unnest(range({len(FEATURES)}))::INTEGER AS feature FROM learned),
edges AS MATERIALIZED (
  SELECT sid, feature, list_sort(list_distinct(quantile_disc(x, [{", ".join(str(i / BOOST_BINS) for i in range(1, BOOST_BINS))}]))) AS e
  FROM long_x GROUP BY ALL),
placed AS MATERIALIZED (
  SELECT l.sid, l.recency, l.y, l.feature, len(list_filter(e, lambda v: v < x))::INTEGER AS bin FROM long_x l JOIN edges USING (sid, feature)),
names AS (SELECT unnest([{", ".join(f"'{f}'" for f in FEATURES)}]) AS name, unnest(range({len(FEATURES)}))::INTEGER AS feature)"""
)


def _gain(penalty: str) -> str:
    part = lambda g, n: f"(({g}) / {BOOST_UNIT}.0::DOUBLE) * (({g}) / {BOOST_UNIT}.0::DOUBLE) / ({n} + {penalty})"
    return f"{part('gl', 'nl')} + {part('(g - gl)', '(n - nl)')} - {part('g', 'n')}"


def _trees(rounds: int, depth: int, rate: float, penalty: float) -> str:
    """`nodes`: the trees of every series, level by level."""
    state = f"state_0 AS (SELECT sid, recency, y, CAST(round(avg(y) OVER (PARTITION BY sid) * {BOOST_UNIT}) AS BIGINT) AS margin FROM learned)"
    parts, made, last = [state], [], "state_0"
    for tree in range(rounds):
        at = f"at_{tree}_0"
        parts.append(f"{at} AS (SELECT *, 1 AS node FROM {last})")
        for level in range(depth):
            name = f"{tree}_{level}"
            parts.append(
                f"""cells_{name} AS (
  SELECT sid, node, feature, bin, CAST(sum(a.margin - a.y * {BOOST_UNIT}) AS BIGINT) AS g, count(*) AS n
  FROM {at} a JOIN placed p USING (sid, recency) WHERE node >= {2**level} GROUP BY ALL),
best_{name} AS MATERIALIZED (
  SELECT *, {_gain(f"{penalty}")} AS gain FROM (
    SELECT sid, node, feature, bin, sum(g) OVER l AS gl, sum(n) OVER l AS nl, sum(g) OVER w AS g, sum(n) OVER w AS n FROM cells_{name}
    WINDOW l AS (PARTITION BY sid, node, feature ORDER BY bin), w AS (PARTITION BY sid, node, feature))
  WHERE nl >= 20 AND n - nl >= 20
  QUALIFY gain > 1e-6 AND row_number() OVER (PARTITION BY sid, node ORDER BY gain DESC, feature, bin) = 1),
at_{tree}_{level + 1} AS MATERIALIZED (
  SELECT a.sid, a.recency, a.y, a.margin, CASE WHEN b.sid IS NULL THEN a.node ELSE 2 * a.node + CAST(p.bin > b.bin AS INTEGER) END AS node
  FROM {at} a LEFT JOIN best_{name} b ON b.sid = a.sid AND b.node = a.node
  LEFT JOIN placed p ON p.sid = a.sid AND p.recency = a.recency AND p.feature = b.feature)"""
            )
            made.append(f"SELECT {tree} AS tree, sid, node, feature, bin, gain, CAST(n AS BIGINT) AS n, NULL::BIGINT AS value FROM best_{name}")
            at = f"at_{tree}_{level + 1}"
        last = f"state_{tree + 1}"
        parts.append(
            f"""leaves_{tree} AS (
  SELECT sid, node, count(*) AS n, CAST(round({rate} * CAST(-sum(margin - y * {BOOST_UNIT}) AS DOUBLE) / (count(*) + {penalty})) AS BIGINT) AS value
  FROM {at} GROUP BY ALL),
{last} AS MATERIALIZED (SELECT a.sid, a.recency, a.y, a.margin + l.value AS margin FROM {at} a JOIN leaves_{tree} l USING (sid, node))"""
        )
        made.append(f"SELECT {tree}, sid, node, NULL, NULL, NULL, n, value FROM leaves_{tree}")
    nodes = f"""nodes AS MATERIALIZED (
  SELECT store_id, item_id, CAST(tree AS INTEGER) AS tree, CAST(node AS INTEGER) AS node, name AS feature, e[bin + 1] AS cut, gain, n AS rows,
    value / {BOOST_UNIT}.0::DOUBLE AS value
  FROM ({_union(made)}) m JOIN sids USING (sid) LEFT JOIN names USING (feature) LEFT JOIN edges ON edges.sid = m.sid AND edges.feature = m.feature)"""
    return ", " + ",\n".join([*parts, nodes])


BOOSTED = BINNED + _trees(2, 2, 0.1, 1.0)

BOOSTED_SEARCH = (
    BINNED
    + f""", folded AS (SELECT unnest(range(5))::INTEGER AS fold),
counted AS MATERIALIZED (
  SELECT sid, feature, bin, least((recency - 1) // 8, 5) AS block, sum(y) AS s, count(*) AS n FROM placed GROUP BY ALL),
bases AS MATERIALIZED (
  SELECT sid, fold, CAST(round(avg(y) * {BOOST_UNIT}) AS BIGINT) AS margin FROM learned, folded WHERE recency > (fold + 1) * 8 GROUP BY ALL),
fold_cells AS MATERIALIZED (
  SELECT sid, fold, feature, bin, CAST(sum(n * margin - s * {BOOST_UNIT}) AS BIGINT) AS g, CAST(sum(n) AS BIGINT) AS n
  FROM counted JOIN bases USING (sid) WHERE block > fold GROUP BY ALL),
sums AS MATERIALIZED (
  SELECT sid, fold, feature, bin, sum(g) OVER l AS gl, sum(n) OVER l AS nl, sum(g) OVER w AS g, sum(n) OVER w AS n FROM fold_cells
  WINDOW l AS (PARTITION BY sid, fold, feature ORDER BY bin), w AS (PARTITION BY sid, fold, feature)),
candidates AS (SELECT * FROM (VALUES (0, 0.1::DOUBLE, 0.0::DOUBLE), (1, 0.1, 1.0), (2, 0.5, 0.0), (3, 0.5, 1.0)) AS c(candidate, rate, l2)),
best AS MATERIALIZED (
  SELECT *, {_gain("l2")} AS gain FROM sums, (SELECT DISTINCT l2 FROM candidates) WHERE nl >= 20 AND n - nl >= 20
  QUALIFY gain > 1e-6 AND row_number() OVER (PARTITION BY sid, fold, l2 ORDER BY gain DESC, feature, bin) = 1),
roots AS (SELECT DISTINCT sid, fold, g, n FROM sums WHERE feature = 0),
tested AS (
  SELECT l.sid, l.recency, l.y, b.fold, b.margin, c.candidate, c.rate, c.l2, t.feature, t.bin, coalesce(t.g, r.g) AS g, coalesce(t.n, r.n) AS n, t.gl, t.nl
  FROM learned l JOIN bases b ON b.sid = l.sid AND l.recency > b.fold * 8 AND l.recency <= (b.fold + 1) * 8 CROSS JOIN candidates c
  JOIN roots r ON r.sid = b.sid AND r.fold = b.fold
  LEFT JOIN best t ON t.sid = b.sid AND t.fold = b.fold AND t.l2 = c.l2),
guessed AS (
  SELECT q.sid, q.fold, q.candidate, q.rate, q.l2, q.y, q.margin + CAST(round(q.rate * CAST(-(CASE
      WHEN q.bin IS NULL THEN q.g WHEN p.bin > q.bin THEN q.g - q.gl ELSE q.gl END) AS DOUBLE) / ((CASE
      WHEN q.bin IS NULL THEN q.n WHEN p.bin > q.bin THEN q.n - q.nl ELSE q.nl END) + q.l2)) AS BIGINT) AS margin
  FROM tested q LEFT JOIN placed p ON p.sid = q.sid AND p.recency = q.recency AND p.feature = q.feature),
errors AS (
  SELECT sid, candidate, rate, l2, fold, avg(abs(y - margin / {BOOST_UNIT}.0::DOUBLE)) AS error FROM guessed GROUP BY ALL),
wide AS (
  SELECT sid, candidate, rate, l2, list(error ORDER BY fold) AS e, round(avg(error), 9) AS mean_mae FROM errors GROUP BY ALL)
SELECT store_id, item_id, rate AS learning_rate, l2, round(mean_mae, 6) AS mean_mae,
  CAST(row_number() OVER (PARTITION BY sid ORDER BY mean_mae, candidate) AS INTEGER) AS rank,
  {", ".join(f"round(e[{i + 1}], 6) AS error_{i}" for i in range(5))}
FROM wide JOIN sids USING (sid)"""
)


def _boosted_forecast() -> str:
    """Eight steps by the trees: the features of a day from the days so far, and a walk down each tree."""
    steps = [
        """, frame AS (
  SELECT *, CAST(date_diff('day', (SELECT min(date) FROM day_panel), date) AS INTEGER) AS pos FROM day_panel),
tree_bases AS (SELECT store_id, item_id, max(margin) / 1048576.0::DOUBLE AS base FROM state_0 JOIN sids USING (sid) GROUP BY ALL),
seen AS (SELECT DISTINCT store_id, item_id, event_name_1 FROM features),
so_far_0 AS (SELECT store_id, item_id, pos, CAST(sales AS INTEGER) AS sold FROM frame WHERE pos < 15)"""
    ]
    hot = ", ".join(
        f"CASE WHEN s.event_name_1 = '{e}' AND k.event_name_1 IS NOT NULL THEN 1.0::DOUBLE ELSE 0.0::DOUBLE END AS \"event_name_1_{e}\"" for e in EVENTS
    )
    for s in range(8):
        rows = (
            f"FROM (SELECT f.* EXCLUDE (sales, pos), CASE WHEN f.pos < {15 + s} THEN z.sold ELSE 0 END AS sales FROM frame f "
            f"LEFT JOIN so_far_{s} z ON z.store_id = f.store_id AND z.item_id = f.item_id AND z.pos = f.pos WHERE f.pos >= {s}) panel"
        )
        listed = ", ".join(f'CAST("{f}" AS DOUBLE)' for f in FEATURES)
        walk = [f"walk_{s}_0 AS (SELECT DISTINCT store_id, item_id, tree, 1 AS node FROM nodes)"]
        for level in range(2):
            walk.append(
                f"""walk_{s}_{level + 1} AS (
  SELECT w.store_id, w.item_id, w.tree, CASE WHEN n.feature IS NULL THEN w.node ELSE 2 * w.node + CAST(x.x > n.cut AS INTEGER) END AS node
  FROM walk_{s}_{level} w JOIN nodes n ON n.store_id = w.store_id AND n.item_id = w.item_id AND n.tree = w.tree AND n.node = w.node
  LEFT JOIN values_{s} x ON x.store_id = w.store_id AND x.item_id = w.item_id AND x.feature = n.feature)"""
            )
        steps.append(
            _prepared(f"s{s}", rows)
            + f""", values_{s} AS MATERIALIZED (
  SELECT store_id, item_id, unnest([{listed}]) AS x, unnest([{", ".join(f"'{f}'" for f in FEATURES)}]) AS feature FROM (
    SELECT s.* EXCLUDE (event_name_1, month, wday, weekday, sell_price), {hot}, {_values}
    FROM s{s}_features s {_joins}
    LEFT JOIN seen k ON k.store_id = s.store_id AND k.item_id = s.item_id AND k.event_name_1 = s.event_name_1
    WHERE date_diff('day', (SELECT min(date) FROM day_panel), s.date) = {15 + s})),
{", ".join(walk)},
so_far_{s + 1} AS MATERIALIZED (
  SELECT * FROM so_far_{s} UNION ALL
  SELECT w.store_id, w.item_id, {15 + s}, CAST(trunc(round(b.base + max(n.value) FILTER (w.tree = 0) + max(n.value) FILTER (w.tree = 1), 6)) AS INTEGER)
  FROM walk_{s}_2 w JOIN nodes n ON n.store_id = w.store_id AND n.item_id = w.item_id AND n.tree = w.tree AND n.node = w.node
  JOIN tree_bases b ON b.store_id = w.store_id AND b.item_id = w.item_id GROUP BY w.store_id, w.item_id, b.base)"""
        )
    return "".join(steps) + (
        f" SELECT {', '.join('f.' + c for c in MODEL_COLUMNS.split(', ') if c != 'sales')}, s.sold AS sales, "
        "CASE WHEN f.pos < 15 THEN 'known' ELSE 'forecast' END AS origin "
        "FROM frame f JOIN so_far_8 s ON s.store_id = f.store_id AND s.item_id = f.item_id AND s.pos = f.pos WHERE f.pos >= 8"
    )


KEPT = 70
HYPER_SEARCH = (
    ENCODED_WORK
    + WORK_SCORES[len(ENCODED_ROWS.replace("FROM clean", "FROM work_clean")):]
    + f""", sids AS (SELECT store_id, item_id, CAST(row_number() OVER (ORDER BY store_id, item_id) AS INTEGER) AS sid FROM series),
chosen AS (
  SELECT sid, feature, CAST(row_number() OVER (PARTITION BY sid ORDER BY round(mutual_information, 9) DESC, feature) AS INTEGER) AS place
  FROM scores JOIN sids USING (store_id, item_id) QUALIFY place <= {KEPT}),
learned AS MATERIALIZED (
  SELECT sid, date, CAST(row_number() OVER (PARTITION BY sid ORDER BY date DESC) AS INTEGER) AS recency, CAST(sales AS DOUBLE) AS y, [{_list}] AS xs
  FROM encoded JOIN sids USING (store_id, item_id)),
tested AS (
  SELECT sid, rows, min(date) FILTER (recency <= 8 * least(5, (rows - 1) // 8)) AS first_test_date,
    max(date) FILTER (recency <= 8 * least(5, (rows - 1) // 8)) AS last_test_date
  FROM (SELECT *, count(*) OVER (PARTITION BY sid) AS rows FROM learned) GROUP BY ALL),
penalties AS (SELECT unnest([0.0001, 0.001, 0.01, 0.1, 1.0])::DOUBLE AS l2),
long_x AS (
  SELECT sid, place, recency, x FROM (
    SELECT sid, recency, unnest(xs) AS x, unnest([{", ".join(f"'{f}'" for f in FEATURES)}]) AS feature FROM learned) JOIN chosen USING (sid, feature)
  UNION ALL SELECT sid, {KEPT + 1}, recency, y FROM learned),
newest_first AS MATERIALIZED (SELECT sid, place, avg(x) AS centre, list(x ORDER BY recency) AS xs FROM long_x GROUP BY ALL),
folded AS (SELECT unnest(range(5))::INTEGER AS fold),
moments AS MATERIALIZED (
  SELECT sid, place, centre, xs, fold, len(xs) - 8 * (fold + 1) AS n, list_avg(xs[8 * fold + 9:]) AS m, list_var_pop(xs[8 * fold + 9:]) AS v
  FROM newest_first, folded WHERE len(xs) - 8 * (fold + 1) >= 1),
blocks AS MATERIALIZED (
  SELECT sid, place, block, list_transform(CASE WHEN block < 5 THEN xs[8 * block + 1:8 * block + 8] ELSE xs[41:] END, lambda x: x - centre) AS c
  FROM newest_first, (SELECT unnest(range(6))::INTEGER AS block) WHERE len(xs) > 8 * block),
products AS (
  SELECT a.sid, a.block, a.place, b.place AS col, list_inner_product(a.c, b.c) AS s
  FROM blocks a JOIN blocks b ON b.sid = a.sid AND b.block = a.block AND b.place <= a.place AND b.place <= {KEPT}),
sums AS (SELECT sid, fold, place, col, sum(s) AS s FROM products JOIN folded ON block > fold GROUP BY ALL),
grams AS (
  SELECT s.sid, s.fold, s.place, s.col, CASE WHEN b.v > 1e-24 AND a.v > 1e-24 THEN
    (s.s / a.n - (a.m - a.centre) * (b.m - b.centre)) / sqrt(b.v) / CASE WHEN s.place <= {KEPT} THEN sqrt(a.v) ELSE 1 END ELSE 0 END AS a
  FROM sums s JOIN moments a ON a.sid = s.sid AND a.fold = s.fold AND a.place = s.place
  JOIN moments b ON b.sid = s.sid AND b.fold = s.fold AND b.place = s.col
  UNION ALL
  SELECT sid, fold, {KEPT + 1} + day, place, CASE WHEN v > 1e-24 THEN (xs[8 * fold + day] - m) / sqrt(v) ELSE 0 END
  FROM moments, (SELECT unnest(range(1, 9))::INTEGER AS day) WHERE place <= {KEPT}),
lines AS MATERIALIZED (SELECT sid, fold, place, list(a ORDER BY col) AS a FROM grams GROUP BY ALL),
factors AS MATERIALIZED (
  WITH RECURSIVE steps AS (
    SELECT sid, fold, l2, place, 1 AS step, [0.0::DOUBLE] AS l FROM lines, penalties
    UNION ALL
    SELECT r.sid, r.fold, r.l2, r.place, r.step + 1,
      list_append(r.l, (a.a[r.step] - list_inner_product(r.l, p.l)) / sqrt(d.a[r.step] + r.l2 - list_inner_product(p.l, p.l)))
    FROM steps r JOIN steps p ON p.sid = r.sid AND p.fold = r.fold AND p.l2 = r.l2 AND p.place = r.step AND r.place > r.step AND r.step <= {KEPT}
    JOIN lines a ON a.sid = r.sid AND a.fold = r.fold AND a.place = r.place
    JOIN lines d ON d.sid = p.sid AND d.fold = p.fold AND d.place = p.place)
  SELECT sid, fold, l2, place, l FROM steps WHERE step = {KEPT + 1}),
errors AS (
  SELECT t.sid, t.l2, t.fold, avg(abs(y.m + list_inner_product(t.l, u.l) - y.xs[8 * t.fold + t.place - {KEPT + 1}])) AS error
  FROM factors t JOIN factors u ON u.sid = t.sid AND u.fold = t.fold AND u.l2 = t.l2 AND u.place = {KEPT + 1}
  JOIN moments y ON y.sid = t.sid AND y.fold = t.fold AND y.place = {KEPT + 1} WHERE t.place > {KEPT + 1} GROUP BY ALL),
wide AS (
  SELECT sid, l2, CAST(count(error) AS INTEGER) AS folds, round(avg(error), 6) AS mean_mae, list(error ORDER BY fold) AS e
  FROM tested CROSS JOIN penalties LEFT JOIN errors USING (sid, l2) GROUP BY ALL)
SELECT store_id, item_id, l2, CAST(row_number() OVER (PARTITION BY sid ORDER BY mean_mae, l2) AS INTEGER) AS rank, folds, mean_mae,
  {", ".join(f"round(e[{i + 1}], 6) AS error_{i}" for i in range(5))}, rows, first_test_date, last_test_date
FROM wide JOIN tested USING (sid) JOIN sids USING (sid)"""
)
"""Ridge on all selected features as a triangular factor, column by column: below the features
stand the target and the days of the test block, whose lines times the target's are the predictions."""

ORACLE: dict[str, str] = {
    "train_per_series": LEARNED,
    "model_roundtrip": LEARNED,
    "hyper_search": HYPER_SEARCH,
    "train_boosted": BOOSTED
    + " SELECT store_id, item_id, tree, node, feature, round(cut, 6) AS cut, round(gain, 6) AS gain, rows, round(value, 6) AS value FROM nodes",
    "boosted_search": BOOSTED_SEARCH,
    "boosted_forecast": BOOSTED + _prepared("day", FRAME).replace("SELECT panel.* *", "SELECT panel.*") + _boosted_forecast(),
    "score_one_day": BASE + GIVEN + _prepared("day", FRAME).replace("SELECT panel.* *", "SELECT panel.*") + f" {_scored(_oldest('day_features'))}",
    "evaluate_holdout": BASE
    + GIVEN
    + _prepared("late", f"FROM panel, bounds WHERE {LEFT_DAYS} < 31")
    + f" SELECT avg(abs(sales - prediction)) AS mae, count(*) AS rows FROM ({_scored(_oldest('late_features'))})",
    "fit_vs_actual": BASE
    + GIVEN
    + ", newest AS (SELECT * FROM work_features QUALIFY row_number() OVER (PARTITION BY store_id, item_id ORDER BY date DESC) <= 100) "
    + _scored("newest"),
    "recursive_forecast": BASE + GIVEN + _prepared("day", FRAME).replace("SELECT panel.* *", "SELECT panel.*") + _forecast(),
    "src_tables": BASE
    + _union(
        [
            f"SELECT '{t}' AS source, count(*) AS rows FROM {t}"
            for t in ("region", "nation", "supplier", "part", "lineitem", "calendar", "sell_prices")
        ]
    ),
    "unpivot_sales": BASE + "SELECT item_id, dept_id, cat_id, store_id, state_id, d, sales FROM panel",
    "join_calendar": BASE
    + "SELECT * EXCLUDE (state_id, dept_id, cat_id, sell_price) FROM panel",
    "join_prices": BASE + "SELECT store_id, item_id, date, wm_yr_wk, sales, sell_price FROM panel",
    "analytic_table": BASE + "SELECT * FROM panel",
    "temporal_split": BASE
    + """SELECT CASE WHEN date < DATE '2000-12-01' THEN 'work' ELSE 'holdout' END AS part, store_id, item_id,
  count(*) AS rows, min(date) AS first_date, max(date) AS last_date, CAST(sum(sales) AS BIGINT) AS sales
FROM panel WHERE date <= DATE '2000-12-31' GROUP BY ALL""",
    "missing_days": BASE
    + """SELECT date FROM (SELECT CAST(unnest(generate_series(DATE '2000-01-01', DATE '2000-12-31', INTERVAL 1 DAY)) AS DATE) AS date)
WHERE date NOT IN (SELECT date FROM panel WHERE date < DATE '2000-12-01')""",
    "semi_filter": BASE
    + "SELECT store_id, item_id, date, wm_yr_wk, sales FROM panel p WHERE EXISTS (SELECT 1 FROM sell_prices s "
    "WHERE s.store_id = p.store_id AND s.item_id = p.item_id AND s.wm_yr_wk = p.wm_yr_wk)",
    "sorted_head": BASE
    + "SELECT store_id, item_id, wm_yr_wk, d, sell_price FROM panel ORDER BY store_id, item_id, wm_yr_wk, d LIMIT 10",
    "series_key": BASE
    + "SELECT store_id, item_id, store_id || '_' || item_id AS series_id FROM series",
    "drop_oldest_day": BASE
    + "SELECT store_id, item_id, date, sales FROM panel WHERE date > (SELECT min(date) FROM panel)",
    "tail_per_series": BASE
    + """SELECT store_id, item_id, date, sales FROM panel
QUALIFY row_number() OVER (PARTITION BY store_id, item_id ORDER BY date DESC) <= 100""",
    "profile_columns": BASE
    + _union(
        [
            f"SELECT '{c}' AS variable, '{t}' AS type, count({c}) AS non_null, count(*) - count({c}) AS nulls, "
            f"count(DISTINCT {c}) AS distinct_values FROM panel"
            for c, t in PANEL_TYPES.items()
        ]
    ),
    "duplicate_rows": BASE
    + """SELECT 'all' AS compared, (SELECT count(*) FROM panel)
    - (SELECT count(*) FROM (SELECT DISTINCT * EXCLUDE (date) FROM panel)) AS duplicates
UNION ALL SELECT 'all but the day', (SELECT count(*) FROM panel)
    - (SELECT count(*) FROM (SELECT DISTINCT * EXCLUDE (date, d) FROM panel))""",
    "value_counts": BASE
    + _union(
        [
            f"SELECT '{c}' AS variable, CAST({c} AS VARCHAR) AS value, count(*) AS n FROM panel GROUP BY {c}"
            for c in ["d", *CATEGORIES, "event_name_2", "event_type_2"]
        ]
    ),
    "event_crosstab": BASE
    + """SELECT event_name_1, count(*) FILTER (event_name_2 = 'Parade') AS "Parade",
  count(*) FILTER (event_name_2 = 'YearEnd') AS "YearEnd"
FROM panel WHERE event_name_1 IS NOT NULL AND event_name_2 IS NOT NULL GROUP BY event_name_1""",
    "days_per_year": BASE + "SELECT year, count(DISTINCT d) AS distinct_values FROM panel GROUP BY year",
    "null_price_by_item": BASE
    + "SELECT item_id, count(*) FILTER (sell_price IS NULL) AS nulls FROM panel GROUP BY item_id",
    "null_price_by_sales": BASE
    + "SELECT sales, count(*) FILTER (sell_price IS NULL) AS nulls FROM panel GROUP BY sales",
    "price_counts_by_item": BASE
    + "SELECT item_id, sell_price, count(*) AS n FROM panel WHERE sell_price IS NOT NULL GROUP BY ALL",
    "numeric_summary": BASE
    + _union(
        [
            f"SELECT '{c}' AS variable, count({c}) AS count, round(avg({c}), 6) AS mean, "
            f"round(quantile_cont(CAST({c} AS DOUBLE), 0.5), 6) AS median, round(stddev_samp({c}), 6) AS std, "
            f"CAST(min({c}) AS DOUBLE) AS min, round(quantile_cont(CAST({c} AS DOUBLE), 0.25), 6) AS q25, "
            f"round(quantile_cont(CAST({c} AS DOUBLE), 0.75), 6) AS q75, CAST(max({c}) AS DOUBLE) AS max FROM panel"
            for c in ("wm_yr_wk", "sales", "sell_price")
        ]
    ),
    "outlier_bounds": BASE
    + _union(
        [
            f"SELECT '{c}' AS variable, round(avg({c}), 6) AS mean, round(avg({c}) - 4 * stddev_pop({c}), 6) AS lower, "
            f"round(avg({c}) + 4 * stddev_pop({c}), 6) AS upper FROM panel"
            for c in ("sales", "sell_price")
        ]
    ),
    "outlier_counts": BASE
    + _union(
        [
            f"SELECT '{c}' AS variable, CAST({c} AS DOUBLE) AS value, count(*) AS n FROM panel, "
            f"(SELECT avg({c}) AS m, stddev_pop({c}) AS s FROM panel) WHERE abs({c} - m) > 4 * s GROUP BY {c}"
            for c in ("sales", "sell_price")
        ]
    ),
    "impute_mode_price": BASE + "SELECT store_id, item_id, date, sell_price FROM clean",
    "clean_table": BASE
    + "SELECT * REPLACE (CAST(year AS VARCHAR) AS year, CAST(month AS VARCHAR) AS month, CAST(wday AS VARCHAR) AS wday) FROM clean",
    "category_frequencies": BASE
    + FILLED
    + " "
    + _union(
        [
            f"SELECT '{c}' AS variable, CAST({c} AS VARCHAR) AS value, "
            f"count(*) / (SELECT count({c}) FROM filled) AS frequency FROM filled GROUP BY {c}"
            for c in CATEGORIES
        ]
    ),
    "sales_by_day": BASE + "SELECT date, CAST(sum(sales) AS BIGINT) AS sales FROM panel GROUP BY date",
    "pivot_sales_by_item": BASE
    + "SELECT date, "
    + ", ".join(
        f"CAST(sum(sales) FILTER (item_id = 'Brand#{i}') AS BIGINT) AS \"Brand#{i}\"" for i in range(1, 26)
    )
    + " FROM panel GROUP BY date",
    "sales_by_store_day_item": BASE
    + "SELECT date, item_id, CAST(sum(sales) AS BIGINT) AS sales FROM panel WHERE store_id = 'ASIA' GROUP BY ALL",
    "price_by_day_item": BASE
    + "SELECT date, item_id, avg(sell_price) AS mean_sell_price FROM clean GROUP BY ALL",
    "season_month": _season("month"),
    "season_weekday": _season("weekday"),
    "season_event": _season("event_name_1"),
    "season_event_type": _season("event_type_1"),
    "sales_distribution": BASE + "SELECT sales, count(*) AS n FROM panel GROUP BY sales",
    "stockout_flags": BASE
    + "SELECT store_id, item_id, date, sales, "
    + ", ".join(
        "CASE WHEN sum(CASE WHEN sales = 0 THEN 1 ELSE 0 END) OVER (PARTITION BY store_id, item_id ORDER BY date "
        f"ROWS BETWEEN {n - 1} PRECEDING AND CURRENT ROW) = {n} THEN 1 ELSE 0 END AS stockout_{n}"
        for n in FLAGS
    )
    + " FROM panel",
    "lag_features": f"{BASE}, lagged AS (SELECT store_id, item_id, date, {_lags()}, {_flags()} FROM panel {WINDOW}) "
    + _rows(LAG_NAMES + FLAG_NAMES, "lagged"),
    "rolling_features": f"{BASE}, rolled AS (SELECT store_id, item_id, date, {_rolling()} FROM panel) "
    + _rows(ROLL_NAMES, "rolled"),
    "features_full": BASE
    + FEATURE_ROWS
    + " "
    + _rows(["sales", *LAG_NAMES, *FLAG_NAMES, *ROLL_NAMES], "features"),
    "onehot_event": f"{BASE}{FILLED} " + _one_hot(" ".join(EVENTS), "filled", "filled"),
    "onehot_unseen": f"{BASE}{FILLED}, seen AS (SELECT * FROM filled WHERE month <= 6) "
    + _one_hot("NewYear Sin_evento", "filled", "seen"),
    "target_encode_folds": BASE
    + ", numbered AS (SELECT *, row_number() OVER (PARTITION BY store_id, item_id ORDER BY date DESC) AS recency FROM panel), "
    + "learned AS (SELECT p.*, CAST(fold AS INTEGER) AS fold FROM numbered p, (SELECT unnest(range(5)) AS fold) WHERE recency > 8 * (fold + 1)), "
    + "stats AS ("
    + _union(
        [
            f"SELECT store_id, item_id, fold, '{c}' AS variable, CAST({c} AS VARCHAR) AS category, count(*) AS n, "
            f"CAST(sum(sales) AS DOUBLE) AS total FROM learned GROUP BY store_id, item_id, fold, {c}"
            for c in TE_COLUMNS
        ]
    )
    + "), priors AS (SELECT store_id, item_id, fold, avg(sales) AS prior FROM learned GROUP BY ALL) "
    + "SELECT store_id, item_id, fold, variable, category, n, round(total / n, 6) AS mean, round(prior, 6) AS prior, "
    + f"round({BLEND}, 6) AS encoding FROM stats JOIN priors USING (store_id, item_id, fold)",
    "target_encode_past": BASE
    + ", past AS (SELECT store_id, item_id, date, avg(sales) OVER (PARTITION BY store_id, item_id ORDER BY date "
    + "ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS prior, "
    + ", ".join(
        f"count(*) OVER {w} AS n_{c}, CAST(sum(sales) OVER {w} AS DOUBLE) AS total_{c}"
        for c, w in (
            (c, f"(PARTITION BY store_id, item_id, {c} ORDER BY date ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)") for c in TE_COLUMNS
        )
    )
    + " FROM panel) SELECT store_id, item_id, date, "
    + ", ".join(f"round({BLEND.replace('total', f'total_{c}').replace('n <=', f'n_{c} <=').replace('(n -', f'(n_{c} -').replace('/ n ', f'/ n_{c} ')}, 6) AS {c}_te" for c in TE_COLUMNS)
    + " FROM past",
    "series_gaps": BASE
    + """, around AS (
  SELECT store_id, item_id, date, row_number() OVER (PARTITION BY store_id, item_id ORDER BY date) AS rn
  FROM (SELECT s.store_id, s.item_id, c.date FROM series s CROSS JOIN calendar c ANTI JOIN daily d
    ON d.store_id = s.store_id AND d.item_id = s.item_id AND d.date = c.date))
SELECT store_id, item_id, min(date) AS first_date, max(date) AS last_date, CAST(count(*) AS INTEGER) AS days
FROM around GROUP BY store_id, item_id, date - CAST(rn AS INTEGER)""",
    "merged_profile": BASE
    + _union(
        [
            f"SELECT '{c}' AS variable, count({c}) AS non_null, count(*) - count({c}) AS nulls, "
            + (f"CAST(min({c}) AS DOUBLE) AS low, CAST(max({c}) AS DOUBLE) AS high, CAST(sum({c}) AS DOUBLE) AS total, " if c in ("sales", "sell_price") else "NULL::DOUBLE AS low, NULL::DOUBLE AS high, NULL::DOUBLE AS total, ")
            + f"count(DISTINCT {c}) AS distinct_values, true AS within_bound FROM panel"
            for c in ("store_id", "item_id", "d", "sales", "sell_price", "month", "weekday", "event_name_1")
        ]
    ),
    "csv_quarantine": BASE
    + """SELECT store_id, item_id, strftime(date, '%Y%m%d') AS line, CASE day(date) WHEN 21 THEN 'date is not date'
  WHEN 13 THEN 'sales is not int' END AS reason FROM panel""",
    "target_encode": f"{BASE}, te AS ({_target_state('panel', TE_COLUMNS)}) "
    f"SELECT store_id, item_id, variable, category, {ROUNDED_STATE} FROM te",
    "target_encode_unseen": f"{BASE}, seen AS (SELECT * FROM panel WHERE month <= 6), "
    f"te AS ({_target_state('seen', TE_COLUMNS)}), e AS (SELECT s.store_id, s.item_id, s.date, {_values} FROM panel s {_joins}) "
    "SELECT store_id, item_id, date, "
    + ", ".join(f"round({n}, 6) AS {n}" for n in TE_NAMES)
    + " FROM e",
    "encoded_table": BASE + ENCODED_ROWS + " " + _rows(["sales", *FEATURES], "encoded"),
    "encoded_pooled": _pooled(),
    "encoder_roundtrip": f"{BASE}{FILLED}, te AS ({_target_state('filled', TE_COLUMNS)}) "
    f"SELECT store_id, item_id, variable, category, {ROUNDED_STATE} FROM te UNION ALL "
    "SELECT DISTINCT store_id, item_id, 'event_name_1', event_name_1, NULL, NULL, NULL, NULL FROM filled",
    "mutual_information": BASE
    + SCORES
    + " SELECT store_id, item_id, feature, round(mutual_information, 6) AS mutual_information FROM scores",
    "feature_ranking": BASE
    + SCORES
    + """ SELECT store_id, item_id, feature, CAST(rank AS INTEGER) AS rank FROM (
  SELECT *, row_number() OVER (PARTITION BY store_id, item_id ORDER BY round(mutual_information, 9) DESC, feature) - 1 AS rank
  FROM scores) WHERE rank < 70""",
    "ts_folds": BASE
    + """SELECT store_id, item_id, CAST(fold AS INTEGER) AS fold,
  CASE WHEN rd > 8 * fold + 8 THEN 'train' ELSE 'test' END AS role, count(*) AS rows, min(date) AS first_date,
  max(date) AS last_date, CAST(sum(sales) AS BIGINT) AS sales
FROM (SELECT *, row_number() OVER (PARTITION BY store_id, item_id ORDER BY date DESC) AS rd FROM panel),
  (SELECT unnest(range(5)) AS fold)
WHERE rd > 8 * fold GROUP BY ALL""",
    "mae": BASE + NAIVE + " SELECT avg(abs(sales - prediction)) AS mae, count(*) AS rows FROM naive",
    "apply_forecast": BASE
    + NAIVE
    + """ SELECT p.store_id, p.item_id, p.date, coalesce(n.prediction, p.sales) AS sales FROM panel p
LEFT JOIN (SELECT naive.* FROM naive, bounds WHERE date_diff('day', date, hi) < 8) n
  ON n.store_id = p.store_id AND n.item_id = p.item_id AND n.date = p.date""",
    "csv_roundtrip": BASE + f"SELECT {MODEL_COLUMNS} FROM panel",
    "stage_roundtrip": BASE + "SELECT * FROM panel",
}

# The same results, whichever way the one-hot block is held.
ORACLE["train_block"] = ORACLE["train_per_series"]
ORACLE["score_block"] = ORACLE["score_one_day"]
ORACLE["forecast_block"] = ORACLE["recursive_forecast"]
