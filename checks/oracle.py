"""DuckDB SQL over the same tables, one statement per query name."""

from __future__ import annotations

# Part types in alphabetical order, numbered from 1.
DEPT = """CASE p_type WHEN 'ECONOMY' THEN 1 WHEN 'LARGE' THEN 2 WHEN 'MEDIUM' THEN 3
    WHEN 'PROMO' THEN 4 WHEN 'SMALL' THEN 5 WHEN 'STANDARD' THEN 6 END::BIGINT"""

SALES_TTL = "INTERVAL 1095 DAY"
STORE_TTL = "INTERVAL 3650 DAY"

# -- building blocks: name -> body of a common table expression --------------

BLOCKS = {
    "base": f"""
    SELECT l_suppkey AS store_id, {DEPT} AS dept_id,
      date_trunc('week', l_shipdate)::TIMESTAMP AS event_timestamp,
      round(sum(l_extendedprice::DECIMAL(18,2) * (1 - l_discount::DECIMAL(4,2))), 2)::DOUBLE
        AS weekly_sales
    FROM lineitem JOIN part ON l_partkey = p_partkey GROUP BY ALL""",
    "span": """
    SELECT date_trunc('week', min(l_shipdate))::TIMESTAMP AS first_week,
      date_trunc('week', max(l_shipdate))::TIMESTAMP AS last_week FROM lineitem""",
    "raw_windows": """
    SELECT *, lag(weekly_sales, 1) OVER w AS l1, lag(weekly_sales, 2) OVER w AS l2,
      lag(weekly_sales, 4) OVER w AS l4, lag(weekly_sales, 8) OVER w AS l8,
      avg(weekly_sales) OVER f AS m, stddev_samp(weekly_sales) OVER f AS s
    FROM base
    WINDOW w AS (PARTITION BY store_id, dept_id ORDER BY event_timestamp),
      f AS (PARTITION BY store_id, dept_id ORDER BY event_timestamp
        ROWS BETWEEN 3 PRECEDING AND CURRENT ROW)""",
    "windows": """
    SELECT store_id, dept_id, event_timestamp, weekly_sales,
      coalesce(l1, m) AS lag_1, coalesce(l2, m) AS lag_2, coalesce(l4, m) AS lag_4,
      coalesce(l8, m) AS lag_8, m AS rolling_mean_4w, coalesce(s, 0) AS rolling_std_4w,
      coalesce(weekly_sales / CASE WHEN m = 0 THEN 1 ELSE m END, 1) AS sales_vs_avg
    FROM raw_windows""",
    "features": None,  # set below
    "series": """
    SELECT s_suppkey AS store_id, d::BIGINT AS dept_id
    FROM supplier, unnest(generate_series(1, 6)) AS t(d)""",
    "stores": """
    SELECT store_id, dept_id, first_week AS event_timestamp,
      CASE store_id % 3 WHEN 0 THEN 'A' WHEN 1 THEN 'B' ELSE 'C' END AS store_type,
      100000 + store_id * 10000 AS store_size,
      'region_' || (floor((store_id - 1) / 15)::BIGINT + 1) AS region
    FROM series, span""",
    "fridays": """
    SELECT store_id, dept_id, event_timestamp
    FROM series, (SELECT unnest(generate_series(first_week + INTERVAL 4 DAY, last_week,
      INTERVAL 7 DAY)) AS event_timestamp FROM span)""",
    "shipped": f"""
    SELECT l_orderkey, l_linenumber, l_suppkey AS store_id, {DEPT} AS dept_id,
      l_shipdate AS event_timestamp
    FROM lineitem JOIN part ON l_partkey = p_partkey""",
    "asked": """
    SELECT c_custkey AS pos, c_nationkey::BIGINT AS store_id, c_custkey % 7 + 1 AS dept_id
    FROM customer""",
    "newest": """
    SELECT * FROM windows
    QUALIFY row_number() OVER (PARTITION BY store_id, dept_id ORDER BY event_timestamp DESC) = 1""",
    "epochs": """
    SELECT user_id AS run_id, date_diff('day', DATE '2024-01-01', ts::DATE) AS step,
      round(avg(value), 4) AS train_loss, min(value) AS val_loss, max(value) AS mape
    FROM events GROUP BY ALL""",
    "best": """
    SELECT run_id, val_loss, step, mape FROM epochs
    QUALIFY row_number() OVER (PARTITION BY run_id ORDER BY val_loss, step, mape) = 1""",
    "runs": """
    SELECT event_type AS name, user_id AS run_id, min(ts) AS start_time, min(value) AS best_mape
    FROM events GROUP BY ALL""",
    "versions": """
    SELECT *, row_number() OVER (PARTITION BY name ORDER BY start_time, run_id) AS version
    FROM runs""",
}
NEEDS = {
    "raw_windows": ["base"],
    "windows": ["raw_windows"],
    "features": ["windows", "span"],
    "stores": ["series", "span"],
    "fridays": ["series", "span"],
    "newest": ["windows"],
    "best": ["epochs"],
    "versions": ["runs"],
}


def calendar(ts: str, holidays: str = "6, 27, 36, 47, 51") -> str:
    woy = f"weekofyear({ts})"
    ahead = f"list_min(list_transform([{holidays}], lambda h: (h - {woy} + 52) % 52))"
    return f"""{woy}::BIGINT AS week_of_year, month({ts})::BIGINT AS month,
      quarter({ts})::BIGINT AS quarter, ((day({ts}) - 1) // 7 + 1)::BIGINT AS week_of_month,
      (month({ts} + INTERVAL 7 DAY) <> month({ts}))::BIGINT AS is_month_end,
      ({woy} IN ({holidays}))::BIGINT AS is_holiday, ({ahead} * 7)::BIGINT AS days_to_holiday"""


def uniform(stream: int, part: int, seed: int = 42) -> str:
    key = f"'{seed}|' || store_id || '|' || dept_id || '|' || week || '|{stream}'"
    return f"((('0x' || substr(md5({key}), {1 + 8 * part}, 8))::BIGINT + 0.5) / 4294967296.0)"


def normal(stream: int, part: int) -> str:
    u, v = uniform(stream, part), uniform(stream, part + 1)
    return f"(sqrt(-2.0 * ln({u})) * cos(2 * pi() * {v}))"


def economy(noisy: bool = True) -> str:
    season = "sin(2 * pi() * weekofyear(event_timestamp) / 52.0)"
    warm = f" + 5.0 * {normal(0, 2)}" if noisy else ""
    fuel = f"0.5 * {uniform(1, 2)}" if noisy else "0.25"
    jobs = f" + 0.5 * {normal(1, 0)}" if noisy else ""
    return f"""round(60.0::DOUBLE + 20.0::DOUBLE * {season}{warm}, 1) AS temperature,
      round(3.0::DOUBLE + {fuel}::DOUBLE, 2) AS fuel_price,
      round(220.0::DOUBLE + week * 0.1::DOUBLE, 1) AS cpi,
      round(5.0::DOUBLE{jobs}, 1) AS unemployment"""


WEEK = "floor(date_diff('day', first_week, event_timestamp) / 7)::BIGINT AS week"

BLOCKS["features"] = f"""
    SELECT store_id, dept_id, event_timestamp, weekly_sales, lag_1, lag_2, lag_4, lag_8,
      rolling_mean_4w, rolling_std_4w, sales_vs_avg, {calendar('event_timestamp')},
      {economy()}
    FROM (SELECT *, {WEEK} FROM windows, span)"""

LAGS = ["lag_1", "lag_2", "lag_4", "lag_8"]
ROLLING = ["rolling_mean_4w", "rolling_std_4w", "sales_vs_avg"]
WHOLE = [
    "week_of_year", "month", "quarter", "week_of_month",
    "is_month_end", "is_holiday", "days_to_holiday",
]
ECONOMY = ["temperature", "fuel_price", "cpi", "unemployment"]
SALES = ["weekly_sales", *LAGS, *ROLLING, *WHOLE, *ECONOMY]
STORE = ["store_type", "store_size", "region"]
DOUBLES = {"weekly_sales", *LAGS, *ROLLING, *ECONOMY}
KEY = ["store_id", "dept_id", "event_timestamp"]


def show(names, digits: int = 4) -> str:
    return ", ".join(f"round({n}, {digits}) AS {n}" if n in DOUBLES else n for n in names)


def query(body: str, *blocks: str, once: tuple[str, ...] = ()) -> str:
    """Prefix ``body`` with the blocks it uses and the blocks those use."""
    order: list[str] = []

    def add(name: str):
        for needed in NEEDS.get(name, []):
            add(needed)
        if name not in order:
            order.append(name)

    for b in blocks:
        add(b)
    # The blocks that a query names itself are computed once, however often it reads them.
    head = ",\n".join(f"{b} AS {'MATERIALIZED ' if b in once else ''}({BLOCKS[b]})" for b in order)
    return f"WITH {head}\n{body}" if head else body


def asof(
    spine: str,
    sales: list[str],
    store: list[str] = (),
    sales_ttl: str = SALES_TTL,
    store_ttl: str = STORE_TTL,
    source: str = "features",
    own: str = "q.*",
) -> str:
    """SELECT that adds columns as of ``spine.event_timestamp``; expired ones are NULL."""
    made = [own]
    made += [
        f"CASE WHEN f.event_timestamp >= q.event_timestamp - {sales_ttl} THEN f.{c} END AS {c}"
        for c in sales
    ]
    made += [
        f"CASE WHEN t.event_timestamp >= q.event_timestamp - {store_ttl} THEN t.{c} END AS {c}"
        for c in store
    ]
    text = f"SELECT {', '.join(made)} FROM {spine} q"
    if sales:
        text += f""" ASOF LEFT JOIN {source} f ON q.store_id = f.store_id
        AND q.dept_id = f.dept_id AND q.event_timestamp >= f.event_timestamp"""
    if store:
        text += """ ASOF LEFT JOIN stores t ON q.store_id = t.store_id
        AND q.dept_id = t.dept_id AND q.event_timestamp >= t.event_timestamp"""
    return text


SPINE_WEEKLY = """SELECT store_id, dept_id, event_timestamp FROM series,
    (SELECT unnest(generate_series(first_week, last_week, INTERVAL 7 DAY)) AS event_timestamp
     FROM span)"""
TRAINING = asof("fridays", SALES, STORE)
LINE = "l_orderkey, l_linenumber, store_id, dept_id, event_timestamp"
SHORT = ["weekly_sales", "lag_1", "rolling_mean_4w"]


def generated(noisy: bool) -> str:
    noise = f" + 2000.0 * {normal(0, 0)}" if noisy else ""
    woy = "weekofyear(event_timestamp)"
    boost = f"CASE WHEN {woy} IN (6, 27, 36, 47, 51) THEN 1.5 ELSE 1.0 END"
    mean = f"""(50000 + store_id * 5000)::DOUBLE * (0.5::DOUBLE + dept_id * 0.2::DOUBLE)
      * (1.0::DOUBLE + 0.3::DOUBLE * sin(2 * pi() * {woy} / 52.0)) * ({boost})::DOUBLE"""
    return query(
        f"""SELECT store_id, dept_id, event_timestamp,
      round(greatest(0.0::DOUBLE, {mean}{noise}), 2) AS weekly_sales,
      {calendar('event_timestamp')}, {economy(noisy)}
    FROM (SELECT w.*, {WEEK} FROM ({SPINE_WEEKLY}) w, span)""",
        "series", "span",
    )


def statistics(names: list[str]) -> str:
    return " UNION ALL ".join(
        f"""SELECT '{n}' AS "column", round(avg({n}), 4) AS mean,
      round(CASE WHEN stddev_pop({n}) = 0 THEN 1 ELSE stddev_pop({n}) END, 4) AS std FROM features"""
        for n in names
    )


def standardized(n: str, of: str, value: str | None = None, alias: str | None = None) -> str:
    value = value or n
    div = f"CASE WHEN s_{n} = 0 THEN 1 ELSE s_{n} END"
    # + 0 turns a negative zero into zero
    return f"round(({of}{value} - m_{n}) / {div}, 6) + 0 AS {alias or n}"


def coverage(view: str, block: str, names: list[str], types: dict[str, str]) -> str:
    return " UNION ALL ".join(
        f"""SELECT '{view}' AS view, '{n}' AS feature, '{types[n]}' AS dtype,
      (SELECT count(*) FROM {block}) AS n_rows,
      (SELECT count(*) FROM {block} WHERE {n} IS NULL) AS n_null"""
        for n in names
    )


TYPES = {
    **{n: "double" for n in DOUBLES},
    **{n: "bigint" for n in WHOLE},
    "store_type": "string", "store_size": "bigint", "region": "string",
}
DERIVED = """
      coalesce(weekly_sales, 0) / CASE WHEN coalesce(store_size, 0) = 0 THEN 1 ELSE store_size END
        AS a, CASE WHEN coalesce(lag_1, 0) = 0 THEN 1 ELSE lag_1 END AS b, weekly_sales"""
DERIVED_SQL = query(
    f"""SELECT {LINE}, round(a, 12) AS sales_per_sqft,
      round((coalesce(weekly_sales, 0) - b) / b, 6) + 0 AS momentum
    FROM (SELECT {LINE}, {DERIVED} FROM
      ({asof('shipped', ['weekly_sales', 'lag_1'], ['store_size'], source='windows')}))""",
    "shipped", "windows", "stores",
)
# NULL features of the joined table are 0 and the first 80 % of its weeks are train.
PREPARED = f"""SELECT *, CASE WHEN row_number() OVER (ORDER BY event_timestamp, store_id, dept_id)
      <= floor(count(*) OVER () * 0.8) THEN 'train' ELSE 'val' END AS split
    FROM (SELECT store_id, dept_id, event_timestamp, weekly_sales, ln(1 + weekly_sales) AS y,
      {', '.join(f'coalesce({n}, 0) AS {n}' for n in [*SALES[1:], 'store_size'])}
    FROM ({TRAINING}) WHERE weekly_sales IS NOT NULL)"""
BLOCKS["stats"] = f"SELECT {', '.join(f'avg({n}) AS m_{n}, stddev_pop({n}) AS s_{n}' for n in SALES)} FROM features"
MATRIX = [*SALES[1:], "store_size"]
TRAIN_STATS = ", ".join(
    f"avg({n}) AS m_{n}, stddev_pop({n}) AS s_{n}" for n in [*MATRIX, "y"]
)
# Least squares of the log target on one feature; scaling both does not change predictions.
# Scoring takes features as 32 bit floats.
ONE_FEATURE = f"""p AS MATERIALIZED ({PREPARED}),
fit AS MATERIALIZED (SELECT regr_slope(y, rolling_mean_4w) AS b, regr_intercept(y, rolling_mean_4w) AS a,
    avg(y) AS m_y, stddev_pop(y) AS s_y FROM p WHERE split = 'train'),
scored AS (SELECT p.*, m_y, s_y, a + b * rolling_mean_4w::FLOAT::DOUBLE AS guess FROM p JOIN fit ON true)"""


REQUESTED = """SELECT floor(pos / 16)::BIGINT AS request_id, pos % 16 AS pos, a.store_id,
    a.dept_id, round(coalesce(n.rolling_mean_4w, 0), 0) AS prediction
    FROM asked a LEFT JOIN newest n ON a.store_id = n.store_id AND a.dept_id = n.dept_id"""

ORACLE = {
    "scan_feature_view": "SELECT user_id, ts, value, event_type FROM events",
    "sales_features": query(f"SELECT {show([*KEY, *SALES])} FROM features", "features"),
    "write_read_roundtrip": query(f"SELECT {show([*KEY, *SALES])} FROM features", "features"),
    "generate_sales": generated(True),
    "generate_sales_det": generated(False),
    "store_features": query("SELECT * FROM stores", "stores"),
    "entity_spine_weekly": query(SPINE_WEEKLY, "series", "span"),
    "entity_spine_friday": query("SELECT * FROM fridays", "fridays"),
    "materialize_latest": """SELECT user_id, ts, value, event_type FROM events
        WHERE ts >= TIMESTAMP '2024-01-05' AND ts <= TIMESTAMP '2024-01-25'
        QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, value DESC) = 1""",
    "materialize_sales": query(
        f"""SELECT {show([*KEY, *SALES])} FROM features QUALIFY row_number() OVER (
        PARTITION BY store_id, dept_id ORDER BY event_timestamp DESC) = 1""",
        "features",
    ),
    "scaler_stats": query(statistics(SALES), "features"),
    "registry_features": query(
        coverage("sales_features", "features", SALES, TYPES)
        + " UNION ALL "
        + coverage("store_features", "stores", STORE, TYPES)
        + """ UNION ALL SELECT 'derived_features', 'sales_per_sqft', 'double', NULL, NULL
        UNION ALL SELECT 'derived_features', 'momentum', 'double', NULL, NULL""",
        "features", "stores",
    ),
    "registry_lineage": query(
        """SELECT * FROM (VALUES
      ('entity', 'dept_id', 'feature_view', 'sales_features'),
      ('entity', 'dept_id', 'feature_view', 'store_features'),
      ('entity', 'store_id', 'feature_view', 'sales_features'),
      ('entity', 'store_id', 'feature_view', 'store_features'),
      ('feature_view', 'sales_features', 'feature_service', 'inference_features'),
      ('feature_view', 'sales_features', 'feature_service', 'training_features'),
      ('feature_view', 'sales_features', 'on_demand_view', 'derived_features'),
      ('feature_view', 'store_features', 'feature_service', 'inference_features'),
      ('feature_view', 'store_features', 'feature_service', 'training_features'),
      ('feature_view', 'store_features', 'on_demand_view', 'derived_features'),
      ('source', 'sales_source', 'feature_view', 'sales_features'),
      ('source', 'store_source', 'feature_view', 'store_features'))
      AS e(from_kind, from_name, to_kind, to_name)
    LEFT JOIN (SELECT 'source' AS from_kind, 'sales_source' AS from_name, count(*) AS n_rows FROM base
      UNION ALL SELECT 'source', 'store_source', count(*) FROM series)
    USING (from_kind, from_name)""",
        "base", "series",
    ),
    "service_projection": query(
        f"SELECT {show([*KEY, 'lag_1', 'lag_2', 'is_holiday'])} FROM features", "features"
    ),
    "training_features": query(
        f"SELECT {show([*KEY, *SALES, *STORE])} FROM ({TRAINING})", "features", "stores", "fridays"
    ),
    "cached_training_set": query(
        f"SELECT {show([*KEY, *SALES, *STORE])} FROM ({TRAINING})", "features", "stores", "fridays"
    ),
    "inference_features": query(
        f"SELECT {show([*KEY, *SALES[1:], *STORE])} FROM ({TRAINING})",
        "features", "stores", "fridays",
    ),
    "feature_refs": query(
        f"""SELECT {LINE}, {show(['weekly_sales', 'lag_1', 'store_type'])} FROM
        ({asof('shipped', ['weekly_sales', 'lag_1'], ['store_type'], source='windows')})""",
        "shipped", "windows", "stores",
    ),
    "drop_null_target": query(
        f"""SELECT {LINE}, {show(SHORT)} FROM
        ({asof('shipped', SHORT, sales_ttl='INTERVAL 2 DAY', source='windows')})
        WHERE weekly_sales IS NOT NULL""",
        "shipped", "windows",
    ),
    "numeric_features": query(
        f"SELECT {show([*KEY, *SALES[1:], 'store_size'])} FROM ({TRAINING})",
        "features", "stores", "fridays",
    ),
    "feature_matrix": query(
        f"""SELECT store_id, dept_id, event_timestamp,
        round(coalesce(lag_1, 0)::FLOAT::DOUBLE, 1) AS lag_1,
        round(coalesce(rolling_mean_4w, 0)::FLOAT::DOUBLE, 1) AS rolling_mean_4w,
        round(coalesce(store_size, 0)::FLOAT::DOUBLE, 1) AS store_size,
        0::DOUBLE AS not_there FROM ({TRAINING})""",
        "features", "stores", "fridays",
    ),
    "fill_zero": query(
        f"""SELECT store_id, dept_id, event_timestamp,
        {', '.join(f'coalesce(round({n}, 4), 0) AS {n}' if n in DOUBLES
                   else f'coalesce({n}, 0) AS {n}' for n in [*SALES, 'store_size'])},
        store_type, region FROM ({asof('fridays', SALES, STORE, 'INTERVAL 30 DAY', 'INTERVAL 365 DAY')})""",
        "features", "stores", "fridays",
    ),
    "lag_features": query(f"SELECT {show([*KEY, *LAGS])} FROM windows", "windows"),
    "lag_features_split": query(f"SELECT {show([*KEY, *LAGS])} FROM windows", "windows"),
    "rolling_mean": query(f"SELECT {show([*KEY, 'rolling_mean_4w'])} FROM windows", "windows"),
    "rolling_std": query(f"SELECT {show([*KEY, 'rolling_std_4w'])} FROM windows", "windows"),
    "sales_vs_avg": query(f"SELECT {show([*KEY, 'sales_vs_avg'])} FROM windows", "windows"),
    "event_windows": """SELECT user_id, ts, round(coalesce(lag(value, 1) OVER w, avg(value) OVER f), 4)
        AS lag_1, round(coalesce(lag(value, 2) OVER w, avg(value) OVER f), 4) AS lag_2,
        round(avg(value) OVER f, 4) AS rolling_mean_4w FROM events
        WINDOW w AS (PARTITION BY user_id ORDER BY ts),
        f AS (PARTITION BY user_id ORDER BY ts ROWS BETWEEN 3 PRECEDING AND CURRENT ROW)""",
    "pit_join": query(
        f"SELECT {LINE}, {show(SHORT)} FROM ({asof('shipped', SHORT, source='windows')})",
        "shipped", "windows",
    ),
    "pit_join_split": query(
        f"SELECT {LINE}, {show(SHORT)} FROM ({asof('shipped', SHORT, source='windows')})",
        "shipped", "windows",
    ),
    "pit_join_broadcast": query(
        f"""SELECT {show([*KEY, 'weekly_sales', 'lag_1', 'region'])} FROM
        ({asof('fridays', ['weekly_sales', 'lag_1'], ['region'], source='windows')}), span
        WHERE event_timestamp >= last_week - INTERVAL 56 DAY""",
        "windows", "stores", "fridays", "span",
    ),
    "pit_join_ttl_expiry": query(
        f"""SELECT {show([*KEY, 'weekly_sales', 'store_size'])} FROM ({asof('fridays',
        ['weekly_sales'], ['store_size'], 'INTERVAL 90 DAY', 'INTERVAL 365 DAY', 'base')})""",
        "base", "stores", "fridays",
    ),
    "pit_join_future_guard": query(
        f"""SELECT {show([*KEY, 'weekly_sales', 'store_type'])} FROM ({asof(
        '(SELECT store_id, dept_id, event_timestamp - INTERVAL 1274 DAY AS event_timestamp FROM fridays)',
        ['weekly_sales'], ['store_type'], source='base')})""",
        "base", "stores", "fridays",
    ),
    "pit_join_events": """SELECT q.event_id, q.user_id, q.ts,
        CASE WHEN c.ts >= q.ts - INTERVAL 3 DAY THEN c.value END AS click_value,
        CASE WHEN c.ts >= q.ts - INTERVAL 3 DAY THEN c.event_id END AS click_id
        FROM events q ASOF LEFT JOIN (SELECT * FROM events WHERE event_type = 'click') c
        ON q.user_id = c.user_id AND q.ts >= c.ts""",
    "online_lookup": query(
        """SELECT a.*, round(n.weekly_sales, 4) AS weekly_sales, round(n.lag_1, 4) AS lag_1
        FROM asked a LEFT JOIN newest n ON a.store_id = n.store_id AND a.dept_id = n.dept_id""",
        "asked", "newest",
    ),
    "online_service": query(
        f"""SELECT a.*, {show([*SALES[1:], *STORE]).replace('round(', 'round(n.')
          .replace(' store_type', ' s.store_type').replace(' store_size', ' s.store_size')
          .replace(' region', ' s.region')}
        FROM asked a LEFT JOIN (SELECT * FROM features QUALIFY row_number() OVER (
        PARTITION BY store_id, dept_id ORDER BY event_timestamp DESC) = 1) n
        ON a.store_id = n.store_id AND a.dept_id = n.dept_id
        LEFT JOIN stores s ON a.store_id = s.store_id AND a.dept_id = s.dept_id""",
        "asked", "features", "stores",
    ),
    "on_demand_features": DERIVED_SQL,
    "on_demand_pandas_udf": DERIVED_SQL,
    "calendar_features": f"""SELECT l_orderkey, l_linenumber, l_shipdate,
        {calendar('l_shipdate')} FROM lineitem""",
    "days_to_holiday_strict": """SELECT l_orderkey, l_linenumber, l_shipdate,
        least(365, (SELECT min(((h - weekofyear(l_shipdate) + 52) % 52) * 7)
          FROM unnest([6, 27, 36, 47, 51, 52]) AS t(h)
          WHERE (h - weekofyear(l_shipdate) + 52) % 52 > 0))::BIGINT AS days_to_holiday
        FROM lineitem""",
    "sorted_sales": query("SELECT * FROM base", "base"),
    "head": query("SELECT * FROM base ORDER BY store_id, dept_id, event_timestamp LIMIT 10", "base"),
    "chrono_split": query(
        """SELECT *, CASE WHEN row_number() OVER (ORDER BY event_timestamp, store_id, dept_id)
        <= floor(count(*) OVER () * 0.8) THEN 'train' ELSE 'val' END AS split FROM base""",
        "base",
    ),
    "hash_split": """SELECT o_orderkey, o_custkey,
        CASE WHEN ('0x' || substr(md5(o_orderkey::VARCHAR), 1, 8))::BIGINT % 100 < 80
        THEN 'train' ELSE 'val' END AS split FROM orders""",
    "permutation_split": """SELECT o_orderkey, o_custkey,
        CASE WHEN row_number() OVER (ORDER BY md5('42|' || o_orderkey), o_orderkey)
        <= floor(count(*) OVER () * 0.8) THEN 'train' ELSE 'val' END AS split FROM orders""",
    "target_transform": query(
        """SELECT store_id, dept_id, event_timestamp, round(ln(1 + weekly_sales), 8) AS y,
        round(exp(ln(1 + weekly_sales)) - 1, 2) AS back FROM base""",
        "base",
    ),
    "scaled_features": query(
        f"""SELECT store_id, dept_id, event_timestamp, {', '.join(standardized(n, 'f.') for n in SALES)}
        FROM features f JOIN stats ON true""",
        "features", "stats", once=("features", "stats"),
    ),
    "training_matrix": query(
        f"""SELECT p.store_id, p.dept_id, p.event_timestamp, p.weekly_sales, p.split,
        {', '.join(standardized(n, 'p.') for n in [*MATRIX, 'y'])}
        FROM ({PREPARED}) p, (SELECT {TRAIN_STATS} FROM ({PREPARED}) WHERE split = 'train')""",
        "features", "stores", "fridays",
    ),
    "mape": query(
        """SELECT round(avg(abs((weekly_sales - lag_1) / weekly_sales)) * 100, 4) AS mape
        FROM windows WHERE weekly_sales > 1000""",
        "windows",
    ),
    "mse": query(
        "SELECT round(avg(pow(ln(1 + weekly_sales) - ln(1 + lag_1), 2)), 6) AS mse FROM windows",
        "windows",
    ),
    "profile": query(
        """SELECT count(*) AS n_rows, min(event_timestamp) AS first_ts,
        max(event_timestamp) AS last_ts FROM base""",
        "base",
    ),
    "weighted_loss": """SELECT year(l_shipdate)::BIGINT AS epoch,
        round(sum(l_tax * l_quantity) / sum(l_quantity), 6) AS weighted_loss,
        round(avg(l_tax), 6) AS mean_loss FROM lineitem GROUP BY ALL""",
    "metrics_log": query(
        """SELECT run_id, step, 'train_loss' AS metric, train_loss AS value FROM epochs
        UNION ALL SELECT run_id, step, 'val_loss', val_loss FROM epochs
        UNION ALL SELECT run_id, step, 'mape', mape FROM epochs
        UNION ALL SELECT run_id, step, 'best_mape', mape FROM best
        UNION ALL SELECT run_id, step, 'best_val_loss', val_loss FROM best""",
        "best",
    ),
    "best_epoch": query("SELECT * FROM best", "best"),
    "top_runs": query(
        "SELECT * FROM runs WHERE name = 'click' ORDER BY start_time DESC, run_id LIMIT 5", "runs"
    ),
    "model_versions": query("SELECT * FROM versions", "versions"),
    "model_latest_version": query(
        """SELECT name, version, run_id, best_mape FROM versions WHERE name = 'click'
        ORDER BY version DESC LIMIT 1""",
        "versions",
    ),
    "decode_requests": query(
        """SELECT floor(pos / 16)::BIGINT AS request_id, pos % 16 AS pos, store_id, dept_id
        FROM asked""",
        "asked",
    ),
    "encode_responses": query(
        f"""SELECT request_id, '{{"model_name":"sales-forecast","id":"' || request_id ||
        '","outputs":[{{"name":"predictions","shape":[' || count(*) || '],"datatype":"FP32","data":['
        || string_agg(printf('%.1f', prediction), ',' ORDER BY pos) || ']}}]}}' AS response
        FROM ({REQUESTED}) GROUP BY request_id""",
        "asked", "newest",
    ),
    "prediction_report": query(
        f"""SELECT request_id, pos, store_id, dept_id,
        '$' || format('{{:,}}', prediction::BIGINT) AS prediction FROM ({REQUESTED})""",
        "asked", "newest",
    ),
    "train_eval_one_feature": query(
        f"""SELECT round(avg(pow((y - guess) / s_y, 2)), 6) AS val_loss,
        round(avg(CASE WHEN weekly_sales > 1000
          THEN abs((weekly_sales - (exp(guess) - 1)) / weekly_sales) END) * 100, 6) AS mape,
        count(*) AS n_rows FROM (WITH {ONE_FEATURE} SELECT * FROM scored WHERE split = 'val')""",
        "features", "stores", "fridays",
    ),
    "batch_score_one_feature": query(
        f"""SELECT store_id, dept_id, event_timestamp, round(exp(guess) - 1, 2) AS prediction
        FROM (WITH {ONE_FEATURE} SELECT * FROM scored)""",
        "features", "stores", "fridays",
    ),
    "decode_feature_rows": """SELECT floor(c_custkey / 16)::BIGINT AS request_id,
        row_number() OVER (PARTITION BY floor(c_custkey / 16) ORDER BY c_custkey) - 1 AS pos,
        round(c_acctbal::FLOAT::DOUBLE, 1) AS balance, c_nationkey::BIGINT AS nation FROM customer""",
    "unscaled_features": query(f"SELECT {show([*KEY, *SALES])} FROM features", "features"),
    "score_requests_one_feature": query(
        f"""SELECT floor(pos / 16)::BIGINT AS request_id, row_number() OVER (PARTITION BY floor(pos / 16) ORDER BY pos) - 1 AS pos,
        NULL::VARCHAR AS error, round(a + b * coalesce(n.rolling_mean_4w, 0)::FLOAT::DOUBLE, 4) AS log_prediction
        FROM asked LEFT JOIN newest n ON asked.store_id = n.store_id AND asked.dept_id = n.dept_id,
        (WITH {ONE_FEATURE} SELECT a, b FROM fit)""",
        "asked", "newest", "features", "stores", "fridays",
    ),
    "train_stump": query(
        f"""SELECT * FROM (WITH p AS MATERIALIZED ({PREPARED}),
        s AS (SELECT avg(y) AS m_y, stddev_pop(y) AS s_y FROM p WHERE split = 'train'),
        leaf AS (SELECT is_holiday, avg(y) AS guess FROM p WHERE split = 'train' GROUP BY is_holiday)
        SELECT round(avg(pow((y - guess) / s_y, 2)), 4) AS val_loss,
        round(avg(CASE WHEN weekly_sales > 1000 THEN abs((weekly_sales - (exp(guess) - 1)) / weekly_sales) END) * 100, 4) AS mape,
        count(*) AS n_rows FROM p JOIN leaf USING (is_holiday), s WHERE split = 'val')""",
        "features", "stores", "fridays",
    ),
}
ORACLE["event_windows_split"] = ORACLE["event_windows"]
ORACLE["online_lookup_join"] = ORACLE["online_lookup"]
ORACLE["sales_features_incremental"] = ORACLE["sales_features"]
ORACLE["scaler_incremental"] = ORACLE["scaler_stats"]
ORACLE["materialize_incremental"] = ORACLE["materialize_sales"]


def _edges() -> str:
    """Feature-level edges of the retail definitions, as VALUES."""
    made = [("source:sales_source", f"feature:sales_features.{c}") for c in SALES]
    made += [("source:store_source", f"feature:store_features.{c}") for c in STORE]
    inputs = [f"sales_features.{c}" for c in ("weekly_sales", "lag_1")] + ["store_features.store_size"]
    made += [(f"feature:{i}", f"feature:derived_features.{o}") for i in inputs for o in ("sales_per_sqft", "momentum")]
    for service, sales in (("training_features", SALES), ("inference_features", SALES[1:])):
        made += [(f"feature:sales_features.{c}", f"service:{service}") for c in sales]
        made += [(f"feature:store_features.{c}", f"service:{service}") for c in STORE]
    return ", ".join(str(e) for e in made)


ORACLE["lineage_closure"] = query(
    f"""SELECT from_node, to_node, hops, n_rows FROM (
      WITH RECURSIVE e(from_node, to_node) AS (VALUES {_edges()}),
      walk(from_node, to_node, hops) AS (
        SELECT from_node, to_node, 1 FROM e
        UNION SELECT w.from_node, e.to_node, w.hops + 1 FROM walk w JOIN e ON e.from_node = w.to_node)
      SELECT from_node, to_node, min(hops) AS hops FROM walk GROUP BY ALL)
    LEFT JOIN (SELECT 'source:sales_source' AS from_node, count(*) AS n_rows FROM base
      UNION ALL SELECT 'source:store_source', count(*) FROM series) USING (from_node)""",
    "base", "series",
)
ORACLE["chrono_split_three"] = query(
    """SELECT *, CASE WHEN r <= floor(n * 0.7) THEN 'train' WHEN r <= floor(n * 0.7) + floor(n * 0.15) THEN 'val'
      ELSE 'test' END AS split FROM (SELECT *, count(*) OVER () AS n,
      row_number() OVER (ORDER BY event_timestamp, store_id, dept_id) AS r FROM base)""",
    "base",
).replace("SELECT *, CASE", "SELECT * EXCLUDE (n, r), CASE", 1)
ORACLE["pit_join_bucketed"] = ORACLE["pit_join"]
ORACLE["decode_mixed_requests"] = query(
    """SELECT floor(pos / 16)::BIGINT AS request_id,
      row_number() OVER (PARTITION BY floor(pos / 16) ORDER BY pos) - 1 AS pos,
      CASE WHEN store_id <> 3 THEN store_id END AS store_id, CASE WHEN dept_id <> 7 THEN dept_id END AS dept_id,
      CASE WHEN store_id = 3 AND dept_id = 7 THEN 'no usable store_id, dept_id' WHEN store_id = 3 THEN 'no usable store_id'
        WHEN dept_id = 7 THEN 'no usable dept_id' END AS error FROM asked""",
    "asked",
)
