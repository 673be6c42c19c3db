"""The same queries as SQL over the star tables, in whole-number arithmetic (HUGEINT)."""

from __future__ import annotations

from spendfall.plans.star_queries import FALLBACK_RULES, STRATEGY_RULES, V1, V2

ONE = 1_000_000_000_000


def money(cents: str) -> str:
    return f"CAST(CAST({cents} AS DECIMAL(18,0)) * CAST(0.01 AS DECIMAL(3,2)) AS DECIMAL(18,2))"


def share(units: str) -> str:
    return f"CAST(CAST({units} AS DECIMAL(18,0)) * CAST(0.000000000001 AS DECIMAL(13,12)) AS DECIMAL(18,12))"


def pct(top: str, bottom: str) -> str:
    """Half up at six places of two whole numbers; the bottom is positive, NULL where it is 0."""
    n = f"((2 * abs(CAST({top} AS HUGEINT)) * 1000000 + ({bottom})) // (2 * ({bottom})) * sign(CAST({top} AS HUGEINT)))"
    whole = f"CAST({n} AS DECIMAL(18,0))"
    return f"CASE WHEN ({bottom}) <> 0 THEN CAST({whole} * CAST(0.000001 AS DECIMAL(7,6)) AS DECIMAL(18,6)) END"


def cents(amount: str) -> str:
    return f"CAST({amount} * 100 AS HUGEINT)"


GL = """
gl AS MATERIALIZED (
  SELECT 'GL-' || o_orderkey AS gl_line_id, strftime(o_orderdate, '%Y-%m') AS period,
         '700' || substr(o_orderpriority, 1, 1) AS gl_account, 'CC-' || o_custkey AS cost_center_id,
         CAST(o_totalprice AS DECIMAL(18,2)) AS amount_eur, o_orderpriority AS description,
         CASE WHEN c_acctbal >= 0 THEN 'TWR-' || c_nationkey END AS tower_id, c_name AS cost_center_name
  FROM orders LEFT JOIN customer ON o_custkey = c_custkey
)"""

CENTERS = """
centers AS (
  SELECT 'CC-' || c_custkey AS cost_center_id, c_name AS name,
         CASE WHEN c_acctbal >= 0 THEN 'TWR-' || c_nationkey END AS tower_id
  FROM customer
)"""

USAGE = """
cube AS MATERIALIZED (
  SELECT strftime(l_shipdate, '%Y-%m') AS period, s_nationkey, r_name, p_type, c_mktsegment,
         count(*) AS lines, sum(CAST(l_quantity AS DECIMAL(18,2))) AS units
  FROM lineitem
  JOIN part ON p_partkey = l_partkey
  JOIN supplier ON s_suppkey = l_suppkey
  JOIN nation ON n_nationkey = s_nationkey
  JOIN region ON r_regionkey = n_regionkey
  JOIN orders ON o_orderkey = l_orderkey
  JOIN customer ON c_custkey = o_custkey
  GROUP BY ALL
),
signals AS (
  SELECT period, 'tower_to_app' AS step, 'TWR-' || s_nationkey AS from_id, 'APP-' || p_type AS to_id,
         'line_count' AS metric_name, CAST(lines AS DECIMAL(18,2)) AS value
  FROM cube WHERE r_name <> 'MIDDLE EAST'
  UNION ALL
  SELECT period, 'tower_to_app', 'TWR-' || s_nationkey, 'APP-' || p_type, 'shipped_units', units
  FROM cube WHERE r_name NOT IN ('MIDDLE EAST', 'AFRICA')
  UNION ALL
  SELECT period, 'app_to_bu', 'APP-' || p_type, 'BU-' || c_mktsegment, 'order_lines', CAST(lines AS DECIMAL(18,2))
  FROM cube WHERE p_type <> 'PROMO'
  UNION ALL
  SELECT period, 'app_to_bu', 'APP-' || p_type, 'BU-' || c_mktsegment, 'ordered_units',
         CASE WHEN p_type = 'ECONOMY' THEN CAST(0 AS DECIMAL(38,2)) ELSE units END
  FROM cube WHERE p_type <> 'PROMO'
),
usage AS MATERIALIZED (
  SELECT concat_ws(':', step, from_id, to_id, metric_name, period) AS metric_id, period, step, from_id, to_id,
         metric_name, CAST(sum(value) AS DECIMAL(18,2)) AS value
  FROM signals GROUP BY period, step, from_id, to_id, metric_name
),
idx AS MATERIALIZED (
  SELECT step, from_id, metric_name, to_id, CAST(sum(value) AS DECIMAL(26,2)) AS signal
  FROM usage GROUP BY step, from_id, metric_name, to_id
)"""


def _text(value: str | None) -> str:
    return "NULL" if value is None else f"'{value}'"


def rule_rows(versions: list[dict]) -> str:
    rows, params = [], ["(NULL, NULL, NULL, CAST(NULL AS DECIMAL(18,12)))"]
    for version in versions:
        for step in ("gl_to_tower", "tower_to_app", "app_to_bu"):
            body = version[step].get("on_unmapped") or {} if step == "gl_to_tower" else version[step]
            rows.append(
                f"({_text(version['version_id'])}, {_text(step)}, "
                f"CAST({_text(body.get('strategy'))} AS VARCHAR), CAST({_text(body.get('metric_name'))} AS VARCHAR))"
            )
            values = body.get("weights") or body.get("proportions") or {}
            params += [
                f"({_text(version['version_id'])}, {_text(step)}, {_text(target)}, CAST({value} AS DECIMAL(18,12)))"
                for target, value in values.items()
            ]
    return f"""
rules AS (SELECT * FROM (VALUES {', '.join(rows)}) AS r(rule_version, step, strategy, metric_name)),
params AS (
  SELECT rule_version, step, to_id, CAST(value * 1000000000000 AS HUGEINT) AS raw
  FROM (VALUES {', '.join(params)}) AS p(rule_version, step, to_id, value) WHERE rule_version IS NOT NULL
)"""


SPLITS = f"""
nodes AS (
  SELECT DISTINCT rule_version, step, strategy, from_id FROM idx JOIN rules USING (step)
),
fallback AS (
  SELECT rule_version, step, strategy, '*' AS from_id FROM rules WHERE step = 'gl_to_tower' AND strategy IS NOT NULL
),
candidates AS (
  SELECT r.rule_version, i.step, r.strategy, i.from_id, i.to_id,
         sum(CASE WHEN r.strategy = 'consumption' AND i.metric_name = r.metric_name
                  THEN CAST(i.signal * 100 AS HUGEINT) ELSE 0 END) AS raw
  FROM idx i JOIN rules r ON r.step = i.step
  WHERE r.strategy = 'consumption' GROUP BY ALL
  UNION ALL
  SELECT DISTINCT r.rule_version, i.step, r.strategy, i.from_id, i.to_id, CAST(1 AS HUGEINT)
  FROM idx i JOIN rules r ON r.step = i.step WHERE r.strategy = 'even_spread'
  UNION ALL
  SELECT t.rule_version, t.step, t.strategy, t.from_id, t.to_id, coalesce(p.raw, 0)
  FROM (
    SELECT r.rule_version, i.step, r.strategy, i.from_id, i.to_id
    FROM idx i JOIN rules r ON r.step = i.step WHERE r.strategy = 'weighted'
    UNION
    SELECT n.rule_version, n.step, n.strategy, n.from_id, p.to_id
    FROM nodes n JOIN params p ON p.rule_version = n.rule_version AND p.step = n.step WHERE n.strategy = 'weighted'
  ) t LEFT JOIN params p ON p.rule_version = t.rule_version AND p.step = t.step AND p.to_id = t.to_id
  UNION ALL
  SELECT n.rule_version, n.step, n.strategy, n.from_id, p.to_id, p.raw
  FROM nodes n JOIN params p ON p.rule_version = n.rule_version AND p.step = n.step
  WHERE n.strategy = 'manual_override'
  UNION ALL
  SELECT f.rule_version, f.step, f.strategy, f.from_id, 'TWR-' || n_nationkey,
         CASE WHEN f.strategy = 'even_spread' THEN 1 ELSE coalesce(p.raw, 0) END
  FROM fallback f CROSS JOIN nation
  LEFT JOIN params p ON p.rule_version = f.rule_version AND p.step = f.step AND p.to_id = 'TWR-' || n_nationkey
  WHERE f.strategy <> 'manual_override'
  UNION ALL
  SELECT f.rule_version, f.step, f.strategy, f.from_id, p.to_id, p.raw
  FROM fallback f JOIN params p ON p.rule_version = f.rule_version AND p.step = f.step
  WHERE f.strategy = 'manual_override'
),
totalled AS (
  SELECT *, sum(raw) OVER (PARTITION BY rule_version, step, from_id) AS total FROM candidates
),
floored AS (
  SELECT *, CASE WHEN strategy = 'manual_override' THEN raw WHEN total > 0 THEN raw * {ONE} // total END AS floor_units,
         CASE WHEN strategy <> 'manual_override' AND total > 0 THEN raw * {ONE} % total END AS rest
  FROM totalled
),
shares AS MATERIALIZED (
  SELECT rule_version, step, strategy, from_id, to_id, raw,
         floor_units + CASE WHEN strategy <> 'manual_override' AND
           row_number() OVER (PARTITION BY rule_version, step, from_id ORDER BY rest DESC, raw DESC, to_id)
           <= {ONE} - sum(floor_units) OVER (PARTITION BY rule_version, step, from_id) THEN 1 ELSE 0 END AS units
  FROM floored
),
known AS (
  SELECT rule_version, step, from_id, bool_or(units IS NULL) AS dead FROM shares GROUP BY ALL
)"""


def _hop(number: int, step: str, source: str, previous: str, source_expr: str, reached: str) -> str:
    """Split the live flows of ``previous``; failed ones pass through. Output: h<number>."""
    kept = {
        1: "",
        2: "f.tower_id, f.u1,",
        3: "f.tower_id, f.u1, f.app_id, f.u2,",
    }[number]
    names = {1: "tower_id, u1", 2: "app_id, u2", 3: "bu_id, u3"}[number]
    target, units = names.split(", ")
    flow = {1: "rule_version, gl_line_id", 2: "rule_version, gl_line_id, tower_id", 3: "rule_version, gl_line_id, tower_id, app_id"}[number]
    base = "f.rule_version, f.gl_line_id, f.period, f.gl_account, f.cost_center_id, f.cost_center_name, f.gl_cents,"
    mapped = "f.mapped_tower," if number == 1 else ""
    plain = (base + kept + mapped).replace("f.", "")
    return f"""
s{number} AS (
  SELECT {base} {kept} {mapped} f.cents, s.to_id, s.units,
         f.cents * s.units // {ONE} AS floor_cents, f.cents * s.units % {ONE} AS rest
  FROM {previous} f
  JOIN known k ON k.rule_version = f.rule_version AND k.step = '{step}' AND k.from_id = {source_expr} AND NOT k.dead
  JOIN shares s ON s.rule_version = k.rule_version AND s.step = k.step AND s.from_id = k.from_id
  WHERE f.failed_step IS NULL
),
g{number} AS (
  SELECT *, row_number() OVER (PARTITION BY {flow} ORDER BY rest DESC, units DESC, to_id) AS position,
         count(*) OVER (PARTITION BY {flow}) AS n,
         cents - sum(floor_cents) OVER (PARTITION BY {flow}) AS spare
  FROM s{number}
),
d{number} AS (
  SELECT {plain} to_id AS {target}, units AS {units},
         floor_cents + spare // n + CASE WHEN position <= spare % n THEN 1 ELSE 0 END AS cents,
         CAST(NULL AS VARCHAR) AS failed_step, CAST(NULL AS VARCHAR) AS reason_code
  FROM g{number}
)"""


CASCADE_TAIL = """
f0 AS (
  SELECT v.rule_version, gl_line_id, period, gl_account, cost_center_id, cost_center_name,
         CAST(amount_eur * 100 AS HUGEINT) AS gl_cents, tower_id AS mapped_tower, CAST(amount_eur * 100 AS HUGEINT) AS cents,
         CASE WHEN tower_id IS NOT NULL THEN 'mapped' END AS failed_step
  FROM gl CROSS JOIN (SELECT DISTINCT rule_version FROM rules) v
),
""" + _hop(1, "gl_to_tower", "'*'", "f0", "'*'", "tower_id") + f""",
h1 AS MATERIALIZED (
  SELECT rule_version, gl_line_id, period, gl_account, cost_center_id, cost_center_name, gl_cents,
         tower_id, u1, cents, failed_step, reason_code FROM d1 WHERE cents <> 0
  UNION ALL
  SELECT f.rule_version, gl_line_id, period, gl_account, cost_center_id, cost_center_name, gl_cents,
         mapped_tower, CASE WHEN mapped_tower IS NOT NULL THEN CAST({ONE} AS HUGEINT) END, cents,
         CASE WHEN mapped_tower IS NULL THEN 'gl_to_tower' END,
         CASE WHEN mapped_tower IS NOT NULL THEN NULL
              WHEN r.strategy IS NULL THEN 'unmapped'
              WHEN k.dead THEN 'driver_zero' ELSE 'shared_unattributable' END
  FROM f0 f JOIN rules r ON r.rule_version = f.rule_version AND r.step = 'gl_to_tower'
  LEFT JOIN known k ON k.rule_version = f.rule_version AND k.step = 'gl_to_tower' AND k.from_id = '*'
  WHERE mapped_tower IS NOT NULL OR k.dead IS NULL OR k.dead
),
""" + _hop(2, "tower_to_app", "tower_id", "h1", "f.tower_id", "app_id") + """,
h2 AS MATERIALIZED (
  SELECT rule_version, gl_line_id, period, gl_account, cost_center_id, cost_center_name, gl_cents,
         tower_id, u1, app_id, u2, cents, failed_step, reason_code FROM d2 WHERE cents <> 0
  UNION ALL
  SELECT f.rule_version, gl_line_id, period, gl_account, cost_center_id, cost_center_name, gl_cents,
         tower_id, u1, NULL, NULL, cents, coalesce(failed_step, 'tower_to_app'),
         CASE WHEN failed_step IS NOT NULL THEN reason_code WHEN k.dead THEN 'driver_zero' ELSE 'shared_unattributable' END
  FROM h1 f LEFT JOIN known k ON k.rule_version = f.rule_version AND k.step = 'tower_to_app' AND k.from_id = f.tower_id
  WHERE failed_step IS NOT NULL OR k.dead IS NULL OR k.dead
),
""" + _hop(3, "app_to_bu", "app_id", "h2", "f.app_id", "bu_id") + f""",
ends AS MATERIALIZED (
  SELECT rule_version, gl_line_id, period, gl_account, cost_center_id, cost_center_name, gl_cents,
         tower_id, u1, app_id, u2, bu_id, u3, cents, failed_step, reason_code, 'allocated' AS outcome
  FROM d3 WHERE cents <> 0
  UNION ALL
  SELECT f.rule_version, gl_line_id, period, gl_account, cost_center_id, cost_center_name, gl_cents,
         tower_id, u1, app_id, u2, NULL, NULL, cents, coalesce(failed_step, 'app_to_bu'),
         CASE WHEN failed_step IS NOT NULL THEN reason_code WHEN k.dead THEN 'driver_zero' ELSE 'shared_unattributable' END,
         'residual'
  FROM h2 f LEFT JOIN known k ON k.rule_version = f.rule_version AND k.step = 'app_to_bu' AND k.from_id = f.app_id
  WHERE failed_step IS NOT NULL OR k.dead IS NULL OR k.dead
),
lin AS (
  SELECT gl_line_id, period, gl_account, cost_center_id, cost_center_name, tower_id, app_id, bu_id,
         {money('gl_cents')} AS gl_amount_eur,
         CASE WHEN outcome = 'allocated' THEN {share('u1')} END AS prop_gl_to_tower,
         CASE WHEN outcome = 'allocated' THEN {share('u2')} END AS prop_tower_to_app,
         CASE WHEN outcome = 'allocated' THEN {share('u3')} END AS prop_app_to_bu,
         CASE WHEN outcome = 'allocated' THEN {money('cents')} END AS allocated_amount_eur,
         CASE WHEN outcome = 'residual' THEN {money('cents')} END AS residual_amount_eur,
         {money('cents')} AS terminal_amount_eur,
         rule_version, outcome, reason_code, failed_step
  FROM ends
)"""

_UNITS = {"strategy": "consumption", "metric_name": "shipped_units"}
MAIN_RULES = [
    {
        "version_id": V1,
        "gl_to_tower": {},
        "tower_to_app": _UNITS,
        "app_to_bu": {"strategy": "consumption", "metric_name": "ordered_units"},
    },
    {
        "version_id": V2,
        "gl_to_tower": {},
        "tower_to_app": _UNITS,
        "app_to_bu": {"strategy": "consumption", "metric_name": "order_lines"},
    },
]


def cascade_sql(select: str, rules: list[dict] = MAIN_RULES, extra: str = "") -> str:
    tables = ",".join([GL, CENTERS, USAGE, rule_rows(rules), SPLITS, CASCADE_TAIL]) + extra
    return f"WITH {tables}\n{select}"


def split_sql(select: str, version: str) -> str:
    chosen = [rule for rule in STRATEGY_RULES if rule["version_id"] == version]
    tables = ",".join([GL, USAGE, rule_rows(chosen), SPLITS])
    return f"WITH {tables}\n{select}"


def usage_sql(select: str) -> str:
    return f"WITH {GL},{CENTERS},{USAGE}\n{select}"


def faulty_sql() -> str:
    """The data-quality report over tables with faults of every kind, each check in plain SQL."""
    tables = f"""
f_centers AS (SELECT * FROM centers UNION ALL SELECT cost_center_id, name || '*', 'TWR-99' FROM centers WHERE tower_id = 'TWR-3'),
f_towers AS (
  SELECT 'TWR-' || n_nationkey AS tower_id, n_name AS name, r_name AS type FROM nation JOIN region ON r_regionkey = n_regionkey WHERE n_nationkey <> 5
  UNION ALL SELECT 'TWR-' || n_nationkey, n_name || '*', r_name FROM nation JOIN region ON r_regionkey = n_regionkey WHERE n_nationkey = 7
),
f_apps AS (
  SELECT DISTINCT 'APP-' || p_type AS app_id, p_type AS name, {_CRITICALITY} AS criticality FROM part WHERE p_type <> 'MEDIUM'
  UNION ALL SELECT DISTINCT 'APP-SMALL', 'SMALL*', 'none' FROM part WHERE p_type = 'SMALL'
),
f_units AS (
  SELECT DISTINCT 'BU-' || c_mktsegment AS bu_id, c_mktsegment AS name FROM customer WHERE c_mktsegment <> 'BUILDING'
  UNION ALL SELECT DISTINCT 'BU-MACHINERY', 'MACHINERY*' FROM customer WHERE c_mktsegment = 'MACHINERY'
),
f_gl AS (
  SELECT gl_line_id, cost_center_id, amount_eur, tower_id FROM gl
  UNION ALL SELECT gl_line_id, 'CC-NONE', -amount_eur, tower_id FROM gl WHERE gl_account = '7003'
),
f_usage AS (
  SELECT step, from_id, to_id, value FROM usage
  UNION ALL SELECT step, from_id, to_id, -value FROM usage WHERE metric_name = 'order_lines'
)"""
    dimensions = {
        "dim_cost_center": ("f_centers", "cost_center_id", "(name, tower_id)"),
        "dim_resource_tower": ("f_towers", "tower_id", "(name, type)"),
        "dim_application": ("f_apps", "app_id", "(name, criticality)"),
        "dim_business_unit": ("f_units", "bu_id", "name"),
    }
    keys = {
        "dim_cost_center_tower_fk": ("f_centers", "tower_id", "f_towers", "tower_id", "true"),
        "fact_gl_cost_cost_center_fk": ("f_gl", "cost_center_id", "f_centers", "cost_center_id", "true"),
        "fact_gl_cost_tower_fk": ("f_gl", "tower_id", "f_towers", "tower_id", "true"),
        "fact_usage_metric_tower_to_app_from_fk": ("f_usage", "from_id", "f_towers", "tower_id", "step = 'tower_to_app'"),
        "fact_usage_metric_tower_to_app_to_fk": ("f_usage", "to_id", "f_apps", "app_id", "step = 'tower_to_app'"),
        "fact_usage_metric_app_to_bu_from_fk": ("f_usage", "from_id", "f_apps", "app_id", "step = 'app_to_bu'"),
        "fact_usage_metric_app_to_bu_to_fk": ("f_usage", "to_id", "f_units", "bu_id", "step = 'app_to_bu'"),
    }
    counts = {}
    for name, (table, key, attributes) in dimensions.items():
        counts[f"{name}_conflicting_pk"] = f"SELECT count(*) FROM (SELECT {key} FROM {table} GROUP BY 1 HAVING count(DISTINCT {attributes}) > 1)"
        counts[f"{name}_pk_unique"] = f"SELECT count(*) FROM (SELECT {key} FROM (SELECT DISTINCT * FROM {table}) GROUP BY 1 HAVING count(*) > 1)"
    for name, (table, key, known, known_key, where) in keys.items():
        counts[name] = f"SELECT count(*) FROM {table} WHERE {where} AND {key} IS NOT NULL AND {key} NOT IN (SELECT {known_key} FROM {known})"
    total, actual = "(SELECT sum(CAST(o_totalprice AS DECIMAL(18,2))) FROM orders)", "(SELECT sum(amount_eur) FROM f_gl)"
    counts |= {
        "fact_gl_cost_pk_unique": "SELECT count(*) FROM (SELECT gl_line_id FROM f_gl GROUP BY 1 HAVING count(*) > 1)",
        "fact_gl_cost_non_negative_amount": "SELECT count(*) FROM f_gl WHERE amount_eur < 0",
        "fact_usage_metric_non_negative_value": "SELECT count(*) FROM f_usage WHERE value < 0",
        "fact_gl_cost_reconciliation": f"SELECT CASE WHEN {actual} = {total} THEN 0 ELSE 1 END",
    }
    rows = " UNION ALL ".join(f"SELECT '{name}' AS name, ({count}) AS n" for name, count in counts.items())
    return f"""WITH {GL},{CENTERS},{USAGE},{tables}
SELECT name, n = 0 AS passed, CAST(n AS BIGINT) AS failure_count,
  CASE name WHEN 'dim_cost_center_tower_fk' THEN 'NULL tower_id is intentionally allowed; only non-null tower keys must resolve.'
            WHEN 'fact_gl_cost_tower_fk' THEN 'NULL tower_id is intentionally allowed for the unmapped residual anchor.'
            WHEN 'fact_gl_cost_reconciliation' THEN 'expected=' || CAST({total} AS VARCHAR) || ' actual=' || CAST({actual} AS VARCHAR) END AS detail
FROM ({rows})"""


ALLOCATION = f"""
SELECT gl_line_id, period, gl_account, cost_center_id, tower_id, app_id, bu_id, {money('cents')} AS allocated_amount_eur,
       rule_version, {share('u1')} AS gl_to_tower_proportion, {share('u2')} AS tower_to_app_proportion,
       {share('u3')} AS app_to_bu_proportion
FROM ends WHERE outcome = 'allocated'"""

RESIDUAL = f"""
SELECT gl_line_id, period, gl_account, cost_center_id, tower_id, app_id, {money('cents')} AS amount_eur,
       failed_step, reason_code, rule_version
FROM ends WHERE outcome = 'residual'"""

LINEAGE = "SELECT * FROM lin"

RESIDUAL_REPORT = f"""
SELECT rule_version, failed_step, reason_code, {money('sum(cents)')} AS residual_amount_eur,
       count(DISTINCT gl_line_id) AS gl_line_count,
       {pct('sum(cents)', '(SELECT sum(CAST(amount_eur * 100 AS HUGEINT)) FROM gl)')} AS pct_of_total_gl
FROM ends WHERE outcome = 'residual' GROUP BY rule_version, failed_step, reason_code"""

STRATEGY = f"""
SELECT step, from_id, to_id, {share('units')} AS share,
       CASE WHEN units IS NULL THEN 'driver_zero' END AS reason_code
FROM shares WHERE step <> 'gl_to_tower'"""

BY_PLACE = f"""
SELECT rule_version, outcome, failed_step, reason_code, tower_id, app_id, bu_id, count(*) AS row_count,
       {money('sum(cents)')} AS amount_eur
FROM ends GROUP BY rule_version, outcome, failed_step, reason_code, tower_id, app_id, bu_id"""

_FALL = f"""
SELECT rule_version, gl_line_id, tower_id, {money('cents')} AS amount_eur, failed_step, reason_code,
       {share('u1')} AS gl_to_tower_proportion FROM h1"""

_COMPARED = f""",
pair AS (
  SELECT bu_id, sum(CASE WHEN rule_version = '{V1}' THEN cents ELSE 0 END) AS a,
         sum(CASE WHEN rule_version = '{V2}' THEN cents ELSE 0 END) AS b
  FROM ends WHERE outcome = 'allocated' GROUP BY bu_id
),
pair_total AS (SELECT *, sum(a) OVER () AS ta, sum(b) OVER () AS tb FROM pair),
compared AS (
  SELECT bu_id, substr(bu_id, 4) AS bu_name, {money('a')} AS amount_{V1}, {money('b')} AS amount_{V2},
         {money('b - a')} AS delta_eur, {pct('b - a', 'a')} AS delta_pct,
         coalesce({pct('a', 'ta')}, 0) AS share_v1, coalesce({pct('b', 'tb')}, 0) AS share_v2,
         {pct('b * ta - a * tb', 'ta * tb')} AS share_delta_pp
  FROM pair_total
)"""

_BY_APP = f""",
pair AS (
  SELECT app_id, bu_id, sum(CASE WHEN rule_version = '{V1}' THEN cents ELSE 0 END) AS a,
         sum(CASE WHEN rule_version = '{V2}' THEN cents ELSE 0 END) AS b
  FROM ends WHERE outcome = 'allocated' GROUP BY app_id, bu_id
)"""

# Ledger amount x shares in 10^-26 EUR: the first share is 1 for these rules.
_RAW = "gl_cents * u2 * u3"
_RAW16 = f"((2 * {_RAW} + 10000000000) // 20000000000)"
_DRIFT10 = f"((2 * abs({_RAW16} - cents * 100000000000000) + 1000000) // 2000000)"
# A cent for every hop that divides, passed on by the shares of the hops after it.
_BOUND10 = "CASE WHEN u2 < 1000000000000 THEN u3 / 10000.0 ELSE 0 END + CASE WHEN u3 < 1000000000000 THEN 100000000 ELSE 0 END"
_DEC10 = "CAST(CAST({} AS DECIMAL(18,0)) * CAST(0.0000000001 AS DECIMAL(11,10)) AS DECIMAL(28,10))"


_CRITICALITY = (
    "CASE WHEN p_type IN ('ECONOMY', 'SMALL') THEN 'low' WHEN p_type IN ('MEDIUM', 'STANDARD') THEN 'med' ELSE 'high' END"
)


def _rounded10(value: str) -> str:
    return f"((2 * abs({value}) + 1000000) // 2000000 * sign({value}))"


def oracle_queries() -> dict[str, str]:
    dims = """
SELECT 'dim_cost_center' AS dimension, cost_center_id AS key, name, tower_id AS attribute FROM centers
UNION ALL SELECT 'dim_resource_tower', 'TWR-' || n_nationkey, n_name, r_name FROM nation JOIN region ON r_regionkey = n_regionkey
UNION ALL SELECT DISTINCT 'dim_application', 'APP-' || p_type, p_type,
  CASE WHEN p_type IN ('ECONOMY', 'SMALL') THEN 'low' WHEN p_type IN ('MEDIUM', 'STANDARD') THEN 'med' ELSE 'high' END FROM part
UNION ALL SELECT DISTINCT 'dim_business_unit', 'BU-' || c_mktsegment, c_mktsegment, NULL FROM customer"""
    offered = """
offered AS (
  SELECT CASE WHEN c_mktsegment = 'BUILDING' THEN '2026-1' ELSE '2026-01' END AS period, '70' || c_nationkey AS gl_account,
         CASE WHEN c_acctbal < 9000 THEN 'x' END AS cost_center_id, c_mktsegment, CAST(c_acctbal AS DECIMAL(18,2)) AS amount,
         c_nationkey
  FROM customer
), codes AS (
  SELECT 'period:pattern' AS violation FROM offered WHERE NOT regexp_full_match(period, '[0-9]{4}-[0-9]{2}')
  UNION ALL SELECT 'gl_account:pattern' FROM offered WHERE NOT regexp_full_match(gl_account, '[0-9]{4}')
  UNION ALL SELECT 'cost_center_id:required' FROM offered WHERE cost_center_id IS NULL
  UNION ALL SELECT 'amount_eur:not_a_number' FROM offered WHERE c_mktsegment = 'MACHINERY'
  UNION ALL SELECT 'amount_eur:not_whole_cents' FROM offered WHERE c_mktsegment = 'FURNITURE'
  UNION ALL SELECT 'amount_eur:out_of_range' FROM offered WHERE c_mktsegment <> 'MACHINERY' AND
    (CASE WHEN c_mktsegment = 'FURNITURE' THEN CAST(CAST(amount AS VARCHAR) || '5' AS DECIMAL(18,3)) ELSE amount END) <= 0
  UNION ALL SELECT 'description:required' FROM offered WHERE c_nationkey = 3
)"""
    dq_names = [
        "dim_cost_center_conflicting_pk",
        "dim_resource_tower_conflicting_pk",
        "dim_application_conflicting_pk",
        "dim_business_unit_conflicting_pk",
        "dim_cost_center_pk_unique",
        "dim_resource_tower_pk_unique",
        "dim_application_pk_unique",
        "dim_business_unit_pk_unique",
    ]
    dq_counts = {
        "dim_cost_center_conflicting_pk": "SELECT count(*) FROM (SELECT cost_center_id FROM centers GROUP BY 1 HAVING count(DISTINCT (name, tower_id)) > 1)",
        "dim_resource_tower_conflicting_pk": "SELECT count(*) FROM (SELECT n_nationkey FROM nation GROUP BY 1 HAVING count(DISTINCT (n_name, n_regionkey)) > 1)",
        "dim_application_conflicting_pk": f"SELECT count(*) FROM (SELECT 'APP-' || p_type FROM part GROUP BY 1 HAVING count(DISTINCT (p_type, {_CRITICALITY})) > 1)",
        "dim_business_unit_conflicting_pk": "SELECT count(*) FROM (SELECT 'BU-' || c_mktsegment FROM customer GROUP BY 1 HAVING count(DISTINCT c_mktsegment) > 1)",
        "dim_cost_center_pk_unique": "SELECT count(*) FROM (SELECT cost_center_id FROM (SELECT DISTINCT * FROM centers) GROUP BY 1 HAVING count(*) > 1)",
        "dim_resource_tower_pk_unique": "SELECT count(*) FROM (SELECT n_nationkey FROM (SELECT DISTINCT * FROM nation) GROUP BY 1 HAVING count(*) > 1)",
        "dim_application_pk_unique": f"SELECT count(*) FROM (SELECT app_id FROM (SELECT DISTINCT 'APP-' || p_type AS app_id, p_type, {_CRITICALITY} AS criticality FROM part) GROUP BY 1 HAVING count(*) > 1)",
        "dim_business_unit_pk_unique": "SELECT count(*) FROM (SELECT bu_id FROM (SELECT DISTINCT 'BU-' || c_mktsegment AS bu_id, c_mktsegment FROM customer) GROUP BY 1 HAVING count(*) > 1)",
        "fact_gl_cost_pk_unique": "SELECT count(*) FROM (SELECT gl_line_id FROM gl GROUP BY 1 HAVING count(*) > 1)",
        "dim_cost_center_tower_fk": "SELECT count(*) FROM centers WHERE tower_id IS NOT NULL AND tower_id NOT IN (SELECT 'TWR-' || n_nationkey FROM nation)",
        "fact_gl_cost_cost_center_fk": "SELECT count(*) FROM gl WHERE cost_center_id NOT IN (SELECT cost_center_id FROM centers)",
        "fact_gl_cost_tower_fk": "SELECT count(*) FROM gl WHERE tower_id IS NOT NULL AND tower_id NOT IN (SELECT 'TWR-' || n_nationkey FROM nation)",
        "fact_usage_metric_tower_to_app_from_fk": "SELECT count(*) FROM usage WHERE step = 'tower_to_app' AND from_id NOT IN (SELECT 'TWR-' || n_nationkey FROM nation)",
        "fact_usage_metric_tower_to_app_to_fk": "SELECT count(*) FROM usage WHERE step = 'tower_to_app' AND to_id NOT IN (SELECT 'APP-' || p_type FROM part)",
        "fact_usage_metric_app_to_bu_from_fk": "SELECT count(*) FROM usage WHERE step = 'app_to_bu' AND from_id NOT IN (SELECT 'APP-' || p_type FROM part)",
        "fact_usage_metric_app_to_bu_to_fk": "SELECT count(*) FROM usage WHERE step = 'app_to_bu' AND to_id NOT IN (SELECT 'BU-' || c_mktsegment FROM customer)",
        "fact_gl_cost_non_negative_amount": "SELECT count(*) FROM gl WHERE amount_eur < 0",
        "fact_usage_metric_non_negative_value": "SELECT count(*) FROM usage WHERE value < 0",
        "fact_gl_cost_reconciliation": "SELECT CASE WHEN (SELECT sum(amount_eur) FROM gl) = (SELECT sum(CAST(o_totalprice AS DECIMAL(18,2))) FROM orders) THEN 0 ELSE 1 END",
    }
    dq_details = {
        "dim_cost_center_tower_fk": "'NULL tower_id is intentionally allowed; only non-null tower keys must resolve.'",
        "fact_gl_cost_tower_fk": "'NULL tower_id is intentionally allowed for the unmapped residual anchor.'",
        "fact_gl_cost_reconciliation": "'expected=' || (SELECT CAST(sum(CAST(o_totalprice AS DECIMAL(18,2))) AS VARCHAR) FROM orders) || ' actual=' || (SELECT CAST(sum(amount_eur) AS VARCHAR) FROM gl)",
    }
    assert set(dq_names) <= set(dq_counts)
    dq = " UNION ALL ".join(
        f"SELECT '{name}' AS name, ({count}) = 0 AS passed, CAST(({count}) AS BIGINT) AS failure_count, "
        f"CAST({dq_details.get(name, 'NULL')} AS VARCHAR) AS detail"
        for name, count in dq_counts.items()
    )
    table_counts = {
        "gl_costs": ("orders", "gl_line_id,period,gl_account,cost_center_id,amount_eur,description"),
        "cost_centers": ("customer", "cost_center_id,cost_center_name,tower_id"),
        "resource_towers": ("nation", "tower_id,tower_name,tower_type"),
        "applications": ("(SELECT DISTINCT p_type FROM part)", "app_id,app_name,business_criticality"),
        "business_units": ("(SELECT DISTINCT c_mktsegment FROM customer)", "bu_id,bu_name"),
        "usage_metrics": ("usage", "metric_id,period,step,from_id,to_id,metric_name,value"),
    }
    headers = " UNION ALL ".join(
        f"SELECT '{name}' AS table_name, '{columns}' AS header, count(*) AS row_count, count(*) AS sound_count FROM {source}"
        for name, (source, columns) in table_counts.items()
    )
    totals = ", ".join(
        f"{money(f'coalesce(sum(cents) FILTER (outcome = {chr(39)}{o}{chr(39)}), 0)')} AS total_{n}_eur"
        for n, o in (("allocated", "allocated"), ("residual", "residual"))
    )
    gl_total = "(SELECT sum(CAST(amount_eur * 100 AS HUGEINT)) FROM gl)"
    worked = f""",
paths AS (
  SELECT rule_version, min(gl_line_id) AS gl_line_id FROM (
    SELECT rule_version, gl_line_id FROM ends WHERE outcome = 'allocated' GROUP BY ALL HAVING count(*) > 1)
  GROUP BY rule_version
),
center AS (
  SELECT min(cost_center_id) AS cost_center_id FROM ends
  WHERE outcome = 'residual' AND cost_center_id IN (SELECT cost_center_id FROM centers WHERE tower_id IS NULL)
),
left_over AS (
  SELECT rule_version, min(gl_line_id) AS gl_line_id FROM ends
  WHERE outcome = 'residual' AND cost_center_id = (SELECT cost_center_id FROM center) GROUP BY rule_version
),
numbered AS (
  SELECT gl_line_id, rule_version, outcome, app_id, bu_id, tower_id, failed_step, reason_code,
         {_rounded10(_RAW16)} AS raw10, cents FROM ends
)"""
    picked = f"""
SELECT lin.*, CASE WHEN lin.outcome = 'allocated' THEN {_DEC10.format('n.raw10')} END AS raw_product_eur,
       CASE WHEN lin.outcome = 'allocated' THEN {_DEC10.format('n.cents * 100000000 - n.raw10')} END AS difference_from_raw_eur
FROM lin JOIN numbered n ON n.gl_line_id = lin.gl_line_id AND n.rule_version = lin.rule_version AND n.outcome = lin.outcome
  AND n.app_id IS NOT DISTINCT FROM lin.app_id AND n.bu_id IS NOT DISTINCT FROM lin.bu_id
WHERE (lin.outcome = 'allocated' AND (lin.rule_version, lin.gl_line_id) IN (SELECT (rule_version, gl_line_id) FROM paths))
   OR (lin.outcome = 'residual' AND (lin.rule_version, lin.gl_line_id) IN (SELECT (rule_version, gl_line_id) FROM left_over))"""
    distributed = split_sql(
        f"""
SELECT gl_line_id, to_id, {share('units')} AS share, {money('floor_cents + CASE WHEN position <= spare THEN 1 ELSE 0 END')} AS amount_eur
FROM (
  SELECT gl_line_id, to_id, units, floor_cents,
         row_number() OVER (PARTITION BY gl_line_id ORDER BY rest DESC, units DESC, to_id) AS position,
         cents - sum(floor_cents) OVER (PARTITION BY gl_line_id) AS spare
  FROM (
    SELECT gl_line_id, to_id, units, CAST(amount_eur * 100 AS HUGEINT) AS cents,
           CAST(amount_eur * 100 AS HUGEINT) * units // {ONE} AS floor_cents,
           CAST(amount_eur * 100 AS HUGEINT) * units % {ONE} AS rest
    FROM gl CROSS JOIN shares WHERE step = 'gl_to_tower'))""",
        "even",
    )
    metric = "coalesce((SELECT {} FROM idx i WHERE i.step = r.step AND i.metric_name = r.metric_name), 0)"
    return {
        "scan_csv": f"WITH {GL} SELECT gl_line_id, period, gl_account, cost_center_id, amount_eur, description FROM gl",
        "header_check": usage_sql(headers),
        "scan_table": usage_sql("SELECT metric_id, period, step, from_id, to_id, metric_name, value FROM usage"),
        "write_table": cascade_sql(RESIDUAL),
        "rules_table": f"WITH {USAGE},{rule_rows(MAIN_RULES)} "
        "SELECT rule_version AS version_id, step, CASE WHEN step = 'gl_to_tower' THEN 'cost_center_mapping' END AS basis, "
        f"strategy, metric_name, {metric.format('count(DISTINCT from_id)')} AS source_count, "
        f"{metric.format('count(DISTINCT to_id)')} AS target_count, "
        f"CAST({metric.format('sum(signal)')} AS DECIMAL(26,2)) AS signal_total FROM rules r",
        "rule_violations": usage_sql(
            """
SELECT version_id, step, violation FROM (VALUES
  ('bad_sum', 'app_to_bu', 'proportions_do_not_sum_to_one'), ('negative', 'tower_to_app', 'values_negative'),
  ('empty', 'tower_to_app', 'values_empty'), ('fall_consumption', 'gl_to_tower', 'fallback_cannot_be_consumption'),
  ('unknown', 'tower_to_app', 'strategy_unknown')) AS fixed(version_id, step, violation)
UNION ALL
SELECT version_id, step, 'metric_unknown_for_step' FROM (VALUES
  ('wrong_step', 'tower_to_app', 'order_lines'), ('wrong_step', 'app_to_bu', 'order_lines'),
  ('no_metric', 'tower_to_app', 'shipped_units'), ('no_metric', 'app_to_bu', 'headcount'),
  ('bad_sum', 'tower_to_app', 'shipped_units'), ('negative', 'app_to_bu', 'order_lines'),
  ('empty', 'app_to_bu', 'order_lines'), ('fall_consumption', 'tower_to_app', 'shipped_units'),
  ('fall_consumption', 'app_to_bu', 'order_lines'), ('unknown', 'app_to_bu', 'order_lines')
) AS wanted(version_id, step, metric_name)
WHERE NOT EXISTS (SELECT 1 FROM usage u WHERE u.step = wanted.step AND u.metric_name = wanted.metric_name)"""
        ),
        "contract_violations": f"WITH {offered} SELECT 'gl_costs' AS table_name, violation, count(*) AS row_count FROM codes GROUP BY violation",
        "quarantine": """
WITH offered AS (
  SELECT ' CC-' || c_custkey || ' ' AS gl_line_id, concat_ws(',',
    CASE WHEN c_mktsegment = 'BUILDING' THEN 'period:pattern' END,
    CASE WHEN c_nationkey < 10 THEN 'gl_account:pattern' END,
    CASE WHEN c_acctbal >= 9000 THEN 'cost_center_id:required' END,
    CASE WHEN c_mktsegment = 'MACHINERY' THEN 'amount_eur:not_a_number' END,
    CASE WHEN c_mktsegment = 'FURNITURE' THEN 'amount_eur:not_whole_cents' END,
    CASE WHEN c_mktsegment <> 'MACHINERY' AND
      (CASE WHEN c_mktsegment = 'FURNITURE' THEN CAST(CAST(CAST(c_acctbal AS DECIMAL(18,2)) AS VARCHAR) || '5' AS DECIMAL(18,3)) ELSE CAST(c_acctbal AS DECIMAL(18,2)) END) <= 0
      THEN 'amount_eur:out_of_range' END,
    CASE WHEN c_nationkey = 3 THEN 'description:required' END) AS reasons
  FROM customer
)
SELECT gl_line_id, reasons, (SELECT count(*) FROM offered WHERE reasons = '') AS sound_count FROM offered WHERE reasons <> ''
""",
        "conform_dims": f"WITH {CENTERS} {dims}",
        "conform_gl_cost": f"WITH {GL} SELECT gl_line_id, period, gl_account, cost_center_id, amount_eur, tower_id FROM gl",
        "conform_usage": usage_sql("SELECT metric_id, period, step, from_id, to_id, metric_name, value FROM usage"),
        "dq_duplicate_keys": "SELECT l_orderkey, l_linenumber, count(*) AS row_count FROM lineitem GROUP BY ALL HAVING count(*) > 1",
        "dq_conflicting_keys": "SELECT c_nationkey, count(DISTINCT c_mktsegment) AS variant_count FROM customer GROUP BY 1 HAVING count(DISTINCT c_mktsegment) > 1",
        "dq_fk_anti_join": usage_sql(
            "SELECT tower_id AS key_value, count(*) AS row_count FROM centers WHERE tower_id IS NOT NULL AND tower_id NOT IN "
            "(SELECT from_id FROM usage WHERE step = 'tower_to_app') GROUP BY tower_id"
        ),
        "dq_report": usage_sql(dq),
        "dq_report_faulty": faulty_sql(),
        "usage_index": usage_sql("SELECT step, from_id, metric_name, to_id, signal FROM idx"),
        "usage_metrics_by_step": usage_sql(
            "SELECT step, metric_name, count(DISTINCT from_id) AS source_count, CAST(sum(signal) AS DECIMAL(26,2)) AS signal_total "
            "FROM idx GROUP BY step, metric_name"
        ),
        "normalize_shares": split_sql(
            "SELECT step, from_id, to_id, CAST(raw AS DECIMAL(26,0)) AS raw, CAST(units AS BIGINT) AS units FROM shares", "units"
        ),
        "strategy_even_spread": split_sql(STRATEGY, "even"),
        "strategy_weighted": split_sql(STRATEGY, "weights"),
        "strategy_consumption": split_sql(STRATEGY, "units"),
        "strategy_manual_override": split_sql(STRATEGY, "declared"),
        "distribute_amount": distributed,
        "distribute_amount_wide": distributed,
        "gl_to_tower": cascade_sql(_FALL),
        "gl_to_tower_fallback": cascade_sql(_FALL, FALLBACK_RULES),
        "tower_to_app": cascade_sql(
            f"SELECT rule_version, gl_line_id, tower_id, app_id, {money('cents')} AS amount_eur, failed_step, reason_code, "
            f"{share('u2')} AS tower_to_app_proportion FROM h2"
        ),
        "app_to_bu": cascade_sql(
            f"SELECT rule_version, gl_line_id, tower_id, app_id, {money('cents')} AS amount_eur, failed_step, reason_code, bu_id, "
            f"outcome, {share('u3')} AS app_to_bu_proportion FROM ends"
        ),
        "cascade_allocation": cascade_sql(ALLOCATION),
        "cascade_residual": cascade_sql(RESIDUAL),
        "cascade_shuffled": cascade_sql(ALLOCATION),
        "cascade_all_strategies": cascade_sql(BY_PLACE, STRATEGY_RULES),
        "cascade_with_fallback": cascade_sql(BY_PLACE, FALLBACK_RULES),
        "residual_by_reason": cascade_sql(
            f"SELECT rule_version, failed_step, reason_code, count(*) AS row_count, {money('sum(cents)')} AS amount_eur "
            "FROM ends WHERE outcome = 'residual' GROUP BY rule_version, failed_step, reason_code"
        ),
        "residual_detail": cascade_sql(
            f"SELECT gl_line_id, {money('cents')} AS amount_eur, gl_account, cost_center_id, cost_center_name, failed_step, "
            "reason_code, rule_version, app_id FROM ends WHERE outcome = 'residual'"
        ),
        "residual_report": cascade_sql(RESIDUAL_REPORT),
        "report_residual": cascade_sql(RESIDUAL_REPORT),
        "reconciliation": cascade_sql(
            f"SELECT rule_version, {money(gl_total)} AS total_gl_eur, {totals}, "
            f"{gl_total} = sum(cents) AS balanced, {money(f'{gl_total} - sum(cents)')} AS difference_eur FROM ends GROUP BY rule_version"
        ),
        "recon_by_line": cascade_sql(
            f"SELECT rule_version, gl_line_id, {money('max(gl_cents)')} AS expected_eur, {money('sum(cents)')} AS actual_eur, "
            "max(gl_cents) = sum(cents) AS balanced FROM ends GROUP BY rule_version, gl_line_id"
        ),
        "lineage": cascade_sql(LINEAGE),
        "report_lineage": cascade_sql(LINEAGE),
        "lineage_completeness": cascade_sql(
            "SELECT rule_version, gl_line_id, max(gl_amount_eur) AS expected_eur, CAST(sum(terminal_amount_eur) AS DECIMAL(18,2)) AS actual_eur, "
            "max(gl_amount_eur) = sum(terminal_amount_eur) AS balanced FROM lin GROUP BY rule_version, gl_line_id"
        ),
        "lineage_round_trip": cascade_sql(
            f"SELECT rule_version, {money(gl_total)} AS total_gl_eur, allocated AS total_lineage_allocated_eur, "
            f"residual AS total_lineage_residual_eur, allocated + residual = {money(gl_total)} AS balanced, "
            f"CAST({money(gl_total)} - allocated - residual AS DECIMAL(18,2)) AS difference_eur, "
            f"allocated = {money('gold_allocated')} AS matches_allocation, residual = {money('gold_residual')} AS matches_residual "
            "FROM (SELECT rule_version, CAST(coalesce(sum(allocated_amount_eur), 0) AS DECIMAL(18,2)) AS allocated, "
            "CAST(coalesce(sum(residual_amount_eur), 0) AS DECIMAL(18,2)) AS residual FROM lin GROUP BY rule_version) "
            "JOIN (SELECT rule_version, sum(CASE WHEN outcome = 'allocated' THEN cents ELSE 0 END) AS gold_allocated, "
            "sum(CASE WHEN outcome = 'residual' THEN cents ELSE 0 END) AS gold_residual FROM ends GROUP BY rule_version) USING (rule_version)"
        ),
        "trace_forward": cascade_sql(f"SELECT * FROM lin WHERE rule_version = '{V1}' AND gl_account = '7001'"),
        "trace_backward": cascade_sql(
            f"SELECT * FROM lin WHERE rule_version = '{V2}' AND outcome = 'allocated' AND bu_id = 'BU-MACHINERY' AND app_id = 'APP-STANDARD'"
        ),
        "proportion_drift": cascade_sql(
            f"SELECT rule_version, app_id, bu_id, count(*) AS path_count, "
            f"count(*) FILTER ({_DRIFT10} > {_BOUND10}) AS outside_count, "
            f"CAST({_DEC10.format(f'max({_DRIFT10})')} AS DECIMAL(18,10)) AS max_drift_eur "
            "FROM ends WHERE outcome = 'allocated' GROUP BY rule_version, app_id, bu_id"
        ),
        "worked_example": cascade_sql(picked, extra=worked),
        "application_tco": cascade_sql(
            f"""
SELECT rule_version, app_id, substr(app_id, 5) AS app_name,
       CASE WHEN app_id IN ('APP-ECONOMY', 'APP-SMALL') THEN 'low' WHEN app_id IN ('APP-MEDIUM', 'APP-STANDARD') THEN 'med' ELSE 'high' END AS business_criticality,
       {money('c')} AS allocated_amount_eur, {pct('c', 'sum(c) OVER (PARTITION BY rule_version)')} AS pct_of_allocated, contributing_gl_line_count
FROM (SELECT rule_version, app_id, sum(cents) AS c, count(DISTINCT gl_line_id) AS contributing_gl_line_count
      FROM ends WHERE outcome = 'allocated' GROUP BY rule_version, app_id)"""
        ),
        "bu_showback": cascade_sql(
            f"""
SELECT rule_version, bu_id, substr(bu_id, 4) AS bu_name, {money('c')} AS allocated_amount_eur,
       {pct('c', 'sum(c) OVER (PARTITION BY rule_version)')} AS pct_of_allocated, contributing_app_count, contributing_gl_line_count
FROM (SELECT rule_version, bu_id, sum(cents) AS c, count(DISTINCT app_id) AS contributing_app_count,
             count(DISTINCT gl_line_id) AS contributing_gl_line_count
      FROM ends WHERE outcome = 'allocated' GROUP BY rule_version, bu_id)"""
        ),
        "driver_comparison": cascade_sql("SELECT * FROM compared", extra=_COMPARED),
        "driver_comparison_by_app": cascade_sql(
            f"SELECT app_id, substr(app_id, 5) AS app_name, bu_id, substr(bu_id, 4) AS bu_name, {money('a')} AS amount_{V1}, "
            f"{money('b')} AS amount_{V2}, {money('b - a')} AS delta_eur FROM pair",
            extra=_BY_APP,
        ),
        "top_bu_flip": cascade_sql(
            "SELECT app_id, top_bu_v1, top_bu_v2, top_bu_v1 IS DISTINCT FROM top_bu_v2 AS flipped FROM ("
            "SELECT app_id, min(bu_id) FILTER (a <> 0 AND a = ma) AS top_bu_v1, min(bu_id) FILTER (b <> 0 AND b = mb) AS top_bu_v2 "
            "FROM (SELECT *, max(a) OVER (PARTITION BY app_id) AS ma, max(b) OVER (PARTITION BY app_id) AS mb FROM pair) GROUP BY app_id)",
            extra=_BY_APP,
        ),
        "max_share_swing": cascade_sql("SELECT max(abs(share_delta_pp)) AS max_share_swing FROM compared", extra=_COMPARED),
    }
