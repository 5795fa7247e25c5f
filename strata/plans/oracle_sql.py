"""DuckDB oracles, one per registered query.

Each oracle restates the query from the raw driver tables with plain SQL:
the fixtures as CTEs, reachability as a recursive ``UNION`` (set semantics, so
it ends on cyclic graphs), calendars with ``range()``. Column names and types
match the Spark results.
"""

from __future__ import annotations

# -- fixtures (FIXTURES.md §3) ------------------------------------------------

ORDER_EDGE_COLS = """CAST(o_custkey % 4 AS INTEGER) AS tenant_id, 'D' || o_custkey AS dimension_id,
  'L' || (o_orderkey % 16) AS child, 'L' || ((o_orderkey // 16) % 16) AS parent"""

DIM_EDGES = f"SELECT DISTINCT {ORDER_EDGE_COLS} FROM orders"
DIM_EDGES_OPEN = f"SELECT DISTINCT {ORDER_EDGE_COLS} FROM orders WHERE o_orderstatus <> 'P'"

HIER_EDGES = """SELECT DISTINCT CAST(o_custkey % 4 AS VARCHAR) AS tenant_id, 'D' || o_custkey AS dimension_id,
  'H' || year(o_orderdate) AS hierarchy_id, 'hierarchy ' || year(o_orderdate) AS hierarchy_name,
  'L' || (o_orderkey % 16) AS from_level, 'L' || ((o_orderkey // 16) % 16) AS to_level FROM orders"""

GEO_EDGES = """SELECT DISTINCT 0 AS tenant_id, 'geo' AS dimension_id, child, parent FROM (
  SELECT c_name AS child, n_name AS parent FROM customer JOIN nation ON c_nationkey = n_nationkey
  UNION ALL SELECT n_name, r_name FROM nation JOIN region ON n_regionkey = r_regionkey
  UNION ALL SELECT s_name, n_name FROM supplier JOIN nation ON s_nationkey = n_nationkey
  UNION ALL SELECT s_name, r_name FROM supplier JOIN nation ON s_nationkey = n_nationkey
                                   JOIN region ON n_regionkey = r_regionkey)"""

PART_EDGES = """SELECT DISTINCT 0 AS tenant_id, 'part' AS dimension_id, child, parent FROM (
  SELECT 'P' || p_partkey AS child, concat_ws(' ', p_brand, p_type) AS parent FROM part
  UNION ALL SELECT concat_ws(' ', p_brand, p_type), p_type FROM part)"""

LEVEL_EDGES = f"{DIM_EDGES} UNION ALL {GEO_EDGES} UNION ALL {PART_EDGES}"


def closure(edges_cte: str = "e", keys: str = "dimension_id", child: str = "child",
            parent: str = "parent") -> str:
    """Recursive CTE body ``r(g, x, y)``: y is reachable from x in >= 1 step."""
    return f"""r(g, x, y) AS (
  SELECT {keys}, {child}, {parent} FROM {edges_cte}
  UNION SELECT r.g, r.x, {edges_cte}.{parent} FROM r JOIN {edges_cte}
    ON {edges_cte}.{keys} = r.g AND {edges_cte}.{child} = r.y)"""


def residue_cte(edges_cte: str = "e", keys: str = "dimension_id", child: str = "child",
                parent: str = "parent") -> str:
    """``res``: edges whose parent is on a cycle or reaches one (needs ``r``)."""
    return f"""cyc AS (SELECT DISTINCT g, x AS node FROM r WHERE x = y),
res AS (SELECT * FROM {edges_cte} e2 WHERE EXISTS (
  SELECT 1 FROM cyc WHERE cyc.g = e2.{keys} AND cyc.node = e2.{parent})
  OR EXISTS (SELECT 1 FROM r JOIN cyc ON cyc.g = r.g AND cyc.node = r.y
             WHERE r.g = e2.{keys} AND r.x = e2.{parent}))"""


DIM_VALIDITY = f"""WITH RECURSIVE e AS ({DIM_EDGES}),
{closure()},
{residue_cte()},
cnt AS (SELECT dimension_id, count(*) AS n_edges FROM e GROUP BY dimension_id),
rc AS (SELECT dimension_id, count(*) AS n_residue FROM res GROUP BY dimension_id)
SELECT cnt.dimension_id, cnt.n_edges, coalesce(rc.n_residue, 0) AS n_residue,
  CASE WHEN rc.n_residue > 0 THEN 'CYCLE' END AS reason, rc.n_residue IS NULL AS valid
FROM cnt LEFT JOIN rc USING (dimension_id)"""


def _with_residue(edges_sql: str, extra: str = "") -> str:
    return f"""WITH RECURSIVE e AS ({edges_sql}),
{closure()},
{residue_cte()}{extra}"""


EDGE_TABLE_VALIDITY = f"""{_with_residue(DIM_EDGES_OPEN)},
grp AS (SELECT DISTINCT tenant_id, dimension_id FROM ({DIM_EDGES})),
cnt AS (SELECT tenant_id, dimension_id, count(*) AS n_edges FROM e GROUP BY ALL),
rc AS (SELECT tenant_id, dimension_id, count(*) AS n_residue FROM res GROUP BY ALL)
SELECT grp.tenant_id, grp.dimension_id, coalesce(cnt.n_edges, 0) AS n_edges,
  coalesce(rc.n_residue, 0) AS n_residue,
  CASE WHEN coalesce(rc.n_residue, 0) > 0 THEN 'CYCLE' END AS reason,
  coalesce(rc.n_residue, 0) = 0 AS valid
FROM grp LEFT JOIN cnt USING (tenant_id, dimension_id) LEFT JOIN rc USING (tenant_id, dimension_id)"""

#: Restated from SURVEY D2 over all rows: an edge stays iff its parent is on a cycle or leads up to one.
EDGE_TABLE_VALIDITY_ALL = f"""WITH RECURSIVE e AS ({DIM_EDGES}),
up AS (SELECT tenant_id, dimension_id, child AS low, parent AS high FROM e
       UNION SELECT up.tenant_id, up.dimension_id, up.low, e.parent FROM up
       JOIN e ON e.tenant_id = up.tenant_id AND e.dimension_id = up.dimension_id AND e.child = up.high),
circle AS (SELECT tenant_id, dimension_id, low AS node FROM up WHERE low = high),
bad AS (SELECT tenant_id, dimension_id, node FROM circle
        UNION SELECT up.tenant_id, up.dimension_id, up.low FROM up
        JOIN circle c ON c.tenant_id = up.tenant_id AND c.dimension_id = up.dimension_id AND c.node = up.high),
grp AS (SELECT tenant_id, dimension_id FROM e
        UNION SELECT CAST(c_custkey % 4 AS INT), 'D' || c_custkey FROM customer),
cnt AS (SELECT e.tenant_id, e.dimension_id, count(*) AS n_edges, count(bad.node) AS n_residue FROM e
        LEFT JOIN bad ON bad.tenant_id = e.tenant_id AND bad.dimension_id = e.dimension_id AND bad.node = e.parent GROUP BY ALL)
SELECT grp.tenant_id, grp.dimension_id, coalesce(n_edges, 0) AS n_edges, coalesce(n_residue, 0) AS n_residue,
  CASE WHEN n_residue > 0 THEN 'CYCLE' END AS reason, coalesce(n_residue, 0) = 0 AS valid
FROM grp LEFT JOIN cnt USING (tenant_id, dimension_id)"""

VALID_DIMENSIONS = f"""{_with_residue(DIM_EDGES)}
SELECT tenant_id, dimension_id, child, parent FROM e WHERE dimension_id NOT IN (SELECT g FROM cyc)"""

CYCLE_RESIDUE = f"""{_with_residue(DIM_EDGES)}
SELECT tenant_id, dimension_id, child, parent FROM res"""

NODE_SET = f"""WITH e AS ({DIM_EDGES})
SELECT dimension_id, child AS node FROM e UNION SELECT dimension_id, parent FROM e"""

DIM_PROFILE = f"""WITH e AS ({LEVEL_EDGES}),
n AS (SELECT dimension_id, child AS node, 1 AS o, 0 AS i FROM e
      UNION ALL SELECT dimension_id, parent, 0, 1 FROM e),
d AS (SELECT dimension_id, node, sum(o) AS od, sum(i) AS idg FROM n GROUP BY ALL)
SELECT dimension_id, CAST(sum(od) AS BIGINT) AS n_edges, count(*) AS n_nodes,
  count(*) FILTER (WHERE od = 0) AS n_roots, count(*) FILTER (WHERE idg = 0) AS n_leaves
FROM d GROUP BY dimension_id"""

ROOT_EDGES_WHERE = """NOT EXISTS (SELECT 1 FROM e e2 WHERE e2.dimension_id = e.dimension_id
                                    AND e2.child = e.parent)"""

ROOT_EDGES = f"""WITH e AS ({DIM_EDGES}) SELECT * FROM e WHERE {ROOT_EDGES_WHERE}"""

EDGES_MINUS_ROOTS = f"""WITH e AS ({DIM_EDGES})
SELECT * FROM e EXCEPT SELECT * FROM e WHERE {ROOT_EDGES_WHERE}"""

ADJ = f"""SELECT dimension_id, child AS level, string_agg(parent, ',' ORDER BY parent) AS parents,
  count(*) AS n_parents FROM ({DIM_EDGES}) GROUP BY dimension_id, child"""

DIM_CONFIG_PARSE = f"""SELECT string_agg(DISTINCT CAST(tenant_id AS VARCHAR), ',') AS tenant_ids,
  dimension_id, child AS dimension_level, string_agg(parent, ',' ORDER BY parent) AS parents,
  count(*) AS n_parents FROM ({DIM_EDGES}) GROUP BY dimension_id, child"""

HIER_CONFIG_PARSE = f"""SELECT tenant_id, dimension_id, hierarchy_id, from_level, hierarchy_name, to_level
FROM ({HIER_EDGES})"""

HIER_CONFIG_TENANT_ARRAY = f"""SELECT tenant_id AS tenant_ids, CAST(1 AS BIGINT) AS n_tenants,
  dimension_id, hierarchy_id, from_level, hierarchy_name, to_level FROM ({HIER_EDGES})"""

DIM_JSON_PARSE = f"SELECT DISTINCT dimension_id, child, parent FROM ({DIM_EDGES})"

EXPLODE_PARENTS = f"""SELECT CAST(tenant_id AS VARCHAR) AS tenant_ids, dimension_id,
  child AS dimension_level, parent AS parent_level FROM ({DIM_EDGES})"""

DIM_OF_TENANT = f"SELECT * FROM ({DIM_EDGES}) WHERE tenant_id = 1"

DIM_REPORT = f"""{_with_residue(DIM_EDGES)},
lv AS (SELECT dimension_id, child AS level FROM e UNION SELECT dimension_id, parent FROM e),
nl AS (SELECT dimension_id, count(*) AS n_levels FROM lv GROUP BY ALL),
cnt AS (SELECT dimension_id, count(*) AS n_edges,
        string_agg(DISTINCT CAST(tenant_id AS VARCHAR), ',') AS tenant_ids FROM e GROUP BY ALL),
rc AS (SELECT dimension_id, count(*) AS n_residue FROM res GROUP BY ALL)
SELECT cnt.dimension_id, tenant_ids, n_levels, n_edges, coalesce(rc.n_residue, 0) AS n_residue,
  CASE WHEN rc.n_residue > 0 THEN 'CYCLE' END AS reason, rc.n_residue IS NULL AS valid
FROM cnt JOIN nl USING (dimension_id) LEFT JOIN rc USING (dimension_id)"""

DIM_JSON_VALIDITY = f"""{_with_residue(DIM_EDGES)}
SELECT DISTINCT dimension_id, dimension_id NOT IN (SELECT g FROM cyc) AS valid,
  'The dimension is ' || CASE WHEN dimension_id NOT IN (SELECT g FROM cyc) THEN 'valid.'
                              ELSE 'not valid.' END AS answer FROM e"""

# -- hierarchies ----------------------------------------------------------------

HK_COLS = "tenant_id, dimension_id, hierarchy_id, hierarchy_name"

PATH_EDGES = f"""pe AS (SELECT DISTINCT {HK_COLS}, from_level, to_level,
  tenant_id || '|' || dimension_id || '|' || hierarchy_id || '|' || hierarchy_name AS hk
  FROM ({HIER_EDGES}) WHERE from_level IS NOT NULL AND to_level IS NOT NULL),
grp AS (SELECT DISTINCT {HK_COLS}, hk FROM pe),
nd AS (SELECT hk, from_level AS node, 1 AS o, 0 AS i FROM pe UNION ALL SELECT hk, to_level, 0, 1 FROM pe),
deg AS (SELECT hk, node, sum(o) AS od, sum(i) AS idg FROM nd GROUP BY ALL),
st AS (SELECT hk, CAST(sum(od) AS BIGINT) AS n_edges, CAST(max(od) AS BIGINT) AS max_out,
       CAST(max(idg) AS BIGINT) AS max_in, count(*) FILTER (WHERE idg = 0) AS n_starts
       FROM deg GROUP BY hk)"""

HIER_BASE = f"""WITH RECURSIVE d AS ({DIM_EDGES_OPEN}),
dr(g, x, y) AS (SELECT dimension_id, child, parent FROM d
  UNION SELECT dr.g, dr.x, d.parent FROM dr JOIN d ON d.dimension_id = dr.g AND d.child = dr.y),
dcyc AS (SELECT DISTINCT g FROM dr WHERE x = y),
dims AS (SELECT DISTINCT dimension_id, dimension_id NOT IN (SELECT g FROM dcyc) AS dimension_valid FROM d),
{PATH_EDGES},
pr(g, x, y) AS (SELECT hk, from_level, to_level FROM pe
  UNION SELECT pr.g, pr.x, pe.to_level FROM pr JOIN pe ON pe.hk = pr.g AND pe.from_level = pr.y),
pcyc AS (SELECT DISTINCT g FROM pr WHERE x = y),
mem AS (SELECT pe.*, EXISTS (SELECT 1 FROM d WHERE d.dimension_id = pe.dimension_id
          AND d.child = pe.from_level AND d.parent = pe.to_level) AS in_dimension FROM pe),
miss AS (SELECT hk, count(*) FILTER (WHERE NOT in_dimension) AS n_missing FROM mem GROUP BY hk),
hv AS (SELECT grp.*, coalesce(st.n_edges, 0) AS n_edges,
  CASE WHEN coalesce(st.n_edges, 0) = 0 THEN 'EMPTY'
       WHEN dims.dimension_id IS NULL THEN 'UNKNOWN_DIMENSION'
       WHEN NOT dims.dimension_valid THEN 'INVALID_DIMENSION'
       WHEN st.max_out > 1 THEN 'MULTI_PARENT'
       WHEN pcyc.g IS NOT NULL THEN 'CYCLE'
       WHEN st.max_in > 1 OR st.n_starts <> 1 THEN 'NOT_A_CHAIN'
       WHEN miss.n_missing > 0 THEN 'EDGE_NOT_IN_DIMENSION' END AS reason
  FROM grp LEFT JOIN st USING (hk) LEFT JOIN miss USING (hk)
  LEFT JOIN dims ON dims.dimension_id = grp.dimension_id LEFT JOIN pcyc ON pcyc.g = grp.hk)"""

HIER_VALIDITY = f"""{HIER_BASE}
SELECT {HK_COLS}, n_edges, reason, reason IS NULL AS valid FROM hv"""

VALID_HIERARCHIES = f"""{HIER_BASE}
SELECT pe.tenant_id, pe.dimension_id, pe.hierarchy_id, pe.hierarchy_name, from_level, to_level
FROM pe JOIN hv USING (hk) WHERE hv.reason IS NULL"""

PATH_EXPLODE = f"""{HIER_BASE}
SELECT pe.tenant_id, pe.dimension_id, pe.hierarchy_id, pe.hierarchy_name,
  from_level AS child_level, to_level AS parent_level
FROM pe JOIN hv USING (hk) WHERE hv.reason IS NULL"""

PATH_INVERTED = f"""{HIER_BASE}
SELECT pe.tenant_id, pe.dimension_id, pe.hierarchy_id, pe.hierarchy_name,
  to_level AS parent_level, from_level AS child_level,
  CAST(1 + (SELECT count(DISTINCT y) FROM pr WHERE pr.g = pe.hk AND pr.x = pe.to_level) AS INTEGER) AS step
FROM pe JOIN hv USING (hk) WHERE hv.reason IS NULL"""

PATH_EDGES_EXIST = f"""WITH d AS ({DIM_EDGES_OPEN}), {PATH_EDGES},
mem AS (SELECT pe.*, EXISTS (SELECT 1 FROM d WHERE d.dimension_id = pe.dimension_id
          AND d.child = pe.from_level AND d.parent = pe.to_level) AS in_dimension FROM pe)
SELECT {HK_COLS}, count(*) AS n_edges, count(*) FILTER (WHERE NOT in_dimension) AS n_missing,
  bool_and(in_dimension) AS all_exist FROM mem GROUP BY ALL"""

SINGLE_PARENT = f"""WITH {PATH_EDGES}
SELECT {HK_COLS}, max_out, max_out <= 1 AS single_parent FROM grp JOIN st USING (hk)"""

HIER_JSON_SINGLE_PARENT = f"""WITH {PATH_EDGES}
SELECT {HK_COLS}, max_out <= 1 AS single_parent,
  'Got the hierarchy and it is ' || CASE WHEN max_out <= 1 THEN 'true' ELSE 'false' END AS answer
FROM grp JOIN st USING (hk)"""

PATH_START_END = f"""WITH {PATH_EDGES}
SELECT {HK_COLS}, node AS level, CASE WHEN idg = 0 THEN 'start' ELSE 'end' END AS role
FROM grp JOIN deg USING (hk) WHERE idg = 0 OR od = 0"""

HIER_PATH = f"""WITH {PATH_EDGES}
SELECT {HK_COLS}, count(*) AS n_edges,
  string_agg(concat_ws('>', from_level, to_level), ';' ORDER BY concat_ws('>', from_level, to_level)) AS path
FROM pe GROUP BY ALL"""


# -- seeded draws and calendars -------------------------------------------------

SEED = "42"


def sql_draw(*parts: str) -> str:
    """The same number as ``strata.functions.draws.draw``."""
    return f"('0x' || substr(md5(concat_ws('|', '{SEED}', {', '.join(parts)})), 1, 8))::BIGINT"


def sql_week_start(anchor_date: str, *parts: str) -> str:
    """Anchor - a years - 7b days - c months, then the next Wednesday (1-7 days on)."""
    a = f"CAST({sql_draw(*parts, "'years'")} % 25 AS INTEGER)"
    b = f"CAST({sql_draw(*parts, "'weeks'")} % 25 AS INTEGER)"
    c = f"CAST({sql_draw(*parts, "'months'")} % 25 AS INTEGER)"
    d = f"CAST(CAST({anchor_date} AS DATE) - to_years({a}) - to_days(7 * {b}) - to_months({c}) AS DATE)"
    return f"strftime({d} + CAST(((3 - isodow({d}) + 6) % 7) + 1 AS INTEGER), '%Y-%m-%d')"


def sql_year(*parts: str) -> str:
    return f"CAST(1998 + {sql_draw(*parts, "'year'")} % 25 AS VARCHAR)"


YEARS = "SELECT DISTINCT CAST(year(o_orderdate) AS VARCHAR) AS year FROM orders"
QUARTERS = """SELECT DISTINCT CAST(year(o_orderdate) AS VARCHAR) || '0' || CAST(quarter(o_orderdate) AS VARCHAR)
  AS quarter FROM orders"""
PERIODS = f"SELECT year, year || lpad(CAST(p AS VARCHAR), 2, '0') AS period FROM ({YEARS}) y, range(1, 14) t(p)"


def sql_period_week(period: str, i: str) -> str:
    return (f"strftime(make_date(CAST(substr({period}, 1, 4) AS INTEGER), 1, 1) + "
            f"CAST(28 * (CAST(substr({period}, 5, 2) AS INTEGER) - 1) + 7 * {i} AS INTEGER), '%Y-%m-%d')")


PERIOD_WEEKS = f"""SELECT period, {sql_period_week('period', 'i')} AS week_start
FROM ({PERIODS}) p, range(0, 4) t(i)"""
WEEK_DAYS = f"""SELECT week_start, strftime(CAST(week_start AS DATE) + CAST(d AS INTEGER), '%Y-%m-%d') AS day
FROM ({PERIOD_WEEKS}) w, range(0, 7) t(d)"""
PERIOD_WEEK_INDICES = f"""SELECT period, CAST(CAST(substr(period, 1, 4) AS INTEGER) AS VARCHAR) || substr(period, 5, 2)
  || '0' || CAST(i AS VARCHAR) AS week_index FROM ({PERIODS}) p, range(1, 5) t(i)"""
INDEX_WEEK = f"""SELECT week_index, strftime(make_date(CAST(substr(week_index, 1, 4) AS INTEGER), 1, 1)
  + (28 * (CAST(substr(week_index, 5, 2) AS INTEGER) - 1) + 7 * (CAST(substr(week_index, 7, 2) AS INTEGER) - 1)),
  '%Y-%m-%d') AS week_start FROM ({PERIOD_WEEK_INDICES}) x"""
QUARTER_PERIODS = f"""SELECT quarter, substr(quarter, 1, 4) || lpad(CAST(p AS VARCHAR), 2, '0') AS period
FROM ({QUARTERS}) q, range(1, 14) t(p)
WHERE p BETWEEN 3 * (CAST(substr(quarter, 5, 2) AS INTEGER) - 1) + 1
            AND 3 * (CAST(substr(quarter, 5, 2) AS INTEGER) - 1) + 4"""
RANDOM_WEEK_STARTS = f"""SELECT anchor, {sql_week_start('anchor', 'anchor')} AS week_start
FROM (SELECT DISTINCT strftime(o_orderdate, '%Y-%m-%d') AS anchor FROM orders) a"""


def _calendar_values() -> str:
    from strata.sources.fixtures import CALENDAR_CHAINS
    rows = []
    for hid, chain in CALENDAR_CHAINS.items():
        for child, parent in zip(chain, chain[1:]):
            rows.append(f"('0', 'time', '{hid}', '{hid.replace('_', ' ')}', '{child}', '{parent}')")
    return ("SELECT * FROM (VALUES " + ", ".join(rows) +
            ") t(tenant_id, dimension_id, hierarchy_id, hierarchy_name, from_level, to_level)")


CALENDAR = _calendar_values()

VALID_PATHS = f"""vpe AS (SELECT pe.tenant_id, pe.dimension_id, pe.hierarchy_id, pe.hierarchy_name,
  from_level, to_level FROM pe JOIN hv USING (hk) WHERE hv.reason IS NULL)"""

KEYS4 = ["tenant_id", "dimension_id", "hierarchy_id", "hierarchy_name"]


def _same_h(a: str, b: str) -> str:
    return " AND ".join(f"{a}.{k} = {b}.{k}" for k in KEYS4)


def _ends(src: str) -> str:
    return f"""SELECT DISTINCT {HK_COLS}, to_level AS level FROM {src} v WHERE NOT EXISTS (
  SELECT 1 FROM {src} w WHERE {_same_h('w', 'v')} AND w.from_level = v.to_level)"""


TOP_ELEMENTS = f"""{HIER_BASE}, {VALID_PATHS},
allp AS (SELECT * FROM vpe UNION ALL {CALENDAR}),
ends AS ({_ends('allp')}),
drawn AS (SELECT *, {sql_year(*KEYS4)} AS y,
  lpad(CAST(1 + {sql_draw(*KEYS4, "'period'")} % 13 AS VARCHAR), 2, '0') AS pp,
  CAST(1 + {sql_draw(*KEYS4, "'quarter'")} % 4 AS VARCHAR) AS q FROM ends),
tops AS (SELECT {HK_COLS}, level,
  CASE WHEN regexp_matches(level, '^(Fiscal|Ad) Year$') THEN y
       WHEN regexp_matches(level, '^(Fiscal|Ad) Period$') THEN y || pp
       WHEN level = 'Fiscal Quarter' THEN y || '0' || q END AS v FROM drawn)
SELECT {HK_COLS}, level, coalesce(v, level || '_id') AS element_id,
  coalesce(v, level || '_label') AS element_label FROM tops"""

GENERIC_CHILDREN = f"""{HIER_BASE}, {VALID_PATHS},
ends AS ({_ends('vpe')})
SELECT e.tenant_id, e.dimension_id, e.hierarchy_id, e.hierarchy_name, e.level AS parent_level,
  v.from_level AS child_level, e.level || '_id' AS parent_element_id,
  v.from_level || '_id' || CAST(i AS VARCHAR) AS child_element_id,
  v.from_level || '_label' || CAST(i AS VARCHAR) AS child_element_label
FROM ends e JOIN vpe v ON {_same_h('v', 'e')} AND v.to_level = e.level, range(1, 4) t(i)"""

ELEMENT_COLS = """tenant_id, hierarchy_id, hierarchy_name, dimension_id, child_level, parent_level,
  parent_element_id, child_element_id, child_element_label, parent_element_label"""

HIER_ELEMENTS = f"""WITH yp AS ({PERIODS}), qs AS ({QUARTERS}),
qp AS (SELECT quarter AS q, period FROM ({QUARTER_PERIODS}) x),
allp AS (SELECT period FROM yp UNION SELECT period FROM qp),
pw AS (SELECT period, {sql_period_week('period', 'i')} AS week FROM allp, range(0, 4) t(i)),
wd AS (SELECT DISTINCT week, strftime(CAST(week AS DATE) + CAST(d AS INTEGER), '%Y-%m-%d') AS day FROM pw, range(0, 7) t(d)),
pi AS (SELECT period, CAST(CAST(substr(period, 1, 4) AS INTEGER) AS VARCHAR) || substr(period, 5, 2) || '0'
       || CAST(i AS VARCHAR) AS widx FROM yp, range(1, 5) t(i)),
iw AS (SELECT widx, strftime(make_date(CAST(substr(widx, 1, 4) AS INTEGER), 1, 1)
       + CAST(28 * (CAST(substr(widx, 5, 2) AS INTEGER) - 1) + 7 * (CAST(substr(widx, 7, 2) AS INTEGER) - 1) AS INTEGER),
       '%Y-%m-%d') AS week FROM pi),
ed AS (
  SELECT 'ad_calendar' AS hierarchy_id, 'Ad Period' AS child_level, 'Ad Year' AS parent_level, year AS pid, period AS cid FROM yp
  UNION ALL SELECT 'ad_calendar', 'Ad Week', 'Ad Period', period, week FROM pw WHERE period IN (SELECT period FROM yp)
  UNION ALL SELECT 'ad_calendar', 'Day', 'Ad Week', week, day FROM wd
    WHERE week IN (SELECT week FROM pw WHERE period IN (SELECT period FROM yp))
  UNION ALL SELECT 'fiscal_calendar', 'Fiscal Period', 'Fiscal Year', year, period FROM yp
  UNION ALL SELECT 'fiscal_calendar', 'Fiscal Week Index', 'Fiscal Period', period, widx FROM pi
  UNION ALL SELECT 'fiscal_calendar', 'Fiscal Week', 'Fiscal Week Index', widx, week FROM iw
  UNION ALL SELECT 'fiscal_calendar', 'Day', 'Fiscal Week', week, day FROM wd WHERE week IN (SELECT week FROM iw)
  UNION ALL SELECT 'fiscal_quarter', 'Fiscal Period', 'Fiscal Quarter', q, period FROM qp
  UNION ALL SELECT 'fiscal_quarter', 'Fiscal Week', 'Fiscal Period', period, week FROM pw
    WHERE period IN (SELECT period FROM qp)
  UNION ALL SELECT 'fiscal_quarter', 'Day', 'Fiscal Week', week, day FROM wd
    WHERE week IN (SELECT week FROM pw WHERE period IN (SELECT period FROM qp)))
SELECT DISTINCT '0' AS tenant_id, hierarchy_id, replace(hierarchy_id, '_', ' ') AS hierarchy_name,
  'time' AS dimension_id, child_level, parent_level, pid AS parent_element_id, cid AS child_element_id,
  cid AS child_element_label, pid AS parent_element_label FROM ed"""

_FAN = f"3 + {sql_draw(*[f'el.{k}' for k in KEYS4], 'el.level', 'el.eid')} % 2"

ELEMENT_EDGES = f"""{HIER_BASE}, {VALID_PATHS},
ends AS ({_ends('vpe')}),
el(tenant_id, dimension_id, hierarchy_id, hierarchy_name, level, eid, elabel) AS (
  SELECT {HK_COLS}, level, level || '_id', level || '_label' FROM ends
  UNION SELECT el.tenant_id, el.dimension_id, el.hierarchy_id, el.hierarchy_name, v.from_level,
    v.from_level || '_id' || CAST(i AS VARCHAR), v.from_level || '_label' || CAST(i AS VARCHAR)
  FROM el JOIN vpe v ON {_same_h('v', 'el')} AND v.to_level = el.level
  JOIN range(1, 5) t(i) ON i <= {_FAN})
SELECT DISTINCT el.tenant_id, el.hierarchy_id, el.hierarchy_name, el.dimension_id, v.from_level AS child_level,
  el.level AS parent_level, el.eid AS parent_element_id, v.from_level || '_id' || CAST(i AS VARCHAR) AS child_element_id,
  v.from_level || '_label' || CAST(i AS VARCHAR) AS child_element_label, el.elabel AS parent_element_label
FROM el JOIN vpe v ON {_same_h('v', 'el')} AND v.to_level = el.level
JOIN range(1, 5) t(i) ON i <= {_FAN}"""

ELEMENT_TREE = f"""{HIER_BASE}, {VALID_PATHS},
ends AS ({_ends('vpe')}),
el(tenant_id, dimension_id, hierarchy_id, hierarchy_name, level, eid, elabel, up, upid, uplabel) AS (
  SELECT {HK_COLS}, level, level || '_id', level || '_label', CAST(NULL AS VARCHAR), CAST(NULL AS VARCHAR), CAST(NULL AS VARCHAR) FROM ends
  UNION ALL SELECT el.tenant_id, el.dimension_id, el.hierarchy_id, el.hierarchy_name, v.from_level,
    el.eid || '/' || v.from_level || '_id' || CAST(i AS VARCHAR), v.from_level || '_label' || CAST(i AS VARCHAR), el.level, el.eid, el.elabel
  FROM el JOIN vpe v ON {_same_h('v', 'el')} AND v.to_level = el.level, range(1, 4) t(i))
SELECT tenant_id, hierarchy_id, hierarchy_name, dimension_id, level AS child_level, up AS parent_level, upid AS parent_element_id,
  eid AS child_element_id, elabel AS child_element_label, uplabel AS parent_element_label FROM el WHERE up IS NOT NULL"""

ELEMENT_REJECTS = """SELECT DISTINCT '0' AS tenant_id, 'time' AS dimension_id, 'fiscal_quarter' AS hierarchy_id,
  'fiscal quarter' AS hierarchy_name, 'Fiscal Quarter' AS parent_level, 'Fiscal Period' AS child_level,
  strftime(o_orderdate, 'Q%Y-%m-%d') AS parent_element_id, strftime(o_orderdate, 'Q%Y-%m-%d') AS parent_element_label,
  'UNPARSABLE_PARENT_LABEL' AS reason
FROM orders"""

DIM_REPORT_JSON = f"""{_with_residue(DIM_EDGES)},
d AS (SELECT DISTINCT dimension_id, child, parent FROM e),
t AS (SELECT dimension_id, '[' || string_agg(CAST(tenant_id AS VARCHAR), ',' ORDER BY tenant_id) || ']' AS tenants
      FROM (SELECT DISTINCT dimension_id, tenant_id FROM e) GROUP BY dimension_id),
n AS (SELECT *, (row_number() OVER (PARTITION BY dimension_id ORDER BY child, parent) - 1) // 10000 AS part FROM d),
l AS (SELECT dimension_id, part, child, '"' || child || '":[' || string_agg('"' || parent || '"', ',' ORDER BY parent) || ']' AS level
      FROM n GROUP BY dimension_id, part, child),
bad AS (SELECT DISTINCT dimension_id FROM res)
SELECT l.dimension_id, CAST(part AS BIGINT) AS part, '{{"dimension_id":"' || l.dimension_id || '","tenant_id":' || any_value(tenants)
  || ',"part":' || CAST(part AS VARCHAR) || ',"mymap":{{' || string_agg(level, ',' ORDER BY child) || '}},"validity":'
  || CASE WHEN any_value(bad.dimension_id) IS NULL THEN 'true' ELSE 'false' END || '}}' AS json
FROM l JOIN t USING (dimension_id) LEFT JOIN bad ON bad.dimension_id = l.dimension_id GROUP BY l.dimension_id, part"""

_SEQ_START = f"1998 + {sql_draw('tenant_id', "'start'")} % 25"

SEQUENTIAL_YEARS = f"""{HIER_BASE},
g AS (SELECT DISTINCT {HK_COLS} FROM hv WHERE reason IS NULL)
SELECT {HK_COLS}, CAST({_SEQ_START} + row_number() OVER (PARTITION BY tenant_id
  ORDER BY dimension_id, hierarchy_id, hierarchy_name) AS VARCHAR) AS year FROM g"""

EDGEWISE_ELEMENTS = f"""{HIER_BASE}, {VALID_PATHS},
allp AS (SELECT * FROM vpe UNION ALL {CALENDAR}),
yr AS (SELECT *, CAST({_SEQ_START} + row_number() OVER (PARTITION BY tenant_id
  ORDER BY dimension_id, hierarchy_id, hierarchy_name, from_level) AS VARCHAR) AS y
  FROM allp WHERE dimension_id = 'time' AND to_level = 'Ad Year'),
par AS (SELECT a.*, CASE
    WHEN a.dimension_id = 'time' AND a.to_level = 'Ad Week'
      THEN {sql_week_start("'2023-01-01'", *[f'a.{k}' for k in KEYS4], 'a.from_level')}
    WHEN a.dimension_id = 'time' AND a.to_level = 'Ad Year' THEN yr.y
    WHEN a.dimension_id = 'time' AND a.to_level = 'Ad Period' THEN 'Ad period from case matching_id1'
    WHEN a.dimension_id = 'time' AND a.to_level IN ('Fiscal Period', 'Fiscal Week', 'Fiscal Year')
      THEN a.to_level || ' from case matching_id1'
    ELSE a.to_level || '_id1' END AS pid,
  CASE WHEN a.dimension_id = 'time' AND a.to_level IN ('Ad Week', 'Ad Year') THEN NULL
       WHEN a.dimension_id = 'time' AND a.to_level IN ('Ad Period', 'Fiscal Period', 'Fiscal Week', 'Fiscal Year')
         THEN 'label from case matching_id1'
       ELSE a.to_level || '_label_id1' END AS plabel
  FROM allp a LEFT JOIN yr ON {_same_h('yr', 'a')} AND yr.from_level = a.from_level AND yr.to_level = a.to_level)
SELECT tenant_id, dimension_id, from_level AS child_level, to_level AS parent_level, pid AS parent_element_id,
  cid AS child_element_id, cid AS child_element_label, coalesce(plabel, pid) AS parent_element_label
FROM (
  SELECT par.*, strftime(CAST(pid AS DATE) + CAST(d AS INTEGER), '%Y-%m-%d') AS cid FROM par, range(0, 7) t(d)
    WHERE from_level = 'Day' AND to_level = 'Ad Week'
  UNION ALL SELECT par.*, pid || lpad(CAST(p AS VARCHAR), 2, '0') FROM par, range(1, 14) t(p)
    WHERE from_level = 'Ad Period' AND to_level = 'Ad Year'
  UNION ALL SELECT par.*, from_level || '_id' || CAST(i AS VARCHAR) FROM par, range(1, 3) t(i)
    WHERE NOT (from_level = 'Day' AND to_level = 'Ad Week') AND NOT (from_level = 'Ad Period' AND to_level = 'Ad Year')
) x"""

EDGEWISE_REJECTED = f"""{HIER_BASE}, {VALID_PATHS},
allp AS (SELECT * FROM vpe UNION ALL {CALENDAR})
SELECT {", ".join(KEYS4)}, to_level AS parent_level, from_level AS child_level, to_level || '_id1' AS parent_element_id,
  to_level || '_label_id1' AS parent_element_label, 'UNPARSABLE_PARENT_LABEL' AS reason
FROM allp WHERE dimension_id <> 'time' AND from_level = 'Day' AND to_level = 'Ad Week'"""

# -- levels -----------------------------------------------------------------------

LEVEL_BASE = f"""WITH RECURSIVE e AS ({LEVEL_EDGES}),
{closure()},
cyc AS (SELECT DISTINCT g FROM r WHERE x = y),
ge AS (SELECT dimension_id, child, parent FROM e WHERE dimension_id NOT IN (SELECT g FROM cyc)),
up(g, x, y, len) AS (SELECT dimension_id, child, parent, 1 FROM ge
  UNION SELECT up.g, up.x, ge.parent, up.len + 1 FROM up JOIN ge ON ge.dimension_id = up.g AND ge.child = up.y),
nodes AS (SELECT dimension_id AS g, child AS node FROM ge UNION SELECT dimension_id, parent FROM ge),
t1 AS (SELECT nodes.g, nodes.node, coalesce(max(up.len), 0) AS level
       FROM nodes LEFT JOIN up ON up.g = nodes.g AND up.x = nodes.node GROUP BY ALL),
leaves AS (SELECT g, node FROM nodes WHERE NOT EXISTS (
  SELECT 1 FROM ge WHERE ge.dimension_id = nodes.g AND ge.parent = nodes.node)),
cand AS (SELECT t1.g, t1.node AS x, t1.level AS v FROM t1 JOIN leaves USING (g, node)
  UNION ALL SELECT up.g, up.y, t1.level - up.len FROM up
    JOIN leaves l ON l.g = up.g AND l.node = up.x JOIN t1 ON t1.g = l.g AND t1.node = l.node),
t2 AS (SELECT g, x AS node, min(v) AS level FROM cand GROUP BY ALL)"""

NODE_LEVELS = f"""{LEVEL_BASE}
SELECT g AS dimension_id, node, CAST(level AS INTEGER) AS level FROM t1"""

NODE_LEVELS_PUSHED = f"""{LEVEL_BASE}
SELECT g AS dimension_id, node, CAST(level AS INTEGER) AS level FROM t2"""

SKIP_LEVEL_EDGES = f"""{LEVEL_BASE}
SELECT ge.dimension_id, ge.child, ge.parent, CAST(c.level AS INTEGER) AS child_level,
  CAST(p.level AS INTEGER) AS parent_level
FROM ge JOIN t2 c ON c.g = ge.dimension_id AND c.node = ge.child
JOIN t2 p ON p.g = ge.dimension_id AND p.node = ge.parent WHERE c.level - p.level >= 2"""

LEVEL_PROFILE = f"""{LEVEL_BASE}
SELECT g AS dimension_id, CAST(level AS INTEGER) AS level, count(*) AS n_nodes,
  (SELECT count(DISTINCT level) FROM t2 x WHERE x.g = t2.g) AS n_levels FROM t2 GROUP BY ALL"""

LEVEL_SLOTS = f"""{LEVEL_BASE}
SELECT g AS dimension_id, node, CAST(level AS INTEGER) AS level,
  row_number() OVER (PARTITION BY g, level ORDER BY node) - 1 AS slot FROM t2"""


# -- configuration with bad rows and several tenants ------------------------------

TENANT_LIST = "[(o_custkey + i) % 4 FOR i IN range(o_custkey % 3 + 1)]"

ROUGH = f"""o AS (SELECT o_orderkey AS k, o_custkey AS c, 'L' || ((o_orderkey // 16) % 16) AS up, {TENANT_LIST} AS several FROM orders),
rough AS (SELECT k, k % 29 IN (0, 1) AS corrupt, CASE WHEN k % 17 <> 0 THEN 'D' || c END AS dimension_id,
  CASE WHEN k % 19 <> 0 THEN 'L' || (k % 16) END AS level,
  CASE WHEN k % 23 = 0 THEN [] WHEN k % 23 = 1 THEN [up, 'Ltop'] ELSE [up] END AS parents,
  CASE WHEN k % 13 IN (0, 1) THEN [] WHEN k % 13 = 2 THEN [c % 4] ELSE several END AS tenants,
  CASE k % 13 WHEN 0 THEN '' WHEN 1 THEN 'x' WHEN 2 THEN (c % 4) || ',x' ELSE array_to_string(several, ', ') END AS tenant_text,
  CASE k % 23 WHEN 0 THEN '' WHEN 1 THEN up || ',, Ltop' ELSE up END AS parent_text FROM o),
marked AS (SELECT *, CASE WHEN corrupt THEN ['CORRUPT_LINE'] ELSE list_filter([
    CASE WHEN dimension_id IS NULL THEN 'NO_DIMENSION' END, CASE WHEN level IS NULL THEN 'NO_LEVEL' END,
    CASE WHEN k % 13 = 0 THEN 'NO_TENANT' END, CASE WHEN k % 13 IN (1, 2) THEN 'BAD_TENANT' END,
    CASE WHEN k % 23 = 0 THEN 'NO_PARENT' END, CASE WHEN k % 23 = 1 THEN 'EMPTY_PARENT' END], lambda x: x IS NOT NULL) END AS problems,
  NOT corrupt AND dimension_id IS NOT NULL AND level IS NOT NULL AS placed FROM rough),
te AS (SELECT DISTINCT tenant_id, dimension_id, child, unnest(parents) AS parent FROM (
  SELECT unnest(CASE WHEN len(tenants) = 0 THEN [NULL] ELSE tenants END) AS tenant_id, dimension_id, level AS child, parents
  FROM marked WHERE placed))"""

CONFIG_PROBLEMS = f"""WITH {ROUGH}
SELECT dimension_id, problem, count(*) AS n_rows FROM (SELECT dimension_id, unnest(problems) AS problem FROM marked) GROUP BY ALL"""

CONFIG_QUARANTINE = f"""WITH {ROUGH}
SELECT tenant_text || '|' || coalesce(dimension_id, ' ') || CASE k % 29 WHEN 0 THEN '' ELSE '|' || coalesce(level, '') || '|' || parent_text END
  || CASE k % 29 WHEN 1 THEN '|more' ELSE '' END AS line, array_to_string(problems, ',') AS problems FROM marked WHERE NOT placed"""

CONFIG_TENANTS = f"""WITH {ROUGH}
SELECT CAST(tenant_id AS INTEGER) AS tenant_id, dimension_id, child, parent FROM te"""

CONFIG_REPORT = f"""WITH RECURSIVE {ROUGH},
e AS (SELECT DISTINCT dimension_id, child, parent FROM te),
{closure()},
{residue_cte()},
counts AS (SELECT dimension_id, count(*) AS n_rows, count(*) FILTER (WHERE NOT placed) AS n_quarantined,
  count(*) FILTER (WHERE placed AND k % 13 = 0) AS n_no_tenant, count(*) FILTER (WHERE placed AND k % 13 IN (1, 2)) AS n_bad_tenant,
  count(*) FILTER (WHERE placed AND k % 23 = 0) AS n_no_parent, count(*) FILTER (WHERE placed AND k % 23 = 1) AS n_empty_parent
  FROM marked WHERE dimension_id IS NOT NULL GROUP BY ALL),
ec AS (SELECT dimension_id, count(*) AS n_edges FROM e GROUP BY ALL),
rc AS (SELECT dimension_id, count(*) AS n_residue FROM res GROUP BY ALL),
tn AS (SELECT dimension_id, string_agg(tenant_id, ',' ORDER BY tenant_id) AS tenant_ids
  FROM (SELECT DISTINCT dimension_id, unnest(tenants) AS tenant_id FROM marked WHERE placed) GROUP BY ALL),
lc AS (SELECT dimension_id, count(DISTINCT level) AS n_levels FROM (
  SELECT dimension_id, level FROM marked WHERE placed UNION ALL SELECT dimension_id, parent FROM e) GROUP BY ALL)
SELECT counts.*, coalesce(n_edges, 0) AS n_edges, coalesce(n_residue, 0) AS n_residue,
  CASE WHEN n_edges IS NULL THEN 'EMPTY' WHEN n_residue > 0 THEN 'CYCLE' END AS reason,
  n_edges IS NOT NULL AND n_residue IS NULL AS valid, coalesce(tenant_ids, '') AS tenant_ids, coalesce(n_levels, 0) AS n_levels
FROM counts LEFT JOIN ec USING (dimension_id) LEFT JOIN rc USING (dimension_id)
LEFT JOIN tn USING (dimension_id) LEFT JOIN lc USING (dimension_id)"""

SHARED_HIER = f"""SELECT DISTINCT {TENANT_LIST} AS tenants, 'D' || o_custkey AS dimension_id, 'H' || year(o_orderdate) AS hierarchy_id,
  'L' || (o_orderkey % 16) AS from_level, 'hierarchy ' || year(o_orderdate) AS hierarchy_name,
  'L' || ((o_orderkey // 16) % 16) AS to_level FROM orders"""

HIER_TENANT_LISTS = f"""SELECT array_to_string(tenants, ',') AS tenant_ids, len(tenants) AS n_tenants,
  dimension_id, hierarchy_id, from_level, hierarchy_name, to_level FROM ({SHARED_HIER})"""

HIER_TENANTS = f"""SELECT CAST(unnest(tenants) AS INTEGER) AS tenant_id, dimension_id, hierarchy_id, from_level, hierarchy_name, to_level
FROM ({SHARED_HIER})"""

# -- tops of every level, path segments, what the sinks wrote ------------------------

TIMED_TOPS = f"""WITH p AS (SELECT DISTINCT CAST(o_custkey % 4 AS VARCHAR) AS tenant_id, 'D' || o_custkey AS dimension_id,
  strftime(o_orderdate, 'H%Y-%m-%d') AS hierarchy_id, strftime(o_orderdate, 'from %Y-%m-%d') AS hierarchy_name,
  ['Ad Year', 'Fiscal Year', 'Ad Week', 'Fiscal Week', 'Ad Period', 'Fiscal Period', 'Fiscal Quarter', 'Season'][o_custkey % 8 + 1] AS level
  FROM orders),
drawn AS (SELECT *, {sql_year(*KEYS4)} AS y, lpad(CAST(1 + {sql_draw(*KEYS4, "'period'")} % 13 AS VARCHAR), 2, '0') AS pp,
  CAST(1 + {sql_draw(*KEYS4, "'quarter'")} % 4 AS VARCHAR) AS q, {sql_week_start("'2023-01-01'", *KEYS4)} AS w FROM p),
tops AS (SELECT *, CASE WHEN level LIKE '% Year' THEN y WHEN level LIKE '% Week' THEN w WHEN level LIKE '% Period' THEN y || pp
  WHEN level = 'Fiscal Quarter' THEN y || '0' || q END AS v FROM drawn)
SELECT {HK_COLS}, level, coalesce(v, level || '_id') AS element_id, coalesce(v, level || '_label') AS element_label FROM tops"""

HIER_PATH_SEGMENTS = f"""WITH {PATH_EDGES},
n AS (SELECT *, concat_ws('>', from_level, to_level) AS entry,
  (row_number() OVER (PARTITION BY hk ORDER BY concat_ws('>', from_level, to_level)) - 1) // 10000 AS segment FROM pe)
SELECT {HK_COLS}, segment, count(*) AS n_edges, string_agg(entry, ';' ORDER BY entry) AS path FROM n GROUP BY {HK_COLS}, segment"""

CSV_READ_BACK = f"""SELECT {ELEMENT_COLS} FROM ({HIER_ELEMENTS}) UNION ALL SELECT {ELEMENT_COLS} FROM ({ELEMENT_EDGES})"""

PAYLOADS_READ_BACK = f"""SELECT 'element' AS kind, {ELEMENT_COLS} FROM ({CSV_READ_BACK})
UNION ALL SELECT 'path', tenant_id, hierarchy_id, hierarchy_name, dimension_id, from_level, to_level, NULL, NULL, NULL, NULL
FROM ({VALID_HIERARCHIES} UNION ALL {CALENDAR})"""


ORACLES: dict[str, str] = {
    "dim_validity": DIM_VALIDITY,
    "edge_table_validity": EDGE_TABLE_VALIDITY,
    "edge_table_validity_all": EDGE_TABLE_VALIDITY_ALL,
    "valid_dimensions": VALID_DIMENSIONS,
    "cycle_residue": CYCLE_RESIDUE,
    "edge_set": DIM_EDGES,
    "node_set": NODE_SET,
    "dim_profile": DIM_PROFILE,
    "root_edges": ROOT_EDGES,
    "edges_minus_roots": EDGES_MINUS_ROOTS,
    "dim_graph": ADJ,
    "dim_config_parse": DIM_CONFIG_PARSE,
    "hier_config_parse": HIER_CONFIG_PARSE,
    "hier_config_tenant_array": HIER_CONFIG_TENANT_ARRAY,
    "dim_json_parse": DIM_JSON_PARSE,
    "explode_parents": EXPLODE_PARENTS,
    "explode_tenants": DIM_EDGES,
    "dim_of_tenant": DIM_OF_TENANT,
    "dim_report": DIM_REPORT,
    "dim_json_validity": DIM_JSON_VALIDITY,
    "hier_path": HIER_PATH,
    "path_start_end": PATH_START_END,
    "single_parent": SINGLE_PARENT,
    "hier_json_single_parent": HIER_JSON_SINGLE_PARENT,
    "path_edges_exist": PATH_EDGES_EXIST,
    "hier_validity": HIER_VALIDITY,
    "valid_hierarchies": VALID_HIERARCHIES,
    "path_explode": PATH_EXPLODE,
    "path_inverted": PATH_INVERTED,
    "year_periods": PERIODS,
    "period_weeks": PERIOD_WEEKS,
    "week_days": WEEK_DAYS,
    "period_week_indices": PERIOD_WEEK_INDICES,
    "index_week": INDEX_WEEK,
    "quarter_periods": QUARTER_PERIODS,
    "random_week_starts": RANDOM_WEEK_STARTS,
    "top_elements": TOP_ELEMENTS,
    "generic_children": GENERIC_CHILDREN,
    "hier_elements": HIER_ELEMENTS,
    "element_edges": ELEMENT_EDGES,
    "element_tree": ELEMENT_TREE,
    "element_rejects": ELEMENT_REJECTS,
    "dim_report_json": DIM_REPORT_JSON,
    "sequential_years": SEQUENTIAL_YEARS,
    "edgewise_elements": EDGEWISE_ELEMENTS,
    "edgewise_rejected": EDGEWISE_REJECTED,
    "node_levels": NODE_LEVELS,
    "node_levels_pushed": NODE_LEVELS_PUSHED,
    "skip_level_edges": SKIP_LEVEL_EDGES,
    "level_profile": LEVEL_PROFILE,
    "level_slots": LEVEL_SLOTS,
    "config_problems": CONFIG_PROBLEMS,
    "config_quarantine": CONFIG_QUARANTINE,
    "config_tenants": CONFIG_TENANTS,
    "config_report": CONFIG_REPORT,
    "hier_tenant_lists": HIER_TENANT_LISTS,
    "hier_tenants": HIER_TENANTS,
    "one_dimension": PART_EDGES,
    "timed_tops": TIMED_TOPS,
    "hier_path_segments": HIER_PATH_SEGMENTS,
    "dataset_read_back": DIM_EDGES,
    "csv_read_back": CSV_READ_BACK,
    "payloads_read_back": PAYLOADS_READ_BACK,
}
