"""Reference SQL (DuckDB dialect) for the registered queries.

Each query is written independently of the Spark code, directly over the
raw test tables, as plain SQL with windows and aggregates.  Only the fixture
mapping (which columns play which role) is shared with the Spark side.
Doubles are rounded to 6 places on both sides.
"""

from __future__ import annotations

import zlib

from outcomelab.sources import fixtures as fx

R = 6  # rounding digits for doubles


def base(extra: str = "") -> str:
    """CTEs: items, outcomes, labelled rows ``lab`` and split flags ``p``."""
    modes = ",\n       ".join(
        f"(SELECT {c} FROM j0 WHERE {c} IS NOT NULL GROUP BY {c} ORDER BY count(*) DESC, {c} LIMIT 1) AS m_{c}"
        for c in fx.MODE_IMPUTED)
    repl = ", ".join(f"coalesce({c}, m_{c}) AS {c}" for c in fx.MODE_IMPUTED)
    anyof = " OR ".join(f"coalesce({c}, m_{c})" for c in fx.OR_PARTS)
    sql = f"""WITH items AS ({fx.ITEM_SQL}),
outc AS ({fx.OUTCOME_SQL}),
j0 AS (SELECT * FROM items JOIN outc USING (id) WHERE d >= DATE '{fx.DATE_FLOOR}'),
modes AS (SELECT {modes}),
lab AS (SELECT j0.* REPLACE ({repl}), {anyof} AS {fx.OR_LABEL} FROM j0, modes),
sp AS (SELECT *, row_number() OVER (ORDER BY d DESC, id DESC) <= ceil({fx.DEV_SHARE}::DOUBLE * count(*) OVER ()) AS is_dev FROM lab),
p AS (SELECT *, (NOT is_dev) AND d >= DATE '{fx.RECENT_FROM}' AS is_train FROM sp)"""
    return sql + ((",\n" + extra) if extra else "")


def kept_cte(name: str, src: str, col: str, share: float = 0.9, k: int = 5) -> str:
    """Values of ``col`` kept by downsizing, fitted on all rows of ``src``."""
    return f"""{name} AS (SELECT v FROM (
  SELECT v, row_number() OVER (ORDER BY c DESC, v) AS rk,
         sum(c) OVER (ORDER BY c DESC, v ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)
           / (SELECT count({col}) FROM {src}) AS share
  FROM (SELECT CAST({col} AS VARCHAR) AS v, count(*) AS c FROM {src} WHERE {col} IS NOT NULL GROUP BY 1))
  WHERE share < {share} AND rk <= {k})"""


def ds(col: str, kept: str) -> str:
    return f"CASE WHEN CAST({col} AS VARCHAR) IN (SELECT v FROM {kept}) THEN CAST({col} AS VARCHAR) ELSE 'Other' END"


def longrows(src: str, numeric: list[str], categorical: list[str]) -> str:
    """Sparse (id, feature, value) rows of a wide feature table."""
    parts = [f"SELECT id, '{c}' AS feature, round(CAST({c} AS DOUBLE), {R}) AS value FROM {src} "
             f"WHERE {c} IS NOT NULL AND {c} <> 0" for c in numeric]
    parts += [f"SELECT id, '{c}_' || {c} AS feature, 1.0 AS value FROM {src} WHERE {c} IS NOT NULL"
              for c in categorical]
    return "\nUNION ALL ".join(parts)


# -- feature sets as CTE chains -----------------------------------------

def project_ctes() -> str:
    return ",\n".join([
        "pf0 AS (SELECT id, subject, area, labor, resource, price, "
        "CAST(date_diff('day', (SELECT min(d) FROM lab), d) AS INTEGER) AS rel FROM lab)",
        "amed AS (SELECT area, median(price) AS med FROM lab WHERE area IS NOT NULL AND price IS NOT NULL GROUP BY area)",
        "pf1 AS (SELECT pf0.*, CASE WHEN med <> 0 THEN price / med END AS ratio FROM pf0 LEFT JOIN amed USING (area))",
        kept_cte("k_subject", "pf1", "subject"), kept_cte("k_area", "pf1", "area"),
        kept_cte("k_resource", "pf1", "resource"),
        f"pf2 AS (SELECT id, labor, rel, ratio, {ds('subject', 'k_subject')} AS subject, "
        f"{ds('area', 'k_area')} AS area, {ds('resource', 'k_resource')} AS resource FROM pf1)",
        "pf3 AS (SELECT id, labor, rel AS date_posted_relative, "
        "coalesce(ratio, (SELECT median(ratio) FROM pf2)) AS price_relative_to_focus_area, "
        "subject, area, resource FROM pf2)",
        "proj_long AS (" + longrows("pf3", ["labor", "date_posted_relative", "price_relative_to_focus_area"],
                                    ["subject", "area", "resource"]) + ")",
    ])


def teacher_ctes(label: str = "label") -> str:
    return ",\n".join([
        f"tr AS (SELECT id, teacher, d, CAST({label} AS INTEGER) AS y FROM p WHERE is_train AND teacher IS NOT NULL)",
        "tw AS (SELECT id, row_number() OVER w - 1 AS np, "
        "coalesce(sum(y) OVER (PARTITION BY teacher ORDER BY d, id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS ne "
        "FROM tr WINDOW w AS (PARTITION BY teacher ORDER BY d, id))",
        "tpr AS (SELECT avg(n) AS pn, avg(k) AS pk FROM (SELECT count(*) AS n, sum(y) AS k FROM tr GROUP BY teacher))",
        "tf0 AS (SELECT lab.id, lab.prefix, CAST(coalesce(np, 0) AS DOUBLE) AS teacher_num_prev_projects, "
        "CAST(coalesce(ne, 0) AS DOUBLE) AS teacher_num_prev_exciting_projects, "
        "coalesce((ne + pk) / (np + pn), 0) AS teacher_pct_prev_exciting FROM lab LEFT JOIN tw USING (id) CROSS JOIN tpr)",
        kept_cte("k_prefix", "tf0", "prefix"),
        f"tf1 AS (SELECT tf0.* REPLACE ({ds('prefix', 'k_prefix')} AS prefix) FROM tf0)",
        "teach_long AS (" + longrows("tf1", ["teacher_num_prev_projects", "teacher_num_prev_exciting_projects",
                                            "teacher_pct_prev_exciting"], ["prefix"]) + ")",
    ])


def school_overall_ctes(label: str = "label", entity: str = "school", tag: str = "s") -> str:
    """Overall smoothed entity performance; yields CTE ``{tag}f`` with id,
    num_projects, pct_exciting, projects_per_year, active_years."""
    return ",\n".join([
        f"{tag}e AS (SELECT {entity} AS ent, count(*) AS n, CAST(sum(CAST({label} AS INTEGER)) AS BIGINT) AS k, "
        f"round(date_diff('day', min(d), max(d)) / 365.0, 2) AS y FROM p WHERE is_train AND {entity} IS NOT NULL GROUP BY 1)",
        f"{tag}pr AS (SELECT avg(n) AS pn, avg(k) AS pk, avg(y) AS py FROM {tag}e WHERE n >= 3)",
        f"{tag}f AS (SELECT lab.id, CAST(coalesce(n, pn) AS DOUBLE) AS num_projects, "
        f"CASE WHEN n IS NULL THEN pk / pn ELSE (k + pk) / (n + pn) END AS pct_exciting, "
        f"CASE WHEN n IS NULL THEN pn / py ELSE (n + pn) / (y + py) END AS projects_per_year, "
        f"coalesce(y, py) AS active_years FROM lab LEFT JOIN {tag}e ON lab.{entity} = {tag}e.ent CROSS JOIN {tag}pr)",
    ])


def school_ctes(label: str = "label") -> str:
    return ",\n".join([
        school_overall_ctes(label),
        "sc0 AS (SELECT lab.id, lab.metro, sf.pct_exciting AS school_pct_exciting, "
        "sf.projects_per_year AS school_projects_per_year, sf.active_years AS school_active_years "
        "FROM lab JOIN sf USING (id))",
        kept_cte("k_metro", "sc0", "metro"),
        f"sc1 AS (SELECT sc0.* REPLACE ({ds('metro', 'k_metro')} AS metro) FROM sc0)",
        "school_long AS (" + longrows("sc1", ["school_pct_exciting", "school_projects_per_year",
                                             "school_active_years"], ["metro"]) + ")",
    ])


def bins_expr(col: str, stats: str, n: int = 5) -> str:
    mn = f"(SELECT CASE WHEN mn0 = mx0 THEN mn0 - CASE WHEN mn0 <> 0 THEN 0.001 * abs(mn0) ELSE 0.001 END ELSE mn0 END FROM {stats})"
    mx = f"(SELECT CASE WHEN mn0 = mx0 THEN mx0 + CASE WHEN mx0 <> 0 THEN 0.001 * abs(mx0) ELSE 0.001 END ELSE mx0 END FROM {stats})"
    step = f"(({mx} - {mn}) / 5.0)" if n == 5 else f"(({mx} - {mn}) / {float(n)})"
    whens = " ".join(f"WHEN {col} <= {i}.0 * {step} + {mn} THEN 'bin{i - 1}'" for i in range(1, n))
    return f"CASE WHEN {col} IS NULL THEN NULL {whens} ELSE 'bin{n - 1}' END"


def geo_ctes() -> str:
    return ",\n".join([
        "latst AS (SELECT min(latitude) AS mn0, max(latitude) AS mx0 FROM p)",
        "lonst AS (SELECT min(longitude) AS mn0, max(longitude) AS mx0 FROM p)",
        f"g0 AS (SELECT id, is_train, city, state, school, city || '-' || state AS city_state, "
        f"{bins_expr('latitude', 'latst')} AS latitude_group, {bins_expr('longitude', 'lonst')} AS longitude_group FROM p)",
        "gsz AS (SELECT city_state, count(DISTINCT school) AS ns, count(DISTINCT id) AS np FROM g0 "
        "WHERE is_train AND city_state IS NOT NULL GROUP BY 1)",
        "g1 AS (SELECT g0.*, ns AS city_state_num_schools, np AS city_state_num_projects, "
        "CAST(np AS DOUBLE) / ns AS city_state_projects_per_school FROM g0 LEFT JOIN gsz USING (city_state))",
        kept_cte("k_state", "g1", "state"), kept_cte("k_lat", "g1", "latitude_group"),
        kept_cte("k_lon", "g1", "longitude_group"),
        f"g2 AS (SELECT id, {ds('state', 'k_state')} AS state, {ds('latitude_group', 'k_lat')} AS latitude_group, "
        f"{ds('longitude_group', 'k_lon')} AS longitude_group, coalesce(city_state_num_schools, 0) AS city_state_num_schools, "
        "coalesce(city_state_num_projects, 0) AS city_state_num_projects, "
        "coalesce(city_state_projects_per_school, (SELECT median(city_state_projects_per_school) FROM g1)) "
        "AS city_state_projects_per_school FROM g1)",
        "geo_long AS (" + longrows("g2", ["city_state_num_schools", "city_state_num_projects",
                                         "city_state_projects_per_school"],
                                  ["state", "latitude_group", "longitude_group"]) + ")",
    ])


# -- mutual information --------------------------------------------------

PRIME = 2147483647  # of the integer scatter


def scatter(id_col: str, code) -> str:
    """The integer scatter of an id (below 2^62) and a number, as SQL."""
    u = f"((({id_col} % {PRIME}) * 1103515245 + (({id_col} >> 31) % {PRIME}) * 48271 + {code}) % {PRIME})"
    square = f"({u} * {u} % {PRIME})"
    return f"({square} * {square} % {PRIME} * {u} % {PRIME})"


def psi(x: str) -> str:
    """Digamma: recurrence up by six, then the asymptotic series."""
    y = f"({x} + 6.0)"
    return (f"(ln({y}) - 0.5 / {y} - 1 / (12 * pow({y}, 2)) + 1 / (120 * pow({y}, 4)) - 1 / (252 * pow({y}, 6)) "
            f"+ 1 / (240 * pow({y}, 8)) - 5 / (660 * pow({y}, 10))"
            + "".join(f" - 1.0 / ({x} + {j}.0)" for j in range(6)) + ")")


def numeric_rows(src: str, columns: list[str], label: str = "label") -> str:
    """(feature, code, id, y, x) rows of numeric columns."""
    return "\nUNION ALL ".join(
        f"SELECT '{c}' AS feature, {zlib.crc32(c.encode()) % PRIME} AS code, id, CAST(lab.{label} AS INTEGER) AS y, "
        f"CAST(f.{c} AS DOUBLE) AS x FROM {src} f JOIN lab USING (id) WHERE f.{c} IS NOT NULL AND lab.{label} IS NOT NULL"
        for c in columns)


def knn_mi_ctes(rows: str, k: int = 3) -> str:
    """CTEs ending in ``kmi`` (feature, m): the nearest-neighbour estimate over
    ``rows``.  Counts come from as-of joins on the cumulative number of
    points, not from an ordered pass."""
    step = ("pow(2.0, floor(log2(1e-10 * greatest(CASE WHEN stddev_pop(x) > 0 THEN stddev_pop(x) ELSE 1.0 END, "
            "avg(abs(x))))) - 29)")
    near = "\nUNION ALL ".join(
        f"SELECT feature, id, y, x, n, abs(x - {side}{j}) AS d, {side}{j} AS nb FROM kn WHERE {side}{j} IS NOT NULL"
        for j in range(1, k + 1) for side in ("lag", "lead"))
    sides = ", ".join(f"{side}(x, {j}) OVER w AS {side}{j}" for j in range(1, k + 1) for side in ("lag", "lead"))
    return f"""kr AS ({rows}),
ks AS (SELECT feature, {step} AS step FROM kr GROUP BY feature),
kp AS (SELECT feature, id, y, x + CAST({scatter('id', 'code')} - {PRIME // 2} AS DOUBLE) * step AS x,
  count(*) OVER (PARTITION BY feature, y) AS n FROM kr JOIN ks USING (feature)),
kn AS (SELECT *, {sides} FROM kp WHERE n > 1 WINDOW w AS (PARTITION BY feature, y ORDER BY x, id)),
kd AS ({near}),
ko AS (SELECT *, row_number() OVER (PARTITION BY feature, id ORDER BY d, nb) AS o FROM kd),
ke AS (SELECT feature, id, n, least({k}, n - 1) AS k, d, CASE WHEN nb < x THEN nb ELSE x - d END AS lo,
  CASE WHEN nb > x THEN nb ELSE x + d END AS hi FROM ko WHERE o = least({k}, n - 1)),
kc AS (SELECT feature, x, CAST(sum(count(*)) OVER (PARTITION BY feature ORDER BY x) AS BIGINT) AS upto
  FROM kp WHERE n > 1 GROUP BY feature, x),
k1 AS (SELECT ke.*, coalesce(kc.upto, 0) AS below_hi FROM ke ASOF LEFT JOIN kc ON ke.feature = kc.feature AND ke.hi > kc.x),
k2 AS (SELECT k1.*, coalesce(kc.upto, 0) AS to_hi FROM k1 ASOF LEFT JOIN kc ON k1.feature = kc.feature AND k1.hi >= kc.x),
k3 AS (SELECT k2.*, coalesce(kc.upto, 0) AS to_lo FROM k2 ASOF LEFT JOIN kc ON k2.feature = kc.feature AND k2.lo >= kc.x),
k4 AS (SELECT k3.*, coalesce(kc.upto, 0) AS below_lo FROM k3 ASOF LEFT JOIN kc ON k3.feature = kc.feature AND k3.lo > kc.x),
km AS (SELECT feature, CAST(n AS DOUBLE) AS n, CAST(k AS DOUBLE) AS k,
  CAST(CASE WHEN d > 0 THEN below_hi - to_lo ELSE to_hi - below_lo END AS DOUBLE) AS m FROM k4),
kt AS (SELECT feature, CAST(count(*) AS DOUBLE) AS total, avg({psi('k')}) AS pk, avg({psi('n')}) AS pn,
  avg({psi('m')}) AS pm FROM km GROUP BY feature),
kmi AS (SELECT feature, greatest(0.0, {psi('total')} + pk - pn - pm) AS m FROM kt)"""


def level_mi_ctes(columns: dict[str, str], label: str = "label") -> str:
    """CTEs ending in ``lmi`` (feature, m): the plug-in estimate of each level
    of the given text columns (column -> table) as a 0/1 feature."""
    levels = "\nUNION ALL ".join(
        f"SELECT '{c}_' || f.{c} AS feature, CAST(lab.{label} AS INTEGER) AS y, count(*) AS one "
        f"FROM {src} f JOIN lab USING (id) WHERE f.{c} IS NOT NULL AND lab.{label} IS NOT NULL GROUP BY ALL"
        for c, src in columns.items())
    return f"""l1 AS ({levels}),
ly AS (SELECT CAST({label} AS INTEGER) AS y, count(*) AS ny FROM lab WHERE {label} IS NOT NULL GROUP BY 1),
l2 AS (SELECT f.feature, ly.y, ny, coalesce(one, 0) AS one FROM (SELECT DISTINCT feature FROM l1) f CROSS JOIN ly
  LEFT JOIN l1 ON l1.feature = f.feature AND l1.y = ly.y),
l3 AS (SELECT feature, ny, one AS nxy, sum(one) OVER w AS nx, sum(ny) OVER w AS n FROM l2 WINDOW w AS (PARTITION BY feature)
  UNION ALL SELECT feature, ny, ny - one, sum(ny - one) OVER w, sum(ny) OVER w FROM l2 WINDOW w AS (PARTITION BY feature)),
lmi AS (SELECT feature, greatest(0.0, sum(CAST(nxy AS DOUBLE) / n * ln(CAST(n AS DOUBLE) * nxy / (CAST(nx AS DOUBLE) * ny)))) AS m
  FROM l3 WHERE nxy > 0 GROUP BY feature)"""


# The feature sets of the second pass: entity -> (table, numeric, text columns).
SETS = {
    "project": ("pf3", ["labor", "date_posted_relative", "price_relative_to_focus_area"], ["subject", "area", "resource"]),
    "teacher": ("tf1", ["teacher_num_prev_projects", "teacher_num_prev_exciting_projects", "teacher_pct_prev_exciting"],
                ["prefix"]),
    "school": ("sc1", ["school_pct_exciting", "school_projects_per_year", "school_active_years"], ["metro"]),
    "geo": ("g2", ["city_state_num_schools", "city_state_num_projects", "city_state_projects_per_school"],
            ["state", "latitude_group", "longitude_group"]),
}


def feature_ranking() -> str:
    rows = "\nUNION ALL ".join(numeric_rows(t, numeric) for t, numeric, _ in SETS.values())
    text = {c: t for t, _, cols in SETS.values() for c in cols}
    owner = {c: e for e, (_, numeric, cols) in SETS.items() for c in numeric + cols}
    entity = "CASE " + " ".join(
        f"WHEN starts_with(feature, '{c}') THEN '{owner[c]}'" for c in sorted(owner, key=len, reverse=True)) + " END"
    return base(",\n".join([project_ctes(), teacher_ctes(), school_ctes(), geo_ctes(), knn_mi_ctes(rows),
                            level_mi_ctes(text)])) + f""" SELECT {entity} AS entity, feature, round(m, {R}) AS mutual_information
 FROM (SELECT * FROM kmi UNION ALL SELECT * FROM lmi)"""
