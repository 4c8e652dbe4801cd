"""Plain SQL that states what each catalogue query has to return, for a check by another engine."""

from __future__ import annotations

from municipia import fixed_values as fixed
from municipia.plans import catalogue

_YEARS = "years AS (SELECT DISTINCT CAST(year(o_orderdate) AS INTEGER) AS year FROM orders)"

_PLACES = """places AS (
  SELECT c_custkey AS mun, c_name AS mun_name, n_name || '-' || c_mktsegment AS mic,
         c_mktsegment AS mic_name, n_name AS uf, r_name AS region
  FROM customer JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey)"""

_FACT = _PLACES + """,
fact AS (
  SELECT region, uf, mic, mic_name, mun, mun_name, p_brand AS category, CAST(year(o_orderdate) AS INTEGER) AS year,
         CAST(l_quantity AS DECIMAL(12,2)) AS a, CAST(l_extendedprice AS DECIMAL(12,2)) AS p,
         CAST(l_extendedprice AS DECIMAL(12,2)) * (1 - CAST(l_discount AS DECIMAL(4,2))) AS v,
         CAST(p_retailprice AS DECIMAL(12,2)) AS r
  FROM lineitem JOIN part ON l_partkey = p_partkey JOIN orders ON l_orderkey = o_orderkey
       JOIN places ON o_custkey = mun)"""

_GROUPS = """numbered AS (SELECT DISTINCT p_brand AS category, CAST(split_part(p_brand, '#', 2) AS INTEGER) AS n FROM part),
groups AS (
  SELECT category, n, CASE WHEN n % 2 = 1 THEN 'PER' ELSE 'TEM' END AS kind,
         CAST(CASE WHEN n % 4 = 0 THEN 1 ELSE 0 END AS INTEGER) AS COL FROM numbered)"""

_CLASSED = _FACT + ",\n" + _GROUPS + """,
classed AS (
  SELECT fact.*, kind, CASE WHEN COL = 1 THEN 'COL' WHEN kind = 'TEM' THEN 'TRA' ELSE 'PER' END AS grp
  FROM fact JOIN groups USING (category))"""

_LIVESTOCK = _PLACES + """,
rows AS (
  SELECT uf, mic, mun, CASE WHEN event_type IN ('purchase', 'signup') THEN 'Producao' ELSE 'Rebanho' END AS kind,
         event_type AS category, CAST(day(ts) AS INTEGER) AS year, CAST(value AS DECIMAL(12,2)) AS q,
         CASE WHEN event_type IN ('purchase', 'signup') THEN CAST(value AS DECIMAL(12,2)) ELSE 0 END AS v
  FROM events JOIN places ON user_id = mun)"""

_LONG = """long AS (
  SELECT user_id AS mun, CASE WHEN event_type IN ('purchase', 'signup') THEN 'Producao' ELSE 'Rebanho' END AS kind,
         event_type AS category, CAST(day(ts) AS INTEGER) AS year,
         CASE WHEN event_type NOT IN ('purchase', 'signup') THEN 'Efetivo_Cabecas'
              WHEN CAST(json_extract(props, '$.k') AS INTEGER) % 2 = 0 THEN 'Quantidade' ELSE 'Valor_mil_reais' END AS variable,
         CASE WHEN CAST(json_extract(props, '$.k') AS INTEGER) >= 5 THEN value END AS value, event_id
  FROM events),
wide AS (
  SELECT mun, kind, category, year,
         arg_min(value, event_id) FILTER (variable = 'Efetivo_Cabecas') AS Efetivo_Cabecas,
         arg_min(value, event_id) FILTER (variable = 'Quantidade') AS Quantidade,
         arg_min(value, event_id) FILTER (variable = 'Valor_mil_reais') AS Valor_mil_reais
  FROM long WHERE value IS NOT NULL GROUP BY ALL)"""

_NATION_CODES = """parents AS (
  SELECT lpad(CAST(n_nationkey AS VARCHAR), 2, '0') AS uf_code, n_name AS uf FROM nation)"""

_NAMES = """names AS (
  SELECT n_name AS uf, upper(n_name[1]) || lower(n_name[2:]) AS uf_name, r_name AS region
  FROM nation JOIN region ON n_regionkey = r_regionkey)"""


def _dbl(*columns: str) -> str:
    return ", ".join(f"CAST(sum({c}) AS DOUBLE) AS {c}" for c in columns)


def _palette(index: str, palette: list[str]) -> str:
    return f"list_extract([{', '.join(repr(c) for c in palette)}], {index} + 1)"


def _brazilian(value: str, decimals: int) -> str:
    text = f"format('{{:,.{decimals}f}}', round({value}, {decimals}))"
    trimmed = f"regexp_replace({text}, '\\.?0+$', '')" if decimals else text
    return f"translate({trimmed}, ',.', '.,')"


def _magnitude(value: str) -> str:
    return f"""CASE WHEN {value} IS NULL OR {value} = 0 THEN '—'
      WHEN {value} >= 1e9 THEN {_brazilian(f'({value}) / 1e9', 2)} || ' Gi'
      WHEN {value} >= 1e6 THEN {_brazilian(f'({value}) / 1e6', 2)} || ' Mi'
      WHEN {value} >= 1e3 THEN {_brazilian(f'({value}) / 1e3', 1)} || ' mil'
      ELSE {_brazilian(value, 1)} END"""


_TARGETS = ", ".join(f"({t!r})" for t in catalogue.FLAG_TARGETS)
_PLAIN = "trim(translate(lower({0}), '()', ''))"
_MATCH = f"contains({_PLAIN.format('category')}, {_PLAIN.format('target')}) OR contains({_PLAIN.format('target')}, {_PLAIN.format('category')})"
_LISTED_NAMES = """names AS (SELECT p_name AS category FROM part UNION SELECT c_name FROM customer UNION SELECT s_name FROM supplier),
        targets AS (SELECT DISTINCT '(' || upper(p_name) || ')' AS target FROM part
                    UNION SELECT ' (' || substr(split_part(s_name, '#', 2), 4, 6) || ')' FROM supplier)"""
_CODED = """coded AS (
  SELECT CASE WHEN c_mktsegment = 'MACHINERY' THEN '99' ELSE lpad(CAST(c_nationkey AS VARCHAR), 2, '0') END || CAST(c_custkey AS VARCHAR) AS mun,
         CASE WHEN c_mktsegment = 'BUILDING' THEN 'NATION_0' ELSE 'NATION_' || c_nationkey END AS uf_file FROM customer),
located AS (SELECT mun, uf_file, uf FROM coded LEFT JOIN parents ON substr(mun, 1, 2) = uf_code)"""

_DENSE_MUN = f"""WITH {_FACT}, {_YEARS},
cells AS (SELECT mun, category, year, {_dbl('a', 'p', 'v')} FROM fact GROUP BY ALL),
grid AS (SELECT * FROM (SELECT DISTINCT mun, category FROM cells) CROSS JOIN years)"""

ORACLES: dict[str, str] = {
    "state_category_rollup": f"""WITH {_FACT}
        SELECT uf, category, year, {_dbl('a', 'p', 'v')}, CAST(sum(r) AS DOUBLE) / count(r) AS r_mean,
               CAST(sum(p) AS DOUBLE) * 1000 / CAST(sum(a) AS DOUBLE) AS r_weighted FROM fact GROUP BY ALL""",
    "micro_membership_rollup": f"""WITH {_CLASSED},
        members AS (
          SELECT mic, 'ALL' AS grp, year, a, p, v FROM classed
          UNION ALL SELECT mic, kind, year, a, p, v FROM classed
          UNION ALL SELECT mic, grp, year, a, p, v FROM classed WHERE grp IN ('COL', 'TRA')
          UNION ALL SELECT mic, category, year, a, p, v FROM classed WHERE grp = 'COL')
        SELECT mic, grp, year, {_dbl('a', 'p', 'v')} FROM members GROUP BY ALL""",
    "micro_crop_groups": f"WITH {_CLASSED} SELECT mic, category AS grp, year, {_dbl('a', 'p', 'v')} FROM classed WHERE grp = 'COL' GROUP BY mic, category, year",
    "mun_rollup": f"WITH {_FACT} SELECT mun, year, {_dbl('a', 'p', 'v')} FROM fact GROUP BY ALL",
    "mun_group_rollup": f"""WITH {_CLASSED},
        members AS (
          SELECT mun, kind AS grp, year, a, p, v FROM classed
          UNION ALL SELECT mun, grp, year, a, p, v FROM classed WHERE grp IN ('COL', 'TRA'))
        SELECT mun, grp, year, {_dbl('a', 'p', 'v')} FROM members GROUP BY ALL""",
    "base_rollup": f"""WITH {_FACT}
        SELECT uf, mic, mun, category, year, {_dbl('a', 'p', 'v')}, CAST(sum(r) AS DOUBLE) AS r_sum,
               CAST(count(r) AS BIGINT) AS r_n FROM fact GROUP BY ALL""",
    "livestock_levels": f"""WITH {_LIVESTOCK}
        SELECT 'uf' AS level, uf AS key, category, year, {_dbl('q', 'v')} FROM rows GROUP BY ALL
        UNION ALL SELECT 'mic', mic, category, year, {_dbl('q', 'v')} FROM rows GROUP BY ALL
        UNION ALL SELECT 'mun', CAST(mun AS VARCHAR), category, year, {_dbl('q', 'v')} FROM rows GROUP BY ALL""",
    "variables_pivot": f"WITH {_LONG} SELECT * FROM wide",
    "union_missing_columns": f"WITH {_LONG} SELECT * FROM wide",
    "normalise_measures": f"""WITH {_LONG}
        SELECT mun, kind, category, year, coalesce(Efetivo_Cabecas, Quantidade) AS q, coalesce(Valor_mil_reais, 0.0) AS v FROM wide""",
    "active_set_sum": f"WITH {_CLASSED} SELECT uf, CAST(sum(p) AS DOUBLE) AS value FROM classed WHERE grp = 'COL' GROUP BY uf",
    "category_totals": f"WITH {_FACT} SELECT category, CAST(sum(p) AS DOUBLE) AS value FROM fact GROUP BY category",
    "profile": f"""WITH {_FACT}
        SELECT count(*) AS row_count, count(DISTINCT mun) AS municipalities, count(DISTINCT category) AS categories,
               count(DISTINCT uf) AS states, min(year) AS first_year, max(year) AS last_year FROM fact""",
    "domain_years": f"WITH {_FACT} SELECT CAST(row_number() OVER (ORDER BY year) - 1 AS INTEGER) AS position, year FROM (SELECT DISTINCT year FROM fact)",
    "domain_categories_by_kind": f"WITH {_LIVESTOCK} SELECT DISTINCT kind, category FROM rows",
    "scope_maximum": f"""WITH {_FACT}, t AS (SELECT uf, mic, year, sum(p) AS p FROM fact GROUP BY ALL)
        SELECT uf, year, greatest(CAST(max(p) AS DOUBLE), 1.0) AS scope_max FROM t GROUP BY ALL""",
    "state_dim": f"""WITH {_PLACES}, {_NAMES}
        SELECT DISTINCT CASE WHEN mic_name = 'BUILDING' THEN 'n/a ' || places.uf ELSE places.uf END AS uf,
               CASE WHEN mic_name = 'BUILDING' THEN 'n/a ' || places.uf ELSE uf_name END AS uf_name,
               CASE WHEN mic_name = 'BUILDING' THEN '' ELSE names.region END AS region
        FROM places JOIN names ON places.uf = names.uf""",
    "micro_dim_last_wins": f"""WITH {_PLACES},
        seen AS (SELECT mic_name AS mic, uf AS mic_name, region AS uf, o_orderpriority AS meso_name, min(o_orderkey) AS first_row
                 FROM orders JOIN places ON o_custkey = mun GROUP BY ALL)
        SELECT mic, mic_name, uf, meso_name FROM seen
        QUALIFY row_number() OVER (PARTITION BY mic ORDER BY first_row DESC, mic_name DESC, uf DESC, meso_name DESC) = 1""",
    "mun_dim_first_wins": """SELECT o_custkey AS mun, o_orderpriority AS mun_name, o_orderstatus AS uf, CAST(year(o_orderdate) AS VARCHAR) AS mic
        FROM orders QUALIFY row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderkey, o_orderpriority, o_orderstatus) = 1""",
    "attach_names": f"""WITH {_FACT}, {_NAMES}
        SELECT CASE WHEN category = 'Brand#1' THEN 'n/a ' || fact.uf ELSE fact.uf END AS uf, category, CAST(sum(p) AS DOUBLE) AS p,
               CASE WHEN category = 'Brand#1' THEN 'n/a ' || fact.uf ELSE uf_name END AS uf_name
        FROM fact JOIN names ON fact.uf = names.uf GROUP BY ALL""",
    "region_lookup": f"""WITH {_FACT}
        SELECT CASE WHEN year % 2 = 0 THEN 'n/a ' || uf ELSE uf END AS uf, year, CAST(sum(p) AS DOUBLE) AS p,
               CASE WHEN year % 2 = 0 THEN '??' ELSE region END AS region FROM fact GROUP BY ALL""",
    "locale_order": f"""WITH {_PLACES} SELECT CAST(row_number() OVER (ORDER BY mic_name, mic) - 1 AS INTEGER) AS position, mic, mic_name
        FROM (SELECT DISTINCT mic, mic_name FROM places)""",
    "parent_code_lookup": f"""WITH {_NATION_CODES}, {_CODED}
        SELECT uf, count(*) AS municipalities, max(mun) AS last_code FROM located WHERE uf IS NOT NULL GROUP BY uf""",
    "state_check": f"""WITH {_NATION_CODES}, {_CODED}
        SELECT count(*) AS row_count, count(*) FILTER (uf IS NULL) AS unmapped, count(*) FILTER (uf <> uf_file) AS disagreeing FROM located""",
    "feature_state": f"""WITH {_NATION_CODES}, f AS (SELECT CASE WHEN c_mktsegment = 'MACHINERY' THEN '99' ELSE lpad(CAST(c_nationkey AS VARCHAR), 2, '0') END AS area_code FROM customer)
        SELECT coalesce(uf, area_code) AS uf, count(*) AS features FROM f LEFT JOIN parents ON area_code = uf_code GROUP BY 1""",
    "unmapped_rejects": f"""WITH {_PLACES}
        SELECT event_type AS category, count(mic) AS kept_rows, count(DISTINCT mic) AS micro_regions, count(*) FILTER (mic IS NULL) AS rejected_rows
        FROM events LEFT JOIN places ON CASE WHEN CAST(json_extract(props, '$.k') AS INTEGER) = 0 THEN -user_id ELSE user_id END = mun GROUP BY 1""",
    "unit_labels": f"""WITH {_LIVESTOCK},
        units(category, unit) AS (VALUES {', '.join(f"({c!r}, {u!r})" for c, u in catalogue.UNITS)}),
        totals AS (SELECT kind, category, CAST(sum(q) AS DOUBLE) AS value FROM rows GROUP BY ALL)
        SELECT category, coalesce(unit, '') AS unit, value,
               CASE WHEN kind = 'Producao' THEN category || ' — Valor (mil R$)'
                    ELSE category || ' — Efetivo' || coalesce(' (' || unit || ')', '') END AS label
        FROM totals LEFT JOIN units USING (category)""",
    "bootstrap_flags": f"""WITH targets(target) AS (VALUES {_TARGETS}), names AS (SELECT DISTINCT p_name AS category FROM part)
        SELECT target, min(category) AS category FROM names JOIN targets ON {_MATCH} GROUP BY target""",
    "name_matches": f"""WITH {_LISTED_NAMES} SELECT category, target FROM names JOIN targets ON {_MATCH}""",
    "first_name_matches": f"""WITH {_LISTED_NAMES}
        SELECT target, min(category) AS category, count(*) AS matches FROM names JOIN targets ON {_MATCH} GROUP BY target""",
    "bootstrap_type": f"""SELECT DISTINCT p_name || ' ' || p_type AS category,
        CASE WHEN {' OR '.join(f"contains(lower(p_name || ' ' || p_type), '{k}')" for k in catalogue.KIND_KEYWORDS)}
             THEN 'PER' ELSE 'TEM' END AS kind FROM part""",
    "new_categories": f"""WITH {_FACT}, {_GROUPS}
        SELECT DISTINCT 'New ' || category AS category, 'TEM' AS kind, CAST(0 AS INTEGER) AS COL FROM fact JOIN groups USING (category) WHERE n > 20""",
    "attach_type_default": f"""WITH {_FACT}, {_GROUPS}
        SELECT CASE WHEN n > 20 THEN 'New ' ELSE '' END || category AS category, CAST(sum(a) AS DOUBLE) AS value, CASE WHEN n > 20 THEN 'TEM' ELSE kind END AS kind
        FROM fact JOIN groups USING (category) GROUP BY ALL""",
    "classify_groups": f"""WITH {_FACT}, {_GROUPS}
        SELECT CASE WHEN n > 20 THEN 'New ' ELSE '' END || category AS category, year, CAST(sum(a) AS DOUBLE) AS a, CASE WHEN n > 20 THEN 'TEM' ELSE kind END AS kind,
               CASE WHEN n > 20 THEN 'TRA' WHEN COL = 1 THEN 'COL' WHEN kind = 'TEM' THEN 'TRA' ELSE 'PER' END AS grp
        FROM fact JOIN groups USING (category) GROUP BY ALL""",
    "set_difference_tra": f"WITH {_CLASSED} SELECT DISTINCT category FROM classed WHERE kind = 'TEM' EXCEPT SELECT category FROM groups WHERE COL = 1",
    "set_intersect_col": f"WITH {_FACT}, {_GROUPS} SELECT category FROM groups WHERE COL = 1 INTERSECT SELECT category FROM fact",
    "group_profile": f"""WITH {_CLASSED}
        SELECT kind AS grp, count(DISTINCT mun) AS municipalities FROM classed GROUP BY kind
        UNION ALL SELECT grp, count(DISTINCT mun) FROM classed WHERE grp IN ('COL', 'TRA') GROUP BY grp""",
    "clean_numeric": """WITH t AS (
          SELECT l_linenumber, l_returnflag,
                 CASE l_linenumber WHEN 1 THEN '-' WHEN 2 THEN ' ... ' WHEN 3 THEN 'X' WHEN 4 THEN 'nd'
                      WHEN 5 THEN ' ' || format('{:,.2f}', l_extendedprice) ELSE format('{:,.2f}', l_extendedprice) END AS txt FROM lineitem),
        c AS (SELECT l_linenumber, l_returnflag,
                     CASE WHEN trim(txt) IN ('-', '..', '...', 'X', '', 'nd') THEN NULL ELSE TRY_CAST(replace(trim(txt), ',', '') AS DOUBLE) END AS value FROM t)
        SELECT l_linenumber, l_returnflag, count(value) AS numbers, count(*) FILTER (value IS NULL) AS missing,
               CAST(sum(CAST(value AS DECIMAL(12,2))) AS DOUBLE) AS total FROM c GROUP BY ALL""",
    "decode_variable": """SELECT CASE event_type WHEN 'click' THEN 'Efetivo_Cabecas' WHEN 'purchase' THEN 'Quantidade'
        WHEN 'signup' THEN 'Valor_mil_reais' ELSE event_type END AS variable, count(*) AS n FROM events GROUP BY 1""",
    "exclude_total": """SELECT event_type AS category, CAST(sum(CAST(value AS DECIMAL(12,2))) AS DOUBLE) AS q, count(*) AS n
        FROM events WHERE event_type <> 'error' GROUP BY 1""",
    "area_code_normalise": """WITH t AS (
          SELECT CASE c_mktsegment WHEN 'BUILDING' THEN '0' || c_nationkey WHEN 'MACHINERY' THEN 'n/a ' || c_nationkey
                 ELSE CAST(c_nationkey AS VARCHAR) END AS txt FROM customer)
        SELECT coalesce(lpad(CAST(TRY_CAST(txt AS INTEGER) AS VARCHAR), 2, '0'), txt) AS area_code, count(*) AS n FROM t GROUP BY 1""",
    "sanitize_float": """WITH t AS (
          SELECT l_returnflag, l_linestatus, CASE WHEN l_discount = 0 OR l_tax = 0 OR l_linenumber = 1 THEN 0.0 ELSE l_extendedprice END AS x FROM lineitem)
        SELECT l_returnflag, l_linestatus, count(*) FILTER (x = 0) AS zeros, CAST(sum(CAST(x AS DECIMAL(12,2))) AS DOUBLE) AS total FROM t GROUP BY ALL""",
    "round_published": f"""WITH {_FACT},
        t AS (SELECT uf, category, year, {_dbl('a', 'p', 'v')}, CAST(sum(r) AS DOUBLE) / count(r) AS r_mean FROM fact GROUP BY ALL)
        SELECT uf, category, year, CAST(printf('%.1f', a) AS DOUBLE) AS a, CAST(printf('%.1f', p) AS DOUBLE) AS p,
               CAST(printf('%.1f', v) AS DOUBLE) AS v, CAST(printf('%.2f', r_mean) AS DOUBLE) AS r_mean FROM t""",
    "latest_period": """WITH t AS (
          SELECT CAST(day(ts) AS INTEGER) AS year, CASE WHEN day(ts) > 28 THEN '...' WHEN event_type = 'error' THEN '-' ELSE CAST(value AS VARCHAR) END AS value FROM events)
        SELECT CAST(coalesce(max(year), 2023) AS INTEGER) AS year FROM t WHERE value NOT IN ('', '...', '-')""",
    "json_decode": """SELECT CAST(json_extract(props, '$.k') AS INTEGER) AS k, count(*) AS n,
        CAST(sum(CAST(value AS DECIMAL(12,2))) AS DOUBLE) AS total FROM events GROUP BY 1""",
    "missing_slices": f"""WITH {_LIVESTOCK},
        kinds AS (SELECT DISTINCT event_type AS category FROM events),
        days AS (SELECT CAST(unnest(range(min(day(ts)), max(day(ts)) + 1)) AS INTEGER) AS year FROM events)
        SELECT n_name AS uf, category, year FROM nation CROSS JOIN kinds CROSS JOIN days
        EXCEPT SELECT uf, category, year FROM rows""",
    "scope_filter": f"""WITH {_CLASSED}
        SELECT mun, category, CAST(sum(p) AS DOUBLE) AS value FROM classed
        WHERE grp = 'TRA' AND uf = 'NATION_3' AND year = 1998 GROUP BY ALL""",
    "dense_series_state": f"""WITH {_CLASSED}, {_YEARS},
        t AS (SELECT uf, year, CAST(sum(p) AS DOUBLE) AS p FROM classed WHERE kind = 'TEM' GROUP BY ALL),
        grid AS (SELECT * FROM (SELECT DISTINCT uf FROM t) CROSS JOIN years)
        SELECT uf, year, coalesce(p, 0) AS p, p IS NOT NULL AS is_observed FROM grid LEFT JOIN t USING (uf, year)""",
    "dense_series_mun_category": f"""{_DENSE_MUN}
        SELECT mun, category, year, coalesce(a, 0) AS a, coalesce(p, 0) AS p, coalesce(v, 0) AS v, a IS NOT NULL AS is_observed
        FROM grid LEFT JOIN cells USING (mun, category, year)""",
    "packed_series": f"""{_DENSE_MUN}
        SELECT mun, category, CAST(i AS INTEGER) AS year_index, coalesce(p, 0) AS p FROM grid LEFT JOIN cells USING (mun, category, year)
        JOIN (SELECT year, row_number() OVER (ORDER BY year) - 1 AS i FROM years) USING (year)""",
    "value_at_year": f"""WITH {_FACT}
        SELECT mun, coalesce(CAST(sum(p) FILTER (year = (SELECT min(year(o_orderdate)) FROM orders)) AS DOUBLE), 0) AS first,
               coalesce(CAST(sum(p) FILTER (year = (SELECT max(year(o_orderdate)) FROM orders)) AS DOUBLE), 0) AS last, CAST(0 AS DOUBLE) AS beyond FROM fact GROUP BY mun""",
    "series_micro": f"""WITH {_FACT}, {_YEARS},
        t AS (SELECT mic, year, {_dbl('a', 'p', 'v')} FROM fact GROUP BY ALL),
        grid AS (SELECT * FROM (SELECT DISTINCT mic FROM t) CROSS JOIN years)
        SELECT mic, year, coalesce(a, 0) AS a, coalesce(p, 0) AS p, coalesce(v, 0) AS v, a IS NOT NULL AS is_observed FROM grid LEFT JOIN t USING (mic, year)""",
    "series_national": f"""WITH {_FACT}, {_YEARS}, t AS (SELECT year, CAST(sum(v) AS DOUBLE) AS value FROM fact GROUP BY year)
        SELECT year, coalesce(value, 0) AS value, value IS NOT NULL AS is_observed FROM years LEFT JOIN t USING (year)""",
    "series_municipality": f"""WITH {_FACT}, {_YEARS},
        t AS (SELECT mun, year, CAST(sum(p) AS DOUBLE) AS p FROM fact GROUP BY ALL),
        grid AS (SELECT * FROM (SELECT DISTINCT mun FROM t) CROSS JOIN years)
        SELECT mun, year, coalesce(p, 0) AS p, p IS NOT NULL AS is_observed FROM grid LEFT JOIN t USING (mun, year)""",
    "series_state_from_mun": f"""WITH {_FACT}, {_YEARS},
        t AS (SELECT uf, year, CAST(sum(p) AS DOUBLE) AS p FROM fact GROUP BY ALL),
        grid AS (SELECT * FROM (SELECT DISTINCT uf FROM t) CROSS JOIN years)
        SELECT uf, year, coalesce(p, 0) AS p, p IS NOT NULL AS is_observed FROM grid LEFT JOIN t USING (uf, year)""",
    "series_by_scope": f"""WITH {_FACT}, {_YEARS}
        SELECT 'country' AS scope, years.year, coalesce(CAST(sum(p) AS DOUBLE), 0) AS value FROM years LEFT JOIN fact USING (year) GROUP BY ALL
        UNION ALL SELECT 'uf', years.year, coalesce(CAST(sum(p) AS DOUBLE), 0) FROM years LEFT JOIN fact ON fact.year = years.year AND uf = 'NATION_3' GROUP BY ALL
        UNION ALL SELECT 'mic', years.year, coalesce(CAST(sum(p) AS DOUBLE), 0) FROM years LEFT JOIN fact ON fact.year = years.year AND mic = 'NATION_7-BUILDING' GROUP BY ALL""",
    "yield_series": f"""WITH {_FACT}, {_YEARS},
        t AS (SELECT year, CAST(sum(p) AS DOUBLE) * 1000 / CAST(sum(a) AS DOUBLE) AS value FROM fact GROUP BY year)
        SELECT year, coalesce(value, 0) AS value, value IS NOT NULL AS is_observed FROM years LEFT JOIN t USING (year)""",
    "top_states": f"""WITH {_FACT}, {_NAMES},
        t AS (SELECT uf, sum(v) AS v FROM fact GROUP BY uf)
        SELECT uf, uf_name, CAST(v AS DOUBLE) AS value FROM t JOIN names USING (uf) WHERE v > 0 ORDER BY v DESC, uf LIMIT 15""",
    "top_categories": f"""WITH {_FACT}, t AS (SELECT category, sum(p) AS p FROM fact GROUP BY category)
        SELECT category, CAST(p AS DOUBLE) AS value FROM t WHERE p > 0 ORDER BY p DESC, category LIMIT 15""",
    "top_categories_in_state": f"""WITH {_FACT}, t AS (SELECT uf, category, sum(p) AS p FROM fact GROUP BY ALL),
        ranked AS (SELECT *, CAST(row_number() OVER (PARTITION BY uf ORDER BY p DESC, category) AS INTEGER) AS position FROM t WHERE p > 0)
        SELECT uf, category, CAST(p AS DOUBLE) AS p, position FROM ranked WHERE position <= 15""",
    "top_livestock_categories": f"""WITH {_LIVESTOCK}, t AS (SELECT category, sum(q) AS q FROM rows WHERE kind = 'Producao' GROUP BY category)
        SELECT category, CAST(q AS DOUBLE) AS value FROM t WHERE q > 0 ORDER BY q DESC, category LIMIT 15""",
    "top_micros": f"""WITH {_FACT}, t AS (SELECT mic, mic_name, sum(a) AS a FROM fact GROUP BY ALL)
        SELECT mic, mic_name, CAST(a AS DOUBLE) AS value FROM t WHERE a > 0 ORDER BY a DESC, mic LIMIT 20""",
    "top_micros_zeros": f"""WITH {_LIVESTOCK}, t AS (SELECT mic, sum(v) AS v FROM rows WHERE category = 'click' GROUP BY mic),
        m AS (SELECT DISTINCT mic, mic_name FROM places)
        SELECT mic, mic_name, coalesce(CAST(v AS DOUBLE), 0) AS value FROM m LEFT JOIN t USING (mic) ORDER BY value DESC, mic LIMIT 15""",
    "mun_ranking": f"""WITH {_FACT}, t AS (SELECT uf, mun, mun_name, mic_name, sum(p) AS p FROM fact GROUP BY ALL),
        ranked AS (SELECT *, CAST(row_number() OVER (PARTITION BY uf ORDER BY p DESC, mun) AS INTEGER) AS position FROM t WHERE p > 0)
        SELECT uf, mun, mun_name, mic_name, CAST(p AS DOUBLE) AS p, position FROM ranked WHERE position <= 100""",
    "top_municipalities": f"""WITH {_FACT}, t AS (SELECT mun, mun_name, mic_name, sum(p) AS p FROM fact GROUP BY ALL)
        SELECT CAST(row_number() OVER (ORDER BY p DESC, mun) AS INTEGER) AS position, mun, mun_name, mic_name, CAST(p AS DOUBLE) AS value
        FROM t WHERE p > 0 QUALIFY position <= 15""",
    "top_k_per_scope": f"""WITH {_FACT}, t AS (SELECT uf, mic, year, sum(v) AS v FROM fact GROUP BY ALL),
        ranked AS (SELECT *, CAST(row_number() OVER (PARTITION BY uf, year ORDER BY v DESC, mic) AS INTEGER) AS position FROM t WHERE v > 0)
        SELECT uf, mic, year, CAST(v AS DOUBLE) AS v, position FROM ranked WHERE position <= 3""",
    "rank_position": f"""WITH {_FACT}, t AS (SELECT uf, mun, sum(p) AS p FROM fact GROUP BY ALL)
        SELECT uf, mun, CAST(p AS DOUBLE) AS p, row_number() OVER (PARTITION BY uf ORDER BY p DESC, mun) AS position FROM t""",
    "compat_state_yields": f"""WITH {_CLASSED},
        t AS (SELECT uf, category, year, CAST(printf('%.2f', CAST(sum(r) AS DOUBLE) / count(r)) AS DECIMAL(18,2)) AS r
              FROM classed WHERE kind = 'TEM' GROUP BY ALL)
        SELECT uf, year, CAST(sum(r) AS DOUBLE) AS value FROM t GROUP BY ALL""",
    "compat_micro_values": f"""WITH {_CLASSED}, t AS (SELECT mic, year, CAST(sum(v) AS DOUBLE) AS v FROM classed WHERE kind = 'PER' GROUP BY ALL)
        SELECT mic, year, CAST(printf('%.1f', v) AS DOUBLE) AS value FROM t""",
    "compat_mun_values": f"""WITH {_CLASSED}, t AS (SELECT mun, year, CAST(sum(v) AS DOUBLE) AS v FROM classed WHERE grp = 'COL' GROUP BY ALL)
        SELECT mun, year, CAST(printf('%.1f', v) AS DOUBLE) AS value FROM t""",
    "compat_kpis": f"""WITH {_FACT}, t AS (SELECT uf, category, {_dbl('a', 'p', 'v')} FROM fact GROUP BY ALL),
        u AS (SELECT uf, category, CAST(printf('%.1f', a) AS DECIMAL(18,1)) AS a, CAST(printf('%.1f', p) AS DECIMAL(18,1)) AS p,
                     CAST(printf('%.1f', v) AS DECIMAL(18,1)) AS v FROM t)
        SELECT {_dbl('a', 'p', 'v')}, count(*) FILTER (a + p + v > 0) AS pair_count, count(DISTINCT category) FILTER (a + p + v > 0) AS crop_count FROM u""",
    "kpi_crop": f"""WITH {_FACT}, t AS (SELECT year, uf, category, sum(a) AS a, sum(p) AS p, sum(v) AS v FROM fact GROUP BY ALL)
        SELECT year, {_dbl('a', 'p', 'v')}, count(*) FILTER (a + p + v > 0) AS pair_count,
               count(DISTINCT category) FILTER (a + p + v > 0) AS crop_count FROM t GROUP BY year""",
    "kpi_livestock": f"""WITH {_LIVESTOCK}, t AS (SELECT category, mun, sum(q) AS q, sum(v) AS v FROM rows GROUP BY ALL)
        SELECT category, {_dbl('q', 'v')}, count(*) FILTER (q > 0) AS municipalities FROM t GROUP BY category""",
    "scope_counts": f"""WITH {_FACT}, m AS (SELECT uf, count(DISTINCT mic) AS micro_regions FROM places GROUP BY uf),
        t AS (SELECT uf, mun, sum(p) AS p FROM fact GROUP BY ALL), n AS (SELECT uf, count(*) FILTER (p > 0) AS municipalities FROM t GROUP BY uf)
        SELECT uf, micro_regions, coalesce(municipalities, 0) AS municipalities FROM m LEFT JOIN n USING (uf)""",
    "choropleth_classes": f"""WITH {_FACT}, t AS (SELECT uf, mic, year, CAST(sum(p) AS DOUBLE) AS value FROM fact GROUP BY ALL),
        s AS (SELECT *, greatest(max(value) OVER (PARTITION BY uf, year), 1.0) AS scope_max FROM t),
        c AS (SELECT *, CASE WHEN value = 0 THEN 0 ELSE CAST(floor(least(ln(1 + value) / ln(1 + scope_max), 1) * 6) AS INTEGER) END AS class_index FROM s)
        SELECT uf, mic, year, value, scope_max, class_index, {_palette('class_index', fixed.PALETTE_REGION)} AS colour FROM c""",
    "value_over_scope_max": f"""WITH {_FACT}, t AS (SELECT uf, CAST(sum(p) AS DOUBLE) AS value FROM fact GROUP BY uf)
        SELECT uf, value, greatest(max(value) OVER (), 1.0) AS scope_max FROM t""",
    "legend_steps": f"""WITH {_FACT}, t AS (SELECT uf, year, CAST(sum(p) AS DOUBLE) AS value FROM fact GROUP BY ALL),
        s AS (SELECT year, greatest(max(value), 1.0) AS scope_max FROM t GROUP BY year),
        steps AS (SELECT CAST(unnest(range(0, 7)) AS INTEGER) AS step)
        SELECT year, step, {_palette('step', fixed.PALETTE_COUNTRY)} AS colour, scope_max * step / 6 AS linear_value,
               round(exp(ln(1 + scope_max) * step / 6) - 1, 2) AS log_value FROM s CROSS JOIN steps""",
    "feature_values": f"""WITH {_LIVESTOCK}, f AS (SELECT DISTINCT mic, uf FROM places), t AS (SELECT mic, CAST(sum(q) AS DOUBLE) AS value FROM rows GROUP BY mic)
        SELECT mic, uf, coalesce(value, 0) AS value FROM f LEFT JOIN t USING (mic)""",
    "features_in_scope": f"WITH {_LIVESTOCK} SELECT DISTINCT mic FROM places WHERE mic IN (SELECT mic FROM rows)",
    "fmt_magnitude": f"""WITH {_FACT},
        t AS (SELECT uf || '/' || category AS place, year, {_dbl('a', 'p', 'v')} FROM fact GROUP BY ALL
              UNION ALL SELECT 'country', year, {_dbl('a', 'p', 'v')} FROM fact GROUP BY ALL)
        SELECT place, year, {_magnitude('a')} AS a_text, {_magnitude('p')} AS p_text, {_magnitude('v')} AS v_text,
               {_brazilian('a', 1)} || ' kg/ha' AS r_text FROM t""",
    "export_slice": f"""WITH {_FACT}, {_NAMES}
        SELECT fact.uf, uf_name, category, year, CAST(sum(p) AS DOUBLE) AS value FROM fact JOIN names USING (uf) GROUP BY ALL HAVING sum(p) <> 0""",
    "export_nested_json": f"""WITH {_FACT}, t AS (SELECT uf, year, category, CAST(sum(a) AS DECIMAL(18,2)) AS a FROM fact GROUP BY ALL)
        SELECT uf, year, '{{' || string_agg('"' || category || '":' || a, ',' ORDER BY category) || '}}' AS data FROM t GROUP BY ALL""",
    "nested_package": f"""WITH {_FACT}, {_YEARS},
        t AS (SELECT uf, category, year, CAST(sum(a) AS DECIMAL(18,2)) AS a, CAST(sum(p) AS DECIMAL(18,2)) AS p FROM fact GROUP BY ALL),
        grid AS (SELECT * FROM (SELECT DISTINCT uf, category FROM t) CROSS JOIN years),
        packed AS (SELECT uf, category, string_agg(coalesce(a, 0)::VARCHAR, ',' ORDER BY year) AS a, string_agg(coalesce(p, 0)::VARCHAR, ',' ORDER BY year) AS p
                   FROM grid LEFT JOIN t USING (uf, category, year) GROUP BY ALL)
        SELECT uf, '{{' || string_agg('"' || category || '":{{"a":[' || a || '],"p":[' || p || ']}}', ',' ORDER BY category) || '}}' AS package FROM packed GROUP BY uf""",
    "crop_labels": f"""WITH {_FACT}, t AS (SELECT CAST(sum(a) AS DOUBLE) AS a, CAST(sum(p) AS DOUBLE) AS p, CAST(sum(v) AS DOUBLE) AS v FROM fact)
        SELECT 'a' AS metric, a AS value, {_magnitude('a')} AS text, 'Área Colhida (ha)' AS label FROM t
        UNION ALL SELECT 'p', p, {_magnitude('p')}, 'Produção (ton)' FROM t
        UNION ALL SELECT 'v', v, {_magnitude('v')}, 'Valor (mil R$)' FROM t""",
    "api_payload_rows": """WITH t AS (SELECT *, CAST(json_extract(props, '$.k') AS INTEGER) AS k FROM events)
        SELECT CASE event_type WHEN 'click' THEN 'SP' WHEN 'view' THEN 'RJ' END AS uf, CASE WHEN event_type IN ('click', 'view') THEN 'Sudeste' ELSE '??' END AS region,
               'Rebanho' AS kind, CAST(year(ts) AS INTEGER) AS year, event_type AS category, CASE WHEN k % 2 = 0 THEN 'Efetivo_Cabecas' ELSE '999' END AS variable,
               count(*) AS rows, count(*) FILTER (k <> 3 AND value IS NOT NULL) AS numbers, CAST(sum(CAST(value AS DECIMAL(12,2))) FILTER (k <> 3) AS DOUBLE) AS total FROM t GROUP BY ALL""",
    "geo_feature_rows": f"""WITH codes(code, uf) AS (VALUES {', '.join(f"({s[0]!r}, {s[1]!r})" for s in fixed.STATES)}),
        t AS (SELECT CASE WHEN c_mktsegment = 'BUILDING' THEN '0' ELSE '' END || (c_nationkey + 11) AS codarea, CAST(c_nationkey + 11 AS VARCHAR) AS code FROM customer)
        SELECT codarea, coalesce(uf, code) AS uf, '{{"type":"Polygon","coordinates":[]}}' AS geometry, count(*) AS n FROM t LEFT JOIN codes USING (code) GROUP BY ALL""",
    "category_flags_parse": f"""WITH {_GROUPS} SELECT category, CASE WHEN n % 2 = 1 THEN 'PER' END AS kind,
        CAST(CASE WHEN n % 4 < 2 THEN 1 ELSE 0 END AS INTEGER) AS COL, CAST(0 AS INTEGER) AS XYZ FROM groups""",
    "municipality_series": f"""WITH {_FACT}, {_YEARS}
        SELECT 'one' AS asked, years.year, coalesce(CAST(sum(p) AS DOUBLE), 0) AS value FROM years LEFT JOIN fact ON fact.year = years.year AND mun = 7 GROUP BY ALL
        UNION ALL SELECT 'none', years.year, coalesce(CAST(sum(p) AS DOUBLE), 0) FROM years LEFT JOIN fact ON fact.year = years.year AND uf = 'NATION_3' GROUP BY ALL""",
    "kpi_livestock_known": f"""WITH {_LIVESTOCK}, known AS (SELECT mun AS k FROM places WHERE mic_name = 'BUILDING'),
        t AS (SELECT category, mun, sum(q) AS q, sum(v) AS v FROM rows GROUP BY ALL)
        SELECT category, {_dbl('q', 'v')}, count(*) FILTER (q > 0 AND mun IN (SELECT k FROM known)) AS municipalities FROM t GROUP BY category""",
    "export_document": f"""WITH {_FACT}, t AS (SELECT uf, category, CAST(sum(a) AS DOUBLE) AS a FROM fact WHERE year = 1998 GROUP BY ALL),
        maps AS (SELECT uf, '"' || uf || '":{{' || coalesce(string_agg('"' || category || '":' || a, ',' ORDER BY category) FILTER (a <> 0), '') || '}}' AS m
                 FROM (SELECT DISTINCT uf FROM fact) LEFT JOIN t USING (uf) GROUP BY uf)
        SELECT '{{"ano":1998,"metrica":"a","uf":"BR","data":{{' || string_agg(m, ',' ORDER BY uf) || '}}}}' AS document FROM maps""",
}

_STATE_CODES = ", ".join(f"({n}, '{s[0]}', '{s[1]}')" for n, s in enumerate(fixed.STATES))
_CROP_FILE = f"""codes(n, uf_code, uf) AS (VALUES {_STATE_CODES}), {_GROUPS},
lines AS (
  SELECT uf, uf || '-' || c_mktsegment AS mic, uf_code || c_custkey AS mun, p_brand AS category, year(o_orderdate) AS year, c_custkey % 97 = 5 AS a_bad,
         c_custkey % 89 = 7 AS p_bad, c_custkey % 13 = 2 AS v_nan, false AS v_bad, CAST(l_quantity AS DECIMAL(12,2)) AS a, CAST(l_extendedprice AS DECIMAL(12,2)) AS p,
         CASE WHEN c_custkey % 13 <> 2 THEN CAST(l_extendedprice AS DECIMAL(12,2)) END AS v, CAST(p_retailprice AS DECIMAL(12,2)) AS r
  FROM lineitem JOIN part ON l_partkey = p_partkey JOIN orders ON l_orderkey = o_orderkey JOIN customer ON o_custkey = c_custkey JOIN codes ON c_nationkey = n),
classed AS (SELECT lines.*, kind, CASE WHEN COL = 1 THEN 'COL' WHEN kind = 'TEM' THEN 'TRA' ELSE 'PER' END AS grp FROM lines JOIN groups USING (category)),
years AS (SELECT year, CAST(row_number() OVER (ORDER BY year) - 1 AS INTEGER) AS position FROM (SELECT DISTINCT year FROM lines))"""


def _published(measure: str) -> str:
    return f"CAST(printf('%.1f', CASE WHEN bool_or({measure}_bad) THEN 0 ELSE coalesce(CAST(sum({measure}) AS DOUBLE), 0) END) AS DOUBLE)"


def _section(name: str, source: str, key: str, member: str, yields: str = "CAST(NULL AS DOUBLE)") -> str:
    """Dense series of one section: every key and member in every year."""
    r = "coalesce(r, 0)" if name == "est_data" else "r"
    return f"""SELECT '{name}' AS section, g.key, g.member, position, coalesce(a, 0) AS a, coalesce(p, 0) AS p, coalesce(v, 0) AS v, {r} AS r, CAST(NULL AS VARCHAR) AS entry
        FROM (SELECT DISTINCT {key} AS key, {member} AS member FROM {source}) g CROSS JOIN years y LEFT JOIN (
          SELECT {key} AS key, {member} AS member, year, {', '.join(f'{_published(m)} AS {m}' for m in 'apv')}, {yields} AS r FROM {source} GROUP BY 1, 2, 3
        ) c ON c.key = g.key AND c.member IS NOT DISTINCT FROM g.member AND c.year = y.year"""


def _list(name: str, condition: str) -> str:
    return f"""SELECT '{name}', NULL, NULL, CAST(row_number() OVER (ORDER BY category) - 1 AS INTEGER), NULL, NULL, NULL, NULL, category
        FROM (SELECT DISTINCT category FROM classed WHERE {condition})"""


ORACLES["crop_package"] = f"""WITH {_CROP_FILE},
members AS (
  SELECT *, 'ALL' AS member FROM classed UNION ALL SELECT *, kind FROM classed UNION ALL SELECT *, grp FROM classed WHERE grp IN ('COL', 'TRA')
  UNION ALL SELECT *, category FROM classed WHERE grp = 'COL'),
fixed_groups AS (SELECT * FROM members WHERE member IN ('TEM', 'PER', 'COL', 'TRA'))
{_section("est_data", "classed", "uf", "category", "CAST(printf('%.2f', CAST(sum(r) AS DOUBLE) / count(r)) AS DOUBLE)")}
UNION ALL {_section("mic_data", "members", "mic", "member")}
UNION ALL {_section("mun_data", "classed", "mun", "CAST(NULL AS VARCHAR)")}
UNION ALL {_section("mun_grp_data", "fixed_groups", "mun", "member")}
UNION ALL {_list("culturas", "true")} UNION ALL {_list("colheitadeiras", "grp = 'COL'")} UNION ALL {_list("tratores", "kind = 'TEM' AND grp <> 'COL'")}
UNION ALL {_list("permanentes", "kind = 'PER'")} UNION ALL {_list("temporarias", "kind = 'TEM'")}
UNION ALL SELECT 'anos', NULL, NULL, position, NULL, NULL, NULL, NULL, CAST(year AS VARCHAR) FROM years"""

ORACLES["rejected_crop_cells"] = f"""WITH {_CROP_FILE},
cells AS (
  SELECT 'a' AS measure, 'infinite' AS problem, 'Infinity' AS value, mun FROM lines WHERE a_bad
  UNION ALL SELECT 'p', 'too_large', '1.0E300', mun FROM lines WHERE p_bad UNION ALL SELECT 'v', 'nan', 'NaN', mun FROM lines WHERE v_nan)
SELECT measure, problem, value, count(*) AS rows, count(DISTINCT mun) AS municipalities FROM cells GROUP BY ALL
UNION ALL SELECT NULL, NULL, 'cell ' || problem || ': ' || measure, count(*), NULL FROM cells GROUP BY measure, problem"""

_QUARTERS = f"""{_FACT},
quarterly AS (
  SELECT mic, n_name AS uf, p_brand AS category, CAST(year(o_orderdate) * 4 + quarter(o_orderdate) - 1 AS INTEGER) AS quarter, CAST(l_quantity AS DECIMAL(12,2)) AS a,
         CAST(l_extendedprice AS DECIMAL(12,2)) AS p, CAST(l_extendedprice AS DECIMAL(12,2)) * (1 - CAST(l_discount AS DECIMAL(4,2))) AS v
  FROM lineitem JOIN part ON l_partkey = p_partkey JOIN orders ON l_orderkey = o_orderkey JOIN places ON o_custkey = mun JOIN nation ON n_name = uf),
quarters AS (SELECT DISTINCT CAST(year(o_orderdate) * 4 + quarter(o_orderdate) - 1 AS INTEGER) AS quarter FROM orders)"""
_ZEROED = ", ".join(f"coalesce({m}, 0) AS {m}" for m in "apv")

ORACLES["dense_quarters"] = f"""WITH {_QUARTERS}, cells AS (SELECT mic, quarter, {_dbl('a', 'p', 'v')}, count(*) AS n FROM quarterly GROUP BY ALL)
SELECT mic, quarter, {_ZEROED}, n IS NOT NULL AS is_observed FROM (SELECT DISTINCT mic FROM cells) CROSS JOIN quarters LEFT JOIN cells USING (mic, quarter)"""
ORACLES["packed_quarters"] = f"""WITH {_QUARTERS}, cells AS (SELECT uf, category, quarter, {_dbl('a', 'p', 'v')} FROM quarterly GROUP BY ALL),
numbered AS (SELECT quarter, CAST(row_number() OVER (ORDER BY quarter) - 1 AS INTEGER) AS period FROM quarters)
SELECT uf, category, period, {_ZEROED} FROM (SELECT DISTINCT uf, category FROM cells) CROSS JOIN numbered LEFT JOIN cells USING (uf, category, quarter)"""

_HERD, _PRODUCT = fixed.SURVEY_TABLES
_SLICES = f"""codes(n, uf_code, uf) AS (VALUES {_STATE_CODES}),
sliced AS (
  SELECT CAST(CASE WHEN event_type IN ('purchase', 'signup') THEN {_PRODUCT} ELSE {_HERD} END AS INTEGER) AS survey_table, CAST(day(ts) + 2000 AS INTEGER) AS slice_year, uf,
         event_type AS category, CASE WHEN event_type NOT IN ('purchase', 'signup') THEN 'Efetivo_Cabecas' WHEN event_id % 2 = 0 THEN 'Quantidade' ELSE 'Valor_mil_reais' END AS variable,
         event_id, user_id AS mun, CAST(value AS DECIMAL(18,2)) AS value
  FROM events JOIN customer ON user_id = c_custkey JOIN codes ON c_nationkey = n)"""

ORACLES["ingested_slices"] = f"""WITH {_SLICES}
SELECT survey_table, slice_year, uf, category, variable, count(*) AS rows, CAST(sum(value + CASE WHEN slice_year BETWEEN 2005 AND 2009 THEN 1 ELSE 0 END) AS DOUBLE) AS total
FROM sliced GROUP BY ALL"""
ORACLES["landed_slice_rows"] = f"""WITH {_SLICES}, told AS (
  SELECT *, CASE WHEN event_id % 9 = 0 THEN 'too few' WHEN event_id % 11 = 0 THEN 'too many' ELSE 'kept' END AS state FROM sliced)
SELECT survey_table, slice_year AS year, uf, category, state, count(*) AS rows, CAST(sum(value) AS DOUBLE) AS total FROM told WHERE state = 'kept' GROUP BY ALL
UNION ALL SELECT survey_table, slice_year, NULL, NULL, state, count(*), NULL FROM told WHERE state <> 'kept' GROUP BY ALL"""

_CORRECTED = f"""{_CROP_FILE},
final AS (
  SELECT * REPLACE (a + CASE WHEN year = 1995 AND uf = '{fixed.STATES[3][1]}' THEN 1 ELSE 0 END AS a) FROM classed WHERE NOT (year = 1996 AND uf = '{fixed.STATES[5][1]}')),
members AS (
  SELECT *, 'ALL' AS member FROM final UNION ALL SELECT *, kind FROM final UNION ALL SELECT *, grp FROM final WHERE grp IN ('COL', 'TRA')
  UNION ALL SELECT *, category FROM final WHERE grp = 'COL')"""


def _refreshed(name: str, source: str, key: str, member: str, r_mean: str = "CAST(NULL AS DOUBLE)") -> str:
    sums = ", ".join(f"CASE WHEN NOT bool_or({m}_bad) THEN CAST(sum({m}) AS DOUBLE) END AS {m}" for m in "apv")
    return f"""SELECT '{name}' AS rollup, {key} AS key, {member} AS member, CAST(year AS INTEGER) AS year, {sums}, {r_mean} AS r_mean FROM {source} GROUP BY 1, 2, 3, 4"""


ORACLES["refreshed_crop"] = f"""WITH {_CORRECTED}
{_refreshed("state_category", "final", "uf", "category", "CAST(sum(r) AS DOUBLE) / count(r)")}
UNION ALL {_refreshed("micro_groups", "members", "mic", "member")}
UNION ALL {_refreshed("municipality", "final", "mun", "CAST(NULL AS VARCHAR)")}
UNION ALL {_refreshed("municipality_groups", "(SELECT * FROM members WHERE member IN ('TEM', 'PER', 'COL', 'TRA'))", "mun", "member")}"""


def _wide(value: str, micro: str) -> str:
    """Slices made wide: where events repeat a place, category and year, the least value of each variable; a missing value is 0."""
    return f"""wide AS (
  SELECT sliced.uf, {micro} AS mic, sliced.mun, slice_year AS year, category, min({value}) FILTER (variable <> 'Valor_mil_reais') AS q,
         coalesce(min({value}) FILTER (variable = 'Valor_mil_reais'), 0) AS v
  FROM sliced JOIN places ON sliced.mun = places.mun JOIN customer ON c_custkey = sliced.mun GROUP BY ALL)"""


ORACLES["refreshed_livestock"] = f"""WITH {_PLACES}, {_SLICES}, {_wide("value + CASE WHEN slice_year BETWEEN 2005 AND 2009 THEN 1 ELSE 0 END", "places.mic")}
SELECT 'uf' AS level, uf AS key, category, year, {_dbl('q', 'v')} FROM wide GROUP BY ALL
UNION ALL SELECT 'mic', mic, category, year, {_dbl('q', 'v')} FROM wide GROUP BY ALL
UNION ALL SELECT 'mun', CAST(mun AS VARCHAR), category, year, {_dbl('q', 'v')} FROM wide GROUP BY ALL"""


def _herd_section(name: str, key: str) -> str:
    q, v = (f"CAST(printf('%.1f', coalesce(CAST(sum({m}) AS DOUBLE), 0)) AS DOUBLE) AS {m}" for m in "qv")
    return f"""SELECT '{name}' AS section, g.key, g.member, position, coalesce(q, 0) AS q, coalesce(v, 0) AS v, CAST(NULL AS VARCHAR) AS entry
  FROM (SELECT DISTINCT CAST({key} AS VARCHAR) AS key, category AS member FROM located) g CROSS JOIN calendar LEFT JOIN (
    SELECT CAST({key} AS VARCHAR) AS key, category AS member, year, {q}, {v} FROM located GROUP BY 1, 2, 3) c USING (key, member, year)"""


def _kinds(name: str, test: str) -> str:
    return f"""SELECT '{name}', NULL, NULL, CAST(row_number() OVER (ORDER BY category) - 1 AS INTEGER), NULL, NULL, category
  FROM (SELECT DISTINCT category FROM located WHERE category {test} ('purchase', 'signup'))"""


ORACLES["livestock_package"] = f"""WITH {_PLACES}, {_SLICES}, {_wide("value", "c_nationkey * 100 + ascii(c_mktsegment)")},
located AS (SELECT * FROM wide WHERE mun % 50 <> 0),
calendar AS (SELECT year, CAST(row_number() OVER (ORDER BY year) - 1 AS INTEGER) AS position FROM (SELECT DISTINCT year FROM located))
{_herd_section("est_data", "uf")} UNION ALL {_herd_section("mic_data", "mic")} UNION ALL {_herd_section("mun_data", "mun")}
UNION ALL {_kinds("rebanho_categorias", "NOT IN")} UNION ALL {_kinds("producao_categorias", "IN")}
UNION ALL SELECT 'anos', NULL, NULL, position, NULL, NULL, CAST(year AS VARCHAR) FROM calendar"""

ORACLES["geo_files"] = f"""WITH codes(n, uf_code, uf) AS (VALUES {_STATE_CODES}),
counted AS (SELECT n, count(*) AS value FROM customer JOIN codes ON c_nationkey = n WHERE n % 5 <> 0 GROUP BY n)
SELECT 'Feature' AS type, CASE WHEN c_mktsegment = 'BUILDING' THEN '0' ELSE '' END || uf_code AS codarea, CAST(coalesce(value, 0) AS DOUBLE) AS value, 'Polygon' AS shape,
       count(*) AS features, CAST(sum(c_custkey) AS BIGINT) AS corner
FROM customer JOIN codes ON c_nationkey = codes.n LEFT JOIN counted ON counted.n = codes.n GROUP BY ALL"""

_COUNTS = "CAST(count(DISTINCT mun) AS BIGINT) AS municipalities, CAST(count(DISTINCT category) AS BIGINT) AS categories, CAST(count(DISTINCT year) AS BIGINT) AS years"
ORACLES["profile_levels"] = f"""WITH {_FACT}
SELECT uf, year, {_COUNTS}, 'state_year' AS level FROM fact GROUP BY uf, year UNION ALL SELECT uf, NULL, {_COUNTS}, 'state' FROM fact GROUP BY uf
UNION ALL SELECT NULL, year, {_COUNTS}, 'year' FROM fact GROUP BY year UNION ALL SELECT NULL, NULL, {_COUNTS}, 'country' FROM fact"""

ORACLES["micro_rejects"] = f"""WITH {_PLACES},
seen AS (SELECT DISTINCT CASE WHEN CAST(json_extract(props, '$.k') AS INTEGER) = 0 THEN -user_id ELSE user_id END AS mun, event_type AS category FROM events),
joined AS (SELECT seen.*, mic FROM seen LEFT JOIN places USING (mun))
SELECT category, nullif(count(DISTINCT mic), 0) AS micro_regions, nullif(count(mic), 0) AS municipalities, nullif(count(*) FILTER (mic IS NULL), 0) AS rejected_rows
FROM joined GROUP BY category"""

ORACLES["clustered_scope"] = f"""WITH {_FACT}
SELECT uf, category, year, CAST(sum(a) AS DOUBLE) AS a, CAST(sum(p) AS DOUBLE) AS p, CAST(sum(v) AS DOUBLE) AS v, count(DISTINCT mun) AS municipalities
FROM fact WHERE uf = 'NATION_3' AND category BETWEEN 'Brand#2' AND 'Brand#4' GROUP BY ALL"""

ORACLES["bucketed_places"] = f"""WITH {_FACT}
SELECT places.mun, places.mun_name, places.mic, places.uf, CAST(sum(a) AS DOUBLE) AS a, CAST(sum(p) AS DOUBLE) AS p, count(DISTINCT category) AS categories
FROM places LEFT JOIN fact USING (mun) GROUP BY ALL"""
