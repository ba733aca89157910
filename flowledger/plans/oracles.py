"""DuckDB SQL for the registered queries, assembled from shared WITH clauses.

Used only to check results; the engine itself never runs it.
"""

from __future__ import annotations

import re

MEASURES = ["Hours", "GasProduction", "OilProduction", "CondensateProduction", "WaterProduction",
            "EthaneMixVolume", "PropaneMixVolume", "ButaneMixVolume", "PentaneMixVolume",
            "PentaneSpecVolume", "LiteMixVolume"]
PRODUCTION = ["OilProduction", "GasProduction", "CondensateProduction"]
MAIN = ["GasProduction", "OilProduction", "CondensateProduction", "WaterProduction"]

# One half plus the tolerance of a tie.
HALF = 0.5003

_K = "CAST(substr(WellID, 2) AS BIGINT)"
_SERIES = "PARTITION BY WellID, ProductionType ORDER BY t, ProductionMonth"


def _exact(columns: list[str]) -> str:
    return ", ".join(f"CAST(sum(CAST({c} AS DECIMAL(18,4))) AS DOUBLE) AS {c}" for c in columns)


def rounded(columns: list[str], digits: int = 4) -> str:
    return ", ".join(f"rnd({c}, {digits}) AS {c}" for c in columns)


def _write_rnd(text: str) -> str:
    """Write out rnd(x, d): round half up, where anything a hair below a tie counts as the tie.

    Engines add in different order, so a tie such as 0.12345 may be one bit off in either.
    """
    at = text.find("rnd(")
    if at < 0:
        return text
    depth, comma, end = 0, 0, at + 3
    for end in range(at + 3, len(text)):
        depth += {"(": 1, ")": -1}.get(text[end], 0)
        if text[end] == "," and depth == 1:
            comma = end
        if depth == 0:
            break
    inner, digits = text[at + 4:comma], int(text[comma + 1:end])
    return text[:at] + _write_rnd(f"floor(({inner}) * 1e{digits} + {HALF}e0) / 1e{digits}") + _write_rnd(text[end + 1:])


def _rolling() -> str:
    cases = []
    for w in (3, 4, 5, 6):
        before, after = w // 2, (w - 1) // 2
        cases.append(f"WHEN width = {w} AND idx >= {before} AND idx + {after} < n THEN avg(q) OVER "
                     f"({_SERIES} ROWS BETWEEN {before} PRECEDING AND {after} FOLLOWING)")
    return "CASE WHEN width < 3 THEN q " + " ".join(cases) + " END"


def _points(source: str, measures: list[str], t: str, month: str = "ProductionMonth",
            column: str = "{m}") -> str:
    return " UNION ALL ".join(
        f"SELECT WellID, '{m}' AS ProductionType, {month} AS ProductionMonth, {t} AS t, "
        f"{column.format(m=m)} AS q FROM {source}" for m in measures)


_SHAPE = ("CASE curve WHEN 'exponential' THEN exp(-exp(u) * y) WHEN 'harmonic' THEN 1 / (1 + exp(u) * y) "
          "ELSE exp(-ln(1 + b * exp(u) * y) / b) END")
_RATE = ("CASE CurveType WHEN 'exponential' THEN qi * exp(-di * (day - t_offset) / 365.25e0) "
         "WHEN 'hyperbolic' THEN qi * power(1 + b * di * (day - t_offset) / 365.25e0, -1 / b) "
         "WHEN 'harmonic' THEN qi / (1 + di * (day - t_offset) / 365.25e0) END")
_DAY = "CAST(floor(last_day + 30 + {i} * 30.44e0) AS INTEGER)"

CTES = {
    "line": """SELECT 'W' || lpad(CAST(l_suppkey AS VARCHAR), CAST(greatest(12, length(CAST(l_suppkey AS VARCHAR))) AS INTEGER), '0') AS WellID,
  CAST(date_trunc('month', l_shipdate) AS DATE) AS ProductionMonth, l_returnflag AS Pool, l_linestatus AS Area,
  l_quantity * 4 AS Hours, l_extendedprice AS GasProduction, l_quantity AS OilProduction,
  l_quantity * (l_discount - 0.02e0) AS CondensateProduction, l_quantity * l_tax AS WaterProduction,
  l_quantity * l_discount AS EthaneMixVolume,
  CASE WHEN l_linenumber <> 5 THEN l_quantity * 0.1e0 END AS PropaneMixVolume,
  l_quantity * 0.05e0 AS ButaneMixVolume, l_quantity * 0.02e0 AS PentaneMixVolume,
  l_quantity * 0.01e0 AS PentaneSpecVolume, l_quantity * 0.03e0 AS LiteMixVolume FROM lineitem""",
    "attributes": """SELECT 'W' || lpad(CAST(s_suppkey AS VARCHAR), CAST(greatest(12, length(CAST(s_suppkey AS VARCHAR))) AS INTEGER), '0') AS WellID,
  'F' || CAST(s_nationkey AS VARCHAR) AS ReportingFacilityID, s_name AS ReportingFacilityName,
  'N' || CAST(n_nationkey AS VARCHAR) AS OperatorBAID, n_name AS OperatorName,
  'L' || CAST(s_suppkey AS VARCHAR) AS WellLicenseNumber, r_name AS Field
  FROM supplier JOIN nation ON s_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey""",
    "merged": f"""SELECT WellID, ProductionMonth, min(Pool) AS Pool, min(Area) AS Area, {_exact(MEASURES)},
  count(*) AS LineCount FROM line GROUP BY WellID, ProductionMonth""",
    "well_month": "SELECT * FROM merged JOIN attributes USING (WellID)",
    "injected": f"""SELECT * REPLACE (CASE WHEN {_K} % 10 = 3 AND ProductionMonth = DATE '1996-01-01' THEN -1
  WHEN {_K} % 10 = 4 AND ProductionMonth = DATE '1996-02-01' THEN 0 ELSE Hours END AS Hours) FROM line""",
    "flagged": f"""SELECT *, day(last_day(ProductionMonth)) * 24.0e0 AS HIM,
  (OilProduction > 0 OR GasProduction > 0 OR CondensateProduction > 0) AS produced FROM (
  SELECT WellID, ProductionMonth, min(Pool) AS Pool, min(Area) AS Area, {_exact(MEASURES)}, count(*) AS LineCount
  FROM injected GROUP BY WellID, ProductionMonth)""",
    "silver": """SELECT * REPLACE (
  CASE WHEN OilProduction < 0 THEN 0 ELSE OilProduction END AS OilProduction,
  CASE WHEN GasProduction < 0 THEN 0 ELSE GasProduction END AS GasProduction,
  CASE WHEN CondensateProduction < 0 THEN 0 ELSE CondensateProduction END AS CondensateProduction)
  FROM flagged WHERE NOT (Hours < 0 OR (Hours = 0 AND produced) OR Hours > HIM + 24)""",
    "months": """SELECT WellID, CAST(unnest(generate_series(lo, hi, INTERVAL 1 MONTH)) AS DATE) AS ProductionMonth
  FROM (SELECT WellID, min(ProductionMonth) AS lo, max(ProductionMonth) AS hi FROM silver GROUP BY WellID)""",
    "filled": "SELECT m.WellID, m.ProductionMonth, s.Pool, s.Area, "
              + ", ".join(f"coalesce(s.{c}, 0) AS {c}" for c in MEASURES)
              + """, s.WellID IS NULL AS Backfilled FROM months m LEFT JOIN silver s
  ON m.WellID = s.WellID AND m.ProductionMonth = s.ProductionMonth""",
    "calendar": "SELECT *, " + ", ".join(
        f"CAST(sum(CAST({c} AS DECIMAL(18,4))) OVER w AS DOUBLE) AS {c}Cumulative" for c in MAIN + ["Hours"])
        + """, CAST(date_diff('day', min(ProductionMonth) OVER (PARTITION BY WellID), ProductionMonth) AS INTEGER)
  AS DaysFromFirst FROM filled
  WINDOW w AS (PARTITION BY WellID ORDER BY ProductionMonth ROWS UNBOUNDED PRECEDING)""",
    "reported": f"""SELECT * REPLACE (
  HoursCumulative - CASE WHEN {_K} % 7 = 2 AND ProductionMonth = DATE '1997-03-01' THEN 5000 ELSE 0 END AS HoursCumulative,
  GasProductionCumulative - CASE WHEN {_K} % 7 = 3 AND ProductionMonth = DATE '1998-05-01' THEN 9000000 ELSE 0 END
  AS GasProductionCumulative) FROM calendar""",
    "lagged": "SELECT *, " + ", ".join(
        f"lag({c}Cumulative) OVER (PARTITION BY WellID ORDER BY ProductionMonth) AS prev{c}"
        for c in MAIN[:3] + ["Hours"]) + " FROM reported",
    "bracketed": "SELECT WellID, Pool, Area, ProductionMonth, HoursCumulative AS h, "
                 + ", ".join(f"{m}Cumulative AS c{m}, lag({m}Cumulative) OVER w AS p{m}" for m in MAIN)
                 + """, lag(HoursCumulative) OVER w AS ph, lag(ProductionMonth) OVER w AS pmonth,
  min(ProductionMonth) OVER (PARTITION BY WellID) AS first_month,
  first_value(Pool) OVER w AS first_pool, first_value(Area) OVER w AS first_area,
  max(CASE WHEN HoursCumulative > 730 AND (GasProductionCumulative > 0 OR OilProductionCumulative > 0
      OR CondensateProductionCumulative > 0) THEN 1 END) OVER (PARTITION BY WellID) AS qualifies
  FROM calendar WINDOW w AS (PARTITION BY WellID ORDER BY ProductionMonth)""",
    "boundaries": """SELECT *, k * 730.0e0 AS target, CASE WHEN h <> k * 730 AND ph IS NOT NULL
  THEN (k * 730.0e0 - ph) / (h - ph) END AS r FROM (
  SELECT *, unnest(generate_series(CAST(coalesce(floor(ph / 730), 0) AS INTEGER) + 1, CAST(floor(h / 730) AS INTEGER))) AS k
  FROM bracketed WHERE qualifies = 1 AND floor(h / 730) >= coalesce(floor(ph / 730), 0) + 1)""",
    "ends": "SELECT WellID, first_pool AS Pool, first_area AS Area, k, target, first_month, "
            "CASE WHEN r IS NULL THEN ProductionMonth ELSE pmonth + CAST(floor(r * date_diff('day', pmonth, ProductionMonth)) AS INTEGER) END AS PeriodEndDate, "
            + ", ".join(f"CASE WHEN r IS NULL THEN c{m} ELSE p{m} + r * (c{m} - p{m}) END AS {m}Cumulative" for m in MAIN)
            + " FROM boundaries",
    "normalized": "SELECT *, " + ", ".join(
        f"{m}Cumulative - coalesce(lag({m}Cumulative) OVER (PARTITION BY WellID ORDER BY k), 0) AS {m}" for m in MAIN)
        + """, CASE WHEN k = 1 THEN first_month ELSE PeriodEndDate - 30 END AS PeriodStartDate,
  CAST(floor((target - 730) / 24) AS INTEGER) + 30 AS DaysFromFirstProducing FROM ends""",
    "measured": """SELECT *, ethane_gas_equiv + propane_gas_equiv + butane_gas_equiv + pentane_gas_equiv + lite_gas_equiv
  AS total_gas_equiv, c5_liquids + oil_liquids + condensate_liquids + lite_liquids AS total_liquids FROM (
  SELECT *, coalesce(EthaneMixVolume, 0) * 384 AS ethane_gas_equiv, coalesce(PropaneMixVolume, 0) * 235 AS propane_gas_equiv,
  coalesce(ButaneMixVolume, 0) * 156 AS butane_gas_equiv, coalesce(PentaneMixVolume, 0) * 130 AS pentane_gas_equiv,
  coalesce(LiteMixVolume, 0) * 200 AS lite_gas_equiv,
  coalesce(PentaneMixVolume, 0) + coalesce(PentaneSpecVolume, 0) AS c5_liquids,
  coalesce(OilProduction, 0) AS oil_liquids, coalesce(CondensateProduction, 0) AS condensate_liquids,
  coalesce(LiteMixVolume, 0) AS lite_liquids FROM well_month)""",
    "dirty": """SELECT l_orderkey, l_linenumber, l_partkey, CASE l_linenumber
  WHEN 1 THEN concat(substr(v, 1, 2), ',', substr(v, 3)) WHEN 2 THEN '***' WHEN 3 THEN concat('(', v, ')')
  WHEN 4 THEN concat(' $', v, ' ') WHEN 5 THEN concat(v, '-1') WHEN 6 THEN '' ELSE v END AS GasProduction,
  concat(' ', l_returnflag, '  ') AS Pool, concat('#', CAST(l_partkey AS VARCHAR), '.') AS Sequence,
  CASE l_linenumber WHEN 1 THEN concat(d, '-01') WHEN 2 THEN '' WHEN 3 THEN 'n/a' WHEN 4 THEN NULL ELSE d END
  AS ProductionMonth FROM (SELECT *, CAST(l_extendedprice AS VARCHAR) AS v,
  substr(CAST(l_shipdate AS VARCHAR), 1, 7) AS d FROM lineitem)""",
    "trended": f"""SELECT * REPLACE (
  CASE WHEN stopped THEN 0 ELSE GasProduction / 1000 * CASE k % 3 WHEN 0 THEN e WHEN 1 THEN h ELSE y END END AS GasProduction,
  CASE WHEN stopped THEN 0 ELSE OilProduction * CASE (k + 1) % 3 WHEN 0 THEN e WHEN 1 THEN h ELSE y END END AS OilProduction,
  CASE WHEN stopped THEN 0 ELSE CondensateProduction END AS CondensateProduction) FROM (
  SELECT *, k % 10 = 9 AND t > 180 AS stopped, exp(-di * t / 365.25e0) AS e, 1 / (1 + di * t / 365.25e0) AS h,
    power(1 + 0.5e0 * di * t / 365.25e0, -2) AS y FROM (
  SELECT *, {_K} AS k, 0.1e0 * ({_K} % 6) AS di, CAST(date_diff('day', DATE '1995-01-01', ProductionMonth) AS INTEGER) AS t
  FROM well_month))""",
    "points": _points("trended", PRODUCTION, "t"),
    "normalized_points": _points("normalized", PRODUCTION, "DaysFromFirstProducing", "PeriodStartDate",
                                 "{m} / (730 / 24.0e0)"),
    "placed": f"""SELECT *, least(6, n // 4) AS width FROM (SELECT *, row_number() OVER ({_SERIES}) - 1 AS idx,
  count(*) OVER (PARTITION BY WellID, ProductionType) AS n FROM points WHERE q > 0)""",
    "heights": f"SELECT *, {_rolling()} AS height FROM placed",
    "peaks": """SELECT WellID, ProductionType, idx AS peak_idx FROM (SELECT *, row_number() OVER (
  PARTITION BY WellID, ProductionType ORDER BY height DESC NULLS LAST, idx) AS rank FROM heights) WHERE rank = 1""",
    "segment": """SELECT *, n >= 8 AND idx >= start_idx AS in_segment, n - start_idx AS seg_len FROM (
  SELECT *, CASE WHEN peak_idx < n - greatest(6, n // 3) THEN peak_idx
  ELSE least(peak_idx // 2, n - greatest(6, n // 3)) END AS start_idx FROM placed JOIN peaks USING (WellID, ProductionType))""",
    "bounds": """SELECT WellID, ProductionType, any_value(seg_len) AS seg_len,
  max(CASE WHEN idx = n - 1 THEN q END) / max(CASE WHEN idx = start_idx THEN q END) AS overall_ratio,
  avg(CASE WHEN idx - start_idx >= seg_len - seg_len // 3 THEN q END)
    / avg(CASE WHEN idx - start_idx < seg_len // 3 THEN q END) AS trend_ratio,
  quantile_cont(q, 0.25) - 2.5e0 * (quantile_cont(q, 0.75) - quantile_cont(q, 0.25)) AS low_bound,
  quantile_cont(q, 0.75) + 2.5e0 * (quantile_cont(q, 0.75) - quantile_cont(q, 0.25)) AS high_bound
  FROM segment WHERE in_segment GROUP BY WellID, ProductionType""",
    "masked": """SELECT *, inside OR kept < seg_len * 0.8e0 AS keep FROM (
  SELECT *, count(CASE WHEN inside THEN 1 END) OVER (PARTITION BY WellID, ProductionType) AS kept FROM (
  SELECT s.*, b.low_bound, b.high_bound, q BETWEEN low_bound AND high_bound AS inside
  FROM segment s JOIN bounds b USING (WellID, ProductionType) WHERE in_segment))""",
    "lines": """SELECT WellID, ProductionType, count(*) AS n_used, CAST(min(t) AS DOUBLE) AS t_offset,
  arg_min(q, t) AS q_first, regr_slope(ln(q), t / 365.25e0) AS slope,
  regr_intercept(ln(q), t / 365.25e0) + regr_slope(ln(q), t / 365.25e0) * min(t) / 365.25e0 AS intercept,
  sum(q * q) AS sum_q2, avg(q) AS mean_q FROM masked WHERE keep GROUP BY WellID, ProductionType""",
    "series": """SELECT p.*, h.n_points, h.hist_min, h.hist_max, h.hist_avg, h.hist_peak, h.hist_last,
  b.seg_len, b.overall_ratio, b.trend_ratio, b.low_bound, b.high_bound, l.n_used, l.t_offset, l.q_first,
  l.slope, l.intercept, l.sum_q2, l.mean_q, greatest(exp(l.intercept), l.q_first) AS qi_estimate,
  CASE WHEN coalesce(h.n_points, 0) < 8 THEN 'Insufficient data points'
       WHEN least(b.overall_ratio, b.trend_ratio) > 0.7 THEN 'No significant decline pattern observed' END AS rejected
  FROM (SELECT WellID, ProductionType, max(t) AS last_day, min(ProductionMonth) AS first_month FROM points GROUP BY ALL) p
  LEFT JOIN (SELECT WellID, ProductionType, count(*) AS n_points, min(ProductionMonth) AS hist_min,
    max(ProductionMonth) AS hist_max, avg(q) AS hist_avg, max(q) AS hist_peak, arg_max(q, ProductionMonth) AS hist_last
    FROM points WHERE q > 0 GROUP BY ALL) h USING (WellID, ProductionType)
  LEFT JOIN bounds b USING (WellID, ProductionType) LEFT JOIN lines l USING (WellID, ProductionType)""",
    "fit_points": """SELECT m.WellID, m.ProductionType, (m.t - s.t_offset) / 365.25e0 AS y, m.q
  FROM masked m JOIN series s USING (WellID, ProductionType) WHERE m.keep AND s.rejected IS NULL""",
    "job": """SELECT * FROM (VALUES
  ('exponential', 1, 0.001e0, 3e0, 0.1e0, 5e0, 0e0), ('exponential', 2, 0.0001e0, 5e0, 0.01e0, 20e0, 0e0),
  ('exponential', 3, 0.00001e0, 10e0, 0e0, 100e0, 0.001e0), ('harmonic', 1, 0.001e0, 3e0, 0.1e0, 5e0, 0e0),
  ('harmonic', 2, 0.0001e0, 5e0, 0.01e0, 20e0, 0e0), ('harmonic', 3, 0.00001e0, 10e0, 0e0, 100e0, 0.001e0),
  ('hyperbolic', 1, 0.001e0, 3e0, 0.1e0, 5e0, 0e0), ('hyperbolic', 2, 0.0001e0, 5e0, 0.01e0, 20e0, 0e0))
  v(curve, box, dlo, dhi, qlo, qhi, qfloor)""",
    "grid": """SELECT curve, box, (ln(dhi) - ln(dlo)) / 19 AS hu, ln(dlo) + i * ((ln(dhi) - ln(dlo)) / 19) AS u,
  CASE curve WHEN 'hyperbolic' THEN 0.001e0 + j * ((0.999e0 - 0.001e0) / 6) ELSE 0.5e0 END AS b
  FROM job, generate_series(0, 19) gi(i), generate_series(0, 6) gj(j) WHERE curve = 'hyperbolic' OR j = 0""",
    "offsets": "SELECT i, j FROM generate_series(-2, 2) a(i), generate_series(-2, 2) c(j)",
    "limits": """SELECT WellID, ProductionType, curve, box, sum_q2, (SELECT max(y) / 2 FROM fit_points p
    WHERE p.WellID = series.WellID AND p.ProductionType = series.ProductionType) AS ym, greatest(qlo * qi_estimate, qfloor) AS qi_low,
  qhi * qi_estimate AS qi_high, dlo, dhi, ln(dlo) AS ulo, ln(dhi) AS uhi FROM series, job WHERE rejected IS NULL""",
}


def _best(candidates: str, track: str, level: str, u_step: str, b_step: str) -> str:
    """Best of the `candidates` per (series, curve, box) and, while lines are searched, exponent."""
    return f"""SELECT {level} AS lvl, WellID, ProductionType, curve, box, best.u AS u, best.b AS b, error,
    {u_step} AS hu, {b_step} AS hb FROM (
    SELECT WellID, ProductionType, curve, box, any_value(lvl) AS lvl, any_value(hu) AS hu, any_value(hb) AS hb,
      arg_min({{'u': u, 'b': b}}, sse) AS best, min(sse) AS error FROM (
      SELECT *, sum_q2 - 2 * qi * qf + qi * qi * ff AS sse FROM (
        SELECT *, greatest(qi_low, least(qi_high, qf / greatest(ff, 1e-300))) AS qi FROM (
          SELECT WellID, ProductionType, curve, box, u, b, lvl, hu, hb, sum(q * f) AS qf, sum(f * f) AS ff FROM (
            SELECT c.*, p.q, {_SHAPE} AS f FROM ({candidates}) c JOIN fit_points p USING (WellID, ProductionType))
          GROUP BY ALL) JOIN limits USING (WellID, ProductionType, curve, box)))
    GROUP BY WellID, ProductionType, curve, box{track})"""


_NEXT_B = "greatest(0.001e0, least(0.999e0, z.b + o.j * (z.hb / 2)))"
_LIMITED = ("JOIN limits l ON l.WellID = z.WellID AND l.ProductionType = z.ProductionType AND l.curve = z.curve "
            "AND l.box = z.box")
CTES |= {
    "line_search": _best("""SELECT WellID, ProductionType, curve, box, u, b, 0 AS lvl, hu, 0e0 AS hb
        FROM limits JOIN grid USING (curve, box)""", ", b", "0", "hu", "hb") + " UNION ALL " + _best(
        f"""SELECT DISTINCT z.WellID, z.ProductionType, z.curve, z.box, z.lvl, z.hu, z.hb, z.b,
        greatest(l.ulo, least(l.uhi, z.u + o.i * (z.hu / 4))) AS u
        FROM line_search z CROSS JOIN generate_series(-4, 4) o(i) {_LIMITED}
        WHERE z.lvl < CASE z.curve WHEN 'hyperbolic' THEN 2 ELSE 6 END""", ", b", "lvl + 1", "hu / 4", "hb"),
    "plane_search": """SELECT 0 AS lvl, WellID, ProductionType, curve, box, best.u AS u, best.b AS b, error,
        (uhi - ulo) / 19 / 4 AS hu, (0.999e0 - 0.001e0) / 6 AS hb FROM (
        SELECT WellID, ProductionType, curve, box, arg_min({'u': u, 'b': b}, error) AS best, min(error) AS error
        FROM line_search WHERE curve = 'hyperbolic' AND lvl = 2 GROUP BY ALL)
        JOIN limits USING (WellID, ProductionType, curve, box) UNION ALL """ + _best(
        f"""SELECT DISTINCT z.WellID, z.ProductionType, z.curve, z.box, z.lvl, z.hu, z.hb, {_NEXT_B} AS b,
        greatest(l.ulo, least(l.uhi, ln((exp({_NEXT_B} * ln(1 + z.b * exp(z.u) * l.ym) / z.b * exp(o.i * (z.hu / 2))) - 1)
          / ({_NEXT_B} * l.ym)))) AS u
        FROM plane_search z CROSS JOIN offsets o {_LIMITED} WHERE z.lvl < 14""", "", "lvl + 1", "hu / 2", "hb / 2"),
    "searched": """SELECT WellID, ProductionType, curve, box, u, b FROM line_search WHERE curve <> 'hyperbolic' AND lvl = 6
  UNION ALL SELECT WellID, ProductionType, curve, box, u, b FROM plane_search WHERE lvl = 14""",
}
CTES |= {
    "polish": f"""SELECT * , CASE WHEN low - 2 * mid + high > 0 AND u - 1e-4 >= ulo AND u + 1e-4 <= uhi
    AND abs(0.5e-4 * (low - high) / (low - 2 * mid + high)) <= 1e-4 THEN u + 0.5e-4 * (low - high) / (low - 2 * mid + high)
    ELSE u END AS u_best FROM (
  SELECT WellID, ProductionType, curve, box, center AS u, b, any_value(ulo) AS ulo, any_value(uhi) AS uhi,
    max(CASE WHEN k = -1 THEN sse END) AS low, max(CASE WHEN k = 0 THEN sse END) AS mid, max(CASE WHEN k = 1 THEN sse END) AS high FROM (
    SELECT *, sum_q2 - 2 * qi * qf + qi * qi * ff AS sse FROM (
      SELECT *, greatest(qi_low, least(qi_high, qf / greatest(ff, 1e-300))) AS qi FROM (
        SELECT WellID, ProductionType, curve, box, center, b, k, sum(q * f) AS qf, sum(f * f) AS ff FROM (
          SELECT c.*, p.q, {_SHAPE} AS f FROM (SELECT WellID, ProductionType, curve, box, u AS center, u + k * 1e-4 AS u, b, k
            FROM searched, (VALUES (-1), (0), (1)) v(k)) c
          JOIN fit_points p USING (WellID, ProductionType)) GROUP BY ALL)
      JOIN limits USING (WellID, ProductionType, curve, box)))
  GROUP BY WellID, ProductionType, curve, box, center, b)""",
    "solved": f"""SELECT WellID, ProductionType, curve, box, greatest(qi_low, least(qi_high, qf / greatest(ff, 1e-300))) AS qi,
    exp(u) AS di, CASE curve WHEN 'hyperbolic' THEN b ELSE 0 END AS b, u FROM (
    SELECT WellID, ProductionType, curve, box, u, b, sum(q * f) AS qf, sum(f * f) AS ff FROM (
      SELECT c.*, p.q, {_SHAPE} AS f FROM (SELECT WellID, ProductionType, curve, box, u_best AS u, b FROM polish) c
      JOIN fit_points p USING (WellID, ProductionType)) GROUP BY ALL)
    JOIN limits USING (WellID, ProductionType, curve, box)
  UNION ALL SELECT WellID, ProductionType, 'exponential', 0, exp(intercept), -slope, 0, ln(-slope) FROM series
  WHERE rejected IS NULL AND slope < 0""",
    "judged": f"""SELECT WellID, ProductionType, curve, box, qi, di, b, CASE WHEN total > 0 THEN 1 - ss / total ELSE 0 END AS r2,
  n_used * ln(greatest(ss / n_used, 1e-12 * sum_q2 / n_used)) + CASE curve WHEN 'hyperbolic' THEN 6 ELSE 4 END AS aic FROM (
  SELECT WellID, ProductionType, curve, box, any_value(qi) AS qi, any_value(di) AS di, any_value(b) AS b,
    sum((q - qi * f) * (q - qi * f)) AS ss, sum((q - mean_q) * (q - mean_q)) AS total,
    any_value(n_used) AS n_used, any_value(sum_q2) AS sum_q2
  FROM (SELECT c.*, p.q, {_SHAPE} AS f FROM solved c JOIN fit_points p USING (WellID, ProductionType))
  JOIN series USING (WellID, ProductionType) GROUP BY WellID, ProductionType, curve, box)""",
    "wide": """SELECT WellID, ProductionType, curve, CASE curve WHEN 'harmonic' THEN 0.7 ELSE 0.8 END AS good,
  bool_or(box = 1 AND clear) AS in_1, bool_or(box = 2 AND clear) AS in_2,
  coalesce(max(CASE WHEN box = 0 THEN r2 END), -1e300) AS r_0, max(CASE WHEN box = 1 THEN r2 END) AS r_1,
  max(CASE WHEN box = 2 THEN r2 END) AS r_2, coalesce(max(CASE WHEN box = 3 THEN r2 END), -1e300) AS r_3
  FROM (SELECT j.*, coalesce(qi > qi_low * 1.001e0 AND qi < qi_high * 0.999e0 AND di > dlo * 1.001e0 AND di < dhi * 0.999e0, false) AS clear
    FROM judged j LEFT JOIN limits USING (WellID, ProductionType, curve, box)) GROUP BY WellID, ProductionType, curve""",
    "boxed": """SELECT WellID, ProductionType, curve,
  CASE WHEN NOT stop2 AND r_3 > best2 + 1e-9 THEN 3 WHEN gain2 THEN 2 WHEN gain1 THEN 1 ELSE 0 END AS box FROM (
  SELECT *, stop1 OR in_2 OR (gain2 AND r_2 > good) AS stop2, CASE WHEN gain2 THEN r_2 ELSE best1 END AS best2 FROM (
  SELECT *, NOT stop1 AND r_2 > best1 + 1e-9 AS gain2 FROM (
  SELECT *, in_1 OR (gain1 AND r_1 > good) AS stop1, CASE WHEN gain1 THEN r_1 ELSE r_0 END AS best1 FROM (
  SELECT *, r_1 > r_0 + 1e-9 AS gain1 FROM wide))))""",
    "curves": "SELECT * FROM judged JOIN boxed USING (WellID, ProductionType, curve, box)",
    # Standard errors: the cofactors of the normal matrix of the curve's derivatives over its determinant.
    "fit_errors": f"""SELECT WellID, ProductionType, curve,
  sqrt(var * CASE WHEN curve = 'hyperbolic' THEN (bb * cc - bc * bc) / det ELSE bb / det END) AS qi_error,
  sqrt(var * CASE WHEN curve = 'hyperbolic' THEN (aa * cc - ac * ac) / det ELSE aa / det END) AS di_error,
  CASE WHEN curve = 'hyperbolic' THEN sqrt(var * (aa * bb - ab * ab) / det) END AS b_error FROM (
  SELECT *, CASE WHEN curve = 'hyperbolic'
    THEN aa * (bb * cc - bc * bc) - ab * (ab * cc - bc * ac) + ac * (ab * bc - bb * ac) ELSE aa * bb - ab * ab END AS det,
    CASE WHEN box > 0 THEN ss / (n - CASE WHEN curve = 'hyperbolic' THEN 3 ELSE 2 END) END AS var FROM (
  SELECT WellID, ProductionType, curve, box, count(*) AS n, sum((q - qi * f) * (q - qi * f)) AS ss,
    sum(a * a) AS aa, sum(a * d) AS ab, sum(a * c) AS ac, sum(d * d) AS bb, sum(d * c) AS bc, sum(c * c) AS cc FROM (
  SELECT *, f AS a, -qi * y * f / CASE curve WHEN 'exponential' THEN 1 WHEN 'harmonic' THEN 1 + di * y ELSE 1 + b * di * y END AS d,
    CASE WHEN curve = 'hyperbolic' THEN qi * f * (ln(1 + b * di * y) / b - di * y / (1 + b * di * y)) / b ELSE 0 END AS c FROM (
  SELECT c.*, p.y, p.q, {_SHAPE} AS f FROM (SELECT *, ln(di) AS u FROM (SELECT WellID, ProductionType, curve, box, qi, di, b FROM curves
    WHERE di > 0)) c JOIN fit_points p USING (WellID, ProductionType))) GROUP BY ALL))""",
    "auto_choice": """SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY WellID, ProductionType ORDER BY
    CASE WHEN curve = 'exponential' AND box = 0 AND r2 >= 0.4 THEN 0 ELSE 1 END, aic,
    CASE curve WHEN 'exponential' THEN 0 WHEN 'hyperbolic' THEN 1 ELSE 2 END) AS rank FROM curves WHERE r2 > 0) WHERE rank = 1""",
    "fits": """SELECT s.*, c.curve AS CurveType, c.qi, c.di, c.b, c.r2 AS RSquared, c.aic AS AIC,
  coalesce(s.rejected, CASE WHEN c.curve IS NULL THEN 'All curve fits failed' END,
    CASE WHEN c.r2 < 0.3 THEN printf('Best fit R² (%.3f) below threshold (0.3)', c.r2) END, 'ok') AS Status
  FROM series s LEFT JOIN auto_choice c USING (WellID, ProductionType)""",
    "ahead": f"""SELECT *, {_RATE} AS Rate, first_month + day AS ForecastDate,
  CAST(date_trunc('month', first_month + day) AS DATE) AS ProductionMonth FROM (
  SELECT *, {_DAY.format(i='i')} AS day FROM fits, generate_series(0, 23) g(i) WHERE Status = 'ok')""",
    "summary": """SELECT WellID, ProductionType, CurveType, any_value(RSquared) AS RSquared, any_value(qi) AS InitialRate_qi,
  any_value(di) AS DeclineRate_di, any_value(b) AS DeclineExponent_b, any_value(hist_min) AS HistoricalDataMinDate,
  any_value(hist_max) AS HistoricalDataMaxDate, CAST(any_value(n_points) AS INTEGER) AS DataPointsUsed,
  any_value(hist_avg) AS HistoricalAvgProduction, any_value(hist_peak) AS HistoricalPeakProduction,
  any_value(hist_last) AS HistoricalLastProduction, min(ForecastDate) AS ForecastStartDate,
  sum(CASE WHEN i < 12 THEN Rate END) AS ForecastCumulative12Month, any_value(AIC) AS AIC FROM ahead
  GROUP BY WellID, ProductionType, CurveType""",
    "first_rows": """SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY WellID ORDER BY ProductionMonth) AS rank
  FROM trended) WHERE rank = 1""",
    "forecasts": """SELECT a.ProductionType, a.i + 1 AS Step, a.ForecastDate, a.WellID, a.ProductionMonth, a.day AS DaysFromFirst,
  CASE WHEN ProductionType = 'OilProduction' THEN Rate ELSE 0 END AS OilProduction,
  CASE WHEN ProductionType = 'GasProduction' THEN Rate ELSE 0 END AS GasProduction,
  CASE WHEN ProductionType = 'CondensateProduction' THEN Rate ELSE 0 END AS CondensateProduction,
  f.ReportingFacilityID, f.ReportingFacilityName, f.OperatorBAID, f.OperatorName, f.WellLicenseNumber, f.Field,
  f.Pool, f.Area, 720.0e0 AS Hours, 'ARPS_' || CurveType AS ForecastMethod, RSquared AS ForecastRSquared
  FROM ahead a JOIN first_rows f USING (WellID)""",
}

_NAME = re.compile(r"\b(?:FROM|JOIN|,)\s+([a-z_]+)\b")


def _needs(text: str, clauses: dict[str, str]) -> set[str]:
    return {n for n in _NAME.findall(text) if n in clauses}


def sql(body: str, **override: str) -> str:
    """`body` preceded by every WITH clause it depends on; overrides replace a clause by name."""
    body, clauses = _write_rnd(body), {**CTES, **{k: _write_rnd(v) for k, v in override.items()}}
    wanted, todo = set(), list(_needs(body, clauses))
    while todo:
        name = todo.pop()
        if name not in wanted:
            wanted.add(name)
            todo += [n for n in _needs(clauses[name], clauses) if n != name]
    if not wanted:
        return body
    ordered, placed = [], set()

    def place(name: str) -> None:
        if name in placed:
            return
        placed.add(name)
        for n in _needs(clauses[name], clauses):
            if n != name:
                place(n)
        ordered.append(name)

    for name in [*CTES, *override]:
        if name in wanted:
            place(name)
    # Recursive clauses cannot be marked materialized.
    parts = [f"{n} AS {'' if n in ('line_search', 'plane_search') else 'MATERIALIZED '}({clauses[n]})" for n in ordered]
    return "WITH RECURSIVE " + ",\n".join(parts) + "\n" + body
