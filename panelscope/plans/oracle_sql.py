"""DuckDB SQL oracles for the registered queries.

Each string is self-contained ANSI-ish SQL over the pre-registered table views.
Every computed double is rounded to 6 digits on both sides (summation order of
sliding means may differ in the last bit); ranks carry unique tie-breakers.
"""

from __future__ import annotations

# Fixed values shared with the Spark side (kept literal here on purpose).
_NUM = r"^[+-]?([0-9]+\.?[0-9]*|\.[0-9]+)([eE][+-]?[0-9]+)?$"


def strip(x: str) -> str:
    return f"regexp_replace(CAST({x} AS VARCHAR), '^\\s+|\\s+$', '', 'g')"


def digits(x: str) -> str:
    return f"regexp_replace(CAST({x} AS VARCHAR), '[^0-9]', '', 'g')"


def pad_if_fits(d: str) -> str:
    return f"(CASE WHEN length({d}) BETWEEN 1 AND 5 THEN lpad({d}, 5, '0') END)"


def norm_key(x: str) -> str:
    return pad_if_fits(digits(x))


def norm_key_numeric(x: str) -> str:
    t = strip(x)
    ip = f"regexp_replace(regexp_extract({t}, '^([0-9]*)\\.', 1), '^0+', '')"
    num = f"(CASE WHEN {ip} = '' THEN '0' ELSE {ip} END)"
    v = f"(CASE WHEN regexp_full_match({t}, '([0-9]+\\.[0-9]*|\\.[0-9]+)') THEN {num} ELSE {t} END)"
    return norm_key(v)


def norm_key_request(x: str) -> str:
    d = digits(strip(x))
    d2 = f"(CASE WHEN length({d}) = 6 AND starts_with({d}, '0') THEN substr({d}, 2, 5) ELSE {d} END)"
    return pad_if_fits(d2)


def repad_key(x: str) -> str:
    t = strip(x)
    return (
        f"(CASE WHEN {t} IS NULL THEN NULL "
        f"WHEN regexp_matches({t}, '^[+-]') THEN substr({t}, 1, 1) || "
        f"(CASE WHEN length(substr({t}, 2)) < 4 THEN lpad(substr({t}, 2), 4, '0') ELSE substr({t}, 2) END) "
        f"WHEN length({t}) < 5 THEN lpad({t}, 5, '0') ELSE {t} END)"
    )


def coerce_double(x: str) -> str:
    t = strip(x)
    v = f"(CASE WHEN regexp_full_match({t}, '{_NUM}') THEN TRY_CAST({t} AS DOUBLE) END)"
    return f"(CASE WHEN NOT isnan({v}) AND abs({v}) <> 'inf'::DOUBLE THEN {v} END)"


def coerce_int(x: str) -> str:
    v = coerce_double(x)
    return f"(CASE WHEN abs({v}) < 2147483648.0 THEN CAST(trunc({v}) AS INTEGER) END)"


def month_floor(x: str) -> str:
    t = f"regexp_replace({strip(x)}, '(\\d{{2}}:\\d{{2}}:\\d{{2}})\\.\\d+$', '\\1')"
    fmts = ["%Y-%m-%d %H:%M:%S", "%Y-%m-%d", "%Y-%m", "%Y/%m/%d", "%m/%d/%Y"]
    parsed = "coalesce(" + ", ".join(f"try_strptime({t}, '{f}')" for f in fmts) + ")"
    return f"CAST(date_trunc('month', {parsed}) AS DATE)"


def r6(x: str) -> str:
    return f"(CAST(floor(CAST({x} AS DOUBLE) * CAST(1000000 AS DOUBLE) + CAST(0.5 AS DOUBLE)) AS DOUBLE) / CAST(1000000 AS DOUBLE))"


def rolling_mean(col: str, k: int, w: str = "w") -> str:
    """Mean of the last k rows, summed oldest first (the order of Spark's sliding frame)."""
    terms = [f"lag({col}, {i}) OVER {w}" for i in range(k - 1, 0, -1)] + [col]
    total = terms[0]
    for t in terms[1:]:
        total = f"({total} + {t})"
    return f"(CASE WHEN lag({col}, {k - 1}) OVER {w} IS NOT NULL THEN {total} / {k} END)"


# ---------------------------------------------------------------- inputs ----

B1 = """SELECT (CASE WHEN length(CAST(user_id AS VARCHAR)) < 5 THEN lpad(CAST(user_id AS VARCHAR), 5, '0') ELSE CAST(user_id AS VARCHAR) END) AS entity,
       CAST(date_diff('day', DATE '2024-01-01', CAST(ts AS DATE)) AS INTEGER) AS period,
       CAST(count(*) AS DOUBLE) AS exposure_count,
       CAST(sum(CAST(value AS DECIMAL(18,2))) AS DOUBLE) / count(*) AS rate
FROM events GROUP BY 1, 2"""

B2 = """SELECT (CASE WHEN length(CAST(o_custkey AS VARCHAR)) < 5 THEN lpad(CAST(o_custkey AS VARCHAR), 5, '0') ELSE CAST(o_custkey AS VARCHAR) END) AS entity,
       CAST(year(o_orderdate) AS INTEGER) AS period,
       CAST(count(*) AS DOUBLE) AS exposure_count,
       CAST(sum(CAST(o_totalprice AS DECIMAL(18,2))) AS DOUBLE) / count(*) AS rate
FROM orders GROUP BY 1, 2"""

B3 = """SELECT (CASE WHEN length(CAST(l_suppkey AS VARCHAR)) < 5 THEN lpad(CAST(l_suppkey AS VARCHAR), 5, '0') ELSE CAST(l_suppkey AS VARCHAR) END) AS entity,
       CAST(date_trunc('month', l_shipdate) AS DATE) AS month,
       CAST(sum(CAST(l_extendedprice AS DECIMAL(18,2))) AS DOUBLE) / count(*) / 1000 AS rate
FROM lineitem GROUP BY 1, 2"""


def weighted(panel_cte: str = "b1") -> str:
    """CTEs `imp`, `cap`, `panel`: implied exposure and p99-capped sample weight."""
    return f"""imp AS (SELECT *, CASE WHEN exposure_count IS NOT NULL AND exposure_count >= 0 AND rate > 0
                         THEN exposure_count / (rate / 100.0) END AS implied_exposure FROM {panel_cte}),
cap AS (SELECT quantile_cont(implied_exposure, 0.99) AS weight_cap FROM imp WHERE implied_exposure > 0),
panel AS (SELECT imp.*, CASE WHEN implied_exposure > 0 AND weight_cap > 0 THEN least(implied_exposure, weight_cap)
                        ELSE 1.0 END AS sample_weight FROM imp LEFT JOIN cap ON TRUE)"""


RAW_YEARLY = """SELECT event_id AS row_id,
  CASE WHEN event_id % 7 = 0 THEN ' ' || CAST(user_id AS VARCHAR) || ' '
       WHEN event_id % 7 = 1 THEN CAST(user_id AS VARCHAR) || '.0'
       WHEN event_id % 7 = 2 THEN ''
       WHEN event_id % 7 = 3 THEN CAST(user_id AS VARCHAR) || '123456'
       WHEN event_id % 7 = 4 THEN event_type
       ELSE CAST(user_id AS VARCHAR) END AS "CoFIPS",
  CASE WHEN event_id % 11 = 0 THEN event_type
       WHEN event_id % 5 = 0 THEN CAST(dayofmonth(ts) AS VARCHAR) || '.7'
       ELSE CAST(dayofmonth(ts) AS VARCHAR) END AS "Year",
  CASE WHEN event_id % 29 = 0 THEN '' WHEN event_id % 31 = 0 THEN '-5'
       ELSE json_extract_string(props, '$.k') END AS filings,
  CASE WHEN event_id % 13 = 0 THEN 'NaN'
       WHEN event_id % 17 = 0 THEN CAST(CAST(value AS DECIMAL(18,2)) AS VARCHAR) || 'd'
       WHEN event_id % 19 = 0 THEN '-1'
       WHEN event_id % 23 = 0 THEN '0'
       WHEN event_id % 37 = 0 THEN 'inf'
       ELSE CAST(CAST(value AS DECIMAL(18,2)) AS VARCHAR) END AS "Filing_Rate",
  event_type AS extra_note
FROM events"""

RAW_MONTHLY = """SELECT l_orderkey * 8 + l_linenumber AS row_id,
  CASE WHEN (l_orderkey * 8 + l_linenumber) % 5 = 0 THEN CAST(l_suppkey AS VARCHAR) || '.0'
       WHEN (l_orderkey * 8 + l_linenumber) % 5 = 1 THEN '  ' || CAST(l_suppkey AS VARCHAR)
       WHEN (l_orderkey * 8 + l_linenumber) % 5 = 2 THEN '0000' || CAST(l_suppkey AS VARCHAR) || '.'
       ELSE CAST(l_suppkey AS VARCHAR) END AS "County_FIPS",
  CASE WHEN (l_orderkey * 8 + l_linenumber) % 4 = 0 THEN strftime(l_shipdate, '%Y-%m-%d %H:%M:%S')
       WHEN (l_orderkey * 8 + l_linenumber) % 4 = 1 THEN strftime(l_shipdate, '%m/%d/%Y')
       WHEN (l_orderkey * 8 + l_linenumber) % 4 = 2 THEN strftime(l_shipdate, '%Y-%m')
       WHEN (l_orderkey * 8 + l_linenumber) % 97 = 3 THEN l_returnflag
       ELSE strftime(l_shipdate, '%Y-%m-%d') END AS "MONTH",
  CASE WHEN (l_orderkey * 8 + l_linenumber) % 41 = 0 THEN 'n/a'
       ELSE CAST(CAST(l_extendedprice AS DECIMAL(18,2)) AS VARCHAR) END AS "eviction filing rate"
FROM lineitem"""

TYPED_YEARLY = f"""SELECT row_id, {norm_key('"CoFIPS"')} AS entity, {coerce_int('"Year"')} AS period,
  {coerce_double('filings')} AS exposure_count, {coerce_double('"Filing_Rate"')} AS rate FROM raw"""


def features_ctes(panel: str = "panel") -> str:
    """CTEs `thr`, `flags`, `feat`, `lab`: yearly features and next-period labels over `panel`."""
    return f"""thr AS (SELECT period, quantile_cont(rate, 0.75) AS threshold FROM {panel} GROUP BY period),
flags AS (SELECT p.entity, p.period, p.rate, t.threshold, CAST(p.rate >= t.threshold AS INTEGER) AS flag
          FROM {panel} p JOIN thr t ON p.period = t.period),
feat AS (SELECT entity, period, rate AS lag_1,
   {rolling_mean('rate', 3)} AS lag_3_mean_obs,
   {rolling_mean('rate', 5)} AS lag_5_mean_obs,
   CAST(coalesce(period - lag(period) OVER w, 0) AS INTEGER) AS periods_since_last_obs,
   sample_weight
  FROM {panel}
  WINDOW w AS (PARTITION BY entity ORDER BY period)),
lab AS (SELECT f.*, CAST(f.period + 1 AS INTEGER) AS outcome_period, l.flag AS y
        FROM feat f LEFT JOIN flags l ON l.entity = f.entity AND l.period = f.period + 1)"""


FEATURE_OUT = f"""entity, period, outcome_period, y, {r6('lag_1')} AS lag_1,
  {r6('lag_3_mean_obs')} AS lag_3_mean_obs, {r6('lag_5_mean_obs')} AS lag_5_mean_obs,
  periods_since_last_obs, {r6('sample_weight')} AS sample_weight"""
YEARLY_FEATURES_SELECT = f"""SELECT {FEATURE_OUT}
FROM lab WHERE lag_3_mean_obs IS NOT NULL AND lag_5_mean_obs IS NOT NULL"""
FEATURES_RAW_SELECT = """SELECT entity, period, outcome_period, y, lag_1, lag_3_mean_obs, lag_5_mean_obs,
  periods_since_last_obs, sample_weight FROM lab WHERE lag_3_mean_obs IS NOT NULL AND lag_5_mean_obs IS NOT NULL"""

FEATURES_B1 = f"""b1 AS ({B1}), {weighted()}, {features_ctes()},
features AS ({FEATURES_RAW_SELECT})"""


def monthly_features_ctes(panel: str = "b3") -> str:
    return f"""mthr AS (SELECT month, quantile_cont(rate, 0.75) AS threshold FROM {panel} GROUP BY month),
mflags AS (SELECT p.entity, p.month, CAST(p.rate >= t.threshold AS INTEGER) AS flag
           FROM {panel} p JOIN mthr t ON p.month = t.month),
mfeat AS (SELECT entity, month, rate AS lag_1,
   {rolling_mean('rate', 3)} AS lag_3_mean,
   {rolling_mean('rate', 12)} AS lag_12_mean,
   CAST(month(month) AS INTEGER) AS month_of_year
  FROM {panel}
  WINDOW w AS (PARTITION BY entity ORDER BY month)),
mlab AS (SELECT f.*, l.flag AS y FROM mfeat f
         LEFT JOIN mflags l ON l.entity = f.entity AND l.month = CAST(f.month + INTERVAL 1 MONTH AS DATE))"""


# --------------------------------------------------------------- queries ----

def _raw_yearly(select: str) -> str:
    return f"WITH raw AS ({RAW_YEARLY}) {select}"


def _raw_monthly(select: str) -> str:
    return f"WITH raw AS ({RAW_MONTHLY}) {select}"


ORACLES: dict[str, str] = {}

ORACLES["column_mapping"] = _raw_yearly(
    'SELECT "CoFIPS" AS entity, "Year" AS period, filings AS exposure_count, "Filing_Rate" AS rate FROM raw'
)
ORACLES["normalize_key"] = _raw_yearly(
    f'SELECT row_id, "CoFIPS" AS raw_key, {norm_key(chr(34) + "CoFIPS" + chr(34))} AS entity FROM raw'
)
ORACLES["normalize_key_numeric"] = _raw_monthly(
    f'SELECT row_id, "County_FIPS" AS raw_key, {norm_key_numeric(chr(34) + "County_FIPS" + chr(34))} AS entity FROM raw'
)
ORACLES["normalize_key_request"] = _raw_yearly(
    f'SELECT row_id, "CoFIPS" AS raw_key, {norm_key_request(chr(34) + "CoFIPS" + chr(34))} AS entity FROM raw'
)
ORACLES["repad_key"] = _raw_yearly(
    f'SELECT row_id, "CoFIPS" AS raw_key, {repad_key(chr(34) + "CoFIPS" + chr(34))} AS entity FROM raw'
)
ORACLES["coerce_numeric"] = _raw_yearly(
    f"""SELECT row_id, {coerce_double('"Year"')} AS year_value, {coerce_int('"Year"')} AS year_int,
    {coerce_double('filings')} AS filings_value, {coerce_double('"Filing_Rate"')} AS rate_value FROM raw"""
)
ORACLES["month_floor"] = _raw_monthly(f'SELECT row_id, {month_floor(chr(34) + "MONTH" + chr(34))} AS month FROM raw')
ORACLES["invalid_row_counts"] = f"""WITH raw AS ({RAW_YEARLY}), typed AS ({TYPED_YEARLY})
SELECT count(*) AS input_rows,
  count(*) FILTER (WHERE entity IS NULL) AS null_entity,
  count(*) FILTER (WHERE entity IS NOT NULL AND period IS NULL) AS null_period,
  count(*) FILTER (WHERE entity IS NOT NULL AND period IS NOT NULL AND rate IS NULL) AS null_rate,
  count(*) FILTER (WHERE entity IS NULL OR period IS NULL OR rate IS NULL) AS dropped_rows,
  count(*) FILTER (WHERE entity IS NOT NULL AND period IS NOT NULL AND rate IS NOT NULL) AS kept_rows
FROM typed"""
CLEAN_RAW_CTES = f"""raw AS ({RAW_YEARLY}), typed AS ({TYPED_YEARLY}),
kept AS (SELECT entity, period, exposure_count, rate FROM typed
         WHERE entity IS NOT NULL AND period IS NOT NULL AND rate IS NOT NULL),
{weighted('kept')}"""
ORACLES["clean_panel"] = f"""WITH {CLEAN_RAW_CTES}
SELECT entity, period, {r6('exposure_count')} AS exposure_count, {r6('rate')} AS rate,
  {r6('implied_exposure')} AS implied_exposure, {r6('sample_weight')} AS sample_weight FROM panel"""
ORACLES["clean_panel_monthly"] = _raw_monthly(
    f"""SELECT * FROM (SELECT {norm_key_numeric('"County_FIPS"')} AS entity, {month_floor('"MONTH"')} AS month,
      {r6(coerce_double('"eviction filing rate"'))} AS rate FROM raw)
    WHERE entity IS NOT NULL AND month IS NOT NULL AND rate IS NOT NULL"""
)
ORACLES["implied_exposure"] = f"""WITH b1 AS ({B1})
SELECT entity, period, {r6("CASE WHEN exposure_count >= 0 AND rate > 0 THEN exposure_count / (rate / 100.0) END")}
  AS implied_exposure FROM b1"""
ORACLES["sample_weight"] = f"""WITH b1 AS ({B1}), {weighted()}
SELECT entity, period, {r6('implied_exposure')} AS implied_exposure, {r6('sample_weight')} AS sample_weight FROM panel"""
ORACLES["duplicate_keys"] = f"""WITH raw AS ({RAW_YEARLY}), typed AS ({TYPED_YEARLY})
SELECT entity, period, count(*) AS copies FROM typed WHERE entity IS NOT NULL AND period IS NOT NULL
GROUP BY entity, period HAVING count(*) > 1"""

ORACLES["lag_features"] = f"""WITH b1 AS ({B1}), panel AS (SELECT *, 1.0 AS sample_weight FROM b1), {features_ctes()}
SELECT entity, period, {r6('lag_1')} AS lag_1, {r6('lag_3_mean_obs')} AS lag_3_mean_obs,
  {r6('lag_5_mean_obs')} AS lag_5_mean_obs, periods_since_last_obs FROM feat"""
ORACLES["period_threshold_flag"] = f"""WITH b1 AS ({B1}), panel AS (SELECT *, 1.0 AS sample_weight FROM b1), {features_ctes()}
SELECT entity, period, {r6('rate')} AS rate, {r6('threshold')} AS threshold, flag FROM flags"""
ORACLES["next_period_label"] = f"""WITH b1 AS ({B1}), panel AS (SELECT *, 1.0 AS sample_weight FROM b1), {features_ctes()}
SELECT entity, period, y FROM lab"""
ORACLES["next_period_label_join"] = ORACLES["next_period_label"]
ORACLES["outcome_observed"] = f"""WITH b1 AS ({B1})
SELECT a.entity, a.period, CASE WHEN b.entity IS NULL THEN 0 ELSE 1 END AS has_outcome_observation
FROM b1 a LEFT JOIN b1 b ON a.entity = b.entity AND b.period = a.period + 1"""
ORACLES["yearly_features"] = f"WITH {FEATURES_B1} SELECT {FEATURE_OUT} FROM features"
ORACLES["yearly_features_orders"] = f"""WITH b1 AS ({B2}), {weighted()}, {features_ctes()}
{YEARLY_FEATURES_SELECT}"""
ORACLES["lag_features_monthly"] = f"""WITH b3 AS ({B3}), {monthly_features_ctes()}
SELECT entity, month, {r6('lag_1')} AS lag_1, {r6('lag_3_mean')} AS lag_3_mean, {r6('lag_12_mean')} AS lag_12_mean,
  month_of_year FROM mfeat"""
ORACLES["next_month_label"] = f"""WITH b3 AS ({B3}), {monthly_features_ctes()} SELECT entity, month, y FROM mlab"""
ORACLES["monthly_features"] = f"""WITH b3 AS ({B3}), {monthly_features_ctes()}
SELECT entity, month, y, {r6('lag_1')} AS lag_1, {r6('lag_3_mean')} AS lag_3_mean, {r6('lag_12_mean')} AS lag_12_mean,
  month_of_year FROM mlab WHERE y IS NOT NULL AND lag_3_mean IS NOT NULL AND lag_12_mean IS NOT NULL"""

# --------------------------------------------------------------- training ----

_TRAIN_REQ = ["lag_1", "lag_3_mean_obs", "lag_5_mean_obs", "periods_since_last_obs", "y", "sample_weight",
              "outcome_period"]
_ALL_PRESENT = " AND ".join(f"{c} IS NOT NULL" for c in _TRAIN_REQ)
_LAB_PRESENT = " AND ".join(f"{c} IS NOT NULL" for c in _TRAIN_REQ[:-1])
LABELLED_B1 = f"""{FEATURES_B1}, labelled AS (SELECT * FROM features WHERE {_LAB_PRESENT}),
training AS (SELECT * FROM features WHERE {_ALL_PRESENT})"""

ORACLES["training_set"] = f"WITH {LABELLED_B1} SELECT {FEATURE_OUT} FROM training"
ORACLES["leakage_violations"] = f"""WITH {LABELLED_B1}
SELECT count(*) AS rows_checked, count(*) FILTER (WHERE period >= outcome_period) AS violations FROM training"""
_reason = "'kept'"
for _c in reversed(_TRAIN_REQ):
    _reason = f"CASE WHEN {_c} IS NULL THEN 'missing_{_c}' ELSE {_reason} END"
ORACLES["training_row_audit"] = f"""WITH {FEATURES_B1}
SELECT {repad_key('entity')} AS entity, outcome_period AS target_period, period AS as_of_period,
  CASE WHEN {_ALL_PRESENT} THEN 1 ELSE 0 END AS kept, {_reason} AS drop_reason FROM features"""
_first = "0"
for _i, _c in reversed(list(enumerate(_TRAIN_REQ, start=1))):
    _first = f"CASE WHEN {_c} IS NULL THEN {_i} ELSE {_first} END"
_steps = ["SELECT 1 AS step_index, 'input_feature_rows' AS step_name, n AS rows_remaining, 0 AS rows_dropped, '' AS drop_reason FROM agg"]
_rem = "n"
for _i, _c in enumerate(_TRAIN_REQ, start=1):
    _rem = f"{_rem} - d{_i}"
    _steps.append(f"SELECT {_i + 1}, 'require_non_null_{_c}', {_rem}, d{_i}, 'missing_{_c}' FROM agg")
_k = len(_TRAIN_REQ) + 2
_steps.append(f"SELECT {_k}, 'cast_label_to_int', {_rem}, 0, '' FROM agg")
_steps.append(f"SELECT {_k + 1}, 'dedupe_rows_not_applied', {_rem}, 0, 'no_dedupe_logic_in_training_dataset_builder' FROM agg")
ORACLES["training_filter_counts"] = f"""WITH {FEATURES_B1}, agg AS (SELECT count(*) AS n,
  {", ".join(f"count(*) FILTER (WHERE ({_first}) = {_i}) AS d{_i}" for _i in range(1, len(_TRAIN_REQ) + 1))}
  FROM features)
{" UNION ALL ".join(_steps)}"""
ORACLES["split_by_period"] = f"""WITH {LABELLED_B1},
held AS (SELECT DISTINCT period FROM labelled ORDER BY period DESC LIMIT 2)
SELECT entity, period, outcome_period, y,
  CASE WHEN period IN (SELECT period FROM held) THEN 'test' ELSE 'train' END AS split FROM labelled"""
ORACLES["split_by_outcome"] = f"""WITH {LABELLED_B1},
held AS (SELECT DISTINCT outcome_period FROM labelled ORDER BY outcome_period DESC LIMIT 2)
SELECT entity, period, outcome_period, y,
  CASE WHEN outcome_period IN (SELECT outcome_period FROM held) THEN 'test' ELSE 'train' END AS split FROM labelled"""
ORACLES["split_by_month"] = f"""WITH b3 AS ({B3}), {monthly_features_ctes()},
fm AS (SELECT * FROM mlab WHERE y IS NOT NULL AND lag_3_mean IS NOT NULL AND lag_12_mean IS NOT NULL),
held AS (SELECT DISTINCT month FROM fm ORDER BY month DESC LIMIT 6)
SELECT entity, month, y, CASE WHEN month IN (SELECT month FROM held) THEN 'test' ELSE 'train' END AS split FROM fm"""
ORACLES["fit_calibration_split"] = f"""WITH {LABELLED_B1},
train AS (SELECT * FROM labelled WHERE outcome_period < (SELECT max(outcome_period) FROM labelled))
SELECT entity, period, outcome_period, y,
  CASE WHEN outcome_period = (SELECT max(outcome_period) FROM train) THEN 'calibration' ELSE 'fit' END AS part
FROM train"""
ORACLES["latest_k_periods"] = f"""WITH {LABELLED_B1}
SELECT DISTINCT period FROM labelled ORDER BY period DESC LIMIT 2"""
ORACLES["latest_period_rows"] = f"""WITH {FEATURES_B1}
SELECT {FEATURE_OUT} FROM features WHERE period = (SELECT max(period) FROM features)"""

# ------------------------------------------------- metrics (fixed scores) ----

_FIXED_MARGIN = ("((((CAST(-3.0 AS DOUBLE) + CAST(0.02 AS DOUBLE) * lag_1) + CAST(0.02 AS DOUBLE) * lag_3_mean_obs)"
                 " + CAST(0.02 AS DOUBLE) * lag_5_mean_obs) + CAST(-0.1 AS DOUBLE) * periods_since_last_obs)")
FIXED_SCORE = r6(f"CAST(1.0 AS DOUBLE) / (CAST(1.0 AS DOUBLE) + exp(-{_FIXED_MARGIN}))")


def detail_ctes(k: int) -> str:
    """CTE `detail`: last k outcome periods of the labelled B1 rows, fixed score, top-quartile flag."""
    return f"""{LABELLED_B1},
held AS (SELECT DISTINCT outcome_period FROM labelled ORDER BY outcome_period DESC LIMIT {k}),
scored AS (SELECT entity, period, outcome_period, y, {FIXED_SCORE} AS risk_score FROM labelled
           WHERE outcome_period IN (SELECT outcome_period FROM held)),
detail AS (SELECT *, CASE WHEN row_number() OVER (PARTITION BY outcome_period ORDER BY risk_score DESC, entity, period)
             <= greatest(1, ceil(0.25 * count(*) OVER (PARTITION BY outcome_period))) THEN 1 ELSE 0 END
             AS predicted_top_quartile FROM scored)"""


def _ratio(num: str, den: str) -> str:
    return f"(CASE WHEN {den} > 0 THEN CAST({num} AS DOUBLE) / {den} ELSE 0.0 END)"


_TP = "count(*) FILTER (WHERE y = 1 AND predicted_top_quartile = 1)"
_PP = "count(*) FILTER (WHERE predicted_top_quartile = 1)"
_AP = "count(*) FILTER (WHERE y = 1)"


def auc_ctes(src: str = "detail", score: str = "risk_score") -> str:
    """CTEs `auc_per` (per outcome period) and `auc_all` (pooled) with exact tie-aware AUC."""
    return f"""cnt AS (SELECT outcome_period, {score} AS s, count(*) FILTER (WHERE y = 1) AS pos,
                  count(*) FILTER (WHERE y = 0) AS neg FROM {src} GROUP BY 1, 2),
pre AS (SELECT *, coalesce(sum(neg) OVER (PARTITION BY outcome_period ORDER BY s
          ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS neg_before FROM cnt),
auc_per AS (SELECT outcome_period, CASE WHEN sum(pos) > 0 AND sum(neg) > 0 THEN
              CAST(sum(pos * (2 * neg_before + neg)) AS DOUBLE) / CAST(2 * sum(pos) * sum(neg) AS DOUBLE) END AS auc
            FROM pre GROUP BY 1),
cnt2 AS (SELECT {score} AS s, count(*) FILTER (WHERE y = 1) AS pos, count(*) FILTER (WHERE y = 0) AS neg
         FROM {src} GROUP BY 1),
pre2 AS (SELECT *, coalesce(sum(neg) OVER (ORDER BY s ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)
           AS neg_before FROM cnt2),
auc_all AS (SELECT CASE WHEN sum(pos) > 0 AND sum(neg) > 0 THEN
              CAST(sum(pos * (2 * neg_before + neg)) AS DOUBLE) / CAST(2 * sum(pos) * sum(neg) AS DOUBLE) END AS auc
            FROM pre2)"""


def _levels_with_auc(aggs: str) -> str:
    return f"""{_summary_ctes(aggs)} SELECT * FROM summary"""


def _summary_ctes(aggs: str) -> str:
    """CTEs ending in `summary`: rollup rows per outcome period and pooled, with AUC."""
    return f"""lv AS (SELECT outcome_period, CASE WHEN grouping(outcome_period) = 1 THEN 'pooled' ELSE 'period' END AS level,
  {aggs} FROM detail GROUP BY GROUPING SETS ((outcome_period), ())),
{auc_ctes()},
summary AS (SELECT lv.*, {r6('CASE WHEN lv.level = ' + "'pooled'" + ' THEN (SELECT auc FROM auc_all) ELSE a.auc END')} AS auc
FROM lv LEFT JOIN auc_per a ON lv.level = 'period' AND a.outcome_period = lv.outcome_period)"""


ORACLES["score_with_params"] = f"""WITH {FEATURES_B1}
SELECT entity, period, {FIXED_SCORE} AS risk_score FROM features
WHERE lag_1 IS NOT NULL AND lag_3_mean_obs IS NOT NULL AND lag_5_mean_obs IS NOT NULL
  AND periods_since_last_obs IS NOT NULL"""
ORACLES["flag_top_quartile"] = f"WITH {detail_ctes(2)} SELECT * FROM detail"
ORACLES["naive_flags"] = f"""WITH {detail_ctes(2)},
m AS (SELECT d.*, f.lag_1 AS raw_lag_1 FROM detail d LEFT JOIN features f ON f.entity = d.entity AND f.period = d.period)
SELECT entity, period, outcome_period, y, risk_score, predicted_top_quartile, {r6('raw_lag_1')} AS lag_1,
  CASE WHEN row_number() OVER (PARTITION BY outcome_period ORDER BY raw_lag_1 DESC, entity, period)
    <= greatest(1, ceil(0.25 * count(*) OVER (PARTITION BY outcome_period))) THEN 1 ELSE 0 END
    AS naive_predicted_top_quartile
FROM m"""
ORACLES["naive_join_guard"] = f"""WITH {detail_ctes(2)}
SELECT count(*) AS rows, count(*) FILTER (WHERE f.lag_1 IS NULL) AS missing_lag_1
FROM detail d LEFT JOIN features f ON f.entity = d.entity AND f.period = d.period"""
ORACLES["risk_percentile"] = f"""WITH {FEATURES_B1},
s AS (SELECT entity, period, {FIXED_SCORE} AS risk_score FROM features
      WHERE lag_1 IS NOT NULL AND lag_3_mean_obs IS NOT NULL AND lag_5_mean_obs IS NOT NULL)
SELECT entity, period, risk_score, {r6('cume_dist() OVER (PARTITION BY period ORDER BY risk_score) * 100.0')}
  AS risk_percentile FROM s"""
ORACLES["precision_recall_at_half"] = f"""WITH {detail_ctes(2)}
SELECT count(*) AS rows, count(*) FILTER (WHERE risk_score >= 0.5 AND y = 1) AS true_positives,
  count(*) FILTER (WHERE risk_score >= 0.5) AS predicted_positives, count(*) FILTER (WHERE y = 1) AS actual_positives,
  {_ratio("count(*) FILTER (WHERE risk_score >= 0.5 AND y = 1)", "count(*) FILTER (WHERE risk_score >= 0.5)")}
    AS precision_at_0_5,
  {_ratio("count(*) FILTER (WHERE risk_score >= 0.5 AND y = 1)", "count(*) FILTER (WHERE y = 1)")} AS recall_at_0_5
FROM detail"""
ORACLES["top_quartile_metrics"] = f"""WITH {detail_ctes(2)},
{_levels_with_auc(f"count(*) AS rows, {r6('avg(CAST(y AS DOUBLE))')} AS positive_rate, "
                  f"{_ratio(_TP, _PP)} AS precision_at_top_quartile, {_ratio(_TP, _AP)} AS recall_at_top_quartile")}"""
_SUMMARY_AGGS = (f"count(*) AS rows, {_PP} AS predicted_top_quartile_count, {_AP} AS actual_top_quartile_count, "
                 f"{_TP} AS true_positives, {_ratio(_TP, _PP)} AS precision_at_top_quartile, "
                 f"{_ratio(_TP, _AP)} AS recall_at_top_quartile")
ORACLES["backtest_summary"] = f"""WITH {detail_ctes(2)}, {_levels_with_auc(_SUMMARY_AGGS)}"""
ORACLES["roc_auc"] = f"""WITH {detail_ctes(2)}, {auc_ctes()} SELECT outcome_period, {r6('auc')} AS auc FROM auc_per"""
_edges = "[" + ", ".join(str(i / 10) for i in range(11)) + "]"
ORACLES["calibration_deciles"] = f"""WITH {detail_ctes(2)},
e AS (SELECT list_sort(list_distinct(quantile_cont(risk_score, {_edges}))) AS edges,
             min(risk_score) < max(risk_score) AS spread FROM detail),
b AS (SELECT d.*, CASE WHEN NOT e.spread THEN 0
        ELSE CAST(greatest(len(list_filter(e.edges, lambda x: x < d.risk_score)), 1) - 1 AS INTEGER) END AS decile
      FROM detail d, e)
SELECT decile, count(*) AS count, {r6('avg(risk_score)')} AS mean_pred, {r6('avg(CAST(y AS DOUBLE))')} AS observed_rate
FROM b GROUP BY decile"""
_q = ", ".join(f"{r6(f'quantile_cont(risk_score, {p})')} AS {n}" for p, n in
               zip([0.01, 0.05, 0.5, 0.95, 0.99], ["p01", "p05", "p50", "p95", "p99"]))
ORACLES["score_distribution"] = f"""WITH {detail_ctes(2)}
SELECT outcome_period, CASE WHEN grouping(outcome_period) = 1 THEN 'pooled' ELSE 'period' END AS level, {_q},
  avg(CAST(risk_score > 0.99 AS DOUBLE)) AS share_gt_0_99, avg(CAST(risk_score < 0.01 AS DOUBLE)) AS share_lt_0_01
FROM detail GROUP BY GROUPING SETS ((outcome_period), ())"""
ORACLES["roc_points"] = f"""WITH {detail_ctes(2)},
c AS (SELECT risk_score AS threshold, count(*) FILTER (WHERE y = 1) AS pos, count(*) FILTER (WHERE y = 0) AS neg
      FROM detail GROUP BY 1),
r AS (SELECT threshold, CAST(sum(pos) OVER (ORDER BY threshold DESC ROWS UNBOUNDED PRECEDING) AS BIGINT) AS true_positives,
        CAST(sum(neg) OVER (ORDER BY threshold DESC ROWS UNBOUNDED PRECEDING) AS BIGINT) AS false_positives,
        sum(pos) OVER () AS p, sum(neg) OVER () AS n FROM c)
SELECT threshold, true_positives, false_positives,
  {r6('CASE WHEN n > 0 THEN CAST(false_positives AS DOUBLE) / n END')} AS fpr,
  {r6('CASE WHEN p > 0 THEN CAST(true_positives AS DOUBLE) / p END')} AS tpr FROM r"""


def _auc_delta(k: int) -> str:
    return f"""(WITH {detail_ctes(k)},
nd AS (SELECT d.outcome_period, d.y, f.lag_1 FROM detail d JOIN features f ON f.entity = d.entity AND f.period = d.period),
{auc_ctes()},
{auc_ctes('nd', 'lag_1').replace('cnt AS', 'ncnt AS').replace('pre AS', 'npre AS').replace('FROM cnt', 'FROM ncnt')
   .replace('auc_per AS', 'nauc_per AS').replace('FROM pre', 'FROM npre').replace('cnt2 AS', 'ncnt2 AS')
   .replace('FROM cnt2', 'FROM ncnt2').replace('pre2 AS', 'npre2 AS').replace('FROM pre2', 'FROM npre2')
   .replace('auc_all AS', 'nauc_all AS')}
SELECT {k} AS holdout_periods, {r6('(SELECT auc FROM auc_all)')} AS model_auc, {r6('(SELECT auc FROM nauc_all)')} AS naive_auc,
  {r6('((SELECT auc FROM auc_all) - (SELECT auc FROM nauc_all)) * 10000')} AS delta_bps)"""


ORACLES["auc_delta"] = f"SELECT * FROM {_auc_delta(1)} UNION ALL SELECT * FROM {_auc_delta(2)}"
ORACLES["top_predicted"] = f"""WITH {detail_ctes(1)}
SELECT entity, risk_score, y, predicted_top_quartile FROM detail ORDER BY risk_score DESC, entity LIMIT 25"""
ORACLES["top_misses"] = f"""WITH {detail_ctes(1)}
SELECT entity, risk_score, y, predicted_top_quartile FROM detail WHERE y = 0 ORDER BY risk_score DESC, entity LIMIT 25"""
ORACLES["top_surprises"] = f"""WITH {detail_ctes(1)}
SELECT entity, risk_score, y, predicted_top_quartile FROM detail WHERE y = 1 ORDER BY risk_score ASC, entity LIMIT 25"""
ORACLES["period_ranges"] = f"""WITH {FEATURES_B1}
SELECT min(period) AS period_min, max(period) AS period_max, count(DISTINCT period) AS distinct_periods,
  count(*) AS rows, min(outcome_period) AS outcome_period_min, max(outcome_period) AS outcome_period_max FROM features"""


def _pct(x: str) -> str:
    return f"CASE WHEN {x} IS NOT NULL THEN printf('%.1f%%', floor({x} * 100.0 * 10.0 + 0.5) / 10.0) END"


ORACLES["format_metrics"] = f"""WITH {detail_ctes(2)}, {_summary_ctes(_SUMMARY_AGGS)}
SELECT outcome_period, level, {_pct('precision_at_top_quartile')} AS precision_text,
  {_pct('recall_at_top_quartile')} AS recall_text,
  CASE WHEN auc IS NULL THEN 'N/A' ELSE printf('%.3f', floor(auc * 1000.0 + 0.5) / 1000.0) END AS auc_text FROM summary"""

# --------------------------------------------------------- request scoring ----

REQUESTS = """SELECT event_id AS request_id,
  CASE WHEN event_id % 6 = 0 THEN (CASE WHEN length(CAST(user_id AS VARCHAR)) < 5 THEN lpad(CAST(user_id AS VARCHAR), 5, '0') ELSE CAST(user_id AS VARCHAR) END)
       WHEN event_id % 6 = 1 THEN '0' || (CASE WHEN length(CAST(user_id AS VARCHAR)) < 5 THEN lpad(CAST(user_id AS VARCHAR), 5, '0') ELSE CAST(user_id AS VARCHAR) END)
       WHEN event_id % 6 = 2 THEN ' ' || CAST(user_id AS VARCHAR) || ' '
       WHEN event_id % 6 = 3 THEN '99999'
       WHEN event_id % 6 = 4 THEN '   '
       ELSE CAST(user_id AS VARCHAR) || '12' END AS raw_key,
  CAST(CASE WHEN event_id % 5 = 0 THEN NULL WHEN event_id % 5 = 1 THEN 40 WHEN event_id % 5 = 2 THEN -3
       ELSE date_diff('day', DATE '2024-01-01', CAST(ts AS DATE)) END AS INTEGER) AS as_of_period
FROM events"""

_VALID_REQ = f"""req AS ({REQUESTS}),
rv AS (SELECT *, {norm_key_request('raw_key')} AS entity FROM req),
v AS (SELECT *, (entity IS NULL OR (as_of_period IS NOT NULL AND (as_of_period < 0 OR as_of_period > 365)))
       AS invalid FROM rv)"""
_SCOREABLE = ("lag_1 IS NOT NULL AND lag_3_mean_obs IS NOT NULL AND lag_5_mean_obs IS NOT NULL "
              "AND periods_since_last_obs IS NOT NULL")
_INFO = f"""info AS (SELECT entity, min(CASE WHEN {_SCOREABLE} THEN period END) AS available_periods_min,
  max(CASE WHEN {_SCOREABLE} THEN period END) AS available_periods_max FROM features GROUP BY entity)"""

ORACLES["request_validation"] = f"""WITH {_VALID_REQ} SELECT request_id, raw_key, as_of_period, entity, invalid FROM v"""
ORACLES["score_requests_resolve"] = f"""WITH {FEATURES_B1}, {_VALID_REQ}, {_INFO},
k AS (SELECT DISTINCT entity, as_of_period FROM v WHERE NOT invalid)
SELECT k.entity, k.as_of_period, i.available_periods_min, i.available_periods_max,
  coalesce(k.as_of_period, i.available_periods_max) AS resolved_period
FROM k LEFT JOIN info i ON i.entity = k.entity"""
ORACLES["score_requests"] = f"""WITH {FEATURES_B1}, {_VALID_REQ}, {_INFO},
sc AS (SELECT entity, period, {FIXED_SCORE} AS risk_score, lag_1, lag_3_mean_obs, lag_5_mean_obs,
         periods_since_last_obs FROM features WHERE {_SCOREABLE}),
scp AS (SELECT *, cume_dist() OVER (PARTITION BY period ORDER BY risk_score) * 100.0 AS pct FROM sc),
res AS (SELECT v.*, i.entity IS NOT NULL AS known, i.available_periods_min AS smin, i.available_periods_max AS smax,
          coalesce(v.as_of_period, i.available_periods_max) AS resolved
        FROM v LEFT JOIN info i ON NOT v.invalid AND i.entity = v.entity),
st AS (SELECT res.*, s.risk_score, s.pct, s.lag_1, s.lag_3_mean_obs, s.lag_5_mean_obs, s.periods_since_last_obs,
         CASE WHEN invalid THEN 'invalid' WHEN NOT known THEN 'unknown_entity' WHEN smax IS NULL THEN 'no_scoreable_period'
              WHEN s.entity IS NULL THEN 'period_unavailable' ELSE 'ok' END AS status
       FROM res LEFT JOIN scp s ON NOT res.invalid AND s.entity = res.entity AND s.period = res.resolved)
SELECT request_id, raw_key, entity,
  CASE WHEN status = 'ok' THEN resolved ELSE as_of_period END AS as_of_period, status,
  CASE WHEN status = 'ok' THEN risk_score END AS risk_score,
  'fixed-params' AS model_version, 'logistic_fixed_params' AS model_type,
  CASE WHEN invalid THEN NULL ELSE status = 'ok' END AS as_of_period_available,
  CASE WHEN status IN ('ok', 'period_unavailable') THEN smin END AS available_periods_min,
  CASE WHEN status IN ('ok', 'period_unavailable') THEN smax END AS available_periods_max,
  CASE WHEN status = 'ok' THEN {r6('pct')} END AS risk_percentile_in_period,
  CASE WHEN status = 'ok' THEN {r6('lag_1')} END AS feature_lag_1,
  CASE WHEN status = 'ok' THEN {r6('lag_3_mean_obs')} END AS feature_lag_3_mean_obs,
  CASE WHEN status = 'ok' THEN {r6('lag_5_mean_obs')} END AS feature_lag_5_mean_obs,
  CASE WHEN status = 'ok' THEN {r6('CAST(periods_since_last_obs AS DOUBLE)')} END AS feature_periods_since_last_obs,
  CASE WHEN status = 'ok' AND as_of_period IS NULL
       THEN 'as_of_period was not provided. Used latest available period (' || CAST(smax AS VARCHAR) || ').' END AS notes
FROM st"""

# ------------------------------------------------------------ name lookup ----

def _sql_str(s: str) -> str:
    return "'" + s.replace("'", "''") + "'"


def norm_text(x: str) -> str:
    from ..operators.resolve import ACCENTS_FROM, ACCENTS_TO, _EXTRA_WS

    t = f"translate(lower({x}), {_sql_str(ACCENTS_FROM)}, {_sql_str(ACCENTS_TO)})"
    t = f"regexp_replace({t}, {_sql_str('[^a-z0-9' + chr(92) + 's' + _EXTRA_WS + ']')}, ' ', 'g')"
    t = f"regexp_replace({t}, {_sql_str('[' + chr(92) + 's' + _EXTRA_WS + ']+')}, ' ', 'g')"
    return f"regexp_replace({t}, '^ | $', '', 'g')"


def display(x: str) -> str:
    pat = r"(county|parish|borough|census area|municipality|city and borough|city|municipio)\b"
    return f"(CASE WHEN regexp_matches(trim({x}), '{pat}', 'i') THEN trim({x}) ELSE trim({x}) || ' County' END)"


NAMES = f"""names AS (SELECT trim(p_name) AS name, trim(p_brand) AS group_code, trim(CAST(p_partkey AS VARCHAR)) AS key,
  p_partkey AS ord, {norm_text('p_name')} AS norm_name FROM part
  WHERE p_name IS NOT NULL AND p_brand IS NOT NULL AND p_partkey IS NOT NULL)"""
ORACLES["display_name"] = f"""WITH {NAMES}
SELECT key, name, {display('name')} AS display_name, norm_name AS normalized_name FROM names"""
def _resolved(queries: str) -> str:
    return f"""WITH {NAMES},
q AS ({queries}),
qv AS (SELECT * FROM (SELECT query_id, query_text, {norm_text('query_text')} AS q_norm FROM q)
       WHERE length(trim(query_text)) >= 2 AND length(q_norm) >= 2),
m AS (SELECT qv.query_id, qv.query_text, n.*, CASE WHEN starts_with(n.norm_name, qv.q_norm) THEN 0 ELSE 1 END AS tier
      FROM qv JOIN names n ON contains(n.norm_name, qv.q_norm)),
r AS (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY tier, ord) AS rank FROM m)
SELECT CAST(query_id AS BIGINT) AS query_id, query_text, CAST(rank AS INTEGER) AS rank, key, name, group_code,
  CASE WHEN tier = 0 THEN 'prefix' ELSE 'contains' END AS match,
  {display('name')} AS display_name FROM r WHERE rank <= 12"""


ORACLES["resolve_names"] = _resolved(
    "SELECT * FROM (VALUES (1, 're'), (2, 'gear'), (3, 'blue b'), (4, 'x')) t(query_id, query_text)")
ORACLES["resolve_part_names"] = _resolved(
    "SELECT p_partkey AS query_id, substr(p_name, CAST(p_partkey // 100 % 4 + 1 AS INTEGER), 6) AS query_text "
    "FROM part WHERE p_partkey % 100 = 0 AND p_name IS NOT NULL")
ORACLES["name_gram_counts"] = f"""WITH {NAMES},
places AS (SELECT norm_name, unnest(range(1, length(norm_name))) AS i FROM names)
SELECT substr(norm_name, i, 3) AS gram, count(*) AS n FROM places GROUP BY 1"""
ORACLES["fold_names"] = f"""SELECT CAST(p_partkey AS VARCHAR) AS key, {norm_text('p_name')} || ' o iikg 1 2ffl' AS normalized_name FROM part"""

# ------------------------------------------------- re-typing after a text trip ----

def _retyped(src: str, outcome: str) -> str:
    w = "coalesce(TRY_CAST(sample_weight AS DOUBLE), 1.0)"
    return f"""SELECT {repad_key('entity')} AS entity, TRY_CAST(period AS INTEGER) AS period, {outcome} AS outcome_period,
  CAST(TRY_CAST(y AS DOUBLE) AS INTEGER) AS y, {r6('TRY_CAST(lag_1 AS DOUBLE)')} AS lag_1,
  {r6('TRY_CAST(lag_3_mean_obs AS DOUBLE)')} AS lag_3_mean_obs, {r6('TRY_CAST(lag_5_mean_obs AS DOUBLE)')} AS lag_5_mean_obs,
  CAST(TRY_CAST(periods_since_last_obs AS DOUBLE) AS INTEGER) AS periods_since_last_obs, {r6(w)} AS sample_weight
FROM {src}"""


ORACLES["feature_table_compat"] = f"""WITH b1 AS ({B2}), {weighted()}, {features_ctes()},
features AS ({FEATURES_RAW_SELECT})
{_retyped('features', 'CAST(period AS INTEGER) + 1')}"""
ORACLES["standardize_features"] = f"""WITH {FEATURES_B1},
blanked AS (SELECT * REPLACE (CASE WHEN period % 7 = 0 THEN NULL ELSE sample_weight END AS sample_weight) FROM features)
{_retyped('blanked', 'outcome_period')}"""
ORACLES["split_semi_anti"] = ORACLES["split_by_outcome"]

ORACLES["yearly_features_raw"] = f"""WITH {CLEAN_RAW_CTES.replace('panel AS (', 'wpanel AS (')},
panel AS (SELECT entity, period, avg(rate) AS rate, avg(sample_weight) AS sample_weight FROM wpanel GROUP BY 1, 2),
{features_ctes()}
{YEARLY_FEATURES_SELECT}"""

ORACLES["invalid_row_counts_monthly"] = _raw_monthly(
    f"""SELECT count(*) AS input_rows, count(*) FILTER (WHERE entity IS NULL) AS null_entity,
      count(*) FILTER (WHERE entity IS NOT NULL AND month IS NULL) AS null_month,
      count(*) FILTER (WHERE entity IS NOT NULL AND month IS NOT NULL AND rate IS NULL) AS null_rate,
      count(*) FILTER (WHERE entity IS NULL OR month IS NULL OR rate IS NULL) AS dropped_rows,
      count(*) FILTER (WHERE entity IS NOT NULL AND month IS NOT NULL AND rate IS NOT NULL) AS kept_rows
    FROM (SELECT {norm_key_numeric('"County_FIPS"')} AS entity, {month_floor('"MONTH"')} AS month,
      {coerce_double('"eviction filing rate"')} AS rate FROM raw)"""
)
ORACLES["weight_audit"] = f"""WITH b1 AS ({B1}), {weighted()}
SELECT count(*) AS rows, count(*) FILTER (WHERE NOT coalesce(implied_exposure > 0, FALSE) OR weight_cap IS NULL) AS default_weight_rows,
  count(*) FILTER (WHERE implied_exposure > weight_cap) AS capped_rows, {r6('max(weight_cap)')} AS weight_cap
FROM imp LEFT JOIN cap ON TRUE"""
ORACLES["standardize_monthly_features"] = ORACLES["monthly_features"]
ORACLES["features_used"] = ORACLES["score_requests"].rsplit("SELECT request_id", 1)[0] + "SELECT * FROM (" + " UNION ALL ".join(
    f"SELECT request_id, '{c}' AS feature, {r6(f'CAST({c} AS DOUBLE)')} AS value FROM st WHERE status = 'ok'"
    for c in ("lag_1", "lag_3_mean_obs", "lag_5_mean_obs", "periods_since_last_obs")
) + ")"
ORACLES["score_request_stream"] = ORACLES["score_requests"]
ORACLES["monthly_features_by_increments"] = ORACLES["monthly_features"]
