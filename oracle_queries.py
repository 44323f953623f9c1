"""DuckDB oracle SQL, one statement per registered query.

Each statement re-derives its result from the raw test tables (views
``customer nation region orders lineitem`` ...) without sharing code with the
Spark plans: the ledger features follow the straightforward shape (one
``GROUP BY`` per feature family, ``count(DISTINCT ...)``), so a fused-plan
mistake on the Spark side shows up as a mismatch.

Numeric conventions shared with the Spark side of the check: integer
counts are BIGINT, whole-day differences INTEGER, doubles rounded to 6
places, amounts summed as DECIMAL then cast to DOUBLE.
"""

from __future__ import annotations

# Stand-in inputs (same definition as ledgerlens.sources.standin).
STANDIN = """
ledger AS (
  SELECT CASE WHEN l_quantity = 1 THEN -1 ELSE o_custkey END AS source,
         CASE WHEN l_quantity = 1 THEN o_custkey
              WHEN l_quantity = 2 THEN -1
              ELSE l_partkey - l_partkey % 2 END AS target,
         o_orderdate AS time,
         CAST(l_extendedprice AS DECIMAL(18,2)) AS amount
  FROM lineitem JOIN orders ON l_orderkey = o_orderkey
  WHERE o_orderdate < TIMESTAMP '2001-01-01 00:00:00'
),
acct_labels_all AS (
  SELECT c_custkey AS id,
         CAST(NOT EXISTS (SELECT 1 FROM orders WHERE o_custkey = c_custkey
                          AND o_orderdate >= TIMESTAMP '2001-01-01 00:00:00') AS INTEGER) AS inactive
  FROM customer
),
acct_users AS (
  SELECT c_custkey AS id, CAST(c_acctbal AS DOUBLE) AS start_balance,
         TIMESTAMP '1995-01-01 00:00:00' + to_days(CAST(c_custkey % 700 AS INTEGER))
           + to_hours(CAST(c_custkey % 24 AS INTEGER)) AS registration_time,
         'individual' AS account_type, c_mktsegment AS business_type,
         n_name AS area_name, r_name AS area_type,
         CASE WHEN c_custkey % 10 < 5 THEN 'male' WHEN c_custkey % 10 < 9 THEN 'female'
              ELSE 'unknown' END AS gender
  FROM customer JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey
)"""

POPULATION_FILTER = {
    "all": "TRUE",
    "train": "id % 5 <> 0",
    "test": "id % 5 = 0",
}


def p2_ctes(population: str = "all", labelled: bool = True, stats: str | None = None) -> str:
    """CTEs ending in ``p2``: base features of a population, with the global values of the
    p2 table ``stats`` or else its own."""
    label_cols = "pop.inactive," if labelled else ""
    max_reg, min_last, max_first = (f"(SELECT {e} FROM {stats or 'j'})" for e in (
        "max(registration_time)", f"min({'last_trx_date' if stats else 'last_d'})",
        f"max({'first_trx_date' if stats else 'first_d'})"))
    max_last = f"(SELECT max(last_trx_date) FROM {stats})" if stats else "(SELECT max(last_f) FROM j2)"
    return f"""{STANDIN},
pop AS (SELECT * FROM acct_labels_all WHERE {POPULATION_FILTER[population]}),
trx AS (SELECT source, target, CAST(time AS DATE) AS d, amount FROM ledger),
s_cnt AS (SELECT source AS id, count(*) AS n_sent,
                 sum(CASE WHEN target = -1 THEN 1 ELSE 0 END) AS n_pen
          FROM trx GROUP BY source),
r_cnt AS (SELECT target AS id, count(*) AS n_recv,
                 sum(CASE WHEN source = -1 THEN 1 ELSE 0 END) AS n_bon
          FROM trx GROUP BY target),
r_part AS (SELECT target AS id, count(DISTINCT source) AS p_recv FROM trx GROUP BY target),
s_part AS (SELECT source AS id, count(DISTINCT target) AS p_sent FROM trx GROUP BY source),
s_dates AS (SELECT source AS id, min(d) AS first_d, max(d) AS last_d FROM trx GROUP BY source),
amt_r AS (SELECT target AS id, sum(amount) AS amount_received FROM trx GROUP BY target),
amt_s AS (SELECT source AS id, sum(amount) AS amount_sent FROM trx GROUP BY source),
amt_b AS (SELECT target AS id, sum(amount) AS amount_bonuses FROM trx WHERE source = -1 GROUP BY target),
amt_p AS (SELECT source AS id, sum(amount) AS amount_penalties FROM trx WHERE target = -1 GROUP BY source),
j AS (
  SELECT pop.id, {label_cols}
         u.start_balance, u.registration_time, u.account_type, u.business_type,
         u.area_name, u.area_type, u.gender,
         s_cnt.n_sent, r_cnt.n_recv, s_cnt.n_pen, r_cnt.n_bon, r_part.p_recv, s_part.p_sent,
         s_dates.first_d, s_dates.last_d,
         amt_s.amount_sent, amt_r.amount_received, amt_b.amount_bonuses, amt_p.amount_penalties
  FROM pop
  LEFT JOIN acct_users u ON u.id = pop.id
  LEFT JOIN s_cnt ON s_cnt.id = pop.id LEFT JOIN r_cnt ON r_cnt.id = pop.id
  LEFT JOIN r_part ON r_part.id = pop.id LEFT JOIN s_part ON s_part.id = pop.id
  LEFT JOIN s_dates ON s_dates.id = pop.id
  LEFT JOIN amt_s ON amt_s.id = pop.id LEFT JOIN amt_r ON amt_r.id = pop.id
  LEFT JOIN amt_b ON amt_b.id = pop.id LEFT JOIN amt_p ON amt_p.id = pop.id
),
j2 AS (
  SELECT j.*,
         CASE WHEN registration_time IS NOT NULL THEN
           greatest((epoch_us({max_reg}) - epoch_us(registration_time)) / 86400000000.0, 0) END AS dfr_raw,
         coalesce(last_d, {min_last}) AS last_f,
         coalesce(first_d, {max_first}) AS first_f
  FROM j
),
j3 AS (
  SELECT j2.*, date_diff('day', last_f, {max_last}) AS dpl FROM j2
),
flags AS (SELECT id, CASE WHEN dpl > 30 THEN 1 ELSE 0 END AS is_stage_2 FROM j3),
r2 AS (SELECT t.target AS id, count(DISTINCT t.source) AS r2
       FROM trx t JOIN flags f ON t.source = f.id WHERE f.is_stage_2 = 1 GROUP BY t.target),
s2 AS (SELECT t.source AS id, count(DISTINCT t.target) AS s2
       FROM trx t JOIN flags f ON t.target = f.id WHERE f.is_stage_2 = 1 GROUP BY t.source),
p2 AS (
  SELECT j3.id, {"j3.inactive," if labelled else ""}
         coalesce(j3.start_balance, 0) AS start_balance, j3.registration_time,
         coalesce(j3.account_type, '0') AS account_type,
         coalesce(j3.business_type, '0') AS business_type,
         coalesce(j3.area_name, '0') AS area_name,
         coalesce(j3.area_type, '0') AS area_type,
         coalesce(j3.gender, '0') AS gender,
         CAST(coalesce(n_sent, 0) AS BIGINT) AS n_transactions_sent,
         CAST(coalesce(n_recv, 0) AS BIGINT) AS n_transactions_received,
         CAST(coalesce(n_pen, 0) AS BIGINT) AS n_penalties,
         CAST(coalesce(n_bon, 0) AS BIGINT) AS n_bonuses,
         CAST(coalesce(p_recv, 0) AS BIGINT) AS n_partners_received,
         CAST(coalesce(p_sent, 0) AS BIGINT) AS n_partners_sent,
         first_f AS first_trx_date, last_f AS last_trx_date,
         CAST(coalesce(n_recv + n_sent, 0) AS BIGINT) AS n_transactions,
         CAST(coalesce(p_recv + p_sent, 0) AS BIGINT) AS n_partners,
         CAST(registration_time AS DATE) AS registration_date,
         CAST(coalesce(date_diff('day', CAST(registration_time AS DATE), first_d), 0) AS INTEGER)
           AS days_before_first_trx,
         coalesce(dfr_raw, 0) AS days_from_registr,
         coalesce((n_recv + n_sent) / nullif(dfr_raw, 0), 0) AS count_intensity,
         coalesce(n_sent / nullif(dfr_raw, 0), 0) AS count_sent_intensity,
         coalesce(n_recv / nullif(dfr_raw, 0), 0) AS count_received_intensity,
         CAST(coalesce(dpl, 0) AS INTEGER) AS days_past_last_trxs,
         CASE WHEN dpl > 30 THEN 1 ELSE 0 END AS is_stage_2,
         CAST(coalesce(r2.r2, 0) AS BIGINT) AS n_partners_received_stage_2,
         CAST(coalesce(s2.s2, 0) AS BIGINT) AS n_partners_sent_stage_2,
         CAST(coalesce(s2.s2, 0) + coalesce(r2.r2, 0) AS BIGINT) AS n_partners_stage_2,
         coalesce((coalesce(s2.s2, 0) + coalesce(r2.r2, 0))
                  / nullif(coalesce(p_recv + p_sent, 0), 0), 0) AS stage_2_partners_share,
         coalesce(coalesce(dfr_raw, 0) / nullif(coalesce(n_recv + n_sent, 0), 0), 0)
           AS avg_time_between_trxs,
         amount_sent, amount_received, amount_bonuses, amount_penalties
  FROM j3 LEFT JOIN r2 ON r2.id = j3.id LEFT JOIN s2 ON s2.id = j3.id
)"""


P2_DOUBLES = ["start_balance", "days_from_registr", "count_intensity", "count_sent_intensity",
              "count_received_intensity", "stage_2_partners_share", "avg_time_between_trxs"]
P2_COLUMNS = ["id", "inactive", "start_balance", "registration_time", "account_type",
              "business_type", "area_name", "area_type", "gender",
              "n_transactions_sent", "n_transactions_received", "n_penalties", "n_bonuses",
              "n_partners_received", "n_partners_sent", "first_trx_date", "last_trx_date",
              "n_transactions", "n_partners", "registration_date", "days_before_first_trx",
              "days_from_registr", "count_intensity", "count_sent_intensity",
              "count_received_intensity", "days_past_last_trxs", "is_stage_2",
              "n_partners_received_stage_2", "n_partners_sent_stage_2", "n_partners_stage_2",
              "stage_2_partners_share", "avg_time_between_trxs"]


P2_DATES = ["first_trx_date", "last_trx_date", "registration_date"]


def _rounded(cols, doubles, digits: int = 6, dates=P2_DATES) -> str:
    def one(c):
        if c in doubles:
            return f"round(CAST({c} AS DOUBLE), {digits}) AS {c}"
        if c in dates:
            return f"CAST({c} AS VARCHAR) AS {c}"
        return c
    return ", ".join(one(c) for c in cols)


def base_features_sql() -> str:
    return f"WITH {p2_ctes('all')}\nSELECT {_rounded(P2_COLUMNS, P2_DOUBLES)} FROM p2"


def account_activity_sql() -> str:
    return f"""WITH {STANDIN},
trx AS (SELECT source, target, CAST(time AS DATE) AS d, amount FROM ledger),
ids AS (SELECT source AS id FROM trx UNION SELECT target FROM trx),
s AS (SELECT source AS id, count(*) AS n_sent,
             sum(CASE WHEN target = -1 THEN 1 ELSE 0 END) AS n_pen,
             count(DISTINCT target) AS p_sent, min(d) AS first_d, max(d) AS last_d,
             sum(amount) AS a_sent FROM trx GROUP BY source),
r AS (SELECT target AS id, count(*) AS n_recv,
             sum(CASE WHEN source = -1 THEN 1 ELSE 0 END) AS n_bon,
             count(DISTINCT source) AS p_recv, sum(amount) AS a_recv FROM trx GROUP BY target),
b AS (SELECT target AS id, sum(amount) AS a_bon FROM trx WHERE source = -1 GROUP BY target),
p AS (SELECT source AS id, sum(amount) AS a_pen FROM trx WHERE target = -1 GROUP BY source)
SELECT ids.id,
       CAST(n_sent AS DOUBLE) AS n_transactions_sent, CAST(n_recv AS DOUBLE) AS n_transactions_received,
       CAST(n_pen AS DOUBLE) AS n_penalties, CAST(n_bon AS DOUBLE) AS n_bonuses,
       CAST(p_recv AS DOUBLE) AS n_partners_received, CAST(p_sent AS DOUBLE) AS n_partners_sent,
       CAST(first_d AS VARCHAR) AS first_trx_date, CAST(last_d AS VARCHAR) AS last_trx_date,
       round(CAST(a_sent AS DOUBLE), 6) AS amount_sent, round(CAST(a_recv AS DOUBLE), 6) AS amount_received,
       round(CAST(a_bon AS DOUBLE), 6) AS amount_bonuses, round(CAST(a_pen AS DOUBLE), 6) AS amount_penalties
FROM ids LEFT JOIN s USING (id) LEFT JOIN r USING (id) LEFT JOIN b USING (id) LEFT JOIN p USING (id)"""


def dormant_neighbours_sql() -> str:
    return f"""WITH {p2_ctes('all')},
fl AS (SELECT id FROM p2 WHERE is_stage_2 = 1),
rr AS (SELECT t.target AS id, count(DISTINCT t.source) AS c FROM trx t JOIN fl ON t.source = fl.id
       GROUP BY t.target),
ss AS (SELECT t.source AS id, count(DISTINCT t.target) AS c FROM trx t JOIN fl ON t.target = fl.id
       GROUP BY t.source)
SELECT coalesce(rr.id, ss.id) AS id, CAST(rr.c AS DOUBLE) AS n_partners_received_stage_2,
       CAST(ss.c AS DOUBLE) AS n_partners_sent_stage_2
FROM rr FULL OUTER JOIN ss ON rr.id = ss.id"""


LOG_COLUMNS = [
    "start_balance", "n_transactions", "n_transactions_received", "n_transactions_sent",
    "n_bonuses", "n_partners", "n_partners_stage_2", "n_partners_received",
    "n_partners_received_stage_2", "n_partners_sent", "n_partners_sent_stage_2",
    "days_before_first_trx", "count_received_intensity", "count_sent_intensity",
    "count_intensity",
]
LOG_RATIOS = [
    ("n_partners_ratio_log", "n_partners_received_log", "n_partners_sent_log"),
    ("n_transactions_ratio_log", "n_transactions_received_log", "n_transactions_sent_log"),
    ("count_intensity_ratio_log", "count_received_intensity_log", "count_sent_intensity_log"),
    ("n_partners_stage_2_ratio_log", "n_partners_received_stage_2_log",
     "n_partners_sent_stage_2_log"),
]
AMOUNTS = {
    "amount_received_intensity":
        "coalesce(CAST(amount_received AS DOUBLE) / nullif(days_from_registr, 0), 0)",
    "amount_sent_intensity":
        "coalesce(CAST(amount_sent AS DOUBLE) / nullif(days_from_registr, 0), 0)",
    "amount_intensity":
        "coalesce(CAST(amount_sent + amount_received AS DOUBLE) / nullif(days_from_registr, 0), 0)",
    "balance_growth":
        "coalesce(start_balance + CAST(amount_received AS DOUBLE) - CAST(amount_sent AS DOUBLE), 0)",
    "amount_penalties": "coalesce(CAST(amount_penalties AS DOUBLE), 0)",
    "amount_bonuses": "coalesce(CAST(amount_bonuses AS DOUBLE), 0)",
    "amount_total": "coalesce(CAST(amount_sent + amount_received AS DOUBLE), 0)",
    "amount_sent": "coalesce(CAST(amount_sent AS DOUBLE), 0)",
    "amount_received": "coalesce(CAST(amount_received AS DOUBLE), 0)",
}
KEPT_BASE = ["days_past_last_trxs", "is_stage_2", "stage_2_partners_share", "avg_time_between_trxs"]


def _logs_ctes() -> str:
    logs = ",\n  ".join(f"CASE WHEN {c} > 0 THEN ln({c}) ELSE 0 END AS {c}_log" for c in LOG_COLUMNS)
    ratios = ",\n  ".join(f"coalesce({a} / nullif({b}, 0), 0) AS {n}" for n, a, b in LOG_RATIOS)
    return f"""lg0 AS (SELECT p2.*,
  {logs} FROM p2),
lg AS (SELECT lg0.*,
  {ratios} FROM lg0)"""


def _scaled_ctes(bounds_from: str = "am", clamp: bool = False) -> str:
    """CTEs from ``lg`` to ``fin``: amounts, min-max bounds of ``bounds_from``, scaled logs."""
    vals = ",\n  ".join(f"{e} AS v_{c}" for c, e in AMOUNTS.items())
    bounds = ", ".join(f"min(v_{c}) AS lo_{c}, max(v_{c}) AS hi_{c}" for c in AMOUNTS)
    share = "least(greatest((v_{c} - lo_{c}) / (hi_{c} - lo_{c}), 0), 1)" if clamp else "(v_{c} - lo_{c}) / (hi_{c} - lo_{c})"
    scaled = ",\n  ".join(
        f"CASE WHEN hi_{c} > lo_{c} THEN ln({share.format(c=c)} + 1e-6) ELSE 0 END AS {c}_log" for c in AMOUNTS)
    return f"""am AS (SELECT lg.*,
  {vals} FROM lg),
mm AS (SELECT {bounds} FROM {bounds_from}),
sc AS (SELECT am.*,
  {scaled} FROM am, mm),
fin AS (SELECT sc.*,
  coalesce(amount_sent_log / nullif(amount_received_log, 0), 0) AS amount_sent_receive_logratio
  FROM sc)"""


MODEL_NUMERIC = (KEPT_BASE + [c + "_log" for c in LOG_COLUMNS] + [r[0] for r in LOG_RATIOS]
                 + [c + "_log" for c in AMOUNTS] + ["amount_sent_receive_logratio"])
MODEL_DOUBLES = set(MODEL_NUMERIC) - {"days_past_last_trxs", "is_stage_2"}


def model_features_sql(population: str = "all", labelled: bool = True) -> str:
    out = ["id"] + (["inactive"] if labelled else []) + MODEL_NUMERIC
    return f"""WITH {p2_ctes(population, labelled)},
{_logs_ctes()},
{_scaled_ctes()}
SELECT {_rounded(out, MODEL_DOUBLES)} FROM fin"""


def _dummy_lists(fitted_on: str, of: str) -> str:
    """CTEs ending in ``dl``: each id of ``of`` with its dummies fitted on ``fitted_on``, sorted."""
    long = "\n  UNION ALL ".join(f"SELECT id, '{c}' AS column_name, {c} AS value FROM {of}" for c in ONEHOT)
    return f"""{_onehot_ctes(fitted_on)},
own AS ({long}),
dl AS (SELECT own.id, string_agg(own.value, ',' ORDER BY own.value) AS dummies FROM own
       JOIN fit ON fit.column_name = own.column_name AND fit.value = own.value AND fit.kept AND NOT fit.baseline
       GROUP BY own.id)"""


def features_full_sql(population: str, labelled: bool) -> str:
    out = ["id"] + (["inactive"] if labelled else []) + MODEL_NUMERIC
    return f"""WITH {p2_ctes(population, labelled)},
{_logs_ctes()},
{_scaled_ctes()},
{_dummy_lists("p2", "p2")}
SELECT {_rounded(["fin." + c for c in out], {"fin." + c for c in MODEL_DOUBLES}).replace("AS fin.", "AS ")},
       coalesce(dl.dummies, '') AS dummies FROM fin LEFT JOIN dl ON dl.id = fin.id"""


def scoring_features_sql() -> str:
    vals = ",\n  ".join(f"{e} AS v_{c}" for c, e in AMOUNTS.items())
    return f"""WITH tr AS (WITH {p2_ctes("train")} SELECT * FROM p2),
tram AS (SELECT {vals} FROM tr),
{p2_ctes("test", False, "tr")},
{_logs_ctes()},
{_scaled_ctes("tram", clamp=True)},
{_dummy_lists("tr", "p2")}
SELECT {_rounded(["fin." + c for c in ["id", *MODEL_NUMERIC]], {"fin." + c for c in MODEL_DOUBLES}).replace("AS fin.", "AS ")},
       coalesce(dl.dummies, '') AS dummies FROM fin LEFT JOIN dl ON dl.id = fin.id"""


def csv_roundtrip_sql() -> str:
    return f"""WITH {STANDIN}
SELECT id, CASE WHEN id % 7 IN (1, 2) THEN NULL WHEN id % 7 IN (3, 4) THEN 0.0
                ELSE round(start_balance, 6) END AS start_balance,
       strftime(registration_time, '%Y-%m-%d %H:%M:%S') AS registration_time,
       account_type, business_type, area_name, area_type,
       CASE WHEN id % 7 NOT IN (5, 6) THEN gender END AS gender
FROM acct_users"""


def top_k_sql() -> str:
    return f"""WITH {p2_ctes('all')}
SELECT CAST(row_number() OVER (ORDER BY days_past_last_trxs DESC, id) AS INTEGER) AS rank, id, days_past_last_trxs
FROM p2 ORDER BY days_past_last_trxs DESC, id LIMIT 100"""


def accuracy_sql() -> str:
    return f"""WITH {p2_ctes('all')}
SELECT count(*) AS n_rows, round(count(*) FILTER (inactive = is_stage_2) / count(*), 6) AS accuracy FROM p2"""


def label_feature_split_sql() -> str:
    total = " + ".join(MODEL_NUMERIC)
    return f"""WITH {p2_ctes('all')},
{_logs_ctes()},
{_scaled_ctes()}
SELECT id, inactive, {len(MODEL_NUMERIC)} AS n_features, round({total}, 4) AS total FROM fin"""


_POINTS = {"model_search": [("logistic_net", 20)],
           "model_accuracy": [("logistic", 3), ("logistic_l1", 3), ("logistic_net", 3), ("logistic_none", 1),
                              ("svm", 1), ("gbt", 1), ("mlp", 1)]}


def search_sql(query: str) -> str:
    """What must hold for every point of a search: as many rows as the training population has,
    3 folds, convergence, a loss that has come down, a score in range."""
    points = " UNION ALL ".join(f"SELECT '{family}' AS family, unnest(range({n})) AS point" for family, n in _POINTS[query])
    return f"""SELECT family, point, (SELECT count(*) FROM customer WHERE c_custkey % 5 <> 0) AS n_rows, 3 AS folds,
       true AS converged, true AS descending, true AS score_in_range FROM ({points})"""


def pca_projection_sql() -> str:
    """Rows of the training population and its dormant accounts; the identities hold for every component."""
    return f"""WITH {p2_ctes('train')}
SELECT component, n_rows, n_stage_2, true AS ratio_is_share_of_variance, true AS uncorrelated_with_others
FROM (SELECT count(*) AS n_rows, CAST(sum(is_stage_2) AS BIGINT) AS n_stage_2 FROM p2),
     (SELECT unnest([1, 2, 3]) AS component)"""


def forest_checks_sql() -> str:
    return """WITH t AS (SELECT count(*) AS n FROM customer WHERE c_custkey % 5 = 0)
SELECT 'scores_in_range' AS "check", n, true AS ok FROM t
UNION ALL SELECT 'top_distinct_and_ordered', least(n, 500), true FROM t
UNION ALL SELECT 'stored_forest_same_top', least(n, 500), true FROM t
UNION ALL SELECT 'importances_sum_to_1', 2, true
UNION ALL SELECT 'classifier_order_of_rows', 25, true
UNION ALL SELECT 'regressor_order_of_rows', 25, true"""


EDA_LOGS = ["start_balance", "n_transactions", "n_bonuses", "n_partners", "n_partners_stage_2",
            "days_before_first_trx", "count_intensity"]


def eda_features_sql() -> str:
    numeric = KEPT_BASE + [c + "_log" for c in EDA_LOGS] + [r[0] for r in LOG_RATIOS]
    out = ["id", "inactive", "area_type", "gender"] + numeric
    doubles = set(numeric) - {"days_past_last_trxs", "is_stage_2"}
    return f"""WITH {p2_ctes('all')},
{_logs_ctes()}
SELECT {_rounded(out, doubles)} FROM lg"""


ONEHOT = ["business_type", "area_name", "area_type", "gender"]


def _onehot_ctes(source: str = "p2") -> str:
    long = "\n  UNION ALL ".join(
        f"SELECT id, '{c}' AS column_name, {c} AS value FROM {source}" for c in ONEHOT)
    return f"""lp AS ({long}),
cnt AS (SELECT column_name, value, count(*) AS n FROM lp WHERE value IS NOT NULL
        GROUP BY column_name, value),
per AS (SELECT column_name, sum(n) AS total, min(n) AS min_n FROM cnt GROUP BY column_name),
least AS (SELECT cnt.column_name, min(cnt.value) AS least_value FROM cnt JOIN per
          ON cnt.column_name = per.column_name AND cnt.n = per.min_n GROUP BY cnt.column_name),
fit AS (SELECT cnt.column_name, cnt.value, cnt.n, cnt.n / per.total AS share,
               cnt.n / per.total > 0.1 AS kept,
               (per.min_n / per.total > 0.1) AND cnt.value = least.least_value AS baseline
        FROM cnt JOIN per ON cnt.column_name = per.column_name
        JOIN least ON cnt.column_name = least.column_name)"""


def onehot_fit_sql() -> str:
    return f"""WITH {p2_ctes('all')},
{_onehot_ctes()}
SELECT column_name, value, n, round(share, 6) AS share, kept, baseline FROM fit"""


def onehot_encode_sql() -> str:
    return f"""WITH {p2_ctes('all')},
{_onehot_ctes()},
dummies AS (SELECT column_name, value FROM fit WHERE kept AND NOT baseline)
SELECT lp.id, d.value AS dummy, CAST(CASE WHEN lp.value = d.value THEN 1 ELSE 0 END AS INTEGER) AS value
FROM lp JOIN dummies d ON lp.column_name = d.column_name"""


P2_INTEGRAL = ["id", "inactive", "n_transactions_sent", "n_transactions_received", "n_penalties",
               "n_bonuses", "n_partners_received", "n_partners_sent", "n_transactions",
               "n_partners", "days_before_first_trx", "days_past_last_trxs", "is_stage_2",
               "n_partners_received_stage_2", "n_partners_sent_stage_2", "n_partners_stage_2"]
P2_STRINGS = ["account_type", "business_type", "area_name", "area_type", "gender"]
P2_NUMERIC = [c for c in P2_COLUMNS if c in P2_INTEGRAL or c in P2_DOUBLES]


def profile_census_sql() -> str:
    n_cols = len(P2_COLUMNS)
    return f"""WITH {p2_ctes('all')}
SELECT count(*) AS n_rows, CAST({n_cols} AS BIGINT) AS n_columns,
       round(count(*) / {n_cols}, 6) AS rows_per_column,
       CAST({len(P2_INTEGRAL)} AS BIGINT) AS n_integer_columns,
       CAST({len(P2_DOUBLES)} AS BIGINT) AS n_float_columns,
       CAST({len(P2_STRINGS)} AS BIGINT) AS n_string_columns
FROM p2"""


def profile_nulls_sql() -> str:
    parts = "\nUNION ALL ".join(
        f"SELECT '{c}' AS column_name, CAST(count(*) - count({c}) AS BIGINT) AS n_null FROM p2"
        for c in P2_COLUMNS)
    return f"WITH {p2_ctes('all')}\n{parts}"


def profile_describe_sql() -> str:
    parts = "\nUNION ALL ".join(
        f"""SELECT '{c}' AS column_name, count(x) AS count, round(avg(x), 6) AS mean,
       round(stddev_samp(x), 6) AS std, round(min(x), 6) AS min,
       round(quantile_cont(x, 0.25), 6) AS q25, round(quantile_cont(x, 0.5), 6) AS q50,
       round(quantile_cont(x, 0.75), 6) AS q75, round(max(x), 6) AS max
FROM (SELECT CAST({c} AS DOUBLE) AS x FROM p2)""" for c in P2_NUMERIC)
    return f"WITH {p2_ctes('all')}\n{parts}"


def profile_uniques_sql() -> str:
    cols = P2_STRINGS + P2_INTEGRAL
    parts = "\nUNION ".join(
        f"SELECT '{c}' AS column_name, CAST({c} AS VARCHAR) AS value FROM p2" for c in cols)
    return f"WITH {p2_ctes('all')}\n{parts}"


def profile_head_sql() -> str:
    return (f"WITH {p2_ctes('all')}\nSELECT {_rounded(P2_COLUMNS, P2_DOUBLES)} "
            f"FROM p2 ORDER BY id LIMIT 5")


def outliers_sql(n_std: float = 3.0) -> str:
    parts = "\nUNION ALL ".join(
        f"""SELECT '{c}' AS column_name,
       CAST(count(*) - count_if(x <= (SELECT avg(CAST({c} AS DOUBLE)) + {n_std} * stddev_samp(CAST({c} AS DOUBLE)) FROM p2)) AS BIGINT) AS count,
       round((count(*) - count_if(x <= (SELECT avg(CAST({c} AS DOUBLE)) + {n_std} * stddev_samp(CAST({c} AS DOUBLE)) FROM p2))) / count(*), 3) AS percentage,
       round(min(CASE WHEN x > (SELECT avg(CAST({c} AS DOUBLE)) + {n_std} * stddev_samp(CAST({c} AS DOUBLE)) FROM p2) THEN x END), 6) AS min
FROM (SELECT CAST({c} AS DOUBLE) AS x FROM p2)""" for c in P2_NUMERIC)
    return f"WITH {p2_ctes('all')}\n{parts}"


def correlation_sql() -> str:
    parts = []
    for a in P2_NUMERIC:
        for b in P2_NUMERIC:
            parts.append(
                f"SELECT '{a}' AS column_a, '{b}' AS column_b, round(covar_samp(xa, xb) / "
                f"nullif(stddev_samp(xa) * stddev_samp(xb), 0), 3) AS corr FROM "
                f"(SELECT CAST({a} AS DOUBLE) AS xa, CAST({b} AS DOUBLE) AS xb FROM p2 "
                f"WHERE {a} IS NOT NULL AND {b} IS NOT NULL)")
    return f"WITH {p2_ctes('all')}\n" + "\nUNION ALL ".join(parts)


EDA_NUMERIC = [
    "start_balance", "n_transactions_sent", "n_transactions_received", "n_transactions",
    "n_penalties", "n_bonuses", "n_partners_received", "n_partners_sent", "n_partners",
    "days_before_first_trx", "days_from_registr", "days_past_last_trxs", "count_intensity",
    "count_sent_intensity", "count_received_intensity", "is_stage_2", "stage_2_partners_share",
    "n_partners_received_stage_2", "n_partners_sent_stage_2", "n_partners_stage_2",
]
EDA_CATEGORICAL = ["inactive", "account_type", "area_name", "business_type"]


def _eda_ctes() -> str:
    cats = ", ".join(f"CAST({c} AS VARCHAR) AS {c}" for c in EDA_CATEGORICAL)
    nums = ", ".join(f"CAST({c} AS DOUBLE) AS {c}" for c in EDA_NUMERIC)
    longs = "\n  UNION ALL ".join(
        f"SELECT '{c}' AS column_name, {c} AS x FROM e WHERE {c} IS NOT NULL" for c in EDA_NUMERIC)
    return f"""{p2_ctes('all')},
e AS (SELECT {cats}, {nums} FROM p2),
lx AS ({longs})"""


def dist_categorical_sql() -> str:
    parts = "\nUNION ALL ".join(
        f"SELECT '{c}' AS column_name, {c} AS value, count(*) AS n FROM e "
        f"WHERE {c} IS NOT NULL GROUP BY {c}" for c in EDA_CATEGORICAL)
    return f"WITH {_eda_ctes()}\n{parts}"


def dist_crosstab_sql() -> str:
    parts = "\nUNION ALL ".join(
        f"SELECT '{a}' AS column_a, {a} AS value_a, '{b}' AS column_b, {b} AS value_b, "
        f"count(*) AS n FROM e GROUP BY {a}, {b}"
        for a in EDA_CATEGORICAL for b in EDA_CATEGORICAL if a != b)
    return f"WITH {_eda_ctes()}\n{parts}"


def dist_density_sql(points: int = 500) -> str:
    return f"""WITH {_eda_ctes()},
st AS (SELECT column_name, count(*) AS n, stddev_samp(x) AS sd, min(x) AS mn, max(x) AS mx
       FROM lx GROUP BY column_name),
st2 AS (SELECT *, sd * pow(CAST(n AS DOUBLE), -0.2) AS h FROM st),
w AS (SELECT column_name, x, count(*) AS w FROM lx GROUP BY column_name, x),
g AS (SELECT CAST(range AS INTEGER) AS i FROM range(0, {points})),
k AS (SELECT w.column_name, g.i, st2.mn + g.i * (st2.mx - st2.mn) / {points} AS gx,
             (st2.mn + g.i * (st2.mx - st2.mn) / {points} - w.x) / st2.h AS z, w.w,
             st2.n * st2.h * sqrt(2 * pi()) AS norm
      FROM w JOIN st2 ON w.column_name = st2.column_name CROSS JOIN g)
SELECT column_name, i, round(max(gx), 6) AS x,
       round(sum(w * exp(-0.5 * z * z)) / nullif(max(norm), 0), 6) AS density
FROM k GROUP BY column_name, i"""


def _box_sql(group_sel: str, group_by: str, source: str) -> str:
    return f"""q AS (SELECT {group_sel} column_name, count(*) AS n, min(x) AS mn, max(x) AS mx,
              quantile_cont(x, 0.25) AS q1, quantile_cont(x, 0.5) AS median,
              quantile_cont(x, 0.75) AS q3 FROM {source} GROUP BY {group_by} column_name),
f AS (SELECT *, q3 - q1 AS iqr, q1 - 1.5 * (q3 - q1) AS lf, q3 + 1.5 * (q3 - q1) AS uf FROM q)
SELECT {group_sel.replace('g.', 'f.') if group_sel else ''} f.column_name, f.n, round(f.mn, 6) AS min,
       round(f.q1, 6) AS q1, round(f.median, 6) AS median, round(f.q3, 6) AS q3,
       round(f.mx, 6) AS max, round(f.iqr, 6) AS iqr, round(f.lf, 6) AS lower_fence,
       round(f.uf, 6) AS upper_fence,
       round(min(CASE WHEN s.x >= f.lf THEN s.x END), 6) AS whisker_low,
       round(max(CASE WHEN s.x <= f.uf THEN s.x END), 6) AS whisker_high,
       CAST(count_if(s.x < f.lf OR s.x > f.uf) AS BIGINT) AS n_outliers
FROM f JOIN {source} s ON s.column_name = f.column_name {{join_extra}}
GROUP BY ALL"""


def dist_box_sql() -> str:
    body = _box_sql("", "", "lx").replace("{join_extra}", "")
    return f"WITH {_eda_ctes()},\n{body}"


def dist_box_by_category_sql() -> str:
    lc = "\n  UNION ALL ".join(
        f"SELECT '{c}' AS category_column, {c} AS category_value, '{m}' AS column_name, {m} AS x "
        f"FROM e WHERE {m} IS NOT NULL"
        for c in EDA_CATEGORICAL for m in EDA_NUMERIC)
    body = _box_sql("category_column, category_value,", "category_column, category_value,", "lc")
    body = body.replace("SELECT  f.column_name", "SELECT f.column_name")
    body = body.replace("{join_extra}", "AND s.category_column = f.category_column "
                                        "AND s.category_value IS NOT DISTINCT FROM f.category_value")
    body = body.replace("SELECT category_column, category_value, f.column_name",
                        "SELECT f.category_column, f.category_value, f.column_name")
    return f"WITH {_eda_ctes()},\nlc AS ({lc}),\n{body}"


def _pairs(cols):
    return [(a, b) for i, a in enumerate(cols) for b in cols[i + 1:]]


def dist_hist2d_sql(bins: int = 20) -> str:
    bounds = ", ".join(f"min({c}) AS mn_{c}, max({c}) AS mx_{c}" for c in EDA_NUMERIC)
    bincols = ", ".join(
        f"CAST(least(coalesce(floor(({c} - mn_{c}) / nullif(mx_{c} - mn_{c}, 0) * {bins}), 0), "
        f"{bins - 1}) AS INTEGER) AS b_{c}" for c in EDA_NUMERIC)
    parts = []
    for a, b in _pairs(EDA_NUMERIC):
        for x, y in ((a, b), (b, a)):
            parts.append(f"SELECT '{x}' AS column_a, '{y}' AS column_b, b_{x} AS bin_a, "
                         f"b_{y} AS bin_b, count(*) AS n FROM eb WHERE {x} IS NOT NULL "
                         f"AND {y} IS NOT NULL GROUP BY b_{x}, b_{y}")
    return f"""WITH {_eda_ctes()},
bd AS (SELECT {bounds} FROM e),
eb AS (SELECT e.*, {bincols} FROM e, bd)
""" + "\nUNION ALL ".join(parts)


def dist_trend_sql() -> str:
    parts = []
    for a in EDA_NUMERIC:
        for b in EDA_NUMERIC:
            if a == b:
                continue
            parts.append(f"SELECT '{a}' AS column_x, '{b}' AS column_y, regr_count({b}, {a}) AS n, "
                         f"round(regr_slope({b}, {a}), 6) AS slope, "
                         f"round(regr_intercept({b}, {a}), 6) AS intercept, "
                         f"round(regr_r2({b}, {a}), 6) AS r2 FROM e")
    return f"WITH {_eda_ctes()}\n" + "\nUNION ALL ".join(parts)


def dummy_correlation_sql() -> str:
    numeric = ["inactive"] + KEPT_BASE + [c + "_log" for c in EDA_LOGS] + [r[0] for r in LOG_RATIOS]
    nums = "\n  UNION ALL ".join(
        f"SELECT id, '{c}' AS var, CAST({c} AS DOUBLE) AS x FROM lg" for c in numeric)
    return f"""WITH {p2_ctes('all')},
{_logs_ctes()},
vals AS (SELECT DISTINCT 'area_type' AS c, area_type AS v FROM lg
         UNION SELECT DISTINCT 'gender' AS c, gender AS v FROM lg),
l AS ({nums}
  UNION ALL SELECT lg.id, vals.c || '_' || vals.v AS var,
         CASE WHEN (vals.c = 'area_type' AND lg.area_type = vals.v)
                OR (vals.c = 'gender' AND lg.gender = vals.v) THEN 1.0 ELSE 0.0 END AS x
  FROM lg CROSS JOIN vals)
SELECT a.var AS column_a, b.var AS column_b,
       round(covar_samp(a.x, b.x) / nullif(stddev_samp(a.x) * stddev_samp(b.x), 0), 3) AS corr
FROM l a JOIN l b ON a.id = b.id
GROUP BY a.var, b.var"""


def oracle_sql() -> dict[str, str]:
    return {
        "base_features": base_features_sql(),
        "account_activity": account_activity_sql(),
        "dormant_neighbours": dormant_neighbours_sql(),
        "model_features": model_features_sql("all", True),
        "test_features": model_features_sql("test", False),
        "model_features_full": features_full_sql("all", True),
        "test_features_full": features_full_sql("test", False),
        "scoring_features": scoring_features_sql(),
        "csv_roundtrip": csv_roundtrip_sql(),
        "top_k_deterministic": top_k_sql(),
        "accuracy_fixed_predictions": accuracy_sql(),
        "label_feature_split": label_feature_split_sql(),
        "forest_checks": forest_checks_sql(),
        "pca_projection": pca_projection_sql(),
        "model_search": search_sql("model_search"),
        "model_accuracy": search_sql("model_accuracy"),
        "eda_features": eda_features_sql(),
        "onehot_fit": onehot_fit_sql(),
        "onehot_encode": onehot_encode_sql(),
        "profile_census": profile_census_sql(),
        "profile_nulls": profile_nulls_sql(),
        "profile_describe": profile_describe_sql(),
        "profile_uniques": profile_uniques_sql(),
        "profile_head": profile_head_sql(),
        "outliers": outliers_sql(),
        "correlation": correlation_sql(),
        "dist_categorical": dist_categorical_sql(),
        "dist_crosstab": dist_crosstab_sql(),
        "dist_density": dist_density_sql(),
        "dist_density_cells": dist_density_sql(),
        "dist_box": dist_box_sql(),
        "dist_hist2d": dist_hist2d_sql(),
        "dist_trend": dist_trend_sql(),
        "dist_box_by_category": dist_box_by_category_sql(),
        "dummy_correlation": dummy_correlation_sql(),
    }
