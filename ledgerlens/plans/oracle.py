"""DuckDB SQL building blocks for the oracle side of every registered query.

The SQL re-states each operator's definition independently of the Spark code:
plain window functions, ``median`` and one-pass aggregates over the same
parquet views.  The fixed values are stated here again, not imported, so that a
wrong one in the package shows.  Floating outputs are rounded to 6 digits on
both sides.
"""

from __future__ import annotations

import datetime as _dt


# ---------------------------------------------------------------------------
# FIXED VALUES (must equal the reference for equal results)
# ---------------------------------------------------------------------------
class C:
    FEATURE_WEIGHTS = {
        "tx_count_total": 0.2,
        "borrow_to_supply_ratio_vol": -0.3,
        "repay_ratio": 0.4,
        "account_age_days": 0.3,
        "days_since_last_tx": -0.2,
        "activity_consistency_stddev": -0.2,
        "avg_ltv_90d": -0.5,
        "min_ltv_alltime": -0.3,
        "liquidation_count_borrower": -0.8,
        "liquidation_count_liquidator": 0.0,
        "time_near_liquidation_pct": -0.6,
        "market_diversity_count": 0.3,
        "comp_earned_estimate_ratio": -0.1,
        "avg_gas_price_relative": 0.1,
        "complex_action_freq": 0.1,
        "anomaly_score": -0.7,
    }
    LIQUIDATION_STEP, LIQUIDATION_CAP = 0.1, 0.5
    GOOD_REPAY_RATIO, GOOD_REPAY_BONUS = 0.9, 0.1
    HIGH_LTV_LIMIT, HIGH_LTV_PENALTY = 0.9, 0.1
    CONSISTENT_AGE_DAYS, CONSISTENT_STDDEV, CONSISTENCY_BONUS = 180, 5, 0.05
    INACTIVE_DAYS, INACTIVE_STEP, INACTIVE_PERIOD_DAYS, INACTIVE_CAP = 90, 0.05, 30, 0.25
    NEUTRAL_ANOMALY = 0.5
    SIGMOID_K, SIGMOID_X0, TOP_N = 1.0, 0.0, 1000
    TIME_WINDOWS = {"lifetime": None, "90d": 90, "30d": 30}
    BAND_HIGH, BAND_MEDIUM = 80, 40
    DEFAULT_AS_OF = _dt.datetime(2024, 4, 15)


EVENT_TYPES = ["Mint", "Redeem", "Borrow", "RepayBorrow", "LiquidateBorrow"]
EVENT_SYNONYMS = {
    "Mint": "Mint",
    "Supply": "Mint",
    "Deposit": "Mint",
    "Redeem": "Redeem",
    "Withdraw": "Redeem",
    "Borrow": "Borrow",
    "Repayborrow": "RepayBorrow",
    "Repay": "RepayBorrow",
    "Repayment": "RepayBorrow",
    "Liquidateborrow": "LiquidateBorrow",
    "Liquidate": "LiquidateBorrow",
}
EVENTS_EVENT_MAP = {"signup": "Mint", "view": "Redeem", "purchase": "Borrow", "click": "RepayBorrow", "error": "LiquidateBorrow"}
# ---------------------------------------------------------------------------

AS_OF_SQL = "TIMESTAMP '" + C.DEFAULT_AS_OF.strftime("%Y-%m-%d %H:%M:%S") + "'"
K = "CAST(json_extract_string(props, '$.k') AS BIGINT)"


def d(x: float) -> str:
    """A DOUBLE literal (DuckDB reads bare decimals as DECIMAL)."""
    return f"CAST({float(x)!r} AS DOUBLE)"


def days(a: str, b: str) -> str:
    return f"((epoch_us({b}) - epoch_us({a})) / 86400e6)"


def ev_case(col: str) -> str:
    parts = " ".join(f"WHEN '{k}' THEN '{v}'" for k, v in EVENTS_EVENT_MAP.items())
    return f"CASE {col} {parts} END"


def account_sql(mode: str, uid: str = "user_id") -> str:
    if mode == "dense":
        return f"CAST({uid} AS VARCHAR)"
    return f"CAST({uid} * 31 + event_id % 31 AS VARCHAR)"


def tx_sql(source: str = "events_sparse") -> str:
    if source in ("events_sparse", "events_dense"):
        mode = source.split("_")[1]
        acct, other = account_sql(mode), account_sql(mode, "(user_id + 1)")
        return f"""SELECT {ev_case('event_type')} AS event_type, ts AS "timestamp",
  CAST(NULL AS BIGINT) AS block_number, CAST(event_id AS VARCHAR) AS transaction_hash,
  {acct} AS account,
  CASE WHEN event_type = 'error' THEN CASE WHEN event_id % 5 = 0 THEN {acct} ELSE {other} END END AS liquidator,
  CAST({K} % 8 AS VARCHAR) AS token, 'c' || CAST({K} % 5 AS VARCHAR) AS ctoken,
  value AS amount, value * (1 + ({K} % 8) / 10) AS amountusd
FROM events"""
    if source == "orders":
        ev = """CASE WHEN l_returnflag = 'N' AND l_linestatus = 'O' THEN 'Mint'
  WHEN l_returnflag = 'R' AND l_linestatus = 'O' THEN 'Mint'
  WHEN l_returnflag = 'N' AND l_linestatus = 'F' THEN 'Redeem'
  WHEN l_returnflag = 'A' AND l_linestatus = 'O' THEN 'Borrow'
  WHEN l_returnflag = 'A' AND l_linestatus = 'F' THEN 'RepayBorrow'
  WHEN l_returnflag = 'R' AND l_linestatus = 'F' AND l_discount >= 0.1 THEN 'LiquidateBorrow'
  ELSE 'Redeem' END"""
        return f"""SELECT {ev} AS event_type, o_orderdate AS "timestamp", CAST(NULL AS BIGINT) AS block_number,
  CAST(l_orderkey AS VARCHAR) || '-' || CAST(l_linenumber AS VARCHAR) AS transaction_hash,
  CAST(o_custkey AS VARCHAR) AS account,
  CASE WHEN ({ev}) = 'LiquidateBorrow' THEN CAST(o_custkey + 1 AS VARCHAR) END AS liquidator,
  CAST(l_partkey % 8 AS VARCHAR) AS token, 'c' || CAST(l_suppkey % 5 AS VARCHAR) AS ctoken,
  l_extendedprice AS amount, l_extendedprice * (1 - l_discount) AS amountusd
FROM lineitem JOIN orders ON l_orderkey = o_orderkey"""
    raise ValueError(source)


def norm_event_sql(x: str) -> str:
    t = f"regexp_replace({x}, '^\\s+|\\s+$', '', 'g')"
    titled = f"(upper(substr({t}, 1, 1)) || lower(substr({t}, 2)))"
    cases = " ".join(f"WHEN '{k}' THEN '{v}'" for k, v in EVENT_SYNONYMS.items())
    return f"COALESCE(CASE {titled} {cases} END, {titled})"


def clean_sql(src: str = "tx") -> str:
    evs = ", ".join(f"'{e}'" for e in EVENT_TYPES)
    return f"""SELECT * FROM (SELECT * REPLACE ({norm_event_sql('event_type')} AS event_type) FROM {src}
  WHERE "timestamp" IS NOT NULL AND account IS NOT NULL AND event_type IS NOT NULL)
WHERE event_type IN ({evs})"""


def activity_sql(src: str = "clean", liquidation_mode: str = "compat") -> str:
    vol = lambda e: f"COALESCE(sum(CASE WHEN event_type = '{e}' THEN amount END), {d(0)})"
    inner = f"""SELECT account AS wallet, min("timestamp") AS first_tx_timestamp, max("timestamp") AS last_tx_timestamp,
  count(*) AS tx_count,
  CAST(count_if(event_type = 'Mint') AS BIGINT) AS mint_count, CAST(count_if(event_type = 'Redeem') AS BIGINT) AS redeem_count,
  CAST(count_if(event_type = 'Borrow') AS BIGINT) AS borrow_count, CAST(count_if(event_type = 'RepayBorrow') AS BIGINT) AS repay_count,
  CAST(count_if(event_type = 'LiquidateBorrow') AS BIGINT) AS liquidation_count,
  {vol('Mint')} AS supply_volume, {vol('Borrow')} AS borrow_volume, {vol('RepayBorrow')} AS repay_volume,
  CAST(count_if(event_type = 'LiquidateBorrow' AND liquidator = account) AS BIGINT) AS self_liq
FROM {src} GROUP BY account"""
    if liquidation_mode == "corrected":
        inner = f"""SELECT g.* REPLACE (COALESCE(p.n, 0) AS self_liq) FROM ({inner}) g LEFT JOIN
  (SELECT liquidator AS wallet, count(*) AS n FROM {src}
   WHERE event_type = 'LiquidateBorrow' AND liquidator IS NOT NULL GROUP BY liquidator) p USING (wallet)"""
    return f"""SELECT a.wallet, first_tx_timestamp, last_tx_timestamp, tx_count,
  {days('first_tx_timestamp', 'last_tx_timestamp')} AS wallet_age_days,
  mint_count, redeem_count, borrow_count, repay_count, liquidation_count,
  COALESCE(m.market_count, 0) AS market_count,
  borrow_count / greatest({d(1)}, CAST(mint_count AS DOUBLE)) AS borrow_to_supply_ratio_count,
  borrow_volume / greatest({d(1)}, supply_volume) AS borrow_to_supply_ratio_vol,
  repay_volume / greatest({d(1)}, borrow_volume) AS repay_ratio,
  liquidation_count AS liquidation_count_borrower,
  self_liq AS liquidation_count_liquidator
FROM ({inner}) a LEFT JOIN (
  SELECT account AS wallet, count(DISTINCT m) AS market_count FROM (
    SELECT account, token AS m FROM {src} UNION ALL SELECT account, ctoken AS m FROM {src}) WHERE m IS NOT NULL
  GROUP BY account) m USING (wallet)"""


def gaps_sql(src: str = "clean") -> str:
    return f"""SELECT account, {days('"timestamp"', 'nxt')} AS gap FROM (
  SELECT account, "timestamp", lead("timestamp") OVER (PARTITION BY account ORDER BY "timestamp") AS nxt
  FROM {src}) WHERE nxt IS NOT NULL"""


def temporal_sql(src: str = "clean", optimize: bool = True) -> str:
    day = d(86_400_000_000)
    below = "(n::DOUBLE * n)" if optimize else "(n::DOUBLE * nullif(n - 1, 0))"
    cv = ", CASE WHEN mean > 0 THEN sd / mean END AS activity_consistency_cv" if optimize else ""
    return f"""SELECT wallet, mean AS avg_time_between_tx_days, longest / {day} AS max_time_between_tx_days,
  shortest / {day} AS min_time_between_tx_days, sd AS activity_consistency_stddev{cv}
FROM (SELECT wallet, s::DOUBLE / n / {day} AS mean, longest, shortest,
    sqrt((q::HUGEINT * n - s::HUGEINT * s)::DOUBLE / {below}) / {day} AS sd
  FROM (SELECT account AS wallet, count(*) AS n, sum(us) AS s, sum(us::HUGEINT * us) AS q, max(us) AS longest,
      min(us) AS shortest
    FROM (SELECT account, epoch_us(nxt) - epoch_us("timestamp") AS us FROM (
      SELECT account, "timestamp", lead("timestamp") OVER (PARTITION BY account ORDER BY "timestamp") AS nxt
      FROM {src}) WHERE nxt IS NOT NULL) GROUP BY account))"""


TEMPORAL = ["avg_time_between_tx_days", "max_time_between_tx_days", "min_time_between_tx_days",
            "activity_consistency_stddev", "activity_consistency_cv"]


def features_ctes(source: str = "events_sparse", optimize: bool = True,
                  liquidation_mode: str = "compat", cutoff: str | None = None, as_of: str | None = None) -> str:
    """CTEs tx, clean, act, temporal, rawf, med, feat (imputed features).
    ``cutoff`` keeps history strictly before it; ``as_of`` is the clock."""
    temporal = TEMPORAL if optimize else TEMPORAL[:4]
    meds = ", ".join(f"median({c}) AS m_{c}" for c in temporal)
    repl = ", ".join(f"COALESCE({c}, m_{c}, {d(0)}) AS {c}" for c in temporal)
    tcols = ", ".join(f"t.{c}" for c in temporal)
    clean = clean_sql("tx") + (f' AND "timestamp" < {cutoff}' if cutoff else "")
    clock = as_of or AS_OF_SQL
    return f"""tx AS ({tx_sql(source)}),
clean AS ({clean}),
act AS ({activity_sql('clean', liquidation_mode)}),
temporal AS ({temporal_sql('clean', optimize)}),
rawf AS (SELECT a.*, {days('a.last_tx_timestamp', clock)} AS days_since_last_tx, {tcols}
  FROM act a LEFT JOIN temporal t USING (wallet)),
med AS (SELECT {meds} FROM rawf),
feat AS (SELECT rawf.* REPLACE ({repl}) FROM rawf CROSS JOIN med)"""


def available(cols, weights=None) -> dict:
    w = weights if weights is not None else C.FEATURE_WEIGHTS
    return {f: float(x) for f, x in w.items() if f in cols}


FEATURE_COLS = ["wallet", "first_tx_timestamp", "last_tx_timestamp", "tx_count", "wallet_age_days",
                "mint_count", "redeem_count", "borrow_count", "repay_count", "liquidation_count",
                "market_count", "borrow_to_supply_ratio_count", "borrow_to_supply_ratio_vol", "repay_ratio",
                "liquidation_count_borrower", "liquidation_count_liquidator", "days_since_last_tx"] + TEMPORAL


def contrib_sql(f: str, w: float, optimize: bool = True) -> str:
    x, lo, hi = f"CAST({f} AS DOUBLE)", f"mn_{f}", f"mx_{f}"
    norm = f"(({x} - {lo}) / ({hi} - {lo}))"
    if w < 0:
        norm = f"({d(1)} - {norm})"
    if optimize:
        return f"CASE WHEN {hi} > {lo} THEN {norm} * {d(abs(w))} END"
    half = d(0.5) if w >= 0 else f"({d(1)} - {d(0.5)})"
    return (f"CASE WHEN {x} IS NULL THEN NULL WHEN {hi} > {lo} THEN {norm} * {d(abs(w))} "
            f"ELSE {half} * {d(abs(w))} END")


def scoring_ctes(cols, src: str = "sc0", optimize: bool = True, weights=None) -> str:
    """CTEs st (stats), contrib (c_<f> columns), weighted (raw_score before rules)."""
    w = available(cols, weights)
    stats = ", ".join(f"CAST(min({f}) AS DOUBLE) AS mn_{f}, CAST(max({f}) AS DOUBLE) AS mx_{f}" for f in w)
    cs = ", ".join(f"{contrib_sql(f, x, optimize)} AS c_{f}" for f, x in w.items())
    total = f"{d(0)}" + "".join(f" + COALESCE(c_{f}, {d(0)})" for f in w)
    sum_w = sum(abs(x) for x in w.values())
    raw = f"({total}) / {d(sum_w)}" if sum_w > 0 else total
    return f"""st AS (SELECT {stats} FROM {src}),
contrib AS (SELECT {src}.*, {cs} FROM {src} CROSS JOIN st),
weighted AS (SELECT *, {raw} AS raw_score FROM contrib)"""


def adjust_ctes(cols, src: str = "weighted", optimize: bool = True) -> str:
    """CTEs adj1..adjN applying the rules in order; last CTE is ``adjusted``
    with columns a_<rule> holding each applied adjustment (or NULL)."""
    cols = set(cols)
    steps = []
    if "liquidation_count_borrower" in cols:
        pen = f"least(liquidation_count_borrower * {d(C.LIQUIDATION_STEP)}, {d(C.LIQUIDATION_CAP)})"
        cond = "liquidation_count_borrower > 0"
        steps.append(("liquidation_penalty", cond, f"raw_score * ({d(1)} - {pen})", f"-{pen}"))
    if {"repay_ratio", "liquidation_count_borrower"} <= cols:
        cond = f"repay_ratio > {d(C.GOOD_REPAY_RATIO)} AND liquidation_count_borrower = 0"
        steps.append(("good_repayer_bonus", cond, f"raw_score * {d(1.0 + C.GOOD_REPAY_BONUS)}",
                      d(C.GOOD_REPAY_BONUS)))
    if "max_ltv_alltime" in cols:
        cond = f"max_ltv_alltime > {d(C.HIGH_LTV_LIMIT)}"
        steps.append(("high_ltv_penalty", cond, f"raw_score * {d(1.0 - C.HIGH_LTV_PENALTY)}",
                      d(-C.HIGH_LTV_PENALTY)))
    if optimize and {"account_age_days", "activity_consistency_stddev"} <= cols:
        cond = (f"account_age_days > {C.CONSISTENT_AGE_DAYS} AND "
                f"activity_consistency_stddev < {C.CONSISTENT_STDDEV}")
        steps.append(("consistency_bonus", cond, f"raw_score * {d(1.0 + C.CONSISTENCY_BONUS)}",
                      d(C.CONSISTENCY_BONUS)))
    if optimize and "days_since_last_tx" in cols:
        pen = (f"least({d(C.INACTIVE_STEP)} * (days_since_last_tx / {C.INACTIVE_PERIOD_DAYS}), "
               f"{d(C.INACTIVE_CAP)})")
        cond = f"days_since_last_tx > {C.INACTIVE_DAYS}"
        steps.append(("inactivity_penalty", cond, f"raw_score * ({d(1)} - {pen})", f"-{pen}"))
    ctes, prev = [], src
    for i, (name, cond, newraw, val) in enumerate(steps):
        cte = "adjusted" if i == len(steps) - 1 else f"adj{i}"
        ctes.append(f"""{cte} AS (SELECT * REPLACE (CASE WHEN {cond} THEN {newraw} ELSE raw_score END AS raw_score),
  CASE WHEN {cond} THEN {val} END AS a_{name} FROM {prev})""")
        prev = cte
    if not steps:
        ctes.append(f"adjusted AS (SELECT * FROM {src})")
    return ",\n".join(ctes)


def percentile_sql(src: str, reverse: bool = True) -> str:
    order = "ASC" if reverse else "DESC"
    pct = f"rank() OVER (ORDER BY raw_score {order}) / count(*) OVER () * 100"
    return f"SELECT *, least(100, greatest(0, CAST(round_even({pct}, 0) AS INTEGER))) AS final_score FROM {src}"


def pipeline_ctes(source: str = "events_sparse", optimize: bool = True, method: str = "percentile",
                  cutoff: str | None = None, as_of: str | None = None) -> str:
    """All CTEs through ``fin`` (final scores) with constant anomaly 0.5."""
    cols = FEATURE_COLS if optimize else [c for c in FEATURE_COLS if c != "activity_consistency_cv"]
    cols = cols + ["anomaly_score"]
    fin = {"percentile": percentile_sql("adjusted"),
           "min_max": minmax_sql("adjusted"),
           "sigmoid": sigmoid_sql("adjusted")}[method]
    return f"""{features_ctes(source, optimize, cutoff=cutoff, as_of=as_of)},
sc0 AS (SELECT *, {d(C.NEUTRAL_ANOMALY)} AS anomaly_score FROM feat),
{scoring_ctes(cols, 'sc0', optimize)},
{adjust_ctes(cols, 'weighted', optimize)},
fin AS ({fin})"""


def minmax_sql(src: str, reverse: bool = True) -> str:
    norm = "(raw_score - mn) / (mx - mn)"
    v = f"{d(100)} * ({d(1)} - {norm})" if reverse else f"{d(100)} * {norm}"
    return f"""SELECT s.*, least(100, greatest(0, CAST(round_even(CASE WHEN mx > mn THEN {v} ELSE {d(50)} END, 0) AS INTEGER)))
  AS final_score FROM {src} s CROSS JOIN (SELECT min(raw_score) AS mn, max(raw_score) AS mx FROM {src}) m"""


def sigmoid_sql(src: str, reverse: bool = True, k: float = C.SIGMOID_K, x0: float = C.SIGMOID_X0) -> str:
    sig = f"({d(1)} / ({d(1)} + exp({d(-k)} * (raw_score - {d(x0)}))))"
    v = f"{d(100)} * ({d(1)} - {sig})" if reverse else f"{d(100)} * {sig}"
    return f"SELECT *, least(100, greatest(0, CAST(round_even({v}, 0) AS INTEGER))) AS final_score FROM {src}"


def with_ctes(ctes: str, select: str) -> str:
    return f"WITH {ctes}\n{select}"


def r6(cols) -> str:
    """Projection list rounding each column to 6 digits."""
    return ", ".join(f"round({c}, 6) AS {c}" for c in cols)


def rule_applies(rule: str, cols, optimize: bool = True) -> bool:
    cols = set(cols)
    need = {"liquidation_penalty": {"liquidation_count_borrower"},
            "good_repayer_bonus": {"repay_ratio", "liquidation_count_borrower"},
            "high_ltv_penalty": {"max_ltv_alltime"},
            "consistency_bonus": {"account_age_days", "activity_consistency_stddev"},
            "inactivity_penalty": {"days_since_last_tx"}}[rule]
    if not optimize and rule in ("consistency_bonus", "inactivity_penalty"):
        return False
    return need <= cols


def count_filter(sql: str) -> str:
    """Rewrite ``count_if(x)`` as ``(count(*) FILTER (WHERE x))``: DuckDB's
    count_if yields NULL when every condition is NULL, a count yields 0."""
    out, i = [], 0
    while True:
        j = sql.find("count_if(", i)
        if j < 0:
            out.append(sql[i:])
            return "".join(out)
        out.append(sql[i:j])
        k, depth = j + len("count_if("), 1
        while depth:
            depth += {"(": 1, ")": -1}.get(sql[k], 0)
            k += 1
        out.append(f"(count(*) FILTER (WHERE {sql[j + len('count_if('):k - 1]}))")
        i = k
