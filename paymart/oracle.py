"""Independent SQL statement of every registered query, for DuckDB.

The correctness check runs each Spark query and the SQL here over the same
parquet tables (registered as views named after the tables) and compares the
results.  The SQL re-states the warehouse rules directly (window
``row_number`` for deduplication and keys, joins and CASE for the SCD
merges), so it shares no code path with the Spark jobs.

Each named CTE is a function returning SQL text; ``_with`` collects the CTEs
a query needs, in dependency order.  Money leaves every query as DOUBLE (on
the Spark side too), averages and rates use the same exact HALF_UP rule.
"""

from __future__ import annotations

from paymart.schemas import RAW_COLUMNS
from paymart.sources.fixtures import DAY1, DAY2, DAY3, UPDATES_DATE

# ---------------------------------------------------------------------------
# expression helpers
# ---------------------------------------------------------------------------


def _initcap(x: str) -> str:
    return (
        f"array_to_string(list_transform(string_split(lower({x}), ' '), "
        f"lambda s: upper(substr(s, 1, 1)) || substr(s, 2)), ' ')"
    )


def _to_int(x: str) -> str:
    return f"TRY_CAST(trunc(TRY_CAST({x} AS DECIMAL(38,18))) AS INTEGER)"


def _dec(x: str) -> str:
    return f"TRY_CAST({x} AS DECIMAL(10,2))"


def _hash(cols: list[str], null_safe: bool = False) -> str:
    parts = [f"CAST({c} AS VARCHAR)" for c in cols]
    if null_safe:
        parts = [f"coalesce({p}, '\\N')" for p in parts]
    return f"md5(concat_ws('|', {', '.join(parts)}))"


def _key_order(nk: str) -> str:
    return f"substr(md5({nk}), 1, 4), {nk}"


def _avg(sum_sql: str, n_sql: str) -> str:
    return f"CAST((2 * CAST({sum_sql} * 100 AS HUGEINT) + {n_sql}) // (2 * {n_sql}) AS DOUBLE) / 100.0"


def _pct(flag_sql: str, n_sql: str) -> str:
    return f"CAST((2 * CAST({flag_sql} AS HUGEINT) * 10000 + {n_sql}) // (2 * {n_sql}) AS DOUBLE) / 100.0"


def _stamp(day: str) -> str:
    return f"'{day} 00:00:00'"


def _audit(source: str, day: str) -> str:
    return f"{_stamp(day)} AS load_timestamp, '{source}.csv' AS source_file, '{day}' AS load_date"


def _pick(idx: str, values: list[str]) -> str:
    arms = " ".join(f"WHEN {i} THEN '{v}'" for i, v in enumerate(values))
    return f"CASE {idx} {arms} END"


# Fixed values mirrored from the fixture rules.
KYC_RAW = [" basic", "Full", "PREMIUM "]
SEGMENTS = ["automobile", "building", "furniture", "household", "machinery"]
PM_CODES = [" upi", "wallet", "CARD_DEBIT", "netbanking ", "bnpl"]
PM_NAMES = ["UPI", "Wallet", "Debit Card", " Net Banking", "Buy Now Pay Later "]
PM_TYPES = ["instant", "INSTANT", "Instant ", "deferred", " DEFERRED"]
TXN_CODES = [" upi", "Wallet ", "CARD_DEBIT", "netbanking", "BNPL"]

CUSTOMER_TRACKED = ["kyc_tier", "wallet_limit", "customer_segment", "city", "state"]
MERCHANT_TRACKED = ["merchant_name", "category", "sub_category", "city", "state", "is_active"]
PAYMENT_TRACKED = ["method_name", "method_type", "is_active"]

SILVER_CUSTOMER_COLS = [
    "customer_id", "full_name", "email", "phone", "city", "state", "kyc_tier",
    "wallet_limit", "customer_segment", "created_date", "is_active",
    "load_timestamp", "source_file", "load_date", "silver_loaded_at",
]
DIM_CUSTOMER_VALUES = [
    "customer_id", "full_name", "email", "phone", "city", "state", "kyc_tier",
    "wallet_limit", "customer_segment", "created_date", "is_active", "record_hash",
]
DIM_MERCHANT_VALUES = [
    "merchant_id", "merchant_name", "category", "sub_category", "city", "state",
    "is_active", "onboarded_date", "record_hash", "updated_at",
]
DIM_PAYMENT_VALUES = [
    "method_id", "method_code", "method_name", "method_type", "is_active",
    "record_hash", "updated_at",
]

# ---------------------------------------------------------------------------
# CTE library: name -> (dependencies, body)
# ---------------------------------------------------------------------------

CTES: dict[str, tuple[list[str], str]] = {}


def cte(name: str, deps: list[str], body: str) -> None:
    CTES[name] = (deps, body)


def _customer_rows(updates: bool) -> str:
    k = "c.c_custkey"
    if updates:
        kyc = _pick(f"({k} + 1) % 3", KYC_RAW)
        wallet = f"CAST(CAST(floor(abs(c.c_acctbal)) AS INTEGER) + 1000 AS VARCHAR)"
        arms = " ".join(
            f"WHEN '{s}' THEN '{SEGMENTS[(i + 1) % len(SEGMENTS)]}'" for i, s in enumerate(SEGMENTS)
        )
        seg = f"CASE lower(c.c_mktsegment) {arms} ELSE '{SEGMENTS[0]}' END"
        cid = f"'CUST-' || printf('%06d', {k})"
        extra = f", '{UPDATES_DATE}' AS updated_date"
    else:
        kyc = _pick(f"{k} % 3", KYC_RAW)
        wallet = (
            f"CASE WHEN {k} % 43 = 0 THEN 'n/a' WHEN {k} % 47 = 0 THEN '12500.5' "
            f"ELSE CAST(CAST(floor(abs(c.c_acctbal)) AS INTEGER) AS VARCHAR) END"
        )
        seg = f"CASE WHEN {k} % 53 = 0 THEN NULL ELSE lower(c.c_mktsegment) END"
        cid = f"CASE WHEN {k} = 5 THEN NULL ELSE 'CUST-' || printf('%06d', {k}) END"
        extra = ""
    return f"""
        SELECT {cid} AS customer_id,
               '  ' || c.c_name || ' ' AS full_name,
               ' USER' || CAST({k} AS VARCHAR) || '@EXAMPLE.COM' AS email,
               '555-' || printf('%07d', {k}) AS phone,
               CASE WHEN {k} % 37 = 0 THEN NULL ELSE ' new ' || lower(n.n_name) END AS city,
               CASE WHEN {k} % 41 = 0 THEN NULL ELSE lower(substr(r.r_name, 1, 2)) || ' ' END AS state,
               {kyc} AS kyc_tier,
               {wallet} AS wallet_limit,
               {seg} AS customer_segment,
               CAST(make_date(CAST(1995 + {k} % 3 AS INTEGER), CAST(1 + {k} % 12 AS INTEGER),
                              CAST(1 + {k} % 28 AS INTEGER)) AS VARCHAR) AS created_date{extra}
        FROM customer c
        JOIN nation n ON c.c_nationkey = n.n_nationkey
        JOIN region r ON n.n_regionkey = r.r_regionkey"""


cte("raw_customers_0", [], _customer_rows(False))
cte("raw_customers_1", [], _customer_rows(False) + " WHERE c.c_custkey % 11 <> 0")
cte("raw_customers_2", [], _customer_rows(False) + " WHERE c.c_custkey % 23 <> 0")
cte("raw_customer_updates", [], _customer_rows(True) + " WHERE c.c_custkey % 7 = 0")


def _merchant_rows(snapshot: int) -> str:
    k = "s_suppkey"
    even = f"({k} - {k} % 2)"
    cat = f"CASE WHEN {even} % 6 = 0 THEN 'food' WHEN {even} % 6 = 2 THEN 'Retail ' ELSE 'TRAVEL' END"
    if snapshot == 2:
        cat = f"CASE WHEN {k} % 5 = 0 THEN 'health' ELSE {cat} END"
    where = "TRUE" if snapshot == 0 else f"{k} % 13 <> 0" if snapshot == 1 else f"{k} % 11 <> 0"
    return f"""
        SELECT 'MERCH-' || printf('%04d', {k}) AS merchant_id,
               ' Merchant ' || CAST({even} AS VARCHAR) AS merchant_name,
               {cat} AS category,
               'sub_' || CAST({k} % 3 AS VARCHAR) AS sub_category,
               'city ' || CAST({even} % 5 AS VARCHAR) AS city,
               CASE WHEN {k} % 19 = 0 THEN NULL ELSE 'mh' END AS state,
               CASE WHEN {k} % 20 = 0 THEN '0' WHEN {k} % 17 = 1 THEN NULL ELSE '1' END AS is_active,
               CAST(make_date(1994, CAST(1 + {k} % 12 AS INTEGER), CAST(1 + {k} % 28 AS INTEGER)) AS VARCHAR)
                   AS onboarded_date
        FROM supplier WHERE {where}"""


cte("raw_merchants_0", [], _merchant_rows(0))
cte("raw_merchants_1", [], _merchant_rows(1))
cte("raw_merchants_2", [], _merchant_rows(2))


def _payment_rows(snapshot: int) -> str:
    mtype = _pick("p - 1", PM_TYPES)
    active = "CASE WHEN p = 5 THEN NULL ELSE '1' END"
    where = "WHERE p <> 5" if snapshot == 1 else ""
    if snapshot == 2:
        active = f"CASE WHEN p = 4 THEN '0' ELSE {active} END"
        mtype = f"CASE WHEN p = 2 THEN 'Deferred' ELSE {mtype} END"
    return f"""
        SELECT 'PM-' || printf('%03d', p) AS method_id,
               {_pick('p - 1', PM_CODES)} AS method_code,
               {_pick('p - 1', PM_NAMES)} AS method_name,
               {mtype} AS method_type,
               {active} AS is_active
        FROM (SELECT CAST(substr(o_orderpriority, 1, 1) AS INTEGER) AS p, count(*) AS n_orders
              FROM orders GROUP BY 1) pri {where}"""


cte("raw_payment_methods_1", [], _payment_rows(1))
cte("raw_payment_methods_2", [], _payment_rows(2))

_PRICE = "CAST(l_extendedprice AS DECIMAL(10,2))"
def _raw_transactions(where: str = "TRUE") -> str:
    return f"""
    SELECT 'TXN-' || CAST(l_orderkey AS VARCHAR) || '-' || CAST(l_linenumber AS VARCHAR) AS transaction_id,
           CASE WHEN l_partkey % 109 = 0 THEN NULL ELSE 'CUST-' || printf('%06d', o_custkey) END AS customer_id,
           'MERCH-' || printf('%04d', l_suppkey) AS merchant_id,
           CASE WHEN l_partkey % 127 = 0 THEN 'CRYPTO'
                ELSE {_pick('CAST(substr(o_orderpriority, 1, 1) AS INTEGER) - 1', TXN_CODES)} END AS method_code,
           CASE WHEN l_partkey % 113 = 0 THEN NULL ELSE CAST(CAST(l_shipdate AS DATE) AS VARCHAR) END AS txn_date,
           CASE WHEN l_partkey % 101 = 0 THEN 'bad'
                WHEN l_partkey % 103 = 0 THEN NULL
                WHEN l_partkey % 107 = 0 THEN '-' || CAST({_PRICE} AS VARCHAR)
                ELSE CAST({_PRICE} AS VARCHAR) END AS txn_amount,
           CAST(CAST({_PRICE} * CAST(l_tax AS DECIMAL(4,2)) AS DECIMAL(10,2)) AS VARCHAR) AS platform_fee,
           CAST(CAST({_PRICE} * CAST(l_discount AS DECIMAL(4,2)) AS DECIMAL(10,2)) AS VARCHAR) AS cashback_amount,
           CASE WHEN l_partkey % 97 = 0 THEN 'REVERSED'
                WHEN l_returnflag = 'N' AND l_linenumber % 2 = 0 THEN ' success '
                WHEN l_returnflag = 'N' THEN 'SUCCESS'
                WHEN l_returnflag = 'R' THEN 'failed'
                WHEN l_returnflag = 'A' THEN 'PENDING' END AS txn_status,
           CASE WHEN l_returnflag = 'R' THEN CASE WHEN l_linestatus = 'F' THEN 'timeout' ELSE 'BANK_DECLINED ' END
                END AS failure_reason,
           CASE WHEN l_quantity >= 49 THEN '1' ELSE '0' END AS is_fraud_flag
    FROM lineitem JOIN orders ON l_orderkey = o_orderkey WHERE {where}"""


# The feed, and its two parts with rows in common.
cte("raw_transactions", [], _raw_transactions())
_AS_TEXT = [f"coalesce({c}, '')" for c in RAW_COLUMNS["transactions"]]
cte("feed_lines", ["raw_transactions"],
    f"SELECT *, {' || chr(44) || '.join(_AS_TEXT)} AS whole, {' || chr(44) || '.join(_AS_TEXT[:6])} AS cut, length(whole) % 10 AS kind FROM raw_transactions")
cte("raw_transactions_a", [], _raw_transactions("l_partkey % 3 <> 2"))
cte("raw_transactions_b", [], _raw_transactions("l_partkey % 3 <> 0"))


# ---- silver ----------------------------------------------------------------


def _silver_customers(raw: str, day: str) -> str:
    rest = [c for c in SILVER_CUSTOMER_COLS if c not in ("customer_id", "silver_loaded_at")]
    order = ", ".join(f"{c} ASC NULLS LAST" for c in rest)
    return f"""
    SELECT {', '.join(SILVER_CUSTOMER_COLS[:-1])}, {_stamp(day)} AS silver_loaded_at
    FROM (SELECT *, row_number() OVER (PARTITION BY customer_id ORDER BY {order}) AS rn
          FROM (SELECT customer_id, trim(full_name) AS full_name, trim(lower(email)) AS email, phone,
                       coalesce(trim({_initcap('city')}), 'UNKNOWN') AS city,
                       coalesce(trim(upper(state)), 'UNKNOWN') AS state,
                       trim(upper(kyc_tier)) AS kyc_tier,
                       {_to_int('wallet_limit')} AS wallet_limit,
                       coalesce(trim(upper(customer_segment)), 'UNKNOWN') AS customer_segment,
                       TRY_CAST(created_date AS DATE) AS created_date,
                       1 AS is_active, {_audit('customers', day)}
                FROM {raw} WHERE customer_id IS NOT NULL) t) d
    WHERE rn = 1"""


cte("silver_customers_0", ["raw_customers_0"], _silver_customers("raw_customers_0", DAY1))
cte("silver_customers_1", ["raw_customers_1"], _silver_customers("raw_customers_1", DAY1))
cte("silver_customers_2_base", ["raw_customers_2"], _silver_customers("raw_customers_2", DAY2))
cte(
    "customer_updates",
    ["raw_customer_updates"],
    f"""
    SELECT customer_id, trim(upper(kyc_tier)) AS kyc_tier, {_to_int('wallet_limit')} AS wallet_limit,
           trim(upper(customer_segment)) AS customer_segment, trim({_initcap('city')}) AS city,
           trim(upper(state)) AS state
    FROM raw_customer_updates WHERE customer_id IS NOT NULL""",
)
_UPD = ["kyc_tier", "wallet_limit", "customer_segment", "city", "state"]
cte(
    "silver_customers_2",
    ["silver_customers_2_base", "customer_updates"],
    "SELECT "
    + ", ".join(
        f"CASE WHEN u.customer_id IS NOT NULL THEN u.{c} ELSE c.{c} END AS {c}" if c in _UPD
        else (f"CASE WHEN u.customer_id IS NOT NULL THEN {_stamp(DAY2)} ELSE c.silver_loaded_at END AS {c}"
              if c == "silver_loaded_at" else f"c.{c}")
        for c in SILVER_CUSTOMER_COLS
    )
    + " FROM silver_customers_2_base c LEFT JOIN customer_updates u ON c.customer_id = u.customer_id",
)


def _silver_merchants(raw: str, day: str) -> str:
    cols = ["merchant_name", "category", "sub_category", "city", "state", "is_active", "onboarded_date",
            "load_timestamp", "source_file", "load_date"]
    order = ", ".join(f"{c} ASC NULLS LAST" for c in cols)
    return f"""
    SELECT merchant_id, {', '.join(cols)}, {_stamp(day)} AS silver_loaded_at
    FROM (SELECT *, row_number() OVER (PARTITION BY merchant_id ORDER BY {order}) AS rn
          FROM (SELECT merchant_id, trim(merchant_name) AS merchant_name, trim(upper(category)) AS category,
                       trim(upper(sub_category)) AS sub_category,
                       coalesce(trim({_initcap('city')}), 'UNKNOWN') AS city,
                       coalesce(trim(upper(state)), 'UNKNOWN') AS state,
                       coalesce({_to_int('is_active')}, 1) AS is_active,
                       TRY_CAST(onboarded_date AS DATE) AS onboarded_date, {_audit('merchants', day)}
                FROM {raw} WHERE merchant_id IS NOT NULL) t) d
    WHERE rn = 1"""


cte("silver_merchants_0", ["raw_merchants_0"], _silver_merchants("raw_merchants_0", DAY1))
cte("silver_merchants_1", ["raw_merchants_1"], _silver_merchants("raw_merchants_1", DAY1))
cte("silver_merchants_2", ["raw_merchants_2"], _silver_merchants("raw_merchants_2", DAY2))


def _silver_payments(raw: str, day: str) -> str:
    cols = ["method_code", "method_name", "method_type", "is_active", "load_timestamp", "source_file", "load_date"]
    order = ", ".join(f"{c} ASC NULLS LAST" for c in cols)
    return f"""
    SELECT method_id, {', '.join(cols)}, {_stamp(day)} AS silver_loaded_at
    FROM (SELECT *, row_number() OVER (PARTITION BY method_id ORDER BY {order}) AS rn
          FROM (SELECT method_id, trim(upper(method_code)) AS method_code, trim(method_name) AS method_name,
                       trim(upper(method_type)) AS method_type, {_to_int('is_active')} AS is_active,
                       {_audit('payment_methods', day)}
                FROM {raw} WHERE method_id IS NOT NULL) t) d
    WHERE rn = 1"""


cte("silver_payment_methods_1", ["raw_payment_methods_1"], _silver_payments("raw_payment_methods_1", DAY1))
cte("silver_payment_methods_2", ["raw_payment_methods_2"], _silver_payments("raw_payment_methods_2", DAY2))

def _typed_transactions(raw: str) -> str:
    return f"""
    SELECT transaction_id, customer_id, merchant_id, trim(upper(method_code)) AS method_code,
           TRY_CAST(txn_date AS DATE) AS txn_date,
           {_dec('txn_amount')} AS txn_amount_typed,
           coalesce({_dec('txn_amount')}, CAST(0 AS DECIMAL(10,2))) AS txn_amount,
           coalesce({_dec('platform_fee')}, CAST(0 AS DECIMAL(10,2))) AS platform_fee,
           coalesce({_dec('cashback_amount')}, CAST(0 AS DECIMAL(10,2))) AS cashback_amount,
           trim(upper(txn_status)) AS txn_status, trim(upper(failure_reason)) AS failure_reason,
           coalesce({_to_int('is_fraud_flag')}, 0) AS is_fraud_flag
    FROM {raw}"""


def _valid_transactions(typed: str) -> str:
    return f"""
    SELECT transaction_id, customer_id, merchant_id, method_code, txn_date, txn_amount, platform_fee,
           cashback_amount, txn_status, failure_reason, is_fraud_flag,
           platform_fee - cashback_amount AS net_revenue,
           CAST(year(txn_date) AS INTEGER) AS txn_year, CAST(month(txn_date) AS INTEGER) AS txn_month
    FROM {typed}
    WHERE transaction_id IS NOT NULL AND customer_id IS NOT NULL AND merchant_id IS NOT NULL
      AND txn_amount >= 0 AND txn_status IN ('SUCCESS', 'FAILED', 'PENDING')"""


def _silver_transactions(valid: str, day: str) -> str:
    return f"""
    SELECT transaction_id, customer_id, merchant_id, method_code, txn_date, txn_amount, platform_fee,
           cashback_amount, txn_status, failure_reason, is_fraud_flag, net_revenue, txn_year, txn_month,
           {_audit('transactions', day)}, {_stamp(day)} AS silver_loaded_at
    FROM (SELECT *, row_number() OVER (
                PARTITION BY transaction_id
                ORDER BY txn_date DESC NULLS LAST, txn_amount DESC NULLS LAST,
                         customer_id ASC NULLS LAST, merchant_id ASC NULLS LAST, method_code ASC NULLS LAST,
                         platform_fee ASC NULLS LAST, cashback_amount ASC NULLS LAST,
                         txn_status ASC NULLS LAST, failure_reason ASC NULLS LAST,
                         is_fraud_flag ASC NULLS LAST) AS rn
          FROM {valid}) d
    WHERE rn = 1"""


for _part in ("", "_a", "_b"):
    cte(f"typed_transactions{_part}", [f"raw_transactions{_part}"], _typed_transactions(f"raw_transactions{_part}"))
    cte(f"valid_transactions{_part}", [f"typed_transactions{_part}"], _valid_transactions(f"typed_transactions{_part}"))
cte("silver_transactions", ["valid_transactions"], _silver_transactions("valid_transactions", DAY2))
cte("silver_transactions_a", ["valid_transactions_a"], _silver_transactions("valid_transactions_a", DAY2))
cte(
    "silver_transactions_b",
    ["valid_transactions_b", "silver_transactions_a"],
    f"SELECT * FROM ({_silver_transactions('valid_transactions_b', DAY3)}) b "
    "WHERE NOT EXISTS (SELECT 1 FROM silver_transactions_a a WHERE a.transaction_id = b.transaction_id)",
)


# ---- calendar --------------------------------------------------------------


def _calendar(days_sql: str) -> str:
    return f"""
    SELECT d AS full_date,
           CAST(strftime(d, '%Y%m%d') AS INTEGER) AS date_key,
           CAST(year(d) AS INTEGER) AS year,
           CAST(quarter(d) AS INTEGER) AS quarter,
           CAST(month(d) AS INTEGER) AS month,
           strftime(d, '%B') AS month_name,
           CAST(weekofyear(d) AS INTEGER) AS week_of_year,
           CAST(dayofweek(d) + 1 AS INTEGER) AS day_of_week,
           strftime(d, '%A') AS day_name,
           CASE WHEN dayofweek(d) IN (0, 6) THEN 1 ELSE 0 END AS is_weekend,
           CAST(CASE WHEN month(d) >= 4 THEN year(d) ELSE year(d) - 1 END AS INTEGER) AS fiscal_year,
           CASE WHEN month(d) IN (4, 5, 6) THEN 1 WHEN month(d) IN (7, 8, 9) THEN 2
                WHEN month(d) IN (10, 11, 12) THEN 3 ELSE 4 END AS fiscal_quarter
    FROM ({days_sql}) days"""


cte(
    "dim_date",
    ["silver_transactions"],
    _calendar(
        "SELECT CAST(unnest(generate_series(make_date(year(min(txn_date)), 1, 1), "
        "make_date(year(max(txn_date)), 12, 31), INTERVAL 1 DAY)) AS DATE) AS d "
        "FROM silver_transactions HAVING min(txn_date) IS NOT NULL"
    ),
)

# ---- SCD1 --------------------------------------------------------------------


def _scd1_initial(src: str, nk: str, key: str, tracked: list[str], values: list[str], day: str) -> str:
    cols = []
    for c in values:
        if c == "record_hash":
            cols.append(f"{_hash(tracked)} AS record_hash")
        elif c == "updated_at":
            cols.append(f"{_stamp(day)} AS updated_at")
        else:
            cols.append(c)
    return f"SELECT row_number() OVER (ORDER BY {_key_order(nk)}) AS {key}, {', '.join(cols)} FROM {src}"


def _scd1_merge(old: str, src: str, nk: str, key: str, tracked: list[str], values: list[str], day: str) -> str:
    s_cols = []
    for c in values:
        if c == "record_hash":
            s_cols.append(f"{_hash(tracked)} AS record_hash")
        elif c == "updated_at":
            s_cols.append(f"{_stamp(day)} AS updated_at")
        else:
            s_cols.append(c)
    s = f"(SELECT {', '.join(s_cols)} FROM {src})"
    upd = set(tracked) | {"record_hash", "updated_at"}
    changed = f"s.{nk} IS NOT NULL AND o.record_hash IS DISTINCT FROM s.record_hash"
    kept = ", ".join(
        f"CASE WHEN {changed} THEN s.{c} ELSE o.{c} END AS {c}" if c in upd else f"o.{c}" for c in values
    )
    return f"""
    SELECT o.{key}, {kept} FROM {old} o LEFT JOIN {s} s ON o.{nk} = s.{nk}
    UNION ALL
    SELECT coalesce((SELECT max({key}) FROM {old}), 0)
           + row_number() OVER (ORDER BY {_key_order(nk)}) AS {key}, {', '.join(values)}
    FROM {s} s WHERE NOT EXISTS (SELECT 1 FROM {old} o WHERE o.{nk} = s.{nk})"""


_M = ("merchant_id", "merchant_key", MERCHANT_TRACKED, DIM_MERCHANT_VALUES)
_P = ("method_id", "payment_method_key", PAYMENT_TRACKED, DIM_PAYMENT_VALUES)
cte("dim_merchant_1", ["silver_merchants_1"], _scd1_initial("silver_merchants_1", *_M, DAY1))
cte("dim_merchant", ["dim_merchant_1", "silver_merchants_2"], _scd1_merge("dim_merchant_1", "silver_merchants_2", *_M, DAY2))
cte("dim_merchant_rerun", ["dim_merchant", "silver_merchants_2"], _scd1_merge("dim_merchant", "silver_merchants_2", *_M, DAY2))
cte("dim_payment_1", ["silver_payment_methods_1"], _scd1_initial("silver_payment_methods_1", *_P, DAY1))
cte("dim_payment", ["dim_payment_1", "silver_payment_methods_2"],
    _scd1_merge("dim_payment_1", "silver_payment_methods_2", *_P, DAY2))

# ---- SCD2 --------------------------------------------------------------------

_VC = DIM_CUSTOMER_VALUES
_CUST_OUT = ["customer_key", *_VC, "effective_start", "effective_end", "is_current"]

cte(
    "dim_customer_1",
    ["silver_customers_1"],
    f"""
    SELECT row_number() OVER (ORDER BY {_key_order('customer_id')}) AS customer_key,
           {', '.join(c if c != 'record_hash' else _hash(CUSTOMER_TRACKED) + ' AS record_hash' for c in _VC)},
           coalesce(created_date, DATE '{DAY1}') AS effective_start,
           CAST(NULL AS DATE) AS effective_end, 1 AS is_current
    FROM silver_customers_1""",
)


def _scd2_joined(img: str, src: str, day: str) -> str:
    s_cols = ", ".join(
        f"{_hash(CUSTOMER_TRACKED)} AS s_record_hash" if c == "record_hash" else f"{c} AS s_{c}" for c in _VC
    )
    return f"""
    SELECT t.*, s.*,
           CASE WHEN t.customer_id IS NULL THEN 'new'
                WHEN s.s_customer_id IS NULL THEN 'missing'
                WHEN t.record_hash IS NOT DISTINCT FROM s.s_record_hash THEN 'unchanged'
                ELSE 'changed' END AS cls,
           coalesce(t.customer_id IS NOT NULL AND s.s_customer_id IS NOT NULL
                    AND t.record_hash IS DISTINCT FROM s.s_record_hash
                    AND t.effective_start >= DATE '{day}', FALSE) AS in_place
    FROM (SELECT * FROM {img} WHERE is_current = 1) t
    FULL OUTER JOIN (SELECT {s_cols} FROM {src}) s ON t.customer_id = s.s_customer_id"""


def _scd2_parts(prefix: str, img: str, src: str, day: str) -> None:
    j = f"{prefix}_joined"
    cte(j, [img, src], _scd2_joined(img, src, day))
    tcols = ", ".join(_CUST_OUT)
    cte(f"{prefix}_keep", [j], f"SELECT {tcols} FROM {j} WHERE cls IN ('missing', 'unchanged')")
    expired_cols = []
    for c in _CUST_OUT:
        if c == "effective_end":
            expired_cols.append(f"CAST(DATE '{day}' - INTERVAL 1 DAY AS DATE) AS effective_end")
        elif c == "is_current":
            expired_cols.append("0 AS is_current")
        else:
            expired_cols.append(c)
    cte(f"{prefix}_expired", [j],
        f"SELECT {', '.join(expired_cols)} FROM {j} WHERE cls = 'changed' AND NOT in_place")
    cte(
        f"{prefix}_replaced",
        [j],
        "SELECT customer_key, " + ", ".join(f"s_{c} AS {c}" for c in _VC)
        + ", effective_start, CAST(NULL AS DATE) AS effective_end, 1 AS is_current"
        + f" FROM {j} WHERE in_place",
    )
    cte(
        f"{prefix}_inserts",
        [j, img],
        f"""
        SELECT coalesce((SELECT max(customer_key) FROM {img}), 0)
               + row_number() OVER (ORDER BY {_key_order('customer_id')}) AS customer_key,
               {', '.join(_VC)}, effective_start, effective_end, is_current
        FROM (SELECT {', '.join(f's_{c} AS {c}' for c in _VC)},
                     CASE WHEN cls = 'new' THEN coalesce(s_created_date, DATE '{day}') ELSE DATE '{day}' END
                         AS effective_start,
                     CAST(NULL AS DATE) AS effective_end, 1 AS is_current
              FROM {j} WHERE cls = 'new' OR (cls = 'changed' AND NOT in_place)) n""",
    )
    cte(
        f"{prefix}_merged",
        [img, f"{prefix}_keep", f"{prefix}_expired", f"{prefix}_replaced", f"{prefix}_inserts"],
        f"""
        SELECT {tcols} FROM {img} WHERE is_current = 0
        UNION ALL SELECT {tcols} FROM {prefix}_keep
        UNION ALL SELECT {tcols} FROM {prefix}_expired
        UNION ALL SELECT {tcols} FROM {prefix}_replaced
        UNION ALL SELECT {tcols} FROM {prefix}_inserts""",
    )


_scd2_parts("scd2", "dim_customer_1", "silver_customers_2", DAY2)
cte("dim_customer", ["scd2_merged"], "SELECT * FROM scd2_merged")
_scd2_parts("scd2_rerun", "dim_customer", "silver_customers_2", DAY2)
# Day 3 lands the first snapshot again: tiers that day 2 changed go back, their versions close.
_scd2_parts("scd2_third", "dim_customer", "silver_customers_1", DAY3)

# ---- fact ----------------------------------------------------------------------



def _fact(txn: str, day: str, payments: str = "dim_payment", customers: str = "dim_customer", merchants: str = "dim_merchant") -> str:
    return f"""
    SELECT c.customer_key, m.merchant_key, p.payment_method_key,
           CAST(strftime(t.txn_date, '%Y%m%d') AS INTEGER) AS date_key,
           t.transaction_id, t.txn_date, t.txn_status, t.failure_reason, t.method_code, t.txn_amount,
           t.platform_fee, t.cashback_amount, t.net_revenue, t.is_fraud_flag, t.txn_year, t.txn_month,
           {_stamp(day)} AS created_at, t.customer_id, t.merchant_id
    FROM {txn} t
    LEFT JOIN {merchants} m ON t.merchant_id = m.merchant_id
    LEFT JOIN {payments} p ON t.method_code = p.method_code
    LEFT JOIN {customers} c ON t.customer_id = c.customer_id AND t.txn_date >= c.effective_start
                             AND (c.effective_end IS NULL OR t.txn_date <= c.effective_end)"""


_DIMS = ["dim_merchant", "dim_payment", "dim_customer"]
cte("fact", ["silver_transactions", *_DIMS], _fact("silver_transactions", DAY2))
cte("fact_a", ["silver_transactions_a", *_DIMS], _fact("silver_transactions_a", DAY2))
cte("fact_b", ["silver_transactions_b", *_DIMS], _fact("silver_transactions_b", DAY3))
cte("fact_b_third", ["silver_transactions_b", "scd2_third_merged", *_DIMS], _fact("silver_transactions_b", DAY3, customers="scd2_third_merged"))
cte("fact_third", ["fact_a", "fact_b_third"], "SELECT * FROM fact_a UNION ALL SELECT * FROM fact_b_third")
# Late customers without a creation date start on the day they arrive.
cte(
    "dim_customer_late",
    ["dim_customer_1"],
    f"SELECT * REPLACE (CASE WHEN created_date IS NULL AND CAST(regexp_extract(customer_id, '[0-9]+$') AS INTEGER) % 3 = 0 "
    f"THEN DATE '{DAY3}' ELSE effective_start END AS effective_start) FROM dim_customer_1",
)
# Two methods with one code, and the lookup that takes the smaller method id.
cte(
    "dim_payment_shared",
    ["dim_payment"],
    "SELECT method_id, payment_method_key, CASE WHEN method_id = 'PM-002' THEN 'UPI' ELSE method_code END AS method_code FROM dim_payment",
)
cte(
    "payment_lookup_shared",
    ["dim_payment_shared"],
    "SELECT method_code, arg_min(payment_method_key, method_id) AS payment_method_key FROM dim_payment_shared "
    "WHERE method_code IS NOT NULL GROUP BY method_code",
)
cte("fact_shared", ["silver_transactions", "payment_lookup_shared", *_DIMS], _fact("silver_transactions", DAY2, "payment_lookup_shared"))
cte("short_dim_date", [], _calendar("SELECT CAST(unnest(generate_series(DATE '1992-01-01', DATE '1996-12-31', INTERVAL 1 DAY)) AS DATE) AS d"))

FACT_OUT = [
    "customer_key", "merchant_key", "payment_method_key", "date_key", "transaction_id", "txn_date",
    "txn_status", "failure_reason", "method_code", "txn_amount", "platform_fee", "cashback_amount",
    "net_revenue", "is_fraud_flag", "txn_year", "txn_month", "created_at",
]


# ---------------------------------------------------------------------------
# assembling statements
# ---------------------------------------------------------------------------


def _with(final: str, needs: list[str]) -> str:
    order: list[str] = []

    def visit(n: str) -> None:
        if n in order:
            return
        for d in CTES[n][0]:
            visit(d)
        order.append(n)

    for n in needs:
        visit(n)
    if not order:
        return final
    body = ",\n".join(f"{n} AS ({CTES[n][1]}\n)" for n in order)
    return f"WITH {body}\n{final}"


def _select_money(table: str, cols: list[str], money: list[str]) -> str:
    return "SELECT " + ", ".join(f"CAST({c} AS DOUBLE) AS {c}" if c in money else c for c in cols) + f" FROM {table}"


_SILVER_TXN_COLS = [
    "transaction_id", "customer_id", "merchant_id", "method_code", "txn_date", "txn_amount",
    "platform_fee", "cashback_amount", "txn_status", "failure_reason", "is_fraud_flag",
    "net_revenue", "txn_year", "txn_month", "load_timestamp", "source_file", "load_date",
    "silver_loaded_at",
]
_MONEY = ["txn_amount", "platform_fee", "cashback_amount", "net_revenue"]


def _layer_counts_sql() -> str:
    parts = [
        ("bronze", "raw_customers", "raw_customers_2"),
        ("bronze", "raw_customer_updates", "raw_customer_updates"),
        ("bronze", "raw_merchants", "raw_merchants_2"),
        ("bronze", "raw_payment_methods", "raw_payment_methods_2"),
        ("bronze", "raw_transactions", "raw_transactions"),
        ("silver", "customers", "silver_customers_2"),
        ("silver", "merchants", "silver_merchants_2"),
        ("silver", "payment_methods", "silver_payment_methods_2"),
        ("silver", "transactions", "silver_transactions"),
        ("gold", "dim_customer", "dim_customer"),
        ("gold", "dim_merchant", "dim_merchant"),
        ("gold", "dim_payment_method", "dim_payment"),
        ("gold", "dim_date", "dim_date"),
        ("gold", "fact_transaction", "fact"),
    ]
    sql = "\nUNION ALL ".join(
        f"SELECT '{layer}' AS layer, '{name}' AS table_name, count(*) AS row_count FROM {src}"
        for layer, name, src in parts
    )
    return _with(sql, [p[2] for p in parts])


_DQ_REJECTS = """
        SELECT count(*) AS rows_in,
               count(*) FILTER (WHERE nk) AS null_key_rejects,
               count(*) FILTER (WHERE NOT nk AND neg) AS negative_amount_rejects,
               count(*) FILTER (WHERE NOT nk AND NOT neg AND NOT ok_status) AS invalid_status_rejects,
               count(*) FILTER (WHERE NOT nk AND NOT neg AND ok_status) AS rows_valid,
               count(DISTINCT CASE WHEN NOT nk AND NOT neg AND ok_status THEN transaction_id END)
                   AS distinct_valid_ids,
               count(*) FILTER (WHERE txn_amount_typed IS NULL) AS amount_defaulted
        FROM (SELECT *, (transaction_id IS NULL OR customer_id IS NULL OR merchant_id IS NULL) AS nk,
                     txn_amount < 0 AS neg,
                     coalesce(txn_status IN ('SUCCESS', 'FAILED', 'PENDING'), FALSE) AS ok_status
              FROM typed_transactions) t"""


def oracle_sql() -> dict[str, str]:
    q: dict[str, str] = {}
    q["bronze_ingest"] = _with(f"SELECT *, {_audit('transactions', DAY2)} FROM raw_transactions", ["raw_transactions"])
    q["bronze_stream"] = q["bronze_ingest"]
    q["bronze_roundtrip"] = _with(
        f"SELECT *, {_audit('transactions', DAY1)} FROM raw_transactions "
        f"UNION ALL SELECT *, {_audit('transactions', DAY2)} FROM raw_transactions",
        ["raw_transactions"],
    )
    q["cast_int"] = _with(
        f"SELECT customer_id, wallet_limit AS wallet_limit_text, {_to_int('wallet_limit')} AS wallet_limit "
        "FROM raw_customers_0",
        ["raw_customers_0"],
    )
    q["cast_decimal"] = _with(
        "SELECT transaction_id, txn_amount AS txn_amount_text, "
        f"CAST({_dec('txn_amount')} AS DOUBLE) AS txn_amount, CAST({_dec('platform_fee')} AS DOUBLE) AS platform_fee, "
        f"CAST({_dec('cashback_amount')} AS DOUBLE) AS cashback_amount FROM raw_transactions",
        ["raw_transactions"],
    )
    q["cast_date"] = _with(
        "SELECT transaction_id, txn_date AS txn_date_text, TRY_CAST(txn_date AS DATE) AS txn_date FROM raw_transactions",
        ["raw_transactions"],
    )
    q["clean_strings"] = _with(
        f"SELECT customer_id, trim(full_name) AS full_name, trim(lower(email)) AS email, "
        f"trim({_initcap('city')}) AS city, trim(upper(state)) AS state, trim(upper(kyc_tier)) AS kyc_tier, "
        f"trim(upper(customer_segment)) AS customer_segment FROM raw_customers_0",
        ["raw_customers_0"],
    )
    q["fill_defaults"] = _with(
        f"SELECT merchant_id, coalesce(trim({_initcap('city')}), 'UNKNOWN') AS city, "
        f"coalesce(trim(upper(state)), 'UNKNOWN') AS state, coalesce({_to_int('is_active')}, 1) AS is_active "
        "FROM raw_merchants_0",
        ["raw_merchants_0"],
    )
    q["fill_measures"] = _with(
        "SELECT transaction_id, CAST(txn_amount AS DOUBLE) AS txn_amount, CAST(platform_fee AS DOUBLE) AS platform_fee, "
        "CAST(cashback_amount AS DOUBLE) AS cashback_amount, is_fraud_flag FROM typed_transactions",
        ["typed_transactions"],
    )
    q["drop_null_keys"] = _with(
        "SELECT transaction_id, customer_id, merchant_id FROM typed_transactions "
        "WHERE transaction_id IS NOT NULL AND customer_id IS NOT NULL AND merchant_id IS NOT NULL",
        ["typed_transactions"],
    )
    q["valid_transactions"] = _with(
        "SELECT transaction_id, CAST(txn_amount AS DOUBLE) AS txn_amount, txn_status FROM valid_transactions",
        ["valid_transactions"],
    )
    q["dedupe_latest"] = _with(
        "SELECT transaction_id, txn_date, CAST(txn_amount AS DOUBLE) AS txn_amount, customer_id, merchant_id, "
        "txn_status FROM silver_transactions",
        ["silver_transactions"],
    )
    q["net_revenue"] = _with(
        "SELECT transaction_id, CAST(platform_fee AS DOUBLE) AS platform_fee, "
        "CAST(cashback_amount AS DOUBLE) AS cashback_amount, CAST(net_revenue AS DOUBLE) AS net_revenue, "
        "txn_year, txn_month FROM silver_transactions",
        ["silver_transactions"],
    )
    q["silver_customers"] = _with("SELECT * FROM silver_customers_0", ["silver_customers_0"])
    q["silver_merchants"] = _with("SELECT * FROM silver_merchants_0", ["silver_merchants_0"])
    q["silver_payment_methods"] = _with("SELECT * FROM silver_payment_methods_2", ["silver_payment_methods_2"])
    q["silver_transactions"] = _with(_select_money("silver_transactions", _SILVER_TXN_COLS, _MONEY),
                                     ["silver_transactions"])
    q["merge_update_only"] = _with("SELECT * FROM silver_customers_2", ["silver_customers_2"])
    q["dq_rejects"] = _with(_DQ_REJECTS, ["typed_transactions"])
    q["dq_rejects_dims"] = _with(
        "\nUNION ALL ".join(
            f"SELECT '{t}' AS table_name, count(*) AS rows_in, count(*) FILTER (WHERE {k} IS NULL) AS null_key_rejects, "
            f"count({k}) - count(DISTINCT {k}) AS duplicate_rejects, count(DISTINCT {k}) AS rows_out FROM {src}"
            for t, k, src in [("customers", "customer_id", "raw_customers_0"),
                              ("merchants", "merchant_id", "raw_merchants_0"),
                              ("payment_methods", "method_id", "raw_payment_methods_2")]
        ),
        ["raw_customers_0", "raw_merchants_0", "raw_payment_methods_2"],
    )
    q["update_matches"] = _with(
        """
        SELECT CAST(sum(n) AS BIGINT) AS update_rows, count(*) AS distinct_ids,
               count(*) FILTER (WHERE hit) AS matched_customers,
               count(*) FILTER (WHERE NOT hit) AS unmatched_ids,
               count(*) FILTER (WHERE n > 1) AS ids_with_several_updates
        FROM (SELECT u.customer_id, count(*) AS n,
                     bool_or(c.customer_id IS NOT NULL) AS hit
              FROM raw_customer_updates u
              LEFT JOIN (SELECT DISTINCT customer_id FROM silver_customers_0) c ON u.customer_id = c.customer_id
              WHERE u.customer_id IS NOT NULL
              GROUP BY u.customer_id) t""",
        ["raw_customer_updates", "silver_customers_0"],
    )
    q["dim_date"] = _with("SELECT * FROM dim_date", ["dim_date"])
    q["fiscal_calendar"] = _with("SELECT full_date, fiscal_year, fiscal_quarter FROM dim_date", ["dim_date"])
    q["date_key"] = _with(
        "SELECT transaction_id, txn_date, CAST(strftime(txn_date, '%Y%m%d') AS INTEGER) AS date_key "
        "FROM silver_transactions",
        ["silver_transactions"],
    )
    q["record_hash"] = _with(
        f"SELECT merchant_id, {_hash(MERCHANT_TRACKED)} AS record_hash, "
        f"{_hash(MERCHANT_TRACKED, null_safe=True)} AS record_hash_null_safe FROM silver_merchants_0",
        ["silver_merchants_0"],
    )
    q["surrogate_key"] = _with(
        f"SELECT customer_id, row_number() OVER (ORDER BY {_key_order('customer_id')}) AS customer_key "
        "FROM silver_customers_0",
        ["silver_customers_0"],
    )
    q["scd1_initial"] = _with("SELECT * FROM dim_merchant_1", ["dim_merchant_1"])
    q["scd1_merge"] = _with("SELECT * FROM dim_merchant", ["dim_merchant"])
    q["scd1_merge_payment"] = _with("SELECT * FROM dim_payment", ["dim_payment"])
    q["scd1_rerun_noop"] = _with("SELECT * FROM dim_merchant_rerun", ["dim_merchant_rerun"])
    q["scd2_initial"] = _with("SELECT * FROM dim_customer_1", ["dim_customer_1"])
    q["scd2_classify"] = _with(
        "SELECT coalesce(customer_id, s_customer_id) AS customer_id, cls AS change_class FROM scd2_joined",
        ["scd2_joined"],
    )
    q["scd2_changed"] = _with(
        "SELECT " + ", ".join(f"s_{c} AS {c}" for c in _VC) + " FROM scd2_joined WHERE cls = 'changed'",
        ["scd2_joined"],
    )
    q["scd2_new"] = _with(
        "SELECT " + ", ".join(f"s_{c} AS {c}" for c in _VC) + " FROM scd2_joined WHERE cls = 'new'",
        ["scd2_joined"],
    )
    q["scd2_expire"] = _with("SELECT * FROM scd2_expired", ["scd2_expired"])
    q["scd2_inserts"] = _with("SELECT * FROM scd2_inserts", ["scd2_inserts"])
    q["scd2_merge"] = _with("SELECT * FROM dim_customer", ["dim_customer"])
    q["scd2_counts"] = _with(
        "SELECT count(*) AS total_rows, count(*) FILTER (WHERE is_current = 1) AS current_rows, "
        "count(*) FILTER (WHERE is_current <> 1) AS historical_rows FROM dim_customer",
        ["dim_customer"],
    )
    q["scd2_rerun_noop"] = _with("SELECT * FROM scd2_rerun_merged", ["scd2_rerun_merged"])
    q["join_dim_date"] = _with(
        "SELECT t.transaction_id, t.date_key, d.year, d.month, d.month_name, d.fiscal_year, d.fiscal_quarter "
        "FROM (SELECT transaction_id, CAST(strftime(txn_date, '%Y%m%d') AS INTEGER) AS date_key "
        "      FROM silver_transactions) t LEFT JOIN dim_date d ON t.date_key = d.date_key",
        ["silver_transactions", "dim_date"],
    )
    q["join_dim_merchant"] = _with("SELECT transaction_id, merchant_id, merchant_key FROM fact", ["fact"])
    q["join_dim_payment"] = _with("SELECT transaction_id, method_code, payment_method_key FROM fact", ["fact"])
    q["point_in_time_join"] = _with("SELECT transaction_id, customer_id, txn_date, customer_key FROM fact", ["fact"])
    q["as_of_join_salted"] = q["as_of_join_ordered"] = q["point_in_time_join"]
    # the planted rules of the audit query, then neighbours by lag
    q["scd2_audit"] = _with(
        """
        SELECT customer_id, customer_key, effective_start, effective_end, previous_end, fault
        FROM (SELECT *, unnest([
                  CASE WHEN follows AND (previous_end IS NULL OR effective_start <= previous_end) THEN 'overlap' END,
                  CASE WHEN follows AND effective_start > previous_end + 1 THEN 'gap' END,
                  CASE WHEN follows AND customer_key <= previous_key THEN 'key_order' END,
                  CASE WHEN effective_end < effective_start THEN 'reversed' END,
                  CASE WHEN (effective_end IS NULL) <> (is_current = 1) THEN 'open_flag' END]) AS fault
              FROM (SELECT *, row_number() OVER w > 1 AS follows, lag(effective_end) OVER w AS previous_end,
                           lag(customer_key) OVER w AS previous_key
                    FROM (SELECT customer_id, CASE WHEN customer_key % 7 = 0 THEN -customer_key ELSE customer_key END AS customer_key,
                                 effective_start,
                                 CASE customer_key % 5 WHEN 0 THEN effective_end - 3 WHEN 1 THEN effective_end + 4
                                      ELSE effective_end END AS effective_end,
                                 CASE WHEN customer_key % 11 = 0 THEN 1 - is_current ELSE is_current END AS is_current
                          FROM dim_customer) p
                    WINDOW w AS (PARTITION BY customer_id ORDER BY effective_start, customer_key)) l) f
        WHERE fault IS NOT NULL""",
        ["dim_customer"],
    )
    q["fact_transaction"] = _with(_select_money("fact", FACT_OUT, _MONEY), ["fact"])
    q["fact_partition_roundtrip"] = q["fact_transaction"]
    def quality(cal: str) -> str:
        return f"""
        SELECT count(*) AS total_rows,
               count(*) FILTER (WHERE customer_key IS NULL) AS null_customer_key,
               count(*) FILTER (WHERE merchant_key IS NULL) AS null_merchant_key,
               count(*) FILTER (WHERE payment_method_key IS NULL) AS null_payment_method_key,
               count(*) FILTER (WHERE date_key IS NULL) AS null_date_key,
               count(*) FILTER (WHERE date_key IS NOT NULL
                                AND date_key NOT IN (SELECT date_key FROM {cal})) AS date_key_not_in_calendar,
               count(DISTINCT transaction_id) AS distinct_transactions
        FROM fact"""

    q["fact_quality"] = _with(quality("dim_date"), ["fact", "dim_date"])
    q["fact_quality_short_calendar"] = _with(quality("short_dim_date"), ["fact", "short_dim_date"])
    q["fact_shared_method_code"] = _with(_select_money("fact_shared", FACT_OUT, _MONEY), ["fact_shared"])
    q["payment_code_conflicts"] = _with(
        "SELECT method_code, count(*) AS methods FROM dim_payment_shared WHERE method_code IS NOT NULL GROUP BY method_code HAVING count(*) > 1",
        ["dim_payment_shared"],
    )
    q["fact_spread_joins"] = q["fact_transaction"]
    q["bronze_stream_then_batch"] = q["bronze_roundtrip"]
    q["bronze_reordered_header"] = q["bronze_ingest"]
    q["pipeline_fact"] = q["fact_transaction"]
    q["pipeline_dim_customer"] = q["pipeline_rerun_day"] = q["pipeline_reopen"] = q["scd2_merge"]
    q["pipeline_dim_payment"] = q["scd1_merge_payment"]
    q["pipeline_silver_customers"] = q["merge_update_only"]
    q["pipeline_silver_merchants"] = _with("SELECT * FROM silver_merchants_2", ["silver_merchants_2"])
    profiles = _with(f"SELECT * FROM ({_DQ_REJECTS}) a, ({quality('dim_date')}) b", ["typed_transactions", "fact", "dim_date"])
    q["pipeline_quality"] = profiles
    q["fact_two_days"] = _with(
        f"{_select_money('fact_a', FACT_OUT, _MONEY)} UNION ALL {_select_money('fact_b', FACT_OUT, _MONEY)}", ["fact_a", "fact_b"]
    )

    def by_ids(fact: str) -> str:
        return (
            f"SELECT f.transaction_id, f.txn_date, CAST(f.txn_amount AS DOUBLE) AS txn_amount, CAST(f.net_revenue AS DOUBLE) AS net_revenue,"
            f" f.created_at, c.customer_id, c.effective_start, c.effective_end, c.is_current, c.kyc_tier, m.merchant_id, m.category,"
            f" m.updated_at, p.method_id, p.method_name FROM {fact} f LEFT JOIN dim_customer c ON c.customer_key = f.customer_key"
            f" LEFT JOIN dim_merchant m ON m.merchant_key = f.merchant_key"
            f" LEFT JOIN dim_payment p ON p.payment_method_key = f.payment_method_key"
        )

    q["pipeline_late_day"] = _with(by_ids("fact"), ["fact"])
    q["fact_late_part"] = _with(f"{by_ids('fact_a')} UNION ALL {by_ids('fact_b')}", ["fact_a", "fact_b"])
    q["fact_rekeyed"] = _with(
        "SELECT t.transaction_id, t.txn_date, CAST(t.txn_amount AS DOUBLE) AS txn_amount, c.customer_id, c.effective_start, c.kyc_tier, "
        "m.merchant_id, m.category FROM silver_transactions t LEFT JOIN dim_merchant_1 m ON t.merchant_id = m.merchant_id "
        "LEFT JOIN dim_customer_late c ON t.customer_id = c.customer_id AND t.txn_date >= c.effective_start",
        ["silver_transactions", "dim_customer_late", "dim_merchant_1"],
    )
    q["bronze_empty_day"] = _with(f"SELECT *, {_audit('merchants', DAY2)} FROM raw_merchants_1", ["raw_merchants_1"])
    columns = RAW_COLUMNS["transactions"]
    audit = ["load_timestamp", "source_file"]
    q["bronze_quarantine"] = _with(
        f"SELECT {', '.join(columns)}, {_audit('transactions', DAY2)}, NULL AS reason, NULL AS line, CAST(NULL AS INT) AS found_fields, "
        f"CAST(NULL AS INT) AS expected_fields FROM feed_lines WHERE kind NOT IN (3, 5, 7) UNION ALL "
        f"SELECT {', '.join(f'NULL AS {c}' for c in [*columns, *audit])}, '{DAY2}', CASE kind WHEN 7 THEN 'long' ELSE 'short' END, "
        f"CASE kind WHEN 3 THEN cut WHEN 5 THEN chr(34) || cut ELSE whole || ',more' END, CASE kind WHEN 3 THEN 6 WHEN 5 THEN 1 ELSE {len(columns) + 1} END, "
        f"{len(columns)} FROM feed_lines WHERE kind IN (3, 5, 7)",
        ["feed_lines"],
    )
    q["layer_row_counts"] = _layer_counts_sql()
    q["pipeline_end_to_end"] = q["layer_row_counts"]

    n = "COUNT(f.transaction_id)"
    def q1(cal: str, more: str = "") -> str:
        return f"""
        SELECT d.year, d.month_name, d.month, {n} AS total_transactions,
               CAST(SUM(f.txn_amount) AS DOUBLE) AS gross_merchandise_value,
               CAST(SUM(f.platform_fee) AS DOUBLE) AS total_platform_revenue,
               CAST(SUM(f.cashback_amount) AS DOUBLE) AS total_cashback,
               CAST(SUM(f.net_revenue) AS DOUBLE) AS net_revenue,
               {_avg('SUM(f.txn_amount)', n)} AS avg_transaction_value
        FROM fact f JOIN {cal} d ON f.date_key = d.date_key
        WHERE f.txn_status = 'SUCCESS' {more}
        GROUP BY d.year, d.month, d.month_name
        ORDER BY d.year, d.month"""

    q["q1_monthly_gmv"] = _with(q1("dim_date"), ["fact", "dim_date"])
    q["q1_range"] = _with(
        q1("dim_date", "AND f.txn_date BETWEEN DATE '1994-11-16' AND DATE '1996-02-10'"), ["fact", "dim_date"])
    q["q1_short_calendar"] = _with(q1("short_dim_date"), ["fact", "short_dim_date"])
    failed = "SUM(CASE WHEN f.txn_status = 'FAILED' THEN 1 ELSE 0 END)"
    ok = "SUM(CASE WHEN f.txn_status = 'SUCCESS' THEN 1 ELSE 0 END)"
    q["q2_top_merchants"] = _with(
        f"""
        SELECT m.merchant_name, m.category, m.city, {n} AS total_transactions,
               CAST(SUM(f.txn_amount) AS DOUBLE) AS total_gmv,
               CAST(SUM(f.platform_fee) AS DOUBLE) AS total_revenue,
               {_avg('SUM(f.txn_amount)', n)} AS avg_txn_value,
               CAST({failed} AS BIGINT) AS failed_transactions,
               {_pct(failed, 'COUNT(*)')} AS failure_rate_pct
        FROM fact f JOIN dim_merchant m ON f.merchant_key = m.merchant_key
        GROUP BY m.merchant_name, m.category, m.city
        ORDER BY SUM(f.platform_fee) DESC, m.merchant_name, m.category, m.city
        LIMIT 10""",
        ["fact", "dim_merchant"],
    )
    q["q3_payment_methods"] = _with(
        f"""
        SELECT p.method_name, p.method_type, {n} AS total_transactions,
               CAST({ok} AS BIGINT) AS successful_txns, CAST({failed} AS BIGINT) AS failed_txns,
               {_pct(ok, 'COUNT(*)')} AS success_rate_pct,
               {_avg('SUM(f.txn_amount)', n)} AS avg_txn_amount,
               CAST(SUM(f.platform_fee) AS DOUBLE) AS total_revenue
        FROM fact f JOIN dim_payment p ON f.payment_method_key = p.payment_method_key
        GROUP BY p.method_name, p.method_type
        ORDER BY total_transactions DESC""",
        ["fact", "dim_payment"],
    )
    dc = "COUNT(DISTINCT f.customer_key)"
    def q4(fact: str, customers: str) -> str:
        return f"""
        SELECT c.customer_segment, c.kyc_tier, {dc} AS unique_customers, {n} AS total_transactions,
               CAST(SUM(f.txn_amount) AS DOUBLE) AS total_gmv,
               CAST(SUM(f.platform_fee) AS DOUBLE) AS total_revenue,
               {_avg('SUM(f.txn_amount)', n)} AS avg_txn_value,
               {_avg('SUM(f.txn_amount)', dc)} AS gmv_per_customer,
               CAST(SUM(f.is_fraud_flag) AS BIGINT) AS fraud_transactions,
               {_pct('SUM(f.is_fraud_flag)', 'COUNT(*)')} AS fraud_rate_pct
        FROM {fact} f JOIN {customers} c ON f.customer_key = c.customer_key
        WHERE c.is_current = 1
        GROUP BY c.customer_segment, c.kyc_tier
        ORDER BY total_revenue DESC"""

    def q5(fact: str, customers: str) -> str:
        return f"""
        SELECT c.kyc_tier AS kyc_tier_at_time_of_txn, {n} AS total_transactions,
               COUNT(DISTINCT c.customer_id) AS unique_customers,
               CAST(SUM(f.txn_amount) AS DOUBLE) AS total_gmv,
               CAST(SUM(f.platform_fee) AS DOUBLE) AS total_revenue,
               {_avg('SUM(f.txn_amount)', n)} AS avg_txn_value
        FROM {fact} f JOIN {customers} c ON f.customer_key = c.customer_key
        GROUP BY c.kyc_tier
        ORDER BY total_revenue DESC"""

    q["q4_segment_revenue"] = _with(q4("fact", "dim_customer"), ["fact", "dim_customer"])
    q["q5_kyc_point_in_time"] = _with(q5("fact", "dim_customer"), ["fact", "dim_customer"])
    q["q4_incremental"] = _with(q4("fact_third", "scd2_third_merged"), ["fact_third", "scd2_third_merged"])
    q["q5_bitmap_customers"] = _with(q5("fact_third", "scd2_third_merged"), ["fact_third", "scd2_third_merged"])
    q["q5b_version_split"] = _with(
        f"""
        SELECT c.kyc_tier AS kyc_tier_at_txn_time, c.is_current, {n} AS transactions,
               CAST(SUM(f.txn_amount) AS DOUBLE) AS gmv
        FROM fact f JOIN dim_customer c ON f.customer_key = c.customer_key
        GROUP BY c.kyc_tier, c.is_current
        ORDER BY c.kyc_tier, c.is_current""",
        ["fact", "dim_customer"],
    )
    q["sql_views_q5b"] = q["q5b_version_split"]
    return q
