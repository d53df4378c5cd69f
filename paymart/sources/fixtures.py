"""Raw string tables derived from the TPC-H-like test tables.

The warehouse lands five all-string sources.  For tests and benchmarks they
are derived, with Spark, from the parquet tables in ``sf_dir`` so that their
volume grows with the scale factor:

* customers, customer updates: ``customer`` joined to ``nation`` and ``region``;
* merchants (two snapshots): ``supplier``;
* payment methods (two snapshots): one row per order priority of ``orders``;
* transactions: ``lineitem`` joined to ``orders``.

Dirt (NULL keys, unparsable numbers, stray spaces and case, invalid
statuses, duplicate ids) is injected by fixed modulus rules on the source
keys, so every silver rule has rows to act on.  The rules are data, not
behaviour of the warehouse.
"""

from functools import lru_cache

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


# The two SCD load days of the test scenario and the date the
# customer updates carry.
DAY1 = "1995-01-01"
DAY2 = "1998-07-01"
UPDATES_DATE = "1998-06-30"
# Fixed value: a third load day, for transactions only.
DAY3 = "1998-07-02"

# Raw KYC tier text by key % 3 (dirty case and spaces on purpose).
KYC_RAW = [" basic", "Full", "PREMIUM "]
# Market segments in rotation order (updates move to the next one).
SEGMENTS = ["automobile", "building", "furniture", "household", "machinery"]
# Payment method attributes by order priority 1..5.
PM_CODES = [" upi", "wallet", "CARD_DEBIT", "netbanking ", "bnpl"]
PM_NAMES = ["UPI", "Wallet", "Debit Card", " Net Banking", "Buy Now Pay Later "]
PM_TYPES = ["instant", "INSTANT", "Instant ", "deferred", " DEFERRED"]
# Transaction method text by order priority 1..5, and the code
# no payment method has.
TXN_CODES = [" upi", "Wallet ", "CARD_DEBIT", "netbanking", "BNPL"]
UNKNOWN_CODE = "CRYPTO"


@lru_cache(maxsize=128)
def _read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    # One lazy scan per table and session: listing files and reading footers
    # once instead of at every use.
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def _pick(index: Column, values: list[str]) -> Column:
    """values[index] for a 0-based integer column (NULL outside the range)."""
    out = None
    for i, v in enumerate(values):
        out = F.when(index == i, F.lit(v)) if out is None else out.when(index == i, F.lit(v))
    return out


def _digits(k: Column, width: int) -> Column:
    """Zero-padded decimal text of ``k``; never truncates wider numbers.

    A formatter call per row costs more than the rest of a row, so it is left to negative and NULL keys.
    """
    text = k.cast("string")
    return F.when(k >= 10**width, text).when(k >= 0, F.lpad(text, width, "0")).otherwise(F.format_string(f"%0{width}d", k))


def customer_id(k: Column) -> Column:
    return F.concat(F.lit("CUST-"), _digits(k, 6))


def merchant_id(k: Column) -> Column:
    return F.concat(F.lit("MERCH-"), _digits(k, 4))


def _customers_base(spark: SparkSession, sf_dir: str) -> DataFrame:
    nation = _read(spark, sf_dir, "nation").select("n_nationkey", "n_name", "n_regionkey")
    region = _read(spark, sf_dir, "region").select("r_regionkey", "r_name")
    cust = _read(spark, sf_dir, "customer").select(
        "c_custkey", "c_name", "c_nationkey", "c_acctbal", "c_mktsegment"
    )
    # nation (25 rows) and region (5 rows) are fixed-size reference tables.
    geo = nation.join(F.broadcast(region), nation.n_regionkey == region.r_regionkey)
    return cust.join(F.broadcast(geo), cust.c_nationkey == geo.n_nationkey)


def _customer_rows(base: DataFrame, updates: bool) -> DataFrame:
    k = F.col("c_custkey")
    created = F.make_date(
        (F.lit(1995) + k % 3).cast("int"), (F.lit(1) + k % 12).cast("int"), (F.lit(1) + k % 28).cast("int")
    ).cast("string")
    wallet = F.floor(F.abs(F.col("c_acctbal"))).cast("int")
    seg = F.lower("c_mktsegment")
    if updates:
        # Next tier, limit + 1000, next segment; name, contact and place unchanged.
        kyc = _pick((k + 1) % 3, KYC_RAW)
        wallet_txt = (wallet + 1000).cast("string")
        nxt = None
        for i, s in enumerate(SEGMENTS):
            to = F.lit(SEGMENTS[(i + 1) % len(SEGMENTS)])
            nxt = F.when(seg == s, to) if nxt is None else nxt.when(seg == s, to)
        segment = nxt.otherwise(F.lit(SEGMENTS[0]))
        cid = customer_id(k)
    else:
        kyc = _pick(k % 3, KYC_RAW)
        wallet_txt = (
            F.when(k % 43 == 0, F.lit("n/a")).when(k % 47 == 0, F.lit("12500.5"))
            .otherwise(wallet.cast("string"))
        )
        segment = F.when(k % 53 == 0, F.lit(None).cast("string")).otherwise(seg)
        cid = F.when(k == 5, F.lit(None).cast("string")).otherwise(customer_id(k))
    cols = [
        cid.alias("customer_id"),
        F.concat(F.lit("  "), F.col("c_name"), F.lit(" ")).alias("full_name"),
        F.concat(F.lit(" USER"), k.cast("string"), F.lit("@EXAMPLE.COM")).alias("email"),
        F.concat(F.lit("555-"), _digits(k, 7)).alias("phone"),
        F.when(k % 37 == 0, F.lit(None).cast("string"))
        .otherwise(F.concat(F.lit(" new "), F.lower("n_name"))).alias("city"),
        F.when(k % 41 == 0, F.lit(None).cast("string"))
        .otherwise(F.concat(F.lower(F.substring("r_name", 1, 2)), F.lit(" "))).alias("state"),
        kyc.alias("kyc_tier"),
        wallet_txt.alias("wallet_limit"),
        segment.alias("customer_segment"),
        created.alias("created_date"),
    ]
    if updates:
        cols.append(F.lit(UPDATES_DATE).alias("updated_date"))
    return base.select(*cols)


def raw_customers(spark: SparkSession, sf_dir: str, snapshot: int = 1) -> DataFrame:
    """Snapshot 0 holds every customer.  Snapshot 1 lacks keys divisible by 11 (they
    arrive on day 2); snapshot 2 lacks keys divisible by 23 (gone from the
    source, kept by the dimension)."""
    base = _customers_base(spark, sf_dir)
    k = F.col("c_custkey")
    if snapshot:
        base = base.filter(k % 11 != 0) if snapshot == 1 else base.filter(k % 23 != 0)
    return _customer_rows(base, updates=False)


def raw_customer_updates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """About one customer in seven changes tier, wallet limit and segment (the feed's own rule)."""
    base = _customers_base(spark, sf_dir).filter(F.col("c_custkey") % 7 == 0)
    return _customer_rows(base, updates=True)


def raw_merchants(spark: SparkSession, sf_dir: str, snapshot: int = 1) -> DataFrame:
    """Suppliers as merchants; pairs (2j, 2j+1) share name, category and city.

    Snapshot 0 holds every merchant.  Snapshot 1 lacks keys divisible by 13.
    Snapshot 2 has them, lacks keys divisible by 11 and moves keys divisible by
    5 to category 'health'.
    """
    k = F.col("s_suppkey")
    even = k - k % 2
    category = F.when(even % 6 == 0, F.lit("food")).when(even % 6 == 2, F.lit("Retail ")).otherwise(F.lit("TRAVEL"))
    if snapshot == 2:
        category = F.when(k % 5 == 0, F.lit("health")).otherwise(category)
    df = _read(spark, sf_dir, "supplier").select("s_suppkey")
    if snapshot:
        df = df.filter(k % 13 != 0) if snapshot == 1 else df.filter(k % 11 != 0)
    return df.select(
        merchant_id(k).alias("merchant_id"),
        F.concat(F.lit(" Merchant "), even.cast("string")).alias("merchant_name"),
        category.alias("category"),
        F.concat(F.lit("sub_"), (k % 3).cast("string")).alias("sub_category"),
        F.concat(F.lit("city "), (even % 5).cast("string")).alias("city"),
        F.when(k % 19 == 0, F.lit(None).cast("string")).otherwise(F.lit("mh")).alias("state"),
        F.when(k % 20 == 0, F.lit("0")).when(k % 17 == 1, F.lit(None).cast("string"))
        .otherwise(F.lit("1")).alias("is_active"),
        F.make_date(F.lit(1994), (F.lit(1) + k % 12).cast("int"), (F.lit(1) + k % 28).cast("int"))
        .cast("string").alias("onboarded_date"),
    )


def raw_payment_methods(spark: SparkSession, sf_dir: str, snapshot: int = 1) -> DataFrame:
    """One method per order priority of ``orders`` (a grouped scan of orders).

    Priority 5 has a NULL ``is_active``.  Snapshot 1 lacks priority 5;
    snapshot 2 deactivates priority 4 and renames priority 2's type.
    """
    p = F.col("p")
    pri = (
        _read(spark, sf_dir, "orders")
        .groupBy(F.substring("o_orderpriority", 1, 1).cast("int").alias("p"))
        .agg(F.count(F.lit(1)).alias("n_orders"))
    )
    pri = pri.filter(p != 5) if snapshot == 1 else pri
    active = F.when(p == 5, F.lit(None).cast("string")).otherwise(F.lit("1"))
    mtype = _pick(p - 1, PM_TYPES)
    if snapshot == 2:
        active = F.when(p == 4, F.lit("0")).otherwise(active)
        mtype = F.when(p == 2, F.lit("Deferred")).otherwise(mtype)
    return pri.select(
        F.concat(F.lit("PM-"), _digits(p, 3)).alias("method_id"),
        _pick(p - 1, PM_CODES).alias("method_code"),
        _pick(p - 1, PM_NAMES).alias("method_name"),
        mtype.alias("method_type"),
        active.alias("is_active"),
    )


def raw_transactions(spark: SparkSession, sf_dir: str, part: str = "all") -> DataFrame:
    """Line items as transactions; ``(orderkey, linenumber)`` repeats, so ids repeat.

    The feed may arrive in two parts, ``first`` and ``second``, that share
    about a third of the rows and, as ids repeat, more of the ids.

    Both sides of the join grow with the feed, so they meet in a shuffle at every
    size, each cut to short values first: decimals, dates and the bits of all yes-no rules.
    """
    pk, flag = F.col("l_partkey"), F.col("l_returnflag")
    rules = {
        **{f"pk{m}": pk % m == 0 for m in (97, 101, 103, 107, 109, 113, 127)},
        "N": flag == "N", "R": flag == "R", "A": flag == "A",
        "timeout": F.col("l_linestatus") == "F", "even": F.col("l_linenumber") % 2 == 0, "large": F.col("l_quantity") >= 49,
    }
    bits = sum((F.when(rule, F.lit(1 << n)).otherwise(F.lit(0)) for n, rule in enumerate(rules.values())), F.lit(0))
    holds = {name: F.col("bits").bitwiseAND(F.lit(1 << n)) != 0 for n, name in enumerate(rules)}
    price = F.col("l_extendedprice").cast("decimal(10,2)")
    li = _read(spark, sf_dir, "lineitem")
    if part != "all":
        li = li.filter(F.col("l_partkey") % 3 != (2 if part == "first" else 0))
    li = li.select(
        "l_orderkey", "l_suppkey", "l_linenumber", bits.alias("bits"),
        price.alias("price"),
        F.col("l_tax").cast("decimal(4,2)").alias("tax"),
        F.col("l_discount").cast("decimal(4,2)").alias("discount"),
        F.col("l_shipdate").cast("date").alias("shipped"),
    )
    od = _read(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", F.substring("o_orderpriority", 1, 1).cast("int").alias("prio"))
    prio = F.col("prio")
    amount = F.col("price").cast("string")
    return li.join(od.hint("merge"), li.l_orderkey == od.o_orderkey).select(
        F.concat(F.lit("TXN-"), F.col("l_orderkey").cast("string"), F.lit("-"),
                 F.col("l_linenumber").cast("string")).alias("transaction_id"),
        F.when(holds["pk109"], F.lit(None).cast("string"))
        .otherwise(customer_id(F.col("o_custkey"))).alias("customer_id"),
        merchant_id(F.col("l_suppkey")).alias("merchant_id"),
        F.when(holds["pk127"], F.lit(UNKNOWN_CODE)).otherwise(_pick(prio - 1, TXN_CODES)).alias("method_code"),
        F.when(holds["pk113"], F.lit(None).cast("string"))
        .otherwise(F.col("shipped").cast("string")).alias("txn_date"),
        F.when(holds["pk101"], F.lit("bad")).when(holds["pk103"], F.lit(None).cast("string"))
        .when(holds["pk107"], F.concat(F.lit("-"), amount)).otherwise(amount).alias("txn_amount"),
        (F.col("price") * F.col("tax")).cast("decimal(10,2)").cast("string").alias("platform_fee"),
        (F.col("price") * F.col("discount")).cast("decimal(10,2)").cast("string").alias("cashback_amount"),
        F.when(holds["pk97"], F.lit("REVERSED"))
        .when(holds["N"] & holds["even"], F.lit(" success "))
        .when(holds["N"], F.lit("SUCCESS"))
        .when(holds["R"], F.lit("failed"))
        .when(holds["A"], F.lit("PENDING")).alias("txn_status"),
        F.when(holds["R"], F.when(holds["timeout"], F.lit("timeout"))
               .otherwise(F.lit("BANK_DECLINED "))).alias("failure_reason"),
        F.when(holds["large"], F.lit("1")).otherwise(F.lit("0")).alias("is_fraud_flag"),
    )


RAW_BUILDERS = {
    "customers": lambda spark, sf_dir: raw_customers(spark, sf_dir, 1),
    "merchants": lambda spark, sf_dir: raw_merchants(spark, sf_dir, 1),
    "payment_methods": lambda spark, sf_dir: raw_payment_methods(spark, sf_dir, 1),
    "transactions": lambda spark, sf_dir: raw_transactions(spark, sf_dir),
    "customer_updates": lambda spark, sf_dir: raw_customer_updates(spark, sf_dir),
}
