"""The two-load-day warehouse over a directory of test tables.

Day 1 (``DAY1``) lands customer, merchant and payment-method snapshot 1 and
builds the first dimension images.  Day 2 (``DAY2``) lands customer
snapshot 2 plus the updates feed (applied to silver by the
update-only merge), merchant and payment-method snapshot 2 and the
transactions, merges every dimension and builds the fact.  Every frame is
derived from the parquet tables in ``sf_dir``.

Dimension images and the silver customer snapshots are *staged* so that each
is computed once per query even though several steps read it (the broadcast
size check, the joins, the next day's merge):

* ``stage="write"`` (default): written as parquet under the shared storage root
  and read back, as the pipeline does; this also cuts the lineage, so a lost
  executor recomputes from the last table, and nothing stays cached;
* ``stage=None``: fully lazy.

Silver transactions and the fact stay lazy.  Steps that read the transactions more
than once (calendar, hot keys, joins, the fact, layer counts) take
``stored_transactions``, staged like the images, so that feed join and
deduplication run once.
"""

from __future__ import annotations

from functools import cached_property

from pyspark.sql import DataFrame, SparkSession

from paymart.operators.calendar import dim_date_covering
from paymart.plans import gold, silver
from paymart.sources import fixtures
from paymart.sources.bronze import add_audit_columns
from paymart.sources.fixtures import DAY1, DAY2
from paymart.sources.storage import new_table_path, read_table, write_table


class Warehouse:
    def __init__(
        self,
        spark: SparkSession,
        sf_dir: str,
        initial_start: str = "created_date",
        stage: str | None = "write",
        **fact_options,
    ):
        self.spark = spark
        self.sf_dir = sf_dir.rstrip("/")
        self.initial_start = initial_start
        self.staging = stage
        self.fact_options = fact_options

    def stage(self, name: str, df: DataFrame) -> DataFrame:
        """Stage a frame that several later steps read (see module docstring)."""
        if self.staging == "write":
            return read_table(self.spark, write_table(df, new_table_path(self.spark, name)), df.schema)
        return df

    # ---- raw and bronze ------------------------------------------------------
    def raw(self, source: str, snapshot: int = 1) -> DataFrame:
        s, d = self.spark, self.sf_dir
        if source == "customers":
            return fixtures.raw_customers(s, d, snapshot)
        if source == "merchants":
            return fixtures.raw_merchants(s, d, snapshot)
        if source == "payment_methods":
            return fixtures.raw_payment_methods(s, d, snapshot)
        return fixtures.RAW_BUILDERS[source](s, d)

    def bronze(self, source: str, load_date: str, snapshot: int = 1) -> DataFrame:
        return add_audit_columns(self.raw(source, snapshot), source, load_date)

    # ---- silver --------------------------------------------------------------
    @cached_property
    def customers_day1(self) -> DataFrame:
        return self.stage("silver_customers_day1", silver.silver_customers(self.bronze("customers", DAY1), DAY1))

    @cached_property
    def customers_day2_before_updates(self) -> DataFrame:
        return silver.silver_customers(self.bronze("customers", DAY2, snapshot=2), DAY2)

    @cached_property
    def customers_day2(self) -> DataFrame:
        return self.stage("silver_customers", silver.apply_customer_updates(
            self.customers_day2_before_updates, self.raw("customer_updates"), DAY2
        ))

    def merchants(self, snapshot: int) -> DataFrame:
        day = DAY2 if snapshot == 2 else DAY1
        return silver.silver_merchants(self.bronze("merchants", day, snapshot), day)

    def payment_methods(self, snapshot: int) -> DataFrame:
        day = DAY1 if snapshot == 1 else DAY2
        return silver.silver_payment_methods(self.bronze("payment_methods", day, snapshot), day)

    @cached_property
    def bronze_transactions(self) -> DataFrame:
        return self.bronze("transactions", DAY2)

    @cached_property
    def transactions(self) -> DataFrame:
        return silver.silver_transactions(self.bronze_transactions, DAY2)

    @cached_property
    def stored_transactions(self) -> DataFrame:
        return self.stage("silver_transactions", self.transactions)

    # ---- gold ----------------------------------------------------------------
    @cached_property
    def dim_merchant_day1(self) -> DataFrame:
        return self.stage("dim_merchant_day1", gold.load_type1("merchant", None, self.merchants(1), DAY1))

    @cached_property
    def dim_merchant(self) -> DataFrame:
        return self.stage("dim_merchant", gold.load_type1(
            "merchant", self.dim_merchant_day1, self.merchants(2), DAY2, stage=lambda rows: self.stage("scd1_rows", rows)))

    @cached_property
    def dim_payment_day1(self) -> DataFrame:
        return self.stage("dim_payment_day1", gold.load_type1("payment_method", None, self.payment_methods(1), DAY1))

    @cached_property
    def dim_payment(self) -> DataFrame:
        return self.stage(
            "dim_payment",
            gold.load_type1("payment_method", self.dim_payment_day1, self.payment_methods(2), DAY2,
                            stage=lambda rows: self.stage("scd1_rows", rows)),
        )

    @cached_property
    def dim_customer_day1(self) -> DataFrame:
        return self.stage("dim_customer_day1", gold.load_customers(None, self.customers_day1, DAY1, self.initial_start))

    @cached_property
    def dim_customer(self) -> DataFrame:
        return self.stage(
            "dim_customer",
            gold.load_customers(
                self.dim_customer_day1, self.customers_day2, DAY2, self.initial_start,
                stage=lambda rows: self.stage("scd2_rows", rows),
            ),
        )

    @cached_property
    def dim_date(self) -> DataFrame:
        return self.stage("dim_date", dim_date_covering(self.stored_transactions, "txn_date"))

    @cached_property
    def fact(self) -> DataFrame:
        return gold.fact_transaction(
            self.stored_transactions, self.dim_customer, self.dim_merchant, self.dim_payment, DAY2, **self.fact_options
        )
