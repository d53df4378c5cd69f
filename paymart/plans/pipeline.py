"""The warehouse as daily jobs over real tables (P1).

``load_day`` is one daily run: it reads the bronze partitions landed for that
day, rebuilds that day's silver, merges every dimension into its image from
before the day (initial load when there is none), extends the calendar and
builds the day's facts.

Storage.  Every table image is written to a fresh folder and never touched
again.  A catalog table under the root records (name, day, path, rows, schema);
a day's entries are appended to it in one write after everything of the day
succeeded, so a failed run leaves the warehouse as it was, a repeated run of a
day replaces that day's entries, and another process continues from the catalog
(``Lakehouse.open``).  Snapshot tables are read at their latest day.  Transactions
and facts are kept by load day: reading them unites the days, and an id stored
on another day is not loaded again.  Closed customer versions are kept by the
day that closed them and are never rewritten.

Late rows.  A fact whose customer or merchant is unknown on its day gets the key
when the dimension row arrives: the missing ids of each day are stored by month,
and only the months of a day that an arriving id concerns are written again.  Such
a fact takes the customer version valid on its date in the latest images, however
the days were ordered; payment methods stay as of the fact's own day.

Many customers.  Where the customer versions outgrow a broadcast the transactions of a
day look up their customers on the way to their months, by id, customer and date, and
keep the keys in their files, so the facts are built month by month without a shuffle.

Report states.  Each day's facts are summed per customer version once, when they
are written (``plans.states``); the segment and tier reports merge the states.

Quality.  Each transaction day is profiled (rejects of the feed, NULL keys and
calendar misses of the facts); ``fail_above`` stops the day, before anything of
it becomes visible, when a count exceeds its share of the rows.

``run_pipeline`` is the two-day test scenario: land the day-1 feeds (customer,
merchant and payment-method snapshot 1) and load day 1; land the day-2 feeds
(second snapshots, customer updates, transactions) and load day 2.
"""

from __future__ import annotations

import dataclasses
import functools
import json
import time
import uuid
from collections.abc import Callable
from concurrent.futures import Future, ThreadPoolExecutor
from dataclasses import dataclass, field

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StructField, StructType

from paymart.operators.calendar import EARLIEST, LATEST, dim_date
from paymart.operators.id_index import admitted, bucket_count, id_filters
from paymart.operators.joins import checked_broadcast, known_to_fit
from paymart.operators.keys import SMALL_ROWS
from paymart.plans import gold, silver, states
from paymart.sources import fixtures
from paymart.sources.bronze import ingest_csv, read_bronze
from paymart.sources.csv import write_csv
from paymart.sources.fixtures import DAY1, DAY2
from paymart.sources.storage import ROWS_PER_FILE, new_table_path, read_table, write_table

CATALOG = "seq long, name string, day string, path string, rows long, schema string, max_key long, longest long"

# Tables kept by load day; all others are snapshots read at their latest day.
ID_FILTERS = "silver.transaction_id_filters"
MISSING = "gold.fact_missing_ids"
SPEND = "gold.customer_spend"
TIER_CUSTOMERS = "gold.tier_customers"
BY_DAY = {"silver.transactions", ID_FILTERS, "gold.fact_transaction", MISSING, SPEND, TIER_CUSTOMERS, "gold.dim_customer_closed"}
CUSTOMER_PARTS = ("gold.dim_customer_current", "gold.dim_customer_closed")
BY_MONTH = {"silver.transactions", "gold.fact_transaction"}
MONTHS = ["txn_year", "txn_month"]
# Kept in the files of transactions whose customers were looked up on their way to their months; no column of the table.
CUSTOMER_KEY = StructField("customer_key", LongType())
# Surrogate key and looked-up text of the dimensions; the catalog keeps the largest and the longest.
KEYS = {
    "gold.dim_customer_current": ("customer_key", "customer_id"),
    "gold.dim_customer_closed": ("customer_key", "customer_id"),
    "gold.dim_merchant": ("merchant_key", "merchant_id"),
    "gold.dim_payment_method": ("payment_method_key", "method_code"),
}
# Dimensions that facts look up: the fact's column and the number of columns looked at.
LOOKUPS = {"gold.dim_customer": ("customer_id", 4), "gold.dim_merchant": ("merchant_id", 2), "gold.dim_payment_method": ("method_code", 2)}
LATE = ("gold.dim_customer", "gold.dim_merchant")  # ids unknown on the day of a fact are looked up in the latest images


class DataQualityError(ValueError):
    """A day's profile exceeds a limit of ``fail_above``."""


@dataclass
class Image:
    seq: int
    name: str
    day: str
    path: str
    rows: int
    schema: str
    max_key: int | None = None
    longest: int | None = None


@dataclass
class Lakehouse:
    root: str
    images: dict[tuple[str, str], Image] = field(default_factory=dict)  # (name, day) -> its image
    seconds: dict[str, float] = field(default_factory=dict)  # wall time per table, planning and staging included
    quality: dict[str, dict[str, dict[str, int]]] = field(default_factory=dict)  # day -> profile -> counts

    @classmethod
    def open(cls, spark: SparkSession, root: str) -> Lakehouse:
        """The warehouse stored under ``root``, as its catalog has it."""
        lake = cls(root)
        try:
            rows = spark.read.schema(CATALOG).parquet(f"{root}/_catalog").orderBy("seq").collect()  # one row a table and day
        except AnalysisException as e:
            if e.getCondition() != "PATH_NOT_FOUND":
                raise
            rows = []
        for r in rows:
            lake.images[r["name"], r["day"]] = Image(**r.asDict())
        return lake

    def commit(self, spark: SparkSession, images: list[Image]) -> None:
        """Make a day's images visible: one append to the catalog."""
        seq = max((i.seq for i in self.images.values()), default=0)
        for n, image in enumerate(images, 1):
            image.seq = seq + n
        rows = [dataclasses.astuple(i) for i in images]
        spark.createDataFrame(rows, CATALOG).coalesce(1).write.mode("append").parquet(f"{self.root}/_catalog")
        for image in images:
            self.images[image.name, image.day] = image

    def days(self, name: str) -> list[str]:
        return sorted(day for n, day in list(self.images) if n == name)  # tables load side by side

    def _files(self, spark: SparkSession, name: str, days: list[str], hidden: tuple[StructField, ...] = ()) -> DataFrame:
        """The stored rows of some days, their folders' values as further columns.

        ``hidden``: columns that the files of these days have beside those of the table.
        """
        found = [self.images[name, d] for d in days]
        schema = StructType([*StructType.fromJson(json.loads(found[-1].schema)), *hidden])
        return spark.read.schema(schema).option("basePath", f"{self.root}/{name.replace('.', '/')}").parquet(*[p for i in found for p in i.path.split("\n")])

    def _load(self, spark: SparkSession, name: str, days: list[str]) -> DataFrame | None:
        if not days:
            return None
        names = StructType.fromJson(json.loads(self.images[name, days[-1]].schema)).names
        return self._files(spark, name, days).select(*names)

    def used(self, name: str, until: str | None = None, before: str | None = None) -> list[Image]:
        """The images that make up a table as of a day."""
        days = [d for d in self.days(name) if (until is None or d <= until) and (before is None or d < before)]
        return [self.images[name, d] for d in (days if name in BY_DAY else days[-1:])]

    def image_rows(self, name: str, until: str | None = None, before: str | None = None) -> int:
        return sum(i.rows for i in self.used(name, until, before))

    def largest_key(self, name: str, but: str | None = None) -> int:
        """The largest surrogate key of all images, those of the day ``but`` aside."""
        return max((i.max_key or 0 for (n, d), i in list(self.images.items()) if n == name and d != but), default=0)

    def image(self, spark: SparkSession, name: str, until: str | None = None, before: str | None = None) -> DataFrame | None:
        """A table as of a day (``until``: that day included), or None if it has no image yet."""
        if name == "gold.dim_customer":
            current, closed = (self.image(spark, part, until, before) for part in CUSTOMER_PARTS)
            return current if closed is None or current is None else current.unionByName(closed)
        return self._load(spark, name, [i.day for i in self.used(name, until, before)])

    def read(self, spark: SparkSession, name: str) -> DataFrame:
        found = self.image(spark, name)
        if found is None:
            raise KeyError(name)
        return found

    def facts_between(self, spark: SparkSession, first: str, last: str) -> DataFrame:
        """Facts dated ``first`` to ``last`` (both included), read from the month folders of that range only.

        Facts without a date are in no range.
        """
        y, m, d = (F.col(c) for c in (*MONTHS, "txn_date"))
        (y0, m0), (y1, m1) = ((int(x[:4]), int(x[5:7])) for x in (first, last))
        folders = ((y > y0) | ((y == y0) & (m >= m0))) & ((y < y1) | ((y == y1) & (m <= m1)))
        return self.read(spark, "gold.fact_transaction").where(folders & d.between(F.lit(first).cast("date"), F.lit(last).cast("date")))

    @property
    def rows(self) -> dict[str, int]:
        """Rows of each stored table: of its latest image, or of all days."""
        out: dict[str, int] = {}
        for name in {n for n, _ in self.images}:
            out[name] = self.image_rows(name)
        return out


def land(spark: SparkSession, lake: Lakehouse, source: str, feed: DataFrame | Callable[[], DataFrame], day: str) -> None:
    """Land one feed (or what builds it) for ``day`` as CSV and ingest it into its bronze table."""
    csv_path = f"{lake.root}/landing/{day}/{source}"
    t = time.perf_counter()
    rows = feed() if callable(feed) else feed
    write_csv(rows, csv_path)
    lake.seconds[f"landing.{source}.{day}"] = time.perf_counter() - t
    t = time.perf_counter()
    ingest_csv(spark, source, csv_path, f"{lake.root}/bronze", day, rows.columns)
    lake.seconds[f"bronze.{source}.{day}"] = time.perf_counter() - t


class _Load:
    """One load of a day: the images it makes are visible to its later steps at once, to others after ``commit``.

    ``lake`` is the warehouse as it was, ``work`` with what this load made so far.
    """

    def __init__(self, spark: SparkSession, lake: Lakehouse, day: str, rebalance: bool) -> None:
        self.spark, self.lake, self.day, self.rebalance = spark, lake, day, rebalance
        self.work = Lakehouse(lake.root, dict(lake.images))
        self.made: dict[tuple[str, str], Image] = {}
        self.gaps: list[str] = []  # days whose missing ids are to be listed anew
        self.rekeyed: list[tuple[str, DataFrame]] = []  # (column of transactions, ids) of moved ids and changed versions
        self.keyed = False  # whether the files of the day's transactions hold their customer keys

    def scratch(self, df: DataFrame) -> DataFrame:
        path = f"{self.lake.root}/_work/{self.day}-{uuid.uuid4().hex[:12]}"
        return read_table(self.spark, write_table(df, path), df.schema)

    def save(
        self, name: str, build: Callable[[], DataFrame], day: str | None = None, metrics: dict[str, Column] | None = None, kept: list[str] = (),
        placed: bool = False, finish: Callable[[DataFrame], DataFrame] | None = None, hidden: tuple[StructField, ...] = (),
    ) -> tuple[DataFrame, dict]:
        """Build and write one image; returns it and what was counted while it was written (``rows`` and ``metrics``).

        The counts are taken in the last stage, above the rebalance, where every row passes once.
        ``kept``: month folders of an older image that stay part of this one.
        ``placed``: the rows come straight from month files, so a task has few months already.
        ``finish``: adds what follows from the other columns, months among it, after the rebalance, which then goes by ``txn_date``.
        ``hidden``: columns that the files hold beside those of the table.
        """
        t, day = time.perf_counter(), day or self.day
        df = build()
        months = MONTHS if name in BY_MONTH else None
        path = f"{self.lake.root}/{name.replace('.', '/')}/load_day={day}/image={uuid.uuid4().hex[:12]}"
        key, text = KEYS.get(name, (None, None))
        counted = {"rows": F.count(F.lit(1)), **(metrics or {})}
        if key is not None:
            counted |= {"max_key": F.max(key), "longest": F.max(F.octet_length(text))}
        seen = Observation()
        if finish is None:
            out = df.hint("rebalance", *months) if months and self.rebalance and not placed else df
        else:
            month = F.year("txn_date") * 12 + F.month("txn_date")
            out = df = finish(df.withColumn("_month", month).hint("rebalance", "_month").drop("_month") if self.rebalance else df)
        write_table(out.observe(seen, *[c.alias(n) for n, c in counted.items()]), path, partition_by=months, rebalance=False, file_rows=ROWS_PER_FILE if months else None)
        found = {**dict.fromkeys(counted), **seen.get}
        image = Image(0, name, day, "\n".join([path, *kept]), found["rows"] or 0, df.drop(*[f.name for f in hidden]).schema.json(), found.get("max_key"), found.get("longest"))
        self.work.images[name, day] = self.made[name, day] = image
        stored = self.work._load(self.spark, name, [day])
        if kept:
            image.rows = stored.count()
        self.lake.seconds[f"{name}@{day}"] = time.perf_counter() - t
        return stored, found | {"rows": image.rows}

    def staging(self, *rows: int) -> Callable[[DataFrame], DataFrame] | None:
        """Frames that several steps read are written first, unless they are small: then they are made again."""
        return None if sum(rows) <= SMALL_ROWS else self.scratch

    # ---- dimensions ----------------------------------------------------------
    def customers(self, sources: set[str]) -> None:
        s, day, bronze = self.spark, self.day, f"{self.lake.root}/bronze"

        def clean() -> DataFrame:
            out = silver.silver_customers(read_bronze(s, bronze, "customers", day), day)
            if "customer_updates" in sources:
                updates = read_bronze(s, bronze, "customer_updates", day).drop("load_timestamp", "source_file", "load_date")
                out = silver.apply_customer_updates(out, updates, day)
            return out

        rows, seen = self.save("silver.customers", clean)
        current, closed = CUSTOMER_PARTS
        step = lambda old, src, on, many: gold.step_customers(
            old, src, on, stage=self.staging(many, self.work.image_rows(current, before=on)),
            offset=self.work.largest_key(current, day), rows_known=many,
        )
        stay, gone = step(self.work.image(s, current, before=day), rows, day, seen["rows"])
        later = [d for d in self.lake.days(current) if d > day]
        if not later:
            self.save(current, lambda: stay)
            self.save(closed, lambda: gone)
            if any(d >= day for d in self.lake.days("gold.fact_transaction")):  # a day loaded again by another feed
                self.rekeyed.append(("customer_id", self.scratch(self.moved_versions().select(F.col("id").alias("customer_id")).distinct())))
            return
        stay, gone = self.scratch(stay), self.scratch(gone)
        prior, old_gone = self.lake.image(s, current, until=day), self.lake._load(s, closed, [d for d in self.lake.days(closed) if d == day])
        ids = self.changed(prior, stay, "customer_id", "customer_key")
        self.save(current, lambda: _spliced(prior, stay, ids, "customer_id"))
        self.save(closed, lambda: _spliced(old_gone, gone, ids, "customer_id"))
        for on in later:
            src = self.work._load(s, "silver.customers", [on]).join(ids, "customer_id", "left_semi")
            base = self.work.image(s, current, before=on).join(ids, "customer_id", "left_semi")
            stay, gone = gold.step_customers(
                base, src, on, stage=self.scratch, offset=self.work.largest_key(current), rows_known=self.lake.images["silver.customers", on].rows)
            olds = [self.lake._load(s, part, [on]) for part in CUSTOMER_PARTS]
            self.save(current, lambda: _spliced(olds[0], stay, ids, "customer_id"), on)  # noqa: B023
            self.save(closed, lambda: _spliced(olds[1], gone, ids, "customer_id"), on)  # noqa: B023
        self.rekeyed.append(("customer_id", ids))

    def type1(self, source: str, name: str) -> None:
        s, day, table = self.spark, self.day, f"gold.dim_{name}"
        clean = silver.silver_merchants if source == "merchants" else silver.silver_payment_methods
        rows, seen = self.save(f"silver.{source}", lambda: clean(read_bronze(s, f"{self.lake.root}/bronze", source, day), day))
        natural, key, *_ = gold.DIMENSIONS[name]
        before = self.work.image(s, table, before=day)
        merged = gold.load_type1(
            name, before, rows, day, stage=self.staging(seen["rows"], self.work.image_rows(table, before=day)),
            offset=self.work.largest_key(table, day), rows_known=seen["rows"],
        )
        later = [d for d in self.lake.days(table) if d > day]
        if not later:
            self.save(table, lambda: merged)
            return
        # a row that a later day brought keeps the key it has there, so its facts stay as they are
        latest, prior = self.lake.image(s, table), self.lake.image(s, table, until=day)
        merged = self.scratch(_with_keys(merged, latest, natural, key))
        ids = self.changed(prior, merged, natural, key)
        self.save(table, lambda: _spliced(prior, merged, ids, natural))
        for on in later:
            src = self.work._load(s, f"silver.{source}", [on]).join(ids, natural, "left_semi")
            base = self.work.image(s, table, before=on).join(ids, natural, "left_semi")
            offset, old = self.work.largest_key(table), self.lake._load(s, table, [on])
            follow = _with_keys(gold.load_type1(name, base, src, on, stage=self.scratch, offset=offset), latest, natural, key)
            self.save(table, lambda: _spliced(old, follow, ids, natural), on)  # noqa: B023

    def changed(self, old: DataFrame | None, new: DataFrame, natural: str, key: str) -> DataFrame:
        """The ids whose rows differ in anything but the surrogate key, or are in one of the images only."""
        if old is None:
            return self.scratch(new.select(natural).distinct())
        row = F.struct(*[c for c in new.columns if c != key])
        one = old.select(F.col(natural).alias("_id"), row.alias("_old"))
        two = new.select(natural, row.alias("_new"))
        both = two.join(one, F.col(natural) == F.col("_id"), "full_outer").where(~F.col("_old").eqNullSafe(F.col("_new")))
        return self.scratch(both.select(F.coalesce(natural, "_id").alias(natural)).distinct())

    # ---- transactions and facts ----------------------------------------------
    def transactions(self, limits: dict[str, float], customers: Callable[[], None] | None = None) -> None:
        """``customers`` waits for the customers that are loaded beside them."""
        s, day, name = self.spark, self.day, "silver.transactions"
        feed = read_bronze(s, f"{self.lake.root}/bronze", "transactions", day)
        rejects = Observation()
        rows = silver.deduped_transactions(feed, day, rejects)
        earlier = [d for d in self.lake.days(name) if d < day]
        repeats = 0
        if earlier:
            known = self.stored_ids(silver.transaction_ids(feed), earlier)
            if known is not None:  # met by id like the rows of one id, so the rows are shuffled once for both
                repeats = known.count()
                rows = rows.join(checked_broadcast(known), "transaction_id", "left_anti").select(*rows.columns)
        old = self.lake._load(s, name, [d for d in self.lake.days(name) if d == day])
        sane = F.col("txn_date").between(F.lit(EARLIEST).cast("date"), F.lit(LATEST).cast("date"))
        span = {"first": F.min(F.when(sane, F.col("txn_date"))), "last": F.max(F.when(sane, F.col("txn_date")))}
        versions = self.many_customers(customers)
        if versions is not None:
            rows, self.keyed = gold.customer_keys(rows, versions, feed), True
        stored, seen = self.save(
            name, lambda: rows, metrics=span, finish=lambda df: silver.finished_transactions(df, day), hidden=(CUSTOMER_KEY,) if self.keyed else ())
        self.span = (seen["first"], seen["last"])
        self.save(ID_FILTERS, lambda: id_filters(stored, "transaction_id", bucket_count(seen["rows"])))
        t = time.perf_counter()
        # a map task that ran again (a lost executor) is counted again; the feed's footers tell.
        # Where no row is left Spark drops the steps that counted.
        found = {k: int(v) for k, v in rejects.get.items()} if seen["rows"] else {}
        if found.get("rows_in") != feed.count():
            found = silver.transaction_rejects(feed).first().asDict()
        order = ("rows_in", "null_key_rejects", "negative_amount_rejects", "invalid_status_rejects", "rows_valid")
        profile = {**{k: found[k] for k in order}, "distinct_valid_ids": seen["rows"] + repeats, "amount_defaulted": found["amount_defaulted"]}
        self.profile("dq_rejects", profile, "rows_in", limits)
        self.lake.seconds[f"dq_rejects@{day}"] = time.perf_counter() - t
        later = [d for d in self.lake.days(name) if d > day]
        if later:
            self.moved(old, stored, later)

    def many_customers(self, wait: Callable[[], None] | None) -> DataFrame | None:
        """The customer versions of the day if they are too many for a broadcast, else None.

        Waits for the customers of this load only if these can make too many: a row of the feed opens one version at most.
        """
        rows = sum(i.rows for (n, _), i in list(self.lake.images.items()) if n in CUSTOMER_PARTS)
        if wait is not None:
            rows += read_bronze(self.spark, f"{self.lake.root}/bronze", "customers", self.day).count()
        if known_to_fit(rows, 0, LOOKUPS["gold.dim_customer"][1]):
            return None
        if wait is not None:
            wait()
        versions, small = self.lookup("gold.dim_customer", self.day)
        return None if small else versions

    def stored_ids(self, ids: DataFrame, days: list[str]) -> DataFrame | None:
        """Those of ``ids`` that earlier days stored, once each; None if the days' filters admit none.

        Only ids that a filter admits are looked up, and only in the days whose filters admitted some.
        """
        s, name = self.spark, "silver.transactions"
        filters = functools.reduce(DataFrame.unionByName, [self.lake._load(s, ID_FILTERS, [d]).withColumn("of", F.lit(d)) for d in days])
        counts = sorted(r["buckets"] for r in filters.select("buckets").distinct().collect())  # powers of two: some dozens at most
        if not counts:
            return None
        found = self.scratch(admitted(ids, "transaction_id", filters, counts).distinct())
        where = sorted(r["of"] for r in found.select("of").distinct().collect())
        if not where:
            return None
        asked = checked_broadcast(found.select("transaction_id").distinct() if len(where) > 1 else found.select("transaction_id"))
        return self.scratch(self.lake._load(s, name, where).select("transaction_id").join(asked, "transaction_id", "left_semi").distinct())

    def moved(self, old: DataFrame | None, new: DataFrame, later: list[str]) -> None:
        """An id belongs to the first day that brought it: later days give up what this day holds now, and take back what it dropped."""
        s, name = self.spark, "silver.transactions"
        none = new.select("transaction_id").limit(0)
        was = none if old is None else old.select("transaction_id")
        gained = self.scratch(new.select("transaction_id").join(was, "transaction_id", "left_anti"))
        dropped = self.scratch(was.join(new.select("transaction_id"), "transaction_id", "left_anti"))
        self.rekeyed.append(("transaction_id", gained.unionByName(dropped)))
        back = not dropped.isEmpty()
        for on in later:
            held = self.lake._load(s, name, [on])
            extra = None
            if back:
                feed = silver.silver_transactions(read_bronze(s, f"{self.lake.root}/bronze", "transactions", on), on)
                before = self.work._load(s, name, [d for d in self.work.days(name) if d < on]).select("transaction_id")
                extra = self.scratch(feed.join(dropped, "transaction_id", "left_semi").join(before, "transaction_id", "left_anti").select(*held.columns))
            lost = held.join(gained, "transaction_id", "left_semi")
            months = _months(lost if extra is None else lost.select(*MONTHS).unionByName(extra.select(*MONTHS)))
            if months:
                rest = held.where(_in_months(months)).join(gained, "transaction_id", "left_anti").select(*held.columns)
                stored, _ = self.save(name, lambda: rest if extra is None else rest.unionByName(extra), on, kept=self.other_months(name, on, months))  # noqa: B023
                self.save(ID_FILTERS, lambda: id_filters(stored, "transaction_id", bucket_count(self.work.images[name, on].rows)), on)  # noqa: B023

    def other_months(self, name: str, day: str, months: list[tuple]) -> list[str]:
        """The month folders of the day's stored image but for ``months`` (some hundreds at most)."""
        files = self.lake._files(self.spark, name, [day])
        folder = F.regexp_extract("_metadata.file_path", "^(.*)/[^/]+$", 1)
        named = {f"txn_year={_folder(y)}/txn_month={_folder(m)}" for y, m in months}
        return sorted(r[0] for r in files.select(folder.alias("f")).distinct().collect() if "/".join(r[0].split("/")[-2:]) not in named)

    def calendar(self, bounds: tuple[str, str] | None) -> tuple:
        """Write the calendar; returns its first and last day."""
        def days() -> DataFrame:
            if bounds is not None:
                return dim_date(self.spark, *bounds)
            known = self.lake.image(self.spark, "gold.dim_date")
            ends = [d for d in self.span if d is not None]
            if known is not None:
                ends += [d for d in known.agg(F.min("full_date"), F.max("full_date")).first() if d is not None]
            if not ends:
                return dim_date(self.spark, "2000-01-02", "2000-01-01")  # no days
            return dim_date(self.spark, f"{min(ends).year:04d}-01-01", f"{max(ends).year:04d}-12-31")

        _, seen = self.save("gold.dim_date", days, metrics={"first": F.min("full_date"), "last": F.max("full_date")})
        return seen["first"], seen["last"]

    def save_facts(self, txn: DataFrame, day: str, metrics: dict[str, Column] | None = None, kept: list[str] = ()) -> tuple[DataFrame, dict]:
        """Facts of ``day`` from its stored transactions: keys as its images have them; customers and merchants unknown then, as the latest images do.

        Where every dimension is broadcast (or the files hold the customer keys) the rows stay with the month files they were read from and are not shuffled to their months again.
        """
        found = {column: self.lookup(table, day) for table, (column, _) in LOOKUPS.items()}
        small = {column: few for column, (_, few) in found.items()}
        placed = all(few or (column == "customer_id" and CUSTOMER_KEY.name in txn.columns) for column, few in small.items())
        return self.save(
            "gold.fact_transaction", lambda: gold.fact_transaction(txn, *[dim for dim, _ in found.values()], day, small=small), day, metrics, kept, placed=placed)

    def lookup(self, table: str, day: str) -> tuple[DataFrame | None, bool]:
        """A dimension as facts of ``day`` look it up, and whether it may be broadcast."""
        column, columns = LOOKUPS[table]
        names = CUSTOMER_PARTS if table == "gold.dim_customer" else (table,)
        dim, used = self.work.image(self.spark, table, until=day), [i for n in names for i in self.work.used(n, until=day)]
        if table in LATE and any(d > day for d in self.work.days(names[0])):
            newest = self.work.image(self.spark, table)
            if dim is not None:
                newest = dim.unionByName(newest.join(dim.select(column), column, "left_anti").select(*newest.columns))
            dim, used = newest, used + [i for n in names for i in self.work.used(n)]
        return dim, known_to_fit(sum(i.rows for i in used), max((i.longest or 0 for i in used), default=0), columns)

    def stored_transactions(self, day: str, keyed: bool) -> DataFrame:
        """The transactions of ``day``, ``keyed``: with the customer keys that their files hold."""
        name = "silver.transactions"
        txn = self.work._load(self.spark, name, [day])
        return self.work._files(self.spark, name, [day], (CUSTOMER_KEY,)).select(*txn.columns, CUSTOMER_KEY.name) if keyed else txn

    def facts(self, cal: tuple, limits: dict[str, float]) -> None:
        txn = self.stored_transactions(self.day, self.keyed)
        metrics = gold.fact_metrics(F.col("txn_date").between(F.lit(cal[0]), F.lit(cal[1])))
        _, seen = self.save_facts(txn, self.day, metrics)
        profile = {k: seen[k] or 0 for k in metrics}
        # the joins keep every transaction: as many facts as transactions of distinct ids are one fact an id
        many = self.work.images["silver.transactions", self.day].rows
        if profile["total_rows"] != many:
            many = self.work._load(self.spark, "gold.fact_transaction", [self.day]).select("transaction_id").distinct().count()
        self.profile("fact_quality", {**profile, "distinct_transactions": many}, "total_rows", limits)
        if profile["null_customer_key"] + profile["null_merchant_key"] or self.has_later_rows(self.day) or (MISSING, self.day) in self.lake.images:
            self.gaps.append(self.day)

    def has_later_rows(self, day: str) -> bool:
        """Whether a customer or merchant image of a later day may have filled keys of facts of ``day``."""
        return any(d > day for n in (CUSTOMER_PARTS[0], "gold.dim_merchant") for d in self.work.days(n))

    def save_missing(self, day: str) -> None:
        """The customer and merchant ids of the day's transactions that the images of the day do not have.

        One row per column, id and month with the first and last date, so that a
        row of a dimension that arrives later finds its facts without reading them.
        """
        s, keyed = self.spark, self.keyed and day == self.day and not self.has_later_rows(day)
        txn = self.stored_transactions(day, keyed)

        def missing() -> DataFrame:
            parts = []
            for table, column in (("gold.dim_customer", "customer_id"), ("gold.dim_merchant", "merchant_id")):
                rows = txn.where(F.col(column).isNotNull())
                if keyed and column == "customer_id":  # an id that was found under a key is not missing
                    rows = rows.where(F.col(CUSTOMER_KEY.name).isNull())
                known = self.work.image(s, table, until=day)
                if known is not None and self.lookup(table, day)[1]:
                    rows = rows.join(F.broadcast(known.select(column)), column, "left_anti")
                elif known is not None:  # ids meet, not rows
                    ids = self.scratch(rows.select(column).distinct().join(known.select(column).hint("merge"), column, "left_anti"))
                    rows = rows.join(checked_broadcast(ids), column, "left_semi")
                span = rows.groupBy(column, *MONTHS).agg(F.min("txn_date").alias("first_date"), F.max("txn_date").alias("last_date"))
                parts.append(span.select(
                    F.lit(column).alias("id_column"), F.col(column).alias("id"), *MONTHS, "first_date", "last_date"))
            return parts[0].unionByName(parts[1])

        self.save(MISSING, missing, day)

    def moved_versions(self) -> DataFrame | None:
        """(id, from_date, to_date): where the customer versions of the latest images differ from those before this load.

        A closed version lies in the image of the day that closed it, so only the
        closed images of this load and the current ones can differ.
        """
        current, closed = CUSTOMER_PARTS
        if not any((n, d) in self.made for n in CUSTOMER_PARTS for d in self.work.days(n)):
            return None
        days = [d for n, d in list(self.made) if n == closed]
        far, sides = F.lit(LATEST).cast("date"), []
        for lake in (self.lake, self.work):
            frames = [lake.image(self.spark, current), lake._load(self.spark, closed, sorted(d for d in days if (closed, d) in lake.images))]
            frames = [f.select("customer_id", "customer_key", "effective_start", "effective_end") for f in frames if f is not None]
            sides.append(functools.reduce(DataFrame.unionByName, frames) if frames else None)
        old, new = sides
        if old is None:
            old = new.limit(0)
        new = new.select("*", F.lit(True).alias("_new"), F.coalesce("effective_end", far).alias("_new_end"))
        old = old.select(
            F.col("customer_id").alias("_id"), F.col("customer_key").alias("_key"), F.col("effective_start").alias("_start"),
            F.lit(True).alias("_old"), F.coalesce("effective_end", far).alias("_old_end"))
        same = (F.col("customer_id") == F.col("_id")) & (F.col("customer_key") == F.col("_key")) & F.col("effective_start").eqNullSafe(F.col("_start"))
        both = new.join(old, same, "full_outer").where(~F.col("_new_end").eqNullSafe(F.col("_old_end")))
        kept = F.col("_new") & F.col("_old")
        return both.select(
            F.coalesce("customer_id", "_id").alias("id"),
            F.when(kept, F.date_add(F.least("_new_end", "_old_end"), 1)).otherwise(F.coalesce("effective_start", "_start")).alias("from_date"),
            F.greatest("_new_end", "_old_end").alias("to_date"),
        )

    def late_rows(self) -> None:
        """Facts of earlier days whose customer or merchant was unknown then and is another now: their months are built anew."""
        s, name = self.spark, "gold.fact_transaction"
        days = [d for d in self.lake.days(MISSING) if d < self.day and (name, d) not in self.made]
        versions = self.moved_versions()
        table = "gold.dim_merchant"
        merchants = None
        if any(n == table for n, _ in self.made):
            merchants = self.other_keys(table, "id", lambda d: d.select("merchant_id", "merchant_key"), None)
        if not days or (versions is None and merchants is None):
            return
        gaps = functools.reduce(DataFrame.unionByName, [self.lake._load(s, MISSING, [d]).withColumn("of", F.lit(d)) for d in days])
        hit = []
        if versions is not None:
            v = versions.select(F.col("id").alias("_id"), "from_date", "to_date")
            meets = (F.col("id") == F.col("_id")) & (F.col("from_date") <= F.col("last_date")) & (F.col("to_date") >= F.col("first_date"))
            hit.append(gaps.where("id_column = 'customer_id'").join(v, meets, "left_semi"))
        if merchants is not None:
            hit.append(gaps.where("id_column = 'merchant_id'").join(merchants, "id", "left_semi"))
        found: dict[str, list[tuple]] = {}
        for r in functools.reduce(DataFrame.unionByName, [h.select("of", *MONTHS) for h in hit]).distinct().collect():  # load days x months
            found.setdefault(r["of"], []).append((r[MONTHS[0]], r[MONTHS[1]]))
        for day, months in sorted(found.items()):
            txn = self.work._load(s, "silver.transactions", [day])
            self.save_facts(txn.where(_in_months(months)), day, kept=self.other_months(name, day, months))

    def spending(self, day: str) -> None:
        """The report states of a day."""
        fact = self.work._load(self.spark, "gold.fact_transaction", [day])
        spend, _ = self.save(SPEND, lambda: states.customer_spend(fact), day)
        self.save(TIER_CUSTOMERS, lambda: states.tier_bitmaps(spend, self.work.image(self.spark, "gold.dim_customer")), day)

    def summaries(self) -> None:
        """Missing ids and report states of every day whose facts this load wrote, and of no other day."""
        written = sorted(d for n, d in self.made if n == "gold.fact_transaction")
        with ThreadPoolExecutor(4) as pool:
            for step in [*(pool.submit(self.spending, d) for d in written), *(pool.submit(self.save_missing, d) for d in self.gaps)]:
                step.result()

    def other_keys(self, table: str, column: str, lookup: Callable[[DataFrame], DataFrame], day: str | None) -> DataFrame | None:
        """The values of ``column`` that facts of ``day`` (None: of the latest images) looked up under another key than they would now."""
        if self.work.used(table, until=day) == self.lake.used(table, until=day):
            return None
        now = lookup(self.work.image(self.spark, table, until=day))
        value, key = now.columns
        was = self.lake.image(self.spark, table, until=day)
        if was is None:
            return now.select(F.col(value).alias(column))
        old = lookup(was).select(F.col(value).alias("_value"), F.col(key).alias("_key"))
        both = now.join(old, F.col(value) == F.col("_value"), "full_outer").where(~F.col(key).eqNullSafe(F.col("_key")))
        return both.select(F.coalesce(value, "_value").alias(column))

    def later_facts(self) -> None:
        """Facts of other days whose ids this load moved or whose dimension rows it changed: their months are built anew."""
        name = "gold.fact_transaction"
        for day in [d for d in self.lake.days(name) if d >= self.day and (name, d) not in self.made]:
            held, txn = (t._load(self.spark, "silver.transactions", [day]) for t in (self.lake, self.work))
            merchants = self.other_keys("gold.dim_merchant", "merchant_id", lambda d: d.select("merchant_id", "merchant_key"), day)
            methods = self.other_keys("gold.dim_payment_method", "method_code", gold.payment_lookup, day)
            found = [*self.rekeyed, ("merchant_id", merchants), ("method_code", methods)]
            hit = [
                t.join(ids, column, "left_semi").select(*MONTHS)
                for column, ids in found if ids is not None for t in ((held, txn) if column == "transaction_id" else (txn,))
            ]
            months = _months(functools.reduce(DataFrame.unionByName, hit)) if hit else []
            if months:
                self.save_facts(txn.where(_in_months(months)), day, kept=self.other_months(name, day, months))
                self.gaps.append(day)

    def profile(self, name: str, counts: dict[str, int], total: str, fail_above: dict[str, float]) -> None:
        self.lake.quality.setdefault(self.day, {})[name] = counts
        for metric, share in fail_above.items():
            if counts.get(metric, 0) > share * counts[total]:
                raise DataQualityError(f"{self.day}: {metric} is {counts[metric]} of {counts[total]} rows, over {share:.2%}")


def _spliced(old: DataFrame | None, new: DataFrame, ids: DataFrame, natural: str) -> DataFrame:
    """``old`` with the rows of ``ids`` taken from ``new``."""
    part = new.join(ids, natural, "left_semi").select(*new.columns)
    return part if old is None else old.join(ids, natural, "left_anti").select(*new.columns).unionByName(part)


def _with_keys(rows: DataFrame, known: DataFrame, natural: str, key: str) -> DataFrame:
    """``rows`` with the surrogate keys that ``known`` has for their ids."""
    keys = known.select(F.col(natural).alias("_id"), F.col(key).alias("_key"))
    j = rows.join(keys, F.col(natural) == F.col("_id"), "left")
    return j.withColumn(key, F.coalesce("_key", key)).select(*rows.columns)


def _months(rows: DataFrame) -> list[tuple]:
    """The (year, month) that occur, some hundreds at most."""
    return [tuple(r) for r in rows.select(*MONTHS).distinct().collect()]


def _in_months(months: list[tuple]) -> Column:
    each = [F.col(MONTHS[0]).eqNullSafe(F.lit(y)) & F.col(MONTHS[1]).eqNullSafe(F.lit(m)) for y, m in months]
    return functools.reduce(lambda a, b: a | b, each)


def _folder(value: int | None) -> str:
    return "__HIVE_DEFAULT_PARTITION__" if value is None else str(value)


def load_day(
    spark: SparkSession,
    lake: Lakehouse,
    day: str,
    sources: set[str],
    rebalance: bool = True,
    fail_above: dict[str, float] | None = None,
    calendar: tuple[str, str] | None = None,
) -> Lakehouse:
    """One daily run over the feeds in ``sources`` landed in bronze for ``day``, which may be any day.

    ``rebalance``: size the month files of transactions and facts by a shuffle
    (without it they follow the tasks).  ``fail_above``: profile count -> largest
    share of the rows.  ``calendar``: its first and last day (default: the whole
    years of all transactions so far).

    The dimensions and the transactions are loaded side by side; only transactions of
    more customers than a broadcast takes wait for the customers.
    """
    run, limits = _Load(spark, lake, day, rebalance), fail_above or {}
    under_way: dict[str, Future] = {}
    steps = {
        "customers": lambda: run.customers(sources),
        "merchants": lambda: run.type1("merchants", "merchant"),
        "payment_methods": lambda: run.type1("payment_methods", "payment_method"),
        "transactions": lambda: run.transactions(limits, under_way["customers"].result if "customers" in sources else None),
    }
    with ThreadPoolExecutor(len(steps)) as pool:
        for source, f in steps.items():
            if source in sources:
                under_way[source] = pool.submit(f)
        for step in under_way.values():
            step.result()
    if "transactions" in sources:
        run.facts(run.calendar(calendar), limits)
    run.later_facts()
    run.late_rows()
    run.summaries()
    t = time.perf_counter()
    lake.commit(spark, list(run.made.values()))
    lake.seconds[f"catalog@{day}"] = time.perf_counter() - t
    return lake


DAY1_FEEDS = {"customers", "merchants", "payment_methods"}
DAY2_FEEDS = {"customers", "customer_updates", "merchants", "payment_methods", "transactions"}


def land_day1(spark: SparkSession, lake: Lakehouse, sf_dir: str) -> None:
    land(spark, lake, "customers", lambda: fixtures.raw_customers(spark, sf_dir, 1), DAY1)
    land(spark, lake, "merchants", lambda: fixtures.raw_merchants(spark, sf_dir, 1), DAY1)
    land(spark, lake, "payment_methods", lambda: fixtures.raw_payment_methods(spark, sf_dir, 1), DAY1)


def land_day2(spark: SparkSession, lake: Lakehouse, sf_dir: str, part: str = "all") -> None:
    """``part``: which transactions arrive, see ``fixtures.raw_transactions``."""
    land(spark, lake, "customers", lambda: fixtures.raw_customers(spark, sf_dir, 2), DAY2)
    land(spark, lake, "customer_updates", lambda: fixtures.raw_customer_updates(spark, sf_dir), DAY2)
    land(spark, lake, "merchants", lambda: fixtures.raw_merchants(spark, sf_dir, 2), DAY2)
    land(spark, lake, "payment_methods", lambda: fixtures.raw_payment_methods(spark, sf_dir, 2), DAY2)
    land(spark, lake, "transactions", lambda: fixtures.raw_transactions(spark, sf_dir, part), DAY2)


def run_pipeline(spark: SparkSession, sf_dir: str, root: str | None = None, part: str = "all", **options) -> Lakehouse:
    """The two-day scenario over the test tables in ``sf_dir`` (see module docstring; ``options``: of ``load_day``)."""
    lake = Lakehouse(root or new_table_path(spark, "lakehouse"))
    d = sf_dir.rstrip("/")
    land_day1(spark, lake, d)
    load_day(spark, lake, DAY1, DAY1_FEEDS, **options)
    land_day2(spark, lake, d, part)
    return load_day(spark, lake, DAY2, DAY2_FEEDS, **options)


# (layer, table, lakehouse entry) reported by ``layer_counts``; bronze counts
# are the rows landed on day 2.
LAYER_TABLES = [
    ("bronze", "raw_customers", "bronze.customers"),
    ("bronze", "raw_customer_updates", "bronze.customer_updates"),
    ("bronze", "raw_merchants", "bronze.merchants"),
    ("bronze", "raw_payment_methods", "bronze.payment_methods"),
    ("bronze", "raw_transactions", "bronze.transactions"),
    ("silver", "customers", "silver.customers"),
    ("silver", "merchants", "silver.merchants"),
    ("silver", "payment_methods", "silver.payment_methods"),
    ("silver", "transactions", "silver.transactions"),
    ("gold", "dim_customer", "gold.dim_customer"),
    ("gold", "dim_merchant", "gold.dim_merchant"),
    ("gold", "dim_payment_method", "gold.dim_payment_method"),
    ("gold", "dim_date", "gold.dim_date"),
    ("gold", "fact_transaction", "gold.fact_transaction"),
]


def layer_counts(frames: dict[str, DataFrame]) -> DataFrame:
    """(layer, table_name, row_count) for every table, as one union of aggregates."""
    out = None
    for layer, name, entry in LAYER_TABLES:
        c = frames[entry].agg(
            F.lit(layer).alias("layer"), F.lit(name).alias("table_name"),
            F.count(F.lit(1)).cast("bigint").alias("row_count"),
        )
        out = c if out is None else out.unionByName(c)
    return out


def lakehouse_frames(spark: SparkSession, lake: Lakehouse) -> dict[str, DataFrame]:
    frames = {}
    for _, _, entry in LAYER_TABLES:
        if entry.startswith("bronze."):
            frames[entry] = read_bronze(spark, f"{lake.root}/bronze", entry.split(".", 1)[1], DAY2)
        else:
            frames[entry] = lake.read(spark, entry)
    return frames
