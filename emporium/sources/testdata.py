"""Adapter: the driver's TPC-H-style tables re-shaped into the 14 raw shop tables.

Every mapping is a deterministic projection (plus two aggregates: refunds per
order and sessions per user-day), so the same rules can be written in plain SQL
for the oracle. Two load batches are modelled:

* ``b1``  - the initial extract (loaded ``LOAD_1``);
* ``current`` - the landed state after the second extract (``LOAD_2``), i.e.
  what an upsert of batch 2 onto batch 1 by primary key yields. It is written
  in closed form so models read one projection, not a landing merge.
* ``b2`` - the second extract itself, for the landing/upsert/snapshot jobs.

app_db tables are full extracts (rows can vanish: hard deletes); shopify,
stripe and web tables are incremental (late rows and status updates).

A few traps are planted so that checks have something to find: product
categories outside the declared list, and order items of unknown orders.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from emporium.session import landed
from emporium.sources.schemas import RAW_SCHEMAS

# Declared schemas of the driver's tables (as written in the Parquet files);
# declaring them skips the footer-inference job on every read.
DRIVER_SCHEMAS = {
    "region": "r_regionkey int, r_name string",
    "nation": "n_nationkey int, n_name string, n_regionkey int",
    "customer": "c_custkey bigint, c_name string, c_nationkey int, c_acctbal double, c_mktsegment string",
    "part": "p_partkey bigint, p_name string, p_brand string, p_type string, p_size int, p_retailprice double",
    "orders": ("o_orderkey bigint, o_custkey bigint, o_orderstatus string, o_totalprice double, "
               "o_orderdate timestamp_ntz, o_orderpriority string"),
    "lineitem": ("l_orderkey bigint, l_partkey bigint, l_suppkey bigint, l_linenumber int, l_quantity double, "
                 "l_extendedprice double, l_discount double, l_tax double, l_returnflag string, "
                 "l_linestatus string, l_shipdate timestamp_ntz"),
    "events": "event_id bigint, ts timestamp_ntz, user_id bigint, event_type string, value double, props string",
}

# ---- fixed values of the adapter (the SQL oracle repeats them verbatim) ----
LOAD_1 = "2024-06-01 06:00:00"
LOAD_2 = "2024-06-16 06:00:00"
YEAR_SHIFT = 24                          # order/ship dates 1995-2001 -> 2019-2025,
                                         # so orders overlap the date spine and web sessions
ORDER_CUTOFF = "2024-01-01 00:00:00"     # orders dated on/after arrive in batch 2
ORDER_LATE_FROM = "2023-12-22 00:00:00"  # key % 7 = 0 in [late_from, cutoff) arrive late
ORDER_UPDATE_FROM = "2023-12-29 00:00:00"  # pending, key % 3 = 0 -> completed in batch 2
WEB_CUTOFF = "2024-01-20 00:00:00"
WEB_LATE_FROM = "2024-01-17 00:00:00"    # event_id % 9 = 0 in [late_from, cutoff) arrive late
USER_CHANGED_AT = "2024-06-10 12:00:00"
PRODUCT_CHANGED_AT = "2024-06-12 08:00:00"
USERS_CREATED_FROM = "2022-01-01 00:00:00"
PRODUCTS_CREATED_FROM = "2021-01-01 00:00:00"
EVENT_TYPES = {"view": "Page_View", "click": "Product_Click", "signup": "Add_To_Cart",
               "error": "Checkout", "purchase": "Purchase"}
CHANNELS = ["Organic_Search", "Paid_Search", "Direct", "Email", "Social", "Referral"]
DEVICES = ["Desktop", "Mobile", "Tablet"]
PAYMENT_METHODS = ["credit_card", "PayPal", "gift_card", "Bank_Transfer"]
CURRENCIES = ["USD", "eur", "Gbp"]
DISPUTE_STATUSES = ["Under_Review", "Won", "Lost"]
CATEGORIES = ["Electronics", "Accessories", "Lifestyle"]
STRAY_CATEGORY_EVERY = 97     # p_partkey % 97 = 0: a category outside the declared ones
ORPHAN_EVERY = 211            # items of orders with l_orderkey % 211 = 0 point to no order

STATES = ("b1", "b2", "current")


def _ts(s: str) -> Column:
    return F.lit(s).cast("timestamp_ntz")


def _raw_ts(s: str) -> Column:
    """A shifted-domain cutoff in the unshifted domain. Shifting by whole
    years is monotone, so ``shifted < c`` iff ``raw < c - shift`` for the
    cutoffs used here (none is on 29 February)."""
    return _ts(f"{int(s[:4]) - YEAR_SHIFT:04d}{s[4:]}")


def _add(ts: Column, unit: str, n: Column | int) -> Column:
    return F.timestamp_add(unit, n if isinstance(n, Column) else F.lit(n), ts)


def _pick(values: list[str], idx: Column) -> Column:
    out = None
    for i, v in enumerate(values):
        out = (F.when(idx == i, F.lit(v)) if out is None else out.when(idx == i, F.lit(v)))
    return out


def shift_orders(raw_orders: DataFrame) -> DataFrame:
    """Driver orders with dates moved by ``YEAR_SHIFT``; the unshifted date
    stays as ``raw_orderdate`` for pushed-down batch filters."""
    return (raw_orders.withColumn("raw_orderdate", F.col("o_orderdate"))
            .withColumn("o_orderdate", _add(F.col("o_orderdate"), "YEAR", YEAR_SHIFT)))


class LazyTables(dict):
    """Mapping that builds each DataFrame on first access.

    Building a DataFrame triggers analysis on the JVM; a query that touches
    three tables should not pay for fourteen.
    """

    def __init__(self, names, build):
        super().__init__()
        self._names = list(names)
        self._build = build

    def __missing__(self, key):
        if key not in self._names:
            raise KeyError(key)
        df = self[key] = self._build(key)
        return df

    def keys(self):
        return list(self._names)

    def __iter__(self):
        return iter(self._names)

    def __len__(self):
        return len(self._names)

    def __contains__(self, key):
        return key in self._names

    def get(self, key, default=None):
        return self[key] if key in self._names else default

    def items(self):
        return [(k, self[k]) for k in self._names]

    def values(self):
        return [self[k] for k in self._names]


def _memo(fn):
    """Cache a derived frame per (method, args) when built from the source
    files (``raw`` not given): shared intermediates are built once, and
    identical subplans let Spark reuse their exchanges."""
    def wrapper(self, *args, raw: DataFrame | None = None):
        if raw is not None:
            return fn(self, *args, raw=raw)
        key = (fn.__name__, args)
        if key not in self._frames:
            self._frames[key] = fn(self, *args)
        return self._frames[key]
    wrapper.__name__ = fn.__name__
    return wrapper


def _finish(df: DataFrame, table: str) -> DataFrame:
    return df.select(*[F.col(f.name).cast(f.dataType) for f in RAW_SCHEMAS[table].fields])


class TestdataSource:
    """Raw shop tables derived from ``sf_dir``; every method is lazy."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark = spark
        self.sf_dir = sf_dir.rstrip("/")
        self._reads: dict[str, DataFrame] = {}
        self._frames: dict[tuple, DataFrame] = {}

    def read(self, name: str) -> DataFrame:
        if name not in self._reads:
            self._reads[name] = self._read(name)
        return self._reads[name]

    def _read(self, name: str) -> DataFrame:
        reader = self.spark.read
        if name in DRIVER_SCHEMAS:
            reader = reader.schema(DRIVER_SCHEMAS[name])
        df = reader.parquet(f"{self.sf_dir}/{name}.parquet")
        # the unshifted column is kept so that batch filters can be stated on
        # it and reach the Parquet reader as pushed filters
        if name == "orders":
            df = shift_orders(df)
        elif name == "lineitem":
            df = (df.withColumn("raw_shipdate", F.col("l_shipdate"))
                  .withColumn("l_shipdate", _add(F.col("l_shipdate"), "YEAR", YEAR_SHIFT)))
            # (order, line) repeats in the data: an ordinal over all columns makes it a key. Equal rows are
            # interchangeable. Where no id is asked for, the optimizer drops this window.
            same = W.partitionBy("l_orderkey", "l_linenumber").orderBy(*[F.col(c.split()[0]) for c in DRIVER_SCHEMAS["lineitem"].split(", ")])
            df = df.withColumn("line_id", (F.col("l_orderkey") * 1000 + F.col("l_linenumber")) * 1000 + F.row_number().over(same) - 1)
        return df

    def table(self, name: str, state: str = "current") -> DataFrame:
        if state not in STATES:
            raise ValueError(f"state {state!r} is none of {STATES}")
        return _finish(getattr(self, f"_{name}")(state), name)

    def orders_from(self, raw_orders: DataFrame, state: str = "current") -> DataFrame:
        """Shop orders of a state from a driver ``orders`` frame - batch or
        streaming; the year shift is applied here."""
        return _finish(self._orders(state, shift_orders(raw_orders)), "orders")

    def payments_from(self, raw_orders: DataFrame, state: str = "current") -> DataFrame:
        """Stripe payments of a state from a driver ``orders`` frame."""
        return _finish(self._payments(state, raw=shift_orders(raw_orders)), "payments")

    def visitor_events(self, raw_events: DataFrame) -> DataFrame:
        """Events keyed by visitor with shop event types - batch or streaming."""
        return self._events_state("current", raw=raw_events)

    def tables(self, state: str = "current") -> "LazyTables":
        return LazyTables(RAW_SCHEMAS, lambda t: self.table(t, state))

    def tables_cache(self, state: str = "current") -> "LazyTables":
        """The same lazy table set for every caller of this source and state."""
        key = ("__tables__", state)
        if key not in self._frames:
            self._frames[key] = self.tables(state)
        return self._frames[key]

    def land(self, root: str, state: str = "current") -> None:
        """Write what takes more than a projection, once, into folders of
        ``root``: items with their ids, refunds, sessions and page views.
        Tables of the state that are asked for from then on read them from there."""
        tables = self.tables_cache(state)
        frames = {"lineitem": self.read("lineitem").drop("l_discount", "l_tax", "l_linestatus"),  # no shop table has these
                  "refunds": self._refund_base(), "sessions": tables["sessions"], "page_views": tables["page_views"]}
        written = landed({f"{root}/{name}": df for name, df in frames.items()})
        self._reads["lineitem"], self._frames["_refund_base", ()] = written[f"{root}/lineitem"], written[f"{root}/refunds"]
        tables |= {name: written[f"{root}/{name}"] for name in ("sessions", "page_views")}

    def load_times(self, state: str = "current") -> "LazyTables":
        """Only the load time of every row of each table; page views need no next event for it."""
        def times(name: str) -> DataFrame:
            if name == "page_views":
                return self._events_state(state).where(F.col("mapped_type") == "Page_View").select("_etl_loaded_at")
            return getattr(self, f"_{name}")(state).select("_etl_loaded_at")
        return LazyTables(RAW_SCHEMAS, times)

    # ---------------------------------------------------------------- app_db
    def _users(self, state):
        c = self.read("customer")
        k = F.col("c_custkey")
        changed = (k % 10 == 3) & F.lit(state != "b1")
        created = _add(_ts(USERS_CREATED_FROM), "DAY", k % 365)
        base_tier = (F.when(F.col("c_acctbal") < 0, "Bronze")
                     .when(F.col("c_acctbal") < 5000, "Silver").otherwise("Gold"))
        keep = (k % 25 != 24) if state == "b1" else (k % 100 != 98)
        return c.where(keep).select(
            k.alias("user_id"),
            F.when(k % 23 == 5, F.lit(None).cast("string"))
             .otherwise(F.concat(F.lit("user"), k.cast("string"), F.lit("@shop.test"))).alias("email"),
            F.col("c_name").alias("name"),
            F.when(changed, F.lit("Gold")).otherwise(base_tier).alias("tier"),
            created.alias("created_at"),
            F.when(changed, _ts(USER_CHANGED_AT)).otherwise(created).alias("updated_at"),
            (k % 50 == 7).alias("is_deleted"),
            _ts(LOAD_1 if state == "b1" else LOAD_2).alias("_etl_loaded_at"))

    def _addresses(self, state):
        # nation (25 rows) and region (5 rows) are fixed-size dimensions:
        # broadcasting them is bounded regardless of scale.
        c = self.read("customer").select("c_custkey", "c_nationkey")
        geo = (self.read("nation").join(F.broadcast(self.read("region")),
                                        F.col("n_regionkey") == F.col("r_regionkey"))
               .select("n_nationkey", "n_name", "r_name"))
        base = c.join(F.broadcast(geo), F.col("c_nationkey") == F.col("n_nationkey"))
        k = F.col("c_custkey")
        loaded = _ts(LOAD_1 if state == "b1" else LOAD_2)

        def addr(suffix: int, street: str, default: bool):
            return base.select(
                (k * 10 + suffix).alias("address_id"), k.alias("user_id"),
                F.concat(k.cast("string"), F.lit(street)).alias("street"),
                F.col("n_name").alias("city"), F.col("r_name").alias("state"),
                F.lpad((k % 100000).cast("string"), 5, "0").alias("zip"),
                F.lower("n_name").alias("country"), F.lit(default).alias("is_default"),
                loaded.alias("_etl_loaded_at"))

        return addr(1, " Main St", True).unionByName(
            addr(2, " Side Ave", False).where(k % 4 == 0))

    def _products(self, state):
        p = self.read("part")
        k = F.col("p_partkey")
        changed = (k % 10 == 7) & F.lit(state != "b1")
        created = _add(_ts(PRODUCTS_CREATED_FROM), "DAY", k % 500)
        cents = F.round(F.col("p_retailprice") * 100).cast("bigint")
        out = p if state == "b1" else p.where(k % 100 != 97)
        return out.select(
            k.alias("product_id"), F.col("p_name").alias("name"), F.when(k % STRAY_CATEGORY_EVERY == 0, F.col("p_type")).otherwise(_pick(CATEGORIES, k % 3)).alias("category"),
            F.when(changed, cents + 100).otherwise(cents).alias("price_cents"),
            created.alias("created_at"),
            F.when(changed, _ts(PRODUCT_CHANGED_AT)).otherwise(created).alias("updated_at"),
            (F.col("p_size") == 1).alias("is_deleted"),
            _ts(LOAD_1 if state == "b1" else LOAD_2).alias("_etl_loaded_at"))

    def _inventory(self, state):
        li = self.read("lineitem")
        if state == "b1":
            li = li.where(F.col("raw_shipdate") < _raw_ts(ORDER_CUTOFF))
        return li.select(
            F.col("line_id").alias("inventory_id"),
            F.col("l_partkey").alias("product_id"),
            F.concat(F.lit("WH-"), F.col("l_suppkey").cast("string")).alias("warehouse_location"),
            F.when(F.col("l_returnflag") == "R", F.lit(0))
             .otherwise(F.col("l_quantity").cast("bigint")).alias("quantity"),
            _add(F.col("l_shipdate"), "HOUR", F.col("l_linenumber")).alias("updated_at"),
            _ts(LOAD_1 if state == "b1" else LOAD_2).alias("_etl_loaded_at"))

    # --------------------------------------------------------------- shopify
    @_memo
    def _order_flags(self, raw: DataFrame | None = None):
        o = self.read("orders") if raw is None else raw
        k, d = F.col("o_orderkey"), F.col("o_orderdate")
        base_status = (F.when(F.col("o_orderstatus") == "F", "Completed")
                       .when(F.col("o_orderstatus") == "P", "Returned")
                       .when(k % 5 == 0, "Cancelled").otherwise("Pending"))
        late = (d >= _ts(ORDER_LATE_FROM)) & (d < _ts(ORDER_CUTOFF)) & (k % 7 == 0)
        update = ((d >= _ts(ORDER_UPDATE_FROM)) & (d < _ts(ORDER_CUTOFF)) & (k % 7 != 0)
                  & (k % 3 == 0) & (base_status == "Pending"))
        return o.select("*", base_status.alias("base_status"), late.alias("is_late"),
                        update.alias("is_update"))

    @_memo
    def _orders_state(self, state, raw: DataFrame | None = None):
        """Orders of a state with the status/updated_at/loaded_at valid in it."""
        o = self._order_flags(raw=raw)
        d = F.col("o_orderdate")
        in_b1 = (d < _ts(ORDER_CUTOFF)) & ~F.col("is_late")
        in_b2 = (d >= _ts(ORDER_CUTOFF)) | F.col("is_late") | F.col("is_update")
        if state == "b1":
            o = (o.where(F.col("raw_orderdate") < _raw_ts(ORDER_CUTOFF)).where(in_b1)
                 .withColumn("is_update", F.lit(False)))
        elif state == "b2":
            o = o.where(F.col("raw_orderdate") >= _raw_ts(ORDER_LATE_FROM)).where(in_b2)
        updated = F.col("is_update")
        return o.select(
            "*",
            F.when(updated, F.lit("Completed")).otherwise(F.col("base_status")).alias("status"),
            F.when(updated, _add(d, "HOUR", 80))
             .otherwise(_add(d, "HOUR", F.col("o_orderkey") % 72)).alias("order_updated_at"),
            F.when(in_b2 & F.lit(state != "b1"), _ts(LOAD_2)).otherwise(_ts(LOAD_1))
             .alias("_etl_loaded_at"))

    def _orders(self, state, raw: DataFrame | None = None):
        k = F.col("o_orderkey")
        return self._orders_state(state, raw=raw).select(
            k.alias("order_id"), F.col("o_custkey").alias("customer_id"),
            F.col("o_orderdate").alias("order_date"), "status",
            F.round(F.col("o_totalprice") * 100).cast("bigint").alias("total_amount_cents"),
            (F.col("o_custkey") * 10 + 1).alias("shipping_address_id"),
            "order_updated_at", "_etl_loaded_at")

    def _order_items(self, state):
        li = self.read("lineitem")
        late_item = F.col("l_shipdate") >= _ts(ORDER_CUTOFF)
        if state == "b1":
            li = li.where(F.col("raw_shipdate") < _raw_ts(ORDER_CUTOFF))
        elif state == "b2":
            li = li.where(F.col("raw_shipdate") >= _raw_ts(ORDER_CUTOFF))
        return li.select(
            F.col("line_id").alias("order_item_id"),
            F.when(F.col("l_orderkey") % ORPHAN_EVERY == 0, -1 - F.col("l_orderkey")).otherwise(F.col("l_orderkey")).alias("order_id"), F.col("l_partkey").alias("product_id"),
            F.col("l_quantity").cast("bigint").alias("quantity"),
            F.round(F.col("l_extendedprice") * 100 / F.col("l_quantity")).cast("bigint")
             .alias("unit_price_cents"),
            F.when(late_item, _ts(LOAD_2)).otherwise(_ts(LOAD_1)).alias("_etl_loaded_at"))

    @_memo
    def _refund_base(self):
        """One refund per order that has returned line items (partial agg before shuffle)."""
        li = self.read("lineitem").where(F.col("l_returnflag") == "R")
        agg = li.groupBy("l_orderkey").agg(
            F.sum(F.round(F.col("l_extendedprice") * 100).cast("bigint")).alias("cents"),
            F.max("l_shipdate").alias("last_ship"))
        k = F.col("l_orderkey")
        return agg.select(
            k.alias("order_id"),
            F.when(k % 2 == 0, "customer_request").otherwise("defective_product").alias("reason"),
            F.when(k % 101 == 0, -F.col("cents")).otherwise(F.col("cents")).alias("cents"),
            _add(F.col("last_ship"), "DAY", 7).alias("refunded_at"))

    def _refunds_of(self, state):
        """Refunds whose order is there: batch 1 has those of its orders, batch 2 all others."""
        r = self._refund_base()
        if state == "current":
            return r
        first = self._orders_state("b1").select(F.col("o_orderkey").alias("order_id"))
        return r.join(first, "order_id", "left_semi" if state == "b1" else "left_anti")

    @staticmethod
    def _refund_load(state):
        if state != "current":
            return _ts(LOAD_1 if state == "b1" else LOAD_2)
        return F.when(F.col("refunded_at") >= _ts(ORDER_CUTOFF), _ts(LOAD_2)).otherwise(_ts(LOAD_1))

    def _shopify_refunds(self, state):
        r = self._refunds_of(state)
        return r.select(F.col("order_id").alias("refund_id"), "order_id", "reason",
                        F.col("cents").alias("refund_amount_cents"), "refunded_at",
                        self._refund_load(state).alias("_etl_loaded_at"))

    # ---------------------------------------------------------------- stripe
    @_memo
    def _payments(self, state, raw: DataFrame | None = None):
        o = self._orders_state(state, raw=raw)
        k = F.col("o_orderkey")
        cents = F.round(F.col("o_totalprice") * 100).cast("bigint")
        pay_status = (F.when(F.col("status") == "Completed", "Succeeded")
                      .when(F.col("status") == "Pending", "Pending")
                      .when(F.col("status") == "Returned", "Refunded").otherwise("Failed"))
        return o.select(
            k.alias("payment_id"), k.alias("order_id"),
            (cents - F.when(k % 97 == 0, 1).otherwise(0)).alias("amount_cents"),
            F.when(k % 1000 == 999, F.lit("XYZ")).otherwise(_pick(CURRENCIES, k % 3)).alias("currency"),
            pay_status.alias("status"),
            _pick(PAYMENT_METHODS, k % 4).alias("payment_method"),
            _add(F.col("o_orderdate"), "HOUR", 1).alias("created_at"),
            "_etl_loaded_at")

    def _charges(self, state):
        p = self._payments(state)
        return p.select(
            (F.col("payment_id") * 10 + 1).alias("charge_id"), "payment_id", "amount_cents",
            "currency", "status", _add(F.col("created_at"), "MINUTE", 1).alias("created_at"),
            "_etl_loaded_at")

    def _stripe_refunds(self, state):
        r = self._refunds_of(state).where(F.col("order_id") % 10 != 3)
        k = F.col("order_id")
        return r.select(
            (k * 10 + 2).alias("refund_id"), (k * 10 + 1).alias("charge_id"),
            (F.abs("cents") + F.when(k % 10 == 4, 100).otherwise(0)).alias("amount_cents"),
            "reason", F.lit("Succeeded").alias("status"),
            _add(F.col("refunded_at"), "HOUR", 1).alias("created_at"),
            self._refund_load(state).alias("_etl_loaded_at"))

    def _disputes(self, state):
        p = self._payments(state).where(F.col("order_id") % 50 == 0)
        k = F.col("order_id")
        return p.select(
            (k * 10 + 3).alias("dispute_id"), (k * 10 + 1).alias("charge_id"), "amount_cents",
            F.lit("fraudulent").alias("reason"), _pick(DISPUTE_STATUSES, k % 3).alias("status"),
            _add(F.col("created_at"), "DAY", 3).alias("created_at"), "_etl_loaded_at")

    # --------------------------------------------------------- web analytics
    @_memo
    def _events_state(self, state, raw: DataFrame | None = None):
        e = self.read("events") if raw is None else raw
        ts = F.col("ts")
        late = (ts >= _ts(WEB_LATE_FROM)) & (ts < _ts(WEB_CUTOFF)) & (F.col("event_id") % 9 == 0)
        in_b1 = (ts < _ts(WEB_CUTOFF)) & ~late
        if state == "b1":
            e = e.where(in_b1)
        elif state == "b2":
            e = e.where(~in_b1)
        uid = F.col("user_id")
        etype = None
        for src, dst in EVENT_TYPES.items():
            cond = F.col("event_type") == src
            etype = F.when(cond, F.lit(dst)) if etype is None else etype.when(cond, F.lit(dst))
        return e.select(
            "event_id", "ts", uid.alias("visitor_id"),
            F.concat(F.lit("S"), uid.cast("string"), F.lit("-"),
                     F.date_format(ts, "yyyy-MM-dd")).alias("session_id"),
            etype.alias("mapped_type"),
            F.concat(F.lit("/page/"), F.get_json_object("props", "$.k")).alias("page_url"),
            F.when(in_b1, _ts(LOAD_1)).otherwise(_ts(LOAD_2)).alias("_etl_loaded_at"))

    def _events(self, state):
        e = self._events_state(state)
        return e.select(F.concat(F.lit("E"), F.col("event_id").cast("string")).alias("event_id"),
                        "session_id", F.col("mapped_type").alias("event_type"),
                        F.col("ts").alias("event_timestamp"), "page_url", "_etl_loaded_at")

    def _sessions(self, state):
        # A session is one visitor-day. Plain aggregate: partial combine
        # before the shuffle keeps a hot visitor from overloading one task.
        e = self._events_state(state)
        s = e.groupBy("session_id", "visitor_id").agg(
            F.min("ts").alias("session_start"), F.max("ts").alias("session_end"),
            F.min_by("page_url", "ts").alias("landing_page"),
            F.max("_etl_loaded_at").alias("_etl_loaded_at"))
        v = F.col("visitor_id")
        return s.select(
            "session_id",
            F.when(v % 10 == 0, F.lit(None).cast("bigint")).otherwise(v).alias("user_id"),
            "session_start", "session_end",
            _pick(DEVICES, v % 3).alias("device_type"), _pick(CHANNELS, v % 6).alias("channel"),
            "landing_page", "_etl_loaded_at")

    def _page_views(self, state):
        from emporium.operators.sequence import next_in_group

        e = self._events_state(state)
        nxt = next_in_group(e, ["session_id"], "ts", "event_id")
        dur = F.floor(F.timestamp_diff("MICROSECOND", F.col("ts"), F.col("next_ts")) / F.lit(1e6))
        return nxt.where(F.col("mapped_type") == "Page_View").select(
            F.concat(F.lit("PV"), F.col("event_id").cast("string")).alias("page_view_id"),
            "session_id", "page_url", F.col("ts").alias("view_timestamp"),
            F.coalesce(dur.cast("bigint"), F.lit(0).cast("bigint")).alias("duration_seconds"),
            "_etl_loaded_at")

