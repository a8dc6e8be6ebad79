"""Derived views over the TPC-H-style tables that give the hand-over operators a churn-shaped table.

``customer_snapshot``: one row per customer as of a cut-off date. The target is 1 when the customer
places no order on or after the cut-off; every feature is measured from orders strictly before it,
so the label cannot leak into recency. Customers with no earlier order have real NULL features.

Each view is written twice: as DataFrame code (what the library runs) and as plain SQL (what the
oracle runs in another engine). Money is summed in DECIMAL so both engines get identical values.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from handoff.config import Config
from handoff.functions.columns import knuth_hash, pseudo_score

CUTOFF = "2000-08-01"

SNAPSHOT_CONFIG = Config(
    primary_key="customer_id",
    target="churned",
    protected=("nation",),
    # Raw spellings of the derived raw view and their canonical forms.
    entity_map={
        "segment": {"AUTO": "AUTOMOBILE", "BLDG": "BUILDING", "FURN": "FURNITURE", "HH": "HOUSEHOLD", "MACH": "MACHINERY"},
        "payment_mode": {"URGENT": "1-URGENT", "HIGH": "2-HIGH"},
    },
    units={"tenure_months": "months", "days_since_last": "days", "cashback": "USD", "account_balance": "USD"},
    int_columns=("customer_id", "churned", "region_key", "returned"),
    categorical_extra=("region_key",),
    seed=42,
)
# Engineered-feature sources, in the roles the churn features give them.
FEATURE_SOURCES = {
    "cashback": "cashback",
    "orders": "order_count",
    "tenure": "tenure_months",
    "coupons": "coupon_used",
    "recency": "days_since_last",
}
# Data dictionary of the snapshot (what a dictionary sheet would hold for it).
SNAPSHOT_DESCRIPTIONS = {
    "customer_id": "customer key",
    "churned": "1 when the customer places no order on or after the cut-off",
    "tenure_months": "whole 30-day months from the first order to the cut-off",
    "segment": "market segment",
    "region_key": "region of the customer's nation",
    "nation": "nation of the customer",
    "account_balance": "account balance",
    "payment_mode": "priority of the latest order before the cut-off",
    "order_count": "orders before the cut-off",
    "coupon_used": "order lines with a discount above 5 % before the cut-off",
    "days_since_last": "days from the latest order to the cut-off",
    "cashback": "sum of price x discount over order lines before the cut-off",
    "returned": "1 when any order line before the cut-off was returned",
}
TENURE_EDGES = (-0.5, 1.5, 6.5, 12.5, float("inf"))
TENURE_LABELS = ("0-1", "2-6", "7-12", "13+")
FLAG_COLUMN = "returned"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def customer_snapshot(spark: SparkSession, sf_dir: str, cutoff: str = CUTOFF) -> DataFrame:
    """One row per customer as of ``cutoff`` (see module doc).

    Plan: lineitem collapses to one row per order (map-side partial aggregation), is joined to
    orders on the order key, and ONE conditional aggregate per customer yields every order-based
    feature and the label (a single scan of orders); nation is small enough for the planner to broadcast.
    """
    cut = F.lit(cutoff).cast("timestamp_ntz")
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_orderdate", "o_orderpriority")
    per_order = table(spark, sf_dir, "lineitem").groupBy("l_orderkey").agg(
        F.sum(F.col("l_extendedprice").cast("decimal(15,2)") * F.col("l_discount").cast("decimal(15,2)")).alias("cb"),
        F.count_if(F.col("l_discount") > 0.05).alias("coupons"),
        F.max(F.when(F.col("l_returnflag") == "R", 1).otherwise(0)).alias("ret"),
    )
    pre = F.col("o_orderdate") < cut
    per_customer = orders.join(per_order, F.col("o_orderkey") == F.col("l_orderkey"), "left").groupBy(
        F.col("o_custkey").alias("c_custkey")
    ).agg(
        F.count_if(pre).alias("n_pre"),
        F.min(F.when(pre, F.col("o_orderdate"))).alias("first_order"),
        F.max(F.when(pre, F.col("o_orderdate"))).alias("last_order"),
        # latest earlier order, ties by the highest order key (NULL orderings are skipped)
        F.max_by(F.col("o_orderpriority"), F.when(pre, F.struct("o_orderdate", "o_orderkey"))).alias("payment_mode"),
        F.sum(F.when(pre, F.col("cb"))).alias("cb"),
        F.sum(F.when(pre, F.col("coupons"))).alias("coupons"),
        F.max(F.when(pre, F.col("ret"))).alias("ret"),
        F.max(F.when(~pre, F.lit(1))).alias("_later"),
    )
    nation = table(spark, sf_dir, "nation")
    cust = table(spark, sf_dir, "customer").join(nation, F.col("c_nationkey") == F.col("n_nationkey"))
    has = F.col("n_pre") > 0
    return (
        cust.join(per_customer, "c_custkey", "left")
        .select(
            F.col("c_custkey").alias("customer_id"),
            F.when(F.col("_later").isNull(), 1).otherwise(0).alias("churned"),
            F.floor(F.datediff(cut.cast("date"), F.col("first_order").cast("date")) / 30.0).cast("double").alias("tenure_months"),
            F.col("c_mktsegment").alias("segment"),
            F.col("n_regionkey").alias("region_key"),
            F.col("n_name").alias("nation"),
            F.col("c_acctbal").alias("account_balance"),
            F.col("payment_mode"),
            F.when(has, F.col("n_pre")).cast("double").alias("order_count"),
            F.when(has, F.coalesce(F.col("coupons"), F.lit(0))).cast("double").alias("coupon_used"),
            F.datediff(cut.cast("date"), F.col("last_order").cast("date")).cast("double").alias("days_since_last"),
            F.when(has, F.coalesce(F.col("cb"), F.lit(0))).cast("double").alias("cashback"),
            F.coalesce(F.col("ret"), F.lit(0)).alias("returned"),
        )
    )


SNAPSHOT_SQL = f"""
snap AS (
  WITH pre AS (
    SELECT o_orderkey, o_custkey, o_orderdate, o_orderpriority FROM orders
    WHERE o_orderdate < TIMESTAMP '{CUTOFF}'),
  later AS (SELECT DISTINCT o_custkey AS c_custkey FROM orders WHERE o_orderdate >= TIMESTAMP '{CUTOFF}'),
  ranked AS (
    SELECT o_custkey, o_orderpriority,
           row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate DESC, o_orderkey DESC) AS rn
    FROM pre),
  per_customer AS (
    SELECT p.o_custkey AS c_custkey, count(*) AS n_orders, min(o_orderdate) AS first_order,
           max(o_orderdate) AS last_order,
           (SELECT r.o_orderpriority FROM ranked r WHERE r.o_custkey = p.o_custkey AND r.rn = 1) AS payment_mode
    FROM pre p GROUP BY p.o_custkey),
  per_line AS (
    SELECT p.o_custkey AS c_custkey,
           sum(CAST(l_extendedprice AS DECIMAL(15,2)) * CAST(l_discount AS DECIMAL(15,2))) AS cb,
           count(*) FILTER (WHERE l_discount > 0.05) AS coupons,
           max(CASE WHEN l_returnflag = 'R' THEN 1 ELSE 0 END) AS ret
    FROM lineitem l JOIN pre p ON l.l_orderkey = p.o_orderkey GROUP BY p.o_custkey)
  SELECT c.c_custkey AS customer_id,
         CASE WHEN lt.c_custkey IS NULL THEN 1 ELSE 0 END AS churned,
         CAST(floor(date_diff('day', CAST(pc.first_order AS DATE), DATE '{CUTOFF}') / 30.0) AS DOUBLE) AS tenure_months,
         c.c_mktsegment AS segment, n.n_regionkey AS region_key, n.n_name AS nation,
         c.c_acctbal AS account_balance, pc.payment_mode,
         CAST(pc.n_orders AS DOUBLE) AS order_count,
         CAST(CASE WHEN pc.n_orders IS NOT NULL THEN coalesce(pl.coupons, 0) END AS DOUBLE) AS coupon_used,
         CAST(date_diff('day', CAST(pc.last_order AS DATE), DATE '{CUTOFF}') AS DOUBLE) AS days_since_last,
         CAST(CASE WHEN pc.n_orders IS NOT NULL THEN coalesce(pl.cb, 0) END AS DOUBLE) AS cashback,
         coalesce(pl.ret, 0) AS returned
  FROM customer c JOIN nation n ON c.c_nationkey = n.n_nationkey
  LEFT JOIN per_customer pc ON pc.c_custkey = c.c_custkey
  LEFT JOIN per_line pl ON pl.c_custkey = c.c_custkey
  LEFT JOIN later lt ON lt.c_custkey = c.c_custkey
)"""


def customer_raw(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The snapshot as a messy upstream file would hold it.

    Every row passes through; some get a raw spelling or stray blanks, and some are emitted twice
    (an exact copy; a copy whose spelling differs only before mapping; a copy with the same key
    and other content; a copy with a new key and the same content).
    """
    s = customer_snapshot(spark, sf_dir)
    k = F.col("customer_id")
    abbrev = F.create_map(*[F.lit(x) for raw, canon in SNAPSHOT_CONFIG.entity_map["segment"].items() for x in (canon, raw)])
    seg = F.when(F.pmod(k, F.lit(5)) == 1, F.element_at(abbrev, F.col("segment"))).otherwise(F.col("segment"))
    seg = F.when(F.pmod(k, F.lit(7)) == 3, F.concat(F.lit(" "), seg, F.lit("\t"))).otherwise(seg)
    pay = F.when((F.pmod(k, F.lit(4)) == 2) & F.col("payment_mode").isin("1-URGENT", "2-HIGH"),
                 F.substring_index(F.col("payment_mode"), "-", -1)).otherwise(F.col("payment_mode"))
    tagged = s.select(
        "*",
        seg.alias("_seg"),
        pay.alias("_pay"),
        F.explode(F.array(
            F.lit("row"),
            F.when(F.pmod(k, F.lit(10)) == 0, F.lit("exact")),
            F.when(F.pmod(k, F.lit(15)) == 1, F.lit("mapped")),
            F.when(F.pmod(k, F.lit(20)) == 5, F.lit("same_key")),
            F.when(F.pmod(k, F.lit(25)) == 7, F.lit("new_key")),
        )).alias("_copy"),
    ).where(F.col("_copy").isNotNull())
    copy = F.col("_copy")
    out = []
    for c in s.columns:
        if c == "customer_id":
            out.append(F.when(copy == "new_key", k + F.lit(1_000_000_000_000)).otherwise(k).alias(c))
        elif c == "segment":
            out.append(F.when(copy == "mapped", F.col("segment")).otherwise(F.col("_seg")).alias(c))
        elif c == "payment_mode":
            out.append(F.when(copy == "mapped", F.col("payment_mode")).otherwise(F.col("_pay")).alias(c))
        elif c == "account_balance":
            out.append(F.when(copy == "same_key", F.col(c) + 1).otherwise(F.col(c)).alias(c))
        else:
            out.append(F.col(c))
    return tagged.select(*out)


RAW_SQL = """
raw AS (
  SELECT CASE WHEN cp = 'new_key' THEN customer_id + 1000000000000 ELSE customer_id END AS customer_id,
         churned, tenure_months,
         CASE WHEN cp = 'mapped' THEN segment ELSE seg END AS segment,
         region_key, nation,
         CASE WHEN cp = 'same_key' THEN account_balance + 1 ELSE account_balance END AS account_balance,
         CASE WHEN cp = 'mapped' THEN payment_mode ELSE pay END AS payment_mode,
         order_count, coupon_used, days_since_last, cashback, returned
  FROM (
    SELECT s.*,
      CASE WHEN customer_id % 7 = 3 THEN ' ' || seg1 || chr(9) ELSE seg1 END AS seg,
      CASE WHEN customer_id % 4 = 2 AND payment_mode IN ('1-URGENT', '2-HIGH')
           THEN split_part(payment_mode, '-', 2) ELSE payment_mode END AS pay,
      cp
    FROM (SELECT *, CASE WHEN customer_id % 5 = 1 THEN
                 CASE segment WHEN 'AUTOMOBILE' THEN 'AUTO' WHEN 'BUILDING' THEN 'BLDG' WHEN 'FURNITURE' THEN 'FURN'
                              WHEN 'HOUSEHOLD' THEN 'HH' WHEN 'MACHINERY' THEN 'MACH' END
                 ELSE segment END AS seg1 FROM snap) s,
    (VALUES ('row'), ('exact'), ('mapped'), ('same_key'), ('new_key')) AS t(cp)
    WHERE cp = 'row' OR (cp = 'exact' AND customer_id % 10 = 0) OR (cp = 'mapped' AND customer_id % 15 = 1)
       OR (cp = 'same_key' AND customer_id % 20 = 5) OR (cp = 'new_key' AND customer_id % 25 = 7)
  ) x
)"""


def scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(customer_id, y, proba, fold, nation, segment): a deterministic pseudo-score per customer."""
    s = customer_snapshot(spark, sf_dir)
    return s.select(
        F.col("customer_id"),
        F.col("churned").alias("y"),
        pseudo_score(F.col("customer_id")).alias("proba"),
        F.pmod(knuth_hash(F.col("customer_id"), 7), F.lit(5)).cast("int").alias("fold"),
        F.col("nation"),
        F.col("segment"),
    )


def line_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(line_id, y, proba, fold, returnflag_group): one score per lineitem row, y = returned."""
    li = table(spark, sf_dir, "lineitem")
    line_id = F.col("l_orderkey") * 8 + F.col("l_linenumber")
    return li.select(
        line_id.alias("line_id"),
        F.when(F.col("l_returnflag") == "R", 1).otherwise(0).alias("y"),
        pseudo_score(F.col("l_orderkey") * 131 + F.col("l_partkey")).alias("proba"),
        F.pmod(knuth_hash(F.col("l_partkey"), 7), F.lit(5)).cast("int").alias("fold"),
        F.col("l_linestatus").alias("group_a"),
        F.col("l_shipdate").cast("date").cast("string").substr(1, 4).alias("group_b"),
    )


def events_runlog(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The ``events`` table read as a run log (see ``runlog_from_events``)."""
    return runlog_from_events(table(spark, sf_dir, "events"))


def runlog_from_events(ev: DataFrame) -> DataFrame:
    """Events as a run log: user = run, event type = step, errors = failures (batch or stream).

    (run_id, seq, ts, step, status, result, duration_s, llm_calls, cost_usd); ``llm_calls`` comes
    from the JSON ``props`` field.
    """
    return ev.select(
        F.col("user_id").alias("run_id"),
        F.col("event_id").alias("seq"),
        F.col("ts"),
        F.col("event_type").alias("step"),
        F.when(F.col("event_type") == "error", "fail").when(F.col("event_type") == "signup", "start")
        .otherwise("ok").alias("status"),
        F.lit(None).cast("string").alias("result"),
        F.col("value").alias("duration_s"),
        F.get_json_object("props", "$.k").cast("bigint").alias("llm_calls"),
        (F.col("value") / 1000.0).alias("cost_usd"),
    )


RUNLOG_SQL = """
ev AS (
  SELECT user_id AS run_id, event_id AS seq, ts, event_type AS step,
         CASE WHEN event_type = 'error' THEN 'fail' WHEN event_type = 'signup' THEN 'start' ELSE 'ok' END AS status,
         CAST(NULL AS VARCHAR) AS result, value AS duration_s,
         CAST(json_extract_string(props, '$.k') AS BIGINT) AS llm_calls, value / 1000.0 AS cost_usd
  FROM events
)"""

SCORES_SQL = """
sc AS (
  SELECT customer_id, churned AS y,
         CAST((CAST(customer_id AS DECIMAL(20,0)) * CAST(2654435761 AS DECIMAL(10,0))) % 1000003 AS DOUBLE) / 1000003.0 AS proba,
         CAST(((CAST(customer_id AS DECIMAL(20,0)) * CAST(2654435761 AS DECIMAL(10,0)) + 7) % 4294967296) % 5 AS INTEGER) AS fold,
         nation, segment
  FROM snap
)"""

LINE_SCORES_SQL = """
lsc AS (
  SELECT l_orderkey * 8 + l_linenumber AS line_id,
         CASE WHEN l_returnflag = 'R' THEN 1 ELSE 0 END AS y,
         CAST((CAST(l_orderkey * 131 + l_partkey AS DECIMAL(20,0)) * CAST(2654435761 AS DECIMAL(10,0))) % 1000003 AS DOUBLE) / 1000003.0 AS proba,
         CAST(((CAST(l_partkey AS DECIMAL(20,0)) * CAST(2654435761 AS DECIMAL(10,0)) + 7) % 4294967296) % 5 AS INTEGER) AS fold,
         l_linestatus AS group_a, substr(CAST(CAST(l_shipdate AS DATE) AS VARCHAR), 1, 4) AS group_b
  FROM lineitem
)"""


LINE_CONFIG = Config(primary_key="line_key", target="returned", protected=("l_linestatus",),
                     units={"l_extendedprice": "USD"}, int_columns=("line_key", "returned"), seed=42)


def line_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``lineitem`` as a hand-over table: key = orderkey * 8 + linenumber (repeats exist), target = returned."""
    li = table(spark, sf_dir, "lineitem")
    return li.select((F.col("l_orderkey") * 8 + F.col("l_linenumber")).alias("line_key"),
                     F.when(F.col("l_returnflag") == "R", 1).otherwise(0).alias("returned"),
                     "l_partkey", "l_suppkey", "l_quantity", "l_extendedprice", "l_discount", "l_tax",
                     "l_linestatus", F.col("l_shipdate").cast("date").cast("string").substr(1, 7).alias("ship_month"))
