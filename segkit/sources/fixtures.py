"""The buyer table: a view over the given customer, orders and nation tables.

One buyer per customer with orders.  Every attribute comes from given columns: the customer's segment, balance and nation, and its
first and last order (by key).  Gaps are gaps of the data (a priority that is "not specified", pending orders); copies are customers
at the ends of the balance range, entered a second time, exactly or with another label and score.  ``seq`` is the input order.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from segkit.fixed_values import REQUIRED_COLUMNS
from segkit.operators.joins import lookup_join
from segkit.sources.tables import read_table

BUYER_COLUMNS = REQUIRED_COLUMNS

CORPORATE_BALANCE = 6000.0      # from this balance on a customer counts as a company
LOAN_BALANCE = 1500.0           # below it as a borrower
INVESTOR_MEAN = 240000          # mean order value from which the purpose is investment
EXACT_COPY_BELOW = -900.0       # these customers are entered twice, equal
CHANGED_COPY_ABOVE = 9900.0     # these with another label and score
COPY_LABEL = "AUTOMOBILE"
NOT_SPECIFIED = 4               # the order priority "4-NOT SPECIFIED"
LAST_CHANNELS = ["URGENT", "HIGH", "MEDIUM", "LOW"]

# The four "main" cohorts of the dashboard (FURNITURE plays the rest).
MAIN_COHORTS = ["AUTOMOBILE", "BUILDING", "HOUSEHOLD", "MACHINERY"]

# Allowed values per column (Q2 domain rules).
DOMAINS = {
    "client_type": ["Individual", "Corporate"],
    "gender": ["Male", "Female", "Other", "Not Applicable"],
    "acquisition_purpose": ["Investment", "Personal Use"],
    "loan_applied": ["Yes", "No"],
    "referral_channel": LAST_CHANNELS,
    "satisfaction_score": [1, 2, 3, 4, 5],
}


def order_facts(orders: DataFrame) -> DataFrame:
    """Per customer: first and last order as (key, priority digit, status digit) packed into one number, and totals."""
    status = F.expr("case o_orderstatus when 'F' then 1 when 'O' then 2 else 3 end")
    packed = F.col("o_orderkey") * 100 + F.substring("o_orderpriority", 1, 1).cast("int") * 10 + status
    return orders.groupBy("o_custkey").agg(
        F.min(packed).alias("_first"), F.max(packed).alias("_last"), F.count(F.lit(1)).alias("_n"),
        F.sum(F.col("o_totalprice").cast("decimal(18,2)")).alias("_value"), F.min("o_orderdate").cast("date").alias("_since"))


def buyers_base(customer: DataFrame, nation: DataFrame, orders: DataFrame) -> DataFrame:
    """One buyer per customer with orders, before copies."""
    base = lookup_join(customer.select("c_custkey", "c_nationkey", "c_mktsegment", "c_acctbal"),
                       nation.select(F.col("n_nationkey").alias("c_nationkey"), "n_name"), on="c_nationkey", how="inner")
    base = base.join(order_facts(orders), F.col("c_custkey") == F.col("o_custkey"))
    none = F.lit(None).cast("string")
    first, first_status = F.expr("int(_first div 10 % 10)"), F.expr("int(_first % 10)")
    last, last_status = F.expr("int(_last div 10 % 10)"), F.expr("int(_last % 10)")
    return base.select(
        F.concat(F.lit("B_"), F.lpad(F.col("c_custkey").cast("string"), 7, "0")).alias("client_id"),
        F.col("c_mktsegment").alias("cohort_label"),
        F.when(F.col("c_acctbal") >= CORPORATE_BALANCE, F.lit("Corporate")).otherwise(F.lit("Individual")).alias("client_type"),
        F.when(last == NOT_SPECIFIED, none).when(last_status == 1, F.lit("Female")).when(last_status == 2, F.lit("Male"))
         .otherwise(F.lit("Other")).alias("gender"),
        F.col("n_name").alias("country"),
        F.when((first == NOT_SPECIFIED) & (first_status == 3), none)
         .otherwise(F.concat("n_name", F.lit("/"), first_status.cast("string"))).alias("region"),
        F.date_sub("_since", (F.lit(11000) + F.floor(F.abs("c_acctbal"))).cast("int")).cast("string").alias("date_of_birth"),
        F.when((last == 5) & (last_status == 3), none)
         .when(F.col("_value") >= F.col("_n") * INVESTOR_MEAN, F.lit("Investment")).otherwise(F.lit("Personal Use")).alias("acquisition_purpose"),
        F.when((first == 1) & (first_status == 3), none)
         .when(F.col("c_acctbal") < LOAN_BALANCE, F.lit("Yes")).otherwise(F.lit("No")).alias("loan_applied"),
        F.when(first == NOT_SPECIFIED, none)
         .otherwise(F.element_at(F.array(*[F.lit(c) for c in LAST_CHANNELS]), F.least(first, F.lit(4)))).alias("referral_channel"),
        last.alias("satisfaction_score"),
        (F.col("c_custkey") * 2).alias("seq"),
        (F.col("c_acctbal") < EXACT_COPY_BELOW).alias("_exact"),
        (F.col("c_acctbal") > CHANGED_COPY_ABOVE).alias("_changed"),
    )


def buyers_ordered(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The buyers with their copies and ``seq``, the input order (a copy follows its original)."""
    base = buyers_base(*(read_table(spark, sf_dir, t) for t in ("customer", "nation", "orders")))
    copies = base.where("_exact or _changed").withColumns({
        "cohort_label": F.when(F.col("_changed"), F.lit(COPY_LABEL)).otherwise(F.col("cohort_label")),
        "satisfaction_score": F.when(F.col("_changed"), F.col("satisfaction_score") % 5 + 1).otherwise(F.col("satisfaction_score")).cast("int"),
        "seq": F.col("seq") + 1})
    return base.unionByName(copies).drop("_exact", "_changed")


def buyers_raw(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The buyers with their copies, without the order column."""
    return buyers_ordered(spark, sf_dir).drop("seq")
