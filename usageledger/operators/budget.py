"""Monthly credit budgets of workspaces and what was spent against them."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from usageledger.functions.times import months_between_starts

# The workspace types every installation has.
WORKSPACE_TYPES = {
    "LRN": "Learner Workspace",
    "POC": "Proff Of Concept Workspace",
    "ES": "Explore Workspace",
    "DP": "Data Product Workspace",
}


def budget_months(purchases: DataFrame) -> DataFrame:
    """One row per purchase and budget month, dated from the purchase day.

    Each date is one month after the one before, so the 31st drifts to the
    shortest month met so far. A month follows while the last date lies before
    the renewal less one month. All dates of a purchase come from one
    higher-order function on its own row: no recursion and no join.
    """
    start, renewal = F.col("purchased_date"), F.col("renewal_date")
    limit = F.add_months(renewal, -1)
    steps = F.greatest(F.coalesce(months_between_starts(start, renewal), F.lit(0)) + 1, F.lit(1))
    dates = F.aggregate(
        F.sequence(F.lit(1), steps),
        F.array(start),
        lambda acc, _: F.when(
            F.element_at(acc, -1) < limit, F.concat(acc, F.array(F.add_months(F.element_at(acc, -1), 1)))
        ).otherwise(acc),
    )
    return purchases.withColumn("active_date", F.explode(dates))


def workspace_monthly_budget(purchases: DataFrame, tracker: DataFrame) -> DataFrame:
    """Budget per purchase and month: purchased credits over its months, rounded down."""
    renewed = F.date_add("renewal_date", 1)
    months = months_between_starts(F.col("purchased_date"), renewed)
    budget = F.floor(F.try_divide(F.col("purchased_credits"), months)).cast("bigint")
    known = purchases.join(tracker.select("ws_id").distinct(), "ws_id", "left_semi")
    return budget_months(known).select("ws_id", "active_date", "pur_id", budget.alias("monthly_credit_budget"))


#: Budget months by recursion: a purchase's next month follows while the last one lies before the renewal less a month.
BUDGET_SQL = """
WITH RECURSIVE months MAX RECURSION LEVEL 1200 AS (
  SELECT p.ws_id, p.pur_id, p.purchased_date, p.renewal_date, p.purchased_credits, p.purchased_date AS active_date
  FROM {purchases} p LEFT SEMI JOIN {tracker} t ON p.ws_id = t.ws_id
  UNION ALL
  SELECT ws_id, pur_id, purchased_date, renewal_date, purchased_credits, add_months(active_date, 1)
  FROM months WHERE active_date < add_months(renewal_date, -1))
SELECT ws_id, active_date, pur_id,
  CAST(floor(try_divide(purchased_credits, (year(date_add(renewal_date, 1)) - year(purchased_date)) * 12
    + month(date_add(renewal_date, 1)) - month(purchased_date))) AS BIGINT) AS monthly_credit_budget
FROM months"""


def workspace_monthly_budget_recursive(purchases: DataFrame, tracker: DataFrame) -> DataFrame:
    """workspace_monthly_budget as a recursive query, for those who read SQL.

    Each month of the longest purchase is a step over all purchases, and Spark bounds
    a recursion's rows (``spark.sql.cteRecursionRowLimit``); the other form has neither.
    """
    return purchases.sparkSession.sql(BUDGET_SQL, purchases=purchases, tracker=tracker)


def bu_warehouse_spend(
    warehouses: DataFrame, daily_credits: DataFrame, purchases: DataFrame, tracker: DataFrame
) -> DataFrame:
    """Monthly credits per warehouse beside the budgets of its business unit in that month."""
    spent = daily_credits.groupBy(
        "warehouse_name", F.trunc(F.to_date("active_date"), "month").alias("active_month")
    ).agg(F.sum("credits_used").alias("total_credits_used"))
    budgets = (
        workspace_monthly_budget(purchases, tracker)
        .join(purchases.select("ws_id", "pur_id", "purchased_rate"), ["ws_id", "pur_id"])
        .join(tracker.select("ws_id", "workspace", "bu"), "ws_id")
        .withColumnRenamed("active_date", "budget_month")
    )
    joined = warehouses.join(spent, "warehouse_name").alias("w").join(
        budgets.alias("b"),
        (F.col("w.bu") == F.col("b.bu")) & (F.col("w.active_month") == F.col("b.budget_month")),
        "left",
    )
    return joined.select(
        "warehouse_name",
        "w.bu",
        "env",
        "purpose",
        "db_name",
        "total_credits_used",
        "purchased_rate",
        "workspace",
        "ws_id",
        "pur_id",
        "budget_month",
        "monthly_credit_budget",
    )


def workspace_details(tracker: DataFrame, purchases: DataFrame) -> DataFrame:
    """Workspaces with their purchases."""
    return tracker.join(purchases, "ws_id").select(
        "ws_id",
        "workspace",
        "workspace_desc",
        "workspace_type",
        "bu",
        "purchased_credits",
        "purchased_rate",
        "purchased_amount",
        "purchased_date",
        "renewal_date",
    )


def workspace_types_seed(existing: DataFrame) -> DataFrame:
    """The type table with the standard types replaced; running it twice changes nothing."""
    columns = ["workspace_type", "workspace_type_desc"]
    seed = existing.sparkSession.createDataFrame(list(WORKSPACE_TYPES.items()), ", ".join(f"{c} string" for c in columns))
    others = existing.filter(~F.col("workspace_type").isin(list(WORKSPACE_TYPES)))
    return others.select(*columns).unionByName(seed)
