"""Retail analytics over the sales fact."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

from ledgerloom.functions.scalars import day_label, full_name, month_label, month_number
from ledgerloom.operators.relational import attach, largest, mean
from ledgerloom.session import checkpointed


def revenue() -> Column:
    return F.sum("total_sale")


def per_order(sales: DataFrame, *also: str) -> DataFrame:
    """Revenue per order and customer. Counting distinct orders or customers afterwards works on one
    row per order instead of one per item."""
    return sales.groupBy("order_id", "customer_id", *also).agg(revenue().alias("order_total"))


def kpi_row(sales: DataFrame) -> DataFrame:
    return per_order(sales).agg(
        F.sum("order_total").cast("double").alias("total_revenue"),
        F.count("order_id").alias("total_orders"),  # an order has one customer, so one row
        F.countDistinct("customer_id").alias("unique_customers"),
    )


def daily_sales(sales: DataFrame, *keys: str) -> DataFrame:
    """Revenue per calendar day from the first to the last sale, days without sales as zero.

    With keys, every key gets its own span of days.
    """
    sold = sales.groupBy(*keys, F.to_date("order_date").alias("day")).agg(revenue().alias("sold"))
    # Every day with sales also brings the days up to the next one: no second look at the sales. The
    # window runs over one row per day (and key).
    following = F.lead("day").over(Window.partitionBy(*keys).orderBy("day"))
    days = F.sequence("sold_day", F.coalesce(F.date_sub("following", 1), F.col("sold_day")))
    return (
        sold.where("day IS NOT NULL")
        .withColumn("following", following)
        .withColumnRenamed("day", "sold_day")
        .select(*keys, "sold_day", "sold", F.explode(days).alias("day"))
        .select(
            *keys,
            "day",
            F.when(F.col("day") == F.col("sold_day"), F.col("sold"))
            .otherwise(F.lit(0).cast("decimal(28,2)"))
            .alias("total_sale"),
        )
    )


def daily_trend(sales: DataFrame, width: int = 7) -> DataFrame:
    """Daily revenue with a moving average that is NULL until ``width`` days exist.

    The window runs over one row per calendar day.
    """
    recent = Window.orderBy("day").rowsBetween(1 - width, 0)
    value = F.col("total_sale").cast("double")
    return daily_sales(sales).select(
        day_label(F.col("day")).alias("day"),
        value.alias("total_sale"),
        F.when(
            F.count("*").over(recent) == width,
            F.sum("total_sale").over(recent).cast("double") / width,
        ).alias("moving_average"),
    )


def revenue_by(sales: DataFrame, *keys: str) -> DataFrame:
    return sales.groupBy(*keys).agg(revenue().cast("double").alias("total_sale"))


def top_products(sales: DataFrame, n: int = 10) -> DataFrame:
    keys = ["model_name", "theme", "finish"]
    return largest(revenue_by(sales, *keys), "total_sale", keys, n)


def hierarchy_totals(sales: DataFrame) -> DataFrame:
    """Revenue of every model, model/theme and model/theme/finish; level 1 is a model.

    The finest level is aggregated first and rolled up from there, so the expansion into three levels
    touches one row per leaf, not one per sale.
    """
    leaves = sales.groupBy("model_name", "theme", "finish").agg(revenue().alias("leaf"))
    return (
        leaves.rollup("model_name", "theme", "finish")
        .agg(
            F.sum("leaf").cast("double").alias("total_sale"),
            F.grouping_id().alias("_g"),
        )
        .filter(F.col("_g") < 7)
        .select(
            "model_name",
            "theme",
            "finish",
            F.when(F.col("_g") == 0, 3).when(F.col("_g") == 1, 2).otherwise(1).alias("level"),
            "total_sale",
        )
    )


def _models_per_order(sales: DataFrame) -> DataFrame:
    """One row per order and model with the number of lines; bounded by the catalogue per order."""
    return (
        sales.filter(F.col("model_name").isNotNull())
        .groupBy("order_id", "model_name")
        .agg(F.count("*").alias("lines"))
    )


def _baskets(sales: DataFrame) -> DataFrame:
    """Distinct baskets with the number of orders that hold them.

    A basket is the sorted list of (model, lines); its length is bounded by the number of models, how
    many lines the order may have. Equal baskets are counted before any pair is formed.
    """
    return (
        _models_per_order(sales)
        .groupBy("order_id")
        .agg(F.array_sort(F.collect_list(F.struct("model_name", "lines"))).alias("basket"))
        .groupBy("basket")
        .agg(F.count("*").alias("orders"))
    )


def _pairs(baskets: DataFrame) -> DataFrame:
    """Ordered pairs (first before second) of different models, by position in the basket."""
    first = baskets.select("basket", "orders", F.posexplode("basket").alias("at", "first"))
    return first.select(
        "orders",
        "first",
        F.explode(F.slice("basket", F.col("at") + 2, F.size("basket"))).alias("second"),
    )


def basket_affinity(sales: DataFrame) -> DataFrame:
    """Orders per pair of distinct models, quantities and repeated lines ignored."""
    return (
        _pairs(_baskets(sales))
        .groupBy(F.col("first.model_name").alias("a"), F.col("second.model_name").alias("b"))
        .agg(F.sum("orders").alias("pair_count"))
    )


def top_affinity(sales: DataFrame, n: int = 5) -> DataFrame:
    """The n most frequent pairs, labelled "A & B". A single order gives no result."""
    enough = _baskets(sales).agg((F.sum("orders") > 1).alias("enough"))
    best = largest(basket_affinity(sales), "pair_count", ["a", "b"], n)
    return (
        attach(best, enough)
        .filter("enough")
        .select(F.concat_ws(" & ", "a", "b").alias("product_pair"), "pair_count")
    )


def copurchase_edges(sales: DataFrame) -> DataFrame:
    """Pairs of lines of one order by model, every line counted, pairs of one model included.

    An order with c lines of A and d lines of B holds c*d pairs (A, B) and c*(c-1)/2 pairs (A, A), so
    no pair of lines is ever produced.
    """
    baskets = _baskets(sales)
    mixed = _pairs(baskets).select(
        F.col("first.model_name").alias("a"),
        F.col("second.model_name").alias("b"),
        (F.col("orders") * F.col("first.lines") * F.col("second.lines")).alias("w"),
    )
    same = baskets.select("orders", F.explode("basket").alias("m")).select(
        F.col("m.model_name").alias("a"),
        F.col("m.model_name").alias("b"),
        (F.col("orders") * F.expr("m.lines * (m.lines - 1) div 2")).alias("w"),
    )
    return (
        mixed.unionByName(same)
        .groupBy("a", "b")
        .agg(F.sum("w").alias("weight"))
        .filter(F.col("weight") > 0)
    )


def copurchase_network(sales: DataFrame) -> DataFrame:
    """Edges with their weight relative to the strongest edge."""
    edges = copurchase_edges(sales)
    strongest = edges.agg(F.max("weight").alias("_max"))
    return attach(edges, strongest).select(
        "a", "b", "weight", (F.col("weight") / F.col("_max")).alias("relative_weight")
    )


def network_degrees(sales: DataFrame) -> DataFrame:
    """Number of edges at every model; an edge of a model with itself counts once."""
    return (
        copurchase_edges(sales)
        .select(F.explode(F.array_distinct(F.array("a", "b"))).alias("model_name"))
        .groupBy("model_name")
        .agg(F.count("*").alias("degree"))
    )


def network_summary(sales: DataFrame) -> DataFrame:
    edges = copurchase_edges(sales).withColumn(
        "node", F.explode(F.array_distinct(F.array("a", "b")))
    )
    one = edges.select("a", "b", "weight", "node")
    return one.agg(
        F.countDistinct("node").alias("products"),
        F.countDistinct("a", "b").alias("connections"),
        F.max("weight").alias("strongest"),
    )


def flow_counts(sales: DataFrame) -> DataFrame:
    """Line counts channel to theme and theme to finish, with labelled nodes."""
    counted = sales.groupBy("sales_channel", "theme", "finish").agg(F.count("*").alias("n"))

    def flow(left_label: str, left: str, right_label: str, right: str) -> DataFrame:
        return (
            counted.filter(F.col(left).isNotNull() & F.col(right).isNotNull())
            .groupBy(
                F.concat(F.lit(left_label), F.col(left)).alias("source"),
                F.concat(F.lit(right_label), F.col(right)).alias("target"),
            )
            .agg(F.sum("n").alias("value"))
        )

    return flow("Canal: ", "sales_channel", "Thème: ", "theme").unionByName(
        flow("Thème: ", "theme", "Finish: ", "finish")
    )


# --- cohorts -----------------------------------------------------------------------------------


def cohort_retention(sales: DataFrame) -> DataFrame:
    """Distinct customers per acquisition month and months since, with percent of month zero."""
    active = sales.select(
        "customer_id", month_number(F.col("order_date")).alias("month")
    ).distinct()
    # A customer has at most one row per calendar month here.
    by_customer = Window.partitionBy("customer_id")
    counts = (
        active.withColumn("cohort", F.min("month").over(by_customer))
        .groupBy("cohort", (F.col("month") - F.col("cohort")).alias("cohort_index"))
        .agg(F.count("customer_id").alias("customers"))
    )
    start = counts.filter(F.col("cohort_index") == 0).select(
        "cohort", F.col("customers").alias("_size")
    )
    label = F.format_string(
        "%04d-%02d",
        F.expr("(cohort - 1) div 12"),
        ((F.col("cohort") - 1) % 12 + 1).cast("bigint"),
    )
    return counts.join(start, "cohort").select(
        label.alias("cohort_month"),
        F.col("cohort_index").cast("bigint").alias("cohort_index"),
        "customers",
        (F.col("customers") * 100.0 / F.col("_size")).alias("retention"),
    )


def cohort_matrix(sales: DataFrame, indexes: Sequence[int] | None = None) -> DataFrame:
    """Retention as a matrix: one row per cohort, one column per month offset.

    Without ``indexes`` the offsets are 0 to the largest one of the retention rows, which are kept (one
    per cohort and month) instead of joining the sales again.
    """
    retention = cohort_retention(sales)
    if indexes is None:
        retention = checkpointed(retention)
        last = retention.agg(F.max("cohort_index").alias("last")).first()["last"]
        indexes = range((last or 0) + 1)
    wide = (
        retention.groupBy("cohort_month")
        .pivot("cohort_index", list(indexes))
        .agg(F.first("retention"))
    )
    return wide.select("cohort_month", *[F.col(str(i)).alias(f"month_{i}") for i in indexes])


# --- customers ---------------------------------------------------------------------------------


def customer_race(sales: DataFrame, n: int = 10) -> DataFrame:
    """Running revenue by month of the n customers with the highest total; namesakes are merged."""
    monthly = (
        sales.withColumn("customer", full_name(F.col("first_name"), F.col("last_name")))
        .filter(F.col("customer").isNotNull())
        .groupBy("customer", month_label(F.col("order_date")).alias("month"))
        .agg(revenue().alias("sold"))
    )
    running = cumulative_by_month(monthly)
    best = largest(
        running.groupBy("customer").agg(F.max("cumulative").alias("_best")), "_best", ["customer"], n
    ).select("customer")
    # n rows on the right.
    return running.join(F.broadcast(best), "customer", "left_semi").select(
        "customer", "month", F.col("sold").cast("double").alias("total_sale"),
        F.col("cumulative").cast("double").alias("cumulative"),
    )


def cumulative_by_month(monthly: DataFrame) -> DataFrame:
    """Running total per customer; one row per customer and month, so a partition is short."""
    upto = (
        Window.partitionBy("customer")
        .orderBy("month")
        .rowsBetween(Window.unboundedPreceding, Window.currentRow)
    )
    return monthly.withColumn("cumulative", F.sum("sold").over(upto))


def customer_running_totals(sales: DataFrame) -> DataFrame:
    """Running revenue by month of every customer name."""
    monthly = (
        sales.withColumn("customer", full_name(F.col("first_name"), F.col("last_name")))
        .groupBy("customer", month_label(F.col("order_date")).alias("month"))
        .agg(revenue().alias("sold"))
    )
    return cumulative_by_month(monthly).select(
        "customer", "month", F.col("cumulative").cast("double").alias("cumulative")
    )


def customer_profiles(sales: DataFrame, customers: DataFrame, n: int = 3) -> DataFrame:
    """Inputs of a next-best-action decision for every customer.

    Lines are counted per customer, model, theme and channel first: a customer then holds at most one
    cell per combination of the catalogue, however many lines it has. Those cells move once, by
    customer; counting per value, ranking and collecting all keep that partitioning.
    """
    cells = sales.groupBy("customer_id", "model_name", "theme", "sales_channel").agg(
        F.count("*").alias("n"),
        revenue().alias("sold"),
        F.count("total_sale").alias("priced"),
        F.max("order_date").alias("last"),
    )
    kinds = {"model": "model_name", "theme": "theme", "channel": "sales_channel"}
    views = [F.struct(F.lit(k).alias("kind"), F.col(c).alias("value")) for k, c in kinds.items()]
    views.append(F.struct(F.lit("all").alias("kind"), F.lit(None).cast("string").alias("value")))
    counted = (
        cells.repartition("customer_id")
        .select("customer_id", "n", "sold", "priced", "last", F.inline(F.array(*views)))
        .filter(F.col("value").isNotNull() | (F.col("kind") == "all"))
        .groupBy("customer_id", "kind", "value")
        .agg(
            F.sum("n").alias("n"),
            F.sum("sold").alias("sold"),
            F.sum("priced").alias("priced"),
            F.max("last").alias("last"),
        )
    )
    best_first = Window.partitionBy("customer_id", "kind").orderBy(F.desc("n"), "value")
    ranked = counted.withColumn("place", F.row_number().over(best_first)).filter(F.col("place") <= n)
    of_kind = lambda kind, c: F.when(F.col("kind") == kind, c)
    text = F.concat_ws(":", "value", F.col("n").cast("string")).alias("text")

    def favourites(kind: str) -> Column:
        listed = F.array_sort(F.collect_list(of_kind(kind, F.struct("place", text))))
        return F.array_join(F.transform(listed, lambda s: s["text"]), ", ")

    total = F.max(of_kind("all", F.col("sold"))).cast("double")
    profile = ranked.groupBy("customer_id").agg(
        F.max(of_kind("all", F.col("n"))).alias("lines"),
        total.alias("total_sale"),
        (total / F.max(of_kind("all", F.col("priced")))).alias("average_sale"),
        day_label(F.max("last")).alias("last_order"),
        favourites("model").alias("top_models"),
        favourites("theme").alias("top_themes"),
        F.max(of_kind("channel", F.when(F.col("place") == 1, F.col("value")))).alias("channel"),
    )
    names = customers.select(
        "customer_id", full_name(F.col("first_name"), F.col("last_name")).alias("customer")
    )
    return profile.join(names, "customer_id", "left").select(
        "customer_id",
        "customer",
        "lines",
        "total_sale",
        "average_sale",
        "last_order",
        "top_models",
        "top_themes",
        F.coalesce("channel", F.lit("N/A")).alias("preferred_channel"),
    )


# --- calendar and prices -----------------------------------------------------------------------


def calendar_daily(sales: DataFrame) -> DataFrame:
    """Days with sales, with ISO week, weekday (Monday is 0) and year."""
    day = F.col("day")
    return (
        sales.groupBy(F.to_date("order_date").alias("day"))
        .agg(revenue().alias("sold"))
        .select(
            day_label(day).alias("day"),
            F.weekofyear(day).alias("week"),
            F.weekday(day).alias("weekday"),
            F.year(day).alias("year"),
            F.col("sold").cast("double").alias("total_sale"),
        )
    )


def calendar_matrix(sales: DataFrame) -> DataFrame:
    """Revenue by ISO week and weekday, all years together."""
    day = F.col("day")
    return (
        sales.groupBy(F.to_date("order_date").alias("day"))
        .agg(revenue().alias("sold"))
        .groupBy(F.weekofyear(day).alias("week"), F.weekday(day).alias("weekday"))
        .agg(F.sum("sold").cast("double").alias("total_sale"))
    )


def price_scenarios(
    sales: DataFrame, elasticity: float = -1.5, low: int = -50, high: int = 50, step: int = 5
) -> DataFrame:
    """Price, quantity and revenue of every model for a grid of price changes.

    Quantity is the number of lines, truncated after the change. The grid is a literal array, so the
    models are expanded in place without a join.
    """
    change = F.col("price_change")
    current = sales.groupBy("model_name").agg(
        F.count("*").alias("current_quantity"),
        mean("price_at_purchase").alias("current_price"),
        revenue().cast("double").alias("current_revenue"),
    )
    quantity_change = F.lit(elasticity) * change
    return (
        current.withColumn("price_change", F.explode(F.sequence(F.lit(low), F.lit(high), F.lit(step))))
        .withColumn("new_price", F.col("current_price") * (1 + change / 100.0))
        .withColumn("new_quantity", (F.col("current_quantity") * (1 + quantity_change / 100.0)).cast("bigint"))
        .withColumn("new_revenue", F.col("new_price") * F.col("new_quantity"))
        .select(
            "model_name",
            F.col("price_change").cast("bigint").alias("price_change"),
            "current_quantity",
            "current_price",
            "current_revenue",
            "new_price",
            "new_quantity",
            "new_revenue",
            (
                (F.col("new_revenue") - F.col("current_revenue"))
                / F.nullif("current_revenue", F.lit(0.0))
                * 100
            ).alias("revenue_change"),
        )
    )


# --- business questions ------------------------------------------------------------------------


def best_month(sales: DataFrame) -> DataFrame:
    monthly = revenue_by(sales.withColumn("month", month_label(F.col("order_date"))), "month")
    return largest(monthly, "total_sale", ["month"], 1)


def loyal_customers(sales: DataFrame, customers: DataFrame, n: int = 5) -> DataFrame:
    """Customers with the most orders; only the n winners look up their name."""
    counts = sales.groupBy("customer_id").agg(
        F.countDistinct("order_id").alias("orders"), revenue().cast("double").alias("total_sale")
    )
    best = counts.orderBy(F.desc("orders"), F.desc("total_sale"), "customer_id").limit(n)
    names = customers.select("customer_id", "first_name", "last_name")
    return names.join(F.broadcast(best), "customer_id")


def best_sellers_by_theme(sales: DataFrame, n: int = 3) -> DataFrame:
    """The n models with the most units per theme; ranked over one row per theme and model."""
    units = sales.groupBy("theme", "model_name").agg(F.sum("quantity").alias("units"))
    place = F.row_number().over(Window.partitionBy("theme").orderBy(F.desc("units"), "model_name"))
    return units.withColumn("place", place).filter(F.col("place") <= n)


def basket_by_channel(sales: DataFrame) -> DataFrame:
    """Average order value per channel."""
    return (
        per_order(sales, "sales_channel")
        .groupBy("sales_channel")
        .agg(
            F.count("*").alias("orders"),
            mean("order_total").alias("average_basket"),
        )
    )


def new_customers_by_quarter(sales: DataFrame) -> DataFrame:
    first = sales.groupBy("customer_id").agg(F.min("order_date").alias("first_order"))
    quarter = F.concat(F.year("first_order"), F.lit("-Q"), F.quarter("first_order"))
    return first.groupBy(quarter.alias("quarter")).agg(F.count("*").alias("new_customers"))


def best_item(support: DataFrame) -> DataFrame:
    counts = support.groupBy("item").agg(F.count("*").alias("order_count"))
    return largest(counts, "order_count", ["item"], 1)


def item_count(support: DataFrame, item: str) -> DataFrame:
    return support.filter(F.col("item") == item).agg(
        F.lit(item).alias("item"), F.count("*").alias("order_count")
    )
