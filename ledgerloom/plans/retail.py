"""Registered retail queries."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F

from ledgerloom.functions.scalars import day_label, elapsed_days, month_label
from ledgerloom.operators import models, retail as ops, rfm
from ledgerloom.operators.facts import filter_sales, sales_fact
from ledgerloom.operators.relational import upper_case_columns
from ledgerloom.plans.oracle import sql
from ledgerloom.plans.registry import RETAIL_AS_OF, register
from ledgerloom.sources.bindings import retail


def on_sales(
    name: str, text: str | None = None, needs: str = "sales", with_customers: bool = False
):
    """Register an operator that takes the sales fact (and the customers, if it needs names)."""

    def add(op: Callable[..., DataFrame]):
        @register(name, sql(needs, text) if text else None)
        def run(spark: SparkSession, folder: str) -> DataFrame:
            tables = retail(spark, folder)
            sales = sales_fact(tables)
            return op(sales, tables.customers) if with_customers else op(sales)

        return op

    return add


MONEY = "cast(sum(total_sale) AS double)"


@on_sales(
    "sales_lines",
    """SELECT order_id, product_id, customer_id, strftime(order_date, '%Y-%m-%d') AS order_day,
    sales_channel, model_name, theme, finish, quantity, cast(price_at_purchase AS double) AS price,
    cast(total_sale AS double) AS total_sale FROM sales""",
)
def _(sales):
    return sales.select(
        "order_id", "product_id", "customer_id", day_label(F.col("order_date")).alias("order_day"),
        "sales_channel", "model_name", "theme", "finish", "quantity",
        F.col("price_at_purchase").cast("double").alias("price"),
        F.col("total_sale").cast("double").alias("total_sale"),
    )


on_sales(
    "kpi_row",
    f"""SELECT {MONEY} AS total_revenue, count(DISTINCT order_id) AS total_orders,
    count(DISTINCT customer_id) AS unique_customers FROM sales""",
)(ops.kpi_row)


@on_sales(
    "kpi_slice",
    f"""SELECT {MONEY} AS total_revenue, count(DISTINCT order_id) AS total_orders,
    count(DISTINCT customer_id) AS unique_customers FROM sales
    WHERE order_date >= timestamp '1996-01-01' AND order_date <= timestamp '1998-12-31'
    AND theme IN ('ECONOMY','STANDARD') AND model_name IN ('Brand#1','Brand#2','Brand#3','Brand#13')""",
)
def _(sales):
    return ops.kpi_row(
        filter_sales(
            sales, "1996-01-01", "1998-12-31", ["ECONOMY", "STANDARD"],
            ["Brand#1", "Brand#2", "Brand#3", "Brand#13"],
        )
    )


on_sales(
    "daily_trend",
    """SELECT strftime(day, '%Y-%m-%d') AS day, cast(sold AS double) AS total_sale,
    CASE WHEN count(*) OVER w = 7 THEN cast(sum(sold) OVER w AS double) / 7 END AS moving_average
    FROM daily WINDOW w AS (ORDER BY day ROWS BETWEEN 6 PRECEDING AND CURRENT ROW)""",
    "daily",
)(ops.daily_trend)

on_sales(
    "top_products",
    f"""SELECT model_name, theme, finish, {MONEY} AS total_sale FROM sales
    GROUP BY ALL ORDER BY total_sale DESC, model_name, theme, finish LIMIT 10""",
)(ops.top_products)


@on_sales(
    "revenue_by_product",
    f"SELECT model_name, theme, finish, {MONEY} AS total_sale FROM sales GROUP BY ALL",
)
def _(sales):
    return ops.revenue_by(sales, "model_name", "theme", "finish")


on_sales(
    "hierarchy_totals",
    f"""SELECT model_name, theme, finish, {MONEY} AS total_sale,
    cast(CASE grouping(model_name, theme, finish) WHEN 0 THEN 3 WHEN 1 THEN 2 ELSE 1 END AS int) AS level
    FROM sales GROUP BY ROLLUP (model_name, theme, finish)
    HAVING grouping(model_name, theme, finish) < 7""",
)(ops.hierarchy_totals)

AFFINITY = """SELECT x.model_name AS a, y.model_name AS b, count(*) AS pair_count
    FROM models x JOIN models y ON x.order_id = y.order_id AND x.model_name < y.model_name
    GROUP BY ALL"""

on_sales("basket_affinity", AFFINITY, "models")(ops.basket_affinity)
on_sales(
    "top_affinity",
    f"""SELECT a || ' & ' || b AS product_pair, pair_count FROM ({AFFINITY})
    ORDER BY pair_count DESC, a, b LIMIT 5""",
    "models",
)(ops.top_affinity)
on_sales(
    "copurchase_network",
    """SELECT a, b, weight, cast(weight AS double) / max(weight) OVER () AS relative_weight FROM edges""",
    "edges",
)(ops.copurchase_network)
on_sales(
    "network_degrees",
    """SELECT model_name, count(*) AS degree FROM (SELECT a AS model_name FROM edges
    UNION ALL SELECT b FROM edges WHERE a <> b) GROUP BY 1""",
    "edges",
)(ops.network_degrees)
on_sales(
    "network_summary",
    """SELECT (SELECT count(DISTINCT m) FROM (SELECT a AS m FROM edges UNION ALL SELECT b FROM edges))
    AS products, count(*) AS connections, max(weight) AS strongest FROM edges""",
    "edges",
)(ops.network_summary)
on_sales(
    "flow_counts",
    """SELECT 'Canal: ' || sales_channel AS source, 'Thème: ' || theme AS target, count(*) AS value
    FROM sales GROUP BY ALL
    UNION ALL SELECT 'Thème: ' || theme, 'Finish: ' || finish, count(*) FROM sales GROUP BY ALL""",
)(ops.flow_counts)

on_sales(
    "cohort_retention", "SELECT cohort_month, cohort_index, customers, retention FROM retention", "retention"
)(ops.cohort_retention)


@on_sales(
    "cohort_matrix",
    "SELECT cohort_month, 'month_' || cohort_index AS month_offset, retention FROM retention",
    "retention",
)
def _(sales):
    """The matrix in long form, as its columns follow the data."""
    wide = ops.cohort_matrix(sales)
    months = [c for c in wide.columns if c != "cohort_month"]
    return wide.unpivot("cohort_month", months, "month_offset", "retention").where("retention IS NOT NULL")


on_sales(
    "customer_running_totals",
    "SELECT customer, month, cast(cumulative AS double) AS cumulative FROM running",
    "running",
)(ops.customer_running_totals)
on_sales(
    "customer_race",
    """SELECT customer, month, cast(sold AS double) AS total_sale, cast(cumulative AS double) AS cumulative
    FROM running WHERE customer IN (SELECT customer FROM running GROUP BY customer
    ORDER BY max(cumulative) DESC, customer LIMIT 10)""",
    "running",
)(ops.customer_race)


def _favourite_sql(column: str) -> str:
    return f"""(SELECT customer_id, string_agg({column} || ':' || n, ', ' ORDER BY n DESC, {column}) AS list
      FROM (SELECT customer_id, {column}, count(*) AS n, row_number() OVER (PARTITION BY customer_id
        ORDER BY count(*) DESC, {column}) AS place FROM sales GROUP BY customer_id, {column})
      WHERE place <= 3 GROUP BY customer_id)"""


on_sales(
    "customer_profiles",
    f"""SELECT s.customer_id, s.customer, s.lines, s.total_sale, s.average_sale, s.last_order,
    m.list AS top_models, t.list AS top_themes, c.channel AS preferred_channel
    FROM (SELECT customer_id, min(first_name) || ' ' || min(last_name) AS customer, count(*) AS lines,
      {MONEY} AS total_sale, {MONEY} / count(*) AS average_sale,
      strftime(max(order_date), '%Y-%m-%d') AS last_order FROM sales GROUP BY customer_id) s
    JOIN {_favourite_sql('model_name')} m ON s.customer_id = m.customer_id
    JOIN {_favourite_sql('theme')} t ON s.customer_id = t.customer_id
    JOIN (SELECT customer_id, sales_channel AS channel, row_number() OVER (PARTITION BY customer_id
      ORDER BY count(*) DESC, sales_channel) AS place FROM sales GROUP BY customer_id, sales_channel) c
      ON s.customer_id = c.customer_id AND c.place = 1""",
    with_customers=True,
)(ops.customer_profiles)

on_sales(
    "calendar_daily",
    f"""SELECT strftime(order_date, '%Y-%m-%d') AS day, cast(weekofyear(order_date) AS int) AS week,
    cast(isodow(order_date) - 1 AS int) AS weekday, cast(year(order_date) AS int) AS year,
    {MONEY} AS total_sale FROM sales GROUP BY ALL""",
)(ops.calendar_daily)
on_sales(
    "calendar_matrix",
    f"""SELECT cast(weekofyear(order_date) AS int) AS week, cast(isodow(order_date) - 1 AS int) AS weekday,
    {MONEY} AS total_sale FROM sales GROUP BY ALL""",
)(ops.calendar_matrix)
on_sales(
    "price_scenarios",
    f"""SELECT model_name, price_change, current_quantity, current_price, current_revenue, new_price,
    new_quantity, new_price * new_quantity AS new_revenue,
    (new_price * new_quantity - current_revenue) / current_revenue * 100 AS revenue_change
    FROM (SELECT *, current_price * (1 + price_change / cast(100.0 AS double)) AS new_price,
      cast(trunc(current_quantity * (1 + cast(-1.5 AS double) * price_change / cast(100.0 AS double)))
        AS bigint) AS new_quantity
      FROM (SELECT model_name, count(*) AS current_quantity,
        cast(sum(price_at_purchase) AS double) / count(*) AS current_price, {MONEY} AS current_revenue
        FROM sales GROUP BY model_name), (SELECT unnest(generate_series(-50, 50, 5)) AS price_change))""",
)(ops.price_scenarios)

on_sales(
    "best_month",
    f"""SELECT strftime(order_date, '%Y-%m') AS month, {MONEY} AS total_sale FROM sales GROUP BY 1
    ORDER BY total_sale DESC, month LIMIT 1""",
)(ops.best_month)


@on_sales(
    "revenue_by_month",
    f"SELECT strftime(order_date, '%Y-%m') AS month, {MONEY} AS total_sale FROM sales GROUP BY 1",
)
def _(sales):
    return ops.revenue_by(sales.withColumn("month", month_label(F.col("order_date"))), "month")


on_sales(
    "loyal_customers",
    f"""SELECT customer_id, first_name, last_name, count(DISTINCT order_id) AS orders,
    {MONEY} AS total_sale FROM sales GROUP BY 1, 2, 3
    ORDER BY orders DESC, total_sale DESC, customer_id LIMIT 5""",
    with_customers=True,
)(ops.loyal_customers)
on_sales(
    "best_sellers_by_theme",
    """SELECT theme, model_name, units, place FROM (SELECT theme, model_name,
    cast(sum(quantity) AS bigint) AS units,
    cast(row_number() OVER (PARTITION BY theme ORDER BY sum(quantity) DESC, model_name) AS int) AS place
    FROM sales GROUP BY 1, 2) WHERE place <= 3""",
)(ops.best_sellers_by_theme)
on_sales(
    "basket_by_channel",
    f"""SELECT sales_channel, count(DISTINCT order_id) AS orders,
    {MONEY} / count(DISTINCT order_id) AS average_basket FROM sales GROUP BY 1""",
)(ops.basket_by_channel)
on_sales(
    "new_customers_by_quarter",
    """SELECT year(first) || '-Q' || quarter(first) AS quarter, count(*) AS new_customers
    FROM (SELECT min(order_date) AS first FROM sales GROUP BY customer_id) GROUP BY 1""",
)(ops.new_customers_by_quarter)


@on_sales(
    "context_top_products",
    f"""SELECT model_name, theme, {MONEY} AS total_sale FROM sales GROUP BY ALL
    ORDER BY total_sale DESC, model_name, theme LIMIT 5""",
)
def _(sales):
    keys = ["model_name", "theme"]
    return ops.largest(ops.revenue_by(sales, *keys), "total_sale", keys, 5)


@on_sales("distinct_choices", "SELECT DISTINCT theme, model_name FROM sales")
def _(sales):
    return sales.select("theme", "model_name").distinct()


@on_sales(
    "upper_case_orders",
    f"""SELECT order_id AS "ORDER_ID", {MONEY} AS "ORDER_TOTAL" FROM sales GROUP BY order_id""",
)
def _(sales):
    totals = sales.groupBy("order_id").agg(F.sum("total_sale").cast("double").alias("order_total"))
    return upper_case_columns(totals)


# --- recency, frequency, monetary --------------------------------------------------------------


@on_sales(
    "rfm_table", "SELECT customer_id, recency, frequency, monetary FROM rfm", "rfm"
)
def _(sales):
    return rfm.rfm_table(sales)


@on_sales(
    "rfm_as_of",
    f"""SELECT customer_id, date_sub('day', last_order, timestamp '{RETAIL_AS_OF}') AS recency,
    frequency, monetary FROM rfm_base""",
    "rfm_base",
)
def _(sales):
    return rfm.rfm_table(sales, RETAIL_AS_OF)


on_sales(
    "rfm_scores",
    """SELECT customer_id, recency, frequency, monetary, cast(r_score AS int) AS r_score,
    cast(f_score AS int) AS f_score, cast(m_score AS int) AS m_score, segment FROM scored""",
    "scored",
)(rfm.rfm_scores)


@on_sales(
    "rfm_segment_counts",
    "SELECT segment, count(*) AS customers FROM scored GROUP BY segment",
    "scored",
)
def _(sales):
    return rfm.segment_counts(rfm.rfm_scores(sales))


on_sales("quantile_segments", "SELECT * FROM segmented", "segmented", with_customers=True)(
    rfm.quantile_segments
)


@on_sales(
    "quantile_segment_statistics",
    """SELECT segment, count(customer) AS customers,
    round(cast(sum(cast(monetary AS decimal(28,2))) AS double) / count(monetary), 2) AS average_monetary
    FROM segmented GROUP BY segment""",
    "segmented",
    with_customers=True,
)
def _(sales, customers):
    return rfm.segment_statistics(rfm.quantile_segments(sales, customers))


def _describe_sql(column: str) -> str:
    x = f"cast({column} AS double)"
    return f"""SELECT '{column}' AS column_name, count({column}) AS row_count,
      cast(sum(cast({column} AS decimal(28,2))) AS double) / count({column}) AS mean,
      round(stddev_samp({x}), 4) AS std, min({x}) AS min, max({x}) AS max,
      round(quantile_cont({x}, 0.25), 4) AS q25, round(quantile_cont({x}, 0.5), 4) AS q50,
      round(quantile_cont({x}, 0.75), 4) AS q75 FROM aged"""


@on_sales(
    "rfm_description",
    f"""SELECT * FROM (WITH aged AS (SELECT date_sub('day', last_order, timestamp '{RETAIL_AS_OF}')
      AS recency, frequency, monetary FROM rfm_base) """
    + " UNION ALL ".join(_describe_sql(c) for c in ("recency", "frequency", "monetary"))
    + ")",
    "rfm_base",
)
def _(sales):
    return rfm.rfm_description(sales, RETAIL_AS_OF)


@on_sales(
    "days_since_last_sale",
    f"""SELECT theme, date_sub('day', max(order_date), timestamp '{RETAIL_AS_OF}') AS days
    FROM sales GROUP BY theme""",
)
def _(sales):
    last = sales.groupBy("theme").agg(F.max("order_date").alias("last"))
    at = F.lit(RETAIL_AS_OF).cast("timestamp_ntz")
    return last.select("theme", elapsed_days(F.col("last"), at).alias("days"))


# --- models ------------------------------------------------------------------------------------

@on_sales("customer_clusters", "SELECT * FROM clustered", needs="clustered")
def _(sales):
    found = models.customer_clusters(sales, RETAIL_AS_OF)
    return found.withColumn("training_cost", F.round("training_cost", 2))


@on_sales(
    "value_by_cluster",
    """SELECT segment, count(*) AS customers, round(cast(sum(monetary::decimal(18,2)) AS double) / count(*), 4) AS average_monetary
    FROM clustered GROUP BY segment""",
    needs="clustered",
)
def _(sales):
    values = models.value_by_cluster(models.customer_clusters(sales, RETAIL_AS_OF))
    return values.withColumn("average_monetary", F.round("average_monetary", 4))


@on_sales("sales_forecast")
def _(sales):
    return models.sales_forecast(sales)


@on_sales("sales_forecast_by_theme")
def _(sales):
    return models.sales_forecast(sales, "theme")


@on_sales(
    "sales_forecast_by_model",
    """SELECT model_name AS series, cast(step AS int) AS step, cast(last + cast(step AS int) AS date) AS day, true AS ordered
    FROM (SELECT model_name, min(cast(order_date AS date)) AS first, max(cast(order_date AS date)) AS last
          FROM sales GROUP BY ALL), range(1, 31) t(step)
    WHERE last - first >= 13""",
)
def _(sales):
    """A series per model: 30 days after its last sale, the mean within its limits."""
    found = models.sales_forecast(sales, "model_name")
    ordered = (F.col("lower") <= F.col("mean")) & (F.col("mean") <= F.col("upper"))
    return found.select("series", "step", "day", ordered.alias("ordered"))
