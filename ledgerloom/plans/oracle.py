"""Common table expressions shared by the SQL twins."""

from __future__ import annotations

from ledgerloom.plans.registry import RETAIL_AS_OF

# name -> (names it needs, SELECT text)
CTES: dict[str, tuple[tuple[str, ...], str]] = {
    "r_orders": (
        (),
        """SELECT o_orderkey AS order_id, o_custkey AS customer_id, o_orderdate AS order_date,
        CASE o_orderstatus WHEN 'F' THEN 'delivered' WHEN 'O' THEN 'shipped' WHEN 'P' THEN 'cancelled' END
          AS order_status,
        CASE WHEN o_orderpriority IN ('1-URGENT','2-HIGH') THEN 'online' ELSE 'in_person' END
          AS sales_channel
        FROM orders""",
    ),
    "r_customers": (
        (),
        """SELECT c_custkey AS customer_id, c_mktsegment AS first_name, c_name AS last_name,
        cast(NULL AS varchar) AS email, cast(c_acctbal AS decimal(18,2)) AS balance FROM customer""",
    ),
    "r_items": (
        (),
        """SELECT l_orderkey AS order_id, l_partkey AS product_id, cast(l_quantity AS bigint) AS quantity,
        cast(l_extendedprice AS decimal(18,2)) AS price_at_purchase,
        cast(cast(l_quantity AS bigint) * cast(l_extendedprice AS decimal(18,2)) AS decimal(18,2))
          AS total_sale
        FROM lineitem""",
    ),
    "r_products": (
        (),
        """SELECT p_partkey AS product_id, p_brand AS model_name, p_type AS theme, p_name AS finish,
        cast(p_retailprice AS decimal(18,2)) AS base_price FROM part""",
    ),
    "sales": (
        ("r_orders", "r_customers", "r_items", "r_products"),
        """SELECT o.order_id, o.order_date, o.sales_channel, c.customer_id, c.first_name, c.last_name,
        p.product_id, p.model_name, p.theme, p.finish, i.quantity, i.price_at_purchase, i.total_sale
        FROM r_orders o JOIN r_customers c ON o.customer_id = c.customer_id
        JOIN r_items i ON o.order_id = i.order_id
        JOIN r_products p ON i.product_id = p.product_id
        WHERE o.order_status <> 'cancelled'""",
    ),
    "frame": (
        ("r_orders", "r_customers", "r_items", "r_products"),
        """SELECT o.order_id, o.order_date, o.sales_channel, o.order_status, c.customer_id,
        c.first_name, c.last_name, c.email, p.product_id, p.model_name, p.theme, p.finish,
        p.base_price, i.quantity, i.price_at_purchase, i.total_sale
        FROM r_orders o LEFT JOIN r_customers c ON o.customer_id = c.customer_id
        LEFT JOIN r_items i ON o.order_id = i.order_id
        LEFT JOIN r_products p ON i.product_id = p.product_id""",
    ),
    "cards": (
        (),
        """SELECT event_id AS element, 'basic-card' AS object_type,
        event_id + 1000000000 AS transaction_id,
        CASE event_type WHEN 'purchase' THEN 'PURCHASE' WHEN 'error' THEN 'REFUND'
          ELSE upper(event_type) END AS transaction_type,
        cast(cast(value AS decimal(10,2)) * 20 AS decimal(10,2)) AS amount, 'USD' AS currency,
        ts AS transaction_timestamp, event_type <> 'error' AS approved,
        4000000000000000 + user_id AS card_number,
        cast(json_extract(props, '$.k') AS bigint) AS merchant_id
        FROM events""",
    ),
    "support": (
        (),
        """SELECT p_name AS item, o_orderdate AS purchase_time, c_name AS name, n_name AS state
        FROM lineitem JOIN part ON l_partkey = p_partkey JOIN orders ON l_orderkey = o_orderkey
        JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey""",
    ),
    "daily": (
        ("sales",),
        """SELECT cast(d.day AS date) AS day, coalesce(s.sold, 0) AS sold
        FROM (SELECT unnest(generate_series(min(cast(order_date AS date)), max(cast(order_date AS date)),
                interval 1 day)) AS day FROM sales) d
        LEFT JOIN (SELECT cast(order_date AS date) AS day, sum(total_sale) AS sold
                   FROM sales GROUP BY 1) s ON cast(d.day AS date) = s.day""",
    ),
    "rfm_base": (
        ("sales",),
        """SELECT customer_id, max(order_date) AS last_order, count(DISTINCT order_id) AS frequency,
        cast(sum(total_sale) AS double) AS monetary, min(first_name) AS first_name,
        min(last_name) AS last_name FROM sales GROUP BY customer_id""",
    ),
    "rfm": (
        ("rfm_base",),
        """SELECT customer_id, date_sub('day', last_order,
          (SELECT max(last_order) + interval 1 day FROM rfm_base)) AS recency,
        frequency, monetary, first_name, last_name FROM rfm_base""",
    ),
    "rfm_ranked": (
        ("rfm",),
        """SELECT *, row_number() OVER (ORDER BY frequency, customer_id) AS f_rank FROM rfm""",
    ),
    "rfm_edges": (
        ("rfm_ranked",),
        """SELECT
        quantile_cont(cast(recency AS double), [0.0,0.25,0.5,0.75,1.0]) AS r,
        quantile_cont(cast(f_rank AS double), [0.0,0.25,0.5,0.75,1.0]) AS f,
        quantile_cont(monetary, [0.0,0.25,0.5,0.75,1.0]) AS m FROM rfm_ranked""",
    ),
    "scored": (
        ("rfm_ranked", "rfm_edges"),
        """SELECT *, CASE WHEN r_score >= 4 AND f_score >= 4 THEN 'Champions'
          WHEN f_score >= 4 THEN 'Clients Loyaux'
          WHEN r_score <= 2 AND f_score <= 2 THEN 'Clients à Risque' ELSE 'Standard' END AS segment
        FROM (SELECT customer_id, recency, frequency, monetary,
          CASE WHEN len(list_distinct(r)) < 5 THEN 1 WHEN recency <= r[2] THEN 4 WHEN recency <= r[3] THEN 3
            WHEN recency <= r[4] THEN 2 ELSE 1 END AS r_score,
          CASE WHEN len(list_distinct(f)) < 5 THEN 1 WHEN f_rank <= f[2] THEN 1 WHEN f_rank <= f[3] THEN 2
            WHEN f_rank <= f[4] THEN 3 ELSE 4 END AS f_score,
          CASE WHEN len(list_distinct(m)) < 5 THEN 1 WHEN monetary <= m[2] THEN 1 WHEN monetary <= m[3] THEN 2
            WHEN monetary <= m[4] THEN 3 ELSE 4 END AS m_score
          FROM rfm_ranked, rfm_edges)""",
    ),
    "segmented": (
        ("rfm",),
        """SELECT customer_id, first_name || ' ' || last_name AS customer, recency, frequency, monetary,
        CASE WHEN recency > q.r75 THEN 'À Risque' WHEN frequency > q.f75 THEN 'Loyaux'
          WHEN monetary > q.m75 AND recency < q.r25 THEN 'Champions' ELSE 'Standard' END AS segment
        FROM rfm, (SELECT quantile_cont(cast(recency AS double), 0.25) AS r25,
          quantile_cont(cast(recency AS double), 0.75) AS r75,
          quantile_cont(cast(frequency AS double), 0.75) AS f75,
          quantile_cont(monetary, 0.75) AS m75 FROM rfm) q""",
    ),
    "models": (
        ("sales",),
        "SELECT order_id, model_name, count(*) AS lines FROM sales GROUP BY ALL",
    ),
    "edges": (
        ("models",),
        """SELECT a, b, cast(sum(w) AS bigint) AS weight FROM (
          SELECT x.model_name AS a, y.model_name AS b, x.lines * y.lines AS w
          FROM models x JOIN models y ON x.order_id = y.order_id AND x.model_name < y.model_name
          UNION ALL SELECT model_name, model_name, lines * (lines - 1) // 2 FROM models)
        GROUP BY a, b HAVING sum(w) > 0""",
    ),
    "active_months": (
        ("sales",),
        """SELECT DISTINCT customer_id, year(order_date) * 12 + month(order_date) AS m FROM sales""",
    ),
    "cohorts": (
        ("active_months",),
        """SELECT first AS cohort, m - first AS cohort_index, count(*) AS customers
        FROM (SELECT *, min(m) OVER (PARTITION BY customer_id) AS first FROM active_months)
        GROUP BY ALL""",
    ),
    "retention": (
        ("cohorts",),
        """SELECT printf('%04d-%02d', (c.cohort - 1) // 12, (c.cohort - 1) % 12 + 1) AS cohort_month,
        c.cohort_index, c.customers, c.customers * cast(100.0 AS double) / z.customers AS retention
        FROM cohorts c JOIN cohorts z ON c.cohort = z.cohort AND z.cohort_index = 0""",
    ),
    "running": (
        ("sales",),
        """SELECT customer, month, sold, sum(sold) OVER (PARTITION BY customer ORDER BY month
          ROWS UNBOUNDED PRECEDING) AS cumulative
        FROM (SELECT first_name || ' ' || last_name AS customer, strftime(order_date, '%Y-%m') AS month,
          sum(total_sale) AS sold FROM sales GROUP BY ALL)""",
    ),
    "flows": (
        (),
        """SELECT *, concat_ws('|', dependency_level, source_object, target_object) AS lineage_id FROM (
        SELECT DISTINCT 'R:' || r_name AS source_object, 'N:' || n_name AS target_object,
          'REGION' AS transformation_type, 1 AS dependency_level
        FROM nation JOIN region ON n_regionkey = r_regionkey
        UNION ALL SELECT DISTINCT 'N:' || n_name, 'S:' || c_mktsegment, 'MARKET', 2
        FROM customer JOIN nation ON c_nationkey = n_nationkey
        UNION ALL SELECT DISTINCT 'S:' || c_mktsegment, 'P:' || o_orderpriority, 'ORDER', 3
        FROM orders JOIN customer ON o_custkey = c_custkey)""",
    ),
    "usage": (
        (),
        """SELECT 'WH_' || upper(event_type) AS warehouse_name,
        cast(date_trunc('hour', ts) AS timestamp) AS start_time,
        cast(sum(cast(value AS decimal(10,2))) * 100 AS bigint) * 10 AS credits_micro,
        cast(sum(CASE WHEN cast(value AS decimal(10,2)) > 50 THEN 1 ELSE 0 END) AS bigint) AS query_count,
        cast(floor(max(cast(value AS decimal(10,2))) * 300) AS bigint) AS avg_execution_time,
        cast(floor(sum(cast(value AS decimal(10,2))) * 4000000) AS bigint) AS total_bytes_scanned
        FROM events GROUP BY ALL""",
    ),
    "costs": (
        ("usage",),
        """SELECT DISTINCT warehouse_name, credits_micro, query_count, avg_execution_time,
        total_bytes_scanned,
        CASE WHEN query_count > 0
          THEN (2 * credits_micro + query_count) // (2 * query_count) END AS cost_micro,
        CASE WHEN avg_execution_time > 60000 THEN 'Consider query optimization'
          WHEN query_count > 0 AND credits_micro > 100000 * query_count THEN 'High cost per query'
          WHEN total_bytes_scanned > 1000000000 THEN 'Consider result caching'
          ELSE 'Operating efficiently' END AS optimization_opportunities
        FROM usage""",
    ),
    "runs": (
        (),
        """SELECT upper(event_type) || '_TASK' AS task_name,
        CASE WHEN cast(json_extract(props, '$.k') AS bigint) < 10 THEN 'FAILED' ELSE 'SUCCEEDED' END AS state,
        date_diff('second', ts, ts + to_microseconds(cast(cast(value AS decimal(10,2)) * 1000000 AS bigint)))
          AS seconds
        FROM events""",
    ),
    "loads": (
        (),
        """SELECT upper(event_type) || '_STAGING' AS table_name,
        event_type || '_' || strftime(ts, '%Y%m%d') || '.json' AS file_name, count(*) AS row_parsed,
        cast(sum(CASE WHEN cast(json_extract(props, '$.k') AS bigint) < 99 THEN 1 ELSE 0 END) AS bigint)
          AS row_count,
        cast(sum(CASE WHEN cast(json_extract(props, '$.k') AS bigint) >= 99 THEN 1 ELSE 0 END) AS bigint)
          AS error_count,
        cast(sum(length(props)) AS bigint) AS bytes_loaded, max(ts) AS last_load_time
        FROM events GROUP BY 1, 2""",
    ),
    "daily_checks": (
        ("cards",),
        """SELECT cast(date_trunc('day', transaction_timestamp) AS timestamp) + interval 1 day AS measured,
        count(*) AS n, count(transaction_id) AS c1, count(amount) AS c2, count(card_number) AS c3,
        count(*) FILTER (amount BETWEEN 0 AND 10000) AS v1,
        count(*) FILTER (length(cast(card_number AS varchar)) BETWEEN 15 AND 19) AS v2,
        count(*) FILTER (currency = 'USD') AS s1,
        count(*) FILTER (transaction_type IN ('PURCHASE','REFUND')) AS s2
        FROM cards GROUP BY 1""",
    ),
    "daily_metrics": (
        ("daily_checks",),
        """SELECT metric_name, split_part(metric_name, '_', 1) AS metric_category,
        cast((good * 2000000 + n) // (2 * n) AS double) / 10000 AS metric_value, n AS total_records,
        measured AS measurement_timestamp
        FROM (SELECT measured, n, unnest(['COMPLETENESS_TRANSACTION_ID','COMPLETENESS_AMOUNT',
          'COMPLETENESS_CARD_NUMBER','VALIDITY_AMOUNT_RANGE','VALIDITY_CARD_NUMBER_FORMAT',
          'CONSISTENCY_CURRENCY_USD','CONSISTENCY_TRANSACTION_TYPES']) AS metric_name,
          unnest([c1, c2, c3, v1, v2, s1, s2]) AS good FROM daily_checks)""",
    ),
    # Lloyd's passes of ten starts side by side: first centres by md5, nearest centre, means, until no centre moves by
    # more than a hundredth of the spread; then the start that holds most of the squares, its labels and names.
    "c_points": (
        ("rfm_base",),
        f"""SELECT customer_id, date_sub('day', last_order, timestamp '{RETAIL_AS_OF}') AS r, frequency AS f, monetary,
        cast(round(monetary * 100) AS bigint) AS cents, cast(round(monetary * 100) AS bigint) / 100.0::double AS m
      FROM rfm_base""",
    ),
    "c_totals": (
        ("c_points",),
        """SELECT count(*) AS n, sum(r)::double AS r, sum(f)::double AS f, sum(cents)::double / 100 AS m,
        sum(r::hugeint * r)::double + sum(f::hugeint * f)::double + sum(cents::hugeint * cents)::double / 10000 AS squares
      FROM c_points""",
    ),
    "c_passes": (
        ("c_points", "c_totals",),
        """WITH RECURSIVE passes AS (
      SELECT s, j, 0 AS pass, r::double AS x, f::double AS y, m AS z, false AS done, 0::double AS held FROM (
        SELECT s, r, f, m, row_number() OVER (PARTITION BY s ORDER BY md5(s || ':' || customer_id), customer_id) - 1 AS j
        FROM c_points, range(42, 52) t(s)) WHERE j < 4
      UNION ALL
      SELECT s, j, pass + 1, x, y, z,
        max(moved) OVER (PARTITION BY s) <= 1e-4::double * (SELECT (squares - (r * r / n + f * f / n + m * m / n)) / n / 3 FROM c_totals),
        sum(part) OVER (PARTITION BY s ORDER BY j ROWS BETWEEN UNBOUNDED PRECEDING AND UNBOUNDED FOLLOWING)
      FROM (
        SELECT o.s, o.j, o.pass, coalesce(u.x, o.x) AS x, coalesce(u.y, o.y) AS y, coalesce(u.z, o.z) AS z, coalesce(u.part, 0) AS part,
          coalesce((u.x - o.x) * (u.x - o.x) + (u.y - o.y) * (u.y - o.y) + (u.z - o.z) * (u.z - o.z), 0) AS moved
        FROM passes o LEFT JOIN (
          SELECT s, j, sum(r)::double / count(*) AS x, sum(f)::double / count(*) AS y, sum(cents)::double / (count(*) * 100) AS z,
            (sum(r)::double * sum(r)::double + sum(f)::double * sum(f)::double
              + (sum(cents)::double / 100) * (sum(cents)::double / 100)) / count(*) AS part
          FROM (SELECT c.s, p.customer_id, any_value(p.r) AS r, any_value(p.f) AS f, any_value(p.cents) AS cents,
              arg_min(c.j, struct_pack(d := (p.r - c.x) * (p.r - c.x) + (p.f - c.y) * (p.f - c.y) + (p.m - c.z) * (p.m - c.z), j := c.j)) AS j
            FROM c_points p, passes c WHERE NOT c.done GROUP BY c.s, p.customer_id)
          GROUP BY s, j) u ON u.s = o.s AND u.j = o.j
        WHERE NOT o.done))
    SELECT * FROM passes WHERE done""",
    ),
    "c_best": (
        ("c_passes", "c_totals",),
        """SELECT p.*, t.squares - held AS cost FROM c_passes p, c_totals t
      WHERE s = (SELECT arg_min(s, struct_pack(h := -held, s := s)) FROM c_passes)""",
    ),
    "clustered": (
        ("c_points", "c_best", "c_totals",),
        """SELECT customer_id, recency, frequency, monetary, cluster, round(cost, 2) AS training_cost,
        CASE WHEN z > t_m AND x < t_r THEN 'Champions' WHEN x > t_r * 1.5 THEN 'À Risque'
          WHEN y > t_f THEN 'Clients Loyaux' ELSE 'Standard' END AS segment
      FROM (SELECT p.customer_id, any_value(p.r) AS recency, any_value(p.f) AS frequency, any_value(p.monetary) AS monetary,
          arg_min(b.j, struct_pack(d := (p.r - b.x) * (p.r - b.x) + (p.f - b.y) * (p.f - b.y) + (p.m - b.z) * (p.m - b.z), j := b.j))::int
            AS cluster
        FROM c_points p, c_best b GROUP BY p.customer_id) a
      JOIN c_best b ON b.j = a.cluster, (SELECT r / n AS t_r, f / n AS t_f, m / n AS t_m FROM c_totals)""",
    ),
}


def sql(needs: str, body: str) -> str:
    """Body preceded by the table expressions it names and everything they depend on."""
    ordered: list[str] = []

    def visit(name: str) -> None:
        if name not in ordered:
            for dependency in CTES[name][0]:
                visit(dependency)
            ordered.append(name)

    for name in needs.split():
        visit(name)
    if not ordered:
        return body
    return "WITH " + ",\n".join(f"{n} AS ({CTES[n][1]})" for n in ordered) + "\n" + body
