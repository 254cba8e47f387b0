"""SQL with the same answers as the named queries, for checking them on another engine."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

# What each recommendation implies and advises.
RULE_TEXTS = {
    "global-product-margin-pressure": (
        "A large revenue base is carrying weaker unit economics than the typical product, so growth may be less valuable than it appears.",
        "Review pricing, discount thresholds, and cost drivers for this product before increasing demand-generation spend.",
    ),
    "global-channel-discount-spread": (
        "Commercial volume in this channel is more dependent on price concessions, increasing the risk of margin leakage.",
        "Introduce approval bands for high-discount transactions and evaluate whether volume gains offset foregone gross profit.",
    ),
    "global-regional-economics-gap": (
        "The regional revenue mix is economically uneven and may reflect logistics cost, discount mix, or product mix differences.",
        "Decompose the regional gap by category and channel before setting a region-wide growth target.",
    ),
    "global-category-profit-underweight": (
        "Revenue concentration in the category overstates its contribution to economic value.",
        "Prioritize high-margin products within the category and test lower discount ceilings on weak-margin combinations.",
    ),
    "global-segment-discount-governance": (
        "Large negotiated discounts can be economically justified only if they are supported by sufficient volume, retention, or lower service cost.",
        "Create segment-specific discount guardrails tied to contribution margin rather than using revenue alone.",
    ),
    "global-discount-pool": (
        "Even small improvements in discount discipline can materially change gross profit at this revenue scale.",
        "Track discount amount as a controllable investment and review the top product-channel combinations consuming it each month.",
    ),
    "scope": (
        "The filtered commercial slice deserves a mix, pricing, or cost review before pursuing additional volume.",
        "Inspect the next-level product and channel mix, then target the specific combinations driving the gap.",
    ),
    "product-tension": (
        "Scaling demand without fixing economics can grow low-quality revenue.",
        "Review pricing, discount approval, and unit cost before increasing acquisition spend.",
    ),
    "discount-spend": (
        "Discount is a commercial investment and should be measured against incremental volume and profit.",
        "Rank customers, channels, and products by discount leakage and introduce approval bands for the weakest economics.",
    ),
    "margin-gap": (
        "The performance gap is large enough to justify a mix, pricing, or cost investigation.",
        None,
    ),
}

FACTS = """
lines AS (
  SELECT 'TXN-' || CAST(l_orderkey * 10 + l_linenumber AS VARCHAR) AS transaction_id,
         'ORD-' || CAST(l_orderkey AS VARCHAR) AS order_id,
         CAST(o_orderdate AS DATE) AS order_date,
         coalesce(r_name, 'Unspecified') AS region, coalesce(o_orderpriority, 'Unspecified') AS channel,
         coalesce(c_mktsegment, 'Unspecified') AS customer_segment, coalesce(p_type, 'Unspecified') AS category,
         coalesce(p_type || ' ' || p_name, 'Unspecified') AS product,
         CAST(l_quantity AS BIGINT) AS quantity,
         CAST(l_extendedprice AS DECIMAL(15,2)) AS gross,
         CAST(l_discount AS DECIMAL(4,2)) AS discount_rate,
         CAST(p_retailprice AS DECIMAL(15,2)) AS unit_cost
  FROM lineitem
  LEFT JOIN part ON p_partkey = l_partkey
  LEFT JOIN orders ON o_orderkey = l_orderkey
  LEFT JOIN customer ON c_custkey = o_custkey
  LEFT JOIN nation ON n_nationkey = c_nationkey
  LEFT JOIN region ON r_regionkey = n_regionkey
),
amounts AS (
  SELECT *, CAST(gross AS DECIMAL(18,4)) AS gross_revenue,
         CAST(gross * discount_rate AS DECIMAL(18,4)) AS discount_amount,
         CAST(quantity * unit_cost AS DECIMAL(18,4)) AS cost
  FROM lines
),
profits AS (
  SELECT *, CAST(gross_revenue - discount_amount AS DECIMAL(18,4)) AS net_revenue,
         CAST(gross_revenue - discount_amount - cost AS DECIMAL(18,4)) AS gross_profit
  FROM amounts
),
facts AS (
  SELECT *, CAST(gross_profit AS DOUBLE) / nullif(CAST(net_revenue AS DOUBLE), 0) AS gross_margin,
         CAST(gross_revenue - cost AS DOUBLE) / nullif(CAST(gross_revenue AS DOUBLE), 0) AS margin_before_discount,
         CAST(year(order_date) AS BIGINT) AS year,
         CAST(year(order_date) AS VARCHAR) || 'Q' || CAST(quarter(order_date) AS VARCHAR) AS quarter,
         strftime(order_date, '%Y-%m') AS month,
         CAST(month(order_date) AS BIGINT) AS month_of_year
  FROM profits
)"""

DIMENSIONS = ("region", "channel", "customer_segment", "category", "product")

BY_DIMENSION = "sliced AS (\n  " + "\n  UNION ALL ".join(
    f"SELECT '{d}' AS dimension, {d} AS value, * FROM facts" for d in DIMENSIONS
) + "\n)"

SUMS = {
    "gross_revenue": "gross_revenue",
    "revenue": "net_revenue",
    "profit": "gross_profit",
    "cost": "cost",
    "discount_amount": "discount_amount",
}


def sums(names: Sequence[str] = tuple(SUMS)) -> str:
    return ", ".join(f"CAST(sum({SUMS[n]}) AS DOUBLE) AS {n}" for n in names)


UNITS = "CAST(sum(quantity) AS BIGINT) AS units"
ORDERS = "count(DISTINCT order_id) AS orders"
MARGIN = "profit / nullif(revenue, 0)"
RATE = "discount_amount / nullif(gross_revenue, 0)"


def grouped(by: str, source: str = "facts", where: str = "TRUE") -> str:
    """Economics per group with null-safe rates."""
    return (
        f"SELECT *, {MARGIN} AS margin, {RATE} AS discount_rate FROM ("
        f"SELECT {by}, {sums()}, {UNITS}, {ORDERS} FROM {source} WHERE {where} GROUP BY {by})"
    )


def query(body: str, *steps: str) -> str:
    return "WITH " + ",\n".join((FACTS.strip(), *steps)) + "\n" + body


def varied(sql: str, *changes: tuple[str, str]) -> str:
    """The same SQL with other literals."""
    for old, new in changes:
        if old not in sql:
            raise ValueError(f"No {old!r} in the SQL.")
        sql = sql.replace(old, new)
    return sql


def rounded(value: str, digits: int = 6) -> str:
    """Rounded without negative zeros."""
    return f"CASE WHEN round({value}, {digits}) = 0 THEN 0 ELSE round({value}, {digits}) END"


def rounding(columns: Mapping[str, int] | Sequence[str], digits: int = 6) -> str:
    """Replacement list that rounds result columns."""
    pairs = columns.items() if isinstance(columns, Mapping) else ((c, digits) for c in columns)
    return "REPLACE (" + ", ".join(f"{rounded(c, d)} AS {c}" for c, d in pairs) + ")"


RATES = rounding(("margin", "discount_rate"))


def economics(by: str, tail: str = "") -> str:
    return query(f"SELECT * {RATES} FROM ({grouped(by)}) {tail}")


def combination(a: str, b: str, limit: int) -> str:
    return economics(f"{a}, {b}", f"ORDER BY revenue DESC, {a}, {b} LIMIT {limit}")


SUMMARY = f"""summary AS (
  SELECT *, revenue / sum(revenue) OVER (PARTITION BY dimension) AS revenue_share,
         profit / sum(profit) OVER (PARTITION BY dimension) AS profit_share
  FROM ({grouped("dimension, value", "sliced")})
)"""

KPIS = query(
    """SELECT CAST(round(g, 2) AS DOUBLE) AS gross_revenue, CAST(round(n, 2) AS DOUBLE) AS net_revenue,
  CAST(round(n, 2) AS DOUBLE) AS revenue, units AS units_sold, orders,
  round(CAST(n AS DOUBLE) / orders, 2) AS average_order_value,
  round(CAST(n AS DOUBLE) / units, 2) AS average_selling_price,
  CAST(round(c, 2) AS DOUBLE) AS cost, CAST(round(p, 2) AS DOUBLE) AS gross_profit,
  round(CAST(p AS DOUBLE) / CAST(n AS DOUBLE), 4) AS gross_margin,
  CAST(round(d, 2) AS DOUBLE) AS discount_amount,
  round(CAST(d AS DOUBLE) / CAST(g AS DOUBLE), 4) AS discount_rate,
  round(CAST(g - c AS DOUBLE) / CAST(g AS DOUBLE), 4) AS margin_before_discount
FROM (SELECT sum(gross_revenue) AS g, sum(net_revenue) AS n, sum(cost) AS c, sum(gross_profit) AS p,
             sum(discount_amount) AS d, CAST(sum(quantity) AS BIGINT) AS units, count(DISTINCT order_id) AS orders
      FROM facts)"""
)

MONTHS = f"months AS ({grouped('month')})"

MONTHLY_PERFORMANCE = query(
    f"""SELECT * {rounding({
        "margin": 6, "discount_rate": 6, "mom_revenue_growth": 6, "mom_profit_growth": 6, "margin_change_pp": 4,
        "revenue_rolling_3m": 2, "profit_rolling_3m": 2, "yoy_revenue_growth": 6, "yoy_profit_growth": 6,
        "growth_acceleration": 6})}
FROM (SELECT *, mom_revenue_growth - lag(mom_revenue_growth) OVER (ORDER BY month) AS growth_acceleration FROM grown)
ORDER BY month""",
    MONTHS,
    """grown AS (
  SELECT *, revenue / nullif(lag(revenue) OVER w, 0) - 1 AS mom_revenue_growth,
         profit / nullif(lag(profit) OVER w, 0) - 1 AS mom_profit_growth,
         (margin - lag(margin) OVER w) * 100 AS margin_change_pp,
         avg(revenue) OVER (ORDER BY month ROWS 2 PRECEDING) AS revenue_rolling_3m,
         avg(profit) OVER (ORDER BY month ROWS 2 PRECEDING) AS profit_rolling_3m,
         revenue / nullif(lag(revenue, 12) OVER w, 0) - 1 AS yoy_revenue_growth,
         profit / nullif(lag(profit, 12) OVER w, 0) - 1 AS yoy_profit_growth
  FROM months WINDOW w AS (ORDER BY month)
)""",
)

DIMENSION_SUMMARY = query(
    f"SELECT * {rounding(('margin', 'discount_rate', 'revenue_share', 'profit_share'))} FROM summary",
    BY_DIMENSION,
    SUMMARY,
)

ZERO_SAFE = "coalesce(profit / nullif(revenue, 0), 0) AS margin, coalesce(discount_amount / nullif(gross_revenue, 0), 0) AS discount_rate"


def zero_safe(by: str) -> str:
    return f"SELECT *, {ZERO_SAFE} FROM (SELECT {by}, {sums()}, {UNITS} FROM facts GROUP BY {by})"


MONTHLY_SERIES = query(
    f"SELECT month, revenue, profit, round(margin, 6) AS margin, round(discount_rate, 6) AS discount_rate "
    f"FROM ({zero_safe('month')})"
)
PRODUCTS = f"products AS ({zero_safe('product')})"
PRODUCT_COLUMNS = (
    "product, revenue, profit, round(margin, 6) AS margin, round(discount_rate, 6) AS discount_rate, units"
)
PRODUCT_SERIES = query(f"SELECT {PRODUCT_COLUMNS} FROM products", PRODUCTS)
PRODUCT_TABLE = query(
    f"""SELECT product, revenue, profit, round(m, 6) AS margin, round(r, 6) AS discount_rate, units, m < 0.45 AS at_risk
FROM (SELECT product, revenue, profit, margin AS m, discount_rate AS r, units FROM products
      ORDER BY margin, product LIMIT 12)""",
    PRODUCTS,
)
PROFITABILITY_MAP = query(
    """SELECT product, revenue, round(margin, 6) AS margin, units, round(benchmark, 6) AS benchmark_margin,
  margin < benchmark AS below_benchmark
FROM products, (SELECT margin AS benchmark FROM (SELECT margin, row_number() OVER (ORDER BY margin) - 1 AS place,
                                                       count(*) OVER () AS n FROM products) WHERE place = n // 2)""",
    PRODUCTS,
)


def curve(dimension: str) -> str:
    return (
        f"SELECT {dimension}, CAST(revenue AS DOUBLE) AS revenue, "
        f"CAST(revenue AS DOUBLE) / CAST(sum(revenue) OVER () AS DOUBLE) AS revenue_share, "
        f"CAST(sum(revenue) OVER w AS DOUBLE) / CAST(sum(revenue) OVER () AS DOUBLE) AS cumulative_revenue_share, "
        f"row_number() OVER w AS rank "
        f"FROM (SELECT {dimension}, sum(net_revenue) AS revenue FROM facts GROUP BY {dimension}) "
        f"WINDOW w AS (ORDER BY revenue DESC, {dimension} ROWS UNBOUNDED PRECEDING)"
    )


def pareto(dimension: str) -> str:
    return query(
        f"SELECT * {rounding(('revenue_share', 'cumulative_revenue_share'))} FROM ({curve(dimension)}) ORDER BY rank"
    )


def pareto_summary(dimension: str) -> str:
    return f"""SELECT '{dimension}' AS dimension,
  count(*) FILTER (cumulative_revenue_share < 0.8) + 1 AS entities_for_80_percent, count(*) AS entity_count,
  round((count(*) FILTER (cumulative_revenue_share < 0.8) + 1) / CAST(count(*) AS DOUBLE), 4)
    AS share_of_entities_for_80_percent,
  round(sum(revenue_share) FILTER (rank <= 3), 4) AS top_3_revenue_share
FROM ({curve(dimension)})"""


DISCOUNT_DISTRIBUTION = query(
    f"SELECT * {RATES} FROM ({grouped('discount_bucket', 'banded', 'discount_bucket IS NOT NULL')})",
    """banded AS (
  SELECT * EXCLUDE (discount_rate), CASE WHEN discount_rate <= -0.001 THEN NULL WHEN discount_rate <= 0.05 THEN '0–5%'
    WHEN discount_rate <= 0.10 THEN '5–10%' WHEN discount_rate <= 0.15 THEN '10–15%'
    WHEN discount_rate <= 0.20 THEN '15–20%' WHEN discount_rate <= 0.26 THEN '20–26%'
    WHEN discount_rate <= 1 THEN '26%+' END AS discount_bucket
  FROM facts
)""",
)
DISCOUNT_SUMMARY = query(
    """SELECT round(rates / lines, 4) AS average_discount, round(discount / gross, 4) AS weighted_discount_rate,
  lost AS revenue_lost_to_discounts, round(before, 4) AS margin_before_discount, round(after, 4) AS margin_after_discount,
  round((before - after) * 100, 2) AS margin_erosion_pp
FROM (SELECT *, kept / gross AS before, profit / net AS after FROM (
  SELECT CAST(sum(discount_rate) AS DOUBLE) AS rates, count(discount_rate) AS lines,
         CAST(sum(discount_amount) AS DOUBLE) AS discount, CAST(round(sum(discount_amount), 2) AS DOUBLE) AS lost,
         CAST(sum(gross_revenue) AS DOUBLE) AS gross, CAST(sum(gross_revenue) - sum(cost) AS DOUBLE) AS kept,
         CAST(sum(net_revenue) AS DOUBLE) AS net, CAST(sum(gross_profit) AS DOUBLE) AS profit
  FROM facts))"""
)
DISCOUNT_LEAKAGE = query(
    """SELECT round(cutoff, 4) AS leakage_threshold, CAST(round(sum(net_revenue), 2) AS DOUBLE) AS leakage_revenue,
  CAST(round(sum(discount_amount), 2) AS DOUBLE) AS leakage_discount_amount, count(*) AS leakage_lines
FROM facts, (SELECT quantile_cont(CAST(discount_rate AS DOUBLE), 0.85) AS cutoff FROM facts)
WHERE CAST(discount_rate AS DOUBLE) >= cutoff GROUP BY cutoff"""
)
SPEARMAN = query(
    """SELECT round(corr(x, y), 6) AS discount_margin_spearman FROM (
  SELECT rank() OVER (ORDER BY discount_rate) + (count(*) OVER (PARTITION BY discount_rate) - 1) / 2.0::DOUBLE AS x,
         rank() OVER (ORDER BY gross_margin) + (count(*) OVER (PARTITION BY gross_margin) - 1) / 2.0::DOUBLE AS y
  FROM facts WHERE discount_rate IS NOT NULL AND gross_margin IS NOT NULL)"""
)


def anomalies(threshold: float, by: str = "", where: str = "TRUE") -> str:
    """Batch detector, optionally per slice."""
    key = f"{by}, " if by else ""
    long = " UNION ALL ".join(
        f"SELECT {key}month, '{m}' AS metric, {m} AS value FROM months WHERE {m} IS NOT NULL"
        for m in ("revenue", "profit", "margin")
    )
    on = " AND ".join(f"a.{c} = b.{c}" for c in ([by] if by else []) + ["metric"])
    return query(
        f"""SELECT {key}month, metric, CASE WHEN metric = 'margin' THEN round(value, 4) ELSE round(value, 2) END AS value,
  round(z, 3) AS robust_z_score, CASE WHEN z > 0 THEN 'high' ELSE 'low' END AS direction,
  CASE WHEN mad > 0 THEN 'MAD robust z-score' ELSE 'median-centered z-score fallback (MAD=0)' END AS method,
  CAST({threshold} AS DOUBLE) AS threshold
FROM (SELECT *, CASE WHEN mad > 0 THEN 0.6745 * (value - med) / mad WHEN sd = 0 THEN 0 ELSE (value - med) / sd END AS z
      FROM (SELECT a.*, b.med, b.sd, c.mad FROM long a JOIN centre b ON {on}
            JOIN spread c ON {on.replace("b.", "c.")}))
WHERE abs(z) >= {threshold} AND {where}""",
        f"months AS ({grouped(key + 'month')})",
        f"long AS ({long})",
        f"centre AS (SELECT {key}metric, median(value) AS med, stddev_pop(value) AS sd FROM long GROUP BY {key}metric)",
        f"spread AS (SELECT a.metric{', a.' + by if by else ''}, median(abs(value - med)) AS mad "
        f"FROM long a JOIN centre b ON {on} GROUP BY a.metric{', a.' + by if by else ''})",
    )


REVENUE_ANOMALIES = query(
    """SELECT month, 'revenue' AS metric, revenue AS value, round(z, 6) AS robust_z_score,
  CASE WHEN z > 0 THEN 'high' ELSE 'low' END AS direction,
  CASE WHEN mad > 1e-9 THEN 'MAD robust z-score' ELSE 'standard deviation fallback' END AS method,
  CAST(3 AS DOUBLE) AS threshold
FROM (SELECT month, revenue, mad, CASE WHEN mad > 1e-9 THEN 0.6745 * (revenue - med) / mad
             WHEN sd > 0 THEN (revenue - med) / sd ELSE 0 END AS z
      FROM months, centre, (SELECT median(abs(revenue - med)) AS mad FROM months, centre))
WHERE abs(z) >= 3 AND (SELECT count(*) FROM months) >= 6""",
    MONTHS,
    "centre AS (SELECT median(revenue) AS med, stddev_samp(revenue) AS sd FROM months)",
)

PRODUCT_ECONOMICS = query(
    """SELECT product, category, CAST(round(rev, 2) AS DOUBLE) AS revenue, CAST(round(prof, 2) AS DOUBLE) AS profit,
  round(m, 4) AS margin, round(r, 4) AS discount_rate, units, orders, round(growth, 4) AS recent_revenue_growth,
  round((last_margin - first_margin) * 100, 2) AS recent_margin_change_pp,
  CASE WHEN growth > 0.12 AND m > median_margin THEN 'strong-growth-strong-margin'
       WHEN growth > 0.12 AND last_margin < first_margin - 0.015 THEN 'growth-margin-pressure'
       WHEN growth < -0.08 THEN 'declining' ELSE 'stable' END AS growth_profile
FROM (SELECT t.*, e.first_margin, e.last_margin, coalesce(e.last_revenue / nullif(e.first_revenue, 0) - 1, 0) AS growth,
             (SELECT median(m) FROM totals) AS median_margin
      FROM totals t JOIN ends e USING (product))""",
    """totals AS (
  SELECT product, category, sum(net_revenue) AS rev, sum(gross_profit) AS prof,
         CAST(sum(gross_profit) AS DOUBLE) / nullif(CAST(sum(net_revenue) AS DOUBLE), 0) AS m,
         CAST(sum(discount_amount) AS DOUBLE) / nullif(CAST(sum(gross_revenue) AS DOUBLE), 0) AS r,
         CAST(sum(quantity) AS BIGINT) AS units, count(DISTINCT order_id) AS orders
  FROM facts GROUP BY product, category
)""",
    """by_month AS (
  SELECT *, row_number() OVER (PARTITION BY product ORDER BY month) AS a,
         row_number() OVER (PARTITION BY product ORDER BY month DESC) AS z
  FROM (SELECT product, month, CAST(sum(net_revenue) AS DOUBLE) AS revenue,
               CAST(sum(gross_profit) AS DOUBLE) / nullif(CAST(sum(net_revenue) AS DOUBLE), 0) AS margin
        FROM facts GROUP BY product, month)
)""",
    """ends AS (
  SELECT product, avg(revenue) FILTER (a <= 3) AS first_revenue, avg(revenue) FILTER (z <= 3) AS last_revenue,
         avg(margin) FILTER (a <= 3) AS first_margin, avg(margin) FILTER (z <= 3) AS last_margin
  FROM by_month GROUP BY product
)""",
)

VIEW = "region = 'ASIA' AND customer_segment = 'BUILDING'"
VIEW_KPIS = f"""SELECT *, {ZERO_SAFE}, coalesce(revenue / nullif(orders, 0), 0) AS average_order_value,
  coalesce(revenue / nullif(units, 0), 0) AS average_selling_price
FROM (SELECT {sums()}, {UNITS}, {ORDERS} FROM facts WHERE {{where}})"""
VIEW_ROUNDING = rounding(("margin", "discount_rate", "average_order_value", "average_selling_price"))
FILTERED_KPIS = query(
    f"SELECT * {VIEW_ROUNDING} FROM ("
    + VIEW_KPIS.format(where=f"{VIEW} AND order_date BETWEEN DATE '1997-01-01' AND DATE '1998-12-31'")
    + ")"
)
COMPARED = (
    ("revenue", "relative"),
    ("profit", "relative"),
    ("margin", "absolute"),
    ("discount_amount", "relative"),
    ("average_order_value", "relative"),
    ("average_selling_price", "relative"),
)
PERIOD_OVER_PERIOD = query(
    " UNION ALL ".join(
        f"SELECT '{m}' AS metric, '{kind}' AS change_kind, round(c.{m}, 6) AS current, round(p.{m}, 6) AS previous, "
        + (f"round(c.{m} / nullif(p.{m}, 0) - 1, 6)" if kind == "relative" else f"round(c.{m} - p.{m}, 6)")
        + " AS change FROM cur c, prev p"
        for m, kind in COMPARED
    ),
    "cur AS ("
    + VIEW_KPIS.format(where=f"{VIEW} AND order_date BETWEEN DATE '1997-01-01' AND DATE '1998-12-31'")
    + ")",
    "prev AS ("
    + VIEW_KPIS.format(where=f"{VIEW} AND order_date BETWEEN DATE '1995-01-02' AND DATE '1996-12-31'")
    + ")",
)


def brief(mode: str, previous: str) -> str:
    """One row comparing the latest month with a month picked by an SQL condition."""
    return query(
        f"""SELECT '{mode}' AS mode, c.month AS current_month, p.month AS previous_month,
  round(c.revenue - p.revenue, 6) AS revenue_delta, round(c.revenue / nullif(p.revenue, 0) - 1, 6) AS revenue_growth,
  round(c.profit - p.profit, 6) AS profit_delta, round(c.profit / nullif(p.profit, 0) - 1, 6) AS profit_growth,
  round(coalesce(c.margin, 0) - coalesce(p.margin, 0), 6) AS margin_delta
FROM months c, months p WHERE c.month = (SELECT max(month) FROM months) AND p.month = {previous}""",
        MONTHS,
    )


PRESENT_BEFORE = "(SELECT max(month) FROM months WHERE month < c.month)"
CALENDAR_BEFORE = "strftime(CAST(c.month || '-01' AS DATE) - INTERVAL {n} MONTH, '%Y-%m')"


def drivers(current: str, previous: str) -> str:
    """Top movers between two months given as SQL expressions."""
    return query(
        """SELECT direction, rank, CASE dimension WHEN 'customer_segment' THEN 'Segment' ELSE
    upper(dimension[1]) || dimension[2:] END AS dimension,
  CASE dimension WHEN 'customer_segment' THEN 'segment' ELSE dimension END AS filter_key, value,
  CAST(delta AS DOUBLE) AS delta, CAST(cur AS DOUBLE) AS current, CAST(prev AS DOUBLE) AS previous
FROM (SELECT *, row_number() OVER (PARTITION BY direction ORDER BY abs(delta) DESC, dimension, value) AS rank
      FROM (SELECT *, cur - prev AS delta, CASE WHEN cur > prev THEN 'positive' ELSE 'negative' END AS direction
            FROM moved) WHERE delta <> 0) WHERE rank <= 5""",
        BY_DIMENSION,
        f"picked AS (SELECT {current} AS now, {previous} AS before)",
        """moved AS (
  SELECT dimension, value, coalesce(sum(net_revenue) FILTER (month = now), 0) AS cur,
         coalesce(sum(net_revenue) FILTER (month = before), 0) AS prev
  FROM sliced, picked WHERE month = now OR month = before GROUP BY dimension, value
)""",
    )


LAST_MONTH = "(SELECT max(month) FROM facts)"
MONTH_BEFORE_LAST = "(SELECT max(month) FROM facts WHERE month < (SELECT max(month) FROM facts))"
LAST_COMPLETE = (
    "(SELECT max(month) FROM (SELECT month, max(order_date) AS d FROM facts GROUP BY month) "
    "WHERE month < (SELECT max(month) FROM facts) OR d = last_day(d))"
)
YEAR_BEFORE_COMPLETE = f"strftime(CAST({LAST_COMPLETE} || '-01' AS DATE) - INTERVAL 12 MONTH, '%Y-%m')"

OPPORTUNITY_RADAR = query(
    """SELECT CASE dimension WHEN 'customer_segment' THEN 'segment' ELSE dimension END || '-' || value AS id,
  CASE dimension WHEN 'customer_segment' THEN 'Segment' ELSE upper(dimension[1]) || dimension[2:] END AS dimension,
  CASE dimension WHEN 'customer_segment' THEN 'segment' ELSE dimension END AS filter_key, value, revenue,
  round(margin, 6) AS margin, round(discount_rate, 6) AS discount_rate, round(peer, 6) AS peer_discount_rate,
  round(recovery, 2) AS estimated_discount_recovery, round(gap, 6) AS margin_gap,
  CASE WHEN score >= greatest(all_profit * 0.025, all_revenue * 0.004) THEN 'high' ELSE 'medium' END AS priority,
  round(score, 2) AS priority_score
FROM (SELECT *, recovery + greatest(0, gap) * revenue * 0.25 AS score
      FROM (SELECT *, greatest(0, gross_revenue * (discount_rate - peer)) AS recovery,
                   all_profit / all_revenue - margin AS gap FROM rated JOIN peers USING (dimension), total))
WHERE recovery >= greatest(1, all_revenue * 1e-5) OR (gap >= 0.001 AND revenue >= all_revenue * 0.03)
ORDER BY score DESC, id LIMIT 5""",
    BY_DIMENSION,
    f"rated AS (SELECT *, {ZERO_SAFE} FROM (SELECT dimension, value, {sums()} FROM sliced GROUP BY dimension, value))",
    "peers AS (SELECT dimension, median(discount_rate) AS peer FROM rated GROUP BY dimension HAVING count(*) >= 2)",
    "total AS (SELECT CAST(sum(net_revenue) AS DOUBLE) AS all_revenue, CAST(sum(gross_profit) AS DOUBLE) AS all_profit FROM facts)",
)

BRIDGE_STEPS = ("gross_revenue", "discount_amount", "revenue", "cost", "profit")
BRIDGE_NAMES = {"revenue": "net_revenue", "profit": "gross_profit"}


def bridge(by: str = "") -> str:
    key = f"{by}, " if by else ""
    group = f"GROUP BY {by}" if by else ""
    return query(
        " UNION ALL ".join(
            f"SELECT {key}CAST({i} AS BIGINT) AS step, '{BRIDGE_NAMES.get(c, c)}' AS item, {c} AS amount FROM total"
            for i, c in enumerate(BRIDGE_STEPS, start=1)
        ),
        f"total AS (SELECT {key}{sums()} FROM facts {group})",
    )


SCENARIOS = """scenarios(scenario, price_pct, discount_pp, cost_pct) AS (VALUES
  ('Tighten discount 2pp', 0.0::DOUBLE, -2.0::DOUBLE, 0.0::DOUBLE), ('Cost +5% shock', 0.0, 0.0, 5.0),
  ('Price +3%', 3.0, 0.0, 0.0), ('Price -10%, cost -5%', -10.0, 0.0, -5.0),
  ('Discount to floor', 0.0, -10.0, 0.0), ('Discount to ceiling', 0.0, 95.0, 0.0)
)"""


def tested(by: str = "") -> str:
    key = f"{by}, " if by else ""
    group = f"GROUP BY {by}" if by else ""
    return f"""tested AS (
  SELECT *, gross_revenue * (1 + price_pct / 100) * (1 - rate) AS projected_revenue,
         cost * (1 + cost_pct / 100) AS projected_cost
  FROM (SELECT *, least(0.95, greatest(0, discount_amount / gross_revenue + discount_pp / 100)) AS rate
        FROM (SELECT {key}{sums()} FROM facts {group}), scenarios)
)"""


SCENARIO_GRID = query(
    """SELECT region, scenario, price_pct, discount_pp, cost_pct, revenue AS baseline_revenue, profit AS baseline_profit,
  round(profit / revenue, 6) AS baseline_margin, round(projected_revenue, 2) AS projected_revenue,
  round(projected_revenue - projected_cost, 2) AS projected_profit,
  round((projected_revenue - projected_cost) / projected_revenue, 6) AS projected_margin FROM tested""",
    SCENARIOS,
    tested("region"),
)
BREAK_EVEN = query(
    """SELECT scenario, CASE WHEN needed = 0 THEN 0 ELSE needed END AS break_even_price_pct,
  CASE WHEN spare = 0 THEN 0 ELSE spare END AS price_above_break_even_pp
FROM (SELECT scenario, round(needed, 6) AS needed, round(price_pct - needed, 6) AS spare FROM (
  SELECT *, ((profit + projected_cost) / (gross_revenue * (1 - rate)) - 1) * 100 AS needed FROM tested))""",
    SCENARIOS,
    tested(),
)


def series(by: str) -> str:
    return f"""series AS (
  SELECT *, row_number() OVER (PARTITION BY s ORDER BY month) - 1 AS x, count(*) OVER (PARTITION BY s) AS n,
         month(CAST(month || '-01' AS DATE)) AS moy
  FROM (SELECT {by} AS s, month, CAST(sum(net_revenue) AS DOUBLE) AS y FROM facts GROUP BY ALL)
)"""


def forecast(by: str = "") -> str:
    name = f"s AS {by}, " if by else ""
    return query(
        f"""SELECT {name}CAST(h AS BIGINT) AS step, month, round(revenue, 2) AS revenue,
  round(greatest(0, revenue - band), 2) AS lower, round(revenue + band, 2) AS upper,
  CASE WHEN n >= 18 THEN 'Trend + shrunk month-of-year seasonality'
       ELSE 'Linear trend (insufficient history for seasonality)' END AS method
FROM (SELECT a.s, a.n, a.h, a.month, greatest(0, (b + m * (a.n + h - 1)) *
               CASE WHEN a.n >= 18 THEN coalesce(0.5 + 0.5 * f.factor, 1) ELSE 1 END) AS revenue,
             1.96 * sqrt(sq / greatest(a.n - 2, 1)) * sqrt(1 + h / CAST(a.n AS DOUBLE)) AS band
      FROM ahead a LEFT JOIN factors f ON f.s = a.s AND f.moy = month(CAST(a.month || '-01' AS DATE)))""",
        series(f"{by}" if by else "'all'"),
        "fits AS (SELECT s, any_value(n) AS n, max(month) AS last, regr_slope(y, x) AS m, regr_intercept(y, x) AS b "
        "FROM series WHERE n >= 6 GROUP BY s)",
        "fitted AS (SELECT series.*, b + m * x AS fit FROM series JOIN fits USING (s))",
        "factors AS (SELECT s, moy, avg(y / greatest(fit, 1)) AS factor FROM fitted GROUP BY s, moy)",
        """ahead AS (
  SELECT fits.*, sq, h, strftime(CAST(last || '-01' AS DATE) + to_months(CAST(h AS INTEGER)), '%Y-%m') AS month
  FROM fits JOIN (SELECT s, sum((y - fit) ** 2) AS sq FROM fitted GROUP BY s) USING (s), range(1, 4) AS r(h)
)""",
    )


BACKTEST = query(
    """SELECT s AS category, round(avg(miss), 6) AS validation_mape, count(miss) AS folds
FROM (SELECT s, CASE WHEN predicted <> 0 AND actual <> 0 THEN abs(actual - predicted) / abs(actual) END AS miss
      FROM (SELECT f.s, t.y AS actual, greatest(0, (f.b + f.m * f.c) * CASE WHEN f.c >= 18 THEN coalesce(
              (SELECT 0.5 + 0.5 * avg(y / greatest(f.b + f.m * x, 1)) FROM series q
               WHERE q.s = f.s AND q.x < f.c AND q.moy = month(CAST(f.last || '-01' AS DATE) + INTERVAL 1 MONTH)), 1)
            ELSE 1 END) AS predicted
            FROM folds f JOIN series t ON t.s = f.s AND t.x = f.c))
GROUP BY s""",
    series("category"),
    """folds AS (
  SELECT p.s, c, regr_slope(y, x) AS m, regr_intercept(y, x) AS b, max(month) AS last
  FROM series p JOIN (SELECT DISTINCT s, x AS c, n FROM series WHERE x >= greatest(5, n - 6) AND n >= 6) cuts
    ON cuts.s = p.s AND p.x < c
  GROUP BY p.s, c
)""",
)

EXTREMES = """extremes AS (
  SELECT *, row_number() OVER (PARTITION BY dimension ORDER BY margin, revenue DESC, value DESC) AS weakest,
         row_number() OVER (PARTITION BY dimension ORDER BY margin DESC, revenue DESC, value DESC) AS strongest,
         row_number() OVER (PARTITION BY dimension ORDER BY discount_rate DESC, revenue DESC, value DESC) AS dearest,
         row_number() OVER (PARTITION BY dimension ORDER BY discount_rate, revenue DESC, value DESC) AS thriftiest,
         row_number() OVER (PARTITION BY dimension ORDER BY revenue DESC, value DESC) AS largest,
         count(*) OVER (PARTITION BY dimension) AS n
  FROM summary
)"""


def money(x: str) -> str:
    return f"format('${{:,.0f}}', {x})"


def number(x: str) -> str:
    return f"format('{{:,.0f}}', floor({x} + 0.5))"


def pct(x: str) -> str:
    return f"printf('%.1f%%', {x} * 100)"


def points(x: str) -> str:
    return f"printf('%.1f', {x} * 100)"


def finding(
    source: str, rule: int, id_: str, severity: str, dimension: str, value: str, observation: str, evidence: str,
    implication: str, advice: str, revenue: str, profit: str, margin: str, rate: str, benchmark: str,
) -> str:
    return f"""SELECT CAST({rule} AS BIGINT) AS rule, {id_} AS id, {severity} AS severity, {dimension} AS scope_dimension,
  {value} AS scope_value, {observation} AS observation, {evidence} AS evidence, '{implication}' AS implication,
  {advice} AS recommendation, round({revenue}, 4) AS revenue, round({profit}, 4) AS profit, round({margin}, 6) AS margin,
  round({rate}, 6) AS discount_rate, round({benchmark}, 6) AS benchmark {source}"""


def advice(rule: str) -> str:
    return f"'{RULE_TEXTS[rule][1]}'"


NONE = "CAST(NULL AS VARCHAR)"
NO_NUMBER = "CAST(NULL AS DOUBLE)"
OWN = ("revenue", "profit", "margin", "discount_rate")


def of(alias: str) -> tuple[str, ...]:
    return tuple(f"{alias}.{c}" for c in OWN)


RECOMMENDATIONS = "found AS (\n" + "\nUNION ALL ".join(
    [
        finding(
            "FROM (SELECT s.*, med FROM summary s, (SELECT median(margin) AS med, quantile_cont(revenue, 0.75) AS q "
            "FROM summary WHERE dimension = 'product') WHERE dimension = 'product' AND revenue >= q AND margin < med "
            "ORDER BY revenue DESC, value LIMIT 1)",
            1, "'global-product-margin-pressure'", "'high'", NONE, NONE,
            f"value || ' is a top-quartile revenue product but earns only ' || {pct('margin')} || ' gross margin.'",
            f"'It generated ' || {money('revenue')} || ' revenue and ' || {money('profit')} || "
            f"' gross profit, versus a product median margin of ' || {pct('med')} || '.'",
            RULE_TEXTS["global-product-margin-pressure"][0],
            advice("global-product-margin-pressure"),
            *OWN, "med",
        ),
        finding(
            "FROM extremes h JOIN extremes l ON h.dimension = 'channel' AND l.dimension = 'channel' AND h.dearest = 1 "
            "AND l.thriftiest = 1 WHERE h.discount_rate - l.discount_rate > 0.025",
            2, "'global-channel-discount-spread'", "'medium'", "'channel'", "h.value",
            f"h.value || ' carries the highest realized discount rate at ' || {pct('h.discount_rate')} || '.'",
            f"'Its discount rate is ' || {points('(h.discount_rate - l.discount_rate)')} || ' percentage points above ' || "
            f"l.value || ', while margin is ' || {pct('h.margin')} || '.'",
            RULE_TEXTS["global-channel-discount-spread"][0],
            advice("global-channel-discount-spread"),
            *of("h"), "l.discount_rate",
        ),
        finding(
            "FROM extremes w JOIN extremes b ON w.dimension = 'region' AND b.dimension = 'region' AND w.weakest = 1 "
            "AND b.strongest = 1",
            3, "'global-regional-economics-gap'", "'medium'", "'region'", "w.value",
            f"w.value || ' has the lowest regional margin at ' || {pct('w.margin')} || '.'",
            f"'That is ' || {points('(b.margin - w.margin)')} || ' percentage points below ' || b.value || ', on ' || "
            f"{money('w.revenue')} || ' revenue.'",
            RULE_TEXTS["global-regional-economics-gap"][0],
            advice("global-regional-economics-gap"),
            *of("w"), "b.margin",
        ),
        finding(
            "FROM extremes WHERE dimension = 'category' AND largest = 1 AND profit_share + 0.03 < revenue_share",
            4, "'global-category-profit-underweight'", "'high'", "'category'", "value",
            f"value || ' contributes ' || {pct('revenue_share')} || ' of revenue but only ' || {pct('profit_share')} || "
            "' of gross profit.'",
            f"'Its realized gross margin is ' || {pct('margin')} || ' with a ' || {pct('discount_rate')} || ' discount rate.'",
            RULE_TEXTS["global-category-profit-underweight"][0],
            advice("global-category-profit-underweight"),
            *OWN, "profit_share",
        ),
        finding(
            "FROM extremes WHERE dimension = 'customer_segment' AND dearest = 1",
            5, "'global-segment-discount-governance'", "'medium'", "'customer_segment'", "value",
            f"value || ' receives the highest segment discount rate at ' || {pct('discount_rate')} || '.'",
            f"'The segment produced ' || {money('revenue')} || ' revenue at ' || {pct('margin')} || ' margin.'",
            RULE_TEXTS["global-segment-discount-governance"][0],
            advice("global-segment-discount-governance"),
            *OWN, NO_NUMBER,
        ),
        finding(
            "FROM (SELECT revenue, profit, round(profit / revenue, 4) AS m, round(discount_amount / gross_revenue, 4) AS r, "
            f"lost FROM (SELECT {sums()}, CAST(round(sum(discount_amount), 2) AS DOUBLE) AS lost FROM facts))",
            6, "'global-discount-pool'", "'info'", NONE, NONE,
            f"'The business gave up ' || {money('lost')} || ' of gross revenue through discounts.'",
            f"'Weighted realized discount is ' || {pct('r')} || '; gross margin after discount is ' || {pct('m')} || '.'",
            RULE_TEXTS["global-discount-pool"][0],
            advice("global-discount-pool"),
            "revenue", "profit", "m", "r", "lost",
        ),
        finding(
            "FROM summary JOIN (SELECT dimension, median(margin) AS med, median(discount_rate) AS dis FROM summary "
            "GROUP BY dimension) USING (dimension) WHERE margin < med - 0.015 OR discount_rate > dis + 0.02",
            7, "'scope-' || dimension || '-' || replace(lower(value), ' ', '-')", "'medium'", "dimension", "value",
            "value || ' is economically weaker than its peer median on margin or discount discipline.'",
            f"'Revenue ' || {money('revenue')} || ', margin ' || {pct('margin')} || ', discount ' || {pct('discount_rate')} || '.'",
            RULE_TEXTS["scope"][0],
            advice("scope"),
            *OWN, "med",
        ),
    ]
) + "\n)"

RECOMMENDED = query("SELECT * FROM found", BY_DIMENSION, SUMMARY, EXTREMES, RECOMMENDATIONS)
IN_SCOPE = (
    "(scope_dimension = 'region' AND scope_value = 'EUROPE') OR (scope_dimension = 'category' AND scope_value = 'PROMO') "
    "OR (scope_dimension = 'product' AND scope_value = 'PROMO red widget')"
)
SCOPED = query(
    f"""SELECT * FROM found WHERE CASE WHEN (SELECT count(*) FROM found WHERE {IN_SCOPE}) > 0
  THEN coalesce({IN_SCOPE}, FALSE) ELSE scope_dimension IS NULL END
ORDER BY rule, revenue DESC NULLS LAST, id LIMIT 5""",
    BY_DIMENSION,
    SUMMARY,
    EXTREMES,
    RECOMMENDATIONS,
)

SHORT = "CASE dimension WHEN 'customer_segment' THEN 'segment' ELSE dimension END"
DYNAMIC = query(
    "SELECT * FROM ("
    + "\nUNION ALL ".join(
        [
            finding(
                "FROM (SELECT s.*, med FROM summary s, (SELECT median(margin) AS med FROM summary WHERE dimension = 'product'), "
                "(SELECT revenue AS lead FROM (SELECT revenue, row_number() OVER (ORDER BY revenue DESC) - 1 AS i, "
                "count(*) OVER () AS n FROM summary WHERE dimension = 'product') WHERE i = least(n // 4, n - 1)) "
                "WHERE dimension = 'product' AND revenue >= lead AND margin < med * 0.98 ORDER BY revenue DESC, value LIMIT 1)",
                1, "'product-tension'", "'high'", "'product'", "value",
                "value || ' is a revenue leader with weak realized margin.'",
                f"'Revenue is ' || {number('revenue')} || ' while gross margin is ' || {pct('margin')} || "
                f"', versus a product median of ' || {pct('med')} || '.'",
                RULE_TEXTS["product-tension"][0],
                advice("product-tension"),
                *OWN, "med",
            ),
            finding(
                f"FROM (SELECT *, {MARGIN} AS margin, {RATE} AS discount_rate FROM (SELECT {sums()} FROM facts)) "
                "WHERE discount_rate > 0.04",
                2, "'discount-spend'", "CASE WHEN discount_rate > 0.15 THEN 'high' ELSE 'medium' END", NONE, NONE,
                f"'Discounting consumes ' || {pct('discount_rate')} || ' of gross revenue.'",
                f"{number('discount_amount')} || ' of gross-to-net value is currently given away.'",
                RULE_TEXTS["discount-spend"][0],
                advice("discount-spend"),
                *OWN, "discount_amount",
            ),
            finding(
                f"FROM (SELECT w.*, {SHORT.replace('dimension', 'w.dimension', 1).replace('ELSE dimension', 'ELSE w.dimension')} AS label, "
                "b.value AS best, b.margin AS best_margin FROM extremes w JOIN extremes b ON w.dimension = b.dimension "
                "AND w.weakest = 1 AND b.strongest = 1 WHERE w.dimension <> 'product' AND w.n >= 2 "
                "AND b.margin - w.margin >= 0.001)",
                3, "label || '-margin-gap'", "'medium'", "dimension", "value",
                f"value || ' has the weakest ' || label || ' margin at ' || {pct('margin')} || '.'",
                f"'The gap to ' || best || ' is ' || {points('(best_margin - margin)')} || ' percentage points on ' || "
                f"{number('revenue')} || ' of revenue.'",
                RULE_TEXTS["margin-gap"][0],
                "'Decompose ' || value || ' by product and channel/customer mix before setting a blanket growth target.'",
                *OWN, "best_margin",
            ),
        ]
    )
    + """) ORDER BY rule, CASE scope_dimension WHEN 'region' THEN 0 WHEN 'channel' THEN 1 WHEN 'customer_segment' THEN 2
  WHEN 'category' THEN 3 WHEN 'product' THEN 4 ELSE -1 END LIMIT 8""",
    BY_DIMENSION,
    SUMMARY,
    EXTREMES,
)

DOUBLES = "gross_revenue discount_amount net_revenue cost gross_profit".split()
ENRICHED = query(
    "SELECT * EXCLUDE (gross) REPLACE ("
    + ", ".join(f"CAST({c} AS DOUBLE) AS {c}" for c in (*DOUBLES, "discount_rate", "unit_cost"))
    + f", strftime(order_date, '%Y-%m-%d') AS order_date, {rounded('gross_margin')} AS gross_margin, "
    f"{rounded('margin_before_discount')} AS margin_before_discount) FROM facts"
)
EXPORT = query(
    "SELECT transaction_id, order_id, strftime(order_date, '%Y-%m-%d') AS order_date, "
    + ", ".join(DIMENSIONS)
    + ", quantity, "
    + ", ".join(f"CAST(round({c}, 2) AS DOUBLE) AS {c}" for c in DOUBLES)
    + f", round(CAST(discount_rate AS DOUBLE), 4) AS discount_rate, {rounded('gross_margin', 4)} AS gross_margin, "
    "month FROM facts"
)
CHECKS = (
    "required_columns; unexpected_columns; null_values; duplicate_transaction_ids; id_format; date_parse; date_range; "
    "numeric_types; quantity_range; price_range; cost_range; discount_range; derived_revenue_rules"
)
LINEAGE = query(
    f"""SELECT '2.0.0' AS schema_version, count(*) AS row_count, CAST(12 AS BIGINT) AS column_count,
  CASE WHEN count(DISTINCT transaction_id) < count(*) OR min(order_date) < DATE '1996-01-01'
    OR max(order_date) > DATE '2001-01-01' THEN 'failed' ELSE 'passed' END AS validation_status,
  '{CHECKS}' AS validation_checks,
  strftime(min(order_date), '%Y-%m-%d') AS date_min, strftime(max(order_date), '%Y-%m-%d') AS date_max FROM facts"""
)
FINGERPRINT_LINE = " || ".join(
    f"CASE WHEN {c} IS NULL THEN '-' ELSE length(CAST({c} AS VARCHAR)) || ':' || CAST({c} AS VARCHAR) END"
    for c in (
        "transaction_id", "order_id", "order_date", "region", "channel", "customer_segment", "category", "product",
        "quantity", "gross", "discount_rate", "unit_cost",
    )
)
FINGERPRINT = query(
    f"""SELECT fingerprint, row_count,
  substr(sha256(fingerprint || '|' || CAST(row_count AS VARCHAR) || '|2.0.0|0'), 1, 16) AS build_id
FROM (SELECT CAST(sum(('0x' || substr(digest, 1, 16))::UBIGINT) AS VARCHAR) || '-'
        || CAST(sum(('0x' || substr(digest, 17, 16))::UBIGINT) AS VARCHAR) AS fingerprint, count(*) AS row_count
      FROM (SELECT sha256({FINGERPRINT_LINE}) AS digest FROM facts))"""
)
STORED_LINE = " || ".join(
    f"CASE WHEN {c} IS NULL THEN '-' ELSE length({c}) || ':' || {c} END"
    for c in (
        "transaction_id", "order_id", "CAST(order_date AS VARCHAR)", "region", "channel", "customer_segment", "category", "product",
        "CAST(quantity AS VARCHAR)", "CAST(gross_revenue AS VARCHAR)", "CAST(discount_amount AS VARCHAR)", "CAST(discount_rate AS VARCHAR)",
        "CAST(net_revenue AS VARCHAR)", "CAST(cost AS VARCHAR)", "CAST(gross_profit AS VARCHAR)", "month",
    )
)
STORED_BUILD = query(
    f"""SELECT CAST(sum(('0x' || substr(digest, 1, 16))::UBIGINT) AS VARCHAR) || '-'
        || CAST(sum(('0x' || substr(digest, 17, 16))::UBIGINT) AS VARCHAR) AS fingerprint, count(*) AS row_count,
  count(DISTINCT month) AS months, strftime(min(order_date), '%Y-%m-%d') AS first_day, strftime(max(order_date), '%Y-%m-%d') AS last_day
FROM (SELECT month, order_date, sha256({STORED_LINE}) AS digest FROM facts)"""
)
FILTER_OPTIONS = query("SELECT DISTINCT dimension, value FROM sliced WHERE value <> ''", BY_DIMENSION)

VALIDATION_ROWS = (
    [("required_columns", "Missing required columns", "FALSE", "''"), ("unexpected_columns", "Unexpected columns present", "FALSE", "''")]
    + [
        ("null_values", "Null values found in required columns", f"{c} IS NULL", f"'{c}'")
        for c in (
            "transaction_id", "order_id", "order_date", "region", "channel", "customer_segment", "category", "product",
            "quantity", "list_price", "discount_rate", "unit_cost",
        )
    ]
    + [
        ("duplicate_transaction_ids", "Duplicate transaction IDs found", None, None),
        ("id_format", "Malformed transaction_id", r"NOT regexp_full_match(transaction_id, 'TXN-\d+')", "transaction_id"),
        ("id_format", "Malformed order_id", r"NOT regexp_full_match(order_id, 'ORD-\d+')", "order_id"),
        ("date_parse", "Invalid order_date values found; expected ISO-compatible dates.", "FALSE", "''"),
        ("date_range", "Impossible future order_date values found.", "order_date > DATE '2001-01-01'", "CAST(order_date AS VARCHAR)"),
        ("date_range", "Impossible historical order_date values found before 1996-01-01.", "order_date < DATE '1996-01-01'", "CAST(order_date AS VARCHAR)"),
    ]
    + [
        ("numeric_types", f"Column ''{c}'' contains invalid numeric values", "FALSE", "''")
        for c in ("quantity", "list_price", "discount_rate", "unit_cost")
    ]
    + [
        ("quantity_range", "Quantity must be greater than zero; zero/negative quantities are invalid.", "quantity <= 0", "''"),
        ("quantity_range", "Quantity must contain whole units only.", "quantity % 1 <> 0", "''"),
        ("price_range", "List price must be greater than zero.", "list_price <= 0", "''"),
        ("cost_range", "Unit cost cannot be negative.", "unit_cost < 0", "''"),
        ("discount_range", "Discount rate must be between 0 and 1 inclusive.", "discount_rate < 0 OR discount_rate > 1", "''"),
        ("derived_revenue_rules", "Impossible gross revenue detected.", "quantity * list_price <= 0", "''"),
        ("derived_revenue_rules", "Impossible negative net revenue detected.", "quantity * list_price * (1 - discount_rate) < 0", "''"),
        ("derived_revenue_rules", "Impossible negative total cost detected.", "quantity * unit_cost < 0", "''"),
    ]
)


def validation_row(position: int, check: str, message: str, violated: str | None, example: str | None) -> str:
    head = f"SELECT '{check}' AS \"check\", CAST({position} AS BIGINT) AS position, "
    if violated is None:
        return (
            head + f"CAST(coalesce(sum(n - 1), 0) AS BIGINT) AS violations, '{message}' AS message, (SELECT "
            "coalesce(string_agg(transaction_id, '; ' ORDER BY transaction_id), '') FROM "
            "(SELECT transaction_id FROM repeated ORDER BY transaction_id LIMIT 5)) AS examples FROM repeated"
        )
    return (
        head + f"count(*) FILTER ({violated}) AS violations, '{message}' AS message, (SELECT "
        f"coalesce(string_agg(e, '; ' ORDER BY e), '') FROM (SELECT {example} AS e FROM raw WHERE {violated} "
        "ORDER BY e LIMIT 3)) AS examples FROM raw"
    )


VALIDATION = query(
    "\nUNION ALL ".join(validation_row(i, *row) for i, row in enumerate(VALIDATION_ROWS)),
    "raw AS (SELECT *, CAST(gross AS DOUBLE) / quantity AS list_price FROM lines)",
    "repeated AS (SELECT transaction_id, count(*) AS n FROM raw GROUP BY transaction_id HAVING count(*) > 1)",
)
# The same rules over text, some of it spoiled: kept apart from the code under test on purpose.
SPOILS = {
    "transaction_id": {0: "'BAD-1'"},
    "order_id": {1: "'oops'"},
    "order_date": {2: "'2024-02-30'", 3: "'not-a-date'", 4: "'2099-01-01'", 5: "'1990-05-05'"},
    "region": {16: "NULL"},
    "product": {17: "NULL"},
    "quantity": {6: "'abc'", 7: "'0'", 8: "'-3'", 9: "'1.5'"},
    "list_price": {10: "'NaN'", 11: "'-5'", 12: "'100d'"},
    "discount_rate": {14: "'1.1'", 15: "'-0.1'", 19: "'x'"},
    "unit_cost": {13: "'-2'", 18: "'2f'"},
}
NUMBERS = ("quantity", "list_price", "discount_rate", "unit_cost")


def spoiled_text(column: str) -> str:
    cases = " ".join(f"WHEN {rest} THEN {value}" for rest, value in SPOILS.get(column, {}).items())
    plain = f"CAST({column} AS VARCHAR)"
    return (f"CASE CAST(substr(transaction_id, 5) AS BIGINT) % 199 {cases} ELSE {plain} END" if cases else plain) + f" AS {column}_text"


def spoiled_rule(position: int, check: str, message: str, violated: str | None) -> str:
    count = "(SELECT coalesce(sum(n - 1), 0) FROM repeated)" if violated is None else f"count(*) FILTER ({violated})"
    return (
        f"SELECT '{check}' AS \"check\", CAST({position} AS BIGINT) AS position, CAST({count} AS BIGINT) AS violations, "
        f"'{message}' AS message" + (" FROM read" if violated else "")
    )


SPOILED_RULES = [
    (
        check,
        message,
        {
            "null_values": f"{(example or '').strip(chr(39))}_text IS NULL",
            "date_parse": "order_date_text IS NOT NULL AND order_date IS NULL",
            "numeric_types": f"{message.split(chr(39))[2] if check == 'numeric_types' else ''}_text IS NOT NULL "
            f"AND {message.split(chr(39))[2] if check == 'numeric_types' else ''} IS NULL",
        }.get(check, violated),
    )
    for check, message, violated, example in VALIDATION_ROWS
]
VALIDATION_SPOILED = query(
    "\nUNION ALL ".join(spoiled_rule(i, *row) for i, row in enumerate(SPOILED_RULES)),
    "priced AS (SELECT *, CAST(gross AS DOUBLE) / quantity AS list_price FROM lines)",
    "spoiled AS (SELECT "
    + ", ".join(
        spoiled_text(c)
        for c in ("transaction_id", "order_id", "order_date", "region", "channel", "customer_segment", "category", "product", *NUMBERS)
    )
    + " FROM priced)",
    r"read AS (SELECT *, transaction_id_text AS transaction_id, order_id_text AS order_id, "
    r"CASE WHEN regexp_matches(order_date_text, '^\d{4}-\d{2}-\d{2}') THEN TRY_CAST(substr(order_date_text, 1, 10) AS DATE) END AS order_date, "
    + ", ".join(
        rf"CASE WHEN regexp_full_match({c}_text, '[+-]?(\d+\.?\d*|\.\d+)([eE][+-]?\d+)?') THEN TRY_CAST({c}_text AS DOUBLE) END AS {c}"
        for c in NUMBERS
    )
    + " FROM spoiled)",
    "repeated AS (SELECT transaction_id, count(*) AS n FROM read GROUP BY transaction_id HAVING count(*) > 1)",
)
DUPLICATE_IDS = query(
    "SELECT transaction_id, count(*) AS occurrences FROM facts GROUP BY transaction_id HAVING count(*) > 1"
)

NET_AMOUNT = "CAST(round(CAST(l_extendedprice AS DECIMAL(15,2)) * (1 - CAST(l_discount AS DECIMAL(4,2))), 2) AS DECIMAL(15,2))"
AMOUNT_TEXT = f"'$' || format('{{:,.2f}}', CAST({NET_AMOUNT} AS DOUBLE))"
UNTIDY_AMOUNT = f"CASE WHEN l_tax = 0.08 THEN '(' || {AMOUNT_TEXT} || ')' ELSE {AMOUNT_TEXT} END"


def read_number(text: str) -> str:
    cleaned = rf"regexp_replace({text}, '[$€£₹,%()\s]', '', 'g')"
    plain = rf"CASE WHEN regexp_full_match({cleaned}, '[+-]?(\d+\.?\d*|\.\d+)([eE][+-]?\d+)?') THEN TRY_CAST({cleaned} AS DOUBLE) END"
    return f"CASE WHEN contains({text}, '(') AND contains({text}, ')') THEN -({plain}) ELSE {plain} END"


PARSE_NUMBER = f"""SELECT l_orderkey, CAST(l_linenumber AS BIGINT) AS l_linenumber, written, {read_number("written")} AS number
FROM (SELECT l_orderkey, l_linenumber, CASE WHEN l_linestatus = 'F' THEN {UNTIDY_AMOUNT}
        WHEN l_returnflag = 'A' THEN CAST(CAST(round(l_discount * 100) AS INTEGER) AS VARCHAR) || ' %'
        WHEN l_returnflag = 'R' THEN '€ ' || CAST({NET_AMOUNT} AS VARCHAR)
        WHEN l_linenumber = 1 THEN CAST({NET_AMOUNT} AS VARCHAR) || 'd'
        WHEN l_linenumber = 2 THEN '2e3' WHEN l_linenumber = 3 THEN 'NaN'
        WHEN l_linenumber = 4 THEN '-' || CAST({NET_AMOUNT} AS VARCHAR) ELSE '' END AS written
      FROM lineitem)"""


def untidy_date(style: str) -> str:
    return (
        f"CASE WHEN day(o_orderdate) = 31 THEN 'not a date' WHEN {style} = 'R' THEN strftime(o_orderdate, '%-d/%-m/%Y') "
        f"WHEN {style} = 'A' THEN strftime(o_orderdate, '%-m/%-d/%Y') ELSE strftime(o_orderdate, '%Y-%m-%d') END"
    )


def read_date(text: str) -> str:
    shapes = ("%Y-%m-%d", "%m/%d/%Y", "%d/%m/%Y", "%b %-d, %Y", "%Y-%m-%dT%H:%M:%SZ", "%m-%d-%y", "%d-%m-%y")
    return "strftime(coalesce(" + ", ".join(f"try_strptime({text}, '{s}')" for s in shapes) + "), '%Y-%m-%d')"


STYLE = "CASE o_orderstatus WHEN 'O' THEN 'R' WHEN 'F' THEN 'A' ELSE 'I' END"
# Two-digit years are read as 20yy day first, and by the turn of 1950 month first.
PARSE_DATE = f"""SELECT o_orderkey, written, CASE WHEN o_orderpriority = '5-LOW' THEN strftime(CASE
    WHEN day(o_orderdate) <= 12 THEN make_date(year(o_orderdate), day(o_orderdate), month(o_orderdate))
    ELSE make_date(2000 + year(o_orderdate) % 100, month(o_orderdate), day(o_orderdate)) END, '%Y-%m-%d')
  ELSE {read_date("written")} END AS date
FROM (SELECT *, CASE o_orderpriority WHEN '5-LOW' THEN strftime(o_orderdate, '%d-%m-%y')
        WHEN '4-NOT SPECIFIED' THEN strftime(o_orderdate, '%b %-d, %Y')
        WHEN '1-URGENT' THEN strftime(o_orderdate, '%Y-%m-%dT%H:%M:%SZ')
        ELSE {untidy_date(STYLE)} END AS written FROM orders)"""

COST_TEXT = "CAST(CAST(CAST(l_quantity AS BIGINT) * CAST(p_retailprice AS DECIMAL(15,2)) AS DECIMAL(15,2)) AS VARCHAR)"
UPLOAD_COLUMNS = ("idate", "ino", "sku", "dept", "store", "qty", "sales", "cogs", "disc")
UPLOAD = f"""WITH doubled AS (
  SELECT 0 AS copy, * FROM lineitem UNION ALL SELECT 1, * FROM lineitem WHERE l_returnflag = 'A'
),
written AS (
  SELECT row_number() OVER (ORDER BY copy, l_orderkey, l_linenumber, l_partkey, l_suppkey, l_extendedprice, l_quantity,
           l_shipdate) - 1 AS idx,
         {untidy_date("l_returnflag")} AS idate, 'INV-' || CAST(l_orderkey AS VARCHAR) AS ino,
         p_type || ' ' || p_name AS sku, p_type AS dept, o_orderpriority AS store,
         CASE l_quantity WHEN 50 THEN '0' WHEN 49 THEN '' ELSE CAST(CAST(l_quantity AS BIGINT) AS VARCHAR) END AS qty,
         {UNTIDY_AMOUNT} AS sales,
         CASE WHEN l_tax = 0 THEN '' WHEN l_quantity = 1 THEN '(' || {COST_TEXT} || ')' ELSE {COST_TEXT} END AS cogs,
         CASE WHEN l_linenumber = 7 THEN 'n/a'
              ELSE CAST(CAST(round(l_discount * 100) AS INTEGER) AS VARCHAR) || '%' END AS disc
  FROM doubled LEFT JOIN orders ON o_orderkey = l_orderkey LEFT JOIN part ON p_partkey = l_partkey
),
upload AS (
  SELECT idx, {", ".join(f"coalesce({c}, '') AS {c}" for c in UPLOAD_COLUMNS)} FROM written
),
numbered AS (
  SELECT *, row_number() OVER (PARTITION BY {", ".join(UPLOAD_COLUMNS)} ORDER BY idx) AS occurrence FROM upload
),
parsed AS (
  SELECT *, {read_date("idate")} AS d, {read_number("qty")} AS q, {read_number("sales")} AS rev,
         {read_number("cogs")} AS c, coalesce({read_number("disc")}, 0) AS given
  FROM numbered WHERE occurrence = 1
),
checked AS (
  SELECT *, CASE WHEN given > 1 AND given <= 100 THEN given / 100 ELSE given END AS rate,
         d IS NULL AS bad_date, rev IS NULL OR rev < 0 AS bad_revenue, q IS NULL OR q <= 0 AS bad_quantity,
         c IS NULL AS bad_cost
  FROM parsed
),
judged AS (
  SELECT *, bad_date OR bad_revenue OR bad_quantity OR bad_cost AS broken,
         coalesce(c < 0, FALSE) AS negative_cost, rate < 0 OR rate >= 1 AS bad_rate
  FROM checked
),
duplicates AS (
  SELECT idx + 2 AS "row", 'row' AS field, '' AS value, 'Exact duplicate row' AS issue FROM numbered WHERE occurrence > 1
),
issues AS (
  SELECT idx + 2 AS "row", 'order_date' AS field, idate AS value, 'Unparseable or missing date' AS issue FROM judged WHERE bad_date
  UNION ALL SELECT idx + 2, 'net_revenue', sales, 'Revenue must be a non-negative number' FROM judged WHERE bad_revenue
  UNION ALL SELECT idx + 2, 'quantity', qty, 'Quantity must be positive' FROM judged WHERE bad_quantity
  UNION ALL SELECT idx + 2, 'cost/profit', '', 'Cost or gross profit is required' FROM judged WHERE bad_cost
  UNION ALL SELECT idx + 2, 'cost', CASE WHEN floor(c) = c THEN CAST(CAST(c AS BIGINT) AS VARCHAR) ELSE CAST(c AS VARCHAR) END,
              'Cost cannot be negative' FROM judged WHERE NOT broken AND negative_cost
  UNION ALL SELECT idx + 2, 'discount_rate', disc, 'Discount rate must be between 0% and <100%' FROM judged
            WHERE NOT broken AND NOT negative_cost AND bad_rate
  UNION ALL SELECT * FROM duplicates
),
grossed AS (
  SELECT *, rev + da AS gr, rev - c AS profit FROM (
    SELECT *, greatest(CASE WHEN rate = 0 THEN 0 ELSE rev * rate / greatest(1 - rate, 0.0001::DOUBLE) END, 0) AS da
    FROM judged WHERE NOT broken AND NOT negative_cost AND NOT bad_rate)
),
accepted AS (
  SELECT 'upload-' || lpad(CAST(idx + 1 AS VARCHAR), 7, '0') AS transaction_id, ino AS order_id, d AS order_date,
         'Unspecified' AS region, store AS channel, 'Unspecified' AS customer_segment, dept AS category, sku AS product,
         q AS quantity, gr AS gross_revenue, da AS discount_amount, coalesce(da / nullif(gr, 0), 0) AS discount_rate,
         rev AS net_revenue, c AS cost, profit AS gross_profit, coalesce(profit / nullif(rev, 0), 0) AS gross_margin,
         d[1:7] AS month
  FROM grossed
)
"""

# Thresholds so low that every rule finds something in the test data.
LOW = (
    ("h.discount_rate - l.discount_rate > 0.025", "h.discount_rate - l.discount_rate > 0.000001"),
    ("profit_share + 0.03 < revenue_share", "profit_share - 0.5 < revenue_share"),
    ("margin < med - 0.015 OR discount_rate > dis + 0.02", "margin < med - 0.00001 OR discount_rate > dis + 0.00001"),
)
# A month without lines: rows and calendar differ from there on.
MONTHLY_CALENDAR = query(
    f"""SELECT * {rounding({
        "margin": 6, "discount_rate": 6, "mom_revenue_growth": 6, "mom_profit_growth": 6, "margin_change_pp": 4,
        "revenue_rolling_3m": 2, "profit_rolling_3m": 2, "yoy_revenue_growth": 6, "yoy_profit_growth": 6,
        "growth_acceleration": 6})}
FROM (SELECT *, mom_revenue_growth - lag(mom_revenue_growth) OVER (ORDER BY month) AS growth_acceleration FROM grown)""",
    f"months AS ({grouped('month', where="month <> '1996-05'")})",
    """grown AS (
  SELECT n.*, n.revenue / nullif(lag(n.revenue) OVER w, 0) - 1 AS mom_revenue_growth,
         n.profit / nullif(lag(n.profit) OVER w, 0) - 1 AS mom_profit_growth,
         (n.margin - lag(n.margin) OVER w) * 100 AS margin_change_pp,
         avg(n.revenue) OVER (ORDER BY n.month ROWS 2 PRECEDING) AS revenue_rolling_3m,
         avg(n.profit) OVER (ORDER BY n.month ROWS 2 PRECEDING) AS profit_rolling_3m,
         n.revenue / nullif(b.revenue, 0) - 1 AS yoy_revenue_growth,
         n.profit / nullif(b.profit, 0) - 1 AS yoy_profit_growth
  FROM months n LEFT JOIN months b
    ON b.month = strftime(CAST(n.month || '-01' AS DATE) - INTERVAL 12 MONTH, '%Y-%m') WINDOW w AS (ORDER BY n.month)
)""",
)
DEFAULT_VIEW = query(
    f"SELECT * {VIEW_ROUNDING}, (SELECT CAST(min(order_date) AS VARCHAR) FROM facts) AS start_date, "
    "(SELECT CAST(max(order_date) AS VARCHAR) FROM facts) AS end_date FROM (" + VIEW_KPIS.format(where="TRUE") + ")"
)
# Sketches draw lots, so their estimates are not to be had here; the lines are, and that every estimate keeps its error.
APPROXIMATE_MARGINS = query(
    "SELECT region, CAST(share AS DOUBLE) AS share, count(gross_margin) AS lines, TRUE AS within_error "
    "FROM facts, (VALUES (0.05), (0.25), (0.5), (0.85), (0.99)) AS s(share) GROUP BY region, share"
)
VALIDATION_COLUMNS = """SELECT * FROM (VALUES
  ('required_columns', CAST(0 AS BIGINT), CAST(2 AS BIGINT), 'Missing required columns', 'channel; unit_cost'),
  ('unexpected_columns', CAST(1 AS BIGINT), CAST(1 AS BIGINT), 'Unexpected columns present', 'note')
) AS t("check", position, violations, message, examples)"""

INGEST_FACTS = UPLOAD + f"SELECT * {rounding((*DOUBLES, 'discount_rate', 'gross_margin'))} FROM accepted"
INGEST_FILE_PRODUCTS = UPLOAD + """SELECT category || ' "' || substr(product, length(category) + 2) || '",' || chr(10) || '(' || category || ')' AS product,
  category, count(*) AS "rows", CAST(sum(CAST(net_revenue AS DECIMAL(18,2))) AS DOUBLE) AS revenue
FROM accepted GROUP BY ALL"""
INGEST_REJECTED_FILE = UPLOAD + """SELECT field, issue, count(*) AS issues, count(DISTINCT "row") AS "rows", min("row") AS first_row, max("row") AS last_row
FROM issues GROUP BY ALL"""
TYPED_FILE = query("""SELECT category, channel, count(*) AS "rows", CAST(sum(quantity) AS BIGINT) AS units, CAST(sum(cost) AS DOUBLE) AS cost,
  CAST(sum(discount_rate) AS DOUBLE) AS rates, strftime(min(order_date), '%Y-%m-%d') AS first_day, strftime(max(order_date), '%Y-%m-%d') AS last_day
FROM facts GROUP BY ALL""")
FACT_GAPS = query("""SELECT count(*) AS lines, count(*) FILTER (WHERE order_date IS NULL) AS undated_lines,
  count(*) FILTER (WHERE cost IS NULL) AS uncosted_lines, CAST(coalesce(sum(net_revenue) FILTER (WHERE cost IS NULL), 0) AS DOUBLE) AS uncosted_revenue
FROM facts""")
# The texts of the report's methodology.
METHODS = """
  ('anomaly_detection', 'Monthly revenue, profit, and margin use MAD robust z-scores; |z| >= 3.0 is flagged.'),
  ('growth', 'MoM uses percentage change from the immediately preceding month; YoY uses the same month 12 months earlier; acceleration is the first difference of MoM growth.'),
  ('margin', 'Gross margin = (net revenue - cost) / net revenue. Margin before discount uses gross revenue as the denominator.'),
  ('discount', 'Discount amount = gross revenue - net revenue. Weighted discount rate = total discount amount / total gross revenue.'),
  ('seasonality', 'Month-of-year patterns are descriptive across the observed ' || years || ' history and are not causal claims.')"""
METHODOLOGY = query(f"""SELECT topic, text FROM
  (SELECT CASE WHEN min(year) = max(year) THEN min(year)::VARCHAR ELSE min(year)::VARCHAR || '–' || max(year)::VARCHAR END AS years FROM facts) y,
  LATERAL (VALUES {METHODS}) AS m(topic, text)""")
INGEST_QUALITY = UPLOAD + """SELECT total_rows, valid_rows, total_rows - valid_rows AS rejected_rows, duplicate_rows, issue_count,
  CAST(greatest(0, floor(100 - (total_rows - valid_rows) / total_rows::DOUBLE * 100 - 3 + 0.5)) AS BIGINT) AS score,
  'Region was not mapped; that drilldown will use “Unspecified”.; Customer segment was not mapped; that drilldown will use “Unspecified”.'
    AS warnings,
  'schema_mapping; date_parse; numeric_sales; positive_quantity; cost_or_profit; discount_bounds; exact_duplicates' AS checks
FROM (SELECT (SELECT count(*) FROM upload) AS total_rows, (SELECT count(*) FROM accepted) AS valid_rows,
             (SELECT count(*) FROM duplicates) AS duplicate_rows, (SELECT count(*) FROM issues) AS issue_count)"""
INGEST_SUMMARY = UPLOAD + f"""SELECT round(gross_revenue, 2) AS gross_revenue, round(revenue, 2) AS revenue, round(profit, 2) AS profit,
  round(cost, 2) AS cost, round(discount_amount, 2) AS discount_amount, units, orders,
  round(profit / revenue, 6) AS margin, round(discount_amount / gross_revenue, 6) AS discount_rate,
  round(revenue / orders, 6) AS average_order_value, round(revenue / units, 6) AS average_selling_price
FROM (SELECT {", ".join(f"CAST(sum(CAST({c} AS DECIMAL(18,4))) AS DOUBLE) AS {n}" for n, c in SUMS.items())},
             sum(quantity) AS units, count(DISTINCT order_id) AS orders FROM accepted)"""

ORACLES: dict[str, str] = {
    "kpis": KPIS,
    "monthly_performance": MONTHLY_PERFORMANCE,
    "dimension_summary": DIMENSION_SUMMARY,
    "combo_category_channel": combination("category", "channel", 60),
    "combo_region_category": combination("region", "category", 60),
    "combo_channel_segment": combination("channel", "customer_segment", 60),
    "combo_product_channel": combination("product", "channel", 40),
    "seasonality_month": economics("month_of_year"),
    "seasonality_category": economics("category, month_of_year"),
    "seasonality_channel": economics("channel, month_of_year"),
    "monthly_series": MONTHLY_SERIES,
    "product_series": PRODUCT_SERIES,
    "product_table": PRODUCT_TABLE,
    "profitability_map": PROFITABILITY_MAP,
    "pareto_product": pareto("product"),
    "pareto_category": pareto("category"),
    "pareto_summary": query(pareto_summary("product") + " UNION ALL " + pareto_summary("category")),
    "discount_distribution": DISCOUNT_DISTRIBUTION,
    "discount_summary": DISCOUNT_SUMMARY,
    "discount_leakage": DISCOUNT_LEAKAGE,
    "discount_margin_spearman": SPEARMAN,
    "anomalies": anomalies(2.5),
    "revenue_anomalies": REVENUE_ANOMALIES,
    "anomalies_in_window": anomalies(1.0, where="month BETWEEN '1997-01' AND '1998-12'"),
    "anomalies_by_region": anomalies(2.5, by="region"),
    "product_economics": PRODUCT_ECONOMICS,
    "filtered_kpis": FILTERED_KPIS,
    "period_over_period_kpis": PERIOD_OVER_PERIOD,
    "what_changed": brief("latest", PRESENT_BEFORE),
    "period_brief_mom": brief(
        "mom",
        f"coalesce((SELECT month FROM months WHERE month = {CALENDAR_BEFORE.format(n=1)}), {PRESENT_BEFORE})",
    ),
    "period_brief_yoy": brief("yoy", CALENDAR_BEFORE.format(n=12)),
    "period_drivers_latest": drivers(LAST_MONTH, MONTH_BEFORE_LAST),
    "period_drivers_mom": drivers(LAST_MONTH, MONTH_BEFORE_LAST),
    "period_drivers_yoy": drivers(LAST_COMPLETE, YEAR_BEFORE_COMPLETE),
    "recommendations_low_thresholds": varied(RECOMMENDED, *LOW),
    "scoped_recommendations_low_thresholds": varied(SCOPED, *LOW),
    "dynamic_recommendations_high": varied(DYNAMIC, ("discount_rate > 0.15", "discount_rate > 0.04")),
    "opportunity_radar_high": varied(OPPORTUNITY_RADAR, ("all_profit * 0.025, all_revenue * 0.004", "all_profit * 0.000001, all_revenue * 0.000001")),
    "monthly_performance_calendar": MONTHLY_CALENDAR,
    "default_view_kpis": DEFAULT_VIEW,
    "approximate_margin_quantiles": APPROXIMATE_MARGINS,
    "cube_monthly_performance": MONTHLY_PERFORMANCE,
    "cube_dimension_summary": DIMENSION_SUMMARY,
    "cube_product_economics": PRODUCT_ECONOMICS,
    "opportunity_radar": OPPORTUNITY_RADAR,
    "economic_bridge": bridge(),
    "economic_bridge_by_region": bridge("region"),
    "scenario_grid": SCENARIO_GRID,
    "break_even_price": BREAK_EVEN,
    "forecast": forecast(),
    "forecast_by_category": forecast("category"),
    "forecast_backtest": BACKTEST,
    "recommendations": RECOMMENDED,
    "scoped_recommendations": SCOPED,
    "dynamic_recommendations": DYNAMIC,
    "enriched_facts": ENRICHED,
    "fact_export": EXPORT,
    "lineage_metadata": LINEAGE,
    "dataset_fingerprint": FINGERPRINT,
    "stored_build": STORED_BUILD,
    "filter_options": FILTER_OPTIONS,
    "validation_report": VALIDATION,
    "validation_report_spoiled": VALIDATION_SPOILED,
    "validation_report_columns": VALIDATION_COLUMNS,
    "check_summary": f"""SELECT "check", CAST(sum(violations) AS BIGINT) AS violations,
  CASE WHEN sum(violations) = 0 THEN 'passed' ELSE 'failed' END AS status FROM ({VALIDATION}) GROUP BY "check" """,
    "duplicate_ids": DUPLICATE_IDS,
    "parse_number": PARSE_NUMBER,
    "parse_date": PARSE_DATE,
    "ingest_facts": INGEST_FACTS,
    "ingest_duplicates": UPLOAD + "SELECT * FROM duplicates",
    "ingest_issues": UPLOAD + "SELECT * FROM issues",
    "ingest_preview": UPLOAD + 'SELECT * FROM issues ORDER BY "row", field LIMIT 500',
    "ingest_quality": INGEST_QUALITY,
    "ingest_file_products": INGEST_FILE_PRODUCTS,
    "ingest_rejected_file": INGEST_REJECTED_FILE,
    "typed_file_costs": TYPED_FILE,
    "fact_gaps": FACT_GAPS,
    "report_methodology": METHODOLOGY,
    "ingest_summary": INGEST_SUMMARY,
}
