"""The same results as plain SQL over the raw tables, for an independent engine to check.

Written as windows, self-joins and subqueries where the Spark jobs use range
partitioning, conditional sums and telescoped gaps. Queries without an entry
depend on a fitted model.
"""

from __future__ import annotations


# Steps of the cleaning report, written out apart from the code under test.
AUDITED = [
    "Remove Missing Customer ID",
    "Remove Cancelled Transactions",
    "Remove Non-Positive Quantities",
    "Remove Non-Positive Prices",
    "Remove Duplicates",
    "Remove Test Accounts & Codes",
]
# Segments and their playbook, written out apart from the code under test.
PLAYBOOK = [
    (
        'Champions',
        'Best customers, buy recently and buy often with high spend.',
        'Upsell premium products, reward loyalty, seek advocacy.',
        'Invite to VIP program, early access to new collections, ask for reviews.',
        'Personalized Email / Dedicated Account Manager',
    ),
    (
        'Loyal Customers',
        'Buy regularly. Responsive to promotions.',
        'Maintain engagement, cross-sell related categories.',
        'Loyalty program points acceleration, recommend companion items.',
        'Email / Push Notifications',
    ),
    (
        'Potential Loyalists',
        'Recent shoppers with moderate frequency and spend.',
        'Increase purchase frequency.',
        'Offer multi-buy discounts, discount code for next purchase within 30 days.',
        'SMS / Push Notifications',
    ),
    (
        'New Customers',
        'Bought very recently but only once.',
        'Onboard and secure the second purchase.',
        'Welcome sequence with discount, usage/styling guides, customer support follow-up.',
        'Email / In-app greetings',
    ),
    (
        'At Risk',
        "Frequent/big spenders in the past, but haven't purchased in a while.",
        'Win them back before they churn.',
        "Send renewal/re-activation discount code, ask feedback, 'We miss you' campaign.",
        'Personalized Email / Re-targeting Ads',
    ),
    (
        "Can't Lose Them",
        'Used to make massive purchases often, but inactive for a long time.',
        'Emergency reactivation.',
        'High-value direct discount, phone outreach, exclusive renewal offers.',
        'Personalized Email / Direct Call',
    ),
    (
        'Need Attention',
        'Above-average recency and frequency, but not quite loyal.',
        'Nudge into loyal status.',
        'Limited-time offers, bundle deals based on browse history.',
        'Email / Web Popups',
    ),
    (
        'About to Sleep',
        'Below-average recency, frequency and spend. Will lose them if not reactivated.',
        'Low-cost re-engagement.',
        'Share popular products list, low value coupon.',
        'Email / Push',
    ),
    (
        'Hibernating',
        'Low frequency, low spend, and inactive for a long time.',
        'Cost-effective recovery attempt.',
        'Reconstruct value proposition, send massive seasonal clearance campaign.',
        'Email',
    ),
    (
        'Lost',
        'Lowest R, F, and M scores. Churned.',
        'Minimal spend. Abandon unless high acquisition cost justifies it.',
        'Standard automated newsletter, survey on why they left.',
        'Email',
    ),
]
# Tiers of acquisition spending, written out apart from the code under test.
TIERS = [
    (
        'VIP',
        150.0,
        'VIP Tier: Exclusive Loyalty Program Entry & Dedicated Account Outreach',
        'Offer invitation to key collections previews and reward bonus acceleration.',
        '350%',
        'High (92%)',
    ),
    (
        'Core',
        40.0,
        'Core Tier: Targeted Cross-Category Product Bundles Campaign',
        'Push recommendation emails containing matched item pairs.',
        '220%',
        'Medium-High (85%)',
    ),
    (
        'Volume',
        10.0,
        'Volume Tier: Low-cost automated reactivation sequences',
        'Send email sequence highlighting popular discount items.',
        '140%',
        'Medium (78%)',
    ),
]


SPLIT = "TIMESTAMP '2001-05-01'"
CANCELLED = "starts_with(Invoice, 'C')"
SERVICE = "('POST', 'D', 'DOT', 'M', 'BANK CHARGES', 'TEST', 'PADS', 'ADJUST', 'CRUK')"


def dbl(x: str) -> str:
    return f"CAST({x} AS DOUBLE)"


def rnd(x: str, digits: int) -> str:
    return f"CAST(ROUND(CAST({x} AS DECIMAL(38, 10)), {digits}) AS DOUBLE)"


def pct(part: str, whole: str, digits: int = 2) -> str:
    return rnd(f"CAST({part} AS DOUBLE) * 100 / NULLIF(CAST({whole} AS DOUBLE), 0)", digits)


def text(value: str) -> str:
    return "'" + value.replace("'", "''") + "'"


def values(rows: list[tuple]) -> str:
    return ", ".join("(" + ", ".join(text(v) if isinstance(v, str) else f"{v}::DOUBLE" for v in r) + ")" for r in rows)


def segment(r: str, f: str, lost_big: str, fallback: str) -> str:
    return f"""CASE WHEN {r} >= 4 AND {f} >= 4 THEN 'Champions'
        WHEN {r} >= 3 AND {f} >= 3 THEN 'Loyal Customers'
        WHEN {r} >= 3 AND {f} = 2 THEN 'Potential Loyalists'
        WHEN {r} >= 4 AND {f} = 1 THEN 'New Customers'
        WHEN {r} = 2 AND {f} >= 3 THEN 'At Risk'
        WHEN {r} = 1 AND {f} >= 4 THEN {text(lost_big)}
        WHEN {r} = 2 AND {f} = 2 THEN 'Need Attention'
        WHEN {r} = 3 AND {f} = 1 THEN 'About to Sleep'
        WHEN {r} = 1 AND {f} IN (2, 3) THEN 'Hibernating'
        WHEN {r} = 1 AND {f} = 1 THEN 'Lost'
        ELSE {text(fallback)} END"""


def qcut(rank: str, rows: str, n: int) -> str:
    return f"GREATEST(1, CAST(CEIL(({rank} - 1) * {n}.0::DOUBLE / ({rows} - 1)) AS BIGINT))"


# Common table expressions in the order they build on each other.
CTES = {
    "t": """SELECT CASE WHEN l_returnflag = 'R' AND l_linestatus = 'F' THEN 'C' ELSE '' END || CAST(l_orderkey AS VARCHAR) AS Invoice,
        CASE WHEN l_partkey % 101 = 0 THEN 'POST' ELSE CAST(l_partkey AS VARCHAR) END AS StockCode,
        p_name AS Description,
        CAST(CASE WHEN l_returnflag = 'R' AND l_linestatus = 'F' THEN -l_quantity ELSE l_quantity END AS INTEGER) AS Quantity,
        o_orderdate + to_seconds(o_orderkey * 7919 % 86400) AS InvoiceDate,
        CAST(CASE WHEN l_partkey % 97 = 0 THEN 0 ELSE p_retailprice END AS DECIMAL(12, 2)) AS Price,
        CASE WHEN o_orderkey % 20 <> 0 THEN CAST(o_custkey AS VARCHAR) END AS CustomerID,
        CASE WHEN n_nationkey = 0 THEN 'United Kingdom' ELSE n_name END AS Country
        FROM lineitem LEFT JOIN orders ON l_orderkey = o_orderkey LEFT JOIN part ON l_partkey = p_partkey
        LEFT JOIN customer ON o_custkey = c_custkey LEFT JOIN nation ON c_nationkey = n_nationkey""",
    # priced lines and valid sales
    "tr": "SELECT *, CAST(Quantity * Price AS DECIMAL(18, 2)) AS r FROM t",
    "s": f"SELECT * FROM tr WHERE CustomerID IS NOT NULL AND NOT {CANCELLED}",
    "spend": "SELECT CustomerID, SUM(r) AS spend, COUNT(DISTINCT Invoice) AS orders FROM s GROUP BY CustomerID",
    "months": "SELECT strftime(InvoiceDate, '%Y-%m') AS year_month, SUM(r) AS revenue FROM s GROUP BY ALL",
    # segments, SQL flavour
    "rs": """SELECT CustomerID, datesub('day', MAX(InvoiceDate), (SELECT MAX(InvoiceDate) FROM t)) AS Recency,
        COUNT(DISTINCT Invoice) AS Frequency, SUM(r) AS Monetary FROM s GROUP BY CustomerID""",
    "rss": """SELECT *, NTILE(5) OVER (ORDER BY Recency DESC, CustomerID) AS R_Score,
        NTILE(5) OVER (ORDER BY Frequency, CustomerID) AS F_Score,
        NTILE(5) OVER (ORDER BY Monetary, CustomerID) AS M_Score FROM rs""",
    "rsg": f"""SELECT *, CAST(R_Score AS VARCHAR) || CAST(F_Score AS VARCHAR) || CAST(M_Score AS VARCHAR) AS RFM_Score,
        {segment('R_Score', 'F_Score', 'Cant Lose Them', 'Lost')} AS Segment FROM rss""",
    # cleaned lines
    "lines": f"""SELECT DISTINCT trim(Invoice) AS Invoice, StockCode, Description, Quantity, InvoiceDate, Price,
        trim(split_part(CustomerID, '.', 1)) AS CustomerID, Country FROM t
        WHERE CustomerID IS NOT NULL AND NOT starts_with(trim(Invoice), 'C') AND Quantity > 0 AND Price > 0
        AND regexp_full_match(trim(split_part(CustomerID, '.', 1)), '[0-9]+') AND upper(StockCode) NOT IN {SERVICE}""",
    "bounds": """SELECT CAST(quantile_cont(Quantity::DOUBLE, 0.01) AS DECIMAL(16, 4)) AS ql,
        CAST(quantile_cont(Quantity::DOUBLE, 0.99) AS DECIMAL(16, 4)) AS qh,
        CAST(quantile_cont(Price::DOUBLE, 0.01) AS DECIMAL(16, 4)) AS pl,
        CAST(quantile_cont(Price::DOUBLE, 0.99) AS DECIMAL(16, 4)) AS ph FROM lines""",
    "clipped": """SELECT Invoice, StockCode, upper(trim(Description)) AS Description,
        LEAST(GREATEST(CAST(Quantity AS DECIMAL(16, 4)), ql), qh) AS Quantity, InvoiceDate,
        LEAST(GREATEST(CAST(Price AS DECIMAL(16, 4)), pl), ph) AS Price, CustomerID, Country FROM lines, bounds""",
    "cleaned": "SELECT *, CAST(Quantity * Price AS DECIMAL(24, 6)) AS Revenue FROM clipped",
    # segments, Python flavour
    "rp": """SELECT CustomerID,
        datesub('day', MAX(InvoiceDate), (SELECT MAX(InvoiceDate) + INTERVAL 1 DAY FROM cleaned)) AS Recency,
        COUNT(DISTINCT Invoice) AS Frequency, SUM(Revenue) AS Monetary FROM cleaned GROUP BY CustomerID""",
    "rpr": """SELECT *, COUNT(*) OVER () AS n, ROW_NUMBER() OVER (ORDER BY Recency, CustomerID) AS pr,
        ROW_NUMBER() OVER (ORDER BY Frequency, CustomerID) AS pf,
        ROW_NUMBER() OVER (ORDER BY Monetary, CustomerID) AS pm FROM rp""",
    "rps": f"""SELECT CustomerID, Recency, Frequency, Monetary, 6 - {qcut('pr', 'n', 5)} AS R_Score,
        {qcut('pf', 'n', 5)} AS F_Score, {qcut('pm', 'n', 5)} AS M_Score FROM rpr""",
    "rpg": f"""SELECT *, CAST(R_Score AS VARCHAR) || CAST(F_Score AS VARCHAR) || CAST(M_Score AS VARCHAR) AS RFM_Score,
        {segment('R_Score', 'F_Score', "Can't Lose Them", 'Need Attention')} AS Segment FROM rps""",
    # features
    "obs": f"SELECT *, epoch_us(InvoiceDate) AS us FROM cleaned WHERE InvoiceDate < {SPLIT}",
    "pred": f"SELECT * FROM cleaned WHERE InvoiceDate >= {SPLIT} AND InvoiceDate < {SPLIT} + INTERVAL 90 DAY",
    "f_rfm": f"""SELECT CustomerID, COUNT(DISTINCT Invoice) AS Frequency, SUM(Revenue) AS Monetary,
        datesub('day', MAX(InvoiceDate), {SPLIT}) AS Recency, datesub('day', MIN(InvoiceDate), {SPLIT}) AS Tenure
        FROM obs GROUP BY CustomerID""",
    "f_div": "SELECT CustomerID, COUNT(DISTINCT StockCode) AS Product_Diversity FROM obs GROUP BY CustomerID",
    "f_bask": """SELECT CustomerID, CAST(SUM(u) AS DOUBLE) / COUNT(*) AS Avg_Basket_Size,
        CAST(SUM(v) AS DOUBLE) / COUNT(*) AS Avg_Order_Value
        FROM (SELECT CustomerID, Invoice, SUM(Quantity) AS u, SUM(Revenue) AS v FROM obs GROUP BY ALL) GROUP BY CustomerID""",
    "f_month": """SELECT CustomerID, CAST(SUM(v) AS DOUBLE) / COUNT(*) AS Avg_Monthly_Spend
        FROM (SELECT CustomerID, date_trunc('month', InvoiceDate) AS m, SUM(Revenue) AS v FROM obs GROUP BY ALL)
        GROUP BY CustomerID""",
    "f_q4": """SELECT CustomerID, SUM(Revenue) AS total_rev,
        COALESCE(SUM(Revenue) FILTER (quarter(InvoiceDate) = 4), 0) AS q4_rev FROM obs GROUP BY CustomerID""",
    "f_gap": """SELECT CustomerID, COALESCE(CAST(SUM(gap) AS DOUBLE) / NULLIF(COUNT(gap), 0), 999.0) AS Avg_Purchase_Interval
        FROM (SELECT CustomerID, datesub('day', LAG(bought_at) OVER (PARTITION BY CustomerID ORDER BY bought_at, Invoice), bought_at) AS gap
              FROM (SELECT CustomerID, Invoice, MIN(InvoiceDate) AS bought_at FROM obs GROUP BY ALL)) GROUP BY CustomerID""",
    "f_mid": "SELECT CustomerID, MIN(us) + MAX(us) AS middle FROM obs GROUP BY CustomerID",
    "f_half": """SELECT CustomerID, COALESCE(SUM(Revenue) FILTER (2 * us <= middle), 0) AS first_half,
        COALESCE(SUM(Revenue) FILTER (2 * us > middle), 0) AS second_half
        FROM obs JOIN f_mid USING (CustomerID) GROUP BY CustomerID""",
    "f_grow": """SELECT CustomerID, CAST(second_half - first_half AS DOUBLE) / (CAST(first_half AS DOUBLE) + 1e-5) AS Revenue_Growth
        FROM f_half""",
    "f_home": """SELECT CustomerID, arg_min(Country, ROW(InvoiceDate, Country)) AS Country FROM obs GROUP BY CustomerID""",
    "f_uk": "SELECT CustomerID, CAST(Country = 'United Kingdom' AS BIGINT) AS Is_UK FROM f_home",
    "f_target": "SELECT CustomerID, CAST(SUM(Revenue) AS DOUBLE) AS target_revenue FROM pred GROUP BY CustomerID",
    "behaviour": """SELECT CustomerID, Product_Diversity, Avg_Basket_Size, Avg_Order_Value, Avg_Monthly_Spend,
        COALESCE(CAST(q4_rev AS DOUBLE) / NULLIF(CAST(total_rev AS DOUBLE), 0), 0) AS Seasonal_Score_Q4,
        Avg_Purchase_Interval, Revenue_Growth, Is_UK
        FROM f_div JOIN f_bask USING (CustomerID) JOIN f_month USING (CustomerID) JOIN f_q4 USING (CustomerID)
        JOIN f_gap USING (CustomerID) JOIN f_grow USING (CustomerID) JOIN f_uk USING (CustomerID)""",
    "features": """SELECT CustomerID, Frequency, CAST(Monetary AS DOUBLE) AS Monetary, Recency, Tenure,
        behaviour.* EXCLUDE (CustomerID), COALESCE(target_revenue, 0) AS target_revenue
        FROM f_rfm JOIN behaviour USING (CustomerID) LEFT JOIN f_target USING (CustomerID)""",
    "scored": "SELECT *, GREATEST(0.0::DOUBLE, Avg_Monthly_Spend * 3) AS predicted_cltv FROM features",
}


def q(body: str, *extra: str) -> str:
    """``body`` with the expressions it names, and those they name, in front."""
    needed: set[str] = set()
    pending = [body, *extra]
    while pending:
        words = set(pending.pop().replace("(", " ").replace(")", " ").replace(",", " ").replace(".", " ").split())
        for name in words & set(CTES) - needed:
            needed.add(name)
            pending.append(CTES[name])
    front = [f"{n} AS ({sql})" for n, sql in CTES.items() if n in needed]
    return f"WITH {', '.join([*front, *extra])} {body}" if front or extra else body


# Output columns of whole lines.
RAW = "Invoice, StockCode, Description, CAST(Quantity AS BIGINT) AS Quantity, InvoiceDate, CAST(Price AS DOUBLE) AS Price, CustomerID, Country"
DONE = "Invoice, StockCode, Description, CAST(Quantity AS DOUBLE) AS Quantity, InvoiceDate, CAST(Price AS DOUBLE) AS Price, CustomerID, Country, CAST(Revenue AS DOUBLE) AS Revenue"
BUYS = "SUM(CASE WHEN Quantity > 0 THEN Quantity ELSE 0 END)::BIGINT"
BACKS = "SUM(CASE WHEN Quantity < 0 THEN -Quantity ELSE 0 END)::BIGINT"
RATE = rnd(f"CAST({BACKS} AS DOUBLE) * 100 / (CAST({BUYS} AS DOUBLE) + 1e-5)", 2)
EVERYONE = "(SELECT COUNT(DISTINCT CustomerID) FROM t)"


def named_top(stats: str, where: str, order: str, k: int, name: str = "Description", source: str = "tr") -> str:
    return q(f"SELECT StockCode, MIN(Description) AS {name}, {stats} FROM {source} WHERE {where} "
             f"GROUP BY StockCode ORDER BY {order} DESC, StockCode LIMIT {k}")


def profile() -> str:
    types = {
        "Invoice": "string", "StockCode": "string", "Description": "string", "Quantity": "int",
        "InvoiceDate": "timestamp_ntz", "Price": "decimal(12,2)", "CustomerID": "string", "Country": "string",
    }
    rows = " UNION ALL ".join(
        f"""SELECT COUNT(*) AS total_rows, 8::BIGINT AS total_columns,
        COUNT(*) - (SELECT COUNT(*) FROM (SELECT DISTINCT * FROM t)) AS duplicate_rows, '{c}' AS column_name,
        '{kind}' AS dtype, COUNT(DISTINCT {c}) AS unique_values, COUNT(*) - COUNT({c}) AS null_count,
        {pct(f'COUNT(*) - COUNT({c})', 'COUNT(*)')} AS null_percentage FROM t"""
        for c, kind in types.items()
    )
    return q(rows)


def report() -> str:
    guard = [
        "CustomerID IS NOT NULL",
        f"NOT {CANCELLED}",
        "Quantity > 0",
        "Price > 0",
    ]
    passed = [" AND ".join(guard[:i]) or "TRUE" for i in range(5)]
    counts = [f"(SELECT COUNT(*) FROM t WHERE {p})" for p in passed]
    counts.append(f"(SELECT COUNT(*) FROM (SELECT DISTINCT * FROM t WHERE {passed[4]}))")
    counts.append("(SELECT COUNT(*) FROM lines)")
    steps = " UNION ALL ".join(
        f"SELECT {text(name)} AS step_name, {counts[i]} AS b, {counts[i + 1]} AS a, {counts[0]} AS o"
        for i, name in enumerate(AUDITED)
    )
    return q(f"""SELECT step_name, b AS rows_before, a AS rows_after, b - a AS rows_removed,
        COALESCE({pct('b - a', 'b', 4)}, 0) AS pct_removed, o - a AS total_removed,
        COALESCE({pct('o - a', 'o')}, 0) AS total_removed_pct FROM ({steps})""")


STEP = "CASE WHEN Is_UK = 1 THEN 140.0::DOUBLE ELSE 40.0::DOUBLE END"
RULE = "CAST(Recency * 2 + Frequency * 5 + 7 AS DOUBLE)"
TEST_SIDE = "CAST('0x' || md5(CustomerID)[1:8] AS BIGINT) % 100 >= 80"


def regression(actual: str, predicted: str) -> str:
    e = f"({actual} - {predicted})"
    return (
        f"{rnd(f'AVG(ABS{e})', 4)} AS MAE, {rnd(f'SQRT(AVG({e} * {e}))', 4)} AS RMSE, "
        f"{rnd(f'1 - SUM({e} * {e}) / (VAR_POP({actual}) * COUNT(*))', 4)} AS R2, "
        f"{rnd(f'COALESCE(AVG(ABS({e} / {actual})) FILTER ({actual} > 0) * 100, 0)', 4)} AS MAPE"
    )


SIMPLE = {"Monthly": "Avg_Monthly_Spend", "Order": "Avg_Order_Value", "History": "Monetary"}
SIMPLE_ROWS = " UNION ALL ".join(
    f"SELECT '{name}' AS Model, {regression('target_revenue', column)} FROM features" for name, column in SIMPLE.items()
)
WEIGHTS = {"Monetary": 180.0, "Frequency": 70.0, "Recency": -110.0, "Tenure": 45.0, "Avg_Monthly_Spend": 55.0}


def attribution() -> str:
    z = {c: f"(({c} - AVG({c}) OVER ()) / (STDDEV_SAMP({c}) OVER () + 1e-5) * ({w}::DOUBLE))" for c, w in WEIGHTS.items()}
    parts = ", ".join(f"{x} AS z_{c}" for c, x in z.items())
    shown = ", ".join(f"{rnd(f'z_{c} * f', 3)} AS {c}_impact" for c in WEIGHTS)
    return q(f"""SELECT CustomerID, {rnd('predicted_cltv', 3)} AS predicted_cltv, {rnd('baseline', 3)} AS baseline, {shown}
        FROM (SELECT *, LEAST(GREATEST((predicted_cltv - baseline) / ({' + '.join(f'z_{c}' for c in WEIGHTS)} + 1e-5), 0.1::DOUBLE), 5.0::DOUBLE) AS f
              FROM (SELECT CustomerID, predicted_cltv, CASE WHEN AVG(predicted_cltv) OVER () > 0
                    THEN AVG(predicted_cltv) OVER () ELSE 120.0 END AS baseline, {parts} FROM scored))""")


def scaled(centre: str, spread: str) -> str:
    columns = ", ".join(
        f"{rnd(f'(CAST({c} AS DOUBLE) - {centre.format(c)}) / COALESCE(NULLIF({spread.format(c)}, 0), 1)', 6)} AS {c}"
        for c in ("Recency", "Frequency", "Monetary", "Is_UK")
    )
    return q(f"SELECT CustomerID, {columns} FROM features")


def scaled_test(centre: str, spread: str) -> str:
    """The test split in units of the train split; ``{}`` stands for a column of the train split."""
    side = "CAST('0x' || md5(CustomerID)[1:8] AS BIGINT) % 100 < 80"
    names = ("Recency", "Frequency", "Monetary", "Is_UK")
    stats = ", ".join(f"{centre.format(f'CAST({c} AS DOUBLE)')} AS {c}_c, {spread.format(f'CAST({c} AS DOUBLE)')} AS {c}_s" for c in names)
    columns = ", ".join(f"{rnd(f'(CAST({c} AS DOUBLE) - {c}_c) / COALESCE(NULLIF({c}_s, 0), 1)', 6)} AS {c}" for c in names)
    return q(f"SELECT CustomerID, {columns} FROM features, (SELECT {stats} FROM features WHERE {side}) WHERE NOT ({side})")


def summary(source: str, averages: list[str], names: list[str]) -> str:
    columns = ", ".join(f"{a} AS {n}" for a, n in zip(averages, names[2:6]))
    return q(f"""SELECT Segment AS {names[0]}, COUNT(*) AS {names[1]}, {columns},
        {pct('COUNT(*)', f'(SELECT COUNT(*) FROM {source})')} AS {names[6]},
        {pct('SUM(Monetary)', f'(SELECT SUM(Monetary) FROM {source})')} AS {names[7]} FROM {source} GROUP BY Segment""")


SUMMARY_SQL = summary(
    "rsg",
    [
        rnd("CAST(SUM(Recency) AS DOUBLE) / COUNT(*)", 1),
        rnd("CAST(SUM(Frequency) AS DOUBLE) / COUNT(*)", 1),
        rnd("CAST(SUM(Monetary) AS DOUBLE) / COUNT(*)", 2),
        rnd("SUM(Monetary)", 2),
    ],
    ["segment", "customer_count", "avg_recency_days", "avg_frequency_orders", "avg_monetary_spend",
     "total_segment_revenue", "customer_percentage", "revenue_percentage"],
)
CROSS = "SELECT DISTINCT CustomerID FROM t WHERE StockCode = '5' AND CustomerID IS NOT NULL AND CustomerID NOT IN (SELECT CustomerID FROM t WHERE StockCode = '7'{}) ORDER BY 1 LIMIT 15"
PRODUCT_SUMMARY = q(f"""SELECT StockCode, MIN(Description) AS product_description, {BUYS} AS units_sold,
    CAST(SUM(CASE WHEN Quantity > 0 THEN r ELSE 0 END) AS DOUBLE) AS gross_sales_value, {BACKS} AS units_returned,
    CAST(SUM(CASE WHEN Quantity < 0 THEN -r ELSE 0 END) AS DOUBLE) AS refunds_value,
    CAST(SUM(r) AS DOUBLE) AS net_sales_value, COUNT(DISTINCT CustomerID) AS unique_buyers, {RATE} AS return_rate_pct
    FROM tr WHERE Price > 0 GROUP BY StockCode""")
CUSTOMER_SUMMARY = """SELECT CustomerID, Country, MIN(InvoiceDate) AS first_purchase_date, MAX(InvoiceDate) AS last_purchase_date,
    COUNT(DISTINCT Invoice) AS total_orders, SUM(Quantity)::BIGINT AS total_items_bought,
    CAST(SUM(r) AS DOUBLE) AS total_revenue_spend, CAST(SUM(r) AS DOUBLE) / COUNT(r) AS avg_item_revenue,
    CAST(SUM(r) AS DOUBLE) / COUNT(DISTINCT Invoice) AS avg_order_value FROM s GROUP BY CustomerID, Country"""
QUARTILES = q("""SELECT year_month, CAST(revenue AS DOUBLE) AS monthly_revenue,
    NTILE(4) OVER (ORDER BY revenue, year_month) AS revenue_quartile FROM months""")
AVG_DAILY = q("""SELECT CAST(SUM(v) AS DOUBLE) / COUNT(*) AS avg_daily_revenue
    FROM (SELECT CAST(InvoiceDate AS DATE) AS d, SUM(r) AS v FROM s GROUP BY ALL)""")
PYTHON_BASE = q("SELECT CustomerID, Recency, Frequency, CAST(Monetary AS DOUBLE) AS Monetary FROM rp")
SEGMENT_COUNTS = q("SELECT Segment, COUNT(*) AS Customer_Count FROM rpg GROUP BY Segment")
CHURN = """(SELECT CAST(COUNT(*) FILTER (datesub('day', m, (SELECT MAX(InvoiceDate) FROM cleaned)) > 90) AS DOUBLE) / COUNT(*)
    FROM (SELECT MAX(InvoiceDate) AS m FROM cleaned GROUP BY CustomerID))"""
MEASURES = {
    "net_sales": "CAST(SUM(Revenue) AS DOUBLE)",
    "unique_customers": "COUNT(DISTINCT CustomerID)",
    "total_orders": "COUNT(DISTINCT Invoice)",
    "average_order_value": "CAST(SUM(Revenue) AS DOUBLE) / COUNT(DISTINCT Invoice)",
    "purchase_frequency": "CAST(COUNT(DISTINCT Invoice) AS DOUBLE) / COUNT(DISTINCT CustomerID)",
}
TIER_TABLE = f"(VALUES {values(TIERS)}) AS tiers(Tier, CAC_Cap, Strategy, Next_Action, Expected_ROI, Confidence)"


def by_group(*keys: str) -> str:
    """All eleven measures per group of the lines with their dimensions."""
    g = ", ".join(keys)
    same = " AND ".join(f"a.{k} IS NOT DISTINCT FROM b.{k}" for k in keys)
    fact = """(SELECT cleaned.*, Segment, strftime(InvoiceDate, '%Y') AS Year, 'Q' || quarter(InvoiceDate) AS Quarter
        FROM cleaned LEFT JOIN rpg USING (CustomerID))"""
    return q(f"""SELECT a.*, b.* EXCLUDE ({g}) FROM
        (SELECT {g}, {', '.join(f'{sql} AS {n}' for n, sql in MEASURES.items())} FROM {fact} GROUP BY {g}) AS a JOIN
        (SELECT {g}, 45.0::DOUBLE AS assumed_cac, {rnd('SUM(CAST(predicted_cltv AS DECIMAL(28, 6)))', 2)} AS total_predicted_cltv,
          {rnd('AVG(predicted_cltv)', 2)} AS avg_predicted_cltv, COALESCE({rnd('AVG(predicted_cltv) / 45', 4)}, 0) AS ltv_to_cac,
          CAST(COUNT(*) FILTER (n > 1) AS DOUBLE) / COUNT(*) AS repeat_purchase_rate,
          CAST(COUNT(*) FILTER (datesub('day', seen, (SELECT MAX(InvoiceDate) FROM cleaned)) > 90) AS DOUBLE) / COUNT(*) AS churn_rate
          FROM (SELECT {g}, CustomerID, COUNT(DISTINCT Invoice) AS n FROM {fact} GROUP BY {g}, CustomerID)
          JOIN (SELECT CustomerID, MAX(InvoiceDate) AS seen FROM cleaned GROUP BY CustomerID) USING (CustomerID)
          LEFT JOIN (SELECT CustomerID, predicted_cltv FROM scored) USING (CustomerID) GROUP BY {g}) AS b ON {same}""")


def measure(name: str) -> str:
    return q(f"SELECT {MEASURES[name]} AS {name} FROM cleaned")


ORACLE: dict[str, str] = {
    "load_transactions": q(f"SELECT {RAW} FROM t"),
    "load_awkward_csv": q(f"""SELECT {RAW.replace('Description', "CASE abs(Quantity) % 5 WHEN 0 THEN '  PAD  ' WHEN 1 THEN 'SET \"15\", RED' WHEN 2 THEN '' WHEN 3 THEN '日本 é, €' END AS Description")} FROM t"""),
    "stored_table": q("""SELECT CustomerID, COUNT(*) AS line_count, CAST(SUM(Quantity) AS BIGINT) AS units FROM (
        SELECT CustomerID, Quantity FROM t UNION ALL SELECT '13085', 6 UNION ALL SELECT '13085', -1) GROUP BY CustomerID"""),
    "load_mixed_encodings": q("""SELECT 'CAF\u00c9' AS Description, Country, COUNT(*) AS line_count, CAST(SUM(Quantity) AS BIGINT) AS units FROM t GROUP BY Country
        UNION ALL SELECT 'put aside', 'Quantity', COUNT(*), 0 FROM t WHERE Quantity < 0 HAVING COUNT(*) > 0"""),
    "union_periods": q(f"SELECT {RAW} FROM t"),
    "validate_schema": q("SELECT TRUE AS valid, COUNT(*) AS row_count, COUNT(CustomerID) AS known_rows FROM t"),
    "table_profile": profile(),
    "save_table": q(f"SELECT {DONE} FROM cleaned"),
    "load_table": q(f"SELECT {RAW} FROM lines"),
    "create_transactions": q(f"SELECT {RAW} FROM t"),
    "insert_rows": q(f"""SELECT {RAW} FROM t
        UNION ALL SELECT '489434', '85123A', 'WHITE HANGING HEART T-LIGHT HOLDER', 6, TIMESTAMP '2009-12-01 07:45:00', 2.55::DOUBLE, '13085', 'United Kingdom'
        UNION ALL SELECT 'C489435', '22632', 'HAND WARMER RED POLKA DOT', -1, TIMESTAMP '2009-12-01 07:46:00', 1.85::DOUBLE, '13085', 'United Kingdom'"""),
    "valid_sales": q(f"SELECT {RAW} FROM s"),
    "positive_price": q("SELECT Invoice, StockCode, CAST(Quantity AS BIGINT) AS Quantity, CAST(Price AS DOUBLE) AS Price FROM t WHERE Price > 0"),
    "cancellations_only": q(f"SELECT Invoice, StockCode, CAST(Quantity AS BIGINT) AS Quantity FROM t WHERE {CANCELLED}"),
    "exclude_home_market": q("SELECT Invoice, StockCode, CustomerID, Country FROM t WHERE Country <> 'United Kingdom'"),
    "min_volume": q(f"SELECT StockCode, {BUYS} AS sold_qty, {BACKS} AS returned_qty FROM t GROUP BY StockCode HAVING {BUYS} > 100"),
    "having_filter": q("SELECT CustomerID, COUNT(DISTINCT Invoice) AS order_count FROM s GROUP BY CustomerID HAVING COUNT(DISTINCT Invoice) = 1"),
    "date_window": q(f"SELECT {RAW} FROM t WHERE InvoiceDate >= {SPLIT} AND InvoiceDate < {SPLIT} + INTERVAL 90 DAY"),
    "line_revenue": q("SELECT Invoice, StockCode, CAST(Quantity AS BIGINT) AS Quantity, CAST(Price AS DOUBLE) AS Price, CAST(r AS DOUBLE) AS Revenue FROM tr"),
    "conditional_bucket": q("""SELECT Invoice, StockCode, CAST(Quantity AS BIGINT) AS Quantity,
        CASE WHEN Quantity <= 5 THEN '1. Tiny (1-5 items)' WHEN Quantity <= 15 THEN '2. Small (6-15 items)'
        WHEN Quantity <= 50 THEN '3. Medium (16-50 items)' WHEN Quantity <= 150 THEN '4. Large (51-150 items)'
        ELSE '5. Bulk (>150 items)' END AS size_band FROM t"""),
    "segment_filter": q("SELECT CustomerID, Recency, Frequency, CAST(Monetary AS DOUBLE) AS Monetary FROM rpg WHERE Segment = 'Champions' ORDER BY CustomerID LIMIT 100"),
    "customer_filter": q(f"SELECT {DONE} FROM cleaned WHERE CustomerID = '7'"),
    "join_cohort": q("""SELECT CustomerID, activity_month, line_count, cohort_month
        FROM (SELECT CustomerID, strftime(InvoiceDate, '%Y-%m') AS activity_month, COUNT(*) AS line_count FROM s GROUP BY ALL)
        JOIN (SELECT CustomerID, strftime(MIN(InvoiceDate), '%Y-%m') AS cohort_month FROM s GROUP BY CustomerID) USING (CustomerID)"""),
    "join_seasonality": q("SELECT CustomerID, CAST(total_rev AS DOUBLE) AS total_rev, CAST(q4_rev AS DOUBLE) AS q4_rev FROM f_q4"),
    "join_midpoint": q("""SELECT CustomerID, strftime(InvoiceDate, '%Y-%m-%d') AS day, CAST(SUM(Revenue) AS DOUBLE) AS revenue, ANY_VALUE(middle) AS middle
        FROM obs JOIN f_mid USING (CustomerID) GROUP BY 1, 2"""),
    "join_halves": q("SELECT CustomerID, CAST(first_half AS DOUBLE) AS first_half, CAST(second_half AS DOUBLE) AS second_half FROM f_half"),
    "join_features": q("SELECT * FROM behaviour"),
    "join_rfm_behaviour": q("SELECT * EXCLUDE (target_revenue) FROM features"),
    "join_target": q("SELECT CustomerID, target_revenue FROM features"),
    "anti_null_in_list": q(f"""SELECT (SELECT COUNT(*) FROM (SELECT DISTINCT CustomerID FROM s WHERE CustomerID NOT IN (SELECT CustomerID FROM t WHERE {CANCELLED}))) AS not_in_list,
        (SELECT COUNT(*) FROM t WHERE {CANCELLED} AND CustomerID IS NULL) AS nulls_in_list"""),
    "anti_null_aware": q(f"SELECT DISTINCT CustomerID FROM s WHERE CustomerID NOT IN (SELECT CustomerID FROM t WHERE {CANCELLED} AND CustomerID IS NOT NULL)"),
    "scalar_cross": q("""SELECT CustomerID, MAX(InvoiceDate) AS last_seen, (SELECT MAX(InvoiceDate) FROM t) AS newest,
        datesub('day', MAX(InvoiceDate), (SELECT MAX(InvoiceDate) FROM t)) AS days_since FROM t WHERE CustomerID IS NOT NULL GROUP BY CustomerID"""),
    "join_strategy": q(f"""SELECT CustomerID, Segment, p.* EXCLUDE (sname) FROM rpg
        JOIN (VALUES {values(PLAYBOOK)}) AS p(sname, Description, Marketing_Goal, Tactical_Action, Primary_Channel) ON sname = Segment"""),
    "star_join": q(f"""SELECT Segment, strftime(d, '%Y') AS Year, 'Q' || quarter(d) AS Quarter, CAST(SUM(v) AS DOUBLE) AS net_sales,
        CAST(SUM(u) AS DOUBLE) AS units, COUNT(*) FILTER (name IS NOT NULL) AS known_product_sales
        FROM (SELECT CustomerID, StockCode, CAST(InvoiceDate AS DATE) AS d, SUM(Revenue) AS v, SUM(Quantity) AS u FROM cleaned GROUP BY ALL)
        LEFT JOIN rpg USING (CustomerID)
        LEFT JOIN (SELECT StockCode, MIN(Description) AS name FROM t WHERE Price > 0 GROUP BY StockCode) USING (StockCode)
        GROUP BY 1, 2, 3"""),
    "profile_join": q("SELECT features.*, R_Score, F_Score, M_Score, RFM_Score, Segment FROM features LEFT JOIN rpg USING (CustomerID)"),
    "agg_basic": q("""SELECT StockCode, SUM(Quantity)::BIGINT AS units, CAST(SUM(Price) AS DOUBLE) / COUNT(Price) AS avg_price,
        CAST(MIN(Price) AS DOUBLE) AS min_price, CAST(MAX(Price) AS DOUBLE) AS max_price, COUNT(*) AS line_count
        FROM t WHERE Price > 0 GROUP BY StockCode"""),
    "agg_distinct": q("SELECT StockCode, COUNT(DISTINCT Invoice) AS invoices, COUNT(DISTINCT CustomerID) AS buyers FROM t GROUP BY StockCode"),
    "agg_distinct_sketch": q("""SELECT strftime(InvoiceDate, '%Y-%m') AS year_month, COUNT(DISTINCT Invoice) AS orders, COUNT(DISTINCT CustomerID) AS buyers,
        TRUE AS orders_close, TRUE AS buyers_close FROM t WHERE InvoiceDate IS NOT NULL GROUP BY 1"""),
    "agg_conditional": q(f"SELECT StockCode, {BUYS} AS sold_qty, {BACKS} AS returned_qty FROM t GROUP BY StockCode"),
    "agg_two_level": q("SELECT * FROM f_month"),
    "agg_ratio": q("SELECT CustomerID, CAST(spend AS DOUBLE) / orders AS avg_order_value FROM spend"),
    "agg_share": q(f"""SELECT Country, {pct('SUM(r)', '(SELECT SUM(r) FROM s)')} AS revenue_pct,
        {pct('COUNT(*)', '(SELECT COUNT(*) FROM s)')} AS line_pct FROM s GROUP BY Country"""),
    "agg_histogram": q("SELECT orders AS order_count, COUNT(*) AS customer_count FROM spend GROUP BY orders"),
    "agg_first": q("SELECT * FROM f_home"),
    "agg_named": PYTHON_BASE,
    "value_counts": SEGMENT_COUNTS,
    "exact_quantile": q(" UNION ALL ".join(
        f"SELECT '{c}' AS name, {p}::DOUBLE AS q, CAST(CAST(quantile_cont({c}::DOUBLE, {p}) AS DECIMAL(20, 4)) AS DOUBLE) AS value FROM lines"
        for c in ("Quantity", "Price") for p in (0.01, 0.25, 0.5, 0.75, 0.99))),
    "bracketed_quantile": q(" UNION ALL ".join(
        f"SELECT '{c}' AS name, {p}::DOUBLE AS q, CAST(CAST(quantile_cont({c}::DOUBLE, {p}) AS DECIMAL(20, 4)) AS DOUBLE) AS value FROM lines"
        for c in ("Quantity", "Price") for p in (0.01, 0.25, 0.5, 0.75, 0.99))),
    "w_rank": q("SELECT CustomerID, orders AS order_count, RANK() OVER (ORDER BY orders DESC) AS order_rank FROM spend"),
    "w_row_number": q("SELECT CustomerID, CAST(spend AS DOUBLE) AS total_spend, ROW_NUMBER() OVER (ORDER BY spend DESC, CustomerID) AS place FROM spend"),
    "w_ntile4": QUARTILES,
    "w_ntile5": q("SELECT CustomerID, Recency, Frequency, R_Score, F_Score, M_Score FROM rss"),
    "w_lag": q("""SELECT CustomerID, Invoice, bought_at, LAG(bought_at) OVER (PARTITION BY CustomerID ORDER BY bought_at, Invoice) AS previous_at
        FROM (SELECT CustomerID, Invoice, MIN(InvoiceDate) AS bought_at FROM s GROUP BY ALL)"""),
    "w_rolling": q("""SELECT year_week, SUM(n) OVER (ORDER BY year_week ROWS BETWEEN 2 PRECEDING AND CURRENT ROW)::BIGINT AS orders_3_weeks
        FROM (SELECT strftime(InvoiceDate, '%Y-%W') AS year_week, COUNT(DISTINCT Invoice) AS n FROM s GROUP BY ALL)"""),
    "w_cumulative": q("""SELECT Country, buyers, SUM(buyers) OVER (ORDER BY buyers DESC)::BIGINT AS running_buyers
        FROM (SELECT Country, COUNT(DISTINCT CustomerID) AS buyers FROM s GROUP BY Country)"""),
    "w_rank_first": q("SELECT CustomerID, Recency, pr AS recency_rank FROM rpr"),
    "w_qcut": q(f"SELECT CustomerID, Frequency, {qcut('pf', 'n', 7)} AS bin FROM rpr"),
    "order_by": q("SELECT CustomerID, CAST(spend AS DOUBLE) AS spend, orders FROM spend ORDER BY orders DESC, spend.spend DESC, CustomerID"),
    "top_k": q("SELECT CustomerID, CAST(spend.spend AS DOUBLE) AS total_spend FROM spend ORDER BY spend.spend DESC, CustomerID LIMIT 20"),
    "top_1_per_group": q("""SELECT CustomerID, StockCode, SUM(Quantity)::BIGINT AS units FROM s GROUP BY CustomerID, StockCode
        QUALIFY ROW_NUMBER() OVER (PARTITION BY CustomerID ORDER BY SUM(Quantity) DESC, StockCode) = 1"""),
    "global_rank": q("SELECT CustomerID, orders AS order_count, ROW_NUMBER() OVER (ORDER BY orders, CustomerID) AS place, COUNT(*) OVER () AS customers FROM spend"),
    "union_all": q("SELECT strftime(InvoiceDate, '%Y-%m') AS year_month, COUNT(*) AS line_count FROM t GROUP BY ALL"),
    "select_distinct": q("SELECT DISTINCT CustomerID, Invoice, InvoiceDate FROM s"),
    "drop_duplicates": q(f"SELECT {RAW} FROM (SELECT DISTINCT * FROM t)"),
    "cte_chain": SUMMARY_SQL,
    "derived_table": AVG_DAILY,
    "views": q("""SELECT 'v_customer_summary' AS view_name, COUNT(*) AS row_count FROM (SELECT DISTINCT CustomerID, Country FROM s)
        UNION ALL SELECT 'v_monthly_revenue', COUNT(*) FROM months
        UNION ALL SELECT 'v_rfm_segments', COUNT(*) FROM spend
        UNION ALL SELECT 'v_product_summary', COUNT(DISTINCT StockCode) FROM t WHERE Price > 0"""),
    "clean_missing_customer": q(f"SELECT {RAW} FROM t WHERE CustomerID IS NOT NULL"),
    "clean_cancelled": q(f"SELECT {RAW} FROM t WHERE NOT {CANCELLED}"),
    "clean_quantity": q(f"SELECT {RAW} FROM t WHERE Quantity > 0"),
    "clean_price": q(f"SELECT {RAW} FROM t WHERE Price > 0"),
    "clean_types": q(f"SELECT {RAW} FROM t"),
    "clean_duplicates": q(f"SELECT {RAW} FROM (SELECT DISTINCT * FROM t)"),
    "clean_test_accounts": q(f"SELECT {RAW} FROM t WHERE CustomerID IS NOT NULL AND upper(StockCode) NOT IN {SERVICE}"),
    "winsorize": q("""SELECT Invoice, StockCode, Description, CAST(LEAST(GREATEST(Quantity::DOUBLE, b.ql), b.qh) AS DOUBLE) AS Quantity, InvoiceDate,
        CAST(LEAST(GREATEST(Price::DOUBLE, b.pl), b.ph) AS DOUBLE) AS Price, CustomerID, Country FROM lines,
        (SELECT ROUND(quantile_cont(Quantity::DOUBLE, 0.05), 4) AS ql, ROUND(quantile_cont(Quantity::DOUBLE, 0.95), 4) AS qh,
                ROUND(quantile_cont(Price::DOUBLE, 0.05), 4) AS pl, ROUND(quantile_cont(Price::DOUBLE, 0.95), 4) AS ph FROM lines) AS b"""),
    "winsorize_fine": q("""SELECT Invoice, StockCode, Description, CAST(LEAST(GREATEST(Quantity::DOUBLE, b.ql), b.qh) AS DOUBLE) AS Quantity, InvoiceDate,
        CAST(LEAST(GREATEST(Price::DOUBLE, b.pl), b.ph) AS DOUBLE) AS Price, CustomerID, Country FROM lines,
        (SELECT ROUND(quantile_cont(Quantity::DOUBLE, 0.013), 5) AS ql, ROUND(quantile_cont(Quantity::DOUBLE, 0.987), 5) AS qh,
                ROUND(quantile_cont(Price::DOUBLE, 0.013), 5) AS pl, ROUND(quantile_cont(Price::DOUBLE, 0.987), 5) AS ph FROM lines) AS b"""),
    "clean_description": q(f"SELECT {RAW.replace('Description', 'upper(trim(Description)) AS Description')} FROM t"),
    "add_revenue": q("SELECT Invoice, StockCode, CAST(Quantity AS DOUBLE) AS Quantity, CAST(Price AS DOUBLE) AS Price, CAST(Revenue AS DOUBLE) AS Revenue FROM cleaned"),
    "cleaning_report": report(),
    "clean_all": q(f"SELECT {DONE} FROM cleaned"),
    "split_windows": q("""SELECT 'observation' AS side, COUNT(*) AS line_count, MIN(InvoiceDate) AS first_line, MAX(InvoiceDate) AS last_line,
        CAST(SUM(Revenue) AS DOUBLE) AS revenue FROM obs
        UNION ALL SELECT 'prediction', COUNT(*), MIN(InvoiceDate), MAX(InvoiceDate), CAST(SUM(Revenue) AS DOUBLE) FROM pred"""),
    "rfm_base": q("SELECT CustomerID, Frequency, CAST(Monetary AS DOUBLE) AS Monetary, Recency, Tenure FROM f_rfm"),
    "product_diversity": q("SELECT * FROM f_div"),
    "avg_basket_size": q("SELECT CustomerID, Avg_Basket_Size FROM f_bask"),
    "avg_order_value": q("SELECT CustomerID, Avg_Order_Value FROM f_bask"),
    "avg_monthly_spend": q("SELECT * FROM f_month"),
    "seasonal_score_q4": q("SELECT CustomerID, Seasonal_Score_Q4 FROM behaviour"),
    "avg_purchase_interval": q("SELECT * FROM f_gap"),
    "revenue_growth": q("SELECT * FROM f_grow"),
    "is_uk": q("SELECT * FROM f_uk"),
    "behavioural_features": q("SELECT * FROM behaviour"),
    "feature_table": q("SELECT * FROM features"),
    "target_revenue": q("SELECT * FROM f_target"),
    "returning_rate": q(f"""SELECT COUNT(*) AS customers, COUNT(*) FILTER (target_revenue > 0) AS returning_customers,
        {pct('COUNT(*) FILTER (target_revenue > 0)', 'COUNT(*)')} AS returning_pct FROM features"""),
    "scale_standard": scaled("AVG({}) OVER ()", "STDDEV_POP({}) OVER ()"),
    "scale_test_standard": scaled_test("AVG({})", "STDDEV_POP({})"),
    "scale_test_minmax": scaled_test("MIN({})", "(MAX({0}) - MIN({0}))"),
    "scale_minmax": scaled("MIN({}) OVER ()", "(MAX({0}) OVER () - MIN({0}) OVER ())"),
    "growing_rfm": q("SELECT CustomerID, Recency, Frequency, CAST(Monetary AS DOUBLE) AS Monetary FROM rs"),
    "growing_customer_summary": q(CUSTOMER_SUMMARY),
    "rfm_raw_sql": q("SELECT CustomerID, Recency, Frequency, CAST(Monetary AS DOUBLE) AS Monetary FROM rs"),
    "rfm_scores_ntile": q("SELECT * EXCLUDE (Segment) REPLACE (CAST(Monetary AS DOUBLE) AS Monetary) FROM rsg"),
    "rfm_base_full": PYTHON_BASE,
    "rfm_scores_qcut": q("SELECT * EXCLUDE (Segment) REPLACE (CAST(Monetary AS DOUBLE) AS Monetary) FROM rpg"),
    "rfm_segments": q("SELECT * REPLACE (CAST(Monetary AS DOUBLE) AS Monetary) FROM rpg"),
    "rfm_summary_sql": SUMMARY_SQL,
    "rfm_summary": summary(
        "rpg",
        [f"CAST(SUM({c}) AS DOUBLE) / COUNT(*)" for c in ("Recency", "Frequency", "Monetary")] + [dbl("SUM(Monetary)")],
        ["Segment", "Customer_Count", "Avg_Recency", "Avg_Frequency", "Avg_Monetary", "Total_Monetary",
         "Customer_Percentage", "Revenue_Percentage"],
    ),
    "segment_strategy": q(f"""SELECT p.*, (SELECT COUNT(*) FROM rpg WHERE rpg.Segment = p.Segment) AS Customer_Count
        FROM (VALUES {values(PLAYBOOK)}) AS p(Segment, Description, Marketing_Goal, Tactical_Action, Primary_Channel)"""),
    "rfm_full": q("SELECT CustomerID, RFM_Score, Segment, COUNT(*) OVER (PARTITION BY Segment) AS Customer_Count FROM rpg"),
    "validate_rfm_input": PYTHON_BASE,
    "revenue_totals": q(f"""SELECT CAST(SUM(CASE WHEN Quantity > 0 THEN r ELSE 0 END) AS DOUBLE) AS gross_revenue,
        CAST(SUM(CASE WHEN {CANCELLED} THEN r ELSE 0 END) AS DOUBLE) AS refund_revenue, CAST(SUM(r) AS DOUBLE) AS net_revenue
        FROM tr WHERE CustomerID IS NOT NULL AND Price > 0"""),
    "revenue_monthly": q("""SELECT strftime(InvoiceDate, '%Y-%m') AS year_month, CAST(SUM(r) AS DOUBLE) AS monthly_revenue,
        COUNT(DISTINCT Invoice) AS total_orders, COUNT(DISTINCT CustomerID) AS unique_active_customers FROM s GROUP BY 1"""),
    "revenue_weekly": q("""SELECT strftime(InvoiceDate, '%Y-%W') AS year_week, CAST(SUM(r) AS DOUBLE) AS weekly_revenue,
        COUNT(DISTINCT Invoice) AS total_orders FROM s GROUP BY 1"""),
    "revenue_top_months": q("""SELECT year_month, CAST(revenue AS DOUBLE) AS monthly_revenue, RANK() OVER (ORDER BY revenue DESC) AS revenue_rank
        FROM months ORDER BY revenue DESC, year_month LIMIT 10"""),
    "revenue_yearly": q("""SELECT strftime(InvoiceDate, '%Y') AS sales_year, CAST(SUM(r) AS DOUBLE) AS annual_revenue,
        COUNT(DISTINCT CustomerID) AS annual_unique_customers FROM s GROUP BY 1"""),
    "revenue_avg_daily": AVG_DAILY,
    "revenue_quartiles": QUARTILES,
    "customers_total": q("SELECT COUNT(DISTINCT CustomerID) AS total_unique_customers FROM t"),
    "customers_top_spend": q("""SELECT CustomerID, MIN(Country) AS Country, CAST(SUM(r) AS DOUBLE) AS total_spend,
        COUNT(DISTINCT Invoice) AS total_orders, RANK() OVER (ORDER BY SUM(r) DESC) AS customer_spend_rank
        FROM s GROUP BY CustomerID ORDER BY SUM(r) DESC, CustomerID LIMIT 20"""),
    "customers_frequency_dist": q(f"""SELECT orders AS order_count, COUNT(*) AS customer_count, {pct('COUNT(*)', EVERYONE)} AS customer_percentage
        FROM spend GROUP BY orders ORDER BY orders LIMIT 15"""),
    "customers_aov": q("""SELECT CustomerID, CAST(spend.spend AS DOUBLE) / orders AS avg_order_value, orders AS order_count
        FROM spend ORDER BY 2 DESC, 1 LIMIT 10"""),
    "customers_repeat_rate": q(f"""SELECT COUNT(*) FILTER (orders > 1) AS repeat_customers, COUNT(*) AS total_customers,
        {pct('COUNT(*) FILTER (orders > 1)', 'COUNT(*)')} AS repeat_purchase_rate_pct FROM spend"""),
    "customers_cohorts": q("""SELECT cohort_month, strftime(InvoiceDate, '%Y-%m') AS activity_month, COUNT(DISTINCT CustomerID) AS active_customers
        FROM s JOIN (SELECT CustomerID, strftime(MIN(InvoiceDate), '%Y-%m') AS cohort_month FROM s GROUP BY CustomerID) USING (CustomerID)
        GROUP BY 1, 2"""),
    "customers_lifetime": q("""SELECT CustomerID, MIN(InvoiceDate) AS first_purchase, MAX(InvoiceDate) AS last_purchase,
        datesub('day', MIN(InvoiceDate), MAX(InvoiceDate)) AS customer_lifetime_days FROM s GROUP BY CustomerID ORDER BY 4 DESC, 1 LIMIT 10"""),
    "customers_active": q(f"""SELECT CASE WHEN Recency <= 90 THEN 'Active (<= 90 days)' ELSE 'Inactive (> 90 days)' END AS customer_status,
        COUNT(*) AS customer_count, {pct('COUNT(*)', EVERYONE)} AS pct FROM rs GROUP BY 1"""),
    "customers_pareto": q(f"""SELECT CASE WHEN place <= {EVERYONE} * 0.20 THEN 'Top 20%' ELSE 'Bottom 80%' END AS customer_tier,
        COUNT(*) AS customer_count, CAST(SUM(x.spend) AS DOUBLE) AS total_tier_spend,
        {pct('SUM(x.spend)', '(SELECT SUM(r) FROM s)')} AS contribution_percentage
        FROM (SELECT *, ROW_NUMBER() OVER (ORDER BY spend.spend DESC, CustomerID) AS place FROM spend) AS x GROUP BY 1"""),
    "products_top_revenue": named_top(
        "CAST(SUM(r) AS DOUBLE) AS total_revenue, SUM(Quantity)::BIGINT AS units_sold, COUNT(DISTINCT Invoice) AS order_count",
        f"NOT {CANCELLED} AND Price > 0", "SUM(r)", 20),
    "products_top_units": named_top(
        "SUM(Quantity)::BIGINT AS units_sold, CAST(SUM(r) AS DOUBLE) AS total_revenue", f"NOT {CANCELLED} AND Price > 0", "SUM(Quantity)", 20),
    "products_most_returned": named_top(
        "ABS(SUM(Quantity))::BIGINT AS returned_units, CAST(ABS(SUM(r)) AS DOUBLE) AS refunded_amount, COUNT(DISTINCT Invoice) AS return_count",
        CANCELLED, "ABS(SUM(Quantity))", 20),
    "products_price_stats": named_top(
        "CAST(SUM(Price) AS DOUBLE) / COUNT(Price) AS avg_price, CAST(MIN(Price) AS DOUBLE) AS min_price, CAST(MAX(Price) AS DOUBLE) AS max_price",
        "Price > 0", "avg_price", 10),
    "products_diversity": q("""SELECT CustomerID, COUNT(DISTINCT StockCode) AS unique_products_bought, SUM(Quantity)::BIGINT AS total_units_bought
        FROM t WHERE CustomerID IS NOT NULL GROUP BY CustomerID ORDER BY 2 DESC, 1 LIMIT 15"""),
    "products_single_buyer": q("""SELECT StockCode, MIN(Description) AS product_name, COUNT(DISTINCT CustomerID) AS unique_buyer_count
        FROM t WHERE CustomerID IS NOT NULL GROUP BY StockCode HAVING COUNT(DISTINCT CustomerID) = 20 ORDER BY 1 LIMIT 10"""),
    "products_best_by_country": q(f"""SELECT * FROM (SELECT Country, StockCode, MIN(Description) AS Description, SUM(Quantity)::BIGINT AS total_quantity
        FROM t WHERE NOT {CANCELLED} AND Country <> 'United Kingdom' GROUP BY Country, StockCode
        QUALIFY ROW_NUMBER() OVER (PARTITION BY Country ORDER BY SUM(Quantity) DESC, StockCode) = 1)
        ORDER BY total_quantity DESC, Country LIMIT 15"""),
    "products_return_rate": q(f"""SELECT StockCode, MIN(Description) AS product_name, {BUYS} AS sold_qty, {BACKS} AS returned_qty, {RATE} AS return_rate_pct
        FROM t GROUP BY StockCode HAVING {BUYS} > 100 ORDER BY return_rate_pct DESC, StockCode LIMIT 10"""),
    "adv_rolling_3m": q("""SELECT year_month, CAST(revenue AS DOUBLE) AS revenue,
        CAST(SUM(revenue) OVER w AS DOUBLE) / COUNT(*) OVER w AS rolling_3month_avg_revenue,
        CAST(SUM(revenue) OVER w AS DOUBLE) AS rolling_3month_total_revenue
        FROM months WINDOW w AS (ORDER BY year_month ROWS BETWEEN 2 PRECEDING AND CURRENT ROW)"""),
    "adv_mom_growth": q(f"""SELECT year_month, CAST(revenue AS DOUBLE) AS revenue, CAST(p AS DOUBLE) AS prev_month_revenue,
        {pct('revenue - p', 'p')} AS mom_growth_percentage
        FROM (SELECT *, LAG(revenue) OVER (ORDER BY year_month) AS p FROM months)"""),
    "adv_purchase_gaps": q(f"""SELECT CustomerID, COUNT(gap) AS repeat_purchase_count,
        {rnd('CAST(SUM(gap) AS DOUBLE) / COUNT(gap) / 86400000000', 1)} AS avg_days_between_purchases
        FROM (SELECT CustomerID, epoch_us(InvoiceDate) - LAG(epoch_us(InvoiceDate)) OVER (PARTITION BY CustomerID ORDER BY InvoiceDate) AS gap
              FROM (SELECT DISTINCT CustomerID, Invoice, InvoiceDate FROM s))
        WHERE gap IS NOT NULL GROUP BY CustomerID ORDER BY 3, 1 LIMIT 15"""),
    "adv_country_cumulative": q(f"""SELECT Country, CAST(SUM(r) AS DOUBLE) AS total_revenue,
        CAST(SUM(SUM(r)) OVER (ORDER BY SUM(r) DESC) AS DOUBLE) AS cumulative_running_revenue,
        {pct('SUM(r)', '(SELECT SUM(r) FROM s)')} AS revenue_share_pct FROM s GROUP BY Country"""),
    "adv_top_product_per_customer": q("""SELECT * FROM (SELECT CustomerID, StockCode, MIN(Description) AS product_name, SUM(Quantity)::BIGINT AS total_quantity
        FROM s GROUP BY CustomerID, StockCode
        QUALIFY ROW_NUMBER() OVER (PARTITION BY CustomerID ORDER BY SUM(Quantity) DESC, StockCode) = 1)
        ORDER BY total_quantity DESC, CustomerID LIMIT 15"""),
    "adv_basket_sizes": q(f"""SELECT CASE WHEN u <= 5 THEN '1. Tiny (1-5 items)' WHEN u <= 15 THEN '2. Small (6-15 items)'
        WHEN u <= 50 THEN '3. Medium (16-50 items)' WHEN u <= 150 THEN '4. Large (51-150 items)' ELSE '5. Bulk (>150 items)' END AS basket_size_category,
        COUNT(*) AS invoice_count, {rnd('CAST(SUM(v) AS DOUBLE) / COUNT(v)', 2)} AS avg_basket_value
        FROM (SELECT Invoice, SUM(Quantity) AS u, SUM(r) AS v FROM tr WHERE NOT {CANCELLED} GROUP BY Invoice) GROUP BY 1"""),
    "cross_sell": q(CROSS.format(" AND CustomerID IS NOT NULL")),
    "cross_sell_strict": q(CROSS.format("").replace("'7'", "'68'")),
    "cross_sell_strict_guest": q(f"""SELECT (SELECT COUNT(*) FROM ({CROSS.format("").replace("LIMIT 15", "")})) AS strict,
        (SELECT COUNT(*) FROM ({CROSS.format(" AND CustomerID IS NOT NULL").replace("LIMIT 15", "")})) AS plain"""),
    "adv_quarterly": q("""SELECT strftime(InvoiceDate, '%Y') AS sales_year, 'Q' || quarter(InvoiceDate) AS quarter,
        CAST(SUM(r) AS DOUBLE) AS quarterly_revenue, COUNT(DISTINCT Invoice) AS order_count FROM s GROUP BY 1, 2"""),
    "v_customer_summary": q(CUSTOMER_SUMMARY),
    "v_monthly_revenue": q("""SELECT strftime(InvoiceDate, '%Y') AS sales_year, strftime(InvoiceDate, '%m') AS sales_month,
        strftime(InvoiceDate, '%Y-%m') AS year_month, CAST(SUM(r) AS DOUBLE) AS net_revenue,
        COUNT(DISTINCT Invoice) AS total_orders, COUNT(DISTINCT CustomerID) AS active_customers FROM s GROUP BY 1, 2, 3"""),
    "v_rfm_segments": q("""SELECT CustomerID, Recency, Frequency, CAST(Monetary AS DOUBLE) AS Monetary, R_Score AS r_score,
        F_Score AS f_score, M_Score AS m_score, RFM_Score AS rfm_score, Segment FROM rsg"""),
    "v_product_summary": PRODUCT_SUMMARY,
    "eda_monthly_trend": q("SELECT strftime(InvoiceDate, '%Y-%m') AS YearMonth, CAST(SUM(Revenue) AS DOUBLE) AS Revenue FROM cleaned GROUP BY 1"),
    "eda_top_countries": q("SELECT Country, CAST(SUM(Revenue) AS DOUBLE) AS Revenue FROM cleaned GROUP BY 1 ORDER BY 2 DESC, 1 LIMIT 5"),
    "kpi_net_sales": measure("net_sales"),
    "kpi_customers": measure("unique_customers"),
    "kpi_orders": measure("total_orders"),
    "kpi_aov": measure("average_order_value"),
    "kpi_frequency": measure("purchase_frequency"),
    "kpi_cac": q("SELECT 45.0::DOUBLE AS assumed_cac, COUNT(DISTINCT CustomerID) * 45.0::DOUBLE AS acquisition_spend FROM cleaned"),
    "kpi_predicted_total": q(f"SELECT {rnd('SUM(CAST(predicted_cltv AS DECIMAL(28, 6)))', 2)} AS total_predicted_cltv FROM scored"),
    "kpi_predicted_avg": q(f"SELECT {rnd('AVG(predicted_cltv)', 2)} AS avg_predicted_cltv FROM scored"),
    "kpi_ltv_cac": q(f"SELECT {rnd('AVG(predicted_cltv) / 45', 4)} AS ltv_to_cac, AVG(predicted_cltv) / 45 > 3 AS meets_target FROM scored"),
    "kpi_repeat_rate": q("""SELECT CAST(COUNT(*) FILTER (n > 1) AS DOUBLE) / COUNT(*) AS repeat_purchase_rate
        FROM (SELECT COUNT(DISTINCT Invoice) AS n FROM cleaned GROUP BY CustomerID)"""),
    "kpi_churn_rate": q(f"SELECT {CHURN} AS churn_rate"),
    "dim_date": q("""SELECT strftime(d, '%Y-%m-%d') AS Date, strftime(d, '%Y') AS Year, 'Q' || quarter(d) AS Quarter, strftime(d, '%m') AS Month
        FROM (SELECT UNNEST(generate_series(date_trunc('year', MIN(InvoiceDate)), date_trunc('year', MAX(InvoiceDate)) + INTERVAL 1 YEAR - INTERVAL 1 DAY, INTERVAL 1 DAY)) AS d FROM cleaned)"""),
    "dim_customers": q(f"SELECT c.*, Recency, RFM_Score, Segment FROM ({CUSTOMER_SUMMARY}) AS c LEFT JOIN rpg USING (CustomerID)"),
    "dim_products": PRODUCT_SUMMARY,
    "kpi_by": by_group("Country"),
    "kpi_by_segment": by_group("Segment"),
    "kpi_by_quarter": by_group("Year", "Quarter"),
    "kpi_by_product": by_group("StockCode"),
    "kpi_overview": q(f"""SELECT COUNT(*) AS total_customers, {rnd('AVG(Monetary)', 2)} AS avg_historical_spend,
        {rnd('(SELECT SUM(Monetary) FROM rpg)', 2)} AS total_historical_spend,
        (SELECT 100.0::DOUBLE - CAST(COUNT(*) FILTER (Recency > 90) AS DOUBLE) / COUNT(*) * 100 FROM rpg) AS retention_pct,
        {rnd('AVG(predicted_cltv)', 2)} AS avg_predicted_cltv FROM scored"""),
    "model_linear_rule": q(f"SELECT 'LinearRegression' AS Model, {regression('y', 'y')} FROM (SELECT {RULE} AS y FROM features WHERE {TEST_SIDE})"),
    "feature_importance_rule": q("""SELECT Feature, CASE Feature WHEN 'Frequency' THEN 5.0::DOUBLE WHEN 'Recency' THEN 2.0::DOUBLE ELSE 0.0::DOUBLE END AS Importance
        FROM (SELECT UNNEST(['Frequency', 'Monetary', 'Recency', 'Tenure', 'Product_Diversity', 'Avg_Basket_Size', 'Avg_Order_Value', 'Avg_Monthly_Spend',
            'Seasonal_Score_Q4', 'Avg_Purchase_Interval', 'Revenue_Growth', 'Is_UK']) AS Feature)"""),
    "score_batch_rule": q(f"SELECT CustomerID, {RULE} AS predicted_cltv FROM features"),
    "score_whatif_rule": q("SELECT CustomerID, CAST(2 + (Frequency + 1) * 5 + 7 AS DOUBLE) AS predicted_cltv FROM features"),
    "residuals_rule": q(f"SELECT CustomerID, {RULE} AS actual, {RULE} AS predicted, 0.0::DOUBLE AS residual FROM features WHERE {TEST_SIDE}"),
    **{
        f"model_{m}_rule": q(f"SELECT CustomerID, {STEP} AS actual, {STEP} AS predicted, 0.0::DOUBLE AS residual FROM features WHERE {TEST_SIDE}")
        for m in ("tree", "gbt", "xgb", "lgbm")
    },
    "load_best_rule": q(f"SELECT CustomerID, {RULE} AS predicted_cltv, 'LinearRegression' AS model FROM features"),
    "daily_run": q("""SELECT 'cleaning_report' AS table_name, 6::BIGINT AS row_count
        UNION ALL SELECT 'cleaned', COUNT(*) FROM lines
        UNION ALL SELECT 'segments', COUNT(*) FROM rp
        UNION ALL SELECT 'segment_summary', COUNT(DISTINCT Segment) FROM rpg
        UNION ALL SELECT 'features', COUNT(*) FROM f_rfm
        UNION ALL SELECT 'model_comparison', 6
        UNION ALL SELECT 'scored', COUNT(*) FROM f_rfm
        UNION ALL SELECT 'importance', 12
        UNION ALL SELECT 'residuals', COUNT(*) FROM f_rfm WHERE CAST('0x' || md5(CustomerID)[1:8] AS BIGINT) % 100 >= 80"""),
    "train_test_split": q("""SELECT CustomerID, CASE WHEN CAST('0x' || md5(CustomerID)[1:8] AS BIGINT) % 100 < 80 THEN 'train' ELSE 'test' END AS split
        FROM f_rfm"""),
    "metrics_regression": q(f"SELECT {regression('target_revenue', 'predicted_cltv')} FROM scored"),
    "model_comparison": q(SIMPLE_ROWS),
    "model_registry": q(f"""SELECT Model AS name, 'models/' || Model AS path, MAE, RMSE, R2, MAPE,
        FIRST_VALUE(Model) OVER (ORDER BY R2 DESC) AS best_model FROM ({SIMPLE_ROWS})"""),
    "residuals": q("""SELECT CustomerID, target_revenue AS actual, predicted_cltv AS predicted, target_revenue - predicted_cltv AS residual FROM scored"""),
    "cac_tier_threshold": q(f"""SELECT CustomerID, predicted_cltv, tiers.* FROM scored JOIN {TIER_TABLE}
        ON Tier = CASE WHEN predicted_cltv > 1200 THEN 'VIP' WHEN predicted_cltv >= 200 THEN 'Core' ELSE 'Volume' END"""),
    "cac_tier_percentile": q(f"""SELECT CustomerID, predicted_cltv, place, Tier, CAC_Cap
        FROM (SELECT CustomerID, predicted_cltv, ROW_NUMBER() OVER (ORDER BY predicted_cltv DESC, CustomerID) AS place, COUNT(*) OVER () AS n FROM scored)
        JOIN {TIER_TABLE} ON Tier = CASE WHEN place * 10 <= n THEN 'VIP' WHEN place * 2 <= n THEN 'Core' ELSE 'Volume' END"""),
    "attribution_local": attribution(),
    "segment_counts": SEGMENT_COUNTS,
    "segment_spend": q("SELECT Segment, CAST(SUM(Monetary) AS DOUBLE) AS Monetary FROM rpg GROUP BY Segment"),
    "customer_profile": q("""SELECT CustomerID, CASE WHEN Is_UK = 1 THEN 'United Kingdom (Domestic)' ELSE 'International' END AS Home_Market,
        Tenure AS Tenure_Days, scored.Frequency AS Orders, scored.Monetary AS Total_Revenue, Avg_Basket_Size,
        COALESCE(Segment, 'N/A') AS Segment, predicted_cltv FROM scored LEFT JOIN rpg USING (CustomerID)"""),
    "customer_timeline": q("""SELECT InvoiceDate, CAST(Revenue AS DOUBLE) AS Revenue, CAST(Quantity AS DOUBLE) AS Quantity, CAST(Price AS DOUBLE) AS Price
        FROM cleaned WHERE CustomerID = '7'"""),
    "cltv_traditional": q(f"""SELECT CustomerID, Avg_Order_Value, Frequency,
        {rnd(f'Avg_Order_Value * Frequency / NULLIF({CHURN}, 0) * 0.3', 4)} AS cltv FROM features"""),
    "cltv_discounted": q(f"""SELECT CustomerID, Avg_Monthly_Spend,
        {rnd('Avg_Monthly_Spend * (1.0::DOUBLE - 0.7) * (SELECT SUM(pow(0.9, m) / pow(1.1, m)) FROM range(1, 13) AS g(m))', 4)} AS cltv FROM features"""),
}
