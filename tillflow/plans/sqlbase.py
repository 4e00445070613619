"""DuckDB SQL for the same layers, used as the independent oracle.

``with_layers("purchases", ...)`` returns a ``WITH`` clause holding the named
layers and everything they depend on; queries append their own SELECT.
The SQL restates the fixture mapping and the Silver/Gold rules on the driver
tables; it shares no code path with the Spark plans.
"""

from __future__ import annotations

_LAYERS: dict[str, tuple[str, tuple[str, ...]]] = {
    "tx": ("""
SELECT CASE WHEN l.l_returnflag = 'R' THEN 'C' ELSE '' END || CAST(l.l_orderkey AS VARCHAR) AS InvoiceNo,
       CAST(l.l_partkey AS VARCHAR) || CASE WHEN l.l_partkey % 10 = 0 THEN 'A' ELSE '' END AS StockCode,
       CASE WHEN l.l_partkey % 50 = 0 THEN NULL ELSE p.p_name END AS Description,
       CAST(trunc(l.l_quantity) AS INTEGER) * CASE WHEN l.l_returnflag = 'R' THEN -1 ELSE 1 END AS Quantity,
       CAST(o.o_orderdate + to_hours(CAST(o.o_orderkey % 24 AS INTEGER)) AS TIMESTAMP) AS InvoiceDate,
       CASE WHEN l.l_partkey % 97 = 0 THEN 0.0 ELSE p.p_retailprice END AS UnitPrice,
       CASE WHEN o.o_orderkey % 5 = 0 THEN NULL ELSE o.o_custkey END AS CustomerID,
       n.n_name AS Country,
       l.l_orderkey * 8 + l.l_linenumber AS feed_position
FROM lineitem l
JOIN orders o ON l.l_orderkey = o.o_orderkey
JOIN part p ON l.l_partkey = p.p_partkey
JOIN customer c ON o.o_custkey = c.c_custkey
JOIN nation n ON c.c_nationkey = n.n_nationkey""", ()),
    "msg": ("""
SELECT strftime(InvoiceDate, '%Y-%m-%dT%H:%M:%S') AS "timestamp",
       CAST(CustomerID AS BIGINT) AS kullanici_ID,
       CASE WHEN starts_with(InvoiceNo, 'C') THEN 'cancellation' ELSE 'purchase' END AS olay_tipi,
       InvoiceNo AS ilgili_ID, StockCode AS stock_code, Description AS description,
       Quantity AS quantity, UnitPrice AS unit_price, Country AS country,
       strftime(InvoiceDate, '%Y-%m-%dT%H:%M:%S') AS invoice_date, feed_position
FROM tx""", ("tx",)),
    "bronze": ("""
SELECT 'online-retail-transactions' AS kafka_topic,
       CAST(coalesce(kullanici_ID, 0) % 3 AS INTEGER) AS kafka_partition,
       CAST(feed_position AS BIGINT) AS kafka_offset,
       CAST(invoice_date AS TIMESTAMP) AS kafka_timestamp,
       "timestamp", kullanici_ID, olay_tipi, ilgili_ID, stock_code, description, quantity,
       unit_price, country, invoice_date,
       CAST(invoice_date AS TIMESTAMP) AS ingestion_time
FROM msg""", ("msg",)),
    "typed": ("""
SELECT kafka_topic, kafka_partition, kafka_offset, kafka_timestamp,
       TRY_CAST("timestamp" AS TIMESTAMP) AS "timestamp", kullanici_ID, olay_tipi, ilgili_ID,
       stock_code, description, quantity, unit_price, country,
       TRY_CAST(invoice_date AS TIMESTAMP) AS invoice_date, ingestion_time,
       quantity * unit_price AS total_price, olay_tipi = 'cancellation' AS is_cancellation
FROM bronze""", ("bronze",)),
    "clean": ("""
SELECT * EXCLUDE (_rn) FROM (
  SELECT *, row_number() OVER (
      PARTITION BY ilgili_ID, stock_code, kullanici_ID, invoice_date, quantity
      ORDER BY kafka_timestamp NULLS FIRST, kafka_partition NULLS FIRST, kafka_offset NULLS FIRST,
               kafka_topic NULLS FIRST, "timestamp" NULLS FIRST, olay_tipi NULLS FIRST) AS _rn
  FROM typed WHERE kullanici_ID IS NOT NULL AND description IS NOT NULL)
WHERE _rn = 1""", ("typed",)),
    "purchases": ("SELECT * FROM clean WHERE NOT is_cancellation AND quantity > 0 AND unit_price > 0", ("clean",)),
    "cancellations": ("SELECT * FROM clean WHERE is_cancellation", ("clean",)),
    "split": ("""
SELECT min_date, max_date, total_days,
       CAST(date_trunc('second', min_date + to_days(CAST(floor(total_days * 0.75) AS INTEGER))) AS TIMESTAMP) AS split_at
FROM (SELECT min_date, max_date,
             CAST(floor((epoch_us(max_date) - epoch_us(min_date)) / 86400000000) AS BIGINT) AS total_days
      FROM (SELECT min(invoice_date) AS min_date, max(invoice_date) AS max_date FROM purchases))""",
              ("purchases",)),
    "feat": ("SELECT * FROM purchases WHERE invoice_date < (SELECT split_at FROM split)", ("purchases", "split")),
    "targ": ("SELECT * FROM purchases WHERE invoice_date >= (SELECT split_at FROM split)", ("purchases", "split")),
    "canc_feat": ("SELECT * FROM cancellations WHERE invoice_date < (SELECT split_at FROM split)",
                  ("cancellations", "split")),
    "g_rfm": ("""
SELECT kullanici_ID,
       CAST(date_diff('day', CAST(max(invoice_date) AS DATE), CAST((SELECT split_at FROM split) AS DATE)) AS INTEGER) AS recency_days,
       count(DISTINCT ilgili_ID) AS frequency, sum(total_price) AS monetary
FROM feat GROUP BY kullanici_ID""", ("feat", "split")),
    "g_basket": ("""
SELECT kullanici_ID, sum(basket_total) / nullif(count(DISTINCT ilgili_ID), 0) AS avg_basket_value
FROM (SELECT kullanici_ID, ilgili_ID, sum(total_price) AS basket_total FROM feat GROUP BY kullanici_ID, ilgili_ID)
GROUP BY kullanici_ID""", ("feat",)),
    "g_gap": ("""
SELECT kullanici_ID,
       CASE WHEN n > 1 THEN date_diff('day', CAST(first_purchase AS DATE), CAST(last_purchase AS DATE)) / (n - 1)
            ELSE 0.0 END AS avg_days_between_purchases
FROM (SELECT kullanici_ID, min(invoice_date) AS first_purchase, max(invoice_date) AS last_purchase,
             count(DISTINCT ilgili_ID) AS n FROM feat GROUP BY kullanici_ID)""", ("feat",)),
    "g_products": ("SELECT kullanici_ID, count(DISTINCT stock_code) AS unique_products FROM feat GROUP BY kullanici_ID",
                   ("feat",)),
    "g_canc": ("SELECT kullanici_ID, count(DISTINCT ilgili_ID) AS cancellation_count FROM canc_feat GROUP BY kullanici_ID",
               ("canc_feat",)),
    "g_months": ("""
SELECT kullanici_ID, count(DISTINCT strftime(invoice_date, '%Y-%m')) AS active_months FROM feat GROUP BY kullanici_ID""",
                 ("feat",)),
    "g_hour": ("""
SELECT kullanici_ID, most_active_hour FROM (
  SELECT kullanici_ID, h AS most_active_hour,
         row_number() OVER (PARTITION BY kullanici_ID ORDER BY n DESC, h ASC) AS rk
  FROM (SELECT kullanici_ID, CAST(hour(invoice_date) AS INTEGER) AS h, count(*) AS n FROM feat GROUP BY 1, 2))
WHERE rk = 1""", ("feat",)),
    "g_country": ("""
SELECT kullanici_ID, country FROM (
  SELECT kullanici_ID, country, row_number() OVER (PARTITION BY kullanici_ID ORDER BY n DESC, country ASC) AS rk
  FROM (SELECT kullanici_ID, country, count(*) AS n FROM feat GROUP BY 1, 2))
WHERE rk = 1""", ("feat",)),
    "g_target": ("SELECT kullanici_ID, sum(total_price) AS future_spending FROM targ GROUP BY kullanici_ID", ("targ",)),
    "gold": ("""
SELECT r.kullanici_ID, r.recency_days, r.frequency, r.monetary, b.avg_basket_value,
       g.avg_days_between_purchases, p.unique_products, coalesce(c.cancellation_count, 0) AS cancellation_count,
       m.active_months, h.most_active_hour, co.country, t.future_spending
FROM g_rfm r
LEFT JOIN g_basket b USING (kullanici_ID)
LEFT JOIN g_gap g USING (kullanici_ID)
LEFT JOIN g_products p USING (kullanici_ID)
LEFT JOIN g_canc c USING (kullanici_ID)
LEFT JOIN g_months m USING (kullanici_ID)
LEFT JOIN g_hour h USING (kullanici_ID)
LEFT JOIN g_country co USING (kullanici_ID)
JOIN g_target t USING (kullanici_ID)""",
             ("g_rfm", "g_basket", "g_gap", "g_products", "g_canc", "g_months", "g_hour", "g_country", "g_target")),
}


def register(name: str, sql: str, deps: tuple[str, ...] = ()) -> None:
    """Add a named layer other modules can build on."""
    _LAYERS[name] = (sql, deps)


def _order(names) -> list[str]:
    seen: list[str] = []

    def visit(n: str) -> None:
        if n in seen:
            return
        for d in _LAYERS[n][1]:
            visit(d)
        seen.append(n)

    for n in names:
        visit(n)
    return seen


def with_layers(*names: str) -> str:
    parts = [f"{n} AS ({_LAYERS[n][0].strip()})" for n in _order(names)]
    return "WITH " + ",\n".join(parts) + "\n"


def q(body: str, *layers: str) -> str:
    """Full oracle statement: the needed layers plus ``body``."""
    return with_layers(*layers) + body.strip()
