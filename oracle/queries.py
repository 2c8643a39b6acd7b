"""Oracle SQL per query key (DuckDB). Column names and types mirror the Spark results."""

from __future__ import annotations

import datetime as dt

from oracle.pipeline import exact_avg, fact_ctes, mart_ctes, reading_ctes, safe_int, sround, staging_ctes
from oracle.raw import RAW_COLUMNS


def oracle_queries(ceiling: dt.date, first_cohort: dt.date, call_list: int) -> dict[str, str]:
    M = lambda sel: f"WITH {mart_ctes(ceiling)}\n{sel}"
    F_ = lambda sel: f"WITH {fact_ctes(ceiling)}\n{sel}"
    fc = first_cohort.isoformat()
    cal = """
      SELECT CAST(strftime(d, '%Y%m%d') AS INTEGER) AS date_key, d AS full_date,
        CAST(year(d) AS INTEGER) AS year, CAST(month(d) AS INTEGER) AS month, strftime(d, '%B') AS month_name,
        CAST(quarter(d) AS INTEGER) AS quarter, CAST(dayofweek(d) + 1 AS INTEGER) AS day_of_week,
        strftime(d, '%A') AS day_name, dayofweek(d) IN (0, 6) AS is_weekend,
        CAST(date_trunc('month', d) AS DATE) AS month_start
      FROM (SELECT CAST(unnest(generate_series(
              CAST(date_trunc('year', (SELECT min(order_date_clean) FROM fact)) AS DATE),
              CAST(date_trunc('year', (SELECT max(order_date_clean) FROM fact)) AS DATE) + INTERVAL 1 YEAR
                - INTERVAL 1 DAY, INTERVAL 1 DAY)) AS DATE) AS d)"""
    q = {
        "clean_orders": f"WITH {staging_ctes()}\nSELECT * FROM stg",
        "drop_exact_duplicates": f"WITH {staging_ctes()}\nSELECT DISTINCT * FROM raw",
        "raw_export": f"WITH {staging_ctes()}\nSELECT {', '.join(f"nullif({c}, '') AS {c}" for c in RAW_COLUMNS)}, product_name || chr(10) || '\"' || department_name || '\"' AS product_description FROM raw",
        "staging_view": f"""WITH {staging_ctes()}
          SELECT order_status_clean, market_clean, count(*) AS order_items, count(DISTINCT order_id) AS orders
          FROM stg GROUP BY order_status_clean, market_clean""",
        "date_resolution": (f"WITH {reading_ctes()}\nSELECT {safe_int('n.order_item_id')} AS order_item_id, n.order_date, n.shipping_date, "
                            "o.m AS order_date_monthfirst, o.d AS order_date_dayfirst, s.m AS shipping_date_monthfirst, "
                            "s.d AS shipping_date_dayfirst, o.sure AS order_date_forced, s.sure AS shipping_date_forced, "
                            "oc.d AS order_date_clean, sc.d AS shipping_date_clean FROM numbered n "
                            + " ".join(f"LEFT JOIN {t} {a} ON {a}.line = n.line AND {a}.side = '{k}'" for t, a, k in (
                                ("cand", "o", "o"), ("cand", "s", "s"), ("settled", "oc", "o"), ("settled", "sc", "s")))),
        "ceiling_corrections": F_("""SELECT
            count_if(s.order_date_clean IS NOT NULL AND f.order_date_clean IS DISTINCT FROM s.order_date_clean)
              AS order_dates_moved,
            count_if(s.shipping_date_clean IS NOT NULL
                     AND f.shipping_date_clean IS DISTINCT FROM s.shipping_date_clean) AS shipping_dates_moved,
            count_if(s.order_date_clean IS NOT NULL AND f.order_date_clean IS NULL) AS order_dates_nulled,
            count_if(s.shipping_date_clean IS NOT NULL AND f.shipping_date_clean IS NULL) AS shipping_dates_nulled
          FROM stg s JOIN fact f ON s.order_item_id = f.order_item_id"""),
        "fact_order_item": F_("SELECT * FROM fact"),
        "dim_customer": F_("SELECT * FROM dim_customer"),
        "dim_product": F_("SELECT * FROM dim_product"),
        "dim_date": F_(cal),
        "mart_funnel": M("SELECT * FROM mart_funnel"),
        "funnel_counts": M("""SELECT
            count(DISTINCT CASE WHEN is_placed THEN order_id END) AS orders_placed,
            count(DISTINCT CASE WHEN is_shipped THEN order_id END) AS orders_shipped,
            count(DISTINCT CASE WHEN is_delivered THEN order_id END) AS orders_delivered,
            count(DISTINCT CASE WHEN is_delivered_on_time THEN order_id END) AS orders_delivered_on_time
          FROM mart_funnel"""),
        "late_rate_by_mode": M(f"""SELECT shipping_mode, count(*) AS total_rows,
            CAST(sum(late_delivery_risk) AS BIGINT) AS late_count,
            {sround('sum(late_delivery_risk) / count(*) * 100', 2)} AS late_rate_pct
          FROM mart_funnel WHERE shipping_mode IS NOT NULL AND late_delivery_risk IS NOT NULL
          GROUP BY shipping_mode"""),
        "late_rate_by_region": M(f"""SELECT order_region, count(*) AS total_rows,
            CAST(sum(late_delivery_risk) AS BIGINT) AS late_count,
            {sround('sum(late_delivery_risk) / count(*) * 100', 2)} AS late_rate_pct
          FROM mart_funnel WHERE order_region IS NOT NULL AND late_delivery_risk IS NOT NULL
          GROUP BY order_region"""),
        "kpi_late_rate": M(f"""SELECT count(*) AS total_rows, CAST(sum(late_delivery_risk) AS BIGINT) AS late_count,
            {sround('avg(CAST(late_delivery_risk AS DOUBLE)) * 100', 2)} AS late_rate_pct
          FROM mart_funnel WHERE late_delivery_risk IS NOT NULL"""),
        "mart_cohort": M("SELECT * FROM mart_cohort"),
        "cohort_curve": M(f"SELECT * FROM mart_cohort WHERE cohort_month = DATE '{fc}'"),
        "kpi_retention": M(f"""SELECT {sround(exact_avg('CASE WHEN month_index >= 1 THEN retention_pct END'), 2)}
              AS retention_kpi_pct,
            {sround(exact_avg('CASE WHEN month_index = 1 THEN retention_pct END'), 2)} AS month1_retention_pct,
            count(CASE WHEN month_index >= 1 THEN 1 END) AS cells
          FROM mart_cohort"""),
        "rfm_base": M("SELECT customer_id, recency_days, frequency, monetary, avg_delivery_delay FROM rfm_base"),
        "mart_churn_rfm": M("SELECT * FROM mart_churn_rfm"),
        "segment_summary": M(f"""SELECT segment, count(*) AS customer_count,
            {sround(exact_avg('monetary'), 2)} AS avg_monetary FROM mart_churn_rfm GROUP BY segment"""),
        "segment_churn_crosstab": M("SELECT segment, is_churned, count(*) AS cnt FROM mart_churn_rfm GROUP BY segment, is_churned"),
        "kpi_at_risk_pct": M(f"""SELECT count(CASE WHEN segment IN ('At Risk', 'Lapsed') THEN 1 END) AS at_risk_accounts,
            count(*) AS total_accounts,
            {sround("avg(CASE WHEN segment IN ('At Risk', 'Lapsed') THEN 1.0 ELSE 0.0 END) * 100", 2)} AS at_risk_pct
          FROM mart_churn_rfm"""),
        "risk_call_list": M(f"""SELECT customer_id, segment, monetary, recency_days, frequency, rfm_score
          FROM mart_churn_rfm WHERE segment IN ('At Risk', 'Lapsed')
          ORDER BY monetary DESC NULLS LAST, customer_id ASC LIMIT {call_list}"""),
        "risk_table_with_total": M(f"""SELECT segment, count(*) AS accounts, {sround(exact_avg('monetary'), 2)} AS avg_monetary
            FROM mart_churn_rfm GROUP BY segment
          UNION ALL SELECT 'Total', count(*), {sround(exact_avg('monetary'), 2)} FROM mart_churn_rfm"""),
        "dominant_region": M("SELECT * FROM dominant_region"),
        "dominant_market": M("SELECT * FROM dominant_market"),
        "ltv_base": M("SELECT * FROM ltv"),
        "mart_ltv": M("SELECT * FROM mart_ltv"),
        "ltv_by_segment": M(f"""SELECT customer_segment, count(*) AS customer_count,
            {sround(exact_avg('historical_ltv'), 2)} AS avg_historical_ltv,
            {sround(exact_avg('formula_based_ltv'), 2)} AS avg_formula_ltv
          FROM mart_ltv GROUP BY customer_segment"""),
        "ltv_by_region": M(f"""SELECT dominant_region, count(*) AS customer_count,
            {sround(exact_avg('historical_ltv'), 2)} AS avg_historical_ltv FROM mart_ltv GROUP BY dominant_region"""),
        "ltv_formula_check": M(f"""SELECT {sround('corr(historical_ltv, formula_based_ltv)', 4)} AS correlation,
            count(CASE WHEN abs(historical_ltv - formula_based_ltv) > 1 THEN 1 END) AS mismatch_count FROM mart_ltv"""),
        "ltv_by_engagement": M(f"""SELECT r.segment, count(*) AS customer_count,
            {sround(exact_avg('l.historical_ltv'), 2)} AS avg_historical_ltv
          FROM mart_ltv l JOIN mart_churn_rfm r ON l.customer_id = r.customer_id GROUP BY r.segment"""),
        "retention_rate": M("""SELECT cohort_month, month_index, sum(CAST(retention_pct AS DECIMAL(28, 2)))::DOUBLE / 100 AS retention_rate
          FROM mart_cohort GROUP BY cohort_month, month_index"""),
        "ntile_global": """SELECT c_custkey, c_acctbal, c_mktsegment,
            CAST(ntile(7) OVER (ORDER BY c_mktsegment NULLS FIRST, c_acctbal DESC NULLS LAST, c_custkey) AS INTEGER) AS tile FROM customer""",
        "slice_by_segment": M("SELECT * FROM mart_ltv WHERE customer_segment = 'Corporate'"),
        "slice_mart": M("""SELECT * FROM mart_funnel
          WHERE order_date_clean BETWEEN DATE '1998-01-01' AND DATE '1998-12-31' AND market IN ('Europe', 'LATAM')"""),
    }
    stages = ("orders_placed", "orders_shipped", "orders_delivered", "orders_delivered_on_time")
    rows = []
    for i, n in enumerate(stages):
        prev = stages[i - 1] if i else n
        rows.append(f"""SELECT {i + 1} AS stage_order, '{n}' AS stage, {n} AS orders,
            {sround(f'{n} * 100.0 / nullif({prev}, 0)', 2)} AS pct_of_previous,
            {sround(f'{n} * 100.0 / nullif(orders_placed, 0)', 2)} AS pct_of_placed FROM counts""")
    counts_sel = """SELECT
            count(DISTINCT CASE WHEN is_placed THEN order_id END) AS orders_placed,
            count(DISTINCT CASE WHEN is_shipped THEN order_id END) AS orders_shipped,
            count(DISTINCT CASE WHEN is_delivered THEN order_id END) AS orders_delivered,
            count(DISTINCT CASE WHEN is_delivered_on_time THEN order_id END) AS orders_delivered_on_time
          FROM mart_funnel"""
    q["funnel_conversion"] = f"WITH {mart_ctes(ceiling)},\ncounts AS ({counts_sel})\n" + "\nUNION ALL\n".join(rows)
    # a cohort's months up to the one before the ceiling: one column each, from the first cohort on
    idx = range((ceiling.year - first_cohort.year) * 12 + ceiling.month - first_cohort.month)
    cols = ", ".join(f"max(CASE WHEN month_index = {i} THEN retention_pct END) AS m{i}" for i in idx)
    q["cohort_matrix"] = M(f"SELECT cohort_month, {cols} FROM mart_cohort GROUP BY cohort_month")
    from oracle.quality import quality_queries

    q.update(quality_queries(ceiling))
    return q
