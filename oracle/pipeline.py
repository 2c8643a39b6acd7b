"""DuckDB SQL of the cleaning rules, the star schema and the marts, as the check of the Spark plans.

Written from the rules, in another relational shape than the plans: lines are numbered, every possible reading
of a date is a row with a priority, spellings are looked up in one vocabulary table, one line per
key is the minimum of a sort key, cohorts come from distinct customer months, tiles from rank
arithmetic, customer totals from order totals.
"""

from __future__ import annotations

import datetime as dt

from oracle.raw import RAW_COLUMNS, raw_order_lines_sql

IDS = ("order_item_id", "order_id", "customer_id", "order_customer_id", "product_card_id", "order_item_cardprod_id")
MONEY = ("sales", "order_item_total", "order_item_product_price", "order_item_discount",
         "order_profit_per_order", "benefit_per_order", "sales_per_customer")

# Date formats that are read the same way by both conventions, and the two that differ.
BOTH = ((0, "%Y-%m-%d %H:%M:%S"), (3, "%d-%b-%y"), (4, "%B %d, %Y"), (5, "%Y/%m/%d"))
SLASHED = {"m": ((1, "%m/%d/%Y %H:%M"), (2, "%m/%d/%Y")), "d": ((1, "%d/%m/%Y %H:%M"), (2, "%d/%m/%Y"))}
# Fixed values: (kind, text looked for, canonical value), in order of precedence within a kind.
VOCABULARY = (
    ("mode", "STANDARD", "Standard Class"), ("mode", "FIRST", "First Class"), ("mode", "2ND", "Second Class"),
    ("mode", "SECOND", "Second Class"), ("mode", "SAME", "Same Day"),
    ("segment", "CONSUMER", "Consumer"), ("segment", "CORPORATE", "Corporate"), ("segment", "HOME OFFICE", "Home Office"),
    *(("delivery", v.upper(), v) for v in ("Advance shipping", "Late delivery", "Shipping canceled", "Shipping on time")),
    *(("risk", v, "1") for v in ("1", "TRUE", "YES", "Y")), *(("risk", v, "0") for v in ("0", "FALSE", "NO", "N")),
    *(("region", v.upper(), v) for v in (
        "Southeast Asia", "South Asia", "Oceania", "Eastern Asia", "West Asia", "West Africa", "Central Africa",
        "North Africa", "Western Europe", "Northern Europe", "Southern Europe", "Eastern Europe", "Caribbean",
        "South America", "Central America", "North America")),
    *(("market", v.upper(), v) for v in ("USCA", "LATAM", "Pacific Asia", "Europe", "Africa")),
    *(("country", spelling, country) for country, spellings in (
        ("United States", ("USA", "US", "U.S.A.", "UNITED STATES")), ("Vietnam", ("VN", "VIETNAM", "VIET NAM")),
        ("Ireland", ("IE", "IRELAND", "REP. OF IRELAND")), ("Germany", ("DE", "GERMANY", "DEUTSCHLAND")),
        ("Mexico", ("MX", "MEXICO", "MÉXICO")), ("Brazil", ("BR", "BRAZIL", "BRASIL")), ("Australia", ("AU", "AUSTRALIA")),
    ) for spelling in spellings),
    *((kind, v, None) for kind in ("status", "state") for v in ("N/A", "NULL", "NONE", "-", "??", "")),
    ("status", "CANCELLED", "CANCELED"),
)


def utrim(x: str) -> str:
    return f"regexp_replace({x}, '^\\s+|\\s+$', '', 'g')"


def strip_junk(x: str) -> str:
    r = x
    for s in ("'&nbsp;'", "'<br>'", "'###'", "'N/A - check later'", "chr(9)", "chr(8203)"):
        r = f"replace({r}, {s}, ' ')"
    return utrim(r)


def safe_int(x: str) -> str:
    return f"(CASE WHEN regexp_full_match({x}, '[+-]?[0-9]+') THEN TRY_CAST({x} AS BIGINT) END)"


def safe_double(x: str) -> str:
    return (f"(CASE WHEN regexp_full_match({x}, '[+-]?([0-9]+[.]?[0-9]*|[.][0-9]+)([eE][+-]?[0-9]+)?') "
            f"THEN TRY_CAST({x} AS DOUBLE) END)")


def sround(x: str, n: int) -> str:
    """ROUND half away from zero on the shortest decimal text of the double (as Spark)."""
    return f"CAST(round(CAST(CAST(({x}) AS VARCHAR) AS DECIMAL(38, 18)), {n}) AS DOUBLE)"


def exact_avg(x: str) -> str:
    """Mean of cents, summed as decimal and divided once."""
    return f"(sum(CAST({x} AS DECIMAL(28, 2)))::DOUBLE / nullif(count({x}), 0))"


def money(x: str) -> str:
    """A leading dollar sign means that commas group digits, else a comma is the decimal point; what is no number is NULL."""
    t = utrim(x)
    digits = f"translate({t}, CASE WHEN {x} LIKE '$%' THEN '$,' ELSE ',' END, CASE WHEN {x} LIKE '$%' THEN '' ELSE '.' END)"
    return safe_double(digits)


def looked_up(kind: str, text: str, part: bool = False) -> str:
    """The canonical value of ``text`` in upper case: of the first vocabulary entry that equals it (``part``: that it holds)."""
    match = f"contains(upper({text}), v.probe)" if part else f"upper({text}) = v.probe"
    return f"(SELECT arg_min(v.value, v.place) FROM vocabulary v WHERE v.kind = '{kind}' AND {match})"


def open_value(kind: str, text: str) -> str:
    """``text`` in upper case unless the vocabulary has it, as a synonym or (without a value) as a spelling of nothing."""
    there = f"(SELECT count(*) FROM vocabulary v WHERE v.kind = '{kind}' AND upper({text}) = v.probe)"
    return f"CASE WHEN {there} = 0 THEN upper({text}) ELSE {looked_up(kind, text)} END"


def _quoted(v) -> str:
    return "NULL" if v is None else "'" + v.replace("'", "''") + "'"


def reading_ctes(ids: str = "numbered") -> str:
    """CTEs numbered (a line number for each raw line) -> cand (readings per line and side) -> settled (the chosen date)."""
    rows = []
    for side, col in (("o", "order_date"), ("s", "shipping_date")):
        for conv in "md":
            for place, fmt in sorted(BOTH + SLASHED[conv]):
                rows.append(f"SELECT line, '{side}' AS side, '{conv}' AS conv, {place} AS place, "
                            f"CAST(try_strptime({utrim(col)}, '{fmt}') AS DATE) AS d FROM numbered")
    in_order = lambda a, b: f"CASE own.side WHEN 'o' THEN {a} <= {b} ELSE {a} >= {b} END"
    options = [("own.sure", "TRUE"), ("own.m", in_order("own.m", "other.sure")), ("own.d", in_order("own.d", "other.sure")),
               ("own.m", in_order("own.m", "other.m")), ("own.d", in_order("own.d", "other.d")), ("own.m", "TRUE")]
    choice = "\n  UNION ALL ".join(
        f"SELECT own.line, own.side, {i} AS place, {d} AS d FROM cand own LEFT JOIN cand other ON own.line = other.line "
        f"AND own.side <> other.side WHERE {cond}" for i, (d, cond) in enumerate(options))
    return f"""
raw AS MATERIALIZED ({raw_order_lines_sql()}),
numbered AS MATERIALIZED (SELECT row_number() OVER () AS line, * FROM raw),
readings AS (
  {chr(10).join(('UNION ALL ' if i else '') + r for i, r in enumerate(rows))}),
first_reading AS (SELECT line, side, conv, arg_min(d, place) AS d FROM readings WHERE d IS NOT NULL GROUP BY line, side, conv),
cand AS MATERIALIZED (
  SELECT line, side, max(d) FILTER (conv = 'm') AS m, max(d) FILTER (conv = 'd') AS d,
    CASE WHEN count(DISTINCT d) = 1 THEN max(d) END AS sure
  FROM first_reading GROUP BY line, side),
options AS ({choice}),
settled AS (SELECT line, side, arg_min(d, place) AS d FROM options WHERE d IS NOT NULL GROUP BY line, side)"""


def staging_ctes() -> str:
    """CTEs raw -> stg (final staging table)."""
    others = [c for c in RAW_COLUMNS if c != "order_item_id"]
    typed = ", ".join(f"{safe_int(f'n.{c}')} AS {c}" if c in IDS else f"n.{c}" for c in RAW_COLUMNS)
    # a sort key as text: NULL before all else; ids in the order of their numbers
    shown = [f"lpad(CAST({safe_int(f'n.{c}')} AS VARCHAR), 20, '0')" if c in IDS else f"n.{c}" for c in others]
    tie = ", ".join(f"coalesce('1' || {c}, '0')" for c in shown)
    missing = lambda pairs: ",\n    ".join(f"{c}_clean IS NULL AS is_{flag}_missing" for flag, c in pairs)
    words = ", ".join(f"('{k}', {_quoted(p)}, {_quoted(v)}, {i})" for i, (k, p, v) in enumerate(VOCABULARY))
    return f"""{reading_ctes()},
vocabulary(kind, probe, value, place) AS (VALUES {words}),
dated AS (
  SELECT n.line, {typed}, o.d AS order_date_clean, s.d AS shipping_date_clean,
    n.order_item_id IS NOT NULL AND {safe_int('n.order_item_id')} IS NULL AS is_order_item_id_invalid,
    coalesce(CAST({safe_int('n.order_item_id')} AS VARCHAR), '?' || n.order_item_id, '') AS line_key,
    [coalesce('0' || strftime(o.d, '%Y%m%d'), '1'), {tie}] AS sort_key
  FROM numbered n LEFT JOIN settled o ON o.line = n.line AND o.side = 'o' LEFT JOIN settled s ON s.line = n.line AND s.side = 's'),
kept AS (SELECT arg_min(line, sort_key) AS line FROM dated GROUP BY line_key),
cleaned AS (
  SELECT d.* EXCLUDE (line, line_key, sort_key),
    {looked_up('mode', strip_junk('d.shipping_mode'), part=True)} AS shipping_mode_clean,
    {open_value('status', utrim('d.order_status'))} AS order_status_clean,
    {looked_up('delivery', utrim('d.delivery_status'))} AS delivery_status_clean,
    CAST({looked_up('risk', utrim('d.late_delivery_risk'))} AS INTEGER) AS late_delivery_risk_clean,
    {safe_int('d.real_shipping_days')} AS real_shipping_days_clean,
    {safe_int('d.scheduled_days_for_shipment')} AS scheduled_days_for_shipment_clean,
    {", ".join(f"{money(f'd.{c}')} AS {c}_clean" for c in MONEY)},
    {safe_double('d.order_item_discount_rate')} AS order_item_discount_rate_clean,
    {safe_double('d.order_item_profit_ratio')} AS order_item_profit_ratio_clean,
    {safe_int('d.order_item_quantity')} AS order_item_quantity_clean,
    {looked_up('segment', strip_junk('d.customer_segment'), part=True)} AS customer_segment_clean,
    {looked_up('region', strip_junk('d.order_region'))} AS order_region_clean,
    {looked_up('market', strip_junk('d.market'))} AS market_clean,
    {looked_up('country', utrim('d.order_country'))} AS order_country_clean,
    {open_value('state', utrim('d.order_state'))} AS order_state_clean
  FROM dated d SEMI JOIN kept USING (line)),
stg AS (
  SELECT *,
    {missing((('order_date', 'order_date'), ('shipping_date', 'shipping_date'), ('shipping_mode', 'shipping_mode'),
              ('order_status', 'order_status'), ('delivery_status', 'delivery_status'), ('late_risk', 'late_delivery_risk'),
              ('real_days', 'real_shipping_days'), ('scheduled_days', 'scheduled_days_for_shipment'), ('sales', 'sales'),
              ('order_item_total', 'order_item_total'), ('product_price', 'order_item_product_price'), ('discount', 'order_item_discount'),
              ('profit_per_order', 'order_profit_per_order'), ('benefit_per_order', 'benefit_per_order'),
              ('sales_per_customer', 'sales_per_customer'), ('discount_rate', 'order_item_discount_rate'),
              ('profit_ratio', 'order_item_profit_ratio'), ('quantity', 'order_item_quantity'), ('segment', 'customer_segment'),
              ('region', 'order_region'), ('market', 'market'), ('country', 'order_country'), ('state', 'order_state')))},
    coalesce(shipping_date_clean < order_date_clean, FALSE) AS is_ship_before_order_flag,
    coalesce(order_item_quantity_clean <= 0, FALSE) AS is_quantity_invalid
  FROM cleaned)"""


def _fix(c: str, ceiling: dt.date) -> str:
    """A date past the ceiling is its day/month swap if there is one, else nothing."""
    swapped = f"try_strptime(strftime({c}, '%Y-%d-%m'), '%Y-%m-%d')::DATE"
    return f"if({c} > DATE '{ceiling.isoformat()}', {swapped}, {c})"


def _key(c: str) -> str:
    return f"CAST(year({c}) * 10000 + month({c}) * 100 + day({c}) AS INTEGER)"


# The fact's columns that are cleaned staging columns, and the flags that it carries.
FACT_CLEAN = ("order_status", "delivery_status", "shipping_mode", "order_region", "order_state", "order_country", "market",
              "real_shipping_days", "scheduled_days_for_shipment", "late_delivery_risk", "sales", "order_item_total",
              "order_item_product_price", "order_item_discount", "order_item_discount_rate", "order_profit_per_order",
              "benefit_per_order", "order_item_profit_ratio", "sales_per_customer", "order_item_quantity")
FACT_FLAGS = ("shipping_mode", "order_status", "delivery_status", "late_risk", "real_days", "scheduled_days", "sales",
              "order_item_total", "product_price", "discount", "profit_per_order", "benefit_per_order", "sales_per_customer",
              "discount_rate", "profit_ratio", "quantity", "segment", "region", "market", "country", "state")


def fact_ctes(ceiling: dt.date) -> str:
    per_key = lambda key, cols: ", ".join(f"min({c}) AS {n}" for n, c in cols)
    people = [(c, c) for c in ("customer_fname", "customer_lname", "customer_city", "customer_state", "customer_country")]
    things = [("category_id", safe_int("category_id")), ("category_name", "category_name"), ("department_id", safe_int("department_id"))]
    things += [(c, c) for c in ("department_name", "product_name", "product_price", "product_status")]
    return f"""{staging_ctes()},
fixed AS (SELECT * REPLACE ({_fix('order_date_clean', ceiling)} AS order_date_clean,
                            {_fix('shipping_date_clean', ceiling)} AS shipping_date_clean) FROM stg),
fact AS (
  SELECT order_item_id, order_id, customer_id, product_card_id,
    {_key('order_date_clean')} AS order_date_key, {_key('shipping_date_clean')} AS shipping_date_key,
    order_date_clean, shipping_date_clean, {", ".join(f"{c}_clean AS {c}" for c in FACT_CLEAN)},
    order_date_clean IS NULL AS is_order_date_missing, shipping_date_clean IS NULL AS is_shipping_date_missing,
    coalesce(shipping_date_clean < order_date_clean, FALSE) AS is_ship_before_order_flag,
    {", ".join(f"is_{f}_missing" for f in FACT_FLAGS)}, is_quantity_invalid
  FROM fixed),
segment_seen AS (SELECT customer_id, customer_segment_clean AS seg, max(order_date_clean) AS last FROM stg
  WHERE customer_segment_clean IS NOT NULL GROUP BY ALL),
segment_now AS (SELECT customer_id, arg_max(seg, {{'a': coalesce(last, DATE '0001-01-01'), 'b': seg}}) AS customer_segment
  FROM segment_seen GROUP BY customer_id),
dim_customer AS (
  SELECT p.*, s.customer_segment FROM (SELECT customer_id, {per_key('customer_id', people)} FROM stg GROUP BY customer_id) p
  LEFT JOIN segment_now s ON p.customer_id IS NOT DISTINCT FROM s.customer_id),
dim_product AS (SELECT product_card_id, {per_key('product_card_id', things)} FROM stg GROUP BY product_card_id)"""


def _tile(n_tiles: int, order: str) -> str:
    """Tile of a 0-based rank r among n rows: the first n % k tiles have one row more."""
    r, n = f"(row_number() OVER (ORDER BY {order}) - 1)", "(count(*) OVER ())"
    large = f"(({n} % {n_tiles}) * ({n} // {n_tiles} + 1))"
    return (f"CAST(1 + CASE WHEN {r} < {large} THEN {r} // ({n} // {n_tiles} + 1) "
            f"ELSE {n} % {n_tiles} + ({r} - {large}) // greatest({n} // {n_tiles}, 1) END AS INTEGER)")


def _dominant(column: str, out: str) -> str:
    """Per customer the value with the most orders, of these the one seen last, of these the smallest."""
    return f"""{out}_seen AS (SELECT customer_id, {column} AS v, count(DISTINCT order_id) AS orders, max(order_date_clean) AS last
  FROM fact WHERE {column} IS NOT NULL AND order_date_clean IS NOT NULL GROUP BY ALL),
{out}_top AS (SELECT customer_id, max({{'n': orders, 'd': last}}) AS best FROM {out}_seen GROUP BY customer_id),
{out} AS (SELECT s.customer_id, min(s.v) AS {out} FROM {out}_seen s JOIN {out}_top t
  ON s.customer_id IS NOT DISTINCT FROM t.customer_id AND s.orders = t.best.n AND s.last = t.best.d GROUP BY s.customer_id)"""


def mart_ctes(ceiling: dt.date) -> str:
    snap = f"DATE '{ceiling.isoformat()}'"
    months = lambda a, b: f"((year({b}) - year({a})) * 12 + month({b}) - month({a}))"
    return f"""{fact_ctes(ceiling)},
progress(order_status, shipped, delivered) AS (VALUES ('CANCELED', FALSE, FALSE), ('SUSPECTED_FRAUD', FALSE, FALSE),
  ('COMPLETE', TRUE, TRUE), ('CLOSED', TRUE, TRUE)),
mart_funnel AS (
  SELECT f.order_item_id, f.order_id, f.customer_id, f.order_status, f.delivery_status, f.shipping_mode, f.order_region,
    f.order_country, f.market, f.late_delivery_risk, f.real_shipping_days, f.scheduled_days_for_shipment, f.order_date_clean,
    CAST(year(f.order_date_clean) AS INTEGER) AS order_year, CAST(month(f.order_date_clean) AS INTEGER) AS order_month,
    monthname(f.order_date_clean) AS order_month_name, TRUE AS is_placed, coalesce(p.shipped, TRUE) AS is_shipped,
    coalesce(p.delivered, FALSE) AS is_delivered,
    coalesce(p.delivered AND f.late_delivery_risk = 0, FALSE) AS is_delivered_on_time
  FROM fact f LEFT JOIN progress p ON f.order_status = p.order_status WHERE f.order_status IS NOT NULL),
customer_month AS (SELECT DISTINCT customer_id, CAST(date_trunc('month', order_date_clean) AS DATE) AS active FROM fact
  WHERE order_date_clean IS NOT NULL),
customer_start AS (SELECT customer_id, min(active) AS cohort_month FROM customer_month GROUP BY customer_id),
cell AS (
  SELECT s.cohort_month, CAST({months('s.cohort_month', 'm.active')} AS INTEGER) AS month_index, count(m.customer_id) AS active_customers
  FROM customer_month m JOIN customer_start s ON m.customer_id IS NOT DISTINCT FROM s.customer_id GROUP BY ALL),
mart_cohort AS (
  SELECT c.cohort_month, c.month_index, c.active_customers, z.active_customers AS cohort_size,
    {sround('c.active_customers / nullif(z.active_customers, 0) * 100', 2)} AS retention_pct
  FROM cell c JOIN cell z ON c.cohort_month = z.cohort_month AND z.month_index = 0
  WHERE c.cohort_month + to_months(c.month_index + 1) <= {snap}),
order_total AS (
  SELECT customer_id, order_id, sum(CAST(sales AS DECIMAL(28, 6))) AS amount, min(order_date_clean) AS first_day, max(order_date_clean) AS last_day,
    sum(real_shipping_days - scheduled_days_for_shipment) AS delay, count(real_shipping_days - scheduled_days_for_shipment) AS delays
  FROM fact WHERE order_date_clean IS NOT NULL AND NOT is_quantity_invalid GROUP BY customer_id, order_id),
customer_total AS (
  SELECT customer_id, {sround('sum(amount)::DOUBLE', 2)} AS amount, count(order_id) AS orders, min(first_day) AS first_day,
    max(last_day) AS last_day, sum(delay)::DOUBLE / nullif(sum(delays), 0) AS mean_delay
  FROM order_total GROUP BY customer_id),
rfm_base AS (
  SELECT customer_id, CAST({snap} - last_day AS INTEGER) AS recency_days, orders AS frequency, amount AS monetary,
    mean_delay AS avg_delivery_delay FROM customer_total),
tiled AS (
  SELECT *, {_tile(5, 'recency_days DESC NULLS LAST, customer_id')} AS r_score,
    {_tile(5, 'frequency ASC NULLS FIRST, customer_id')} AS f_score, {_tile(5, 'monetary ASC NULLS FIRST, customer_id')} AS m_score
  FROM rfm_base),
tier(lowest, segment) AS (VALUES (12, 'Growing'), (9, 'Stable'), (6, 'At Risk'), (0, 'Lapsed')),
mart_churn_rfm AS (
  SELECT t.* , r_score + f_score + m_score AS rfm_score, coalesce(recency_days > 90, FALSE) AS is_churned, b.segment
  FROM tiled t ASOF JOIN tier b ON r_score + f_score + m_score >= b.lowest),
{_dominant('order_region', 'dominant_region')},
{_dominant('market', 'dominant_market')},
ltv_base AS (
  SELECT customer_id, amount AS historical_ltv, orders AS total_orders, first_day AS first_order_date, last_day AS last_order_date,
    CAST(greatest({months('first_day', 'last_day')} + 1, 1) AS INTEGER) AS lifespan_months FROM customer_total),
ltv AS (
  SELECT *, {sround('historical_ltv / total_orders', 2)} AS avg_order_value,
    {sround('total_orders / lifespan_months', 3)} AS purchase_frequency_per_month,
    {sround('(historical_ltv / total_orders) * (total_orders / lifespan_months) * lifespan_months', 2)} AS formula_based_ltv
  FROM ltv_base),
mart_ltv AS (
  SELECT l.customer_id, c.customer_segment, r.dominant_region, m.dominant_market, l.historical_ltv, l.formula_based_ltv,
    l.avg_order_value, l.total_orders, l.lifespan_months, l.first_order_date, l.last_order_date
  FROM ltv l LEFT JOIN dim_customer c USING (customer_id) LEFT JOIN dominant_region r USING (customer_id)
  LEFT JOIN dominant_market m USING (customer_id))"""
