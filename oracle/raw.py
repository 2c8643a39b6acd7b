"""DuckDB text of the raw order-line view: the same stand-in rules as
``acct_health.sources.order_lines``, written independently in SQL."""

from __future__ import annotations


def _lst(values) -> str:
    return "[" + ", ".join("'" + v.replace("'", "''") + "'" for v in values) + "]"


STATUSES = _lst(("COMPLETE", "CANCELED", "PENDING", "PROCESSING", "CLOSED",
                 "PAYMENT_REVIEW", "SUSPECTED_FRAUD", "ON_HOLD", "PENDING_PAYMENT"))
MODES = _lst(("Standard Class", "First Class", "Second Class", "Same Day"))
REGIONS = _lst(("Southeast Asia", "South Asia", "Oceania", "Eastern Asia", "West Asia", "West Africa",
                "Central Africa", "North Africa", "Western Europe", "Northern Europe", "Southern Europe",
                "Eastern Europe", "Caribbean", "South America", "Central America", "North America"))
MARKETS = _lst(("Africa", "USCA", "Pacific Asia", "Europe", "LATAM"))
COUNTRIES = _lst(("United States", "Vietnam", "Ireland", "Germany", "Mexico", "Brazil", "Australia"))
SPELLINGS = "[" + ", ".join(_lst(x) for x in (
    ("United States", "USA", "us", "U.S.A."), ("Vietnam", "VN", "viet nam"),
    ("Ireland", "IE", "Rep. of Ireland"), ("Germany", "DE", "Deutschland"),
    ("Mexico", "MX", "México"), ("Brazil", "BR", "Brasil"), ("Australia", "AU"))) + "]"
JUNK = "['&nbsp;', '<br>', '###', 'N/A - check later', chr(9), chr(8203)]"
CAT_NULLS = _lst(("N/A", "NULL", "None", "-", "??", ""))
MONEY_NULLS = _lst(("N/A", "None", "??", "-", "NULL", "null"))
TRUE_SPELL = _lst(("1", "Yes", "YES", "yes", "True", "Y"))
FALSE_SPELL = _lst(("0", "No", "NO", "no", "False", "N"))
DATE_JUNK = _lst(("not a date", "0000-00-00", "2026-02-30 10:00:00"))


def _cents(c: str) -> str:
    return f"(({c}) // 100)::VARCHAR || '.' || lpad((({c}) % 100)::VARCHAR, 2, '0')"


def _cents_thousands(c: str) -> str:
    ip = f"(({c}) // 100)"
    return (f"'$' || CASE WHEN {ip} >= 1000000 THEN ({ip} // 1000000)::VARCHAR || ',' || "
            f"lpad((({ip} // 1000) % 1000)::VARCHAR, 3, '0') || ',' || lpad(({ip} % 1000)::VARCHAR, 3, '0') "
            f"WHEN {ip} >= 1000 THEN ({ip} // 1000)::VARCHAR || ',' || lpad(({ip} % 1000)::VARCHAR, 3, '0') "
            f"ELSE {ip}::VARCHAR END || '.' || lpad((({c}) % 100)::VARCHAR, 2, '0')")


def _money(c: str, j: int) -> str:
    st = f"((k + {j}) % 7)"
    return (f"CASE WHEN ({c}) IS NULL THEN NULL WHEN {st} = 0 THEN {_cents(c)} "
            f"WHEN {st} = 1 THEN ' ' || {_cents(c)} WHEN {st} = 2 THEN {_cents(c)} || ' ' "
            f"WHEN {st} = 3 THEN {_cents_thousands(c)} "
            f"WHEN {st} = 4 THEN (({c}) // 100)::VARCHAR || ',' || lpad((({c}) % 100)::VARCHAR, 2, '0') "
            f"WHEN {st} = 5 THEN {MONEY_NULLS}[((k // 7) % 6) + 1] "
            f"ELSE CASE WHEN k % 2 = 0 THEN '' ELSE '   ' END END")


def _cat(v: str, j: int) -> str:
    st = f"((k + {j}) % 11)"
    return (f"CASE WHEN ({v}) IS NULL THEN NULL WHEN {st} = 0 THEN upper({v}) WHEN {st} = 1 THEN lower({v}) "
            f"WHEN {st} = 2 THEN '  ' || ({v}) || ' ' WHEN {st} = 3 THEN ({v}) || {JUNK}[((k // 11) % 6) + 1] "
            f"WHEN {st} = 4 THEN {CAT_NULLS}[((k // 11) % 6) + 1] ELSE ({v}) END")


_FMTS = ("%Y-%m-%d %H:%M:%S", "%m/%d/%Y %H:%M", "%m/%d/%Y", "%d/%m/%Y", "%d-%b-%y", "%B %d, %Y", "%Y/%m/%d")


def _date(d: str, i: str, kk: str) -> str:
    whens = " ".join(f"WHEN {i} = {n} THEN strftime({d}, '{f}')" for n, f in enumerate(_FMTS))
    body = (f"CASE WHEN {d} IS NULL THEN NULL {whens} "
            f"WHEN {i} = 7 THEN {DATE_JUNK}[((({kk}) // 9) % 3) + 1] ELSE NULL END")
    return f"CASE WHEN ({kk}) % 5 = 0 THEN ' ' || ({body}) || ' ' ELSE ({body}) END"


RAW_COLUMNS = (
    "order_item_id", "order_id", "customer_id", "order_customer_id", "product_card_id", "order_item_cardprod_id",
    "order_date", "shipping_date", "order_status", "delivery_status", "shipping_mode", "customer_segment",
    "order_region", "market", "late_delivery_risk", "real_shipping_days", "scheduled_days_for_shipment",
    "sales", "order_item_total", "order_item_product_price", "order_item_discount", "order_profit_per_order",
    "benefit_per_order", "sales_per_customer", "order_item_discount_rate", "order_item_profit_ratio",
    "order_item_quantity", "order_country", "order_state", "customer_fname", "customer_lname", "customer_city",
    "customer_state", "customer_country", "category_id", "category_name", "department_id", "department_name",
    "product_name", "product_price", "product_status",
)


def raw_order_lines_sql() -> str:
    """SELECT producing the dirty raw order lines (all VARCHAR)."""
    base = f"""
    SELECT li.l_orderkey * 10 + li.l_linenumber AS k, li.l_orderkey, li.l_partkey, li.l_suppkey,
           li.l_linenumber, CAST(o.o_orderdate AS DATE) AS od, CAST(li.l_shipdate AS DATE) AS sd,
           o.o_custkey, c.c_custkey, c.c_name, c.c_nationkey, c.c_mktsegment,
           p.p_name, p.p_brand, p.p_type, p.p_size, p.p_retailprice, s.s_nationkey, n.n_regionkey,
           li.l_partkey % 5 + 1 AS sched, li.l_partkey % 5 + 1 + li.l_suppkey % 4 - 1 AS real_days,
           {STATUSES}[(li.l_orderkey % 9) + 1] AS status,
           CAST(round(li.l_extendedprice * 100) AS BIGINT) AS cents,
           CAST(round(li.l_discount * 100) AS BIGINT) AS d100,
           CAST(li.l_quantity AS BIGINT) AS qty, li.l_suppkey % 7 + 1 AS pr
    FROM lineitem li
    LEFT JOIN orders o ON li.l_orderkey = o.o_orderkey
    LEFT JOIN customer c ON o.o_custkey = c.c_custkey
    LEFT JOIN part p ON li.l_partkey = p.p_partkey
    LEFT JOIN supplier s ON li.l_suppkey = s.s_suppkey
    LEFT JOIN nation n ON s.s_nationkey = n.n_nationkey
    LEFT JOIN region r ON n.n_regionkey = r.r_regionkey"""
    disc = "((cents * d100) // 100)"
    total = f"(cents - {disc})"
    profit = f"(({total} * pr) // 20)"
    money = {
        "sales": "cents",
        "order_item_total": total,
        "order_item_product_price": "CASE WHEN qty > 0 THEN cents // qty END",
        "order_item_discount": disc,
        "order_profit_per_order": profit,
        "benefit_per_order": profit,
        "sales_per_customer": total,
    }
    delivery = ("CASE WHEN status = 'CANCELED' THEN 'Shipping canceled' WHEN real_days > sched THEN 'Late delivery' "
                "WHEN real_days = sched THEN 'Shipping on time' ELSE 'Advance shipping' END")
    seg = ("CASE c_mktsegment WHEN 'AUTOMOBILE' THEN 'Consumer' WHEN 'BUILDING' THEN 'Corporate' "
           "WHEN 'FURNITURE' THEN 'Home Office' WHEN 'HOUSEHOLD' THEN 'Consumer' WHEN 'MACHINERY' THEN 'Corporate' END")
    cat = {
        "order_status": "CASE WHEN status = 'CANCELED' AND k % 2 = 0 THEN 'Cancelled' ELSE status END",
        "delivery_status": delivery,
        "shipping_mode": (f"CASE WHEN {MODES}[(l_linenumber % 4) + 1] = 'Second Class' AND k % 2 = 0 "
                          f"THEN '2nd Class' ELSE {MODES}[(l_linenumber % 4) + 1] END"),
        "customer_segment": seg,
        "order_region": f"{REGIONS}[(s_nationkey % 16) + 1]",
        "market": f"{MARKETS}[(n_regionkey % 5) + 1]",
    }
    spellings = f"{SPELLINGS}[(c_nationkey % 7) + 1]"
    spelling = f"{spellings}[((k // 5) % len({spellings})) + 1]"
    country = (f"CASE WHEN k % 23 = 0 THEN 'N/A' WHEN k % 19 = 0 THEN 'France' WHEN k % 3 = 1 THEN lower({spelling}) "
               f"WHEN k % 3 = 2 THEN upper({spelling}) ELSE {spelling} END")
    state0 = "'ST' || lpad((l_suppkey % 60)::VARCHAR, 2, '0')"
    state = (f"CASE WHEN k % 10 = 0 THEN {CAT_NULLS}[((k // 10) % 6) + 1] WHEN k % 10 = 1 THEN lower({state0}) "
             f"ELSE {state0} END")
    qty = ("CASE WHEN k % 13 = 0 THEN '??' WHEN (k // 3) % 9 = 0 THEN '0' WHEN (k // 3) % 9 = 1 THEN '-1' "
           "ELSE qty::VARCHAR END")
    late = (f"CASE WHEN k % 31 = 0 THEN 'N/A' WHEN real_days > sched THEN {TRUE_SPELL}[(k % 6) + 1] "
            f"ELSE {FALSE_SPELL}[(k % 6) + 1] END")
    cols = {
        "order_item_id": "k::VARCHAR",
        "order_id": "l_orderkey::VARCHAR",
        "customer_id": "o_custkey::VARCHAR",
        "order_customer_id": "o_custkey::VARCHAR",
        "product_card_id": "l_partkey::VARCHAR",
        "order_item_cardprod_id": "l_partkey::VARCHAR",
        "order_date": _date("od", "(k % 9)", "k"),
        "shipping_date": _date("sd", "((k // 7) % 9)", "(k + 1)"),
        **{name: _cat(v, j) for j, (name, v) in enumerate(cat.items())},
        "late_delivery_risk": late,
        "real_shipping_days": "CASE WHEN k % 13 = 5 THEN 'N/A' ELSE real_days::VARCHAR END",
        "scheduled_days_for_shipment": "CASE WHEN k % 13 = 7 THEN '' ELSE sched::VARCHAR END",
        **{name: _money(v, j) for j, (name, v) in enumerate(money.items())},
        "order_item_discount_rate": f"CASE WHEN k % 17 = 0 THEN '??' ELSE {_cents('d100')} END",
        "order_item_profit_ratio": _cents("pr * 5"),
        "order_item_quantity": qty,
        "order_country": country,
        "order_state": state,
        "customer_fname": "c_name",
        "customer_lname": "'L' || (c_custkey % 1000)::VARCHAR",
        "customer_city": "'City ' || c_nationkey::VARCHAR",
        "customer_state": "'CS' || lpad((c_nationkey % 50)::VARCHAR, 2, '0')",
        "customer_country": f"{COUNTRIES}[(c_nationkey % 7) + 1]",
        "category_id": "p_size::VARCHAR",
        "category_name": "p_type",
        "department_id": "(p_size % 10)::VARCHAR",
        "department_name": "p_brand",
        "product_name": "p_name",
        "product_price": _cents("CAST(round(p_retailprice * 100) AS BIGINT)"),
        "product_status": "'0'",
    }
    assert tuple(cols) == RAW_COLUMNS
    sel = ",\n      ".join(f"{v} AS {name}" for name, v in cols.items())
    return (f"SELECT {sel}\n    FROM ({base}) b\n    CROSS JOIN generate_series(1, "
            f"CASE WHEN b.k % 67 = 0 THEN 2 ELSE 1 END) AS copies(c)")



