"""Raw order-line export derived from the driver's TPC-H-style tables.

The reference's input is a dirty order-line CSV that is not shipped with it. This
module rebuilds rows *in that schema* from the driver tables (lineitem joined to
orders, customer, part, supplier, nation, region) and renders every field as text
with deterministic dirt chosen by integer arithmetic on the line id ``k``. It does no
cleaning work: all parsing, deduplication and canonicalisation happen in the
cleaning plan. The same rules are written independently as DuckDB SQL for the oracle.

Scale: one pass over lineitem. Each join that shuffles the lines carries all columns taken before it, so suppliers (two numbers, with
their nation and region) are joined first, broadcast while their files are small, then parts, and orders with their customers last: lines
of an order stand together behind it. The other joins are left to Catalyst's size-based strategy. Exact duplicate
rows are produced by ``explode`` in the same pass, not by a second scan + union.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# ---------------------------------------------------------------------------
# Fixed values for the stand-in input (indexed by key arithmetic).
# ---------------------------------------------------------------------------
STATUSES = ("COMPLETE", "CANCELED", "PENDING", "PROCESSING", "CLOSED",
            "PAYMENT_REVIEW", "SUSPECTED_FRAUD", "ON_HOLD", "PENDING_PAYMENT")
MODES = ("Standard Class", "First Class", "Second Class", "Same Day")
SEGMENT_OF_MKT = {"AUTOMOBILE": "Consumer", "BUILDING": "Corporate", "FURNITURE": "Home Office",
                  "HOUSEHOLD": "Consumer", "MACHINERY": "Corporate"}
REGIONS = ("Southeast Asia", "South Asia", "Oceania", "Eastern Asia", "West Asia", "West Africa",
           "Central Africa", "North Africa", "Western Europe", "Northern Europe", "Southern Europe",
           "Eastern Europe", "Caribbean", "South America", "Central America", "North America")
MARKETS = ("Africa", "USCA", "Pacific Asia", "Europe", "LATAM")
COUNTRY_SPELLINGS = (
    ("United States", "USA", "us", "U.S.A."),
    ("Vietnam", "VN", "viet nam"),
    ("Ireland", "IE", "Rep. of Ireland"),
    ("Germany", "DE", "Deutschland"),
    ("Mexico", "MX", "México"),
    ("Brazil", "BR", "Brasil"),
    ("Australia", "AU"),
)
JUNK = ("&nbsp;", "<br>", "###", "N/A - check later", "\t", "\u200b")
CAT_NULLS = ("N/A", "NULL", "None", "-", "??", "")
MONEY_NULLS = ("N/A", "None", "??", "-", "NULL", "null")
TRUE_SPELL = ("1", "Yes", "YES", "yes", "True", "Y")
FALSE_SPELL = ("0", "No", "NO", "no", "False", "N")
DATE_JUNK = ("not a date", "0000-00-00", "2026-02-30 10:00:00")
# Date renderings picked by k % 9 (7 = junk, 8 = NULL).
DATE_RENDER = ("yyyy-MM-dd HH:mm:ss", "MM/dd/yyyy HH:mm", "MM/dd/yyyy", "dd/MM/yyyy",
               "dd-MMM-yy", "MMMM dd, yyyy", "yyyy/MM/dd")
MONEY_COLUMNS = ("sales", "order_item_total", "order_item_product_price", "order_item_discount",
                 "order_profit_per_order", "benefit_per_order", "sales_per_customer")
# ---------------------------------------------------------------------------


def _pick(values, idx: Column) -> Column:
    return F.element_at(F.array(*[F.lit(v) for v in values]), (idx + 1).cast("int"))


def _div(a: Column, b) -> Column:
    return F.floor(a / b).cast("bigint")


def _cents_text(c: Column) -> Column:
    return F.concat(_div(c, 100).cast("string"), F.lit("."), F.lpad((c % 100).cast("string"), 2, "0"))


def _dirty_money(cents: Column, k: Column, j: int) -> Column:
    style = (k + j) % 7
    ip, fp = _div(cents, 100), F.lpad((cents % 100).cast("string"), 2, "0")
    plain = F.concat(ip.cast("string"), F.lit("."), fp)
    return (
        F.when(cents.isNull(), F.lit(None).cast("string"))
        .when(style == 0, plain)
        .when(style == 1, F.concat(F.lit(" "), plain))
        .when(style == 2, F.concat(plain, F.lit(" ")))
        .when(style == 3, F.concat(F.lit("$"), F.format_number(ip, 0), F.lit("."), fp))
        .when(style == 4, F.concat(ip.cast("string"), F.lit(","), fp))
        .when(style == 5, _pick(MONEY_NULLS, _div(k, 7) % 6))
        .otherwise(F.when(k % 2 == 0, F.lit("")).otherwise(F.lit("   ")))
    )


def _dirty_category(v: Column, k: Column, j: int) -> Column:
    style = (k + j) % 11
    return (
        F.when(v.isNull(), F.lit(None).cast("string"))
        .when(style == 0, F.upper(v))
        .when(style == 1, F.lower(v))
        .when(style == 2, F.concat(F.lit("  "), v, F.lit(" ")))
        .when(style == 3, F.concat(v, _pick(JUNK, _div(k, 11) % 6)))
        .when(style == 4, _pick(CAT_NULLS, _div(k, 11) % 6))
        .otherwise(v)
    )


def _dirty_date(d: Column, i: Column, k: Column) -> Column:
    out = F.when(d.isNull(), F.lit(None).cast("string"))
    for n, fmt in enumerate(DATE_RENDER):
        out = out.when(i == n, F.date_format(d, fmt))
    out = out.when(i == 7, _pick(DATE_JUNK, _div(k, 9) % 3)).otherwise(F.lit(None).cast("string"))
    return F.when(k % 5 == 0, F.concat(F.lit(" "), out, F.lit(" "))).otherwise(out)


BROADCAST_BYTES = 16 << 20  # of files of suppliers, of which two numbers a row are read


def file_bytes(spark: SparkSession, path: str) -> int:
    where = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return where.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).getContentSummary(where).getLength()


_DISTINCT: dict[tuple, bool] = {}  # (application, file, key, stamp of the files) -> whether no key but null is there twice


def one_per_key(df: DataFrame, key: str, path: str) -> DataFrame:
    """``df``, the table in ``path``, and if it has each key once, looked up once a session, in a form that tells Catalyst so. Rows whose key is null, which meet nothing
    in a join, may be fewer."""
    where = df.sparkSession.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    files = where.getFileSystem(df.sparkSession.sparkContext._jsc.hadoopConfiguration()).listStatus(where)
    at = (df.sparkSession.sparkContext.applicationId, path, key, tuple(sorted((f.getPath().toString(), f.getLen(), f.getModificationTime()) for f in files)))
    if at not in _DISTINCT:
        _DISTINCT[at] = df.where(F.col(key).isNotNull()).groupBy(key).count().where("count > 1").isEmpty()
    return df.dropDuplicates([key]) if _DISTINCT[at] else df


SOURCE_TABLES = ("lineitem", "orders", "customer", "part", "supplier", "nation", "region")


def order_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Order lines as all-STRING columns named as the cleaning plan reads them."""
    rd = lambda t: spark.read.parquet(f"{sf_dir}/{t}.parquet")
    # whole numbers and days take less of a shuffle than doubles and timestamps
    li = rd("lineitem").select(
        "l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", F.col("l_quantity").cast("bigint").alias("qty"), F.col("l_shipdate").cast("date").alias("sd"),
        F.round(F.col("l_extendedprice") * 100).cast("bigint").alias("cents"), F.round(F.col("l_discount") * 100).cast("bigint").alias("d100"))
    o = rd("orders").select("o_orderkey", "o_custkey", F.col("o_orderdate").cast("date").alias("od"))
    c = rd("customer").select("c_custkey", "c_name", "c_nationkey", "c_mktsegment")
    p = rd("part").select("p_partkey", "p_name", "p_brand", "p_type", "p_size", "p_retailprice")
    s = rd("supplier").select("s_suppkey", "s_nationkey")
    n = rd("nation").select("n_nationkey", "n_regionkey")
    r = rd("region").select("r_regionkey")

    # a join on keys that are known to be distinct goes where none of the table's columns is read
    c, p = one_per_key(c, "c_custkey", f"{sf_dir}/customer.parquet"), one_per_key(p, "p_partkey", f"{sf_dir}/part.parquet")
    # orders take their customer before they meet the lines, so the lines are shuffled for orders once
    oc = o.join(c, F.col("o_custkey") == c.c_custkey, "left")
    snr = (s.join(n, F.col("s_nationkey") == n.n_nationkey, "left").join(r, F.col("n_regionkey") == r.r_regionkey, "left")
           .select("s_suppkey", "s_nationkey", "n_regionkey"))
    if file_bytes(spark, f"{sf_dir}/supplier.parquet") <= BROADCAST_BYTES:
        snr = F.broadcast(snr)
    j = (li.join(snr, li.l_suppkey == snr.s_suppkey, "left")
         .join(p, F.col("l_partkey") == p.p_partkey, "left")
         .join(oc, F.col("l_orderkey") == oc.o_orderkey, "left"))

    k = F.col("l_orderkey") * 10 + F.col("l_linenumber")
    j = j.withColumns({
        "k": k,
        "sched": F.col("l_partkey") % 5 + 1,
        "real": F.col("l_partkey") % 5 + 1 + F.col("l_suppkey") % 4 - 1,
        "status": _pick(STATUSES, F.col("l_orderkey") % 9),
        "pr": F.col("l_suppkey") % 7 + 1,
    })
    k = F.col("k")
    disc = _div(F.col("cents") * F.col("d100"), 100)
    total = F.col("cents") - disc
    profit = _div(total * F.col("pr"), 20)
    money = {
        "sales": F.col("cents"),
        "order_item_total": total,
        "order_item_product_price": F.when(F.col("qty") > 0, _div(F.col("cents"), F.col("qty"))),
        "order_item_discount": disc,
        "order_profit_per_order": profit,
        "benefit_per_order": profit,
        "sales_per_customer": total,
    }
    delivery = (F.when(F.col("status") == "CANCELED", F.lit("Shipping canceled"))
                .when(F.col("real") > F.col("sched"), F.lit("Late delivery"))
                .when(F.col("real") == F.col("sched"), F.lit("Shipping on time"))
                .otherwise(F.lit("Advance shipping")))
    seg = F.create_map(*[F.lit(x) for kv in SEGMENT_OF_MKT.items() for x in kv])[F.col("c_mktsegment")]
    country_idx = F.col("c_nationkey") % 7
    cat = {
        "order_status": F.col("status"),
        "delivery_status": delivery,
        "shipping_mode": _pick(MODES, F.col("l_linenumber") % 4),
        "customer_segment": seg,
        "order_region": _pick(REGIONS, F.col("s_nationkey") % 16),
        "market": _pick(MARKETS, F.col("n_regionkey") % 5),
    }
    late = F.col("real") > F.col("sched")
    ids = {
        "order_item_id": k.cast("string"),
        "order_id": F.col("l_orderkey").cast("string"),
        "customer_id": F.col("o_custkey").cast("string"),
        "order_customer_id": F.col("o_custkey").cast("string"),
        "product_card_id": F.col("l_partkey").cast("string"),
        "order_item_cardprod_id": F.col("l_partkey").cast("string"),
    }
    attrs = {
        "customer_fname": F.col("c_name"),
        "customer_lname": F.concat(F.lit("L"), (F.col("c_custkey") % 1000).cast("string")),
        "customer_city": F.concat(F.lit("City "), F.col("c_nationkey").cast("string")),
        "customer_state": F.concat(F.lit("CS"), F.lpad((F.col("c_nationkey") % 50).cast("string"), 2, "0")),
        "customer_country": _pick([x[0] for x in COUNTRY_SPELLINGS], country_idx),
        "category_id": F.col("p_size").cast("string"),
        "category_name": F.col("p_type"),
        "department_id": (F.col("p_size") % 10).cast("string"),
        "department_name": F.col("p_brand"),
        "product_name": F.col("p_name"),
        "product_price": _cents_text(F.round(F.col("p_retailprice") * 100).cast("bigint")),
        "product_status": F.lit("0"),
    }
    cat_dirty = {}
    for jj, (name, v) in enumerate(cat.items()):
        if name == "shipping_mode":
            v = F.when((v == "Second Class") & (k % 2 == 0), F.lit("2nd Class")).otherwise(v)
        if name == "order_status":
            v = F.when((v == "CANCELED") & (k % 2 == 0), F.lit("Cancelled")).otherwise(v)
        cat_dirty[name] = _dirty_category(v, k, jj)
    spell_arr = F.array(*[F.array(*[F.lit(x) for x in sp]) for sp in COUNTRY_SPELLINGS])
    spellings = F.element_at(spell_arr, (country_idx + 1).cast("int"))
    spelling = F.element_at(spellings, (_div(k, 5) % F.size(spellings) + 1).cast("int"))
    country = (F.when(k % 23 == 0, F.lit("N/A"))
               .when(k % 19 == 0, F.lit("France"))
               .when(k % 3 == 1, F.lower(spelling))
               .when(k % 3 == 2, F.upper(spelling))
               .otherwise(spelling))
    state = F.concat(F.lit("ST"), F.lpad((F.col("l_suppkey") % 60).cast("string"), 2, "0"))
    state = (F.when(k % 10 == 0, _pick(CAT_NULLS, _div(k, 10) % 6))
             .when(k % 10 == 1, F.lower(state))
             .otherwise(state))
    qty = (F.when(k % 13 == 0, F.lit("??"))
           .when(_div(k, 3) % 9 == 0, F.lit("0"))
           .when(_div(k, 3) % 9 == 1, F.lit("-1"))
           .otherwise(F.col("qty").cast("string")))
    late_txt = (F.when(k % 31 == 0, F.lit("N/A"))
                .when(late, _pick(TRUE_SPELL, k % 6))
                .otherwise(_pick(FALSE_SPELL, k % 6)))
    out = {
        **ids,
        "order_date": _dirty_date(F.col("od"), k % 9, k),
        "shipping_date": _dirty_date(F.col("sd"), _div(k, 7) % 9, k + 1),
        **cat_dirty,
        "late_delivery_risk": late_txt,
        "real_shipping_days": F.when(k % 13 == 5, F.lit("N/A")).otherwise(F.col("real").cast("string")),
        "scheduled_days_for_shipment": F.when(k % 13 == 7, F.lit("")).otherwise(F.col("sched").cast("string")),
        **{name: _dirty_money(v, k, jj) for jj, (name, v) in enumerate(money.items())},
        "order_item_discount_rate": F.when(k % 17 == 0, F.lit("??")).otherwise(_cents_text(F.col("d100"))),
        "order_item_profit_ratio": _cents_text(F.col("pr") * 5),
        "order_item_quantity": qty,
        "order_country": country,
        "order_state": state,
        **attrs,
    }
    copies = F.explode(F.sequence(F.lit(1), F.when(k % 67 == 0, F.lit(2)).otherwise(F.lit(1))))
    return j.select(*[v.alias(name) for name, v in out.items()], copies.alias("_copy")).drop("_copy")
