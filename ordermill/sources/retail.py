"""Order messages and reference sources read from the generic retail tables.

The tables hold customers, parts, suppliers, orders and order lines. Each line
becomes one order message, with faults sown by fixed expressions; customers,
parts and suppliers become the overlapping reference sources.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ordermill.session import parts_for, prepare, slice_of, slices_for

LINE_COLUMNS = (
    "l_shipdate", "l_partkey", "l_suppkey", "l_extendedprice", "l_quantity", "l_discount",
    "l_tax", "l_returnflag", "l_linestatus",
)


class Retail:
    def __init__(self, spark: SparkSession, folder: str):
        self.spark = prepare(spark)
        self.folder = folder.rstrip("/")
        self._tables: dict[str, DataFrame] = {}

    def table(self, name: str) -> DataFrame:
        if name not in self._tables:
            self._tables[name] = self.spark.read.parquet(f"{self.folder}/{name}.parquet")
        return self._tables[name]

    def as_of(self) -> Column:
        """The latest order date stands for today."""
        return self.table("orders").agg(F.max(F.to_date("o_orderdate"))).scalar()

    def line_count(self) -> int:
        """Number of order lines, from the footers of the stored table."""
        return self.table("lineitem").count()

    def order_lines(self, number: int = 0, slices: int = 1) -> DataFrame:
        """One row per order line with the typed fields of its message; of one slice of the orders, if asked.

        Lines are spread by order first: how many tasks judge them follows their number, not the layout of the files.
        """
        tasks = -(-parts_for(self.spark, self.line_count()) // slices)
        line, order, part = self.table("lineitem"), self.table("orders"), self.table("part")
        if slices > 1:
            line, order = (rows.filter(slice_of(slices, key) == number) for rows, key in ((line, "l_orderkey"), (order, "o_orderkey")))
        rows = line.repartition(tasks, "l_orderkey").join(order.select("o_orderkey", "o_custkey"), F.col("l_orderkey") == F.col("o_orderkey")).join(
            part.select("p_partkey", "p_type"), F.col("l_partkey") == F.col("p_partkey")
        )
        rows = rows.withColumns({
            "kind": F.expr("o_orderkey % 3"),
            "cents": F.expr("cast(round(l_extendedprice * 100) as bigint)"),
            "units": F.col("l_quantity").cast("bigint"),
        }).withColumn("unit_cents", F.expr("cents div units"))

        def every(n: int, column: str = "l_partkey") -> Column:
            return F.expr(f"{column} % {n} = 0")

        return rows.select(
            F.when(F.col("kind") == 2, "orders.pos").otherwise("orders.web").alias("topic"),
            F.struct(*LINE_COLUMNS).alias("arrival"),
            F.concat(F.when(F.col("kind") == 2, "POS-").otherwise("WEB-"), F.col("l_orderkey"), F.lit("-"),
                     F.col("l_linenumber")).alias("order_id"),
            F.when(every(53), "not-an-email").when(every(83), "Stranger@Email.com")
            .when(~every(59), F.concat(F.lit("Customer"), F.col("o_custkey"), F.lit("@Email.com")))
            .alias("customer_email"),
            F.when(every(61), "phone").when(F.col("kind") == 0, "web").when(F.col("kind") == 1, "app")
            .otherwise("store").alias("channel"),
            F.when((F.col("kind") == 2) & ~every(47, "l_suppkey"), store_code("l_suppkey")).alias("store_code"),
            F.when(every(67), F.concat(F.lit("WEB-"), F.col("l_partkey"))).when(every(79), "UC-ZZ-999")
            .otherwise(product_ref("l_partkey")).alias("product_ref"),
            F.when(every(71), 0).otherwise(F.col("units")).cast("int").alias("quantity"),
            (F.col("unit_cents") / 100).alias("unit_price_eur"),
            (F.when(F.col("l_linenumber") == 7, F.col("cents")).otherwise(F.col("units") * F.col("unit_cents")) / 100)
            .alias("amount_eur"),
            F.col("l_shipdate").cast("timestamp").alias("order_timestamp"),
        )

    def order_messages(self, number: int = 0, slices: int = 1) -> DataFrame:
        """``(topic, arrival, value)`` with the message as JSON text; of one slice of the orders, if asked."""
        lines = self.order_lines(number, slices)
        fields = [c for c in lines.columns if c not in ("topic", "arrival")]
        return lines.select("topic", "arrival", F.to_json(F.struct(*fields)).alias("value"))

    def sliced_messages(self, share: int = 1) -> list[DataFrame]:
        """All messages, as one frame per slice of the orders: what the joins of one shuffle lies on disk at a time.

        There are slices for one ``share`` of the lines, if the caller filters the rest out.
        """
        slices = slices_for(self.line_count() // share)
        return [self.order_messages(n, slices) for n in range(slices)]

    def customer_activity(self) -> DataFrame:
        """Customers with first and last order date."""
        seen = self.table("orders").groupBy(F.col("o_custkey").alias("c_custkey")).agg(
            F.min(F.to_date("o_orderdate")).alias("first_order"), F.max(F.to_date("o_orderdate")).alias("last_order")
        )
        return self.table("customer").join(seen, "c_custkey", "left")

    def customer_sources(self) -> dict[str, DataFrame]:
        """CRM, web and pos customers, overlapping by key; every customer is in one at least."""
        people, key = self.customer_activity(), F.col("c_custkey")

        def source(tag: str, kept: str, email: Column, last_activity: Column, **more: Column) -> DataFrame:
            return people.filter(kept).select(
                F.concat(F.lit(tag + "-"), key).alias("source_id"),
                email.alias("email"),
                F.col("c_name").alias("first_name"),
                F.col("c_mktsegment").alias("last_name"),
                F.concat(F.lit("+33"), padded("c_custkey", 9)).alias("phone"),
                (F.col("c_acctbal") > 0).alias("consent_marketing"),
                F.col("first_order").alias("consent_date"),
                last_activity.alias("last_activity"),
                *[c.alias(n) for n, c in more.items()],
            )

        days = F.col("last_order")
        web_email = F.concat(F.lit("Customer"), key, F.lit("@EMAIL.com"))
        return {
            "crm": source("CRM", "c_custkey % 2 = 0 or (c_custkey % 3 <> 0 and c_custkey % 5 > 1)", F.concat(F.lit("customer"), key, F.lit("@email.com")),
                          F.when(F.expr("c_custkey % 11 <> 0"), F.date_sub(days, F.expr("cast(c_custkey % 7 as int)")))),
            "web": source("WEB", "c_custkey % 3 = 0",
                          F.when(F.expr("c_custkey % 10 = 9"), F.concat(F.lit(" "), web_email, F.lit(" ")))
                          .otherwise(web_email),
                          F.date_sub(days, F.expr("cast(c_custkey % 5 as int)"))),
            "pos": source("POS", "c_custkey % 5 <= 1",
                          F.when(F.expr("c_custkey % 97 = 0"), F.lit(None)).when(F.expr("c_custkey % 89 = 0"), F.lit(""))
                          .otherwise(F.concat(F.lit("CUSTOMER"), key, F.lit("@email.com"))),
                          days, store_code=F.concat(F.lit("S"), padded("c_custkey % 10", 4))),
        }

    def products_erp(self) -> DataFrame:
        """Three of four parts. Parts that share a reference are rows of their own; golden records choose."""
        return self.table("part").filter("p_partkey % 4 <> 0").select(
            product_ref("p_partkey").alias("product_ref"),
            F.col("p_name").alias("product_name"),
            F.col("p_brand").alias("category"),
            price(F.col("p_retailprice")).alias("price_eur"),
            F.col("p_size").alias("stock_qty"),
        )

    def products_web(self) -> DataFrame:
        """Every third part, and those that are not in the ERP."""
        return self.table("part").filter("p_partkey % 3 = 0 or p_partkey % 4 = 0").select(
            F.concat(F.lit("SKU-"), "p_partkey").alias("web_sku"),
            F.when(F.expr("p_partkey % 21 = 0"), F.concat(F.lit("WEB-"), "p_partkey"))
            .otherwise(product_ref("p_partkey")).alias("product_ref"),
            F.concat(F.col("p_name"), F.lit(" (web)")).alias("product_name"),
            F.col("p_brand").alias("category"),
            price(F.col("p_retailprice") * 1.05).alias("price_eur"),
        )

    def stores(self, kept: str = "true") -> DataFrame:
        nation, region = self.table("nation"), self.table("region")
        place = nation.join(region, F.col("n_regionkey") == F.col("r_regionkey")).select("n_nationkey", "n_name", "r_name")
        return self.table("supplier").filter(kept).join(
            place, F.col("s_nationkey") == F.col("n_nationkey"), "left"
        ).select(
            store_code("s_suppkey").alias("store_code"),
            F.col("s_name").alias("store_name"),
            F.col("n_name").alias("city"),
            F.col("r_name").alias("region"),
        )

    def historical_orders(self) -> tuple[DataFrame, DataFrame]:
        """Web and pos orders as typed tables, one row per order id."""
        rows = self.order_lines().withColumnRenamed("order_timestamp", "order_date")
        first = rows.groupBy("order_id").agg(
            F.min_by(F.struct(*[c for c in rows.columns if c not in ("order_id", "arrival")]), "arrival").alias("o")
        ).select("order_id", "o.*")
        web = first.filter("topic = 'orders.web'").drop("topic", "store_code")
        pos = first.filter("topic = 'orders.pos'").drop("topic", "channel")
        return web, pos

    def day_span(self) -> DataFrame:
        """One row: first and last day any order line was shipped."""
        return self.table("lineitem").agg(
            F.to_date(F.min("l_shipdate")).alias("start"), F.to_date(F.max("l_shipdate")).alias("end")
        )


def padded(key: str, width: int) -> Column:
    """A number with leading zeros up to ``width`` digits; longer ones stay whole."""
    return F.expr(f"lpad(string({key}), greatest({width}, length(string({key}))), '0')")


def store_code(key: str) -> Column:
    return F.concat(F.lit("S"), padded(key, 4))


def product_ref(key: str) -> Column:
    """The rules ask for two letters and three digits, so references are few by design and parts share them."""
    return F.concat(F.lit("UC-"), F.upper(F.left("p_type", F.lit(2))), F.lit("-"),
                    F.lpad(F.expr(f"cast({key} % 1000 as string)"), 3, "0"))


def price(value: Column) -> Column:
    return (F.round(value * 100).cast("bigint") / 100).cast("decimal(10,2)")
