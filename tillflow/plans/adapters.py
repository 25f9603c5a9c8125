"""The given tables in the shape of the records the operators take.

Values the tables lack (a birthday, a province of an order) are derived from
columns they have, the same way in ``plans.oracle``.
"""

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tillflow.functions.dates import second_text
from tillflow.functions.money import to_cents

_DAY_SECONDS = 86_400
SPU_COUNT = 64
FILES_PER_BATCH = 256


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def table_stream(
    spark: SparkSession, sf_dir: str, name: str, files_per_batch: int | None = FILES_PER_BATCH
) -> DataFrame:
    """A table as a stream. The pattern lets it be one file or a folder of files.

    The number of files bounds a micro-batch, and with it what one key can bring.
    """
    schema = table(spark, sf_dir, name).schema
    reader = spark.readStream.schema(schema)
    if files_per_batch:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    return reader.parquet(f"{sf_dir}/{name}.parque[t]")


def instant(ts: str) -> Column:
    return F.col(ts).cast("timestamp")


# --- logs --------------------------------------------------------------------------


def app_logs(events: DataFrame) -> DataFrame:
    """Events as parsed app logs; a sign-up stands for an app start."""
    user = F.col("user_id").cast("string")
    common = F.struct(
        user.alias("mid"),
        user.alias("uid"),
        F.get_json_object("props", "$.k").alias("ar"),
        F.col("event_type").alias("ch"),
        F.lit("1.0").alias("vc"),
    )
    start = F.when(F.col("event_type") == "signup", F.lit("entry"))
    return events.select(
        common.alias("common"), start.alias("start"), F.unix_millis(instant("ts")).alias("ts")
    )


def as_text(rows: DataFrame) -> DataFrame:
    """Rows as JSON messages."""
    return rows.select(F.to_json(F.struct("*")).alias("value"))


# --- orders and lines ----------------------------------------------------------------


def _create_time() -> Column:
    """Orders carry dates only; the time of day comes from the key."""
    seconds = F.col("o_orderkey") % _DAY_SECONDS
    moment = F.timestamp_seconds(F.unix_seconds(instant("o_orderdate")) + seconds)
    return second_text(moment)


def order_time() -> Column:
    """When an order was made, as ``order_info`` has it, in microseconds."""
    return F.unix_micros(F.to_timestamp(_create_time()))


def line_time() -> Column:
    """When a line was made, as ``order_detail`` has it, in microseconds."""
    return F.unix_micros(F.to_timestamp(second_text(F.col("l_shipdate"))))


def order_info(orders: DataFrame) -> DataFrame:
    """Orders; the paid total is the stored price, freight is charged on urgent ones."""
    freight = F.when(F.col("o_orderpriority") == "1-URGENT", 10.0).otherwise(0.0)
    return orders.select(
        F.col("o_orderkey").alias("id"),
        F.col("o_orderstatus").alias("order_status"),
        F.col("o_custkey").alias("user_id"),
        F.col("o_totalprice").alias("final_total_amount"),
        F.lit(0.0).alias("benefit_reduce_amount"),
        (F.col("o_totalprice") - freight).alias("original_total_amount"),
        freight.alias("feight_fee"),
        _create_time().alias("create_time"),
    )


def with_province(orders: DataFrame, customer: DataFrame) -> DataFrame:
    """Order records with the nation of their customer as province."""
    home = customer.select(
        F.col("c_custkey").alias("user_id"), F.col("c_nationkey").cast("bigint").alias("province_id")
    )
    return orders.join(home, "user_id", "left")


def detail_id() -> Column:
    """An id for a line: no smaller set of its columns is unique."""
    return F.concat_ws(
        "-",
        F.col("l_orderkey"), F.col("l_linenumber"), F.col("l_partkey"), F.col("l_suppkey"),
        to_cents(F.col("l_extendedprice")), F.unix_date(F.col("l_shipdate").cast("date")),
    )


def order_detail(lineitem: DataFrame, keep: tuple[str, ...] = ()) -> DataFrame:
    """Order lines: price is the extended price, number the quantity; ``keep`` are columns added before."""
    return lineitem.select(
        detail_id().alias("id"),
        F.col("l_orderkey").alias("order_id"),
        F.col("l_partkey").alias("sku_id"),
        F.col("l_extendedprice").alias("order_price"),
        F.col("l_quantity").cast("bigint").alias("sku_num"),
        second_text(F.col("l_shipdate")).alias("create_time"),
        *keep,
    )


def with_sku_name(details: DataFrame) -> DataFrame:
    """Order lines with the name a line carries of its own."""
    return details.withColumn("sku_name", F.concat(F.lit("sku "), F.col("sku_id")))


# --- dimensions -------------------------------------------------------------------


def province(nation: DataFrame) -> DataFrame:
    key = F.col("n_nationkey").cast("string")
    return nation.select(
        key.alias("id"),
        F.col("n_name").alias("name"),
        F.col("n_regionkey").cast("string").alias("area_code"),
        F.concat(F.lit("CN-"), key).alias("iso_code"),
        F.concat(F.lit("CN-"), F.col("n_name")).alias("iso_3166_2"),
    )


def user_info(customer: DataFrame) -> DataFrame:
    days = ((F.col("c_custkey") * 37) % 16_000).cast("int")
    gender = F.when(F.col("c_custkey") % 3 == 0, "M").when(F.col("c_custkey") % 3 == 1, "F")
    return customer.select(
        F.col("c_custkey").cast("string").alias("id"),
        F.col("c_mktsegment").alias("user_level"),
        F.date_add(F.lit("1975-01-01").cast("date"), days).cast("string").alias("birthday"),
        gender.alias("gender"),
    )


def _brand_number() -> Column:
    return F.split_part(F.col("p_brand"), F.lit("#"), F.lit(2))


def sku_info(part: DataFrame) -> DataFrame:
    return part.select(
        F.col("p_partkey").cast("string").alias("id"),
        (F.col("p_partkey") % SPU_COUNT).cast("string").alias("spu_id"),
        F.col("p_name").alias("sku_name"),
        _brand_number().alias("tm_id"),
        F.col("p_size").cast("string").alias("category3_id"),
    )


def trademarks(part: DataFrame) -> DataFrame:
    return part.select(_brand_number().alias("id"), F.col("p_brand").alias("tm_name")).distinct()


def categories(part: DataFrame) -> DataFrame:
    size = F.col("p_size").cast("string")
    return part.select(
        size.alias("id"), F.concat(F.lit("size "), size).alias("name")
    ).distinct()


def spus(part: DataFrame) -> DataFrame:
    key = (F.col("p_partkey") % SPU_COUNT).cast("string")
    return part.groupBy(key.alias("id")).agg(F.min("p_name").alias("spu_name"))


# --- change messages ----------------------------------------------------------------


def _change_type(key: Column) -> Column:
    kinds = F.array(*[F.lit(k) for k in ("insert", "update", "delete", "bootstrap-insert", "insert")])
    return F.element_at(kinds, (key % 5 + 1).cast("int"))


def _change(rows: DataFrame, name: str, key: Column, data: Column) -> DataFrame:
    envelope = F.struct(F.lit(name).alias("table"), _change_type(key).alias("type"), data.alias("data"))
    return rows.select(F.to_json(envelope).alias("value"))


def row_changes(
    orders: DataFrame, lineitem: DataFrame, customer: DataFrame, region: DataFrame
) -> DataFrame:
    """Single-row change messages of several tables; users in debt come without data."""

    def image(identity: Column, note: Column) -> Column:
        return F.struct(identity.cast("string").alias("id"), note.alias("note"))

    user = F.when(F.col("c_acctbal") >= 0, image(F.col("c_custkey"), F.col("c_mktsegment")))
    return (
        _change(orders, "order_info", F.col("o_orderkey"), image(F.col("o_orderkey"), F.col("o_orderstatus")))
        .unionByName(_change(lineitem, "order_detail", F.col("l_linenumber"), image(F.col("l_orderkey"), detail_id())))
        .unionByName(_change(customer, "user_info", F.col("c_custkey"), user))
        .unionByName(_change(region, "base_region", F.lit(0), image(F.col("r_regionkey"), F.col("r_name"))))
    )


def array_changes(orders: DataFrame, lineitem: DataFrame) -> DataFrame:
    """Change messages with none to three row images each."""
    steps = F.transform(
        F.filter(F.array(F.lit(1), F.lit(2), F.lit(3)), lambda i: i <= F.col("o_orderkey") % 4),
        lambda i: F.struct(F.col("o_orderkey").cast("string").alias("id"), i.cast("string").alias("note")),
    )
    line = F.array(F.struct(F.col("l_orderkey").cast("string").alias("id"), detail_id().alias("note")))
    return _change(orders, "order_status_log", F.col("o_orderkey"), steps).unionByName(
        _change(lineitem, "order_detail", F.col("l_linenumber"), line)
    )
