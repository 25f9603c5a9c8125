"""Record schemas at the edges of the library (messages, tables, reports)."""

from pyspark.sql.types import (
    DecimalType,
    DoubleType,
    IntegerType,
    LongType,
    StringType,
    StructField,
    StructType,
    TimestampType,
)


_TYPES = {
    "string": StringType(),
    "bigint": LongType(),
    "int": IntegerType(),
    "double": DoubleType(),
    "timestamp": TimestampType(),
    "amount": DecimalType(38, 2),
}


def _schema(fields: str) -> StructType:
    """``"name type, name type"`` to a schema, without needing a session."""
    pairs = (field.split() for field in fields.split(","))
    return StructType([StructField(name, _TYPES[kind]) for name, kind in pairs])


COMMON = _schema("mid string, uid string, ar string, ch string, vc string")
APP_LOG = StructType(
    [
        StructField("common", COMMON),
        StructField("start", StringType()),
        StructField("ts", LongType()),
    ]
)

ORDER_INFO = _schema(
    "id bigint, province_id bigint, order_status string, user_id bigint, "
    "final_total_amount double, benefit_reduce_amount double, "
    "original_total_amount double, feight_fee double, "
    "expire_time string, create_time string, operate_time string"
)

ORDER_DETAIL = _schema(
    "id bigint, order_id bigint, sku_id bigint, order_price double, sku_num bigint, "
    "sku_name string, create_time string"
)

# What the enriched DWD messages carry on top of the raw records.
ORDER_INFO_ADDED = _schema(
    "create_date string, create_hour string, if_first_order string, "
    "province_name string, province_area_code string, province_iso_code string, "
    "province_iso_3166_2 string, user_age_group string, user_gender string"
)
ORDER_DETAIL_ADDED = _schema(
    "spu_id bigint, tm_id bigint, category3_id bigint, "
    "spu_name string, tm_name string, category3_name string"
)
ENRICHED_ORDER = StructType(ORDER_INFO.fields + ORDER_INFO_ADDED.fields)
ENRICHED_DETAIL = StructType(ORDER_DETAIL.fields + ORDER_DETAIL_ADDED.fields)

ORDER_WIDE = _schema(
    "order_detail_id bigint, order_id bigint, order_status string, create_time string, "
    "user_id bigint, sku_id bigint, sku_price double, sku_num bigint, sku_name string, "
    "benefit_reduce_amount double, original_total_amount double, feight_fee double, "
    "final_total_amount double, final_detail_amount double, if_first_order string, "
    "province_name string, province_area_code string, user_age_group string, "
    "user_gender string, dt string, spu_id bigint, tm_id bigint, category3_id bigint, "
    "spu_name string, tm_name string, category3_name string"
)

SALE_DETAIL = _schema(
    "order_detail_id string, order_id string, order_status string, create_time string, "
    "user_id string, sku_id string, user_gender string, user_age int, user_level string, "
    "sku_price double, sku_name string, dt string"
)

DAU_INFO = _schema(
    "mid string, uid string, ar string, ch string, vc string, "
    "dt string, hr string, mi string, ts bigint"
)

PROVINCE = _schema(
    "id string, name string, area_code string, iso_code string, iso_3166_2 string"
)
USER_INFO = _schema("id string, user_level string, birthday string, gender string")
CATEGORY3 = _schema("id string, name string, category2_id string")
TRADEMARK = _schema("id string, tm_name string")
SPU_INFO = _schema("id string, spu_name string")
SKU_INFO = _schema(
    "id string, spu_id string, price string, sku_name string, tm_id string, "
    "category3_id string, create_time string"
)
# Dimension tables as the jobs write them, by table name.
DIMENSIONS = {
    "base_province": PROVINCE,
    "base_category3": CATEGORY3,
    "base_trademark": TRADEMARK,
    "spu_info": SPU_INFO,
    "user_info": StructType(USER_INFO.fields + _schema("age_group string, gender_name string").fields),
    "sku_info": StructType(
        SKU_INFO.fields + _schema("category3_name string, tm_name string, spu_name string").fields
    ),
}
USER_STATE = _schema("user_id string, if_consumed string")

TRADEMARK_STAT = _schema(
    "stat_time timestamp, trademark_id string, trademark_name string, amount amount"
)
