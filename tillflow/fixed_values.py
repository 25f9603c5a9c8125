"""Texts and names that results must carry exactly as they are."""

# --- change-data routing -----------------------------------------------------
ODS_PREFIX = "ODS_"
# Tables whose row images are routed whatever the change type (except delete).
ROUTED_TABLES = (
    "order_detail",
    "base_province",
    "user_info",
    "base_category3",
    "base_trademark",
    "spu_info",
    "sku_info",
)
# Table routed only when the change type equals INSERT.
INSERT_ONLY_TABLE = "order_info"
INSERT = "insert"
DELETE = "delete"

# --- message topics ------------------------------------------------------------
TOPIC_ORDER_INFO = "DWD_ORDER_INFO"
TOPIC_ORDER_DETAIL = "DWD_ORDER_DETAIL"
TOPIC_ORDER_WIDE = "DWS_ORDER_WIDE"

# --- user dimension --------------------------------------------------------------
AGE_UP_TO_20 = "20岁及以下"
AGE_21_TO_30 = "21岁到30岁"
AGE_OVER_30 = "30岁以上"
GENDER_MALE = "男"
GENDER_FEMALE = "女"
DAYS_PER_YEAR = 365

# --- flags -----------------------------------------------------------------------
FIRST_ORDER = "1"
LATER_ORDER = "0"
VISIT_MINUTE = "00"

# --- dashboard totals --------------------------------------------------------------
TOTAL_DAU = ("dau", "新增日活")
TOTAL_NEW_DEVICES = ("new_mid", "新增设备")
TOTAL_ORDER_AMOUNT = ("order_amount", "新增交易额")

# --- settings ----------------------------------------------------------------------
LONG_BATCH = "5 seconds"
JOIN_WINDOW_SECONDS = 10
JOIN_CACHE_SECONDS = 60
VISIT_TTL = "24 hours"
JDBC_BATCH_ROWS = 100
JDBC_PARTITIONS = 4
HOURS_PER_DAY = 24
PREVIEW_ROWS = 1000
