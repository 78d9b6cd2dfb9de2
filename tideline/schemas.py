"""Schemas of the messages, facts and metrics that cross a layer boundary."""

from __future__ import annotations

from pyspark.sql import types as T

TEXT_MAP = T.MapType(T.StringType(), T.StringType())
CORRUPT = "_corrupt_record"


def _strings(*names: str) -> list[T.StructField]:
    return [T.StructField(n, T.StringType()) for n in names]


CDC = T.StructType(
    [
        T.StructField("before", TEXT_MAP),
        T.StructField("after", TEXT_MAP),
        T.StructField("source", TEXT_MAP),
        T.StructField("op", T.StringType()),
        T.StructField("ts_ms", T.LongType()),
    ]
)

COMMON = T.StructType(_strings("mid", "uid", "vc", "ch", "ar", "is_new", "ba", "md", "os", "sid"))
PAGE = T.StructType(
    _strings("page_id", "last_page_id", "item", "item_type") + [T.StructField("during_time", T.DoubleType())]
)
APP_LOG = T.StructType(
    [
        T.StructField("common", COMMON),
        T.StructField("page", PAGE),
        T.StructField("start", TEXT_MAP),
        T.StructField("displays", T.ArrayType(TEXT_MAP)),
        T.StructField("actions", T.ArrayType(TEXT_MAP)),
        T.StructField("err", TEXT_MAP),
        T.StructField("ts", T.LongType()),
    ]
)

# Columns read from `after` per source table (P5).
CDC_COLUMNS = {
    "order_detail": [
        "id", "order_id", "sku_id", "sku_name", "order_price", "sku_num", "create_time", "source_id",
        "source_type", "split_total_amount", "split_activity_amount", "split_coupon_amount",
    ],
    "order_info": ["id", "user_id", "province_id", "total_amount", "original_total_amount", "consignee",
                   "order_status", "payment_way", "trade_body", "create_time", "operate_time",
                   "activity_reduce_amount", "coupon_reduce_amount"],
    "order_detail_activity": ["order_detail_id", "activity_id", "activity_rule_id"],
    "order_detail_coupon": ["order_detail_id", "coupon_id"],
    "payment_info": ["user_id", "order_id", "payment_type", "callback_time"],
    "order_refund_info": ["id", "user_id", "order_id", "sku_id", "refund_type", "refund_num", "refund_amount",
                          "refund_reason_type", "refund_reason_txt", "create_time"],
    "comment_info": ["id", "user_id", "sku_id", "spu_id", "order_id", "appraise", "comment_txt", "nick_name",
                     "create_time"],
    "cart_info": ["id", "user_id", "sku_id", "sku_num"],
    "user_info": ["id", "name", "user_level", "login_name", "phone_num", "email", "gender", "birthday"],
    "user_info_sup_msg": ["uid", "height", "unit_height", "weight", "unit_weight", "create_ts"],
}

ORDER_DETAIL_FACT = [
    "id", "order_id", "user_id", "sku_id", "sku_name", "province_id", "activity_id", "activity_rule_id",
    "coupon_id", "date_id", "create_time", "sku_num", "split_original_amount", "split_activity_amount",
    "split_coupon_amount", "split_total_amount", "ts_ms",
]
PAYMENT_FACT = [
    "order_detail_id", "order_id", "user_id", "sku_id", "sku_name", "province_id", "activity_id",
    "activity_rule_id", "coupon_id", "payment_type_code", "payment_type_name", "callback_time", "sku_num",
    "split_original_amount", "split_activity_amount", "split_coupon_amount", "split_payment_amount", "ts_ms",
]
REFUND_FACT = [
    "id", "user_id", "order_id", "sku_id", "province_id", "date_id", "create_time", "refund_type_code",
    "refund_type_name", "refund_reason_type_code", "refund_reason_type_name", "refund_reason_txt", "refund_num",
    "refund_amount", "ts_ms",
]
COMMENT_FACT = ["id", "user_id", "sku_id", "appraise", "appraise_name", "comment_txt", "ts_ms"]
