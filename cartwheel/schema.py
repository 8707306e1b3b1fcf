"""Explicit schemas of the raw zone (no inference at read time)."""

from pyspark.sql import types as T

RAW_EVENTS = T.StructType(
    [
        T.StructField("event_id", T.StringType()),
        T.StructField("event_timestamp", T.TimestampNTZType()),
        T.StructField("event_date", T.DateType()),
        T.StructField("event_name", T.StringType()),
        T.StructField("user_pseudo_id", T.StringType()),
        T.StructField("customer_id", T.StringType()),
        T.StructField("ga_session_id", T.StringType()),
        T.StructField("device_category", T.StringType()),
        T.StructField("country", T.StringType()),
        T.StructField("campaign_id", T.StringType()),
        T.StructField("traffic_source", T.StringType()),
        T.StructField("traffic_medium", T.StringType()),
        T.StructField("item_id", T.StringType()),
        T.StructField("item_category", T.StringType()),
        T.StructField("item_name", T.StringType()),
        T.StructField("quantity", T.DoubleType()),
        T.StructField("purchase_revenue", T.DoubleType()),
    ]
)

RAW_AD_SPEND = T.StructType(
    [
        T.StructField("date", T.DateType()),
        T.StructField("campaign_id", T.StringType()),
        T.StructField("channel", T.StringType()),
        T.StructField("source", T.StringType()),
        T.StructField("impressions", T.LongType()),
        T.StructField("clicks", T.LongType()),
        T.StructField("cost", T.DoubleType()),
    ]
)

RAW_CRM = T.StructType(
    [
        T.StructField("customer_id", T.StringType()),
        T.StructField("signup_date", T.DateType()),
        T.StructField("plan", T.StringType()),
        T.StructField("region", T.StringType()),
    ]
)

# Nested analytics export (one row per hit) as consumed by the export flattener.
GA4_EVENTS = T.StructType(
    [
        T.StructField("event_date", T.StringType()),
        T.StructField("event_timestamp", T.LongType()),
        T.StructField("event_name", T.StringType()),
        T.StructField("user_pseudo_id", T.StringType()),
        T.StructField("user_id", T.StringType()),
        T.StructField(
            "event_params",
            T.ArrayType(
                T.StructType(
                    [
                        T.StructField("key", T.StringType()),
                        T.StructField("value", T.StructType([T.StructField("int_value", T.LongType())])),
                    ]
                )
            ),
        ),
        T.StructField("device", T.StructType([T.StructField("category", T.StringType())])),
        T.StructField("geo", T.StructType([T.StructField("country", T.StringType())])),
        T.StructField(
            "traffic_source",
            T.StructType(
                [
                    T.StructField("name", T.StringType()),
                    T.StructField("source", T.StringType()),
                    T.StructField("medium", T.StringType()),
                ]
            ),
        ),
        T.StructField(
            "items",
            T.ArrayType(
                T.StructType(
                    [
                        T.StructField("item_id", T.StringType()),
                        T.StructField("item_name", T.StringType()),
                        T.StructField("item_category", T.StringType()),
                        T.StructField("quantity", T.LongType()),
                    ]
                )
            ),
        ),
        T.StructField("ecommerce", T.StructType([T.StructField("purchase_revenue_in_usd", T.DoubleType())])),
    ]
)
