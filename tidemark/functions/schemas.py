"""Schemas of the records the operators and reports read. Nothing is inferred."""

from pyspark.sql import types as T


_TYPES = {
    "string": T.StringType(),
    "int": T.IntegerType(),
    "bigint": T.LongType(),
    "double": T.DoubleType(),
    "boolean": T.BooleanType(),
    "timestamp": T.TimestampType(),
}


def _schema(columns: str) -> T.StructType:
    """Flat schema from ``name type, ...``; needs no session, unlike DDL."""
    named = [column.split() for column in columns.split(", ")]
    return T.StructType([T.StructField(name, _TYPES[kind]) for name, kind in named])


WORD = _schema("word string, count int")
TAGGED_TEXT = _schema("lang string, text string")
NAMED_EVENT = _schema("event_time timestamp, event_name string, description string")
VALUED_EVENT = _schema(
    "event_time timestamp, event_name string, description string, value int"
)
CLICK = _schema("user_id string, click_time timestamp")
BOOKING = _schema("geo_region string, event_time timestamp, booking_count int")
BUTTON_CLICK = _schema("user_id string, button string, click_count int, time timestamp")
APP_EVENT = _schema("store string, app_id string, event_type string, event_time bigint")
CSV_SAMPLE = _schema("value string, id int")
COMMENT = _schema("comment_id string, time bigint, user string, topic string, acronym string")
ORDER = _schema("id string, order_time timestamp")
DELIVERY = _schema("id string, order_id string, delivery_time timestamp")
RAW_USAGE = _schema("app_name string, date string, time string, duration string")
USER_BEHAVIOR = _schema(
    "user_id int, item_id int, category_id int, behavior string, ts string"
)
SENSOR_READING = _schema("id string, timestamp bigint, temperature double")
USER_ROW = _schema("id bigint, rating int, subscription boolean")
