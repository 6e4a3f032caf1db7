"""Schemas, key columns and the fixed reference values of the data model."""

from __future__ import annotations

from pyspark.sql import types as T

# ---------------------------------------------------------------------------
# These must equal the reference for equal results.
# ---------------------------------------------------------------------------

# Channel display name -> channel username.
CHANNEL_USERNAMES = {
    "Chemed": "@CheMed123",
    "Lobelia4Cosmetics": "@lobelia4cosmetics",
    "TikvahPharma": "@tikvahpharma",
}

# Channels whose photos are downloaded by the exporter.
PHOTO_CHANNELS = ["Chemed", "Lobelia4Cosmetics"]

# Product keywords of the top-products report, in the reference's order.
DEFAULT_KEYWORDS = [
    "paracetamol", "ibuprofen", "antibiotic", "vaccine", "insulin", "syrup",
    "tablet", "cream", "ointment", "capsule", "injection", "mask", "sanitizer",
    "vitamin", "supplement", "drug", "medicine", "pill", "gel", "lotion",
    "diagnostic", "equipment", "test kit", "bandage", "disinfectant", "gloves",
    "thermometer", "blood pressure monitor", "nebulizer", "crutches", "wheelchair",
]

# Keyword flags of fct_messages: column name -> case-insensitive substring.
MESSAGE_FLAGS = {"is_urgent_message": "urgent", "is_vacancy_message": "vacancy"}

# Image file extensions accepted by the detector (compared lower-cased).
IMAGE_EXTENSIONS = ["jpg", "jpeg", "png"]

# Column widths of VARCHAR(255) columns in the raw tables.
VARCHAR_LIMIT = 255

# Exporter cap: latest messages per channel per export.
EXPORT_LIMIT_PER_CHANNEL = 100

# Report argument bounds.
TOP_PRODUCTS_DEFAULT_LIMIT = 10
TOP_PRODUCTS_MAX_LIMIT = 100
SEARCH_MIN_QUERY_LENGTH = 2
REPORT_ROW_LIMIT = 100

# ---------------------------------------------------------------------------
# Schemas
# ---------------------------------------------------------------------------

# One landing-export record (a JSON object of the export array).
EXPORT_SCHEMA = T.StructType([
    T.StructField("message_id", T.LongType()),
    T.StructField("channel", T.StringType()),
    T.StructField("date", T.DateType()),
    T.StructField("text", T.StringType()),
    T.StructField("views", T.IntegerType()),
    T.StructField("forwards", T.IntegerType()),
    T.StructField("has_photo", T.BooleanType()),
    T.StructField("photo_path", T.StringType()),
])
EXPORT_KEYS = [f.name for f in EXPORT_SCHEMA.fields]

RAW_MESSAGES_SCHEMA = T.StructType([
    T.StructField("message_id", T.LongType()),
    T.StructField("channel_name", T.StringType()),
    T.StructField("channel_username", T.StringType()),
    T.StructField("scrape_date", T.DateType()),
    T.StructField("message_date", T.DateType()),
    T.StructField("message_text", T.StringType()),
    T.StructField("message_length", T.IntegerType()),
    T.StructField("views", T.IntegerType()),
    T.StructField("forwards", T.IntegerType()),
    T.StructField("has_photo", T.BooleanType()),
    T.StructField("photo_path", T.StringType()),
])
RAW_MESSAGES_KEY = ["message_id", "channel_username"]

RAW_DETECTIONS_SCHEMA = T.StructType([
    T.StructField("detection_id", T.StringType()),
    T.StructField("message_id", T.LongType()),
    T.StructField("channel_username", T.StringType()),
    T.StructField("image_path", T.StringType()),
    T.StructField("detected_object_class", T.StringType()),
    T.StructField("confidence_score", T.DecimalType(5, 4)),
    T.StructField("detection_timestamp", T.TimestampNTZType()),
])
RAW_DETECTIONS_KEY = ["detection_id"]

FCT_MESSAGES_COLUMNS = [
    "message_sk", "message_id", "channel_sk", "channel_username",
    "message_date_sk", "scrape_date_sk", "message_text", "message_length",
    "views", "forwards", "has_photo", "photo_path",
    "is_urgent_message", "is_vacancy_message", "message_count",
]

IMAGE_DETECTION_REPORT_COLUMNS = [
    "image_detection_sk", "message_sk", "detected_object_class",
    "confidence_score", "image_path", "detection_timestamp",
]
