"""

Jobs read landed files with these instead of inferring: inference is a full
extra pass over the input, and a schema fixed in code keeps every run's
types the same.
"""

from __future__ import annotations

from pyspark.sql import types as T

# A scraped group record as the scraper writes it (field names as landed).
RAW_GROUP = T.StructType([
    T.StructField("Group ID", T.LongType()),
    T.StructField("Message IDs", T.ArrayType(T.LongType())),
    T.StructField("Text", T.StringType()),
    T.StructField("Message", T.StringType()),
    T.StructField("Date", T.StringType()),
    T.StructField("Sender ID", T.LongType()),
    T.StructField("Media Path", T.ArrayType(T.StringType())),
    T.StructField("Channel", T.StringType()),
])

# One live message as landed by a listener, before folding.
LIVE_MESSAGE = T.StructType([
    T.StructField("channel", T.StringType()),
    T.StructField("id", T.LongType()),
    T.StructField("grouped_id", T.LongType()),
    T.StructField("date", T.StringType()),
    T.StructField("message", T.StringType()),
    T.StructField("text", T.StringType()),
    T.StructField("sender_id", T.LongType()),
    T.StructField("media_kind", T.StringType()),
    T.StructField("mime_type", T.StringType()),
])

DETECTION = T.StructType([
    T.StructField("class", T.StringType()),
    T.StructField("confidence", T.DoubleType()),
    T.StructField("bbox", T.ArrayType(T.DoubleType())),
])
DETECTIONS = T.StructType([
    T.StructField("image_path", T.StringType()),
    T.StructField("detections", T.ArrayType(DETECTION)),
])

# Stored high-water marks.
LAST_ID = T.StructType([
    T.StructField("channel", T.StringType()),
    T.StructField("last_id", T.LongType()),
])
