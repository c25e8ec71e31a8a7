"""Schemas of the tables and messages that move between the operators."""

from pyspark.sql import types as T

PAGE = T.StructType([
    T.StructField("file_name", T.StringType()),
    T.StructField("page", T.IntegerType()),
    T.StructField("text", T.StringType()),
])

CHUNK = T.StructType([
    T.StructField("file_name", T.StringType()),
    T.StructField("document_page", T.IntegerType()),
    T.StructField("chunk_no", T.IntegerType()),
    T.StructField("text", T.StringType()),
    T.StructField("model", T.StringType()),
    T.StructField("prompt_tokens", T.IntegerType()),
    T.StructField("total_tokens", T.IntegerType()),
    T.StructField("created_date_time", T.TimestampType()),
    T.StructField("chunk_vector", T.ArrayType(T.FloatType(), containsNull=False)),
])

# The same row as it stands in a CSV file: the vector and the time are text.
CHUNK_CSV = T.StructType([
    T.StructField("file_name", T.StringType()),
    T.StructField("document_page", T.StringType()),
    T.StructField("chunk_no", T.IntegerType()),
    T.StructField("text", T.StringType()),
    T.StructField("model", T.StringType()),
    T.StructField("prompt_tokens", T.IntegerType()),
    T.StructField("total_tokens", T.IntegerType()),
    T.StructField("created_date_time", T.StringType()),
    T.StructField("chunk_vector", T.StringType()),
])

EMBEDDING = T.StructType([
    T.StructField("model", T.StringType()),
    T.StructField("prompt_tokens", T.IntegerType()),
    T.StructField("total_tokens", T.IntegerType()),
    T.StructField("embedding", T.ArrayType(T.FloatType(), containsNull=False)),
    T.StructField("error", T.StringType()),
])

# Body of a file notification. Further fields of a real body are ignored.
NOTIFICATION = T.StructType([
    T.StructField("Records", T.ArrayType(T.StructType([
        T.StructField("s3", T.StructType([
            T.StructField("bucket", T.StructType([T.StructField("name", T.StringType())])),
            T.StructField("object", T.StructType([T.StructField("key", T.StringType())])),
        ])),
    ]))),
])

ENVELOPE = T.StructType([
    T.StructField("message_id", T.StringType()),
    T.StructField("body", T.StringType()),
    T.StructField("receive_count", T.IntegerType()),
    T.StructField("ts", T.TimestampType()),
])

# What became of a message: the ledger by key and content, and the dead letters.
OUTCOME = T.StructType(ENVELOPE.fields + [
    T.StructField("key", T.StringType()),
    T.StructField("content_hash", T.StringType()),
    T.StructField("error", T.StringType()),
    T.StructField("route", T.StringType()),
    T.StructField("failure_reason", T.StringType()),
    T.StructField("processed_at", T.TimestampType()),
])

REDRIVEN = T.StructType([
    T.StructField("message_id", T.StringType()),
    T.StructField("processed_at", T.TimestampType()),
])

MANIFEST = T.StructType([
    T.StructField("key", T.StringType()),
    T.StructField("file_hash", T.StringType()),
])

# Fixed value: the reason that goes with a dead letter.
FAILURE_REASON = "Exceeded max retry attempts"
