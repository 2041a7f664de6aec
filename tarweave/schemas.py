"""Row types shared by the operators."""

from pyspark.sql import types as T

ENTRY = T.StructType([
    T.StructField("shard", T.StringType()),
    T.StructField("pos", T.LongType()),
    T.StructField("fname", T.StringType()),
    T.StructField("url", T.StringType()),
    T.StructField("offset", T.LongType()),
    T.StructField("size", T.LongType()),
    T.StructField("data", T.BinaryType()),
])

# The fields of Spark's own image struct, so that either source fits.
IMAGE = T.StructType([
    T.StructField("origin", T.StringType()),
    T.StructField("height", T.IntegerType()),
    T.StructField("width", T.IntegerType()),
    T.StructField("nChannels", T.IntegerType()),
    T.StructField("mode", T.IntegerType()),
    T.StructField("data", T.BinaryType()),
])

CAPTION = T.StructType([
    T.StructField("txt", T.StringType()),
    T.StructField("prompt", T.StringType()),
    T.StructField("url", T.StringType()),
    T.StructField("key", T.StringType()),
    T.StructField("pos", T.LongType()),
    T.StructField("source_url", T.StringType()),
    T.StructField("score", T.DoubleType()),
    T.StructField("params", T.MapType(T.StringType(), T.DoubleType())),
])

# One line for each run that read a shard; of several the latest counts.
MANIFEST = T.StructType([
    T.StructField("shard", T.StringType()),
    T.StructField("rows_in", T.LongType()),
    T.StructField("rows_out", T.LongType()),
    T.StructField("rejected", T.LongType()),
    T.StructField("batches", T.LongType()),
    T.StructField("damage", T.StringType()),
    T.StructField("seconds", T.DoubleType()),
    T.StructField("written", T.LongType()),
])

REJECT = T.StructType([
    T.StructField("pos", T.LongType()),
    T.StructField("key", T.StringType()),
    T.StructField("error", T.StringType()),
])
