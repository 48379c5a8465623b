"""Declared schemas. Nothing is inferred from data."""

from pyspark.sql import types as T

# Wire schema of one geo event message (JSON). Spark's from_json returns every
# field nullable whatever is declared here, so required fields are checked by
# the cleaning stage, not by the schema.
GEO_EVENT = T.StructType(
    [
        T.StructField("clientId", T.StringType(), True),
        T.StructField("cellId", T.StringType(), False),
        T.StructField("latitude", T.DoubleType(), False),
        T.StructField("longitude", T.DoubleType(), False),
        T.StructField("signalDbm", T.IntegerType(), True),
        T.StructField("congestion", T.IntegerType(), True),
        T.StructField("technology", T.StringType(), False),
        T.StructField("timestamp", T.LongType(), False),  # epoch millis, UTC
    ]
)

GEO_EVENT_FIELDS = [f.name for f in GEO_EVENT.fields]

CONSENT = T.StructType(
    [
        T.StructField("clientId", T.StringType(), True),
        T.StructField("hasConsent", T.BooleanType(), True),
        T.StructField("segment", T.StringType(), True),
        T.StructField("targetCells", T.StringType(), True),  # comma separated cell ids
        T.StructField("campaignsSent", T.IntegerType(), True),  # this month
    ]
)

CELL = T.StructType(
    [
        T.StructField("cellId", T.StringType(), True),
        T.StructField("campaignActive", T.BooleanType(), True),
        T.StructField("congestionThreshold", T.IntegerType(), True),
        T.StructField("city", T.StringType(), True),
        T.StructField("zone", T.StringType(), True),
    ]
)

# Externally produced decision replies (one JSON text per candidate).
DECISION_REPLY = T.StructType(
    [
        T.StructField("decision", T.StringType(), True),
        T.StructField("reasoning", T.StringType(), True),
        T.StructField("smsText", T.StringType(), True),
    ]
)

# Reply table: the replies of an outside service, by window, client and cell.
REPLY = T.StructType(
    [
        T.StructField("windowStart", T.LongType(), True),  # epoch millis
        T.StructField("clientId", T.StringType(), True),
        T.StructField("cellId", T.StringType(), True),
        T.StructField("reply", T.StringType(), True),  # the service's text
        T.StructField("repliedAt", T.LongType(), True),  # epoch millis
    ]
)

ALERT_COLUMNS = [
    "clientId",
    "cellId",
    "city",
    "congestion",
    "technology",
    "segment",
    "aiDecision",
    "aiReasoning",
    "smsText",
    "timestamp",
]

ALERT = T.StructType(
    [
        T.StructField("clientId", T.StringType(), True),
        T.StructField("cellId", T.StringType(), True),
        T.StructField("city", T.StringType(), True),
        T.StructField("congestion", T.IntegerType(), True),
        T.StructField("technology", T.StringType(), True),
        T.StructField("segment", T.StringType(), True),
        T.StructField("aiDecision", T.StringType(), True),
        T.StructField("aiReasoning", T.StringType(), True),
        T.StructField("smsText", T.StringType(), True),
        T.StructField("timestamp", T.StringType(), True),
    ]
)
