"""Declared schemas.  Batch tables take their types from the query that builds
them; only the event stream has a fixed schema."""

from pyspark.sql import types as T

# Payload of one event message (14 known fields; unknown fields are ignored,
# missing ones become NULL).
EVENT_PAYLOAD = T.StructType([
    T.StructField("tipo", T.StringType()),
    T.StructField("timestamp", T.TimestampType()),
    T.StructField("ano", T.LongType()),
    T.StructField("sigla_uf", T.StringType()),
    T.StructField("serie", T.StringType()),
    T.StructField("rede", T.StringType()),
    T.StructField("source", T.StringType()),
    T.StructField("taxa_alfabetizacao", T.DoubleType()),
    T.StructField("media_portugues", T.DoubleType()),
    T.StructField("meta_2030", T.DoubleType()),
    T.StructField("percentual_atingido", T.DoubleType()),
    T.StructField("taxa_anterior", T.DoubleType()),
    T.StructField("taxa_revisada", T.DoubleType()),
    T.StructField("motivo_revisao", T.StringType()),
])

CORRUPT_COL = "_corrupt_record"

# Payload plus the column PERMISSIVE parsing fills with the raw text of a
# message that does not fit the schema.
EVENT_PAYLOAD_WITH_CORRUPT = T.StructType(
    EVENT_PAYLOAD.fields + [T.StructField(CORRUPT_COL, T.StringType())])

# Envelope of a delivered message in the landing folder: broker id, publish
# time and the payload as UTF-8 JSON text.
MESSAGE_ENVELOPE = T.StructType([
    T.StructField("message_id", T.StringType()),
    T.StructField("publish_time", T.TimestampType()),
    T.StructField("data", T.StringType()),
])

EVENT_METRICS = [
    "taxa_alfabetizacao", "media_portugues", "meta_2030", "percentual_atingido",
    "taxa_anterior", "taxa_revisada", "motivo_revisao",
]
