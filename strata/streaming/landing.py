"""Message envelopes for the landing folder, derived by Spark from the event
deliveries of the test data (the stand-in for a message broker export)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from strata.schemas import EVENT_PAYLOAD


def _iso_utc(c: Column) -> Column:
    # TIMESTAMP_NTZ holds the UTC wall clock; formatting it does not depend
    # on the session time zone.
    return F.concat(F.date_format(c, "yyyy-MM-dd'T'HH:mm:ss.SSSSSS"), F.lit("+00:00"))


def envelopes(deliveries: DataFrame) -> DataFrame:
    """One JSON line per delivery: ``{"message_id", "publish_time", "data"}``.

    Well-formed payloads carry the non-NULL fields plus one unknown field;
    malformed ones are cut short (every second one) or have ``ano`` as text.
    """
    fields = []
    for f in EVENT_PAYLOAD.fields:
        fields.append(_iso_utc(F.col(f.name)).alias(f.name) if f.name == "timestamp" else F.col(f.name))
    fields.append(F.lit("ignored").alias("campo_desconhecido"))
    payload = F.to_json(F.struct(*fields))
    head = F.concat(F.lit('{"tipo": "'), F.coalesce(F.col("tipo"), F.lit("")), F.lit('", "ano": '))
    broken = (F.when(F.col("pubsub_message_id").cast("long") % 2 == 0, head)
              .otherwise(F.concat(head, F.lit('"x"}'))))
    data = F.when(F.col("malformed"), broken).otherwise(payload)
    envelope = F.to_json(F.struct(
        F.col("pubsub_message_id").alias("message_id"),
        _iso_utc(F.col("ingestao_ts")).alias("publish_time"),
        data.alias("data")))
    return deliveries.select(envelope.alias("value"))


def write_wave(deliveries: DataFrame, landing_dir: str) -> None:
    """Append one wave of deliveries to the landing folder as JSON lines."""
    envelopes(deliveries).write.mode("append").text(landing_dir)
