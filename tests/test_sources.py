"""The source views carry every planted defect the layers must handle."""

from pyspark.sql import functions as F

from strata.catalog import Layers
from strata.sources import testviews as tv
from tests.conftest import SMOKE


def test_indicator_defects_present(spark):
    L = Layers(spark, SMOKE)
    b = L.bronze_uf
    stats = b.agg(
        F.count_if(F.col("taxa_alfabetizacao").isNull()).alias("null_rate"),
        F.count_if(F.col("taxa_alfabetizacao") > 100).alias("out_of_range"),
        F.count_if(F.col("nome_uf").isNull()).alias("no_name"),
        F.count_if(F.col("serie").isNull()).alias("no_label"),
        F.count_if(F.col("proporcao_aluno_nivel_0").isNull()).alias("no_levels"),
        F.count_if(F.col("sigla_uf") == " sp ").alias("dirty_code"),
    ).first().asDict()
    assert all(v > 0 for v in stats.values()), stats
    dup_keys = b.groupBy("ano", "sigla_uf", "serie_codigo", "rede_codigo").count().where("count > 1").count()
    assert dup_keys > 0


def test_directories_repeat_rows_and_miss_codes(spark):
    d = tv.dir_municipio(spark, SMOKE)
    assert d.count() == 2 * d.distinct().count()
    suppliers = tv.table(spark, SMOKE, "supplier").count()
    assert d.distinct().count() < suppliers


def test_event_deliveries(spark):
    events = tv.table(spark, SMOKE, "events")
    deliveries = tv.event_deliveries(spark, SMOKE)
    redelivered = events.where(F.col("event_id") % 10 == 0).count()
    assert deliveries.count() == events.count() + redelivered
    assert deliveries.where("delivery = 1").count() == redelivered
    malformed = deliveries.where("malformed").count()
    assert malformed == deliveries.where(F.col("pubsub_message_id").cast("long") % 13 == 0).count() > 0
    assert tv.bronze_events_view(spark, SMOKE).count() == deliveries.count() > malformed > 0
