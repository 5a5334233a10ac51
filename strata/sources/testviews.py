"""Source views of the indicator domain, derived by Spark from the driver's
TPC-H-like tables.

The driver data has no literacy tables, so each source the pipeline expects
(state and municipality indicators, pupil microdata, targets, code dictionary,
name directories, event messages) is a view over orders / customer / lineitem /
supplier / nation / region / events.  Defects are planted by fixed arithmetic
(no hash functions, which differ between engines) so that the same views can
be written in DuckDB SQL for the oracle:

* mean scores are divided by 997.3 / 99.7 (not 1000 / 100) so that they are
  never short decimals sitting exactly on a rounding boundary;
* ``k = place*7 + ano*3 + serie*5 + rede`` per indicator row;
  rate NULL when ``k % 17 = 0``, else rate + 100 when ``k % 23 = 0``;
  all levels NULL when ``k % 19 = 0``; level 4 NULL when ``k % 29 = 0``;
  a second copy with half the rate when ``k % 10 = 0``.
* directories leave out a few codes and list every row twice;
* the dictionary leaves out one code per table (decode gives NULL);
* targets lack the 2024 value for keys divisible by 9;
* events with ``event_id % 10 = 0`` are delivered twice, the second time later
  and with a changed value; ``event_id % 13 = 0`` messages are malformed.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from strata.functions import LEVELS, TARGET_YEARS, VALID_STATES

# Dictionary rows (id_tabela, nome_coluna, chave, valor).
# uf/serie '5', municipio/serie '82' and alunos/preenchimento_caderno '2' are
# left out on purpose so that their decode yields NULL.
DICTIONARY_ROWS = [
    ("uf", "serie", "1", "1º ano EF"),
    ("uf", "serie", "2", "2º ano EF"),
    ("uf", "serie", "3", "3º ano EF"),
    ("uf", "serie", "4", "4º ano EF"),
    ("uf", "rede", "1", "Federal"),
    ("uf", "rede", "2", "Estadual"),
    ("uf", "rede", "6", "Municipal"),
    ("uf", "rede", "8", "Privada"),
    ("uf", "rede", "13", "Pública"),
    ("municipio", "serie", "65", "2º ano EF"),
    ("municipio", "serie", "78", "3º ano EF"),
    ("municipio", "rede", "70", "Municipal"),
    ("municipio", "rede", "79", "Estadual"),
    ("alunos", "serie", "65", "2º ano EF"),
    ("alunos", "serie", "78", "3º ano EF"),
    ("alunos", "serie", "82", "4º ano EF"),
    ("alunos", "rede", "70", "Municipal"),
    ("alunos", "rede", "79", "Estadual"),
    ("alunos", "presenca", "0", "Ausente"),
    ("alunos", "presenca", "1", "Presente"),
    ("alunos", "preenchimento_caderno", "0", "Preenchido"),
    ("alunos", "preenchimento_caderno", "1", "Parcial"),
    ("alunos", "alfabetizado", "0", "Não alfabetizado"),
    ("alunos", "alfabetizado", "1", "Alfabetizado"),
]

DICTIONARY_SCHEMA = T.StructType([
    T.StructField("id_tabela", T.StringType()),
    T.StructField("nome_coluna", T.StringType()),
    T.StructField("chave", T.StringType()),
    T.StructField("valor", T.StringType()),
])

# Event type of the driver data -> event kind of the domain.
EVENT_KINDS = {
    "view": "medicao_desempenho",
    "click": "medicao_desempenho",
    "purchase": "atualizacao_meta",
    "error": "revisao_indicador",
    "signup": "revisao_indicador",
}
# Network names.
NETWORKS = ["Municipal", "Estadual", "Privada", "Federal"]


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def state_code(key: Column) -> Column:
    """Nation-like key 0..24 -> state code; 23 is outside the domain, 24 is dirty."""
    codes = F.array(*[F.lit(c) for c in VALID_STATES])
    return (F.when(key == 23, F.lit("XX"))
            .when(key == 24, F.lit(" sp "))
            .otherwise(F.element_at(codes, (key + 1).cast("int"))))


def _share(cond: Column) -> Column:
    """Percentage of the rows: counts, of which all shares of a group have the second in common, keep its hash table small."""
    return F.count_if(cond).cast("double") / F.count(F.lit(1)).cast("double") * F.lit(100.0)


def _plant_defects(df: DataFrame, place: str) -> DataFrame:
    k = (F.col(place).cast("long") * 7 + F.col("ano") * 3 + F.col("serie") * 5 + F.col("rede"))
    rate = F.col("taxa_alfabetizacao")
    null = F.lit(None).cast("double")
    keyed = df.withColumn("_k", k)
    kk = F.col("_k")
    no_levels = kk % 19 == 0
    copies = F.when(kk % 10 == 0, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))
    planted = keyed.select(
        *[c for c in df.columns if c not in LEVELS and c != "taxa_alfabetizacao"],
        F.when(kk % 17 == 0, null).when(kk % 23 == 0, rate + F.lit(100.0)).otherwise(rate)
        .alias("taxa_alfabetizacao"),
        *[F.when(no_levels | ((kk % 29 == 0) & F.lit(lv == LEVELS[4])), null).otherwise(F.col(lv)).alias(lv)
          for lv in LEVELS],
        F.explode(copies).alias("_copy"))
    return planted.withColumn(
        "taxa_alfabetizacao",
        F.when(F.col("_copy") == 1, F.col("taxa_alfabetizacao") / F.lit(2.0))
        .otherwise(F.col("taxa_alfabetizacao"))).drop("_copy")


def src_uf(spark: SparkSession, sf_dir: str) -> DataFrame:
    """State indicators: orders of customers grouped by year, nation, priority, segment."""
    orders = table(spark, sf_dir, "orders").select(
        "o_custkey", "o_orderstatus", "o_totalprice", "o_orderdate", "o_orderpriority")
    customer = table(spark, sf_dir, "customer").select("c_custkey", "c_nationkey", "c_mktsegment")
    # Both sides grow with the data: a shuffle join on the customer key.
    joined = orders.join(customer, orders.o_custkey == customer.c_custkey, "inner")
    level = F.least(F.lit(8), F.floor(F.col("o_totalprice") / F.lit(55555)))
    grouped = joined.groupBy(
        F.year("o_orderdate").cast("long").alias("ano"),
        F.col("c_nationkey").cast("long").alias("place"),
        F.substring("o_orderpriority", 1, 1).cast("long").alias("serie"),
        (F.ascii("c_mktsegment") - 64).cast("long").alias("rede"),
    ).agg(
        _share(F.col("o_orderstatus") != "F").alias("taxa_alfabetizacao"),
        (F.avg("o_totalprice") / F.lit(997.3)).alias("media_portugues"),
        *[_share(level == k).alias(LEVELS[k]) for k in range(9)],
    )
    planted = _plant_defects(grouped, "place")
    return planted.select(
        "ano", state_code(F.col("place")).alias("sigla_uf"), "serie", "rede",
        "taxa_alfabetizacao", "media_portugues", *LEVELS)


def src_municipio(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Municipality indicators: line items grouped by year, supplier, flag, status."""
    # Groups have a few rows each, so rows are dealt out before they are summed up: hash tables of partial sums would be as large as the input.
    keys = ["ano", "id_municipio", "serie", "rede"]
    items = table(spark, sf_dir, "lineitem").select(
        F.year("l_shipdate").cast("long").alias("ano"),
        F.col("l_suppkey").cast("long").alias("id_municipio"),
        F.ascii("l_returnflag").cast("long").alias("serie"),
        F.ascii("l_linestatus").cast("long").alias("rede"),
        (F.col("l_quantity") >= 25).alias("reached"), "l_extendedprice").repartition(*keys)
    level = F.least(F.lit(8), F.floor(F.col("l_extendedprice") / F.lit(11700)))
    grouped = items.groupBy(*keys).agg(
        _share(F.col("reached")).alias("taxa_alfabetizacao"),
        (F.avg("l_extendedprice") / F.lit(99.7)).alias("media_portugues"),
        *[_share(level == k).alias(LEVELS[k]) for k in range(9)],
    )
    planted = _plant_defects(grouped, "id_municipio")
    return planted.select(
        "ano", "id_municipio", "serie", "rede", "taxa_alfabetizacao", "media_portugues", *LEVELS)


def src_alunos(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pupil microdata: one row per line item (the largest source)."""
    items = table(spark, sf_dir, "lineitem")
    proficiency = F.col("l_extendedprice") / F.lit(100.0)
    return items.select(
        F.year("l_shipdate").cast("long").alias("ano"),
        F.col("l_suppkey").cast("long").alias("id_municipio"),
        F.col("l_partkey").cast("string").alias("id_escola"),
        (F.col("l_orderkey") * 10 + F.col("l_linenumber")).cast("string").alias("id_aluno"),
        F.col("l_linenumber").cast("string").alias("caderno"),
        F.ascii("l_returnflag").cast("long").alias("serie"),
        F.ascii("l_linestatus").cast("long").alias("rede"),
        F.when(F.col("l_orderkey") % 7 != 0, F.lit(1)).otherwise(F.lit(0)).cast("long").alias("presenca"),
        (F.col("l_linenumber") % 3).cast("long").alias("preenchimento_caderno"),
        F.when(proficiency >= 525, F.lit(1)).otherwise(F.lit(0)).cast("long").alias("alfabetizado"),
        F.when((F.col("l_orderkey") + F.col("l_linenumber")) % 37 == 0, F.lit(None).cast("double"))
        .otherwise(proficiency).alias("proficiencia"),
        F.col("l_quantity").alias("peso_aluno"),
    )


def literal_table(spark: SparkSession, rows: list[tuple], schema: T.StructType) -> DataFrame:
    """A small fixed table built JVM-side (a local relation, no Python workers)."""
    def lit(v):
        return "NULL" if v is None else "'" + str(v).replace("'", "''") + "'"
    values = ", ".join("(" + ", ".join(lit(v) for v in r) + ")" for r in rows)
    names = ", ".join(f.name for f in schema.fields)
    casts = ", ".join(f"CAST({f.name} AS {f.dataType.simpleString()}) AS {f.name}" for f in schema.fields)
    return spark.sql(f"SELECT {casts} FROM VALUES {values} AS t({names})")


def dictionary(spark: SparkSession) -> DataFrame:
    return literal_table(spark, DICTIONARY_ROWS, DICTIONARY_SCHEMA)


def doubled(df: DataFrame) -> DataFrame:
    """Every row twice, as the directories list their codes."""
    return df.unionByName(df)


def dir_uf(spark: SparkSession, sf_dir: str) -> DataFrame:
    nation = table(spark, sf_dir, "nation").where(F.col("n_nationkey") % 11 != 5)
    once = nation.select(state_code(F.col("n_nationkey")).alias("sigla"), F.col("n_name").alias("nome"))
    return once.unionByName(once)


def dir_municipio(spark: SparkSession, sf_dir: str) -> DataFrame:
    supplier = table(spark, sf_dir, "supplier").where(F.col("s_suppkey") % 11 != 0)
    once = supplier.select(F.col("s_suppkey").cast("string").alias("id_municipio"),
                           F.col("s_name").alias("nome"))
    return once.unionByName(once)


def _targets(base: Column, missing: dict[int, Column]) -> list[Column]:
    """Seven yearly targets ``base + 2.5 * (year - 2024)``; NULL where ``missing[year]``."""
    out = []
    for y in TARGET_YEARS:
        value = (base + F.lit(2.5 * (y - 2024))).cast("double")
        if y in missing:
            value = F.when(missing[y], F.lit(None).cast("double")).otherwise(value)
        out.append(value.alias(f"meta_alfabetizacao_{y}"))
    return out


def src_meta_uf(spark: SparkSession, sf_dir: str) -> DataFrame:
    customer = table(spark, sf_dir, "customer")
    grouped = customer.groupBy("c_nationkey", "c_mktsegment").agg(
        (F.avg("c_acctbal") / F.lit(100.0)).alias("taxa_alfabetizacao"),
        _share(F.col("c_acctbal") > 0).alias("percentual_participacao"))
    key = F.col("c_nationkey").cast("long")
    base = F.lit(50) + (key * 7) % 30 + F.ascii("c_mktsegment") % 3
    return grouped.select(
        (F.lit(2022) + key % 2).cast("long").alias("ano"),
        state_code(key).alias("sigla_uf"),
        F.col("c_mktsegment").alias("rede"),
        "taxa_alfabetizacao",
        *_targets(base, {2024: key % 9 == 0}),
        "percentual_participacao")


def src_meta_municipio(spark: SparkSession, sf_dir: str) -> DataFrame:
    supplier = table(spark, sf_dir, "supplier")
    key = F.col("s_suppkey").cast("long")
    years = supplier.withColumn("ano", F.explode(F.array(F.lit(2023).cast("long"), F.lit(2024).cast("long"))))
    base = F.lit(50) + (key * 7) % 30 + (F.col("ano") - 2023)
    return years.select(
        "ano",
        key.alias("id_municipio"),
        F.when(key % 2 == 0, F.lit("Municipal")).otherwise(F.lit("Estadual")).alias("rede"),
        (F.col("s_acctbal") / F.lit(100.0)).alias("taxa_alfabetizacao"),
        *_targets(base, {2024: key % 9 == 0}),
        F.col("s_nationkey").cast("long").alias("nivel_alfabetizacao"),
        (F.lit(90.0) + key % 10).cast("double").alias("percentual_participacao"))


def src_meta_brasil(spark: SparkSession, sf_dir: str) -> DataFrame:
    region = table(spark, sf_dir, "region")
    key = F.col("r_regionkey").cast("long")
    base = F.lit(60) + key * 2
    return region.select(
        F.lit(2023).cast("long").alias("ano"),
        F.col("r_name").alias("rede"),
        (F.lit(70.0) + key).cast("double").alias("taxa_alfabetizacao"),
        *_targets(base, {2027: key == 3}),
        F.lit(95.0).alias("percentual_participacao"))


def event_deliveries(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every delivery of every event message, malformed ones included.

    Columns: the 14 payload fields, ``pubsub_message_id``, ``ingestao_ts``
    (TIMESTAMP_NTZ, UTC wall clock), ``malformed`` and ``delivery`` (0 first, 1 redelivery).
    """
    events = table(spark, sf_dir, "events")
    copies = F.when(F.col("event_id") % 10 == 0, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))
    ev = events.withColumn("_copy", F.explode(copies))
    kind = F.col("event_type")
    tipo = None
    for src, dst in EVENT_KINDS.items():
        tipo = F.when(kind == src, F.lit(dst)) if tipo is None else tipo.when(kind == src, F.lit(dst))
    tipo = tipo.otherwise(F.lit(None).cast("string"))
    v = F.col("value") + F.col("_copy").cast("double")
    measured = kind.isin("view", "click")
    target = kind == "purchase"
    revised = kind.isin("error", "signup")
    null = F.lit(None).cast("double")
    network = None
    for i, name in enumerate(NETWORKS):
        c = F.col("user_id") % len(NETWORKS) == i
        network = F.when(c, F.lit(name)) if network is None else network.when(c, F.lit(name))
    return ev.select(
        tipo.alias("tipo"),
        F.col("ts").alias("timestamp"),
        (F.lit(2021) + F.col("user_id") % 3).cast("long").alias("ano"),
        state_code(F.col("user_id") % 25).alias("sigla_uf"),
        F.concat((F.lit(2) + F.col("event_id") % 2).cast("string"), F.lit("º ano EF")).alias("serie"),
        network.alias("rede"),
        F.lit("events").alias("source"),
        F.when(measured, v).otherwise(null).alias("taxa_alfabetizacao"),
        F.when(measured, v + F.lit(500.0)).otherwise(null).alias("media_portugues"),
        F.when(target, v).otherwise(null).alias("meta_2030"),
        F.when(target, v / F.lit(4.0)).otherwise(null).alias("percentual_atingido"),
        F.when(revised, v).otherwise(null).alias("taxa_anterior"),
        F.when(revised, v + F.lit(1.0)).otherwise(null).alias("taxa_revisada"),
        F.when(revised, F.col("props")).otherwise(F.lit(None).cast("string")).alias("motivo_revisao"),
        F.col("event_id").cast("string").alias("pubsub_message_id"),
        (F.col("ts") + F.make_dt_interval(mins=F.lit(1) + F.col("_copy") * 5)).alias("ingestao_ts"),
        (F.col("event_id") % 13 == 0).alias("malformed"),
        F.col("_copy").alias("delivery"),
    )


def bronze_events_view(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every delivery as a bronze row (what a message says, whether or not its landed text is cut)."""
    return event_deliveries(spark, sf_dir).drop("malformed", "delivery")


_SOURCES = {
    "uf": src_uf,
    "municipio": src_municipio,
    "alunos": src_alunos,
    "meta_brasil": src_meta_brasil,
    "meta_uf": src_meta_uf,
    "meta_municipio": src_meta_municipio,
    "dicionario": lambda spark, sf_dir: dictionary(spark),
    "dir_uf": dir_uf,
    "dir_municipio": dir_municipio,
}


class Sources(Mapping):
    """All batch sources by the name the bronze builders expect; each view is
    built on first use and then shared (same DataFrame object)."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark, self.sf_dir, self._built = spark, sf_dir, {}

    def __getitem__(self, name: str) -> DataFrame:
        if name not in self._built:
            self._built[name] = _SOURCES[name](self.spark, self.sf_dir)
        return self._built[name]

    def __iter__(self):
        return iter(_SOURCES)

    def __len__(self):
        return len(_SOURCES)


def sources(spark: SparkSession, sf_dir: str) -> Sources:
    return Sources(spark, sf_dir)
