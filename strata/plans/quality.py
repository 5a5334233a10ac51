"""Data-quality rules as data, evaluated as Spark jobs.

A rule names a layer, a table and what to count; rules are plain data (row
filters are SQL text), so the same objects also generate the oracle SQL
without a Spark session.  ``evaluate`` turns a rule
list into one small result DataFrame
(layer, table_name, rule, kind, severity, violations, total, passed):

* every per-row rule of one table (range, NULLs, level sums, domain, missing
  values, non-empty) is fused into ONE aggregation over that table - one scan
  per table instead of one query per rule;
* duplicate keys, row ratio, coverage and references are aggregations and
  anti-joins of their own; all results are unioned.

``enforce`` collects only the result rows (one per rule) and raises when a
check failed; reports (kind ``report``) never fail.
"""

from __future__ import annotations

from dataclasses import dataclass, field
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from strata.plans.registry import SPECS
from strata.functions import LEVELS, VALID_STATES, any_null, col_sum

ROW_KINDS = {"non_empty", "range", "nulls", "level_sum", "domain", "missing"}
def _share_pct() -> Column:
    """Violations as a percentage of the total; NULL for an empty table."""
    return F.when(F.col("total") > 0, F.col("violations") * F.lit(100.0) / F.col("total")).alias("share_pct")


@dataclass(frozen=True)
class Rule:
    kind: str
    layer: str
    table: str
    params: dict = field(default_factory=dict, hash=False, compare=False)

    @property
    def name(self) -> str:
        p = self.params
        if self.kind == "non_empty":
            return "exists_and_non_empty"
        if self.kind == "range":
            return f"{p['col']}_within_{p['lo']}_{p['hi']}"
        if self.kind == "nulls":
            return "no_nulls(" + ",".join(p["cols"]) + ")"
        if self.kind == "level_sum":
            return f"levels_sum_to_{p['target']}_within_{p['tol']}"
        if self.kind == "domain":
            return f"{p['col']}_in_domain"
        if self.kind == "missing":
            return f"missing_{p['col']}"
        if self.kind == "duplicates":
            return "no_duplicate_keys(" + ",".join(p["keys"]) + ")"
        if self.kind == "row_ratio":
            return f"rows_at_most_{p['other'][0]}.{p['other'][1]}"
        if self.kind == "coverage":
            return f"covers_{p['ref'][0]}.{p['ref'][1]}.{p['ref_key']}"
        if self.kind == "references":
            return f"{p['key']}_references_{p['ref'][0]}.{p['ref'][1]}"
        raise ValueError(self.kind)

    @property
    def is_report(self) -> bool:
        return self.kind == "missing"


def _violation_agg(rule: Rule) -> Column:
    p = rule.params
    if rule.kind == "non_empty":
        return (F.count(F.lit(1)) == 0).cast("long")
    if rule.kind == "range":
        c = F.col(p["col"])
        return F.count_if(c.isNotNull() & ((c < p["lo"]) | (c > p["hi"])))
    if rule.kind == "nulls":
        return F.count_if(any_null(p["cols"]))
    if rule.kind == "level_sum":
        cols = p["cols"]
        return F.count_if(F.col(cols[0]).isNotNull()
                          & (F.abs(col_sum(cols) - F.lit(p["target"])) > F.lit(p["tol"])))
    if rule.kind == "domain":
        c = F.col(p["col"])
        # NOT IN with a NULL value is NULL, so NULL codes are not counted.
        return F.count_distinct(F.when(~c.isin(*p["domain"]), c))
    if rule.kind == "missing":
        return F.count_if(F.col(p["col"]).isNull())
    raise ValueError(rule.kind)


def _one(v: Column, total: Column) -> list[Column]:
    return [v.cast("long").alias("violations"), total.cast("long").alias("total")]


def _single(df: DataFrame, rule: Rule, tables: dict) -> DataFrame:
    """One-row (violations, total) frame for a rule that is not per-row."""
    p = rule.params
    if rule.kind == "duplicates":
        groups = df.groupBy(*p["keys"]).agg(F.count(F.lit(1)).alias("_cnt"))
        return groups.agg(*_one(F.count_if(F.col("_cnt") > 1), F.coalesce(F.sum("_cnt"), F.lit(0))))
    if rule.kind == "row_ratio":
        # Both counts in one aggregate over the stacked tables.
        sides = _side(df.select(F.lit(None).cast("string")), 0).union(
            _side(tables[tuple(p["other"])].select(F.lit(None).cast("string")), 1))
        mine, theirs = F.count_if(F.col("_side") == 0), F.count_if(F.col("_side") == 1)
        bad = (mine > 0) & (theirs > 0) & (mine > theirs)
        return sides.agg(*_one(F.when(bad, 1).otherwise(0), theirs))
    if rule.kind == "coverage":
        ref = tables[tuple(p["ref"])]
        ref = ref.where(F.expr(p["ref_filter_sql"])) if p.get("ref_filter_sql") else ref
        sides = _side(df.select(F.col(p["key"]).cast("string")), 0).union(_side(ref.select(F.col(p["ref_key"]).cast("string")), 1))
        keys = sides.where("_key IS NOT NULL").distinct()
        mine, theirs = F.count_if(F.col("_side") == 0), F.count_if(F.col("_side") == 1)
        return keys.agg(*_one(F.abs(mine - theirs), theirs))
    if rule.kind == "references":
        ref = tables[tuple(p["ref"])]
        ref = ref.where(F.expr(p["ref_filter_sql"])) if p.get("ref_filter_sql") else ref
        keys = ref.select(F.col(p["ref_key"]).alias("_ref_key")).distinct().withColumn("_hit", F.lit(True))
        left = F.col(p["key"]).cast("string") if p.get("cast") else F.col(p["key"])
        return df.join(keys, left == F.col("_ref_key"), "left").agg(
            *_one(F.count_if(F.col("_hit").isNull()), F.count(F.lit(1))))
    raise ValueError(rule.kind)


def _side(keys: DataFrame, side: int) -> DataFrame:
    return keys.toDF("_key").withColumn("_side", F.lit(side))


def _tag(frame: DataFrame, rule: Rule) -> DataFrame:
    return frame.select(
        F.lit(rule.layer).alias("layer"), F.lit(rule.table).alias("table_name"),
        F.lit(rule.name).alias("rule"), F.lit("report" if rule.is_report else "check").alias("kind"),
        F.lit("INFO" if rule.is_report else "ERROR").alias("severity"),
        "violations", "total",
        (F.lit(True) if rule.is_report else F.col("violations") == 0).alias("passed"),
        _share_pct())


def rule_result(counts: DataFrame, rule: Rule, violations: Column, total: Column) -> DataFrame:
    """The result row of a rule whose counts were kept elsewhere (merged states, incremental references)."""
    return _tag(counts.select(*_one(violations, total)), rule)


def evaluate(spark: SparkSession, tables: dict[tuple[str, str], DataFrame],
             rules: list[Rule]) -> DataFrame:
    """Result rows for ``rules``; a rule whose table is absent is skipped,
    except ``non_empty`` which then fails with total 0."""
    parts: list[DataFrame] = []
    by_table: dict[tuple[str, str], list[Rule]] = {}
    for r in rules:
        key = (r.layer, r.table)
        if key not in tables:
            if r.kind == "non_empty":
                missing = spark.range(1).select(*_one(F.lit(1), F.lit(0)))
                parts.append(_tag(missing, r))
            continue
        if r.kind in ROW_KINDS:
            by_table.setdefault(key, []).append(r)
        else:
            needed = [tuple(r.params[k]) for k in ("ref", "other") if k in r.params]
            if all(n in tables for n in needed):
                parts.append(_tag(_single(tables[key], r, tables), r))
    for (layer, table), row_rules in by_table.items():
        aggs = [F.count(F.lit(1)).alias("_total")]
        aggs += [_violation_agg(r).cast("long").alias(f"_v{i}") for i, r in enumerate(row_rules)]
        fused = tables[(layer, table)].agg(*aggs)
        # Unpivot the one-row aggregate: one result row per rule, one scan per table.
        args = [F.lit(len(row_rules))]
        for i, r in enumerate(row_rules):
            args += [F.lit(r.name), F.lit("report" if r.is_report else "check"),
                     F.lit("INFO" if r.is_report else "ERROR"), F.col(f"_v{i}")]
        rows = fused.select(F.lit(layer).alias("layer"), F.lit(table).alias("table_name"),
                            F.stack(*args).alias("rule", "kind", "severity", "violations"),
                            F.col("_total").alias("total"))
        parts.append(rows.select(
            "layer", "table_name", "rule", "kind", "severity", "violations", "total",
            ((F.col("kind") == "report") | (F.col("violations") == 0)).alias("passed"),
            _share_pct()))
    if not parts:
        empty = spark.range(0).select(*_one(F.lit(0), F.lit(0)))
        return _tag(empty, Rule("non_empty", "", ""))
    return reduce(lambda a, b: a.unionByName(b), parts)


class DataQualityError(RuntimeError):
    pass


def enforce(results: DataFrame) -> None:
    """Raise when any check failed (the result has one row per rule)."""
    failed = results.where(~F.col("passed")).select("layer", "table_name", "rule", "violations").collect()
    if failed:
        lines = [f"{r.layer}.{r.table_name}: {r.rule} ({r.violations} violations)" for r in failed]
        raise DataQualityError(f"{len(failed)} check(s) failed:\n" + "\n".join(lines))


# ---- the rule set of the three layers ------------------------------------

BATCH = [(layer, name) for layer, name in SPECS if not name.startswith("streaming_")]
BRONZE_TABLES, SILVER_TABLES, GOLD_TABLES = ([n for lay, n in BATCH if lay == layer] for layer in ("bronze", "silver", "gold"))

# The columns that must be filled in each table.
SILVER_CRITICAL = {
    "alfabetizacao_uf_clean": ["ano", "sigla_uf", "nome_uf", "serie", "rede", "taxa_alfabetizacao"],
    "metas_consolidadas": ["ano", "rede", "taxa_alfabetizacao", "meta_alfabetizacao_2030",
                           "percentual_participacao", "escopo"],
    "alfabetizacao_municipio_clean": ["ano", "id_municipio", "nome_municipio", "serie", "rede",
                                      "taxa_alfabetizacao"],
    "alunos_clean": ["ano", "id_municipio", "nome_municipio", "serie", "rede", "presenca",
                     "preenchimento_caderno", "alfabetizado", "proficiencia", "peso_aluno"],
}
STREAM_CRITICAL = ["tipo", "evento_ts", "sigla_uf", "metrica", "valor", "pubsub_message_id"]
GOLD_CRITICAL = {
    "indicador_por_uf_ano": ["ano", "sigla_uf", "taxa_media", "meta_2030", "gap_meta"],
    "evolucao_temporal_brasil": ["ano", "serie", "taxa_media_brasil", "desvio_padrao", "qtd_estados"],
    "ranking_estados": ["posicao", "sigla_uf", "taxa_media", "meta_2030", "gap_meta", "classificacao"],
    "perfil_desempenho_uf": ["ano", "sigla_uf", "serie", "rede", "taxa_alfabetizacao"],
    "painel_municipios": ["id_municipio", "nome_municipio", "ano", "taxa_media", "meta_2030",
                          "gap_meta", "atingiu_meta"],
}


def bronze_rules() -> list[Rule]:
    t = "alfabetizacao_uf"
    return ([Rule("non_empty", "bronze", b) for b in BRONZE_TABLES] + [
        Rule("duplicates", "bronze", t, {"keys": ["ano", "sigla_uf", "serie", "rede"]}),
        Rule("range", "bronze", t, {"col": "taxa_alfabetizacao", "lo": 0, "hi": 100}),
        Rule("domain", "bronze", t, {"col": "sigla_uf", "domain": VALID_STATES}),
        # A code listed twice would double the rows it decodes.
        Rule("duplicates", "source", "dicionario", {"keys": ["id_tabela", "nome_coluna", "chave"]}),
    ])


def silver_rules(with_stream: bool = True) -> list[Rule]:
    rules = [Rule("non_empty", "silver", s) for s in SILVER_TABLES]
    rules.append(Rule("row_ratio", "silver", "alfabetizacao_uf_clean",
                      {"other": ("bronze", "alfabetizacao_uf")}))
    rules += [Rule("nulls", "silver", t, {"cols": cols}) for t, cols in SILVER_CRITICAL.items()]
    for t in ["alfabetizacao_uf_clean", "alfabetizacao_municipio_clean"]:
        rules.append(Rule("missing", "silver", t, {"col": LEVELS[0]}))
        rules.append(Rule("level_sum", "silver", t, {"cols": LEVELS, "target": 100, "tol": 1}))
    rules.append(Rule("domain", "silver", "alfabetizacao_uf_clean",
                      {"col": "sigla_uf", "domain": VALID_STATES}))
    if with_stream:
        rules.append(Rule("nulls", "silver", "streaming_eventos_clean", {"cols": STREAM_CRITICAL}))
        rules.append(Rule("duplicates", "silver", "streaming_eventos_clean",
                          {"keys": ["pubsub_message_id", "metrica"]}))
    return rules


def gold_rules() -> list[Rule]:
    rules = [Rule("non_empty", "gold", g) for g in GOLD_TABLES]
    rules.append(Rule("coverage", "gold", "ranking_estados", {
        "key": "sigla_uf", "ref": ("silver", "metas_consolidadas"), "ref_key": "sigla_uf",
        "ref_filter_sql": "escopo = 'uf' AND sigla_uf IS NOT NULL"}))
    rules += [Rule("nulls", "gold", t, {"cols": cols}) for t, cols in GOLD_CRITICAL.items()]
    rules.append(Rule("missing", "gold", "perfil_desempenho_uf", {"col": "proporcao_topo"}))
    rules += [
        Rule("references", "gold", "indicador_por_uf_ano", {
            "key": "sigla_uf", "ref": ("silver", "metas_consolidadas"), "ref_key": "sigla_uf",
            "ref_filter_sql": "escopo = 'uf'"}),
        Rule("references", "gold", "painel_municipios", {
            "key": "id_municipio", "cast": True, "ref": ("silver", "metas_consolidadas"),
            "ref_key": "id_municipio", "ref_filter_sql": "escopo = 'municipio'"}),
        Rule("references", "gold", "ranking_estados", {
            "key": "sigla_uf", "ref": ("silver", "alfabetizacao_uf_clean"), "ref_key": "sigla_uf"}),
    ]
    return rules


def rules_for(layer: str = "all", with_stream: bool = True) -> list[Rule]:
    out = []
    if layer in ("bronze", "all"):
        out += bronze_rules()
    if layer in ("silver", "all"):
        out += silver_rules(with_stream)
    if layer in ("gold", "all"):
        out += gold_rules()
    return out
