"""Catalogue entries for the warehouse build (D1-D9), audits (A1-A4) and the flat views
(P1/P4 analysis view, P2/M12 mining feature table)."""

from __future__ import annotations

from functools import reduce

from pyspark.ml.feature import StringIndexer
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.scalars import UNKNOWN_HOUR, UNKNOWN_HYPOTHESIS, UNKNOWN_VEHICLE
from ..operators import audit
from ..sources.tables import EventSource, open_source
from . import load, star
from .registry import fresh, query


def _arr_text(c: str):
    return F.array_join(F.col(c), "|").alias(c)


@query("dim_calendar")
def q_dim_calendar(spark, root):
    return star.dim_calendar(open_source(spark, root))


@query("dim_members")
def q_dim_members(spark, root):
    return star.dim_members(open_source(spark, root))


@query("fact_v1")
def q_fact_v1(spark, root):
    return star.fact_v1(open_source(spark, root))


@query("bridge_hypothesis")
def q_bridge_hypothesis(spark, root):
    return star.bridge_hypothesis(open_source(spark, root))


@query("bridge_vehicle")
def q_bridge_vehicle(spark, root):
    return star.bridge_vehicle(open_source(spark, root))


@query("bridge_actor")
def q_bridge_actor(spark, root):
    return star.bridge_actor(open_source(spark, root))


@query("child_dims")
def q_child_dims(spark, root):
    """dim_actor with a dense surrogate key (the child dimension the queries use)."""
    return star.dim_actor(open_source(spark, root))


@query("child_dim_hypothesis")
def q_child_dim_hypothesis(spark, root):
    return star.dim_hypothesis(open_source(spark, root))


@query("child_dim_vehicle")
def q_child_dim_vehicle(spark, root):
    return star.dim_vehicle(open_source(spark, root))


@query("fact_arrays")
def q_fact_arrays(spark, root):
    """v3 fact; arrays shown as '|'-joined text for order-free comparison."""
    f = star.fact_arrays(open_source(spark, root))
    return f.select(*[_arr_text(c) if c in ("hipotesis", "vehiculos_clase") else c for c in f.columns])


@query("fact_rekeyed")
def q_fact_rekeyed(spark, root):
    s = open_source(spark, root)
    f = star.fact_rekeyed(s)
    return f.select("codigo_accidente", "localidad_id", "nombre", "zona", "gravedad_nivel", "n_actores")


@query("dim_localidad")
def q_dim_localidad(spark, root):
    s = open_source(spark, root)
    return star.dim_localidad(s)


# ------------------------------------------------------------------ further batches
def _two_batches(spark, root):
    """The events in two loads: an early part without the class that sorts first, then all
    events, old and new."""
    ev = open_source(spark, root).events()
    early = ev.where((F.col("anio") < 1995) & (F.col("clase") != F.lit("1-URGENT")))
    members, fact = load.batch_of(early, None, None, 1)
    more, rows = load.batch_of(ev, members, fact, 2)
    return members, more, fact, rows


@query("append_members")
def q_append_members(spark, root):
    """Keys given by the first load stay; members new in the second get the next ones."""
    members, more, _, _ = _two_batches(spark, root)
    return members.withColumn("lote", F.lit(1)).unionByName(more.withColumn("lote", F.lit(2)))


@query("append_facts")
def q_append_facts(spark, root):
    """Events of the first load are left as they are; the second adds only those it lacks."""
    _, _, fact, rows = _two_batches(spark, root)
    return fact.unionByName(rows)


# ------------------------------------------------------------------ audits
# Each source names what it audits (tables and keys of its own layout).
@query("audit_fk")
def q_audit_fk(spark, root):
    return audit.foreign_keys(open_source(spark, root).fk_pairs())


@query("audit_unique")
def q_audit_unique(spark, root):
    return audit.unique_keys(open_source(spark, root).unique_checks())


@query("audit_notnull")
def q_audit_notnull(spark, root):
    return audit.not_null(open_source(spark, root).notnull_checks())


@query("audit_counts")
def q_audit_counts(spark, root):
    """A4: source vs derived row counts of the star build."""
    return audit.row_counts(open_source(spark, root).count_tables())


# ------------------------------------------------------------------ flat views
def flat_events_df(s: EventSource):
    """P1 + P3 + P4: the 13-column analysis view, built from the normalised tables with
    per-event aggregates (no nested arrays are materialised)."""
    if hasattr(s, "flat_rows"):     # nested records carry the job's own rules
        return s.flat_rows()
    ev = s.events().where(F.col("gravedad").isin(*s.levels))
    f = ev.join(s.child_summary(), "codigo_accidente", "left").join(s.event_place(), "cliente", "left")
    return f.select(
        "codigo_accidente", "fecha", "anio", "mes",
        F.coalesce("hora", F.lit(UNKNOWN_HOUR)).alias("hora"), "gravedad", "clase", "localidad",
        F.coalesce("hipotesis", F.lit(UNKNOWN_HYPOTHESIS)).alias("hipotesis"),
        F.coalesce("tipo_vehiculo", F.lit(UNKNOWN_VEHICLE)).alias("tipo_vehiculo"),
        F.coalesce("num_hipotesis", F.lit(0)).alias("num_hipotesis"),
        F.coalesce("num_vehiculos", F.lit(0)).alias("num_vehiculos"),
        F.coalesce("num_actores", F.lit(0)).alias("num_actores"))


@query("flat_events")
def q_flat_events(spark, root):
    return flat_events_df(open_source(spark, root))


_VIEWS: dict = {}


def analysis_view(spark, root):
    """The analysis view built once per session and kept (memory, spilling to
    disk) for the batch job's aggregates and models, as the reference caches its view.
    Lost blocks are rebuilt from lineage."""
    from pyspark import StorageLevel
    key = (fresh(spark, root), root)
    if key not in _VIEWS:
        _VIEWS[key] = flat_events_df(open_source(spark, root)).persist(StorageLevel.MEMORY_AND_DISK)
    return _VIEWS[key]


FEATURE_CATEGORIES = ["clase_siniestro", "localidad", "hipotesis", "tipo_vehiculo", "gravedad"]


def feature_rows(s: EventSource):
    """Mining table (hour with the zero default, locality as a category, counts as
    doubles), rows without a target dropped."""
    if hasattr(s, "mining_rows"):   # nested records carry the loader's own rules
        return s.mining_rows()
    ev = s.events().where(F.col("gravedad").isNotNull() & (F.col("gravedad") != ""))
    f = ev.join(s.child_summary(), "codigo_accidente", "left").join(s.event_place(), "cliente", "left")
    return f.select(
        "codigo_accidente",
        # the hour is already numeric here; the zero default of the mining flavour applies
        F.coalesce(F.col("hora").cast("double"), F.lit(0.0)).alias("hora"),
        "gravedad", F.col("clase").alias("clase_siniestro"),
        F.coalesce(F.col("localidad").cast("string"), F.lit("0")).alias("localidad"),
        F.coalesce("hipotesis", F.lit(UNKNOWN_HYPOTHESIS)).alias("hipotesis"),
        F.coalesce("tipo_vehiculo", F.lit(UNKNOWN_VEHICLE)).alias("tipo_vehiculo"),
        F.coalesce("num_vehiculos", F.lit(0)).cast("double").alias("num_vehiculos"),
        F.coalesce("num_actores", F.lit(0)).cast("double").alias("num_actores"))


def feature_table_df(s: EventSource):
    """P2 + M12: the mining table with its categories indexed in sorted order."""
    flat = feature_rows(s)
    idx = StringIndexer(inputCols=FEATURE_CATEGORIES, outputCols=[c + "_idx" for c in FEATURE_CATEGORIES],
                        stringOrderType="alphabetAsc", handleInvalid="keep")
    return idx.fit(flat).transform(flat)


@query("feature_table")
def q_feature_table(spark, root):
    return feature_table_df(open_source(spark, root))


@query("fact_sample")
def q_fact_sample(spark, root, n: int = 3):
    """P9 + L7: peek at facts whose hypothesis array is non-empty (the migration check);
    the limit is the feature. Ordered by key so the peek is repeatable."""
    f = star.fact_arrays(open_source(spark, root))
    f = f.where(F.size("hipotesis") > 0).orderBy("codigo_accidente").limit(n)
    return f.select(*[_arr_text(c) if c in ("hipotesis", "vehiculos_clase") else c for c in f.columns])


@query("hourly_sentinel")
def q_hourly_sentinel(spark, root):
    """The batch job's hour chart on the analysis view; the -1 sentinel is masked."""
    v = analysis_view(spark, root)
    return v.where(F.col("hora") >= 0).groupBy("hora").agg(F.count(F.lit(1)).alias("total")).orderBy("hora")


# Required output columns of the smoke-checked warehouse queries (A5).
CONTRACTS = {
    "severity_counts": ["descripcion", "total"],
    "severity_by_year": ["anio", "descripcion", "total"],
    "actor_state": ["condicion", "estado", "total"],
    "fatal_hour": ["hora", "muertos", "total"],
    "fatal_cause_top10": ["descripcion", "total"],
    "class_by_severity": ["clase", "gravedad", "total"],
    "place_table": ["nombre", "zona", "total", "con_muertos", "con_heridos", "solo_danos", "tasa_mortalidad"],
    "table_counts": ["tabla", "filas"],
}


@query("audit_contracts")
def q_audit_contracts(spark, root):
    """A5 + U2: each checked query has its required columns and at least one row, as one plan."""
    from .registry import all_queries
    q = all_queries()
    return reduce(DataFrame.unionByName, [audit.output_contract(n, q[n](spark, root), cols) for n, cols in CONTRACTS.items()])
