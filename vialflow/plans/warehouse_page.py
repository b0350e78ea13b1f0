"""The warehouse page's questions (``sql_*``), asked of the event roles with the engine's own
operators.

A count by severity, date or class needs only the events, so it is one aggregate on the scan.
Building the star first and asking its tables gives the same rows (``star.register_star``
offers the written tables to SQL users; a test compares both), at the price of the build.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.scalars import rate_or_zero
from ..operators.aggregates import LEVEL_MEASURES, conditional_counts, count_rows, sum_measures
from ..sources.tables import open_source
from . import catalog
from .registry import query

UNKNOWN_PLACE = "Desconocida"

# questions that the catalogue answers as the page asks them
for _page, _same in {
    "gravedad": catalog.severity_counts, "tendencia": catalog.monthly_trend, "hipotesis": catalog.cause_top10,
    "evolucion_gravedad": catalog.severity_by_year, "actores_estado": catalog.actor_state,
    "causas_fatales": catalog.fatal_cause_top10, "clase_gravedad": catalog.class_by_severity,
}.items():
    query(f"sql_{_page}")(_same)


def _place_codes(s) -> DataFrame:
    """Events per place code with their severity counts; events without a place have the
    unknown code. Events are reduced to one row a customer before they meet the places."""
    per = conditional_counts(s.events(), ["cliente"])
    coded = per.join(s.event_place(), "cliente", "left")
    coded = coded.withColumn("localidad", F.coalesce("localidad", F.lit(s.unknown_place)))
    return sum_measures(coded, "localidad", ["total", *LEVEL_MEASURES.values()])


@query("sql_conteos")
def conteos(spark, root):
    """Rows of the fact and of its calendar, locality and actor dimensions."""
    s = open_source(spark, root)
    ev = s.events()
    dates = ev.select("fecha").where(F.col("fecha").isNotNull()).distinct()
    parts = {"fact_siniestros": ev, "dim_fecha": dates, "dim_localidad": _place_codes(s), "dim_actor": s.actors()}
    return reduce(DataFrame.unionByName, [df.agg(F.lit(name).alias("tabla"), count_rows("filas")) for name, df in parts.items()])


def _hours(s) -> DataFrame:
    ev = s.events().where(F.col("hora").isNotNull())
    return ev.groupBy("hora").agg(F.count_if(F.col("gravedad_nivel") == 1).alias("muertos"), F.count(F.lit(1)).alias("total"))


@query("sql_por_hora")
def por_hora(spark, root):
    """Events by the hour of the event itself."""
    return _hours(open_source(spark, root)).select("hora", "total").orderBy("hora")


@query("sql_hora_fatal")
def hora_fatal(spark, root):
    """Fatal and all events by the hour of the event itself."""
    return _hours(open_source(spark, root)).orderBy("hora")


@query("sql_tabla_localidades")
def tabla_localidades(spark, root):
    """Severity counts and rate per place; events without a place form the unknown one."""
    s = open_source(spark, root)
    named = _place_codes(s).join(s.places().select(F.col("localidad_id").alias("localidad"), "nombre", "zona"), "localidad", "left")
    named = named.select(F.coalesce("nombre", F.lit(UNKNOWN_PLACE)).alias("nombre"), F.coalesce("zona", F.lit(UNKNOWN_PLACE)).alias("zona"),
                         "total", *LEVEL_MEASURES.values())
    g = sum_measures(named, ["nombre", "zona"], ["total", *LEVEL_MEASURES.values()])
    return g.select("nombre", "zona", "total", *LEVEL_MEASURES.values(),
                    rate_or_zero("con_muertos", "total").alias("tasa_mortalidad")).orderBy(F.desc("con_muertos"), "nombre")
