"""Star-schema build (D1-D9): calendar and member dimensions, the fact with foreign keys,
bridges, child dimensions, the array-denormalised fact and the locality re-key.

All steps are DataFrame functions; ``build_star`` writes them as one job graph. Dimension joins
carry no hints; fact <-> child joins are shuffle joins on the event key, and the children of an
event are one row before they meet the fact.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions.scalars import date_key, month_name, weekday_name
from ..operators.aggregates import first_per_key
from ..operators.joins import join_small
from ..operators.ranking import row_number_by
from ..sources.tables import EventSource

UNKNOWN = "Desconocida"


# ------------------------------------------------------------------ D1 calendar
def dim_calendar(s: EventSource) -> DataFrame:
    """One row per distinct event date; key yyyymmdd (no numbering window needed)."""
    d = s.events().where(F.col("fecha").isNotNull()).select("fecha").distinct()
    return d.select(
        date_key("fecha").alias("fecha_id"), "fecha",
        F.year("fecha").alias("anio"), F.month("fecha").alias("mes"),
        F.dayofmonth("fecha").alias("dia"), F.quarter("fecha").alias("trimestre"),
        month_name("fecha").alias("nombre_mes"), weekday_name("fecha").alias("dia_semana"),
        F.weekday("fecha").alias("dia_semana_num"))


# ------------------------------------------------------------------ D2 member dimensions
def dim_members(s: EventSource) -> DataFrame:
    """Members of each small dimension, numbered by value within the dimension: the source's
    fixed severities with their levels, and the distinct values of the others but empty ones.

    The window is partitioned by dimension over *distinct* values only, so its size is the
    vocabulary, not the event count."""
    ev = s.events()
    levels = F.array(*[F.struct(F.lit("gravedad").alias("dimension"), F.lit(k).alias("descripcion"), F.lit(v).alias("nivel"))
                       for k, v in s.levels.items()])
    parts = [
        s.spark.range(1).select(F.inline(levels)),
        ev.select(F.lit("clase"), F.col("clase"), F.lit(None).cast("int")),
        *[s.member_values(d).select(F.lit(d), F.col("descripcion"), F.lit(None).cast("int"))
          for d in ("hipotesis", "vehiculo_clase", "condicion")],
    ]
    members = reduce(DataFrame.union, parts).where(F.col("descripcion") != "").distinct()
    w = Window.partitionBy("dimension").orderBy("descripcion")
    return members.select("dimension", F.row_number().over(w).alias("member_id"), "descripcion", "nivel")


def members_of(members: DataFrame, dimension: str, key: str, value: str) -> DataFrame:
    return members.where(F.col("dimension") == dimension).select(
        F.col("member_id").alias(key), F.col("descripcion").alias(value))


# ------------------------------------------------------------------ D3 fact v1
def fact_v1(s: EventSource, members: DataFrame | None = None) -> DataFrame:
    """v1 fact: first record per natural key (W6), foreign keys to calendar, place, level
    and class members (J9), vehicle and actor counts of the surviving record."""
    members = members if members is not None else dim_members(s)
    ev = s.fact_events().select("codigo_accidente", "cliente", "fecha", "hora", "gravedad", "clase")
    lvl = members.where(F.col("dimension") == "gravedad").select(
        F.col("descripcion").alias("gravedad"), F.col("nivel").alias("gravedad_nivel"))
    ev = join_small(ev, lvl, "gravedad", "left")
    ev = join_small(ev, members_of(members, "clase", "clase_id", "clase"), "clase", "left")
    ev = ev.join(s.event_place().withColumnRenamed("localidad", "localidad_id"), "cliente", "left")
    kids = s.child_summary().select("codigo_accidente", "num_vehiculos", "num_actores")
    f = ev.join(kids, "codigo_accidente", "left")
    return f.select(
        "codigo_accidente", date_key("fecha").alias("fecha_id"), "localidad_id", "gravedad_nivel",
        "clase_id", "hora",
        F.coalesce("num_vehiculos", F.lit(0)).alias("n_vehiculos"),
        F.coalesce("num_actores", F.lit(0)).alias("n_actores"))


# ------------------------------------------------------------------ D4-D6 bridges
def bridge_hypothesis(s: EventSource, members: DataFrame | None = None) -> DataFrame:
    """(event, hypothesis) pairs are unique."""
    members = members if members is not None else dim_members(s)
    h = s.hypotheses()
    return join_small(h, members_of(members, "hipotesis", "hipotesis_id", "hipotesis"), "hipotesis") \
        .select("codigo_accidente", "hipotesis_id")


def bridge_vehicle(s: EventSource, members: DataFrame | None = None) -> DataFrame:
    """Vehicles keep duplicates."""
    members = members if members is not None else dim_members(s)
    v = s.vehicles()
    return join_small(v, members_of(members, "vehiculo_clase", "vehiculo_id", "clase"), "clase") \
        .select("codigo_accidente", "vehiculo_id", "servicio")


def bridge_actor(s: EventSource, members: DataFrame | None = None) -> DataFrame:
    members = members if members is not None else dim_members(s)
    a = s.actors()
    return join_small(a, members_of(members, "condicion", "condicion_id", "condicion"), "condicion") \
        .select("codigo_accidente", "condicion_id", "estado", *[c for c in ("sexo",) if c in a.columns])


# ------------------------------------------------------------------ D7 child dimensions
def child_dim(rows: DataFrame, id_name: str, order_cols: list[str]) -> DataFrame:
    """Collapse a bridge + lookup into a child dimension with a dense surrogate key
    numbered in (event, values) order (W3), computed without a single-task window."""
    return row_number_by(rows, order_cols, out=id_name).select(id_name, *rows.columns)


def dim_actor(s: EventSource) -> DataFrame:
    a = s.actors().withColumnRenamed("codigo_accidente", "siniestro_id")
    return child_dim(a, "actor_id", ["siniestro_id", "condicion", "estado"])


def dim_hypothesis(s: EventSource) -> DataFrame:
    h = s.hypotheses().select(F.col("codigo_accidente").alias("siniestro_id"),
                              F.col("hipotesis").alias("descripcion"))
    return child_dim(h, "hipotesis_id", ["siniestro_id", "descripcion"])


def dim_vehicle(s: EventSource) -> DataFrame:
    v = s.vehicles().withColumnRenamed("codigo_accidente", "siniestro_id")
    return child_dim(v, "vehiculo_id", ["siniestro_id", "clase", "servicio"])


# ------------------------------------------------------------------ D8 array fact
def fact_arrays(s: EventSource, unknown_place: int | None = None, with_keys: bool = False) -> DataFrame:
    """v3 fact: severity, class and place inline, hypotheses and vehicle classes as arrays in
    source order (one element a vehicle), the address where the source has one, missing values
    coalesced (level 0, texts 'Desconocida', place ``unknown_place`` - the source's unknown
    code, 0 in the reference data, -1 for the driver tables where 0 is a real place - and empty
    arrays)."""
    unknown_place = s.unknown_place if unknown_place is None else unknown_place
    ev = s.events().join(s.event_place(), "cliente", "left")
    f = ev.join(s.child_profile(), "codigo_accidente", "left")
    empty = F.array().cast("array<string>")
    keys = [F.col("codigo_accidente").alias("siniestro_id"), date_key("fecha").alias("fecha_id"), "hora",
            "anio"] if with_keys else []
    return f.select(
        *keys, "codigo_accidente", F.when(F.col("gravedad_nivel").isNotNull(), F.col("gravedad")).otherwise(UNKNOWN).alias("gravedad"),
        F.coalesce("gravedad_nivel", F.lit(0)).alias("gravedad_nivel"),
        F.when(F.col("clase") != "", F.col("clase")).otherwise(UNKNOWN).alias("clase"),
        *[c for c in ("direccion",) if c in ev.columns],
        F.coalesce("localidad", F.lit(unknown_place)).alias("localidad"),
        F.coalesce("hipotesis", empty).alias("hipotesis"),
        F.coalesce("vehiculos_clase", empty).alias("vehiculos_clase"),
        F.coalesce("num_vehiculos", F.lit(0)).alias("n_vehiculos"),
        F.coalesce("num_actores", F.lit(0)).alias("n_actores"))


# ------------------------------------------------------------------ D9 locality re-key
def fact_place_codes(s: EventSource) -> DataFrame:
    """The fact's place code per event (unknown -> the source's unknown code), from the
    events and their place only - no child lists - so the dimension does not rebuild the fact."""
    ev = s.events().select("codigo_accidente", "cliente").join(s.event_place(), "cliente", "left")
    return ev.select("codigo_accidente", F.coalesce("localidad", F.lit(s.unknown_place)).alias("localidad"))


def dim_localidad(s: EventSource, fact: DataFrame | None = None) -> DataFrame:
    """Distinct place codes of the fact with name and zone; unknown codes get the
    'Desconocida' member. Codes are the distinct values of ``fact.localidad`` when a built
    fact is given, otherwise they come straight from the events."""
    src = fact if fact is not None else fact_place_codes(s)
    codes = src.select(F.col("localidad").alias("codigo_localidad")).distinct()
    pl = s.places().select(F.col("codigo_localidad"), "nombre", "zona")
    d = join_small(codes, pl, "codigo_localidad", "left")
    return d.select(F.col("codigo_localidad").alias("localidad_id"), "codigo_localidad",
                    F.coalesce("nombre", F.lit(UNKNOWN)).alias("nombre"),
                    F.coalesce("zona", F.lit(UNKNOWN)).alias("zona"))


def fact_rekeyed(s: EventSource, fact: DataFrame | None = None) -> DataFrame:
    """Update-from join (J8): the fact's place code is replaced by the dimension key."""
    fact = fact if fact is not None else fact_arrays(s)
    dl = dim_localidad(s)
    f = join_small(fact, dl.withColumnRenamed("codigo_localidad", "localidad"), "localidad", "left")
    return f.drop("localidad")


# ------------------------------------------------------------------ final (v4) tables
def star_tables(s: EventSource) -> dict[str, DataFrame]:
    """The four tables the warehouse queries read: fact with arrays re-keyed on the
    locality dimension, calendar, locality and actor dimensions."""
    fact = fact_arrays(s, with_keys=True)
    return {
        "fact_siniestros": fact_rekeyed(s, fact).drop("nombre", "zona"),
        "dim_fecha": dim_calendar(s),
        "dim_localidad": dim_localidad(s),
        "dim_actor": dim_actor(s),
    }


# ------------------------------------------------------------------ one-shot build
def build_star(s: EventSource, out: str, mode: str = "overwrite", version: str | None = None) -> dict[str, str]:
    """Write the final (v4) warehouse as parquet tables under ``out/<version>/``: the fact
    is partitioned by year so date filters prune files.

    The reference migrates table by table, so a failure half-way leaves a half-migrated
    schema. Here every table of a build goes to a fresh version folder and a one-line
    ``_current`` pointer is written last: readers (``current_star``) only ever see a
    complete build, and a failed build leaves an unreferenced folder behind."""
    import time

    version = version or time.strftime("v%Y%m%d%H%M%S")
    base = f"{out.rstrip('/')}/{version}"
    tables = star_tables(s)
    tables["dim_members"] = dim_members(s)
    paths = {}
    for name, df in tables.items():
        path = f"{base}/{name}"
        w = df.write.mode(mode)
        if name == "fact_siniestros":
            w = w.partitionBy("anio")
        w.parquet(path)
        paths[name] = path
    s.spark.createDataFrame([(version,)], "version string").coalesce(1) \
        .write.mode("overwrite").text(f"{out.rstrip('/')}/_current")
    return paths


VIEWS = ("fact_siniestros", "dim_fecha", "dim_localidad", "dim_actor")


def register_star(spark, written: str) -> list[str]:
    """The tables of the last complete build under ``written`` as temporary views."""
    base = current_star(spark, written)
    for name in VIEWS:
        spark.read.parquet(f"{base}/{name}").createOrReplaceTempView(name)
    return list(VIEWS)


def current_star(spark, out: str) -> str:
    """Folder of the last complete build under ``out``."""
    version = spark.read.text(f"{out.rstrip('/')}/_current").first()[0]
    return f"{out.rstrip('/')}/{version}"
