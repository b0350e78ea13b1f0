"""The reference's own input: nested accident records (JSON), read with an explicit schema.

``NestedSource`` offers the same role views as ``EventSource`` so every catalogue query and
the star build run on nested records too; ``flatten`` / ``mining_rows`` are the two
flattening flavours of the reference (analysis job and desktop mining loader).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.scalars import (UNKNOWN_HOUR, UNKNOWN_HYPOTHESIS, UNKNOWN_VEHICLE, first_of, parse_date,
                                 parse_hour, safe_size)

# Fixed values of the reference data set: severity text -> level, actor outcome -> state
# text, locality code -> name and zone.
SEVERITY_LEVELS = {"Con Muertos": 1, "Con Heridos": 2, "Solo Daños": 3}
ACTOR_STATES = {"muertos": "MUERTO", "heridos": "HERIDO", "ilesos": "ILESO"}
LOCALITY_NAMES = {
    1: "Usaquén", 2: "Chapinero", 3: "Santa Fe", 4: "San Cristóbal", 5: "Usme", 6: "Tunjuelito",
    7: "Bosa", 8: "Kennedy", 9: "Fontibón", 10: "Engativá", 11: "Suba", 12: "Barrios Unidos",
    13: "Teusaquillo", 14: "Los Mártires", 15: "Antonio Nariño", 16: "Puente Aranda",
    17: "La Candelaria", 18: "Rafael Uribe Uribe", 19: "Ciudad Bolívar", 20: "Sumapaz",
}
LOCALITY_ZONES = {
    1: "Norte", 2: "Norte", 3: "Centro", 4: "Sur", 5: "Sur", 6: "Sur", 7: "Occidente", 8: "Occidente",
    9: "Occidente", 10: "Occidente", 11: "Norte", 12: "Norte", 13: "Norte", 14: "Centro", 15: "Centro",
    16: "Centro", 17: "Centro", 18: "Sur", 19: "Sur", 20: "Sur",
}
# Display labels of actor conditions used by the mortality chart.
CONDITION_LABELS = {"CONDUCTOR": "Conductor", "MOTOCICLISTA": "Motociclista", "PASAJERO/ACOMPAÑANTE": "Pasajero",
                    "PEATON": "Peatón", "CICLISTA": "Ciclista"}
UNKNOWN = "Desconocida"

VEHICLE = T.StructType([T.StructField("CLASE", T.StringType()), T.StructField("SERVICIO", T.StringType())])
ACTOR = T.StructType([T.StructField("CONDICION", T.StringType()), T.StructField("ESTADO", T.StringType()),
                      T.StructField("SEXO", T.StringType())])
NESTED_SCHEMA = T.StructType([
    T.StructField("CODIGO_ACCIDENTE", T.LongType(), False),
    T.StructField("FECHA_STR", T.StringType()),
    T.StructField("HORA", T.StringType()),
    T.StructField("GRAVEDAD", T.StringType()),
    T.StructField("CLASE", T.StringType()),
    T.StructField("CODIGO_LOCALIDAD", T.LongType()),
    T.StructField("DIRECCION", T.StringType()),
    T.StructField("HIPOTESIS_LISTA", T.ArrayType(T.StringType())),
    T.StructField("VEHICULOS_INVOLUCRADOS", T.ArrayType(VEHICLE)),
    T.StructField("ACTORES_INVOLUCRADOS", T.ArrayType(ACTOR)),
])


def read_nested(spark: SparkSession, path: str, multiline: bool = True) -> DataFrame:
    """Nested events with an explicit schema (no inference pass). A JSON array file
    needs ``multiline`` and is read by one task per file; convert large inputs once to
    JSON Lines or Parquet (``sinks.write_table``) so the scan splits."""
    r = spark.read.schema(NESTED_SCHEMA).option("encoding", "UTF-8")
    if multiline:
        r = r.option("multiLine", "true")
    return r.json(path)


def read_array(spark: SparkSession, path: str, first_key: str = "CODIGO_ACCIDENTE") -> DataFrame:
    """The records of JSON array files whose records begin with ``first_key``, read by
    byte ranges: the key's name parts the text, so one large array is split over many tasks
    wherever the ranges fall (inside a string the quotes of the name are escaped). The column
    ``_corrupt`` has the text of what is no record of the schema, null for good rows; a file
    whose records begin with another key shows up there, nothing is lost unnoticed."""
    parts = spark.read.option("lineSep", f'"{first_key}"').text(path)
    parts = parts.where(~F.col("value").rlike(r"^\x{FEFF}?\s*(\[\s*(\{|\])?\s*)?$"))        # what stands before the first record
    end = r"\}\s*(,\s*\{|\])\s*$"
    body = F.concat(F.lit(f'{{"{first_key}"'), F.regexp_replace("value", end, "}"))
    schema = T.StructType([*NESTED_SCHEMA.fields, T.StructField("_corrupt", T.StringType())])
    got = parts.select("value", F.from_json(body, schema, {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": "_corrupt"}).alias("r"))
    bad = F.col("r._corrupt").isNotNull() | F.col("r.CODIGO_ACCIDENTE").isNull() | ~F.col("value").rlike(end)
    return got.select(*[F.col(f"r.{f.name}") for f in NESTED_SCHEMA], F.when(bad, F.col("value")).alias("_corrupt"))


def convert_to_parquet(spark: SparkSession, path: str, out: str, multiline: bool = True, by_record: bool = False) -> str:
    """Read nested JSON once (one task per multiLine file; ``by_record``: array files by byte
    ranges, see ``read_array``) and store it as Parquet partitioned by year, keeping the file
    order in ``_ingest`` for the first-record-wins rule. Later scans split, prune by year and
    read only the needed nested fields."""
    raw = read_array(spark, path) if by_record else read_nested(spark, path, multiline)
    raw = raw.withColumn("_ingest", F.monotonically_increasing_id())
    raw = raw.withColumn("_anio", F.year(parse_date("FECHA_STR")))
    raw.write.mode("overwrite").partitionBy("_anio").parquet(out)
    return out


def _truthy(c) -> "F.Column":
    return c.isNotNull() & (c != "")


def _level(c) -> "F.Column":
    e = None
    for k, v in SEVERITY_LEVELS.items():
        e = F.when(c == k, F.lit(v)) if e is None else e.when(c == k, F.lit(v))
    return e


# ------------------------------------------------------------------ P1 / P2 flatteners
def flatten(raw: DataFrame) -> DataFrame:
    """P1 + P3 + P4: the batch job's 13-column analysis view (hour by ``split``, first
    hypothesis and first vehicle class, list sizes with 0 for a missing list)."""
    fecha = parse_date("FECHA_STR")
    df = raw.select(
        F.col("CODIGO_ACCIDENTE"), fecha.alias("fecha"), F.year(fecha).alias("anio"), F.month(fecha).alias("mes"),
        parse_hour("HORA", "split").alias("hora"),
        F.col("GRAVEDAD").alias("gravedad"), F.col("CLASE").alias("clase"),
        F.col("CODIGO_LOCALIDAD").cast("int").alias("localidad"),
        first_of("HIPOTESIS_LISTA").alias("hipotesis"),
        first_of("VEHICULOS_INVOLUCRADOS", "CLASE").alias("tipo_vehiculo"),
        safe_size("HIPOTESIS_LISTA").alias("num_hipotesis"),
        safe_size("VEHICULOS_INVOLUCRADOS").alias("num_vehiculos"),
        safe_size("ACTORES_INVOLUCRADOS").alias("num_actores"))
    return df.where(F.col("gravedad").isin(*SEVERITY_LEVELS)).na.fill(
        {"hipotesis": UNKNOWN_HYPOTHESIS, "tipo_vehiculo": UNKNOWN_VEHICLE, "hora": UNKNOWN_HOUR})


def mining_rows(raw: DataFrame) -> DataFrame:
    """P2 + P10: the desktop loader's rows (hour with ``zero_default``, locality as text,
    first hypothesis / vehicle with defaults, counts as doubles), rows without a target
    dropped."""
    hyp = first_of("HIPOTESIS_LISTA")
    veh = F.get(F.col("VEHICULOS_INVOLUCRADOS"), 0)
    df = raw.select(
        F.col("CODIGO_ACCIDENTE"),
        parse_hour("HORA", "zero_default").alias("hora"),
        F.coalesce(F.col("GRAVEDAD"), F.lit("")).alias("gravedad"),
        F.coalesce(F.col("CLASE"), F.lit("")).alias("clase_siniestro"),
        F.coalesce(F.col("CODIGO_LOCALIDAD").cast("string"), F.lit("0")).alias("localidad"),
        F.coalesce(hyp, F.lit(UNKNOWN_HYPOTHESIS)).alias("hipotesis"),
        F.when(veh.isNull(), F.lit(UNKNOWN_VEHICLE)).otherwise(veh["CLASE"]).alias("tipo_vehiculo"),
        safe_size("VEHICULOS_INVOLUCRADOS").cast("double").alias("num_vehiculos"),
        safe_size("ACTORES_INVOLUCRADOS").cast("double").alias("num_actores"))
    return df.where(F.col("gravedad") != "")


# ------------------------------------------------------------------ role adapter
class NestedSource:
    """Role views over nested records with the reference loader's rules: first record per
    natural key wins (T5), hypotheses deduplicated per event, vehicles and actors kept as
    bags (T6), empty or missing child values skipped (P11), dates parsed once and bad
    dates giving NULL (T7/T8), hour by the loader's two-digit prefix (T1)."""

    levels = SEVERITY_LEVELS
    actor_states = ACTOR_STATES
    condition_labels = CONDITION_LABELS
    unknown_place = 0

    def __init__(self, spark: SparkSession, raw: DataFrame | str, name: str = "nested"):
        self.spark = spark
        self.raw = read_nested(spark, raw) if isinstance(raw, str) else raw
        self.corrupt = None
        if "_corrupt" in self.raw.columns:
            self.corrupt = self.raw.where("_corrupt is not null")
            self.raw = self.raw.where("_corrupt is null").drop("_corrupt")
        self.root = name
        # ingest order = file order (partition, then position); used for first-wins only.
        # Converted inputs carry the order of the original file.
        self._ordered = self.raw if "_ingest" in self.raw.columns else \
            self.raw.withColumn("_ingest", F.monotonically_increasing_id())

    def table(self, name: str) -> DataFrame:
        raise KeyError(f"nested source has no table {name!r}")

    def _first_records(self) -> DataFrame:
        from ..operators.aggregates import first_per_key
        cols = [f.name for f in NESTED_SCHEMA] + ["_ingest"]
        return first_per_key(self._ordered.select(*cols), "CODIGO_ACCIDENTE", ["_ingest"])

    def events(self) -> DataFrame:
        r = self._first_records()
        fecha = parse_date("FECHA_STR")
        return r.select(
            F.col("CODIGO_ACCIDENTE").alias("codigo_accidente"),
            F.col("CODIGO_ACCIDENTE").alias("cliente"),
            fecha.alias("fecha"), F.year(fecha).alias("anio"), F.month(fecha).alias("mes"),
            parse_hour("HORA", "prefix").alias("hora"),
            F.col("GRAVEDAD").alias("gravedad"), _level(F.col("GRAVEDAD")).alias("gravedad_nivel"),
            F.col("CLASE").alias("clase"), F.col("DIRECCION").alias("direccion"))

    def flat_rows(self) -> DataFrame:
        """The batch job's analysis view: its own hour rule, every record (also repeated keys)."""
        return flatten(self.raw).withColumnRenamed("CODIGO_ACCIDENTE", "codigo_accidente")

    def mining_rows(self) -> DataFrame:
        """The desktop loader's rows with its own hour and default rules."""
        return mining_rows(self.raw).withColumnRenamed("CODIGO_ACCIDENTE", "codigo_accidente")

    def fact_events(self) -> DataFrame:
        """The loaded fact's events: already the first record per key."""
        return self.events()

    # ------------------------------------------------------------------ audit targets
    def fk_pairs(self):
        ev = self.events()
        return [("hipotesis", self.hypotheses(), "codigo_accidente", "siniestros", ev, "codigo_accidente"),
                ("vehiculos", self.vehicles(), "codigo_accidente", "siniestros", ev, "codigo_accidente"),
                ("actores", self.actors(), "codigo_accidente", "siniestros", ev, "codigo_accidente"),
                ("siniestros", self.event_place().withColumnRenamed("cliente", "codigo_accidente"), "localidad",
                 "dim_localidad", self.places(), "localidad_id")]

    def unique_checks(self):
        return [("siniestros_json", self.raw, ["CODIGO_ACCIDENTE"]),
                ("bridge_hipotesis", self.hypotheses(), ["codigo_accidente", "hipotesis"])]

    def notnull_checks(self):
        return [("siniestros_json", self.raw, ["CODIGO_ACCIDENTE", "FECHA_STR", "HORA", "GRAVEDAD", "CLASE",
                                                "CODIGO_LOCALIDAD"])]

    def count_tables(self):
        return [("siniestros_json", self.raw), ("fact_siniestros", self.events()),
                ("bridge_hipotesis", self.hypotheses()), ("dim_vehiculo", self.vehicles()),
                ("dim_actor", self.actors())] + ([] if self.corrupt is None else [("registros_corruptos", self.corrupt)])

    def event_place(self) -> DataFrame:
        """Event -> place code; codes 0/NULL are not places (the loader skips them)."""
        r = self._first_records()
        code = F.col("CODIGO_LOCALIDAD").cast("int")
        return r.where(code.isNotNull() & (code != 0)).select(
            F.col("CODIGO_ACCIDENTE").alias("cliente"), code.alias("localidad"))

    def places(self) -> DataFrame:
        codes = self.event_place().select(F.col("localidad").alias("localidad_id")).distinct()
        names = F.create_map(*[x for k, v in LOCALITY_NAMES.items() for x in (F.lit(k), F.lit(v))])
        zones = F.create_map(*[x for k, v in LOCALITY_ZONES.items() for x in (F.lit(k), F.lit(v))])
        return codes.select(
            "localidad_id", F.col("localidad_id").alias("codigo_localidad"),
            F.coalesce(F.element_at(names, F.col("localidad_id")),
                       F.concat(F.lit("Localidad "), F.col("localidad_id").cast("string"))).alias("nombre"),
            F.coalesce(F.element_at(zones, F.col("localidad_id")), F.lit(UNKNOWN)).alias("zona"))

    def _children(self, col: str) -> DataFrame:
        # children of every record (also later duplicates) attach to the surviving event
        # with the record and the position they come from
        return self._ordered.select(F.col("CODIGO_ACCIDENTE").alias("codigo_accidente"), "_ingest",
                                    F.posexplode(col).alias("posicion", "c"))

    def hypotheses(self, within: DataFrame | None = None) -> DataFrame:
        h = self._children("HIPOTESIS_LISTA").where(_truthy(F.col("c")))
        h = h.select("codigo_accidente", F.col("c").alias("hipotesis")).distinct()
        return h if within is None else h.join(within.select("codigo_accidente"), "codigo_accidente", "left_semi")

    def vehicles(self, within: DataFrame | None = None) -> DataFrame:
        v = self._children("VEHICULOS_INVOLUCRADOS").where(_truthy(F.col("c.CLASE")))
        v = v.select("codigo_accidente", F.col("c.CLASE").alias("clase"), F.col("c.SERVICIO").alias("servicio"))
        return v if within is None else v.join(within.select("codigo_accidente"), "codigo_accidente", "left_semi")

    def vehicle_counts(self) -> DataFrame:
        return self.vehicles().groupBy("clase").agg(F.count(F.lit(1)).alias("total"))

    def service_counts(self) -> DataFrame:
        return self.vehicles().groupBy("servicio").agg(F.count(F.lit(1)).alias("total"))

    def actors(self) -> DataFrame:
        a = self._children("ACTORES_INVOLUCRADOS").where(_truthy(F.col("c.CONDICION")))
        return a.select("codigo_accidente", F.col("c.CONDICION").alias("condicion"),
                        F.col("c.ESTADO").alias("estado"), F.col("c.SEXO").alias("sexo"))

    def child_summary(self) -> DataFrame:
        """Per surviving record, read straight from its arrays (no aggregation needed)."""
        r = self._first_records()
        return r.select(
            F.col("CODIGO_ACCIDENTE").alias("codigo_accidente"),
            first_of("HIPOTESIS_LISTA").alias("hipotesis"),
            safe_size("HIPOTESIS_LISTA").cast("long").alias("num_hipotesis"),
            first_of("VEHICULOS_INVOLUCRADOS", "CLASE").alias("tipo_vehiculo"),
            safe_size("VEHICULOS_INVOLUCRADOS").cast("long").alias("num_vehiculos"),
            safe_size("ACTORES_INVOLUCRADOS").cast("long").alias("num_actores"))

    def child_profile(self) -> DataFrame:
        """Per event: the different hypotheses in the order of their first mention, one vehicle
        class a vehicle in source order, and the surviving record's counts."""
        from ..operators.reshape import gather_in_order
        h = self._children("HIPOTESIS_LISTA").where(_truthy(F.col("c"))).withColumnRenamed("c", "hipotesis")
        v = self._children("VEHICULOS_INVOLUCRADOS").where(_truthy(F.col("c.CLASE"))).withColumn("clase", F.col("c.CLASE"))
        order = ["_ingest", "posicion"]
        h = gather_in_order(h, "codigo_accidente", order, ["hipotesis"]).select(
            "codigo_accidente", F.array_distinct(F.col("hijos.hipotesis")).alias("hipotesis"))
        v = gather_in_order(v, "codigo_accidente", order, ["clase"]).select("codigo_accidente", F.col("hijos.clase").alias("vehiculos_clase"))
        kids = self.child_summary().select("codigo_accidente", "num_vehiculos", "num_actores")
        return kids.join(h, "codigo_accidente", "left").join(v, "codigo_accidente", "left")

    def member_values(self, dimension: str) -> DataFrame:
        src = {"hipotesis": (self.hypotheses(), "hipotesis"), "vehiculo_clase": (self.vehicles(), "clase"),
               "condicion": (self.actors(), "condicion")}[dimension]
        return src[0].select(F.col(src[1]).alias("descripcion")).distinct()

    def hour_events(self) -> DataFrame:
        ev = self.events()
        return ev.select("hora", F.when(F.col("gravedad_nivel") == 1, 1).otherwise(0).alias("fatal"), "fecha")
