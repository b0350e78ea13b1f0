"""Parquet table access and the role adapter for the driver's TPC-H-style tables.

The engine's operators are written over *role* columns of the event model (event id, date,
severity, class, place, child rows). ``EventSource`` maps a concrete data set onto those
roles with plain projections, so Catalyst still prunes columns and pushes filters into the
parquet scans. Nothing is materialised here; every method returns a lazy DataFrame.

Role mapping for the driver tables:
  event            orders.o_orderkey            date   orders.o_orderdate
  severity/level   orders.o_orderstatus         F -> 1 (fatal), P -> 2, O -> 3
  class            orders.o_orderpriority
  place            customer.c_nationkey -> nation.n_name (name) -> region.r_name (zone)
  hypotheses (set) distinct part.p_brand of the event's lineitems
  vehicles (bag)   part.p_type of each lineitem; service = lineitem.l_returnflag
  actors (rows)    one per lineitem; condition = l_linestatus, state = l_returnflag
  hour events      events.ts hour; fatal = event_type 'error'
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# Fixed values of the driver adapter: severity code -> level (1 = most severe).
SEVERITY_LEVELS = {"F": 1, "P": 2, "O": 3}
# Actor states recorded for the mortality pivot: state code per outcome.
ACTOR_STATES = {"muertos": "R", "heridos": "A", "ilesos": "N"}
FATAL_EVENT_TYPE = "error"

TABLES = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem",
          "events", "documents", "embeddings", "pages", "benchmark", "labels", "conversations")


def severity_level(c) -> "F.Column":
    e = None
    for code, lvl in SEVERITY_LEVELS.items():
        e = F.when(c == code, F.lit(lvl)) if e is None else e.when(c == code, F.lit(lvl))
    return e


def severity_of_level(level: int) -> str:
    return next(k for k, v in SEVERITY_LEVELS.items() if v == level)




def order_hour():
    """The event's hour. Order dates of the driver tables carry no time of day, so the hour
    comes from the order key: every hour occurs, independent of the other columns."""
    return F.pmod(F.col("o_orderkey"), F.lit(24)).cast("int")


class EventSource:
    """Lazy role views over a directory of parquet tables."""

    levels = SEVERITY_LEVELS
    actor_states = ACTOR_STATES
    condition_labels: dict = {}  # codes are shown as they are
    unknown_place = -1  # nation key 0 is a real place here

    def __init__(self, spark: SparkSession, root: str):
        self.spark = spark
        self.root = root.rstrip("/")

    def table(self, name: str) -> DataFrame:
        return self.spark.read.parquet(f"{self.root}/{name}.parquet")

    # ------------------------------------------------------------------ events (fact)
    def events(self) -> DataFrame:
        """One row per event: codigo_accidente, cliente, fecha, anio, mes, hora, gravedad,
        gravedad_nivel, clase."""
        o = self.table("orders")
        fecha = F.to_date("o_orderdate")
        return o.select(
            F.col("o_orderkey").alias("codigo_accidente"),
            F.col("o_custkey").alias("cliente"),
            fecha.alias("fecha"),
            F.year(fecha).alias("anio"),
            F.month(fecha).alias("mes"),
            order_hour().alias("hora"),
            F.col("o_orderstatus").alias("gravedad"),
            severity_level(F.col("o_orderstatus")).alias("gravedad_nivel"),
            F.col("o_orderpriority").alias("clase"),
        )

    def fact_events(self) -> DataFrame:
        """Events for the loaded fact: the first row per natural key in ingest order (file,
        row position), as the loader's conflict-free insert keeps it (W6, T5)."""
        from ..operators.aggregates import first_per_key
        o = self.table("orders").select("*", F.col("_metadata.file_path").alias("_file"),
                                        F.col("_metadata.row_index").alias("_row"))
        o = first_per_key(o, "o_orderkey", ["_file", "_row"])
        return o.select(
            F.col("o_orderkey").alias("codigo_accidente"), F.col("o_custkey").alias("cliente"),
            F.to_date("o_orderdate").alias("fecha"), order_hour().alias("hora"),
            F.col("o_orderstatus").alias("gravedad"), F.col("o_orderpriority").alias("clase"))

    # ------------------------------------------------------------------ audit targets
    def fk_pairs(self):
        t = self.table
        return [
            ("lineitem", t("lineitem"), "l_orderkey", "orders", t("orders"), "o_orderkey"),
            ("lineitem", t("lineitem"), "l_partkey", "part", t("part"), "p_partkey"),
            ("lineitem", t("lineitem"), "l_suppkey", "supplier", t("supplier"), "s_suppkey"),
            ("orders", t("orders"), "o_custkey", "customer", t("customer"), "c_custkey"),
            ("customer", t("customer"), "c_nationkey", "nation", t("nation"), "n_nationkey"),
            ("supplier", t("supplier"), "s_nationkey", "nation", t("nation"), "n_nationkey"),
            ("nation", t("nation"), "n_regionkey", "region", t("region"), "r_regionkey"),
        ]

    def unique_checks(self):
        t = self.table
        return [("orders", t("orders"), ["o_orderkey"]), ("customer", t("customer"), ["c_custkey"]),
                ("part", t("part"), ["p_partkey"]), ("supplier", t("supplier"), ["s_suppkey"]),
                ("nation", t("nation"), ["n_nationkey"]), ("lineitem", t("lineitem"), ["l_orderkey", "l_linenumber"])]

    def notnull_checks(self):
        t = self.table
        return [("orders", t("orders"), ["o_orderkey", "o_custkey", "o_orderdate", "o_orderstatus", "o_orderpriority"]),
                ("lineitem", t("lineitem"), ["l_orderkey", "l_partkey", "l_returnflag", "l_linestatus"]),
                ("customer", t("customer"), ["c_custkey", "c_nationkey"])]

    def count_tables(self):
        return [("orders", self.table("orders")), ("fact_siniestros", self.events()),
                ("lineitem", self.table("lineitem")), ("bridge_hipotesis", self.hypotheses()),
                ("dim_vehiculo", self.vehicles()), ("dim_actor", self.actors())]

    def event_place(self) -> DataFrame:
        """cliente -> localidad (place code); one row per customer."""
        return self.table("customer").select(
            F.col("c_custkey").alias("cliente"), F.col("c_nationkey").alias("localidad"))

    def places(self) -> DataFrame:
        """Place dimension: localidad_id, codigo_localidad, nombre, zona (small, fixed size)."""
        n = self.table("nation")
        r = self.table("region")
        return n.join(r, n.n_regionkey == r.r_regionkey, "left").select(
            F.col("n_nationkey").alias("localidad_id"),
            F.col("n_nationkey").alias("codigo_localidad"),
            F.col("n_name").alias("nombre"),
            F.col("r_name").alias("zona"),
        )

    # ------------------------------------------------------------------ child rows
    def _lines(self, within: DataFrame | None = None) -> DataFrame:
        li = self.table("lineitem")
        if within is None:
            return li
        # a given number of partitions is not merged at run time: packed integers compress so far
        # that a merged partition of a few MB holds millions of rows, all sorted in one task
        n = int(self.spark.conf.get("spark.sql.shuffle.partitions"))
        keep = within.select(F.col("codigo_accidente").alias("l_orderkey"))
        return li.repartition(n, "l_orderkey").join(keep.repartition(n, "l_orderkey"), "l_orderkey", "left_semi")

    def vehicle_counts(self) -> DataFrame:
        """clase, total over all events: lines are counted by part before the parts are read."""
        used = self._lines().groupBy(F.col("l_partkey").alias("p_partkey")).agg(F.count(F.lit(1)).alias("n"))
        p = self.table("part").select("p_partkey", F.col("p_type").alias("clase"))
        return used.join(p, "p_partkey").groupBy("clase").agg(F.sum("n").alias("total"))

    def service_counts(self) -> DataFrame:
        """servicio, total over the lines that have a part, counted by part and service first."""
        used = self._lines().groupBy(F.col("l_partkey").alias("p_partkey"), F.col("l_returnflag").alias("servicio")).agg(
            F.count(F.lit(1)).alias("n"))
        return used.join(self.table("part").select("p_partkey"), "p_partkey", "left_semi").groupBy("servicio").agg(F.sum("n").alias("total"))

    def vehicles(self, within: DataFrame | None = None) -> DataFrame:
        """Bag of vehicles per event: codigo_accidente, clase, servicio; of the events ``within``
        only, if given (the lines are reduced before they meet the parts)."""
        li = self._lines(within).select("l_orderkey", "l_partkey", "l_returnflag")
        p = self.table("part").select("p_partkey", "p_type")
        return li.join(p, li.l_partkey == p.p_partkey).select(
            F.col("l_orderkey").alias("codigo_accidente"),
            F.col("p_type").alias("clase"),
            F.col("l_returnflag").alias("servicio"),
        )

    def hypotheses(self, within: DataFrame | None = None) -> DataFrame:
        """Set of hypotheses per event (deduplicated pairs): codigo_accidente, hipotesis; of the
        events ``within`` only, if given."""
        li = self._lines(within).select("l_orderkey", "l_partkey")
        p = self.table("part").select("p_partkey", "p_brand")
        pairs = li.join(p, li.l_partkey == p.p_partkey).select(
            F.col("l_orderkey").alias("codigo_accidente"), F.col("p_brand").alias("hipotesis"))
        # distinct is a hash aggregate: the map side collapses duplicates before the shuffle
        return pairs.distinct()

    def actors(self) -> DataFrame:
        """Actor rows: codigo_accidente, condicion, estado."""
        return self._lines().select(
            F.col("l_orderkey").alias("codigo_accidente"),
            F.col("l_linestatus").alias("condicion"),
            F.col("l_returnflag").alias("estado"),
        )

    def child_summary(self) -> DataFrame:
        """Per-event child facts in one pass over lineitem: first hypothesis and vehicle class
        (lists are ordered by value, so "first" is the minimum), number of distinct
        hypotheses, vehicles and actors.

        Two-level aggregation instead of COUNT(DISTINCT): (event, hypothesis) first, then
        event. Both levels aggregate map-side, so an event with a huge number of child rows
        is reduced to one row per (task, hypothesis) before any shuffle.
        """
        p = self.table("part").select("p_partkey", "p_brand", "p_type")
        li = self._lines().select("l_orderkey", "l_partkey")
        lines = li.join(p, li.l_partkey == p.p_partkey, "left")
        per_pair = lines.groupBy("l_orderkey", "p_brand").agg(
            F.count(F.lit(1)).alias("_n_act"),
            F.count("p_type").alias("_n_veh"),
            F.min("p_type").alias("_min_type"),
        )
        return per_pair.groupBy(F.col("l_orderkey").alias("codigo_accidente")).agg(
            F.min("p_brand").alias("hipotesis"),
            F.count("p_brand").alias("num_hipotesis"),
            F.min("_min_type").alias("tipo_vehiculo"),
            F.sum("_n_veh").cast("long").alias("num_vehiculos"),
            F.sum("_n_act").cast("long").alias("num_actores"),
        )

    def child_profile(self) -> DataFrame:
        """Per-event child lists for the array fact, from one pass over lineitem x part: the
        different hypotheses in the order of their first line, one vehicle class a line in line
        order, vehicle and actor counts; lines of one number stand in the order of their
        values."""
        from ..operators.reshape import gather_in_order
        p = self.table("part").select("p_partkey", "p_brand", "p_type")
        li = self._lines().select(F.col("l_orderkey").alias("codigo_accidente"), "l_partkey", "l_linenumber")
        lines = li.join(p, li.l_partkey == p.p_partkey, "left")
        per = gather_in_order(lines, "codigo_accidente", ["l_linenumber"], ["p_brand", "p_type"])
        brands, types = F.transform("hijos", lambda x: x["p_brand"]), F.transform("hijos", lambda x: x["p_type"])
        per = per.select("codigo_accidente", F.array_distinct(F.array_compact(brands)).alias("hipotesis"),
                         F.array_compact(types).alias("vehiculos_clase"), F.size("hijos").cast("long").alias("num_actores"))
        return per.withColumn("num_vehiculos", F.size("vehiculos_clase").cast("long"))

    # ------------------------------------------------------------------ hour stream
    def hour_events(self) -> DataFrame:
        """Timestamped events with an hour: hora, fatal (1/0), fecha."""
        e = self.table("events")
        return e.select(
            F.hour("ts").alias("hora"),
            F.when(F.col("event_type") == FATAL_EVENT_TYPE, 1).otherwise(0).alias("fatal"),
            F.to_date("ts").alias("fecha"),
        )

    def member_values(self, dimension: str) -> DataFrame:
        """Distinct values of a child dimension that events use. For parts, the used part
        keys are reduced map-side first, so lineitem is never joined row by row."""
        if dimension == "condicion":
            return self.actors().select(F.col("condicion").alias("descripcion")).distinct()
        col = {"hipotesis": "p_brand", "vehiculo_clase": "p_type"}[dimension]
        used = self._lines().select(F.col("l_partkey").alias("p_partkey")).distinct()
        parts = self.table("part").join(used, "p_partkey", "left_semi")
        return parts.select(F.col(col).alias("descripcion")).distinct()


def open_source(spark: SparkSession, root: str):
    """Role adapter for ``root``: a directory of parquet tables, or nested records: a ``.json``
    file (one array), JSON Lines (``.jsonl``, ``.ndjson``; splittable), or a folder of JSON,
    JSON Lines or Parquet files (as ``convert_to_parquet`` writes it)."""
    from .nested import NestedSource, read_nested
    kind = _nested_kind(spark, root)
    if kind is None:
        return EventSource(spark, root)
    if kind == "parquet":
        return NestedSource(spark, spark.read.parquet(root), name=root)
    return NestedSource(spark, read_nested(spark, root, multiline=kind == "json"), name=root)


LINES = (".jsonl", ".ndjson")


def _nested_kind(spark: SparkSession, root: str) -> str | None:
    """'json', 'lines' or 'parquet' for nested records, None for a folder of tables. Looks
    through Hadoop's file system, so any store that Spark reads will do."""
    if root.endswith(LINES):
        return "lines"
    if root.endswith(".json"):
        return "json"
    jvm = spark._jvm
    top = jvm.org.apache.hadoop.fs.Path(root)
    fs = top.getFileSystem(spark._jsc.hadoopConfiguration())
    if not fs.exists(top) or fs.exists(jvm.org.apache.hadoop.fs.Path(top, "orders.parquet")):
        return None
    names = [f.getPath().getName() for f in fs.listStatus(top)]
    if any(n.endswith(LINES) for n in names):
        return "lines"
    return "json" if any(n.endswith(".json") for n in names) else "parquet"


def read_jdbc(spark: SparkSession, url: str, table: str, properties: dict, partition_column: str | None = None,
              lower: int | None = None, upper: int | None = None, partitions: int = 1) -> DataFrame:
    """S3 from a database: with a numeric partition column the read is split into
    ``partitions`` parallel range queries instead of one connection. Connection options
    come from the caller only."""
    if partition_column:
        return spark.read.jdbc(url, table, column=partition_column, lowerBound=lower, upperBound=upper,
                               numPartitions=partitions, properties=properties)
    return spark.read.jdbc(url, table, properties=properties)


def register_views(spark: SparkSession, root: str) -> list[str]:
    """The role views and the analysis view as temporary views for SQL users
    (``siniestros`` is the batch job's view)."""
    from ..plans.warehouse import analysis_view
    s = open_source(spark, root)
    views = {"eventos": s.events(), "hipotesis": s.hypotheses(), "vehiculos": s.vehicles(),
             "actores": s.actors(), "lugares": s.places(), "siniestros": analysis_view(spark, root)}
    for name, df in views.items():
        df.createOrReplaceTempView(name)
    return list(views)
