"""Hand-made nested records exercising the semantic traps through the
nested source adapter, the two flatteners and catalogue queries run on JSON input."""

import json
import math
import os
import tempfile

import pytest
from pyspark.sql import functions as F

V = lambda c, s="Particular": {"CLASE": c, "SERVICIO": s}
A = lambda c, e, s="M": {"CONDICION": c, "ESTADO": e, "SEXO": s}


def rec(code, fecha, hora, grav, clase="Choque", loc=8, hyps=("H1",), vehs=(V("AUTOMOVIL"),),
        acts=(A("CONDUCTOR", "ILESO"),)):
    return {"CODIGO_ACCIDENTE": code, "FECHA_STR": fecha, "HORA": hora, "GRAVEDAD": grav, "CLASE": clase,
            "CODIGO_LOCALIDAD": loc, "DIRECCION": f"Calle {code}",
            "HIPOTESIS_LISTA": None if hyps is None else list(hyps),
            "VEHICULOS_INVOLUCRADOS": None if vehs is None else list(vehs),
            "ACTORES_INVOLUCRADOS": None if acts is None else list(acts)}


RECORDS = [
    rec(1, "2015-03-10", "14:30:00", "Con Heridos", hyps=("H1", "H2"), vehs=(V("AUTOMOVIL"), V("MOTO")),
        acts=(A("CONDUCTOR", "HERIDO"), A("CONDUCTOR", "ILESO", "F"), A("PEATON", "HERIDO", "F"))),
    rec(2, "2015-03-11", None, "Solo Daños", vehs=(V("AUTOMOVIL", "Publico"),)),
    rec(3, "2016-01-05", "9:30:00", "Con Muertos", clase="Atropello", loc=3, hyps=("H3",), vehs=(V("MOTO"),),
        acts=(A("PEATON", "MUERTO"),)),
    rec(4, "2016-01-06", "xx:00:00", "Solo Daños", loc=0, hyps=None, vehs=(), acts=None),
    rec(5, "2016-02-01", "00:00:00", "Con Heridos", clase="Volcamiento", loc=None, hyps=(),
        vehs=(V(""),), acts=(A("CONDUCTOR", None),)),
    rec(6, "2017-05-05", "10:00:00", None, loc=21),
    rec(7, "2017-05-06", "10:00:00", ""),
    rec(8, "2017-05-07", "10:00:00", "Desconocido"),
    rec(9, "2015-1-5", "11:00:00", "Con Heridos"),
    rec(10, "2015-13-40", "12:00:00", "Solo Daños"),
    rec(11, None, "13:00:00", "Solo Daños"),
    rec(1, "2018-01-01", "08:00:00", "Solo Daños", hyps=("H4",), vehs=(V("BUS", "Publico"),),
        acts=(A("PASAJERO", "HERIDO", "F"),)),
    rec(12, "2018-02-02", "15:00:00", "Con Muertos", hyps=("H2", "H2"), vehs=(V("AUTOMOVIL"), V("AUTOMOVIL"))),
    rec(13, "2018-02-03", "16:00:00", "Con Heridos", acts=(A("CICLISTA", "DESCONOCIDO"),)),
]


@pytest.fixture(scope="module")
def path():
    d = tempfile.mkdtemp(prefix="vialflow-nested-")
    p = os.path.join(d, "siniestros.json")
    with open(p, "w", encoding="utf-8") as f:
        json.dump(RECORDS, f, ensure_ascii=False)
    return p


@pytest.fixture(scope="module")
def src(spark, path):
    from vialflow.sources.nested import NestedSource
    return NestedSource(spark, path, name=path)


def by_code(df, key="CODIGO_ACCIDENTE"):
    return {r[key]: r for r in df.collect()}


def test_read_with_explicit_schema(spark, path):
    from vialflow.sources.nested import NESTED_SCHEMA, read_nested
    raw = read_nested(spark, path)
    assert raw.schema == NESTED_SCHEMA or [f.name for f in raw.schema] == [f.name for f in NESTED_SCHEMA]
    assert raw.count() == len(RECORDS)


def test_flatten_hour_sizes_defaults_and_severity_filter(spark, path):
    from vialflow.sources.nested import flatten, read_nested
    f = flatten(read_nested(spark, path))
    rows = f.collect()
    codes = sorted(r.CODIGO_ACCIDENTE for r in rows)
    # Null, empty and unknown severities dropped (6, 7, 8); duplicates kept by the job view
    assert codes == [1, 1, 2, 3, 4, 5, 9, 10, 11, 12, 13]
    m = {(r.CODIGO_ACCIDENTE, r.gravedad): r for r in rows}
    assert m[(3, "Con Muertos")].hora == 9            # T1 split: '9:30:00' -> 9
    assert m[(2, "Solo Daños")].hora == -1            # null -> sentinel (T11)
    assert m[(4, "Solo Daños")].hora == -1            # 'xx' -> NULL -> sentinel
    assert m[(4, "Solo Daños")].num_hipotesis == 0    # T10 missing list -> 0
    assert m[(4, "Solo Daños")].hipotesis == "Desconocida"
    assert m[(4, "Solo Daños")].tipo_vehiculo == "Otro"  # empty vehicle list
    assert m[(5, "Con Heridos")].tipo_vehiculo == ""     # job takes the first class as is
    assert m[(10, "Solo Daños")].fecha is None           # T8 bad date -> NULL, no failure
    assert m[(1, "Con Heridos")].num_actores == 3


def test_mining_rows(spark, path):
    from vialflow.sources.nested import mining_rows, read_nested
    m = by_code(mining_rows(read_nested(spark, path)).where(F.col("CODIGO_ACCIDENTE") != 1))
    assert 6 not in m and 7 not in m        # P10 rows without target dropped
    assert 8 in m                            # unknown text is a target value
    assert m[2].hora == 0.0                  # zero default
    assert math.isnan(m[4].hora)             # unparsable -> NaN
    assert m[3].hora == 9.0
    assert m[5].localidad == "0" and m[3].localidad == "3"
    assert m[4].num_vehiculos == 0.0 and m[4].tipo_vehiculo == "Otro"


def test_loader_hour_prefix_and_first_wins(src):
    ev = by_code(src.events(), "codigo_accidente")
    assert ev[3].hora is None                 # T1 prefix: '9:30:00' -> NULL
    assert ev[1].hora == 14 and ev[5].hora == 0
    assert ev[1].gravedad == "Con Heridos"    # T5 first record wins
    assert ev[9].fecha is None                # T7 unpadded date -> NULL key


def test_children_rules(src):
    h = src.hypotheses().collect()
    assert sorted(r.hipotesis for r in h if r.codigo_accidente == 1) == ["H1", "H2", "H4"]  # T5
    assert [r.hipotesis for r in h if r.codigo_accidente == 12] == ["H2"]                   # T6 set
    assert not [r for r in h if r.codigo_accidente in (4, 5)]                               # T3
    v = src.vehicles().collect()
    assert len([r for r in v if r.codigo_accidente == 12]) == 2                             # T6 bag
    assert not [r for r in v if r.codigo_accidente == 5]                                    # P11 empty class
    places = by_code(src.event_place(), "cliente")
    assert 4 not in places and 5 not in places                                              # T9


def test_catalogue_on_nested(spark, path, queries):
    sev = {r.descripcion: r.total for r in queries["severity_counts"](spark, path).collect()}
    assert sev["Con Heridos"] == 4 and sev["Con Muertos"] == 2 and sev["Solo Daños"] == 4
    assert sum(sev.values()) == 13            # 13 distinct natural keys
    states = queries["actor_state"](spark, path).collect()
    assert any(r.condicion == "CONDUCTOR" and r.estado is None for r in states)             # T13 NULL group kept
    mort = {r.condicion: r for r in queries["actor_mortality"](spark, path).collect()}
    assert mort["CICLISTA"].total >= 1 and mort["CICLISTA"].muertos == 0                      # outside states
    assert mort["PEATON"].muertos == 1 and mort["PEATON"].tasa == round(1000 / mort["PEATON"].total, 2)
    table = {r.nombre: r for r in queries["place_table"](spark, path).collect()}
    assert table["Kennedy"].zona == "Occidente" and table["Santa Fe"].con_muertos == 1
    assert "Localidad 21" in table                                                          # J12 default label
    causes = {r.descripcion: r.total for r in queries["cause_top10"](spark, path).collect()}
    assert causes["H2"] == 2                 # events 1 and 12, once each


def test_star_on_nested(spark, src):
    from vialflow.plans import star
    fa = by_code(star.fact_arrays(src), "codigo_accidente")
    assert fa[4].localidad == 0 and fa[4].hipotesis == [] and fa[4].gravedad_nivel == 3
    assert fa[6].gravedad_nivel == 0                              # P8 level default
    assert {fa[i].gravedad for i in (6, 7, 8)} == {"Desconocida"}  # neither missing nor unlisted severities have a member
    members = star.dim_members(src).where("dimension = 'gravedad'").collect()
    assert {(r.descripcion, r.nivel) for r in members} == {("Con Muertos", 1), ("Con Heridos", 2), ("Solo Daños", 3)}
    assert fa[12].vehiculos_clase == ["AUTOMOVIL", "AUTOMOVIL"] and fa[12].hipotesis == ["H2"]
    assert fa[1].vehiculos_clase == ["AUTOMOVIL", "MOTO", "BUS"]  # source order, later records behind
    assert fa[1].direccion == "Calle 1" and "sexo" in star.bridge_actor(src, star.dim_members(src)).columns
    assert fa[1].hipotesis == ["H1", "H2", "H4"]
    cal = star.dim_calendar(src).where(F.col("fecha") == F.lit("2016-01-05").cast("date")).first()
    assert cal.nombre_mes == "Enero" and cal.dia_semana == "Martes" and cal.dia_semana_num == 1
    assert cal.trimestre == 1 and cal.fecha_id == 20160105


def test_every_query_runs_on_nested_records(spark, path, queries):
    """A user of the reference can point every query at nested JSON records. Model fits are
    left out only to keep the suite short (they were run on this fixture by hand)."""
    failed = {}
    for name, fn in queries.items():
        if name.startswith(("forest", "kmeans", "silhouette")):
            continue
        try:
            fn(spark, path).collect()
        except Exception as e:  # collect every failure, then report them together
            failed[name] = str(e).splitlines()[0][:200]
    assert not failed, failed


@pytest.mark.parametrize("indent", [None, 2])
def test_array_read_by_byte_ranges(spark, queries, indent):
    from vialflow.sources.nested import NESTED_SCHEMA, NestedSource, convert_to_parquet, read_array, read_nested
    d = tempfile.mkdtemp(prefix="vialflow-array-")
    p = os.path.join(d, "a.json")
    many = [dict(r, CODIGO_ACCIDENTE=100 * i + r["CODIGO_ACCIDENTE"], DIRECCION='"CODIGO_ACCIDENTE": }, {é]') for i in range(60) for r in RECORDS]
    with open(p, "w", encoding="utf-8") as f:
        json.dump(many, f, ensure_ascii=False, indent=indent)
    size = "spark.sql.files.maxPartitionBytes"
    was = spark.conf.get(size)
    spark.conf.set(size, str(os.path.getsize(p) // 12))
    cost = spark.conf.get("spark.sql.files.openCostInBytes")
    spark.conf.set("spark.sql.files.openCostInBytes", "1")
    try:
        got = read_array(spark, p)
        assert got.rdd.getNumPartitions() >= 8
        assert got.where("_corrupt is not null").count() == 0
        cols = [f.name for f in NESTED_SCHEMA]
        key = lambda r: repr(r)
        assert sorted(got.select(*cols).collect(), key=key) == sorted(read_nested(spark, p).select(*cols).collect(), key=key)
        # two broken records are counted, the others stay
        text = open(p, encoding="utf-8").read()
        text = text.replace('"2015-03-11"', "oops", 1).replace('"CODIGO_ACCIDENTE": 103', '"CODIGO_ACCIDENTE": "x"', 1)
        with open(os.path.join(d, "b.json"), "w", encoding="utf-8") as f:
            f.write(text)
        out = convert_to_parquet(spark, os.path.join(d, "b.json"), os.path.join(d, "parquet"), by_record=True)
        src = NestedSource(spark, spark.read.parquet(out))
        assert src.corrupt.count() == 2 and src.raw.count() == len(many) - 2
        counts = {r.tabla: r.filas for r in queries["audit_counts"](spark, out).collect()}
        assert counts["registros_corruptos"] == 2 and counts["siniestros_json"] == len(many) - 2
        with open(os.path.join(d, "empty.json"), "w") as f:
            f.write("[ ]")
        assert read_array(spark, os.path.join(d, "empty.json")).count() == 0
    finally:
        spark.conf.set(size, was)
        spark.conf.set("spark.sql.files.openCostInBytes", cost)
