"""Further batches: keys and rows already stored stay as they are."""

import tempfile

import pytest
from pyspark.sql import functions as F

from conftest import SF0001
from vialflow.plans import load
from vialflow.sources.tables import EventSource


def rows(df):
    return sorted(map(tuple, df.collect()), key=str)


def test_three_loads(spark):
    out = tempfile.mkdtemp(prefix="vialflow-load-")
    s = EventSource(spark, SF0001)
    ev = s.events()
    assert load.read_table(spark, out, "dim_members") is None
    early = ev.where((F.col("codigo_accidente") % 2 == 0) & (F.col("clase") != "1-URGENT") & (F.col("gravedad") != "F"))
    assert load.load_batch(s, out, early) == 1
    members, fact = (rows(load.read_table(spark, out, t)) for t in load.TABLES)
    # a later record of a stored event does not change it
    changed = ev.withColumn("hora", F.lit(99))
    assert load.load_batch(s, out, changed) == 2
    members2, fact2 = (rows(load.read_table(spark, out, t)) for t in load.TABLES)
    assert set(members) < set(members2) and set(fact) < set(fact2)
    keys = {(d, k) for d, k, *_ in members2}
    assert len(keys) == len(members2)                   # no key twice in a dimension
    assert {k for d, k, v, _ in members2 if v == "1-URGENT"} == {5} and {k for d, k, v, _ in members2 if v == "F"} == {3}
    assert len(fact2) == len({r[0] for r in fact2}) == ev.count()
    assert {r[5] for r in fact2 if r[0] in {f[0] for f in fact}} == {1}
    # the same again adds nothing
    assert load.load_batch(s, out) == 3
    assert [rows(load.read_table(spark, out, t)) for t in load.TABLES] == [members2, fact2]


def test_a_failed_load_is_never_seen(spark, monkeypatch):
    out = tempfile.mkdtemp(prefix="vialflow-load-")
    s = EventSource(spark, SF0001)
    load.load_batch(s, out, s.events().where("codigo_accidente % 2 = 0"))
    before = rows(load.read_table(spark, out, "fact_siniestros"))
    monkeypatch.setattr(load, "keyed", lambda *a: (_ for _ in ()).throw(RuntimeError("lost")))
    with pytest.raises(RuntimeError):
        load.load_batch(s, out)
    assert rows(load.read_table(spark, out, "fact_siniestros")) == before and load.committed(spark, out) == [1]
    monkeypatch.undo()
    assert load.load_batch(s, out) == 2
    # a number is committed once
    fs, mark = load._fs(spark, f"{out}/_commits/2")
    with pytest.raises(Exception):
        fs.create(mark, False)


def test_nulls_and_repeats(spark):
    stored = spark.createDataFrame([("a", 4, "x")], "dimension string, member_id int, descripcion string")
    values = spark.createDataFrame([("a", "x"), ("a", "w"), ("a", "w"), ("a", None), ("b", "q")], "dimension string, descripcion string")
    got = load.assign_keys(stored, values).select("dimension", "member_id", "descripcion")
    assert rows(got) == [("a", 5, "w"), ("b", 1, "q")]
    assert load.assign_keys(stored, values.limit(0)).count() == 0
