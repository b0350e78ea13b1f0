"""The catalogue's questions as plain SQL that DuckDB runs on the same parquet tables.

This is an independent statement of each query (joins and GROUP BYs written out in SQL,
no shared code with the DataFrame plans) used as the correctness oracle. Counts are
BIGINT, calendar parts INTEGER, rates DOUBLE from exact integer rounding.
"""

from __future__ import annotations

CTE = {
    "ev": """ev AS (
  SELECT o_orderkey AS id, o_custkey AS cliente, CAST(o_orderdate AS DATE) AS fecha,
         CAST(year(o_orderdate) AS INTEGER) AS anio, CAST(month(o_orderdate) AS INTEGER) AS mes,
         CAST(o_orderkey % 24 AS INTEGER) AS hora,
         o_orderstatus AS gravedad,
         CASE o_orderstatus WHEN 'F' THEN 1 WHEN 'P' THEN 2 WHEN 'O' THEN 3 END AS nivel,
         o_orderpriority AS clase
  FROM orders)""",
    "evp": """evp AS (SELECT ev.*, c.c_nationkey AS localidad FROM ev JOIN customer c ON ev.cliente = c.c_custkey)""",
    "pl": """pl AS (SELECT n.n_nationkey AS localidad, n.n_name AS nombre, r.r_name AS zona
  FROM nation n LEFT JOIN region r ON n.n_regionkey = r.r_regionkey)""",
    "hyp": """hyp AS (SELECT DISTINCT l.l_orderkey AS id, p.p_brand AS hipotesis
  FROM lineitem l JOIN part p ON l.l_partkey = p.p_partkey)""",
    "veh": """veh AS (SELECT l.l_orderkey AS id, p.p_type AS clase, l.l_returnflag AS servicio
  FROM lineitem l JOIN part p ON l.l_partkey = p.p_partkey)""",
    "act": """act AS (SELECT l_orderkey AS id, l_linestatus AS condicion, l_returnflag AS estado FROM lineitem)""",
    "hev": """hev AS (SELECT CAST(hour(ts) AS INTEGER) AS hora,
  CASE WHEN event_type = 'error' THEN 1 ELSE 0 END AS fatal FROM events)""",
    "kids": """kids AS (
  SELECT l.l_orderkey AS id, MIN(p.p_brand) AS hipotesis, COUNT(DISTINCT p.p_brand) AS num_hipotesis,
         MIN(p.p_type) AS tipo_vehiculo, COUNT(p.p_type) AS num_vehiculos, COUNT(*) AS num_actores
  FROM lineitem l LEFT JOIN part p ON l.l_partkey = p.p_partkey GROUP BY l.l_orderkey)""",
}
# CTEs that other CTEs depend on
DEPENDS = {"evp": ["ev"]}


def rnd(num: str, den: str, scale: int = 1, digits: int = 1) -> str:
    """Exact half-up round(num*scale/den, digits) as DOUBLE; NULL when den = 0."""
    k = 2 * scale * 10 ** digits
    return (f"CASE WHEN ({den}) <> 0 THEN CAST((CAST({num} AS BIGINT) * {k} + ({den})) // (2 * ({den})) AS DOUBLE)"
            f" / {10 ** digits} END")


def with_(names: str, body: str) -> str:
    """WITH clause holding the named CTEs and, first, everything they depend on."""
    order: list[str] = []

    def add(n: str) -> None:
        for d in DEPENDS.get(n, []):
            add(d)
        if n not in order:
            order.append(n)

    for n in names.split():
        add(n)
    return "WITH " + ",\n".join(CTE[n] for n in order) + "\n" + body


LEVELS = """CAST(COUNT(*) FILTER (WHERE nivel = 1) AS BIGINT) AS con_muertos,
  CAST(COUNT(*) FILTER (WHERE nivel = 2) AS BIGINT) AS con_heridos,
  CAST(COUNT(*) FILTER (WHERE nivel = 3) AS BIGINT) AS solo_danos"""
VALID = "gravedad IN ('F', 'P', 'O')"

PLACE_TABLE = with_("evp pl", f"""
, t AS (SELECT pl.nombre, pl.zona, COUNT(*) AS total, {LEVELS}
  FROM evp JOIN pl ON evp.localidad = pl.localidad GROUP BY pl.nombre, pl.zona)
""".replace("\n, t AS", ", t AS", 1))


def _place(select: str) -> str:
    # PLACE_TABLE ends inside the WITH list; append the final SELECT
    return PLACE_TABLE.rstrip() + "\n" + select


SQL: dict[str, str] = {
    "table_counts": with_("ev", """
SELECT 'fact_siniestros' AS tabla, COUNT(*) AS filas FROM ev
UNION ALL SELECT 'dim_fecha', COUNT(DISTINCT fecha) FROM ev
UNION ALL SELECT 'dim_localidad', COUNT(*) FROM nation
UNION ALL SELECT 'dim_actor', COUNT(*) FROM lineitem"""),

    "severity_counts": with_("ev", """
SELECT gravedad AS descripcion, COUNT(*) AS total FROM ev GROUP BY gravedad, nivel ORDER BY nivel"""),

    "severity_share": with_("ev", f"""
, g AS (SELECT gravedad, COUNT(*) AS total FROM ev WHERE {VALID} GROUP BY gravedad)
SELECT gravedad, total, {rnd('total', 'SUM(total) OVER ()', 100, 1)} AS pct FROM g ORDER BY total DESC, gravedad"""),

    "monthly_trend": with_("ev", """
SELECT anio, mes, COUNT(*) AS total FROM ev WHERE fecha IS NOT NULL GROUP BY anio, mes ORDER BY anio, mes"""),

    "severity_by_year": with_("ev", """
SELECT anio, gravedad AS descripcion, COUNT(*) AS total FROM ev WHERE fecha IS NOT NULL
GROUP BY anio, gravedad, nivel ORDER BY anio, nivel"""),

    "severity_by_year_pct": with_("ev", f"""
, y AS (SELECT anio, gravedad, COUNT(*) AS n FROM ev WHERE fecha IS NOT NULL GROUP BY anio, gravedad)
, tot AS (SELECT anio, SUM(n) AS total_anio FROM y GROUP BY anio)
, lv AS (SELECT * FROM (VALUES ('F'), ('P'), ('O')) v(gravedad))
, cells AS (SELECT tot.anio, lv.gravedad, tot.total_anio FROM tot, lv)
SELECT c.anio, c.gravedad, CAST(COALESCE(y.n, 0) AS BIGINT) AS total,
       {rnd('COALESCE(y.n, 0)', 'c.total_anio', 100, 2)} AS pct
FROM cells c LEFT JOIN y ON y.anio = c.anio AND y.gravedad = c.gravedad ORDER BY 1, 2"""),

    "yearly_pivot": with_("ev", f"""
SELECT anio, COUNT(*) AS total, {LEVELS} FROM ev WHERE {VALID} GROUP BY anio ORDER BY anio"""),

    "totals": with_("ev", f"""
, t AS (SELECT {LEVELS} FROM ev WHERE {VALID})
SELECT con_muertos + con_heridos + solo_danos AS siniestros, con_muertos, con_heridos, solo_danos,
  {rnd('con_muertos', 'con_muertos + con_heridos + solo_danos', 100, 2)} AS pct_muertos,
  {rnd('con_heridos', 'con_muertos + con_heridos + solo_danos', 100, 1)} AS pct_heridos,
  {rnd('solo_danos', 'con_muertos + con_heridos + solo_danos', 100, 1)} AS pct_danos FROM t"""),

    "class_by_severity": with_("ev", """
SELECT clase, gravedad, COUNT(*) AS total FROM ev GROUP BY clase, gravedad, nivel ORDER BY nivel, total DESC, clase"""),

    "class_pivot": with_("ev", f"""
SELECT clase, COUNT(*) AS total, {LEVELS} FROM ev GROUP BY clase ORDER BY total DESC, clase"""),

    "class_top8": with_("ev", f"""
SELECT clase, COUNT(*) AS total FROM ev WHERE {VALID} GROUP BY clase ORDER BY total DESC, clase LIMIT 8"""),

    "hourly_counts": with_("hev", """
SELECT hora, COUNT(*) AS total FROM hev WHERE hora IS NOT NULL GROUP BY hora ORDER BY hora"""),

    "hourly_share_top5": with_("hev", f"""
, g AS (SELECT hora, COUNT(*) AS total FROM hev WHERE hora IS NOT NULL GROUP BY hora)
SELECT hora, total, {rnd('total', 'SUM(total) OVER ()', 100, 1)} AS pct FROM g ORDER BY total DESC, hora LIMIT 5"""),

    "fatal_hour": with_("hev", """
SELECT hora, CAST(SUM(CASE WHEN fatal = 1 THEN 1 ELSE 0 END) AS BIGINT) AS muertos, COUNT(*) AS total
FROM hev WHERE hora IS NOT NULL GROUP BY hora ORDER BY hora"""),

    "hour_bands": with_("hev", """
, g AS (SELECT hora, COUNT(*) AS total FROM hev WHERE hora IS NOT NULL GROUP BY hora)
, r AS (SELECT hora, total, CAST(total AS DOUBLE) / MAX(total) OVER () AS ratio FROM g)
SELECT hora, total, ratio, CASE WHEN ratio > 0.85 THEN 'muy_alta' WHEN ratio > 0.65 THEN 'alta'
  WHEN ratio > 0.40 THEN 'media' ELSE 'baja' END AS banda, lpad(CAST(hora AS VARCHAR), 2, '0') || 'h' AS etiqueta
FROM r ORDER BY hora"""),

    "peak_fatal_hour": with_("hev", """
SELECT hora, CAST(SUM(fatal) AS BIGINT) AS muertos FROM hev WHERE hora IS NOT NULL GROUP BY hora
ORDER BY muertos DESC, hora LIMIT 1"""),

    "cause_top10": with_("ev hyp", """
SELECT hipotesis AS descripcion, COUNT(*) AS total FROM hyp WHERE id IN (SELECT id FROM ev)
GROUP BY hipotesis ORDER BY total DESC, descripcion LIMIT 10"""),

    "fatal_cause_top10": with_("ev hyp", """
SELECT hipotesis AS descripcion, COUNT(*) AS total FROM hyp WHERE id IN (SELECT id FROM ev WHERE nivel = 1)
GROUP BY hipotesis ORDER BY total DESC, descripcion LIMIT 10"""),

    "cause_by_year": with_("ev hyp", """
SELECT ev.anio, hyp.hipotesis AS descripcion, COUNT(*) AS total FROM hyp JOIN ev ON hyp.id = ev.id
WHERE ev.fecha IS NOT NULL GROUP BY ev.anio, hyp.hipotesis ORDER BY 1, total DESC, descripcion"""),

    "top_cause_per_year": with_("ev hyp", """
, g AS (SELECT ev.anio, hyp.hipotesis AS descripcion, COUNT(*) AS total FROM hyp JOIN ev ON hyp.id = ev.id
  WHERE ev.fecha IS NOT NULL GROUP BY ev.anio, hyp.hipotesis)
SELECT anio, descripcion, total FROM g
QUALIFY ROW_NUMBER() OVER (PARTITION BY anio ORDER BY total DESC, descripcion) = 1 ORDER BY anio"""),

    "first_cause_top8": with_("ev kids", f"""
SELECT COALESCE(k.hipotesis, 'Desconocida') AS hipotesis, COUNT(*) AS total
FROM ev LEFT JOIN kids k ON ev.id = k.id WHERE {VALID} GROUP BY 1 ORDER BY total DESC, hipotesis LIMIT 8"""),

    "first_vehicle_top8": with_("ev kids", f"""
SELECT COALESCE(k.tipo_vehiculo, 'Otro') AS tipo_vehiculo, COUNT(*) AS total
FROM ev LEFT JOIN kids k ON ev.id = k.id WHERE {VALID} GROUP BY 1 ORDER BY total DESC, tipo_vehiculo LIMIT 8"""),

    "vehicle_top8": with_("veh", """
SELECT clase, COUNT(*) AS total FROM veh GROUP BY clase ORDER BY total DESC, clase LIMIT 8"""),

    "condition_counts": with_("act", """
SELECT condicion, COUNT(*) AS total FROM act GROUP BY condicion ORDER BY total DESC, condicion"""),

    "service_counts": with_("veh", """
SELECT servicio, COUNT(*) AS total FROM veh GROUP BY servicio ORDER BY total DESC, servicio"""),

    "fatal_vehicle_top10": with_("ev veh", """
SELECT clase AS descripcion, COUNT(*) AS muertos FROM veh WHERE id IN (SELECT id FROM ev WHERE nivel = 1)
GROUP BY clase ORDER BY muertos DESC, descripcion LIMIT 10"""),

    "actor_state": with_("act", """
SELECT condicion, estado, COUNT(*) AS total FROM act GROUP BY condicion, estado
ORDER BY condicion NULLS LAST, estado NULLS LAST"""),

    "actor_mortality": with_("act", f"""
, g AS (SELECT condicion, CAST(COUNT(*) FILTER (WHERE estado = 'R') AS BIGINT) AS muertos,
  CAST(COUNT(*) FILTER (WHERE estado = 'A') AS BIGINT) AS heridos,
  CAST(COUNT(*) FILTER (WHERE estado = 'N') AS BIGINT) AS ilesos, COUNT(*) AS total FROM act GROUP BY condicion)
, r AS (SELECT condicion, muertos, heridos, ilesos, total, COALESCE({rnd('muertos', 'total', 1000, 2)}, 0.0) AS tasa FROM g)
, q AS (SELECT *, CASE WHEN MAX(tasa) OVER () = 0 THEN NULL ELSE tasa / MAX(tasa) OVER () END AS ratio FROM r)
SELECT condicion, condicion AS etiqueta, muertos, heridos, ilesos, total, tasa,
  CASE WHEN ratio > 0.7 THEN 'alta' WHEN ratio > 0.4 THEN 'media' ELSE 'baja' END AS banda
FROM q ORDER BY tasa DESC, condicion"""),

    "deaths_by_condition": with_("act", """
SELECT condicion AS descripcion, COUNT(*) AS muertos FROM act WHERE estado = 'R' GROUP BY condicion
ORDER BY muertos DESC, descripcion"""),

    "seasonality": with_("ev", f"""
, m AS (SELECT anio, mes, COUNT(*) AS n FROM ev WHERE fecha IS NOT NULL GROUP BY anio, mes)
SELECT mes, (['Ene','Feb','Mar','Abr','May','Jun','Jul','Ago','Sep','Oct','Nov','Dic'])[mes] AS etiqueta,
  {rnd('SUM(n)', 'COUNT(*)', 1, 0)} AS promedio FROM m GROUP BY mes ORDER BY mes"""),

    "weekday_counts": with_("ev", """
, g AS (SELECT CAST(isodow(fecha) - 1 AS INTEGER) AS dia_semana, COUNT(*) AS total FROM ev
  WHERE fecha IS NOT NULL GROUP BY 1)
SELECT dia_semana, (['Lunes','Martes','Miércoles','Jueves','Viernes','Sábado','Domingo'])[dia_semana + 1] AS nombre,
  total FROM g ORDER BY dia_semana"""),

    "place_table": _place(f"""SELECT nombre, zona, total, con_muertos, con_heridos, solo_danos,
  {rnd('con_muertos', 'total', 1000, 1)} AS tasa_mortalidad FROM t ORDER BY con_muertos DESC, nombre"""),

    "place_total": _place(f""", s AS (SELECT CAST(SUM(total) AS BIGINT) AS total, CAST(SUM(con_muertos) AS BIGINT) AS con_muertos,
  CAST(SUM(con_heridos) AS BIGINT) AS con_heridos, CAST(SUM(solo_danos) AS BIGINT) AS solo_danos FROM t)
SELECT total, con_muertos, con_heridos, solo_danos, {rnd('con_muertos', 'total', 1000, 1)} AS tasa_mortalidad FROM s"""),

    "place_search": _place(f""", r AS (SELECT nombre, zona, total, con_muertos, con_heridos, solo_danos,
  {rnd('con_muertos', 'total', 1000, 1)} AS tasa_mortalidad FROM t)
SELECT * FROM r WHERE contains(lower(nombre), 'nation_1') AND tasa_mortalidad >= 330.0
ORDER BY con_muertos DESC, nombre"""),

    "place_shares": _place(f"""SELECT nombre, total,
  {rnd('con_muertos', 'total', 100, 1)} AS pct_muertos,
  {rnd('con_heridos', 'total', 100, 1)} AS pct_heridos,
  {rnd('solo_danos', 'total', 100, 1)} AS pct_danos,
  CASE WHEN {rnd('con_muertos', 'total', 1000, 1)} > 20 THEN 'alta' WHEN {rnd('con_muertos', 'total', 1000, 1)} > 12
    THEN 'media' ELSE 'baja' END AS banda_tasa FROM t"""),

    "zone_counts": with_("evp pl", """
SELECT pl.zona, COUNT(*) AS total FROM evp JOIN pl ON evp.localidad = pl.localidad GROUP BY pl.zona
ORDER BY total DESC, zona"""),

    "place_top10": with_("ev", f"""
SELECT c.c_nationkey AS localidad, COUNT(*) AS total, CAST(COUNT(*) FILTER (WHERE nivel = 1) AS BIGINT) AS con_muertos
FROM ev LEFT JOIN customer c ON ev.cliente = c.c_custkey WHERE {VALID} GROUP BY 1
ORDER BY total DESC, localidad NULLS LAST LIMIT 10"""),

    "place_topn_by": with_("evp pl", f"""
, g AS (SELECT localidad, {LEVELS} FROM evp WHERE anio = 1998 GROUP BY localidad)
SELECT g.localidad, COALESCE(pl.nombre, 'Loc. ' || CAST(g.localidad AS VARCHAR)) AS nombre,
  g.con_muertos, g.con_heridos, g.solo_danos, g.con_muertos AS valor
FROM g LEFT JOIN pl ON g.localidad = pl.localidad ORDER BY valor DESC, g.localidad LIMIT 10"""),

    # 32 bits of an md5 of the key part the rows, alike in any engine
    "split_counts": with_("ev", f"""
, s AS (SELECT gravedad, ('0x' || substr(md5(CAST(id AS VARCHAR) || ':42'), 1, 8))::BIGINT % 100 < 80 AS train FROM ev WHERE {VALID})
SELECT gravedad, CAST(SUM(CASE WHEN train THEN 1 ELSE 0 END) AS BIGINT) AS n_train,
  CAST(SUM(CASE WHEN train THEN 0 ELSE 1 END) AS BIGINT) AS n_test FROM s GROUP BY gravedad"""),

    "place_topn_all": with_("evp pl", f"""
, g AS (SELECT localidad, {LEVELS} FROM evp GROUP BY localidad)
SELECT g.localidad, COALESCE(pl.nombre, 'Loc. ' || CAST(g.localidad AS VARCHAR)) AS nombre,
  g.con_muertos, g.con_heridos, g.solo_danos, g.con_muertos + g.con_heridos + g.solo_danos AS valor
FROM g LEFT JOIN pl ON g.localidad = pl.localidad ORDER BY valor DESC, g.localidad LIMIT 10"""),

    "place_severity_year": with_("evp", f"""
, g AS (SELECT anio, localidad, {LEVELS} FROM evp WHERE fecha IS NOT NULL GROUP BY anio, localidad)
SELECT anio, localidad AS codigo_localidad, 'F' AS gravedad, con_muertos AS total FROM g
UNION ALL SELECT anio, localidad, 'P', con_heridos FROM g
UNION ALL SELECT anio, localidad, 'O', solo_danos FROM g"""),

    "fatal_place_top5": with_("evp pl", """
SELECT pl.nombre, COUNT(*) AS total FROM evp JOIN pl ON evp.localidad = pl.localidad WHERE evp.nivel = 1
GROUP BY pl.nombre ORDER BY total DESC, nombre LIMIT 5"""),

    "place_mortality_rank": _place(f""", r AS (SELECT nombre, total, con_muertos AS muertos,
  {rnd('con_muertos', 'total', 1000, 1)} AS tasa FROM t)
, q AS (SELECT *, tasa / MAX(tasa) OVER () AS ratio FROM r)
SELECT nombre, total, muertos, tasa, ratio,
  CASE WHEN ratio > 0.75 THEN 'alta' WHEN ratio > 0.45 THEN 'media' ELSE 'baja' END AS banda FROM q"""),
}


# ------------------------------------------------------------------ warehouse, audits, flat views
CTE["members"] = """members AS (
  SELECT dimension, CAST(ROW_NUMBER() OVER (PARTITION BY dimension ORDER BY descripcion) AS INTEGER) AS member_id,
         descripcion, nivel FROM (
    SELECT 'gravedad' AS dimension, * FROM (VALUES ('F', 1), ('P', 2), ('O', 3)) l(descripcion, nivel)
    UNION SELECT DISTINCT 'clase', o_orderpriority, CAST(NULL AS INTEGER) FROM orders
    UNION SELECT DISTINCT 'hipotesis', p_brand, CAST(NULL AS INTEGER) FROM part WHERE p_partkey IN (SELECT l_partkey FROM lineitem)
    UNION SELECT DISTINCT 'vehiculo_clase', p_type, CAST(NULL AS INTEGER) FROM part WHERE p_partkey IN (SELECT l_partkey FROM lineitem)
    UNION SELECT DISTINCT 'condicion', l_linestatus, CAST(NULL AS INTEGER) FROM lineitem) m
  WHERE descripcion <> '')"""
CTE["fa"] = """fa AS (
  SELECT ev.id AS codigo_accidente, CASE WHEN ev.nivel IS NULL THEN 'Desconocida' ELSE ev.gravedad END AS gravedad, COALESCE(ev.nivel, 0) AS gravedad_nivel,
         COALESCE(NULLIF(ev.clase, ''), 'Desconocida') AS clase, COALESCE(c.c_nationkey, -1) AS localidad,
         COALESCE(h.txt, '') AS hipotesis, COALESCE(v.txt, '') AS vehiculos_clase,
         COALESCE(k.num_vehiculos, 0) AS n_vehiculos, COALESCE(k.num_actores, 0) AS n_actores
  FROM ev LEFT JOIN customer c ON ev.cliente = c.c_custkey
  LEFT JOIN (SELECT id, string_agg(p_brand, '|' ORDER BY pos NULLS FIRST, p_brand) AS txt FROM
     (SELECT l_orderkey AS id, p_brand, MIN(l_linenumber) AS pos FROM lineitem JOIN part ON l_partkey = p_partkey
      WHERE p_brand IS NOT NULL GROUP BY ALL) GROUP BY id) h ON ev.id = h.id
  LEFT JOIN (SELECT l_orderkey AS id, string_agg(p_type, '|' ORDER BY l_linenumber NULLS FIRST, p_brand NULLS FIRST, p_type) AS txt
     FROM lineitem JOIN part ON l_partkey = p_partkey WHERE p_type IS NOT NULL GROUP BY ALL) v ON ev.id = v.id
  LEFT JOIN kids k ON ev.id = k.id)"""
CTE["dl"] = """dl AS (
  SELECT d.localidad AS localidad_id, d.localidad AS codigo_localidad,
         COALESCE(pl.nombre, 'Desconocida') AS nombre, COALESCE(pl.zona, 'Desconocida') AS zona
  FROM (SELECT DISTINCT localidad FROM fa) d LEFT JOIN pl ON d.localidad = pl.localidad)"""
DEPENDS.update({"fa": ["ev", "hyp", "veh", "kids"], "dl": ["pl", "fa"]})

CAL = """CAST(year(fecha) * 10000 + month(fecha) * 100 + day(fecha) AS INTEGER)"""
MONTHS = "['Enero','Febrero','Marzo','Abril','Mayo','Junio','Julio','Agosto','Septiembre','Octubre','Noviembre','Diciembre']"
DAYS = "['Lunes','Martes','Miércoles','Jueves','Viernes','Sábado','Domingo']"


def _fk(child, ck, parent, pk):
    return (f"SELECT '{child}.{ck}' AS hijo, '{parent}.{pk}' AS padre, COUNT(*) AS huerfanos FROM {child} "
            f"WHERE {ck} IS NOT NULL AND {ck} NOT IN (SELECT {pk} FROM {parent} WHERE {pk} IS NOT NULL)")


def _uniq(table, keys):
    k = ", ".join(keys)
    return (f"SELECT '{table}' AS tabla, '{','.join(keys)}' AS clave, COUNT(*) AS claves_repetidas, "
            f"CAST(COALESCE(SUM(n - 1), 0) AS BIGINT) AS filas_sobrantes "
            f"FROM (SELECT {k}, COUNT(*) AS n FROM {table} GROUP BY {k} HAVING COUNT(*) > 1)")


def _nn(table, cols):
    return "\nUNION ALL ".join(
        f"SELECT '{table}' AS tabla, '{c}' AS columna, COUNT(*) FILTER (WHERE {c} IS NULL) AS nulos FROM {table}"
        for c in cols)


SQL.update({
    "dim_calendar": with_("ev", f"""
, d AS (SELECT DISTINCT fecha FROM ev WHERE fecha IS NOT NULL)
SELECT {CAL} AS fecha_id, fecha, CAST(year(fecha) AS INTEGER) AS anio, CAST(month(fecha) AS INTEGER) AS mes,
  CAST(day(fecha) AS INTEGER) AS dia, CAST(quarter(fecha) AS INTEGER) AS trimestre,
  ({MONTHS})[month(fecha)] AS nombre_mes, ({DAYS})[isodow(fecha)] AS dia_semana,
  CAST(isodow(fecha) - 1 AS INTEGER) AS dia_semana_num FROM d"""),

    "dim_members": with_("members", "SELECT * FROM members"),

    "fact_v1": with_("ev kids members", f"""
SELECT ev.id AS codigo_accidente, {CAL} AS fecha_id, c.c_nationkey AS localidad_id, g.nivel AS gravedad_nivel,
  m.member_id AS clase_id, ev.hora, COALESCE(k.num_vehiculos, 0) AS n_vehiculos, COALESCE(k.num_actores, 0) AS n_actores
FROM ev LEFT JOIN customer c ON ev.cliente = c.c_custkey
LEFT JOIN (SELECT descripcion, nivel FROM members WHERE dimension = 'gravedad') g ON ev.gravedad = g.descripcion
LEFT JOIN (SELECT * FROM members WHERE dimension = 'clase') m ON ev.clase = m.descripcion
LEFT JOIN kids k ON ev.id = k.id"""),

    "bridge_hypothesis": with_("hyp members", """
SELECT hyp.id AS codigo_accidente, m.member_id AS hipotesis_id FROM hyp
JOIN members m ON m.dimension = 'hipotesis' AND m.descripcion = hyp.hipotesis"""),

    "bridge_vehicle": with_("veh members", """
SELECT veh.id AS codigo_accidente, m.member_id AS vehiculo_id, veh.servicio FROM veh
JOIN members m ON m.dimension = 'vehiculo_clase' AND m.descripcion = veh.clase"""),

    "bridge_actor": with_("act members", """
SELECT act.id AS codigo_accidente, m.member_id AS condicion_id, act.estado FROM act
JOIN members m ON m.dimension = 'condicion' AND m.descripcion = act.condicion"""),

    "child_dims": with_("act", """
SELECT ROW_NUMBER() OVER (ORDER BY id, condicion, estado) AS actor_id, id AS siniestro_id, condicion, estado FROM act"""),

    "child_dim_hypothesis": with_("hyp", """
SELECT ROW_NUMBER() OVER (ORDER BY id, hipotesis) AS hipotesis_id, id AS siniestro_id, hipotesis AS descripcion FROM hyp"""),

    "child_dim_vehicle": with_("veh", """
SELECT ROW_NUMBER() OVER (ORDER BY id, clase, servicio) AS vehiculo_id, id AS siniestro_id, clase, servicio FROM veh"""),

    "fact_arrays": with_("fa", "SELECT * FROM fa"),

    "dim_localidad": with_("dl", "SELECT * FROM dl"),

    "fact_rekeyed": with_("dl", """
SELECT fa.codigo_accidente, dl.localidad_id, dl.nombre, dl.zona, fa.gravedad_nivel, fa.n_actores
FROM fa LEFT JOIN dl ON fa.localidad = dl.codigo_localidad"""),

    "audit_fk": "\nUNION ALL ".join([
        _fk("lineitem", "l_orderkey", "orders", "o_orderkey"),
        _fk("lineitem", "l_partkey", "part", "p_partkey"),
        _fk("lineitem", "l_suppkey", "supplier", "s_suppkey"),
        _fk("orders", "o_custkey", "customer", "c_custkey"),
        _fk("customer", "c_nationkey", "nation", "n_nationkey"),
        _fk("supplier", "s_nationkey", "nation", "n_nationkey"),
        _fk("nation", "n_regionkey", "region", "r_regionkey")]),

    "audit_unique": "\nUNION ALL ".join([
        _uniq("orders", ["o_orderkey"]), _uniq("customer", ["c_custkey"]), _uniq("part", ["p_partkey"]),
        _uniq("supplier", ["s_suppkey"]), _uniq("nation", ["n_nationkey"]),
        _uniq("lineitem", ["l_orderkey", "l_linenumber"])]),

    "audit_notnull": "\nUNION ALL ".join([
        _nn("orders", ["o_orderkey", "o_custkey", "o_orderdate", "o_orderstatus", "o_orderpriority"]),
        _nn("lineitem", ["l_orderkey", "l_partkey", "l_returnflag", "l_linestatus"]),
        _nn("customer", ["c_custkey", "c_nationkey"])]),

    "audit_counts": with_("hyp veh", """
SELECT 'orders' AS tabla, COUNT(*) AS filas FROM orders
UNION ALL SELECT 'fact_siniestros', COUNT(*) FROM orders
UNION ALL SELECT 'lineitem', COUNT(*) FROM lineitem
UNION ALL SELECT 'bridge_hipotesis', COUNT(*) FROM hyp
UNION ALL SELECT 'dim_vehiculo', COUNT(*) FROM veh
UNION ALL SELECT 'dim_actor', COUNT(*) FROM lineitem"""),

    "flat_events": with_("ev kids", f"""
SELECT ev.id AS codigo_accidente, ev.fecha, ev.anio, ev.mes, COALESCE(ev.hora, -1) AS hora, ev.gravedad, ev.clase,
  c.c_nationkey AS localidad, COALESCE(k.hipotesis, 'Desconocida') AS hipotesis,
  COALESCE(k.tipo_vehiculo, 'Otro') AS tipo_vehiculo, COALESCE(k.num_hipotesis, 0) AS num_hipotesis,
  COALESCE(k.num_vehiculos, 0) AS num_vehiculos, COALESCE(k.num_actores, 0) AS num_actores
FROM ev LEFT JOIN kids k ON ev.id = k.id LEFT JOIN customer c ON ev.cliente = c.c_custkey WHERE {VALID}"""),

    "feature_table": with_("ev kids", """
, f AS (SELECT ev.id AS codigo_accidente, COALESCE(CAST(ev.hora AS DOUBLE), 0.0) AS hora, ev.gravedad,
  ev.clase AS clase_siniestro, COALESCE(CAST(c.c_nationkey AS VARCHAR), '0') AS localidad,
  COALESCE(k.hipotesis, 'Desconocida') AS hipotesis, COALESCE(k.tipo_vehiculo, 'Otro') AS tipo_vehiculo,
  CAST(COALESCE(k.num_vehiculos, 0) AS DOUBLE) AS num_vehiculos, CAST(COALESCE(k.num_actores, 0) AS DOUBLE) AS num_actores
  FROM ev LEFT JOIN kids k ON ev.id = k.id LEFT JOIN customer c ON ev.cliente = c.c_custkey
  WHERE ev.gravedad IS NOT NULL AND ev.gravedad <> '')
SELECT *, CAST(DENSE_RANK() OVER (ORDER BY clase_siniestro) - 1 AS DOUBLE) AS clase_siniestro_idx,
  CAST(DENSE_RANK() OVER (ORDER BY localidad) - 1 AS DOUBLE) AS localidad_idx,
  CAST(DENSE_RANK() OVER (ORDER BY hipotesis) - 1 AS DOUBLE) AS hipotesis_idx,
  CAST(DENSE_RANK() OVER (ORDER BY tipo_vehiculo) - 1 AS DOUBLE) AS tipo_vehiculo_idx,
  CAST(DENSE_RANK() OVER (ORDER BY gravedad) - 1 AS DOUBLE) AS gravedad_idx FROM f"""),
})


# ------------------------------------------------------------------ mining table, samples, folds, encoders
CTE["fe"] = """fe AS (SELECT id, gravedad FROM ev WHERE gravedad IS NOT NULL AND gravedad <> '')"""
CTE["smp"] = """smp AS (
  WITH c AS (SELECT gravedad, COUNT(*) AS n FROM fe GROUP BY gravedad),
  q0 AS (SELECT gravedad, (n * 3000) // t.tot AS base, (n * 3000) % t.tot AS rem FROM c, (SELECT SUM(n) AS tot FROM c) t),
  q AS (SELECT gravedad, base + CASE WHEN ROW_NUMBER() OVER (ORDER BY rem DESC, gravedad) <= 3000 - SUM(base) OVER ()
        THEN 1 ELSE 0 END AS quota FROM q0),
  r AS (SELECT id, gravedad, ROW_NUMBER() OVER (PARTITION BY gravedad ORDER BY md5(CAST(id AS VARCHAR) || ':42'), id) AS rn
        FROM fe)
  SELECT r.id, r.gravedad FROM r JOIN q ON r.gravedad = q.gravedad WHERE r.rn <= q.quota)"""
CTE["mt"] = """mt AS (
  SELECT ev.id, COALESCE(CAST(ev.hora AS DOUBLE), 0.0) AS hora, ev.clase AS clase_siniestro,
         COALESCE(CAST(c.c_nationkey AS VARCHAR), '0') AS localidad, COALESCE(k.hipotesis, 'Desconocida') AS hipotesis,
         COALESCE(k.tipo_vehiculo, 'Otro') AS tipo_vehiculo, CAST(COALESCE(k.num_vehiculos, 0) AS DOUBLE) AS num_vehiculos,
         CAST(COALESCE(k.num_actores, 0) AS DOUBLE) AS num_actores
  FROM ev LEFT JOIN kids k ON ev.id = k.id LEFT JOIN customer c ON ev.cliente = c.c_custkey)"""
DEPENDS.update({"fe": ["ev"], "smp": ["fe"], "mt": ["ev", "kids"]})


def _mm(c: str) -> str:
    """[0, 1] scaling as Spark's MinMaxScaler evaluates it: x * s + (-min * s) with
    s = 1 / (max - min); a constant column maps to 0.5."""
    return (f"CASE WHEN MAX({c}) OVER () <> MIN({c}) OVER () THEN {c} * (1.0 / (MAX({c}) OVER () - MIN({c}) OVER ()))"
            f" + (-MIN({c}) OVER () * (1.0 / (MAX({c}) OVER () - MIN({c}) OVER ())) + 0.0) ELSE 0.5 END")


SQL.update({
    "class_weights": with_("fe", """
, c AS (SELECT gravedad, COUNT(*) AS n_clase FROM fe GROUP BY gravedad)
SELECT gravedad, n_clase, SUM(n_clase) OVER () / (COUNT(*) OVER () * n_clase) AS peso FROM c"""),

    "folds": with_("fe", """
SELECT id AS codigo_accidente, gravedad,
  CAST((ROW_NUMBER() OVER (PARTITION BY gravedad ORDER BY md5(CAST(id AS VARCHAR) || ':42'), id) - 1) % 10 AS INTEGER) AS fold
FROM fe"""),

    "stratified_sample": with_("smp", "SELECT id AS codigo_accidente, gravedad FROM smp"),

    "one_hot_minmax": with_("mt", f"""
, f AS (SELECT * FROM mt)
, sz AS (SELECT COUNT(DISTINCT clase_siniestro) AS a, COUNT(DISTINCT localidad) AS b, COUNT(DISTINCT hipotesis) AS c FROM f)
, e AS (SELECT id, DENSE_RANK() OVER (ORDER BY clase_siniestro) - 1 AS i1, DENSE_RANK() OVER (ORDER BY localidad) - 1 AS i2,
         DENSE_RANK() OVER (ORDER BY hipotesis) - 1 AS i3, DENSE_RANK() OVER (ORDER BY tipo_vehiculo) - 1 AS i4,
         {_mm('hora')} AS hora_mm, {_mm('num_vehiculos')} AS num_vehiculos_mm, {_mm('num_actores')} AS num_actores_mm FROM f)
SELECT e.id AS codigo_accidente,
  CAST(i1 AS VARCHAR) || '|' || CAST(sz.a + i2 AS VARCHAR) || '|' || CAST(sz.a + sz.b + i3 AS VARCHAR) || '|'
    || CAST(sz.a + sz.b + sz.c + i4 AS VARCHAR) AS onehot,
  hora_mm, num_vehiculos_mm, num_actores_mm
FROM e, sz"""),
})


# ------------------------------------------------------------------ warehouse SQL over the star views
# Same questions as the catalogue where both count the same rows; the hour queries read the
# fact's own hour, and the locality dimension is the set of place codes used by the fact.
SQL.update({
    "sql_conteos": with_("ev", """
SELECT 'fact_siniestros' AS tabla, COUNT(*) AS filas FROM ev
UNION ALL SELECT 'dim_fecha', COUNT(DISTINCT fecha) FROM ev
UNION ALL SELECT 'dim_localidad', COUNT(DISTINCT COALESCE(c.c_nationkey, -1))
  FROM ev LEFT JOIN customer c ON ev.cliente = c.c_custkey
UNION ALL SELECT 'dim_actor', COUNT(*) FROM lineitem"""),
    "sql_gravedad": SQL["severity_counts"],
    "sql_tendencia": SQL["monthly_trend"],
    "sql_por_hora": with_("ev", """
SELECT hora, COUNT(*) AS total FROM ev WHERE hora IS NOT NULL GROUP BY hora ORDER BY hora"""),
    "sql_hipotesis": SQL["cause_top10"],
    "sql_evolucion_gravedad": SQL["severity_by_year"],
    "sql_actores_estado": SQL["actor_state"],
    "sql_hora_fatal": with_("ev", """
SELECT hora, CAST(SUM(CASE WHEN nivel = 1 THEN 1 ELSE 0 END) AS BIGINT) AS muertos, COUNT(*) AS total
FROM ev WHERE hora IS NOT NULL GROUP BY hora ORDER BY hora"""),
    "sql_causas_fatales": SQL["fatal_cause_top10"],
    "sql_clase_gravedad": SQL["class_by_severity"],
    "sql_tabla_localidades": SQL["place_table"],
})

SQL.update({
    "fact_sample": with_("fa", """
SELECT * FROM fa WHERE hipotesis <> '' ORDER BY codigo_accidente LIMIT 3"""),
    "hourly_sentinel": with_("ev", f"""
SELECT COALESCE(hora, -1) AS hora, COUNT(*) AS total FROM ev WHERE {VALID} AND COALESCE(hora, -1) >= 0
GROUP BY 1 ORDER BY 1"""),
})

# A5: each smoke-checked query has its columns (checked by name on the Spark side) and rows.
_CONTRACTED = ["severity_counts", "severity_by_year", "actor_state", "fatal_hour", "fatal_cause_top10",
               "class_by_severity", "place_table", "table_counts"]
SQL["audit_contracts"] = "\nUNION ALL ".join(
    f"SELECT '{n}' AS consulta, '' AS faltan, NOT EXISTS ({SQL[n]}) AS vacia, EXISTS ({SQL[n]}) AS ok"
    for n in _CONTRACTED)

# Two loads: early orders without the class that sorts first, then all.
_APPEND = """
WITH ev AS (SELECT o_orderkey AS id, CAST(o_orderdate AS DATE) AS fecha, o_orderstatus AS gravedad, o_orderpriority AS clase,
    year(CAST(o_orderdate AS DATE)) < 1995 AND o_orderpriority <> '1-URGENT' AS temprano FROM orders),
val AS (SELECT 'gravedad' AS dimension, gravedad AS descripcion, temprano FROM ev UNION ALL SELECT 'clase', clase, temprano FROM ev),
seen AS (SELECT dimension, descripcion, CASE WHEN bool_or(temprano) THEN 1 ELSE 2 END AS lote FROM val
    WHERE descripcion IS NOT NULL GROUP BY ALL),
m AS (SELECT dimension, descripcion, lote, CAST(row_number() OVER (PARTITION BY dimension ORDER BY lote, descripcion) AS INTEGER) AS member_id FROM seen)
"""
SQL["append_members"] = _APPEND + """
SELECT dimension, member_id, descripcion,
  CASE WHEN dimension = 'gravedad' THEN CASE descripcion WHEN 'F' THEN 1 WHEN 'P' THEN 2 WHEN 'O' THEN 3 END END AS nivel, lote FROM m"""
SQL["append_facts"] = _APPEND + """
SELECT ev.id AS codigo_accidente, CAST(year(fecha) * 10000 + month(fecha) * 100 + day(fecha) AS INTEGER) AS fecha_id, g.member_id AS gravedad_id,
  c.member_id AS clase_id, CAST(ev.id % 24 AS INTEGER) AS hora, CASE WHEN temprano THEN 1 ELSE 2 END AS lote
FROM ev LEFT JOIN m c ON c.dimension = 'clase' AND c.descripcion = ev.clase
LEFT JOIN m g ON g.dimension = 'gravedad' AND g.descripcion = ev.gravedad"""

SQL["score_quartiles"] = """
SELECT o_orderstatus AS gravedad, COUNT(*) AS n, quantile_disc(p, 0.25) AS q1, quantile_disc(p, 0.5) AS mediana, quantile_disc(p, 0.75) AS q3
FROM (SELECT o_orderstatus, CAST((o_orderkey * 7919) % 10007 AS DOUBLE) / 10007 + CAST(o_orderkey % 24 AS DOUBLE) AS p FROM orders) GROUP BY 1"""
