"""Metrics, catalogs, boxes, ordered scans and progress."""

from __future__ import annotations

from pyspark.sql import functions as F

from conformance import fixtures as X
from conformance.queries.matching import CENTRE, PLACED, V1, V3, cascade_rows
from conformance.registry import query
from deslinde.functions import geometry as G
from deslinde.functions import coords as M
from deslinde.operators import metrics as A
from deslinde.operators import ordered as O
from deslinde.operators import planning as L
from deslinde.plans import cascade as P
from deslinde.session import large
from deslinde.sources import tables as R

MATCH = ["fx_parcels", "fx_polygons"]


def v3(spark, sf):
    return P.match_cascade_v3(X.parcels(spark, sf), X.polygons(spark, sf))


def with_attributes(spark, sf):
    return v3(spark, sf).join(large(X.parcels(spark, sf).select("ok", *P.KEY, "ubicacion", "lat")), P.KEY)


@query("match_metrics", f"""{V3},
  p AS (SELECT comuna, count(*) AS n, count(*) FILTER (WHERE x_u IS NOT NULL) AS c, count(*) FILTER (WHERE match_method = 'point_in_polygon') AS a,
               count(*) FILTER (WHERE match_method = 'nearest_10m') AS b, count(*) FILTER (WHERE match_method = 'address_inheritance') AS d,
               count(poly_idx) AS m FROM fx_v3 GROUP BY comuna),
  g AS (SELECT comuna, count(*) AS t, count(*) FILTER (WHERE poly_idx NOT IN (SELECT poly_idx FROM fx_v3 WHERE poly_idx IS NOT NULL)) AS o FROM fx_polygons GROUP BY comuna)
    SELECT comuna, t AS poligonos_disponibles, o AS poligonos_huerfanos, c AS predios_con_coords, a AS metodo_pip, b AS metodo_nearest_10m,
           CAST(0 AS BIGINT) AS metodo_coord_inherit, d AS metodo_addr_inherit, m AS total_matched, n - m AS sin_match, n - c AS sin_coords,
           round(m * 100.0 / n, 2)::DOUBLE AS cobertura_pct FROM p JOIN g USING (comuna)""", MATCH)
def match_metrics(spark, sf):
    return A.match_metrics(v3(spark, sf), X.polygons(spark, sf))


@query("fetch_metrics", """
    SELECT comuna, count(*) AS total_predios, count(*) FILTER (WHERE ok % 8 <> 0) AS descargados, count(*) FILTER (WHERE ok % 8 <> 0 AND y_u IS NOT NULL) AS con_coords,
           count(*) FILTER (WHERE ok % 8 <> 0 AND y_u IS NULL) AS sin_coords, count(*) FILTER (WHERE ok % 8 <> 0 AND ok % 4 = 1) AS con_predio_publicado,
           count(*) FILTER (WHERE ok % 8 = 5) AS errores_red FROM fx_parcels GROUP BY comuna""", ["fx_parcels"])
def fetch_metrics(spark, sf):
    p = X.parcels(spark, sf)
    got = p.where("ok % 8 <> 0").select(
        "comuna", F.coalesce(F.col("lat").cast("string"), F.lit("None")).alias("lat"),
        F.when(F.col("ok") % 4 == 1, F.col("predio")).alias("predioPublicado_predio"),
        F.when(F.col("ok") % 8 == 5, "max_retries").alias("_error"),
    )
    return A.fetch_metrics(p, got)


@query("coverage", f"""{V3}, r AS (SELECT v.*, p.ubicacion FROM fx_v3 v JOIN fx_parcels p USING (ok))
    SELECT count(*) FILTER (WHERE ubicacion = 'URBANA' AND poly_idx IS NOT NULL) AS urbana_con, count(*) FILTER (WHERE ubicacion = 'URBANA') AS urbana,
           count(poly_idx) AS total_con, count(*) AS total, round(urbana_con * 100.0 / urbana, 1)::DOUBLE AS urbana_pct,
           round(total_con * 100.0 / total, 1)::DOUBLE AS total_pct FROM r""", MATCH)
def coverage(spark, sf):
    return A.coverage(with_attributes(spark, sf))


@query("method_topk", f"""WITH {V1}, c AS (SELECT match_method, count(*) AS n FROM fx_v1 GROUP BY 1), named AS (SELECT * FROM c WHERE match_method IS NOT NULL)
    SELECT 'method' AS line, match_method, n FROM (SELECT * FROM named ORDER BY n DESC, match_method LIMIT 15)
    UNION ALL SELECT 'more_methods', NULL, count(*) - 15 FROM named HAVING count(*) > 15
    UNION ALL SELECT 'rows_of_more', NULL, CAST(sum(n) AS BIGINT) FROM (SELECT n FROM named ORDER BY n DESC, match_method OFFSET 15) HAVING count(*) > 0
    UNION ALL SELECT 'unmatched', NULL, n FROM c WHERE match_method IS NULL""", ["fx_parcels", "fx_polygons", "fx_anchors"])
def method_topk(spark, sf):
    return A.method_topk(P.match_cascade_v1(X.parcels(spark, sf), X.polygons(spark, sf), X.table(spark, sf, "fx_anchors")))


def _recovery_sql():
    from conformance.registry import ORACLES

    full = ORACLES["recovery_cascade"]
    head, tail = full.rsplit("SELECT r3.comuna", 1)
    labels = ["ah_utm_pip", "ah_utm_nearest", "csa_utm_pip", "csa_utm_nearest", "nearest_unlimited", "ocr_orphan", "address_inheritance"]
    counts = ", ".join(f"count(*) FILTER (WHERE won AND match_method = '{m}') AS {m}" for m in labels)
    return f"""{head.rstrip()}, fin AS (SELECT r3.comuna{tail}),
      j AS (SELECT f.*, p.poly_idx IS NULL AND f.poly_idx >= 0 AS won, p.poly_idx IS NOT NULL AS was
            FROM fin f JOIN fx_placed p USING (comuna, manzana, predio))
    SELECT comuna, {counts}, count(*) FILTER (WHERE won) AS total_recovered,
           round(count(*) FILTER (WHERE was) * 100.0 / count(*), 2)::DOUBLE AS cobertura_antes,
           round(count(*) FILTER (WHERE was OR won) * 100.0 / count(*), 2)::DOUBLE AS cobertura_post_recovery FROM j GROUP BY comuna"""


@query("recovery_metrics", _recovery_sql())
def recovery_metrics(spark, sf):
    rows, polygons = cascade_rows(spark, sf)
    after = P.recover(rows, polygons, X.table(spark, sf, "fx_number_reads"))
    return A.recovery_metrics(rows, after)


# --- catalog -----------------------------------------------------------------------------
X.add_table("fx_catalog_rows", """
    SELECT comuna, manzana, predio, CASE WHEN y_u IS NULL THEN 'nan' ELSE CAST(y_u AS STRING) END AS lat,
           CASE ok % 7 WHEN 0 THEN '' WHEN 1 THEN 'nan' WHEN 2 THEN NULL ELSE CAST(ok AS STRING) END AS pol_area_m2,
           CASE WHEN comuna = 13103 THEN '' WHEN ok % 4 = 0 THEN NULL ELSE 'Comuna ' || CAST(comuna AS STRING) || '-' || CAST(ok % 3 AS STRING) END AS nombre_comuna
    FROM fx_parcels
    UNION ALL SELECT comuna, NULL, NULL, NULL, '12.5', NULL FROM fx_polygons""", ["fx_parcels", "fx_polygons"])
CAT = """count(*) AS total_csv, count(*) FILTER (WHERE poly) AS total_poligonos, count(*) FILTER (WHERE poly AND manzana IS NOT NULL) AS con_datos_y_poligono,
    count(*) FILTER (WHERE poly AND manzana IS NULL) AS solo_poligono, count(*) FILTER (WHERE NOT poly AND manzana IS NOT NULL) AS catastro_only,
    count(*) FILTER (WHERE lat <> 'nan') AS con_latlon"""
CATROWS = "(SELECT *, coalesce(pol_area_m2 NOT IN ('', 'nan'), false) AS poly FROM fx_catalog_rows)"


def catalog_rows(spark, sf):
    return X.table(spark, sf, "fx_catalog_rows").withColumnRenamed("nombre_comuna", "nombreComuna")


@query("catalog", f"""SELECT CAST(comuna AS VARCHAR) AS codigo,
    coalesce(arg_min(nombre_comuna, (manzana, predio)) FILTER (WHERE nombre_comuna <> ''), CAST(comuna AS VARCHAR)) AS nombre, {CAT} FROM {CATROWS} GROUP BY comuna""", ["fx_catalog_rows"])
def catalog(spark, sf):
    return A.catalog(catalog_rows(spark, sf))


@query("catalog_rollup", f"SELECT coalesce(CAST(comuna AS VARCHAR), 'total') AS codigo, {CAT} FROM {CATROWS} GROUP BY ROLLUP (comuna)", ["fx_catalog_rows"])
def catalog_rollup(spark, sf):
    return A.catalog_rollup(catalog_rows(spark, sf))


@query("catalog_json", f"""
    WITH c AS (SELECT CAST(comuna AS VARCHAR) AS codigo, coalesce(arg_min(nombre_comuna, (manzana, predio)) FILTER (WHERE nombre_comuna <> ''), CAST(comuna AS VARCHAR)) AS nombre,
                      {CAT} FROM {CATROWS} GROUP BY comuna)
    SELECT count(*) AS total_comunas, string_agg(codigo || ':' || nombre || ':' || total_csv || ':' || con_latlon, ',' ORDER BY codigo) AS entries,
           CAST(sum(total_csv) AS BIGINT) AS rows_total, CAST(sum(solo_poligono) AS BIGINT) AS only_polygon FROM c""", ["fx_catalog_rows"])
def catalog_json(spark, sf):
    """Reads the document back, so that its shape and contents are compared."""
    doc = A.catalog_json(catalog_rows(spark, sf), "second semester").select(F.parse_json("document").alias("d"))
    entries = F.try_variant_get("d", "$.comunas", "array<struct<codigo:string,nombre:string,predios:struct<total_csv:string,con_latlon:string>>>")
    text = F.array_join(F.transform(entries, lambda e: F.concat_ws(":", e["codigo"], e["nombre"], e["predios"]["total_csv"], e["predios"]["con_latlon"])), ",")
    return doc.select(
        F.try_variant_get("d", "$.total_comunas", "bigint").alias("total_comunas"), text.alias("entries"),
        F.try_variant_get("d", "$.totales.total_csv", "bigint").alias("rows_total"),
        F.try_variant_get("d", "$.totales.solo_poligono", "bigint").alias("only_polygon"),
    )


X.add_table("fx_metric_lines", """
    SELECT comuna, CASE ok % 3 WHEN 0 THEN 'fase0' WHEN 1 THEN 'match' ELSE 'recovery' END AS section,
           'm' || CAST(ok % 4 AS STRING) AS name, count(*) AS value FROM fx_parcels GROUP BY 1, 2, 3""", ["fx_parcels"])


@query("metrics_json", """
    WITH f AS (SELECT comuna, section, name, CASE WHEN section = 'match' THEN value * 2 ELSE value END AS value FROM fx_metric_lines
               WHERE section <> 'match' OR name <> 'm3'),
    s AS (SELECT comuna, section, '{' || string_agg('"' || name || '":' || value, ',' ORDER BY name) || '}' AS body FROM f GROUP BY ALL)
    SELECT comuna, '{' || string_agg('"' || section || '":' || body, ',' ORDER BY section) || '}' AS document FROM s GROUP BY comuna""", ["fx_metric_lines"])
def metrics_json(spark, sf):
    lines = X.table(spark, sf, "fx_metric_lines")
    fresh = lines.where("section = 'match' and name <> 'm3'").withColumn("value", F.col("value") * 2)
    return A.metrics_json(A.merge_sections(lines, fresh))


# --- boxes ---------------------------------------------------------------------------------
X.add_table("fx_data_points", """
    SELECT CAST(13101 + c.c_custkey % 23 AS INT) AS comuna, o_orderkey AS ok,
           CASE WHEN o_orderkey % 31 = 0 THEN NULL WHEN o_orderkey % 37 = 0 THEN 0 WHEN o_orderkey % 101 = 0 THEN -20000000
                ELSE -33500000 + (o_orderkey * 7919) % 60000 END AS lat_u,
           CASE WHEN o_orderkey % 41 = 0 THEN 0 WHEN o_orderkey % 103 = 0 THEN -79000000 ELSE -70700000 + (o_orderkey * 104729) % 90000 END AS lon_u
    FROM orders o JOIN customer c ON o.o_custkey = c.c_custkey""", ["orders", "customer"])


def data_points(spark, sf):
    return X.table(spark, sf, "fx_data_points").select("comuna", (F.col("lat_u") / 1e6).alias("lat"), (F.col("lon_u") / 1e6).alias("lon"))


IQR = """WITH d AS (SELECT comuna, lat_u / 1e6 AS lat, lon_u / 1e6 AS lon FROM fx_data_points WHERE lat_u IS NOT NULL AND lat_u <> 0 AND lon_u <> 0),
  st AS (SELECT comuna, quantile_cont(lat, 0.25) AS a1, quantile_cont(lat, 0.75) AS a3, quantile_cont(lon, 0.25) AS o1, quantile_cont(lon, 0.75) AS o3 FROM d GROUP BY comuna),
  iqr AS (SELECT comuna, min(lat) FILTER (WHERE la) AS lat_min, max(lat) FILTER (WHERE la) AS lat_max, min(lon) FILTER (WHERE lo) AS lon_min,
                 max(lon) FILTER (WHERE lo) AS lon_max, count(*) FILTER (WHERE la) AS "count"
          FROM (SELECT *, lat BETWEEN a1 - 3 * (a3 - a1) AND a3 + 3 * (a3 - a1) AS la, lon BETWEEN o1 - 3 * (o3 - o1) AND o3 + 3 * (o3 - o1) AS lo
                FROM d JOIN st USING (comuna)) GROUP BY comuna)"""


@query("iqr_bbox", f"{IQR} SELECT * FROM iqr", ["fx_data_points"])
def iqr_bbox(spark, sf):
    return A.iqr_bbox(data_points(spark, sf))


@query("exact_percentiles", """SELECT comuna, f AS fraction, round(CASE f WHEN 0.1 THEN a WHEN 0.5 THEN b ELSE c END, 9) AS v
    FROM (SELECT comuna, quantile_cont(lat_u / 1e6, 0.1) AS a, quantile_cont(lat_u / 1e6, 0.5) AS b, quantile_cont(lat_u / 1e6, 0.99) AS c
          FROM fx_data_points WHERE lat_u IS NOT NULL GROUP BY comuna), (SELECT unnest([0.1::DOUBLE, 0.5::DOUBLE, 0.99::DOUBLE]) AS f)""", ["fx_data_points"])
def exact_percentiles(spark, sf):
    rows = data_points(spark, sf).select("comuna", F.col("lat").alias("v"))
    return A.exact_percentiles(rows, ["comuna"], [0.1, 0.5, 0.99], 0.001).withColumn("v", F.round("v", 9))


@query("simple_bbox", """SELECT comuna, round(min(lon_u) / 1e6 - 0.002, 6) AS min_lon, round(min(lat_u) / 1e6 - 0.002, 6) AS min_lat,
    round(max(lon_u) / 1e6 + 0.002, 6) AS max_lon, round(max(lat_u) / 1e6 + 0.002, 6) AS max_lat FROM fx_data_points
    WHERE lat_u <> 0 AND lon_u <> 0 GROUP BY comuna""", ["fx_data_points"])
def simple_bbox(spark, sf):
    box = A.simple_bbox(data_points(spark, sf))
    return box.select("comuna", *[F.round(c, 6).alias(c) for c in ("min_lon", "min_lat", "max_lon", "max_lat")])


@query("area_histogram", """
    SELECT CASE WHEN a < 5 THEN '1-5' WHEN a < 20 THEN '5-20' WHEN a < 50 THEN '20-50' WHEN a < 100 THEN '50-100' WHEN a < 200 THEN '100-200'
           WHEN a < 300 THEN '200-300' WHEN a < 500 THEN '300-500' WHEN a < 1000 THEN '500-1000' WHEN a < 5000 THEN '1000-5000' ELSE '5000-50000' END AS bin, count(*) AS n
    FROM (SELECT (w_u * w_u * 0.012321) * (1 + poly_idx % 97) / 40.0 AS a FROM fx_polygons) WHERE a >= 1 AND a < 50000 GROUP BY 1""", ["fx_polygons"])
def area_histogram(spark, sf):
    a = M.degree_area_m2(G.ring_area(F.col("shell"))) * (1 + F.col("poly_idx") % 97) / 40.0
    return A.area_histogram(X.polygons(spark, sf).select(a.alias("area_m2")))


@query("hole_counts", """SELECT comuna, CAST(sum(CAST(has_hole AS INT) + CAST(has_slit AS INT)) AS BIGINT) AS before, CAST(sum(CAST(has_hole AS INT)) AS BIGINT) AS kept,
    CAST(sum(CAST(has_slit AS INT)) AS BIGINT) AS filled FROM fx_polygons GROUP BY comuna""", ["fx_polygons"])
def hole_counts(spark, sf):
    return A.hole_counts(X.polygons(spark, sf), 10.0 / 111000.0**2)


@query("distinct_communes", """SELECT DISTINCT comuna FROM fx_parcels UNION SELECT comuna FROM fx_data_points""", ["fx_parcels", "fx_data_points"])
def distinct_communes(spark, sf):
    return X.parcels(spark, sf).select("comuna").union(X.table(spark, sf, "fx_data_points").select("comuna")).distinct()


# --- events --------------------------------------------------------------------------------
X.add_table("fx_progress", """
    SELECT user_id AS worker, ts, event_id, event_type <> 'error' AS ok, event_id // 2000 AS counter FROM events""", ["events"])
X.add_table("fx_progress_lines", """
    SELECT user_id AS worker, ts, event_id, CASE event_type WHEN 'error' THEN 'WARN retry ok=9' WHEN 'purchase' THEN 'DONE chunk=' ELSE 'PROGRESS chunk=' END
      || CASE WHEN event_type = 'error' THEN '' ELSE CAST(user_id AS STRING) || ' ok=' || CAST(event_id AS STRING) || ' fail=' || CAST(event_id % 11 AS STRING)
      || ' total=' || CAST(event_id + (user_id * 37) % 90 AS STRING) || ' rate=1.5/s' END AS line FROM events""", ["events"])


def progress(spark, sf):
    return X.table(spark, sf, "fx_progress")


@query("failure_runs", """
    WITH i AS (SELECT *, sum(CAST(ok AS INT)) OVER (PARTITION BY worker ORDER BY ts, event_id ROWS UNBOUNDED PRECEDING) AS island FROM fx_progress)
    SELECT worker, min(ts) AS first_ts, max(ts) AS last_ts, count(*) AS failures FROM i WHERE NOT ok GROUP BY worker, island HAVING count(*) >= 3""", ["fx_progress"])
def failure_runs(spark, sf):
    """Three in a row here: failures in this table are too rare for runs of twenty."""
    return O.failure_runs(progress(spark, sf), at_least=3)


X.add_table("fx_long_runs", "SELECT user_id % 10 AS worker, ts, event_id, event_type = 'purchase' AS ok FROM events", ["events"])


@query("failure_runs_published", """
    WITH i AS (SELECT *, sum(CAST(ok AS INT)) OVER (PARTITION BY worker ORDER BY ts, event_id ROWS UNBOUNDED PRECEDING) AS island FROM fx_long_runs)
    SELECT worker, min(ts) AS first_ts, max(ts) AS last_ts, count(*) AS failures FROM i WHERE NOT ok GROUP BY worker, island HAVING count(*) >= 20""", ["fx_long_runs"])
def failure_runs_published(spark, sf):
    """Runs of twenty failures and more, as published, of ten busy workers."""
    return O.failure_runs(X.table(spark, sf, "fx_long_runs"))


@query("stall_gaps", """
    WITH m AS (SELECT *, max(counter) OVER (PARTITION BY worker ORDER BY ts, event_id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS before,
                      max(ts) OVER (PARTITION BY worker) AS last_ts FROM fx_progress),
    s AS (SELECT worker, counter, ts, event_id, last_ts FROM m WHERE counter > coalesce(before, 0)
          UNION ALL SELECT worker, 0, min(ts), -1, max(ts) FROM fx_progress GROUP BY worker),
    u AS (SELECT *, lead(ts) OVER (PARTITION BY worker ORDER BY ts, event_id) AS next FROM s)
    SELECT worker, counter, ts AS stalled_from, coalesce(next, last_ts) AS stalled_to, next IS NOT NULL AS closed FROM u
    WHERE coalesce(next, last_ts) - ts > INTERVAL 60 SECOND""", ["fx_progress"])
def stall_gaps(spark, sf):
    return O.stall_gaps(progress(spark, sf))


LAST = """SELECT worker, arg_max(worker, (ts, event_id)) AS chunk, arg_max(event_id, (ts, event_id)) AS ok, arg_max(event_id % 11, (ts, event_id)) AS fail,
    arg_max(event_id + (worker * 37) % 90, (ts, event_id)) AS total FROM fx_progress WHERE ok GROUP BY worker"""


@query("progress_last", LAST, ["fx_progress"])
def progress_last(spark, sf):
    return R.progress_last(X.table(spark, sf, "fx_progress_lines"))


@query("progress_totals", f"""SELECT ok, fail, total, round(ok / 3600.0, 1)::DOUBLE AS rate, round((total - ok) / (ok / 3600.0) / 60, 1)::DOUBLE AS eta_min
    FROM (SELECT CAST(sum(ok) AS BIGINT) AS ok, CAST(sum(fail) AS BIGINT) AS fail, CAST(sum(total) AS BIGINT) AS total FROM ({LAST}))""", ["fx_progress"])
def progress_totals(spark, sf):
    return R.progress_totals(R.progress_last(X.table(spark, sf, "fx_progress_lines")), 3600.0)


@query("busiest_worker", f"SELECT worker, total - ok AS remaining FROM ({LAST}) WHERE total - ok > 20 ORDER BY total - ok DESC, worker LIMIT 1", ["fx_progress"])
def busiest_worker(spark, sf):
    return R.busiest_worker(R.progress_last(X.table(spark, sf, "fx_progress_lines")))


@query("complete_communes", """SELECT comuna, n_cells FROM (SELECT comuna, count(*) AS n_cells FROM fx_data_points GROUP BY comuna) WHERE n_cells > 100
    AND comuna IN (SELECT CAST(13101 + n_nationkey AS INT) FROM nation WHERE n_regionkey <> 1) AND comuna % 6 <> 0""", ["fx_data_points"])
def complete_communes(spark, sf):
    tables = X.source(spark, sf, "nation").where("n_regionkey <> 1").select((F.lit(13101) + F.col("n_nationkey")).cast("int").alias("comuna"))
    cells = X.table(spark, sf, "fx_data_points").select("comuna", "ok")
    return L.complete_communes(tables, cells, cells.where("comuna % 6 = 0"))
