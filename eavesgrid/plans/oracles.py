"""The same queries as plain SQL over the driver's tables."""

from __future__ import annotations

from ..operators.tiles import SERVICE

# ---------------------------------------------------------------- shared views

F = """f AS (
  SELECT k, 'B' || k AS id, commune, score, x0 AS xmin, y0 AS ymin, x0 + w AS xmax, y0 + h AS ymax,
         CAST(w * h AS DOUBLE) AS area
  FROM (SELECT p_partkey AS k, lpad(substr(p_brand, 7), 5, '0') AS commune, p_size AS score,
               CAST((p_partkey * p_partkey * 31 + p_partkey * 17) % 20011 AS DOUBLE) / 8 AS x0,
               CAST((p_partkey * p_partkey * 53 + p_partkey * 101 + 7) % 20011 AS DOUBLE) / 8 AS y0,
               5 + p_size % 20 AS w, 4 + p_size % 13 AS h
        FROM part))"""
Z = """z AS (
  SELECT 'Z' || s AS zone_id, x0 AS xmin, y0 AS ymin, x0 + w AS xmax, y0 + h AS ymax
  FROM (SELECT s_suppkey AS s,
               CAST((s_suppkey * s_suppkey * 37 + s_suppkey * 11) % 20011 AS DOUBLE) / 8 AS x0,
               CAST((s_suppkey * s_suppkey * 59 + s_suppkey * 29) % 20011 AS DOUBLE) / 8 AS y0,
               50 + (s_suppkey % 7) * 25 AS w, 50 + (s_suppkey % 5) * 25 AS h
        FROM supplier))"""
ROOF = """roof AS (
  SELECT lpad(substr(p_brand, 7), 5, '0') || '-' || p_partkey AS batiment_groupe_id,
         nullif(p_type, 'PROMO') AS mat_toit_txt
  FROM part)"""
DOM = """dom AS (
  SELECT commune, roof AS toiture, n FROM (
    SELECT commune, roof, n, row_number() OVER (PARTITION BY commune ORDER BY n DESC, roof) AS rk
    FROM (SELECT substr(batiment_groupe_id, 1, 5) AS commune, coalesce(mat_toit_txt, 'UNKNOWN') AS roof, count(*) AS n
          FROM roof GROUP BY 1, 2)) WHERE rk = 1)"""
DENSE = """d AS (
  SELECT id, xmin, ymin, xmax, ymax FROM f UNION ALL
  SELECT 'D' || k, x0, y0, x0 + 150 + k % 300, y0 + 100 + k % 250
  FROM (SELECT p_partkey AS k, CAST((p_partkey * p_partkey * 41 + p_partkey * 13) % 20011 AS DOUBLE) / 8 AS x0,
               CAST((p_partkey * p_partkey * 67 + p_partkey * 7 + 3) % 20011 AS DOUBLE) / 8 AS y0 FROM part WHERE p_partkey % 199 = 0))"""
R = """cells AS (
  SELECT i, unnest(range(CAST(floor(ymin / 500) AS BIGINT), CAST(floor(ymax / 500) AS BIGINT) + 1)) AS j
  FROM (SELECT ymin, ymax,
               unnest(range(CAST(floor(xmin / 500) AS BIGINT), CAST(floor(xmax / 500) AS BIGINT) + 1)) AS i FROM f)),
r AS (
  SELECT DISTINCT 'R' || i || '_' || j AS raster_id, i, j, CAST(i * 500 AS DOUBLE) AS rx0, CAST(j * 500 AS DOUBLE) AS ry0,
         CAST((i + 1) * 500 AS DOUBLE) AS rx1, CAST((j + 1) * 500 AS DOUBLE) AS ry1
  FROM cells)"""
PAIRS = """fr AS (
  SELECT f.id, f.k, r.raster_id, i, j,
         greatest(CAST(ceil((xmin - rx0) / 5 - 0.5) AS BIGINT), 0) AS c0,
         least(CAST(ceil((xmax - rx0) / 5 - 0.5) AS BIGINT), 100) - 1 AS c1,
         greatest(CAST(floor((ry1 - ymax) / 5 - 0.5) AS BIGINT) + 1, 0) AS r0,
         least(CAST(floor((ry1 - ymin) / 5 - 0.5) AS BIGINT) + 1, 100) - 1 AS r1
  FROM f JOIN r ON xmin < rx1 AND xmax > rx0 AND ymin < ry1 AND ymax > ry0),
crop AS (
  SELECT *, CASE WHEN r1 < r0 OR c1 < c0 THEN 0 ELSE r1 - r0 + 1 END AS height,
         CASE WHEN r1 < r0 OR c1 < c0 THEN 0 ELSE c1 - c0 + 1 END AS width
  FROM fr),
px AS (
  SELECT *, ((i * 100 + c) * 7 + ((j + 1) * 100 - 1 - r) * 13) % 256 AS v
  FROM (SELECT *, unnest(range(c0, c1 + 1)) AS c
        FROM (SELECT *, unnest(range(r0, r1 + 1)) AS r FROM crop WHERE height > 0 AND width > 0)))"""
CROPS = f"WITH {F}, {R}, {PAIRS}"
CROPS_16 = f"""{CROPS}, px16 AS (
  SELECT *, CASE WHEN (gc + 2 * gr) % 11 = 0 THEN 65535 ELSE (gc * 701 + gr * 1303) % 65521 END AS v16
  FROM (SELECT *, i * 100 + c AS gc, (j + 1) * 100 - 1 - r AS gr FROM px))"""
NAMED = f"""{CROPS}, named AS (
  SELECT id, raster_id, height, width, suffix, id || '.jpg' AS file_name,
         CASE WHEN suffix = 0 THEN id || '.jpg' ELSE id || '_' || suffix || '.jpg' END AS suffixed_name
  FROM (SELECT *, row_number() OVER (PARTITION BY id ORDER BY raster_id) - 1 AS suffix FROM crop))"""
LEDGER = "ledger AS (SELECT raster_id FROM r WHERE (i + j) % 3 = 0)"
BOXES = """box AS (
  SELECT c_custkey AS box_id, CAST(200000 + 1000 * (c_custkey % 2000) AS DOUBLE) AS x,
         CAST(5400000 + 700 * (c_custkey % 2000) AS DOUBLE) AS y,
         CASE WHEN c_custkey % 5 = 0 THEN 250 * (1 + c_custkey % 3) ELSE 100 + (137 * c_custkey) % 1100 END AS pw,
         CASE WHEN c_custkey % 4 = 0 THEN 250 * (1 + c_custkey % 2) ELSE 100 + (211 * c_custkey) % 900 END AS ph
  FROM customer),
axis AS (
  SELECT *, greatest(pw // 250, 1) AS nx, greatest(ph // 250, 1) AS ny, least(pw, 250) AS uw, least(ph, 250) AS uh FROM box),
placed AS (
  SELECT *, x + (pw - nx * uw) / CAST(2 AS DOUBLE) * CAST(0.25 AS DOUBLE) AS x0,
         y + (ph - ny * uh) / CAST(2 AS DOUBLE) * CAST(0.25 AS DOUBLE) AS y0 FROM axis),
grid AS (
  SELECT box_id, col || '-' || "row" AS tile_name, col, "row", uw, uh,
         x0 + col * uw * CAST(0.25 AS DOUBLE) AS min_x, y0 + "row" * uh * CAST(0.25 AS DOUBLE) AS min_y,
         x0 + (col + 1) * uw * CAST(0.25 AS DOUBLE) AS max_x, y0 + ("row" + 1) * uh * CAST(0.25 AS DOUBLE) AS max_y
  FROM (SELECT *, unnest(range(0, ny)) AS "row" FROM (SELECT *, unnest(range(0, nx)) AS col FROM placed)))"""
VEC = """raw AS (
  SELECT vec_id, label, label % 3 AS truth,
         exp(CAST(embedding[1] AS DOUBLE) * 10) AS e1, exp(CAST(embedding[2] AS DOUBLE) * 10) AS e2,
         exp(CAST(embedding[3] AS DOUBLE) * 10) AS e3, 1 / (1 + exp(-CAST(embedding[1] AS DOUBLE) * 10)) AS p
  FROM embeddings),
vec AS (
  SELECT *, e1 / (e1 + e2 + e3) AS p1, e2 / (e1 + e2 + e3) AS p2, e3 / (e1 + e2 + e3) AS p3,
         'B' || vec_id || CASE WHEN vec_id % 11 = 0 THEN '_1' ELSE '' END AS name FROM raw),
best AS (
  SELECT *, greatest(p1, p2, p3) AS top,
         CASE WHEN p1 >= p2 AND p1 >= p3 THEN 0 WHEN p2 >= p3 THEN 1 ELSE 2 END AS pred FROM vec)"""
POST = f"WITH {VEC}, post AS (SELECT vec_id, name AS building_name, round(top, 7) AS score, 'c' || pred AS predicted_class FROM best WHERE vec_id % 11 <> 0)"
EVAL = """ev AS (
  SELECT l.doc_id, l.quality AS y_true, least(d.n_chars / CAST(1000 AS DOUBLE), 1.0) AS p,
         CASE WHEN least(d.n_chars / CAST(1000 AS DOUBLE), 1.0) > 0.5 THEN 1 ELSE 0 END AS y_pred
  FROM labels l JOIN documents d USING (doc_id))"""
FILES = """files AS (
  SELECT vec_id, label, cls, ext, '/data/' || cls || '/im' || vec_id || '.' || ext AS path
  FROM (SELECT vec_id, label, ['no_PV', 'PV', 'other'][label % 3 + 1] AS cls,
               ['jpg', 'PNG', 'bmp', 'txt', 'jpeg', 'gif', 'csv'][vec_id % 7 + 1] AS ext FROM embeddings))"""
FRACTION = "CAST(CAST('0x' || substr(md5('42' || doc_id), 1, 8) AS BIGINT) AS DOUBLE) / 4294967296"
OVERLAPS = """pairs AS (
  SELECT a.id AS id_a, b.id AS id_b,
         (least(a.xmax, b.xmax) - greatest(a.xmin, b.xmin)) * (least(a.ymax, b.ymax) - greatest(a.ymin, b.ymin)) AS overlap
  FROM {t} a JOIN {t} b ON a.id < b.id AND a.xmin < b.xmax AND b.xmin < a.xmax AND a.ymin < b.ymax AND b.ymin < a.ymax)"""
GROUPS = """reach AS (
  SELECT id_a AS a, id_b AS b FROM pairs
  UNION SELECT id_b, id_a FROM pairs
  UNION SELECT reach.a, e.b FROM reach JOIN (SELECT id_a AS a, id_b AS b FROM pairs UNION ALL SELECT id_b, id_a FROM pairs) e
    ON reach.b = e.a),
comp AS (SELECT a AS id, least(a, min(b)) AS component FROM reach GROUP BY a)"""
GRAPH = f"WITH RECURSIVE {F}, {OVERLAPS.format(t='f')}, {GROUPS}"
LEADERS = """lead AS (
  SELECT id, component, row_number() OVER (PARTITION BY component ORDER BY coalesce(score, 0) DESC, id) AS rk
  FROM comp JOIN f USING (id))"""
SPLIT = f"SELECT doc_id, {FRACTION} AS fraction FROM documents"


def _evaluate3() -> str:
    parts = ["SELECT 'loss' AS metric, round(avg(-ln(least(greatest(CASE truth WHEN 0 THEN p1 WHEN 1 THEN p2 ELSE p3 END, 1e-7), 1 - 1e-7))), 9) AS value FROM best"]
    for name, side in (("Precision", "pred"), ("Recall", "truth")):
        for c in range(3):
            parts.append(
                f"SELECT '{name} (class: c{c})', round(sum(CASE WHEN truth = {c} AND pred = {c} THEN 1.0 ELSE 0 END)"
                f" / (sum(CASE WHEN {side} = {c} THEN 1.0 ELSE 0 END) + CAST(1e-7 AS DOUBLE)), 9) FROM best"
            )
    return f"WITH {VEC} " + " UNION ALL ".join(parts)


def _two_classes(side: str, name: str, batch: bool) -> str:
    group = "GROUP BY doc_id // 32" if batch else ""
    rows = []
    for i, c in enumerate(("bad", "good")):
        ratio = (
            f"sum(CASE WHEN y_true = {i} AND y_pred = {i} THEN 1 ELSE 0 END)"
            f" / (sum(CASE WHEN {side} = {i} THEN 1 ELSE 0 END) + CAST(1e-7 AS DOUBLE))"
        )
        rows.append(f"SELECT '{c}' AS class_name, round(avg(v), 9) AS {name} FROM (SELECT {ratio} AS v FROM ev {group})")
    return f"WITH {EVAL} " + " UNION ALL ".join(rows)


def _lambert(lon: str, lat: str) -> tuple[str, str]:
    es = f"(k.e * sin(radians({lat})))"
    rho = f"(k.big * pow(tan(pi() / 4 - radians({lat}) / 2) / pow((1 - {es}) / (1 + {es}), k.e / 2), k.n))"
    theta = f"(k.n * radians({lon} - 3))"
    return f"round(700000 + {rho} * sin({theta}), 3)", f"round(6600000 + k.r0 - {rho} * cos({theta}), 3)"


def _reproject() -> str:
    def t(phi: str) -> str:
        return f"(tan(pi() / 4 - {phi} / 2) / pow((1 - e * sin({phi})) / (1 + e * sin({phi})), e / 2))"

    def m(phi: str) -> str:
        return f"(cos({phi}) / sqrt(1 - pow(e * sin({phi}), 2)))"

    p0, p1, p2 = "radians(46.5)", "radians(49)", "radians(44)"
    x, y = _lambert("lon", "lat")
    x2, y2 = _lambert("(lon + 0.25)", "(lat + 0.25)")
    return f"""WITH ell AS (SELECT 1 / CAST(298.257222101 AS DOUBLE) AS fl, CAST(6378137 AS DOUBLE) AS a),
ecc AS (SELECT a, sqrt(2 * fl - fl * fl) AS e FROM ell),
cone AS (SELECT a, e, (ln({m(p1)}) - ln({m(p2)})) / (ln({t(p1)}) - ln({t(p2)})) AS n FROM ecc),
k0 AS (SELECT a, e, n, a * {m(p1)} / (n * pow({t(p1)}, n)) AS big FROM cone),
k AS (SELECT *, big * pow({t(p0)}, n) AS r0 FROM k0),
s AS (SELECT s_suppkey, CAST(-5 AS DOUBLE) + (s_suppkey * 37 % 1500) / CAST(100 AS DOUBLE) AS lon,
             CAST(41 AS DOUBLE) + (s_suppkey * 53 % 1000) / CAST(100 AS DOUBLE) AS lat FROM supplier)
SELECT s_suppkey, {x} AS x, {y} AS y, {x2} AS x2, {y2} AS y2 FROM s, k"""


# crop_or_pad to 4 x 4: position of a crop pixel in the fixed-size image
PREPARED = """prep AS (
  SELECT id, raster_id, v,
         r - r0 - greatest((height - 4) // 2, 0) AS yy, greatest((4 - height) // 2, 0) AS py,
         c - c0 - greatest((width - 4) // 2, 0) AS xx, greatest((4 - width) // 2, 0) AS px
  FROM px),
fit AS (
  SELECT id, raster_id, v, (yy + py) * 4 + xx + px AS pos FROM prep
  WHERE yy >= 0 AND yy < 4 AND xx >= 0 AND xx < 4)"""
FETCHED = '(box_id + col * 3 + "row" * 5) % 4 <> 0'

ORACLES: dict[str, str] = {
    "read_layer": f"""WITH {F} SELECT id, CASE WHEN k % 9 <> 0 THEN xmin END AS xmin, CASE WHEN k % 9 <> 0 THEN ymin END AS ymin,
        CASE WHEN k % 9 <> 0 THEN xmax END AS xmax, CASE WHEN k % 9 <> 0 THEN ymax END AS ymax,
        CASE WHEN k % 9 <> 0 THEN 5 END AS n_points FROM f""",
    "scan_roof_csv": f"WITH {ROOF} SELECT batiment_groupe_id, mat_toit_txt FROM roof",
    "scan_image_folder": f"""WITH {FILES} SELECT path, cls AS class_name,
        CASE cls WHEN 'no_PV' THEN 0 WHEN 'PV' THEN 1 ELSE 2 END AS label_idx
        FROM files WHERE lower(ext) IN ('bmp', 'gif', 'jpeg', 'jpg', 'png')""",
    "image_labels_list": f"""WITH {FILES} SELECT path, CASE WHEN vec_id % 5 <> 0 THEN label END AS label
        FROM files WHERE lower(ext) IN ('bmp', 'gif', 'jpeg', 'jpg', 'png')""",
    "raster_catalog": """SELECT '/r/R' || s_suppkey || '.' || ext AS path, '/r/R' || s_suppkey || '.' || ext AS raster_id,
        'R' || s_suppkey AS raster_name FROM (SELECT s_suppkey, ['jp2', 'tiff', 'tif', 'JP2'][s_suppkey % 4 + 1] AS ext FROM supplier)
        WHERE ext IN ('jp2', 'tiff')""",
    "tile_manifest": f"""WITH {BOXES} SELECT box_id, tile_name, '{SERVICE}&WIDTH=' || uw || '&HEIGHT=' || uh || '&BBOX='
        || min_x || ',' || min_y || ',' || max_x || ',' || max_y AS url FROM grid""",
    "write_attributes": f"WITH {F} SELECT id, commune, score FROM f",
    "write_layer": f"""WITH {F} SELECT id, score, xmin, ymax, area, fmt
        FROM f CROSS JOIN (SELECT unnest(['parquet', 'csv']) AS fmt)""",
    "crop_manifest": f"{NAMED} SELECT raster_id, suffixed_name, file_name FROM named",
    "write_scores": f"{POST} SELECT building_name, printf('%.7f', score) AS score_text, predicted_class FROM post",
    "route_by_class": f"{POST} SELECT predicted_class, count(*) AS n, CAST(sum(vec_id) AS BIGINT) AS id_sum FROM post GROUP BY 1",
    "add_id": "SELECT p_partkey, '75' || (row_number() OVER (ORDER BY p_partkey) - 1) AS \"ID\" FROM part",
    "add_xy": f"""WITH {F} SELECT id, round((xmin + xmax) / 2, 1) AS "X", round((ymin + ymax) / 2, 1) AS "Y" FROM f""",
    "compute_area": f"WITH {F} SELECT id, area FROM f",
    "remove_small": f"WITH {F} SELECT id, area FROM f WHERE area > 60",
    "removal_counts": f"""WITH {F} SELECT count(*) AS total, count(*) FILTER (WHERE area <= 60) AS removed,
        count(*) FILTER (WHERE area > 60) AS kept FROM f""",
    "subset_filter": f"WITH {F} SELECT id, score FROM f WHERE score % 10 <> 0 AND score >= 25",
    "drop_prefix": f"WITH {F} SELECT id, score FROM f",
    "copy_layer": f"WITH {F} SELECT id, score FROM f",
    "drop_suffix_names": f"WITH {VEC} SELECT name FROM vec WHERE vec_id % 11 <> 0 AND vec_id % 13 <> 0",
    "threshold_class": f"WITH {VEC} SELECT vec_id, CASE WHEN p > 0.5 THEN 1 ELSE 0 END AS predicted FROM vec",
    "class_name_map": f"WITH {VEC} SELECT vec_id, 'c' || truth AS class_name FROM vec",
    "bbox_overlap_filter": f"WITH {F} SELECT id FROM f WHERE xmin < 1000 AND xmax > 500 AND ymin < 1500 AND ymax > 1000",
    "spatial_join": f"""WITH {F}, {Z} SELECT f.id, z.zone_id FROM f JOIN z
        ON f.xmin <= z.xmax AND z.xmin <= f.xmax AND f.ymin <= z.ymax AND z.ymin <= f.ymax""",
    "flag_protected": f"""WITH {F}, {Z} SELECT f.id, EXISTS (SELECT 1 FROM z
        WHERE f.xmin <= z.xmax AND z.xmin <= f.xmax AND f.ymin <= z.ymax AND z.ymin <= f.ymax) AS protected FROM f""",
    "dominant_roof": f"""WITH {F}, {ROOF}, {DOM}, l AS (SELECT id, CASE WHEN score % 17 = 0 THEN '99999' ELSE commune END AS commune FROM f)
        SELECT l.id, l.commune, coalesce(dom.toiture, 'UNKNOWN') AS toiture FROM l LEFT JOIN dom USING (commune)""",
    "dominant_per_commune": f"WITH {ROOF}, {DOM} SELECT commune, toiture, n FROM dom",
    "unknown_share": f"""WITH {ROOF}, {DOM} SELECT toiture, count(*) AS communes,
        count(*) / CAST((SELECT count(*) FROM dom) AS DOUBLE) AS share FROM dom GROUP BY 1""",
    "roof_counts": """SELECT coalesce(nullif(p_type, 'PROMO'), 'UNKNOWN') AS roof, count(*) AS n,
        count(*) / CAST((SELECT count(*) FROM part) AS DOUBLE) AS share FROM part GROUP BY 1 ORDER BY n DESC, roof""",
    "update_on_id": """SELECT 'B' || p_partkey AS id, p_size AS score,
        CASE WHEN p_partkey % 3 = 0 THEN CAST(p_partkey AS DOUBLE) WHEN p_partkey % 7 = 0 THEN NULL
             ELSE p_partkey * CAST(0.5 AS DOUBLE) END AS new_score FROM part""",
    "footprint_raster_join": f"{CROPS} SELECT id, raster_id FROM fr",
    "self_overlap_pairs": f"WITH {F}, {OVERLAPS.format(t='f')} SELECT id_a, id_b, overlap FROM pairs",
    "spatial_join_dense": f"""WITH {F}, {DENSE} SELECT l.id, r.id AS other, predicate FROM d l JOIN d r ON (r.id LIKE 'D%' OR r.id LIKE '%7'),
        (VALUES ('intersects'), ('overlaps')) AS p(predicate)
        WHERE CASE WHEN predicate = 'intersects' THEN l.xmin <= r.xmax AND r.xmin <= l.xmax AND l.ymin <= r.ymax AND r.ymin <= l.ymax
                   ELSE l.xmin < r.xmax AND r.xmin < l.xmax AND l.ymin < r.ymax AND r.ymin < l.ymax END""",
    "self_overlap_dense": f"""WITH {F}, {DENSE} SELECT least(a.id, b.id) AS id_a, greatest(a.id, b.id) AS id_b,
        round((least(a.xmax, b.xmax) - greatest(a.xmin, b.xmin)) * (least(a.ymax, b.ymax) - greatest(a.ymin, b.ymin)), 3) AS overlap
        FROM d a JOIN d b ON a.id < b.id AND a.xmin < b.xmax AND b.xmin < a.xmax AND a.ymin < b.ymax AND b.ymin < a.ymax""",
    "buffer_concave": f"""WITH {F}, u AS (SELECT *, xmax - xmin AS w, ymax - ymin AS h FROM f)
        SELECT id, xmin - 4 AS xmin, ymin - 4 AS ymin, xmin + 4 * w + 4 AS xmax, ymin + 4 * h + 4 AS ymax,
               round((4 * w + 8) * (4 * h + 8) - greatest(k % 13 - 6, 0) * 2 * h, 6) AS area, 1 AS n_rings, TRUE AS buffer_simple FROM u""",
    "pair_dedup": f"WITH {F}, {OVERLAPS.format(t='f')} SELECT id_a, id_b FROM pairs",
    "pending_rasters": f"WITH {F}, {R}, {LEDGER} SELECT raster_id FROM r WHERE raster_id NOT IN (SELECT raster_id FROM ledger)",
    "pending_tiles": f"WITH {BOXES} SELECT box_id, tile_name FROM grid WHERE NOT ({FETCHED})",
    "connected_components": f"{GRAPH} SELECT id, component FROM comp",
    "merge_overlaps": f"""{GRAPH}, {LEADERS} SELECT component AS group_id, max(CASE WHEN rk = 1 THEN lead.id END) AS leader_id,
        count(*) AS members, count(*) AS n_parts, sum(area) AS part_area FROM lead JOIN f ON f.id = lead.id GROUP BY component""",
    "merged_parts": f"""{GRAPH}, {LEADERS}, tops AS (SELECT component, lead.id AS leader_id FROM lead WHERE rk = 1)
        SELECT lead.component AS group_id, leader_id, f.id, area FROM lead JOIN f ON f.id = lead.id JOIN tops ON tops.component = lead.component""",
    "merge_overlapped": f"""WITH RECURSIVE {F}, g AS (SELECT * FROM f WHERE score >= 5), {OVERLAPS.format(t='g')}, {GROUPS}, {LEADERS},
        tot AS (SELECT component, count(*) AS members, min(xmin) AS xmin, min(ymin) AS ymin, max(xmax) AS xmax, max(ymax) AS ymax,
                       sum(area) AS area FROM comp JOIN f USING (id) GROUP BY component)
        SELECT f.id, commune, score, members, tot.xmin, tot.ymin, tot.xmax, tot.ymax, tot.area
        FROM f JOIN lead ON lead.id = f.id AND rk = 1 JOIN tot ON tot.component = lead.component
        UNION ALL SELECT id, commune, score, 1, xmin, ymin, xmax, ymax, area FROM f WHERE id NOT IN (SELECT id FROM comp)""",
    "commune_code": f"WITH {ROOF} SELECT batiment_groupe_id, substr(batiment_groupe_id, 1, 5) AS commune FROM roof",
    "fill_unknown": f"WITH {ROOF} SELECT batiment_groupe_id, coalesce(mat_toit_txt, 'UNKNOWN') AS roof FROM roof",
    "bbox": f"WITH {F} SELECT id, xmin, ymin, xmax, ymax FROM f",
    "min_rotated_rect": f"WITH {F} SELECT id, area AS rect_area, xmin, ymin, xmax, ymax FROM f",
    "buffer": f"""WITH {F} SELECT id, xmin - 4 AS xmin, ymin - 4 AS ymin, xmax + 4 AS xmax, ymax + 4 AS ymax,
        (xmax - xmin + 8) * (ymax - ymin + 8) AS area, TRUE AS buffer_simple FROM f""",
    "reproject_lambert93": _reproject(),
    "distinct_ids": f"""{CROPS} SELECT raster_id, 'G' || (k // 10) AS id, count(*) AS n_features FROM fr GROUP BY 1, 2""",
    "crop_suffix": f"{NAMED} SELECT id, raster_id, suffix, suffixed_name FROM named",
    "crop_rasters": f"""{CROPS}, s AS (SELECT id, raster_id, CAST(sum(((r - r0) * width + c - c0 + 1) * v) AS BIGINT) AS checksum FROM px GROUP BY 1, 2)
        SELECT id, raster_id, height, width, height * width AS n_bytes, coalesce(checksum, 0) AS checksum
        FROM crop LEFT JOIN s USING (id, raster_id)""",
    "crop_rasters_16": f"""{CROPS_16}, s AS (SELECT id, raster_id, CAST(sum(((r - r0) * width + c - c0 + 1) * v16) AS BIGINT) AS checksum FROM px16 GROUP BY 1, 2)
        SELECT id, raster_id, height, width, 'u16' AS dtype, 2 * height * width AS n_bytes, coalesce(checksum, 0) AS checksum
        FROM crop LEFT JOIN s USING (id, raster_id)""",
    "zonal_pixels_16": f"""{CROPS_16} SELECT id, raster_id, count(*) FILTER (WHERE v16 < 65535) AS n_pixels, count(*) FILTER (WHERE v16 = 65535) AS n_nodata,
        coalesce(sum(v16) FILTER (WHERE v16 < 65535), 0)::DOUBLE AS pixel_sum, (min(v16) FILTER (WHERE v16 < 65535))::DOUBLE AS pixel_min,
        (max(v16) FILTER (WHERE v16 < 65535))::DOUBLE AS pixel_max, 0 AS missing_tiles FROM px16 GROUP BY 1, 2""",
    "stretch_pixels": f"""{CROPS_16}, s AS (
          SELECT id, raster_id, CAST(sum(((r - r0) * width + c - c0 + 1) * CASE WHEN v16 = 65535 THEN 0 ELSE round_even(v16::DOUBLE / 65520.0::DOUBLE * 255.0::DOUBLE, 0) END) AS BIGINT) AS checksum
          FROM px16 GROUP BY 1, 2)
        SELECT id, raster_id, 'u8' AS dtype, height * width AS n_bytes, coalesce(checksum, 0) AS checksum
        FROM crop LEFT JOIN s USING (id, raster_id)""",
    "zonal_pixels": f"{CROPS} SELECT id, raster_id, count(*) AS n_pixels, CAST(sum(v) AS BIGINT) AS pixel_sum, 0 AS missing_tiles FROM px GROUP BY 1, 2",
    "incremental_crops": f"""{CROPS}, {LEDGER}, s AS (SELECT id, raster_id, CAST(sum(((r - r0) * width + c - c0 + 1) * v) AS BIGINT) AS checksum FROM px GROUP BY 1, 2),
        done AS (SELECT id, count(*) AS n FROM fr JOIN ledger USING (raster_id) GROUP BY 1),
        ranked AS (SELECT fr.id, fr.raster_id, row_number() OVER (PARTITION BY fr.id ORDER BY fr.raster_id) - 1 + coalesce(done.n, 0) AS suffix
                   FROM fr LEFT JOIN done ON done.id = fr.id WHERE fr.raster_id NOT IN (SELECT raster_id FROM ledger))
        SELECT id, raster_id, suffix, CASE WHEN suffix = 0 THEN id || '.jpg' ELSE id || '_' || suffix || '.jpg' END AS suffixed_name,
               coalesce(checksum, 0) AS checksum FROM ranked LEFT JOIN s USING (id, raster_id)""",
    "incremental_stream": f"""{CROPS}, s AS (SELECT id, CAST(sum(((r - r0) * width + c - c0 + 1) * v) AS BIGINT) AS checksum FROM px GROUP BY 1)
        SELECT id, count(*) AS n_crops, count(*) - 1 AS last_suffix, CAST(sum(height * width) AS BIGINT) AS n_bytes, coalesce(any_value(checksum), 0) AS checksum
        FROM crop LEFT JOIN s USING (id) GROUP BY 1""",
    "tile_grid": f"WITH {BOXES} SELECT box_id, tile_name, min_x, min_y, max_x, max_y FROM grid",
    "prepare_images": f"""{CROPS}, {PREPARED},
        s AS (SELECT id, raster_id, CAST(sum(v * (9 * pos + 6)) AS BIGINT) AS checksum FROM fit GROUP BY 1, 2)
        SELECT id, raster_id, 48 AS n_values, coalesce(checksum, 0) AS checksum FROM crop LEFT JOIN s USING (id, raster_id)""",
    "prepare_fit_images": f"""{CROPS}, {PREPARED}, keyed AS (
          SELECT id, raster_id, raster_id || '/' || id AS path, CASE WHEN height * width >= 6 THEN 'PV' ELSE 'no_PV' END AS class_name FROM crop),
        ranked AS (
          SELECT *, CAST(CAST('0x' || substr(md5('42' || path), 1, 8) AS BIGINT) AS DOUBLE) / 4294967296 AS fraction,
                 CAST(CAST('0x' || substr(md5(path || '#1#0'), 1, 8) AS BIGINT) AS DOUBLE) / 4294967296 AS u0,
                 CAST(CAST('0x' || substr(md5(path || '#1#1'), 1, 8) AS BIGINT) AS DOUBLE) / 4294967296 AS u1 FROM keyed),
        bright AS (
          SELECT k.path, class_name, fraction, u1, q.pos,
                 least(greatest(coalesce(v, 0) + (2 * u0 - 1) * CAST(0.125 AS DOUBLE) * CAST(255 AS DOUBLE), 0), 255) AS b
          FROM ranked k CROSS JOIN (SELECT unnest(range(0, 16)) AS pos) q
          LEFT JOIN fit ON fit.id = k.id AND fit.raster_id = k.raster_id AND fit.pos = q.pos WHERE fraction < 0.9),
        mean AS (SELECT *, avg(b) OVER (PARTITION BY path) AS m FROM bright),
        made AS (
          SELECT *, round_even(least(greatest((b - m) * (1 - CAST(0.875 AS DOUBLE) + 2 * CAST(0.875 AS DOUBLE) * u1) + m, 0), 255), 0) AS a FROM mean)
        SELECT CASE WHEN fraction < 0.6 THEN 'train' ELSE 'validation' END AS split, class_name, count(DISTINCT path) AS n,
               count(DISTINCT path) * 48 AS n_values, min(path) AS first_path, CAST(sum(a * (9 * pos + 6)) AS BIGINT) AS checksum
        FROM made GROUP BY 1, 2""",
    "score_images": f"""{NAMED}, {PREPARED}, s AS (SELECT id, raster_id, sum(v) AS total FROM fit GROUP BY 1, 2),
        p AS (SELECT named.id, 1 / (1 + exp(-(coalesce(total, 0) / CAST(16 AS DOUBLE) - 20) / 10)) AS p
              FROM named LEFT JOIN s USING (id, raster_id) WHERE suffix = 0)
        SELECT id AS building_name, round(p, 7) AS score, CASE WHEN p > 0.5 THEN 'PV' ELSE 'no_PV' END AS predicted_class FROM p""",
    "score_tiles": f"""WITH {BOXES}, turn AS (SELECT *, (box_id * 3 + col * 5 + "row" * 2) % 7 AS attempt FROM grid), px AS (
          SELECT box_id, tile_name, attempt, (box_id * 7 + col * 13 + "row" * 29 + q * 3) % 64 AS v
          FROM turn CROSS JOIN (SELECT unnest(range(0, 16)) AS q) WHERE attempt < 5),
        p AS (SELECT box_id, tile_name, attempt, 1 / (1 + exp(-(avg(CAST(v AS DOUBLE)) - 20) / 10)) AS p
              FROM px GROUP BY box_id, tile_name, attempt)
        SELECT box_id || '-' || tile_name AS building_name, round(p, 7) AS score, CASE WHEN p > 0.5 THEN 'PV' ELSE 'no_PV' END AS predicted_class,
               box_id, tile_name, attempt FROM p
        UNION ALL SELECT NULL, NULL, NULL, box_id, tile_name, NULL FROM turn WHERE attempt >= 5""",
    "score_postprocess": f"{POST} SELECT building_name, score, predicted_class FROM post",
    "softmax_score": f"""WITH {VEC} SELECT vec_id, round(top, 7) AS plain,
        round(exp(top) / (exp(p1) + exp(p2) + exp(p3)), 7) AS twice FROM best""",
    "argmax_class": f"WITH {VEC} SELECT vec_id, pred AS predicted FROM best",
    "path_stem": r"""WITH n AS (SELECT page_id, regexp_extract(url, '([^/]+)/*$', 1) AS name FROM pages)
        SELECT page_id, CASE WHEN regexp_matches(name, '^.+\.[^.]+$') THEN regexp_replace(name, '^(.+)\.[^.]+$', '\1') ELSE name END AS stem FROM n""",
    "encode_labels": """SELECT vec_id, label % 3 AS as_int, CAST(label % 3 % 2 AS DOUBLE) AS as_binary,
        CASE label % 3 WHEN 0 THEN '1,0,0' WHEN 1 THEN '0,1,0' ELSE '0,0,1' END AS one_hot FROM embeddings""",
    "round7": "SELECT c_custkey, round(c_acctbal / CAST(1000 AS DOUBLE), 7) AS r FROM customer",
    "sorted_paths": f"WITH {FILES} SELECT path FROM files ORDER BY path",
    "share_sample": f"""WITH {FILES}, n AS (SELECT path, row_number() OVER (ORDER BY path) AS rk, count(*) OVER () AS n FROM files)
        SELECT path FROM n WHERE rk > n - floor(CAST(0.3 AS DOUBLE) * n)""",
    "split_rank": SPLIT,
    "train_val_split": f"""SELECT doc_id, CASE WHEN fraction < 0.7 THEN 'train' ELSE 'validation' END AS split
        FROM ({SPLIT}) WHERE fraction < 0.9""",
    "exact_split": f"""WITH o AS (SELECT doc_id, row_number() OVER (ORDER BY fraction, doc_id) - 1 AS rk, count(*) OVER () AS n FROM ({SPLIT}))
        SELECT doc_id, CASE WHEN rk < floor(round(0.7 * n, 9)) THEN 'train' ELSE 'validation' END AS split
        FROM o WHERE rk < floor(round(0.7 * n, 9)) + floor(round(0.2 * n, 9))""",
    "split_disjoint": f"""SELECT count(*) FILTER (WHERE fraction < 0.7) AS n_train, count(*) FILTER (WHERE fraction >= 0.7) AS n_validation,
        0 AS n_both FROM ({SPLIT})""",
    "precision_by_class": _two_classes("y_pred", "precision", False),
    "recall_by_class": _two_classes("y_true", "recall", True),
    "log_loss": f"""WITH {EVAL}, c AS (SELECT y_true, least(greatest(p, 1e-7), 1 - 1e-7) AS p FROM ev)
        SELECT round(avg(-(CASE WHEN y_true = 1 THEN ln(p) ELSE ln(1 - p) END)), 9) AS log_loss FROM c""",
    "evaluate": _evaluate3(),
    "confusion_matrix": f"WITH {VEC} SELECT truth AS y_true, pred AS y_pred, count(*) AS n FROM best GROUP BY 1, 2",
    "enrich_chain": f"""WITH RECURSIVE {F}, {Z}, {ROOF}, {DOM},
        e AS (SELECT *, CASE WHEN k % 3 = 0 THEN CAST(k AS DOUBLE) WHEN k % 7 = 0 THEN NULL ELSE k * CAST(0.5 AS DOUBLE) END AS new_score,
                     '75' || (row_number() OVER (ORDER BY id) - 1) AS number FROM f WHERE area > 60),
        {OVERLAPS.format(t='e')}, {GROUPS},
        lead AS (SELECT id, component, row_number() OVER (PARTITION BY component ORDER BY coalesce(new_score, 0) DESC, id) AS rk
                 FROM comp JOIN e USING (id)),
        tot AS (SELECT component, count(*) AS members, sum(area) AS area FROM comp JOIN e USING (id) GROUP BY component)
        SELECT e.id, number, e.commune, coalesce(tot.area, e.area) AS area, round((xmin + xmax) / 2, 1) AS "X", round((ymin + ymax) / 2, 1) AS "Y",
               EXISTS (SELECT 1 FROM z WHERE e.xmin <= z.xmax AND z.xmin <= e.xmax AND e.ymin <= z.ymax AND z.ymin <= e.ymax) AS protected,
               coalesce(dom.toiture, 'UNKNOWN') AS toiture, new_score, coalesce(tot.members, 1) AS members
        FROM e LEFT JOIN dom ON dom.commune = e.commune LEFT JOIN lead ON lead.id = e.id LEFT JOIN tot ON tot.component = lead.component
        WHERE coalesce(rk, 1) = 1""",
    "train_classifier": """WITH s AS (
          SELECT label % 2 AS label, CAST(('0x' || substr(md5('42' || vec_id), 1, 8)) AS BIGINT) / CAST(4294967296 AS DOUBLE) AS fraction
          FROM embeddings)
        SELECT CASE WHEN fraction < 0.8 THEN 'train' ELSE 'validation' END AS split, label, count(*) AS n, TRUE AS probabilities,
               CAST(0 AS DOUBLE) AS gap FROM s WHERE fraction < 1 GROUP BY 1, 2""",
}


def _training(n_epochs: int, steps: int, n_classes: int, width: int) -> str:
    """Gradient descent on a softmax layer, a table of weights after each step."""
    classes, inputs = range(n_classes), range(width + 1)
    names = [f"w{c}_{i}" for c in classes for i in inputs]
    parts = ["""d AS (
  SELECT vec_id, x0, x1, x2, x3, 1::DOUBLE AS x4, CASE WHEN x0 + x1 > CAST(0.5 AS DOUBLE) THEN 0 WHEN x2 > 0 THEN 1 ELSE 2 END AS y
  FROM (SELECT vec_id, """ + ", ".join(f"embedding[{i + 1}]::DOUBLE * 8 AS x{i}" for i in range(width)) + " FROM embeddings))"]
    parts.append("s0 AS (SELECT " + ", ".join(f"0::DOUBLE AS {n}" for n in names) + ")")
    rows, step = [], 0
    for epoch in range(n_epochs):
        losses = []
        for turn in range(steps):
            step += 1
            u = f"CAST(CAST('0x' || substr(md5(vec_id || '#{epoch}'), 1, 8) AS BIGINT) AS DOUBLE) / 4294967296"
            scores = ", ".join(f"exp({' + '.join(f'w{c}_{i} * x{i}' for i in inputs)}) AS e{c}" for c in classes)
            total = " + ".join(f"e{c}" for c in classes)
            parts.append(f"p{step} AS (SELECT *, {total} AS t FROM (SELECT *, {scores} FROM d, s{step - 1} WHERE floor(({u}) * {steps}) = {turn}))")
            own = "CASE y " + " ".join(f"WHEN {c} THEN e{c}" for c in classes) + " END"
            moved = ", ".join(
                f"any_value(w{c}_{i}) - {1 / 2**epoch!r}::DOUBLE * avg((e{c} / t - CASE WHEN y = {c} THEN 1 ELSE 0 END) * x{i}) AS w{c}_{i}"
                for c in classes for i in inputs
            )
            parts.append(f"s{step} AS (SELECT {moved} FROM p{step})")
            parts.append(f"l{step} AS (SELECT sum(-ln({own} / t)) AS loss, count(*) AS n FROM p{step})")
            losses.append(f"SELECT * FROM l{step}")
        flat = "unnest([" + ", ".join(names) + "]) AS weight, unnest(range(" + str(len(names)) + ")) AS place"
        rows.append(
            f"SELECT {epoch} AS epoch, {1 / 2**epoch!r}::DOUBLE AS rate, (SELECT round(sum(loss) / sum(n), 6) FROM ({' UNION ALL '.join(losses)})) AS loss,"
            f" (SELECT sum(n)::BIGINT FROM ({' UNION ALL '.join(losses)})) AS n, place, round(weight, 6) AS weight FROM (SELECT {flat} FROM s{step})"
        )
    return "WITH " + ", ".join(parts) + " " + " UNION ALL ".join(rows)


ORACLES["train_epochs"] = _training(3, 2, 3, 4)
