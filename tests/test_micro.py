"""Hand-written cases for single expressions."""

import pytest
from pyspark.sql import functions as F

from deslinde.functions import answers as A
from deslinde.functions import coords as M
from deslinde.functions import geometry as G
from deslinde.functions import keys as K
from deslinde.functions import shapes
from deslinde.functions import text as T
from deslinde.operators import overlap as V
from deslinde.sources import roll


def one(spark, column, **values):
    row = spark.range(1).select(*[F.lit(v).alias(k) for k, v in values.items()]) if values else spark.range(1)
    return row.select(column.alias("r")).first()["r"]


@pytest.mark.parametrize("given, want", [
    ("Valor m² (CLP) - neto ", "valor_m²_clp_neto"), ("  Código  AH ", "código_ah"), ("__x--y__", "x_y"), ("a" * 200, "a" * 120),
])
def test_slug(spark, given, want):
    assert one(spark, T.slug(F.col("t")), t=given) == want


@pytest.mark.parametrize("given, want", [
    ("LOS AROMOS 12  DP 301 BL 2", "LOS AROMOS 12"), ("Calle 1 bx 3 z", "CALLE 1"), ("Calle 1 EDP 4A", "CALLE 1"), ("X BD 2", "X"),
    ("DPTO 3", "DPTO 3"), ("", None), (None, None),
])
def test_address_base(spark, given, want):
    assert one(spark, T.address_base(F.col("t").cast("string")), t=given) == want


@pytest.mark.parametrize("given, want", [(" 397 ", "00397"), ("123456", "123456"), ("12345", "12345"), ("", "00000")])
def test_zfill(spark, given, want):
    assert one(spark, K.zfill(F.col("t")), t=given) == want


def test_parse_v_strict_rejects(spark):
    with pytest.raises(Exception, match="malformed parcel key"):
        one(spark, K.parse_v_strict(F.col("t")), t="13101|00001")


@pytest.mark.parametrize("mb, want", [(500, "large"), (501, "huge"), (200, "medium"), (50, "small")])
def test_size_tier_edges(spark, mb, want):
    assert one(spark, T.size_tier(F.lit(mb * 1048576 + 5))) == want


def test_accents(spark):
    assert one(spark, T.normal_name(F.lit("Ñuñoa Viña"))) == "NUNOA VINA"
    assert one(spark, T.layer_name(F.lit("13101"), F.lit("Santiago"))) == "SANTIAGO_CENTRO"
    assert one(spark, T.layer_word(F.lit("Viña del Mar"))) == "VINA_DEL_MAR"


def test_coord_key_is_half_even(spark):
    assert one(spark, K.coord_key(F.lit(0.0000005))) == 0
    assert one(spark, K.coord_key(F.lit(0.0000015))) == 2


def square():
    return G.box_ring(F.lit(0.0), F.lit(0.0), F.lit(10.0), F.lit(10.0))


def holes():
    return F.array(G.box_ring(F.lit(4.0), F.lit(4.0), F.lit(6.0), F.lit(6.0)))


@pytest.mark.parametrize("x, y, want", [(1, 1, True), (0, 5, False), (10, 10, False), (5, 5, False), (4, 5, False), (3.999, 5, True), (11, 5, False)])
def test_contains_excludes_boundary(spark, x, y, want):
    assert one(spark, G.contains(square(), holes(), F.lit(float(x)), F.lit(float(y)))) is want
    assert one(spark, G.position(square(), holes(), F.lit(float(x)), F.lit(float(y))))["inside"] is want


def test_measures(spark):
    assert one(spark, G.area(square(), holes())) == 96.0
    assert one(spark, G.distance(square(), holes(), F.lit(13.0), F.lit(14.0))) == 5.0
    assert one(spark, G.distance(square(), holes(), F.lit(5.0), F.lit(5.0))) == 1.0
    c = one(spark, G.centroid(square(), holes()))
    assert (round(c["x"], 9), round(c["y"], 9)) == (5.0, 5.0)


def test_hole_of_exactly_the_limit_is_kept(spark):
    assert one(spark, F.size(G.fill_holes(holes(), 4.0))) == 1
    assert one(spark, F.size(G.fill_holes(holes(), 4.1))) == 0


def test_tile_arithmetic(spark):
    assert one(spark, M.tile_x(F.lit(0.0))) == 2**18
    box = one(spark, M.tile_box(F.lit(0), F.lit(0)))
    assert (box["minx"], box["maxy"]) == (-20037508.34, 20037508.34)


def test_utm_known_point(spark):
    # the central meridian of zone 19 and the equator
    ll = one(spark, M.utm_to_lonlat(F.lit(500000.0), F.lit(10000000.0)))
    assert abs(ll["lon"] + 69) < 1e-12 and abs(ll["lat"]) < 1e-12


def test_roll_file_keeps_odd_characters(spark, tmp_path):
    line = "13101" "2025" "2" "A" + " " * 6 + '  "Ñ\\n" #1 \\'.ljust(40) + "   12" + "    7" + "N" + "1".rjust(13) + "2".rjust(15) + " " * 15 + "2030UH"
    (tmp_path / "roll.txt").write_bytes(("\n".join([line, "", "   ", "# " + line[2:]]) + "\n").encode("latin-1"))
    rows = roll.parse_roll(roll.read_lines(spark, str(tmp_path))).collect()
    good = [r for r in rows if r["_parse_ok"]]
    assert len(rows) == 2 and good[0]["direccion"] == '"Ñ\\n" #1 \\' and good[0]["v"] == "13101|00012|00007"


def test_layer_numbering_skips_taken_names(spark):
    items = F.array(*[
        F.struct(F.lit(0).alias("layer"), F.lit("t").alias("title"), F.lit(k).alias("label"), F.lit(v).alias("value"), F.lit(True).alias("is_text"))
        for k, v in [("x__2", "taken"), ("x", "1"), ("x", "1"), ("x", "2"), ("x", "2")]
    ])
    got = one(spark, A.flatten_layers(items))
    assert got == {"cap__t__x__2": "taken", "cap__t__x": "1", "cap__t__x__3": "2", "cap__t__x__4": "2"}


def test_ah_null_does_not_fall_back(spark):
    rows = [(1, "1", "1", '{"data":{"ah":null,"datosAh":{"codigoAh":"C"}}}'), (1, "1", "2", '{"data":{"datosAh":{"codigoAh":"C"}}}')]
    got = A.base_record(spark.createDataFrame(rows, "comuna int, manzana string, predio string, json string")).select("predio", "ah").collect()
    assert dict(got) == {"1": None, "2": "C"}


def test_shared_area_of_triangles():
    import numpy as np

    tri = lambda pts: np.array([[*a, *b] for a, b in zip(pts, pts[1:] + pts[:1])], dtype=float).T
    p, q = tri([(0, 0), (4, 0), (0, 4)]), tri([(0, 0), (4, 0), (4, 4)])
    assert abs(shapes.shared_area(p, q) - 4.0) < 1e-12
    assert abs(shapes.shared_area(p, p) - 8.0) < 1e-12
    assert shapes.shared_area(p, tri([(9, 9), (10, 9), (9, 10)])) == 0


def test_half_covered_is_kept(spark):
    box = lambda x: G.box_ring(F.lit(x), F.lit(0.0), F.lit(x + 0.001), F.lit(0.001))
    layer = lambda x, i: spark.range(1).select(F.lit(1).alias("comuna"), F.lit(i).cast("bigint").alias("poly_idx"), box(x).alias("shell"), G.no_holes().alias("holes"))
    agri = layer(0.0005, 7).unionByName(layer(0.0004, 8))
    got = V.overlap_dedup(layer(0.0, 1), agri).select("poly_idx").collect()
    assert sorted(r[0] for r in got) == [1, 7]
