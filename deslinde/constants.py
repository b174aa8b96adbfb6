"""Fixed values of the cadastral domain.

They have to equal the published ones for results to agree, so they are kept
together and stated plainly.
"""

# --- fixed values: fixed-width roll layout (1-based first and last column) ---
ROLL_FIELDS = [
    ("comuna", 1, 5),
    ("anio", 6, 9),
    ("semestre", 10, 10),
    ("indicador_aseo", 11, 11),
    ("direccion", 18, 57),
    ("manzana", 58, 62),
    ("predio", 63, 67),
    ("serie", 68, 68),
    ("cuota_trimestral", 69, 81),
    ("avaluo_total", 82, 96),
    ("avaluo_exento", 97, 111),
    ("anio_termino_exencion", 112, 115),
    ("codigo_ubicacion", 116, 116),
    ("codigo_destino", 117, 117),
]
ROLL_MIN_KEY_LENGTH = 67

# --- fixed values: roll columns added to an answer, and their names there ---
ROLL_ENRICHMENT = {
    "direccion": "txt_direccion",
    "avaluo_total": "txt_avaluo_total",
    "avaluo_exento": "txt_avaluo_exento",
    "cuota_trimestral": "txt_cuota_trimestral",
    "serie": "txt_serie",
    "indicador_aseo": "txt_ind_aseo",
    "anio_termino_exencion": "txt_anio_term_exencion",
    "codigo_ubicacion": "txt_cod_ubicacion",
    "codigo_destino": "txt_cod_destino",
}

# --- fixed values: registry columns ---
REGISTRY_KEY = ["comuna", "manzana", "predio"]
REGISTRY_ADDED = [
    "dc_contribucion_semestral", "dc_cod_destino", "dc_avaluo_fiscal",
    "dc_avaluo_exento", "dc_sup_terreno", "dc_cod_ubicacion", "dc_direccion",
    "dc_bc1_comuna", "dc_bc1_manzana", "dc_bc1_predio",
    "dc_bc2_comuna", "dc_bc2_manzana", "dc_bc2_predio",
    "dc_padre_comuna", "dc_padre_manzana", "dc_padre_predio",
    "n_lineas_construccion", "sup_construida_total",
    "anio_construccion_min", "anio_construccion_max",
    "materiales", "calidades", "pisos_max", "serie",
]
REGISTRY_OWN = [
    "periodo", "anio", "semestre",
    "rc_direccion", "rc_serie", "rc_ind_aseo", "rc_cuota_trimestral",
    "rc_avaluo_total", "rc_avaluo_exento", "rc_anio_term_exencion",
    "rc_cod_ubicacion", "rc_cod_destino",
]

# --- fixed values: coordinate validity (degrees) ---
LAT_MIN, LAT_MAX = -62.0, -17.0
LAT_MAX_LEGACY = -15.0
LON_MIN, LON_MAX = -80.0, -64.0

# --- fixed values: match cascade ---
METRES_PER_DEGREE = 111000
NEAREST_M = 10
NEIGHBOUR_TOLERANCE = 20
FALLBACK_NEAREST_M = 500
BASE_GROUP_DEGREES = 0.001
BASE_NUMBER_FIRST, BASE_NUMBER_LAST = 90001, 90999
NUMBER_READ_LAST = 89999
NUMBER_READ_MIN_AREA_M2 = 200
OVERLAP_DROP = 0.50
OVERLAP_USED = 0.90

# --- fixed values: tile grid ---
ZOOM = 19
TILE_PX = 256
CELL_TILES = 4
BLOCK_TILES = 64
BLOCK_STEP_TILES = 60
MERCATOR_HALF = 20037508.34
EARTH_RADIUS = 6378137.0
GRID_BUFFER_M = 1500.0
BBOX_PAD_DEGREES = 0.002
LARGE_TILE_COUNT = 50000
MIN_IMAGE_BYTES = 100
MIN_CELLS_EXCLUSIVE = 100

# --- fixed values: pixel classes and polygon filters ---
URBAN_RED_MIN, URBAN_RED_MAX = 160, 200
EXACT_RED = 182
OPAQUE = 255
AGRI_ALPHA = 179
GATE_OPAQUE_PX = 100
GATE_URBAN_FILL_PX = 50
GATE_AGRI_FILL_PX = 100
GATE_AGRI_BORDER_PX = 5
URBAN_DILATION, AGRI_DILATION = 1, 3
URBAN_AREA_M2 = (1.0, 50000.0)
AGRI_MIN_AREA_M2 = 5000.0
FINAL_MIN_AREA_M2 = 500.0
HOLE_FILL_URBAN_M2 = 50.0
HOLE_FILL_AGRI_M2 = 500.0
HOLE_FILL_JOIN_M2 = 200.0
HOLE_FILL_COMPACT_M2 = 100.0
HOLE_COMPACTNESS = 0.25
SIMPLIFY_MATCHED_DEGREES = 0.00001
SIMPLIFY_ORPHAN_DEGREES = 0.00005
AREA_BINS = [(1, 5), (5, 20), (20, 50), (50, 100), (100, 200), (200, 300),
             (300, 500), (500, 1000), (1000, 5000), (5000, 50000)]
REPAIR_MIN_BORDER_PX = 10
LEGACY_AREA_M2 = (1.0, 50_000.0)
REPAIR_PAD_M = 10.0
REPAIR_MIN_SIDE_PX = 256
REPAIR_METRES_PER_PX = (2.0, 1.0, 0.5)

# --- fixed values: operations ---
STALL_SECONDS = 60
FAILURE_RUN = 20
STEAL_MIN_REMAINING = 20
TIER_MB = [("huge", 500), ("large", 200), ("medium", 50)]
TIER_REST = "small"

# --- fixed values: text ---
NULL_WORDS = ["", "None", "nan"]
TRUE_WORDS = ["true", "1", "t", "yes", "y", "si"]
SLUG_LENGTH = 120
PREPOSITION_SPLITS = [
    ("DELAPAZ", "DE_LA_PAZ"), ("DELAS", "DE_LAS"), ("DELOS", "DE_LOS"),
    ("DELA", "DE_LA"), ("DEL", "DEL"), ("DE", "DE"),
]
LAYER_NAME = "sii:BR_CART_%s_WMS"
LAYER_NAME_EXCEPTIONS = {13101: "SANTIAGO_CENTRO"}
LAYER_NAME_OVERRIDES = {
    2303: "SAN_PEDRO_ATACAMA", 3304: "ALTO_DEL_CARMEN", 5309: "CONCON",
    5504: "CALERA", 5606: "LLAILLAY", 6104: "MOSTAZAL", 6117: "QUINTA_TILCOCO",
    8108: "TREHUACO", 8210: "SAN_PEDRO_DE_LA_PAZ", 10207: "SAN_JUAN_LA_COSTA",
    10410: "CURACO_DE_VELEZ", 11302: "O'HIGGINS", 12101: "PUERTO_NATALES",
    12103: "TORRES_DEL_PAINE", 13134: "SANTIAGO_OESTE", 13135: "SANTIAGO_SUR",
    14203: "TIL_TIL", 16162: "PEDRO_AGUIRRE_CERDA", 16303: "SAN_JOSE_MAIPO",
}

# --- fixed values: nested answer, output column -> path below $.data ---
ANSWER_SCALARS = {
    "existePredio": "existePredio", "eacs": "eacs", "eacano": "eacano",
    "eacsDescripcion": "eacsDescripcion", "direccion_sii": "direccion",
    "nombreComuna": "nombreComuna", "destinoDescripcion": "destinoDescripcion",
    "ubicacion": "ubicacion", "valorTotal": "valorTotal",
    "valorAfecto": "valorAfecto", "valorExento": "valorExento",
    "supTerreno": "supTerreno", "supConsMt2": "supConsMt2",
    "supConsMt3": "supConsMt3", "medidaSup": "medidaSup",
    "medidaSupConst": "medidaSupConst", "sector": "sector",
    "tablaOrigen": "tablaOrigen", "periodo": "periodo",
    "lat": "ubicacionX", "lon": "ubicacionY",
}
ANSWER_AH = {
    "ah_rangoSuperficie": "rangoSuperficie", "ah_valorUnitario": "valorUnitario",
    "ah_numeroMuestras": "numeroMuestras", "ah_coefVariacion": "coefVariacion",
    "ah_mediana": "mediana", "ah_eac": "eac", "ah_eacano": "eacano",
    "ah_utm_x": "ubicacionX", "ah_utm_y": "ubicacionY",
}
ANSWER_PUBLISHED = {
    "predioPublicado_id": "id", "predioPublicado_comuna": "comuna",
    "predioPublicado_manzana": "manzana", "predioPublicado_predio": "predio",
    "predioPublicado_utm_x": "ubicacionX", "predioPublicado_utm_y": "ubicacionY",
}
ANSWER_CSA = {
    "csa_sector": "sector", "csa_clase": "clase", "csa_utm_x": "ubicacionX",
    "csa_utm_y": "ubicacionY", "csa_eac": "eac", "csa_eacano": "eacano",
    "csa_valorUnitario": "valorUnitario",
}
OBSERVATORY_WORD = "observatorio"
OBSERVATORY_TITLE_LEGACY = "observatorio de mercado de suelo urbano 2025"
OBSERVATORY_NAMES = {
    "region": "obs_region", "región": "obs_region", "comuna": "obs_comuna",
    "codigo_area_homogenea": "obs_codigo_area_homogenea",
    "código_área_homogénea": "obs_codigo_area_homogenea",
    "valor_comercial_m2_de_suelo": "obs_valor_comercial_m2_suelo",
    "valor_comercial_m²_de_suelo": "obs_valor_comercial_m2_suelo",
}
LAND_VALUE_LABELS = ["valor m² de terreno", "valor m2 de terreno"]
POINT_FIELDS_TRIMMED = {"rol": "rol", "direccion": "direccion",
                        "destino": "destinoDescripcion", "ah": "ah"}
POINT_FIELDS = {"manzana": "manzana", "predio": "predio", "lat": "ubicacionX",
                "lon": "ubicacionY", "avaluo_total": "valorTotal",
                "avaluo_afecto": "valorAfecto", "avaluo_exento": "valorExento",
                "sup_terreno": "supTerreno", "sup_construida": "supConsMt2"}

# --- fixed values: request services, (layer, style, eac, eacano) ---
SERVICES = {
    "default": [("sii:BR_CART_AH_MUESTRAS", "AH_MUESTRA_EAC_14_2022", 14, 2022)],
    "obs_ah": [
        ("sii:BR_CART_AH_MUESTRAS", "AH_MUESTRA_EAC_15_2025", 15, 2025),
        ("sii:BR_CART_OBS_SUELO_15", "OBS_SUELO_15_V2", 15, 2025),
    ],
    "full_generic": [
        ("sii:BR_CART_AH_MUESTRAS", "AH_MUESTRA_EAC_15_2025", 15, 2025),
        ("sii:BR_CART_CSA_MUESTRAS", "CSA_MUESTRA_EAC_16_2024", 16, 2024),
        ("sii:BR_CART_AH_MUESTRAS", "AH_MUESTRA_EAC_15_2024", 15, 2024),
        ("sii:BR_CART_AH_MUESTRAS", "AH_MUESTRA_EAC_15_2023", 15, 2023),
        ("sii:BR_CART_AH_MUESTRAS", "AH_MUESTRA_EAC_14_2022", 14, 2022),
        ("sii:BR_CART_TEMATICA", "DEST_EDUCACION", 0, 0),
        ("sii:BR_CART_TEMATICA", "DESTINOS_02", 0, 0),
        ("sii:BR_CART_OBS_SUELO_15", "OBS_SUELO_15_V2", 15, 2025),
    ],
}
PARCEL_LAYER_STYLE = "PREDIOS_WMS_V0"
CLICK_HALF_LAT, CLICK_HALF_LON = 0.0003, 0.0004

# --- fixed values: column order of an incremental result file ---
PREFERRED_ORDER = [
    "v", "comuna", "manzana", "predio", "rol", "rol_base",
    "_ok", "_status", "_msg", "_error", "nombreComuna", "direccion_sii",
    "lat", "lon", "valorTotal", "valorAfecto", "valorExento",
    "supTerreno", "supConsMt2", "supConsMt3", "valorComercial_clp_m2",
    "txt_direccion", "txt_avaluo_total", "txt_avaluo_exento",
    "txt_cuota_trimestral", "txt_serie", "txt_ind_aseo",
    "txt_anio_term_exencion", "txt_cod_ubicacion", "txt_cod_destino",
    "_extra_json",
]
