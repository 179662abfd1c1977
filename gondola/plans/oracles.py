"""SQL for the registered queries, written independently of the operators and run on the
test tables by another engine. Fragments name the model's tables; each text is complete.

Values whose last bits depend on summation order are rounded, as in queries.rounded."""

from __future__ import annotations

BASKET = (
    "('blue anvil', 'blue bolt', 'blue gizmo', 'blue ring', 'blue rod', "
    "'blue widget', 'cold anvil', 'cold bolt', 'cold gear', 'cold gizmo')"
)

MODEL = {
    "obs": """SELECT CAST(l_shipdate AS DATE) AS fecha, CAST(l_partkey AS INT) AS producto_id,
        CAST(l_suppkey AS INT) AS establecimiento_id, l_extendedprice AS precio,
        CASE WHEN l_discount > 0 THEN 1 ELSE 0 END AS oferta,
        CAST(year(l_shipdate) AS INT) AS anio, CAST(month(l_shipdate) AS INT) AS mes FROM lineitem""",
    "prod": """SELECT CAST(p_partkey AS INT) AS producto_id, p_name || ' ' || p_brand AS nombre_completo,
        p_name AS nombre, p_type AS categoria, 'size ' || CAST(p_size AS VARCHAR) AS subcategoria,
        p_brand AS marca FROM part""",
    "tienda": """SELECT CAST(s_suppkey AS INT) AS establecimiento_id, s_name AS nombre,
        CASE WHEN s_suppkey % 7 = 0 THEN NULL ELSE n_name END AS cadena,
        CASE WHEN s_suppkey % 7 = 0 THEN 'Sin Cadena' ELSE n_name END AS cadena_normalizada
        FROM supplier JOIN nation ON s_nationkey = n_nationkey""",
    "lugar": """SELECT CAST(s_suppkey AS INT) AS establecimiento_id, r_name AS departamento, n_name AS ciudad,
        'Dir ' || CAST(s_suppkey AS VARCHAR) AS direccion,
        CASE WHEN s_suppkey % 5 = 0 THEN 'Sin Barrio' ELSE 'Barrio ' || CAST(s_suppkey % 3 AS VARCHAR) END AS barrio
        FROM supplier JOIN nation ON s_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey""",
    "dias": """SELECT DISTINCT CAST(l_shipdate AS DATE) AS fecha FROM lineitem""",
    "tiempo": """SELECT fecha, CAST(strftime(fecha, '%Y%m%d') AS INT) AS fecha_id,
        CAST(year(fecha) AS INT) AS anio, CAST(month(fecha) AS INT) AS mes, CAST(day(fecha) AS INT) AS dia,
        CAST(quarter(fecha) AS INT) AS trimestre, CAST(dayofweek(fecha) + 1 AS INT) AS dia_semana,
        CAST(weekofyear(fecha) AS INT) AS semana_anio, monthname(fecha) AS nombre_mes,
        dayname(fecha) AS nombre_dia FROM dias""",
    "crudo": """SELECT CASE WHEN l_linenumber <> 2 THEN CAST(l_shipdate AS DATE) END AS fecha,
        CAST(l_partkey AS VARCHAR) || CASE WHEN l_linenumber = 3 THEN '.0' ELSE '' END AS producto_id,
        CAST(l_suppkey AS VARCHAR) AS establecimiento_id, l_extendedprice AS precio,
        CASE WHEN l_linenumber <> 4 THEN CASE WHEN l_discount > 0 THEN 1 ELSE 0 END END AS oferta
        FROM lineitem WHERE l_quantity > 5 AND (l_quantity <> 6 OR l_linenumber = 3)""",
    "crudo_prod": """SELECT CAST(p_partkey AS VARCHAR) AS producto_id, p_type AS producto, p_brand AS marca,
        printf('size %02d', p_size) AS especificacion, p_name AS nombre, p_type AS categoria,
        printf('size %02d', p_size) AS subcategoria FROM part""",
    "crudo_tienda": """SELECT CAST(s_suppkey AS VARCHAR) AS establecimiento_id, s_name AS razon_social,
        s_name AS nombre, 'Dir ' || CAST(s_suppkey AS VARCHAR) AS direccion, n_name AS ciudad, r_name AS depto,
        CAST(NULL AS VARCHAR) AS cadena,
        CASE WHEN s_suppkey % 5 = 0 THEN 'Sin Barrio' ELSE 'Barrio ' || CAST(s_suppkey % 3 AS VARCHAR) END AS barrio
        FROM supplier JOIN nation ON s_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey""",
}

EXACT_MEAN = "CAST(sum(CAST(precio AS DECIMAL(12, 2))) AS DOUBLE) / count(*)"
EXACT_SUM = "CAST(sum(CAST(precio AS DECIMAL(12, 2))) AS DOUBLE)"

METRICS = {
    "por_nombre": f"""SELECT nombre AS producto, anio, mes, count(*) AS num_observaciones,
        min(precio) AS precio_minimo, max(precio) AS precio_maximo, {EXACT_MEAN} AS precio_promedio
        FROM obs JOIN prod USING (producto_id) GROUP BY ALL""",
    "por_id": f"""SELECT producto_id, nombre AS producto_nombre, anio, mes, count(*) AS num_observaciones,
        min(precio) AS precio_minimo, max(precio) AS precio_maximo, {EXACT_MEAN} AS precio_promedio
        FROM obs JOIN prod USING (producto_id) GROUP BY ALL""",
    "por_dia": f"""SELECT producto_id, nombre AS producto_nombre, fecha, {EXACT_MEAN} AS precio_promedio
        FROM obs JOIN prod USING (producto_id) GROUP BY ALL""",
    "dispersion": """SELECT producto, anio, mes, precio_minimo, precio_maximo, precio_promedio,
        (precio_maximo - precio_minimo) / precio_promedio AS indice_dispersion FROM por_nombre""",
    "cambios": """SELECT producto, anio, mes, precio_promedio AS precio_mes,
        lag(precio_promedio) OVER (PARTITION BY producto ORDER BY anio, mes) AS precio_anterior FROM por_nombre""",
    "variacion": """SELECT *, (precio_mes - precio_anterior) / precio_anterior * 100 AS variacion_pct
        FROM cambios WHERE precio_anterior IS NOT NULL""",
    "canasta": f"""SELECT t.nombre AS supermercado, anio, mes, {EXACT_SUM} AS costo_canasta
        FROM obs JOIN prod p USING (producto_id) JOIN tienda t USING (establecimiento_id)
        WHERE p.nombre IN {BASKET} GROUP BY ALL""",
    "articulo": f"""SELECT establecimiento_id, t.nombre AS establecimiento_nombre, producto_id, anio, mes,
        {EXACT_MEAN} AS precio_promedio
        FROM obs JOIN prod p USING (producto_id) JOIN tienda t USING (establecimiento_id)
        WHERE p.nombre IN {BASKET} GROUP BY ALL""",
    "canasta_media": """SELECT establecimiento_id, establecimiento_nombre, anio, mes,
        sum(precio_promedio) AS costo, count(producto_id) AS num_productos_canasta
        FROM articulo GROUP BY ALL""",
    "orden": """SELECT *, CAST(row_number() OVER (PARTITION BY anio, mes ORDER BY costo_canasta, supermercado) AS BIGINT)
        AS ranking FROM canasta""",
    "ultimo": """SELECT * FROM orden WHERE anio * 12 + mes = (SELECT max(anio * 12 + mes) FROM canasta)""",
    "lideres": """SELECT supermercado FROM canasta GROUP BY supermercado
        ORDER BY count(*) DESC, supermercado LIMIT 8""",
    "canasta_lider": """SELECT * FROM canasta WHERE supermercado IN (SELECT supermercado FROM lideres)""",
    "integrado": """SELECT producto, anio, mes, precio_minimo, precio_maximo, precio_promedio, indice_dispersion,
        variacion_pct FROM dispersion JOIN variacion USING (producto, anio, mes)""",
    "integrado_corto": """SELECT * FROM integrado WHERE indice_dispersion < 2.0
        AND variacion_pct >= -50 AND variacion_pct <= 50""",
    "var_corta": "SELECT * FROM variacion WHERE variacion_pct >= -50 AND variacion_pct <= 50",
    "disp_corta": "SELECT * FROM dispersion WHERE indice_dispersion <= 2.0",
    "meses": """SELECT anio, mes, make_date(anio, mes, 1) AS fecha,
        avg(p) AS precio_promedio, avg(v) AS variacion_pct, avg(d) AS indice_dispersion,
        CAST(sum(CAST(c AS DECIMAL(18, 2))) AS DOUBLE) / count(c) AS costo_canasta
        FROM (SELECT anio, mes, precio_promedio AS p, NULL AS v, NULL AS d, NULL AS c FROM por_nombre
        UNION ALL SELECT anio, mes, NULL, variacion_pct, NULL, NULL FROM variacion
        UNION ALL SELECT anio, mes, NULL, NULL, indice_dispersion, NULL FROM dispersion
        UNION ALL SELECT anio, mes, NULL, NULL, NULL, costo_canasta FROM canasta) GROUP BY anio, mes""",
}

# What a fragment is built on, so that a query carries no more than it uses.
USES = {
    "tiempo": ["dias"],
    "por_nombre": ["obs", "prod"],
    "por_id": ["obs", "prod"],
    "por_dia": ["obs", "prod"],
    "dispersion": ["por_nombre"],
    "cambios": ["por_nombre"],
    "variacion": ["cambios"],
    "canasta": ["obs", "prod", "tienda"],
    "articulo": ["obs", "prod", "tienda"],
    "canasta_media": ["articulo"],
    "orden": ["canasta"],
    "ultimo": ["orden"],
    "lideres": ["canasta"],
    "canasta_lider": ["canasta", "lideres"],
    "integrado": ["dispersion", "variacion"],
    "integrado_corto": ["integrado"],
    "var_corta": ["variacion"],
    "disp_corta": ["dispersion"],
    "meses": ["por_nombre", "variacion", "dispersion", "canasta"],
}

ORACLES: dict[str, str] = {}


def _closure(names: list[str]) -> list[str]:
    found: list[str] = []
    for name in names:
        for needed in [*_closure(USES.get(name, [])), name]:
            if needed not in found:
                found.append(needed)
    return found


def oracle(key: str, uses: str, text: str) -> None:
    parts = {**MODEL, **METRICS}
    fragments = ", ".join(f"{n} AS ({parts[n]})" for n in _closure(uses.split()))
    ORACLES[key] = f"WITH {fragments} {text}" if fragments else text


def check(table: str, kind: str, column: str, bad: str, source: str | None = None) -> str:
    """A quality-check row counting the rows of source for which `bad` holds."""
    return f"""SELECT '{table}' AS tabla, '{kind}' AS check_type, '{column}' AS columna, count(*) AS total_rows,
        count(*) FILTER (WHERE {bad}) AS failed_rows, 
        CAST(count(*) FILTER (WHERE {bad}) AS DOUBLE) / count(*) * 100 AS failed_pct,
        count(*) FILTER (WHERE {bad}) = 0 AS passed FROM {source}"""


def surplus(table: str, column: str, source: str, keys: str) -> str:
    return f"""SELECT '{table}' AS tabla, 'duplicates' AS check_type, '{column}' AS columna, t AS total_rows,
        t - u AS failed_rows, (t - u) / t * 100 AS failed_pct, t = u AS passed
        FROM (SELECT (SELECT count(*) FROM {source}) AS t,
        (SELECT count(*) FROM (SELECT DISTINCT {keys} FROM {source})) AS u)"""


# --- sources and cleaning

oracle("raw_prices", "crudo", "SELECT * FROM crudo")
oracle("raw_products", "crudo_prod", "SELECT * FROM crudo_prod")
oracle("raw_stores", "crudo_tienda", "SELECT * FROM crudo_tienda")
oracle(
    "multi_year_prices", "",
    """SELECT CAST(year(l_shipdate) AS INT) AS anio_archivo, count(*) AS filas FROM lineitem
    WHERE l_linenumber <> 7 AND l_quantity > 5 GROUP BY 1""",
)
oracle(
    "source_contract", "",
    """SELECT 'precios' AS archivo, TRUE AS existe, '' AS columnas_faltantes, count(*) AS filas, TRUE AS passed
    FROM lineitem UNION ALL SELECT 'productos', TRUE, '', 2 * count(*), TRUE FROM part
    UNION ALL SELECT 'establecimientos', TRUE, 'barrio', 2 * count(*), FALSE FROM supplier""",
)
oracle(
    "ingest_audit", "crudo",
    """SELECT 'precios' AS archivo, (SELECT count(*) FROM lineitem) AS filas_leidas, count(*) AS filas_validas,
    count(*) FILTER (WHERE fecha IS NULL) AS fechas_nulas FROM crudo
    UNION ALL SELECT 'productos', 2 * count(*), count(*), 0 FROM part
    UNION ALL SELECT 'establecimientos', 2 * count(*), count(*), 0 FROM supplier""",
)

# --- model

oracle("dim_time", "tiempo", "SELECT * FROM tiempo")
oracle(
    "dim_product", "crudo_prod",
    """SELECT CAST(producto_id AS INT) AS producto_id, nombre AS nombre_completo, producto AS nombre, categoria,
    subcategoria, marca, especificacion FROM crudo_prod""",
)
oracle(
    "dim_store", "crudo_tienda",
    """SELECT CAST(establecimiento_id AS INT) AS establecimiento_id, nombre, razon_social, cadena,
    'Sin Cadena' AS cadena_normalizada FROM crudo_tienda""",
)
oracle(
    "dim_location", "lugar",
    "SELECT *, establecimiento_id AS ubicacion_id FROM lugar",
)
oracle(
    "fact_prices", "obs",
    """SELECT CAST(strftime(CAST(l_shipdate AS DATE), '%Y%m%d') AS INT) AS fecha_id,
    CAST(l_partkey AS INT) AS producto_id, CAST(l_suppkey AS INT) AS establecimiento_id,
    CAST(l_suppkey AS INT) AS ubicacion_id, l_extendedprice AS precio,
    CASE WHEN l_discount > 0 THEN 1 ELSE 0 END AS oferta, CAST(l_shipdate AS DATE) AS fecha FROM lineitem
    WHERE l_linenumber <> 2 AND l_partkey IN (SELECT p_partkey FROM part)
    AND l_suppkey IN (SELECT s_suppkey FROM supplier)""",
)
oracle("fact_partitions", "obs", "SELECT fecha, count(*) AS filas FROM obs GROUP BY fecha")
oracle(
    "arrivals_current", "",
    """WITH l AS (SELECT CAST(l_shipdate AS DATE) AS d, l_partkey AS p, l_suppkey % 50 AS s, l_extendedprice AS precio, l_linenumber AS n FROM lineitem),
    fuentes AS (SELECT d, p, s, precio, n AS oferta, 3 AS t, '' AS f FROM l WHERE n <= 5
        UNION ALL SELECT d, p, s, precio, n + 100, n % 7, 'd' || n FROM l WHERE n >= 2),
    puestas AS (SELECT *, rank() OVER (PARTITION BY d, p, s ORDER BY t DESC, f = '' DESC, f DESC) AS lugar FROM fuentes)
    SELECT CAST(oferta AS INT) AS oferta, count(*) AS filas, min(precio) AS minimo FROM puestas WHERE lugar = 1 GROUP BY oferta""",
)
oracle(
    "variation_daily_carried", "por_dia",
    """SELECT * EXCLUDE (anterior) FROM (SELECT producto_id, producto_nombre, fecha, precio_promedio,
    lag(precio_promedio) OVER (PARTITION BY producto_id ORDER BY fecha) AS anterior,
    (precio_promedio - anterior) / anterior * 100 AS variacion_diaria_pct FROM por_dia)
    WHERE anterior IS NOT NULL AND year(fecha) >= 1998""",
)
oracle(
    "distinct_products_rollup", "obs lugar",
    """SELECT anio, count(DISTINCT producto_id) AS productos, TRUE AS cerca FROM obs JOIN lugar USING (establecimiento_id) GROUP BY anio""",
)
oracle(
    "fact_prices_salted", "obs prod",
    """SELECT producto_id, marca, count(*) AS filas, max(precio) AS precio_maximo
    FROM (SELECT CASE WHEN day(fecha) <= 10 THEN 1 ELSE producto_id END AS producto_id, precio FROM obs) JOIN prod USING (producto_id) GROUP BY ALL""",
)
oracle(
    "quartiles_by_year_from_states", "obs",
    """SELECT anio, count(*) AS cantidad, round(quantile_cont(precio, 0.25), 6) AS q1, round(quantile_cont(precio, 0.5), 6) AS mediana,
    round(quantile_cont(precio, 0.75), 6) AS q3 FROM obs GROUP BY anio""",
)
oracle(
    "cube_incremental", "obs",
    f"""SELECT anio, mes, count(*) AS num_observaciones, min(precio) AS precio_minimo, max(precio) AS precio_maximo,
    {EXACT_MEAN} AS precio_promedio FROM obs GROUP BY anio, mes""",
)

# --- metrics

oracle(
    "avg_price_by_name_month", "por_nombre", "SELECT producto, anio, mes, precio_promedio FROM por_nombre"
)
oracle(
    "avg_price_by_product_month", "por_id",
    "SELECT producto_id, producto_nombre, anio, mes, precio_promedio, num_observaciones FROM por_id",
)
oracle(
    "min_max_by_name_month", "por_nombre",
    "SELECT producto, anio, mes, precio_minimo, precio_maximo, precio_promedio FROM por_nombre",
)
oracle(
    "min_max_by_product_month", "por_id",
    "SELECT producto_id, producto_nombre, anio, mes, precio_minimo, precio_maximo, precio_promedio FROM por_id",
)
oracle("dispersion_by_name_month", "dispersion", "SELECT * FROM dispersion")
oracle(
    "dispersion_by_product_month", "por_id",
    """SELECT producto_id, producto_nombre, anio, mes, precio_minimo, precio_maximo, precio_promedio,
    (precio_maximo - precio_minimo) / precio_promedio AS indice_dispersion FROM por_id""",
)
oracle("variation_monthly_by_name", "variacion", "SELECT * FROM variacion")
oracle(
    "variation_monthly_by_product", "por_id",
    """SELECT producto_id, producto_nombre, anio, mes, anio || '-' || lpad(CAST(mes AS VARCHAR), 2, '0') AS anio_mes,
    precio_promedio AS precio_promedio_mes, (precio_promedio - antes) / antes * 100 AS variacion_mensual_pct
    FROM (SELECT *, lag(precio_promedio) OVER (PARTITION BY producto_id ORDER BY anio, mes) AS antes FROM por_id)
    WHERE antes IS NOT NULL""",
)
oracle(
    "variation_daily", "por_dia",
    """SELECT producto_id, producto_nombre, fecha, precio_promedio,
    (precio_promedio - antes) / antes * 100 AS variacion_diaria_pct
    FROM (SELECT *, lag(precio_promedio) OVER (PARTITION BY producto_id ORDER BY fecha) AS antes FROM por_dia)
    WHERE antes IS NOT NULL""",
)
oracle(
    "price_extremes_with_store", "por_id tienda",
    """, visto AS (SELECT producto_id, anio, mes, precio, nombre,
    row_number() OVER (PARTITION BY producto_id, anio, mes ORDER BY precio, nombre) AS abajo,
    row_number() OVER (PARTITION BY producto_id, anio, mes ORDER BY precio DESC, nombre) AS arriba
    FROM obs JOIN tienda USING (establecimiento_id))
    SELECT i.producto_id, i.producto_nombre, i.anio, i.mes, i.precio_minimo, a.nombre AS establecimiento_mas_barato,
    i.precio_maximo, b.nombre AS establecimiento_mas_caro, i.precio_promedio FROM por_id i
    JOIN visto a ON a.producto_id = i.producto_id AND a.anio = i.anio AND a.mes = i.mes AND a.abajo = 1
    JOIN visto b ON b.producto_id = i.producto_id AND b.anio = i.anio AND b.mes = i.mes AND b.arriba = 1""",
)
oracle(
    "star_category_chain_month", "obs prod tienda",
    f"""SELECT anio, mes, categoria, cadena_normalizada, {EXACT_MEAN} AS precio_promedio,
    count(*) AS cantidad_observaciones, min(precio) AS precio_min, max(precio) AS precio_max
    FROM obs JOIN prod USING (producto_id) JOIN tienda USING (establecimiento_id) GROUP BY ALL""",
)
oracle(
    "star_region_category_month", "obs prod lugar",
    f"""SELECT departamento, categoria, mes, {EXACT_MEAN} AS precio_promedio, count(*) AS total_observaciones
    FROM obs JOIN prod USING (producto_id) JOIN lugar USING (establecimiento_id)
    WHERE anio >= 1998 GROUP BY departamento, categoria, mes""",
)
oracle("basket_cost_sum", "canasta", "SELECT * FROM canasta")
oracle(
    "basket_cost_variation", "canasta",
    """SELECT supermercado, anio, mes, costo_canasta, costo_anterior,
    (costo_canasta - costo_anterior) / costo_anterior * 100 AS variacion_pct
    FROM (SELECT *, lag(costo_canasta) OVER (PARTITION BY supermercado ORDER BY anio, mes) AS costo_anterior
    FROM canasta) WHERE costo_anterior IS NOT NULL""",
)
oracle("store_ranking_sum", "orden", "SELECT * FROM orden")
oracle(
    "basket_cost_avg", "canasta_media",
    """SELECT establecimiento_id, establecimiento_nombre, anio, mes, round(costo, 6) AS costo_total_canasta,
    num_productos_canasta FROM canasta_media""",
)
oracle(
    "store_ranking_avg", "canasta_media",
    """SELECT CAST(row_number() OVER (PARTITION BY anio, mes
    ORDER BY costo, establecimiento_nombre, establecimiento_id) AS BIGINT) AS ranking,
    establecimiento_id, establecimiento_nombre, anio, mes,
    anio || '-' || lpad(CAST(mes AS VARCHAR), 2, '0') AS anio_mes, round(costo, 6) AS costo_total_canasta,
    num_productos_canasta FROM canasta_media""",
)

# --- quality

MODEL["hechos"] = """SELECT CAST(strftime(fecha, '%Y%m%d') AS INT) AS fecha_id, producto_id, establecimiento_id,
    establecimiento_id AS ubicacion_id, precio, oferta, fecha FROM obs"""
MODEL["sitio"] = "SELECT *, establecimiento_id AS ubicacion_id FROM lugar"
USES["hechos"] = ["obs"]
USES["sitio"] = ["lugar"]
STAR = "hechos tiempo prod tienda sitio"
SOURCE = {
    "fact_precios": "hechos", "dim_tiempo": "tiempo", "dim_producto": "prod",
    "dim_establecimiento": "tienda", "dim_ubicacion": "sitio",
}
CRITICAL = {
    "fact_precios": ["fecha_id", "producto_id", "establecimiento_id", "ubicacion_id", "precio"],
    "dim_tiempo": ["fecha_id", "fecha", "anio", "mes", "dia"],
    "dim_producto": ["producto_id", "nombre"],
    "dim_establecimiento": ["establecimiento_id", "nombre"],
    "dim_ubicacion": ["ubicacion_id", "establecimiento_id"],
}
NULLS = [
    check(t, "null_values", c, f"{c} IS NULL", SOURCE[t]) for t, columns in CRITICAL.items() for c in columns
]
PARENT_KEY = {
    "dim_tiempo": "fecha_id", "dim_producto": "producto_id",
    "dim_establecimiento": "establecimiento_id", "dim_ubicacion": "ubicacion_id",
}
KEYS = [
    check(
        f"fact_precios -> {t}", "referential_integrity", k,
        f"NOT EXISTS (SELECT 1 FROM {SOURCE[t]} d WHERE d.{k} = h.{k})", "hechos h",
    )
    for t, k in PARENT_KEY.items()
]
COPIES = [surplus(t, k, SOURCE[t], k) for t, k in PARENT_KEY.items()]
RANGES = [
    check("fact_precios", "range_validation", "precio", "NOT coalesce(precio >= 0.01, FALSE)", "hechos"),
    check("dim_tiempo", "range_validation", "anio", "NOT coalesce(anio BETWEEN 2020 AND 2030, FALSE)", "tiempo"),
    check("dim_tiempo", "range_validation", "mes", "NOT coalesce(mes BETWEEN 1 AND 12, FALSE)", "tiempo"),
    check("dim_tiempo", "range_validation", "dia", "NOT coalesce(dia BETWEEN 1 AND 31, FALSE)", "tiempo"),
]
DOMAINS = [
    check("fact_precios", "consistency", "oferta", "NOT coalesce(oferta IN (0, 1), FALSE)", "hechos"),
    check("dim_tiempo", "consistency", "dia_semana", "NOT coalesce(dia_semana BETWEEN 1 AND 7, FALSE)", "tiempo"),
    check("dim_tiempo", "consistency", "trimestre", "NOT coalesce(trimestre BETWEEN 1 AND 4, FALSE)", "tiempo"),
]
LATER = check(
    "dim_tiempo", "range_validation", "anio", "NOT coalesce(anio BETWEEN 1995 AND 2001, FALSE)", "tiempo"
)
LINES = surplus("lineas", "l_orderkey,l_linenumber", "lineitem", "l_orderkey, l_linenumber")


def union(parts: list[str]) -> str:
    return " UNION ALL ".join(parts)


oracle("dq_nulls", STAR, union(NULLS))
WRONG_PARENT = check(
    "lineas -> dim_establecimiento", "referential_integrity", "l_partkey",
    "NOT EXISTS (SELECT 1 FROM supplier s WHERE s.s_suppkey = l.l_partkey)", "lineitem l",
)
SHORT_CALENDAR = check(
    "fact_precios -> calendario", "referential_integrity", "fecha_id",
    "NOT EXISTS (SELECT 1 FROM tiempo d WHERE d.fecha_id = h.fecha_id AND d.anio < 1998)", "hechos h",
)
oracle("dq_fk", STAR, union([*KEYS, WRONG_PARENT, SHORT_CALENDAR]))
oracle("dq_duplicates", STAR, union([*COPIES, LINES]))
oracle("dq_range", STAR, union([*RANGES, LATER]))
oracle("dq_domain", STAR, union(DOMAINS))
REPORT = f"""SELECT tabla AS "table", check_type, bool_and(passed) AS passed,
    tabla || CASE WHEN check_type = 'null_values' THEN '' ELSE '.' || min(columna) END || ' ' || check_type || ': '
    || CAST(CAST(sum(failed_rows) AS BIGINT) AS VARCHAR) || ' of ' || CAST(max(total_rows) AS VARCHAR) AS message
    FROM ({union([*NULLS, *KEYS, *COPIES, *RANGES, *DOMAINS])})
    GROUP BY tabla, check_type, CASE WHEN check_type = 'null_values' THEN '' ELSE columna END"""
oracle("dq_report", STAR, REPORT)
oracle(
    "dq_summary", STAR,
    f"""SELECT count(*) AS total_checks, count(*) FILTER (WHERE passed) AS passed,
    count(*) FILTER (WHERE NOT passed) AS failed,
    CAST(count(*) FILTER (WHERE passed) AS DOUBLE) / count(*) * 100 AS pass_rate, bool_and(passed) AS all_passed
    FROM ({REPORT})""",
)
RAW_COLUMNS = {
    "precios": ("crudo", ["fecha", "producto_id", "establecimiento_id", "precio", "oferta"]),
    "productos": (
        "crudo_prod",
        ["producto_id", "producto", "marca", "especificacion", "nombre", "categoria", "subcategoria"],
    ),
    "establecimientos": (
        "crudo_tienda",
        ["establecimiento_id", "razon_social", "nombre", "direccion", "ciudad", "depto", "cadena", "barrio"],
    ),
}
oracle(
    "null_profile", "crudo crudo_prod crudo_tienda",
    union([
        f"""SELECT '{t}' AS tabla, '{c}' AS columna, count(*) AS total_rows, count(*) - count({c}) AS nulos,
        CAST(count(*) - count({c}) AS DOUBLE) / count(*) * 100 AS porcentaje FROM {source}"""
        for t, (source, columns) in RAW_COLUMNS.items()
        for c in columns
    ]),
)
oracle(
    "dup_rows", "crudo",
    f"""SELECT tabla, total_rows, total_rows - failed_rows AS unicos, failed_rows AS duplicados,
    failed_pct AS porcentaje FROM ({surplus("precios", "", "crudo", "*")} UNION ALL {LINES})
    UNION ALL SELECT 'productos', 2 * count(*), count(*), count(*), 50.0 FROM part
    UNION ALL SELECT 'establecimientos', 2 * count(*), count(*), count(*), 50.0 FROM supplier""",
)
oracle(
    "orphan_keys", "crudo",
    """SELECT DISTINCT 'productos' AS catalogo, producto_id AS clave FROM crudo
    WHERE producto_id NOT IN (SELECT CAST(p_partkey AS VARCHAR) FROM part)
    UNION ALL SELECT DISTINCT 'establecimientos', establecimiento_id FROM crudo
    WHERE establecimiento_id NOT IN (SELECT CAST(s_suppkey AS VARCHAR) FROM supplier)""",
)

# --- exploration

oracle(
    "daily_price_profile", "obs",
    f"""SELECT fecha, count(*) AS cantidad_registros, {EXACT_MEAN} AS precio_promedio, min(precio) AS precio_minimo,
    max(precio) AS precio_maximo FROM obs GROUP BY fecha""",
)
oracle(
    "price_stats_by_category", "obs prod",
    f"""SELECT categoria, count(*) AS cantidad_registros, {EXACT_MEAN} AS precio_promedio,
    min(precio) AS precio_minimo, max(precio) AS precio_maximo, round(stddev_samp(precio), 4) AS desviacion_std
    FROM obs JOIN prod USING (producto_id) GROUP BY categoria""",
)


def frequency(key: str, uses: str, columns: str, limit: int | None = None) -> None:
    nulls_first = ", ".join(f"{c} NULLS FIRST" for c in columns.split(", "))
    tail = "" if limit is None else f" ORDER BY cantidad DESC, {nulls_first} LIMIT {limit}"
    oracle(key, uses, f"SELECT {columns}, count(*) AS cantidad FROM {uses} GROUP BY {columns}{tail}")


frequency("freq_offer", "obs", "oferta")
frequency("freq_category", "prod", "categoria", 50)
frequency("freq_subcategory", "prod", "subcategoria", 30)
frequency("freq_brand", "prod", "marca", 20)
frequency("freq_region", "lugar", "departamento", 25)
frequency("freq_city", "lugar", "ciudad", 20)
frequency("freq_chain", "tienda", "cadena", 15)
frequency("freq_chain_normalized", "tienda", "cadena, cadena_normalizada", 20)
frequency("coverage_quarter", "tiempo", "anio, trimestre")
frequency("coverage_weekday", "tiempo", "dia_semana, nombre_dia")
frequency("coverage_date", "hechos", "fecha_id")

oracle(
    "table_counts", STAR,
    union([f"SELECT '{t}' AS tabla, count(*) AS filas FROM {source}" for t, source in SOURCE.items()]),
)
TYPES = {
    "fact_precios": "fecha_id int, producto_id int, establecimiento_id int, ubicacion_id int, precio double,"
    " oferta int, fecha date",
    "dim_tiempo": "fecha date, fecha_id int, anio int, mes int, dia int, trimestre int, dia_semana int,"
    " semana_anio int, nombre_mes string, nombre_dia string",
    "dim_producto": "producto_id int, nombre_completo string, nombre string, categoria string,"
    " subcategoria string, marca string, especificacion string",
    "dim_establecimiento": "establecimiento_id int, nombre string, razon_social string, cadena string,"
    " cadena_normalizada string",
    "dim_ubicacion": "establecimiento_id int, departamento string, ciudad string, direccion string,"
    " barrio string, ubicacion_id int",
}
SAME_AS = {"especificacion": "subcategoria", "razon_social": "nombre"}
oracle(
    "schema_profile", STAR,
    union([
        f"""SELECT '{t}' AS tabla, {i} AS posicion, '{field.split()[0]}' AS columna, '{field.split()[1]}' AS tipo,
        count({SAME_AS.get(field.split()[0], field.split()[0])}) AS con_valor FROM {SOURCE[t]}"""
        for t, fields in TYPES.items()
        for i, field in enumerate(fields.split(", "), 1)
    ]),
)
COUNTED = [
    ("dim_producto", "prod", ["categoria", "subcategoria", "marca"]),
    ("dim_establecimiento", "tienda", ["cadena", "cadena_normalizada"]),
    ("dim_ubicacion", "lugar", ["departamento", "ciudad", "barrio"]),
    ("precio_promedio", "por_nombre", ["producto", "anio"]),
    ("canasta_basica", "canasta", ["supermercado", "anio"]),
]
oracle(
    "cardinality_profile", "prod tienda lugar por_nombre canasta",
    union([
        f"""SELECT '{t}' AS tabla, '{c}' AS columna, count(DISTINCT {c}) AS distintos,
        (SELECT count(*) FROM (SELECT DISTINCT {c} FROM {source})) AS distintos_con_nulo,
        {"min(anio)" if c == "anio" else "CAST(NULL AS INT)"} AS minimo,
        {"max(anio)" if c == "anio" else "CAST(NULL AS INT)"} AS maximo FROM {source}"""
        for t, source, columns in COUNTED
        for c in columns
    ]),
)


def described(key: str, uses: str, column: str, digits: int) -> None:
    figures = {
        "count": "CAST(count(x) AS DOUBLE)", "mean": "avg(x)", "std": "stddev_samp(x)", "min": "min(x)",
        "25%": "quantile_cont(x, 0.25)", "50%": "quantile_cont(x, 0.5)", "75%": "quantile_cont(x, 0.75)",
        "max": "max(x)",
    }
    rows = [
        f"SELECT '{k}' AS estadistico, round({v}, {digits}) AS valor FROM (SELECT {column} AS x FROM {uses})"
        for k, v in figures.items()
    ]
    oracle(key, uses, union(rows))


described("describe_price", "obs", "precio", 4)
described("describe_variation", "variacion", "variacion_pct", 6)
described("describe_dispersion", "dispersion", "indice_dispersion", 6)


def histogram(key: str, uses: str, column: str, bins: int) -> None:
    oracle(
        key, uses,
        f""", e AS (SELECT min({column}) AS lo, max({column}) AS hi FROM {uses}),
        b AS (SELECT CAST(least(floor(({column} - lo) / ((hi - lo) / {bins})), {bins - 1}) AS INT) AS bin
        FROM {uses}, e),
        todos AS (SELECT CAST(unnest(range(0, {bins})) AS INT) AS bin)
        SELECT t.bin, lo + t.bin * ((hi - lo) / {bins}) AS desde, count(b.bin) AS cantidad
        FROM todos t CROSS JOIN e LEFT JOIN b ON b.bin = t.bin GROUP BY t.bin, e.lo, e.hi""",
    )


histogram("hist_price", "obs", "precio", 100)
histogram("hist_variation", "var_corta", "variacion_pct", 50)
histogram("hist_dispersion", "disp_corta", "indice_dispersion", 50)


def box(key: str, uses: str, column: str, by: str) -> None:
    group, pick, match = (f"{by},", f"q.{by},", f"q.{by} = r.{by}") if by else ("", "", "TRUE")
    tail = f"GROUP BY {by}" if by else ""
    oracle(
        key, uses,
        f""", q AS (SELECT {group} count({column}) AS n, quantile_cont({column}, 0.25) AS a,
        quantile_cont({column}, 0.5) AS m, quantile_cont({column}, 0.75) AS z FROM {uses} {tail}),
        r AS (SELECT {group} {column} AS x FROM {uses})
        SELECT {pick} n AS cantidad, round(a, 6) AS q1, round(m, 6) AS mediana, round(z, 6) AS q3,
        min(x) FILTER (WHERE x BETWEEN a - (z - a) * 1.5 AND z + (z - a) * 1.5) AS bigote_inferior,
        max(x) FILTER (WHERE x BETWEEN a - (z - a) * 1.5 AND z + (z - a) * 1.5) AS bigote_superior,
        count(*) FILTER (WHERE x < a - (z - a) * 1.5 OR x > z + (z - a) * 1.5) AS atipicos
        FROM r JOIN q ON {match} GROUP BY {pick} n, a, m, z""",
    )


box("box_price", "obs", "precio", "")
box("box_variation_year", "var_corta", "variacion_pct", "anio")
box("box_basket_store", "canasta_lider", "costo_canasta", "supermercado")

# --- dashboard

oracle("variation_trimmed", "var_corta", "SELECT * FROM var_corta")
oracle("dispersion_trimmed", "disp_corta", "SELECT * FROM disp_corta")
oracle("integrated_dispersion_variation", "integrado", "SELECT * FROM integrado")
oracle("integrated_join", "integrado", "SELECT * FROM integrado")
oracle("integrated_filtered", "integrado_corto", "SELECT * FROM integrado_corto")
oracle(
    "top10_products_series", "por_nombre",
    """SELECT make_date(anio, mes, 1) AS fecha, producto, precio_promedio FROM por_nombre WHERE producto IN
    (SELECT producto FROM por_nombre GROUP BY producto ORDER BY count(*) DESC, producto LIMIT 10)""",
)
oracle(
    "top8_stores_series", "canasta_lider",
    "SELECT make_date(anio, mes, 1) AS fecha, supermercado, costo_canasta FROM canasta_lider",
)
oracle(
    "avg_price_yearly_stats", "por_nombre",
    """SELECT anio, round(avg(precio_promedio), 6) AS mean, round(quantile_cont(precio_promedio, 0.5), 6) AS median,
    min(precio_promedio) AS min, max(precio_promedio) AS max FROM por_nombre GROUP BY anio""",
)
oracle(
    "basket_store_stats", "canasta_lider",
    """SELECT supermercado, round(avg(costo_canasta), 6) AS mean, round(quantile_cont(costo_canasta, 0.5), 6) AS median,
    min(costo_canasta) AS min, max(costo_canasta) AS max, round(stddev_samp(costo_canasta), 6) AS std
    FROM canasta_lider GROUP BY supermercado""",
)
FOUR = ("precio_promedio", "variacion_pct", "indice_dispersion", "costo_canasta")
oracle(
    "dashboard_monthly", "meses",
    "SELECT anio, mes, fecha, " + ", ".join(f"round({c}, 7) AS {c}" for c in FOUR) + " FROM meses",
)
oracle(
    "dashboard_trend", "meses",
    union([
        f"""SELECT '{c}' AS metrica, round(avg({c}), 6) AS promedio,
        CASE WHEN max_by({c}, fecha) FILTER (WHERE {c} IS NOT NULL) > min_by({c}, fecha) FILTER (WHERE {c} IS NOT NULL)
        THEN '↑' ELSE '↓' END AS tendencia FROM meses"""
        for c in FOUR
    ]),
)
oracle(
    "dispersion_trimmed_monthly", "disp_corta",
    """SELECT make_date(anio, mes, 1) AS fecha, round(avg(indice_dispersion), 6) AS indice_dispersion
    FROM disp_corta GROUP BY anio, mes""",
)


def leaders(key: str, uses: str, statistic: str, direction: str) -> None:
    oracle(
        key, uses,
        f"""SELECT producto, round(v, 6) AS valor FROM (SELECT producto, {statistic} AS v FROM {uses}
        GROUP BY producto) WHERE v IS NOT NULL ORDER BY v {direction}, producto LIMIT 5""",
    )


leaders("top_expensive", "por_nombre", "avg(precio_promedio)", "DESC")
leaders("top_cheap", "por_nombre", "avg(precio_promedio)", "ASC")
leaders("top_volatile", "variacion", "stddev_samp(variacion_pct)", "DESC")
leaders("top_dispersed", "dispersion", "avg(indice_dispersion)", "DESC")


def extremes(key: str, uses: str, columns: str, value: str, direction: str, k: int) -> None:
    oracle(
        key, uses, f"SELECT {columns} FROM {uses} ORDER BY {value} {direction}, producto, anio, mes LIMIT {k}"
    )


extremes("top_price_drops", "variacion", "producto, anio, mes, variacion_pct", "variacion_pct", "ASC", 5)
extremes("top_price_rises", "variacion", "producto, anio, mes, variacion_pct", "variacion_pct", "DESC", 5)
extremes(
    "top_price_ranges", "por_nombre",
    """producto, anio, mes, precio_minimo, precio_maximo, precio_maximo - precio_minimo AS rango_precio,
    substr(producto, 1, 20) || '... ' || anio || '-' || lpad(CAST(mes AS VARCHAR), 2, '0') AS etiqueta""",
    "rango_precio", "DESC", 15,
)
extremes(
    "top_dispersion_rows", "dispersion", "producto, anio, mes, indice_dispersion", "indice_dispersion", "DESC", 10
)
oracle(
    "ranking_latest_top15", "ultimo",
    "SELECT ranking, supermercado, costo_canasta FROM ultimo ORDER BY ranking LIMIT 15",
)
oracle(
    "ranking_latest_bottom5", "ultimo",
    "SELECT ranking, supermercado, costo_canasta FROM ultimo ORDER BY ranking DESC LIMIT 5",
)
CORRELATED = ("indice_dispersion", "variacion_pct", "precio_promedio")
oracle(
    "metric_correlation", "integrado_corto",
    union([
        f"""SELECT '{a}' AS fila, '{b}' AS columna, round(corr({a}, {b}), 6) AS correlacion FROM integrado_corto"""
        for a in CORRELATED
        for b in CORRELATED
    ]),
)
oracle(
    "density_dispersion_variation", "integrado_corto",
    """, e AS (SELECT min(indice_dispersion) AS a, max(indice_dispersion) AS b, min(variacion_pct) AS c,
    max(variacion_pct) AS d FROM integrado_corto)
    SELECT CAST(least(floor((indice_dispersion - a) / ((b - a) / 30)), 29) AS INT) AS bin_x,
    CAST(least(floor((variacion_pct - c) / ((d - c) / 30)), 29) AS INT) AS bin_y, count(*) AS cantidad
    FROM integrado_corto, e GROUP BY 1, 2""",
)
oracle(
    "dispersion_bands", "dispersion",
    """SELECT CASE WHEN indice_dispersion < 0.3 THEN 'baja' WHEN indice_dispersion <= 1.0 THEN 'media' ELSE 'alta' END
    AS banda, count(*) AS cantidad FROM dispersion GROUP BY 1""",
)
oracle(
    "exec_summary", "dispersion variacion ultimo",
    """SELECT p.*, v.*, d.*, c.*, b.supermercado AS mas_economico, k.supermercado AS mas_caro,
    round(k.costo_canasta - b.costo_canasta, 6) AS diferencia_precio,
    round((k.costo_canasta / b.costo_canasta - 1) * 100, 6) AS diferencia_pct
    FROM (SELECT count(DISTINCT producto) AS productos_analizados,
    round(avg(precio_promedio), 6) AS precio_promedio_general, min(precio_promedio) AS precio_minimo,
    max(precio_promedio) AS precio_maximo FROM por_nombre) p,
    (SELECT round(avg(variacion_pct), 6) AS variacion_promedio, max(variacion_pct) AS mayor_aumento,
    min(variacion_pct) AS mayor_caida FROM variacion) v,
    (SELECT round(avg(indice_dispersion), 6) AS dispersion_promedio,
    round(quantile_cont(indice_dispersion, 0.5), 6) AS dispersion_mediana,
    count(*) FILTER (WHERE indice_dispersion > 1.0) AS registros_alta_dispersion FROM dispersion) d,
    (SELECT count(DISTINCT supermercado) AS supermercados_analizados, round(avg(costo_canasta), 6) AS costo_promedio,
    min(costo_canasta) AS costo_minimo, max(costo_canasta) AS costo_maximo,
    round(max(costo_canasta) - min(costo_canasta), 6) AS costo_diferencia FROM canasta) c,
    (SELECT * FROM ultimo ORDER BY ranking LIMIT 1) b, (SELECT * FROM ultimo ORDER BY ranking DESC LIMIT 1) k""",
)

oracle(
    "approx_quartiles_price", "obs",
    "SELECT quantile_disc(precio, 0.25) AS q25, quantile_disc(precio, 0.5) AS q50, quantile_disc(precio, 0.75) AS q75 FROM obs",
)
oracle(
    "price_sample", "",
    """SELECT l_orderkey, l_linenumber, l_extendedprice AS precio FROM lineitem
    WHERE ('0x' || substr(md5(CAST(l_orderkey AS VARCHAR) || '-' || CAST(l_linenumber AS VARCHAR)), 1, 8))::BIGINT < 429496729""",
)
oracle(
    "basket_cost_avg_category", "obs prod tienda",
    """, articulo AS (SELECT establecimiento_id, t.nombre AS establecimiento_nombre, producto_id, anio, mes,
    CAST(sum(CAST(round(precio * 100) AS BIGINT)) AS DOUBLE) / 100 / count(*) AS precio_promedio
    FROM obs JOIN prod p USING (producto_id) JOIN tienda t USING (establecimiento_id)
    WHERE p.categoria IN ('ECONOMY', 'PROMO') GROUP BY ALL)
    SELECT establecimiento_id, establecimiento_nombre, anio, mes,
    round(sum(precio_promedio), 6) AS costo_total_canasta, count(producto_id) AS num_productos_canasta
    FROM articulo GROUP BY ALL""",
)
oracle(
    "display_rounded_quantities", "",
    "SELECT l_orderkey, l_linenumber, round_even(l_quantity / 8, 2) AS octavo FROM lineitem",
)
