"""Fixed dimensions of the domain and the frames made of them. All are a few rows, so they may be broadcast."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

# ---- Fixed values -----------------------------------------------------------------------------------------------
# Label -> (class, weight, confidence, rationale), by exact label.
TAXONOMY = {
    "DELITOS LEY DE DROGAS": ("base_19913", 1.0, "high", "Familia asociada a Ley 20.000, expresamente incorporada por el artículo 27."),
    "DELITOS FUNCIONARIOS": ("proxy_19913", 0.95, "medium", "Categoría amplia; contiene delitos potencialmente comprendidos como delitos base, pero requiere código específico."),
    "DELITOS ECONÓMICOS Y TRIBUTARIOS": ("proxy_19913", 0.9, "medium", "Categoría amplia con relevancia AML; no todos sus delitos son necesariamente base del artículo 27."),
    "DELITOS CONTRA LA FE PÚBLICA": ("proxy_19913", 0.72, "medium", "Señal económica/documental; exige desagregación por código."),
    "DELITOS CONTRA LEYES DE PROPIEDAD INTELECTUAL E INDUSTRIAL": ("proxy_19913", 0.7, "medium", "Algunos ilícitos están contemplados por la normativa LA; validar por tipo penal."),
    "DELITOS DE LEYES ESPECIALES": ("proxy_19913", 0.6, "low", "Categoría amplia que requiere desagregación por tipo penal."),
    "HOMICIDIOS": ("contexto_general", 0.0, "high", "Contexto de violencia. No se pondera como delito base ni indicio LA/FT."),
    "DELITOS CONTRA LA LIBERTAD E INTIMIDAD DE LAS PERSONAS": ("proxy_19913", 0.35, "low", "Puede contener secuestro, que sí está citado en artículo 27, pero la categoría agregada exige desagregación."),
    "ROBOS": ("contexto_general", 0.0, "high", "Contexto patrimonial; no se pondera automáticamente como AML."),
    "ROBOS NO VIOLENTOS": ("contexto_general", 0.0, "high", "Contexto delictual general."),
    "HURTOS": ("contexto_general", 0.0, "high", "Contexto delictual general."),
    "LESIONES": ("contexto_general", 0.0, "high", "Contexto de violencia general."),
    "DELITOS SEXUALES": ("contexto_general", 0.0, "medium", "La categoría agregada no debe usarse como proxy LA/FT; algunos tipos específicos sí requieren mapeo por código."),
    "DELITOS LEY DE TRÁNSITO": ("contexto_general", 0.0, "high", "Sin ponderación AML agregada."),
    "CUASIDELITOS": ("contexto_general", 0.0, "high", "Sin ponderación AML agregada."),
}
TAXONOMY_DEFAULT = ("contexto_general", 0.0, "low", "Sin mapeo AML específico.")
TAXONOMY_VERSION = "0.3.0"

# Catalogue key -> (class, eligible, weight, confidence, basis).
CATALOG = {
    "family:4": ("predicate_family_direct", True, 1.0, "high", "Familia CEAD asociada a la Ley 20.000; el artículo 27 de la Ley 19.913 incorpora los delitos contemplados en esa ley. Para decisiones jurídicas finas se privilegia grupo/subgrupo."),
    "group:401": ("predicate_direct", True, 1.0, "high", "Crímenes y simples delitos de la Ley 20.000."),
    "subgroup:40101": ("predicate_direct", True, 1.0, "high", "Tráfico de sustancias · Ley 20.000."),
    "subgroup:40102": ("predicate_direct", True, 1.0, "high", "Microtráfico de sustancias · Ley 20.000."),
    "subgroup:40103": ("predicate_direct", True, 1.0, "high", "Elaboración o producción de sustancias · Ley 20.000."),
    "subgroup:40104": ("predicate_candidate", False, 0.0, "medium", "Categoría residual de infracciones a Ley 20.000; requiere tipo penal antes de ponderar."),
    "family:5": ("predicate_candidate", False, 0.0, "high", "El artículo 27 remite específicamente al artículo 10 de la Ley 17.798; la familia CEAD es más amplia."),
    "group:501": ("predicate_candidate", False, 0.0, "high", "Debe distinguirse la conducta exacta del artículo 10 de Ley 17.798."),
    "subgroup:50101": ("context_only", False, 0.0, "high", "Disparo injustificado no se equipara automáticamente al artículo 10 de Ley 17.798."),
    "subgroup:50102": ("predicate_candidate", False, 0.0, "medium", "Porte/posesión es más amplio que las conductas del artículo 10; requiere código penal específico."),
    "subgroup:50103": ("predicate_candidate", False, 0.0, "low", "Residual de Ley de Armas; requiere código específico."),
    "group:101": ("context_only", False, 0.0, "high", "Homicidios y femicidios se excluyen del score AML/LAFT."),
    "subgroup:10101": ("context_only", False, 0.0, "high", "Homicidio no se utiliza por sí solo como delito base o indicio LA/FT."),
    "subgroup:10102": ("context_only", False, 0.0, "high", "Femicidio no se utiliza por sí solo como delito base o indicio LA/FT."),
    "group:102": ("predicate_candidate", False, 0.0, "medium", "El artículo 27 contempla tipos sexuales específicos, no toda la familia CEAD."),
}
CATALOG_DEFAULT = ("context_or_unresolved", False, 0.0, "low", "Sin homologación jurídica suficientemente precisa para ponderación automática.")

# Normalised label -> catalogue key.
LABEL_KEYS = {
    "delitos asociados a drogas": "family:4",
    "crimenes y simples delitos ley de drogas": "group:401",
    "trafico de sustancias": "subgroup:40101",
    "microtrafico de sustancias": "subgroup:40102",
    "elaboracion o produccion de sustancias": "subgroup:40103",
    "otras infracciones a la ley de drogas": "subgroup:40104",
    "homicidios": "subgroup:10101",
    "femicidios": "subgroup:10102",
    "homicidios y femicidios": "group:101",
    "delitos asociados a armas": "family:5",
    "crimenes y simples delitos ley de armas": "group:501",
    "disparo injustificado": "subgroup:50101",
    "porte posesion de armas o explosivos": "subgroup:50102",
    "otras infracciones a la ley de armas": "subgroup:50103",
    "violaciones y delitos sexuales": "group:102",
    "violaciones y otros delitos sexuales": "group:102",
}
HOMICIDE_LABELS = ("homicidios", "femicidios", "homicidios y femicidios")
DRUG_FAMILY_LABEL, DRUG_GROUP_LABEL = "delitos asociados a drogas", "crimenes y simples delitos ley de drogas"

# Communal family -> (relation, eligible, weight, confidence).
FAMILIES = {
    "delitos_asociados_drogas": ("direct_family_ley_20000", True, 1.0, "high"),
    "delitos_asociados_armas": ("partial_requires_subgroup_or_code", False, 0.0, "high"),
    "delitos_contra_vida_integridad": ("mixed_context", False, 0.0, "high"),
    "robos_violentos": ("context_only", False, 0.0, "high"),
    "violencia_intrafamiliar": ("context_only", False, 0.0, "high"),
    "delitos_propiedad_no_violentos": ("context_or_market_signal", False, 0.0, "high"),
    "incivilidades": ("context_only", False, 0.0, "high"),
    "otros_delitos_faltas": ("mixed_unresolved", False, 0.0, "low"),
    "homicidios": ("context_only", False, 0.0, "high"),
}

# Legal codes: (class, confidence, basis) -> codes; ranges (low, high, class, confidence, basis); codes no longer in force.
LEGAL_CODES = {
    ("laundering_offense", "high", "Lavado de dinero persona natural, art. 27 Ley 19.913"): (12133,),
    ("laundering_offense", "high", "Lavado de dinero persona jurídica, art. 27 Ley 19.913"): (12174,),
    ("predicate_direct", "high", "Tráfico de armas art. 10 Ley 17.798, citado por art. 27"): (10010,),
    ("predicate_direct", "high", "Ordenanza de Aduanas art. 168, citado por art. 27"): (12051,),
    ("predicate_direct", "high", "Ordenanza de Aduanas art. 169, citado por art. 27"): (12052,),
    ("predicate_direct", "high", "Ordenanza de Aduanas art. 168 bis, citado por art. 27"): (12056,),
    ("predicate_direct", "high", "Código Tributario art. 97 N°4 inciso tercero, citado por art. 27"): (5004,),
    ("predicate_direct", "high", "Ley de Bosques art. 21, citado por art. 27"): (12137,),
    ("predicate_direct", "high", "Ley 19.473 art. 31, citado por art. 27"): (12138,),
    ("predicate_direct", "high", "Ley 20.962 art. 11, citado por art. 27"): (12055,),
    ("predicate_direct", "high", "Tráfico de migrantes art. 411 bis CP, citado por art. 27"): (721,),
    ("predicate_direct", "high", "Tráfico de migrantes por funcionario art. 411 bis CP"): (722,),
    ("predicate_direct", "high", "Trata de personas art. 411 quáter CP"): (723,),
    ("predicate_direct", "high", "Trata de menores art. 411 quáter CP"): (724,),
    ("predicate_direct", "high", "Asociación para tráfico/trata art. 411 quinquies CP"): (725,),
    ("predicate_direct", "high", "Trata para trabajos forzados art. 411 quáter CP"): (727,),
    ("predicate_direct", "high", "Secuestro art. 141 CP, citado por art. 27"): (235, 236, 237, 248, 249,),
    ("predicate_direct", "high", "Fraude de subvenciones art. 470 N°8 CP, citado por art. 27"): (845,),
    ("predicate_direct", "high", "Apropiación indebida art. 470 N°1 CP, citado por art. 27"): (856,),
    ("predicate_direct", "high", "Administración desleal art. 470 N°11 CP, citado por art. 27"): (863,),
    ("predicate_direct", "high", "Administración desleal persona jurídica art. 470 N°11 CP"): (865,),
    ("predicate_direct", "high", "Apropiación indebida persona jurídica art. 470 N°1 CP"): (866,),
    ("organized_crime_signal", "high", "Extorsión art. 438 CP; señal de crimen organizado, no se etiqueta automáticamente como delito base"): (806,),
    ("organized_crime_signal", "medium", "Receptación art. 456 bis A CP"): (812,),
    ("organized_crime_signal", "medium", "Receptación de vehículos; señal de mercado criminal"): (869,),
    ("predicate_candidate", "medium", "Receptación aduanera art. 182; requiere validación jurídica específica frente al art. 27"): (12053,),
    ("predicate_candidate", "medium", "Art. 81 Ley 17.336; art. 27 refiere específicamente a su inciso segundo"): (9003,),
    ("predicate_candidate", "medium", "Código agrupa varios artículos de pesca, solo algunos están expresamente citados por art. 27"): (12023,),
    ("predicate_direct", "high", "Secuestro art. 141 incisos 1 y 2 CP, expresamente citado por art. 27 Ley 19.913"): (202,),
    ("predicate_direct", "high", "Sustracción de menores art. 142 CP, expresamente citado por art. 27 Ley 19.913"): (203,),
    ("predicate_direct", "high", "Explotación sexual de menor art. 367 CP, expresamente citado por art. 27 Ley 19.913"): (610,),
    ("predicate_direct", "high", "Transmisión de imágenes art. 367 septies CP, expresamente citado por art. 27 Ley 19.913"): (647,),
    ("predicate_direct", "high", "Comercialización material pornográfico infantil art. 367 quáter CP, expresamente citado por art. 27"): (648,),
    ("predicate_direct", "high", "Producción material pornográfico infantil art. 367 quáter CP, expresamente citado por art. 27"): (649,),
    ("predicate_direct", "high", "Adquisición/almacenamiento material pornográfico infantil art. 367 quáter CP, expresamente citado por art. 27"): (650,),
    ("predicate_direct", "high", "Art. 64 Ley 18.840 Banco Central, expresamente citado por art. 27"): (12031,),
    ("predicate_direct", "high", "Art. 59 Ley 18.840 Banco Central, expresamente citado por art. 27"): (12032,),
    ("predicate_direct", "high", "Delitos del Título XI Ley 18.045 Mercado de Valores, expresamente citado por art. 27"): (12135,),
    ("predicate_direct", "high", "Invasión del giro bancario art. 39, comprendido por art. 27 Ley 19.913"): (3003,),
    ("predicate_direct", "medium", "Conducta catalogada en art. 10 inc. 3 Ley 17.798; art. 27 cita el art. 10"): (10039,),
    ("predicate_direct", "high", "Delitos medioambientales dolosos arts. 305, 306, 307, 308 y 310 CP, expresamente citados por art. 27"): (551,),
    ("predicate_candidate", "medium", "Categoría agrupada de estafas y defraudaciones; art. 27 cubre solo artículos/hipótesis específicos y requiere desagregación"): (816,),
    ("organized_crime_signal", "high", "Asociación delictiva o criminal mediante persona jurídica art. 294 CP; señal de estructura criminal"): (542,),
    ("organized_crime_signal", "high", "Asociación ilícita/delictiva para simples delitos; señal de estructura criminal"): (552,),
    ("organized_crime_signal", "high", "Asociación ilícita/criminal para crímenes; señal de estructura criminal"): (553,),
    ("organized_crime_signal", "medium", "Receptación por persona jurídica; señal de mercado criminal, no delito base automático"): (864,),
    ("organized_crime_signal", "medium", "Robo de vehículo motorizado; señal de mercado criminal de vehículos"): (831,),
    ("organized_crime_signal", "medium", "Robo de vehículo con sorpresa, violencia o intimidación; señal de mercado criminal"): (867,),
    ("organized_crime_signal", "medium", "Robo de vehículo con elementos distractivos; señal de mercado criminal"): (868,),
}
LEGAL_RANGES = (
    (2004, 2011, "predicate_direct", "high", "Título I Ley 21.459, expresamente citado por art. 27"),
    (7001, 7099, "predicate_direct", "medium", "Delitos vigentes Ley 20.000; excluir códigos no vigentes mediante catálogo"),
)
LEGAL_REPEALED = (7030, 7035, 7036, 7098)
LEGAL_VERSION = "0.2.0"
LEGAL_REPEALED_CLASS = ("historical_nonvigent", "high", "Código marcado no vigente en catálogo")
LEGAL_DEFAULT = ("unmapped", "none", "Sin regla jurídica exacta en v0.2")
LEGAL_BASIS = {"law": "Ley 19.913", "article": "27", "version_date": "2026-05-30", "source": "https://www.bcn.cl/leychile/navegar?idNorma=219119&idParte=8649605"}
LEGAL_CATALOG = {"name": "Catálogo de Delitos - Codificación Penal a diciembre 2025", "published": "2026-02-10", "source": "https://www.fiscaliadechile.cl/sites/default/files/2026-02/Catalogo_de_delitos.pdf"}

# Layer -> (label, weight, fallback labels in order, component -> (weight, labels)).
LAYERS = {
    "predicate_direct": (0.55, ("crimenes y simples delitos ley de drogas", "delitos asociados a drogas"), {
        "drug_traffic": (0.333333, ("trafico de sustancias",)),
        "drug_microtraffic": (0.333333, ("microtrafico de sustancias",)),
        "drug_production": (0.333334, ("elaboracion o produccion de sustancias",)),
    }),
    "criminal_economy": (0.35, (), {
        "reception": (0.25, ("receptacion",)),
        "illegal_trade": (0.2, ("comercio ilegal",)),
        "vehicle_theft": (0.2, ("robo de vehiculo motorizado",)),
        "violent_vehicle_theft": (0.15, ("robo violento de vehiculo motorizado",)),
        "weapons_possession": (0.12, ("porte posesion de armas o explosivos",)),
        "cattle_theft": (0.08, ("abigeato",)),
    }),
    "criminogenic_context": (0.1, (), {
        "homicide": (0.25, ("homicidios y femicidios", "homicidios", "femicidios")),
        "violent_robbery": (0.25, ("robos con violencia o intimidacion",)),
        "serious_injury": (0.2, ("lesiones graves o gravisimas",)),
        "threats": (0.15, ("amenazas",)),
        "public_disorder": (0.15, ("desordenes publicos",)),
    }),
}
# Labels of the layers and components, in their order.
LAYER_LABELS = {"predicate_direct": "Delito base directo", "criminal_economy": "Economía criminal y facilitadores", "criminogenic_context": "Contexto criminógeno"}
COMPONENT_LABELS = {
    "drug_traffic": "Tráfico de sustancias", "drug_microtraffic": "Microtráfico de sustancias", "drug_production": "Elaboración o producción de sustancias",
    "reception": "Receptación", "illegal_trade": "Comercio ilegal", "vehicle_theft": "Robo de vehículo motorizado", "violent_vehicle_theft": "Robo violento de vehículo motorizado",
    "weapons_possession": "Porte / posesión de armas o explosivos", "cattle_theft": "Abigeato",
    "homicide": "Homicidios y femicidios", "violent_robbery": "Robos con violencia o intimidación", "serious_injury": "Lesiones graves o gravísimas", "threats": "Amenazas", "public_disorder": "Desórdenes públicos",
}
# The component that stands for a layer of which only a fallback label occurs.
FALLBACK_IDS = {"predicate_direct": "drug_family_fallback"}
INTERPRETATION = (
    "El indicador caracteriza presión criminógena territorial relevante para análisis AML. No representa probabilidad de lavado de activos, no acredita delito base respecto de una persona "
    "y no atribuye conductas a residentes, empresas o sectores del territorio."
)
FACTOR_WEIGHTS = {"intensity": 0.40, "persistence": 0.25, "trend": 0.20, "anomaly": 0.15}
USABLE_STATUSES = ("usable", "validated", "ok")
SOURCE_TIERS = {"primary_direct": 10, "mirror_of_primary": 20, "official_secondary": 30, "quarantined": 90}
UNKNOWN_TIER, MISSING_TIER = 99, 90
EXPECTED_COMMUNES, LEAST_COMMUNES = 346, 340
FIRST_YEAR, LAST_YEAR = 2020, 2025
MONTHS = ("enero", "febrero", "marzo", "abril", "mayo", "junio", "julio", "agosto", "septiembre", "octubre", "noviembre", "diciembre")
HOMICIDE_CONTROL = {"2024": 1207, "2025-H1": 511}
# Region code -> official name, north to south.
REGIONS = {
    "15": "Arica y Parinacota", "01": "Tarapacá", "02": "Antofagasta", "03": "Atacama", "04": "Coquimbo", "05": "Valparaíso", "13": "Metropolitana de Santiago", "06": "Libertador General Bernardo O'Higgins",
    "07": "Maule", "16": "Ñuble", "08": "Biobío", "09": "La Araucanía", "14": "Los Ríos", "10": "Los Lagos", "11": "Aysén del General Carlos Ibáñez del Campo", "12": "Magallanes y de la Antártica Chilena",
}
# Short names that tables also use for a region (normalised, apostrophes kept) -> region code.
SHORT_REGIONS = {"metropolitana": "13", "o'higgins": "06", "aysen": "11", "magallanes": "12"}
# Prosecutors' region labels -> region code; the capital's four prosecutors are one region.
PROSECUTOR_REGIONS = {
    "I": "01", "II": "02", "III": "03", "IV": "04", "V": "05", "VI": "06", "VII": "07", "VIII": "08", "IX": "09", "X": "10", "XI": "11", "XII": "12",
    "RM CN": "13", "RM OR": "13", "RM OCC": "13", "RM SUR": "13", "XIV": "14", "XV": "15", "XVI": "16",
}
# Region codes of the electoral districts 1 to 28.
DISTRICTS = ("15", "01", "02", "03", "04", "05", "05", "05", "13", "13", "13", "13", "13", "13", "06", "06", "07", "07", "16", "08", "08", "09", "09", "14", "10", "10", "11", "12")
# The four rate columns of the annual district table, in their order: family key -> label.
ANNUAL_FAMILIES = {
    "delitos_contra_vida_integridad": "Delitos contra la vida o integridad de las personas",
    "delitos_asociados_drogas": "Delitos asociados a drogas",
    "delitos_propiedad_no_violentos": "Delitos contra la propiedad no violentos",
    "violencia_intrafamiliar": "Violencia intrafamiliar",
}
# Words of which a publication's title or address holds one.
PUBLICATION_TERMS = ("homicid", "casos policiales", "enusc", "trata", "tráfico", "trafico", "seguridad ciudadana", "sitia", "delict")
# What each score says it is, and what it is not.
PRESSURE_TEXT = "Presión delictual AML (proxy); no es probabilidad de LA/FT ni atribución de delito."
REGION_PROXY_TEXT = "Proxy regional basado en categorías de delitos ingresados a SAF con relevancia AML. Homicidios y criminalidad general tienen peso cero."
REGION_PRIORITY_TEXT = "Prioridad territorial analítica AML/OSINT; no es probabilidad de LA/FT ni atribución de criminalidad a personas o sectores."
HOMICIDE_TEXT = "Señal territorial de violencia homicida estabilizada por población y volumen; no es un score AML ni una medición de crimen organizado."
COMMUNE_PRIORITY_TEXT = "Prioridad analítica territorial basada exclusivamente en denuncias CEAD de la familia drogas vinculada a Ley 20.000. No es probabilidad de LA/FT ni atribución a personas, empresas o sectores."
ACTIVITY_TEXT = "Actividad territorial reciente de una familia relacionada con delitos base. Es volumen de casos policiales; no es tasa, probabilidad de LA/FT ni atribución a residentes, empresas o sectores."
DRUG_LAW_BASIS, DRUG_LAW_RELATION = "Ley 19.913 art. 27 → Ley 20.000", "direct_family_ley_20000"
# How the factors of the geographic score are computed, in words.
METHODOLOGY = {
    "intensity": "Percentil territorial del volumen observado para la categoría y año. Reduce el efecto de escala frente al uso de conteos crudos, pero no reemplaza una tasa poblacional cuando ésta esté disponible.",
    "persistence": "Proporción de años observados en que la comuna se ubica en el cuartil superior nacional de esa categoría.",
    "trend": "Cambio del último año frente al promedio de hasta tres años previos, transformado a escala 0-100 y centrado en 50 cuando no hay cambio.",
    "anomaly": "Separación robusta del último valor respecto de la distribución comunal, usando mediana y MAD, transformada a escala 0-100.",
    "missing_data": "Los pesos internos se renormalizan solo entre componentes efectivamente observados. La cobertura se informa por separado y reduce la confianza; ausencia de datos nunca se interpreta como cero.",
    "interpretation": INTERPRETATION,
}
SOURCE_PRECEDENCE = ("external_cead_data_pipeline", "official_secondary", "quarantined")
# ---- End of fixed values ----------------------------------------------------------------------------------------


def taxonomy(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame([(k, *v) for k, v in TAXONOMY.items()], "label string, class string, weight double, confidence string, rationale string")


def catalog(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame([(k, *v) for k, v in CATALOG.items()], "mapping_key string, class string, eligible boolean, weight double, confidence string, basis string")


def label_keys(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame(list(LABEL_KEYS.items()), "label string, mapping_key string")


def families(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame([(k, *v) for k, v in FAMILIES.items()], "family_key string, relation string, eligible boolean, weight double, confidence string")


def legal_codes(spark: SparkSession) -> DataFrame:
    rows = [(code, *key, "exact", 1) for key, codes in LEGAL_CODES.items() for code in codes]
    return spark.createDataFrame(rows + [(code, *LEGAL_REPEALED_CLASS, "exclusion", 2) for code in LEGAL_REPEALED], "code long, class string, confidence string, basis string, rule_type string, rank int")


def legal_ranges(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame([(k, *r) for k, r in enumerate(LEGAL_RANGES)], "ordinal int, low long, high long, class string, confidence string, basis string")


def component_rows(layers: dict = LAYERS) -> list[tuple]:
    """One row for each component and label; fallback labels are rows with a priority of 1 or more, each the component's label itself."""
    rows = []
    for at, (layer, (weight, fallback, parts)) in enumerate(layers.items()):
        rows += [(at, layer, weight, k, c, COMPONENT_LABELS.get(c, c), w, label, 0) for k, (c, (w, labels)) in enumerate(parts.items()) for label in labels]
        rows += [(at, layer, weight, 0, FALLBACK_IDS.get(layer, f"{layer}_fallback"), label, 1.0, label, p) for p, label in enumerate(fallback, 1)]
    return rows


COMPONENT_SCHEMA = "layer_at int, layer string, layer_weight double, component_at int, component string, component_label string, component_weight double, label string, priority int"
