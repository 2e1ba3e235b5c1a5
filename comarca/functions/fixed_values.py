"""Fixed values of the public statistics this package works on.

Word lists, spellings, column layouts and thresholds whose exact value decides
the result.  They are stated as data so that every operator can be given others.
"""

# --- fixed values: official province names (community, name, province, name) ---
PROVINCES = [
    (1, "Andalucía", 4, "Almería"),
    (1, "Andalucía", 11, "Cádiz"),
    (1, "Andalucía", 14, "Córdoba"),
    (1, "Andalucía", 18, "Granada"),
    (1, "Andalucía", 21, "Huelva"),
    (1, "Andalucía", 23, "Jaén"),
    (1, "Andalucía", 29, "Málaga"),
    (1, "Andalucía", 41, "Sevilla"),
    (2, "Aragón", 22, "Huesca"),
    (2, "Aragón", 44, "Teruel"),
    (2, "Aragón", 50, "Zaragoza"),
    (3, "Asturias, Principado de", 33, "Asturias"),
    (4, "Balears, Illes", 7, "Balears, Illes"),
    (5, "Canarias", 35, "Palmas, Las"),
    (5, "Canarias", 38, "Santa Cruz de Tenerife"),
    (6, "Cantabria", 39, "Cantabria"),
    (7, "Castilla y León", 5, "Ávila"),
    (7, "Castilla y León", 9, "Burgos"),
    (7, "Castilla y León", 24, "León"),
    (7, "Castilla y León", 34, "Palencia"),
    (7, "Castilla y León", 37, "Salamanca"),
    (7, "Castilla y León", 40, "Segovia"),
    (7, "Castilla y León", 42, "Soria"),
    (7, "Castilla y León", 47, "Valladolid"),
    (7, "Castilla y León", 49, "Zamora"),
    (8, "Castilla-La Mancha", 2, "Albacete"),
    (8, "Castilla-La Mancha", 13, "Ciudad Real"),
    (8, "Castilla-La Mancha", 16, "Cuenca"),
    (8, "Castilla-La Mancha", 19, "Guadalajara"),
    (8, "Castilla-La Mancha", 45, "Toledo"),
    (9, "Cataluña", 8, "Barcelona"),
    (9, "Cataluña", 17, "Girona"),
    (9, "Cataluña", 25, "Lleida"),
    (9, "Cataluña", 43, "Tarragona"),
    (10, "Comunitat Valenciana", 3, "Alicante/Alacant"),
    (10, "Comunitat Valenciana", 12, "Castellón/Castelló"),
    (10, "Comunitat Valenciana", 46, "Valencia/València"),
    (11, "Extremadura", 6, "Badajoz"),
    (11, "Extremadura", 10, "Cáceres"),
    (12, "Galicia", 15, "Coruña, A"),
    (12, "Galicia", 27, "Lugo"),
    (12, "Galicia", 32, "Ourense"),
    (12, "Galicia", 36, "Pontevedra"),
    (13, "Madrid, Comunidad de", 28, "Madrid"),
    (14, "Murcia, Región de", 30, "Murcia"),
    (15, "Navarra, Comunidad Foral de", 31, "Navarra"),
    (16, "País Vasco", 1, "Araba/Álava"),
    (16, "País Vasco", 20, "Gipuzkoa"),
    (16, "País Vasco", 48, "Bizkaia"),
    (17, "Rioja, La", 26, "Rioja, La"),
    (18, "Ceuta", 51, "Ceuta"),
    (19, "Melilla", 52, "Melilla"),
]

# --- fixed values: province spellings in employment sheets -> official name ---
PROVINCE_ALIASES = [
    ("ALAVA", "Araba/Álava"),
    ("ARABA", "Araba/Álava"),
    ("VIZCAYA", "Bizkaia"),
    ("GUIPUZCOA", "Gipuzkoa"),
    ("GIPUZCOA", "Gipuzkoa"),
    ("GUIPÚZCOA", "Gipuzkoa"),
    ("GUIPUZKOA", "Gipuzkoa"),
    ("GERONA", "Girona"),
    ("LERIDA", "Lleida"),
    ("ALICANTE", "Alicante/Alacant"),
    ("CASTELLON", "Castellón/Castelló"),
    ("VALENCIA", "Valencia/València"),
    ("BALEARES", "Balears, Illes"),
    ("ILLES BALEARS", "Balears, Illes"),
    ("ILLES BALEARES", "Balears, Illes"),
    ("LA CORUÑA", "Coruña, A"),
    ("CORUÑA", "Coruña, A"),
    ("ORENSE", "Ourense"),
    ("PONTEVEDRA", "Pontevedra"),
    ("LUGO", "Lugo"),
    ("CORDOBA", "Córdoba"),
    ("CADIZ", "Cádiz"),
    ("MALAGA", "Málaga"),
    ("JAEN", "Jaén"),
    ("ALMERIA", "Almería"),
    ("AVILA", "Ávila"),
    ("CACERES", "Cáceres"),
    ("LEON", "León"),
    ("RIOJA (LA)", "Rioja, La"),
    ("LA RIOJA", "Rioja, La"),
    ("ASTURIAS", "Asturias"),
    ("OVIEDO", "Asturias"),
    ("LAS PALMAS", "Palmas, Las"),
    ("SANTA CRUZ DE TENERIFE", "Santa Cruz de Tenerife"),
    ("SANTA CRUZ TENERIFE", "Santa Cruz de Tenerife"),
    ("TENERIFE", "Santa Cruz de Tenerife"),
]

# --- fixed values: month names used in page identifiers ---
MONTH_NAMES = ["enero", "febrero", "marzo", "abril", "mayo", "junio", "julio",
               "agosto", "septiembre", "octubre", "noviembre", "diciembre"]

# --- fixed values: letters folded when names are compared ---
FOLD_FROM = "ÁÉÍÓÚÜÑÇ.,()-/"
FOLD_TO = "AEIOUUNC      "
FOLD_GRAVE_FROM = "ÀÈÌÒÙÂÊÎÔÛÄËÏÖ"
FOLD_GRAVE_TO = "AEIOUAEIOUAEIO"

# --- fixed values: whole-word abbreviations, longest first ---
ABBREVIATIONS = [("N SRA", "NUESTRA SENORA"), ("STA", "SANTA"),
                 ("STO", "SANTO"), ("S", "SAN")]

# --- fixed values: rule that gave a code, in the order the rules are tried ---
CODE_SOURCES = ["original", "sepe_lookup", "ine_reference", "fuzzy_match", "not_found"]
NORMALIZED_MATCH = ("fuzzy_normalized", 95)

# --- fixed values: sheets that hold no data, sheet prefixes, sheet spellings ---
IGNORED_SHEETS = ["PORTADA", "Indice", "NO CONSTA MUNIC."]
SHEET_PREFIXES = {"PARO": "unemployment", "CONTRATOS": "contracts"}
SHEET_SPELLINGS = [("CONTRTOS LUGO", "CONTRATOS LUGO")]
SHEET_PROVINCES = [
    ("A CORUÑA", "CORUÑA"),
    ("CORUÑA A", "CORUÑA"),
    ("STA CRUZ TENER.", "SANTA CRUZ TENERIFE"),
    ("STA. CRUZ TENER.", "SANTA CRUZ TENERIFE"),
]

# --- fixed values: words that mark a heading row inside an old sheet ---
HEADING_WORDS = [
    "PARO REGISTRADO", "SEGÚN SEXO", "EDAD Y SECTOR", "MUNICIPIOS", "TOTAL",
    "HOMBRES", "MUJERES", "SECTORES", "AGRI-", "INDUS-", "CONS-",
    "CONTRATOS DE TRABAJO", "REGISTRADOS SEGÚN", "TIPO DE CONTRATO",
    "INIC. INDEF.", "INIC. TEMPORAL", "CONVERT.",
]
TITLE_CELLS = ["TOTAL", "HOMBRES", "MUJERES", "MUNICIPIOS"]
SUBTOTAL_WORDS = ["total", "suma", "agregado"]

# --- fixed values: measure columns in sheet order ---
UNEMPLOYMENT_MEASURES = [
    "total_unemployment",
    "men_under_25", "men_25_44", "men_45_plus",
    "women_under_25", "women_25_44", "women_45_plus",
    "agriculture_sector", "industry_sector", "construction_sector",
    "services_sector", "no_previous_employment",
]
CONTRACT_MEASURES = [
    "total_contracts",
    "men_indefinite_initial", "men_temporary_initial", "men_indefinite_conversion",
    "women_indefinite_initial", "women_temporary_initial", "women_indefinite_conversion",
    "agriculture_sector", "industry_sector", "construction_sector", "services_sector",
]
POPULATION_MEASURES = ["population_total", "population_male", "population_female"]

# --- fixed values: last years of the sheet vintages ---
WIDE_VINTAGE_LAST_YEAR = 2007
OLD_VINTAGE_LAST_YEAR = 2012
FIRST_TWO_DIGIT_YEAR = 96

# --- fixed values: plausibility limits of the totals ---
HIGH_TOTAL = {"unemployment": 50_000, "contracts": 100_000}

# --- fixed values: header spellings, first matching rule wins.
# (column, any of these, all of these, none of these); "~" marks a pattern ---
HEADER_RULES = [
    ("population_total", ["~^pob[0-9]{2}"], [], []),
    ("municipality_code", ["codigo", "cod", "cmun"], ["municipio"], []),
    ("municipality_name", ["municipio", "nombre"], [], ["codigo"]),
    ("province_code", ["cpro", "cod_prov", "codigo_prov"], [], []),
    ("province_name", ["provincia"], [], ["codigo", "cpro"]),
    ("province", ["~^province$"], [], []),
    ("population_male", ["varon", "hombre", "varones", "hombres", "masculino"], [], []),
    ("population_female", ["mujer", "mujeres", "femenino", "femenina"], [], []),
    ("population_total", ["total", "ambos_sexos", "ambos", "suma", "totales"], [], []),
    ("autonomous_community", ["comunidad", "autonoma", "ccaa"], [], []),
    ("island", ["isla", "island"], [], []),
]

# --- fixed values: registered publishers copied onto loaded rows ---
SOURCE_REGISTRY = {
    "demography": {
        "data_source": "INE",
        "data_source_full": "Instituto Nacional de Estadística",
        "data_category": "demography",
        "source_url": "https://www.ine.es/jaxiT3/Tabla.htm?t=2852",
        "source_description": "Municipal population data by year",
    },
    "economy": {
        "data_source": "Banco de España",
        "data_source_full": "Banco de España",
        "data_category": "economy",
        "source_url": "https://www.bde.es/",
        "source_description": "Economic indicators by municipality",
    },
}
