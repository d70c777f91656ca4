"""Fixed values of the published analyses: variable groups, model formulas and export columns."""

TARGET_RATE = "tx_crimes_1000_hab"
LOG_RATE = "log_tx_crimes_1000_hab"
TOP_RATE = 1500
STUDY_YEARS = (2020, 2025)
POPULATION_FLOOR_DESCRIPTIVE = 50
POPULATION_FLOOR_MODEL = 100

# count column, flag column
EVENT_FLAGS = {"qt_roubos": "is_roubo", "qt_furtos": "is_furto"}

INFRASTRUCTURE = (
    "tx_via_pavimentada",
    "tx_bueiro",
    "tx_iluminacao_publica",
    "tx_calcada",
    "tx_arborizacao",
    "tx_rampa_cadeirante",
    "tx_obstaculo_calcada",
    "indice_infraestrutura_urbana",
)
MOBILITY = ("tx_ponto_onibus", "tx_ciclovia", "indice_mobilidade_urbana", "indice_caminhabilidade")
INCOME = (
    "log_renda_media",
    "log_renda_mediana",
    "vl_renda_media_por_morador",
    "vl_renda_mediana_por_morador",
    "densidade_renda_media_km2",
    "densidade_renda_mediana_km2",
)
DEMOGRAPHIC = (
    "densidade_populacional",
    "densidade_domicilios",
    "avg_moradores_domiciliosparticularesocupados",
    "tx_domicilios_ocupados",
    "tx_domicilios_vagos",
)
GROUPS = {
    "infrastructure": INFRASTRUCTURE,
    "mobility": MOBILITY,
    "income": INCOME,
    "demographic": DEMOGRAPHIC,
}
MAIN_VARIABLES = (
    "indice_infraestrutura_urbana",
    "indice_mobilidade_urbana",
    "indice_caminhabilidade",
    "indice_vulnerabilidade_urbana",
    "log_renda_media",
    "densidade_populacional",
    "tx_iluminacao_publica",
    "tx_arborizacao",
)
URBAN_RATIOS = (
    "tx_via_pavimentada",
    "tx_bueiro",
    "tx_iluminacao_publica",
    "tx_ponto_onibus",
    "tx_ciclovia",
    "tx_calcada",
    "tx_obstaculo_calcada",
    "tx_rampa_cadeirante",
    "tx_arborizacao",
)
URBAN_VARIABLES = (
    "densidade_populacional",
    "densidade_domicilios",
    "log_renda_media",
    "log_renda_mediana",
    "indice_infraestrutura_urbana",
    "indice_mobilidade_urbana",
    "indice_vulnerabilidade_urbana",
    "tx_iluminacao_publica",
    "tx_arborizacao",
    "tx_calcada",
)

# model name, predictors; the target of all three is LOG_RATE
MODELS = {
    "Modelo 1": ("indice_infraestrutura_urbana",),
    "Modelo 2": ("indice_infraestrutura_urbana", "log_renda_media"),
    "Modelo 3": (
        "indice_infraestrutura_urbana",
        "indice_mobilidade_urbana",
        "log_renda_media",
        "densidade_populacional",
    ),
}
MODEL_TITLES = {
    "Modelo 1": "Infraestrutura",
    "Modelo 2": "Infraestrutura + Renda",
    "Modelo 3": "Modelo Principal",
}
# row label, term, number format
MODEL_ROWS = (
    ("Infraestrutura", "indice_infraestrutura_urbana", "%.3f"),
    ("Renda", "log_renda_media", "%.3f"),
    ("Mobilidade", "indice_mobilidade_urbana", "%.3f"),
    ("Densidade Pop.", "densidade_populacional", "%.2e"),
)

SPATIAL_COLUMNS = (
    "cd_setor",
    "nm_dist",
    "nm_mun",
    "qt_pessoas",
    "area_km2",
    "qt_crimes",
    "qt_roubos",
    "qt_furtos",
    "tx_crimes_1000_hab",
    "tx_roubos_1000_hab",
    "tx_furtos_1000_hab",
    "log_tx_crimes_1000_hab",
    "indice_infraestrutura_urbana",
    "indice_mobilidade_urbana",
    "indice_caminhabilidade",
    "indice_vulnerabilidade_urbana",
    "log_renda_media",
    "densidade_populacional",
)
