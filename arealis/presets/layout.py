"""Where the published files lie under the data folder. ``{year}`` etc. are filled in."""

RAW_SHEETS = "criminalidade/raw/VeiculosSubtraidos_{year}.csv"
CLEAN_SHEETS = "criminalidade/processed/veiculos/veiculos_{year}"
QUARTER_FOLDERS = "criminalidade/processed/veiculos_trimestre/veiculos_{year}"
LOCATED_QUARTERS = "criminalidade/processed/veiculos_setor/veiculos_{year}_{quarter}_setor.csv"
CURATED = "criminalidade/curated/veiculos_setor_parquet"
CENSUS = "censo"

CENSUS_FILES = {
    "setor": {
        "basico": "censo/basico/raw/setores/Agregados_por_setores_basico_BR.csv",
        "entorno": "censo/caracteristicas_domicilio/raw/setores/"
        "Agregados_por_setores_entorno_domicílios_BR.csv",
        "rendimento": "censo/rendimento_responsavel/raw/setores/"
        "Agregados_por_setores_renda_responsavel_BR.csv",
    },
    "distrito": {
        "basico": "censo/basico/raw/distritos/Agregados_por_distritos_basico_BR.csv",
        "entorno": "censo/caracteristicas_domicilio/raw/distritos/"
        "Agregados_por_distritos_entorno_domicílios_BR.csv",
        "rendimento": "censo/rendimento_responsavel/raw/distritos/"
        "Agregados_por_distritos_renda_responsavel_BR.csv",
    },
}
