"""Census tables. Everything here is a fixed value of the published tables.

A mapping row is (raw code, published name); which converter applies is said by the list it is in.
"""

from arealis.functions.rules import Rule

SECTOR_TYPE = (
    Rule("NAO_ESPECIAL", "in", (0,)),
    Rule("FAVELA_COMUNIDADE_URBANA", "in", (1,)),
    Rule("QUARTEL_BASE_MILITAR", "in", (2,)),
    Rule("ALOJAMENTO_ACAMPAMENTO", "in", (3,)),
    Rule("SETOR_BAIXO_PATAMAR_DOMICILIAR", "in", (4,)),
    Rule("AGRUPAMENTO_INDIGENA", "in", (5,)),
    Rule("UNIDADE_PRISIONAL", "in", (6,)),
    Rule("CONVENTO_HOSPITAL_ILPI_IACA", "in", (7,)),
    Rule("AGROVILA_PA", "in", (8,)),
    Rule("AGRUPAMENTO_QUILOMBOLA", "in", (9,)),
)

MUNICIPALITY = "São Paulo"

# raw name, published name, converter
BASIC_SECTOR = (
    ("cd_setor", "cd_setor", "text"),
    ("situacao", "ds_situacao", "text"),
    ("cd_sit", "cd_situacao", "text"),
    ("cd_tipo", "cd_tipo", "text"),
    ("cd_tipo", "categoria_tipo_setor", "sector_type"),
    ("area_km2", "area_km2", "double"),
    ("nm_uf", "nm_uf", "text"),
    ("cd_mun", "cd_mun", "text"),
    ("nm_mun", "nm_mun", "text"),
    ("cd_dist", "cd_dist", "text"),
    ("nm_dist", "nm_dist", "text"),
    ("cd_subdist", "cd_subdist", "text"),
    ("v0001", "qt_pessoas", "bigint"),
    ("v0002", "qt_domicilios", "bigint"),
    ("v0005", "avg_moradores_domiciliosparticularesocupados", "double"),
    ("v0007", "qt_domicilios_particularesocupados", "bigint"),
    ("v0008", "qt_domicilios_particulares_usococasional", "bigint"),
    ("v0009", "qt_domicilios_particulares_vagos", "bigint"),
)

BASIC_DISTRICT = (
    ("cd_dist", "cd_dist", "text"),
    ("nm_dist", "nm_dist", "text"),
    ("cd_regiao", "cd_regiao", "text"),
    ("nm_regiao", "nm_regiao", "text"),
    ("cd_uf", "cd_uf", "text"),
    ("nm_uf", "nm_uf", "text"),
    ("cd_mun", "cd_mun", "text"),
    ("nm_mun", "nm_mun", "text"),
    ("area_km2", "area_km2", "double"),
    ("v0001", "qt_pessoas", "bigint"),
    ("v0002", "qt_domicilios", "bigint"),
    ("v0003", "qt_domicilios_particulares", "bigint"),
    ("v0004", "qt_domicilios_coletivos", "bigint"),
    ("v0005", "avg_moradores_domiciliosparticularesocupados", "double"),
    ("v0006", "perc_domicilios_coletivos", "double"),
    ("v0007", "qt_domicilios_particularesocupados", "bigint"),
    ("v0008", "qt_domicilios_particulares_usococasional", "bigint"),
    ("v0009", "qt_domicilios_particulares_vagos", "bigint"),
)

# raw name, published name; all counted
SURROUNDINGS = (
    ("v05000", "qt_domicilios_entorno"),
    ("v05001", "qt_domicilios_face_circulacao_caminhao_onibus"),
    ("v05002", "qt_domicilios_face_circulacao_carro_van"),
    ("v05003", "qt_domicilios_face_circulacao_pedestre_bicicleta_motocicleta"),
    ("v05004", "qt_domicilios_face_circulacao_aquavia"),
    ("v05005", "qt_domicilios_face_circulacao_saltado"),
    ("v05006", "qt_domicilios_face_via_pavimentada_sim"),
    ("v05007", "qt_domicilios_face_via_pavimentada_nao"),
    ("v05008", "qt_domicilios_face_via_pavimentada_nao_declarado"),
    ("v05009", "qt_domicilios_face_bueiro_sim"),
    ("v05010", "qt_domicilios_face_bueiro_nao"),
    ("v05011", "qt_domicilios_face_bueiro_nao_declarado"),
    ("v05012", "qt_domicilios_face_iluminacao_publica_sim"),
    ("v05013", "qt_domicilios_face_iluminacao_publica_nao"),
    ("v05014", "qt_domicilios_face_iluminacao_publica_nao_declarado"),
    ("v05015", "qt_domicilios_face_ponto_onibus_sim"),
    ("v05016", "qt_domicilios_face_ponto_onibus_nao"),
    ("v05017", "qt_domicilios_face_ponto_onibus_nao_declarado"),
    ("v05018", "qt_domicilios_face_via_sinalizada_bicicleta_sim"),
    ("v05019", "qt_domicilios_face_via_sinalizada_bicicleta_nao"),
    ("v05020", "qt_domicilios_face_via_sinalizada_bicicleta_nao_declarado"),
    ("v05021", "qt_domicilios_face_calcada_sim"),
    ("v05022", "qt_domicilios_face_calcada_nao"),
    ("v05023", "qt_domicilios_face_calcada_nao_declarado"),
    ("v05024", "qt_domicilios_face_obstaculo_calcada_sim"),
    ("v05025", "qt_domicilios_face_obstaculo_calcada_nao"),
    ("v05026", "qt_domicilios_face_obstaculo_calcada_nao_declarado"),
    ("v05027", "qt_domicilios_face_rampa_cadeirante_sim"),
    ("v05028", "qt_domicilios_face_rampa_cadeirante_nao"),
    ("v05029", "qt_domicilios_face_rampa_cadeirante_nao_declarado"),
    ("v05030", "qt_domicilios_face_arborizacao_sem_arvores"),
    ("v05031", "qt_domicilios_face_arborizacao_1_2_arvores"),
    ("v05032", "qt_domicilios_face_arborizacao_3_4_arvores"),
    ("v05033", "qt_domicilios_face_arborizacao_5_mais_arvores"),
    ("v05034", "qt_domicilios_face_arborizacao_saltado"),
)

# raw name, published name, converter
INCOME = (
    ("v06001", "qt_pessoas_responsaveis_domicilios", "bigint"),
    ("v06002", "qt_moradores_domicilios", "bigint"),
    ("v06003", "vl_variancia_qt_moradores_domicilios", "double"),
    ("v06004", "vl_rendimento_nominal_medio_responsavel", "double"),
    ("v06005", "vl_variancia_rendimento_nominal_responsavel", "double"),
    ("v06006", "vl_rendimento_nominal_mediano_responsavel", "double"),
)

# ratio column, stem of its _sim and _nao counters
YES_SHARES = (
    ("tx_via_pavimentada", "qt_domicilios_face_via_pavimentada"),
    ("tx_bueiro", "qt_domicilios_face_bueiro"),
    ("tx_iluminacao_publica", "qt_domicilios_face_iluminacao_publica"),
    ("tx_ponto_onibus", "qt_domicilios_face_ponto_onibus"),
    ("tx_ciclovia", "qt_domicilios_face_via_sinalizada_bicicleta"),
    ("tx_calcada", "qt_domicilios_face_calcada"),
    ("tx_obstaculo_calcada", "qt_domicilios_face_obstaculo_calcada"),
    ("tx_rampa_cadeirante", "qt_domicilios_face_rampa_cadeirante"),
)

TREE_CLASSES = (
    "qt_domicilios_face_arborizacao_sem_arvores",
    "qt_domicilios_face_arborizacao_1_2_arvores",
    "qt_domicilios_face_arborizacao_3_4_arvores",
    "qt_domicilios_face_arborizacao_5_mais_arvores",
)

# index column, parts that raise it, parts that lower it (entered as one minus the share)
COMPOSITES = (
    (
        "indice_infraestrutura_urbana",
        (
            "tx_via_pavimentada",
            "tx_bueiro",
            "tx_iluminacao_publica",
            "tx_calcada",
            "tx_rampa_cadeirante",
            "tx_arborizacao",
        ),
        (),
    ),
    ("indice_mobilidade_urbana", ("tx_ponto_onibus", "tx_ciclovia"), ()),
    ("indice_caminhabilidade", ("tx_calcada", "tx_rampa_cadeirante"), ("tx_obstaculo_calcada",)),
    (
        "indice_vulnerabilidade_urbana",
        ("tx_domicilios_vagos",),
        ("tx_iluminacao_publica", "tx_via_pavimentada", "tx_calcada", "tx_bueiro"),
    ),
)

FINAL_MEASURES = (
    "cd_mun",
    "nm_mun",
    "area_km2",
    "qt_pessoas",
    "qt_domicilios",
    "qt_domicilios_particularesocupados",
    "qt_domicilios_particulares_vagos",
    "densidade_populacional",
    "densidade_domicilios",
    "tx_domicilios_ocupados",
    "tx_domicilios_vagos",
    "avg_moradores_domiciliosparticularesocupados",
    "tx_via_pavimentada",
    "tx_bueiro",
    "tx_iluminacao_publica",
    "tx_ponto_onibus",
    "tx_ciclovia",
    "tx_calcada",
    "tx_obstaculo_calcada",
    "tx_rampa_cadeirante",
    "tx_arborizacao",
    "indice_arborizacao_ponderado",
    "vl_rendimento_nominal_medio_responsavel",
    "vl_rendimento_nominal_mediano_responsavel",
    "vl_variancia_rendimento_nominal_responsavel",
    "vl_variancia_qt_moradores_domicilios",
    "log_renda_media",
    "log_renda_mediana",
    "vl_renda_media_por_morador",
    "vl_renda_mediana_por_morador",
    "densidade_renda_media_km2",
    "densidade_renda_mediana_km2",
    "indice_infraestrutura_urbana",
    "indice_mobilidade_urbana",
    "indice_caminhabilidade",
    "indice_vulnerabilidade_urbana",
)
