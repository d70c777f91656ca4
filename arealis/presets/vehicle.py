"""Vehicle occurrence records. Everything here is a fixed value of the published records."""

from arealis.functions.rules import Rule

DROPPED = (
    "tipo_intolerancia",
    "nome_departamento",
    "flag_ato_infracional",
    "logradouro_versao",
    "flag_intolerancia",
    "desdobramento",
    "circunstancia",
    "descr_periodo",
    "descricao_apresentacao",
    "desc_lei",
)

UPPERCASED = (
    "nome_seccional",
    "nome_delegacia",
    "nome_municipio",
    "nome_municipio_circ",
    "cidade",
    "bairro",
    "logradouro",
    "rubrica",
    "descr_conduta",
    "descr_tipo_veiculo",
    "descr_marca_veiculo",
    "desc_cor_veiculo",
)

DATES = ("data_ocorrencia_bo", "data_comunicacao_bo")
TIMESTAMPS = ("datahora_registro_bo", "datahora_impressao_bo")
INTEGERS = (
    "id_delegacia",
    "ano_bo",
    "versao",
    "cont_veiculo",
    "ano_fabricacao",
    "ano_modelo",
    "mes_registro_bo",
    "ano_registro_bo",
)
CLOCKS = ("hora_ocorrencia",)
COORDINATES = ("latitude", "longitude")

PERIOD_OF_DAY = (
    Rule("MADRUGADA", "between", (0, 5)),
    Rule("MANHA", "between", (6, 11)),
    Rule("TARDE", "between", (12, 17)),
    Rule("NOITE", "between", (18, 23)),
)

CONDUCT = (
    Rule("VEICULO", "in", ("VEÍCULO", "INTERIOR DE VEÍCULO")),
    Rule("PESSOA", "in", ("TRANSEUNTE", "PESSOA")),
    Rule("RESIDENCIAL", "in", ("RESIDÊNCIA", "CONDOMÍNIO RESIDÊNCIAL")),
    Rule(
        "COMERCIAL",
        "in",
        ("ESTABELECIMENTO COMERCIAL", "INTERIOR ESTABELECIMENTO", "ESTABELECIMENTO-OUTROS"),
    ),
    Rule("CARGA", "in", ("CARGA",)),
    Rule("TRANSPORTE", "in", ("COLETIVO", "APLICATIVO DE MOBILIDADE URBANA")),
    Rule("OUTROS", "in", ("OUTROS", "FIOS E CABOS")),
)

# The published patterns are alternations of plain words; word tests are cheaper per row than a pattern.
OFFENCE = (
    Rule("FURTO", "starts", ("FURTO",)),
    Rule("ROUBO", "starts", ("ROUBO",)),
    Rule("RECUPERACAO", "contains", ("LOCALIZAÇÃO", "APREENSÃO", "ENTREGA")),
    Rule("RECEPTACAO", "contains", ("RECEPTAÇÃO",)),
    Rule("ADULTERACAO", "contains", ("ADULTERAÇÃO",)),
    Rule("FRAUDE", "contains", ("ESTELIONATO", "APROPRIAÇÃO INDÉBITA")),
    Rule("ACIDENTE", "contains", ("COLISÃO", "CHOQUE", "ABALROAMENTO", "TOMBAMENTO")),
    Rule("VIOLENCIA", "contains", ("HOMICÍDIO", "LESÃO CORPORAL", "AMEAÇA", "VIOLÊNCIA")),
    Rule("DROGAS", "contains", ("TRÁFICO", "DROGAS")),
    Rule("ARMAS", "contains", ("ARMA DE FOGO", "ARMA")),
)

VEHICLE_EVENT = (
    Rule("RECUPERADO", "in", ("Localizado / Entregue",)),
    Rule("FURTADO", "in", ("Furtado",)),
    Rule("ROUBADO", "in", ("Roubado",)),
)

VEHICLE_TYPE = (
    Rule("LEVE", "in", ("AUTOMOVEL", "CAMINHONETE", "CAMIONETA", "UTILITÁRIO")),
    Rule("MOTOCICLETA", "in", ("MOTOCICLO", "MOTONETA", "CICLOMOTO")),
    Rule("PESADO", "in", ("CAMINHÃO", "CAMINHÃO TRATOR", "SEMI-REBOQUE", "REBOQUE")),
    Rule("TRANSPORTE_PUBLICO", "in", ("ONIBUS", "MICRO-ONIBUS")),
    Rule("MAQUINARIO", "contains", ("TRATOR",)),
    Rule("BICICLETA", "in", ("BICICLETA",)),
)

PLACE_TYPE = (
    Rule("VIA_PUBLICA", "in", ("Via Pública",)),
    Rule("RESIDENCIAL", "in", ("Residência", "Condomínio Residencial", "Favela")),
    Rule(
        "COMERCIAL",
        "in",
        (
            "Comércio e Serviços",
            "Centro Comercial/Empresarial",
            "Shopping Center",
            "Escritório",
            "Estabelecimento Bancário",
            "Restaurante e Afins",
            "Condomínio Comercial",
        ),
    ),
    Rule("ESTACIONAMENTO", "in", ("Estacionamento/Garagem",)),
    Rule("RODOVIA", "in", ("Rodovia/Estrada",)),
    Rule(
        "PUBLICO",
        "in",
        (
            "Repartição Pública",
            "Serviços e Bens Públicos",
            "Saúde",
            "Terminal/Estação",
            "Estabelecimento de Ensino",
            "Entidade Assistencial",
        ),
    ),
    Rule("AREA_ABERTA", "in", ("Area não Ocupada", "Unidade Rural")),
)

# target column, source column, rules, default
CATEGORIES = (
    ("periodo_dia", "hora_ocorrencia_num", PERIOD_OF_DAY, None),
    ("categoria_conduta", "descr_conduta", CONDUCT, "NAO_INFORMADO"),
    ("categoria_rubrica", "rubrica", OFFENCE, "OUTROS"),
    ("categoria_ocorrencia_veiculo", "descr_ocorrencia_veiculo", VEHICLE_EVENT, "OUTROS"),
    ("categoria_tipo_veiculo", "descr_tipo_veiculo", VEHICLE_TYPE, "OUTROS"),
    ("categoria_tipolocal", "descr_tipolocal", PLACE_TYPE, "OUTROS"),
)

# flag column, category column, categories that set it
FLAGS = (
    ("is_recuperado", "categoria_ocorrencia_veiculo", ("RECUPERADO",)),
    ("is_furto", "categoria_rubrica", ("FURTO",)),
    ("is_roubo", "categoria_rubrica", ("ROUBO",)),
    ("is_violento", "categoria_rubrica", ("ROUBO", "VIOLENCIA")),
)
