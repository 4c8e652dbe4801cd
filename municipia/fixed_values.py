"""Codes, names and word lists that results depend on.

They are facts of the two surveys (state codes, category names, sentinels, API header words)
or editable starting points (keyword lists), stated here as plain text in natural order.
"""

# Fixed values: (two-digit code, state, state name, short macro-region, long macro-region).
STATES = [
    ("11", "RO", "Rondônia", "N", "Norte"),
    ("12", "AC", "Acre", "N", "Norte"),
    ("13", "AM", "Amazonas", "N", "Norte"),
    ("14", "RR", "Roraima", "N", "Norte"),
    ("15", "PA", "Pará", "N", "Norte"),
    ("16", "AP", "Amapá", "N", "Norte"),
    ("17", "TO", "Tocantins", "N", "Norte"),
    ("21", "MA", "Maranhão", "NE", "Nordeste"),
    ("22", "PI", "Piauí", "NE", "Nordeste"),
    ("23", "CE", "Ceará", "NE", "Nordeste"),
    ("24", "RN", "Rio Grande do Norte", "NE", "Nordeste"),
    ("25", "PB", "Paraíba", "NE", "Nordeste"),
    ("26", "PE", "Pernambuco", "NE", "Nordeste"),
    ("27", "AL", "Alagoas", "NE", "Nordeste"),
    ("28", "SE", "Sergipe", "NE", "Nordeste"),
    ("29", "BA", "Bahia", "NE", "Nordeste"),
    ("31", "MG", "Minas Gerais", "SE", "Sudeste"),
    ("32", "ES", "Espírito Santo", "SE", "Sudeste"),
    ("33", "RJ", "Rio de Janeiro", "SE", "Sudeste"),
    ("35", "SP", "São Paulo", "SE", "Sudeste"),
    ("41", "PR", "Paraná", "S", "Sul"),
    ("42", "SC", "Santa Catarina", "S", "Sul"),
    ("43", "RS", "Rio Grande do Sul", "S", "Sul"),
    ("50", "MS", "Mato Grosso do Sul", "CO", "Centro-Oeste"),
    ("51", "MT", "Mato Grosso", "CO", "Centro-Oeste"),
    ("52", "GO", "Goiás", "CO", "Centro-Oeste"),
    ("53", "DF", "Distrito Federal", "CO", "Centro-Oeste"),
]

# The category lookup as shipped with the survey (permanent, temporary, combine-harvested).
PERMANENT_CROPS = [
    "Abacate", "Abacaxi*", "Açaí", "Banana (cacho)", "Borracha (látex coagulado)",
    "Cacau (em amêndoa)", "Café (em grão) Arábica", "Café (em grão) Canephora",
    "Café (em grão) Total", "Caqui", "Castanha de caju", "Coco-da-baía*",
    "Dendê (cacho de coco)", "Erva-mate (folha verde)", "Figo", "Goiaba",
    "Guaraná (semente)", "Laranja", "Limão", "Mamão", "Manga", "Maracujá", "Marmelo",
    "Maçã", "Pera", "Pimenta-do-reino", "Pêssego", "Sisal ou agave (fibra)", "Tangerina",
    "Urucum (semente)", "Uva", "Chá-da-índia (folha verde)", "Tungue (fruto seco)",
]
TEMPORARY_CROPS = [
    "Algodão arbóreo (em caroço)", "Algodão herbáceo (em caroço)", "Alho",
    "Amendoim (em casca)", "Arroz (em casca)", "Aveia (em grão)", "Azeitona", "Batata-doce",
    "Batata-inglesa", "Cana-de-açúcar", "Cebola", "Centeio (em grão)", "Cevada (em grão)",
    "Ervilha (em grão)", "Fava (em grão)", "Feijão (em grão)", "Fumo (em folha)",
    "Girassol (em grão)", "Juta (fibra)", "Linho (semente)", "Malva (fibra)",
    "Mamona (baga)", "Mandioca", "Melancia", "Melão", "Milho (em grão)", "Noz (fruto seco)",
    "Palmito", "Soja (em grão)", "Sorgo (em grão)", "Tomate", "Trigo (em grão)",
    "Triticale (em grão)", "Rami (fibra)",
]
COMBINE_CROPS = [
    "Arroz (em casca)", "Aveia (em grão)", "Centeio (em grão)", "Cevada (em grão)",
    "Ervilha (em grão)", "Fava (em grão)", "Feijão (em grão)", "Girassol (em grão)",
    "Linho (semente)", "Milho (em grão)", "Soja (em grão)", "Sorgo (em grão)",
    "Trigo (em grão)", "Triticale (em grão)",
]

# Words that mark a crop as permanent when no lookup exists yet.
PERMANENT_KEYWORDS = [
    "banana", "café", "cacao", "cacau", "laranja", "tangerina", "lima", "limão", "limao",
    "uva", "coco", "maçã", "maca", "pêssego", "pessego", "manga", "goiaba", "abacate",
    "guaraná", "guarana", "dendê", "dende", "palma", "pimenta-do-reino", "maracujá", "maracuja",
    "figo", "caju", "acerola", "graviola", "pitanga", "açaí", "acai", "cupuaçu", "cupuacu",
    "borracha", "seringueira", "sisal", "abacaxi", "mamão", "mamao",
    "noz-pecã", "pecan", "macadamia", "macadâmia", "castanha-do-para", "castanha do pará",
    "urucum", "erva-mate", "carnauba", "carnaúba",
]

# Unit of each livestock category.
CATEGORY_UNITS = {
    "Bovino": "cab.", "Bubalino": "cab.", "Caprino": "cab.", "Codornas": "cab.", "Equino": "cab.",
    "Galináceos - galinhas": "cab.", "Galináceos - total": "cab.", "Ovino": "cab.",
    "Suíno - matrizes de suínos": "cab.", "Suíno - total": "cab.",
    "Leite": "mil L", "Ovos de galinha": "mil dz", "Ovos de codorna": "mil dz",
    "Mel de abelha": "kg", "Casulos do bicho-da-seda": "kg", "Lã": "kg",
}

# Survey tables, their row type and the names of their variable codes.
SURVEY_TABLES = {
    3939: {"kind": "Rebanho", "variables": {"105": "Efetivo_Cabecas"}},
    74: {"kind": "Producao", "variables": {"106": "Quantidade", "215": "Valor_mil_reais"}},
}
FIRST_YEAR = 2004
LAST_YEAR = 2024

# Texts that mean "no value" in the survey tables.
NUMERIC_SENTINELS = ["-", "..", "...", "X", "", "nd"]
PERIOD_SENTINELS = ["", "...", "-"]

# Candidate names of the municipality-name column, in order of preference.
MUNICIPALITY_NAME_COLUMNS = [
    "Municipio", "Nome_Municipio", "municipio", "nome_municipio", "MUNICIPIO",
]

# Two 7-step palettes (country map; state and micro-region maps).
PALETTE_COUNTRY = ["#ffffb2", "#fed976", "#feb24c", "#fd8d3c", "#fc4e2a", "#e31a1c", "#800026"]
PALETTE_REGION = ["#fdd49e", "#fdbb84", "#fc8d59", "#ef6548", "#d7301f", "#b30000", "#7f0000"]

# Group codes.
ALL, TEM, PER, COL, TRA = "ALL", "TEM", "PER", "COL", "TRA"
