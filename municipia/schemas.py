"""Column names of the files, their types, and the canonical names used inside."""

from __future__ import annotations

from pyspark.sql import types as T

# Canonical crop columns: source name -> (canonical name, type). Codes stay text.
CROP_COLUMNS = {
    "Cod_Municipio": ("mun", "string"),
    "UF": ("uf_file", "string"),
    "Cod_Microrregiao": ("mic", "string"),
    "Microrregiao": ("mic_name", "string"),
    "Cod_Mesorregiao": ("meso", "string"),
    "Mesorregiao": ("meso_name", "string"),
    "Ano": ("year", "int"),
    "Cultura": ("category", "string"),
    "Area_Colhida_ha": ("a", "double"),
    "Quantidade_Produzida_ton": ("p", "double"),
    "Valor_Producao_mil_reais": ("v", "double"),
    "Rendimento_Medio_kg_ha": ("r", "double"),
}

# Livestock index columns, shared by the long and the wide form.
LIVESTOCK_INDEX = {
    "Cod_Municipio": ("mun", "string"),
    "Municipio": ("mun_name", "string"),
    "UF": ("uf", "string"),
    "Regiao": ("region", "string"),
    "Ano": ("year", "int"),
    "Tipo": ("kind", "string"),
    "Cod_Categoria": ("category_code", "string"),
    "Categoria": ("category", "string"),
}
LIVESTOCK_LONG = {**LIVESTOCK_INDEX, "Variavel": ("variable", "string"), "Valor": ("value", "double")}
LIVESTOCK_MEASURES = ("Efetivo_Cabecas", "Quantidade", "Valor_mil_reais")
LIVESTOCK_WIDE = {**LIVESTOCK_INDEX, **{name: (name, "double") for name in LIVESTOCK_MEASURES}}

# Raw slice as landed: one CSV per (table, year), all columns as text.
RAW_SLICE_SCHEMA = T.StructType([T.StructField(name, T.StringType()) for name in LIVESTOCK_LONG])

LOCALITY_SCHEMA = T.StructType([
    T.StructField("id", T.LongType()),
    T.StructField("microrregiao", T.StructType([T.StructField("id", T.LongType())])),
])

# Geometry is declared as text so that mixed polygon kinds pass through unread and unchanged.
GEO_SCHEMA = "features array<struct<type:string,properties:struct<codarea:string>,geometry:string>>"
API_PAYLOAD = "array<map<string,string>>"
