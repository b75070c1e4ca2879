"""Schemas of the crash tables.

Fixed values: column names, road codes, labels, kilometre breaks and level
lists below must equal those of the data being replaced.
"""

from __future__ import annotations

from pyspark.sql import types as T

from riskframe.spec import FeatureSpec

VEHICLES = ("Automovel", "Bicicleta", "Caminhao", "Moto", "Onibus", "Outros", "Utilitario")
PEOPLE = ("Ilesos", "Levemente_feridos", "Moderadamente_feridos", "Gravemente_feridos", "Mortos")

RAW_COLUMNS = (
    "Concessionaria",
    "Data",
    "Horario",
    "No_DaOcorrencia",
    "TipoDeOcorrencia",
    "Km",
    "Trecho",
    "Sentido",
    "TipoDeAcidente",
    "Automovel",
    "Bicicleta",
    "Caminhao",
    "Moto",
    "Onibus",
    "Outros",
    "Tracao_animal",
    "Transp__Cargas_Especiais",
    "Trator__maquinas",
    "Utilitario",
    "Ilesos",
    "Levemente_feridos",
    "Moderadamente_feridos",
    "Gravemente_feridos",
    "Mortos",
)
RAW_SCHEMA = T.StructType([T.StructField(c, T.StringType()) for c in RAW_COLUMNS])

ROADS = ("SP-BR116", "BR-116/SP", "BR-116/SP EXP", "BR-116/SP MARG")
REGIONS = {
    "SP-BR116": "CAPITAL TRECHO NORMAL",
    "BR-116/SP EXP": "CAPITAL TIETEPINHEIROS EXP",
    "BR-116/SP MARG": "CAPITAL TIETEPINHEIROS MARG",
}
OUTSIDE = "FORA DA CAPITAL"
INSIDE = "CAPITAL"
DIRECTIONS = (("Norte", "NORTE"), ("Sul", "SUL"))
LANE_SPLIT, LANE_NORMAL = "Contorno", "Normal"
WITH_VICTIM, WITHOUT_VICTIM = "Com vitima", "Sem vitima"
NO_VICTIM_TEXTS = ("sem vitima", "sem vítima", "danos materiais")

FLAGS = tuple(f"{c}_bin" for c in (*VEHICLES, *PEOPLE))
SEVERE = "Gravemente_feridos_Mortos"
FEATURE_COLUMNS = (
    "Concessionaria",
    "Num_Ocorrencia",
    "DataRef",
    "Periodo",
    "Trecho",
    "Pista",
    "KmDecimal",
    "SentidoPadrao",
    *VEHICLES,
    *PEOPLE,
    *FLAGS,
    "TipoDeOcorrenciaPadrao",
    "Vitimas",
    SEVERE,
)
# Not part of the identity of an accident when features are de-duplicated.
UNTRUSTED = ("Num_Ocorrencia", "SentidoPadrao")

KM_BREAKS_FIRST = (0, 50, 100, 150, 200, 225, 250, 300, 350, 400, 450, 500, 600)
KM_BREAKS = (0, 25, 50, 75, 100, 125, 150, 175, 200, 225, 250, 300, 400, 500, 600)
KM_LEVELS = ("[0,25]", *[f"({a},{b}]" for a, b in zip(KM_BREAKS[1:], KM_BREAKS[2:])])
DAYPART_LEVELS = ("madrugada", "manha", "noturno", "vespertino")

CRASH_SPEC = FeatureSpec(
    target=SEVERE,
    numeric=VEHICLES,
    levels={"Periodo": DAYPART_LEVELS, "Km_cat": KM_LEVELS},
    key="Chave",
)
MODEL_COLUMNS = (*VEHICLES, "Periodo", "Km_cat", SEVERE, "Chave")

BASELINE_SCHEMA = T.StructType(
    [
        T.StructField("data_treinamento", T.TimestampType()),
        T.StructField("auc_treino", T.DoubleType()),
        T.StructField("auc_teste", T.DoubleType()),
        T.StructField("ks_treino", T.DoubleType()),
        T.StructField("ks_teste", T.DoubleType()),
        T.StructField("cutoff", T.DoubleType()),
    ]
)
MONITORING_SCHEMA = T.StructType(
    [
        T.StructField("carga_id", T.StringType()),
        T.StructField("data_execucao", T.StringType()),
        T.StructField("n_linhas_base_viva", T.LongType()),
        T.StructField("auc_viva", T.DoubleType()),
        T.StructField("ks_viva", T.DoubleType()),
        T.StructField("sensibilidade_viva", T.DoubleType()),
        T.StructField("cutoff_usado", T.DoubleType()),
    ]
)
