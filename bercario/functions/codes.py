"""Code tables of the birth registry and the lookup that decodes them.

The tables are fixed values: the labels are part of the stored results, so they keep
their Portuguese spelling, accents and punctuation.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column
from pyspark.sql import functions as F

# mother's education.
EDUCATION = {
    0: "Sem Escolaridade",
    1: "Fundamental I Incompleto",
    2: "Fundamental I Completo",
    3: "Fundamental II Incompleto",
    4: "Fundamental II Completo",
    5: "Ensino Médio Incompleto",
    6: "Ensino Médio Completo",
    7: "Superior Incompleto",
    8: "Superior Completo",
    9: "Ignorado",
    10: "Fundamental I Incompleto ou Inespecífico",
    11: "Fundamental II Incompleto ou Inespecífico",
    12: "Ensino Médio Incompleto ou Inespecífico",
}

# Number of prenatal visits.
VISITS = {1: "Nenhuma", 2: "de 1 a 3", 3: "de 4 a 6", 4: "7 e mais", 9: "Ignorado"}

# Sex of the newborn (the dash is U+2013).
SEX = {0: "I – Ignorado", 1: "M – Masculino", 2: "F – Feminino"}

# Type of delivery.
DELIVERY = {1: "Vaginal", 2: "Cesário", 9: "Ignorado"}

# Weeks of gestation.
GESTATION = {
    1: "Menos de 22 semanas",
    2: "22 a 27 semanas",
    3: "28 a 31 semanas",
    4: "32 a 36 semanas",
    5: "37 a 41 semanas",
    6: "42 semanas e mais",
    9: "Ignorado",
}

# Type of pregnancy. The keys are text; no star table uses this one.
PREGNANCY = {"1": "Única", "2": "Dupla", "3": "Tripla ou mais", "9": "Ignorado"}

# Race, of the mother and of the newborn.
RACE = {1: "Branca", 2: "Preta", 3: "Amarela", 4: "Parda", 5: "Indígena"}

# mother's marital status.
MARITAL_STATUS = {
    1: "Solteira",
    2: "Casada",
    3: "Viúva",
    4: "Separada judicialmente/divorciada",
    5: "União estável",
    9: "Ignorada",
}

# Kind of place where the birth happened.
BIRTH_PLACE = {
    1: "Hospital",
    2: "Outros estabelecimentos de saúde",
    3: "Domicílio",
    4: "Outros",
    5: "Aldeia Indígena",
}

# The states of Brazil by region, full name to abbreviation.
STATES_BY_REGION = {
    "Norte": {
        "Acre": "AC", "Amapá": "AP", "Amazonas": "AM", "Pará": "PA", "Rondônia": "RO",
        "Roraima": "RR", "Tocantins": "TO",
    },
    "Nordeste": {
        "Alagoas": "AL", "Bahia": "BA", "Ceará": "CE", "Maranhão": "MA", "Paraíba": "PB",
        "Pernambuco": "PE", "Piauí": "PI", "Rio Grande do Norte": "RN", "Sergipe": "SE",
    },
    "Centro-Oeste": {
        "Distrito Federal": "DF", "Goiás": "GO", "Mato Grosso": "MT", "Mato Grosso do Sul": "MS",
    },
    "Sudeste": {
        "Espírito Santo": "ES", "Minas Gerais": "MG", "Rio de Janeiro": "RJ", "São Paulo": "SP",
    },
    "Sul": {"Paraná": "PR", "Rio Grande do Sul": "RS", "Santa Catarina": "SC"},
}

STATES = {name: uf for states in STATES_BY_REGION.values() for name, uf in states.items()}
REGIONS = {uf: region for region, states in STATES_BY_REGION.items() for uf in states.values()}

UNKNOWN = "Desconhecido"


def decode(code: Column, table: Mapping) -> Column:
    """Label of ``code``; NULL for a code the table does not have.

    The table becomes one constant map inside the generated code: no join, no shuffle.
    """
    pairs = [F.lit(item) for pair in table.items() for item in pair]
    return F.create_map(*pairs)[code]


def label_or_unknown(label: Column) -> Column:
    """The bucket a report puts a missing label in."""
    return F.coalesce(label, F.lit(UNKNOWN))
