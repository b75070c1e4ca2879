"""Dirty crash feed derived row by row from the ``events`` table.

Every event becomes one raw record; each tenth event is delivered twice, as an
exact copy.  Only integer arithmetic and string building are used, so the same
rules can be written in any SQL engine (see ``FIXTURES.md``).
"""

from __future__ import annotations

from pyspark.sql import DataFrame

from riskframe.plans.crash_schema import RAW_COLUMNS

COUNT_MODULI = {
    "Automovel": 7,
    "Bicicleta": 11,
    "Caminhao": 9,
    "Moto": 8,
    "Onibus": 13,
    "Outros": 10,
    "Tracao_animal": 17,
    "Transp__Cargas_Especiais": 19,
    "Trator__maquinas": 23,
    "Utilitario": 12,
    "Ilesos": 6,
    "Levemente_feridos": 14,
    "Moderadamente_feridos": 16,
    "Gravemente_feridos": 18,
    "Mortos": 20,
}


def _pick(selector: str, *choices: str) -> str:
    """The choice at position ``selector``; the last one beyond the list."""
    whens = " ".join(f"WHEN {i} THEN {choice}" for i, choice in enumerate(choices[:-1]))
    return f"CASE {selector} {whens} ELSE {choices[-1]} END"


_HOUR = "hour(ts)"
_HH = f"lpad(string({_HOUR}), 2, '0')"
_MM = "lpad(string(minute(ts)), 2, '0')"
_H12 = f"string(if({_HOUR} % 12 = 0, 12, {_HOUR} % 12))"
_K = "string(event_id % 601)"

_RULES = {
    "Concessionaria": "'C' || string(user_id % 5)",
    "Data": "lpad(string(day(ts)), 2, '0') || '/' || lpad(string(month(ts)), 2, '0') || '/' "
    "|| lpad(string(year(ts) % 100), 2, '0')",
    "Horario": _pick(
        "event_id % 7",
        f"{_H12} || ':' || {_MM} || ':00 ' || if({_HOUR} < 12, 'AM', 'PM')",
        f"{_HH} || ':' || {_MM}",
        f"string({_HOUR}) || ':' || {_MM}",
        f"{_HH} || ':' || {_MM} || 'h'",
        f"chr(9) || {_HH} || ':' || {_MM} || ':00' || chr(160)",
        f"{_HH} || ':' || {_MM} || ':30h'",
        "'N/A'",
    ),
    "No_DaOcorrencia": "if(event_id % 3 = 0, ' ', '') || string(event_id % 997) || "
    "CASE WHEN event_id % 7 = 0 THEN '-' || string(event_id % 4) "
    "WHEN event_id % 11 = 0 THEN '.5' ELSE '' END || "
    + _pick("event_id % 5", "chr(160)", "chr(9)", "chr(13)", "''"),
    "TipoDeOcorrencia": _pick(
        "event_id % 4",
        "'Acidente sem vítima'",
        "'3 - Acidente com Danos Materiais'",
        "'ACIDENTE COM VITIMA'",
        "'1 - Sem Vitima'",
    ),
    "Km": _pick(
        "event_id % 8",
        "''",
        "NULL",
        f"{_K} || ',5'",
        f"{_K} || '+250'",
        f"'  ' || {_K} || ' '",
        "'1.234,5'",
        f"{_K} || '.49'",
        "'abc'",
    ),
    "Trecho": _pick(
        "event_id % 6",
        "'SP-BR116'",
        "'BR-116/SP'",
        "'BR-116/SP EXP'",
        "'BR-116/SP MARG'",
        "'BR-381/SP'",
        "'BR-116/PR'",
    ),
    "Sentido": _pick("event_id % 6", "'Norte'", "'SUL'", "'Pista Norte'", "'N/A'", "''", "NULL"),
    "TipoDeAcidente": "event_type",
} | {
    name: _pick(f"event_id % {modulus}", "''", "NULL", "' 1 '", "'2'", "'00'", "'x'", "'0'")
    for name, modulus in COUNT_MODULI.items()
}


def crash_feed(events: DataFrame) -> DataFrame:
    once = events.selectExpr(
        *[f"{_RULES[name]} AS {name}" for name in RAW_COLUMNS],
        "array_repeat(0, if(event_id % 10 = 0, 2, 1)) AS _copies",
    )
    return once.selectExpr(*RAW_COLUMNS, "explode(_copies) AS _copy").drop("_copy")
