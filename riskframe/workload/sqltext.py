"""SQL twins of the shared fixtures, written for an ANSI engine."""

from __future__ import annotations

from riskframe.plans.crash_schema import (
    FEATURE_COLUMNS,
    PEOPLE,
    RAW_COLUMNS,
    ROADS,
    UNTRUSTED,
    VEHICLES,
)
from riskframe.plans.feed import COUNT_MODULI


def _count(modulus: int) -> str:
    return (
        f"CASE e % {modulus} WHEN 0 THEN '' WHEN 1 THEN NULL WHEN 2 THEN ' 1 ' WHEN 3 THEN '2' "
        "WHEN 4 THEN '00' WHEN 5 THEN 'x' ELSE '0' END"
    )


_COUNTS = ",\n  ".join(f"{_count(m)} AS {c}" for c, m in COUNT_MODULI.items())

FEED = f"""
ev AS (
  SELECT event_id AS e, user_id, event_type, ts, hour(ts) AS h, minute(ts) AS mi,
    lpad(CAST(hour(ts) AS VARCHAR), 2, '0') AS hh, lpad(CAST(minute(ts) AS VARCHAR), 2, '0') AS mm,
    CAST(CASE WHEN hour(ts) % 12 = 0 THEN 12 ELSE hour(ts) % 12 END AS VARCHAR) AS h12,
    CAST(event_id % 601 AS VARCHAR) AS k
  FROM events
),
once AS (
  SELECT e,
  'C' || CAST(user_id % 5 AS VARCHAR) AS Concessionaria,
  strftime(ts, '%d/%m/%y') AS Data,
  CASE e % 7
    WHEN 0 THEN h12 || ':' || mm || ':00 ' || CASE WHEN h < 12 THEN 'AM' ELSE 'PM' END
    WHEN 1 THEN hh || ':' || mm
    WHEN 2 THEN CAST(h AS VARCHAR) || ':' || mm
    WHEN 3 THEN hh || ':' || mm || 'h'
    WHEN 4 THEN chr(9) || hh || ':' || mm || ':00' || chr(160)
    WHEN 5 THEN hh || ':' || mm || ':30h'
    ELSE 'N/A' END AS Horario,
  CASE WHEN e % 3 = 0 THEN ' ' ELSE '' END || CAST(e % 997 AS VARCHAR) ||
    CASE WHEN e % 7 = 0 THEN '-' || CAST(e % 4 AS VARCHAR) WHEN e % 11 = 0 THEN '.5' ELSE '' END ||
    CASE e % 5 WHEN 0 THEN chr(160) WHEN 1 THEN chr(9) WHEN 2 THEN chr(13) ELSE '' END
    AS No_DaOcorrencia,
  CASE e % 4 WHEN 0 THEN 'Acidente sem vítima' WHEN 1 THEN '3 - Acidente com Danos Materiais'
    WHEN 2 THEN 'ACIDENTE COM VITIMA' ELSE '1 - Sem Vitima' END AS TipoDeOcorrencia,
  CASE e % 8 WHEN 0 THEN '' WHEN 1 THEN NULL WHEN 2 THEN k || ',5' WHEN 3 THEN k || '+250'
    WHEN 4 THEN '  ' || k || ' ' WHEN 5 THEN '1.234,5' WHEN 6 THEN k || '.49' ELSE 'abc' END AS Km,
  CASE e % 6 WHEN 0 THEN 'SP-BR116' WHEN 1 THEN 'BR-116/SP' WHEN 2 THEN 'BR-116/SP EXP'
    WHEN 3 THEN 'BR-116/SP MARG' WHEN 4 THEN 'BR-381/SP' ELSE 'BR-116/PR' END AS Trecho,
  CASE e % 6 WHEN 0 THEN 'Norte' WHEN 1 THEN 'SUL' WHEN 2 THEN 'Pista Norte' WHEN 3 THEN 'N/A'
    WHEN 4 THEN '' ELSE NULL END AS Sentido,
  event_type AS TipoDeAcidente,
  {_COUNTS}
  FROM ev
),
feed AS (
  SELECT {", ".join(RAW_COLUMNS)}
  FROM (SELECT *, unnest(range(CASE WHEN e % 10 = 0 THEN 2 ELSE 1 END)) AS copy FROM once) t
)"""

INVISIBLE = "chr(160) || chr(9) || chr(13) || chr(10)"
STRIP_ALL = f"translate({{0}}, ' ' || {INVISIBLE}, '')"
STRIP_INVISIBLE = f"trim(translate({{0}}, {INVISIBLE}, ''), ' ')"
_TIME = "^ *([0-9]{{1,2}}):([0-9]{{1,2}})(:([0-9]{{1,2}}))? *$".replace("{{", "{").replace("}}", "}")


def tm(x: str) -> str:
    """Seconds of day of a 24-hour time text."""

    def part(group):
        return f"TRY_CAST(regexp_extract({x}, '{_TIME}', {group}) AS INT)"

    return (
        f"CASE WHEN {part(1)} < 24 AND {part(2)} < 60 AND coalesce({part(4)}, 0) < 60 "
        f"THEN {part(1)} * 3600 + {part(2)} * 60 + coalesce({part(4)}, 0) END"
    )


def without(x: str, token: str) -> str:
    return f"regexp_replace({x}, '(?i){token}', '', 'g')"


def unified(x: str) -> str:
    """Clock text with a trailing h rewritten."""
    bare = without(x, "h")
    return (
        f"CASE WHEN lower({x}) LIKE '%h' THEN CASE WHEN {tm(bare)} BETWEEN 0 AND 43140 "
        f"THEN {bare} || 'AM' WHEN {tm(bare)} BETWEEN 43200 AND 86340 THEN {bare} ELSE {x} END "
        f"ELSE {x} END"
    )


def clock(x: str) -> str:
    """Seconds of day of unified clock text."""
    pm = without(x, "PM")
    return (
        f"CASE WHEN upper({x}) LIKE '%AM' THEN {tm(without(x, 'AM'))} "
        f"WHEN upper({x}) LIKE '%PM' THEN CASE WHEN left({pm}, 2) = '12' THEN {tm(pm)} "
        f"ELSE (({tm(pm)}) + 43200) % 86400 END ELSE {tm(x)} END"
    )


def integer(x: str) -> str:
    return f"CASE WHEN regexp_full_match({x}, ' *[+-]?[0-9]+ *') THEN TRY_CAST(trim({x}) AS INT) END"


def km(x: str) -> str:
    text = f"CASE WHEN {x} IS NULL OR trim({x}) = '' THEN '0' ELSE trim({x}) END"
    text = f"replace(replace({text}, ',', '.'), '+', '.')"
    return (
        f"CASE WHEN regexp_full_match({text}, '[+-]?([0-9]+[.]?[0-9]*|[.][0-9]+)') "
        f"THEN CAST(round(CAST({text} AS DOUBLE)) AS DOUBLE) END"
    )


def flag(x: str) -> str:
    return f"CASE WHEN trim({x}) = '' THEN '' WHEN ({integer(x)}) >= 1 THEN '1' ELSE '0' END"


def any_flag(*names: str) -> str:
    blank = " AND ".join(f"trim({c}) = ''" for c in names)
    hit = " OR ".join(f"({integer(c)}) >= 1" for c in names)
    return f"CASE WHEN {blank} THEN '' WHEN {hit} THEN '1' ELSE '0' END"


def occurrence(x: str) -> str:
    return (
        f"CASE WHEN strpos({x}, '-') > 0 THEN left({x}, strpos({x}, '-') - 1) || '00' "
        f"ELSE {x} || '01' END"
    )


DAYPART = (
    "CASE WHEN {0} < 21600 THEN 'madrugada' WHEN {0} < 43200 THEN 'manha' "
    "WHEN {0} < 64800 THEN 'vespertino' WHEN {0} < 86400 THEN 'noturno' END"
)
VICTIM = (
    "CASE WHEN "
    + " OR ".join(f"({integer(c)}) > 0" for c in PEOPLE[1:])
    + " THEN 'Com vitima' WHEN lower(TipoDeOcorrencia) LIKE '%sem vitima%' "
    "OR lower(TipoDeOcorrencia) LIKE '%sem vítima%' "
    "OR lower(TipoDeOcorrencia) LIKE '%danos materiais%' THEN 'Sem vitima' ELSE 'Com vitima' END"
)
REGION = (
    "CASE WHEN Trecho = 'SP-BR116' THEN 'CAPITAL TRECHO NORMAL' "
    "WHEN Trecho = 'BR-116/SP EXP' THEN 'CAPITAL TIETEPINHEIROS EXP' "
    "WHEN Trecho = 'BR-116/SP MARG' THEN 'CAPITAL TIETEPINHEIROS MARG' ELSE 'FORA DA CAPITAL' END"
)
DIRECTION = (
    "CASE WHEN lower(Sentido) LIKE '%norte%' THEN 'NORTE' "
    "WHEN lower(Sentido) LIKE '%sul%' THEN 'SUL' END"
)
_ROAD_LIST = ", ".join(f"'{r}'" for r in ROADS)
_CLEANED = ", ".join(
    f"{STRIP_ALL.format(c)} AS {c}" if c == "No_DaOcorrencia" else c for c in RAW_COLUMNS
)

# Distinct records with cleaned id and seconds of day.
RECORDS = f"""{FEED},
uniq AS (SELECT DISTINCT {_CLEANED} FROM feed),
timed AS (
  SELECT * EXCLUDE (Horario), {STRIP_INVISIBLE.format("Horario")} AS Horario,
    translate({occurrence("No_DaOcorrencia")}, '.,;/-', '') AS Num_Ocorrencia,
    CASE WHEN strpos(No_DaOcorrencia, '-') > 0 THEN 'Contorno' ELSE 'Normal' END AS Pista,
    CAST(strptime(Data, '%d/%m/%y') AS DATE) AS DataRef
  FROM uniq
),
unified AS (SELECT *, {unified("Horario")} AS HorarioAMPM FROM timed),
records AS (SELECT *, {clock("HorarioAMPM")} AS HorarioPadrao FROM unified)"""

_FLAGS = ",\n    ".join(f"{flag(c)} AS {c}_bin" for c in (*VEHICLES, *PEOPLE))

# Every derived column, before the second de-duplication; roads not filtered yet.
DERIVED = f"""{RECORDS},
derived AS (
  SELECT *, {km("Km")} AS KmDecimal, {REGION} AS TrechoRegiao,
    CASE WHEN {REGION} = 'FORA DA CAPITAL' THEN 'FORA DA CAPITAL' ELSE 'CAPITAL' END
      AS TrechoRegiao2,
    {DIRECTION} AS SentidoPadrao, {VICTIM} AS TipoDeOcorrenciaPadrao,
    {DAYPART.format("HorarioPadrao")} AS Periodo,
    {_FLAGS},
    {any_flag("Gravemente_feridos", "Mortos")} AS Gravemente_feridos_Mortos,
    {any_flag(*reversed(PEOPLE[1:]))} AS Vitimas
  FROM records
),
road AS (SELECT * FROM derived WHERE Trecho IN ({_ROAD_LIST}))"""

_KEYS = [c for c in FEATURE_COLUMNS if c not in UNTRUSTED]
_ORDER = ", ".join(f"{c} NULLS FIRST" for c in UNTRUSTED)

# The 35-column feature table.
FEATURES = f"""{DERIVED},
ranked AS (
  SELECT {", ".join(FEATURE_COLUMNS)},
    row_number() OVER (PARTITION BY {", ".join(_KEYS)} ORDER BY {_ORDER}) AS rn
  FROM road
),
features AS (SELECT {", ".join(FEATURE_COLUMNS)} FROM ranked WHERE rn = 1)"""

SCORED = """
scored AS (
  SELECT *, round(l_quantity / 50 + l_tax, 2) AS p,
    CASE WHEN (l_partkey * 37) % 29 < 2 THEN 1 ELSE 0 END AS y
  FROM lineitem
)"""

PLANTED = """
planted AS (
  SELECT *,
    CASE WHEN (l_partkey * 37) % 100 <
      CASE l_returnflag WHEN 'R' THEN 20 WHEN 'A' THEN 5 ELSE 2 END THEN 1 ELSE 0 END AS y,
    CASE WHEN (l_partkey * 37) % 100 < CASE WHEN l_quantity > 25 THEN 30 ELSE 5 END
      THEN 1 ELSE 0 END AS y_quantity
  FROM lineitem
)"""


def curve(source: str, y: str = "y", p: str = "p") -> str:
    """CTEs ``cells`` and ``curve``: running sums per distinct score from the top."""
    return f"""
cells AS (
  SELECT {p} AS score, CAST(count(*) AS DOUBLE) AS n, CAST(sum({y}) AS DOUBLE) AS n1
  FROM {source} WHERE {p} IS NOT NULL AND {y} IS NOT NULL GROUP BY {p}
),
curve AS (
  SELECT score, n, n1, n - n1 AS n0,
    sum(n) OVER w AS n_run, sum(n1) OVER w AS n1_run, sum(n - n1) OVER w AS n0_run,
    sum(n) OVER () AS n_all, sum(n1) OVER () AS n1_all, sum(n - n1) OVER () AS n0_all
  FROM cells
  WINDOW w AS (ORDER BY score DESC ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)
)"""


KS = "max(abs(n1_run / n1_all - n0_run / n0_all))"


def ks_in_groups(groups: int = 10) -> str:
    """KS of ``curve`` read where the edges of equal-size groups fall inside a score."""
    return f"""(SELECT max(abs(taken / n1_all - (edge - taken) / n0_all)) FROM (
      SELECT *, n1_run - n1 + n1 * (edge - (n_run - n)) / n AS taken FROM (
        SELECT *, g * n_all / {groups} AS edge FROM (SELECT *, unnest(range(1, {groups + 1})) AS g FROM curve))
      WHERE edge > n_run - n AND edge <= n_run))"""


AUC = "sum(n1 * (n0_all - n0_run + n0 / 2)) / max(n1_all * n0_all)"
