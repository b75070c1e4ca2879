"""Scalar functions, derived columns, filters and the cleaning plans."""

from __future__ import annotations

from pyspark.sql import functions as F

from riskframe.functions import clock, flags, numbers, text
from riskframe.operators import columns as cols
from riskframe.operators.dedupe import distinct_rows, duplicate_report, keep_first
from riskframe.plans import cleaning as plan
from riskframe.plans import crash_schema as cs
from riskframe.workload import sqltext as sq
from riskframe.workload.registry import feed, query, rounded, table

c = F.col


def on_feed(name: str, **outputs):
    """Register a projection of the feed: output name -> (column, SQL expression)."""
    names = list(outputs)
    select = ", ".join(f"{outputs[n][1]} AS {n}" for n in names)

    @query(name, f"WITH {sq.FEED} SELECT {select} FROM feed")
    def run(spark, sf_dir):
        return feed(spark, sf_dir).select(*[outputs[n][0]().alias(n) for n in names])

    return run


def same(column):
    return (lambda: c(column), column)


NO = "No_DaOcorrencia"
_STRIPPED = sq.STRIP_ALL.format(NO)
_CLOCK_TEXT = sq.STRIP_INVISIBLE.format("Horario")

on_feed(
    "sca1_strip_all",
    raw=same(NO),
    cleaned=(lambda: text.strip_all(c(NO)), _STRIPPED),
)
on_feed(
    "sca2_strip_invisible",
    raw=same("Horario"),
    cleaned=(lambda: text.strip_invisible(c("Horario")), _CLOCK_TEXT),
)
on_feed(
    "sca3_strip_punctuation",
    cleaned=(
        lambda: text.strip_punctuation(text.strip_all(c(NO))),
        f"translate({_STRIPPED}, '.,;/-', '')",
    ),
    km=(lambda: text.strip_punctuation(c("Km")), "translate(Km, '.,;/-', '')"),
)
on_feed(
    "sca4_trim",
    km=(lambda: F.trim("Km"), "trim(Km, ' ')"),
    automovel=(lambda: F.trim("Automovel"), "trim(Automovel, ' ')"),
)
on_feed(
    "sca5_decimal_point",
    km=(
        lambda: numbers.decimal_point(F.trim("Km")),
        "replace(replace(trim(Km, ' '), ',', '.'), '+', '.')",
    ),
)
on_feed(
    "sca6_positions",
    at=(lambda: F.instr(NO, "-").cast("long"), f"strpos({NO}, '-')"),
    head=(lambda: F.left(NO, F.lit(2)), f"left({NO}, 2)"),
    body=(lambda: F.substring(NO, 2, 3), f"substring({NO}, 2, 3)"),
)
on_feed(
    "sca7_visible_length",
    km=same("Km"),
    size=(
        lambda: text.visible_length(c("Km")).cast("double"),
        "CAST(length(rtrim(Km, ' ')) AS DOUBLE)",
    ),
)
on_feed(
    "sca8_char_codes",
    marked=(
        lambda: F.concat(F.chr(F.lit(9)), c("Trecho"), F.chr(F.lit(160))),
        "chr(9) || Trecho || chr(160)",
    ),
)
on_feed(
    "sca9_concat_null_propagating",
    joined=(lambda: F.concat(c("Trecho"), F.lit(" "), c("Sentido")), "Trecho || ' ' || Sentido"),
)
on_feed(
    "sca10_concat_null_skipping",
    joined=(
        lambda: F.concat_ws("|", "Trecho", "Sentido", "Km", "Mortos"),
        "concat_ws('|', Trecho, Sentido, Km, Mortos)",
    ),
)
on_feed(
    "sca11_nullif_coalesce",
    km=(lambda: F.nullif(F.trim("Km"), F.lit("")), "nullif(trim(Km, ' '), '')"),
    sentido=(lambda: F.coalesce("Sentido", F.lit("Total")), "coalesce(Sentido, 'Total')"),
)
on_feed(
    "sca12_parse_int",
    automovel=(
        lambda: numbers.parse_int(c("Automovel")).cast("double"),
        f"CAST({sq.integer('Automovel')} AS DOUBLE)",
    ),
    mortos=(
        lambda: numbers.parse_int(c("Mortos")).cast("double"),
        f"CAST({sq.integer('Mortos')} AS DOUBLE)",
    ),
    bare_time=(
        lambda: clock.seconds_of_day(
            text.replace_any_case(text.replace_any_case(c("Horario"), "AM"), "PM")
        ).cast("double"),
        f"CAST({sq.tm(sq.without(sq.without('Horario', 'AM'), 'PM'))} AS DOUBLE)",
    ),
)
on_feed(
    "sca13_parse_day",
    raw=same("Data"),
    day=(
        lambda: clock.parse_day(c("Data")).cast("string"),
        "CAST(CAST(strptime(Data, '%d/%m/%y') AS DATE) AS VARCHAR)",
    ),
)
on_feed(
    "sca14_parse_km",
    raw=same("Km"),
    km=(lambda: numbers.parse_km(c("Km")).cast("double"), sq.km("Km")),
)


@query(
    "sca15_add_hours",
    """SELECT event_id,
      (hour(ts) * 3600 + minute(ts) * 60 + second(ts) + 43200) % 86400 AS shifted FROM events""",
)
def sca15(spark, sf_dir):
    at = F.hour("ts") * 3600 + F.minute("ts") * 60 + F.second("ts")
    return table(spark, sf_dir, "events").select(
        "event_id", clock.add_hours(at, 12).cast("long").alias("shifted")
    )


@query(
    "sca16_parse_clock",
    f"""WITH {sq.FEED},
    t AS (SELECT {_CLOCK_TEXT} AS raw FROM feed),
    u AS (SELECT raw, {sq.unified("raw")} AS x FROM t)
    SELECT raw, CAST({sq.clock("x")} AS DOUBLE) AS seconds FROM u""",
)
def sca16(spark, sf_dir):
    rows = feed(spark, sf_dir).select(text.strip_invisible(c("Horario")).alias("raw"))
    return clock.add_clock(rows, "raw", "seconds").withColumn("seconds", c("seconds").cast("double"))


on_feed(
    "sca17_case",
    simple=(
        lambda: flags.map_values(c("Trecho"), cs.REGIONS, cs.OUTSIDE),
        sq.REGION,
    ),
    searched=(
        lambda: F.when(c("Km").isNull(), "null").when(c("Km") == "", "blank").otherwise("text"),
        "CASE WHEN Km IS NULL THEN 'null' WHEN Km = '' THEN 'blank' ELSE 'text' END",
    ),
)
on_feed(
    "sca18_paste_ifelse",
    pasted=(
        lambda: text.composite_key(c("Concessionaria"), c("Sentido"), sep="_"),
        "Concessionaria || '_' || coalesce(Sentido, 'NA')",
    ),
    chosen=(
        lambda: F.when(c("Sentido") == "SUL", 1.0).when(c("Sentido") != "SUL", 0.0),
        "CASE WHEN Sentido = 'SUL' THEN 1.0::DOUBLE WHEN Sentido <> 'SUL' THEN 0.0::DOUBLE END",
    ),
)
on_feed(
    "sca19_casts",
    number=(
        lambda: numbers.parse_double(numbers.decimal_point(c("Km"))),
        "CASE WHEN regexp_full_match(replace(replace(Km, ',', '.'), '+', '.'), "
        "' *[0-9]+[.]?[0-9]* *') "
        "THEN TRY_CAST(trim(replace(replace(Km, ',', '.'), '+', '.')) AS DOUBLE) END",
    ),
    code=(lambda: c("Data").substr(1, 2).try_cast("int").cast("long"), "CAST(left(Data, 2) AS BIGINT)"),
)


@query(
    "sca20_metric_arithmetic",
    """SELECT l_orderkey, l_linenumber, l_extendedprice / nullif(l_quantity, 0) AS unit,
      l_discount / nullif(l_tax, 0) AS relative FROM lineitem""",
)
def sca20(spark, sf_dir):
    return table(spark, sf_dir, "lineitem").select(
        "l_orderkey",
        "l_linenumber",
        numbers.ratio(c("l_extendedprice"), c("l_quantity")).alias("unit"),
        numbers.ratio(c("l_discount"), c("l_tax")).alias("relative"),
    )


on_feed(
    "sca21_membership",
    listed=(
        lambda: F.when(c("Sentido").isin("Norte", "SUL"), "yes").otherwise("no"),
        "CASE WHEN Sentido IN ('Norte', 'SUL') THEN 'yes' ELSE 'no' END",
    ),
    missing=(
        lambda: F.when(c("Sentido").isNull(), "yes").otherwise("no"),
        "CASE WHEN Sentido IS NULL THEN 'yes' ELSE 'no' END",
    ),
)

# --- projections and derived columns -------------------------------------------------

on_feed("prj1_select", **{n: same(n) for n in ("Concessionaria", "Data", "Trecho", "Km")})


@query(
    "prj2_add_columns",
    f"""WITH {sq.RECORDS} SELECT Num_Ocorrencia, Pista, CAST(DataRef AS VARCHAR) AS DataRef,
    CAST(HorarioPadrao AS DOUBLE) AS HorarioPadrao FROM records""",
)
def prj2(spark, sf_dir):
    records = plan.add_time(plan.distinct_records(feed(spark, sf_dir)))
    return records.select(
        "Num_Ocorrencia",
        "Pista",
        c("DataRef").cast("string").alias("DataRef"),
        c("HorarioPadrao").cast("double").alias("HorarioPadrao"),
    )


@query(
    "prj3_rewrite_where",
    f"""WITH {sq.FEED} SELECT Trecho,
    CASE WHEN trim(Km, ' ') = '' OR Km IS NULL THEN '0' ELSE trim(Km, ' ') END AS Km FROM feed""",
)
def prj3(spark, sf_dir):
    trimmed = cols.rewrite(feed(spark, sf_dir).select("Trecho", "Km"), "Km", F.trim("Km"))
    return cols.rewrite(trimmed, "Km", F.lit("0"), (c("Km") == "") | c("Km").isNull())


@query("prj4_drop_columns", "SELECT * EXCLUDE (l_tax, l_discount) FROM lineitem")
def prj4(spark, sf_dir):
    return table(spark, sf_dir, "lineitem").drop("l_tax", "l_discount", "not_there")


on_feed(
    "prj5_occurrence_number",
    number=(
        lambda: text.occurrence_number(text.strip_all(c(NO))),
        sq.occurrence(_STRIPPED),
    ),
)
on_feed(
    "prj6_presence_label",
    raw=same(NO),
    lane=(
        lambda: text.presence_label(c(NO), "-", cs.LANE_SPLIT, cs.LANE_NORMAL),
        f"CASE WHEN strpos({NO}, '-') > 0 THEN 'Contorno' ELSE 'Normal' END",
    ),
)


@query(
    "prj7_after_hyphen",
    f"""WITH {sq.FEED}, t AS (SELECT {_STRIPPED} AS x FROM feed)
    SELECT x AS raw, substring(x, strpos(x, '-') + 1, length(x)) AS tail
    FROM t WHERE strpos(x, '-') > 0""",
)
def prj7(spark, sf_dir):
    cleaned = feed(spark, sf_dir).select(text.strip_all(c(NO)).alias("raw"))
    return cleaned.where(text.has(c("raw"), "-")).select(
        "raw", text.after_first(c("raw"), "-").alias("tail")
    )


on_feed(
    "prj8_region",
    Trecho=same("Trecho"),
    region=(lambda: flags.map_values(c("Trecho"), cs.REGIONS, cs.OUTSIDE), sq.REGION),
)
on_feed(
    "prj9_region_two_classes",
    region=(
        lambda: flags.map_values(
            flags.map_values(c("Trecho"), cs.REGIONS, cs.OUTSIDE),
            {cs.OUTSIDE: cs.OUTSIDE},
            cs.INSIDE,
        ),
        f"CASE WHEN {sq.REGION} = 'FORA DA CAPITAL' THEN 'FORA DA CAPITAL' ELSE 'CAPITAL' END",
    ),
)
on_feed(
    "prj10_direction",
    raw=same("Sentido"),
    direction=(
        lambda: flags.classify_contains(c("Sentido"), list(cs.DIRECTIONS)),
        sq.DIRECTION,
    ),
)
on_feed(
    "prj11_occurrence_class",
    raw=same("TipoDeOcorrencia"),
    kind=(lambda: plan.occurrence_class(c("TipoDeOcorrencia")), sq.VICTIM),
)
on_feed(
    "prj12_presence_flags",
    **{
        f"{n}_bin": ((lambda n=n: flags.presence_flag(c(n))), sq.flag(n))
        for n in (*cs.VEHICLES, *cs.PEOPLE)
    },
)
on_feed(
    "prj13_severe_target",
    a=same("Gravemente_feridos"),
    b=same("Mortos"),
    target=(
        lambda: flags.any_at_least_one(c("Gravemente_feridos"), c("Mortos")),
        sq.any_flag("Gravemente_feridos", "Mortos"),
    ),
)
on_feed(
    "prj14_victim_target",
    target=(
        lambda: flags.any_at_least_one(*[c(n) for n in cs.PEOPLE[1:]]),
        sq.any_flag(*cs.PEOPLE[1:]),
    ),
)


@query(
    "prj15_daypart",
    f"WITH {sq.RECORDS} SELECT Horario, {sq.DAYPART.format('HorarioPadrao')} AS daypart FROM records",
)
def prj15(spark, sf_dir):
    records = plan.add_time(plan.distinct_records(feed(spark, sf_dir)))
    return records.select("Horario", clock.daypart(c("HorarioPadrao")).alias("daypart"))


KEY_SQL = (
    "coalesce(Concessionaria, 'NA') || '_' || coalesce(Trecho, 'NA') || '_' || "
    "coalesce(Num_Ocorrencia, 'NA') || '_' || coalesce(CAST(DataRef AS VARCHAR), 'NA')"
)


@query("prj16_composite_key", f"WITH {sq.RECORDS} SELECT {KEY_SQL} AS Chave FROM records")
def prj16(spark, sf_dir):
    records = plan.add_time(plan.distinct_records(feed(spark, sf_dir)))
    parts = [c(n) for n in ("Concessionaria", "Trecho", "Num_Ocorrencia", "DataRef")]
    return records.select(text.composite_key(*parts).alias("Chave"))


@query(
    "prj17_blank_to_null",
    f"WITH {sq.FEED} SELECT "
    + ", ".join(f"nullif({n}, '') AS {n}" for n in cs.RAW_COLUMNS)
    + " FROM feed",
)
def prj17(spark, sf_dir):
    return cols.blanks_to_null(feed(spark, sf_dir))


def _double(n):
    number = f"regexp_full_match({n}, ' *[+-]?[0-9]+ *')"
    return f"CASE WHEN {number} THEN CAST(trim({n}) AS DOUBLE) END AS {n}"


@query(
    "prj18_cast_roles",
    f"WITH {sq.FEATURES} SELECT Chave, "
    + ", ".join(_double(n) for n in cs.VEHICLES)
    + f", {_double(cs.SEVERE)}, Periodo FROM (SELECT *, {KEY_SQL} AS Chave FROM features)",
)
def prj18(spark, sf_dir):
    typed = cols.cast_roles(
        plan.typed_features(plan.feature_table(feed(spark, sf_dir))), cs.CRASH_SPEC
    )
    return typed.select(
        "Chave", *cs.VEHICLES, c(cs.SEVERE).cast("double").alias(cs.SEVERE), "Periodo"
    )


@query(
    "prj19_or_flag",
    f"""WITH {sq.FEED}, f AS (
      SELECT Onibus, Caminhao, TRY_CAST(nullif({sq.flag("Onibus")}, '') AS INT) AS a,
        TRY_CAST(nullif({sq.flag("Caminhao")}, '') AS INT) AS b FROM feed)
    SELECT Onibus, Caminhao, CAST(CASE WHEN a = 1 OR b = 1 THEN 1
      WHEN a IS NULL OR b IS NULL THEN NULL ELSE 0 END AS DOUBLE) AS either FROM f""",
)
def prj19(spark, sf_dir):
    def bit(name):
        return text.blank_to_null(flags.presence_flag(c(name))).cast("int")

    return feed(spark, sf_dir).select(
        "Onibus",
        "Caminhao",
        flags.or_flag(bit("Onibus"), bit("Caminhao")).cast("double").alias("either"),
    )


@query(
    "prj20_calendar_parts",
    """SELECT o_orderkey, strftime(o_orderdate, '%m') AS Mes,
    CASE isodow(o_orderdate) WHEN 1 THEN 'segunda-feira' WHEN 2 THEN 'terça-feira'
      WHEN 3 THEN 'quarta-feira' WHEN 4 THEN 'quinta-feira' WHEN 5 THEN 'sexta-feira'
      WHEN 6 THEN 'sábado' ELSE 'domingo' END AS DiaSemana FROM orders""",
)
def prj20(spark, sf_dir):
    dated = table(spark, sf_dir, "orders").select("o_orderkey", c("o_orderdate").cast("date"))
    return cols.calendar_parts(dated, "o_orderdate").select("o_orderkey", "Mes", "DiaSemana")


@query(
    "prj22_stamp_load",
    f"WITH {sq.FEED} SELECT Concessionaria, Km, '2026-02-12 08:00:00' AS carga_id FROM feed",
)
def prj22(spark, sf_dir):
    return cols.stamp_load(
        feed(spark, sf_dir).select("Concessionaria", "Km"), "2026-02-12 08:00:00"
    )


@query(
    "prj23_null_to_zero",
    """SELECT l_orderkey, l_linenumber,
      round(coalesce(l_discount / nullif(l_tax, 0), 0), 6) AS metric FROM lineitem""",
)
def prj23(spark, sf_dir):
    metric = numbers.null_to_zero(numbers.ratio(c("l_discount"), c("l_tax")))
    return table(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_linenumber", F.round(metric, 6).alias("metric")
    )


@query(
    "prj26_rename",
    "SELECT o_orderkey AS chave, o_totalprice AS valor FROM orders",
)
def prj26(spark, sf_dir):
    return (
        table(spark, sf_dir, "orders")
        .select("o_orderkey", "o_totalprice")
        .withColumnRenamed("o_orderkey", "chave")
        .withColumnRenamed("o_totalprice", "valor")
    )


# --- filters -------------------------------------------------------------------------


def filter_feed(name, cond, sql):
    shown = ("Concessionaria", "Horario", "TipoDeOcorrencia", "Km", "Trecho", "Sentido")

    @query(name, f"WITH {sq.FEED} SELECT {', '.join(shown)} FROM feed WHERE {sql}")
    def run(spark, sf_dir):
        return feed(spark, sf_dir).where(cond()).select(*shown)


filter_feed("flt1_equals", lambda: c("Sentido") == "SUL", "Sentido = 'SUL'")
filter_feed("flt2_in_list", lambda: c("Trecho").isin(*cs.ROADS), f"Trecho IN ({sq._ROAD_LIST})")
filter_feed(
    "flt3_like",
    lambda: c("Horario").ilike("%h") | c("Km").startswith("1") | c("Trecho").contains("EXP"),
    "lower(Horario) LIKE '%h' OR Km LIKE '1%' OR Trecho LIKE '%EXP%'",
)
filter_feed(
    "flt4_unparseable",
    lambda: c("Horario").isNotNull() & clock.seconds_of_day(c("Horario")).isNull(),
    f"Horario IS NOT NULL AND ({sq.tm('Horario')}) IS NULL",
)
filter_feed(
    "flt5_time_between",
    lambda: clock.seconds_of_day(c("Horario")).between(0, 11 * 3600 + 59 * 60),
    f"({sq.tm('Horario')}) BETWEEN 0 AND 43140",
)
filter_feed(
    "flt6_length", lambda: text.visible_length(c("Horario")) == 5, "length(rtrim(Horario, ' ')) = 5"
)
filter_feed(
    "flt12_combined",
    lambda: (c("Km").isNull() | (c("Km") == "")) & c("Sentido").isNotNull(),
    "(Km IS NULL OR Km = '') AND Sentido IS NOT NULL",
)

_TARGET_SQL = f"nullif({sq.any_flag('Gravemente_feridos', 'Mortos')}, '')"


@query(
    "flt7_drop_null_target",
    f"""WITH {sq.FEED}, f AS (SELECT Trecho, Km, {_TARGET_SQL} AS target FROM feed)
    SELECT * FROM f WHERE target IS NOT NULL""",
)
def flt7(spark, sf_dir):
    target = text.blank_to_null(flags.any_at_least_one(c("Gravemente_feridos"), c("Mortos")))
    return cols.complete_cases(
        feed(spark, sf_dir).select("Trecho", "Km", target.alias("target")), ["target"]
    )


_CASE_COLUMNS = ("Automovel", "Moto", "Sentido", "Km")


@query(
    "flt8_complete_cases",
    f"WITH {sq.FEED} SELECT {', '.join(_CASE_COLUMNS)}, Trecho FROM feed WHERE "
    + " AND ".join(f"{n} IS NOT NULL" for n in _CASE_COLUMNS),
)
def flt8(spark, sf_dir):
    return cols.complete_cases(
        feed(spark, sf_dir).select(*_CASE_COLUMNS, "Trecho"), _CASE_COLUMNS
    )


@query(
    "flt8_drop_report",
    f"""WITH {sq.FEED}, f AS (
      SELECT Automovel, Moto, Sentido, Km, CAST({_TARGET_SQL} AS INT) AS target FROM feed)
    SELECT CASE WHEN Automovel IS NULL OR Moto IS NULL OR Sentido IS NULL OR Km IS NULL
      THEN 'dropped' ELSE 'kept' END AS part, count(*) AS n, CAST(sum(target) AS BIGINT) AS events,
      round(avg(target), 6) AS rate FROM f GROUP BY 1""",
)
def flt8_report(spark, sf_dir):
    target = text.blank_to_null(flags.any_at_least_one(c("Gravemente_feridos"), c("Mortos")))
    rows = feed(spark, sf_dir).select(*_CASE_COLUMNS, target.cast("int").alias("target"))
    return rounded(cols.drop_report(rows, _CASE_COLUMNS, "target"))


# --- de-duplication and whole plans --------------------------------------------------


@query(
    "win1_exact_dedupe",
    f"""WITH {sq.FEED}, uniq AS (SELECT DISTINCT {sq._CLEANED} FROM feed)
    SELECT *, translate({sq.occurrence(NO)}, '.,;/-', '') AS Num_Ocorrencia,
      CASE WHEN strpos({NO}, '-') > 0 THEN 'Contorno' ELSE 'Normal' END AS Pista FROM uniq""",
)
def win1(spark, sf_dir):
    return plan.distinct_records(feed(spark, sf_dir))


@query(
    "flt9_row_number_one",
    """SELECT l_orderkey, l_linenumber, l_partkey, l_quantity FROM (
      SELECT *, row_number() OVER (PARTITION BY l_orderkey, l_linenumber
        ORDER BY l_partkey, l_quantity) AS rn FROM lineitem) t WHERE rn = 1""",
)
def flt9(spark, sf_dir):
    rows = table(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_linenumber", "l_partkey", "l_quantity"
    )
    return keep_first(rows, ["l_orderkey", "l_linenumber"], ["l_partkey", "l_quantity"])


_SHOWN = ", ".join(
    "CAST(DataRef AS VARCHAR) AS DataRef" if n == "DataRef" else n for n in cs.FEATURE_COLUMNS
)


@query("win2_feature_dedupe", f"WITH {sq.FEATURES} SELECT {_SHOWN} FROM features")
def win2(spark, sf_dir):
    return plan.feature_table(feed(spark, sf_dir)).withColumns(
        {"DataRef": c("DataRef").cast("string"), "KmDecimal": c("KmDecimal").cast("double")}
    )


@query(
    "agg3_duplicate_report",
    f"""WITH {sq.FEED}, u AS (SELECT DISTINCT * FROM feed),
    a AS (SELECT count(*) AS total FROM feed), b AS (SELECT count(*) AS remaining FROM u)
    SELECT total, total - remaining AS duplicated, remaining FROM a, b""",
)
def agg3(spark, sf_dir):
    return duplicate_report(feed(spark, sf_dir))


@query(
    "agg3_duplicate_report_null_skipping",
    f"""WITH {sq.FEED} SELECT count(*) AS total,
      count(*) - count(DISTINCT concat_ws('|', {", ".join(cs.RAW_COLUMNS)})) AS duplicated,
      count(DISTINCT concat_ws('|', {", ".join(cs.RAW_COLUMNS)})) AS remaining FROM feed""",
)
def agg3_skipping(spark, sf_dir):
    return duplicate_report(feed(spark, sf_dir), null_safe=False)


@query(
    "win1_fold_case",
    f"""WITH {sq.FEED} SELECT min(TipoDeOcorrencia) AS TipoDeOcorrencia,
      min(Km) AS Km FROM feed GROUP BY lower(rtrim(TipoDeOcorrencia, ' ')), lower(rtrim(Km, ' '))""",
)
def win1_fold(spark, sf_dir):
    return distinct_rows(feed(spark, sf_dir).select("TipoDeOcorrencia", "Km"), fold_case=True)


@query(
    "e1_severity_by_daypart",
    f"""WITH {sq.RECORDS}, s AS (
      SELECT {sq.DAYPART.format("HorarioPadrao")} AS daypart,
        {sq.any_flag("Gravemente_feridos", "Mortos")} AS severe
      FROM records WHERE Trecho IN ({sq._ROAD_LIST}))
    SELECT daypart, count(*) AS n_rows, count(*) FILTER (severe = '1') AS n_severe,
      count(*) FILTER (severe <> '') AS n_known,
      round(CAST(count(*) FILTER (severe = '1') AS DOUBLE)
        / CAST(count(*) FILTER (severe <> '') AS DOUBLE), 6) AS severe_rate
    FROM s GROUP BY daypart""",
)
def e1_severity(spark, sf_dir):
    return plan.severity_by_daypart(feed(spark, sf_dir))


@query(
    "e1_cleaned_table",
    f"""WITH {sq.DERIVED} SELECT TrechoRegiao, TrechoRegiao2, SentidoPadrao,
      TipoDeOcorrenciaPadrao, Periodo, KmDecimal, Vitimas, Gravemente_feridos_Mortos,
      count(*) AS n FROM road GROUP BY ALL""",
)
def e1_cleaned(spark, sf_dir):
    cleaned = plan.cleaned_table(feed(spark, sf_dir)).withColumn(
        "KmDecimal", c("KmDecimal").cast("double")
    )
    return cleaned.groupBy(
        "TrechoRegiao",
        "TrechoRegiao2",
        "SentidoPadrao",
        "TipoDeOcorrenciaPadrao",
        "Periodo",
        "KmDecimal",
        "Vitimas",
        cs.SEVERE,
    ).agg(F.count("*").alias("n"))
