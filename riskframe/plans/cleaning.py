"""Raw crash records to the de-duplicated feature table and the model table."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from riskframe.functions import clock, flags, numbers, text
from riskframe.operators import columns as cols
from riskframe.operators.binning import cut
from riskframe.operators.dedupe import distinct_rows, keep_first
from riskframe.plans import crash_schema as cs


def clean_number(raw: DataFrame) -> DataFrame:
    """Occurrence id without blanks, tabs, line ends and no-break blanks."""
    return raw.withColumn("No_DaOcorrencia", text.strip_all(F.col("No_DaOcorrencia")))


def add_identity(df: DataFrame) -> DataFrame:
    """Occurrence number and lane from the cleaned id."""
    c = F.col("No_DaOcorrencia")
    return df.withColumns(
        {
            "Num_Ocorrencia": text.strip_punctuation(text.occurrence_number(c)),
            "Pista": text.presence_label(c, "-", cs.LANE_SPLIT, cs.LANE_NORMAL),
        }
    )


def distinct_records(raw: DataFrame) -> DataFrame:
    """Exact copies removed.

    Number and lane are functions of the id, so they are derived after the
    shuffle instead of widening its key.
    """
    return add_identity(distinct_rows(clean_number(raw)))


def add_time(df: DataFrame, twelve_am: str = "reference", strict_dates: bool = True) -> DataFrame:
    """Reference date and seconds of day from their texts."""
    cleaned = df.withColumn("Horario", text.strip_invisible(F.col("Horario")))
    dated = cleaned.withColumn("DataRef", clock.parse_day(F.col("Data"), strict_dates))
    return clock.add_clock(dated, "Horario", "HorarioPadrao", twelve_am)


def on_roads(df: DataFrame, roads=cs.ROADS) -> DataFrame:
    return df.where(F.col("Trecho").isin(*roads))


def occurrence_class(kind: Column) -> Column:
    """Any victim counted wins; then the wording; then 'with victim'."""
    injured = [
        numbers.at_least_one(F.col(c))
        for c in ("Levemente_feridos", "Moderadamente_feridos", "Gravemente_feridos", "Mortos")
    ]
    rules = [(cond, cs.WITH_VICTIM) for cond in injured]
    rules.append((text.contains_any(kind, *cs.NO_VICTIM_TEXTS), cs.WITHOUT_VICTIM))
    return flags.classify(rules, cs.WITH_VICTIM)


def add_place(df: DataFrame, km_scale: int = 0, blank_km: str = "zero") -> DataFrame:
    """Kilometre, region, direction, occurrence class and day part."""
    region = flags.map_values(F.col("Trecho"), cs.REGIONS, cs.OUTSIDE)
    return df.withColumns(
        {
            "KmDecimal": numbers.parse_km(F.col("Km"), km_scale, blank_km),
            "TrechoRegiao": region,
            "TrechoRegiao2": flags.map_values(region, {cs.OUTSIDE: cs.OUTSIDE}, cs.INSIDE),
            "SentidoPadrao": flags.classify_contains(F.col("Sentido"), list(cs.DIRECTIONS)),
            "TipoDeOcorrenciaPadrao": occurrence_class(F.col("TipoDeOcorrencia")),
            "Periodo": clock.daypart(F.col("HorarioPadrao")),
        }
    )


def add_flags(df: DataFrame) -> DataFrame:
    """Twelve three-state flags and the two targets."""
    derived = {f"{c}_bin": flags.presence_flag(F.col(c)) for c in (*cs.VEHICLES, *cs.PEOPLE)}
    derived[cs.SEVERE] = flags.any_at_least_one(F.col("Gravemente_feridos"), F.col("Mortos"))
    derived["Vitimas"] = flags.any_at_least_one(
        *[
            F.col(c)
            for c in ("Mortos", "Gravemente_feridos", "Moderadamente_feridos", "Levemente_feridos")
        ]
    )
    return df.withColumns(derived)


def cleaned_table(raw: DataFrame, **options) -> DataFrame:
    """Distinct cleaned records of the chosen roads with every derived column.

    The road filter is written last; it is on a de-duplication key, so Catalyst
    runs it at the scan.
    """
    km = {k: options.pop(k) for k in ("km_scale", "blank_km") if k in options}
    records = add_time(distinct_records(raw), **options)
    return add_flags(add_place(on_roads(records), **km))


def feature_table(raw: DataFrame, **options) -> DataFrame:
    """The 35-column feature table, one row per accident.

    Equal to de-duplicating the raw records, deriving everything and
    de-duplicating the features, but with one narrow shuffle instead of two
    wide ones: exact copies have equal features, so the second step removes
    them too; and the flags and targets are functions of the counts, so they
    add nothing to the key and are derived after it.
    """
    km = {k: options.pop(k) for k in ("km_scale", "blank_km") if k in options}
    records = add_place(
        add_time(add_identity(clean_number(on_roads(raw))), **options), **km
    )
    base = [c for c in cs.FEATURE_COLUMNS if c in records.columns]
    keys = [c for c in base if c not in cs.UNTRUSTED]
    unique = keep_first(records.select(*base), keys, cs.UNTRUSTED)
    return add_flags(unique).select(*cs.FEATURE_COLUMNS)


def typed_features(features: DataFrame) -> DataFrame:
    """Key, blanks to null, casts by role, kilometre band and calendar fields."""
    keyed = features.withColumn(
        "Chave",
        text.composite_key(
            *[F.col(c) for c in ("Concessionaria", "Trecho", "Num_Ocorrencia", "DataRef")]
        ),
    )
    blanks = cols.blanks_to_null(keyed)

    def number(name, kind):
        c = F.col(name)
        return (numbers.parse_double(c.cast("string"))).cast(kind)

    casts = {c: number(c, "double") for c in (*cs.VEHICLES, *cs.PEOPLE)}
    casts |= {c: number(c, "int") for c in (*cs.FLAGS, "Vitimas", cs.SEVERE)}
    typed = blanks.withColumns(casts)
    typed = typed.withColumns(
        {
            "Km_cat": cut(F.col("KmDecimal"), cs.KM_BREAKS),
            "Onibus_Caminhao_Bin": flags.or_flag(F.col("Onibus_bin"), F.col("Caminhao_bin")),
        }
    )
    return cols.calendar_parts(typed, "DataRef")


def model_table(features: DataFrame) -> DataFrame:
    """Complete cases of the eleven model columns."""
    typed = cols.cast_roles(typed_features(features), cs.CRASH_SPEC).select(*cs.MODEL_COLUMNS)
    return cols.complete_cases(typed, [c for c in cs.MODEL_COLUMNS if c != "Chave"])


def severity_by_daypart(raw: DataFrame) -> DataFrame:
    """Distinct road records, severe records and severe share per day part."""
    records = on_roads(add_time(distinct_records(raw)))
    severe = flags.any_at_least_one(F.col("Gravemente_feridos"), F.col("Mortos"))
    return (
        records.select(
            clock.daypart(F.col("HorarioPadrao")).alias("daypart"), severe.alias("severe")
        )
        .groupBy("daypart")
        .agg(
            F.count("*").alias("n_rows"),
            F.count_if(F.col("severe") == "1").alias("n_severe"),
            F.count_if(F.col("severe") != "").alias("n_known"),
        )
        .withColumn("severe_rate", F.round(numbers.ratio(F.col("n_severe"), F.col("n_known")), 6))
    )
