"""Literal tables for the parsing and flag rules."""

import itertools

import pytest
from pyspark.sql import functions as F

from riskframe.functions import clock, flags, numbers, text

c = F.col


def column(spark, values, expr, kind="string"):
    """Apply ``expr`` to a one-column table and return the results in order."""
    rows = spark.createDataFrame(list(enumerate(values)), f"i int, x {kind}")
    return [r.y for r in rows.select("i", expr(c("x")).alias("y")).orderBy("i").collect()]


CLOCK = [
    ("10:00:00 AM", 36000),
    ("1:19:00 PM", 47940),
    ("00:00:00", 0),
    ("23:59:00", 86340),
    ("0:00:00", 0),
    ("16:10", 58200),
    ("5:19", 19140),
    ("10:00", 36000),
    ("0:00", 0),
    ("9:59", 35940),
    ("9:59:00", 35940),
    ("23:59h", 86340),
    ("00:32h", 1920),
    ("12:30 AM", 45000),  # only the mark is stripped
    ("12:30 PM", 45000),
    ("13:05 PM", 3900),  # twelve hours more, wrapped
    ("11:59:30h", None),
    ("23:59:30h", None),
    ("11:59:00h", 43140),
    ("10:00 am", 36000),
    ("24:00", None),
    ("10:60", None),
    ("N/A", None),
    ("", None),
    (None, None),
]


def test_clock_texts(spark):
    got = column(spark, [t for t, _ in CLOCK], clock.parse_clock)
    assert got == [s for _, s in CLOCK]


def test_clock_steps_equal_expression(spark):
    rows = spark.createDataFrame([(t,) for t, _ in CLOCK], "x string")
    both = clock.add_clock(rows, "x", "a", "midnight").withColumn(
        "b", clock.parse_clock(c("x"), "midnight")
    )
    assert both.where(~c("a").eqNullSafe(c("b"))).count() == 0


def test_midnight_option(spark):
    got = column(spark, ["12:30 AM", "1:00 AM", "12:00 PM"], lambda x: clock.parse_clock(x, "midnight"))
    assert got == [1800, 3600, 43200]


def test_dayparts(spark):
    edges = [0, 21599, 21600, 43199, 43200, 64799, 64800, 86399, None]
    got = column(spark, edges, clock.daypart, "int")
    night, morning, afternoon, evening = clock.DAYPARTS
    assert got == [night] * 2 + [morning] * 2 + [afternoon] * 2 + [evening] * 2 + [None]


def test_weekday_and_month(spark):
    days = ["2024-01-01", "2024-01-07", None]
    assert column(spark, days, lambda x: clock.weekday_label(x.cast("date"))) == [
        "segunda-feira",
        "domingo",
        None,
    ]
    assert column(spark, days, lambda x: clock.month_label(x.cast("date"))) == ["01", "01", None]


def test_dates(spark):
    got = column(spark, ["01/07/23", "31/12/10"], lambda x: clock.parse_day(x).cast("string"))
    assert got == ["2023-07-01", "2010-12-31"]
    assert column(spark, ["31/31/23", None], lambda x: clock.parse_day(x, strict=False)) == [None, None]
    with pytest.raises(Exception, match="CANNOT_PARSE_TIMESTAMP|could not be parsed"):
        column(spark, ["31/31/23"], clock.parse_day)


def test_integers(spark):
    texts = ["3", " 3 ", "+3", "-3", "1.0", "", "x", "00", None, "2147483647", "2147483648"]
    assert column(spark, texts, numbers.parse_int) == [
        3, 3, 3, -3, None, None, None, 0, None, 2147483647, None,
    ]
    assert column(spark, texts, numbers.at_least_one) == [
        True, True, True, False, False, False, False, False, None, True, False,
    ]


def test_doubles_reject_words(spark):
    texts = ["1.5", " 1.5 ", ".5", "5.", "1e3", "NaN", "Infinity", "1d", "1f", ".", "1.234.5", None]
    assert column(spark, texts, numbers.parse_double) == [
        1.5, 1.5, 0.5, 5.0, 1000.0, None, None, None, None, None, None, None,
    ]


def test_kilometres(spark):
    texts = ["97,5", "98+500", "10.49", "", None, "  ", "1.234,5", "abc", "."]
    assert [None if v is None else int(v) for v in column(spark, texts, numbers.parse_km)] == [
        98, 99, 10, 0, 0, 0, None, None, None,
    ]
    kept = column(spark, texts[:5], lambda x: numbers.parse_km(x, scale=2, blank="null"))
    assert [None if v is None else float(v) for v in kept] == [97.5, 98.5, 10.49, None, None]


def test_text_rules(spark):
    dirty = " 6\t5-1\u00a0\r\n"
    assert column(spark, [dirty], text.strip_all) == ["65-1"]
    assert column(spark, ["\u00a0 a b\t"], text.strip_invisible) == ["a b"]
    assert column(spark, ["65-1", "65-2", "65", None], text.occurrence_number) == [
        "6500",
        "6500",
        "6501",
        None,
    ]
    assert column(spark, ["65-1", "65", None], lambda x: text.presence_label(x, "-", "y", "n")) == [
        "y",
        "n",
        "n",
    ]
    assert column(spark, ["a-b-c", "abc"], lambda x: text.after_first(x, "-")) == ["b-c", "abc"]
    assert column(spark, ["ab  ", "  ab", ""], text.visible_length) == [2, 4, 0]
    key = column(spark, [None, "b"], lambda x: text.composite_key(F.lit("a"), x))
    assert key == ["a_NA", "a_b"]


def test_matching_ignores_case_not_accents(spark):
    texts = ["SUL", "Pista norte", "N/A", "", None]
    rules = [("Norte", "NORTE"), ("Sul", "SUL")]
    assert column(spark, texts, lambda x: flags.classify_contains(x, rules)) == [
        "SUL",
        "NORTE",
        None,
        None,
        None,
    ]
    texts = ["SEM VÍTIMA", "sem vitima", "sem vìtima"]
    assert column(spark, texts, lambda x: text.contains_any(x, "sem vítima")) == [True, False, False]


def test_presence_flag_states(spark):
    texts = ["", "  ", None, "0", "00", "1", " 3 ", "x", "1.0", "-1"]
    assert column(spark, texts, flags.presence_flag) == [
        "", "", "0", "0", "0", "1", "1", "0", "0", "0",
    ]


def test_target_pairs(spark):
    states = ["", "0", "2", None]
    pairs = list(itertools.product(states, states))
    rows = spark.createDataFrame([(i, a, b) for i, (a, b) in enumerate(pairs)], "i int, a string, b string")
    got = [
        r.t
        for r in rows.select("i", flags.any_at_least_one(c("a"), c("b")).alias("t"))
        .orderBy("i")
        .collect()
    ]

    def expected(a, b):
        if a == "" and b == "":
            return ""
        return "1" if "2" in (a, b) else "0"

    assert got == [expected(a, b) for a, b in pairs]


def test_or_flag_keeps_unknown(spark):
    bits = [1, 0, None]
    rows = spark.createDataFrame(list(itertools.product(bits, bits)), "a int, b int")
    got = {(r.a, r.b): r.f for r in rows.select("a", "b", flags.or_flag(c("a"), c("b")).alias("f")).collect()}
    assert got == {
        (1, 1): 1, (1, 0): 1, (1, None): 1, (0, 1): 1, (0, 0): 0, (0, None): None,
        (None, 1): 1, (None, 0): None, (None, None): None,
    }


def test_cutoff_is_two_sided(spark):
    scores = [0.1, 0.5, 0.9, None]
    assert column(spark, scores, lambda x: flags.apply_cutoff(x, 0.5), "double") == [0, 0, 1, None]
    loose = column(spark, scores, lambda x: flags.apply_cutoff(x, 0.5, strict=False), "double")
    assert loose == [0, 1, 1, None]


def test_iv_label_edges(spark):
    values = [0.0, 0.02, 0.020001, 0.1, 0.3, 0.5, 0.51, None]
    assert column(spark, values, flags.iv_label, "double") == [
        "Fraquissimo", "Fraquissimo", "Fraco", "Fraco", "Média", "Forte", "Suspeita", None,
    ]
