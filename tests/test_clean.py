from datetime import date
from decimal import Decimal

from pyspark.sql import functions as F

from strata import functions as fn
from strata.operators import calendar_parts, fill_defaults, normalize_text, preview, require_not_null
from tests.conftest import values


def test_normalize_trims_spaces_only(rows):
    df = rows("s string", "  são ", "\t x", "  ", None)
    got = [r[0] for r in normalize_text(df, ["s"]).collect()]
    assert got == ["SÃO", "\t X", "", None]


def test_defaults_fill_null_but_not_blank(rows):
    df = rows("r string, d double", ("", 1.0), ("  ", None), (None, None))
    defaults = {"r": "NONE", "d": 0.0}
    assert [tuple(r) for r in fill_defaults(df, defaults).collect()] == [
        ("", 1.0), ("  ", 0.0), ("NONE", 0.0),
    ]
    blank = fill_defaults(df, defaults, blank_as_null=True)
    assert [r.r for r in blank.collect()] == ["NONE"] * 3


def test_defaults_keep_decimal_columns_decimal(rows):
    df = rows("d decimal(9,4)", Decimal("1.5"), None)
    filled = fill_defaults(df, {"d": 0.0})
    assert filled.dtypes == [("d", "decimal(9,4)")]
    assert [r.d for r in filled.collect()] == [Decimal("1.5000"), Decimal("0.0000")]


def test_net_amount_is_binary_for_doubles_and_exact_for_decimals(rows):
    df = rows("a string, p string", ("0.50", "1"), ("200.10", "15"), ("10.00", None))

    def net(kind, exact):
        amount = fn.net_amount(F.col("a").cast(kind), F.col("p").cast(kind), exact=exact)
        return [r[0] for r in df.select(amount.cast("double")).collect()]

    # 0.495 and 170.085 before rounding; the second is just below the tie in binary.
    assert net("double", False) == [0.5, 170.08, None]
    assert net("decimal(18,2)", True) == [0.5, 170.09, None]


def test_lead_days_flag_and_override(rows):
    df = rows(
        "a date, b date, s string",
        (date(2024, 1, 1), date(2024, 1, 8), "X"),
        (date(2024, 1, 1), date(2024, 1, 9), "X"),
        (date(2024, 1, 9), date(2024, 1, 1), "X"),
        (date(2024, 1, 1), None, "X"),
    )
    days = fn.lead_days(F.col("a"), F.col("b"))
    got = df.select(days, fn.sla_flag(days), fn.override_when_null(F.col("s"), F.col("b"))).collect()
    assert [tuple(r) for r in got] == [
        (7, True, "X"), (8, False, "X"), (-8, True, "X"), (None, False, "EM_TRANSITO"),
    ]


def test_band_limits_are_exclusive_and_null_is_ok(rows):
    df = rows("v double", 79.99, 80.0, 94.99, 95.0, None)
    got = [r[0] for r in df.select(fn.band(F.col("v"))).collect()]
    assert got == ["ABAIXO_SLA", "ATENCAO", "ATENCAO", "OK", "OK"]


def test_band_does_not_depend_on_step_order(rows):
    df = rows("v double", 1.0, 5.0, 9.0)
    steps = [(8, "mid"), (3, "low")]
    got = [r[0] for r in df.select(fn.band(F.col("v"), steps, "high")).collect()]
    assert got == ["low", "mid", "high"]


def test_calendar_parts_of_null_date_are_null(rows):
    df = rows("d date", date(2024, 5, 1), date(2023, 12, 31), None)
    got = [tuple(r) for r in calendar_parts(df, "d").drop("d").collect()]
    assert got == [(2024, 5, "Q2"), (2023, 12, "Q4"), (None, None, None)]


def test_require_not_null_and_preview(rows):
    df = rows("a int, b int", (1, 1), (None, 2), (3, None), (4, 0))
    kept = require_not_null(df, ["a", "b"])
    assert values(kept) == [(1, 1), (4, 0)]
    assert [r.a for r in preview(df, [F.col("a").desc_nulls_last()], 2).collect()] == [4, 3]
