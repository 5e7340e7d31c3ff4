from datetime import date

from pyspark.sql import functions as F

from strata.functions import parse_date, parse_int, parse_money, parse_percent


def column(df, expression):
    return [r[0] for r in df.select(expression).collect()]


def test_money_reads_noise_and_gives_null_for_words(rows):
    df = rows("s string", "abc", "", " 5 ", "3.7", "1e3", "$1,250.00", "-$2.5", None)
    expected = [None, None, 5.0, 3.7, 1000.0, 1250.0, -2.5, None]
    assert column(df, parse_money(F.col("s"))) == expected


def test_money_as_decimal_is_exact(rows):
    df = rows("s string", "$1,250.10", "$0.005", "x")
    got = column(df, parse_money(F.col("s"), "decimal(18,2)").cast("string"))
    assert got == ["1250.10", "0.01", None]


def test_percent(rows):
    df = rows("s string", "15%", " 7.5 % ", "none", None)
    assert column(df, parse_percent(F.col("s"))) == [15.0, 7.5, None, None]


def test_int_truncates_and_refuses_exponents_and_overflow(rows):
    cases = {
        "abc": None, "": None, " 5 ": 5, "3.7": 3, "-3.7": -3, "1e3": None, "+4": 4, "5.": 5,
        ".9": 0, "2147483647": 2147483647, "2147483648": None, "1 2": None, "-": None,
        "\t8\n": 8, "$1": None,
    }
    df = rows("s string", *cases, None)
    assert column(df, parse_int(F.col("s"))) == [*cases.values(), None]


def test_date_takes_first_format_that_reads(rows):
    cases = {
        "2024-12-31": date(2024, 12, 31), "31/12/2024": date(2024, 12, 31),
        "12-31-2024": date(2024, 12, 31), "2024-1-5": None, "2024-02-30": None,
        " 2024-02-03": None, "soon": None,
    }
    df = rows("s string", *cases, None)
    assert column(df, parse_date(F.col("s"))) == [*cases.values(), None]


def test_shipment_formats_do_not_read_month_first(rows):
    df = rows("s string", "12-31-2024", "31/12/2024")
    assert column(df, parse_date(F.col("s"), ("yyyy-MM-dd", "dd/MM/yyyy"))) == [
        None, date(2024, 12, 31),
    ]


def test_parsers_do_not_depend_on_ansi_mode(spark, rows):
    df = rows("s string", "abc", "3.7", "31/12/2024")
    parsed = df.select(parse_money(F.col("s")), parse_int(F.col("s")), parse_date(F.col("s")))
    before = spark.conf.get("spark.sql.ansi.enabled")
    results = []
    try:
        for mode in ("true", "false"):
            spark.conf.set("spark.sql.ansi.enabled", mode)
            results.append(parsed.collect())
    finally:
        spark.conf.set("spark.sql.ansi.enabled", before)
    assert results[0] == results[1]
