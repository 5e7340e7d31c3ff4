import random
from decimal import Decimal

import pytest

from strata.operators import growth_pct, rank_within, share_of_total
from tests.conftest import values


def brute_ranks(data, descending):
    """Rank by counting strictly better rows; null is worst descending, best ascending."""

    def key(v):
        return (v is not None, v if v is not None else 0)

    def better(a, b):
        return key(a) > key(b) if descending else key(a) < key(b)

    return sorted(
        ((g, v, 1 + sum(1 for h, w in data if h == g and better(w, v))) for g, v in data),
        key=lambda r: [(x is not None, x) for x in r],
    )


def hot_data():
    """One partition holds most rows, one value most of that partition, plus nulls."""
    draw = random.Random(7)
    hot = [("hot", 50.0)] * 120 + [("hot", float(draw.randint(0, 99))) for _ in range(200)]
    rest = [(draw.choice(["a", "b", None]), float(draw.randint(0, 20))) for _ in range(80)]
    return hot + rest + [("hot", None), ("hot", None), ("a", None), (None, None)]


@pytest.mark.parametrize("descending", [True, False])
@pytest.mark.parametrize("spread", [None, 2, 16])
def test_rank_matches_brute_force(rows, descending, spread):
    data = hot_data()
    df = rows("g string, v double", *data)
    ranked = rank_within(df, "v", ["g"], "r", descending=descending, spread=spread)
    assert values(ranked) == brute_ranks(data, descending)


def test_spread_rank_of_decimals(rows):
    data = [("a", Decimal(i % 7)) for i in range(30)]
    df = rows("g string, v decimal(18,2)", *data)
    assert values(rank_within(df, "v", ["g"], "r", spread=4)) == values(
        rank_within(df, "v", ["g"], "r")
    )


def test_spread_rank_of_text(rows):
    data = [(f"g{i % 2}", f"v{i * 7 % 10}") for i in range(40)]
    df = rows("g string, v string", *data)
    assert values(rank_within(df, "v", ["g"], "r", spread=4)) == values(
        rank_within(df, "v", ["g"], "r")
    )


GAPPED = (
    ("A", None, None, 5.0), ("A", 2024, 1, 10.0), ("A", 2024, 3, 15.0), ("A", 2024, 4, 0.0),
    ("A", 2024, 5, 9.0), ("B", 2023, 12, 4.0), ("B", 2024, 1, None), ("B", 2024, 2, 2.0),
)


def test_growth_compares_with_the_previous_row(rows):
    df = rows("g string, y int, m int, v double", *GAPPED)
    got = [r[-1] for r in values(growth_pct(df, "v", ["g"], ["y", "m"], "p"))]
    assert got == [None, 100.0, 50.0, -100.0, None, None, None, None]


def test_calendar_growth_is_null_over_gaps(rows):
    df = rows("g string, y int, m int, v double", *GAPPED, ("C", 2023, 12, 1.0), ("C", 2024, 1, 3.0))
    got = [r[-1] for r in values(growth_pct(df, "v", ["g"], ["y", "m"], "p", calendar=True))]
    assert got == [None, None, None, -100.0, None, None, None, None, None, 200.0]


@pytest.mark.parametrize("spread", [False, True])
def test_share_of_total(rows, spread):
    df = rows("g string, v double", ("a", 1.0), ("a", 2.0), ("a", None), ("z", 0.0), (None, 4.0))
    assert values(share_of_total(df, "v", ["g"], "s", spread=spread)) == [
        (None, 4.0, 100.0), ("a", None, None), ("a", 1.0, 33.33), ("a", 2.0, 66.67), ("z", 0.0, None),
    ]


@pytest.mark.parametrize("spread", [False, True])
def test_shares_sum_to_one_hundred(rows, spread):
    data = [(f"g{i % 3}", Decimal(i * 13 % 101)) for i in range(60)]
    df = rows("g string, v decimal(18,2)", *data)
    shares = share_of_total(df, "v", ["g"], "s", spread=spread)
    for row in shares.groupBy("g").sum("s").collect():
        assert abs(row[1] - 100) <= Decimal("0.005") * 20
