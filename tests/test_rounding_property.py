"""round_ratio equals Decimal ROUND_HALF_UP (away from zero) in Spark and DuckDB."""
import random
from decimal import ROUND_HALF_UP, Decimal

import pytest

from ledgerlens.functions import numeric as N
from ledgerlens.plans import oracle as O


def expected(num: Decimal, den: int, digits: int) -> Decimal:
    return (num / Decimal(den)).quantize(Decimal(1).scaleb(-digits), rounding=ROUND_HALF_UP)


@pytest.mark.parametrize("digits,scale", [(0, 0), (1, 0), (2, 0), (2, 2), (2, 4), (1, 2)])
def test_round_ratio_matches_decimal(spark, duck_con, digits, scale):
    rnd = random.Random(digits * 10 + scale)
    cases = []
    for _ in range(400):
        den = rnd.choice([1, 2, 3, 4, 7, 8, 16, 40, 99, 1000, rnd.randint(1, 10**6)])
        num = Decimal(rnd.randint(-10**12, 10**12)).scaleb(-scale)
        if rnd.random() < 0.3:  # force exact ties at the rounding digit
            num = (Decimal(den) * (Decimal(rnd.randint(-10**6, 10**6)) + Decimal("0.5"))).scaleb(-digits)
            num = num.quantize(Decimal(1).scaleb(-max(scale, digits + 1)))
        cases.append((num, den))
    width = max(scale, digits + 1)
    df = spark.createDataFrame(
        [(n, d) for n, d in cases], f"n DECIMAL(38,{width}), d BIGINT"
    )
    got = [r[0] for r in df.select(N.round_ratio("n", "d", digits, width)).collect()]
    want = [expected(n, d, digits) for n, d in cases]
    assert got == want
    values = ", ".join(f"(CAST('{n}' AS DECIMAL(38,{width})), {d})" for n, d in cases)
    sql = f"SELECT {O.round_ratio('n', 'd', digits, width)} FROM (VALUES {values}) t(n, d)"
    assert [r[0] for r in duck_con.execute(sql).fetchall()] == want


def test_round_ratio_fractional_denominator(spark, duck_con):
    # shares divide one 4-decimal sum by another (regional share)
    rnd = random.Random(11)
    cases = [(Decimal(rnd.randint(0, 10**10)).scaleb(-4), Decimal(rnd.randint(1, 10**12)).scaleb(-4))
             for _ in range(300)]
    df = spark.createDataFrame(cases, "n DECIMAL(38,4), d DECIMAL(38,4)")
    got = [r[0] for r in df.select(N.round_ratio(df.n * 100, "d", 2, 4)).collect()]
    want = [(n * 100 / d).quantize(Decimal("0.01"), rounding=ROUND_HALF_UP) for n, d in cases]
    assert got == want
    values = ", ".join(f"(CAST('{n}' AS DECIMAL(38,4)), CAST('{d}' AS DECIMAL(38,4)))" for n, d in cases)
    sql = f"SELECT {O.round_ratio('n * 100', 'd', 2, 4)} FROM (VALUES {values}) t(n, d)"
    assert [r[0] for r in duck_con.execute(sql).fetchall()] == want


def test_average_days_does_not_overflow_for_huge_segments(spark):
    # 5e9 customers x 86.4e9 micros/day exceeds BIGINT; the helper stays exact
    df = spark.createDataFrame([(Decimal(5 * 10**9 * 86_400_000_000 * 30), 5 * 10**9)],
                               "micros DECIMAL(38,0), n BIGINT")
    from pyspark.sql import functions as F

    out = df.select(N.round_ratio("micros", F.col("n").cast("decimal(38,0)") * F.lit(86_400_000_000), 0)).first()[0]
    assert out == Decimal(30)
