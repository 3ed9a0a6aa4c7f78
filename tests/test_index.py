import math
import random
from decimal import Decimal

from pyspark.sql import functions as F

from deckspark.functions import index as ix
from deckspark.operators import window as W


def magnitude_key(d: Decimal):
    """Independent statement of the deck order: same root -> the whole
    number first, then fractions of larger magnitude (fewer leading zeros)
    first, then by value."""
    root = int(d // 1)
    frac = d - root
    if frac == 0:
        return (root, -1, Decimal(0))
    zeros = -int(math.floor(math.log10(float(frac)))) - 1
    return (root, zeros, frac)


def test_deck_order_fixture(spark):
    expected = ["1.002", "2", "2.01", "2.001", "2.0013", "2.00132", "2.003", "2.0001", "2.0002", "3"]
    shuffled = expected[:]
    random.Random(3).shuffle(shuffled)
    df = spark.createDataFrame([(Decimal(x),) for x in shuffled], "idx decimal(18,6)")
    got = [r[0] for r in df.orderBy(*ix.deck_order_key("idx")).collect()]
    assert got == [Decimal(x) for x in expected]


def test_deck_order_random_against_independent_key(spark):
    rng = random.Random(11)
    vals = set()
    while len(vals) < 400:
        root = rng.randint(0, 30)
        kind = rng.random()
        if kind < 0.2:
            vals.add(Decimal(root))
        elif kind < 0.6:
            vals.add(Decimal(root) + Decimal(rng.randint(1, 9)) / 1000 + Decimal(rng.randint(0, 9)) / 10000)
        elif kind < 0.8:
            vals.add(Decimal(root) + Decimal(rng.randint(1, 9)) / 10000)
        else:
            vals.add(Decimal(root) + Decimal(rng.randint(1, 99)) / 100)
    vals = [v.quantize(Decimal("0.000001")) for v in vals]
    df = spark.createDataFrame([(v,) for v in vals], "idx decimal(18,6)")
    got = [r[0] for r in df.orderBy(*ix.deck_order_key("idx")).collect()]
    assert got == sorted(vals, key=magnitude_key)


def test_fraction_predicates(spark):
    df = spark.createDataFrame([(Decimal(x),) for x in ["4", "4.001", "4.0002", "4.0102", "4.00005"]], "idx decimal(18,6)")
    rows = df.select("idx", ix.is_root("idx"), ix.is_custom_note("idx"), ix.fraction_at_least("idx"), ix.leading_zeros("idx")).collect()
    got = {str(r[0].normalize()): tuple(r[1:]) for r in rows}
    assert got["4"] == (True, False, False, -1)
    assert got["4.001"] == (False, False, False, 2)
    assert got["4.0002"] == (False, True, False, 3)
    assert got["4.0102"] == (False, False, True, 1)
    assert got["4.00005"] == (False, True, False, 4)  # round(frac, 4) = 0.0001


def test_suffix_occurrences(spark):
    df = spark.createDataFrame([(Decimal(5), 1), (Decimal(5), 2), (Decimal(5), 3), (Decimal(7), 1)], "idx decimal(18,6), pos int")
    out = W.suffix_occurrences(df, "idx", ["pos"], "0.001")
    got = sorted(r[0] for r in out.select("idx").collect())
    assert got == [Decimal("5"), Decimal("5.001"), Decimal("5.002"), Decimal("7")]
