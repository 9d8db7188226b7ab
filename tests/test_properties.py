"""Randomised checks of the exact-rounding and distributed-ranking helpers."""

import random
from decimal import ROUND_HALF_UP, Decimal

from ledgerline.functions.ratios import money_avg_half_up, ratio_half_up
from ledgerline.plans.ranking import asc, desc, ntile, rank_within


def _half_up(num, den, digits, factor=1):
    if den == 0:
        return None
    q = Decimal(num * factor) / Decimal(den)
    return float(q.quantize(Decimal(1).scaleb(-digits), rounding=ROUND_HALF_UP))


def test_ratio_matches_decimal_half_up(spark):
    rng = random.Random(7)
    rows = [(rng.randint(-10 ** 12, 10 ** 12), rng.choice([0, 1, 2, 3, 7, 16, 40, rng.randint(1, 10 ** 9)]))
            for _ in range(3000)]
    rows += [(1, 16), (3, 16), (5, 2), (-5, 2), (25, 1000)]
    df = spark.createDataFrame(rows, "n long, d long")
    for digits, factor in ((0, 1), (1, 100), (2, 1), (4, 1)):
        got = df.select("n", "d", ratio_half_up("n", "d", digits, factor).alias("r")).collect()
        for r in got:
            assert r["r"] == _half_up(r["n"], r["d"], digits, factor), (r, digits, factor)


def test_money_average_matches_decimal(spark):
    rng = random.Random(11)
    rows = [(rng.randint(0, 10 ** 15), rng.randint(1, 10 ** 6)) for _ in range(2000)]
    df = spark.createDataFrame(rows, "c long, n long")
    for r in df.select("c", "n", money_avg_half_up("c", "n").alias("a")).collect():
        want = (Decimal(r["c"]) / Decimal(r["n"])).quantize(Decimal(1), rounding=ROUND_HALF_UP) / 100
        assert r["a"] == want


def test_rank_matches_direct_definition(spark):
    rng = random.Random(3)
    rows = [(f"k{i:05d}", rng.choice(["a", "b", "c", None]),
             rng.choice([None, *[Decimal(rng.randint(0, 30)) for _ in range(5)]])) for i in range(1500)]
    rows += [(f"hot{i:05d}", "a", Decimal(7)) for i in range(700)]        # one hot tie group
    df = spark.createDataFrame(rows, "id string, g string, v decimal(10,0)")
    spark.conf.set("spark.sql.shuffle.partitions", "13")
    try:
        for nulls_first in (True, False):
            got = {r["id"]: r["rk"] for r in rank_within(
                df, ["g"], [desc("v", nulls_first=nulls_first)], [asc("id")], out="rk").collect()}
            live = rank_within(df, ["g"], [desc("v", nulls_first=nulls_first)], [asc("id")], out="rk", live=True)
            assert got == {r["id"]: r["rk"] for r in live.collect()}
            for rid, g, v in rows:
                peers = [w for _, h, w in rows if h == g]
                if v is None:
                    better = sum(1 for w in peers if w is not None) if not nulls_first else 0
                else:
                    better = sum(1 for w in peers if (w is None and nulls_first) or (w is not None and w > v))
                assert got[rid] == better + 1, (rid, g, v, nulls_first)
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", "4")


def test_ntile_matches_formula(spark):
    rng = random.Random(5)
    for n, k in ((1, 4), (3, 4), (4, 4), (5, 4), (103, 4), (1000, 7)):
        rows = [(f"s{i:05d}", Decimal(rng.choice([1, 2, 2, 2, 3, 50]))) for i in range(n)]
        df = spark.createDataFrame(rows, "id string, v decimal(10,0)").repartition(9)
        got = {r["id"]: r["t"] for r in ntile(df, k, [asc("v"), asc("id")], out="t").collect()}
        ordered = sorted(rows, key=lambda r: (r[1], r[0]))
        q, rem = divmod(n, k)
        want, pos = {}, 0
        for tile in range(1, k + 1):
            size = q + (1 if tile <= rem else 0)
            for rid, _ in ordered[pos:pos + size]:
                want[rid] = tile
            pos += size
        assert got == want, (n, k)
