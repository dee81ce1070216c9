import random

import pytest

from dockside.plans.ordered import ordered_columns
from dockside.sources.readers import with_surrogate_key

SCHEMA = "g string, t long, id long, x long"


def data(seed, groups, n):
    rng = random.Random(seed)
    return [(rng.choice(groups), rng.randrange(n), i, rng.choice([None, 1, 2, 5])) for i in range(n)]


def brute(rows, group):
    out = {}
    parts = {}
    for r in rows:
        parts.setdefault(r[0] if group else None, []).append(r)
    for part in parts.values():
        part.sort(key=lambda r: (r[1], r[2]))
        xs = [r[3] for r in part]
        for i, r in enumerate(part):
            seen = [x for x in xs[: i + 1] if x is not None]
            last = [x for x in xs[max(0, i - 3): i + 1] if x is not None]
            out[r[2]] = (
                i + 1,
                xs[i - 2] if i >= 2 else None,
                xs[i + 1] if i + 1 < len(xs) else None,
                xs[i + 3] if i + 3 < len(xs) else None,
                sum(seen),
                min(seen) if seen else None,
                sum(last) if last else None,
            )
    return out


@pytest.mark.parametrize("groups", [["a"], ["a", "a", "a", "b", None], list("abcdefgh")])
@pytest.mark.parametrize("grouped", [True, False])
@pytest.mark.parametrize("segments", [None, 1, 7, 40])
def test_columns_match_brute_force(spark, groups, grouped, segments):
    rows = data(len(groups), groups, 120)
    df = spark.createDataFrame(rows, SCHEMA)
    got = ordered_columns(
        df, ["g"] if grouped else [], [("t", True), ("id", True)],
        segments=segments, rank="n",
        lags={"two_back": ("x", 2)}, leads={"next": ("x", 1), "third": ("x", 3)},
        running={"total": ("x", "sum"), "low": ("x", "min")}, trailing={"last4": ("x", 4)},
    )
    have = {r.id: (r.n, r.two_back, r.next, r.third, r.total, r.low, r.last4) for r in got.collect()}
    assert have == brute(rows, grouped)


def test_descending_order(spark):
    df = spark.createDataFrame([("a", i, i, i) for i in range(20)], SCHEMA)
    got = ordered_columns(df, ["g"], [("t", False), ("id", False)], segments=5,
                          rank="n", lags={"before": ("x", 1)})
    assert {r.x: (r.n, r.before) for r in got.collect()} == {
        i: (20 - i, i + 1 if i < 19 else None) for i in range(20)
    }


def test_surrogate_keys_are_dense(small_model):
    got = with_surrogate_key(small_model.tables.orders, "orders")
    ids = sorted(r[0] for r in got.select("order_id").collect())
    assert ids == list(range(1, len(ids) + 1))
