"""Property tests: the scale-oriented operators equal their simple definitions on random input."""
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from regiolake.functions import numbers as N
from regiolake.operators import relational as R

from conftest import rows

SETTINGS = settings(max_examples=12, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])


@SETTINGS
@given(st.lists(st.tuples(st.sampled_from("ab"), st.integers(0, 300), st.one_of(st.none(), st.integers(0, 9))),
                min_size=1, max_size=80, unique_by=lambda t: (t[0], t[1])),
       st.sampled_from([1, 3, 16, 1000]))
def test_blocked_forward_fill_equals_window(spark, data, block):
    df = spark.createDataFrame(data, "g string, t long, v int")
    expected = {}
    for g in "ab":
        last = None
        for _, t, v in sorted(x for x in data if x[0] == g):
            last = v if v is not None else last
            expected[(g, t)] = last
    got = {(g, t): v for g, t, v in rows(R.forward_fill(df, ["g"], "t", ["v"], block=block))}
    assert got == expected


@SETTINGS
@given(st.integers(0, 60), st.integers(1, 5), st.integers(1, 7))
def test_split_even_matches_positional_split(spark, n, parts, ranges):
    df = spark.range(0, n).withColumnRenamed("id", "k")
    got = dict(rows(R.split_even(df, ["k"], parts, num_ranges=ranges).select("k", "part")))
    size = n // parts
    for k in range(n):
        want = parts - 1 if size == 0 else min(k // size, parts - 1)
        assert got[k] == want


@SETTINGS
@given(st.integers(0, 10 ** 9), st.integers(0, 99))
def test_strict_locale_number_roundtrip(spark, whole, cents):
    text = f"{whole:,}".replace(",", ".") + f",{cents:02d}"
    got = spark.createDataFrame([(text,)], "x string").select(N.locale_number("x", strict=True).alias("y")).first()["y"]
    assert got == float(f"{whole}.{cents:02d}")
