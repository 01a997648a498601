"""Property checks: the halo form equals the plain window; scaling round-trips."""

import datetime as dt

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from candela.operators import features as fe
from candela.operators.position import with_position

D0 = dt.date(2020, 1, 1)
SETTINGS = settings(max_examples=6, deadline=None,
                    suppress_health_check=[HealthCheck.function_scoped_fixture])


def frame(spark, series):
    rows = [(t, D0 + dt.timedelta(days=3 * i), float(v)) for t, vals in series.items()
            for i, v in enumerate(vals)]
    return spark.createDataFrame(rows, "ticker string, bar_date date, close double")


series_st = st.dictionaries(st.sampled_from(["A", "B", "C"]),
                            st.lists(st.integers(-50, 50), min_size=0, max_size=60), min_size=1)


@SETTINGS
@given(series=series_st, L=st.integers(1, 6), extra=st.integers(0, 5))
def test_halo_samples_equal_plain(spark, series, L, extra):
    d = fe.minmax_scale(frame(spark, series))
    halo = fe.sequence_samples(with_position(d, bucket="week"), L, chunk=L + extra)
    plain = fe.sequence_samples_plain(d, L)
    assert sorted(map(tuple, halo.collect())) == sorted(map(tuple, plain.collect()))
    assert halo.count() == sum(max(0, len(v) - L) for v in series.values())


@SETTINGS
@given(series=series_st)
def test_scale_roundtrip(spark, series):
    d = fe.minmax_scale(frame(spark, series))
    rows = d.select("close", "s", fe.inverse_scale_expr("s").alias("back")).collect()
    for r in rows:
        assert 0.0 <= r.s <= 1.0
        assert abs(r.back - r.close) < 1e-9
