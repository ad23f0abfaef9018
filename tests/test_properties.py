"""Property: the band join equals the textbook plan on arbitrary small inputs
(instants across day boundaries, repeated observations, both endpoints)."""

import datetime as dt

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from lagframe.operators import lagjoin
from tests.test_lagjoin import _canon, _tables

AIRPORTS = ["A", "B", "C"]
WBAN = {"A": "100", "B": "200", "C": "300"}
START = dt.date(2024, 1, 1)


def _day_time(minute: int) -> tuple[str, str]:
    day = START + dt.timedelta(days=minute // 1440)
    m = minute % 1440
    return day.isoformat(), str(m // 60 * 100 + m % 60)


legs_st = st.lists(st.tuples(st.sampled_from(AIRPORTS), st.sampled_from(AIRPORTS),
                             st.integers(0, 3 * 1440 - 1), st.sampled_from([30, 60, 95, 600])),
                   min_size=1, max_size=6)
obs_st = st.lists(st.tuples(st.sampled_from(AIRPORTS), st.integers(0, 3 * 1440 - 1)), max_size=30)


@settings(max_examples=6, deadline=None, suppress_health_check=list(HealthCheck))
@given(legs_st, obs_st, st.data())
def test_band_join_matches_textbook_plan(spark, legs, obs, data):
    leg_rows = []
    for i, (o, d, minute, elapsed) in enumerate(legs):
        day, hhmm = _day_time(minute)
        leg_rows.append((i, day, o, d, hhmm, str(i), "0", "0", str(elapsed)))
    obs_rows = []
    for j, (a, minute) in enumerate(obs):
        # aim some observations exactly at a leg's lagged instants
        if legs and data.draw(st.booleans()):
            o, _, dep, _ = legs[j % len(legs)]
            a, minute = o, dep - 60 * data.draw(st.integers(0, 12))
        day, hhmm = _day_time(max(minute, 0))
        obs_rows.append((j, WBAN[a], day, hhmm.zfill(4), str(j % 5)))
    legs_df, obs_df = _tables(spark, leg_rows, obs_rows or [(0, "100", "2024-01-01", "0000", "1")])
    want = _canon(lagjoin.lag_join_long_exploded(legs_df, obs_df).select(
        *lagjoin.lag_join_long(legs_df, obs_df, heavy=False).columns))
    assert _canon(lagjoin.lag_join_long(legs_df, obs_df, heavy=False)) == want
    assert _canon(lagjoin.lag_join_long(legs_df, obs_df, heavy=True)) == want
