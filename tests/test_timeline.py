import math
import random
from datetime import datetime, timedelta

import pytest

from newsloom.operators import timeline

START = datetime(2024, 1, 1)
IMPS = "impression_id string, user_id string, time timestamp_ntz, clicked_articles array<string>"


def log(seed, n=300):
    rng = random.Random(seed)
    at = lambda: START + timedelta(seconds=rng.choice([rng.randrange(4000), rng.randrange(900) * 10, rng.randrange(3 * 86400)]))
    imps = [(f"i{i:04d}", f"u{rng.choice([0, 0, 0, 1, 2, 3])}", at(), ["a"] if rng.random() < 0.4 else []) for i in range(n)]
    clicks = [(f"u{rng.choice([0, 0, 1, 2, 4])}", at()) for _ in range(n)]
    clicks += [(u, t) for _, u, t, _ in imps[:30]]  # at the very time of an impression
    return imps, clicks


def recency(imps, clicks, tau):
    out = {}
    for i, u, t, _ in imps:
        ages = [(t - c).total_seconds() for v, c in clicks if v == u and t is not None and c is not None and c < t]
        out[i] = (len(ages), min(ages, default=None), sum(math.exp(-a / tau) for a in ages))
    return out


@pytest.mark.parametrize("tau", [20.0, 3600.0, 1e7])
def test_recency_counts_only_earlier_clicks(spark, tau):
    imps, clicks = log(1)
    imps += [("null", "u0", None, [])]
    clicks += [("u0", None), ("u1", START - timedelta(days=3000))]
    got = timeline.recency_at_impression(
        spark.createDataFrame(imps, IMPS), spark.createDataFrame(clicks, "user_id string, click_time timestamp_ntz"), tau).collect()
    want = recency(imps, clicks, tau)
    assert len(got) == len(want)
    for r in got:
        n, age, total = want[r.impression_id]
        assert (r.n_clicks, r.last_click_age) == (n, age), r
        assert r.decay_sum == pytest.approx(total, rel=1e-9, abs=1e-12)


def sessions(imps, gap):
    out = {}
    for user in {u for _, u, _, _ in imps}:
        rows = sorted((t, i, int(bool(c))) for i, u, t, c in imps if u == user and t is not None)
        groups = []
        for row in rows:
            if not groups or (row[0] - groups[-1][-1][0]).total_seconds() > gap:
                groups.append([])
            groups[-1].append(row)
        for number, group in enumerate(groups, 1):
            for place, (t, i, c) in enumerate(group, 1):
                out[i] = (number, place, sum(x[2] for x in group[:place - 1]), len(group),
                          (group[-1][0] - group[0][0]).total_seconds(), pytest.approx(sum(x[2] for x in group) / len(group)))
    return out


@pytest.mark.parametrize("piece", [50.0, 3600.0, 1e8])
def test_sessions_run_on_over_the_borders_of_pieces(spark, piece):
    imps, _ = log(2)
    imps += [("null", "u0", None, [])]
    got = timeline.session_features(spark.createDataFrame(imps, IMPS), 400.0, piece).collect()
    want = sessions(imps, 400.0)
    assert {r.impression_id: tuple(r)[2:] for r in got} == want
    assert timeline.session_features(spark.createDataFrame([], IMPS)).collect() == []
