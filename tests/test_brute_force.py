"""Q1/Q2/Q3 (both variants) against a plain-Python brute force on random
dirty trips: NULL / zero / NaN / out-of-range coordinates, negative, zero and
sub-second durations, unmatched and doubly matched vendors."""

import datetime as dt
import math
import random

import pytest

from tripspark.plans import trip_queries as Q

from helpers import trips_df, vendors_df

BASE = dt.datetime(2015, 3, 9, 12, 0, 0)
CUTOFF = "2015-03-10 00:00:00"
CUT = dt.datetime(2015, 3, 10)


def random_trips(seed, n=300):
    rnd = random.Random(seed)
    rows = []
    for i in range(n):
        start = BASE + dt.timedelta(seconds=rnd.randint(0, 86400), microseconds=rnd.choice([0, 250000, 999999]))
        end = start + dt.timedelta(milliseconds=rnd.choice([-5000, 0, 400, 1000, rnd.randint(1, 3_600_000)]))

        def coord(lim):
            if rnd.random() < 0.8:
                return round(rnd.uniform(-lim, lim), 3)
            return rnd.choice([None, 0.0, math.nan, lim + 0.5, -lim, lim])

        slon, slat = coord(180.0), coord(90.0)
        elon = slon if rnd.random() < 0.1 else coord(180.0)
        elat = slat if rnd.random() < 0.1 else coord(90.0)
        rows.append((i, start, end, slon, slat, elon, elat, round(rnd.uniform(0, 500), 2)))
    vendors = [(rnd.randint(0, n + 20), rnd.randint(1, 4)) for _ in range(n)]
    return rows, vendors


def secs(t):
    return math.floor((t - dt.datetime(1970, 1, 1)).total_seconds())


def millis(t):
    return (t - dt.datetime(1970, 1, 1)) // dt.timedelta(milliseconds=1)


def ok_range(x, lim):
    return x is not None and not math.isnan(x) and -lim <= x <= lim


def haversine(r):
    _, _, _, slon, slat, elon, elat, _ = r
    p1, p2 = math.radians(slat), math.radians(elat)
    return math.sin((p2 - p1) / 2) ** 2 + math.cos(p1) * math.cos(p2) * math.sin(
        (math.radians(elon) - math.radians(slon)) / 2) ** 2


def brute_q1(rows, variant):
    acc = {}
    for r in rows:
        if variant == "dataframe" and not r[2] > r[1]:
            continue
        h = f"{r[1].hour:02d}"
        s, n = acc.get(h, (0, 0))
        acc[h] = (s + secs(r[2]) - secs(r[1]), n + 1)
    return [(h, s / n / 1000.0) for h, (s, n) in sorted(acc.items())]


def brute_q2(rows, vendors, variant):
    best = {}
    for r in rows:
        for vid, v in vendors:
            if vid == r[0]:
                k = str(v) if variant == "rdd" else v
                best[k] = max(best.get(k, -math.inf), r[7])
    return sorted(best.items())


def brute_q3(rows, vendors, variant, k=5):
    out = []
    for r in rows:
        i, start, end, slon, slat, elon, elat, _ = r
        if not (ok_range(slon, 180) and ok_range(elon, 180) and ok_range(slat, 90) and ok_range(elat, 90)):
            continue
        if 0.0 in (slon, slat, elon, elat):
            continue
        if variant == "dataframe" and (slon == elon or slat == elat):
            continue
        if not end > start:
            continue
        if variant == "dataframe" and not start >= CUT:
            continue
        if variant == "rdd" and not end > CUT:
            continue
        a = haversine(r)
        if variant == "dataframe" and not (0 <= a <= 1):
            continue
        c = 2 * math.atan2(math.sqrt(a), math.sqrt(1 - a)) if 0 <= a <= 1 else math.nan
        dist = c * 6371.0
        if variant == "dataframe":
            dur = secs(end) - secs(start)
            speed = dist / dur if dur != 0 else None
        else:
            dur = (millis(end) - millis(start)) / 1000.0
            speed = dist / dur if dur != 0 else (math.nan if dist == 0 or math.isnan(dist) else math.inf)
        for vid, v in vendors:
            if vid == i:
                out.append((speed, i, v, dist, dur))

    def key(t):
        s = t[0]
        if s is None:
            return (2, 0.0, t[1], t[2])
        if math.isnan(s):
            return (0, 0.0, t[1], t[2])
        return (1, -s, t[1], t[2])

    return sorted(out, key=key)[:k]


def close(a, b):
    if a is None or b is None:
        return a is None and b is None
    if isinstance(a, float) and math.isnan(a):
        return isinstance(b, float) and math.isnan(b)
    return a == b or abs(a - b) <= 1e-9 * max(1.0, abs(a), abs(b))


@pytest.mark.parametrize("seed", [11, 12])
@pytest.mark.parametrize("variant", ["dataframe", "rdd"])
def test_questions_match_brute_force(spark, seed, variant):
    rows, vendors = random_trips(seed)
    t, v = trips_df(spark, rows), vendors_df(spark, vendors)

    q1 = [tuple(r) for r in Q.avg_trip_duration_per_hour(t, variant=variant).collect()]
    want1 = brute_q1(rows, variant)
    assert [h for h, _ in q1] == [h for h, _ in want1]
    assert all(close(a, b) for (_, a), (_, b) in zip(q1, want1))

    q2 = [tuple(r) for r in Q.max_trip_cost_per_vendor(t, v, variant=variant).collect()]
    assert q2 == brute_q2(rows, vendors, variant)

    for method, k in (("candidates", 5), ("join", 5), ("candidates", 40)):
        got = Q.fastest_trips(t, v, variant=variant, cutoff=CUTOFF, method=method, k=k).collect()
        want = brute_q3(rows, vendors, variant, k)
        assert len(got) == len(want) >= min(k, 20)
        for g, w in zip(got, want):
            if variant == "dataframe":
                assert (g.VendorCompanyId, g.TripId, g.DurationInSec) == (w[2], w[1], w[4])
                assert close(g.SpeedInMetersPerSec, w[0]) and close(g.DistanceInMeters, w[3])
            else:
                assert g.VendorCompanyId == w[2] and close(g.SpeedInMetersPerSec, w[0])


def test_questions_on_renamed_columns(spark):
    """Column roles make the questions independent of column names."""
    from tripspark.schemas import TripRoles, VendorRoles

    rows, vendors = random_trips(5, n=120)
    t, v = trips_df(spark, rows), vendors_df(spark, vendors)
    names = {"id": "trip_id", "startDate": "pickup", "endDate": "dropoff", "startLon": "lon0",
             "startLat": "lat0", "endLon": "lon1", "endLat": "lat1", "cost": "fare"}
    t2 = t.select(*[t[c].alias(n) for c, n in names.items()])
    v2 = v.select(v["id"].alias("trip"), v["vendor"].alias("company"))
    roles = TripRoles(id="trip_id", start="pickup", end="dropoff", start_lon="lon0", start_lat="lat0",
                      end_lon="lon1", end_lat="lat1", cost="fare")
    vroles = VendorRoles(id="trip", vendor="company")
    assert Q.avg_trip_duration_per_hour(t2, roles=roles).collect() == Q.avg_trip_duration_per_hour(t).collect()
    assert Q.max_trip_cost_per_vendor(t2, v2, roles=roles, vroles=vroles).collect() == \
        Q.max_trip_cost_per_vendor(t, v).collect()
    assert Q.fastest_trips(t2, v2, cutoff=CUTOFF, roles=roles, vroles=vroles).collect() == \
        Q.fastest_trips(t, v, cutoff=CUTOFF).collect()
