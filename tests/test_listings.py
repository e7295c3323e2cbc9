"""The listing workflow end to end on a hand-made listings file, checked
against a plain-Python brute force of the same rules."""

import csv
import math
import os
import random
import tempfile

import pytest

from roomrate.functions.geo import haversine_km_py
from roomrate.plans import listings

PLACES = {"Queens": ["Astoria", "Flushing"], "Brooklyn": ["Bushwick", "Williamsburg"],
          "Manhattan": ["Harlem", "Chelsea"]}
HEADER = [f.name for f in listings.LISTING_SCHEMA.fields]


def _make_listings(n=600, seed=7):
    rnd = random.Random(seed)
    rows = []
    for i in range(n):
        borough = rnd.choice(sorted(PLACES))
        hood = rnd.choice(PLACES[borough])
        room = rnd.choice(["Private room", "Entire home/apt", "Shared room"])
        acc = rnd.choice([1, 1, 2, 3, 4])
        price = 40 + 60 * (room == "Entire home/apt") + 15 * acc + rnd.randint(0, 20)
        if i % 97 == 0:
            price = 2000 + i                      # outliers
        rows.append([i, borough, hood, round(40.7 + rnd.random() * 0.1, 8),
                     round(-73.99 + rnd.random() * 0.1, 8),
                     rnd.choice(["Apartment", "Loft", "Casa particular (Cuba)"]), room, acc,
                     rnd.choice([1, 1, 1.5, 2]), rnd.choice([1, 1, 2]), rnd.choice([1, 2, 3]),
                     rnd.choice(["Real Bed", "Futon"]), price, rnd.choice([0, 10, 200, 365]),
                     rnd.randint(60, 100)])
    rows.append([n, "Queens", "Tiny Place", 40.75, -73.9, "Apartment", "Private room", 1, 1, 1, 1,
                 "Real Bed", 80, 10, 90])          # a neighbourhood with one listing
    return rows


@pytest.fixture(scope="module")
def listing_file():
    rows = _make_listings()
    d = tempfile.mkdtemp(prefix="roomrate-listings-")
    path = os.path.join(d, "listings.csv")
    with open(path, "w", newline="") as f:
        w = csv.writer(f)
        w.writerow(HEADER)
        for j, r in enumerate(rows):
            w.writerow(r)
            if j == 300:
                w.writerow(HEADER)                 # header repeated mid-file
    return path, rows


def _zkeep(rows, k):
    prices = [r[12] for r in rows]
    m = sum(prices) / len(prices)
    sd = math.sqrt(sum((p - m) ** 2 for p in prices) / len(prices))
    return [r for r in rows if abs((r[12] - m) / sd) < k]


def test_prepare_matches_brute_force(spark, listing_file):
    path, rows = listing_file
    out = os.path.join(tempfile.mkdtemp(prefix="roomrate-prep-"), "prepared")
    prepared = listings.prepare(spark, path, out)
    counts = {}
    for r in rows:
        counts[r[2]] = counts.get(r[2], 0) + 1
    frequent = [r for r in rows if counts[r[2]] * 200 > len(rows)]
    want = {r[0] for r in _zkeep(frequent, 2.5)}
    assert {r.id for r in prepared.select("id").collect()} == want
    assert "neighbourhood_Tiny_Place" not in prepared.columns
    assert "propertyType_Casa_particular_Cuba" in prepared.columns
    assert "roomType_Entire_home_apt" in prepared.columns
    assert not set(listings.CATEGORIES) & set(prepared.columns)
    assert os.path.isdir(out)


def test_models_on_prepared_listings(spark, listing_file):
    path, _ = listing_file
    prepared = listings.prepare(spark, path)
    preds, metrics, _ = listings.global_model(prepared, max_iter=5)
    m = metrics.first()
    assert m.n == preds.count() > 0
    assert m.rmse < 25                       # price is mostly explained by room and guests
    res = listings.clustered_model(prepared, k=3, max_iter=3, stage_input=True)
    assert 1 <= res.metrics.count() <= 3
    lf = listings.leak_free_model(prepared, k=3, max_iter=3)
    assert 1 <= lf.metrics.count() <= 3


def test_comparables_match_brute_force(spark, listing_file):
    path, rows = listing_file
    df = listings.read_listings(spark, path)
    anchor = next(r for r in rows if r[1] == "Queens" and r[2] == "Astoria"
                  and r[6] == "Private room")
    got_rows, summary = listings.comparables(df, anchor[0], "Queens", "Astoria",
                                             room_type="Private room",
                                             property_type=anchor[5], bed_type=anchor[11],
                                             accommodates=anchor[7], bathrooms=anchor[8],
                                             bedrooms=anchor[9])
    kept = _zkeep(rows, 3.0)
    want = [r for r in kept if r[1] == "Queens" and r[2] == "Astoria" and r[6] == "Private room"
            and r[5] == anchor[5] and r[11] == anchor[11] and r[7] == anchor[7]
            and r[8] == anchor[8] and r[9] == anchor[9] and r[13] > 0]
    want.sort(key=lambda r: (-r[12], r[0]))
    got = got_rows.collect()
    assert [r.id for r in got] == [r[0] for r in want]
    for g, w in zip(got, want):
        assert g.distance_km == pytest.approx(haversine_km_py(anchor[3], anchor[4], w[3], w[4]),
                                              abs=1e-9)
    s = summary.first()
    assert s.n == len(want)
    if len(want) > 1:
        prices = [w[12] for w in want]
        m = sum(prices) / len(prices)
        assert s.std_samp == pytest.approx(math.sqrt(sum((p - m) ** 2 for p in prices)
                                                     / (len(prices) - 1)))
        assert s.range == max(prices) - min(prices)


def test_cli_prepare_and_global(spark, listing_file, capsys):
    from roomrate.__main__ import main

    path, _ = listing_file
    out = os.path.join(tempfile.mkdtemp(prefix="roomrate-cli-"), "prepared")
    main(["prepare", path, out])
    assert "prepared" in capsys.readouterr().out
    main(["global", out])
    assert "rmse" in capsys.readouterr().out


def test_cli_comparables(spark, listing_file, capsys):
    from roomrate.__main__ import main

    path, rows = listing_file
    anchor = next(r for r in rows if r[7] == 1 and r[8] == 1 and r[9] == 1
                  and r[13] > 0 and r[12] < 1000)
    out = os.path.join(tempfile.mkdtemp(prefix="roomrate-cli-comp-"), "report")
    main(["comparables", path, "--anchor", str(anchor[0]), "--borough", anchor[1],
          "--neighbourhood", anchor[2], "--room-type", anchor[6],
          "--property-type", anchor[5], "--bed-type", anchor[11], "--out", out])
    text = capsys.readouterr().out
    assert "std_samp" in text
    back = spark.read.option("header", True).csv(out)
    assert "distance_km" in back.columns and back.count() >= 1
