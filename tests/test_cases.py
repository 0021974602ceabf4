"""The numeric cases that the operators must reproduce, on tiny tables."""

import datetime as dt
import random
from functools import reduce

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from pyrogrid.functions import fields, grid, keys
from pyrogrid.operators import cells, classify, intervals, maintain, profile, quality, route, timeseq, viewport
from pyrogrid.sources import normalize, store, versions
from pyrogrid.streaming import jobs


def hourly(spark, start, hours, step=60, sensor="MODIS"):
    t0 = dt.datetime.fromisoformat(start)
    rows = [(t0 + dt.timedelta(minutes=step * i), float(i % 90), float(i % 45), 1.0 * i) for i in range(hours)]
    df = spark.createDataFrame(rows, "acq_datetime timestamp, lon double, lat double, frp double")
    return df.withColumns({"acq_date": F.to_date("acq_datetime"), "sensor": F.lit(sensor), "year": F.year("acq_datetime")})


@pytest.mark.parametrize(
    ("archive", "window", "year", "allow", "action", "rows"),
    [
        (("2026-09-01", 13), ("2026-09-01T06:00", 18), 2026, False, "merge", 24),
        (("2026-09-01", 5), ("2026-09-08", 5), 2026, False, "refuse", 5),
        (("2026-09-01", 5), ("2026-09-08", 5), 2026, True, "merge", 10),
        (("2026-09-01", 48), ("2026-09-01T06:00", 5), 2026, False, "noop", 48),
        (None, ("2027-01-01", 30), 2027, False, "seed", 30),
        (None, ("2027-06-01", 30), 2027, False, "refuse", 0),
    ],
)
def test_merge(spark, archive, window, year, allow, action, rows):
    w = hourly(spark, *window)
    a = hourly(spark, *archive) if archive else w.limit(0)
    said, out = maintain.merge(a, w, year, allow)
    assert said.startswith(action) and out.count() == rows
    if action == "merge":
        again = maintain.merge(out, w, year, allow)[1]
        assert again.count() == rows and not quality.duplicates(out, ("sensor", "acq_datetime")).take(1)


def span(spark, lo, hi, step, sensor="MODIS"):
    n = int((dt.datetime.fromisoformat(hi) - dt.datetime.fromisoformat(lo)).total_seconds() // (60 * step)) + 1
    return hourly(spark, lo, n, step, sensor)


def test_incident(spark):
    det = span(spark, "2026-09-01T00:00", "2026-09-15T05:30", 30).union(span(spark, "2026-09-17T00:01", "2026-09-24T04:00", 30))
    lo, hi = F.lit("2026-09-01").cast("timestamp"), F.lit("2026-09-24 04:00:00").cast("timestamp")
    holes = timeseq.holes(det, "3 hours", lo=lo, hi=hi)
    (h,) = holes.collect()
    assert h["start"] == dt.datetime(2026, 9, 15, 5, 30) and h["end"] == dt.datetime(2026, 9, 17, 0, 1)
    days = timeseq.days_touched(holes, F.lit("2026-01-01").cast("date"), F.lit("2026-09-24").cast("date"))
    assert [r["day"].day for r in days.orderBy("day").collect()] == [15, 16, 17]
    assert [tuple(r)[1] for r in timeseq.runs(days, 2).orderBy("start").collect()] == [2, 1]
    refetched = span(spark, "2026-09-15T00:00", "2026-09-17T23:40", 20, "VIIRS_SNPP")
    still = lambda df: timeseq.holes(df, "3 hours", lo=lo, hi=hi)
    said, out = maintain.repair(det, refetched, days, still)
    assert said.startswith("replaced")
    assert out.filter("acq_date = DATE '2026-09-15'").agg(F.count("*"), F.countDistinct("sensor")).first()[:] == (72, 1)
    assert maintain.repair(det, refetched.filter("acq_date = DATE '2026-09-15'"), days, still)[0] == "refused: still uncovered"
    assert maintain.repair(det, refetched.limit(0), days, still)[0] == "refused: nothing was refetched"
    assert timeseq.holes(det.limit(0), "3 hours", lo=lo, hi=hi).count() == 1
    stalled = jobs.stall_alarm(det.filter("acq_datetime < TIMESTAMP '2026-09-15 06:00:00'"), lo, F.lit("2026-09-24 10:00:00").cast("timestamp")).collect()
    assert [r["end"] for r in stalled] == [dt.datetime(2026, 9, 24, 4)]


def test_totals_and_profile(spark):
    det = hourly(spark, "2031-01-01", 240)
    base = cells.base_cells(det, grid.cell(F.col("lon"), F.col("lat"), 9), keys.day_key(F.col("acq_date")), ("sensor",))
    up = cells.rollup(base, grid.parent(F.col("cell"), 3), "bucket", "sensor")
    six = cells.base_cells(det, grid.cell(F.col("lon"), F.col("lat"), 6), keys.day_key(F.col("acq_date")), ("sensor",))
    assert sorted(map(tuple, up.collect())) == sorted(map(tuple, six.collect()))
    assert base.agg(F.sum("cnt")).first()[0] == 240
    live = hourly(spark, "2031-01-08", 144)
    p = profile.collection_profile(det, live)
    assert p.first()["n_rows"] == 240 + 72 and not quality.counted_twice(p, det, live, ("acq_datetime",)).take(1)
    with pytest.raises(Exception, match="unlisted"):
        cells.wide(base, "bucket", ["20310101"], 366).collect()


def test_running_equals_direct(spark):
    rng = random.Random(3)
    rows = [(c, f"2020{m:02d}", rng.randrange(5)) for c in range(5) for m in range(1, 13) if rng.random() < 0.6]
    c = spark.createDataFrame(rows, "cell long, bucket string, cnt long")
    total = timeseq.running(c)
    for _ in range(3):
        lo, hi = sorted(f"2020{rng.randint(1, 12):02d}" for _ in range(2))
        direct = {r["cell"]: r["cnt"] for r in viewport.selected(c, lo, hi).collect()}
        got = {r["cell"]: r["cnt"] for r in timeseq.range_sum(total, lo, hi).collect()}
        assert all(got.get(k, 0) == v for k, v in direct.items())
    assert not quality.running_differs(total, c).take(1)
    dense = timeseq.dense(c, timeseq.spine(c, "month", F.lit("202001"), F.lit("202012")))
    assert dense.count() == 60 and dense.agg(F.sum("cnt")).first()[0] == sum(r[2] for r in rows)


def test_ranges_by_blocks(spark):
    rng = random.Random(9)
    ranges = [(i, rng.choice("ab"), lo, lo + rng.choice([-1, 0, 1, 5, 63, 64, 700])) for i, lo in enumerate(rng.randint(-50, 900) for _ in range(80))] + [(99, "a", None, 5)]
    points = [(i, rng.choice("ab"), rng.choice([rng.randint(-60, 1000), None])) for i in range(200)]
    r = spark.createDataFrame(ranges, "id long, unit string, lo long, hi long")
    p = spark.createDataFrame(points, "pos long, unit string, at long")
    lo, hi = F.col("lo"), F.col("hi")
    got = sorted((x["pos"], x["id"]) for x in intervals.holding(p, F.col("at"), r, lo, hi, ("unit",)).collect())
    assert got == sorted((q, i) for q, u, at in points for i, v, a, b in ranges if u == v and at is not None and a is not None and a <= at <= b)
    other = r.select(F.col("id").alias("other"), "unit", (lo + 7).alias("lo"), (hi + 9).alias("hi"))
    got = sorted((x["id"], x["other"]) for x in intervals.meeting(r, lo, hi, "id", other, lo, hi, "other", ("unit",)).collect())
    sound = [x for x in ranges if x[2] is not None]
    assert got == sorted((i, j) for i, u, a, b in sound for j, v, c, d in sound if u == v and a <= b and c + 7 <= d + 9 and a <= d + 9 and c + 7 <= b)
    assert intervals.holding(p, F.col("at"), r.limit(0), lo, hi, ("unit",)).count() == 0


def test_many_sources(spark):
    """A hundred thousand sources: no nested loops, and the owner of each day is the freshest that covers it."""
    day = lambda c: F.date_format(F.date_add(F.lit("2000-01-01"), c), "yyyyMMdd")
    lo = (F.col("i") * 7919 % 9000).cast("int")
    src = spark.range(100_000).withColumnRenamed("id", "i").select(F.format_string("s%06d", "i").alias("id"), F.lit("day").alias("unit"), day(lo).alias("min_key"), day(lo + (F.col("i") % 5).cast("int")).alias("max_key"), (F.col("i") * 31 % 100_003).alias("rebuilt"))
    buckets = spark.range(9000).select(day(F.col("id").cast("int")).alias("bucket"), F.lit("day").alias("unit"))
    owned, cover = route.owners(buckets, src), route.best_cover(buckets.select(F.col("bucket").alias("sel"), "unit", F.col("bucket").alias("lo"), F.col("bucket").alias("hi")), src)
    days = buckets.select("bucket", "unit", F.row_number().over(Window.orderBy("bucket")).cast("long").alias("pos"))
    for df in (owned, cover, timeseq.gaps(days, src.filter("id < 's001000'"))):
        plan = df._jdf.queryExecution().executedPlan().toString()
        assert "NestedLoop" not in plan and "Cartesian" not in plan
    got = {r["bucket"]: r["owner"] for r in owned.collect()}
    assert got == {r["sel"]: r["source"] for r in cover.collect()} and len(got) == 9000
    want: dict = {}
    for r in src.select("id", "min_key", "max_key", "rebuilt").collect():
        d = dt.datetime.strptime(r["min_key"], "%Y%m%d")
        while (k := d.strftime("%Y%m%d")) <= r["max_key"]:
            want[k] = max(want.get(k, (-1, 0, "")), (r["rebuilt"], -((dt.datetime.strptime(r["max_key"], "%Y%m%d") - dt.datetime.strptime(r["min_key"], "%Y%m%d")).days), r["id"]), key=lambda x: (x[0], x[1], [-ord(c) for c in x[2]]))
            d += dt.timedelta(1)
    assert all(want[k][2] == v for k, v in got.items())


def test_regions(spark):
    """Random shapes with holes, parts and the antimeridian: cells inside are not tested, and the rows are those of the exact test alone."""
    rng = random.Random(12)
    shapes = []
    for k in range(6):
        x0, y0 = rng.uniform(-200, 190), rng.uniform(-60, 50)
        rings = [[(x0 + rng.uniform(0, 40), y0 + rng.uniform(0, 35)) for _ in range(rng.randint(3, 7))] for _ in range(rng.randint(1, 3))]
        shapes.append((f"r{k}", rings + [[(x0, y0), (x0 + 60, y0), (x0 + 60, y0 + 39), (x0, y0 + 39)]] * (k % 2)))
    regions = spark.createDataFrame(shapes, "region string, rings array<array<struct<x:double,y:double>>>")
    points = [(i, rng.uniform(-180, 180), rng.uniform(-90, 90)) for i in range(3000)] + [(3000, -180.0, 0.0), (3001, 180.0, 0.0), (3002, 0.0, 90.0)]
    det = spark.createDataFrame(points, "id long, lon double, lat double")

    def holds(rings, lon, lat):
        crossed = 0
        for r in rings:
            for (ax, ay), (bx, by) in zip(r, r[1:] + r[:1]):
                crossed += (ay > lat) != (by > lat) and lon < (bx - ax) * (lat - ay) / (by - ay) + ax
        return crossed % 2 == 1

    want = sorted((i, k) for i, lon, lat in points for k, rings in shapes for turn in (-1, 0, 1) if holds(rings, lon + 360 * turn, lat))
    for step in (100, 500, 1500):
        got = sorted((r["id"], r["region"]) for r in viewport.join_regions(det, regions, step).collect())
        assert got == want
    cover = viewport.region_cover(regions, 100).groupBy(F.col("edges").isNull().alias("whole")).count().collect()
    assert {r["whole"]: r["count"] for r in cover}[True] > 3 * {r["whole"]: r["count"] for r in cover}[False]


def test_observed_gates(spark, tmp_path):
    """What is counted during the write is what the gates count in a scan of their own."""
    det = hourly(spark, "2026-01-01", 50).withColumns({"quality": F.lit("nrt"), "instrument": F.lit("MODIS"), "type": F.when(F.col("frp") % 7 == 0, 1), "lon": F.when(F.col("frp") % 5 > 0, F.col("lon")), "daynight": F.lit("D")})
    rows, seen = quality.observed(det)
    rows.write.parquet(str(tmp_path / "out"))
    counted = {r["rule"]: r["cnt"] for r in quality.row_gates(spark.read.parquet(str(tmp_path / "out"))).collect()}
    assert {k: v for k, v in seen.get.items() if v} == counted == {"rows": 50, "type": 8, "lon": 10}


def test_downsample(spark):
    rng = random.Random(5)
    for _ in range(4):
        n, w = rng.randint(1, 200), rng.randint(1, 60)
        s = spark.createDataFrame([(i, rng.randrange(9)) for i in range(n)], "idx long, value long")
        out = timeseq.downsample(s, n, w)
        assert out.count() <= max(w, 1) if n >= w else out.count() == n
        assert out.agg(F.sum("total")).first()[0] == s.agg(F.sum("value")).first()[0]


def test_axes():
    assert timeseq.axis_of_columns(["a5_cell", "count", "count_202601", "count_202603", "count_modis"])["buckets"] == 2
    for bad in (["count", "count_modis"], ["count_202601", "count_20260101"], ["count_0101"]):
        with pytest.raises(ValueError, match="axis"):
            timeseq.axis_of_columns(bad)


def test_owner_and_cover(spark):
    src = spark.createDataFrame([("latest", "day", "20260901", "20260907", 9), ("2026", "day", "20260101", "20260905", 9), ("alltime", "month", "200001", "202608", 1)], "id string, unit string, min_key string, max_key string, rebuilt long")
    b = spark.createDataFrame([("20260903", "day"), ("20260906", "day"), ("20260301", "day"), ("202607", "month")], "bucket string, unit string")
    assert {r["bucket"]: r["owner"] for r in route.owners(b, src).collect()} == {"20260903": "latest", "20260906": "latest", "20260301": "2026", "202607": "alltime"}
    axis = spark.createDataFrame([(i, f"202612{i + 1:02d}", "day") for i in range(5)], "pos long, bucket string, unit string")
    assert [tuple(r) for r in timeseq.gaps(axis, src).collect()] == [(0, 4)]
    assert tuple(timeseq.union_axis(src).first()) == ("day", "20260101", "20260907")
    d = spark.createDataFrame([(1, dt.date(2026, 12, 20), dt.date(2027, 1, 5)), (2, dt.date(2025, 2, 1), dt.date(2025, 3, 1)), (3, dt.date(2020, 2, 1), dt.date(2025, 3, 1))], "req long, lo date, hi date")
    assert {r["req"]: r["target"] for r in route.route(d, (2000, 2027), "2027-09-01").collect()} == {1: "year-2026", 2: "year-2025", 3: "alltime"}


def test_hilbert_is_one_walk(spark):
    n = 16
    pts = spark.range(n * n).select((F.col("id") % n).alias("x"), F.floor(F.col("id") / n).alias("y"))
    placed = grid.with_hilbert(pts, (F.col("x") + 0.5) / n * 360 - 180, (F.col("y") + 0.5) / n * 180 - 90, "d", bits=4)
    rows = sorted((r["d"], r["x"], r["y"]) for r in placed.collect())
    assert [r[0] for r in rows] == list(range(n * n))
    assert all(abs(a[1] - b[1]) + abs(a[2] - b[2]) == 1 for a, b in zip(rows, rows[1:]))


def test_normalize(spark, tmp_path):
    (tmp_path / "a.csv").write_text("latitude,longitude,acq_date,acq_time,satellite,confidence,bright_ti4,frp,daynight\n1.5,2.5,2026-01-02,7,n20,nominal,300,,D\n,1,2026-01-02,8,N,low,,1,N\n")
    df = normalize.read_detections_csv(spark, str(tmp_path / "a.csv"), "VIIRS_NOAA20_NRT")
    (r,) = df.collect()
    assert (r["acq_datetime"], r["satellite"], r["confidence"], r["frp"], r["type"], r["sensor"], r["brightness"]) == (dt.datetime(2026, 1, 2, 0, 7), "NOAA-20", "n", None, None, "VIIRS_NOAA20", None)
    assert not quality.schema_differs(df).take(1)
    odd = df.drop("frp").withColumns({"more": F.lit(1), "type": F.lit("x")})
    assert [tuple(r) for r in quality.schema_differs(odd).collect()] == [("frp", "double", None), ("more", None, "int"), ("type", "int", "string")]


def test_feed_fields(spark):
    rows = [(" npp ", " Sure ", "[1]"), (" Foo", "HIGH", "not json"), ("n", "low ", '{"a": 1, "b": 2}'), (None, None, None), ("AQUA", "7", '{"a": "x"}'), ("", "", '"text"')]
    df = spark.createDataFrame(rows, "s string, c string, j string")
    got = df.select(fields.platform(F.col("s")), fields.confidence(F.col("c")), fields.tolerant_json(F.col("j"), "a long")).collect()
    assert [r[0] for r in got] == ["npp", "Foo", "Suomi-NPP", None, "Aqua", ""]
    assert [r[1] for r in got] == ["Sure", "h", "l", None, "7", ""]
    assert [r[2] and r[2]["a"] for r in got[:4]] == [None, None, 1, None] and got[4][2]["a"] is None and got[5][2] is None


def test_store(spark, tmp_path):
    path = str(tmp_path / "store")
    of = lambda start, n: hourly(spark, start, n).drop("year")
    assert store.staged_swap(of("2024-03-01", 5), path, 5) == 5
    # nothing of an earlier run is counted or published, and other years stay
    assert store.staged_swap(of("2025-03-01", 7), path, 7) == 7
    with pytest.raises(ValueError, match="expected"):
        store.staged_swap(of("2025-03-01", 6), path, 7)
    bad = lambda df: df.filter("frp > 3")
    with pytest.raises(ValueError, match="refused"):
        store.staged_swap(of("2024-05-01", 6), path, 6, [bad])
    years = lambda: sorted(map(tuple, versions.read(spark, path).groupBy(F.year("acq_date")).count().collect()))
    assert years() == [(2024, 5), (2025, 7)] and len(list((tmp_path / "store" / "data").iterdir())) == 2
    # one write, in as many files as asked for, in spatial order across them
    assert store.staged_swap(of("2024-01-01", 600), path, 600, rows_per_file=200) == 600
    files = sorted((tmp_path / "store" / versions.manifest(spark, path).parts["2024"]).glob("*.parquet"))
    assert len(files) == 3 and years() == [(2024, 600), (2025, 7)]
    order = [(r["acq_date"].month, r["place"]) for f in files for r in spark.read.parquet(str(f)).select("acq_date", "place").coalesce(1).collect()]
    assert order == sorted(order)
    versions.restore(spark, path, 2)
    assert years() == [(2024, 5), (2025, 7)] and versions.manifest(spark, path).version == 4
    assert versions.vacuum(spark, path, keep=1) == 1 and years() == [(2024, 5), (2025, 7)]
    many = spark.range(4000).select((F.col("id") % 360 - 180).cast("double").alias("lon"), (F.col("id") % 180 - 90).cast("double").alias("lat"), F.to_date(F.lit("2024-01-05")).alias("acq_date"))
    assert store.write_detections(many, str(tmp_path / "parts"), rows_per_file=1000) == 4000
    assert len(list((tmp_path / "parts" / "year=2024").glob("*.parquet"))) == 4
    with pytest.raises(ValueError, match="none of"):
        store.read_part(spark, str(tmp_path), "*")


def test_chunks(spark, tmp_path):
    of = lambda start, n: hourly(spark, start, n)
    for name, df in {"2026-01-02": of("2026-01-02", 3), "2025-12-30": of("2025-12-30", 60), "2025-03-01": of("2026-02-01", 1), "bulk": of("2026-05-01", 4).drop("year", "sensor")}.items():
        df.coalesce(1).write.parquet(str(tmp_path / "tmp" / name))
        (part,) = (tmp_path / "tmp" / name).glob("*.parquet")
        (tmp_path / "in").mkdir(exist_ok=True)
        part.rename(tmp_path / "in" / f"{name}.parquet")
    rows = store.read_chunks(spark, str(tmp_path / "in"), 2026)
    assert rows.count() == 3 + 12 + 4 and "year" not in rows.columns  # a file named by another year is not opened


def test_quantiles(spark):
    rng = random.Random(4)
    values = [("a", rng.choice([0.3, 1.0, 7.0, 7.0, rng.random() * 900])) for _ in range(301)] + [("b", 5.0)] + [("c", 2.0), ("c", 3.0)] + [("d", 4.0)] * 50
    got = {r["g"]: list(r["quantiles"]) for r in classify.quantiles(spark.createDataFrame(values, "g string, value double"), ["g"], classify.QUANTILES).collect()}
    for g in "abcd":
        x = sorted(v for k, v in values if k == g)
        for q, have in zip(classify.QUANTILES, got[g]):
            r = (len(x) - 1) * q
            want = x[int(r)] + (x[min(len(x) - 1, int(r) + 1)] - x[int(r)]) * (r - int(r))
            assert abs(want - have) < 1e-9, (g, q)


def test_zooms(spark):
    bands = spark.createDataFrame([(5, 0, 4, "cells"), (8, 5, 9, "cells"), (10, 10, None, "features")], "level int, min_zoom int, max_zoom int, layer string")
    z = spark.createDataFrame([(0.0,), (4.9,), (5.0,), (9.99,), (22.0,), (-1.0,)], "zoom double")
    assert {r["zoom"]: r["level"] for r in classify.level_for_zoom(z, bands).collect()} == {0.0: 5, 4.9: 5, 5.0: 8, 9.99: 8, 22.0: 10, -1.0: None}
    assert classify.points_from(bands).first()[0] == 10 and classify.points_from(bands.filter("level < 9")).first()[0] == float("inf")


def test_gates():
    quality.nothing_written(1, True)
    with pytest.raises(ValueError, match="none were written"):
        quality.nothing_written(0, True)


def test_breaks_rise(spark):
    rows = [([3.0, 3.0, 3.0],), ([0.31, 0.32, 12.4],), ([0.02, 0.03, 0.5],)]
    got = [list(r[0]) for r in spark.createDataFrame(rows, "v array<double>").select(classify.rising(F.col("v"))).collect()]
    assert got == [[3.0, 3.1, 3.2], [0.3, 0.4, 12.0], [0.1, 0.2, 0.5]]
    s = spark.createDataFrame([([1, 5, 20],)], "b array<bigint>").select(fields.scaled_breaks(F.col("b"), F.lit(0.1))).first()[0]
    assert s == [1, 2, 3]


def test_streams(spark, tmp_path):
    det = hourly(spark, "2026-09-01", 72)
    det.write.parquet(str(tmp_path / "in"))
    stream = jobs.table_stream(spark, str(tmp_path / "in"))
    counts = jobs.run_once(jobs.live_counts(stream), "live", str(tmp_path / "c1"), "complete")
    assert sorted(r["cnt"] for r in counts.collect()) == [24, 24, 24]
    twice = det.union(det)
    twice.write.parquet(str(tmp_path / "in2"))
    one = jobs.run_once(jobs.without_repeats(jobs.table_stream(spark, str(tmp_path / "in2"))), "once", str(tmp_path / "c2"))
    assert one.count() == 72
    path = str(tmp_path / "store")
    fold = jobs.apply_window(path, 2026)
    first, second = hourly(spark, "2026-01-01", 48), hourly(spark, "2026-01-02", 48)
    for i, w in enumerate((first, second, second)):
        fold(w, min(i, 1))
    rows = lambda: versions.read(spark, path)
    assert rows().count() == 72
    written = versions.manifest(spark, path).parts
    fold(hourly(spark, "2026-01-02", 5), 2)  # covered
    fold(hourly(spark, "2026-03-01", 5), 3)  # too late
    assert versions.manifest(spark, path).parts == written
    fold(hourly(spark, "2026-01-03T12:00", 24), 4)
    assert rows().count() == 84 and not quality.duplicates(rows(), ("sensor", "acq_datetime")).take(1)
    now = versions.manifest(spark, path).parts
    assert versions.changed(written, now) == {"20260103", "20260104"}  # earlier days are not written again
    assert [m.note.split(":")[0] for m in versions.history(spark, path)] == ["seed", "merge", "noop", "refuse", "merge"]


def test_fold_is_tail_replacement(spark, tmp_path):
    """Whatever days archive and window lack: the folded table holds what merge_tail() gives, days without rows are gone."""
    rng = random.Random(8)
    day = lambda d: hourly(spark, f"2026-01-{d:02d}T0{rng.randrange(10)}:30", rng.randint(1, 14))
    days = lambda some: reduce(lambda a, b: a.union(b), [day(d) for d in some])
    cases = [([1, 2, 3], [2, 4]), ([1, 5, 6, 7], [5, 9])] + [(sorted(rng.sample(range(1, 10), 4)), [*sorted(rng.sample(range(2, 10), 2)), 12]) for _ in range(2)]
    for i, (old, new) in enumerate(cases):
        path, archive, window = str(tmp_path / f"s{i}"), days(old), days(new)
        fold = jobs.apply_window(path, 2026, allow_gap=True)
        fold(archive, 0)
        want = sorted(map(str, maintain.merge_tail(archive, window).collect()))
        before = versions.manifest(spark, path)
        # cut off between the write of the rows and the step that publishes them: the old state stands, and the batch can be folded again
        commit, versions.commit = versions.commit, lambda *a, **k: (_ for _ in ()).throw(KeyboardInterrupt())
        try:
            with pytest.raises(KeyboardInterrupt):
                fold(window, 1)
        finally:
            versions.commit = commit
        assert versions.manifest(spark, path) == before and versions.read(spark, path).count() == archive.count()
        fold(window, 1)
        assert sorted(map(str, versions.read(spark, path).collect())) == want
        assert set(versions.manifest(spark, path).parts) == {r[0].replace("-", "") for r in maintain.merge_tail(archive, window).select(F.col("acq_date").cast("string")).distinct().collect()}
        with pytest.raises(versions.Conflict):
            versions.commit(spark, path, before)
        assert versions.vacuum(spark, path, keep=1) and versions.read(spark, path).count() == len(want)


def test_kept_cells(spark, tmp_path):
    """After each fold the derived tables equal a full recount, and only parts that changed are written."""
    root, c = str(tmp_path), F.floor(F.col("lon") / 10).cast("long")
    fold = jobs.apply_window(f"{root}/detections", 2026, allow_gap=True)
    seen = []
    for i, w in enumerate([hourly(spark, "2026-01-01", 24 * 40), hourly(spark, "2026-02-08", 50), hourly(spark, "2026-02-12", 30), hourly(spark, "2026-02-11", 1)]):
        fold(w, i)
        seen.append(store.kept_cells(spark, root, c))
        det = versions.read(spark, f"{root}/detections")
        want = cells.base_cells(det, c, F.date_format("acq_date", "yyyyMMdd"), ())
        same = lambda a, b: sorted(map(str, a.select(*b.columns).collect())) == sorted(map(str, b.collect()))
        assert same(versions.read(spark, f"{root}/cells_day"), want)
        assert same(versions.read(spark, f"{root}/cells_month"), cells.again(want.withColumn("bucket", F.substring("bucket", 1, 6)), "cell", "bucket"))
        blocks, totals = versions.read(spark, f"{root}/running"), versions.read(spark, f"{root}/totals")
        for lo, hi in (("20260105", "20260214"), ("20260210", "20260211")):
            got = timeseq.block_range_sum(blocks, totals, lo, hi, lambda k: k[:6]).filter("cnt > 0")
            assert same(got, det.filter(F.date_format("acq_date", "yyyyMMdd").between(lo, hi)).groupBy(c.alias("cell")).agg(F.count("*").alias("cnt")))
    assert [len(s["days"]) for s in seen] == [40, 3, 2, 0] and [s["blocks"] for s in seen] == [{"202601", "202602"}, {"202602"}, {"202602"}, set()]


def test_reads_by_place(spark, tmp_path):
    """A small view reads a small part of the rows, and gets those that a full scan gets."""
    rng = spark.range(200_000).select((F.rand(3) * 360 - 180).alias("lon"), (F.rand(4) * 180 - 90).alias("lat"), F.to_date(F.lit("2024-01-05")).alias("acq_date"), F.col("id"))
    store.write_detections(rng, str(tmp_path / "parts"), rows_per_group=1000)
    rows = spark.read.parquet(str(tmp_path / "parts"))
    for view in ((10.0, 5.0, 25.0, 15.0), (175.0, -30.0, 190.0, -15.0), (-200.0, 60.0, -170.0, 70.0)):
        near = store.by_place(rows, view)
        got = {r["id"] for r in near.select("id").collect()}
        lon, lat = F.col("lon"), F.col("lat")
        assert got == {r["id"] for r in rows.filter(grid.in_view(lon, lat, lon, lat, view)).select("id").collect()} and got
        plan = near.select("id")._jdf.queryExecution().executedPlan()
        plan.execute().count()
        read = plan.collectLeaves().head().metrics().apply("numOutputRows").value()
        assert read < 20_000, read


@pytest.mark.parametrize("bits", [3, 6])
def test_hilbert_cover(bits):
    rng, n = random.Random(bits), 1 << bits
    for _ in range(150):
        w, s = rng.uniform(-540, 400), rng.uniform(-100, 95)
        e, north, most = w + rng.choice([0, 1, 20, 100, 300, 400]), s + rng.choice([0, 2, 30, 100]), rng.choice([1, 3, 8, 32, 1000])
        ranges = grid.hilbert_cover((w, s, e, north), most, bits)
        assert len(ranges) <= most and all(a <= b for a, b in ranges) and all(a[1] < b[0] for a, b in zip(ranges, ranges[1:]))
        for _ in range(30):
            lon, lat = rng.uniform(-180, 180), rng.uniform(-90, 90)
            place = grid.hilbert_place(min(int((lon + 180) / 360 * n), n - 1), min(int((lat + 90) / 180 * n), n - 1), bits)
            if s <= lat <= north and any(w <= lon + 360 * k <= e for k in range(-4, 5)):
                assert any(a <= place <= b for a, b in ranges)


def test_late_science_rows(spark, tmp_path):
    fold = jobs.apply_window(str(tmp_path / "store"), 2026)
    nrt = lambda *a: hourly(spark, *a).withColumn("quality", F.lit("nrt"))
    fold(nrt("2026-01-01", 72), 0)
    fold(hourly(spark, "2026-01-02", 20).withColumn("quality", F.lit("sp")), 1)
    count = lambda: {(r["day"], r["quality"]): r["count"] for r in versions.read(spark, str(tmp_path / "store")).groupBy(F.dayofmonth("acq_date").alias("day"), "quality").count().collect()}
    assert count() == {(1, "nrt"): 24, (2, "sp"): 20, (3, "nrt"): 24}
    fold(nrt("2026-01-03", 48).unionByName(hourly(spark, "2026-01-02", 22).withColumn("quality", F.lit("sp"))), 2)
    assert count() == {(1, "nrt"): 24, (2, "sp"): 22, (3, "nrt"): 24, (4, "nrt"): 24}


def test_more_streams(spark, tmp_path):
    (tmp_path / "csv").mkdir()
    raw = "latitude,longitude,acq_date,acq_time,satellite,confidence,frp\n1.5,20.5,2026-01-02,{t},n20,nominal,{p}\n50,20.5,2026-01-02,{t},n20,low,500\n,1,2026-01-02,8,N,low,1\n"
    (tmp_path / "csv" / "a.csv").write_text(raw.format(t=7, p=120))
    from pyspark.sql.types import StringType, StructField, StructType

    schema = StructType([StructField(c, StringType()) for c in raw.split("\n")[0].split(",")])
    ingested = jobs.ingest(spark, str(tmp_path / "csv"), "VIIRS_NOAA20_NRT", schema)
    batch = normalize.read_detections_csv(spark, str(tmp_path / "csv"), "VIIRS_NOAA20_NRT")
    assert sorted(map(str, jobs.run_once(ingested, "ingested", str(tmp_path / "c1")).collect())) == sorted(map(str, batch.collect()))
    ring = "array(named_struct('x', 10D, 'y', 0D), named_struct('x', 30D, 'y', 0D), named_struct('x', 30D, 'y', 10D), named_struct('x', 10D, 'y', 10D))"
    regions = spark.sql(f"SELECT 'here' AS region, {ring} AS ring")
    found = jobs.run_once(jobs.alerts(ingested, regions, 100.0), "alerts", str(tmp_path / "c2")).collect()
    assert [(r["region"], r["lat"], r["frp"]) for r in found] == [("here", 1.5, 120.0)]
    det = hourly(spark, "2026-09-01", 72)
    det.write.parquet(str(tmp_path / "in"))
    slid = jobs.run_once(jobs.rolling(jobs.table_stream(spark, str(tmp_path / "in")), "2 days", "1 day"), "slid", str(tmp_path / "c3"), "complete")
    assert sorted(r["cnt"] for r in slid.collect()) == [24, 24, 48, 48]
