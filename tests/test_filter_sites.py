import random

from pyspark.sql import functions as F

from strandline import schemas
from strandline.operators import intervals, ordered
from strandline.plans import filter_sites
from strandline.streaming import session_islands


def _read(name, flag, pos, cigar, next_chrom, next_pos, mapq=60):
    n = sum(x for op, x in cigar if op in "MIS")
    return (name, flag, "1", pos, mapq, cigar, next_chrom, next_pos, 0, "ACGT" * (n // 4) + "A" * (n % 4), "I" * n, {})


def test_clips_and_discordants(spark):
    rows = [
        _read("left", 64, 1000, [("S", 20), ("M", 80)], "2", 50),
        _read("right", 64, 930, [("M", 80), ("S", 20)], "1", 9000),
        _read("short", 64, 1000, [("S", 8), ("M", 80)], "2", 50),
        _read("duplicate", 64 | schemas.DUPLICATE, 1000, [("S", 20), ("M", 80)], "2", 50),
        _read("near mate", 64, 900, [("M", 100)], "1", 2900),
        _read("decoy", 64, 900, [("M", 100)], "hs37d5", 2900),
        _read("low", 64, 900, [("M", 100)], "2", 2900, mapq=19),
        _read("far away", 64, 2000, [("M", 100)], "2", 1),
    ]
    reads = spark.createDataFrame(rows, schemas.ALIGNMENT)
    at = filter_sites.reads_at_sites(spark.createDataFrame([("1", 1005)], "chrom string, pos long"), reads, filter_sites.Params())
    assert sorted((r.name, r.side, r.clip_pos, len(r.bases)) for r in filter_sites.clips(at, filter_sites.Params()).collect()) == [("left", "L", 1000, 20), ("right", "R", 1010, 20)]
    assert sorted(r.name for r in filter_sites.discordants(at, filter_sites.Params()).collect()) == ["left", "right"]


def test_three_planted_sites(spark):
    clips, mates = [], []
    for site, sides in ((1000, "LR"), (2000, "L"), (3000, "R"), (4000, "LR")):
        for side in sides:
            clips += [("1", site, side, site + (15 if side == "R" else 0), 10 + i) for i in range(4)]
        n = 5 if site == 4000 else 8
        mates += [("1", site, sample, 100 + 10 * i) for sample in (0, 1) for i in range(n)]
    c = spark.createDataFrame(clips, "chrom string, site_pos long, side string, clip_pos long, cns_pos long")
    m = spark.createDataFrame(mates, "chrom string, site_pos long, sample_id int, cns_pos long")
    got = sorted(map(tuple, filter_sites.confirmed_sites(c, m, 2).collect()))
    assert got == [("1", 1000, 15), ("1", 2000, 0), ("1", 3015, 0)]


def test_max_cover_and_islands_against_brute_force(spark):
    rng = random.Random(3)
    groups = {g: [rng.randrange(0, 300) for _ in range(rng.randint(1, 25))] for g in range(40)}
    df = spark.createDataFrame([(g, p) for g, ps in groups.items() for p in ps], "g long, p long")
    best = lambda ps: max(((sum(s <= q <= s + 50 for q in ps), -s) for s in ps), default=(0, None))
    for r in ordered.max_cover(df, ["g"], "p", 50).collect():
        ps = groups[r.g]
        n, start = best(ps)
        rest = [q for q in ps if not -start <= q <= -start + 50]
        assert (r.n, r.count1, r.start1, r.count2) == (len(ps), n, -start, best(rest)[0])
    for r in ordered.islands(df, ["g"], "p", 20).collect():
        ps = sorted(groups[r.g])
        assert r.island == sum(b - a > 20 for a, b in zip(ps, ps[1:], strict=False) if b <= r.p)


def test_session_islands(spark, tmp_path):
    spark.createDataFrame([(1, "2024-01-01 00:00:00"), (1, "2024-01-01 00:05:00"), (1, "2024-01-01 02:00:00")], "k long, s string").selectExpr("k", "CAST(s AS TIMESTAMP) AS at").write.parquet(str(tmp_path / "in"))
    stream = spark.readStream.schema("k long, at timestamp").parquet(str(tmp_path / "in"))
    q = session_islands(stream, ["k"], "at", "10 minutes", "1 hour").writeStream.outputMode("complete").format("memory").queryName("sessions").start()
    q.processAllAvailable()
    q.stop()
    assert sorted(r.n for r in spark.sql("SELECT n FROM sessions").collect()) == [1, 2]


def test_calls_to_sites_end_to_end(spark):
    """Two samples; of three called sites one has clips and mates, one clips only, and one too few mates in a sample."""
    samples = []
    for sample in range(2):
        rows = []
        for site, n in ((1000, 8), (3000, 0), (5000, 8 if sample else 3)):
            for i in range(4):
                rows.append(_read(f"l{site}.{i}", 64, site, [("S", 20), ("M", 80)], "1", site + 300))
                rows.append(_read(f"r{site}.{i}", 64, site - 65, [("M", 80), ("S", 20)], "1", site + 300))
            for i in range(n):
                rows.append(_read(f"d{site}.{i}", 64, site - 200 + i, [("M", 100)], "2", 70_000 + i))
                rows.append(_read(f"d{site}.{i}", 128, 70_000 + i, [("M", 100)], "1", site - 200 + i)[:2] + ("2",) + _read("", 128, 70_000 + i, [("M", 100)], "1", site - 200 + i)[3:])
        samples.append(spark.createDataFrame(rows, schemas.ALIGNMENT))
    calls = spark.createDataFrame([("1", 1004, None, 4, 2), ("1", None, 2998, 1, 3), ("1", 5001, 5001, 3, 3), ("1", None, None, 0, 0)], "chr string, pbp long, nbp long, pcr long, ncr long")
    realign = lambda df: df.withColumn("cns_pos", F.char_length("bases").cast("long"))
    got = sorted(map(tuple, filter_sites.call_sites(calls, samples, realign).collect()))
    assert got == [("1", 1000, 15)]
    assert filter_sites.call_sites(calls.limit(0), samples, realign).count() == 0


def test_hot_key_is_spread_over_bins(spark):
    rng = random.Random(8)
    points = sorted(rng.randrange(0, 3_000_000) for _ in range(3000))
    df = spark.createDataFrame([(1, p, 1) for p in points], "g long, p long, n long")
    got = {r.p: r.sum_n for r in ordered.neighbour_sums(df, ["g"], "p", ["n"], 700, 500).collect()}
    assert got == {p: sum(p - 700 <= q <= p + 500 for q in points) for p in set(points)}
    number, last, want = 0, points[0], {}
    for p in points:
        number += p - last > 900
        want[p], last = number, p
    assert {r.p: r.island for r in ordered.islands(df, ["g"], "p", 900).collect()} == want
    asked = [rng.randrange(-10, 3_100_000) for _ in range(500)]
    left = spark.createDataFrame([(1, a) for a in asked] + [(2, 5)], "g long, a long")
    right = df.where("p > 200000 AND (p < 900000 OR p > 2500000)")
    known = [p for p in points if 200_000 < p and (p < 900_000 or p > 2_500_000)]
    seen = intervals.asof_join(left, right, ["g"], "a", "p", ["n"], "_", 1 << 15).collect()
    assert sorted((r.g, r.a, r._p or -1) for r in seen) == sorted([(1, a, max((p for p in known if p <= a), default=-1)) for a in asked] + [(2, 5, -1)])
