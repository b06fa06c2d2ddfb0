"""Neighbour pairing equals a brute-force lead, also when one group is cut
into many pieces (a hot session)."""
import random

from pyspark.sql import functions as F

from clickscope.operators.sequence import consecutive_pairs, in_pieces


def brute(rows):
    by = {}
    for g, t, i, v in rows:
        by.setdefault(g, []).append((t, i, v))
    out = []
    for g, xs in by.items():
        xs.sort()
        out += [(g, a[2], b[2]) for a, b in zip(xs, xs[1:])]
    return sorted(out, key=str)


def test_hot_group_split_into_pieces(spark):
    rnd = random.Random(7)
    rows = []
    eid = 0
    # one hot session with a third of all rows, many small ones, singletons
    for g, n in [("hot", 600)] + [(f"s{i:03d}", rnd.randint(1, 12)) for i in range(150)]:
        for _ in range(n):
            rows.append((g, f"2024-01-01 00:00:{rnd.randint(0, 59):02d}", eid, rnd.randint(1, 10)))
            eid += 1
    df = spark.createDataFrame(rows, "g string, t string, id long, v long")
    for chars in (10, 18, 19):  # one piece a day, ten seconds, a second
        got = consecutive_pairs(df, "g", ["t", "id"], "v", piece=F.substring("t", 1, chars))
        assert sorted(map(tuple, got.collect()), key=str) == brute(rows), chars


def test_a_hot_hour_of_one_session_is_cut(spark):
    rnd = random.Random(3)
    rows = [("hot", f"2024-01-01 07:{rnd.randrange(60):02d}:{rnd.randrange(60):02d}", i, rnd.randint(1, 9))
            for i in range(2000)]  # a third of all rows in one session and hour
    rows += [(f"s{i % 400}", f"2024-01-01 {rnd.randrange(24):02d}:00:{rnd.randrange(60):02d}", 2000 + i, rnd.randint(1, 9))
             for i in range(3990)]
    rows += [(None, f"2024-01-01 07:00:0{i % 7}", 9000 + i, 1) for i in range(60)]
    df = spark.createDataFrame(rows, "g string, t string, id long, v long")
    hour, second = F.substring("t", 1, 13), F.col("t")
    cut = in_pieces(df.withColumn("_piece", hour).withColumn("_finer", second), "g", second, hot_rows=50)
    largest = cut.groupBy("g", "_piece").count().agg(F.max("count")).first()[0]
    assert df.groupBy("g", hour).count().agg(F.max("count")).first()[0] == 2000 and largest <= 50
    got = consecutive_pairs(df, "g", ["t", "id"], "v", piece=hour, finer=second, hot_rows=50)
    assert sorted(map(tuple, got.collect()), key=str) == sorted(brute(rows), key=str)
    plain = consecutive_pairs(df, "g", ["t", "id"], "v", piece=hour, finer=second)  # nothing is hot
    assert sorted(map(tuple, plain.collect()), key=str) == sorted(brute(rows), key=str)


def test_single_rows_and_empty(spark):
    df = spark.createDataFrame([("a", "t", 1, 5)], "g string, t string, id long, v long")
    assert consecutive_pairs(df, "g", ["t", "id"], "v", piece=F.col("t")).count() == 0
    empty = spark.createDataFrame([], "g string, t string, id long, v long")
    assert consecutive_pairs(empty, "g", ["t", "id"], "v", piece=F.col("t")).count() == 0
