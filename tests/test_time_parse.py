"""The guarded multi-format parser gives the same result as trying every format."""

import random

from pyspark.sql import functions as F

from cohortium.functions.time import parse_mixed_timestamp, parse_mixed_timestamp_unguarded


def _samples():
    rnd = random.Random(5)
    out = [None, "", " ", "not a date", "2024-02-30", "2024-13-01 10:00:00", "2024-03-10 02:30:00",
           "2024-3-5", "2024-3-5 7:8:9", "2024-03-05t07:08:09z", "2024-03-05T07:08:09.5Z",
           "2024-03-05T07:08:09.123456Z", "2024-03-05T07:08:09.1234567Z", " 2024-03-05", "2024-03-05 ",
           "2024-03-05T07:08:09", "2024-03-05 07:08:09Z", "2024/03/05", "07:08:09", "2024-03-05T07:08Z"]
    fmts = ["{y}-{m:02d}-{d:02d}T{H:02d}:{M:02d}:{S:02d}.{f:06d}Z", "{y}-{m:02d}-{d:02d}T{H:02d}:{M:02d}:{S:02d}Z",
            "{y}-{m:02d}-{d:02d} {H:02d}:{M:02d}:{S:02d}", "{y}-{m:02d}-{d:02d}", "{y}-{m}-{d} {H}:{M}:{S}"]
    for _ in range(400):
        v = dict(y=rnd.randint(1990, 2030), m=rnd.randint(1, 12), d=rnd.randint(1, 31), H=rnd.randint(0, 23),
                 M=rnd.randint(0, 59), S=rnd.randint(0, 59), f=rnd.randint(0, 999999))
        t = rnd.choice(fmts).format(**v)
        if rnd.random() < 0.2:
            t = t.lower()
        if rnd.random() < 0.1:
            t = t[: rnd.randint(0, len(t))]
        out.append(t)
    return out


def test_guarded_parse_equals_unguarded(spark):
    df = spark.createDataFrame([(i, t) for i, t in enumerate(_samples())], "i int, t string")
    rows = df.select("i", parse_mixed_timestamp(F.col("t")).alias("a"),
                     parse_mixed_timestamp_unguarded(F.col("t")).alias("b")).collect()
    assert all(r.a == r.b for r in rows), [r for r in rows if r.a != r.b][:5]
    assert sum(r.a is not None for r in rows) > 300
