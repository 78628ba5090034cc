import random

from lapse.operators.ranking import running_totals, with_positions


def test_positions_and_totals(spark):
    rnd = random.Random(7)
    rows = [(g, i, rnd.randint(0, 5)) for g in ("a", "b", "c") for i in range(rnd.randint(1, 60))]
    rnd.shuffle(rows)
    df = spark.createDataFrame(rows, "g string, k long, v long")
    pos = {(r["g"], r["k"]): r["pos"] for r in with_positions(df, ["g"], ["k"], num_partitions=5).collect()}
    for g in ("a", "b", "c"):
        ks = sorted(k for gg, k, _ in rows if gg == g)
        assert [pos[(g, k)] for k in ks] == list(range(len(ks)))
    tot = {(r["g"], r["k"]): r["cum_v"] for r in running_totals(df, ["g"], ["k"], ["v"], num_partitions=4).collect()}
    for g in ("a", "b", "c"):
        acc = 0
        for gg, k, v in sorted((r for r in rows if r[0] == g), key=lambda r: r[1]):
            acc += v
            assert tot[(gg, k)] == acc
    glob = with_positions(df, [], ["g", "k"], num_partitions=3).collect()
    assert sorted(r["pos"] for r in glob) == list(range(len(rows)))
