import random
from datetime import datetime as dt
from datetime import timedelta

from pyspark.sql import functions as F

from lanewright.operators import store
from lanewright.streaming import streams

VALUES = "segment_id string, time string, value double, last_sample_at timestamp"


def test_keys_are_folded_without_a_state_store(spark, rows, tmp_path, monkeypatch):
    """Equal to the fold by hand over landings with late samples and repeats, also across a batch that writes all states as one."""
    monkeypatch.setattr(streams, "WHOLE_EVERY", 2)
    r, src, table, want = random.Random(5), str(tmp_path / "in"), str(tmp_path / "t"), {}
    for _ in range(4):
        part = [(f"s{r.randrange(3)}", "0800", r.choice((2.5, 3.5, -0.5, 40.0)), dt(2026, 8, 1) + timedelta(minutes=r.randrange(90))) for _ in range(40)]
        rows(VALUES, *part, ("s0", None, 1.0, dt(2026, 8, 1)), ("s1", "0800", None, dt(2026, 8, 1))).write.mode("append").parquet(src)
        for s, _, v, t in sorted(set(part), key=lambda x: (x[3], x[2])):
            avg, n, newest, late, arrived = want.get(s, (0.0, 0, t, 0, []))
            if t not in arrived:
                want[s] = float(round(avg + (v - avg) / min(n + 1, streams.traveltime.SMOOTHING))) if n else float(round(v)), n + 1, max(newest, t), late + (t < newest), [*arrived, t][-streams.REMEMBERED:]
        q = streams.fold_means(streams.read_landed(spark, src, VALUES), table, str(tmp_path / "log"))
        q.awaitTermination()
        assert q.lastProgress is None or not q.lastProgress["stateOperators"]  # no key is fetched from a store by itself
    got = {x.segment_id: (x.avg, x["count"], x.last_sample_at, x.late) for x in store.newest_of_batches(spark, table, ["segment_id", "time"]).collect()}
    assert got == {s: w[:4] for s, w in want.items()}
    assert store.batches(spark, f"{table}/whole").select(F.max("batch")).first()[0] == 2
