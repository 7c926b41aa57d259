"""Streams against the ordered log."""

import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from factloom.operators import progress
from factloom.streaming import breaker

LOG = "host string, seq long, at timestamp, kind string"
ROCKS = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


def log(n=400):
    rng, t = random.Random(4), dt.datetime(2026, 1, 1)
    rows = []
    for seq in range(n):
        t += dt.timedelta(minutes=rng.choice([1, 5, 90, 400]))
        rows.append((f"h{rng.randint(0, 4)}", seq, t, rng.choice(["refused", "refused", "refused", "fine", "other"])))
    return rows


def ordered(rows, limit=3, cooldown=24 * 3600 * 1000):
    """All trips of the log taken in its order."""
    state, out = {}, []
    for host, seq, at, kind in sorted(rows, key=lambda r: r[2]):
        run, until = state.get(host, (0, 0))
        ms = int(at.replace(tzinfo=dt.timezone.utc).timestamp() * 1000)
        run, until, trips = breaker.advance(run, until, ms, kind, limit, cooldown)
        state[host] = run, until
        if trips:
            out.append((host, seq))
    return sorted(out)


def test_shuffled_micro_batches_give_the_trips_of_the_ordered_log(spark, tmp_path):
    rows, rng = log(), random.Random(9)
    batches = [rows[k : k + 80] for k in range(0, len(rows), 80)]
    for batch in batches:
        rng.shuffle(batch)
    late = [[], *[batch[:5] for batch in batches[:-1]]]  # some rows come a batch late
    batches = [came + (batch[5:] if k < len(batches) - 1 else batch) for k, (came, batch) in enumerate(zip(late, batches))]
    sent = [r for b in batches for r in b]
    assert {r[1] for r in sent} == {r[1] for r in rows}
    end = max(r[2] for r in rows) + dt.timedelta(days=60)
    batches += [[("end", 10**6 + k, end + dt.timedelta(days=60 * k), "fine")] for k in range(2)]  # the watermark passes all of them
    for k, batch in enumerate(batches):
        spark.createDataFrame(batch, LOG).coalesce(1).write.mode("append").parquet(str(tmp_path / "log"))
    source = spark.readStream.schema(LOG).option("maxFilesPerTrigger", 1).parquet(str(tmp_path / "log"))
    got, old = [], spark.conf.get("spark.sql.streaming.stateStore.providerClass")
    spark.conf.set("spark.sql.streaming.stateStore.providerClass", ROCKS)
    try:
        trips = breaker.trips_stream(source, "host", "seq", "at", F.col("kind") == "refused", F.col("kind") == "fine", late="50 days")
        q = trips.writeStream.outputMode("append").foreachBatch(lambda df, _: got.extend(map(tuple, df.collect()))).option("checkpointLocation", str(tmp_path / "ck")).trigger(availableNow=True).start()
        q.awaitTermination(180)
        assert q.exception() is None
    finally:
        spark.conf.set("spark.sql.streaming.stateStore.providerClass", old)
    want = ordered(rows)
    assert len(want) > 10 and sorted((h, s) for h, s, *_ in got) == want
    assert all(until - at == dt.timedelta(hours=24) for _, _, at, until in got)
    first = {r["host"]: r["tripped_at"] for r in progress.trips(spark.createDataFrame(rows, LOG), "host", "seq", F.col("kind") == "refused", F.col("kind") == "fine").collect()}
    assert first == {h: min(s for g, s, *_ in got if g == h) for h in first}


@pytest.mark.parametrize(("kinds", "trips"), [("rrr", [2]), ("rrfr", []), ("rror", [3]), ("rrrrrr", [2]), ("rofrr", [])])
def test_one_host(kinds, trips):
    at, got, state = 0, [], (0, 0)
    for k, c in enumerate(kinds):
        at += 1000
        run, until, trip = breaker.advance(*state, at, {"r": "refused", "f": "fine", "o": "other"}[c], 3, 24 * 3600 * 1000)
        state = run, until
        got += [k] if trip else []
    assert got == trips
