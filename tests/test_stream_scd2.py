import random

import pytest

from lake_helpers import rows
from lakeops.operators.history import scd2_history
from lakeops.streaming.scd2 import KeyDirectory, StreamingSCD2, split_bucket

SCHEMA = "k string, seq string, a string, u double"


def test_shuffled_micro_batches_equal_batch_build(spark, tmp_path):
    rnd = random.Random(11)
    data = [(f"k{k}", f"2024{m:02d}{d:02d}", rnd.choice("AB"), float(d))
            for k in range(5) for m in range(1, 13) for d in (1, 15) if rnd.random() < 0.8]
    # duplicate deliveries (same key and sequence) are part of the input
    data += data[:7]
    rnd.shuffle(data)
    land = tmp_path / "landing"
    for i in range(0, len(data), 25):  # files arrive in shuffled order, late rows included
        spark.createDataFrame(data[i:i + 25], SCHEMA).coalesce(1).write.mode("append").parquet(str(land))
    stream = spark.readStream.schema(SCHEMA).option("maxFilesPerTrigger", 1).parquet(str(land))
    job = StreamingSCD2(spark, str(tmp_path / "state"), ["k"], "seq", untracked=["u"], bucket_rows=40)
    job.run(stream, str(tmp_path / "ckpt"))
    batch = scd2_history(spark.createDataFrame(data, SCHEMA), ["k"], "seq", untracked=["u"])
    cols = ["k", "a", "u", "valid_from", "valid_to"]
    assert rows(job.read(), *cols) == rows(batch, *cols)
    # one folder per bucket instead of one per batch: the history stays the same
    job.compact(stream.schema)
    job.process(spark.createDataFrame(data[:3], SCHEMA), 0, "again")
    assert rows(job.read(), *cols) == rows(batch, *cols)


def test_null_keys_and_a_new_checkpoint_keep_history(spark, tmp_path):
    days = [[("x", "20240101", "A", 1.0), (None, "20240101", "A", 1.0)], [("x", "20240201", "B", 1.0), (None, "20240301", "B", 2.0)]]
    job = StreamingSCD2(spark, str(tmp_path / "state"), ["k"], "seq", untracked=["u"], bucket_rows=40)
    for i, day in enumerate(days):  # each with a checkpoint of its own, so both are batch 0
        spark.createDataFrame(day, SCHEMA).coalesce(1).write.parquet(str(tmp_path / f"land{i}"))
        job.run(spark.readStream.schema(SCHEMA).parquet(str(tmp_path / f"land{i}")), str(tmp_path / f"ckpt{i}"))
    assert rows(job.read(), "k", "a", "valid_from", "valid_to") == [
        ("x", "A", "20240101", "20240201"), ("x", "B", "20240201", None),
        (None, "A", "20240101", "20240301"), (None, "B", "20240301", None)]
    # a replayed batch adds nothing
    again = spark.createDataFrame(days[1], SCHEMA)
    job.process(again, 7, "r")
    job.process(again, 7, "r")
    assert job.read().count() == 4


COLS = ["k", "a", "u", "valid_from", "valid_to"]


def test_buckets_split_by_size():
    counts = [(i, 10, 2) for i in range(64)]
    parts = split_bucket("", counts, 50, 16)
    assert sum(parts.values()) == 640 and max(parts.values()) <= 50 and len(parts) == 16
    # one key fills its bucket: split off from the others, not split itself
    parts = split_bucket("", [*counts, (5, 4000, 4000)], 50, 16)
    assert sum(parts.values()) == 4640 and len(parts) == 1
    parts = split_bucket("", [(i, 100, 2) for i in range(64)] + [(5, 3000, 3000)], 200, 16)
    assert len([n for n in parts.values() if n > 200]) == 1 and len(parts) > 16
    assert split_bucket("", [(0, 500, 3)], 50, 16) == {"": 500} and len(split_bucket("", [(i, 99, 9) for i in range(4)], 50, 1)) == 2


def test_every_hash_has_one_bucket():
    d = KeyDirectory({"b0": [[None, 0, 0]], "b10": [[None, 0, 0]], "b110": [[None, 0, 0]], "b111": [[None, 0, 0]]})
    assert [d.label_of(f"{i:03b}"[::-1]) for i in range(8)] == ["b0", "b10", "b0", "b110", "b0", "b10", "b0", "b111"]


def test_a_small_batch_rewrites_few_buckets(spark, tmp_path):
    first = spark.range(10_000).selectExpr("concat('k', id) as k", "'20240101' as seq", "'A' as a", "1d as u")
    job = StreamingSCD2(spark, str(tmp_path / "state"), ["k"], "seq", untracked=["u"], bucket_rows=50)
    assert job.process(first, 0, "r")["places"] >= 200
    few = spark.range(8).selectExpr("concat('k', id * 811) as k", "'20240201' as seq", "'B' as a", "2d as u")
    before = {f.name: f.stat().st_mtime_ns for f in (tmp_path / "state" / "history").rglob("*.parquet")}
    got = job.process(few, 1, "r")
    assert got["rewritten"] < 0.05 * got["places"]
    after = {f.name for f in (tmp_path / "state" / "history").rglob("*.parquet")}
    assert len(set(before) - after) < 0.05 * len(before)
    assert rows(job.read(), *COLS) == rows(scd2_history(first.union(few), ["k"], "seq", untracked=["u"]), *COLS)


@pytest.mark.parametrize("seed", [1, 2])
def test_a_hot_key_is_split_by_sequence(spark, tmp_path, seed):
    rnd = random.Random(seed)
    data = [("hot", f"{20240000 + i}", rnd.choice("AB"), float(i)) for i in range(300)]
    data += [(f"k{i % 9}", f"{20240000 + i}", rnd.choice("AB"), 1.0) for i in range(0, 300, 4)]
    data += [(None, "20240005", "A", 0.0), ("hot", None, "Z", -1.0)]
    rnd.shuffle(data)
    job = StreamingSCD2(spark, str(tmp_path / "state"), ["k"], "seq", untracked=["u"], bucket_rows=40)
    done = []
    for i in range(0, len(data), 130):
        done += data[i : i + 130]
        job.process(spark.createDataFrame(data[i : i + 130], SCHEMA), i, "r")
        assert rows(job.read(), *COLS) == rows(scd2_history(spark.createDataFrame(done, SCHEMA), ["k"], "seq", untracked=["u"]), *COLS)
    directory = job.directory()
    assert directory.ranged() and max(r[2] for ranges in directory.leaves.values() for r in ranges) <= 2 * 40
    # a late row touches its own range only
    late = spark.createDataFrame([("hot", "20240100", "C", 9.0)], SCHEMA)
    assert job.process(late, 10_000, "r")["rewritten"] == 1
    assert rows(job.read(), *COLS) == rows(scd2_history(spark.createDataFrame(done, SCHEMA).union(late), ["k"], "seq", untracked=["u"], tie_break=[]), *COLS)


def test_a_batch_that_broke_off_is_replayed(spark, tmp_path, monkeypatch):
    data = [(f"k{i}", "20240101", "A", 1.0) for i in range(60)]
    more = [(f"k{i}", "20240201", "B", 2.0) for i in range(30, 90)]
    job = StreamingSCD2(spark, str(tmp_path / "state"), ["k"], "seq", untracked=["u"], bucket_rows=40)
    job.process(spark.createDataFrame(data, SCHEMA), 0, "r")
    want = rows(job.read(), *COLS)
    for step in ("_publish", "_delete"):
        with monkeypatch.context() as m:
            m.setattr(job, step, lambda *_: (_ for _ in ()).throw(OSError("broke off")))
            with pytest.raises(OSError):
                job.process(spark.createDataFrame(more, SCHEMA), 1, "r")
        if step == "_publish":  # not published: buckets the directory doesn't name aren't read
            assert {r[0] for r in rows(job.read(), "k")} >= {r[0] for r in want}
    job.process(spark.createDataFrame(more, SCHEMA), 1, "r")
    assert rows(job.read(), *COLS) == rows(scd2_history(spark.createDataFrame(data + more, SCHEMA), ["k"], "seq", untracked=["u"]), *COLS)


def test_a_fail_rule_stops_the_batch_before_its_write(spark, tmp_path):
    from lakeops.operators.expectations import ExpectationFailed, expect, expect_or_drop, expect_or_fail
    from lakeops.streaming.expected import read_counts
    rules = [expect_or_fail("valid_key", "k IS NOT NULL"), expect_or_drop("has_a", "a <> 'X'"), expect("small", "u < 5")]
    job = StreamingSCD2(spark, str(tmp_path / "state"), ["k"], "seq", untracked=["u"], expectations=rules)
    job.process(spark.createDataFrame([("x", "20240101", "A", 1.0), ("y", "20240101", "X", 9.0)], SCHEMA), 0, "r")
    with pytest.raises(ExpectationFailed):
        job.process(spark.createDataFrame([("x", "20240201", "B", 1.0), (None, "20240201", "A", 1.0)], SCHEMA), 1, "r")
    assert rows(job.read(), "k", "a", "valid_to") == [("x", "A", None)]
    assert rows(read_counts(spark, str(tmp_path / "state" / "expectations")), "batch", "rule", "rows", "violations") == [
        (0, "has_a", 2, 1), (0, "small", 2, 1), (0, "valid_key", 2, 0)]


def test_stream_rules_count_every_batch(spark, tmp_path):
    from pyspark.errors import StreamingQueryException

    from lakeops.operators.expectations import expect, expect_or_drop, expect_or_fail
    from lakeops.streaming.expected import read_counts, run_expected
    rules = [expect_or_fail("valid_key", "k IS NOT NULL"), expect_or_drop("has_a", "a <> 'X'"), expect("small", "u < 5")]
    land = tmp_path / "land"
    for i in range(5):
        spark.createDataFrame([(f"k{i}", "20240101", "X" if i == 2 else "A", float(2 * i))], SCHEMA).coalesce(1).write.mode("append").parquet(str(land))
    at = {"table": str(tmp_path / "t"), "checkpoint": str(tmp_path / "ck"), "counts": str(tmp_path / "counts")}
    stream = lambda: spark.readStream.schema(SCHEMA).option("maxFilesPerTrigger", 1).parquet(str(land))
    run_expected(stream(), rules, **at)
    seen = read_counts(spark, at["counts"])
    assert seen.select("batch").distinct().count() == 5
    want = [("has_a", 5, 1), ("small", 5, 2), ("valid_key", 5, 0)]
    totals = lambda: rows(read_counts(spark, at["counts"]).groupBy("rule").agg({"rows": "sum", "violations": "sum"}))
    assert [(r, a, b) for r, *ab in totals() for a, b in [sorted(ab, reverse=True)]] == want
    spark.createDataFrame([(None, "20240101", "A", 1.0)], SCHEMA).coalesce(1).write.mode("append").parquet(str(land))
    with pytest.raises(StreamingQueryException):
        run_expected(stream(), rules, **at)
    assert spark.read.parquet(at["table"]).count() == 4 and len(totals()) == 3
