"""Available-now run, re-read, restart from the checkpoint adds no duplicates."""

from pyspark.sql import functions as F

from paths import SF_ORACLE
from riskspark.session import scratch_path
from riskspark.streaming.feedback import (feedback_records, parse_requests, rejected_requests, run_feedback_stream,
                                         start_rejected_stream, start_request_stream, outcomes, read_outcomes, start_outcome_stream)


def test_stream_then_restart(spark):
    base = scratch_path(spark, "stream-test")
    out = run_feedback_stream(spark, SF_ORACLE, f"{base}/sink", f"{base}/ckpt", pattern="events.parquet")
    levels = {r.level: r["count"] for r in out.groupBy("level").count().collect()}
    assert levels == {"ERROR": 2014, "INFO": 7986}
    again = run_feedback_stream(spark, SF_ORACLE, f"{base}/sink", f"{base}/ckpt", pattern="events.parquet")
    assert again.count() == 10000
    assert again.select("event_id").distinct().count() == 10000


def test_request_defaults(spark):
    raw = spark.createDataFrame([
        ('{"message": "hello", "is_positive": false, "custom_dimensions": {"page": "x"}}',),
        ("{}",),
    ], "body string")
    rows = feedback_records(parse_requests(raw), null_is_missing=False).collect()
    assert (rows[0].message, rows[0].is_positive, rows[0].level, rows[0].custom_dimensions) == \
        ("hello", False, "ERROR", {"page": "x"})
    assert (rows[1].message, rows[1].is_positive, rows[1].level, rows[1].custom_dimensions) == \
        ("Message vide", True, "INFO", {})


BODIES = ['{"is_positive": null}', '{"is_positive": 0}', '{"is_positive": ""}', '{"is_positive": []}', '{"is_positive": "false"}',
          '{"is_positive": 2.5}', '{"message": null}', '{"custom_dimensions": null}', "not json", "", "[1]", "3", None]


def test_missing_is_not_null_and_bad_bodies_are_rejected(spark):
    raw = spark.createDataFrame([(i, b) for i, b in enumerate(BODIES)], "n int, body string")
    rows = {r.n: r for r in feedback_records(parse_requests(raw), null_is_missing=False).collect()}
    assert [rows[i].level for i in range(8)] == ["ERROR"] * 4 + ["INFO"] * 4
    assert rows[6].message is None and rows[7].custom_dimensions is None and rows[0].message == "Message vide"
    assert sorted(r.n for r in rejected_requests(raw).collect()) == [8, 9, 10, 11, 12]


def test_rejected_bodies_have_their_own_sink(spark):
    base = scratch_path(spark, "bodies-test")
    spark.createDataFrame([(b,) for b in BODIES if b is not None], "body string").write.text(f"{base}/bodies")
    for start, name in ((start_request_stream, "good"), (start_rejected_stream, "bad")):
        start(spark, f"{base}/bodies", f"{base}/{name}", f"{base}/{name}-ckpt").awaitTermination()
    assert spark.read.parquet(f"{base}/good").count() == 8
    assert sorted(r.body for r in spark.read.parquet(f"{base}/bad").collect()) == ["", "3", "[1]", "not json"]


def _rows(frame):
    return sorted((tuple(r) for r in frame.collect()), key=repr)


def test_outcomes_equal_the_two_parsers(spark):
    raw = spark.createDataFrame([(i, b) for i, b in enumerate(BODIES)], "n int, body string")
    both = outcomes(raw)
    good = feedback_records(parse_requests(raw), null_is_missing=False)
    assert _rows(both.where("outcome = 'accepted'").select(*good.columns)) == _rows(good)
    assert _rows(both.where("outcome = 'rejected'").select("n", "body")) == _rows(rejected_requests(raw).select("n", "body"))
    plan = both._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("Union") == 0


def test_a_batch_that_fails_after_writing_leaves_no_row_twice(spark, monkeypatch):
    import pytest
    from pyspark.errors import StreamingQueryException

    import riskspark.streaming.feedback as module

    base = scratch_path(spark, "outcomes-test")
    bodies = [b for b in BODIES if b] + [f'{{"message": "m{i}"}}' for i in range(40)]
    spark.createDataFrame([(b,) for b in bodies], "body string").repartition(5).write.text(f"{base}/bodies")
    real, calls = module.outcomes, []

    def dies(batch, **more):
        calls.append(1)
        out = real(batch, **more)
        if len(calls) == 2:  # this batch is written, but not taken down as done
            out.write.partitionBy("outcome").mode("overwrite").parquet(f"{base}/sink/batch=1")
            raise RuntimeError("lost")
        return out

    def run():
        start_outcome_stream(spark, f"{base}/bodies", f"{base}/sink", f"{base}/checkpoint", files_per_batch=1).awaitTermination()

    monkeypatch.setattr(module, "outcomes", dies)
    with pytest.raises(StreamingQueryException):
        run()
    run()
    run()  # nothing is left to do
    good, bad = read_outcomes(spark, f"{base}/sink")
    want = real(spark.createDataFrame([(b,) for b in bodies], "body string"))
    assert _rows(good) == _rows(want.where("outcome = 'accepted'").select(*good.columns))
    assert _rows(bad) == _rows(want.where("outcome = 'rejected'").select("body")) and bad.count() == 3
    assert len(calls) == 6
