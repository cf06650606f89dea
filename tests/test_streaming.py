"""Continuous scoring: accepted + rejected = input, replay-safe, B2/B4."""

import json
import os

import pytest

from conftest import SF_SMOKE
from trip_engine import fixtures as fx
from trip_engine.operators.features import trip_features
from trip_engine.operators.model import train_duration_model
from trip_engine.sources.requests import read_requests
from trip_engine.specs import FeatureConfig
from trip_engine.streaming.scoring import read_scored, score_stream


@pytest.fixture(scope="module")
def model(spark):
    train = trip_features(fx.duration_trips(spark, SF_SMOKE), FeatureConfig(impute=False))
    return train_duration_model(train, max_iter=5, max_depth=3)


def _run(spark, model, base):
    q = score_stream(read_requests(spark, os.path.join(base, "in"), streaming=True,
                                   max_files_per_trigger=1), model,
                     os.path.join(base, "out"), os.path.join(base, "rej"),
                     os.path.join(base, "ckpt"), available_now=True)
    q.awaitTermination()
    assert q.exception() is None


def test_stream_accepts_and_rejects(spark, model, tmp_dir):
    reqs = fx.scoring_requests(spark, SF_SMOKE)
    reqs.repartition(3).write.json(os.path.join(tmp_dir, "in"))
    _run(spark, model, tmp_dir)
    out = read_scored(spark, os.path.join(tmp_dir, "out"), os.path.join(tmp_dir, "rej"))
    n_in = reqs.count()
    assert out.count() == n_in
    rej = out.filter("status = 'rejected'").collect()
    assert len(rej) > 0
    assert all(r.reject_reason.startswith("Missing feature or id: ") for r in rej)
    both = [r for r in rej if ";" in r.reject_reason]
    assert both  # rows missing vendor_id and distance carry two reasons
    # restart: nothing new, nothing duplicated
    _run(spark, model, tmp_dir)
    assert read_scored(spark, os.path.join(tmp_dir, "out"),
                       os.path.join(tmp_dir, "rej")).count() == n_in


def test_fields_bind_by_name_and_int_distance(spark, model, tmp_dir):
    inbox = os.path.join(tmp_dir, "in")
    os.makedirs(inbox)
    recs = [{"month": 3, "day": 17, "hour": 5, "id": "a", "vendor_id": 1, "passenger_count": 2,
             "store_and_fwd_flag": 0, "distance": 7},
            {"id": "b", "vendor_id": 2, "passenger_count": 1, "store_and_fwd_flag": 1,
             "hour": 23, "day": 1, "month": 6}]
    with open(os.path.join(inbox, "r.json"), "w") as fh:
        fh.write("\n".join(json.dumps(r) for r in recs))
    df = read_requests(spark, inbox).collect()
    a = [r for r in df if r.id == "a"][0]
    assert (a.hour, a.day, a.month, a.distance) == (5, 17, 3, 7.0)
    _run(spark, model, tmp_dir)
    out = {r.id: r for r in read_scored(spark, os.path.join(tmp_dir, "out"),
                                        os.path.join(tmp_dir, "rej")).collect()}
    assert out["a"].status == "accepted" and out["a"].predicted_trip_duration > 0
    assert out["b"].status == "rejected"
    assert out["b"].reject_reason == "Missing feature or id: distance"


def test_score_stream_cli(spark, model, tmp_dir):
    import sys
    from conftest import ROOT
    from trip_engine.operators.model import save_model
    sys.path.insert(0, os.path.join(ROOT, "jobs"))
    import score_stream as job
    save_model(model, os.path.join(tmp_dir, "model"))
    reqs = fx.scoring_requests(spark, SF_SMOKE)
    reqs.write.json(os.path.join(tmp_dir, "in"))
    job.main(["--requests", os.path.join(tmp_dir, "in"), "--model", os.path.join(tmp_dir, "model"),
              "--output", os.path.join(tmp_dir, "out"), "--rejects", os.path.join(tmp_dir, "rej"),
              "--checkpoint", os.path.join(tmp_dir, "ck"), "--available-now"], spark=spark)
    out = read_scored(spark, os.path.join(tmp_dir, "out"), os.path.join(tmp_dir, "rej"))
    assert out.count() == reqs.count()


def test_dead_letter_keeps_the_record_and_tells_why(spark, model, tmp_dir):
    inbox = os.path.join(tmp_dir, "in")
    os.makedirs(inbox)
    good = {"id": "g", "vendor_id": 1, "passenger_count": 2, "store_and_fwd_flag": 0, "hour": 1, "day": 2, "month": 3,
            "distance": 1.5}
    lines = [json.dumps(good), "not json at all", json.dumps({**good, "id": "w", "vendor_id": "abc"}),
             json.dumps({k: v for k, v in good.items() if k != "month"}), "[1, 2]", '"text"', '{"id": "cut", ']
    with open(os.path.join(inbox, "r.json"), "w") as fh:
        fh.write("\n".join(lines))
    _run(spark, model, tmp_dir)
    rejects = {r.raw_record: r.reject_reason for r in spark.read.parquet(os.path.join(tmp_dir, "rej")).collect()}
    assert rejects == {lines[1]: "Malformed record", lines[2]: "Wrong type: vendor_id",
                       lines[3]: "Missing feature or id: month", lines[4]: "Malformed record",
                       lines[5]: "Malformed record", lines[6]: "Malformed record"}
    assert read_scored(spark, os.path.join(tmp_dir, "out"), os.path.join(tmp_dir, "rej")).count() == len(lines)


class _Killed(RuntimeError):
    pass


def _start(spark, model, base):
    return score_stream(read_requests(spark, os.path.join(base, "in"), streaming=True, max_files_per_trigger=1), model,
                        os.path.join(base, "out"), os.path.join(base, "rej"), os.path.join(base, "ckpt"),
                        available_now=True)


@pytest.mark.parametrize("where", ["between the writes", "before the record"])
def test_a_batch_cut_off_counts_neither_half_nor_twice(spark, model, tmp_dir, monkeypatch, where):
    from trip_engine.streaming import scoring
    reqs = fx.scoring_requests(spark, SF_SMOKE)
    reqs.repartition(3).write.json(os.path.join(tmp_dir, "in"))
    real_score, real_commit = scoring.score_batch, scoring.BatchCommits.commit

    class Cut:
        @property
        def write(self):
            raise _Killed

    def score_once(batch, *args):
        preds, rejects = real_score(batch, *args)
        done = os.path.isdir(os.path.join(tmp_dir, "out", "batch=0"))
        return preds, (Cut() if done and not os.path.isdir(os.path.join(tmp_dir, "out", "batch=2")) else rejects)

    def no_record(self, batch_id, *args):
        if batch_id == 1:
            raise _Killed
        return real_commit(self, batch_id, *args)

    with monkeypatch.context() as m:
        if where == "between the writes":
            m.setattr(scoring, "score_batch", score_once)
        else:
            m.setattr(scoring.BatchCommits, "commit", no_record)
        query = _start(spark, model, tmp_dir)
        with pytest.raises(Exception):
            query.awaitTermination()
    tries = os.listdir(os.path.join(tmp_dir, "out", "batch=1"))
    assert len(tries) == 1  # the first output of batch 1 is there, but does not count
    seen = read_scored(spark, os.path.join(tmp_dir, "out"), os.path.join(tmp_dir, "rej"))
    first = seen.count()
    assert 0 < first < reqs.count() and seen.select("id").distinct().count() == first
    _run(spark, model, tmp_dir)
    out = read_scored(spark, os.path.join(tmp_dir, "out"), os.path.join(tmp_dir, "rej"))
    assert sorted(r.id for r in out.select("id").collect()) == sorted(r.id for r in reqs.select("id").collect())
    again = os.listdir(os.path.join(tmp_dir, "out", "batch=1"))
    assert len(again) == 1 and again != tries  # what the cut-off try left is gone


def test_a_replayed_batch_is_not_written_again(spark, model, tmp_dir):
    from trip_engine.streaming.scoring import read_commits, write_scored_batch
    out, rej = os.path.join(tmp_dir, "out"), os.path.join(tmp_dir, "rej")
    assert read_scored(spark, out, rej).count() == 0
    reqs = fx.scoring_requests(spark, SF_SMOKE)
    write_scored_batch(reqs, 7, model, out, rej)
    tries = os.listdir(os.path.join(out, "batch=7"))
    write_scored_batch(reqs, 7, model, out, rej)
    assert os.listdir(os.path.join(out, "batch=7")) == tries
    assert [(r.batch, r.requests) for r in read_commits(spark, out).collect()] == [(7, reqs.count())]
    assert read_scored(spark, out, rej).count() == reqs.count()


def test_accepted_requests_are_kept_without_their_record(spark, model, tmp_dir):
    from trip_engine.sources.requests import RAW, parse_requests
    from trip_engine.streaming.scoring import REASON, outcome_columns, score_batch, validate_requests
    good = {"id": "g", "vendor_id": 1, "passenger_count": 2, "store_and_fwd_flag": 0, "hour": 1, "day": 2, "month": 3,
            "distance": 1.5}
    lines = [json.dumps(good), " \t" + json.dumps({**good, "id": "s"}), '"{ a text"', json.dumps({**good, "month": "x"})]
    parsed = parse_requests(spark.createDataFrame([(x,) for x in lines], "value string"))
    kept = outcome_columns(parsed)
    assert {(r[RAW], r[REASON]) for r in kept.collect()} == {
        (None, None), (lines[2], "Malformed record"), (lines[3], "Wrong type: month")}
    assert set(kept.columns) == {*parsed.columns, REASON} - {"malformed", "wrong_type"}
    for ours, theirs in zip(score_batch(kept, model, "raw", None), score_batch(parsed, model)):
        assert sorted(map(str, ours.collect())) == sorted(map(str, theirs.collect()))
    assert validate_requests(kept, None)[1].count() == 2


def test_every_field_is_cast_once_and_what_is_wrong_is_told_without_lambdas(spark):
    from trip_engine.sources.requests import REQUEST_SCHEMA, parse_requests
    from trip_engine.streaming.scoring import outcome_columns
    good = {"id": "g", "vendor_id": 1, "passenger_count": 2, "store_and_fwd_flag": 0, "hour": 1, "day": 2, "month": 3,
            "distance": 1.5}
    lines = [json.dumps(x) for x in (good, {**good, "month": "x", "vendor_id": [1], "hour": None}, {**good, "id": ""}, {})]
    df = spark.createDataFrame([(x,) for x in [*lines, "not json", "[]", None]], "value string")
    parsed = parse_requests(df)
    assert [r.wrong_type for r in parsed.collect()] == [[], ["vendor_id", "month"], [], [], [], [], []]
    assert [r.reject_reason for r in outcome_columns(parsed).collect()] == [
        None, "Wrong type: vendor_id; Missing feature or id: hour; Wrong type: month", None,
        "; ".join(f"Missing feature or id: {k}" for k in (
            "id", "vendor_id", "passenger_count", "store_and_fwd_flag", "day", "hour", "month", "distance")),
        *["Malformed record"] * 3]
    plan = outcome_columns(parsed)._jdf.queryExecution().optimizedPlan().toString()
    assert "lambda" not in plan
    assert plan.count("try_cast(") == sum(f.dataType.typeName() != "string" for f in REQUEST_SCHEMA.fields)
