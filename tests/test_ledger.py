"""M1/M2 over the answer ledger: a run that dies is not paid for twice."""

import os

import pytest

from paperflow.functions.sections import FIELDS
from paperflow.operators import ledger as LG
from paperflow.session import scratch_path

GOOD = "\n\n".join(f"{f.upper()}: an answer of some length" for f in FIELDS)


def model(log, good=lambda prompt, attempt: True):
    """Writes down every call (the workers share this machine's files) and answers."""
    def call(prompt, attempt):
        with open(log, "a") as out:
            out.write(f"{prompt} {attempt}\n")
        return GOOD if good(prompt, attempt) else "no sections"
    return call


def calls(log):
    if not os.path.exists(log):
        return []
    with open(log) as f:
        return sorted(tuple(x.rsplit(" ", 1)) for x in f.read().splitlines())


def prompts(spark, n, text="p"):
    return spark.createDataFrame([(k, f"{text}{k}") for k in range(n)], "id long, prompt string")


def test_a_run_that_dies_goes_on_where_it_stopped(spark, tmp_path, monkeypatch):
    path, log = scratch_path(spark, "t-ledger"), str(tmp_path / "calls")
    even_first = model(log, lambda p, attempt: attempt > 1 or int(p[1:]) % 2 == 0)
    real, seen = LG.judged, []

    def dies(*args):
        if seen.append(1) or len(seen) == 2:  # after the first attempt's answers are written, before they are parsed
            raise RuntimeError("driver lost")
        return real(*args)

    monkeypatch.setattr(LG, "judged", dies)
    with pytest.raises(RuntimeError, match="driver lost"):
        LG.summarize(prompts(spark, 20), even_first, path, "run 1", lanes=4)
    first = calls(log)
    assert first == sorted((f"p{k}", "1") for k in range(20))
    monkeypatch.setattr(LG, "judged", real)
    got = {r["id"]: r for r in LG.summarize(prompts(spark, 20), even_first, path, "run 1", lanes=4).collect()}
    again = calls(log)
    assert sorted(set(again) - set(first)) == sorted((f"p{k}", "2") for k in range(1, 20, 2)) and len(again) == 30
    assert all(r["ok"] and r["attempts"] == 1 + k % 2 and r["reused"] == (k % 2 == 0) for k, r in got.items()) and len(got) == 20
    # a third start finds every answer
    third = LG.summarize(prompts(spark, 20), even_first, path, "run 1").collect()
    assert len(calls(log)) == 30 and all(r["reused"] and r["ok"] for r in third)


def test_a_job_lost_between_writes_loses_one_write(spark, tmp_path):
    path, log = scratch_path(spark, "t-ledger"), str(tmp_path / "calls")
    stop = {"after": 3}


    real = LG.inference._caller

    def limited(fn, attempt, per_lane):
        if not stop["after"]:
            raise RuntimeError("driver lost")
        stop["after"] -= 1
        return real(fn, attempt, per_lane)

    LG.inference._caller = limited
    try:
        with pytest.raises(RuntimeError):
            LG.summarize(prompts(spark, 60), model(log), path, "r", lanes=2, calls_per_write=10)
    finally:
        LG.inference._caller = real
    paid = len(calls(log))
    assert 0 < paid < 60 and LG.read_ledger(spark, path).count() == paid
    out = LG.summarize(prompts(spark, 60), model(log), path, "r", lanes=2, calls_per_write=10)
    assert out.filter("ok").count() == 60 and len(calls(log)) == 60 and len(set(calls(log))) == 60


def test_changed_prompts_and_new_runs(spark, tmp_path):
    path, log = scratch_path(spark, "t-ledger"), str(tmp_path / "calls")
    never = model(log, lambda p, a: False)
    first = LG.summarize(prompts(spark, 3), never, path, "monday").collect()
    assert {(r["ok"], r["attempts"], r["error"]) for r in first} == {(False, 3, "invalid or empty response")} and len(calls(log)) == 9
    again = LG.summarize(prompts(spark, 3), never, path, "monday").collect()
    assert len(calls(log)) == 9 and {r["attempts"] for r in again} == {3} and all(r["reused"] for r in again)
    # the next run tries anew, and its good answers count for any later run
    assert LG.summarize(prompts(spark, 3), model(log), path, "tuesday").filter("ok and attempts = 1 and not reused").count() == 3
    assert LG.summarize(prompts(spark, 3), never, path, "wednesday").filter("ok and reused").count() == 3 and len(calls(log)) == 12
    # another prompt is another question
    assert LG.summarize(prompts(spark, 3, "q"), model(log), path, "wednesday").filter("ok and not reused").count() == 3
    assert len(calls(log)) == 15


def test_errors_nulls_and_an_empty_queue(spark, tmp_path):
    path = scratch_path(spark, "t-ledger")

    def broken(prompt, attempt):
        raise ValueError(f"attempt {attempt}")

    df = spark.createDataFrame([(1, None), (2, "p"), (2, "p")], "id long, prompt string")
    got = sorted(LG.summarize(df, broken, path, "r").collect())
    assert [(r["id"], r["ok"], r["attempts"], r["error"]) for r in got] == [(k, False, 3, "ValueError: attempt 3") for k in (1, 2)]
    assert LG.read_ledger(spark, path).count() == 6
    assert LG.summarize(df.filter("id > 5"), broken, path, "r").count() == 0


def test_the_drain_needs_a_run_id(spark, sf):
    from paperflow.sources import standins as S
    from paperflow.streaming import drain
    with pytest.raises(ValueError):
        drain.drain(S.papers(spark, sf), S.summaries(spark, sf), None, lambda p, a: "", "m", ledger_path="x")
