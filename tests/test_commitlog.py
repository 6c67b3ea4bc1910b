import pytest

from voltstream.streaming.commitlog import KEPT_BATCHES, CommitLog


@pytest.fixture
def log(spark, tmp_path):
    return CommitLog(spark, str(tmp_path / "log"))


def test_facts_of_a_step_and_batch(log):
    assert not log.has("a", 0) and log.get("a", 0) is None and log.last("a", 9) is None
    log.add("a", 0)
    log.add("a", 3, {"rows": 7, "word": "é"})
    assert log.has("a", 0) and log.get("a", 0) == {}
    assert log.get("a", 3) == {"rows": 7, "word": "é"}
    assert not log.has("b", 3) and not log.has("a", 1)


def test_the_newest_batch_before_a_number(log):
    for n in (2, 10, 9):
        log.add("a", n, {"n": n})
    log.add("a.b", 30, {"n": 30})
    assert [log.last("a", n) and log.last("a", n)["n"] for n in (2, 3, 10, 11, 99)] == [None, 2, 9, 10, 10]


def test_a_step_may_be_noted_again(log):
    log.add("a", 1, {"n": 1})
    log.add("a", 1, {"n": 2})
    assert log.get("a", 1) == {"n": 2}


def test_old_batches_leave(log, tmp_path):
    for n in range(KEPT_BATCHES + 5):
        log.add("a", n)
    assert not log.has("a", 4) and log.has("a", 5)
    assert len([f for f in (tmp_path / "log").iterdir() if not f.name.startswith(".")]) == KEPT_BATCHES


def test_names_of_any_kind_and_frames_outside_of_streams(log):
    log.add("0.fan-out/1:x", 4, {"n": 1})
    assert log.get("0.fan-out/1:x", 4) == {"n": 1}
    log.add("a", None)
    assert not log.has("a", None)


def test_a_log_outlives_its_session_object(spark, log, tmp_path):
    log.add("a", 1, {"n": 5})
    assert CommitLog(spark, str(tmp_path / "log") + "/").last("a", 2) == {"n": 5}
