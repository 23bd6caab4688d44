"""State calls of keyed processors: a key pays for its batches, not for its panes, windows or rows."""

from collections import Counter

import pytest
from pyspark.sql import Row

from millrace.streaming import machine_time as T
from millrace.streaming import processors as K
from millrace.streaming import triggers as G
from millrace.streaming import window_process as P


class _State:
    def __init__(self, calls):
        self.calls, self.value = calls, None

    def __getattr__(self, name):
        def call(*args):
            self.calls[name] += 1
            if name in ("update", "put"):
                self.value = args[0]
            elif name == "clear":
                self.value = None
            return self.value if name != "exists" else self.value is not None

        return call


class _List(_State):
    def get(self):
        self.calls["get"] += 1
        return iter(self.value or [])


class _Handle:
    """Keeps the state of one key, its timers, and counts every call."""

    def __init__(self):
        self.calls, self.timers = Counter(), set()

    def getValueState(self, *_):
        return _State(self.calls)

    def getListState(self, *_):
        return _List(self.calls)

    def registerTimer(self, at):
        self.calls["timer"] += 1
        self.timers.add(at)

    def deleteTimer(self, at):
        self.calls["timer"] += 1
        self.timers.remove(at)


class _Clock:
    def __init__(self, ms):
        self.ms = ms

    def getCurrentWatermarkInMs(self):
        return self.ms

    getCurrentProcessingTimeInMs = getExpiryTimeInMs = getCurrentWatermarkInMs


KEY = (7, False)


@pytest.mark.parametrize("kind,purge,want", [("event_time", False, 100), ("continuous", False, 600), ("continuous", True, 600)])
def test_triggers_pay_for_batches_not_panes(kind, purge, want):
    handle, trigger = _Handle(), G.PaneTrigger(kind, 6000, 1000, purge)
    trigger.init(handle)
    rows = [Row("user_id", "__no_key", "pane", "n", "cents")(*KEY, p * 1000, 1, 5) for p in range(600)]
    assert not list(trigger.handleInputRows(KEY, iter(rows), _Clock(0)))
    assert len(handle.timers) == 1 and handle.timers == {6000 if kind == "event_time" else 1000}
    got = list(trigger.handleExpiredTimer(KEY, _Clock(10**6), _Clock(min(handle.timers))))
    assert len(got) == want and trigger.open.value is None
    assert sum(r.n for r in got) == {(False, 100): 600, (False, 600): 2100, (True, 600): 600}[purge, want]
    assert sum(handle.calls.values()) <= 8


def test_windows_pay_for_batches_not_windows():
    function, handle = P.TopAndTotal(), _Handle()
    state = P.WindowState(function, f"key BIGINT, no_key BOOLEAN, closes_ms BIGINT, {function.result_schema}", True)
    state.init(handle)
    row = Row("key", "no_key", "closes_ms", "acc")
    accs = [(c, function.add(function.create(), c, i, 1.0, 100)) for c in range(1000, 301000, 1000) for i in (4, None, 2)]
    list(state.handleInputRows(KEY, (row(*KEY, c, P.pickle.dumps(a)) for c, a in accs), _Clock(0)))
    got = list(state.handleExpiredTimer(KEY, _Clock(200_000), _Clock(1000)))
    assert [tuple(r) for r in got] == [(*KEY, c, 3, 300, 2, 2) for c in range(1000, 201000, 1000)]
    assert len(state.open.value[0]) == 100 and sum(handle.calls.values()) <= 8


def test_machine_windows_pay_for_batches_not_windows():
    handle, windows = _Handle(), T.MachineWindows(4000, 100, 1500)
    windows.init(handle)
    rows = [Row("user_id", "__no_key", "n", "cents")(*KEY, 2, 30)]
    assert [r.kind for r in windows.handleInputRows(KEY, iter(rows), _Clock(10_050))] == ["arrival"]
    assert len(handle.timers) == 1
    got = list(windows.handleExpiredTimer(KEY, _Clock(20_000), _Clock(10_100)))
    assert Counter(r.kind for r in got) == {"sliding": 40, "tumbling": 1, "session": 1}
    assert {(r.n, r.cents) for r in got} == {(2, 30)} and sum(handle.calls.values()) <= 6


@pytest.mark.parametrize("processor,calls", [
    (K.RunningSum(), 2), (K.CountedSum(), 2), (K.EventTimeTtlSum(10), 2), (K.CountTrigger(5, True), 2), (K.Previous(), 2),
    (K.Silence(10**9), 3), (K.StrictSequence(["a", "b", "c"], 10**9), 2),
])
def test_rows_cost_no_state_calls(processor, calls):
    handle = _Handle()
    processor.init(handle)
    values = {"cents": 3, "event_type": "a"}
    rows = [Row("user_id", "__no_key", *processor.reads)(*KEY, i, i, *(values[c] for c in processor.reads[2:])) for i in range(500)]
    list(processor.handleInputRows(KEY, iter(rows), _Clock(0)))
    assert sum(handle.calls.values()) <= calls
