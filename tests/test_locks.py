import random

import numpy as np
import pandas as pd

from orderflow.streaming.arrivals import Locks

TTL = 100


class Map:
    """A state map that counts what is asked of it."""

    def __init__(self):
        self.rows, self.calls = {}, 0

    def getValue(self, key):
        self.calls += 1
        return self.rows.get(key)

    def updateValue(self, key, value):
        self.calls += 1
        self.rows[key] = value

    def removeKey(self, key):
        del self.rows[key]

    def iterator(self):
        return iter(self.rows.items())


class Handle:
    def __init__(self):
        self.map, self.timers = Map(), set()

    def getMapState(self, name, key, value):
        return self.map

    def listTimers(self):
        return iter(self.timers)

    def registerTimer(self, at):
        self.timers.add(at)

    def deleteTimer(self, at):
        self.timers.discard(at)

    def locks(self):
        return {k: s for (k,), (s,) in self.map.rows.items()}


class Times:
    def __init__(self, watermark):
        self.watermark = watermark

    def getCurrentWatermarkInMs(self):
        return self.watermark

    def getExpiryTimeInMs(self):
        return self.watermark


def started():
    locks, handle = Locks(TTL, ["_micros"]), Handle()
    locks.init(handle)
    return locks, handle


def routed(locks, rows, pieces=1):
    """Accepted (key, second, number) of rows that come in pieces."""
    rng = random.Random(len(rows))
    rows = rng.sample(rows, len(rows))
    frames = [pd.DataFrame([(7, k, s, s * 10**6 + n, [k, str(s), str(n)]) for k, s, n in rows[i::pieces]], columns=list("abcde")) for i in range(pieces)]
    out = pd.concat(list(locks.handleInputRows((7,), iter(frames), Times(0))))
    assert len(out) == len(rows)
    return {(r[0], int(r[1]), int(r[2])) for r, taken in zip(out["_row"], out["_taken"]) if taken}


def by_hand(rows, last):
    taken = set()
    for k, s, n in sorted(rows):
        if k not in last or s >= last[k] + TTL:
            taken.add((k, s, n))
            last[k] = s
    return taken


def test_many_keys_are_one_call():
    rng = random.Random(1)
    locks, handle = started()
    last = {}
    for batch in range(4):
        rows = [(f"k{rng.randint(0, 500)}", rng.randint(-900, 900) + 300 * batch, n) for n in range(6000)]
        handle.map.calls = 0
        assert routed(locks, rows, 3) == by_hand(rows, last)
        assert handle.map.calls <= 2 * len({k for k, _, _ in rows}) and len(handle.timers) == 1
        assert handle.locks() == last and min(handle.timers) <= (min(last.values()) + TTL) * 1000


def test_timer_forgets_ended_locks_only():
    locks, handle = started()
    routed(locks, [("a", 0, 0), ("b", 50, 1), ("c", 70, 2)])
    routed(locks, [("a", 400, 3)])
    at = handle.timers.pop()
    assert at == TTL * 1000
    list(locks.handleExpiredTimer((7,), Times(160_000), Times(at)))
    assert handle.locks() == {"a": 400, "c": 70} and handle.timers == {170_000}
    list(locks.handleExpiredTimer((7,), Times(900_000), Times(handle.timers.pop())))
    assert not handle.locks() and not handle.timers
    assert routed(locks, [("c", 71, 4)]) == {("c", 71, 4)}


def test_extreme_times():
    locks, _ = started()
    rows = [("a", -(2**37), 0), ("a", 2**37, 1), ("b", 2**37, 2), ("b", 2**37 + TTL - 1, 3), ("b", 2**37 + TTL, 4)]
    assert routed(locks, rows) == by_hand(rows, {})
    assert np.array_equal(sorted(routed(locks, rows)), [])
