"""Endpoints for tests of the delivery sink, importable by workers."""

import os
import threading
import time

_LOCK, _NOW, MOST = threading.Lock(), [0], [0]


def counting(records):
    with _LOCK:
        _NOW[0] += 1
        MOST[0] = max(MOST[0], _NOW[0])
    time.sleep(0.005)
    with _LOCK:
        _NOW[0] -= 1
    return [204] * len(records)


def good():
    return lambda records: [200] * len(records)


def flaky():
    tries = {}

    def send(records):
        out = []
        for r in records:
            n = tries[r["position"]] = tries.get(r["position"], 0) + 1
            out.append(503 if n <= r["position"] % 6 else 204)
        return out

    return send


def breaking():
    def send(records):
        if any(r["position"] == 77 for r in records):
            os._exit(1)  # the worker is gone, not only the call
        return [200] * len(records)

    return send
