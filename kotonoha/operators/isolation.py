"""A function in a process of its own, with a time limit for every call.

A tokenizer that hangs or kills its process would take the worker and all its
documents along. Here it runs in a child; a call that gives no result in time,
or whose child dies, is an error of that call alone, and the next call starts a
new child. The child builds the function once, outside the limit.
"""

from __future__ import annotations

import os
import pickle
import select
import struct
import subprocess
import sys
import time
import traceback
from collections.abc import Callable
from typing import Any

from pyspark import cloudpickle

_LENGTH = struct.Struct("<q")


class Isolated:
    """Calls ``factory()`` 's function in a child process."""

    def __init__(self, factory: Callable[[], Callable], time_limit: float):
        self._made = cloudpickle.dumps(factory)
        self._limit = time_limit
        self._child: subprocess.Popen | None = None

    def _start(self) -> None:
        env = os.environ | {"PYTHONPATH": os.pathsep.join(p for p in sys.path if p)}
        self._child = subprocess.Popen(
            [sys.executable, "-c", "from kotonoha.operators.isolation import serve; serve()"], stdin=subprocess.PIPE, stdout=subprocess.PIPE, env=env
        )
        self._send(self._made)
        ready, problem = self._receive(None)
        if not ready:
            self.close()
            raise RuntimeError(problem)

    def _send(self, held: bytes) -> None:
        self._child.stdin.write(_LENGTH.pack(len(held)) + held)
        self._child.stdin.flush()

    def _read(self, size: int, until: float | None) -> bytes:
        found, source = bytearray(), self._child.stdout.fileno()
        while len(found) < size:
            left = None if until is None else max(0.0, until - time.monotonic())
            if not select.select([source], [], [], left)[0]:
                raise TimeoutError(f"no result within {self._limit} seconds")
            part = os.read(source, min(size - len(found), 1 << 20))
            if not part:
                raise RuntimeError(f"the process ended with code {self._child.wait()}")
            found += part
        return bytes(found)

    def _receive(self, limit: float | None) -> Any:
        until = None if limit is None else time.monotonic() + limit
        (size,) = _LENGTH.unpack(self._read(_LENGTH.size, until))
        return pickle.loads(self._read(size, until))

    def __call__(self, value: Any) -> Any:
        if self._child is None:
            self._start()
        try:
            self._send(pickle.dumps(value))
            good, result = self._receive(self._limit)
        except (TimeoutError, RuntimeError, OSError):
            self.close()
            raise
        if not good:
            raise RuntimeError(result)
        return result

    def close(self) -> None:
        if self._child is not None:
            self._child.kill()
            self._child.wait()
            self._child.stdin.close()
            self._child.stdout.close()
            self._child = None


def serve() -> None:
    """The child: a function, then value after value until the parent goes."""
    out = os.fdopen(os.dup(1), "wb")
    os.dup2(2, 1)  # what the function prints is no answer
    source = sys.stdin.buffer

    def answer(good: bool, result: Any) -> None:
        held = pickle.dumps((good, result))
        out.write(_LENGTH.pack(len(held)) + held)
        out.flush()

    def values():
        while len(head := source.read(_LENGTH.size)) == _LENGTH.size:
            yield pickle.loads(source.read(_LENGTH.unpack(head)[0]))

    given = values()
    try:
        function = next(given)()
    except Exception:
        answer(False, traceback.format_exc())
        return
    answer(True, None)
    for value in given:
        try:
            result = function(value)
            pickle.dumps(result)
        except Exception:
            answer(False, traceback.format_exc())
        else:
            answer(True, result)
