"""Running canonical solutions: each call in a forked isolated process with limits on time and memory.

Only ingested code is run, never a model's answer. The limits stop runaways; they
are no defence against hostile code.
"""

from __future__ import annotations

import ast
import json
import os
import struct
import subprocess
import sys
import threading
from collections.abc import Iterator
from dataclasses import dataclass
from typing import Any

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, StringType, StructField, StructType

from ..functions.values import canonical, parse_kwargs, parse_value

TIMEOUT_S, MEMORY_MB = 5.0, 256
#: Names that solutions use without importing them.
_PREAMBLE = """
from typing import *
from collections import *
from functools import *
from itertools import *
from heapq import *
from bisect import *
from math import inf, gcd, sqrt, ceil, floor, log2, comb, isqrt
from random import randint, choice, shuffle
import bisect, collections, functools, heapq, itertools, math, random, re, string
"""
_MARK = "\x1eRESULT\x1e"
#: Runs the preamble once; then forks a process for each job it reads, waits for it and answers with what it printed.
_STARTER = """
import atexit as _atexit, gc as _gc, json as _json, os as _os, resource as _resource, select as _select, signal as _signal, struct as _struct, sys as _sys, threading as _threading, time as _time
_in, _back = _os.dup(0), _os.dup(1)
_null = _os.open(_os.devnull, _os.O_RDWR)
_os.dup2(_null, 0), _os.dup2(_null, 1)
_space = {"__name__": "solution"}
exec(compile(_os.environ.pop("SIEVEWRIGHT_PREAMBLE"), "preamble", "exec"), _space)

def _read(n):
    parts = []
    while n and (part := _os.read(_in, min(n, 1 << 20))):
        parts.append(part)
        n -= len(part)
    return b"".join(parts)

def _solve(job):
    try:
        exec(compile(job["code"], "solution", "exec"), _space)
        call = getattr(_space["Solution"](), job["name"]) if job["kind"] == "method" else _space[job["name"]]
        text = _json.dumps({"value": call(**job["args"])})
    except MemoryError:
        text = _json.dumps({"error": "MemoryError", "memory": True})
    except BaseException as e:
        text = _json.dumps({"error": f"{type(e).__name__}: {e}"})
    _sys.stdout.write("\\n" + job["mark"] + text)

def _child(job, out, err):
    code = 1
    try:
        _os.dup2(out, 1), _os.dup2(err, 2)
        _os.closerange(3, 64)
        _resource.setrlimit(_resource.RLIMIT_AS, (job["memory"], job["memory"]))
        _solve(job)
        _threading._shutdown(), _atexit._run_exitfuncs()
        _sys.stdout.flush(), _sys.stderr.flush()
        code = 0
    except BaseException as e:
        _os.write(2, f"{type(e).__name__}: {e}".encode("utf-8", "replace"))
    finally:
        _os._exit(code)

def _watched(job):
    (out, out_w), (err, err_w), end = _os.pipe(), _os.pipe(), _time.monotonic() + job["timeout"]
    pid = _os.fork()
    if not pid:
        _child(job, out_w, err_w)
    _os.close(out_w), _os.close(err_w)
    said, poll, late = {out: [], err: []}, _select.poll(), False
    poll.register(out), poll.register(err)
    open_ = 2
    while open_ and not late:
        late = not (ready := poll.poll(max(0, end - _time.monotonic()) * 1000))
        for fd, _ in ready:
            if part := _os.read(fd, 1 << 16):
                said[fd].append(part)
            else:
                poll.unregister(fd)
                open_ -= 1
        late = late or open_ > 0 and _time.monotonic() > end
    status = None
    while not late and status is None:  # a process may close its pipes and go on
        done, code = _os.waitpid(pid, _os.WNOHANG)
        status, late = (_os.waitstatus_to_exitcode(code), False) if done else (None, _time.monotonic() > end)
        done or _time.sleep(0.0002)
    if status is None:
        _os.kill(pid, _signal.SIGKILL)
        _os.waitpid(pid, 0)
    _os.close(out), _os.close(err)
    return {"status": status, "out": b"".join(said[out]).decode("utf-8", "replace"), "err": b"".join(said[err]).decode("utf-8", "replace")}

_gc.freeze()
while len(_head := _read(8)) == 8:
    _answer = _json.dumps(_watched(_json.loads(_read(_struct.unpack("<q", _head)[0])))).encode()
    _answer = _struct.pack("<q", len(_answer)) + _answer
    while _answer:
        _answer = _answer[_os.write(_back, _answer):]
"""


def entry_point(code: str | None) -> tuple[str, str, list[str]] | None:
    """(kind, name, parameters) of the first public method of ``Solution`` or public function, in source order."""
    try:
        body = ast.parse(code or "").body
    except (SyntaxError, ValueError, RecursionError, MemoryError):
        return None
    for node in body:
        inner = node.body if isinstance(node, ast.ClassDef) and node.name == "Solution" else [node]
        for f in inner:
            if isinstance(f, ast.FunctionDef) and not f.name.startswith("_"):
                names = [a.arg for a in f.args.args]
                return "function" if f is node else "method", f.name, names[1:] if names[:1] in (["self"], ["cls"]) else names
    return None


@dataclass
class Run:
    value: Any = None
    error: str | None = None
    timed_out: bool = False
    memory_exceeded: bool = False


class _Starter:
    """A Python process without anything of ours that has run the preamble, and forks itself for every call; it ends with this process."""

    def __init__(self):
        self.pid, self.lock = os.getpid(), threading.Lock()
        self.process = subprocess.Popen(
            [sys.executable, "-I", "-c", _STARTER], stdin=subprocess.PIPE, stdout=subprocess.PIPE, stderr=subprocess.DEVNULL, env=os.environ | {"SIEVEWRIGHT_PREAMBLE": _PREAMBLE}
        )

    def call(self, payload: bytes) -> dict | None:
        """What the call's process printed and its exit status, null if it ran out of time; null where this process is gone."""
        with self.lock:
            try:
                self.process.stdin.write(struct.pack("<q", len(payload)) + payload)
                self.process.stdin.flush()
                head = self.process.stdout.read(8)
                return json.loads(self.process.stdout.read(struct.unpack("<q", head)[0])) if len(head) == 8 else None
            except OSError:
                return None

    def end(self) -> None:
        self.process.kill()
        self.process.communicate()


_starter: _Starter | None = None


def _answer(payload: bytes) -> dict | None:
    """The starter's answer; a starter that a call has ended is replaced once."""
    global _starter
    for _ in range(2):
        if _starter is None or _starter.pid != os.getpid():
            _starter = _Starter()
        if (got := _starter.call(payload)) is not None:
            return got
        _starter.end()
        _starter = None
    return None


def run_code(code: str, entry: tuple, args: dict, timeout: float = TIMEOUT_S, memory_mb: int = MEMORY_MB) -> Run:
    """One call in a process of its own, forked from a :class:`_Starter`."""
    job = {"code": code, "kind": entry[0], "name": entry[1], "args": args, "mark": _MARK, "timeout": timeout, "memory": memory_mb << 20}
    try:
        payload = json.dumps(job).encode()
    except (TypeError, ValueError) as e:
        return Run(error=f"arguments aren't JSON: {e}")
    done = _answer(payload)
    if done is None:
        return Run(error="the call ended the process that started it")
    if done["status"] is None:
        return Run(error=f"timed out after {timeout}s", timed_out=True)
    _, mark, text = done["out"].rpartition(_MARK)
    if not mark:
        memory = "MemoryError" in done["err"] or done["status"] < 0
        return Run(error=(done["err"].strip().splitlines() or [f"exit code {done['status']}"])[-1], memory_exceeded=memory)
    out = json.loads(text)
    return Run(out.get("value"), out.get("error"), False, bool(out.get("memory")))


def run_example(code: str, entry: tuple, given: str | None, expected: str | None, **limits) -> tuple[bool, Run]:
    run = run_code(code, entry, parse_kwargs(given or ""), **limits)
    return run.error is None and canonical(run.value) == canonical(parse_value(expected or "")), run


def sandbox(records: DataFrame, timeout: float = TIMEOUT_S, memory_mb: int = MEMORY_MB) -> DataFrame:
    """``(id, outcome, entry_point, n_cases, n_passed, all_passed, errors)`` of records(id, code, languages, examples).

    Outcomes: ``unsupported_language`` without Python code, ``no_examples``,
    ``no_entry_point``, else ``ok``. Each case is a process of its own in the worker.
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for r in batch.to_pylist():
                out = {"id": r["id"], "outcome": "ok", "entry_point": None, "n_cases": 0, "n_passed": 0, "all_passed": False, "errors": []}
                entry = entry_point(r["code"])
                if not r["code"] or "python" not in [str(x).lower() for x in r["languages"] or []]:
                    out["outcome"] = "unsupported_language"
                elif not r["examples"]:
                    out["outcome"] = "no_examples"
                elif entry is None:
                    out["outcome"] = "no_entry_point"
                else:
                    cases = [run_example(r["code"], entry, e["input"], e["output"], timeout=timeout, memory_mb=memory_mb) for e in r["examples"]]
                    passed = sum(ok for ok, _ in cases)
                    out |= {"entry_point": entry[1], "n_cases": len(cases), "n_passed": passed, "all_passed": passed == len(cases), "errors": [c.error for _, c in cases if c.error]}
                rows.append(out)
            yield pa.RecordBatch.from_pylist(rows, _SANDBOX)

    return records.select("id", "code", "languages", "examples").mapInArrow(
        run, "id string, outcome string, entry_point string, n_cases int, n_passed int, all_passed boolean, errors array<string>"
    )


_SANDBOX = pa.schema([("id", pa.string()), ("outcome", pa.string()), ("entry_point", pa.string()), ("n_cases", pa.int32()), ("n_passed", pa.int32()), ("all_passed", pa.bool_()), ("errors", pa.list_(pa.string()))])


@F.pandas_udf(StructType([StructField("kind", StringType()), StructField("name", StringType()), StructField("params", ArrayType(StringType()))]))
def entry_points(code):
    """Entry point of each code, null fields where there is none."""
    import pandas as pd

    found = [entry_point(c) or (None, None, None) for c in code]
    return pd.DataFrame(found, columns=["kind", "name", "params"])
