"""Models outside the worker's own process: commands, and Python functions under a time limit.

Each runs as the leader of a process group of its own, which is ended as a whole,
so that what a model has started ends with it.
"""

from __future__ import annotations

import csv
import math
import os
import select
import signal
import subprocess
import sys
import tempfile
import time
from collections.abc import Callable, Iterator
from contextlib import closing, contextmanager
from dataclasses import dataclass, replace
from multiprocessing.connection import Connection
from pathlib import Path
from socket import socketpair

import pandas as pd
from pyspark import cloudpickle

from chunklake.operators.columns import INPUT_COLUMNS

#: A model takes a chunk's values and returns a frame of as many rows.
Model = Callable[[list[str]], pd.DataFrame]
#: Runs a model once: the results, or why there are none.
Trial = Callable[[list[str]], tuple[pd.DataFrame | None, str]]

#: Seconds that a process may take until it has loaded its model.
LOADING = 120
LONGEST_FIELD, LONGEST_MESSAGE = 10485760, 300


class ModelFailure(Exception):
    """Why a model gave no result, as a report shows it."""


def one_line(text: str) -> str:
    return text.strip().replace("\n", " | ")[:LONGEST_MESSAGE]


def told(e: Exception) -> str:
    return one_line(str(e)) or type(e).__name__


def _exited(pid: int, seconds: float | None) -> bool:
    """Whether a child has ended within ``seconds``, told as soon as it has.  It stays known to the system, so that
    its number, which is its group's, can't be another process's yet."""
    line = os.pidfd_open(pid)
    try:
        ended = select.poll()
        ended.register(line, select.POLLIN)
        return bool(ended.poll(None if seconds is None else math.ceil(seconds * 1000)))
    finally:
        os.close(line)


def _end(process: subprocess.Popen) -> int:
    """End all that is left of a process's group, and say how the process ended."""
    if process.returncode is None:
        try:
            os.killpg(process.pid, signal.SIGKILL)
        except ProcessLookupError:
            pass
    return process.wait()


@contextmanager
def _scratch() -> Iterator[str]:
    """A folder by its real name, which a command that works in it knows too: TMPDIR may be told from where a process works."""
    with tempfile.TemporaryDirectory(prefix="attempt-", dir=os.path.realpath(tempfile.gettempdir()), ignore_cleanup_errors=True) as folder:
        yield folder


@dataclass(frozen=True)
class Command:
    """A model that is a command: it reads a CSV file with the one column ``column`` and writes one.

    ``argv`` may hold {input}, {output} and {python}.  It has succeeded if it exits with 0 and has
    written the file within ``seconds``; otherwise the reason is ``EXIT n: `` and what it
    wrote to standard error, or ``TIMEOUT after n s``.  What it wrote before it failed does not count.
    Each run has a folder of its own that goes with it.  Columns of the output that repeat the input are left out.

    One that ``stays`` is told of its runs while it goes on, see :class:`Staying`.
    """

    argv: tuple[str, ...]
    column: str = "smiles"
    seconds: float | None = None
    inputs: tuple[str, ...] = INPUT_COLUMNS
    stays: bool = False

    def __call__(self, values: list[str]) -> pd.DataFrame:
        if self.stays:
            with closing(Staying(self)) as run:
                return run(values)
        with _scratch() as folder:
            source, target, said = (Path(folder, n) for n in ("input.csv", "output.csv", "stderr.txt"))
            self.give(source, values)
            names = {"{input}": str(source), "{output}": str(target), "{python}": sys.executable}
            with said.open("wb") as errors:
                process = subprocess.Popen([names.get(a, a) for a in self.argv], cwd=folder, stdin=subprocess.DEVNULL, stdout=subprocess.DEVNULL, stderr=errors, start_new_session=True)
            try:
                ended = _exited(process.pid, self.seconds)
            finally:
                code = _end(process)
            if not ended:
                raise ModelFailure(f"TIMEOUT after {self.seconds:g} s")
            if code:
                raise ModelFailure(f"EXIT {code}: {one_line(said.read_text('utf-8', 'replace'))}")
            if not target.exists():
                raise ModelFailure("EXIT 0: no output")
            return self.take(target)

    def give(self, source: Path, values: list[str]) -> None:
        with source.open("w", newline="", encoding="utf-8", errors="replace") as f:
            csv.writer(f).writerows([[self.column], *([v] for v in values)])

    def take(self, target: Path) -> pd.DataFrame:
        csv.field_size_limit(LONGEST_FIELD)
        with target.open(newline="", encoding="utf-8-sig", errors="replace") as f:
            rows = [r for r in csv.reader(f) if r]
        header, known = rows[0] if rows else [], {self.column.lower(), *self.inputs}
        places = {n: i for i, n in enumerate(header) if n.strip().lower() not in known}
        return pd.DataFrame({n: [r[i] if i < len(r) else "" for r in rows[1:]] for n, i in places.items()}, index=range(len(rows) - 1 if rows else 0))


class Staying:
    """A command that is started once for many runs, as one that takes long to start may ask for, and anew once it has ended.

    For each run it reads a line from its standard input, the names of input and output with a tab between them, and
    when the output is whole it writes the output's name as a line to its standard output, where other lines are
    ignored.  A run fails if the command ends instead, with a code as any command; one that gives each run a process of
    its own tells that process's code after the name and a tab, and goes on.  What has been written to standard error since the run
    began is the reason.  The command reads on until its input ends, and carries nothing from one run to the next.
    """

    def __init__(self, command: Command):
        self.command, self.runs = command, 0
        self.process: subprocess.Popen | None = None

    def _start(self) -> None:
        self.scratch = _scratch()
        self.folder = Path(self.scratch.__enter__())
        try:
            # Appended to, so that it can be emptied between runs.
            with (self.folder / "stderr.txt").open("ab") as errors:
                argv = [sys.executable if a == "{python}" else a for a in self.command.argv]
                self.process = subprocess.Popen(argv, cwd=self.folder, stdin=subprocess.PIPE, stdout=subprocess.PIPE, stderr=errors, bufsize=0, start_new_session=True)
        except OSError:
            self.scratch.__exit__(None, None, None)
            raise
        self.life, self.rest = os.pidfd_open(self.process.pid), b""
        self.signs = select.poll()
        for line in (self.life, self.process.stdout.fileno()):
            self.signs.register(line, select.POLLIN)

    def _answer(self, source: Path, target: Path) -> int | None:
        """The code with which a run has ended; None if the command has ended itself."""
        try:
            self.process.stdin.write(f"{source}\t{target}\n".encode())
        except BrokenPipeError:
            pass
        out, seconds, wanted = self.process.stdout.fileno(), self.command.seconds, str(target).encode()
        until = None if seconds is None else time.monotonic() + seconds
        while True:
            left = None if until is None else until - time.monotonic()
            if left is not None and left <= 0:
                raise ModelFailure(f"TIMEOUT after {seconds:g} s")
            ready = {line for line, _ in self.signs.poll(None if left is None else math.ceil(left * 1000))}
            if out in ready:
                new = os.read(out, 1 << 16)
                if not new:  # no answer can come any more; its end may still be to come
                    self.signs.unregister(out)
                    self.process.stdin.close()
                *lines, self.rest = (self.rest + new).split(b"\n")
                for name, _, code in (line.partition(b"\t") for line in lines):
                    if name == wanted:
                        return int(code or 0)
            elif self.life in ready:
                return None

    def __call__(self, values: list[str]) -> pd.DataFrame:
        if self.process is not None and _exited(self.process.pid, 0):
            self.close()
        if self.process is None:
            self._start()
        self.runs, goes_on = self.runs + 1, False
        source, target, said = (self.folder / n for n in (f"input{self.runs}.csv", f"output{self.runs}.csv", "stderr.txt"))
        try:
            self.command.give(source, values)
            os.truncate(said, 0)
            code = self._answer(source, target)
            goes_on = code is not None
            if not goes_on and not (code := _end(self.process)):
                raise ModelFailure("EXIT 0: no answer")
            if code:
                raise ModelFailure(f"EXIT {code}: {one_line(said.read_text('utf-8', 'replace'))}")
            if not target.exists():
                raise ModelFailure("EXIT 0: no output")
            return self.command.take(target)
        finally:
            if goes_on:
                for used in (source, target):
                    used.unlink(missing_ok=True)
            else:
                self.close()

    def close(self) -> None:
        process, self.process = self.process, None
        if process is not None:
            _end(process)
            os.close(self.life)
            process.stdin.close()
            process.stdout.close()
            self.scratch.__exit__(None, None, None)


class Limited:
    """A Python model in a process of its own, started anew once a run has been ended."""

    def __init__(self, model: Model, seconds: float):
        self.model, self.seconds = cloudpickle.dumps(model), seconds
        self.process: subprocess.Popen | None = None

    def _start(self) -> None:
        ours, theirs = socketpair()
        path = os.pathsep.join([p for p in sys.path if p])
        with theirs:
            argv = [sys.executable, "-c", "import sys; from chunklake.operators.runners import serve; serve(int(sys.argv[1]))", str(theirs.fileno())]
            self.process = subprocess.Popen(argv, env=os.environ | {"PYTHONPATH": path}, stdin=subprocess.DEVNULL, pass_fds=[theirs.fileno()], start_new_session=True)
        self.line = Connection(ours.detach())
        self.line.send_bytes(self.model)
        if not self.line.poll(LOADING):
            raise ModelFailure(f"not loaded after {LOADING} s")
        self.line.recv()

    def __call__(self, values: list[str]) -> pd.DataFrame:
        try:
            if self.process is None:
                self._start()
            self.line.send(values)
            if not self.line.poll(self.seconds):
                raise ModelFailure(f"TIMEOUT after {self.seconds:g} s")
            out, why = self.line.recv()
        except (EOFError, ConnectionError):
            code = self.close()
            raise ModelFailure(f"EXIT {code}: the model ended without a result") from None
        except ModelFailure:
            self.close()
            raise
        if out is None:
            raise ModelFailure(why)
        return out

    def close(self) -> int:
        process, self.process = self.process, None
        if process is None:
            return 0
        self.line.close()
        _exited(process.pid, 0.2)  # one that has ended by itself keeps its own code
        return _end(process)


def serve(fd: int) -> None:
    """What the process of :class:`Limited` does."""
    line = Connection(fd)
    try:
        model = cloudpickle.loads(line.recv_bytes())
        line.send(True)
        while True:
            values = line.recv()
            try:
                answer = model(values), ""
            except Exception as e:
                answer = None, told(e)
            line.send(answer)
    except (EOFError, ConnectionError):
        pass


@contextmanager
def trials(model: Model, seconds: float | None = None) -> Iterator[Trial]:
    """A function that runs ``model`` once.  Success is as many rows out as in, within ``seconds``;
    otherwise it tells the exception, the exit code, the time limit or the numbers of rows.

    A Python model under a time limit has one process for all runs that end by themselves, and so has a command that stays.
    """
    kept = None
    if isinstance(model, Command):
        model = model if seconds is None else replace(model, seconds=seconds)
        if model.stays:
            model = kept = Staying(model)
    elif seconds is not None:
        model = kept = Limited(model, seconds)

    def trial(values: list[str]) -> tuple[pd.DataFrame | None, str]:
        try:
            out = model(values)
        except Exception as e:
            return None, told(e)
        if len(out) != len(values):
            return None, f"{len(values)} rows in, {len(out)} out"
        return out.reset_index(drop=True), ""

    try:
        yield trial
    finally:
        if kept:
            kept.close()
