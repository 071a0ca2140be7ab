"""External engines: where their program is, what its build can do, its command, and a table of commands run by executors."""

from __future__ import annotations

import os
import shutil
import signal
import subprocess
import tempfile
from collections.abc import Iterator, Mapping, Sequence
from dataclasses import dataclass
from pathlib import Path

import pyarrow as pa
from pyspark.sql import DataFrame

from trivet.errors import ReconstructionBinaryNotFoundError
from trivet.operators.recon import FATAL


@dataclass(frozen=True)
class Engine:
    """A program by name, the file names it may have, and the folders of an installation to look in."""

    name: str
    program: str
    files: tuple[str, ...]
    folders: tuple[str, ...] = (".",)
    #: The path to use where none is given to `find`: a file, an installation folder, or a name on the PATH.
    path: str | None = None

    def find(self, path: str | os.PathLike | None = None) -> Path | None:
        """The program: the path itself if a file, else in its folders if a folder, else by name on the PATH."""
        given = os.fspath(path) if path else self.path or self.program
        at = Path(given).expanduser()
        if at.is_file():
            return at.resolve()
        inside = (at / d / f for d in self.folders for f in self.files) if at.is_dir() else ()
        if found := next((p for p in inside if p.is_file()), None):
            return found.resolve()
        found = shutil.which(given)
        return Path(found).resolve() if found else None

    def require(self, path: str | os.PathLike | None = None) -> Path:
        if found := self.find(path):
            return found
        raise ReconstructionBinaryNotFoundError(f"no program of engine {self.name} at {path or self.path or 'the PATH'}")

    def command(self, source: str, target: str, cache: str | None = None, args: Sequence[str] = (), params: Mapping[str, object] | None = None, path: str | None = None) -> list[str]:
        """The whole command: folders of input, output and cache, then arguments as given, then parameters as options."""
        options = [x for k, v in (params or {}).items() for x in (k if k.startswith("-") else f"--{k}", str(v))]
        folders = {"--input": source, "--output": target} | ({"--cache": cache} if cache is not None else {})
        return [str(self.require(path)), *(x for kv in folders.items() for x in kv), *args, *options]


# The engines by name, their programs, and where installations keep them.
ENGINES = {
    "meshroom": Engine("meshroom", "meshroom_batch", ("meshroom_batch.exe", "meshroom_batch")),
    "colmap": Engine("colmap", "colmap", ("colmap.exe", "colmap", "colmap.bat", "colmap.cmd"), (".", "bin")),
}


def get_engine(name: str = "meshroom", path: str | None = None) -> Engine:
    """An engine by its name in any case; an unknown name is an error."""
    if not (found := ENGINES.get(name.lower())):
        raise ValueError(f"unknown engine {name}; known are {', '.join(ENGINES)}")
    return Engine(found.name, found.program, found.files, found.folders, str(path)) if path else found


def has_gpu(program: str | os.PathLike, seconds: float = 5.0) -> bool:
    """Whether the build has a GPU, by what it says on `version`, or on `help` if that says nothing; no answer is no."""
    try:
        asked = (subprocess.run([os.fspath(program), word], capture_output=True, text=True, timeout=seconds, check=False) for word in ("version", "help"))
        said = next((t for r in asked if (t := r.stdout + r.stderr)), "").lower()
    except (OSError, UnicodeError, subprocess.SubprocessError):
        return False
    return "without gpu support" not in said and "without cuda" not in said


RUN = "job_id string, status string, exit_code int, seconds double, n_lines long, tail string"


def _run(command: list[str], seconds: float | None, most: int) -> tuple:
    """Status, exit code, seconds, lines and the last lines of one command; it is killed with its children when late."""
    import time
    from collections import deque

    began = time.monotonic()
    # The log goes to a file of the task, not to memory; only its end leaves.
    with tempfile.TemporaryFile("w+b") as log:
        try:
            p = subprocess.Popen(command, stdin=subprocess.DEVNULL, stdout=log, stderr=subprocess.STDOUT, start_new_session=True)
        except OSError as e:
            return "not_found", None, 0.0, 1, str(e)
        try:
            status = "ok" if p.wait(seconds) == 0 else "failed"
        except subprocess.TimeoutExpired:
            os.killpg(p.pid, signal.SIGKILL)
            p.wait()
            status = "timeout"
        log.seek(0)
        n, end = 0, deque(maxlen=most)
        for raw in log:
            line = raw.decode("utf-8", "replace").rstrip("\r\n")
            n += 1
            end.append(line)
            if status == "ok" and any(t in line.lower() for t in FATAL):
                status = "failed"
    return status, p.returncode, time.monotonic() - began, n, "\n".join(end)


def run_commands(jobs: DataFrame, most: int = 20) -> DataFrame:
    """Runs a command a row (job_id, command array<string>, timeout_seconds) on the executors, one at a time in a task.

    Returns job_id, status (`ok`, `failed`, `timeout`, `not_found`), exit_code, seconds, n_lines of the
    log and its last `most` lines. A program that ends well but printed a fatal line has failed. A
    null timeout waits; a null or empty command is `not_found`. A task that is lost or repeated runs
    its commands again, so each should write to a folder of its own. An empty table gives none.
    """

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for job, command, seconds in zip(*(c.to_pylist() for c in b.columns), strict=True):
                row = (job, *(_run(command, seconds, most) if command and None not in command else ("not_found", None, 0.0, 0, "")))
                kinds = (pa.string(), pa.string(), pa.int32(), pa.float64(), pa.int64(), pa.string())
                names = [c.split()[0] for c in RUN.split(", ")]
                yield pa.RecordBatch.from_arrays([pa.array([x], t) for x, t in zip(row, kinds, strict=True)], names=names)

    return jobs.selectExpr("cast(job_id as string) job_id", "cast(command as array<string>) command", "cast(timeout_seconds as double) timeout_seconds").mapInArrow(work, RUN)
