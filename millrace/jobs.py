"""Runs started from a review screen: one at a time, their output kept as numbered lines."""

from __future__ import annotations

import subprocess
import threading
from collections.abc import Callable, Iterable
from urllib.parse import parse_qs

JOBS = ("crawl", "enrich")


class Job:
    """A single slot for a process. Lines are appended by a thread; a second start while one runs is refused."""

    def __init__(self):
        self.lock, self.process, self.lines = threading.Lock(), None, []

    def start(self, command: list[str]) -> bool:
        with self.lock:
            if self.running():
                return False
            self.lines = []
            self.process = subprocess.Popen(command, stdout=subprocess.PIPE, stderr=subprocess.STDOUT, text=True, errors="replace")
            self.pump = threading.Thread(target=self._read, args=(self.process, self.lines), daemon=True)
            self.pump.start()
            return True

    @staticmethod
    def _read(process: subprocess.Popen, lines: list[str]) -> None:
        for line in process.stdout:
            lines.append(line.rstrip("\n"))
        process.wait()

    def running(self) -> bool:
        return self.process is not None and self.process.poll() is None

    def snapshot(self, start: int = 0) -> dict:
        """Lines from a position on, whether it runs, and the exit code when it is over."""
        lines = self.lines[max(0, start) :]
        return {"lines": lines, "next": max(0, start) + len(lines), "running": self.running(), "returncode": None if self.process is None else self.process.poll()}


def offset(text: str | None) -> int:
    """A position from a request: 0 for anything but a number from 0 on."""
    return int(text) if text and text.isdecimal() else 0


def from_index(query: str) -> int | None:
    """The position that a request's query asks for: 0 if it names none, null (a bad request) if that is no whole number."""
    said = parse_qs(query, keep_blank_values=True).get("from", [""])[0]
    if not said:
        return 0
    try:
        return int(said)
    except ValueError:
        return None


def handle_run(job: str, university: str | None, slugs: Iterable[str], running: bool, start: Callable[[], bool], clear: Callable[[str], None]) -> tuple[int, str]:
    """Status and text for a request to run: 400 for an unknown job, a university with the naming run or one that the seed lacks; 409 if something runs."""
    if job not in JOBS:
        return 400, "unknown job"
    if university is not None and job == "enrich":
        return 400, "the naming run takes no university"
    if university is not None and university not in set(slugs):
        return 400, "not in the seed"
    if running:
        return 409, "running"
    if university is not None:
        clear(university)
    return (200, "started") if start() else (409, "running")
