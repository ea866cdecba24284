"""Schedules, events, dependent jobs, retries and the call on a final failure (STR-7 to STR-9, SNK-21, FLT-18)."""

from __future__ import annotations

import json
import logging
import time
import uuid
from collections.abc import Callable
from datetime import datetime, timedelta

from tablemill.functions.text import ERROR_CHARS
from tablemill.jobs.base import Job, JobResult
from tablemill.sources.http import urllib_transport

#: Least and greatest value of a schedule's fields: minute, hour, day, month, day of the week (0 and 7 are Sunday).
FIELDS = ((0, 59), (0, 23), (1, 31), (1, 12), (0, 7))


def allowed(part: str, least: int, most: int) -> set[int]:
    """A field's values: numbers, ranges, steps and lists."""
    out: set[int] = set()
    for piece in part.split(","):
        span, _, step = piece.partition("/")
        low, dash, high = span.partition("-")
        first = least if low == "*" else int(low)
        last = most if low == "*" or (step and not dash) else int(high) if dash else first
        if not (least <= first <= last <= most) or (step and int(step) < 1):
            raise ValueError(f"{piece!r} is not within {least} to {most}")
        out |= set(range(first, last + 1, int(step or 1)))
    return out


def next_run(schedule: str, after: datetime) -> datetime:
    """STR-8: the first minute after `after` that a five-field schedule names. If both day fields are given, either does."""
    parts = schedule.split()
    if len(parts) != 5:
        raise ValueError(f"{schedule!r} has {len(parts)} fields, not 5")
    minutes, hours, days, months, weekdays = (allowed(p, *f) for p, f in zip(parts, FIELDS))
    weekdays = {d % 7 for d in weekdays}
    any_day, any_weekday = parts[2].startswith("*"), parts[4].startswith("*")
    at = (after + timedelta(minutes=1)).replace(second=0, microsecond=0)
    for _ in range(366 * 8 + 1):  # a 29 February is at most eight years away
        by_day, by_weekday = at.day in days, at.isoweekday() % 7 in weekdays
        right = by_day and by_weekday if any_day or any_weekday else by_day or by_weekday
        if at.month in months and right:
            for h in sorted(x for x in hours if x >= at.hour):
                for m in sorted(minutes):
                    if h > at.hour or m >= at.minute:
                        return at.replace(hour=h, minute=m)
        at = at.replace(hour=0, minute=0) + timedelta(days=1)
    raise ValueError(f"{schedule!r} names no day")


class Runner:
    """Runs jobs in the driver; their work is Spark's. A listener takes (event, details): job_start, job_complete."""

    def __init__(self, jobs: dict[str, Job], *, depends_on: dict[str, str] | None = None, retries: int = 0, webhook: str | None = None, base: float = 5.0, most: float = 60.0, sleep: Callable[[float], None] = time.sleep, transport: Callable = urllib_transport):
        self.jobs, self.depends_on, self.retries, self.webhook = jobs, depends_on or {}, retries, webhook
        self.base, self.most, self.sleep, self.transport = base, most, sleep, transport
        self.listeners: list[Callable[[str, dict], None]] = []
        self.running: set[tuple[str, str]] = set()

    def tell(self, event: str, **details) -> None:
        """A listener that fails stops neither the job nor the other listeners."""
        for listener in self.listeners:
            try:
                listener(event, details)
            except Exception:  # noqa: BLE001
                logging.getLogger(__name__).exception("listener of %s", event)

    def run(self, name: str, _above: tuple[str, ...] = (), **args) -> JobResult:
        """One job with its retries, then the jobs that depend on it if it went well. A job that runs with the same
        arguments is not started again; a circle of dependent jobs ends where it closes."""
        mark = (name, json.dumps(args, sort_keys=True, default=str))
        if mark in self.running:
            return JobResult(False, f"{name} is running with these arguments")
        self.running.add(mark)
        try:
            for tried in range(self.retries + 1):
                run_id = uuid.uuid4().hex
                self.tell("job_start", run_id=run_id, job=name, args=args, tried=tried)
                out = self.jobs[name].execute(**args)
                self.tell("job_complete", run_id=run_id, job=name, success=out.success, tried=tried)
                if out.success or tried == self.retries:
                    break
                self.sleep(min(self.base * 2**tried, self.most))
        finally:
            self.running.discard(mark)
        if not out.success and self.webhook:
            self._call(name, run_id, out)
        if out.success:
            for other in [j for j, on in self.depends_on.items() if on == name and j not in (*_above, name)]:
                self.run(other, (*_above, name))
        return out

    def _call(self, name: str, run_id: str, out: JobResult) -> None:
        """SNK-21: only the last failure is told; a call that fails is logged."""
        told = {"event": "job_failed", "job": name, "run_id": run_id, "error": out.message[:ERROR_CHARS], "finished_at": out.finished_at, "retries": self.retries}
        try:
            self.transport("POST", self.webhook, json.dumps(told, default=str), {}, 10)
        except Exception:  # noqa: BLE001
            logging.getLogger(__name__).exception("webhook of %s", name)

    def serve(self, name: str, schedule: str, *, now: Callable[[], datetime] = datetime.now, times: int | None = None, **args) -> None:
        """STR-8: waits for each time of the schedule and runs the job, without end or `times` times. A time that passes
        while the job still runs is left out."""
        while times is None or times > 0:
            self.sleep(max((next_run(schedule, now()) - now()).total_seconds(), 0))
            self.run(name, **args)
            times = None if times is None else times - 1
