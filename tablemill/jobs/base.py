"""Job interface and result (UDF-1, DM-13)."""

from __future__ import annotations

import logging
from abc import ABC, abstractmethod
from dataclasses import dataclass
from datetime import datetime, timezone
from typing import Any

from pyspark.sql import SparkSession


@dataclass
class JobResult:
    success: bool
    message: str = ""
    rows_affected: int = 0
    started_at: datetime | None = None
    finished_at: datetime | None = None

    def to_dict(self) -> dict[str, Any]:
        return {k: v.isoformat() if isinstance(v, datetime) else v for k, v in vars(self).items()}


class Job(ABC):
    name = ""
    scope = "none"
    default_args: dict[str, Any] = {}

    def __init__(self, spark: SparkSession):
        self.spark = spark

    @abstractmethod
    def run(self, **kwargs) -> JobResult: ...

    def execute(self, **kwargs) -> JobResult:
        """Runs with times; an exception becomes a failure."""
        began = datetime.now(timezone.utc)
        try:
            out = self.run(**{**self.default_args, **kwargs})
        except Exception as e:  # noqa: BLE001
            logging.getLogger(__name__).exception("job %s", self.name)
            out = JobResult(False, str(e))
        out.started_at, out.finished_at = began, datetime.now(timezone.utc)
        return out


def roll_up(results: dict[str, int | Exception]) -> JobResult:
    """AGG-14 to AGG-16: rows of the tables that went well; one that fails does not stop the others."""
    failed = {t: e for t, e in results.items() if isinstance(e, Exception)}
    rows = sum(n for n in results.values() if not isinstance(n, Exception))
    text = f"{len(results) - len(failed)} of {len(results)} tables, {rows} rows" + "".join(f"; {t}: {e}" for t, e in failed.items())
    return JobResult(not failed, text, rows)
