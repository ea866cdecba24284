"""Jobs: a registry filled by importing every module of this folder (UDF-1, UDF-2)."""

from __future__ import annotations

import importlib
import logging
import pkgutil

from tablemill.jobs.base import Job, JobResult

__all__ = ["Job", "JobResult", "registry"]


def registry() -> dict[str, type[Job]]:
    """Jobs by name. A module that does not import is logged and left out, so that one plug-in cannot stop the others."""
    out: dict[str, type[Job]] = {}
    for m in pkgutil.iter_modules(__path__):
        try:
            module = importlib.import_module(f"{__name__}.{m.name}")
        except Exception as e:  # noqa: BLE001
            logging.getLogger(__name__).warning("job module %s: %s", m.name, e)
            continue
        for x in vars(module).values():
            if isinstance(x, type) and issubclass(x, Job) and x.name:
                out[x.name] = x
    return out
