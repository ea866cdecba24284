"""HTTP responses for rows, through a transport that the caller can exchange (SRC-14, SRC-15)."""

from __future__ import annotations

import json
import urllib.request
from collections.abc import Callable, Iterator
from concurrent.futures import ThreadPoolExecutor

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import types as T


def urllib_transport(method: str, url: str, body: str | None, headers: dict[str, str], timeout: float) -> str:
    request = urllib.request.Request(url, body.encode() if body else None, {"Content-Type": "application/json", **headers}, method=method)
    with urllib.request.urlopen(request, timeout=timeout) as r:
        return r.read().decode()


def fetch(df: DataFrame, *, method: str = "GET", url: str = "url", body: str | None = None, headers: dict[str, str] | None = None, timeout: float = 10, transport: Callable = urllib_transport, workers: int = 1, error: str | None = None) -> DataFrame:
    """df with the response's text; null where a request fails, so that the row is skipped and others go on. A request a
    row, `workers` of a task at a time; `error` names a column for what a failed request raised."""

    def ask(u, b) -> tuple[str | None, str | None]:
        try:
            return transport(method, u, b, headers or {}, timeout), None
        except Exception as e:  # noqa: BLE001
            return None, f"{type(e).__name__}: {e}"[:200]

    def run(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        with ThreadPoolExecutor(workers) as pool:
            for p in parts:
                got = list(pool.map(ask, p[url], p[body] if body else [None] * len(p)))
                more = {"response": [r for r, _ in got]} | ({error: [e for _, e in got]} if error else {})
                yield p.assign(**{k: pd.Series(v, index=p.index, dtype=object) for k, v in more.items()})

    return df.mapInPandas(run, T.StructType([*df.schema.fields, *(T.StructField(n, T.StringType()) for n in ["response", *([error] if error else [])])]))


def fetch_batches(df: DataFrame, *, url: str, key: str, batch_key: str, array: str | None = None, id_field: str | None = None, method: str = "POST", headers: dict[str, str] | None = None, timeout: float = 10, size: int = 500, transport: Callable = urllib_transport) -> DataFrame:
    """A request for up to `size` rows; items are matched by id, the last one of an id, or by position."""

    def items(text: str) -> list:
        data = json.loads(text)
        for step in array.split(".") if array else ():
            data = data.get(step) if isinstance(data, dict) else None
        return data if isinstance(data, list) else []

    def run(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for p in parts:
            got: list[str | None] = []
            for at in range(0, len(p), size):
                ids = p[key].iloc[at : at + size].tolist()
                try:
                    found = items(transport(method, url, json.dumps({batch_key: ids}), headers or {}, timeout))
                except Exception:  # noqa: BLE001
                    found = []
                if id_field:  # items that are no objects have no id
                    by = {str(x.get(id_field)): x for x in found if isinstance(x, dict)}
                    got += [json.dumps(by[str(i)]) if str(i) in by else None for i in ids]
                else:
                    got += [json.dumps(found[k]) if k < len(found) else None for k in range(len(ids))]
            yield p.assign(response=pd.Series(got, index=p.index, dtype=object))

    return df.mapInPandas(run, ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in df.schema) + ", response string")
