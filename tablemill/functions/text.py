"""Formatting, encoding, JSON paths and request templates as column expressions."""

from __future__ import annotations

import re
from typing import Any

from pyspark.sql import Column
from pyspark.sql import functions as F

#: How much of a failed job's message is told.
ERROR_CHARS = 500
_NAME = re.compile(r"\{(\w+)\}")


def fmt_bytes(c: Column) -> Column:
    """FUN-16: 1024-based, one decimal."""
    x = c.cast("double")
    shown = lambda power, unit: F.format_string(f"%.1f {unit}", F.bround(x / 1024.0**power, 1))  # noqa: E731  halves to even
    out = shown(4, "TB")
    for power, unit in ((3, "GB"), (2, "MB"), (1, "KB"), (0, "B")):
        out = F.when(x < 1024.0 ** (power + 1), shown(power, unit)).otherwise(out)
    return F.when(x.isNotNull(), out)


def fmt_count(c: Column) -> Column:
    """FUN-17: thousands, millions and billions, one decimal."""
    x = c.cast("double")
    return (
        F.when(x >= 1e9, F.format_string("%.1fB", x / 1e9)).when(x >= 1e6, F.format_string("%.1fM", x / 1e6))
        .when(x >= 1e3, F.format_string("%.1fK", x / 1e3)).otherwise(c.cast("bigint").cast("string"))
    )


def iso(c: Column, fraction: bool = True) -> Column:
    """FUN-20, FUN-25."""
    return F.date_format(c, "yyyy-MM-dd'T'HH:mm:ss" + (".SSSSSS" if fraction else ""))


def progress_bar(percent: Column, width: int = 20) -> Column:
    """FUN-24."""
    full = F.floor(F.least(F.greatest(percent, F.lit(0)), F.lit(100)) * width / 100).cast("int")
    return F.concat(F.repeat(F.lit("█"), full), F.repeat(F.lit("░"), F.lit(width) - full))


def shorten(c: Column, most: int = 200) -> Column:
    """FUN-23."""
    return F.substring(c, 1, most)


def percent_encode(c: Column) -> Column:
    """FUN-11: every byte but letters, digits and _.-~ (Q17)."""
    out = F.url_encode(c.cast("string"))
    for a, b in (("+", "%20"), ("*", "%2A"), ("%7E", "~")):
        out = F.replace(out, F.lit(a), F.lit(b))
    return out


def plain_base64(c: Column) -> Column:
    """FUN-15, without line breaks (Q18)."""
    return F.replace(F.base64(c), F.lit("\r\n"), F.lit(""))


def url(template: str, columns: dict[str, Column]) -> Column:
    """FUN-11: {name} is the encoded column; unknown names and nulls are empty (Q32)."""
    parts, at = [], 0
    for m in _NAME.finditer(template):
        parts.append(F.lit(template[at : m.start()]))
        parts.append(F.coalesce(percent_encode(columns[m[1]]), F.lit("")) if m[1] in columns else F.lit(""))
        at = m.end()
    return F.concat(*parts, F.lit(template[at:]))


def body(template: Any, columns: dict[str, Column], collections: dict[str, Column] | None = None) -> Column:
    """FUN-12, UDF-5: a JSON template compiled to a column; to_json of it is the request body.

    A lone placeholder keeps its type, a mixed string is text with nulls empty, $collections.x is a list.
    """
    if isinstance(template, dict):
        return F.struct(*[body(v, columns, collections).alias(k) for k, v in template.items()])
    if isinstance(template, list):
        return F.array(*[body(v, columns, collections) for v in template])
    if not isinstance(template, str):
        return F.lit(template)
    if template.startswith("$collections."):
        return (collections or {}).get(template.removeprefix("$collections."), F.array().cast("array<string>"))
    if m := _NAME.fullmatch(template):
        return columns.get(m[1], F.lit(None).cast("string"))
    parts, at = [], 0
    for m in _NAME.finditer(template):
        parts += [F.lit(template[at : m.start()]), F.coalesce(columns[m[1]].cast("string"), F.lit("")) if m[1] in columns else F.lit("")]
        at = m.end()
    return F.concat(*parts, F.lit(template[at:])) if parts else F.lit(template)


def json_path(c: Column, path: str, kind: str = "string") -> Column:
    """FUN-9: a dotted path with [i]; whatever is missing, of the wrong type or JSON null is null (Q16)."""
    if not all(re.fullmatch(r"\w+\[\d+\]|[^.\[\]]+", p) for p in path.split(".")):
        return F.lit(None).cast(kind)
    steps = "".join(f"['{m[1]}']" + (f"[{m[2]}]" if m[2] else "") for p in path.split(".") for m in [re.match(r"([^\[]+)(?:\[(\d+)\])?", p)])
    return F.get_json_object(c, "$" + steps).try_cast(kind)


def mapped(c: Column, mapping: list[dict]) -> list[Column]:
    """FUN-10: response columns."""
    return [json_path(c, m["json_path"], m.get("type", "string")).alias(m["column"]) for m in mapping]
