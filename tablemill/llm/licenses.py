"""License scans: Aho-Corasick over words, and a shunting-yard parser for licence expressions.

One automaton over the words of a whole text finds identifier tags and notice phrases; behind each place of a tag, the
expression is read from the rest of its raw line, parsed by precedence (with, and, or) and evaluated to the licences it
names. Nothing is shuffled; each text is scanned by itself.

Labels: the base labels of the four base phrases; the method adds those of NOTICES, `spdx:<id>` for every licence of a
valid tag expression (an OR also adds `choice:<id>` for its least restrictive side, a WITH `exception:<id>`), and
`spdx-invalid` for a tag whose expression does not parse or names what is no licence: an operand is one of LICENCES,
perhaps with a + behind it, or a LicenseRef- or DocumentRef- of one's own; behind WITH stands one of EXCEPTIONS or an
AdditionRef-. A tag without a colon or equals sign behind it counts only if a valid expression follows; else it is
prose about tags. Score: 1 for a valid tag; else 1 - 0.5 ** (notice places).

Edge cases: null and empty texts have no words, no labels (empty strings) and score 0; overlapping places all count;
repeated rows and rows without an id are scanned like others; an empty table gives no rows; further columns are ignored.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import ahocorasick
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from tablemill.llm.common import append, read, words

#: Fixed by the query's contract.
BASE = {"gnu general public license": "gpl", "apache license": "apache", "cc by": "cc-by", "mit license": "mit"}
#: Further notice phrases and the labels they give.
NOTICES = {
    "gnu lesser general public license": "lgpl",
    "gnu affero general public license": "agpl",
    "mozilla public license": "mpl",
    "eclipse public license": "epl",
    "european union public licence": "eupl",
    "boost software license": "bsl",
    "isc license": "isc",
    "zlib license": "zlib",
    "artistic license": "artistic",
    "open font license": "ofl",
    "gnu free documentation license": "gfdl",
    "creative commons attribution": "cc-by-notice",
    "creative commons zero": "cc0",
    "cc0 1 0 universal": "cc0",
    "this is free and unencumbered software released into the public domain": "unlicense",
    "public domain dedication": "public-domain",
    "bsd license": "bsd",
    "cc by nc": "cc-by-nc",
    "cc by sa": "cc-by-sa",
    "cc by nd": "cc-by-nd",
    "all rights reserved": "all-rights-reserved",
    "permission is hereby granted free of charge": "mit-notice",
    "redistribution and use in source and binary forms": "bsd-notice",
}
TAG = "spdx license identifier"
#: Identifiers of common licences in the public SPDX list, and of its exceptions. Fixed values.
LICENCES = frozenset("""
0BSD AAL AFL-2.1 AFL-3.0 AGPL-1.0 AGPL-1.0-only AGPL-1.0-or-later AGPL-3.0 AGPL-3.0-only AGPL-3.0-or-later Apache-1.0
Apache-1.1 Apache-2.0 APSL-2.0 Artistic-1.0 Artistic-1.0-Perl Artistic-2.0 BlueOak-1.0.0 BSD-1-Clause BSD-2-Clause
BSD-2-Clause-Patent BSD-3-Clause BSD-3-Clause-Clear BSD-3-Clause-LBNL BSD-4-Clause BSL-1.0 BUSL-1.0 CAL-1.0 CC-BY-1.0
CC-BY-2.0 CC-BY-2.5 CC-BY-3.0 CC-BY-4.0 CC-BY-NC-2.0 CC-BY-NC-3.0 CC-BY-NC-4.0 CC-BY-NC-ND-3.0 CC-BY-NC-ND-4.0
CC-BY-NC-SA-3.0 CC-BY-NC-SA-4.0 CC-BY-ND-3.0 CC-BY-ND-4.0 CC-BY-SA-2.0 CC-BY-SA-2.5 CC-BY-SA-3.0 CC-BY-SA-4.0
CC-PDDC CC0-1.0 CDDL-1.0 CDDL-1.1 CECILL-2.1 CECILL-B CECILL-C CPAL-1.0 CPL-1.0 curl ECL-2.0 EFL-2.0 Elastic-2.0
EPL-1.0 EPL-2.0 EUPL-1.1 EUPL-1.2 FSFAP FTL GFDL-1.1-only GFDL-1.1-or-later GFDL-1.2-only GFDL-1.2-or-later
GFDL-1.3-only GFDL-1.3-or-later GPL-1.0 GPL-1.0-only GPL-1.0-or-later GPL-2.0 GPL-2.0-only GPL-2.0-or-later GPL-3.0
GPL-3.0-only GPL-3.0-or-later HPND ICU IJG IPL-1.0 ISC JSON LGPL-2.0 LGPL-2.0-only LGPL-2.0-or-later LGPL-2.1
LGPL-2.1-only LGPL-2.1-or-later LGPL-3.0 LGPL-3.0-only LGPL-3.0-or-later Libpng LPPL-1.3c MIT MIT-0 MIT-CMU
MIT-Modern-Variant MPL-1.0 MPL-1.1 MPL-2.0 MPL-2.0-no-copyleft-exception MS-PL MS-RL MulanPSL-2.0 NCSA NTP ODbL-1.0
ODC-By-1.0 OFL-1.0 OFL-1.1 OLDAP-2.8 OpenSSL OSL-2.1 OSL-3.0 PDDL-1.0 PHP-3.0 PHP-3.01 PostgreSQL PSF-2.0 Python-2.0
QPL-1.0 RPL-1.5 Ruby SISSL Sleepycat SSPL-1.0 Unicode-3.0 Unicode-DFS-2016 Unlicense UPL-1.0 Vim W3C WTFPL X11 Zend-2.0
Zlib zlib-acknowledgement ZPL-2.1
""".lower().split())
EXCEPTIONS = frozenset("""
Autoconf-exception-2.0 Autoconf-exception-3.0 Bison-exception-2.2 Bootloader-exception Classpath-exception-2.0
Font-exception-2.0 GCC-exception-2.0 GCC-exception-3.1 GPL-CC-1.0 Libtool-exception Linux-syscall-note LLVM-exception
LGPL-3.0-linking-exception OpenJDK-assembly-exception-1.0 openvpn-openssl-exception Qt-GPL-exception-1.0
Qt-LGPL-exception-1.1 Universal-FOSS-exception-1.0 WxWindows-exception-3.1
""".lower().split())
_WORD = re.compile(r"[0-9A-Za-z\x80-\U0010ffff]+")
_REST = re.compile(r"([ \t]*[:=])?[ \t]*([^\r\n]*)")
_END = re.compile(r"\*/|-->|[\"'#]+\s*$")
_TOKEN = re.compile(r"[()]|[^\s()]+")
_RANK = {"with": 3, "and": 2, "or": 1}
#: From permissive to restrictive: what an OR lets the reader choose first.
_ORDER = ("mit", "bsd", "isc", "apache", "cc0", "cc-by", "mpl", "lgpl", "gpl", "agpl")


def to_postfix(expression: str) -> list[str] | None:
    """Postfix order by Dijkstra's shunting yard; None if the expression is not well formed."""
    out: list[str] = []
    held: list[str] = []
    operand = False  # whether the last token ended an operand
    for tok in _TOKEN.findall(expression):
        op = tok.lower()
        if op in _RANK:
            if not operand:
                return None
            while held and held[-1] != "(" and _RANK[held[-1]] >= _RANK[op]:
                out.append(held.pop())
            held.append(op)
            operand = False
        elif tok == "(":
            if operand:
                return None
            held.append(tok)
        elif tok == ")":
            if not operand:
                return None
            while held and held[-1] != "(":
                out.append(held.pop())
            if not held:
                return None
            held.pop()
        elif operand:
            return None
        else:
            out.append(op)
            operand = True
    if not operand:
        return None
    while held:
        if held[-1] == "(":
            return None
        out.append(held.pop())
    return out


def _cost(licences: frozenset[str]) -> tuple[int, list[str]]:
    at = [next((k for k, x in enumerate(_ORDER) if one.startswith(x)), len(_ORDER)) for one in licences]
    return max(at, default=0), sorted(licences)


def is_licence(name: str) -> bool:
    return name.removesuffix("+") in LICENCES or re.fullmatch(r"(documentref-[a-z0-9.-]+:)?licenseref-[a-z0-9.-]+", name) is not None


def is_exception(name: str) -> bool:
    return name in EXCEPTIONS or re.fullmatch(r"(documentref-[a-z0-9.-]+:)?additionref-[a-z0-9.-]+", name) is not None


def evaluate(expression: str) -> set[str] | None:
    """Labels of an expression: every licence named, the chosen side of each OR, exceptions; None if it is invalid."""
    postfix = to_postfix(expression)
    if postfix is None:
        return None
    if any(tok not in _RANK and not is_licence(tok) and not is_exception(tok) for tok in postfix):
        return None
    labels: set[str] = set()
    stack: list[frozenset[str]] = []
    for tok in postfix:
        if tok not in _RANK:
            stack.append(frozenset([tok]))
            continue
        right, left = stack.pop(), stack.pop()
        if tok == "with":
            if len(right) != 1 or len(left) != 1 or not all(map(is_exception, right)) or not all(map(is_licence, left)):
                return None
            labels.add("exception:" + next(iter(right)))
            stack.append(left)
        elif not all(map(is_licence, left | right)):
            return None
        elif tok == "and":
            stack.append(left | right)
        else:
            chosen = min(left, right, key=_cost)
            labels |= {"spdx:" + x for x in left | right} | {"choice:" + x for x in chosen}
            stack.append(chosen)
    return labels | {"spdx:" + x for x in stack[0]} if all(map(is_licence, stack[0])) else None


def automaton() -> ahocorasick.Automaton:
    a = ahocorasick.Automaton()
    for phrase, label in {**BASE, **NOTICES, TAG: ""}.items():
        a.add_word(f" {phrase} ", (phrase.count(" ") + 1, len(phrase) + 1, label, phrase in BASE, phrase == TAG))
    a.make_automaton()
    return a


def behind(text: str | None, numbers: list[int]) -> Iterator[int]:
    """Where the raw text goes on behind the words of these ascending numbers."""
    if numbers:
        wanted = set(numbers)
        yield from (m.end() for k, m in enumerate(_WORD.finditer(text)) if k in wanted)


def scan(text: str | None, a: ahocorasick.Automaton) -> dict:
    w = words(text)
    joined = (b" " + b" ".join(w) + b" ").decode() if w else ""
    base, extra, first, last, n, places, tags = set(), set(), None, None, 0, 0, []
    at, seen = 0, 0
    # matches come by their end; word numbers are counted on from the last match's end, so the text is counted once
    for end, (size, length, label, is_base, is_tag) in a.iter(joined):
        seen += joined.count(" ", at, end)
        at = end
        start = seen - size
        if is_tag:
            tags.append(start + size - 1)
        else:
            places += 1
            (base if is_base else extra).add(label)
        if is_base:
            n += 1
            first = start if first is None else min(first, start)
            last = start if last is None else max(last, start)
    valid = False
    for rest in behind(text, tags):
        marked, expression = _REST.match(text, rest).groups()
        found = evaluate(_END.sub(" ", expression))
        valid |= found is not None
        extra |= found if found is not None else {"spdx-invalid"} if marked else set()
    return {
        "n_words": len(w), "n_base": n, "first_word": first, "last_word": last,
        "base_labels": ",".join(sorted(base)), "labels": ",".join(sorted(base | extra)), "score": 1.0 if valid else 1 - 0.5**places,
    }


FIELDS = [T.StructField(n, t) for n, t in (("n_words", T.LongType()), ("n_base", T.LongType()), ("first_word", T.LongType()), ("last_word", T.LongType()), ("base_labels", T.StringType()), ("labels", T.StringType()), ("score", T.DoubleType()))]
_ARROW = (pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.string(), pa.string(), pa.float64())
_made: list = []


def _scan_column(col: pa.Array) -> list[pa.Array]:
    if not _made:
        _made.append(automaton())
    rows = [scan(x, _made[0]) for x in col.to_pylist()]
    return [pa.array([r[f.name] for r in rows], t) for f, t in zip(FIELDS, _ARROW)]


def license_scan(docs: DataFrame, *, id: str = "doc_id", text: str = "text") -> DataFrame:
    """One row a document: its id and the scan's columns."""
    return append(docs.selectExpr(f"`{id}` as doc_id", f"`{text}` as text"), "text", FIELDS, _scan_column).drop("text")


def op9(spark, sf_dir: str) -> DataFrame:
    return license_scan(read(spark, sf_dir, "documents"))
