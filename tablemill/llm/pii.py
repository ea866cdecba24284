"""PII pseudonyms that keep the format, by keyed Feistel networks in SQL functions.

Texts are cut at the places one pattern finds. Each place is validated by its kind and, if it holds, replaced:
  card       13-19 digits that pass the Luhn check: all digits but the last are permuted, the check digit is made anew
  iban       country, then check digits 02 to 98 that hold by mod 97: letters and digits behind them are permuted, and
             checked anew
  ssn        ddd-dd-dddd by the issuing rules of its area, group and serial: the digits are permuted, walking to a valid one
  date       yyyy-mm-dd, dd.mm.yyyy, dd/mm/yyyy or mm/dd/yyyy of a real day from 0001 to 9999: the days from 1900-01-01
             to 2101-03-27 are permuted among themselves, and so are all others. A slash date is dd/mm/yyyy if it can be;
             those that can only be mm/dd/yyyy are permuted among themselves, walking to a day above the 12th
  ip         four numbers up to 255: each pair of numbers is permuted; numbers written with leading zeros keep their width
  phone      + and 7-15 digits with their separators: the digits behind the country code are permuted
  email      letters and digits of the address before the last label are permuted within their kinds
  secret     the value, of any length, behind a label such as token, password or api_key: letters and digits are permuted
             within their kinds (an e-mail address there is one)
A permutation depends on the key, the kind and the format alone, so equal values get equal pseudonyms in all documents
and different values of a format different ones. Numbers that fail their check are left alone.

Feistel: a value is (a, b) with a below A and b below B; each of ROUNDS rounds adds a keyed hash of one half to the
other, modulo its size, which is a permutation for any A and B. Strings over letters and digits are cut in two halves;
a round shifts each character of one half, within its kind, by a keyed stream from the other half, which can be undone
as well. Subsets (valid numbers, real days) are permuted by walking on until a member is met.

Only rows whose text holds a place are worked on; there is no shuffle. The key comes from the caller; the query's is a
fixed test key. The plan holds a key derived from the caller's, not that key itself; but whoever can read plans or event
logs can make pseudonyms with it, so hide it there with spark.sql.redaction.string.regex = [0-9a-f]{64}.

Edge cases: null and empty texts stay; rows repeated or in any order get the same pseudonyms; an empty table stays
empty; further columns pass through; a place inside a longer run of digits or letters is no place.
"""

from __future__ import annotations

import hashlib
import hmac

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tablemill.llm.common import free_name, read

ROUNDS = 8
#: Days from FIRST on that dates are permuted among: 245 x 300, up to 2101-03-27.
FIRST, DAYS_A, DAYS_B = "1900-01-01", 245, 300
#: All other days from 0001-01-01 to 9999-12-31; BEFORE of them lie before FIRST. FAR_A * FAR_B is a little more.
BEFORE, FAR = 693595, 3578559
FAR_A, FAR_B = 1892, 1892

EMAIL = r"[A-Za-z0-9._%+-]{1,64}@[A-Za-z0-9-]{1,63}(?:\.[A-Za-z0-9-]{1,63}){0,8}\.[A-Za-z]{2,24}(?![A-Za-z0-9-])"
#: Each kind's pattern, in the order in which they are tried at a place. No capturing groups, Java and RE2 syntax but for
#: the guards.
KINDS = {
    "secret": r"(?<![A-Za-z0-9_])(?i:token|password|passwd|secret|api[_-]?key)\s{0,3}[=:]\s{0,3}[\x22']?" + rf"(?!{EMAIL})(?=[A-Za-z0-9_.=~+/-]{{5}}\.*+[A-Za-z0-9_=~+/-])[A-Za-z0-9_.=~+/-]++",
    "email": r"(?<![A-Za-z0-9._%+-])" + EMAIL,
    "iban": r"(?<![A-Za-z0-9])[A-Z]{2}[0-9]{2}(?: ?[A-Z0-9]{4}){2,7}(?: ?[A-Z0-9]{1,3})?(?![A-Za-z0-9])",
    "date": r"(?<![0-9./-])(?:[0-9]{4}-[0-9]{2}-[0-9]{2}|[0-9]{2}/[0-9]{2}/[0-9]{4}|[0-9]{2}\.[0-9]{2}\.[0-9]{4})(?![0-9/-])",
    "ssn": r"(?<![0-9-])[0-9]{3}-[0-9]{2}-[0-9]{4}(?![0-9-])",
    "ip": r"(?<![0-9.])[0-9]{1,3}\.[0-9]{1,3}\.[0-9]{1,3}\.[0-9]{1,3}(?![0-9]|\.[0-9])",
    "phone": r"(?<![0-9+])\+(?:[0-9]{1,3}[ .-]?\([0-9]{1,4}\)[ .-]?[0-9]{2,4}[ .-]?[0-9]{3,4}|[0-9]{7,15}|[0-9]{1,3}(?:[ -][0-9]{1,4}){2,5}|[0-9]{1,3}(?:\.[0-9]{1,4}){2,5})(?![0-9])",
    "card": r"(?<![0-9])(?:[0-9]{13,19}|[0-9]{4}(?:[ -][0-9]{4}){3}|[0-9]{4}[ -][0-9]{6}[ -][0-9]{5})(?![0-9])",
}
PATTERN = "|".join(KINDS.values())
#: A place needs one of these characters.
HINT = r"[0-9]{2}|[0-9][.][0-9]|@|[=:]\s{0,3}[\x22']?[A-Za-z0-9_.=~+/-]{6}"


def _quoted(s: str) -> str:
    return "'" + s.replace("\\", "\\\\").replace("'", "\\'") + "'"


def _hash(key: str, *parts: str) -> str:
    """A keyed number below 2 ** 60, as SQL."""
    return f"cast(conv(substr(sha2(concat_ws('|', {_quoted(key)}, {', '.join(parts)}), 256), 1, 15), 16, 10) as bigint)"


def feistel(key: str, tweak: str, a: str, b: str, size_a: str, size_b: str) -> str:
    """SQL struct (a, b) after all rounds. The sizes are SQL, too."""
    even = f"named_struct('a', pmod(s.a + {_hash(key, tweak, 'r', 's.b')}, {size_a}), 'b', s.b)"
    odd = f"named_struct('a', s.a, 'b', pmod(s.b + {_hash(key, tweak, 'r', 's.a')}, {size_b}))"
    start = f"named_struct('a', cast({a} as bigint), 'b', cast({b} as bigint))"
    return f"aggregate(sequence(0, {ROUNDS - 1}), {start}, (s, r) -> if(r % 2 = 0, {even}, {odd}))"


def _let(name: str, value: str, body: str) -> str:
    return f"transform(array({value}), {name} -> {body})[0]"


def digits(key: str, tweak: str, d: str) -> str:
    """A string of 2 to 18 digits, permuted among those of its length; one digit is shifted."""
    n = f"length({d})"
    size = lambda k: f"cast(pow(10, {k}) as bigint)"
    left, right = f"cast(floor({n} / 2) as int)", f"cast(ceil({n} / 2) as int)"
    f = feistel(key, f"{tweak}, {n}", f"substr({d}, 1, {left})", f"substr({d}, {left} + 1)", size(left), size(right))
    two = _let("f", f, f"concat(lpad(cast(f.a as string), {left}, '0'), lpad(cast(f.b as string), {right}, '0'))")
    one = f"cast(pmod(cast({d} as bigint) + {_hash(key, tweak, '1')}, 10) as string)"
    return f"if({n} > 1, {two}, {one})"


def refill(shape: str, chars: str) -> str:
    """The shape with its digits, in order, exchanged for the given ones."""
    step = (
        f"if(c between '0' and '9', named_struct('t', concat(s.t, substr({chars}, s.i, 1)), 'i', s.i + 1), named_struct('t', concat(s.t, c), 'i', s.i))"
    )
    return f"aggregate(split({shape}, ''), named_struct('t', '', 'i', 1), (s, c) -> {step}).t"


def luhn_sum(d: str) -> str:
    """Luhn's sum of a digit string whose last digit is not doubled."""
    v = f"cast(substr({d}, i, 1) as int)"
    return f"aggregate(sequence(1, length({d})), 0, (s, i) -> s + if((length({d}) - i) % 2 = 1, {v} * 2 - if({v} > 4, 9, 0), {v}))"


def characters(key: str, tweak: str, x: str) -> str:
    """Letters and digits shifted within their kinds by a stream from the tweak; other characters stay."""
    shift = f"cast(conv(substr(sha2(concat_ws('|', {_quoted(key)}, {tweak}, cast(floor(i / 16) as string)), 256), 1 + (i % 16) * 4, 4), 16, 10) as int)"
    move = lambda base, n: f"char({base} + pmod(ascii(c) - {base} + {shift}, {n}))"
    step = f"case when c between '0' and '9' then {move(48, 10)} when c between 'a' and 'z' then {move(97, 26)} when c between 'A' and 'Z' then {move(65, 26)} else c end"
    return f"array_join(transform(split({x}, ''), (c, i) -> {step}), '')"


def permuted(key: str, tweak: str, x: str) -> str:
    """A string's letters and digits permuted within their kinds: a Feistel network over its halves. The stream of a
    half comes from the other one's hash, so the work is linear."""
    n = f"cast(length({x}) div 2 as int)"
    t = f"concat_ws('|', {tweak}, r, w)"
    even = _let("w", "sha2(s.b, 256)", f"named_struct('a', {characters(key, t, 's.a')}, 'b', s.b)")
    odd = _let("w", "sha2(s.a, 256)", f"named_struct('a', s.a, 'b', {characters(key, t, 's.b')})")
    run = f"aggregate(sequence(0, {ROUNDS - 1}), named_struct('a', substr({x}, 1, {n}), 'b', substr({x}, {n} + 1)), (s, r) -> if(r % 2 = 0, {even}, {odd}))"
    return _let("p", run, "concat(p.a, p.b)")


def mod97(x: str) -> str:
    """An upper-case letter and digit string as a number (A is 10), modulo 97."""
    return f"aggregate(split({x}, ''), 0, (s, c) -> if(c between '0' and '9', (s * 10 + cast(c as int)) % 97, (s * 100 + ascii(c) - 55) % 97))"


def _card(key: str) -> str:
    body = f"concat({digits(key, _quoted('card'), 'substr(d, 1, length(d) - 1)')}, '0')"
    full = _let("z", body, f"concat(substr(z, 1, length(z) - 1), cast((10 - {luhn_sum('z')} % 10) % 10 as string))")
    return _let("d", "regexp_replace(m, '[^0-9]', '')", f"if({luhn_sum('d')} % 10 = 0 and d rlike '[1-9]', {_let('y', full, refill('m', 'y'))}, m)")


def _iban(key: str) -> str:
    valid = f"substr(d, 3, 2) between '02' and '98' and {mod97('concat(substr(d, 5), substr(d, 1, 4))')} = 1"
    made = _let("y", permuted(key, "concat('iban', substr(d, 1, 2))", "substr(d, 5)"), f"concat(substr(d, 1, 2), lpad(cast(98 - {mod97('concat(y, substr(d, 1, 2), ' + _quoted('00') + ')')} as string), 2, '0'), y)")
    spaced = "aggregate(split(m, ''), named_struct('t', '', 'i', 1), (s, c) -> if(c = ' ', named_struct('t', concat(s.t, c), 'i', s.i), named_struct('t', concat(s.t, substr(z, s.i, 1)), 'i', s.i + 1))).t"
    return _let("d", "replace(m, ' ', '')", f"if(length(d) between 15 and 34 and {valid}, {_let('z', made, spaced)}, m)")


def _ssn(key: str) -> str:
    valid = lambda d: f"(substr({d}, 1, 3) not in ('000', '666') and substr({d}, 1, 1) <> '9' and substr({d}, 4, 2) <> '00' and substr({d}, 6) <> '0000')"
    step = digits(key, _quoted("ssn"), "w")
    # walking on from a valid value meets a valid one again after 1.1 steps on average; the walk is a cycle, so it is a permutation
    walk = f"aggregate(sequence(1, 40), {_let('w', 'd', step)}, (w, k) -> if({valid('w')}, w, {step}))"
    return _let("d", "replace(m, '-', '')", f"if({valid('d')}, {_let('y', walk, refill('m', 'y'))}, m)")


def _date(key: str) -> str:
    us = "m like '__/__/____' and try_to_date(m, 'dd/MM/yyyy') is null"
    day = "case when m like '____-__-__' then try_to_date(m, 'yyyy-MM-dd') when m like '__.__.____' then try_to_date(m, 'dd.MM.yyyy') else coalesce(try_to_date(m, 'dd/MM/yyyy'), try_to_date(m, 'MM/dd/yyyy')) end"
    shape = f"case when m like '____-__-__' then 'yyyy-MM-dd' when m like '__.__.____' then 'dd.MM.yyyy' when {us} then 'MM/dd/yyyy' else 'dd/MM/yyyy' end"
    near = f"d between date'{FIRST}' and date_add(date'{FIRST}', {DAYS_A * DAYS_B - 1})"
    kinds = [  # start: a day's number among its kind's; back: the number's day
        ("near", f"datediff(d, date'{FIRST}')", f"date_add(date'{FIRST}', cast({{w}} as int))", DAYS_A, DAYS_B, DAYS_A * DAYS_B),
        ("far", f"datediff(d, date'0001-01-01') - if(d >= date'{FIRST}', {DAYS_A * DAYS_B}, 0)", f"date_add(date'0001-01-01', cast({{w}} + if({{w}} >= {BEFORE}, {DAYS_A * DAYS_B}, 0) as int))", FAR_A, FAR_B, FAR),
    ]

    def moved(name: str, start: str, back: str, a: int, b: int, size: int) -> str:
        step = _let("f", feistel(key, _quoted("date" + name), f"floor(w / {b})", f"w % {b}", str(a), str(b)), f"f.a * {b} + f.b")
        good = f"case when w >= {size} then false when u then day({back.format(w='w')}) > 12 else true end"
        # a member is met again after 1.7 steps on average, and at once if all days but a few are members
        walk = f"aggregate(sequence(1, 60), {_let('w', f'cast({start} as bigint)', step)}, (w, k) -> if({good}, w, {step}))"
        return _let("y", walk, f"date_format({back.format(w='y')}, {shape})")

    return _let("d", day, _let("u", us, f"case when d is null then m when {near} then {moved(*kinds[0])} else {moved(*kinds[1])} end"))


def _ip(key: str) -> str:
    p = [f"split(m, '[.]')[{k}]" for k in range(4)]
    valid = " and ".join(f"cast({x} as int) < 256" for x in p)
    # numbers written with leading zeros have one digit less to choose from, and are written as wide again
    wide = [f"if(length({x}) > 1 and substr({x}, 1, 1) = '0', length({x}), 0)" for x in p]
    size = [f"case {w} when 0 then 256 when 2 then 10 else 100 end" for w in wide]
    a, b = (f"cast({p[k]} as int) * {size[k + 1]} + cast({p[k + 1]} as int)" for k in (0, 2))
    f = feistel(key, f"concat_ws(',', 'ip', {', '.join(wide)})", a, b, f"({size[0]}) * {size[1]}", f"({size[2]}) * {size[3]}")
    got = [f"f.{h} {op} ({size[k]})" for h, op, k in (("a", "div", 1), ("a", "%", 1), ("b", "div", 3), ("b", "%", 3))]
    out = ", ".join(f"if({w} > 0, lpad(cast({g} as string), {w}, '0'), cast({g} as string))" for w, g in zip(wide, got))
    return f"if({valid}, {_let('f', f, f'concat_ws({_quoted(chr(46))}, {out})')}, m)"


def _phone(key: str) -> str:
    rest = "regexp_replace(substr(m, length(h) + 1), '[^0-9]', '')"
    y = _let("d", rest, _let("y", digits(key, _quoted("phone"), "d"), f"concat(h, {refill('substr(m, length(h) + 1)', 'y')})"))
    return _let("h", "regexp_extract(m, '^[+][0-9]{1,3}(?=[ .(-])|^[+][0-9]', 0)", f"if(length(regexp_replace(m, '[^0-9]', '')) between 7 and 15 and length({rest}) > 0, {y}, m)")


def _email(key: str) -> str:
    return _let("h", "regexp_extract(m, '^(.*)[.][A-Za-z]+$', 1)", f"concat({permuted(key, _quoted('email'), 'h')}, substr(m, length(h) + 1))")


def _secret(key: str) -> str:
    """Dots at the end are a sentence's."""
    moved = _let("v", "trim(TRAILING '.' FROM substr(m, length(h) + 1))", f"concat(h, {permuted(key, _quoted('secret'), 'v')}, substr(m, length(h) + length(v) + 1))")
    return _let("h", r"regexp_extract(m, '^[A-Za-z_-]+\\s*[=:]\\s*[\\x22\']?', 0)", moved)


def pseudonym(key: str) -> str:
    """SQL for the replacement of one place, m."""
    key = hmac.new(key.encode(), b"pseudonyms", hashlib.sha256).hexdigest()
    make = {"secret": _secret, "email": _email, "iban": _iban, "date": _date, "ssn": _ssn, "ip": _ip, "phone": _phone, "card": _card}
    return "case " + " ".join(f"when m rlike {_quoted('^(?:' + p + ')$')} then {make[kind](key)}" for kind, p in KINDS.items()) + " else m end"


def pseudonymize(docs: DataFrame, key: str, *, text: str = "text", n_replaced: str | None = None) -> DataFrame:
    """docs with the text's places replaced; and how many were, if a column is named for that."""
    found, parts, new = (free_name(docs.columns, n) for n in ("found", "parts", "new"))
    t = F.col(f"`{text}`")
    hit = F.when(t.rlike(HINT), F.expr(f"regexp_extract_all(`{text}`, {_quoted(PATTERN)}, 0)"))
    out = docs.withColumn(found, hit)
    out = out.withColumn(new, F.when(F.size(found) > 0, F.expr(f"transform(`{found}`, m -> {pseudonym(key)})")))
    out = out.withColumn(parts, F.when(F.size(found) > 0, F.expr(f"split(`{text}`, {_quoted(PATTERN)}, -1)")))
    joined = F.expr(f"concat(array_join(transform(`{new}`, (x, i) -> concat(`{parts}`[i], x)), ''), element_at(`{parts}`, -1))")
    changed = F.expr(f"coalesce(aggregate(arrays_zip(`{found}`, `{new}`), 0L, (s, z) -> s + if(z.`{found}` <> z.`{new}`, 1L, 0L)), 0L)")
    cols = [F.when(F.col(new).isNull(), t).otherwise(joined).alias(text) if c == text else F.col(f"`{c}`") for c in docs.columns]
    return out.select(*cols, *([changed.alias(n_replaced)] if n_replaced else []))


#: Of the registered query; a real job passes its own.
TEST_KEY = "0f1e2d3c4b5a69788796a5b4c3d2e1f0"


def op1(spark, sf_dir: str) -> DataFrame:
    return pseudonymize(read(spark, sf_dir, "documents").select("doc_id", "text"), TEST_KEY, n_replaced="n_replaced")
