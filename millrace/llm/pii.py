"""Format-preserving pseudonyms for personal numbers and dates.

Valid cards, phone and social-security numbers, IPv4 addresses and dates are
permuted by a keyed Feistel network within their own format, so a value gets the
same pseudonym wherever it stands, two values never share one, and the key's
holder can turn them back. What only looks like one (a number that fails its
check sum, an impossible date) stays.

* card: 13 to 19 digits, blanks and hyphens kept; the check digit is made anew. In a
  run of more digits or one that fails its check sum, spans of whole digit groups
  are tried, those in a card's usual layout first, so a card is found beside its
  expiry date, its code or another number. A pseudonym is permuted again until the
  same spans are found in it, so that it can be turned back.
* phone: ``+`` and country code stay, the other digits are permuted; so are all ten of
  ``(202) 555-0199``.
* social security: three, two and four digits with hyphens, none of these all zeros,
  the first not 666 or from 900 on; permuted again until that holds for the pseudonym.
* IPv4: the address as one 32-bit number.
* date: ISO dates of 1900 to 2099, permuted among these 73,049 days.

Three kinds have no such form and get a keyed token instead, also linked but
one-way: the local part of mail addresses, access keys (``AKIA`` and 16 letters or
digits) and what follows ``password=`` or ``password:``, in any case.

All of it is SQL expressions; texts without a match pass through unchanged. The
patterns read a text once, without nesting that grows with it. The key is a column
of a one-row table, so no plan, log or web page shows it.
"""

from __future__ import annotations

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.llm.staging import packed

ROUNDS = 8
# Permutations tried until a run's spans are found again; each does with some 0.7 or more.
WALK = 40
OCTET = "(?:25[0-5]|2[0-4][0-9]|1[0-9][0-9]|[1-9]?[0-9])"
# Days of 1900 to 2099, and the grid of 256 x 286 that is a little larger.
DAYS = 73_049
# A name has at most 127 labels (253 characters), which also bounds the matcher's stack.
PATTERNS = {
    "email": r"(?<![A-Za-z0-9._%+-])[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++){0,125}\.[A-Za-z]{2,}+",
    "secret": r"(?i:password) ?[=:] ?[^\s]++|(?<![A-Za-z0-9])AKIA[A-Z0-9]{16}(?![A-Za-z0-9])",
    "ip": rf"(?<![0-9.])(?:{OCTET}\.){{3}}{OCTET}(?![0-9]|\.[0-9])",
    "date": r"(?<![0-9-])(?:19|20)[0-9]{2}-[0-9]{2}-[0-9]{2}(?![0-9-])",
    "ssn": r"(?<![0-9-])(?!000|666|9)[0-9]{3}-(?!00)[0-9]{2}-(?!0000)[0-9]{4}(?![0-9-])",
    "phone": r"\+[0-9]{1,3}[ -]?\(?[0-9]{2,4}\)?[ -]?[0-9]{3,4}[ -]?[0-9]{3,4}(?![0-9])|\([0-9]{3}\) ?[0-9]{3}-[0-9]{4}(?![0-9-])",
}
# A run of digit groups, up to a date or a social-security number.
PATTERNS["card"] = rf"(?<![0-9])[0-9](?:(?:[ -](?!{PATTERNS['date']}|{PATTERNS['ssn']}))?[0-9]){{12,}}+"
ANY = "|".join(PATTERNS.values())
# Mail address, secret, IPv4 address, phone, or 8 digits with their signs.
HINT = r"@|(?i:password) ?[=:]|AKIA|[0-9]\.[0-9]|[0-9](?:[ ()-]{0,2}[0-9]){7}"


def _quoted(text: str) -> str:
    return "'" + text.replace("\\", "\\\\").replace("'", "\\'") + "'"


def _noise(key: str, kind: str, turn: str, value: str) -> str:
    """60 keyed bits of a value as a bigint."""
    return f"cast(conv(substring(sha2(concat_ws(':', {key}, '{kind}', cast({turn} as string), cast({value} as string)), 256), 1, 15), 16, 10) as bigint)"


def _turns(back: bool) -> str:
    return f"sequence({ROUNDS}, 1, -1)" if back else f"sequence(1, {ROUNDS})"


def _digits(d: str, key: str, kind: str, back: bool) -> str:
    """The digit string ``d`` (at least 2 digits) permuted among those as long.

    State: two halves and their lengths, which swap each round.
    """
    start = (f"named_struct('a', cast(left({d}, length({d}) div 2) as bigint), 'la', length({d}) div 2, "
             f"'b', cast(substring({d}, length({d}) div 2 + 1) as bigint), 'lb', length({d}) - length({d}) div 2)")
    ten = lambda n: f"cast(power(10, {n}) as bigint)"
    if back:
        step = (f"named_struct('a', pmod(s.b - {_noise(key, kind, 'i', 's.a')} % {ten('s.lb')}, {ten('s.lb')}), 'la', s.lb, 'b', s.a, 'lb', s.la)")
    else:
        step = (f"named_struct('a', s.b, 'la', s.lb, 'b', (s.a + {_noise(key, kind, 'i', 's.b')} % {ten('s.la')}) % {ten('s.la')}, 'lb', s.la)")
    return (f"aggregate({_turns(back)}, {start}, (s, i) -> {step}, "
            "s -> concat(lpad(cast(s.a as string), s.la, '0'), lpad(cast(s.b as string), s.lb, '0')))")


def _pair(a: str, b: str, sizes: tuple[int, int], key: str, kind: str, back: bool, finish: str) -> str:
    """A number pair, each below its size, permuted among all such pairs."""
    na, nb = sizes
    sign = "-" if back else "+"
    step = (f"if(i % 2 = 0, named_struct('a', pmod(s.a {sign} {_noise(key, kind, 'i', 's.b')} % {na}, {na}), 'b', s.b), "
            f"named_struct('a', s.a, 'b', pmod(s.b {sign} {_noise(key, kind, 'i', 's.a')} % {nb}, {nb})))")
    return f"aggregate({_turns(back)}, named_struct('a', cast({a} as bigint), 'b', cast({b} as bigint)), (s, i) -> {step}, s -> {finish})"


def _check_sum(d: str) -> str:
    """Luhn's sum of a digit string."""
    digit = f"cast(substring({d}, i, 1) as int)"
    twice = f"if((length({d}) - i) % 2 = 1, if({digit} > 4, 2 * {digit} - 9, 2 * {digit}), {digit})"
    return f"aggregate(sequence(1, length({d})), 0, (t, i) -> t + {twice})"


def _refilled(shape: str, digits: str) -> str:
    """``shape`` with its digits replaced, one by one, by those given."""
    return (f"array_join(zip_with(split({shape}, '[0-9]', -1), concat(regexp_extract_all({digits}, '[0-9]', 0), array('')), "
            "(a, b) -> concat(a, b)), '')")


def _walked(start: str, step: str, good: str) -> str:
    """``step`` of ``w`` from ``start``, again and again until ``good`` holds for it.
    As both ends are good and steps are one to one, the same walk backwards returns."""
    return f"aggregate(sequence(1, {WALK}), {start}, (w, k) -> if(k > 1 and {good}, w, {step}))"


def _let(value: str, name: str, body: str) -> str:
    """``body`` with ``name`` bound to a value, which is worked out once."""
    return f"element_at(transform(array({value}), {name} -> {body}), 1)"


def _spans(d: str, sizes: str) -> str:
    """The cards among the digits ``d`` of a run of groups: structs of rank, first
    digit and negative end, none overlapping another, the best ranked chosen first."""
    cuts = f"aggregate({sizes}, array(0), (t, x) -> concat(t, array(element_at(t, -1) + x)))"
    layout = _quoted("^((4-){3}[1-4]|(4-){4}[1-3]|4-6-[45]|1[3-9])$")
    groups = f"array_join(transform(slice({sizes}, g + 1, h + 1), x -> cast(x as string)), '-')"
    rank = f"case when c[g] = 0 and c[g + h + 1] = length({d}) then 0 when {groups} rlike {layout} then 1 else 2 end"
    ends = "filter(sequence(0, least(18, size(c) - 2 - g)), h -> c[g + h + 1] - c[g] between 13 and 19)"
    every = f"flatten(transform(sequence(0, size(c) - 2), g -> transform({ends}, h -> struct({rank} as rank, c[g] as low, -c[g + h + 1] as high))))"
    valid = _let(f"substring({d}, v.low + 1, -v.high - v.low)", "y", f"{_check_sum('y')} % 10 = 0")
    cards = f"array_sort(filter({_let(cuts, 'c', every)}, v -> {valid}))"
    apart = "exists(p, u -> u.low < -v.high and v.low < -u.high)"
    return _let(cards, "l", f"aggregate(l, filter(l, v -> false), (p, v) -> if({apart}, p, concat(p, array(v))))")


def _cards(key: str, back: bool) -> str:
    """SQL for the run of digit groups ``m`` with the cards in it replaced."""
    check = f"cast((10 - {_check_sum(chr(39).join(['concat(q, ', '0', ')']))} % 10) % 10 as string)"
    made = _let("substring(w.d, v.low + 1, -v.high - v.low - 1)", "p", _let(_digits("p", key, "card", back), "q", f"concat(q, {check})"))
    placed = f"concat(left(w.d, v.low), {made}, substring(w.d, 1 - v.high))"
    walk = (f"aggregate(sequence(1, {WALK}), named_struct('d', r, 'done', false), (w, k) -> if(w.done, w, "
            f"{_let(placed, 'e', 'named_struct(' + chr(39) + 'd' + chr(39) + ', e, ' + chr(39) + 'done' + chr(39) + ', ' + _spans('e', 'z') + ' = f)')}), w -> w.d)")
    order = "reverse(f)" if back else "f"
    turned = _let(f"aggregate({order}, d, (r, v) -> {walk})", "n", _refilled("m", "n"))
    sizes = "transform(regexp_extract_all(m, '[0-9]+', 0), x -> length(x))"
    return _let("regexp_replace(m, '[^0-9]', '')", "d", _let(sizes, "z", _let(_spans("d", "z"), "f", f"if(size(f) = 0, m, {turned})")))


def _pseudonym(key: str, back: bool) -> str:
    """SQL for the pseudonym of a match ``m``."""
    bare = "regexp_replace(m, '[^0-9]', '')"
    number = lambda kind: _let(bare, "d", _let(_digits("d", key, kind, back), "e", _refilled("m", "e")))
    right = "(?!000|666|9)[0-9]{3}(?!00)[0-9]{2}(?!0000)[0-9]{4}"
    social = _let(_walked(bare, _digits("w", key, "ssn", back), f"w rlike '^{right}$'"), "e", _refilled("m", "e"))
    lead = r"regexp_extract(m, '^\\+(?:1(?=[0-9 (-])|[0-9]{1,3}(?=[ (-])|[0-9]{2})', 0)"
    phone = _let(lead, "c", _let("substring(m, length(c) + 1)", "r", _let("regexp_replace(r, '[^0-9]', '')", "d", _let(
        _digits("d", key, "phone", back), "e", f"concat(c, {_refilled('r', 'e')})"))))
    octets = "transform(split(m, '[.]'), x -> cast(x as bigint))"
    address = _let(octets, "o", _pair("o[0] * 256 + o[1]", "o[2] * 256 + o[3]", (65536, 65536), key, "ip", back,
                                      "concat_ws('.', cast(s.a div 256 as string), cast(s.a % 256 as string), cast(s.b div 256 as string), cast(s.b % 256 as string))"))
    other = _pair("w div 286", "w % 286", (256, 286), key, "date", back, "s.a * 286 + s.b")
    other = _walked("cast(n as bigint)", other, f"w < {DAYS}")
    day = _let("datediff(try_cast(m as date), date'1900-01-01')", "n",
               f"if(n is null or n < 0, m, cast(date_add(date'1900-01-01', cast({other} as int)) as string))")
    token = lambda kind, value, size: f"substring(sha2(concat_ws(':', {key}, '{kind}', {value}), 256), 1, {size})"
    full = lambda kind: _quoted(f"^(?:{PATTERNS[kind]})$")
    mail = "m" if back else f"concat('u', {token('email', 'lower(m)', 12)}, substring(m, instr(m, '@')))"
    akia = "m" if back else f"concat('AKIA', upper({token('key', 'm', 16)}))"
    lead_in = _quoted("^(?i:password) ?[=:] ?")
    password = "m" if back else f"concat(regexp_extract(m, {lead_in}, 0), {token('password', f'regexp_replace(m, {lead_in}, {chr(39) * 2})', 16)})"
    return (f"case when m rlike {lead_in} then {password} "
            f"when m rlike {full('email')} then {mail} "
            f"when m rlike '^AKIA[A-Z0-9]{{16}}$' then {akia} "
            f"when m rlike {full('ip')} then {address} "
            f"when m rlike {full('date')} then {day} "
            f"when m rlike {full('ssn')} then {social} "
            f"when startswith(m, '(') then {number('phone')} "
            f"when m rlike {full('phone')} then {phone} "
            f"else {_cards(key, back)} end")


def pseudonymised(df: DataFrame, key: str, text: str = "text", back: bool = False) -> DataFrame:
    """All columns, with the values found in ``text`` replaced; ``back`` restores
    numbers and dates under the same key.

    Null and empty texts stay as they are; rows are neither dropped nor merged.
    """
    at = F.col(f"row.`{text}`").cast("string")
    secret = df.sparkSession.createDataFrame(pa.table({"one": pa.array([1], pa.int32()), "secret": [key]}))
    rows = df.select(packed(df).alias("row"), F.lit(1).alias("one")).join(F.broadcast(secret), "one")
    found = F.regexp_extract_all(at, F.lit(ANY), F.lit(0))
    rows = rows.select("row", "secret", F.when(at.rlike(HINT), found).alias("found"))
    gaps = F.split(at, ANY, -1)
    new = F.expr(f"transform(found, m -> {_pseudonym('secret', back)})")
    whole = F.array_join(F.zip_with(gaps, F.concat(new, F.array(F.lit(""))), lambda g, n: F.concat(g, n)), "")
    changed = F.when(F.size("found") > 0, whole).otherwise(at)
    return rows.select(*[changed.alias(text) if c == text else F.col(f"row.`{c}`").alias(c) for c in df.columns])


def pseudonymised_documents(docs: DataFrame, key: str) -> DataFrame:
    """(doc_id, text) of every document with its personal values replaced."""
    return pseudonymised(docs.select("doc_id", "text"), key)
