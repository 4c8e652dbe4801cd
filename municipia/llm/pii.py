"""Format-preserving pseudonyms for personal data, as column expressions only.

What a pattern finds and a check confirms (Luhn, mod 97, octets, calendar, numbering plan) is replaced by a value of the same format, chosen by
a keyed Feistel permutation of the valid values: equal values get equal pseudonyms in every document, different ones different pseudonyms, and
a pseudonym passes the same checks. Letters and digits of names, keys and tokens are permuted within their own alphabets.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from municipia.llm.common import feistel_sql, free_name

LOWER, UPPER, DIGITS, HEX = "abcdefghijklmnopqrstuvwxyz", "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "0123456789", "0123456789abcdef"

# Kinds in order of precedence: name, pattern of a whole value, what may not stand before it, what may not follow.
# The e-mail's domain is matched possessively: a plain repeated group would need a stack frame per label.
KINDS = (
    ("email", r"[A-Za-z0-9._%+-]{1,64}@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]++)++", r"(?<![A-Za-z0-9._%+-])", ""),
    ("key", r"(?:AKIA|ASIA)[A-Z0-9]{16}", r"(?<![A-Za-z0-9])", r"(?![A-Za-z0-9])"),
    ("secret", r"[A-Za-z0-9+/_-]{8,}", r"(?<=[=\"])(?<=(?:password|passwd|secret|token|api[_-]key) {0,1}= {0,1}\"{0,1})", ""),
    ("iban", r"[A-Z]{2}[0-9]{2}(?: ?[A-Z0-9]{4}){2,7}(?: ?[A-Z0-9]{1,3})?", r"(?<![A-Za-z0-9])", r"(?![A-Za-z0-9])"),
    ("ip", r"[0-9]{1,3}(?:\.[0-9]{1,3}){3}", r"(?<![0-9.])", r"(?![0-9]|\.[0-9])"),
    ("date", r"(?:[0-9]{4}-[0-9]{2}-[0-9]{2}|[0-9]{1,2}([/.])[0-9]{1,2}\1[0-9]{4})", r"(?<![0-9/.-])", r"(?![0-9/-]|\.[0-9])"),
    ("ssn", r"[0-9]{3}-[0-9]{2}-[0-9]{4}", r"(?<![0-9-])", r"(?![0-9-])"),
    ("phone", r"(?:(?:\+?1[ .-]?)?(?:\([0-9]{3}\) ?|[0-9]{3}[ .-])[0-9]{3}[ .-][0-9]{4}|\+[1-9][0-9]{0,2}(?:[ .-]?\(?[0-9]{2,4}\)?){2,5})", r"(?<![0-9+])", r"(?![0-9])"),
    # Digits in one piece, or in the groups that cards show; a number after a blank is no part of a card in one piece.
    ("card", r"(?:[0-9]{13,19}|[0-9]{4}(?: [0-9]{4}){3}(?: [0-9]{3})?|[0-9]{4}(?:-[0-9]{4}){3}(?:-[0-9]{3})?|[0-9]{4}[ -][0-9]{6}[ -][0-9]{5})", r"(?<![A-Za-z0-9])", r"(?![A-Za-z0-9])"),
)
DATE_LAYOUTS = ("yyyy-MM-dd", "dd/MM/yyyy", "MM/dd/yyyy", "dd.MM.yyyy", "MM.dd.yyyy")


def _quoted(text: str) -> str:
    return "r'" + text + "'" if "'" not in text else "'" + text.replace("\\", "\\\\").replace("'", "\\'") + "'"


def _pattern() -> str:
    """One pattern for all kinds. The date's back reference becomes two alternatives, as groups shift in a longer pattern."""
    date = r"(?:[0-9]{4}-[0-9]{2}-[0-9]{2}|[0-9]{1,2}/[0-9]{1,2}/[0-9]{4}|[0-9]{1,2}\.[0-9]{1,2}\.[0-9]{4})"
    return "|".join(f"(?:{before}{date if name == 'date' else body}{after})" for name, body, before, after in KINDS)


def _is(value: str, kind: str) -> str:
    return f"{value} RLIKE {_quoted('^(?:' + dict((k[0], k[1]) for k in KINDS)[kind] + ')$')}"


def let(value: str, name: str, body: str) -> str:
    """SQL that computes ``value`` once and names it in ``body``."""
    return f"element_at(transform(array({value}), {name} -> {body}), 1)"


def scramble_sql(value: str, key: int, alphabets: tuple[str, ...] = (LOWER, UPPER, DIGITS), rounds: int = 6) -> str:
    """SQL for a keyed permutation of strings that keeps every character's alphabet: a Feistel network over the two halves.

    A round shifts each character of one half, within its alphabet, by a hash of its place and of the other half's hash, which is
    taken once a round: work grows with the value's length. Characters of no alphabet stay.
    """

    def shifted(half: str, other: str) -> str:
        shift = f"xxhash64({key}L, i, p, h)"
        cases = " ".join(f"WHEN instr('{a}', c) > 0 THEN substr('{a}', CAST(pmod(instr('{a}', c) - 1 + pmod({shift}, {len(a)}L), {len(a)}L) AS INT) + 1, 1)" for a in alphabets)
        moved = let(f"xxhash64({key}L, i, {other})", "h", f"array_join(transform(split({half}, ''), (c, p) -> CASE {cases} ELSE c END), '')")
        return f"CASE WHEN {half} = '' THEN '' ELSE {moved} END"

    return (
        f"aggregate(sequence(0, {rounds - 1}), named_struct('l', substr({value}, 1, CAST(length({value}) div 2 AS INT)), 'r', substr({value}, CAST(length({value}) div 2 AS INT) + 1)), "
        f"(s, i) -> CASE WHEN i % 2 = 0 THEN named_struct('l', {shifted('s.l', 's.r')}, 'r', s.r) ELSE named_struct('l', s.l, 'r', {shifted('s.r', 's.l')}) END, s -> concat(s.l, s.r))"
    )


def _digits(value: str) -> str:
    return f"regexp_replace({value}, '[^0-9]', '')"


def _refilled(value: str, filling: str, kept: str = "[^A-Za-z0-9]") -> str:
    """``value`` with its letters and digits replaced in turn by the characters of ``filling``, separators kept."""
    seen = f"length(regexp_replace(substr({value}, 1, q), '{kept}', ''))"
    return f"array_join(transform(sequence(1, length({value})), q -> CASE WHEN substr({value}, q, 1) RLIKE '{kept}' THEN substr({value}, q, 1) ELSE substr({filling}, {seen}, 1) END), '')"


def _luhn(digits: str) -> str:
    """The Luhn sum of a string of digits, whose last digit counts once."""
    d = f"CAST(substr({digits}, length({digits}) - k, 1) AS INT)"
    return f"aggregate(sequence(0, length({digits}) - 1), 0, (t, k) -> t + CASE WHEN k % 2 = 0 THEN {d} WHEN {d} > 4 THEN 2 * {d} - 9 ELSE 2 * {d} END)"


def _mod97(account: str) -> str:
    """The remainder of an account in digits and capitals, read as a number with A as 10 and so on."""
    c = f"substr({account}, k, 1)"
    return (
        f"aggregate(sequence(1, length({account})), 0, (t, k) -> CASE WHEN {c} BETWEEN '0' AND '9' THEN (t * 10 + CAST({c} AS INT)) % 97 ELSE (t * 100 + ascii({c}) - 55) % 97 END)"
    )


def _card(m: str, key: int) -> str:
    payload = f"concat(substr(d, 1, 1), {scramble_sql('substr(d, 2, length(d) - 2)', key, (DIGITS,))})"
    checked = let(payload, "n", f"concat(n, CAST((10 - {_luhn('''concat(n, '0')''')} % 10) % 10 AS STRING))")
    return let(_digits(m), "d", f"CASE WHEN {_luhn('d')} % 10 = 0 THEN {let(checked, 'f', _refilled(m, 'f', '[^0-9]'))} END")


def _iban(m: str, key: int) -> str:
    compact = f"replace({m}, ' ', '')"
    tail = let(scramble_sql("substr(c, 5)", key, (UPPER, DIGITS)), "b", f"concat(substr(c, 1, 2), lpad(CAST(98 - {_mod97('''concat(b, substr(c, 1, 2), '00')''')} AS STRING), 2, '0'), b)")
    return let(compact, "c", f"CASE WHEN {_mod97('concat(substr(c, 5), substr(c, 1, 4))')} = 1 THEN {let(tail, 'f', _refilled(m, 'f'))} END")


def _ip(m: str, key: int) -> str:
    number = let(f"transform(split({m}, '[.]'), o -> CAST(o AS BIGINT))", "a", "CASE WHEN forall(a, o -> o < 256) THEN ((a[0] * 256 + a[1]) * 256 + a[2]) * 256 + a[3] END")
    octets = "concat_ws('.', x div 16777216L, (x div 65536L) % 256, (x div 256L) % 256, x % 256)"
    return let(number, "n", f"CASE WHEN n IS NOT NULL THEN {let(feistel_sql('n', 65_536, 65_536, key), 'x', octets)} END")


def _ssn(m: str, key: int) -> str:
    """Areas 001 to 899 without 666, groups 01 to 99, serials 0001 to 9999."""
    d = _digits(m)
    area, group, serial = (f"CAST(substr(d, {a}, {n}) AS BIGINT)" for a, n in ((1, 3), (4, 2), (6, 4)))
    number = f"(({area} - 1 - CAST({area} > 666 AS INT)) * 99 + {group} - 1) * 9999 + {serial} - 1"
    back = let("x div 989901L", "r", "concat(lpad(CAST(r + 1 + CAST(r >= 665 AS INT) AS STRING), 3, '0'), '-', lpad(CAST((x div 9999L) % 99 + 1 AS STRING), 2, '0'), '-', lpad(CAST(x % 9999L + 1 AS STRING), 4, '0'))")
    valid = f"{area} BETWEEN 1 AND 899 AND {area} <> 666 AND {group} > 0 AND {serial} > 0"
    return let(d, "d", f"CASE WHEN {valid} THEN {let(feistel_sql(number, 898 * 99, 9_999, key), 'x', back)} END")


def _phone(m: str, key: int) -> str:
    """North American numbers keep area codes and exchanges from 200 on; of other numbers the first two digits stay."""
    national = "substr(d, length(d) - 9)"
    area, exchange, line = (f"CAST(substr({national}, {a}, {n}) AS BIGINT)" for a, n in ((1, 3), (4, 3), (7, 4)))
    number = f"(({area} - 200) * 800 + {exchange} - 200) * 10000 + {line}"
    back = "concat(substr(d, 1, length(d) - 10), CAST(x div 8000000L + 200 AS STRING), CAST((x div 10000L) % 800 + 200 AS STRING), lpad(CAST(x % 10000L AS STRING), 4, '0'))"
    american = f"(length(d) = 10 OR length(d) = 11 AND d LIKE '1%') AND {area} >= 200 AND {exchange} >= 200"
    other = f"concat(substr(d, 1, 2), {scramble_sql('substr(d, 3)', key, (DIGITS,))})"
    new = f"CASE WHEN {american} THEN {let(feistel_sql(number, 80_000, 80_000, key), 'x', back)} ELSE {other} END"
    return let(_digits(m), "d", let(new, "f", _refilled(m, "f", "[^0-9]")))


def _date(m: str, key: int) -> str:
    """A day is permuted within its hundred years, counted from 1930: 36,525 = 75 * 487 or 36,524 = 92 * 397 days. Years before 30 stay."""
    layout = f"CASE WHEN {m} LIKE '____-__-__' THEN 'yyyy-MM-dd' WHEN instr({m}, '/') > 0 THEN 'dd/MM/yyyy' ELSE 'dd.MM.yyyy' END"
    month_first = f"instr({m}, '-') = 0 AND CAST(element_at(split({m}, '[/.]'), 2) AS INT) > 12"
    parts = let(f"split({m}, '[-/.]')", "a", f"CASE WHEN length(a[0]) = 4 THEN array(a[0], a[1], a[2]) WHEN {month_first} THEN array(a[2], a[0], a[1]) ELSE array(a[2], a[1], a[0]) END")
    day = let(parts, "b", "try_to_date(concat_ws('-', b[0], lpad(b[1], 2, '0'), lpad(b[2], 2, '0')), 'yyyy-MM-dd')")
    number = "CAST(datediff(t, w) AS BIGINT)"
    moved = f"date_add(w, CAST(CASE WHEN datediff(add_months(w, 1200), w) = 36525 THEN {feistel_sql(number, 75, 487, key)} ELSE {feistel_sql(number, 92, 397, key)} END AS INT))"
    start = "make_date(CAST(1930 + 100 * floor((year(t) - 1930) / 100) AS INT), 1, 1)"
    shown = f"CASE WHEN {month_first} THEN concat_ws(substr(z, 3, 1), date_format(n, 'MM'), date_format(n, 'dd'), date_format(n, 'yyyy')) ELSE date_format(n, z) END"
    return let(day, "t", f"CASE WHEN t IS NOT NULL AND year(t) >= 30 THEN {let(start, 'w', let(moved, 'n', let(layout, 'z', shown)))} END")


def pseudonym_sql(m: str, key: int) -> str:
    """SQL for the pseudonym of a value found by the pattern; null where the checks don't confirm it."""
    hexadecimal = f"{m} RLIKE '^[0-9a-f]+$'"
    return " ".join((
        "CASE",
        f"WHEN {_is(m, 'email')} THEN concat({scramble_sql(f'substring_index({m}, {chr(39)}@{chr(39)}, 1)', key)}, '@', substring_index({m}, '@', -1))",
        f"WHEN {_is(m, 'key')} THEN concat(substr({m}, 1, 4), {scramble_sql(f'substr({m}, 5)', key, (UPPER, DIGITS))})",
        f"WHEN {_is(m, 'ip')} THEN {_ip(m, key)}",
        f"WHEN {_is(m, 'date')} THEN {_date(m, key)}",
        f"WHEN {_is(m, 'ssn')} THEN {_ssn(m, key)}",
        f"WHEN {_is(m, 'iban')} AND {_iban(m, key)} IS NOT NULL THEN {_iban(m, key)}",
        f"WHEN {_is(m, 'phone')} THEN {_phone(m, key)}",
        f"WHEN {_is(m, 'card')} THEN {_card(m, key)}",
        f"WHEN {hexadecimal} AND length({m}) >= 8 AND {m} RLIKE '[a-f]' THEN {scramble_sql(m, key, (HEX,))}",
        f"WHEN {_is(m, 'secret')} AND {m} RLIKE '[A-Za-z]' THEN {scramble_sql(m, key)}",
        "END",
    ))


def pseudonymised(docs: DataFrame, text: str = "text", key: int = 8_675_309, count: str | None = None) -> DataFrame:
    """``docs`` with the personal data in ``text`` replaced, and the number of replaced values in ``count`` if that is named.

    Text between the values is kept to the byte. Null stays null (and counts 0), empty stays empty; other columns are kept. Values that fail
    their check (a card number without a valid last digit, an octet above 255, a 30 February) stay as they are. The key is a
    parameter: the same key links values across tables, and who does not know it can't undo them.
    """
    pattern = _quoted(_pattern().replace("'", "\\'"))
    values, parts, names = (free_name(docs, stem) for stem in ("_values", "_parts", "_names"))
    found = docs.withColumn(values, F.expr(f"regexp_extract_all(`{text}`, {pattern}, 0)")).withColumn(parts, F.expr(f"split(`{text}`, {pattern}, -1)"))
    named = found.withColumn(names, F.expr(f"transform(`{values}`, m -> {pseudonym_sql('m', key)})"))
    filled = named.withColumn(values, F.expr(f"zip_with(`{names}`, `{values}`, (a, b) -> coalesce(a, b))"))
    joined = f"array_join(zip_with(`{parts}`, `{values}`, (a, b) -> concat(a, coalesce(b, ''))), '')"
    out = filled.withColumn(text, F.expr(joined))
    if count:
        out = out.withColumn(count, F.coalesce(F.size(F.filter(names, lambda v: v.isNotNull())), F.lit(0)))
    return out.select(*dict.fromkeys([*docs.columns, *([count] if count else [])]))
