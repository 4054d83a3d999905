"""Format-preserving Feistel pseudonyms, in DataFrame operations only.

Validated numbers (IPv4 addresses, payment cards, IBANs, phone numbers, social
security numbers) and dates are permuted within their format by keyed Feistel
rounds, so equal values get equal pseudonyms in all documents, different values
different ones, and check digits stay valid.  E-mail addresses, hexadecimal secrets,
cloud access keys and the values of password assignments, which are not numbers of a
bounded format, get keyed hashes in their form.
All forms of a value are one value: the blanks of an IBAN, the groups of a phone number
and the order of a date are left as they are, and what is permuted doesn't depend on them.
Numbers that fail validation stay.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

ROUNDS = 8
#: Countries by the length of their IBANs.
IBAN_LENGTHS = {
    15: "NO", 16: "BE", 18: "DK FI FK FO GL NL SD", 19: "MK SI", 20: "AT BA EE KZ LT LU MN XK", 21: "CH HR LI LV",
    22: "BG BH CR DE GB GE IE ME RS VA", 23: "AE GI IL IQ OM SO TL", 24: "AD CZ ES MD PK RO SA SE SK TN VG", 25: "AO CV GW LY PT ST",
    26: "DZ IR IS TR", 27: "BI CF CG CM DJ FR GA GQ GR IT KM MC MG MR SM TD", 28: "AL AZ BF BJ BY CI CY DO GT HN HU LB MA ML NE NI PL SN SV TG",
    29: "BR EG PS QA UA", 30: "JO KW MU YE", 31: "MT SC", 32: "LC", 33: "RU",
}
_IBAN_START = "(?:" + "|".join(" ".join(IBAN_LENGTHS.values()).split()) + ")[0-9]{2}"


def _iban_pattern() -> str:
    """A match ends with the IBAN, as its country fixes the length: words that follow aren't part of it.

    Any other text of the form is a match too (its check digits decide), unless an IBAN of a country starts in it.
    """
    exact = "|".join(
        f"(?:{c.replace(' ', '|')})[0-9]{{2}}(?: ?[A-Z0-9]{{4}}){{{n // 4 - 1}}}" + (f" ?[A-Z0-9]{{{n % 4}}}" if n % 4 else "")
        for n, c in IBAN_LENGTHS.items())
    group = f"(?! {_IBAN_START}(?: ?[A-Z0-9]{{4}}){{2}}) ?[A-Z0-9]"
    other = rf"[A-Z]{{2}}[0-9]{{2}}(?:{group}{{4}}){{2,7}}(?:{group}{{1,3}})?"
    end = r"(?![\p{L}\p{N}])"
    return rf"(?<![\p{{L}}\p{{N}}])(?=[A-Z]{{2}}[0-9]{{2}})(?:(?:{exact}){end}|{other}{end})"


#: Fixed patterns, in order of precedence at one place.
PATTERNS = {
    # starts where a run of its characters does, or where the match before ended
    # a host has 127 labels at most, which also bounds how deep the group recurs; an ending in Latin letters comes first, as scripts
    # without blanks may go on behind it
    "email": r"(?:\G|(?<![\p{L}\p{N}._%+-]))[\p{L}\p{N}._%+-]++@[\p{L}\p{N}-]+(?:\.[\p{L}\p{N}-]+){0,125}\.(?:[A-Za-z]{2,}|\p{L}{2,})",
    "secret": r"(?<![\p{L}\p{N}])(?:[0-9a-f]{32,64}|[0-9A-F]{32,64})(?![\p{L}\p{N}])",
    "access_key": r"(?<![\p{L}\p{N}])(?:AKIA|ASIA)[A-Z0-9]{16}(?![\p{L}\p{N}])",
    "password": r"(?<![\p{L}\p{N}])(?:[Pp]assword|PASSWORD|[Pp]asswd|[Pp]assphrase|pwd)[=:][\"']?[^\s\"'<>,;&]{3,}[^\s\"'<>,;&.:!?)]",
    "iban": _iban_pattern(),
    "ip": r"(?<![\p{N}.])(?:(?:25[0-5]|2[0-4][0-9]|1?[0-9]?[0-9])\.){3}(?:25[0-5]|2[0-4][0-9]|1?[0-9]?[0-9])(?![\p{N}]|\.[\p{N}])",
    "date": r"(?<![\p{N}/.-])(?:[0-9]{4}-[0-9]{2}-[0-9]{2}|[0-9]{2}/[0-9]{2}/[0-9]{4}|[0-9]{2}\.[0-9]{2}\.[0-9]{4})(?![\p{N}/-])",
    "ssn": r"(?<![\p{N}-])[0-9]{3}-[0-9]{2}-[0-9]{4}(?![\p{N}-])",
    "phone": r"\+[0-9]{1,3}[ .-]?\([0-9]{1,4}\)[ .-]?[0-9]{2,4}[ .-]?[0-9]{2,4}(?![.-]?\p{N})"
             r"|\+[0-9]{1,3}(?:[ .-][0-9]{1,8}){1,6}(?![.-]?\p{N})|\+[0-9]{8,15}(?!\p{N})"
             r"|(?<!\p{N})\([0-9]{3}\)[ .-]?[0-9]{3}[ .-][0-9]{4}(?!\p{N})|(?<![\p{N}.-])[0-9]{3}[ .-][0-9]{3}[ .-][0-9]{4}(?!\p{N})",
    "card": r"(?<![\p{N}-])(?:[0-9]{4}[ -][0-9]{4}[ -][0-9]{4}[ -][0-9]{4}|[0-9]{13,19})(?![\p{N}-])",
}
KINDS = tuple(PATTERNS)
_EITHER = lambda *kinds: "|".join(f"(?:{PATTERNS[k]})" for k in kinds)
#: All patterns in order; what several of them ask for is asked first, once, so most places fail at once.
ANY = "|".join((
    _EITHER("email"), rf"(?<![\p{{L}}\p{{N}}])(?:{_EITHER('secret', 'access_key', 'password', 'iban')})",
    f"(?=[0-9+(])(?:{_EITHER('ip', 'date', 'ssn', 'phone', 'card')})"))
#: Recent dates, 300 * 300 days from the first, are permuted among each other; all others, of the years 1 to 9999, among themselves.
RECENT, RECENT_SIDE = "1880-01-01", 300
FIRST_DAY, ALL_DAYS, ALL_SIDE = "0001-01-01", 3_652_059, 1_912
#: Steps of a walk through a permutation to the next date of the same kind; at least every third is one.
WALK = 128
#: Country codes of one and of two digits; all others have three.
COUNTRY_CODE = "^(?:[17]|2[07]|3[0-469]|4[013-9]|5[1-8]|6[0-6]|8[1246]|9[0-58]|[0-9]{3})"


def feistel(a: Column, b: Column, mod_a: Column, mod_b: Column, tweak: Column, key: str) -> tuple[Column, Column]:
    """Permutes (a, b) of [0, mod_a) x [0, mod_b); an even number of rounds keeps the sides."""
    def step(acc: Column, i: Column) -> Column:
        even = i % 2 == 0
        seen = F.concat_ws(":", F.lit(key), tweak, i, acc["b"])
        f = F.conv(F.substring(F.sha2(seen, 256), 1, 14), 16, 10).cast("bigint")
        new = F.pmod(acc["a"] + f, F.when(even, mod_a).otherwise(mod_b))
        return F.struct(acc["b"].alias("a"), new.alias("b"))

    out = F.aggregate(F.sequence(F.lit(0), F.lit(ROUNDS - 1)), F.struct(a.alias("a"), b.alias("b")), step)
    return out["a"], out["b"]


def _power(n: Column) -> Column:
    return F.rpad(F.lit("1"), n + 1, "0").cast("bigint")


def digits_permuted(digits: Column, tweak: Column, key: str) -> Column:
    """A string of 2 to 36 digits, permuted among those of its length."""
    n = F.length(digits)
    u = F.floor(n / 2).cast("int")
    v = n - u
    a, b = feistel(F.substring(digits, F.lit(1), u).cast("bigint"), F.substring(digits, u + 1, v).cast("bigint"),
                   _power(u), _power(v), F.concat_ws("/", tweak, n), key)
    return F.concat(F.lpad(a.cast("string"), u, "0"), F.lpad(b.cast("string"), v, "0"))


def only_digits(value: Column) -> Column:
    return F.regexp_replace(value, "[^0-9]", "")


def refilled(shape: Column, digits: Column) -> Column:
    """``shape`` with its digits replaced by ``digits``, in order."""
    place = lambda i: F.length(only_digits(F.substring(shape, F.lit(1), i)))
    return F.array_join(F.transform(
        F.sequence(F.lit(1), F.length(shape)),
        lambda i: F.when(F.substring(shape, i, F.lit(1)).rlike("[0-9]"), F.substring(digits, place(i), F.lit(1)))
        .otherwise(F.substring(shape, i, F.lit(1)))), "")


def mod97(value: Column) -> Column:
    """The remainder of letters (A = 10) and digits read as one number."""
    def step(acc: Column, c: Column) -> Column:
        n = F.when(c.rlike("[0-9]"), c.cast("int")).otherwise(F.ascii(c) - 55)
        return F.pmod(acc * F.when(n > 9, F.lit(100)).otherwise(F.lit(10)) + n, F.lit(97)).cast("int")

    return F.aggregate(F.filter(F.split(value, ""), lambda c: c != ""), F.lit(0), step)


def _email(v: Column, key: str) -> Column:
    code = F.sha2(F.concat_ws(":", F.lit(key), F.lit("email"), F.lower(v)), 256)
    return F.concat(F.lit("u"), F.substring(code, 1, 12), F.lit("@"), F.substring(code, 13, 6), F.lit(".example"))


def _secret(v: Column, key: str) -> Column:
    code = F.substring(F.sha2(F.concat_ws(":", F.lit(key), F.lit("secret"), F.lower(v)), 256), F.lit(1), F.length(v))
    return F.when(v.rlike("[A-F]"), F.upper(code)).otherwise(code)


def _access_key(v: Column, key: str) -> Column:
    """The prefix stays; the rest are 16 hexadecimal digits of a keyed hash, in capitals."""
    code = F.upper(F.sha2(F.concat_ws(":", F.lit(key), F.lit("access_key"), v), 256))
    return F.concat(F.substring(v, 1, 4), F.substring(code, 1, 16))


def _password(v: Column, key: str) -> Column:
    """The name and the quote stay; the value becomes a keyed hash of its length, 64 digits at most."""
    name = F.regexp_extract(v, "^[^=:]*[=:][\"']?", 0)
    value = F.substring(v, F.length(name) + 1, F.length(v))
    code = F.sha2(F.concat_ws(":", F.lit(key), F.lit("password"), value), 256)
    return F.concat(name, F.substring(code, F.lit(1), F.length(value)))


def _ip(v: Column, key: str) -> Column:
    o = lambda i: F.split_part(v, F.lit("."), F.lit(i)).cast("bigint")
    a, b = feistel(o(1) * 256 + o(2), o(3) * 256 + o(4), F.lit(65536), F.lit(65536), F.lit("ip"), key)
    byte = lambda x: (F.floor(x / 256).cast("string"), F.pmod(x, F.lit(256)).cast("string"))
    return F.concat_ws(".", *byte(a), *byte(b))


def _month_first(v: Column) -> Column:
    """Dates with slashes count as day/month; as month/day where they can't: the day is above 12."""
    return v.contains("/") & F.try_to_date(v, "dd/MM/yyyy").isNull()


def _days(v: Column) -> Column:
    """The date's number from the first day of year 1; null if there is no such date."""
    day = F.coalesce(*[F.try_to_date(v, f) for f in ("yyyy-MM-dd", "dd/MM/yyyy", "dd.MM.yyyy", "MM/dd/yyyy")])
    return F.datediff(day, F.lit(FIRST_DAY).cast("date"))


def _valid_date(v: Column) -> Column:
    return _days(v).between(0, ALL_DAYS - 1)


def _date(v: Column, key: str) -> Column:
    """The date's place in a permutation of the dates of its kind, in the form of ``v``.

    A kind is recent or not, with a day of the month above 12 or not: so a month/day is read as one
    again, and a date has one pseudonym in all forms.  The permutation of all days is walked until
    it comes to a date of the kind.
    """
    first = F.lit(FIRST_DAY).cast("date")
    start = F.datediff(F.lit(RECENT).cast("date"), first).cast("bigint")
    late = lambda n: F.day(F.date_add(first, n.cast("int"))) > 12
    recent = lambda n: n.between(start, start + RECENT_SIDE**2 - 1)
    n = _days(v).cast("bigint")

    def place(n: Column, side: int, name: str) -> Column:
        a, b = feistel(F.floor(n / side).cast("bigint"), F.pmod(n, F.lit(side)).cast("bigint"), F.lit(side), F.lit(side), F.lit(name), key)
        return a * side + b

    def walked(step, there) -> Column:
        return F.aggregate(F.sequence(F.lit(1), F.lit(WALK)), step(n), lambda at, _: F.when(there(at), at).otherwise(step(at)))

    new = F.when(recent(n), walked(
        lambda n: place(n - start, RECENT_SIDE, "date") + start, lambda at: late(at) == late(n))
    ).otherwise(walked(
        lambda n: place(n, ALL_SIDE, "other date"), lambda at: (at < ALL_DAYS) & ~recent(at) & (late(at) == late(n))))
    day = F.date_add(first, new.cast("int"))
    return (
        F.when(v.contains("-"), F.date_format(day, "yyyy-MM-dd")).when(v.contains("."), F.date_format(day, "dd.MM.yyyy"))
        .when(_month_first(v), F.date_format(day, "MM/dd/yyyy")).otherwise(F.date_format(day, "dd/MM/yyyy")))


def _ssn_parts(v: Column) -> tuple[Column, Column, Column]:
    return tuple(F.split_part(v, F.lit("-"), F.lit(i)).cast("bigint") for i in (1, 2, 3))


def _valid_ssn(v: Column) -> Column:
    """Areas 001 to 899 but 666, and no group or serial of zeros, are given out."""
    area, group, serial = _ssn_parts(v)
    return area.between(1, 899) & (area != 666) & (group > 0) & (serial > 0)


def _ssn(v: Column, key: str) -> Column:
    area, group, serial = _ssn_parts(v)
    a, b = feistel(area - F.when(area > 666, F.lit(2)).otherwise(F.lit(1)), (group - 1) * 9999 + serial - 1,
                   F.lit(898), F.lit(99 * 9999), F.lit("ssn"), key)
    area = a + F.when(a >= 665, F.lit(2)).otherwise(F.lit(1))
    pad = lambda x, n: F.lpad(x.cast("bigint").cast("string"), n, "0")
    return F.concat_ws("-", pad(area, 3), pad(F.floor(b / 9999) + 1, 2), pad(F.pmod(b, F.lit(9999)) + 1, 4))


def _phone(v: Column, key: str) -> Column:
    """The country code stays, whatever the groups; numbers without one are of the form that country 1 has."""
    digits = only_digits(v)
    code = F.when(v.startswith("+"), F.regexp_extract(digits, COUNTRY_CODE, 0)).otherwise("")
    rest = F.substring(digits, F.length(code) + 1, F.length(digits))
    tweak = F.concat(F.lit("phone"), F.when(code == "", "1").otherwise(code))
    return refilled(v, F.concat(code, digits_permuted(rest, tweak, key)))


def _card(v: Column, key: str) -> Column:
    d = only_digits(v)
    body = digits_permuted(F.substring(d, F.lit(1), F.length(d) - 1), F.lit("card"), key)
    check = F.filter(F.sequence(F.lit(0), F.lit(9)), lambda c: F.call_function("luhn_check", F.concat(body, c.cast("string"))))
    return refilled(v, F.concat(body, F.get(check, F.lit(0)).cast("string")))


def _iban(v: Column, key: str) -> Column:
    tail = F.substring(v, F.lit(5), F.length(v))
    form = F.regexp_replace(F.replace(tail, F.lit(" "), F.lit("")), "[0-9]", "#")
    new = F.when(F.length(only_digits(tail)) >= 2, refilled(
        tail, digits_permuted(only_digits(tail), F.concat(F.lit("iban"), form), key))).otherwise(tail)
    country = F.substring(v, 1, 2)
    check = 98 - mod97(F.concat(F.replace(new, F.lit(" "), F.lit("")), country, F.lit("00")))
    return F.concat(country, F.lpad(check.cast("string"), 2, "0"), new)


def kind_of(v: Column) -> Column:
    """The kind of a match that passes its validation; null otherwise."""
    whole = {k: v.rlike(f"^(?:{p})$") for k, p in PATTERNS.items()}
    bare = F.replace(v, F.lit(" "), F.lit(""))
    valid = {
        "iban": mod97(F.concat(F.substring(bare, F.lit(5), F.length(bare)), F.substring(bare, 1, 4))) == 1,
        "date": _valid_date(v),
        "ssn": _valid_ssn(v),
        "phone": F.length(only_digits(v)).between(7, 15),
        "card": F.call_function("luhn_check", only_digits(v)),
    }
    out = F.when(F.lit(False), F.lit(None).cast("string"))
    for k in KINDS:
        out = out.when(whole[k] & valid[k] if k in valid else whole[k], F.lit(k))
    return out


def pseudonym(kind: Column, v: Column, key: str) -> Column:
    by_kind = {
        "email": _email, "secret": _secret, "access_key": _access_key, "password": _password, "iban": _iban, "ip": _ip,
        "date": _date, "ssn": _ssn, "phone": _phone, "card": _card}
    out = F.when(kind.isNull(), v)
    for k, f in by_kind.items():
        out = out.when(kind == k, f(v, key))
    return out


def pseudonymize(docs: DataFrame, key: str, text_col: str = "text") -> DataFrame:
    """``docs`` with its texts pseudonymised, and ``found``: (kind, pseudonym) of each value, in order.

    A null text stays null, with nothing found; an empty one stays empty.  Rows that
    repeat get the same result each, an empty table gives an empty one, and texts are
    searched whole, whatever their length: patterns are linear and don't recur more than
    127 deep.  Hosts of more labels than a host can have are no addresses.  A column named
    found is replaced.
    """
    text = F.col(f"`{text_col}`")
    rest = [c for c in docs.columns if c not in ("found", text_col)]
    # Most texts hold nothing: only others are parted, once, and their gaps are joined with the new values.
    out = docs.select(*[F.col(f"`{c}`") for c in rest], text.alias("_text"), F.regexp_extract_all(text, F.lit(ANY), F.lit(0)).alias("_values"))
    out = out.withColumn("_gaps", F.when(F.size("_values") > 0, F.split("_text", ANY)))
    out = out.withColumn("_kinds", F.transform("_values", lambda v: F.struct(v.alias("v"), kind_of(v).alias("kind"))))
    out = out.withColumn("_named", F.transform("_kinds", lambda s: F.struct(s["kind"].alias("kind"), pseudonym(s["kind"], s["v"], key).alias("v"))))
    spliced = F.concat(F.array_join(F.transform(
        F.arrays_zip(F.col("_named"), F.slice("_gaps", F.lit(1), F.size("_named")).alias("gap")),
        lambda z: F.concat(z["gap"], z["_named"]["v"])), ""), F.element_at("_gaps", -1))
    return out.select(
        *[F.col(f"`{c}`") for c in rest],
        F.when(F.size("_values") > 0, spliced).otherwise(F.col("_text")).alias(text_col),
        F.coalesce(F.filter("_named", lambda s: s["kind"].isNotNull()), F.array().cast("array<struct<kind:string,v:string>>")).alias("found"),
    )
