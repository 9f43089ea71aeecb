"""Personal data replaced by format-preserving pseudonyms, with DataFrame functions only.

E-mail addresses, telephone numbers, payment cards, IPv4 addresses, US social security numbers and dates are found by one
expression, validated (Luhn digit, octet range, calendar, numbering rules) and replaced by a keyed permutation of their
format: a Feistel network over two factors of the format's domain. It is a bijection, so equal values get equal
pseudonyms in all documents and different values different ones, and a pseudonym validates as its value did.

    card    the digits before the check digit are permuted, the check digit is computed anew; separators stay
    phone   area code, exchange and line are permuted among numbers that the numbering plan allows (area and exchange of
            200 or more), and among those that it doesn't; country code and punctuation stay
    ipv4    the 32 bits are permuted
    ssn     the valid numbers (area 001-899 but 666, group 01-99, serial 0001-9999) are permuted
    date    the days of 1900-2099 are permuted; YYYY-MM-DD and DD/MM/YYYY keep their form
    email   runs of letters and digits are permuted, in lower case; punctuation and the last label of the domain stay

The key is the caller's: configured_key() reads it from the session, and makes one up for an application that sets none,
whose pseudonyms then can't be linked with another run's. Values that don't validate stay as they are. Null texts stay null and empty ones empty; a text is handled whole. Repeated
rows give repeated results. Other columns are kept; columns named like a result are replaced.
"""

from __future__ import annotations

import secrets

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from siteweave.llm.common import table

#: Setting of the session that holds the key.
KEY = "spark.siteweave.pii.key"
ROUNDS = 8
KINDS = ("email", "phone", "card", "ipv4", "ssn", "date")

# Possessive repeats and look-behinds keep the scan linear in the text. The labels of a domain (at most 127) are given back one
# by one, as the last may be followed by the full stop of a sentence.
_EMAIL = r"(?<![A-Za-z0-9._%+-])[A-Za-z0-9][A-Za-z0-9._%+-]{0,63}+@[A-Za-z0-9](?:[A-Za-z0-9-]{0,62}+\.){1,126}[A-Za-z]{2,24}(?![A-Za-z0-9])"
_PHONE = r"(?<![\d+])(?:\+?1[ .-]?)?(?:\(\d{3}\) ?|\d{3}[ .-])\d{3}[ .-]\d{4}(?!\d)"
_CARD = r"(?<![\d.])(?:\d{13,19}|\d{4}([ -])\d{4}\1\d{4}\1\d{4}|\d{4}([ -])\d{6}\2\d{5})(?!\d)"
_IPV4 = r"(?<![\d.])\d{1,3}\.\d{1,3}\.\d{1,3}\.\d{1,3}(?!\d|\.\d)"
_SSN = r"(?<![\d-])\d{3}-\d{2}-\d{4}(?![\d-])"
_DATE = r"(?<![\d/-])(?:(?:19|20)\d\d-\d\d-\d\d|\d\d/\d\d/(?:19|20)\d\d)(?![\d/-])"
PATTERN = "|".join((_EMAIL, _SSN, _DATE, _PHONE, _IPV4, _CARD))
#: Texts without this hold no value.
_ANY = r"@[0-9A-Za-z]|\d[ )./-]{0,2}\d"


def permute(l: Column, r: Column, a: Column | int, b: Column | int, tweak: Column, key: str) -> Column:
    """A keyed permutation of the pairs 0 <= l < a, 0 <= r < b, as a struct of l and r: a Feistel network in which the
    halves take turns in adding a keyed hash of the other."""
    a, b = (v if isinstance(v, Column) else F.lit(v).cast("long") for v in (a, b))

    def noise(turn: Column, half: Column) -> Column:
        digest = F.sha2(F.concat_ws("|", F.lit(key), tweak, turn.cast("string"), half.cast("string")), 256)
        return F.conv(F.substring(digest, 1, 15), 16, 10).cast("long")

    def step(s: Column, turn: Column) -> Column:
        left = F.when(turn % 2 == 0, (s["l"] + noise(turn, s["r"]) % a) % a).otherwise(s["l"])
        right = F.when(turn % 2 == 1, (s["r"] + noise(turn, s["l"]) % b) % b).otherwise(s["r"])
        return F.struct(left.alias("l"), right.alias("r"))

    start = F.struct(l.cast("long").alias("l"), r.cast("long").alias("r"))
    return F.aggregate(F.sequence(F.lit(0), F.lit(ROUNDS - 1)), start, step)


def _digits(v: Column) -> Column:
    return F.regexp_replace(v, r"\D", "")


def _power(base: int, n: Column) -> Column:
    return F.pow(F.lit(float(base)), n).cast("long")


def _number(s: Column) -> Column:
    """The number that a string of digits writes; 0 for the empty string."""
    return F.coalesce(F.try_to_number(s, F.lit("9" * 18)).cast("long"), F.lit(0).cast("long"))


def _pad(n: Column, width: Column | int) -> Column:
    return F.lpad(n.cast("string"), width, "0")


def _luhn(digits: Column) -> Column:
    """The Luhn sum of digits that a check digit is yet to follow."""
    each = F.transform(F.split(F.reverse(digits), "(?!^)(?!$)"), lambda c, k: F.when(k % 2 == 0, 2 * c.cast("int") - F.when(c.cast("int") > 4, 9).otherwise(0)).otherwise(c.cast("int")))
    return F.aggregate(each, F.lit(0), lambda s, x: s + x)


def _card(v: Column, key: str) -> Column:
    digits = _digits(v)
    body, check = F.substring(digits, F.lit(1), F.length(digits) - 1), F.substring(digits, -1, 1)
    n = F.length(body)
    left = F.floor(n / 2).cast("int")
    out = permute(_number(F.substring(body, F.lit(1), left)), _number(F.substring(body, left + 1, n)), _power(10, left), _power(10, n - left), F.concat(F.lit("card"), n.cast("string")), key)
    new = F.transform(F.array(out), lambda o: F.concat(_pad(o["l"], left), _pad(o["r"], n - left)))
    full = F.get(F.transform(new, lambda d: F.concat(d, F.pmod(-_luhn(d), F.lit(10)).cast("string"))), F.lit(0))
    sep = F.substring(v, 5, 1)
    shaped = (
        F.when(v.rlike(r"^\d+$"), full)
        .when(n == 14, F.concat(F.substring(full, 1, 4), sep, F.substring(full, 5, 6), sep, F.substring(full, 11, 5)))
        .otherwise(F.concat(F.substring(full, 1, 4), sep, F.substring(full, 5, 4), sep, F.substring(full, 9, 4), sep, F.substring(full, 13, 4)))
    )
    return F.when(F.pmod(-_luhn(body), F.lit(10)) == check.cast("int"), shaped)


def _phone(v: Column, key: str) -> Column:
    shape = r"^(\D*(?:1\D+)?)(\d{3})(\D{0,2})(\d{3})(\D)(\d{4})$"
    part = lambda k: F.regexp_extract(v, shape, k)
    area, exchange = part(2).cast("long"), part(4).cast("long")
    # Numbers of the plan have no area or exchange below 200; those that do stay among their like.
    first = lambda code: F.when(code < 200, 0).otherwise(200).cast("long")
    many = lambda code: F.when(code < 200, 200).otherwise(800).cast("long")
    tweak = F.concat(F.lit("phone"), (area < 200).cast("string"), (exchange < 200).cast("string"))
    out = permute(area - first(area), (exchange - first(exchange)) * 10_000 + part(6).cast("long"), many(area), many(exchange) * 10_000, tweak, key)
    code = lambda n, old: _pad(n + first(old), 3)
    build = lambda s: F.concat(part(1), code(s["l"], area), part(3), code(F.floor(s["r"] / 10_000).cast("long"), exchange), part(5), _pad(s["r"] % 10_000, 4))
    return F.get(F.transform(F.array(out), build), F.lit(0))


def _ipv4(v: Column, key: str) -> Column:
    octets = F.transform(F.split(v, r"\."), lambda o: o.cast("long"))
    valid = F.forall(F.split(v, r"\."), lambda o: (o.cast("int") <= 255) & ~o.rlike("^0\\d"))
    o = lambda k: F.get(octets, F.lit(k))
    out = permute(o(0) * 256 + o(1), o(2) * 256 + o(3), 1 << 16, 1 << 16, F.lit("ipv4"), key)
    half = lambda h: F.concat(F.shiftright(h, 8).cast("string"), F.lit("."), (h % 256).cast("string"))
    return F.when(valid, F.get(F.transform(F.array(out), lambda s: F.concat(half(s["l"]), F.lit("."), half(s["r"]))), F.lit(0)))


def _ssn(v: Column, key: str) -> Column:
    area, group, serial = (F.substring(v, a, n).cast("long") for a, n in ((1, 3), (5, 2), (8, 4)))
    valid = (area > 0) & (area != 666) & (area < 900) & (group > 0) & (serial > 0)
    rank = area - F.when(area > 666, 2).otherwise(1)
    out = permute(rank * 99 + group - 1, serial - 1, 898 * 99, 9_999, F.lit("ssn"), key)

    def build(s: Column) -> Column:
        rank = F.floor(s["l"] / 99).cast("long")
        return F.concat(_pad(rank + F.when(rank >= 665, 2).otherwise(1), 3), F.lit("-"), _pad(s["l"] % 99 + 1, 2), F.lit("-"), _pad(s["r"] + 1, 4))

    return F.when(valid, F.get(F.transform(F.array(out), build), F.lit(0)))


#: 1900-01-01 to 2099-12-31 are 73,049 days, 319 times 229.
_DAYS = (319, 229)


def _date(v: Column, key: str) -> Column:
    iso = v.contains("-")
    text = F.when(iso, v).otherwise(F.concat_ws("-", F.substring(v, 7, 4), F.substring(v, 4, 2), F.substring(v, 1, 2)))
    first = F.lit("1900-01-01").cast("date")
    day = F.datediff(text.try_cast("date"), first)
    out = permute(F.floor(day / _DAYS[1]), day % _DAYS[1], *_DAYS, F.lit("date"), key)
    build = lambda s: F.date_add(first, (s["l"] * _DAYS[1] + s["r"]).cast("int"))
    new = F.get(F.transform(F.transform(F.array(out), build), lambda d: F.when(iso, F.date_format(d, "yyyy-MM-dd")).otherwise(F.date_format(d, "dd/MM/yyyy"))), F.lit(0))
    return F.when(day.isNotNull(), new)


def _email(v: Column, key: str) -> Column:
    last = F.substring_index(v, ".", -1)
    runs = F.regexp_extract_all(F.lower(F.substring(v, F.lit(1), F.length(v) - F.length(last) - 1)), F.lit("[a-z0-9]{1,10}|[^a-z0-9]+"), F.lit(0))

    def run(s: Column, k: Column) -> Column:
        n = F.length(s)
        left = F.floor(n / 2).cast("int")
        base36 = lambda x: F.coalesce(F.conv(x, 36, 10).cast("long"), F.lit(0).cast("long"))
        out = permute(base36(F.substring(s, F.lit(1), left)), base36(F.substring(s, left + 1, n)), _power(36, left), _power(36, n - left), F.concat_ws(":", F.lit("email"), n.cast("string"), k.cast("string")), key)
        write = lambda x, w: F.lpad(F.lower(F.conv(x.cast("string"), 10, 36)), w, "0")
        new = F.get(F.transform(F.array(out), lambda o: F.concat(write(o["l"], left), write(o["r"], n - left))), F.lit(0))
        return F.when(s.rlike("^[a-z0-9]"), new).otherwise(s)

    return F.concat(F.array_join(F.transform(runs, run), ""), F.lit("."), last)


def _replaced(v: Column, key: str) -> Column:
    """Kind and pseudonym of a match; a null pseudonym where it doesn't validate."""
    tests = {"email": v.contains("@"), "ssn": v.rlike(r"^\d{3}-\d{2}-\d{4}$"), "date": v.rlike(r"^(\d{4}-\d\d-\d\d|\d\d/\d\d/\d{4})$"), "ipv4": v.rlike(r"^\d+\.\d+\.\d+\.\d+$"), "card": F.length(_digits(v)) > 11}
    makers = {"email": _email, "ssn": _ssn, "date": _date, "ipv4": _ipv4, "card": _card}
    out = None
    for kind, test in tests.items():
        value = F.struct(F.lit(kind).alias("kind"), makers[kind](v, key).alias("new"))
        out = F.when(test, value) if out is None else out.when(test, value)
    return out.otherwise(F.struct(F.lit("phone").alias("kind"), _phone(v, key).alias("new")))


_made_up: dict[str, str] = {}


def configured_key(spark: SparkSession) -> str:
    """The session's key, or one for this application alone."""
    return spark.conf.get(KEY, None) or _made_up.setdefault(spark.sparkContext.applicationId, secrets.token_hex(32))


def _unused(df: DataFrame, name: str) -> str:
    """A column name that df does not have."""
    while name in df.columns:
        name += "_"
    return name


def pseudonymise(df: DataFrame, key: str, text: str = "text") -> DataFrame:
    """df with its text pseudonymised under a key, and n_<kind>, the number of values replaced, for each kind."""
    col = F.col(text)
    counts = [f"n_{k}" for k in KINDS]
    keep = [c for c in df.columns if c not in counts]
    own_found, own_new = (_unused(df, name) for name in ("pii_found", "pii_new"))
    found = F.when(col.rlike(_ANY), F.regexp_extract_all(col, F.lit(PATTERN), F.lit(0))).otherwise(F.array().cast("array<string>"))
    marked = df.select(*keep, found.alias(own_found))
    made = marked.withColumn(own_new, F.transform(own_found, lambda v: _replaced(v, key)))
    between = F.split(col, PATTERN, -1)
    parts = F.zip_with(between, F.transform(F.arrays_zip(own_found, own_new), lambda x: F.coalesce(x[own_new]["new"], x[own_found])), lambda a, b: F.concat(a, F.coalesce(b, F.lit(""))))
    new = F.when(F.size(own_found) > 0, F.array_join(parts, "")).otherwise(col)
    number = lambda kind: F.size(F.filter(own_new, lambda x: (x["kind"] == kind) & x["new"].isNotNull())).cast("long")
    return made.select(*(new.alias(c) if c == text else F.col(c) for c in keep), *(number(k).alias(c) for k, c in zip(KINDS, counts, strict=True)))


def op9_pii_pseudonyms(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pseudonymise(table(spark, sf_dir, "documents").select("doc_id", "text"), configured_key(spark))
