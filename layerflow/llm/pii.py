"""PII: format-preserving pseudonyms by a keyed Feistel network, in built-in expressions only.

Numbers and dates are found by pattern, validated (check digit, octet and
calendar ranges), split into two parts and sent through eight Feistel rounds
whose round function is SHA-256 of a key, the kind, the round and the other part.
That permutes the values of each format among themselves: a card number
becomes a card number with a right check digit, a date a date, and equal values
become equal pseudonyms in all documents, while different ones stay different.
E-mail addresses keep their domain and get a keyed local part of fixed form; hexadecimal
secrets get keyed digits of the same length and case.

kinds: email, ip, card (13-19 digits, Luhn), phone (+country code, or (ddd) ddd-dddd, or
ddd-ddd-dddd), ssn (ddd-dd-dddd in the issued ranges), date (yyyy-mm-dd, d/m/yyyy, d.m.yyyy; from
1900-01-01 for 73,000 days; month first where the day-first reading is no date), secret (32-64 hex digits).
What fails its validation is left as it is.

Defined results: a null text stays null with 0 found, an empty one empty; repeated
rows get equal results; whole texts are searched; an empty table gives an empty
result; all other columns pass through ``pseudonymise`` unchanged, whatever their
names, except that helper columns start with ``_p_`` and are dropped.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

KEY = "change-me"  # the default key; a real run passes its own secret
ROUNDS = 8
DAY_ZERO, YEARS, YEAR_DAYS = "1900-01-01", 200, 365  # 73,000 days of dates are permuted among themselves

#: kind -> pattern; earlier ones win where two begin at one place.
PATTERNS = {
    "email": r"(?<![\p{L}\p{N}_.%+\-])[\p{L}\p{N}_.%+\-]++@[A-Za-z0-9\-]++(?:\.[A-Za-z0-9\-]++)+",
    "secret": r"(?<![0-9A-Za-z])[0-9A-Fa-f]{32,64}(?![0-9A-Za-z])",
    "ip": r"(?<![0-9A-Za-z.])(?:[0-9]{1,3}\.){3}[0-9]{1,3}(?![0-9A-Za-z]|\.[0-9])",
    "date": r"(?<![0-9A-Za-z./\-])(?:[0-9]{4}-[0-9]{2}-[0-9]{2}|[0-9]{1,2}/[0-9]{1,2}/[0-9]{4}|[0-9]{1,2}\.[0-9]{1,2}\.[0-9]{4})(?![0-9A-Za-z/\-]|\.[0-9])",
    "ssn": r"(?<![0-9A-Za-z\-])[0-9]{3}-[0-9]{2}-[0-9]{4}(?![0-9A-Za-z\-])",
    "phone": r"(?<![0-9A-Za-z+])(?:\+[0-9]{1,3}(?:[ .\-]?\([0-9]{1,4}\))?(?:[ .\-]?[0-9]{2,5}){2,5}|\([0-9]{3}\) ?[0-9]{3}-[0-9]{4}|[0-9]{3}-[0-9]{3}-[0-9]{4})(?![0-9A-Za-z]|-[0-9])",
    "card": r"(?<![0-9A-Za-z])[0-9](?:[ \-]?[0-9]){12,18}(?![0-9A-Za-z]|-[0-9])",
}
ANY = "|".join(f"(?:{p})" for p in PATTERNS.values())


def _with(value: Column, use: Callable[[Column], Column]) -> Column:
    """use(value) with the value worked out once, though it is used more than once."""
    return F.transform(F.array(value), use)[0]


def _int(c: Column) -> Column:
    return c.cast("bigint")


def feistel(kind: str, key: str, a: Column, size_a: Column, b: Column, size_b: Column, back: bool = False) -> Column:
    """(a, b) permuted among all pairs below (size_a, size_b); ``back`` undoes it."""
    rounds = F.sequence(F.lit(ROUNDS), F.lit(1)) if back else F.sequence(F.lit(1), F.lit(ROUNDS))

    def step(pair: Column, r: Column) -> Column:
        other = F.when(r % 2 == 1, pair["b"]).otherwise(pair["a"])
        digest = F.sha2(F.concat_ws("|", F.lit(key), F.lit(kind), size_a.cast("string"), size_b.cast("string"),
                                    r.cast("string"), other.cast("string")), 256)
        f = _int(F.conv(F.substring(digest, 1, 14), 16, 10))
        f = -f if back else f
        return F.struct(F.when(r % 2 == 1, F.pmod(pair["a"] + f, size_a)).otherwise(pair["a"]).alias("a"),
                        F.when(r % 2 == 0, F.pmod(pair["b"] + f, size_b)).otherwise(pair["b"]).alias("b"))

    return F.aggregate(rounds, F.struct(_int(a).alias("a"), _int(b).alias("b")), step)


def _digits(m: Column) -> Column:
    return F.regexp_replace(m, "[^0-9]", "")


def _permuted_digits(kind: str, key: str, digits: Column) -> Column:
    """Digit string of the same length."""
    n = F.length(digits)
    cut = F.floor(n / 2).cast("int")
    left, right = F.substring(digits, F.lit(1), cut), F.substring(digits, cut + 1, n)
    size = lambda k: _int(F.rpad(F.lit("1"), k + 1, "0"))
    return _with(feistel(kind, key, left, size(cut), right, size(n - cut)), lambda pair: F.concat(
        F.lpad(pair["a"].cast("string"), cut, "0"), F.lpad(pair["b"].cast("string"), n - cut, "0")))


def _in_place(m: Column, digits: Column) -> Column:
    """m with its digits replaced in turn by those of ``digits``."""
    start = F.struct(F.lit("").alias("out"), F.lit(1).alias("k"))
    return F.aggregate(F.split(m, ""), start, lambda acc, c: F.struct(
        F.concat(acc["out"], F.when(c.rlike("^[0-9]$"), F.substring(digits, acc["k"], F.lit(1))).otherwise(c)).alias("out"),
        (acc["k"] + c.rlike("^[0-9]$").cast("int")).alias("k")), lambda acc: acc["out"])


def _check_digit(body: Column) -> Column:
    """Luhn check digit of a digit string."""
    n = F.length(body)

    def add(acc: Column, i: Column) -> Column:
        d = F.substring(body, n - i + 1, F.lit(1)).cast("int") * F.when(i % 2 == 1, 2).otherwise(1)
        return acc + F.when(d > 9, d - 9).otherwise(d)

    total = F.aggregate(F.sequence(F.lit(1), n), F.lit(0), add)
    return F.pmod(10 - F.pmod(total, F.lit(10)), F.lit(10)).cast("string")


def _card(m: Column, key: str) -> Column:
    def new(digits: Column) -> Column:
        n = F.length(digits)
        return _with(F.substring(digits, F.lit(1), n - 1), lambda body: F.when(
            _check_digit(body) == F.substring(digits, n, F.lit(1)),
            _with(_permuted_digits("card", key, body), lambda x: _with(F.concat(x, _check_digit(x)), lambda y: _in_place(m, y)))))

    return _with(_digits(m), new)


def _phone(m: Column, key: str) -> Column:
    # the country code is kept: up to the first separator, or +1 or two digits where there is none
    head = F.regexp_extract(m, r"^(\+[0-9]{1,3}(?=[ .(\-])|\+1(?=[0-9])|\+[0-9]{2}(?=[0-9])|)", 1)

    def new(head: Column) -> Column:
        rest = F.substring(m, F.length(head) + 1, F.length(m))
        return _with(_digits(rest), lambda digits: F.when(F.length(digits).between(7, 15), F.concat(
            head, _with(_permuted_digits("phone", key, digits), lambda x: _in_place(rest, x)))))

    return _with(head, new)


def _ip(m: Column, key: str) -> Column:
    byte = lambda c: [F.floor(c / 256).cast("string"), (c % 256).cast("string")]

    def new(o: Column) -> Column:
        return F.when(F.forall(o, lambda x: x <= 255), _with(
            feistel("ip", key, o[0] * 256 + o[1], F.lit(65536), o[2] * 256 + o[3], F.lit(65536)),
            lambda pair: F.concat_ws(".", *byte(pair["a"]), *byte(pair["b"]))))

    return _with(F.transform(F.split(m, r"\."), lambda x: x.cast("bigint")), new)


def _ssn(m: Column, key: str) -> Column:
    pad = lambda c, n: F.lpad(c.cast("string"), n, "0")

    def new(part: Column) -> Column:
        area, group, serial = part[0], part[1], part[2]
        good = (area >= 1) & (area <= 899) & (area != 666) & (group >= 1) & (serial >= 1)
        pair = feistel("ssn", key, F.when(area < 666, area - 1).otherwise(area - 2), F.lit(898),
                       (group - 1) * 9999 + serial - 1, F.lit(99 * 9999))
        return F.when(good, _with(pair, lambda x: F.concat_ws(
            "-", pad(F.when(x["a"] < 665, x["a"] + 1).otherwise(x["a"] + 2), 3),
            pad(F.floor(x["b"] / 9999) + 1, 2), pad(x["b"] % 9999 + 1, 4))))

    return _with(F.transform(F.split(m, "-"), lambda x: x.cast("bigint")), new)


def _date(m: Column, key: str) -> Column:
    iso = m.rlike("^[0-9]{4}-")
    sep = F.regexp_extract(m, "[-/.]", 0)
    part = F.split(m, "[-/.]")
    pad = lambda c: F.lpad(c, 2, "0")
    ymd = lambda y, mo, d: F.try_to_date(F.concat_ws("-", y, pad(mo), pad(d)), "yyyy-MM-dd")
    day_first, month_first = ymd(part[2], part[1], part[0]), ymd(part[2], part[0], part[1])
    index = F.datediff(F.when(iso, ymd(part[0], part[1], part[2])).otherwise(F.coalesce(day_first, month_first)),
                       F.lit(DAY_ZERO).cast("date"))

    def shown(day: Column) -> Column:
        # day and month of the new date are written with two digits: one digit would not hold all of them
        y, mo, d = (F.date_format(day, f) for f in ("yyyy", "MM", "dd"))
        return F.when(iso, F.concat_ws("-", y, mo, d)).when(day_first.isNotNull(), F.concat(d, sep, mo, sep, y)).otherwise(
            F.concat(mo, sep, d, sep, y))

    def new(i: Column) -> Column:
        pair = feistel("date", key, F.floor(i / YEAR_DAYS), F.lit(YEARS), i % YEAR_DAYS, F.lit(YEAR_DAYS))
        day = _with(pair, lambda x: F.date_add(F.lit(DAY_ZERO).cast("date"), (x["a"] * YEAR_DAYS + x["b"]).cast("int")))
        return F.when((i >= 0) & (i < YEARS * YEAR_DAYS), _with(day, shown))

    return _with(index, new)


def _keyed(kind: str, key: str, m: Column) -> Column:
    return F.sha2(F.concat_ws("|", F.lit(key), F.lit(kind), m), 256)


def _email(m: Column, key: str) -> Column:
    digest = _keyed("email", key, F.lower(m))
    return F.concat(F.lit("user."), F.substring(digest, 1, 16), F.lit("@"), F.substring_index(m, "@", -1))


def _secret(m: Column, key: str) -> Column:
    new = F.substring(_keyed("secret", key, F.lower(m)), F.lit(1), F.length(m))
    return F.when(m.rlike("[A-F]") & ~m.rlike("[a-f]"), F.upper(new)).otherwise(new)


MAKERS = {"email": _email, "secret": _secret, "ip": _ip, "date": _date, "ssn": _ssn, "phone": _phone, "card": _card}


def kind_of(m: Column) -> Column:
    """Kind of a match; its surroundings were checked when it was found."""
    chain = F
    for kind, pattern in PATTERNS.items():
        bare = pattern[pattern.index(")") + 1:] if pattern.startswith("(?<!") else pattern
        cut = bare.rindex("(?!") if "(?!" in bare else len(bare)
        chain = chain.when(m.rlike(f"^(?:{bare[:cut]})$"), F.lit(kind))
    return chain


def _replacement(m: Column, key: str) -> Column:
    def new(kind: Column) -> Column:
        chain = F
        for name, make in MAKERS.items():
            chain = chain.when(kind == name, make(m, key))
        return F.coalesce(chain, m)

    return _with(kind_of(m), new)


def pseudonymise(docs: DataFrame, key: str = KEY, text: str = "text", found: str | None = None) -> DataFrame:
    """``docs`` with its text pseudonymised; ``found`` names a new column for the number of replaced values."""
    names = docs.columns
    # almost every text without a digit or an at sign is passed over by one cheap scan
    docs = docs.withColumn("_p_m", F.when(F.col(text).rlike("[0-9@]"), F.regexp_extract_all(text, F.lit(ANY), F.lit(0))))
    docs = docs.withColumn("_p_r", F.when(F.size("_p_m") > 0, F.transform("_p_m", lambda m: _replacement(m, key))))
    gaps = F.split(F.col(text), ANY, -1)
    new = F.when(F.col("_p_r").isNull(), F.col(text)).otherwise(F.array_join(
        F.zip_with(gaps, "_p_r", lambda g, r: F.concat(F.coalesce(g, F.lit("")), F.coalesce(r, F.lit("")))), ""))
    changed = F.coalesce(F.size(F.filter(F.zip_with("_p_m", "_p_r", lambda a, b: a != b), lambda x: x)), F.lit(0)).cast("bigint")
    changed = F.when(F.col("_p_r").isNull(), F.lit(0).cast("bigint")).otherwise(changed)
    return docs.select(*[new.alias(c) if c == text else F.col(c) for c in names], *([changed.alias(found)] if found else []))
