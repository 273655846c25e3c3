"""Format-preserving pseudonyms of personal data. DataFrame operations only.

E-mail addresses, telephone and card numbers, IPv4 addresses, social security
numbers and dates are found with one pattern, validated (Luhn check, calendar,
number plans, octets) and permuted within their format by a keyed Feistel
network, so that equal values get equal pseudonyms in all documents, however
they are punctuated. Numbers stay valid: a card keeps a right check digit, a
date is a date. Everything happens within a row; there is no shuffle.

Values that fail validation are left as they are. A permutation has fixed
points with the chance that two random values of the format are equal.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

ROUNDS = 10
WALKS = 24  # steps of a cycle walk; a step stays outside the calendar once in 180

_EMAIL = r"(?<![A-Za-z0-9._%+-])[A-Za-z0-9._%+-]{1,64}+@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)+"
_IP = r"(?<![\d.])\d{1,3}(?:\.\d{1,3}){3}(?!\.?\d)"
_SSN = r"(?<![\d-])\d{3}-\d{2}-\d{4}(?![\d-])"
_ISO = r"(?<![\d-])\d{4}-\d{2}-\d{2}(?![\d-])"
_SLASHED = r"(?<![\d/])\d{2}/\d{2}/\d{4}(?![\d/])"
_PHONE = r"(?<![\d+(])(?:\+?1[ .-]?)?(?:\([1-9]\d{2}\) ?\d{3}[ .-]?|[1-9]\d{2}[ .-]\d{3}[ .-])\d{4}(?!\d)"
_CARD = (
    r"(?<!\d)(?:\d{13,19}|\d{4}(?: \d{4}){2} \d{1,4}|\d{4}(?:-\d{4}){2}-\d{1,4}"
    r"|\d{4} \d{6} \d{5}|\d{4}-\d{6}-\d{5})(?!\d)"
)
PATTERN = "|".join((_EMAIL, _IP, _SSN, _ISO, _SLASHED, _PHONE, _CARD))

FIRST_DAY, DAYS = "1900-01-01", 73_049  # up to 2099-12-31
_SIDE = 271  # 271 * 271 is the least square of at least DAYS days


def _hash(key: str, kind: Column | str, turn: Column, half: Column) -> Column:
    """48 keyed bits of a round."""
    kind = F.lit(kind) if isinstance(kind, str) else kind
    text = F.concat_ws("|", F.lit(key), kind, turn.cast("string"), half.cast("string"))
    return F.conv(F.substring(F.sha2(text, 256), 1, 12), 16, 10).cast("bigint")


def permuted(n: Column, a: Column, b: Column, key: str, kind: Column | str) -> Column:
    """Keyed permutation of 0 .. a*b-1: a Feistel network over two halves mod a and b."""
    halves = F.struct(_div(n, b).alias("l"), F.pmod(n, b).alias("r"))

    def turn(s: Column, i: Column) -> Column:
        left = F.pmod(s["l"] + F.pmod(_hash(key, kind, i, s["r"]), a), a)
        right = F.pmod(s["r"] + F.pmod(_hash(key, kind, i, s["l"]), b), b)
        odd = i % 2 == 1
        return F.struct(F.when(odd, left).otherwise(s["l"]).alias("l"), F.when(odd, s["r"]).otherwise(right).alias("r"))

    return F.aggregate(F.sequence(F.lit(1), F.lit(ROUNDS)), halves, turn, lambda s: s["l"] * b + s["r"])


def _div(n: Column, b: Column) -> Column:
    """Whole quotient of numbers that are not negative, without a detour by doubles."""
    return F.call_function("div", n, b)


def _long(n: int) -> Column:
    return F.lit(n).cast("bigint")


def _digits(value: Column) -> Column:
    return F.regexp_replace(value, r"[^0-9]", "")


def _refilled(shape: Column, digits: Column) -> Column:
    """The shape with its digits replaced in turn."""

    def put(s: Column, c: Column) -> Column:
        is_digit = c.between("0", "9")
        return F.struct(
            F.concat(s["out"], F.when(is_digit, F.substr(digits, s["at"], F.lit(1))).otherwise(c)).alias("out"),
            (s["at"] + F.when(is_digit, 1).otherwise(0)).alias("at"),
        )

    start = F.struct(F.lit("").alias("out"), F.lit(1).alias("at"))
    return F.aggregate(F.split(shape, ""), start, put, lambda s: s["out"])


def luhn_sum(digits: Column, double_last: bool) -> Column:
    """Sum of the digits from the right, every second one doubled."""
    first = 0 if double_last else 1

    def weigh(c: Column, i: Column) -> Column:
        d = c.cast("int")
        twice = F.when(d > 4, 2 * d - 9).otherwise(2 * d)
        return F.when(i % 2 == first, twice).otherwise(d)

    each = F.transform(F.split(F.reverse(digits), ""), weigh)
    return F.aggregate(each, F.lit(0), lambda s, x: s + x)


def _card(value: Column, key: str) -> Column:
    digits = _digits(value)
    body = F.substr(digits, F.lit(1), F.length(digits) - 1)
    half = (F.floor((F.length(body)) / 2)).cast("int")
    a, b = F.pow(F.lit(10), half).cast("bigint"), F.pow(F.lit(10), F.length(body) - half).cast("bigint")
    fresh = permuted(body.cast("bigint"), a, b, key, F.concat(F.lit("card"), F.length(body).cast("string")))
    text = F.lpad(fresh.cast("string"), F.length(body), F.lit("0"))
    check = F.pmod(10 - F.pmod(luhn_sum(text, True), F.lit(10)), F.lit(10))
    valid = F.length(digits).between(13, 19) & (luhn_sum(digits, False) % 10 == 0)
    return F.when(valid, _refilled(value, F.concat(text, check.cast("string"))))


def _phone(value: Column, key: str) -> Column:
    """Area codes do not start with 0: 900 * 10^7 numbers; a country code stays."""
    digits = _digits(value)
    n = F.right(digits, F.lit(10)).cast("bigint") - 1_000_000_000
    fresh = permuted(n, _long(90_000), _long(100_000), key, "phone") + 1_000_000_000
    country = F.substr(digits, F.lit(1), F.length(digits) - 10)
    return _refilled(value, F.concat(country, fresh.cast("string")))


def _ip(value: Column, key: str) -> Column:
    octets = F.transform(F.split(value, r"\."), lambda x: x.cast("bigint"))
    n = F.aggregate(octets, _long(0), lambda s, x: s * 256 + x)
    fresh = permuted(n, _long(65_536), _long(65_536), key, "ip")
    parts = [F.pmod(F.shiftright(fresh, s), _long(256)).cast("string") for s in (24, 16, 8, 0)]
    return F.when(F.forall(octets, lambda x: x <= 255), F.concat_ws(".", *parts))


def _ssn(value: Column, key: str) -> Column:
    """Areas 001 to 899 but 666, groups 01 to 99, serials 0001 to 9999."""
    parts = F.split(value, "-")
    area, group, serial = (parts[i].cast("bigint") for i in range(3))
    valid = area.between(1, 899) & (area != 666) & (group > 0) & (serial > 0)
    place = area - F.when(area > 666, 2).otherwise(1)
    fresh = permuted((place * 99 + group - 1) * 9_999 + serial - 1, _long(898 * 99), _long(9_999), key, "ssn")
    serial, rest = F.pmod(fresh, _long(9_999)) + 1, _div(fresh, _long(9_999))
    group, place = F.pmod(rest, _long(99)) + 1, _div(rest, _long(99))
    area = place + F.when(place >= 665, 2).otherwise(1)
    text = [F.lpad(c.cast("string"), w, "0") for c, w in ((area, 3), (group, 2), (serial, 4))]
    return F.when(valid, F.concat_ws("-", *text))


def _date(value: Column, pattern: str, key: str) -> Column:
    """A day of the same calendar; steps that leave it are repeated."""
    day = F.try_to_timestamp(value, F.lit(pattern)).cast("date")
    n = F.datediff(day, F.lit(FIRST_DAY).cast("date")).cast("bigint")

    def walk(s: Column, i: Column) -> Column:
        return F.when((i > 1) & (s < DAYS), s).otherwise(permuted(s, _long(_SIDE), _long(_SIDE), key, "date"))

    fresh = F.aggregate(F.sequence(F.lit(1), F.lit(WALKS)), n, walk)
    shown = F.date_format(F.date_add(F.lit(FIRST_DAY).cast("date"), fresh.cast("int")), pattern)
    return F.when(n.between(0, DAYS - 1) & (fresh < DAYS), shown)


def _email(value: Column, key: str) -> Column:
    """Letters and digits of the local part stay what they are, at their places."""
    parts = F.split(value, "@")
    name, cut = parts[0], F.floor(F.length(parts[0]) / 2).cast("int")
    start = F.struct(F.substr(name, F.lit(1), cut).alias("l"), F.substr(name, cut + 1, F.length(name)).alias("r"))

    def turn(s: Column, i: Column) -> Column:
        digest = F.sha2(F.concat_ws("|", F.lit(key), F.lit("email"), i.cast("string"), s["r"]), 256)
        moved = F.transform(F.split(s["l"], ""), lambda c, j: _moved(c, _byte(digest, j)))
        return F.struct(s["r"].alias("l"), F.array_join(moved, "").alias("r"))

    fresh = F.aggregate(F.sequence(F.lit(1), F.lit(ROUNDS)), start, turn, lambda s: F.concat(s["l"], s["r"]))
    return F.concat(fresh, F.lit("@"), parts[1])


def _byte(digest: Column, j: Column) -> Column:
    return F.conv(F.substr(digest, F.pmod(j, F.lit(32)) * 2 + 1, F.lit(2)), 16, 10).cast("int")


def _moved(c: Column, by: Column) -> Column:
    """A letter or digit ``by`` places on within its kind."""
    out = c
    for low, high in (("0", "9"), ("A", "Z"), ("a", "z")):
        size = ord(high) - ord(low) + 1
        shifted = F.char(F.pmod(F.ascii(c) - ord(low) + by, F.lit(size)) + ord(low))
        out = F.when(c.between(low, high), shifted).otherwise(out)
    return out


def pseudonym(value: Column, key: str) -> Column:
    """Of a text that ``PATTERN`` found; unchanged if it does not validate."""
    full = lambda p: value.rlike(f"^(?:{p})$")
    found = (
        F.when(value.contains("@"), _email(value, key))
        .when(full(_IP), _ip(value, key))
        .when(full(_SSN), _ssn(value, key))
        .when(full(_ISO), _date(value, "yyyy-MM-dd", key))
        .when(full(_SLASHED), _date(value, "MM/dd/yyyy", key))
        .when(full(_PHONE), _phone(value, key))
        .otherwise(_card(value, key))
    )
    return F.coalesce(found, value)


def pseudonymised(docs: DataFrame, key: str, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """(doc_id, text, n_values): whole texts with personal data replaced.

    ``n_values`` counts the values replaced. A null text stays null and has none.
    Rows may repeat; other columns take no part; an empty table gives none.
    ``key`` is the secret; without it pseudonyms cannot be linked back.
    """
    rows = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text"))
    may_have = F.col("text").rlike("[0-9@]")
    values = F.regexp_extract_all("text", F.lit(PATTERN), F.lit(0))
    found = rows.withColumn("values", F.when(may_have, values).otherwise(F.array().cast("array<string>")))
    found = found.withColumn("fresh", F.transform("values", lambda v: pseudonym(v, key)))
    between = F.split("text", PATTERN, -1)
    filled = F.array_join(F.zip_with(between, F.col("fresh"), lambda s, v: F.concat(s, F.coalesce(v, F.lit("")))), "")
    changed = F.size(F.filter(F.arrays_zip("values", "fresh"), lambda p: p["values"] != p["fresh"]))
    return found.select(
        "doc_id", F.when(F.size("values") > 0, filled).otherwise(F.col("text")).alias("text"),
        changed.cast("bigint").alias("n_values"),
    )
