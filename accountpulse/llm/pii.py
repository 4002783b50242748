"""Personal data replaced by format-preserving pseudonyms, in built-in expressions only.

Candidates are found by one pattern and then validated: card numbers by their check digit, IPv4
addresses by their octets, dates by the calendar, social security numbers by their ranges, phone
numbers by their length. Each is permuted inside its own format by a keyed Feistel network, so
an equal value has an equal pseudonym in every document, different values have different ones, and
who holds the key can invert them (``invert``). The network alternates two moduli, which need
not be equal, so its domain is exactly the format's: numbers of n digits, 2^32 addresses, the
days of a calendar cycle. E-mail names and long hexadecimal secrets are no numbers; a keyed digest
of the same kind of characters stands for them.

Everything is a projection: no shuffle, no Python.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Rounds of the network; even, so both halves come back to their own place.
ROUNDS = 10
#: First day and number of days of the dates that are permuted: one 400-year cycle, 189 x 773 days.
FIRST_DAY, DAY_PARTS = "1800-01-01", (189, 773)

NAME = r"\p{L}\p{N}._%+-"
EDGE, END = r"(?<![\p{L}\p{N}])", r"(?![\p{L}\p{N}])"
PATTERNS = {
    "email": rf"(?<![{NAME}])[{NAME}]++@[\p{{L}}\p{{N}}-]++(?:\.[\p{{L}}\p{{N}}-]++)++",
    "ip": rf"{EDGE}(?<![0-9]\.)[0-9]{{1,3}}(?:\.[0-9]{{1,3}}){{3}}{END}(?!\.[0-9])",
    "date": rf"{EDGE}(?:[0-9]{{4}}-[0-9]{{2}}-[0-9]{{2}}|[0-9]{{2}}/[0-9]{{2}}/[0-9]{{4}}|[0-9]{{2}}\.[0-9]{{2}}\.[0-9]{{4}}){END}(?![-/][0-9])",
    "ssn": rf"{EDGE}[0-9]{{3}}-[0-9]{{2}}-[0-9]{{4}}{END}(?!-[0-9])",
    "phone": rf"(?<![\p{{L}}\p{{N}}+])\+(?:1[ .-]?(?:\([0-9]{{3}}\)|[0-9]{{3}})[ .-]?[0-9]{{3}}[ .-]?[0-9]{{4}}"
    rf"|[0-9]{{1,3}}[ .-]?(?:\([0-9]{{1,4}}\)|[0-9]{{1,4}})(?:[ .-]?[0-9]{{2,4}}){{1,4}}){END}(?!\.[0-9])",
    "card": rf"{EDGE}(?:[0-9]{{4}}([ -])[0-9]{{4}}\1[0-9]{{4}}\1[0-9]{{1,7}}|[0-9]{{13,19}}){END}(?![ -][0-9]{{4}}{END})",
    "secret": rf"{EDGE}(?=[a-f]*[0-9])(?=[0-9]*[a-f])[0-9a-f]{{32,128}}{END}",
}


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` of a value that is computed once, however often ``body`` names it."""
    return F.transform(F.array(value), body)[0]


def _any() -> str:
    # The card pattern's own group is the first and only one.
    return "|".join(f"(?:{p})" for p in PATTERNS.values())


def _round(key: Column, tweak: Column, number: Column, half: Column) -> Column:
    digest = F.sha2(F.concat_ws(":", key, tweak, number.cast("string"), half.cast("string")), 256)
    return F.conv(F.substring(digest, 1, 15), 16, 10).cast("long")


def feistel(left: Column, right: Column, a: Column, b: Column, key: Column, tweak: Column, inverse: bool = False) -> Column:
    """``l`` below ``a`` and ``r`` below ``b``, permuted together."""
    start = F.struct(left.cast("long").alias("l"), right.cast("long").alias("r"))

    def forth(state: Column, i: Column) -> Column:
        moved = state["l"] + _round(key, tweak, i, state["r"])
        return F.struct(state["r"].alias("l"), F.pmod(moved, F.when(i % 2 == 0, a).otherwise(b)).alias("r"))

    def back(state: Column, i: Column) -> Column:
        moved = state["r"] - _round(key, tweak, i, state["l"])
        return F.struct(F.pmod(moved, F.when(i % 2 == 0, a).otherwise(b)).alias("l"), state["l"].alias("r"))

    order = F.sequence(F.lit(ROUNDS - 1), F.lit(0)) if inverse else F.sequence(F.lit(0), F.lit(ROUNDS - 1))
    return F.aggregate(order, start, back if inverse else forth)


def _padded(number: Column, size: Column) -> Column:
    return F.lpad(number.cast("string"), size, "0")


def permuted_digits(digits: Column, key: Column, tweak: str, inverse: bool = False) -> Column:
    """A number of as many digits."""

    def halves(given: Column) -> Column:
        size, ten = F.length(given), F.lit(10.0)
        half = F.floor(size / 2).cast("int")
        return F.struct(
            F.substring(given, F.lit(1), half).alias("left"),
            F.substring(given, half + 1, size - half).alias("right"),
            half.alias("short"),
            (size - half).alias("long"),
            F.pow(ten, half).cast("long").alias("a"),
            F.pow(ten, size - half).cast("long").alias("b"),
            F.concat(F.lit(f"{tweak}:"), size.cast("string")).alias("name"),
        )

    def permuted(parts: Column) -> Column:
        moved = feistel(parts["left"], parts["right"], parts["a"], parts["b"], key, parts["name"], inverse)
        return let(moved, lambda out: F.concat(_padded(out["l"], parts["short"]), _padded(out["r"], parts["long"])))

    return let(digits, lambda given: let(halves(given), permuted))


def refilled(shape: Column, digits: Column) -> Column:
    """``shape`` with its digits replaced one by one."""

    def step(state: Column, i: Column) -> Column:
        char = F.substring(shape, i, F.lit(1))
        digit = char.between("0", "9")
        put = F.when(digit, F.substring(digits, state["k"], F.lit(1))).otherwise(char)
        return F.struct(F.concat(state["out"], put).alias("out"), (state["k"] + digit.cast("int")).alias("k"))

    start = F.struct(F.lit("").alias("out"), F.lit(1).alias("k"))
    return F.aggregate(F.sequence(F.lit(1), F.length(shape)), start, step, lambda s: s["out"])


def _digits(value: Column) -> Column:
    return F.regexp_replace(value, "[^0-9]", "")


def luhn_sum(digits: Column) -> Column:
    """Check sum of a card number, its check digit included."""

    def step(total: Column, i: Column) -> Column:
        digit = F.substring(digits, i, F.lit(1)).cast("int")
        twice = digit * 2 - F.when(digit > 4, 9).otherwise(0)
        return total + F.when((F.length(digits) - i) % 2 == 1, twice).otherwise(digit)

    return F.aggregate(F.sequence(F.lit(1), F.length(digits)), F.lit(0), step)


def _card(value: Column, key: Column, inverse: bool) -> tuple[Column, Column]:
    def checked(body: Column) -> Column:
        check = F.pmod(10 - luhn_sum(F.concat(body, F.lit("0"))) % 10, F.lit(10))
        return refilled(value, F.concat(body, check.cast("string")))

    def valid(digits: Column) -> Column:
        return (luhn_sum(digits) % 10 == 0) & F.length(digits).between(13, 19)

    digits = _digits(value)
    body = permuted_digits(F.substring(digits, F.lit(1), F.length(digits) - 1), key, "card", inverse)
    return let(digits, valid), let(body, checked)


def _ip(value: Column, key: Column, inverse: bool) -> tuple[Column, Column]:
    parts = F.transform(F.split(value, r"\."), lambda p: p.cast("long"))
    side = F.lit(1 << 16)
    moved = feistel(parts[0] * 256 + parts[1], parts[2] * 256 + parts[3], side, side, key, F.lit("ip"), inverse)

    def address(out: Column) -> Column:
        octets = [F.floor(out[h] / 256) if high else out[h] % 256 for h in "lr" for high in (True, False)]
        return F.concat_ws(".", *(o.cast("long").cast("string") for o in octets))

    # An address with leading zeros would not come back as it was.
    plain = F.concat_ws(".", *(parts[i].cast("string") for i in range(4))) == value
    return plain & F.forall(parts, lambda p: p <= 255), let(moved, address)


def _date(value: Column, key: Column, inverse: bool) -> tuple[Column, Column]:
    forms = [("-", "yyyy-MM-dd"), ("/", "MM/dd/yyyy"), (".", "dd.MM.yyyy")]
    day = F.coalesce(*(F.when(F.contains(value, F.lit(sign)), F.try_to_timestamp(value, F.lit(form))) for sign, form in forms)).cast("date")
    a, b = (F.lit(n).cast("long") for n in DAY_PARTS)
    first = F.lit(FIRST_DAY).cast("date")
    number = F.datediff(day, first)
    moved = let(number, lambda n: feistel(F.floor(n / b), n % b, a, b, key, F.lit("date"), inverse))

    def written(new: Column) -> Column:
        return reduce(
            lambda rest, form: F.when(F.contains(value, F.lit(form[0])), F.date_format(new, form[1])).otherwise(rest), forms, F.lit(None)
        )

    new = let(moved, lambda out: F.date_add(first, (out["l"] * b + out["r"]).cast("int")))
    return number.between(0, DAY_PARTS[0] * DAY_PARTS[1] - 1), let(new, written)


def _ssn(value: Column, key: Column, inverse: bool) -> tuple[Column, Column]:
    area, group, serial = (F.split(value, "-")[i].cast("long") for i in range(3))
    valid = area.between(1, 899) & (area != 666) & (group > 0) & (serial > 0)
    place = area - 1 - F.when(area > 666, 1).otherwise(0)
    moved = feistel(place, (group - 1) * 9999 + serial - 1, F.lit(898), F.lit(99 * 9999), key, F.lit("ssn"), inverse)

    def written(out: Column) -> Column:
        new = out["l"] + 1 + F.when(out["l"] + 1 >= 666, 1).otherwise(0)
        three, two, four = F.lit(3), F.lit(2), F.lit(4)
        parts = [_padded(new, three), _padded(F.floor(out["r"] / 9999) + 1, two), _padded(out["r"] % 9999 + 1, four)]
        return F.concat_ws("-", *parts)

    return valid, let(moved, written)


def _phone(value: Column, key: Column, inverse: bool) -> tuple[Column, Column]:
    country = F.regexp_extract(value, r"^\+[0-9]{1,3}(?=[^0-9])", 0)
    country = F.when(country == "", F.substring(value, 1, 2)).otherwise(country)
    rest = F.substring(value, F.length(country) + 1, F.length(value))
    digits = _digits(rest)
    valid = F.length(_digits(value)).between(8, 15)
    return valid, F.concat(country, refilled(rest, permuted_digits(digits, key, "phone", inverse)))


def _email(value: Column, key: Column) -> Column:
    digest = F.sha2(F.concat_ws(":", key, F.lit("email"), F.lower(value)), 256)
    return F.concat(F.lit("p"), F.substring(digest, 1, 15), F.lit("@"), F.substring_index(value, "@", -1))


def _secret(value: Column, key: Column) -> Column:
    name = F.concat_ws(":", key, F.lit("secret"), value)
    digest = F.concat(F.sha2(name, 256), F.sha2(F.concat(name, F.lit(":2")), 256))
    return F.substring(digest, F.lit(1), F.length(value))


NUMBERS = {"ip": _ip, "date": _date, "ssn": _ssn, "phone": _phone, "card": _card}


def pseudonym(value: Column, key: Column, inverse: bool = False) -> Column:
    """Pseudonym of a candidate; the candidate itself where it isn't valid."""
    out = value
    if not inverse:
        out = F.when(value.rlike(f"^(?:{PATTERNS['secret']})$"), _secret(value, key)).otherwise(out)
    for kind in reversed(NUMBERS):
        valid, new = NUMBERS[kind](value, key, inverse)
        out = F.when(value.rlike(f"^(?:{PATTERNS[kind]})$"), F.when(valid, new).otherwise(value)).otherwise(out)
    if not inverse:
        out = F.when(F.contains(value, F.lit("@")), _email(value, key)).otherwise(out)
    return out


def _replaced(text: Column, key: Column, inverse: bool) -> tuple[Column, Column]:
    """Candidates of a text with their pseudonyms, and the text with them in place."""
    pattern = F.lit(_any())
    found = F.regexp_extract_all(text, pattern, F.lit(0))
    new = F.transform(found, lambda m: F.struct(m.alias("old"), pseudonym(m, key, inverse).alias("new")))
    return new, F.split(text, _any(), -1)


def pseudonymised(docs: DataFrame, key: str, text_column: str = "text", inverse: bool = False) -> DataFrame:
    """``docs`` with the text replaced and a last column ``n_private``, one row per input row.

    ``n_private`` counts what was replaced. What looks like personal data but isn't valid stays.
    Null texts stay null with 0, texts without candidates stay as they are, empty ones too. Equal
    values get equal pseudonyms everywhere, in repeated rows as well. Other columns stay; one named
    ``n_private`` is replaced. With ``inverse``, numbers and dates are turned back. The key appears in
    query plans, so keep their logs private.
    """
    secret, text = F.lit(key), F.col(text_column)
    columns = [c for c in docs.columns if c != "n_private"]
    candidate = text.rlike("[0-9@]") & text.rlike(_any())
    pairs, between = _replaced(text, secret, inverse)
    empty = F.lit(None).cast("array<struct<old:string,new:string>>")
    rows = docs.select(*columns, F.when(candidate, pairs).otherwise(empty).alias("__pairs"))
    joined = F.array_join(
        F.flatten(
            F.transform(between, lambda part, i: F.array(part, F.coalesce(F.try_element_at("__pairs", i + 1)["new"], F.lit(""))))
        ),
        "",
    )
    changed = F.size(F.filter("__pairs", lambda p: p["old"] != p["new"]))
    return rows.select(
        *(F.when(F.col("__pairs").isNotNull(), joined).otherwise(text).alias(c) if c == text_column else F.col(c) for c in columns),
        F.when(F.col("__pairs").isNotNull(), changed).otherwise(0).cast("long").alias("n_private"),
    )
