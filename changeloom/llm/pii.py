"""Format-preserving pseudonyms for personal data, in DataFrame operations only."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

ROUNDS = 8
OCTET = "(?:25[0-5]|2[0-4][0-9]|1[0-9]{2}|[1-9]?[0-9])"
#: What may be a value of each kind. Later checks decide.
FORMS = {
    "email": r"(?<![\p{L}0-9._%+-])[\p{L}0-9._%+-]++@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)*\.[A-Za-z]{2,}",
    "phone": r"(?<![0-9])(?:(?:\+[0-9]{1,3}[ .-]?)?\([0-9]{3}\)[ .-]?[0-9]{3}[ .-]?[0-9]{4}|(?:\+[0-9]{1,3}[ .-])?[0-9]{3}([ .-])[0-9]{3}\1[0-9]{4}|\+[0-9]{1,3}(?:[ .-]?[0-9]{2,4}){2,5})(?![0-9])",
    "card": r"(?<![0-9])(?:[0-9]{13,19}|[0-9]{4}(?:[ -][0-9]{4}){3}|[0-9]{4}[ -][0-9]{6}[ -][0-9]{5})(?![0-9])",
    "ssn": r"(?<![0-9-])[0-9]{3}-[0-9]{2}-[0-9]{4}(?![0-9-])",
    "ip": rf"(?<![0-9.]){OCTET}(?:\.{OCTET}){{3}}(?![0-9]|\.[0-9])",
    "date": r"(?<![0-9-])(?:[0-9]{4}[-/][0-9]{2}[-/][0-9]{2}|[0-9]{2}[./][0-9]{2}[./][0-9]{4})(?![0-9-])",
}
KINDS = tuple(FORMS)
ANY = "|".join(f"(?:{form})" for form in FORMS.values()).replace(r"\1", r"[ .-]").replace("([ .-])", "[ .-]")
#: Days are permuted within stretches of 292 * 250, counted from 1900-01-01.
EPOCH, DAYS = "1900-01-01", (292, 250)


def permuted(left: Column, right: Column, size_left: Column, size_right: Column, kind: str, key: str) -> Column:
    """A keyed Feistel permutation of pairs (left, right), left below ``size_left`` and right below ``size_right``.

    Each round adds a keyed hash of one half to the other, modulo that one's size; any sizes do, so no value needs a second pass.
    """

    def turn(pair: Column, i: Column) -> Column:
        add = lambda to, by, size: F.pmod(to + F.pmod(F.xxhash64(F.lit(key), F.lit(kind), i, by), size), size)
        first = F.struct(add(pair["l"], pair["r"], size_left).alias("l"), pair["r"].alias("r"))
        second = F.struct(pair["l"].alias("l"), add(pair["r"], pair["l"], size_right).alias("r"))
        return F.when(i % 2 == 1, first).otherwise(second)

    start = F.struct(left.cast("bigint").alias("l"), right.cast("bigint").alias("r"))
    return F.aggregate(F.sequence(F.lit(1), F.lit(ROUNDS)), start, turn)


def _tens(n: Column) -> Column:
    return F.rpad(F.lit("1"), n + 1, "0").cast("bigint")


def _digits(text: Column, kind: str, key: str) -> Column:
    """A string of 2 to 18 digits as another of the same length."""
    n = F.length(text)
    half = F.floor(n / 2).cast("int")
    pair = permuted(F.left(text, half), F.right(text, n - half), _tens(half), _tens(n - half), kind, key)
    return F.concat(F.lpad(pair["l"].cast("string"), half, "0"), F.lpad(pair["r"].cast("string"), n - half, "0"))


def _refilled(form: Column, digits: Column) -> Column:
    """A value with its digits, in turn, replaced by these."""

    def put(done: Column, c: Column) -> Column:
        digit = c.rlike("[0-9]")
        return F.struct(
            F.when(digit, done["n"] + 1).otherwise(done["n"]).alias("n"),
            F.concat(done["text"], F.when(digit, F.substring(digits, done["n"], F.lit(1))).otherwise(c)).alias("text"),
        )

    return F.aggregate(F.split(form, ""), F.struct(F.lit(1).alias("n"), F.lit("").alias("text")), put)["text"]


def _luhn(digits: Column) -> Column:
    """The Luhn sum of a number, its last digit counted once."""
    n = F.length(digits)

    def worth(c: Column, i: Column) -> Column:
        d = c.cast("int")
        twice = d * 2
        return F.when((n - i) % 2 == 1, d).otherwise(F.when(twice > 9, twice - 9).otherwise(twice))

    return F.aggregate(F.transform(F.split(digits, ""), worth), F.lit(0), lambda a, b: a + b)


def _card(value: Column, key: str) -> Column:
    digits = F.regexp_replace(value, "[ -]", "")
    body = _digits(F.left(digits, F.length(digits) - 1), "card", key)
    check = F.pmod(-_luhn(F.concat(body, F.lit("0"))), F.lit(10)).cast("string")
    return F.when(_luhn(digits) % 10 == 0, _refilled(value, F.concat(body, check)))


def _phone(value: Column, key: str) -> Column:
    country = F.regexp_replace(F.regexp_extract(value, r"^\+[0-9]{1,3}(?=[ .(-])", 0), "[^0-9]", "")
    digits = F.regexp_replace(value, "[^0-9]", "")
    rest = F.substring(digits, F.length(country) + 1, F.length(digits))
    return F.when(F.length(rest).between(7, 17), _refilled(value, F.concat(country, _digits(rest, "phone", key))))


def _ssn(value: Column, key: str) -> Column:
    area, group, serial = (F.split_part(value, F.lit("-"), F.lit(i)).cast("int") for i in (1, 2, 3))
    good = (area >= 1) & (area <= 899) & (area != 666) & (group >= 1) & (serial >= 1)
    place = F.when(area > 666, area - 2).otherwise(area - 1)
    pair = permuted(place * 99 + group - 1, serial - 1, F.lit(898 * 99), F.lit(9999), "ssn", key)
    low = F.floor(pair["l"] / 99)
    parts = F.when(low >= 665, low + 2).otherwise(low + 1), pair["l"] % 99 + 1, pair["r"] + 1
    return F.when(good, F.concat_ws("-", *[F.lpad(p.cast("string"), n, "0") for p, n in zip(parts, (3, 2, 4), strict=True)]))


def _ip(value: Column, key: str) -> Column:
    a, b, c, d = (F.split_part(value, F.lit("."), F.lit(i)).cast("int") for i in (1, 2, 3, 4))
    pair = permuted(a * 256 + b, c * 256 + d, F.lit(65536), F.lit(65536), "ip", key)
    halves = [part for half in ("l", "r") for part in (F.floor(pair[half] / 256), pair[half] % 256)]
    return F.concat_ws(".", *[part.cast("string") for part in halves])


def _date(value: Column, key: str) -> Column:
    """Year first, or day first, or month first where only that is a date."""
    mark = F.regexp_extract(value, "[./-]", 0)
    parts = F.split(value, "[./-]")
    orders = {"ymd": (0, 1, 2), "dmy": (2, 1, 0), "mdy": (2, 0, 1)}
    read = lambda places: F.concat_ws("-", *[parts[i] for i in places]).try_cast("date")
    year_first = F.length(parts[0]) == 4
    out = F.lit(None).cast("string")
    for name in ("mdy", "dmy", "ymd"):
        day = F.datediff(read(orders[name]), F.lit(EPOCH).cast("date"))
        span = DAYS[0] * DAYS[1]
        inside = F.pmod(day, F.lit(span))
        pair = permuted(F.floor(inside / DAYS[1]), inside % DAYS[1], F.lit(DAYS[0]), F.lit(DAYS[1]), "date", key)
        moved = F.date_add(F.lit(EPOCH).cast("date"), (day - inside + pair["l"] * DAYS[1] + pair["r"]).cast("int"))
        fields = dict(zip("ymd", (F.lpad(F.year(moved).cast("string"), 4, "0"), F.date_format(moved, "MM"), F.date_format(moved, "dd")), strict=True))
        text = F.concat_ws("", fields[name[0]], mark, fields[name[1]], mark, fields[name[2]])
        fits = (year_first if name == "ymd" else ~year_first) & day.isNotNull() & (F.year(moved) <= 9999)
        out = F.when(fits, text).otherwise(out)
    return out


def _email(value: Column, key: str) -> Column:
    """The part before the @, each half shifted letter by letter by a hash of the other, within the letter's alphabet."""
    name, host = F.split_part(value, F.lit("@"), F.lit(1)), F.split_part(value, F.lit("@"), F.lit(2))
    half = F.ceil(F.length(name) / 2).cast("int")
    ranges = ((48, 57), (65, 90), (97, 122), (192, 214), (216, 222), (223, 246), (248, 255))

    def shifted(text: Column, by: Column, i: Column) -> Column:
        def one(c: Column, at: Column) -> Column:
            code, out = F.ascii(c), c
            for low, high in ranges:
                size = high - low + 1
                moved = F.pmod(code - low + F.pmod(F.xxhash64(F.lit(key), i, at, by), F.lit(size)), F.lit(size)) + low
                out = F.when(code.between(low, high), F.char(moved)).otherwise(out)
            return out

        return F.array_join(F.transform(F.filter(F.split(text, ""), lambda c: c != ""), one), "")

    def turn(pair: Column, i: Column) -> Column:
        first = F.struct(shifted(pair["l"], pair["r"], i).alias("l"), pair["r"].alias("r"))
        second = F.struct(pair["l"].alias("l"), shifted(pair["r"], pair["l"], i).alias("r"))
        return F.when(i % 2 == 1, first).otherwise(second)

    start = F.struct(F.left(name, half).alias("l"), F.substring(name, half + 1, F.length(name)).alias("r"))
    pair = F.aggregate(F.sequence(F.lit(1), F.lit(4)), start, turn)
    return F.concat(pair["l"], pair["r"], F.lit("@"), host)


MASKS = {"email": _email, "phone": _phone, "card": _card, "ssn": _ssn, "ip": _ip, "date": _date}


def pseudonymize(docs: DataFrame, key: str) -> DataFrame:
    """Documents with their personal data replaced: the input's columns with the new ``text``, then ``found`` (kind, value, pseudonym, in
    the order of the text).

    Kinds: mail addresses, phone numbers, card numbers with a right check digit, social security numbers in the valid ranges,
    network addresses and calendar dates. Each valid value is permuted by the key within its format and stays valid, so equal values stay equal
    everywhere, whatever document they are in; nothing is stored or looked up. Numbers that fail their check, and all other
    text, stay as they are. Null text stays null and has no values; an input column ``found`` is replaced.
    """
    def value(v: Column) -> Column:
        kind = F.lit(None).cast("string")
        new = F.lit(None).cast("string")
        for name in reversed(KINDS):
            of = v.rlike(f"^(?:{FORMS[name]})$")
            kind, new = F.when(of, F.lit(name)).otherwise(kind), F.when(of, MASKS[name](v, key)).otherwise(new)
        return F.struct(F.when(new.isNotNull(), kind).alias("kind"), v.alias("value"), new.alias("pseudonym"))

    names = [name for name in docs.columns if name.lower() not in ("text", "found")]
    matches = F.regexp_extract_all("text", F.lit(ANY), F.lit(0))
    marked = docs.select(
        *[F.col(f"`{name}`") for name in names], F.col("text"),
        F.when(F.col("text").rlike("[0-9@]"), F.transform(matches, value)).alias("all"),
    )
    some = F.coalesce(F.size("all"), F.lit(0)) > 0
    pieces = F.zip_with(
        F.split("text", ANY), "all",
        lambda piece, m: F.concat(piece, F.coalesce(m["pseudonym"], m["value"], F.lit(""))),
    )
    empty = F.array().cast("array<struct<kind:string,value:string,pseudonym:string>>")
    return marked.select(
        *[F.col(f"`{name}`") for name in names],
        F.when(some, F.array_join(pieces, "")).otherwise(F.col("text")).alias("text"),
        F.when(some, F.filter("all", lambda m: m["kind"].isNotNull())).otherwise(empty).alias("found"),
    )
