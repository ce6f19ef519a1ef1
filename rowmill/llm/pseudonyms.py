"""Format-preserving pseudonyms: validated values are permuted by a keyed Feistel network in their format.

Equal values get equal pseudonyms wherever they stand, different values of a format different ones, and
each pseudonym is a valid value of the same form: a card keeps its first digit, its spacing and a right
check digit, a date stays a day of its century, an address keeps the width of each number. Domains are
products of two numbers, so the network permutes them exactly, without walking out and back in.

Column expressions only and no shuffle. A text is cut once at the values it holds and joined again; texts
without a digit or ``@`` are passed over by one look. The key is a literal of the plan: whoever can read plans or
event logs can read it, so redact those.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rowmill.llm.common import by_name, by_place

ROUNDS = 10
EMAIL = r"(?<![A-Za-z0-9._%+-])[A-Za-z0-9._%+-]{1,64}+@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++"
ISO_DATE = r"(?<![0-9-])[0-9]{4}-[0-9]{2}-[0-9]{2}(?![0-9]|-[0-9])"
DAY_DATE = r"(?<![0-9./])(?:[0-9]{2}\.[0-9]{2}\.|[0-9]{2}/[0-9]{2}/)[0-9]{4}(?![0-9]|[./][0-9])"
CARD = (r"(?<![0-9])(?:[0-9]{4}(?<s>[ -]?)[0-9]{4}\k<s>[0-9]{4}\k<s>[0-9]{1,7}"
        r"|3[47][0-9]{2}(?<t>[ -])[0-9]{6}\k<t>[0-9]{5})(?![0-9])")
SSN = r"(?<![0-9-])[0-9]{3}-[0-9]{2}-[0-9]{4}(?![0-9]|-[0-9])"
PHONE = r"(?<![0-9])(?:1[ .-]?)?(?:\([0-9]{3}\) ?|[0-9]{3}[ .-])[0-9]{3}[ .-][0-9]{4}(?![0-9])"
ADDRESS = r"(?<![0-9.])(?:[0-9]{1,3}\.){3}[0-9]{1,3}(?![0-9]|\.[0-9])"
VALUES = "|".join((EMAIL, ISO_DATE, DAY_DATE, CARD, SSN, PHONE, ADDRESS))


def digest(key: str, kind: str, *parts: Column) -> Column:
    return F.sha2(F.concat_ws("|", F.lit(key), F.lit(kind), *(p.cast("string") for p in parts)), 256)


def permuted(left: Column, right: Column, a: Column, b: Column, key: str, kind: str) -> Column:
    """struct(x, y): the pair (left < a, right < b) permuted over all such pairs."""
    def turn(s: Column, i: Column) -> Column:
        by = F.conv(F.substring(digest(key, kind, i, s["m"], s["n"], s["y"]), 1, 14), 16, 10).cast("long")
        return F.struct(s["y"].alias("x"), F.pmod(s["x"] + by, s["m"]).alias("y"), s["n"].alias("m"), s["m"].alias("n"))

    start = F.struct(left.cast("long").alias("x"), right.cast("long").alias("y"), a.cast("long").alias("m"), b.cast("long").alias("n"))
    return F.aggregate(F.array(*(F.lit(i) for i in range(ROUNDS))), start, turn)


def let(value: Column, body) -> Column:
    """Bind a value once, so that a long expression over it does not compute it again and again."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def digits_of(value: Column) -> Column:
    return F.regexp_replace(value, "[^0-9]", "")


def number(value: Column, start: int | Column, length: int | Column) -> Column:
    start, length = (F.lit(x) if isinstance(x, int) else x for x in (start, length))
    return F.coalesce(F.nullif(F.substr(value, start, length), F.lit("")), F.lit("0")).cast("long")


def padded(value: Column, width: int | Column) -> Column:
    return F.lpad(value.cast("string"), width, "0")


def spaced_like(value: Column, digits: Column) -> Column:
    """``digits`` in place of the digits of ``value``."""
    return F.array_join(F.zip_with(F.split(value, "[0-9]", -1), F.split(digits, ""), lambda gap, d: F.concat(
        F.coalesce(gap, F.lit("")), F.coalesce(d, F.lit("")))), "")


def luhn(digits: Column) -> Column:
    """The check sum of a digit string."""
    doubled = F.transform(F.filter(F.split(F.reverse(digits), ""), lambda d: d != ""), lambda d, i: F.when(
        i % 2 == 0, d.cast("int")).otherwise(F.pmod(d.cast("int") * 2 - 1, F.lit(9)) + F.when(d == "0", -8).otherwise(1)))
    return F.aggregate(doubled, F.lit(0), lambda a, b: a + b)


def card(value: Column, key: str) -> Column:
    def new(d: Column) -> Column:
        middle = F.length(d) - 2
        first = F.floor(middle / 2).cast("int")
        pair = permuted(number(d, F.lit(2), first), number(d, first + 2, middle - first),
                        F.pow(F.lit(10.0), first).cast("long"), F.pow(F.lit(10.0), middle - first).cast("long"), key, "card")
        body = let(pair, lambda p: F.concat(F.substring(d, 1, 1), padded(p["x"], first), padded(p["y"], middle - first)))
        whole = let(body, lambda x: F.concat(x, F.pmod(10 - F.pmod(luhn(F.concat(x, F.lit("0"))), F.lit(10)), F.lit(10)).cast("string")))
        return F.when((luhn(d) % 10 == 0) & ~d.rlike("^0+$"), spaced_like(value, whole))
    return let(digits_of(value), new)


def phone(value: Column, key: str) -> Column:
    def new(d: Column) -> Column:
        ten, lead = F.substring(d, -10, 10), F.substr(d, F.lit(1), F.length(d) - 10)
        pair = permuted(F.concat(F.substring(ten, 2, 2), F.substring(ten, 5, 2)), F.substring(ten, 7, 4), F.lit(10_000), F.lit(10_000), key, "phone")
        return let(pair, lambda p: spaced_like(value, F.concat(
            lead, F.substring(ten, 1, 1), F.substring(padded(p["x"], 4), 1, 2), F.substring(ten, 4, 1),
            F.substring(padded(p["x"], 4), 3, 2), padded(p["y"], 4))))
    return let(digits_of(value), new)


def ssn(value: Column, key: str) -> Column:
    area, group, serial = number(value, 1, 3), number(value, 5, 2), number(value, 8, 4)
    valid = (area > 0) & (area != 666) & (area < 900) & (group > 0) & (serial > 0)
    pair = permuted(area - 1 - F.when(area > 666, 1).otherwise(0), (group - 1) * 9999 + serial - 1, F.lit(898), F.lit(99 * 9999), key, "ssn")
    return F.when(valid, let(pair, lambda p: F.concat_ws("-", padded(p["x"] + 1 + F.when(p["x"] >= 665, 1).otherwise(0), 3),
                                                         padded(F.floor(p["y"] / 9999) + 1, 2), padded(p["y"] % 9999 + 1, 4))))


def address(value: Column, key: str) -> Column:
    """Numbers keep their count of digits: 0-9, 10-99 and 100-255 are permuted each in its range."""
    def new(o: Column) -> Column:
        least = [F.element_at(F.array(F.lit(0), F.lit(10), F.lit(100)), F.length(o[i])) for i in range(4)]
        size = [F.element_at(F.array(F.lit(10), F.lit(90), F.lit(156)), F.length(o[i])) for i in range(4)]
        at = [o[i].cast("int") - least[i] for i in range(4)]
        pair = permuted(at[0] * size[1] + at[1], at[2] * size[3] + at[3], size[0] * size[1], size[2] * size[3], key, "address")
        return let(pair, lambda p: F.concat_ws(".", *(
            (number_ + low).cast("string") for number_, low in zip(
                (F.floor(p["x"] / size[1]), p["x"] % size[1], F.floor(p["y"] / size[3]), p["y"] % size[3]), least))))
    octet = "(0|[1-9][0-9]?|1[0-9][0-9]|2[0-4][0-9]|25[0-5])"
    return F.when(value.rlike(rf"^{octet}(\.{octet}){{3}}$"), let(F.split(value, r"\."), new))


def moved_day(year: Column, month: Column, day: Column, key: str, shape) -> Column:
    """``shape`` of another day of the century; null for what is no day of the calendar."""
    def new(first: Column) -> Column:
        leap = F.pmod(F.floor(year / 100), F.lit(4)) == 0
        # 36 525 = 75 x 487 days in a century that begins with a leap year, 36 524 = 92 x 397 in others.
        a, b = F.when(leap, 75).otherwise(92), F.when(leap, 487).otherwise(397)
        place = F.datediff(F.make_date(year, month, day), first)
        pair = permuted(F.floor(place / b), place % b, a, b, key, "date")
        return let(pair, lambda p: shape(F.date_add(first, (p["x"] * b + p["y"]).cast("int"))))
    thirty = F.when(month == 2, F.when((year % 4 == 0) & ((year % 100 != 0) | (year % 400 == 0)), 29).otherwise(28)).when(
        month.isin(4, 6, 9, 11), 30).otherwise(31)
    valid = (month >= 1) & (month <= 12) & (day >= 1) & (day <= thirty)
    return F.when(valid, let(F.when(valid, F.make_date((F.floor(year / 100) * 100).cast("int"), F.lit(1), F.lit(1))), new))


def part(value: Column, start: int, length: int) -> Column:
    return F.substring(value, start, length).cast("int")


def iso_date(value: Column, key: str) -> Column:
    return moved_day(part(value, 1, 4), part(value, 6, 2), part(value, 9, 2), key, lambda d: F.date_format(d, "yyyy-MM-dd"))


def day_date(value: Column, key: str) -> Column:
    """dd.mm.yyyy, and mm/dd/yyyy, or dd/mm/yyyy where the first number is no month."""
    a, b, year = part(value, 1, 2), part(value, 4, 2), part(value, 7, 4)
    return F.when(value.contains("."), moved_day(year, b, a, key, lambda d: F.date_format(d, "dd.MM.yyyy"))).when(
        a > 12, moved_day(year, b, a, key, lambda d: F.date_format(d, "dd/MM/yyyy"))).otherwise(
        moved_day(year, a, b, key, lambda d: F.date_format(d, "MM/dd/yyyy")))


def email(value: Column, key: str) -> Column:
    """The part before the ``@``: letters become letters of their case, digits digits, signs stay."""
    def shifted(text: Column, by: Column) -> Column:
        def one(c: Column, i: Column) -> Column:
            step = F.conv(F.substr(by, 2 * (i % 32).cast("int") + 1, F.lit(2)), 16, 10).cast("int")
            turn = lambda low, n: F.chr((F.ascii(c) - low + step) % n + low)
            return F.when(c.rlike("[a-z]"), turn(97, 26)).when(c.rlike("[A-Z]"), turn(65, 26)).when(c.rlike("[0-9]"), turn(48, 10)).otherwise(c)
        return F.array_join(F.transform(F.filter(F.split(text, ""), lambda c: c != ""), one), "")

    def turn(s: Column, i: Column) -> Column:
        return F.struct(s["y"].alias("x"), shifted(s["x"], digest(key, "email", i, s["y"])).alias("y"))

    def new(local: Column) -> Column:
        half = F.floor(F.length(local) / 2).cast("int")
        start = F.struct(F.substr(local, F.lit(1), half).alias("x"), F.substr(local, half + 1, F.length(local)).alias("y"))
        done = F.aggregate(F.array(*(F.lit(i) for i in range(ROUNDS))), start, turn)
        return let(done, lambda d: F.concat(d["x"], d["y"], F.substr(value, F.length(local) + 1, F.length(value))))
    return let(F.substring_index(value, "@", 1), new)


def pseudonym(value: Column, key: str) -> Column:
    """The pseudonym of one matched value; null if the value does not hold up."""
    n = F.length(digits_of(value))
    return (F.when(value.contains("@"), email(value, key))
            .when(value.rlike(f"^{ISO_DATE}$"), iso_date(value, key))
            .when(value.rlike(f"^{DAY_DATE}$"), day_date(value, key))
            .when(value.rlike(f"^{SSN}$"), ssn(value, key))
            .when(value.rlike(f"^{ADDRESS}$"), address(value, key))
            .when(n >= 13, card(value, key)).otherwise(phone(value, key)))


def pseudonymize(df: DataFrame, key: str, text: str = "text") -> DataFrame:
    """``df`` with the values in its texts replaced, and n_values, how many held up and were.

    Values: e-mail addresses, dates (yyyy-mm-dd, dd.mm.yyyy, mm/dd/yyyy), card numbers of 13 to 19 digits
    with a right check digit, social security numbers, North American phone numbers, IPv4 addresses. Digits that only look
    like one stay as they are. A null text stays null, with no values. Rows are independent: repeated rows
    and ids give equal results, an empty table none. A column named n_values is replaced; others pass.
    """
    plain, names = by_place(df, (text,), ("n_values",))
    body = F.col(f"`{text}`").cast("string")
    found = F.when(body.rlike("[0-9@]"), F.regexp_extract_all(body, F.lit(VALUES), F.lit(0))).otherwise(F.array().cast("array<string>"))
    marked = plain.withColumn("__values", F.coalesce(found, F.array().cast("array<string>")))
    changed = marked.withColumn("__new", F.transform("__values", lambda v: pseudonym(v, key)))
    joined = F.array_join(F.zip_with(F.split(body, VALUES, -1), F.zip_with("__values", "__new", lambda v, n: F.coalesce(n, v)),
                                     lambda gap, v: F.concat(gap, F.coalesce(v, F.lit("")))), "")
    done = changed.withColumns({text: F.when(F.size("__values") > 0, joined).otherwise(body),
                                "n_values": F.size(F.filter("__new", lambda n: n.isNotNull())).cast("long")}).drop("__values", "__new")
    return by_name(done, names)
