"""Pseudonyms of e-mail addresses, social security numbers and day dates beside plain versions."""

import hashlib
import re
from datetime import date, timedelta

import numpy as np

from rowmill.llm.pseudonyms import ROUNDS
from test_texts import KEY, changed, turn


def moved(day):
    first = date(day.year // 100 * 100, 1, 1)
    a, b = (75, 487) if first.year % 400 == 0 else (92, 397)
    place = (day - first).days
    x, y = turn(place // b, place % b, a, b, "date")
    return first + timedelta(x * b + y)


def plain_day(value):
    a, b, year = (int(v) for v in re.split("[./]", value))
    month, day, shape = (b, a, "{d:02d}.{m:02d}.{y:04d}") if "." in value else (b, a, "{d:02d}/{m:02d}/{y:04d}") if a > 12 else (a, b, "{m:02d}/{d:02d}/{y:04d}")
    try:
        new = moved(date(year, month, day))
    except ValueError:
        return value
    return shape.format(d=new.day, m=new.month, y=new.year)


def plain_ssn(value):
    area, group, serial = (int(v) for v in value.split("-"))
    if not (0 < area < 900 and area != 666 and group and serial):
        return value
    x, y = turn(area - 1 - (area > 666), (group - 1) * 9999 + serial - 1, 898, 99 * 9999, "ssn")
    return f"{x + 1 + (x >= 665):03d}-{y // 9999 + 1:02d}-{y % 9999 + 1:04d}"


def plain_email(value):
    local, host = value.split("@", 1)

    def shifted(text, by):
        out = []
        for i, c in enumerate(text):
            step = int(by[2 * (i % 32):2 * (i % 32) + 2], 16)
            low, n = next(((w, n) for w, n, kind in ((97, 26, "[a-z]"), (65, 26, "[A-Z]"), (48, 10, "[0-9]")) if re.match(kind, c)), (0, 0))
            out.append(chr((ord(c) - low + step) % n + low) if n else c)
        return "".join(out)

    x, y = local[:len(local) // 2], local[len(local) // 2:]
    for i in range(ROUNDS):
        x, y = y, shifted(x, hashlib.sha256(f"{KEY}|email|{i}|{y}".encode()).hexdigest())
    return f"{x}{y}@{host}"


def test_day_dates(spark):
    rng = np.random.default_rng(4)
    parts = list(zip(rng.integers(0, 33, 200), rng.integers(0, 15, 200), rng.integers(1000, 2400, 200)))
    values = [f"{d:02d}.{m:02d}.{y:04d}" for d, m, y in parts] + [f"{m:02d}/{d:02d}/{y:04d}" for d, m, y in parts] + [f"{d:02d}/{m:02d}/{y:04d}" for d, m, y in parts]
    values += ["29.02.2000", "29.02.1900", "02/29/2024", "31/12/1999", "12/31/1999"]
    got = changed(spark, values)
    assert got == [plain_day(v) for v in values] and got != values


def test_social_security_numbers(spark):
    rng = np.random.default_rng(5)
    values = [f"{a:03d}-{g:02d}-{s:04d}" for a, g, s in zip(rng.integers(0, 1000, 300), rng.integers(0, 100, 300), rng.integers(0, 10_000, 300))]
    values += ["666-01-0001", "000-01-0001", "899-99-9999", "001-01-0001", "665-01-0001", "667-01-0001", "123-00-1234", "123-45-0000"]
    assert changed(spark, values) == [plain_ssn(v) for v in values]


def test_email_addresses(spark):
    values = ["a@b.de", "bosbt.42@mail8.example.com", "Very-Long.Name_With+Signs%And1234567890.Digits" + "x" * 18 + "@sub.Example-host.org", "A1@x.y", "zz99@1.2"]
    got = changed(spark, values)
    assert got == [plain_email(v) for v in values] and all(g != v for g, v in zip(got, values))
