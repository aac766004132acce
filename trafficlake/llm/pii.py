"""Format-preserving pseudonyms for personal numbers and dates, by a keyed Feistel network in SQL functions only.

A value found in a text is validated, then written as symbols, each with its own modulus: the digits of a card number
before its check digit, the ten digits of a North American telephone number (area and exchange keep to 2 to 9, or to 0 and 1, in front),
the octets of an IP address, the day number of a date, and so on. The symbols are cut into two halves; each round adds
to one half, symbol by symbol and modulo its modulus, a keyed SHA-256 of the other. That is a bijection within the
format, so different values stay different, equal values stay equal across documents, and the key's owner can invert it
(``restore=True``). What is not permuted (separators, country code, domain) stays, and check digits are made anew.

Kinds and validation: ``card`` 13 to 19 digits with a valid Luhn digit; ``ssn`` ddd-dd-dddd in issued ranges; ``phone``
North American or international with +; ``ip`` dotted quads of octets; ``date`` yyyy-mm-dd, dd.mm.yyyy or mm/dd/yyyy from
1900-01-01 to 2100-01-02; ``email`` letters and digits of the local part. What fails its validation stays as it is.

NULL texts stay NULL; texts without values are not touched. Every row is worked on by itself, without a shuffle: repeated rows
give equal results, an empty table an empty one. Texts of any length are read whole; other columns are kept as they are.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from trafficlake.llm.frames import let, with_results

ROUNDS = 5
LETTERS = "abcdefghijklmnopqrstuvwxyz"
FIRST_DAY, DAY_FACTORS = "1900-01-01", (319, 229)  # 319 * 229 days end on 2100-01-02

EDGE_LEFT, EDGE_RIGHT = r"(?<![0-9A-Za-z.+_-])", r"(?![0-9A-Za-z_]|[.-][0-9])"
PATTERNS = {
    "email": r"(?<![A-Za-z0-9._%+-])[A-Za-z0-9._%+-]++@(?:[A-Za-z0-9-]+\.)+[A-Za-z]{2,}",
    "date": EDGE_LEFT + r"(?:\d{4}-\d{2}-\d{2}|\d{2}\.\d{2}\.\d{4}|\d{2}/\d{2}/\d{4})" + EDGE_RIGHT,
    "ip": EDGE_LEFT + r"\d{1,3}\.\d{1,3}\.\d{1,3}\.\d{1,3}" + EDGE_RIGHT,
    "ssn": EDGE_LEFT + r"\d{3}-\d{2}-\d{4}" + EDGE_RIGHT,
    # digits in one piece or in the groups that cards have, so a number that follows is not taken in
    "card": EDGE_LEFT + r"(?:\d{13,19}|\d{4}[ -]\d{6}[ -]\d{5}|\d{4}[ -]\d{4}[ -]\d{4}[ -]\d{1,7})" + EDGE_RIGHT,
    "phone": r"(?<![0-9A-Za-z.+_-])(?:"
    r"\+1[ .-]?\(?\d{3}\)?[ .-]?\d{3}[ .-]?\d{4}"
    r"|\([2-9]\d{2}\) ?[2-9]\d{2}-\d{4}"
    r"|[2-9]\d{2}[.-][2-9]\d{2}[.-]\d{4}"
    r"|\+[2-9]\d(?:[ .-]?\d{2,4}){2,5})" + EDGE_RIGHT,
}
ANY = "|".join(PATTERNS.values())
DATE_FORMATS = {r"\d{4}-.*": "yyyy-MM-dd", r"\d{2}\..*": "dd.MM.yyyy", r"\d{2}/.*": "MM/dd/yyyy"}
ARRAY = "array<bigint>"


def _digits(value: Column) -> Column:
    return F.regexp_replace(value, "[^0-9]", "")


def _numbers(text: Column) -> Column:
    """The characters of a string of digits as numbers."""
    return F.filter(F.split(text, ""), lambda c: c != "").cast(ARRAY)


def _repeat(value: int, n: Column) -> Column:
    return F.array_repeat(F.lit(value).cast("bigint"), n.cast("int"))


def _luhn_sum(digits: Column, doubled: int) -> Column:
    """Luhn sum of an array of digits; places whose distance from the end has this parity are doubled."""
    last = F.size(digits) - 1

    def add(x: Column, i: Column) -> Column:
        twice = x * 2
        return F.when((last - i) % 2 == doubled, twice - F.when(twice > 9, 9).otherwise(0)).otherwise(x)

    return F.aggregate(F.transform(digits, add), F.lit(0).cast("bigint"), lambda a, x: a + x)


def _is(kind: str, value: Column) -> Column:
    return value.rlike("^(?:" + PATTERNS[kind] + ")$")


def _date(value: Column) -> Column:
    parts = [
        F.when(value.rlike(f"^{shape}$"), F.try_to_timestamp(value, F.lit(form)).cast("date"))
        for shape, form in DATE_FORMATS.items()
    ]
    return F.coalesce(*parts)


def _day(value: Column) -> Column:
    return F.datediff(_date(value), F.lit(FIRST_DAY).cast("date")).cast("bigint")


def _octets(value: Column) -> Column:
    return F.split(value, r"\.").cast(ARRAY)


def kind_of(value: Column) -> Column:
    """Kind of a found value, NULL if it is not valid."""
    card = _numbers(_digits(value))
    area = F.substring(value, 1, 3).cast("int")
    days = DAY_FACTORS[0] * DAY_FACTORS[1]
    n = F.length(_digits(value))
    return (
        F.when(_is("email", value), F.lit("email"))
        .when(_is("date", value), F.when((_day(value) >= 0) & (_day(value) < days), F.lit("date")))
        .when(_is("ip", value), F.when(F.forall(_octets(value), lambda o: o < 256), F.lit("ip")))
        .when(
            _is("ssn", value),
            F.when((area > 0) & (area < 900) & (area != 666) & ~value.rlike("-00-|-0000$"), F.lit("ssn")),
        )
        .when(value.startswith("+1"), F.when(n == 11, F.lit("phone")))
        .when(value.startswith("+"), F.when((n >= 8) & (n <= 15), F.lit("abroad")))
        .when(_is("card", value), F.when(_luhn_sum(card, 1) % 10 == 0, F.lit("card")))
        .when(_is("phone", value), F.lit("phone"))
    )


def _phone_floors(ten: Column) -> Column:
    """What the ten digits of a number start from: area and exchange stay with 2 to 9, or with 0 and 1."""
    floor = lambda at: F.when(F.substring(ten, at, 1) >= "2", 2).otherwise(0)
    return F.array(*[(floor(k + 1) if k in (0, 3) else F.lit(0)).cast("bigint") for k in range(10)])


def _symbols(kind: Column, value: Column) -> tuple[Column, Column]:
    """What is permuted, and the modulus of each symbol."""
    digits = _digits(value)
    body = F.substring(digits, F.lit(1), F.length(digits) - 1)
    ten = F.right(digits, F.lit(10))
    floors = _phone_floors(ten)
    free = F.transform(floors, lambda f, k: F.when(~k.isin(0, 3), 10).when(f == 2, 8).otherwise(2).cast("bigint"))
    area = F.substring(digits, 1, 3).cast("bigint")
    rest = F.substring(digits, F.lit(3), F.length(digits))
    local = F.lower(F.regexp_replace(F.substring_index(value, "@", 1), "[^A-Za-z0-9]", ""))
    signs = F.filter(F.split(local, ""), lambda c: c != "")
    sign = lambda c: F.when(c.rlike("[0-9]"), F.ascii(c) - 48).otherwise(F.ascii(c) - 97).cast("bigint")
    base = lambda c: F.when(c.rlike("[0-9]"), 10).otherwise(26).cast("bigint")
    day = _day(value)
    a, b = DAY_FACTORS
    serial = F.right(digits, F.lit(4)).cast("bigint") - 1
    group = F.substring(digits, 4, 2).cast("bigint") - 1
    symbols = {
        "card": (_numbers(body), _repeat(10, F.length(body))),
        "phone": (F.zip_with(_numbers(ten), floors, lambda x, y: x - y), free),
        "abroad": (_numbers(rest), _repeat(10, F.length(rest))),
        "ip": (_octets(value), _repeat(256, F.lit(4))),
        "ssn": (
            F.array(area - 1 - F.when(area > 666, 1).otherwise(0), group, serial),
            F.array(*[F.lit(x).cast("bigint") for x in (898, 99, 9999)]),
        ),
        "date": (
            F.array(F.floor(day / b).cast("bigint"), day % b),
            F.array(F.lit(a).cast("bigint"), F.lit(b).cast("bigint")),
        ),
        "email": (F.transform(signs, sign), F.transform(signs, base)),
    }
    pick = lambda k: reduce(lambda c, x: c.when(kind == x, symbols[x][k].cast(ARRAY)), symbols, F.when(F.lit(False), None))
    return pick(0), pick(1)


def feistel(values: Column, moduli: Column, key: str, tweak: Column, restore: bool = False) -> Column:
    """The keyed permutation of an array of numbers, each below its modulus. One symbol alone is permuted by itself."""
    half = F.floor(F.size(values) / 2).cast("int")
    cut = lambda x: (F.slice(x, F.lit(1), half), F.slice(x, half + 1, F.size(x) - half))
    (left, right), (left_mod, right_mod) = cut(values), cut(moduli)
    sign = -1 if restore else 1

    def add(mine: Column, mods: Column, other: Column, step: Column, side: str) -> Column:
        seed = F.concat_ws("|", F.lit(key), tweak, F.lit(side), step.cast("string"), F.array_join(other.cast("array<string>"), ","))
        pairs = F.zip_with(mine, mods, lambda x, m: F.struct(x.alias("x"), m.alias("m")))

        def shift(pair: Column, i: Column, seed: Column) -> Column:
            word = F.substring(F.sha2(F.concat_ws("|", seed, i.cast("string")), 256), 1, 12)
            number = F.conv(word, 16, 10).cast("bigint")
            return F.pmod(pair["x"] + sign * (number % pair["m"]), pair["m"])

        return let(seed, lambda s: F.transform(pairs, lambda pair, i: shift(pair, i, s)))

    def turn(state: Column, step: Column) -> Column:
        if restore:
            old = add(state["r"], right_mod, state["l"], step, "r")
            return let(old, lambda r: F.struct(add(state["l"], left_mod, r, step, "l").alias("l"), r.alias("r")))
        new = add(state["l"], left_mod, state["r"], step, "l")
        return let(new, lambda x: F.struct(x.alias("l"), add(state["r"], right_mod, x, step, "r").alias("r")))

    steps = F.sequence(F.lit(ROUNDS), F.lit(1)) if restore else F.sequence(F.lit(1), F.lit(ROUNDS))
    start = F.struct(left.cast(ARRAY).alias("l"), right.cast(ARRAY).alias("r"))
    return F.aggregate(steps, start, turn, lambda s: F.concat(s["l"], s["r"]))


def _written_over(value: Column, signs: Column, pattern: str) -> Column:
    """``value`` with its characters of this kind replaced in order by ``signs``; letters keep their case."""
    before = lambda i: F.length(F.regexp_replace(F.substring(value, F.lit(1), i + 1), f"[^{pattern}]", "")) - 1

    def write(c: Column, i: Column) -> Column:
        new = F.get(signs, before(i))
        return F.when(~c.rlike(f"[{pattern}]"), c).when(c.rlike("[A-Z]"), F.upper(new)).otherwise(new)

    characters = F.filter(F.split(value, ""), lambda c: c != "")
    return F.array_join(F.transform(characters, write), "")


def _formatted(kind: Column, value: Column, new: Column) -> Column:
    digits, strings = _digits(value), new.cast("array<string>")
    check = F.pmod(10 - _luhn_sum(new, 0) % 10, F.lit(10)).cast("string")
    lead = F.substring(digits, F.lit(1), F.length(digits) - 10)
    ten = F.zip_with(new, _phone_floors(F.right(digits, F.lit(10))), lambda x, y: x + y).cast("array<string>")
    area = new[0] + 1 + F.when(new[0] + 1 >= 666, 1).otherwise(0)
    ssn = F.concat(F.lpad(area.cast("string"), 3, "0"), F.lpad((new[1] + 1).cast("string"), 2, "0"), F.lpad((new[2] + 1).cast("string"), 4, "0"))
    day = F.date_add(F.lit(FIRST_DAY).cast("date"), (new[0] * DAY_FACTORS[1] + new[1]).cast("int"))
    date = F.coalesce(*[F.when(value.rlike(f"^{shape}$"), F.date_format(day, form)) for shape, form in DATE_FORMATS.items()])
    letters = F.split(F.lit(LETTERS), "")
    local, domain = F.substring_index(value, "@", 1), F.substring_index(value, "@", -1)
    old = F.filter(F.split(F.lower(F.regexp_replace(local, "[^A-Za-z0-9]", "")), ""), lambda c: c != "")
    signs = F.zip_with(old, new, lambda c, x: F.when(c.rlike("[0-9]"), x.cast("string")).otherwise(F.get(letters, x.cast("int"))))
    over = lambda text: _written_over(value, F.filter(F.split(text, ""), lambda c: c != ""), "0-9")
    return (
        F.when(kind == "card", over(F.concat(F.array_join(strings, ""), check)))
        .when(kind == "phone", over(F.concat(lead, F.array_join(ten, ""))))
        .when(kind == "abroad", over(F.concat(F.substring(digits, 1, 2), F.array_join(strings, ""))))
        .when(kind == "ip", F.array_join(strings, "."))
        .when(kind == "ssn", over(ssn))
        .when(kind == "date", date)
        .when(kind == "email", F.concat(_written_over(local, signs, "A-Za-z0-9"), F.lit("@"), domain))
        .otherwise(value)
    )


def pseudonym(value: Column, kind: Column, key: str, restore: bool = False) -> Column:
    """The pseudonym of one validated value."""
    symbols, moduli = _symbols(kind, value)
    parts = F.struct(symbols.alias("x"), moduli.alias("m"))
    permuted = let(parts, lambda p: feistel(p["x"], p["m"], key, kind, restore))
    return let(permuted, lambda new: _formatted(kind, value, new))


def pseudonymise(df: DataFrame, key: str, text: str = "text", restore: bool = False) -> DataFrame:
    """``df`` with every valid value in ``text`` replaced, plus ``n_values``, how many; a column of that name gives way.

    With ``restore`` pseudonyms made with the same key become the values they stand for.
    """
    source = F.col(f"`{text}`")
    found = F.when(source.rlike("[0-9@]"), F.regexp_extract_all(source, F.lit(ANY), F.lit(0)))
    with_kinds = F.transform(found, lambda v: F.struct(v.alias("value"), kind_of(v).alias("kind")))
    names = {c.lower() for c in df.columns}
    spare = next(f"found{i}" for i in range(len(names) + 1) if f"found{i}" not in names)
    staged = df.withColumn(spare, with_kinds)
    matches = F.col(spare)
    new = F.transform(matches, lambda m: F.when(m["kind"].isNull(), m["value"]).otherwise(pseudonym(m["value"], m["kind"], key, restore)))
    pieces = F.split(source, ANY, -1)
    woven = F.zip_with(pieces, F.concat(new, F.array(F.lit(""))), lambda p, n: F.concat(p, n))
    n = F.coalesce(F.size(F.filter(matches, lambda m: m["kind"].isNotNull())), F.lit(0))
    valid = F.when(matches.isNull(), F.lit(0)).otherwise(n)
    columns = {text: F.when(valid > 0, F.array_join(woven, "")).otherwise(source)}
    out = with_results(staged, n_values=valid.cast("long"))
    return out.withColumns(columns).drop(spare)
