"""Format-preserving pseudonyms for personal numbers, dates and addresses, in SQL functions only.

Validated values are replaced by keyed permutations of the values of their format: Feistel networks
whose round function is a digest of the key, the kind of value, the round and the other half. Equal
values get equal pseudonyms in every document, different ones of a kind get different ones, and the
key holder can undo them.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

ROUNDS = 8
# Values are looked for from left to right; kinds are told apart by their form afterwards.
# An email's name is all from its first letter or digit on that white space, brackets, quotes and marks
# that part values leave of it; letters may be of any script.
EMAIL = (
    r"(?<![\p{L}\p{N}])[\p{L}\p{N}][^\s\p{Z}()<>\[\]{}\"“”„«»,;:/=|@\\]*+"
    r"@[\p{L}\p{N}](?:[\p{L}\p{M}\p{N}-]*[\p{L}\p{N}])?(?:\.[\p{L}\p{M}\p{N}-]+)+"
)
GAP = "[ \u00a0\u202f-]"  # between groups of digits: a space, one that does not break, a dash
# In one piece, or in groups of four.
IBAN = r"[A-Z]{2}\d{2}(?:[A-Z0-9]{11,30}|(?:[ \u00a0][A-Z0-9]{4}){2,7}(?:[ \u00a0][A-Z0-9]{1,3})?)"
ADDRESS = r"\d{1,3}\.\d{1,3}\.\d{1,3}\.\d{1,3}"
DATE = r"\d{4}-\d{1,2}-\d{1,2}|\d{1,2}[./]\d{1,2}[./]\d{4}"
DATE_END = r"(?!(?!(?<=-\d\d)T\d)[\w/-]|\.\d)"  # of a timestamp the date only
SOCIAL = r"\d{3}-\d{2}-\d{4}"
# Any digits where a sign, brackets or separators tell a phone number, real area codes where nothing does.
PHONE = (
    r"(?:\+?1[ .-]?)?(?:\(\d{3}\) ?|\d{3}[ .-])\d{3}[ .-]\d{4}"
    r"|(?:\+?1[ .-]?)?\(\d{3}\) ?\d{7}|\+1[ .-]?\d{10}|1?[2-9]\d{2}[2-9]\d{6}"
)
NOT_CARD = (
    rf"{EMAIL}|(?:{ADDRESS})(?![\w]|\.\d)|(?:{DATE}){DATE_END}|(?:{SOCIAL}|{PHONE})(?![\w-])"
)
# Groups of digits up to the next value of another kind; which of them are cards is found later.
RUN = rf"(?=\d(?:{GAP}?\d){{12}})\d++(?!\w)(?:{GAP}(?!{NOT_CARD})\d++(?!\w))*+"
FOUND = (
    rf"{EMAIL}|(?<!\w)(?:{IBAN})(?!\w)|(?<![\w.])(?:{ADDRESS})(?![\w]|\.\d)|(?<![\w./-])(?:{DATE}){DATE_END}"
    rf"|(?<![\w-])(?:{SOCIAL})(?![\w-])|(?<!\w)(?:{PHONE})(?!\w)|(?<![\w.]){RUN}"
)
# Usual groupings of cards, then rarer ones; "x" stands for a space or dash.
CARD_FORMS = (
    r"\d{13,19}|\d{4}x\d{4}x\d{4}x\d{4}|\d{4}x\d{6}x\d{4,5}".replace("x", GAP),
    r"(?:\d{4}x){3,4}\d{1,3}|\d{4}x\d{3}x\d{3}x\d{3}|\d{6}x\d{7,13}".replace("x", GAP),
)
# Cheap test for texts that cannot hold any value.
LIKELY = r"\d[\d \u00a0\u202f./()-]{5}|@|[A-Z]{2}\d{2}"
FIRST_DAY = "1900-01-01"
DAYS = (252, 290)  # 73,080 days, to 2100-01-31
HALF_DAYS = DAYS[0] * DAYS[1]


def _number(text: Column) -> Column:
    return text.cast("bigint")


def _shift(key: str, kind: str, turn: Column, other: Column) -> Column:
    """A number below 2**60 from the key, the kind, the round and the other half."""
    material = F.concat_ws("|", F.lit(key), F.lit(kind), turn.cast("string"), other.cast("string"))
    return F.conv(F.substring(F.sha2(material, 256), 1, 15), 16, 10).cast("bigint")


def permuted(left: Column, right: Column, sizes: tuple[int, int], key: str, kind: str) -> Column:
    """A permutation of the pairs (left, right) below ``sizes``, as a struct of both."""

    def turned(state: Column, turn: Column) -> Column:
        a = (state["a"] + _shift(key, kind, turn, state["b"])) % sizes[0]
        b = (state["b"] + _shift(key, kind, turn, state["a"])) % sizes[1]
        even = turn % 2 == 0
        return F.struct(
            F.when(even, a).otherwise(state["a"]).alias("a"),
            F.when(even, state["b"]).otherwise(b).alias("b"),
        )

    start = F.struct(left.cast("bigint").alias("a"), right.cast("bigint").alias("b"))
    return F.aggregate(F.sequence(F.lit(0), F.lit(ROUNDS - 1)), start, turned)


def _characters(text: Column) -> Column:
    return F.filter(F.split(text, ""), lambda c: c != "")


# Letters that follow each other in the same script and case: (first, last) of each run.
LETTER_RUNS = [
    ("\u00c0", "\u00d6"),
    ("\u00d8", "\u00de"),
    ("\u00df", "\u00f6"),
    ("\u00f8", "\u00ff"),
    ("\u0100", "\u017f"),
    ("\u0391", "\u03a1"),
    ("\u03b1", "\u03c9"),
    ("\u0410", "\u042f"),
    ("\u0430", "\u044f"),
    ("\u0450", "\u045f"),
    ("\u05d0", "\u05ea"),
    ("\u0620", "\u064a"),
    ("\u0905", "\u0939"),
    ("\u0e01", "\u0e2e"),
    ("\u3041", "\u3096"),
    ("\u30a1", "\u30fa"),
    ("\u4e00", "\u9fff"),
    ("\uac00", "\ud7a3"),
]


def _char(code: Column) -> Column:
    return F.decode(F.unhex(F.lpad(F.hex(code.cast("long")), 8, "0")), "UTF-32")


def _moved(character: Column, by: Column) -> Column:
    """The character moved on in its own class: digits, lower case, upper case, a run of letters of
    another script, or else a block of 16 letters; other characters stay."""
    code = F.ascii(character)

    def within(first: str, last: str) -> Column:
        size = ord(last) - ord(first) + 1
        step = by if size <= 256 else by * 83
        moved = (code - ord(first) + step) % size + ord(first)
        return F.char(moved) if ord(last) < 128 else _char(moved)

    other = F.when(character.rlike(r"\p{L}"), _char(code - code % 16 + (code + by) % 16)).otherwise(character)
    for first, last in LETTER_RUNS:
        other = F.when(code.between(ord(first), ord(last)), within(first, last)).otherwise(other)
    return (
        F.when(character.between("0", "9"), within("0", "9"))
        .when(character.between("a", "z"), within("a", "z"))
        .when(character.between("A", "Z"), within("A", "Z"))
        .when(code > 127, other)
        .otherwise(character)
    )


def permuted_text(text: Column, key: str, kind: str) -> Column:
    """A permutation of the texts of the same form: each character keeps its class and place.

    The two halves take turns; each character moves by a byte of the digest of the other half.
    """

    def moved(half: Column, other: Column, turn: Column) -> Column:
        digest = F.sha2(
            F.concat_ws("|", F.lit(key), F.lit(kind), turn.cast("string"), F.array_join(other, "")), 256
        )
        return F.transform(
            half,
            lambda c, i: _moved(
                c, F.conv(F.substr(digest, (i % 32) * 2 + 1, F.lit(2)), 16, 10).cast("int")
            ),
        )

    def turned(state: Column, turn: Column) -> Column:
        even = turn % 2 == 0
        return F.struct(
            F.when(even, moved(state["a"], state["b"], turn)).otherwise(state["a"]).alias("a"),
            F.when(even, state["b"]).otherwise(moved(state["b"], state["a"], turn)).alias("b"),
        )

    length = F.char_length(text)
    half = F.floor(length / 2).cast("int")
    start = F.struct(
        _characters(F.substr(text, F.lit(1), half)).alias("a"),
        _characters(F.substr(text, half + 1, length)).alias("b"),
    )
    end = F.aggregate(F.sequence(F.lit(0), F.lit(ROUNDS - 1)), start, turned)
    return F.concat(F.array_join(end["a"], ""), F.array_join(end["b"], ""))


def _luhn_sum(digits: Column, length: Column) -> Column:
    """The check sum in which the last digit counts once, the one before it twice, and so on."""

    def worth(c: Column, i: Column) -> Column:
        doubled = c.cast("int") * F.when((length - i) % 2 == 0, 2).otherwise(1)
        return F.when(doubled > 9, doubled - 9).otherwise(doubled)

    return F.aggregate(
        F.transform(_characters(digits), worth), F.lit(0), lambda total, x: total + x.cast("int")
    )


def _refilled(form: Column, filling: Column, places: str = "[0-9]") -> Column:
    """``form`` with its digits, or other ``places``, replaced by the characters of ``filling``, in order."""

    def put(state: Column, c: Column) -> Column:
        is_place = c.rlike(f"^{places}$")
        return F.struct(
            F.concat(
                state["out"],
                F.when(is_place, F.substr(filling, state["at"], F.lit(1))).otherwise(c),
            ).alias("out"),
            (state["at"] + F.when(is_place, 1).otherwise(0)).cast("int").alias("at"),
        )

    start = F.struct(F.lit("").alias("out"), F.lit(1).cast("int").alias("at"))
    return F.aggregate(_characters(form), start, put)["out"]


def _digits(text: Column) -> Column:
    return F.regexp_replace(text, r"\D", "")


def _padded(number: Column, width: int) -> Column:
    return F.lpad(number.cast("string"), width, "0")


def _once(value: Column, use) -> Column:
    """``use(value)``, with the value computed once however often it is used."""
    return F.transform(F.array(value), use)[0]


def _cards(groups: Column) -> Column:
    """(first, last, text) of the cards among ``groups``, the digits of a run with what follows each.

    Every part of 13 to 19 digits with a right check digit may be one: in the groupings of cards
    anywhere, in others where it begins or ends the run. Of those that overlap, usual groupings go
    first, then those that begin with 3 to 6, then the leftmost and longest.
    """
    last = F.size(groups) - 1

    def part(i: Column, j: Column) -> Column:
        text = F.regexp_replace(F.array_join(F.slice(groups, i + 1, j - i + 1), ""), f"{GAP}$", "")
        return _once(text, lambda text: formed(text, i, j))

    def formed(text: Column, i: Column, j: Column) -> Column:
        form = (
            F.when(text.rlike(f"^(?:{CARD_FORMS[0]})$"), 0)
            .when(text.rlike(f"^(?:{CARD_FORMS[1]})$"), 1)
            .when((i == 0) | (j == last), 2)
        )
        return F.struct(
            form.alias("form"),
            F.when(text.rlike("^[3-6]"), 0).otherwise(1).alias("other"),
            i.alias("first"),
            (-j).alias("less"),
            j.alias("last"),
            text.alias("text"),
        )

    parts = F.flatten(
        F.transform(
            F.sequence(F.lit(0), last),
            lambda i: F.transform(F.sequence(i, F.least(i + 18, last)), lambda j: part(i, j)),
        )
    )

    def is_card(x: Column) -> Column:
        def right(digits: Column) -> Column:
            return _once(F.char_length(digits), lambda n: n.between(13, 19) & (_luhn_sum(digits, n) % 10 == 0))

        return x["form"].isNotNull() & _once(_digits(x["text"]), right)

    def added(chosen: Column, x: Column) -> Column:
        apart = F.forall(chosen, lambda y: (x["last"] < y["first"]) | (x["first"] > y["last"]))
        return F.when(apart, F.concat(chosen, F.array(x))).otherwise(chosen)

    kind = "array<struct<form:int,other:int,first:int,less:int,last:int,text:string>>"
    found = F.array_sort(F.filter(parts, is_card)).cast(kind)
    return F.aggregate(found, F.array().cast(kind), added)


def cards_replaced(run: Column, key: str) -> Column:
    """``run`` with its cards replaced as ``text``, and ``n``, how many of them changed."""

    def replaced(groups: Column) -> Column:
        made = F.transform(
            _cards(groups),
            lambda x: F.struct(
                x["first"].alias("first"),
                x["last"].alias("last"),
                x["text"].alias("old"),
                card_pseudonym(x["text"], key).alias("new"),
            ),
        )
        return _once(made, lambda made: with_new(groups, made))

    def with_new(groups: Column, made: Column) -> Column:
        def piece(group: Column, i: Column) -> Column:
            own = F.filter(made, lambda x: i.between(x["first"], x["last"]))
            end = F.regexp_extract(group, rf"\d+({GAP}?)$", 1)
            new = F.when(i == own[0]["first"], own[0]["new"]).otherwise("")
            ended = F.when(i == own[0]["last"], end).otherwise("")
            return F.when(F.size(own) == 0, group).otherwise(F.concat(new, ended))

        return F.struct(
            F.array_join(F.transform(groups, piece), "").alias("text"),
            F.size(F.filter(made, lambda x: x["old"] != x["new"])).alias("n"),
        )

    return _once(F.regexp_extract_all(run, F.lit(rf"\d+{GAP}?"), 0), replaced)


def card_pseudonym(value: Column, key: str) -> Column:
    """The first digit stays, the check digit is made anew, the digits between are permuted."""
    digits = _digits(value)
    length = F.char_length(digits)
    inner = permuted_text(F.substr(digits, F.lit(2), length - 2), key, "card")
    body = F.concat(F.substr(digits, F.lit(1), F.lit(1)), inner)
    check = (F.lit(10) - _luhn_sum(F.concat(body, F.lit("0")), length) % 10) % 10
    return _refilled(value, F.concat(body, check.cast("string")))


def phone_pseudonym(value: Column, key: str) -> Column:
    """Any ten digits among all; a leading 1 stays.

    Area and exchange both of 200 and above stay so, others stay others: a number without
    punctuation is still one afterwards.
    """
    digits = F.right(_digits(value), F.lit(10))
    area, exchange, line = (
        _number(F.substr(digits, F.lit(a), F.lit(n))) for a, n in ((1, 3), (4, 3), (7, 4))
    )
    real = (area >= 200) & (exchange >= 200)
    new = permuted((area - 200) * 800 + exchange - 200, line, (640_000, 10_000), key, "phone")
    real_six = F.floor(new["a"] / 800) * 1000 + 200_000 + new["a"] % 800 + 200
    # The others in order: 200 areas with every exchange, then 800 with 200 exchanges each.
    place = F.when(area < 200, area * 1000 + exchange).otherwise(200_000 + (area - 200) * 200 + exchange)
    other = permuted(place, line, (360_000, 10_000), key, "other phone")
    rest = other["a"] - 200_000
    other_six = F.when(rest < 0, other["a"]).otherwise(
        F.floor(rest / 200) * 1000 + 200_000 + rest % 200
    )
    ten = F.when(real, F.concat(_padded(real_six, 6), _padded(new["b"], 4))).otherwise(
        F.concat(_padded(other_six, 6), _padded(other["b"], 4))
    )
    return _refilled(value, F.concat(F.regexp_extract(_digits(value), r"^(\d*)\d{10}$", 1), ten))


def address_pseudonym(value: Column, key: str) -> Column:
    """An IPv4 address among all of them, written without leading zeros."""
    part = [_number(F.split_part(value, F.lit("."), F.lit(i))) for i in (1, 2, 3, 4)]
    new = permuted(part[0] * 256 + part[1], part[2] * 256 + part[3], (65_536, 65_536), key, "address")
    whole = [F.floor(new["a"] / 256), new["a"] % 256, F.floor(new["b"] / 256), new["b"] % 256]
    return F.concat_ws(".", *[w.cast("string") for w in whole])


def social_pseudonym(value: Column, key: str) -> Column:
    """Area 001 to 899 without 666, group 01 to 99, serial 0001 to 9999."""
    area, group, serial = (_number(F.split_part(value, F.lit("-"), F.lit(i))) for i in (1, 2, 3))
    place = area - 1 - F.when(area > 666, 1).otherwise(0)
    new = permuted(place * 99 + group - 1, serial - 1, (898 * 99, 9_999), key, "social")
    area = F.floor(new["a"] / 99) + 1
    area = area + F.when(area >= 666, 1).otherwise(0)
    return F.concat_ws("-", _padded(area, 3), _padded(new["a"] % 99 + 1, 2), _padded(new["b"] + 1, 4))


def _day(value: Column) -> Column:
    """Days since the first day, or null for what is no date. Day before month unless only the other
    way round gives a date."""
    as_iso = F.try_to_date(value, "yyyy-M-d")
    dotted = F.try_to_date(value, "d.M.yyyy")
    slashed = F.coalesce(F.try_to_date(value, "d/M/yyyy"), F.try_to_date(value, "M/d/yyyy"))
    date = (
        F.when(value.contains("-"), as_iso).when(value.contains("/"), slashed).otherwise(dotted)
    )
    return F.datediff(date, F.lit(FIRST_DAY).cast("date"))


def date_pseudonym(value: Column, key: str) -> Column:
    """A day from 1900 to January 2100, in the form of the value.

    A day or month of one digit is written without a leading zero, with two digits if it needs them.
    """
    days = _day(value)
    new = permuted(F.floor(days / DAYS[1]), days % DAYS[1], DAYS, key, "date")
    date = F.date_add(F.lit(FIRST_DAY).cast("date"), (new["a"] * DAYS[1] + new["b"]).cast("int"))
    parts = F.split(value, "[./-]")

    def two(field: Column, place: int) -> Column:
        return F.when(F.char_length(parts[place]) == 1, field.cast("string")).otherwise(_padded(field, 2))

    year, month, day = _padded(F.year(date), 4), F.month(date), F.day(date)
    dayfirst = F.array(two(day, 0), two(month, 1), year)
    return (
        F.when(value.contains("-"), F.concat_ws("-", year, two(month, 1), two(day, 2)))
        .when(value.contains("."), F.array_join(dayfirst, "."))
        .when(F.try_to_date(value, "d/M/yyyy").isNotNull(), F.array_join(dayfirst, "/"))
        .otherwise(F.concat_ws("/", two(month, 0), two(day, 1), year))
    )


def email_pseudonym(value: Column, key: str) -> Column:
    """The name is permuted within its form, the domain stays."""
    name = F.regexp_extract(value, "^([^@]*)@", 1)
    domain = F.regexp_extract(value, "(@.*)$", 1)
    return F.concat(permuted_text(name, key, "email"), domain)


def _iban_rest(text: Column) -> Column:
    """The number of an account, its country and check digits moved to its end, modulo 97."""
    compact = F.regexp_replace(text, r"[^A-Z0-9]", "")
    turned = F.concat(F.substr(compact, F.lit(5), F.lit(34)), F.substr(compact, F.lit(1), F.lit(4)))

    def add(rest: Column, c: Column) -> Column:
        letter = c.between("A", "Z")
        worth = F.when(letter, F.ascii(c) - 55).otherwise(F.ascii(c) - 48)
        return ((rest * F.when(letter, 100).otherwise(10) + worth) % 97).cast("int")

    return F.aggregate(_characters(turned), F.lit(0), add)


def _iban_of(value: Column) -> Column:
    """The longest of the first groups of ``value`` that is an account number with right check digits, or
    null: what follows it may look like one more group."""
    groups = F.split(value, "[ \u00a0]")

    def first(k: Column) -> Column:
        shorter = F.aggregate(F.slice(groups, 1, k), F.lit(-1), lambda n, g: n + F.char_length(g) + 1)
        return F.substr(value, F.lit(1), shorter)

    ends = F.transform(F.sequence(F.size(groups), F.lit(1), F.lit(-1)), first)
    long = F.filter(ends, lambda x: F.char_length(F.regexp_replace(x, "[^A-Z0-9]", "")).between(15, 34))
    return F.get(F.filter(long, lambda x: _iban_rest(x) == 1), F.lit(0))


def iban_pseudonym(value: Column, key: str) -> Column:
    """The country stays, the account is permuted within its form, the check digits are made anew."""

    def made(own: Column) -> Column:
        compact = F.regexp_replace(own, r"[^A-Z0-9]", "")
        country = F.substr(compact, F.lit(1), F.lit(2))
        account = permuted_text(F.substr(compact, F.lit(5), F.lit(34)), key, "iban")
        check = _padded(F.lit(98) - _iban_rest(F.concat(country, F.lit("00"), account)), 2)
        new = _refilled(own, F.concat(country, check, account), "[A-Z0-9]")
        return F.concat(new, F.substr(value, F.char_length(own) + 1, F.lit(40)))

    return _once(_iban_of(value), made)


def kind_of(value: Column) -> Column:
    """`email`, `iban`, `address`, `date`, `social`, `phone`, `card`, or null for what is not valid.

    A `card` is a run of digits long enough for one; ``cards_replaced`` finds those with a right
    check digit.
    """
    length = F.char_length(_digits(value))
    days = _day(value)
    octets = F.forall(F.split(value, r"\."), lambda part: _number(part) <= 255)
    parts = [F.split_part(value, F.lit("-"), F.lit(i)) for i in (1, 2, 3)]
    issued = (parts[0] != "000") & (parts[0] != "666") & (parts[0] < "900")
    issued = issued & (parts[1] != "00") & (parts[2] != "0000")
    return (
        F.when(value.contains("@"), "email")
        .when(value.rlike("^[A-Z]"), F.when(_iban_of(value).isNotNull(), "iban"))
        .when(value.rlike(f"^(?:{ADDRESS})$"), F.when(octets, "address"))
        .when(value.rlike(f"^(?:{DATE})$"), F.when(days.between(0, HALF_DAYS - 1), "date"))
        .when(value.rlike(f"^(?:{SOCIAL})$"), F.when(issued, "social"))
        .when(value.rlike(f"^(?:{PHONE})$"), "phone")
        .when(length >= 13, "card")
    )


def pseudonym(value: Column, key: str) -> Column:
    """The pseudonym of a value as ``text``, or the value itself when it is not valid, and ``n``, how
    many values changed: more than 1 only for cards one after the other."""
    kind = kind_of(value)
    made = {
        "email": email_pseudonym,
        "iban": iban_pseudonym,
        "address": address_pseudonym,
        "date": date_pseudonym,
        "social": social_pseudonym,
        "phone": phone_pseudonym,
    }

    def counted(new: Column) -> Column:
        return F.struct(new.alias("text"), F.when(new != value, 1).otherwise(0).alias("n"))

    text = value
    for name, make in made.items():
        text = F.when(kind == name, make(value, key)).otherwise(text)
    return F.when(kind == "card", cards_replaced(value, key)).otherwise(_once(text, counted))


def pseudonymised(docs: DataFrame, key: str) -> DataFrame:
    """``docs`` with personal values in ``text`` replaced, and ``n_replaced``; no shuffle.

    Emails (the name, of letters of any script), account numbers (IBAN) with right check digits, IPv4
    addresses, dates (year-month-day with dashes, day first with dots or slashes), US social security
    and phone numbers, and card numbers with a right check digit, also with spaces that do not break.
    What only looks like one stays. Null texts stay null with 0 replaced; texts without values are not touched. An
    input column n_replaced is replaced.
    """
    docs = docs.drop("n_replaced")
    text = F.col("text")
    likely = F.coalesce(text.rlike(LIKELY), F.lit(False))
    values = F.when(likely, F.regexp_extract_all(text, F.lit(FOUND), 0)).otherwise(
        F.array().cast("array<string>")
    )
    new = F.transform("_values", lambda value: pseudonym(value, key))
    pieces = F.split(text, FOUND, -1)
    joined = F.array_join(
        F.zip_with(pieces, F.col("_new"), lambda a, b: F.concat(a, F.coalesce(b["text"], F.lit("")))), ""
    )
    changed = F.aggregate("_new", F.lit(0), lambda total, x: total + x["n"])
    return (
        docs.withColumn("_values", values)
        .withColumn("_new", new)
        .withColumn("n_replaced", changed)
        .withColumn("text", F.when(F.col("n_replaced") > 0, joined).otherwise(text))
        .drop("_values", "_new")
    )
