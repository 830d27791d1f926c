"""Format-preserving pseudonyms for personal data: a keyed Feistel permutation inside each value's own format.

Card numbers whose check digit is right and account numbers (IBANs) whose check digits are right keep their length and
separators and stay right; other runs of digits (order numbers, times) are no such numbers and stay as they are. Dates stay valid
dates, and what is no date stays; addresses, telephone numbers and tokens keep their shape. Equal values get equal pseudonyms in every document, however
they are separated, and different ones different pseudonyms. Everything is built from SQL functions.
"""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millrace.llm.common import let

ROUNDS = 10
_OCTET = r"(?:25[0-5]|2[0-4]\d|1\d\d|[1-9]?\d)"
_ALONE, _END = r"(?<![0-9A-Za-z])", r"(?![0-9A-Za-z])"
EMAIL = r"(?<![\p{L}\p{N}._%+-])[\p{L}\p{N}._%+-]++@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+"
ISO_DATE = rf"{_ALONE}(?<!-)\d{{4}}-\d{{2}}-\d{{2}}{_END}(?!-\d)"
DOTTED_DATE = rf"{_ALONE}(?<!\.)\d{{2}}\.\d{{2}}\.\d{{4}}{_END}(?!\.\d)"
SLASHED_DATE = rf"{_ALONE}(?<!/)\d{{2}}/\d{{2}}/\d{{4}}{_END}(?!/\d)"
PHONE = rf"{_ALONE}(?:\+\d{{1,3}}[ -]?(?:\(\d{{2,4}}\)|\d{{2,4}})[ -]?\d{{3,4}}[ -]?\d{{3,4}}|\(\d{{3}}\) ?\d{{3}}-\d{{4}}|\d{{3}}-\d{{3}}-\d{{4}}){_END}"
SOCIAL = rf"{_ALONE}(?<!-)\d{{3}}-\d{{2}}-\d{{4}}{_END}(?!-\d)"
CARD = rf"{_ALONE}(?:\d{{13,19}}|\d{{4}} \d{{4}} \d{{4}} \d{{1,7}}|\d{{4}}-\d{{4}}-\d{{4}}-\d{{1,7}}|\d{{4}} \d{{6}} \d{{5}}|\d{{4}}-\d{{6}}-\d{{5}}){_END}"
#: Countries with IBANs by the length of an IBAN; it is written in one piece or in groups of four.
IBAN_COUNTRIES = {
    15: "NO", 16: "BE", 18: "DK FI FK FO GL NL SD", 19: "MK SI", 20: "AT BA EE KZ LT LU MN XK", 21: "CH HR LI LV", 22: "BG BH CR DE GB GE IE ME RS VA",
    23: "AE GI IL IQ OM SO TL", 24: "AD CZ DZ ES MD PK RO SA SE SK TN VG", 25: "AO CV LY MZ PT ST", 26: "IS TR", 27: "BI DJ FR GR IT MC MR SM",
    28: "AL AZ BY CY DO GT HU LB NI PL SV", 29: "BR EG PS QA UA", 30: "JO KW MU YE", 31: "MT SC", 32: "LC", 33: "RU",
}


def _iban(length: int, countries: str) -> str:
    groups, tail = divmod(length - 4, 4)
    spaced = rf"(?: [0-9A-Z]{{4}}){{{groups}}}" + (rf" [0-9A-Z]{{{tail}}}" if tail else "")
    return rf"(?:{countries.replace(' ', '|')})\d{{2}}(?:[0-9A-Z]{{{length - 4}}}|{spaced})"


IBAN = rf"{_ALONE}(?:{'|'.join(_iban(n, c) for n, c in IBAN_COUNTRIES.items())}){_END}"
ADDRESS = rf"{_ALONE}(?<!\d\.){_OCTET}(?:\.{_OCTET}){{3}}{_END}(?!\.\d)"
TOKEN = rf"{_ALONE}(?:[0-9a-f]{{32,128}}|[0-9A-F]{{32,128}}){_END}"
ANY = "|".join(f"(?:{p})" for p in (EMAIL, IBAN, ISO_DATE, DOTTED_DATE, SLASHED_DATE, PHONE, SOCIAL, CARD, ADDRESS, TOKEN))
#: Country codes of telephone numbers; all others have three digits. Their digits may be separated.
COUNTRY_CODES = ("[17]", "2[07]", "3[0-469]", "4[013-9]", "5[1-8]", "6[0-6]", "8[1246]", "9[0-58]", "[0-9][0-9][0-9]")
COUNTRY = r"^\+(?:" + "|".join(r"[ ()-]*".join(re.findall(r"\[.*?\]|\d", c)) for c in COUNTRY_CODES) + ")"

DIGITS, LOWER, UPPER = "0123456789", "abcdefghijklmnopqrstuvwxyz", "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
#: Months and days in the 400 years after which the calendar repeats, and the day 0000-01-01.
MONTHS, CYCLE, YEAR_ZERO = 4_800, 146_097, -719_528
#: Days of a month that can be read as a month too. They and the later days of 400 years as products of two numbers.
EARLY = 12
EARLY_PARTS, LATE_PARTS = (240, 240), (9, 9_833)
#: Code points that lie in one alphabet; more where one block has a single letter (U+2E2F).
ALPHABET, WIDE_ALPHABET, WIDE = 128, 1_024, 0x2C00


def feistel(items: Column, sizes: Column, tweak: Column, key: str) -> Column:
    """Permute ``items`` (array of int, each below its entry of ``sizes``): halves take turns being shifted by a keyed hash of
    the other. One item alone is shifted by the hash of the tweak, never by nothing. A bijection for each tweak, length and sizes."""
    half = F.floor(F.size(items) / 2).cast("int")

    def turn(state: Column, r: Column) -> Column:
        right = r % 2 == 0
        source = F.when(right, F.slice(state, F.lit(1), half)).otherwise(F.slice(state, half + 1, F.size(state) - half))

        def shifted(digest: Column) -> Column:
            def one(x: Column, i: Column) -> Column:
                k = F.when(right, i - half).otherwise(i) % 32
                shift = F.conv(F.substring(digest, k * 4 + 1, F.lit(4)), 16, 10).cast("int")
                return F.when((i >= half) == right, F.pmod(x + shift, F.get(sizes, i))).otherwise(x)

            return F.transform(state, one)

        return let(F.sha2(F.concat_ws("|", F.lit(key), tweak, r.cast("string"), F.array_join(source, ",")), 512), shifted)

    def alone(x: Column) -> Column:
        shift = F.conv(F.substring(F.sha2(F.concat_ws("|", F.lit(key), tweak), 512), 1, 4), 16, 10).cast("int")
        return F.pmod(x + 1 + F.pmod(shift, F.get(sizes, F.lit(0)) - 1), F.get(sizes, F.lit(0)))

    return F.when(F.size(items) == 1, F.transform(items, alone)).otherwise(F.aggregate(F.sequence(F.lit(0), F.lit(ROUNDS - 1)), items, turn))


def _permuted_characters(value: Column, alphabet, tweak: Column, key: str) -> Column:
    """``value`` with those characters permuted that have an alphabet (``alphabet(character)``: a string or null)."""

    def of(chars: Column) -> Column:
        def at(places: Column) -> Column:
            letters = F.transform(places, lambda i: alphabet(chars[i]))

            def permuted(letters: Column) -> Column:
                items = F.transform(places, lambda i, k: (F.instr(F.get(letters, k), chars[i]) - 1).cast("int"))
                sizes = F.transform(letters, lambda a: F.length(a))

                def back(out: Column) -> Column:
                    new = F.transform(out, lambda x, k: F.substring(F.get(letters, k), x + 1, F.lit(1)))
                    return let(
                        new,
                        lambda new: F.array_join(
                            F.transform(chars, lambda c, i: F.coalesce(F.get(new, (F.array_position(places, i) - 1).cast("int")), c)), ""
                        ),
                    )

                return let(feistel(items, sizes, tweak, key), back)

            return let(letters, permuted)

        return let(F.filter(F.sequence(F.lit(0), F.size(chars) - 1), lambda i: alphabet(chars[i]).isNotNull()), at)

    return F.when(F.length(value) == 0, value).otherwise(let(F.split(value, ""), of))


def _digit(c: Column) -> Column:
    return F.when(c.rlike("^[0-9]$"), F.lit(DIGITS))


def _letter_or_digit(c: Column) -> Column:
    """The alphabet of a letter or digit: beyond ASCII, those of the code points around it that an EMAIL admits, too."""

    def around(point: Column) -> Column:
        width = F.when(F.floor(point / WIDE_ALPHABET) == WIDE // WIDE_ALPHABET, WIDE_ALPHABET).otherwise(ALPHABET)
        points = let(width, lambda w: F.sequence(point - point % w, point - point % w + w - 1))
        return F.array_join(F.filter(F.transform(points, _character), lambda x: x.rlike(r"^[\p{L}\p{N}&&[^\x00-\x7F]]$")), "")

    ascii = F.when(c.rlike("^[a-z]$"), F.lit(LOWER)).when(c.rlike("^[A-Z]$"), F.lit(UPPER)).when(c.rlike("^[0-9]$"), F.lit(DIGITS))
    return ascii.when(c.rlike(r"^[\p{L}\p{N}]$"), let(F.ascii(c), around))


def _character(point: Column) -> Column:
    return F.decode(F.unhex(F.lpad(F.hex(point), 8, "0")), "UTF-32")


def _email(value: Column, key: str) -> Column:
    local = F.substring_index(value, "@", 1)
    domain = F.substring_index(value, "@", -1)
    return F.concat(_permuted_characters(local, _letter_or_digit, F.concat(F.lit("mail:"), F.lower(domain)), key), F.lit("@"), domain)


def _phone(value: Column, key: str) -> Column:
    """All digits after the country code are permuted. A number without one is written as in North America: its code is 1."""
    country = F.regexp_extract(value, COUNTRY, 0)
    rest = F.substring(value, F.length(country) + 1, F.length(value))
    code = F.when(country == "", F.lit("1")).otherwise(F.regexp_replace(country, "[^0-9]", ""))
    return F.concat(country, _permuted_characters(rest, _digit, F.concat(F.lit("phone:"), code), key))


def _iban_check(account: Column, country: Column) -> Column:
    """The right check digits (2 to 98) of an account in a country."""
    chars = F.split(F.concat(F.regexp_replace(account, " ", ""), country, F.lit("00")), "")
    value = lambda c: F.instr(F.lit(DIGITS + UPPER), c) - 1
    rest = F.aggregate(chars, F.lit(0), lambda r, c: F.pmod(r * F.when(value(c) > 9, 100).otherwise(10) + value(c), F.lit(97)).cast("int"))
    return F.lit(98) - rest


def _account(value: Column, key: str) -> Column:
    """The country stays, letters and digits are permuted under new check digits; null if the given check digits are wrong."""
    country, check, account = F.substring(value, 1, 2), F.substring(value, 3, 2).cast("int"), F.substring(value, 5, 99)

    def checked(new: Column) -> Column:
        return F.concat(country, F.lpad(_iban_check(new, country).cast("string"), 2, "0"), new)

    new = let(_permuted_characters(account, _letter_or_digit, F.concat(F.lit("account:"), country), key), checked)
    return F.when(check == _iban_check(account, country), new)


def _token(value: Column, key: str) -> Column:
    lower = value.rlike("[a-f]")
    return _permuted_characters(value, lambda c: F.when(lower, F.lit(DIGITS + LOWER[:6])).otherwise(F.lit(DIGITS + UPPER[:6])), F.lit("token"), key)


def _check(body: Column) -> Column:
    """The Luhn check digit of an array of digits."""
    doubled = F.transform(
        body, lambda x, i: F.when((F.size(body) - i) % 2 == 1, F.when(x > 4, 2 * x - 9).otherwise(2 * x)).otherwise(x)
    )
    return F.pmod(-F.aggregate(doubled, F.lit(0), lambda total, x: total + x), F.lit(10))


def _card(value: Column, key: str) -> Column:
    """All digits but the last are permuted under a new check digit; null if the given one is wrong."""

    def of(digits: Column) -> Column:
        def bodied(body: Column) -> Column:
            new = feistel(body, F.transform(body, lambda _: F.lit(10)), F.lit("number"), key)

            def placed(new: Column) -> Column:
                whole = F.concat(new, F.array(_check(new)))
                chars = F.split(value, "")

                def back(whole: Column) -> Column:
                    def put(chars: Column) -> Column:
                        places = F.filter(F.sequence(F.lit(0), F.size(chars) - 1), lambda i: chars[i].rlike("^[0-9]$"))
                        return let(
                            places,
                            lambda places: F.array_join(
                                F.transform(
                                    chars,
                                    lambda c, i: F.coalesce(F.get(whole, (F.array_position(places, i) - 1).cast("int")).cast("string"), c),
                                ),
                                "",
                            ),
                        )

                    return let(chars, put)

                return let(whole, back)

            return F.when(F.element_at(digits, -1) == _check(body), let(new, placed))

        return let(F.slice(digits, F.lit(1), F.size(digits) - 1), bodied)

    digits = F.transform(F.split(F.regexp_replace(value, "[^0-9]", ""), ""), lambda c: c.cast("int"))
    return let(digits, of)


def _address(value: Column, key: str) -> Column:
    parts = F.transform(F.split(value, r"\."), lambda c: c.cast("int"))
    return let(parts, lambda p: F.array_join(feistel(p, F.transform(p, lambda _: F.lit(256)), F.lit("address"), key), "."))


def _date(value: Column, key: str, *patterns: str) -> Column:
    """Another day of the same 400 years, read by the first pattern that fits; null if there is no such date from the year 400 on.

    Days up to 12 and later ones are permuted among themselves, so that a date which can only be read day first stays one.
    """

    def first(month: Column) -> Column:
        return F.unix_date(F.add_months(F.date_from_unix_date(F.lit(YEAR_ZERO)), month)) - F.lit(YEAR_ZERO)

    def moved(day: Column) -> Column:
        date = F.date_from_unix_date(day + YEAR_ZERO)
        cycle = F.floor(F.year(date) / 400).cast("int")
        month = (F.year(date) % 400) * 12 + F.month(date) - 1
        early = F.dayofmonth(date) <= EARLY
        # of each month the first 12 days, or all but those
        place = F.when(early, month * EARLY + F.dayofmonth(date) - 1).otherwise(day % CYCLE - (month + 1) * EARLY)
        radix = F.when(early, F.lit(EARLY_PARTS[1])).otherwise(F.lit(LATE_PARTS[1]))
        sizes = F.when(early, F.array(*map(F.lit, EARLY_PARTS))).otherwise(F.array(*map(F.lit, LATE_PARTS)))

        def placed(place: Column) -> Column:
            def late(near: Column) -> Column:
                # the last month whose first late day isn't behind the place; months differ little from their mean
                months = F.sequence(F.greatest(near - 2, F.lit(0)), F.least(near + 2, F.lit(MONTHS - 1)))
                found = F.array_max(F.filter(months, lambda m: first(m) - m * EARLY <= place))
                return place + (found + 1) * EARLY

            near = F.floor(place * F.lit(MONTHS) / F.lit(CYCLE - MONTHS * EARLY)).cast("int")
            early_day = first(F.floor(place / EARLY).cast("int")) + place % EARLY
            return F.date_from_unix_date(cycle * CYCLE + F.when(early, early_day).otherwise(let(near, late)) + YEAR_ZERO)

        parts = let(place, lambda n: F.array(F.floor(n / radix).cast("int"), (n % radix).cast("int")))
        new = let(feistel(parts, sizes, F.when(early, F.lit("date:early")).otherwise(F.lit("date:late")), key), lambda p: p[0] * radix + p[1])
        return let(new, placed)

    def read(pattern: str, other: Column) -> Column:
        day = F.unix_date(F.try_to_timestamp(value, F.lit(pattern)).cast("date")) - F.lit(YEAR_ZERO)
        return F.when(day >= CYCLE, let(day, lambda day: F.date_format(moved(day), pattern))).otherwise(other)

    out = F.lit(None).cast("string")
    for pattern in reversed(patterns):
        out = read(pattern, out)
    return out


def pseudonym(value: Column, key: str) -> Column:
    """The pseudonym of one value that :data:`ANY` found; null if it is no such value after all."""

    def is_a(pattern: str) -> Column:
        return value.rlike(f"^(?:{pattern})$")

    return (
        F.when(is_a(EMAIL), _email(value, key))
        .when(is_a(IBAN), _account(value, key))
        .when(is_a(ISO_DATE), _date(value, key, "yyyy-MM-dd"))
        .when(is_a(DOTTED_DATE), _date(value, key, "dd.MM.yyyy"))
        .when(is_a(SLASHED_DATE), _date(value, key, "MM/dd/yyyy", "dd/MM/yyyy"))
        .when(is_a(PHONE), _phone(value, key))
        .when(is_a(SOCIAL), _permuted_characters(value, _digit, F.lit("social"), key))
        .when(is_a(CARD), _card(value, key))
        .when(is_a(ADDRESS), _address(value, key))
        .otherwise(_token(value, key))
    )


def pseudonymised(text: Column, key: str) -> Column:
    """Struct (text, n_found): the text with every value replaced, and how many were; null stays null."""

    def of(found: Column) -> Column:
        def replaced(new: Column) -> Column:
            def joined(between: Column) -> Column:
                return F.array_join(F.transform(between, lambda s, i: F.concat(s, F.coalesce(F.get(new, i), F.get(found, i), F.lit("")))), "")

            return F.struct(let(F.split(text, ANY), joined).alias("text"), F.size(F.filter(new, lambda v: v.isNotNull())).cast("long").alias("n_found"))

        nothing = F.struct(text.alias("text"), F.lit(0).cast("long").alias("n_found"))
        return F.when(F.size(found) == 0, nothing).otherwise(let(F.transform(found, lambda v: pseudonym(v, key)), replaced))

    return let(F.regexp_extract_all(text, F.lit(ANY), F.lit(0)), of)


def replace(docs: DataFrame, key: str, text_col: str = "text") -> DataFrame:
    """``docs`` with pseudonyms in ``text_col``; all rows, repeated ones too, and all other columns stay as they are."""
    return docs.withColumn(text_col, pseudonymised(F.col(f"`{text_col}`"), key)["text"])


def report(docs: DataFrame, key: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per row of ``docs``: the id, the text with pseudonyms and how many values were replaced (0 for a null text)."""
    rows = docs.select(F.col(f"`{id_col}`").alias(id_col), pseudonymised(F.col(f"`{text_col}`"), key).alias("p"))
    return rows.select(id_col, F.col("p.text").alias("text"), F.coalesce("p.n_found", F.lit(0).cast("long")).alias("n_found"))
