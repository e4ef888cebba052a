"""Personal data replaced by format-preserving Feistel pseudonyms, in DataFrame operations only.

Numbers and dates that pass their format's validation are permuted by a keyed Feistel network within that
format: card numbers keep length, separators and a right check digit (Luhn); account numbers (IBAN) keep
country, length and right check digits (mod 97); phone numbers keep country code and punctuation; social
security numbers stay within valid areas, groups and serials; IPv4 addresses stay addresses; dates stay
dates of the same hundred years in the same notation; long hexadecimal secrets keep length and case. Equal values get equal
pseudonyms in every document, different values of a format different ones. E-mail addresses, which have no
fixed format, get a keyed digest. An account number ends where its country's length or else its check digits say, so
words and numbers after it are read on their own. Numbers that fail validation and all other text stay as they are.

The network alternates between two digits of any radices a and b, left + F(right) mod a and right + F(left) mod b, so
every domain of a x b values is permuted without walking cycles. F is SHA-256 of key, format, round and value.

Null texts stay null, empty ones empty. Whole texts are read. There is no shuffle.
"""

from __future__ import annotations

import calendar

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

ROUNDS = 8
# Formats as patterns; the first that matches at a place is tried.
EMAIL = r"(?<![\w.+%-])[\w.+%-]+@[\w-]+(?:\.[\w-]+)+"
SECRET = r"(?<![\p{L}\p{N}])(?:[0-9a-f]{32,64}|[0-9A-F]{32,64})(?![\p{L}\p{N}])"
IBAN = r"[A-Z]{2}\d{2}(?: ?[A-Z0-9]){11,30}"
# Lengths of account numbers by country; those of other countries may have any.
IBAN_LENGTHS = {
    15: "NO", 16: "BE", 18: "DK FI FO FK GL NL SD", 19: "MK SI", 20: "AT BA EE KZ LT LU MN XK", 21: "CH HR LI LV", 22: "BG BH CR DE GB GE IE ME RS VA",
    23: "AE GI IL IQ OM SO TL", 24: "AD CZ ES MD PK RO SA SE SK TN VG", 25: "LY PT ST", 26: "IS TR", 27: "BI DJ FR GR IT MC MR SM", 28: "AL AZ BY CY DO GT HN HU LB NI PL SV",
    29: "BR EG PS QA UA", 30: "JO KW MU YE", 31: "MT SC", 32: "LC", 33: "RU",
}
REGISTERED = r"\A(?:" + "|".join(rf"(?:{c.replace(' ', '|')})\d{{2}}(?: ?[A-Z0-9]){{{n - 4}}}" for n, c in IBAN_LENGTHS.items()) + r")\z"
# At each place, the longest run that could hold an account number, and a letter or number right after it.
IBAN_RUN = rf"(?<![\p{{L}}\p{{N}}])(?=({IBAN}[\p{{L}}\p{{N}}]?))"
CARD = r"(?<![\p{L}\p{N}])(?<![\p{N}][.,-])(?:\d{13,19}|\d{4} \d{4} \d{4} \d{4}|\d{4}-\d{4}-\d{4}-\d{4}|\d{4} \d{6} \d{4,5}|\d{4}-\d{6}-\d{4,5})(?![\p{L}\p{N}])"
CARD_AFTER = r"[ ]\d{4}[ -]\d{4}[ -]\d{4}[ -]\d{4}(?![ -]?\d)|[ ]\d{4}[ -]\d{6}[ -]\d{4,5}(?![ -]?\d)"
# Digits of an international number in groups of any length, at most 14 after the country code; a card number after it isn't taken in.
ABROAD = r"\+\d{1,3}(?:(?!" + CARD_AFTER + r")(?:[ .-]?\(?|\)[ .-]?)\d){6,14}\)?"
# North American numbers, and others from their trunk zero on, with 9 to 12 digits.
HOME = r"(?:\+?1[ .-]?)?(?:\(\d{3}\) ?|\d{3}[ .-])\d{3}[ .-]\d{4}|(?<![\p{N}][.,-])(?:(?:\+?1[ .-]?)?[2-9]\d{9}|(?=\(?(?:[ ./()-]{0,2}\d){9,12}(?![\p{L}\p{N}]))(?:\(0\d{1,4}\)|0\d{1,4})(?:(?!" + CARD_AFTER + r")[ ./-]?\d){4,9})(?![.,]\d)"
PHONE = rf"(?<![\p{{L}}\p{{N}}])(?:{HOME}|{ABROAD})(?![\p{{L}}\p{{N}}])"
SSN = r"(?<![\p{L}\p{N}-])\d{3}-\d{2}-\d{4}(?![\p{L}\p{N}-])"
IPV4 = r"(?<![\p{N}.])(?:\d{1,3}\.){3}\d{1,3}(?!\.?\d)"
DATE = r"(?<![\p{N}./-])(?:\d{4}-\d{2}-\d{2}|\d{2}/\d{2}/\d{4}|\d{2}\.\d{2}\.\d{4})(?![\p{N}/-])"
KINDS = {"email": EMAIL, "secret": SECRET, "iban": IBAN, "ssn": SSN, "date": DATE, "ipv4": IPV4, "card": CARD, "phone": PHONE}
# All but account numbers, which are found by their check digits first: before and after their turn.
BEFORE, AFTER = ("|".join(f"(?:{KINDS[k]})" for k in kinds) for kinds in (("email", "secret"), ("ssn", "date", "ipv4", "card", "phone")))
MOST_DIGITS = 30


def let(value: Column, use) -> Column:
    """``use`` of a value that is computed once."""
    return F.element_at(F.transform(F.array(value), lambda x: use(x)), 1)


def keyed(key: str, *parts: Column) -> Column:
    """60 bits of SHA-256 of key and parts."""
    return F.conv(F.substring(F.sha2(F.concat_ws("|", F.lit(key), *(p.cast("string") for p in parts)), 256), 1, 15), 16, 10).cast("long")


def feistel(left: Column, right: Column, a: Column, b: Column, tweak: Column, key: str) -> Column:
    """struct(l, r): the keyed permutation of (left, right) in [0, a) x [0, b)."""
    start = F.struct(left.cast("long").alias("l"), right.cast("long").alias("r"))

    def turn(s: Column, i: Column) -> Column:
        even = F.struct(F.pmod(s["l"] + keyed(key, tweak, i, s["r"]), a.cast("long")).alias("l"), s["r"].alias("r"))
        odd = F.struct(s["l"].alias("l"), F.pmod(s["r"] + keyed(key, tweak, i, s["l"]), b.cast("long")).alias("r"))
        return F.when(i % 2 == 0, even).otherwise(odd)

    return F.aggregate(F.sequence(F.lit(0), F.lit(ROUNDS - 1)), start, turn)


def digits_of(m: Column) -> Column:
    return F.regexp_replace(m, r"\D", "")


def permute_digits(d: Column, tweak: Column, key: str) -> Column:
    """A string of 2 to MOST_DIGITS digits to another of the same length."""
    half = F.floor(F.length(d) / 2).cast("int")
    low = F.length(d) - half
    left, right = F.substr(d, F.lit(1), half).cast("long"), F.substr(d, half + 1).cast("long")
    ten = lambda n: F.pow(F.lit(10.0), n).cast("long")
    out = feistel(left, right, ten(half), ten(low), F.concat_ws("/", tweak, F.length(d)), key)
    return let(out, lambda s: F.concat(F.lpad(s["l"].cast("string"), half, "0"), F.lpad(s["r"].cast("string"), low, "0")))


def luhn_sum(d: Column, double_last: bool) -> Column:
    """Luhn's sum of digits; the last one is doubled if a check digit is still to come."""
    n = F.length(d)
    terms = F.transform(
        F.sequence(F.lit(1), n),
        lambda i: let(
            F.substr(d, i, F.lit(1)).cast("int") * F.when((n - i) % 2 == (0 if double_last else 1), 2).otherwise(1), lambda x: F.when(x > 9, x - 9).otherwise(x)
        ),
    )
    return F.aggregate(terms, F.lit(0), lambda s, x: s + x)


def refill(m: Column, chars: Column, slot: str) -> Column:
    """``m`` with its characters of the class ``slot`` replaced in order by those of ``chars``."""
    start = F.struct(F.lit("").alias("out"), F.lit(1).alias("at"))

    def step(s: Column, c: Column) -> Column:
        put = F.struct(F.concat(s["out"], F.substr(chars, s["at"], F.lit(1))).alias("out"), (s["at"] + 1).alias("at"))
        return F.when(c.rlike(slot), put).otherwise(F.struct(F.concat(s["out"], c).alias("out"), s["at"].alias("at")))

    return F.aggregate(F.split(m, ""), start, step, lambda s: s["out"])


def mod97(text: Column) -> Column:
    """Remainder by 97 of digits and letters, A counting as 10."""
    return F.aggregate(
        F.split(text, ""),
        F.lit(0),
        lambda s, c: F.when(c.rlike("[0-9]"), (s * 10 + F.ascii(c) - 48) % 97).when(c.rlike("[A-Z]"), (s * 100 + F.ascii(c) - 55) % 97).otherwise(s),
    )


def card(m: Column, key: str) -> Column:
    def valid(d: Column) -> Column:
        payload = permute_digits(F.substr(d, F.lit(1), F.length(d) - 1), F.lit("card"), key)
        new = let(payload, lambda p: F.concat(p, ((10 - luhn_sum(p, True) % 10) % 10).cast("string")))
        return F.when((luhn_sum(d, False) % 10 == 0) & ~d.rlike("^0+$"), refill(m, new, "[0-9]")).otherwise(m)

    return let(digits_of(m), valid)


def ibans_in(text: Column) -> Column:
    """The valid account numbers of a text, long ones first: at each place the one of its country's length, or else the longest run up to a boundary."""

    def best(run: Column) -> Column:
        def valid(p: Column) -> Column:
            t = F.replace(p, F.lit(" "), F.lit(""))
            return mod97(F.concat(F.substr(t, F.lit(5)), F.substr(t, F.lit(1), F.lit(4)))) == 1

        starts = F.transform(F.sequence(F.length(run), F.lit(15), F.lit(-1)), lambda n: F.struct(F.substr(run, F.lit(1), n).alias("p"), F.substr(run, n + 1, F.lit(1)).alias("next")))
        whole = F.filter(starts, lambda x: ~x["next"].rlike(r"[\p{L}\p{N}]") & x["p"].rlike(rf"\A{IBAN}\z"))
        fit = F.filter(F.transform(whole, lambda x: x["p"]), valid)
        return let(fit, lambda v: F.coalesce(F.get(F.filter(v, lambda p: p.rlike(REGISTERED)), F.lit(0)), F.get(v, F.lit(0))))

    runs = F.array_distinct(F.regexp_extract_all(text, F.lit(IBAN_RUN), F.lit(1)))
    found = F.array_distinct(F.filter(F.transform(runs, best), lambda p: p.isNotNull()))
    return F.transform(F.reverse(F.array_sort(F.transform(found, lambda p: F.struct(F.length(p).alias("n"), p.alias("p"))))), lambda x: x["p"])


def pattern_for(text: Column) -> Column:
    """The pattern of all kinds, with the text's own valid account numbers."""
    own = F.when(text.rlike(IBAN), F.array_join(ibans_in(text), "|"))
    alone = F.when(own != "", F.concat(F.lit(r"(?<![\p{L}\p{N}])(?:"), own, F.lit(r")(?![\p{L}\p{N}])|")))
    return F.concat(F.lit(BEFORE + "|"), F.coalesce(alone, F.lit("")), F.lit(AFTER))


def iban(m: Column, key: str) -> Column:
    def valid(t: Column) -> Column:
        country, rest = F.substr(t, F.lit(1), F.lit(2)), F.substr(t, F.lit(5))
        ok = mod97(F.concat(rest, F.substr(t, F.lit(1), F.lit(4)))) == 1
        digits = digits_of(rest)
        new = F.when(F.length(digits) >= 2, refill(rest, permute_digits(digits, F.concat(F.lit("iban"), country), key), "[0-9]")).otherwise(rest)
        whole = let(new, lambda n: F.concat(country, F.lpad((98 - mod97(F.concat(n, country, F.lit("00")))).cast("string"), 2, "0"), n))
        return F.when(ok, refill(m, whole, "[A-Z0-9]")).otherwise(m)

    return let(F.replace(m, F.lit(" "), F.lit("")), valid)


def phone(m: Column, key: str) -> Column:
    country = F.regexp_extract(m, r"^(?:\+?1(?=[ .(-])|\+\d{1,3})", 0)
    rest = F.substr(m, F.length(country) + 1)

    def valid(d: Column) -> Column:
        return F.when(F.length(d).between(4, 14), F.concat(country, refill(rest, permute_digits(d, F.concat(F.lit("phone"), country), key), "[0-9]"))).otherwise(m)

    return let(digits_of(rest), valid)


def ssn(m: Column, key: str) -> Column:
    area, group, serial = (F.substr(m, F.lit(i), F.lit(n)).cast("long") for i, n in ((1, 3), (5, 2), (8, 4)))
    ok = (area > 0) & (area != 666) & (area < 900) & (group > 0) & (serial > 0)
    # 898 areas; 99 groups x 9,999 serials
    out = feistel(F.when(area > 666, area - 2).otherwise(area - 1), (group - 1) * 9999 + serial - 1, F.lit(898), F.lit(99 * 9999), F.lit("ssn"), key)
    new = let(out, lambda s: F.format_string("%03d-%02d-%04d", F.when(s["l"] >= 665, s["l"] + 2).otherwise(s["l"] + 1), F.floor(s["r"] / 9999) + 1, s["r"] % 9999 + 1))
    return F.when(ok, new).otherwise(m)


def ipv4(m: Column, key: str) -> Column:
    def valid(p: Column) -> Column:
        at = lambda i: F.get(p, F.lit(i)).cast("long")
        out = feistel(at(0) * 256 + at(1), at(2) * 256 + at(3), F.lit(65536), F.lit(65536), F.lit("ipv4"), key)
        new = let(out, lambda s: F.concat_ws(".", *(x.cast("string") for x in (F.floor(s["l"] / 256), s["l"] % 256, F.floor(s["r"] / 256), s["r"] % 256))))
        return F.when(F.forall(p, lambda x: x.cast("int") < 256), new).otherwise(m)

    return let(F.split(m, r"\."), valid)


# Hundred years from their first: number of days and of leap years as products. 1900 and 2100 have no leap day.
ERAS = ((1820, 92, 397, 4, 6), (1920, 75, 487, 5, 5), (2020, 92, 397, 4, 6))
# Days after the 12th of a year without leap day, as MM-dd.
LATE = [f"{month:02}-{day:02}" for month in range(1, 13) for day in range(13, calendar.monthrange(2001, month)[1] + 1)]


def permute_day(day: Column, late: Column, key: str) -> Column:
    """A date of 1820 to 2119 to another of the same hundred years; others stay. With ``late`` the day is after the 12th and stays so: leap days among themselves, the others as year and place in LATE."""
    year, leap = F.year(day), late & (F.date_format(day, "MM-dd") == "02-29")
    era = F.lit(None)
    for first, a, b, c, d in reversed(ERAS):
        start = F.to_date(F.lit(f"{first}-01-01"))
        here = F.struct(
            F.lit(first).alias("first"), start.alias("start"), F.array(*(F.lit(y) for y in range(first, first + 100) if calendar.isleap(y))).alias("leaps"),
            F.when(leap, c).when(late, 100).otherwise(a).alias("a"), F.when(leap, d).when(late, len(LATE)).otherwise(b).alias("b"),
        )
        era = F.when((year >= first) & (year < first + 100), here).otherwise(era)
    places = F.split(F.lit(" ".join(LATE)), " ")

    def within(e: Column) -> Column:
        at = F.array_position(places, F.date_format(day, "MM-dd")) - 1
        n = F.when(leap, F.array_position(e["leaps"], year) - 1).when(late, (year - e["first"]) * len(LATE) + at).otherwise(F.datediff(day, e["start"])).cast("long")
        tweak = F.concat_ws("/", F.when(leap, "leap").when(late, "late").otherwise("date"), e["first"])
        new = let(feistel(F.floor(n / e["b"]), n % e["b"], e["a"], e["b"], tweak, key), lambda s: s["l"] * e["b"] + s["r"])

        def read(k: Column) -> Column:
            word = F.when(leap, F.concat(F.get(e["leaps"], k.cast("int")).cast("string"), F.lit("-02-29")))
            word = word.when(late, F.concat((e["first"] + F.floor(k / len(LATE))).cast("string"), F.lit("-"), F.get(places, (k % len(LATE)).cast("int"))))
            return F.coalesce(F.to_date(word), F.date_add(e["start"], k.cast("int")))

        return F.when(e.isNull(), day).otherwise(let(new, read))

    return let(era, within)


def read_day(m: Column, when: Column, form: str) -> Column:
    """struct(day, form) if ``when`` holds and ``m`` is a date of the form, else null."""
    day = F.when(when, F.try_to_timestamp(m, F.lit(form)).cast("date"))
    return let(day, lambda d: F.when(d.isNotNull(), F.struct(d.alias("day"), F.lit(form).alias("form"))))


def date(m: Column, key: str) -> Column:
    """Days come first with dots; with slashes months do, unless only the other reading is a date. Those dates are permuted among themselves, so no two dates get one pseudonym."""
    sep = F.substr(m, F.lit(3), F.lit(1))
    forms = (("yyyy-MM-dd", m.rlike("^[0-9]{4}-")), ("dd.MM.yyyy", sep == "."), ("MM/dd/yyyy", sep == "/"), ("dd/MM/yyyy", sep == "/"))
    found = F.coalesce(*(read_day(m, when, form) for form, when in forms))

    def written(x: Column) -> Column:
        new = permute_day(x["day"], x["form"] == "dd/MM/yyyy", key)
        out = F.lit(None).cast("string")
        return F.when(x.isNull(), m).otherwise(let(new, lambda d: F.coalesce(*(F.when(x["form"] == form, F.date_format(d, form)) for form, _ in forms), out)))

    return let(found, written)


def secret(m: Column, key: str) -> Column:
    """Hexadecimal digits, eight at a time and the rest, each permuted with its place and the digits before as tweak; then the same from the back, so every digit depends on all."""
    low = F.lower(m)
    n = F.length(m)

    def sweep(text: Column, name: str) -> Column:
        def step(out: Column, i: Column) -> Column:
            block = F.substr(text, i * 8 + 1, F.least(F.lit(8), n - i * 8))
            k = F.length(block)
            half = F.floor(k / 2).cast("int")
            num = lambda x: F.coalesce(F.conv(x, 16, 10).cast("long"), F.lit(0))
            size = lambda x: F.pow(F.lit(16.0), x).cast("long")
            new = feistel(num(F.substr(block, F.lit(1), half)), num(F.substr(block, half + 1)), size(half), size(k - half), F.concat_ws("/", F.lit(name), n, i, out), key)
            return F.concat(out, let(new, lambda s: F.concat(F.when(half > 0, F.lpad(F.lower(F.hex(s["l"])), half, "0")).otherwise(""), F.lpad(F.lower(F.hex(s["r"])), k - half, "0"))))

        return F.aggregate(F.sequence(F.lit(0), F.ceil(n / 8).cast("int") - 1), F.lit(""), step)

    new = let(sweep(low, "hex1"), lambda once: let(F.reverse(once), lambda back: sweep(back, "hex2")))
    return F.when(m == low, new).otherwise(F.upper(new))


def email(m: Column, key: str) -> Column:
    """A keyed digest as name, at a reserved domain."""
    return F.concat(F.lit("u"), F.substring(F.sha2(F.concat_ws("|", F.lit(key), F.lit("email"), F.lower(m)), 256), 1, 16), F.lit("@example.invalid"))


def pseudonym(m: Column, key: str) -> Column:
    whole = lambda kind: m.rlike(rf"\A(?:{KINDS[kind]})\z")
    ways = {"email": email, "secret": secret, "iban": iban, "card": card, "phone": phone, "ssn": ssn, "ipv4": ipv4, "date": date}
    out = m
    for kind in reversed(KINDS):
        out = F.when(whole(kind), ways[kind](m, key)).otherwise(out)
    return out


def pseudonymise(docs: DataFrame, *, key: str, text_col: str = "text", count_col: str | None = None) -> DataFrame:
    """``docs`` with pseudonyms in ``text_col`` and, if named, the number of replaced values in ``count_col``. Other columns may have any names."""
    names = docs.columns
    named = docs.toDF(*(f"_c{i}" for i in range(len(names))))
    at = names.index(text_col)
    text = F.col(f"_c{at}")
    found = F.when(F.col("_any").isNotNull(), F.regexp_extract_all(text, F.col("_any"), F.lit(0)))
    out = named.withColumn("_any", F.when(text.rlike("[0-9@]"), pattern_for(text))).withColumn("_found", found).withColumn("_new", F.when(F.size("_found") > 0, F.transform("_found", lambda m: pseudonym(m, key))))
    parts = F.split(text, F.col("_any"), -1)
    spliced = let(parts, lambda p: F.array_join(F.transform(p, lambda x, i: F.concat(x, F.coalesce(F.get(F.col("_new"), i), F.lit("")))), ""))
    changed = F.coalesce(F.size(F.filter(F.arrays_zip("_found", "_new"), lambda z: z["_found"] != z["_new"])), F.lit(0))
    kept = [F.when(F.col("_new").isNull(), text).otherwise(spliced).alias(c) if i == at else F.col(f"_c{i}").alias(c) for i, c in enumerate(names) if c != count_col or i == at]
    return out.select(*kept, *([F.when(F.col("_new").isNull(), 0).otherwise(changed).alias(count_col)] if count_col else []))
