"""Operator 6: personal data under format-preserving Feistel pseudonyms.

Numbers that validate (payment cards by their check digit, telephone numbers
by digit count and prefix, IPv4 addresses, social security numbers, IBANs by
country, length and check digits) and calendar dates are replaced by a
keyed permutation of their own format: a balanced Feistel network over the
digits (or the day number), whose round function is a slice of a keyed SHA-256.
Equal values get equal pseudonyms in every document, different values different
ones, and the holder of the key can invert them (``inverse=True``). Cards get a
new valid check digit, IBANs keep country and letters and get new check digits
(national ones inside aren't kept), social security numbers walk the permutation until the
result is valid, so pseudonyms pass the same validation as the values.

Mail addresses and secrets have no numeric format; they get keyed digests, linked
but not invertible. Secrets are values behind the name of a password, token,
secret or key and ``=`` or ``:``, up to the next white space or quote (a quoted
password or key may hold spaces and goes up to its quote; other names before
quoted words are usual in prose), tokens behind ``Bearer``, and keys of known
prefixes (AKIA, gh._, sk-, xox.-). Behind ``Bearer`` and prefixes a digit must
be among them. IPv6 addresses and mail addresses outside ASCII are no candidates.

Only DataFrame functions, one row at a time: no shuffle, and nothing depends on
how often a value occurs.

Cards have the prefix and length of a card scheme and a valid check digit, and
stand undivided or in one of the usual groupings (4-4-4-4, 4-6-5, 4-6-4,
4-4-4-4-3), with spaces or hyphens. They are sought in runs of digit groups, so an
expiry date, a security code or any other number beside a card doesn't hide it;
of overlapping ones the first to end goes. The first four digits stay. The
permutation is walked until the pseudonym is found at the same place; so where
candidates overlap it can depend on the numbers before the card.

Telephone numbers are: + and 7 to 15 digits (the country code stays); 9 to 12
digits from a leading 0, as in Germany and France (the first two stay); Spanish
ones in groups (the first stays); 10 digits in groups of 3-3-4 with any prefix
(divided by spaces only where no other number stands beside, as in a table), or
undivided from 2 to 9. Undivided Spanish numbers (9 digits) and local numbers
without area code are no candidates: their form doesn't tell them from other
numbers.

Defined cases: null text stays null; a candidate that does not validate stays
as it is; digits inside longer digit runs are no candidates; dates from
1900-01-01 to 2099-08-04 are permuted among themselves and others stay; rows
that repeat get equal results; all columns of the input are kept.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from truetally.llm.common import fresh

ROUNDS = 8
DATE_ORIGIN, DATE_SIDE = "1900-01-01", 270  # 270 * 270 days

_OCTET = "(?:25[0-5]|2[0-4][0-9]|1[0-9][0-9]|[1-9]?[0-9])"
#: No digit group of 3 or more digits stands beside, as it would in a card.
_ALONE, _NO_MORE = r"(?<![0-9A-Za-z.,+/-])(?<![0-9]{3} )", r"(?![0-9]|[ -][0-9]{3})"
#: IBANs: lengths by country (fixed values).
IBAN_LENGTHS = {15: "NO", 16: "BE", 18: "DK|FI|NL", 20: "AT|EE|LT|LU", 21: "CH|HR|LI|LV", 22: "BG|DE|GB|IE|RS",
                24: "CZ|ES|RO|SE|SK", 25: "PT", 26: "IS|TR", 27: "FR|GR|IT|MC|SM", 28: "CY|HU|PL", 31: "MT"}
_IBANS = "|".join(f"(?:{c})[0-9]{{2}}(?:[ ]?[A-Z0-9]){{{n - 4}}}" for n, c in IBAN_LENGTHS.items())
PATTERNS = {
    "iban": rf"(?<![0-9A-Za-z])(?:{_IBANS})(?![0-9A-Za-z])",
    "email": r"(?<![A-Za-z0-9._%+-])[A-Za-z0-9._%+-]{1,64}@[A-Za-z0-9-]{1,63}(?:\.[A-Za-z0-9-]{1,63}){1,8}",
    # 3-3-4 behind a country code, with a parenthesis or another first separator than a space, or alone among words
    "phone": r"(?:(?<![0-9A-Za-z+])\+[0-9]{1,3}[ .-]?(?<![0-9])\(?[0-9]{3}\)?[ .-]"
             r"|(?<![0-9])(?:\(?[0-9]{3}\)[ .-]|\([0-9]{3}[ .-]|[0-9]{3}[.-])"
             r"|(?<![0-9])(?<![0-9] )[0-9]{3} (?=[0-9]{3}[ .-][0-9]{4}(?! [0-9])))[0-9]{3}[ .-][0-9]{4}(?![0-9])",
    "date": r"(?<![0-9])(?:[0-9]{4}-[0-9]{2}-[0-9]{2}|[0-9]{2}[./][0-9]{2}[./][0-9]{4})(?![0-9])",
    "ssn": r"(?<![0-9-])[0-9]{3}-[0-9]{2}-[0-9]{4}(?![0-9-])",
    "ip": rf"(?<![0-9.]){_OCTET}(?:\.{_OCTET}){{3}}(?![0-9]|\.[0-9])",
    # + and 7 to 15 digits (11 in the zones 1 and 7), national with a leading 0, Spanish, North American without separators
    "abroad": r"(?<![0-9A-Za-z+])\+(?:[17](?:[ .-]?\(?[0-9]\)?){10}|[2-689](?:[ .-]?\(?[0-9]\)?){6,14})(?![0-9])",
    "trunk": _ALONE + r"\(?0[1-9](?:\)?[ ./-]?[0-9]){7,10}" + _NO_MORE,
    "spanish": _ALONE + r"[6-9][0-9]{2}(?:[ -][0-9]{3}[ -][0-9]{3}|(?:[ -][0-9]{2}){3})" + _NO_MORE,
    "ten": _ALONE + r"[2-9][0-9]{9}(?![A-Za-z]|[.,/][0-9])" + _NO_MORE,
    "secret": r"(?<![A-Za-z0-9])AKIA[0-9A-Z]{16}(?![0-9A-Z])"
              r"|(?<![A-Za-z0-9_])gh[pousr]_(?=[A-Za-z]*+[0-9])[A-Za-z0-9]{36,}+"
              r"|(?<![A-Za-z0-9_-])(?:sk-(?=[A-Za-z_-]*+[0-9])[A-Za-z0-9_-]{20,}+|xox[abprs]-(?=[A-Za-z-]*+[0-9])[A-Za-z0-9-]{10,}+)"
              r"|(?<![A-Za-z])[Bb]earer (?=[A-Za-z._~+/-]*+[0-9])[A-Za-z0-9._~+/-]{16,}+=*+"
              r"|(?i:password|passwd|pwd|api[_-]?key)[\"']?[ ]?[=:][ ]?(?:\"[^\"\n]{6,}+(?=\")|'[^'\n]{6,}+(?='))"
              r"|(?i:password|passwd|pwd|token|secret|api[_-]?key)[\"']?[ ]?[=:][ ]?[\"']?[^\s\"']{6,}+",
}
PATTERN = "|".join(f"(?:{p})" for p in PATTERNS.values())
#: Runs of digit groups, sought between the other kinds; cards are sub-runs of them.
RUN = "(?<![0-9])[0-9][0-9 -]{11,}[0-9](?![0-9]|[./][0-9])"
#: Digits by group of the usual ways to write a card; these go before other sub-runs that pass the check.
USUAL = "^(1[3-9]|4-4-4-4|4-6-5|4-6-4|4-4-4-4-3)$"
#: Prefixes of the card schemes with their lengths; the prefix stays, so that a pseudonym keeps its scheme.
SCHEMES = ("^(4([0-9]{12}|[0-9]{15}|[0-9]{18})|(5[1-5][0-9]{2}|2(22[1-9]|2[3-9][0-9]|[3-6][0-9]{2}|7[01][0-9]|720))[0-9]{12}"
           "|3[47][0-9]{13}|3(0[0-5]|[689][0-9])[0-9]{11}|35(2[89]|[3-8][0-9])[0-9]{12}"
           "|(6011|64[4-9][0-9]|65[0-9]{2}|62[0-9]{2})[0-9]{12,15}|(5018|5020|5038|5893|6304|6759|676[1-3])[0-9]{9,15})$")
PREFIX, MOST_GROUPS = 4, 5
WALK = 64
#: Cheap test that every candidate passes.
MAYBE = "[0-9@=:]"


def _digest(key: str, *parts: Column) -> Column:
    return F.sha2(F.concat_ws("|", F.lit(key), *(p.cast("string") for p in parts)).cast("binary"), 256)


def _keyed(key: str, kind: str, rnd: Column, value: Column, modulus: Column) -> Column:
    """A keyed pseudo-random number below ``modulus``."""
    return F.pmod(F.conv(F.substring(_digest(key, F.lit(kind), rnd, modulus, value), 1, 15), 16, 10).cast("long"), modulus)


def feistel(a: Column, b: Column, mod_a: Column, mod_b: Column, key: str, kind: str, inverse: bool = False) -> Column:
    """struct<a, b>: keyed permutation of the pairs (a, b) with a < mod_a and b < mod_b."""
    mod_a, mod_b = mod_a.cast("long"), mod_b.cast("long")
    sign = -1 if inverse else 1

    def step(s, r):
        even = r % 2 == 0
        return F.struct(
            F.when(even, F.pmod(s["a"] + sign * _keyed(key, kind, r, s["b"], mod_a), mod_a)).otherwise(s["a"]).alias("a"),
            F.when(even, s["b"]).otherwise(F.pmod(s["b"] + sign * _keyed(key, kind, r, s["a"], mod_b), mod_b)).alias("b"))

    order = F.array(*(F.lit(r) for r in (reversed(range(ROUNDS)) if inverse else range(ROUNDS))))
    return F.aggregate(order, F.struct(a.cast("long").alias("a"), b.cast("long").alias("b")), step)


def permute_digits(digits: Column, key: str, kind: str, inverse: bool = False) -> Column:
    """Keyed permutation of digit strings of one length (2 to 30 digits)."""
    half = F.floor(F.length(digits) / 2).cast("int")
    rest = F.length(digits) - half
    ten = lambda n: F.element_at(F.array(*(F.lit(10 ** i) for i in range(16))), n + 1)
    out = feistel(F.substr(digits, F.lit(1), half), F.substr(digits, half + 1, rest), ten(half), ten(rest), key, kind, inverse)
    return F.concat(F.lpad(out["a"].cast("string"), half, F.lit("0")), F.lpad(out["b"].cast("string"), rest, F.lit("0")))


def refill(shape: Column, digits: Column) -> Column:
    """``shape`` with its digits replaced, one by one, by ``digits``."""
    zero = F.struct(F.lit("").alias("o"), F.lit(1).alias("k"))

    def step(s, c):
        is_digit = c.rlike("^[0-9]$")
        return F.struct(F.concat(s["o"], F.when(is_digit, F.substr(digits, s["k"], F.lit(1))).otherwise(c)).alias("o"),
                        F.when(is_digit, s["k"] + 1).otherwise(s["k"]).alias("k"))

    return F.aggregate(F.split(shape, ""), zero, step, lambda s: s["o"])


def _luhn_sum(digits: Column) -> Column:
    """Check sum with the last digit counted once."""
    each = F.transform(F.split(F.reverse(digits), ""), lambda c, i: F.when(i % 2 == 0, c.cast("int")).otherwise(
        F.when(c.cast("int") > 4, c.cast("int") * 2 - 9).otherwise(c.cast("int") * 2)))
    return F.aggregate(each, F.lit(0), lambda s, x: s + x)


def luhn_valid(digits: Column) -> Column:
    return _luhn_sum(digits) % 10 == 0


def _ssn_valid(d: Column) -> Column:
    area = F.substring(d, 1, 3)
    return ~(area.isin("000", "666") | (F.substring(d, 1, 1) == "9") | (F.substring(d, 4, 2) == "00")
             | (F.substring(d, 6, 4) == "0000"))


def _let(value: Column, body) -> Column:
    """``body`` of a value that is computed once."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def _is_card(group: Column) -> Column:
    digits = F.array_join(group, "")
    return digits.rlike(SCHEMES) & _is_usual(group) & ~F.array_contains(group, "") & luhn_valid(digits)


def _is_usual(group: Column) -> Column:
    return F.array_join(F.transform(group, lambda y: F.length(y).cast("string")), "-").rlike(USUAL)


def _card_from(groups: Column, least: Column, end: Column) -> Column:
    """First group, not before ``least``, of the (longest) card that ends with group ``end``; null: none does."""
    first = F.greatest(least, end - MOST_GROUPS + 1)
    found = F.filter(F.sequence(first, end), lambda i: _is_card(F.slice(groups, i + 1, end - i + 1)))
    return F.when(least <= end, F.array_min(found))


def _card_digits(digits: Column, key: str, inverse: bool) -> Column:
    """New digits behind the scheme's prefix, which is part of the permutation's key, and their check digit."""
    prefix = F.substring(digits, 1, PREFIX)
    body = F.concat(prefix, permute_digits(F.substr(digits, F.lit(PREFIX + 1), F.length(digits) - PREFIX - 1), key, "card", inverse))
    return _let(body, lambda x: F.concat(x, F.pmod(10 - _luhn_sum(F.concat(x, F.lit("0"))) % 10, F.lit(10)).cast("string")))


def _permuted(groups: Column, start: Column, end: Column, key: str, inverse: bool) -> Column:
    """The groups with the digits of one card permuted."""
    own = F.slice(groups, start + 1, end - start + 1)
    return _let(_card_digits(F.array_join(own, ""), key, inverse), lambda new: F.transform(
        groups, lambda g, i: F.when((i < start) | (i > end), g).otherwise(F.substr(
            new, F.length(F.array_join(F.slice(groups, start + 1, F.greatest(i - start, F.lit(0))), "")) + 1, F.length(g)))))


def _walked(groups: Column, least: Column, start: Column, end: Column, key: str, inverse: bool) -> Column:
    """As ``_permuted``, repeated until the same card is found again from the left."""
    def same(g):
        before = F.exists(F.sequence(start, end), lambda e: (e < end) & _card_from(g, least, e).isNotNull())
        return ~before & F.coalesce(_card_from(g, least, end) == start, F.lit(False))

    def step(s, _):
        return F.when(s["done"], s).otherwise(_let(_permuted(s["g"], start, end, key, inverse), lambda g: F.struct(
            g.alias("g"), same(g).alias("done"))))

    return F.aggregate(F.sequence(F.lit(1), F.lit(WALK)), F.struct(groups.alias("g"), F.lit(False).alias("done")), step,
                       lambda s: s["g"])


def _run(value: Column, key: str, inverse: bool) -> Column:
    """struct<o, n>: a run of digit groups with its cards replaced, and their number."""
    def step(s, end):
        return _let(_card_from(s["g"], s["least"], end), lambda i: F.when(i.isNull(), s).otherwise(F.struct(
            _walked(s["g"], s["least"], i, end, key, inverse).alias("g"), (end + 1).alias("least"), (s["n"] + 1).alias("n"))))

    def whole(g):
        zero = F.struct(g.alias("g"), F.lit(0).alias("least"), F.lit(0).alias("n"))
        return F.aggregate(F.sequence(F.lit(0), F.size(g) - 1), zero, step)

    # the separators stand between the groups, one each
    marks = F.split(F.regexp_replace(value, "[0-9]+", ""), "")
    return _let(_let(F.split(value, "[ -]", -1), whole), lambda s: F.struct(F.array_join(F.zip_with(
        s["g"], marks, lambda g, m: F.concat(g, F.coalesce(m, F.lit("")))), "").alias("o"), s["n"].alias("n")))


def _with_cards(part: Column, key: str, inverse: bool) -> Column:
    """struct<o, n>: the text between other candidates with its cards replaced, and their number."""
    plain = F.struct(part.alias("o"), F.lit(0).alias("n"))
    runs = F.transform(F.regexp_extract_all(part, F.lit(RUN), 0), lambda x: _run(x, key, inverse))
    woven = _let(runs, lambda r: F.struct(
        F.array_join(F.zip_with(F.split(part, RUN, -1), r, lambda text, x: F.concat(text, F.coalesce(x["o"], F.lit("")))), "").alias("o"),
        F.aggregate(r, F.lit(0), lambda s, x: s + x["n"]).alias("n")))
    return F.when(part.rlike(RUN), woven).otherwise(plain)


def _phone(value: Column, key: str, inverse: bool) -> Column:
    digits = F.regexp_replace(value, "[^0-9]", "")
    own = F.substr(digits, F.length(digits) - 9, F.lit(10))
    return refill(value, F.concat(F.substr(digits, F.lit(1), F.length(digits) - 10), permute_digits(own, key, "phone", inverse)))


#: Country codes of two digits; 1 and 7 have one, the others three.
TWO_DIGIT_CODES = "^(2[07]|3[0-469]|4[013-9]|5[1-8]|6[0-6]|8[1246]|9[0-58])"


def _phone_after(value: Column, n_kept: Column, key: str, inverse: bool) -> Column:
    """The digits after the first ``n_kept`` permuted."""
    digits = F.regexp_replace(value, "[^0-9]", "")
    own = F.substr(digits, n_kept + 1, F.length(digits) - n_kept)
    return refill(value, F.concat(F.substr(digits, F.lit(1), n_kept), permute_digits(own, key, "phone", inverse)))


def _abroad(value: Column, key: str, inverse: bool) -> Column:
    digits = F.regexp_replace(value, "[^0-9]", "")
    code = F.when(digits.rlike("^[17]"), 1).when(digits.rlike(TWO_DIGIT_CODES), 2).otherwise(3)
    return _phone_after(value, code, key, inverse)


def _ten(value: Column, key: str, inverse: bool) -> Column:
    return F.aggregate(F.sequence(F.lit(1), F.lit(WALK)), permute_digits(value, key, "phone", inverse),
                       lambda d, _: F.when(d.rlike("^[2-9]"), d).otherwise(permute_digits(d, key, "phone", inverse)))


def _ssn(value: Column, key: str, inverse: bool) -> Column:
    digits = F.regexp_replace(value, "-", "")
    start = permute_digits(digits, key, "ssn", inverse)
    walked = F.aggregate(F.sequence(F.lit(1), F.lit(64)), start,
                         lambda d, _: F.when(_ssn_valid(d), d).otherwise(permute_digits(d, key, "ssn", inverse)))
    return F.when(_ssn_valid(digits), refill(value, walked)).otherwise(value)


def _ip(value: Column, key: str, inverse: bool) -> Column:
    o = F.transform(F.split(value, r"\."), lambda x: x.cast("long"))
    octet = lambda i: F.get(o, F.lit(i))
    side = F.lit(65536)
    out = feistel(octet(0) * 256 + octet(1), octet(2) * 256 + octet(3), side, side, key, "ip", inverse)
    return F.concat_ws(".", *(x.cast("string") for h in ("a", "b")
                              for x in (F.floor(out[h] / 256).cast("long"), out[h] % 256)))


def _date(value: Column, key: str, inverse: bool) -> Column:
    iso = value.rlike("^[0-9]{4}-")
    dots = value.contains(".")
    us = F.try_to_date(value, "MM/dd/yyyy")
    day = F.when(iso, F.try_to_date(value, "yyyy-MM-dd")).when(dots, F.try_to_date(value, "dd.MM.yyyy")) \
        .otherwise(F.coalesce(us, F.try_to_date(value, "dd/MM/yyyy")))
    n = F.datediff(day, F.to_date(F.lit(DATE_ORIGIN)))
    side = F.lit(DATE_SIDE)
    out = feistel(F.floor(n / DATE_SIDE), n % DATE_SIDE, side, side, key, "date", inverse)
    new = F.date_add(F.to_date(F.lit(DATE_ORIGIN)), (out["a"] * DATE_SIDE + out["b"]).cast("int"))
    shown = F.when(iso, F.date_format(new, "yyyy-MM-dd")).when(dots, F.date_format(new, "dd.MM.yyyy")) \
        .when(us.isNotNull(), F.date_format(new, "MM/dd/yyyy")).otherwise(F.date_format(new, "dd/MM/yyyy"))
    ok = day.isNotNull() & (n >= 0) & (n < DATE_SIDE * DATE_SIDE)
    return F.when(ok, shown).otherwise(value)


def _iban_check(country: Column, bban: Column) -> Column:
    """The two check digits: 98 less the number, letters as 10 to 35, modulo 97."""
    def step(r, c):
        return F.when(c.rlike("[0-9]"), r * 10 + F.ascii(c) - 48).otherwise(r * 100 + F.ascii(c) - 55) % 97

    left = F.aggregate(F.split(F.concat(bban, country, F.lit("00")), ""), F.lit(0), step)
    return F.lpad((98 - left).cast("string"), 2, "0")


def _iban(value: Column, key: str, inverse: bool) -> Column:
    """Digits behind the check digits permuted; candidates with a wrong check or fewer than six such digits stay."""
    flat = F.regexp_replace(value, " ", "")
    country, bban = F.substring(flat, 1, 2), F.substr(flat, F.lit(5), F.length(flat) - 4)
    digits = F.regexp_replace(bban, "[^0-9]", "")
    new = _let(permute_digits(digits, key, "iban", inverse),
               lambda d: refill(value, F.concat(_iban_check(country, refill(bban, d)), d)))
    return F.when((F.substring(flat, 3, 2) == _iban_check(country, bban)) & (F.length(digits) >= 6), new).otherwise(value)


def _secret(value: Column, key: str) -> Column:
    name = F.regexp_extract(value, "^(AKIA|gh[pousr]_|sk-|xox[abprs]-|[Bb]earer |[^=:]*[=:][ ]?[\"']?)", 1)
    size = F.length(value) - F.length(name)
    hexes = F.repeat(_digest(key, F.lit("secret"), value), F.ceil(size / 64).cast("int"))
    return F.concat(name, F.when(value.startswith("AKIA"), F.upper(F.substr(hexes, F.lit(1), size)))
                    .otherwise(F.substr(hexes, F.lit(1), size)))


def pseudonym(value: Column, key: str, inverse: bool = False) -> Column:
    """The pseudonym of one candidate, by its kind (mail addresses and secrets aren't invertible and stay then)."""
    whole = {k: value.rlike(f"^(?:{PATTERNS[k]})$") for k in PATTERNS}
    mail = F.concat(F.lit("u"), F.substring(_digest(key, F.lit("email"), F.lower(value)), 1, 16), F.lit("@pseudonym.example"))
    return (F.when(whole["iban"], _iban(value, key, inverse))
            .when(whole["email"], value if inverse else mail)
            .when(whole["phone"], _phone(value, key, inverse))
            .when(whole["date"], _date(value, key, inverse))
            .when(whole["ssn"], _ssn(value, key, inverse))
            .when(whole["ip"], _ip(value, key, inverse))
            .when(whole["abroad"], _abroad(value, key, inverse))
            .when(whole["trunk"], _phone_after(value, F.lit(2), key, inverse))
            .when(whole["spanish"], _phone_after(value, F.lit(1), key, inverse))
            .when(whole["ten"], _ten(value, key, inverse))
            .otherwise(value if inverse else _secret(value, key)))


def pseudonymise(docs: DataFrame, key: str, text_col: str = "text", inverse: bool = False,
                 count: str = "_n_replaced") -> DataFrame:
    """``docs`` with personal data in the text replaced, plus the column ``count`` (a column of that name is replaced)."""
    text = F.col(text_col)
    found, new, parts = fresh(docs, "_found", "_new", "_parts")
    maybe = text.rlike(MAYBE)
    out = docs.withColumn(found, F.when(maybe, F.regexp_extract_all(text, F.lit(PATTERN), 0)))
    out = out.withColumn(new, F.transform(found, lambda x: pseudonym(x, key, inverse)))
    out = out.withColumn(parts, F.when(maybe, F.transform(F.split(text, PATTERN, -1), lambda x: _with_cards(x, key, inverse))))
    woven = F.array_join(F.zip_with(parts, new, lambda part, value: F.concat(part["o"], F.coalesce(value, F.lit("")))), "")
    changed = (F.size(F.filter(F.zip_with(found, new, lambda a, b: a != b), lambda x: x))
               + F.aggregate(parts, F.lit(0), lambda s, x: s + x["n"]))
    return (out.withColumn(text_col, F.when(maybe, woven).otherwise(text))
            .withColumn(count, F.when(maybe, changed).otherwise(F.lit(0)).cast("long"))
            .drop(found, new, parts))
