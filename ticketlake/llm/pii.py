"""Format-preserving pseudonyms for personal data, in built-in functions only.

One pattern finds candidates. Each candidate is validated (Luhn and mod-97
check digits, calendar dates, octets, number ranges); what fails stays as it
is. A valid value is permuted inside its own format by a keyed Feistel
network, so the result is valid again, two different values never get the
same pseudonym, and equal values get equal pseudonyms in every document,
however they are punctuated.

Two networks are used. Strings of digits and letters: the characters are cut
into two halves, and each round shifts every character of one half inside its
class (digit, letter) by a key stream of the other half. Values with a range
(dates, addresses, social security numbers): the value's index in the range
``n_a * n_b`` is a pair, and each round adds a keyed function of one
coordinate to the other.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import table

ROUNDS = 10
#: Characters of a secret that are permuted together.
SECRET_BLOCK = 256
DEFAULT_KEY = "change-me"

_L, _R = r"(?<![\p{L}\p{N}])", r"(?![\p{L}\p{N}])"
#: Characters of a secret; it has a digit or begins with 16 letters and digits.
_SECRET = r"[A-Za-z0-9_~+/=.:@!#$%^*?\-]"
_NAMED = r"(?i:token|secret|password|passwd|api_?key|key)\s{0,3}[=:]\s{0,3}[\"']?"
#: Length of an account number by country.
IBAN_LENGTHS = {
    15: "NO", 16: "BE", 18: "DK FI FK FO GL NL SD", 19: "MK SI", 20: "AT BA EE KZ LT LU MN XK", 21: "CH HR LI LV",
    22: "BG BH CR DE GB GE IE ME RS VA", 23: "AE GI IL IQ OM SO TL", 24: "AD CZ ES MD PK RO SA SE SK TN VG",
    25: "LY PT ST", 26: "IS TR", 27: "BI DJ FR GR IT MC MR SM", 28: "AL AZ BY CY DO GT HN HU LB NI PL SV",
    29: "BR EG PS QA UA", 30: "JO KW MU YE", 31: "MT SC", 32: "LC", 33: "RU"}
_IBAN = "|".join(rf"(?:{c.replace(' ', '|')})\d{{2}}(?: ?[A-Z0-9]{{4}}){{{n // 4 - 1}}}" + (rf" ?[A-Z0-9]{{{n % 4}}}" if n % 4 else "") + _R
                 for n, c in IBAN_LENGTHS.items())
_ELSEWHERE = "(?!" + "|".join(IBAN_LENGTHS.values()).replace(" ", "|") + r")[A-Z]{2}\d{2}(?: ?[A-Z0-9]{4}){2,7}(?: ?[A-Z0-9]{1,3})?" + _R
#: What may stand between two digits of a phone number.
_GAP = r"(?:[ \u00A0]?\(|\)[ \u00A0.\-]?|[ \u00A0./\-])"
#: Candidates by kind, in the order in which they are tried at a place.
KINDS = {
    "secret": "(?:" + _L + _NAMED + rf"(?!https?://)(?=[A-Za-z0-9]{{16}}|{_SECRET}*[0-9]){_SECRET}{{16,}}+"
              + r"|(?<=[\"'])[0-9A-Fa-f]{32,}+(?=[\"']))",
    "email": r"(?<![\p{L}\p{N}._%+\-])[\p{L}\p{N}._%+\-]{1,64}+@(?:[\p{L}\p{N}\-]{1,63}+\.){1,8}\p{L}{2,24}" + _R,
    "iban": _L + r"(?=[A-Z]{2}\d{2})(?:" + _IBAN + "|" + _ELSEWHERE + ")",
    "date": _L + r"(?:(?:19|20)\d{2}([\-/.])\d{2}\1\d{2}|\d{2}([\-/.])\d{2}\2(?:19|20)\d{2})" + r"(?![\p{L}\p{N}]|[\-/.]\d)",
    "ip": r"(?<![\p{L}\p{N}.])(?:\d{1,3}\.){3}\d{1,3}(?![\p{L}\p{N}]|\.\d)",
    "ssn": r"(?<![\p{L}\p{N}\-])\d{3}-\d{2}-\d{4}(?![\p{L}\p{N}]|-\d)",
    "phone": rf"(?:\+\d(?:{_GAP}?\d){{6,14}}|(?<![\p{{L}}\p{{N}}\-.])00[1-9]\d{{0,2}}{_GAP}\d(?:{_GAP}?\d){{5,11}}|"
             + _L + r"\(\d{3}\) ?\d{3}[\-. ]\d{4}|(?<![\p{L}\p{N}\-.])\d{3}[\-. ]\d{3}[\-. ]\d{4})" + _R,
    "card": _L + r"(?:\d{13,19}|\d{4}([ \-])\d{4}\3\d{4}\3\d{1,7}|\d{4}[ \-]\d{6}[ \-]\d{5})" + _R,
}
#: All kinds as one pattern (the back references count groups over the whole).
PATTERN = "(?:" + "|".join(KINDS.values()) + ")"

LETTERS, DIGITS = "abcdefghijklmnopqrstuvwxyz", "0123456789"


def _hash_number(*parts: Column) -> Column:
    """A keyed number under 2^60."""
    return F.conv(F.substring(F.sha2(F.concat_ws("|", *parts).cast("binary"), 256), 1, 15), 16, 10).cast("long")


def bound(v: Column, f) -> Column:
    """``f(v)`` with ``v`` evaluated once (a lambda would evaluate it for each element)."""
    return F.element_at(F.transform(F.array(v), f), 1)


def feistel_pair(a: Column, b: Column, n_a: int, n_b: int, tweak: str, key: str) -> Column:
    """struct(a, b) permuted inside n_a x n_b."""
    def step(s: Column, i: Column) -> Column:
        f = lambda v: _hash_number(F.lit(key), F.lit(tweak), i, v)
        return F.when(i % 2 == 0, F.struct(((s["a"] + f(s["b"])) % n_a).alias("a"), s["b"].alias("b"))) \
                .otherwise(F.struct(s["a"].alias("a"), ((s["b"] + f(s["a"])) % n_b).alias("b")))

    start = F.struct(a.cast("long").alias("a"), b.cast("long").alias("b"))
    return F.aggregate(F.sequence(F.lit(0), F.lit(ROUNDS - 1)), start, step)


def feistel_chars(values: Column, radix: Column, tweak: str, key: str) -> Column:
    """``values`` (array of long), each permuted inside 0 .. radix - 1 of its
    place. The length is part of the key: other lengths, other permutation."""
    n = F.size(values)
    h = (n / 2).cast("int")

    def shifted(xs: Column, other: Column, s: Column, at: Column, i: Column) -> Column:
        stream = F.sha2(F.concat_ws("|", F.lit(key), F.lit(tweak), s["n"], i, F.array_join(other.cast("array<string>"), ",")).cast("binary"), 512)
        return bound(stream, lambda stream: F.transform(
            xs, lambda x, k: (x + F.conv(F.substr(stream, (k % 42) * 3 + 1, F.lit(3)), 16, 10).cast("long"))
            % F.element_at(s["r"], at + k + 1)))

    def step(s: Column, i: Column) -> Column:
        rest = s["r"].alias("r"), s["n"].alias("n")
        return F.when(i % 2 == 0, F.struct(shifted(s["a"], s["b"], s, F.lit(0), i).alias("a"), s["b"].alias("b"), *rest)) \
                .otherwise(F.struct(s["a"].alias("a"), shifted(s["b"], s["a"], s, F.size(s["a"]), i).alias("b"), *rest))

    start = F.struct(F.slice(values, F.lit(1), h).alias("a"), F.slice(values, h + 1, n - h).alias("b"), radix.alias("r"), n.alias("n"))
    return F.aggregate(F.sequence(F.lit(0), F.lit(ROUNDS - 1)), start, step, lambda s: F.concat(s["a"], s["b"]))


def _chars(s: Column) -> Column:
    return F.filter(F.split(s, ""), lambda c: c != "")


def _values(chars: Column) -> Column:
    """0-9 for a digit, 0-25 for a letter; other characters -1."""
    low = F.lower(chars)
    return F.when(low.between("0", "9"), F.ascii(low) - 48).when(low.between("a", "z"), F.ascii(low) - 97) \
            .otherwise(F.lit(-1)).cast("long")


def permute_string(s: Column, tweak: str, key: str, letter_radix: Column | None = None) -> Column:
    """ASCII letters and digits of ``s`` permuted in their classes; case and
    every other character stay where they are."""
    letters = F.lit(26) if letter_radix is None else letter_radix
    places = F.filter(_chars(s), lambda c: _values(c) >= 0)
    values = F.transform(places, _values)
    radix = F.transform(places, lambda c: F.when(c.between("0", "9"), F.lit(10)).otherwise(letters).cast("long"))
    new = feistel_chars(values, radix, tweak, key)

    def put(acc: Column, c: Column) -> Column:
        v = F.element_at(acc["new"], acc["i"] + 1)
        low = F.when(c.between("0", "9"), F.chr(v + 48)).otherwise(F.chr(v + 97))
        mine = _values(c) >= 0
        out = F.when(~mine, c).when(c.between("A", "Z"), F.upper(low)).otherwise(low)
        return F.struct(acc["new"].alias("new"), F.when(mine, acc["i"] + 1).otherwise(acc["i"]).alias("i"),
                        F.concat(acc["out"], out).alias("out"))

    start = F.struct(new.alias("new"), F.lit(0).alias("i"), F.lit("").alias("out"))
    return F.when(F.size(places) == 0, s).otherwise(F.aggregate(_chars(s), start, put, lambda a: a["out"]))


def refill(form: Column, digits: Column) -> Column:
    """``form`` with its digits, from left to right, replaced by ``digits``."""
    def put(acc: Column, c: Column) -> Column:
        d = c.between("0", "9")
        return F.struct(F.when(d, acc["i"] + 1).otherwise(acc["i"]).alias("i"),
                        F.concat(acc["out"], F.when(d, F.substr(digits, acc["i"] + 1, F.lit(1))).otherwise(c)).alias("out"))

    return F.aggregate(_chars(form), F.struct(F.lit(0).alias("i"), F.lit("").alias("out")), put, lambda a: a["out"])


def _only_digits(m: Column) -> Column:
    return F.regexp_replace(m, "[^0-9]", "")


def luhn_digit(payload: Column) -> Column:
    """The check digit that makes ``payload`` + digit pass the Luhn test."""
    total = F.aggregate(F.transform(F.reverse(_chars(payload)), lambda c, i: F.when(
        i % 2 == 0, F.element_at(F.array(*[F.lit(x) for x in (0, 2, 4, 6, 8, 1, 3, 5, 7, 9)]), c.cast("int") + 1))
        .otherwise(c.cast("int"))), F.lit(0), lambda a, x: a + x)
    return ((F.lit(10) - total % 10) % 10).cast("string")


def mod97(s: Column) -> Column:
    """The number spelled by ``s`` (letters A-Z are 10-35), modulo 97."""
    return F.aggregate(_chars(s), F.lit(0).cast("long"), lambda a, c: F.when(
        c.between("0", "9"), (a * 10 + F.ascii(c) - 48) % 97).otherwise((a * 100 + F.ascii(c) - 55) % 97))


def _card(m: Column, key: str) -> Column:
    d = _only_digits(m)
    payload = F.substr(d, F.lit(1), F.length(d) - 1)
    new = permute_string(payload, "card", key)
    return F.when(luhn_digit(payload) == F.substr(d, F.length(d), F.lit(1)), refill(m, F.concat(new, luhn_digit(new))))


def _iban(m: Column, key: str) -> Column:
    flat = F.regexp_replace(m, " ", "")
    land, body = F.substr(flat, F.lit(1), F.lit(2)), F.substr(flat, F.lit(5), F.length(flat) - 4)
    valid = mod97(F.concat(body, land, F.substr(flat, F.lit(3), F.lit(2)))) == 1
    new = permute_string(body, "iban", key)
    check = F.lpad((F.lit(98) - mod97(F.concat(new, land, F.lit("00")))).cast("string"), 2, "0")
    whole = F.concat(land, check, new)
    grouped = F.when(m.contains(" "), F.trim(F.regexp_replace(whole, "(.{4})", "$1 "))).otherwise(whole)
    return F.when(valid & F.length(flat).between(15, 34), grouped)


def _phone(m: Column, key: str) -> Column:
    head = F.regexp_extract(m, r"^(?:\+\d{1,3}|00[1-9]\d{0,2})(?=[ \u00A0.(/\-])", 0)
    return F.concat(head, permute_string(F.substr(m, F.length(head) + 1, F.length(m)), "phone", key))


def _email(m: Column, key: str) -> Column:
    at = F.instr(m, "@")
    return F.concat(permute_string(F.substr(m, F.lit(1), at - 1), "email", key), F.substr(m, at, F.length(m)))


def _secret(m: Column, key: str) -> Column:
    value = F.regexp_extract(m, f"^(?:{_NAMED})?({_SECRET}+)$", 1)
    hexa = F.when(value.rlike("[A-Za-z0-9]") & ~value.rlike("[G-Zg-z]"), F.lit(6)).otherwise(F.lit(26))
    # in blocks, so that the work grows with the length and not with its square
    blocks = F.regexp_extract_all(value, F.lit(f".{{1,{SECRET_BLOCK}}}"), F.lit(0))
    new = F.array_join(bound(hexa, lambda hexa: F.transform(blocks, lambda b: permute_string(b, "secret", key, hexa))), "")
    return F.concat(F.substr(m, F.lit(1), F.length(m) - F.length(value)), new)


def _ip(m: Column, key: str) -> Column:
    o = F.transform(F.split(m, r"\."), lambda x: x.cast("int"))
    p = feistel_pair(o[0] * 256 + o[1], o[2] * 256 + o[3], 65536, 65536, "ip", key)
    text = lambda p: F.concat_ws(".", (p["a"] / 256).cast("int"), p["a"] % 256, (p["b"] / 256).cast("int"), p["b"] % 256)
    return F.when(F.array_max(o) <= 255, F.element_at(F.transform(F.array(p), text), 1))


def _ssn(m: Column, key: str) -> Column:
    n = F.transform(F.split(m, "-"), lambda x: x.cast("int"))
    valid = n[0].between(1, 899) & (n[0] != 666) & (n[1] > 0) & (n[2] > 0)
    area = F.when(n[0] > 666, n[0] - 2).otherwise(n[0] - 1)                  # 0 .. 897
    p = feistel_pair(area * 99 + n[1] - 1, n[2] - 1, 898 * 99, 9999, "ssn", key)

    def text(p: Column) -> Column:
        a = (p["a"] / 99).cast("int")
        return F.format_string("%03d-%02d-%04d", F.when(a >= 665, a + 2).otherwise(a + 1),
                               (p["a"] % 99 + 1).cast("int"), (p["b"] + 1).cast("int"))

    return F.when(valid, F.element_at(F.transform(F.array(p), text), 1))


#: 1900-01-01 to 2099-12-31: 73,049 days.
_DAY0, _DATE_A, _DATE_B = "1900-01-01", 17, 4297


def _date(m: Column, key: str) -> Column:
    """Year first, or day.month.year where that is a date, else month.day.year."""
    year_first = F.substr(m, F.lit(3), F.lit(1)).between("0", "9")
    p = F.split(m, r"[\-/.]")
    sep = F.regexp_extract(m, r"[\-/.]", 0)
    iso = lambda y, mo, d: F.try_to_timestamp(F.concat_ws("-", y, mo, d), F.lit("yyyy-MM-dd")).cast("date")
    ymd, dmy, mdy = iso(p[0], p[1], p[2]), iso(p[2], p[1], p[0]), iso(p[2], p[0], p[1])
    form = F.when(year_first & ymd.isNotNull(), F.lit("yyyy-MM-dd")).when(~year_first & dmy.isNotNull(), F.lit("dd-MM-yyyy")) \
            .when(~year_first & mdy.isNotNull(), F.lit("MM-dd-yyyy"))
    day = F.datediff(F.when(year_first, ymd).otherwise(F.coalesce(dmy, mdy)), F.lit(_DAY0).cast("date"))
    q = feistel_pair((day / _DATE_B).cast("int"), day % _DATE_B, _DATE_A, _DATE_B, "date", key)

    def text(q: Column) -> Column:
        new = F.date_add(F.lit(_DAY0).cast("date"), (q["a"] * _DATE_B + q["b"]).cast("int"))
        y, mo, d = F.date_format(new, "yyyy"), F.date_format(new, "MM"), F.date_format(new, "dd")
        return F.when(form == "yyyy-MM-dd", F.concat(y, sep, mo, sep, d)) \
                .when(form == "dd-MM-yyyy", F.concat(d, sep, mo, sep, y)).otherwise(F.concat(mo, sep, d, sep, y))

    return F.when(form.isNotNull(), F.element_at(F.transform(F.array(q), text), 1))


_PERMUTE = {"secret": _secret, "email": _email, "iban": _iban, "date": _date, "ip": _ip, "ssn": _ssn,
            "phone": _phone, "card": _card}


def pseudonym(m: Column, key: str = DEFAULT_KEY) -> Column:
    """A candidate's pseudonym; NULL if it is not a valid value of its kind."""
    return reduce(lambda out, k: F.when(m.rlike(_FULL_PLAIN[k]), _PERMUTE[k](m, key)).otherwise(out),
                  reversed(list(KINDS)), F.lit(None).cast("string"))


#: A whole candidate, without the surroundings (they were checked in the text).
_FULL_PLAIN = {
    "secret": rf"^(?:{_NAMED}|[0-9A-Fa-f]{{32,}}$)",
    "email": "@", "iban": r"^[A-Z]{2}\d{2}", "date": r"^(?:\d{4}([\-/.])\d{2}\1\d{2}|\d{2}([\-/.])\d{2}\2\d{4})$",
    "ip": r"^(?:\d{1,3}\.){3}\d{1,3}$", "ssn": r"^\d{3}-\d{2}-\d{4}$",
    "phone": rf"^(?:\+|\(|00[1-9]\d{{0,2}}{_GAP}|\d{{3}}[\-. ]\d{{3}}[\-. ]\d{{4}}$)", "card": r"^\d",
}


def pseudonymize(docs: DataFrame, key: str = DEFAULT_KEY, text: str = "text", count: str | None = "n_pseudonyms") -> DataFrame:
    """``docs`` with personal data in ``text`` replaced by pseudonyms; all
    columns stay, and ``count`` (if named) gives the values replaced.

    NULL text stays NULL (count 0), a text without candidates is unchanged.
    Every row is judged by itself, so repeated rows get equal results. Helper
    columns use a prefix that is lengthened until it clashes with no column.
    """
    pre = "__p"
    while any(c.lower().startswith(pre) for c in docs.columns):
        pre += "_"
    t = F.col(f"`{text}`")
    some = t.rlike("[0-9@]")                      # every kind has a digit or an @
    cut = docs.withColumns({
        f"{pre}m": F.when(some, F.regexp_extract_all(t, F.lit(PATTERN), F.lit(0))),
        f"{pre}g": F.when(some, F.split(t, PATTERN, -1))})
    m, g, r = F.col(f"{pre}m"), F.col(f"{pre}g"), F.col(f"{pre}r")
    put = cut.withColumn(f"{pre}r", F.transform(m, lambda x: F.when(x != "", pseudonym(x, key))))
    new = F.concat(g[0], F.array_join(F.zip_with(F.zip_with(r, m, lambda a, b: F.coalesce(a, b)),
                                                 F.slice(g, F.lit(2), F.size(m)), lambda a, b: F.concat(a, b)), ""))
    out = put.withColumn(text, F.when(F.size(m) > 0, new).otherwise(t))
    if count:
        out = out.withColumn(count, F.coalesce(F.size(F.filter(r, lambda x: x.isNotNull())), F.lit(0)).cast("long"))
    return out.select(*[F.col(f"`{c}`") for c in docs.columns], *([count] if count and count not in docs.columns else []))


def op8(spark, sf_dir):
    return pseudonymize(table(spark, sf_dir, "documents").select("doc_id", "text"))
