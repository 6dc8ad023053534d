"""Format-preserving pseudonyms by keyed Feistel permutations.

Validated values are permuted within their format: a card number becomes another
card number with a right check digit, a date another date in the same notation,
an address of a machine another address. The permutation depends only on the
key, the kind and the form of the value, so equal values get equal pseudonyms in
all documents, and different values of one form get different ones.

Two Feistel networks are used. Characters: the value is cut in two halves; in
every round each letter or digit of one half is shifted within its own class by
a stream derived from the key and the other half. Numbers: a pair of residues;
in every round one is shifted by a keyed value of the other. Both can be undone
with the key. Where not every result is valid, the permutation is repeated until
one is (cycle walking), which keeps it one to one.

Kinds: ``email``, ``iban`` (checksum 97), ``card`` (13 to 19 digits, Luhn; the
first digit stays), ``ssn``, ``ip`` (version 4), ``date`` (year first, month
first or day first; real dates of the years 1 to 9999), ``phone`` (the country code stays) and
``secret`` (access keys and values of password-like settings). What fails its
validation stays as it is. Numbers that follow each other are searched for cards in runs
of 128 groups; a card across the border of two such runs is not found. A null text stays null, an empty one empty; repeated
rows are treated alike; all other text is kept to the character.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

ROUNDS = 8
WALK = 64

# How the kinds look.
_EMAIL = r"(?<![\w.%+-])[A-Za-z0-9][A-Za-z0-9._%+-]*+@(?:[A-Za-z0-9-]{1,63}+\.){1,126}[A-Za-z]{2,}"
# Lengths of account numbers by country; other lengths and countries are tried after them.
_IBAN_LENGTHS = {
    15: "NO", 16: "BE", 18: "DK FI FK FO GL NL SD", 19: "MK SI", 20: "AT BA EE KZ LT LU MN XK",
    21: "CH HR LI LV", 22: "BG BH CR DE GB GE IE ME RS VA", 23: "AE GI IL IQ OM SO TL",
    24: "AD CZ ES MD PK RO SA SE SK TN VG", 25: "LY PT ST", 26: "IS TR",
    27: "BI DJ FR GR IT MC MR SM", 28: "AL AZ BY CY DO GT HN HU LB NI PL SV", 29: "BR EG PS QA UA",
    30: "JO KW MU YE", 31: "MT SC", 32: "LC", 33: "RU"}
_IBAN = r"(?<!\w)(?:" + "|".join(
    rf"(?:{names.replace(' ', '|')})\d{{2}}(?: ?[A-Z0-9]{{4}}){{{size // 4 - 1}}}"
    + rf"(?: ?[A-Z0-9]{{{size % 4}}})" * (size % 4 > 0) + r"(?!\w)"
    for size, names in _IBAN_LENGTHS.items()
) + r"|[A-Z]{2}\d{2}(?: ?[A-Z0-9]{4}){2,7}(?: ?[A-Z0-9]{1,3})?(?!\w))"
_OCTET = r"(?:25[0-5]|2[0-4]\d|1\d\d|[1-9]?\d)"
_IP = rf"(?<![\w.])(?:{_OCTET}\.){{3}}{_OCTET}(?![\w]|\.\d)"
_DATE = (r"(?<![\w./-])(?:\d{4}-\d{2}-\d{2}|\d{4}/\d{2}/\d{2}|\d{1,2}/\d{1,2}/\d{4}"
         r"|\d{1,2}\.\d{1,2}\.\d{4})(?![\w/-]|\.\d)")
_SSN = r"(?<![\w-])\d{3}-\d{2}-\d{4}(?![\w-])"
# A run of groups of digits; the cards are looked for inside it, at borders of its groups.
# Loops over groups are possessive, which Java walks without recursion however long the
# run is: a group that touches a letter, or a hyphen before something else, is refused
# where it begins. A longer run is divided after GROUPS groups. No card has a group of
# more than 19 digits, and what follows 13 digits is checked by looking back.
GROUPS = 128
_GROUP = r"\d{1,19}+(?![\w]|-(?!\d))"
_TAIL_GROUP = r"\d{1,19}+(?![\w]|-(?!\d)|[./]\d)"
_LONG = r"(?<=\d[ -]?" + r"\d[ -]?" * 11 + r"\d)"
_CARD = "|".join(rf"(?<![\w+-]){_GROUP}(?:[ -]{group}){{0,{GROUPS - 1}}}+{_LONG}(?![\w-])"
                 for group in (_TAIL_GROUP, _GROUP))
# The longest card with its separators, and the character behind it.
_CARD_REACH = 38
_CARD_FORMS = (r"^\d{13,19}(?!\d)", r"^\d{4}([ -])\d{4}\1\d{4}\1\d{4}(?!\d)",
               r"^\d{4}[ -]\d{6}[ -]\d{4,5}(?!\d)", r"^\d{4}(?:[ -]\d{4}){3}[ -]\d{1,3}(?!\d)")
_CARD_SIZES = tuple(rf"^\d(?:[ -]?\d){{{size - 1}}}(?!\d)" for size in (16, 15, 14, 13, 17, 18, 19))
_PHONE = (r"(?<![\w+])\+1[ .-]?\(?\d{3}\)?[ .-]?\d{3}[ .-]?\d{4}(?!\w)"
          r"|(?<![\w+])\+\d{1,3}[ .-]?(?:\(\d{1,4}\)[ .-]?)?\d{1,4}(?:[ .-]?\d{2,4}){1,5}(?!\w)"
          r"|(?<![\w(+-])(?:\(\d{3}\) ?|\d{3}[.-])\d{3}[ .-]\d{4}(?![\w-])")
_SECRET = (r"(?<!\w)(?:AKIA|ASIA)[0-9A-Z]{16}(?!\w)"
           r"|(?i:(?<![a-z0-9])(?:password|passwd|pwd|secret|token|api_?key))"
           r"\s?[=:]\s?[\"']?[^\s\"']{5,}[A-Za-z0-9]")
ANY = "|".join((_EMAIL, _SECRET, _IBAN, _IP, _DATE, _SSN, _CARD, _PHONE))
_SECRET_NAME = r"^(?:AKIA|ASIA|(?i:[a-z_]+)\s?[=:]\s?[\"']?)"

# Days permuted together: 250 * 292 days, about two centuries.
_DAYS_A, _DAYS_B = 250, 292


def _keyed(key: str, kind: str, round_: Column, other: Column) -> Column:
    """64 hexadecimal digits from key, kind, round and the other half."""
    return F.sha2(F.concat_ws("\0", F.lit(key), F.lit(kind), round_.cast("string"), other), 256)


def _byte(digest: Column, i: Column) -> Column:
    return F.conv(F.substr(digest, (i % 31) * 2 + 1, F.lit(3)), 16, 10).cast("int")


def _shifted(char: Column, by: Column) -> Column:
    """The character moved within digits, small or capital letters; others stay."""
    code = F.ascii(char)

    def within(first: str, size: int) -> Column:
        return F.char(F.lit(ord(first)) + F.pmod(code - ord(first) + by, F.lit(size)))
    return (F.when(char.between("0", "9") & (F.length(char) == 1), within("0", 10))
            .when(char.rlike("^[a-z]$"), within("a", 26))
            .when(char.rlike("^[A-Z]$"), within("A", 26)).otherwise(char))


def permute_characters(value: Column, key: str, kind: str, inverse: bool = False) -> Column:
    """Feistel over the characters of a string; its form stays."""
    sign = -1 if inverse else 1

    def turned(half: Column, other: Column, round_: Column) -> Column:
        digest = _keyed(key, kind, round_, other)
        return F.array_join(F.transform(
            F.split(half, ""), lambda c, i: _shifted(c, sign * _byte(digest, i))), "")

    def step(state: Column, i: Column) -> Column:
        round_ = F.lit(ROUNDS + 1) - i if inverse else i
        odd = round_ % 2 == 1
        return F.struct(
            F.when(odd, turned(state["a"], state["b"], round_)).otherwise(state["a"]).alias("a"),
            F.when(odd, state["b"]).otherwise(turned(state["b"], state["a"], round_)).alias("b"))
    cut = F.floor(F.length(value) / 2).cast("int")
    return F.aggregate(
        F.sequence(F.lit(1), F.lit(ROUNDS)),
        F.struct(F.substr(value, F.lit(1), cut).alias("a"),
                 F.substr(value, cut + 1, F.length(value)).alias("b")),
        step, lambda state: F.concat(state["a"], state["b"]))


def permute_number(value: Column, a: int, b: int, key: str, kind: str,
                   inverse: bool = False) -> Column:
    """Feistel over the numbers 0 to a * b - 1."""
    sign = -1 if inverse else 1

    def drawn(other: Column, round_: Column) -> Column:
        digest = _keyed(key, kind, round_, other.cast("string"))
        return sign * F.conv(F.substring(digest, 1, 12), 16, 10).cast("long")

    def step(state: Column, i: Column) -> Column:
        round_ = F.lit(ROUNDS + 1) - i if inverse else i
        odd = round_ % 2 == 1
        return F.struct(
            F.when(odd, F.pmod(state["l"] + drawn(state["r"], round_), F.lit(a)))
            .otherwise(state["l"]).cast("long").alias("l"),
            F.when(odd, state["r"]).otherwise(
                F.pmod(state["r"] + drawn(state["l"], round_), F.lit(b))).cast("long").alias("r"))
    return F.aggregate(
        F.sequence(F.lit(1), F.lit(ROUNDS)),
        F.struct(F.floor(value / b).cast("long").alias("l"),
                 (value % b).cast("long").alias("r")),
        step, lambda state: state["l"] * b + state["r"])


def _digits(value: Column) -> Column:
    return F.regexp_replace(value, r"\D", "")


def _refilled(form: Column, digits: Column) -> Column:
    """The digits put one by one into the places of digits of a form."""
    return F.aggregate(
        F.split(form, ""), F.struct(F.lit("").alias("out"), F.lit(1).alias("at")),
        lambda s, c: F.when(
            c.rlike(r"^\d$"), F.struct(
                F.concat(s["out"], F.substr(digits, s["at"], F.lit(1))).alias("out"),
                (s["at"] + 1).alias("at"))).otherwise(
            F.struct(F.concat(s["out"], c).alias("out"), s["at"].alias("at"))),
        lambda s: s["out"])


def luhn_sum(digits: Column) -> Column:
    """Luhn sum of digits whose last one is the check digit."""
    return F.aggregate(
        F.split(F.reverse(digits), ""), F.struct(F.lit(0).alias("sum"), F.lit(0).alias("i")),
        lambda s, c: F.struct(
            (s["sum"] + F.when(s["i"] % 2 == 0, c.cast("int")).otherwise(
                F.when(c.cast("int") > 4, c.cast("int") * 2 - 9).otherwise(c.cast("int") * 2))
             ).cast("int").alias("sum"), (s["i"] + 1).alias("i")),
        lambda s: s["sum"])


def _card(value: Column, key: str) -> Column:
    digits = _digits(value)
    inner = permute_characters(F.substr(digits, F.lit(2), F.length(digits) - 2), key, "card")
    front = F.concat(F.substr(digits, F.lit(1), F.lit(1)), inner)
    check = F.pmod(-luhn_sum(F.concat(front, F.lit("0"))), F.lit(10)).cast("string")
    return _refilled(value, F.concat(front, check))


def iban_rest(value: Column) -> Column:
    """Remainder by 97 of an account number without spaces, 1 if it is valid."""
    turned = F.concat(F.substr(value, F.lit(5), F.length(value)), F.substr(value, F.lit(1), F.lit(4)))
    return F.aggregate(
        F.split(turned, ""), F.lit(0),
        lambda rest, c: F.when(c.rlike(r"^\d$"), (rest * 10 + c.cast("int")) % 97).otherwise(
            (rest * 100 + F.ascii(c) - 55) % 97).cast("int"))


def _iban(value: Column, key: str) -> Column:
    plain = F.regexp_replace(value, " ", "")
    country = F.substr(plain, F.lit(1), F.lit(2))
    account = permute_characters(F.substr(plain, F.lit(5), F.length(plain)), key, "iban")
    check = F.lpad((98 - iban_rest(F.concat(country, F.lit("00"), account))).cast("string"), 2, "0")
    made = F.concat(country, check, account)
    # Back into the groups of the original.
    return F.aggregate(
        F.split(value, ""), F.struct(F.lit("").alias("out"), F.lit(1).alias("at")),
        lambda s, c: F.when(c == " ", F.struct(
            F.concat(s["out"], c).alias("out"), s["at"].alias("at"))).otherwise(
            F.struct(F.concat(s["out"], F.substr(made, s["at"], F.lit(1))).alias("out"),
                     (s["at"] + 1).alias("at"))),
        lambda s: s["out"])


def _walked(value: Column, step, valid) -> Column:
    """The first valid result of repeated steps, at most WALK of them."""
    return F.aggregate(
        F.sequence(F.lit(1), F.lit(WALK)), F.struct(value.alias("v"), F.lit(False).alias("done")),
        lambda s, i: F.when(s["done"], s).otherwise(_step_of(step(s["v"]), valid)),
        lambda s: F.when(s["done"], s["v"]).otherwise(value))


def _step_of(made: Column, valid) -> Column:
    return F.element_at(F.transform(F.array(made), lambda v: F.struct(
        v.alias("v"), valid(v).alias("done"))), 1)


def _ssn_valid(digits: Column) -> Column:
    return digits.rlike(r"^(?!000|666|9)\d{3}(?!00)\d{2}(?!0000)\d{4}$")


def _ssn(value: Column, key: str) -> Column:
    return _refilled(value, _walked(
        _digits(value), lambda v: permute_characters(v, key, "ssn"), _ssn_valid))


def _ip(value: Column, key: str) -> Column:
    octets = F.split(value, r"\.")
    number = F.aggregate(octets, F.lit(0).cast("long"), lambda n, o: n * 256 + o.cast("long"))
    made = permute_number(number, 1 << 16, 1 << 16, key, "ip")
    return F.element_at(F.transform(F.array(made), lambda n: F.concat_ws(".", *[
        (F.shiftright(n, shift) % 256).cast("string") for shift in (24, 16, 8, 0)])), 1)


def _date_parts(value: Column) -> tuple[Column, Column]:
    """The date, and whether month and day stand day first; null if there is none.

    Slashes mean month first unless that is no date; full stops mean day first.
    """
    p = F.split(value, r"[-/.]")

    def made(y: int, m: int, d: int) -> Column:
        text = F.concat_ws("-", F.lpad(p[y], 4, "0"), F.lpad(p[m], 2, "0"), F.lpad(p[d], 2, "0"))
        return F.when(p[y].cast("int") > 0, F.try_to_date(text, "yyyy-MM-dd"))
    year_first = value.rlike(r"^\d{4}")
    month_first, day_first = made(2, 0, 1), made(2, 1, 0)
    dotted = value.contains(".")
    return (F.when(year_first, made(0, 1, 2)).when(dotted, day_first)
            .otherwise(F.coalesce(month_first, day_first)),
            ~year_first & (dotted | month_first.isNull()))


def _date(value: Column, key: str) -> Column:
    """Days are permuted in blocks of 73,000, so a date stays near its centuries.

    A date that can only be read day first becomes one of the same kind. Padding
    follows the original; without padding both lengths are the form.
    """
    date, day_first = _date_parts(value)
    slashed = day_first & value.contains("/")
    size = _DAYS_A * _DAYS_B
    day = F.datediff(date, F.lit("0001-01-01").cast("date")).cast("long")

    def step(n: Column) -> Column:
        return F.floor(n / size).cast("long") * size + permute_number(
            n % size, _DAYS_A, _DAYS_B, key, "date")

    def back(n: Column) -> Column:
        return F.date_add(F.lit("0001-01-01").cast("date"), n.cast("int"))
    moved = _walked(day, step, lambda n: (n < 3652059) & (
        ~slashed | (F.dayofmonth(back(n)) > 12)))
    sep = F.regexp_extract(value, r"\d([-/.])", 1)
    padded = F.length(value) == 10

    def part(n: Column) -> Column:
        return F.when(padded, F.lpad(n.cast("string"), 2, "0")).otherwise(n.cast("string"))
    def written(d: Column) -> Column:
        year = F.lpad(F.year(d).cast("string"), 4, "0")
        month, monthday = F.month(d), F.dayofmonth(d)
        return F.when(value.rlike(r"^\d{4}"), F.concat(
            year, sep, F.lpad(month.cast("string"), 2, "0"), sep,
            F.lpad(monthday.cast("string"), 2, "0"))).otherwise(F.concat(
                F.when(day_first, part(monthday)).otherwise(part(month)), sep,
                F.when(day_first, part(month)).otherwise(part(monthday)), sep, year))
    return F.element_at(F.transform(F.array(back(moved)), written), 1)


def _phone(value: Column, key: str) -> Column:
    code = F.regexp_extract(value, r"^(\+\d{1,3}(?=[ .(-])|\+\d)?", 1)
    rest = F.substr(value, F.length(code) + 1, F.length(value))
    return F.concat(code, _refilled(rest, permute_characters(_digits(rest), key, "phone")))


def _email(value: Column, key: str) -> Column:
    """Everything but the dots, the sign and the top-level domain is permuted."""
    top = F.concat(F.lit("."), F.substring_index(value, ".", -1))
    front = F.substr(value, F.lit(1), F.length(value) - F.length(top))
    return F.concat(permute_characters(front, key, "email"), top)


def _secret(value: Column, key: str) -> Column:
    name = F.regexp_extract(value, _SECRET_NAME, 0)
    return F.concat(name, permute_characters(
        F.substr(value, F.length(name) + 1, F.length(value)), key, "secret"))


def kind_of(value: Column) -> Column:
    """Kind of a found value, null if it fails its validation."""
    digits = _digits(value)
    return (F.when(value.rlike(rf"^(?:{_SECRET})$"), "secret")
            .when(value.contains("@"), "email")
            .when(value.rlike("^[A-Z]{2}"), F.when(
                iban_rest(F.regexp_replace(value, " ", "")) == 1, "iban"))
            .when(value.rlike(rf"^(?:{_IP})$"), "ip")
            .when(value.rlike(rf"^(?:{_DATE})$"), F.when(
                _date_parts(value)[0].isNotNull(), "date"))
            .when(value.rlike(rf"^(?:{_SSN})$"), F.when(_ssn_valid(digits), "ssn"))
            .when(value.rlike(rf"^(?:{_CARD})$") & F.length(digits).between(13, 19)
                  & (luhn_sum(digits) % 10 == 0), "card")
            .when(value.rlike(rf"^(?:{_PHONE})$") & F.length(digits).between(7, 15), "phone"))


_PIECES = "array<struct<value:string,kind:string>>"


def _piece(value: Column, kind: Column) -> Column:
    return F.struct(value.alias("value"), kind.cast("string").alias("kind"))


def _with_cards(run: Column, forms: tuple) -> Column:
    """Pieces of a run of digits: valid cards of the forms, from the left, and what is between."""
    def card_at(i: Column) -> Column:
        rest = F.substr(run, i, F.lit(_CARD_REACH))
        return F.get(F.filter(F.array(*[F.regexp_extract(rest, form, 0) for form in forms]),
                              lambda c: (c != "") & (luhn_sum(_digits(c)) % 10 == 0)), F.lit(0))

    def step(s: Column, i: Column) -> Column:
        return F.element_at(F.transform(F.array(F.when(i >= s["at"], card_at(i))), lambda c: F.when(
            c.isNull(), s).otherwise(F.struct(
                (i + F.length(c)).cast("int").alias("at"),
                F.concat(s["out"], F.array(
                    _piece(F.substr(run, s["at"], i - s["at"]), F.lit(None)),
                    _piece(c, F.lit("card")))).cast(_PIECES).alias("out")))), 1)
    starts = F.filter(F.sequence(F.lit(1), F.greatest(F.length(run), F.lit(1))), lambda i: (
        (i == 1) | ~F.substr(run, i - 1, F.lit(1)).rlike(r"\d")) & F.substr(run, i, F.lit(1)).rlike(r"\d"))
    return F.aggregate(
        starts, F.struct(F.lit(1).alias("at"), F.array().cast(_PIECES).alias("out")), step,
        lambda s: F.concat(s["out"], F.array(_piece(
            F.substr(run, s["at"], F.length(run)), F.lit(None)))).cast(_PIECES))


def _with_others(run: Column) -> Column:
    """Pieces of a run of digits: dates, numbers of persons and phones, and what is between."""
    other = "|".join((_DATE, _SSN, _PHONE))
    return F.flatten(F.zip_with(
        F.split(run, other, -1), F.regexp_extract_all(run, F.lit(other), F.lit(0)),
        lambda piece, hit: F.array(_piece(piece, F.lit(None)), _piece(
            F.coalesce(hit, F.lit("")), kind_of(hit))))).cast(_PIECES)


def _inside(pieces: Column, split) -> Column:
    return F.flatten(F.transform(pieces, lambda p: F.when(
        p["kind"].isNotNull(), F.array(p)).otherwise(split(p["value"])).cast(_PIECES)))


def pieces_of(value: Column) -> Column:
    """A found value as pieces with their kinds; only a failed run of digits has several."""
    whole = F.array(_piece(value, kind_of(value))).cast(_PIECES)
    parts = _with_cards(value, _CARD_FORMS)
    for split in (_with_others, lambda rest: _with_cards(rest, _CARD_SIZES)):
        parts = _inside(parts, split)
    failed = value.rlike(rf"^(?:{_CARD})$")
    return F.flatten(F.transform(whole, lambda p: F.when(
        failed & p["kind"].isNull(), parts).otherwise(F.array(p)).cast(_PIECES)))


def pseudonym(value: Column, kind: Column, key: str) -> Column:
    """The pseudonym of a value of a kind; a value without kind stays."""
    made = {"email": _email, "secret": _secret, "iban": _iban, "ip": _ip, "date": _date,
            "ssn": _ssn, "card": _card, "phone": _phone}
    out = F.when(kind.isNull(), value)
    for name, make in made.items():
        out = out.when(kind == name, make(value, key))
    return out


def pseudonymize(docs: DataFrame, key: str, text: str = "text",
                 found: str | None = None) -> DataFrame:
    """The table with the values in ``text`` replaced.

    ``found`` names a column for what was replaced: an array of ``kind`` and
    ``pseudonym``, in the order of the text; it holds no original.
    """
    source = F.col(f"`{text}`")
    hits = docs.select("*", F.when(source.rlike("[0-9@]|(?i:password|passwd|pwd|secret|token|key)"),
                                   F.regexp_extract_all(source, F.lit(ANY), F.lit(0)))
                       .alias("_pii_hits"))
    typed = hits.withColumn("_pii_hits", F.when(F.size("_pii_hits") > 0, F.transform(
        "_pii_hits", pieces_of)))
    made = typed.withColumn("_pii_hits", F.transform("_pii_hits", lambda h: F.transform(
        h, lambda p: F.struct(p["kind"].alias("kind"),
                              pseudonym(p["value"], p["kind"], key).alias("pseudonym")))))
    replaced = F.when(F.col("_pii_hits").isNull(), source).otherwise(F.array_join(F.zip_with(
        F.split(source, ANY, -1), F.col("_pii_hits"), lambda piece, hit: F.concat(
            piece, F.coalesce(F.array_join(hit["pseudonym"], ""), F.lit("")))), ""))
    out = [replaced.alias(text) if name == text else F.col(f"`{name}`") for name in docs.columns]
    if found:
        out = [column for column, name in zip(out, docs.columns, strict=True) if name != found]
        out.append(F.coalesce(F.filter(F.flatten("_pii_hits"), lambda h: h["kind"].isNotNull()),
                              F.array().cast("array<struct<kind:string,pseudonym:string>>")
                              ).alias(found))
    return made.select(*out)
