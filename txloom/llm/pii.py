"""Personal data replaced by pseudonyms of the same format; DataFrame functions only.

Found values are validated, then permuted by a keyed Feistel network over the set of values of their
format: a number stays a number of that kind, a date stays a date. The network is a permutation, so equal
values get equal pseudonyms in every document and different values different ones. The halves live in
Z_a x Z_b and each round adds a keyed digest of one half to the other.

* card: 13 to 19 digits, maybe grouped, with a right Luhn digit; the first digits are permuted, the check digit is made anew.
  Beside other numbers every cut of whole groups is tried, the usual groupings first, then the leftmost and longest
* phone: +1 (ddd) ddd-dddd, or +1 and ten digits grouped by spaces, dots or hyphens; the ten digits
* ssn: ddd-dd-dddd, not 000, 666 or 9dd, group and serial not zero; the nine digits
* ip: four numbers from 0 to 255; the 32 bits
* date: a day of the calendar as yyyy-mm-dd or dd.mm.yyyy or dd/mm/yyyy, years 1800 to 2199; the day number
* email: the name becomes ten keyed digits (a digest, as names have no fixed set of values); the host stays
* secret: 32 to 64 hexadecimal digits after token, key, secret or password; keyed digits, as above
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

ROUNDS = 8
DEFAULT_KEY = "txloom"

EMAIL = r"[\p{L}\p{N}._%+-]+@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)*\.[A-Za-z]{2,}"
IP = r"(?:25[0-5]|2[0-4]\d|1\d\d|[1-9]?\d)(?:\.(?:25[0-5]|2[0-4]\d|1\d\d|[1-9]?\d)){3}"
PHONE = r"\+1[ .-]?(?:\(\d{3}\)|\d{3})[ .-]?\d{3}[ .-]?\d{4}"
SSN = r"\d{3}-\d{2}-\d{4}"
ISO_DATE = r"(?:18|19|20|21)\d{2}-\d{2}-\d{2}"
DAY_DATE = r"\d{2}([./])\d{2}\1(?:18|19|20|21)\d{2}"
CARD = r"\d(?:[ -]?\d){12,18}"
SECRET = r"(?<=(?:token|secret|password|passwd|api_key|apikey|key)[ ]?[=:][ ]?[\"']?)[0-9A-Fa-f]{32,64}"

_FREE = r"(?<![\w+-])(?<!\d\.)"
_END = r"(?![\w-])(?!\.\d)"
# Numbers beside each other: any count of units parted by single spaces, a unit being groups parted by hyphens. Dates
# and numbers of another kind are no unit. Possessive, as the regex engine keeps a frame for each repetition otherwise.
_UNIT = rf"(?!(?:{SSN}|\d{{4}}-\d{{2}}-\d{{2}}){_END})(?!\d{{2}}/\d{{2}}/\d{{4}})\d{{1,19}}+(?:-\d{{1,19}}+)*+{_END}"
RUN = rf"(?=\d(?:[ -]?\d){{12}}){_UNIT}(?: {_UNIT})*+"
#: The usual groupings of cards.
CARD_GROUPS = r"\d{13,19}|\d{4}(?:[ -]\d{4}){2}[ -]\d{1,4}(?:[ -]\d{1,3})?|\d{4}[ -]\d{6}[ -]\d{4,5}"
_PATTERNS = [EMAIL, PHONE + r"(?!\d)", *(_FREE + p + _END for p in (IP, SSN, ISO_DATE, DAY_DATE)), "(?i:" + SECRET + r")(?![0-9A-Fa-f])", _FREE + RUN]
ANY = "|".join(f"(?:{p})" for p in _PATTERNS).replace(r"\1", r"[./]").replace("([./])", "[./]")
#: Seldom beside text without personal data: decides whether a text is looked at closely.
HINT = r"@|\+1[\d( .-]|\d[\d -]{7}|\d\.\d{1,3}\.\d|\d[./]\d\d[./]\d{4}|[0-9A-Fa-f]{32}"

#: 1800 to 2199 is one turn of the Gregorian calendar: 400 years of 146,097 days = 189 x 773.
FIRST_DAY = "1800-01-01"
DAY_FACTORS = (189, 773)


def _feistel(x: Column, y: Column, a: Column, b: Column, kind: str, key: str) -> Column:
    """(x, y) in Z_a x Z_b permuted: struct<x, y>."""

    def round_(state: Column, k: Column) -> Column:
        even = k % 2 == 0
        half = F.when(even, state["y"]).otherwise(state["x"])
        digest = F.sha2(F.concat_ws("|", F.lit(key), F.lit(kind), a, b, k, half), 256)
        added = F.conv(F.substring(digest, 1, 15), 16, 10).cast("long")
        return F.struct(
            F.when(even, (state["x"] + added % a) % a).otherwise(state["x"]).alias("x"),
            F.when(even, state["y"]).otherwise((state["y"] + added % b) % b).alias("y"),
        )

    start = F.struct(x.cast("long").alias("x"), y.cast("long").alias("y"))
    return F.aggregate(F.array(*[F.lit(k) for k in range(ROUNDS)]), start, round_)


def _bound(value: Column, use) -> Column:
    """`use(value)` with the value computed once."""
    return F.transform(F.array(value), use)[0]


def _permuted_digits(digits: Column, kind: str, key: str) -> Column:
    """Digits of any length from 2 to 36 permuted among all texts of that length."""

    def of(d: Column) -> Column:
        front = F.floor(F.length(d) / 2).cast("int")
        back = F.length(d) - front
        a, b = F.pow(F.lit(10), front).cast("long"), F.pow(F.lit(10), back).cast("long")
        state = _feistel(F.substr(d, F.lit(1), front), F.substr(d, front + 1), a, b, kind, key)
        return _bound(state, lambda s: F.concat(F.lpad(s["x"].cast("string"), front, F.lit("0")), F.lpad(s["y"].cast("string"), back, F.lit("0"))))

    return _bound(digits, of)


def _luhn_sum(digits: Column) -> Column:
    """The Luhn sum of digits that stand left of a check digit."""
    worth = lambda d, k: F.when(k % 2 == 1, d).otherwise(F.when(d < 5, 2 * d).otherwise(2 * d - 9))
    each = F.transform(F.split(F.reverse(digits), ""), lambda d, k: worth(d.cast("int"), k))
    return F.aggregate(each, F.lit(0), lambda total, d: total + F.coalesce(d, F.lit(0)))


def _refilled(shape: Column, digits: Column) -> Column:
    """`shape` with its digits replaced in order."""
    start = F.struct(F.lit("").alias("out"), F.lit(1).alias("at"))

    def put(state: Column, c: Column) -> Column:
        digit = c.rlike("[0-9]")
        return F.struct(
            F.concat(state["out"], F.when(digit, F.substr(digits, state["at"], F.lit(1))).otherwise(c)).alias("out"),
            (state["at"] + F.when(digit, 1).otherwise(0)).alias("at"),
        )

    return F.aggregate(F.split(shape, ""), start, put)["out"]


def _digits(value: Column) -> Column:
    return F.regexp_replace(value, "[^0-9]", "")


def _is_card(d: Column) -> Column:
    """Whether digits alone are as many as those of a card, with a right Luhn digit."""
    n = F.length(d)
    return n.between(13, 19) & ((_luhn_sum(F.substr(d, F.lit(1), n - 1)) + F.substr(d, n).cast("int")) % 10 == 0)


def _permuted_card(h: Column, key: str) -> Column:
    def of(d: Column) -> Column:
        body = F.substr(d, F.lit(1), F.length(d) - 1)
        made = _bound(_permuted_digits(body, "card", key), lambda p: F.concat(p, ((10 - _luhn_sum(p) % 10) % 10).cast("string")))
        return _bound(made, lambda m: _refilled(h, m))

    return _bound(_digits(h), of)


def _groups(run: Column) -> Column:
    """The groups of a run, each with the separator behind it."""
    return F.regexp_extract_all(run, F.lit("[0-9]+[ -]?"), 0)


def _joined(groups: Column, at: Column, n: Column) -> Column:
    return F.array_join(F.slice(groups, at, n), "")


def _cuts(groups: Column) -> Column:
    """The cards among groups: array<struct<prev, at, n>>, n groups from the at-th on; prev is where the cut before ends.

    All groups if they are one card; else those in a usual grouping, from the left and the longest first, and
    between them any other whole groups with a right check digit. The work grows with the number of groups.
    """
    kind = "array<struct<prev:int,at:int,n:int>>"
    size = F.size(groups)

    def longest(at: Column, most: int, fits) -> Column:
        counts = F.sequence(F.lit(1), F.least(F.lit(most), size - at + 1))
        right = lambda n: _bound(_joined(groups, at, n), lambda x: fits(at, n, x) & _bound(_digits(x), _is_card))
        return F.coalesce(F.array_max(F.filter(counts, right)), F.lit(0))

    def chosen(usual: Column) -> Column:
        other = lambda at: longest(at, 19, lambda at, n, x: ~F.exists(F.slice(usual, at + 1, n - 1), lambda u: u > 0))
        found = F.transform(F.sequence(F.lit(1), size), lambda at: _bound(F.element_at(usual, at), lambda u: F.when(u > 0, u).otherwise(other(at))))
        start = F.struct(F.lit(1).alias("free"), F.array().cast(kind).alias("cuts"))

        def take(state: Column, pair: Column) -> Column:
            cut = F.struct(state["free"].alias("prev"), pair["at"].alias("at"), pair["n"].alias("n"))
            taken = F.struct((pair["at"] + pair["n"]).alias("free"), F.concat(state["cuts"], F.array(cut)).alias("cuts"))
            return F.when((pair["n"] > 0) & (pair["at"] >= state["free"]), taken).otherwise(state)

        pairs = F.transform(found, lambda n, k: F.struct((k + 1).alias("at"), n.alias("n")))
        return F.aggregate(pairs, start, take)["cuts"]

    usual = F.transform(F.sequence(F.lit(1), size), lambda at: longest(at, 5, lambda at, n, x: x.rlike(f"^(?:{CARD_GROUPS})[ -]?$")))
    whole = F.array(F.struct(F.lit(1).alias("prev"), F.lit(1).alias("at"), size.alias("n"))).cast(kind)
    return F.when((size <= 19) & _bound(_digits(_joined(groups, F.lit(1), size)), _is_card), whole).otherwise(_bound(usual, chosen))


def _cards(h: Column, key: str) -> Column:
    """A run of numbers with the cards in it permuted."""

    def shown(groups: Column, cuts: Column) -> Column:
        made = F.transform(cuts, lambda c: F.concat(_joined(groups, c["prev"], c["at"] - c["prev"]), _permuted_card(_joined(groups, c["at"], c["n"]), key)))
        last = F.element_at(cuts, -1)
        after = last["at"] + last["n"]
        return F.when(F.size(cuts) > 0, F.concat(F.array_join(made, ""), _joined(groups, after, F.size(groups) - after + 1))).otherwise(h)

    return _bound(_groups(h), lambda groups: _bound(_cuts(groups), lambda cuts: shown(groups, cuts)))


def _phone(h: Column, key: str) -> Column:
    return _bound(F.concat(F.lit("1"), _permuted_digits(F.substr(_digits(h), F.lit(2)), "phone", key)), lambda d: _refilled(h, d))


def _ssn(h: Column, key: str) -> Column:
    """Areas 001 to 899 but 666, groups 01 to 99 and serials 0001 to 9999: each set permuted within itself."""
    area, group, serial = (F.split(h, "-")[k].cast("long") for k in range(3))
    x = area - 1 - F.when(area > 666, 1).otherwise(0)
    y = (group - 1) * 9999 + serial - 1
    state = _feistel(x, y, F.lit(898).cast("long"), F.lit(99 * 9999).cast("long"), "ssn", key)

    def shown(s: Column) -> Column:
        area = s["x"] + 1 + F.when(s["x"] + 1 >= 666, 1).otherwise(0)
        part = lambda v, n: F.lpad(v.cast("string"), n, "0")
        return F.concat_ws("-", part(area, 3), part(F.floor(s["y"] / 9999) + 1, 2), part(s["y"] % 9999 + 1, 4))

    right = (area > 0) & (area < 900) & (area != 666) & (group > 0) & (serial > 0)
    return F.when(right, _bound(state, shown)).otherwise(h)


def _ip(h: Column, key: str) -> Column:
    o = [F.split(h, r"\.")[k].cast("long") for k in range(4)]
    half = F.lit(1 << 16).cast("long")
    state = _feistel(o[0] * 256 + o[1], o[2] * 256 + o[3], half, half, "ip", key)
    parts = lambda v: [F.floor(v / 256).cast("string"), (v % 256).cast("string")]
    return _bound(state, lambda s: F.concat_ws(".", *parts(s["x"]), *parts(s["y"])))


def _date(h: Column, key: str) -> Column:
    iso = h.rlike("^....-")
    year, month, day = (
        F.when(iso, F.substring(h, i, n)).otherwise(F.substring(h, j, n)) for i, j, n in ((1, 7, 4), (6, 4, 2), (9, 1, 2))
    )
    first = F.lit(FIRST_DAY).cast("date")
    value = F.try_to_date(F.concat_ws("-", year, month, day), "yyyy-MM-dd")
    number = F.datediff(value, first).cast("long")
    a, b = (F.lit(n).cast("long") for n in DAY_FACTORS)
    state = _feistel(F.floor(number / DAY_FACTORS[1]), number % DAY_FACTORS[1], a, b, "date", key)

    def shown(s: Column) -> Column:
        made = F.date_add(first, (s["x"] * DAY_FACTORS[1] + s["y"]).cast("int"))
        mark = F.substring(h, 3, 1)
        by_day = F.concat(F.date_format(made, "dd"), mark, F.date_format(made, "MM"), mark, F.date_format(made, "yyyy"))
        return F.when(iso, F.date_format(made, "yyyy-MM-dd")).otherwise(by_day)

    return F.when(value.isNotNull(), _bound(state, shown)).otherwise(h)


def _keyed_digest(value: Column, kind: str, key: str) -> Column:
    return F.sha2(F.concat_ws("|", F.lit(key), F.lit(kind), value), 256)


def _email(h: Column, key: str) -> Column:
    number = F.conv(F.substring(_keyed_digest(F.lower(h), "email", key), 1, 15), 16, 10).cast("long") % 10_000_000_000
    return F.concat(F.lit("user"), F.lpad(number.cast("string"), 10, "0"), F.lit("@"), F.substring_index(h, "@", -1))


def _secret(h: Column, key: str) -> Column:
    made = F.substr(_keyed_digest(F.lower(h), "secret", key), F.lit(1), F.length(h))
    return F.when(h == F.upper(h), F.upper(made)).otherwise(made)


_NUMBERS = "[0-9]++(?:[ -][0-9]++)*+"
_KINDS = [
    ("email", EMAIL, _email),
    ("phone", PHONE, _phone),
    ("ip", IP, _ip),
    ("ssn", SSN, _ssn),
    ("date", f"{ISO_DATE}|{DAY_DATE}", _date),
    ("secret", "[0-9A-Fa-f]{32,64}", _secret),
    ("card", _NUMBERS, _cards),
]


def pseudonym(value: Column, key: str = DEFAULT_KEY) -> Column:
    """The pseudonym of one found value; a value that fails its check stays."""
    out = value
    for _, pattern, made in reversed(_KINDS):
        out = F.when(value.rlike(f"^(?:{pattern})$"), made(value, key)).otherwise(out)
    return out


def _hits(text: Column) -> Column:
    return F.regexp_extract_all(text, F.lit(ANY), 0)


def pseudonymised(text: Column, key: str = DEFAULT_KEY) -> Column:
    """The text with every found value replaced; null stays null."""
    between = F.split(text, ANY, -1)
    made = F.transform(_hits(text), lambda h: pseudonym(h, key))
    joined = F.array_join(F.zip_with(between, made, lambda t, m: F.concat(t, F.coalesce(m, F.lit("")))), "")
    return F.when(text.rlike(HINT), joined).otherwise(text)


def pseudonymise(docs: DataFrame, key: str = DEFAULT_KEY, text_column: str = "text") -> DataFrame:
    """`docs` with `text_column` pseudonymised; all other columns, whatever their names, stay.

    Null and empty texts stay as they are; equal texts become equal texts; no row is added or dropped. No
    shuffle: the key alone links values of different documents.
    """
    return docs.withColumn(text_column, pseudonymised(F.col(text_column), key))


def replaced(before: Column, after: Column) -> Column:
    """How many values differ between a text and its pseudonymised form."""

    def differing(x: Column, y: Column) -> Column:
        of = lambda g, h: F.size(F.filter(_cuts(g), lambda c: _joined(g, c["at"], c["n"]) != _joined(h, c["at"], c["n"])))
        cards = _bound(_groups(x), lambda g: _bound(_groups(y), lambda h: of(g, h)))
        # a run of numbers may hold several cards
        return F.when(x == y, 0).when(x.rlike(f"^{_NUMBERS}$") & x.rlike("(?:[0-9][ -]?){26}"), F.greatest(cards, F.lit(1))).otherwise(1)

    pairs = F.zip_with(_hits(before), _hits(after), differing)
    return F.when(before == after, 0).otherwise(F.coalesce(F.aggregate(pairs, F.lit(0), lambda s, x: s + x), F.lit(0))).cast("long")
