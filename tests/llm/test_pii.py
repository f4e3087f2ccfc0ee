from __future__ import annotations

import hashlib
import re
from datetime import date, timedelta

import pytest
from pyspark.sql import functions as F
from txloom.llm import pii
from txloom.llm.queries import op5_pseudonyms

SF = "/root/testdata/sf0.01"


def feistel(x, y, a, b, kind, key=pii.DEFAULT_KEY):
    for k in range(pii.ROUNDS):
        half = y if k % 2 == 0 else x
        added = int(hashlib.sha256("|".join(map(str, (key, kind, a, b, k, half))).encode()).hexdigest()[:15], 16)
        x, y = ((x + added) % a, y) if k % 2 == 0 else (x, (y + added) % b)
    return x, y


def digits(d, kind):
    n = len(d) // 2
    x, y = feistel(int(d[:n]), int(d[n:]), 10**n, 10 ** (len(d) - n), kind)
    return f"{x:0{n}d}{y:0{len(d) - n}d}"


def luhn(d):
    worth = [int(c) if k % 2 == 0 else int(c) * 2 - 9 * (c > "4") for k, c in enumerate(reversed(d))]
    return sum(worth) % 10 == 0


def refill(shape, d):
    it = iter(d)
    return re.sub("[0-9]", lambda _: next(it), shape)


def plain(value):
    """The pseudonym of one value, by itself."""
    d = re.sub("[^0-9]", "", value)
    if re.fullmatch(pii.EMAIL.replace(r"\p{L}\p{N}", r"\w"), value):
        h = hashlib.sha256(f"{pii.DEFAULT_KEY}|email|{value.lower()}".encode()).hexdigest()
        return f"user{int(h[:15], 16) % 10**10:010d}@{value.split('@')[-1]}"
    if re.fullmatch(pii.PHONE, value):
        return refill(value, "1" + digits(d[1:], "phone"))
    if re.fullmatch(pii.IP, value):
        o = [int(x) for x in value.split(".")]
        x, y = feistel(o[0] * 256 + o[1], o[2] * 256 + o[3], 1 << 16, 1 << 16, "ip")
        return f"{x >> 8}.{x & 255}.{y >> 8}.{y & 255}"
    if re.fullmatch(pii.SSN, value):
        area, group, serial = map(int, value.split("-"))
        if area in (0, 666) or area > 899 or not group or not serial:
            return value
        x, y = feistel(area - 1 - (area > 666), (group - 1) * 9999 + serial - 1, 898, 99 * 9999, "ssn")
        area = x + 1 + (x + 1 >= 666)
        return f"{area:03d}-{y // 9999 + 1:02d}-{y % 9999 + 1:04d}"
    if re.fullmatch(f"{pii.ISO_DATE}|{pii.DAY_DATE}", value):
        parts = [int(x) for x in re.split("[-./]", value)]
        try:
            day = date(*(parts if parts[0] > 31 else parts[::-1]))
        except ValueError:
            return value
        first = date(1800, 1, 1)
        x, y = feistel(*divmod((day - first).days, 773), 189, 773, "date")
        made = first + timedelta(days=x * 773 + y)
        return made.isoformat() if parts[0] > 31 else made.strftime(f"%d{value[2]}%m{value[2]}%Y")
    if re.fullmatch(pii.CARD, value):
        if not luhn(d):
            return value
        body = digits(d[:-1], "card")
        return refill(value, next(body + str(k) for k in range(10) if luhn(body + str(k))))
    h = hashlib.sha256(f"{pii.DEFAULT_KEY}|secret|{value.lower()}".encode()).hexdigest()[: len(value)]
    return h.upper() if value == value.upper() else h


VALUES = [
    "the.72@mail3.example.com", "Réné_9@a.example.org", "+1 (377) 555-0271", "+1 377.555.0271", "+13775550271", "126.40.69.100", "0.0.0.0", "255.255.255.255",
    "123-45-6789", "899-99-9999", "001-01-0001", "665-12-3456", "667-12-3456", "000-12-3456", "666-12-3456", "123-00-4567",
    "1999-02-28", "2000-02-29", "1999-02-30", "31.12.2199", "01/01/1800", "31/02/2001",
    "4952935900253052", "4952 9359 0025 3052", "4952-9359-0025-3052", "5927243074273351", "6011000990139424000", "0000000000000",
]


@pytest.mark.parametrize("around", ["{}", "a {} b", "({}),", "end: {}.\nNext", "«{}»!!"])
def test_each_kind(spark, docs_of, around):
    got = pii.pseudonymise(docs_of(*[(k, around.format(v)) for k, v in enumerate(VALUES)])).collect()
    for r in got:
        assert r["text"] == around.format(plain(VALUES[r["doc_id"]])), VALUES[r["doc_id"]]


def test_secrets(spark, docs_of):
    h = "9233A8ECF7C5B09FE5949719B6B82BC439E9329B"
    got = {r["doc_id"]: r["text"] for r in pii.pseudonymise(docs_of((1, f'TOKEN = "{h}"'), (2, f"token={h.lower()}"), (3, f"commit {h}"))).collect()}
    assert got == {1: f'TOKEN = "{plain(h)}"', 2: f"token={plain(h.lower())}", 3: f"commit {h}"}


def test_clean_text_stays(spark, docs_of):
    clean = ["", "$ 3.14 and 2.0. Version 4.0.1", "5.5.5.5.5", "pages 1234-5678", "call 555-0271", "a@b", "1" * 40, "12.5.2020", "256.1.1.1", "x12.34.56.78", "300 1000 2000", None]
    got = {r["doc_id"]: r["text"] for r in pii.pseudonymise(docs_of(*enumerate(clean))).collect()}
    assert got == dict(enumerate(clean))


def test_permutations_do_not_collide(spark):
    days = spark.range(146_097).select(F.date_format(F.expr("date_add(date'1800-01-01', cast(id as int))"), "yyyy-MM-dd").alias("text"))
    made = days.select(pii.pseudonym(F.col("text")).alias("p"))
    assert made.distinct().count() == 146_097
    assert made.agg(F.min("p"), F.max("p")).first() == ("1800-01-01", "2199-12-31")


def test_equal_values_stay_linked_and_keys_differ(spark, docs_of):
    docs = docs_of((1, "from 126.40.69.100 on"), (2, "126.40.69.100, 126.40.69.100"))
    got = [set(re.findall(pii.IP, r["text"])) for r in pii.pseudonymise(docs).collect()]
    assert got[0] == got[1] and len(got[0]) == 1
    other = [set(re.findall(pii.IP, r["text"])) for r in pii.pseudonymise(docs, key="other").collect()]
    assert other[0] != got[0]


def test_rows_and_columns_stay(spark, docs_of):
    docs = docs_of((None, "a@b.example.com"), (1, "x"), (1, "x"), (2, "1.2.3.4 " * 20_000))
    out = pii.pseudonymise(docs)
    assert out.columns == docs.columns and out.count() == 4
    assert pii.pseudonymise(docs.limit(0)).count() == 0


def test_plan_is_native(spark):
    plan = op5_pseudonyms(spark, SF)._jdf.queryExecution().executedPlan().toString()
    assert not re.search("Python|Arrow|Pandas|Exchange", plan)


def test_query(spark):
    texts = {r["doc_id"]: r["text"] for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}
    got = op5_pseudonyms(spark, SF).collect()
    assert len(got) == len(texts)
    assert sum(r["n_replaced"] for r in got) > 0
    any_ = re.compile("|".join(f"(?:{p})" for p in (pii.EMAIL.replace(r"\p{L}\p{N}", r"\w"), pii.PHONE, pii.IP)))
    for r in got:
        found = any_.findall(texts[r["doc_id"]])
        assert not [v for v in found if v in r["text"] and plain(v) != v]
