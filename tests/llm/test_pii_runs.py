"""Cards with other numbers beside them."""

from __future__ import annotations

from test_pii import luhn, plain
from txloom.llm import pii

CARD, GROUPED, OTHER = "4111111111111111", "4111 1111 1111 1111", "5500-0000-0000-0004"
#: Texts with {} for the values that go; the numbers around them stay.
TEXTS = [
    ("{} 123", CARD), ("{} 12/25", GROUPED), ("{}, 12/25", GROUPED), ("order 77 {}", GROUPED), ("1234 5678 {}", GROUPED), ("1234 5678 {} 9 10", GROUPED),
    ("{} {}", GROUPED, OTHER), ("{} 7 {} 8", CARD, OTHER), ("{} {} 1", CARD, CARD), ("12345 {} {}", CARD, "2024-01-02"), ("{} {}", GROUPED, "12/05/2024"),
    ("{} 55 {}", GROUPED, "12.05.2024"), ("123456789 {}", "2024-01-02"), ("12345 {} 6", "123-45-6789"), ("7 {} 8", "3782 822463 10005"), ("5 {} 000 1", "60110009 90139424"),
]


def test_numbers_beside_a_card(spark, docs_of):
    docs = docs_of(*[(k, f"pay {t.format(*values)} now") for k, (t, *values) in enumerate(TEXTS)])
    assert all(luhn(v.replace(" ", "").replace("-", "")) for v in (CARD, GROUPED, OTHER))
    out = pii.pseudonymise(docs.withColumn("before", docs["text"]))
    for r in out.withColumn("n", pii.replaced(out["before"], out["text"])).collect():
        t, *values = TEXTS[r["doc_id"]]
        assert r["text"] == f"pay {t.format(*map(plain, values))} now", r["before"]
        assert r["n"] == len(values), r["before"]


def test_runs_without_a_card_stay(spark, docs_of):
    clean = ["4111 1111 1111 1112", "4111111111111112 123", "1" * 40 + " 2", "1" * 20 + " " + "1" * 21]
    got = {r["doc_id"]: r["text"] for r in pii.pseudonymise(docs_of(*enumerate(clean))).collect()}
    assert got == dict(enumerate(clean))


def test_long_runs(spark, docs_of):
    numbers = " ".join(["99999999999999999990"[k % 3 : 20 - k % 5] for k in range(4000)])
    text = f"{numbers}x {numbers.replace('9', '7')} y {GROUPED} z"
    got = pii.pseudonymise(docs_of((1, text))).first()["text"]
    assert len(got) == len(text) and got.endswith(f" y {plain(GROUPED)} z")
