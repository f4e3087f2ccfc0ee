from __future__ import annotations

import re
from collections import Counter

from txloom.llm import repetition
from txloom.llm.queries import op8_repetition_rules

SF = "/root/testdata/sf0.001"
WORD = re.compile(r"[^\x20\x09-\x0D]+")


def plain(text):
    """The same figures by counting tuples of words."""
    text = text or ""
    words = WORD.findall(text)
    n = len(words)
    lines = [x for x in text.split("\n") if WORD.search(x)]
    windows = lambda w: [tuple(words[k : k + w]) for k in range(n - w + 1)]
    count = Counter(windows(3))
    repeat = {j for k, x in enumerate(windows(3)) if count[x] > 1 for j in range(k, k + 3)}
    out = {
        "n_words": n,
        "word_chars": sum(map(len, words)),
        "n_symbols": len(re.findall(r"[#*$%&|<>]", text)),
        "n_dup_lines": sum(x in lines[:k] for k, x in enumerate(lines)),
        "dup_line_chars": sum(sum(map(len, WORD.findall(x))) for k, x in enumerate(lines) if x in lines[:k]),
        "n_repeat_words": len(repeat),
    }
    for w in repetition.NGRAM_LIMITS:
        seen, covered = set(), set()
        for k, x in enumerate(windows(w)):
            if x in seen:
                covered.update(range(k, k + w))
            seen.add(x)
        out[f"dup_chars_{w}"] = sum(len(words[j]) for j in covered)
    out["base_failed"] = n < 50 or 100 * len(repeat) > 50 * n
    out["kept"] = (
        not out["base_failed"]
        and out["dup_line_chars"] <= 0.2 * out["word_chars"]
        and all(out[f"dup_chars_{w}"] <= limit * out["word_chars"] for w, limit in repetition.NGRAM_LIMITS.items())
    )
    return out


def check(row, text):
    expected = plain(text)
    assert {k: row[k] for k in expected} == expected


def test_odd_texts(spark, docs_of):
    some = " ".join(f"w{k}" for k in range(60))
    texts = [None, "", " \n\t\n", "a", "# $ <> |", some, some + "\n" + some, "é b \x1c c\x0bd " * 40, (some + "\n") * 3000, "x " * 200_000, "l\r\nl\r\nl \nl"]
    got = repetition.repetition(docs_of(*enumerate(texts))).collect()
    assert len(got) == len(texts)
    for r in got:
        check(r, texts[r["doc_id"]])


def test_null_and_repeated_ids_and_no_rows(spark, docs_of):
    docs = docs_of((None, "a"), (1, "a"), (1, "a"))
    assert sorted(r["doc_id"] or 0 for r in repetition.repetition(docs).collect()) == [0, 1, 1]
    assert repetition.repetition(docs.limit(0)).count() == 0


def test_query(spark):
    got = {r["doc_id"]: r for r in op8_repetition_rules(spark, SF).collect()}
    rows = spark.read.parquet(f"{SF}/documents.parquet").collect()
    assert len(got) == len(rows)
    for row in rows:
        check(got[row["doc_id"]], row["text"])
