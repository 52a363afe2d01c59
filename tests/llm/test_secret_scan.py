"""Spans and redaction of texts with very many matches, and of overlapping ones, against plain Python."""

import random
import re

import pytest

from tablesync.llm import secret_scan


def spans(text):
    out = []
    for n, rule in enumerate(secret_scan.RULES):
        out += [(m.start(), n, m.end(), rule.kind) for m in re.finditer(rule.regex, text) if len(m.group(rule.group)) >= rule.least]
    return sorted(out)


def redacted(text):
    out, at = "", 0
    for start, _, end, kind in spans(text):
        if start >= at:
            out += text[at:start] + f"[{kind}]"
        at = max(at, end)
    return out + text[at:]


@pytest.mark.parametrize("stride", [secret_scan.STRIDE, 3])
def test_many_and_overlapping_matches(spark, monkeypatch, stride):
    monkeypatch.setattr(secret_scan, "STRIDE", stride)
    rng = random.Random(stride)
    parts = ["password=", "AKIA" + "Q7" * 8, "ab" * 17, "token: short ", "é漢😀", " ", "\n", "secret=AKIA" + "Z9" * 7, "eyJ" + "x" * 9 + ".", "ghp_" + "a1" * 18, "x"]
    texts = ["".join(rng.choice(parts) for _ in range(rng.randrange(40))) for _ in range(60)] + ["", None]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = {r["doc_id"]: [tuple(x) for x in r["spans"]] for r in secret_scan.scan(docs).collect()}
    clean = {r["doc_id"]: r["text"] for r in secret_scan.redact(docs).collect()}
    for i, t in enumerate(texts):
        assert got[i] == spans(t or "") and clean[i] == (None if t is None else redacted(t)), t


def test_a_text_of_a_hundred_thousand_matches_ends(spark):
    text = "".join(f"é token: abcdefg{i} " for i in range(100_000))
    docs = spark.createDataFrame([(1, text)], "doc_id long, text string")
    assert len(secret_scan.scan(docs).first()["spans"]) == 100_000
    assert secret_scan.redact(docs).first()["text"] == "é [assign] " * 100_000
