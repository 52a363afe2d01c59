"""Token counts of prefixes against the tokenizer's own encoding of every prefix."""

import random

import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from tablesync.llm import token_counts
from tablesync.llm.queries import QUERIES

SF = "/root/testdata/sf0.001"
END = "<|endoftext|>"
ODD = [
    "it're don't we'll 'sup 'r 're!'re x'RE", "a \n\n b", " ", "  \n", "a \n\nb　 c  ", f"abc {END} b {END}{END}\n<|endoftext", END, "é́ ΣΑΣ 漢字かな😀😀 ё",
    "\x1c\x1d a\x85b", "a" * 40 + "-" * 20 + "===", f"x{END}y 's{END}'s", "''''re 'll'll 'v'e 've", "   'tis  'twas 'l' lé'é ", "", None,
]


@pytest.fixture(scope="module")
def encode():
    own = Tokenizer.from_file(token_counts.default_tokenizer())
    return lambda s: len(own.encode(s, add_special_tokens=False).ids)


def drawn(n, seed):
    rng = random.Random(seed)
    letters = [*"ab eE'lrsvtmd\n\t .,!?-–é漢😀  1290<|>", END, "'re", "'ll", " the", "ing", " ", " "]
    return ["".join(rng.choice(letters) for _ in range(rng.randrange(50))) for _ in range(n)]


@pytest.mark.parametrize("long", [token_counts.LONG, 5])
def test_every_prefix_has_the_count_of_its_own_encoding(encode, monkeypatch, long):
    monkeypatch.setattr(token_counts, "LONG", long)
    texts = [*ODD, *drawn(300, long)]
    got = token_counts.Vocabulary(token_counts.default_tokenizer()).texts([None if t is None else t.encode() for t in texts])
    for t, counts in zip(texts, got):
        assert counts.tolist() == [encode(t[:i]) for i in range(1, len(t or "") + 1)], t


def test_kept_units_and_pairs_are_forgotten_without_a_change(encode, monkeypatch):
    monkeypatch.setattr(token_counts, "KEEP", 3)
    own = token_counts.Vocabulary(token_counts.default_tokenizer())
    for t in drawn(40, 9):
        assert [c[-1] if len(c) else 0 for c in own.texts([t.encode(), b"same"])] == [encode(t), encode("same")]


def test_query_against_the_tokenizer(spark, encode):
    docs = {r["doc_id"]: r["text"] for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}
    got = QUERIES["op13_token_counts"](spark, SF).collect()
    assert len(got) == len(docs)
    for r in got:
        text = docs[r["doc_id"]]
        n = encode(text)
        assert (r["n_bytes"], r["n_tokens"], r["over_limit"]) == (len(text.encode()), n, n > 512)
        assert encode(text[: r["chars_within"]]) <= 512 and (n <= 512) == (r["chars_within"] == len(text))


def test_truncations_and_budgets_of_odd_rows(spark, encode):
    long = " ".join(f"w{i % 97} x{i % 89}é" for i in range(40000))
    rows = [(i, t, "clash", 1) for i, t in enumerate([*ODD, long, "same", "same"])] + [(None, "no id", "c", 2), (1, "id again", "c", 3)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, steps string, n_tokens int")
    table = token_counts.prefix_counts(docs, token_counts.default_tokenizer())
    asked = table.select("doc_id", "n_chars", "n_tokens", token_counts.tokens_at(7).alias("at"), token_counts.tokens_at(F.lit(None)).alias("none"), token_counts.longest_within(3).alias("fits"), token_counts.longest_within(F.col("n_tokens")).alias("all"))
    got = sorted((tuple(r) for r in asked.collect()), key=repr)
    want = []
    for i, t, *_ in rows:
        t = t or ""
        n = encode(t)
        if t == long:
            within = [k for k in range(0, 40) if encode(t[:k]) <= 3]
        else:
            within = [k for k in range(len(t) + 1) if encode(t[:k]) <= 3]
        most = len(t)
        want.append((i, len(t), n, encode(t[:7]), None, max(within), most))
    assert got == sorted(want, key=repr)
    assert token_counts.prefix_counts(docs.limit(0), token_counts.default_tokenizer()).count() == 0
    with pytest.raises(ValueError):
        import public_tokenizers

        token_counts.Vocabulary(public_tokenizers.path("word_bpe_49k.json"))
