import hashlib
import random

import numpy as np
import pandas as pd
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from hitledger.llm import bpe, common, language

from .conftest import AWKWARD

PATH = public_tokenizers.path("word_bpe_49k.json")
TEXTS = [
    "Hello, World! it's we'll I'd they're 2024 x²", "a<|startoftext|>b <|endoftext|> <|endoftext", "İstanbul ΣΑΣ ΟΔΥΣΣΕΥΣ ﬁ Å é é",
    " \x85\x1c \u200b\u3000tabs\tand\nlines\r\n", "日本語 العربية हिन्दी 😀👩‍👧 ①²Ⅷ", "supercalifragilistic" * 40, "'s's'S ''' \"'ll", "1234567890", "don’t",
]


@pytest.fixture(scope="module")
def own():
    return bpe.Vocabulary(PATH)


@pytest.fixture(scope="module")
def library():
    return Tokenizer.from_file(PATH)


def test_equals_the_library(own, library):
    rng = random.Random(5)
    mixed = ["".join(rng.choice("ab eE'stIlL.,1é\n<|>") for _ in range(rng.randrange(80))) for _ in range(300)]
    for text in [*TEXTS, *mixed, *(r[1] for r in AWKWARD if r[1])]:
        ids = library.encode(text, add_special_tokens=False).ids
        assert own.encode_ids(text) == ids, text[:60]
        assert " ".join(x[2] for x in own.encode_texts([text])[0]) == library.decode(ids, skip_special_tokens=False) == own.decode(ids)


def test_tree_gives_the_leftmost_lowest():
    rng = random.Random(3)
    for size in (1, 2, 3, 7, 8, 100):
        values = [rng.randrange(50) * size + i for i in range(size)]
        tree = bpe.PairTree(list(values))
        for _ in range(200):
            assert tree.root() == min(values)
            i = rng.randrange(size)
            values[i] = rng.randrange(50) * size + i
            tree.put((i, values[i]))


def test_words_merged_together_are_those_merged_alone(own):
    rng = random.Random(8)
    words = ["".join(rng.choice("abcdestnrio éß1#") for _ in range(rng.randrange(1, 70))).replace(" ", "") or "x" for _ in range(3000)]
    words += ["a" * n for n in range(1, 70)] + ["the", "é", "日本", "😀" * 16, "😀" * 17, "supercalifragilistic"]
    assert own.merge_words(words) == [own.merge(own.symbols(w)) for w in words]


def test_cache_of_words_is_bounded(own, monkeypatch):
    monkeypatch.setattr(bpe, "CACHE_WORDS", 3)
    fresh = bpe.Vocabulary(PATH)
    assert fresh.encode_ids("a b c d e f g a b") == own.encode_ids("a b c d e f g a b")
    assert len(fresh.cache) <= 3


def test_frequent_words_stay_when_the_cache_is_full(own):
    fresh = bpe.Vocabulary(PATH, room=4, decimals=False)
    fresh.encode_texts(["the"]), fresh.encode_texts(["of"]), fresh.encode_texts(["rare words come once"])
    assert list(fresh.cache) == ["the", "of"]
    assert [x[3] for x in fresh.encode_texts(["the rare of"])[0]] == [x[3] for x in own.encode_texts(["the rare of"])[0]]


@pytest.mark.parametrize("stage", ["token_ids", "language_id"])
def test_batches_of_long_texts_are_bounded(spark, stage):
    """Ten thousand rows of whole texts in one batch were held by the executor and by Python, whatever their size."""
    spark.conf.unset(common.BATCH_SETTING)
    docs = spark.range(3000).selectExpr("id as doc_id", "repeat('word ', 1000) as text").coalesce(1)
    if stage == "token_ids":
        bpe.encode_binary(docs, PATH)
    else:
        language.keep_languages(docs, language.LanguageModel.of_counts([], np.zeros((0, language.BUCKETS))))
    try:
        size = common.per_text(docs, lambda: lambda texts: pd.DataFrame({"n": [sum(map(len, texts))] * len(texts)}), "n long", 1 << 30)
        found = size.agg({"n": "max", "doc_id": "count"}).first()
        assert found["max(n)"] <= common.BATCH_BYTES + 5000 and found["count(doc_id)"] == 3000
        spark.conf.set(common.BATCH_SETTING, "1000")
        common.bounded_batches(spark)
        assert spark.conf.get(common.BATCH_SETTING) == "1000"
    finally:
        spark.conf.unset(common.BATCH_SETTING)


def test_every_row(table, library):
    docs = table(*AWKWARD)
    digests = bpe.digest_documents(docs, PATH).collect()
    ids = bpe.encode_documents(docs, PATH).collect()
    packed = bpe.encode_binary(docs, PATH).collect()
    want = sorted(
        (repr(r[0]), len(e := library.encode(r[1] or "", add_special_tokens=False).ids), hashlib.sha256(" ".join(map(str, e)).encode()).hexdigest())
        for r in AWKWARD
    )
    assert sorted((repr(r.doc_id), r.n_tokens, r.ids_sha256) for r in digests) == want
    assert sorted((repr(r.doc_id), r.n_tokens, hashlib.sha256(r.ids.encode()).hexdigest()) for r in ids) == want
    assert sorted((repr(r.doc_id), len(r.ids) // 2) for r in packed) == [w[:2] for w in want]


def test_empty_table(table):
    assert bpe.digest_documents(table((1, "a")).limit(0), PATH).collect() == []
