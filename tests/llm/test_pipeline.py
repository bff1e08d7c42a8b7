import corpus_pipeline
import duckdb
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from hitledger.llm import common, mixing, queries

from . import brute
from .conftest import AWKWARD

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def stages(spark):
    """Rows before the first stage and after each one, by stage name."""
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    out, names = [docs.toPandas()], []
    for name, stage in corpus_pipeline.STAGES:
        docs = stage(spark, docs, SF)
        if name != corpus_pipeline.STAGES[-1][0]:
            assert docs.columns == spark.read.parquet(f"{SF}/documents.parquet").columns
        docs = spark.createDataFrame(docs.collect(), docs.schema)
        names.append(name)
        out.append(docs.toPandas())
    return dict(zip(["documents", *names], out))


def test_stages_in_order():
    assert [n for n, _ in corpus_pipeline.STAGES] == ["language_id", "exact_copies", "near_copies", "source_mix", "token_ids"]


def test_language_keeps_what_has_letters(stages):
    docs, kept = stages["documents"], set(stages["language_id"].doc_id)
    assert {d for d, t in zip(docs.doc_id, docs.text) if not any(c.isalpha() for c in t or "")}.isdisjoint(kept)
    assert len(kept) > 0.95 * len(docs)


def test_exact_copies(stages):
    before = stages["language_id"].fillna({"text": ""})
    assert sorted(stages["exact_copies"].doc_id) == sorted(before.groupby("text").doc_id.max())


def test_near_copies(stages):
    rows = list(zip(stages["exact_copies"].doc_id.tolist(), stages["exact_copies"].text))
    assert sorted(stages["near_copies"].doc_id) == sorted({c for _, _, c in brute.components(rows)})


def test_mix(stages):
    con = duckdb.connect()
    con.register("documents", stages["near_copies"])
    want = con.execute(mixing.mix_sql(queries.MIX) + " select doc_id from chosen order by 1").fetchall()
    assert sorted(stages["source_mix"].doc_id) == [w[0] for w in want]


def test_token_ids(stages):
    library = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    texts = dict(zip(stages["source_mix"].doc_id, stages["source_mix"].text))
    found = stages["token_ids"]
    assert sorted(found.doc_id) == sorted(stages["source_mix"].doc_id)
    for doc, n, ids in zip(found.doc_id, found.n_tokens, found.ids):
        want = library.encode(texts[doc], add_special_tokens=False).ids
        assert n == len(want) and [a | b << 8 for a, b in zip(ids[::2], ids[1::2])] == want


def test_run_gives_the_same(spark, stages):
    found = corpus_pipeline.run(spark, SF).toPandas()
    assert sorted(found.doc_id) == sorted(stages["token_ids"].doc_id)


@pytest.mark.parametrize("empty", [False, True])
def test_stages_take_awkward_rows(spark, table, empty):
    """Nulls, repeated rows, long texts and columns with names that the stages use inside; and no rows at all."""
    docs = table(*AWKWARD).where("false") if empty else table(*AWKWARD)
    names = docs.columns
    for name, stage in corpus_pipeline.STAGES:
        docs = common.stored(stage(spark, docs, SF), name)
        assert name == "token_ids" or docs.columns == names
        if empty:
            assert docs.isEmpty()
    if not empty:
        assert docs.count() > 0
