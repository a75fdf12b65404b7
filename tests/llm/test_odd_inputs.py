"""Names with dots, clashing names, ties, extreme numbers and very long runs."""

import numpy as np
import pytest

import corpus_pipeline
from slatecast.llm import lattice, mixing, separators
from slatecast.llm.queries import TOKENIZERS

RANKS = f"{TOKENIZERS}/byte_bpe_50k.tiktoken"
NAMES = ["a.b", "id", "tag", "_gone_id", "_gone_tag", "key", "digest", "size", "order", "doc", "host", "salt", "mark", "q`t"]


@pytest.mark.parametrize("name", [n for n, _ in corpus_pipeline.STAGES[:-1]])
def test_stages_keep_columns_of_any_name(spark, name):
    texts = ["the house and the garden of the king\nthis is what they said to him that day", "der hund und die katze\nsind im haus",
             "the house and the garden of the king\nthis is what they said to him that day", None, ""]
    extra = ", ".join(f"`{n.replace('`', '``')}` int" for n in NAMES)
    rows = [(i, t, ("en", "de", "en", None, "en")[i], "s", len(t or ""), *range(len(NAMES))) for i, t in enumerate(texts)]
    docs = spark.createDataFrame(rows, f"doc_id long, text string, lang string, source string, n_chars long, {extra}")
    out = dict(corpus_pipeline.STAGES)[name](spark, docs, None)
    assert out.columns == docs.columns
    for row in out.collect():
        assert tuple(row)[5:] == tuple(range(len(NAMES)))


def test_mix_of_tied_rows_does_not_depend_on_their_order(spark):
    rows = [(7, "a b c d", "en", "s", 7), (7, "e f g h", "en", "s", 7), (None, "i j k", "en", "t", 5), (None, "l m n", "en", "t", 5)]
    schema = "doc_id long, text string, lang string, source string, n_chars long"

    def read(order):
        return [tuple(r) for r in mixing.mixed(spark.createDataFrame(order, schema).coalesce(1)).collect()]

    assert sorted(read(rows), key=str) == sorted(read(rows[::-1]), key=str)


@pytest.mark.parametrize("power", [0, 300, 150, -150, -300])
def test_links_do_not_depend_on_scale(spark, power):
    rng = np.random.default_rng(5)
    x = np.repeat(rng.normal(size=(6, 16)), 4, 0) + rng.normal(size=(24, 16)) * 0.02
    want = lattice.embedding_groups(spark.createDataFrame(list(enumerate(x.tolist())), "vec_id long, embedding array<double>"))
    frame = spark.createDataFrame(list(enumerate((x * 10.0 ** power).tolist())), "vec_id long, embedding array<double>")
    got = sorted(map(tuple, lattice.embedding_groups(frame).collect()))
    assert got == sorted(map(tuple, want.collect())) and {r[1] for r in got} == {3}


def test_cells_do_not_depend_on_the_batch():
    machine = lattice.Lattice(7, 4, 0.6, 3)
    x = np.random.default_rng(6).normal(size=(300, 40))
    whole = machine.cells(x)
    assert all((machine.cells(x[a:a + 7]) == whole[a:a + 7]).all() for a in range(0, 300, 7))


def test_long_runs_of_blanks_are_counted(spark):
    coder = separators.tokenizer(RANKS)
    for blank in (" ", "\n", " "):
        for text in (f"a b{blank * 6000}c d", blank * 7000, f"{blank * 5500}x", f"x{blank * 5001}", f"{blank * 5000} \n{blank * 5000}\ty"):
            assert separators.encode(coder, text) == coder.encode_ordinary(text)
    texts = [" " * 1_500_000 + "a", "a" + "\n" * 1_200_000, "b" * 300_000, "", None]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = {r.doc_id: r.n_tokens for r in separators.document_token_counts(spark, docs, RANKS, 50256).collect()}
    assert got[3] == got[4] == 0 and got[0] > 1 and got[1] > 1 and got[2] == len(coder.encode_ordinary(texts[2]))
    none = separators.document_token_counts(spark, docs.limit(0), RANKS, 50256)
    assert none.collect() == []
