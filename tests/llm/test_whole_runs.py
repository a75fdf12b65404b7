"""The pipeline's whole run and the toxicity query against plain Python."""

import itertools
import math
import random
import re
import zlib
from collections import Counter

import duckdb
import numpy as np
import pytest
import sentencepiece
from conftest import SF
from pyspark.sql import functions as F

import corpus_pipeline
from slatecast.llm import toxicity
from slatecast.llm.queries import MIXING_SQL, QUERIES, TOKENIZERS

WORDS = {"en": "the of and to in that with which from this have been were their would about there other people water",
         "fr": "le la de et les des une dans pour avec sur plus par mais nous vous leur comme cette tout"}


def corpus():
    """Texts of plain languages whose lines repeat only where a passage or a copy was planted."""
    rng = random.Random(12)
    rows = []

    def text(lang, lines=4):
        return [f"{' '.join(rng.choices(WORDS[lang].split(), k=14))} m{rng.randrange(10 ** 9)}" for _ in range(lines)]

    passage = [" ".join(f"shared{i}w{w} the of" for w in range(12)) for i in range(3)]
    for i in range(40):
        lang = ("en", "en", "fr")[i % 3]
        lines = text(lang, 3 + i % 4)
        if i in (5, 11, 17, 29):
            at = rng.randrange(len(lines) + 1)
            lines[at:at] = passage
        rows.append((i, "\n".join(lines), lang, ("a", "b", None)[i % 5 % 3]))
    # near copies: one word of one long line differs, so no whole line of over 50 words repeats
    for i, base in enumerate((2, 2, 7, 20)):
        words = (" ".join(text("en", 9))).split()
        if i != 1:
            near = words
        changed = list(near)
        changed[40 + i] = f"other{i}"
        if i == 0:
            rows.append((60, " ".join(near), "en", "a"))
        rows.append((61 + i, " ".join(changed if i < 2 else words), "en", "b"))
    rows += [(70, "", "en", "a"), (71, None, "fr", "b"), (72, "123 456", "en", "a"), (73, rows[3][1], "en", "b")]
    return rows


def repeats_removed(rows):
    """Whole-line runs of over 50 words that stand earlier go; exact copies of lines too, as chunks of two lines do."""
    out = []
    for k, (i, t, lang, source) in enumerate(rows):
        own = t.split("\n")
        gone = set()
        for _, other, *_ in rows[:k]:
            theirs = other.split("\n")
            for a, b in itertools.product(range(len(own)), range(len(theirs))):
                n = 0
                while a + n < len(own) and b + n < len(theirs) and own[a + n] == theirs[b + n]:
                    n += 1
                if sum(len(x.split()) for x in own[a:a + n]) > 50:
                    gone |= set(range(a, a + n))
        out.append((i, "\n".join(x for z, x in enumerate(own) if z not in gone), lang, source))
    return out


def probability_jaccard(a, b):
    def shingles(t):
        w = re.findall(r"\w+", t.lower())
        return Counter(tuple(w[k:k + 5]) for k in range(max(1, len(w) - 4))) if w else Counter()

    x, y = shingles(a), shingles(b)
    return sum(1 / sum(max(x[e] / x[d], y[e] / y[d]) for e in x.keys() | y.keys()) for d in x.keys() & y.keys())


def one_of_each_group(rows):
    kept = []
    root = {r[0]: r[0] for r in rows}
    for a, b in itertools.combinations(rows, 2):
        if a[1] and b[1] and probability_jaccard(a[1], b[1]) >= 0.8:
            low, high = sorted((root[a[0]], root[b[0]]))
            root = {k: low if v == high else v for k, v in root.items()}
    for r in rows:
        if root[r[0]] == r[0]:
            kept.append(r)
    return kept


def test_run_of_the_pipeline_against_plain_python(spark, tmp_path):
    rows = corpus()
    schema = "doc_id long, text string, lang string, source string, n_chars long"
    spark.createDataFrame([(i, t, lang, s, len(t or "")) for i, t, lang, s in rows], schema).write.parquet(
        str(tmp_path / "documents.parquet"))
    got = corpus_pipeline.run(spark, str(tmp_path)).collect()

    # language: texts without words go, the others keep their plain language
    rows = sorted((r for r in rows if re.search("[a-z]", r[1] or "")), key=lambda r: r[0])
    rows = one_of_each_group(repeats_removed(rows))
    assert {61, 62} - {r[0] for r in rows} == {61, 62} and len(rows) == 44     # near copies went
    con = duckdb.connect()
    con.execute("create table documents (doc_id bigint, text varchar, source varchar)")
    con.executemany("insert into documents values (?, ?, ?)", [(i, t, s) for i, t, _, s in rows])
    plan = con.execute(f"select doc_id, size, taken, position, again from ({MIXING_SQL})").fetchall()
    texts = {i: t for i, t, *_ in rows}
    order = sorted((at, i) for i, size, taken, *times in plan for turn, at in enumerate(times)
                   if at is not None and 2 * (taken - turn * size) >= size)
    model = sentencepiece.SentencePieceProcessor(model_file=f"{TOKENIZERS}/piece_bpe_32k.model")
    want = [(i, model.encode(texts[i])) for _, i in order]
    assert [(r.doc_id, r.ids) for r in got] == want
    assert all(r.lossless and r.n_tokens == len(r.ids) for r in got)


def test_toxicity_against_scalar_ftrl(spark):
    """The same steps one coordinate at a time, on 200 documents."""
    rng = random.Random(13)
    rows, marks = [], []
    for i in range(200):
        bad = i % 4 == 0
        words = [f"w{rng.randrange(80)}" for _ in range(rng.randrange(30))] + ["vile", "nasty"][:rng.randint(1, 2)] * bad
        rng.shuffle(words)
        rows.append((i, " ".join(words)))
        marks.append((i, int(bad)))
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    labels = spark.createDataFrame(marks[:150], "doc_id long, toxic int")
    weights = toxicity.fit(docs, labels, bits=12, epochs=3)

    ids = sorted(range(150), key=lambda i: int(__import__("hashlib").md5(str(i).encode()).hexdigest()[:15], 16))
    hashes, z, n = toxicity.WordHashes(), Counter(), Counter()

    def weight(k):
        if abs(z[k]) <= 4.0:
            return 0.0
        return -(z[k] - math.copysign(4.0, z[k])) / ((1.0 + math.sqrt(n[k])) / 2.0 + 0.5)

    def coordinates(text):
        return [0, *sorted(set(toxicity.features(text.encode(), hashes, 12).tolist()))]

    for _ in range(3):
        for i in ids:
            at = coordinates(rows[i][1])
            w = {k: weight(k) for k in at}
            g = 1 / (1 + math.exp(-sum(w.values()))) - marks[i][1]
            for k in at:
                z[k] += g - (math.sqrt(n[k] + g * g) - math.sqrt(n[k])) / 2.0 * w[k]
                n[k] += g * g
    want = {k: weight(k) for k in z if weight(k)}
    assert set(weights) == set(want) and len(want) > 3
    assert all(weights[k] == pytest.approx(want[k], rel=1e-9) for k in want)
    for r in toxicity.score(docs, weights, bits=12).collect():
        total = sum(want.get(k, 0.0) for k in coordinates(rows[r.doc_id][1]))
        assert r.score == pytest.approx(1 / (1 + math.exp(-total)))
    assert toxicity.fit(docs.limit(0), labels, bits=12) == {} and toxicity.score(docs.limit(0), weights, bits=12).count() == 0
    # a labelled id with many rows is one training row
    many = docs.unionByName(docs.filter("doc_id = 8").withColumn("copy", F.explode(F.sequence(F.lit(1), F.lit(50)))).drop("copy"))
    assert toxicity.fit(many, labels, bits=12, epochs=3) == weights


def test_toxicity_query_learns_from_the_other_rows_only(spark):
    got = {r.doc_id: r for r in QUERIES["op2_toxicity"](spark, SF).collect()}
    docs = {r.doc_id: r.text for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}
    assert set(got) == set(docs)
    held = {i for i in docs if zlib.crc32(str(i).encode()) % 3 == 1}
    assert all(r.held_out == (i in held) and r.predicted == int(r.score >= 0.7) and 0 <= r.score <= 1 for i, r in got.items())
    labels = spark.read.parquet(f"{SF}/labels.parquet")
    learn = labels.filter(~labels.doc_id.isin(list(held)))
    frame = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text")
    weights = toxicity.fit(frame, learn)
    again = {r.doc_id: r.score for r in toxicity.score(frame, weights).collect()}
    assert all(np.isclose(again[i], r.score) for i, r in got.items())
