"""Line dedup, licenses, token counts, pieces, languages, toxicity: against brute force, and on odd rows."""

import math
import os
import random
import re
from collections import Counter

import numpy as np
import pytest

from slatecast.llm import langid, licenses, line_chunks, separators, toxicity, wfst
from slatecast.llm.queries import END_OF_DOCUMENT, TOKENIZERS

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, score double, key long, size string"
PIECES, RANKS = f"{TOKENIZERS}/piece_bpe_32k.model", f"{TOKENIZERS}/byte_bpe_50k.tiktoken"


def frame(spark, rows):
    """Rows (doc_id, text) with columns whose names clash with working names."""
    return spark.createDataFrame([(i, t, "en", "s", 1, 0.5, 7, "x") for i, t in rows], SCHEMA)


LONG = "\n".join(f"line {i} of a very long text with words" for i in range(20_000))
ODD = [(1, None), (2, ""), (3, " \n\n\t "), (4, LONG), (None, "no id here"), (5, "same"), (5, "same"), (6, "é日本😀\x00")]


# line dedup ---------------------------------------------------------------

def without_repeats(rows):
    first, out = {}, []
    order = sorted({r for r in rows if r[1]}, key=lambda r: (r[0] is None, r[0]))
    for i, t in order:
        lines = t.split("\n")
        for a, b, may in line_chunks.chunks(t):
            if may:
                first.setdefault("\n".join(lines[a:b]), (i, a))
    for i, t in rows:
        if not t:
            out.append((i, t))
            continue
        lines = t.split("\n")
        kept = [x for a, b, may in line_chunks.chunks(t)
                if not may or first["\n".join(lines[a:b])] == (i, a) for x in lines[a:b]]
        out.append((i, "\n".join(kept)))
    return out


def test_line_dedup_against_brute_force(spark):
    rng = random.Random(3)
    lines = [f"sentence number {i} with some words" for i in range(40)] + ["", "  "]
    shared = [f"shared passage line {i}" for i in range(8)]
    rows = [(i, "\n".join(rng.choices(lines, k=rng.randint(0, 6)) + shared + rng.choices(lines, k=rng.randint(0, 9))))
            for i in range(60)] + ODD
    got = line_chunks.dedup_lines(frame(spark, rows)).select("doc.*", "n_lines", "n_removed").collect()
    assert sorted(((r.doc_id, r.text) for r in got), key=str) == sorted(without_repeats(rows), key=str)
    assert all(r.size == "x" and r.key == 7 for r in got)
    assert sum(r.n_removed for r in got) > 200


def test_line_dedup_finds_shifted_and_long_passages(spark):
    passage = "\n".join(f"the {i}th line of a passage that many documents share" for i in range(30))
    line = " ".join(f"word{i}" for i in range(60))
    rows = [(1, "start\n" + passage), (2, "another\nlonger\nstart\n" + passage + "\nend"),
            (3, "own words\n" + line + "\nown end"), (4, line + "\nothers")]
    got = {r.doc.doc_id: r.doc.text for r in line_chunks.dedup_lines(frame(spark, rows)).collect()}
    assert got[1] == rows[0][1] and got[3] == rows[2][1]
    assert len(got[2].split("\n")) <= 10 and got[2].startswith("another") and got[2].endswith("end")
    assert got[4] == "others"


def test_line_dedup_hot_chunk_is_salted(spark, monkeypatch):
    monkeypatch.setattr(line_chunks, "SALT_ROWS", 5)
    block = "one line of a block\nand a second line of it"
    rows = [(i, block) for i in range(50)]
    got = {r.doc.doc_id: r.doc.text for r in line_chunks.dedup_lines(frame(spark, rows)).collect()}
    assert got == dict(without_repeats(rows))


def lines_said_before(rows, least=50):
    """(row, line) inside a run of over ``least`` words that an earlier document or the text before has, all pairs tried."""
    order = sorted(range(len(rows)), key=lambda i: (rows[i][0] is None, rows[i][0]))
    texts = [(rows[i][1] or "").split("\n") for i in order]
    gone = set()
    for d, own in enumerate(texts):
        for e in range(d + 1):
            for a in range(len(own)):
                for b in range(len(texts[e]) if e < d else a):
                    n = 0
                    while a + n < len(own) and b + n < (len(texts[e]) if e < d else a) and own[a + n] == texts[e][b + n]:
                        n += 1
                    if sum(len(x.split()) for x in own[a:a + n]) > least:
                        gone |= {(order[d], a + k) for k in range(n)}
    return gone


def test_line_dedup_removes_every_repeated_run(spark):
    rng = random.Random(11)
    rows = []
    for n in (2, 3, 4):
        for offset in range(6):
            # passages of n lines of under 50 words, over 50 in all, behind and before lines of no other document
            passage = [" ".join(f"p{n}x{offset}x{i}w{w}" for w in range(52 // n + rng.randint(1, 4))) for i in range(n)]
            passage.insert(1, "")
            for copy in range(3):
                own = [f"own {len(rows)} {k} {rng.random()}" for k in range(offset + copy + 2)]
                rows.append((len(rows), "\n".join(own[:offset] + passage + own[offset:])))
    # a run whose first window and last window stand in different documents, and repeats inside one text
    a, b, c = ([" ".join(f"{x}{i}w{w}" for w in range(20)) for i in range(4)] for x in "abc")
    rows += [(100, "\n".join(a + b)), (101, "\n".join(b + c)), (102, "\n".join(["new", *a, *b, *c, "end"])),
             (103, "\n".join(["in", *[x + "q" for x in a], "between", *[x + "q" for x in a], "out"])),
             (104, "\n".join(["one and the same line of nine words here"] * 12)), (105, "\n" * 3000 + "\n".join(a[:3]))]
    gone = lines_said_before(rows[:-1]) | {(len(rows) - 1, 3000 + k) for k in range(3)}
    got = {r.doc.doc_id: r for r in line_chunks.dedup_lines(frame(spark, rows)).collect()}
    first = {}
    for k, (i, t) in enumerate(rows):
        lines = t.split("\n")
        for x, y, may in line_chunks.chunks(t):
            if may and first.setdefault("\n".join(lines[x:y]), (i, x)) != (i, x):
                gone |= {(k, z) for z in range(x, y)}
        kept = [x for z, x in enumerate(lines) if (k, z) not in gone]
        assert got[i].doc.text == "\n".join(kept), i
        assert got[i].n_removed == len(lines) - len(kept)
    assert got[102].doc.text == "new\nend"


# licenses -------------------------------------------------------------------

def test_license_base_rule_against_regular_expressions(spark):
    rng = random.Random(5)
    bits = ["CC", "by", "cc-BY", "General Public", "License", "all", "rights", "RESERVED", "é", "x1", "\n", "...", "all rights"]
    rows = [(i, " ".join(rng.choices(bits, k=rng.randint(0, 40)))) for i in range(200)] + ODD
    got = licenses.license_report(licenses.scan_licenses(frame(spark, rows))).collect()
    want = []
    for i, t in rows:
        low = "".join(c.lower() if "A" <= c <= "Z" else c for c in t or "")
        w = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", low)
        at = sorted((k, lab) for p, lab in licenses.PHRASES.items() for k in range(len(w))
                    if w[k:k + len(p.split())] == p.split())
        want.append((i, len(w), len(at), at[0][0] if at else None, at[-1][0] if at else None,
                     ",".join(sorted({lab for _, lab in at}))))
    have = [(r.doc_id, r.n_words, r.n_base, r.first_word, r.last_word, r.base_labels) for r in got]
    assert sorted(have, key=str) == sorted(want, key=str)
    assert all(0 <= r.score <= 1 and set(r.base_labels.split(",")) - {""} <= set(r.labels.split(",")) for r in got)


@pytest.mark.parametrize("text, accepted", [
    ("Licensed under the Apache License, Version 2.0", {"apache-2.0"}),
    ("licensed under the apache license 2.0", {"apache-2.0"}),
    ("licensed under an apache license version 2.0", set()),
    ("Copyright (c) 2020 Some Holder Inc. All rights reserved.", {"copyright-notice"}),
    ("copyright a b c d e f g h all rights reserved", {"copyright-notice"}),
    ("copyright a b c d e f g h i all rights reserved", set()),
    ("this fine work is licensed under the terms of the GNU General Public License either version 3", {"gpl-3.0"}),
    ("mit", set()),
])
def test_templates_accept_mandatory_wording_only(text, accepted):
    found = licenses.Scanner(licenses.PHRASES, licenses.TEMPLATES).scan(text.encode())
    assert found[3] == accepted


def rendered(template, keep):
    """Words of a template with its optional parts kept or left out, replaceable ones filled in."""
    while "[[" in template:
        template = re.sub(r"\[\[((?:(?!\[\[|\]\]).)*)\]\]", lambda m: f" {m[1]} " if keep else " ", template, flags=re.S)
    fill = lambda m: " ".join(f"holder{k}" for k in range(int(m[1]) if keep else 1))
    return re.sub(r"\{\{(\d+)\}\}", fill, template).split()


@pytest.mark.parametrize("label", sorted(licenses.TEMPLATES))
def test_every_template_refuses_changed_wording(label):
    scanner, rng = licenses.Scanner({}, licenses.TEMPLATES), random.Random(label)
    for keep in (True, False):
        words = rendered(licenses.TEMPLATES[label], keep)
        whole = "Some heading.\n" + " ".join(words).capitalize() + ".\n\nMore text follows"
        assert label in scanner.scan(whole.encode())[3]
        bare = rendered(re.sub(r"\{\{\d+\}\}", "", licenses.TEMPLATES[label]), False)
        mandatory = [k for k, w in enumerate(words) if w in bare and not w.startswith("holder")] if not keep else []
        for k in rng.sample(mandatory, min(6, len(mandatory))):
            changed = words[:k] + ["otherwise"] + words[k + 1:]
            assert label not in scanner.scan(" ".join(changed).encode())[3], (label, k)
            assert label not in scanner.scan(" ".join(words[:k] + ["you", "pay", "us"] + words[k:]).encode())[3] \
                or label.endswith("notice") or k == 0
        assert keep or label not in scanner.scan(" ".join(words[:len(words) // 2]).encode())[3]


def test_openings_alone_are_not_accepted():
    scanner = licenses.Scanner(licenses.PHRASES, licenses.TEMPLATES)
    mit, bsd = (" ".join(rendered(licenses.TEMPLATES[t], False)) for t in ("mit-text", "bsd-3-clause-text"))
    evil = mit.replace("the software is provided", "the software shall be used for good not evil the software is provided")
    for text in (evil, mit[:300] + " and you pay us", bsd[:250] + " you pay us", "licensed under the mozilla public license"):
        assert scanner.scan(text.encode())[3] == set()
    assert scanner.scan(bsd.encode())[3] == {"bsd-3-clause-text"}


def test_automaton_against_regular_expression():
    template, pattern = "a [[b [[c]]]] {{2}} d [[a]]", r"^a (b (c )?)?(\S+ ){1,2}d( a)?"
    automaton, rng = licenses.Automaton(template), random.Random(1)
    for _ in range(500):
        words = rng.choices("abcd", k=rng.randint(1, 8))
        words[0] = "a"
        want = max((k for k in range(1, len(words) + 1) if re.fullmatch(pattern + "$", " ".join(words[:k]))), default=None)
        assert automaton.end_from([w.encode() for w in words], 0) == want
    for bad in ("[[a]]", "{{2}} a", "a [[b", "a ]] b"):
        with pytest.raises(ValueError):
            licenses.Automaton(bad)


# token counts ---------------------------------------------------------------

@pytest.mark.parametrize("block", [3, 7, 1 << 20])
def test_separator_scan_over_blocks(spark, block):
    rows = [(i, t) for i, t in ODD if i != 4 and i is not None and i != 5] + [(9, "hello world " * 30), (10, "x")]
    got = separators.document_token_counts(spark, frame(spark, rows).repartition(3), RANKS, END_OF_DOCUMENT, block)
    coder = separators.tokenizer(RANKS)
    assert sorted(map(tuple, got.collect())) == sorted((i, len(coder.encode_ordinary(t or ""))) for i, t in rows)


def test_separator_scan_of_foreign_files(spark, tmp_path):
    rng = np.random.default_rng(1)
    want = []
    for n, (size, p) in enumerate([(0, 0.1), (1, 1.0), (50, 0.2), (997, 0.01), (300, 0.0), (64, 1.0)]):
        ids = np.where(rng.random(size) < p, 9, 1).astype("<u2")
        (tmp_path / f"{n}.bin").write_bytes(ids.tobytes())
        ends = np.flatnonzero(ids == 9)
        if size and (not len(ends) or ends[-1] != size - 1):
            ends = np.append(ends, size)
        starts = np.concatenate([[0], ends[:-1] + 1]) if len(ends) else ends
        want += [(f"{tmp_path}/{n}.bin", k, int(a), int(b - a)) for k, (a, b) in enumerate(zip(starts, ends))]
    files = spark.createDataFrame([(f"{tmp_path}/{n}.bin", os.path.getsize(f"{tmp_path}/{n}.bin") // 2)
                                   for n in range(6)], "file string, tokens long")
    got = separators.count_tokens(files, str(tmp_path), 9, block=16)
    assert sorted(map(tuple, got.collect())) == sorted(want)


# pieces ---------------------------------------------------------------------

def test_pieces_equal_the_reference_encoder(spark):
    import sentencepiece

    known = sentencepiece.SentencePieceProcessor(model_file=PIECES)
    rng = random.Random(2)
    rows = [(i, "".join(rng.choices("ab  the\n\t.,;don't日本ﬁé́हि123😀　x", k=rng.randint(0, 50)))) for i in range(300)]
    rows += [r for r in ODD if r[0] not in (4, None)] + [(7, "a" * 4000), (8, " " * 500), (9, LONG[:20000])]
    got = wfst.encode_documents(frame(spark, rows), PIECES)
    coded = sorted(((r.doc_id, r.ids, r.n_tokens, r.lossless) for r in got.collect()), key=str)
    want = sorted(((i, None if t is None else known.encode(t), len(known.encode(t or "")), None if t is None else True)
                   for i, t in rows), key=str)
    assert coded == want
    back = wfst.decode_documents(got, PIECES)
    assert sorted(map(tuple, back.collect()), key=str) == sorted(rows, key=str)


def test_unigram_machine_takes_the_shortest_path():
    def field(n, kind, data):
        return bytes([n << 3 | kind]) + (bytes([len(data)]) + data if kind == 2 else data)

    import struct
    pieces = [("<unk>", 0.0, 2), ("▁", -3.0, 1), ("a", -2.0, 1), ("b", -2.5, 1), ("ab", -3.0, 1), ("▁a", -3.5, 1),
              ("aba", -7.0, 1)]
    data = b"".join(field(1, 2, field(1, 2, p.encode()) + field(2, 5, struct.pack("<f", s)) + field(3, 0, bytes([t])))
                    for p, s, t in pieces)
    machine = wfst.Transducer(wfst.Model(data))
    score = {p: s for p, s, t in pieces if t == 1}

    def best(text):
        ways = {0: (0.0, [])}
        for j in range(1, len(text) + 1):
            ways[j] = min((ways[i][0] - score[text[i:j]], ways[i][1] + [text[i:j]])
                          for i in range(j) if text[i:j] in score and i in ways)
        return ways[len(text)][1]

    for text in ("ab", "aba", "abab", "ab ab", "aabba"):
        ids = np.frombuffer(machine.encode(text), np.int32)
        assert [pieces[i][0] for i in ids] == best("▁" + text.replace(" ", "▁"))


# languages --------------------------------------------------------------------

def test_languages_fuse_evidence(spark):
    words = {"en": "the of and to in that", "fr": "le la de et les des", "de": "der die und das den zu",
             "es": "el los que y por una"}
    rng = random.Random(4)
    rows = [(i, " ".join(rng.choices(words[lang].split(), k=12)), lang) for i, lang in enumerate(list(words) * 40)]
    rows += [(1000, None, "en"), (1001, "", "en"), (1002, "123 456", "fr"), (1003, LONG, "en"), (1004, "le la", None)]
    docs = spark.createDataFrame([(i, t, lang, "h", "s", 0.1, [1.0]) for i, t, lang in rows],
                                 "doc_id long, text string, lang string, source string, suffix string, n double, s array<double>")
    model = langid.fit(docs)
    for keep in (None, ["doc_id"]):
        found = langid.identify(docs, model, docs["text"], docs["lang"], docs["source"], docs["suffix"], keep=keep)
        got = {r.doc.doc_id: r for r in found.collect()}
        assert len(got) == len(rows)
        assert all(got[i].lang == lang and got[i].accepted for i, _, lang in rows[:160])
        assert all(got[i].lang == "und" and not got[i].accepted for i in (1000, 1001, 1002))
        assert got[1004].lang == "fr"
    assert langid.identify(docs.limit(0), model, docs["text"], docs["lang"], docs["source"], docs["suffix"]).count() == 0


def test_model_does_not_depend_on_partitions_or_copies(spark):
    rng = random.Random(8)
    words = {"en": "the of and to in that", "pt": "o que de uma não com", "sv": "och att det som en på", "xx": "zz"}
    rows = [(" ".join(rng.choices(words[lang].split(), k=9)), lang) for lang in ("en", "pt", "sv") for _ in range(60)]
    rows += [("zz yy", "xx")] * 9 + [("the same text of all", "en")] * 200 + [("the same text of all", "pt")]
    models = [langid.fit(spark.createDataFrame(order, "text string, lang string").repartition(n), max_rows=100)
              for order, n in ((rows, 1), (rows[::-1], 40))]
    assert models[0].languages == models[1].languages == ("en", "pt", "sv")     # xx is declared too seldom
    assert np.array_equal(models[0].table, models[1].table)
    given = langid.fit(spark.createDataFrame(rows, "text string, lang string"), languages=("sv", "xx"))
    assert given.languages == ("sv", "xx")


def test_posterior_against_plain_python(spark):
    """Likelihoods, declarations and smoothed priors fused by hand."""
    rng = random.Random(9)
    words = {"en": "the of and to in that la", "fr": "le la de et les des of"}
    rows = []
    for i in range(90):
        lang = "en" if i % 3 else "fr"
        text = " ".join(rng.choices(words[lang].split(), k=rng.randint(1, 30))) if i % 13 else rng.choice(["", "42", None])
        rows.append((i, text, rng.choice([lang, lang, "fr", None, "de"]), f"h{i % 7 if i % 2 else 0}", "s" if i % 7 < 4 else "t"))
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, host string, suffix string")
    model = langid.fit(docs, languages=("en", "fr"), bits=10)
    found = langid.identify(docs, model, docs["text"], docs["lang"], docs["host"], docs["suffix"], keep=["doc_id"])
    got = {r.doc.doc_id: r for r in found.collect()}

    def grams(text):
        words = re.findall("[a-z]+", (text or "").lower())
        data = (" " + " ".join(words) + " ").encode()
        return [((data[k] << 16 | data[k + 1] << 8 | data[k + 2]) * 2654435761 % 2 ** 32) >> 22
                for k in range(len(data) - 2)] if words else []

    counts = {lang: Counter() for lang in ("en", "fr")}
    for text, lang in {t: min(x for _, u, x, _, _ in rows if u == t and x in counts)
                       for _, t, lab, _, _ in rows if t is not None and lab in counts}.items():
        counts[lang].update(grams(text))
    logs = []
    for lang in ("en", "fr"):
        whole = sum(counts[lang].values()) + 512
        logs.append([math.log((counts[lang][g] + 0.5) / whole) for g in range(1024)])
    logs.append([math.log(1 / 1024)] * 1024)

    def soft(v):
        e = [math.exp(x - max(v)) for x in v]
        return [x / sum(e) for x in e]

    def likely(text):
        found = grams(text)
        return [sum(t[g] for g in found) * min(60, len(found)) / len(found) for t in logs] if found else None

    fits = {i: likely(t) for i, t, *_ in rows}
    shares = {i: soft(f) if f else [1 / 3] * 3 for i, f in fits.items()}

    def total(picked):
        return [sum(shares[r[0]][k] for r in picked) for k in range(3)]

    level = [(x + 1) / (len(rows) + 3) for x in total(rows)]
    said = {d: total([r for r in rows if (r[2] or "") == d]) for d in {r[2] or "" for r in rows}}
    per_class = [sum(v[k] for v in said.values()) for k in range(3)]
    for i, text, declared, host, suffix in rows:
        of_suffix = [r for r in rows if r[4] == suffix]
        of_host = [r for r in of_suffix if r[3] == host]
        q = [(x + 8 * y) / (len(of_suffix) + 8) for x, y in zip(total(of_suffix), level)]
        prior = [(max(0, x - own) + 8 * y) / (len(of_host) - 1 + 8) for x, own, y in zip(total(of_host), shares[i], q)]
        prior[2] = min(prior[2], 1e-3)
        says = [math.log((said[declared][k] + 1) / (per_class[k] + len(said))) if declared else 0 for k in range(3)]
        if fits[i] is None:
            assert (got[i].lang, got[i].confidence, got[i].accepted) == ("und", 0.0, False)
            continue
        fused = soft([math.log(max(p, 1e-9)) + s + f for p, s, f in zip(prior, says, fits[i])])
        assert got[i].confidence == pytest.approx(max(fused), abs=1e-4), i
        assert got[i].lang == ("en", "fr", "und")[fused.index(max(fused))]


def test_host_prior_decides_short_texts(spark):
    rows = [(i, "el la de", None, "fr.example" if i < 40 else "es.example") for i in range(80)]
    rows += [(100 + i, "le la de et les des", None, "fr.example") for i in range(60)]
    rows += [(200 + i, "el los que y por una", None, "es.example") for i in range(60)]
    train = spark.createDataFrame([(1, "le la de et les des el", "fr"), (2, "el los que y por una la de", "es")],
                                  "doc_id long, text string, lang string")
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, host string")
    found = langid.identify(docs, langid.fit(train, least_rows=1), F_col(docs, "text"), F_col(docs, "lang"), F_col(docs, "host"),
                            F_col(docs, "host"), text_weight=2.0)
    got = {r.doc.doc_id: r.lang for r in found.collect()}
    assert {got[i] for i in range(40)} == {"fr"} and {got[i] for i in range(40, 80)} == {"es"}


def F_col(df, name):
    return df[name]


def test_page_helpers(spark):
    page = "<html LANG='fr-CA'><head><script>var a='<p>';</script><!-- x --></head><body><p>le <b>mot</b></p></body>"
    df = spark.createDataFrame([(page, "https://user@Www.Example.co.fr:80/a?b"), (None, None), ("plain", "not an url")],
                               "html string, url string")
    got = [tuple(r) for r in df.select(langid.page_text(df.html), langid.page_language(df.html), langid.url_host(df.url),
                                       langid.host_suffix(langid.url_host(df.url)),
                                       langid.code(langid.page_language(df.html))).collect()]
    assert got[0][0].split() == ["le", "mot"] and got[0][1:] == ("fr-CA", "www.example.co.fr", "fr", "fr")
    assert got[1][0] is None and got[2][1:3] == ("", "")


# toxicity -----------------------------------------------------------------------

def test_toxicity_learns_and_keeps_odd_rows(spark):
    rng = random.Random(6)
    common = [f"w{i}" for i in range(300)]
    rows, labels = [], []
    for i in range(600):
        bad = i % 5 == 0
        text = rng.choices(common, k=60) + (rng.choices(["vileword", "nasty", "rotten"], k=2) if bad else [])
        rng.shuffle(text)
        rows.append((i, " ".join(text)))
        labels.append((i, 1, int(bad)))
    odd = [(1000 + (i or 0), t) for i, t in ODD]
    docs = frame(spark, rows + odd)
    marks = spark.createDataFrame(labels[:400] + [(None, 1, 1), (3, 1, None), (5, 1, 7)], "doc_id long, quality int, toxic int")
    weights = toxicity.fit(docs, marks)
    assert 0 < len(weights) < 1000
    got = {}
    for r in toxicity.score(docs, weights).collect():
        got.setdefault(r.doc_id, r.score)
    assert len(got) == 600 + len({i for i, _ in odd})
    held = [(got[i], i % 5 == 0) for i in range(400, 600)]
    assert np.mean([(s >= 0.7) == bad for s, bad in held]) >= 0.95
    assert min(s for s, bad in held if bad) > max(s for s, bad in held if not bad)
    assert got[1001] == got[1002] and all(0 <= s <= 1 for s in got.values())
    again = toxicity.fit(docs.repartition(7), marks)
    assert again == weights
    assert {r.score for r in toxicity.score(docs, toxicity.fit(docs, marks.limit(0))).collect()} == {0.5}
