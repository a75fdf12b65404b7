"""Language identification by fusing evidence with Bayes' rule.

Evidence of a row: its text (likelihood under hashed byte trigrams of each
language), the language its markup declares, its address suffix and its host.
The prior of a host is smoothed towards its suffix, the suffix's towards the
whole corpus; both and the reliability of declarations come from grouped sums
of text posteriors over all rows, a row's own share taken out of its host's.
Text counts with the weight of at most ``text_weight`` trigrams, for neighbouring
trigrams are far from independent. A row in none of the languages is "und",
whose text likelihood is level over all trigrams.

The languages are those that at least ``LEAST_ROWS`` rows declare, unless they
are given. Fitting reads a bounded sample of labelled texts (the ``max_rows``
distinct ones with the least hash, so copies count once and the sample doesn't
depend on the partitions); everything else covers all rows.

Defined cases: a null, empty or letterless text gives "und" and is rejected; a
null or unknown declaration says nothing; a null host or suffix is one host or
suffix of its own; without training rows, or in an empty table, every row is
"und"; of equal texts with several labels the least counts; repeated rows are
judged each, with the same result; texts of any length are read whole; rows
travel as one column, so their names may be any.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from slatecast.llm.common import hash60, join_hot, quoted, store
from slatecast.llm.licenses import words_of

BITS = 15
LEAST_ROWS, MAX_ROWS = 10, 20_000
SMOOTH_HOST, SMOOTH_SUFFIX, UNKNOWN_PRIOR = 8.0, 8.0, 1e-3
TEXT_WEIGHT, CONFIDENCE = 60.0, 0.5


@dataclass(frozen=True)
class Model:
    """Log likelihood of each hashed trigram: one column per language, the last for "und"."""

    languages: tuple[str, ...]
    table: np.ndarray


def trigrams(text: bytes | None, bits: int = BITS) -> np.ndarray:
    """Hashed trigrams of the lower-cased words, a blank between words; digits don't count."""
    words = [w for w in words_of(text or b"") if not w.isdigit()]
    if not words:
        return np.empty(0, np.int64)
    data = np.frombuffer(b" " + b" ".join(words) + b" ", np.uint8).astype(np.uint32)
    codes = (data[:-2] << 16 | data[1:-1] << 8 | data[2:]) * np.uint32(2654435761)
    return (codes >> np.uint32(32 - bits)).astype(np.int64)


def code(col: Column) -> Column:
    """A declared language as two lower-case letters, or null."""
    two = F.lower(F.regexp_extract(F.trim(col.cast("string")), r"^([A-Za-z]{2})([-_].*)?$", 1))
    return F.when(two != "", two)


def declared_languages(labels: DataFrame, least: int = LEAST_ROWS) -> tuple[str, ...]:
    """Codes (column ``lang``) that at least so many rows declare: at most 26 * 26."""
    counts = labels.filter(F.col("lang").isNotNull()).groupBy("lang").agg(F.count("*").alias("n"))
    return tuple(sorted(r["lang"] for r in counts.filter(F.col("n") >= least).select("lang").collect()))


def fit(docs: DataFrame, text: str = "text", lang: str = "lang", languages: Sequence[str] | None = None,
        bits: int = BITS, max_rows: int = MAX_ROWS, least_rows: int = LEAST_ROWS) -> Model:
    """Trigram likelihoods from the rows that declare one of the languages."""
    labelled = docs.select(F.col(text).cast("string").alias("text"), code(F.col(lang)).alias("lang"))
    labelled = labelled.filter(F.col("text").isNotNull() & F.col("lang").isNotNull())
    languages = tuple(declared_languages(labelled, least_rows) if languages is None else languages)
    labelled = labelled.filter(F.col("lang").isin(*languages)).withColumn("order", hash60(F.col("text")))
    # the border of the sample: the hash of the last of max_rows distinct texts
    border = labelled.select("order").distinct().orderBy("order").limit(max_rows).agg(F.max("order")).first()[0]
    sample = labelled.filter(F.col("order") <= F.lit(border)) if border is not None else labelled.limit(0)
    sample = sample.groupBy("order").agg(F.min(F.struct("lang", "text")).alias("one")).select("one.text", "one.lang")

    def count(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = np.zeros((len(languages), 1 << bits), np.int64)
        for part in parts:
            for t, lab in zip(part.column(0).cast(pa.binary()).to_pylist(), part.column(1).to_pylist()):
                table[languages.index(lab)] += np.bincount(trigrams(t, bits), minlength=1 << bits)
        lang_at, at = np.nonzero(table)
        yield pa.RecordBatch.from_arrays([pa.array(lang_at), pa.array(at), pa.array(table[lang_at, at])],
                                         names=["lang", "at", "n"])

    counts = sample.mapInArrow(count, "lang long, at long, n long").groupBy("lang", "at").agg(F.sum("n").alias("n"))
    found = counts.toArrow()     # at most languages * 2^bits rows
    table = np.full((1 << bits, len(languages) + 1), 0.5)
    np.add.at(table, (found.column("at").to_numpy(), found.column("lang").to_numpy()), found.column("n").to_numpy())
    table[:, -1] = 1.0
    log = np.log(table / table.sum(0, keepdims=True))
    empty = table[:, :-1].sum(0) <= 0.5 * (1 << bits)
    log[:, :-1][:, empty] = np.log(0.25 / (1 << bits))    # a language without training text never wins
    return Model(languages, log.astype(np.float32))


def likelihoods(texts: Sequence[bytes | None], table: np.ndarray, text_weight: float) -> np.ndarray:
    """Weighted log likelihood per language and "und" of each text; nan without letters."""
    bits = int(np.log2(len(table)))
    out = np.full((len(texts), table.shape[1]), np.nan)
    for i, t in enumerate(texts):
        at = trigrams(t, bits)
        if len(at):
            out[i] = table[at].sum(0, dtype=np.float64) * (min(text_weight, len(at)) / len(at))
    return out


def softmax(scores: np.ndarray) -> np.ndarray:
    """Row by row; rows of nan become level."""
    e = np.exp(scores - np.nan_to_num(scores).max(1, keepdims=True))
    e[np.isnan(e)] = 1.0
    return e / e.sum(1, keepdims=True)


def _lists(rows: np.ndarray) -> pa.Array:
    flat = pa.array(np.ascontiguousarray(rows).ravel())
    return pa.FixedSizeListArray.from_arrays(flat, rows.shape[1]).cast(pa.list_(pa.float64()))


def _matrix(column: pa.Array, width: int) -> np.ndarray:
    return np.asarray(column.flatten()).astype(np.float64).reshape(-1, width)


def identify(rows: DataFrame, model: Model, text: Column, declared: Column, host: Column, suffix: Column,
             keep: Sequence[str] | None = None, text_weight: float = TEXT_WEIGHT,
             confidence: float = CONFIDENCE) -> DataFrame:
    """(doc, lang, confidence, accepted) for every row; ``doc`` holds the columns ``keep``, by default all.

    With ``keep`` texts are read once; whole rows are read a second time, after
    the grouped sums, and shuffled once to meet their host's prior.
    """
    spark, wide = rows.sparkSession, keep is None
    classes = [*model.languages, "und"]
    width = len(classes)
    shared = spark.sparkContext.broadcast(model.table)      # 2^bits rows, a column per language
    evidence = [F.coalesce(host.cast("string"), F.lit("")).alias("host"),
                F.coalesce(suffix.cast("string"), F.lit("")).alias("suffix"),
                F.coalesce(code(declared), F.lit("")).alias("declared"),
                F.xxhash64(text.cast("string")).alias("mark"),
                text.cast("string").alias("text")]
    doc = F.struct(*[rows[quoted(c)].alias(c) for c in (keep or rows.columns)]).alias("doc")
    scored = rows.select(*([] if wide else [doc]), *evidence)
    names = [c for c in scored.columns if c != "text"]

    def score(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in parts:
            for at in range(0, whole.num_rows, 1000):
                part = whole.slice(at, 1000)
                fit_ = likelihoods(part.column("text").cast(pa.binary()).to_pylist(), shared.value, text_weight)
                yield pa.RecordBatch.from_arrays(
                    [part.column(c) for c in names] + [_lists(fit_), _lists(softmax(fit_))],
                    names=[*names, "fit", "share"])

    nothing = F.lit(None).cast("array<double>")
    narrow = store(scored.mapInArrow(score, scored.drop("text").withColumns(
        {"fit": nothing, "share": nothing}).schema), "language-evidence")

    sums = [F.sum(F.col("share")[i]).alias(f"s{i}") for i in range(width)]
    again = [F.sum(f"s{i}").alias(f"s{i}") for i in range(width)]
    hosts = store(narrow.groupBy("host", "suffix").agg(F.count("*").alias("n"), *sums), "language-hosts")
    whole = hosts.agg(F.sum("n").alias("n"), *again).first()
    level = [((whole[f"s{i}"] or 0.0) + 1.0) / (float(whole["n"] or 0) + width) for i in range(width)]
    suffixes = hosts.groupBy("suffix").agg(F.sum("n").alias("m"), *again).select("suffix", F.array(*[
        (F.col(f"s{i}") + SMOOTH_SUFFIX * level[i]) / (F.col("m") + SMOOTH_SUFFIX) for i in range(width)]).alias("q"))
    priors = hosts.select("host", "suffix", "n", F.array(*[f"s{i}" for i in range(width)]).alias("s")) \
        .join(suffixes, "suffix")
    priors = store(priors, "host-priors")
    # how often each language declares each code: at most 26 * 26 + 1 rows
    said = {r["declared"]: np.array([r[f"s{i}"] for i in range(width)])
            for r in narrow.groupBy("declared").agg(*sums).collect()}
    per_class = sum(said.values(), np.zeros(width))
    says = {d: np.log((v + 1.0) / (per_class + len(said))) for d, v in said.items() if d}

    def fuse(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table, none = shared.value, np.zeros(width)
        for full in parts:
            for at in range(0, full.num_rows, 1000):
                part = full.slice(at, 1000)
                fit_ = likelihoods(part.column("text").cast(pa.binary()).to_pylist(), table, text_weight) if wide \
                    else _matrix(part.column("fit"), width)
                n = part.column("n").to_numpy()[:, None]
                own = np.maximum(0.0, _matrix(part.column("s"), width) - softmax(fit_))
                prior = (own + SMOOTH_HOST * _matrix(part.column("q"), width)) / (n - 1 + SMOOTH_HOST)
                prior[:, -1] = np.minimum(prior[:, -1], UNKNOWN_PRIOR)
                markup = np.array([says.get(d, none) for d in part.column("declared").to_pylist()]).reshape(-1, width)
                fused = softmax(np.log(np.maximum(prior, 1e-9)) + markup + fit_)
                best = fused.argmax(1)
                silent = np.isnan(fit_).any(1)
                best[silent] = width - 1
                sure = np.where(silent, 0.0, fused.max(1))
                yield pa.RecordBatch.from_arrays(
                    [part.column("doc"), pa.array([classes[b] for b in best], pa.string()), pa.array(sure),
                     pa.array((best < width - 1) & (sure >= confidence))],
                    names=["doc", "lang", "confidence", "accepted"])

    body = rows.select(doc, *evidence) if wide else narrow
    joined = join_hot(body, priors, ["host", "suffix"], ["mark"]).select(
        "doc", "declared", "text" if wide else "fit", "n", "s", "q")
    schema = T.StructType([T.StructField("doc", joined.schema["doc"].dataType), T.StructField("lang", T.StringType()),
                           T.StructField("confidence", T.DoubleType()), T.StructField("accepted", T.BooleanType())])
    return joined.mapInArrow(fuse, schema)


def page_text(html: Column) -> Column:
    """Text between the tags of a page, without scripts, styles and comments."""
    bare = F.regexp_replace(html, r"(?is)<(script|style)\b.*?</\1\s*>|<!--.*?-->", " ")
    return F.regexp_replace(bare, r"(?s)<[^>]*>", " ")


def page_language(html: Column) -> Column:
    return F.regexp_extract(html, r"""(?i)<html[^>]*\blang\s*=\s*["']?([A-Za-z_-]+)""", 1)


def url_host(url: Column) -> Column:
    return F.lower(F.regexp_extract(url, r"^[A-Za-z][A-Za-z0-9+.-]*://(?:[^/?#@]*@)?([^/:?#]+)", 1))


def host_suffix(host: Column) -> Column:
    return F.element_at(F.split(host, r"\."), -1)
