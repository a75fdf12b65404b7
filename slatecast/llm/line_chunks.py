"""Line dedup by content-defined chunks and by runs of lines.

A text is cut into chunks of lines where a rolling hash over the hashes of the
last two lines hits one value in ``average``, so an insertion or deletion only
moves the borders next to it. A line of ``long_words`` words or more is a chunk
by itself. Chunks of two lines with words (or one long line) that occur more
than once in the corpus go, except for their first occurrence (least doc_id,
then line).

Borders don't decide about longer passages: every line also starts a window, the
fewest lines from it on with more than ``long_words`` words, and ends one, the
fewest lines up to it. Windows that occurred before go as well. The windows that
lie inside a run of lines cover all of it, and equal runs have equal windows, so
each run of whole lines with more than ``long_words`` words that stands earlier
in the corpus is removed whole, wherever it starts. Out of reach stay passages of
at most ``long_words`` words that are no chunk, passages that begin or end inside
a line, and lines that differ in any byte.

Hash rows alone are grouped to find repeats. Repeats of one document that lie at
one distance from their first occurrences are joined to stretches of lines. The
text of first occurrences then travels to the documents that repeat them, whose
rows are shuffled once for both directions, and each document compares byte by
byte and cuts by itself. Stretches that very many documents share are salted by
their count.

Defined cases: a null text stays null, an empty one empty; a text of which
everything is removed becomes empty (its row stays); rows equal in doc_id and
text are one document and are treated alike; a null doc_id comes last in
order; repeats inside one document go too unless they overlap their first
occurrence; blank lines inside or next to a repeated run belong to it; each
removed line stands earlier in the corpus; lines end at "\\n" and whole texts
are read; an empty table gives an empty result; rows travel as one column, so
their names may be any.
"""

from __future__ import annotations

import itertools
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from slatecast.llm.common import join_hot, quoted, store

AVERAGE, LONG_WORDS, SALT_ROWS = 3, 50, 2000
_M = (1 << 64) - 1
_P, _BASE = (1 << 127) - 1, 0x5851F42D4C957F2D14057B7EF767814F
FETCHED_BYTES = 16_000_000


def chunks(text: str, average: int = AVERAGE, long_words: int = LONG_WORDS) -> list[tuple[int, int, bool]]:
    """(first line, line after the last, whether it may be removed) of each chunk of a text."""
    lines = text.split("\n")
    out, start, before = [], 0, 0
    lengthy = [len(line) >= long_words * 2 - 1 and len(line.split()) >= long_words for line in lines]
    for i, line in enumerate(lines):
        own = xxhash.xxh64_intdigest(line.encode("utf-8", "surrogatepass"))
        rolled = (before * 0x9E3779B97F4A7C15 + own) & _M
        rolled = ((rolled ^ (rolled >> 31)) * 0xD6E8FEB86659FD93) & _M
        before = own
        last = i + 1 == len(lines)
        if last or lengthy[i] or lengthy[i + 1] or (rolled >> 32) % average == 0:
            full = sum(1 for k in range(start, i + 1) if lines[k].strip())
            out.append((start, i + 1, full >= 2 or lengthy[start]))
            start = i + 1
    return out


def windows(text: str, long_words: int = LONG_WORDS) -> list[tuple[int, int]]:
    """(first line, line after the last) of the fewest lines over ``long_words`` words from and up to each line."""
    n_words = [len(line.split()) for line in text.split("\n")]
    out, end, held = set(), 0, 0
    for a, own in enumerate(n_words):
        while end < len(n_words) and held <= long_words:
            held += n_words[end]
            end += 1
        if held <= long_words:
            break
        out.add((a, end))
        held -= own
    start, held = 0, 0
    for b, own in enumerate(n_words):
        held += own
        while held - n_words[start] > long_words:
            held -= n_words[start]
            start += 1
        if held > long_words:
            out.add((start, b + 1))
    return sorted(out)


def units(text: str, average: int = AVERAGE, long_words: int = LONG_WORDS) -> list[tuple[int, int, int]]:
    """(first line, line after the last, 128-bit hash) of all that may be removed: chunks and windows."""
    lines = [line.encode("utf-8", "surrogatepass") for line in text.split("\n")]
    out = [(a, b, xxhash.xxh3_128_intdigest(b"\n".join(lines[a:b])))
           for a, b, may in chunks(text, average, long_words) if may]
    found = windows(text, long_words)
    if found:
        # a polynomial over line hashes: each window costs the same, however many lines it has
        sums, powers = [0], [1]
        for line in lines:
            sums.append((sums[-1] * _BASE + xxhash.xxh3_128_intdigest(line)) % _P)
        for _ in range(max(b - a for a, b in found)):
            powers.append(powers[-1] * _BASE % _P)
        out += [(a, b, (1 << 127) + (sums[b] - sums[a] * powers[b - a]) % _P) for a, b in found]
    return out


def stretches(repeats: list[dict]) -> list[tuple[int, int, int, int, int]]:
    """(first key, first tag, line there, line here, lines): repeats at one distance joined where they touch."""
    out: list[tuple[int, int, int, int, int]] = []
    order = sorted((r["key"], r["tag"], r["line"] - r["at"], r["at"], r["last"]) for r in repeats)
    for (key, tag, distance), group in itertools.groupby(order, lambda r: r[:3]):
        start, end = None, None
        for *_, a, b in group:
            if end is not None and a <= end:
                end = max(end, b)
                continue
            if end is not None:
                out.append((key, tag, start + distance, start, end - start))
            start, end = a, b
        out.append((key, tag, start + distance, start, end - start))
    return out


#: Bytes that a task may hand to Python at a time, where the session allows more: texts and the passages they are
#: compared with stand in the JVM's buffer, in Python's and in its lists at once.
BATCH_BYTES = 8 << 20


def small_batches(spark: SparkSession) -> None:
    """Lower the session's limit on the bytes of an Arrow batch."""
    name = "spark.sql.execution.arrow.maxBytesPerBatch"
    if spark.sparkContext._jvm.org.apache.spark.network.util.JavaUtils.byteStringAsBytes(spark.conf.get(name)) > BATCH_BYTES:
        spark.conf.set(name, str(BATCH_BYTES))


def dedup_lines(docs: DataFrame, text: str = "text", doc_id: str = "doc_id", average: int = AVERAGE,
                long_words: int = LONG_WORDS) -> DataFrame:
    """(doc, n_lines, n_removed): every row, its text without what stood before; ``doc`` has the columns of ``docs``."""
    small_batches(docs.sparkSession)
    options = {"average": average, "long_words": long_words}
    key = [F.coalesce(docs[doc_id].cast("long"), F.lit((1 << 63) - 1)).alias("key"),
           F.xxhash64(docs[text]).alias("tag")]
    place = docs.columns.index(text)
    whole = docs.select(F.struct(*[docs[quoted(c)].alias(c) for c in docs.columns]).alias("doc"), *key)

    def hashed(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole_part in parts:
            for at in range(0, whole_part.num_rows, 500):
                part = whole_part.slice(at, 500)
                row, first, last, digests = [], [], [], []
                for i, t in enumerate(part.column(2).to_pylist()):
                    for a, b, digest in units(t, **options) if t else ():
                        row.append(i)
                        first.append(a)
                        last.append(b)
                        digests.append(digest.to_bytes(16, "big"))
                take = pa.array(row, pa.int64())
                halves = np.frombuffer(b"".join(digests), ">i8").astype(np.int64).reshape(-1, 2)
                yield pa.RecordBatch.from_arrays(
                    [part.column(0).take(take), part.column(1).take(take), pa.array(first, pa.int64()),
                     pa.array(last, pa.int64()), pa.array(halves[:, 0].copy()), pa.array(halves[:, 1].copy())],
                    names=["key", "tag", "line", "last", "h1", "h2"])

    hashes = docs.select(*key, docs[text].cast("string").alias("text"))
    rows = store(hashes.mapInArrow(hashed, "key long, tag long, line long, last long, h1 long, h2 long"), "chunk-hashes")
    repeated = store(rows.groupBy("h1", "h2").agg(
        F.count("*").alias("n"), F.min(F.struct("key", "tag", "line")).alias("first")).filter("n > 1"), "chunk-counts")
    here = (F.col("key") == F.col("first.key")) & (F.col("tag") == F.col("first.tag"))
    overlaps = here & (F.col("first.line") + F.col("last") - F.col("line") > F.col("line"))   # or is the first
    seen = join_hot(rows, repeated, ["h1", "h2"], ["key", "tag", "line"]).filter(~overlaps).groupBy("key", "tag").agg(F.collect_set(F.struct(
        "first.key", "first.tag", "first.line", F.col("line").alias("at"), "last")).alias("repeats"))

    def joined_up(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in parts:
            row, out = [], []
            for i, repeats in enumerate(part.column(2).to_pylist()):
                found = stretches(repeats)
                row += [i] * len(found)
                out += found
            take = pa.array(row, pa.int64())
            columns = np.array(out, np.int64).reshape(-1, 5)
            yield pa.RecordBatch.from_arrays(
                [part.column(0).take(take), part.column(1).take(take)]
                + [pa.array(columns[:, k].copy()) for k in range(5)],
                names=["key", "tag", "first_key", "first_tag", "first_line", "line", "n"])

    place_of_first = ["first_key", "first_tag", "first_line", "n"]
    seen = store(seen.mapInArrow(joined_up, "key long, tag long, first_key long, first_tag long, first_line long, "
                                            "line long, n long"), "chunk-repeats")
    salts = F.greatest(F.lit(1), F.ceil(F.count("*") / SALT_ROWS)).cast("int")
    wanted = store(seen.groupBy(*place_of_first).agg(salts.alias("salts")), "chunk-firsts")
    firsts = wanted.groupBy(F.col("first_key").alias("key"), F.col("first_tag").alias("tag")).agg(
        F.collect_list(F.struct("first_line", "n", "salts")).alias("wanted"))

    def fetched(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def batch(out):
            return pa.RecordBatch.from_arrays(
                [*(pa.array(column, pa.int64()) for column in out[:4]), pa.array(out[4], pa.int32()),
                 pa.array(out[5], pa.string())], names=[*place_of_first, "salts", "first_text"])

        for part in parts:
            for at in range(0, part.num_rows, 200):
                piece = part.slice(at, 200)
                out, held = [[] for _ in range(6)], 0
                texts = piece.column(2).field(place).to_pylist()
                for k, t, tag, wanted in zip(piece.column(0).to_pylist(), texts, piece.column(1).to_pylist(),
                                             piece.column(3).to_pylist()):
                    lines = t.split("\n")
                    for w in wanted:
                        found = "\n".join(lines[w["first_line"]:w["first_line"] + w["n"]])
                        for column, value in zip(out, (k, tag, w["first_line"], w["n"], w["salts"], found)):
                            column.append(value)
                        held += len(found)
                        if held > FETCHED_BYTES:
                            yield batch(out)
                            out, held = [[] for _ in range(6)], 0
                yield batch(out)

    # the whole row goes along in both directions, so that both use one exchange of the documents
    originals = whole.join(firsts, ["key", "tag"]).select("key", "tag", "doc", "wanted").mapInArrow(
        fetched, "first_key long, first_tag long, first_line long, n long, salts int, first_text string"
    ).dropDuplicates(place_of_first)
    originals = originals.withColumn("salt", F.explode(F.expr("sequence(0, salts - 1)"))).drop("salts")
    others = seen.join(wanted, place_of_first).withColumn(
        "salt", F.pmod(F.xxhash64("key", "tag", "line"), F.col("salts")).cast("int")).drop("salts")
    compare = others.join(originals, [*place_of_first, "salt"]).groupBy("key", "tag").agg(
        F.collect_set(F.struct("line", "n", "first_text")).alias("compare"))

    def cut(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in parts:
            for at in range(0, part.num_rows, 500):
                piece = part.slice(at, 500)
                doc = piece.column(0)
                texts, n_lines, n_removed = [], [], []
                for t, compared in zip(doc.field(place).to_pylist(), piece.column(1).to_pylist()):
                    lines = t.split("\n") if t else []
                    n_lines.append(len(lines))
                    if compared:
                        gone = np.zeros(len(lines), bool)
                        for c in compared:
                            a, b = c["line"], c["line"] + c["n"]
                            if "\n".join(lines[a:b]) == c["first_text"]:
                                gone[a:b] = True
                        n_removed.append(int(gone.sum()))
                        t = "\n".join(line for line, away in zip(lines, gone) if not away)
                    else:
                        n_removed.append(0)
                    texts.append(t)
                fields = [doc.field(i) for i in range(doc.type.num_fields)]
                fields[place] = pa.array(texts, fields[place].type)
                again = pa.StructArray.from_arrays(fields, fields=[doc.type.field(i) for i in range(len(fields))])
                yield pa.RecordBatch.from_arrays(
                    [again, pa.array(np.array(n_lines, np.int64)), pa.array(np.array(n_removed, np.int64))],
                    names=["doc", "n_lines", "n_removed"])

    joined = whole.join(compare, ["key", "tag"], "left").select("doc", "compare")
    schema = T.StructType([T.StructField("doc", whole.schema["doc"].dataType), T.StructField("n_lines", T.LongType()),
                           T.StructField("n_removed", T.LongType())])
    return joined.mapInArrow(cut, schema)
