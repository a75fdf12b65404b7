"""Token counts from flat token files: a separator scan.

A flat file holds little-endian 16-bit token ids of many documents, each ended
by an end-of-document id, and no index. Files are cut into blocks of equal
size; tasks read blocks by offset and find the ids with one vector comparison.
A document may begin in an earlier block: a prefix scan over the few summary
values of a file's blocks (last separator so far, separators so far) gives each
block the place where its first document began and the number it has.

Defined cases: a document without tokens counts 0; ids after the last separator
are a document too; an empty file has none; a file of odd length is refused. A
null text is written as an empty document; rows that repeat a doc_id are counted
each; a null doc_id is kept; texts of any length are encoded whole; an empty
table gives an empty result. Other columns are not read, whatever their names.
"""

from __future__ import annotations

import base64
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyarrow import fs
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from slatecast.llm.common import store
from slatecast.session import scratch_path

BLOCK_TOKENS = 1 << 20
WIDTH = 2
#: Fixed value: the pattern that goes with the byte-level vocabularies.
PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"


def tokenizer(ranks_path: str):
    import tiktoken

    with open(ranks_path, "rb") as f:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
    return tiktoken.Encoding("documents", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={})


#: Fixed value: what the pattern takes for blank; runs of this many overflow its engine's stack.
BLANKS = re.compile("[\t-\r \x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000]{5000,}")


def encode(coder, text: str) -> list[int]:
    """Token ids; long runs of blanks are cut out where the pattern has a border anyway.

    Of a run before other text the pattern takes all but the last blank as one
    piece, of a run at the end all of it.
    """
    out, at = [], 0
    for run in BLANKS.finditer(text):
        end = run.end() - (run.end() < len(text))
        out += coder.encode_ordinary(text[at:run.start()])
        out += coder._encode_single_piece(text[run.start():end])
        at = end
    return out + coder.encode_ordinary(text[at:])


def write_token_files(docs: DataFrame, ranks_path: str, separator: int, text: str = "text",
                      doc_id: str = "doc_id") -> tuple[DataFrame, DataFrame]:
    """Tokenise ``docs`` into flat files in the shared folder.

    Returns (files, places): files (file, tokens) and the place of each
    document, (file, ordinal, doc_id). A file belongs to one attempt of one
    task; files of lost attempts are in neither table.
    """
    folder = scratch_path(docs.sparkSession, "tokens")
    schema = f"file string, ordinal long, doc_id {docs.schema[doc_id].dataType.simpleString()}, tokens long"

    def run(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder = tokenizer(ranks_path)
        context = TaskContext.get()
        system, root = fs.FileSystem.from_uri(folder) if "://" in folder or folder.startswith("file:") \
            else (fs.LocalFileSystem(), folder)
        system.create_dir(root, recursive=True)
        name = f"{root}/{context.partitionId():06d}-{context.taskAttemptId()}.bin"
        ordinal, end = 0, np.array([separator], "<u2").tobytes()
        with system.open_output_stream(name) as out:
            for part in parts:
                counts = []
                for t in part.column(1).to_pylist():
                    ids = np.array(encode(coder, t) if t else [], "<u2")
                    out.write(ids.tobytes() + end)
                    counts.append(len(ids) + 1)
                n = part.num_rows
                yield pa.RecordBatch.from_arrays(
                    [pa.array([name] * n, pa.string()), pa.array(np.arange(ordinal, ordinal + n)), part.column(0),
                     pa.array(counts, pa.int64())], names=["file", "ordinal", "doc_id", "tokens"])
                ordinal += n

    rows = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).cast("string").alias("text")).mapInArrow(run, schema)
    # written once: running it again would write other files
    places = store(rows, "token-places")
    return places.groupBy("file").agg(F.sum("tokens").alias("tokens")), places.drop("tokens")


def count_tokens(files: DataFrame, folder_uri: str, separator: int, block: int = BLOCK_TOKENS) -> DataFrame:
    """(file, ordinal, start, n_tokens) of every document of ``files`` (file, tokens).

    ``folder_uri`` only names the file system that the paths belong to.
    """
    blocks = files.select("file", F.col("tokens"), F.explode(F.expr(
        f"sequence(0L, greatest(0L, ceil(tokens / {block}) - 1))")).alias("block"))
    blocks = blocks.filter("tokens > 0").repartition("file", "block")

    def run(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        system = fs.FileSystem.from_uri(folder_uri)[0] if "://" in folder_uri or folder_uri.startswith("file:") \
            else fs.LocalFileSystem()
        for part in parts:
            for name, tokens, number in zip(*(c.to_pylist() for c in part.columns)):
                first = number * block
                size = min(block, tokens - first)
                with system.open_input_file(name) as f:
                    data = f.read_at(size * WIDTH, first * WIDTH)
                if len(data) != size * WIDTH:
                    raise ValueError(f"{name} is shorter than its {tokens} tokens")
                ends = np.flatnonzero(np.frombuffer(data, "<u2") == separator) + first
                yield pa.RecordBatch.from_arrays(
                    [pa.array([name]), pa.array([number]), pa.array([tokens]),
                     pa.array([ends.tolist()], pa.list_(pa.int64()))], names=["file", "block", "tokens", "ends"])

    # the lists stay with their blocks; only counts and last places are scanned
    found = store(blocks.select("file", "tokens", "block").mapInArrow(
        run, "file string, block long, tokens long, ends array<long>"), "separators")
    before = W.partitionBy("file").orderBy("block").rowsBetween(W.unboundedPreceding, -1)
    last = F.when(F.size("ends") > 0, F.element_at("ends", -1))
    brief = found.select("file", "block", F.size("ends").alias("n"), last.alias("last"))
    scanned = brief.select(
        "file", "block", F.coalesce(F.max("last").over(before), F.lit(-1)).alias("before"),
        F.coalesce(F.sum("n").over(before), F.lit(0)).alias("done"),
        F.lead("block").over(W.partitionBy("file").orderBy("block")).isNull().alias("final"))
    stitched = found.join(scanned, ["file", "block"])
    tail = F.greatest("before", F.coalesce(last, F.lit(-1)))
    stitched = stitched.withColumn("ends", F.when(
        F.col("final") & (tail < F.col("tokens") - 1), F.concat("ends", F.array("tokens"))).otherwise(F.col("ends")))
    each = stitched.select("file", "done", "before", "ends", F.posexplode("ends").alias("k", "end"))
    start = F.when(F.col("k") == 0, F.col("before")).otherwise(F.expr("ends[k - 1]")) + 1
    return each.select("file", (F.col("done") + F.col("k")).alias("ordinal"), start.alias("start"),
                       (F.col("end") - start).alias("n_tokens"))


def document_token_counts(spark: SparkSession, docs: DataFrame, ranks_path: str, separator: int,
                          block: int = BLOCK_TOKENS, **columns: str) -> DataFrame:
    """(doc_id, n_tokens): documents written as flat files, which are then scanned."""
    files, places = write_token_files(docs, ranks_path, separator, **columns)
    counts = count_tokens(files, scratch_path(spark, "tokens"), separator, block)
    # both sides have a row per document: never broadcast
    return counts.join(places.hint("merge"), ["file", "ordinal"]).select("doc_id", "n_tokens")
