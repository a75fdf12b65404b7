"""Near-duplicate documents by ProbMinHash.

A document is its word shingles, each weighted by how often it occurs. Every
shingle emits a Poisson process of arrivals whose rate is its weight, and each
arrival falls on a random register; a register keeps the shingle that arrived
first. Two documents agree on a register with their probability Jaccard
similarity. A shingle stops as soon as its next arrival is later than every
register's first, so the work is about (shingles + registers * log registers).

Registers are cut into bands; documents that agree on a whole band share a
bucket, and pairs are verified on their texts by the exact probability Jaccard
similarity. Documents with the same words are one class from the start. In a
bucket every class is first compared with the least one only (a star, as many
pairs as members); links are joined into components, and only buckets that then
still hold several components go on: there, classes of different components are
compared with each other inside tasks, from their shingle hashes, and only the
links that join two components leave the task. Pairs inside one component need
no comparison, as they can't change the result. Buckets of any size are cut into
blocks, every block against every other.

Defined cases: words are runs of letters and digits, lower-cased; a text of
fewer words than a shingle is one shingle; a text without words (null, empty)
is a class of its own; rows that repeat a doc_id with one text are alike,
and with different texts each text has its own class: ``keep_one`` keeps or drops
each row by the class of its text, the report names one class for a doc_id (of
the text whose word digest is least); a null doc_id keeps its row, without a class;
texts of any length are read whole; an empty table gives an empty result; rows
travel as one column, so their names may be any.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from slatecast.llm.common import join_hot, quoted, runs, store
from slatecast.llm.components import components

WORDS, SIMILARITY, BANDS, ROWS = 5, 0.8, 40, 8
#: Members of a star in one task; classes, and shingles of theirs, in one block.
STAR_ROWS, BLOCK, BLOCK_SHINGLES = 2000, 2048, 4_000_000
_WORD = re.compile(r"\w+")
_K = [np.uint64(x) for x in (0x9E3779B97F4A7C15, 0xBF58476D1CE4E5B9, 0x94D049BB133111EB)]
_MULT = [np.uint64(x) for x in (0xD6E8FEB86659FD93, 0xA0761D6478BD642F, 0xE7037ED1A0B428DB, 0x8EBC6AF09C88C6E3,
                                0x589965CC75374CC3, 0x1D8E4E27C47D124F, 0xEB44ACCAB455D165, 0x9C6E6877736C46E3)]


def words(text: str | None) -> list[str]:
    return _WORD.findall(text.lower()) if text else []


class WordHashes(dict):
    """64-bit hashes of words, the common ones remembered."""

    def __missing__(self, word: str) -> int:
        if len(self) > 500_000:
            self.clear()
        self[word] = value = xxhash.xxh64_intdigest(word.encode("utf-8", "surrogatepass"))
        return value


def _mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * _K[1]
    x = (x ^ (x >> np.uint64(27))) * _K[2]
    return x ^ (x >> np.uint64(31))


def shingles(found: list[str], hashes: WordHashes, size: int = WORDS) -> tuple[np.ndarray, np.ndarray]:
    """Distinct shingle hashes of a word list and their counts."""
    if not found:
        return np.empty(0, np.uint64), np.empty(0, np.int64)
    h = np.fromiter(map(hashes.__getitem__, found), np.uint64, len(found))
    n = max(1, len(h) - size + 1)
    joined = np.zeros(n, np.uint64)
    for k in range(min(size, len(h))):
        joined = (joined ^ h[k:k + n]) * _MULT[k % len(_MULT)]
        joined ^= joined >> np.uint64(29)
    return np.unique(_mixed(joined), return_counts=True)


def signature(elements: np.ndarray, weights: np.ndarray, registers: int) -> np.ndarray:
    """The first-arriving element of each register (ProbMinHash with early termination)."""
    first = np.full(registers, np.inf)
    holder = np.zeros(registers, np.uint64)
    active, rate = elements, weights.astype(np.float64)
    clock, turn = np.zeros(len(active)), 0
    latest = np.inf
    while len(active):
        # arrivals in blocks: about four a register in all at first, then few
        block = max(1, min(4096, (4 * registers) // len(active) + 1)) if latest == np.inf else \
            max(1, min(64, registers // len(active) + 1))
        steps = np.arange(turn + 1, turn + block + 1, dtype=np.uint64)
        draw = _mixed(active[:, None] + steps[None, :] * _K[0])
        gaps = -np.log(((draw >> np.uint64(11)).astype(np.float64) + 0.5) * 2.0 ** -53) / rate[:, None]
        times = clock[:, None] + np.cumsum(gaps, axis=1)
        where = (_mixed(draw ^ _K[1]) % np.uint64(registers)).astype(np.int64)
        use = times < latest
        t, r = times[use], where[use]
        np.minimum.at(first, r, t)
        won = t == first[r]
        holder[r[won]] = np.broadcast_to(active[:, None], times.shape)[use][won]
        latest = first.max()
        clock = times[:, -1]
        turn += block
        going = clock < latest
        active, rate, clock = active[going], rate[going], clock[going]
    return holder


def band_keys(text_words: list[str], hashes: WordHashes, bands: int, rows: int, size: int) -> np.ndarray:
    elements, counts = shingles(text_words, hashes, size)
    held = signature(elements, counts, bands * rows).reshape(bands, rows)
    keys = np.arange(1, bands + 1, dtype=np.uint64) * _K[0]
    for k in range(rows):
        keys = _mixed(keys ^ held[:, k]) * _MULT[k % len(_MULT)]
    return keys.view(np.int64)


def similarity(a: Counter, b: Counter) -> float:
    """Exact probability Jaccard similarity of two weighted sets.

    The sum over common d of 1 / sum over e of max(a_e / a_d, b_e / b_d). With
    common elements in order of a_d / b_d the inner sums are running sums.
    """
    if not a or not b:
        return 0.0
    both = [k for k in a if k in b]
    if not both:
        return 0.0
    x = np.array([a[k] for k in both], np.float64)
    y = np.array([b[k] for k in both], np.float64)
    only_a = float(sum(a.values()) - x.sum())
    only_b = float(sum(b.values()) - y.sum())
    ratio = x / y
    order = np.argsort(ratio, kind="stable")
    x, y, ratio = x[order], y[order], ratio[order]
    # e with x_e / x_d > y_e / y_d is e with a greater ratio
    first = np.searchsorted(ratio, ratio, side="right")
    tail_x = np.concatenate([np.cumsum(x[::-1])[::-1], [0.0]])
    head_y = np.concatenate([[0.0], np.cumsum(y)])
    whole = (tail_x[first] + only_a) / x + (head_y[first] + only_b) / y
    return float((1.0 / whole).sum())


def weighted(found: list[str], size: int = WORDS) -> Counter:
    if len(found) < size:
        return Counter([tuple(found)]) if found else Counter()
    return Counter(zip(*(found[k:] for k in range(size))))


def _verified(stars: DataFrame, texts: DataFrame, classes: DataFrame, least: float, size: int) -> DataFrame:
    """Pairs (a, b) of ``stars`` whose texts are similar enough; texts are (id, tag, text).

    A star's members go to parts of at most STAR_ROWS, each of which gets the
    centre's text once, ahead of them; so a task holds one centre and passes
    the members one by one.
    """
    sizes = stars.groupBy("a").agg(F.ceil(F.count("*") / STAR_ROWS).cast("int").alias("parts"))
    sizes = store(sizes, "star-sizes")
    place = classes.select(F.col("node"), "id", "tag")
    # merge joins at every size: both use one exchange of the texts
    read = texts.hint("merge")
    members = stars.join(sizes, "a").join(place.withColumnRenamed("node", "b"), "b").select(
        "a", F.pmod(F.xxhash64("b"), F.col("parts")).cast("int").alias("part"), "b", "id", "tag")
    members = read.join(members, ["id", "tag"]).select("a", "part", "b", "text")
    centres = read.join(sizes.join(place.withColumnRenamed("node", "a"), "a"), ["id", "tag"]).select(
        "a", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)).alias("part"), F.lit(-1).cast("long").alias("b"), "text")
    cells = members.unionByName(centres).repartition("a", "part").sortWithinPartitions("a", "part", "b")

    def check(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        centre: Counter = Counter()
        for whole in parts:
            for at in range(0, whole.num_rows, 500):
                part = whole.slice(at, 500)
                found = []
                for a, b, text in zip(*(part.column(k).to_pylist() for k in (0, 2, 3))):
                    mine = weighted(words(text), size)
                    if b < 0:
                        centre = mine
                    elif similarity(centre, mine) >= least:
                        found.append((a, b))
                yield pa.RecordBatch.from_arrays([pa.array([f[k] for f in found], pa.int64()) for k in range(2)],
                                                 names=["a", "b"])

    return cells.mapInArrow(check, "a long, b long")


def _close(i: int, j: np.ndarray, sets: list, totals: np.ndarray, mark: np.ndarray, least: float) -> np.ndarray:
    """Which of the sets ``j`` have similarity ``least`` or more with set ``i``.

    A common element adds at most min(a / sum of a, b / sum of b) to the exact
    similarity, which bounds it; sets without repeats need no more than counts.
    """
    own, own_n = sets[i]
    mark[own] = own_n
    lengths = np.array([len(sets[k][0]) for k in j])
    flat, flat_n = np.concatenate([sets[k][0] for k in j]), np.concatenate([sets[k][1] for k in j])
    starts = np.concatenate([[0], np.cumsum(lengths)[:-1]])
    a = mark[flat]
    common_a = np.add.reduceat(a, starts)
    common_b = np.add.reduceat(np.where(a > 0, flat_n, 0), starts)
    mark[own] = 0
    near = np.minimum(common_a / totals[i], common_b / totals[j]) >= least - 1e-12
    plain = (totals[i] == len(own)) & (totals[j] == lengths)
    exact = common_a / (totals[i] + totals[j] - common_a) >= least
    out = near & plain & exact
    mine = dict(zip(own.tolist(), own_n.tolist()))
    for k in np.flatnonzero(near & ~plain):
        out[k] = similarity(mine, dict(zip(sets[j[k]][0].tolist(), sets[j[k]][1].tolist()))) >= least
    return out


def _joining_links(table: pa.Table, least: float) -> list[tuple[int, int]]:
    """Links between the roots of different components of one block pair, no more than join them."""
    roots = table.column("root").to_numpy()
    inside = table.column("s")[0].as_py() == table.column("v")[0].as_py()
    here = table.column("block").to_numpy() == table.column("s")[0].as_py()
    label = np.unique(roots, return_inverse=True)[1]
    if not label.any():
        return []
    hashes = [np.frombuffer(x, np.uint64) for x in table.column("shingles").to_pylist()]
    counts = [np.frombuffer(x, np.int32) for x in table.column("counts").to_pylist()]
    names, flat = np.unique(np.concatenate(hashes), return_inverse=True)
    sets = list(zip(np.split(flat, np.cumsum([len(h) for h in hashes])[:-1]), counts))
    totals = np.array([float(c.sum()) for c in counts])
    sizes = np.array([len(c) for c in counts])
    mark, found = np.zeros(len(names)), []
    for i in range(len(roots)):
        if not inside and not here[i]:
            continue
        others = np.arange(len(roots)) > i if inside else ~here
        j = np.flatnonzero(others & (label != label[i]) & (np.minimum(sizes, sizes[i]) > 0))
        for at in range(0, len(j), 512):
            part = j[at:at + 512]
            for k in part[_close(i, part, sets, totals, mark, least)]:
                if label[k] != label[i]:
                    found.append((int(roots[i]), int(roots[k])))
                    label[label == label[k]] = label[i]
    return found


def open_bucket_links(apart: DataFrame, texts: DataFrame, classes: DataFrame, least: float, size: int,
                      block: int = BLOCK) -> DataFrame:
    """Links (a, b) between roots of components that share a bucket; ``apart`` is (key, id, root), its ids are nodes.

    A bucket is cut into blocks by its classes and by their shingles, whichever needs more.
    """
    def sets(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashes = WordHashes()
        for whole in parts:
            for at in range(0, whole.num_rows, 500):
                part = whole.slice(at, 500)
                found = [shingles(words(t), hashes, size) for t in part.column(1).to_pylist()]
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), pa.array([e.tobytes() for e, _ in found], pa.binary()),
                     pa.array([c.astype(np.int32).tobytes() for _, c in found], pa.binary())],
                    names=["id", "shingles", "counts"])

    wanted = apart.select(F.col("id").alias("node")).distinct().join(classes.select("node", "id", "tag"), "node")
    details = store(texts.hint("merge").join(wanted, ["id", "tag"]).select("node", "text").mapInArrow(
        sets, "id long, shingles binary, counts binary").dropDuplicates(["id"]), "shingle-sets")
    weights = details.select("id", (F.octet_length("shingles") / 8).alias("size"))
    blocks = F.greatest(F.ceil(F.count("*") / block), F.ceil(F.sum("size") / BLOCK_SHINGLES), F.lit(1)).cast("int")
    cut = store(apart.join(weights, "id").groupBy("key").agg(blocks.alias("blocks")), "bucket-blocks")
    placed = apart.join(cut, "key").withColumn("block", F.pmod(F.xxhash64("id"), F.col("blocks")).cast("int"))
    spots = F.expr("transform(sequence(0, blocks - 1), j -> struct(least(block, j) as s, greatest(block, j) as v))")
    placed = placed.select("key", "id", "root", "block", F.explode(spots).alias("spot"))
    placed = placed.select("key", "spot.s", "spot.v", "id", "root", "block").join(details, "id")
    placed = placed.select("key", "s", "v", "id", "root", "block", "shingles", "counts") \
        .repartition("key", "s", "v").sortWithinPartitions("key", "s", "v", "id")

    def linked(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for group in runs(parts, 3):
            found = _joining_links(group, least) if group.num_rows > 1 else []
            if found:
                yield pa.RecordBatch.from_arrays([pa.array([f[0] for f in found]), pa.array([f[1] for f in found])],
                                                 names=["a", "b"])

    return placed.mapInArrow(linked, "a long, b long")


def _labelled(docs: DataFrame, least: float, bands: int, rows: int, size: int, text: str,
              doc_id: str) -> tuple[DataFrame, DataFrame]:
    """Every row as (id, tag, digest), and (digest, class_id) of every class of words; class_id is its group's least id."""
    body = docs[text].cast("string")
    source = docs.filter(docs[doc_id].isNotNull()).select(
        docs[doc_id].cast("long").alias("id"), F.xxhash64(body).alias("tag"), body.alias("text"))

    def banded(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashes = WordHashes()
        for whole in parts:
            for at in range(0, whole.num_rows, 500):
                part = whole.slice(at, 500)
                digests, keys = [], []
                for t in part.column(2).to_pylist():
                    found = words(t)
                    digests.append(xxhash.xxh3_128_hexdigest(" ".join(found).encode("utf-8", "surrogatepass"))
                                   if found else None)
                    keys.append(band_keys(found, hashes, bands, rows, size) if found else None)
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), part.column(1), pa.array(digests, pa.string()),
                     pa.array(keys, pa.list_(pa.int64()))], names=["id", "tag", "digest", "keys"])

    # one pass over the texts, which stay where they are
    digested = store(source.mapInArrow(banded, "id long, tag long, digest string, keys array<long>"), "document-bands")
    classes = digested.filter("digest is not null").groupBy("digest").agg(
        F.min(F.struct("id", "tag")).alias("least"), F.count("*").alias("n"))
    # a class is a node of its own, as one doc_id may be the least of several classes
    classes = store(classes.select("digest", "least.id", "least.tag", "n",
                                   F.monotonically_increasing_id().alias("node")), "word-classes")
    members = digested.join(classes, ["id", "tag", "digest"]).select(
        F.col("node").alias("id"), F.explode("keys").alias("key"))
    members = store(members, "bands")
    buckets = members.groupBy("key").agg(F.min("id").alias("a"), F.count("*").alias("n")).filter("n > 1")
    buckets = store(buckets, "buckets")
    shared = store(members.join(buckets, "key").select("key", "a", "id"), "bucket-members")
    stars = shared.filter("id <> a").select("a", F.col("id").alias("b")).distinct()
    stars = store(stars, "candidates")
    links = store(_verified(stars, source, classes, least, size), "document-links")
    roots = components(links)

    # what stars left apart: classes of different components that share a bucket
    named = shared.select("key", "id").join(roots.withColumnRenamed("node", "id"), "id", "left").select(
        "key", "id", F.coalesce("root", "id").alias("root"))
    open_keys = named.groupBy("key").agg(F.min("root").alias("lo"), F.max("root").alias("hi"),
                                         F.count("*").alias("n")).filter("lo < hi")
    apart = store(named.join(open_keys.select("key"), "key"), "open-buckets")
    more = store(open_bucket_links(apart, source, classes, least, size), "document-links")
    # roots that a second link joins, and the least id of each whole component
    over = components(more).select(F.col("node").alias("root"), F.col("root").alias("over"))
    everything = store(classes.join(roots, "node", "left").select(
        "digest", "id", "n", F.coalesce("root", "node").alias("root")), "class-roots")
    each = everything.groupBy("root").agg(F.min("id").alias("least"), F.count("*").alias("n"))
    each = store(each.join(over, "root", "left").withColumn("over", F.coalesce("over", "root")), "components")
    whole = each.groupBy("over").agg(F.min("least").alias("class_id"))
    named = store(each.join(whole, "over").select("root", "class_id", "n"), "component-names")
    label = join_hot(everything.withColumnRenamed("n", "rows"), named, ["root"], ["digest"])
    label = store(label.select("digest", F.col("rows").alias("n"), "class_id"), "class-labels")
    return digested.select("id", "tag", "digest"), label


def near_duplicates(docs: DataFrame, least: float = SIMILARITY, bands: int = BANDS, rows: int = ROWS,
                    size: int = WORDS, text: str = "text", doc_id: str = "doc_id") -> DataFrame:
    """(doc_id, class_id) for every distinct doc_id; class_id is the least doc_id of its group."""
    digested, label = _labelled(docs, least, bands, rows, size, text, doc_id)
    of_words = digested.groupBy("id").agg(F.min("digest").alias("digest"))
    return join_hot(of_words, label, ["digest"], ["id"], "left").select(
        F.col("id").alias("doc_id"), F.coalesce("class_id", "id").alias("class_id"))


def keep_one(docs: DataFrame, least: float = SIMILARITY, bands: int = BANDS, rows: int = ROWS, size: int = WORDS,
             text: str = "text", doc_id: str = "doc_id") -> DataFrame:
    """Rows of ``docs`` whose doc_id is the least of their text's group (rows without a doc_id or words stay)."""
    digested, label = _labelled(docs, least, bands, rows, size, text, doc_id)
    gone = join_hot(digested, label, ["digest"], ["id", "tag"]).filter("id <> class_id").select("id", "tag")
    # whole rows travel as one column, so that no name of theirs can clash
    whole = docs.select(F.struct(*[docs[quoted(c)].alias(c) for c in docs.columns]).alias("doc"),
                        docs[doc_id].cast("long").alias("id"), F.xxhash64(docs[text].cast("string")).alias("tag"))
    return whole.hint("merge").join(gone, ["id", "tag"], "left_anti").select("doc.*")
