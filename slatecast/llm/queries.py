"""The registered corpus queries and their DuckDB twins."""

from __future__ import annotations

import os

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from slatecast.llm import (
    adaptive_scan,
    langid,
    lattice,
    licenses,
    line_chunks,
    merkle,
    mixing,
    probminhash,
    repair,
    separators,
    topk,
    toxicity,
    wfst,
)
from slatecast.llm.common import table

#: Folder of the public vocabularies on every worker.
TOKENIZERS = os.environ.get("SLATECAST_TOKENIZERS", "/opt/tokenizers")
#: Fixed value: the id after the last rank of the byte-level vocabulary.
END_OF_DOCUMENT = 50256


def op1_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document without the line chunks that an earlier one has."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return line_chunks.dedup_lines(docs).select("doc.doc_id", "doc.text", "n_lines", "n_removed")


def op2_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Toxicity of every document, learned from the rows that aren't held out."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    held_out = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 3 == 1
    learn = table(spark, sf_dir, "labels").filter(~held_out)
    scored = toxicity.score(docs, toxicity.fit(docs, learn))
    return scored.select("doc_id", F.coalesce(held_out, F.lit(False)).alias("held_out"), "score",
                         (F.col("score") >= 0.7).cast("int").alias("predicted"))


def op3_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The 20 best rows for every vector whose id 20 divides."""
    return topk.top_k(table(spark, sf_dir, "embeddings"))


def op4_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Base phrases and template labels of every document."""
    return licenses.license_report(licenses.scan_licenses(table(spark, sf_dir, "documents")))


def op5_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Language of every document and every page.

    A document declares ``lang`` and has its source for a host; a page declares
    the language of its markup and has the host and suffix of its address.
    """
    docs, pages = table(spark, sf_dir, "documents"), table(spark, sf_dir, "pages")
    nothing = F.lit(None).cast("long")
    host = langid.url_host(F.col("url"))
    rows = docs.select("doc_id", nothing.alias("page_id"), "text", F.col("lang").alias("declared"),
                       F.concat(F.lit("source:"), "source").alias("host"), F.lit("source").alias("suffix"))
    rows = rows.unionByName(pages.select(
        nothing.alias("doc_id"), "page_id", langid.page_text(F.col("html")).alias("text"),
        langid.page_language(F.col("html")).alias("declared"), host.alias("host"),
        langid.host_suffix(host).alias("suffix")))
    found = langid.identify(rows, langid.fit(docs), rows["text"], rows["declared"], rows["host"], rows["suffix"],
                            keep=["doc_id", "page_id"])
    return found.select("doc.doc_id", "doc.page_id", "lang", "confidence", "accepted")


def op6_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What the mix takes of every document, in training order."""
    plan = mixing.curriculum(table(spark, sf_dir, "documents"), keep=["doc_id"])
    rows = plan.select("doc.doc_id", "size", "source_size", "target", "taken", "position", "again")
    return rows.orderBy(F.col("position").asc_nulls_last(), "doc_id")


def op7_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The near-duplicate group of every document; its least doc_id is kept."""
    found = probminhash.near_duplicates(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return found.withColumn("kept", F.col("doc_id") == F.col("class_id"))


def op8_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Tokens of every document, counted in flat token files."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return separators.document_token_counts(spark, docs, f"{TOKENIZERS}/byte_bpe_50k.tiktoken", END_OF_DOCUMENT)


def op9_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Piece ids of every document and whether decoding restores the text."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return wfst.encode_documents(docs, f"{TOKENIZERS}/piece_bpe_32k.model")


def op10_embedding_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Links and components of all vectors at cosine 0.9."""
    return lattice.embedding_groups(table(spark, sf_dir, "embeddings"))


def op11_conversation_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Faults and cheapest repair of every conversation after damage, with its audit."""
    return repair.audit_conversations(table(spark, sf_dir, "conversations"))


def op12_merkle_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Leaf, subroot, root and proof of every document, checked after tampering."""
    return merkle.manifest(table(spark, sf_dir, "documents"))


def op13_nearest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The 20 nearest rows found for every vector whose id 20 divides."""
    return adaptive_scan.nearest(table(spark, sf_dir, "embeddings"))


QUERIES = {
    "op1_line_dedup": op1_line_dedup,
    "op2_toxicity": op2_toxicity,
    "op3_topk": op3_topk,
    "op4_license_scan": op4_license_scan,
    "op5_language_id": op5_language_id,
    "op6_mixing": op6_mixing,
    "op7_near_dedup": op7_near_dedup,
    "op8_token_counts": op8_token_counts,
    "op9_sentencepiece": op9_sentencepiece,
    "op10_embedding_dedup": op10_embedding_dedup,
    "op11_conversation_repair": op11_conversation_repair,
    "op12_merkle_manifest": op12_merkle_manifest,
    "op13_nearest": op13_nearest,
}

MIXING_SQL = r"""
with recursive d as (
  select doc_id, coalesce(source, '') as src, source is null as unnamed,
         coalesce(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0)::bigint as size,
         ('0x' || substr(md5(coalesce(doc_id::varchar, '')), 1, 15))::bigint as ord
  from documents),
s as (
  select src, unnamed, sum(size)::bigint as source_size,
         row_number() over (order by unnamed, src) - 1 as place
  from d group by src, unnamed),
w as (select *, [3.0, 1.0, 2.0][place % 3 + 1]::double as weight, 2.0::double * source_size as most from s),
-- resharing by hand: cap what is above its cap, share the rest again, until nothing is above
turns as (
  select 0 as turn, src, unnamed, source_size, place, weight, most, false as capped,
         (select sum(source_size) from w) * 1.5::double as pool
  from w
  union all
  select turn + 1, src, unnamed, source_size, place, weight, most,
         capped or pool_left / open_weight > most / weight, pool
  from (select *, pool - coalesce(sum(most) filter (capped) over (), 0) as pool_left,
               sum(weight) filter (not capped) over () as open_weight from turns)
  where turn < (select count(*) from w) and open_weight is not null),
shared as (
  select *, (pool - coalesce(sum(most) filter (capped) over (), 0))
            / sum(weight) filter (not capped) over () as level
  from turns where turn = (select max(turn) from turns)),
t as (
  select src, unnamed, source_size, place,
         case when capped then most else least(most, level * weight) end as target
  from shared),
p as (
  select d.*, t.source_size, t.place, t.target, floor(t.target + 0.5)::bigint as quota,
         (coalesce(sum(size) over (partition by src, unnamed order by ord, doc_id, size
                   rows between unbounded preceding and 1 preceding), 0))::bigint as start
  from d join t using (src, unnamed)),
r as (
  select *, case when source_size > 0 then quota // source_size else 0 end as rounds from p),
k as (
  select *, (rounds * size + greatest(0, least(quota - rounds * source_size - start, size)))::bigint as taken from r),
y as (
  select *, start::double / quota as y1, (start + source_size)::double / quota as y2 from k)
select doc_id, size, source_size, target, taken,
  case when taken > 0 then case place % 3
    when 0 then 0.0::double + 2.0::double * y1 / (0.5::double + sqrt(0.25::double + 2.0::double * y1))
    when 1 then 0.0::double + 2.0::double * y1 / (1.0::double + sqrt(1.0::double + 0.0::double * y1))
    else 0.0::double + 2.0::double * y1 / (1.5::double + sqrt(2.25::double + -2.0::double * y1)) end end as position,
  case when taken > size then case place % 3
    when 0 then 0.0::double + 2.0::double * y2 / (0.5::double + sqrt(0.25::double + 2.0::double * y2))
    when 1 then 0.0::double + 2.0::double * y2 / (1.0::double + sqrt(1.0::double + 0.0::double * y2))
    else 0.0::double + 2.0::double * y2 / (1.5::double + sqrt(2.25::double + -2.0::double * y2)) end end as again
from y
"""

TOPK_SQL = """
with v as (
  select vec_id, [floor(64 * x::double) for x in embedding] as x from embeddings
  where vec_id is not null and embedding is not null
    and len([x for x in embedding if x is null or not isfinite(x)]) = 0),
s as (
  select q.vec_id as query_id, c.vec_id, list_dot_product(q.x, c.x)::bigint as score
  from v q, v c where q.vec_id % 20 = 0 and c.vec_id <> q.vec_id),
r as (
  select *, row_number() over (partition by query_id order by score desc, vec_id)::int as rank from s)
select query_id, rank, vec_id, score from r where rank <= 20
"""

#: CRC-32 of an ASCII string x, bit by bit
CRC32_SQL = """xor(4294967295, list_reduce(
  list_prepend(4294967295::bigint, [ord(c)::bigint for c in string_split({x}, '')]),
  lambda crc, b: list_reduce([xor(crc, b), 0, 0, 0, 0, 0, 0, 0, 0]::bigint[],
    lambda r, z: xor(r >> 1, 3988292384 * (r & 1)))))"""


def _field(column: str) -> str:
    return f"coalesce(strlen({column}::varchar)::varchar || ':' || {column}, '-')"


MERKLE_SQL = f"""
with recursive d as (
  select *, sha256({_field('doc_id')} || {_field('source')} || {_field('lang')} || {_field('n_chars')}
                   || {_field('text')}) as leaf,
    coalesce({CRC32_SQL.format(x='doc_id::varchar')} % 2 = 0, false) as tampered
  from documents),
l as (
  select doc_id, source, leaf, row_number() over (order by source nulls first, doc_id nulls first, leaf) as row,
    row_number() over (partition by source order by doc_id nulls first, leaf) - 1 as pos,
    case when tampered then sha256({_field('doc_id')} || {_field('source')} || {_field('lang')}
      || {_field('n_chars')} || {_field("replace(text, chr(10), '')")}) else leaf end as changed
  from d),
-- every level of every source's tree
t as (
  select 0 as level, source, pos, leaf as node, count(*) over (partition by source) as n from l
  union all
  select level + 1, source, pos // 3, sha256(string_agg(node, '' order by pos)), (n + 2) // 3 from t
  where n > 1 group by level, source, pos // 3, n),
s as (select source, node as subroot, row_number() over (order by source nulls first) - 1 as place from t where n = 1),
u as (
  select 0 as level, place as pos, subroot as node, count(*) over () as n from s
  union all
  select level + 1, pos // 3, sha256(string_agg(node, '' order by pos)), (n + 2) // 3 from u
  where n > 1 group by level, pos // 3, n),
-- one list of nodes per run
runs as (select level, source, pos // 3 as run, list(node order by pos) as nodes from t where n > 1
  group by level, source, pos // 3),
top as (select level, pos // 3 as run, list(node order by pos) as nodes from u where n > 1 group by level, pos // 3),
-- up along the path: siblings gathered, tampered digests folded
p as (
  select 0 as level, row, source, pos, ''::varchar as proof, changed as folded from l
  union all
  select p.level + 1, row, p.source, pos // 3,
    proof || coalesce(array_to_string(nodes[:pos % 3], ''), '') || coalesce(array_to_string(nodes[pos % 3 + 2:], ''), ''),
    sha256(array_to_string(nodes[:pos % 3], '') || folded || array_to_string(nodes[pos % 3 + 2:], ''))
  from p join runs on runs.level = p.level and runs.source is not distinct from p.source and run = pos // 3),
inner_ as (select p.* from p join (select row, max(level) as level from p group by row) using (row, level)),
q as (
  select 0 as level, row, place as pos, proof, folded, subroot from inner_ join s
    on s.source is not distinct from inner_.source
  union all
  select q.level + 1, row, pos // 3,
    proof || array_to_string(nodes[:pos % 3], '') || array_to_string(nodes[pos % 3 + 2:], ''),
    sha256(array_to_string(nodes[:pos % 3], '') || folded || array_to_string(nodes[pos % 3 + 2:], '')), subroot
  from q join top on top.level = q.level and run = pos // 3),
outer_ as (select q.* from q join (select row, max(level) as level from q group by row) using (row, level))
select doc_id, leaf, subroot, (select node from u where n = 1) as root, sha256(proof) as proof_sha256,
  folded as folded_root, folded = (select node from u where n = 1) as verified
from l join outer_ using (row)
"""

REPAIR_SQL = rf"""
with recursive d as (
  select conv_id, turn, coalesce(role, ' ') as role, coalesce(text, ' ') as text,
    {CRC32_SQL.format(x="coalesce(conv_id::varchar, ' ') || ':' || coalesce(turn::varchar, ' ')")} % 20 as dealt
  from conversations),
r as (
  select conv_id, turn, case when dealt = 4 then 'user' else role end as role,
    case dealt when 1 then '' when 2 then regexp_replace(text, '[.!?]', '', 'g') else text end as text
  from d, unnest(case when dealt = 3 then [0, 1] else [0] end) where dealt <> 0),
o as (select *, row_number() over (partition by conv_id order by turn nulls first, role, text) as pos from r),
f as (
  select *, left(role, 1) as initial, case
    when not regexp_matches(text, '[^\x20\x09-\x0D]') then 'blank'
    when row_number() over (partition by conv_id, role, text order by pos) > 1 then 'duplicate'
    when not regexp_matches(text, '[.!?][\x20\x09-\x0D]*$') then 'truncated' else 'sound' end as fault,
    lag(left(role, 1)) over (partition by conv_id order by pos) || left(role, 1) as pair
  from o),
-- states: 0 nothing yet, 1 after system, 2 after user, 3 after assistant
hop(state, mid, audit, lines) as (values
  (0, 0, '', []::varchar[]), (1, 1, '', []), (2, 2, '', []), (3, 3, '', []),
  (0, 2, 'I', ['user:']), (1, 2, 'I', ['user:']), (3, 2, 'I', ['user:']), (2, 3, 'I', ['assistant:']),
  (0, 3, 'II', ['user:', 'assistant:']), (1, 3, 'II', ['user:', 'assistant:'])),
take(mid, initial, role, state) as (values
  (0, 's', null, 1), (0, 'u', 'user', 2), (1, 'u', 'user', 2), (3, 'u', 'user', 2), (2, 'a', 'assistant', 3)),
step as (
  select b.conv_id, b.pos, hop.state as before, take.state, case when initial = take_initial then 'K' else 'R' end as edit,
    hop.audit, hop.lines, case when initial = take_initial then 0 else 1 end + case fault when 'truncated' then 5 else 0 end
      + 5 * length(hop.audit) as cost,
    case when initial = take_initial then b.role else take.role end || ':' || text as line
  from f b, hop, (select mid, initial as take_initial, role, state from take) take
  where hop.mid = take.mid and fault in ('sound', 'truncated') and (initial = take_initial or take.role is not null)
  union all
  select b.conv_id, b.pos, hop.state, hop.mid, 'D', hop.audit, hop.lines, 2 + 5 * length(hop.audit), null
  from f b, hop),
best as (
  select conv_id, 0::bigint as pos, 0 as state, {{'cost': 0::bigint, 'audit': '', 'lines': []::varchar[]}} as b
  from (select distinct conv_id from f)
  union all
  select best.conv_id, best.pos + 1, step.state, min({{
    'cost': (b.cost + step.cost)::bigint, 'audit': b.audit || step.audit || step.edit,
    'lines': list_concat(b.lines, step.lines, case when line is null then [] else [line] end)}})
  from best join step on step.conv_id is not distinct from best.conv_id and step.pos = best.pos + 1
    and step.before = best.state
  group by best.conv_id, best.pos, step.state),
ended as (
  select best.conv_id, min({{'cost': b.cost + 5 * length(hop.audit), 'audit': b.audit || hop.audit,
    'lines': list_concat(b.lines, hop.lines)}}) as b
  from best join (select conv_id, max(pos) as pos from f group by conv_id) last
    on last.conv_id is not distinct from best.conv_id and last.pos = best.pos
  join hop on hop.state = best.state and hop.mid in (0, 3) group by best.conv_id),
counts as (
  select conv_id, coalesce(max(turn) - min(turn) + 1 - count(distinct turn), 0) as gaps,
    count(*) filter (fault = 'blank') as blank, count(*) filter (fault = 'duplicate') as duplicate,
    count(*) filter (fault = 'truncated') as truncated, count(*) filter (pair not in ('su', 'ua', 'au')) as illegal
  from f group by conv_id)
select i.conv_id, coalesce(gaps, 0)::bigint as gaps, coalesce(blank, 0)::bigint as blank,
  coalesce(duplicate, 0)::bigint as duplicate, coalesce(truncated, 0)::bigint as truncated,
  coalesce(illegal, 0)::bigint as illegal, coalesce(b.cost, 0)::bigint as cost, coalesce(b.audit, '') as audit,
  sha256(coalesce(array_to_string(b.lines, chr(10)), '')) as repaired_sha256
from (select distinct conv_id from conversations) i
left join counts c on c.conv_id is not distinct from i.conv_id
left join ended e on e.conv_id is not distinct from i.conv_id
"""

ORACLE_SQL = {
    "op11_conversation_repair": REPAIR_SQL,
    "op12_merkle_manifest": MERKLE_SQL,
    "op3_topk": TOPK_SQL,
    "op6_mixing": MIXING_SQL,
}
