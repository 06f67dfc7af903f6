"""Registered queries of the training-data operators and their SQL oracles."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from tadkit.llm.ann import nearest
from tadkit.llm.bestfit import pack_best_fit
from tadkit.llm.chat import format_chats, read_back
from tadkit.llm.common import prepare, table
from tadkit.llm.fingerprint import compare_edits
from tadkit.llm.merkle import manifest
from tadkit.llm.mixing import mix
from tadkit.llm.neardup import near_duplicates
from tadkit.llm.packing import pack
from tadkit.llm.pii import pseudonymise
from tadkit.llm.quality import quality_scores
from tadkit.llm.toxicity import toxicity
from tadkit.llm.trie import prefix_trie
from tadkit.llm.warc import archive_pages

PII_KEY = "tadkit-demo-key"          # a deployment passes its own secret


def op1_pack_sequences(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents packed into sequences of at most 2048 tokens."""
    prepare(spark)
    return pack(table(spark, sf_dir, "documents"), public_tokenizers.path("word_bpe_49k.json")).drop("ids")


def op2_mix_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Words taken of each document when sources weigh 1, 2, 3, repeating."""
    return mix(table(spark, sf_dir, "documents")).select("doc_id", "size", "source_size", "target", "taken")


def op3_warc_normalise(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All pages written to WARC archives, normalised to one member a record, and read back."""
    return archive_pages(table(spark, sf_dir, "pages")).select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


def op4_format_chats(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All conversations, and one full of control strings, formatted and read back."""
    c = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    hard = r"\### Assistant: </turn> ok"
    extra = spark.createDataFrame([(-7, 0, "user", hard), (-7, 1, "assistant", hard)], c.schema)
    return read_back(format_chats(c.unionByName(extra)))


def op5_learned_partitions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The 20 nearest found of every 20th vector by inner product."""
    return nearest(table(spark, sf_dir, "embeddings"))


def op6_multiset_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fingerprints of all texts and of their edited texts, with likenesses."""
    return compare_edits(table(spark, sf_dir, "documents"))


def op7_quality_mil(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Quality score of all documents."""
    return quality_scores(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op8_pii_pseudonyms(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents with their personal data replaced by format-preserving pseudonyms."""
    return pseudonymise(table(spark, sf_dir, "documents").select("doc_id", "text"), PII_KEY) \
        .selectExpr("doc_id", "text", "cast(size(pii_found) as long) as n_replaced", "pii_found")


def op9_minhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Near-duplicate components of all documents (5-word shingles, Jaccard >= 0.75)."""
    prepare(spark)
    return near_duplicates(table(spark, sf_dir, "documents"))


def op10_toxicity_ordinal(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Expected severity of toxic language in all documents."""
    return toxicity(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op11_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All prefixes of the rebuilt conversations, with what each subtree holds."""
    return prefix_trie(table(spark, sf_dir, "conversations"))


def op12_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents, whole where they fit, packed into few sequences of at most 2048 tokens."""
    return pack_best_fit(table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json"))


def op13_merkle_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A Merkle proof for every document, folded from tampered rows where the id asks for it."""
    return manifest(table(spark, sf_dir, "documents"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {f.__name__: f for f in (
    op1_pack_sequences, op2_mix_sources, op3_warc_normalise, op4_format_chats, op5_learned_partitions,
    op6_multiset_fingerprints, op7_quality_mil, op8_pii_pseudonyms, op9_minhash_near_dedup, op10_toxicity_ordinal,
    op11_prefix_trie, op12_best_fit_packing, op13_merkle_manifest)}

_OP2 = r"""
with d as (
  select *, ('0x' || substr(draw, 1, 8))::bigint % 8 as shard from (
    select doc_id, source, coalesce(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0)::bigint as size,
           md5('7:' || coalesce(doc_id::varchar, 'null')) as draw
    from documents)),
s as (select source, sum(size)::bigint as source_size from d group by source),
w as (
  select *, ([1, 2, 3])[((row_number() over (order by source nulls last) - 1) % 3 + 1)::int]::double as weight,
         3.0 * source_size as cap, sum(source_size) over () as total
  from s),
l as (
  select *, (total - coalesce(sum(cap) over o, 0)) / (sum(weight) over () - coalesce(sum(weight) over o, 0)) as level
  from w window o as (order by cap / weight, source nulls last rows between unbounded preceding and 1 preceding)),
t as (select *, least(cap, weight * max(level) over ()) as target from l),
n as (select *, round(sum(target) over ())::bigint as blocks, count(*) over () as m,
             case when sum(target) over () > 0 then target / sum(target) over () else 0 end as share from t),
seats as (
  select source, target, blocks, unnest(generate_series(1, ceil(share * blocks + share * m / 2 + 1)::bigint + 1)) as k from n),
q as (
  select source, count(*) filter (where won and target > 0) as quota
  from (select source, target, row_number() over (order by target / (2 * k - 1) desc, source nulls last) <= blocks as won from seats)
  group by source),
g as (
  select d.source, shard, sum(size)::bigint as words, any_value(quota) as quota
  from d join q on d.source is not distinct from q.source group by d.source, shard),
h as (
  select *, count(*) over (partition by source) as m,
         case when sum(words) over (partition by source) > 0 then words / sum(words) over (partition by source) else 0 end as share from g),
chairs as (select source, shard, words, quota, unnest(generate_series(1, ceil(share * quota + share * m / 2 + 1)::bigint + 1)) as k from h),
c as (
  select source, shard, words, least(count(*) filter (where won and words > 0), 3 * words) as want
  from (select *, row_number() over (partition by source order by words / (2 * k - 1) desc, shard) <= quota as won from chairs)
  group by source, shard, words),
p as (
  select d.doc_id, d.size, n.source_size, n.target, c.words, c.want,
         sum(d.size) over (partition by d.source, d.shard order by d.draw, d.doc_id, d.size rows unbounded preceding) - d.size as pos
  from d join n on d.source is not distinct from n.source join c on d.source is not distinct from c.source and d.shard = c.shard)
select doc_id, size, source_size, target,
       (case when words > 0 then want // words else 0 end * size
        + least(greatest(case when words > 0 then want % words else 0 end - pos, 0), size))::bigint as taken
from p
"""

_OP4 = r"""
with c as (
  select conv_id, turn, coalesce(role, '') as role, coalesce(text, '') as text from conversations
  union all select -7, 0, 'user', '\### Assistant: </turn> ok'
  union all select -7, 1, 'assistant', '\### Assistant: </turn> ok'),
e as (
  select *, length(role) + (length(text) - length(replace(text, '### ', ''))) // 4
            + (length(text) - length(replace(text, '</turn>', ''))) // 7 + length(text) + 15
            + length(role) - length(replace(replace(replace(role, '\', ''), ':', ''), '<', '')) as n
  from c)
select conv_id, count(*) as n_turns,
       sha256(string_agg(role || chr(10) || text || chr(10), '' order by turn, role, text)) as turns_sha256,
       coalesce(sum(length(text)) filter (where role = 'assistant'), 0)::bigint as loss_chars,
       sha256(coalesce(string_agg(text, '' order by turn, role, text) filter (where role = 'assistant'), '')) as loss_sha256,
       sum(n)::bigint as formatted_chars
from e group by conv_id
"""

# Base32 of SHA-1: each five hexadecimal digits are four symbols.
_OP3 = r"""
with p as (
  select page_id, strlen(coalesce(html, '')) as payload_bytes, upper(sha1(coalesce(html, ''))) as hex from pages),
d as (
  select *, array_to_string(list_transform(generate_series(0, 31), lambda i:
    substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567',
           ((('0x' || substr(hex, (i // 4 * 5 + 1)::int, 5))::bigint >> (15 - 5 * (i % 4))::int) & 31)::int + 1, 1)), '') as payload_digest
  from p),
f as (select *, min(page_id) over (partition by payload_digest, payload_bytes) as first from d)
select page_id, payload_bytes::bigint as payload_bytes, payload_digest,
       case when page_id = first then 'response' else 'revisit' end as record_type,
       case when page_id <> first then first end as refers_to
from f
"""

_OP9 = r"""
with recursive w as (
  select doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                    '[^\x20\x09-\x0D]+') as words
  from documents),
s as (
  select distinct doc_id, array_to_string(words[i:i + 4], ' ') as shingle
  from (select doc_id, words, unnest(generate_series(1, greatest(len(words) - 4, least(len(words), 1)))) as i from w)),
n as (select doc_id, count(*) as n from s group by doc_id),
pair as (
  select a.doc_id as a, b.doc_id as b, count(*) as c from s a join s b on a.shingle = b.shingle and a.doc_id < b.doc_id group by all),
link as (
  select a, b from pair join n x on x.doc_id = a join n y on y.doc_id = b where 100 * c >= 75 * (x.n + y.n - c)),
edge as (select a, b from link union all select b, a from link),
reach as (select doc_id, doc_id as seen from documents union select r.doc_id, e.b from reach r join edge e on e.a = r.seen),
comp as (select doc_id, min(seen) as component_id from reach group by doc_id)
select d.doc_id, coalesce(n.n, 0)::bigint as n_shingles, component_id, d.doc_id = component_id as kept
from documents d left join n on n.doc_id = d.doc_id join comp on comp.doc_id = d.doc_id
"""

# CRC-32 of a short text, bit by bit.
_CRC32 = """xor(list_reduce(list_concat([4294967295::bigint], flatten(list_transform(generate_series(1, length({0})), lambda i:
    list_transform(generate_series(0, 7), lambda j: ((ascii({0}[i]) >> j) & 1)::bigint)))),
    lambda a, b: xor(a >> 1, 3988292384 * (xor(a, b) & 1))), 4294967295::bigint)"""

_OP13 = """
with recursive f as (
  select doc_id, lang, coalesce('1' || lang, '0') as k, n_chars, %s as crc,
         coalesce(strlen(doc_id::varchar) || ':' || doc_id, '-') || coalesce(strlen(source) || ':' || source, '-')
         || coalesce(strlen(lang) || ':' || lang, '-') as head,
         coalesce(strlen(text) || ':' || text, '-') as tail
  from documents),
l as (
  select *, sha256(head || coalesce(strlen(n_chars::varchar) || ':' || n_chars, '-') || tail) as leaf,
         sha256(head || case when crc %% 7 = 0 then coalesce(strlen((n_chars + 1)::varchar) || ':' || (n_chars + 1), '-')
                             else coalesce(strlen(n_chars::varchar) || ':' || n_chars, '-') end || tail) as held
  from f),
r as (
  select *, row_number() over (partition by k order by doc_id nulls first, leaf) - 1 as rank, count(*) over (partition by k) as n,
         row_number() over (order by k, doc_id nulls first, leaf) as id
  from l),
tree(k, level, n, pos, digest) as (
  select k, 0, n, rank, leaf from r
  union all
  select k, level + 1, (n + 1) // 2, pos // 2, sha256(string_agg(digest, '' order by pos))
  from tree where n > 1 group by k, level, n, pos // 2),
sub as (select k, digest as subroot, row_number() over (order by encode(k)) - 1 as i, count(*) over () as m from tree where n = 1),
high(level, n, pos, digest) as (
  select 0, m, i, subroot from sub
  union all
  select level + 1, (n + 1) // 2, pos // 2, sha256(string_agg(digest, '' order by pos))
  from high where n > 1 group by level, n, pos // 2),
root as (select digest as root from high where n = 1),
walk(id, k, level, pos, held, proof) as (
  select id, k, 0, rank, held, '' from r
  union all
  select w.id, w.k, w.level + 1, w.pos // 2,
         sha256(case when w.pos %% 2 = 1 then s.digest || w.held else w.held || coalesce(s.digest, '') end), w.proof || coalesce(s.digest, '')
  from walk w join tree t on t.k = w.k and t.level = w.level and t.pos = w.pos and t.n > 1
  left join tree s on s.k = w.k and s.level = w.level and s.pos = xor(w.pos, 1)),
top as (select w.id, w.k, w.held, w.proof from walk w join tree t on t.k = w.k and t.level = w.level and t.pos = w.pos and t.n = 1),
climb(id, level, pos, held, proof) as (
  select top.id, 0, sub.i, top.held, top.proof from top join sub on sub.k = top.k
  union all
  select c.id, c.level + 1, c.pos // 2,
         sha256(case when c.pos %% 2 = 1 then s.digest || c.held else c.held || coalesce(s.digest, '') end), c.proof || coalesce(s.digest, '')
  from climb c join high t on t.level = c.level and t.pos = c.pos and t.n > 1
  left join high s on s.level = c.level and s.pos = xor(c.pos, 1)),
last as (
  select c.id, sha256(c.proof) as proof_sha256, c.held as folded_root
  from climb c join high t on t.level = c.level and t.pos = c.pos and t.n = 1)
select r.doc_id, r.leaf, sub.subroot, root.root, last.proof_sha256, last.folded_root, last.folded_root = root.root as verified
from r join last on last.id = r.id join sub on sub.k = r.k cross join root
""" % _CRC32.format("coalesce(doc_id::varchar, '1')")

_OP11 = """
with c as (
  select conv_id, list(struct_pack(a := coalesce(role, ''), b := coalesce(text, '')) order by turn nulls first, role, text) as t
  from conversations group by conv_id),
b as (
  select c.conv_id, %s %% 6 as h, c.t as own, first.t as head
  from c left join c first on first.conv_id = c.conv_id - c.conv_id %% 100),
r as (
  select conv_id, list_concat(case when head is null then [] else head[1:h] end, own[h + 1:]) as t from b),
k as (
  select conv_id, d, len(t) as n, coalesce(length(t[d].b), 0) as chars,
         md5(array_to_string(list_transform(t[1:d], lambda x: md5(strlen(x.a) || ':' || x.a || x.b)), '')) as key
  from (select conv_id, t, unnest(generate_series(0, len(t))) as d from r)),
node as (
  select key, d, min(conv_id) as conv_id, count(*) as n_convs, any_value(chars) as chars,
         sha256(coalesce(string_agg(conv_id::varchar, ',' order by conv_id) filter (where d = n), '')) as ends_sha256
  from k group by key, d),
edge as (
  select x.key, x.d, above.key as parent from node x join k above on above.conv_id = x.conv_id and above.d = x.d - 1),
kids as (select parent as key, d - 1 as d, count(*) as n_children from edge group by all),
whole as (select node.*, coalesce(n_children, 0) as n_children from node left join kids using (key, d)),
tree as (
  select top.key, top.d, count(*) filter (where s.n_children = 0) as n_leaves, sum((s.n_convs - 1) * s.chars) as saved_tokens
  from whole s join k top on top.conv_id = s.conv_id and top.d <= s.d group by all)
select whole.conv_id, whole.d as depth, above.conv_id as parent_conv_id, whole.n_convs, whole.n_children, tree.n_leaves::bigint as n_leaves,
       tree.saved_tokens::bigint as saved_tokens, whole.ends_sha256
from whole join tree using (key, d) left join edge using (key, d) left join node above on above.key = edge.parent and above.d = whole.d - 1
""" % _CRC32.format("(c.conv_id::varchar)")

ORACLE: dict[str, str] = {"op11_prefix_trie": _OP11, "op13_merkle_manifest": _OP13, "op2_mix_sources": _OP2, "op3_warc_normalise": _OP3, "op4_format_chats": _OP4, "op9_minhash_near_dedup": _OP9}
