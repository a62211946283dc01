"""DuckDB SQL for the operators whose results SQL can express in fair time on whole tables."""

from __future__ import annotations

_WORD = r"[^\x20\x09-\x0D]+"

SUBSTRING_DEDUP = f"""
with d as (select doc_id, regexp_extract_all(coalesce(text, ''), '{_WORD}') ws from documents),
w as (select doc_id, i, array_to_string(ws[i:i + 34], ' ') g from (select doc_id, ws, unnest(range(1, len(ws) - 33)) i from d where len(ws) >= 35)),
gone as (select distinct doc_id, i + k p from (select doc_id, i from w qualify count(*) over (partition by g) > 1), range(35) t(k)),
words as (select doc_id, unnest(ws) word, generate_subscripts(ws, 1) p from d),
kept as (select doc_id, string_agg(word, ' ' order by p) t, count(*) n from words anti join gone using (doc_id, p) group by doc_id)
select doc_id, len(ws)::bigint n_words, (len(ws) - coalesce(n, 0))::bigint n_removed, sha256(coalesce(t, '')) kept_sha256 from d left join kept using (doc_id)"""

EMBEDDING_DEDUP = """
with recursive v as (select vec_id, label, embedding::double[] e from embeddings where label is not null and len(embedding) > 0),
pairs as (select a.vec_id a, b.vec_id b from v a join v b on a.label = b.label and a.vec_id <> b.vec_id and len(a.e) = len(b.e)
    where list_cosine_similarity(a.e, b.e) >= 0.93),
reach(id, other) as (select vec_id, vec_id from embeddings union select reach.id, pairs.b from reach join pairs on reach.other = pairs.a),
low as (select id, min(other) component_id from reach group by id),
links as (select a, count(*) n from pairs group by a)
select vec_id, coalesce(n, 0)::bigint n_links, component_id, vec_id = component_id kept
from embeddings join low on vec_id = low.id left join links on vec_id = links.a"""

_SEATS = """select *, row_number() over (partition by {group} order by {weight} / (2 * k + 1) desc, {cell}, k) place
    from (select *, unnest(range(0, {most})) k from {cells})"""

MIXING = f"""
with d as (select doc_id, source is null none, coalesce(source, '') source, len(regexp_extract_all(coalesce(text, ''), '{_WORD}'))::bigint size,
    md5('42:' || coalesce(doc_id::varchar, '')) rank from documents),
s as (select none, source, sum(size)::bigint source_size from d group by none, source),
weighed as (select *, (row_number() over (order by none, source) - 1) % 3 + 1 weight, 3 * source_size cap from s),
levels as (select *, (sum(source_size) over () - coalesce(sum(cap) over o, 0)) / (sum(weight) over () - coalesce(sum(weight) over o, 0)) level from weighed
    window o as (order by cap / weight, none, source rows between unbounded preceding and 1 preceding)),
goals as (select none, source, source_size, least(cap::double, weight * max(level) over ()) target, ceil(source_size / 1048576)::bigint n_shards,
    round(sum(source_size) over () / 32)::bigint blocks from levels),
won as (select none, source, count(*) source_quota from ({_SEATS.format(group="1", weight="target", cell="none, source", most="blocks", cells="goals")})
    where place <= blocks and target > 0 group by none, source),
dealt as (select d.*, source_size, target, coalesce(source_quota, 0) source_quota, ('0x' || substr(rank, 1, 8))::bigint % greatest(n_shards, 1) shard
    from d join goals using (none, source) left join won using (none, source)),
shards as (select none, source, shard, sum(size)::bigint shard_size, any_value(source_quota) source_quota from dealt group by none, source, shard),
quotas as (select none, source, shard, count(*) quota
    from ({_SEATS.format(group="none, source", weight="shard_size", cell="shard", most="source_quota", cells="shards")})
    where place <= source_quota and shard_size > 0 group by none, source, shard),
placed as (select dealt.*, shard_size, least(coalesce(quota, 0) * 32, 3 * shard_size)::bigint words,
    sum(size) over (partition by none, source, shard order by rank, doc_id, size rows between unbounded preceding and current row) - size position
    from dealt join shards using (none, source, shard) left join quotas using (none, source, shard))
select doc_id, size, source_size, target,
    (case when shard_size = 0 then 0 else (words // shard_size) * size + greatest(0, least(size, words % shard_size - position)) end)::bigint taken from placed"""
