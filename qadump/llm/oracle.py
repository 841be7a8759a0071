"""SQL for DuckDB that gives the rows of those queries that SQL can express."""

from __future__ import annotations

URL_FILTER = """
with rules(rule_host, rule_path, verdict) as (
    values ('net', '/', 'block'), ('example.net', '/en/', 'allow'),
           ('example.com', '/de/', 'block'), ('org', '/fr/', 'allow')
),
rests as (
    select page_id, row_number() over () as uid,
        case when strpos(coalesce(url, ''), '://') = 0 then ''
             else substr(url, strpos(url, '://') + 3) end as rest
    from pages
),
parsed as (
    select page_id, uid,
        translate(regexp_extract(rest, '^[^/?#]*'), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') as host,
        regexp_extract(rest, '^[^/?#]*([^?#]*)', 1) as path
    from rests
),
fits as (
    select uid, rule_host || rule_path as rule, verdict,
        row_number() over (partition by uid order by length(rule_host || rule_path) desc, length(rule_host) desc) as nth
    from parsed, rules
    where (host = rule_host or ends_with(host, '.' || rule_host)) and starts_with(path, rule_path)
)
select page_id, host, path, rule, coalesce(verdict, 'allow') as verdict
from parsed left join (select * from fits where nth = 1) using (uid)
"""

# CRC-32 of each distinct feature, byte by byte, over the usual table of 256 states.
IMPORTANCE = r"""
with crc as (
    select list_transform(range(256), lambda n:
        list_reduce(range(8), lambda c, k: case when c & 1 = 1 then xor(c >> 1, 3988292384) else c >> 1 end, n)) as states
),
texts as (
    select 'd' as kind, row_number() over () as uid, doc_id, text from documents
    union all
    select 'b', row_number() over (), null, text from benchmark
),
split as (
    select kind, uid, doc_id,
        regexp_extract_all(
            translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
            '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') as words
    from texts
),
features as (
    select kind, uid, unnest(list_concat(words,
        list_transform(range(1, len(words)), lambda i: words[i] || ' ' || words[i + 1]))) as feature
    from split
),
counted as (select kind, uid, feature, count(*) as n from features group by all),
hashes as (
    select feature, upper(hex(encode(feature))) as digits from (select distinct feature from counted)
),
bucketed as (
    select feature,
        xor(list_reduce(
            range(0, len(digits) // 2),
            lambda c, i: xor(states[(xor(c, ('0x' || substr(digits, 2 * i + 1, 2))::bigint) & 255) + 1], c >> 8),
            4294967295), 4294967295) % 10000 as bucket
    from hashes, crc
),
cells as (select kind, uid, bucket, sum(n) as n from counted join bucketed using (feature) group by all),
sums as (
    select bucket, sum(n) filter (kind = 'd') as s, sum(n) filter (kind = 'b') as t from cells group by bucket
),
everything as (select coalesce(sum(s), 0)::double as s_all, coalesce(sum(t), 0)::double as t_all from sums),
gained as (
    select bucket, floor(1000 * ln((coalesce(t, 0) + 1)::double * (s_all + 10000)
        / ((coalesce(s, 0) + 1)::double * (t_all + 10000))))::bigint as gain
    from sums, everything
),
summed as (
    select uid, sum(n)::bigint as n, sum(n * gain)::bigint as gain
    from cells join gained using (bucket) where kind = 'd' group by uid
),
weighed as (
    select doc_id, len(words) >= 20 as fit, coalesce(n, 0) as n_features,
        coalesce((gain - (gain % n + n) % n) // n, 0) as weight,
        ('0x' || sha256('7:' || coalesce(doc_id::varchar, ''))[:8])::bigint as h
    from split left join summed using (uid) where kind = 'd'
),
scored as (
    select *, weight + floor(-1000 * ln(-ln((h + 0.5::double) / 4294967296)))::bigint as score from weighed
),
ranked as (
    select *, row_number() over (partition by fit order by score desc, doc_id) as nth,
        count(*) over (partition by fit) as fitting
    from scored
)
select doc_id, n_features::bigint as n_features, weight::bigint as weight, score::bigint as score,
    case when fit and nth <= 25 * fitting // 100 then nth end as rank
from ranked
"""

# Turns become numbers, nodes lists of them; every node adds its values to all its prefixes.
PREFIX_TRIE = """
with crc as (
    select list_transform(range(256), lambda n:
        list_reduce(range(8), lambda c, k: case when c & 1 = 1 then xor(c >> 1, 3988292384) else c >> 1 end, n)) as states
),
turns as (
    select conv_id, coalesce(role, '') as role, coalesce(text, '') as text,
        row_number() over (
            partition by conv_id order by turn nulls first, coalesce(role, ''), coalesce(text, '')) - 1 as nth,
        dense_rank() over (order by coalesce(role, ''), coalesce(text, '')) as turn_id
    from conversations where conv_id is not null
),
digits as (select distinct conv_id, hex(encode(conv_id::varchar)) as digits from turns),
convs as (
    select conv_id, conv_id - conv_id % 5 as base,
        xor(list_reduce(
            range(0, len(digits) // 2),
            lambda c, i: xor(states[(xor(c, ('0x' || substr(digits, 2 * i + 1, 2))::bigint) & 255) + 1], c >> 8),
            4294967295), 4294967295) % 9 as h
    from digits, crc
),
rebuilt as (
    select c.conv_id, 0 as own, nth, turn_id, text from convs c join turns t on t.conv_id = c.base and nth < h
    union all
    select c.conv_id, 1, nth, turn_id, text from convs c join turns t on t.conv_id = c.conv_id and nth >= h
),
ordered as (
    select conv_id, turn_id, text, row_number() over (partition by conv_id order by own, nth) as depth from rebuilt
),
whole as (
    select conv_id, coalesce(list(turn_id order by depth) filter (turn_id is not null), []) as ids
    from convs left join ordered using (conv_id) group by conv_id
),
paths as (select conv_id, unnest(range(0, len(ids) + 1)) as depth, ids from whole),
on_paths as (
    select p.conv_id, p.depth, ids[1:p.depth] as key, ids[1:p.depth - 1] as above, len(ids) = p.depth as last,
        coalesce(octet_length(encode(text)), 0) as bytes
    from paths p left join ordered o on o.conv_id = p.conv_id and o.depth = p.depth
),
nodes as (
    select key, depth, min(conv_id) as conv_id, count(*) as n_convs, any_value(above) as above, any_value(bytes) as bytes,
        coalesce(string_agg(conv_id::varchar, ',' order by conv_id) filter (last), '') as ends
    from on_paths group by key, depth
),
children as (select above as key, count(*) as n_children from nodes where depth > 0 group by above),
counted as (select nodes.*, coalesce(n_children, 0) as n_children from nodes left join children using (key)),
sent as (
    select key[1:unnest(range(0, depth + 1))] as key, (n_children = 0)::int as leaf, (n_convs - 1) * bytes as saved
    from counted
),
totals as (select key, sum(leaf) as n_leaves, sum(saved) as saved_tokens from sent group by key)
select n.conv_id, n.depth::bigint as depth, p.conv_id as parent_conv_id, n.n_convs, n.n_children,
    n_leaves::bigint as n_leaves, saved_tokens::bigint as saved_tokens, sha256(n.ends) as ends_sha256
from counted n join totals using (key) left join nodes p on n.depth > 0 and p.key = n.above
"""

ORACLE = {
    "op11_url_filter": URL_FILTER,
    "op12_importance": IMPORTANCE,
    "op13_prefix_trie": PREFIX_TRIE,
}
