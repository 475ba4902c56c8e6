"""SQL for DuckDB of the operators that SQL can express."""

from postmill.llm import importance, minhash


def crc32_of(text: str) -> str:
    """Unsigned CRC-32 of a string's UTF-8 bytes, bit by bit."""
    octets = f"list_transform(regexp_extract_all(hex(encode({text})), '..'), lambda x: ('0x' || x)::bigint)"
    bits = "list_prepend(xor(a, b), list_transform(range(8), lambda i: 0::bigint))"
    step = f"lambda a, b: list_reduce({bits}, lambda s, i: xor(s >> 1, 3988292384 * (s & 1)))"
    return f"xor(list_reduce(list_prepend(4294967295::bigint, {octets}), {step}), 4294967295)"


def ascii_lower(text: str) -> str:
    return f"translate({text}, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"


# Each distinct word is hashed once.
IMPORTANCE_SQL = rf"""
with split as (
    select doc_id, regexp_extract_all({ascii_lower("coalesce(text, '')")}, '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') as words from documents
),
corpus as (select w, count(*) as n from (select unnest(words) as w from split) group by w),
wanted as (
    select w, count(*) as n
    from (select unnest(regexp_extract_all({ascii_lower("text")}, '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')) as w from benchmark) group by w
),
place as (select w, {crc32_of("w")} % {importance.BUCKETS} as bucket from (select w from corpus union select w from wanted)),
sizes as (select (select coalesce(sum(n), 0) from corpus)::double as s_all, (select coalesce(sum(n), 0) from wanted)::double as t_all),
by_bucket as (
    select bucket, coalesce(sum(c.n), 0)::double as s, coalesce(sum(b.n), 0)::double as t
    from place left join corpus c using (w) left join wanted b using (w) group by bucket
),
gain as (
    select bucket, floor(1000 * ln((t + 1) * (s_all + {importance.BUCKETS}) / ((s + 1) * (t_all + {importance.BUCKETS}))))::bigint as g
    from by_bucket, sizes
),
summed as (
    select r.row, sum(g) as g
    from (select row_number() over () as row, unnest(words) as w from split) r join place using (w) join gain using (bucket) group by r.row
),
weights as (
    select doc_id, len(words)::bigint as n_features,
           (case when len(words) = 0 then 0 else floor(g::double / len(words)) end)::bigint as weight
    from (select row_number() over () as row, doc_id, words from split) left join summed using (row)
),
scores as (
    select *, weight + floor(-1000 * ln(-ln((('0x' || substring(sha256('{importance.SALT}:' || doc_id), 1, 8))::bigint + 0.5::double)
                                          / 4294967296::double)))::bigint as score
    from weights
),
ranked as (
    select doc_id, n_features, row_number() over (order by score desc, doc_id) as place
    from scores where n_features >= {importance.MIN_WORDS}
),
drawn as (select doc_id, place from ranked where place <= (select count(*) * {importance.PERCENT} // 100 from ranked))
select doc_id, n_features, weight, score, place as rank from scores left join drawn using (doc_id)
"""

# A node is named by the digest of its turns' digests; a conversation's row at depth 0 is the root.
PREFIX_TRIE_SQL = f"""
with said as (
    select conv_id, turn, coalesce(role, '') as role, coalesce(text, '') as text from conversations where conv_id is not null
),
keyed as (
    select conv_id, turn, substring(sha256(length(role) || ':' || role || text), 1, 32) as key, octet_length(encode(text)) as bytes from said
),
placed as (
    select conv_id, key, bytes, row_number() over (partition by conv_id order by turn nulls first, key) as position from keyed
),
ids as (select conv_id, {crc32_of("conv_id::varchar")} % 9 as h from (select distinct conv_id from placed)),
rebuilt as (
    select conv_id, position, key, bytes from placed join ids using (conv_id) where position > h
    union all
    select i.conv_id, p.position, p.key, p.bytes from ids i join placed p on p.conv_id = i.conv_id - i.conv_id % 5 and p.position <= i.h
    union all
    select conv_id, 0, '', 0 from ids
),
paths as (
    select conv_id, bytes, row_number() over w - 1 as depth, sha256(string_agg(key, '') over w) as node
    from rebuilt window w as (partition by conv_id order by position)
),
steps as (select *, lag(node) over (partition by conv_id order by depth) as above, max(depth) over (partition by conv_id) as deepest from paths),
nodes as (
    select node, any_value(above) as above, any_value(depth) as depth, min(conv_id) as conv_id, count(*) as n_convs, any_value(bytes) as bytes,
           sha256(coalesce(string_agg(conv_id::varchar, ',' order by conv_id) filter (depth = deepest), '')) as ends_sha256
    from steps group by node
),
children as (select above as node, count(*) as n from nodes where above is not null group by above),
whole as (select nodes.*, coalesce(n, 0) as n_children from nodes left join children using (node)),
-- The smallest member of a node passes through all nodes above it.
sums as (
    select p.node, count(*) filter (w.n_children = 0) as n_leaves, sum((w.n_convs - 1) * w.bytes) as saved_tokens
    from whole w join paths p on p.conv_id = w.conv_id and p.depth <= w.depth group by p.node
)
select w.conv_id, w.depth::bigint as depth, a.conv_id as parent_conv_id, w.n_convs::bigint as n_convs, w.n_children::bigint as n_children,
       n_leaves::bigint as n_leaves, saved_tokens::bigint as saved_tokens, w.ends_sha256
from whole w join sums using (node) left join whole a on a.node = w.above
"""

# Equal texts are one set; a set is found in another through the shingles they share.
NEAR_DUPLICATES_SQL = rf"""
with recursive texts as (
    select row_number() over () as number, text, doc_id, regexp_extract_all({ascii_lower("text")}, '[^\x20\x09-\x0D]+') as words
    from (select coalesce(text, '') as text, min(doc_id) as doc_id from documents group by 1)
),
said as (select number, unnest(words) as word, generate_subscripts(words, 1) as i, len(words) as n_words from texts),
shingles as (
    select number, i, n_words, concat_ws(' ', word{"".join(f", lead(word, {k}) over w" for k in range(1, minhash.SHINGLE))}) as shingle
    from said window w as (partition by number order by i)
),
elements as (select distinct number, shingle from shingles where i <= greatest(n_words - {minhash.SHINGLE - 1}, 1)),
sizes as (select number, count(*) as n from elements group by number),
shared as (
    select a.number as a, b.number as b, count(*) as n
    from elements a join elements b on a.shingle = b.shingle and a.number <> b.number group by a.number, b.number
),
links as (
    select a, b from shared s join sizes x on x.number = a join sizes y on y.number = b
    where 100 * s.n >= {minhash.PERCENT} * (x.n + y.n - s.n)
),
reached as (
    select distinct a as start, a as number from links
    union
    select r.start, l.b from reached r join links l on l.a = r.number
),
least as (select r.start as number, min(t.doc_id) as doc_id from reached r join texts t on t.number = r.number group by r.start)
select d.doc_id, coalesce(s.n, 0)::bigint as n_shingles,
       case when s.n is null then d.doc_id else coalesce(l.doc_id, t.doc_id) end as component_id,
       d.doc_id = (case when s.n is null then d.doc_id else coalesce(l.doc_id, t.doc_id) end) as kept
from documents d join texts t on t.text = coalesce(d.text, '')
left join sizes s on s.number = t.number left join least l on l.number = t.number
"""
