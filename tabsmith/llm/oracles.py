"""DuckDB SQL of the training-data queries that SQL can express (names as in ``queries.QUERIES``)."""

PHRASES_SQL = r"""
with words as (
  select lang, list_filter(string_split_regex(piece, '[ \t]+'), lambda x: x <> '') as w from (
    select coalesce(lang, 'und') as lang,
      unnest(string_split_regex(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\n\x0B\f\r]')) as piece
    from documents)),
totals as (select lang, sum(len(w))::bigint as n from words group by lang),
grams as (
  select lang, k, unnest(list_transform(range(1, len(w) - k + 2), lambda i: array_to_string(w[i:i + k - 1], ' '))) as phrase
  from words, range(1, 6) as ks(k) where len(w) >= k),
freq as (select lang, k, phrase, count(*) as a from grams group by all having count(*) >= 100),
parts as (select *, string_split(phrase, ' ') as w from freq),
cuts as (
  select p.lang, p.phrase, p.a, cut, array_to_string(w[1:cut], ' ') as first_part, array_to_string(w[cut + 1:], ' ') as rest
  from parts p, range(1, 5) as cs(cut) where cut < k),
scored as (
  select c.*, f.a as l, r.a as r, n, ((1000::hugeint * c.a * n) // (f.a::hugeint * r.a))::bigint as score from cuts c
  join freq f on f.lang = c.lang and f.phrase = first_part join freq r on r.lang = c.lang and r.phrase = rest join totals t on t.lang = c.lang),
best as (select * from scored qualify row_number() over (partition by lang, phrase order by score, cut) = 1),
longer as (
  select lang, part, max(a) as most from (
    select lang, a, unnest(list_transform(list_filter(flatten(list_transform(range(1, 5), lambda i: list_transform(range(i, 6), lambda j: [i, j]))),
      lambda s: s[2] <= k and s[2] - s[1] + 1 < k), lambda s: array_to_string(w[s[1]:s[2]], ' '))) as part from parts)
  group by all),
kept as (select b.* from best b left join longer on longer.lang = b.lang and part = phrase where most is null or 100 * most < 100 * a)
select lang, row_number() over (partition by lang order by score desc, a desc, phrase) as rank, phrase, a, l, r, n, score from kept
qualify rank <= 2000
"""

#: Base32 of the SHA-1: four letters for five hexadecimal digits.
WARC_SQL = """
with hashed as (
  select page_id, coalesce(html, '') as payload, row_number() over same as nth, first_value(page_id) over same as first_id
  from pages window same as (partition by coalesce(html, '') order by page_id nulls last, url nulls first)),
digits as (
  select *, list_transform(range(8), lambda g: ('0x' || substr(sha1(payload), 5 * g + 1, 5))::bigint) as v from hashed)
select page_id, strlen(payload)::bigint as payload_bytes,
  list_aggregate(list_transform(v, lambda x: list_aggregate(list_transform([15, 10, 5, 0],
    lambda s: substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567', ((x >> s) & 31) + 1, 1)), 'string_agg', '')), 'string_agg', '') as payload_digest,
  case when nth = 1 then 'response' else 'revisit' end as record_type, case when nth > 1 then first_id end as refers_to
from digits
"""

#: CRC-32 (reflected polynomial 0xEDB88320) of a conversation id's decimal digits, by list folds.
TRIE_SQL = """
with t as (
  select conv_id, coalesce(role, '') as role, coalesce(text, '') as text,
    row_number() over (partition by conv_id order by turn nulls first, coalesce(role, ''), coalesce(text, '')) as p from conversations),
crc as (
  select conv_id as c, conv_id - conv_id % 100 as head,
    xor(list_reduce(list_prepend(4294967295::bigint, list_transform(string_split(conv_id::varchar, ''), lambda x: ascii(x)::bigint)),
      lambda crc, b: list_reduce([xor(crc, b), 0, 0, 0, 0, 0, 0, 0, 0],
        lambda v, i: case when v & 1 = 1 then xor(v >> 1, 3988292384::bigint) else v >> 1 end)), 4294967295::bigint) % 6 as h
  from (select distinct conv_id from conversations)),
rebuilt as (
  select c, row_number() over (partition by c order by own, p) as d, role, text from (
    select c, 0 as own, p, role, text from crc join t on t.conv_id = head and p <= h
    union all select c, 1, p, role, text from crc join t on t.conv_id = c and p > h)),
prefixes as (
  select c, d, string_agg(md5(length(role) || ':' || role || text), '') over (partition by c order by d) as path, length(text) as chars from rebuilt
  union all select c, 0, '', 0 from crc),
ends as (
  select path, string_agg(c::varchar, ',' order by c) as ids from (
    select c, arg_max(path, d) as path from prefixes group by c) group by path),
nodes as (
  select path, d, min(c) as conv_id, count(*) as n, any_value(chars) as chars from prefixes group by path, d),
linked as (
  select x.*, u.path as up, q.conv_id as parent_conv_id from nodes x
  left join prefixes u on u.c = x.conv_id and u.d = x.d - 1 left join nodes q on q.path = u.path and q.d = x.d - 1),
kids as (select up, count(*) as k from linked where up is not null group by up),
own as (
  select x.*, coalesce(k, 0) as k, (n - 1) * chars as saved from linked x left join kids on kids.up = x.path),
sums as (
  select a.path, sum(o.saved) as saved, count(*) filter (o.k = 0) as leaves from own o
  join prefixes a on a.c = o.conv_id and a.d <= o.d group by a.path)
select conv_id, d as depth, parent_conv_id, n as n_convs, k as n_children, leaves as n_leaves, sums.saved::bigint as saved_tokens,
  sha256(coalesce(ids, '')) as ends_sha256
from own join sums using (path) left join ends using (path)
"""
