"""DuckDB SQL for the queries that SQL can express."""

from __future__ import annotations

import re

from lakemart.llm.licenses import TEMPLATES, size_classes

# The plain forms of the patterns.
_PATTERNS = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+",
    "ip": r"[0-9]+(?:\.[0-9]+)(?:\.[0-9]+)(?:\.[0-9]+)",
    "card": r"[0-9](?:[\x20-]?[0-9])+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
    "iban": r"[A-Z]{2}[0-9]{2}(?:[A-Z0-9]{11,30}|(?:\x20[A-Z0-9]{4}){2,7}(?:\x20[A-Z0-9]{1,3})?)",
    "ssn": r"[0-9]{3}-[0-9]{2}-[0-9]{4}",
}

_RAW = " union all ".join(
    f"select doc_id, text, '{kind}' as kind, {order} as ord, regexp_extract_all(text, '{pattern}') as m, "
    f"string_split_regex(text, '{pattern}') as g from d"
    for order, (kind, pattern) in enumerate(_PATTERNS.items())
)

PII = f"""
with d as (select doc_id, coalesce(text, '') as text from documents),
raw as ({_RAW}),
hit as (select *, unnest(generate_series(1, len(m))) as i from raw where len(m) > 0),
pos as (
  select doc_id, text, kind, ord, m[i] as v, regexp_replace(m[i], '[^0-9]', '', 'g') as digits,
         replace(m[i], ' ', '') as plain,
         list_sum(list_transform(g[1:i], lambda x: length(x)))
           + coalesce(list_sum(list_transform(m[1:i - 1], lambda x: length(x))), 0) as s
  from hit),
kept as (
  select doc_id, kind, ord, s::bigint as s, (s + length(v))::bigint as e from pos
  where case kind
    when 'email' then true
    when 'ip' then len(list_filter(string_split(v, '.'), lambda p: p::double > 255)) = 0
    when 'card' then length(digits) between 14 and 19 and list_sum(list_transform(range(1, length(digits) + 1), lambda k:
        case when k % 2 = 1 then substr(reverse(digits), k, 1)::int
             when substr(reverse(digits), k, 1)::int > 4 then substr(reverse(digits), k, 1)::int * 2 - 9
             else substr(reverse(digits), k, 1)::int * 2 end)) % 10 = 0
    when 'phone' then length(digits) between 10 and 15
    when 'iban' then length(plain) between 15 and 34 and list_reduce(list_prepend(0::bigint, list_transform(
        range(1, length(plain) + 1), lambda k: ascii(substr(substr(plain, 5) || substr(plain, 1, 4), k, 1))::bigint)),
        lambda a, c: case when c < 65 then (a * 10 + c - 48) % 97 else (a * 100 + c - 55) % 97 end) = 1
    else not regexp_matches(v, '^(000|666|9)') and not regexp_matches(v, '-00-|-0000$') and regexp_matches(
        lower(substr(text, (greatest(s - 40, 0) + 1)::bigint, (s + length(v) + 20 - greatest(s - 40, 0))::bigint)),
        'ssn|social security|taxpayer')
    end),
grouped as (
  select doc_id, count(*) filter (kind = 'email') as n_email, count(*) filter (kind = 'ip') as n_ip,
         count(*) filter (kind = 'card') as n_card, count(*) filter (kind = 'phone') as n_phone,
         string_agg(kind || ':' || s || ':' || e, ',' order by s, ord) filter (ord < 4) as base,
         string_agg(kind || ':' || s || ':' || e, ',' order by s, ord) as spans
  from kept group by doc_id)
select doc_id, coalesce(n_email, 0) as n_email, coalesce(n_ip, 0) as n_ip, coalesce(n_card, 0) as n_card,
       coalesce(n_phone, 0) as n_phone, sha256(coalesce(base, '')) as base_sha256, coalesce(spans, '') as spans
from d left join grouped using (doc_id)
"""


def _licenses() -> str:
    """The best window of each document and license by exact containment, windows as in the operator."""
    grams = {}
    for name, text in sorted(TEMPLATES.items()):
        words = re.findall(r"[^\W_]+", text.lower())
        grams[name] = {tuple(words[i : i + 5]) for i in range(len(words) - 4)}
    classes = size_classes([len(g) for g in grams.values()])
    rows = []
    for name, own in grams.items():
        largest = min(c for c in classes if c >= len(own))
        body = TEMPLATES[name].replace("'", "''")
        rows.append(f"('{name}', {largest}, {max(1, largest // 2)}, {len(own)}, '{body}')")
    split = r"list_filter(string_split_regex(lower({0}), '[^\p{{L}}\p{{N}}]+'), lambda x: x <> '')"
    return f"""
with t(license, cls, stride, n, body) as (values {", ".join(rows)}),
tw as (select license, cls, stride, n, {split.format("body")} as w from t),
ts as (select distinct license, cls, stride, n, array_to_string(w[i:i + 4], ' ') as sh
       from (select *, unnest(generate_series(1, len(w) - 4)) as i from tw) x),
dw as (select doc_id, {split.format("text")} as w from documents where text is not null),
ds as (select doc_id, i - 1 as p, array_to_string(w[i:i + 4], ' ') as sh
       from (select doc_id, w, unnest(generate_series(1, len(w) - 4)) as i from dw) y),
hit as (select * from ds join ts using (sh)),
win as (select *, unnest(generate_series(greatest(0, ceil((p - cls - stride + 1) / stride))::bigint, floor(p / stride)::bigint)) as k
        from hit),
fit as (select doc_id, license, k, count(distinct sh)::double / n as containment, min(p)::bigint as first_word
        from win group by doc_id, license, k, n having count(distinct sh)::double / n >= 0.8)
select doc_id, license, best[1] as containment, (-best[2])::bigint as first_word
from (select doc_id, license, max([containment, -first_word::double]) as best from fit group by doc_id, license) z
"""


LICENSES = _licenses()

HARD_NEGATIVES = """
with v as (
  select vec_id, case when vec_id % 7 = 0 then (label + 1) % 10 else label end as label,
         list_transform(embedding, lambda x: floor(256 * x::double)) as v
  from embeddings
  where label is not null and vec_id is not null and embedding is not null
    and len(list_filter(embedding, lambda x: x is null or not isfinite(x))) = 0),
scored as (
  select a.vec_id as anchor_id, b.vec_id as id, a.label = b.label as alike, list_dot_product(a.v, b.v)::bigint as score
  from v a join v b on a.vec_id <> b.vec_id where a.vec_id % 50 = 0),
positive as (
  select anchor_id, id, score from scored where alike
  qualify row_number() over (partition by anchor_id order by score desc, id) <= 5)
select p.anchor_id, p.id as positive_id,
       (row_number() over (partition by p.anchor_id, p.id order by n.score desc, n.id))::integer as rank,
       n.id as negative_id, p.score as positive_score, n.score as negative_score
from positive p join scored n on n.anchor_id = p.anchor_id and not n.alike
  and 50 * p.score <= 100 * n.score and 100 * n.score <= 95 * p.score
qualify row_number() over (partition by p.anchor_id, p.id order by n.score desc, n.id) <= 3
"""

# The CRC of the contract, byte by byte with the table of the reflected polynomial.
PREFIX_TRIE = r"""
with crc(t) as (
  select list_transform(range(256), lambda i: list_reduce(list_prepend(i, [0, 0, 0, 0, 0, 0, 0, 0]),
    lambda c, z: case when c & 1 = 1 then xor(c >> 1, 3988292384) else c >> 1 end))),
raw as (
  select conv_id, turn, coalesce(role, '') as role, coalesce(text, '') as text from conversations where conv_id is not null),
own as (
  select conv_id, md5(length(role) || ':' || role || text) as symbol, len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')) as words,
         row_number() over (partition by conv_id order by turn nulls first, role, md5(length(role) || ':' || role || text)) as place
  from raw),
conv as (
  select conv_id, count(*) as turns, conv_id - conv_id % 20 as head,
         xor(list_reduce(list_prepend(4294967295, list_transform(range(1, length(conv_id::varchar) + 1),
               lambda i: ascii(substr(conv_id::varchar, i, 1))::bigint)),
             lambda c, b: xor(c >> 8, any_value(t)[xor(c & 255, b) + 1])), 4294967295) % 4 as h
  from own, crc group by conv_id),
graft as (
  select c.conv_id, c.turns, c.h, c.head, least(c.h, coalesce(f.turns, 0)) as taken
  from conv c left join conv f on f.conv_id = c.head),
turn as (
  select g.conv_id, o.place as depth, symbol, words from graft g join own o on o.conv_id = g.head and o.place <= g.taken
  union all
  select g.conv_id, o.place - g.h + g.taken, symbol, words from graft g join own o on o.conv_id = g.conv_id and o.place > g.h),
path as (
  select conv_id, depth, words, md5(string_agg(symbol, '') over (partition by conv_id order by depth)) as key from turn
  union all
  select conv_id, 0, 0, '' from conv),
linked as (
  select *, lag(key) over (partition by conv_id order by depth) as above,
         depth = max(depth) over (partition by conv_id) as ends
  from path),
node as (
  select key, depth, min(conv_id) as conv_id, any_value(above) as above, any_value(words) as words, count(*) as n_convs,
         sha256(coalesce(string_agg(conv_id::varchar, ',' order by conv_id) filter (ends), '')) as ends_sha256
  from linked group by key, depth),
child as (select above as key, count(*) as n_children from node where above is not null group by above),
below as (
  select p.key, count(*) filter (c.key is null) as n_leaves, sum((n.n_convs - 1) * n.words) as saved_tokens
  from node n left join child c using (key) join linked p on p.conv_id = n.conv_id and p.depth <= n.depth
  group by p.key)
select n.conv_id, n.depth::bigint as depth, a.conv_id as parent_conv_id, n.n_convs::bigint as n_convs,
       coalesce(n_children, 0)::bigint as n_children, n_leaves::bigint as n_leaves, saved_tokens::bigint as saved_tokens, n.ends_sha256
from node n join below b on b.key = n.key left join child c on c.key = n.key left join node a on a.key = n.above
"""
