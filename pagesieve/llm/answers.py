"""Expected results of the numbered operators in SQL, where SQL can express them."""

from __future__ import annotations

ANSWERS: dict[str, str] = {}

ANSWERS["op9_capped_water_filling"] = """
with recursive d as (
  select doc_id, source, coalesce(len(regexp_extract_all(text, '[^\\x20\\x09-\\x0D]+')), 0) as size,
    md5('mix-1:' || coalesce(cast(doc_id as varchar), 'null')) as place
  from documents),
ranked as (
  select source, cast(sum(size) as bigint) as source_size,
    [3, 1, 2][1 + (row_number() over (order by source nulls last) - 1) % 3] as weight
  from d group by source),
turns as (
  select 0 as turn, cast(0 as double) as full_size, cast(sum(weight) as double) as free, 1.5 * sum(source_size) as total from ranked
  union all
  select turn + 1, f, r, total from (
    select t.turn, t.total, t.full_size, t.free,
      sum(case when t.free = 0 or weight * (t.total - t.full_size) > 2 * source_size * t.free then 2 * source_size else 0 end) as f,
      sum(case when t.free = 0 or weight * (t.total - t.full_size) > 2 * source_size * t.free then 0 else weight end) as r
    from turns t, ranked group by t.turn, t.total, t.full_size, t.free)
  where f <> full_size or r <> free),
settled as (select full_size, free, total from turns order by turn desc limit 1),
wanted as (
  select source, source_size,
    cast(case when free = 0 or weight * (total - full_size) > 2 * source_size * free then 2 * source_size
      else weight * (total - full_size) / free end as double) as target
  from ranked, settled),
amounts as (
  select *, case when source_size > 0 then cast(floor(target / source_size) as bigint) else 0 end as epochs from wanted),
running as (
  select d.doc_id, d.source, d.size, d.place, a.source_size, a.target, a.epochs,
    cast(floor(a.target) as bigint) - a.epochs * a.source_size as more,
    sum(d.size) over (partition by d.source order by d.place) as upto,
    sum(d.size) over (partition by d.source, d.place) as tied
  from d join amounts a on d.source is not distinct from a.source),
placed as (
  select *, case when upto <= more then size when upto - tied < more then floor((more - (upto - tied)) * size / tied) else 0 end as extra
  from running)
select doc_id, source, cast(size as bigint) as size, source_size, target, epochs, cast(extra as bigint) as extra,
  cast(epochs * size + extra as bigint) as taken
from placed
"""

_MARKS = "</s>[INST] ok [/INST]"


def _escaped(text: str) -> str:
    out = f"replace({text}, '\\', '\\\\')"
    for c in ("<|", "|>", "<s>", "</s>", "[INST]", "[/INST]", "<<SYS>>", "<</SYS>>"):
        out = f"replace({out}, '{c}', '{c[0]}' || '\\' || '{c[1:]}')"
    return out


ANSWERS["op8_budgeted_chat_windows"] = f"""
with recursive given as (
  select conv_id, turn, coalesce(role, '') as role, coalesce(text, '') as text from conversations
  union all select -7, 0, 'user', '{_MARKS}' union all select -7, 1, 'assistant', '{_MARKS}'),
placed as (
  select *, row_number() over (partition by conv_id order by turn nulls first, role, text) as spot,
    len(regexp_extract_all(text, '[\\p{{L}}\\p{{N}}]+|[^\\x20\\x09-\\x0D\\p{{L}}\\p{{N}}]')) + 4 as tokens,
    length({_escaped("role")}) + 5 + length({_escaped("text")}) + 8 as chars
  from given),
summed as (
  select *, sum(tokens) over w as upto, sum(chars) over w as chars_upto, first_value(role) over w = 'system' as has_system,
    case when first_value(role) over w = 'system' then first_value(tokens) over w else 0 end as system_tokens,
    case when first_value(role) over w = 'system' then first_value(chars) over w else 0 end as system_chars
  from placed window w as (partition by conv_id order by spot rows between unbounded preceding and current row)),
spans as (
  select conv_id, spot, spot as first, cast(0 as hugeint) as base from summed where spot = 1
  union all
  select s.conv_id, s.spot,
    case when s.upto - p.base > greatest(384 - s.system_tokens, 128) and s.spot > p.first then s.spot else p.first end,
    case when s.upto - p.base > greatest(384 - s.system_tokens, 128) and s.spot > p.first then s.upto - s.tokens else p.base end
  from spans p join summed s on s.conv_id = p.conv_id and s.spot = p.spot + 1),
begun as (select s.* from summed s join spans p on s.conv_id = p.conv_id and s.spot = p.spot and p.first = p.spot where s.spot > 1),
repeated as (
  select b.conv_id, b.system_chars
    + case when b.spot - 2 >= first_free and two.tokens + one.tokens <= 128 then one.chars + two.chars
        when b.spot - 1 >= first_free and one.tokens <= 128 then one.chars else 0 end as chars
  from (select *, case when has_system then 2 else 1 end as first_free from begun) b
    join summed one on one.conv_id = b.conv_id and one.spot = b.spot - 1
    left join summed two on two.conv_id = b.conv_id and two.spot = b.spot - 2)
select conv_id, count(*) as n_turns,
  sha256(string_agg(role || chr(10) || text || chr(10), '' order by spot)) as turns_sha256,
  cast(coalesce(sum(length(text)) filter (role = 'assistant'), 0) as bigint) as loss_chars,
  sha256(coalesce(string_agg(text, '' order by spot) filter (role = 'assistant'), '')) as loss_sha256,
  cast(sum(chars) + coalesce((select sum(chars) from repeated r where r.conv_id = s.conv_id), 0) as bigint) as formatted_chars
from summed s group by conv_id
"""

_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
_WORDS = "'[^\\x20\\x09-\\x0D]+'"

ANSWERS["op6_line_frequency_rules"] = f"""
with d as (
  select doc_id, coalesce('=' || source, '') as host, coalesce(text, '') as text,
    regexp_extract_all(coalesce(text, ''), {_WORDS}) as words
  from documents),
lines as (
  select doc_id, host, text, line, len(regexp_extract_all(line, {_WORDS})) as words,
    array_to_string(regexp_extract_all(translate(translate(line, '{_UPPER}', '{_LOWER}'), '123456789', '000000000'), {_WORDS}), ' ') as norm
  from (select doc_id, host, text, unnest(string_split(text, chr(10))) as line from d)
  where regexp_matches(line, {_WORDS})),
doubles as (select doc_id, count(*) - count(distinct line) as n from lines group by doc_id),
windows as (
  select doc_id, i, count(*) over (partition by doc_id, words[i], words[i + 1], words[i + 2]) as n
  from (select doc_id, words, unnest(range(1, len(words) - 1)) as i from d where len(words) > 2)),
repeated as (
  select doc_id, count(distinct i + k) as n from windows, (select unnest([0, 1, 2]) as k) where n > 1 group by doc_id),
shared as (select host, norm, count(distinct text) as texts from lines group by host, norm having count(distinct text) > 20),
gone as (select doc_id, sum(words) as n from lines join shared using (host, norm) group by doc_id),
counts as (
  select d.doc_id, len(words) as n_words, length(array_to_string(words, '')) as word_chars,
    length(text) - length(regexp_replace(text, '[#*$%&|<>]', '', 'g')) as n_symbols, coalesce(b.n, 0) as n_dup_lines,
    coalesce(r.n, 0) as n_repeat_words, len(words) - coalesce(g.n, 0) as n_left
  from d left join doubles b using (doc_id) left join repeated r using (doc_id) left join gone g using (doc_id))
select doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words,
  n_words < 50 or 100 * n_repeat_words > 50 * n_words as base_failed, cast(n_left as bigint) as n_left,
  not (n_words < 50 or 100 * n_repeat_words > 50 * n_words) and 100 * n_left >= 30 * n_words as kept
from counts
"""

ANSWERS["op10_superminhash_near_dup"] = f"""
with recursive d as (
  select doc_id, regexp_extract_all(translate(coalesce(text, ''), '{_UPPER}', '{_LOWER}'), {_WORDS}) as w from documents),
shingles as (
  select distinct doc_id, unnest(case when len(w) = 0 then [] when len(w) < 5 then [array_to_string(w, ' ')]
    else list_transform(range(1, len(w) - 3), lambda i: array_to_string(w[i:i + 4], ' ')) end) as s
  from d),
sizes as (select doc_id, count(*) as n from shingles group by doc_id),
links as (
  select a, b from (
    select x.doc_id as a, y.doc_id as b, count(*) as both_have from shingles x join shingles y using (s)
    where x.doc_id < y.doc_id group by 1, 2) p
  join sizes m on m.doc_id = p.a join sizes n on n.doc_id = p.b
  where 100 * both_have >= 85 * (m.n + n.n - both_have)),
edges as (select a, b from links union all select b, a from links),
reach as (
  select a, b from edges
  union
  select r.a, e.b from reach r join edges e on e.a = r.b)
select d.doc_id, coalesce(z.n, 0) as n_shingles, least(d.doc_id, coalesce(r.least_one, d.doc_id)) as component_id,
  d.doc_id = least(d.doc_id, coalesce(r.least_one, d.doc_id)) as kept
from d left join sizes z using (doc_id) left join (select a as doc_id, min(b) as least_one from reach group by a) r using (doc_id)
"""

# Fixed value: the alphabet of base 32.
_BASE32 = "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567"
_FIVE_BITS = " + ".join(f"{2 ** (4 - k)} * cast(substr(bits, cast(5 * i + {k + 1} as bigint), 1) as int)" for k in range(5))

ANSWERS["op12_zip_warc"] = f"""
with p as (
  select page_id, cast(strlen(coalesce(html, '')) as bigint) as payload_bytes, cast(cast(unhex(sha1(coalesce(html, ''))) as bit) as varchar) as bits
  from pages),
named as (
  select page_id, payload_bytes, array_to_string(list_transform(range(32), lambda i: substr('{_BASE32}', 1 + {_FIVE_BITS}, 1)), '') as payload_digest
  from p)
select page_id, payload_bytes, payload_digest,
  case when page_id = max(page_id) over w then 'response' else 'revisit' end as record_type,
  case when page_id <> max(page_id) over w then max(page_id) over w end as refers_to
from named window w as (partition by payload_digest)
"""
