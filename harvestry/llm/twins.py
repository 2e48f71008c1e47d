"""DuckDB twins of the queries that SQL can express."""

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
LOWERED = f"translate(coalesce(text, ''), '{UPPER}', '{LOWER}')"
BLANKS = "' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)"
BLANK_WORDS = r"regexp_extract_all({0}, '[^\x20\x09-\x0D]+')"

HOST_REPUTATION = rf"""
with cut as (select page_id, case when position('://' in url) > 0 then substr(url, position('://' in url) + 3) else '' end as rest from pages),
parted as (select page_id, translate(regexp_extract(coalesce(rest, ''), '^([^/?#]*)', 1), '{UPPER}', '{LOWER}') as host, regexp_extract(coalesce(rest, ''), '^[^/?#]*([^?#]*)', 1) as path from cut),
known as (select doc_id, max(case when toxic = 1 or quality = 0 then 1 when toxic is not null or quality is not null then 0 end) as bad from labels where doc_id is not null group by doc_id),
asked as (select host, try_cast(nullif(regexp_extract(path, '/([0-9]{{1,18}})(?:\.[A-Za-z]+)?/?$', 1), '') as bigint) as doc_id from parted),
counted as (select host, count(bad) as n, coalesce(sum(bad), 0) as k from asked left join (select * from known where bad is not null) using (doc_id) group by host),
bare as (select *, regexp_replace(regexp_replace(host, ':[0-9]*$', ''), '\.$', '') as b from counted),
two as (select *, array_to_string(list_slice(string_split(b, '.'), -2, -1), '.') as t, regexp_matches(b, '^[0-9.]+$|^\[') as address,
  array_to_string(list_slice(string_split(b, '.'), -2, -1), '.') in ('co.uk', 'org.uk', 'ac.uk', 'gov.uk', 'com.au', 'net.au', 'org.au', 'co.jp', 'ne.jp', 'or.jp', 'com.br', 'com.cn', 'com.tr', 'com.mx', 'co.in', 'co.nz', 'co.za', 'co.kr') as long from bare),
hosts as (select host, n, k, case when address then b when long then array_to_string(list_slice(string_split(b, '.'), -3, -1), '.') else t end as domain,
  case when address then '' when long then t else string_split(b, '.')[-1] end as suffix from two),
domains as (select suffix, domain, sum(n) as n, sum(k) as k from hosts group by all),
suffixes as (select suffix, sum(n) as n, sum(k) as k from domains group by all),
whole as (select case when sum(n) > 0 then sum(k) / sum(n) else 0.5 end as m from suffixes),
levels as (select 0 as level, n, k from suffixes union all select 1, n, k from domains union all select 2, n, k from hosts),
moments as (select level, any_value(m) as m, sum(n) as n, sum(n * n) as n2, count(*) as j, sum(n * pow(k / n - m, 2)) as spread from levels, whole where n > 0 group by level),
between_ as (select level, m, j, (spread - (j - 1) * m * (1 - m)) / nullif(n - n2 / n, 0) as v from moments),
strengths as (select level, case when j < 2 or m * (1 - m) <= 0 or v is null or v <= 0 then 1000.0 else least(1000.0, greatest(2.0, m * (1 - m) / v - 1)) end as s from between_),
s as (select m, coalesce((select s from strengths where level = 0), 1000.0) as s0, coalesce((select s from strengths where level = 1), 1000.0) as s1, coalesce((select s from strengths where level = 2), 1000.0) as s2 from whole),
prior as (select h.host, h.n, h.k, s2, (d.k - h.k + s1 * ((u.k - d.k + s0 * m) / (u.n - d.n + s0))) / (d.n - h.n + s1) as p
  from hosts h join domains d using (suffix, domain) join suffixes u using (suffix), s),
share as (select host, (k + s2 * p) / (n + s2) as q, n + s2 as w from prior),
low as (select host, case when exists (select 1 from hosts where n > 0) then q - 1.6449 * sqrt(q * (1 - q) / (w + 1)) else 0 end as l from share)
select page_id, host, path,
  case when (host = 'example.org' or host like '%.example.org') and starts_with(path, '/en/1') then 'example.org/en/1'
       when (host = 'example.org' or host like '%.example.org') and starts_with(path, '/es/') then 'example.org/es/'
       when (host = 'com' or host like '%.com') and starts_with(path, '/fr/') then 'com/fr/' when (host = 'com' or host like '%.com') and starts_with(path, '/de/') then 'com/de/'
       when (host = 'org' or host like '%.org') and starts_with(path, '/') then 'org/' end as rule,
  case rule when 'org/' then 'allow' when 'com/fr/' then 'allow' when 'com/de/' then 'block' when 'example.org/es/' then 'block' when 'example.org/en/1' then 'block'
       else case when l > 0.4 then 'block' else 'allow' end end as verdict
from parted join low using (host)
"""

DECONTAMINATION = rf"""
with d as (select row_number() over () as r, doc_id, regexp_extract_all({LOWERED}, '[0-9a-z\x{{80}}-\x{{10FFFF}}]+') as w from documents),
i as (select coalesce(cast(item_id as varchar), '') as item, regexp_extract_all({LOWERED}, '[0-9a-z\x{{80}}-\x{{10FFFF}}]+') as w from benchmark),
spots as (select item, w, least(len(w), 10) as size, unnest(range(1, greatest(len(w) - 9, 1) + 1)) as pos from i where len(w) > 0),
windows as (select distinct item, size, array_to_string(list_slice(w, pos, pos + size - 1), ' ') as win from spots),
sizes as (select distinct size from windows),
places as (select r, size, w, unnest(range(1, len(w) - size + 2)) as pos from d, sizes where len(w) >= size),
hits as (select r, pos, size, item from (select r, pos, size, array_to_string(list_slice(w, pos, pos + size - 1), ' ') as win from places) join windows using (size, win)),
words as (select r, count(distinct p) as n from (select r, unnest(range(pos, pos + size)) as p from hits) group by r),
items as (select r, count(*) as n, string_agg(item, ',' order by item) as names from (select distinct r, item from hits) group by r)
select doc_id, cast(len(w) as bigint) as n_words, coalesce(words.n, 0) as n_hit, coalesce(items.n, 0) as n_items, sha256(coalesce(names, '')) as items_sha256, coalesce(words.n, 0) > 0 as contaminated
from d left join words using (r) left join items using (r)
"""

LINE_RULES = rf"""
with d as (select row_number() over () as r, doc_id, coalesce(text, '') as t, {BLANK_WORDS.format("coalesce(text, '')")} as w from documents),
spots as (select r, w, unnest(range(1, len(w) - 1)) as pos from d where len(w) >= 3),
again as (select r, pos from (select r, pos, count(*) over (partition by r, w[pos] || ' ' || w[pos + 1] || ' ' || w[pos + 2]) as c from spots) where c > 1),
repeated as (select r, count(distinct p) as n from (select r, unnest([pos, pos + 1, pos + 2]) as p from again) group by r),
split as (select r, unnest(string_split(t, chr(10))) as line from d),
lines as (select r, line, length(translate(line, {BLANKS}, '')) as n from split where length(translate(line, {BLANKS}, '')) > 0),
judged as (select distinct r, line, n,
  (length(line) - length(translate(line, '#*$%&|<>~^_=+{{}}[]\@', ''))) * 10 > n or ((length(line) - length(translate(line, '!?', ''))) * 12 > n and length(line) - length(translate(line, '!?', '')) > 2)
  or (regexp_matches(line, '\p{{Lu}}') and not regexp_matches(line, '\p{{Ll}}') and n > 12) or not regexp_matches(line, '[\p{{L}}\p{{N}}]')
  or length(line) - length(translate(line, '|»›→•', '')) >= 3
  or regexp_matches(lower(line), '^\s*(?:home|menu|log ?in|sign in|search|contact|about(?: us)?|next|previous|share|tweet|print|read more|back to top|skip to \w+)\s*$')
  or regexp_matches(lower(line), 'all rights reserved|(?:un)?licen[sc]ed under|general public license|copyright|©|cookies? (?:policy|settings)|uses? cookies|privacy policy|terms of (?:use|service)|subscribe to|sign up for|enable javascript|lorem ipsum|click here') as fails
  from lines),
passed as (select r, sum(n) as n from judged where not fails group by r),
doubled as (select r, count(*) - count(distinct line) as n from lines group by r),
counts as (select doc_id, cast(len(w) as bigint) as n_words, cast(length(translate(t, {BLANKS}, '')) as bigint) as word_chars, cast(length(t) - length(translate(t, '#*$%&|<>', '')) as bigint) as n_symbols,
  coalesce(doubled.n, 0) as n_dup_lines, coalesce(repeated.n, 0) as n_repeat_words, cast(coalesce(passed.n, 0) as bigint) as left_chars
  from d left join repeated using (r) left join passed using (r) left join doubled using (r))
select *, n_words < 50 or 100 * n_repeat_words > 50 * n_words as base_failed, not base_failed and left_chars >= 0.5 * word_chars as kept from counts
"""

JACCARD = rf"""
with recursive d as (select doc_id, {BLANK_WORDS.format(LOWERED)} as w from documents),
spots as (select doc_id, w, unnest(range(1, greatest(len(w) - 4, 1) + 1)) as pos from d where len(w) > 0),
s as (select distinct doc_id, array_to_string(list_slice(w, pos, pos + 4), ' ') as shingle from spots),
n as (select doc_id, count(*) as n from s group by doc_id),
shared as (select x.doc_id as a, y.doc_id as b, count(*) as k from s x join s y using (shingle) where x.doc_id <> y.doc_id group by all),
links as (select a, b from shared join n p on p.doc_id = a join n q on q.doc_id = b where 100 * k >= 80 * (p.n + q.n - k)),
reach(a, b) as (select doc_id, doc_id from d union select r.a, l.b from reach r join links l on r.b = l.a)
select d.doc_id, coalesce(n.n, 0) as n_shingles, c.component_id from d left join n using (doc_id) join (select a as doc_id, min(b) as component_id from reach group by a) c using (doc_id)
"""

_LEAF = " || ".join(f"coalesce(strlen({c}::varchar) || ':' || {c}, '-')" for c in ("doc_id", "source", "lang", "n_chars", "{0}"))
_RUNS = "partition by {0}, level, pos // 16 order by pos rows between"
_SIBLINGS = """coalesce(string_agg(digest, '') over ({0} unbounded preceding and 1 preceding), '') as l, coalesce(string_agg(digest, '') over ({0} 1 following and unbounded following), '') as r"""

MANIFEST = f"""
with recursive crc_table as (select [list_reduce([i] || range(8), lambda c, k: case when c % 2 = 1 then xor(c // 2, 3988292384) else c // 2 end) for i in range(256)] as crc),
leaves as (select row_number() over () as row, doc_id, source, sha256({_LEAF.format("text")}) as leaf, sha256({_LEAF.format(f"translate(text, '{UPPER}', '{LOWER}')")}) as lowered,
  xor(list_reduce([4294967295] || [ascii(c)::bigint for c in string_split(doc_id::varchar, '')], lambda c, b: xor(c // 256, crc[xor(c, b) % 256 + 1])), 4294967295) as code from documents, crc_table),
first as (select *, row_number() over (partition by source order by doc_id nulls first, leaf) - 1 as pos, count(*) over (partition by source) as n from leaves),
tree as (select 0 as level, source, pos, leaf as digest, n from first
  union all select level + 1, source, pos // 16, sha256(string_agg(digest, '' order by pos)), (n + 15) // 16 from tree where n > 1 group by level, source, pos // 16, n),
subroots as (select source, digest as subroot from tree where n = 1),
upper_ as (select 0 as level, row_number() over (order by source nulls first) - 1 as pos, subroot as digest, count(*) over () as n from subroots
  union all select level + 1, pos // 16, sha256(string_agg(digest, '' order by pos)), (n + 15) // 16 from upper_ where n > 1 group by level, pos // 16, n),
root as (select digest as root from upper_ where n = 1),
steps as (select source, level, pos, {_SIBLINGS.format(_RUNS.format("source"))} from tree where n > 1),
above as (select level, pos, {_SIBLINGS.format(_RUNS.format("1"))} from upper_ where n > 1),
known as (select row, doc_id, f.source, subroot, leaf, case when code % 5 = 0 then lowered else leaf end as start, f.pos,
  (select count(*) from subroots s where s.source < f.source or (s.source is null and f.source is not null)) as place from first f join subroots s2 on s2.source is not distinct from f.source),
path as (select row, s.level, l, r from known k join steps s on s.source is not distinct from k.source and s.pos = k.pos // pow(16, s.level)::bigint
  union all select row, 1000 + a.level, l, r from known k join above a on a.pos = k.place // pow(16, a.level)::bigint),
listed as (select row, list(struct_pack(l := l, r := r) order by level) as path, string_agg(l || r, '' order by level) as proof from path group by row)
select doc_id, leaf, subroot, root, sha256(coalesce(proof, '')) as proof_sha256,
  list_reduce([start] || coalesce([s.l || '|' || s.r for s in path], []), lambda d, s: sha256(split_part(s, '|', 1) || d || split_part(s, '|', 2))) as folded_root,
  list_reduce([start] || coalesce([s.l || '|' || s.r for s in path], []), lambda d, s: sha256(split_part(s, '|', 1) || d || split_part(s, '|', 2))) = root as verified
from known left join listed using (row), root
"""
