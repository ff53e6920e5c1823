"""SQL twins, for DuckDB, of the queries that SQL can express and run over whole tables."""

from __future__ import annotations

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"

OP5 = f"""
with recursive w as (select doc_id, regexp_extract_all(translate(coalesce(text, ''), '{UPPER}', '{LOWER}'), '[^\\x20\\x09-\\x0D]+') as words from documents),
l as (select doc_id, case when len(words) >= 4 then list_distinct(list_transform(range(len(words) - 3), lambda i: array_to_string(words[i + 1 : i + 4], ' ')))
      when len(words) > 0 then [array_to_string(words, ' ')] else [] end as shingles from w),
s as (select doc_id, unnest(shingles) as shingle from l),
n as (select doc_id, cast(len(shingles) as bigint) as n_shingles from l),
p as (select a.doc_id as x, b.doc_id as y, count(*) as same from s a join s b on a.shingle = b.shingle and a.doc_id < b.doc_id group by 1, 2),
e as (select x, y from p join n a on a.doc_id = x join n b on b.doc_id = y where 100 * same >= 80 * (a.n_shingles + b.n_shingles - same)),
both_ways as (select x, y from e union select y, x from e),
reach(doc_id, node) as (select doc_id, doc_id from n union select r.doc_id, y from reach r join both_ways on r.node = x)
select doc_id, n_shingles, min(node) as component_id, doc_id = min(node) as kept from n join reach using (doc_id) group by doc_id, n_shingles
"""

OP10 = """
with d as (select doc_id, source, cast(coalesce(len(regexp_extract_all(text, '[^\\x20\\x09-\\x0D]+')), 0) as bigint) as size, md5(coalesce(cast(doc_id as varchar), '')) as place from documents),
p as (select source, cast(sum(size) as bigint) as source_size from d group by source),
w as (select *, 2.0::double * source_size as most, case (row_number() over (order by source nulls last) - 1) % 3 when 0 then 5.0::double when 1 then 2.0::double else 1.0::double end as weight from p),
l as (select *, ((sum(source_size) over ())::double * 1.5::double - coalesce(sum(most) over before, 0.0)) / (sum(weight) over () - coalesce(sum(weight) over before, 0.0)) as level
      from w window before as (order by most / weight, source nulls last rows between unbounded preceding and 1 preceding)),
h as (select first(level order by most / weight, source nulls last) as level from l where level * weight < most),
t as (select source, source_size, case when h.level is null then most else least(most, h.level * weight) end as target from l, h),
b as (select d.*, t.source_size, t.target, cast(floor(t.target) as bigint) as goal,
      cast(coalesce(sum(size) over (partition by d.source order by place, doc_id, size rows between unbounded preceding and 1 preceding), 0) as bigint) as begin
      from d join t on d.source is not distinct from t.source)
select doc_id, source, size, source_size, target,
       case when source_size = 0 then 0 else size * (goal // source_size) + greatest(0, least(begin + size, goal % source_size) - begin) end as taken from b
"""

OP13 = """
with d as (select row_number() over () as row, doc_id, regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+') as words from documents),
p as (select row, i, words[i + 1] as word, case when i + 35 <= len(words) then array_to_string(words[i + 1 : i + 35], ' ') end as win from (select row, words, unnest(range(len(words))) as i from d)),
t as (select win from p where win is not null group by win having count(*) > 1),
c as (select row, i, word, max(case when t.win is not null then 1 else 0 end) over (partition by row order by i rows between 34 preceding and current row) as gone from p left join t on p.win = t.win),
k as (select row, cast(sum(gone) as bigint) as n_removed, string_agg(word, ' ' order by i) filter (where gone = 0) as kept from c group by row)
select doc_id, cast(len(words) as bigint) as n_words, coalesce(n_removed, 0) as n_removed, sha256(coalesce(kept, '')) as kept_sha256 from d left join k on d.row = k.row
"""

OP12 = f"""
with t as (select row_number() over () as row, coalesce(lang, 'und') as lang, translate(coalesce(text, ''), '{UPPER}', '{LOWER}') as text from documents),
p as (select lang, regexp_extract_all(unnest(regexp_extract_all(text, '[^.,;:!?\\x0A-\\x0D]+')), '[^\\x20\\x09]+') as words from t),
s as (select lang, words, unnest(range(len(words))) as i from p),
g as (select lang, len, array_to_string(words[i + 1 : i + len], ' ') as phrase from (select lang, words, i, unnest(range(1, least(5, len(words) - i) + 1)) as len from s)),
f as (select lang, len, phrase, count(*) as f from g group by lang, len, phrase having len = 1 or count(*) >= 100),
n as (select lang, sum(f) as n from f where len = 1 group by lang),
c as (select lang, len, phrase, string_split(phrase, ' ') as words, f as a from f where len > 1),
k as (select lang, phrase, a, k, array_to_string(words[1 : k], ' ') as x, array_to_string(words[k + 1 :], ' ') as y from (select *, unnest(range(1, len)) as k from c)),
q as (select k.lang, k.phrase, k.a, k, x.f as l, y.f as r, n.n, (1000::hugeint * k.a * n.n) // (x.f::hugeint * y.f) as score
      from k join f x on x.lang = k.lang and x.phrase = k.x join f y on y.lang = k.lang and y.phrase = k.y join n on n.lang = k.lang),
b as (select * from q qualify row_number() over (partition by lang, phrase order by score, k) = 1),
i as (select lang, a, len, words, unnest(range(2, len)) as m from c),
u as (select lang, a, array_to_string(words[o + 1 : o + m], ' ') as phrase from (select *, unnest(range(len - m + 1)) as o from i)),
v as (select lang, phrase, max(a) as longer from u group by lang, phrase),
z as (select b.* from b left join v on v.lang = b.lang and v.phrase = b.phrase where v.longer is null or 100 * v.longer < 100 * b.a)
select lang, row_number() over (partition by lang order by score desc, a desc, phrase) as rank, phrase, a, l, r, cast(n as bigint) as n, cast(score as bigint) as score
from z qualify rank <= 2000
"""
