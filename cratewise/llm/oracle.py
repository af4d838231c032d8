"""The operators' results as DuckDB SQL, where SQL can say them."""

from __future__ import annotations

ORACLE_SQL: dict[str, str] = {}

# Documents in shuffled order lie end to end; a source takes the first floor(target) words of
# that line, which starts again at its end.
ORACLE_SQL["op10_source_mix"] = r"""
with recursive sized as (
  select doc_id, source, row_number() over () as row_no,
    coalesce(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0)::bigint as size,
    md5('mix|' || coalesce(doc_id::varchar, '')) as shuffled
  from documents
), sources as (
  select source, sum(size)::bigint as source_size,
    row_number() over (order by source nulls last) - 1 as source_no
  from sized group by source
), weighed as (
  select *, case source_no % 3 when 0 then 3 when 1 then 1 else 2 end as weight from sources
), filled as (
  select 0 as turn, source_no, weight, source_size, false as capped,
    1.5::double * sum(source_size) over () / sum(weight) over () as level
  from weighed
  union all
  select turn + 1, source_no, weight, source_size, now_capped,
    case when sum(case when now_capped then 0 else weight end) over () = 0 then level
      else (1.5::double * sum(source_size) over ()
        - sum(case when now_capped then 2 * source_size else 0 end) over ())
        / sum(case when now_capped then 0 else weight end) over () end
  from (
    select *, weight * level > 2 * source_size as now_capped,
      bool_or((weight * level > 2 * source_size) <> capped) over () as changed
    from filled
  ) where changed
), targets as (
  select source_no, case when capped then 2.0::double * source_size else weight * level end as target
  from filled where turn = (select max(turn) from filled)
), placed as (
  select d.doc_id, d.size, s.source_size, t.target, floor(t.target)::bigint as take,
    (sum(d.size) over (partition by s.source_no order by shuffled, doc_id, size, row_no)
      - d.size)::bigint as start
  from sized d
  join sources s on d.source is not distinct from s.source
  join targets t using (source_no)
)
select doc_id, size, source_size, target,
  (greatest(0, least(start + size, take) - least(start, take))
   + greatest(0, least(source_size + start + size, take) - least(source_size + start, take))
  )::bigint as taken
from placed
"""

ORACLE_SQL["op9_exact_dedup"] = r"""
with clean as (
  select doc_id, coalesce(length(text), 0) as chars,
    regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]', '', 'g') as body
  from documents
), ranked as (
  select doc_id, body, first_value(doc_id) over best as keep_id,
    row_number() over best as place, count(*) over (partition by body) as group_size
  from clean
  window best as (partition by body order by chars desc, doc_id nulls last)
)
select doc_id, keep_id, group_size, place = 1 as kept, sha256(body) as text_sha256 from ranked
"""

ORACLE_SQL["op3_benchmark_hits"] = r"""
with words as (
  select row_number() over () as row_no, doc_id, coalesce(regexp_extract_all(
    translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+'), []) as words
  from documents
), items as (
  select item_id::varchar as item_id, regexp_extract_all(
    translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') as words
  from benchmark
), item_windows as (
  select distinct item_id, least(13, len(words)) as n, unnest([array_to_string(words[i:i + 12], ' ')
    for i in range(1, greatest(len(words) - 12, 1) + 1)]) as passage
  from items where len(words) > 0
), lengths as (
  select distinct n from item_windows
), places as (
  select row_no, words, n, unnest(range(1, len(words) - n + 2)) as start
  from words, lengths where len(words) >= n
), occurs as (
  select p.row_no, p.start, p.n, w.item_id
  from (select row_no, start, n, array_to_string(words[start:start + n - 1], ' ') as passage
        from places) p
  join item_windows w on w.n = p.n and w.passage = p.passage
), hit as (
  select row_no, count(distinct place) as n_hit
  from (select row_no, unnest(range(start, start + n)) as place from occurs) group by row_no
), found as (
  select row_no, count(distinct item_id) as n_items,
    array_to_string(list_sort(list(distinct item_id)), ',') as listed
  from occurs group by row_no
)
select doc_id, len(words)::bigint as n_words, coalesce(n_hit, 0)::bigint as n_hit,
  coalesce(n_items, 0)::bigint as n_items, sha256(coalesce(listed, '')) as items_sha256,
  coalesce(n_hit, 0) > 0 and 20 * coalesce(n_hit, 0) >= len(words) as contaminated
from words left join hit using (row_no) left join found using (row_no)
"""

ORACLE_SQL["op4_ngram_jaccard"] = r"""
with recursive words as (
  select row_number() over () as row_no, doc_id, coalesce(regexp_extract_all(
    translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x20\x09-\x0D]+'), []) as words
  from documents
), shingles as (
  select distinct row_no, unnest([array_to_string(words[i:i + 4], ' ')
    for i in range(1, greatest(len(words) - 4, 1) + 1)]) as shingle
  from words where len(words) > 0
), sizes as (
  select row_no, count(*) as n from shingles group by row_no
), shared as (
  select a.row_no as a, b.row_no as b, count(*) as n_both
  from shingles a join shingles b on a.shingle = b.shingle and a.row_no < b.row_no
  group by a.row_no, b.row_no
), links as (
  select a, b from shared join sizes x on x.row_no = a join sizes y on y.row_no = b
  where 100 * n_both >= 75 * (x.n + y.n - n_both)
), edges as (
  select a, b from links union all select b, a from links
), reached as (
  select row_no as root, row_no from words
  union
  select r.root, e.b from reached r join edges e on e.a = r.row_no
)
select w.doc_id, coalesce(s.n, 0)::bigint as n_shingles, min(o.doc_id) as component_id
from words w
join reached r on r.root = w.row_no
join words o on o.row_no = r.row_no
left join sizes s on s.row_no = w.row_no
group by w.row_no, w.doc_id, s.n
"""

ORACLE_SQL["op6_substring_dedup"] = r"""
with words as (
  select row_number() over () as row_no, doc_id,
    coalesce(regexp_extract_all(text, '[^\x20\x09-\x0D]+'), []) as words
  from documents
), windows as (
  select row_no, doc_id, start, array_to_string(words[start:start + 12], ' ') as passage
  from (select *, unnest(range(1, len(words) - 11)) as start from words where len(words) >= 13)
), least as (
  select passage, min(doc_id) as first_id from windows group by passage
), covered as (
  select distinct row_no, unnest(range(start, start + 13)) as place
  from windows join least using (passage) where first_id < doc_id or doc_id is null and first_id is not null
), kept as (
  select w.row_no, list(word order by place) as left_words
  from (select row_no, unnest(words) as word, unnest(range(1, len(words) + 1)) as place
        from words) w
  anti join covered c on c.row_no = w.row_no and c.place = w.place
  group by w.row_no
)
select doc_id, len(words)::bigint as n_words,
  (len(words) - coalesce(len(left_words), 0))::bigint as n_removed,
  sha256(coalesce(array_to_string(left_words, ' '), '')) as kept_sha256
from words left join kept using (row_no)
"""

ORACLE_SQL["op12_embedding_near_dedup"] = r"""
with recursive vectors as (
  select row_number() over () as row_no, vec_id, embedding::double[] as v from embeddings
), sound as materialized (
  select * from vectors
  where len(v) > 0 and len([x for x in v if x is null or not isfinite(x)]) = 0
    and len([x for x in v if x <> 0]) > 0
), links as (
  select a.row_no as a, b.row_no as b from sound a join sound b
  on a.row_no <> b.row_no and len(a.v) = len(b.v)
    and list_cosine_similarity(a.v, b.v) >= 0.95
), reached as (
  select row_no as root, row_no from vectors
  union
  select r.root, l.b from reached r join links l on l.a = r.row_no
), classes as (
  select r.root as row_no, min(v.vec_id) as component_id
  from reached r join vectors v using (row_no) group by r.root
), counts as (
  select a as row_no, count(*) as n_links from links group by a
)
select vec_id, coalesce(n_links, 0)::bigint as n_links, component_id,
  vec_id is not distinct from component_id as kept
from vectors join classes using (row_no) left join counts using (row_no)
"""

ORACLE_SQL["op13_collocations"] = r"""
with pieces as (
  select coalesce(lang, 'und') as lang, unnest(regexp_split_to_array(
    translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[.,;:!?\x0A-\x0D]')) as piece
  from documents
), runs as (
  select lang, regexp_extract_all(piece, '[^\x20\x09]+') as words from pieces
), totals as (
  select lang, sum(len(words))::hugeint as n from runs group by lang
), places as (
  select lang, words, size, unnest(range(1, len(words) - size + 2)) as start
  from runs, (select unnest(range(1, 6)) as size) where len(words) >= size
), found as (
  select lang, words[start:start + size - 1] as words, count(*)::hugeint as f
  from places group by all having count(*) >= 100
), inner_phrases as (
  select lang, words[start:start + part - 1] as words, max(f) as within
  from (select *, unnest(range(1, len(words) - part + 2)) as start
        from (select *, unnest(range(2, len(words))) as part from found where len(words) > 2))
  group by all
), cuts as (
  select c.lang, c.words, c.f as a, x.f as l, y.f as r, t.n, c.k,
    (1000 * c.f * t.n) // (x.f * y.f) as score
  from (select *, unnest(range(1, len(words))) as k from found where len(words) > 1) c
  join found x on x.lang = c.lang and x.words = c.words[1:c.k]
  join found y on y.lang = c.lang and y.words = c.words[c.k + 1:]
  join totals t on t.lang = c.lang
), best as (
  select * from cuts qualify row_number() over (partition by lang, words order by score, k) = 1
), ranked as (
  select b.*, array_to_string(b.words, ' ') as phrase, row_number() over (
    partition by b.lang order by b.score desc, b.a desc, array_to_string(b.words, ' ')) as rank
  from best b left join inner_phrases i on i.lang = b.lang and i.words = b.words
  where i.within is null or i.within < b.a
)
select lang, rank::bigint as rank, phrase, a::bigint as a, l::bigint as l, r::bigint as r,
  n::bigint as n, score::bigint as score
from ranked where rank <= 2000
"""
