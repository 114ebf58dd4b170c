r"""DuckDB SQL for the operators that SQL can express."""

from __future__ import annotations

_SPACE = r"[\x20\x09-\x0D]+"
_WORD = r"[^\x20\x09-\x0D]+"
_VARIABLE = r"[^\x20\x09-\x0D]*[0-9][^\x20\x09-\x0D]*"

OP1 = rf"""
with parts as (
  select doc_id, unnest(string_split(text, chr(10))) as content,
         generate_subscripts(string_split(text, chr(10)), 1) as line
  from documents
), marked as (
  select doc_id, line, trim(regexp_replace(content, '{_SPACE}', ' ', 'g')) as exact,
         trim(regexp_replace(regexp_replace(content, '{_VARIABLE}', '<*>', 'g'), '{_SPACE}', ' ', 'g')) as template
  from parts
), parsed as materialized (
  select doc_id, line, template, exact, len(string_split(template, ' ')) as words,
         array_to_string(string_split(template, ' ')[1:3], ' ') as lead
  from marked where template <> ''
), busy as (
  select words, lead from parsed where words > 3
  group by all having count(distinct template) > 1 and count(*) >= 3
), templates as materialized (
  select distinct words, lead, template from parsed semi join busy using (words, lead)
), places as materialized (
  select words, lead, template, unnest(string_split(template, ' ')) as word,
         generate_subscripts(string_split(template, ' '), 1) as place
  from templates
), counts as (
  select words, lead, place, word, count(*) as n from places group by all
), shared as (
  select words, lead, place, word from counts
  qualify row_number() over (partition by words, lead, place order by n desc, word) = 1
      and 2 * n > sum(n) over (partition by words, lead, place)
), near as (
  select words, lead, template from places join shared using (words, lead, place, word)
  group by all having count(*) >= 0.8 * words
), named as materialized (
  select p.doc_id, p.line, p.words, p.lead, case when n.template is null then p.template end as own
  from parsed p left join near n on p.words = n.words and p.lead = n.lead and p.template = n.template
), recurring as (
  select words, lead, own, min((doc_id, line)) as first from named
  group by all having count(distinct doc_id) >= 3
), passages as (
  select exact, min((doc_id, line)) as first from parsed where words > 50
  group by exact having count(distinct doc_id) >= 2
), gone as (
  select n.doc_id, n.line from named n
  join recurring r on n.words = r.words and n.lead = r.lead and n.own is not distinct from r.own
  where (n.doc_id, n.line) <> r.first
  union
  select p.doc_id, p.line from parsed p join passages s on p.exact = s.exact
  where p.words > 50 and (p.doc_id, p.line) <> s.first
), kept as (
  select p.doc_id, count(*) as n_lines, count(g.line) as n_dropped,
         coalesce(string_agg(p.content, chr(10) order by p.line) filter (g.line is null), '') as kept
  from parts p left join gone g on p.doc_id = g.doc_id and p.line = g.line
  group by p.doc_id
)
select d.doc_id, coalesce(n_lines, 0) as n_lines, coalesce(n_dropped, 0) as n_dropped,
       coalesce(n_dropped > 0 and not regexp_matches(kept, '{_WORD}'), false) as emptied,
       sha256(coalesce(kept, '')) as kept_sha256
from documents d left join kept k on d.doc_id = k.doc_id
"""

_RULES = (("block", "example.org", "/en/1"), ("block", "example.org", "/es/"), ("allow", "com", "/fr/"),
          ("block", "com", "/de/"), ("allow", "org", "/"))  # longest first


def _by_rule(result: str) -> str:
    cases = " ".join(
        f"when (host = '{host}' or ends_with(host, '.{host}')) and starts_with(path, '{path}') "
        f"then '{verdict if result == 'verdict' else host + path}'"
        for verdict, host, path in _RULES
    )
    return f"case {cases} end"


def _level(source: str, level: int) -> str:
    """Wildcards for the children of variable nodes at one level of the path tree."""
    node = f"array_to_string(segments[1:{level - 1}], '/')" if level > 1 else "''"
    return f"""
t{level} as materialized (
  with variable as (
    select host, {node} as node from {source} where len(segments) >= {level}
    group by host, node having count(distinct segments[{level}]) > 10 and sum(n) < 3 * count(distinct segments[{level}])
  )
  select s.host, original, n, known, blocked,
         case when v.host is not null and len(segments) >= {level}
              then list_concat(list_concat(segments[1:{level - 1}], ['*']), segments[{level + 1}:])
              else segments end as segments
  from (select *, {node} as node from {source}) s left join variable v on s.host = v.host and s.node = v.node
)"""


OP4 = rf"""
with split as (
  select page_id,
         coalesce(translate(regexp_extract(url, '://([^/?#]*)', 1),
                            'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '') as host,
         coalesce(regexp_extract(url, '://[^/?#]*([^?#]*)', 1), '') as path
  from pages
), rows as materialized (
  select page_id, host, path, {_by_rule("rule")} as rule, {_by_rule("verdict")} as ruled,
         list_transform(string_split(regexp_replace(path, '^/', ''), '/'),
           lambda s: case when regexp_matches(s, '[0-9]') then '*' || regexp_extract(s, '(\.[A-Za-z]+)$', 1) else s end
         ) as segments
  from split
), tree as (
  select host, segments, segments as original, count(*) as n, count(ruled) as known,
         count(*) filter (ruled = 'block') as blocked
  from rows group by host, segments
), {_level("tree", 1)}, {_level("t1", 2)}, {_level("t2", 3)}
, templates as (
  select host, array_to_string(segments, '/') as template,
         array_to_string(segments[1:len(segments) - 1], '/') as parent, sum(known) as known, sum(blocked) as blocked
  from t3 group by all
), overall as (
  select coalesce(sum(blocked) / nullif(sum(known), 0), 0.5) as rate from templates
), compared as (
  select *, coalesce(abs(blocked / nullif(known, 0) - pool) <= 2.0 * sqrt(pool * (1 - pool) / nullif(known, 0)), false) as alike
  from (select *, sum(blocked) over w / nullif(sum(known) over w, 0) as pool
        from templates window w as (partition by host, parent))
), merged as (
  select *, sum(known) filter (alike) over w as merged_known, sum(blocked) filter (alike) over w as merged_blocked,
         bool_and(alike or known = 0) over w as uniform
  from compared window w as (partition by host, parent)
), effective as (
  select host, template,
         case when alike or (uniform and known = 0) then coalesce(merged_known, 0) else known end as known,
         case when alike or (uniform and known = 0) then coalesce(merged_blocked, 0) else blocked end as blocked
  from merged
), judged as (
  select host, template, known > 0 and (blocked + 2.0 * rate) / (known + 2.0) >= 0.5 as rejected
  from effective, overall
)
select page_id, r.host, path, rule, coalesce(ruled, case when rejected then 'block' else 'allow' end) as verdict
from rows r
join t3 t on r.host = t.host and r.segments = t.original
join judged j on t.host = j.host and array_to_string(t.segments, '/') = j.template
"""

#: sizes, shares and copies of the mix; {documents} is a table or a bracketed select
MIX = rf"""
sized as materialized (
  select *, coalesce(len(regexp_extract_all(text, '{_WORD}')), 0)::bigint as size from {{documents}}
), weighted as (
  select source, sum(size)::bigint as source_size,
         [5, 2, 1][(row_number() over (order by source nulls last) - 1) % 3 + 1] as weight
  from sized group by source
), filled as (
  -- sources in the order in which they reach their limit as the level rises
  select *, sum(source_size) over () as total,
         coalesce(sum(3 * source_size) over (order by 3.0 * source_size / weight
                  groups between unbounded preceding and 1 preceding), 0) as full_before,
         sum(weight) over (order by 3.0 * source_size / weight groups between current row and unbounded following) as weight_left
  from weighted
), level as (
  -- the lowest level that all sources still below their limit can take
  select arg_min((total - full_before) / weight_left, 3.0 * source_size / weight)
           filter (3.0 * source_size / weight >= (total - full_before) / weight_left) as level
  from filled
), targets as (
  select source, source_size, coalesce(least((3 * source_size)::double, level * weight), 0) as target from weighted, level
), drawn as (
  select s.*, source_size, target, coalesce(target / nullif(source_size, 0), 0) as rate,
         ('0x' || substr(md5('mix-1:' || coalesce(doc_id::text, md5(text), '')), 1, 13))::bigint / 4503599627370496.0 as u
  from sized s join targets t on s.source is not distinct from t.source
), mixed as (
  select *, (floor(rate) + case when u < rate - floor(rate) then 1 else 0 end)::bigint as copies from drawn
)"""

OP9 = f"with {MIX.format(documents='documents')} select doc_id, size, source_size, target, size * copies as taken from mixed"

OP11 = """
with rows as (
  select vec_id, case when vec_id % 7 = 0 then (label + 1) % 10 else label end as label,
         [floor(256 * x::double) for x in embedding] as vector
  from embeddings
  where vec_id is not null and label is not null and embedding is not null
    and len(list_filter(embedding, lambda x: x is null or not isfinite(x))) = 0
), scored as (
  select a.vec_id as anchor_id, b.vec_id as other_id, a.label = b.label as same, list_inner_product(a.vector, b.vector)::bigint as score
  from rows a join rows b on a.vec_id <> b.vec_id
  where a.vec_id % 50 = 0
), positives as (
  select anchor_id, other_id as positive_id, score as positive_score from scored where same
  qualify row_number() over (partition by anchor_id order by score desc, other_id) <= 5
), lower as (
  select anchor_id, positive_id, other_id as negative_id, positive_score, score as negative_score,
         (row_number() over (partition by anchor_id, positive_id order by score desc, other_id))::int as rank
  from positives join scored using (anchor_id)
  where not same and 50 * positive_score <= 100 * score and 100 * score <= 95 * positive_score
)
select anchor_id, positive_id, rank, negative_id, positive_score, negative_score from lower where rank <= 3"""

_TERM = r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"
_TERMS = f"regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '{_TERM}')"

OP12 = f"""
with texts as (
  select row_number() over () as doc, doc_id, {_TERMS} as words from documents
), sizes as (
  select doc, doc_id, len(words)::bigint as n from texts where len(words) > 0
), total as (
  select count(*)::bigint as docs, sum(n)::bigint as words from sizes
), asked as (
  select item_id, term, count(*)::bigint as times
  from (select item_id, unnest({_TERMS}) as term from (select distinct item_id, text from benchmark)) group by all
), held as (
  select doc, term, count(*)::bigint as tf
  from (select doc, unnest(words) as term from texts) where term in (select term from asked) group by all
), weights as (
  select term, floor(1000 * ln((2 * docs + 2)::double / (2 * df + 1)::double))::bigint as weight
  from (select term, count(*)::bigint as df from held group by term), total
), scored as (
  select item_id, doc_id, sum(times * weight * ((1000000000 * tf) // (1000 * tf + 12 * (75 + (25 * n * docs) // words))))::bigint as score
  from asked join held using (term) join weights using (term) join sizes using (doc), total
  group by item_id, doc, doc_id
), ranked as (
  select item_id, (row_number() over (partition by item_id order by score desc, doc_id))::int as rank, doc_id, score
  from scored where score > 0 and doc_id is not null
)
select * from ranked where rank <= 20"""

# the smallest id that links lead to, in a table links(a, b) that holds both directions
_REACHED = """reached as (
  select a as id, b as other from links
  union
  select r.id, l.b from reached r join links l on r.other = l.a
), lowest as (
  select id, min(other) as component from reached group by id
)"""

OP2 = f"""
with recursive usable as (
  select vec_id, min(v) as v
  from (select vec_id, embedding::double[] as v from embeddings where vec_id is not null)
  where len(list_filter(v, lambda x: x is null or not isfinite(x))) = 0 and len(list_filter(v, lambda x: x <> 0)) > 0
  group by vec_id
), links as materialized (
  select x.vec_id as a, y.vec_id as b from usable x join usable y on x.vec_id <> y.vec_id
  where list_cosine_similarity(x.v, y.v) >= 0.9
), {_REACHED}, counted as (
  select a, count(*) as n from links group by a
), ids as (
  select distinct vec_id from embeddings where vec_id is not null
)
select vec_id, coalesce(n, 0) as n_links, least(vec_id, coalesce(component, vec_id)) as component_id,
       vec_id <= coalesce(component, vec_id) as kept
from ids left join counted on a = vec_id left join lowest on id = vec_id
union all
select null, 0, null, true from embeddings where vec_id is null"""

OP6 = """
with raw as (
  select doc_id, hex(encode(coalesce(text, ''))) as h from documents
), windows as materialized (
  select doc_id, p, substr(h, 2 * p + 1, 100) as w
  from (select doc_id, h, unnest(range(len(h) // 2 - 49)) as p from raw where len(h) >= 100)
), firsts as (
  select w, min(doc_id) as lowest from windows group by w
), hits as (
  select doc_id, p, p - lag(p) over (partition by doc_id order by p) as gap
  from windows join firsts using (w) where doc_id > lowest
), numbered as (
  select doc_id, p, sum((gap is null or gap > 50)::int) over (partition by doc_id order by p) as span from hits
), spans as (
  select doc_id, span, min(p) as low, max(p) + 50 as high from numbered group by doc_id, span
), parts as (
  select doc_id, span, low, high, lag(high, 1, 0) over (partition by doc_id order by span) as since from spans
), cut as (
  select doc_id, sum(high - low) as n_removed, count(*) as n_spans, max(high) as last_high,
         string_agg(substr(h, 2 * since + 1, 2 * (low - since)), '' order by span) as before
  from parts join raw using (doc_id) group by doc_id
)
select doc_id, len(h) // 2 as n_bytes, coalesce(n_removed, 0)::bigint as n_removed, coalesce(n_spans, 0) as n_spans,
       sha256(unhex(coalesce(before, '') || substr(h, 2 * coalesce(last_high, 0) + 1))) as kept_sha256
from raw left join cut using (doc_id)"""

OP8 = f"""
with recursive worded as (
  select doc_id, regexp_extract_all(coalesce(text, ''), '{_WORD}') as words from documents
), runs as materialized (
  select doc_id, run, count(*) as times from (
    select doc_id, words[k:k + 4] as run
    from (select doc_id, words, unnest(range(1, greatest(len(words) - 3, 2))) as k from worded where len(words) > 0)
  ) group by doc_id, run
), sizes as materialized (
  select doc_id, sum(times)::bigint as n from runs group by doc_id
), copies as (
  select list(run order by run) as all_runs, list(times order by run) as all_times, doc_id from runs group by doc_id
), firsts as (
  select doc_id, min(doc_id) over (partition by all_runs, all_times) as copy_of from copies
), shared as (
  select x.doc_id as a, y.doc_id as b, sum(least(x.times, y.times)) as n
  from runs x join runs y on x.run = y.run and x.doc_id <> y.doc_id group by a, b
), links as materialized (
  select a, b from shared s join sizes x on x.doc_id = a join sizes y on y.doc_id = b
  where 5 * s.n >= 4 * (x.n + y.n - s.n)
), {_REACHED}
select d.doc_id, coalesce(n, 0) as runs, coalesce(copy_of, d.doc_id) as copy_of,
       least(d.doc_id, coalesce(component, d.doc_id)) as component_id,
       d.doc_id <= coalesce(component, d.doc_id) as kept
from documents d left join sizes using (doc_id) left join firsts using (doc_id) left join lowest on id = d.doc_id"""

ORACLES = {
    "op1_line_dedup": OP1, "op2_near_vectors": OP2, "op4_url_filter": OP4, "op6_suffix_dedup": OP6, "op8_near_text": OP8,
    "op9_mixing": OP9, "op11_hard_negatives": OP11, "op12_lexical_search": OP12,
}
