"""SQL of those queries of this package that SQL can express, written apart from them."""

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"

#: The 256 remainders of the checksum come from its polynomial; the letters of a run are one or two bytes each.
SPELLING_VARIANTS = f"""
with remainders as (
  select list(list_reduce(list_prepend(i, range(8)), lambda c, k: case when c & 1 = 1 then xor(c >> 1, 3988292384) else c >> 1 end) order by i) as table_
  from range(256) r(i)
), runs as (
  select doc_id, unnest(regexp_extract_all(translate(text, '{UPPER}', '{LOWER}'), '[A-Za-z\\x{{00C0}}-\\x{{00FF}}]+')) as run from documents
), counted as (
  select doc_id, run, count(*) as times from runs where length(run) >= 6 group by all
), summed as (
  select run, times, xor(4294967295, list_reduce(
    list_prepend(4294967295::bigint, flatten(list_transform(string_split(coalesce(doc_id::varchar, '') || ':' || run, ''),
      lambda x: case when ord(x) < 128 then [ord(x)::bigint] else [195::bigint, (ord(x) - 64)::bigint] end))),
    lambda c, b: xor(c >> 8, table_[(xor(c, b) & 255) + 1]))) as h
  from counted, remainders
), made as (
  select case when h % 199 = 0 then left(run, (h % length(run))::int) || substr(run, (h % length(run))::int + 2) else run end as word, times from summed
), words as (
  select word, sum(times)::bigint as n from made where length(word) >= 6 group by word having sum(times) >= 5
), gaps as (
  select word, n, i, left(word, i::int - 1) || substr(word, i::int + 1) as gap
  from (select word, n, unnest(range(1, length(word) + 1)) as i from words)
), pairs as (
  select distinct * from (
    select a.word, b.word as near, b.n as near_n from gaps a join gaps b using (gap, i) where a.word <> b.word
    union all
    select w.word, g.word, g.n from words w join gaps g on g.gap = w.word
    union all
    select g.word, w.word, w.n from words w join gaps g on g.gap = w.word
  )
), best as (
  select word, count(*) as n_near, first(near order by near_n desc, near) as near, max(near_n) as near_n from pairs group by word
), forms as (
  select w.word, w.n, coalesce(n_near, 0) as n_near, case when near_n >= 5 * n then near end as form, case when near_n >= 5 * n then near_n end as form_n
  from words w left join best b on b.word = w.word
), walk as (
  with recursive steps(word, here, depth) as (
    select word, word, 0 from forms
    union all
    select s.word, f.form, depth + 1 from steps s join forms f on f.word = s.here where f.form is not null
  )
  select word, last(here order by depth) as root from steps group by word
)
select f.word, form, root, n, n_near, form_n from forms f join walk w on w.word = f.word
"""

TOP_K = """
with vectors as (
  select vec_id, list_transform(embedding, lambda x: floor(256 * x::double)::bigint) as q from embeddings
  where vec_id is not null and embedding is not null
    and len(list_filter(embedding, lambda x: x is null or not isfinite(x))) = 0
), scored as (
  select a.vec_id as query_id, b.vec_id, list_sum(list_transform(list_zip(a.q, b.q), lambda p: coalesce(p[1] * p[2], 0)))::bigint as score
  from vectors a join vectors b on a.vec_id <> b.vec_id where a.vec_id % 50 = 0
), numbered as (
  select *, row_number() over (partition by query_id order by score desc, vec_id) as rank from scored
)
select query_id, rank::int as rank, vec_id, score from numbered where rank <= 5
"""

TERMS = "[^\\x00-\\x2F\\x3A-\\x40\\x5B-\\x60\\x7B-\\x7F]+"
RANKED_SEARCH = f"""
with terms as (
  select doc_id, unnest(regexp_extract_all(translate(text, '{UPPER}', '{LOWER}'), '{TERMS}')) as t from documents
), sizes as (
  select doc_id, count(*) as n from terms group by doc_id
), totals as (
  select count(*) as docs, sum(n)::bigint as l from sizes
), postings as (
  select doc_id, t, count(*) as tf from terms group by all
), weights as (
  select t, floor(1000 * ln((2 * docs + 2)::double / (2 * count(*) + 1)))::bigint as w from postings, totals group by t, docs
), asked as (
  select distinct item_id, unnest(regexp_extract_all(translate(text, '{UPPER}', '{LOWER}'), '{TERMS}')) as t from benchmark
), scored as (
  select item_id, doc_id, sum(w * ((1000000000 * tf) // (1000 * tf + 8 * (10 + (90 * n * docs) // l))))::bigint as score
  from asked join weights using (t) join postings using (t) join sizes using (doc_id), totals group by all
), numbered as (
  select *, row_number() over (partition by item_id order by score desc, doc_id) as rank from scored where score > 0
)
select item_id, rank::int as rank, doc_id, score from numbered where rank <= 10
"""

ORACLE: dict[str, str] = {
    "op11_spelling_variants": SPELLING_VARIANTS,
    "op12_top_k": TOP_K,
    "op13_ranked_search": RANKED_SEARCH,
}
