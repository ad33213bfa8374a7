"""DuckDB text of the operators that SQL can express."""

from __future__ import annotations

DEDUP_SQL = r"""
with x as (
  select doc_id, regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', ' ', 'g') t from documents)
select doc_id, min(doc_id) over same keep_id, count(*) over same group_size,
       row_number() over (partition by t order by doc_id nulls last) = 1 kept, sha256(t) text_sha256
from x window same as (partition by t)"""


def cluster_sql(rounds: int = 10) -> str:
    """Every round as two tables: the assignment of all vectors, and the centroids after it."""
    steps = [r"""
v as materialized (
  select vec_id, row_number() over () row_no, list_transform(embedding, lambda x: floor(1024 * x::double)::bigint) xs
  from embeddings
  where len(embedding) = 64 and len(list_filter(embedding, lambda x: x is not null and isfinite(x))) = 64),
c0 as materialized (
  select (row_number() over (order by sha256('3:' || vec_id), xs) - 1)::int cluster, xs
  from (select * from v order by sha256('3:' || vec_id), xs limit 8))"""]
    assigned = r"""
a{0} as materialized (
  select vec_id, row_no, xs, arg_min(cluster, struct_pack(d := d, c := cluster)) cluster, min(d) distance
  from (
    select v.*, cluster,
           (list_inner_product(v.xs::double[], v.xs::double[]) - 2 * list_inner_product(v.xs::double[], c.xs::double[])
            + list_inner_product(c.xs::double[], c.xs::double[]))::bigint d
    from v cross join c{0} c)
  group by all)"""
    moved = r"""
c{1} as materialized (
  select c.cluster, coalesce(m.xs, c.xs) xs
  from c{0} c left join (
    select cluster, list(((s - ((s % n) + n) % n) // n)::bigint order by k) xs
    from (select cluster, k, sum(x)::bigint s, count(*) n
          from (select cluster, unnest(xs) x, generate_subscripts(xs, 1) k from a{0}) group by cluster, k)
    group by cluster) m using (cluster))"""
    for k in range(rounds):
        steps += [assigned.format(k), moved.format(k, k + 1)]
    steps.append(assigned.format(rounds))
    return f"""with {','.join(steps)}
select vec_id, cluster, distance, (sum(distance) over (partition by cluster))::bigint cluster_inertia,
       (sum(distance) over ())::bigint inertia, sha256(array_to_string(c.xs, ',')) centroid_sha256
from a{rounds} a join c{rounds} c using (cluster)"""


COLLOCATION_SQL = r"""
with p as (
  select lang, unnest(string_split_regex(t, '[.,;:!?\x0A-\x0D]')) p
  from (select coalesce(lang, 'und') lang,
               translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') t from documents)),
w as (select lang, regexp_extract_all(p, '[^\x20\x09]+') ws from p),
n as (select lang, sum(len(ws))::bigint n from w group by lang),
g as (
  select lang, m, unnest(list_transform(range(1, len(ws) - m + 2), lambda i: ws[i:i + m - 1])) ph
  from w, range(1, 5) t(m) where len(ws) >= m),
f as (select lang, m, ph, count(*)::bigint a from g group by all having count(*) >= 30),
k as (select lang, m, ph, a, unnest(range(1, m)) k from f where m > 1),
s as (
  select k.lang, k.m, k.ph, k.a, k.k, x.a l, y.a r, ((2000000::hugeint * k.a) // (x.a::hugeint + y.a))::bigint score
  from k join f x on x.lang = k.lang and x.ph = k.ph[1:k.k] join f y on y.lang = k.lang and y.ph = k.ph[k.k + 1:k.m]),
b as (select *, row_number() over (partition by lang, ph order by score, k) place from s),
u as (
  select lang, ph, max(a) above from (
    select lang, a, unnest(list_transform(range(1, m - j + 2), lambda i: ph[i:i + j - 1])) ph
    from f, range(2, 4) t(j) where m > j) group by lang, ph),
d as (
  select b.* from b left join u on u.lang = b.lang and u.ph = b.ph
  where place = 1 and (u.above is null or 100 * u.above < 80 * b.a)),
o as (
  select *, array_to_string(ph, ' ') phrase,
         row_number() over (partition by lang order by score desc, a desc, array_to_string(ph, ' ')) "rank" from d)
select o.lang, "rank", phrase, a, l, r, n.n, score from o join n on n.lang = o.lang where "rank" <= 2000"""
