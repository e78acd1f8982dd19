"""DuckDB SQL for the operators that SQL can express."""

RULES_SQL = r"""
with t as (select row_number() over () as r, doc_id, coalesce("text", '') as x from documents),
w as (select r, doc_id, x, regexp_extract_all(x, '[^ \t-\r]+') as ws,
      list_filter(string_split(x, chr(10)), lambda s: regexp_matches(s, '[^ \t-\r]')) as ls from t),
p as (select r, unnest(range(1, len(ws) - 1)) as i, ws from w where len(ws) >= 3),
g as (select r, i, ws[i] || ' ' || ws[i + 1] || ' ' || ws[i + 2] as g from p),
d as (select r, i from g qualify count(*) over (partition by r, g) > 1),
c as (select r, count(distinct i + k) as n from d, (values (0), (1), (2)) v(k) group by r),
m as (select w.doc_id, cast(len(ws) as bigint) as n_words,
      cast(length(array_to_string(ws, '')) as bigint) as word_chars,
      cast(length(x) - length(regexp_replace(x, '[#*$%&|<>]', '', 'g')) as bigint) as n_symbols,
      cast(len(ls) - len(list_distinct(ls)) as bigint) as n_dup_lines,
      cast(coalesce(c.n, 0) as bigint) as n_repeat_words,
      cast(len(ls) as bigint) as n_lines,
      cast(length(x) - length(regexp_replace(x, '\p{L}', '', 'g')) as bigint) as n_letters,
      cast(length(x) - length(regexp_replace(x, '\p{Lu}', '', 'g')) as bigint) as n_capitals,
      cast(length(x) - length(replace(x, '!', '')) as bigint) as n_exclamations
      from w left join c using (r)),
b as (select *, cast(case when n_words < 50 then 1 else 0 end
      + case when 100 * n_repeat_words > 50 * n_words then 2 else 0 end
      + case when 100 * n_symbols > 25 * n_words then 4 else 0 end
      + case when n_letters > 0 and 100 * n_capitals > 40 * n_letters then 8 else 0 end
      + case when 100 * n_exclamations > 30 * n_words then 16 else 0 end
      + case when n_lines >= 4 and 100 * n_dup_lines > 50 * n_lines then 32 else 0 end
      + case when word_chars > 20 * n_words then 64 else 0 end
      + case when 2 * n_letters < word_chars then 128 else 0 end as bigint) as fail_bits from m)
select *, 'v2' as policy, (fail_bits & 3) <> 0 as base_failed, fail_bits = 0 as kept from b
"""

CONTAINMENT_SQL = r"""
with it as (select row_number() over () as i, item_id, regexp_extract_all(lower("text"), '[^ \t-\r]+') as ws from benchmark),
sized as (select *, least(len(ws), 5) as m from it where len(ws) >= 1),
isg as (select distinct i, item_id, m, array_to_string(ws[k:k + m - 1], ' ') as g
        from (select i, item_id, ws, m, unnest(range(1, len(ws) - m + 2)) as k from sized)),
n as (select i, item_id, count(*) as n from isg group by all),
d as (select row_number() over () as r, doc_id, regexp_extract_all(lower("text"), '[^ \t-\r]+') as ws from documents),
dsg as (select distinct r, doc_id, m, array_to_string(ws[k:k + m - 1], ' ') as g
        from (select r, doc_id, ws, m, unnest(range(1, len(ws) - m + 2)) as k from d, (select distinct m from sized) where len(ws) >= m)),
c as (select r, doc_id, i, count(*) as n_both from dsg join isg using (g, m) group by all)
select doc_id, item_id, cast(n as bigint) as n_shingles, cast(n_both as bigint) as n_shared,
       round(cast(n_both as double) / n, 6) as containment
from c join n using (i) where n_both >= ceil(0.8 * n - 1e-9)
"""

JACCARD_SQL = r"""
with recursive
d as (select row_number() over () as r, doc_id, regexp_extract_all(coalesce("text", ''), '[^ \t-\r]+') as ws from documents),
s as (select distinct r, g from (
        select r, array_to_string(ws[k:k + 4], ' ') as g
        from (select r, ws, unnest(range(1, len(ws) - 3)) as k from d where len(ws) >= 5)
        union all select r, 'all ' || array_to_string(ws, ' ') from d where len(ws) between 1 and 4)),
n as (select r, count(*) as n from s group by r),
b as (select x.r as a, y.r as b, count(*) as n_both from s x join s y on x.g = y.g and x.r <> y.r group by all),
l as (select a, b from b join n na on na.r = a join n nb on nb.r = b where n_both >= 0.8 * (na.n + nb.n - n_both) - 1e-9),
reach as (select r as a, r as b from d union select reach.a, l.b from reach join l on l.a = reach.b),
cls as (select reach.a as r, min(d.doc_id) as class_id from reach join d on d.r = reach.b group by reach.a),
k as (select a as r, count(*) as n_links from l group by a)
select d.doc_id, cls.class_id, cast(coalesce(k.n_links, 0) as bigint) as n_links
from d join cls using (r) left join k using (r)
"""

TEMPLATES_SQL = r"""
with d as (select row_number() over () as r, doc_id, coalesce("text", '') as x,
           md5(coalesce(cast(doc_id as varchar), '') || chr(10) || coalesce("text", '')) as ident from documents),
p as (select r, doc_id, ident, unnest(string_split(x, chr(10))) as line, unnest(range(1, len(string_split(x, chr(10))) + 1)) as no from d),
w as (select r, doc_id, ident, no, line,
      regexp_extract_all(regexp_replace(line, '[^ \t-\r]*[0-9@][^ \t-\r]*', '<*>', 'g'), '[^ \t-\r]+') as ws from p),
m as (select *, len(ws) as n, array_to_string(ws, ' ') as masked, array_to_string(ws[1:4], ' ') as lead from w where len(ws) > 0),
counted as (select n, lead, masked, any_value(ws) as ws, count(distinct ident) as docs from m group by n, lead, masked),
leaf as (select n, lead, sum(docs) as leaf_docs from counted group by n, lead
         having count(*) > 1 and sum(docs) >= case when n >= 16 then 2 else 8 end),
places as (select n, lead, masked, docs, leaf_docs, unnest(ws) as token, unnest(range(1, len(ws) + 1)) as pos
           from counted join leaf using (n, lead)),
common as (select n, lead, pos, token from places group by n, lead, pos, token having 2 * sum(docs) > any_value(leaf_docs)),
alike as (select n, lead, masked from places join common using (n, lead, pos, token)
          group by n, lead, masked having count(*) - 4 >= greatest(1, 0.6 * (n - 4)) - 1e-9),
owned as (select m.*, case when alike.masked is null then m.masked else '' end as own
          from m left join alike on alike.n = m.n and alike.lead = m.lead and alike.masked = m.masked),
recurring as (select n, lead, own, first(ident order by doc_id nulls last, ident) as keeper from owned
              group by n, lead, own having count(distinct ident) >= case when n >= 16 then 2 else 8 end),
lost as (select r, no from owned join recurring using (n, lead, own) where ident <> keeper)
select doc_id, coalesce(string_agg(line, chr(10) order by no) filter (where lost.no is null), '') as "text",
       cast(count(*) filter (where x <> '') as bigint) as n_lines, cast(count(lost.no) as bigint) as n_dropped
from (select p.*, d.x from p join d using (r)) q left join lost using (r, no) group by r, doc_id
"""

# The same, with documents left whole that share at least half of their words with the keeper of these, and that
# as much of the keeper is made of.
SPARED_TEMPLATES_SQL = TEMPLATES_SQL.replace(
    "lost as (select r, no from owned join recurring using (n, lead, own) where ident <> keeper)",
    """going as (select r, no, ident, keeper, masked, n from owned join recurring using (n, lead, own) where ident <> keeper),
held as (select ident, sum(n) as words from (select distinct ident, masked, n from owned) group by ident),
shared as (select ident, keeper, sum(n) as shared from (select distinct ident, keeper, masked, n from going) group by all),
copies as (select shared.ident from shared join held d on d.ident = shared.ident join held k on k.ident = shared.keeper
           where shared >= 0.5 * greatest(d.words, k.words) - 1e-9),
lost as (select r, no from going where ident not in (select ident from copies))""",
)


def cluster_sql(rounds: int = 3) -> str:
    """Rounds of nearest centroids by their distances, one pair of relations each."""

    def nearest(name: str, centroids: str) -> str:
        return f"""{name} as (
  select r, vec_id, v, cluster, d from (
    select e.r, e.vec_id, e.v, c.cluster, list_sum(list_transform(range(1, 65), lambda i: (e.v[i] - c.v[i]) * (e.v[i] - c.v[i]))) as d
    from e, {centroids} c) qualify row_number() over (partition by r order by d, cluster) = 1)"""

    steps = []
    for n in range(rounds):
        steps.append(nearest(f"near{n}", f"c{n}"))
        steps.append(f"""c{n + 1} as (
  select c.cluster, coalesce(m.v, c.v) as v from c{n} c left join (
    select cluster, list(cast(floor_of as bigint) order by pos) as v from (
      select cluster, pos, (total - ((total % n) + n) % n) // n as floor_of from (
        select cluster, pos, sum(x) as total, count(*) as n
        from (select cluster, unnest(v) as x, unnest(range(1, 65)) as pos from near{n}) group by all)) group by cluster) m using (cluster))""")
    return f"""
with e as materialized (
  select row_number() over () as r, vec_id, list_transform(embedding, lambda x: cast(floor(64 * cast(x as double)) as bigint)) as v
  from embeddings where len(embedding) = 64 and len(list_filter(embedding, lambda x: x is not null and isfinite(x))) = 64),
c0 as (select row_number() over (order by h, vec_id) - 1 as cluster, v
       from (select vec_id, v, sha256('1:' || vec_id) as h from e order by h, vec_id limit 16)),
{", ".join(steps)},
{nearest("placed", f"c{rounds}")}
select vec_id, cast(cluster as integer) as cluster, cast(d as bigint) as distance,
       cast(sum(d) over (partition by cluster) as bigint) as cluster_inertia, cast(sum(d) over () as bigint) as inertia,
       sha256(array_to_string(c.v, ',')) as centroid_sha256
from placed join c{rounds} c using (cluster)
"""


CLUSTER_SQL = cluster_sql()
