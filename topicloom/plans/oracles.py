"""DuckDB SQL twins of ``queries``, written independently of the Spark code over the same tables."""

from __future__ import annotations

DOCS = """k as (
  select doc_id, lang, split_part(text, chr(10), 1) as title, doc_id % (select count(*) from embeddings) as vec_id,
         case when doc_id % 5 = 0 then 0 else 1 + doc_id % 37 end as b from documents),
em as (select vec_id, cast(embedding as double[]) as e from embeddings),
p as (
  select k.*, em.e,
         cast(case when b = 0 then 12 + 3 * (doc_id % 6) when b % 3 = 0 then 10 + 4 * (doc_id % 7)
                   when b % 3 = 1 then 44 when doc_id % 2 = 0 then 20 else 90 end as double) / 100 as a,
         cast(case when b = 0 then 30 else 0 end as double) / 100 as s
  from k join em on em.vec_id = k.vec_id),
feed as materialized (
  select concat('doc://', cast(p.doc_id as varchar)) as url, p.doc_id, p.b, p.title, p.lang,
         date '2024-01-25' + cast(p.doc_id % 6 as integer) as ts,
         list_transform(range(1, len(p.e) + 1), lambda i: c.e[i] + p.s * u.e[i] + p.a * p.e[i]) as te,
         list_transform(range(1, len(p.e) + 1), lambda i: c.e[i] + p.s * u.e[i] + p.a * p.e[len(p.e) + 1 - i]) as co,
         case when p.doc_id % 23 = 0 then cast([] as varchar[]) when p.doc_id % 11 = 0 then ['unknown', p.lang]
              else [concat('c', cast(p.b % 8 as varchar)), p.lang] end as cats,
         case when p.doc_id % 23 = 0 then '' when p.doc_id % 11 = 0 then p.lang
              else concat('c', cast(p.b % 8 as varchar), ',', p.lang) end as ck,
         case when b > 0 and b % 3 = 2 and doc_id % 2 = 1 then 'cl_b-1' else concat('cl_b', cast(b as varchar)) end as topic
  from p join em c on c.vec_id = 100 + p.b join em u on u.vec_id = 150 + (p.doc_id // 5) % 3)"""

CATS = """cn as (select * from (values (0,'c0'),(1,'c1'),(2,'c2'),(3,'c3'),(4,'c4'),(5,'c5'),(6,'c6'),
  (7,'c7'),(8,'de'),(9,'en'),(10,'es'),(11,'fr')) as t(i, n)),
cd as (
  select l.n as first_category, r.n as second_category,
         cast(case when l.i = r.i then 0 else 10 + 8 * ((l.i * 7 + r.i * 13) % 10) end as double) / 100 as distance
  from cn l join cn r on l.i <= r.i where l.i = r.i or (l.i + r.i) % 9 <> 0)"""

# category distance of two distinct lists, keyed by their text
KD = """kl as (select distinct ck from feed),
kx as (select a.ck as ka, b.ck as kb, unnest(string_split(a.ck, ',')) as x, string_split(b.ck, ',') as ys from kl a, kl b),
ky as (select ka, kb, x, unnest(ys) as y from kx),
kd as materialized (
  select ka, kb, case when ka = '' or kb = '' then 1.0 else greatest(0.0, least(1.0, avg(coalesce(cd.distance, 1.0)))) end as c
  from ky left join cd on cd.first_category = least(x, y) and cd.second_category = greatest(x, y) group by ka, kb)"""

CLUSTERS = """x as (select vec_id, cast(embedding as double[]) as e, vec_id // 4 as g from embeddings),
y as (
  select x.*, case when g % 4 = 0 then 0 else 1 + g % 13 end as k,
         cast(case when g % 6 = 5 then 40 else 5 + 2 * (g % 4) end as double) / 100 as a from x),
z as (select y.*, cast(case when k = 0 then 17 else 0 end as double) / 100 as s from y),
cf as materialized (
  select concat('cl_', cast(z.vec_id as varchar)) as cluster_id, z.k, z.g, concat('co_', cast(z.k as varchar)) as co_k,
         concat('label ', cast(z.k as varchar), ' ', cast(z.vec_id as varchar)) as cluster_label,
         list_transform(range(1, len(z.e) + 1), lambda i: c.e[i] + z.s * u.e[i] + z.a * z.e[i]) as ce,
         concat('c', cast(z.k % 8 as varchar)) as top,
         case when z.k % 8 = z.g % 8 then 1.0 else 2.0 / 3.0 end as share,
         [concat('c', cast(z.k % 8 as varchar)), concat('c', cast(z.k % 8 as varchar)), concat('c', cast(z.g % 8 as varchar))] as clist,
         [concat('t', cast(z.k % 5 as varchar)), concat('t', cast(z.g % 7 as varchar))] as tags,
         cast(2 + z.vec_id % 17 as bigint) as size, date '2024-01-30' - cast(z.g % 40 as integer) as ts
  from z join x c on c.vec_id = 160 + z.k join x u on u.vec_id = 150 + (z.g // 4) % 2)"""

LINKS = """ls as (
  select cluster_id, co_k as community_id, ts, g % 5 = 0 as unclusterized from cf where ts < date '2024-01-10'
  union all
  select concat('dead_', cast(k as varchar)), co_k, max(ts), false from cf where ts < date '2024-01-10' group by k, co_k)"""

# communities of the links: members, leading category of all members, mean centroid
HYDRATED = """mem as (select ls.community_id, cf.* from ls join cf on cf.cluster_id = ls.cluster_id),
ccount as (select community_id, c, count(*) as n from (select community_id, unnest(clist) as c from mem) group by all),
ctop as (
  select community_id, arg_min(c, struct_pack(o := -n, c := c)) as top, max(n) / sum(n) as share from ccount group by community_id),
cmean as (
  select community_id, list(v order by i) as ce from (
    select community_id, i, avg(ce[i]) as v from (select community_id, ce, unnest(range(1, len(ce) + 1)) as i from mem) group by community_id, i)
  group by community_id),
hyd as (
  select community_id, ctop.top, ctop.share, cmean.ce, sz.size from ctop join cmean using (community_id)
  join (select community_id, cast(sum(size) as bigint) as size from mem group by community_id) sz using (community_id))"""

ROLLED = """rl as (
  select cluster_id, case when g % 6 = 5 then concat('2024-01-30_', sha256(concat('2024-01-30_', cluster_id)), '_', cluster_id)
                          else co_k end as community_id, ts, g % 6 = 5 as unclusterized, size, clist, tags from cf)"""


def _doc_distance(w_title: float, w_content: float, w_cat: float, x: str, y: str, cat: str) -> str:
    title = f"{w_title} * list_distance({x}.te, {y}.te) + " if w_title else ""
    return f"round({title}{w_content} * list_distance({x}.co, {y}.co) + {w_cat} * {cat}, 9)"


def _m1(x: str, y: str, cat: str = "kd.c") -> str:
    return _doc_distance(0.8, 0.1, 0.1, x, y, cat)


def _m2(x: str, y: str, cat: str = "kd.c") -> str:
    return _doc_distance(0.0, 0.8, 0.2, x, y, cat)


def _edges(metric: str, eps: float, source: str = "feed", where: str = "true", name: str = "edges") -> str:
    return f"""{name} as materialized (
  select * from (select a.url as src, b.url as dst, {metric} as d from {source} a join {source} b on a.url < b.url
    join kd on kd.ka = a.ck and kd.kb = b.ck where {where}) where d <= {eps})"""


def _components(edges: str = "edges", name: str = "cc") -> str:
    """Smallest reachable id of every vertex that has an edge."""
    return f"""{name}_e as materialized (select src as u, dst as v from {edges} union all select dst, src from {edges}),
{name}_r(u, r) as (select distinct u, u from {name}_e union select e.v, q.r from {name}_r q join {name}_e e on e.u = q.u),
{name} as materialized (select u, min(r) as root from {name}_r group by u)"""


def _with(*ctes: str) -> str:
    return "with recursive " + ",\n".join(ctes) + "\n"


def _profile(source: str, key: str = "topic") -> str:
    """Centroids, central documents and distances to them for the rows of ``source``."""
    return f"""mean as materialized (
  select {key}, list(v order by i) as ce from (
    select {key}, i, avg(co[i]) as v from (select {key}, co, unnest(range(1, len(co) + 1)) as i from {source}) group by {key}, i)
  group by {key}),
head as materialized (
  select * from (select s.{key}, s.url, s.te, s.co, s.cats, s.ck, round(list_distance(s.co, mean.ce), 9) as gap,
    row_number() over (partition by s.{key} order by round(list_distance(s.co, mean.ce), 9), s.url) as rn
    from {source} s join mean using ({key})) where rn = 1),
gaps as materialized (
  select s.{key}, s.url, {_m1('s', 'head')} as d0, {_m2('s', 'head')} as d1
  from {source} s join head using ({key}) join kd on kd.ka = s.ck and kd.kb = head.ck),
edge as materialized (
  select {key}, """ + ", ".join(
        f"arg_min(url, struct_pack(d := d{m}, u := url)) as min_url{m}, min(d{m}) as min{m}, "
        f"arg_min(url, struct_pack(d := -d{m}, u := url)) as max_url{m}, max(d{m}) as max{m}, avg(d{m}) as avg{m}"
        for m in (0, 1)) + f" from gaps group by {key})"


_BORDERS = ", ".join(f"min_url{m}, min{m}, max_url{m}, max{m}, "
                     f"round(avg{m}, 6) + 0.0 as avg{m}" for m in (0, 1))

_ID = "concat('2024-01-30_', sha256(concat('2024-01-30_', {0})), '_', {0})"
_NOISE = _ID.format("'-1'")


def _layer(source: str, edges: str, start: int, flag: str, other: str) -> str:
    return f"""num as (select root, dense_rank() over (order by root) - 1 + {start} as n from (select distinct root from cc))
select f.url, case when num.n is not null then {_ID.format('cast(num.n as varchar)')} else {other} end as cluster, num.n is not null as {flag}
from feed f left join cc on cc.u = f.url left join num using (root)"""


def _min_samples(n: int) -> str:
    return _with(DOCS, CATS, KD, _edges(_m1("a", "b"), 0.53), f"""
deg as (select u, count(*) + 1 as n from (select src as u from edges union all select dst from edges) group by u),
core as materialized (select u from deg where n >= {n}),
ce as materialized (select src, dst from edges where src in (select u from core) and dst in (select u from core))""",
        _components("ce"), """
top as (select core.u, coalesce(cc.root, core.u) as root from core left join cc using (u)),
fringe as (
  select e.v as u, min(top.root) as root from (select src as u, dst as v from edges union all select dst, src from edges) e
  join top on top.u = e.u where e.v not in (select u from core) group by e.v),
allm as (select u, root from top union all select u, root from fringe)
""") + "select u as url, dense_rank() over (order by root) - 1 as label from allm"


_RESPONSE = """case doc_id % 6
  when 0 then concat('cluster label: ', lang, ' ', source, chr(10), 'cluster tags: ', lang, ', ', source)
  when 1 then concat('Cluster label: "', source, '"', chr(10), 'Cluster tags: [', lang, ' , ', source, ']')
  when 2 then concat('- ', source, chr(10), '- "', lang, ',', source, '"')
  when 3 then text
  when 4 then source
  else concat('"', lang, ' cluster label: ', source, '"', chr(10), '-cluster tags: [', n_chars, ']') end"""

_COMMUNITY_RESPONSE = """case doc_id % 5
  when 0 then concat('COMMUNITY: ', source) when 1 then concat('Community: - "', source, ' ', lang, '"')
  when 2 then text when 3 then concat('- ', source) else concat('"', text, '"') end"""


def _strip(t: str) -> str:
    return f"regexp_replace({t}, '^\\s+|\\s+$', '', 'g')"


def _drop(t: str, marker: str) -> str:
    return f"case when contains({t}, '{marker}') then {_strip(f'''replace({t}, '{marker}', '')''')} else {t} end"


def _dash(t: str) -> str:
    return f"case when starts_with({t}, '-') then {_strip(f'substr({t}, 2)')} else {t} end"


def _wrap(t: str, left: str, right: str) -> str:
    inner = _strip(f"substr({t}, 2, greatest(length({t}) - 2, 0))")
    return f"case when starts_with({t}, '{left}') and ends_with({t}, '{right}') then {inner} else {t} end"


def _steps(first: str, *steps) -> str:
    """A chain of derived tables, one text step each."""
    sql = first
    for step in steps:
        sql = f"select doc_id, {step('t')} as t from ({sql})"
    return sql


def _fits(keys: str, text: str, budget: str, most: int) -> str:
    return (f"select *, sum(length(line)) over (partition by {keys} order by {text} rows unbounded preceding) as used, "
            f"row_number() over (partition by {keys} order by {text}) as rn")


def _assign(rules: str, order: str) -> str:
    return _with(DOCS, CATS, KD, "hist as (select * from feed where ts < date '2024-01-30' and topic not like '%-1')",
                 _profile("hist"), f"""
pairs as (
  select f.url, head.topic as cluster_id, {_m1('f', 'head')} as d0, {_m2('f', 'head')} as d1, edge.max0, edge.max1
  from feed f join head on true join edge on edge.topic = head.topic join kd on kd.ka = f.ck and kd.kb = head.ck),
hits as (
  {rules}),
best as materialized (select * from (
  select *, row_number() over (partition by url order by {order}, cluster_id, rule) as rn from hits) where rn = 1)""")


_RULES = """select url, cluster_id, d0 as distance, 0 as rule, case when d0 < max0 then 'border' else 'regular' end as method
  from pairs where d0 < 0.53 or d0 < max0
  union all
  select url, cluster_id, d1, 1, case when d1 < max1 then 'border' else 'regular' end from pairs where d1 < 0.59 or d1 < max1"""
_PLAIN_RULES = """select url, cluster_id, d0 as distance, 0 as rule, 'regular' as method from pairs where d0 < 0.53
  union all select url, cluster_id, d1, 1, 'regular' from pairs where d1 < 0.59"""


def _cluster_pair(x: str, y: str, w: float, wc: float, shares: bool) -> str:
    factor = f" * {x}.share * {y}.share" if shares else ""
    return f"round(least(1.0, {w} * list_distance({x}.ce, {y}.ce) + {wc} * coalesce(cd.distance, 0.0){factor}), 9)"


_CD_ON = "left join cd on cd.first_category = least(a.top, b.top) and cd.second_category = greatest(a.top, b.top)"

_MIX = """mix as materialized (
  select *, concat('mix_', cast(b % 5 as varchar)) as cluster, b % 5 in (0, 1, 3) and doc_id % 4 <> 0 as first_layer,
         b % 5 in (1, 4) and doc_id % 4 <> 1 as second_layer from feed),
modal as (
  select cluster, 2 * count(*) filter (first_layer) > count(*) as first_layer,
         2 * count(*) filter (second_layer) > count(*) as second_layer from mix group by cluster)"""


ORACLES: dict[str, str] = {
    "daily_scan": _with(DOCS) + "select url, ts as timestamp, length(title) as title_chars, len(cats) as n_categories from feed where ts = date '2024-01-30'",
    "doc_lookup": _with(DOCS) + "select url, lang, ts as timestamp from feed where doc_id in (select doc_id from labels)",
    "unwrap_hits": _with(DOCS) + "select url, case when doc_id % 7 <> 0 then title end as title, ts as timestamp from feed",
    "midnights": "select o_orderkey, cast(o_orderdate as date) as day from orders",
    "live_clusters_ttl": _with(CLUSTERS) + """select cluster_id, ts as timestamp, 'documents' as stage from cf where ts > date '2023-12-31'
        union all select cluster_id, ts, 'communities' from cf where ts >= date '2023-12-31'""",
    "cluster_docs": _with(DOCS, CLUSTERS) + """select url, topic as cluster_id from feed where ts < date '2024-01-30'
        and topic in (select concat('cl_b', cast(k as varchar)) from cf where ts > date '2023-12-31')""",
    "missing_clusters": _with(DOCS, CLUSTERS) + """select distinct topic as cluster_id from feed where ts < date '2024-01-30'
        and topic not in (select concat('cl_b', cast(k as varchar)) from cf)""",
    "backlog_ttl": _with(DOCS) + """select url, topic as cluster_id, title, lang from feed
        where ts < date '2024-01-30' and ts > date '2024-01-26' and topic = 'cl_b-1'""",
    "cluster_sizes": _with(DOCS) + """select topic as cluster_id, min(ts) as timestamp, count(*) as size from feed
        where ts < date '2024-01-30' and topic <> 'cl_b-1' group by topic""",
    "community_links": _with(CLUSTERS, LINKS) + """select cluster_id, k from cf where cluster_id not in (
        select cluster_id from ls where ts >= date '2023-12-31' and not unclusterized)""",
    "community_hydration": _with(CLUSTERS, LINKS, HYDRATED) + """select community_id, size, i - 1 as i, round(ce[i], 6) + 0.0 as v
        from (select *, unnest(range(1, len(ce) + 1)) as i from hyd)""",
    "cluster_titles": _with(DOCS) + """select topic as cluster_id, url, title from feed where ts < date '2024-01-30' and topic in (
        select topic from feed where ts < date '2024-01-30' group by topic having count(*) > 15)""",
    "merge_batch": _with(DOCS) + """select url, ts as timestamp, case when ts = date '2024-01-30' then 'new' else 'backlog' end as origin,
        len(cats) as n_categories from feed where ts >= date '2024-01-29' and doc_id % 29 <> 0""",
    "dedupe_keep_first": """select doc_id, lang, n_chars from (select *, row_number() over (partition by text order by n_chars, doc_id) as rn
        from documents) where rn = 1""",
    "corpus": _with(DOCS) + """select url, topic as cluster, ts = date '2024-01-30' as first_layer, false as second_layer,
        ts <> date '2024-01-30' as old_doc from feed""",
    "document_rows": _with(DOCS) + """select url, case when doc_id % 13 <> 0 then topic end as cluster_id,
        case when doc_id % 17 <> 0 then ts else date '2024-01-30' end as timestamp,
        doc_id % 13 = 0 or topic like '%-1' as unclusterized from feed""",
    "orphans": _with(DOCS, CLUSTERS) + """select distinct concat('cl_b', cast(g as varchar)) as cluster_id, g from cf
        where concat('cl_b', cast(g as varchar)) not in (select topic from feed where ts < date '2024-01-30')""",
    "cluster_ids": _with(DOCS) + """select url, concat(d, '_', h, '_', b) as topic, d as day_part, cast(b as varchar) as label_part from (
        select url, strftime(ts, '%Y-%m-%d') as d, cast(b as varchar) as b, sha256(concat(strftime(ts, '%Y-%m-%d'), '_', cast(b as varchar))) as h from feed)""",
}

_LEAD = "lead as (select * from (select *, row_number() over (partition by b order by url) as rn from feed) where rn = 1)"
ORACLES |= {
    "distances_vec": _with(DOCS, _LEAD) + """select f.url, round(list_distance(f.te, h.te), 6) + 0.0 as euclidean,
        round(list_sum(list_transform(range(1, len(f.te) + 1), lambda i: abs(f.te[i] - h.te[i]))), 6) + 0.0 as manhattan,
        round(1 - list_cosine_similarity(f.te, h.te), 6) + 0.0 as cosine_distance,
        round(list_cosine_similarity(f.te, h.te), 6) + 0.0 as cosine_similarity from feed f join lead h using (b)""",
    "category_distance": _with(DOCS, CATS, KD, _LEAD) + """select f.url, round(kd.c, 6) + 0.0 as distance
        from feed f join lead h using (b) join kd on kd.ka = f.ck and kd.kb = h.ck""",
    "cluster_distance": _with(CLUSTERS, CATS, "lead as (select * from (select *, row_number() over (partition by k order by cluster_id) as rn from cf) where rn = 1)")
    + f"""select a.cluster_id, {_cluster_pair('a', 'b', 0.75, 0.25, True)} as shared,
        {_cluster_pair('a', 'b', 0.8, 0.2, False)} as flat from cf a join lead b using (k) {_CD_ON}""",
    "parse_labels": f"""with l as ({_steps(f"select doc_id, split_part({_RESPONSE}, chr(10), 1) as t from documents",
                                          lambda t: _drop(t, 'cluster label:'), lambda t: _drop(t, 'Cluster label:'),
                                          lambda t: _wrap(t, '"', '"'), _dash)}),
        g as ({_steps(f"select doc_id, split_part({_RESPONSE}, chr(10), 2) as t from documents",
                      lambda t: _drop(t, 'cluster tags:'), lambda t: _drop(t, 'Cluster tags:'), _dash,
                      lambda t: _wrap(t, '"', '"'), lambda t: _wrap(t, '[', ']'))}),
        e as (select doc_id, split_part({_RESPONSE}, chr(10), 2) = '' as bare from documents)
        select l.doc_id, l.t as label, case when e.bare then '' else
          array_to_string(list_transform(string_split(g.t, ','), lambda x: {_strip('x')}), '|') end as tags
        from l join g using (doc_id) join e using (doc_id)""",
    "parse_community_label": f"""select doc_id, t as label from ({_steps(
        f"select doc_id, {_COMMUNITY_RESPONSE} as t from documents", lambda t: _drop(t, 'COMMUNITY:'),
        lambda t: _drop(t, 'Community:'), _dash, lambda t: _wrap(t, '"', '"'))})""",
}
for _name, _metric in (("doc_distance_m1", _m1("f", "h")), ("doc_distance_m2", _m2("f", "h"))):
    ORACLES[_name] = _with(DOCS, CATS, KD, _LEAD) + f"""select f.url, {_metric} as distance
        from feed f join lead h using (b) join kd on kd.ka = f.ck and kd.kb = h.ck"""

_L1 = _edges(_m1("a", "b"), 0.53)
ORACLES |= {
    "eps_edges_m1": _with(DOCS, CATS, KD, """one as materialized (
        select min(url) as url, any_value(te) as te, any_value(co) as co, any_value(ck) as ck, count(*) as n from feed group by te, co, ck)""",
        _edges(_m1("a", "b"), 0.53, "one")) + """select src, dst, d as distance, x.n as src_copies, y.n as dst_copies
        from edges join one x on x.url = src join one y on y.url = dst""",
    "own_distance_edges": _with(DOCS) + """select src, dst, d as distance from (
        select a.url as src, b.url as dst,
          round(case when a.ck = b.ck then list_distance(a.te, b.te) * 0.9 else list_distance(a.te, b.te) end, 9) as d
        from feed a join feed b on a.url < b.url where list_distance(a.te, b.te) <= 0.5 + 1e-9) where d <= 0.4""",
    "neighbor_counts": _with(DOCS, CATS, KD, _L1) + """select url, 1 + (coalesce(n, 0)) as n from feed left join (
        select u, count(*) as n from (select src as u from edges union all select dst from edges) group by u) on u = url""",
    "dbscan_layer1": _with(DOCS, CATS, KD, _L1, _components(), _layer("feed", "edges", 0, "first_layer", _NOISE)),
    "dbscan_layer2": _with(DOCS, CATS, KD, _edges(_m1("a", "b"), 0.59, where="a.b % 3 <> 0 and b.b % 3 <> 0"), _components(),
                           _layer("feed", "edges", 8, "second_layer", "case when f.b % 3 = 0 then 't_1' else 't_-1' end")),
    "dbscan_min3": _min_samples(3), "dbscan_min5": _min_samples(5),
    "split_clusters": _with(DOCS, CATS, KD, _MIX, "half as (select mix.url, mix.te, mix.co, mix.ck, mix.cluster, m.first_layer as f, m.second_layer as s "
                            "from mix join modal m using (cluster) where m.first_layer or m.second_layer)",
                            _edges(_m1("a", "b"), 0.53, "half", "a.cluster = b.cluster and not a.s", "e1"),
                            _edges(_m2("a", "b"), 0.59, "half", "a.cluster = b.cluster and a.s", "e2"),
                            "edges as (select src, dst from e1 union all select src, dst from e2)", _components(), f"""
        lab as (select half.url, half.cluster, cc.root, case when cc.root is not null then
            dense_rank() over (partition by half.cluster, cc.root is null order by cc.root) - 1 end as sub
          from half left join cc on cc.u = half.url),
        changed as (select cluster from lab group by cluster having max(sub) > 0 or count(*) filter (sub is null) > 0)
        select url, cluster as old, case when sub is null then {_NOISE} else
          concat('2024-01-30_', sha256(concat('2024-01-30_', cluster, '_', cast(sub as varchar))), '_',
                 split_part(cluster, '_', -1), '.', cast(sub as varchar)) end as new
        from lab join changed using (cluster)"""),
}

_PROFILE = _with(DOCS, CATS, KD, _profile("feed"))
_CAT_COUNTS = """cat_n as (select topic, c, count(*) as n from (select topic, unnest(cats) as c from feed) group by all),
cat_t as (select topic, string_agg(c, '|' order by n desc, c) filter (rn <= 20) as top,
            string_agg(concat(c, ':', cast(n as varchar)), '|' order by n desc, c) as counted
          from (select *, row_number() over (partition by topic order by n desc, c) as rn from cat_n) group by topic)"""
_TERMS = """w as (select topic, unnest(regexp_extract_all(lower(title), '(\\p{L}{3,})')) as term from feed where topic not like '%-1'),
tf as (select topic, term, count(*) as tf from w group by all),
df as (select term, count(*) as df from tf group by term),
sc as (select topic, term, round(tf * ln(1 + (select count(distinct topic) from feed where topic not like '%-1') / df), 6) as score from tf join df using (term)),
terms as (select * from (select *, row_number() over (partition by topic order by score desc, term) as rank from sc) where rank <= 5)"""
ORACLES |= {
    "centroids": _PROFILE + "select topic as cluster, i - 1 as i, round(ce[i], 6) + 0.0 as v from (select *, unnest(range(1, len(ce) + 1)) as i from mean)",
    "central_docs": _PROFILE + "select topic as cluster, url, gap as distance from head",
    "borders": _PROFILE + f"select topic as cluster, {_BORDERS} from edge",
    "profiles": _PROFILE + f"""select topic as cluster, split_part(topic, '_', -1) as label, born.ts as timestamp, born.n as size,
        head.url as central_url, round(sqrt(list_sum(list_transform(mean.ce, lambda v: v * v))), 6) as centroid_norm, {_BORDERS}
        from edge join head using (topic) join mean using (topic)
        join (select topic, min(ts) as ts, count(*) as n from feed group by topic) born using (topic)""",
    "cluster_rows": _with(DOCS, CATS, KD, _profile("feed"), _CAT_COUNTS, _TERMS) + """
        select concat_ws('-', h[1:8], h[9:12], h[13:16], h[17:20], h[21:32]) as uuid, topic as cluster_id,
          coalesce(t.label, '') as cluster_label, born.ts as timestamp, head.url as central_url, coalesce(t.tags, '') as tags, cat_t.top as top
        from (select topic, md5(topic) as h, url from head) head join cat_t using (topic)
        join (select topic, min(ts) as ts from feed group by topic) born using (topic)
        left join (select topic, string_agg(term, '|' order by rank) as tags, string_agg(term, ' ' order by rank) filter (rank <= 3) as label
                   from terms group by topic) t using (topic)""",
    "top_categories": _with(DOCS, _CAT_COUNTS) + "select topic as cluster, top, counted from cat_t",
    "category_shares": _with(CLUSTERS) + """select cluster_id, c as category, round(n / 3.0, 6) as share from (
        select *, row_number() over (partition by cluster_id order by n desc, c) as rn from (
          select cluster_id, c, count(*) as n from (select cluster_id, unnest(clist) as c from cf) group by all)) where rn <= 2""",
    "size_outliers": _with(DOCS) + """select cluster, size, round(threshold, 6) as threshold from (
        select *, avg(size) over () + 2.0 * stddev_pop(size) over () as threshold from (
          select topic as cluster, count(*) as size from feed where topic not like '%-1' group by topic)) where size > threshold and size > 10""",
    "modal_layer": _with(DOCS, _MIX) + "select cluster, first_layer, second_layer from modal",
    "tfidf_labels": _with(DOCS, _TERMS) + "select topic as cluster, rank, term, score from terms",
    "assign_docs": _assign(_RULES, "distance") + "select url, cluster_id, distance, method from best",
    "assign_docs_as_run": _assign(_PLAIN_RULES, "distance desc") + "select url, cluster_id, distance, method from best",
    "pick_best": _assign(_RULES, "distance") + f""",
        nw as materialized (select *, case when b % 4 = 3 then 'nw_-1' else concat('nw_', cast(b % 11 as varchar)) end as nc from feed),
        nmean as materialized (select nc, list(v order by i) as ce from (select nc, i, avg(co[i]) as v from
          (select nc, co, unnest(range(1, len(co) + 1)) as i from nw) group by nc, i) group by nc),
        nhead as materialized (select * from (select nw.nc, nw.te, nw.co, nw.ck, row_number() over (partition by nw.nc
          order by round(list_distance(nw.co, nmean.ce), 9), nw.url) as rn from nw join nmean using (nc)) where rn = 1),
        nd as (select nw.url, nw.nc, {_m1('nw', 'nhead')} < 0.53 or {_m2('nw', 'nhead')} < 0.59 as near
          from nw join nhead using (nc) join kd on kd.ka = nw.ck and kd.kb = nhead.ck)
        select url, case when cluster_id is not null and (nc like '%-1' or not near) then cluster_id else nc end as cluster,
          case when cluster_id is not null and (nc like '%-1' or not near) then 'old' when nc like '%-1' then 'none' else 'new' end as choice
        from nd left join best using (url)""",
}

_CEDGES = f"""edges as materialized (select src, dst from (
  select a.cluster_id as src, b.cluster_id as dst, {_cluster_pair('a', 'b', 0.75, 0.25, True)} as d
  from cf a join cf b on a.cluster_id < b.cluster_id {_CD_ON}) where d <= 0.216)"""
_SEDGES = f"""tot as (select co_k, sum(size) as size from cf group by co_k),
big as (select co_k from (select *, avg(size) over () + 2.0 * stddev_pop(size) over () as t from tot) where size > t),
edges as materialized (select src, dst from (
  select a.cluster_id as src, b.cluster_id as dst, {_cluster_pair('a', 'b', 0.8, 0.2, False)} as d
  from cf a join cf b on a.cluster_id < b.cluster_id and a.co_k = b.co_k {_CD_ON} where a.co_k in (select co_k from big)) where d <= 0.15)"""
ORACLES |= {
    "communities": _with(CLUSTERS, CATS, _CEDGES, _components(), f"""
        num as (select root, dense_rank() over (order by root) - 1 as n from (select distinct root from cc))
        select cf.cluster_id, case when num.n is not null then {_ID.format('cast(num.n as varchar)')} else {_NOISE} end as community_id
        from cf left join cc on cc.u = cf.cluster_id left join num using (root)"""),
    "append_communities": _with(CLUSTERS, CATS, LINKS, HYDRATED) + f"""
        select cluster_id, community_id, d as distance from (
          select *, row_number() over (partition by cluster_id order by d, community_id) as rn from (
            select cluster_id, community_id, case when d1 < 0.216 and d2 < 0.15 then least(d1, d2) when d1 < 0.216 then d1 else d2 end as d from (
              select a.cluster_id, b.community_id, {_cluster_pair('a', 'b', 0.75, 0.25, True)} as d1, {_cluster_pair('a', 'b', 0.8, 0.2, False)} as d2
              from cf a join hyd b on true {_CD_ON} where a.cluster_id not in (select cluster_id from ls)) where d1 < 0.216 or d2 < 0.15)) where rn = 1""",
    "split_communities": _with(CLUSTERS, CATS, _SEDGES, _components(), f"""
        lab as (select cf.cluster_id, cf.co_k, case when cc.root is not null then
            dense_rank() over (partition by cf.co_k, cc.root is null order by cc.root) - 1 end as sub
          from cf left join cc on cc.u = cf.cluster_id where cf.co_k in (select co_k from big))
        select cluster_id, co_k as old, case when sub is null then {_NOISE} else
          concat('2024-01-30_', sha256(concat('2024-01-30_', co_k, '_', cast(sub as varchar))), '_', split_part(co_k, '_', -1), '.',
                 cast(sub as varchar)) end as new from lab"""),
    "community_rollup": _with(CLUSTERS, ROLLED) + """select community_id, base.size, base.ts as timestamp, base.n as clusters, t.top from
        (select community_id, cast(sum(size) as bigint) as size, min(ts) as ts, count(*) as n from rl group by community_id) base
        join (select community_id, string_agg(c, '|' order by n desc, c) filter (rn <= 20) as top from (
          select *, row_number() over (partition by community_id order by n desc, c) as rn from (
            select community_id, c, count(*) as n from (select community_id, unnest(clist) as c from rl) group by all)) group by community_id) t using (community_id)""",
    "community_link_rows": _with(CLUSTERS, ROLLED) + "select cluster_id, community_id, ts as timestamp, unclusterized from rl",
    "community_tags": _with(CLUSTERS, ROLLED) + "select distinct community_id, unnest(tags) as tag from rl",
    "stale_links": _with(CLUSTERS, LINKS, """lv as (select * from ls where ts >= date '2023-12-31'),
        dead as (select * from lv where cluster_id not in (select cluster_id from cf where ts >= date '2023-12-31'))""") + """
        select 'link' as kind, cluster_id as id from dead
        union all select distinct 'community', community_id from (select community_id from dead union all select community_id from lv where unclusterized)""",
    "upsert_docs": _with(DOCS) + """select url, topic as cluster_id, ts as timestamp, topic = 'cl_b-1' as unclusterized from feed where ts < date '2024-01-29'
        union all select url, case when doc_id % 3 <> 0 then concat('new_', cast(b as varchar)) end, date '2024-01-30', doc_id % 3 = 0
        from feed where ts >= date '2024-01-29'""",
    "category_pairs": """select least(source, lang) as first_category, greatest(source, lang) as second_category,
        round(1.0 / count(*), 6) as distance from documents group by source, lang""",
    "upsert_clusters_partial": _with(CLUSTERS) + """
        select cluster_id, case when g % 2 = 0 and k % 2 = 0 then 'renamed' else cluster_label end as cluster_label,
          case when g % 2 = 0 then date '2024-01-30' else ts end as timestamp, size,
          round(case when g % 2 = 0 and g % 3 <> 0 then ce[2] else ce[1] end, 6) + 0.0 as head from cf
        union all select concat('u_', cluster_id), case when k % 2 = 0 then 'renamed' end, date '2024-01-30', null,
          round(case when g % 3 <> 0 then ce[2] end, 6) + 0.0 from cf where g % 2 <> 0""",
    "upsert_links": _with(CLUSTERS, LINKS, ROLLED) + """select cluster_id, community_id, ts as timestamp, unclusterized from rl
        union all select cluster_id, community_id, ts, unclusterized from ls where cluster_id not in (select cluster_id from rl)""",
    "upsert_communities": _with(CLUSTERS, LINKS, ROLLED, """
        cur as (select ls.community_id, cast(sum(cf.size) as bigint) as size, min(cf.ts) as ts from ls join cf using (cluster_id) group by ls.community_id),
        nw as (select community_id, cast(sum(size) as bigint) as size from rl group by community_id)""") + """
        select community_id, coalesce(nw.size, cur.size) as size, cur.ts as timestamp from cur full join nw using (community_id)""",
    "delete_stale": _with(CLUSTERS, LINKS) + "select cluster_id, community_id, ts as timestamp, unclusterized from ls where cluster_id in (select cluster_id from cf)",
    "cluster_prompt": _with(DOCS, """
        tl as (select topic, url, concat('TITLE: ', title, chr(10)) as line from feed where topic not like '%-1'),
        us as (select *, sum(length(line)) over (partition by topic order by url rows unbounded preceding) as used from tl)""") + """
        select topic as cluster, coalesce(string_agg(line, '' order by url) filter (used <= 4097), '') as prompt from us group by topic""",
    "community_prompt": _with(CLUSTERS, """
        ll as (select co_k, cluster_id as o, concat('LABEL: ', cluster_label, chr(10)) as line from cf),
        la as (select *, sum(length(line)) over (partition by co_k order by o rows unbounded preceding) as used,
          row_number() over (partition by co_k order by o) as rn from ll),
        a as (select co_k, string_agg(line, '' order by o) as t, sum(length(line)) as n from la where used <= 4097 and rn <= 30 group by co_k),
        tl as (select cf.co_k, concat('doc://', cast(d.doc_id as varchar)) as o, concat('TITLE: ', split_part(d.text, chr(10), 1), chr(10)) as line
          from documents d join cf on cf.cluster_id = concat('cl_', cast(d.doc_id % (select count(*) from embeddings) as varchar))),
        ta as (select *, sum(length(line)) over (partition by co_k order by o rows unbounded preceding) as used,
          row_number() over (partition by co_k order by o) as rn from tl),
        b as (select ta.co_k, string_agg(line, '' order by o) as t, sum(length(line)) as n from ta left join a using (co_k)
          where ta.used <= 4097 - coalesce(a.n, 0) and rn <= 30 group by ta.co_k),
        gl as (select co_k, tag as o, concat('TAG: ', tag, chr(10)) as line from (select distinct co_k, unnest(tags) as tag from cf)),
        ga as (select *, sum(length(line)) over (partition by co_k order by o rows unbounded preceding) as used from gl),
        c as (select ga.co_k, string_agg(line, '' order by o) as t from ga left join a using (co_k) left join b using (co_k)
          where ga.used <= 4097 - coalesce(a.n, 0) - coalesce(b.n, 0) group by ga.co_k)""") + """
        select k.co_k as community_id, concat(coalesce(a.t, ''), coalesce(b.t, ''), coalesce(c.t, '')) as prompt
        from (select distinct co_k from cf) k left join a using (co_k) left join b using (co_k) left join c using (co_k)""",
    "core_distances": _with(DOCS, CATS, KD) + f"""select cluster, url, core from (
        select cluster, url, coalesce(max(d) filter (rn <= 2), 0.0) as core from (
          select a.topic as cluster, a.url, {_m1('a', 'b')} as d, row_number() over (partition by a.url order by {_m1('a', 'b')}) as rn
          from feed a join feed b on a.topic = b.topic and a.url <> b.url join kd on kd.ka = a.ck and kd.kb = b.ck) group by cluster, url)
        union all select topic, any_value(url), 0.0 from feed group by topic having count(*) = 1""",
}
#: Variants of a name are as far apart as the names, so the edges are the same.
ORACLES["edges_wide_vocabulary"] = ORACLES["eps_edges_m1"]
ORACLES["runs_by_day"] = _with(DOCS) + """select url, concat('run', cast(doc_id % 3 as varchar), '_', cast(b as varchar)) as cluster_id,
  cast(date '2024-01-28' + cast(doc_id % 3 as int) as date) as timestamp, doc_id % 3 = 1 as unclusterized
  from feed where not (doc_id % 3 = 2 and b % 7 = 3)"""
_COMMUNITY_STATE = """cur as (select ls.community_id, cast(sum(cf.size) as bigint) as size, min(cf.ts) as ts
  from ls join cf using (cluster_id) group by ls.community_id)"""
ORACLES["delete_by_uuid"] = _with(CLUSTERS, LINKS, _COMMUNITY_STATE) + """
  select 'clusters' as kind, cluster_id as id, ts as timestamp from cf where g % 4 <> 1
  union all select 'communities', community_id, ts from cur where size % 2 <> 0"""
ORACLES["delete_by_community"] = _with(CLUSTERS, LINKS, _COMMUNITY_STATE) + """
  select community_id, size, ts as timestamp from cur where community_id = 'co_0' or community_id not in (
    select community_id from ls where cluster_id in (select cluster_id from cf where g % 3 = 0))"""
