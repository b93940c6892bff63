"""Link graphs."""

from pyspark.sql import functions as F

from millrace.catalog import query
from millrace.functions.scalars import rounded
from millrace.operators import graph

RESOLVED = """recursive:, walk(src, here, seen, step) as (select src, dst, [src], 1 from redirects union all
  select w.src, r.dst, list_append(w.seen, r.dst), step + 1 from walk w join redirects r on r.src = w.here where not list_contains(w.seen, r.dst)),
  resolved as (select src, arg_max(here, step) as target from walk group by 1)"""


@query("resolve_redirects", RESOLVED + " select src, target from resolved", "redirects")
def _(t):
    return graph.resolve_redirects(t.redirects)


@query("link_index", RESOLVED + """, e as (select distinct coalesce(a.target, l.src) as src, coalesce(b.target, l.dst) as dst from links l left join resolved a on a.src = l.src left join resolved b on b.src = l.dst),
  n as (select name, cast(row_number() over (order by name) - 1 as bigint) as i from (select src as name from e union select dst from e) x)
select a.i as i, b.i as j from e join n a on a.name = e.src join n b on b.name = e.dst""", "redirects links")
def _(t):
    edges, _nodes = graph.link_index(t.links, graph.resolve_redirects(t.redirects))
    return edges


def _rank_sql(rounds):
    body = ", nodes as (select src as node from links union select dst from links), deg as (select src as node, count(*) as out from links group by 1), s0 as (select node, 1.0e0 / (select count(*) from nodes) as score from nodes)"
    for i in range(rounds):
        body += (f", g{i} as (select l.dst as node, sum(s.score / d.out) as got from links l join s{i} s on s.node = l.src join deg d on d.node = l.src group by 1),"
                 f" k{i} as (select 0.85e0 * coalesce(sum(score) filter (where node not in (select node from deg)), 0) / count(*) + 0.15e0 * sum(score) / count(*) as base from s{i}),"
                 f" s{i + 1} as (select n.node, coalesce(g.got, 0) * 0.85e0 + (select base from k{i}) as score from nodes n left join g{i} g using (node))")
    return body + f" select node, round(score, 10) as score from s{rounds}"


@query("pagerank", _rank_sql(6), "links")
def _(t):
    return graph.pagerank(t.links, rounds=6, early_stop=False).withColumn("score", rounded(F.col("score"), 10))


@query("pagerank_converged")
def _(t):
    return graph.pagerank(t.links)
