"""A document feed, a category table and a cluster feed derived from the test tables.

The raw ``embeddings`` are near-random, so no two are within any threshold. The feeds add topic
structure in closed form: a topic's anchor vector plus the document's own vector scaled by an
amplitude. Every document and every embedding is used. The anchors are a few dozen vectors of fixed numbers, which are
broadcast: joined by a shuffle, a third of all documents would meet in one task.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from ..session import prepare

DOC_FEED = """
with k as (
  select doc_id, lang, split_part(text, chr(10), 1) as title,
         doc_id % (select count(*) from {embeddings}) as vec_id,
         case when doc_id % 5 = 0 then 0 else 1 + doc_id % 37 end as b
  from {documents}),
e as (select vec_id, cast(embedding as array<double>) as e from {embeddings}),
p as (
  select k.*, e.e,
         cast(case when b = 0 then 12 + 3 * (doc_id % 6) when b % 3 = 0 then 10 + 4 * (doc_id % 7)
                   when b % 3 = 1 then 44 when doc_id % 2 = 0 then 20 else 90 end as double) / 100 as a,
         cast(case when b = 0 then 30 else 0 end as double) / 100 as s
  from k join e on e.vec_id = k.vec_id)
select /*+ BROADCAST(c), BROADCAST(u) */ concat('doc://', cast(p.doc_id as string)) as url, p.doc_id, p.b, p.title, p.lang,
       date_add(date'2024-01-25', cast(p.doc_id % 6 as int)) as timestamp,
       cast(p.doc_id % 6 as int) as day,
       transform(sequence(0, size(p.e) - 1), i -> c.e[i] + p.s * u.e[i] + p.a * p.e[i]) as title_embedding,
       transform(sequence(0, size(p.e) - 1), i -> c.e[i] + p.s * u.e[i] + p.a * p.e[size(p.e) - 1 - i])
         as content_embedding,
       case when p.doc_id % 23 = 0 then cast(array() as array<string>)
            when p.doc_id % 11 = 0 then array('unknown', p.lang)
            else array(concat('c', cast(p.b % 8 as string)), p.lang) end as categories
from p join (select * from e where vec_id between 64 and 137) c on c.vec_id = 100 + p.b
       join (select * from e where vec_id between 148 and 152) u on u.vec_id = 150 + (p.doc_id div 5) % 3
"""

CATEGORY_FEED = """
with c as (select * from (values (0,'c0'),(1,'c1'),(2,'c2'),(3,'c3'),(4,'c4'),(5,'c5'),(6,'c6'),
  (7,'c7'),(8,'de'),(9,'en'),(10,'es'),(11,'fr')) as t(i, n))
select l.n as first_category, r.n as second_category,
       cast(case when l.i = r.i then 0 else 10 + 8 * ((l.i * 7 + r.i * 13) % 10) end as double) / 100 as distance
from c l join c r on l.i <= r.i
where l.i = r.i or (l.i + r.i) % 9 <> 0
"""

CLUSTER_FEED = """
with x as (
  select vec_id, cast(embedding as array<double>) as e, vec_id div 4 as g from {embeddings}),
y as (
  select x.*, case when g % 4 = 0 then 0 else 1 + g % 13 end as k,
         cast(case when g % 6 = 5 then 40 else 5 + 2 * (g % 4) end as double) / 100 as a
  from x),
z as (select y.*, cast(case when k = 0 then 17 else 0 end as double) / 100 as s from y)
select /*+ BROADCAST(c), BROADCAST(u) */ concat('cl_', cast(z.vec_id as string)) as cluster_id, z.k, z.g,
       concat('label ', cast(z.k as string), ' ', cast(z.vec_id as string)) as cluster_label,
       transform(sequence(0, size(z.e) - 1), i -> c.e[i] + z.s * u.e[i] + z.a * z.e[i]) as centroid_embedding,
       case when z.k % 8 = z.g % 8
            then array(named_struct('category', concat('c', cast(z.k % 8 as string)), 'n', 3L))
            else array(named_struct('category', concat('c', cast(z.k % 8 as string)), 'n', 2L),
                       named_struct('category', concat('c', cast(z.g % 8 as string)), 'n', 1L)) end as categories,
       array(concat('t', cast(z.k % 5 as string)), concat('t', cast(z.g % 7 as string))) as tags,
       cast(2 + z.vec_id % 17 as bigint) as size,
       date_sub(date'2024-01-30', cast(z.g % 40 as int)) as timestamp
from z join (select * from x where vec_id between 148 and 173) c on c.vec_id = 160 + z.k
       join (select * from x where vec_id between 149 and 151) u on u.vec_id = 150 + (z.g div 4) % 2
"""


def _table(sf_dir: str, name: str) -> str:
    return f"parquet.`{sf_dir}/{name}.parquet`"


def doc_feed(spark: SparkSession, sf_dir: str) -> DataFrame:
    prepare(spark)
    return spark.sql(DOC_FEED.format(documents=_table(sf_dir, "documents"), embeddings=_table(sf_dir, "embeddings")))


def category_feed(spark: SparkSession) -> DataFrame:
    return spark.sql(CATEGORY_FEED)


def cluster_feed(spark: SparkSession, sf_dir: str) -> DataFrame:
    prepare(spark)
    return spark.sql(CLUSTER_FEED.format(embeddings=_table(sf_dir, "embeddings")))
