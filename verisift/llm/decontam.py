"""Operator 7: benchmark items inside documents, by containment.

Texts are lower-cased words between white space; shingles are of five words, and those of an
item that has fewer are of as many as it has. An item is found in a document when the
document holds at least 80 % of the item's distinct shingles: a short item, when its words
stand in the document in their order.

Search: the hashes of an item's shingles are taken in ascending order. As at most
``q - ceil(0.8 q)`` of its ``q`` shingles may be missing, the ``q - ceil(0.8 q) + 1``
smallest (its MinHash sketch) hold one that a containing document must have. Items
are partitioned by size (the length of their shingles, and powers of two of their number),
each partition with bounds of its own: the largest hash in any of its sketches, and the
fewest shingles that a document needs. A document is probed once per partition whose size it
reaches, with its hashes up to that partition's bound; a shared (partition, hash) makes a
candidate. No candidate is missed. Candidates are verified by counting the shingles themselves.

(Banded MinHash signatures of whole documents can't find items of forty words in
documents of twenty thousand: their Jaccard similarity is near 0.002.)

Null and empty texts hold nothing and are found nowhere. Repeated documents or items count as one
with their id; ids that are null are left out. Empty tables give no rows. Other
columns are ignored. Only DataFrame functions are used.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import cut, free_name, table

WORDS = 5
CONTAINMENT = 80  # per cent
#: Rows up to which a side of a join is sent to every executor; beyond it, both sides are shuffled.
BROADCAST_ROWS = 500_000


def words_of(text: Column) -> Column:
    return F.filter(F.split(F.lower(F.coalesce(text.cast("string"), F.lit(""))), r"[ \t-\r]+"), lambda w: w != "")


def _runs(words: str, width: int, one: str) -> str:
    """SQL of an array with ``one`` (of the start ``i``) for each run of ``width`` words; empty for a shorter text."""
    return f"case when size({words}) >= {width} then transform(sequence(0, size({words}) - {width}), i -> {one}) else array() end"


def shingle_hashes(words: str, width: int) -> Column:
    picks = ", ".join(f"h[i + {k}]" for k in range(width))
    return F.expr(f"transform(array(transform({words}, w -> xxhash64(w))), h -> {_runs('h', width, f'xxhash64({picks})')})[0]")


def shingles(words: str, width: int) -> Column:
    return F.expr(_runs(words, width, f"array_join(slice({words}, i + 1, {width}), ' ')"))


def _own(words: str, make) -> Column:
    """What ``make`` gives for an item's own width."""
    out = F.when(F.size(words) >= WORDS, make(words, WORDS))
    for width in range(1, WORDS):
        out = out.when(F.size(words) == width, make(words, width))
    return out.otherwise(F.array())


def limited(df: DataFrame, rows: int) -> DataFrame:
    return F.broadcast(df) if rows <= BROADCAST_ROWS else df


def sketches(items: DataFrame) -> DataFrame:
    """(partition, h, item_id, q, width, least): the sketch rows of each item."""
    sized = items.select("item_id", F.least(F.size("words"), F.lit(WORDS)).alias("width"), F.array_sort(F.array_distinct(_own("words", shingle_hashes))).alias("hashes"))
    sized = sized.withColumn("q", F.size("hashes")).where("q > 0")
    need = f"cast(ceil(q * {CONTAINMENT} / 100) as int)"
    return sized.select(
        "item_id", "q", "width",
        F.expr("100 * width + cast(floor(log2(q)) as int)").alias("partition"),
        F.expr(need).alias("least"),
        F.explode(F.expr(f"slice(hashes, 1, q - {need} + 1)")).alias("h"),
    )


def find(docs: DataFrame, items: DataFrame) -> DataFrame:
    """(doc_id, item_id, n_shingles, n_shared, containment) of each item in each document that holds it."""
    d = docs.select(F.col("doc_id").cast("long"), "text").where("doc_id is not null")
    b = items.select(F.col("item_id").cast("long"), words_of(F.col("text")).alias("words")).where("item_id is not null")
    sketch = cut(sketches(b))
    n_sketch = sketch.count()
    # A row per size partition.
    bounds = sketch.groupBy("partition", "width").agg(F.max("h").alias("upto"), F.min("least").alias("least")).collect()
    if not bounds:
        return d.where(F.lit(False)).selectExpr("doc_id", "doc_id as item_id", "doc_id as n_shingles", "doc_id as n_shared", "1.0D as containment")
    widths = sorted({r.width for r in bounds})
    hashed = d.select("doc_id", words_of(F.col("text")).alias("words")).select("doc_id", *[shingle_hashes("words", w).alias(f"h{w}") for w in widths])
    in_partition = [
        f"case when size(h{r.width}) >= {r.least} then transform(filter(h{r.width}, x -> x <= cast('{r.upto}' as bigint)), "
        f"x -> named_struct('partition', {r.partition}, 'n', size(h{r.width}), 'h', x)) else array() end"
        for r in bounds
    ]
    probes = hashed.select("doc_id", F.explode(F.expr(f"concat({', '.join(in_partition)})")).alias("p")).select("doc_id", "p.*")
    candidates = cut(
        probes.join(limited(sketch.select("partition", "h", "item_id", "least"), n_sketch), ["partition", "h"]).where("n >= least").select("doc_id", "item_id").distinct()
    )
    n = candidates.count()
    some = d.join(limited(candidates.select("doc_id").distinct(), n), "doc_id", "left_semi")
    in_docs = some.select("doc_id", words_of(F.col("text")).alias("words")).select("doc_id", F.explode(F.concat(*[F.array_distinct(shingles("words", w)) for w in widths])).alias("shingle"))
    in_items = b.select("item_id", F.explode(_own("words", shingles)).alias("shingle")).distinct()
    sizes = in_items.groupBy("item_id").agg(F.count("*").alias("n_shingles"))
    # The pairs carry the item's shingles, so a pair is compared with that item alone.
    shared = (
        candidates.join(in_items, "item_id").join(in_docs.distinct(), ["doc_id", "shingle"]).groupBy("doc_id", "item_id").agg(F.count("*").alias("n_shared"))
    )
    return (
        shared.join(sizes, "item_id")
        .where(F.col("n_shared") * 100 >= F.col("n_shingles") * CONTAINMENT)
        .select("doc_id", "item_id", "n_shingles", "n_shared", (F.col("n_shared") / F.col("n_shingles")).alias("containment"))
    )


def clean(docs: DataFrame, items: DataFrame) -> DataFrame:
    """The rows, with all their columns, in which no item is found."""
    leaked = cut(find(docs, items).select("doc_id").distinct())
    name = free_name(docs, "__leaked")
    return docs.join(limited(leaked.withColumnRenamed("doc_id", name), leaked.count()), F.col("doc_id") == F.col(name), "left_anti")


def op7(spark, sf_dir: str) -> DataFrame:
    return find(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


SQL = """
with d as (select doc_id, list_filter(regexp_split_to_array(lower(coalesce(text, '')), '[ \\t-\\r]+'), lambda w: w <> '') as w from documents),
b as (select item_id, list_filter(regexp_split_to_array(lower(coalesce(text, '')), '[ \\t-\\r]+'), lambda w: w <> '') as w from benchmark),
m as (select distinct least(len(w), 5) as m from b where len(w) > 0),
ds as (select distinct doc_id, unnest(list_transform(range(1, len(w) - m + 2), lambda i: array_to_string(w[i:i + m - 1], ' '))) as s from d, m where len(w) >= m),
bs as (select distinct item_id, unnest(list_transform(range(1, len(w) - least(len(w), 5) + 2), lambda i: array_to_string(w[i:i + least(len(w), 5) - 1], ' '))) as s
  from b where len(w) > 0),
q as (select item_id, count(*) as n_shingles from bs group by item_id)
select ds.doc_id, bs.item_id, q.n_shingles, count(*) as n_shared, count(*) / q.n_shingles as containment
from ds join bs using (s) join q on q.item_id = bs.item_id
group by ds.doc_id, bs.item_id, q.n_shingles having count(*) * 100 >= q.n_shingles * 80
""".replace("\\\\", "\\")
