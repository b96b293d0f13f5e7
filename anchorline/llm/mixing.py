"""Operator 1 [native]: mixing sources to target weights by a multivariate-hypergeometric splitting tree.

Each source gets a target of words: the weights share ``ratio`` times all words; no target exceeds ``most``
times its source, and what is cut off is shared again by weight. Documents of a source fall into blocks by a
hash of their id and text. A target is whole passes over the source's blocks and a last partial pass.

The tree partitions exact quotas of blocks among the output shards: a source's blocks in each whole pass, and for
the partial pass the blocks to draw and those to leave. At each node the units of all quotas are permuted and the left
child gets half of them, which draws its quotas from the multivariate hypergeometric distribution; a node's quotas are
the sums of its children's. A leaf then holds as many blocks of the source's permuted order as its quotas add up to,
disjoint from all other leaves, and draws the first of them: so the tree decides which blocks are taken and where they
go. Blocks differ in size: where the drawn ones hold fewer words than the target, blocks that were left follow, and
the last block is taken in part (by sub-blocks, then documents, and the last document by its first words), so the words
taken equal the rounded target. Documents follow their block's shard and carry a key for the local shuffle inside it.

Everything is DataFrame code, and the draws depend on ids, texts and the seed alone: reruns agree. Null text has
size 0; null source is one source, last in order. An id that occurs twice counts each time; equal rows are drawn one by
one, in any order, as nothing tells them apart. Empty documents are taken 0 words. A very long text is counted by a
regular expression and never split into an array, but for the one document a source that is taken in part. Targets are
doubles; an empty table gives an empty result; other columns are passed on or not read, whatever their names. Sources are
rows of windows without a partition, and the tree holds up to three units a block: meant for up to some 10^5 sources.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from anchorline.llm._common import WORD, count_words, stored, table

WEIGHTS = (5.0, 2.0, 1.0)
#: Blocks of all sources together are at most BLOCKS plus one a source; sub-blocks of a block are SUB at most.
BLOCKS, SUB = 4096, 1024
SHARDS = 64


def _hash(seed: int, *cols: Column | str) -> Column:
    return F.xxhash64(F.lit(seed), *cols)


def with_targets(sizes: DataFrame, weights=WEIGHTS, ratio: float = 1.5, most: float = 2.0) -> DataFrame:
    """source, source_size -> and target. Water-filling: sorted by size per weight, a prefix of sources is capped.

    A source is capped where the share it would get after capping those before it exceeds its limit. Rows here
    are sources, of which there are few; the window that needs them in one place sees nothing else.
    """
    order = Window.orderBy(F.col("source").asc_nulls_last())
    w = F.element_at(F.array(*[F.lit(float(x)) for x in weights]), (F.row_number().over(order) - 1) % len(weights) + 1)
    by = Window.orderBy(F.col("limit") / F.col("weight"), F.col("source").asc_nulls_last())
    everything = Window.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    df = sizes.withColumn("weight", w).withColumn("limit", F.lit(float(most)) * F.col("source_size"))
    df = df.withColumn("_all", F.lit(float(ratio)) * F.sum("source_size").over(everything)).withColumn("_w", F.sum("weight").over(everything))
    before = by.rowsBetween(Window.unboundedPreceding, -1)
    df = df.withColumn("_cut", F.coalesce(F.sum("limit").over(before), F.lit(0.0))).withColumn("_gone", F.coalesce(F.sum("weight").over(before), F.lit(0.0)))
    rate = (F.col("_all") - F.col("_cut")) / (F.col("_w") - F.col("_gone"))
    df = df.withColumn("_rate", rate).withColumn("_capped", F.col("_rate") * F.col("weight") > F.col("limit"))
    # limits over weights ascend, so the capped ones are a prefix; the first that is not gives everyone's rate
    df = df.withColumn("_level", F.min(F.when(~F.col("_capped"), F.struct(F.col("limit") / F.col("weight"), F.col("_rate")))).over(everything)["_rate"])
    df = df.withColumn("target", F.when(F.col("_capped") | F.col("_level").isNull(), F.col("limit")).otherwise(F.col("_level") * F.col("weight")))
    return df.select("source", "source_size", "target")


def _same(a: str, b: str) -> Column:
    return F.col(a).eqNullSafe(F.col(b))


def _fill(parts: DataFrame, group: list[str], order: list[Column], need: str, size: str) -> DataFrame:
    """Goes through the parts of a group in order: ``got`` words of each until ``need`` is met."""
    w = Window.partitionBy(*group).orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    left = F.col(need) - F.coalesce(F.sum(size).over(w), F.lit(0))
    return parts.withColumn("got", F.greatest(F.lit(0), F.least(F.col(size), left)))


def split(quotas: DataFrame, levels: int, seed: int) -> DataFrame:
    """quotas: what (a struct), quota -> shard, what, quota: exact quotas of each leaf of the tree."""
    df = quotas.withColumn("shard", F.lit(0))
    for level in range(levels):
        units = df.select("shard", "what", F.explode(F.sequence(F.lit(1), F.col("quota").cast("int"))).alias("_unit"))
        order = Window.partitionBy("shard").orderBy(_hash(seed + level, "shard", "what", "_unit"), "what", "_unit")
        odd = F.pmod(_hash(seed + 7919, F.lit(level), "shard"), F.lit(2))  # which half gets the odd unit
        left = F.row_number().over(order) <= F.floor((F.count("*").over(Window.partitionBy("shard")) + odd) / 2)
        side = F.when(left, 0).otherwise(1)
        df = units.withColumn("_side", side).groupBy((F.col("shard") * 2 + F.col("_side")).alias("shard"), "what").agg(F.count("*").alias("quota"))
    return df


def drawn_blocks(blocks: DataFrame, levels: int, seed: int) -> DataFrame:
    """blocks: source, block, _passes, _part (share of the partial pass) -> source, block, pass, shard, drawn."""
    sums = blocks.groupBy("source").agg(F.count("*").alias("_n"), F.first("_passes").alias("_passes"), F.first("_part").alias("_part"))
    draw = F.least("_n", F.ceil(F.col("_part") * F.col("_n")))
    whole = F.transform(F.filter(F.sequence(F.lit(0), F.col("_passes").cast("int")), lambda i: i < F.col("_passes")), lambda i: F.struct(i.alias("pass"), F.lit(1).alias("drawn"), F.col("_n").alias("quota")))
    last = F.col("_passes").cast("int").alias("pass")
    rest = F.array(F.struct(last, F.lit(1).alias("drawn"), draw.alias("quota")), F.struct(last, F.lit(0).alias("drawn"), (F.col("_n") - draw).alias("quota")))
    quotas = sums.select("source", F.explode(F.concat(whole, rest)).alias("_q")).where("_q.quota > 0")
    quotas = quotas.select(F.struct("source", F.col("_q.pass").alias("pass"), F.col("_q.drawn").alias("drawn")).alias("what"), F.col("_q.quota").alias("quota"))
    leaf = split(quotas, levels, seed).select("shard", "what.*", "quota")
    leaf = leaf.groupBy("source", "pass", "shard").agg(F.sum("quota").alias("_held"), F.sum(F.col("quota") * F.col("drawn")).alias("_drawn"))
    before = Window.partitionBy("source", "pass").orderBy("shard").rowsBetween(Window.unboundedPreceding, -1)
    leaf = leaf.withColumn("_from", F.coalesce(F.sum("_held").over(before), F.lit(0)))
    places = leaf.select(F.col("source").alias("_source"), F.col("pass").alias("_pass"), "shard", "_from", "_drawn", F.explode(F.sequence(F.lit(0), (F.col("_held") - 1).cast("int"))).alias("_i"))
    places = places.select("_source", "_pass", "shard", (F.col("_from") + F.col("_i") + 1).alias("_at"), (F.col("_i") < F.col("_drawn")).alias("drawn"))
    every = blocks.select("source", "block", F.explode(F.sequence(F.lit(0), F.col("_passes").cast("int"))).alias("pass"))
    order = Window.partitionBy("source", "pass").orderBy(_hash(seed + 101, "source", "pass", "block"), "block")
    every = every.withColumn("_rank", F.row_number().over(order).cast("long"))
    out = every.join(places, _same("source", "_source") & (F.col("pass") == F.col("_pass")) & (F.col("_rank") == F.col("_at")))
    return out.select("source", "block", "pass", "shard", "drawn")


def mix(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source", weights=WEIGHTS, ratio: float = 1.5, most: float = 2.0, shards: int = SHARDS, seed: int = 17) -> tuple[DataFrame, DataFrame]:
    """(documents with size, source_size, target, taken, and the shard of each draw; draws: id, pass, shard, shuffle_key, words)."""
    if shards < 1 or shards & (shards - 1):
        raise ValueError("shards must be a power of two")
    sized = docs.select(F.col(f"`{id_col}`").alias("doc_id"), count_words(F.col(f"`{text_col}`")).alias("size"), F.col(f"`{source_col}`").alias("source"), row_key(id_col, text_col, seed).alias("_h"))
    sized = stored(sized)
    targets = stored(with_targets(sized.groupBy("source").agg(F.sum("size").alias("source_size")), weights, ratio, most))
    total = targets.agg(F.sum("source_size")).first()[0] or 0
    blocks_of = F.greatest(F.lit(1), F.ceil(F.lit(float(BLOCKS)) * F.col("source_size") / max(1, total))).cast("long")
    plan = targets.select(F.col("source").alias("_source"), "source_size", "target", blocks_of.alias("_n"))
    plan = plan.withColumn("_passes", F.when(F.col("source_size") > 0, F.floor(F.round("target") / F.col("source_size"))).otherwise(0).cast("long"))
    plan = plan.withColumn("_rest", F.when(F.col("source_size") > 0, F.round("target").cast("long") - F.col("_passes") * F.col("source_size")).otherwise(0))
    placed = sized.join(plan, _same("source", "_source")).drop("_source")
    placed = placed.withColumn("block", F.pmod("_h", "_n")).withColumn("_sub", F.pmod(F.shiftrightunsigned("_h", 40), F.lit(SUB)))
    # one row a block; the leaves of the tree draw them, pass by pass
    blocks = placed.groupBy("source", "block").agg(F.sum("size").alias("words"), F.first("_rest").alias("_rest"), F.first("_passes").alias("_passes"), F.first("source_size").alias("_all"))
    blocks = stored(blocks.withColumn("_part", F.coalesce(F.try_divide("_rest", "_all"), F.lit(0.0))))
    leaves = stored(drawn_blocks(blocks, shards.bit_length() - 1, seed + 11))
    # words of the partial pass: of the drawn blocks first, of those left if the drawn ones are small
    last = leaves.select(F.col("source").alias("_source"), F.col("block").alias("_block"), "pass", "drawn")
    last = blocks.join(last, _same("source", "_source") & (F.col("block") == F.col("_block")) & (F.col("pass") == F.col("_passes"))).drop("_source", "_block")
    filled = stored(_fill(last, ["source"], [F.desc("drawn"), _hash(seed + 1, "source", "block"), F.col("block")], "_rest", "words"))
    status = filled.select(F.col("source").alias("_source"), F.col("block").alias("_block"), F.col("words").alias("_words"), F.col("got").alias("_got"))
    status = status.where("_got > 0")
    held = placed.join(status, _same("source", "_source") & (F.col("block") == F.col("_block")), "left").drop("_source", "_block")
    whole = held.withColumn("_last", F.when(F.coalesce("_got", F.lit(0)) == F.coalesce("_words", F.lit(0)), F.when(F.col("_got").isNotNull(), F.col("size")).otherwise(0)))
    # one block of each source is taken in part: by sub-blocks, then documents of one sub-block
    part = whole.where("_last is null")
    subs = part.groupBy("source", "_sub").agg(F.sum("size").alias("_w"), F.first("_got").alias("_need"))
    subs = stored(_fill(subs, ["source"], [_hash(seed + 2, "source", "_sub"), F.col("_sub")], "_need", "_w"))
    subs = subs.select(F.col("source").alias("_source"), F.col("_sub").alias("_sub2"), F.col("_w"), F.col("got").alias("_sub_got"))
    part = part.join(subs, _same("source", "_source") & (F.col("_sub") == F.col("_sub2"))).drop("_source", "_sub2")
    even = part.where("_sub_got in (0, _w)").withColumn("_last", F.when(F.col("_sub_got") > 0, F.col("size")).otherwise(0)).drop("_w", "_sub_got")
    odd = _fill(part.where("_sub_got not in (0, _w)"), ["source"], [_hash(seed + 3, "_h"), F.col("doc_id"), F.col("size")], "_sub_got", "size")
    odd = odd.withColumn("_last", F.col("got")).drop("_w", "_sub_got", "got")
    taken = whole.where("_last is not null").unionByName(even).unionByName(odd)
    taken = taken.withColumn("_last", F.col("_last").cast("long")).drop("_words", "_got")
    # the shards of each block's passes, in order; the last only where the partial pass takes words of it
    leaf = leaves.groupBy("source", "block").agg(F.transform(F.array_sort(F.collect_list(F.struct("pass", "shard"))), lambda x: x["shard"]).alias("_shards"))
    leaf = leaf.select(F.col("source").alias("_source"), F.col("block").alias("_block"), "_shards")
    taken = taken.join(leaf, _same("source", "_source") & (F.col("block") == F.col("_block"))).drop("_source", "_block")
    draws_ = F.col("_passes") + F.when(F.col("_last") > 0, 1).otherwise(0)
    result = taken.withColumn("taken", F.col("_passes") * F.col("size") + F.col("_last")).withColumn("shards", F.slice("_shards", F.lit(1), draws_.cast("int")))
    draws = result.select("doc_id", "source", "size", "_h", F.posexplode("shards").alias("pass", "shard"), "_passes", "_last")
    draws = draws.withColumn("words", F.when(F.col("pass") < F.col("_passes"), F.col("size")).otherwise(F.col("_last"))).where("words > 0")
    draws = draws.select("doc_id", "source", "size", "_h", "pass", "shard", _hash(seed + 5, "_h", "pass").alias("shuffle_key"), "words")
    return result.select("doc_id", "size", "source_size", "target", "taken", "source", "block", "shards"), draws


def row_key(id_col: str, text_col: str, seed: int) -> Column:
    """A hash of id and text, so rows that share an id (or have none) still spread over blocks."""
    return _hash(seed, F.col(f"`{id_col}`"), F.col(f"`{text_col}`"))


def mixed_documents(docs: DataFrame, text_col: str = "text", seed: int = 17, **kw) -> DataFrame:
    """The drawn documents with the same columns, one row a draw; a document taken in part keeps its first words.

    Rows come shard by shard, shuffled inside each (a partition holds whole shards, in order, as a writer then writes
    them). Null or empty texts, which have no words to take, are not in the mix. Equal rows share their draws.
    """
    shards = kw.get("shards", SHARDS)
    _, draws = mix(docs, text_col=text_col, seed=seed, **kw)
    key = ["doc_id", "source", "size", "_h"]
    # each row's draws, by pass; equal rows are numbered, and the n draws of a pass fall on the first n of them
    drawn = draws.groupBy(*key, "pass").agg(F.array_sort(F.collect_list(F.struct("words", "shard", "shuffle_key"))).alias("_d"))
    drawn = drawn.groupBy(*key).agg(F.collect_list(F.struct("pass", "_d")).alias("_draws"))
    drawn = drawn.select(F.col("doc_id").alias("_id"), F.col("source").alias("_source"), F.col("size").alias("_size"), F.col("_h").alias("_key"), "_draws")
    flat = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("_row"), F.col("doc_id"), F.col("source"), count_words(F.col(f"`{text_col}`")).alias("size"), row_key("doc_id", text_col, seed).alias("_h"))
    twice = flat.groupBy(*key).agg(F.count("*").alias("_n")).where("_n > 1").select(F.col("_h").alias("_t")).distinct()
    twin = flat.join(twice, F.col("_h") == F.col("_t"), "left_semi")
    rank = Window.partitionBy(*key).orderBy(F.xxhash64(F.to_json("_row")))
    flat = flat.join(twice, F.col("_h") == F.col("_t"), "left_anti").withColumn("_rank", F.lit(0)).unionByName(twin.withColumn("_rank", F.row_number().over(rank) - 1))
    out = flat.join(drawn, _same("doc_id", "_id") & _same("source", "_source") & (F.col("size") == F.col("_size")) & (F.col("_h") == F.col("_key")))
    mine = F.transform(F.filter("_draws", lambda d: F.size(d["_d"]) > F.col("_rank")), lambda d: F.element_at(d["_d"], F.col("_rank") + 1))
    out = out.select("_row", "size", F.explode(mine).alias("_d"))
    out = out.repartition(shards, "_d.shard").sortWithinPartitions("_d.shard", "_d.shuffle_key")
    text = F.col(f"_row.`{text_col}`")
    words = F.regexp_extract_all(text, F.lit(f"({WORD})"), F.lit(1))
    first = F.array_join(F.slice(words, F.lit(1), F.col("_d.words").cast("int")), " ")
    text = F.when(F.col("_d.words") >= F.col("size"), text).otherwise(first)
    return out.select(*[text.alias(c) if c == text_col else F.col(f"_row.`{c}`").alias(c) for c in docs.columns])


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "source")
    return mix(docs)[0]


def targets_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Sizes and targets alone, which SQL can express for the three sources with the given weights."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "source")
    sized = docs.select("doc_id", count_words(F.col("text")).alias("size"), "source")
    targets = with_targets(sized.groupBy("source").agg(F.sum("size").alias("source_size"))).withColumnRenamed("source", "_source")
    return sized.join(targets, _same("source", "_source")).select("doc_id", "size", "source_size", F.round("target", 3).alias("target"))


#: Water filling, round by round; each round that changes anything caps one source at least.
TARGETS_SQL = r"""
WITH RECURSIVE d AS (SELECT doc_id, source, CAST(len(regexp_extract_all(coalesce(text, ''), '[^ 	-]+')) AS BIGINT) AS size FROM documents),
s AS (SELECT source, CAST(sum(size) AS BIGINT) AS n, [5.0, 2.0, 1.0][CAST((row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 + 1 AS BIGINT)] AS w FROM d GROUP BY source),
r AS (
  SELECT 0 AS step, source, n, w, false AS capped, 1.5 * (SELECT sum(n) FROM s) / (SELECT sum(w) FROM s) AS rate FROM s
  UNION ALL
  SELECT step + 1, source, n, w, capped OR rate * w > 2 * n,
    (1.5 * sum(n) OVER () - sum(CASE WHEN capped OR rate * w > 2 * n THEN 2.0 * n ELSE 0 END) OVER ()) / nullif(sum(CASE WHEN capped OR rate * w > 2 * n THEN 0 ELSE w END) OVER (), 0)
  FROM r WHERE step < (SELECT count(*) FROM s)
),
t AS (SELECT source, n, CASE WHEN capped OR rate IS NULL THEN 2.0 * n ELSE rate * w END AS target FROM r WHERE step = (SELECT count(*) FROM s))
SELECT doc_id, size, n AS source_size, round(CAST(target AS DOUBLE), 3) AS target FROM d JOIN t ON d.source IS NOT DISTINCT FROM t.source
"""
