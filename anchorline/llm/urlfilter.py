"""Operator 2 [native]: URL filters. A blocked Bloom filter passes possible hits to an exact hash join.

A rule is a canonical URL: host and path. It fits its host and all subdomains where the url's path starts
with its own; the longest rule that fits decides (rules of equal text: block wins). Every url has a few
canonical candidates: its host's suffixes of the numbers of labels that occur among the rules, with its path's
prefixes of the lengths that occur there, so a host of very many labels has no more candidates than others. Each candidate looks up one block of 512 bits of the filter (a join on the block number with
a table of bounded size, so it is broadcast) and only possible hits enter the exact join, which removes false
positives. Hits are folded per distinct (page, host, path) and joined back.

Null urls and those without ``://`` have empty host and path and no rule. Without a rule the url is not
listed and allowed. Null rules are ignored; repeated rows are kept; all is DataFrame code. An empty table gives an empty
result, no rules allow all. Columns other than id and url are not read, so names like host or rule do not clash. Beyond
some 5.6 million rules the filter, which stays at 8 MB, passes more false positives to the exact join; results stay right.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from anchorline.llm._common import stored, table

#: Bits of a block, of the largest filter (8 MB: what bounds the broadcast), and those set for a rule.
BLOCK, MOST_BLOCKS, PROBES, BITS_PER_RULE = 512, 1 << 17, 6, 12
RULES = [("com", "/", "allow"), ("example.com", "/en/", "block"), ("www.example.com", "/en/", "allow"), ("net", "/es/", "block"), ("net", "/fr/", "block")]


def _lower(c: Column) -> Column:
    return F.translate(c, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def host_path(url: Column) -> tuple[Column, Column]:
    at = F.locate("://", url)
    rest = F.when(at > 0, F.substring(url, at + 3, F.length(url))).otherwise(F.lit(""))
    rest = F.regexp_extract(F.coalesce(rest, F.lit("")), r"(?s)^([^?#]*)", 1)
    host = F.regexp_extract(rest, r"(?s)^([^/]*)", 1)
    return _lower(host), F.substring(rest, F.length(host) + 1, F.length(rest))


def _probes(key: Column, blocks: int) -> tuple[Column, list[tuple[Column, Column]]]:
    """Block number; word index and bit mask of each probe inside the block."""
    h = F.xxhash64(F.lit(101), key)
    bits = F.xxhash64(F.lit(202), key)
    out = []
    for i in range(PROBES):
        b = F.shiftrightunsigned(bits, 9 * i).bitwiseAND(F.lit(BLOCK - 1))
        out.append((F.shiftright(b, 6).cast("int"), b.bitwiseAND(F.lit(63)).cast("int")))
    return F.pmod(h, F.lit(blocks)), out


def _bit(n: Column) -> Column:
    return F.call_function("shiftleft", F.lit(1).cast("long"), n)


def bloom(rules: DataFrame) -> tuple[DataFrame, int]:
    """One row a block that is not empty: its eight 64-bit words."""
    n = rules.count()
    blocks = 1
    while blocks < MOST_BLOCKS and blocks * BLOCK < n * BITS_PER_RULE:
        blocks *= 2
    block, probes = _probes(F.col("rule"), blocks)
    bits = rules.select(block.alias("_block"), F.explode(F.array(*[F.struct(w.alias("w"), b.alias("b")) for w, b in probes])).alias("p"))
    words = [F.coalesce(F.bit_or(F.when(F.col("p.w") == i, _bit(F.col("p.b")))), F.lit(0).cast("long")) for i in range(8)]
    return bits.groupBy("_block").agg(F.array(*words).alias("_words")), blocks


def canonical(rules: DataFrame) -> DataFrame:
    """host, path, action -> rule, action, length of the path, labels of the host; one row a rule text."""
    rules = rules.where("host is not null and path is not null and action is not null")
    size = F.size(F.split("host", r"\."))
    rules = rules.select(F.concat(_lower(F.col("host")), F.col("path")).alias("rule"), F.length("path").alias("_len"), size.alias("_labels"), "action")
    return rules.groupBy("rule").agg(F.max("_len").alias("_len"), F.max("_labels").alias("_labels"), F.max("action").alias("action"))


def filter_urls(pages: DataFrame, rules: DataFrame, id_col: str = "page_id", url_col: str = "url") -> DataFrame:
    """page_id, host, path, rule (null if none fits) and verdict."""
    rules = stored(canonical(rules))
    filter_, blocks = bloom(rules)
    # no more of either than urls are long
    lengths = [r[0] for r in rules.select("_len").distinct().collect()]
    counts = [r[0] for r in rules.select("_labels").distinct().collect()]
    host, path = host_path(F.col(url_col))
    urls = pages.select(F.col(id_col).alias("page_id"), host.alias("host"), path.alias("path"))
    labels = F.split("host", r"\.")
    ends = F.filter(F.array(*[F.lit(x) for x in sorted(counts)]).cast("array<int>"), lambda n: n <= F.size(labels))
    suffixes = F.transform(ends, lambda n: F.array_join(F.slice(labels, -n, n), "."))
    fits = F.filter(F.array(*[F.lit(x) for x in sorted(lengths)]).cast("array<int>"), lambda n: n <= F.length("path"))
    starts = F.transform(fits, lambda n: F.substring(F.col("path"), F.lit(1), n))
    keys = F.flatten(F.transform(suffixes, lambda s: F.transform(starts, lambda p: F.concat(s, p))))
    asked = urls.where("host <> ''").distinct().select("*", F.explode(keys).alias("_key"))
    block, probes = _probes(F.col("_key"), blocks)
    asked = asked.withColumn("_block", block).join(F.broadcast(filter_), "_block")
    hit = F.lit(True)
    for w, b in probes:
        hit &= F.get("_words", w).bitwiseAND(_bit(b)) != 0
    possible = asked.where(hit).select("page_id", "host", "path", "_key")
    exact = possible.join(rules.select(F.col("rule").alias("_key"), "action"), "_key")
    best = exact.groupBy("page_id", "host", "path").agg(F.max(F.struct(F.length("_key").alias("n"), F.col("_key").alias("rule"), "action")).alias("_best"))
    best = best.select(F.col("page_id").alias("_i"), F.col("host").alias("_h"), F.col("path").alias("_p"), "_best")
    out = urls.join(best, F.col("page_id").eqNullSafe(F.col("_i")) & (F.col("host") == F.col("_h")) & (F.col("path") == F.col("_p")), "left")
    return out.select("page_id", "host", "path", F.col("_best.rule").alias("rule"), F.coalesce("_best.action", F.lit("allow")).alias("verdict"))


def default_rules(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame(RULES, "host string, path string, action string")


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return filter_urls(table(spark, sf_dir, "pages").select("page_id", "url"), default_rules(spark))


_FITS = " union all ".join(f"select '{h}' rh, '{p}' rp, '{a}' ra" for h, p, a in RULES)
SQL = f"""
with u as (
  select page_id, case when url is null or strpos(url, '://') = 0 then ''
    else regexp_extract(substr(url, strpos(url, '://') + 3), '^([^?#]*)', 1) end as rest from pages),
h as (select page_id, rest, regexp_extract(rest, '^([^/]*)', 1) as raw from u),
p as (select row_number() over () as k, page_id, lower(raw) as host, substr(rest, length(raw) + 1) as path from h),
r as ({_FITS}),
m as (select k, arg_max(rh || rp, length(rh || rp)) as rule, arg_max(ra, length(rh || rp)) as verdict from p, r
  where (host = rh or suffix(host, '.' || rh)) and prefix(path, rp) group by k)
select page_id, host, path, rule, coalesce(verdict, 'allow') as verdict from p left join m using (k)
"""
