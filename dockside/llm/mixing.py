"""Mixing sources to target weights by a multivariate-hypergeometric splitting tree.

Every source has a weight, and the mix takes as many words as the corpus has.  A source's target is its weight's share, but
at most ``repeats`` times its own words; what is cut off goes to the others by weight.  A source's documents are dealt into
blocks by hash, and its target becomes an exact quota of blocks: whole passes over all of them, each in a permuted order of
its own, then the first blocks of one more pass, the last of which is cut between two documents.

The quotas of all sources are split among the output shards by a binary tree.  A node has a number of blocks of every source;
its left half draws its share without replacement, a multivariate hypergeometric draw, and the right half keeps the rest, so
every shard has as many blocks as any other and each source's blocks are dealt out exactly.  The shards then take disjoint
ranges of each source's permuted blocks, and order their documents by hash.  Draws are seeded by the node, so reruns agree.

Only counts of blocks meet in one task: a node's quotas, one row a source.  Blocks hold a bounded number of words or one
document, so a source with most of the rows is many blocks.

Edge cases: a null text has no words, and takes nothing.  A null source is a source, the last.  Null ids and repeated rows
are documents of their own; equal rows are dealt alike, and where the cut falls between them any of them stands for the
other.  Sources without words have a target of zero.  An empty table gives an empty result.  Extra columns are carried by
:func:`mixture` and ignored by :func:`shares`.
"""

from __future__ import annotations

import math

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, functions as F

from dockside.llm.columns import free_names
from dockside.plans.ordered import ordered_columns
from dockside.plans.staging import stage

WEIGHTS = (5, 2, 1)
#: The mix has a document so often at most.
REPEATS = 3
#: Words of a block, about.
BLOCK_WORDS = 1 << 16
#: Blocks of a shard, about.
SHARD_BLOCKS = 256
SEED = 20_011
_WORD = r"[^\x20\x09-\x0D]+"


def word_count(text: str = "text") -> Column:
    return F.coalesce(F.regexp_count(F.col(text), F.lit(_WORD)), F.lit(0)).cast("long")


def targets(sizes: DataFrame, *, weights: tuple[int, ...] = WEIGHTS, repeats: int = REPEATS) -> DataFrame:
    """(source, source_size, target) of ``sizes(source, source_size)``, one row a source.

    With a level x the sources take the lesser of repeats * size and x * weight each.  That sum is the least over k of the
    lines on which the k sources that are capped first are capped, so the level is the largest at which a line meets the
    total.  Ranks and sums over sources don't meet in one task.
    """
    # A null source comes last; without it, code points order as UTF-8 bytes.
    named = sizes.select("source", F.col("source").isNull().alias("nameless"), "source_size")
    ranked = ordered_columns(named, [], [("nameless", True), ("source", True)], rank="at")
    weight = F.element_at(F.array(*[F.lit(w) for w in weights]), (F.pmod(F.col("at") - 1, F.lit(len(weights))) + 1).cast("int"))
    each = ranked.select("source", "at", "source_size", weight.cast("long").alias("weight"), (F.lit(repeats) * F.col("source_size")).alias("cap"))
    each = each.withColumn("ratio", F.col("cap") / F.col("weight"))
    sums = ordered_columns(each, [], [("ratio", True), ("at", True)], running={"capped": ("cap", "sum"), "spent": ("weight", "sum")})
    sums = stage(sums, "levels")
    total, of_weight = sums.agg(F.sum("source_size"), F.sum("weight")).first()
    before, left = F.col("capped") - F.col("cap"), F.lit(of_weight) - F.col("spent") + F.col("weight")
    level = sums.agg(F.max((F.lit(total) - before) / left)).first()[0]
    return sums.select("source", "source_size", F.least(F.col("cap").cast("double"), F.lit(level) * F.col("weight")).alias("target"))


def _hash(*columns: Column | str, seed: int = SEED) -> Column:
    return F.xxhash64(F.lit(seed), *columns)


def _documents(docs: DataFrame, block_words: int) -> tuple[DataFrame, DataFrame]:
    """Documents' (doc_id, source, size, mark, block), and sources with their targets; ``mark`` tells rows of one size and id apart by their text."""
    own = stage(docs.select("doc_id", "source", word_count().alias("size"), _hash("doc_id", "text").alias("mark")), "mix-sizes")
    sizes = own.groupBy("source").agg(F.sum("size").alias("source_size"))
    aims = stage(targets(sizes).withColumn("blocks", F.greatest(F.ceil(F.col("source_size") / block_words), F.lit(1))), "mix-targets")
    dealt = own.alias("d").join(aims.alias("a"), F.col("d.source").eqNullSafe(F.col("a.source"))).select(
        "d.*", F.pmod(F.col("mark"), F.col("blocks")).alias("block")
    )
    return dealt, aims


def _quotas(dealt: DataFrame, aims: DataFrame) -> DataFrame:
    """(source, block, size, whole, extra, room): passes that have all of the block, whether one more has it, and words left for a block that is cut."""
    blocks = stage(dealt.groupBy("source", "block").agg(F.sum("size").alias("size")), "mix-blocks")
    pass_ = F.when(F.col("source_size") > 0, F.floor(F.col("target") / F.col("source_size"))).otherwise(0)
    aims = aims.select("source", pass_.alias("whole"), (F.col("target") - pass_ * F.col("source_size")).alias("rest"))
    ordered = ordered_columns(
        blocks.withColumn("turn", _hash("source", "block", F.lit("last"))), ["source"], [("turn", True), ("block", True)],
        running={"upto": ("size", "sum")},
    )
    from_ = F.col("upto") - F.col("size")
    return ordered.alias("b").join(aims.alias("a"), F.col("b.source").eqNullSafe(F.col("a.source"))).select(
        "b.source", "block", "size", "turn", F.col("whole").cast("int").alias("whole"),
        (F.col("upto") <= F.col("rest")).alias("extra"), F.when((F.col("upto") > F.col("rest")) & (from_ < F.col("rest")), F.col("rest") - from_).alias("room"),
    )


def split(quotas: np.ndarray, share: int, rng: np.random.Generator) -> np.ndarray:
    """``share`` blocks drawn without replacement from sources with ``quotas``: a multivariate hypergeometric draw, one source after the other."""
    out, left, want = np.zeros(len(quotas), np.int64), int(quotas.sum()), share
    for k, n in enumerate(quotas.tolist()):
        left -= n
        if n and want:
            # numpy draws from fewer than 10^9 items; larger quotas are drawn in parts.
            good, bad = n, left
            while good and want:
                part = min(good, 500_000_000)
                rest = good - part + bad
                got = int(rng.hypergeometric(part, rest, want)) if part + rest < 1_000_000_000 else _large(part, rest, want, rng)
                out[k], want, good = out[k] + got, want - got, good - part
    return out


def _large(good: int, bad: int, sample: int, rng: np.random.Generator) -> int:
    """The same draw beyond numpy's range, by the normal limit, held to what is possible."""
    n = good + bad
    mean = sample * (good / n)
    spread = math.sqrt(mean * (bad / n) * ((n - sample) / max(n - 1, 1)))
    return int(min(max(round(rng.normal(mean, spread)), sample - bad, 0), good, sample))


def _divide(node: pd.DataFrame) -> pd.DataFrame:
    """Both halves of a tree's node: (node, source, n)."""
    node = node.sort_values("source", na_position="last")
    at, shards = int(node["node"].iloc[0]), int(node["shards"].iloc[0])
    quotas = node["n"].to_numpy(np.int64)
    left_shards = shards // 2
    left = split(quotas, int(quotas.sum()) * left_shards // shards, np.random.default_rng([SEED, at]))
    sides = [node.assign(node=2 * at + k, n=n, shards=s) for k, (n, s) in enumerate(((left, left_shards), (quotas - left, shards - left_shards)))]
    return pd.concat(sides)[["node", "shards", "source", "n"]]


def tree(quotas: DataFrame, shards: int) -> DataFrame:
    """(shard, source, n): the blocks of each source that a shard draws; ``shards`` is a power of two."""
    nodes = quotas.select(F.lit(1).cast("long").alias("node"), F.lit(shards).cast("long").alias("shards"), "source", "n")
    for _ in range(shards.bit_length() - 1):
        nodes = nodes.groupBy("node").applyInPandas(_divide, "node long, shards long, source string, n long")
    return nodes.select((F.col("node") - shards).alias("shard"), "source", "n")


def _draws(quotas: DataFrame) -> DataFrame:
    """(source, block, pass, shard) of every block drawn."""
    passes = F.col("whole") + F.when(F.col("extra") | F.col("room").isNotNull(), 1).otherwise(0)
    each = quotas.where(passes > 0).select(
        "source", "block", "turn", "whole", F.explode(F.sequence(F.lit(0), passes - 1)).alias("pass")
    )
    # Every pass has its own permutation; that of the part pass is the one by which its blocks were chosen.
    each = each.withColumn("order", F.when(F.col("pass") < F.col("whole"), _hash("source", "block", "pass")).otherwise(F.col("turn")))
    each = stage(ordered_columns(each, ["source"], [("pass", True), ("order", True), ("block", True)], rank="at"), "mix-draws")
    per_source = stage(each.groupBy("source").agg(F.count("*").alias("n")), "mix-quotas")
    n = per_source.agg(F.sum("n")).first()[0] or 0
    shards = 1 << max(0, math.ceil(math.log2(max(1, n / SHARD_BLOCKS))))
    parts = tree(per_source, shards)
    upto = Window.partitionBy("source").orderBy("shard").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    reach = parts.withColumn("upto", F.sum("n").over(upto)).where("n > 0").select(
        "source", "shard", F.explode(F.sequence(F.col("upto") - F.col("n") + 1, F.col("upto"))).alias("at")
    )
    e, r = each.alias("e"), reach.alias("r")
    return e.join(r, F.col("e.source").eqNullSafe(F.col("r.source")) & (F.col("e.at") == F.col("r.at"))).select(
        "e.source", "e.block", "e.pass", "r.shard"
    )


def _schema(df: DataFrame, *more: str) -> str:
    return ", ".join([*(f"`{name}` {kind}" for name, kind in df.dtypes), *more])


def _fill(block: pa.Table) -> pa.Table:
    """The documents of a block that is cut, by hash: each that the room left can hold, and at last one that ends nearer."""
    size, room = block["size"].to_numpy(), block["room"][0].as_py()
    fits = np.zeros(len(size), bool)
    order = np.lexsort((size, block["mark"].to_numpy(), block["turn"].to_numpy()))
    for k in order.tolist():
        if size[k] <= room:
            fits[k], room = True, room - size[k]
    over = [k for k in order.tolist() if not fits[k] and size[k] < 2 * room]
    if over:
        fits[min(over, key=lambda k: size[k])] = True
    return block.append_column("fits", pa.array(fits))


def plan(docs: DataFrame, *, block_words: int = BLOCK_WORDS) -> DataFrame:
    """(doc_id, source, size, mark, source_size, target, shards): the shards that have the document, once for every time the mix has it."""
    dealt, aims = _documents(docs, block_words)
    quotas = stage(_quotas(dealt, aims), "mix-quota")
    draws = _draws(quotas).groupBy("source", "block").agg(F.sort_array(F.collect_list(F.struct("pass", "shard"))).alias("draws"))
    q, d = quotas.alias("q"), draws.alias("d")
    blocks = stage(q.join(d, F.col("q.source").eqNullSafe(F.col("d.source")) & (F.col("q.block") == F.col("d.block")), "left").select(
        "q.source", "q.block", "q.whole", "q.room", F.transform("d.draws", lambda x: x["shard"]).alias("shards")
    ), "mix-blocks-drawn")
    x, b = dealt.alias("x"), blocks.alias("b")
    met = x.join(b, F.col("x.source").eqNullSafe(F.col("b.source")) & (F.col("x.block") == F.col("b.block"))).select(
        "x.*", "whole", "room", F.coalesce("shards", F.array().cast("array<long>")).alias("shards")
    )
    # One block of a source is cut; documents without words have nothing to take and stay with the others.
    split_up = F.col("room").isNotNull() & (F.col("size") > 0)
    whole = met.where(~split_up).drop("room")
    cut = met.where(split_up).withColumn("turn", _hash("mark", F.lit("cut")))
    fits = F.when(F.col("fits"), F.col("shards")).otherwise(F.slice("shards", F.lit(1), F.col("whole")))
    cut = cut.groupBy("source", "block").applyInArrow(_fill, _schema(cut, "fits boolean")).withColumn("shards", fits)
    both = whole.unionByName(cut.select(*whole.columns)).alias("m")
    a = aims.alias("a")
    return both.join(a, F.col("m.source").eqNullSafe(F.col("a.source"))).select(
        "m.doc_id", "m.source", "m.size", "m.mark", "a.source_size", "a.target", "m.shards"
    )


def shares(docs: DataFrame, *, block_words: int = BLOCK_WORDS) -> DataFrame:
    """(doc_id, size, source_size, target, taken) of every row."""
    return plan(docs, block_words=block_words).select(
        "doc_id", "size", "source_size", "target", (F.col("size") * F.size("shards")).alias("taken")
    )


def mixture(docs: DataFrame, *, block_words: int = BLOCK_WORDS) -> DataFrame:
    """Rows of ``docs`` as often as the mix has them, with ``shard`` and ``place``, an order by hash within the shard.

    Equal rows (all of id, source and text alike) are one document that stands for all of them: planned once a row, repeated as planned.
    """
    shard, place, times, mark, number = free_names(docs, "shard", "place", "times", "mark", "number")
    per = plan(docs, block_words=block_words)
    numbered = lambda df, by: df.withColumn(number, F.row_number().over(Window.partitionBy(*by).orderBy(F.lit(0))))
    left = numbered(docs.withColumn(mark, _hash("doc_id", "text")), ["doc_id", "source", mark]).alias("l")
    right = numbered(per.select("doc_id", "source", F.col("mark").alias(mark), F.col("shards").alias(times)), ["doc_id", "source", mark]).alias("r")
    on = F.lit(True)
    for c in ("doc_id", "source", mark, number):
        on = on & F.col(f"l.{c}").eqNullSafe(F.col(f"r.{c}"))
    met = left.join(right, on).select(*[F.col(f"l.`{c}`") for c in docs.columns], F.col(f"l.{mark}"), F.posexplode(f"r.{times}").alias(number, shard))
    return met.select(*[F.col(f"`{c}`") for c in docs.columns], shard, _hash(mark, number, F.lit("place")).alias(place))


def write_mixture(docs: DataFrame, path: str, **options) -> None:
    """A folder for each shard, its documents in the shuffled order."""
    mixed = mixture(docs, **options)
    shard, place = mixed.columns[-2:]
    mixed.repartition(shard).sortWithinPartitions(shard, place).drop(place).write.partitionBy(shard).parquet(path)
