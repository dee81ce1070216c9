"""Near-duplicates by SimHash fingerprints and pigeonhole blocks.

Fingerprints of 64 bits are cut into seven blocks.  Two that differ in at most four bits agree in at least three whole
blocks, so they meet in one of the 35 joins on three blocks, where their Hamming distance is verified.  Documents with
equal fingerprints are one class, and only classes are joined; a run of classes that agree on a key yields a spanning
forest of its links, never all pairs.  Links between classes become components.

Edge cases: a null text is empty.  A text without words has fingerprint zero and is linked like any other.  Repeated
rows share a fingerprint and so a component.  Null ids don't count for the smallest id; a component of null ids has a
null id.  An empty table gives an empty result.  Extra columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import Column, DataFrame, functions as F

from dockside.llm.columns import free_names
from dockside.llm.components import components
from dockside.plans.staging import stage

SHINGLE = 4
SEED = 42
MAX_DISTANCE = 4
#: Blocks that two close fingerprints surely share; their number and MAX_DISTANCE make up the number of blocks.
SHARED_BLOCKS = 3
#: Classes of one key that a task compares at once; longer runs are cut, and the cuts compared pairwise elsewhere.
MAX_RUN = 20_000
_BATCH = 1 << 16


def fingerprint(text: str, shingle: int = SHINGLE) -> int:
    """SimHash of a whole text as an unsigned number."""
    words = text.encode("utf-8", "replace").lower().split()  # both at ASCII only
    if not words:
        return 0
    n = max(1, len(words) - shingle + 1)
    joined = b" ".join(words)
    ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1) - 1
    starts = np.concatenate(([0], ends[:-1] + 1))[:n].tolist()
    ends = ends[min(shingle, len(words)) - 1:].tolist()
    digest = xxhash.xxh64_intdigest
    set_in = np.zeros(64, np.int64)
    for at in range(0, n, _BATCH):
        h = np.array([digest(joined[s:e], SEED) for s, e in zip(starts[at:at + _BATCH], ends[at:at + _BATCH])], "<u8")
        set_in += np.unpackbits(h.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * set_in > n, bitorder="little").view("<u8")[0])


def fingerprint_column(text: str = "text", shingle: int = SHINGLE) -> Column:
    """The fingerprint of a text column as a signed long."""

    @F.pandas_udf("long")
    def fps(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for batch in batches:
            yield pd.Series(np.array([fingerprint(t, shingle) for t in batch], np.uint64).view(np.int64))

    return fps(F.coalesce(F.col(text), F.lit("")))


def fingerprints(docs: DataFrame, shingle: int = SHINGLE) -> DataFrame:
    """(doc_id, fp) of every row."""
    return docs.select(F.col("doc_id").cast("long"), fingerprint_column("text", shingle).alias("fp"))


def block_masks(distance: int = MAX_DISTANCE, shared: int = SHARED_BLOCKS) -> list[int]:
    """A mask for every choice of ``shared`` blocks out of ``distance + shared``."""
    edges = [64 * k // (distance + shared) for k in range(distance + shared + 1)]
    blocks = [(1 << hi) - (1 << lo) for lo, hi in zip(edges, edges[1:])]
    return [sum(chosen) for chosen in combinations(blocks, shared)]


def _signed(x: int) -> int:
    return x - (1 << 64) if x >> 63 else x


def forest(fps: np.ndarray, distance: int) -> tuple[np.ndarray, np.ndarray]:
    """Edges that connect exactly what links within ``distance`` connect, one fewer than members in each component."""
    froms, tos, left = [], [], fps
    while len(left) > 1:
        front, left = [left[0]], left[1:]
        while front and len(left):
            f = front.pop()
            near = np.bitwise_count(left ^ f) <= distance
            if near.any():
                got = left[near]
                froms.append(np.full(len(got), f))
                tos.append(got)
                front.extend(got)
                left = left[~near]
    if not froms:
        return fps[:0], fps[:0]
    return np.concatenate(froms), np.concatenate(tos)


def _run_edges(key: np.ndarray, fp: np.ndarray, distance: int) -> list[tuple[np.ndarray, np.ndarray]]:
    """Edges within the runs of equal keys; the rows are sorted by key."""
    edge = np.flatnonzero(np.concatenate(([True], key[1:] != key[:-1], [True])))
    size = np.diff(edge)
    of_row = np.repeat(size, size)
    out = []
    for s in range(1, 8):  # runs of up to eight, all at once
        at = np.flatnonzero((of_row[:-s] <= 8) & (key[s:] == key[:-s])) if len(key) > s else []
        if not len(at):
            break
        at = at[np.bitwise_count(fp[at] ^ fp[at + s]) <= distance]
        out.append((fp[at], fp[at + s]))
    for k in np.flatnonzero(size > 8):
        out.append(forest(fp[edge[k]:edge[k + 1]], distance))
    return out


def link_edges(classes: DataFrame, *, distance: int = MAX_DISTANCE, shared: int = SHARED_BLOCKS, max_run: int = MAX_RUN) -> DataFrame:
    """(a, b) between different fingerprints ``fp``: they connect what all links within ``distance`` connect."""

    def meet(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        keys, fps = np.empty(0, np.int64), np.empty(0, np.uint64)
        cut, cut_key = 0, None  # so many chunks of this key's run are out already

        def found(n: int, chunk: int = -1) -> pd.DataFrame:
            """Edges within the first n rows; they are handed on as well if they are a chunk of a run."""
            nonlocal keys, fps
            key, fp, keys, fps = keys[:n], fps[:n], keys[n:], fps[n:]
            edges = _run_edges(key, fp, distance) or [(fp[:0], fp[:0])]
            a, b = (np.concatenate(x).view(np.int64) for x in zip(*edges))
            out = pd.DataFrame({"a": a, "b": b, "key": 0, "chunk": -1})
            if chunk < 0:
                return out
            own = fp.view(np.int64)
            return pd.concat([out, pd.DataFrame({"a": own, "b": own, "key": key, "chunk": chunk})])

        for frame in frames:
            keys = np.concatenate([keys, frame["key"].to_numpy(np.int64)])
            fps = np.concatenate([fps, frame["fp"].to_numpy(np.int64).view(np.uint64)])
            while len(keys):
                if cut and keys[0] != cut_key:
                    cut = 0
                others = np.flatnonzero(keys != keys[0])
                if cut and len(others):
                    yield found(int(others[0]), cut)
                elif len(others):  # the last run may go on in the next frame
                    yield found(int(np.flatnonzero(keys != keys[-1])[-1]) + 1)
                elif len(keys) >= max_run:
                    cut_key = keys[0]
                    yield found(max_run, cut)
                    cut += 1
                else:
                    break
        if len(keys):
            yield found(len(keys), cut if cut else -1)

    masks = block_masks(distance, shared)
    keyed = classes.select(
        "fp",
        F.explode(F.array(*(F.xxhash64(F.lit(k), F.col("fp").bitwiseAND(F.lit(_signed(m)))) for k, m in enumerate(masks)))).alias("key"),
    )
    met = stage(
        keyed.repartition("key").sortWithinPartitions("key", "fp").mapInPandas(meet, "a long, b long, key long, chunk int"),
        "simhash-met",
    )
    edges = met.where("chunk = -1").select("a", "b")
    cut = met.where("chunk >= 0").select("key", "chunk", F.col("a").alias("fp"))
    return edges.unionByName(_cut_edges(cut, distance))


def _cut_edges(cut: DataFrame, distance: int) -> DataFrame:
    """Edges between the chunks of runs that were too long for one task, each two chunks in a task of their own."""

    def across(frame: pd.DataFrame) -> pd.DataFrame:
        a, b = forest(np.unique(frame["fp"].to_numpy(np.int64)).view(np.uint64), distance)
        return pd.DataFrame({"a": a.view(np.int64), "b": b.view(np.int64)})

    chunks = cut.groupBy("key").agg(F.max("chunk").alias("n"))
    mates = F.transform(F.sequence(F.lit(0), F.col("n")), lambda c: F.struct(F.least(c, "chunk").alias("i"), F.greatest(c, "chunk").alias("j")))
    pairs = cut.join(chunks, "key").select("key", "fp", F.explode(mates).alias("x")).where("x.i < x.j")
    return pairs.select("key", "fp", "x.i", "x.j").groupBy("key", "i", "j").applyInPandas(across, "a long, b long")


def cluster(docs: DataFrame, *, distance: int = MAX_DISTANCE, shared: int = SHARED_BLOCKS, max_run: int = MAX_RUN) -> DataFrame:
    """(doc_id, fp, root, component_id) of every row.

    ``root`` is the component's smallest fingerprint, ``component_id`` the smallest doc_id that links reach.
    """
    prints = stage(fingerprints(docs), "simhash")
    of_class = class_components(prints, distance=distance, shared=shared, max_run=max_run)
    # Two plain exchanges: adaptive execution can split a fingerprint that many documents share.
    return prints.join(of_class, "fp").select("doc_id", "fp", "root", "component_id")


def class_components(prints: DataFrame, **options) -> DataFrame:
    """(fp, root, component_id) of every fingerprint in ``prints(doc_id, fp)``."""
    classes = stage(prints.groupBy("fp").agg(F.min("doc_id").alias("first")), "simhash-classes")
    roots = components(link_edges(classes, **options)).withColumnRenamed("node", "fp")
    rooted = stage(classes.join(roots, "fp", "left"), "simhash-roots")
    linked = rooted.where("root is not null")
    # Written, so that the join reads two plain exchanges and a component of very many classes can be split.
    least = stage(linked.groupBy("root").agg(F.min("first").alias("component_id")), "simhash-least")
    # Classes without links stay out of the join, where they would all meet under the null root.
    of_class = linked.join(least, "root").select("fp", "root", "component_id").unionByName(
        rooted.where("root is null").select("fp", F.col("fp").alias("root"), F.col("first").alias("component_id"))
    )
    return stage(of_class, "simhash-components")


def hex_digits(fp: Column) -> Column:
    return F.lpad(F.lower(F.hex(fp)), 16, "0")


def keep_one(docs: DataFrame, **options) -> DataFrame:
    """One document of each component, that with the smallest id, with all its columns.

    Of rows that share this id in one component one is kept.  A row without an id is kept where its whole component
    has none, one for each component.  Only rows whose id is null or repeated, few as a rule, are told apart by their
    fingerprints again.
    """
    id_, fp, root, first = free_names(docs, "id_", "fp_", "root_", "first_")
    prints = stage(fingerprints(docs), "simhash")
    of_class = class_components(prints, **options)
    ids = prints.join(of_class, "fp").groupBy("doc_id").agg(
        F.count("*").alias("n"), F.bool_and(F.col("doc_id") == F.col("component_id")).alias("stays")
    )
    ids = stage(ids.select(F.col("doc_id").alias(id_), "n", "stays"), "simhash-ids")
    odd = F.col(id_).isNull() | (F.col("n") > 1)
    gone, again = ids.where(odd | ~F.col("stays")).select(id_), ids.where(odd).select(id_)
    # By merging at every size: what is gone grows with the corpus, so in the end it is never small.
    once = docs.where(F.col("doc_id").isNotNull()).join(gone.hint("merge"), F.col("doc_id") == F.col(id_), "left_anti")
    if again.isEmpty():
        return once
    # Written before the fingerprints, or they would be taken of all documents in front of the join.
    more = stage(docs.join(again, F.col("doc_id").eqNullSafe(F.col(id_)), "left_semi"), "simhash-again")
    of_class = of_class.select(F.col("fp").alias(fp), F.col("root").alias(root), F.col("component_id").alias(first))
    more = more.withColumn(fp, fingerprint_column("text")).join(of_class, fp)
    more = more.where(F.col("doc_id").eqNullSafe(F.col(first))).dropDuplicates(["doc_id", root])
    return once.unionByName(more.select(*(f"`{c}`" for c in docs.columns)))
