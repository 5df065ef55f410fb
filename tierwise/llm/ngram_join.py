"""N-gram Jaccard join: size-aware heavy-light set similarity join.

Each text is the set of its distinct 5-word shingles; two texts are linked
when 100 * |intersection| >= 80 * |union|. Equal sets collapse into one class
first, so copies cost one row each. Between classes:

* light sets (size up to a boundary) enumerate their subsets of the overlap
  size that a partner of each possible size demands; two light sets that link
  have such a subset in common, so an equal subset key is a candidate;
* heavy sets scan inverted lists: shingles are ordered rare first, by counts
  in a table of fixed size, and only the prefix that any partner must hit is
  listed; a pair must also have as many listed shingles in common as its sizes
  demand. Light sets near the boundary are listed too, for their heavy partners.

The boundary is the largest size whose subset rows cost no more than its
inverted-list entries, from the shingle counts of the whole input.

Candidates are not expanded into all pairs of a list. Every member of a list
is first compared with the list's leader (the member that shares most of its
listed shingles); components of the links found are built, and only pairs of one list
that lie in different components, and pass the size and position bounds, are
compared after that. Links inside a component that is already known are not
needed for any result here, so no component is lost or merged wrongly.
Comparisons are exact set intersections.

Defined results: a null text or one without words has an empty set and links
with nothing (n_shingles 0, component_id its own id); repeated rows are copies
of each other and each get a row; a row with a null id gets its component's
smallest id (null if it has none); an empty table gives no rows; other columns
are ignored, whatever their names.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass
from itertools import combinations
from math import comb

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tierwise.llm.components import components
from tierwise.llm.marks import keep_marked, mark_table, may_hold
from tierwise.llm.scratch import Scratch
from tierwise.llm.text import chunks, mix, row_shingles

#: Entries of the shingle-count table; its size is fixed, so it may be broadcast.
COUNT_SLOTS = 1 << 20
_PIECE = 1 << 14
#: Largest set size for which subsets are ever enumerated.
LIGHT_MAX = 16


def _key(found: np.ndarray) -> int:
    """Signed 64-bit fingerprint of a set of hashes."""
    with np.errstate(over="ignore"):
        total = mix(found ^ np.uint64(0x5851F42D4C957F2D)).sum(dtype=np.uint64)
    return int(mix(np.array([total + np.uint64(len(found))], np.uint64)).view(np.int64)[0])


def _scan(words: int) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """Rows: (kind 0, id, size, node) for each text, (kind 1, slot piece, counts) at the end."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = np.zeros(COUNT_SLOTS, np.uint32)
        shift = np.uint64(64 - COUNT_SLOTS.bit_length() + 1)
        for batch in batches:
            sizes, nodes = [], []
            for _, data, offs in chunks(batch, "text"):
                for s in row_shingles(data, offs, words):
                    sizes.append(len(s))
                    nodes.append(_key(s) if len(s) else None)
                    if len(s):
                        np.add.at(counts, (s >> shift).astype(np.int64), 1)
            n = batch.num_rows
            yield pa.record_batch([pa.array([0] * n, pa.int32()), batch.column(0).cast(pa.int64()),
                                   pa.array(sizes, pa.int64()), pa.array(nodes, pa.int64()),
                                   pa.nulls(n, pa.binary())], names=SCAN_NAMES)
        pieces = counts.reshape(-1, _PIECE)
        held = np.flatnonzero(pieces.any(axis=1))
        yield pa.record_batch([pa.array(np.ones(len(held)), pa.int32()), pa.array(held, pa.int64()),
                               pa.nulls(len(held), pa.int64()), pa.nulls(len(held), pa.int64()),
                               pa.array([pieces[k].tobytes() for k in held], pa.binary())],
                              names=SCAN_NAMES)
    return run


SCAN_NAMES = ["kind", "id", "size", "node", "counts"]
SCAN_SCHEMA = "kind int, id long, size long, node long, counts binary"


def _sum_pieces(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Sum the count pieces of a partition; a piece is of fixed length."""
    total: dict[int, np.ndarray] = {}
    for batch in batches:
        for k, raw in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
            got = np.frombuffer(raw, np.uint32).astype(np.uint64)
            total[k] = total[k] + got if k in total else got
    yield pa.record_batch([pa.array(list(total), pa.int64()),
                           pa.array([v.tobytes() for v in total.values()], pa.binary())],
                          names=["piece", "counts"])


def overlap_needed(a: int, b: int, percent: int) -> int:
    """Least intersection of linked sets of sizes a and b."""
    return -(-percent * (a + b) // (100 + percent))


def light_subset_sizes(size: int, boundary: int, percent: int) -> list[int]:
    """Subset sizes that a light set enumerates, one for each partner size up to the boundary."""
    sizes = set()
    for other in range(1, boundary + 1):
        need = overlap_needed(size, other, percent)
        if need <= min(size, other):
            sizes.add(need)
    return sorted(sizes)


def choose_boundary(mean_list: float, percent: int) -> int:
    """Largest size whose subset rows are no more than the list entries it would meet."""
    best = 0
    for size in range(1, LIGHT_MAX + 1):
        rows = sum(comb(size, c) for c in light_subset_sizes(size, size, percent))
        prefix = size - -(-percent * size // 100) + 1
        if rows <= prefix * (1 + mean_list):
            best = size
    return best


def _signatures(words: int, percent: int, boundary: int,
                levels: object) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """(token, node, size, pos) rows; pos -1 marks a subset key of a light set."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        level = levels.value
        shift = np.uint64(64 - COUNT_SLOTS.bit_length() + 1)
        for batch in batches:
            for _, data, offs in chunks(batch, "text"):
                tokens, nodes, sizes, places = [], [], [], []
                for s in row_shingles(data, offs, words):
                    n = len(s)
                    if not n:
                        continue
                    found = []
                    if n <= boundary:
                        for c in light_subset_sizes(n, boundary, percent):
                            for sub in combinations(s, c):
                                found.append(_key(np.array(sub, np.uint64)) ^ c)
                    subsets = len(found)
                    if n > boundary or 100 * n >= percent * (boundary + 1):
                        rank = (level[(s >> shift).astype(np.int64)].astype(np.uint64)
                                << np.uint64(56)) | (s >> np.uint64(8))
                        prefix = n - -(-percent * n // 100) + 1
                        top = s[np.argsort(rank, kind="stable")[:prefix]].view(np.int64)
                        listed = len(top)
                    else:
                        top, listed = np.zeros(0, np.int64), 0
                    tokens.append(np.array(found, np.int64))
                    tokens.append(top)
                    nodes.append(np.full(subsets + listed, _key(s), np.int64))
                    sizes.append(np.full(subsets + listed, n, np.int32))
                    places.append(np.full(subsets, -1, np.int32))
                    places.append(np.arange(listed, dtype=np.int32))
                if tokens:
                    yield pa.record_batch([pa.array(np.concatenate(x)) for x in
                                           (tokens, nodes, sizes, places)],
                                          names=["token", "node", "size", "pos"])
    return run


def _sets(words: int, marks: object) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """(node, items) of the texts whose id may be marked; the caller drops the others."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            batch = batch.filter(pa.array(may_hold(marks.value, batch.column(0))))
            for part, data, offs in chunks(batch, "text"):
                sets = [s for s in row_shingles(data, offs, words) if len(s)]
                yield pa.record_batch([
                    pa.array([_key(s) for s in sets], pa.int64()),
                    pa.array([s.view(np.int64) for s in sets], pa.list_(pa.int64()))],
                    names=["node", "items"])
    return run


def _pair_sets(spark: SparkSession, texts: DataFrame, members: DataFrame, pairs: DataFrame,
               words: int) -> DataFrame:
    """(node, items) of every class in ``pairs``, made from one text of each.

    Their ids mark a bit table of fixed size, so other texts are dropped where
    they are read (or, in a full table, by the join) and no text is shuffled.
    """
    nodes = pairs.select(F.col("u").alias("node")).union(pairs.select("v")).distinct()
    ids = (members.where("node is not null").join(nodes, "node", "left_semi")
           .groupBy("node").agg(F.min("id").alias("id")).select("id"))
    return (texts.mapInArrow(_sets(words, spark.sparkContext.broadcast(mark_table(ids))),
                             "node long, items array<long>")
            .join(nodes, "node", "left_semi").dropDuplicates(["node"]))


def _promising(pairs: DataFrame, heads: DataFrame, percent: int, boundary: int) -> DataFrame:
    """Of (u, v) pairs those with enough listed shingles in common.

    Listed are all but ceil(n * percent / 100) - 1 shingles of a set, in one
    order for all sets, so linked sets have at least their needed intersection
    less that many in common among the listed. Pairs of light sets come from
    equal subsets and are all kept.
    """
    left = heads.select(F.col("node").alias("u"), F.col("size").alias("a"), F.col("head").alias("ha"))
    right = heads.select(F.col("node").alias("v"), F.col("size").alias("b"), F.col("head").alias("hb"))
    need = F.expr(f"ceil({percent} * (a + b) / {100 + percent}.0 - 1e-9)")
    common = need - F.expr(f"ceil({percent} * greatest(a, b) / 100.0 - 1e-9)") + 1
    return (pairs.join(left, "u").join(right, "v")
            .where((F.greatest("a", "b") <= boundary)
                   | (F.size(F.array_intersect("ha", "hb")) >= common))
            .select("u", "v"))


def _verified(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """Of (u, v) pairs those that link, by exact intersection."""
    left = sets.select(F.col("node").alias("u"), F.col("items").alias("a"))
    right = sets.select(F.col("node").alias("v"), F.col("items").alias("b"))
    both = F.size(F.array_intersect("a", "b"))
    return (pairs.join(left, "u").join(right, "v")
            .where(100 * both >= percent * (F.size("a") + F.size("b") - both))
            .select("u", "v"))


@dataclass
class NgramJoin:
    """documents: doc_id, n_shingles, component_id; links: verified (u, v) class pairs that
    span every component; members: (doc_id, node) class of each document."""
    documents: DataFrame
    links: DataFrame
    members: DataFrame


def ngram_jaccard_join(spark: SparkSession, docs: DataFrame, id_col: str = "doc_id",
                       text_col: str = "text", words: int = 5, percent: int = 80) -> NgramJoin:
    """Components of texts whose word-shingle sets have a Jaccard similarity of percent/100 or more."""
    scratch = Scratch(spark, "ngram-join")
    texts = docs.select(F.col(id_col).cast("long").alias("id"),
                        F.col(text_col).cast("string").alias("text"))
    scan = scratch.save(texts.mapInArrow(_scan(words), SCAN_SCHEMA), "scan")
    members = scan.where("kind = 0").select("id", "size", "node")

    pieces = (scan.where("kind = 1").select(F.col("id").alias("piece"), "counts")
              .repartition("piece").mapInArrow(_sum_pieces, "piece long, counts binary"))
    counts = np.zeros(COUNT_SLOTS, np.uint64)
    for row in pieces.collect():  # COUNT_SLOTS numbers in all, at every input size
        counts[row.piece * _PIECE:(row.piece + 1) * _PIECE] = np.frombuffer(row.counts, np.uint64)
    total = float(counts.sum())
    square = float((counts.astype(np.float64) ** 2).sum())
    mean_list = max(0.0, (square - total * total / COUNT_SLOTS) / total) if total else 0.0
    boundary = choose_boundary(mean_list, percent)
    # half-octave steps keep the table at one byte a slot; ties are ordered by hash
    level = np.minimum(255, np.ceil(2 * np.log2(counts.astype(np.float64) + 1))).astype(np.uint8)
    levels = spark.sparkContext.broadcast(level)

    listed = texts.select("text").mapInArrow(
        _signatures(words, percent, boundary, levels),
        "token long, node long, size int, pos int")
    by_token = Window.partitionBy("token")
    lists = scratch.save(
        listed.withColumn("low", F.min("node").over(by_token))
        .withColumn("high", F.max("node").over(by_token))
        .where("low < high").drop("low", "high").dropDuplicates(["token", "node"]), "lists")

    need = F.ceil(percent * (F.col("size") + F.col("o_size")) / F.lit(100.0 + percent) - 1e-9)
    fits = ((F.least("size", "o_size") >= need)
            & ((F.col("pos") < 0)
               | (F.least(F.col("size") - F.col("pos"), F.col("o_size") - F.col("o_pos")) >= need))
            & ((F.col("pos") < 0) == (F.col("o_pos") < 0))
            & ((F.col("pos") < 0) | (F.greatest("size", "o_size") > boundary)))
    ordered = [F.least("node", "o_node").alias("u"), F.greatest("node", "o_node").alias("v")]
    heads = scratch.save(lists.groupBy("node").agg(
        F.first("size").alias("size"), F.count(F.lit(1)).alias("shared"),
        F.array_sort(F.collect_list(F.when(F.col("pos") >= 0, F.col("token")))).alias("head")), "heads")
    leader = (lists.join(heads.select("node", "shared"), "node").groupBy("token")
              .agg(F.max(F.struct("shared", "node", "size", "pos")).alias("l"))
              .select("token", F.col("l.node").alias("o_node"), F.col("l.size").alias("o_size"),
                      F.col("l.pos").alias("o_pos")))
    first = scratch.save(_promising(
        lists.join(leader, "token").where((F.col("node") != F.col("o_node")) & fits)
        .select(*ordered).distinct(), heads, percent, boundary), "leader-pairs")
    found = scratch.save(
        _verified(first, _pair_sets(spark, texts, members, first, words), percent), "leader-links")

    # two hops put all members of a list linked with its leader under one label; nodes
    # with the same label are connected, which is all that is needed here
    both = found.union(found.select(F.col("v").alias("u"), F.col("u").alias("v")))
    near = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("near"))
    known = (both.join(near.select(F.col("u").alias("v"), "near"), "v").groupBy("u")
             .agg(F.min("near").alias("centre")).withColumnRenamed("u", "node"))
    placed = (lists.join(known, "node", "left")
              .withColumn("centre", F.coalesce("centre", "node")))
    # a list whose members are all of one component has nothing left to compare
    open_lists = (placed.groupBy("token").agg(F.min("centre").alias("low"), F.max("centre").alias("high"))
                  .where("low < high").select("token"))
    placed = scratch.save(placed.join(open_lists, "token"), "open-lists")
    other = placed.select("token", *[F.col(c).alias(f"o_{c}")
                                     for c in ("node", "size", "pos", "centre")])
    second = scratch.save(_promising(
        placed.join(other, "token")
        .where((F.col("node") < F.col("o_node")) & (F.col("centre") != F.col("o_centre")) & fits)
        .select(*ordered).distinct().join(first, ["u", "v"], "left_anti"),
        heads, percent, boundary), "open-pairs")
    links = scratch.save(found.union(
        _verified(second, _pair_sets(spark, texts, members, second, words), percent)), "all-links")

    final = components(links, scratch)
    centred = (members.join(final, "node", "left")
               .withColumn("centre", F.coalesce("centre", "node")))
    smallest = (centred.where("centre is not null").groupBy("centre")
                .agg(F.min("id").alias("component_id")))
    documents = (centred.join(smallest, "centre", "left")
                 .select(F.col("id").alias("doc_id"), F.col("size").alias("n_shingles"),
                         F.coalesce("component_id", "id").alias("component_id")))
    return NgramJoin(documents, links, members.select(F.col("id").alias("doc_id"), "node"))


def keep_one_of_each(spark: SparkSession, docs: DataFrame, words: int = 5, percent: int = 80) -> DataFrame:
    """``docs`` with one document of each group, the one with the smallest id.

    Repeated rows of one document are one document; rows with a null id can't
    be told apart and all stay. Only documents that may go are shuffled.
    """
    found = ngram_jaccard_join(spark, docs, words=words, percent=percent).documents
    gone = found.where("doc_id != component_id").select("doc_id").distinct()
    again = found.where("doc_id is not null").groupBy("doc_id").agg(F.count(F.lit(1)).alias("n")) \
        .where("n > 1").select("doc_id")
    scratch = Scratch(spark, "ngram-keep")
    gone, again = scratch.save(gone, "gone"), scratch.save(again, "again")
    marks = spark.sparkContext.broadcast(mark_table(gone.union(again)))
    ordered = docs.select("doc_id", *[c for c in docs.columns if c != "doc_id"])
    ordered = ordered.withColumn("doc_id", F.col("doc_id").cast("long"))
    sure = ordered.where("doc_id is not null").mapInArrow(keep_marked(marks, False), ordered.schema)
    rest = (ordered.where("doc_id is not null").mapInArrow(keep_marked(marks), ordered.schema)
            .join(gone, "doc_id", "left_anti"))
    # which of a document's rows stays doesn't matter where they are equal; else the smallest text does
    rest = rest.groupBy("doc_id").agg(F.min(F.struct(*[c for c in ordered.columns if c != "doc_id"])).alias("r")) \
        .select("doc_id", "r.*")
    return (sure.union(rest).union(ordered.where("doc_id is null"))
            .select(*[F.col(c).cast(docs.schema[c].dataType).alias(c) for c in docs.columns]))
