"""Near duplicates among embeddings by randomised-rotation binary codes.

Each distinct vector is turned by random rotations; the signs are its code, and for
every rotation the inner product of the vector with its code is stored as correction
factor. A code's product with another, rotated vector, divided by the factor, is an
unbiased estimate of their cosine whose spread is known. Pairs whose estimate stays
below the threshold by more than ``SPREADS`` spreads are dropped; the cosine of all
others is computed from the vectors, and that alone makes a link.

Pairs are looked for among vectors that agree in all bits of a band of the code.
The bits of a band grow with the logarithm of the number of vectors, so a band's
buckets keep their mean size, and the number of bands follows from ``miss``, the
greatest share of pairs right at the threshold that may agree in no band. A pair
counts in the first band in which it agrees. Buckets above ``BLOCK`` rows are cut
into blocks by a hash of the row, and pairs of blocks are compared in tasks of their
own: first with codes and vectors quantised to a byte an entry (without bias, by
random rounding), then, for rows that hold an open pair, with the vectors. Links
leave a task as counts and as a spanning forest, never as all pairs.

Rows: a vector that is null, zero, empty or holds a null or non-finite entry, whose
length is not the most frequent one, or whose id is null links with nothing and is
its own component (null for a null id). Equal vectors are one class, told apart by
128-bit digests; each copy links to the others and to all links of the class. Every
input row gives one row. An empty table gives none.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tierwise.llm.components import components
from tierwise.llm.scratch import Scratch
from tierwise.llm.vectors import main_length, matrix, packed, unpacked, usable

#: Mean rows of a bucket, and rows of a block of a larger one.
BUCKET = 1024
BLOCK = 2048
#: Spreads of the estimate below the threshold at which a pair is dropped: a normal
#: variable falls so low with probability 3e-7.
SPREADS = 5.0
#: Pairs looked at together in a task.
PAIRS = 1 << 16
#: The list of split buckets is broadcast up to this many rows, else joined.
SMALL_LIST = 100_000
_BAND_SHIFT = 40

Batches = Iterator[pa.RecordBatch]


@dataclass
class Coding:
    """Sizes of a code: ``bands`` of ``bits`` signs out of ``rotations`` rotations of ``width`` dimensions."""
    length: int
    width: int
    bits: int
    bands: int
    rotations: int
    threshold: float

    @property
    def size(self) -> int:
        return self.rotations * self.width

    def spread(self, factors: np.ndarray) -> np.ndarray:
        """Standard deviation of the estimates of a pair right at the threshold, for each code."""
        one = (1 - factors ** 2) / factors ** 2 * (1 - self.threshold ** 2) / (self.width - 1)
        return np.sqrt(one.sum(axis=1)) / self.rotations

    def keys(self, signs: np.ndarray, upto: int | None = None) -> np.ndarray:
        """Key of each code in each of the first bands, a column a band."""
        upto = self.bands if upto is None else upto
        weights = np.left_shift(1, np.arange(self.bits, dtype=np.int64))
        used = signs[:, :upto * self.bits].reshape(len(signs), upto, self.bits)
        return used.astype(np.int64) @ weights


def plan_coding(vectors: int, length: int, threshold: float, miss: float) -> Coding:
    """Bits and bands for so many vectors; with one bucket for all, nothing can be missed."""
    width = max(64, -(-length // 64) * 64)
    bits = min(_BAND_SHIFT, max(0, round(math.log2(max(1, vectors) / BUCKET))))
    same = (1 - math.acos(threshold) / math.pi) ** bits
    bands = 1 if bits == 0 else max(1, math.ceil(math.log(miss) / math.log1p(-same)))
    return Coding(length, width, bits, bands, max(1, -(-bits * bands // width)), threshold)


def rotations(coding: Coding, seed: int) -> np.ndarray:
    """Random orthogonal matrices; only the columns that a vector's own dimensions meet."""
    draw, out = np.random.default_rng(seed), []
    for _ in range(coding.rotations):
        q, r = np.linalg.qr(draw.standard_normal((coding.width, coding.width)))
        out.append((q * np.sign(np.diag(r)))[:, :coding.length])
    return np.concatenate(out)


def unit(rows: np.ndarray) -> np.ndarray:
    """Rows of length 1; a power of two is taken out first, so that no square overflows."""
    _, power = np.frexp(np.abs(rows).max(axis=1, initial=0))
    scaled = np.ldexp(rows, -power[:, None])
    return scaled / np.sqrt((scaled * scaled).sum(axis=1))[:, None]


def _packed_rows(length: int, kind: type) -> Callable[[Batches], Batches]:
    """(id, v) of each row; v is null where the vector can't link."""
    def run(batches: Batches) -> Batches:
        for batch in batches:
            good = np.flatnonzero(batch.column(2).to_numpy(zero_copy_only=False))
            rows = matrix(batch.column(1).take(pa.array(good)), length).astype(kind)
            some = (rows != 0).any(axis=1)
            where = np.full(batch.num_rows, -1)
            where[good[some]] = np.arange(int(some.sum()))
            at = pa.array(where, mask=where < 0)
            yield pa.record_batch([batch.column(0), packed(rows[some]).take(at)], names=["id", "v"])
    return run


def _coded(coding: Coding, turned: object, kind: type, seed: int) -> Callable[[Batches], Batches]:
    def run(batches: Batches) -> Batches:
        for batch in batches:
            u = unit(unpacked(batch.column(1), coding.length, kind).astype(np.float64))
            y = u @ turned.value.T
            signs = y > 0
            factors = np.abs(y).reshape(len(u), coding.rotations, coding.width).sum(axis=2) / coding.width ** 0.5
            low = u.min(axis=1, initial=np.inf)
            step = np.maximum((u.max(axis=1, initial=-np.inf) - low) / 255, 1e-300)
            draw = np.random.default_rng([seed, batch.column(0)[0].as_py() if len(u) else 0])
            q = np.minimum(255, np.floor((u - low[:, None]) / step[:, None] + draw.random(u.shape)))
            bucket = coding.keys(signs) + (np.arange(coding.bands, dtype=np.int64) << _BAND_SHIFT)
            yield pa.record_batch(
                [batch.column(0), packed(np.packbits(signs, axis=1)), packed(factors.astype(np.float32)),
                 packed(np.column_stack([low, step])), packed(q.astype(np.uint8)),
                 pa.array(list(bucket), pa.list_(pa.int64()))],
                names=["node", "code", "factors", "grid", "q", "buckets"])
    return run


def _signs(code: pa.Array, coding: Coding) -> np.ndarray:
    return np.unpackbits(unpacked(code, coding.size // 8, np.uint8), axis=1).astype(bool)


def open_pairs(coding: Coding, signs: np.ndarray, factors: np.ndarray, turned: np.ndarray,
               left: np.ndarray, right: np.ndarray, band: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Pairs of a ``left`` code and a ``right`` rotated vector that may reach the threshold.

    Of rows on both sides each pair comes once. Pairs that agree in an earlier band
    are left to that band.
    """
    keys = coding.keys(signs, band)
    if not len(left) or not len(right):
        return
    scale = 1 / (coding.rotations * coding.width ** 0.5 * factors)
    weights = np.repeat(scale, coding.width, axis=1).astype(np.float32)
    least = (coding.threshold - SPREADS * coding.spread(factors)).astype(np.float32)
    q = turned[right].T.astype(np.float32)
    for a in range(0, len(left), 256):
        rows = left[a:a + 256]
        estimate = np.where(signs[rows], weights[rows], -weights[rows]) @ q
        i, j = np.nonzero(estimate >= least[rows, None])
        i, j = rows[i], right[j]
        if left is right:
            i, j = i[i < j], j[i < j]
        for c in range(0, len(i), PAIRS):
            x, y = i[c:c + PAIRS], j[c:c + PAIRS]
            first = ~(keys[x] == keys[y]).any(axis=1)
            if first.any():
                yield x[first], y[first]


def _sides(table: pa.Table) -> tuple[np.ndarray, np.ndarray, int]:
    """Rows of the two blocks that meet (the same rows, if one) and the band of the bucket."""
    own = table["own"].to_numpy()
    low, high = table["low"][0].as_py(), table["high"][0].as_py()
    left = np.flatnonzero(own == low)
    return left, left if low == high else np.flatnonzero(own == high), table["bucket"][0].as_py() >> _BAND_SHIFT


def _rows_with_open_pairs(coding: Coding, rotation: object) -> Callable[[pa.Table], pa.Table]:
    """Rows of a group that hold a pair which codes and quantised vectors leave open."""
    def run(table: pa.Table) -> pa.Table:
        table = table.combine_chunks()
        rows = np.zeros(table.num_rows, bool)
        if table.num_rows > 1:
            grid = unpacked(table["grid"], 2)
            u = grid[:, :1] + grid[:, 1:] * unpacked(table["q"], coding.length, np.uint8)
            left, right, band = _sides(table)
            for i, j in open_pairs(coding, _signs(table["code"], coding),
                                   unpacked(table["factors"], coding.rotations, np.float32).astype(np.float64),
                                   u @ rotation.value.T, left, right, band):
                rows[i] = rows[j] = True
        return table.filter(pa.array(rows)).select(["node", "bucket", "low", "high", "own"])
    return run


def _forest(nodes: int, pairs: list[tuple[np.ndarray, np.ndarray]]) -> np.ndarray:
    """The smallest row of each row's component."""
    label = np.arange(nodes)
    while True:
        before = label.copy()
        for i, j in pairs:
            low = np.minimum(label[i], label[j])
            np.minimum.at(label, i, low)
            np.minimum.at(label, j, low)
        label = label[label]
        if (label == before).all():
            return label


def _links(coding: Coding, rotation: object, kind: type) -> Callable[[pa.Table], pa.Table]:
    """(u, v, n): n links of u found in a group, and links u, v that span the group's components."""
    def run(table: pa.Table) -> pa.Table:
        table = table.combine_chunks()
        u = unit(unpacked(table["v"], coding.length, kind).astype(np.float64))
        node, copies = table["node"].to_numpy(), table["copies"].to_numpy()
        left, right, band = _sides(table)
        n, linked = np.zeros(len(u), np.int64), []
        for i, j in open_pairs(coding, _signs(table["code"], coding),
                               unpacked(table["factors"], coding.rotations, np.float32).astype(np.float64),
                               u @ rotation.value.T, left, right, band):
            near = np.einsum("ij,ij->i", u[i], u[j]) >= coding.threshold
            if near.any():
                i, j = i[near], j[near]
                np.add.at(n, i, copies[j])
                np.add.at(n, j, copies[i])
                linked.append((i.astype(np.int32), j.astype(np.int32)))
        root = _forest(len(u), linked)
        some, child = np.flatnonzero(n), np.flatnonzero(root != np.arange(len(u)))
        return pa.table({
            "u": np.concatenate([node[some], node[child]]),
            "v": pa.array(np.concatenate([node[some], node[root[child]]]),
                          mask=np.arange(len(some) + len(child)) < len(some)),
            "n": np.concatenate([n[some], np.zeros(len(child), np.int64)])})
    return run


@dataclass
class NearVectors:
    """``vectors``: id, n_links, component_id, kept of every row. ``classes``: node, first_id, copies
    of each distinct vector. ``links``: pairs (u, v) of nodes that span the components."""
    vectors: DataFrame
    classes: DataFrame
    links: DataFrame


def near_vectors(spark: SparkSession, vectors: DataFrame, threshold: float = 0.9, miss: float = 1e-3,
                 seed: int = 13, id_column: str = "vec_id", column: str = "embedding") -> NearVectors:
    """Links between vectors of cosine ``threshold`` (above 0, below 1) or more, counted for each row.

    Recall: a pair right at the threshold agrees in no band with probability
    ``miss`` at most, nearer pairs with a smaller one; no pair below it is linked.
    """
    if not 0 < threshold < 1:
        raise ValueError("threshold must lie between 0 and 1")
    scratch = Scratch(spark, "near-vectors")
    length = main_length(vectors, column)
    entry = vectors.schema[column].dataType.elementType.simpleString()
    kind = np.float32 if entry == "float" else np.float64
    id_kind = vectors.schema[id_column].dataType.simpleString()

    ok = F.coalesce(F.col(id_column).isNotNull() & usable(column) & (F.size(column) == length), F.lit(False))
    rows = vectors.select(F.col(id_column).alias("id"), F.col(column).alias("list"), ok.alias("ok")).mapInArrow(
        _packed_rows(length, kind), f"id {id_kind}, v binary")
    classes, (n,) = scratch.save_observed(
        rows.where("v is not null").groupBy("v").agg(F.min("id").alias("first_id"),
                                                     F.count(F.lit(1)).alias("copies"))
        .select(F.monotonically_increasing_id().alias("node"), "v", "first_id", "copies"),
        "classes", ["count(1)"])

    coding = plan_coding(n, length, threshold, miss)
    rotation = spark.sparkContext.broadcast(rotations(coding, seed))  # width x length, whatever the rows
    coded = scratch.save(classes.select("node", "v").mapInArrow(
        _coded(coding, rotation, kind, seed),
        "node long, code binary, factors binary, grid binary, q binary, buckets array<long>"), "codes")

    split, (many,) = scratch.save_observed(
        coded.select(F.explode("buckets").alias("bucket")).groupBy("bucket").count()
        .where(F.col("count") > BLOCK)
        .select("bucket", F.ceil(F.col("count") / BLOCK).cast("int").alias("blocks")), "split", ["count(1)"])
    placed = coded.select("node", "code", "factors", "grid", "q", F.explode("buckets").alias("bucket"))
    placed = placed.join(F.broadcast(split) if many <= SMALL_LIST else split, "bucket", "left")
    blocks = F.coalesce("blocks", F.lit(1))
    placed = (placed.withColumn("own", F.pmod(F.xxhash64("node"), blocks).cast("int"))
              .withColumn("other", F.explode(F.sequence(F.lit(0), blocks - 1)))
              .select("node", "code", "factors", "grid", "q", "bucket", "own",
                      F.least("own", "other").alias("low"), F.greatest("own", "other").alias("high")))
    meeting = ["bucket", "low", "high"]
    is_open = scratch.save(placed.groupBy(*meeting).applyInArrow(
        _rows_with_open_pairs(coding, rotation),
        "node long, bucket long, low int, high int, own int"), "open")

    whole = is_open.join(classes.select("node", "v", "copies"), "node").join(
        coded.select("node", "code", "factors"), "node")
    found = scratch.save(whole.groupBy(*meeting).applyInArrow(
        _links(coding, rotation, kind), "u long, v long, n long"), "found")

    links = found.where("v is not null").select("u", "v")
    counts = found.where("v is null").groupBy(F.col("u").alias("node")).agg(F.sum("n").alias("n"))
    roots = components(links, scratch)
    linked = classes.select("node", "first_id").join(roots, "node")
    least = linked.groupBy("centre").agg(F.min("first_id").alias("least_id"))
    settled = scratch.save(
        classes.select("node", F.md5("v").alias("digest"), "first_id", "copies")
        .join(counts, "node", "left")
        .join(linked.join(least, "centre").select("node", "least_id"), "node", "left")
        .select("digest", (F.coalesce("n", F.lit(0)) + F.col("copies") - 1).alias("n_links"),
                F.coalesce("least_id", "first_id").alias("component_id")), "settled")

    members = rows.where("v is not null").select("id", F.md5("v").alias("digest")).join(settled, "digest")
    alone = rows.where("v is null").select("id", F.lit(0).cast("long").alias("n_links"),
                                           F.col("id").alias("component_id"))
    every = members.select("id", "n_links", "component_id").unionByName(alone)
    result = every.select(F.col("id").alias(id_column), "n_links", "component_id",
                          F.coalesce(F.col("id") == F.col("component_id"), F.lit(True)).alias("kept"))
    return NearVectors(result, classes.select("node", "first_id", "copies"), links)
