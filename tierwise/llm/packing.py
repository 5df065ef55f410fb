"""Cost-balanced packing of documents into training sequences.

A document is its token ids and an end id. Documents as long as a sequence are
cut into whole sequences and a tail; tails are dealt by a hash over blocks of
about ``block_docs`` documents, which bounds a block's memory, and each block is
packed by itself: tails in descending length go to the sequence of lowest cost
(linear plus quadratic attention cost of the pieces it holds) that still has
room. A tail that fits nowhere whole fills the roomiest sequence and goes on
with its rest, so a block leaves less than one sequence of padding in all.

Tokens are made once; whole sequences travel as checksums, tails as ids.

Rows are dealt by id and checksum. Ids that very many rows share (null ids,
copies of a row) are found by counts of the id column in a fixed number of
slots; their rows are dealt by their number in the table as well, so that no
block grows with rows alike. ``docs`` should therefore be a table as it is read.

Defined results: a null or empty text is its end id alone; rows with a null id
keep it; repeated rows are documents of their own; ties in length are ordered
by id and checksum, so reruns agree (among rows of a crowded id: on one layout
of the table); an empty table gives no rows; other columns are ignored.
"""

from __future__ import annotations

import base64
import re
import zlib
from collections.abc import Callable, Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import tiktoken
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

SEQUENCE_TOKENS = 2048
END_ID = 1
BLOCK_DOCS = 8192
#: Slots in which the rows of an id are counted; at most half of them can be crowded.
ID_SLOTS = 1 << 20
#: Cost of a piece of n tokens: LINEAR * n + n * n.
LINEAR = 2048

#: Fixed values of the vocabulary: how it splits text, and its special token.
SPLIT_PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}++| ?\p{N}++| ?[^\s\p{L}\p{N}]++|\s++$|\s+(?!\S)|\s"
SPECIAL = {"<|endoftext|>": 50256}
#: Longest run of white space that the pattern's look-ahead is left to step back through; the
#: class is that of the pattern's \s.
LONG_RUN = 1 << 16
_SPACE = r"[\t-\r \x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000]"
_LONG = re.compile(f"(?<!{_SPACE}){_SPACE}{{{LONG_RUN},}}+")

TOKENS_SCHEMA = "doc_id long, doc_tokens long, all_crc long, full_crcs array<long>, tail binary"
PIECES_SCHEMA = ("doc_id long, start long, length long, ids_crc32 long, doc_tokens long, "
                 "sequence_id long, offset long")


@lru_cache(maxsize=2)
def encoder(path: str) -> tiktoken.Encoding:
    """Byte-level BPE of a rank file (base64 token, id a line)."""
    with open(path, "rb") as lines:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}
    return tiktoken.Encoding("byte-bpe", pat_str=SPLIT_PATTERN, mergeable_ranks=ranks,
                             special_tokens=SPECIAL)


def _parts(text: str) -> Iterator[str]:
    """A text cut inside its long runs of white space, where the pattern splits it anyway.

    A run's last character goes with what follows, unless that is a special token.
    """
    at = 0
    for m in _LONG.finditer(text) if len(text) > LONG_RUN else ():
        end = m.end() if text.startswith(tuple(SPECIAL), m.end()) else m.end() - 1
        if m.end() < len(text):
            yield text[at:end]
            at = end
    yield text[at:]


def token_ids(path: str, text: str | None) -> np.ndarray:
    """Ids of a text and the end id, as unsigned 32-bit little-endian numbers."""
    ids = [i for part in _parts(text or "") for i in encoder(path).encode(part, allowed_special="all")]
    ids.append(END_ID)
    return np.array(ids, "<u4")


def crc(ids: np.ndarray) -> int:
    return zlib.crc32(ids.tobytes())


def _tokens(path: str, length: int) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, 512):
                part = batch.slice(at, 512)
                totals, whole, fulls, tails = [], [], [], []
                for text in part.column(1):
                    ids = token_ids(path, text.as_py())
                    cut = len(ids) // length * length
                    totals.append(len(ids))
                    whole.append(crc(ids))
                    fulls.append([crc(ids[i:i + length]) for i in range(0, cut, length)])
                    tails.append(ids[cut:].tobytes())
                yield pa.record_batch([part.column(0), pa.array(totals, pa.int64()),
                                       pa.array(whole, pa.int64()),
                                       pa.array(fulls, pa.list_(pa.int64())),
                                       pa.array(tails, pa.binary())],
                                      names=["doc_id", "doc_tokens", "all_crc", "full_crcs", "tail"])
    return run


def assign(lengths: list[int], capacity: int) -> list[list[tuple[int, int, int, int]]]:
    """For each length, in descending order: (start, length, sequence, offset) of its pieces."""
    count = -(-sum(lengths) // capacity)
    cost = np.zeros(count, np.int64)
    room = np.full(count, capacity, np.int64)
    placed = []
    for n in lengths:
        start, pieces = 0, []
        while start < n:
            left = n - start
            fits = np.flatnonzero(room >= left)
            if len(fits):
                s, take = int(fits[np.argmin(cost[fits])]), left
            else:
                s = int(np.argmax(room))
                take = int(room[s])
            pieces.append((start, take, s, int(capacity - room[s])))
            room[s] -= take
            cost[s] += LINEAR * take + take * take
            start += take
        placed.append(pieces)
    return placed


def _pack(length: int) -> Callable[[tuple, pa.Table], pa.Table]:
    def run(key: tuple, table: pa.Table) -> pa.Table:
        rows = table.select(["doc_id", "doc_tokens", "all_crc", "full_crcs", "tail"]).to_pylist()
        rows.sort(key=lambda r: (-len(r["tail"]), r["doc_id"] is None, r["doc_id"] or 0, r["all_crc"]))
        tails = assign([len(r["tail"]) // 4 for r in rows], length)
        sequence = 1 + max((p[2] for pieces in tails for p in pieces), default=-1)
        first = key[0].as_py() << 32
        out = []
        for r, pieces in zip(rows, tails):
            done = len(r["full_crcs"]) * length
            for k, value in enumerate(r["full_crcs"]):
                out.append((r["doc_id"], k * length, length, value, r["doc_tokens"], first + sequence, 0))
                sequence += 1
            for start, n, s, offset in pieces:
                value = zlib.crc32(r["tail"][4 * start:4 * (start + n)])
                out.append((r["doc_id"], done + start, n, value, r["doc_tokens"], first + s, offset))
        columns = list(zip(*out)) or [[]] * 7
        return pa.table([pa.array(c, pa.int64()) for c in columns],
                        names=[c.split()[0] for c in PIECES_SCHEMA.split(", ")])
    return run


def pack_documents(docs: DataFrame, ranks_path: str, length: int = SEQUENCE_TOKENS,
                   block_docs: int = BLOCK_DOCS) -> DataFrame:
    """One row for each piece of each document: where it starts and which sequence holds it."""
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"),
                        F.col("text").cast("string").alias("text"))
    rows = texts.count()
    blocks = max(1, -(-rows // block_docs))
    slot = F.pmod(F.xxhash64("doc_id"), F.lit(ID_SLOTS))
    crowded = [r.slot for r in texts.groupBy(slot.alias("slot")).agg(F.count(F.lit(1)).alias("n"))
               .where(F.col("n") > block_docs + 2 * rows // ID_SLOTS).collect()]
    tokens = texts.mapInArrow(_tokens(ranks_path, length), TOKENS_SCHEMA)
    dealt = F.when(slot.isin(crowded), F.xxhash64("doc_id", "all_crc", F.monotonically_increasing_id())) \
        .otherwise(F.xxhash64("doc_id", "all_crc"))
    return (tokens.withColumn("block", F.pmod(dealt, F.lit(blocks)))
            .groupBy("block").applyInArrow(_pack(length), PIECES_SCHEMA))
