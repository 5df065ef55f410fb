"""Fill-in-middle: texts cut into prefix, middle and suffix at unit borders.

A unit is a word with the white space before it; white space at the end of a
text is a unit of its own. Every text is laid out in blocks of ``BLOCK`` bytes.
A Fenwick tree over a text's blocks holds their numbers of unit ends and of code
points; a binary-lifting descent finds the block in which a cut's last unit ends
and what lies before it, and the bytes of that block alone give the border. The
trees of a chunk of texts are built and descended together in numpy.

Rows: a null text reads as empty, an empty text has no unit and stays plain, a
null id is the empty string in the draw. Every input row gives one row, repeated
rows too; columns other than the id and the text are ignored.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tierwise.llm.text import IS_SPACE, chunks

BLOCK = 256
_SLICE = 1 << 12  # blocks looked at together, which bounds the masks of a long text

PREFIX, SUFFIX, MIDDLE = "<P>", "<S>", "<M>"
PLAIN, PSM, SPM = "plain", "psm", "spm"


def _lowest_bit(n: np.ndarray) -> np.ndarray:
    return n & -n


class BlockTrees:
    """Fenwick trees over the blocks of each text of a chunk."""

    def __init__(self, data: np.ndarray, offs: np.ndarray) -> None:
        self.data, self.offs = data, offs
        sizes = np.diff(offs)
        self.blocks = -(-sizes // BLOCK)
        self.base = np.concatenate([[0], np.cumsum(self.blocks)])
        text = np.repeat(np.arange(len(sizes)), self.blocks)
        place = np.arange(self.base[-1]) - self.base[text]
        self.starts = offs[text] + place * BLOCK
        self.ends = np.minimum(self.starts + BLOCK, offs[text + 1])
        units, points = self._counts()
        self.units = np.bincount(text, units, len(sizes)).astype(np.int64)
        self.unit_tree = self._tree(units, text, place)
        self.point_tree = self._tree(points, text, place)

    def unit_ends(self, at: np.ndarray, last: np.ndarray) -> np.ndarray:
        """Whether a unit ends with the byte at each place; ``last``: where a text's last byte is."""
        after = self.data[np.minimum(at + 1, len(self.data) - 1)]
        return (~IS_SPACE[self.data[at]] & IS_SPACE[after]) | (at == last)

    def _counts(self) -> tuple[np.ndarray, np.ndarray]:
        n = len(self.starts)
        units, points = np.zeros(n, np.int64), np.zeros(n, np.int64)
        is_last = np.zeros(n, bool)
        is_last[self.base[1:][self.blocks > 0] - 1] = True
        for a in range(0, n, _SLICE):
            b = min(n, a + _SLICE)
            first, end = self.starts[a], self.ends[b - 1]
            at = np.arange(first, end)
            ends = self.unit_ends(at, -1)
            ends[self.ends[a:b][is_last[a:b]] - 1 - first] = True
            begin = (self.data[first:end] & 0xC0) != 0x80
            cut = self.starts[a:b] - first
            units[a:b] = np.add.reduceat(ends.astype(np.int64), cut)
            points[a:b] = np.add.reduceat(begin.astype(np.int64), cut)
        return units, points

    def _tree(self, counts: np.ndarray, text: np.ndarray, place: np.ndarray) -> np.ndarray:
        """Node i of a text (from 1) holds the sum of the lowest-bit(i) blocks that end with block i."""
        sums = np.concatenate([[0], np.cumsum(counts)])
        i = place + 1
        upto = self.base[text] + i
        return sums[upto] - sums[upto - _lowest_bit(i)]

    def cut(self, k: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Byte place in the text and code points before the end of each text's k-th unit."""
        block = np.zeros(len(k), np.int64)
        left, points = k.astype(np.int64), np.zeros(len(k), np.int64)
        step = 1 << max(0, int(self.blocks.max(initial=0)).bit_length() - 1)
        while step and len(self.unit_tree):
            to = block + step
            node = np.minimum(self.base[:-1] + to - 1, len(self.unit_tree) - 1)
            go = (to <= self.blocks) & (self.unit_tree[node] < left)
            left = np.where(go, left - self.unit_tree[node], left)
            points = np.where(go, points + self.point_tree[node], points)
            block = np.where(go, to, block)
            step >>= 1
        byte = np.zeros(len(k), np.int64)
        some = np.flatnonzero(k > 0)
        for a in range(0, len(some), _SLICE):
            t = some[a:a + _SLICE]
            start = self.offs[t] + block[t] * BLOCK
            at = start[:, None] + np.arange(BLOCK)
            within = at < self.offs[t + 1][:, None]
            at = np.minimum(at, len(self.data) - 1)
            ends = self.unit_ends(at, self.offs[t + 1][:, None] - 1) & within
            border = np.argmax(np.cumsum(ends, axis=1) == left[t][:, None], axis=1)
            begin = ((self.data[at] & 0xC0) != 0x80) & (np.arange(BLOCK) <= border[:, None])
            byte[t] = start + border + 1 - self.offs[t]
            points[t] += begin.sum(axis=1)
        return byte, points


def _rearranged(percent: int, spm_percent: int) -> Callable[[Iterator[pa.RecordBatch]],
                                                           Iterator[pa.RecordBatch]]:
    marks = [m.encode() for m in (PREFIX, SUFFIX, MIDDLE)]
    p, s, m = marks

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for rows, data, offs in chunks(batch, "text"):
                h = [rows.column(f"h{k}").to_numpy(zero_copy_only=False) for k in range(1, 5)]
                trees = BlockTrees(data, offs)
                n = trees.units
                a, b = h[0] % (n + 1), h[1] % (n + 1)
                first, prefix_chars = trees.cut(np.minimum(a, b))
                second, both_chars = trees.cut(np.maximum(a, b))
                forms, outputs, plain = [], [], []
                for k in range(rows.num_rows):
                    raw = data[offs[k]:offs[k + 1]].tobytes()
                    form = (PLAIN if not raw or h[2][k] % 100 >= percent or any(x in raw for x in marks)
                            else SPM if h[3][k] % 100 < spm_percent else PSM)
                    pre, mid, suf = raw[:first[k]], raw[first[k]:second[k]], raw[second[k]:]
                    outputs.append(raw if form == PLAIN else p + pre + s + suf + m + mid if form == PSM
                                   else s + suf + p + pre + m + mid)
                    forms.append(form)
                    plain.append(form == PLAIN)
                hidden = np.array(plain, bool)
                yield pa.record_batch(
                    [rows.column("id"), pa.array(n), pa.array(forms, pa.string()),
                     pa.array(prefix_chars, mask=hidden),
                     pa.array(both_chars - prefix_chars, mask=hidden),
                     pa.array(outputs, pa.binary()).cast(pa.string())],
                    names=["id", "n", "form", "prefix_chars", "middle_chars", "output"])
    return run


def fill_in_middle(docs: DataFrame, seed: int = 42, percent: int = 50, spm_percent: int = 80,
                   id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """(id, n, form, prefix_chars, middle_chars, output) of every row of ``docs``.

    Four numbers are drawn from the SHA-256 of ``seed:id``. Two give the cuts
    among the n + 1 places between the n units, one lets ``percent`` of the texts
    be rearranged, one gives ``spm_percent`` of these the suffix first. A text
    that holds a marker stays plain, as it could not be read back.
    """
    draw = F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col(id_column).cast("string"), F.lit(""))), 256)
    numbers = [F.conv(F.substring(draw, 8 * k - 7, 8), 16, 10).cast("long").alias(f"h{k}")
               for k in range(1, 5)]
    kind = docs.schema[id_column].dataType.simpleString()
    found = docs.select(F.col(id_column).alias("id"), F.col(text_column).alias("text"), *numbers).mapInArrow(
        _rearranged(percent, spm_percent),
        f"id {kind}, n long, form string, prefix_chars long, middle_chars long, output string")
    return found.withColumnRenamed("id", id_column)


def restored(output: str = "output", form: str = "form") -> Column:
    """The text that an output of ``fill_in_middle`` was made from, given its form."""
    head = f"substring_index({output}, '{MIDDLE}', 1)"
    middle = f"substring_index({output}, '{MIDDLE}', -1)"

    def parts(first: str, second: str) -> tuple[str, str]:
        return (f"substring(substring_index({head}, '{second}', 1), {len(first) + 1})",
                f"substring_index({head}, '{second}', -1)")

    prefix, suffix = parts(PREFIX, SUFFIX)
    psm = f"concat({prefix}, {middle}, {suffix})"
    suffix, prefix = parts(SUFFIX, PREFIX)
    spm = f"concat({prefix}, {middle}, {suffix})"
    return F.expr(f"CASE {form} WHEN '{PSM}' THEN {psm} WHEN '{SPM}' THEN {spm} ELSE {output} END")
