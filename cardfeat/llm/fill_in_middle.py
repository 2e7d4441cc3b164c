"""Fill-in-the-middle: documents cut at two line borders and written in another order.

A unit is a line with its line end (``[^\\n]*\\n|[^\\n]+``). Two hashes of the id
name the units after which prefix and middle end. A text is laid out in fixed
blocks of ``BLOCK`` bytes; a Fenwick tree over the blocks holds how many units end
and how many code points begin in each. Binary lifting goes down the tree to the
block in which a cut lies, and only that block is searched for the border.

Null counts as an empty text; a null id as an empty number. An empty text, one
that holds a marker, and texts that the draw leaves out stay plain: the output is
the text, the lengths are null. Repeated rows give equal rows, an empty table an
empty result. A very long text costs time and memory in proportion to its bytes;
outputs leave a task in batches of some ``OUT_BYTES``.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cardfeat.llm.flat import Flat, flat
from cardfeat.llm.tables import small_batches

#: Fixed values of the output format.
PREFIX, SUFFIX, MIDDLE = "<P>", "<S>", "<M>"
SEED, RATE, SPM_RATE = 7, 100, 50

BLOCK = 4096
OUT_BYTES = 16 << 20
_NEWLINE = 10


class Fenwick:
    """Prefix sums of rows of counts, built and descended by the lowest bit of a block's number."""

    def __init__(self, counts: np.ndarray):
        sums = np.zeros((len(counts) + 1, counts.shape[1]), dtype=np.int64)
        np.cumsum(counts, axis=0, out=sums[1:])
        at = np.arange(len(counts) + 1)
        self.tree = sums - sums[at & (at - 1)]  # entry i: the blocks above i without its lowest bit, up to i
        self.tree[0] = 0

    def descend(self, wanted: int) -> tuple[int, np.ndarray]:
        """The block that holds unit end number ``wanted`` (from 1), and the sums of all blocks before it."""
        at, before, size = 0, np.zeros(self.tree.shape[1], dtype=np.int64), len(self.tree) - 1
        for bit in reversed(range(size.bit_length())):
            further = at + (1 << bit)
            if further <= size and before[0] + self.tree[further, 0] < wanted:
                at, before = further, before + self.tree[further]
        return at, before


class Blocks:
    """Unit ends and code points of consecutive texts, counted per block; blocks do not cross texts."""

    def __init__(self, part: Flat, block: int = BLOCK):
        sizes = np.diff(part.offsets)
        many = -(-sizes // block)
        self.first = np.concatenate(([0], np.cumsum(many)))
        text = np.repeat(np.arange(len(sizes)), many)
        self.starts = part.offsets[text] + (np.arange(self.first[-1]) - self.first[text]) * block
        self.data, self.offsets = part.data, part.offsets
        self.counts = np.zeros((len(self.starts), 2), dtype=np.int64)
        if len(self.starts):
            self.counts[:, 0] = np.add.reduceat((self.data == _NEWLINE).astype(np.int32), self.starts)
            self.counts[:, 1] = np.add.reduceat(((self.data & 0xC0) != 0x80).astype(np.int32), self.starts)
            filled = np.flatnonzero(sizes)
            last = part.offsets[filled + 1] - 1
            self.counts[self.first[filled + 1] - 1, 0] += self.data[last] != _NEWLINE  # the last line may lack its end
        ends = np.concatenate((np.zeros((1, 2), dtype=np.int64), np.cumsum(self.counts, axis=0)))
        self.units, self.points = (ends[self.first[1:]] - ends[self.first[:-1]]).T

    def cuts(self, text: int, units: tuple[int, ...]) -> list[tuple[int, int]]:
        """Where the first so many units of a text end: its bytes and code points up to there, for each of ``units``."""
        a, b = self.first[text], self.first[text + 1]
        tree = Fenwick(self.counts[a:b])
        begin, end, found = self.offsets[text], self.offsets[text + 1], []
        for wanted in units:
            if wanted == 0:
                found.append((0, 0))
            elif wanted >= self.units[text]:
                found.append((int(end - begin), int(self.points[text])))
            else:
                block, before = tree.descend(wanted)
                at = self.starts[a + block]
                until = end if a + block + 1 == b else self.starts[a + block + 1]
                inside = self.data[at:until]
                border = int(np.flatnonzero(inside == _NEWLINE)[wanted - before[0] - 1]) + 1
                points = int(before[1]) + int(np.count_nonzero((inside[:border] & 0xC0) != 0x80))
                found.append((int(at - begin) + border, points))
        return found


def _draws(key: Column, seed: int) -> list[Column]:
    """Four unsigned 32-bit numbers from a hash of seed and id."""
    digest = F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(key.cast("string"), F.lit(""))), 256)
    return [F.conv(F.substring(digest, 1 + 8 * k, 8), 16, 10).cast("bigint") for k in range(4)]


def fill_in_middle(
    docs: DataFrame,
    key: str = "doc_id",
    text: str = "text",
    seed: int = SEED,
    rate: int = RATE,
    spm_rate: int = SPM_RATE,
) -> DataFrame:
    """One row per document: ``doc_id``, ``n`` units, ``form`` (plain, psm, spm), ``prefix_chars``, ``middle_chars``, ``output``.

    ``rate`` percent of the documents are cut; of these ``spm_rate`` percent have the suffix in front.
    """
    whole = F.coalesce(F.col(f"`{text}`").cast("string"), F.lit(""))
    rows = docs.select(F.col(f"`{key}`").alias("doc_id"), whole.alias("text"))
    first, second, third, fourth = _draws(F.col("doc_id"), seed)
    marked = F.col("text").contains(PREFIX) | F.col("text").contains(SUFFIX) | F.col("text").contains(MIDDLE)
    plain = (F.col("text") == "") | marked | (third % 100 >= rate)
    form = F.when(plain, "plain").when(fourth % 100 < spm_rate, "spm").otherwise("psm")
    rows = rows.select("doc_id", "text", form.alias("form"), first.alias("first"), second.alias("second"))
    id_type = rows.schema["doc_id"].dataType.simpleString()
    schema = f"doc_id {id_type}, n bigint, form string, prefix_chars bigint, middle_chars bigint, output string"
    p, s, m = (x.encode() for x in (PREFIX, SUFFIX, MIDDLE))

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            part = flat(batch.column(1))
            blocks = Blocks(part)
            forms = batch.column(2).to_pylist()
            draws = [batch.column(k).to_pylist() for k in (3, 4)]
            done, held, out, prefix, middle = 0, 0, [], [], []

            def ready(until: int) -> pa.RecordBatch:
                columns = [batch.column(0)[done:until], pa.array(blocks.units[done:until], pa.int64()), batch.column(2)[done:until]]
                columns += [pa.array(prefix, pa.int64()), pa.array(middle, pa.int64())]
                columns.append(pa.array(out, pa.binary()).cast(pa.string()))
                return pa.RecordBatch.from_arrays(columns, ["doc_id", "n", "form", "prefix_chars", "middle_chars", "output"])

            for k, shape in enumerate(forms):
                raw = part.data[part.offsets[k] : part.offsets[k + 1]].tobytes()
                if shape == "plain":
                    sizes, made = (None, None), raw
                else:
                    n = int(blocks.units[k]) + 1
                    ends = sorted(draw[k] % n for draw in draws)
                    (x, before), (y, upto) = blocks.cuts(k, tuple(ends))
                    sizes = before, upto - before
                    made = b"".join((p, raw[:x], s, raw[y:], m, raw[x:y]) if shape == "psm" else (s, raw[y:], p, raw[:x], m, raw[x:y]))
                out.append(made)
                prefix.append(sizes[0])
                middle.append(sizes[1])
                held += len(made)
                if held > OUT_BYTES:
                    yield ready(k + 1)
                    done, held, out, prefix, middle = k + 1, 0, [], [], []
            if done < len(forms):
                yield ready(len(forms))

    return small_batches(rows).mapInArrow(cut, schema)


def restored(output: Column, form: Column) -> Column:
    """The text that an output was made of; markers never stand inside its parts."""
    parts = F.split(output, f"{PREFIX}|{SUFFIX}|{MIDDLE}")
    piece = lambda *numbers: F.concat(*(F.get(parts, F.lit(k)) for k in numbers))
    psm, spm = piece(1, 3, 2), piece(2, 3, 1)
    return F.when(form == "plain", output).when(form == "psm", psm).otherwise(spm)


def digest(made: DataFrame) -> DataFrame:
    """Outputs and restored texts as hashes."""
    back = restored(F.col("output"), F.col("form"))
    return made.select(
        "doc_id", "n", "form", "prefix_chars", "middle_chars",
        F.sha2(F.col("output").cast("binary"), 256).alias("output_sha256"),
        F.sha2(back.cast("binary"), 256).alias("restored_sha256"),
    )
