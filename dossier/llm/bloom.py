"""A Bloom filter of fixed size that tasks build block by block and workers probe.

All bits of a key lie in one block, so that a block is the work of one task and
the whole, of a size given beforehand, is only put side by side.
"""

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from dossier.llm.words import mixed

BLOCK_BITS = 18
PROBES = 4
_STEP = np.uint64(0x9E3779B97F4A7C15)


def _places(keys: np.ndarray, level) -> list[np.ndarray]:
    """The places in its block of each key's bits, for one level (a number or one for each key)."""
    h = mixed(keys + np.asarray(level).astype(np.uint64) * _STEP)
    again = mixed(h)
    last = np.uint64((1 << BLOCK_BITS) - 1)
    places = [(h >> np.uint64(BLOCK_BITS * i)) & last for i in range(3)]
    return [*places, again & last][:PROBES]


class Bloom:
    """Packed bits; keys are unsigned 64-bit hashes, each with levels from 1 up."""

    def __init__(self, bits: np.ndarray, log2_blocks: int):
        self.bits, self.log2_blocks = bits, log2_blocks

    def _block(self, keys: np.ndarray) -> np.ndarray:
        if not self.log2_blocks:
            return np.zeros(len(keys), np.uint64)
        return keys >> np.uint64(64 - self.log2_blocks)

    def has(self, keys: np.ndarray, level=1) -> np.ndarray:
        """Whether each key may be there at a level; never false for one that is."""
        found = None
        start = self._block(keys) << np.uint64(BLOCK_BITS)
        for place in _places(keys, level):
            at = start + place if found is None else start[found] + place[found]
            bit = self.bits[(at >> np.uint64(3)).view(np.int64)] >> (at & np.uint64(7)).astype(np.uint8)
            kept = np.flatnonzero(bit & np.uint8(1))
            found = kept if found is None else found[kept]
        hit = np.zeros(len(keys), bool)
        hit[found] = True
        return hit

    def levels(self, keys: np.ndarray) -> np.ndarray:
        """How many levels each key has: it is probed for one after the other until one is missing."""
        level = np.zeros(len(keys), np.int64)
        open_keys = np.arange(len(keys))
        while len(open_keys):
            open_keys = open_keys[self.has(keys[open_keys], level[open_keys] + 1)]
            level[open_keys] += 1
        return level


def told_apart(df: DataFrame, key: str, keys: DataFrame, log2_bits: int = 26) -> tuple[DataFrame, DataFrame]:
    """The rows of ``df`` whose ``key`` may be in ``keys``, and those whose is not.

    So that only the former need be shuffled to meet ``keys``. The filter's size is
    fixed: with very many keys, all rows may be among the former.
    """
    hashed = keys.select(F.xxhash64(key).alias("key"), F.lit(1).alias("level"))
    probed = df.sparkSession.sparkContext.broadcast(build(hashed, log2_bits))

    def maybe(values: pa.Array) -> pa.Array:
        return pa.array(probed.value.has(values.to_numpy().view(np.uint64)))

    hit = F.arrow_udf(maybe, "boolean")(F.xxhash64(key))
    return df.where(hit), df.where(~hit)


def blocks(rows: DataFrame, log2_bits: int, part: Column | None = None) -> DataFrame:
    """``block`` and its ``bits`` for the filter of ``key`` (bigint) at the levels 1 to ``level`` (int); ``2 ** log2_bits`` bits.

    With ``part`` (an int) for one filter of this size for each part: the blocks of part p are those from p times the
    number of blocks on.
    """
    log2_blocks = max(0, log2_bits - BLOCK_BITS)
    block = F.shiftrightunsigned("key", 64 - log2_blocks) if log2_blocks else F.lit(0).cast("bigint")
    if part is not None:
        block += F.shiftleft(part.cast("bigint"), log2_blocks)
    dealt = rows.select(block.cast("int").alias("block"), "key", "level")
    dealt = dealt.repartition("block").sortWithinPartitions("block")

    def fill(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        current, marked = None, None
        kinds = pa.schema([("block", pa.int32()), ("bits", pa.binary())])

        def closed():
            bits = np.packbits(marked, bitorder="little").tobytes()
            return pa.RecordBatch.from_pylist([{"block": current, "bits": bits}], kinds)

        for batch in batches:
            block, key, level = (c.to_numpy() for c in batch.columns)
            key = key.view(np.uint64)
            cuts = np.concatenate([[0], np.flatnonzero(np.diff(block)) + 1, [len(block)]])
            for a, b in zip(cuts[:-1].tolist(), cuts[1:].tolist(), strict=True):
                if a == b:
                    continue
                if block[a] != current:
                    if current is not None:
                        yield closed()
                    current, marked = int(block[a]), np.zeros(1 << BLOCK_BITS, bool)
                each = np.repeat(key[a:b], level[a:b])
                ends = np.cumsum(level[a:b])
                which = np.arange(len(each)) - np.repeat(ends - level[a:b], level[a:b]) + 1
                for place in _places(each, which):
                    marked[place] = True
        if current is not None:
            yield closed()

    return dealt.mapInArrow(fill, "block int, bits binary")


def assembled(filled: DataFrame, log2_bits: int) -> Bloom:
    """The filter whose ``blocks`` these are, whichever its part."""
    bits = np.zeros(1 << (max(log2_bits, BLOCK_BITS) - 3), np.uint8)
    size = 1 << (BLOCK_BITS - 3)
    table = filled.select("block", "bits").toArrow()  # a row for each block at most
    for block, own in zip(table.column("block"), table.column("bits"), strict=True):
        at = block.as_py() * size % len(bits)
        bits[at : at + size] = np.frombuffer(own.as_buffer(), np.uint8)
    return Bloom(bits, max(0, log2_bits - BLOCK_BITS))


def build(rows: DataFrame, log2_bits: int) -> Bloom:
    """The filter of ``key`` (bigint) at the levels 1 to ``level`` (int); ``2 ** log2_bits`` bits."""
    return assembled(blocks(rows, log2_bits), log2_bits)
