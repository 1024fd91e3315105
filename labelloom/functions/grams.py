"""Counts of hashed character n-grams, by numpy on Arrow batches: the vectors of RegexTokenizer, NGram and HashingTF."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import keyword_only
from pyspark.ml import Transformer
from pyspark.ml.linalg import VectorUDT
from pyspark.ml.param import Param, Params, TypeConverters
from pyspark.ml.param.shared import HasInputCol, HasNumFeatures, HasOutputCol
from pyspark.ml.util import DefaultParamsReadable, DefaultParamsWritable
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.functions import arrow_udf

#: Bytes of text that are looked at together; a longer text is looked at alone.
PART_BYTES = 1 << 18


class CharGrams(Transformer, HasInputCol, HasOutputCol, HasNumFeatures, DefaultParamsReadable, DefaultParamsWritable):
    """A lower-cased text to the counts of its hashed character n-grams.

    The vectors are those of ``RegexTokenizer`` by character, ``NGram`` and ``HashingTF``, whose strings and arrays of
    them, one per character, cost many times the counting. Lower-casing is that of Spark's ``lower``: only for a capital
    sigma next to marks or rare letters may it choose the other small one. A null text has no n-grams.
    """

    n = Param(Params._dummy(), "n", "characters of an n-gram", typeConverter=TypeConverters.toInt)

    @keyword_only
    def __init__(self, *, inputCol: str | None = None, outputCol: str | None = None, n: int = 3, numFeatures: int = 1 << 16):
        super().__init__()
        self._set(**self._input_kwargs)

    def _transform(self, dataset: DataFrame) -> DataFrame:
        text = F.lower(F.coalesce(F.col(self.getInputCol()), F.lit("")))
        return dataset.withColumn(self.getOutputCol(), gram_counts(self.getOrDefault("n"), self.getNumFeatures())(text))


def gram_counts(n: int, features: int):
    """A column function from texts to sparse vectors. What it calls is local, so that it is shipped to the executors by
    value and they need no copy of this module."""
    part_bytes = PART_BYTES

    def rotated(x, r: int):
        return (x << np.uint32(r)) | (x >> np.uint32(32 - r))

    def mixed(k):
        return rotated(k * np.uint32(0xCC9E2D51), 15) * np.uint32(0x1B873593)

    def hashes(codes, lengths):
        """Murmur3, as HashingTF has it, of the UTF-8 bytes of characters joined by spaces.

        ``codes`` are the UTF-8 bytes of each n-gram's characters as little-endian numbers; all n-grams have characters of
        the same ``lengths``.
        """
        total = sum(lengths) + n - 1
        words = [np.zeros(len(codes[0]), "uint32") for _ in range(total // 4 + 2)]
        at = 0
        for k, (code, length) in enumerate(zip(codes, lengths)):
            if k:
                words[at // 4] |= np.uint32(0x20 << at % 4 * 8)
                at += 1
            words[at // 4] |= code << np.uint32(at % 4 * 8)
            if at % 4 + length > 4:
                words[at // 4 + 1] |= code >> np.uint32(32 - at % 4 * 8)
            at += length
        h = np.full(len(codes[0]), 42, "uint32")
        for word in words[: total // 4]:
            h = rotated(h ^ mixed(word), 13) * np.uint32(5) + np.uint32(0xE6546B64)
        if total % 4:
            h ^= mixed(words[total // 4])
        h ^= np.uint32(total)
        h = (h ^ (h >> np.uint32(16))) * np.uint32(0x85EBCA6B)
        h = (h ^ (h >> np.uint32(13))) * np.uint32(0xC2B2AE35)
        return (h ^ (h >> np.uint32(16))).view("int32") % np.int32(features)  # numpy's sign is the divisor's

    def utf8(points):
        """UTF-8 bytes of code points as little-endian numbers, and how many they are."""
        if not len(points) or points.max() < 0x80:
            return points, None
        size = 1 + (points >= 0x80).astype("int8") + (points >= 0x800) + (points >= 0x10000)
        code = points.copy()
        for length, lead in ((2, 0xC0), (3, 0xE0), (4, 0xF0)):
            if len(at := np.flatnonzero(size == length)):
                p = points[at]
                out = (p >> np.uint32(6 * (length - 1))) | np.uint32(lead)
                for k in range(1, length):
                    out |= ((p >> np.uint32(6 * (length - 1 - k)) & np.uint32(0x3F)) | np.uint32(0x80)) << np.uint32(8 * k)
                code[at] = out
        return code, size

    def counted(texts: pa.Array) -> pa.Array:
        points = np.frombuffer("".join(texts.to_pylist()).encode("utf-32-le"), "uint32")
        sizes = pc.utf8_length(texts).to_numpy(zero_copy_only=False).astype("int64")
        grams = max(0, len(points) - n + 1)
        row = np.repeat(np.arange(len(sizes)), sizes)
        code, size = utf8(points)
        codes = [code[k : grams + k] for k in range(n)]
        index = hashes(codes, [1] * n)
        if size is not None:  # once more where not all characters are single bytes
            odd = np.flatnonzero(sum(size[k : grams + k] > 1 for k in range(n)))
            form = sum(size[odd + k].astype("int64") * 5**k for k in range(n))
            for one in np.unique(form):
                at = odd[form == one]
                index[at] = hashes([c[at] for c in codes], [int(one) // 5**k % 5 for k in range(n)])
        keys = (row[:grams] * features + index)[row[:grams] == row[n - 1 :][:grams]]  # of one text only
        keys.sort()
        first = np.flatnonzero(np.diff(keys, prepend=-1))
        keys, values = keys[first], np.diff(first, append=len(keys)).astype("float64")
        offsets = pa.array(np.searchsorted(keys, np.arange(len(sizes) + 1) * features).astype("int32"))
        return pa.StructArray.from_arrays(
            [
                pa.array(np.zeros(len(sizes), "int8")),
                pa.array(np.full(len(sizes), features, "int32")),
                pa.ListArray.from_arrays(offsets, pa.array((keys % features).astype("int32"))),
                pa.ListArray.from_arrays(offsets, pa.array(values)),
            ],
            names=["type", "size", "indices", "values"],
        )

    def run(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for texts in batches:
            ends = np.cumsum(pc.binary_length(texts).to_numpy(zero_copy_only=False).astype("int64"))
            parts, start = [], 0
            while start < len(texts):
                before = ends[start - 1] if start else 0
                end = max(start + 1, int(np.searchsorted(ends, before + part_bytes, "right")))
                parts.append(counted(texts.slice(start, end - start)))
                start = end
            yield pa.concat_arrays(parts) if parts else counted(texts)

    return arrow_udf(run, VectorUDT())
