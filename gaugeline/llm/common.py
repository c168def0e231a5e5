"""Helpers that the operators share: names of columns, deterministic splits and samples, batch slicing."""

from __future__ import annotations

import ctypes
import functools
from collections.abc import Callable, Iterator, Sequence

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.scratch import discard, materialize, scratch_root

__all__ = ["array_blocks", "bounded_sample", "columns_of", "discard", "free_name", "give_back", "held_out", "materialize", "named", "scratch_root", "slices", "text_blocks"]


def named(name: str) -> Column:
    """The column of exactly this name, whatever characters it holds."""
    return F.col("`" + name.replace("`", "``") + "`")


def columns_of(df: DataFrame) -> list[Column]:
    return [named(c) for c in df.columns]


def free_name(df: DataFrame, name: str) -> str:
    """``name``, with underscores until no column of ``df`` has it."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name += "_"
    return name


def held_out(doc_id: Column) -> Column:
    """True where crc32 of the id as text leaves 1 modulo 3 (a null id counts as the empty text)."""
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit(""))) % 3 == 1


def bounded_sample(rows: DataFrame, h: str, max_rows: int, different: int | None = None) -> DataFrame:
    """At most ``max_rows`` rows with different ``h``, those with the smallest, wherever they lie.

    A threshold on the hash passes about twice ``max_rows`` rows before they are ordered, so
    neither tasks nor the driver handle more when the input grows. Of rows with the same ``h`` the one
    whose other columns sort first is taken, so that the sample is the same in every run.
    ``different``: about how many values ``h`` has, if known.
    """
    if different is None:
        different = rows.agg(F.approx_count_distinct(h)).first()[0]
    share = min(1.0, 2 * max_rows / max(1, different))
    below = F.col(h) < F.lit(int(-(2**63) + share * (2**64 - 1))) if share < 1 else F.col(h).isNotNull()
    others = [c for c in rows.columns if c != h]
    first = rows.filter(below).groupBy(h).agg(F.min(F.struct(*map(named, others))).alias("r"))
    return first.orderBy(h).limit(max_rows).select(*[F.col("r").getField(c).alias(c) if c != h else F.col(h) for c in rows.columns])


def slices(lengths: Sequence[int], most: int) -> Iterator[tuple[int, int]]:
    """Ranges of consecutive items whose lengths sum to about ``most``; a longer item is alone."""
    start, total = 0, 0
    for i, n in enumerate(lengths):
        if i > start and total + n > most:
            yield start, i
            start, total = i, 0
        total += n
    if start < len(lengths):
        yield start, len(lengths)


def array_blocks(texts: pa.Array, most: int) -> Iterator[pa.Array]:
    """The texts in order, in slices of about ``most`` bytes."""
    sizes = pc.fill_null(pc.binary_length(texts), 0).to_numpy(zero_copy_only=False)
    for i, (a, b) in enumerate(slices(sizes.tolist(), most)):
        yield texts.slice(a, b - a)
        if i % 8 == 7:
            give_back()
    give_back()


def text_blocks(texts: pa.Array, most: int) -> Iterator[list[str]]:
    """The texts in order, in lists of about ``most`` bytes; null is empty. Only one list is turned into Python strings at a time."""
    for block in array_blocks(texts, most):
        yield [t or "" for t in block.to_pylist()]


@functools.cache
def _trim() -> Callable[[int], int] | None:
    return getattr(ctypes.CDLL(None), "malloc_trim", None)


def give_back() -> None:
    """Return memory that this worker has freed to the system.

    Workers are kept from stage to stage; what their allocators hold back from the largest block so
    far would count against the executor for as long as it lives.
    """
    pa.default_memory_pool().release_unused()
    trim = _trim()
    if trim:
        trim(0)
