"""Positions of regular-expression matches with built-in SQL functions, in time close to linear in the text and its matches.

``aggregate`` copies its state at every step, so an array must not grow in it over many elements. Running sums are taken
in chunks of ``CHUNK`` numbers instead, each shifted by the chunks before it. Places in a text are reached
through its blocks of ``BLOCK`` code points, as a substring counts from the start of its string. Overlaps are counted by
binary search in sorted starts and ends.
"""

from __future__ import annotations

from collections.abc import Callable

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F

from loanlens.functions.linalg import let

SPAN_TYPE = "array<struct<start:int,end:int,value:string>>"
CHUNK = 256
BLOCK = 1024


def no_spans() -> Column:
    return F.array().cast(SPAN_TYPE)


def running(numbers: Column, combine: Callable[[Column, Column], Column], start: int) -> Column:
    """``combine`` of each element of an ``array<int>`` with all before it, from ``start`` on (its neutral element)."""
    first = F.array(F.lit(start))
    last = lambda a: F.element_at(a, -1)
    grow = lambda a, x: F.concat(a, F.array(combine(last(a), x)))

    def chunked(numbers: Column) -> Column:
        places = F.sequence(F.lit(0), F.floor((F.size(numbers) - 1) / CHUNK).cast("int"))
        own = F.transform(places, lambda j: F.aggregate(F.slice(numbers, j * CHUNK + 1, CHUNK), first, grow))
        return let(own, shifted)

    def shifted(own: Column) -> Column:
        before = F.aggregate(own, first, lambda a, c: grow(a, last(c)))
        whole = F.zip_with(own, F.slice(before, 1, F.size(own)), lambda c, o: F.transform(F.slice(c, 2, F.size(c) - 1), lambda x: combine(o, x)))
        return F.flatten(whole)

    return F.when(F.size(numbers) > 0, let(numbers, chunked)).otherwise(F.array().cast("array<int>"))


def match_spans(text: Column, pattern: str) -> Column:
    """Leftmost non-overlapping matches as ``array<struct<start, end, value>>`` in code points, end exclusive.

    ``split`` gives the gaps between the matches, ``regexp_extract_all`` the matches; running lengths
    give the places. ``pattern`` must not match the empty string.
    """
    gaps = F.split(text, pattern, -1)

    def placed(found: Column) -> Column:
        steps = F.zip_with(found, F.slice(gaps, 1, F.size(found)), lambda m, g: F.char_length(g) + F.char_length(m))
        span = lambda m, end: F.struct((end - F.char_length(m)).alias("start"), end.alias("end"), m.alias("value"))
        return F.zip_with(found, running(steps, lambda a, b: a + b, 0), span)

    located = let(F.regexp_extract_all(text, F.lit(pattern), F.lit(0)), lambda found: F.when(F.size(found) > 0, placed(found)).otherwise(no_spans()))
    return F.coalesce(located, no_spans())


def _below(numbers: Column, limit: Column, inclusive: bool) -> Column:
    """How many of the sorted ``numbers`` are below ``limit`` (or equal to it)."""

    def step(low: Column, power: Column) -> Column:
        probe = low + power  # null past the last number: not below
        here = F.get(numbers, probe - 1)
        return F.when((here <= limit) if inclusive else (here < limit), probe).otherwise(low)

    return F.aggregate(F.array(*(F.lit(1 << k) for k in reversed(range(31)))), F.lit(0), step)


def outside(spans: Column, others: Column) -> Column:
    """The ``spans`` that overlap none of ``others`` (any order, may overlap each other).

    A span overlaps as many others as start before its end, less those that end by its start.
    """
    starts = lambda o: F.array_sort(F.transform(o, lambda s: s["start"]))
    ends = lambda o: F.array_sort(F.transform(o, lambda s: s["end"]))

    def apart(at: Column, to: Column) -> Column:
        return F.filter(spans, lambda s: _below(at, s["end"], False) == _below(to, s["start"], True))

    kept = let(starts(others), lambda at: let(ends(others), lambda to: apart(at, to)))
    return F.when((F.size(spans) > 0) & (F.size(others) > 0), kept).otherwise(spans)


def text_blocks(text: Column) -> Column:
    """``text`` in blocks of ``BLOCK`` code points."""
    return F.regexp_extract_all(text, F.lit(f"(?s).{{1,{BLOCK}}}"), F.lit(0))


def text_between(blocks: Column, start: Column, end: Column) -> Column:
    """Code points ``start`` to ``end`` (exclusive) of a text given as :func:`text_blocks`."""
    first, last = F.floor(start / BLOCK).cast("int"), F.floor((end - 1) / BLOCK).cast("int")

    def part(i: Column) -> Column:
        a, b = F.greatest(start - i * BLOCK, F.lit(0)), F.least(end - i * BLOCK, F.lit(BLOCK))
        return F.substring(F.get(blocks, i), a + 1, b - a)

    return F.when(end > start, F.array_join(F.transform(F.sequence(first, F.greatest(first, last)), part), "")).otherwise(F.lit(""))


def characters(text: Column) -> Column:
    """The code points of a string, one an element."""
    return F.regexp_extract_all(text, F.lit("(?s)."), F.lit(0))


def joined(spans: Column) -> Column:
    """``kind:start:end`` of each span, comma-joined in the order given."""
    return F.array_join(
        F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ","
    )
