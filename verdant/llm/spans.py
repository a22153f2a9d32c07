"""Places of regular-expression matches in texts, with SQL functions only (JVM side).

``regexp_extract_all`` gives the matches and ``split`` the gaps between them; their lengths add up to the matches'
places in code points.  Texts without a match pay for one search only.  Work per text is in proportion to its length
and its matches: sums run over blocks of ``BLOCK`` matches, and slices over chunks of ``CHUNK`` code points.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

BLOCK = 64
CHUNK = 4096
#: One match: code points from 0, end exclusive.
SPAN = "struct<start:long,end:long,text:string>"


def _total(sizes: Column) -> Column:
    return F.aggregate(sizes, F.lit(0).cast("long"), lambda a, x: a + x)


def locate(df: DataFrame, text: str, patterns: dict[str, tuple[str, Callable[[Column], Column] | None]]) -> DataFrame:
    """Add for each name an array of spans: leftmost non-overlapping matches of the pattern that pass the test.

    Matches that fail the test are dropped and not tried again.  Each step is a column of its own, so that Spark
    computes it once.
    """
    names = {step: {k: f"_{step}_{k}" for k in patterns} for step in ("found", "gaps", "sizes", "totals", "offsets")}
    found, gaps, sizes, totals, offsets = names.values()

    def when_some(k: str, value: Column) -> Column:
        return F.when(F.size(found[k]) > 0, value)

    def size_list(k: str) -> Column:
        return F.transform(found[k], lambda x, i: (F.length(F.get(gaps[k], i)) + F.length(x)).cast("long"))

    def block_totals(k: str) -> Column:
        blocks = F.sequence(F.lit(0), F.floor((F.size(found[k]) - 1) / BLOCK).cast("int"))
        return F.transform(blocks, lambda b: _total(F.slice(F.col(sizes[k]), b * BLOCK + 1, F.lit(BLOCK))))

    def block_offsets(k: str) -> Column:
        return F.aggregate(totals[k], F.array(F.lit(0).cast("long")), lambda a, x: F.concat(a, F.array(F.element_at(a, -1) + x)))

    def spans(k: str) -> Column:
        def at(x: Column, i: Column) -> Column:
            block = F.floor(i / BLOCK).cast("int")
            start = F.get(offsets[k], block) + _total(F.slice(F.col(sizes[k]), block * BLOCK + 1, i % BLOCK)) + F.length(F.get(gaps[k], i))
            return F.struct(start.alias("start"), (start + F.length(x)).alias("end"), x.alias("text"))

        every, test = F.transform(found[k], at), patterns[k][1]
        return every if test is None else F.filter(every, lambda x: test(x["text"]))

    df = df.withColumns({found[k]: F.regexp_extract_all(text, F.lit(p), F.lit(0)) for k, (p, _) in patterns.items()})
    df = df.withColumns({gaps[k]: when_some(k, F.split(text, p, -1)) for k, (p, _) in patterns.items()})
    for step, make in ((sizes, size_list), (totals, block_totals), (offsets, block_offsets)):
        df = df.withColumns({step[k]: when_some(k, make(k)) for k in patterns})
    df = df.withColumns({k: F.coalesce(when_some(k, spans(k)), F.array().cast(f"array<{SPAN}>")) for k in patterns})
    return df.drop(*(c for step in names.values() for c in step.values()))


def chunks(text: Column) -> Column:
    """The text in pieces of ``CHUNK`` code points."""
    return F.regexp_extract_all(text, F.lit(f"(?s).{{1,{CHUNK}}}"), F.lit(0))


def piece(chunked: str, start: Column, end: Column) -> Column:
    """Code points start .. end of a text cut by ``chunks`` (a column's name); costs a few chunks, not the text."""
    first, last = F.floor(start / CHUNK).cast("int"), F.floor((end - 1) / CHUNK).cast("int")

    def part(c: Column) -> Column:
        a = F.greatest(start - c * CHUNK, F.lit(0)).cast("int")
        b = F.least(end - c * CHUNK, F.lit(CHUNK)).cast("int")
        return F.substring(F.get(chunked, c), a + 1, b - a)

    return F.when(end > start, F.array_join(F.transform(F.sequence(first, last), part), "")).otherwise(F.lit(""))


def listed(kinds: dict[str, Column]) -> Column:
    """kind:start:end of all spans by start, then the order of the kinds, comma-joined."""
    def named(n: int, kind: str, spans: Column) -> Column:
        return F.transform(spans, lambda x: F.struct(x["start"].alias("start"), F.lit(n).alias("n"), x["end"].alias("end"), F.lit(kind).alias("kind")))

    every = F.concat(*(named(n, kind, spans) for n, (kind, spans) in enumerate(kinds.items())))
    return F.array_join(F.transform(F.array_sort(every), lambda x: F.concat_ws(":", x["kind"], x["start"], x["end"])), ",")
