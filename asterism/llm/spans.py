"""Positions of regular-expression matches, with array functions only."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from asterism.llm.common import bind

#: Lengths summed at once; sums of n lengths cost about n * BLOCK / 2 steps.
BLOCK = 64
#: Characters kept of what stands before and after a match.
BEFORE, AFTER = 40, 24
#: Length of the shortest match of any pattern, by which matches within those characters are counted.
LEAST = 5

SPAN, CONTEXT = "start:int,end:int,hit:string", ",before:string,after:string"


def _sum(xs: Column) -> Column:
    return F.aggregate(xs, F.lit(0), lambda a, x: a + x)


def find_spans(text: Column, pattern: str, context: bool = False) -> Column:
    """All leftmost non-overlapping matches: array of (start, end, hit), with context also (before, after).

    Offsets count code points, end exclusive. They come from the lengths of the
    pieces between matches, summed blockwise, so the cost grows with the matches
    and not with their square. ``before`` and ``after`` are the nearest characters of
    the text, neighbouring matches included. Matches must have LEAST characters or more
    for that, and never be empty.
    """
    def around(x: Column) -> Column:
        """What stands before and after each match, from the pieces beside it, each cut to what can be needed."""
        last = lambda c: F.right(c, F.lit(BEFORE))
        next_ = lambda c: F.left(c, F.lit(AFTER))
        n = F.size(x["hits"])
        cut = F.struct(
            F.zip_with(F.slice(x["gaps"], 1, n), x["hits"], lambda g, h: last(F.concat(last(g), last(h)))).alias("left"),
            F.zip_with(x["hits"], F.slice(x["gaps"], 2, n), lambda h, g: next_(F.concat(next_(h), next_(g)))).alias("right"))

        def near(cut: Column) -> Column:
            def one(_: Column, i: Column) -> Column:
                first = F.greatest(i - BEFORE // LEAST, F.lit(0))
                before = F.concat(F.array_join(F.slice(cut["left"], first + 1, i - first), ""),
                                  last(F.element_at(x["gaps"], i + 1)))
                after = F.concat(next_(F.element_at(x["gaps"], i + 2)),
                                 F.array_join(F.slice(cut["right"], i + 2, F.lit(AFTER // LEAST + 1)), ""))
                return F.struct(last(before).alias("before"), next_(after).alias("after"))

            return F.transform(x["hits"], one)

        return bind(cut, near)

    def placed(found: Column) -> Column:
        hits, gaps = found["hits"], found["gaps"]
        lengths = F.zip_with(F.slice(gaps, 1, F.size(hits)), hits, lambda g, h: F.length(g) + F.length(h))
        return bind(F.struct(hits.alias("hits"), (around(found) if context else F.lit(None)).alias("near"), lengths.alias("lengths")), summed)

    def summed(x: Column) -> Column:
        blocks = F.transform(F.sequence(F.lit(0), F.floor((F.size(x["hits"]) - 1) / BLOCK).cast("int")),
                             lambda b: _sum(F.slice(x["lengths"], b * BLOCK + 1, BLOCK)))
        return bind(F.struct(x["hits"].alias("hits"), x["near"].alias("near"), x["lengths"].alias("lengths"),
                             blocks.alias("blocks")), blocked)

    def blocked(x: Column) -> Column:
        before_block = F.transform(x["blocks"], lambda _, b: _sum(F.slice(x["blocks"], F.lit(1), b)))
        return bind(F.struct(x["hits"].alias("hits"), x["near"].alias("near"), x["lengths"].alias("lengths"),
                             before_block.alias("sums")), spans)

    def spans(x: Column) -> Column:
        def one(hit: Column, i: Column) -> Column:
            b = F.floor(i / BLOCK).cast("int")
            end = (F.element_at(x["sums"], b + 1)
                   + _sum(F.slice(x["lengths"], b * BLOCK + 1, i - b * BLOCK + 1)))
            near = F.element_at(x["near"], i + 1) if context else None
            return F.struct((end - F.length(hit)).alias("start"), end.alias("end"), hit.alias("hit"),
                            *[near[side].alias(side) for side in ("before", "after") if context])

        return F.transform(x["hits"], one)

    hits = F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
    none = F.array().cast(f"array<struct<{SPAN}{CONTEXT if context else ''}>>")
    return bind(hits, lambda h: F.when(F.size(h) == 0, none).otherwise(
        bind(F.struct(h.alias("hits"), F.split(text, pattern, -1).alias("gaps")), placed)))


def joined(spans: Column, kinds: list[str]) -> Column:
    """``kind:start:end`` of sorted spans, comma-joined; ``kind`` is an index into ``kinds``."""
    names = F.array(*[F.lit(k) for k in kinds])
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(
        ":", F.element_at(names, s["kind"] + 1), s["start"].cast("string"), s["end"].cast("string"))), ",")
