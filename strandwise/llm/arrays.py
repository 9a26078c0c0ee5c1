"""Passes over arrays within a row, by built-in functions, in time that grows with the array."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

#: Elements whose results are gathered before they are put to the others.
BLOCK = 64


def let(value: Column, then) -> Column:
    """then(x), where x stands for the value and is computed once.

    A column that stands in a lambda may be written out in it by the optimizer, and is
    then computed for each element; a lambda's own variable never is.
    """
    return F.get(F.transform(F.array(value), then), F.lit(0))


def fold(values: Column, state: Column, step, kind: str, finish=None) -> Column:
    """All that step(state, x) -> (state, array of kind) makes along an array, and finish(state) at its end.

    Appending copies an array, so results are gathered in blocks, and blocks are put
    together once: the copies stay few also for very many elements.
    """
    none, none_of_blocks = F.array().cast(f"array<{kind}>"), F.array().cast(f"array<array<{kind}>>")

    def held(state: Column, out: Column) -> Column:
        return F.struct(state.alias("state"), out.alias("out"))

    def one(a: Column, x: Column) -> Column:
        then, made = step(a.state, x)
        return held(then, F.concat(a.out, made))

    def block(a: Column, part: Column) -> Column:
        done = F.aggregate(part, held(a.state, none), one)
        return let(done, lambda d: held(d.state, F.array_append(a.out, d.out)))

    def whole(all_values: Column) -> Column:
        last = F.floor((F.size(all_values) - 1) / BLOCK).cast("int")
        blocks = F.transform(F.sequence(F.lit(0), last), lambda k: F.slice(all_values, k * BLOCK + 1, F.lit(BLOCK)))
        end = (lambda d: F.concat(F.flatten(d.out), finish(d.state))) if finish else (lambda d: F.flatten(d.out))
        return F.when(F.size(all_values) > 0, let(F.aggregate(blocks, held(state, none_of_blocks), block), end)).otherwise(none)

    return let(values, whole)


def totals(values: Column) -> Column:
    """Running totals of an array of int, each element included."""
    return fold(values, F.lit(0), lambda total, x: (total + x, F.array(total + x)), "int")
