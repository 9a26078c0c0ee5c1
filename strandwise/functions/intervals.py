"""Column expressions over closed intervals [s, e]."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

#: Transcript ids are (chromosome, strand, position) in one number; positions stay below this.
POSITIONS = 10**12


def length(s="s", e="e") -> Column:
    return F.col(e) - F.col(s) + 1


def overlaps(a: str, b: str) -> Column:
    """Intervals of two aliases or structs share a position."""
    return (F.col(f"{a}.s") <= F.col(f"{b}.e")) & (F.col(f"{b}.s") <= F.col(f"{a}.e"))


def contains(a: str, b: str) -> Column:
    return (F.col(f"{a}.s") <= F.col(f"{b}.s")) & (F.col(f"{b}.e") <= F.col(f"{a}.e"))


def place_id(position: str) -> Column:
    return ((F.col("chr") * 2 + F.col("strand")) * F.lit(POSITIONS) + F.col(position)).cast("long")


def chromosome_of(transcript_id: str) -> Column:
    """The chromosome that a transcript id tells."""
    return F.floor(F.col(transcript_id) / F.lit(2 * POSITIONS)).cast("long")


def rpkm(s, e, tags, total) -> Column:
    """Tags per kilobase and million tags of one run."""
    return F.col(tags) / ((F.col(e) - F.col(s) + 1) / 1000.0) / (F.col(total) / 1000000.0)
