"""Personal data: candidate spans, scored by gradient-boosted trees.

High-recall patterns propose spans, which may overlap. Spans whose format can be
proven (base kinds) are always taken. The others get features of format and
context, and a boosted-tree score; a threshold calibrated for each kind on held
out candidates selects what is added, and of added ones that overlap the better
stays. Finding, features, trees and redaction are built-in functions over arrays
within the row: nothing is shuffled, no user function runs.
"""

from __future__ import annotations

import re
import uuid
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .arrays import fold, let, totals
from .common import body, materialize

# Base kinds in their order. Runs are taken possessively and start
# where the last match ended or a run begins, which finds the same spans as the
# plain patterns in linear time.
LOCAL, HOST = "A-Za-z0-9._%+-", "A-Za-z0-9-"
BASE = {
    "email": rf"(?:\G|(?<![{LOCAL}]))[{LOCAL}]++@[{HOST}]++(?:\.[{HOST}]++)++",
    "ip": r"(?:\G|(?<![0-9]))[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++",
    "card": r"[0-9](?:[\x20-]?+[0-9])++",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}
MORE = {
    "secret": r"(?<![A-Za-z0-9])(?=[A-Za-z]*+[0-9])(?=[0-9]*+[A-Za-z])[A-Za-z0-9]{16,}+",
    "local_phone": r"(?<![0-9+])\(?[0-9]{3}\)?[\x20.-][0-9]{3}[\x20.-][0-9]{4}(?![0-9])",
    "id_number": r"(?<![0-9-])[0-9]{3}-[0-9]{2}-[0-9]{4}(?![0-9-])",
    "veiled_email": rf"(?<![{LOCAL}])[{LOCAL}]{{1,64}}+\x20?[\[(]at[\])]\x20?[{HOST}]++(?:(?:\.|\x20?[\[(]dot[\])]\x20?)[{HOST}]++)++",
}
OCTETS = "^0*(?:[0-9]{1,2}|1[0-9]{2}|2[0-4][0-9]|25[0-5])$"
#: Words right before a span that speak for personal data. They label candidates; no feature holds them.
CUES = r"(?i)(?:mail|contact|phone|tel|call|fax|mobile|card|visa|account|host|server|address|ssn|password|passwd|token|key|secret|api)[\"'\x20:=#-]*$"

TREES, DEPTH, STEP = 12, 3, 0.3
#: Share of right spans among the selected ones that a threshold has to reach.
PRECISION = 0.9
#: No threshold goes below this score.
LEAST_SCORE = 0.5
#: Characters before a span that its context takes in.
CONTEXT = 24

SPAN = "struct<s:int,rank:int,e:int,kind:string,m:string,before:string,after:string,ok:boolean>"
PICK = "struct<s:int,rank:int,e:int,kind:string,score:double>"
FOUND = "struct<s:int,rank:int,e:int,kind:string>"
FORMAT = ("length", "digits", "letters", "marks", "digit_share", "upper_share", "dots", "distinct_share", "runs", "luhn", "octets")
AROUND = ("quoted", "before_word", "after_word", "line_start", "digits_before")
FEATURES = FORMAT + AROUND
#: Spans whose pieces of text are cut out of one stretch of it.
STRETCH = 64


def _none(kind: str) -> Column:
    return F.array().cast(f"array<{kind}>")


def _proven(kind: str, m: Column) -> Column:
    digits = F.regexp_replace(m, "[^0-9]", "")
    if kind == "email":
        return F.lit(True)
    if kind == "ip":
        return F.forall(F.split(m, r"\."), lambda p: p.rlike(OCTETS))
    if kind == "card":
        return F.length(digits).between(12, 19) & F.call_function("luhn_check", digits)
    if kind == "phone":
        return F.length(digits).between(9, 15)
    return F.lit(False)


def candidates(text: Column) -> Column:
    """All proposed spans of a text that is not null, in code points, with some text around each."""
    return F.concat(*[_proposed(text, rank, kind, pattern) for rank, (kind, pattern) in enumerate({**BASE, **MORE}.items())])


def _proposed(text: Column, rank: int, kind: str, pattern: str) -> Column:
    """The spans of one pattern. What it leaves between them gives their places."""

    def spans(hits: Column, gaps: Column, ends: Column) -> Column:
        def span(m: Column, i: Column) -> Column:
            before, after = F.right(F.get(gaps, i), F.lit(CONTEXT)), F.left(F.get(gaps, i + 1), F.lit(1))
            return F.struct((F.get(ends, i) - F.length(m)).alias("s"), F.lit(rank).alias("rank"), F.get(ends, i).alias("e"), F.lit(kind).alias("kind"), m.alias("m"), before.alias("before"), after.alias("after"), _proven(kind, m).alias("ok"))

        return F.transform(hits, span)

    def placed(hits: Column) -> Column:
        steps = lambda gaps: F.transform(hits, lambda m, i: F.length(F.get(gaps, i)) + F.length(m))
        some = let(F.split(text, pattern, -1), lambda gaps: let(totals(steps(gaps)), lambda ends: spans(hits, gaps, ends)))
        return F.when(F.size(hits) > 0, some).otherwise(_none(SPAN))

    return let(F.regexp_extract_all(text, F.lit(pattern), F.lit(0)), placed)


def features(c: Column) -> dict[str, Column]:
    def count(drop):
        return F.length(F.regexp_replace(c.m, drop, "")).cast("double")

    length, digits, letters = F.length(c.m).cast("double"), count("[^0-9]"), count("[^A-Za-z]")
    flag = lambda x: F.when(x, 1.0).otherwise(0.0)
    return {
        "length": length,
        "digits": digits,
        "letters": letters,
        "marks": length - digits - letters,
        "digit_share": digits / length,
        "upper_share": count("[^A-Z]") / length,
        "dots": count(r"[^.]"),
        "distinct_share": F.size(F.array_distinct(F.split(c.m, ""))).cast("double") / length,
        "runs": F.size(F.regexp_extract_all(c.m, F.lit("[0-9]+|[A-Za-z]+"), F.lit(0))).cast("double"),
        "luhn": flag(F.call_function("luhn_check", F.regexp_replace(c.m, "[^0-9]", ""))),
        "octets": flag(F.forall(F.split(c.m, r"\."), lambda p: p.rlike(OCTETS))),
        "quoted": flag(c.before.rlike("[\"'`]$")),
        "before_word": flag(c.before.rlike("[A-Za-z0-9]$")),
        "after_word": flag(c.after.rlike("^[A-Za-z0-9]")),
        "line_start": flag(c.before.rlike(r"(?:^|\n)$")),
        "digits_before": F.length(F.regexp_replace(c.before, "[^0-9]", "")).cast("double"),
    }


@dataclass
class Model:
    """Boosted trees as nested (feature, bound, left, right) or a number, with weights.

    ``report`` has, by kind, what the held-out labels say of the selected spans:
    precision, recall, and the number of candidates.
    """

    trees: list = field(default_factory=list)
    thresholds: dict[str, float] = field(default_factory=dict)
    constant: float = 0.0
    report: dict[str, tuple[float, float, int]] = field(default_factory=dict)

    def score(self, of) -> Column:
        """of(name) is the column of a feature."""

        def walk(node) -> Column:
            if isinstance(node, float):
                return F.lit(node)
            name, bound, left, right = node
            return F.when(of(name) <= bound, walk(left)).otherwise(walk(right))

        if not self.trees:
            return F.lit(self.constant)
        margin = F.lit(0.0)
        for weight, tree in self.trees:
            margin = margin + F.lit(weight) * walk(tree)
        return 1.0 / (1.0 + F.exp(-2.0 * margin))

    def selects(self, kind: Column, score: Column) -> Column:
        chosen = F.lit(False)
        for name, bound in self.thresholds.items():
            chosen = chosen | ((kind == name) & (score >= bound))
        return chosen


def _parse(text: str) -> list:
    """Spark's description of a tree ensemble as (weight, tree) pairs."""
    lines = [x.strip() for x in text.splitlines()]

    def tree(k: int):
        if m := re.match(r"Predict: (\S+)", lines[k]):
            return float(m[1]), k + 1
        m = re.match(r"If \(feature (\d+) <= (\S+)\)", lines[k])
        left, k = tree(k + 1)
        right, k = tree(k + 1)
        return (FEATURES[int(m[1])], float(m[2]), left, right), k

    return [(float(m[1]), tree(k + 1)[0]) for k, x in enumerate(lines) if (m := re.match(r"Tree \d+ \(weight (\S+)\)", x))]


def _short(c: Column) -> Column:
    return F.struct(c.s.alias("s"), c["rank"].alias("rank"), c.e.alias("e"), c.kind.alias("kind"))


def _base(spans: Column) -> Column:
    return F.array_sort(F.transform(F.filter(spans, lambda c: c.ok), _short))


def _free(base: Column, spans: Column, kind: str) -> Column:
    """The spans, in order of their starts, that no base span overlaps: one pass from either end over both together."""
    none = _none("int")

    def passes(marks: Column) -> Column:
        own = lambda x, good: F.when((x.i >= 0) & good, F.array(x.i)).otherwise(none)
        behind = fold(marks, F.lit(0), lambda end, x: (F.when(x.i < 0, F.greatest(end, x.e)).otherwise(end), own(x, end <= x.s)), "int")
        ahead = fold(F.reverse(marks), F.lit(2**31 - 1), lambda start, x: (F.when(x.i < 0, F.least(start, x.s)).otherwise(start), own(x, start >= x.e)), "int")
        return F.array_sort(F.array_intersect(behind, ahead))

    bases = F.transform(base, lambda b: F.struct(b.s.alias("s"), b.e.alias("e"), F.lit(-1).alias("i")))
    others = F.transform(spans, lambda c, i: F.struct(c.s.alias("s"), c.e.alias("e"), i.alias("i")))
    found = let(F.array_sort(F.concat(bases, others)), lambda marks: F.transform(passes(marks), lambda i: F.get(spans, i)))
    return F.when((F.size(base) == 0) | (F.size(spans) == 0), spans).otherwise(found)


def _best(picks: Column) -> Column:
    """Of picks that overlap, read from left to right, the one with the higher score; the earlier of equals."""
    none, start = _none(PICK), F.lit(None).cast(PICK)

    def step(held: Column, x: Column):
        past = held.isNull() | (x.s >= held.e)
        made = F.when(held.isNotNull() & past, F.array(held)).otherwise(none)
        return F.when(past | (x.score > held.score), x).otherwise(held), made

    return fold(picks, start, step, PICK, lambda held: F.when(held.isNotNull(), F.array(held)).otherwise(none))


def _undecided(spans: Column) -> Column:
    """Candidates that are not proven and that no proven one overlaps."""
    loose = F.array_sort(F.filter(spans, lambda c: ~c.ok))
    return let(_base(spans), lambda base: let(loose, lambda rest: _free(base, rest, SPAN)))


def fit(df: DataFrame, text: str = "text", precision: float = PRECISION) -> Model:
    """Fit the trees on the undecided candidates of all documents.

    Candidates of equal kind, label and features are one row with their number as its
    weight, so that copies cost nothing. Every candidate counts in the trees' gains, in the thresholds and in the
    report; only where a feature may be cut is drawn from some of them by MLlib, for tables of over 10,000 rows.

    Labels are weak, and come from what no feature holds: a candidate right behind a word
    of CUES is right, any other one wrong, and so is a base candidate that its own proof
    refuses, as digits at the head of a key: no threshold selects these. So the trees learn which formats and
    surroundings go with such words, and find them where the word is missing. Texts with
    an even hash are fitted on; the others calibrate each kind's threshold, the smallest
    score above which the precision holds, and give the model's report. Candidates
    without a cue count as wrong there, so true precision is higher than reported. A kind
    without such a score adds nothing, candidates of one class only get a constant score.
    """
    from pyspark.ml.classification import GBTClassifier
    from pyspark.ml.feature import VectorAssembler
    from pyspark.ml.functions import vector_to_array

    keep = df.select(body(text).alias("t"))
    # A plain explode lets the optimizer infer a filter on the array's size, push it below
    # the candidates and write them all out in it; an outer one is left alone.
    loose = let(F.col("t"), lambda t: let(candidates(t), _undecided))
    rows = keep.select(F.xxhash64("t").alias("half"), F.explode_outer(loose).alias("c")).where("c is not null")
    known = rows.select("half", F.col("c.s").alias("s"), F.col("c.kind").alias("kind"), F.when(F.col("c.before").rlike(CUES) & F.col("c.kind").isin(list(MORE)), 1.0).otherwise(0.0).alias("label"), *[x.alias(n) for n, x in features(F.col("c")).items()])
    known = known.withColumn("half", F.pmod("half", F.lit(2)))
    known = materialize(known.groupBy("half", "kind", "label", *FEATURES).agg(F.count("*").cast("double").alias("weight")), "pii-candidates")
    known = VectorAssembler(inputCols=list(FEATURES), outputCol="x").transform(known)
    fitted_on = known.where("half = 0")
    mean, n = fitted_on.agg(F.sum(F.col("label") * F.col("weight")) / F.sum("weight"), F.count("*")).first()
    if not n or mean in (0.0, 1.0):
        return Model(constant=float(mean or 0.0), thresholds=dict.fromkeys(MORE, LEAST_SCORE) if mean else {})
    trees = GBTClassifier(featuresCol="x", labelCol="label", weightCol="weight", maxIter=TREES, maxDepth=DEPTH, stepSize=STEP, seed=7, cacheNodeIds=False).fit(fitted_on)
    model = Model(trees=_parse(trees.toDebugString))
    held = trees.transform(known.where("half = 1")).select("kind", "label", "weight", F.round(vector_to_array("probability")[1], 3).alias("score"))
    counted = held.groupBy("kind", "score").agg(F.sum(F.col("label") * F.col("weight")).cast("long").alias("right"), F.sum("weight").cast("long").alias("n")).collect()
    for kind in sorted({r.kind for r in counted} & MORE.keys()):
        own = sorted((r for r in counted if r.kind == kind), key=lambda r: -r.score)
        right = total = 0
        for r in own:
            right, total = right + r.right, total + r.n
            if right and right >= precision * total and r.score >= LEAST_SCORE:
                model.thresholds[kind] = r.score - 0.0005
                model.report[kind] = (right / total, right / sum(x.right for x in own), sum(x.n for x in own))
    return model


def find(df: DataFrame, model: Model, text: str = "text") -> DataFrame:
    """Add ``base`` and ``added``, arrays of (s, rank, e, kind) in order.

    Base spans are those of proven format. Added ones are other candidates that
    the model selects and that no base span overlaps; of two that overlap each other,
    the one with the higher score. A null or empty text has none. Repeated rows,
    extra columns of any name and empty tables pass through; only columns named base
    or added are replaced. The work of one text grows with its length and its spans.
    """

    def picked(c: Column) -> Column:
        scored = let(F.struct(*[x.alias(n) for n, x in features(c).items()]), lambda f: model.score(lambda n: f[n]))
        return F.struct(c.s.alias("s"), c["rank"].alias("rank"), c.e.alias("e"), c.kind.alias("kind"), scored.alias("score"))

    def added(spans: Column) -> Column:
        chosen = let(_undecided(spans), lambda rest: F.filter(F.transform(rest, picked), lambda x: model.selects(x.kind, x.score)))
        some = let(chosen, lambda picks: F.transform(_best(picks), _short))
        return F.when(F.exists(spans, lambda c: ~c.ok), some).otherwise(_none(FOUND)) if model.thresholds else _none(FOUND)

    name = f"spans-{uuid.uuid4().hex}"
    both = lambda spans: F.struct(_base(spans).alias("base"), added(spans).alias("added"))
    out = df.withColumn(name, let(body(text), lambda t: let(candidates(t), both)))
    return out.withColumns({c: F.col(f"`{name}`")[c] for c in ("base", "added")}).drop(name)


def redact(df: DataFrame, model: Model, text: str = "text") -> DataFrame:
    """Replace every found span in the text by its kind in angle brackets; what an earlier span covers is not replaced twice.

    Other columns pass through, also ones named base or added.
    """
    mark = "struct<from:int,s:int,e:int,kind:string>"

    def step(end: Column, x: Column):
        made = F.array(F.struct(end.alias("from"), F.greatest(x.s, end).alias("s"), x.e.alias("e"), x.kind.alias("kind")))
        return F.greatest(end, x.e), F.when(x.e > end, made).otherwise(_none(mark))

    def stretch(marks: Column, k: Column) -> Column:
        def cut(part: Column) -> Column:
            first, last = F.get(part, F.lit(0)), F.element_at(part, -1)
            piece = lambda seg, m: F.concat(F.substring(seg, m["from"] - first["from"] + 1, m.s - m["from"]), F.lit("<"), F.upper(m.kind), F.lit(">"))
            return let(F.substring(F.col(text), first["from"] + 1, last.e - first["from"]), lambda seg: F.array_join(F.transform(part, lambda m: piece(seg, m)), ""))

        return let(F.slice(marks, k * STRETCH + 1, F.lit(STRETCH)), cut)

    def rewritten(marks: Column) -> Column:
        last = F.floor((F.size(marks) - 1) / STRETCH).cast("int")
        rest = F.substring(F.col(text), F.element_at(marks, -1).e + 1, F.length(text))
        return F.concat(F.array_join(F.transform(F.sequence(F.lit(0), last), lambda k: stretch(marks, k)), ""), rest)

    name = f"spans-{uuid.uuid4().hex}"
    found = find(df.select(F.struct("*").alias("row"), F.col(text).alias("text")), model)
    out = found.select("row.*", F.array_sort(F.concat("base", "added")).alias(name))
    new = let(fold(F.col(f"`{name}`"), F.lit(0), step, mark), rewritten)
    return out.withColumn(text, F.when(F.size(f"`{name}`") > 0, new).otherwise(F.col(text))).drop(name)


def spans_text(spans: Column) -> Column:
    return F.array_join(F.transform(spans, lambda x: F.concat_ws(":", x.kind, x.s, x.e)), ",")
