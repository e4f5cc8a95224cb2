"""Personal data by candidate boosting, with DataFrame and SQL functions only.

Base spans of four kinds come from fixed patterns and checks and are always kept.  High-recall generators
propose further spans, which may overlap: number shapes, grouped numbers, and addresses whose ``@`` or
dot is spelled out.  Gradient-boosted trees (Spark ML) score a proposal from its format and context; they learn
on all proposals, from those that touch base spans against those that are surely no personal data
(glued to letters or digits, assigned without a hint, failing their kind's check).  The others, which may be what is to be
added, count against with the weight ``UNSURE`` only: enough to refuse shapes that base spans never have.  What base
patterns demand (a leading plus, a written ``@`` and dot) is no feature, so that spans without it can be told.
The trees become a column expression, so whole texts are scored where they are.  All proposals calibrate each
kind's threshold, each half of them scored by trees fitted on the other half: the least score, but no less than a half, whose sure
proposals at or above it are right in ``PRECISION`` of all cases.  Proposals at or above it that touch no base span are added.

A proposal counts by its shape (features, kind, half and what is known of it): one aggregate of all proposals gives the
shapes with their numbers, which are the weights of the fits and of the calibration.

Positions are code points, end exclusive.  Patterns start only where a run of their first
class starts (or where the last match ended) and repeat possessively, so long runs cost linear time.  Positions, and what a
proposal touches, come from running sums and maxima over a text's matches, which cost about linear time too.

Generators propose what can be valid: local parts of at most 64 and labels of at most 63 characters (the limits of
mail and host names), numbers of 7 to 30 characters (19 digits with separators).

Defined cases: a null or empty text has no spans; repeated rows are judged each; an empty table, or one
without both kinds of proposal, adds no spans; other columns stay, those named like results are replaced.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.ml.classification import GBTClassifier
from pyspark.ml.functions import array_to_vector
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from starloom.llm.arrays import let, running, slices
from starloom.llm.common import stored, table

KINDS = ("email", "ip", "card", "phone")
SHAPES_A_TASK = 100_000  # different shapes that a task of a fit holds
TREES, DEPTH = 12, 3
PRECISION = 0.98
UNSURE = 1 - PRECISION  # weight, against being personal data, of a proposal of which that is not known
NOWHERE = (1 << 31) - 1  # behind all positions
SPAN = "array<struct<kind:string,start:int,end:int>>"

# The base patterns, written so that no start or repeat is tried twice.
_LOCAL = "[A-Za-z0-9._%+-]"
PATTERNS = {
    "email": rf"(?:\G|(?<!{_LOCAL})){_LOCAL}++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "ip": r"(?:\G|(?<![0-9]))[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++",
    "card": r"[0-9](?:[\x20-]?[0-9])++",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}
# A text that lacks these has no base span of the kind.
GATES = {"email": "@", "ip": r"[0-9]\.[0-9]++\.[0-9]", "card": r"[0-9](?:[\x20-]?[0-9]){15}", "phone": r"\+[0-9]"}
GENERATORS = {
    "number": r"(?<![0-9(])[0-9(][0-9().\x20-]{5,28}[0-9](?![0-9])",
    "grouped": r"(?<![0-9])\(?[0-9]{2,4}\)?[\x20.-][0-9]{3,4}[\x20.-][0-9]{3,4}(?![0-9])",
    "address": (rf"(?<!{_LOCAL}){_LOCAL}{{1,64}}\x20?(?:@|\(at\)|\[at\])\x20?[A-Za-z0-9-]{{1,63}}"
                r"(?:\x20?(?:\.|\(dot\)|\[dot\])\x20?[A-Za-z0-9-]{1,63})++"),
}
GENERATOR_GATES = {"number": "[0-9][0-9().\\x20-]{5}", "grouped": r"[0-9]\)?[\x20.-][0-9]{3}", "address": r"@|\(at\)|\[at\]"}
HINTS = "tel|phone|call|fax|mail|card|visa|contact|addr"
FEATURES = ["digits", "length", "groups", "longest", "dots", "dashes", "spaces", "brackets", "address", "glued_before",
            "glued_after", "quoted", "assigned", "hint", "luhn"]


def _digits(text: Column) -> Column:
    return F.regexp_replace(text, "[^0-9]", "")


def luhn_valid(digits: Column) -> Column:
    """Whether a string of digits passes Luhn's check."""
    def value(i):
        d = F.substring(digits, F.length(digits) - i + 1, F.lit(1)).cast("int")
        doubled = F.when(i % 2 == 0, d * 2).otherwise(d)
        return F.when(doubled > 9, doubled - 9).otherwise(doubled)

    total = F.aggregate(F.sequence(F.lit(1), F.greatest(F.length(digits), F.lit(1))), F.lit(0),
                        lambda s, i: s + F.coalesce(value(i), F.lit(0)))
    return (F.length(digits) > 0) & (total % 10 == 0)


def _valid(kind: str, found: Column) -> Column:
    if kind == "email":
        return F.lit(True)
    if kind == "ip":
        return F.forall(F.split(found, r"\."), lambda p: F.regexp_replace(p, "^0+", "").rlike(r"^(?:[0-9]{0,2}|1[0-9]{2}|2[0-4][0-9]|25[0-5])$"))
    n = F.length(_digits(found))
    if kind == "card":
        return F.when(n.between(16, 19), luhn_valid(_digits(found))).otherwise(F.lit(False))
    return n.between(8, 15)


def matches(text: Column, pattern: str, keep, make, kind: str) -> Column:
    """Array of ``make(start, end, found, before, after)`` for the leftmost non-overlapping matches that ``keep``.

    The gaps between matches give the positions: one running sum over gaps and matches.
    """
    def placed(x):
        lengths = F.zip_with(x["gaps"], x["found"], lambda g, m: F.length(g) + F.coalesce(F.length(m), F.lit(0)))
        return let(running(lengths, F.lit(0), lambda p, q: p + q), lambda at: F.transform(x["found"], lambda m, i: one(x["gaps"], at, m, i)))

    def one(gaps, at, m, i):
        gap = F.get(gaps, i)
        here = F.get(at, i) + F.length(gap)
        return F.when(keep(m), make(here, here + F.length(m), m, gap, F.substring(F.get(gaps, i + 1), 1, 12)))

    # one gap more than matches
    pieces = F.struct(F.split(text, pattern, -1).alias("gaps"), F.regexp_extract_all(text, F.lit(pattern), F.lit(0)).alias("found"))
    return F.filter(let(pieces, placed), lambda x: x.isNotNull()).cast(kind)


def base_spans(text: Column) -> Column:
    """The fixed kinds' spans, by kind and start."""
    parts = []
    for kind in KINDS:
        made = matches(text, PATTERNS[kind], lambda m, k=kind: _valid(k, m),
                       lambda a, b, m, before, after, k=kind: F.struct(F.lit(k).alias("kind"), a.alias("start"), b.alias("end")), SPAN)
        parts.append(F.when(text.rlike(GATES[kind]), made).otherwise(F.expr(f"cast(array() as {SPAN})")))
    return F.concat(*parts)


CANDIDATE = "array<struct<kind:string,start:int,end:int,features:array<double>,denied:boolean>>"


def _written(found: Column) -> Column:
    """An address with its spelled-out marks, and spaces beside them, as ``@`` and dot."""
    return F.regexp_replace(F.regexp_replace(found, r"\x20?(?:\(at\)|\[at\])\x20?", "@"), r"\x20?(?:\(dot\)|\[dot\])\x20?", ".")


def _features(found: Column, before: Column, after: Column) -> list[Column]:
    digits = _digits(found)
    groups = F.filter(F.split(found, "[^0-9]+"), lambda g: g != "")
    tail = F.right(before, F.lit(24))
    count = lambda c: F.length(found) - F.length(F.replace(found, F.lit(c), F.lit("")))
    return [F.length(digits), F.length(found), F.size(groups), F.coalesce(F.array_max(F.transform(groups, F.length)), F.lit(0)),
            count("."), count("-"), count(" "), count("("), found.rlike("@|at[)\\]]"), tail.rlike(r"[\p{L}0-9.]$"),
            after.rlike(r"^[\p{L}0-9]|^\.[0-9]"), tail.rlike("[\"']$"), tail.rlike("[=:][\\s\"']*$"),
            F.lower(tail).rlike(HINTS), F.when(F.length(digits).between(13, 19), luhn_valid(digits)).otherwise(F.lit(False))]


def _denied(kind: Column, found: Column, before: Column, after: Column) -> Column:
    """Whether a proposal is surely no personal data: part of something longer, an assigned token, or of no valid form."""
    tail, n = F.right(before, F.lit(24)), F.length(_digits(found))
    glued = tail.rlike(r"[\p{L}0-9_]$") | after.rlike(r"^[\p{L}0-9_]")
    assigned = tail.rlike("=[\\s\"']*$") & ~F.lower(tail).rlike(HINTS)
    formless = (F.when(kind == "card", ~n.between(16, 19) | ~luhn_valid(_digits(found)))
                .when(kind == "ip", ~_valid("ip", found))
                .when(kind == "email", ~found.rlike(r"\.[A-Za-z]{2,}$"))
                .otherwise(~n.between(7, 15) | found.rlike(r"^[0-9]+\.[0-9]+$")))
    return glued | assigned | formless


def _kind(name: str, found: Column) -> Column:
    if name == "address":
        return F.lit("email")
    return (F.when(found.rlike(r"^[0-9]{1,3}(?:\.[0-9]{1,3}){3}$"), F.lit("ip"))
            .when(F.length(_digits(found)) >= 13, F.lit("card")).otherwise(F.lit("phone")))


def candidates(text: Column) -> Column:
    """Proposals of all generators with their features."""
    parts = []
    for name, pattern in GENERATORS.items():
        def make(a, b, m, before, after, name=name):
            kind, written = _kind(name, m), _written(m) if name == "address" else m
            return F.struct(kind.alias("kind"), a.alias("start"), b.alias("end"),
                            F.array(*[f.cast("double") for f in _features(written, before, after)]).alias("features"),
                            _denied(kind, written, before, after).alias("denied"))

        made = matches(text, pattern, lambda m, n=name: F.lit(True) if n == "address" else F.length(_digits(m)) >= 7, make, CANDIDATE)
        parts.append(F.when(text.rlike(GENERATOR_GATES[name]), made).otherwise(F.expr(f"cast(array() as {CANDIDATE})")))
    return F.concat(*parts)


def touching(base: Column, proposed: Column) -> Column:
    """For each of ``proposed``, whether it shares a position with one of ``base``.

    Both are laid out by start.  A proposal touches if a base span before it ends behind its start, or the next
    base span starts before its end.
    """
    events = F.array_sort(F.concat(
        F.transform(base, lambda b: F.struct(b["start"].alias("start"), F.lit(-1).alias("of"), b["end"].alias("end"))),
        F.transform(proposed, lambda c, i: F.struct(c["start"].alias("start"), i.alias("of"), c["end"].alias("end")))))

    def judged(e):
        ends = F.transform(e, lambda x: F.when(x["of"] < 0, x["end"]).otherwise(0))
        starts = F.reverse(F.transform(e, lambda x: F.when(x["of"] < 0, x["start"]).otherwise(NOWHERE)))
        last, following = running(ends, F.lit(0), lambda p, q: F.greatest(p, q)), running(starts, F.lit(NOWHERE), lambda p, q: F.least(p, q))
        return let(F.struct(last.alias("last"), following.alias("next")), lambda r: F.transform(e, lambda x, i: F.struct(
            x["of"].alias("of"), ((F.get(r["last"], i) > x["start"]) | (F.get(r["next"], F.size(e) - 1 - i) < x["end"])).alias("touches"))))

    return F.transform(F.array_sort(F.filter(let(events, judged), lambda x: x["of"] >= 0)), lambda x: x["touches"])


def scan(docs: DataFrame, text: str = "text") -> DataFrame:
    """``docs`` with ``base`` spans and ``candidates``, each marked ``touches`` (a base span) or not.

    Both come from one value, so that no projection of the result can have the patterns run again for each proposal.
    """
    whole = F.coalesce(F.col(text), F.lit(""))
    kept = [c for c in docs.columns if c not in ("base", "candidates")]

    def marked(x):
        touches = let(touching(x["base"], x["candidates"]), lambda t: F.transform(x["candidates"], lambda c, i: c.withField("touches", F.get(t, i))))
        return F.struct(x["base"].alias("base"), touches.alias("candidates"))

    found = let(F.struct(base_spans(whole).alias("base"), candidates(whole).alias("candidates")), marked)
    return docs.select(*kept, found.alias("_pii")).select(*kept, "_pii.base", "_pii.candidates")


@dataclass(frozen=True)
class Proposer:
    """Trees as (weight, root) with nodes (feature, threshold, left, right) or leaves; the threshold, and those of single kinds."""

    trees: tuple
    threshold: float
    by_kind: tuple = ()

    def score(self, features: Column) -> Column:
        def walk(node):
            if isinstance(node, float):
                return F.lit(node)
            feature, cut, left, right = node
            return F.when(F.get(features, feature) <= cut, walk(left)).otherwise(walk(right))

        margin = F.lit(0.0)
        for weight, root in self.trees:
            margin = margin + F.lit(weight) * walk(root)
        return 1 / (1 + F.exp(-2 * margin))

    def takes(self, kind: Column, features: Column) -> Column:
        least = F.lit(self.threshold)
        for name, threshold in self.by_kind:
            least = F.when(kind == name, F.lit(threshold)).otherwise(least)
        return self.score(features) >= least


def least_threshold(steps: list[tuple[int, int, float]]) -> float:
    """The least score of at least 0.5 with ``PRECISION`` at or above it, from (score in hundredths, rows, right ones); 2.0 for none."""
    for least in range(50, 101):
        n = sum(count for step, count, _ in steps if step >= least)
        if n and sum(right for step, _, right in steps if step >= least) >= PRECISION * n:
            return least / 100
    return 2.0


def _tree(node) -> tuple | float:
    """A JVM tree node as nested tuples."""
    if not node.getClass().getSimpleName().startswith("Internal"):
        return float(node.prediction())
    split = node.split()
    return int(split.featureIndex()), float(split.threshold()), _tree(node.leftChild()), _tree(node.rightChild())


def shapes(scanned: DataFrame, key: str = "doc_id") -> DataFrame:
    """All proposals as (features, label, kind, sure, half) with their number ``n``; ``half`` is of a hash of ``key``, place and features."""
    rows = (scanned.select(F.col(key).alias("of"), F.explode("candidates").alias("c"))
            .select("c.features", F.col("c.touches").cast("double").alias("label"), "c.kind", (F.col("c.touches") | F.col("c.denied")).alias("sure"),
                    F.pmod(F.xxhash64("of", "c.start", "c.features"), F.lit(2)).alias("half")))
    return rows.groupBy("features", "label", "kind", "sure", "half").agg(F.count(F.lit(1)).alias("n"))


def _fit(known: DataFrame) -> tuple:
    """Trees over all of ``known`` (:func:`shapes`); none where it holds but one label."""
    weight = F.sum(F.col("n") * F.when(F.col("sure"), 1.0).otherwise(UNSURE)).alias("weight")
    rows = known.groupBy("features", "label").agg(weight)
    seen = rows.agg(F.min("label").alias("low"), F.max("label").alias("high"), F.count(F.lit(1)).alias("n")).first()
    if seen.low is None or seen.low == seen.high:
        return ()
    # in a fixed order, so that sums of few shapes do not depend on the run
    dealt = rows.repartition(1 + seen.n // SHAPES_A_TASK, "features").sortWithinPartitions("features", "label")
    model = GBTClassifier(labelCol="label", featuresCol="v", weightCol="weight", maxIter=TREES, maxDepth=DEPTH, stepSize=0.3, seed=11).fit(
        dealt.select(array_to_vector("features").alias("v"), "label", "weight"))
    return tuple((float(w), _tree(t._call_java("rootNode"))) for w, t in zip(model.treeWeights, model.trees))


def train(scanned: DataFrame, key: str = "doc_id") -> Proposer:
    """Fit on all proposals; calibrate on all, each half by trees of the other half."""
    known = stored(shapes(scanned, key))
    trees = _fit(known)
    if not trees:
        return Proposer((), 2.0)
    steps = []
    for half in (0, 1):
        others = _fit(known.filter(F.col("half") != half))
        if others:
            scored = known.filter((F.col("half") == half) & F.col("sure")).withColumn("step", F.floor(Proposer(others, 2.0).score(F.col("features")) * 100))
            steps += scored.groupBy("kind", "step").agg(F.sum("n").alias("n"), F.sum(F.col("n") * F.col("label")).alias("right")).collect()
    by_kind = tuple((k, least_threshold([(s["step"], s["n"], s["right"]) for s in steps if s["kind"] == k]))
                    for k in KINDS if any(s["kind"] == k for s in steps))
    return Proposer(trees, least_threshold([(s["step"], s["n"], s["right"]) for s in steps]), by_kind)


def with_spans(scanned: DataFrame, proposer: Proposer) -> DataFrame:
    """``scanned`` with ``spans``: base ones and accepted proposals that touch none, by kind and start."""
    taken = F.filter("candidates", lambda c: ~c["touches"] & proposer.takes(c["kind"], c["features"]))
    added = F.array_distinct(F.transform(taken, lambda c: F.struct(c["kind"].alias("kind"), c["start"].alias("start"), c["end"].alias("end"))))
    order = F.array(*[F.lit(k) for k in KINDS])
    rank = lambda s: F.struct(F.array_position(order, s["kind"]), s["start"], s["end"])
    by_kind = F.array_sort(F.concat("base", added.cast(SPAN)), lambda a, b: F.when(rank(a) < rank(b), -1).when(rank(a) > rank(b), 1).otherwise(0))
    return scanned.select(*[c for c in scanned.columns if c not in ("candidates", "spans")], by_kind.alias("spans"))


def redacted(text: Column, spans: Column) -> Column:
    """``text`` with every span replaced by ``[KIND]``; of overlapping spans the union goes, under the first's kind."""
    by_start = F.array_sort(F.transform(spans, lambda x: F.struct(x["start"].alias("start"), (-x["end"]).alias("back"), x["kind"].alias("kind"))))

    def replaced(x):
        # what is shown before a span that starts a union: from the end of all before it
        ends = running(F.transform(x, lambda s: -s["back"]), F.lit(0), lambda p, q: F.greatest(p, q))
        fresh = lambda e: F.filter(F.transform(x, lambda s, i: F.struct(F.get(e, i).alias("start"), s["start"].alias("end"), s["kind"].alias("kind"))),
                                   lambda s: s["end"] >= s["start"])
        return let(ends, lambda e: let(fresh(e), lambda u: F.concat(
            F.array_join(F.zip_with(slices(text, u), u, lambda t, s: F.concat(t, F.lit("["), F.upper(s["kind"]), F.lit("]"))), ""),
            F.substring(text, F.get(e, F.size(x)) + 1, F.length(text)))))

    return F.when(F.size(spans) > 0, let(by_start, replaced)).otherwise(text)


def spans_text(spans: Column) -> Column:
    return F.concat_ws(",", F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))))


def op4_pii(spark, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    scanned = stored(scan(docs).drop("text"))
    found = with_spans(scanned, train(scanned))
    kinds = F.transform("base", lambda s: s["kind"])
    counts = [(F.size(kinds) - F.size(F.array_remove(kinds, k))).cast("long").alias(f"n_{k}") for k in KINDS]
    return found.select("doc_id", *counts, F.sha2(spans_text(F.col("base")), 256).alias("base_sha256"),
                        spans_text(F.col("spans")).alias("spans"))
