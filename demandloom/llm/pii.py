"""Personal data by candidate gradient boosting, in DataFrame functions only.

Strict patterns give the base spans.  Loose generators propose further,
overlapping spans; boosted trees judge them by format and context, and those
above their kind's calibrated threshold that touch no base span are added.
The trees are fitted on all distinct candidates and then applied as one
expression, so finding spans moves no rows.
"""

from __future__ import annotations

import re
from collections.abc import Callable
from functools import reduce

from pyspark.ml.classification import GBTClassifier
from pyspark.ml.functions import array_to_vector
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from demandloom.llm.common import only
from demandloom.sources.io import settle

KINDS = ("email", "ip", "card", "phone")

#: With fewer rows of either label than LEAST to fit on nothing is added; rows of a partition of the fit.
LEAST, PART = 30, 100_000
TREES, DEPTH, PRECISION, FLOOR = 10, 3, 0.995, 0.9
CONTEXT = 24

SPAN = "array<struct<kind:string,start:long,end:long,m:string>>"
FOUND = "array<struct<kind:string,start:long,end:long,m:string,left:string,right:string>>"

# Each pattern is written so that Java matches it without recursion or repeated scans of a run:
# possessive repeats, and starts only where a run begins or the last match ended.
_LOCAL, _LABEL = "[A-Za-z0-9._%+-]", "[A-Za-z0-9-]"
STRICT = {
    "email": rf"(?:(?<!{_LOCAL})|\G){_LOCAL}++@{_LABEL}++(?:\.{_LABEL}++)++",
    "ip": r"(?:(?<![0-9])|\G)[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++",
    "card": r"[0-9](?:[\x20-]?[0-9])++",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}
_AT, _DOT = r"[\x20]?(?:@|[(\[]at[)\]])[\x20]?", r"(?:\.|[\x20]?[(\[]dot[)\]][\x20]?)"
LOOSE = {
    "email": rf"(?:(?<!{_LOCAL})|\G){_LOCAL}++{_AT}{_LABEL}++(?:{_DOT}{_LABEL}++)++",
    "ip": r"(?:(?<![0-9])|\G)[0-9]++(?:(?:[.,:_-]|\[\.\])[0-9]++){3}",
    "card": r"(?:(?<![0-9])|\G)[0-9](?:[\x20./_-]?[0-9]){11,}+",
    "phone": r"(?:(?<![0-9A-Za-z+(])|\G)[+(]?[0-9][\x20()./0-9-]{5,}[0-9]",
}
HINT = {"email": r"@|[(\[]at[)\]]", "ip": "[0-9]", "card": "[0-9]", "phone": "[0-9]"}


def digits(m: Column) -> Column:
    return F.regexp_replace(m, "[^0-9]", "")


def luhn(m: Column) -> Column:
    """Whether the digits of m, at most 40, pass the check-digit rule."""

    def value(x: Column, i: Column) -> Column:
        v = x.cast("int")
        return F.when(i % 2 == 0, v).otherwise(v * 2 - F.when(v > 4, 9).otherwise(0))

    values = F.transform(F.array_remove(F.split(F.reverse(digits(m)), ""), ""), value)
    total = F.aggregate(values, F.lit(0), lambda s, x: s + x)
    return F.when(F.length(m).between(1, 80) & F.length(digits(m)).between(1, 40), total % 10 == 0).otherwise(F.lit(False))


def byte_parts(m: Column) -> Column:
    """Whether every run of digits is at most 255."""

    def small(p: Column) -> Column:
        p = F.regexp_replace(p, "^0+", "")
        return (F.length(p) <= 3) & (F.coalesce(p.try_cast("int"), F.lit(0)) <= 255)

    return F.forall(F.regexp_extract_all(m, F.lit("[0-9]+"), F.lit(0)), small)


VALID: dict[str, Callable[[Column], Column]] = {
    "email": lambda m: F.lit(True),
    "ip": byte_parts,
    "card": lambda m: F.length(digits(m)).between(16, 19) & luhn(m),
    "phone": lambda m: F.length(digits(m)).between(8, 15),
}


def matches(text: Column, kind: str, pattern: str) -> Column:
    """(kind, start, end, m) of all leftmost matches, in code points.

    Each step takes the gap up to the next match and the match itself, and
    begins where the last one ended, so a text is read once.
    """
    whole = F.lit(rf"(?s)\G(.*?)({pattern})")
    pairs = F.arrays_zip(F.regexp_extract_all(text, whole, F.lit(1)).alias("g"), F.regexp_extract_all(text, whole, F.lit(2)).alias("m"))
    sizes = F.transform(pairs, lambda x: F.struct(F.length(x["g"]).alias("g"), x["m"].alias("m")))

    def step(s: Column, x: Column) -> Column:
        start = s["at"] + x["g"]
        end = start + F.length(x["m"])
        one = F.struct(F.lit(kind).alias("kind"), start.alias("start"), end.alias("end"), x["m"].alias("m"))
        return F.struct(end.alias("at"), F.concat(s["out"], F.array(one)).alias("out"))

    begin = F.struct(F.lit(0).cast("long").alias("at"), F.array().cast(SPAN).alias("out"))
    found = F.aggregate(sizes, begin, step, lambda s: s["out"])
    return F.when(F.rlike(text, F.lit(HINT[kind])), found).otherwise(F.array().cast(SPAN))


def base_spans(text: Column) -> Column:
    """Valid strict spans of all kinds, by kind as listed, then start."""

    def of(kind: str) -> Column:
        return F.filter(matches(text, kind, STRICT[kind]), lambda x: VALID[kind](x["m"]))

    return F.concat(*map(of, KINDS))


def candidates(text: Column) -> Column:
    """Loose spans of all kinds with the characters around them; they may overlap."""

    def around(x: Column) -> Column:
        n = F.least(x["start"], F.lit(CONTEXT).cast("long")).cast("int")
        return F.struct(
            x["kind"].alias("kind"), x["start"].alias("start"), x["end"].alias("end"), x["m"].alias("m"),
            F.substr(text, (x["start"].cast("int") - n + 1), n).alias("left"),
            F.substr(text, x["end"].cast("int") + 1, F.lit(8)).alias("right"),
        )

    return F.concat(*[F.transform(matches(text, k, LOOSE[k]), around) for k in KINDS]).cast(FOUND)


def features(x: Column) -> Column:
    """Format and context of one candidate as an array of doubles."""
    m, left, right = x["m"], x["left"], x["right"]

    def count(pattern: str) -> Column:
        return F.regexp_count(m, F.lit(pattern))

    return F.array(*[
        c.cast("double")
        for c in (
            *[x["kind"] == k for k in KINDS],
            F.length(m), count("[0-9]"), count("[A-Za-z]"), count("[^0-9A-Za-z]"), count(r"\."), count(r"[\x20-]"), count(r"[\[\]()]"),
            m.startswith("+"), luhn(m), byte_parts(m), F.regexp_count(m, F.lit("[0-9]+")),
            F.length(F.regexp_extract(m, "([A-Za-z]*)$", 1)), F.size(F.array_distinct(F.split(F.left(m, F.lit(100)), ""))),
            F.rlike(left, F.lit("[0-9A-Za-z_]$")), F.rlike(right, F.lit("^[0-9A-Za-z_]")), F.rlike(left, F.lit("[=\"'/#]\\s?$")),
            F.rlike(left, F.lit("(?i)(phone|tel|call|mobile|fax|mail|contact|write|address|host|server|card|visa|account|paid)")),
        )
    ])


def touches(x: Column, spans: Column) -> Column:
    return F.exists(spans, lambda b: (x["start"] < b["end"]) & (b["start"] < x["end"]))


def variants(m: Column, kind: Column) -> Column:
    """Other ways of writing a valid span."""
    return (
        F.when(kind == "email", F.array(F.regexp_replace(m, "@", " [at] "), F.regexp_replace(F.regexp_replace(m, "@", "(at)"), r"\.", "(dot)")))
        .when(kind == "ip", F.array(F.regexp_replace(m, r"\.", "[.]"), F.regexp_replace(m, r"\.", "-")))
        .when(kind == "card", F.array(F.regexp_replace(digits(m), "([0-9]{4})(?=[0-9])", "$1."), F.regexp_replace(digits(m), "([0-9]{4})(?=[0-9])", "$1/")))
        .otherwise(F.array(F.regexp_replace(m, r"^\+", ""), F.regexp_replace(m, r"[\x20()]+", "-"), F.regexp_replace(m, r"^\+", "00")))
    )


def distinct_candidates(docs: DataFrame, sample: int | None = None) -> DataFrame:
    """(kind, good, h, x): all distinct candidates, or at least the first ``sample`` of each kind and label by hash.

    A candidate is its kind, characters and left context, however often it
    occurs; a repeated one leaves each task once.  For a sample, counted
    sketches give the hash below which enough are, so that few rows are grouped.
    """
    text = F.col("text")
    seen = docs.where(F.rlike(text, F.lit("[0-9@]|[(\\[]at[)\\]]"))).select(base_spans(text).alias("b"), candidates(text).alias("c"))
    each = seen.select("b", F.explode("c").alias("x"))
    good = F.exists("b", lambda b: (b["kind"] == F.col("x")["kind"]) & (b["start"] == F.col("x")["start"]) & (b["end"] == F.col("x")["end"]))
    marked = each.select("x", good.alias("good"), touches(F.col("x"), F.col("b")).alias("touches")).where("good or not touches")
    rows = marked.select("x.kind", "good", F.xxhash64("x.m", "x.left").alias("h"), F.struct("x.kind", "x.m", "x.left", "x.right").alias("x"))
    if sample is None:
        return rows.groupBy("kind", "good", "h").agg(F.min("x").alias("x"))
    counts = rows.groupBy("kind", "good").agg(F.approx_count_distinct("h").alias("n")).collect()
    # three times as many as are needed: the sketch is off by a few hundredths
    below = [(r["kind"], r["good"], min(2**63 - 1, -(2**63) + 3 * sample * 2**64 // max(r["n"], 1))) for r in counts]
    low = F.lit(False)
    for kind, label, bound in below:
        low = low | ((F.col("kind") == kind) & (F.col("good") == F.lit(label)) & (F.col("h") <= F.lit(bound)))
    return rows.where(low).groupBy("kind", "good", "h").agg(F.min("x").alias("x"))


def training_rows(docs: DataFrame, sample: int | None = None) -> DataFrame:
    """(label, kind, f, held): valid spans and other ways of writing them against candidates that are neither.

    All distinct candidates; with ``sample`` at most so many of each label, in
    equal shares for the kinds as far as they have them, the first by hash.
    """
    some = settle(distinct_candidates(docs, sample), "pii-candidates").select("kind", "x", "good", "h")
    if sample is not None:
        strata = [some.where((F.col("kind") == k) & (F.col("good") == F.lit(g))).orderBy("h").limit(sample) for k in KINDS for g in (True, False)]
        # at most ``sample`` rows in each partition of the window
        ranked = reduce(DataFrame.unionByName, strata).withColumn("r", F.row_number().over(Window.partitionBy("kind", "good").orderBy("h")))
        first = [ranked.where(F.col("good") == F.lit(g)).orderBy("r", "kind").limit(sample) for g in (True, False)]
        some = settle(first[0].unionByName(first[1]).select("x", "good"), "pii")
    ways = F.concat(F.array(F.col("x.m")), F.when(F.col("good"), variants(F.col("x.m"), F.col("x.kind"))).otherwise(F.array().cast("array<string>")))
    # all ways of writing one span are on one side
    held = (F.pmod(F.xxhash64("x.m"), F.lit(4)) == 0).alias("held")
    rows = some.select("x", "good", F.explode(ways).alias("m"), held).withColumn("x", F.col("x").withField("m", F.col("m")))
    return rows.select(F.col("good").cast("double").alias("label"), "x.kind", features(F.col("x")).alias("f"), "held")


def tree_expression(text: str) -> Callable[[Column], Column]:
    """The margin of boosted trees as a function of a feature array, from their printed form."""
    weights = [float(w) for w in re.findall(r"Tree \d+ \(weight ([-\d.E]+)\)", text)]
    trees = re.split(r"Tree \d+ \(weight [-\d.E]+\):", text)[1:]

    def build(lines: list[str], f: Column) -> Column:
        head = lines.pop(0).strip()
        if found := re.match(r"Predict: (\S+)", head):
            return F.lit(float(found[1]))
        index, bound = re.match(r"If \(feature (\d+) <= (\S+)\)", head).groups()
        low = build(lines, f)
        lines.pop(0)
        return F.when(F.get(f, F.lit(int(index))) <= float(bound), low).otherwise(build(lines, f))

    def margin(f: Column) -> Column:
        total = F.lit(0.0)
        for w, t in zip(weights, trees, strict=True):
            total = total + F.lit(w) * build([x for x in t.splitlines() if x.strip()], f)
        return total

    return margin


def fit(docs: DataFrame, sample: int | None = None) -> tuple[Callable[[Column], Column] | None, dict[str, float]]:
    """Score expression of a feature array (0 to 1), and each kind's threshold.

    A threshold is the lowest, in steps of 0.01 from FLOOR, above which the
    held-out quarter is right at least PRECISION of the time; a kind without
    held-out rows of both labels takes the threshold of all kinds together,
    and one without any rows adds nothing.
    """
    rows = settle(training_rows(docs, sample), "pii")
    n = {r["label"]: r["count"] for r in rows.where("not held").groupBy("label").count().collect()}
    if min(n.get(0.0, 0), n.get(1.0, 0)) < LEAST:
        return None, {}
    train = rows.where("not held").select("label", array_to_vector("f").alias("features")).coalesce(1 + sum(n.values()) // PART)
    model = GBTClassifier(maxIter=TREES, maxDepth=DEPTH, stepSize=0.3, seed=7, maxBins=32).fit(train)
    margin = tree_expression(model.toDebugString)

    def score(f: Column) -> Column:
        return F.lit(1.0) / (F.lit(1.0) + F.exp(F.lit(-2.0) * margin(f)))

    bins = rows.where("held").groupBy("kind", F.floor(score(F.col("f")) * 100).alias("b")).agg(F.sum("label").alias("good"), F.count("*").alias("n")).collect()
    bounds = {}
    for kind in KINDS:
        own = [b for b in bins if b["kind"] == kind]
        if not 0 < sum(b["good"] for b in own) < sum(b["n"] for b in own):
            own = bins if own else []
        for b in range(int(FLOOR * 100), 101):
            above = [x for x in own if x["b"] >= b]
            if above and sum(x["good"] for x in above) >= PRECISION * sum(x["n"] for x in above):
                bounds[kind] = b / 100
                break
    return score, bounds


def added_spans(text: Column, base: Column, score: Callable[[Column], Column], bounds: dict[str, float]) -> Column:
    """Candidates over their threshold that touch no base span and no better candidate."""
    judged = F.transform(
        F.filter(candidates(text), lambda x: ~touches(x, base)),
        lambda x: F.struct(x["kind"].alias("kind"), x["start"].alias("start"), x["end"].alias("end"), score(features(x)).alias("p")),
    )
    needed = F.create_map(*[F.lit(v) for k in KINDS for v in (k, bounds.get(k, 2.0))])
    over = F.filter(judged, lambda x: x["p"] >= F.element_at(needed, x["kind"]))

    def unbeaten(all_over: Column) -> Column:
        def beaten(x: Column) -> Column:
            return F.exists(all_over, lambda y: (y["start"] < x["end"]) & (x["start"] < y["end"]) & (F.struct(y["p"], y["end"], y["kind"]) > F.struct(x["p"], x["end"], x["kind"])))

        return F.filter(all_over, lambda x: ~beaten(x))

    # an array of one makes it a variable: found and judged once for a text, not once for each that it is held against
    return F.element_at(F.transform(F.array(over), unbeaten), 1)


def span_columns(docs: DataFrame, sample: int | None = None) -> tuple[Column, Column]:
    """Expressions over ``text`` and ``_base`` for base and added spans: arrays of (kind, start, end) in code points.

    The second reads the first under the name ``_base``.
    """
    score, bounds = fit(only(docs, "doc_id", "text"), sample)
    text = F.coalesce("text", F.lit(""))
    place = "array<struct<kind:string,start:long,end:long>>"

    def placed(spans: Column) -> Column:
        return F.transform(spans, lambda x: F.struct(x["kind"].alias("kind"), x["start"].alias("start"), x["end"].alias("end"))).cast(place)

    none = F.array().cast(place)
    if not bounds:
        return placed(base_spans(text)), none
    hinted = F.rlike(text, F.lit("[0-9@]|[(\\[]at[)\\]]"))
    return placed(base_spans(text)), F.when(hinted, placed(added_spans(text, F.col("_base"), score, bounds))).otherwise(none)


def personal_data(docs: DataFrame, sample: int | None = None) -> DataFrame:
    """Each row's doc_id and text with ``base`` and ``added``: arrays of (kind, start, end) in code points.

    Null text is empty and has no spans; rows that repeat are judged each for
    itself; a null doc_id stays null.  Columns other than doc_id and text are
    not read.
    """
    base, added = span_columns(docs, sample)
    found = only(docs, "doc_id", "text").withColumn("_base", base).withColumn("added", added)
    return found.select("doc_id", "text", F.col("_base").alias("base"), "added")


def joined(spans: Column) -> Column:
    """kind:start:end by kind as listed, then start, comma-joined."""
    rank = F.create_map(*[F.lit(v) for i, k in enumerate(KINDS) for v in (k, i)])
    keyed = F.array_sort(F.transform(spans, lambda x: F.struct(F.element_at(rank, x["kind"]).alias("r"), x["start"].alias("s"), x["end"].alias("e"), x["kind"].alias("k"))))
    return F.array_join(F.transform(keyed, lambda x: F.concat_ws(":", x["k"], x["s"].cast("string"), x["e"].cast("string"))), ",")


def span_digest(found: DataFrame) -> DataFrame:
    """Counts and digests of the spans of ``personal_data``."""

    def count(kind: str) -> Column:
        return F.size(F.filter("base", lambda x: x["kind"] == kind)).cast("long").alias(f"n_{kind}")

    return found.select(
        "doc_id", *map(count, KINDS), F.sha2(joined(F.col("base")), 256).alias("base_sha256"),
        joined(F.concat("base", "added")).alias("spans"), F.size("added").cast("long").alias("n_added"),
    )


def redacted(text: Column, spans: Column) -> Column:
    """Text with each span replaced by its kind in angle brackets; overlapping spans merge under the first."""
    ordered = F.array_sort(F.transform(spans, lambda x: F.struct(x["start"].alias("s"), x["end"].alias("e"), x["kind"].alias("k"))))

    def step(s: Column, x: Column) -> Column:
        at, e = s["at"].cast("int"), x["e"].cast("int")
        piece = F.concat(F.substr(text, at + 1, F.greatest(x["s"].cast("int") - at, F.lit(0))), F.lit("<"), x["k"], F.lit(">"))
        return F.when(x["s"] < s["at"], F.struct(F.greatest(s["at"], x["e"]).alias("at"), s["out"].alias("out"))).otherwise(
            F.struct(e.cast("long").alias("at"), F.concat(s["out"], F.array(piece)).alias("out"))
        )

    begin = F.struct(F.lit(0).cast("long").alias("at"), F.array().cast("array<string>").alias("out"))
    done = F.aggregate(ordered, begin, step, lambda s: F.concat(F.array_join(s["out"], ""), F.substr(text, s["at"].cast("int") + 1)))
    return F.when(F.size(spans) == 0, text).otherwise(done)
