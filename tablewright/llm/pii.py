"""Personal data found by rules and by boosted trees over candidate spans, with DataFrame functions only.

Base spans come from fixed patterns and checks. Beyond them, generators of high recall propose spans, which may overlap;
gradient-boosted trees score each by its format and what stands around it, and spans above a threshold calibrated on held-out
candidates are added where no base span is. The trees are fitted by Spark ML on the candidates of all texts (weak labels: a
candidate that lies on a base span is personal data) and applied as column expressions, so finding and redacting need no shuffle.
"""

from __future__ import annotations

import math
import re
from dataclasses import dataclass

from pyspark.ml.classification import GBTClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tablewright.llm.base import cut_lineage

#: Kinds in the order that sorts spans, and their patterns. Loops are possessive (nothing after them could match what
#: they took), so long runs are read once and without recursion; a match may start only where its run starts, or where the match
#: before ended, because from any later sign of a run the rest is the same.
KINDS = ("email", "ip", "card", "phone")
PATTERNS = {
    "email": r"(?:(?<![A-Za-z0-9._%+-])|\G)[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "ip": r"(?:(?<![0-9])|\G)[0-9]++(?:\.[0-9]++){3}+",
    "card": r"[0-9](?:[\x20-]?[0-9]){13,}+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}
#: What a text must hold for a kind, to spare it the pattern.
SIGNS = {"email": r"@", "ip": r"[0-9]\.[0-9]", "card": r"[0-9](?:[\x20-]?[0-9]){13}", "phone": r"\+[0-9]"}
#: Generators: kind that an added span gets, and a generous pattern.
GENERATORS = {
    "email": r"(?:(?<![A-Za-z0-9._%+-])|\G)[A-Za-z0-9._%+-]++(?:@|\x20?[(\[](?:at|AT)[)\]]\x20?)[A-Za-z0-9-]++(?:(?:\.|\x20?[(\[](?:dot|DOT)[)\]]\x20?)[A-Za-z0-9-]++)*+",
    "ip": r"(?:(?<![0-9.])|\G)[0-9]{1,4}+(?:\.[0-9]{1,4}+){3,5}+",
    "phone": r"(?:(?<![0-9(])|\G)\(?[0-9]{2,4}+\)?[\x20.-][0-9][0-9\x20.-]{5,11}[0-9](?![0-9])",
    "card": r"(?:(?<![0-9])|\G)[0-9](?:[\x20-]?[0-9]){11,}+",
}
TREES, DEPTH, LEAST_OF_A_CLASS = 12, 3, 30
PRECISION = 0.98  # of held-out candidates above the threshold
AROUND = 24  # characters of context before a candidate
SPAN = "struct<start:int,place:int,end:int,kind:string>"


def _digits(c: Column) -> Column:
    return F.regexp_replace(c, "[^0-9]", "")


def luhn(digits: Column) -> Column:
    """Whether a string of digits has a right check digit."""
    values = F.transform(F.split(F.reverse(digits), ""), lambda d: d.cast("int"))
    total = F.aggregate(
        F.transform(values, lambda v, i: F.when(i % 2 == 0, v).otherwise(F.when(v >= 5, 2 * v - 9).otherwise(2 * v))),
        F.lit(0),
        lambda a, v: a + F.coalesce(v, F.lit(0)),
    )
    return total % 10 == 0


def _octets_fit(c: Column) -> Column:
    # numbers of any length: without leading zeros, at most three digits and at most 255
    return F.forall(F.split(c, r"\."), lambda p: F.coalesce(F.when(F.length(F.regexp_replace(p, "^0+", "")) <= 3, F.right(p, F.lit(3)).cast("int") <= 255), F.lit(False)))


def _valid(kind: str, match: Column) -> Column:
    n = F.length(_digits(match))
    return {
        "email": F.lit(True),
        "ip": _octets_fit(match),
        "card": F.when((n >= 14) & (n <= 19), luhn(_digits(match))).otherwise(F.lit(False)),
        "phone": (n >= 10) & (n <= 15),
    }[kind]


def _matches(text: Column, pattern: str, sign: str | None) -> Column:
    """Array of (start, end, match, before, after) in code points: what stands between matches gives their places."""
    kind = "array<struct<start:int,end:int,match:string,before:string,after:string>>"
    found = F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
    gaps = F.split(text, pattern, -1)
    pairs = F.zip_with(found, F.slice(gaps, 1, F.size(gaps) - 1), lambda m, g: F.struct(m.alias("m"), g.alias("g")))
    after = F.slice(gaps, 2, F.greatest(F.size(gaps) - 1, F.lit(0)))
    pairs = F.zip_with(pairs, after, lambda p, a: F.struct(p["m"].alias("m"), p["g"].alias("g"), a.alias("a")))
    start = F.struct(F.lit(0).alias("at"), F.array().cast(kind).alias("out"))

    def step(state: Column, p: Column) -> Column:
        begin = state["at"] + F.length(p["g"])
        end = begin + F.length(p["m"])
        one = F.struct(begin.alias("start"), end.alias("end"), p["m"].alias("match"), F.right(p["g"], F.lit(AROUND)).alias("before"), F.left(p["a"], F.lit(4)).alias("after"))
        return F.struct(end.alias("at"), F.concat(state["out"], F.array(one)).alias("out"))

    out = F.aggregate(pairs, start, step, lambda s: s["out"])
    return F.when(text.rlike(sign), out).otherwise(F.array().cast(kind)) if sign else out


def _spans(kind: str, found: Column) -> Column:
    good = F.filter(found, lambda m: _valid(kind, m["match"]))
    return F.transform(good, lambda m: F.struct(m["start"].alias("start"), F.lit(KINDS.index(kind)).alias("place"), m["end"].alias("end"), F.lit(kind).alias("kind")))


def with_base_spans(df: DataFrame, text: str = "text", name: str = "pii") -> DataFrame:
    """``df`` with an array of base spans (start, place of the kind, end, kind), in that order; code points, end exclusive.

    Null and empty texts have none. Repeated rows stay; a column called ``name`` is replaced.
    """
    whole = F.coalesce(F.col(text), F.lit(""))
    arrays = [_spans(k, _matches(whole, PATTERNS[k], SIGNS[k])) for k in KINDS]
    return df.withColumn(name, F.array_sort(F.concat(*arrays)))


FEATURES = {
    "length": lambda c: F.length(c["match"]),
    "digits": lambda c: F.length(_digits(c["match"])),
    "letters": lambda c: F.length(F.regexp_replace(c["match"], r"[^A-Za-z]", "")),
    "dots": lambda c: F.length(F.regexp_replace(c["match"], r"[^.]", "")),
    "dashes": lambda c: F.length(F.regexp_replace(c["match"], r"[^-]", "")),
    "blanks": lambda c: F.length(F.regexp_replace(c["match"], r"[^ ]", "")),
    "brackets": lambda c: F.length(F.regexp_replace(c["match"], r"[^()\[\]]", "")),
    "at_sign": lambda c: F.contains(c["match"], F.lit("@")).cast("int"),
    "groups": lambda c: F.size(F.split(c["match"], "[^0-9]+")),
    "first_digit": lambda c: F.coalesce(F.left(_digits(c["match"]), F.lit(1)).cast("int"), F.lit(-1)),
    "octets": lambda c: F.when(c["place"] == 1, _octets_fit(c["match"]).cast("int")).otherwise(F.lit(-1)),
    "luhn": lambda c: F.when(F.length(_digits(c["match"])).between(12, 24), luhn(_digits(c["match"])).cast("int")).otherwise(F.lit(-1)),
    "family": lambda c: c["place"],
    "glued_before": lambda c: c["before"].rlike(r"[A-Za-z0-9_=\"#/.-]$").cast("int"),
    "glued_after": lambda c: c["after"].rlike(r"^[A-Za-z0-9_=\"#/-]").cast("int"),
    "digits_before": lambda c: F.length(_digits(c["before"])),
    "named": lambda c: c["before"].rlike(r"(?i)\b(tel|phone|call|fax|mobile|e-?mail|mail|contact|card|visa|mastercard|ip|addr)").cast("int"),
}


def _candidates(text: Column) -> Column:
    """All proposed spans with what the features need; they may overlap."""
    signs = {"email": r"@|[(\[](?:at|AT)[)\]]", "ip": r"[0-9]\.[0-9]", "phone": r"[0-9]{2}\)?[\x20.-][0-9]", "card": r"[0-9](?:[\x20-]?[0-9]){11}"}
    fields = ("start", "end", "match", "before", "after")

    def proposed(kind: str, pattern: str) -> Column:
        named = [F.lit(KINDS.index(kind)).alias("place"), F.lit(kind).alias("kind")]
        return F.transform(_matches(text, pattern, signs[kind]), lambda m: F.struct(*[m[f].alias(f) for f in fields], *named))

    return F.concat(*[proposed(k, p) for k, p in GENERATORS.items()])


def _overlap(a: Column, b: Column) -> Column:
    return (a["start"] < b["end"]) & (b["start"] < a["end"])


@dataclass(frozen=True)
class Tree:
    """An inner node (feature, cut, low, high) or a leaf with its value."""

    value: float = 0.0
    feature: int = -1
    cut: float = 0.0
    low: Tree | None = None
    high: Tree | None = None

    def column(self, c: Column) -> Column:
        if self.low is None:
            return F.lit(self.value)
        return F.when(c[f"x{self.feature}"] <= self.cut, self.low.column(c)).otherwise(self.high.column(c))


@dataclass(frozen=True)
class SpanModel:
    """Weighted trees over FEATURES and the margin from which a candidate is taken; never, if there was too little to learn from."""

    trees: tuple[Tree, ...] = ()
    weights: tuple[float, ...] = ()
    threshold: float = math.inf

    def margin(self, c: Column) -> Column:
        parts = [F.lit(w) * t.column(c) for w, t in zip(self.weights, self.trees, strict=True)]
        return sum(parts[1:], parts[0])


def _read_trees(text: str) -> list[Tree]:
    """The trees of Spark's description of a model."""
    lines = [line.strip() for line in text.splitlines()]
    at = 0

    def node() -> Tree:
        nonlocal at
        line = lines[at]
        at += 1
        if line.startswith("Predict:"):
            return Tree(value=float(line.split(":")[1]))
        m = re.match(r"If \(feature (\d+) <= ([-0-9.Ee]+)\)", line)
        low = node()
        at += 1  # Else
        return Tree(feature=int(m[1]), cut=float(m[2]), low=low, high=node())

    trees = []
    while at < len(lines):
        if re.match(r"Tree \d+ \(weight", lines[at]):
            at += 1
            trees.append(node())
        else:
            at += 1
    return trees


def fit(df: DataFrame, text: str = "text") -> SpanModel:
    """Fits and calibrates the trees on the candidates of all texts. Those of a quarter of the texts, by their hash, are held out to set
    the threshold."""
    whole = F.col("_t")
    texts = df.select(F.col(text).alias("_t")).where("_t IS NOT NULL").withColumn("_h", F.xxhash64("_t"))
    rows = with_base_spans(texts, "_t", "base").select("_h", "base", F.explode(_candidates(whole)).alias("c"))
    label = F.exists("base", lambda b: _overlap(b, F.col("c"))).cast("double")
    table = rows.select("_h", label.alias("label"), *[f(F.col("c")).cast("double").alias(f"x{k}") for k, f in enumerate(FEATURES.values())])
    table = cut_lineage(table)
    fitted, held = table.where("pmod(_h, 4) > 0"), table.where("pmod(_h, 4) = 0")
    counts = {r.label: r.n for r in fitted.groupBy("label").agg(F.count("*").alias("n")).collect()}
    if min(counts.get(0.0, 0), counts.get(1.0, 0)) < LEAST_OF_A_CLASS:
        return SpanModel()
    columns = [f"x{k}" for k in range(len(FEATURES))]
    to_vector = VectorAssembler(inputCols=columns, outputCol="features")
    learner = GBTClassifier(maxIter=TREES, maxDepth=DEPTH, stepSize=0.3, minInstancesPerNode=5, seed=7, cacheNodeIds=False)
    model = learner.fit(to_vector.transform(fitted).select("label", "features"))
    found = SpanModel(tuple(_read_trees(model.toDebugString)), tuple(float(w) for w in model.treeWeights))
    margin = found.margin(F.struct(*columns))
    # a histogram of margins: 400 bins whatever the sample
    bins = held.select(F.floor(F.greatest(F.least(margin, F.lit(4.0)), F.lit(-4.0)) * 50).alias("bin"), "label").groupBy("bin").agg(F.sum("label").alias("good"), F.count("*").alias("n")).orderBy(F.desc("bin")).collect()
    good = n = 0
    threshold = math.inf
    for b in bins:
        good, n = good + b.good, n + b.n
        if n >= LEAST_OF_A_CLASS and good >= PRECISION * n:
            threshold = b.bin / 50
    return SpanModel(found.trees, found.weights, max(threshold, 0.0))


def with_spans(df: DataFrame, model: SpanModel, text: str = "text", name: str = "pii") -> DataFrame:
    """``df`` with a struct: ``base`` spans and ``spans``, the base ones and those that the model adds where no base span is."""
    df = with_base_spans(df, text, name)
    if not model.trees or math.isinf(model.threshold):
        return df.withColumn(name, F.struct(F.col(name).alias("base"), F.col(name).alias("spans")))
    base = F.col(name)
    proposed = F.filter(_candidates(F.coalesce(F.col(text), F.lit(""))), lambda c: ~F.exists(base, lambda b: _overlap(b, c)))
    scored = F.transform(proposed, lambda c: F.struct(c["start"].alias("start"), c["place"].alias("place"), c["end"].alias("end"), c["kind"].alias("kind"), *[f(c).cast("double").alias(f"x{k}") for k, f in enumerate(FEATURES.values())]))
    df = df.withColumn("_scored", scored)
    rated = F.transform("_scored", lambda c: F.struct(c["start"].alias("start"), c["place"].alias("place"), c["end"].alias("end"), c["kind"].alias("kind"), model.margin(c).alias("margin")))
    df = df.withColumn("_taken", F.filter(rated, lambda c: c["margin"] >= model.threshold)).drop("_scored")
    # of candidates that overlap, the best one; of equal ones the first, then the longest
    better = lambda o, c: (o["margin"] > c["margin"]) | ((o["margin"] == c["margin"]) & ((o["start"] < c["start"]) | ((o["start"] == c["start"]) & ((o["end"] > c["end"]) | ((o["end"] == c["end"]) & (o["place"] < c["place"]))))))
    taken = F.col("_taken")
    alone = F.filter(taken, lambda c: ~F.exists(taken, lambda o: _overlap(o, c) & better(o, c)))
    added = F.transform(alone, lambda c: F.struct(c["start"].alias("start"), c["place"].alias("place"), c["end"].alias("end"), c["kind"].alias("kind")))
    return df.withColumn(name, F.struct(base.alias("base"), F.array_sort(F.concat(base, added)).alias("spans"))).drop("_taken")


def count_of(spans: Column, kind: str) -> Column:
    return F.size(F.filter(spans, lambda s: s["kind"] == kind)).cast("long")


def listed(spans: Column) -> Column:
    """kind:start:end of the spans, comma-joined."""
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ",")


def redacted(text: Column, spans: Column) -> Column:
    """The text with its spans replaced by ``[KIND]``; spans that overlap are replaced together under the first one's kind."""
    start = F.struct(F.lit(0).alias("at"), F.array().cast("array<string>").alias("out"))

    def step(state: Column, s: Column) -> Column:
        new = s["start"] >= state["at"]
        pieces = F.array(F.substring(text, state["at"] + 1, s["start"] - state["at"]), F.concat(F.lit("["), F.upper(s["kind"]), F.lit("]")))
        return F.struct(F.greatest(state["at"], s["end"]).alias("at"), F.when(new, F.concat(state["out"], pieces)).otherwise(state["out"]).alias("out"))

    whole = F.aggregate(spans, start, step, lambda s: F.concat(F.array_join(s["out"], ""), F.substring(text, s["at"] + 1, F.lit(2**31 - 1) - s["at"])))
    return F.when(F.size(spans) > 0, whole).otherwise(text)
