"""Operator 3: personal data by candidate generators and gradient-boosted trees, in built-in functions only.

Patterns propose spans of four kinds. Those of the base patterns that pass their
checks always count. Looser patterns propose more, which overlap them. Boosted trees
over format and context features, none of which is a check, learn from all of
these how likely a match passes its check; so numbers that a check can only refuse by
chance tell the trees what is no personal data. A looser match is added if it
passes and its margin reaches the kind's threshold: on matches the trees have not seen, so many
of those that look as good pass that few can have passed by chance.
"""

from __future__ import annotations

from math import inf, log
from typing import NamedTuple

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from readloom.llm.scratch import Scratch

KINDS = ("email", "ip", "card", "phone")
#: Marks the matches in a text while they are cut out; in a text itself it is replaced by a sign no pattern holds.
MARK, OTHER = "\u0001", "\u0002"

#: Base patterns: leftmost, not overlapping. Possessive and anchored where that changes no match, so that time stays linear.
BASE = {
    "email": r"(?:\G|(?<![A-Za-z0-9._%+-]))[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "ip": r"(?<![0-9])[0-9]++(?:\.[0-9]++){3}",
    "card": r"[0-9](?:[ -]?[0-9])++",
    "phone": r"\+[0-9][ ().0-9-]+[0-9]",
}
#: Looser patterns, whose matches the trees judge.
LOOSE = {
    "email": r"(?i)(?<![a-z0-9._%+-])[a-z0-9._%+-]{1,64}+(?: ?\[at\] ?| ?\(at\) ?)[a-z0-9-]{1,63}+(?:(?: ?\[dot\] ?| ?\(dot\) ?| dot |\.)[a-z0-9-]{2,63}+){1,4}(?![a-z0-9])",
    "ip": r"(?i)(?<![0-9])[0-9]{1,3}(?:(?:\[\.\]|\(\.\)|\[dot\]|\(dot\))[0-9]{1,3}){3}(?![0-9])",
    "card": r"(?<![0-9A-Za-z])(?:[0-9]{4}(?:[._/ -]{1,2}[0-9]{4}){3}|[0-9]{14,19})(?![0-9A-Za-z])",
    "phone": r"(?<![0-9A-Za-z+.-])(?:\([0-9]{2,4}\)|[0-9]{2,4})[ .-]{1,2}[0-9]{3}[ .-][0-9]{4}(?![0-9A-Za-z])",
}
#: Form of an e-mail address and of one with its signs in brackets: the last part of the domain has letters only.
FORM = r"@.*\.[A-Za-z]{2,24}$"
OBFUSCATED = r"(?i)[\[(]at[\])].*(?:\.|[\[(]dot[\])] ?| dot )[a-z]{2,24}$"
#: What a text must hold for a pattern to be tried.
NEEDS = {"base": {"email": "@", "phone": "+"}, "loose": {}}
HELPFUL = r"(?i)e-?mail|contact|phone|\btel\b|\bcall\b|\bfax\b|\bcard\b|visa|server|\bhost\b|address|\bip\b"
HARMFUL = r"(?i)token|\bkey\b|hash|\bid\b|version|\bdoi\b|isbn|="


class Boosting(NamedTuple):
    """Parameters of the trees and thresholds.

    ``chance``: how often what is no personal data passes its kind's check;
    ``precision``: the share of those that pass which must not have passed by chance; with
    less than ``enough`` matches in all there are no trees, and with less held-out ones of a kind its threshold is ``default`` (log odds).
    """

    rounds: int = 6
    rate: float = 0.5
    ridge: float = 1.0
    precision: float = 0.98
    chance: tuple[float, ...] = (0.02, 0.02, 0.1, 0.05)
    enough: int = 20
    default: float = 0.0


class Forest(NamedTuple):
    """Log odds of all labels, and trees whose leaves are added to them."""

    bias: float
    trees: list


class Split(NamedTuple):
    feature: int
    most: int
    low: object
    high: object


def cut_out(text: Column, pattern: str, needed: str | None) -> Column:
    """Every match with its place: array of (start, end, match)."""
    parts = F.split(F.regexp_replace(text, pattern, f"{MARK}$0{MARK}"), MARK, -1)
    kind = "array<struct<start:int,end:int,match:string>>"
    first = F.struct(F.lit(0).alias("at"), F.lit(False).alias("inside"), F.array().cast(kind).alias("found"))

    def step(held: Column, part: Column) -> Column:
        end = held["at"] + F.length(part)
        span = F.array(F.struct(held["at"].alias("start"), end.alias("end"), part.alias("match")))
        return F.struct(end.alias("at"), (~held["inside"]).alias("inside"), F.when(held["inside"], F.concat(held["found"], span)).otherwise(held["found"]).alias("found"))

    found = F.aggregate(parts, first, step, lambda held: held["found"])
    there = F.contains(text, F.lit(needed)) if needed else text.rlike(pattern)
    return F.when(there, found).otherwise(F.array().cast(kind))


def digits_of(match: Column) -> Column:
    return F.regexp_replace(match, "[^0-9]", "")


def luhn(digits: Column) -> Column:
    """Whether the digits pass the checksum of card numbers."""

    def value(digit: Column, place: Column) -> Column:
        d = F.ascii(digit) - 48
        return F.when(place % 2 == 0, d).when(d > 4, 2 * d - 9).otherwise(2 * d)

    total = F.aggregate(F.transform(F.split(F.reverse(digits), ""), value), F.lit(0), lambda a, x: a + x)
    return F.when(F.length(digits) > 1, total % 10 == 0).otherwise(False)


def small_parts(match: Column) -> Column:
    """Whether no number between dots is over 255."""

    def small(part: Column) -> Column:
        plain = F.regexp_replace(part, "^[^0-9]*0*", "")
        return F.when(F.length(plain) > 3, False).otherwise(F.coalesce(plain.try_cast("int"), F.lit(0)) <= 255)

    return F.forall(F.split(F.regexp_replace(match, r"(?i)[\[(](?:\.|dot)[\])]", "."), r"\."), small)


def valid(kind: str, match: Column) -> Column:
    digits = digits_of(match)
    n = F.length(digits)
    if kind == "ip":
        return small_parts(match)
    if kind == "card":
        return F.when(n.between(14, 19), luhn(digits)).otherwise(False)
    return n.between(10, 15) if kind == "phone" else F.lit(True)


def sign_class(sign: Column) -> Column:
    """0 none or white space, 1 letter or digit, 2 quote or equals sign, 3 other."""
    return F.when(sign.rlike(r"^\s?$"), 0).when(sign.rlike(r"^[\p{L}\p{N}_]"), 1).when(sign.rlike("^[\"'=]"), 2).otherwise(3)


def before(text: Column, start: Column) -> Column:
    """The 24 signs before a span."""
    return F.substring(text, F.greatest(start - 23, F.lit(1)), F.least(start, F.lit(24)))


def features(text: Column, kind: str, span: Column) -> Column:
    """Format and context of a span as small numbers; none of them is a check that labels are made by."""
    match, start, end = span["match"], span["start"], span["end"]
    n = F.length(digits_of(match))
    return F.array(
        F.lit(KINDS.index(kind)),
        F.least(n, F.lit(20)),
        F.least(F.length(match), F.lit(40)),
        F.least(F.length(F.regexp_replace(match, r"[\p{L}\p{N}]", "")), F.lit(12)),
        sign_class(F.substring(text, start, F.when(start > 0, 1).otherwise(0))),
        sign_class(F.substring(text, end + 1, F.lit(1))),
        before(text, start).rlike(HELPFUL).cast("int"),
        F.least(F.length(F.regexp_extract(match, r"(?:\.|dot\W{0,2})([A-Za-z]+)$", 1)), F.lit(8)),
        F.coalesce(F.left(digits_of(match), F.lit(1)).try_cast("int"), F.lit(10)),
        F.when(F.contains(match, F.lit("@")), 0).when(match.rlike(r"(?i)[\[(]at[\])]"), 1).otherwise(2),
    )


def spans(text: Column, patterns: dict[str, str], needs: dict[str, str], source: str) -> list[Column]:
    """For each kind its candidates: array of (start, end, rank, match, passed, source)."""

    def checked(kind: str, match: Column) -> Column:
        return match.rlike(OBFUSCATED) if (source, kind) == ("loose", "email") else valid(kind, match)

    def shaped(kind: str) -> Column:
        return F.transform(cut_out(text, patterns[kind], needs.get(kind)), lambda s: F.struct(s["start"].alias("start"), s["end"].alias("end"), F.lit(KINDS.index(kind)).alias("rank"), s["match"].alias("match"), checked(kind, s["match"]).alias("passed")))

    return [shaped(kind).alias(f"{source}_{kind}") for kind in KINDS]


def margin(forest: Forest, at: Column) -> Column:
    """Log odds for a feature array: the forest's bias and its trees' leaves."""

    def leaf(node) -> Column:
        return F.when(at[node.feature] <= node.most, leaf(node.low)).otherwise(leaf(node.high)) if isinstance(node, Split) else F.lit(float(node))

    out = F.lit(forest.bias)
    for tree in forest.trees:
        out = out + leaf(tree)
    return out


def best_split(rows: list, ridge: float) -> tuple[int, int] | None:
    """(feature, greatest value of the low side) with the greatest gain over sums of gradients by feature and value."""
    best, found = 1e-9, None
    for feature in sorted({r["feature"] for r in rows}):
        own = sorted((r["value"], r["g"], r["h"]) for r in rows if r["feature"] == feature)
        g_all, h_all = sum(r[1] for r in own), sum(r[2] for r in own)
        g = h = 0.0
        for value, dg, dh in own[:-1]:
            g, h = g + dg, h + dh
            gain = g * g / (h + ridge) + (g_all - g) ** 2 / (h_all - h + ridge) - g_all * g_all / (h_all + ridge)
            if gain > best:
                best, found = gain, (feature, value)
    return found


def fit_forest(examples: DataFrame, how: Boosting) -> Forest:
    """Trees of depth two by second-order boosting from the labels' log odds; each level is one aggregate by node, feature and value.

    ``examples``: f (array<int>), label (0 or 1), n (how often). Sums leave the
    executors, rows don't. With fewer than ``how.enough`` matches, labels of one kind only, or features that tell nothing, there are no trees.
    """
    good, n = examples.agg(F.coalesce(F.sum(F.col("label") * F.col("n")), F.lit(0)), F.coalesce(F.sum("n"), F.lit(0))).first()
    bias, trees = log((good + 1) / (n - good + 1)), []
    for _ in range(how.rounds if n >= how.enough else 0):
        p = 1 / (1 + F.exp(-margin(Forest(bias, trees), F.col("f"))))
        graded = examples.select("f", (F.col("n") * (p - F.col("label"))).alias("g"), (F.col("n") * p * (1 - p)).alias("h"))

        def sums(node: Column, rows: DataFrame = graded) -> dict[int, list]:
            told = rows.withColumn("node", node).select("node", "g", "h", F.posexplode("f").alias("feature", "value")).groupBy("node", "feature", "value").agg(F.sum("g").alias("g"), F.sum("h").alias("h")).collect()
            return {n: [r for r in told if r["node"] == n] for n in (0, 1)}

        def value(rows: list) -> float:
            own = [r for r in rows if r["feature"] == 0]
            return -how.rate * sum(r["g"] for r in own) / (sum(r["h"] for r in own) + how.ridge)

        root = best_split(sums(F.lit(0))[0], how.ridge)
        if root is None:
            break
        low_side = F.when(F.col("f")[root[0]] <= root[1], 0).otherwise(1)
        children = []
        for rows in sums(low_side).values():
            cut = best_split(rows, how.ridge)
            low = [r for r in rows if cut and r["feature"] == cut[0] and r["value"] <= cut[1]]
            high = [r for r in rows if cut and r["feature"] == cut[0] and r["value"] > cut[1]]
            as_leaf = lambda own: -how.rate * sum(r["g"] for r in own) / (sum(r["h"] for r in own) + how.ridge)
            children.append(Split(*cut, as_leaf(low), as_leaf(high)) if cut else value(rows))
        trees.append(Split(*root, *children))
    return Forest(bias, trees)


def rising(groups: list[tuple[float, int, int]]) -> list[tuple[float, float]]:
    """(least margin, share of label 1) of runs of margins, the shares rising: neighbours that don't rise are one run."""
    runs: list[list] = []
    for m, good, n in sorted(groups):
        runs.append([m, good, n])
        while len(runs) > 1 and runs[-2][1] * runs[-1][2] >= runs[-1][1] * runs[-2][2]:
            _, good, n = runs.pop()
            runs[-1][1:] = runs[-1][1] + good, runs[-1][2] + n
    return [(m, good / n) for m, good, n in runs]


def calibrate(examples: DataFrame, forest: Forest, how: Boosting) -> dict[int, float]:
    """For each kind a margin from which on enough of the held-out matches pass their check; inf if they don't at any.

    It lies halfway between the matches that do and the best ones that don't.

    If a share p passes, of what is no personal data a share c by chance, then
    1 - c (1 - p) / ((1 - c) p) of those that pass have not passed by chance.
    """
    told = examples.groupBy(F.col("f")[0].alias("rank"), (F.floor(1000 * margin(forest, F.col("f"))) / 1000).alias("m")).agg(F.sum(F.col("label") * F.col("n")).alias("good"), F.sum("n").alias("n")).collect()
    out = {}
    for rank, chance in enumerate(how.chance):
        own = [(r["m"], r["good"], r["n"]) for r in told if r["rank"] == rank]
        if sum(n for _, _, n in own) < how.enough:
            out[rank] = how.default
            continue
        passes = chance / (1 - how.precision * (1 - chance))
        good = min((m for m, p in rising(own) if p >= passes), default=inf)
        below = max((m for m, _, _ in own if m < good), default=None)
        out[rank] = min(good, how.default) if below is None else (below + good) / 2
    return out


def proposed(docs: DataFrame) -> DataFrame:
    """The candidates of every row."""
    marked = docs.withColumn("marked", F.translate("text", MARK, OTHER))
    text = F.col("marked")
    return marked.select("*", *spans(text, BASE, NEEDS["base"], "base"), *spans(text, LOOSE, NEEDS["loose"], "loose"))


def examples(candidates: DataFrame) -> DataFrame:
    """Feature arrays of base and looser matches, and whether each is taken for personal data; a third is held out for the thresholds.

    It is if it passes its check (a base e-mail: if it has the form of one) and no word before it says that it is something
    else, such as a key or a version. Digits that are too few or too many for a card tell nothing, since most numbers are such.
    """

    def shaped(source: str, kind: str) -> Column:
        looks = lambda s: s["match"].rlike(FORM) if (source, kind) == ("base", "email") else s["passed"]
        label = lambda s: looks(s) & ~before(F.col("marked"), s["start"]).rlike(HARMFUL)
        found = F.filter(f"{source}_{kind}", lambda s: F.length(digits_of(s["match"])).between(14, 19)) if kind == "card" else F.col(f"{source}_{kind}")
        return F.transform(found, lambda s: F.struct(features(F.col("marked"), kind, s).alias("f"), label(s).cast("int").alias("label"), F.pmod(F.xxhash64(s["match"]), F.lit(3)).alias("fold")))

    found = [shaped(source, kind) for source in ("base", "loose") for kind in KINDS]
    return candidates.select(F.explode(F.flatten(F.array(*found))).alias("e")).select("e.*")


def find_personal_data(docs: DataFrame, *, how: Boosting = Boosting(), id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``id_col``, base (spans), spans (all: start, end, rank, kind, by code points) and redacted text of every row.

    Spans are in order of start, then of KINDS. A null or empty text has none
    and is redacted to an empty text; repeated rows give repeated results; a null id stays
    null; other columns are not read; an empty table gives an empty result. No
    shuffle but of the trees' sums and of how often each feature array occurs
    over all rows. A looser match is added if it passes its kind's check (an
    e-mail: signs in brackets and a last part of letters), its margin reaches the
    kind's threshold and it overlaps no base span.
    """
    narrow = docs.select(F.col(id_col).alias("id"), F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("text"))
    told = Scratch(docs.sparkSession).keep(examples(proposed(narrow)).groupBy("f", "label", "fold").agg(F.count("*").alias("n")))
    forest = fit_forest(told.filter("fold > 0"), how)
    least = calibrate(told.filter("fold = 0"), forest, how)

    candidates = proposed(narrow)
    plain = lambda s: F.struct(s["start"].alias("start"), s["end"].alias("end"), s["rank"].alias("rank"))
    base = F.array_sort(F.flatten(F.array(*(F.transform(F.filter(f"base_{kind}", lambda s: s["passed"]), plain) for kind in KINDS))))

    def selected(rank: int) -> Column:
        kind = KINDS[rank]
        told = F.transform(f"loose_{kind}", lambda s: F.struct(s["start"].alias("start"), s["end"].alias("end"), s["rank"].alias("rank"), s["passed"].alias("passed"), features(F.col("marked"), kind, s).alias("f")))
        return F.transform(F.filter(told, lambda s: s["passed"] & (margin(forest, s["f"]) >= least[rank])), plain)

    extra = [selected(rank) for rank in sorted(least) if least[rank] < inf]
    added = F.flatten(F.array(*extra)) if extra else F.array().cast("array<struct<start:int,end:int,rank:int>>")
    with_base = candidates.select("id", "marked", "text", base.alias("base"), added.alias("added"))
    apart = F.filter("added", lambda s: ~F.exists("base", lambda b: (b["start"] < s["end"]) & (s["start"] < b["end"])))
    named = lambda column: F.transform(column, lambda s: F.struct(s["start"].alias("start"), s["end"].alias("end"), s["rank"].alias("rank"), F.element_at(F.array(*map(F.lit, KINDS)), s["rank"] + 1).alias("kind")))
    spanned = with_base.select("id", "text", named(F.col("base")).alias("base"), named(F.array_sort(F.concat("base", apart))).alias("spans"))
    return spanned.select(F.col("id").alias(id_col), "base", "spans", redacted(F.col("text"), F.col("spans")).alias("redacted"))


def redacted(text: Column, found: Column) -> Column:
    """The text with each run of overlapping spans replaced by the kind of its first."""
    first = F.struct(F.lit(0).alias("at"), F.lit("").alias("out"))

    def step(held: Column, s: Column) -> Column:
        between = F.substring(text, held["at"] + 1, F.greatest(s["start"] - held["at"], F.lit(0)))
        put = F.concat(held["out"], between, F.lit("["), F.upper(s["kind"]), F.lit("]"))
        return F.struct(F.greatest(held["at"], s["end"]).alias("at"), F.when(s["start"] >= held["at"], put).otherwise(held["out"]).alias("out"))

    done = F.aggregate(found, first, step, lambda held: F.concat(held["out"], F.substring(text, held["at"] + 1, F.length(text))))
    return F.when(F.size(found) > 0, done).otherwise(text)


def rendered(found: Column) -> Column:
    """kind:start:end of each span, comma-joined."""
    return F.array_join(F.transform(found, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ",")
