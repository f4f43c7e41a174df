"""Personal data in whole texts: candidate spans, scored by boosted trees, in SQL expressions.

Generators with high recall propose spans that may overlap: the four base
patterns, and looser ones (written-out and spaced addresses, defanged IP
numbers, card numbers in other layouts or within longer rows of digits,
national and 00- phone numbers). Spans of a base pattern that pass its check
always count.

Of every candidate the value, brought to its plain form, passes or fails its
kind's check (Luhn digits, parts at most 255, numbers of digits, a top-level
name). The trees do not see the value: they learn from the generator and from
features of format and context how often candidates of such a kind pass. Where
rows of digits are serial numbers, one in ten passes by chance and the score
is low; where they are card numbers it is high. A threshold per kind is
calibrated on the looser candidates of documents the trees did not see. A
looser candidate counts if its value passes, its score reaches the threshold
and no base span overlaps it.

Everything that touches rows is a DataFrame expression. Candidates are found
in one pass over the texts and written; training reads a contingency table
of the features (bounded by their numbers of values), so it covers all
candidates; the trees are applied as nested CASE expressions.

Patterns are those of the base, in a form that stays linear on long texts: a
match can begin only where the run of its first part begins or where the
previous match ended (\\G), which gives the same leftmost matches. Repeated
groups are possessive, as Java follows others by recursion and a long match
would end its stack.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import fold, let, prefix_sums, saved
from .quality import Forest

KINDS = ("email", "ip", "card", "phone")
_PART = r"0*(?:25[0-5]|2[0-4][0-9]|1[0-9][0-9]|[1-9]?[0-9])"  # at most 255
_LOCAL = "[A-Za-z0-9._%+-]"
# fixed values: top-level names that are no common words
_TOP = "com|org|net|edu|gov|mil|int|info|biz|io|co|uk|de|fr|es|nl|eu|us|ca|au|jp|cn|br|ru|ch|se|pl|kr|mx"
_DOT = r"(?: ?(?:\(dot\)|\[dot\]|\{dot\}|\[\.\]|\(\.\)) ?| dot | \. |\.)"
# (kind, pattern, what a text with a match must hold)
GENERATORS = (
    (0, rf"(?:\G|(?<!{_LOCAL})){_LOCAL}++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++", "@"),
    (1, r"(?<![0-9])[0-9]++(?:\.[0-9]++){3}", r"[0-9]\.[0-9]"),
    (2, r"(?<![0-9])(?<![0-9][ -])[0-9](?:[ -]?[0-9]){12,}+", r"[0-9](?:[ -]?[0-9]){12}"),
    (3, r"\+[0-9][ ().0-9-]+[0-9]", r"\+[0-9]"),
    (0, rf"(?<!{_LOCAL}){_LOCAL}++ ?(?:\(at\)|\[at\]|\{{at\}}|\[@\]|\(@\)) ?[A-Za-z0-9-]++(?:{_DOT}[A-Za-z0-9-]++)++", r"[(\[{](?:at|@)[)\]}]"),
    (0, rf"(?<!{_LOCAL}){_LOCAL}++ at [A-Za-z0-9-]++(?: dot [A-Za-z0-9-]++)++", " dot "),
    (0, rf"(?<!{_LOCAL}){_LOCAL}++(?: @ ?|@ )[A-Za-z0-9-]++(?: ?\. ?[A-Za-z0-9-]++)++", " @|@ "),
    (1, r"(?<![0-9])[0-9]{1,3}+(?:(?: ?(?:\[\.\]|\(\.\)|\[dot\]|\(dot\)) ?| \. | dot )[0-9]{1,3}+){3}(?![0-9])", r"[0-9] ?(?:[\[(](?:\.|dot)[\])]|\. | dot )"),
    (2, r"(?<![0-9])[0-9]{14,19}+(?![0-9])", "[0-9]{14}"),
    (2, r"(?<![0-9][ ._/-]?)[0-9]{4}+(?:[ ._/-]{1,3}+[0-9]{4,7}+){2,3}+(?![0-9])", "[0-9]{4}[ ._/-]{1,3}[0-9]{4}"),
    (3, r"(?<![0-9+.-])(?:\([0-9]{3}\) ?|[0-9]{3}[ .-])[0-9]{3}[ .-][0-9]{4}(?![0-9.-])", r"[0-9]{3}[) .-] ?[0-9]{3}[ .-][0-9]{4}"),
    (3, r"(?<![0-9+.-])00[1-9][0-9]{0,2}(?:[ ().-]{1,3}+[0-9]{2,5}+){2,5}+(?![0-9])", "00[1-9]"),
)
BASE = 4  # the first so many have a check
FEATURES = ("generator", "groups", "before", "after", "cue", "plus", "brackets", "size")
PRECISION = 0.9  # share of candidates from the threshold on whose value passes
PRIOR = 2  # candidates for which all kinds together speak beside a kind's own
_SPAN = "array<struct<kind:int,start:bigint,end:bigint,base:boolean,valid:boolean," + ",".join(f"{f}:int" for f in FEATURES) + ">>"


def _beside(c: Column) -> Column:
    return (F.when(c.isNull() | (c == "") | c.rlike(r"^\s"), 0).when(c.rlike(r"^\p{L}"), 1).when(c.rlike("^[0-9]"), 2).when(c.rlike(r"^[\"'(<\[{)>\]}]"), 3).otherwise(4))


def _proposals(text: Column, number: int) -> Column:
    kind, pattern, needs = GENERATORS[number]

    def describe(x: Column, start: Column, left: Column, right: Column, digits: Column) -> Column:
        n = F.length(digits)
        parts = F.regexp_replace(x, "[^0-9]++", ".")
        passes = (F.lit(True) if number < BASE else F.lower(x).rlike(rf"[^a-z](?:{_TOP})$"), parts.rlike(rf"^{_PART}(?:\.{_PART}){{3}}$"), n.between(14, 19) & F.call_function("luhn_check", digits),
                  (n - F.when(x.startswith("00"), 2).otherwise(0)).between(10, 15))[kind]
        cue = (F.when(left.rlike("mail|contact|write"), 1).when(left.rlike(r"\bip\b|addr|host|server"), 2).when(left.rlike("card|visa|master|credit|account|iban"), 3)
               .when(left.rlike(r"phone|\btel|call|fax|mobile|cell"), 4).otherwise(0))
        values = {"generator": F.lit(number), "groups": F.least(F.size(F.split(x, r"[^A-Za-z0-9]+")), F.lit(8)), "before": _beside(F.right(left, F.lit(1))), "after": _beside(right),
                  "cue": cue, "plus": x.startswith("+").cast("int"), "brackets": F.contains(x, F.lit("(")).cast("int"), "size": F.least(F.floor(F.length(x) / 4), F.lit(12))}
        return F.struct(F.lit(kind).alias("kind"), start.alias("start"), (start + F.length(x)).alias("end"), (passes if number < BASE else F.lit(False)).alias("base"), passes.alias("valid"),
                        *[v.cast("int").alias(k) for k, v in values.items()])

    def spans(found: Column) -> Column:
        matches, between = found["matches"], found["between"]
        steps = F.transform(matches, lambda x, i: (F.length(F.get(between, i)) + F.length(x)).cast("long"))
        return let(prefix_sums(steps), lambda at: F.transform(matches, lambda x, i: let(
            F.struct((F.get(at, i) + F.length(F.get(between, i))).alias("start"), F.lower(F.right(F.get(between, i), F.lit(24))).alias("left"),
                     F.left(F.get(between, i + 1), F.lit(1)).alias("right"), F.regexp_replace(x, "[^0-9]", "").alias("digits")),
            lambda c: describe(x, c["start"], c["left"], c["right"], c["digits"]))))

    found = F.struct(F.regexp_extract_all(text, F.lit(pattern), F.lit(0)).alias("matches"), F.split(text, pattern, -1).alias("between"))
    return F.when(text.rlike(needs), let(found, spans).cast(_SPAN)).otherwise(F.array().cast(_SPAN))


def candidates(text: Column) -> Column:
    """array<struct<kind, start, end, base, valid, features>> of a text; NULL texts count as empty."""
    whole = F.coalesce(text, F.lit(""))
    return F.concat(*[_proposals(whole, g) for g in range(len(GENERATORS))])


def train(found: DataFrame) -> tuple[Forest | None, list[float]]:
    """Trees, and the threshold of each kind, from ``found`` (spans array<...>, fold int)."""
    tables = (found.select("fold", F.explode("spans").alias("s"))
              .groupBy("fold", "s.kind", "s.valid", *[f"s.{f}" for f in FEATURES]).count().collect())  # one row per combination of values
    part = lambda keep: sorted((r for r in tables if keep(r["fold"])), key=tuple)
    matrix = lambda rows: np.array([[r[f] for f in FEATURES] for r in rows], dtype=np.float64).reshape(-1, len(FEATURES))
    seen, unseen = part(lambda f: f), part(lambda f: not f)
    if not tables:
        return None, []
    seen, unseen = seen or unseen, unseen or seen
    forest = Forest(trees=24, depth=3, rate=0.3).fit(matrix(seen), np.array([float(r["valid"]) for r in seen]), np.array([float(r["count"]) for r in seen]))
    scores = forest.score(matrix(unseen))
    kind, loose = np.array([r["kind"] for r in unseen]), np.array([r["generator"] >= BASE for r in unseen])
    count = np.array([float(r["count"]) for r in unseen])
    passed = count * np.array([r["valid"] for r in unseen])
    steps = np.unique(scores)

    def share(own: np.ndarray, step: float, prior: float) -> float:
        some = own & (scores >= step)
        return (passed[some].sum() + PRIOR * prior) / (count[some].sum() + PRIOR)

    pooled = [passed[scores >= x].sum() / count[scores >= x].sum() for x in steps]
    # the lowest score from which enough pass; where none has a share so high, no candidate can reach the limit
    return forest, [next((float(x) for x, p in zip(steps, pooled) if share(loose & (kind == k), x, p) >= PRECISION), 2.0) for k in range(len(KINDS))]


def _score(forest: Forest, span: Column) -> Column:
    def node(t: int, level: int, at: int) -> Column:
        if level == forest.depth:
            return F.lit(float(forest.value[t, at]))
        k = (1 << level) - 1 + at
        split = forest.split[t, k]
        if not np.isfinite(split):
            return node(t, level + 1, 2 * at)
        return F.when(span[FEATURES[forest.feature[t, k]]] > F.lit(float(split)), node(t, level + 1, 2 * at + 1)).otherwise(node(t, level + 1, 2 * at))

    total = F.lit(forest.start)
    for t in range(forest.trees):
        total = total + node(t, 0, 0)
    return 1 / (1 + F.exp(-total))


def _overlaps(spans: Column, s: Column) -> Column:
    """Whether one of ``spans``, in order and apart from each other, overlaps ``s``: the first that ends behind its start, by bisection."""

    def halve(at: Column, _: Column) -> Column:
        mid = F.shiftright(at["low"] + at["high"], 1)
        behind = F.get(spans, mid)["end"] > s["start"]
        return F.when(at["low"] >= at["high"], at).when(behind, F.struct(at["low"].alias("low"), mid.alias("high"))).otherwise(F.struct((mid + 1).alias("low"), at["high"].alias("high")))

    start = F.struct(F.lit(0).alias("low"), F.size(spans).alias("high"))
    first = F.aggregate(F.sequence(F.lit(1), F.lit(32)), start, halve, lambda at: at["low"])
    return (F.size(spans) > 0) & F.coalesce(F.get(spans, first)["start"] < s["end"], F.lit(False))


def personal_data(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The id and ``base``, ``spans``: array<struct<start, kind, end>> in order, per row of ``docs``.

    ``start`` and ``end`` are code points, the end exclusive; ``kind`` is a
    place in ``KINDS``. NULL texts count as empty, rows with a NULL or
    repeated id are rows like others. Texts of any length are read whole, in
    time linear in their length. An empty table gives an empty result; equal
    scores are on the same side of a threshold. Columns besides the two are
    not read.
    """
    found = saved(docs.select(F.col(id_col).alias("doc_id"), fold(id_col, 2).alias("fold"), candidates(F.col(text_col).cast("string")).alias("spans")), "pii-candidates")
    forest, limits = train(found)
    brief = lambda s: F.struct(s["start"].alias("start"), s["kind"].alias("kind"), s["end"].alias("end"))
    base = F.transform(F.filter("spans", lambda s: s["base"]), brief)

    def added(sure: Column) -> Column:
        # base spans of a kind do not overlap and stand in order
        by_kind = F.array(*[F.filter(sure, lambda b, k=k: b["kind"] == k) for k in range(len(KINDS))])

        def counts(s: Column, own: Column) -> Column:
            limit = F.get(F.array(*[F.lit(x) for x in limits]), s["kind"])
            return ~s["base"] & s["valid"] & (_score(forest, s) >= limit) & ~F.exists(own, lambda spans: _overlaps(spans, s))

        more = let(by_kind, lambda own: F.transform(F.filter("spans", lambda s: counts(s, own)), brief)) if forest else F.array().cast("array<struct<start:bigint,kind:int,end:bigint>>")
        every = let(F.array_sort(F.concat(sure, more)), lambda xs: F.filter(xs, lambda x, i: (i == 0) | (x != F.get(xs, i - 1))))
        return F.struct(F.array_sort(sure).alias("base"), every.alias("spans"))

    return found.select("doc_id", let(base, added).alias("s")).select("doc_id", "s.base", "s.spans")


def written(spans: Column) -> Column:
    """kind:start:end, comma-joined."""
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", F.get(F.array(*[F.lit(k) for k in KINDS]), s["kind"]), s["start"], s["end"])), ",")


def digest(found: DataFrame) -> DataFrame:
    """doc_id, the number of base spans by kind, the SHA-256 of the base spans, and all spans."""
    number = lambda k: F.size(F.filter("base", lambda s: s["kind"] == k)).cast("long")
    return found.select("doc_id", *[number(i).alias(f"n_{k}") for i, k in enumerate(KINDS)], F.sha2(written(F.col("base")), 256).alias("base_sha256"), written(F.col("spans")).alias("spans"))
