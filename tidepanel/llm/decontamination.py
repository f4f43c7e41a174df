"""Benchmark passages in documents, also with other numbers, names and units.

Texts become templates: numbers, units after a number and capitalised words
are replaced by typed placeholders, the rest is lower case without
punctuation. A capitalised word where a sentence may begin is a name or not:
windows that hold one are hashed in both readings. Windows of ``WIDTH``
template words (items of fewer words: of all their words) are hashed and
joined with those of the benchmark. Where an item has fewer than ``WINDOWS``
windows with ``LITERAL`` literals, all its windows are looked for verbatim too
and most must match.

Windows of one passage (places in the document less places in the item differ
by little) belong together; a window of the item counts once, and only if its
slots are consistent: a value of the item stands for the same value of the
document in all windows that count.

The documents' windows never travel: the distinct hashes of the benchmark are
sent to them in blocks of at most about ``BLOCK``; what they hit is joined with
the items, which are sent only if they are at most ``BLOCK`` windows.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import let, row_key, saved

WIDTH = 8  # words of a window
LITERAL = 5  # of them not placeholders; benchmark windows with fewer say too little by themselves
WINDOWS = 4  # matching windows of an item (all, if it has fewer; most, if fewer have enough literals)
SUPPORT = 2  # literals of windows that count beside one that says enough, in items with fewer than WINDOWS of these
DRIFT = WIDTH  # words that may be put in or left out between two windows of a passage
BLOCK = 1_000_000  # hashes of benchmark windows, or such windows, sent to all tasks at a time

# Units of measure that may follow a number
UNITS = ("kg", "g", "mg", "lb", "lbs", "oz", "km", "m", "cm", "mm", "mi", "ft", "in", "miles", "mile", "meters", "metres", "feet", "inches", "l", "ml", "liters", "litres",
         "gallons", "hours", "hour", "minutes", "minute", "seconds", "second", "days", "day", "weeks", "week", "months", "month", "years", "year", "kmh", "mph", "dollars", "euros",
         "cents", "usd", "eur", "gbp", "percent", "degrees", "kw", "w", "v", "hz", "kb", "mb", "gb")
NUMBER, NAME, UNIT = "0", "1", "2"  # placeholders: a template has no other digits
_APART = r"[^\p{L}\p{N}]+"
_NAME = r"\p{Lu}(?<=[\p{L}\p{N},;] .)\p{Ll}\p{L}*"  # after a word or comma: not where a sentence begins
_CAPITAL = r"\p{Lu}(?<![\p{L}\p{N}].)\p{Ll}\p{L}*"  # anywhere: a name or the first word of a sentence
_UNIT = "0( ?)(?:" + "|".join(sorted(UNITS, key=len, reverse=True)) + r")(?![\p{L}\p{N}])"
VERBATIM = "verbatim"


def _parts(text: Column) -> Column:
    return F.array_remove(F.split(F.lower(text), _APART), "")


def _typed(text: Column, body) -> Column:
    """``body`` of the text with placeholders, with all capitalised words as names too, and without any (but numbers in one piece)."""

    def numbered(t: Column) -> Column:
        return F.regexp_replace(F.regexp_replace(t, "[0-9]+", NUMBER), _UNIT, "0$1" + UNIT)

    def typed(whole: Column) -> Column:
        sure = F.regexp_replace(F.when(whole.rlike("[0-9]"), numbered(whole)).otherwise(whole), _NAME, NAME)
        return let(sure, lambda s: let(F.regexp_replace(s, _CAPITAL, NAME), lambda a: body(s, a, whole)))

    return let(F.when(text.rlike("[0-9][.,:/][0-9]"), F.regexp_replace(text, "(?<=[0-9])[.,:/](?=[0-9])", "")).otherwise(text), typed)


def template(text: Column) -> Column:
    """struct<words, names, values>: template words; those with all capitalised words as names (NULL if alike);
    the words they stand for (NULL if there is no placeholder)."""
    return _typed(text, lambda s, a, whole: F.struct(
        _parts(s).alias("words"), F.when(a != s, _parts(a)).alias("names"), F.when(a.rlike("[012]"), _parts(whole)).alias("values")))


def _names() -> Column:
    return F.coalesce("t.names", "t.words")


def _values() -> Column:
    return F.coalesce("t.values", "t.words")


def _hashed(words: Column, verbatim: bool) -> Column:
    """A hash of each word, another one where the words themselves are looked for; windows are hashed from these."""
    salt = [F.lit(VERBATIM)] if verbatim else []
    return F.transform(words, lambda w: F.xxhash64(*salt, w))


def windows(rows: DataFrame, forms: list[tuple[int, bool]]) -> DataFrame:
    """Columns of ``rows`` without ``text``; ``own`` (hash of each word its template stands for), ``pos`` and ``hash`` of each window.

    ``forms``: widths, and whether the words themselves are hashed or the
    template in both readings. Hashes are NULL where a text has no such window.
    A text's words are hashed as soon as they are cut: rows hold numbers.
    """
    kept = [c for c in rows.columns if c != "text"]
    kinds = sorted({v for _, v in forms})

    # each word is hashed once a reading, in a lambda, which Spark interprets; windows of these hashes are compiled
    def numbers(s: Column, a: Column, whole: Column) -> Column:
        read = [] if False not in kinds else [_hashed(_parts(s), False).alias("words"), F.when(a != s, _hashed(_parts(a), False)).alias("names")]
        plain = lambda w: [_hashed(w, True).alias("plain")] if True in kinds else []
        return F.struct(*read, let(_parts(whole), lambda w: F.struct(F.transform(w, lambda x: F.hash(x)).alias("own"), *plain(w))).alias("values"))

    split = rows.select(*kept, _typed(F.col("text"), numbers).alias("t"))
    readings = [(v, c) for v in kinds for c in ((F.col("t.values.plain"),) if v else (F.col("t.words"), F.col("t.names")))]
    none = F.array().cast("array<bigint>")
    split = split.select(*kept, F.col("t.values.own").alias("own"), *[F.coalesce(c, none).alias(f"h{k}") for k, (v, c) in enumerate(readings)])
    ways = [(w, f"h{k}") for k, (r, _) in enumerate(readings) for w, v in forms if v == r]
    last = F.greatest(*[F.size(h) - w for w, h in ways], F.lit(-1))

    # by get(), which ends in NULL beyond the text: slice() copies the whole array each time
    def hashed(width: int, h: str) -> Column:
        return F.when(F.col("pos") + width <= F.size(h), F.xxhash64(*[F.get(h, F.col("pos") + j) for j in range(width)]))

    # "outer", as for a plain explode the optimizer puts a filter on the array's size below the scan, which computes it all twice
    return (split.select(*split.columns, F.explode_outer(F.when(last >= 0, F.sequence(F.lit(0), last))).alias("pos"))
            .select(*kept, "own", "pos", F.explode(F.array(*[hashed(w, h) for w, h in ways])).alias("hash")))


def _wanted(items: DataFrame) -> DataFrame:
    """Windows of the items: item, item_id, item_pos, hash, width, verbatim, strong, need, item_slots.

    ``strong``: 2 with ``LITERAL`` literals, 1 if verbatim, else 0; ``need``:
    windows that must match unless ``WINDOWS`` with enough literals do;
    ``item_slots``: offset and value of each placeholder.
    """
    cut = (items.select(row_key("item_id", "text").alias("item"), "item_id", template(F.col("text")).alias("t")).dropDuplicates(["item"]).filter(F.size("t.words") > 0)
           .withColumn("width", F.least(F.lit(WIDTH), F.size("t.words"))).withColumn("item_pos", F.explode(F.sequence(F.lit(0), F.size("t.words") - F.col("width")))))

    def part(words: Column) -> Column:
        return F.slice(words, F.col("item_pos") + 1, F.col("width"))

    def literals(words: Column) -> Column:
        return F.size(F.filter(words, lambda w: ~w.rlike("[012]")))

    cut = cut.select("item", "item_id", "item_pos", "width", part(F.col("t.words")).alias("ws"), part(_names()).alias("ns"), part(_values()).alias("vs"))
    cut = cut.withColumn("rich", literals(F.col("ws")) >= LITERAL).withColumn("renamed", literals(F.col("ns")) >= LITERAL)
    per = cut.groupBy("item").agg(F.count(F.lit(1)).cast("int").alias("n"), F.count_if("rich").alias("rich_n"), F.count_if("renamed").alias("renamed_n"))
    few = F.col("renamed_n") < WINDOWS
    slots = F.filter(F.transform("ns", lambda n, o: F.when(n.rlike("[012]"), F.struct(o.alias("o"), F.hash(F.get("vs", o)).alias("i")))), lambda x: x.isNotNull())

    def way(words: str, verbatim: bool, kept: Column) -> Column:
        strong = F.lit(1) if verbatim else F.when(literals(F.col(words)) >= LITERAL, 2).otherwise(0)
        return F.when(kept, F.struct(F.xxhash64(_hashed(F.col(words), verbatim)).alias("hash"), F.lit(verbatim).alias("verbatim"), strong.alias("strong")))

    def template_way(words: str) -> Column:
        return literals(F.col(words)) >= F.when(few & (F.col("rich_n") > 0), F.lit(SUPPORT)).otherwise(LITERAL)

    ways = F.array(way("ws", False, template_way("ws")), way("ns", False, template_way("ns") & (F.col("ns") != F.col("ws"))), way("vs", True, few))
    need = F.when(few, F.greatest(F.least(F.lit(WINDOWS), F.col("n")), F.floor(F.col("n") / 2).cast("int") + 1)).otherwise(WINDOWS)
    cut = cut.drop("rich", "renamed")
    return (cut.join(per, "item").select("item", "item_id", "item_pos", "width", need.alias("need"), slots.alias("item_slots"), F.explode(ways).alias("way"))
            .filter("way is not null").select("*", "way.*").drop("way"))


def _consistent(found: Column) -> Column:
    """Windows of one passage that have only values which the item's value most often stands for there."""

    def kept(tally: Column) -> Column:
        def outvoted(p: Column) -> Column:
            mine = F.filter(tally, lambda t: t["pair"] == p)[0]["n"]
            # of equal votes the item's own value counts, else the smaller one
            first = lambda t: (p["i"] != p["d"]) & ((t["pair"]["d"] == p["i"]) | (t["pair"]["d"] < p["d"]))
            return F.exists(tally, lambda t: (t["pair"]["i"] == p["i"]) & ((t["n"] > mine) | ((t["n"] == mine) & first(t))))

        return F.filter(found, lambda w: ~F.exists(w["pairs"], outvoted))

    def tallied(pairs: Column) -> Column:
        return F.transform(F.array_distinct(pairs), lambda p: F.struct(p.alias("pair"), F.size(F.filter(pairs, lambda q: q == p)).alias("n")))

    return let(let(F.flatten(F.transform(found, lambda w: w["pairs"])), tallied), kept)


def contaminated(docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text", item_col: str = "item_id", item_text_col: str = "text",
                 block: int = BLOCK) -> DataFrame:
    """doc_id, item_id, windows, verbatim, doc_key: one row per document and benchmark item found in it.

    ``windows`` is the most windows of the item that one passage has with
    consistent slots; ``verbatim`` tells that it has the item's own values.
    Items with too few literals are found verbatim only. NULL texts and texts
    without words match nothing. ``doc_key`` is ``row_key`` of the document;
    rows that share it give one row per item. An empty table on either side
    gives an empty result. An item of few different words has each of its
    windows at many places of a repetitive text; a passage counts each window
    and each place once.
    """
    items = benchmark.filter(F.col(item_text_col).isNotNull()).select(F.col(item_col).alias("item_id"), F.col(item_text_col).alias("text"))
    wanted = saved(_wanted(items), "benchmark-windows")
    hashes = saved(wanted.select("hash").distinct(), "benchmark-hashes")
    forms = sorted((r["width"], r["verbatim"]) for r in wanted.select("width", "verbatim").distinct().collect()) or [(WIDTH, False)]
    blocks = max(1, -(-hashes.count() // (block * 4 // 5)))  # by hash, so a little uneven
    rows = docs.filter(F.col(text_col).isNotNull()).select(F.col(id_col).alias("doc_id"), row_key(id_col, text_col).alias("doc_key"), F.col(text_col).alias("text"))
    cut = windows(rows, forms)
    # without a lambda, so compiled with the join: a hit that left it before this would take a copy of its whole document's words
    own = F.array(*[F.get("own", F.col("pos") + j) for j in range(WIDTH)])
    hits = [cut.join(F.broadcast(hashes.filter(F.pmod("hash", F.lit(blocks)) == b)), "hash").select("doc_id", "doc_key", "pos", "hash", own.alias("own")) for b in range(blocks)]
    many = wanted.count() > block
    met = (reduce(DataFrame.unionByName, hits).join(wanted if many else F.broadcast(wanted), "hash")
           .withColumn("pairs", F.transform("item_slots", lambda s: F.struct(s["i"].alias("i"), F.get("own", s["o"]).alias("d"))))
           .withColumn("shift", F.col("pos") - F.col("item_pos")))
    # two grids of passages: places that differ by at most DRIFT are together in one of them
    grids = F.array(*[F.struct(F.lit(g).alias("grid"), F.floor((F.col("shift") + g * DRIFT) / (2 * DRIFT)).alias("passage")) for g in range(2)])
    places = lambda ws, c="item_pos": F.size(F.array_distinct(F.transform(ws, lambda w: w[c])))
    distinct = lambda ws: F.least(places(ws), places(ws, "pos"))
    found = (met.select("doc_id", "doc_key", "item", "item_id", "need", F.explode(grids).alias("at"), F.struct("item_pos", "pos", "pairs", "strong").alias("w"))
             .groupBy("doc_id", "doc_key", "item", "item_id", "at").agg(F.collect_set("w").alias("found"), F.max("need").alias("need"))
             .withColumn("kept", _consistent(F.col("found")))
             .withColumn("windows", distinct(F.col("kept")))
             .withColumn("same", places(F.filter("found", lambda w: F.forall(w["pairs"], lambda p: p["i"] == p["d"]))) == places(F.col("found")))
             .filter((distinct(F.filter("kept", lambda w: w["strong"] == 2)) >= WINDOWS) | ((F.col("windows") >= F.col("need")) & F.exists("kept", lambda w: w["strong"] > 0))))
    return (found.groupBy("doc_id", "doc_key", "item_id").agg(F.max("windows").alias("windows"), F.max_by("same", F.struct("windows", "same")).alias("verbatim"))
            .select("doc_id", "item_id", "windows", "verbatim", "doc_key"))
