"""PII, decontamination and line dedup against plain Python; the pipeline."""

import collections
import hashlib
import random
import re

import duckdb
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from tidepanel.llm.decontamination import _hashed, contaminated, template, windows
from tidepanel.llm.lines import MIN_SITES, remove_shared_lines, remove_shared_lines_sql
from tidepanel.llm.pii import digest, personal_data

from .helpers import ODD, frame, prose

PATTERNS = [("email", r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+"), ("ip", r"[0-9]+(?:\.[0-9]+){3}"), ("card", r"[0-9](?:[\x20-]?[0-9])+"), ("phone", r"\+[0-9][\x20().0-9-]+[0-9]")]


def luhn(digits):
    return sum((2 * int(c) - 9 if int(c) > 4 else 2 * int(c)) if i % 2 else int(c) for i, c in enumerate(reversed(digits))) % 10 == 0


def plain_spans(text):
    out = []
    for k, (name, p) in enumerate(PATTERNS):
        for m in re.finditer(p, text or ""):
            d = re.sub("[^0-9]", "", m.group())
            if (name == "ip" and any(int(x) > 255 for x in m.group().split("."))) or (name == "card" and not (14 <= len(d) <= 19 and luhn(d))) or (name == "phone" and not 10 <= len(d) <= 15):
                continue
            out.append((m.start(), k, m.end()))
    return sorted(out)


def test_personal_data_against_plain_patterns(spark):
    rng = random.Random(4)
    bits = ["a", "b@", "@", "x.y", "1.2.3.4", "300", "255", "0255", ".", "-", " ", "+", "+1", "(743) ", "555", "-1234", "4111111111111111", "4111 1111 1111 1111", "0", "é", "_", "%", "\n", "a@b.c", "1.", "com", "𝒳"]
    rows = ODD + [(100 + i, "".join(rng.choice(bits) for _ in range(rng.randint(0, 25)))) for i in range(400)] + [(9999, "1 " * 20_000 + "a@b.c " * 3000 + "+" * 5000)]
    got = collections.Counter((r.doc_id, r.n_email, r.n_ip, r.n_card, r.n_phone, r.base_sha256) for r in digest(personal_data(frame(spark, rows))).collect())
    want = collections.Counter()
    for d, t in rows:
        s = plain_spans(t)
        text = ",".join(f"{PATTERNS[k][0]}:{a}:{b}" for a, k, b in s)
        want[(d, *[sum(x[1] == k for x in s) for k in range(4)], hashlib.sha256(text.encode()).hexdigest())] += 1
    assert got == want


LONG = 1_000_000
LONG_MATCHES = [  # of the inner part of each generator; what the base then has of each kind
    ("a@b", ".b", "", (1, 0, 0, 0)), ("x[at]b", " dot c", "", (0, 0, 0, 0)), ("x at b", " dot c", "", (0, 0, 0, 0)), ("x @ b", " . c", "", (0, 0, 0, 0)),
    ("1", ".1", ".1.1", (0, (LONG + 3) // 4, 0, 0)), ("4", " 1", "", (0, 0, 0, 0)), ("+1", "(2)", "", (0, 0, 0, 0)), ("", "4111.", "1111", (0, 0, 0, 0)), ("0044", " 20", "", (0, 0, 0, 0)),
    ("1", "[.]1", "", (0, 0, 0, 0)), ("", "4", "", (0, 0, 0, 0)), ("", "a", "@b", (0, 0, 0, 0)), ("", "(743) 555-1234 " * 20, "", None)]


@pytest.mark.parametrize("head,inner,tail,base", LONG_MATCHES)
def test_personal_data_in_one_long_match(spark, head, inner, tail, base):
    text = head + inner * (LONG if base else 2000) + tail
    got = digest(personal_data(frame(spark, [(1, text)], 1))).collect()
    assert base is None or [(r.n_email, r.n_ip, r.n_card, r.n_phone) for r in got] == [base]


def luhn_number(seed, fits=True):
    digits = [int(c) for c in f"{4_000_000_000_000_00 + seed * 7_919:015d}"]
    sums = sum(d if i % 2 else sum(divmod(2 * d, 10)) for i, d in enumerate(digits))
    return "".join(map(str, digits)) + str((-sums - (not fits)) % 10)


LOOSE = [("email", lambda i: f"joe{i} (at) site{i} dot org"), ("email", lambda i: f"ann{i}[at]mail[dot]example[dot]com"), ("email", lambda i: f"bob{i} at home dot net"), ("email", lambda i: f"kim{i} @ box . org"),
         ("ip", lambda i: f"10.{i}[.]3[.]{i}".replace("10.", "10[.]")), ("card", lambda i: ".".join(re.findall("....", luhn_number(i)))), ("card", lambda i: f"{luhn_number(i)} {luhn_number(i + 500)}"),
         ("phone", lambda i: f"(743) 555-{1000 + i}"), ("phone", lambda i: f"0044 20 7946 {1000 + i}")]


@pytest.mark.parametrize("n", [3, 60])
def test_personal_data_adds_written_out_forms(spark, n):
    """Recall and precision of the added spans, in a small and a larger table: no number of rows turns them off."""
    rows, want = [], set()
    for k, (kind, form) in enumerate(LOOSE):
        for i in range(n):
            said, before = form(i), "please write to "
            parts = said.split(" ") if k == 6 else [said]  # two numbers side by side are one row of digits
            for x in parts:
                want.add((1000 * k + i, f"{kind}:{len(before) + said.index(x)}:{len(before) + said.index(x) + len(x)}"))
            rows.append((1000 * k + i, f"{before}{said}, thanks"))
    rows += [(100_000 + i, f"mail a{i}@b.org or call +1 (743) 555-{3000 + i} from 10.0.0.{i}, card {luhn_number(900 + i)}") for i in range(n)]
    rows += [(200_000 + i, f"nothing to see at the dot of {i} noon, part {luhn_number(i, False)} in version 1.{i} of 2024-01-{10 + i % 20}") for i in range(n)]
    got = {(r.doc_id, s) for r in digest(personal_data(frame(spark, rows))).collect() for s in r.spans.split(",") if s and r.doc_id < 100_000}
    clean = [r for r in digest(personal_data(frame(spark, rows))).collect() if r.doc_id >= 200_000]
    assert len(got & want) >= 0.95 * len(want), sorted(want - got)[:5]
    assert len(got & want) >= 0.95 * len(got)
    assert not any(r.spans for r in clean)


def test_personal_data_leaves_serial_numbers(spark):
    """Rows of digits of which one in ten passes by chance are no card numbers; their layout gives them away."""
    serial = [".".join(re.findall("....", luhn_number(i, i % 10 == 0))) for i in range(200)]
    rows = [(i, f"item {s}, in stock") for i, s in enumerate(serial)] + [(1000 + i, f"paid by card {luhn_number(i)}") for i in range(50)]
    got = digest(personal_data(frame(spark, rows))).collect()
    assert not any(r.spans for r in got if r.doc_id < 1000) and all(r.n_card == 1 for r in got if r.doc_id >= 1000)


def test_personal_data_keeps_base_and_takes_any_table(spark):
    rows = [(i, f"word call +1 (743) 555-{3000 + i} or mail a{i}@b.org, not {i}.300.2.1 nor +1 2") for i in range(80)] + [(501, "nothing here")]
    got = {r.doc_id: r for r in digest(personal_data(frame(spark, rows))).collect()}
    assert all(got[i].spans.startswith("phone:10:27") and f"email:{36}:" in got[i].spans for i in range(80)) and got[501].spans == ""
    assert digest(personal_data(frame(spark, []).limit(0))).count() == 0
    assert [r.spans for r in digest(personal_data(frame(spark, [(1, "no candidate"), (1, None)]))).collect()] == ["", ""]


ITEM = "A train leaves Rome with 120 riders and 35 bags, after 3 hours it has 120 riders and no bags. How many bags per hour did Anna lose on the way"


def test_decontamination(spark):
    items = spark.createDataFrame([(1, ITEM, 5), (2, "short item here", 5), (3, None, 5), (4, "", 5), (5, prose(77, 30), 5), (5, prose(77, 30), 5)], "item_id long, text string, hash long")
    other = ITEM.replace("Rome", "Oslo").replace("120", "7,500").replace("35", "9").replace("Anna", "Bob").replace("hours", "minutes")
    mixed = ITEM.replace("120 riders and 35", "81 riders and 35")  # 120 is 81 once and 120 once
    filler = prose(50, 200)
    rows = [*ODD, (101, filler + " " + ITEM + " " + filler), (102, filler + " " + other.upper().lower().replace("oslo", "Oslo").replace("bob", "Bob") + " more"), (103, filler + " " + mixed), (104, filler),
            (105, "Short item, here"), (106, prose(77, 30)), (107, filler + " " + " ".join(ITEM.split()[:6]) + " " + filler), (101, filler + " " + ITEM + " " + filler)]
    got = {(r.doc_id, r.item_id): r for r in contaminated(frame(spark, rows), items).collect()}
    assert set(got) == {(101, 1), (102, 1), (105, 2), (106, 5), (103, 1)}
    assert got[101, 1].verbatim and not got[102, 1].verbatim and got[106, 5].verbatim
    assert 0 < got[103, 1].windows < got[101, 1].windows == got[102, 1].windows and not got[103, 1].verbatim
    assert contaminated(frame(spark, []).limit(0), items).count() == 0 and contaminated(frame(spark, rows), items.limit(0)).count() == 0
    some = {(r.doc_id, r.item_id) for r in contaminated(frame(spark, rows), items, block=4).collect()}
    assert some == set(got)


def plain_lines(rows):
    sites, first = collections.defaultdict(set), {}
    for d, t, _, s in rows:
        for i, line in enumerate((t or "").split("\n")):
            if line.strip(" "):
                sites[line.strip(" ")].add(s)
                at = (d is not None, d, i)
                first[line.strip(" ")] = min(first.get(line.strip(" "), at), at)
    out = []
    for d, t, _, s in rows:
        if t is None:
            out.append(str((d, None, 0, 0)))
            continue
        gone = {i for i, x in enumerate(t.split("\n")) if len(sites[x.strip(" ")] - {None}) >= MIN_SITES and first.get(x.strip(" ")) != (d is not None, d, i) and x.strip(" ")}
        out.append(str((d, "\n".join(x for i, x in enumerate(t.split("\n")) if i not in gone), sum(bool(x.strip(" ")) for x in t.split("\n")), len(gone))))
    return sorted(out)


def test_line_dedup(spark):
    rows = [(d, t, "en", "s0") for d, t in ODD]
    rows += [(100 + i, f"own line {i}\nseen by many\n  seen by some \n\nonly " + "x" * i + "\nseen by many", "en", f"s{i % (MIN_SITES + 3)}") for i in range(30)]
    rows += [(200 + i, "few sites\nnever a site", "en", f"s{i % (MIN_SITES - 1)}" if i % 2 else None) for i in range(30)]
    rows += [(300, "\n".join("seen by many" if i % 2 else f"line {i}" for i in range(3000)), "en", "s1"), (300, "\n".join("seen by many" if i % 2 else f"line {i}" for i in range(3000)), "en", "s1")]
    got = remove_shared_lines(frame(spark, rows))
    assert "_key" in got.columns and got.select("word").distinct().count() == 1
    assert sorted(str((r.doc_id, r.text, r.n_lines, r.n_removed)) for r in got.collect()) == plain_lines(rows)
    assert remove_shared_lines(frame(spark, []).limit(0)).count() == 0


def test_line_dedup_sql_runs_alike(spark):
    rows = [(i, f"own {i}\nfoot\n{'tail' if i % 3 else 'head'}", "en", f"s{i % 7}") for i in range(40)] + [(90, None, "en", "s1"), (91, "", "en", "s1")]
    docs = frame(spark, rows)
    con = duckdb.connect()
    con.register("documents", docs.select("doc_id", "text", "source").toPandas())
    want = {r[0]: r[1:] for r in con.execute(remove_shared_lines_sql()).fetchall()}
    for r in remove_shared_lines(docs).collect():
        assert want[r.doc_id] == (r.n_lines, r.n_removed, None if r.text is None else hashlib.md5(r.text.encode()).hexdigest())


def test_pipeline_stages(spark, tmp_path):
    for lang in ("en", "de"):
        assert prose(1, 30, lang)
    rows = [(i, prose(i, 200, "en" if i % 2 else "de"), "en" if i % 2 else "de", f"s{i % 9}") for i in range(40)]
    rows += [(50, rows[3][1] + " end", "en", "s1"), (51, rows[3][1], "en", "s2"), (52, None, "en", "s1"), (53, "12 34", "en", "s1"), (54, rows[5][1] + " " + ITEM + " " + rows[7][1], "en", "s3")]
    rows += [(60 + i, prose(600 + i, 120) + "\nAll rights reserved by everyone.", "en", f"s{i % 9}") for i in range(20)]
    frame(spark, rows).select(*corpus_pipeline.COLUMNS).write.parquet(str(tmp_path / "documents.parquet"))
    spark.createDataFrame([(1, ITEM)], "item_id long, text string").write.parquet(str(tmp_path / "benchmark.parquet"))
    docs, left = spark.read.parquet(str(tmp_path / "documents.parquet")), {}
    for name, stage in corpus_pipeline.STAGES:
        docs = corpus_pipeline.saved(stage(spark, docs, str(tmp_path)), name)
        left[name] = {r.doc_id for r in docs.select("doc_id").collect()}
        if name != "packing":
            assert docs.columns == corpus_pipeline.COLUMNS
        if name == "line_dedup":
            assert docs.filter("text like '%All rights%'").count() == 1
    every = {r[0] for r in rows}
    assert left["language_id"] == left["line_dedup"] == every - {52, 53}
    assert left["simhash_dedup"] == every - {50, 51, 52, 53} and left["decontaminate"] == left["packing"] == every - {50, 51, 52, 53, 54}
    assert [r.doc_id for r in corpus_pipeline.run(spark, str(tmp_path)).select("doc_id").distinct().orderBy("doc_id").collect()] == sorted(left["packing"])


def test_pipeline_stages_on_an_empty_table_and_odd_rows(spark, tmp_path):
    spark.createDataFrame([(1, ITEM)], "item_id long, text string").write.parquet(str(tmp_path / "benchmark.parquet"))
    odd = [r for r in ODD if r[0] not in (None, 11)] + [(70 + i, prose(700 + i, 80)) for i in range(4)] + [(70, prose(700, 80))]
    for rows in ([], odd):
        docs = frame(spark, rows)
        for name, stage in corpus_pipeline.STAGES:
            got = stage(spark, docs, str(tmp_path))
            assert name == "packing" or got.columns == corpus_pipeline.COLUMNS
            docs = corpus_pipeline.saved(got, f"odd-{name}")
            assert rows or docs.count() == 0
    assert {70, 71, 72, 73} <= {r.doc_id for r in docs.collect()}


def test_pipeline_decontaminates_long_texts_of_many_hits(spark, tmp_path):
    item = "they all went up the old hill in the rain before the sun came out"
    spark.createDataFrame([(1, item)], "item_id long, text string").write.parquet(str(tmp_path / "benchmark.parquet"))
    rows = [(1, f"{item} and " * 2000), (2, f"{prose(80, 20_000)} {item} {prose(81, 9000)}"), (3, prose(82, 40_000)), (4, None), (5, f"{item} and " * 2000)]
    left = corpus_pipeline.decontaminate(spark, frame(spark, rows), str(tmp_path))
    assert left.columns == corpus_pipeline.COLUMNS and sorted((r.doc_id, r.text) for r in left.collect()) == [(3, rows[2][1]), (4, None)]


def test_repetitive_items_and_texts(spark):
    items = [(1, "la " * 12), (2, prose(61, 40))]
    docs = [(10, "la " * 3000), (11, "la la la"), (12, prose(62, 200))]
    assert set(found(spark, docs, items)) <= {(10, 1)}
    assert found(spark, [], items) == {} and found(spark, docs, []) == {}


def test_simhash_dedup_keeps_one_row_of_repeated_ids(spark):
    a, b, c, d = (prose(i, 200) for i in (71, 72, 73, 74))
    rows = [(1, a), (2, a + " end"), (2, b), (3, c), (3, c), (3, c + " end"), (4, d), (None, a)]
    got = sorted((r.doc_id or 0, r.text) for r in corpus_pipeline.simhash_dedup(spark, frame(spark, rows), "").collect())
    texts = [t for i, t in got if i == 3]
    assert len(texts) == 1 and texts[0].startswith(c)
    assert [x for x in got if x[0] != 3] == sorted([(0, a), (1, a), (2, b), (4, d)])


@pytest.mark.parametrize("n", range(1, 14))
def test_every_operator_is_registered(n):
    import __spark_entry__ as entry

    assert sum(q.startswith(f"op{n}_") for q in entry.queries()) == 1 and "pipeline" in entry.queries()


def found(spark, docs, items, **how):
    got = contaminated(frame(spark, docs), spark.createDataFrame(items, "item_id long, text string"), **how).collect()
    return {(r.doc_id, r.item_id): r for r in got}


def test_decontamination_finds_short_and_dense_items(spark):
    a, b = prose(50, 60), prose(51, 60)
    items = [(1, "What is 12 + 7 * 3 - 4?"), (2, "What is the capital of France?"), (3, "Add 1 2 3 4 5 6 7 8 9 10 11 and 12"), (4, "Take 4 of 9, 3 of 8, 2 of 7 and 1 of 6")]
    docs = [(10 * i, f"{a} {t} {b}") for i, t in items] + [(11, f"{a} What is 12 + 7 * 3 - 5? {b}"), (21, f"{a} what is the CAPITAL of all {b}"), (31, f"{a} Add 2 2 4 4 6 6 8 8 9 11 11 and 13 {b}"), (32, "1 2 3 4 5 6 7 8 " + a)]
    assert set(found(spark, docs, items)) == {(10, 1), (20, 2), (30, 3), (40, 4)}


def test_decontamination_finds_renamed_sentence_starts(spark):
    items = [(1, "Alice has 3 red apples. Bob has 5 green pears. Carol eats 2 plums."), (2, "Then the \"Anna\" sails home with wind from the north and all hands on deck")]
    docs = [(10, prose(50, 60) + ' "Dave has 7 red apples.\nErin has 9 green pears.\n(Frank eats 4 plums.'), (20, "so then the Berta sails home with wind from the north and all hands on deck"),
            (30, "Dave has 7 red apples. Erin has 9 green pears"), (40, items[0][1].lower())]
    got = found(spark, docs, items)
    assert set(got) == {(10, 1), (20, 2), (40, 1)} and got[40, 1].verbatim and not got[10, 1].verbatim


def test_decontamination_counts_within_a_passage(spark):
    phrase, a = "one two three four five six seven eight", prose(50, 300)
    item = f"{prose(60, 12)} {phrase} {prose(61, 12)} {phrase} {prose(62, 12)} {phrase} {prose(63, 12)} {phrase} {prose(64, 12)}"
    slots = "there were 120 men on the old ship and they all saw the 120 birds"
    docs = [(1, f"{a} {phrase} {a}"), (2, f"{a} {item} {a}"), (3, f"{a} {slots.replace('120', '7')} {a}"), (4, f"{a} there were 81 men on the old ship and they {a} old ship and they all saw the 99 birds {a}"),
            (5, f"{a} {item.replace('one two', 'one or two')} {a}")]
    assert set(found(spark, docs, [(1, item), (2, slots)])) == {(2, 1), (3, 2), (5, 1)}


def test_decontamination_hashes_windows_in_compiled_code(spark):
    texts = [None, "", "?!", "one", "Two words", "The old Anna met Bob. Then 12 kg of 7 plums, and İstanbul. Her İda ate ½ of it", prose(50, 40), "So Carol ran. " * 9]
    docs, forms = frame(spark, list(enumerate(texts))).select("doc_id", "text"), [(2, True), (3, False), (8, False), (8, True)]
    cut = windows(docs, forms)
    plan = cut._jdf.queryExecution().executedPlan().toString()
    assert plan.count("lambdafunction(xxhash64(") == 3 and "transform(sequence(" not in plan  # only each word's hash is left in a lambda, once a reading

    split = docs.select("doc_id", template(F.col("text")).alias("t")).select("doc_id", "t.*", *[_hashed(F.col(c), c == "values").alias(f"h_{c}") for c in ("words", "names", "values")],
                                                                             _hashed(F.col("words"), True).alias("plain"))
    want = collections.Counter()
    for r in split.collect():
        for w, verbatim in forms:
            for h in ([r.h_values or r.plain] if verbatim else [r.h_words, r.h_names]):
                want.update((r.doc_id, i, tuple(h[i:i + w])) for i in range(len(h or []) - w + 1))
    keys = list(want)
    hashes = spark.createDataFrame([(k, list(ws)) for k, (_, _, ws) in enumerate(keys)], "k long, ws array<long>").select("k", F.xxhash64("ws").alias("hash")).collect()
    by_key = {r.k: r.hash for r in hashes}
    assert collections.Counter((r.doc_id, r.pos, r.hash) for r in cut.collect() if r.hash is not None) == collections.Counter({(d, i, by_key[k]): want[d, i, ws] for k, (d, i, ws) in enumerate(keys)})


def test_decontamination_hits_hold_their_windows_not_their_document(spark):
    item = "they all went up the old hill in the rain before the sun came out"
    docs = [(1, f"{item} and " * 2000), (2, prose(50, 300)), (3, item)]  # 16,000 hits in a text of 32,000 words: with all its words each, some 12 GB at once
    got = found(spark, docs, [(7, item)])
    assert {k: (r.windows, r.verbatim) for k, r in got.items()} == {(1, 7): (8, True), (3, 7): (8, True)}
    plan = contaminated(frame(spark, docs), spark.createDataFrame([(7, item)], "item_id long, text string"))._jdf.queryExecution().executedPlan().toString()
    assert "transform(sequence(" not in plan  # a lambda over the document's words ends the compiled join, which then hands them out


def test_decontamination_sends_only_hashes_of_large_benchmarks(spark):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        items = spark.createDataFrame([(i, f"the same prompt stands before each of all these items {prose(i, 9)}") for i in range(9)], "item_id long, text string")
        docs = frame(spark, [(1, "now " + items.first()["text"])])
        large, small = (contaminated(docs, items, block=b) for b in (50, 1000))
        assert "SortMergeJoin" in large._jdf.queryExecution().sparkPlan().toString() and sorted(large.collect()) == sorted(small.collect())
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
