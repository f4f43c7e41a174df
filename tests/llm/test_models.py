"""Language, quality and language model: held-out accuracy and plain counts."""

import collections
import math
import re
from pathlib import Path

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from tidepanel.llm import language_model as lm
from tidepanel.llm.common import ARROW_BYTES, fold, map_arrow, releasing
from tidepanel.llm.language import EVIDENCE, WIDTH, Decoder, codewords, has_letter, predict, train
from tidepanel.llm.quality import Forest, quality_scores

from .helpers import ODD, frame, prose


def test_codewords_keep_apart():
    for n in (1, 2, 3, 4, 5, 12, 40):
        code = codewords(n).astype(int)
        far = [(code[i] != code[j]).sum() for i in range(n) for j in range(i)]
        assert len(code) == n and (not far or min(far) >= max(1, code.shape[1] // 4))


def test_decoding_against_a_plain_one():
    rng = np.random.default_rng(2)
    for n in (1, 2, 4, 7):
        counts = rng.integers(0, 50, (n, WIDTH))
        model = Decoder([f"l{i}" for i in range(n)], counts)
        for text in (b"the cat", "é ü 漢".encode(), prose(n, 200).encode(), b" x"):
            folded = [32] + [b + 32 if 65 <= b <= 90 else b if 97 <= b <= 122 or b >= 128 else 32 for b in text] + [32]
            grams = [(x << 16 | y << 8 | z) * 2654435761 % 2 ** 32 >> 18 for x, y, z in zip(folded, folded[1:], folded[2:]) if not (y == 32 and 32 in (x, z))]
            sums = [sum(row) + WIDTH / 2 for row in counts.tolist()]
            share = [[(c + 0.5) / total for c in row] for row, total in zip(counts.tolist(), sums)]
            loss = [0.0] * n
            for bit in model.code.T.tolist():
                sides = [[i for i in range(n) if bit[i] == side] for side in (1, -1)]
                odds = sum(math.log(sum(share[i][g] for i in sides[0]) / len(sides[0]) / (sum(share[i][g] for i in sides[1]) / len(sides[1]))) for g in grams) if all(sides) else 0.0
                odds *= EVIDENCE / (len(grams) + EVIDENCE)
                for i in range(n):
                    loss[i] += math.log1p(math.exp(-bit[i] * odds))
            near = [math.exp(min(loss) - x) for x in loss]
            lang, score = model.decide(text)
            assert lang == f"l{loss.index(min(loss))}" and score == pytest.approx(max(near) / sum(near), abs=1e-3)


def test_letters_are_of_category_l():
    assert not any(has_letter(t.encode()) for t in ("½ ② 5", "12 _", "", "\u0301", "!")) and all(has_letter(t.encode()) for t in ("½a", "漢", "ª", "É"))


def test_language_says_und_without_letters_and_takes_clashing_names(spark):
    rows = [(1, "½ ② 5", "en"), (2, prose(1, 40), "en"), (3, prose(2, 40, "de"), "de"), (3, prose(2, 40, "de"), "de")]
    docs = frame(spark, rows).withColumn("lang_pred", F.lit("x")).withColumn("ambiguous", F.lit(True))
    got = predict(docs, train(docs, F.col("doc_id") > 1), ["doc_id", "lang_pred", "score", "ambiguous", "key"])
    assert got.columns == ["doc_id", "key", "lang_pred", "score", "ambiguous"]
    assert sorted((r.doc_id, r.lang_pred) for r in got.collect()) == [(1, "und"), (2, "en"), (3, "de"), (3, "de")]


def test_language_held_out_accuracy_and_odd_texts(spark):
    rows = [(1000 + i, prose(i, 40, lang), lang) for i in range(120) for lang in ("en", "de", "fr")] + [(9000, prose(3, 40), None)]
    docs = frame(spark, [*rows, *[(d, t, None) for d, t in ODD]]).withColumn("held_out", fold("doc_id", 4) == 2)
    got = predict(docs, train(docs, ~F.col("held_out")), ["doc_id", "held_out", "lang"]).collect()
    assert len(got) == len(rows) + len(ODD)
    told = [r for r in got if r.lang and r.held_out]
    assert len(told) > 40 and sum(r.lang == r.lang_pred for r in told) >= 0.97 * len(told)
    by = {r.doc_id: r for r in got}
    for d in (1, 2, 3, 8):
        assert (by[d].lang_pred, by[d].score, by[d].ambiguous) == ("und", 0.0, False)
    assert all(0 <= r.score <= 1 and r.lang_pred in ("en", "de", "fr", "und") for r in got)


def test_language_without_training_rows_or_rows(spark):
    docs = frame(spark, [(1, "hello there", None)])
    assert [r.lang_pred for r in predict(docs, train(docs, F.lit(True)), ["doc_id"]).collect()] == ["und"]
    assert predict(docs.limit(0), None, ["doc_id"]).count() == 0


def test_language_keeps_a_text_it_is_sent_once(spark):
    docs = frame(spark, [(1, prose(1, 40), "en"), (2, prose(2, 40, "de"), "de"), *ODD])
    model = train(docs, F.col("doc_id") < 3)
    whole = predict(docs, model, ["doc_id", "text", "lang"])
    assert whole.columns == ["doc_id", "text", "lang", "lang_pred", "score", "ambiguous"]
    assert whole._jdf.queryExecution().optimizedPlan().toString().count("cast(text") == 0
    assert sorted(map(repr, whole.select("doc_id", "text").collect())) == sorted(map(repr, docs.select("doc_id", "text").collect()))
    assert sorted(map(repr, whole.drop("text").collect())) == sorted(map(repr, predict(docs, model, ["doc_id", "lang"]).collect()))
    raw = docs.withColumn("text", F.col("text").cast("binary"))
    assert sorted(map(repr, predict(raw, model, ["doc_id", "text", "lang"]).drop("text").collect())) == sorted(map(repr, whole.drop("text").collect()))


def test_batches_are_bounded_by_bytes_unless_the_session_says_otherwise(spark):
    def sizes(batches):
        for batch in batches:
            yield pa.RecordBatch.from_arrays([pa.array([batch.num_rows]), pa.array([batch.nbytes])], names=["n", "size"])

    def most():
        got = map_arrow(docs, sizes, "n long, size long").collect()
        assert sum(r.n for r in got) == 2000
        return max(r.size for r in got)

    docs, before = spark.range(0, 2000, 1, 1).select(F.expr("repeat('x', 10000)").alias("text")), spark.conf.get(ARROW_BYTES, None)
    try:
        spark.conf.unset(ARROW_BYTES)
        assert most() < 5 << 20
        spark.conf.set(ARROW_BYTES, "32m")
        assert most() > 16 << 20
    finally:
        spark.conf.unset(ARROW_BYTES) if before is None else spark.conf.set(ARROW_BYTES, before)


def test_trees_learn_an_interaction():
    x = np.random.default_rng(0).random((3000, 4))
    y = ((x[:, 0] > 0.5) ^ (x[:, 2] > 0.3)).astype(float)
    forest = Forest(trees=40, depth=3).fit(x[:2000], y[:2000])
    assert ((forest.score(x[2000:]) > 0.5) == y[2000:]).mean() > 0.95


def test_flat_traversal_against_a_recursive_walk():
    rng = np.random.default_rng(8)
    x = np.round(rng.random((500, 5)), 1)  # ties with the splits
    forest = Forest(trees=12, depth=4).fit(x, (x[:, 0] + x[:, 3] > 1).astype(float))

    def walk(t, row, level=0, at=0):
        if level == forest.depth:
            return forest.value[t, at]
        k = (1 << level) - 1 + at
        return walk(t, row, level + 1, 2 * at + int(row[forest.feature[t, k]] > forest.split[t, k]))

    want = [1 / (1 + math.exp(-(forest.start + sum(walk(t, row) for t in range(forest.trees))))) for row in x]
    assert np.allclose(forest.score(x), want, atol=1e-12) and len(set(np.round(want, 6))) > 20


def test_quality_held_out_and_odd_texts(spark):
    good = [(2000 + i, prose(i, 80)) for i in range(150)]
    bad = [(4000 + i, prose(i, 80).upper().replace(" ", "!! ")) for i in range(60)] + [(5000 + i, prose(i, 40).replace(" ", " | ")) for i in range(60)]
    docs = frame(spark, [*good, *bad, *ODD]).withColumn("held_out", fold("doc_id", 5) == 0)
    labels = spark.createDataFrame([(d, 1, 0) for d, _ in good] + [(d, 0, 0) for d, _ in bad] + [(None, 1, 0), (77, 1, 0), (good[0][0], 1, 1), (good[1][0], None, 0)], "doc_id long, quality int, toxic int")
    got = quality_scores(docs, labels, ~F.col("held_out"), keep=["doc_id", "held_out"]).collect()
    assert len(got) == len(good) + len(bad) + len(ODD) and all(0 <= r.score <= 1 and r.predicted == int(r.score >= 0.3) for r in got)
    held = [r for r in got if r.held_out and (r.doc_id or 0) >= 2000]
    assert len(held) > 30 and sum(r.predicted == int(r.doc_id < 4000) for r in held) >= 0.95 * len(held)
    clash = docs.withColumns({"_learn": F.lit(False), "stats": F.lit(1), "predicted": F.lit("x")})
    again = quality_scores(clash, labels, ~F.col("held_out"), keep=["doc_id", "_learn", "stats", "score", "predicted"])
    assert again.columns == ["doc_id", "_learn", "score", "predicted"] and sorted((str(r.doc_id), r.score) for r in again.collect()) == sorted((str(r.doc_id), r.score) for r in got)
    none = quality_scores(docs, labels.limit(0), ~F.col("held_out")).collect()
    assert {r.score for r in none} == {0.5}
    assert quality_scores(docs.limit(0), labels, F.lit(True)).count() == 0


def tokens(text):
    return re.findall(rb"[^\x20\x09-\x0d]+", re.sub(rb"[A-Z]", lambda m: m.group().lower(), (text or "").encode())) + ["end"]


@pytest.mark.parametrize("learn", ["some", "none"])
def test_language_model_against_plain_counts(spark, learn):
    rows = [*[r for r in ODD if r[0] != 11], *[(100 + i, prose(i, 60)) for i in range(80)], (11, prose(1, 3000)), (12, "the " * 4000)]
    docs = frame(spark, rows)
    held = (F.pmod("doc_id", F.lit(7)) == 2) if learn == "some" else F.lit(True)
    is_held = (lambda d: d is not None and d % 7 == 2) if learn == "some" else (lambda d: True)
    one, two, context = collections.Counter(), collections.Counter(), collections.Counter()
    for d, t in rows:
        if not is_held(d):
            w = tokens(t)
            one.update(w)
            two.update(zip(["start", *w], w))
            context.update(["start", *w[:-1]])
    after = collections.Counter(a for a, _ in two)
    n, v = sum(one.values()), len(one)
    want = []
    for d, t in rows:
        w, score = tokens(t), 0.0
        for a, b in zip(["start", *w], w):
            if two[a, b]:
                score += math.log10((two[a, b] - 0.75) / context[a])
            else:
                score += math.log10((one[b] + 1) / (n + v + 1)) + (math.log10(0.75 * after[a] / context[a]) if context[a] else 0)
        want.append((str(d), is_held(d), len(w), sum(one[x] > 0 for x in w), n, round(sum(math.log10((one[x] + 1) / (n + v + 1)) for x in w), 6), round(score, 6)))
    got = [(str(r.doc_id), r.held_out, r.n_tokens, r.n_known, r.train_tokens, round(r.base_score, 6), round(r.score, 6)) for r in lm.score_texts(docs, held).collect()]
    assert sorted(got) == sorted(want)


def test_language_model_deals_start_marks_and_words_of_few_documents(spark, monkeypatch):
    monkeypatch.setattr(lm, "COUNTED", 60)
    rows = [(i, ["yes", "no", "a b", f"w{i}"][i % 4]) for i in range(6000)] + [(7000, "long " * 9000 + prose(1, 200))]
    docs, held = frame(spark, rows), F.pmod("doc_id", F.lit(7)) == 2
    hot = lm.frequent_contexts(docs.select(F.col("text").cast("binary").alias("text")), 8).tolist()
    assert sorted(hot) == sorted([lm._mark(b"start"), lm._hashes[b"long"]])
    key = lambda r: (r.doc_id, r.held_out, r.n_tokens, r.n_known, r.train_tokens, round(r.base_score, 6), round(r.score, 6))
    got = sorted(map(key, lm.score_texts(docs, held).collect()))
    monkeypatch.setattr(lm, "frequent_contexts", lambda texts, parts: np.zeros(0, np.uint64))
    assert got == sorted(map(key, lm.score_texts(docs, held).collect()))


def test_language_model_of_nothing(spark):
    assert lm.score_texts(frame(spark, []).limit(0), F.lit(False)).count() == 0


def test_rising_sequence_and_successors():
    rng = np.random.default_rng(1)
    for values in ([], [0], [5, 5, 5], np.sort(rng.integers(0, 1 << 50, 3000)), np.arange(1000), [1 << 60]):
        v = np.array(values, dtype=np.uint64)
        r = lm.Rising.of(v)
        assert (r.values() == v).all()
        wanted = np.sort(np.concatenate([v, v + np.uint64(1), rng.integers(0, 1 << 61, 50).astype(np.uint64)]))
        assert (r.successor(wanted) == np.searchsorted(v, wanted)).all()


def test_rising_values_and_bounded_search_against_plain_lists():
    rng = np.random.default_rng(6)
    for n, most in ((1, 1 << 55), (63, 10), (64, 500), (5000, 300), (5000, 1 << 50), (20_000, 20_100)):
        v = np.sort(rng.integers(0, most + 1, n).astype(np.uint64))
        r = lm.Rising.of(v)
        places = rng.integers(0, n, 500)
        assert (r.at(places) == v[places]).all() and (r.values() == v).all()
        first = rng.integers(0, n + 1, 500)
        last = np.minimum(n, first + rng.integers(0, 40, 500))
        wanted = np.where(rng.random(500) < 0.5, v[np.minimum(first, n - 1)] + rng.integers(0, 3, 500).astype(np.uint64), rng.integers(0, most + 2, 500).astype(np.uint64)).astype(np.uint64)
        want = [next((i for i in range(a, b) if v[i] >= w), b) for w, a, b in zip(wanted.tolist(), first.tolist(), last.tolist())]
        assert r.successor(wanted, first, last).tolist() == want


def test_workers_give_memory_back_between_batches(spark):
    def taken():
        return int(re.search(r"\nAnonymous:\s+(\d+)", Path("/proc/self/smaps_rollup").read_text())[1]) >> 10

    def run(batches):
        for batch in batches:
            seen.append(taken())
            held = [pa.array(np.arange(4000)).cast(pa.string()) for _ in range(1500)]
            del held  # some 45 MB, which the allocator keeps
            yield batch

    class Sent:
        sparkSession, mapInArrow = spark, staticmethod(lambda fn, schema: fn)

    batches, seen = [pa.RecordBatch.from_arrays([pa.array([i])], names=["a"]) for i in range(3)], []
    assert list(run(iter(batches))) == batches
    kept, seen = taken(), []
    assert list(map_arrow(Sent(), run, "a long")(iter(batches))) == batches
    assert max(seen[1:]) < kept - 20 and taken() < kept - 20
    assert list(releasing(run)(iter([]))) == []
