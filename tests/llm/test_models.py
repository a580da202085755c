import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from llm_helpers import by_id, make  # noqa: F401
from sqlmill.llm import langid, queries, toxicity

LARGER = "/root/testdata/sf0.01"


def test_forward_sums_all_segmentations():
    pieces = ["▁a", "▁ab", "a", "ab", "b", "▁"]
    model = langid.Model(["x", "y"], pieces, np.vstack([np.arange(1, 15).reshape(7, 2) / 60, [[0, 0]]]))

    def every(word, lang):
        if not word:
            return 1.0
        total = 0.0
        for k in range(1, len(word) + 1):
            p = pieces.index(word[:k]) if word[:k] in pieces else (6 if k == 1 else None)
            if p is not None:
                total += model.probability[p, lang] * every(word[k:], lang)
        return total

    for word in ("▁ab", "▁aab", "▁", "▁abzab"):
        assert np.allclose(np.exp(model.score([word])[0]), [every(word, 0), every(word, 1)])


def test_long_words_equal_the_plain_forward_sum(monkeypatch):
    pieces = ["▁a", "▁ab", "a", "ab", "abc", "b", "c", "▁"]
    rng = np.random.default_rng(1)
    model = langid.Model(["x", "y"], pieces, np.vstack([rng.random((9, 2)) / 3, [[0, 0]]]))
    word = "▁" + "".join(rng.choice(list("abcz"), 10_000))
    plain, scale = [np.ones(2)], np.zeros(2)  # the plain sum, kept in range
    for end in range(1, len(word) + 1):
        total = np.zeros(2)
        for m in range(1, min(3, end) + 1):
            p = pieces.index(word[end - m:end]) if word[end - m:end] in pieces else (8 if m == 1 else None)
            if p is not None:
                total += plain[-m] * model.probability[p]
        plain.append(total)
        scale += np.log(total)
        plain = [x / total for x in plain[-4:]]
    assert np.allclose(model.score([word])[0], scale + np.log(plain[-1]))
    # both ways agree on words of any length, in scoring and in the fit
    words = ["▁" + "".join(rng.choice(list("abcz"), n)) for n in (1, 5, 30, 60)]
    counts = {("x", w): k + 1 for k, w in enumerate(words)} | {("y", w): 9 - k for k, w in enumerate(words)}
    both = []
    for longest in (3, 200):
        monkeypatch.setattr(langid, "LONGEST", longest)
        both.append((model.score(words), langid.fit(counts, pieces).probability))
    assert np.allclose(both[0][0], both[1][0]) and np.allclose(both[0][1], both[1][1])


def test_number_signs_are_no_letters(make):
    docs = make([(i, "the cat and the dog " * 3, "en") for i in range(9)] + [(20 + i, "der Hund und die " * 3, "de") for i in range(9)])
    model = langid.train(docs, F.lit(True))
    out = by_id(langid.predict(make([(1, "½ ² ①"), (2, "Ⅷ"), (3, "½ the")]), model), "lang_pred", "score")
    assert out[1] == out[2] == ("und", 0.0) and out[3][0] == "en"


def test_language_of_held_out_documents(spark):
    docs = {r["doc_id"]: r for r in spark.read.parquet(f"{LARGER}/documents.parquet").collect()}
    rows = queries.op7_language_id(spark, LARGER).collect()
    assert len(rows) == len(docs)
    held = [r for r in rows if r["held_out"]]
    assert all(r["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % 3 == 1) for r in rows)
    assert np.mean([r["lang_pred"] == docs[r["doc_id"]]["lang"] for r in held]) > 0.97
    assert all(0 <= r["score"] <= 1 for r in rows)


def test_language_edge_cases(make):
    rows = [(i, "the cat and the dog are in the house " * 3, "en") for i in range(20)]
    rows += [(100 + i, "der Hund und die Katze sind im Haus " * 3, "de") for i in range(20)]
    docs = make(rows + [(200, None, "en"), (201, "", "de"), (202, "12 ?!", None), (203, "und die der im", None), (None, "the and", "en"),
                        (204, "z" * 200_000, None), (0, "the cat", "en")])
    model = langid.train(docs, F.lit(True))
    out = langid.predict(docs.withColumn("score", F.lit(1)), model).collect()
    assert len(out) == docs.count()
    got = {r["doc_id"]: r["lang_pred"] for r in out}
    assert got[200] == got[201] == got[202] == "und" and got[203] == "de" and got[None] == "en" and got[204] in ("en", "de")
    nothing = langid.train(docs.limit(0), F.lit(True))
    assert by_id(langid.predict(make([(1, "text")]), nothing), "lang_pred", "score") == {1: ("und", 0.0)}
    assert langid.predict(docs.limit(0), model).count() == 0


def test_kernel_equals_brute_force():
    def brute(u, v):
        def features(w):
            w, out = "<" + w + ">", []
            for i in range(len(w)):
                for a in range(1, toxicity.GAP + 1):
                    for b in range(1, toxicity.GAP + 1):
                        if i + a + b < len(w):
                            out.append(((w[i], w[i + a], w[i + a + b]), toxicity.DECAY ** (a + b - 2)))
            return out
        x, y = features(u), features(v)
        dot = sum(p * q for s, p in x for t, q in y if s == t)
        return dot / np.sqrt(sum(p * p for _, p in x) * sum(q * q for _, q in y))

    columns = np.zeros((toxicity.SHAPES, 1))
    for _, shape, decay in toxicity.subsequences(["idiot"]):
        np.add.at(columns[:, 0], shape, decay)
    columns /= np.sqrt(sum(d * d * len(s) for _, s, d in toxicity.subsequences(["idiot"])))
    for u in ("idiot", "idxiot", "idot", "banana", "a"):
        assert toxicity.folded([u], columns)[0, 0] == pytest.approx(brute(u, "idiot"))


def toxic_rows():
    rng = np.random.default_rng(3)
    words = ["".join(rng.choice(list("aeionrstlm"), rng.integers(2, 8))) for _ in range(400)]
    insults = ["worthless", "idiot", "pathetic"]
    rows, labels = [], []
    for i in range(400):
        text = [str(w) for w in rng.choice(words, 40)]
        if i % 4 == 0:
            for w in rng.choice(insults, 2, replace=False):
                text.insert(int(rng.integers(40)), str(w))
        rows.append((i, " ".join(text) + "."))
        labels.append((i, int(i % 4 == 0)))
    return rows, labels


def test_toxicity_learns_insults_and_their_variants(make, spark):
    rows, labels = toxic_rows()
    marks = spark.createDataFrame(labels + [(None, 1), (5000, None)], "doc_id long, toxic int")
    model = toxicity.train(make(rows), marks, toxicity.teaches())
    found = toxicity.score(make(rows), model).withColumn("held", toxicity.held_out()).filter("held").collect()
    truth = dict(labels)
    assert np.mean([(r["score"] >= 0.3) == bool(truth[r["doc_id"]]) for r in found]) > 0.95
    plain = "rare name mile to tame rain "
    clean, bad, gapped, spelled, inserted = model.score([plain, plain + "idiot", plain + "i.d-i.o.t", plain + "i d i o t so", plain + "idi9ot"])
    assert clean < 0.3 <= min(bad, gapped, spelled) and inserted > clean


def test_toxicity_edge_cases(make, spark):
    rows, labels = toxic_rows()
    marks = spark.createDataFrame(labels, "doc_id long, toxic int")
    model = toxicity.train(make(rows), marks, F.lit(True))
    odd = make([(1, None), (2, ""), (None, "idiot worthless"), (3, "a " * 200_000), (3, "x" * 100_000), (4, "?!")])
    out = toxicity.score(odd, model).collect()
    assert len(out) == 6 and all(0 <= r["score"] <= 1 for r in out)
    kept = toxicity.keep_clean(odd.withColumn("score", F.lit("mine")), model)
    assert kept.columns == odd.columns + ["score"] and kept.filter("doc_id is null").count() == 0 and kept.count() == 5
    one_label = toxicity.train(make(rows), marks.filter("toxic = 0"), F.lit(True))
    assert {r["score"] for r in toxicity.score(odd, one_label).collect()} == {0.0}
    assert toxicity.score(odd.limit(0), model).count() == 0


def test_held_out_toxicity_of_the_table(spark):
    rows = queries.op4_toxicity(spark, LARGER).collect()
    truth = {r["doc_id"]: r["toxic"] for r in spark.read.parquet(f"{LARGER}/labels.parquet").collect()}
    held = [(r["score"], truth[r["doc_id"]]) for r in rows if r["held_out"] and r["doc_id"] in truth]
    assert len(rows) == 1000 and all(r["predicted"] == int(r["score"] >= 0.3) for r in rows)
    bad, good = [s for s, y in held if y], [s for s, y in held if not y]
    assert np.mean([a > b for a in bad for b in good]) > 0.75  # some labels are wrong on purpose
    assert sum(s >= 0.3 for s in good) <= 0.03 * len(good)
