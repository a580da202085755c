import hashlib
import itertools
import zlib
from collections import Counter
from fractions import Fraction

import numpy as np
import pytest
from pyspark.sql import functions as F

from llm_helpers import by_id, make  # noqa: F401
from sqlmill.llm import audit, merkle, quality, queries

LARGER = "/root/testdata/sf0.01"


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


def brute_manifest(rows):
    """(leaf, subroot, root, siblings in order) per row of (doc_id, text, lang), as a list in the rows' order."""
    def piece(v):
        return "-" if v is None else f"{len(str(v).encode())}:{v}"

    def climb(nodes):
        """Root of the nodes and each node's siblings, level by level."""
        paths, place, level = [[] for _ in nodes], list(range(len(nodes))), list(nodes)
        while len(level) > 1:
            for i, p in enumerate(place):
                run = range(p // 8 * 8, min(p // 8 * 8 + 8, len(level)))
                paths[i].append((level[run[0]:p], level[p + 1:run[-1] + 1]))
            level = [sha("".join(level[k:k + 8])) for k in range(0, len(level), 8)]
            place = [p // 8 for p in place]
        return level[0], paths

    leaves = [sha(piece(i) + piece("s") + piece(lang) + piece(len(t) if t is not None else None) + piece(t)) for i, t, lang in rows]
    groups = {}
    for k, (i, _, lang) in enumerate(rows):
        groups.setdefault(lang, []).append(k)
    order = sorted(groups, key=lambda g: (g is not None, (g or "").encode()))
    climbed = {}
    for g in order:
        groups[g].sort(key=lambda k: (rows[k][0] is not None, rows[k][0] or 0, leaves[k]))
        climbed[g] = climb([leaves[k] for k in groups[g]])
    root, tops = climb([climbed[g][0] for g in order])
    out = {}
    for g, top in zip(order, tops):
        for k, path in zip(groups[g], climbed[g][1]):
            out[k] = (leaves[k], climbed[g][0], root, path + top)
    return [out[k] for k in range(len(rows))]


def check_manifest(docs, rows):
    got = Counter((r["doc_id"], r["leaf"], r["subroot"], r["root"], "".join(s["left"] + s["right"] for s in r["proof"]))
                  for r in merkle.manifest(docs, ["doc_id", "source", "lang", "n_chars", "text"]).collect())
    want = Counter((row[0], leaf, sub, root, "".join("".join(a) + "".join(b) for a, b in path))
                   for row, (leaf, sub, root, path) in zip(rows, brute_manifest(rows)))
    assert got == want


@pytest.mark.parametrize("depth", [1, 2, 4])
def test_manifest_equals_brute_force(make, monkeypatch, depth):
    monkeypatch.setattr(merkle, "DEPTH", depth)  # small blocks: several rounds of blocks above blocks
    rows = [(i, f"Text {i}", "en") for i in range(150)] + [(i, None if i % 3 else "", "de") for i in range(200, 265)]
    rows += [(300 + i, "é" * i, None) for i in range(8)] + [(400, "x" * 200_000, "fr"), (None, "n", "en"), (None, None, "en"), (7, "Text 7", "en")]
    rows += [(500 + i, "l", f"lang{i}") for i in range(12)]
    check_manifest(make(rows).repartition(5).withColumn("leaf", F.lit(1)).withColumn("rank", F.lit(2)), rows)


def test_manifest_of_few_rows(make):
    check_manifest(make([(1, "a", None)]), [(1, "a", None)])
    check_manifest(make([(1, "a"), (2, "b")]), [(1, "a", "en"), (2, "b", "en")])
    assert merkle.manifest(make([(1, "a")]).limit(0), ["doc_id"]).count() == 0


def test_proofs_tell_tampered_rows(spark):
    docs = {r["doc_id"]: r["text"] for r in spark.read.parquet(f"{LARGER}/documents.parquet").collect()}
    rows = queries.op11_merkle_manifest(spark, LARGER).collect()
    assert len(rows) == len(docs)
    for r in rows:
        changed = zlib.crc32(str(r["doc_id"]).encode()) % 3 == 0 and any("A" <= c <= "Z" for c in docs[r["doc_id"]])
        assert r["verified"] == (not changed) and (r["folded_root"] == r["root"]) == r["verified"]


def quality_rows(n=400):
    rng = np.random.default_rng(5)
    words = ["".join(rng.choice(list("aeionrstlm"), rng.integers(2, 8))) for _ in range(300)]
    rows, labels = [], []
    for i in range(n):
        text = " ".join(rng.choice(words, int(rng.integers(30, 90))))
        bad = i % 4 == 0
        rows.append((i, " | ".join(text.upper().split()) + "!!" if bad else text + "."))
        labels.append((i, int(not bad)))
    return rows, labels


def test_quality_learns_from_compressed_sizes(make, spark):
    rows, labels = quality_rows()
    marks = spark.createDataFrame(labels + [(None, 1), (5000, None)], "doc_id long, quality int")
    model = quality.train(make(rows), marks, ~quality.held_out())
    again = quality.train(make(rows).repartition(7), marks, ~quality.held_out())
    assert (model.good, model.bad, model.slope) == (again.good, again.bad, again.slope)
    found = quality.score(make(rows), model).withColumn("held", quality.held_out()).filter("held").collect()
    truth = dict(labels)
    assert np.mean([(r["score"] >= 0.7) == bool(truth[r["doc_id"]]) for r in found]) > 0.95
    # the middle of a long text counts as its start does
    good, bad = rows[1][1] + " ", rows[4][1] + " "
    a, b, c = model.score([good * 400, good * 200 + bad * 400 + good * 200, bad * 400])
    assert a > b > c


def test_quality_edge_cases(make, spark):
    rows, labels = quality_rows(200)
    marks = spark.createDataFrame(labels, "doc_id long, quality int")
    model = quality.train(make(rows), marks, F.lit(True))
    odd = make([(1, None), (2, ""), (None, "text"), (3, "a " * 300_000), (4, "?!"), (4, "?!")]).withColumn("score", F.lit("mine"))
    out = quality.score(odd, model).collect()
    assert len(out) == 6 and all(0 <= r["score"] <= 1 for r in out)
    assert len({r["score"] for r in out if r["doc_id"] in (1, 2)}) == 1
    for filtered, share in (("quality = 1", 1.0), ("quality is null", 0.0)):
        flat = quality.train(make(rows), marks.filter(filtered), F.lit(True))
        assert {r["score"] for r in quality.score(odd, flat).collect()} == {share}
    assert quality.train(make(rows).limit(0), marks, F.lit(True)).good is None
    few = quality.train(make(rows[:6]), marks, F.lit(True))  # too little text for dictionaries
    assert all(0 <= r["score"] <= 1 for r in quality.score(odd, few).collect())
    assert quality.score(odd.limit(0), model).count() == 0


def test_held_out_quality_of_the_table(spark):
    rows = queries.op12_quality(spark, LARGER).collect()
    truth = {r["doc_id"]: r["quality"] for r in spark.read.parquet(f"{LARGER}/labels.parquet").collect()}
    held = [(r["score"], truth[r["doc_id"]]) for r in rows if r["held_out"] and r["doc_id"] in truth]
    assert len(rows) == 1000 and all(r["predicted"] == int(r["score"] >= 0.7) for r in rows)
    good, bad = [s for s, y in held if y], [s for s, y in held if not y]
    assert np.mean([a > b for a in good for b in bad]) > 0.95
    assert sum(s >= 0.7 for s in good) >= 0.95 * len(good)


def test_shapley_values_equal_the_mean_over_orders():
    rng = np.random.default_rng(1)
    for n in (1, 2, 3, 5):
        value = [0] + [int(x) for x in rng.integers(0, 1000, 2 ** n - 1)]
        solved = [sum(w * v for w, v in zip(row, value)) for row in audit.shapley_solution(n)]
        orders = list(itertools.permutations(range(n)))
        for i in range(n):
            total = 0
            for order in orders:
                before = sum(1 << j for j in order[:order.index(i)])
                total += value[before | 1 << i] - value[before]
            assert solved[i] == Fraction(total, len(orders))


def brute_audit(docs, labels):
    marks = {}
    for i, q, t in labels:
        g, x = marks.get(i, (False, False))
        marks[i] = (g or q == 1, x or t == 1)
    least = {}
    for i, t, _ in docs:
        if i is not None:
            least[t or ""] = min(i, least.get(t or "", i))
    parts = {}
    for i, text, lang in docs:
        t = text or ""
        words = [w for w in __import__("re").split("[\x20\x09-\x0d]+", t) if w]
        fails = {c for c, f in zip("ABCDE", (
            len(words) < 100, 100 * len(set(words)) < 80 * len(words), 100 * sum("A" <= c <= "Z" for c in t) > 10 * len(t),
            any(c in "#$%&*|" for c in t), i is not None and i > least[t])) if f}
        parts.setdefault(lang or "", []).append((fails, *(marks.get(i, (False, False)) if i is not None else (False, False))))
    out, sums = {}, Counter()
    for part, rows in parts.items():
        for order in itertools.permutations("ABCDE"):
            left = rows
            for step, f in enumerate(order, 1):
                gone = [r for r in left if f in r[0]]
                left = [r for r in left if f not in r[0]]
                out[part, "".join(order), step] = [len(left), len(gone), sum(f in r[0] for r in rows) - len(gone),
                                                   sum(r[0] == {f} for r in rows), sum(r[1] for r in gone), sum(r[2] for r in gone)]
                sums[part, f] += len(gone)
    return {k: (*v, sums[k[0], k[1][k[2] - 1]]) for k, v in out.items()}


def test_audit_equals_brute_force(make, spark):
    rng = np.random.default_rng(2)
    texts = [None, "", "word " * 120, "a b c", "A B C # x", " ".join(f"w{i}" for i in range(150)), " ".join(f"W{i}" for i in range(150)) + " %",
             "x" * 200_000, "\t\n ", " ".join(f"é{i % 90}" for i in range(110)), "one two three"]
    docs = [(int(rng.integers(0, 60)), texts[int(rng.integers(len(texts)))], [None, "", "en", "de"][int(rng.integers(4))]) for _ in range(150)]
    docs += [(None, "a b c", "en"), (None, None, None)]
    labels = [(int(rng.integers(0, 70)), int(rng.integers(2)), int(rng.integers(2))) for _ in range(60)] + [(None, 1, 1), (3, None, None)]
    marks = spark.createDataFrame(labels, "doc_id long, quality int, toxic int")
    frame = make(docs).withColumn("part", F.lit("mine")).withColumn("fails", F.lit(3)).withColumn("id", F.lit(1))
    out = audit.report(audit.coalitions(audit.failures(frame, marks), 5), audit.NAMES).collect()
    got = {(r["part"], r["filter_order"], r["step"]): (r["kept"], r["removed"], r["redundant"], r["unique_fails"], r["good_lost"],
                                                       r["toxic_lost"], r["shapley"]) for r in out}
    assert len(out) == len(got) and got == brute_audit(docs, labels)
    assert audit.report(audit.coalitions(audit.failures(frame.limit(0), marks), 5), audit.NAMES).count() == 0
