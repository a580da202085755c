import hashlib
import random

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from llm_helpers import by_id, make  # noqa: F401
from sqlmill.llm import components, jaccard, suffix, topk


# --- top-k ---

def best(rows, k=5):
    rows = {(i, tuple(v)) for i, v in rows if i is not None and v is not None and all(x is not None and np.isfinite(x) for x in v)}
    ints = [(i, [int(np.floor(256 * np.float64(np.float32(x)))) for x in v]) for i, v in rows]
    out = set()
    for q, x in ints:
        if q % 50 == 0:
            scored = sorted((-sum(a * b for a, b in zip(x, y)), i) for i, y in ints if i != q)
            out |= {(q, r + 1, i, -s) for r, (s, i) in enumerate(scored[:k])}
    return out


def searched(spark, rows):
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>, label int, score string")
    return {(r["query_id"], r["rank"], r["vec_id"], r["score"]) for r in topk.top_k(topk.quantised(df), F.col("vec_id") % 50 == 0).collect()}


@pytest.mark.parametrize("spread", [0.0, 0.6])
def test_topk_equals_brute_force(spark, spread, monkeypatch):
    monkeypatch.setattr(topk, "PAGE_ROWS", 16)
    monkeypatch.setattr(topk, "SUBTREE_ROWS", 64)
    monkeypatch.setattr(topk, "QUERY_BLOCK", 5)
    rng = np.random.default_rng(8)
    middle = rng.normal(size=(6, 5)) * 2
    rows = [(i, (middle[i % 6] + spread * rng.normal(size=5)).astype(np.float32).tolist()) for i in range(700)]
    rows += [(1000, None), (1001, [1.0, float("nan"), 0.0, 0.0, 0.0]), (1002, [None, 1.0, 1.0, 1.0, 1.0]), (None, [1.0] * 5),
             (1003, [float("inf")] * 5), (1004, [3.0, 1.0]), rows[7], rows[50]]
    assert searched(spark, [(i, v, 0, "x") for i, v in rows]) == best(rows)


def test_topk_small_tables(spark):
    rows = [(0, [1.0, 2.0]), (1, [0.5, 0.5]), (2, [0.5, 0.5])]
    assert searched(spark, [(i, v, 0, "") for i, v in rows]) == best(rows)
    assert searched(spark, [(0, [1.0], 0, "")]) == set()
    assert searched(spark, []) == set()


# --- components and Jaccard ---

def test_components_of_chains_and_stars(spark):
    rng = random.Random(2)
    links = [(i, i + 1) for i in range(60)] + [(100, i) for i in range(101, 140)] + [(200, 201), (201, 200), (300, 300)]
    rng.shuffle(links)
    out = {r["node"]: r["component"] for r in components.components(spark.createDataFrame(links, "a long, b long")).collect()}
    assert all(out[i] == 0 for i in range(61)) and all(out[i] == 100 for i in range(100, 140)) and out[201] == 200 and 300 not in out


def sets_of(text):
    words = bytes(text or "", "utf-8").lower().split()
    return {tuple(words[i:i + 5]) for i in range(max(1, len(words) - 4))} if words else set()


def brute_components(rows):
    sets = {i: sets_of(t) for i, t in rows}
    up = {i: i for i in sets}

    def top(i):
        while up[i] != i:
            i = up[i]
        return i
    for a in sets:
        for b in sets:
            if a < b and sets[a] and sets[b] and 100 * len(sets[a] & sets[b]) >= 75 * len(sets[a] | sets[b]):
                x, y = sorted((top(a), top(b)))
                up[y] = x
    return {i: (len(sets[i]), top(i)) for i in sets}


def brute_of_sets(sets):
    left, label = set(sets), {}
    while left:
        i = min(left)
        todo, left = [i], left - {i}
        while todo:
            a = todo.pop()
            label[a] = (len(sets[a]), i)
            near = {b for b in left if sets[a] and sets[b] and 100 * len(sets[a] & sets[b]) >= 75 * len(sets[a] | sets[b])}
            todo, left = todo + list(near), left - near
    return label


def near_copies(seed, n=120):
    rng = random.Random(seed)
    words = [f"w{i}" for i in range(300)]
    bases = [[rng.choice(words) for _ in range(rng.choice([3, 8, 40, 90]))] for _ in range(6)]
    passage = [rng.choice(words) for _ in range(25)]
    rows = []
    for i in range(n):
        text = list(rng.choice(bases))
        for _ in range(rng.randrange(4)):
            text[rng.randrange(len(text))] = rng.choice(words + ["W1", "é"])
        if rng.random() < 0.3:
            text += passage
        rows.append((rng.randrange(10 ** 9), rng.choice([" ", "\n", "\t "]).join(text)))
    return list({i: (i, t) for i, t in rows}.values())


@pytest.mark.parametrize("seed", [1, 2])
def test_jaccard_equals_brute_force(make, seed, monkeypatch):
    monkeypatch.setattr(jaccard, "GROUP_PAIRS", 7)
    rows = near_copies(seed) + [(2 * 10 ** 9, ""), (2 * 10 ** 9 + 1, " \n"), (2 * 10 ** 9 + 2, None), (2 * 10 ** 9 + 3, "word " * 50_000)]
    docs = make(rows).withColumn("n", F.lit("x")).withColumn("key", F.lit(1))
    assert by_id(jaccard.linked(docs), "n_shingles", "component_id") == brute_components(rows)


@pytest.mark.parametrize("seed", [5, 6])
def test_jaccard_with_heavy_tokens_and_many_buckets(make, seed, monkeypatch):
    monkeypatch.setattr(jaccard.R, "FLOOR", 4)  # tokens of two documents are heavy then
    monkeypatch.setattr(jaccard.R, "BUCKET_TOKENS", 60)
    rows = near_copies(seed, 150)
    assert by_id(jaccard.linked(make(rows).repartition(3)), "n_shingles", "component_id") == brute_components(rows)


def test_jaccard_of_one_large_family_makes_few_pairs(make, spark, monkeypatch):
    """Copies with edits of their own: those far from the lead leave its list before pairs are made."""
    rng = random.Random(8)
    base = [f"b{i}" for i in range(120)]
    rows = []
    for i in range(300):
        text = list(base)
        for k in rng.sample(range(120), rng.choice([1, 2, 3, 9, 12])):
            text[k] = f"own{i}x{k}"
        rows.append((i, " ".join(text)))
    made = []
    plain = jaccard.verify
    monkeypatch.setattr(jaccard, "verify", lambda pairs, sets, name: made.append(pairs.count()) or plain(pairs, sets, name))
    assert by_id(jaccard.linked(make(rows)), "n_shingles", "component_id") == brute_components(rows)
    assert sum(made) < 3 * len(rows)


def test_jaccard_keeps_one_of_each_group(make):
    text = " ".join(f"w{i}" for i in range(40))
    docs = make([(3, text), (1, text + " more"), (2, "other words"), (None, text), (4, None), (4, None)]).withColumn("rep", F.lit(0))
    kept = jaccard.keep_one(docs)
    assert kept.columns == docs.columns
    assert sorted((r["doc_id"] is None, r["doc_id"]) for r in kept.collect()) == [(False, 1), (False, 2), (False, 4), (False, 4), (True, None)]
    assert jaccard.linked(docs.limit(0)).count() == 0


def test_jaccard_of_repeated_rows_equals_brute_force(make):
    rng = random.Random(5)
    common = [f"c{i}" for i in range(84)]  # 80 shingles that both long texts hold
    first, second = (" ".join(common + [f"{x}{i}" for i in range(20)]) for x in "ab")
    rows = [(1, first), (1, first), (2, second)]  # 80 of 120 shared: no link
    rows += [(i + 10, t) for i, t in near_copies(3, 60)]
    rows += [rng.choice(rows[3:]) for _ in range(40)]  # equal rows
    rows += [(rows[3 + k][0], rows[60 - k][1]) for k in range(5)] + [(rows[3][0], None), (5, None), (5, ""), (5, None)]  # other texts
    sets = {}
    for i, t in rows:
        sets.setdefault(i, set()).update(sets_of(t))
    want = brute_of_sets(sets)
    out = jaccard.linked(make(rows).repartition(3))
    assert sorted((r["doc_id"], r["n_shingles"], r["component_id"]) for r in out.collect()) == sorted((i, *want[i]) for i, _ in rows)
    assert want[1][1] == 1 and want[2][1] == 2
    kept = jaccard.keep_one(make(rows))
    assert sorted(r["doc_id"] for r in kept.collect()) == sorted(i for i, _ in rows if want[i][1] == i)


def test_prefix_grows_only_when_cheaper():
    assert jaccard.matches(np.array([2] * 200), 200, 0) > 1  # one more cheap list saves many candidates
    assert jaccard.matches(np.array([2] * 51 + [10 ** 6] * 149), 200, 0) == 1


# --- suffix arrays ---

@settings(max_examples=400, deadline=None)
@given(st.one_of(st.binary(max_size=60), st.lists(st.sampled_from([97, 98]), max_size=60).map(bytes)))
def test_suffix_array_equals_sorting(text):
    assert suffix.suffix_array(text) == sorted(range(len(text)), key=lambda i: text[i:])


@settings(max_examples=150, deadline=None)
@given(st.one_of(st.binary(max_size=300), st.text(st.sampled_from("ab"), max_size=300).map(str.encode)))
def test_every_window_has_one_anchor(text):
    at, _, first, last = suffix.anchors([b"q" * 30, text, text])[1]
    assert [w for a, b in zip(first, last) for w in range(a, b + 1)] == list(range(max(0, len(text) - 49)))
    assert all(b <= p and p + suffix.GRAM <= a + suffix.LENGTH for p, a, b in zip(at, first, last)) or all(
        a <= p and p + suffix.GRAM <= b + suffix.LENGTH for p, a, b in zip(at, first, last))


def brute_removed(rows):
    first = {}
    data = [(i, (t or "").encode()) for i, t in rows]
    for i, b in data:
        for k in range(len(b) - 49):
            w = b[k:k + 50]
            first[w] = min(first.get(w, i), i)
    out = {}
    for i, b in data:
        gone = np.zeros(len(b) + 1, np.int8)
        for k in range(len(b) - 49):
            if first[b[k:k + 50]] < i:
                gone[k:k + 50] = 1
        kept = bytes(x for x, g in zip(b, gone) if not g)
        out[i] = (len(b), int(gone.sum()), int((np.diff(np.r_[0, gone]) == 1).sum()), hashlib.sha256(kept).hexdigest())
    return out


def passages(seed, n=60):
    rng = random.Random(seed)

    def prose(k):
        return " ".join("".join(rng.choice("etaoinö") for _ in range(rng.randrange(1, 8))) for _ in range(k))
    common = [prose(rng.randrange(8, 60)) for _ in range(8)]
    rows = []
    for i in rng.sample(range(10 ** 6), n):
        text = ""
        for _ in range(rng.randrange(5)):
            p = rng.choice(common)
            a = rng.randrange(len(p))
            text += prose(rng.randrange(20)) + rng.choice(["", " "]) + (p if rng.random() < 0.5 else p[a:a + rng.randrange(40, 120)])
        rows.append((i, text))
    return rows + [(10 ** 7, "a" * 500), (10 ** 7 + 1, "a" * 120 + "b" + "a" * 49), (10 ** 7 + 2, None), (10 ** 7 + 3, "")]


@pytest.mark.parametrize("heavy", [512, 4])
def test_suffix_dedup_equals_brute_force(make, heavy, monkeypatch):
    monkeypatch.setattr(suffix, "PART_BYTES", 4000)
    monkeypatch.setattr(suffix.R, "BUCKET_TOKENS", 300)
    monkeypatch.setattr(suffix.R, "FLOOR", heavy)
    rows = passages(heavy)
    out = suffix.dedup_bytes(make(rows).repartition(5)).withColumn("sha", F.sha2("kept", 256))
    assert by_id(out, "n_bytes", "n_removed", "n_spans", "sha") == brute_removed(rows)


def test_suffix_rows_keep_their_columns(make, spark):
    long = "a very long passage that repeats itself in other documents, with ö at its end: "
    docs = make([(1, long), (2, "x" + long + "y"), (None, long), (3, None), (5, "short"), (5, "short")]).withColumn("kept", F.array(F.lit(1), F.lit(None)))
    out = suffix.without_repeats(docs)
    assert out.columns == docs.columns and dict(out.dtypes) == dict(docs.dtypes)
    rows = sorted((r["doc_id"] or -1, r["text"], r["source"], r["kept"]) for r in out.collect())
    assert rows == [(-1, long, "s", [1, None]), (1, long, "s", [1, None]), (2, "xy", "s", [1, None]), (3, "", "s", [1, None]),
                    (5, "short", "s", [1, None]), (5, "short", "s", [1, None])]
    assert suffix.without_repeats(docs.limit(0)).count() == 0


def test_suffix_keeps_replacement_characters_of_the_text(make):
    passage = "ö".join(f"passage {i} " for i in range(12))
    rows = [(1, "ä" + passage + "ü"), (2, "old \ufffd mark ö" + passage + "ä and \ufffd\ufffd"), (3, "é\ufffd" + passage + "ý")]
    # the first bytes of ö and ä are those of é and ü, so cuts go through characters too
    out = by_id(suffix.without_repeats(make(rows)), "text")
    assert out[1] == rows[0][1]
    assert out[2].startswith("old \ufffd mark ") and out[2].endswith(" and \ufffd\ufffd") and out[2].count("\ufffd") == 3
    assert out[3].startswith("é\ufffd") and out[3].count("\ufffd") == 1 and len(out[3]) <= 3


def test_suffix_cuts_each_text_of_an_id_by_itself(make):
    passage = " ".join(f"passage {i}" for i in range(12))
    other = "".join(chr(97 + i * i % 23) + str(i) for i in range(90))
    rows = [(1, passage), (2, "x" + passage + "y"), (2, other), (2, other + passage), (2, other + passage), (2, None)]
    out = suffix.dedup_bytes(make(rows).repartition(3)).collect()
    assert sorted((r["doc_id"], r["kept"].decode()) for r in out) == sorted(
        [(1, passage), (2, "xy"), (2, other), (2, other), (2, other), (2, "")])
