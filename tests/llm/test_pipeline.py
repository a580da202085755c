"""The pipeline's stages against brute force, each on its own input."""
import corpus_pipeline
import __spark_entry__ as E
from conftest import SF
from sqlmill.llm import queries, toxicity
from test_search_join_suffix import brute_components, brute_removed
from test_tokens import checked


def test_registered():
    names = E.queries()
    assert "pipeline" in names and all(any(k.startswith(f"op{n}_") for k in names) for n in range(1, 14))
    assert [n for n, _ in corpus_pipeline.STAGES] == ["toxicity", "exact_dedup", "ngram_jaccard", "suffix_array", "packing"]
    assert set(queries.ORACLE) == {f for f in queries.QUERIES if f.split("_")[0] in ("op1", "op3", "op8", "op9", "op10", "op11", "op13")}


def test_stages_on_their_own_input(spark, tmp_path):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    columns = docs.columns
    rows = {r["doc_id"]: r for r in docs.collect()}
    for k, (name, stage) in enumerate(corpus_pipeline.STAGES):
        stage(spark, docs, SF).write.parquet(str(tmp_path / str(k)))
        out = spark.read.parquet(str(tmp_path / str(k)))
        got = out.collect()
        if name != "packing":
            assert out.columns == columns
        if name == "toxicity":
            model = toxicity.train(docs, spark.read.parquet(f"{SF}/labels.parquet"), toxicity.teaches())
            score = dict(zip(rows, model.score([r["text"] for r in rows.values()])))
            assert {r["doc_id"] for r in got} == {i for i in rows if score[i] < toxicity.THRESHOLD}
        elif name == "exact_dedup":
            best = {}
            for r in rows.values():
                key = "".join(r["text"].split()) if r["text"].isascii() else r["text"].translate({c: None for c in b" \t\n\x0b\x0c\r"})
                best[key] = min(best.get(key, (0, 1 << 60)), (-len(r["text"]), r["doc_id"]))
            assert {r["doc_id"] for r in got} == {i for _, i in best.values()}
        elif name == "ngram_jaccard":
            label = brute_components([(i, r["text"]) for i, r in rows.items()])
            assert {r["doc_id"] for r in got} == {i for i, (_, c) in label.items() if i == c}
        elif name == "suffix_array":
            removed = brute_removed([(i, r["text"]) for i, r in rows.items()])
            assert {r["doc_id"] for r in got} == set(rows)
            for r in got:
                assert r["n_chars"] == len(r["text"])
                assert 0 <= removed[r["doc_id"]][0] - removed[r["doc_id"]][1] - len(r["text"].encode()) <= 6 * removed[r["doc_id"]][2]
        else:
            checked(got, [(i, r["text"]) for i, r in rows.items()])
        if name != "packing":
            rows = {r["doc_id"]: r for r in got}
            docs = out
