"""V7: bare names in nested, correlated, derived and WITH scopes."""
from sqlmill.operators import binding

CATALOG = [("orders", "o_orderkey"), ("orders", "o_custkey"), ("orders", "note"), ("customer", "c_custkey"), ("customer", "c_name"),
           ("customer", "note"), ("nation", "n_name"), ("nation", "o_custkey")]


def run(spark, sqls):
    samples = spark.createDataFrame([(i, 0, s) for i, s in enumerate(sqls)], "sample_id long, db_id long, output string")
    cat = spark.createDataFrame([(0, t, c) for t, c in CATALOG], "db_id long, table_name string, column_name string")
    out = {i: [] for i in range(len(sqls))}
    for r in binding.unqualified_refs(binding.binding_summary(samples), cat).orderBy("sample_id", "pos").collect():
        out[r["sample_id"]].append((r["column_name"], r["status"], r["relation"], r["anywhere"]))
    return out


def test_one_scope(spark):
    out = run(spark, [
        "SELECT o_orderkey, note FROM orders o JOIN customer c ON o_custkey = c_custkey",
        "SELECT count(*) AS n, nope FROM orders GROUP BY o_custkey ORDER BY n",
        "SELECT o_custkey k FROM orders WHERE k > 1 AND o_custkey = `o_orderkey`",
        "UPDATE orders SET note = 'x' WHERE o_orderkey = 1",
        "DELETE FROM orders WHERE c_name = 'x'",
        "   ",
    ])
    assert out[0] == [("o_orderkey", "bound", "o", True), ("note", "ambiguous", None, True), ("o_custkey", "bound", "o", True),
                      ("c_custkey", "bound", "c", True)]
    assert out[1] == [("nope", "unresolved", None, False), ("o_custkey", "bound", "orders", True), ("n", "alias", None, False)]
    assert out[2] == [("o_custkey", "bound", "orders", True), ("k", "alias", None, False), ("o_custkey", "bound", "orders", True),
                      ("o_orderkey", "bound", "orders", True)]
    assert out[3] == [("note", "bound", "orders", True), ("o_orderkey", "bound", "orders", True)]
    assert out[4] == [("c_name", "unresolved", None, False)]
    assert out[5] == []


def test_nested_and_correlated_scopes(spark):
    out = run(spark, [
        "SELECT c_name FROM customer WHERE EXISTS (SELECT 1 FROM orders WHERE o_custkey = c_custkey AND note = 'x')",
        "SELECT note FROM orders WHERE o_custkey IN (SELECT c_custkey FROM customer WHERE o_orderkey = (SELECT max(o_custkey) FROM nation))",
        "SELECT o_orderkey FROM orders WHERE o_custkey > 1 UNION SELECT c_custkey FROM customer WHERE o_orderkey = 1 AND note = ''",
        "INSERT INTO customer (c_name) SELECT n_name FROM nation WHERE c_custkey = 1",
    ])
    assert out[0] == [("c_name", "bound", "customer", True), ("o_custkey", "bound", "orders", True),
                      ("c_custkey", "bound", "customer", True), ("note", "bound", "orders", True)]
    assert out[1] == [("note", "bound", "orders", True), ("o_custkey", "bound", "orders", True), ("c_custkey", "bound", "customer", True),
                      ("o_orderkey", "bound", "orders", True), ("o_custkey", "bound", "nation", True)]
    assert out[2] == [("o_orderkey", "bound", "orders", True), ("o_custkey", "bound", "orders", True), ("c_custkey", "bound", "customer", True),
                      ("o_orderkey", "unresolved", None, True), ("note", "bound", "customer", True)]
    assert out[3] == [("c_name", "bound", "customer", True), ("n_name", "bound", "nation", True), ("c_custkey", "bound", "customer", True)]


def test_derived_tables_and_with_names(spark):
    out = run(spark, [
        "WITH big AS (SELECT o_custkey AS k, note FROM orders) SELECT k, note, o_orderkey FROM big",
        "SELECT k, c_name FROM customer, (SELECT o_custkey k FROM orders WHERE c_name = '') d",
        "SELECT o_orderkey, c_name FROM (SELECT * FROM orders) AS d",
        "SELECT o_orderkey FROM (SELECT * FROM (SELECT o_orderkey FROM orders) a) b",
        "SELECT x FROM customer c JOIN LATERAL (SELECT o_orderkey x FROM orders WHERE o_custkey = c_custkey) l ON x = 1",
        "SELECT note FROM orders JOIN customer USING (note)",
        "WITH a AS (SELECT c_custkey FROM customer), b AS (SELECT c_custkey FROM a) SELECT c_custkey, note FROM b, orders",
    ])
    assert out[0] == [("o_custkey", "bound", "orders", True), ("note", "bound", "orders", True), ("k", "bound", "big", False),
                      ("note", "bound", "big", True), ("o_orderkey", "unresolved", None, True)]
    assert out[1] == [("k", "bound", "d", False), ("c_name", "bound", "customer", True), ("o_custkey", "bound", "orders", True),
                      ("c_name", "unresolved", None, True)]
    assert out[2] == [("o_orderkey", "bound", "d", True), ("c_name", "unresolved", None, False)]
    assert out[3] == [("o_orderkey", "unknown", None, True), ("o_orderkey", "bound", "orders", True)]
    assert out[4] == [("x", "bound", "l", False), ("o_orderkey", "bound", "orders", True), ("o_custkey", "bound", "orders", True),
                      ("c_custkey", "bound", "c", True), ("x", "bound", "l", False)]
    assert out[5] == [("note", "merged", None, True), ("note", "merged", None, True)]
    assert out[6] == [("c_custkey", "bound", "customer", True), ("c_custkey", "bound", "a", True), ("c_custkey", "bound", "b", True),
                      ("note", "bound", "orders", True)]
