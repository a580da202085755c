"""Validator on awkward statements (table references and verdicts)."""
from sqlmill.operators import validation as V

CATALOG = [("orders", "o_orderkey"), ("orders", "o_orderdate"), ("orders", "o_custkey"),
           ("customer", "c_custkey"), ("customer", "c_name"), ("nation", "n_nationkey"), ("nation", "n_name")]


def run(spark, sqls, strict=False):
    samples = spark.createDataFrame([(i, 0, s) for i, s in enumerate(sqls)], "sample_id long, db_id long, output string")
    cat = spark.createDataFrame([(0, t, c) for t, c in CATALOG], "db_id long, table_name string, column_name string")
    v = V.validate_samples(samples, cat, strict=strict).orderBy("sample_id").collect()
    frame = V.token_frame(V.sql_tokens(samples))
    refs = {}
    for r in V.table_refs(frame).collect():
        refs.setdefault(r["sample_id"], []).append((r["pos"], r["table_name"], r["alias"]))
    return [(x["valid"], x["error_kind"]) for x in v], {k: [t[1:] for t in sorted(v_)] for k, v_ in refs.items()}


def test_awkward_statements(spark):
    sqls = [
        "SELECT EXTRACT(YEAR FROM o.o_orderdate) FROM orders o",          # 0 EXTRACT is not a table
        "DELETE FROM orders WHERE o_orderkey = 1",                        # 1
        "SELECT x.o_custkey FROM (SELECT o_custkey FROM orders) x",       # 2 derived table
        "SELECT * FROM db1.orders",                                       # 3 qualified name
        "SELECT `c`.`c_name` FROM `customer` AS `c`",                     # 4 backticks
        "SELECT * FROM orders LEFT OUTER JOIN customer USING (o_custkey), nation n",  # 5
        "SELECT TRIM(BOTH 'x' FROM c_name) FROM customer ORDER BY",       # 6 dangling ORDER BY
        "SELECT o.nope FROM orders o",                                    # 7 missing column
        "-- only a comment",                                              # 8 no statement
        "SELECT a FROM t WHERE s = 'unterminated",                        # 9 stray quote
    ]
    verdicts, refs = run(spark, sqls)
    assert refs[0] == [("orders", "o")]
    assert refs[1] == [("orders", None)]
    assert refs[2] == [("orders", None)]
    assert refs[3] == [("orders", None)]
    assert refs[4] == [("customer", "c")]
    assert refs[5] == [("orders", None), ("customer", None), ("nation", "n")]
    assert refs[6] == [("customer", None)]
    assert verdicts[:6] == [(True, None)] * 6
    assert verdicts[6] == (False, "syntax")
    assert verdicts[7] == (False, "missing_column")
    assert verdicts[8] == (False, "syntax")
    assert verdicts[9] == (False, "syntax")
    strict, _ = run(spark, sqls[:3], strict=True)
    assert strict == [(True, None), (True, None), (False, "missing_table")]


def test_words_that_are_no_clauses(spark):
    sqls = [
        "SELECT * FROM orders o WHERE o.o_orderkey IS DISTINCT FROM o_custkey",                 # 0
        "SELECT * FROM orders WHERE o_orderkey IS NOT DISTINCT FROM o_custkey, 1",              # 1
        "INSERT INTO orders (o_orderkey) VALUES (1) ON DUPLICATE KEY UPDATE o_custkey = 2",     # 2
        "SELECT * FROM orders FOR UPDATE NOWAIT",                                               # 3
        "SELECT g.x FROM orders o, generate_series(1, 3) g WHERE my.fn(o.o_orderkey) > 1",      # 4
        "WITH x AS (SELECT 1) UPDATE orders SET o_custkey = 1",                                 # 5
        "UPDATE nowhere SET a = 1",                                                             # 6
        "SELECT * FROM orders JOIN LATERAL_VIEW(1) v ON v.a = o_orderkey",                      # 7
        "INSERT INTO nowhere(a) VALUES (1)",                                                    # 8
        "SELECT DISTINCT FROM orders",                                                          # 9
    ]
    verdicts, refs = run(spark, sqls)
    assert [v for v, _ in verdicts] == [True] * 6 + [False, True, False, True]
    assert refs[4] == [("orders", "o")] and refs[2] == [("orders", None)] and refs[5] == [("orders", None)]
    assert verdicts[6][1] == verdicts[8][1] == "missing_table"


def test_word_lists_hold_what_the_rules_say():
    assert {"SELECT", "WITH", "INSERT", "UPDATE", "DELETE", "("} <= set(V.VERBS)
    assert V.TABLE_PREV == ("FROM", "JOIN", "INTO", "UPDATE")
    assert {"FROM", "WHERE", "ON", "AND", ",", "="} <= set(V.DANGLING) and ";" not in V.DANGLING


def test_execution_stage_and_own_rules(spark):
    from pyspark.sql import functions as F
    rows = [(1, 0, "SELECT o_custkey FROM orders"), (2, 0, "DELETE FROM orders"), (3, 0, "SELECT * FROM nope"), (4, 0, "SELECT 1")]
    samples = spark.createDataFrame(rows, "sample_id long, db_id long, output string")
    cat = spark.createDataFrame([(0, t, c) for t, c in CATALOG], "db_id long, table_name string, column_name string")
    executed = spark.createDataFrame([(1, False, "boom"), (2, False, "x"), (3, False, "x")], "sample_id long, exec_ok boolean, error string")

    def no_constants(summary):
        return summary.where(F.size("trefs") == 0).select("sample_id", F.lit(9).alias("stage"), F.lit(0).cast("long").alias("pos"),
                                                          F.lit("constant").alias("kind"), F.lit("no table").alias("message"))
    out = {r["sample_id"]: (r["valid"], r["error_kind"]) for r in
           V.validate_samples(samples, cat, executed=executed, rules=(no_constants,)).collect()}
    assert out == {1: (False, "execution"), 2: (True, None), 3: (False, "missing_table"), 4: (False, "constant")}


def test_every_table_of_a_statement_is_seen(spark):
    sqls = [
        "UPDATE orders o, nowhere n SET o.o_custkey = 1, n.a = 2",                                   # 0
        "EXPLAIN ANALYZE UPDATE nowhere SET a = 1",                                                  # 1
        "MERGE INTO orders USING nowhere s ON orders.o_orderkey = s.k WHEN MATCHED THEN DELETE",     # 2
        "DELETE FROM orders USING customer c, nowhere WHERE o_custkey = c.c_custkey",                # 3
        "TRUNCATE TABLE nowhere",                                                                    # 4
        "DROP TABLE IF EXISTS orders, nowhere",                                                      # 5
        "ALTER TABLE nowhere ADD COLUMN a INT, ADD COLUMN b INT",                                    # 6
        "SELECT * FROM orders o JOIN customer c ON o.o_custkey = c.c_custkey, nowhere",              # 7
        "UPDATE orders SET o_custkey = 1 FROM nowhere n WHERE n.a = 2",                              # 8
        "MERGE INTO orders USING (SELECT c_custkey FROM customer) s ON s.c_custkey = o_custkey WHEN MATCHED THEN UPDATE SET o_custkey = 1",  # 9
        "SELECT DISTINCT ON (o_custkey) o_custkey, o_orderkey FROM orders",                          # 10
        "SELECT CONVERT(c_name USING utf8), c_custkey FROM customer",                                # 11
        "INSERT INTO orders SELECT * FROM orders JOIN customer ON o_custkey = c_custkey ON DUPLICATE KEY UPDATE o_custkey = 1, o_orderkey = 2",  # 12
    ]
    verdicts, refs = run(spark, sqls)
    names = {i: [t for t, _ in refs.get(i, [])] for i in range(len(sqls))}
    assert names[0] == ["orders", "nowhere"] and refs[0] == [("orders", "o"), ("nowhere", "n")]
    assert names[1] == names[4] == names[6] == ["nowhere"]
    assert names[2] == names[5] == names[8] == ["orders", "nowhere"]
    assert names[3] == names[7] == ["orders", "customer", "nowhere"]
    assert names[9] == ["orders", "customer"] and names[10] == ["orders"] and names[11] == ["customer"]
    assert names[12] == ["orders", "orders", "customer"]
    assert [v for v, _ in verdicts] == [False] * 9 + [True] * 4
    assert {k for v, k in verdicts if not v} == {"missing_table"}
