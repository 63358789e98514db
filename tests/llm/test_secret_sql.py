"""The SQL of the secret scan against Spark, on random texts of its parts."""

import random

import duckdb

from scoreflow.llm.queries import ORACLE, QUERIES


def _token(rng):
    body = "".join(rng.choice("abcXYZ019+/_-") for _ in range(rng.choice([18, 20, 24, 40])))
    return body + rng.choice(["", "", "=", "==", "===", ".", ".x", "=a"])


def _text(rng):
    pieces = [
        lambda: f"{rng.choice(['password', 'API_KEY', 'apikey', 'Token', 'secret'])}{rng.choice([':', ' = ', chr(34) + ': '])}{_token(rng)[: rng.choice([3, 6, 30])]}",
        lambda: "AKIA" + "".join(rng.choice("ABC012") for _ in range(rng.choice([3, 16, 20]))),
        lambda: "".join(rng.choice("0123456789abcdef") for _ in range(rng.choice([10, 24, 40]))),
        lambda: f"{rng.choice(['user', 'client_id', 'Login', 'access_key_id'])}{rng.choice([':', '= ', chr(34) + '=' + chr(34)])}bob{rng.randrange(99)}",
        lambda: f"{rng.choice(['https', 'jdbc:mysql', 'redis'])}://host{rng.randrange(9)}/a?b={rng.randrange(10**6)}",
        lambda: _token(rng),
        lambda: rng.choice(["é", "日本", "plain words", "\n", ",", ";", "(", '"']) * rng.choice([1, 1, 40, 120]),
    ]
    return rng.choice(["", " "]).join(rng.choice(pieces)() + rng.choice([" ", "\n", ",", ""]) for _ in range(rng.randrange(1, 14)))


def test_sql_and_spark_find_the_same_spans(spark, tmp_path):
    rng = random.Random(31)
    texts = [_text(rng) for _ in range(600)] + ["", None, "x" * 50_000 + " user=bob " + "aB3" * 9]
    rows = [(None if i % 50 == 0 else i // 2, t) for i, t in enumerate(texts)]
    path = f"{tmp_path}/documents.parquet"
    spark.createDataFrame(rows, "doc_id bigint, text string").repartition(3).write.parquet(path)
    con = duckdb.connect()
    con.sql(f"CREATE VIEW documents AS SELECT * FROM '{path}/*.parquet'")
    want = con.sql(ORACLE["op2_secrets"])
    got = QUERIES["op2_secrets"](spark, str(tmp_path)).select(*want.columns).collect()
    want = want.fetchall()
    assert sorted(map(tuple, got), key=repr) == sorted(want, key=repr)
    labels = {span.split(":")[0] for row in want for span in row[5].split(",")}
    assert labels >= {"assign", "access", "hex", "credential", "credential_at_endpoint"}
