"""Shared fixtures of the corpus operator tests."""

import os

import duckdb

TABLES = ("documents", "embeddings", "pages", "benchmark", "labels", "conversations")
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"

LONG = " ".join(f"word{i % 5000}" for i in range(60_000))

#: Nulls, empty, blank, repeated and very long texts, and a null id.
ODD = [
    (1, None, None, None, None), (2, "", "en", "a", 0), (3, " \t\n ", "en", "a", 3), (4, "one", "en", "b", 3),
    (5, "alpha beta gamma delta epsilon zeta", "en", "b", 30), (5, "alpha beta gamma delta epsilon zeta", "en", "b", 30),
    (6, "alpha beta gamma delta epsilon zeta", "de", "c", 30), (7, LONG, "fr", "c", len(LONG)),
    (None, "a text without an id at all", "en", "d", 10), (9, "é ü ñ 中文 \U0001f600 …", "es", "d", 10),
]


def odd_docs(spark):
    return spark.createDataFrame(ODD, SCHEMA)


def no_docs(spark):
    return spark.createDataFrame([], SCHEMA)


def oracle(sql, sf_dir):
    con = duckdb.connect()
    for t in TABLES:
        path = f"{sf_dir}/{t}.parquet"
        con.sql(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{path + '/*' if os.path.isdir(path) else path}')")
    rel = con.sql(sql)
    order = sorted(range(len(rel.columns)), key=lambda i: rel.columns[i])
    return [rel.columns[i] for i in order], sorted(tuple(str(r[i]) for i in order) for r in rel.fetchall())


def rows_of(df):
    order = sorted(df.columns)
    return order, sorted(tuple(str(r[c]) for c in order) for r in df.collect())
