"""Small tables of the edge cases every operator must take, and helpers for brute-force twins."""

from __future__ import annotations

import duckdb

DOCS = "doc_id long, text string, lang string, source string, n_chars long"
PAGES = "page_id long, url string, html string"
ITEMS = "item_id long, text string"
LABELS = "doc_id long, quality int, toxic int"
SENT = "One two three four. Five six seven eight. Nine ten eleven twelve. "

ODD_DOCS = [
    (1, None, None, None, None), (2, "", "en", "a", 0), (3, "x", "en", None, 1), (3, "x", "en", None, 1),
    (None, "Some text here. And more of it here! password=abcdefgh12", None, "b", 3), (None, None, None, None, None),
    (7, "word " * 30000, "en", "a", 5), (8, "a" * 300000, "en", "a", 5), (9, SENT * 3, "en", "b", 1),
    (10, SENT * 3, "en", "b", 1), (11, "퟿\U0001F600 é " * 50, "en", "b", 1)]
ODD_PAGES = [(1, None, None), (2, "http://A.com/x", ""), (2, "http://A.com/x", "<p>hi"), (None, "no scheme", "<div><p>x<b>y</div>"),
             (5, "://", "<" * 2000), (6, "http://h/" + "a/" * 3000, "<div>" * 5000 + "t")]
ODD_ITEMS = [(1, None), (2, ""), (4, SENT), (4, SENT), (None, "zz yy xx ww vv")]
ODD_LABELS = [(1, None, None), (2, 0, None), (3, 1, 0), (9, 1, 1), (9, 0, 0), (None, 1, 1)]


VECTORS = "vec_id long, embedding array<float>, label int"


def odd_vectors():
    one = [((i * 37) % 19 - 9) / 7 for i in range(64)]
    return [(1, None, 0), (2, [], 0), (3, one[:63], 0), (4, [None] + one[1:], 0), (5, [float("nan")] + one[1:], 0),
            (6, one[:-1] + [float("-inf")], 0), (7, one, 0), (7, one, 0), (8, [-x for x in one], 1), (None, [0.0] * 64, 1),
            (9, [1e30] * 64, 1), (10, [-1e30] + one[1:], 1)]


def docs_of(spark, rows, schema=DOCS):
    return spark.createDataFrame(rows, schema)


def write_tables(spark, path, docs=(), pages=(), items=(), labels=(), vectors=()):
    for name, rows, schema in (("documents", docs, DOCS), ("pages", pages, PAGES), ("benchmark", items, ITEMS),
                               ("labels", labels, LABELS), ("embeddings", vectors, VECTORS)):
        spark.createDataFrame(list(rows), schema).write.mode("overwrite").parquet(f"{path}/{name}.parquet")
    return str(path)


def rows_of(sf_dir, sql):
    con = duckdb.connect()
    for t in ("documents", "pages", "benchmark", "labels"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf_dir}/{t}.parquet')")
    return con.sql(sql).fetchall()
