"""Brute-force versions and awkward inputs shared by the tests of this folder."""

import re
import string

import duckdb

DOCS = "doc_id long, text string, lang string, source string, n_chars long"


def docs(spark, texts, first=0):
    """A documents frame of the texts (any may be None)."""
    rows = [(first + i, t, "en", f"s{i % 3}", len(t or "")) for i, t in enumerate(texts)]
    return spark.createDataFrame(rows, DOCS)


def awkward(spark):
    """Null in every column, empty and blank texts, a long one, repeats, ties, and a clashing column name."""
    long_text = " ".join(f"w{i % 977}" for i in range(20_000))
    rows = [(1, None, None, None, None, "x"), (2, "", "en", "a", 0, "x"), (3, " \n ", "en", "a", 3, None), (None, "some words", "en", "a", 1, "x"),
            (4, long_text, "en", "b", 9, "y"), (5, "One two three four five six", "en", "a", 1, "x"),
            (5, "One two three four five six", "en", "a", 1, "x"), (6, "one two  three four\tfive six", "en", None, 1, "x"),
            (7, "é" * 3, "fr", "a", 3, "x")]
    return spark.createDataFrame(rows, DOCS + ", score string")


def words(text):
    lowered = "".join(c.lower() if c in string.ascii_uppercase else c for c in text or "")
    return re.findall(r"[^\x20\x09-\x0D]+", lowered)


def shingles(ws, n=5):
    if not ws:
        return set()
    return {tuple(ws[i:i + n]) for i in range(max(1, len(ws) - n + 1))}


def components(sets, percent=75):
    """Smallest id reachable over links at the Jaccard similarity, by comparing all pairs."""
    parent = {i: i for i in sets}

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    ids = sorted(sets)
    for k, a in enumerate(ids):
        for b in ids[k + 1:]:
            both = len(sets[a] & sets[b])
            if both and 100 * both >= percent * len(sets[a] | sets[b]):
                x, y = sorted((root(a), root(b)))
                parent[y] = x
    return {i: root(i) for i in ids}


def duck_folders(folder, *tables):
    """DuckDB with the tables that Spark wrote as Parquet folders."""
    con = duckdb.connect()
    for t in tables:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{folder}/{t}.parquet/*.parquet')")
    return con
