"""Small tables and brute-force versions of what the operators compute."""

import re

import pyarrow as pa

WORD = re.compile(r"[^\x20\x09-\x0D]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
DOCS = "doc_id long, text string, lang string, source string, n_chars long"


def words(text):
    return WORD.findall(text or "")


def table(spark, rows, schema=DOCS):
    return spark.createDataFrame(rows, schema)


def documents(spark, texts, source=None):
    return table(spark, [(i, t, None, source(i) if source else "s", len(t or "")) for i, t in enumerate(texts)])


def least_reachable(ids, links):
    """Least id of each connected component."""
    low = {i: i for i in ids}
    changed = True
    while changed:
        changed = False
        for a, b in links:
            m = min(low[a], low[b])
            if low[a] != m or low[b] != m:
                low[a] = low[b] = m
                changed = True
    return low


def batches(texts):
    return pa.array(texts, pa.string())
