"""Collocations against counting every phrase of every piece in a dictionary."""

import random
import re
from collections import Counter
from decimal import Decimal

import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from tidebook.llm import phrases, queries

LOWER = {c: c + 32 for c in range(65, 91)}


def plain(rows, top=2000, least=10, percent=50):
    n, f = Counter(), Counter()
    for lang, text in rows:
        lang = "und" if lang is None else lang
        for piece in re.split("[.,;:!?\n\x0b\x0c\r]", (text or "").translate(LOWER)):
            own = re.findall("[^ \t]+", piece)
            n[lang] += len(own)
            for size in (1, 2, 3):
                f.update((lang, *own[i : i + size]) for i in range(len(own) - size + 1))
    often = {p: a for p, a in f.items() if len(p) > 2 and a >= least}
    out = []
    for (lang, *own), a in often.items():
        if any(q[0] == lang and len(q) > len(own) + 1 and (list(q[1:3]) == own or list(q[2:4]) == own) and 100 * b >= percent * a for q, b in often.items()):
            continue
        cuts = []
        for k in range(1, len(own)):
            left, right = f[(lang, *own[:k])], f[(lang, *own[k:])]
            cuts.append((1000000 * a * a // (left * right), k, left, right))
        s, _, left, right = min(cuts)
        out.append((lang, -s, -a, " ".join(own).encode(), left, right))
    out.sort()
    ranks = Counter()
    found = []
    for lang, s, a, phrase, left, right in out:
        ranks[lang] += 1
        if ranks[lang] <= top:
            found.append((lang, ranks[lang], phrase.decode(), -a, left, right, n[lang], -s))
    return sorted(found, key=repr)


COLUMNS = ("lang", "rank", "phrase", "a", "l", "r", "n", "score")


def made(seed, docs=120):
    rng = random.Random(seed)
    words = [f"w{i}" for i in range(12)] + ["É", "b\x1cc", "…", "Of", "THE", "x\x00y", "nul"]
    lines = [" ".join(rng.choice(words) for _ in range(6)) for _ in range(5)]
    rows = []
    for _ in range(docs):
        parts = [rng.choice(lines) if rng.random() < 0.5 else " ".join(rng.choice(words) for _ in range(rng.randint(0, 9))) for _ in range(rng.randint(0, 8))]
        rows.append((rng.choice(["en", "de", None, "und", "", "x y\n"]), rng.choice([". ", "\n", " \t ", "\r", "!"]).join(parts)))
    return rows + [("en", None), (None, ""), ("fr", " . ,\n"), ("en", "of the " * 3000)]


@pytest.mark.parametrize("top", [2000, 7])
def test_against_counting(spark, rows, top):
    given = made(5)
    docs = spark.createDataFrame([(lang, text, "s", 1) for lang, text in given], "lang string, text string, first string, total int").repartition(5)
    assert rows(phrases.collocations(docs, top=top), *COLUMNS) == plain(given, top)


def test_blocks_of_any_size(spark, rows, monkeypatch):
    given = made(6, 60)
    monkeypatch.setattr(phrases, "BLOCK", 200)
    monkeypatch.setattr(phrases, "ROWS", 7)
    docs = spark.createDataFrame(given, "lang string, text string").repartition(3)
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", 13)
    try:
        assert rows(phrases.collocations(docs, least=3), *COLUMNS) == plain(given, least=3)
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")


def test_no_documents(spark):
    assert phrases.collocations(spark.createDataFrame([], "doc_id long, lang string, text string")).count() == 0


def test_scores_are_exact_for_large_counts(spark):
    cases = [(10**14, 10**14, 10**14), (3 * 10**14 + 7, 3 * 10**14 + 11, 9 * 10**14 + 1), (10, 10**15, 10**15), (10**15 - 1, 10**15 - 1, 10**15)]
    df = spark.createDataFrame(cases, "a long, l long, r long")
    found = [r.s for r in df.select(phrases.score(F.col("a"), F.col("l"), F.col("r")).alias("s")).collect()]
    assert found == [1000000 * a * a // (left * right) for a, left, right in cases] and not any(isinstance(s, Decimal) for s in found)


def test_merging_keeps_an_open_prefix_whole():
    row = {"prefix": "a b en of a kind", "total": 6, "follow": "x\t4 y"}
    stripes = pa.RecordBatch.from_pylist([row, row, {**row, "follow": ""}], schema=phrases.PACKED_ARROW)
    done, open_row = phrases.merged(stripes, 5, False)
    assert done.num_rows == 0 and open_row.to_pylist() == [{"prefix": "a b en of a kind", "total": 18, "follow": "x\t8 y\t2"}]
    found = {"lang": "en of a kind", "first": "a", "second": "b", "total": 18, "words": ["x"], "counts": [8]}
    assert phrases.merged(open_row, 5, True)[0].to_pylist() == [found]


def test_query_reads_documents(spark, rows, tables):
    given = made(8)
    docs = spark.createDataFrame([(i, *row) for i, row in enumerate(given)], "doc_id long, lang string, text string")
    assert rows(queries.op11_phrases(spark, tables(documents=docs)), *COLUMNS) == plain(given)
