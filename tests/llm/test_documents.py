"""Fingerprints, quality, decontamination, packing and the pipeline."""

import random
import zlib

import brute
import numpy as np
import pytest
from tokenizers import Tokenizer

import corpus_pipeline
from tidebook.llm import base, decontaminate, packing, quality, queries, spotsigs
from tidebook.llm.fm_index import FMIndex, suffix_array


def prose(rng, size):
    common = ["the", "of", "and", "to"]
    return " ".join(rng.choice(common) if rng.random() < 0.3 else f"{rng.choice('abcdefgh')}{rng.randrange(400)}x" for _ in range(size))


def fingerprint_docs():
    rng = random.Random(4)
    docs = [(i * 5, prose(rng, rng.randint(1, 200))) for i in range(80)]
    return [*docs, (1, None), (2, ""), (3, docs[7][1]), (None, "the é ü"), (4, "  \n "), (6, prose(rng, 20_000))]


def test_edited_texts(frame, spark):
    docs = fingerprint_docs()
    got = {r["doc_id"]: r for r in spotsigs.against_next(frame(docs)).collect()}
    order = sorted(docs, key=lambda x: (x[0] is None, -(x[0] or 0)))
    for (doc, text), (_, following) in zip(order, [*order[1:], order[0]], strict=True):
        edited = spotsigs.edited_text(text or "", following or "")
        assert (got[doc]["n_chars"], got[doc]["edited_sha256"]) == (len(text or ""), brute.sha(edited.encode()))
        assert 0 <= got[doc]["near_edited"] <= 1 and 0 <= got[doc]["near_next"] <= 1
    assert got[35]["fingerprint"] == got[3]["fingerprint"] != got[40]["fingerprint"]
    assert got[1]["fingerprint"] == got[2]["fingerprint"] == got[4]["fingerprint"] == ""


@pytest.mark.parametrize("docs", [[], [(1, "only one text")], [(1, None), (1, None)], [(None, "a"), (None, "b")]])
def test_edited_texts_of_odd_tables(frame, docs):
    assert spotsigs.against_next(frame(docs)).count() == len(docs)


def test_all_alike_pairs_are_found(frame, spark):
    rng = random.Random(8)
    docs = []
    for i in range(40):
        own = prose(rng, 120).split()
        for k in range(3):
            docs.append((3 * i + k, " ".join(own)))
            own[rng.randrange(len(own))] = "edit"
    common = [b"the", b"of", b"and", b"to"]
    prints = spotsigs.fingerprints(frame(docs), common)
    pairs, members = spotsigs.matches(prints)
    got = {(r["one"], r["two"]) for r in pairs.collect()}
    sets = {brute.sha(r["fingerprint"].encode()): spotsigs.spots_in(r["fingerprint"]) for r in prints.collect()}
    names = sorted(sets)
    want = {(a, b) for i, a in enumerate(names) for b in names[i + 1 :] if spotsigs.likeness(sets[a], sets[b]) >= 0.8}
    assert got == want and len(want) > 20 and members.count() == len(docs)


def test_quality_on_held_out_labels(spark):
    folder = "/root/testdata/sf0.01"
    docs, labels = (spark.read.parquet(f"{folder}/{t}.parquet") for t in ("documents", "labels"))
    model = quality.fit(docs, labels.filter("doc_id % 2 = 0"))
    judged = quality.scores(docs, model).join(labels, "doc_id").filter("doc_id % 2 = 1").toPandas()
    good, bad = judged[judged.quality == 1], judged[judged.quality == 0]
    assert (good[good.toxic == 0].keep).mean() > 0.97
    assert len(bad) and bad.keep.mean() < 0.1
    assert judged.posterior.between(0, 1).all() and judged.score.between(0, 1).all()


def test_length_alone_does_not_make_a_text_toxic(spark):
    """Clean held-out documents run together stay, however many; so do toxic ones go."""
    folder = "/root/testdata/sf0.01"
    docs, labels = (spark.read.parquet(f"{folder}/{t}.parquet") for t in ("documents", "labels"))
    model = quality.fit(docs, labels.filter("doc_id % 2 = 0"))
    held = {toxic: [r.text for r in docs.join(labels.filter(f"doc_id % 2 = 1 AND quality = 1 AND toxic = {toxic}"), "doc_id").orderBy("doc_id").collect() if r.text] for toxic in (0, 1)}
    rng = random.Random(7)
    long = [(10 * n + i, "\n".join(rng.choices(held[0], k=n))) for n in (10, 100, 400) for i in range(8)]
    kept = quality.scores(spark.createDataFrame(long, "doc_id long, text string"), model).collect()
    assert all(r.toxicity < quality.TOXIC for r in kept)
    toxic = spark.createDataFrame([(i, "\n".join(rng.choices(held[1], k=12))) for i in range(8)], "doc_id long, text string")
    assert not any(r.keep for r in quality.scores(toxic, model).collect())


def test_the_fit_can_be_repeated(spark, frame):
    """Ids with several texts and several labels: the worse label and the least text count, in every order of rows."""
    rng = random.Random(8)
    docs = [(i % 40, prose(rng, 60) + (" foul vile" if i % 40 < 10 else "")) for i in range(80)]
    labels = [(i, int(i < 10)) for i in range(40)] + [(i, 0) for i in range(5)]
    fitted = []
    for seed in (1, 2):
        random.Random(seed).shuffle(docs)
        random.Random(seed).shuffle(labels)
        marked = spark.createDataFrame(labels, "doc_id long, toxic int").repartition(3)
        fitted.append(quality.fit(frame(docs, 4), marked))
    assert np.array_equal(fitted[0].quality, fitted[1].quality)
    assert all(np.array_equal(a, b) for a, b in zip(fitted[0].lexicon, fitted[1].lexicon, strict=True)) and len(fitted[0].lexicon[0])


def test_quality_of_odd_tables(frame, rows):
    for docs in ([], [(1, None), (2, ""), (2, "")]):
        table = frame(docs).withColumnRenamed("place", "keep")
        kept = quality.keep_good(table, quality.fit(table))
        assert kept.count() == len(docs) and "keep" not in kept.columns


def test_accuracies_by_expectation_maximisation():
    rng = np.random.default_rng(5)
    counts, truth = {}, {}
    for _ in range(6000):
        good = rng.random() < 0.8
        votes = "".join("-" if rng.random() < 0.2 else "g" if (rng.random() < 0.9) == good else "b" for _ in range(quality.LABELLERS))
        counts[votes] = counts.get(votes, 0) + 1
        truth[votes] = truth.get(votes, 0) + good
    prior, chance = quality.fit_accuracies(counts)
    assert abs(prior - 0.8) < 0.03 and np.abs(chance[:, 1, 2] - 0.72).max() < 0.05 and np.abs(chance[:, 0, 0] - 0.72).max() < 0.08


def test_suffix_array_and_search():
    rng = np.random.default_rng(2)
    runs = [rng.integers(1, 4, rng.integers(1, 30)) for _ in range(40)]
    symbols = np.concatenate([np.append(r, 0) for r in runs])
    assert sorted(suffix_array(symbols).tolist()) == list(range(len(symbols)))
    index = FMIndex(symbols, 3)
    for size in (1, 2, 5):
        phrases = np.array(list({tuple(symbols[i : i + size]) for i in range(len(symbols) - size) if (symbols[i : i + size] > 0).all()}))
        padded = np.zeros((len(phrases), 6), np.int64)
        padded[:, 6 - size :] = phrases
        low, high = index.search(padded, np.full(len(phrases), size))
        for phrase, a, b in zip(phrases, low, high, strict=True):
            found = sorted(index.locate(np.arange(a, b)).tolist())
            assert found == [i for i in range(len(symbols) - size) if (symbols[i : i + size] == phrase).all()]


def test_contamination(frame, rows, spark):
    rng = random.Random(6)
    items = [(i, " ".join(f"W{rng.randrange(40)}" for _ in range(rng.choice([1, 5, 13, 14, 30])))) for i in range(30)] + [(90, None), (91, "--"), (3, "w1 w2 w3")]
    docs = []
    for i in range(80):
        own = [f"w{rng.randrange(60)}" for _ in range(rng.randint(0, 60))]
        if rng.random() < 0.5:
            own += (rng.choice(items)[1] or "").split()[: rng.choice([4, 13, 40])]
        docs.append((i, rng.choice([" ", ", ", "\n"]).join(own)))
    docs += [(200, None), (201, ""), (202, "!!!"), (203, docs[3][1]), (203, docs[3][1])]
    benchmark = spark.createDataFrame(items, "item_id long, text string")
    names = ("doc_id", "n_words", "n_hit", "n_items", "items_sha256", "contaminated")
    want = sorted(brute.contamination(docs, items), key=repr)
    assert rows(decontaminate.judge(decontaminate.find(frame(docs), benchmark)), *names) == want
    assert rows(decontaminate.judge(decontaminate.find(frame(docs), benchmark, block_words=40)), *names) == want
    assert rows(decontaminate.judge(decontaminate.find(frame(docs), benchmark.limit(0))), "n_hit") == [(0,)] * len(docs)
    assert decontaminate.find(frame([]), benchmark).count() == 0


def check_packing(docs, placed, capacity):
    encoder = Tokenizer.from_file(packing.default_tokenizer())
    by_doc, by_sequence = {}, {}
    for r in placed:
        by_doc.setdefault(r["doc_id"], []).append(r)
        by_sequence.setdefault(r["sequence_id"], []).append(r)
    for doc, text in docs:
        ids = [*encoder.encode(text or "", add_special_tokens=False).ids, 2]
        own = sorted(by_doc[doc], key=lambda r: r["piece"])
        assert [r["start"] for r in own] == [sum(x["length"] for x in own[:k]) for k in range(len(own))]
        assert sum(r["length"] for r in own) == len(ids) and all(r["length"] == capacity for r in own[1:])
        for r in own:
            assert r["ids_crc32"] == zlib.crc32(np.array(ids[r["start"] : r["start"] + r["length"]], "<u4").tobytes())
    for own in by_sequence.values():
        own.sort(key=lambda r: r["offset"])
        assert [r["offset"] for r in own] == [sum(x["length"] for x in own[:k]) for k in range(len(own))]
        assert sum(r["length"] for r in own) <= capacity
    return len(by_sequence)


def test_packing(frame):
    rng = random.Random(9)
    docs = [(i, prose(rng, rng.randint(0, 60))) for i in range(150)] + [(500, None), (501, ""), (502, prose(rng, 400)), (503, "<|endoftext|> a b")]
    placed = packing.pack(frame(docs), capacity=128).collect()
    used = check_packing(docs, placed, 128)
    assert used <= 1.03 * sum(r["length"] for r in placed) / 128 + 1
    assert packing.pack(frame([])).count() == 0
    assert packing.pack(frame([(1, "a"), (1, "a"), (None, "a")])).count() == 3


def test_long_texts_are_cut_where_no_token_spans(monkeypatch):
    encode = packing.load_encoder(packing.default_tokenizer())
    rng = random.Random(1)
    text = "".join(rng.choice(["word", " ", "  ", "\n", "é", "it's", "12", "!", " a"]) for _ in range(4000))
    whole = packing.token_ids(text, encode, 2).tolist()
    monkeypatch.setattr(packing, "CHUNK", 50)
    assert packing.np.concatenate([packing.np.asarray(encode(p)) for p in packing.safe_parts(text, 50)]).tolist() + [2] == whole
    assert whole[:-1] == Tokenizer.from_file(packing.default_tokenizer()).encode(text, add_special_tokens=False).ids


def test_pipeline(spark):
    folder = "/root/testdata/sf0.001"
    placed = corpus_pipeline.run(spark, folder)
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    ids = {r["doc_id"] for r in placed.select("doc_id").distinct().collect()}
    assert 0 < len(ids) <= docs.count()
    labels = spark.read.parquet(f"{folder}/labels.parquet").collect()
    clean = [r for r in labels if r["quality"] == 1 and not r["toxic"]]
    kept = sum(r["doc_id"] in ids for r in clean)
    assert kept >= 0.8 * len(clean)
    assert [name for name, _ in corpus_pipeline.STAGES] == ["quality classifier", "line dedup", "n-gram Jaccard join", "benchmark decontamination", "best-fit packing"]


def test_pipeline_stages_against_plain_versions(spark):
    """Every stage on what the one before left; packing by what it has to keep."""
    folder = "/root/testdata/sf0.001"
    stages = [stage for _, stage in corpus_pipeline.STAGES]
    given = spark.read.parquet(f"{folder}/documents.parquet")

    def held(df):
        return sorted(((r.doc_id, r.text) for r in df.collect()), key=repr)

    docs = base.materialize(stages[0](spark, given, folder), "stage")
    rows = held(docs)
    assert set(rows) <= set(held(given))
    docs = base.materialize(stages[1](spark, docs, folder), "stage")
    assert docs.columns == given.columns
    assert [(d, brute.sha((t or "").encode())) for d, t in held(docs)] == sorted(((d, sha) for d, _, _, sha in brute.lines(rows)), key=lambda r: repr((r[0],)))
    rows = held(docs)
    docs = base.materialize(stages[2](spark, docs, folder), "stage")
    least = {d for d, n, component in brute.components(rows, 5, 80) if component == d or not n}
    assert held(docs) == [r for r in rows if r[0] in least]
    rows = held(docs)
    docs = base.materialize(stages[3](spark, docs, folder), "stage")
    items = [(r.item_id, r.text) for r in spark.read.parquet(f"{folder}/benchmark.parquet").collect()]
    clean = {r[0] for r in brute.contamination(rows, items) if not r[-1]}
    assert held(docs) == [r for r in rows if r[0] in clean]
    pieces = stages[4](spark, docs, folder).collect()
    assert {p.doc_id for p in pieces} == clean
    filled = {}
    for p in sorted(pieces, key=lambda p: (p.sequence_id, p.offset)):
        assert p.offset == filled.get(p.sequence_id, 0)
        filled[p.sequence_id] = p.offset + p.length
    assert max(filled.values()) <= 1024


@pytest.mark.parametrize("empty", [False, True])
def test_pipeline_stages_take_odd_tables(spark, empty):
    """Null ids and texts, equal rows, a very long text, no rows at all."""
    folder = "/root/testdata/sf0.001"
    given = spark.read.parquet(f"{folder}/documents.parquet").limit(0)
    odd = [(None, "some words " * 9, None, None, None), (1, None, "en", "s", None), (2, "", "en", "s", 0), (3, "the long " * 60_000, "en", "s", 9)]
    docs = given if empty else given.unionByName(spark.createDataFrame([*odd, odd[0], odd[3]], given.schema))
    for _, stage in corpus_pipeline.STAGES[1:-1]:
        docs = base.materialize(stage(spark, docs, folder), "stage")
        assert docs.columns == given.columns
    assert empty == docs.isEmpty()
    assert corpus_pipeline.STAGES[-1][1](spark, docs, folder).count() >= docs.count()


def test_every_query_runs(spark):
    for name, query in queries.QUERIES.items():
        frame = query(spark, "/root/testdata/sf0.001")
        assert frame.count() >= 1, name
