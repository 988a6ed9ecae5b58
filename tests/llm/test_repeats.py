"""Line dedup, seed and extend, suffix-array repeats and the shingle join against plain versions."""

import random
import zlib

import brute
import numpy as np
import pytest

from tidebook.llm import line_dedup, ngram_join, seed_extend, seeds, suffix_repeats
from tidebook.llm.cuckoo import CuckooFilter

ODD = [
    [],
    [(1, None)],
    [(1, ""), (2, "  \n\t")],
    [(None, "a b c " * 30), (None, "a b c " * 30), (3, "a b c " * 30)],
    [(7, "same words here " * 20), (7, "same words here " * 20)],
    [(1, "long " * 3000 + "end"), (2, "x" * 5000)],
]


@pytest.mark.parametrize("seed", [0, 1])
def test_words_repeat(frame, rows, seed, monkeypatch):
    if seed:
        monkeypatch.setattr(seed_extend, "SLICE", 200)
    docs = brute.texts(random.Random(seed))
    for length, gram in ((20, 6), (8, 3)):
        got = rows(seed_extend.remove(frame(docs), length, gram), "doc_id", "n_words", "n_removed", "kept_sha256")
        assert got == sorted(brute.word_windows(docs, length), key=repr)


@pytest.mark.parametrize("seed", [0, 1])
def test_bytes_repeat(frame, rows, seed, monkeypatch):
    if seed:
        monkeypatch.setattr(suffix_repeats, "SLICE", 1000)
    docs = brute.texts(random.Random(seed))
    for length, gram, group in ((60, 10, 20_000), (33, 20, 3)):
        got = rows(suffix_repeats.remove(frame(docs), length, gram, group), "doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256")
        assert got == sorted(brute.byte_windows(docs, length), key=repr)


@pytest.mark.parametrize("case", range(len(ODD)))
def test_repeats_of_odd_tables(frame, rows, case):
    docs = ODD[case]
    distinct = len({d for d, _ in docs}) == len(docs)
    got = rows(suffix_repeats.remove(frame(docs), 40, 8), "doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256")
    assert got == sorted(brute.byte_windows(docs, 40), key=repr)
    words = rows(seed_extend.remove(frame(docs), 10, 3), "doc_id", "n_words", "n_removed", "kept_sha256")
    assert len(words) == len(docs)
    if distinct:
        assert words == sorted(brute.word_windows(docs, 10), key=repr)


REPEATED = [
    *ODD,
    [(None, "one text of all without an id " * 9)] * 5,
    [(4, " ".join(f"w{i}" for i in range(60)))] * 4 + [(9, " ".join(f"w{i}" for i in range(20, 80)))] * 3,
    [(4, " ".join(f"v{i % 37}" for i in range(90)))] * 3 + [(None, "x y z " + " ".join(f"v{i}" for i in range(5, 37)))] * 3,
    [((1 << 63) - 1, "largest id and no id are two " * 4), (None, "largest id and no id are two " * 4)],
]


@pytest.mark.parametrize("parts", [1, 3])
@pytest.mark.parametrize("case", range(len(REPEATED)))
def test_equal_rows_are_one_document_to_words(frame, rows, case, parts):
    docs = REPEATED[case]
    got = rows(seed_extend.remove(frame(docs, parts), 10, 3), "doc_id", "n_words", "n_removed", "kept_sha256")
    assert got == sorted(brute.word_windows(docs, 10), key=repr)
    spans = rows(suffix_repeats.remove(frame(docs, parts), 40, 8), "doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256")
    assert spans == sorted(brute.byte_windows(docs, 40), key=repr)


def same_checksum(text, words):
    """A text of other words with the same last 16 bits of its CRC-32."""
    return next(t for i in range(1 << 22) if zlib.crc32((t := f"{words} e{i}").encode()) % (1 << 16) == zlib.crc32(text.encode()) % (1 << 16))


@pytest.mark.parametrize("doc_id", [None, 5])
@pytest.mark.parametrize("size", [18, 130])
def test_texts_of_one_id_stay_apart(frame, rows, doc_id, size):
    passage = " ".join(f"p{i}" for i in range(40))
    text = " ".join(f"a{i}" for i in range(60)) + " " + passage
    other = same_checksum(text, " ".join(f"b{i}" for i in range(size)))
    docs = [(1, passage), (2, "before " + passage + " behind"), (doc_id, text), (doc_id, other)]
    assert rows(seed_extend.remove(frame(docs), 10, 3), "doc_id", "n_words", "n_removed", "kept_sha256") == sorted(brute.word_windows(docs, 10), key=repr)
    got = rows(suffix_repeats.remove(frame(docs), 40, 8), "doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256")
    assert got == sorted(brute.byte_windows(docs, 40), key=repr)


def test_interval_tree_finds_groups_with_all_members():
    before = [b"abc"[::-1], b"abc"[::-1], b"xbc"[::-1], b"zzz"]
    after = [b"hello world", b"hello world", b"hello there", b"other"]
    found = suffix_repeats.maximal_repeats(before, after, 6)
    assert (2, 6, [0, 1, 2]) in found and (3, 11, [0, 1]) in found


def test_winnowing_meets_every_common_run():
    rng = np.random.default_rng(3)
    shape = seeds.Shape(30, 8, 1 << 10)
    common = rng.integers(0, 4, 30).astype(np.uint8)
    for _ in range(50):
        places = []
        for _ in range(2):
            own = rng.integers(0, 4, 200).astype(np.uint8)
            at = int(rng.integers(0, 170))
            own[at : at + 30] = common
            found = seeds.anchors(list(seeds.pieces(0, own, shape)), shape, seeds.Powers())[1]
            places.append({p - at for p in found.tolist() if at <= p <= at + 22})
        assert places[0] & places[1]


def line_rows(docs, frame, rows):
    kept = line_dedup.drop_lines(frame(docs), line_dedup.LineIndex.build(frame(docs), sieve=False))
    assert kept.columns[:2] == ["doc_id", "text"] and kept.columns[-2:] == ["n_lines", "n_dropped"]
    return sorted(((d, n, k, brute.sha(t.encode())) for d, n, k, t in rows(kept, "doc_id", "n_lines", "n_dropped", "text")), key=repr)


def line_docs(seed=0, count=60):
    rng = random.Random(seed)
    shared = [f"Shared line number {i} with more than forty characters in it" for i in range(8)]
    short = ["too short", "", "  \t "]
    docs = [(i, "\n".join(rng.choice(["  " + rng.choice(shared).upper(), rng.choice(shared), rng.choice(short), f"own {i} " * 8]) for _ in range(rng.randint(0, 9)))) for i in range(count)]
    return [*docs, (900, None), (901, ""), (902, "\n\n")]


def test_lines(frame, rows):
    docs = line_docs()
    assert line_rows(docs, frame, rows) == sorted(brute.lines(docs), key=repr)


@pytest.mark.parametrize("docs", [[], [(1, None)], [(None, "n" * 50)] * 6, [(i, "k" * 60 + "\n" + "k" * 60) for i in range(6)]])
def test_lines_of_odd_tables(frame, rows, docs):
    assert line_rows(docs, frame, rows) == sorted(brute.lines(docs), key=repr)


def test_inserting_and_deleting_is_reversible(spark, frame, rows):
    docs = line_docs(2)
    half = line_dedup.LineIndex.build(frame(docs[:30]))
    both = half.insert(frame(docs[30:]))
    fresh = line_dedup.LineIndex.build(frame(docs), sieve=False)
    assert rows(both.repeated(), "key", "documents", "keeper") == rows(fresh.repeated(), "key", "documents", "keeper")
    back = both.delete(frame(docs[30:]))
    assert rows(back.refs, "key", "doc_id") == rows(half.refs, "key", "doc_id")
    for index in (both, back):
        known = line_dedup.probe(index.refs, index.sieve, index.shards).count()
        assert known == index.refs.count()
    gone = both.refs.join(back.refs.select("key"), "key", "left_anti")
    assert line_dedup.probe(gone, back.sieve, back.shards).count() <= max(1, gone.count() // 20)
    again = back.insert(frame(docs[30:]))
    assert rows(again.repeated(), "key", "documents", "keeper") == rows(fresh.repeated(), "key", "documents", "keeper")


def test_cuckoo_filter():
    rng = np.random.default_rng(1)
    keys = rng.integers(0, 1 << 63, 20_000).astype(np.uint64)
    made = CuckooFilter.from_bytes(CuckooFilter.of(keys).to_bytes())
    assert made.contains(keys).all()
    others = rng.integers(0, 1 << 63, 20_000).astype(np.uint64)
    assert made.contains(others).mean() < 0.01
    made.delete(keys[:10_000])
    assert made.contains(keys[10_000:]).all() and made.contains(keys[:10_000]).mean() < 0.01
    assert not CuckooFilter.of(np.empty(0, np.uint64)).contains(others).any()


def similar_docs(seed):
    rng = random.Random(seed)
    size = 500 if seed % 2 else 60
    base = [f"w{rng.randrange(size)}" for _ in range(rng.choice([12, 40, 150]))]
    common = [f"c{i}" for i in range(30)]
    docs = []
    for i in range(120):
        if rng.random() < 0.55:
            if rng.random() < 0.2:
                base = [f"w{rng.randrange(500)}" for _ in range(rng.choice([3, 8, 12, 40, 150, 151, 180, 210]))]
            own = list(base)
            for _ in range(rng.choice([0, 0, 1, 1, 2, 3, 6])):
                at = rng.randrange(len(own) + 1)
                own[at : at + rng.randint(0, 2)] = [f"e{rng.randrange(50)}"] * rng.randint(0, 2)
        else:
            own = [f"w{rng.randrange(500)}" for _ in range(rng.randint(0, 30))] + common
        docs.append((i, " ".join(own)))
    return [*docs, (500, None), (501, ""), (502, "A b C d"), (503, "a B c D"), (504, docs[3][1]), (505, docs[3][1])]


@pytest.mark.parametrize("seed", [0, 1])
def test_components_of_similar_sets(frame, rows, seed):
    docs = similar_docs(seed)
    for size, percent, frequent in ((4, 85, 64), (5, 80, 4), (4, 85, 2)):
        got = rows(ngram_join.groups(frame(docs), size, percent, frequent), "doc_id", "n_shingles", "component_id")
        assert sorted(got) == brute.components(docs, size, percent)


def test_deletion_neighbourhoods_lose_no_link(frame, rows, monkeypatch):
    def deep(low, high, percent, sets):
        most = ngram_join.most_different(2 * (high - 1), percent)
        segments = most // 2 + 1
        return ngram_join.Band(low, high, segments, segments, most)

    monkeypatch.setattr(ngram_join, "allocate", deep)
    docs = similar_docs(3)
    assert sorted(rows(ngram_join.groups(frame(docs)), "doc_id", "n_shingles", "component_id")) == brute.components(docs, 4, 85)


def test_sketches_never_differ_by_more_than_the_sets():
    rng = np.random.default_rng(5)
    for most in (0, 3, 32, 300):
        for _ in range(50):
            one = np.unique(rng.integers(0, 1 << 63, rng.integers(0, 400), dtype=np.uint64))
            two = np.unique(np.concatenate([one[rng.random(len(one)) < 0.9], rng.integers(0, 1 << 63, rng.integers(0, 40), dtype=np.uint64)]))
            x, y = (ngram_join.sketch_of(elements, most) for elements in (one, two))
            assert len(x) == len(y) == max(1, -(-ngram_join.SHARP * most // 64))
            assert np.bitwise_count((x ^ y).view(np.uint64)).sum() <= len(np.setxor1d(one, two))


def test_folded_sketches_never_differ_by_more_than_the_sets():
    rng = np.random.default_rng(6)
    for most in (0, 3, 32, 77, 300):
        for _ in range(50):
            one = np.unique(rng.integers(0, 1 << 63, rng.integers(0, 400), dtype=np.uint64))
            two = np.unique(np.concatenate([one[rng.random(len(one)) < 0.9], rng.integers(0, 1 << 63, rng.integers(0, 40), dtype=np.uint64)]))
            whole = ngram_join.sketch_of(one, most)
            x, y = ngram_join.folded(whole), ngram_join.folded(ngram_join.sketch_of(two, most))
            assert len(x) == len(y) == -(-len(whole) // ngram_join.FOLD)
            assert np.bitwise_count((x ^ y).view(np.uint64)).sum() <= len(np.setxor1d(one, two))


@pytest.fixture
def broadcast_64k(spark):
    name = "spark.sql.autoBroadcastJoinThreshold"
    before = spark.conf.get(name)
    spark.conf.set(name, "64k")
    yield
    spark.conf.set(name, before)


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_few_frequent_keys_move_no_rows(spark, rows, broadcast_64k, monkeypatch):
    met = spark.range(40_000).selectExpr(
        "if(id < 100, 7L, xxhash64(id div 2))", "xxhash64(id, 1)", "if(id < 80, 512, 512 * 3) + 1", "1", "xxhash64(id, 1)", "if(id < 100, 100L, 2L)"
    )
    met = ngram_join.base.materialize(met.toDF("sig", "doc", "info", "n", "leader", "total"), "met")
    plans, write = {}, ngram_join.base.materialize
    monkeypatch.setattr(ngram_join.base, "materialize", lambda df, name: plans.update({name: plan_of(df)}) or write(df, name))
    held, hot = ngram_join.parted(met, 64)
    assert "Exchange hashpartitioning" not in plans["parted"]
    assert held.count() == 39_900 and rows(hot.groupBy("sig").count(), "sig", "count") == [(7, 80)]


def test_texts_move_for_their_pairs_only(spark, rows, broadcast_64k):
    texts = spark.range(5_000).selectExpr("id AS doc", "concat_ws(' ', sha2(string(id), 512), sha2(string(-id), 512)) AS text")
    texts = ngram_join.base.materialize(texts, "texts")
    pairs = ngram_join.base.materialize(spark.createDataFrame([(5, 1), (9, 1), (9, 9_000)], "a long, b long"), "pairs")
    found = ngram_join.texts_of_pairs(pairs, texts)
    assert plan_of(found).count("BroadcastHashJoin") >= 2 and "LeftSemi" in plan_of(found)
    assert rows(found, "a", "b") == [(5, 1), (9, 1)]


@pytest.fixture
def no_broadcast(spark):
    name = "spark.sql.autoBroadcastJoinThreshold"
    before = spark.conf.get(name)
    spark.conf.set(name, "-1")
    yield
    spark.conf.set(name, before)


@pytest.mark.parametrize("shares", [1, 64])
def test_texts_move_once_for_both_ends_of_pairs(spark, rows, no_broadcast, shares):
    texts = ngram_join.base.materialize(spark.range(50).selectExpr("id AS doc", "sha2(string(id), 256) AS text"), "texts")
    pairs = ngram_join.base.materialize(spark.createDataFrame([(5, 1), (9, 1), (9, 90)], "a long, b long"), "pairs")
    found = ngram_join.texts_of_pairs(pairs, texts, shares)
    assert rows(found, "a", "b") == [(5, 1), (9, 1)]
    found.collect()
    assert "ReusedExchange" in plan_of(found)


def test_keys_of_two_sets_are_settled_with_their_leader(frame, rows, monkeypatch):
    given, across = [], ngram_join.across_components
    monkeypatch.setattr(ngram_join, "across_components", lambda met, *more: given.append(met) or across(met, *more))
    docs = []
    for i in range(30):
        words = [f"w{i}x{j}" for j in range(80)]
        docs += [(2 * i, " ".join(words)), (2 * i + 1, " ".join([*words[:40], f"other{i}", *words[40 + 8 * (i % 3) :]]))]
    got = rows(ngram_join.groups(frame(docs)), "doc_id", "n_shingles", "component_id")
    assert sorted(got) == brute.components(docs, 4, 85) and len({row[2] for row in got}) > 30
    assert given[0].groupBy("sig").count().filter("count > 1").isEmpty()


def test_sets_with_too_few_keys_are_left_out(spark, rows):
    met = [(key, 1, 1, 0, 3, False) for key in (1, 2, 3)] + [(key, 2, 1, 0, 3, key == 1) for key in (1, 2)] + [(key, 3, 1, 0, 2, False) for key in (2, 3)]
    met = spark.createDataFrame(met, "sig long, doc long, leader long, instance int, demand int, direct boolean")
    assert rows(ngram_join.bonds_of(met), "doc", "leader", "shared", "demand") == [(1, 1, 3, 3), (3, 1, 2, 2)]


def test_rows_without_links_do_not_meet_by_their_component(frame, rows):
    docs = [(i, " ".join(f"{i}word{j}" for j in range(20))) for i in range(50)] + [(50, "a b c d e f"), (51, "a b c d e f")]
    named = ngram_join.groups(frame(docs))
    assert rows(named, "doc_id", "component_id") == sorted([(i, min(i, 50)) for i in range(52)], key=repr)
    assert "LeftOuter" not in plan_of(named)


@pytest.mark.parametrize("seed", [0, 1])
def test_components_after_more_links(spark, rows, seed):
    rng = random.Random(seed)
    first, more = ([(rng.randrange(120), rng.randrange(120)) for _ in range(n)] for n in (50, 30))
    first, more = (spark.createDataFrame(links, "a long, b long") for links in (first, more))
    whole = ngram_join.components(first.union(more))
    assert rows(ngram_join.merged(ngram_join.components(first), more).filter("node <> component"), "node", "component") == rows(whole.filter("node <> component"), "node", "component")


def test_shingles_of_odd_tables(frame, rows):
    assert rows(ngram_join.groups(frame([])), "doc_id") == []
    got = rows(ngram_join.groups(frame([(None, "a b c d e"), (4, "a b c d e"), (5, None), (4, "a b c d e")])), "doc_id", "component_id")
    assert got == [(4, 4), (4, 4), (5, 5), (None, 4)]
    kept = rows(ngram_join.representatives(frame([(4, "q w e r t y"), (4, "q w e r t y"), (6, "q w e r t y"), (5, None)]), 5, 80), "doc_id")
    assert kept == [(4,), (5,)]


def test_texts_of_one_id_are_linked_on_their_own(frame, rows):
    one, two, three = (" ".join(f"{x}{i}" for i in range(60)) for x in "abc")
    near = one.replace("a30 ", "other ")
    docs = [(1, one), (None, near), (2, two), (None, two), (None, three), (6, one), (6, three), (7, "p q r s t"), (7, "u v w x y"), (8, None), (8, "")]
    got = rows(ngram_join.groups(frame(docs), 4, 80), "doc_id", "component_id")
    assert got == sorted([(1, 1), (None, 1), (2, 2), (None, 2), (None, 6), (6, 1), (6, 6), (7, 7), (7, 7), (8, 8), (8, 8)], key=repr)
    kept = rows(ngram_join.representatives(frame([*docs, (7, "p q r s t"), (None, two)]), 4, 80), "doc_id", "text")
    assert kept == sorted([(1, one), (2, two), (6, three), (7, "p q r s t"), (7, "u v w x y"), (8, None), (8, "")], key=repr)


def test_rows_of_one_id_are_one_document(frame, rows):
    line = "a line that is long enough to be counted as a key"
    docs = [(1, line), (1, line + "\nx"), (1, line), (1, line), (2, line), (None, line), (None, "y\n" + line)]
    for given in (docs, [*docs, (3, line)]):
        kept = line_dedup.drop_lines(frame(given), line_dedup.LineIndex.build(frame(given), sieve=False))
        found = [(r.doc_id, r.n_lines, r.n_dropped, brute.sha(r.text.encode())) for r in kept.collect()]
        assert sorted(found, key=repr) == sorted(brute.lines(given), key=repr)
