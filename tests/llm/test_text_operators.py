"""Similarity join, the two substring operators and quality rules against brute force."""

import numpy as np
import pytest
from llm import brute, cases

from tierwise.llm import repeats
from tierwise.llm import substring_dedup as substring_dedup_module
from tierwise.llm import suffix_dedup as suffix_dedup_module
from tierwise.llm.ngram_join import (choose_boundary, keep_one_of_each, light_subset_sizes,
                                     ngram_jaccard_join, overlap_needed)
from tierwise.llm.quality import keep_good, quality_rules, trusted_ids
from tierwise.llm.scratch import Scratch
from tierwise.llm.substring_dedup import deep_nodes, neighbour_lengths, substring_dedup, word_units
from tierwise.llm.suffix_dedup import RunLengthIndex, suffix_dedup, suffix_order
from tierwise.llm.text import chunks, row_shingles, words

ROWS = cases.documents()


def test_components_equal_brute_force(spark):
    got = {r.doc_id: (r.n_shingles, r.component_id)
           for r in ngram_jaccard_join(spark, cases.frame(spark, ROWS)).documents.collect()}
    want = brute.components(ROWS)
    assert got == {i: (len(brute.shingles(t)), want[i]) for i, t in ROWS}
    assert any(i != c for i, c in want.items())


def test_light_sets_meet_by_subsets(spark):
    rng = np.random.default_rng(4)
    rows = [(i, " ".join(rng.choice(list("abcdefg"), rng.integers(5, 19)))) for i in range(150)]
    base = " ".join("abcdefghijklmnop")
    rows += [(200 + k, base + " " + " ".join("qrstuvw"[:k])) for k in range(6)]
    got = {r.doc_id: r.component_id
           for r in ngram_jaccard_join(spark, cases.frame(spark, rows)).documents.collect()}
    assert got == brute.components(rows)


def test_subset_sizes_cover_every_partner():
    for size in range(1, 15):
        for other in range(1, 15):
            need = overlap_needed(size, other, 80)
            if need <= min(size, other):
                assert need in light_subset_sizes(size, 14, 80)
    assert choose_boundary(0.0, 80) <= choose_boundary(50.0, 80)


def test_join_of_repeated_null_and_empty_rows(spark):
    rows = [(1, "a b c d e f g"), (1, "a b c d e f g"), (2, "a b c d e f g"), (None, "a b c d e f g"),
            (None, "lonely words are here today"), (3, None)]
    got = sorted(((r.doc_id, r.n_shingles, r.component_id) for r in
                  ngram_jaccard_join(spark, cases.frame(spark, rows)).documents.collect()), key=str)
    assert got == sorted([(1, 3, 1), (1, 3, 1), (2, 3, 1), (None, 3, 1), (None, 1, None), (3, 0, 3)], key=str)
    empty = ngram_jaccard_join(spark, cases.frame(spark, [])).documents
    assert empty.count() == 0


def test_one_of_each_group_stays(spark):
    rows = ROWS + [ROWS[0], ROWS[0], (None, "no id here at all"), (None, "no id here at all")]
    docs = cases.frame(spark, rows)
    got = keep_one_of_each(spark, docs)
    want = brute.components(ROWS)
    assert got.columns == docs.columns
    ids = sorted((r.doc_id for r in got.collect()), key=str)
    assert ids == sorted([i for i, c in want.items() if i == c] + [None, None], key=str)


@pytest.mark.parametrize("wide,crowded", [(5000, 1 << 21), (1, 1 << 21), (1, 60), (5000, 60)])
def test_substring_dedup_equals_brute_force(spark, monkeypatch, wide, crowded):
    monkeypatch.setattr(repeats, "WIDE_ANCHOR", wide)
    monkeypatch.setattr(repeats, "CROWDED_UNITS", crowded)
    got = {r.doc_id: (r.n_words, r.kept) for r in substring_dedup(spark, cases.frame(spark, ROWS)).collect()}
    want = brute.substring_dedup(ROWS)
    assert got == want
    assert any(kept != " ".join(brute.WORD.findall(t or "")) for (i, t), (_, kept) in zip(ROWS, want.values()))


@pytest.mark.parametrize("wide,crowded", [(5000, 1 << 21), (1, 1 << 21), (1, 120), (5000, 120)])
def test_suffix_dedup_equals_brute_force(spark, monkeypatch, wide, crowded):
    monkeypatch.setattr(repeats, "WIDE_ANCHOR", wide)
    monkeypatch.setattr(repeats, "CROWDED_UNITS", crowded)
    rows = [r for r in ROWS if r[0] != 112]
    got = {r.doc_id: (r.n_bytes, bytes(r.kept), len(r.removed))
           for r in suffix_dedup(spark, cases.frame(spark, rows)).collect()}
    assert got == brute.suffix_dedup(rows)


@pytest.mark.parametrize("limit", [4000, 1 << 21])
def test_a_line_in_every_text_makes_no_large_group(spark, monkeypatch, limit):
    """A shared line shorter than a window, amid different words: its group meets by window hashes."""
    monkeypatch.setattr(repeats, "CROWDED_UNITS", limit)
    rng = __import__("random").Random(4)
    line, words = cases.prose(rng, 49), [f"w{k}" for k in range(3000)]
    text = lambda: " ".join(rng.choice(words) for _ in range(12))
    rows = [(k, f"{text()} {line} {rng.choice('ab')} {text()}") for k in range(300)]
    saved = {}

    class Spy(Scratch):
        def save_observed(self, df, name, sums):
            out = super().save_observed(df, name, sums)
            saved.setdefault(name, []).append(out[1])
            return out
    monkeypatch.setattr(substring_dedup_module, "Scratch", Spy)
    monkeypatch.setattr(suffix_dedup_module, "Scratch", Spy)
    got = {r.doc_id: (r.n_words, r.kept) for r in substring_dedup(spark, cases.frame(spark, rows)).collect()}
    assert got == brute.substring_dedup(rows)
    got = {r.doc_id: (r.n_bytes, bytes(r.kept), len(r.removed))
           for r in suffix_dedup(spark, cases.frame(spark, rows)).collect()}
    assert got == brute.suffix_dedup(rows)
    assert any(n > 0 for (n,) in saved["crowded"]) == (limit == 4000)


def test_substring_operators_on_odd_rows(spark):
    passage = cases.prose(__import__("random").Random(2), 80)
    rows = [(5, passage), (5, passage), (None, passage), (7, None)]
    got = sorted(((r.doc_id, len(r.kept.split())) for r in
                  substring_dedup(spark, cases.frame(spark, rows)).collect()), key=str)
    assert got == sorted([(5, 80), (5, 80), (None, 0), (7, 0)], key=str)
    got = sorted(((r.doc_id, len(r.kept)) for r in
                  suffix_dedup(spark, cases.frame(spark, rows)).collect()), key=str)
    size = len(passage.encode())
    assert got == sorted([(5, size), (5, size), (None, 0), (7, 0)], key=str)
    assert substring_dedup(spark, cases.frame(spark, [])).count() == 0
    assert suffix_dedup(spark, cases.frame(spark, [])).count() == 0


def test_run_length_index_has_exact_matching_statistics():
    rng = np.random.default_rng(3)
    text = np.concatenate([rng.integers(3, 6, 60), [0], np.tile([3, 4], 30), [1], rng.integers(3, 5, 50), [2]])
    order = suffix_order(text)
    assert [tuple(text[i:]) for i in order] == sorted(tuple(text[i:]) for i in range(len(text)))
    index = RunLengthIndex(text)
    assert index.lengths.sum() == len(text) and (index.symbols[1:] != index.symbols[:-1]).all()
    match, length = index.matching_statistics(text)
    place = {int(i): k for k, i in enumerate(order)}
    for i in range(len(text)):
        if place[i]:
            j = int(order[place[i] - 1])
            common = 0
            while max(i, j) + common < len(text) and text[i + common] == text[j + common]:
                common += 1
            assert length[i] == common
            assert not common or match[i] == j


def test_suffix_tree_nodes_equal_brute_force():
    rng = np.random.default_rng(7)
    for size, kinds in ((1, 2), (60, 2), (200, 3), (200, 40)):
        text = np.concatenate([rng.integers(2, 2 + kinds, size), [0], rng.integers(2, 2 + kinds, size),
                               np.tile([2, 3], 8), [1]])
        order = suffix_order(text)
        lengths = neighbour_lengths(text, order)
        same = lambda a, b: next((k for k in range(len(text) - max(a, b)) if text[a + k] != text[b + k]),
                                 len(text) - max(a, b))
        assert lengths.tolist() == [0] + [same(a, b) for a, b in zip(order[:-1], order[1:])]
        begin, end, depth = deep_nodes(lengths, 4)
        groups = {}
        for i in range(len(text) - 3):
            groups.setdefault(tuple(text[i:i + 4]), []).append(i)
        want = sorted(sorted(g) for g in groups.values() if len(g) > 1)
        assert sorted(sorted(order[b:e].tolist()) for b, e in zip(begin, end)) == want
        for b, e, d in zip(begin, end, depth):
            leaves = order[b:e]
            assert d == min(same(leaves[0], x) for x in leaves[1:]) >= 4
    assert [len(x) for x in deep_nodes(np.zeros(0, np.int64), 4)] == [0, 0, 0]


def test_a_group_of_suffixes_marks_all_but_the_smallest_document():
    rng = np.random.default_rng(11)
    for _ in range(40):
        parts = [rng.integers(0, 3, rng.integers(5, 30)).astype(np.uint64) for _ in range(rng.integers(1, 9))]
        docs = np.sort(rng.integers(0, 5, len(parts)))
        offs = np.concatenate([[0], np.cumsum([len(p) for p in parts])])
        got = word_units(5).resolve(np.concatenate(parts), offs, docs)
        first = {}
        for p, d in zip(parts, docs):
            for i in range(len(p) - 4):
                first.setdefault(tuple(p[i:i + 5]), d)
        want = [i + 5 <= len(p) and first[tuple(p[i:i + 5])] < d for p, d in zip(parts, docs) for i in range(len(p))]
        assert got.tolist() == want


def test_stretches_hold_every_window_once():
    rng = np.random.default_rng(1)
    first = np.array([0, 40, 40, 45, 200])
    lo, hi, _ = repeats.stretches(rng.integers(0, 5, 198).astype(np.uint64), first, 12, 3)
    starts = [s for a, b in zip(lo, hi) for s in range(a, b + 1)]
    assert starts == [*range(0, 29), *range(45, 189)]


def test_chunks_and_words_follow_the_pattern():
    import pyarrow as pa
    texts = ["a  b\x0bc", None, "", "é\x1cf g", " x", "y "]
    batch = pa.record_batch([pa.array(texts)], names=["text"])
    got = []
    for part, data, offs in chunks(batch, "text", limit=4):
        starts, ends, first = words(data, offs)
        for k in range(part.num_rows):
            got.append([bytes(data[s:e]).decode() for s, e in
                        zip(starts[first[k]:first[k + 1]], ends[first[k]:first[k + 1]])])
    assert got == [brute.WORD.findall(t or "") for t in texts]
    sizes = [len(s) for _, data, offs in chunks(batch, "text") for s in row_shingles(data, offs, 5)]
    assert sizes == [len(brute.shingles(t)) for t in texts]


def test_quality_features_equal_brute_force(spark):
    rows = ROWS + [(300, "a|b #c\n a|b #c\nx\n\nx\n x"), (301, "w " * 60), (302, "p q r p q r p q")]
    labels = spark.createDataFrame([(i, int(i % 2), 0) for i in range(40)], "doc_id long, quality int, toxic int")
    got = {r.doc_id: r for r in quality_rules(cases.frame(spark, rows), trusted_ids(labels)).collect()}
    for i, text in rows:
        want = brute.quality_base(text)
        r = got[i]
        assert (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words) == want
        assert r.base_failed == (want[0] < 50 or 100 * want[4] > 50 * want[0])
        assert not (r.base_failed and r.kept)


def test_quality_verdict_tells_junk_from_prose(spark):
    rng = __import__("random").Random(8)
    good = [(i, cases.prose(rng, 80)) for i in range(60)]
    junk = [(100 + i, " ".join(rng.choice(["zz##", "qq$$", "vv||"]) + rng.choice("abcdefgh") for _ in range(80)))
            for i in range(20)]
    labels = spark.createDataFrame([(i, 1, 0) for i in range(30)], "doc_id long, quality int, toxic int")
    docs = cases.frame(spark, good + junk)
    got = {r.doc_id: r for r in quality_rules(docs, trusted_ids(labels)).collect()}
    assert all(got[i].kept for i, _ in good)
    assert not any(got[i].kept for i, _ in junk)
    again = {r.doc_id: r.llr_millionths for r in quality_rules(docs.repartition(7), trusted_ids(labels)).collect()}
    assert again == {i: r.llr_millionths for i, r in got.items()}
    kept = keep_good(docs, trusted_ids(labels))
    assert kept.columns == docs.columns
    assert {r.doc_id for r in kept.collect()} == {i for i, _ in good}


def test_quality_verdicts_equal_brute_force(spark):
    rows = ROWS + [(1, ROWS[1][1]), (None, ROWS[2][1])]
    labels = spark.createDataFrame([(i, int(i % 3 == 1), int(i == 4)) for i in range(40)] + [(7, 1, None), (None, 1, 0)],
                                   "doc_id int, quality int, toxic int")
    found = quality_rules(cases.frame(spark, rows), trusted_ids(labels)).collect()
    scores = brute.quality_scores(rows, {i for i in range(40) if i % 3 == 1 and i != 4})
    want = []
    for (i, text), score in zip(rows, scores):
        base = brute.quality_base(text)
        failed = base[0] < 50 or 100 * base[4] > 50 * base[0]
        want.append((i, score, not failed and score >= -150_000 * (2 * base[0] - 1)))
    assert sorted(((r.doc_id, r.llr_millionths, r.kept) for r in found), key=str) == sorted(want, key=str)
    assert len(set(scores)) > 20 and {k for _, _, k in want} == {True, False}


def test_quality_without_labels_or_rows(spark):
    none = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    rows = [(1, cases.prose(__import__("random").Random(1), 60)), (2, None), (None, "short")]
    got = {r.doc_id: r.kept for r in quality_rules(cases.frame(spark, rows), trusted_ids(none)).collect()}
    assert got == {1: True, 2: False, None: False}
    assert quality_rules(cases.frame(spark, []), trusted_ids(none)).count() == 0
