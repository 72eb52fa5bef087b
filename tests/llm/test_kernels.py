"""The byte kernels and models against plain Python."""

import itertools
import random
import re
import zlib

import numpy as np
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from folia.llm import crf, decontamination, gru, linededup, neardup, packing, pii, suffixes, toxicity
from folia.llm.bytesops import chunks, texts, window_hashes

from .conftest import WORD, prose

TEXT = st.lists(st.text(alphabet="ab \n\té\U0001f600", max_size=30), max_size=6)


@settings(max_examples=60, deadline=None)
@given(TEXT)
def test_words_lines_and_fingerprints(values):
    t = texts(values)
    starts, ends, offsets = t.word_spans
    words = [t.raw(s, e).decode() for s, e in zip(starts, ends, strict=True)]
    assert [words[a:b] for a, b in zip(offsets[:-1], offsets[1:], strict=True)] == [WORD.findall(v) for v in values]
    assert len(set(words)) == len(set(t.hashes(starts, ends).tolist()))
    starts, ends, offsets = t.line_spans
    lines = [t.raw(s, e).decode() for s, e in zip(starts, ends, strict=True)]
    assert [lines[a:b] for a, b in zip(offsets[:-1], offsets[1:], strict=True)] == [v.split("\n") for v in values]


def test_chunks_keep_whole_texts_and_null_is_empty():
    column = pa.array(["abc", None, "d" * 50, "", "e"]).slice(1)

    rows = [t.raw(a, b).decode() for t in chunks(column, 10) for a, b in zip(t.offsets[:-1], t.offsets[1:], strict=True)]
    assert rows == ["", "d" * 50, "", "e"]


def test_windows_of_short_texts():
    t = texts(["a b c", "a b c d e", "", "a b c d e f"])
    starts, ends, offsets = t.word_spans
    found, _, places = window_hashes(t.hashes(starts, ends), offsets)
    assert np.diff(places).tolist() == [1, 1, 0, 2]
    assert found[1] == found[2] and found[0] != found[1]


def test_viterbi_is_the_best_of_all_paths():
    rng = np.random.default_rng(0)
    offsets = np.array([0, 4, 4, 5, 11])
    scores, transition = rng.normal(size=(11, 3)), rng.normal(size=(3, 3))
    got = crf.viterbi(scores, offsets, transition)
    share, _ = crf.marginals(scores, offsets, transition)
    for a, b in zip(offsets[:-1], offsets[1:], strict=True):
        paths = list(itertools.product(range(3), repeat=b - a))
        value = {p: sum(scores[a + i, y] for i, y in enumerate(p)) + sum(transition[x, y] for x, y in zip(p[:-1], p[1:], strict=True)) for p in paths}
        assert tuple(got[a:b]) == max(paths, key=value.get)
        if b > a:
            weight = {p: np.exp(v) for p, v in value.items()}
            first = sum(w for p, w in weight.items() if p[0] == 1) / sum(weight.values())
            assert share[a, 1] == pytest.approx(first)


def test_field_learns_from_neighbours():
    rng = np.random.default_rng(1)
    labels = np.tile([0, 1, 1], 200)
    features = np.stack([labels + rng.normal(0, 0.8, 600), np.ones(600)], 1)
    offsets = np.arange(0, 601, 30)
    model = crf.fit(features, labels, offsets, 2)
    chain = (model.decode(model.dense(features), offsets) == labels).mean()
    assert chain > ((features[:, 0] > 0.5) == labels).mean()


def test_cuckoo_filter_takes_in_and_out():
    rng = np.random.default_rng(2)
    keys = rng.integers(-(2**62), 2**62, 5000)
    f = linededup.Cuckoo.of(keys)
    assert f.contains(keys).all()
    assert f.contains(rng.integers(-(2**62), 2**62, 20000)).mean() < 0.001
    f.delete(keys[:2000])
    assert f.contains(keys[2000:]).all()
    assert f.contains(keys[:2000]).mean() < 0.01


def test_signatures_agree_as_often_as_the_weighted_similarity():
    words = prose(3, 400).split()
    rng = random.Random(5)
    other = [w if rng.random() > 0.02 else "changed" for w in words]
    t = texts([" ".join(words), " ".join(other), " ".join(words)])
    found, offsets = neardup.shingles(t)
    cells = neardup.units(found, offsets)
    best = neardup.signatures(cells, offsets, 1024)
    want = neardup.similarity(np.sort(found[: offsets[1]]), np.sort(found[offsets[1] : offsets[2]]))
    assert (best[0] == best[1]).mean() == pytest.approx(want, abs=0.06)
    assert (best[0] == best[2]).all()


def test_multi_index_finds_all_within_the_radius():
    rng = np.random.default_rng(3)
    items = rng.integers(0, 2**63, 60, dtype=np.uint64)
    queries = items[rng.integers(0, 60, 400)].copy()
    for i, q in enumerate(queries):
        for bit in rng.choice(64, i % 24, replace=False):
            q ^= np.uint64(1) << np.uint64(bit)
        queries[i] = q
    got = set(zip(*(x.tolist() for x in decontamination.MultiIndex(items).query(queries)), strict=True))
    want = {(i, j) for i, q in enumerate(queries) for j, x in enumerate(items) if bin(int(q) ^ int(x)).count("1") <= decontamination.RADIUS}
    assert got == want


def test_checksum_of_a_rest():
    raw = bytes(range(256)) * 9
    for cut in (0, 1, 64, 1000, len(raw)):
        assert packing.crc_of_rest(zlib.crc32(raw), zlib.crc32(raw[:cut]), len(raw) - cut) == zlib.crc32(raw[cut:])


def test_least_squares_are_not_negative_and_best():
    rng = np.random.default_rng(4)
    for _ in range(20):
        a, b = rng.normal(size=(8, 12)), rng.normal(size=8)
        x = packing.nnls(a, b)
        slope = a.T @ (b - a @ x)
        assert (x >= 0).all() and slope.max() < 1e-6 and np.abs(slope[x > 1e-9]).max(initial=0) < 1e-6


def test_plan_stays_within_the_histogram():
    rng = random.Random(6)
    histogram = {b: rng.randrange(200) for b in range(1, packing.BINS + 1)}
    used = dict.fromkeys(histogram, 0)
    for way, n in packing.plan(histogram):
        assert packing.BINS - 1 <= sum(way) <= packing.BINS and n > 0
        for b in way:
            used[b] += n
    assert all(used[b] <= n for b, n in histogram.items())
    assert sum(b * n for b, n in used.items()) > 0.8 * sum(b * n for b, n in histogram.items())


def test_merge_of_front_coded_runs():
    rng = random.Random(7)
    for trial in range(30):
        lists = [sorted(bytes(rng.choice(b"ab") for _ in range(rng.randrange(1, 40))) for _ in range(rng.randrange(0, 30))) for _ in range(trial % 7 + 1)]
        runs = []
        for own in lists:
            prefix, new = suffixes.front_code(own)
            assert suffixes.front_decode(prefix, list(map(len, own)), new) == own
            runs.append((own, prefix))
        out = list(suffixes.merge(runs))
        merged = [lists[r][i] for r, i, _ in out]
        assert merged == sorted(x for own in lists for x in own)
        assert [h for *_, h in out][1:] == [suffixes.shared(a, b, 0) for a, b in zip(merged[:-1], merged[1:], strict=True)]


def test_recurrent_network_starts_at_frequencies_and_learns():
    rng = np.random.default_rng(8)
    counts = np.sort(rng.integers(5, 500, 70))[::-1].astype(float)
    levels = np.array([40.0, 60.0])
    p = gru.start(counts, levels)
    share = np.concatenate((counts, levels)) / (counts.sum() + levels.sum())
    sequences = [np.tile([3, 69, 70], 40) if i % 2 else np.tile([50, 71], 30) for i in range(60)]
    ids, offsets = np.concatenate(sequences), np.concatenate(([0], np.cumsum([len(x) for x in sequences])))
    got = gru.score(p, ids, offsets, 70)
    assert got == pytest.approx([np.log(share[x]).sum() for x in sequences], rel=1e-3)
    better = gru.score(gru.train(p, sequences, 70), ids, offsets, 70)
    assert (better > got).all()
    # The state is carried over windows: their length changes nothing.
    assert gru.score(p, ids, offsets, 70, window=7) == pytest.approx(got)


def test_lanes_hold_every_sequence_once():
    rng = np.random.default_rng(12)
    sequences = [rng.integers(1, 9, n).astype(np.int32) for n in [3, 1, 900, 40, 7, 7, 20_000, 2]]
    ids, begins, length = gru.lanes(sequences, 3)
    assert (np.diff(length) <= 0).all() and length.sum() == sum(map(len, sequences)) and len(ids) == length[0]
    found = []
    for j, n in enumerate(length.tolist()):
        cuts = np.flatnonzero(begins[:n, j])
        assert cuts[0] == 0 and not begins[n:, j].any()
        found += [x.tolist() for x in np.split(ids[:n, j], cuts[1:])]
    assert sorted(found) == sorted(x[a : a + gru.SEGMENT].tolist() for x in sequences for a in range(0, len(x), gru.SEGMENT))


def test_gradient_through_time_with_sequences_end_to_end(monkeypatch):
    """One window over three sequences in two lanes, against differences of the summed scores."""
    p = {k: v.astype(np.float64) for k, v in gru.start(np.full(40, 10.0), np.array([5.0])).items()}
    rng = np.random.default_rng(13)
    p["classes"], p["words"] = rng.normal(0, 0.5, p["classes"].shape), rng.normal(0, 0.5, p["words"].shape)
    sequences = [rng.integers(0, 41, n) for n in (9, 4, 3)]
    ids, offsets = np.concatenate(sequences), np.array([0, 9, 13, 16])
    moments = {}
    gru.train(p, sequences, 40, moments, window=32, width=2, rate=0.0)
    e = 1e-3
    for k, at in (("state", (2, 5)), ("state", (7, 40)), ("state", (3, 20)), ("input", (int(ids[1]), 3)), ("input", (int(ids[10]), 40))):
        up, down = ({n: v.copy() for n, v in p.items()} for _ in range(2))
        up[k][at] += e
        down[k][at] -= e
        # The state that sequences start with is not trained, so it is held.
        held = gru._step(p, p["input"][-1:].T, np.zeros((gru.HIDDEN, 1)))[0]
        value = []
        for q in (up, down):
            total = 0.0
            for x in sequences:
                h = held
                for i in x:
                    total += gru._outputs(q, h, np.array([i]), 40)[0][0]
                    h = gru._step(q, q["input"][[i]].T, h)[0]
            value.append(total)
        got = moments[f"first {k}"][at] / 0.1 * len(ids)
        assert got == pytest.approx(-(value[0] - value[1]) / (2 * e), rel=2e-2, abs=2e-4)


def test_gradient_of_the_network():
    p = {k: v.astype(np.float64) for k, v in gru.start(np.full(40, 10.0), np.array([5.0])).items()}
    rng = np.random.default_rng(9)
    h, ids = rng.normal(size=(gru.HIDDEN, 12)), rng.integers(0, 41, 12)
    grad = {k: np.zeros_like(v) for k, v in p.items()}
    _, back = gru._outputs(p, h, ids, 40, grad)
    e = 1e-6
    for k in ("classes", "words"):
        at = tuple(0 for _ in p[k].shape)
        p[k][at] += e
        up = gru._outputs(p, h, ids, 40)[0].sum()
        p[k][at] -= 2 * e
        assert grad[k][at] == pytest.approx(-(up - gru._outputs(p, h, ids, 40)[0].sum()) / (2 * e), rel=1e-4, abs=1e-7)
        p[k][at] += e


def test_reliabilities_separate_good_labelers_from_noise():
    rng = np.random.default_rng(10)
    truth = rng.random(4000) < 0.4
    good = np.where(rng.random(4000) < 0.9, np.where(truth, 1, -1), np.where(truth, -1, 1))
    also = np.where(rng.random(4000) < 0.8, np.where(truth, 1, -1), 0)
    noise = rng.choice([-1, 0, 1], 4000)
    rows, counts = np.unique(np.stack([good, also, noise], 1), axis=0, return_counts=True)
    share, table = pii.reliabilities(rows, counts.astype(float))
    assert share == pytest.approx(0.4, abs=0.05)
    assert table[1, 0, 2] > 0.8 and abs(table[1, 2, 2] - table[0, 2, 2]) < 0.1


def test_luhn():
    assert pii.luhn("4539578763621486") and not pii.luhn("4539578763621487")
    assert re.fullmatch("[0-9]+", "4539578763621486")


def test_texts_that_share_their_longest_word_are_not_copies():
    footer = "https://example.org/terms-of-use-and-more-that-is-longer-than-all-words"
    bad = ["abominable", "wretched", "dreadful"]

    def text(i, toxic):
        own = prose(i, 60).split(" ")
        if toxic:
            for k in range(3):
                own[7 + 13 * k] = bad[(i + k) % 3]
        return f"{' '.join(own)} {footer}"

    model = toxicity.fit([(text(i, i % 4 == 0), int(i % 4 == 0)) for i in range(400)])
    assert model.weights
    cache = model.savings()
    score = model.score(*model.measures(texts([text(i, i % 4 == 0) for i in range(400, 480)]), cache))
    assert np.mean((score >= 0.5) == (np.arange(400, 480) % 4 == 0)) > 0.95
    # Copies, exact or near, still count once.
    copies = [(f"{text(0, True)} {'' if i % 2 else f'copy{i}'}", 1) for i in range(100)]
    assert not toxicity.fit(copies + [(text(i, False), 0) for i in range(1, 300)]).weights
