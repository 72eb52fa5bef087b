"""Hard negatives, URL rules and the filter audit against plain versions, on odd tables."""

import math
import random
from collections import Counter
from itertools import permutations

import numpy as np
import pyarrow as pa
import pytest

from folia.llm import audit, hardneg, urlfilter

from .conftest import WORD, prose

# -- hard negatives ------------------------------------------------------------------

VECTORS = "vec_id long, embedding array<double>, label int, score double, anchor string, key binary"


def plain_negatives(rows, every, n, least):
    valid = []
    for vec_id, x, label, *_ in rows:
        if vec_id is None or label is None or x is None or any(v is None or not math.isfinite(v) for v in x):
            continue
        valid.append((vec_id, label, tuple(max(-(2**63), min(2**63 - 1, math.floor(256 * v))) for v in x)))
    out = []
    for anchor, label, cells in sorted({v for v in valid if v[0] % every == 0}):
        scored = [(max(-(2**63), min(2**63 - 1, sum(a * b for a, b in zip(cells, other, strict=False)))), i, y) for i, y, other in valid if i != anchor]
        scored.sort(key=lambda r: (-r[0], r[1]))
        for top, positive, _ in [r for r in scored if r[2] == label][:n]:
            fit = [r for r in scored if r[2] != label and least * top <= 100 * r[0] <= 100 * top]
            out += [(anchor, positive, k, i, top, s) for k, (s, i, _) in enumerate(fit[:n], 1)]
    return sorted(out)


def mined(df, **options):
    return sorted(map(tuple, hardneg.hard_negatives(df, **options).collect()))


def odd_vectors():
    rng = random.Random(4)
    vector = lambda: [rng.choice([-1, 0, 1, 2]) / 8 + rng.random() / 64 for _ in range(6)]
    rows = [(i, vector(), rng.randrange(3)) for i in range(160)]
    common = [0.5] * 6  # a vector that many rows share
    rows += [(200 + i, common, i % 3) for i in range(60)]
    rows += [(-100, common, 1), (300, common, 0), (300, common, 0), (400, vector(), 1), (400, vector(), 2)]
    rows += [(500, None, 1), (501, [0.1, None], 1), (502, [math.nan] * 6, 1), (503, [math.inf] * 6, 0), (504, vector(), None), (None, vector(), 1)]
    rows += [(600, [], 1), (601, [0.25, 0.5], 2), (602, [0.25, 0.5, 0.1, 0.1, 0.1, 0.1, 4.0, 5.0], 1)]
    return [(*r, 0.0, "x", b"k") for r in rows]


def test_hard_negatives_are_those_of_all_pairs(sent):
    rows = odd_vectors()
    df = sent.createDataFrame(rows, VECTORS).repartition(5)
    want = plain_negatives(rows, 20, 5, 80)
    assert len(want) > 100
    assert mined(df, every=20) == want
    # Many blocks of few anchors give the same.
    assert mined(df, every=20, block_bytes=600) == want
    assert mined(df, every=20, positives=2, negatives=2, least=0) == plain_negatives(rows, 20, 2, 0)


def test_hard_negatives_of_huge_numbers_are_exact(sent):
    rng = random.Random(5)
    rows = [(i, [rng.choice([-1, 1]) * rng.random() * 1e14 for _ in range(3)], i % 2, 0.0, "", b"") for i in range(40)]
    rows += [(100, [1e300, 1.0, 1.0], 0, 0.0, "", b""), (101, [1e300, 1.0, 2.0], 1, 0.0, "", b"")]
    df = sent.createDataFrame(rows, VECTORS)
    assert mined(df, every=10) == plain_negatives(rows, 10, 5, 80)


def test_hard_negatives_of_nothing(sent):
    assert mined(sent.createDataFrame([], VECTORS)) == []
    assert mined(sent.createDataFrame([(1, [1.0], 1, 0.0, "", b"")], VECTORS)) == []
    assert mined(sent.createDataFrame([(100, [1.0], 1, 0.0, "", b"")], VECTORS)) == []


def test_a_task_drops_only_lower_candidates(monkeypatch, sent):
    monkeypatch.setattr(hardneg, "HELD", 20)
    monkeypatch.setattr(hardneg, "CELLS", 64)
    rows = odd_vectors()
    block = hardneg.Anchors([{"start": 7, "vec_id": 300, "label": 0, "cells": [128] * 6}])

    class Sent:
        value = block

    cells = [(i, y, [math.floor(256 * v) for v in x]) for i, x, y, *_ in rows if i is not None and i < 300]
    batch = pa.record_batch({"vec_id": [c[0] for c in cells], "label": pa.array([c[1] for c in cells], pa.int64()), "cells": pa.array([c[2] for c in cells], pa.list_(pa.int64()))})
    (found,) = hardneg._positives(Sent, 5)(iter([batch]))
    best = sorted((-sum(128 * v for v in c[2]), c[0]) for c in cells if c[1] == 0)[:5]
    assert sorted(zip((-np.asarray(found.column("score"))).tolist(), found.column("id").to_pylist(), strict=True)) == best


# -- URL rules -----------------------------------------------------------------------

RULES = [
    ("net", "/", "block"), ("example.net", "/en/", "allow"), ("example.com", "/de/", "block"), ("org", "/fr/", "allow"),
    ("Deep.EXAMPLE.com", "", "allow"), ("example.com", "/de", "block"), ("example.com", "/de/a/b", "allow"), ("tie.io", "/x", "allow"),
    ("tie.io", "/x", "block"), ("tie.io", "/x", "block"), ("a.io", "/bcd", "allow"), ("cd.a.io", "/b", "block"), ("", "/any/", "block"), (None, None, "allow"), ("münchen.de", "/ü", "block"),
]


def plain_judgement(url, rules, default):
    host = path = ""
    if url is not None and "://" in url:
        rest = url.split("://", 1)[1]
        end = min([rest.find(c) for c in "/?#" if c in rest] or [len(rest)])
        host, path = rest[:end], rest[end:]
        path = path[: min([path.find(c) for c in "?#" if c in path] or [len(path)])]
    low = lambda x: "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in x)
    host = low(host)
    fit = []
    for h, p, v in rules:
        h, p = low(h or ""), p or ""
        if (h == "" or host == h or host.endswith("." + h)) and path.startswith(p):
            fit.append((len(h + p), len(h), v == "block", h + p, v))
    best = max(fit, default=(0, 0, 0, None, default))
    return host, path, best[3], best[4]


def odd_urls():
    hosts = ["net", "a.net", "xnet", "www.Example.NET", "example.net", "example.com", "x.deep.example.com", "deep.example.com", "q.org", "org", "tie.io", "z.tie.io", "cd.a.io", "e.cd.a.io", "", ".net", "a..net", "net.", "a.net:80", "me@a.net", "www.münchen.de", "ÄB.net"]
    paths = ["", "/", "/en/", "/en", "/en/1", "/de", "/de/", "/deutsch", "/de/a/b", "/de/a/bc/d", "/fr/x", "//fr/", "/x", "/bcd", "/b", "/any/thing", "/ü/x", "/en/\nline"]
    urls = [f"{scheme}://{h}{p}{tail}" for scheme in ("http", "") for h in hosts for p in paths for tail in ("", "?q=/en/", "#://x/de/")]
    return [*urls, None, "", "no scheme", "http:/one", "a://b://c.net/d", "http://" + "a." * 5000 + "net/" + "s/" * 5000]


@pytest.mark.parametrize("size", [urlfilter.BLOCK_BYTES, 400])
def test_url_rules(sent, size):
    urls = odd_urls()
    rows = [(k // 2, u, "rule", "host", 1) for k, u in enumerate(urls)] + [(None, "http://a.net/", "", "", 0)]
    pages = sent.createDataFrame(rows, "page_id long, url string, rule string, host string, length long")
    rules = sent.createDataFrame(RULES, "host string, path string, verdict string")
    got = urlfilter.url_filter(pages, rules, block_bytes=size).collect()
    key = lambda r: tuple(map(str, r))
    assert sorted(map(tuple, got), key=key) == sorted(((i, *plain_judgement(u, RULES, "allow")) for i, u, *_ in rows), key=key)


def test_url_rules_of_nothing(sent):
    pages = sent.createDataFrame([(1, "http://a.net/"), (1, None)], "page_id long, url string")
    rules = sent.createDataFrame([], "host string, path string, verdict string")
    assert sorted(r.verdict for r in urlfilter.url_filter(pages, rules, default="block").collect()) == ["block", "block"]
    assert urlfilter.url_filter(pages.limit(0), sent.createDataFrame(RULES, "host string, path string, verdict string")).count() == 0


# -- filter audit --------------------------------------------------------------------


def plain_audit(rows, labels):
    first = {}
    for i, text, _ in rows:
        if i is not None:
            first[text or ""] = min(i, first.get(text or "", i))
    says = lambda i, k: any(x[0] == i and x[k] == 1 for x in labels if i is not None)
    docs = []
    for i, text, part in rows:
        t = text or ""
        words = WORD.findall(t)
        fails = {f for f, bad in {
            "A": len(words) < 100, "B": 100 * len(set(words)) < 80 * len(words),
            "C": 100 * sum("A" <= c <= "Z" for c in t) > 10 * len(t), "D": any(c in "#$%&*|" for c in t),
            "E": i is not None and first[t] < i,
        }.items() if bad}
        docs.append((part or "", fails, says(i, 1), says(i, 2)))
    out, total = {}, Counter()
    for part in {d[0] for d in docs}:
        for order in permutations("ABCDE"):
            left = [d for d in docs if d[0] == part]
            gone = []
            for step, f in enumerate(order, 1):
                removed = [d for d in left if f in d[1]]
                left = [d for d in left if f not in d[1]]
                unique = sum(d[0] == part and d[1] == {f} for d in docs)
                out[part, "".join(order), step] = [len(left), len(removed), sum(f in d[1] for d in gone), unique, sum(d[2] for d in removed), sum(d[3] for d in removed)]
                gone += removed
                total[part, f] += len(removed)
    return {(*k, *v, total[k[0], k[1][k[2] - 1]]) for k, v in out.items()}


def test_paths_of_the_lattice():
    for k in range(1, 6):
        forward, backward = audit.path_counts(k)
        assert forward[-1] == backward[0] == math.factorial(k)
        assert all(forward[s] == math.factorial(s.bit_count()) and backward[s] == math.factorial(k - s.bit_count()) for s in range(1 << k))
        through = Counter()
        for order in permutations(range(k)):
            state = 0
            for f in order:
                through[state, f] += 1
                state |= 1 << f
        assert {(s, f): w for s, f, w in audit.edges(k)} == through


def test_filter_audit_walks_all_orders(sent):
    rng = random.Random(8)
    rows = []
    for i in range(90):
        text = prose(rng.randrange(12), rng.choice([5, 99, 100, 140]))
        if rng.random() < 0.3:
            text = " ".join(f"{w}{k}" for k, w in enumerate(text.split()))
        if rng.random() < 0.3:
            text = text.upper()
        if rng.random() < 0.3:
            text += " 5% | more"
        rows.append((rng.randrange(60), text, rng.choice(["en", "de", None, ""])))
    rows += [(i, "one text that many have " * 30, "en" if i % 3 else "de") for i in range(100, 160)]
    rows += [(7, None, None), (8, "", "en"), (9, " \n\t", "en"), (None, "", "fr"), (None, rows[0][1], "fr"), (3, rows[0][1], "fr"), (3, rows[0][1], "fr"), (11, "é Ü 😀 " * 4000, "x")]
    labels = [(i, rng.choice([0, 1, None]), rng.choice([0, 1, None])) for i in range(0, 160, 2)] + [(100, 1, 1), (None, 1, 1), (999, 1, 0)]
    docs = sent.createDataFrame([(*r, 1, "d", 2) for r in rows], "doc_id long, text string, lang string, mask int, digest string, n long").repartition(4)
    marks = sent.createDataFrame(labels, "doc_id long, quality int, toxic int")
    want = plain_audit(rows, labels)
    assert {tuple(r) for r in audit.filter_interactions(docs, marks).collect()} == want
    # Hot keys are looked up in place.
    counts = audit.mask_counts(docs, marks, hot_rows=1)
    assert {tuple(r) for r in audit.order_steps(audit.edge_counts(counts, 5), "ABCDE").collect()} == want


def test_filter_audit_of_nothing(sent, empty, labels, no_labels):
    assert audit.filter_interactions(empty, labels).count() == 0
    one = sent.createDataFrame([(1, None, None)], "doc_id long, text string, lang string")
    assert {tuple(r) for r in audit.filter_interactions(one, no_labels).collect()} == plain_audit([(1, None, None)], [])
