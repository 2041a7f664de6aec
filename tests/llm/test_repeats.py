"""Repeated substrings against a comparison of every window."""

import hashlib
import random
from collections import defaultdict

import numpy as np
import pytest

from tarweave.llm import repeats

SCHEMA = "doc_id long, text string, ord long, start string, stop string, anchor string, spans string, print string, n string, all string"


def frame(spark, rows):
    return spark.createDataFrame([(*r, *[None] * 8) for r in rows], SCHEMA)


def brute(rows):
    """``doc_id, n_bytes, n_removed, n_spans, sha`` of texts in order, and the spans that are removed."""
    order = sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0, hashlib.sha256((r[1] or "").encode()).hexdigest()))
    seen, out = set(), []
    for doc_id, text in order:
        raw = (text or "").encode()
        gone = np.zeros(len(raw) + 1, bool)
        for p in range(len(raw) - 99):
            window = raw[p:p + 100]
            if window in seen:
                gone[p:p + 100] = True
            seen.add(window)
        kept = bytes(b for b, g in zip(raw, gone) if not g)
        out.append((doc_id, len(raw), int(gone.sum()), int((gone[1:] < gone[:-1]).sum()), hashlib.sha256(kept).hexdigest()))
    return sorted(out, key=str)


def made(seed, n=60, letters="abcdefgh "):
    rnd = random.Random(seed)
    text = lambda k: "".join(rnd.choice(letters) for _ in range(k))
    passages = [text(rnd.choice([60, 99, 100, 101, 140, 150, 151, 400])) for _ in range(8)] + ["é" * 70, "ab" * 120, "x" * 500]
    rows = []
    for i in range(n):
        parts = []
        for _ in range(rnd.randrange(1, 6)):
            p = rnd.choice(passages)
            if rnd.random() < 0.3:  # a copy that differs in one place
                k = rnd.randrange(len(p))
                p = p[:k] + "#" + p[k + 1:]
            if rnd.random() < 0.2:  # a part of it
                p = p[rnd.randrange(len(p)):]
            parts += [p, text(rnd.choice([0, 1, 5, 40, 200]))]
        rows.append((i * 3, "".join(parts)))
    return rows + [(1, rows[0][1]), (4, rows[5][1] + "!"), (7, None), (10, ""), (13, "short"), (14, "y" * 99), (16, "y" * 100), (17, "y" * 3000), (19, "y" * 100)]


def results(spark, rows, **options):
    return sorted((tuple(r) for r in repeats.without_repeats(frame(spark, rows).repartition(5), **options).collect()), key=str)


@pytest.mark.parametrize("seed", range(3))
def test_removed_bytes(spark, seed):
    rows = made(seed)
    assert results(spark, rows) == brute(rows)


def test_hot_anchors_are_compared_by_window(spark):
    """A passage between unlike texts: its anchors near the ends have a context for every text."""
    rnd = random.Random(9)
    text = lambda k: "".join(rnd.choice("abcdefghijklmnop ") for _ in range(k))
    passage = text(260)
    rows = [(k, text(rnd.randrange(150)) + passage + text(rnd.randrange(150))) for k in range(120)] + made(4, 30)[:30]
    rows = [(k, t) for k, (_, t) in enumerate(rows)]
    want = brute(rows)
    assert results(spark, rows) == want
    assert results(spark, rows, hot=3) == want


def test_repeated_and_missing_ids(spark):
    rows = made(5, 20)
    rows += [(rows[0][0], rows[3][1]), (None, rows[1][1]), (None, rows[2][1] + "more" * 40), rows[4], rows[4], (None, None)]
    assert results(spark, rows) == brute(rows)
    assert repeats.without_repeats(frame(spark, rows[:1]).limit(0)).count() == 0


def test_long_text_and_cut_pieces(spark, monkeypatch):
    rnd = random.Random(3)
    noise = "".join(rnd.choice("abcdefghijklmnopqrstuvwxyz") for _ in range(30_000))
    long = noise * 2 + noise[:777] + "z" * 5000
    raw = np.frombuffer((noise + long).encode(), np.uint8)
    offsets = np.array([0, len(noise), len(noise) + len(long)])
    whole = repeats.anchors(raw, offsets)
    monkeypatch.setattr(repeats, "_STEP", 1000)
    assert all(np.array_equal(a, b) for a, b in zip(whole, repeats.anchors(raw, offsets)))
    rows = [(2, long), (5, noise[100:20_000] + "!" + noise[20_000:])]
    assert results(spark, rows) == brute(rows)


def test_groups_have_all_occurrences(spark):
    """Spans name the earliest text of their group, wherever the group begins."""
    rnd = random.Random(1)
    text = lambda k: "".join(rnd.choice("abcdefghij ") for _ in range(k))
    passage = text(120)
    rows = [(k, text(90 + k) + passage + text(80)) for k in range(6)]
    texts = {k: t.encode() for k, t in rows}
    found = repeats.repeats(repeats.in_order(frame(spark, rows))).collect()
    by = defaultdict(set)
    for r in found:
        stop = min(r.stop, len(texts[r.ord]))
        assert (r.earlier_ord, r.earlier_start) < (r.ord, r.start)
        assert texts[r.ord][r.start:stop] == texts[r.earlier_ord][r.earlier_start:r.earlier_start + stop - r.start]
        by[r.ord].add((r.start, stop, r.earlier_ord))
    whole = {k: (90 + k, 210 + k, 0) for k in range(1, 6)}
    assert all(min(s for s, _, e in by[k] if e == 0) == a and max(t for _, t, e in by[k] if e == 0) == b for k, (a, b, _) in whole.items())


def test_intervals():
    rnd = random.Random(8)
    for _ in range(200):
        common = [0] + [rnd.randrange(5) for _ in range(rnd.randrange(12))]
        want = set()
        for a in range(len(common)):
            for b in range(a + 1, len(common)):
                least = min(common[a + 1:b + 1])
                if least >= 2 and common[a] < least and (b + 1 == len(common) or common[b + 1] < least):
                    want.add((least, a, b))
        assert set(repeats.intervals(common, 2)) == want and len(list(repeats.intervals(common, 2))) == len(want)
