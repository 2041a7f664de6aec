"""Exact copies, near copies and passages against brute force."""

import random
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import pytest

from tarweave.llm import common, graph, passages, quotient, weighted_minhash, words

CLASHES = "id long, node string, print string, fp string, n string, size string, keep string, text_a string, _id string, _fp string, _print string, _node string, _key string, _n string, _stays string, mark string, key_id string, key_mark string, MARK_ string"


def made_documents(seed=0, n=60):
    """Texts with copies, texts of a few words changed, shared passages, empty and short ones."""
    rnd = random.Random(seed)
    vocabulary = ["".join(rnd.choice("abcdefghij") for _ in range(rnd.randrange(2, 7))) for _ in range(400)]
    text = lambda k: [rnd.choice(vocabulary) for _ in range(k)]
    docs = [text(rnd.randrange(60, 300)) for _ in range(n)]
    for k in range(n // 2):
        copy = list(docs[k % 15])
        for _ in range(rnd.randrange(0, 6)):
            copy[rnd.randrange(len(copy))] = "changed" + str(k)
        docs.append(copy)
    shared = text(70)
    for k in range(8):
        at = rnd.randrange(20)
        docs.append(text(at) + shared + text(40))
    out = [" ".join(d) for d in docs]
    out += [out[0], out[0].upper(), "", "", "one", "one", "one two three", None]
    return [(i, t) for i, t in enumerate(out)]


def frame(spark, rows, extra=""):
    more = [None] * len(extra.split(", ")) if extra else []
    return spark.createDataFrame([(*r, *more) for r in rows], "doc_id long, text string" + (f", {extra}" if extra else ""))


def classes(pairs, nodes):
    parent = {n: n for n in nodes}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in pairs:
        parent[find(a)] = find(b)
    least = {}
    for n in nodes:
        least[find(n)] = min(least.get(find(n), n), n)
    return {n: least[find(n)] for n in nodes}


@pytest.mark.parametrize("seed", range(4))
def test_filters_lose_nothing(seed):
    rng = np.random.default_rng(seed)
    bits = 3
    part = int(rng.integers(0, 8))
    lists = []
    for size in (1, 5, 400):
        prints = np.unique(rng.integers(0, 1 << (40 if seed % 2 else 61), size, np.uint64) | np.uint64(part << 61))
        counts = rng.integers(1, 1 << 40, len(prints))
        packed = quotient._pack(prints, counts, bits)
        got = quotient._unpack(packed, part, bits)
        assert np.array_equal(got[0], prints) and np.array_equal(got[1], counts)
        lists.append((prints, counts))
    values, counts = quotient.merge(np.concatenate([p for p, _ in lists]), np.concatenate([c for _, c in lists]))
    want = Counter()
    for p, c in lists:
        for x, k in zip(p.tolist(), c.tolist()):
            want[x] += k
    assert dict(zip(values.tolist(), counts.tolist())) == want


def test_exact_copies(spark):
    rows = made_documents() + [(3, "A b"), (7, "a B"), (7, "a B"), (None, "a b"), (None, "nobody"), (None, "nobody")]
    lower = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    groups = defaultdict(list)
    for i, t in rows:
        groups[(t or "").translate(lower)].append(i)
    df = frame(spark, rows, CLASHES)
    got = quotient.exact_copies(df).collect()
    want = Counter()
    for ids in groups.values():
        keep = max((i for i in ids if i is not None), default=None)
        for k, i in enumerate(sorted(ids, key=lambda i: (i is None, i or 0))):
            first = i == keep and ids.count(i) >= 1 and sorted(ids, key=lambda i: (i is None, i or 0)).index(i) == k
            want[i, keep, len(ids), first] += 1
    assert Counter((r.doc_id, r.keep_id, r.group_size, r.kept) for r in got) == want
    kept = quotient.drop_exact_copies(df)
    assert kept.columns == df.columns
    assert sorted((t or "").translate(lower) for _, t in kept.select("doc_id", "text").collect()) == sorted(groups)
    assert quotient.exact_copies(df.limit(0)).count() == 0 and quotient.drop_exact_copies(df.limit(0)).count() == 0


def brute_near(rows, weights):
    found = words.find_words  # the same words, compared without any sampling
    assert found
    sets = {}
    for i, t in rows:
        h, c, _ = weighted_minhash.counted_shingles(pa.array([t or ""]))
        sets[i] = (h, c)
    ids = [i for i, _ in rows]
    texts = dict(rows)
    pairs = []
    for x in range(len(ids)):
        for y in range(x):
            a, b = ids[x], ids[y]
            if (texts[a] or "") == (texts[b] or ""):
                pairs.append((a, b))
            elif len(sets[a][0]) and len(sets[b][0]) and weighted_minhash.similarity(sets[a], sets[b], weights) >= weighted_minhash.SIMILARITY:
                pairs.append((a, b))
    return classes(pairs, ids)


def test_near_copies(spark):
    rows = made_documents(1)
    df = frame(spark, rows, CLASHES).repartition(5)
    got = weighted_minhash.near_copies(df).collect()
    want = brute_near(rows, weighted_minhash.rarity(df))
    assert {r.doc_id: r.class_id for r in got} == want
    sizes = Counter(want.values())
    assert all(r.class_size == sizes[r.class_id] and r.kept == (r.doc_id == r.class_id) for r in got)
    kept = weighted_minhash.drop_near_copies(df)
    assert kept.columns == df.columns and sorted(r.doc_id for r in kept.collect()) == sorted(sizes)


def test_near_copies_of_nothing_and_of_repeated_rows(spark):
    df = frame(spark, [(1, "a b c d e f"), (1, "a b c d e f"), (None, "A B C D E F."), (None, None), (None, "")], CLASHES)
    got = Counter((r.doc_id, r.class_id, r.class_size, r.kept) for r in weighted_minhash.near_copies(df).collect())
    assert got == {(1, 1, 3, True): 1, (1, 1, 3, False): 1, (None, 1, 3, False): 1, (None, None, 2, True): 1, (None, None, 2, False): 1}
    assert sorted((t or "") for t, in weighted_minhash.drop_near_copies(df).select("text").collect()) in (["", "a b c d e f"],)
    assert weighted_minhash.near_copies(df.limit(0)).count() == 0


@pytest.mark.parametrize("block", [5, 4096])
def test_texts_just_too_far_make_no_row_for_each_pair(spark, monkeypatch, block):
    """Many texts of one bucket, most of them a little too unlike, some in chains: whole classes, and rows in proportion to texts."""
    rnd = random.Random(3)
    base = [f"w{k}" for k in range(120)]
    rows = []
    for k in range(120):
        text = list(base)
        for at in rnd.sample(range(120), 1 + (k % 6 > 0) + (k % 6 > 4)):
            text[at] = f"x{k}y{at}"
        rows.append((k, " ".join(text)))
    counts = []

    def counted(df, label):
        out = stage(df, label)
        counts.append((out.count(), label))
        return out

    stage = weighted_minhash.stage
    for module in (weighted_minhash, common, graph):
        monkeypatch.setattr(module, "stage", counted)
    monkeypatch.setattr(weighted_minhash, "BLOCK_ROWS", block, raising=False)
    df = frame(spark, rows).repartition(4)
    got = {r.doc_id: r.class_id for r in weighted_minhash.near_copies(df).collect()}
    want = brute_near(rows, weighted_minhash.rarity(df))
    assert 10 < len(set(want.values())) < 110 and got == want
    if block > len(rows):
        assert max(counts)[0] <= weighted_minhash.BANDS * len(rows), max(counts)


def test_rounds_find_links_that_leaders_miss(spark):
    """A chain: each text is near the next only, and all of a bucket's leader are too far from most."""
    base = [f"w{k}" for k in range(200)]
    rows = []
    for step in range(12):
        text = list(base)
        for k in range(step * 3):
            text[(k * 6) % 200] = f"x{k}"
        rows.append((step, " ".join(text)))
    df = frame(spark, rows)
    got = {r.doc_id: r.class_id for r in weighted_minhash.near_copies(df).collect()}
    assert got == brute_near(rows, weighted_minhash.rarity(df))


def test_components(spark):
    rnd = random.Random(2)
    links = [(rnd.randrange(300), rnd.randrange(300)) for _ in range(180)] + [(k, k + 1) for k in range(1000, 1060)] + [(5000, k) for k in range(5001, 5200)] + [(7, 7)]
    got = {r.node: r.root for r in graph.components(spark.createDataFrame(links, "a long, b long")).collect()}
    links = [(a, b) for a, b in links if a != b]
    want = classes(links, sorted({n for link in links for n in link}))
    frame = lambda part: spark.createDataFrame(part, "a long, b long")
    later = {r.node: r.root for r in graph.joined(graph.components(frame(links[:200])), frame(links[200:])).collect()}
    assert len({(got[n], later[n]) for n in got}) == len(set(got.values())) and later.keys() == got.keys()
    by = defaultdict(set)
    for n, r in got.items():
        by[r].add(n)
    other = defaultdict(set)
    for n, r in want.items():
        other[r].add(n)
    assert sorted(map(sorted, by.values())) == sorted(map(sorted, other.values()))


@pytest.mark.parametrize("seed", range(6))
def test_compact_windows_are_the_nodes_of_cartesian_trees(seed):
    rng = np.random.default_rng(seed)
    rows = np.append(0, np.cumsum(rng.integers(0, 60, 8)))
    hashes = rng.integers(0, 1 << 40 if seed % 2 else 25, rows[-1]).astype(np.uint64) << np.uint64(22)
    t = int(rng.integers(1, 9))
    want = set()

    def nodes(a, b):
        if b - a >= t:
            c = a + int(np.argmin(hashes[a:b]))
            want.add((c, a, b - 1))
            nodes(a, c)
            nodes(c + 1, b)

    for a, b in zip(rows[:-1], rows[1:]):
        nodes(a, b)
    center, left, right, _ = passages.compact_windows(hashes, rows, t)
    assert set(zip(center.tolist(), left.tolist(), right.tolist())) == want


def test_passages_at_two_distances_far_apart():
    rng = np.random.default_rng(3)
    x, y = rng.integers(0, 1 << 60, (2, 60)).astype(np.uint64)
    a, b = np.concatenate([x, y]), np.concatenate([y, rng.integers(0, 1 << 60, 500).astype(np.uint64), x])
    assert passages.common_passages(a, b) == [(0, 59, 560, 619), (60, 119, 0, 59)]
    assert passages.common_passages(a, np.zeros(3, np.uint64)) == []


def diagonal_passages(a, b, t=passages.TOKENS):
    """Words of ``a`` and ``b`` in runs of ``t`` equal tokens, each pair of places compared."""
    in_a, in_b = set(), set()
    for d in range(-len(a), len(b)):
        run = 0
        for i in range(max(0, -d), min(len(a), len(b) - d)):
            run = run + 1 if a[i] == b[i + d] else 0
            if run >= t:
                in_a |= set(range(i - t + 1, i + 1))
                in_b |= set(range(i + d - t + 1, i + d + 1))
    return in_a, in_b


@pytest.mark.parametrize("seed", range(6))
def test_passages_at_every_place(seed, monkeypatch):
    rng = np.random.default_rng(seed)
    new = lambda n: rng.integers(0, 1 << 60, n).astype(np.uint64)
    passage, line = new(51), new(8)
    cases = [
        # An earlier quote of half of the passage, the passage twice, a repeated line at its edges.
        (np.concatenate([new(20), passage, new(20)]), np.concatenate([passage[:26], new(30), passage, new(10)])),
        (np.concatenate([passage, new(9)]), np.concatenate([new(5), passage, new(40), passage])),
        (np.concatenate([line, passage[:40], line, new(30)]), np.concatenate([line, new(15), line, line, new(7), line, passage[:40], line])),
    ]
    for held in (4_000_000, 50):
        monkeypatch.setattr(passages, "MATCHES", held, raising=False)
        for a, b in cases:
            for x, y in ((a, b), (b, a)):
                found = passages.common_passages(x, y)
                own = [{p for s in found for p in range(s[k], s[k + 1] + 1)} for k in (0, 2)]
                want = diagonal_passages(x.tolist(), y.tolist())
                assert want[0] and want[0] <= own[0] and want[1] <= own[1]
                for p, q, u, v in found:
                    here, there = set(x[p:q + 1].tolist()), set(y[u:v + 1].tolist())
                    assert q - p + 1 >= passages.TOKENS and len(here & there) >= passages.SIMILARITY * len(here | there)


def test_passages(spark):
    rows = made_documents(4)
    df = frame(spark, rows, CLASHES).repartition(6)
    got = {r.doc_id: r for r in passages.repeated_passages(df).collect()}
    token = {i: passages.tokens(pa.array([t or ""]))[0] for i, t in rows}
    pairs, spans = [], defaultdict(set)
    for x, (a, _) in enumerate(rows):
        for b, _ in rows[:x]:
            if len(token[a]) and len(token[b]):
                for p, q, u, v in passages.common_passages(token[a], token[b]):
                    pairs.append((a, b))
                    spans[a] |= set(range(p, q + 5))
                    spans[b] |= set(range(u, v + 5))
    want = classes(pairs, [i for i, _ in rows])
    assert {i: r.class_id for i, r in got.items()} == want
    for i, r in got.items():
        own = {w for s in r.spans for w in range(s.first, s.last + 1)}
        assert r.repeated_words == len(own) and bool(own) == bool(spans[i])
        assert len(own & spans[i]) >= 0.9 * len(own | spans[i])


def test_exact_passages_in_a_family_of_variants(spark):
    rnd = random.Random(8)
    word = lambda: f"w{rnd.randrange(10**9)}"
    base = [word() for _ in range(60)]
    # Similarity of about 0.6 between variants: whole sentences of the base are exchanged.
    rows = [(i, " ".join([word() for _ in range(5)] + [w if k // 10 not in own else word() for k, w in enumerate(base)] + [word() for _ in range(5)]))
            for i in range(400) for own in [set(rnd.sample(range(6), 2))]]
    planted = [w if not 20 <= k < 40 else word() for k, w in enumerate(base)]
    for k in range(4):
        # Exact copies, the last one of the shortest passage only.
        rows.append((1000 + k, " ".join([word() for _ in range(30 + k)] + planted[:60 if k < 3 else 50] + [word() for _ in range(30)])))
    df = frame(spark, rows, CLASHES).repartition(6)
    exact, spans = passages.exact_passages(df.selectExpr("xxhash64(text) node", "text"))
    ids = {r.node: r.doc_id for r in df.selectExpr("doc_id", "xxhash64(text) node").collect()}
    token = {i: passages.tokens(pa.array([t]))[0].tolist() for i, t in rows}
    holders, want = defaultdict(set), defaultdict(set)
    for i, own in token.items():
        for p in range(len(own) - passages.TOKENS + 1):
            holders[tuple(own[p:p + passages.TOKENS])].add((i, p))
    pairs = []
    for found in holders.values():
        if len({i for i, _ in found}) > 1:
            pairs += [(min(found)[0], i) for i, _ in found]
            for i, p in found:
                want[i] |= set(range(p, p + passages.WORDS))
    got = defaultdict(set)
    for r in spans.collect():
        got[ids[r.node]] |= set(range(r.first, r.last + 1))
    assert got == want and {1000, 1001, 1002, 1003} <= set(want)
    assert classes([(ids[r.a], ids[r.b]) for r in exact.collect()], token) == classes(pairs, token)
    whole = {r.doc_id: r for r in passages.repeated_passages(df).collect()}
    assert len({whole[1000 + k].class_id for k in range(4)}) == 1
    assert all(want[i] <= {w for s in whole[i].spans for w in range(s.first, s.last + 1)} for i in want)


def test_similar_passages_in_a_family_of_variants(spark):
    rnd = random.Random(9)
    word = lambda: f"w{rnd.randrange(10**9)}"
    base = [word() for _ in range(60)]
    # Variants are of a similarity of about 0.3; each planted pair differs in one word, and from the variants as these do.
    variant = lambda: [w if k // 10 not in own else word() for own in [set(rnd.sample(range(6), 2))] for k, w in enumerate(base)]
    around = lambda text: " ".join([word() for _ in range(5)] + text + [word() for _ in range(5)])
    rows = [(i, around(variant())) for i in range(130)]
    for k in range(10):
        one = variant()
        rows += [(1000 + 2 * k, around(one)), (1001 + 2 * k, around([*one[:30], word(), *one[31:]]))]
    token = {i: passages.tokens(pa.array([t]))[0] for i, t in rows}
    pairs, spans = [], defaultdict(set)
    for x, (a, _) in enumerate(rows):
        for b, _ in rows[:x]:
            for p, q, u, v in passages.common_passages(token[a], token[b]):
                pairs.append((a, b))
                spans[a] |= set(range(p, q + 5))
                spans[b] |= set(range(u, v + 5))
    want = classes(pairs, [i for i, _ in rows])
    assert all(want[1000 + 2 * k] == want[1001 + 2 * k] for k in range(10))
    for parts in (1, 5):
        got = {r.doc_id: r for r in passages.repeated_passages(frame(spark, rows).repartition(parts)).collect()}
        assert {i: r.class_id for i, r in got.items()} == want
        for i, r in got.items():
            own = {w for s in r.spans for w in range(s.first, s.last + 1)}
            assert len(own & spans[i]) >= 0.9 * len(own | spans[i])


@pytest.mark.parametrize("repeated", (False, True))
def test_windows_of_a_group_are_compared_until_they_are_decided(repeated):
    rng = np.random.default_rng(13)
    new = lambda n: rng.integers(0, 1 << 63, n).astype(np.uint64)
    line = new(7) if repeated else new(70)
    families = [np.resize(new(5), 91) if repeated else new(91) for _ in range(6)]
    words, of = [], []
    for k in range(120):
        own = families[k % 6].copy()
        own[41:41 + len(line[:8])] = line[:8]
        if not repeated:
            own[5 + k % 30] = new(1)[0]
        words.append(own)
        of.append(k % 6)
    node = np.arange(120) + 1000
    win = np.full(120, (145 << 16) | (45 << 8) | 45)
    group = passages._Group(node, win, np.full(120, 100), words)
    found = list(group.passages())
    assert all(max(t[1] for t in spans) <= 190 and min(t[0] for t in spans) >= 100 for _, _, spans in found)
    linked = classes([(a, b) for a, b, _ in found], node.tolist())
    brute = classes([(x + 1000, y + 1000) for x in range(120) for y in range(x) if passages.common_passages(words[x], words[y])], node.tolist())
    assert linked == brute and len(set(linked.values())) == (6 if not repeated else len(set(brute.values())))
    assert len(found) < 3 * 120 or repeated


def test_a_line_just_too_short_for_a_passage_is_not_compared_by_pairs(monkeypatch):
    """Windows around a line of TOKENS - 1 tokens, some with repeated tokens, two families of passages among them."""
    rng = np.random.default_rng(17)
    new = lambda n: rng.integers(0, 1 << 63, n).astype(np.uint64)
    line, families = new(passages.TOKENS - 1), [new(91) for _ in range(2)]
    words = []
    for k in range(120):
        own = families[k % 2].copy() if k < 8 else new(91)
        own[30 if k % 3 else 7:][:len(line)] = line
        if k >= 8 and k % 5 == 0:
            own[80:88] = own[80]
        if k < 8:
            own[80 + k] = new(1)[0]
        words.append(own)
    brute = [(x + 1000, y + 1000) for y in range(120) for x in range(y) if passages.common_passages(words[x], words[y])]
    calls, compare = [], passages.common_passages
    monkeypatch.setattr(passages, "common_passages", lambda a, b: calls.append(1) or compare(a, b))
    group = passages._Group(np.arange(120) + 1000, np.full(120, (145 << 16) | (45 << 8) | 45), np.full(120, 100), words)
    found = list(group.passages())
    nodes = list(range(1000, 1120))
    assert classes([(a, b) for a, b, _ in found], nodes) == classes(brute, nodes) and brute
    assert len(calls) <= 120, len(calls)


def test_passages_of_nothing_and_of_repeated_rows(spark):
    long = " ".join(f"w{k}" for k in range(60))
    df = frame(spark, [(2, long), (2, long), (None, long), (5, "short"), (5, "short"), (None, None)], CLASHES)
    got = Counter((r.doc_id, r.class_id, r.repeated_words) for r in passages.repeated_passages(df).collect())
    assert got == {(2, 2, 60): 2, (None, 2, 60): 1, (5, 5, 0): 2, (None, None, 0): 1}
    assert passages.repeated_passages(df.limit(0)).count() == 0


def test_pairs_at_the_threshold_are_candidates():
    """Of pairs whose similarity is just 0.8, nearly all share a bucket and have sketches that are alike; of pairs at 0.5 few do."""
    rng = np.random.default_rng(4)
    share = {}
    for common in (178, 133):  # of 200 shingles each: 0.80 and 0.50
        both = 0
        for _ in range(20):
            rows = []
            for _ in range(25):
                own = rng.integers(0, 1 << 64, 2 * 200 - common, np.uint64)
                rows += [np.sort(own[:200]), np.sort(np.concatenate([own[:common], own[200:]]))]
            samples = weighted_minhash.signatures(np.concatenate(rows), np.zeros(50 * 200, np.float32), np.arange(0, 51 * 200, 200))
            band, sketch = weighted_minhash.bands(samples), weighted_minhash.sketch(samples).view(np.uint8)
            agree = (sketch[::2] == sketch[1::2]).sum(axis=1)
            assert (np.abs(agree - (samples[::2] == samples[1::2]).sum(axis=1)) <= 3).all()
            both += int(((band[::2] == band[1::2]).any(axis=1) & (agree >= 40)).sum())
        share[common] = both / 500
    assert share[178] >= 0.99 and share[133] <= 0.15, share


def test_sketches_are_compared_in_the_engine(spark):
    rng = np.random.default_rng(5)
    a = rng.integers(0, 256, (300, 64)).astype(np.uint8)
    b = np.where(rng.random((300, 64)) < rng.random((300, 1)), a, rng.integers(0, 256, (300, 64)).astype(np.uint8))
    rows = [[*map(int, x), *map(int, y)] for x, y in zip(np.ascontiguousarray(a).view("<i8"), np.ascontiguousarray(b).view("<i8"))]
    df = spark.createDataFrame(rows, ", ".join(f"{side}{k} long" for side in "sl" for k in range(8)))
    got = [r.n for r in df.select(weighted_minhash._agreeing("s", "l").alias("n")).collect()]
    assert got == (a == b).sum(axis=1).tolist()
