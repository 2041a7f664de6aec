"""The conversation trie and the dataset manifest against plain Python."""

import hashlib
import random
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest

from tarweave.llm import merkle, perfect_hash, trie

TURNS = "conv_id long, turn long, role string, text string, conv string, x string, n string, seg string, i string, shard string"
DOCS = "doc_id long, text string, lang string, source string, n_chars long, hash string, i string, n string, leaf string, path string, run string, all string"


def frame(spark, rows, schema):
    more = [None] * (len(schema.split(", ")) - len(rows[0])) if rows else []
    return spark.createDataFrame([(*r, *more) for r in rows], schema)


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


@pytest.mark.parametrize("n", [0, 1, 2, 7, 5000])
def test_slots_are_minimal_and_verified(n):
    rng = np.random.default_rng(n)
    both = rng.integers(0, 1 << 64, (2, n), np.uint64)
    # Digests that share one half.
    both[0, : n // 2] = 5
    table = perfect_hash.PerfectHash(*both)
    assert sorted(table.slots(*both).tolist()) == list(range(n)) and len(table) == n
    others = rng.integers(0, 1 << 64, (2, 1000), np.uint64)
    assert (table.slots(*others) == -1).all()


def brute_trie(turns):
    def own(rows):
        place = lambda r: (r[0] is not None, r[0] or 0, sha(f"{len((r[1] or '').encode())}:{r[1] or ''}{r[2] or ''}"))
        return [(r or "", t or "") for _, r, t in sorted(rows, key=place)]

    given = defaultdict(list)
    for c, turn, role, text in turns:
        if c is not None:
            given[c].append((turn, role, text))
    given = {c: own(rows) for c, rows in given.items()}
    built = {}
    for c, rows in given.items():
        h = zlib.crc32(str(c).encode()) % 6
        hundred = c - (abs(c) % 100) * (1 if c >= 0 else -1)
        built[c] = tuple(given.get(hundred, [])[:h] + rows[h:])
    members = defaultdict(list)
    for c, rows in built.items():
        for d in range(len(rows) + 1):
            members[rows[:d]].append(c)
    kids = Counter(p[:-1] for p in members if p)
    leaves, saved = Counter(), Counter()
    for p, m in members.items():
        for d in range(len(p) + 1):
            leaves[p[:d]] += kids[p] == 0
            saved[p[:d]] += (len(m) - 1) * len(p[-1][1]) if p else 0
    out = Counter()
    for p, m in members.items():
        end = ",".join(map(str, sorted(c for c in m if len(built[c]) == len(p))))
        out[min(m), len(p), min(members[p[:-1]]) if p else None, len(m), kids[p], leaves[p], saved[p], sha(end)] += 1
    return out


def made_turns(seed):
    rnd = random.Random(seed)
    say = lambda: (rnd.choice(["user", "assistant", None]), rnd.choice(["yes", "no", "höhé", "", None, "😀😀"]))
    rows = []
    for c in [*range(0, 130, 3), 200, 201, 205, 299, 301, 302, 307, -5, -100, -107, 10**12, 10**12 + 7]:
        # Few texts, so that long prefixes are shared.
        for t in range(rnd.choice([0, 1, 2, 3, 9, 12])):
            rows.append((c, rnd.choice([t, t, t, None]), *(say() if rnd.random() < 0.3 else ("user", "yes"))))
    rows += [rows[0], rows[0], (None, 0, "user", "nobody's"), (130, 1, "user", "ab"), (131, 1, "usera", "b")]
    rows += [(c, t, "user", f"long {t // 3}") for c in (400, 401, 402, 500) for t in range(40 - c % 5)]
    return rows


@pytest.mark.parametrize("seed, size, shard_rows", [(0, 4096, 200_000), (1, 4, 50), (2, 1, 20), (3, 7, 90)])
def test_trie(spark, seed, size, shard_rows):
    rows = made_turns(seed)
    df = frame(spark, rows, TURNS).repartition(5)
    got = Counter(tuple(r) for r in trie.conversation_trie(df, size, shard_rows).collect())
    assert got == brute_trie(rows)


def test_trie_of_nothing_and_of_many_ends(spark):
    assert trie.conversation_trie(frame(spark, [], TURNS)).count() == 0
    assert trie.conversation_trie(frame(spark, [(None, 1, "user", "x")], TURNS)).count() == 0
    # Conversations that end at one node, in many pieces of ids; turnless ones end at the root.
    rows = [(c * 100, 1, "user", "same") for c in range(25_000)]
    got = Counter(tuple(r) for r in trie.conversation_trie(frame(spark, rows, TURNS).repartition(6), shard_rows=3000).collect())
    assert got == brute_trie(rows)


def brute_manifest(rows):
    lower = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")

    def leaf(doc_id, text, lang, source, n_chars):
        return sha("".join("-" if v is None else f"{len(str(v).encode())}:{v}" for v in (doc_id, source, lang, n_chars, text)))

    def tree(hashes):
        """The root and every leaf's steps."""
        paths, at, now = [[] for _ in hashes], list(range(len(hashes))), hashes
        while len(now) > 1:
            for k, i in enumerate(at):
                run, slot = i // 16 * 16, i % 16
                paths[k].append((now[run:run + slot], now[run + slot + 1:run + 16]))
            now, at = [sha("".join(now[k:k + 16])) for k in range(0, len(now), 16)], [i // 16 for i in at]
        return now[0], paths

    sources = defaultdict(list)
    for r in rows:
        changed = (r[0], r[1].translate(lower), *r[2:]) if r[1] is not None and r[0] is not None and zlib.crc32(str(r[0]).encode()) % 5 == 0 else r
        sources[r[3]].append((r[0] is not None, r[0] or 0, leaf(*r), leaf(*changed)))
    order = sorted(sources, key=lambda s: (s is not None, (s or "").encode()))
    trees = {s: tree([r[2] for r in sorted(sources[s])]) for s in order}
    root, above = tree([trees[s][0] for s in order])
    out = Counter()
    for s, higher in zip(order, above):
        for (known, doc_id, own, other), path in zip(sorted(sources[s]), trees[s][1]):
            now, proof = other, ""
            for left, right in path + higher:
                now = sha("".join([*left, now, *right]))
                proof += "".join(left + right)
            out[doc_id if known else None, own, trees[s][0], root, sha(proof), now, now == root] += 1
    return out


def made_rows(seed, sources):
    rnd = random.Random(seed)
    rows = []
    for s, n in sources.items():
        rows += [(rnd.randrange(10**6), rnd.choice(["Text É", "lower", "", None, "Ä" * 50]), rnd.choice(["en", None]), s, rnd.choice([4, None])) for _ in range(n)]
    rows += [rows[0], rows[0], (rows[0][0], "other", None, rows[0][3], 1), (None, "No id", "en", rows[0][3], 2), (None, None, None, rows[0][3], None)]
    rnd.shuffle(rows)
    return rows


@pytest.mark.parametrize("sources", [{"one": 1, "é": 2, None: 16, "run": 17, "hot": 700, "": 3}, {"only": 40}, {f"s{k}": k % 4 + 1 for k in range(300)}])
def test_manifest(spark, sources):
    rows = made_rows(len(sources), sources)
    got = Counter(tuple(r) for r in merkle.verify(merkle.manifest(frame(spark, rows, DOCS).repartition(4))).collect())
    assert got == brute_manifest(rows)
    assert any(not k[-1] for k in got) and any(k[-1] for k in got)


def test_manifest_of_one_and_of_no_row(spark):
    df = frame(spark, [(5, "A", "en", "s", 1)], DOCS)
    row, = merkle.verify(merkle.manifest(df)).collect()
    assert row.leaf == row.subroot == row.root and row.proof_sha256 == sha("")
    assert merkle.verify(merkle.manifest(df.limit(0))).count() == 0
