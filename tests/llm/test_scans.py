"""License scans, benchmark matches, quality, URL filters, chat formatting."""

import random
import re
import zlib
from collections import Counter, defaultdict

import duckdb
import numpy as np
import pyarrow as pa
import pytest

from tarweave.llm import chat, licenses, quality, templates, urls
from tarweave.session import ship_package

CLASHES = "id long, print string, words string, n_words string, blocks string, label string, hash string, n string, item string, score string, predicted string, _id string, _print string, _key string, _stays string, _n string, mark string, key_id string, key_mark string"


def frame(spark, rows, schema, extra=CLASHES):
    return spark.createDataFrame([(*r, *[None] * len(extra.split(", "))) for r in rows], f"{schema}, {extra}")


def licensed_texts():
    rnd = random.Random(4)
    vocabulary = sorted({w for t in licenses._templates() for w in t[3]}) + ["Zeile", "mot", "é", "ü-x"]
    rows = [(i, " ".join(rnd.choice(vocabulary) + rnd.choice(["", ",", ".\n"]) for _ in range(rnd.randrange(0, 200)))) for i in range(40)]
    for i, (_, text) in enumerate(licenses.PHRASES + licenses.STATEMENTS):
        rows.append((100 + i, "Word " * (60 + i) + text.upper() + " more " + text + "."))
    return rows + [(200, None), (201, ""), (202, "the mit license"), (203, "under the mit license under the mit license")]


def test_license_scan_is_the_brute_force(spark):
    rows = licensed_texts()
    got = licenses.license_scan(frame(spark, rows, "doc_id long, text string")).collect()
    con = duckdb.connect()
    con.register("documents", pa.table({"doc_id": [r[0] for r in rows], "text": [r[1] for r in rows]}))
    cursor = con.execute(licenses.brute_force_sql())
    names = [d[0] for d in cursor.description]
    want = {dict(zip(names, r))["doc_id"]: dict(zip(names, r)) for r in cursor.fetchall()}
    assert {r.doc_id: r.asDict() for r in got} == want
    assert {l for r in got for l in r.labels.split(",") if l} == {l for l, _ in licenses.PHRASES + licenses.STATEMENTS}


def test_license_scan_of_repeated_rows_and_nothing(spark):
    df = frame(spark, [(None, "Under the MIT license."), (None, "Under the MIT license."), (None, None), (1, "x"), (1, "cc by nc")], "doc_id long, text string")
    got = Counter((r.doc_id, r.n_words, r.n_base, r.base_labels) for r in licenses.license_scan(df).collect())
    assert got == {(None, 4, 1, "mit"): 2, (None, 0, 0, ""): 1, (1, 1, 0, ""): 1, (1, 3, 1, "cc-by-nc"): 1}
    assert licenses.license_scan(df.limit(0)).count() == 0


QUESTION = "Then John Smith has 3 apples, and Mary Jones bought 12 apples from him for 5 dollars; how many apples does John Smith keep?"


def test_exchanged_slots_are_found_when_consistent(spark):
    other = QUESTION.replace("John Smith", "Anna Bell").replace("3", "70").replace("dollars", "euros")
    mixed = QUESTION.replace("keep", "lose").replace("does John Smith", "does Peter Brown")
    rows = [
        (1, "Before it all. " + QUESTION + " After."), (2, "x " + other), (3, mixed), (4, "Nothing of the kind is in this text at all, not a word."),
        (5, None), (6, ""), (7, QUESTION.upper()), (8, " ".join([QUESTION] * 3)), (8, QUESTION), (8, QUESTION), (None, QUESTION),
    ]
    items = [(1, QUESTION), (1, QUESTION), (2, "only seven words are in here now"), (3, None), (None, None)]
    df = frame(spark, rows, "doc_id long, text string")
    bench = spark.createDataFrame(items, "item_id long, text string")
    got = templates.benchmark_matches(df, bench).collect()
    by = Counter((r.doc_id, r.item_id) for r in got)
    assert by == {(1, 1): 1, (2, 1): 1, (7, 1): 1, (8, 1): 2, (None, 1): 1}
    one = {(r.doc_id, r.places): r for r in got}
    assert one[1, 1].exchanged == 0 and one[1, 1].coverage > 0.9 and one[1, 1].first_word <= 4
    assert one[2, 1].exchanged >= 4 and one[8, 3].places == 3
    kept = templates.drop_contaminated(df, bench)
    assert kept.columns == df.columns and sorted(r.doc_id for r in kept.collect()) == [3, 4, 5, 6]
    assert templates.benchmark_matches(df.limit(0), bench).count() == 0
    assert templates.drop_contaminated(df, bench.limit(0)).count() == len(rows)


def read_words(text):
    """``(word, kind)`` of a text of ASCII signs: 0 a literal, else what it stands for."""
    out = []
    for k, m in enumerate(re.finditer(r"[0-9A-Za-z]+", text)):
        word, at = m.group(), m.start()
        kind = 1 if word.isdigit() else 0
        if word.lower() in templates.UNITS:
            kind = 2
        named = word[0].isupper() and len(word) > 1 and not word[1].isupper()
        if kind == 0 and k and named and text[at - 1] in " \t" and text[at - 2] not in ".!?:;\n\r\"'([{ \t":
            kind = 3
        out.append((word.lower(), kind))
    return out


def read_windows(text, shorter=None):
    """``{key: [(place, values)]}`` of a text's windows, and how many places there are; ``shorter`` are lengths of short items."""
    words, found = read_words(text), []
    for at in range(len(words) - 7):
        own = words[at:at + 8]
        plain = [(w, 0 if k == 3 else k) for w, k in own]
        ways = [plain] if sum(k == 0 for _, k in plain) >= 4 else []
        if not ways:
            found.append((("words", *(w for w, _ in own)), at, ()))
        if any(k == 3 for _, k in own) and sum(k == 0 for _, k in own) >= 4:
            ways.append(own)
        for way in ways:
            found.append((("template", *(k or w for w, k in way)), at, tuple((w, k) for w, k in way if k)))
    for n in range(1, 8) if shorter is None else shorter:
        if shorter is not None or len(words) == n:
            found += [(("words", *(w for w, _ in words[at:at + n])), at, ()) for at in range(len(words) - n + 1)]
    return found, max(len(words) - 7, min(len(words), 1))


def brute_matches(docs, items):
    shorter = {n for _, t in items if 0 < (n := len(read_words(t))) < 8}
    out = []
    for item, wanted in items:
        own, total = read_windows(wanted)
        for doc_id, text in docs:
            distances = defaultdict(list)
            for key, pos, values in read_windows(text, shorter)[0]:
                for other, place, theirs in own:
                    if key == other:
                        distances[pos - place].append((place, pos, list(zip(theirs, values))))
            runs = []
            for found in distances.values():
                pairs = {p for _, _, values in found for p in values}
                if len({a for a, _ in pairs}) == len(pairs):
                    runs.append(({place for place, _, _ in found}, min(pos for _, pos, _ in found), sum(a != b for a, b in pairs), len(pairs)))
            seen = set().union(*(r[0] for r in runs))
            if total and len(seen) / total >= 0.5:
                best = max((len(r[0]), -r[2], r[3]) for r in runs)
                out.append((doc_id, item, len(seen), len(seen) / total, best[2], -best[1], min(r[1] for r in runs), len(runs)))
    return sorted(out)


@pytest.mark.parametrize("seed", range(4))
def test_matches_equal_all_windows_at_all_distances(spark, seed):
    """Random items, and documents that hold them with values exchanged, consistently or not, cut and repeated."""
    rnd = random.Random(seed)
    vocabulary = "the a of keep give box train walks each then how many left after buy Paris Lima Anna Bell 3 12 70 5 5 km hours dollars days".split()
    items = []
    for i in range(12):
        n = rnd.choice([1, 4, 7, 8, 9, 14, 25])
        items.append((i, " ".join(rnd.choice(vocabulary) + rnd.choice(["", "", "", ".", ","]) for _ in range(n)).capitalize()))
    docs = []
    for k in range(60):
        parts = []
        for _ in range(rnd.randrange(1, 4)):
            text = rnd.choice(items)[1]
            for a, b in (("3", "44"), ("70", "8"), ("Anna", "Peter"), ("Lima", "Rome"), ("km", "miles")):
                if rnd.random() < 0.4:
                    text = re.sub(rf"\b{a}\b", b, text, count=rnd.choice([0, 0, 1]))
            words = text.split(" ")
            if rnd.random() < 0.3:
                words = words[rnd.randrange(len(words)):]
            if rnd.random() < 0.3:
                words[rnd.randrange(len(words))] = "instead"
            parts += [" ".join(words), " ".join(rnd.choice(vocabulary) for _ in range(rnd.randrange(6)))]
        docs.append((k, rnd.choice([" ", ". ", "\n"]).join(parts)))
    got = templates.benchmark_matches(frame(spark, docs, "doc_id long, text string"), spark.createDataFrame(items, "item_id long, text string"))
    columns = ("doc_id", "item_id", "windows", "coverage", "slots", "exchanged", "first_word", "places")
    want = brute_matches(docs, items)
    assert sorted(tuple(r) for r in got.select(*columns).collect()) == want
    assert len(want) > 30 and any(r[5] for r in want)


def test_items_of_numbers_and_short_items_are_found(spark):
    sums = "What is 12 + 7 + 30 + 41 + 5 + 66 + 7 + 81 + 9 + 10 + 11 + 2 + 13 altogether"
    sequence = "2 4 8 16 32 64 128 256 512"
    items = [(1, sums), (2, sequence), (3, "Who wrote Moby Dick?"), (4, "42")]
    rows = [
        (1, f"Before it. {sums} and after."), (2, sums.replace("41", "40").replace("66", "65")), (3, f"x {sequence} y"),
        (4, "2 4 8 16 32 64 128 257 512"), (5, "they asked: who wrote moby dick, again"), (6, "who wrote of Moby Dick"), (7, "42"),
        (8, "nothing of the kind is in here at all today"), (9, "Who wrote Moby"),
    ]
    df = frame(spark, rows, "doc_id long, text string")
    bench = spark.createDataFrame(items, "item_id long, text string")
    got = {(r.doc_id, r.item_id): r for r in templates.benchmark_matches(df, bench).collect()}
    assert set(got) == {(1, 1), (3, 2), (5, 3), (7, 4)}
    assert all(r.coverage == 1 and r.exchanged == 0 for r in got.values()) and got[5, 3].first_word == 2
    assert sorted(r.doc_id for r in templates.drop_contaminated(df, bench).collect()) == [2, 4, 6, 8, 9]


def test_windows_against_words():
    rnd = random.Random(5)
    vocabulary = ["alpha", "beta", "Gamma", "7", "12", "km", "x.", "Delta!"]
    texts = [" ".join(rnd.choice(vocabulary) for _ in range(rnd.randrange(0, 30))) for _ in range(50)] + ["", None]
    found = templates.windows(pa.array(texts), templates._word_hashes(templates.UNITS))
    counts = [len((t or "").split()) for t in texts]
    assert np.array_equal(np.diff(found.rows), counts)
    plain = Counter(found.row[~found.named].tolist())
    assert all(plain[i] <= max(c - templates.WINDOW + 1, 0) for i, c in enumerate(counts))
    kind = templates.kinds(templates.find_words(pa.array(["go John to 12 km. Then we"])), templates.find_words(pa.array(["go John to 12 km. Then we"])).hashes(), templates._word_hashes(["km"]))
    assert kind.tolist() == [0, templates.NAME, 0, templates.NUMBER, templates.UNIT, 0, 0]


def lines_of(text):
    return (text or "").split("\n")


def test_lines():
    texts = ["a b\n\nC!!\n", "", None, "x", "\n", "one one\none one"]
    found = quality.find_lines(pa.array(texts))
    lines = [line for t in texts for line in lines_of(t)]
    assert np.diff(found.rows).tolist() == [len(lines_of(t)) for t in texts]
    assert found.lengths.tolist() == [len(line.encode()) for line in lines]
    upper = [sum(c.isupper() for c in line) / max(len(line), 1) for line in lines]
    assert np.allclose(found.features[:, 0], upper)
    assert found.features[-1, -1] == 1 and found.features[-2, -1] == 0 and found.features[-1, -2] == 0.5


def test_marginals_are_those_of_all_labellings():
    rng = np.random.default_rng(0)
    rows = np.array([0, 1, 5, 8])
    x = rng.normal(size=(8, 3))
    field = quality.Field(rng.normal(size=3), rng.normal(size=(2, 2)))
    good, changes, total = field.marginals(x, rows)
    want, logs, pairs = np.zeros(8), 0.0, np.zeros((2, 2))
    for a, b in zip(rows[:-1], rows[1:]):
        weights, each = [], []
        for code in range(2 ** (b - a)):
            y = [(code >> k) & 1 for k in range(b - a)]
            value = sum(x[a + k] @ field.weights * y[k] for k in range(b - a)) + sum(field.change[p, q] for p, q in zip(y, y[1:]))
            weights.append(np.exp(value))
            each.append(y)
        weights = np.array(weights)
        logs += np.log(weights.sum())
        weights /= weights.sum()
        want[a:b] = weights @ np.array(each)
        for w, y in zip(weights, each):
            for p, q in zip(y, y[1:]):
                pairs[p, q] += w
    assert np.allclose(good, want) and np.allclose(total, logs) and np.allclose(changes, pairs)


def test_quality_of_held_out_documents(spark):
    ship_package(spark)
    rnd = random.Random(9)
    rows, labels = [], []
    for i in range(400):
        bad = i % 4 == 0
        word = lambda: "".join(rnd.choice("abcdefgh") for _ in range(rnd.randrange(2, 8)))
        line = lambda: " ".join(word().upper() + "!!" if bad and rnd.random() < 0.8 else word() for _ in range(rnd.randrange(3, 12)))
        rows.append((i, "\n".join(line() for _ in range(rnd.randrange(1, 8)))))
        labels.append((i, int(not bad)))
    rows += [(None, None), (None, ""), (7, rows[7][1]), (5000, "word " * 20_000 + "\n" * 3000)]
    df = frame(spark, rows, "doc_id long, text string")
    known = spark.createDataFrame(labels + [(None, 1), (3, None), (7, 1)], "doc_id long, quality int")
    field = quality.train(df, known)
    out = quality.judge(df.withColumn("held_out", quality.held_out(df.doc_id)), field)
    got = out.select("doc_id", "held_out", "score", "predicted").collect()
    truth = dict(labels)
    held = [r for r in got if r.held_out and r.doc_id in truth]
    assert len(held) > 60 and np.mean([r.predicted == truth[r.doc_id] for r in held]) > 0.97
    assert all(r.held_out == (r.doc_id is not None and zlib.crc32(str(r.doc_id).encode()) % 4 == 2) and 0 <= r.score <= 1 and r.predicted == (r.score >= 0.7) for r in got)
    assert quality.train(df, known.limit(0)) == 0.5 and quality.train(df.limit(0), known) == 0.5
    assert quality.judge(df, 0.5).where("score = 0.5").count() == len(rows)


def test_patterns(spark):
    rows = [(1, "HTTP://u:p@A.b.Example.com:80/x/y.html?q#f"), (2, "no url"), (3, None), (4, "https://h.org"), (5, "")]
    got = {r.i: r.p for r in spark.createDataFrame(rows, "i long, url string").select("i", urls.patterns_of(__import__("pyspark.sql.functions").sql.functions.col("url")).alias("p")).collect()}
    assert got[1] == ["a.b.example.com", "b.example.com", "example.com", "com", "a.b.example.com/x", "a.b.example.com/x/y.html"]
    assert got[4] == ["h.org", "org"] and got[2] == got[3] == got[5] == []


def test_captures_against_dated_entries(spark):
    rnd = random.Random(6)
    entries = [(rnd.choice(["bad.com", "x.bad.com", "ok.org/de", "org", None]), rnd.choice(["spam", "ads", None]), rnd.randrange(0, 400) * 86400, rnd.random() < 0.6) for _ in range(80)]
    entries += entries[:5]
    captures = [(i, rnd.choice(["http://bad.com/a", "http://x.bad.com", "https://ok.org/de/x", "https://ok.org/deutsch", "http://fine.net", None]), rnd.choice([None, rnd.randrange(0, 500) * 43200])) for i in range(300)]
    df = spark.createDataFrame([(*c, "e", "e") for c in captures], "id long, url string, fetched_at long, pattern string, categories string")
    got = {r.id: r.categories for r in urls.judge(df, spark.createDataFrame(entries, "pattern string, category string, at long, listed boolean")).collect()}
    state = {}
    for p, c, at, on in entries:
        if None not in (p, c, at, on):
            state[p, c, at] = state.get((p, c, at), False) or on
    for i, url, when in captures:
        host, _, path = (url or "").partition("://")[2].partition("/")
        under = lambda p: host == p or host.endswith("." + p) or f"{host}/{path}" == p or f"{host}/{path}".startswith(p + "/")
        last = {}
        for (p, c, at), on in sorted(state.items(), key=lambda e: e[0][2]):
            if when is not None and at <= when and url and under(p):
                last[p, c] = on
        assert got[i] == ",".join(sorted({c for (_, c), on in last.items() if on})), (i, url, when)
    # Rows that repeat an id are judged each by itself.
    listed = spark.createDataFrame([("bad.com", "spam", 0, True)], "pattern string, category string, at long, listed boolean")
    same = [(1, "http://bad.com/a", 5), (1, "http://fine.net", 5), (1, "http://bad.com/a", -5), (1, "http://bad.com/a", 5), (None, "http://bad.com", 9), (None, None, None)]
    judged = Counter(tuple(r) for r in urls.judge(spark.createDataFrame(same, "id long, url string, fetched_at long"), listed).collect())
    assert judged == Counter((*r, "spam" if r[1] and "bad" in r[1] and r[2] > 0 else "", not (r[1] and "bad" in r[1] and r[2] > 0)) for r in same)
    assert urls.judge(df.limit(0), spark.createDataFrame([], "pattern string, category string, at long, listed boolean")).count() == 0


def test_chats_keep_the_longest(spark, monkeypatch):
    monkeypatch.setattr(chat, "BLOCK", 3)
    rnd = random.Random(3)
    talks = [[("user", rnd.choice("abc"))] for _ in range(6)]
    for _ in range(40):
        talks.append(list(rnd.choice(talks)) + [(rnd.choice(["user", "assistant", ""]), rnd.choice(["a", "b", ""])) for _ in range(rnd.randrange(0, 4))])
    rows = [(i, k, r or None, t or None, "clash") for i, talk in enumerate(talks) for k, (r, t) in enumerate(talk)]
    df = spark.createDataFrame(rows + rows[:4], "conv_id long, turn long, role string, text string, n string")
    got = {r.conv_id: (r.turns, r.text) for r in chat.format_chats(df).collect()}
    want = {}
    for i, talk in enumerate(talks):
        longer = any(len(o) > len(talk) and o[:len(talk)] == talk for o in talks)
        if not longer and talks.index(talk) == i:
            want[i] = (len(talk), "".join(f"<|{r}|>\n{t}\n<|end|>\n" for r, t in talk))
    assert got == want
    assert chat.format_chats(df.limit(0)).count() == 0
    odd = spark.createDataFrame([(None, None, "user", "x"), (None, 1, None, None), (1, 1, "user", "x")], "conv_id long, turn long, role string, text string")
    assert {(r.conv_id, r.turns) for r in chat.format_chats(odd).collect()} == {(None, 2)}
