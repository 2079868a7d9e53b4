"""Decontamination, Merkle manifest and periodic runs against brute-force versions."""

import hashlib
import random
import re
import zlib

import pytest
from pyspark.sql import functions as F

from sensorloom.llm import decontaminate, merkle, periodic, queries
from tests.llm import samples

PLAIN = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
ROWS = samples.documents()


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


@pytest.fixture(scope="module")
def docs(spark):
    return spark.createDataFrame(ROWS, samples.SCHEMA).repartition(3).persist()


@pytest.fixture(scope="module")
def empty(spark):
    return spark.createDataFrame([], samples.SCHEMA)


# 11: decontamination


def normal_words(text):
    return PLAIN.findall((text or "").translate(samples.LOWER))


def brute_hits(text, items, k=10):
    """(words, hit places, item ids) of one text; items: (id, text)."""
    words, hit, found = normal_words(text), set(), set()
    for item, said in items:
        w = normal_words(said)
        for i in range(max(1, len(w) - k + 1)) if w else ():
            window = w[i : i + k]
            for j in range(len(words) - len(window) + 1):
                if words[j : j + len(window)] == window:
                    hit |= set(range(j, j + len(window)))
                    found |= {str(item)} if item is not None else set()
    return words, hit, sorted(found)


def benchmark_rows():
    first = " ".join(ROWS[0][1].split()[2:30])
    return [
        (1, first), (10, first.upper() + "!!"), (2, "(" + " ".join(ROWS[4][1].split()[:7]) + ")"), (3, "Word"), (None, " ".join(ROWS[8][1].split()[:12])),
        (4, None), (5, ""), (6, "  \t. "), (7, "a a a"), (7, " ".join(ROWS[9][1].split()[1:14])), (8, "nowhere to be found " * 5), (9, "é" * 130),
    ]


@pytest.fixture(scope="module")
def bench(spark):
    return spark.createDataFrame(benchmark_rows(), "item_id long, text string")


@pytest.mark.parametrize("limits", [{}, {"pairs_per_automaton": 9}, {"bytes_per_automaton": 300}])
def test_hits_against_brute_force(docs, bench, limits):
    found = decontaminate.find(docs, bench, window=10, carry=("source", "text"), **limits)
    cut = found.withColumn("left", decontaminate.cut(F.col("text"), F.col("hits"))).join(decontaminate.digest(found).drop("n_words"), "doc_id")
    got = {r["doc_id"]: r for r in cut.collect()}
    assert len(got) == len(ROWS)
    for i, text, _, source, _ in ROWS:
        words, hit, items = brute_hits(text, benchmark_rows())
        r = got[i]
        assert (r["n_words"], r["n_hit"], r["items"], r["source"]) == (len(words), len(hit), items, source)
        assert (r["n_items"], r["items_sha256"], r["contaminated"]) == (len(items), sha(",".join(items)), bool(hit))
        covered = [w for h in r["hits"] for w in normal_words((text or "")[h["start"] : h["end"]])]
        assert covered == [words[p] for p in sorted(hit)]
        assert all(a["last"] + 1 < b["first"] for a, b in zip(r["hits"], r["hits"][1:]))
        outside = text or ""
        for h in reversed(r["hits"]):
            outside = outside[: h["start"]] + outside[h["end"] :]
        assert r["left"] == outside


def test_words_are_read_in_pieces(spark, monkeypatch):
    rng = random.Random(5)
    words = [rng.choice("abc") * rng.randint(1, 3) for _ in range(4000)]
    items = [(i, " ".join(words[p : p + 14])) for i, p in enumerate(range(0, 4000, 400))]
    matcher = decontaminate.Matcher([(b" ".join(w.encode() for w in normal_words(t)[i : i + 10]), [str(n)]) for n, t in items for i in range(5)])
    monkeypatch.setattr(decontaminate, "_PIECE_BYTES", 64)
    n, runs, found = matcher.scan(" ".join(words).encode())
    _, hit, ids = brute_hits(" ".join(words), items)
    assert n == 4000 and {p for a, b in runs for p in range(a, b + 1)} == hit and matcher.listed(found) == ids


def test_decontamination_of_nothing(docs, bench, empty):
    none = decontaminate.digest(decontaminate.find(docs, bench.limit(0)))
    assert none.where("contaminated or n_hit > 0 or n_items > 0").isEmpty() and none.count() == len(ROWS)
    assert decontaminate.find(empty, bench).count() == 0
    assert decontaminate.find(empty, bench, pairs_per_automaton=5).count() == 0


def test_decontamination_of_repeated_and_null_keys(spark, bench):
    text = benchmark_rows()[0][1]
    rows = [(1, text, 5), (1, text, 6), (1, None, 7), (None, text, 8), (None, "x", 9)]
    twice = spark.createDataFrame(rows, "doc_id long, text string, _uid long")
    for limits in ({}, {"pairs_per_automaton": 9}):
        found = decontaminate.digest(decontaminate.find(twice, bench, carry=("_uid",), **limits)).collect()
        assert sorted(r["n_hit"] for r in found) == sorted(len(brute_hits(t, benchmark_rows())[1]) for _, t, _ in rows)


# 12: Merkle manifest


def h(*parts):
    return sha("".join(parts))


def brute_leaf(*values):
    return h(*["-" if v is None else f"{len(str(v).encode())}:{v}" for v in values])


def brute_tree(leaves, fanout):
    """Root, and for each leaf its list of (left, right) siblings."""
    ways, level, below = [[] for _ in leaves], list(leaves), [[i] for i in range(len(leaves))]
    while len(level) > 1:
        up, under = [], []
        for i in range(0, len(level), fanout):
            run = level[i : i + fanout]
            for j in range(len(run)):
                for leaf in below[i + j]:
                    ways[leaf].append(("".join(run[:j]), "".join(run[j + 1 :])))
            up.append(h(*run))
            under.append([x for b in below[i : i + fanout] for x in b])
        level, below = up, under
    return level[0], ways


def brute_manifest(rows, fanout):
    """(doc_id, leaf, subroot, root, siblings) of rows (doc_id, text, lang, source, n_chars), sorted."""
    groups = {}
    for i, text, lang, source, n in rows:
        groups.setdefault(lang, []).append(((i is not None, i or 0), brute_leaf(i, source, lang, n, text), i))
    order = sorted(groups, key=lambda g: (g is not None, (g or "").encode()))
    subroots, lower = [], []
    for g in order:
        groups[g].sort()
        root, ways = brute_tree([x[1] for x in groups[g]], fanout)
        subroots.append(root)
        lower.append(ways)
    root, upper = brute_tree(subroots, fanout)
    return sorted(
        ((x[2], x[1], sub, root, tuple(way + up)) for g, sub, ways, up in zip(order, subroots, lower, upper) for x, way in zip(groups[g], ways)), key=repr
    )


def many_rows():
    langs = ["en", "é", "zz", None, "", "one", "en"]
    rows = [(i, t, langs[i % 5], s, n if i % 6 else None) for i, t, _, s, n in ROWS]
    rows += [(1000 + i, f"t{i}", "en", "x", i) for i in range(150)]
    return rows + [rows[3], rows[3], rows[3], (None, "no id", "en", None, 1), (None, None, None, None, None), (77_000, "alone", "one", "s", 5)]


@pytest.mark.parametrize(("fanout", "levels"), [(2, 12), (2, 3), (3, 2), (5, 1)])
def test_manifest_against_brute_force(spark, fanout, levels):
    rows = many_rows()
    table = spark.createDataFrame(rows, samples.SCHEMA).withColumn("grp", F.lit("clash")).withColumn("steps", F.lit(1)).repartition(5)
    made = merkle.verify(merkle.manifest(table, fanout=fanout, levels=levels)).collect()
    got = sorted(((r["doc_id"], r["leaf"], r["subroot"], r["root"], tuple((s["left"], s["right"]) for s in r["steps"])) for r in made), key=repr)
    assert got == brute_manifest(rows, fanout)
    for r in made:
        assert r["proof_sha256"] == sha("".join(s["left"] + s["right"] for s in r["steps"]))
        assert r["folded_root"] == r["root"] and r["verified"]


def test_one_row_is_its_own_root(spark, empty):
    row = merkle.verify(merkle.manifest(spark.createDataFrame([(5, None, None, None, None)], samples.SCHEMA))).first()
    assert row["leaf"] == row["subroot"] == row["root"] == row["folded_root"] == h("1:5", "-", "-", "-", "-")
    assert row["proof_sha256"] == sha("")
    assert merkle.manifest(empty).count() == 0


def test_a_shown_leaf_that_differs_is_found(spark, tmp_path):
    spark.createDataFrame(many_rows(), samples.SCHEMA).write.parquet(str(tmp_path / "documents.parquet"))
    rows = queries.op12_merkle_manifest(spark, str(tmp_path)).collect()
    null_size = {i for i, _, _, _, n in many_rows() if n is None}
    for r in rows:
        tampered = r["doc_id"] is not None and zlib.crc32(str(r["doc_id"]).encode()) % 7 == 0 and r["doc_id"] not in null_size
        assert r["verified"] == (not tampered) == (r["folded_root"] == r["root"])
    assert any(not r["verified"] for r in rows)


# 13: periodic runs


def brute_runs(words):
    """(start, length, smallest period) of the runs, by start and period."""
    n, found = len(words), {}
    for q in range(1, n // 3 + 1):
        x = 0
        while x + q < n:
            if words[x] != words[x + q]:
                x += 1
                continue
            y = x
            while y + q < n and words[y] == words[y + q]:
                y += 1
            if y - x + q >= max(24, 3 * q):
                found.setdefault((x, y - x + q), q)
            x = y
    return sorted(((s, length, q) for (s, length), q in found.items()), key=lambda r: (r[0], r[2]))


def brute_digest(words):
    runs = brute_runs(words)
    dropped = {i for s, length, q in runs for i in range(s + q, s + length)}
    best = min(runs, key=lambda r: (-r[1] / r[2], r[0], r[2])) if runs else (None, None, None)
    milli = 1000 * best[1] // best[2] if runs else None
    lines = "".join(f"{s},{length},{q}\n" for s, length, q in runs)
    return len(runs), *best, milli, sha(lines), sha(" ".join(w for i, w in enumerate(words) if i not in dropped))


def repetitive(seed=11, n=70):
    rng = random.Random(seed)
    say = lambda k, letters: [rng.choice(letters) for _ in range(k)]
    texts = [None, "", " \n", "a " * 23, "a " * 24, "a b " * 12, "x " * 500, "ab\n" * 30, "a b c " * 400 + "a b d " * 300]
    for i in range(n):
        words = say(rng.randint(0, 60), "abcde")
        for _ in range(rng.randint(1, 5)):
            p = rng.choice([1, 2, 3, 5, 7, 8, 9, 15, 16, 17, 31, 32, 40, 63, 64, 90])
            unit = say(p, "abcdefgh" if i % 2 else "ab")
            words += (unit * 12)[: rng.randint(p, 12 * p)] + say(rng.randint(0, 9), "abc")
        texts.append(rng.choice([" ", "\n", "  ", "\t"]).join(words))
    return [(i, t) for i, t in enumerate(texts)]


def test_runs_against_brute_force(spark):
    rows = repetitive()
    table = spark.createDataFrame([(i, t, i, [1]) for i, t in rows], "doc_id long, text string, _uid long, runs array<int>").repartition(2)
    got = {r["doc_id"]: tuple(r)[1:] for r in periodic.digest(periodic.find_runs(table)).collect()}
    assert got == {i: brute_digest(samples.WORD.findall(t or "")) for i, t in rows}
    assert sum(1 for v in got.values() if v[0]) > 60


def test_a_long_text_of_equal_words(spark):
    n = 40_000
    got = periodic.digest(periodic.find_runs(spark.createDataFrame([(1, "w " * n)], "doc_id long, text string"))).first()
    assert tuple(got)[1:6] == (1, 0, n, 1, 1000 * n)
    assert got["collapsed_sha256"] == sha("w")


def test_fragments_meet_in_any_order(spark):
    rows = [(1, 4, 0, 20), (1, 4, 12, 30), (1, 4, 30, 41), (1, 4, 43, 60), (1, 5, 0, 20), (2, 4, 0, 20), (1, 4, 5, 8)]
    made = periodic.stitched(spark.createDataFrame(rows[::-1], "uid long, period long, first long, after long"))
    assert sorted(tuple(r) for r in made.collect()) == [(1, 0, 25, 5), (1, 0, 45, 4), (1, 43, 21, 4), (2, 0, 24, 4)]


def test_z_values_by_definition():
    rng = random.Random(2)
    for _ in range(200):
        s = [rng.randint(0, 1) for _ in range(rng.randint(1, 30))]
        want = [next((k for k in range(len(s) - i) if s[k] != s[i + k]), len(s) - i) for i in range(len(s))]
        upto = rng.randint(1, 30)
        assert periodic.z_values(s, upto) == want[: min(upto, len(s))]


def test_planted_runs(spark, tmp_path):
    rows = [(i, t, None, None, None) for i, t, *_ in ROWS] + [(1000 + i, " ".join(f"w{j}" for j in range(i)), None, None, None) for i in range(0, 160, 2)]
    rows += [(None, "no id " * 9, None, None, None)]
    spark.createDataFrame(rows, samples.SCHEMA).write.parquet(str(tmp_path / "documents.parquet"))
    got = {r["doc_id"]: tuple(r)[1:] for r in queries.op13_periodic_runs(spark, str(tmp_path)).collect()}
    for i, text, *_ in rows:
        words = samples.WORD.findall(text or "")
        drawn = zlib.crc32(str(i).encode()) if i is not None else 1
        g, n = drawn // 10, len(words)
        if drawn % 10 == 0 and n:
            a = g % n
            p = 1 + (n - a) // (3 + g % 8)
            words = [words[j] if j < a else words[a + (j - a) % p] for j in range(n)]
        assert got[i] == brute_digest(words)


def test_runs_of_repeated_keys_and_nothing(spark, empty):
    twice = spark.createDataFrame([(1, "a " * 30), (1, "a " * 30), (1, None), (None, "b c " * 20)], "doc_id long, text string")
    assert sorted(r["n_runs"] for r in periodic.digest(periodic.find_runs(twice)).collect()) == [0, 1, 1, 1]
    assert periodic.digest(periodic.find_runs(empty)).count() == 0
