import hashlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from sensorloom.llm import line_dedup, ngram_join, pairs, suffix_dedup, texts
from tests.llm import samples


@pytest.fixture(scope="module")
def docs(spark):
    return spark.createDataFrame(samples.documents(), samples.SCHEMA).repartition(3).persist()


@pytest.fixture(scope="module")
def empty(spark):
    return spark.createDataFrame([], samples.SCHEMA)


ROWS = [(r[0], r[1]) for r in samples.documents()]


@pytest.mark.parametrize("k, percent", [(4, 85), (5, 80), (2, 50)])
def test_components(docs, k, percent):
    got = {(r[0], r[1], r[2]) for r in ngram_join.components(docs, k, percent).collect()}
    assert got == set(samples.components(ROWS, k, percent))


def test_components_in_tiles(docs):
    got = {(r[0], r[1], r[2]) for r in ngram_join.components(docs, 2, 50, tile=4).collect()}
    assert got == set(samples.components(ROWS, 2, 50))


def test_components_of_repeated_and_null_ids(spark, empty):
    rows = [(1, "a b c d e"), (1, "a b c d e"), (None, "a b c d e"), (None, "z y x"), (2, None)]
    got = [tuple(r) for r in ngram_join.components(spark.createDataFrame(rows, "doc_id long, text string")).collect()]
    assert sorted(got, key=str) == sorted([(1, 2, 1), (1, 2, 1), (None, 2, 1), (None, 1, None), (2, 0, 2)], key=str)
    assert ngram_join.components(empty).count() == 0


def test_pairs_of_a_large_group_are_not_listed(spark, monkeypatch):
    plain, rows = [f"w{i}" for i in range(300)], []
    for i in range(120):
        words = list(plain)
        words[5 + 2 * i] = f"z{i}"
        rows.append((i, " ".join(words[: 298 + i % 3])))
    rows += [(200, " ".join(plain)), (300, " ".join(f"v{i}" for i in range(300)))]
    sizes, settle = [], ngram_join.settle

    def counted(df):
        out = settle(df)
        if "a" in out.columns:
            sizes.append(out.count())
        return out

    monkeypatch.setattr(ngram_join, "settle", counted)
    got = {(r[0], r[2]) for r in ngram_join.components(spark.createDataFrame(rows, "doc_id long, text string").repartition(3)).collect()}
    assert got == {(i, 0) for i in [*range(120), 200]} | {(300, 300)}
    assert max(sizes) < 10 * len(rows)


def test_tree_loses_no_pair():
    rng = np.random.default_rng(1)
    counts = rng.poisson(2, (300, ngram_join.GROUPS)).astype(np.uint8)
    counts[200:] = counts[:100]
    counts[200:, 0] += 1
    sizes = counts.sum(axis=1).astype(np.int64)
    counts[7:9, 3] = 255  # more than a byte can say: no bound
    q, p = ngram_join.CountTree(counts, sizes).join(counts, sizes, 85)
    low = np.minimum(counts[:, None], counts[None])
    bound = low.sum(axis=2, dtype=np.int64) + (1 << 24) * (low == 255).any(axis=2)
    want = (185 * bound >= 85 * (sizes[:, None] + sizes[None])) & (100 * np.minimum(sizes[:, None], sizes[None]) >= 85 * np.maximum(sizes[:, None], sizes[None]))
    assert set(zip(q.tolist(), p.tolist())) == set(zip(*(x.tolist() for x in np.nonzero(want))))


def test_linked_groups_of_a_chain(spark):
    edges = spark.createDataFrame([(i, i + 1) for i in range(40)] + [(100, 101)], "a long, b long")
    got = {r["node"]: r["group"] for r in pairs.linked_groups(edges).collect()}
    assert got == {i: 0 for i in range(41)} | {100: 100, 101: 100}


@pytest.mark.parametrize("order", ["shuffled", "smallest last"])
def test_linked_groups_of_long_chains(spark, order):
    n = 300
    ids = np.random.default_rng(5).permutation(n).tolist() if order == "shuffled" else [*range(1, n), 0]
    edges = spark.createDataFrame([*zip(ids, ids[1:]), (1000, 1001)], "a long, b long").coalesce(2)
    got = {r["node"]: r["group"] for r in pairs.linked_groups(edges).collect()}
    assert got == {i: 0 for i in range(n)} | {1000: 1000, 1001: 1000}


def test_linked_groups_of_random_graphs(spark):
    rng = np.random.default_rng(6)
    pairs_of = [tuple(x) for x in rng.integers(0, 400, (330, 2)).tolist()]
    group = {x: x for p in pairs_of for x in p if p[0] != p[1]}
    for _ in group:
        for a, b in pairs_of:
            if a != b:
                group[a] = group[b] = min(group[a], group[b])
    got = {r["node"]: r["group"] for r in pairs.linked_groups(spark.createDataFrame(pairs_of, "a long, b long")).collect()}
    assert got == group
    assert pairs.linked_groups(spark.createDataFrame([], "a long, b long")).count() == 0


def test_key_filter_keeps_all_keys(spark):
    keys = spark.range(1000).select(F.xxhash64("id").alias("k"))
    mine = np.array([r[0] for r in keys.collect()], np.int64)
    held = pairs.KeyFilter.of(keys, 1 << 14)
    assert held.has(mine).all()
    assert held.has(np.arange(1000)).mean() < 0.2


@pytest.mark.parametrize("k, percent", [(5, 80), (1, 60)])
def test_line_dedup(docs, k, percent):
    got = {r["doc_id"]: (r["text"], r["n_removed"]) for r in line_dedup.remove_lines(docs, k, percent).collect()}
    assert got == {i: (t, n) for i, t, n in samples.without_later_lines(ROWS, k, percent)}


def test_line_dedup_keeps_columns_and_repeated_rows(spark, empty):
    rows = [(5, "a b\nc d\n\na b", "u"), (5, "a b\nc d\n\na b", "v"), (None, "c d", "w"), (6, None, None)]
    frame = spark.createDataFrame(rows, "doc_id long, text string, _uid string").withColumn("n_lines", F.lit("old")).withColumn("_gone", F.lit(1))
    got = line_dedup.remove_lines(frame)
    assert got.columns == ["doc_id", "text", "_uid", "_gone", "n_lines", "n_removed"]
    seen = sorted((str(r["doc_id"]), r["text"], r["n_lines"], r["n_removed"]) for r in got.collect())
    assert seen == sorted([("5", "a b\nc d\n", 4, 1), ("5", "", 4, 3), ("None", "", 1, 1), ("6", "", 0, 0)])
    assert line_dedup.remove_lines(empty).count() == 0


def _lines_of_rare_words(n: int, copies: int) -> list[tuple[int, str]]:
    """Lines of 20 words that come once, and near copies, last word changed, of the first of them."""
    rng = np.random.default_rng(11)
    rows = [" ".join(f"w{x}" for x in rng.integers(0, 1 << 40, 20)) for _ in range(n)]
    return list(enumerate(rows + [r.rsplit(" ", 1)[0] + f" c{i}" for i, r in enumerate(rows[:copies])]))


def test_only_recurring_tokens_are_dealt(spark):
    rows = _lines_of_rare_words(300, 20)
    frame = spark.createDataFrame(rows, "_uid long, text string").repartition(3)
    counts, recurring = line_dedup.token_statistics(frame, 5, 1024)
    assert counts.sum() == 16 * len(rows)
    found = line_dedup.prefixes(frame, counts, recurring, 5, 80).collect()
    assert sorted((r["uid"], r["n"]) for r in found if r["place"] is None and r["token"] is None) == [(i, 1) for i, _ in rows]
    assert sorted(r["uid"] for r in found if r["place"] is not None) == [i for i, _ in rows]
    node_of = {r["uid"]: r["node"] for r in found if r["place"] is not None}
    tokens = [r for r in found if r["token"] is not None]
    # of 16 tokens the first 4 are looked at; one of a copy and its original comes once
    assert {r["node"] for r in tokens} == {node_of[i] for i in [*range(20), *range(300, 320)]}
    assert len(tokens) == 40 * 3
    assert {(r["n"], r["at"], r["left"]) for r in tokens} == {(16, 1, 3), (16, 2, 2), (16, 3, 1)}


@pytest.mark.parametrize("k, percent", [(5, 80), (1, 60)])
def test_line_dedup_with_a_full_filter(docs, k, percent, monkeypatch):
    """A filter with too few bits takes more tokens for recurring; the lines that go are the same."""
    plain = line_dedup.token_statistics
    monkeypatch.setattr(line_dedup, "token_statistics", lambda docs, k, ranges: plain(docs, k, ranges, most=8 * ranges))
    got = {r["doc_id"]: (r["text"], r["n_removed"]) for r in line_dedup.remove_lines(docs, k, percent).collect()}
    assert got == {i: (t, n) for i, t, n in samples.without_later_lines(ROWS, k, percent)}


@pytest.mark.parametrize("bits", [8, 256])
def test_line_dedup_with_full_line_filters(docs, bits, monkeypatch):
    """With few bits the filters of lines that go leave some documents, or all, in doubt; those are looked up."""
    monkeypatch.setattr(line_dedup, "filter_bits", lambda keys: bits * 16)
    got = {r["doc_id"]: (r["text"], r["n_removed"]) for r in line_dedup.remove_lines(docs, 5, 80).collect()}
    assert got == {i: (t, n) for i, t, n in samples.without_later_lines(ROWS, 5, 80)}


def test_line_dedup_shuffles_no_text(spark):
    """Only documents in doubt meet their places in a join; the others are told by filters."""
    rows = [(i, f"{t}\n\n{t}\nline {i} of its own") for i, t in _lines_of_rare_words(200, 20)]
    frame = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    gone, counted = line_dedup.later_matches(frame.select(F.col("doc_id").alias("_uid"), "text"), 5, 80)
    lost = {(r["uid"], r["place"]) for r in gone.collect()}
    assert {r["uid"]: r["n"] for r in counted.collect()} == {i: 4 for i, _ in rows}
    assert len(lost) == 220 + 20
    told = line_dedup.LostLines(line_dedup.lost_lines(gone, counted))
    found = told.places(np.arange(len(rows)), np.full(len(rows), 4))
    assert {(i, p) for i, x in enumerate(found) for p in x.tolist()} == lost


def test_line_dedup_of_edited_lines(spark):
    """Lines with 0 to 8 words of 24 changed, whose similarity is on both sides of the limit."""
    rng = np.random.default_rng(12)
    rows = []
    for i in range(60):
        line = [f"w{x}" for x in rng.integers(0, 400, 24)]
        for _ in range(4):
            other = list(line[: rng.integers(18, 25)])
            for at in rng.integers(0, len(other), rng.integers(0, 5)):
                other[at] = f"e{rng.integers(0, 50)}"
            rows.append((len(rows), " ".join(other)))
    frame = spark.createDataFrame(rows, "doc_id long, text string")
    for k, percent in ((1, 80), (2, 70), (5, 50)):
        got = {r["doc_id"]: (r["text"], r["n_removed"]) for r in line_dedup.remove_lines(frame, k, percent).collect()}
        assert got == {i: (t, n) for i, t, n in samples.without_later_lines(rows, k, percent)}
        assert 0 < sum(n for _, n in got.values()) < len(rows)


def test_marks_are_packed_without_loss():
    marks = np.sort(np.random.default_rng(13).integers(0, 1 << line_dedup.MARK, 1000).astype(np.uint64))
    marks[500] = marks[499]
    assert (line_dedup.unpack_marks(line_dedup.pack_marks(marks), len(marks)) == marks).all()
    held = line_dedup.RecurringTokens.of([b"\0", line_dedup.RecurringTokens.block(marks >> np.uint64(1) | np.uint64(1 << 39), 1 << 20).tobytes()])
    assert held.has((marks >> np.uint64(1) | np.uint64(1 << 39)) << np.uint64(64 - line_dedup.MARK)).all()
    assert not held.has(marks >> np.uint64(1) << np.uint64(64 - line_dedup.MARK))[marks >> np.uint64(1) < 1 << 39].any()


@pytest.mark.parametrize("length, seed_length", [(100, 36), (20, 8)])
def test_suffix_dedup(docs, length, seed_length):
    got = {r["doc_id"]: (r["n_bytes"], r["n_removed"], r["n_spans"], bytes(r["kept"])) for r in suffix_dedup.remove_repeats(docs, length, seed_length).collect()}
    assert got == {i: tuple(rest) for i, *rest in samples.without_repeats(ROWS, length)}


def test_suffix_dedup_over_segments(docs, monkeypatch):
    monkeypatch.setattr(suffix_dedup, "_SEGMENT", 57)
    monkeypatch.setattr(suffix_dedup, "slices", lambda batch, column: texts.slices(batch, column, 50))
    got = {r["doc_id"]: hashlib.md5(bytes(r["kept"])).hexdigest() for r in suffix_dedup.remove_repeats(docs, 20, 8).collect()}
    assert got == {i: hashlib.md5(k).hexdigest() for i, *_, k in samples.without_repeats(ROWS, 20)}


def test_suffix_dedup_of_repeated_rows(spark, empty):
    text = "".join(chr(97 + i % 26) + str(i) for i in range(80))
    frame = spark.createDataFrame([(3, text), (3, text), (None, text[:120]), (4, "")], "doc_id long, text string")
    got = sorted((str(r["doc_id"]), r["n_removed"]) for r in suffix_dedup.remove_repeats(frame).collect())
    assert got == sorted([("3", 0), ("3", len(text)), ("None", 120), ("4", 0)])
    assert suffix_dedup.remove_repeats(empty).count() == 0
