import hashlib
import os

import duckdb
import numpy as np
import pandas as pd
import public_tokenizers
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from sensorloom.llm import bpe, fingerprints, html, mixing, neighbours, queries, token_shards, toxicity
from tests.conftest import plan_of
from tests.llm import samples

PATH = public_tokenizers.path(queries.TOKENIZER)
ROWS = samples.documents()
ODD = [
    "", "aaa aaaa aaaaa", "a" * 5000, " \n\n x", "two  spaces   three ", "\tlead", "<|endoftext|> hi <|endoftext|>", "日本語テキスト" * 200, "\x00\x00 zero",
    "\x1c\x1d a\x85b c 　d", "😀" * 100, "'s't 're I'LL we'll", "à­x​ y", "1234 12 3.5e7", "a\r\nb\n c", "�", "x   y",
]


@pytest.fixture(scope="module")
def docs(spark):
    return spark.createDataFrame(ROWS, samples.SCHEMA).repartition(3).persist()


@pytest.fixture(scope="module")
def empty(spark):
    return spark.createDataFrame([], samples.SCHEMA)


# 2: BPE


def test_bpe_agrees_with_the_library():
    library, codec = Tokenizer.from_file(PATH), bpe.BpeCodec.from_file(PATH, cache_bytes=20_000)
    texts = ODD + [r[1] or "" for r in ROWS]
    for text, ids in zip(texts, codec.encode(texts)):
        assert ids == library.encode(text, add_special_tokens=False).ids
        assert codec.decode(ids) == library.decode(ids, skip_special_tokens=False) == text
    assert codec.decode([200, 201, 1000]) == library.decode([200, 201, 1000])


def test_bpe_frames(docs, empty):
    made = bpe.decode(bpe.encode(docs.withColumn("ids", F.lit("old")), PATH), PATH).select("text", "decoded", "ids").collect()
    assert all(r["decoded"] == (r["text"] or "") for r in made)
    digest = {r["doc_id"]: r for r in bpe.round_trip_digest(docs, PATH).collect()}
    library = Tokenizer.from_file(PATH)
    for i, text, *_ in ROWS:
        ids = library.encode(text or "", add_special_tokens=False).ids
        assert digest[i]["n_tokens"] == len(ids)
        assert digest[i]["ids_sha256"] == hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest()
        assert digest[i]["decoded_sha256"] == hashlib.sha256((text or "").encode()).hexdigest()
    assert bpe.round_trip_digest(empty, PATH).count() == 0


# 3: shards


@pytest.mark.parametrize("n", [1, 2, 3, 17, 1000])
def test_permutation(n):
    slots = token_shards.feistel(np.arange(n), n, 5)
    assert sorted(slots) == list(range(n))
    assert (token_shards.feistel(slots, n, 5, back=True) == np.arange(n)).all()


@pytest.mark.parametrize("vocabulary, length", [(None, 64), (PATH, 16)])
def test_shards_hold_every_token_once(spark, tmp_path, docs, vocabulary, length):
    docs.repartition(3).write.parquet(str(tmp_path / "docs"))
    source = spark.read.parquet(str(tmp_path / "docs"))
    folder = f"file://{tmp_path}/shards"
    manifest = token_shards.write_shards(source, folder, length=length, per_shard=32, vocabulary=vocabulary)
    rows = token_shards.read_shards(manifest, folder).toPandas()
    n, kind = len(rows), np.dtype("<u2" if vocabulary else "u1")
    assert sorted(rows["slot"]) == list(range(n))
    order = token_shards.feistel(rows["slot"].to_numpy(), n, 20, back=True)
    stream = np.frombuffer(b"".join(rows["ids"].iloc[np.argsort(order)]), kind)
    stream = stream[stream != np.iinfo(kind).max - 1]
    codec = bpe.BpeCodec.from_file(PATH)
    ends = np.flatnonzero(stream == np.iinfo(kind).max)
    parts = [stream[a:b] for a, b in zip([0, *(ends[:-1] + 1)], ends)]
    texts = [codec.decode(p.tolist()) if vocabulary else p.tobytes().decode() for p in parts]
    assert sorted(texts) == sorted(r[1] or "" for r in ROWS)
    assert sorted(token_shards.read_shards(manifest, folder, 5, 40).toPandas()["slot"]) == list(range(5, min(40, n)))
    stride = length * kind.itemsize
    for name in os.listdir(tmp_path / "shards"):
        if name.startswith("shard-"):
            first = int(name[6:14]) * 32
            assert os.path.getsize(tmp_path / "shards" / name) == min(32, n - first) * stride


def test_registered_shards_hold_token_ids(spark, sf, tmp_path, monkeypatch):
    folder = f"file://{tmp_path}/shards"
    monkeypatch.setattr(token_shards, "shard_folder", lambda df: folder)
    rows = queries.op3_token_shards(spark, sf).collect()
    slots = {}
    for name in os.listdir(tmp_path / "shards"):
        if name.endswith(".bin") and name.startswith("shard-"):
            ids = np.fromfile(tmp_path / "shards" / name, "<u2").reshape(-1, 2048)
            slots |= {int(name[6:14]) * 4096 + i: x for i, x in enumerate(ids)}
    assert {r["slot"]: (r["n_bytes"], r["ids_sha256"]) for r in rows} == {s: (4096, hashlib.sha256(x.tobytes()).hexdigest()) for s, x in slots.items()}
    order = np.argsort(token_shards.feistel(np.arange(len(rows)), len(rows), 20, back=True))
    stream = np.concatenate([slots[s] for s in order])
    stream = stream[stream != 0xFFFE]
    ends = np.flatnonzero(stream == 0xFFFF)
    got = [stream[a:b].tolist() for a, b in zip([0, *(ends[:-1] + 1)], ends)]
    library = Tokenizer.from_file(PATH)
    texts = [r["text"] or "" for r in spark.read.parquet(f"{sf}/documents.parquet").select("text").collect()]
    assert sorted(got) == sorted(library.encode(t, add_special_tokens=False).ids for t in texts)


def test_packed_ids_are_the_ids():
    codec = bpe.BpeCodec.from_file(PATH, cache_bytes=20_000)
    texts = [*ODD, None, *(r[1] for r in ROWS)]
    packed = list(codec.encode_packed(texts, np.dtype("<u2"), 1000))
    assert [np.frombuffer(x, "<u2").tolist() for x in packed] == list(codec.encode(texts))
    with pytest.raises(ValueError):
        next(codec.encode_packed(texts, np.dtype("u1")))


def test_shards_of_an_empty_table(spark, tmp_path, empty):
    empty.write.parquet(str(tmp_path / "docs"))
    folder = f"file://{tmp_path}/shards"
    manifest = token_shards.write_shards(spark.read.parquet(str(tmp_path / "docs")), folder)
    assert token_shards.read_shards(manifest, folder).count() == 0


# 4: mixing


def _sql(sql, rows):
    con = duckdb.connect()
    con.register("documents", pd.DataFrame(rows, columns=["doc_id", "text", "lang", "source", "n_chars"]))
    return sorted(map(str, con.sql(sql).fetchall()))


def test_mix_against_sql(docs):
    got = mixing.mix(docs, queries.SOURCE_WEIGHTS).collect()
    assert sorted(str(tuple(r)) for r in got) == _sql(queries.OP4_SQL, ROWS)


def test_mix_meets_targets(docs):
    rows = mixing.mix(docs, queries.SOURCE_WEIGHTS).join(docs.select("doc_id", "source"), "doc_id").toPandas()
    assert (rows["taken"] <= 2 * rows["size"]).all()
    by = rows.groupby("source", dropna=False).agg(taken=("taken", "sum"), target=("target", "first"), own=("source_size", "first"))
    assert (by["target"] - by["taken"]).between(0, 1.0001).all()
    assert (by["target"] <= 2 * by["own"]).all()
    assert abs(by["target"].sum() - 1.5 * rows["size"].sum()) < 1e-6 * rows["size"].sum()


def test_mix_of_hot_null_and_empty_sources(spark, empty):
    rows = [(i, "w " * (i % 5 + 1), "big") for i in range(200)] + [(300, "x y", None), (301, None, None), (302, "", "none"), (303, "z", "small"), (303, "z", "small")]
    frame = spark.createDataFrame(rows, "doc_id long, text string, source string").withColumn("size", F.lit("clash"))
    got = mixing.mix(frame, [5, 2, 1]).toPandas()
    assert len(got) == len(rows) and (got["taken"] <= 2 * got["size"]).all()
    assert (got.loc[got["doc_id"] == 302, "target"] == 0).all()
    again = mixing.mix(frame.repartition(7), [5, 2, 1]).toPandas()
    assert sorted(map(str, got.itertuples(index=False))) == sorted(map(str, again.itertuples(index=False)))
    assert mixing.mix(empty, [1]).count() == 0


# 6: fingerprints




def test_edited_text_and_next(docs):
    got = {r["doc_id"]: r for r in fingerprints.edited_likeness(docs).collect()}
    texts = [(i, t or "") for i, t, *_ in sorted(ROWS)]
    for (i, text), (j, after) in zip(texts, texts[1:] + texts[:1]):
        cut = len(text) // 4
        edited = text[: len(text) - cut] + after[:cut]
        assert got[i]["n_chars"] == len(text)
        assert got[i]["edited_sha256"] == hashlib.sha256(edited.encode()).hexdigest()
        assert (got[i]["near_edited"] == 1.0) or edited != text
        if text == after:
            assert got[i]["near_next"] == 1.0
        alike = [x == y for x, y in zip(got[i]["fingerprint"].split("-"), got[j]["fingerprint"].split("-"))]
        assert abs(got[i]["near_next"] - sum(alike) / len(alike)) < 1e-12
    by_text = {}
    for i, text in texts:
        by_text.setdefault(text, set()).add(got[i]["fingerprint"])
    assert all(len(f) == 1 for f in by_text.values())


def test_sketches_against_a_loop(spark):
    texts = ["a b a b a b c d", "a a a a a", "", "one two three four five six seven eight nine ten " * 9]
    frame = spark.createDataFrame([(t,) for t in texts], "text string")
    n, picked, kept, place = 4, 2, 64, 24
    got = [r[0] for r in frame.select(fingerprints.sketches(F.col("text"), 2, n, picked, kept)).collect()]
    hashes = lambda *x: spark.range(1).select(F.xxhash64(*x)).first()[0]
    top = lambda h: (h & (1 << 64) - 1) >> place
    for text, sketch in zip(texts, got):
        words = [hashes(F.lit(w)) for w in samples.re.split(r"[\x20\x09-\x0D]+", text)]
        seen, items = {}, []
        for i in range(len(words)):
            kmer = top(hashes(*(F.lit(w) if w is not None else F.lit(None).cast("long") for w in (words + [None])[i : i + 2])))
            occurrence = seen[kmer] = seen.get(kmer, -1) + 1
            digest = hashes(F.lit(kmer).cast("long"), F.lit(occurrence))
            items.append((digest >> place, top(digest), i))
        items = sorted(items, key=lambda x: (x[0], x[2]))[:kept]
        for j in range(n):
            own = sorted([(i, t) for _, t, i in items if t % n == j][:picked])
            want = F.array(*(F.lit(t).cast("long") for _, t in own)) if own else F.array().cast("array<long>")
            assert sketch[j] == hashes(want)


@pytest.mark.parametrize("words", [1, 3, 10, 20, 40])
def test_unrelated_short_texts_have_nothing_alike(spark, words):
    rows = [(i, " ".join(f"w{i}x{j}" for j in range(words))) for i in range(30)]
    got = fingerprints.edited_likeness(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert [r["near_next"] for r in got] == [0.0] * 30


def test_order_sketches_pick_from_the_whole_text(spark):
    texts = ["a b c a b c a b", "x", "one two three four five six seven", "seven six five four three two one"]
    frame = spark.createDataFrame([(t,) for t in texts], "text string").coalesce(1)
    got = [r[0] for r in frame.select(fingerprints.order_sketches(F.col("text"), 1, 8, 2)).collect()]
    words = [(w, t.split(" ")[:i].count(w)) for t in texts for i, w in enumerate(t.split(" "))]
    kmer = F.shiftrightunsigned(F.xxhash64(F.xxhash64("w")), 24)
    item = F.shiftrightunsigned(F.xxhash64(kmer, F.col("o")), 24)
    values = [F.xxhash64(item.bitwiseXOR(F.xxhash64(F.lit(j)))).alias(f"v{j}") for j in range(8)]
    hashed = iter(spark.createDataFrame(words, "w string, o int").coalesce(1).select(values).collect())
    tuples = []
    for text in texts:
        rows = [next(hashed) for _ in text.split(" ")]
        tuples += [([v for v in own if v in sorted(own)[:2]],) for own in zip(*rows)]
    want = [r[0] for r in spark.createDataFrame(tuples, "v array<long>").coalesce(1).select(F.xxhash64("v")).collect()]
    assert sum(got, []) == want
    assert got[2] != got[3]


def test_next_over_many_runs(spark):
    frame = spark.range(0, 5000, 7).withColumn("text", F.col("id").cast("string"))
    got = fingerprints.with_next(frame, "id", ["text"], rows_per_run=10).orderBy("id").toPandas()
    assert got["next_text"].tolist() == got["text"].tolist()[1:] + got["text"].tolist()[:1]


def test_fingerprints_of_few_rows(spark, empty):
    one = spark.createDataFrame([(None, None)], "doc_id long, text string")
    row = fingerprints.edited_likeness(one).first()
    assert (row["n_chars"], row["near_edited"], row["near_next"]) == (0, 1.0, 1.0)
    same = spark.createDataFrame([(1, "a b c"), (1, "a b c"), (2, "x")], "doc_id long, text string").withColumn("sketches", F.lit(1))
    assert fingerprints.edited_likeness(same).count() == 3
    assert fingerprints.edited_likeness(empty).count() == 0


# 7: HTML

PAGE = """<!DOCTYPE html><html><head><title>T</title><style>p{}</style></head><body><header class="top"><a href=/>Home</a> The site of many words that look like a text</header>
<nav><ul><li><a href=1>One</a><li><a href=2>Two words</a></ul></nav><div class="ad banner">Buy this now and be happy with it for ever and ever and more</div>
<article><header><h1>The &amp; title</h1></header><p>First&nbsp;paragraph  with <b>bold</b> and <a href=x>link</a>.<p>Sec&#111;nd.<br>Line<script>var a = "<p>no</p>";</script>
<aside>Related things to read when you are done with this one here today</aside><form><label>Mail</label><input><button>Go</button></form></article>
<section id="comments"><p>This is a reader's comment which is long enough to look like a paragraph of the text itself.</p></section><footer>&copy; 2020 all rights</footer></body></html>"""


def test_page_parts():
    tree = html.grow_tree(html.LABELLED)
    assert html.main_text(PAGE, tree) == "The & title\nFirst paragraph with bold and link.\nSecond. Line"
    data = np.array(html.LABELLED, float)
    assert (tree.predict(data[:, :-1]) == data[:, -1]).all()


@pytest.mark.parametrize("page", [None, "", "<", "<p", "<!-- open", "<script>x", "</p></div>", "<a><b></a></b>", "<article>", "&", "<p title='>'>x", "<svg/><p/>", "\x00"])
def test_broken_pages_do_not_fail(page):
    assert isinstance(html.main_text(page, html.grow_tree(html.LABELLED)), str)


@pytest.mark.parametrize(
    "around",
    [("<div class='site has-sidebar'><article>", "</article></div>"), ("<main class='with-sidebar'>", "</main>"), ("<article class='comments open'>", "</article>"),
     ("<div class='has-sidebar'><main><article class='comments open'>", "</article></main></div>")],
)
def test_hints_on_wrappers_lose_no_article(around):
    page = f"<body><div class='ad'>Buy this now</div>{around[0]}<p>The text of the page.</p><div id='comments'><article class='comment'>A reply</article></div>{around[1]}<div class='ad'>Buy more</div>"
    tree = html.grow_tree(html.LABELLED)
    assert html.main_text(page, tree) == "The text of the page."
    assert html.main_text(page.replace("<body>", "<body><div style='display:none'>"), tree) == ""


LONG = " ".join(["word"] * 40)


@pytest.mark.parametrize(
    ("page", "want"),
    [
        (f"<article><h1>Title</h1><p>{LONG}</p><p>A short closing paragraph.</p></article><nav><a>One</a></nav>", ["Title", LONG, "A short closing paragraph."]),
        (f"<article><h2>Links</h2><p><a>See the list here</a></p><p>{LONG}</p></article>", ["Links", "See the list here", LONG]),
        ("<article><h1>News</h1><p><a>See the list here</a></p></article>", ["News", "See the list here"]),
        ("<body><p>Only a short paragraph.</p></body>", ["Only a short paragraph."]),
        # without an article the neighbours decide
        (f"<body><nav><a>Home</a></nav><h1>Title</h1><p>{LONG}</p><p>A short end.</p><ul><li><a>One link</a></li><li><a>Two links</a></li></ul><footer>c</footer>", ["Title", LONG, "A short end."]),
        (f"<body><div><a>Home</a> <a>About</a></div><div>{LONG}</div><div>Short middle.</div><div>{LONG}</div><div><a>Prev</a> <a>Next</a></div><div>Copyright 2020</div>", [LONG, "Short middle.", LONG]),
        (f"<body><ul><li><a>Home</a></li><li>Menu of pages</li><li><a>Pages</a></li></ul><p>{LONG}</p>", [LONG]),
        (f"<body><p>{LONG} {LONG} {LONG}</p><p>So it was.</p><p>{LONG}</p>", [f"{LONG} {LONG} {LONG}", "So it was.", LONG]),
        (f"<body><p>{LONG}</p><h2>Next part</h2><p>{LONG}</p>", [LONG, "Next part", LONG]),
    ],
)
def test_text_is_not_lost_to_its_neighbours(page, want):
    assert html.main_text(page, html.grow_tree(html.LABELLED)).split("\n") == want


def test_blocks_of_an_article_always_stay():
    tree, rng = html.grow_tree(html.LABELLED), np.random.default_rng(3)
    n = 5000
    some = lambda top: rng.integers(0, top, n) * rng.integers(0, 2, n)
    share = lambda: rng.choice([0.0, 0.2, 0.5, 0.9, 1.0], n)
    x = np.column_stack([1 + some(300), share(), some(300), share(), some(300), share(), np.ones(n), rng.integers(0, 2, n)])
    assert tree.predict(x).all()
    x[:, 6] = -1
    assert not tree.predict(x).any()


def test_extract_pages(spark, sf):
    pages = spark.read.parquet(f"{sf}/pages.parquet").withColumn("text", F.lit("old"))
    for row in html.extract(pages).collect():
        article = row["html"].split("<article>")[1].split("</article>")[0]
        parts = samples.re.split(r"</?(?:p|h1)>", article)
        parts = [" ".join(html.entities.unescape(samples.re.sub(r"<[^>]+>", " ", p)).split()) for p in parts]
        assert row["text"] == "\n".join(p for p in parts if p)
    assert html.extract(pages.limit(0)).count() == 0
    odd = spark.createDataFrame([(1, None, None), (1, "u", "<article><p>" + "word " * 50_000 + "</article>")], "page_id long, url string, html string")
    assert sorted(len(r["text"]) for r in html.extract(odd).collect()) == [0, 249_999]


# 9: toxicity


def test_grammar_composes():
    reader = toxicity.Reader({"idiot": 1.0, "scum": 1.0}, ["scumble"])
    said = lambda text: [p for p, _ in reader.clauses(text)]
    assert said("what an idiot") == ["insult"]
    assert said("you are such an Idiots!") == ["aimed"]
    assert said("he is not an idiot") == ["negated"]
    assert said("she said he is an idiot") == ["reported"]
    assert said("I will kill you") == ["threat"]
    assert said("kill the lights. an idiot; not so") == ["insult"]
    assert said("antiscum and midiot, scumble") == [] == said(None) == said("")
    assert len(said("scum. " * 3)) == 3


def test_scores_on_held_out_rows(spark):
    sf = "/root/testdata/sf0.1"
    docs, labels = spark.read.parquet(f"{sf}/documents.parquet"), spark.read.parquet(f"{sf}/labels.parquet")
    model = toxicity.fit(docs, toxicity.training_labels(labels))
    held = toxicity.score(docs.select("doc_id", "text"), model).join(labels.where(toxicity.held_out(F.col("doc_id"))), "doc_id").toPandas()
    hit = held["score"] >= 0.3
    assert held.loc[hit, "toxic"].mean() > 0.95
    assert hit[held["toxic"] == 1].mean() > 0.8


def test_toxicity_of_odd_rows(spark, empty):
    labels = spark.createDataFrame([(0, None), (7, 1), (7, 0)], "doc_id long, label int")
    model = toxicity.fit(empty, labels)
    rows = spark.createDataFrame([(1, None), (1, ""), (None, "you idiot"), (2, "idiot " * 100_000)], "doc_id long, text string").withColumn("score", F.lit("x"))
    got = sorted((str(r["text"])[:9], r["score"]) for r in toxicity.score(rows, model).collect())
    assert all(0 <= s <= 1 for _, s in got)
    assert got[0][1] == got[1][1] < 0.3 < got[-1][1]
    assert toxicity.score(empty, model).count() == 0


# 10: neighbours


def _truth(ids, x, k):
    unit = x / np.linalg.norm(x, axis=1, keepdims=True)
    out = {}
    for i in np.flatnonzero(ids % 50 == 0):
        score = unit @ unit[i]
        order = sorted((j for j in range(len(ids)) if j != i), key=lambda j: (-round(score[j], 12), ids[j]))
        out[int(ids[i])] = [int(ids[j]) for j in order[:k]]
    return out


def test_recall_against_brute_force(spark):
    frame = spark.read.parquet("/root/testdata/sf0.1/embeddings.parquet")
    got = neighbours.search(frame, frame.where("vec_id % 50 = 0"), run_rows=100).toPandas()
    local = frame.toPandas()
    truth = _truth(local["vec_id"].to_numpy(), np.stack(local["embedding"]).astype(float), 5)
    found = got.sort_values("rank").groupby("query_id")["vec_id"].apply(list).to_dict()
    assert set(found) == set(truth)
    assert np.mean([len(set(found[q]) & set(truth[q])) / 5 for q in truth]) >= 0.9


def test_copies_ties_and_bad_vectors(spark):
    rows = [(i, [1.0, 0.0, 0.0]) for i in range(0, 120)] + [(200 + i, [1.0, float(i), 2.0]) for i in range(30)]
    rows += [(500, None), (550, [0.0, 0.0, 0.0]), (600, [float("nan"), 1.0, 1.0]), (650, [1.0, None, 1.0]), (700, [1.0, 2.0]), (None, [1.0, 1.0, 1.0]), (750, [])]
    frame = spark.createDataFrame(rows, "vec_id long, embedding array<float>").withColumn("id", F.lit(1)).withColumn("score", F.lit(2))
    got = neighbours.search(frame, frame.where("vec_id % 50 = 0"), run_rows=8, recall=1.0).toPandas()
    found = got.sort_values("rank").groupby("query_id")["vec_id"].apply(list).to_dict()
    assert found[0] == [1, 2, 3, 4, 5] and found[50] == [0, 1, 2, 3, 4] and found[100] == [0, 1, 2, 3, 4]
    assert set(found) == {0, 50, 100, 200}
    assert neighbours.search(frame.limit(0), frame.limit(0)).count() == 0
    few = frame.where("vec_id in (0, 1, 200)")
    assert neighbours.search(few, few.where("vec_id = 0")).count() == 2


def test_hilbert_curve_visits_neighbours():
    cells = np.stack(np.meshgrid(*[np.arange(16)] * 2, indexing="ij"), axis=-1).reshape(-1, 2)
    keys = neighbours.hilbert_keys(cells)
    path = cells[np.argsort(keys)]
    assert len(np.unique(keys)) == 256 and (np.abs(np.diff(path, axis=0)).sum(axis=1) == 1).all()


def test_bpe_cache_is_bounded_by_bytes():
    """Texts without spaces are one chunk each; none of them stays, and short chunks go when they weigh too much."""
    library, codec = Tokenizer.from_file(PATH), bpe.BpeCodec.from_file(PATH, cache_bytes=200_000)
    rng = np.random.default_rng(1)
    words = ["".join(map(chr, rng.integers(97, 123, 6))) for _ in range(4000)]
    texts = ["x1y2" * 20_000, "日本語" * 5_000, "a\0" * 8_000] + [" ".join(words[i : i + 200]) for i in range(0, 4000, 200)]
    for ids, text in zip(codec.encode(texts, group_chars=20_000), texts):
        assert ids == library.encode(text, add_special_tokens=False).ids
    assert max(map(len, codec._cache), default=0) <= 256
    assert 0 <= codec._held == sum(bpe._weight(c, ids) for c, ids in codec._cache.items()) <= 200_000
    kind = np.dtype(np.uint16)
    for data, text in zip(codec.encode_packed(texts, kind, group_chars=20_000), texts):
        assert np.frombuffer(data, kind).tolist() == library.encode(text, add_special_tokens=False).ids
    assert max(map(len, codec._packed), default=0) <= 256


def test_a_long_text_without_spaces_goes_through(spark):
    text = "0123456789abcdefghijklmnopqrstuvwxyz" * 140_000  # 5 MB
    row = bpe.round_trip_digest(spark.createDataFrame([(1, text), (2, "a")], "doc_id long, text string"), PATH).where("doc_id = 1").first()
    assert row["decoded_sha256"] == hashlib.sha256(text.encode()).hexdigest()


def test_both_sketches_are_those_of_each_text(spark):
    begins = ["", " ", "a", "a b", "a b c d", " a  b\nc d e ", "x x x x x x x x", "one two three four five si"]
    rows = [(b, b + t, b + e) for b in begins for t in ("", " ", "x", " x x x x", "ly a b c d") for e in ("", "y z", " a b c d a b c d")]
    df = spark.createDataFrame(rows, "begin string, text string, edited string")
    both = fingerprints.both_sketches(F.col("text"), F.col("edited"), F.col("begin"))
    each = F.concat(fingerprints.order_sketches(F.col("text")), fingerprints.order_sketches(F.col("edited")))
    assert df.select(both.alias("both"), each.alias("each")).where("both <> each").count() == 0


def test_rows_are_dealt_before_they_are_fingerprinted(spark):
    docs = spark.createDataFrame([(i, f"a b {i} c") for i in range(5)], "doc_id long, text string").repartition(2)
    plan = plan_of(fingerprints.edited_likeness(docs))
    above, below = plan.split("Exchange hashpartitioning(_run", 1)
    assert "array_min" in above and "array_min" not in below


def test_packed_ids_at_every_kind_of_boundary():
    """Chunks are cut by the kinds of bytes: the ids must be the library's, and a word met before is not merged again, whatever follows it."""
    library, codec = Tokenizer.from_file(PATH), bpe.BpeCodec.from_file(PATH)
    parts = ["a", "B", " ", "  ", "\n", "\t", "'", "s", "ll", "1", "9", ".", "!", "é", "　", "\x85", "\xa0", "日", "\0", "_", "\x1c", "x" * 17, "<|endoftext|>"]
    rng = np.random.default_rng(3)
    texts = ["", *("".join(rng.choice(parts, rng.integers(0, 12))) for _ in range(3000))]
    kind = np.dtype("<u2")
    for data, text in zip(codec.encode_packed(texts, kind, 5000), texts, strict=True):
        assert np.frombuffer(data, kind).tolist() == library.encode(text, add_special_tokens=False).ids
    list(codec.encode_packed([" known words,\n"], kind))
    codec.merge_words = lambda words: pytest.fail(f"merged again: {words}")
    assert len(list(codec.encode_packed([" words, known words\n", " known,\n"], kind))) == 2


def test_shards_shuffle_a_row_per_batch_and_shard(spark, tmp_path, docs):
    """Sequences are shuffled compressed, those of a batch and shard together, and come back whole."""
    docs.repartition(3).write.parquet(str(tmp_path / "docs"))
    docs = spark.read.parquet(str(tmp_path / "docs"))
    manifest = token_shards.write_shards(docs, f"file://{tmp_path}/few", length=16, per_shard=8)
    one = token_shards.write_shards(docs, f"file://{tmp_path}/one", length=16, per_shard=1 << 12)
    rows = [[bytes(r["ids"]) for r in token_shards.read_shards(m, f"file://{tmp_path}/{d}").orderBy("slot").collect()] for m, d in ((manifest, "few"), (one, "one"))]
    assert rows[0] == rows[1] and len(rows[0]) > 8


@pytest.mark.parametrize("words, picked", [(0, 2), (1, 2), (7, 2), (16, 2), (17, 2), (400, 1), (400, 3)])
def test_smallest_values_whatever_the_bound(spark, words, picked):
    """Only values up to the bound are looked at; where they are too few, all are."""
    hashes = F.transform(F.sequence(F.lit(0), F.lit(words)), lambda x: F.xxhash64(x % 300))
    seed, low, high = F.xxhash64(F.lit(7)), F.lit(-(1 << 63)), F.lit((1 << 63) - 1)
    bounds = [low, F.lit(-(1 << 62)), high, fingerprints._bound(hashes, picked)]
    got = [fingerprints._smallest(fingerprints._few(hashes, seed, b), hashes, seed, picked) for b in bounds]
    want = fingerprints._least(fingerprints._seeded(hashes, seed), picked)
    row = spark.range(1).select(want.alias("want"), F.array(*got).alias("got"), F.size(F.filter(hashes, lambda x: F.xxhash64(x.bitwiseXOR(seed)) <= bounds[3])).alias("tried")).first()
    assert row["got"] == [row["want"]] * 4
    assert row["tried"] == words + 1 if words < 16 else row["tried"] < 40 * picked
