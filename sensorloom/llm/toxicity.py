"""Toxicity of documents by a weighted finite-state pattern grammar.

Four small transducers read the token classes of a clause and rewrite them one after another: ``negation`` marks an insult
in the scope of a negator, ``target`` marks one aimed at a person, ``threat`` turns will-verb + harm-verb + person into a
threat, ``reported`` marks all of these in a clause that quotes somebody. They are composed into one machine by the product of
their states, so a clause is read once. A matched clause carries the weight of its pattern and of the word that
matched, and the score of a document is the logistic of its clause evidence.

What is learned, from labelled rows only: the stems of the insult class beyond the fixed seed words (a stem is
the beginning of a word; chosen by greedy cover of the toxic rows), words with such a stem that are usual in clean rows and
are spared, and the weights of the patterns
(logistic regression). Both are fitted on at most about ``max_rows`` labelled rows, chosen by a hash of the
key; scores then cover every row and whole texts.

Defined results: null and empty texts have no clause and get the score of the intercept; null labels are no labels; a key with
several labels counts as toxic if any of them is 1.
"""

from __future__ import annotations

import math
from collections import Counter
from dataclasses import dataclass, field

import ahocorasick
import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import discard, settle

#: Word classes of the grammar.
INSULTS = ["idiot", "moron", "stupid", "loser", "scum", "trash", "clown", "pathetic", "worthless", "disgusting"]
HARM = ["kill", "hurt", "beat", "destroy", "shoot", "stab", "burn"]
WILL = ["will", "gonna", "shall", "going"]
PERSONS = ["you", "your", "he", "she", "they", "him", "her", "them", "du", "dich", "tu", "toi", "vous", "te", "usted"]
NEGATORS = ["not", "no", "never", "isn't", "aren't", "wasn't", "don't", "nicht", "kein", "keine", "pas", "jamais", "nunca"]
REPORTERS = ["said", "says", "called", "wrote", "quoted", "claimed", "sagte", "dit", "dijo"]

#: Classes that a token may have, and what a clause may hold after the transducers.
INSULT, HARMS, WILLS, PERSON, NEGATOR, REPORTER, OTHER = "insult", "harm", "will", "person", "negator", "reporter", "other"
PATTERNS = ["insult", "aimed", "negated", "threat", "reported"]

_TOKEN = regex.compile(r"[\p{L}\p{N}]+(?:'[\p{L}]+)?")
_CLAUSE_END = regex.compile(r"[.!?;\n]")


@dataclass
class Transducer:
    """Deterministic machine: ``arcs[state][symbol] = (next state, output)``; a symbol without an arc passes
    unchanged and leads to ``fall[state]``, or leaves the state as it is."""

    start: int
    arcs: dict[int, dict[str, tuple[int, str]]] = field(default_factory=dict)
    fall: dict[int, int] = field(default_factory=dict)

    def step(self, state: int, symbol: str) -> tuple[int, str]:
        found = self.arcs.get(state, {}).get(symbol)
        return found if found else (self.fall.get(state, state), symbol)


def scope(opener: str, rewrites: dict[str, str], width: int) -> Transducer:
    """``opener`` opens a scope of ``width`` tokens in which symbols are rewritten."""
    t = Transducer(0, {0: {opener: (width, opener)}})
    for left in range(width, 0, -1):
        t.arcs[left] = {opener: (width, opener)} | {a: (left - 1, b) for a, b in rewrites.items()}
        t.fall[left] = left - 1
    return t


def threat(width: int = 3) -> Transducer:
    """will + harm + person within a few tokens: the person's token becomes a threat."""
    t = Transducer(0, {0: {WILLS: (width, OTHER)}})
    for left in range(width, 0, -1):
        t.arcs[left] = {HARMS: (width + left, OTHER), WILLS: (width, OTHER)}
        t.fall[left] = left - 1
        t.arcs[width + left] = {PERSON: (0, "threat")}
        t.fall[width + left] = width + left - 1 if left > 1 else 0
    return t


def reported() -> Transducer:
    """After a reporting word, everything matched in the clause is quoted."""
    quoted = {p: (1, "reported") for p in (INSULT, "aimed", "negated", "threat")}
    return Transducer(0, {0: {REPORTER: (1, OTHER)}, 1: quoted})


def compose(machines: list[Transducer]) -> Transducer:
    """One machine that feeds the output of each transducer to the next; its states are the reachable tuples of theirs."""
    symbols = [INSULT, HARMS, WILLS, PERSON, NEGATOR, REPORTER, OTHER]
    start = tuple(m.start for m in machines)
    number, queue, out = {start: 0}, [start], Transducer(0)
    while queue:
        states = queue.pop()
        arcs = {}
        for symbol in symbols:
            after, passed = [], symbol
            for m, s in zip(machines, states):
                s, passed = m.step(s, passed)
                after.append(s)
            after = tuple(after)
            if after not in number:
                number[after] = len(number)
                queue.append(after)
            arcs[symbol] = (number[after], passed)
        out.arcs[number[states]] = arcs
    return out


def grammar() -> Transducer:
    negation = scope(NEGATOR, {INSULT: "negated"}, 3)
    aimed = scope(PERSON, {INSULT: "aimed"}, 4)
    return compose([negation, aimed, threat(), reported()])


class Reader:
    """Finds clauses that can match and runs the composed machine over them. Picklable."""

    def __init__(self, stems: dict[str, float], spared: list[str] | tuple[str, ...] = ()):
        self.stems, self.spared = dict(stems), frozenset(spared)

    def __getstate__(self):
        return {"stems": self.stems, "spared": self.spared}

    def _ready(self) -> None:
        if "_machine" in self.__dict__:
            return
        self._machine = grammar()
        self._class = {
            w: c
            for c, ws in ((HARMS, HARM), (WILLS, WILL), (PERSON, PERSONS), (NEGATOR, NEGATORS), (REPORTER, REPORTERS))
            for w in ws
        }
        finder = ahocorasick.Automaton()
        for s in {*self.stems, *HARM}:
            finder.add_word(s, len(s))
        finder.make_automaton()
        self._finder = finder
        self._longest = max(map(len, self.stems), default=0)

    def _token(self, word: str) -> tuple[str, float]:
        if word in self.spared:
            return self._class.get(word, OTHER), 1.0
        best = max((self.stems[word[:n]] for n in range(1, min(len(word), self._longest) + 1) if word[:n] in self.stems), default=None)
        return (INSULT, best) if best is not None else (self._class.get(word, OTHER), 1.0)

    def clauses(self, text: str | None) -> list[tuple[str, float]]:
        """(pattern, word weight) of every match, clause by clause, over the whole text."""
        self._ready()
        low = (text or "").lower()
        found, done = [], 0
        for end, length in self._finder.iter(low):
            begin = end - length + 1
            if begin < done or (begin and (low[begin - 1].isalnum())):
                continue
            left = max(map(low.rfind, ".!?;\n", [0] * 5, [begin] * 5)) + 1
            stop = _CLAUSE_END.search(low, end)
            done = stop.start() if stop else len(low)
            state = 0
            for m in _TOKEN.finditer(low, max(left, 0), done):
                kind, weight = self._token(m[0])
                state, said = self._machine.arcs[state][kind]
                if said in PATTERNS:
                    found.append((said, weight))
        return found

    def features(self, text: str | None) -> list[float]:
        """Per pattern the largest word weight, and at last the saturated number of matched clauses."""
        top = Counter()
        matches = self.clauses(text)
        for pattern, weight in matches:
            top[pattern] = max(top[pattern], weight)
        return [*(float(top[p]) for p in PATTERNS), math.log1p(min(len(matches), 20))]


def labelled_sample(docs: DataFrame, labels: DataFrame, max_rows: int, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Rows of ``docs`` with a training label (``key``, ``label``): about ``max_rows`` of them, by a hash of the key."""
    known = labels.where(F.col("label").isNotNull()).groupBy(key).agg(F.max("label").alias("label"))
    share = max_rows / max(1, known.count())
    if share < 1:
        known = known.where(F.pmod(F.xxhash64(F.col(key), F.lit("sample")), F.lit(1 << 30)) < int(share * (1 << 30)))
    # bounded by max_rows, so the texts need no shuffle
    return docs.select(F.col(key), F.col(text).alias("text")).join(F.broadcast(known), key)


def learn_stems(
    sample: DataFrame, lengths: tuple[int, ...] = (3, 4, 5, 6, 7, 8), max_candidates: int = 600, max_stems: int = 100
) -> tuple[list[str], list[str]]:
    """Insult stems, and the words that begin with one but are usual in clean rows.

    A stem is the beginning of words that toxic rows have and clean rows hardly; words usual in clean rows do not count. A candidate
    must be improbable to fall on toxic rows by chance, at least five of six rows with it must be toxic, and greedy cover of the toxic
    rows chooses among the candidates, the longest of equal ones. The driver gets ``max_candidates`` candidates with the toxic
    rows of the bounded sample that hold them.
    """
    # rows with a seed word need no further one
    seed = F.lower("text").rlike(rf"(?<![\p{{L}}\p{{N}}])({'|'.join(INSULTS)})")
    rows = sample.where(~seed).select(F.xxhash64("text").alias("row"), "label", "text").dropDuplicates(["row"])
    totals = rows.agg(F.count("*"), F.sum("label")).first()
    n, toxic = totals[0], totals[1] or 0
    if not toxic or toxic == n:
        return [], []
    found = F.array_distinct(F.regexp_extract_all(F.lower("text"), F.lit(r"[\p{L}\p{N}]+"), F.lit(0)))
    words = settle(rows.select("row", "label", F.explode(found).alias("word")).where(F.length("word") >= min(lengths)))
    seen = words.groupBy("word").agg(F.sum("label").alias("t"), F.sum(1 - F.col("label")).alias("c"))
    usual = settle(seen.where((F.col("c") >= 2) & ((F.col("t") + 0.5) / toxic < 3 * (F.col("c") + 0.5) / (n - toxic))).select("word"))
    odd = words.join(usual, "word", "left_anti").groupBy("row", "label").agg(F.collect_list("word").alias("words"))
    beginnings = F.flatten(F.transform("words", lambda w: F.array(*[F.substring(w, 1, k) for k in lengths])))
    # each stem once per row; counts are summed on the map side, so rows and stems are never shuffled as pairs
    stems = odd.select("row", "label", F.explode(F.array_distinct(beginnings)).alias("stem")).where(F.length("stem") >= min(lengths))
    counts = stems.groupBy("stem").agg(F.count("*").alias("rows"), F.sum("label").alias("toxic")).where("toxic >= 3")
    base = toxic / n
    clean = F.col("rows") - F.col("toxic")
    strong = counts.where((F.col("toxic") >= 5 * clean) & (F.col("toxic") * math.log(base) + clean * math.log(10 / base) < math.log(1e-6)))
    best = strong.orderBy(F.col("toxic").desc(), F.length("stem").desc(), "stem").limit(max_candidates)
    held = stems.where("label = 1").join(F.broadcast(best.select("stem")), "stem").groupBy("stem").agg(F.collect_list("row").alias("held"))
    left = {r["stem"]: set(r["held"]) for r in held.collect()}
    least = max(2, round(0.003 * toxic))
    chosen: list[str] = []
    while left and len(chosen) < max_stems:
        stem, rows_held = max(left.items(), key=lambda x: (len(x[1]), len(x[0]), x[0]))
        if len(rows_held) < least:
            break
        chosen.append(stem)
        left = {s: r - rows_held for s, r in left.items() if s != stem}
    discard(words)
    if not chosen:
        discard(usual)
        return [], []
    begins = F.array(*map(F.lit, chosen))
    spared = usual.where(F.exists(begins, lambda s: F.col("word").startswith(s))).collect()  # words of the bounded sample
    discard(usual)
    return chosen, [r["word"] for r in spared]


def fit_logistic(x: np.ndarray, y: np.ndarray, prior: np.ndarray, ridge: float = 1.0, rounds: int = 30) -> np.ndarray:
    """Weights (last: intercept) of a logistic regression with a normal prior around ``prior``, by Newton steps."""
    x = np.column_stack([x, np.ones(len(x))])
    penalty = np.full(x.shape[1], ridge)
    penalty[-1] = 1e-3
    w = prior.astype(float).copy()
    for _ in range(rounds):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        gradient = x.T @ (p - y) + penalty * (w - prior)
        step = np.linalg.solve((x * (p * (1 - p))[:, None]).T @ x + np.diag(penalty), gradient)
        w -= np.clip(step, -5, 5)
        if np.abs(step).max() < 1e-8:
            break
    return w


#: Prior weights of PATTERNS, of the number of clauses, and the intercept.
PRIOR = np.array([3.0, 4.0, 1.0, 4.0, 1.0, 1.0, -3.0])


@dataclass
class ToxicityModel:
    stems: dict[str, float]
    spared: list[str]
    weights: list[float]

    def reader(self) -> Reader:
        return Reader(self.stems, self.spared)

    def score(self, features: list[float]) -> float:
        z = sum(w * f for w, f in zip(self.weights, features)) + self.weights[-1]
        return 1 / (1 + math.exp(-max(-30.0, min(30.0, z))))


def fit(docs: DataFrame, labels: DataFrame, max_rows: int = 8000, key: str = "doc_id", text: str = "text") -> ToxicityModel:
    """Learn stems and pattern weights from ``labels`` (``key``, ``label`` 0/1) and the texts of their rows."""
    sample = labelled_sample(docs, labels, max_rows, key, text)
    learned, spared = learn_stems(sample)
    stems = dict.fromkeys([*INSULTS, *learned], 1.0)
    reader = Reader(stems, spared)

    def run(batches):
        for b in batches:
            found = [reader.features(t) for t in b.column(0).to_pylist()]
            yield pa.RecordBatch.from_arrays([pa.array(found, pa.list_(pa.float64())), b.column(1)], names=["features", "label"])

    rows = sample.select("text", F.col("label").cast("int").alias("label")).mapInArrow(run, "features array<double>, label int")
    # bounded: distinct feature rows of at most about max_rows documents
    rows = rows.groupBy("features", "label").count().collect()
    if not rows:
        return ToxicityModel(stems, spared, PRIOR.tolist())
    x = np.repeat(np.array([r["features"] for r in rows]), [r["count"] for r in rows], axis=0)
    y = np.repeat(np.array([r["label"] for r in rows], float), [r["count"] for r in rows])
    return ToxicityModel(stems, spared, fit_logistic(x, y, PRIOR).tolist())


def score(docs: DataFrame, model: ToxicityModel, text: str = "text", out: str = "score") -> DataFrame:
    """Append the toxicity score (0 to 1) of ``text``. A column named ``out`` is replaced."""
    kept = [c for c in docs.columns if c != out]
    at = kept.index(text)
    reader = model.reader()

    def run(batches):
        for b in batches:
            scores = []
            for i in range(0, b.num_rows, 64):
                scores += [model.score(reader.features(t)) for t in b.column(at).slice(i, 64).to_pylist()]
            yield pa.RecordBatch.from_arrays([*b.columns, pa.array(scores, pa.float64())], names=[*kept, out])

    source = docs.select(*kept)
    return source.mapInArrow(run, source.withColumn(out, F.lit(0.0)).schema)


def training_labels(labels: DataFrame, key: str = "doc_id", label: str = "toxic") -> DataFrame:
    """Labels that may be learned from: those outside the held-out quarter."""
    return labels.where(~held_out(F.col(key))).select(F.col(key).alias(key), F.col(label).cast("int").alias("label"))


def held_out(key):
    """Whether a key is in the held-out quarter: crc32 of its text modulo 4 is 2 (null key: of the empty text)."""
    return F.crc32(F.coalesce(key.cast("string"), F.lit(""))) % 4 == 2
