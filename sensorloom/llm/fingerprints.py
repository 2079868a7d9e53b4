"""Document fingerprints by Order MinHash, in DataFrame functions only.

The k-mers of a text are its runs of ``k`` words (the last ones shorter). Equal k-mers are told apart by their occurrence number, so
repetition counts. Each sketch has a hash function of its own, and picks the numbered k-mers of the whole text that are the
``picked`` smallest under it. The k-mers of a sketch are then put back in text order and the tuple of them is hashed: it
changes when k-mers go, come or change places, as edit distance does. The likeness of two fingerprints is the share of
equal sketches; texts without a common k-mer have 0. :func:`sketches` is a cheaper variant that deals one list of
smallest k-mers to all sketches; fingerprints do not use it, as it leaves sketches of short texts empty. A text and its edited
form are fingerprinted together, so that what they begin with is hashed once for both. Of the values of a sketch, evenly spread as hashes are, only the
about ``_TRIED`` times ``picked`` smallest are kept at first, up to a bound drawn from their number; if too few are, all are looked at.

K-mers are packed as 40 bits of hash and 24 bits of place in one long, so sorting is on primitive arrays. The
occurrence number of a k-mer in the sorted array is found by doubling steps backwards, not by counting, so a text that
repeats one word costs no more than n log n.

Defined results: null and empty texts have the fingerprint of the empty text; equal texts have equal fingerprints; of a
single document the next is itself; repeated keys are ordered by the text's digest, null keys come last.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .pairs import with_row_id

#: Fixed value: words are cut at space and 0x09-0x0D.
_SPACE = r"[\x20\x09-\x0D]+"
_PLACE = 24
#: Values that a sketch looks at more closely, for each that it picks.
_TRIED = 4
_STEPS = [1 << i for i in range(_PLACE - 1, -1, -1)]


def _let(value: Column, body) -> Column:
    """``body(value)`` with ``value`` computed once per row."""
    return F.transform(F.array(value), body)[0]


def _packed(digest: Column, place: Column) -> Column:
    return F.shiftleft(F.shiftrightunsigned(digest, _PLACE), _PLACE).bitwiseOR(place.cast("long"))


def _hash_of(packed: Column) -> Column:
    return F.shiftrightunsigned(packed, _PLACE)


def _place_of(packed: Column) -> Column:
    return packed.bitwiseAND(F.lit((1 << _PLACE) - 1))


def _kmers(words: Column, k: int) -> Column:
    """Sorted packed k-mers of an array of words."""
    hashes = F.transform(words, lambda w: F.xxhash64(w))
    packed = _let(
        hashes,
        lambda h: F.transform(h, lambda x, i: _packed(F.xxhash64(x, *(F.get(h, i + j) for j in range(1, k))), i)),
    )
    return F.sort_array(packed)


def _numbered_as(kmers: Column, form) -> Column:
    """Sorted ``form(hash of (k-mer, occurrence number), the k-mer's place)``."""

    def occurrence(s: Column, x: Column, i: Column) -> Column:
        back = F.aggregate(
            F.array(*map(F.lit, _STEPS)),
            F.lit(0),
            lambda d, step: F.when((i >= d + step) & (_hash_of(F.get(s, i - d - step)) == _hash_of(x)), d + step).otherwise(d),
        )
        return F.when(_hash_of(F.get(s, i - 1)) == _hash_of(x), back).otherwise(F.lit(0))

    return _let(kmers, lambda s: F.sort_array(F.transform(s, lambda x, i: form(F.xxhash64(_hash_of(x), occurrence(s, x, i)), _place_of(x)))))


def _numbered(kmers: Column) -> Column:
    """Sorted packed hashes of (k-mer, occurrence number), with the k-mer's place."""
    return _numbered_as(kmers, _packed)


def sketches(text: Column, k: int = 3, n: int = 32, picked: int = 2, kept: int = 256) -> Column:
    """Dealt variant: the ``kept`` smallest k-mers under one hash, dealt to ``n`` sketches by their value."""
    words = F.split(F.coalesce(text, F.lit("")), _SPACE, -1)
    smallest = F.slice(_numbered(_kmers(words, k)), 1, kept)

    def sketch(s: Column, j: Column) -> Column:
        own = F.slice(F.filter(s, lambda x: F.pmod(_hash_of(x), F.lit(n)) == j), 1, picked)
        placed = F.transform(own, lambda x: F.shiftleft(_place_of(x), 64 - _PLACE).bitwiseOR(_hash_of(x)))
        ordered = F.transform(F.sort_array(F.transform(placed, lambda x: x)), lambda x: x.bitwiseAND(F.lit((1 << (64 - _PLACE)) - 1)))
        return F.xxhash64(ordered)

    return _let(smallest, lambda s: F.transform(F.sequence(F.lit(0), F.lit(n - 1)), lambda j: sketch(s, j)))


def _in_order(words: Column, k: int) -> Column:
    """Hashes of the numbered k-mers of an array of words, in text order."""
    by_place = _numbered_as(_kmers(words, k), lambda digest, place: F.shiftleft(place, 64 - _PLACE).bitwiseOR(F.shiftrightunsigned(digest, _PLACE)))
    return F.transform(by_place, lambda x: x.bitwiseAND(F.lit((1 << (64 - _PLACE)) - 1)))


def _words(text: Column) -> Column:
    return F.split(F.coalesce(text, F.lit("")), _SPACE, -1)


def _least(values: Column, picked: int) -> Column:
    """The ``picked`` smallest different values, in their order."""

    def in_order(least: Column) -> Column:
        places = F.filter(F.transform(least, lambda x: F.array_position(values, x)), lambda at: at.isNotNull())
        return F.transform(F.sort_array(places), lambda at: F.get(values, at.cast("int") - 1))

    def found(rest: Column, least: list[Column]) -> Column:
        if len(least) == picked - 1:
            return F.array(*least, F.array_min(rest))
        return _let(F.array_min(rest), lambda x: found(F.array_remove(rest, x), [*least, x]))

    return _let(found(values, []), in_order)


def _at(i: int):
    return lambda values: F.get(values, F.lit(i))


def _seeded(hashes: Column, seed: Column) -> Column:
    return F.transform(hashes, lambda x: F.xxhash64(x.bitwiseXOR(seed)))


def _few(hashes: Column, seed: Column, bound: Column) -> Column:
    """The seeded values up to ``bound``, in their order."""
    return _seeded(F.filter(hashes, lambda x: F.xxhash64(x.bitwiseXOR(seed)) <= bound), seed)


def _smallest(few: Column, hashes: Column, seed: Column, picked: int) -> Column:
    """The ``picked`` smallest different seeded values, in their order. Those up to a bound are tried first, and nearly always enough."""

    def told(values: Column) -> Column:
        enough = F.size(F.array_distinct(values)) >= picked
        return F.when(enough, _least(values, picked)).otherwise(_let(_seeded(hashes, seed), lambda every: _least(every, picked)))

    return _let(few, told)


def _bound(hashes: Column, picked: int) -> Column:
    """About ``_TRIED * picked`` seeded values of so many hashes are up to this one."""
    n, tried = F.size(hashes), _TRIED * picked
    step = F.floor(F.lit(float(1 << 63)) / F.greatest(n, F.lit(2 * tried + 1)))
    return F.when(n > 2 * tried, F.lit(-(1 << 63)) + step * (2 * tried)).otherwise(F.lit((1 << 63) - 1))


def order_sketches(text: Column, k: int = 3, n: int = 32, picked: int = 2) -> Column:
    """Fingerprint of a text as an array of ``n`` longs: per sketch the tuple, in text order, of its ``picked`` smallest k-mers."""

    def sketch(s: Column, bound: Column, seed: Column) -> Column:
        return F.xxhash64(_smallest(_few(s, seed, bound), s, seed, picked))

    def every(s: Column, bound: Column) -> Column:
        return F.transform(F.sequence(F.lit(0), F.lit(n - 1)), lambda j: _let(F.xxhash64(j), lambda seed: sketch(s, bound, seed)))

    return _let(_in_order(_words(text), k), lambda s: _let(_bound(s, picked), lambda bound: every(s, bound)))


def both_sketches(text: Column, edited: Column, begin: Column, k: int = 3, n: int = 32, picked: int = 2) -> Column:
    """:func:`order_sketches` of ``text`` and, behind them, of ``edited``, two texts that begin with ``begin``.

    The k-mers within ``begin`` (but for its last word, which may go on) have the same places and numbers in both texts, so each
    sketch hashes them once and takes the few smallest into both tuples.
    """
    shared = F.greatest(F.size(_words(begin)) - k, F.lit(0))

    def sketch(front: Column, ends: list[Column], bound: Column, seed: Column) -> Column:
        def tuple_of(few: Column, end: Column) -> Column:
            return F.xxhash64(_smallest(F.concat(few, _few(end, seed, bound)), F.concat(front, end), seed, picked))

        return _let(_few(front, seed, bound), lambda few: F.array(*(tuple_of(few, end) for end in ends)))

    def every(front: Column, bound: Column, *ends: Column) -> Column:
        pairs = F.transform(F.sequence(F.lit(0), F.lit(n - 1)), lambda j: _let(F.xxhash64(j), lambda seed: sketch(front, ends, bound, seed)))
        return _let(pairs, lambda made: F.concat(*(F.transform(made, _at(i)) for i in (0, 1))))

    def end(s: Column, of: Column) -> Column:
        return F.slice(s, of + 1, F.size(s))

    def parts(t: Column, e: Column, of: Column) -> Column:
        ends = lambda f, bound: _let(end(t, of), lambda te: _let(end(e, of), lambda ee: every(f, bound, te, ee)))
        return _let(F.slice(t, F.lit(1), of), lambda f: _let(_bound(t, picked), lambda bound: ends(f, bound)))

    return _let(_in_order(_words(text), k), lambda t: _let(_in_order(_words(edited), k), lambda e: _let(shared, lambda of: parts(t, e, of))))


def as_text(sketch: Column) -> Column:
    return F.array_join(F.transform(sketch, lambda x: F.lower(F.lpad(F.hex(F.shiftrightunsigned(x, 24)), 10, "0"))), "-")


def likeness(a: Column, b: Column) -> Column:
    """Share of equal sketches, 0 to 1."""
    return F.size(F.filter(F.zip_with(a, b, lambda x, y: x == y), lambda same: same)) / F.size(a)


def with_next(
    docs: DataFrame, order: str, columns: list[str], rows_per_run: int = 2000, most_runs: int = 1 << 14, made: dict[str, Column] | None = None
) -> DataFrame:
    """Append ``next_<column>`` of the row that follows in ``order`` (a unique long); after the last comes the first.

    Columns ``made`` of these are appended as well, then the ``next_`` of each, without dealing the rows again.

    Rows are dealt once, into runs of consecutive ids between quantiles of the ids. The first row of each run is added to the
    run before as well, so that no run has to look beyond itself. The driver gets one id per run.
    """
    told = docs.agg(F.count("*").alias("n")).first()
    runs = max(1, min(most_runs, told["n"] // rows_per_run))
    cuts = [i / runs for i in range(1, runs)]
    borders = sorted(set(docs.agg(F.percentile_approx(order, cuts, 20 * runs).alias("b")).first()["b"] or [])) if cuts else []

    def run_of(value: Column) -> Column:
        if not borders:
            return F.lit(0)
        steps = [1 << i for i in range(len(borders).bit_length() - 1, -1, -1)]
        return F.aggregate(
            F.array(*map(F.lit, steps)),
            F.lit(0),
            lambda at, step: F.when((at + step <= len(borders)) & (F.get(F.lit(borders), at + step - 1) <= value), at + step).otherwise(at),
        )

    rows = docs.withColumn("_run", run_of(F.col(order)))
    firsts = {r["_run"]: r["first"] for r in rows.groupBy("_run").agg(F.min(order).alias("first")).collect()}
    present = sorted(firsts)
    before = {r: present[i - 1] for i, r in enumerate(present)}
    ghosts = docs.where(F.col(order).isin([firsts[r] for r in present]))
    place = [before.get(r, 0) for r in range(len(borders) + 1)]
    ghosts = ghosts.withColumn("_run", F.get(F.lit(place), run_of(F.col(order))))
    # a run's ghost sorts behind all its rows
    every = rows.withColumn("_ghost", F.lit(0)).unionByName(ghosts.withColumn("_ghost", F.lit(1)))
    following = Window.partitionBy("_run").orderBy("_ghost", order)
    for c in columns:
        every = every.withColumn(f"next_{c}", F.lead(c).over(following))
    if made:
        every = every.withColumns(made)
        every = every.withColumns({f"next_{c}": F.lead(c).over(following) for c in made})
    return every.where(F.col("_ghost") == 0).drop("_run", "_ghost")


def fingerprint(docs: DataFrame, text: str = "text", out: str = "sketches", **options) -> DataFrame:
    """Append the fingerprint of ``text`` (array<long>). A column named ``out`` is replaced."""
    return docs.withColumn(out, order_sketches(F.col(text), **options))


def edited_likeness(docs: DataFrame, key: str = "doc_id", text: str = "text", n: int = 32) -> DataFrame:
    """Fingerprints of each text, of the text with its last quarter replaced by the beginning of the next, and their likeness."""
    rows = with_row_id(docs.select(F.col(key).alias(key), F.coalesce(F.col(text), F.lit("")).alias("text")), key, "text")
    n_chars = F.length("text")
    quarter = F.floor(n_chars / 4).cast("int")
    begin = F.substring("text", F.lit(1), n_chars - quarter)
    edited = F.concat(begin, F.substring("next_text", F.lit(1), quarter))
    made = with_next(rows, "_uid", ["text"], made={"both": both_sketches(F.col("text"), edited, begin, n=n), "edited_sha256": F.sha2(edited, 256)})
    halves = {"sketches": F.slice("both", 1, n), "edited_sketches": F.slice("both", n + 1, n), "next_sketches": F.slice("next_both", 1, n)}
    made = made.withColumn("n_chars", n_chars.cast("long")).select(key, "n_chars", "edited_sha256", *(c.alias(name) for name, c in halves.items()))
    return made.select(
        key,
        "n_chars",
        "edited_sha256",
        as_text(F.col("sketches")).alias("fingerprint"),
        as_text(F.col("edited_sketches")).alias("edited_fingerprint"),
        likeness(F.col("sketches"), F.col("edited_sketches")).alias("near_edited"),
        likeness(F.col("sketches"), F.col("next_sketches")).alias("near_next"),
    )
