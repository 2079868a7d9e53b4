"""Small tables with the rows that trouble text operators, and brute-force versions of the operators."""

import random
import re

WORD = re.compile(r"[^\x20\x09-\x0D]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def documents(seed=3, n=60):
    """(doc_id, text, lang, source, n_chars): near copies, repeated lines and passages, nulls, blanks, a long text, repeated rows."""
    rng = random.Random(seed)
    vocabulary = ["".join(rng.choice("abcdeéßж日") for _ in range(rng.randint(1, 6))) for _ in range(400)]
    say = lambda k: " ".join(rng.choice(vocabulary) for _ in range(k))
    passage, line = say(60), say(12)
    texts = []
    for i in range(n):
        text = "\n".join(say(rng.randint(1, 30)) for _ in range(rng.randint(1, 6)))
        if i % 5 == 0:
            text += "\n" + passage + " " + say(3)
        if i % 4 == 0:
            text = line + "\n" + text
        texts.append(text)
    for i in range(0, n, 3):  # near copies
        words = texts[i].split(" ")
        words[rng.randrange(len(words))] = "edited"
        texts.append(" ".join(words))
    texts += [texts[1], texts[1], None, "", " \t ", "Word", "WORD", "a " * 300, "ab" * 400, "x" * 250, "é" * 130, say(3000), "\n\n", "one\r\ntwo"]
    rows = [(i * 7, t, "en", f"s{i % 4}" if i % 9 else None, len(t or "")) for i, t in enumerate(texts)]
    return rows


SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


def shingles(text, k, lower=True):
    words = WORD.findall((text or "").translate(LOWER) if lower else text or "")
    if not words:
        return frozenset()
    return frozenset([tuple(words)]) if len(words) < k else frozenset(tuple(words[i : i + k]) for i in range(len(words) - k + 1))


def similar(a, b, percent):
    return bool(a) and bool(b) and 100 * len(a & b) >= percent * len(a | b)


def components(rows, k, percent):
    """doc_id -> (set size, smallest linked id) for rows (id, text)."""
    sets = [(i, shingles(t, k)) for i, t in rows]
    parent = list(range(len(sets)))

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for i in range(len(sets)):
        for j in range(i):
            if similar(sets[i][1], sets[j][1], percent):
                a, b = sorted((root(i), root(j)))
                parent[b] = a
    least = {}
    for x, (i, _) in enumerate(sets):
        if i is not None:
            least[root(x)] = min(i, least.get(root(x), i))
    return [(i, len(s), least.get(root(x))) for x, (i, s) in enumerate(sets)]


def without_later_lines(rows, k, percent):
    """(id, text) -> (id, kept text, removed) with rows in order."""
    before, out = [], []
    for i, t in rows:
        kept = []
        for line in (t or "").split("\n"):
            s = shingles(line, k, lower=False)
            if not any(similar(s, b, percent) for b in before):
                kept.append(line)
            if s:
                before.append(s)
        out.append((i, "\n".join(kept), len((t or "").split("\n")) - len(kept)))
    return out


def without_repeats(rows, length):
    """(id, text) in order -> (id, bytes, removed, spans, kept bytes)."""
    seen, out = set(), []
    for i, t in rows:
        data = (t or "").encode()
        gone = bytearray(len(data))
        for p in range(len(data) - length + 1):
            s = data[p : p + length]
            if s in seen:
                gone[p : p + length] = b"\1" * length
            seen.add(s)
        spans = sum(1 for p in range(len(data)) if gone[p] and not (p and gone[p - 1]))
        out.append((i, len(data), sum(gone), spans, bytes(b for b, g in zip(data, gone) if not g)))
    return out
