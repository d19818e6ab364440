"""Plain versions of the operators, for small tables."""

import hashlib
import re
from collections import Counter

import numpy as np
import xxhash

WORD = re.compile(r"[^\x20\x09-\x0D]+")
#: Null, empty, blank, ties, repeats inside and across texts, non-ASCII, one long word and one long text.
EDGES = [None, "", " \n\t", "x", "x " * 120, "a" * 300, "a" * 300 + "b", "é" * 60, "né " * 80, "one two three " * 30]


def corpus(seed=5, n=60):
    rng = np.random.default_rng(seed)
    base = [" ".join(rng.choice(["alpha", "be", "gämma", "d", "ep", "zeta", "eta"], 60)) for _ in range(8)]
    texts = []
    for _ in range(n):
        parts = [base[rng.integers(8)][rng.integers(50) : rng.integers(60, 300)] for _ in range(rng.integers(4))]
        texts.append("\n".join([*parts, " ".join(rng.choice(list("pqrstuv"), rng.integers(1, 30)))]))
    texts += EDGES + [texts[3], texts[3]]
    order = rng.permutation(len(texts))
    return [(int(i), texts[k]) for k, i in enumerate(order)]


def repeated_bytes(docs, size=50):
    first = {}
    for i, text in docs:
        b = (text or "").encode()
        for s in range(len(b) - size + 1):
            first[b[s : s + size]] = min(first.get(b[s : s + size], 1 << 62), i)
    out = {}
    for i, text in docs:
        b = (text or "").encode()
        gone = [False] * len(b)
        for s in range(len(b) - size + 1):
            if first[b[s : s + size]] < i:
                gone[s : s + size] = [True] * size
        spans = sum(g and (k == 0 or not gone[k - 1]) for k, g in enumerate(gone))
        kept = bytes(x for x, g in zip(b, gone) if not g)
        out[i] = (len(b), sum(gone), spans, hashlib.sha256(kept).hexdigest())
    return out


def repeated_words(docs, size=20):
    words, first, out = {i: WORD.findall(t or "") for i, t in docs}, {}, {}
    for i in sorted(words):
        for s in range(len(words[i]) - size + 1):
            first.setdefault(tuple(words[i][s : s + size]), (i, s))
    for i, w in words.items():
        gone = [False] * len(w)
        for s in range(len(w) - size + 1):
            if first[tuple(w[s : s + size])] < (i, s):
                gone[s : s + size] = [True] * size
        kept = " ".join(x for x, g in zip(w, gone) if not g)
        out[i] = (len(w), sum(gone), hashlib.sha256(kept.encode()).hexdigest())
    return out


def classes(near, ids):
    """The least id that each can reach; ``near`` is a matrix of links, ids ascend."""
    label = {}
    for a, name in enumerate(ids):
        if name in label:
            continue
        label[name], todo = name, [a]
        while todo:
            for b in np.flatnonzero(near[todo.pop()]):
                if ids[b] not in label:
                    label[ids[b]] = name
                    todo.append(b)
    return label


def simhash(docs):
    prints = {}
    for i, text in sorted(docs):
        words = WORD.findall("".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or ""))
        parts = [" ".join(words[k : k + 3]) for k in range(max(1, len(words) - 2))] if words else []
        hashes = [xxhash.xxh64_intdigest(p.encode(), 42) for p in parts]
        prints[i] = sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))
    v = np.array(list(prints.values()), np.uint64)
    label = classes(np.bitwise_count(v[:, None] ^ v[None, :]) <= 3, list(prints))
    return {i: (format(p, "016x"), label[i]) for i, p in prints.items()}


def quality(text):
    text = text or ""
    words = WORD.findall(text)
    lines = [x for x in text.split("\n") if WORD.search(x)]
    windows = [tuple(words[i : i + 3]) for i in range(len(words) - 2)]
    often, covered = Counter(windows), set()
    for i, w in enumerate(windows):
        if often[w] > 1:
            covered |= {i, i + 1, i + 2}
    symbols = sum(c in "#*$%&|<>" for c in text)
    return len(words), sum(map(len, words)), symbols, len(lines) - len(set(lines)), len(covered)
