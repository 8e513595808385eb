"""The same results by plain loops, to compare the operators with."""

from __future__ import annotations

import hashlib
import math
import re
import zlib
from collections import Counter

WORD = re.compile(r"[^\x20\x09-\x0D]+")
PLAIN_WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
ASSIGN = re.compile(r"""((?ai:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""")


def sha(text: str) -> str:
    return hashlib.sha256(text.encode()).hexdigest()


def in_order(docs):
    """(doc_id, text) by id, NULL first."""
    return sorted(docs, key=lambda d: (d[0] is not None, d[0] or 0))


def secrets(text):
    text = text or ""
    spans = [(m.start(), 0, m.end()) for m in ASSIGN.finditer(text) if len(m[2]) >= 6]
    spans += [(m.start(), 1, m.end()) for m in re.finditer("AKIA[A-Z0-9]+", text) if len(m[0]) >= 20]
    spans += [(m.start(), 2, m.end()) for m in re.finditer("[0-9a-f]+", text) if len(m[0]) >= 24]
    return sorted(spans)


def top_entropy(value, window):
    best = 0.0
    for i in range(len(value) - window + 1):
        counts = Counter(value[i : i + window])
        best = max(best, -sum(c / window * math.log2(c / window) for c in counts.values()))
    return best


def quality(text):
    text = text or ""
    words, seen, dup = WORD.findall(text), set(), 0
    for line in text.split("\n"):
        if WORD.search(line):
            dup += line in seen
            seen.add(line)
    windows = [tuple(words[i : i + 3]) for i in range(len(words) - 2)]
    many, covered = Counter(windows), set()
    for i, w in enumerate(windows):
        if many[w] > 1:
            covered |= {i, i + 1, i + 2}
    n = len(words)
    failed = n < 50 or 100 * len(covered) > 50 * n
    return n, sum(map(len, words)), sum(c in "#*$%&|<>" for c in text), dup, len(covered), failed


def item_windows(items, n=10):
    windows = {}
    for item, text in items:
        words = tuple(PLAIN_WORD.findall((text or "").translate(LOWER)))
        each = [words[i : i + n] for i in range(len(words) - n + 1)] if len(words) >= n else [words] if words else []
        for w in each:
            windows.setdefault(w, set()).add("" if item is None else str(item))
    return windows


def contamination(text, windows):
    words = tuple(PLAIN_WORD.findall((text or "").translate(LOWER)))
    covered, items = set(), set()
    for n in {len(w) for w in windows}:
        for i in range(len(words) - n + 1):
            if words[i : i + n] in windows:
                covered |= set(range(i, i + n))
                items |= windows[words[i : i + n]]
    return len(words), len(covered), sorted(items)


def suffix_dedup(docs, long=100):
    seen, out = set(), []
    for doc, text in in_order(docs):
        data = (text or "").encode()
        gone = bytearray(len(data))
        for i in range(len(data) - long + 1):
            window = data[i : i + long]
            if window in seen:
                gone[i : i + long] = b"\1" * long
            seen.add(window)
        kept = bytes(b for b, g in zip(data, gone, strict=True) if not g)
        runs = sum(1 for i in range(len(data)) if gone[i] and not (i and gone[i - 1]))
        out.append((doc, len(data), sum(gone), runs, kept))
    return out


def line_dedup(docs, least):
    seen, out = set(), []
    for doc, text in in_order(docs):
        lines = (text or "").split("\n")
        words = [len(line.encode().split()) for line in lines]
        units, gone = [i for i, n in enumerate(words) if n], set()
        for a in range(len(units)):
            for b in range(a, len(units)):
                if sum(words[i] for i in units[a : b + 1]) >= least:
                    run = tuple(lines[i] for i in units[a : b + 1])
                    if run in seen:
                        gone |= set(units[a : b + 1])
                    seen.add(run)
        out.append((doc, len(gone), "\n".join(line for i, line in enumerate(lines) if i not in gone)))
    return out


def shingle_set(text, size):
    words = (text or "").encode().lower().split()
    if not words:
        return set()
    return {tuple(words[i : i + size]) for i in range(len(words) - size + 1)} if len(words) >= size else {tuple(words)}


def components(docs, size=4, part=85):
    """position -> (set size, root position), documents given as (id, text)."""
    sets = [shingle_set(text, size) for _, text in docs]
    root = list(range(len(docs)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for i, a in enumerate(sets):
        for j in range(i):
            b = sets[j]
            if a and b and 100 * len(a & b) >= part * len(a | b):
                x, y = find(i), find(j)
                root[max(x, y)] = min(x, y)
    return [(len(s), find(i)) for i, s in enumerate(sets)]


def targets(sizes, weights=(5, 2, 1)):
    """Source sizes -> target by source."""
    order = sorted((s for s in sizes if s is not None)) + [None] * (None in sizes)
    weight = {s: weights[i % 3] for i, s in enumerate(order)}
    total, done, free = 1.5 * sum(sizes.values()), {}, set(order)
    while free:
        level = (total - sum(done.values())) / sum(weight[s] for s in free)
        over = [s for s in free if level * weight[s] > 2 * sizes[s]]
        if not over:
            return done | {s: level * weight[s] for s in free}
        done |= {s: 2.0 * sizes[s] for s in over}
        free -= set(over)
    return done


def base_scores(docs):
    def held(doc):
        return zlib.crc32(("" if doc is None else str(doc)).encode()) % 7 == 2

    tokens = [[*(t or "").encode().lower().split(), b""] for _, t in docs]
    counts = Counter(w for (d, _), ws in zip(docs, tokens, strict=True) if not held(d) for w in ws)
    n, v = sum(counts.values()), len(counts)
    return [
        (d, held(d), len(ws), sum(counts[w] > 0 for w in ws), n, sum(math.log10((counts[w] + 1) / (n + v + 1)) for w in ws))
        for (d, _), ws in zip(docs, tokens, strict=True)
    ]
