"""Plain versions of what the operators compute, for small inputs."""

from __future__ import annotations

import hashlib
import math
import re
import zlib
from collections import Counter, defaultdict

LOW = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
ALNUM = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
SPACED = re.compile(r"[^\x20\x09-\x0D]+")


def words(text, pattern=ALNUM):
    return pattern.findall((text or "").translate(LOW))


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


def base_scores(docs):
    """doc_id -> (held_out, n_tokens, n_known, train_tokens, base_score)."""
    tokens = [(d, zlib.crc32(str(d).encode()) % 7 == 2 if d is not None else False, [*words(t, SPACED), "\0end"]) for d, t in docs]
    counts = Counter(w for _, held, ws in tokens if not held for w in ws)
    total, types = sum(counts.values()), len(counts)
    return [(d, held, len(ws), sum(counts[w] > 0 for w in ws), total, sum(math.log10((counts[w] + 1) / (total + types + 1)) for w in ws)) for d, held, ws in tokens]


def model_scores(docs, order, smoothing, cutoff):
    """doc_id -> the interpolated probability by counts on the logarithmic scale, without a filter."""
    tokens = [(d, zlib.crc32(str(d).encode()) % 7 == 2 if d is not None else False, [*words(t, SPACED), "\0end"]) for d, t in docs]
    grams = lambda ws, n: [tuple((["\0begin"] * (n - 1) + ws)[i : i + n]) for i in range(len(ws))]
    counts = Counter(g for _, held, ws in tokens if not held for n in range(1, order + 1) for g in grams(ws, n))
    counts = {g: c for g, c in counts.items() if len(g) < 3 or c >= cutoff}
    singles = [c for g, c in counts.items() if len(g) == 1]
    total, types, texts = sum(singles), len(singles), sum(not held for _, held, _ in tokens)
    level = lambda g: (2.0 ** (counts[g].bit_length() - 1) + 2.0 ** counts[g].bit_length() - 1) / 2 if g in counts else 0.0
    out = []
    for d, _, ws in tokens:
        score = 0.0
        for i, w in enumerate(ws):
            p = (level((w,)) + 1) / (total + types + 1)
            for n in range(2, order + 1):
                before = level(grams(ws, n - 1)[i - 1]) if i else texts
                p = (min(level(grams(ws, n)[i]), before) + smoothing[n - 2] * p) / (before + smoothing[n - 2])
            score += math.log10(p)
        out.append((d, score))
    return out


def contamination(docs, items, width=10):
    windows = defaultdict(set)
    for item, text in items:
        ws = words(text)
        for k in range(max(1, len(ws) - width + 1) if ws else 0):
            windows[tuple(ws[k : k + width])].add(str(item))
    out = []
    for d, text in docs:
        ws, hit, found = words(text), set(), set()
        for n in {len(w) for w in windows}:
            for k in range(len(ws) - n + 1):
                if owners := windows.get(tuple(ws[k : k + n])):
                    hit.update(range(k, k + n))
                    found |= owners
        out.append((d, len(ws), len(hit), len(found), sha(",".join(sorted(found))), bool(hit)))
    return out


def shingle_set(text, width=5):
    ws = words(text)
    return {tuple(ws[k : k + width]) for k in range(max(1, len(ws) - width + 1))} if ws else set()


def near_classes(docs, least=0.8):
    """doc_id -> smallest doc_id of its class; ids are unique here."""
    sets = [(d, shingle_set(t)) for d, t in docs]
    parent = {d: d for d, _ in sets}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for i, (a, one) in enumerate(sets):
        for b, two in sets[:i]:
            if one and two and len(one & two) / len(one | two) >= least:
                parent[max(find(a), find(b))] = min(find(a), find(b))
    return {d: find(d) for d, _ in sets}


def covered(docs, least=50):
    """Row number -> words that stand in a repeated run of ``least`` words."""
    counts = Counter()
    lists = [words(t) for _, t in docs]
    for ws in lists:
        counts.update(tuple(ws[k : k + least]) for k in range(len(ws) - least + 1))
    return [{w for k in range(len(ws) - least + 1) if counts[tuple(ws[k : k + least])] > 1 for w in range(k, k + least)} for ws in lists]


ASSIGN = re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.I | re.A)


def base_spans(text):
    text = text or ""
    out = [(m.start(), 0, m.end()) for m in ASSIGN.finditer(text.replace("ſ", "*").replace("K", "*")) if len(m[2]) >= 6]
    out += [(m.start(), 1, m.end()) for m in re.finditer(r"AKIA[A-Z0-9]+", text) if len(m[0]) >= 20]
    out += [(m.start(), 2, m.end()) for m in re.finditer(r"[0-9a-f]+", text) if len(m[0]) >= 24]
    return sorted(out)
