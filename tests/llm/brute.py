"""Plain-Python versions of the operators, for small inputs."""

import hashlib
import math
import re
import zlib
from collections import defaultdict

import numpy as np

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
WORDS = re.compile(r"[^\x20\x09-\x0D]+")
ALNUM = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def near_duplicates(rows, width, percent):
    """{row index: (n_shingles, component_id, kept)}"""
    sets = []
    for _, text in rows:
        w = WORDS.findall((text or "").translate(LOWER))
        sets.append({tuple(w[i: i + width]) for i in range(len(w) - width + 1)} if len(w) >= width else {tuple(w)} if w else set())
    parent = {}

    def root(x):
        while parent.setdefault(x, x) != x:
            x = parent[x]
        return x

    for i, (a, _) in enumerate(rows):
        for j in range(i):
            b = rows[j][0]
            if a is None or b is None or not sets[i] or not sets[j]:
                continue
            common = len(sets[i] & sets[j])
            if 100 * common >= percent * (len(sets[i]) + len(sets[j]) - common):
                x, y = sorted((root(a), root(b)))
                parent[y] = x
    out = {}
    for i, (a, _) in enumerate(rows):
        component = a if a is None or not sets[i] else root(a)
        out[i] = (len(sets[i]), component, a == component)
    return out


def contamination(docs, items, width):
    known = defaultdict(set)
    for item, text in items:
        w = ALNUM.findall((text or "").translate(LOWER))
        n = min(width, len(w))
        for i in range(len(w) - n + 1 if n else 0):
            known[tuple(w[i: i + n])].add("" if item is None else str(item))
    lengths = {len(k) for k in known}
    out = []
    for doc, text in docs:
        w = ALNUM.findall((text or "").translate(LOWER))
        hit, found = set(), set()
        for n in lengths:
            for i in range(len(w) - n + 1):
                if (g := tuple(w[i: i + n])) in known:
                    hit |= set(range(i, i + n))
                    found |= known[g]
        out.append((doc, len(w), len(hit), len(found), hashlib.sha256(",".join(sorted(found)).encode()).hexdigest(), bool(hit)))
    return out


def remove_repeats(rows, window):
    first = {}
    for doc, text in rows:
        w = WORDS.findall(text or "")
        for i in range(len(w) - window + 1 if doc is not None else 0):
            g = tuple(w[i: i + window])
            first[g] = min(first.get(g, doc), doc)
    out = []
    for doc, text in rows:
        w = WORDS.findall(text or "")
        gone = set()
        for i in range(len(w) - window + 1 if doc is not None else 0):
            if first[tuple(w[i: i + window])] < doc:
                gone |= set(range(i, i + window))
        kept = " ".join(x for i, x in enumerate(w) if i not in gone)
        out.append((doc, len(w), len(gone), hashlib.sha256(kept.encode()).hexdigest()))
    return out


def poisson_copies(rows, weights=None, total=None, temperature=0.5, seed=17):
    """Copies of each row (doc_id, source, ...), by summing the distribution up to the hashed number."""
    n = defaultdict(int)
    for r in rows:
        n[r[1]] += 1
    w = {s: (float(weights.get(s, 0)) if weights is not None else n[s] ** temperature) for s in n}
    all_w, size = sum(w.values()) or 1.0, len(rows) if total is None else total
    out = []
    for r in rows:
        mean = w[r[1]] / all_w * size / n[r[1]]
        parts = max(1, math.ceil(mean / 32.0))
        m, copies = mean / parts, 0
        for i in range(1, parts + 1):
            text = f"{seed}:{'' if r[0] is None else r[0]}:{i}"
            u = int(hashlib.md5(text.encode()).hexdigest()[:13], 16) / 2 ** 52
            k, p, c = 0, math.exp(-m), math.exp(-m)
            while c <= u and k < 121 and m > 0:
                k += 1
                p *= m / k
                c += p
            copies += k
        out.append(copies)
    return out


def token_rows(rows, tokenizer, end_id):
    """(doc_id, start, n_tokens, crc) of rows sorted by doc_id (null first) and text."""
    rows = sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0, r[1] is not None, r[1] or ""))
    at, out = 0, []
    for doc, text in rows:
        ids = [*tokenizer.encode(text or "", add_special_tokens=False).ids, end_id]
        out.append((doc, at, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())))
        at += len(ids)
    return out


def code_length(sample, order, text):
    """Bits of a text under one language's counts, byte by byte down the escapes."""
    counts = defaultdict(lambda: defaultdict(int))
    for i, b in enumerate(sample):
        for k in range(min(order, i) + 1):
            counts[sample[i - k: i]][b] += 1
    bits = 0.0
    for i, b in enumerate(text):
        excluded = set()
        for k in range(min(order, i), -1, -1):
            context = text[i - k: i]
            if context not in counts:
                continue
            seen = {x: n for x, n in counts[context].items() if x not in excluded}
            if not seen:
                continue
            weight = sum(seen.values()) + len(seen)
            if b in seen:
                bits -= math.log2(seen[b] / weight)
                break
            bits -= math.log2(len(seen) / weight)
            excluded |= set(seen)
        else:
            bits += math.log2(max(1, 256 - len(excluded)))
    return bits
