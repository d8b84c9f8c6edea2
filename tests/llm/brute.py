"""Plain versions of the operators' contracts, a document at a time."""

from __future__ import annotations

import hashlib
import math
import re
import zlib
from collections import Counter

import numpy as np
import xxhash

BLANK = re.compile(rb"[^\x20\x09-\x0D]+")
ALNUM = re.compile(rb"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
LOWER = bytes(b + 32 if 65 <= b < 91 else b for b in range(256))


def raw(text: str | None) -> bytes:
    return (text or "").encode()


def sha(data: bytes) -> str:
    return hashlib.sha256(data).hexdigest()


def windows_hit(words: list, size: int, wanted) -> list[bool]:
    hit = [False] * len(words)
    for i in range(len(words) - size + 1):
        if wanted(tuple(words[i : i + size])):
            hit[i : i + size] = [True] * size
    return hit


def decontamination(docs, items, width):
    windows: dict[tuple, set] = {}
    for item, text in items:
        words = ALNUM.findall(raw(text).translate(LOWER))
        for i in range(max(1, len(words) - width + 1) if words else 0):
            windows.setdefault(tuple(words[i : i + width]), set()).add(str(item))
    out = []
    for doc, text in docs:
        words = ALNUM.findall(raw(text).translate(LOWER))
        hit, found = [False] * len(words), set()
        for size in {len(w) for w in windows}:
            for i in range(len(words) - size + 1):
                if items_of := windows.get(tuple(words[i : i + size])):
                    hit[i : i + size] = [True] * size
                    found |= items_of
        out.append((doc, len(words), sum(hit), len(found), sha(",".join(sorted(found)).encode()), any(hit)))
    return out


def first_doc(docs, parts):
    """The smallest doc_id of each part; parts(text) lists them."""
    first: dict = {}
    for doc, text in docs:
        for part in parts(text) if doc is not None else ():
            first[part] = min(first.get(part, doc), doc)
    return first


def byte_dedup(docs, window):
    def parts(text):
        return [raw(text)[i : i + window] for i in range(len(raw(text)) - window + 1)]

    first = first_doc(docs, parts)
    out = []
    for doc, text in docs:
        data = raw(text)
        gone = windows_hit(list(data), window, lambda w: doc is not None and first[bytes(w)] < doc)
        spans = sum(g and not (i and gone[i - 1]) for i, g in enumerate(gone))
        kept = bytes(b for b, g in zip(data, gone) if not g)
        out.append((doc, len(data), sum(gone), spans, sha(kept)))
    return out


def word_dedup(docs, window):
    def parts(text):
        words = BLANK.findall(raw(text))
        return [tuple(words[i : i + window]) for i in range(len(words) - window + 1)]

    first = first_doc(docs, parts)
    out = []
    for doc, text in docs:
        words = BLANK.findall(raw(text))
        gone = windows_hit(words, window, lambda w: doc is not None and first[w] < doc)
        kept = b" ".join(w for w, g in zip(words, gone) if not g)
        out.append((doc, len(words), sum(gone), sha(kept)))
    return out


def fingerprint(text: str | None, shingle: int = 3) -> int:
    words = BLANK.findall(raw(text).translate(LOWER))
    if not words:
        return 0
    hashes = [xxhash.xxh64_intdigest(b" ".join(words[i : i + shingle]), seed=42)
              for i in range(max(1, len(words) - shingle + 1))]
    return sum(1 << j for j in range(64) if 2 * sum(h >> j & 1 for h in hashes) > len(hashes))


def near_duplicates(docs, distance=2):
    prints = [fingerprint(text) for _, text in docs]
    parent = list(range(len(docs)))

    def root(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for i in range(len(docs)):
        for j in range(i):
            if (prints[i] ^ prints[j]).bit_count() <= distance:
                parent[root(i)] = root(j)
    least: dict[int, int] = {}
    for i, (doc, _) in enumerate(docs):
        if doc is not None:
            least[root(i)] = min(least.get(root(i), doc), doc)
    return [(doc, f"{p:016x}", least.get(root(i))) for i, ((doc, _), p) in enumerate(zip(docs, prints))]


def mix_targets(sizes: dict) -> dict:
    """Shares by weight; what is above three times a source's size is shared again until nothing is."""
    names = sorted((s for s in sizes if s is not None)) + [s for s in sizes if s is None]
    weight = {s: i % 3 + 1 for i, s in enumerate(names)}
    total, full = sum(sizes.values()), set()
    while True:
        left = total - sum(3 * sizes[s] for s in full)
        open_ = [s for s in names if s not in full]
        share = {s: left * weight[s] / sum(weight[o] for o in open_) for s in open_}
        above = {s for s in open_ if share[s] > 3 * sizes[s]}
        if not above:
            return {s: share.get(s, 3.0 * sizes[s]) for s in names}
        full |= above


def held_out(doc, folds, value):
    return doc is not None and zlib.crc32(str(doc).encode()) % folds == value


def unigram(docs, folds=10):
    counts: Counter = Counter()
    tokens = {}
    for i, (doc, text) in enumerate(docs):
        tokens[i] = [*BLANK.findall(raw(text).translate(LOWER)), None]
        if not held_out(doc, folds, 0):
            counts.update(tokens[i])
    n, v = sum(counts.values()), len(counts)
    return [
        (doc, held_out(doc, folds, 0), len(tokens[i]), sum(counts[t] > 0 for t in tokens[i]), n,
         sum(math.log10((counts[t] + 0.1) / (n + 0.1 * (v + 1))) for t in tokens[i]))
        for i, (doc, _) in enumerate(docs)
    ]


def context_tree(train: list[bytes], text: bytes, depth: int) -> float:
    """log10 probability of a text, A-Z lower-cased, and of its end, by trees of dictionaries, a bit at a time."""
    train, text = [t.lower() + b"\xff" for t in train], text.lower() + b"\xff"
    counts: dict = {}
    for data in train:
        for i, symbol in enumerate(data):
            context = tuple(data[i - k] if i >= k else 0xFF for k in range(1, depth + 1))
            for bit in range(8):
                prefix = (1 << bit) | symbol >> (8 - bit)
                for d in range(depth + 1):
                    node = counts.setdefault((context[:d], prefix), [0, 0])
                    node[symbol >> (7 - bit) & 1] += 1

    def own(node):
        a, b = counts[node]
        return math.lgamma(a + 0.5) + math.lgamma(b + 0.5) - math.lgamma(a + b + 1) - math.log(math.pi)

    children: dict = {}
    for context, prefix in counts:
        if context:
            children.setdefault((context[:-1], prefix), []).append((context, prefix))
    weighted: dict = {}
    for node in sorted(counts, key=lambda n: -len(n[0])):
        if len(node[0]) == depth:
            weighted[node] = own(node)
        else:
            weighted[node] = np.logaddexp(own(node), sum(weighted[c] for c in children[node])) - math.log(2)

    total = 0.0
    for i, symbol in enumerate(text):
        context = tuple(text[i - k] if i >= k else 0xFF for k in range(1, depth + 1))
        for bit in range(8):
            prefix, p = (1 << bit) | symbol >> (8 - bit), 0.5
            for d in range(depth, -1, -1):
                node = (context[:d], prefix)
                if node not in counts:
                    p = 0.5
                    continue
                stop = 1.0 if d == depth else math.exp(own(node) - math.log(2) - weighted[node])
                p = stop * (counts[node][1] + 0.5) / (sum(counts[node]) + 1) + (1 - stop) * p
            total += math.log10(p if symbol >> (7 - bit) & 1 else 1 - p)
    return total
