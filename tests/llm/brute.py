"""Plain, slow versions of the registered queries, row by row."""

import hashlib
import re
import zlib
from collections import Counter

import numpy as np
import public_tokenizers
import xxhash
from tokenizers import Tokenizer

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def ids_of(texts, end):
    t = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    t.encode_special_tokens = True
    return [np.array([*e.ids, end], dtype="<u4") for e in t.encode_batch([x or "" for x in texts], add_special_tokens=False)]


def crc(ids):
    return zlib.crc32(ids.astype("<u4").tobytes())


def token_file(docs):
    docs = sorted(docs, key=lambda d: d[0])
    out, start = {}, 0
    for (i, _), ids in zip(docs, ids_of([t for _, t in docs], 2)):
        out[i] = (start, len(ids), crc(ids))
        start += len(ids)
    return out


def simhash(docs):
    """{doc_id: (hex, component)} by comparing all pairs."""
    prints = []
    for i, text in docs:
        found = WORD.findall("".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or ""))
        if not found:
            prints.append((i, 0))
            continue
        shingles = [" ".join(found[k : k + 4]) for k in range(len(found) - 3)] or [" ".join(found)]
        ones, n = [0] * 64, len(shingles)
        for s in shingles:
            h = xxhash.xxh64_intdigest(s.encode(), 42)
            for b in range(64):
                ones[b] += h >> b & 1
        prints.append((i, sum(1 << b for b in range(64) if 2 * ones[b] > n)))
    root = {i: i for i, _ in prints}

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for k, (i, a) in enumerate(prints):
        for j, b in prints[k + 1 :]:
            if (a ^ b).bit_count() <= 4:
                x, y = find(i), find(j)
                root[max(x, y)] = min(x, y)
    return {i: (f"{p:016x}", find(i)) for i, p in prints}


def base_rules(text):
    text = text or ""
    found = WORD.findall(text)
    seen, dup = set(), 0
    for line in text.split("\n"):
        if WORD.search(line):
            dup += line in seen
            seen.add(line)
    windows = [tuple(found[k : k + 8]) for k in range(len(found) - 7)]
    often = Counter(windows)
    covered = set()
    for k, w in enumerate(windows):
        if often[w] > 1:
            covered.update(range(k, k + 8))
    n, r = len(found), len(covered)
    symbols = len(re.findall(r"[#*$%&|<>]", text))
    return (n, sum(map(len, found)), symbols, dup, r, n < 20 or 100 * r > 30 * n)


def targets(sizes):
    """{source: target} from {source: size}, sharing anew until nothing is above its limit."""
    names = sorted((s for s in sizes if s is not None), key=lambda s: [ord(c) for c in s]) + [s for s in sizes if s is None]
    weight = {s: (3, 1, 2)[k % 3] for k, s in enumerate(names)}
    left, open_, out = 1.5 * sum(sizes.values()), set(names), {}
    while open_:
        level = left / sum(weight[s] for s in open_)
        above = {s for s in open_ if weight[s] * level >= 2 * sizes[s]}
        if not above:
            out.update({s: weight[s] * level for s in open_})
            break
        for s in above:
            out[s] = 2.0 * sizes[s]
            left -= out[s]
        open_ -= above
    return out


def edited(docs):
    docs = sorted(docs, key=lambda d: d[0])
    out = {}
    for k, (i, text) in enumerate(docs):
        text, after = text or "", docs[(k + 1) % len(docs)][1] or ""
        cut = len(text) // 2
        out[i] = (len(text), hashlib.sha256((text[: len(text) - cut] + after[:cut]).encode()).hexdigest())
    return out
