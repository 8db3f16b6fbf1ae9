"""Phrase collocations against plain counting, whatever the shards and ranges, and on awkward rows."""

import random
import re
from collections import Counter

import pyarrow as pa
import pytest

from checks.compare import database, differences
from sootledger.llm import phrases
from sootledger.llm.phrases import Automaton

SCHEMA = "doc_id long, text string, lang string, phrase string, f int, range int"
COLUMNS = ["lang", "rank", "phrase", "a", "l", "r", "n", "score"]


def grams(text):
    lower = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    for piece in re.split(r"[.,;:!?\x0a-\x0d]", lower):
        words = re.findall(r"[^\x20\x09]+", piece)
        for i in range(len(words)):
            for m in range(1, min(4, len(words) - i) + 1):
                yield tuple(words[i : i + m])


def brute(rows, least, best):
    out = []
    counts = {}
    for text, lang in rows:
        counts.setdefault("und" if lang is None else lang, Counter()).update(grams(text))
    for lang, f in counts.items():
        many = {p: a for p, a in f.items() if len(p) > 1 and a >= least}
        inside = Counter()
        for p, a in many.items():
            for m in range(2, len(p)):
                for i in range(len(p) - m + 1):
                    inside[p[i : i + m]] = max(inside[p[i : i + m]], a)
        rated = []
        for p, a in many.items():
            if 100 * inside[p] >= 80 * a:
                continue
            score, k = min((2_000_000 * a // (f[p[:k]] + f[p[k:]]), k) for k in range(1, len(p)))
            rated.append((-score, -a, " ".join(p).encode(), f[p[:k]], f[p[k:]]))
        n = sum(c for p, c in f.items() if len(p) == 1)
        out += [(lang, i + 1, p.decode(), -a, l, r, n, -s) for i, (s, a, p, l, r) in enumerate(sorted(rated)[:best])]
    return sorted(out)


def found(df):
    return sorted(tuple(r) for r in df.select(*COLUMNS).collect())


def corpus(n, seed=5):
    """Texts in which two words follow each other in a third of all places, and some rows repeat."""
    rng = random.Random(seed)
    words = ["Hot", "pair", *(f"w{i}" for i in range(12)), "é", "日本", "a b"]
    out = []
    for _ in range(n):
        text = []
        while len(text) < rng.randrange(3, 60):
            text += ["hot", "Pair"] if rng.random() < 0.3 else [rng.choice(words) + rng.choice(["", "", "", ".", ",", "\n", "\t"])]
        out.append((rng.choice([" ", "  ", "\t"]).join(text), rng.choice(["en", "fr", None])))
    return out + out[:5] * 3


ODD = [(None, "en"), ("", "en"), (" \t\n", "en"), ("...!?", None), ("One", "en"), ("long tail " * 30_000, "de"), ("x y x y x y", "und")]


def frame(spark, rows):
    return spark.createDataFrame([(i, t, g, "p", 1, 2) for i, (t, g) in enumerate(rows)], SCHEMA)


@pytest.mark.parametrize("shard, size", [(12_000_000, 8_000_000), (500, 1_000), (50, 300)])
def test_equals_plain_counting(spark, monkeypatch, shard, size):
    """Small shards and ranges cut the hot pair's n-grams over many tasks."""
    rows = corpus(300) + ODD
    monkeypatch.setattr(phrases.shards, "__defaults__", (shard,))
    monkeypatch.setattr(phrases.range_starts, "__defaults__", (size,))
    docs = frame(spark, rows).repartition(3)
    got = found(phrases.collocations(docs, least=3, best=40))
    want = brute(rows, 3, 40)
    assert len(want) > 80 and got == want


def test_equals_sql(spark):
    con = database("/root/testdata/sf0.001")
    assert differences(phrases.op13_phrases(spark, "/root/testdata/sf0.001"), con, phrases.OP13_SQL) == []


def test_no_rows(spark):
    for rows in ([], ODD[:5]):
        out = phrases.collocations(frame(spark, rows) if rows else frame(spark, ODD).where("false"))
        assert out.columns == COLUMNS and out.count() == 0


def test_automata():
    texts = [t or "" for t, _ in corpus(40) + ODD[:5]]
    one = Automaton.counted("\n".join(texts).encode())
    parts = [Automaton.counted(t.encode()) for t in texts]
    for other in (Automaton.union(parts), Automaton.unpack(one.pack())):
        assert other.words == one.words and (other.arcs == one.arcs).all() and (other.weights == one.weights).all()
    want = Counter(g for t in texts for g in grams(t))
    assert {tuple(p.decode().split(" ")): f for p, _, f in one.pushed(1)} == dict(want)
    at = one.first_not_below([b"hot", b"pair", b"hot"])
    left, right = one.part(0, at), one.part(at, len(one.arcs))
    both = Automaton.union([right, left, Automaton.unpack(Automaton.union([]).pack())])
    assert (both.arcs == one.arcs).all() and both.words == one.words
    query = phrases.of_phrases([b"hot pair", b"pair", b"no such", b"w1 zz"], [1] * 4)
    held = phrases.of_phrases([" ".join(g).encode() for g in want], list(want.values()))
    names = [b" ".join(query.words[j - 1] for j in p if j) for p in query.arcs]
    assert dict(zip(names, held.compose(query).tolist())) == {
        b"hot pair": want["hot", "pair"], b"pair": want["pair",], b"no such": 0, b"w1 zz": 0}


class Rows:
    """Stands for a DataFrame: hands back the function of the tasks."""

    def mapInArrow(self, each, schema):
        return each


def test_many_ranges_cost_one_look(monkeypatch):
    """Where a shard is cut at hundreds of ranges, its rows are read once and not once a range."""
    text = "\n".join(t or "" for t, _ in corpus(300))
    whole = Automaton.counted(text.encode())
    rows = whole.arcs[::2]
    paths = [[whole.words[j - 1] for j in p if j] for p in rows] + [[b"no such"], [b"hot", b"zz"], [b"~~"]]
    starts = sorted((b"en", p) for p in paths)
    seen, keys = [], phrases._keys
    monkeypatch.setattr(phrases, "_keys", lambda arcs: seen.append(len(arcs)) or keys(arcs))
    cut_up = phrases.shards(Rows(), starts)
    (out,) = cut_up([pa.RecordBatch.from_pydict({"lang": ["en"], "text": [text.encode()]})])
    assert len(starts) > 300 and sum(seen) <= 2 * (len(whole.arcs) + len(starts))
    parts = {r["range"]: Automaton.unpack(r["automaton"]) for r in out.to_pylist()}
    for at, part in parts.items():
        for p in part.arcs:
            path = [part.words[j - 1] for j in p if j]
            assert at == sum(s <= path for _, s in starts)
    both = Automaton.union(list(parts.values()))
    assert both.words == whole.words and (both.arcs == whole.arcs).all() and (both.weights == whole.weights).all()
