"""Phrase collocations: weighted acyclic automata of n-grams, united by prefix range and composed for parts."""

from __future__ import annotations

from bisect import bisect_left
from dataclasses import dataclass
from functools import cached_property

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from sootledger.llm.shared import documents, unit_hash, written

MOST_WORDS = 4
LEAST_COUNT = 30
CONTAINED = 80  # per cent of a phrase's occurrences that lie within a longer one
BEST = 2000
UNIT = 2_000_000
SHARD = 8_000_000  # bytes of text that one automaton counts
RANGE = 5_000_000  # bytes of text for each range of the union
DRAWN, STRIDE = 16_000, 32  # bytes of text drawn for each range, and every how many words one is taken

# A-Z are lower-cased, these end a piece, tabs count as spaces.
_ENDS = b".,;:!?\x0a\x0b\x0c\x0d"
_TABLE = bytes(
    0x0A if b in _ENDS else 0x20 if b == 0x09 else b + 32 if 0x41 <= b <= 0x5A else b for b in range(256)
)
_CODEC = "zstd"


def _keys(arcs: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Two numbers of 64 bits that order rows of four labels."""
    a = arcs.astype(np.uint64)
    return a[:, 0] << np.uint64(32) | a[:, 1], a[:, 2] << np.uint64(32) | a[:, 3]


def _spaced(words: pa.LargeBinaryArray) -> bytes:
    """Words with a space between them, as one string of bytes."""
    held = pa.LargeListArray.from_arrays(pa.array([0, len(words)], pa.int64()), words)
    return pc.binary_join(held, pa.scalar(b" ", pa.large_binary()))[0].as_py()


def _apart(raw: bytes, n: int) -> pa.LargeBinaryArray:
    """The n words of such a string."""
    letters = np.frombuffer(raw, dtype=np.uint8)
    space = letters == 0x20
    inner = np.flatnonzero(space)
    offsets = np.concatenate([[0], inner - np.arange(len(inner)), [len(raw) - len(inner)]])[: n + 1].astype(np.int64)
    return pa.Array.from_buffers(pa.large_binary(), n, [None, pa.py_buffer(offsets), pa.py_buffer(letters[~space])])


@dataclass
class Automaton:
    """A deterministic acyclic automaton whose accepted paths, n-grams of up to four words, carry weights.

    `names` are the words behind the labels, in byte order (`words` has them as a list); a row of `arcs` is one accepted path as labels from 1 on, filled up
    with 0; rows are sorted and distinct. States are the prefixes of rows: written down (`pack`), each row adds
    only the arcs behind the state that it shares with the row before it, as in incremental construction.
    """

    names: pa.LargeBinaryArray
    arcs: np.ndarray
    weights: np.ndarray

    @cached_property
    def words(self) -> list[bytes]:
        return self.names.to_pylist()

    @classmethod
    def of(cls, words: pa.Array, labels: np.ndarray, weights: np.ndarray | None = None) -> Automaton:
        """From paths in any order: equal ones become one, whose weight is their sum. `words` are distinct, in any order."""
        order = pc.sort_indices(words).to_numpy()
        rank = np.zeros(len(order) + 1, dtype=np.int32)
        rank[order + 1] = np.arange(1, len(order) + 1)
        labels = rank[labels]
        bits = len(order).bit_length()
        if MOST_WORDS * bits <= 64:
            key = np.zeros(len(labels), dtype=np.uint64)
            for c in range(MOST_WORDS):
                key = key << np.uint64(bits) | labels[:, c].astype(np.uint64)
            by = np.argsort(key, kind="stable")
            del key
        else:
            high, low = _keys(labels)
            by = np.lexsort((low, high))
            del high, low
        new = np.zeros(len(by), dtype=bool)
        new[:1] = True
        for c in range(MOST_WORDS):
            column = labels[by, c]
            new[1:] |= column[1:] != column[:-1]
        starts = np.flatnonzero(new)
        if weights is None:
            sums = np.diff(np.append(starts, len(by)))
        else:
            sums = np.add.reduceat(weights[by], starts) if len(starts) else np.zeros(0, dtype=np.int64)
        return cls(words.take(pa.array(order)), labels[by[starts]], sums.astype(np.int64))

    @classmethod
    def counted(cls, text: bytes) -> Automaton:
        """Every word of a text with up to three words behind it in the same piece, and how often."""
        raw = np.frombuffer(text.translate(_TABLE), dtype=np.uint8)
        end = raw == 0x0A
        apart = end | (raw == 0x20)
        before = np.concatenate([[True], apart[:-1]])
        starts = np.flatnonzero(~apart & before)
        stops = np.flatnonzero(apart & ~before) if len(raw) else starts
        stops = stops if len(stops) == len(starts) else np.append(stops, len(raw))
        offsets = np.concatenate([[0], np.cumsum(stops - starts)]).astype(np.int64)
        found = pa.Array.from_buffers(
            pa.large_binary(), len(starts), [None, pa.py_buffer(offsets), pa.py_buffer(raw[~apart].tobytes())]
        ).dictionary_encode()
        piece = np.cumsum(end, dtype=np.int32)[starts] if len(starts) else starts
        labels = np.zeros((len(starts), MOST_WORDS), dtype=np.int32)
        own = found.indices.to_numpy() + np.int32(1)
        for k in range(min(MOST_WORDS, len(own))):
            labels[: len(own) - k, k] = np.where(piece[: len(own) - k] == piece[k:], own[k:], 0)
        return cls.of(found.dictionary, labels)

    def first_not_below(self, path: list[bytes]) -> int:
        """Number of rows that are smaller than a path."""
        return self.places([path])[0]

    def places(self, paths: list[list[bytes]]) -> list[int]:
        """The same for many paths, with one look at the rows."""
        labels = np.zeros((len(paths), MOST_WORDS), dtype=np.int64)
        for i, path in enumerate(paths):
            for k, word in enumerate(path):
                at = bisect_left(self.words, word)
                labels[i, k] = at + 1
                if at == len(self.words) or self.words[at] != word:
                    break
        (high, low), (keys, lows) = _keys(labels), _keys(self.arcs)
        begin, end = np.searchsorted(keys, high, "left"), np.searchsorted(keys, high, "right")
        return [int(a + np.searchsorted(lows[a:b], want, "left")) for a, b, want in zip(begin, end, low)]

    def part(self, begin: int, end: int) -> Automaton:
        arcs = self.arcs[begin:end]
        seen = np.zeros(len(self.names) + 1, dtype=bool)
        seen[arcs] = True
        seen[0] = False
        used = np.flatnonzero(seen)
        own = np.zeros(len(seen), dtype=np.int32)
        own[used] = np.arange(1, len(used) + 1)
        return Automaton(self.names.take(pa.array(used - 1)), own[arcs], self.weights[begin:end])

    def pack(self) -> bytes:
        shared = np.zeros(len(self.arcs), dtype=np.int64)
        same = np.ones(max(len(self.arcs) - 1, 0), dtype=bool)
        for k in range(MOST_WORDS):
            same &= (self.arcs[1:, k] == self.arcs[:-1, k]) & (self.arcs[1:, k] > 0)
            shared[1:] += same
        depth = (self.arcs > 0).sum(axis=1)
        column = np.arange(MOST_WORDS)
        added = self.arcs[(column >= shared[:, None]) & (column < depth[:, None])]
        parts = [
            _spaced(self.names), (shared * (MOST_WORDS + 1) + depth).astype(np.uint8).tobytes(),
            added.astype("<u4").tobytes(), self.weights.astype("<i8").tobytes(),
        ]
        sizes = np.array([len(self.names), *map(len, parts)], dtype="<i8").tobytes()
        raw = sizes + b"".join(parts)
        return len(raw).to_bytes(8, "little") + pa.compress(raw, codec=_CODEC, asbytes=True)

    @classmethod
    def unpack(cls, blob: bytes) -> Automaton:
        raw = pa.decompress(blob[8:], int.from_bytes(blob[:8], "little"), codec=_CODEC, asbytes=True)
        n, *sizes = np.frombuffer(raw[:40], dtype="<i8").tolist()
        ends = np.cumsum([40, *sizes]).tolist()
        words, shape, added, weights = (raw[a:b] for a, b in zip(ends, ends[1:]))
        shared, depth = np.divmod(np.frombuffer(shape, dtype=np.uint8).astype(np.int64), MOST_WORDS + 1)
        column = np.arange(MOST_WORDS)
        fresh = (column >= shared[:, None]) & (column < depth[:, None])
        arcs = np.zeros(fresh.shape, dtype=np.int32)
        arcs[fresh] = np.frombuffer(added, dtype="<u4")
        for k in range(MOST_WORDS):  # a label that is not written is that of the last row that writes one
            last = np.maximum.accumulate(np.where(fresh[:, k], np.arange(len(arcs)), 0))
            arcs[:, k] = np.where(column[k] < depth, arcs[last, k], 0)
        return cls(_apart(words, n), arcs, np.frombuffer(weights, dtype="<i8").astype(np.int64))

    @classmethod
    def union(cls, parts: list[Automaton]) -> Automaton:
        """All paths of some automata; the weights of equal paths are summed."""
        none = pa.array([], pa.large_binary())
        every = pa.concat_arrays([none, *(p.names for p in parts)]).dictionary_encode()
        place = every.indices.to_numpy() + np.int32(1)
        labels, at = [], 0
        for p in parts:
            own = np.zeros(len(p.names) + 1, dtype=np.int32)
            own[1:] = place[at : at + len(p.names)]
            labels.append(own[p.arcs])
            at += len(p.names)
        empty = np.zeros((0, MOST_WORDS), dtype=np.int32)
        weights = np.concatenate([np.zeros(0, dtype=np.int64), *(p.weights for p in parts)])
        return cls.of(every.dictionary, np.concatenate([empty, *labels]), weights)

    def pushed(self, least: int) -> list[tuple[bytes, int, int]]:
        """Prefixes (phrase, words, weight) with the weights of all paths through them, from `least` on.

        The first and the last row's prefixes are there whatever their weight: other ranges may hold the rest.
        """
        out, rows = [], len(self.arcs)
        new = np.zeros(rows, dtype=bool)
        new[:1] = True
        for k in range(MOST_WORDS if rows else 0):
            new[1:] |= self.arcs[1:, k] != self.arcs[:-1, k]
            starts = np.flatnonzero(new)
            sums = np.add.reduceat(self.weights, starts)
            there = self.arcs[starts, k] > 0
            edge = np.zeros(len(starts), dtype=bool)
            edge[[0, -1]] = True
            for i in np.flatnonzero(there & ((sums >= least) | edge)):
                path = self.arcs[starts[i], : k + 1]
                out.append((b" ".join(self.words[j - 1] for j in path), k + 1, int(sums[i])))
        return out

    def compose(self, asked: Automaton) -> np.ndarray:
        """Weights of the paths of another automaton in this one, 0 where it has none."""
        at = np.array([bisect_left(self.words, w) for w in asked.words], dtype=np.int64)
        known = np.array([i < len(self.words) and self.words[i] == w for i, w in zip(at, asked.words)], dtype=bool)
        own = np.concatenate([[0], np.where(known, at + 1, -1)])[asked.arcs]
        out = np.zeros(len(own), dtype=np.int64)
        whole = np.flatnonzero((own >= 0).all(axis=1))
        (high, low), (keys, lows) = _keys(own[whole]), _keys(self.arcs)
        begin, end = np.searchsorted(keys, high, "left"), np.searchsorted(keys, high, "right")
        for i, a, b, want in zip(whole, begin, end, low):
            j = a + np.searchsorted(lows[a:b], want)
            if j < b and lows[j] == want:
                out[i] = self.weights[j]
        return out


def of_phrases(phrases: list[bytes], weights: list[int]) -> Automaton:
    words = [p.split(b" ") for p in phrases]
    every = pa.array([w for p in words for w in p], pa.large_binary()).dictionary_encode()
    labels = np.zeros((len(words), MOST_WORDS), dtype=np.int32)
    labels[np.arange(MOST_WORDS) < np.array([len(p) for p in words])[:, None]] = every.indices.to_numpy() + 1
    return Automaton.of(every.dictionary, labels, np.array(weights, dtype=np.int64))


def _by_language(docs: DataFrame, text: str, lang: str) -> DataFrame:
    return docs.select(
        F.coalesce(F.col(lang).cast("string"), F.lit("und")).alias("lang"),
        F.coalesce(F.col(text), F.lit("")).cast("binary").alias("text"),
    )


def range_starts(rows: DataFrame, size: int = RANGE) -> list[tuple[bytes, list[bytes]]]:
    """Where the ranges of sorted (language, n-gram) begin, about one for each `size` bytes of text.

    They follow n-grams of texts drawn by hash. They only say which task adds up what: results do not depend on
    them. The driver gets some 80 n-grams for each range.
    """
    total = rows.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    ranges = -(-total // size)
    if ranges < 2:
        return []
    share = min(1.0, ranges * DRAWN / total)

    def draw(batches):
        for batch in batches:
            out = []
            for lang, text in zip(batch.column("lang"), batch.column("text")):
                found = Automaton.counted(text.as_py())
                step = found.arcs[:: STRIDE]
                out += [(lang.as_py(), b" ".join(found.words[j - 1] for j in p if j)) for p in step]
            yield pa.RecordBatch.from_arrays(
                [pa.array([o[0] for o in out], pa.string()), pa.array([o[1] for o in out], pa.binary())], names=["lang", "path"]
            )

    drawn = rows.where(unit_hash("lang", "text") < share).mapInArrow(draw, "lang string, path binary").collect()
    paths = sorted({(r["lang"].encode(), tuple(bytes(r["path"]).split(b" "))) for r in drawn})
    picked = {paths[i * len(paths) // ranges] for i in range(1, ranges)} if paths else set()
    return [(lang, list(path)) for lang, path in sorted(picked)]


def shards(rows: DataFrame, starts: list[tuple[bytes, list[bytes]]], size: int = SHARD) -> DataFrame:
    """Automata of about `size` bytes of text each, cut at the ranges: rows (range, lang, automaton)."""
    languages = [lang for lang, _ in starts]

    def cut_up(lang: str, texts: list[bytes]):
        found = Automaton.counted(b"\n".join(texts))
        first, last = bisect_left(languages, lang.encode()), bisect_left(languages, lang.encode() + b"\0")
        at = [0, *found.places([path for _, path in starts[first:last]]), len(found.arcs)]
        out = [(first + i, found.part(a, b).pack()) for i, (a, b) in enumerate(zip(at, at[1:])) if b > a]
        return pa.RecordBatch.from_arrays(
            [pa.array([o[0] for o in out], pa.int64()), pa.array([lang] * len(out), pa.string()), pa.array([o[1] for o in out], pa.binary())],
            names=["range", "lang", "automaton"],
        )

    def count(batches):
        held: dict[str, tuple[list[bytes], int]] = {}
        for batch in batches:
            for lang, text in zip(batch.column("lang"), batch.column("text")):
                lang, text = lang.as_py(), text.as_py()
                texts, n = held.get(lang, ([], 0))
                texts.append(text)
                held[lang] = texts, n + len(text)
                if n + len(text) >= size:
                    del held[lang]
                    yield cut_up(lang, texts)
            while sum(n for _, n in held.values()) > 2 * size:  # many languages: the fullest one goes
                lang = max(held, key=lambda k: held[k][1])
                yield cut_up(lang, held.pop(lang)[0])
        for lang, (texts, _) in held.items():
            yield cut_up(lang, texts)

    return rows.mapInArrow(count, "range long, lang string, automaton binary")


def counts(docs: DataFrame, least: int = LEAST_COUNT, text: str = "text", lang: str = "lang") -> DataFrame:
    """Phrases of one to four words with at least `least` occurrences: (lang, phrase, size, f).

    A row of size 0 and no phrase for each language holds the number of all its words. Tasks count shards of
    text; the automata of a prefix range are united in one task, which keeps what is frequent. A phrase whose
    rows lie in two ranges comes from both and is added up.
    """
    rows = _by_language(docs, text, lang)
    parts = shards(rows, range_starts(rows))

    def unite(key, table):
        whole = Automaton.union([Automaton.unpack(b.as_py()) for b in table.column("automaton")])
        out = [(None, 0, int(whole.weights.sum())), *whole.pushed(least)]
        return pa.table(
            {
                "lang": pa.array([key[1].as_py()] * len(out), pa.string()),
                "phrase": pa.array([o[0] for o in out], pa.binary()).cast(pa.string()),
                "size": pa.array([o[1] for o in out], pa.int64()),
                "f": pa.array([o[2] for o in out], pa.int64()),
            }
        )

    found = parts.groupBy("range", "lang").applyInArrow(unite, "lang string, phrase string, size long, f long")
    whole = found.groupBy("lang", "phrase", "size").agg(F.sum("f").alias("f"))
    return whole.where((F.col("f") >= least) | (F.col("size") == 0))


def lookups(asked: DataFrame, known: DataFrame, slots: int) -> DataFrame:
    """f of distinct (lang, part) among known (lang, phrase, f), by composing their automata slot by slot."""

    def slot(name: str) -> Column:
        return F.pmod(F.xxhash64("lang", name), F.lit(slots)).alias("slot")

    def compose(left, right):
        out = {"lang": [], "part": [], "f": []}
        for lang in pc.unique(left.column("lang")).to_pylist():
            own = left.filter(pc.equal(left.column("lang"), lang)).column("part").cast(pa.binary()).to_pylist()
            side = right.filter(pc.equal(right.column("lang"), lang))
            held = of_phrases(side.column("phrase").cast(pa.binary()).to_pylist(), side.column("f").to_pylist())
            query = of_phrases(own, [1] * len(own))
            out["lang"] += [lang] * len(query.arcs)
            out["part"] += [b" ".join(query.words[j - 1] for j in p if j) for p in query.arcs]
            out["f"] += held.compose(query).tolist()
        return pa.table(
            {"lang": pa.array(out["lang"], pa.string()), "part": pa.array(out["part"], pa.binary()).cast(pa.string()), "f": pa.array(out["f"], pa.int64())}
        )

    asked = asked.select("lang", "part", slot("part"))
    known = known.select("lang", "phrase", "f", slot("phrase"))
    return asked.groupBy("slot").cogroup(known.groupBy("slot")).applyInArrow(compose, "lang string, part string, f long")


def _words(first: Column | int, n: Column | int) -> Column:
    return F.array_join(F.slice("_words", first, n), " ")


def collocations(
    docs: DataFrame, least: int = LEAST_COUNT, best: int = BEST, text: str = "text", lang: str = "lang"
) -> DataFrame:
    """The best phrases of each language: lang, rank, phrase, a, l, r, n, score.

    A phrase of two to four words is as good as its weakest cut: score is 2,000,000 a / (l + r), rounded down, with
    its own count and those of both parts, of the cut with the lowest score (the first of equal ones). Phrases inside a
    longer one with 80 per cent of their occurrences are left out. NULL texts are empty, NULL languages `und`;
    repeated rows count again; other columns are ignored. A language without a frequent phrase has no row.
    """
    found = written(counts(docs, least, text, lang), "phrases")
    many = found.where("size >= 2").select("lang", "phrase", F.col("f").alias("a"), F.split("phrase", " ").alias("_words"))
    cuts = many.select(
        "lang", "phrase", "a", "_words", F.explode(F.sequence(F.lit(1), F.size("_words") - 1)).alias("k")
    ).select(
        "lang", "phrase", "a", "k",
        F.explode(F.array(
            F.struct(F.lit("l").alias("side"), _words(1, F.col("k")).alias("part")),
            F.struct(F.lit("r").alias("side"), _words(F.col("k") + 1, F.size("_words")).alias("part")),
        )).alias("p"),
    ).select("lang", "phrase", "a", "k", "p.side", "p.part")
    known = found.where("size between 1 and 3")
    slots = known.count() // 100_000 + 1
    weights = lookups(cuts.select("lang", "part").distinct(), known, slots)

    def part(k: int, side: str) -> Column:
        return F.max(F.when((F.col("k") == k) & (F.col("side") == side), F.col("f")))

    sums = cuts.join(weights, ["lang", "part"]).groupBy("lang", "phrase", "a").agg(
        *(part(k, side).alias(f"{side}{k}") for k in range(1, MOST_WORDS) for side in "lr")
    )

    def scored(k: int) -> Column:
        score = F.expr(f"cast({UNIT} as decimal(20, 0)) * cast(a as decimal(18, 0)) div (l{k} + r{k})")
        return F.when(
            F.col(f"l{k}").isNotNull(),
            F.struct(score.alias("score"), F.lit(k).alias("k"), F.col(f"l{k}").alias("l"), F.col(f"r{k}").alias("r")),
        )

    rated = sums.select("lang", "phrase", "a", F.least(*(scored(k) for k in range(1, MOST_WORDS))).alias("cut"))
    inner = many.where(F.size("_words") > 2).select(
        "lang", "a", "_words",
        F.explode(F.expr(
            "flatten(transform(sequence(2, size(_words) - 1), m -> transform(sequence(1, size(_words) - m + 1), i -> struct(i, m))))"
        )).alias("at"),
    ).select("lang", _words(F.col("at.i"), F.col("at.m")).alias("phrase"), "a")
    longer = inner.groupBy("lang", "phrase").agg(F.max("a").alias("_longer"))
    left = rated.join(longer, ["lang", "phrase"], "left").where(
        F.col("_longer").isNull() | (100 * F.col("_longer") < CONTAINED * F.col("a"))
    )
    order = Window.partitionBy("lang").orderBy(F.desc("cut.score"), F.desc("a"), "phrase")
    top = left.withColumn("rank", F.row_number().over(order).cast("long")).where(F.col("rank") <= best)
    words = found.where("size = 0").select("lang", F.col("f").alias("n"))
    return top.join(words, "lang").select("lang", "rank", "phrase", "a", "cut.l", "cut.r", "n", "cut.score")


def op13_phrases(spark: SparkSession, sf_dir: str) -> DataFrame:
    return collocations(documents(spark, sf_dir))


OP13_SQL = r"""
WITH pieces AS (
    SELECT coalesce(lang, 'und') AS lang, unnest(string_split_regex(
        translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
        '[.,;:!?\x0A-\x0D]')) AS piece
    FROM documents),
split AS (SELECT lang, regexp_extract_all(piece, '[^\x20\x09]+') AS ws FROM pieces),
starts AS (SELECT lang, ws, unnest(range(1, len(ws) + 1)) AS i FROM split),
grams AS (
    SELECT lang, ws[i:i + m - 1] AS p, count(*) AS f
    FROM starts, (VALUES (1), (2), (3), (4)) AS sizes(m) WHERE i + m - 1 <= len(ws) GROUP BY ALL),
totals AS (SELECT lang, count(*) AS n FROM starts GROUP BY lang),
candidates AS (SELECT lang, p, f AS a FROM grams WHERE len(p) >= 2 AND f >= 30),
cuts AS (SELECT lang, p, a, unnest(range(1, len(p))) AS k FROM candidates),
scores AS (
    SELECT c.lang, c.p, c.a, c.k, x.f AS l, y.f AS r,
        CAST((2000000::HUGEINT * c.a) // (x.f + y.f) AS BIGINT) AS score
    FROM cuts c JOIN grams x ON x.lang = c.lang AND x.p = c.p[1:c.k]
    JOIN grams y ON y.lang = c.lang AND y.p = c.p[c.k + 1:len(c.p)]),
lowest AS (
    SELECT * FROM scores QUALIFY row_number() OVER (PARTITION BY lang, p ORDER BY score, k) = 1),
inside AS (
    SELECT lang, p[i:i + m - 1] AS p, max(a) AS longer
    FROM (SELECT lang, p, a, m, unnest(range(1, len(p) - m + 2)) AS i
        FROM candidates, (VALUES (2), (3)) AS sizes(m) WHERE m < len(p)) GROUP BY ALL),
stay AS (
    SELECT s.* FROM lowest s LEFT JOIN inside i ON i.lang = s.lang AND i.p = s.p
    WHERE i.longer IS NULL OR 100 * i.longer < 80 * s.a),
ranked AS (
    SELECT lang, array_to_string(p, ' ') AS phrase, a, l, r, score, row_number() OVER (
        PARTITION BY lang ORDER BY score DESC, a DESC, array_to_string(p, ' ')) AS rank
    FROM stay)
SELECT lang, rank, phrase, a, l, r, n, score FROM ranked JOIN totals USING (lang) WHERE rank <= 2000
"""
