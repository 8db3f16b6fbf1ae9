"""Language identification by a string kernel: blended spectrum, Nyström landmarks, kernel ridge regression."""

from __future__ import annotations

import re
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sootledger.llm.shared import bounded_sample, column_named, documents, held_out, packed, unpacked

LONGEST = 4  # n-grams of one to four bytes
BITS = 14
WINDOW = 1024
PAD = b" " * (LONGEST - 1)
_LETTER = re.compile(r"[^\W\d_]")
_FOLD = bytes(c if c >= 0x80 or chr(c).isalpha() else 0x20 for c in range(256))


def folded(text: str) -> bytes:
    """Lower case; ASCII characters that are no letters become spaces."""
    return PAD + text.lower().encode().translate(_FOLD) + PAD


def presence(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Which hashed n-grams each window of the folded texts has; each window's text; its bytes.

    Windows hold WINDOW bytes of one text. The spaces around each text keep n-grams inside it.
    """
    sizes = np.array([len(t) for t in texts], dtype=np.int64)
    data = np.frombuffer(b"".join(texts) + PAD, dtype=np.uint8).astype(np.uint32)
    starts = np.cumsum(sizes) - sizes
    per_text = -(-sizes // WINDOW)
    first = np.cumsum(per_text) - per_text
    inside = np.arange(sizes.sum()) - np.repeat(starts, sizes)
    window = np.repeat(first, sizes) + inside // WINDOW
    has = np.zeros((int(per_text.sum()), 1 << BITS), dtype=np.uint8)
    flat, base = has.ravel(), window << BITS
    code = np.zeros(len(window), dtype=np.uint32)
    for n in range(LONGEST):
        code = code | (data[n : n + len(code)] << np.uint32(8 * n))
        place = (code * np.uint32(2654435761) + np.uint32((n + 1) * 0x9E3779B9 & 0xFFFFFFFF)) >> np.uint32(32 - BITS)
        flat[base + place] = 1
    owner = np.repeat(np.arange(len(texts)), per_text)
    return has, owner, np.bincount(window, minlength=len(has))


def _normal(has: np.ndarray) -> np.ndarray:
    has = has.astype(np.float32)
    return has / np.sqrt(np.maximum(has.sum(axis=1, keepdims=True), 1))


def runs(texts: list, size: int = 300_000):
    """Positions of the texts in runs of about `size` characters; a short text counts as a whole window."""
    run, held = [], 0
    for i, t in enumerate(texts):
        run.append(i)
        held += max(len(t), WINDOW)
        if held >= size:
            yield run
            run, held = [], 0
    if run:
        yield run


@dataclass
class Model:
    """One column of weights per language. A text's score is the mean of its windows' kernel
    expansions; the expansion over the landmarks is folded into weights of hashed n-grams, which
    gives the same values by one matrix product per batch of windows."""

    languages: list[str]
    weights: np.ndarray
    bias: np.ndarray

    def scores(self, texts: list[str]) -> np.ndarray:
        out = np.zeros((len(texts), len(self.languages)))
        parts = [folded(t) for t in texts]
        for run in runs(parts):
            has, owner, size = presence([parts[i] for i in run])
            raw = has.astype(np.float32) @ self.weights
            raw /= np.sqrt(np.maximum(has.sum(axis=1, dtype=np.float32), 1))[:, None]
            for c in range(raw.shape[1]):
                out[run, c] = np.bincount(owner, raw[:, c] * size, len(run)) / np.bincount(owner, size, len(run))
        return out + self.bias

    def predict(self, texts: list[str | None]) -> tuple[list[str], np.ndarray]:
        """The language of each text and a score from 0 to 1; 'und' where there is no letter."""
        if not self.languages:
            return ["und"] * len(texts), np.zeros(len(texts))
        known = [i for i, t in enumerate(texts) if t is not None and _LETTER.search(t)]
        names, score = ["und"] * len(texts), np.zeros(len(texts))
        if known:
            margin = self.scores([texts[i] for i in known])
            odds = np.exp((margin - margin.max(axis=1, keepdims=True)) / 0.15)
            share = odds.max(axis=1) / odds.sum(axis=1)
            for i, best, p in zip(known, margin.argmax(axis=1), share):
                names[i], score[i] = self.languages[best], p
        return names, score


def train(texts: list[str], labels: list[str], landmarks: int = 320, ridge: float = 1e-2, seed: int = 3) -> Model:
    """Kernel ridge regression, one language against the rest, on windows of the given texts."""
    languages = sorted(set(labels))
    if not languages:
        return Model([], np.zeros((1 << BITS, 0), np.float32), np.zeros(0))
    found, target = [], []
    parts = [folded(t) for t in texts]
    for run in runs(parts):
        has, owner, _ = presence([parts[i] for i in run])
        found.append(has)
        target += [languages.index(labels[run[o]]) for o in owner]
    has, target = np.concatenate(found), np.array(target)
    pick = np.random.default_rng(seed).permutation(len(has))
    chosen = np.concatenate([[i for i in pick if target[i] == c][: -(-landmarks // len(languages))] for c in range(len(languages))])
    marks = _normal(has[chosen.astype(np.int64)])
    values, vectors = np.linalg.eigh((marks @ marks.T).astype(np.float64))
    strong = values > 1e-6 * values.max()
    root = vectors[:, strong] / np.sqrt(values[strong])
    mapped = np.concatenate([_normal(has[i : i + 512]) @ marks.T for i in range(0, len(has), 512)]) @ root
    wanted = np.eye(len(languages))[target]
    mean, level = mapped.mean(axis=0), wanted.mean(axis=0)
    centred = mapped - mean
    gram = centred.T @ centred + ridge * len(has) * np.eye(centred.shape[1]) / 10
    solved = np.linalg.solve(gram, centred.T @ (wanted - level))
    return Model(languages, (marks.T @ (root @ solved)).astype(np.float32), level - mean @ solved)


def fit(docs: DataFrame, per_language: int = 300, most_bytes: int = 2_000_000) -> Model:
    """Learn from at most `per_language` documents of each language, of at most `most_bytes` bytes together.

    Of the chosen ones shorter ones come first; a language of long texts only is learned from its shortest.
    Rows with NULL text or language, and held-out rows, are never looked at.
    """
    rows = docs.where(F.col("text").isNotNull() & F.col("lang").isNotNull() & ~held_out(F.col("doc_id")))
    sample = bounded_sample(rows.select("doc_id", "lang", "text"), "lang", "doc_id", per_language, "text", most_bytes)
    return train([r["text"] for r in sample], [r["lang"] for r in sample])


def identify(docs: DataFrame, model: Model, text: str = "text") -> DataFrame:
    """Add lang_pred and score, in place of columns of these names; all others stay, whatever their names.

    NULL texts and texts without any letter are 'und' with score 0.
    """

    @F.arrow_udf("lang_pred string, score double")
    def predict(column: pa.Array) -> pa.Array:
        names, score = model.predict(column.to_pylist())
        return pa.StructArray.from_arrays([pa.array(names, pa.string()), pa.array(score, pa.float64())], ["lang_pred", "score"])

    columns = docs.drop("lang_pred", "score").columns
    return docs.select(packed(columns).alias("_row"), predict(column_named(text)).alias("_found")).select(
        *unpacked(columns), "_found.lang_pred", "_found.score"
    )


def accepted(docs: DataFrame, model: Model, least: float = 0.5, long: int = 200) -> DataFrame:
    """The documents whose language is recognised, all columns as they were.

    A score counts by how far it is from an even share to one: `least` is asked of texts of `long` characters
    or more, and so of those that are as much in one language as in another. Shorter texts show too few n-grams
    for that and need only a letter. With one learned language nothing else can go.
    """
    even = 1 / max(len(model.languages), 1)
    columns = docs.columns
    prepared = docs.select(F.col("text").alias("_text"), packed(columns).alias("_doc"))
    judged = identify(prepared, model, "_text")
    sure = (F.char_length("_text") < long) | (F.col("score") >= even + least * (1 - even))
    return judged.where((F.col("lang_pred") != "und") & sure).select(*unpacked(columns, "_doc"))


def op7_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir)
    found = identify(docs.select("doc_id", "text"), fit(docs))
    return found.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "lang_pred", "score")
