"""Token ids of whole texts, by the tokenizers library, with a bounded memory of words."""

from __future__ import annotations

import os
import re

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

# A cut before a space that a word follows never changes byte-level ids: the space
# belongs to that word's first piece, whatever stands before it.
_CUT = re.compile(r" (?=\S)")
_UNSAFE = re.compile(r" (?=\s|$)")
# A word of letters with marks behind, and perhaps another one on the next line. Apostrophes can begin
# endings that are pieces of their own and are left out.
_MARKS = r"[!-&(-/:-@\[-`{-~]*"
_PLAIN = re.compile(rf"([^\W\d_]+)({_MARKS})(?:\n([^\W\d_]+)({_MARKS}))?")


def byte_characters() -> dict[int, str]:
    """The character that stands for each byte in byte-level vocabularies: itself if it prints, else one from 256 on."""
    printing = {*range(33, 127), *range(161, 173), *range(174, 256)}
    others = iter(range(256, 512))
    return {b: chr(b if b in printing else next(others)) for b in range(256)}


class Encoder:
    """Encodes texts with a byte-level vocabulary file; strings of special tokens are ordinary text.

    Texts fall apart at spaces before words, and each distinct word of a batch is looked up once.
    The ids of words met before are remembered, up to `limit` words and those of one batch; then
    only the words of the next batch stay. New words with other characters than letters are
    encoded in one call.
    """

    def __init__(self, path: str, limit: int = 600_000):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self._tokenizer = Tokenizer.from_file(path)
        self._tokenizer.encode_special_tokens = True
        vocabulary = self._tokenizer.get_vocab()
        # In a byte-level vocabulary each character of a piece stands for one byte.
        self._bytes = np.zeros(max(vocabulary.values()) + 1, dtype=np.int64)
        for piece, i in vocabulary.items():
            self._bytes[i] = len(piece)
        self._model = self._tokenizer.model
        if hasattr(self._model, "_resize_cache"):
            self._model._resize_cache(0)  # the words are remembered here
        self._characters = byte_characters()
        self._raw = [int(i).to_bytes(4, "little") for i in range(len(self._bytes))]
        # Only where the vocabulary cuts letters, marks and line breaks apart do pieces go to the model one by one.
        example, space, line = " ab$.\nCd", self._characters[0x20], self._characters[0x0A]
        cutter = self._tokenizer.pre_tokenizer
        pieces = [p for p, _ in cutter.pre_tokenize_str(example)] if cutter else []
        self._by_piece = self._tokenizer.normalizer is None and pieces == [f"{space}ab", "$.", line, "Cd"]
        self._known: dict[str, bytes] = {}
        self._limit = limit

    def _ids(self, text: str) -> np.ndarray:
        encoded = self._tokenizer.encode_batch_fast([text], add_special_tokens=False)[0].ids
        return np.array(encoded, dtype="<u4")

    def _piece(self, key: str, letters: str, before: int | None = None) -> bytes:
        """Ids of one piece, remembered under its key: its letters, behind the byte before them if there is one."""
        ids = self._known.get(key)
        if ids is None:
            if not letters.isascii():
                letters = letters.encode().decode("latin-1").translate(self._characters)
            head = "" if before is None else self._characters[before]
            ids = b"".join([self._raw[t.id] for t in self._model.tokenize(head + letters)])
            self._known[key] = ids
        return ids

    def _learn(self, new: list[str]) -> dict[str, bytes]:
        """Ids of each word with a space before it.

        A word of letters only is one piece for the vocabulary's model, marks behind it another, and so are a
        line break and what follows it; all other words go through the whole tokenizer, in one call. No word
        begins with white space, so pieces without a space before them have keys that begin with it.
        """
        out, rest, piece = {}, [], self._piece
        for w in new:
            found = _PLAIN.fullmatch(w) if self._by_piece else None
            if found is None:
                rest.append(w)
                continue
            core, marks, second, last = found.groups()
            if not core.isalpha() or not (second is None or second.isalpha()):
                rest.append(w)
                continue
            ids = piece(core, core, 0x20)
            if marks:
                ids += piece("\t" + marks, marks)
            if second:
                ids += piece("\n", "", 0x0A) + piece("\n" + second, second)
                if last:
                    ids += piece("\t" + last, last)
            out[w] = ids
        return out | self._learn_any(rest)

    def _learn_any(self, new: list[str]) -> dict[str, bytes]:
        """Ids of each word with a space before it, for any word without a space before its first letter."""
        ids = self._ids("".join([f" {w}" for w in new]))
        ends = np.cumsum(self._bytes[ids])
        words = np.cumsum([len(w.encode()) + 1 for w in new])
        cuts = np.searchsorted(ends, words)
        if not np.array_equal(ends[cuts], words):
            raise ValueError("the vocabulary is not byte-level")
        raw, at, out = ids.tobytes(), 0, {}
        for word, end in zip(new, ((cuts + 1) * 4).tolist()):
            out[word], at = raw[at:end], end
        return out

    def _table(self, words: list[str]) -> pa.Array:
        """The ids of each of these distinct words; when too many are remembered, only these stay."""
        if len(self._known) > self._limit:
            self._known = {w: self._known[w] for w in words if w in self._known}
        known = self._known
        if new := [w for w in words if w not in known]:
            known.update(self._learn(new))
        return pa.array(list(map(known.__getitem__, words)), pa.large_binary())

    def _encode_split(self, parts: pa.Array) -> list[bytes]:
        """Ids of texts given as lists of parts: each part but the first has lost the space before it."""
        offsets = np.asarray(parts.offsets)
        values, rows = parts.values, len(parts)
        heads = self._tokenizer.encode_batch_fast(
            values.take(pa.array(offsets[:-1])).to_pylist(), add_special_tokens=False
        )
        behind = np.ones(len(values), dtype=bool)
        behind[offsets[:-1]] = False
        words = values.filter(pa.array(behind)).dictionary_encode()
        ids = self._table(words.dictionary.to_numpy(zero_copy_only=False).tolist()).take(words.indices)
        ends, data = np.frombuffer(ids.buffers()[1], "<i8", len(ids) + 1), memoryview(ids.buffers()[2] or b"")
        cuts = ends[offsets - np.arange(rows + 1)].tolist()
        return [
            np.array(h.ids, dtype="<u4").tobytes() + data[begin:end]
            for h, begin, end in zip(heads, cuts, cuts[1:])
        ]

    def encode(self, texts: list[str]) -> list[bytes]:
        """For each text its ids as little-endian unsigned 32-bit integers."""
        plain, odd = [], []
        for i, t in enumerate(texts):
            (odd if _UNSAFE.search(t) else plain).append(i)
        found = []
        if plain:
            found += self._encode_split(pc.split_pattern(pa.array([texts[i] for i in plain], pa.large_string()), " "))
        if odd:
            found += self._encode_split(pa.array([_CUT.split(texts[i]) for i in odd], pa.large_list(pa.large_string())))
        out: list[bytes] = [b""] * len(texts)
        for i, ids in zip(plain + odd, found):
            out[i] = ids
        return out


_encoders: dict[str, Encoder] = {}


def encoder(path: str) -> Encoder:
    """The encoder of this worker process: its words are remembered from task to task."""
    if path not in _encoders:
        _encoders[path] = Encoder(path)
    return _encoders[path]


def forget() -> None:
    """Give back what this worker process remembers: for jobs whose other stages need its memory."""
    _encoders.clear()
    pa.default_memory_pool().release_unused()


def encoded(texts: pa.Array, path: str, end_id: int, size: int = 2_000_000):
    """Yields (first row, list of ids with the end id) for runs of rows of about `size` characters."""
    coder, end = encoder(path), np.array([end_id], dtype="<u4").tobytes()
    run, first, held = [], 0, 0
    for i, text in enumerate(texts):
        run.append(text.as_py() or "")
        held += len(run[-1])
        if held >= size:
            yield first, [b + end for b in coder.encode(run)]
            run, first, held = [], i + 1, 0
    if run:
        yield first, [b + end for b in coder.encode(run)]
