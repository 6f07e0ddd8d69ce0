"""Exact BPE encoding in linear time, and decoding by an offset table.

An Aho-Corasick automaton of the tokens, read backwards in one pass over the
word, finds the longest token at every place. A backtracking search over that
table takes the longest one whose pair with the token before it
is compatible (byte-pair merging of both would leave them as they are), goes
on to shorter tokens where it is not, and back one token where none is left; a
place that failed once is never tried again, so the work is linear. The result
is exactly what merging in rank order gives.

The vocabulary file is read on the driver (its path is a parameter) and sent
to tasks as tables bounded by the vocabulary. There is no shuffle.
"""

from __future__ import annotations

import hashlib
import json
import re
import unicodedata
from array import array

import ahocorasick
import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from .common import slices, text_or_empty, utf8

#: Closes a word where the vocabulary has its end-of-word suffix.
END = "\0"
#: Entries of each of a worker's caches, which are emptied when full.
CACHE = 150_000
#: White space of the splitting pattern; str.split() also takes U+001C-U+001F.
SPACE = "\t-\r \x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000"
_CONTROL = re.compile("[\x1c-\x1f]")
#: Words that are letters of ASCII, and characters beyond Latin.
_PLAIN = re.compile("[A-Za-z]+")
_RARE = re.compile("[^\x00-\u024f]")


def byte_alphabet() -> list[str]:
    """The printable character that byte-level vocabularies write for each
    byte: itself where Latin-1 prints it, else the next one from U+0100 on."""
    plain = {*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)}
    spare = iter(range(0x100, 0x200))
    return [chr(b) if b in plain else chr(next(spare)) for b in range(256)]


def read_spec(path: str) -> dict:
    """What the encoder needs of a tokenizers JSON file."""
    with open(path, encoding="utf-8") as f:
        whole = json.load(f)
    model = whole["model"]
    merges = [tuple(m.split(" ")) if isinstance(m, str) else tuple(m) for m in model["merges"]]
    pattern = next(p["pattern"]["Regex"] for p in whole["pre_tokenizer"]["pretokenizers"] if p["type"] == "Split")
    return {"vocab": model["vocab"], "merges": merges, "suffix": model["end_of_word_suffix"] or "",
            "special": {t["content"]: t["id"] for t in whole["added_tokens"]},
            # normaliser and splitter alone, for characters newer than Python's tables
            "rules": json.dumps(whole | {"added_tokens": [], "model": {
                "type": "BPE", "vocab": {}, "merges": []}}),
            "pattern": pattern.replace(r"[^\s", f"[^{SPACE}")}


class Bpe:
    """Encoder and decoder of one vocabulary."""

    def __init__(self, spec: dict):
        vocab, suffix = spec["vocab"], spec["suffix"]
        self.suffix, self.special = suffix, spec["special"]
        self.split_special = (re.compile("(" + "|".join(re.escape(t) for t in sorted(self.special, key=len, reverse=True)) + ")")
                              if self.special else None)
        self.pattern = regex.compile(spec["pattern"])
        self.rules, self._newer = spec["rules"], None
        size = max([*vocab.values(), *self.special.values()]) + 1
        self.rank = [-1] * size
        self.parts: list[tuple[int, int]] = [(-1, -1)] * size
        self.pair: dict[tuple[int, int], int] = {}
        for rank, (a, b) in enumerate(spec["merges"]):
            left, right, whole = vocab[a], vocab[b], vocab[a + b]
            self.pair[left, right] = rank
            self.rank[whole], self.parts[whole] = rank, (left, right)
        self.key = [""] * size
        for token, i in vocab.items():
            self.key[i] = token[:-len(suffix)] + END if suffix and token.endswith(suffix) else token
        self.sizes = [len(k) for k in self.key]
        self._judged: dict[tuple[int, int], bool] = {}
        self._words: dict[str, bytes] = {}
        self._chunks: dict[str, bytes] = {}
        # usable: merging the token's own characters does end in the token
        usable = []
        good = [False] * size
        for i in sorted(vocab.values(), key=self.rank.__getitem__):
            a, b = self.parts[i]
            if self.rank[i] < 0 or good[a] and good[b] and self._apart(a, b, self.rank[i]):
                good[i] = True
                usable.append(i)
        self.id_of = {self.key[i]: i for i in usable}
        self.automaton = ahocorasick.Automaton()
        for i in usable:
            self.automaton.add_word(self.key[i][::-1], i)
        self.automaton.make_automaton()
        # the next shorter token that starts each token
        self.shorter = [-1] * size
        for i in usable:
            k = self.key[i]
            self.shorter[i] = next((self.id_of[k[:n]] for n in range(len(k) - 1, 0, -1) if k[:n] in self.id_of), -1)
        self.byte_map = {b: c for b, c in enumerate(byte_alphabet())}
        texts = [b""] * size
        for token, i in [*vocab.items(), *self.special.items()]:
            texts[i] = token.encode("utf-8") + b" "
        self.table = np.frombuffer(b"".join(texts), np.uint8)
        self.lengths = np.array([len(t) for t in texts], np.int64)
        self.starts = np.concatenate([[0], np.cumsum(self.lengths)[:-1]])

    def _apart(self, a: int, b: int, until: int) -> bool:
        """Whether no merge crosses the border of ``a`` and ``b`` before rank
        ``until``. Going back in time, the later built of the two tokens at
        the border comes apart; each pair stands until either is built into
        its successor. Of merges with equal rank the left one comes first."""
        over_a = over_b = until
        while True:
            rank = self.pair.get((a, b))
            if rank is not None and rank < over_a and (rank <= over_b if over_b != until else rank < over_b):
                return False
            ra, rb = self.rank[a], self.rank[b]
            if ra < 0 and rb < 0:
                return True
            if ra > rb:
                over_a, a = ra, self.parts[a][1]
            else:
                over_b, b = rb, self.parts[b][0]

    def compatible(self, a: int, b: int) -> bool:
        if len(self._judged) >= CACHE // 2:
            self._judged.clear()
        known = self._judged[a, b] = self._apart(a, b, 1 << 60)
        return known

    def word(self, key: str) -> list[int]:
        """Ids of one word, given in the byte alphabet with END."""
        whole = self.id_of.get(key)
        if whole is not None:
            return [whole]
        sizes, shorter, judged = self.sizes, self.shorter, self._judged
        # longest token from each place, by its distance to the end: failure
        # links give the longest match first, and a dict keeps the last
        found = list(self.automaton.iter(key[::-1]))
        found.reverse()
        longest = dict(found).get
        # places go by that distance too, and -1 is the end of the word
        left = len(key) - 1
        open_to = bytearray(b"\1") * (left + 2)
        out: list[int] = []
        last, token = -1, longest(left, -1)
        while True:
            while token >= 0:
                rest = left - sizes[token]
                if open_to[rest]:
                    if last < 0:
                        break
                    ok = judged.get((last, token))
                    if ok is None:
                        ok = self.compatible(last, token)
                    if ok:
                        break
                token = shorter[token]
            if token >= 0:
                out.append(token)
                if rest < 0:
                    return out
                left, last = rest, token
                token = longest(left, -1)
            else:
                open_to[left] = 0
                if not out:
                    raise ValueError(f"the vocabulary cannot spell {key!r}")
                token = out.pop()
                last = out[-1] if out else -1
                left += sizes[token]
                token = shorter[token]

    def chunk(self, chunk: str) -> bytes:
        """Packed ids of a text without white space: composed, lower-cased character
        by character (no final sigma), split, encoded word by word. Characters
        that this Python's Unicode tables lack are left to the tokenizers
        library's tables."""
        end = END if self.suffix else ""
        if _PLAIN.fullmatch(chunk):
            return self.known(chunk.lower() + end)
        out = b""
        if _RARE.search(chunk) and any(unicodedata.category(c) == "Cn" for c in chunk):
            if self._newer is None:
                self._newer = Tokenizer.from_str(self.rules)
            found = self._newer.pre_tokenizer.pre_tokenize_str(self._newer.normalizer.normalize_str(chunk))
            for w, _ in found:
                out += self.known(w + end)
            return out
        text = unicodedata.normalize("NFC", chunk).replace("Σ", "σ").lower()
        for w in self.pattern.findall(text):
            out += self.known((w if _PLAIN.fullmatch(w) else
                               w.encode("utf-8").decode("latin-1").translate(self.byte_map)) + end)
        return out

    def known(self, key: str) -> bytes:
        """``word`` as packed ids, behind a cache."""
        found = self._words.get(key)
        if found is None:
            found = array("I", self.word(key)).tobytes()
            if len(key) <= 64:
                if len(self._words) >= CACHE:
                    self._words.clear()
                self._words[key] = found
        return found

    def encode(self, text: str) -> np.ndarray:
        out: list[bytes] = []
        parts = self.split_special.split(text) if self.split_special and "<|" in text else (text,)
        known = self._chunks
        for part in parts:
            if part in self.special:
                out.append(array("I", [self.special[part]]).tobytes())
                continue
            for c in regex.split(f"[{SPACE}]+", part) if _CONTROL.search(part) else part.split():
                found = known.get(c)
                if found is None:
                    found = self.chunk(c)
                    if len(c) <= 64:
                        if len(known) >= CACHE:
                            known.clear()
                        known[c] = found
                out.append(found)
        return np.frombuffer(b"".join(out), "<u4")

    def decode(self, ids: np.ndarray) -> bytes:
        """The tokens' texts joined by one space, by gathering from the table."""
        if not len(ids):
            return b""
        n = self.lengths[ids]
        ends = np.cumsum(n)
        at = np.arange(ends[-1]) + np.repeat(self.starts[ids] - (ends - n), n)
        return self.table[at[:-1]].tobytes()


#: The worker's encoder, by the digest of its vocabulary file: kept from task to
#: task and query to query, and only one at a time.
_BUILT: dict[str, Bpe] = {}


def _built(digest: str, known) -> Bpe:
    if digest not in _BUILT:
        _BUILT.clear()
        _BUILT[digest] = Bpe(known.value)
    return _BUILT[digest]


def encode_decode(docs: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, ids, decoded) for every row: ids as little-endian unsigned 32-bit
    integers in a binary, and the text they decode to.

    Null and empty texts have no ids and decode to an empty text. Strings of
    special tokens in a text become those tokens. Other columns are not looked
    at. Batches leave a task slice by slice, so memory is bounded by the
    slice, or the longest single text.
    """
    spec = read_spec(path)
    digest = hashlib.sha256(repr(spec).encode()).hexdigest()
    known = docs.sparkSession.sparkContext.broadcast(spec)
    src = docs.select(F.col(id_col).alias("id"), text_or_empty(text_col).alias("text"))

    def run(batches):
        bpe = _built(digest, known)
        for b in batches:
            _, offsets = utf8(b.column("text"))
            for lo, hi in slices(offsets):
                ids = [bpe.encode(t) for t in b.column("text").slice(lo, hi - lo).to_pylist()]
                yield pa.RecordBatch.from_arrays(
                    [b.column("id").slice(lo, hi - lo), pa.array([x.tobytes() for x in ids], pa.binary()),
                     pa.array([bpe.decode(x).decode("utf-8") for x in ids], pa.string())],
                    names=["id", "ids", "decoded"])

    kind = src.schema["id"].dataType.simpleString()
    return src.mapInArrow(run, f"id {kind}, ids binary, decoded string").withColumnRenamed("id", id_col)
