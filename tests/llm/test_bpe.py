import random
import time

import numpy as np
import pyarrow.parquet as pq
import pytest
from llm_rows import ODD, SF001, frame, shipped  # noqa: F401
from tokenizers import Tokenizer

from loyalspark.llm import bpe
from loyalspark.llm.queries import TOKENIZER


@pytest.fixture(scope="module")
def both():
    return Tokenizer.from_file(TOKENIZER), bpe.Bpe(bpe.read_spec(TOKENIZER))


def same(both, texts):
    lib, own = both
    for t, e in zip(texts, lib.encode_batch(texts, add_special_tokens=False)):
        ids = own.encode(t)
        assert ids.tolist() == e.ids, t
        assert own.decode(ids).decode() == lib.decode(e.ids, skip_special_tokens=False)


def test_whole_documents(both):
    same(both, pq.read_table(f"{SF001}/documents.parquet").column("text").to_pylist())


def test_every_character(both):
    same(both, [f"a{chr(c)}b {chr(c)}" for c in range(1, 0x110000, 7) if not 0xD800 <= c < 0xE000])


def test_random_strings(both):
    rnd = random.Random(2)
    parts = ["a", "aa", "in", "th", "er", "ing", "'s", "'LL", " ", "\x1c", "É", "é", "Σ", "İ", "漢", "9", "!!", "<|endoftext|>", "<|"]
    same(both, ["".join(rnd.choice(parts) for _ in range(rnd.randint(0, 40))) for _ in range(3000)])


def test_one_very_long_word(both):
    rnd = random.Random(5)
    words = ["".join(rnd.choice(letters) for _ in range(200_000)) for letters in ("abcdefghijklmnopqrstuvwxyz", "a", "in", "漢字é")]
    began = time.process_time()
    own = [both[1].encode(w) for w in words]
    assert time.process_time() - began < 8
    for w, ids in zip(words, own):
        assert ids.tolist() == both[0].encode(w, add_special_tokens=False).ids


def plain_merges(spec, key):
    """Byte-pair merging as defined: the best ranked pair, leftmost first."""
    rank = {(a, b): i for i, (a, b) in enumerate(spec["merges"])}
    parts = [*key[:-1], key[-1] + spec["suffix"]]
    while len(parts) > 1:
        best = min(range(len(parts) - 1), key=lambda i: (rank.get((parts[i], parts[i + 1]), 1 << 30), i))
        if (parts[best], parts[best + 1]) not in rank:
            break
        parts[best: best + 2] = [parts[best] + parts[best + 1]]
    return [spec["vocab"][p] for p in parts]


def test_backtracking_equals_merging_in_rank_order():
    """On vocabularies in which greedy longest matching goes wrong."""
    rnd = random.Random(3)
    for _ in range(40):
        tokens = ["a", "b", "c", "a$", "b$", "c$"]
        merges = []
        for _ in range(14):
            a, b = rnd.choice([t for t in tokens if not t.endswith("$")]), rnd.choice(tokens)
            if a + b not in tokens:
                merges.append((a, b))
                tokens.append(a + b)
        spec = {"vocab": {t: i for i, t in enumerate(tokens)}, "merges": merges, "suffix": "$", "special": {}, "pattern": r"\S+", "rules": ""}
        own = bpe.Bpe(spec)
        for _ in range(60):
            word = "".join(rnd.choice("abc") for _ in range(rnd.randint(1, 14)))
            assert list(own.word(word + bpe.END)) == plain_merges(spec, word), (merges, word)


def test_frame(both, frame):
    got = bpe.encode_decode(frame(ODD), TOKENIZER).collect()
    want = sorted((str(i), tuple(both[0].encode(t or "", add_special_tokens=False).ids)) for i, t in ODD)
    assert sorted((str(r.doc_id), tuple(np.frombuffer(r.ids, "<u4").tolist())) for r in got) == want
    assert bpe.encode_decode(frame([]), TOKENIZER).count() == 0
