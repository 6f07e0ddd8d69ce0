import random
from collections import defaultdict

import pytest
from llm_rows import ODD, frame, shipped  # noqa: F401

from loyalspark.llm import suffix_dedup as S


def brute(texts, length):
    where = defaultdict(list)
    raw = [(t or "").encode() for t in texts]
    for d, b in enumerate(raw):
        for i in range(len(b) - length + 1):
            where[b[i:i + length]].append((d, i))
    gone = [bytearray(len(b)) for b in raw]
    for found in where.values():
        if len(found) > 1:
            for d, i in found:
                gone[d][i:i + length] = b"\1" * length
    out = []
    for b, g in zip(raw, gone):
        spans = [i for i in range(len(g)) if g[i] and (not i or not g[i - 1])]
        ends = [i + 1 for i in range(len(g)) if g[i] and (i + 1 == len(g) or not g[i + 1])]
        out.append((len(b), list(zip(spans, ends)), bytes(x for x, y in zip(b, g) if not y)))
    return out


def corpus(seed=3):
    rnd = random.Random(seed)
    base = ["".join(rnd.choice("abcdé ") for _ in range(rnd.randint(0, 700))) for _ in range(25)]
    texts = []
    for _ in range(70):
        t = ""
        for _ in range(rnd.randint(0, 4)):
            s = rnd.choice(base)
            a = rnd.randint(0, len(s))
            t += s[a:a + rnd.randint(0, 350)]
            if rnd.random() < 0.5:
                t += "".join(rnd.choice("abcd") for _ in range(30))
        texts.append(t)
    return [*texts, None, "", "a" * 700, "a" * 300, "xyz" * 150, texts[3], texts[3], "漢字" * 60]


@pytest.mark.parametrize("length", [200, 50, 11])
def test_against_brute_force(frame, length):
    texts = corpus()
    got = S.repeated_bytes(frame(enumerate(texts)), length=length, bucket_bytes=6000, range_bytes=2000).collect()
    have = {r.doc_id: (r.n_bytes, [tuple(s) for s in r.spans], bytes(r.kept)) for r in got}
    assert have == dict(enumerate(brute(texts, length)))


def test_covers_cover_every_difference():
    for v, cover in S.COVERS.items():
        assert {(a - b) % v for a in cover for b in cover} == set(range(v))


def test_odd_rows_and_empty(frame):
    got = S.repeated_bytes(frame(ODD)).collect()
    assert len(got) == len(ODD)
    long_ones = [r for r in got if r.n_bytes > 10_000]
    assert [len(r.kept) for r in long_ones] == [0, 0]
    assert S.repeated_bytes(frame([])).count() == 0
    with pytest.raises(ValueError):
        S.Shape(10)
