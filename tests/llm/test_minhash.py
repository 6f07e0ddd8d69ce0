import random
import re
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from llm_rows import CLASHES, ODD, frame, shipped  # noqa: F401

from loyalspark.llm import common
from loyalspark.llm import minhash as M

WORD = re.compile("[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def bag(text):
    w = WORD.findall("".join(c.lower() if "A" <= c <= "Z" else c for c in text or ""))
    return Counter(tuple(w[i:i + 5]) for i in range(len(w) - 4)) if len(w) >= 5 else Counter([tuple(w)] if w else [])


def classes(rows):
    """Connected components by comparing all pairs."""
    bags, parent = [bag(t) for _, t in rows], list(range(len(rows)))

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for i in range(len(rows)):
        for j in range(i):
            if bags[i] and bags[j] and 5 * sum((bags[i] & bags[j]).values()) >= 4 * sum((bags[i] | bags[j]).values()):
                a, b = find(i), find(j)
                parent[max(a, b)] = min(a, b)
    label = [find(i) for i in range(len(rows))]
    out = []
    for i, (key, _) in enumerate(rows):
        ids = [rows[j][0] for j in range(len(rows)) if label[j] == label[i] and rows[j][0] is not None]
        out.append((key, min(ids) if ids else None, label.count(label[i])))
    return sorted(out, key=str)


def near_texts(seed=5):
    rnd = random.Random(seed)
    voc = [f"w{i}" for i in range(3000)]
    texts = []
    for _ in range(30):
        base = [rnd.choice(voc) for _ in range(rnd.choice([3, 5, 8, 40, 200]))]
        for _ in range(rnd.choice([1, 1, 2, 5])):
            p = rnd.choice([0, 0.005, 0.02, 0.05])
            texts.append(" ".join(rnd.choice(voc) if rnd.random() < p else w for w in base) + rnd.choice(["", " ", "!"]))
    chain = [rnd.choice(voc) for _ in range(200)]
    for k in range(12):  # neighbours alike, ends not
        chain = list(chain)
        chain[k * 7 % 200], chain[(k * 7 + 90) % 200] = f"c{k}", f"d{k}"
        texts.append(" ".join(chain))
    rnd.shuffle(texts)
    return texts


def test_signatures_estimate_weighted_similarity():
    rnd = random.Random(5)
    for p in (0.01, 0.05):
        for times in (1, 6):
            a = [f"w{rnd.randint(0, 500)}" for _ in range(200)] * times
            b = [f"x{rnd.randint(0, 500)}" if rnd.random() < p else w for w in a]
            x, y = bag(" ".join(a)), bag(" ".join(b))
            _, _, owner, value, weight = M.shingles(*common.utf8(pa.array([" ".join(a), " ".join(b)])))
            s = M.bag_minhash(2, owner, value, weight, 4000)
            true = sum((x & y).values()) / sum((x | y).values())
            assert abs((s[0] == s[1]).mean() - true) < 0.035


def test_signatures_do_not_depend_on_the_slice():
    """Bit-equal whether a text is signed alone or among many others, whose
    processes change the number of points drawn at once."""
    rnd = random.Random(6)
    texts = [" ".join(rnd.choice("abcdefghijklmnop") + str(rnd.randint(0, 99)) for _ in range(n))
             for n in [3, 5, 9, 14, 24, 44, 104, 400] * 12 + [3000, 6000]]

    def sign(some):
        _, _, owner, value, weight = M.shingles(*common.utf8(pa.array(some)))
        return M.bag_minhash(len(some), owner, value, weight, 80)

    alone = np.concatenate([sign([t]) for t in texts])
    for some in (len(texts), 40, 8):
        assert (sign(texts[-some:]) == alone[-some:]).all()


def test_classes_against_all_pairs(frame):
    rows = [*enumerate(near_texts(), 100), *ODD, (20, "one two"), (21, "One TWO."), (22, "one two three")]
    got = M.near_classes(frame(rows)).collect()
    alone = {"", "   \n", "!!! ???", None}
    own = [r for r in rows if r[1] in alone]
    want = classes([r for r in rows if r[1] not in alone]) + [(i, i, 1) for i, _ in own]
    assert sorted(((r.doc_id, r.class_id, r.class_size) for r in got), key=str) == sorted(want, key=str)
    for r in got:
        assert r.kept == (r.doc_id == r.class_id)


@pytest.mark.parametrize("bound", [M.BUCKET_WORDS, 900])
def test_buckets_of_many_components(frame, spark, monkeypatch, bound):
    """One bucket holds everything: it is resolved in one task, or prefixes,
    pivots and rings must find every link."""
    monkeypatch.setattr(M, "BUCKET_WORDS", bound)
    rows = list(enumerate(near_texts(8), 100))
    sig = common.stage(spark, M.signatures(frame(rows), "doc_id", "text"), "t")
    members = common.stage(spark, sig.selectExpr("1L AS bucket", "node", "n_words").distinct(), "t")
    labels = {bytes(r.node): bytes(r.label) for r in M.link_nodes(spark, members, frame(rows), "text").collect()}
    node = {r.id: bytes(r.node) for r in sig.collect()}
    by = {}
    for i, _ in rows:
        by.setdefault(labels.get(node[i], node[i]), []).append(i)
    want = {}
    for i, c, _ in classes(rows):
        want.setdefault(c, []).append(i)
    assert sorted(map(sorted, by.values())) == sorted(map(sorted, want.values()))


def test_dedup_and_empty(frame):
    rows = [(1, "a b c d e f g h"), (2, "A b c d e f g h!"), (3, "other words in this text"), (3, "other words in this text"), *ODD[:5]]
    got = M.near_dedup(frame(rows))
    assert got.columns == ["doc_id", "text", *[c.split()[-1] for c in CLASHES]]
    assert sorted(r.doc_id for r in got.collect()) == [1, 1, 2, 3, 3, 4]
    assert M.near_classes(frame([])).count() == 0
