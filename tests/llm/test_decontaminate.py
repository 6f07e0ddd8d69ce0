import random
import re

from llm_rows import CLASHES, ODD, frame, shipped  # noqa: F401

from loyalspark.llm import decontaminate as D

WORD = re.compile("[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def words(text):
    return WORD.findall("".join(c.lower() if "A" <= c <= "Z" else c for c in text or ""))


def brute(docs, items, window=13):
    wins = {}
    for i, t in items:
        w = words(t)
        n = min(window, len(w))
        for k in range(len(w) - n + 1 if n else 0):
            wins.setdefault(tuple(w[k:k + n]), set()).add("null" if i is None else str(i))
    sizes = {len(w) for w in wins}
    out = {}
    for key, (_, t) in enumerate(docs):
        w, hit, found = words(t), set(), set()
        for n in sizes:
            for k in range(len(w) - n + 1):
                if ids := wins.get(tuple(w[k:k + n])):
                    found |= ids
                    hit.update(range(k, k + n))
        out[key] = (len(w), len(hit), sorted(found))
    return out


def planted(seed=1):
    rnd = random.Random(seed)
    voc = [f"w{i}" for i in range(60)] + ["É", "straße", "X9"]
    items = [(i, " ".join(rnd.choice(voc) for _ in range(rnd.choice([0, 1, 3, 12, 13, 14, 30])))) for i in range(40)]
    items += [(7, items[5][1]), (None, "only here"), (99, None), (98, "...")]
    docs = []
    for k in range(120):
        t = [rnd.choice(voc) for _ in range(rnd.randint(0, 80))]
        if k % 2:
            w = words(rnd.choice(items)[1])
            a = rnd.randint(0, len(w))
            t[rnd.randint(0, len(t)):0] = w[a:a + 20]
        docs.append((k, rnd.choice([" ", ", ", "\n"]).join(t).title()))
    return [*docs, *[(1000 + i, t) for i, (_, t) in enumerate(ODD)]], items


def test_scan_against_brute_force(frame, spark):
    docs, items = planted()
    bench = spark.createDataFrame(items, "item_id long, text string")
    want = brute(docs, items)
    for limit in (D.MAX_WINDOWS, 150):  # one block, and several
        got = {r.doc_id: (r.n_words, r.n_hit, r["items"]) for r in D.scan(frame(docs), bench, limit=limit).collect()}
        assert got == {docs[k][0]: v for k, v in want.items()}
    assert any(v[1] for v in want.values()) and not all(v[1] for v in want.values())


def test_documents_and_spans(frame, spark):
    docs = [(1, "Before a b c d e f g h i j k l m after"), (2, "clean text"), (3, None), (3, None)]
    bench = spark.createDataFrame([(1, "a b c d e f g h i j k l m n o")], "item_id long, text string")
    left = D.decontaminate(frame(docs), bench)
    assert left.columns == ["doc_id", "text", *[c.split()[-1] for c in CLASHES]]
    assert sorted(r.doc_id for r in left.collect()) == [2, 3, 3]
    cut = {r.doc_id: r.text for r in D.decontaminate(frame(docs), bench, mode="spans").collect()}
    assert cut == {1: "Before  after", 2: "clean text", 3: None}


def test_five_percent(frame, spark):
    bench = spark.createDataFrame([(1, "needle")], "item_id long, text string")
    docs = [(1, "x " * 19 + "needle"), (2, "x " * 20 + "needle")]
    got = {r.doc_id for r in D.decontaminate(frame(docs), bench).collect()}
    assert got == {2}


def test_empty(frame, spark):
    none = spark.createDataFrame([], "item_id long, text string")
    assert [r.n_hit for r in D.scan(frame([(1, "a b")]), none).collect()] == [0]
    assert D.scan(frame([]), none).count() == 0
    assert D.decontaminate(frame(ODD), none).count() == len(ODD)
