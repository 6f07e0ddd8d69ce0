import hashlib

import corpus_pipeline as P
import numpy as np
from llm_rows import ODD, SF001, frame, shipped  # noqa: F401
from test_decontaminate import brute
from test_minhash import classes
from tokenizers import Tokenizer

from loyalspark.llm import quality
from loyalspark.llm.common import stage, table
from loyalspark.llm.queries import TOKENIZER

NAMES = ["quality_classifier", "exact_dedup", "minhash_near_dedup", "decontamination", "bpe"]


def test_stages_against_brute_force(spark):
    docs, kept = table(spark, SF001, "documents"), {}
    assert [n for n, _ in P.STAGES] == NAMES
    columns = docs.columns
    for name, function in P.STAGES:
        before = {r.doc_id: r.text for r in docs.collect()}
        out = stage(spark, function(spark, docs, SF001), "t")
        if name == "quality_classifier":
            model = quality.fit(docs, table(spark, SF001, "labels"))
            want = {r.doc_id for r in quality.score(docs, model).collect() if r.predicted}
        elif name == "exact_dedup":
            want = set({t: i for i, t in sorted(before.items())}.values())
        elif name == "minhash_near_dedup":
            want = {i for i, c, _ in classes(sorted(before.items())) if i == c}
        elif name == "decontamination":
            items = [tuple(r) for r in table(spark, SF001, "benchmark").select("item_id", "text").collect()]
            rows = sorted(before.items())
            found = brute(rows, items)
            want = {i for k, (i, _) in enumerate(rows) if not (found[k][1] and 20 * found[k][1] >= found[k][0])}
        else:
            want = set(before)
            lib = Tokenizer.from_file(TOKENIZER)
            for r in out.collect():
                ids = np.array(lib.encode(before[r.doc_id], add_special_tokens=False).ids, "<u4")
                assert bytes(r.ids) == ids.tobytes() and r.n_tokens == len(ids)
                assert r.decoded_sha256 == hashlib.sha256(lib.decode(ids.tolist(), skip_special_tokens=False).encode()).hexdigest()
        have = [r.doc_id for r in out.select("doc_id").collect()]
        assert set(have) == want and len(have) == len(want), name
        if name != "bpe":
            assert out.columns == columns
        kept[name] = len(have)
        docs = out
    assert kept["quality_classifier"] < 200 and kept["bpe"] > 100
    assert {r.doc_id for r in P.run(spark, SF001).select("doc_id").collect()} == set(have)


def test_odd_rows_and_empty_tables(spark, frame):
    for rows in (ODD, []):
        docs = frame(rows)
        columns = docs.columns
        for name, function in P.STAGES:
            docs = stage(spark, function(spark, docs, SF001), "t")
            if name != "bpe":
                assert docs.columns == columns, name
