"""Near-duplicate classes by BagMinHash signatures, banding and verification.

A document is the multiset of its five-word shingles (one shingle of all its
words if it has fewer). Weights are discretised at dyadic levels: a shingle of
multiplicity w owns the level intervals [0, 1), [1, 2), [2, 4), ... below w,
each with a Poisson process of the interval's width whose points carry a slot
and a level and are the same in every document; points at levels of w or more
are skipped. The first point in each slot is the signature, so two signatures
agree in a slot with exactly the weighted Jaccard similarity. Points are drawn
in order and a process stops once it is beyond the last first point.

Documents with the same word sequence are one node. Nodes that share a band
are candidates. No bucket is expanded into pairs: each node is compared with
a pivot, exactly, on the words themselves; links make components; a bucket
whose nodes are all in one component is done. Of the others, those of bounded
size are resolved in one task, comparing nodes whose prefixes meet: ordered
rarest first, the shingles of two similar nodes meet before four fifths of
their weight are left. Larger ones are first split by the same rule into parts
that share a prefix shingle. What is still large then is split around pivots:
by the triangle inequality of the weighted Jaccard distance, a node within 0.2
of the pivot and a node beyond 0.4 cannot be similar, so only the ring between
goes on with both sides. This ends when no bucket holds two components, hence
no link between candidates is lost, whatever a bucket's size.
"""

from __future__ import annotations

from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from . import words as W
from .common import SLICE_BYTES, join_small, keep_rows, mix, slices, stage, text_or_empty, utf8

#: Words in a shingle.
SHINGLE = 5
#: Bands and slots per band: at similarity 0.8 all bands differ with
#: probability (1 - 0.8 ** 4) ** 20 = 3e-5.
BANDS, ROWS = 20, 4
#: Nodes (16 bytes each) that may be broadcast.
MAX_BROADCAST_NODES = 500_000

_GOLD = np.uint64(0x9E3779B97F4A7C15)


def shingles(raw: np.ndarray, offsets: np.ndarray):
    """(node names as 16 bytes per text, n words, owner, shingle, weight)."""
    s, e, first = W.words(raw, offsets)
    hashes = W.word_hashes(raw, s, e)
    n = np.diff(first)
    texts = np.arange(len(n))
    owner = np.repeat(texts, n)
    names = np.zeros((len(n), 2), np.uint64)
    for lane, base in enumerate((0xD1342543DE82EF95, 0xAF251AF3B0F025B5)):
        sums = np.zeros(len(hashes) + 1, np.uint64)
        np.cumsum((hashes if lane == 0 else mix(hashes + _GOLD)) * W.powers(base, len(hashes)), dtype=np.uint64, out=sums[1:])
        part = (sums[first[1:]] - sums[first[:-1]]) * W.powers(pow(base, -1, 1 << 64), len(hashes) + 1)[first[:-1]]
        names[:, lane] = mix(part + n.astype(np.uint64) * _GOLD)
    whole = W.windows(hashes, SHINGLE)
    at = np.flatnonzero(owner[: len(whole)] == owner[SHINGLE - 1: SHINGLE - 1 + len(whole)]) if len(whole) else np.zeros(0, int)
    value, text = [whole[at]], [owner[at]]
    for size in range(1, SHINGLE):
        short = np.flatnonzero(n == size)
        if len(short):
            value.append(W.windows(hashes, size)[first[short]])
            text.append(short)
    value, text = np.concatenate(value), np.concatenate(text)
    order = np.lexsort((value, text))
    value, text = value[order], text[order]
    new = np.ones(len(value), bool)
    new[1:] = (value[1:] != value[:-1]) | (text[1:] != text[:-1])
    cut = np.flatnonzero(new)
    return names, n, text[cut], value[cut], np.diff(np.append(cut, len(value)))


def all_shingles(raw: np.ndarray, offsets: np.ndarray):
    """(owner, shingle, weight) of many texts, worked out slice by slice."""
    parts = []
    for lo, hi in slices(offsets, SLICE_BYTES // 2):
        owner, value, weight = shingles(raw[offsets[lo]: offsets[hi]], offsets[lo: hi + 1] - offsets[lo])[2:]
        parts.append((owner + lo, value, weight))
    if not parts:
        return np.zeros(0, np.int64), np.zeros(0, np.uint64), np.zeros(0, np.int64)
    return tuple(np.concatenate(x) for x in zip(*parts))


def bag_minhash(texts: int, owner: np.ndarray, value: np.ndarray, weight: np.ndarray, slots: int) -> np.ndarray:
    """Signatures (texts x slots) as the bits of the first points; a text
    without shingles keeps infinity everywhere."""
    first = np.full(texts * slots, np.inf)
    # one process per shingle and dyadic interval of levels below its weight
    text, seed, low, width, most = [], [], [], [], []
    j, have = 0, np.arange(len(owner))
    while len(have):
        lo = 0 if j == 0 else 1 << (j - 1)
        text.append(owner[have])
        seed.append(mix(value[have] + np.uint64((j + 1) * 0xA0761D6478BD642F % (1 << 64))))
        low.append(np.full(len(have), lo))
        width.append(np.full(len(have), max(1, lo)))
        most.append(weight[have])
        j += 1
        have = have[weight[have] > 1 << (j - 1)]
    if not text:
        return first.reshape(texts, slots).view(np.uint64)
    text, seed, low, width, most = map(np.concatenate, (text, seed, low, width, most))
    time = np.zeros(len(text))
    k = 0
    while len(text):
        group = 1 if len(text) > 4000 else 16  # points drawn at once
        step = np.arange(k + 1, k + group + 1, dtype=np.uint64) * _GOLD
        draw = mix(seed[:, None] + step)
        gap = -np.log(((draw >> np.uint64(11)).astype(float) + 0.5) * 2.0 ** -53) / width[:, None]
        # gaps are added one by one, so a point's bits do not depend on the group
        at = np.cumsum(np.concatenate([time[:, None], gap], axis=1), axis=1)[:, 1:]
        draw = mix(draw ^ np.uint64(0xE7037ED1A0B428DB))
        slot = (draw & np.uint64(0xFFFFFFFF)) * np.uint64(slots) >> np.uint64(32)
        level = low[:, None] + ((draw >> np.uint64(32)) * width[:, None].astype(np.uint64) >> np.uint64(32)).astype(np.int64)
        ok = level < most[:, None]
        place = text[:, None] * slots + slot.astype(np.int64)
        np.minimum.at(first, place[ok], at[ok])
        time, k = at[:, -1], k + group
        last = first.reshape(texts, slots).max(axis=1)
        go = time < last[text]
        text, seed, low, width, most, time = (x[go] for x in (text, seed, low, width, most, time))
    return first.reshape(texts, slots).view(np.uint64)


def band_keys(signature: np.ndarray, bands: int = BANDS, rows: int = ROWS) -> np.ndarray:
    """(texts x bands) bucket keys; the band's number is part of the key."""
    out = np.empty((len(signature), bands), np.uint64)
    for b in range(bands):
        key = np.full(len(signature), np.uint64((b + 1) * int(_GOLD) % (1 << 64)))
        for r in range(rows):
            key = mix(key * np.uint64(0xD6E8FEB86659FD93) + signature[:, b * rows + r])
        out[:, b] = key
    return out


def _binary(names: np.ndarray) -> pa.Array:
    n = len(names)
    return pa.Array.from_buffers(pa.binary(), n, [None, pa.py_buffer((np.arange(n + 1, dtype=np.int32) * 16).tobytes()),
                                                  pa.py_buffer(names.tobytes())])


def signatures(docs: DataFrame, id_col: str, text_col: str, bands: int = BANDS, rows: int = ROWS) -> DataFrame:
    """(id, sha, node, n_words, bands) of every row."""
    text = text_or_empty(text_col)
    src = docs.select(F.col(id_col).alias("id"), F.unhex(F.sha2(text, 256)).alias("sha"), text.alias("text"))
    kind = src.schema["id"].dataType.simpleString()

    def run(batches):
        for b in batches:
            raw, offsets = utf8(b.column("text"))
            for lo, hi in slices(offsets):
                names, n, owner, value, weight = shingles(raw[offsets[lo]: offsets[hi]], offsets[lo: hi + 1] - offsets[lo])
                keys = band_keys(bag_minhash(hi - lo, owner, value, weight, bands * rows), bands, rows)
                yield pa.RecordBatch.from_arrays([
                    b.column("id").slice(lo, hi - lo), b.column("sha").slice(lo, hi - lo), _binary(names), pa.array(n, pa.int64()),
                    pa.ListArray.from_arrays(pa.array(np.arange(hi - lo + 1) * bands, pa.int32()), pa.array(keys.ravel().view(np.int64)))],
                    names=["id", "sha", "node", "n_words", "bands"])

    return src.mapInArrow(run, f"id {kind}, sha binary, node binary, n_words long, bands array<long>")


def node_texts(docs: DataFrame, text_col: str, nodes: DataFrame) -> DataFrame:
    """(node, text): a text of every node in ``nodes`` (staged, distinct)."""
    def run(batches):
        for b in batches:
            raw, offsets = utf8(b.column("text"))
            for lo, hi in slices(offsets):
                names = shingles(raw[offsets[lo]: offsets[hi]], offsets[lo: hi + 1] - offsets[lo])[0]
                yield pa.RecordBatch.from_arrays([_binary(names), b.column("text").slice(lo, hi - lo)], names=["node", "text"])

    all_texts = docs.select(text_or_empty(text_col).alias("text")).mapInArrow(run, "node binary, text string")
    wanted = join_small(all_texts, nodes, "node", "left_semi", MAX_BROADCAST_NODES)
    return wanted.groupBy("node").agg(F.first("text").alias("text"))


def pair_overlaps(left: tuple, right: tuple, at: np.ndarray, n: int, limit: int = 1 << 20):
    """(both, either) of pair i: text i of ``left`` and text ``at[i]`` of
    ``right``, each given as (owner, shingle, weight) sorted by owner."""
    both, either = np.zeros(n, np.int64), np.zeros(n, np.int64)
    from_left, from_right = (np.searchsorted(x[0], np.arange(m + 1)) for x, m in ((left, n), (right, int(at.max(initial=-1)) + 1)))
    sizes = np.diff(from_left) + np.diff(from_right)[at]
    for lo, hi in slices(np.concatenate([[0], np.cumsum(sizes)]), limit):
        some = slice(from_left[lo], from_left[hi])
        begin, count = from_right[at[lo:hi]], np.diff(from_right)[at[lo:hi]]
        ends = np.cumsum(count)
        take = np.arange(ends[-1]) + np.repeat(begin - (ends - count), count)
        owner = np.concatenate([left[0][some], np.repeat(np.arange(lo, hi), count)]) - lo
        value = np.concatenate([left[1][some], right[1][take]])
        weight = np.concatenate([left[2][some], right[2][take]])
        order = np.lexsort((value, owner))
        owner, value, weight = owner[order], value[order], weight[order]
        same = (owner[1:] == owner[:-1]) & (value[1:] == value[:-1])
        shared = np.minimum(weight[1:], weight[:-1])[same]
        both[lo:hi] = np.bincount(owner[1:][same], shared, hi - lo).astype(np.int64)
        either[lo:hi] = np.bincount(owner, weight, hi - lo).astype(np.int64) - both[lo:hi]
    return both, either


#: Pairs of one pivot that are dealt together, and bytes of text in a group of pairs.
CHUNK, GROUP_BYTES = 64, 1 << 20


def overlaps(pairs: DataFrame, texts: DataFrame) -> DataFrame:
    """(a, b, both, either): shared and united weight of pairs of nodes.

    A pivot's pairs are dealt in chunks, so a text that is the pivot of a third
    of all nodes is read once per chunk and never gathers its pairs in one task.
    """
    pairs = stage(pairs.sparkSession, pairs, "pairs")
    mean = texts.agg(F.avg(F.octet_length("text"))).first()[0] or 1
    groups = max(1, int(pairs.count() * mean / GROUP_BYTES) + 1)
    many = pairs.groupBy("b").agg(F.ceil(F.count("*") / CHUNK).alias("chunks"))
    dealt = stage(pairs.sparkSession, pairs.join(many, "b").withColumn("g", F.pmod(
        F.xxhash64("b", F.pmod(F.xxhash64("a"), F.col("chunks"))), F.lit(groups))), "dealt")

    def with_text(side: DataFrame, name: str) -> DataFrame:
        found = side.join(texts.select(F.col("node").alias(name), F.col("text").alias("text")), name)
        return found.select(*[F.col(c).alias(c) for c in found.columns])

    left = with_text(dealt.select("g", "a", "b"), "a")
    right = with_text(dealt.select("g", "b").distinct(), "b")

    def run(key, of_a, of_b):
        row = {b: i for i, b in enumerate(of_b.column("b").to_pylist())}
        at = np.array([row[b] for b in of_a.column("b").to_pylist()], np.int64)
        both, either = pair_overlaps(all_shingles(*utf8(of_a.column("text"))), all_shingles(*utf8(of_b.column("text"))), at, len(at), 1 << 18)
        return pa.table({"a": of_a.column("a"), "b": of_a.column("b"), "both": pa.array(both), "either": pa.array(either)})

    return left.groupBy("g").cogroup(right.groupBy("g")).applyInArrow(run, "a binary, b binary, both long, either long")


def components(spark: SparkSession, links: DataFrame) -> DataFrame:
    """(node, label): every node of ``links`` (a, b) with the smallest node of
    its connected component, by alternating star contractions."""
    edges = stage(spark, links.select("a", "b").filter("a != b").distinct(), "links")
    before = None
    while True:
        # every neighbour above a node is tied to the node's smallest neighbour
        both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m"))
        large = both.join(least, "a").filter("b > a").select(F.col("b").alias("a"), F.col("m").alias("b"))
        large = large.filter("a != b").distinct()
        # now every edge points down: a node and its neighbours go to the smallest of them
        least = large.groupBy("a").agg(F.min("b").alias("m"))
        small = large.join(least, "a").select(F.explode(F.array(F.struct("a", "m"), F.struct(F.col("b").alias("a"), "m"))).alias("e"))
        edges = stage(spark, small.select(F.col("e.a").alias("a"), F.col("e.m").alias("b")).filter("a != b").distinct(), "links")
        state = edges.agg(F.count("*"), F.sum(F.hash("a", "b").cast("long"))).first()
        if state == before:
            return edges.select(F.col("a").alias("node"), F.col("b").alias("label")).unionByName(
                edges.select(F.col("b").alias("node"), F.col("b").alias("label")).distinct())
        before = state


def _similar():
    return 5 * F.col("both") >= 4 * F.col("either")


def _near():
    return 5 * F.col("both") >= 3 * F.col("either")


#: Words of a bucket that one task resolves by itself; larger ones are split first.
BUCKET_WORDS = 1_000_000
#: Words that a task shingles at once when it resolves buckets, about.
GROUP_WORDS = 100_000


def in_prefix(before, total):
    """Whether a shingle with ``before`` weight ahead of it, in an order that
    all texts share, is in its text's prefix: two texts of similarity 0.8 or
    more share a shingle of both prefixes, as the rest weighs too little."""
    return 5 * (total - before) >= 4 * total


def resolve_bucket(group: np.ndarray, owner: np.ndarray, value: np.ndarray, weight: np.ndarray) -> list[tuple[int, int]]:
    """Pairs of texts 0..m-1 that join all similar ones; ``group`` numbers the
    components known before and is updated. Texts are compared only where
    their prefixes, rarest shingles first, meet and their components differ."""
    m = len(group)
    at = np.searchsorted(owner, np.arange(m + 1))
    total = np.bincount(owner, weight, m).astype(np.int64)
    _, kind, count = np.unique(value, return_inverse=True, return_counts=True)
    order = np.lexsort((kind, count[kind], owner))
    before = np.cumsum(weight[order]) - weight[order] - (np.cumsum(total) - total)[owner[order]]
    keep = order[in_prefix(before, total[owner[order]]) & (count[kind[order]] > 1)]
    keep = keep[np.argsort(kind[keep], kind="stable")]
    cut = np.flatnonzero(np.append(True, kind[keep][1:] != kind[keep][:-1])) if len(keep) else np.zeros(0, np.int64)
    out: list[tuple[int, int]] = []
    seen: set[int] = set()
    for lo, hi in zip(cut.tolist(), np.append(cut[1:], len(keep)).tolist()):
        texts = owner[keep[lo:hi]]
        if hi - lo < 2 or (group[texts] == group[texts[0]]).all():
            continue
        for n, i in enumerate(texts[:-1].tolist()):
            rest = texts[n + 1:]
            rest = rest[group[rest] != group[i]]
            rest = np.array([j for j in rest.tolist() if (min(i, j) * m + max(i, j)) not in seen], np.int64)
            if not len(rest):
                continue
            seen.update((np.minimum(i, rest) * m + np.maximum(i, rest)).tolist())
            size = at[rest + 1] - at[rest]
            ends = np.cumsum(size)
            take = np.arange(ends[-1]) + np.repeat(at[rest] - (ends - size), size)
            who = np.repeat(np.arange(len(rest)), size)
            own, w = value[at[i]: at[i + 1]], weight[at[i]: at[i + 1]]
            k = np.minimum(np.searchsorted(own, value[take]), len(own) - 1)
            hit = own[k] == value[take]
            both = np.bincount(who[hit], np.minimum(w[k[hit]], weight[take][hit]), len(rest))
            for j in rest[5 * both >= 4 * (total[i] + total[rest] - both)].tolist():
                if group[j] != group[i]:
                    out.append((i, j))
                    group[group == group[j]] = group[i]
    return out


def resolve(members: DataFrame, texts: DataFrame) -> DataFrame:
    """(a, b): links that join all similar nodes of each bucket of ``members``
    (bucket, node, label, n_words), whose sizes are bounded."""
    groups = int((members.agg(F.sum("n_words")).first()[0] or 0) // GROUP_WORDS) + 1
    found = members.join(texts, "node").withColumn("g", F.pmod(F.xxhash64("bucket"), F.lit(groups)))

    def run(key, table):
        bucket = table.column("bucket").to_numpy()
        order = np.argsort(bucket, kind="stable")
        table, bucket = table.take(pa.array(order)), bucket[order]
        node, label = table.column("node").to_pylist(), table.column("label").to_pylist()
        owner, value, weight = all_shingles(*utf8(table.column("text")))
        out: list[tuple[bytes, bytes]] = []
        cuts = np.flatnonzero(np.append(True, bucket[1:] != bucket[:-1])) if len(bucket) else []
        for lo, hi in zip(cuts, np.append(cuts[1:], len(bucket))):
            number = {x: i for i, x in enumerate(dict.fromkeys(label[lo:hi]))}
            some = slice(*np.searchsorted(owner, [lo, hi]))
            pairs = resolve_bucket(np.array([number[x] for x in label[lo:hi]]), owner[some] - lo, value[some], weight[some])
            out += [(node[lo + i], node[lo + j]) for i, j in pairs]
        return pa.table({"a": pa.array([x for x, _ in out], pa.binary()), "b": pa.array([y for _, y in out], pa.binary())})

    return found.groupBy("g").applyInArrow(run, "a binary, b binary")


def split_by_prefix(members: DataFrame, texts: DataFrame) -> DataFrame:
    """(bucket, node, n_words): the buckets of ``members`` split so that each
    part holds the nodes whose prefixes share a shingle, rarest in the bucket
    first. Similar nodes of a bucket meet in some part."""
    def run(batches):
        for b in batches:
            raw, offsets = utf8(b.column("text"))
            for lo, hi in slices(offsets, 1 << 20):
                _, _, owner, value, weight = shingles(raw[offsets[lo]: offsets[hi]], offsets[lo: hi + 1] - offsets[lo])
                total = np.bincount(owner, weight, hi - lo).astype(np.int64)[owner]
                rows = pa.RecordBatch.from_arrays([b.column(c) for c in ("bucket", "node", "n_words")], names=["bucket", "node", "n_words"])
                yield pa.RecordBatch.from_arrays([*rows.take(pa.array(owner + lo)).columns, pa.array(value.view(np.int64)),
                                                  pa.array(weight, pa.int64()), pa.array(total)],
                                                 names=["bucket", "node", "n_words", "shingle", "weight", "total"])

    rows = members.select("bucket", "node", "n_words").join(texts, "node").select("bucket", "node", "n_words", "text").mapInArrow(
        run, "bucket long, node binary, n_words long, shingle long, weight long, total long")
    often = rows.groupBy("bucket", "shingle").agg(F.count("*").alias("often"))
    order = Window.partitionBy("bucket", "node").orderBy("often", "shingle").rowsBetween(Window.unboundedPreceding, -1)
    placed = rows.join(often, ["bucket", "shingle"]).withColumn("before", F.coalesce(F.sum("weight").over(order), F.lit(0)))
    return placed.filter(in_prefix(F.col("before"), F.col("total")) & (F.col("often") > 1)).select(
        F.xxhash64("bucket", "shingle", F.lit("prefix")).alias("bucket"), "node", "n_words")


def link_nodes(spark: SparkSession, members: DataFrame, docs: DataFrame, text_col: str) -> DataFrame:
    """(node, label) of all nodes with a link, from staged (bucket, node,
    n_words) rows of buckets with two nodes or more."""
    texts = stage(spark, node_texts(docs, text_col, stage(spark, members.select("node").distinct(), "nodes")), "node-texts")
    # first every node against the smallest pivot of its buckets
    pivots = members.groupBy("bucket").agg(F.min("node").alias("p"))
    first = members.join(pivots, "bucket").groupBy("node").agg(F.min("p").alias("p")).filter("node != p")
    known = stage(spark, overlaps(first.select(F.col("node").alias("a"), F.col("p").alias("b")), texts), "overlaps")
    labels = stage(spark, components(spark, known.filter(_similar()).select("a", "b")), "labels")
    active = members.withColumn("side", F.lit(0)).withColumn("split", F.lit(False))
    while True:
        active = active.join(labels, "node", "left").withColumn("label", F.coalesce("label", "node"))
        # buckets with two components or more; of equal ones (bands repeat each other) one is enough
        open_ = (active.groupBy("bucket", "split").agg(
            F.min("label").alias("lo"), F.max("label").alias("hi"), F.min(F.struct("side", "node")).alias("p"),
            F.count("*").alias("n"), F.sum("n_words").alias("words"),
            *[F.sum(F.xxhash64("node", F.lit(i)).cast("decimal(38,0)")).alias(f"set{i}") for i in (0, 1)])
            .filter("lo != hi").groupBy("n", "set0", "set1").agg(F.min(F.struct("bucket", "p", "words")).alias("w"))
            .select("w.bucket", F.col("w.p.node").alias("p"), (F.col("w.words") <= BUCKET_WORDS).alias("small")))
        active = stage(spark, active.join(open_, "bucket").withColumn("what", F.when(F.col("small"), "small")
                       .when(F.col("split"), "large").otherwise("whole")), "buckets")
        sizes = {r["what"]: r["count"] for r in active.groupBy("what").count().collect()}
        if not sizes:
            return labels
        links, parts = labels.select(F.col("node").alias("a"), F.col("label").alias("b")), []
        if "small" in sizes:
            links = links.unionByName(stage(spark, resolve(
                active.filter("what = 'small'").select("bucket", "node", "label", "n_words"), texts), "resolved"))
        if "whole" in sizes:
            parts.append(split_by_prefix(active.filter("what = 'whole'"), texts).withColumn("side", F.lit(0)))
        if "large" in sizes:
            large = active.filter("what = 'large'")
            asked = large.filter("node != p").select(F.col("node").alias("a"), F.col("p").alias("b")).distinct()
            asked = asked.join(known.select("a", "b"), ["a", "b"], "left_anti")
            known = stage(spark, known.unionByName(overlaps(asked, texts)), "overlaps")
            links = links.unionByName(known.filter(_similar()).select("a", "b"))
            seen = large.filter("node != p").select("bucket", F.col("node").alias("a"), F.col("p").alias("b"), "n_words") \
                .join(known, ["a", "b"]).withColumn("near", _near()).withColumn("like", _similar())
            ring = F.col("near") & ~F.col("like")

            def part(name: str, of: str, side):
                return seen.filter(of).select(F.xxhash64("bucket", "b", F.lit(name)).alias("bucket"), F.col("a").alias("node"),
                                              "n_words", side.alias("side"))

            # pivots come from side 0, the nodes that may still find links; an
            # inner part without a ring holds similar nodes only
            parts += [part("in", "near", F.when(ring, 0).otherwise(1)), part("out", "not like", F.lit(0))]
        labels = stage(spark, components(spark, links), "labels") if set(sizes) != {"whole"} else labels
        if not parts:
            return labels
        active = reduce(DataFrame.unionByName, parts).withColumn("split", F.lit(True))


def near_classes(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                 bands: int = BANDS, rows: int = ROWS) -> DataFrame:
    """(id, class_id, class_size, kept, sha) for every row.

    Classes are the connected components of documents with a weighted Jaccard
    similarity of 0.8 or more; ``class_id`` is the smallest id in the class,
    and the rows that carry it with the class's first text by digest are kept.
    A text without words is similar to nothing, not even to its copies: it is
    a class of its own with its own id. A null id never represents a class
    that has an id; rows with a null id are kept only if the class has none.
    Other columns are not looked at.
    """
    spark = docs.sparkSession
    seen = stage(spark, signatures(docs, id_col, text_col, bands, rows), "signatures")
    worded = seen.filter("n_words > 0")
    nodes = worded.groupBy("node").agg(F.first("bands").alias("bands"), F.first("n_words").alias("n_words"))
    listed = nodes.select("node", "n_words", F.explode("bands").alias("bucket"))
    shared = listed.groupBy("bucket").agg(F.count("*").alias("n")).filter("n > 1").select("bucket")
    members = stage(spark, listed.join(shared, "bucket"), "members")
    rows_ = worded.select("id", "sha", "node")
    if members.limit(1).count():
        labels = link_nodes(spark, members, docs, text_col)
        rows_ = rows_.join(labels, "node", "left").withColumn("label", F.coalesce("label", "node"))
    else:
        rows_ = rows_.withColumn("label", F.col("node"))
    best = rows_.groupBy("label").agg(
        F.min(F.struct(F.col("id").isNull().alias("no"), "id", "sha")).alias("w"), F.count("*").alias("class_size"))
    out = rows_.join(best, "label").select(
        "id", F.col("w.id").alias("class_id"), "class_size",
        (F.col("id").eqNullSafe(F.col("w.id")) & (F.col("sha") == F.col("w.sha"))).alias("kept"), "sha")
    alone = seen.filter("n_words = 0").select("id", F.col("id").alias("class_id"), F.lit(1).cast("long").alias("class_size"),
                                              F.lit(True).alias("kept"), "sha")
    return out.unionByName(alone).withColumnRenamed("id", id_col)


def near_dedup(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows of ``docs`` that stay, one of each class, columns unchanged.

    Of rows that repeat id and text one stays. A row without an id stays only if
    its class has no id, then the first text by digest; a text without words
    (null, empty) is a class of its own. An empty table gives no rows.
    """
    out = stage(docs.sparkSession, near_classes(docs, id_col, text_col), "near-classes")
    return keep_rows(docs, out.withColumnRenamed(id_col, "id").select("id", "sha", "kept"), id_col, text_col)
