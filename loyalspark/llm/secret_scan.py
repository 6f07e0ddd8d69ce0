"""Secret scans: fixed patterns, then a battery of randomness tests.

Pattern spans (``assign``, ``access``, ``hex``) are always reported. Every
other run of 16 or more characters of ``[A-Za-z0-9+/_=-]`` is a candidate, split
at ``=`` that is not padding at its end (a name and its value are two
candidates): its encoding is inferred from its alphabet, and three tests say how
well it fits random symbols of that encoding -- the chi-squared statistic of
alphabet uniformity, the runs test about the middle of the alphabet, the lag-one
serial correlation. Fisher's method joins them to one p-value, which is uniform
for truly random strings and near 0 for text.

``-`` and ``_`` are symbols where letters of both cases stand beside them and
separators otherwise: each piece that is long enough is a candidate
(``xoxb-20485-abc..``); without such a piece all are one (UUIDs). Letters alone are tested from 32 symbols on: shorter ones leave the tests no
power to tell them from words. Digits alone are numbers and have no encoding.

Short strings give the tests little power, so discovery is controlled for
each encoding and band of lengths: over the whole corpus, p-values above one
half estimate how many random strings a band holds, hence how many of those
accepted above a threshold are not random; the lowest threshold is taken at
which that share is at most ``rate``. The histogram behind it has a fixed
number of cells, so it is bounded at any corpus size.
"""

from __future__ import annotations

import math
import re
from bisect import bisect_left
from itertools import accumulate

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import slices, stage, text_or_empty, utf8

# The contract's patterns.
ASSIGN = re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.I | re.A)
ACCESS = re.compile(r"AKIA[A-Z0-9]{16,}")
HEX = re.compile(r"[0-9a-f]{24,}")
KINDS = ("assign", "access", "hex", "random")

#: Symbols that a candidate needs: at all, and if all are letters.
LEAST, LETTERS = 16, 32
CANDIDATE = re.compile(r"(?<![A-Za-z0-9+/_=-])[A-Za-z0-9+/_=-]{%d,}" % LEAST)
#: The parts of a candidate: names and values, the last with its padding.
PART = re.compile(r"[^=]{%d,}(?:=+\Z)?" % LEAST)
SEPARATORS = re.compile("[-_]+")
PIECE = re.compile("[^-_]{%d,}=*" % LEAST)
#: Encodings by alphabet size; symbols count by their place in the alphabet.
ENCODINGS = {
    "hex": "0123456789abcdef",
    "base26": "abcdefghijklmnopqrstuvwxyz",
    "base32": "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567",
    "base36": "0123456789abcdefghijklmnopqrstuvwxyz",
    "base52": "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz",
    "base62": "0123456789ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz",
    "base64": "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/",
}
_PLACE = {e: {c: i for i, c in enumerate(a)} for e, a in ENCODINGS.items()}
#: Lower ends of the bands of lengths, and cells of the p-value histogram.
BANDS = (LEAST, 20, 24, 32, 48, 64, 128)
CELLS = 20


def infer_encoding(token: str) -> tuple[str, str] | None:
    """(smallest encoding that spells the token, its symbols); None for numbers
    and for what is too short to be tested."""
    symbols = SEPARATORS.sub("", token)
    lower, upper = re.search("[a-z]", symbols), re.search("[A-Z]", symbols)
    digit = re.search("[0-9]", symbols)
    if not lower and not upper or len(symbols) < (LEAST if digit else LETTERS):
        return None
    if re.search("[+/]", symbols):
        return "base64", token.replace("-", "+").replace("_", "/")
    if not digit:
        return ("base52", symbols) if lower and upper else ("base26", symbols.lower())
    if lower and upper:
        return ("base62", token) if symbols == token else ("base64", token.replace("-", "+").replace("_", "/"))
    if re.fullmatch("[0-9a-f]+|[0-9A-F]+", symbols):
        return "hex", symbols.lower()
    return ("base32", symbols) if re.fullmatch("[A-Z2-7]+", symbols) else ("base36", symbols.lower())


def readings(part: str) -> list[tuple[int, int, str, str]]:
    """(start, end, encoding, symbols) of what is tested of a candidate."""
    if SEPARATORS.search(part) and not (re.search("[a-z]", part) and re.search("[A-Z]", part)):
        pieces = [(m.start(), m.end(), read) for m in PIECE.finditer(part) if (read := infer_encoding(m[0].rstrip("=")))]
        if pieces:
            return [(a, b, *read) for a, b, read in pieces]
    read = infer_encoding(part.rstrip("="))
    return [(0, len(part), *read)] if read else []


def battery(symbols: str, encoding: str) -> float:
    """Joint p-value of the three tests for random symbols of the encoding."""
    place, k = _PLACE[encoding], len(ENCODINGS[encoding])
    x = np.array([place[c] for c in symbols], float)
    n = len(x)
    if n < 2:
        return 0.0

    def tail(z: float) -> float:
        return math.erfc(abs(z) / math.sqrt(2))

    counts = np.bincount(x.astype(int), minlength=k)
    chi = k / n * float((counts ** 2).sum()) - n
    # exact mean and variance of the statistic also where cells are nearly empty
    p_chi = 0.5 * math.erfc((chi - (k - 1)) / math.sqrt(2 * (k - 1) * (1 - 1 / n)) / math.sqrt(2))
    up = x >= k / 2
    n1 = int(up.sum())
    n2 = n - n1
    if n1 and n2:
        runs = 1 + int((up[1:] != up[:-1]).sum())
        mean = 1 + 2 * n1 * n2 / n
        var = (mean - 1) * (mean - 2) / (n - 1)
        p_runs = tail((runs - mean) / math.sqrt(var)) if var > 0 else 1.0
        d = x - x.mean()
        r = float((d[1:] * d[:-1]).sum() / (d * d).sum())
        p_serial = tail((r + 1 / n) * math.sqrt(n))
    else:
        p_runs = p_serial = 2.0 ** (1 - n)
    half = -sum(math.log(max(p, 1e-300)) for p in (p_chi, p_runs, p_serial))
    return min(1.0, math.exp(-half) * (1 + half + half * half / 2))  # chi-squared, 6 degrees


def base_spans(text: str) -> list[tuple[int, int, int]]:
    """(start, kind, end) of the fixed patterns, leftmost non-overlapping per
    kind; too short ones are dropped after matching."""
    out = []
    folded = text.lower()
    if any(w in folded for w in ("passw", "secret", "token", "key")):
        out = [(m.start(), 0, m.end()) for m in ASSIGN.finditer(text) if len(m[2]) >= 6]
    if "AKIA" in text:
        out += [(m.start(), 1, m.end()) for m in ACCESS.finditer(text)]
    out += [(m.start(), 2, m.end()) for m in HEX.finditer(text)]
    return sorted(out)


def candidates(text: str, base: list[tuple[int, int, int]]) -> list[dict]:
    out = []
    starts = [s for s, _, _ in base]
    reach = list(accumulate((e for _, _, e in base), max))
    for m in CANDIDATE.finditer(text):
        for part in PART.finditer(m[0]):
            at = m.start() + part.start()
            for start, end, encoding, symbols in readings(part[0]):
                k = bisect_left(starts, at + end)
                if k and reach[k - 1] > at + start:
                    continue
                band = sum(len(symbols) >= b for b in BANDS) - 1
                out.append({"start": at + start, "end": at + end, "encoding": encoding, "band": band,
                            "p": battery(symbols, encoding)})
    return out


_SPAN = pa.struct([("start", pa.int64()), ("kind", pa.int32()), ("end", pa.int64())])
_CAND = pa.struct([("start", pa.int64()), ("end", pa.int64()), ("encoding", pa.string()), ("band", pa.int32()),
                   ("p", pa.float64())])


def _scan(batches):
    for b in batches:
        _, offsets = utf8(b.column("text"))
        for lo, hi in slices(offsets):
            base, cand = [], []
            for text in b.column("text").slice(lo, hi - lo).to_pylist():
                found = base_spans(text)
                base.append([{"start": s, "kind": k, "end": e} for s, k, e in found])
                cand.append(candidates(text, found))
            yield pa.RecordBatch.from_arrays(
                [b.column("id").slice(lo, hi - lo), pa.array(base, pa.list_(_SPAN)), pa.array(cand, pa.list_(_CAND))],
                names=["id", "base", "cand"])


def thresholds(cells: list, rate: float = 0.05) -> dict[tuple[str, int], float]:
    """(encoding, band) -> lowest accepted p, from (encoding, band, cell, n)
    rows; bands in which nothing can be accepted at that rate are left out."""
    out = {}
    by: dict[tuple[str, int], list[int]] = {}
    for encoding, band, cell, n in cells:
        by.setdefault((encoding, band), [0] * CELLS)[cell] += n
    for key, h in by.items():
        random = min(sum(h), 2 * sum(h[CELLS // 2:]))
        for cell in range(CELLS):
            accepted = sum(h[cell:])
            if accepted and accepted - random * (1 - cell / CELLS) <= rate * accepted:
                out[key] = cell / CELLS
                break
    return out


def find_secrets(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", rate: float = 0.05) -> DataFrame:
    """(id, spans) for every row; spans are (start, kind, end, name) in code
    points, end exclusive, by start and then kind.

    Null and empty texts have none; rows that repeat are each scanned; texts of
    any length are scanned whole, in slices; an empty table gives no rows; other
    columns are not looked at.
    """
    src = docs.select(F.col(id_col).alias("id"), text_or_empty(text_col).alias("text"))
    kind = src.schema["id"].dataType.simpleString()
    found = stage(docs.sparkSession, src.mapInArrow(_scan, (
        f"id {kind}, base array<struct<start: long, kind: int, end: long>>, "
        "cand array<struct<start: long, end: long, encoding: string, band: int, p: double>>")), "secrets")
    cells = (found.select(F.explode("cand").alias("c"))
             .groupBy("c.encoding", "c.band", F.least(F.floor(F.col("c.p") * CELLS), F.lit(CELLS - 1)).cast("int").alias("cell"))
             .count().collect())  # at most encodings x bands x cells rows
    accept = thresholds([tuple(r) for r in cells], rate)
    ok = F.lit(False)
    cand = F.col("cand")

    def passes(c):
        test = ok
        for (encoding, band), p in accept.items():
            test = test | ((c["encoding"] == encoding) & (c["band"] == band) & (c["p"] >= p))
        return test

    more = F.transform(F.filter(cand, passes),
                       lambda c: F.struct(c["start"].alias("start"), F.lit(3).alias("kind"), c["end"].alias("end")))
    names = F.array(*[F.lit(k) for k in KINDS])
    spans = F.transform(F.array_sort(F.concat("base", more)), lambda s: F.struct(
        s["start"].alias("start"), s["kind"].alias("kind"), s["end"].alias("end"),
        F.element_at(names, s["kind"] + 1).alias("name")))
    return found.select(F.col("id").alias(id_col), spans.alias("spans"))


def digest(spans):
    """kind:start:end of each span, comma-joined."""
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["name"], s["start"], s["end"])), ",")
