import random
import re
import string

from llm_rows import ODD, frame, shipped  # noqa: F401

from loyalspark.llm import secret_scan as S

RULES = {
    "assign": (r"""(?ai)(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", lambda m: len(m[2]) >= 6),
    "access": (r"AKIA[A-Z0-9]+", lambda m: len(m[0]) >= 20),
    "hex": (r"[0-9a-f]+", lambda m: len(m[0]) >= 24),
}


def base(text):
    """The fixed patterns as stated, one after the other."""
    out = [(m.start(), k, m.end()) for k, (rx, ok) in enumerate(RULES.values()) for m in re.finditer(rx, text) if ok(m)]
    return sorted(out)


def rnd_of(rnd, alphabet, n):
    return "".join(rnd.choice(alphabet) for _ in range(n))


def test_base_against_the_rules_as_stated():
    rnd = random.Random(1)
    parts = ["token", "SECRET", "passwd", "password", "api_key", "apikey", "ſecret", "toKen", "=", ":", " ", '"', "'", "é", "AKIA",
             "ABCDEFGH01234567", "0123456789abcdef", "deadbeef", "abc", "abcdef", "=token:abcdef", "\n", "-"]
    for _ in range(4000):
        text = "".join(rnd.choice(parts) for _ in range(rnd.randint(0, 14)))
        assert S.base_spans(text) == base(text), text


def test_battery_tells_random_from_worded():
    rnd = random.Random(2)
    for encoding, alphabet in S.ENCODINGS.items():
        for n in (24, 40, 64, 200):
            p = [S.battery(rnd_of(rnd, alphabet, n), encoding) for _ in range(400)]
            assert 0.3 < sum(p) / 400 < 0.65, (encoding, n)  # about uniform
    words = ["password", "release", "backup", "server", "config", "2024", "10", "main"]
    ordinary = [S.battery("".join(rnd.choice(words) for _ in range(8)), "base36") for _ in range(200)]
    assert sum(x > 0.05 for x in ordinary) < 20


def test_false_discovery_control():
    even = [("base62", 1, cell, 50) for cell in range(S.CELLS)]
    assert S.thresholds(even) == {("base62", 1): 0.0}
    mixed = [*even, ("base62", 1, 0, 900)]  # ordinary strings sit at p near 0
    assert 0 < S.thresholds(mixed)["base62", 1] <= 0.1
    assert S.thresholds([("hex", 0, 0, 10)]) == {}


def test_frame_finds_planted_and_leaves_clean(frame):
    rnd = random.Random(3)
    alphabet = string.ascii_letters + string.digits
    keys = {i: rnd_of(rnd, alphabet, 40) + "Aa0" for i in range(100, 300)}
    rows = [(i, f"See the log.\nkey {k} end of it") for i, k in keys.items()]
    rows += [(i, f"An ordinary text about{i}thingsThatAreWritten" + "together" * 3) for i in range(400, 600)] + ODD
    got = S.find_secrets(frame(rows)).select("doc_id", S.digest("spans").alias("s")).collect()
    found = {r.doc_id: r.s for r in got}
    assert len(got) == len(rows)
    right = sum(found[i] == f"random:17:{17 + len(k)}" for i, k in keys.items())
    assert right >= 180
    assert sum(bool(found[i]) for i in range(400, 600)) <= 10
    assert not any(found[i] for i in range(1, 9))


def test_value_behind_a_name(frame):
    rnd = random.Random(4)
    alphabet = string.ascii_letters + string.digits
    names = ["auth=", "?sig=", "PRIVATE_KEY=", "pwd=", "a=b=", "="]
    keys = {i: (names[i % 6], rnd_of(rnd, alphabet, 41) + "Aa0") for i in range(100, 400)}
    got = S.find_secrets(frame([(i, f"See {n}{k}{'=' * (i % 3)} end") for i, (n, k) in keys.items()])).collect()
    right = sum([tuple(s) for s in r.spans] == [(at := 4 + len(keys[r.doc_id][0]), 3, at + 44 + r.doc_id % 3, "random")] for r in got)
    assert right >= 270
    long = S.candidates(f"{'aB3' * 8}={'cD4' * 8}==x=token=abcdef", [(32, 0, 64)])
    assert [(c["start"], c["end"]) for c in long] == [(0, 24)]


def test_encodings():
    for token, want in [("550e8400-e29b-41d4-a716-446655440000", ("hex", "550e8400e29b41d4a716446655440000")),
                        ("xoxb-2048573920-abcdefk29dk3js8f7dh", ("base36", "xoxb2048573920abcdefk29dk3js8f7dh")),
                        ("sk-proj-9f8a7b6c5d4e3f2a1b0c", ("base36", "skproj9f8a7b6c5d4e3f2a1b0c")),
                        ("ABCDEFGH-234567AB", ("base32", "ABCDEFGH234567AB")), ("aB3-xY9_" * 3, ("base64", "aB3+xY9/" * 3)),
                        ("q" * 32, ("base26", "q" * 32)), ("q" * 31, None), ("Qq" * 16, ("base52", "Qq" * 16)),
                        ("2024-01-31_123456789012", None), ("a1" * 7, None), ("----------------", None)]:
        assert S.infer_encoding(token) == want, token


def test_one_case_secrets_with_separators(frame):
    rnd = random.Random(6)
    low, hexa = string.ascii_lowercase + string.digits, "0123456789abcdef"
    make = [lambda: (f"xoxb-{rnd_of(rnd, string.digits, 10)}-", rnd_of(rnd, low, 24) + "a1"), lambda: ("sk-proj-", rnd_of(rnd, low, 30)),
            lambda: ("", "-".join(rnd_of(rnd, hexa, n) for n in (8, 4, 4, 4, 12))), lambda: ("", rnd_of(rnd, string.ascii_letters, 48)),
            lambda: ("", rnd_of(rnd, low, 18) + "a1")]
    keys = {i: make[i % 5]() for i in range(100, 600)}
    rows = [(i, f"key: {name}{k}, end") for i, (name, k) in keys.items()]
    rows += [(i, f"the release-{i}-main-server-backup-of-the-year-2024 and aVeryLongNameOfAFunctionThatHasNoDigits{'Or' * 5}") for i in range(700, 900)]
    found = {r.doc_id: r.s for r in S.find_secrets(frame(rows)).select("doc_id", S.digest("spans").alias("s")).collect()}
    for kind in range(5):
        ids = [i for i in keys if i % 5 == kind]
        assert sum(found[i] == f"random:{(at := 5 + len(keys[i][0]))}:{at + len(keys[i][1])}" for i in ids) >= 80, kind
    assert sum(bool(found[i]) for i in range(700, 900)) <= 10


def test_spans_and_empty(frame):
    text = "password = hunter2x " + "é" + "0123456789abcdef" * 2
    row = S.find_secrets(frame([(1, text), (2, None)])).orderBy("doc_id").collect()
    assert [tuple(s) for s in row[0].spans] == [(0, 0, 19, "assign"), (21, 2, 53, "hex")]
    assert row[1].spans == []
    assert S.find_secrets(frame([])).count() == 0
