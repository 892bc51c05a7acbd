import hashlib
import random
from collections import Counter

import numpy as np
import pytest
from ordermart.llm import suffixes as x

from .llm_cases import ODD


def windows(data, length):
    return [data[k : k + length] for k in range(len(data) - length + 1)]


def brute(rows, length):
    data = [(t or "").encode() for _, t in rows]
    count = Counter(w for d in data for w in windows(d, length))
    out = []
    for (i, _), d in zip(rows, data):
        gone = bytearray(len(d))
        for k, w in enumerate(windows(d, length)):
            if count[w] > 1:
                gone[k : k + length] = b"\x01" * length
        kept = bytes(b for b, g in zip(d, gone) if not g)
        spans = sum(g and not (k and gone[k - 1]) for k, g in enumerate(gone))
        out.append((i, len(d), sum(gone), spans, hashlib.sha256(kept).hexdigest()))
    return sorted(out, key=str)


@pytest.mark.parametrize("seed", range(20))
def test_starts_in_the_transform(seed):
    rng = random.Random(seed)
    length = rng.choice([1, 2, 3, 5, 8, 13, 20])
    letters = rng.choice([b"ab", b"abc", bytes(range(97, 123)), b"\x00\x01\xffa"])
    make = lambda n: bytes(rng.choice(letters) for _ in range(n))
    base = make(60)
    texts = [make(rng.randint(0, 20)) + base[a : a + 30] + make(rng.randint(0, 20)) for a in rng.sample(range(60), 6)]
    times = np.array([rng.choice([1, 1, 2]) for _ in texts])
    count = Counter()
    for t, n in zip(texts, times):
        for w in windows(t, length):
            count[w] += int(n)
    expected = [[k for k, w in enumerate(windows(t, length)) if count[w] > 1] for t in texts]
    assert [g.tolist() for g in x.repeated_starts(texts, times, length)] == expected


def test_borders_are_those_of_the_common_prefixes():
    data = np.frombuffer(b"mississippi$banana$", np.uint8).astype(np.int16)
    data = np.where(data == ord("$"), 0, data)
    order = x.sorted_suffixes(data, 32)
    text = data.tolist()
    for length in (1, 2, 3, 4):
        border = x.prefix_borders(data, order, length)
        for k in range(1, len(order)):
            a, b = text[order[k - 1] :][:length], text[order[k] :][:length]
            if 0 not in a and 0 not in b and len(a) == len(b) == length:
                assert border[k] == (a != b)


def mixed(seed):
    rng = random.Random(seed)
    make = lambda n: "".join(rng.choice("abcdé \n") for _ in range(n))
    shared = [make(rng.randint(10, 120)) for _ in range(5)]
    rows = [(k, make(rng.randint(0, 60)) + rng.choice(shared) + make(rng.randint(0, 60))) for k in range(40)]
    rows += [(90, shared[0] * 3), (91, "a" * 200), (92, rows[5][1]), (93, rows[5][1])]
    return rows + [(i, t if t is None or len(t) < 999 else t[:300]) for i, t in ODD]


@pytest.mark.parametrize("many", [1024, 0])
@pytest.mark.parametrize("seed", [1, 2])
def test_against_brute_force(documents, monkeypatch, seed, many):
    monkeypatch.setattr(x, "MANY", many)
    rows = mixed(seed)
    got = x.deduplicate_bytes(documents(*rows), length=20, gram=8).collect()
    assert sorted((tuple(r)[:5] for r in got), key=str) == brute(rows, 20)
    texts = Counter((i, t or "") for i, t in rows)
    for r in got:
        assert sum(part.length for part in r.removed) == r.n_removed and len(r.removed) == r.n_spans
        # The text and the removed runs make up one of the texts of that id.
        for i, text in texts:
            data, at, kept = text.encode(), 0, b""
            for part in r.removed:
                kept += data[at : part.start]
                at = part.start + part.length
            kept += data[at:]
            if i == r.doc_id and len(data) == r.n_bytes and kept.decode("utf-8", "replace") == r.text:
                break
        else:
            raise AssertionError(r)


def test_long_texts_and_empty_table(documents):
    rng = random.Random(3)
    long = "".join(rng.choice("abcdefgh") for _ in range(1_300_000))
    rows = [(1, long), (2, "xx" + long[700_000:701_000] + "yy"), (3, long[5:405] + "|" + long[1_299_000:])]
    got = {r.doc_id: tuple(r)[1:4] for r in x.deduplicate_bytes(documents(*rows)).collect()}
    assert got == {1: (1_300_000, 2400, 3), 2: (1004, 1000, 1), 3: (1401, 1400, 2)}
    assert x.deduplicate_bytes(documents(*rows).where("false")).collect() == []
