import heapq
import zlib
from collections import defaultdict

import numpy as np
import pytest
from .llm_cases import ODD
from ordermart.llm.sharding import group_shards, schedule, shard_documents


def brute(sizes, shards):
    heap, placed = [(0, s) for s in range(shards)], {}
    heapq.heapify(heap)
    for k in sorted(range(len(sizes)), key=lambda k: (-sizes[k], k)):
        load, shard = heapq.heappop(heap)
        placed[k] = shard
        heapq.heappush(heap, (load + sizes[k], shard))
    return [placed[k] for k in range(len(sizes))]


def test_schedule_is_longest_first():
    sizes = np.random.default_rng(1).integers(1, 1000, 500)
    assert schedule(sizes, 7).tolist() == brute(sizes.tolist(), 7)


@pytest.mark.parametrize("grain", [1, 20, 1000])
def test_shards_are_even_and_keep_groups(documents, grain):
    rng = np.random.default_rng(2)
    rows = [(i, "x" * int(rng.integers(0, 400)) + str(i % 900)) for i in range(1500)] + ODD[:-4]
    got = shard_documents(documents(*rows), shards=5, grain=grain).collect()
    assert len(got) == len(rows)
    loads, slots, of_text = defaultdict(int), defaultdict(list), defaultdict(set)
    texts = defaultdict(set)
    for i, t in rows:
        texts[zlib.crc32((t or "").encode())].add(t or "")
    for r in got:
        loads[r.shard] += r.size
        slots[r.shard].append(r.slot)
        of_text[r.text_crc32].add(r.shard)
        assert r.law == "bytes" and r.grown_shard is None
    assert all(len(s) == 1 for k, s in of_text.items() if len(texts[k]) == 1)
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())
    largest = max(len((t or "").encode()) + 8 for _, t in rows) * 3
    assert max(loads.values()) - min(loads.values()) <= max(largest, sum(loads.values()) / (5 * grain))
    assert sorted((r.doc_id is None, r.doc_id or 0, r.size) for r in got) == sorted(
        (i is None, i or 0, len((t or "").encode()) + 8) for i, t in rows
    )


def test_hot_group_and_empty_table(documents):
    rows = [(i, "copy" if i % 3 else f"text {i}") for i in range(300)]
    got = shard_documents(documents(*rows), shards=4).collect()
    assert len({r.shard for r in got if r.doc_id % 3}) == 1
    assert shard_documents(documents(*rows).where("false"), shards=4).collect() == []


def test_large_groups_are_scheduled_like_the_whole(spark):
    sizes = [int(x) for x in np.random.default_rng(3).permutation(2000)[:60] + 1]
    groups = spark.createDataFrame([(bytes([k]), s) for k, s in enumerate(sizes)], "key binary, bytes long")
    got = {r.key[0]: r.shard for r in group_shards(groups, 6).collect()}
    assert [got[k] for k in range(60)] == brute(sizes, 6)
