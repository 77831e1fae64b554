import zlib
from collections import Counter

from helpers import HARD, documents
from hypothesis import given, settings
from hypothesis import strategies as st

from fleetscope.llm import sharding


def brute(sizes, capacity):
    """Best fit by looking at every bin."""
    room, out = [], []
    for s in sizes:
        fit = [(r, b) for b, r in enumerate(room) if r >= s]
        b = min(fit)[1] if fit else len(room)
        if not fit:
            room.append(capacity)
        room[b] -= s
        out.append(b)
    return out


@settings(max_examples=200, deadline=None)
@given(st.lists(st.integers(1, 60), max_size=60))
def test_tree_packs_as_a_scan_does(sizes):
    sizes.sort(reverse=True)
    assert sharding.pack(sizes, 60) == brute(sizes, 60)
    if sizes:
        bins = sharding.even_bins(sizes, 4)
        load = Counter()
        for s, b in zip(sizes, bins, strict=True):
            load[b] += s
        assert max(load) < 4 and max(load.values()) <= max(sizes[0], -(-sum(sizes) // 4)) + sizes[0]


def test_all_rows_placed_groups_whole_slots_gapless(spark):
    for rows in (HARD, [], [(i, "same") for i in range(30)] + HARD, [(i, f"text {i}" * (i % 7)) for i in range(400)]):
        got = sharding.shard_documents(documents(spark, rows), grain=16, cells=4).collect()
        assert len(got) == len(rows)
        assert Counter((r.doc_id, r.size, r.text_crc32) for r in got) == Counter(
            (i, len((t or "").encode()) + 1, zlib.crc32((t or "").encode())) for i, t in rows)
        for s in range(8):
            assert sorted(r.slot for r in got if r.shard == s) == list(range(sum(r.shard == s for r in got)))
        of = {}
        for r in got:
            of.setdefault((r.size, r.text_crc32), set()).add(r.shard)
        assert all(len(x) == 1 for x in of.values())


def test_bytes_are_even_with_bundles(spark):
    rows = [(i, "x" * (i % 50)) for i in range(3000)] + [(10_000 + i, f"{i}" * 9) for i in range(3000)]
    got = sharding.shard_documents(documents(spark, rows), grain=32, cells=4).groupBy("shard").sum("size").collect()
    sizes = [r[1] for r in got]
    assert len(sizes) == 8 and max(sizes) - min(sizes) < 0.02 * sum(sizes) / 8


def test_fixed_capacity(spark):
    got = sharding.shard_documents(documents(spark, [(i, "y" * (i % 40) + str(i)) for i in range(300)]), grain=64, capacity=500).groupBy("shard").sum("size").collect()
    assert max(r[1] for r in got) <= 500 and len(got) <= -(-sum(r[1] for r in got) // 500) + 1
