import hashlib
import random

import pytest
from helpers import HARD, documents, prose

from fleetscope.llm import linededup

LINE = prose(30, 60)
ROWS = [
    *HARD, (20, f"{LINE}\nshort line\n{LINE.upper()}"), (21, f"short line\n  {LINE.replace(' ', '   ')} \nlast of all the lines here"), (22, LINE),
    (23, "..., \n ?! " + prose(31, 20)), (24, "word " * 500), (25, "你好世界，" * 90 + "再见。"), (26, "再见，" + "你好世界，" * 90), (27, "x" * 100_000), (28, "x" * 100_000),
]


def brute(rows, min_words, min_bytes):
    apart = " \t\v\f\r。！？、，；："
    low = lambda x: "".join(c.lower() if c.isascii() else c for c in x)

    def units(t):
        """(start, end, normalised) by a walk over the characters."""
        found, at, unit, start, before = [], 0, [], 0, 0
        while at < len(t):
            if t[at] == "\n" or t[at] in apart:
                if t[at] == "\n":
                    before = 0
                    if unit:
                        found.append((start, unit))
                        unit = []
                at += 1
                continue
            z = at
            while z < len(t) and t[z] != "\n" and t[z] not in apart:
                z += 1
            start = start if unit else at
            unit.append(low(t[at:z]).strip(".!?,;:"))
            here = int(hashlib.md5(unit[-1].encode()).hexdigest()[:8], 16)
            if len(unit) == 24 or (before + here) % 6 == 0:
                found.append((start, unit))
                unit = []
            before = here
            at = z
        if unit:
            found.append((start, unit))
        ends = [*(s for s, _ in found[1:]), len(t)]
        return [(s, z, " ".join(u), len(u)) for (s, u), z in zip(found, ends, strict=True)] if found else []

    doc = lambda t: int(hashlib.md5(t.encode()).hexdigest()[:15], 16)
    first, out = {}, []
    for i, t in rows:
        for k, (_, _, n, _) in enumerate(units(t or "")):
            first[n] = min(first.get(n, (9,)), (i is not None, i or 0, doc(t), k))
    for i, t in rows:
        if t is None:
            out.append((i, None, 0, [], []))
            continue
        us = units(t)
        late = [first[n] < (i is not None, i or 0, doc(t), k) for k, (_, _, n, _) in enumerate(us)]
        gone, k = [], 0
        while k < len(us):
            z = k
            while z < len(us) and late[z]:
                z += 1
            if z > k and (sum(m for *_, m in us[k:z]) >= min_words or sum(len(n.encode()) for _, _, n, _ in us[k:z]) >= min_bytes):
                gone.append((k, z))
            k = max(z, k + 1)
        removed = [(us[a][0], us[z - 1][1]) for a, z in gone]
        edges = [0, *(x for s in removed for x in s), len(t)]
        kept = [(a, z) for a, z in zip(edges[::2], edges[1::2], strict=True) if z > a]
        out.append((i, "".join(t[a:z] for a, z in kept), sum(z - a for a, z in gone), removed, kept))
    return sorted(out, key=str)


@pytest.mark.parametrize(("words", "size", "held"), [(linededup.MIN_WORDS, linededup.MIN_BYTES, linededup.HELD), (4, 40, 5), (1, 1, 50), (12, 10**6, 10**6)])
def test_equal_to_brute_force(spark, monkeypatch, words, size, held):
    monkeypatch.setattr(linededup, "HELD", held)
    cleaned = linededup.clean(documents(spark, ROWS).repartition(4), words, size)
    report = cleaned.columns[-1]
    assert report == "dedup_" and cleaned.columns[:-1] == documents(spark, []).columns
    got = [(r.doc_id, r.text, r[report].n_removed, [tuple(x) for x in r[report].removed], [tuple(x) for x in r[report].kept]) for r in cleaned.collect()]
    assert sorted(got, key=str) == brute(ROWS, words, size)


def test_a_passage_goes_wherever_it_is_put_in_and_common_lines_stay(spark):
    r, common = random.Random(3), prose(40, 13)
    rows = []
    for k in range(60):
        w = prose(100 + k, 200).split(" ")
        if k % 3 == 0:  # the passage, in the middle of a sentence
            at = r.randrange(20, 180)
            w[at:at] = prose(41, 200).split(" ")[70:121]
        rows.append((k, common + "\n" + " ".join(w)))
    passage = prose(41, 200).split(" ")[85:105]
    for row in linededup.clean(documents(spark, rows)).collect():
        if row.doc_id % 3 or row.doc_id == 0:
            assert row.text == rows[row.doc_id][1]
        else:
            assert " ".join(passage) not in row.text and row.text.startswith(common)
            assert len(row.text.split()) <= 213 + 22


def test_empty_table(spark):
    assert linededup.clean(documents(spark, [])).count() == 0
