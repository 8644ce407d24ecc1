"""The methods by which answers come, checked against brute force and by the work they do."""

import random

import numpy as np
import pyarrow as pa
import pytest

from ratefuse.llm import jaccard, packing
from ratefuse.llm.components import components


def family(rng, members, size, changed, shift=0):
    """Sets around one set, each with some of its shingles replaced by others."""
    base = rng.sample(range(shift, shift + 10**6), size)
    sets = []
    for _ in range(members):
        own = set(base) - set(rng.sample(base, changed))
        own |= {shift + 10**6 + rng.randrange(10**6) for _ in range(changed)}
        sets.append(sorted(own))
    return sets


def columns_of(sets):
    names = {s: k for k, s in enumerate(sorted(set().union(*sets)))} if sets else {}
    return [np.array([names[s] for s in own], np.int64) for own in sets], len(names)


def postings_of(columns, width):
    flat = np.concatenate([*columns, np.zeros(0, np.int64)])
    row = np.repeat(np.arange(len(columns)), [len(c) for c in columns])
    return jaccard.Postings(flat, row, len(columns), width)


@pytest.mark.parametrize("cells", [10, 5_000, 4_000_000])
def test_derived_overlaps_are_exact(monkeypatch, cells):
    monkeypatch.setattr(jaccard, "STRIP_CELLS", cells)
    rng = random.Random(4)
    sets = family(rng, 70, 60, 4) + family(rng, 20, 25, 9, 500) + [[], [7], [7, 8], sorted(range(90))]
    rng.shuffle(sets)
    columns, width = columns_of(sets)
    left = rng.sample(range(len(sets)), 50)
    seen = []
    for places, common in jaccard.derived_overlaps(
        [columns[i] for i in left], postings_of(columns, width)
    ):
        for place, row in zip(places, common):
            seen.append(place)
            want = [len(set(sets[left[place]]) & set(other)) for other in sets]
            assert row.tolist() == want
    assert sorted(seen) == list(range(50))
    assert list(jaccard.derived_overlaps([], postings_of([], 0))) == []


def test_similar_sets_look_up_only_what_differs():
    sets = family(random.Random(5), 64, 1000, 10)
    columns, width = columns_of(sets)
    postings = postings_of(columns, width)
    list(jaccard.derived_overlaps(columns, postings))
    # The first set wholly, then each one's own changes; all 64 sets hold 64 000 shingles.
    assert 1000 <= postings.met <= 1000 + 64 * 4 * 10


@pytest.mark.parametrize("chunks", [1, 2])
def test_links_of_a_block_join_what_is_linked(chunks):
    rng = random.Random(6)
    sets = family(rng, 40, 50, 1) + family(rng, 40, 50, 5, 400)
    chunk = [rng.randrange(chunks) for _ in sets]
    table = pa.table({
        "id": pa.array(range(len(sets)), pa.int64()),
        "component": pa.array(range(len(sets)), pa.int64()),
        "chunk": pa.array(chunk, pa.int32()), "s": pa.array(sets, pa.list_(pa.int64())),
    })
    got = jaccard._cell((9, 10))((), table)
    found = list(zip(got["a"].to_pylist(), got["b"].to_pylist()))
    linked = {
        (i, j) for i in range(len(sets)) for j in range(i)
        if {chunk[i], chunk[j]} == {0, chunks - 1}
        and 10 * len(set(sets[i]) & set(sets[j])) >= 9 * len(set(sets[i]) | set(sets[j]))
    }
    assert linked and all((max(p), min(p)) in linked for p in found)

    def classes(pairs):
        of = {i: i for i in range(len(sets))}
        for a, b in pairs:
            p, q = of[a], of[b]
            of = {k: min(p, q) if v in (p, q) else v for k, v in of.items()}
        return of

    assert classes(found) == classes(linked)


def laid_out(sizes, length=1024):
    packer, closed = packing.Packer(length), []
    for k, n in enumerate(sizes):
        whole = packer.add((k, 0, np.arange(n, dtype="<u4").tobytes(), n), n)
        closed += [whole] if whole else []
    kept = len(closed)
    return packer, kept, closed + list(packer.rest())


@pytest.mark.parametrize("sizes", [[], [1], [512], [1023], [700, 700], [3] * 5])
def test_rest_of_few_pieces(sizes):
    _, _, sequences = laid_out(sizes)
    got = sorted((k, start, ids) for w in sequences for k, start, ids, _ in w)
    text = {k: b"" for k in range(len(sizes))}
    for k, start, ids in got:
        assert start == len(text[k]) // 4 and ids
        text[k] += ids
    assert text == {k: np.arange(n, dtype="<u4").tobytes() for k, n in enumerate(sizes)}


def test_few_tokens_leave_their_place():
    rng = random.Random(7)
    sizes = [min(1023, 1 + int(rng.expovariate(1 / 300))) for _ in range(4000)]
    packer, kept, sequences = laid_out(sizes)
    fill = [sum(len(ids) // 4 for _, _, ids, _ in w) for w in sequences]
    assert sum(fill) == sum(sizes) and all(f <= 1024 and f & (f - 1) == 0 for f in fill)
    assert kept > 100 and packer.moved < 0.05 * sum(sizes)
    # Only the end of a sequence that was filled up, or laid out last, cuts a document.
    cut = len([p for w in sequences for p in w]) - len(sizes)
    assert cut <= len(sequences) - kept


def test_components_of_a_path_and_odd_edges(spark):
    path = [(k * 37 % 101, (k + 1) * 37 % 101) for k in range(90)]
    edges = [*path, (500, 500), (None, 3), (700, 600), (600, 700), (600, 700)]
    got = {r.id: r.component for r in components(spark.createDataFrame(edges, "a long, b long")).collect()}
    nodes = {n for e in path for n in e}
    assert got == dict.fromkeys(nodes, min(nodes)) | {600: 600, 700: 600}
    assert components(spark.createDataFrame([], "a long, b long")).count() == 0
