import random

import numpy as np
import pytest
import xxhash

from tidemark.llm import simhash


def plain_print(text):
    words = (text or "").encode().lower().split()
    if not words:
        return 0
    grams = [b" ".join(words[i : i + 3]) for i in range(max(1, len(words) - 2))]
    hashes = [xxhash.xxh64_intdigest(g, 42) for g in grams]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def plain_components(ids, prints, distance=2):
    parent = list(range(len(ids)))

    def find(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for i in range(len(ids)):
        for j in range(i):
            if (prints[i] ^ prints[j]).bit_count() <= distance:
                parent[find(i)] = find(j)
    groups = {}
    for i in range(len(ids)):
        groups.setdefault(find(i), []).append(ids[i])
    least = {k: min([x for x in v if x is not None], default=None) for k, v in groups.items()}
    return [least[find(i)] for i in range(len(ids))]


def signed(x):
    return x - (1 << 64) if x >= 1 << 63 else x


@pytest.mark.parametrize("distance", [0, 1, 2])
@pytest.mark.parametrize("crowded", [2, 64])
def test_links_give_the_components_of_all_pairs(spark, monkeypatch, distance, crowded):
    monkeypatch.setattr(simhash, "CROWDED", crowded)
    rnd = random.Random(distance)
    prints = {0}
    for _ in range(25):
        x = rnd.getrandbits(64)
        for _ in range(rnd.randint(1, 12)):
            prints.add(x)
            x ^= 1 << rnd.randrange(64)
            if rnd.random() < 0.4:
                x ^= 1 << rnd.randrange(64)
    prints = sorted(prints)
    frame = spark.createDataFrame([(signed(p),) for p in prints], "print long").repartition(4)
    edges = [(r.a % (1 << 64), r.b % (1 << 64)) for r in simhash.links(frame, distance).collect()]
    assert all((a ^ b).bit_count() <= distance for a, b in edges)
    from tidemark.llm.graph import components

    roots = {r.node: r.root for r in components(simhash.links(frame, distance)).collect()}
    got = [roots.get(signed(p), signed(p)) for p in prints]
    want = plain_components(list(range(len(prints))), prints, distance)
    assert len(set(zip(got, want, strict=True))) == len(set(got)) == len(set(want))


def test_a_long_chain_is_one_component(spark):
    from tidemark.llm.graph import components

    edges = spark.createDataFrame([(i, i + 1) for i in range(300)] + [(1000, 2000)], "a long, b long")
    found = components(edges).groupBy("root").count().collect()
    assert sorted(r["count"] for r in found) == [2, 301]


def test_fingerprints_and_components(documents):
    rnd = random.Random(3)
    words = [f"Word{i}" for i in range(300)]
    rows = []
    for i in range(40):
        base = [rnd.choice(words) for _ in range(rnd.choice([0, 1, 2, 3, 40, 200]))]
        rows.append((100 - i, " ".join(base)))
        if i % 3 == 0 and base:
            near = list(base)
            near[rnd.randrange(len(near))] = "edited"
            rows.append((200 + i, "\t ".join(near)))
            rows.append((300 + i, " ".join(base).upper()))
    rows += [(500, None), (501, ""), (502, "   "), (None, "a b c"), (7, "a b c"), (7, "a b c"), (503, "É é ü"), (504, "x " * 60_000)]
    got = sorted([(r.doc_id, r.print % (1 << 64), r.component_id) for r in simhash.near_duplicates(documents(rows)).collect()], key=repr)
    prints = [plain_print(t) for _, t in rows]
    least = plain_components([d for d, _ in rows], prints)
    assert got == sorted([(d, p, c) for (d, _), p, c in zip(rows, prints, least, strict=True)], key=repr)
    assert simhash.near_duplicates(documents([])).count() == 0


def test_thresholds_follow_the_general_pigeonhole():
    costs = [[10.0, 20.0, 40.0], [1000.0, 2000.0, 4000.0], [10.0, 25.0, 60.0]]
    assert simhash.allocate(costs, 2) == [1, -1, 0]
    for row in ([[1.0, 9, 9]] * 3, [[9.0, 1, 1]] * 4):
        assert sum(simhash.allocate(row, 2)) == 2 - len(row) + 1


def test_correlated_bits_share_a_part():
    rnd = np.random.default_rng(1)
    bits = rnd.integers(0, 2, (2000, 64)).astype(float)
    bits[:, 40] = bits[:, 3]
    masks = simhash.group_bits(bits.T @ bits, 2000, 3)
    assert sum(masks) == (1 << 64) - 1
    assert any(m >> 3 & 1 and m >> 40 & 1 for m in masks)


def test_one_document_of_each_group_stays(documents, rows):
    data = [(1, "a b c d"), (2, "A b C d"), (2, "A b C d"), (None, None), (None, ""), (3, "q r s t u v"), (3, "other text altogether here"), (4, "other text altogether here")]
    kept = simhash.keep_one(documents(data))
    assert rows(kept, "doc_id", "text") == sorted([(1, "a b c d"), (None, None), (3, "q r s t u v"), (3, "other text altogether here")], key=repr) or rows(
        kept, "doc_id", "text"
    ) == sorted([(1, "a b c d"), (None, ""), (3, "q r s t u v"), (3, "other text altogether here")], key=repr)
    assert kept.columns == documents(data).columns
