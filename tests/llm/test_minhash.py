import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from tidemark.llm import graph, minhash


def shingles(text, k=4):
    words = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "").encode().split()
    if not words:
        return frozenset()
    return frozenset(tuple(words[i : i + k]) for i in range(max(1, len(words) - k + 1)))


def plain(rows, percent=80):
    """(doc_id, n_shingles, component_id, kept) by comparing all pairs of sets."""
    sets = [shingles(t) for _, t in rows]
    parent = list(range(len(rows)))

    def find(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for i in range(len(rows)):
        for j in range(i):
            if sets[i] and sets[j] and 100 * len(sets[i] & sets[j]) >= percent * len(sets[i] | sets[j]):
                parent[find(i)] = find(j)
    groups = {}
    for i, (d, _) in enumerate(rows):
        groups.setdefault(find(i), []).append(d)
    least = {k: min([x for x in v if x is not None], default=None) for k, v in groups.items()}
    return sorted([(d, len(s), least[find(i)], d == least[find(i)]) for i, ((d, _), s) in enumerate(zip(rows, sets, strict=True))], key=repr)


def found(df):
    return sorted([(r.doc_id, r.n_shingles, r.component_id, r.kept) for r in df.collect()], key=repr)


def edited(rnd, words, edits):
    out = list(words)
    for _ in range(edits):
        out[rnd.randrange(len(out))] = f"e{rnd.getrandbits(40)}"
    return out


def crowd_rows(seed):
    """A hub with spokes that are linked only through it, chains, clusters at the limit and documents that share a passage."""
    rnd = random.Random(seed)
    fresh = lambda n: [f"w{rnd.getrandbits(40)}" for _ in range(n)]
    texts = []
    hub = fresh(97)
    texts += [hub, *[edited(rnd, hub, 2) for _ in range(50)], *[edited(rnd, hub, 3) for _ in range(20)]]
    chain = fresh(120)
    for _ in range(30):
        texts.append(chain)
        chain = edited(rnd, chain, rnd.choice([1, 3, 5]))
    passage = fresh(150)
    for n in (5, 20, 60, 140):
        texts += [passage + fresh(n) for _ in range(15)]
    mixed = [passage[:100] + fresh(25) for _ in range(6)]
    texts += mixed + [edited(rnd, m, e) for m in mixed for e in (0, 1, 2, 3)]
    texts += [fresh(n) for n in (1, 2, 3, 4, 5, 200, 900)]
    # Copies whose shingles are fewer than a sketch holds.
    short = fresh(30)
    texts += [edited(rnd, short, 1) for _ in range(12)] + [short]
    rnd.shuffle(texts)
    return [(i, " ".join(t)) for i, t in enumerate(texts)]


@pytest.mark.parametrize(("seed", "longest", "members"), [(1, 8, 512), (2, 2, 8)])
def test_crowds_equal_all_pairs(documents, monkeypatch, seed, longest, members):
    monkeypatch.setattr(minhash, "LIST", longest)
    monkeypatch.setattr(minhash, "MEMBERS", members)
    rows = crowd_rows(seed)
    want = plain(rows)
    assert len({r[2] for r in want}) < len(rows) - 60
    assert found(minhash.near_duplicates(documents(rows))) == want


def test_defined_cases(documents):
    rnd = random.Random(5)
    base = [f"Word{i}" for i in range(60)]
    rows = [(9, " ".join(base)), (4, "\t".join(base).upper()), (4, " ".join(base)), (4, " ".join(base)), (12, " ".join(edited(rnd, base, 1))), (None, " ".join(base)), (None, "q r s t"), (None, "q r s t")]
    rows += [(20, None), (21, ""), (22, " \n\x0b"), (23, "a b c"), (24, "A  b c"), (25, "a b c d"), (26, "a"), (7, "x y z u v w"), (7, "other text of one id here")]
    rows += [(30, "É é ü ñ"), (31, "é é ü ñ"), (40, "x " * 60_000), (41, "x x x x"), (50, "no break a b c"), (51, "no break a b c")]
    want = [(d, n, c, (d == c) if d is not None or c is not None else True) for d, n, c, _ in plain(rows)]
    got = found(minhash.near_duplicates(documents(rows).withColumn("uid", F.lit(1)).withColumn("sketch", F.lit("s"))))
    assert got == sorted([(d, n, c, bool(k)) for d, n, c, k in want], key=repr)
    assert minhash.near_duplicates(documents([])).count() == 0


def test_other_limits(documents):
    rows = crowd_rows(7)[:100]
    assert found(minhash.near_duplicates(documents(rows), percent=50)) == plain(rows, 50)


def test_linked_sketches_share_enough():
    c = minhash.least_shared(64)
    assert 25 <= c <= 36
    assert minhash.least_shared(64, 100) == 64
    assert sum(math.comb(64, i) * 0.8**i * 0.2 ** (64 - i) for i in range(c)) <= minhash.RISK


def test_a_large_crowd(documents):
    rnd = random.Random(11)
    base = [f"w{i}" for i in range(80)]
    rows = [(i, " ".join(edited(rnd, base, 1))) for i in range(300)]
    got = minhash.near_duplicates(documents(rows, 8)).select("component_id").distinct().collect()
    assert [r.component_id for r in got] == [0]


def crowd_counts(monkeypatch, documents, rows):
    """Rows of (crowd, class) that each crowd step of a run returned, the first that of the long lists, and the result."""
    counts = []
    for name, part in (("_crowds", lambda made: made), ("_split", lambda made: made[1])):
        step = getattr(minhash, name)

        def counted(*args, step=step, part=part):
            made = step(*args)
            counts.append(part(made).count())
            return made

        monkeypatch.setattr(minhash, name, counted)
    return counts, found(minhash.near_duplicates(documents(rows)))


def test_classes_left_over_in_a_large_crowd_stand_in_few_lists(documents, monkeypatch):
    """Copies with up to 16 edited words, most too far from the text and from each other to be linked."""
    monkeypatch.setattr(minhash, "MEMBERS", 64)
    rnd = random.Random(21)
    base = [f"w{i}" for i in range(150)]
    rows = [(i, " ".join(edited(rnd, base, i % 17))) for i in range(340)]
    counts, got = crowd_counts(monkeypatch, documents, rows)
    assert got == plain(rows)
    assert counts[0] <= 1.2 * len(rows) and counts[1] <= 3 * len(rows)


def test_crowds_inside_one_another_become_one(spark):
    lists = {1: range(100, 200), 2: range(102, 199), 3: range(150, 200), 4: range(190, 260), 5: range(300, 310)}
    placed = spark.createDataFrame([(u, 50, h) for h, us in lists.items() for u in us], "uid long, n long, head long")
    assert sorted(map(tuple, minhash._inside(placed).collect())) == [(2, 1), (3, 1)]


def test_a_large_group_of_near_copies_takes_few_written_steps(documents, monkeypatch):
    """One group that is split once: contraction rounds do not grow with the group, and sizes are not written again."""
    monkeypatch.setattr(minhash, "MEMBERS", 64)
    rnd = random.Random(31)
    base = [f"w{i}" for i in range(120)]
    rows = [(i, " ".join(edited(rnd, base, i % 6))) for i in range(260)]
    written = []
    for module in (minhash, graph):
        monkeypatch.setattr(module, "cut_lineage", lambda df, cut=module.cut_lineage: written.append(1) or cut(df))
    assert found(minhash.near_duplicates(documents(rows))) == plain(rows)
    assert len(written) <= 36


def test_a_hub_takes_one_contraction(spark, monkeypatch):
    rounds = []
    monkeypatch.setattr(graph, "_normal", lambda edges, normal=graph._normal: rounds.append(1) or normal(edges))
    edges = spark.range(1, 2000).selectExpr("0L AS a", "id AS b")
    assert graph.components(edges).agg(F.count_distinct("root"), F.count("node")).collect() == [(1, 2000)]
    assert len(rounds) == 2


def test_sets_inside_a_task():
    rnd = random.Random(8)
    base = list(range(300))
    sets = [sorted(set(rnd.sample(base, rnd.choice([200, 260, 280])))) for _ in range(40)] + [[1], [1, 2], [5000]]
    root = minhash.linked_rows(np.array([len(s) for s in sets]), np.concatenate(sets), 80)
    want = plain_roots([set(s) for s in sets])
    assert root.tolist() == want and 3 < len(set(want)) < 40


def plain_roots(sets):
    root = list(range(len(sets)))
    for _ in sets:
        for i, x in enumerate(sets):
            for j, y in enumerate(sets):
                if 100 * len(x & y) >= 80 * len(x | y):
                    root[i] = min(root[i], root[j])
    return root
