import hashlib
import pickle
import random
import re

from tidemark.llm import decontaminate

WORD = re.compile("[^\x00-\x2f\x3a-\x60\x7b-\x7f]+")


def low(text):
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")


def plain(docs, items, window=10):
    out = []
    for doc_id, text in docs:
        words, hit, found = WORD.findall(low(text)), set(), set()
        for item_id, item in items:
            own = WORD.findall(low(item))
            for gram in {tuple(own[i : i + window]) for i in range(max(1, len(own) - window + 1))} if own else ():
                for s in range(len(words) - len(gram) + 1):
                    if tuple(words[s : s + len(gram)]) == gram:
                        hit.update(range(s, s + len(gram)))
                        found.add(str(item_id))
        digest = hashlib.sha256(",".join(sorted(found)).encode()).hexdigest()
        out.append((doc_id, len(words), len(hit), len(found), digest, bool(hit)))
    return sorted(out, key=repr)


ITEM = "The Quick, brown-fox 42 jumps óver the lazy dog Twice today and then sleeps"
ITEMS = [(10, ITEM), (9, "short answer"), (9, "short answer"), (8, None), (7, " .,; "), (6, "the quick brown fox 42 jumps óver the lazy dog"), (5, "aa aa")]
DOCS = [
    (1, f"Before. {ITEM.upper().replace('Ó', 'ó')}! After"),
    (2, "x short\n\nANSWER, short answerx"),
    (3, None),
    (4, ""),
    (5, "quick brown fox 42 jumps óver the lazy dog twice; and quick brown fox 42 jumps óver the lazy dog twice TODAY"),
    (6, "aa aa aa b aa"),
    (6, "aa aa aa b aa"),
    (None, "short answer"),
    (7, "word " * 50_000 + ITEM),
]


def results(df):
    return sorted([tuple(r) for r in df.select("doc_id", "n_words", "n_hit", "n_items", "items_sha256", "contaminated").collect()], key=repr)


def items_table(spark, rows):
    return spark.createDataFrame(rows, "item_id long, text string")


def test_equals_brute_force(spark, documents):
    items = items_table(spark, ITEMS)
    assert results(decontaminate.mark(documents(DOCS), items)) == plain(DOCS, ITEMS)


def test_blocks_of_patterns_add_up(spark, documents):
    items = items_table(spark, ITEMS)
    assert results(decontaminate.mark(documents(DOCS), items, block_windows=2)) == plain(DOCS, ITEMS)


def test_spans_are_places_in_the_original(spark, documents):
    rows = decontaminate.mark(documents(DOCS), items_table(spark, ITEMS)).filter("doc_id in (1, 2)").collect()
    texts = dict(DOCS[:2])
    spans = {r.doc_id: [texts[r.doc_id][s.start : s.end] for s in r.spans] for r in rows}
    assert spans[1] == [ITEM.upper().replace("Ó", "ó")]
    assert spans[2] == ["short\n\nANSWER"]


def test_empty_tables_and_clashing_columns(spark, documents):
    nothing = items_table(spark, [])
    marked = decontaminate.mark(documents(DOCS).withColumnRenamed("source", "contaminated"), nothing)
    assert {r.contaminated for r in marked.collect()} == {False}
    assert marked.columns.count("contaminated") == 1
    assert decontaminate.mark(documents([]), items_table(spark, ITEMS)).count() == 0


def test_large_test_sets_are_cut_by_bytes(spark, documents):
    rnd = random.Random(3)
    words = ["".join(rnd.choices("abcdefghij", k=6)) for _ in range(4000)]
    texts = [" ".join(rnd.choices(words, k=30)) for _ in range(1500)]
    items = items_table(spark, list(enumerate(texts)))
    blocks = list(decontaminate._pattern_blocks(items, 10, decontaminate.BLOCK_WINDOWS, decontaminate.BLOCK_BYTES))
    assert len(blocks) == 3
    for raw in blocks:
        assert sum(map(len, pickle.loads(raw))) <= decontaminate.BLOCK_BYTES
        assert decontaminate._automaton(raw).get_stats()["total_size"] < 96 << 20
    docs = [(i, f"before {texts[i * 99]} between {texts[i * 7 + 3]} after") for i in range(12)]
    expected = plain(docs, list(enumerate(texts))[:100] + [(i * 99, texts[i * 99]) for i in range(2, 12)])
    marked = decontaminate.mark(documents(docs), items)
    assert results(marked) == expected
    one = decontaminate.mark(documents(docs), items, block_bytes=1 << 30)
    assert sorted(map(str, one.collect())) == sorted(map(str, marked.collect()))


def test_one_automaton_a_task(spark, documents):
    marked = decontaminate.mark(documents(DOCS), items_table(spark, ITEMS), block_bytes=80)
    assert results(marked) == plain(DOCS, ITEMS)
    plan = marked._jdf.queryExecution().executedPlan().toString()
    assert plan.count("ArrowEvalPython") == 1
