from collections import Counter, defaultdict

from tidemark.llm import lines


def plain(rows, min_docs=3, depth=3, min_tokens=4, constant=0.6, share=50):
    """Equal lines, and the template tree built line by line."""
    every, parsed = defaultdict(list), []
    for r, (doc, text) in enumerate(rows):
        for no, line in enumerate((text or "").split("\n") if text is not None and doc is not None else []):
            words = tuple(t for t in line.replace("\t", " ").split(" ") if t)
            if words:
                every[words].append((r, doc, no))
            tokens = tuple("<*>" if any(c in "0123456789" for c in t) else t for t in words)
            if len(tokens) >= min_tokens:
                parsed.append((r, doc, no, tokens, (len(tokens), *tokens[:depth])))
    gone = defaultdict(set)
    for places in every.values():
        keeper = min(doc for _, doc, _ in places)
        for r, doc, no in places:
            if doc > keeper:
                gone[r].add(no)
    leaf_docs = defaultdict(set)
    for _, doc, _, _, leaf in parsed:
        leaf_docs[leaf].add(doc)
    parsed = [p for p in parsed if len(leaf_docs[p[4]]) >= min_docs]
    seen, size = Counter(), Counter()
    for doc, tokens, leaf in {(p[1], p[3], p[4]) for p in parsed}:
        size[leaf] += 1
        seen.update((leaf, i, t) for i, t in enumerate(tokens))
    template = {}
    for p in parsed:
        steady = lambda i, t: t != "<*>" and seen[p[4], i, t] >= min_docs and seen[p[4], i, t] * share >= size[p[4]]  # noqa: B023, E731
        template[p[3]] = tuple(t if steady(i, t) else "<*>" for i, t in enumerate(p[3]))
    docs = defaultdict(set)
    for p in parsed:
        if sum(t != "<*>" for t in template[p[3]][depth:]) >= constant * (len(p[3]) - depth):
            docs[template[p[3]]].add(p[1])
    for r, doc, no, tokens, _ in parsed:
        owners = docs.get(template[tokens], ())
        if len(owners) >= min_docs and doc > min(owners):
            gone[r].add(no)
    out = []
    for r, (doc, text) in enumerate(rows):
        parts = text.split("\n") if text is not None else []
        kept = text if text is None else "\n".join(x for i, x in enumerate(parts) if i not in gone[r])
        out.append((doc, kept, len(parts), len(gone[r])))
    return sorted(out, key=repr)


LOG = "user {} logged in from host {} at {}"
ROWS = [
    (1, LOG.format("ann", "h1", "10:00") + "\nA clean line of its own\nshort"),
    (2, "another clean line stays here\n" + LOG.format("ann", "h2", "11:30") + "\nshort"),
    (3, LOG.format("ann", "h9", "12:30") + "\n\n" + LOG.format("ann", "h7", "1:1")),
    (3, LOG.format("ann", "h9", "12:30") + "\n\n" + LOG.format("ann", "h7", "1:1")),
    (3, "same id other text\n" + LOG.format("ann", "h1", "0")),
    (4, "All rights are reserved worldwide by Ann 2020\nshort"),
    (5, "\tAll rights are  reserved worldwide by Bob 2021 "),
    (6, "All rights are reserved worldwide by Cid x9\nbody text of six is here"),
    (7, "one two three four five six\none two three a b c"),
    (8, "one two three d e f\none two three g h i"),
    (9, "one two three j k l"),
    (None, LOG.format("ann", "h1", "10:00")),
    (10, None),
    (11, ""),
    (12, "filler line number {} goes\n".format("x") * 3000 + "tail of a very long text"),
    (13, "only in one document 1\nonly in one document 2\nonly in one document 3"),
]


def test_equals_brute_force(documents, rows):
    got = lines.drop_recurring(documents(ROWS))
    assert rows(got, "doc_id", "text", "n_lines", "n_dropped") == plain(ROWS)
    dropped = {r.doc_id: r.n_dropped for r in got.filter("doc_id in (1, 2, 5, 8, 13)").collect()}
    assert dropped == {1: 0, 2: 2, 5: 1, 8: 0, 13: 0}


def test_empty_table_and_clashing_columns(documents):
    assert lines.drop_recurring(documents([])).count() == 0
    frame = documents(ROWS).withColumnsRenamed({"source": "mark", "lang": "line_no", "n_chars": "n_lines"})
    got = lines.drop_recurring(frame)
    assert got.columns == ["doc_id", "text", "line_no", "mark", "n_lines", "n_dropped"]
    assert got.agg({"n_dropped": "sum"}).first()[0] == sum(r[3] for r in plain(ROWS))


def test_no_python_in_the_plan(spark, documents, saved):
    from compare import plan_of

    frame = spark.read.parquet(saved(documents=documents(ROWS)) + "/documents.parquet")
    assert not [x for x in ("Python", "Pandas", "Arrow", "Cartesian", "NestedLoop") if x in plan_of(lines.drop_recurring(frame))]


def test_equal_lines_go_from_all_but_one_document(documents):
    """Short lines, lines with digits, lines without spaces and long lines in two documents only."""
    long = " ".join(f"word{i}x" for i in range(60))
    shared = ["Read more", "Page 7", "\u5168\u6587\u3092\u8aad\u3080", long]
    rows = [(5, "\n".join([*shared, "own five"])), (2, "\n".join(["own two", *reversed(shared)])), (9, "Read  more \nown nine")]
    got = {r.doc_id: r.text for r in lines.drop_recurring(documents(rows)).collect()}
    assert got == {2: rows[1][1], 5: "own five", 9: "own nine"}


def test_fields_generalise_alike_in_a_crowded_leaf(documents, rows):
    """The lines of a template go whether a few or thousands of documents have it, though names and towns repeat."""
    line = "Posted in the town of {} by {} on this very day"
    few = [(i, line.format(f"town{'abcdef'[i]}", f"name{'uvwxyz'[i]}")) for i in range(6)]
    letters = "abcdefghijklmnopqrstuvwxyz"
    many = [(100 + i, line.format("town" + letters[i % 26] + letters[i // 26 % 26], "name" + letters[i // 7 % 26] + letters[i % 23])) for i in range(3000)]
    alone = {r.doc_id: r.n_dropped for r in lines.drop_recurring(documents(few)).collect()}
    crowded = lines.drop_recurring(documents([*few, *many]))
    assert {r.doc_id: r.n_dropped for r in crowded.filter("doc_id < 100").collect()} == alone == {0: 0, **dict.fromkeys(range(1, 6), 1)}
    assert rows(crowded, "doc_id", "text", "n_lines", "n_dropped") == plain([*few, *many])


def test_leading_tokens_alone_make_no_template(documents):
    rows = [(1, "Thor the haan eaesing"), (2, "Thor the haan for"), (3, "Thor the haan eron"), (4, "Thor the haan away")]
    assert lines.drop_recurring(documents(rows)).agg({"n_dropped": "sum"}).first()[0] == 0
